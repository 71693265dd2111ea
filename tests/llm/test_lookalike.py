import itertools
from types import SimpleNamespace

import pytest

from gleaner.llm.lookalike import Rewriter, confusable_pairs, look_alike_classes, look_classes, looks_of, rewriter_of, same_look_pairs, with_consistent_form

TEXTS = [
    "Market Basket", "Mаrket Basket", "Ｍａｒｋｅｔ　Ｂａｓｋｅｔ", "Mar​ket Basket", "market basket", "Market  Basket", "Café", "Café", "Cafe", "ﬁsh", "fish", "a‘b", "a'b", "К", "K", "K",
    "", None, "👨‍👩", "👨👩", "...", "…",
]


def same_look(a, b):
    groups = [{"Market Basket", "Mаrket Basket", "Ｍａｒｋｅｔ　Ｂａｓｋｅｔ", "Mar​ket Basket"}, {"Café", "Café"}, {"ﬁsh", "fish"}, {"К", "K", "K"}, {"...", "…"}]
    return a != b and any(a in g and b in g for g in groups)


def test_classes_are_transitive_and_apart():
    members = [s for g in look_alike_classes() for s in g]
    assert len(members) == len(set(members))
    of = {s: i for i, g in enumerate(look_alike_classes()) for s in g}
    assert of["a"] == of["а"] == of["ａ"] and of["a"] != of["A"]


def test_pairs_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS + TEXTS[:3])], "id bigint, t string")
    texts = dict(enumerate(TEXTS + TEXTS[:3]))
    want = {(i, j) for i, j in itertools.combinations(texts, 2) if same_look(texts[i], texts[j])}
    looks = looks_of(df, "id", "t", rewriter_of(df, "t"))
    for chunk in (1, 2, 1000):
        got = same_look_pairs(looks, chunk).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)
    of = {i: {i} | {j for a, b in want if i in (a, b) for j in (a, b)} for i in texts}
    classes = {r["key"]: (r["look"], r["rows"]) for r in look_classes(looks).collect()}
    alike = [i for i in of if len(of[i]) > 1]
    assert sorted(classes) == sorted(alike)
    group = lambda i: {j for j in alike if same_look(texts[i], texts[j]) or texts[i] == texts[j]}
    assert all(classes[i] == (min(group(i)), len(group(i))) for i in alike)


#: Pairs that the public table or the character database calls the same, and pairs that a reader tells apart.
SHEET = "a а|c ϲ|M Ꮇ|T Ꭲ|S Ꮪ|T ꓔ|M 𝐌|n ո|g ց|$ ﹩|o օ|H ℋ|K К|e ｅ|I Ⅰ|B Ᏼ|A Ꭺ|P ꓑ|X Χ|C Ⲥ|O Ⲟ|w ա|h հ|q զ|u ս|V Ꮩ|L Ꮮ|N Ⲛ|ë ё|fi ﬁ|x 𝓍|7 𝟕|Z Ꮓ|J Ꭻ|E ꓰ|Y ꓬ"
APART = "a A|e é|o 0|I l|1 l|O 0|' ’|i ı|ß β|a α|r г|3 З|n ñ|- —|o ø|S $|α а"


def test_sheet(spark):
    confusable = confusable_pairs(spark)
    assert len(confusable) > 200 and all(sum(m.isascii() for m in g) < 2 for g in look_alike_classes(confusable))
    f = Rewriter(confusable=confusable).build()
    pairs = [p.split(" ") for p in SHEET.split("|")]
    missed = [p for p in pairs if f(p[0]) != f(p[1])]
    assert len(missed) <= 0.05 * len(pairs), missed
    assert not [p for p in (x.split(" ") for x in APART.split("|")) if f(p[0]) == f(p[1])]


def test_representative_is_the_more_frequent(spark):
    df = spark.createDataFrame([("сыр",), ("сок",), ("c",)], "t string")
    assert with_consistent_form(df, "t", "f", rewriter_of(df, "t")).where("t = 'c'").first()["f"] == "с"


def test_form_is_stable():
    f = Rewriter({"a": 5}).build()
    for t in TEXTS:
        assert t is None or f(f(t)) == f(t)
    long = "Ｍаrket " * 200_000
    assert f(long) == "Market " * 200_000


def test_nothing(spark):
    df = spark.createDataFrame([], "id bigint, t string")
    assert same_look_pairs(looks_of(df, "id", "t", rewriter_of(df, "t"))).count() == 0


@pytest.mark.parametrize("jvm", ["without the table", "that throws"])
def test_no_table_is_no_result(spark, jvm):
    own = spark._jvm
    text = SimpleNamespace(SpoofChecker=SimpleNamespace(Builder=lambda: own.java.net.URI("::")))
    throws = SimpleNamespace(com=SimpleNamespace(ibm=SimpleNamespace(icu=SimpleNamespace(text=text))))
    # py4j takes an unknown name for a package
    with pytest.raises(RuntimeError, match="table of confusables"):
        confusable_pairs(SimpleNamespace(_jvm=own.no.such if jvm == "without the table" else throws))
