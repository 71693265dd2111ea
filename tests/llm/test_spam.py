import random
import time

from gleaner.llm.spam import LINK, WORD, Languages, SpamSettings, block_ratio, normalised, measured, sentence_ends, shape, short_words, spam_pages

SCHEMA = "doc_id bigint, text string, lang string"
WORDS = (
    "bread market cashier evening pepper window bottle summer corner basket orchard kitchen neighbour morning candle saturday flavour counter parking station winter garden shelf honey"
).split()
SMALL = "the a of to in on at we it is was by my no so up if for and but not had its one too".split()


def prose(r, sentences):
    """Sentences of small and longer words, with now and then a comma."""
    out = []
    for _ in range(sentences):
        words = [r.choice(SMALL) if r.random() < 0.55 else r.choice(WORDS) for _ in range(r.randrange(6, 15))]
        if r.random() < 0.4:
            words[len(words) // 2] += ","
        out.append(" ".join(words).capitalize() + ".")
    return " ".join(out)


def lists(r):
    keyword = lambda: " ".join(r.choice(["cheap", "local", "organic", *WORDS]) for _ in range(r.randrange(1, 4)))
    link = lambda: f"https://{r.choice(WORDS)}{r.randrange(99)}.example/{r.choice(WORDS)}/{r.randrange(9999)}"
    n = r.randrange(25, 60)
    return [
        ", ".join(keyword() for _ in range(n)),
        "\n".join(link() for _ in range(n)),
        "  ".join(f"#{r.choice(WORDS)}{r.choice(WORDS)}" for _ in range(n)),
        "".join(f'<li><a href="{link()}">{keyword()}</a></li>' for _ in range(n)),
        prose(r, 3) + "\n" + "\n".join(f"{keyword()} {link()}" for _ in range(n)),
        " ".join(r.choice(WORDS[:4]) for _ in range(3 * n)),
        "We have cheap salmon, more cheap salmon and only cheap salmon. Buy cheap salmon today. " * (n // 4),
    ]


def good(r):
    price = lambda: f"{r.randrange(1, 30)}.{r.randrange(100):02}"
    n = r.randrange(12, 30)
    return [
        "\n".join(f"{r.choice(WORDS).upper()}  {price()}" for _ in range(n)),
        prose(r, 1) + "\n" + "\n".join(f"{r.choice(WORDS)} ${price()} each" for _ in range(n)),
        prose(r, 9) + " #bread #milk https://a.example/x/y",
    ]


def corpus():
    r = random.Random(3)
    texts = [prose(r, r.randrange(3, 45)) for _ in range(600)]
    spam = [t for _ in range(5) for t in lists(r)]
    fine = [t for _ in range(8) for t in good(r)]
    return texts, spam, fine


def test_pages(spark):
    texts, spam, fine = corpus()
    rows = [(i, t, "en") for i, t in enumerate(texts + fine)] + [(10_000 + i, t, "EN-us") for i, t in enumerate(spam)]
    rows += [(20_000, None, "en"), (20_001, "", "en"), (20_002, "#a #b #c", None), (20_003, spam[0], None), (None, spam[0], "en"), (10_000, spam[0], "en")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = sorted(r[0] for r in spam_pages(df).collect())
    assert set(found) == {*range(10_000, 10_000 + len(spam)), 20_003}
    assert len(found) == len(spam) + 2  # of two rows of one id each is judged
    assert spam_pages(df.limit(0)).count() == 0


def test_few_texts_have_norms_too(spark):
    r = random.Random(1)
    df = spark.createDataFrame([(i, prose(r, 12), None) for i in range(4)], SCHEMA)
    assert spam_pages(df).count() == 0
    assert all(x["text_part"] > 0.5 for x in normalised(measured(df)).collect())


def test_shape():
    assert shape("The new bread was 3.99, see https://a.example/x?y=1 or #Tag") == f"the new {WORD} was 3.99, see {LINK} or #tag"
    assert shape("最好的面包", frozenset("的")) == f"{WORD}{WORD}的{WORD}{WORD}"
    lists, text = ", ".join(WORDS * 4), prose(random.Random(2), 12)
    assert block_ratio(shape(lists), len(lists), 4096) < block_ratio(shape(text), len(text), 4096) / 2


def test_languages_are_told_by_their_small_words():
    tell = Languages({"en": {"the": 0.9, "of": 0.8, "and": 0.8, "la": 0.01}, "es": {"la": 0.9, "de": 0.9, "y": 0.8, "el": 0.7}}).tell
    assert tell(short_words("The end of the road and the car")) == "en"
    assert tell(short_words("La casa de la playa y el mar")) == "es"
    assert tell(short_words("#kale, #rice, #the")) is None


def test_sentences_said_again_do_not_count():
    assert sentence_ends("Buy it now! Buy it now! Eat it. 很好。") == (4, 3)
    assert sentence_ends("") == (0, 0)


def test_long_texts_take_no_long():
    start, s = time.time(), SpamSettings()
    for t in ("<a " * 100_000, "a-" * 200_000, "a." * 200_000, "x" * 1_000_000, "." * 500_000, ", " * 200_000, "最" * 300_000):
        block_ratio(shape(t, frozenset("最")), len(t), s.block), sentence_ends(t), short_words(t)
    assert time.time() - start < 60
