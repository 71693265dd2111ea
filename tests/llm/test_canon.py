import random
import string

import pytest

from gleaner.llm.canon import MAX_EDITS, Entry, Matcher, deletions, map_to_list, weighted_distance

REF = [
    (1, "city", "Paiststead", "", []), (2, "city", "North Paiststead", "", ["Flandenmont"]), (3, "branch", "Treltmore Center", "Paiststead", ["Grouckton"]),
    (4, "street", "Pearington Terrace", "Paiststead", []), (5, "street", "Pearington Drive", "Bomgate", []), (6, "city", "Bomgate", "", None), (7, "street", "Siskinggate Highway", "Bomgate", []),
]
REF_SCHEMA = "ref_id bigint, ref_kind string, name string, city string, aliases array<string>"


def edits(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_distance_equals_the_full_table():
    r = random.Random(0)
    for _ in range(3000):
        a = "".join(r.choice("abc") for _ in range(r.randrange(7)))
        b = "".join(r.choice("abc") for _ in range(r.randrange(7)))
        found = weighted_distance(a, b)
        assert (found[0] if found else None) == (edits(a, b) if edits(a, b) <= MAX_EDITS else None)


def test_deletions_meet_every_name_within_the_edits():
    r = random.Random(1)
    names = ["".join(r.choice(string.ascii_lowercase[:6]) for _ in range(8)) for _ in range(80)]
    m = Matcher([Entry(i, "city", n, "", n) for i, n in enumerate(names)], {})
    for n in names[:40]:
        typed = list(n)
        for _ in range(2):
            i = r.randrange(len(typed))
            typed[i : i + 1] = r.choice([[], [typed[i], "z"], ["y"]])
        typed = "".join(typed)
        want = {i for i, x in enumerate(names) if edits(typed, x) <= MAX_EDITS}
        if typed in names:
            continue
        assert {x[2] for x in m.near("city", typed)} == (want if len(typed) >= 6 else {x[2] for x in m.near("city", typed)})
    assert "abc" in deletions("abxcy")


VALUES = [
    ("branch,city", "the treltmore ctr. one", 3), ("branch,city", "TreltmoreCentre", 3), ("branch,city", "Treltmore Center, Paiststead", 3), ("branch,city", "Treltmroe Ctr (MA)", 3),
    ("branch,city", "paistsead", 1), ("branch,city", "N. Paiststead", 2), ("branch,city", "Grouckton", 3), ("branch,city", "the big one", 0), ("branch,city", "Treltmore Plaza", 0),
    ("city", "Nth Paiststead, MA 00412", 2), ("city", "West Bomgate", 0), ("street", "12 Pearington Ter., Apt 4", 4), ("street", "Unit 3, 88B pearingtn dr", 5),
    ("street", "Siskinggate 307", 7), ("street", "Pearington 4, Bomgate", 5), ("street", "P.O. Box 9", 0), ("street", "9 Siskinggate Road", 0), ("city", "x" * 200_000, 0),
]


@pytest.mark.parametrize("kinds,value,want", VALUES)
def test_values(kinds, value, want):
    m = Matcher([Entry(i, k, n, c, w) for i, k, n, c, al in REF for w in [n, *(al or [])]], {})
    assert (m.street(value) if kinds == "street" else m.place(value, kinds.split(","))) == want


def test_rows(spark):
    ref = spark.createDataFrame(REF, REF_SCHEMA)
    values = [("s", 1, "Bomgate", "city"), ("s", 2, "bomgate", "city"), ("s", 3, "  ", "city"), ("s", 4, None, "city"), ("s", 5, "bomgate", "city"), ("s", 6, "nowhere", "city")]
    schema = "src string, row_id bigint, value string, kinds string"
    got = sorted(tuple(r) for r in map_to_list(spark.createDataFrame(values, schema), ref).collect())
    assert got == [("s", 2, 6), ("s", 5, 6), ("s", 6, 0)]
    typed = [(str(i), i, v, k) for i, (k, v, _) in enumerate(VALUES)]
    for most in (0, 1000):  # joined, broadcast
        got = {r["row_id"]: r["ref_id"] for r in map_to_list(spark.createDataFrame(typed, schema), ref, most).collect()}
        assert got == {i: want for i, (_, _, want) in enumerate(VALUES)}
    assert map_to_list(spark.createDataFrame([], schema), ref).count() == 0
    assert [r["ref_id"] for r in map_to_list(spark.createDataFrame(values[1:2], schema), ref.limit(0)).collect()] == [0]


def test_a_name_of_many_towns(spark):
    """One street name in many towns: joined, few entries reach a value, and the result is that of the broadcast."""
    towns = [(i, "city", f"Town{chr(97 + i // 26)}{chr(97 + i % 26)}ville", "", [f"Old{chr(97 + i // 26)}{chr(97 + i % 26)}place"]) for i in range(60)]
    ref = spark.createDataFrame(towns + [(100 + i, "street", "Pearington Road", towns[i][2], None) for i in range(60)], REF_SCHEMA)
    typed = ["12 Pearington Rd, Townabville", "5 pearingtn road, Oldbcplace", "Pearington Road, Nowhere", "7 Pearington"]
    schema = "src string, row_id bigint, value string, kinds string"
    values = spark.createDataFrame([("s", i, v, "street") for i, v in enumerate(typed)], schema)
    got = [{r["row_id"]: r["ref_id"] for r in map_to_list(values, ref, most).collect()} for most in (0, 1000)]
    assert got[0] == got[1] == {0: 101, 1: 128, 2: 100, 3: 100}
