import random

import pytest

from gleaner.llm.caps import CapSettings, beyond_cap, claims_beyond_cap, confidence_rank, quality_number

SCHEMA = "claim_row bigint, store string, category string, claim string, confidence string, source_key string, author string, created_utc bigint, total string"


def brute(rows, cap):
    seen, groups = {}, {}
    for r in sorted(rows, key=lambda r: r[0]):
        if seen.setdefault((r[5], r[1], r[2], r[3]), r[0]) != r[0]:
            continue
        handle = (r[6] or "").strip().lower().removeprefix("/").removeprefix("u/")
        if not r[1] or handle in ("", "[deleted]", "[removed]"):
            continue
        conf = {"high": 0, "medium": 1, "low": 2}.get((r[4] or "").strip().lower(), 3)
        groups.setdefault((handle, r[1]), []).append((conf, -(r[7] if r[7] is not None else -(2**40)), r[0]))
    return sorted(x[2] for g in groups.values() for x in sorted(g)[cap:])


@pytest.mark.parametrize("seed,bits", [(0, 22), (1, 2), (2, 0)])
def test_equal_to_sorting_each_group(spark, seed, bits):
    r = random.Random(seed)
    rows = [
        (i, r.choice(["A", "A", "B", None, ""]), r.choice("xy"), f"c{r.randrange(60)}", r.choice(["high", " HIGH", "medium", "low ", "odd", None]), r.choice([f"d{r.randrange(30)}", None]),
         r.choice(["u1", "U1", " /u/u1 ", "u/u1", "v", None, "", "[deleted]"]), r.choice([None, 1_600_000_000 + r.randrange(40)]), "t")
        for i in range(500)
    ]
    got = claims_beyond_cap(spark.createDataFrame(rows, SCHEMA), CapSettings(cap=8, bin_bits=bits))
    assert sorted(x[0] for x in got.collect()) == brute(rows, 8)


def test_share_of_all_and_extra_columns(spark):
    df = spark.createDataFrame([("k", i, 5, "keep") for i in range(10)] + [("z", 100, 5, "keep")], "key string, tie bigint, quality bigint, total string")
    out = beyond_cap(df, ["key"], CapSettings(cap=None, share=0.3))
    assert out.columns == df.columns and sorted(r["tie"] for r in out.collect()) == list(range(3, 10))


def test_nothing_and_no_cap(spark):
    assert claims_beyond_cap(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        beyond_cap(spark.createDataFrame([("k", 1, 1)], "key string, tie bigint, quality bigint"), ["key"], CapSettings(cap=0))


def test_quality_order(spark):
    df = spark.createDataFrame([("high", 5), ("high", 9), ("high", None), ("low", 9), (None, None)], "c string, t bigint")
    q = [r[0] for r in df.select(quality_number(confidence_rank(df["c"]), df["t"])).collect()]
    assert q[1] < q[0] < q[2] < q[3] < q[4]
