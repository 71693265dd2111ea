import random
from collections import Counter

from pyspark.sql import functions as F

from gleaner.operators.chunked import Chunking, dominant_keys, gap_profile, key_counts, number_rows
from gleaner.operators.lookup import lookup_join

ROWS = [(random.Random(i).choice(["hot"] * 6 + ["b", "c", None, ""]), random.Random(i + 7).choice([None, *range(1000)]), i, "x") for i in range(900)]
SCHEMA = "k string, t bigint, i bigint, number string"


def test_numbers_are_complete_and_chunks_bounded(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    for ordered in (False, True):
        out = number_rows(df, "k", [F.col("t").asc_nulls_first(), F.col("i").asc()], Chunking(50, ordered)).collect()
        by = {}
        for r in out:
            by.setdefault(r["k"], []).append(r["number"])
        assert {k: sorted(v) for k, v in by.items()} == {k: list(range(n)) for k, n in Counter(r[0] for r in ROWS).items()}
        assert max(Counter((r["k"], r["chunk"]) for r in out).values()) == 50
        if ordered:
            hot = sorted((r["number"], r["t"] if r["t"] is not None else -1, r["i"]) for r in out if r["k"] == "hot")
            assert [x[1:] for x in hot] == sorted(x[1:] for x in hot)


def test_counts_and_share(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    want = Counter(r[0] for r in ROWS)
    assert {r["key_value"]: r["n_rows"] for r in key_counts(df, "k", Chunking(7)).collect()} == want
    got = {r["key_value"] for r in dominant_keys(df, "k", 0.3).collect()}
    assert got == {k for k, n in want.items() if n > 0.3 * len(ROWS)}


def test_gaps_across_chunk_borders(spark):
    got = {r["key_value"]: r for r in gap_profile(spark.createDataFrame(ROWS, SCHEMA).repartition(4), "k", "t", "i", F.lit(1), Chunking(9, True)).collect()}
    for key in {r[0] for r in ROWS}:
        times = sorted(r[1] for r in ROWS if r[0] == key and r[1] is not None)
        assert got[key]["longest_gap"] == max(b - a for a, b in zip(times, times[1:], strict=False))
        assert (got[key]["first_at"], got[key]["last_at"]) == (times[0], times[-1])
        assert got[key]["n_rows"] == got[key]["measure"] == sum(r[0] == key for r in ROWS)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert key_counts(df, "k").count() == 0
    assert dominant_keys(df, "k").count() == 0


def test_lookup_join_without_broadcast_is_the_same(spark):
    rows = spark.createDataFrame([(k, i) for k, _, i, _ in ROWS], "k string, i bigint")
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    small, large = (sorted(r["i"] for r in lookup_join(rows, table, ["k"], "n", b).collect()) for b in (100, 1))
    assert small == large == sorted(r[2] for r in ROWS if r[0] is not None)
