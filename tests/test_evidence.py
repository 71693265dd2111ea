import random

import pytest
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.config import Settings
from gleaner.functions import scoring
from gleaner.functions.text import UNSAFE
from gleaner.operators import calibration as cal
from gleaner.operators import evidence as ev
from gleaner.operators import ratings as rt

S = Settings()
SCHEMA = (
    "claim_row bigint, store string, location string, category string, item string, claim string, sentiment string, price_signal string, confidence string, comparator_store string,"
    " transient boolean, source_key string, permalink string, author string, created_utc bigint, score bigint"
)


def claim(row, **over):
    base = dict(
        claim_row=row, store="Aldi", location="", category="produce", item="", claim=f"c{row}", sentiment="positive", price_signal="none", confidence="high", comparator_store="",
        transient=False, source_key=f"c_x_{row}", permalink="/r/x/1/", author=f"a{row}", created_utc=S.now, score=None,
    )
    return tuple((base | over).values())


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def greedy(rows):
    weight = {"high": 1.0, "medium": 0.6, "low": 0.3}
    docs, cells, out = {}, {}, []
    for r in sorted(rows, key=lambda r: (-weight.get(r[8], 0.6), -r[14], r[11], r[5], r[0])):
        doc, cell = (r[11], r[1]), (r[13], r[1], r[3])
        named = r[13] not in ("", "[deleted]", "[removed]")
        if docs.get(doc, 0) >= 3 or named and cells.get(cell, 0) >= 2:
            continue
        docs[doc] = docs.get(doc, 0) + 1
        if named:
            cells[cell] = cells.get(cell, 0) + 1
        out.append(r[0])
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_caps_equal_the_sequential_rule(spark, seed):
    r = random.Random(seed)
    rows = [
        claim(i, store=r.choice(["A", "B"]), category=r.choice("pqr"), confidence=r.choice(["high", "medium", "low", "odd"]), created_utc=1_600_000_000 + r.randrange(3),
              source_key=f"d{r.randrange(8)}", author=r.choice(["u", "v", "w", "", "[deleted]"]), claim=f"c{r.randrange(40)}")
        for i in range(120)
    ]
    few = (0, 10, 1000, 1000)[seed]  # in rounds to the end, in some rounds, at once
    assert sorted(x[0] for x in ev.independence_caps(frame(spark, rows), few=few).select("claim_row").collect()) == greedy(rows)


def test_a_rejected_claim_uses_no_quota(spark):
    rows = [claim(i, category=c, source_key="d", author="u", claim=f"{i}") for i, c in enumerate(["c1", "c1", "c1", "c2", "c3"])]
    assert [r[0] for r in ev.independence_caps(frame(spark, rows)).orderBy("claim_row").select("claim_row").collect()] == [0, 1, 3]


def test_caps_of_nothing(spark):
    assert ev.independence_caps(frame(spark, [])).count() == 0


def test_transient_claims_take_no_place(spark):
    rows = [claim(i, source_key="d", transient=i < 3, category=f"c{i}") for i in range(4)]
    assert [r["claim_row"] for r in ev.prepare(frame(spark, rows)).collect()] == [3]


def test_reciprocals_count_half(spark):
    rows = [claim(0, source_key="d", store="A", comparator_store="B"), claim(1, source_key="d", store="B", comparator_store="A"), claim(2, store="A", comparator_store="Z")]
    out = {r["claim_row"]: (r["reciprocal"], r["w"]) for r in ev.weigh(ev.prepare(frame(spark, rows))).collect()}
    assert out == {0: (True, 0.5), 1: (True, 0.5), 2: (False, 1.0)}


def test_six_spellings_are_one_branch(spark):
    names = ["Somerville", "somerville ", "the Somerville one", "Somerville, MA", "Somerville St", "SOMERVILLE  location"]
    rows = [claim(i, location=n) for i, n in enumerate(names)]
    cells = ev.branch_cells(ev.weigh(ev.prepare(frame(spark, rows)))).collect()
    assert [(c["branch"], c["n"]) for c in cells] == [("somerville", 6)]


def test_a_category_or_the_store_is_no_branch(spark):
    rows = [claim(0, location="Produce"), claim(1, location="ALDI"), claim(2, location="Beacon St, Town")]
    assert sorted(r["branch"] for r in ev.weigh(ev.prepare(frame(spark, rows))).collect()) == ["", "", "beacon, town"]


def test_weights(spark):
    row = spark.range(1).select(
        scoring.recency_weight(F.lit(S.now - int(4 * scoring.SECONDS_PER_YEAR)), S.now, 4.0).alias("old"), scoring.recency_weight(F.lit(S.now + 99), S.now, 4.0).alias("new"),
        *[scoring.vote_weight(F.lit(v).cast("bigint")).alias(f"v{i}") for i, v in enumerate([None, -5, 0, 100_000])],
    ).first()
    assert row["old"] == pytest.approx(0.5) and row["new"] == 1.0
    assert [row[f"v{i}"] for i in range(4)] == [1.0, 0.5, 1.0, 2.0]


def test_price_label_needs_evidence(spark):
    rows = [claim(0, price_signal="cheap", confidence="low"), *[claim(i, store="B", price_signal="cheap") for i in range(1, 9)]]
    v = {r["store"]: r for r in ev.view(ev.chain_cells(ev.branch_cells(ev.weigh(ev.prepare(frame(spark, rows)))))).collect()}
    assert v["Aldi"]["price_signal"] is None and v["Aldi"]["price_level"] is None
    assert v["B"]["price_signal"] == "cheap" and v["B"]["price_level"] == pytest.approx(-0.8)


def test_headline_half_life_keeps_the_mixture(spark):
    rows = [(f"s{i}", c, w) for i, (c, w) in enumerate([("price_overall", 3.0), ("cleanliness", 1.0)])]
    cells = spark.createDataFrame(rows, "store string, category string, weight double")
    h = ev.headline_half_life(cells).first()[0]
    assert 4.0 * 0.5 ** (5 / h) == pytest.approx(3 * 0.5 ** (5 / 7) + 0.5 ** (5 / 2))
    assert ev.headline_half_life(cells.limit(0)).first()[0] == 4.0


def match(edges):
    a, b, out = set(), set(), set()
    for d, g, o in sorted(edges):
        if g not in a and o not in b:
            a.add(g), b.add(o), out.add((g, o))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_matching_equals_the_sorted_list(spark, seed):
    r = random.Random(seed)
    edges = list({(g, o): (float(r.randrange(6)), g, o) for g, o in ((f"g{r.randrange(9)}", f"o{r.randrange(9)}") for _ in range(40))}.values())
    df = spark.createDataFrame([("s", g, o, d) for d, g, o in edges], "store string, gmap_id string, osm string, metres double")
    few = (0, 15, 1000)[seed]
    assert {(x["gmap_id"], x["osm"]) for x in rt.match_one_to_one(df, few).collect()} == match(edges)


def test_a_long_line_of_falling_distances_is_matched(spark):
    edges = [(float(1000 - i), f"g{(i + 1) // 2:03}", f"o{i // 2:03}") for i in range(450)]
    df = spark.createDataFrame([("s", g, o, d) for d, g, o in edges], "store string, gmap_id string, osm string, metres double")
    assert {(x["gmap_id"], x["osm"]) for x in rt.match_one_to_one(df).collect()} == match(edges)


def test_scrub_takes_line_ends_and_tabs_too(spark):
    text = F.regexp_replace(F.col("x"), UNSAFE, "")
    every = "".join(chr(c) for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF)
    unsafe = lambda c: any(lo <= ord(c) <= hi for lo, hi in vocab.UNSAFE_RANGES)
    got = spark.createDataFrame([("line\nbreak\ttab",), (every,)], "x string").select(text).collect()
    assert got[0][0] == "linebreaktab" and got[1][0] == "".join(c for c in every if not unsafe(c))


def test_geo_grid_misses_no_neighbour(spark):
    r = random.Random(2)
    a = [(f"g{i}", "s", 60 + r.random() * 0.01, 10 + r.random() * 0.02) for i in range(60)]
    b = [(f"o{i}", "s", 60 + r.random() * 0.01, 10 + r.random() * 0.02) for i in range(60)]
    left, right = spark.createDataFrame(a, "gmap_id string, store string, latitude double, longitude double"), spark.createDataFrame(b, "osm string, store string, lat double, lon double")
    got = {(x["gmap_id"], x["osm"]) for x in rt.nearby(left, right).collect()}
    away = scoring.metres(F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lon"))
    want = {(x["gmap_id"], x["osm"]) for x in left.crossJoin(right.drop("store")).where(away <= 150).collect()}
    assert got == want and want


def test_upper_median_month(spark):
    ms = lambda s: s * 1000
    rows = [("s", "g", 5.0, ms(1514764800), 0), ("s", "g", 1.0, ms(1609459200), 200), ("s", "g", 3.0, ms(1609459201), 0), ("s", "g", 3.0, ms(1514764801), 0)]
    out = rt.summarise(spark.createDataFrame(rows, "store string, gmap_id string, rating double, time bigint, text_len int"), ["store"]).first()
    assert (out["median_month"], out["first_month"], out["last_month"], out["n_long"], out["mean_long"], out["thin"]) == ("2021-01", "2018-01", "2021-01", 1, 1.0, True)


def pairs(spark, rows):
    return spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], "id string, x double, y double, w double")


def test_calibration_recovers_a_line(spark):
    r = random.Random(1)
    rows = [(0.4 + 0.025 * i, -1.7 + 2.8 * (0.4 + 0.025 * i) + r.uniform(-0.05, 0.05), 1.0) for i in range(20)]
    out = cal.calibrate(pairs(spark, rows)).first()
    assert out["slope"] == pytest.approx(2.8, abs=0.25) and out["intercept"] == pytest.approx(-1.7, abs=0.2) and out["r2"] > 0.9


def test_calibration_needs_four_pairs_and_spread(spark):
    assert cal.calibrate(pairs(spark, [(0.1, 0.2, 1.0)] * 3)).count() == 0
    assert cal.calibrate(pairs(spark, [(0.1, 0.2 * i, 1.0) for i in range(6)])).count() == 0
    assert cal.calibrate(pairs(spark, [(0.1 * i, 0.2, 0.0) for i in range(6)])).count() == 0


def test_one_source_alone_gives_the_shrunk_mean(spark):
    df = spark.createDataFrame([("a", 6.0, 10.0, None), ("b", None, None, None)], "k string, score double, w double, x double")
    fit = "intercept double, slope double, residual_sd double"
    df = df.crossJoin(spark.createDataFrame([(0.1, 2.0, 0.2)], fit))
    has = F.col("w") > 0
    out = cal.combine(df, ["k"], F.when(has, F.col("score") / F.col("w")), F.when(has, cal.first_variance(F.col("w"))), cal.apply_line(F.col("x")) + F.lit(None), F.lit(None).cast("double")).collect()
    assert [(r["k"], r["v"], r["share"]) for r in out] == [("a", 0.5, 1.0)]
