import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.config import Settings
from gleaner.functions import receipts as rc
from gleaner.operators import places as pl
from gleaner.operators import selection as sel
from gleaner.sources import jsonl, sinks, windows

GOOD = "The produce at Market Basket is fresh and cheap, well worth the trip across town."


def one(spark, expr, **cols):
    names = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in cols.items())
    return spark.createDataFrame([tuple(cols.values())], names).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text,stores",
    [
        ("stop and shop, STOP & SHOP or stop n shop", ["Stop & Shop"]), ("Trader Joe and market  basket", ["Market Basket", "Trader Joe's"]), ("the target of the strike", []),
        ("Target has cheap milk", ["Target"]), ("haymarket produce", ["Haymarket"]), ("bj's restaurant", []), ("BJs and H-Mart", ["H Mart", "BJ's"]), ("éshaws", []), ("", []),
        ("Market Basket", ["Market Basket"]),
    ],
)
def test_stores(spark, text, stores):
    assert one(spark, sel.matched_stores(F.col("t")), t=text) == stores


def test_pre_gate_never_loses_a_store(spark):
    r = random.Random(0)
    names = ["market basket", "trader joes", "star market", "whole food", "stop n shop", "shaws", "hmart", "wegmans", "aldi", "costco", "bjs", "haymarket", "rusos", "broadway marketplace", "daves fresh pasta", "formaggio", "cardullo", "reliable market", "ebisuya", "target"]
    rows = [(f"{'x' * r.randrange(3)} {n} y",) for n in names]
    out = spark.createDataFrame(rows, "t string").select(sel.may_mention(F.col("t")).alias("m"), F.size(pl.store_hits(F.col("t"))).alias("n")).collect()
    assert all(r["m"] for r in out) and all(r["n"] > 0 for r in out)


def test_excerpt_keeps_a_mention_in_view(spark):
    s = Settings(max_chars=60)
    text = "milk " * 30 + "at Market Basket " + "eggs " * 30
    body, cut = sel.excerpt(F.col("t"), F.array(F.lit("Market Basket")), s)
    row = spark.createDataFrame([(text,), ("short Market Basket",)], "t string").select(body.alias("b"), cut.alias("c")).collect()
    assert "Market Basket" in row[0]["b"] and len(row[0]["b"]) == 60 and row[0]["c"]
    assert row[1]["b"] == "short Market Basket" and not row[1]["c"]


def test_offsets_are_in_characters(spark):
    text = "😂İ Market Basket"
    assert one(spark, sel.first_mention(F.col("t"), F.array(F.lit("Market Basket"))), t=text) == 3


def docs(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i bigint, author string, text string, parent_body string")


def test_qualify(spark):
    rows = [
        ("u", GOOD, "ignored"), ("AutoModerator", GOOD, ""), ("u", "Market Basket", ""), ("u", "I walked past Market Basket on my way home from the office.", ""),
        ("u", "The produce there is at least less terrible than the other one.", "Everett Costco"), ("u", "The produce there is at least less terrible than the other one.", "Costco or Aldi"),
        ("u", "The parking is terrible, I was there for an hour on a Monday.", "Costco"), (None, GOOD, None),
    ]
    out = {r["i"]: (r["stores"], r["parent_body"]) for r in sel.qualify(docs(spark, rows)).collect()}
    assert out == {0: (["Market Basket"], ""), 4: (["Costco"], "Everett Costco"), 7: (["Market Basket"], "")}


def test_first_text_wins(spark):
    rows = [("u", GOOD, ""), ("u", GOOD + " Yes.", ""), *[("u", GOOD, "")] * 4]
    assert sorted(r["i"] for r in sel.select_candidates(docs(spark, rows), ["i"]).collect()) == [0, 1]
    assert [r["i"] for r in sel.select_candidates(docs(spark, rows), ["i"], limit=1).collect()] == [0]
    assert sel.select_candidates(docs(spark, []), ["i"]).count() == 0


def test_shards_and_parents(spark, tmp_path):
    folder = tmp_path / "comments" / "town"
    folder.mkdir(parents=True)
    lines = [
        json.dumps({"id": "b", "parent_id": "t1_a", "body": "reply", "created_utc": 1}), "{broken", json.dumps({"id": "a", "body": "old", "created_utc": 1}),
        json.dumps({"id": "a", "body": "new", "created_utc": 2}), json.dumps({"id": "c", "parent_id": "t3_a", "body": "top"}), json.dumps({"id": "d", "parent_id": "t1_zz", "body": "x"}),
    ]
    with gzip.open(folder / "2020-01.ndjson.gz", "wt") as f:
        f.write("\n".join(lines))
    with pytest.raises(FileNotFoundError):  # an unknown one is refused, not passed over
        jsonl.read_shards(spark, str(tmp_path), ["town", "elsewhere"])
    raw = jsonl.read_shards(spark, str(tmp_path), ["town"])
    out = {r["id"]: r["parent_body"] for r in sel.resolve_parents(raw).collect() if r["id"] != "a"}
    assert out == {"b": "new", "c": "", "d": ""}
    assert {(r["kind"], r["subreddit"], r["window"]) for r in raw.collect()} == {("comments", "town", "2020-01")}
    with pytest.raises(FileNotFoundError):
        jsonl.read_shards(spark, str(tmp_path), ["elsewhere"])


def test_place_of_a_review_claim(spark):
    claims = spark.createDataFrame([("d1", "A", "guess"), ("d1", "B", "guess"), ("d2", "A", "guess")], "source_id string, store string, location string").withColumn("gmap_id", F.lit(None).cast("string"))
    documents = spark.createDataFrame([("d1", "g1", "A")], "source_id string, place string, reviewed string")
    branches = spark.createDataFrame([("g1", "center")], "place string, branch string")
    out = {(r["source_id"], r["store"]): (r["location"], r["foreign"]) for r in sel.attach_place(claims, documents, branches).collect()}
    assert out == {("d1", "A"): ("center", False), ("d1", "B"): ("", True), ("d2", "A"): ("", True)}


@pytest.mark.parametrize(
    "line,item",
    [("GV WHL MLK GAL 3.28", "whole milk"), ("PB 2.99", "peanut butter"), ("ORG BAN 4011 1.20 lb @ 0.59/lb", "organic bananas"), ("WHL WHL MLK", "whole milk"), ("BUTTR 12OZ 4.99 F", "butter"), ("", "")],
)
def test_receipt_lines(spark, line, item):
    assert one(spark, rc.expand(F.col("t")), t=line) == item


def test_receipt_facts(spark):
    row = spark.createDataFrame([("2 @ 1.99 MLK $3,98", "TOTAL 9.99", "03/31/21", "Stop&Shop #12 receipt"), ("MLK", "MILK 2.00", "13/45/2021", "nothing")], "a string, b string, c string, d string").select(
        rc.price(F.col("a")).alias("p"), rc.quantity(F.col("a")).alias("q"), rc.is_noise(F.col("b")).alias("n"), rc.detect_date(F.col("c"), 1_640_000_000).alias("at"),
        rc.detect_store(F.col("d"), list(vocab.STORE_PATTERNS)).alias("s"), rc.match_term(F.lit("peanut butter jar"), ["butter", "peanut butter"]).alias("m"),
    ).collect()
    assert tuple(row[0]) == (3.98, 2, True, 1_617_148_800, "Stop & Shop", "peanut butter")
    assert tuple(row[1]) == (None, 1, False, None, None, "peanut butter")


def test_places(spark):
    rows = [("Shaw’s Pharmacy", "Shaw's"), ("Star Market and Wegmans", None), ("Corner Shop", None), ("Target", "Target")]
    got = spark.createDataFrame(rows, "n string, s string").select(pl.match_store(F.col("n")).alias("m"), "s").collect()
    assert all(r["m"] == r["s"] for r in got)
    at = spark.createDataFrame([("o1", "S", "Cambridge", "1 Main"), ("o2", "S", "Boston", "180 Cambridge Street"), ("o3", "S", "Boston", "5 Kilmarnock St"), ("o4", "S", None, None)], "osm string, store string, city string, address string")
    names = spark.createDataFrame([("S", "cambridge"), ("S", "kilmarnock"), ("S", "5 kilmarnock boston"), ("T", "boston"), ("S", "xy")], "store string, branch string")
    assert {r["osm"]: r["branch"] for r in pl.attach_branches(at, names).collect()} == {"o1": "cambridge", "o3": "5 kilmarnock boston"}


def test_elements(spark, tmp_path):
    doc = {"elements": [
        {"type": "node", "id": 1, "lat": 1.0, "lon": 2.0, "tags": {"name": "Aldi", "addr:street": "Main"}}, {"type": "node", "id": 1, "lat": 3.0, "lon": 2.0, "tags": {"name": "Aldi"}},
        {"type": "way", "id": 2, "center": {"lat": 5.0, "lon": 6.0}, "tags": {"name": "Costco", "addr:housenumber": "7", "addr:street": "Elm"}}, {"type": "node", "id": 3, "lat": 1.0, "lon": 1.0, "tags": {}},
    ]}
    (tmp_path / "m.json").write_text(json.dumps(doc))
    out = {r["osm"]: (r["lat"], r["address"]) for r in pl.places_from_elements(jsonl.read_elements(spark, str(tmp_path / "m.json"))).collect()}
    assert out == {"node/1": (3.0, ""), "way/2": (5.0, "7 Elm")}


def test_valid_rows_and_counts(spark, tmp_path):
    good = dict(store="A", category="meat", claim="c​x", sentiment="positive", confidence="high", source_key="k", permalink="/r/x/1", created_utc=1_600_000_000)
    bad = [{"created_utc": "1600000000"}, {"created_utc": True}, {"created_utc": 5}, {"score": "3"}, {"score": True}, {"transient": None}, {"location": 7}, {"claim": None}]
    lines = [json.dumps(good), "", "  ", "nonsense {", "[1]", json.dumps({**good, "score": None, "item": None}), *[json.dumps({**good, **b}) for b in bad]]
    (tmp_path / "c.jsonl").write_text("\n".join(lines))
    rows, dropped = jsonl.read_claims(spark, str(tmp_path / "c.jsonl"))
    assert rows.count() == 2 and dropped.first()[0] == len(bad) + 2


def test_publish_keeps_the_old_over_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, 0.5, "/r/x/1")], "i bigint, v double, u string")
    sinks.publish(df, path, links="u", check=True)
    with pytest.raises(sinks.EmptyResultError):
        sinks.publish(df.limit(0), path)
    with pytest.raises(ValueError):
        sinks.publish(df.withColumn("v", F.lit(float("nan"))), path, check=True)
    with pytest.raises(ValueError):
        sinks.publish(df.withColumn("u", F.lit("javascript:x")), path, links="u", check=True)
    assert spark.read.parquet(path).count() == 1
    sinks.publish(df.unionByName(df), path)
    assert spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


DATA = [{"id": f"r{i}", "created_utc": 1_577_836_800 + (i // 3) * 40_000, "body": "x"} for i in range(900)]


def fetch(after, limit):
    return [r for r in DATA if r["created_utc"] > after][:limit]


def test_paged_source(spark, monkeypatch):
    monkeypatch.syspath_prepend(str(__import__("pathlib").Path(__file__).parent))
    reader = windows.PagedReader({"client": "test_selection:fetch", "start": "1577836800", "end": str(DATA[-1]["created_utc"])})
    got = [row for p in reader.partitions() for row in reader.read(p)]
    assert len(got) == len(DATA) and {r[0] for r in got} == {r["id"] for r in DATA}
    spark.dataSource.register(windows.PagedSource)
    months = windows.month_windows(spark, 1_577_836_800, 1_583_020_799).collect()
    assert [m["label"] for m in months] == ["2020-01", "2020-02"] and months[1]["last"] == 1_583_020_799


def test_paged_source_marks_gaps(spark, monkeypatch):
    at = 1_577_836_800
    crowd = [{"id": f"g{i}", "created_utc": at + (0 if i < 30 else 5 if i < 180 else 9), "body": ""} for i in range(200)]
    monkeypatch.setattr(windows.importlib, "import_module", lambda _: type("M", (), {"fetch": staticmethod(lambda after, n: [r for r in crowd if r["created_utc"] > after][:n])}))
    reader = windows.PagedReader({"client": "m:fetch", "start": str(at), "end": str(at + 10)})
    got = [row for p in reader.partitions() for row in reader.read(p)]
    assert {r[1] for r in got if r[4]} == {at + 5} and len(got) < len(crowd)
    rows = spark.createDataFrame(got, windows.PagedSource({}).schema())
    assert [tuple(r) for r in windows.gap_counts(rows).collect()] == [("2020-01", 1)]
