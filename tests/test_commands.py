import gzip
import json

from gleaner.__main__ import main
from gleaner.operators import publish as pb
from gleaner.operators import evidence as ev
from gleaner.reports import percent


def test_from_shards_to_verdicts(spark, tmp_path, capsys):
    folder = tmp_path / "shards" / "comments" / "town"
    folder.mkdir(parents=True)
    rows = [{"id": f"i{k}", "body": f"The produce at Market Basket is fresh and cheap, well worth trip number {k}.", "created_utc": 1_600_000_000 + k, "author": f"u{k}", "link_id": "t3_x"} for k in range(6)]
    with gzip.open(folder / "2020-09.ndjson.gz", "wt") as f:
        f.write("\n".join(map(json.dumps, [*rows, {**rows[0], "id": "again"}])))
    at = lambda name: str(tmp_path / name)
    assert main(["select", at("shards"), at("candidates")]) == 0
    kept = spark.read.json(at("candidates"))
    assert kept.count() == 6 and kept.first()["permalink"].startswith("/r/town/comments/x/_/i")
    assert main(["extract", at("candidates"), at("run")]) == 0
    assert main(["aggregate", at("run/claims"), at("verdicts"), "--now", "1700000000"]) == 0
    totals = spark.read.parquet(at("verdicts/totals")).collect()
    assert [(r["store"], r["n_claims"]) for r in totals] == [("Market Basket", 6)] and totals[0]["sentiment"] > 0
    assert main(["report", at("verdicts")]) == 0 and "Market Basket" in capsys.readouterr().out
    assert main(["detail", at("run/claims"), "Market Basket", "--now", "1700000000"]) == 0
    told = capsys.readouterr().out
    assert "Market Basket" in told and "n=6" in told and "The produce at Market Basket" in told
    assert main(["site", at("run/claims"), at("site.json"), "--now", "1700000000"]) == 0
    document = json.loads((tmp_path / "site.json").read_text())
    assert document["totals"]["Market Basket"]["n"] == 6 and document["stores"]["Market Basket"] and document["keywords"]["milk"] == "dairy"
    assert main(["select", at("nowhere"), at("candidates")]) == 2
    assert main(["select", at("shards"), at("candidates"), "--limit", "0"]) == 1 and spark.read.json(at("candidates")).count() == 6


def test_evaluation_command(spark, tmp_path):
    gold = [
        {"id": "a", "text": "great fresh milk", "parent_body": "", "stores": ["Aldi"], "expected": [{"store": "Aldi", "category": "dairy", "sentiment": "positive", "price_signal": "none", "confidence": "high", "transient": False, "comparator_store": ""}]},
        {"id": "#parked", "text": "x", "parent_body": "", "stores": [], "expected": []}, {"id": "b", "text": "nothing", "parent_body": "", "stores": [], "expected": []},
    ]
    (tmp_path / "gold.jsonl").write_text("\n".join(map(json.dumps, gold)))
    assert main(["evaluate", str(tmp_path / "gold.jsonl"), str(tmp_path / "out"), "--least", "1.0"]) == 0
    row = spark.read.json(str(tmp_path / "out")).first()
    assert row["exact_match"] == 1.0 and row["silence"] == 1.0 and row["flag_accuracy"] == 1.0


def test_quotes_and_documents(spark):
    rows = [(i, "A", "meat", "", "", "positive", "cheap" if i else "none", float(i), f"c{i}", 1_600_000_000, "/r/x/1", "high", "town" if i == 3 else "") for i in range(5)]
    df = spark.createDataFrame(rows, "claim_row bigint, store string, category string, branch string, item_key string, sentiment string, price_signal string, w double, claim string, created_utc bigint, permalink string, confidence string, location string")
    quotes = pb.quotes(df, ["store", "category"], 2).first()["e"]
    assert [(q["t"], q["l"]) for q in quotes] == [("c4", None), ("c3", "town")]
    body = json.loads(pb.store_documents(pb.slim_cells(ev.chain_cells(ev.branch_cells(df)), ["store", "category"]), pb.quotes(df, ["store", "category"], 2)).first()["body"])
    assert body["meat"]["n"] == 5 and body["meat"]["p"] == "cheap" and body["meat"]["pd"] == {"cheap": 4} and "l" not in body["meat"]["e"][0]


def test_reviews_are_placed(spark, tmp_path):
    write = lambda name, rows: (tmp_path / name).write_text("\n".join(map(json.dumps, rows)))
    at = lambda name: str(tmp_path / name)
    write("reviews.json", [{"gmap_id": "g", "user_id": "u", "time": 1_600_000_000_000, "rating": 5, "text": "good " * 40}, {"gmap_id": "g", "time": 1, "text": "short"}])
    write("places.json", [{"gmap_id": "g", "store": "Aldi"}, {"gmap_id": "h", "store": None}])
    assert main(["reviews", at("reviews.json"), at("places.json"), at("candidates")]) == 0
    row = spark.read.json(at("candidates")).first()
    assert (row["stores"], row["kind"], row["created_utc"]) == (["Aldi"], "review", 1_600_000_000)
    claim = {"store": "Aldi", "category": "dairy", "claim": "c", "sentiment": "positive", "confidence": "high", "source_key": "r_1", "source_id": "1", "permalink": "", "created_utc": 1_600_000_000, "transient": False}
    write("claims.json", [claim, {**claim, "store": "Costco", "claim": "d"}])
    write("documents.json", [{"source_id": "1", "place": "g", "reviewed": "Aldi"}])
    write("branches.json", [{"place": "g", "branch": "somewhere"}])
    assert main(["place", at("claims.json"), at("documents.json"), at("branches.json"), at("placed")]) == 0
    assert sorted((r["store"], r["location"]) for r in spark.read.json(at("placed")).collect()) == [("Aldi", "somewhere"), ("Costco", "")]


def test_percent():
    assert (percent(None), percent(0.954)) == ("n/a", "95%")
