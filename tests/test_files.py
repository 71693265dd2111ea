import json

import pytest

from gleaner.sources import jsonl, sinks


def test_one_writer_at_a_time(spark, tmp_path):
    with sinks.single_writer(spark, str(tmp_path / "run")):
        with pytest.raises(sinks.LockedError):
            with sinks.single_writer(spark, str(tmp_path / "run")):
                pass
    with sinks.single_writer(spark, str(tmp_path / "run")):
        pass


def test_a_failed_move_leaves_the_old_result(spark, tmp_path):
    sinks.publish(spark.range(3), str(tmp_path / "t"))
    with pytest.raises(OSError):
        sinks._move(spark, str(tmp_path / "missing"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    with pytest.raises(sinks.EmptyResultError):
        sinks.publish(spark.range(0), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_windows_and_ledgers(spark, tmp_path):
    at = str(tmp_path / "w")
    for month, ids in (("2020-01", 3), ("2020-02", 2), ("2020-02", 5)):
        sinks.publish_window(spark.range(ids).selectExpr("id", f"'{month}' AS month"), at, "month")
    assert {r["month"]: r["count"] for r in spark.read.parquet(at).groupBy("month").count().collect()} == {"2020-01": 3, "2020-02": 5}
    (tmp_path / "done").write_text("a\n b \n\na\n")
    assert {r["key"] for r in jsonl.read_done(spark, str(tmp_path / "done")).collect()} == {"a", "b"}
    assert jsonl.read_done(spark, str(tmp_path / "none")).count() == 0 and jsonl.optional(spark, None, "a int").count() == 0
    sinks.manifest(spark, str(tmp_path / "m"), rows=3)
    assert spark.read.json(str(tmp_path / "m")).first()["rows"] == "3"
    assert sinks.corpus_tag("a") != sinks.corpus_tag("b") and [r["id"] for r in sinks.keep_last(spark.range(9), "id", 2).collect()] == [8, 7]


def test_readers(spark, tmp_path):
    rows = [{"store": "A", "gmap_id": "g", "rating": 5, "time": 1, "user_id": "u", "text": " \u00a0great "}, {"store": "A", "gmap_id": None, "rating": 1, "time": 1}, {"store": "B", "gmap_id": "h", "rating": None, "time": 2, "text": "x"}]
    (tmp_path / "r.json").write_text("\n".join(map(json.dumps, rows)))
    assert [r["text_len"] for r in jsonl.read_reviews(spark, str(tmp_path / "r.json")).collect()] == [5, 0]
    assert sorted((r["gmap_id"], r["text"]) for r in jsonl.read_review_texts(spark, str(tmp_path / "r.json")).collect()) == [("g", " \u00a0great "), ("h", "x")]
    (tmp_path / "d.json").write_text(json.dumps({"places": [{"osm": "n/1"}], "attribution": "x"}, indent=1))
    row = jsonl.read_document(spark, str(tmp_path / "d.json"), "places array<struct<osm:string>>, attribution string, other int").first()
    assert (row["places"][0]["osm"], row["attribution"], row["other"]) == ("n/1", "x", None)
    kept = [json.dumps([{"at": 1, "store": "A", "lines": [{"name": "milk", "qty": 2, "price": 1.5}]}, {"at": 2}]), "{}", "no json", None, "[]"]
    history = jsonl.read_history(spark.createDataFrame([(x,) for x in kept], "t string"), "t")
    assert [tuple(r) for r in history.collect()] == [(1, "A", "milk", 2, 1.5)]
    with pytest.raises(FileNotFoundError):
        jsonl.read_shards(spark, str(tmp_path), ["unknown"])
