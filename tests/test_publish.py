import copy
import json

import pytest
from pyspark.sql import functions as F

from gleaner.operators import publish as pb

DOCUMENT = {
    "generated_at": "2026-01-01", "method": {}, "places": [], "categories": ["meat"], "keywords": {}, "totals": {"A": {"n": 1}}, "branches": {}, "regions": {}, "items": {},
    "stores": {"A": {"meat": {"n": 1, "e": [{"t": "fine", "u": "/r/x/1"}]}}}, "crosscheck": {"citation": "a source", "stores": {"A": {"norm": 0.1}}}, "reviews": {"stores": {"A": {"v": 0.1}}},
}


def changed(path, value):
    out = copy.deepcopy(DOCUMENT)
    node = out
    for p in path[:-1]:
        node = node[p]
    node[path[-1]] = value
    return out


@pytest.mark.parametrize(
    "path,value",
    [(["reviews", "stores", "A", "t"], "text"), (["reviews", "x"], [{"permalink": 1}]), (["crosscheck", "stores", "A", "author"], "u"), (["crosscheck", "citation"], " "),
     (["stores", "A", "meat", "e"], [{"t": "x", "u": "https://maps.example/1"}]), (["stores"], None), (["places"], {}), (["generated_at"], 5)],
)
def test_what_must_not_be_published(path, value):
    pb.assert_document(DOCUMENT)
    with pytest.raises(pb.PublishingError):
        pb.assert_document(changed(path, value))


def test_a_document_is_written_whole_or_not_at_all(spark, tmp_path):
    at = str(tmp_path / "d.json")
    assert pb.write_document(spark, DOCUMENT, at) == (tmp_path / "d.json").stat().st_size
    assert pb.read_document(spark, at) == DOCUMENT
    for bad in (changed(["totals", "A", "n"], float("nan")), changed(["crosscheck", "citation"], "")):
        with pytest.raises(ValueError):
            pb.write_document(spark, bad, at)
    assert pb.read_document(spark, at) == DOCUMENT
    (tmp_path / ".d.json.crc").unlink(missing_ok=True)
    (tmp_path / "d.json").write_text("[1]")
    with pytest.raises(pb.PublishingError):
        pb.read_document(spark, at)


def test_sections_nest_and_their_size_is_looked_at(spark):
    rows = spark.createDataFrame([("stores", ["A", "meat"], '{"n":1}'), ("stores", ["A", "dairy"], '{"n":2}'), ("totals", ["A"], '{"n":3}')], "section string, path array<string>, body string")
    out = pb.build_document(rows, {"generated_at": "x"})
    assert out["stores"] == {"A": {"meat": {"n": 1}, "dairy": {"n": 2}}} and out["totals"] == {"A": {"n": 3}} and out["categories"] == ["dairy", "meat"] and out["items"] == {}
    with pytest.raises(pb.PublishingError):
        pb.build_document(rows, {}, most_bytes=10)


SECTION = "section string, path array<string>, body string"
HEAD = {"generated_at": "é", "method": {"k": 1.5e-7}, "places": [{"at": -12}], "keywords": {"milk": "dairy"}}


def entries(n):
    """n stores, each with cells of all sections; names hold what JSON escapes, and braces."""
    quote = lambda i: json.dumps({"n": i, "s": 1.25e-05, "e": [{"t": 'a "}{" \n\u2028 é', "u": f"/r/x/{i}"}]})
    for i in range(n):
        store = f'A"{{{i},\n'
        yield from (("stores", [store, c], quote(i)) for c in ("meat", "dairy"))
        yield from (("branches", [store, b, c], quote(i)) for b in ("", "}", "east") for c in ("meat", "dairy", "\\"))
        yield ("items", [store, "milk"], quote(i))
        yield ("totals", [store], '{"n":3}')


@pytest.mark.parametrize("n", [0, 1, 200])
def test_sections_are_written_and_read_piece_by_piece(spark, tmp_path, monkeypatch, n):
    rows = spark.createDataFrame(list(entries(n)), SECTION).repartition(7)
    at = str(tmp_path / "d.json")
    assert pb.write_sections(spark, rows, HEAD, at) == (tmp_path / "d.json").stat().st_size
    document = pb.build_document(rows, HEAD)
    assert pb.read_document(spark, at) == document == json.loads((tmp_path / "d.json").read_text())
    # no name twice, as json would take the last one
    json.loads((tmp_path / "d.json").read_text(), object_pairs_hook=lambda pairs: dict(pairs) if len(dict(pairs)) == len(pairs) else pytest.fail(str(pairs)))
    for size in (1, 1 << 20) if n < 2 else (1000, 1 << 20):
        monkeypatch.setattr(pb, "read_pieces", lambda s, p, size=size: iter([b[i : i + size] for b in [(tmp_path / "d.json").read_bytes()] for i in range(0, len(b), size)]))
        out = {}
        for names, value in pb.read_entries(spark, at):
            node = out
            for name in names[:-1]:
                node = node[name]
            node[names[-1]] = value if names[0] not in pb.DEPTH or len(names) > pb.DEPTH[names[0]] else {}
        assert out == document


def test_a_document_larger_than_the_driver_holds_is_written_whole(spark, tmp_path):
    """Some 80 MB, which was an error; read a megabyte at a time."""
    body = F.concat(F.lit('{"e":[{"u":"/r/x","t":"'), F.repeat(F.lit("x"), 4000), F.lit('"}]}'))
    rows = spark.range(20_000).select(F.lit("items").alias("section"), F.array(F.concat(F.lit("s"), F.col("id") % 3), F.col("id").cast("string")).alias("path"), body.alias("body"))
    with pytest.raises(pb.PublishingError):
        pb.build_document(rows, HEAD)
    at = str(tmp_path / "d.json")
    assert pb.write_sections(spark, rows, HEAD, at) > 64 << 20
    names = [tuple(names) for names, _ in pb.read_entries(spark, at) if names[0] == "items"]
    assert len([x for x in names if len(x) == 2]) == 3 and len(set(names)) == 20_004


@pytest.mark.parametrize(
    "row,head",
    [(("stores", ["A", "meat"], '{"e":[{"t":"x","u":"https://maps.example/1"}]}'), {}), (("stores", ["A", "dairy"], '{"n":NaN}'), {}), (("stores", ["B", "meat"], '{"n":1}'), {}), (("stores", ["A"], '{"n":1}'), {}),
     (("other", ["A"], '{"n":1}'), {}), (("totals", ["A"], '{"n":1}'), {"stores": {}}), (("totals", ["A"], '{"n":1}'), {"places": None}), (("totals", ["A"], '{"n":1}'), {"reviews": {"t": "text"}})],
)
def test_sections_that_must_not_be_published_leave_the_old_file(spark, tmp_path, row, head):
    at = str(tmp_path / "d.json")
    good = spark.createDataFrame([("stores", ["B", "meat"], '{"n":1}')], SECTION)
    pb.write_sections(spark, good, HEAD, at)
    before = pb.read_document(spark, at)
    with pytest.raises(pb.PublishingError):
        pb.write_sections(spark, good.union(spark.createDataFrame([row], SECTION)), HEAD | head, at)
    assert pb.read_document(spark, at) == before


@pytest.mark.parametrize("change", [lambda t: t[:-1], lambda t: t + "1", lambda t: t.replace('"places"', '"other"'), lambda t: t.replace("/r/x/1", "http://x"), lambda t: "[1]", lambda t: "", lambda t: t.replace('"totals":{', '"totals":3,"x":{')])
def test_what_is_no_document_is_not_read_as_one(spark, tmp_path, change):
    (tmp_path / "d.json").write_text(change(json.dumps(DOCUMENT, separators=(",", ":"))))
    with pytest.raises(pb.PublishingError):
        list(pb.read_entries(spark, str(tmp_path / "d.json")))
