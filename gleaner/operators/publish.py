"""Verdicts as a page reads them: slim cells with short quotes, nested only where they are written."""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator, Mapping
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.config import Settings
from gleaner.functions.scoring import month
from gleaner.operators import evidence as ev
from gleaner.runtime import file_system, last_line, read_pieces, read_text, scratch_path, write_text, write_whole

#: Field names that ratings and second-source blocks must not have: texts and persons.
BANNED = {"reviews": ("t", "claim", "evidence", "permalink", "user_id", "name"), "crosscheck": ("text", "user_id", "author")}
#: What a document must have: mappings, lists, texts.
STRUCTURE = {dict: ("stores", "branches", "regions", "items", "totals", "keywords", "method"), list: ("places", "categories"), str: ("generated_at",)}
QUOTED = ("stores", "branches", "regions", "items")
#: The sections of cells, and how many names lead to a cell.
DEPTH = {"stores": 2, "branches": 3, "regions": 3, "items": 2, "totals": 1}


class PublishingError(ValueError):
    """The document breaks a rule of what may be published."""


def quotes(weighed: DataFrame, keys: list[str], n: int) -> DataFrame:
    """keys and e: the n heaviest claims as (t, d, u, c, l); only these are collected, so a group's size does not matter."""
    top = ev.top_evidence(weighed, keys, n)
    quote = F.struct(
        F.col("place"), F.col("claim").alias("t"), month(F.col("created_utc")).alias("d"), F.col("permalink").alias("u"), F.col("confidence").alias("c"),
        F.nullif(F.col("location"), F.lit("")).alias("l"),
    )
    grouped = top.groupBy(*keys).agg(F.array_sort(F.collect_list(quote)).alias("q"))
    return grouped.select(*keys, F.transform("q", lambda x: x.dropFields("place")).alias("e"))


def slim_cells(cells: DataFrame, keys: list[str], s: Settings = Settings()) -> DataFrame:
    """keys, n, w, s, p, pl, pd: p and pl are absent (null) without a price label, pd without any price."""
    v = ev.view(cells, s)
    counts = [F.struct(F.lit(p).alias("k"), F.col(f"n_{p}").alias("v")) for p in vocab.PRICE_SCORE]
    spread = F.map_from_entries(F.filter(F.array(*counts), lambda x: x["v"] > 0))
    return v.select(
        *keys, F.col("n_claims").alias("n"), F.round("weighted_evidence", 1).alias("w"), F.round("sentiment", 3).alias("s"), F.col("price_signal").alias("p"),
        F.round("price_level", 3).alias("pl"), F.when(F.size(spread) > 0, spread).alias("pd"),
    )


def store_documents(cells: DataFrame, quoted: DataFrame) -> DataFrame:
    """store and body: one JSON text for each store with its categories' cells; absent measures have no key. A store has
    at most as many cells as there are categories."""
    each = cells.join(quoted, ["store", "category"], "left")
    cell = F.struct(*[F.col(c) for c in each.columns if c not in ("store", "category")])
    return each.groupBy("store").agg(F.map_from_entries(F.collect_list(F.struct("category", cell.alias("cell")))).alias("m")).select("store", F.to_json("m").alias("body"))


def totals_section(totals: DataFrame, s: Settings = Settings()) -> DataFrame:
    """store, n, w, s, thin: the published totals."""
    weight = F.col("weighted_evidence")
    return totals.select("store", F.col("n_claims").alias("n"), F.round(weight, 1).alias("w"), F.round("sentiment", 3).alias("s"), (weight < s.min_weight).alias("thin"))


def published_places(places: DataFrame, cells: DataFrame) -> DataFrame:
    """Pins of stores that have published cells."""
    return places.join(cells.select("store").distinct(), "store", "left_semi")


def placement(claims: DataFrame) -> DataFrame:
    """Of claims placed by attach_place: how many have a branch, are about another store, and the part placed."""
    placed = F.count_if(~F.col("foreign") & (F.col("location") != ""))
    return claims.agg(F.count(F.lit(1)).alias("n"), placed.alias("placed"), F.count_if("foreign").alias("foreign")).withColumn("part", F.round(F.try_divide("placed", "n"), 4))


def section(name: str, rows: DataFrame, path: list[str], body: list[str]) -> DataFrame:
    """Rows of a published section: section, path (under which names the body stands), body (JSON; null fields have no key)."""
    return rows.select(F.lit(name).alias("section"), F.array(*path).alias("path"), F.to_json(F.struct(*body)).alias("body"))


def verdict_sections(weighed: DataFrame, s: Settings = Settings(), quotes_chain: int = 3, quotes_other: int = 2) -> DataFrame:
    """The sections stores, branches, regions, items and totals of weighed claims: cells with enough evidence, each with its
    heaviest quotes. A row is one cell, so no row grows with a store."""
    cells = ev.branch_cells(weighed)
    chains, items = ev.chain_cells(cells), ev.item_cells(weighed)
    body = ["n", "w", "s", "p", "pl", "pd", "e"]

    def with_quotes(table: DataFrame, keys: list[str], n: int) -> DataFrame:
        return slim_cells(ev.above_floor(table, s), keys, s).join(quotes(weighed, keys, n), keys)

    named = with_quotes(cells.where("branch <> ''"), ["store", "branch", "category"], quotes_other)
    kept = items.where(F.round("weight", 2) >= s.min_item_weight)
    totals = totals_section(ev.view(ev.store_totals(chains), s), s)
    parts = [
        section("stores", with_quotes(chains, ["store", "category"], quotes_chain), ["store", "category"], body),
        section("branches", named.where(ev.is_branch(F.col("branch"))), ["store", "branch", "category"], body),
        section("regions", named.where(~ev.is_branch(F.col("branch"))), ["store", "branch", "category"], body),
        section("items", with_quotes(kept, ["store", "item_key"], quotes_other), ["store", "item_key"], body),
        section("totals", totals, ["store"], ["n", "w", "s", "thin"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def _entries(node: Any) -> Iterator[Mapping[str, Any]]:
    """Every mapping at any depth."""
    if isinstance(node, dict):
        yield node
    for value in node.values() if isinstance(node, dict) else node if isinstance(node, list) else ():
        yield from _entries(value)


def assert_document(document: Mapping[str, Any]) -> None:
    """The document has its parts; blocks made of reviews and ratings hold no texts and no persons; a cross-check names its
    source; every quote has a public link."""
    for kind, names in STRUCTURE.items():
        missing = [n for n in names if not isinstance(document.get(n), kind)]
        if missing:
            raise PublishingError(f"the document lacks {missing}")
    for block, banned in BANNED.items():
        found = {k for entry in _entries(document.get(block)) for k in entry} & set(banned)
        if found:
            raise PublishingError(f"{block} must not hold {sorted(found)}")
    cross = document.get("crosscheck")
    if cross is not None and not str(cross.get("citation", "")).strip():
        raise PublishingError("the cross-check must name its source")
    for view in QUOTED:
        _assert_quotes(view, document[view])


def _assert_quotes(view: str, node: Any) -> None:
    for entry in _entries(node):
        quoted = entry.get("e")
        for quote in quoted if isinstance(quoted, list) else ():
            if not str(quote.get("u", "")).startswith("/r/"):
                raise PublishingError(f"{view}: a quote without a public link")


def build_document(sections: DataFrame, head: Mapping[str, Any], most_bytes: int = 64 << 20) -> dict[str, Any]:
    """One nested document of sections (section, path, body) and further top-level parts, held by the driver; its size is looked
    at before any row comes there, and above most_bytes it is an error. write_sections takes any size."""
    size = sections.agg(F.sum(F.octet_length("body") + F.octet_length(F.array_join("path", ""))).alias("n")).first()["n"] or 0
    if size > most_bytes:
        raise PublishingError(f"{size} bytes; a document has up to {most_bytes}")
    document: dict[str, Any] = {name: {} for name in (*QUOTED, "totals")} | dict(head)
    for row in sections.orderBy("section", "path").toLocalIterator():
        node = document.setdefault(row["section"], {})
        for name in row["path"][:-1]:
            node = node.setdefault(name, {})
        node[row["path"][-1]] = json.loads(row["body"])
    document.setdefault("categories", sorted({c for cells in document["stores"].values() for c in cells}))
    return document


def write_document(spark: SparkSession, document: Mapping[str, Any], path: str) -> int:
    """Write the document, if it may be published, as one compact file; returns its bytes. Numbers that JSON lacks are an error."""
    assert_document(document)
    text = _dumps(document)
    write_text(spark, path, text)
    return len(text.encode())


def _dumps(value: Any) -> str:
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _between(before: list[Any], after: list[Any]) -> str:
    """What stands between two entries in order: mappings that end are closed, those that begin are opened."""
    same = next((i for i, (a, b) in enumerate(zip(before, after, strict=False)) if a != b), None)
    if same is None:
        raise PublishingError(f"{after} stands twice, or in another entry")
    return "}" * (len(before) - 1 - same) + "," + "".join(f"{_dumps(name)}:{{" for name in after[same:-1])


def _entry_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A line for each entry of a sorted partition, with what stands between it and the one before; a last line on the partition,
    or on the rule that it breaks."""
    about: dict[str, Any] = {}
    seen: set[str] = set()
    categories: set[str] = set()
    try:
        for batch in batches:
            lines = []
            for view, path, body in zip(batch["section"], batch["path"], batch["body"], strict=True):
                names = [view, *path]
                if len(names) != DEPTH.get(view, -1) + 1:
                    raise PublishingError(f"{names} is no entry of a section")
                entry = {names[-1]: json.loads(body)}
                if view in QUOTED:
                    _assert_quotes(view, entry)
                lines.append((_between(about["last"], names) if about else "") + _dumps(entry)[1:-1])
                about = {"first": about.get("first", names), "last": names}
                seen.add(view)
                if view == "stores":
                    categories.add(names[2])
            yield pd.DataFrame({"value": lines}, dtype="object")
        about = about and about | {"sections": sorted(seen), "categories": sorted(categories)}
    except ValueError as e:
        about = {"error": str(e)}
    if about:
        yield pd.DataFrame({"value": [_dumps(about)]})


def write_sections(spark: SparkSession, sections: DataFrame, head: Mapping[str, Any], path: str) -> int:
    """Write the document of sections (section, path, body) and further top-level parts, if it may be published, as one file;
    returns its bytes. The entries are checked and written in order by the executors; the driver sees a line for each partition
    and has the JVM copy their files, so any size will do."""
    if clash := sorted(set(head) & set(DEPTH)):
        raise PublishingError(f"{clash} are made of sections")
    folder = scratch_path(spark, "entries")
    fs, at = file_system(spark, folder)
    lines = sections.select("section", "path", "body").sort("section", "path").mapInPandas(_entry_lines, "value string")
    lines.write.options(compression="none", lineSep="\n", maxRecordsPerFile=0).text(folder)
    try:
        files = sorted((int(f.getPath().getName().split("-")[1]), f.getPath().toString()) for f in fs.listStatus(at) if f.getPath().getName().startswith("part-"))
        parts = [(file, n, json.loads(text)) for _, file in files for text, n in last_line(spark, file)]
        for _, _, about in parts:
            if "error" in about:
                raise PublishingError(about["error"])
        seen = {name for _, _, about in parts for name in about["sections"]}
        top = {"categories": sorted({c for _, _, about in parts for c in about["categories"]})} | dict(head)
        assert_document({name: {} for name in DEPTH} | top)
        pieces: list[str | tuple[str, int]] = [_dumps({name: {} for name in DEPTH if name not in seen} | top)[:-1]]
        before: list[Any] = [None]
        for file, n, about in parts:
            pieces += [_between(before, about["first"]), (file, n)]
            before = about["last"]
        return write_whole(spark, path, [*pieces, "}" * len(before)])
    finally:
        fs.delete(at, True)


class _Pieces:
    """Values of a JSON text that comes in pieces; what was read is let go."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.decode, self.scan = pieces, codecs.getincrementaldecoder("utf-8")().decode, json.JSONDecoder().raw_decode
        self.text, self.at, self.over = "", 0, False

    def more(self) -> None:
        """As much again as is held, so that a long value is tried few times only."""
        held, got = len(self.text) - self.at, 0
        new = [self.text[self.at :]]
        while not self.over and (got == 0 or got < held):
            piece = next(self.pieces, None)
            self.over = piece is None
            new.append(self.decode(piece or b"", final=self.over))
            got += len(new[-1])
        self.text, self.at = "".join(new), 0

    def sign(self) -> str:
        """The next character that is no space, '' at the end; it is not taken."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in " \t\r\n":
                self.at += 1
            if self.at < len(self.text) or self.over:
                return self.text[self.at : self.at + 1]
            self.more()

    def take(self, signs: str) -> str:
        found = self.sign()
        if not found or found not in signs:
            raise PublishingError(f"no document: {found or 'its end'} in place of {' or '.join(signs)}")
        self.at += 1
        return found

    def value(self) -> Any:
        self.sign()
        while True:
            try:
                value, end = self.scan(self.text, self.at)
                if end + 2 < len(self.text) or self.over:  # else a number may go on, as 1 of 1e-5
                    self.at = end
                    return value
            except json.JSONDecodeError as e:
                if self.over:
                    raise PublishingError(f"no document: {e}") from e
            self.more()

    def entries(self, names: list[str], depth: Mapping[str, int] | int) -> Iterator[tuple[list[str], Any]]:
        """Names and value of what stands below a mapping, its names having that depth."""
        self.take("{")
        if self.sign() == "}":
            self.take("}")
            return
        while True:
            if not isinstance(name := self.value(), str):
                raise PublishingError(f"no document: {name} in place of a name")
            self.take(":")
            below = depth.get(name, 0) if isinstance(depth, Mapping) else depth - 1
            if below:
                yield [*names, name], None
                yield from self.entries([*names, name], below)
            else:
                yield [*names, name], self.value()
            if self.take(",}") == "}":
                return


def read_entries(spark: SparkSession, path: str) -> Iterator[tuple[list[str], Any]]:
    """The parts of a published document one after the other, of any size: names and value of each cell of a section and of each
    further part; a mapping on the way to cells comes first, without value. What read_document asks of a document is asked of each
    part as it passes, and of the whole at the end."""
    pieces = _Pieces(read_pieces(spark, path))
    top: dict[str, Any] = {}
    for names, value in pieces.entries([], DEPTH):
        if names[0] in DEPTH:
            top[names[0]] = {}
            if names[0] in QUOTED and len(names) > DEPTH[names[0]]:
                _assert_quotes(names[0], {names[-1]: value})
        else:
            top[names[0]] = value
        yield names, value
    if pieces.sign():
        raise PublishingError("no document: it goes on after its end")
    assert_document(top)


def read_document(spark: SparkSession, path: str) -> dict[str, Any]:
    """A published document, if it has the parts it must have."""
    document = json.loads(read_text(spark, path))
    if not isinstance(document, dict):
        raise PublishingError("no document")
    assert_document(document)
    return document
