"""Keyword-stuffed and link-list pages.

A page is judged by its redundancy: how far the blocks of its text compress, in parts of what is usual for texts of their
length and language. It is measured twice: on the text, which repeated keywords and phrases make redundant, and on the
text's shape, in which longer words and links are one symbol each and short words, digits and marks stay. The shape of
prose keeps its small words and so varies; that of a list of links, tags or different keywords hardly does. Extreme
redundancy of either flags a page; a low density of sentence punctuation confirms it, sentences said again not counted.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from math import log

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.runtime import materialise


@dataclass(frozen=True)
class SpamSettings:
    """block: bytes compressed at once. text_limit, shape_limit: the highest redundancy of text or shape that is extreme, as
    compressed size in parts of the usual one. density: most sentence ends, in parts of what is usual in the language.
    short: letters of the words that stay in the shape, up to 8. least_chars: texts below are tiny. languages, words: how many
    languages (the most frequent labels) have a profile, and of how many short words. few: documents that a language
    needs for norms of its own; below, and where a text's words don't tell its language, those of its script hold."""

    block: int = 4096
    text_limit: float = 0.6
    shape_limit: float = 0.72
    density: float = 0.55
    short: int = 3
    least_chars: int = 60
    languages: int = 100
    words: int = 100
    few: int = 50


#: Labels that name no language.
NO_LANGUAGE = ("und", "mul", "zxx", "mis")
_CHARACTER = "぀-ヿ㐀-鿿가-힯"
_SIGN = re.compile(f"[{_CHARACTER}]")
_GAP = re.compile(f"[\\s{_CHARACTER}]|\\Z")
_LINK = re.compile(r"[^\W\d_][./:?=&_@\\]+[^\W\d_]")
_LONG = {n: re.compile(rf"[^\W\d_{_CHARACTER}]{{{n + 1},}}") for n in range(1, 9)}
_END = re.compile(r"[.!?…][\"')”’]*(?:\s|$)|[。！？]")
WORD, LINK = "\x01", "\x02"


def block_ratio(text: str, size: int, block: int) -> float:
    """Compressed bytes of the text's blocks, each compressed by itself, in parts of size."""
    raw, total = text.encode("utf-8", "replace"), 0
    for i in range(0, len(raw), block):
        c = zlib.compressobj(9, zlib.DEFLATED, -15)
        total += len(c.compress(raw[i : i + block])) + len(c.flush())
    return total / size


def shape(text: str, signs: frozenset[str] = frozenset(), short: int = 3) -> str:
    """The text in lower case with links and longer words as one symbol each. Of writing without spaces between words the
    signs given (the frequent ones) stay."""
    parts, at = [], 0
    for m in _LINK.finditer(text):
        if m.start() < at:
            continue
        # the whole run without spaces around the mark
        begin = m.start()
        while begin > at and not text[begin - 1].isspace() and not _SIGN.match(text[begin - 1]):
            begin -= 1
        parts += [text[at:begin], LINK]
        at = _GAP.search(text, m.end()).start()
    if parts:
        text = "".join([*parts, text[at:]])
    out = _LONG[short].sub(WORD, text).lower()
    return out if out.isascii() else _SIGN.sub(lambda m: m.group() if m.group() in signs else WORD, out)


def script_of(text: str) -> str:
    if text.isascii():
        return "latin"
    signs, other = len(_SIGN.findall(text)), len(re.findall(r"[Ͱ-῿]", text))
    return "signs" if signs * 4 > len(text) else "other" if other * 3 > len(text) else "latin"


def size_class(n: int, block: int) -> int:
    """Two classes for each doubling of the (first) block's length."""
    n = min(n, block)
    bits = n.bit_length()
    return bits * 2 + (n >> max(0, bits - 2) & 1)


def short_words(text: str, short: int = 3) -> set[str]:
    """The different short words of a text that stand alone, and its signs."""
    words = {w for w in set(text.lower().split()) if len(w) <= short and w.isalpha()}
    return words if text.isascii() else {w for w in words if not _SIGN.match(w)} | set(_SIGN.findall(text))


def sentence_ends(text: str) -> tuple[int, int]:
    """(sentence ends, those of different sentences)."""
    parts = _END.split(text)
    return len(parts) - 1, min(len(parts) - 1, len({s for s in (x.strip().lower() for x in parts) if s}))


class Languages:
    """Tells a text's language by its short words. profiles: for each language the share of its texts with each word."""

    def __init__(self, profiles: Mapping[str, Mapping[str, float]]) -> None:
        self.weights: dict[str, dict[str, float]] = {}
        for language, words in profiles.items():
            for w, share in words.items():
                # over a word that the language does not have
                self.weights.setdefault(w, {})[language] = log(share + 1e-3) - log(1e-3)

    def tell(self, words: set[str]) -> str | None:
        """None where fewer than three words are known."""
        known = [self.weights[w] for w in words if w in self.weights]
        if len(known) < 3:
            return None
        score: dict[str, float] = {}
        for weights in known:
            for language, weight in weights.items():
                score[language] = score.get(language, 0.0) + weight
        return max(sorted(score), key=score.__getitem__)


def profiles(documents: DataFrame, settings: SpamSettings = SpamSettings()) -> tuple[dict[str, dict[str, float]], frozenset[str]]:
    """Short-word profiles by language label, counted over all documents, and the most frequent signs.

    Labels are often wrong, but mostly right; texts are judged by their words only. At most `languages` labels with `words`
    words each come to the driver.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter[tuple[str, str]] = Counter()
            for label, text in zip(batch["label"], batch["text"], strict=True):
                if text is not None and len(text) >= settings.least_chars:
                    found[label, ""] += 1
                    found.update((label, w) for w in short_words(text, settings.short))
            yield pd.DataFrame([(a, w, n) for (a, w), n in found.items()], columns=["label", "word", "n"], dtype=object)

    label = F.regexp_extract(F.lower(F.trim(F.coalesce("lang", F.lit("")))), "^([a-z]{2,3})(?:[-_].*)?$", 1)
    rows = documents.select(label.alias("label"), "text").mapInPandas(count, "label string, word string, n bigint")
    counts = materialise(rows.groupBy("label", "word").agg(F.sum("n").alias("n")), "words")
    labels = counts.where((F.col("word") == "") & (F.col("label") != "") & ~F.col("label").isin(*NO_LANGUAGE)).orderBy(F.desc("n"), "label").limit(settings.languages)
    labels = labels.where(F.col("n") >= settings.few).select("label", F.col("n").alias("texts"))
    best = Window.partitionBy("label").orderBy(F.desc("n"), "word")
    top = counts.where("word <> ''").join(F.broadcast(labels), "label").withColumn("place", F.row_number().over(best)).where(F.col("place") <= settings.words)
    out: dict[str, dict[str, float]] = {}
    for r in top.select("label", "word", (F.col("n") / F.col("texts")).alias("share")).collect():
        out.setdefault(r["label"], {})[r["word"]] = r["share"]
    signs = counts.where(F.col("word").rlike(f"^[{_CHARACTER}]$")).groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(settings.words)
    return out, frozenset(r["word"] for r in signs.collect())


MEASURES = "doc_id bigint, script string, language string, size int, text_ratio double, shape_ratio double, ends double, new_ends double"


def measured(documents: DataFrame, settings: SpamSettings = SpamSettings()) -> DataFrame:
    """For each document with an id and a text that isn't tiny: script, language ('' where its words don't tell), size class,
    compression ratios of text and shape, sentence ends (all, and of different sentences) in 100 characters."""
    shared = documents.sparkSession.sparkContext.broadcast(profiles(documents, settings))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, signs = shared.value
        languages = Languages(known)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                if text is None or len(text) < settings.least_chars:
                    continue
                size = len(text.encode("utf-8", "replace"))
                solid = max(1, len(text) - text.count(" "))
                ends, new = sentence_ends(text)
                language = languages.tell(short_words(text, settings.short)) or ""
                shaped = shape(text, signs, settings.short)
                rows.append(
                    (doc_id, script_of(text), language, size_class(size, settings.block), block_ratio(text, size, settings.block), block_ratio(shaped, size, settings.block),
                     100 * ends / solid, 100 * new / solid)
                )
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in MEASURES.split(", ")], dtype=object)

    rows = documents.where("doc_id is not null").select("doc_id", "text").mapInPandas(measure, MEASURES)
    return materialise(rows, "measures")


def _by_size(measures: DataFrame, settings: SpamSettings) -> DataFrame:
    """size, ut, us: the median ratios of each size class, there are some 30; a class of few documents has those of the
    nearest one that has more, or where none has, those of all."""
    median = lambda c: F.percentile_approx(c, 0.5, 1000)
    rows = measures.rollup("size").agg(F.count(F.lit(1)).alias("n"), median("text_ratio").alias("ut"), median("shape_ratio").alias("us")).collect()
    by = {r["size"]: (r["ut"], r["us"]) for r in rows}
    large = [r["size"] for r in rows if r["size"] is not None and r["n"] >= settings.few]
    own = {size: by[min(large, key=lambda x: (abs(x - size), x)) if large else None] for size in by if size is not None}
    return measures.sparkSession.createDataFrame([(size, *usual) for size, usual in own.items()], "size int, ut double, us double")


def normalised(measures: DataFrame, settings: SpamSettings = SpamSettings()) -> DataFrame:
    """doc_id, redundancy of text and shape and sentence density, each in parts of the usual: the median over all documents
    of the size class, times that of the script, times that of the language (of what the one before leaves)."""
    median = lambda c: F.percentile_approx(c, 0.5, 1000)
    rows = measures.withColumns({"t": F.col("text_ratio"), "s": F.col("shape_ratio")})
    for keys in (["size"], ["script"], ["script", "language"]):
        if keys == ["size"]:
            usual = _by_size(measures, settings)
        elif keys == ["script"]:
            usual = rows.groupBy(*keys).agg(median("t").alias("ut"), median("s").alias("us"))
        else:
            own = rows.where("language <> ''").groupBy(*keys).agg(median("t").alias("ut"), median("s").alias("us"), F.count(F.lit(1)).alias("n"))
            usual = own.where(F.col("n") >= settings.few).drop("n")
        # a row for each size class, script or language: some 30, 3 and at most 3 * languages
        rows = rows.join(F.broadcast(usual), keys, "left").withColumns({"t": F.col("t") / F.coalesce("ut", F.lit(1.0)), "s": F.col("s") / F.coalesce("us", F.lit(1.0))}).drop("ut", "us")
    ends = rows.groupBy("script").agg(median("ends").alias("by_script"))
    own = rows.where("language <> ''").groupBy("script", "language").agg(median("ends").alias("by_language"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= settings.few).drop("n")
    rows = rows.join(F.broadcast(ends), "script", "left").join(F.broadcast(own), ["script", "language"], "left")
    usual = F.coalesce("by_language", "by_script")
    return rows.select("doc_id", F.col("t").alias("text_part"), F.col("s").alias("shape_part"), F.coalesce(F.try_divide("new_ends", usual), F.lit(0.0)).alias("density_part"))


def spam_pages(documents: DataFrame, settings: SpamSettings = SpamSettings()) -> DataFrame:
    """doc_id of the pages flagged and confirmed. Null, empty and tiny texts are none, nor are rows without doc_id;
    repeated texts are each. An empty table gives none. documents: doc_id, text, lang."""
    parts = normalised(measured(documents, settings), settings)
    extreme = (F.col("text_part") <= settings.text_limit) | (F.col("shape_part") <= settings.shape_limit)
    return parts.where(extreme & (F.col("density_part") <= settings.density)).select("doc_id")
