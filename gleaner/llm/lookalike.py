"""Visually identical text with different characters.

Strings and code points that look alike are joined into classes by union-find (so a chain of look-alikes is one class):
the public table of confusable letters that the session's JVM has, width and style forms of the character database, and
the letters below, which hold without a session too.
Of each class the member most frequent in the text at hand represents it, and a multi-pattern automaton rewrites every
other member, longest match first. Invisible characters are removed; canonically equal sequences are composed.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.lookup import lookup_join
from gleaner.runtime import fingerprint, materialise

#: Letters of other scripts that show the same shape as a Latin letter.
LOOK_ALIKES = {
    "a": "аɑ", "c": "сϲⅽ", "d": "ԁⅾ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іⅰ", "j": "јϳ", "k": "", "l": "ӏⅼ", "m": "ⅿ",
    "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "u": "ս", "v": "νѵⅴ", "w": "ԝ", "x": "хⅹ", "y": "у", "A": "АΑ", "B": "ВΒ",
    "C": "СϹⅭ", "D": "Ⅾ", "E": "ЕΕ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀⅠ", "J": "ЈͿ", "K": "КΚ", "L": "Ⅼ", "M": "МΜⅯ", "N": "Ν",
    "O": "ОΟՕ", "P": "РΡ", "Q": "Ԛ", "S": "ЅՏ", "T": "ТΤ", "V": "ѴⅤ", "W": "Ԝ", "X": "ХΧⅩ", "Y": "ҮΥ", "Z": "Ζ",
    "-": "‐‑", ".": "․", ";": ";", ":": "∶", "'": "", "/": "⁄∕", "...": "…",
}
#: Characters that show nothing.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩﻿"
JOINER = "‍"
#: Letters that the table of confusables joins with others which a reader tells from them: by a dot, a storey,
#: a hook, a stroke or in all but slanted writing.
TOLD_APART = frozenset("ıɩɪιͺȷαγɣσᴑჿυʋſẝßβẞϐƽƖƍʏᶌỿƄЬгᴦⲅꭇꭈꮁϱϖʀ")


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, s: str) -> str:
        self.parent.setdefault(s, s)
        while self.parent[s] != s:
            self.parent[s] = s = self.parent[self.parent[s]]
        return s

    def union(self, a: str, b: str) -> None:
        self.parent[self.find(a)] = self.find(b)

    def groups(self) -> list[list[str]]:
        out: dict[str, list[str]] = {}
        for s in sorted(self.parent):
            out.setdefault(self.find(s), []).append(s)
        return [g for g in out.values() if len(g) > 1]


def _compatible() -> Iterator[tuple[str, str]]:
    """Pairs from the character database: width forms, kinds of space, ligatures, Roman numerals, canonical singletons."""
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        rule = unicodedata.decomposition(ch)
        if not rule:
            continue
        tag = rule.split()[0]
        plain = unicodedata.normalize("NFKC", ch)
        if tag in ("<wide>", "<narrow>", "<noBreak>", "<font>", "<small>") or unicodedata.category(ch) == "Zs" or 0xFB00 <= cp <= 0xFB06 or 0x2160 <= cp <= 0x217F:
            yield ch, plain
        elif tag[0] != "<" and (single := unicodedata.normalize("NFC", ch)) != ch:
            yield ch, single


def _accented(pairs: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Where two letters look alike, so do they under the same mark (ё and ë)."""
    marks = [chr(c) for c in range(0x300, 0x370)]
    for a, b in pairs:
        if len(a) == len(b) == 1:
            for m in marks:
                x, y = unicodedata.normalize("NFC", a + m), unicodedata.normalize("NFC", b + m)
                if len(x) == 1 or len(y) == 1:
                    yield x, y


def confusable_pairs(spark: SparkSession) -> tuple[tuple[str, str], ...]:
    """Letters of scripts with capitals (and of Lisu, whose letters are Latin capitals) and the letter that each shows, by
    the public table of confusables. Left out: letters that show a digit, several letters, or TOLD_APART. I and l are one
    in the table; here capitals show I and others l. Raises where the JVM has no table, as few classes would look like a result."""
    listed = frozenset("".join(LOOK_ALIKES.values()))
    chars = [
        ch for ch in map(chr, range(0x80, 0x20000))
        if (unicodedata.category(ch) in ("Lu", "Ll", "Lt", "Nl") or unicodedata.name(ch, "").startswith("LISU LETTER")) and unicodedata.bidirectional(ch) == "L" and ch not in TOLD_APART
        # styles, widths and letters composed or put otherwise are in the database, and the letters above hold
        and not unicodedata.decomposition(ch).startswith("<") and unicodedata.normalize("NFC", ch) == ch and ch not in listed
    ]
    try:
        shown = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build().getSkeleton("\n".join(chars)).split("\n")
    except (TypeError, Py4JError) as e:
        raise RuntimeError("the table of confusables can't be read from the session's JVM (SpoofChecker of icu4j)") from e
    out = []
    for ch, other in zip(chars, shown, strict=True):
        if other == "l":
            other = "I" if unicodedata.category(ch) != "Ll" else "l"
        if len(other) == 1 and other != ch and unicodedata.category(other)[0] == "L" and other not in TOLD_APART:
            out.append((ch, other))
    return tuple(out)


@lru_cache(maxsize=4)
def look_alike_classes(confusable: tuple[tuple[str, str], ...] = ()) -> tuple[tuple[str, ...], ...]:
    known = Classes()
    letters = [*((a, b) for a, others in LOOK_ALIKES.items() for b in others), *confusable]
    for a, b in [*letters, *_compatible(), *_accented(letters)]:
        if a != b:
            known.union(a, b)
    return tuple(tuple(g) for g in known.groups())


@dataclass(frozen=True)
class Rewriter:
    """Maps each member that isn't its class's representative to that one. frequency: of strings in the corpus; without
    any, the lowest code points represent. confusable: pairs beside the letters of this module."""

    frequency: dict[str, int] = field(default_factory=dict, hash=False)
    confusable: tuple[tuple[str, str], ...] = ()

    def table(self) -> dict[str, str]:
        out = {}
        for group in look_alike_classes(self.confusable):
            best = min(group, key=lambda s: (-self.frequency.get(s, 0), not s.isascii(), len(s), s))
            out.update({s: best for s in group if s != best})
        return out

    def build(self):
        table = self.table()
        automaton = ahocorasick.Automaton()
        for s, best in table.items():
            automaton.add_word(s, (len(s), best))
        for ch in INVISIBLE:
            automaton.add_word(ch, (1, ""))
        automaton.make_automaton()
        plain = all(not s.isascii() for s in table)
        # of longer members those outside ASCII end in a mark
        ends = frozenset(s[-1] for s in [*table, *INVISIBLE] if len(s) == 1 or not s.isascii())
        longer = [s for s in table if len(s) > 1 and s.isascii()]

        def rewrite(text: str | None) -> str | None:
            if text is None or (plain and text.isascii()):
                return text
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            if ends.isdisjoint(text) and not any(s in text for s in longer):
                return text
            parts, at, changed = [], 0, False
            for end, (n, best) in automaton.iter_long(text):
                start = end - n + 1
                if text[start] == JOINER and 0 < start < len(text) - 1 and _joins(text[start - 1], text[start + 1]):
                    continue
                parts += [text[at:start], best]
                at, changed = end + 1, True
            if not changed:
                return text
            parts.append(text[at:])
            return unicodedata.normalize("NFC", "".join(parts))

        return rewrite


def _joins(a: str, b: str) -> bool:
    """A joiner between two symbols makes one picture of them and so is visible."""
    return (unicodedata.category(a) in ("So", "Sk") or a == "️") and unicodedata.category(b) in ("So", "Sk")


def rewriter_of(texts: DataFrame, column: str) -> Rewriter:
    """The rewriter of a column: counts how often each member of a class stands in all of it. The counts have at most as
    many entries as there are members (some 5,000), whatever the input."""
    confusable = confusable_pairs(texts.sparkSession)
    every = [s for g in look_alike_classes(confusable) for s in g]
    several = [s for s in every if len(s) > 1]
    plain_several = [s for s in several if s.isascii()]
    marks = "".join(sorted({s[-1] for s in several if not s.isascii() and s[-1] <= "\uffff"}))
    wanted = frozenset(every)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter[str] = Counter()
        ascii_counts = np.zeros(256, dtype=np.int64)
        plain, marked = re.compile("[\x00-\x7f]+"), re.compile(f".[{marks}]")  # marks are few
        for batch in batches:
            # a batch at a time, set apart by a character that is no member
            text = "\x00".join(t for t in batch[column] if t is not None)
            ascii_counts += np.bincount(np.frombuffer(text.encode("ascii", "ignore"), np.uint8), minlength=256)
            found.update(plain.sub("", text))
            found.update(marked.findall(text))
            for s in plain_several:
                found[s] += text.count(s)
        for i in np.nonzero(ascii_counts)[0]:
            found[chr(i)] += int(ascii_counts[i])
        keep = [(s, n) for s, n in found.items() if n and s in wanted]
        yield pd.DataFrame(keep, columns=["member", "n"], dtype=object)

    rows = texts.select(column).mapInPandas(count, "member string, n bigint").groupBy("member").agg(F.sum("n").alias("n")).collect()
    return Rewriter({r["member"]: r["n"] for r in rows}, confusable)


def with_consistent_form(df: DataFrame, column: str, out: str, rewriter: Rewriter) -> DataFrame:
    """df with `out`, the column in its one consistent form. Null stays null and empty stays empty."""
    cache: dict[str, object] = {}

    @F.pandas_udf("string")
    def consistent(texts: pd.Series) -> pd.Series:
        if "f" not in cache:
            cache["f"] = rewriter.build()
        return texts.map(cache["f"], na_action="ignore")

    return df.withColumn(out, consistent(F.col(column)))


@dataclass(frozen=True)
class Looks:
    """rows: key, c0, c1 (its look), s0, s1 (its string), of every row with a value. strings: c0, c1, s0, s1, n (rows), of
    the looks with two strings at least, and m, how many strings the look has."""

    rows: DataFrame
    strings: DataFrame


def looks_of(df: DataFrame, key: str, column: str, rewriter: Rewriter) -> Looks:
    """Values by look (their consistent form) and string, both as fingerprints of 128 bits. Null has no look."""
    formed = with_consistent_form(df.select(F.col(key).alias("key"), F.col(column).alias("v")).where(F.col("v").isNotNull()), "v", "form", rewriter)
    (c0, c1), (s0, s1) = fingerprint("form"), fingerprint("v")
    rows = materialise(formed.select("key", c0.alias("c0"), c1.alias("c1"), s0.alias("s0"), s1.alias("s1")), "forms")
    strings = rows.groupBy("c0", "c1", "s0", "s1").agg(F.count(F.lit(1)).alias("n"))
    several = strings.groupBy("c0", "c1").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    return Looks(rows, materialise(lookup_join(strings, several, ["c0", "c1"], "m"), "strings"))


def look_classes(looks: Looks) -> DataFrame:
    """key, look, strings, rows: of every row whose look has two strings at least, the look (the lowest key of its class) and
    how many different strings and how many rows show it. One row for each row, however large the class."""
    sizes = looks.strings.groupBy("c0", "c1").agg(F.max("m").alias("strings"), F.sum("n").alias("rows"))
    members = materialise(lookup_join(looks.rows.select("key", "c0", "c1"), sizes, ["c0", "c1"], "rows"), "members")
    lowest = members.groupBy("c0", "c1").agg(F.min("key").alias("look"), F.count(F.lit(1)).alias("_w"))
    return lookup_join(members, lowest, ["c0", "c1"], "_w").select("key", "look", "strings", "rows")


def same_look_pairs(looks: Looks, chunk: int = 1_000) -> DataFrame:
    """Pairs key_a < key_b of rows whose values look the same but differ as strings, made from the classes.

    A class of many strings is split into blocks of strings, and the rows of one string into chunks; pairs are made between
    blocks and between chunks, so a look or a string that a third of all rows have is spread over as many tasks as its
    pairs need.
    """
    chunks, blocks = F.ceil(F.col("n") / chunk), F.ceil(F.col("m") / chunk)
    strings = looks.strings.withColumns({"chunks": chunks, "blocks": blocks}).withColumn("block", F.pmod(F.xxhash64("s0", "s1"), F.col("blocks")))
    each = F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)
    a = strings.select("c0", "c1", F.col("s0").alias("a0"), F.col("s1").alias("a1"), F.col("chunks").alias("na"), F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"))
    b = strings.select("c0", "c1", F.col("s0").alias("b0"), F.col("s1").alias("b1"), each.alias("nb"), F.explode(F.sequence(F.lit(0).cast("bigint"), "block")).alias("i"), F.col("block").alias("j"))
    # pairs of different strings of one class, then of their chunks
    before = (F.col("a0") < F.col("b0")) | ((F.col("a0") == F.col("b0")) & (F.col("a1") < F.col("b1")))
    pairs = (
        a.join(b, ["c0", "c1", "i", "j"]).where((F.col("i") < F.col("j")) | before)
        .select("a0", "a1", "b0", "b1", "nb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("na") - 1)).alias("ca"))
        .select("a0", "a1", "b0", "b1", "ca", F.explode("nb").alias("cb"))
    )
    numbered = lookup_join(looks.rows.select("s0", "s1", "key"), looks.strings.select("s0", "s1", chunks.alias("nc")), ["s0", "s1"], "nc").select(
        "s0", "s1", "key", F.pmod(F.xxhash64("key"), F.col("nc")).alias("c")
    )
    left = numbered.select(F.col("s0").alias("a0"), F.col("s1").alias("a1"), F.col("c").alias("ca"), F.col("key").alias("ka"))
    right = numbered.select(F.col("s0").alias("b0"), F.col("s1").alias("b1"), F.col("c").alias("cb"), F.col("key").alias("kb"))
    joined = pairs.join(left, ["a0", "a1", "ca"]).join(right, ["b0", "b1", "cb"])
    return joined.select(F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b"))
