"""Lines of a receipt as columns: what is noise, what was bought, for how much."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.functions.text import let


def literal_of(pattern: str) -> str | None:
    """A text that stands in every match of a noise pattern: its longest plain part, or its one mark; None without."""
    plain = re.sub(r"\([^()]*\)\??|\[[^\]]*\][?*+]?|.\?|\\.[*+]?|[\^$.*+]|\{[^}]*\}", "|", pattern)
    parts = sorted(re.findall(r"[a-z]+(?: [a-z]+)*|#", plain), key=len)
    return parts[-1] if parts and not pattern.startswith((r"^\s*[", r"^\s*\d")) else None


def is_noise(line: Column) -> Column:
    """A pattern is tried only where its literal stands."""
    tests = []
    for p in vocab.RECEIPT_NOISE:
        literal = literal_of(p)
        tests.append(lambda low, p=p, literal=literal: low.rlike(p) if literal is None else low.contains(literal) & low.rlike(p))
    return let(F.lower(line), lambda low: reduce(lambda a, b: a | b, [test(low) for test in tests]))


def price(line: Column) -> Column:
    digits = F.replace(F.regexp_replace(F.regexp_extract(line, vocab.RECEIPT_PRICE, 1), r"[$\s]", ""), F.lit(","), F.lit("."))
    return F.when(digits != "", digits.try_cast("double"))


def quantity(line: Column) -> Column:
    found = F.regexp_extract(line, vocab.RECEIPT_QUANTITY, 1)
    return F.when(found == "", 1).otherwise(F.least(F.lit(20), found.try_cast("int")))


def without_repeats(words: Column) -> Column:
    """Words that repeat the one before go."""
    return F.filter(words, lambda w, i: (i == 0) | (F.get(words, i - 1) != w))


def expand(line: Column) -> Column:
    """The line in ordinary words: price, weight, sizes, codes, brands and units gone, abbreviations written out."""
    text = F.regexp_replace(line, vocab.RECEIPT_PRICE, "")
    for p in (vocab.RECEIPT_WEIGHED, vocab.RECEIPT_SIZES, vocab.RECEIPT_CODES):
        text = F.regexp_replace(text, p, " ")
    table = F.map_from_arrays(F.array(*map(F.lit, vocab.RECEIPT_WORDS)), F.array(*map(F.lit, vocab.RECEIPT_WORDS.values())))
    skipped = F.array(*map(F.lit, dict.fromkeys(["", *vocab.RECEIPT_BRANDS, *vocab.RECEIPT_UNITS])))
    plain = F.filter(F.split(F.lower(text), "[^a-z]+"), lambda w: ~F.array_contains(skipped, w))
    full = F.filter(F.transform(plain, lambda w: F.coalesce(F.try_element_at(table, w), w)), lambda w: F.length(w) >= 2)
    return F.array_join(let(F.flatten(F.transform(full, lambda w: F.split(w, " "))), without_repeats), " ")


def match_term(text: Column, terms: list[str]) -> Column:
    """The longest of the terms that the text contains; of equally long ones the first."""
    # the longest first, the given order among equals: then the first found is the answer
    ordered = F.array(*[F.lit(w) for w in sorted(dict.fromkeys(terms), key=lambda w: -len(w))])
    return F.get(F.filter(ordered, lambda w: F.contains(text, w)), F.lit(0))


def detect_store(text: Column, stores: list[str]) -> Column:
    """The store whose letters stand in the head of the text; the longest name wins, then the first."""
    flat = F.regexp_replace(F.lower(F.substring(text, 1, 400)), "[^a-z]", "")
    letters = [(s, "".join(ch for ch in s.lower() if "a" <= ch <= "z")) for s in stores]
    out = F.lit(None).cast("string")
    for name, key in sorted(((s, k) for s, k in reversed(letters) if len(k) > 3), key=lambda x: len(x[0])):
        out = F.when(flat.contains(key), name).otherwise(out)
    return out


def detect_date(text: Column, now: int) -> Column:
    """Epoch seconds of the first month/day/year; months and days beyond their range roll over; null if more than five
    years ago or more than a day ahead."""
    p = r"\b(\d{1,2})[/-](\d{1,2})[/-](\d{2,4})\b"
    m, d, y = (F.regexp_extract(text, p, i) for i in (1, 2, 3))
    year = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y).try_cast("int")
    day = F.date_add(F.add_months(F.make_date(year, F.lit(1), F.lit(1)), m.try_cast("int") - 1), d.try_cast("int") - 1)
    at = F.unix_timestamp(day.cast("timestamp"))
    return F.when((m != "") & (at > now - 5 * 365 * 86400) & (at < now + 86400), at)
