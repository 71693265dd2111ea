"""Mapping free-entered values to a canonical list.

A typed value is brought to candidate forms (affixes cut, abbreviations of kinds of place and of directions written out,
spaces dropped). The list's names and aliases are kept with all their deletions of up to two characters; a form meets an
entry where they share a deletion (symmetric delete), so that each form costs a bounded number of look-ups whatever the
length of the list. Entries met are ranked by a weighted Damerau-Levenshtein distance, then by how often the data uses
the entry exactly. Values that meet none are reported as misses (ref_id 0).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators.lookup import lookup_join
from gleaner.runtime import fingerprint, materialise

#: Ways to write kinds of place, kinds of street and directions.
PLACE_KINDS = {
    "center": "ctr centre cntr cent", "plaza": "plz plza pl", "square": "sq squ sqr", "village": "vlg vill vil vllg", "heights": "hts hgts ht",
    "junction": "jct jctn jn jnct jtn junct", "crossing": "xing crssg crsg cros", "landing": "ldg lndg lnd", "point": "pt pnt", "corner": "cnr crnr cor",
}
STREET_KINDS = {
    "street": "st str strt", "avenue": "av ave aven avn", "boulevard": "blvd boul blv bvd", "road": "rd", "court": "ct crt", "parkway": "pkwy pky pkway pwy",
    "lane": "ln la", "drive": "dr drv", "highway": "hwy hiway hwy hgwy", "way": "wy", "terrace": "ter terr tce", "place": "pl", "circle": "cir circ",
}
DIRECTIONS = {"north": "n no nth nrth", "south": "s so sth", "east": "e est", "west": "w wst"}
STATE_WORDS = {"ma", "mass", "massachusetts", "usa"}
LEADING = {"the", "over", "in", "at", "near", "by"}
TRAILING = {"store", "branch", "location", "one", "shop"}
NUMBER_WORDS = set(
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty"
    " sixty seventy eighty ninety hundred".split()
)
UNIT_WORDS = {"unit", "apt", "apartment", "suite", "ste", "room", "rm", "floor", "fl", "level", "rear", "lower", "upper", "no", "bldg", "building"}
#: Neighbours on a keyboard with letters in three rows.
ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")

MAX_EDITS = 2
#: Entries (with aliases) up to which the dictionary is broadcast: some 60 MB of deletions. Beyond it is joined.
MAX_BROADCAST_ENTRIES = 50_000


def _inverse(kinds: dict[str, str]) -> dict[str, str]:
    return {w: k for k, ws in kinds.items() for w in [k, *ws.split()]}


_PLACE, _STREET, _DIRECTION = _inverse(PLACE_KINDS), _inverse(STREET_KINDS), _inverse(DIRECTIONS)


def _near() -> set[tuple[str, str]]:
    at = {ch: (r, i + 0.5 * (r > 0) + 0.5 * (r > 1)) for r, row in enumerate(ROWS) for i, ch in enumerate(row)}
    return {(a, b) for a, (ra, xa) in at.items() for b, (rb, xb) in at.items() if a != b and abs(ra - rb) <= 1 and abs(xa - xb) <= 1}


_NEAR = _near()


def weighted_distance(typed: str, name: str, limit: int = MAX_EDITS) -> tuple[int, float] | None:
    """(edits, weight) of the restricted Damerau-Levenshtein alignment with fewest edits, then least weight; null beyond
    limit. Neighbouring keys, swaps and doubled letters weigh less than other edits."""
    n, m = len(typed), len(name)
    if abs(n - m) > limit:
        return None
    big = (limit + 1, 9.0)
    before: list[tuple[int, float]] = []
    row = [(j, float(j)) if j <= limit else big for j in range(m + 1)]
    for i in range(1, n + 1):
        a = typed[i - 1]
        now = [big] * (m + 1)
        if i <= limit:
            now[0] = (i, float(i))
        for j in range(max(1, i - limit), min(m, i + limit) + 1):
            b = name[j - 1]
            if a == b:
                best = row[j - 1]
            else:
                e, w = row[j - 1]
                best = (e + 1, w + (0.8 if (a, b) in _NEAR else 1.0))
            e, w = row[j]
            best = min(best, (e + 1, w + (0.7 if i > 1 and typed[i - 2] == a or i < n and typed[i] == a else 0.9)))
            e, w = now[j - 1]
            best = min(best, (e + 1, w + (0.7 if j > 1 and name[j - 2] == b or j < m and name[j] == b else 0.9)))
            if i > 1 and j > 1 and a == name[j - 2] and typed[i - 2] == b and a != b:
                e, w = before[j - 2]
                best = min(best, (e + 1, w + 0.6))
            now[j] = best
        before, row = row, now
    return row[m] if row[m][0] <= limit else None


def deletions(s: str, most: int = MAX_EDITS) -> set[str]:
    out = {s}
    for k in range(1, min(most, len(s)) + 1):
        for drop in combinations(range(len(s)), k):
            out.add("".join(ch for i, ch in enumerate(s) if i not in drop))
    return out


def edits_allowed(length: int) -> int:
    return 0 if length < 4 else 1 if length < 6 else MAX_EDITS


def _plain(value: str) -> str:
    value = unicodedata.normalize("NFKD", value.replace(" ", " "))
    return "".join(ch for ch in value if not unicodedata.combining(ch))


def _words(part: str) -> list[str]:
    part = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", part)
    part = re.sub(r"['’]", "", part)
    return re.findall(r"[a-z]+|\d+[a-z]?(?:/\d+)?|#", re.sub(r"(?<=\d)[-–]\s*(?=\d)", "/", part.lower()))


def place_forms(value: str) -> list[list[str]]:
    """Candidate word lists of a town or branch, the fullest first."""
    value = _plain(value)
    parts = [p for p in re.split(r"[,;(/|]|\s[-–]\s|\s(?i:in)\s", value) if p.strip()]
    out: list[list[str]] = []
    for p in [value, *parts] if len(parts) > 1 else parts:
        words = [w for w in _words(p) if not w[0].isdigit() and w != "#"]
        while words and words[-1] in STATE_WORDS:
            words.pop()
        while len(words) > 1 and words[0] in LEADING:
            words.pop(0)
        while len(words) > 1 and words[-1] in TRAILING:
            words.pop()
        while len(words) > 1 and words[-1] in STATE_WORDS:
            words.pop()
        if not words:
            continue
        if len(words) > 1:
            words[0] = _DIRECTION.get(words[0], words[0])
            words[1:] = [_PLACE.get(w, w) for w in words[1:]]
        for form in (words, _written_together(words)):
            if form and form not in out:
                out.append(form)
    return out


def _written_together(words: list[str]) -> list[str] | None:
    """"Dostaburnsq": a kind of place that was not set apart."""
    last = words[-1]
    for short in sorted(_PLACE, key=len, reverse=True):
        if last.endswith(short) and len(last) >= len(short) + 4:
            return [*words[:-1], last[: -len(short)], _PLACE[short]]
    return None


def street_forms(value: str) -> list[tuple[list[str], bool]]:
    """Candidate word lists of a street, without numbers and units; whether a kind of street is among the words."""
    out: list[tuple[list[str], bool]] = []
    for p in re.split(r"[,;()]| - ", _plain(value)):
        words, unit = [], False
        for w in _words(p):
            if w in UNIT_WORDS or w == "#":
                unit = True
            elif w[0].isdigit() or len(w) == 1 and (unit or not words):
                unit = False
            elif w in NUMBER_WORDS and not words:
                continue
            elif w in ("st", "nd", "rd", "th") and not words:
                continue
            else:
                words.append(w)
        if not words:
            continue
        kind = len(words) > 1 and words[-1] in _STREET
        if kind:
            words[-1] = _STREET[words[-1]]
        out.append((words, kind))
    return out


@dataclass(frozen=True)
class Entry:
    ref_id: int
    kind: str
    name: str
    city: str
    written: str  # the name or an alias


def entry_keys(e: Entry) -> Iterable[tuple[str, str]]:
    """(list, key) under which an entry is found; lists: place (towns, branches), street, base (streets without kind)."""
    words = _words(_plain(e.written))
    if e.kind == "street":
        yield "street", "".join(words)
        if len(words) > 1:
            yield "base", "".join(words[:-1])
    else:
        yield e.kind, "".join(words)


class Matcher:
    """The dictionary with its deletions, for entries that fit in memory."""

    def __init__(self, entries: Sequence[Entry], frequency: dict[int, int]) -> None:
        self.frequency, self.city = frequency, {e.ref_id: e.city for e in entries}
        self.towns = {"".join(_words(_plain(e.written))): e.name for e in entries if e.kind == "city"}
        self.keys: dict[tuple[str, str], list[int]] = {}
        self.deleted: dict[tuple[str, str], list[str]] = {}
        self.longest = 0
        for e in entries:
            for where, key in entry_keys(e):
                self.longest = max(self.longest, len(key))
                ids = self.keys.setdefault((where, key), [])
                if not ids:
                    for d in deletions(key, edits_allowed(len(key))):
                        self.deleted.setdefault((where, d), []).append(key)
                ids.append(e.ref_id)

    def near(self, where: str, form: str) -> list[tuple[int, float, int]]:
        """(edits, weight, ref_id) of the entries within the edits allowed."""
        if (where, form) in self.keys:
            return [(0, 0.0, i) for i in self.keys[where, form]]
        if len(form) > self.longest + MAX_EDITS:  # no name is that long
            return []
        most, seen, out = edits_allowed(len(form)), set(), []
        for d in deletions(form, most):
            for key in self.deleted.get((where, d), ()):
                if key not in seen:
                    seen.add(key)
                    found = weighted_distance(form, key, min(most, edits_allowed(len(key))))
                    if found:
                        out += [(*found, i) for i in self.keys[where, key]]
        return out

    def best(self, found: list[tuple[int, float, int]], town: str = "") -> int:
        if not found:
            return 0
        return min(found, key=lambda x: (x[0], round(x[1], 3), self.city.get(x[2], "") != town if town else False, -self.frequency.get(x[2], 0), x[2]))[2]

    def place(self, value: str, kinds: Sequence[str]) -> int:
        # each form means the kind it is nearest to; of the forms' meanings, a branch goes before the town it is given with
        meant: list[tuple[int, int, float, int, int]] = []
        for words in place_forms(value):
            form = "".join(words)
            found = [(e, round(w, 3), rank, -self.frequency.get(ref, 0), ref) for rank, kind in enumerate(kinds) for e, w, ref in self.near(kind, form)]
            if found:
                e, w, rank, often, ref = min(found)
                meant.append((rank, e, w, often, ref))
        return min(meant)[4] if meant else 0

    def street(self, value: str) -> int:
        forms = street_forms(value)
        town = next((self.towns[f] for words, _ in forms[1:] if (f := "".join(words)) in self.towns), "")
        with_kind = [words for words, kind in forms if kind]
        if with_kind:
            return self.best([x for words in with_kind for x in self.near("street", "".join(words))], town)
        found = self.best([x for words, _ in forms for x in self.near("street", "".join(words))], town)
        if found:
            return found
        return self.best([x for i, (words, _) in enumerate(forms) if not (i and "".join(words) in self.towns) for x in self.near("base", "".join(words))], town)


def reference_entries(ref: DataFrame) -> DataFrame:
    """One row per name and alias."""
    written = F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    return ref.select("ref_id", F.col("ref_kind").alias("kind"), "name", F.coalesce("city", F.lit("")).alias("city"), F.explode(written).alias("written")).where("ref_id is not null and kind is not null and name is not null and written is not null")


def lookups_of(value: str, kinds: str) -> set[tuple[str, str]]:
    """(list, form) pairs under which a value is looked up."""
    if kinds == "street":
        return {(where, "".join(words)) for words, _ in street_forms(value) for where in ("street", "base", "city")}
    return {(kind, "".join(words)) for words in place_forms(value) for kind in kinds.split(",")}


def decide(matcher: Matcher, value: str, kinds: str) -> int:
    return matcher.street(value) if kinds == "street" else matcher.place(value, kinds.split(","))


def match_by_broadcast(todo: DataFrame, entries: DataFrame) -> DataFrame:
    """kinds, value, n, ref_id with the whole dictionary in each worker."""
    rows = [(Entry(r["ref_id"], r["kind"], r["name"], r["city"], r["written"]), r["uses"]) for r in entries.collect()]
    shared = todo.sparkSession.sparkContext.broadcast(([e for e, _ in rows], {e.ref_id: n for e, n in rows}))

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(*shared.value)
        for batch in batches:
            ids = [decide(matcher, v, k) for k, v in zip(batch["kinds"], batch["value"], strict=True)]
            yield pd.DataFrame({"kinds": list(batch["kinds"]), "value": list(batch["value"]), "n": list(batch["n"]), "ref_id": ids}, dtype=object)

    return todo.mapInPandas(match, "kinds string, value string, n bigint, ref_id bigint")


def match_by_join(todo: DataFrame, entries: DataFrame) -> DataFrame:
    """The same for a dictionary of any size: deletions of names and of values are joined, each pair that meets is weighed
    where it is, and of all entries near a form only the best is kept, and the best in each town that the value names. So
    a value is decided with a few entries, however many share a deletion or a name."""

    def name_deletions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                for where, key in entry_keys(Entry(r.ref_id, r.kind, r.name, r.city, r.written)):
                    out += [(where, d, key, r.ref_id, r.kind, r.name, r.city, r.written, r.uses) for d in deletions(key, edits_allowed(len(key)))]
            yield pd.DataFrame(out, columns=["where_", "deletion", "key", "ref_id", "kind", "name", "city", "written", "uses"], dtype=object)

    longest = (entries.agg(F.max(F.length("written"))).first()[0] or 0) + MAX_EDITS

    def value_deletions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, v in zip(batch["kinds"], batch["value"], strict=True):
                out += [(k, v, where, form, d) for where, form in lookups_of(v, k) if len(form) <= longest for d in deletions(form, edits_allowed(len(form)))]
            yield pd.DataFrame(out, columns=["kinds", "value", "where_", "form", "deletion"], dtype=object)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            edits, weights = [], []
            for form, key in zip(batch["form"], batch["key"], strict=True):
                found = weighted_distance(form, key, min(edits_allowed(len(form)), edits_allowed(len(key))))
                edits.append(found[0] if found else None)
                weights.append(round(found[1], 3) if found else None)
            yield batch.assign(edits=pd.array(edits, "Int32"), weight=pd.array(weights, "Float64"))

    entry = "ref_id bigint, kind string, name string, city string, written string, uses bigint"
    names = entries.mapInPandas(name_deletions, f"where_ string, deletion string, key string, {entry}")
    tried = materialise(todo.select("kinds", "value").mapInPandas(value_deletions, "kinds string, value string, where_ string, form string, deletion string"), "deletions")
    met = tried.join(names, ["where_", "deletion"]).drop("deletion")
    near = met.mapInPandas(weigh, f"where_ string, kinds string, value string, form string, key string, {entry}, edits int, weight double").where("edits is not null")
    # the towns that a value names as they are written
    exact = tried.where("where_ = 'city' and deletion = form").select("kinds", "value", F.col("form").alias("key"))
    towns = exact.join(names.where("where_ = 'city' and deletion = key").select("key", "name"), "key").groupBy("kinds", "value").agg(F.collect_set("name").alias("towns"))
    placed = near.join(towns, ["kinds", "value"], "left").withColumn("town", F.when(F.array_contains("towns", F.col("city")), F.col("city")))
    order = F.struct("edits", "weight", (-F.col("uses")).alias("often"), "ref_id", "kind", "name", "city", "written", "uses")
    best = placed.groupBy("kinds", "value", "where_", "form", "town").agg(F.min(order).alias("e"))
    few = best.groupBy("kinds", "value").agg(F.collect_set(F.struct("e.ref_id", "e.kind", "e.name", "e.city", "e.written", "e.uses")).alias("met"))

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = []
            for k, v, met_ in zip(batch["kinds"], batch["value"], batch["met"], strict=True):
                found = [] if met_ is None else [(Entry(e["ref_id"], e["kind"], e["name"], e["city"], e["written"]), e["uses"]) for e in met_]
                ids.append(decide(Matcher([e for e, _ in found], {e.ref_id: n for e, n in found}), v, k) if found else 0)
            yield pd.DataFrame({"kinds": list(batch["kinds"]), "value": list(batch["value"]), "n": list(batch["n"]), "ref_id": ids}, dtype=object)

    return todo.join(few, ["kinds", "value"], "left").select("kinds", "value", "n", "met").mapInPandas(match, "kinds string, value string, n bigint, ref_id bigint")


def map_to_list(values: DataFrame, ref: DataFrame, broadcast_entries: int = MAX_BROADCAST_ENTRIES) -> DataFrame:
    """src, row_id, ref_id for each value (columns src, row_id, value, kinds) that is not blank and not, letter for letter,
    the name of an entry of its kinds. kinds: the kinds of entry allowed, as a comma list, the preferred first.

    Each distinct value is matched once. ref_id is 0 where the list has none. Of entries equally near, the one the
    values use more often exactly is taken, then the lower ref_id. A list of more than broadcast_entries names and aliases
    is joined instead of broadcast.
    """
    spark = values.sparkSession
    names = ref.select(F.col("ref_id").alias("exact_id"), F.col("ref_kind").alias("exact_kind"), F.col("name").alias("exact_name"))
    kept = values.where(F.regexp_replace("value", r"(?U)\s+", "") != "")
    f0, f1 = fingerprint("kinds", "value")
    counted = materialise(kept.groupBy("kinds", "value").agg(F.count(F.lit(1)).alias("n")), "values")
    exact = counted.join(names, (F.col("value") == F.col("exact_name")) & (F.array_contains(F.split("kinds", ","), F.col("exact_kind"))), "left")
    uses = exact.where("exact_id is not null").groupBy(F.col("exact_id").alias("ref_id")).agg(F.sum("n").alias("uses"))
    entries = materialise(reference_entries(ref).join(uses, "ref_id", "left").fillna(0, ["uses"]), "entries")
    todo = exact.where("exact_id is null").select("kinds", "value", "n").repartition(spark.sparkContext.defaultParallelism * 2)
    matched = (match_by_broadcast if entries.count() <= broadcast_entries else match_by_join)(todo, entries)
    found = matched.select(f0.alias("f0"), f1.alias("f1"), "n", "ref_id")
    rows = kept.select("src", "row_id", f0.alias("f0"), f1.alias("f1"))
    return lookup_join(rows, found, ["f0", "f1"], "n").select("src", "row_id", "ref_id")
