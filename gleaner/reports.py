"""Tables as lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.config import Settings
from gleaner.operators import evidence as ev
from gleaner.operators import publish as pb


def signed(c):
    return F.concat(F.when(c > 0, "+").otherwise(""), F.format_number(c, 2))


def tone(c):
    return F.when(c > 0.15, "pos").when(c < -0.15, "neg").otherwise("mid")


def title(c):
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def preference_label(percent):
    """What a preference of so many percent for quality means."""
    return F.when(percent < 15, "cheapest").when(percent < 40, "mostly price").when(percent <= 60, "balanced").when(percent <= 85, "mostly quality").otherwise("best quality")


def age(seconds):
    days = F.floor(seconds / 86400)
    return F.when(days < 1, "today").when(days < 2, "yesterday").when(days < 31, F.concat(days, F.lit(" days ago"))).otherwise(F.concat(F.floor(days / 30), F.lit(" months ago")))


def totals_lines(totals: DataFrame) -> list[str]:
    """The stores with most evidence first."""
    line = F.format_string("%-24s %7d claims %10.2f %+.3f", "store", "n_claims", "weighted_evidence", "sentiment")
    return [r[0] for r in totals.orderBy(F.desc("weighted_evidence"), "store").select(line).collect()]


def store_lines(cells: DataFrame, store: str) -> list[str]:
    line = F.format_string("%-20s %6d %9.2f %+.3f %s", title(F.col("category")), "n_claims", "weighted_evidence", "sentiment", F.coalesce("price_signal", F.lit("-")))
    rows = cells.where(F.col("store") == store).orderBy(F.desc("weighted_evidence"), "category")
    return [store, *[r[0] for r in rows.select(line).collect()]]


def detail_lines(weighed: DataFrame, store: str, s: Settings = Settings(), most_quotes: int = 3, most_items: int = 5) -> list[str]:
    """One store: its categories by evidence, each with the heaviest quotes, the branches with evidence, the heaviest items."""
    cells = ev.branch_cells(weighed)
    chains = ev.above_floor(ev.chain_cells(cells), s)
    rows = ev.view(chains, s).join(pb.quotes(weighed, ["store", "category"], most_quotes), ["store", "category"], "left").orderBy(F.desc("weighted_evidence"), "category")
    out = [store, "=" * len(store)]
    for r in rows.collect():  # a row for each category
        mark = "+" if r["sentiment"] > 0.15 else "-" if r["sentiment"] < -0.15 else "~"
        out.append(f"{r['category']:<18} {mark} {r['sentiment']:+.2f}  n={r['n_claims']}  price={r['price_signal'] or '-'}")
        for q in r["e"] or ():
            where = f" [{q['l']}]" if q["l"] else ""
            out.append(f"    [{q['d']}]{where} {q['t'][:100]}")
    if len(out) == 2:
        return [*out, "no claims above the floor of evidence"]
    named = ev.above_floor(cells, s).where("branch <> ''").select("branch").distinct().orderBy("branch")
    out += ["branches: " + ", ".join(r["branch"] for r in named.toLocalIterator())]
    items = ev.view(ev.item_cells(weighed), s).orderBy(F.desc("weighted_evidence"), "item_key").limit(most_items).collect()
    return [*out, "items: " + ", ".join(f"{r['item_key']} ({r['sentiment']:+.2f})" for r in items)]


def percent(value: float | None) -> str:
    return "n/a" if value is None else f"{100 * value:.0f}%"


def score_lines(score: DataFrame) -> list[str]:
    row = score.first()
    return [f"{name:14s} {percent(row[name])}" for name in score.columns]
