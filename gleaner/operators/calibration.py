"""A second source on the first one's scale: weighted least squares, leave-one-out error, inverse-variance combination.

These work on one row per store or branch, already aggregated; fits are aggregations over such rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.config import Settings

EPS = 1e-9


def fit_line(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """keys, intercept, slope, n of y on x weighted by w, in two passes (means first). (0, 0) without weight; a flat line
    through the mean without spread in x."""
    keys = list(keys)
    means = pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("w").alias("sw"), F.sum(F.col("w") * F.col("x")).alias("sx"), F.sum(F.col("w") * F.col("y")).alias("sy")
    )
    means = means.withColumns({"mx": F.try_divide("sx", "sw"), "my": F.try_divide("sy", "sw")})
    joined = pairs.join(means, keys) if keys else pairs.crossJoin(F.broadcast(means))
    dx, dy = F.col("x") - F.col("mx"), F.col("y") - F.col("my")
    sums = joined.groupBy(*keys, "n", "sw", "mx", "my").agg(F.sum(F.col("w") * dx * dx).alias("sxx"), F.sum(F.col("w") * dx * dy).alias("sxy"))
    slope = F.when(F.col("sw") <= 0, 0.0).when(F.col("sxx") == 0, 0.0).otherwise(F.try_divide("sxy", "sxx"))
    return sums.withColumn("slope", slope).select(
        *keys, F.when(F.col("sw") <= 0, 0.0).otherwise(F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"), "slope", "n"
    )


def leave_one_out(pairs: DataFrame) -> DataFrame:
    """id, x, y, w, error of each pair under the line fitted to all the others; pairs whose rest has no weight or no two
    different x are left out.

    No pair meets another: the sums about the common means, less the pair's own part, give the line of the others. Which
    pairs leave no two different x behind follows from the least and greatest x and how many pairs have each.
    """
    means = pairs.agg(F.sum("w").alias("sw"), F.try_divide(F.sum(F.col("w") * F.col("x")), F.sum("w")).alias("mx"), F.try_divide(F.sum(F.col("w") * F.col("y")), F.sum("w")).alias("my"))
    ends = pairs.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count_distinct("x").alias("kinds"))
    each = pairs.crossJoin(F.broadcast(means)).crossJoin(F.broadcast(ends)).withColumns({"dx": F.col("x") - F.coalesce("mx", F.lit(0.0)), "dy": F.col("y") - F.coalesce("my", F.lit(0.0))})
    sums = each.agg(
        F.sum(F.col("w") * F.col("dx")).alias("sx"), F.sum(F.col("w") * F.col("dy")).alias("sy"), F.sum(F.col("w") * F.col("dx") ** 2).alias("sxx"), F.sum(F.col("w") * F.col("dx") * F.col("dy")).alias("sxy"),
        F.count_if(F.col("x") == F.col("lo")).alias("n_lo"), F.count_if(F.col("x") == F.col("hi")).alias("n_hi"),
    )
    less = lambda total, own: F.col(total) - own
    w, dx, dy = F.col("w"), F.col("dx"), F.col("dy")
    rows = each.crossJoin(F.broadcast(sums)).withColumns({"rw": less("sw", w), "rx": less("sx", w * dx), "ry": less("sy", w * dy), "rxx": less("sxx", w * dx * dx), "rxy": less("sxy", w * dx * dy)})
    spread = F.when(F.col("kinds") > 2, True).when(F.col("kinds") < 2, False).otherwise(F.when(F.col("x") == F.col("lo"), F.col("n_lo") > 1).otherwise(F.col("n_hi") > 1))
    mx, my = F.try_divide("rx", "rw"), F.try_divide("ry", "rw")
    var = F.col("rxx") - F.col("rw") * mx * mx
    slope = F.when(var <= 0, 0.0).otherwise(F.try_divide(F.col("rxy") - F.col("rw") * mx * my, var))
    return rows.where((F.col("rw") > 0) & spread).select("id", "x", "y", "w", (dy - (my + slope * (dx - mx))).alias("error"))


def calibrate(pairs: DataFrame) -> DataFrame:
    """One row: intercept, slope, residual_sd (leave-one-out), n_stores, r2. None with fewer than four pairs, without
    weight, or where no pair can be left out. pairs: id, x, y, w."""
    line = fit_line(pairs)
    loo = leave_one_out(pairs).agg(F.sum("w").alias("lw"), F.sum(F.col("w") * F.col("error") ** 2).alias("le"), F.count(F.lit(1)).alias("folds"))
    residual = F.col("y") - (F.col("intercept") + F.col("slope") * F.col("x"))
    mean = pairs.agg((F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("wmean"), F.sum("w").alias("total"))
    spread = (
        pairs.crossJoin(F.broadcast(line)).crossJoin(F.broadcast(mean))
        .agg(F.sum(F.col("w") * residual**2).alias("res"), F.sum(F.col("w") * (F.col("y") - F.col("wmean")) ** 2).alias("var"), F.max("total").alias("total"))
    )
    out = line.crossJoin(loo).crossJoin(spread).where((F.col("n") >= 4) & (F.col("total") > 0) & (F.col("folds") > 0))
    return out.select(
        "intercept", "slope", F.sqrt(F.coalesce(F.try_divide("le", "lw"), F.lit(0.0))).alias("residual_sd"), F.col("n").alias("n_stores"),
        F.coalesce(1.0 - F.try_divide("res", "var"), F.lit(0.0)).alias("r2"),
    )


def claim_calibration(first: DataFrame, second: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The line from the second source's raw means to the first's, over the stores that both know well enough. first,
    second: store, n, score, valenced."""
    enough = lambda d: d.where((F.col("valenced") > 0) & (F.col("n") >= s.min_claims_to_calibrate))
    pairs = enough(first).alias("a").join(enough(second).alias("b"), "store").select(
        F.col("store").alias("id"), (F.col("b.score") / F.col("b.valenced")).alias("x"), (F.col("a.score") / F.col("a.valenced")).alias("y"), F.col("a.valenced").alias("w")
    )
    return calibrate(pairs)


def combine_claims(first: DataFrame, second: DataFrame, keys: Sequence[str], fit: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Two sources of claims, full outer by keys, on the first's scale. fit: one row, a calibration; without one no rows."""
    keys = list(keys)
    side = lambda d, i: d.select(*keys, F.col("score").alias(f"s{i}"), F.col("valenced").alias(f"w{i}"))
    rows = side(first, 1).join(side(second, 2), keys, "full").crossJoin(F.broadcast(fit))
    one, two = F.col("w1") > 0, F.col("w2") > 0
    return combine(
        rows, keys, F.when(one, F.col("s1") / F.col("w1")), F.when(one, first_variance(F.col("w1"))),
        F.when(two, apply_line(F.col("s2") / F.col("w2"))), F.when(two, claim_variance(F.col("w2"))), s,
    )


def apply_line(x: Column) -> Column:
    """On the first source's scale, kept within it. The calibration's columns are at hand."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("intercept") + F.col("slope") * x))


def first_variance(weight: Column) -> Column:
    return 1.0 / F.greatest(weight, F.lit(EPS))


def star_variance(n_eff: Column) -> Column:
    return (F.col("slope") * 0.6 / F.sqrt(F.greatest(n_eff, F.lit(1.0)))) ** 2 + F.col("residual_sd") ** 2


def claim_variance(weight: Column) -> Column:
    return F.col("slope") ** 2 / F.greatest(weight, F.lit(EPS)) + F.col("residual_sd") ** 2


def combine(df: DataFrame, keys: Sequence[str], value_1: Column, var_1: Column, value_2: Column, var_2: Column, s: Settings = Settings(), digits: int = 4) -> DataFrame:
    """keys, v, se, share, gap, conflict, r, g: both values weighted by precision, then pulled once toward neutral.

    A null value is an absent source; rows without either are left out. With the second absent v is score / (weight + 2).
    """
    one, two = value_1.isNotNull(), value_2.isNotNull()
    p1 = F.when(one, 1.0 / var_1).otherwise(0.0)
    p2 = F.when(two, 1.0 / var_2).otherwise(0.0)
    rows = df.withColumns({"_v1": value_1, "_v2": value_2, "_p1": p1, "_p2": p2, "_s": var_1 + var_2}).where(one | two)
    precision = F.col("_p1") + F.col("_p2")
    raw = (F.coalesce(F.col("_v1") * F.col("_p1"), F.lit(0.0)) + F.coalesce(F.col("_v2") * F.col("_p2"), F.lit(0.0))) / precision
    both = F.col("_v1").isNotNull() & F.col("_v2").isNotNull()
    gap = F.when(both, F.col("_v2") - F.col("_v1")).otherwise(0.0)
    return rows.select(
        *keys, F.round(raw * precision / (precision + s.shrinkage), digits).alias("v"), F.round(F.sqrt(1.0 / (precision + s.shrinkage)), digits).alias("se"),
        F.round(F.col("_p1") / precision, digits).alias("share"), (F.round(gap, digits) + F.lit(0.0)).alias("gap"),
        F.coalesce(both & (F.abs(gap) > s.disagreement_sigmas * F.sqrt("_s")), F.lit(False)).alias("conflict"),
        F.round("_v1", digits).alias("r"), F.round("_v2", digits).alias("g"),
    )
