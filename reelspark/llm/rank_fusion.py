"""Problem 3: one ranking from differently scaled scores by normal scores of empirical percentiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.session import materialize

# Coefficients of Acklam's rational approximation of the inverse normal distribution (published).
_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)
_LOW = 0.02425


def _horner(x: Column, coefficients: tuple[float, ...]) -> Column:
    return reduce(lambda acc, c: acc * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def inverse_normal(p: Column) -> Column:
    """Quantile of the standard normal distribution for 0 < p < 1, else null; relative error below 1.2e-9."""
    tail = lambda q: _horner(q, _C) / _horner(q, (*_D, 1.0))
    r = (p - 0.5) * (p - 0.5)
    return (
        F.when((p <= 0) | (p >= 1), None)
        .when(p < _LOW, tail(F.sqrt(-2 * F.log(p))))
        .when(p > 1 - _LOW, -tail(F.sqrt(-2 * F.log(1 - p))))
        .otherwise((p - 0.5) * _horner(r, _A) / _horner(r, (*_B, 1.0)))
    )


def _percentiles(long: DataFrame, split_rows: int, splits: int) -> DataFrame:
    """``g, m, s, pct`` for each distinct score ``s``: (mean rank of the ties - 1/2) / number of items.

    Works on distinct scores with their counts. A (group, score) column with more than ``split_rows`` of them is cut
    into ranges by approximate quantiles; the ranks stay exact, for a range's offset is a sum of counts.
    """
    counts = materialize(long.groupBy("g", "m", "s").agg(F.count(F.lit(1)).alias("c")), "counts")
    fractions = [i / splits for i in range(1, splits)]
    hot = (
        counts.groupBy("g", "m").agg(F.count(F.lit(1)).alias("nd"), F.percentile_approx("s", fractions, 1000).alias("cuts"))
        .filter(F.col("nd") > split_rows).select("g", "m", "cuts")
    )
    cut = counts.join(hot, ["g", "m"], "left").select(
        "g", "m", "s", "c", F.coalesce(F.size(F.filter("cuts", lambda x: x < F.col("s"))), F.lit(0)).alias("b")
    )
    before = (
        cut.groupBy("g", "m", "b").agg(F.sum("c").alias("bc"))
        .select("g", "m", "b",
                (F.sum("bc").over(Window.partitionBy("g", "m").orderBy("b")) - F.col("bc")).alias("off"),
                F.sum("bc").over(Window.partitionBy("g", "m")).alias("n"))
    )
    below = F.sum("c").over(Window.partitionBy("g", "m", "b").orderBy("s")) - F.col("c")
    return (
        cut.withColumn("below", below).join(before, ["g", "m", "b"])
        .select("g", "m", "s", ((F.col("off") + F.col("below") + F.col("c") / 2) / F.col("n")).alias("pct"))
    )


def fuse_scores(
    hits: DataFrame, *, group: str, item: str, scores: dict[str, tuple[float, bool]], split_rows: int = 20_000, splits: int = 64,
) -> DataFrame:
    """One combined order of the items of each group from several scores, whatever their ranges.

    ``scores`` maps a column to (weight, higher is better). Within a group every score becomes its empirical percentile
    with averaged ties, then the normal quantile of it; an item's fused score is the weighted mean over the scores that
    it has. Returns ``group, item, fused_score, n_scores, fused_rank`` with rank 1 the best and ties broken by item.

    A repeated item counts once, with its best value of each score. Rows without group or item are left out; NaN counts
    as null; an item without any score comes last with a null fused score. An empty table gives an empty result. Other
    columns are ignored, so the names used inside cannot clash with them.
    """
    value = lambda c, up: F.max(F.when(~F.isnan(F.col(f"`{c}`").cast("double")), (F.col(f"`{c}`").cast("double") if up else -F.col(f"`{c}`").cast("double")) + 0.0))
    # the best value after orientation, so higher is better from here on
    items = (
        hits.filter(F.col(f"`{group}`").isNotNull() & F.col(f"`{item}`").isNotNull())
        .groupBy(F.col(f"`{group}`").alias("g"), F.col(f"`{item}`").alias("i"))
        .agg(*[value(c, up).alias(f"s{k}") for k, (c, (_, up)) in enumerate(scores.items())])
    )
    # several branches read the items and the distinct scores: each is written once, or every branch would aggregate anew
    items = materialize(items, "items")
    stack = F.explode(F.array(*[F.struct(F.lit(k).alias("m"), F.lit(float(w)).alias("w"), F.col(f"s{k}").alias("s")) for k, (w, _) in enumerate(scores.values())]))
    long = items.select("g", "i", stack.alias("x")).select("g", "i", "x.*")
    pct = _percentiles(long.filter("s is not null"), split_rows, splits)
    scored = long.join(pct, ["g", "m", "s"], "left").select("g", "i", "w", inverse_normal(F.col("pct")).alias("z"))
    fused = scored.groupBy("g", "i").agg(
        (F.sum(F.col("w") * F.col("z")) / F.sum(F.when(F.col("z").isNotNull(), F.col("w")))).alias("fused_score"), F.count("z").alias("n_scores")
    )
    # sums of a few doubles differ in the last bits with their order: ties are decided on nine decimals
    rank = F.row_number().over(Window.partitionBy("g").orderBy(F.desc_nulls_last(F.round("fused_score", 9)), "i"))
    return fused.withColumn("fused_rank", rank).select(F.col("g").alias(group), F.col("i").alias(item), "fused_score", "n_scores", "fused_rank")
