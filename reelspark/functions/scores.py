"""Scores and other arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_tf(tf: Column) -> Column:
    return 1 + F.log(tf.cast("double"))


def smoothed_idf(df: Column, n: Column) -> Column:
    return F.log((n + 1) / (df + 1)) + 1


def bm25_idf(df: Column, n: Column) -> Column:
    """Never zero or negative: a term in more than half of the documents counts 1e-6."""
    idf = F.log((n - df + 0.5) / (df + 0.5))
    return F.when(idf <= 0, F.lit(1e-6)).otherwise(idf)


def clipped_sigmoid(score: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), score))))


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Position between the ends; 1 where they are equal."""
    return F.when(high > low, (value - low) / (high - low)).otherwise(1.0)


def clamp_ratio(value: Column, most: Column) -> Column:
    """value / most within 0 and 1; 0 where most is not positive."""
    return F.when(most > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), value / most))).otherwise(0.0)


def reciprocal_rank(rank: Column, weight: float, k: int) -> Column:
    return F.coalesce(F.lit(float(weight)) / (k + rank), F.lit(0.0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """The vector at length 1; a zero vector stays as it is."""
    norm = l2_norm(v)
    return F.transform(v, lambda x: F.when(norm > 0, x / norm).otherwise(x.cast("double")))


def normalized_histogram(v: Column) -> Column:
    total = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(v, lambda x: F.when(total > 0, x / total).otherwise(0.0))


def bhattacharyya(a: Column, b: Column) -> Column:
    """Distance of two histograms: the root of 1 - sum sqrt(a b) / sqrt(sum a sum b)."""
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)
    shared = F.aggregate(F.zip_with(a, b, lambda x, y: F.sqrt(x.cast("double") * y.cast("double"))), F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(F.greatest(F.lit(0.0), 1 - shared / F.sqrt(total(a) * total(b))))


def frame_quality(sharpness: Column, brightness: Column) -> Column:
    """Sharpness weighted by how near the brightness is to the middle of its range."""
    return sharpness * (0.5 + F.greatest(F.lit(0.0), 1 - F.abs(brightness - 127.5) / 127.5))


def correlation(a: Column, b: Column) -> Column:
    """Pearson's correlation of two histograms of equal length; 1 where one of them is constant, null where one is missing."""
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    n, sa, sb = F.size(a), total(a), total(b)
    shared, own_a, own_b = dot(a, b) - sa * sb / n, dot(a, a) - sa * sa / n, dot(b, b) - sb * sb / n
    spread = F.sqrt(F.greatest(own_a * own_b, F.lit(0.0)))
    return F.when(a.isNull() | b.isNull(), None).when(spread > 1e-12, shared / spread).otherwise(1.0)
