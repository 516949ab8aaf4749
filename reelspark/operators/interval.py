"""Interval joins on a media time line, bucketed so that a long recording does not end in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _spread(df: DataFrame, start: str, end: str, bucket: float) -> DataFrame:
    """Rows with ``__b`` for each time bucket that they touch and ``__b0`` for the first one."""
    lo, hi = F.floor(F.col(start) / bucket), F.floor(F.col(end) / bucket)
    return df.filter(f"{start} is not null and {end} is not null and {end} >= {start}").withColumn("__b0", lo).withColumn("__b", F.explode(F.sequence(lo, hi)))


def overlap_join(left: DataFrame, right: DataFrame, *, by: list[str], left_span: tuple[str, str], right_span: tuple[str, str], closed: bool = False, bucket: float = 60.0) -> DataFrame:
    """Pairs of equal ``by`` values whose spans overlap; open ends by default, so spans that only touch are no pair.

    Both sides are copied to every time bucket they touch and joined on key and bucket; a pair is kept in the first
    bucket that both touch, so that no distinct is needed. Columns other than ``by`` must have different names. Rows
    with a null in the key or span, or with an end before the start, have no partner.
    """
    ls, le = left_span
    rs, re_ = right_span
    a, b = _spread(left, ls, le, bucket).withColumnRenamed("__b0", "__la"), _spread(right, rs, re_, bucket).withColumnRenamed("__b0", "__lb")
    meets = (F.col(le) >= F.col(rs)) & (F.col(ls) <= F.col(re_)) if closed else (F.col(le) > F.col(rs)) & (F.col(ls) < F.col(re_))
    return a.join(b, [*by, "__b"]).filter(meets & (F.col("__b") == F.greatest("__la", "__lb"))).drop("__b", "__la", "__lb")


def point_join(points: DataFrame, spans: DataFrame, *, by: list[str], at: str, span: tuple[str, str], bucket: float = 60.0) -> DataFrame:
    """Pairs of a point and each span with start <= point <= end."""
    s, e = span
    p = points.filter(F.col(at).isNotNull()).withColumn("__b", F.floor(F.col(at) / bucket))
    return p.join(_spread(spans, s, e, bucket).drop("__b0"), [*by, "__b"]).filter(F.col(at).between(F.col(s), F.col(e))).drop("__b")
