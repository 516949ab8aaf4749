"""Problem 2: match records of two tables by nearest time within a tolerance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_US = 1_000_000


def _micros(seconds: Column) -> Column:
    """Whole microseconds, so that equal gaps compare as equal; NaN and infinity count as null."""
    s = seconds.cast("double")
    return F.when(~F.isnan(s) & (F.abs(s) < 9e12), F.round(s * _US).cast("bigint"))


def nearest_in_time(
    left: DataFrame, right: DataFrame, *, by: list[str], left_time: Column, right_time: Column, left_id: str, right_id: str,
    tolerance: float, bucket_seconds: float = 120.0,
) -> DataFrame:
    """For each left row the right row of the same ``by`` values that lies nearest in time, at most ``tolerance`` away.

    Both tables are united, sorted by time within a time bucket of each key, and the last and the next right row are
    carried onto the left rows. Returns ``left_id, right_id, gap_seconds``; a left row without a partner is left out.

    The key alone would put a very long recording into one task, so rows are grouped by key and time bucket, and a right
    row near a bucket's edge is also put into the bucket beyond it: no pair within the tolerance is lost, and every
    left row is in just one bucket.

    Nulls in the key, either time, or either id leave the row out. Of equally near right rows the smallest ``right_id``
    wins. Repeated left rows give repeated results only if their ids differ. Empty tables give an empty result. Other
    columns of the inputs are ignored, whatever their names.
    """
    width, tol = round(max(bucket_seconds, 2 * tolerance) * _US), round(tolerance * _US)
    keys = [f"k{i}" for i in range(len(by))]
    key_cols = lambda df: [F.col(f"`{c}`").alias(k) for c, k in zip(by, keys)]
    bucket = lambda t: F.floor(t / width).cast("bigint")
    kept = lambda df: df.dropna()
    rows = kept(left.select(*key_cols(left), _micros(left_time).alias("t"), F.col(f"`{left_id}`").alias("lid"))).select(
        *keys, "t", bucket(F.col("t")).alias("b"), "lid", F.lit(None).cast(right.schema[right_id].dataType).alias("rid")
    )
    marks = kept(right.select(*key_cols(right), _micros(right_time).alias("t"), F.col(f"`{right_id}`").alias("rid"))).select(
        *keys, "t", F.explode(F.sequence(bucket(F.col("t") - tol), bucket(F.col("t") + tol))).alias("b"),
        F.lit(None).cast(left.schema[left_id].dataType).alias("lid"), "rid",
    )
    both = rows.unionByName(marks).withColumn("side", F.col("rid").isNull().cast("int"))
    part = Window.partitionBy(*keys, "b")
    mark = F.when(F.col("side") == 0, F.struct("t", "rid"))
    # at one time right rows stand before left rows, the smallest id last, so that it is the one carried
    carry = lambda order: F.last(mark, ignorenulls=True).over(part.orderBy(order, "side", F.desc("rid")).rowsBetween(Window.unboundedPreceding, 0))
    seen = both.withColumn("p", carry(F.asc("t"))).withColumn("n", carry(F.desc("t"))).filter("side = 1")
    gap = lambda c: F.abs(F.col(f"{c}.t") - F.col("t"))
    nearer = F.array_min(F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(gap(c).alias("g"), F.col(f"{c}.rid").alias("rid"))) for c in "pn"])))
    return (
        seen.select("lid", nearer.alias("m"))
        .filter(F.col("m.g") <= tol)
        .select(F.col("lid").alias(left_id), F.col("m.rid").alias(right_id), (F.col("m.g") / _US).alias("gap_seconds"))
    )


def cue_middle(start: Column, end: Column) -> Column:
    """The middle of a cue; an end before the start is read as the start, a null stays null."""
    return (start + F.when(end < start, start).otherwise(end)) / 2


def ocr_on_video_clock(ocr: DataFrame, scenes: DataFrame) -> DataFrame:
    """``video_id, ocr_id, at``: OCR records placed by their scene's start; records without a scene or a time are left out."""
    s = scenes.select("video_id", "scene_id", "start_seconds").dropna()
    o = ocr.select("video_id", "scene_id", "ocr_id", "scene_local_time_seconds").dropna()
    return o.join(s, ["video_id", "scene_id"]).select("video_id", "ocr_id", (F.col("start_seconds") + F.col("scene_local_time_seconds")).alias("at"))
