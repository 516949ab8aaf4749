"""Scene and keyframe documents from scenes, subtitle cues and OCR records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.functions import text as X
from reelspark.operators.interval import overlap_join, point_join

BBOX = "array<array<double>>"
PREFERENCES = ("vi", "en", "vi-orig")


def clean_cues(cues: DataFrame, repair: bool = True) -> DataFrame:
    """Cues with clean (and, with ``repair``, re-encoded) non-empty text and an end not before the start; a null start leaves a cue out."""
    out = cues.filter("video_id is not null and start_seconds is not null").withColumn("text", X.clean_text(F.col("text"), repair)).filter("length(text) > 0")
    return out.withColumn("end_seconds", F.greatest("end_seconds", "start_seconds")).withColumn("language", F.coalesce("language", F.lit("unknown")))


def clean_ocr_lines(ocr: DataFrame, min_confidence: float = 0.5, repair: bool = True) -> DataFrame:
    """``ocr_id, video_id, scene_id, frame_index, line_no, text, confidence, bbox, key`` of the lines that count.

    A line counts with enough confidence (none counts 0) and a key that is not empty and new in its record.
    """
    rows = ocr.select("ocr_id", "video_id", "scene_id", "frame_index", F.posexplode("lines").alias("line_no", "l"))
    rows = rows.select("ocr_id", "video_id", "scene_id", "frame_index", "line_no", X.clean_text(F.col("l.text"), repair).alias("text"), F.coalesce("l.confidence", F.lit(0.0)).alias("confidence"), F.coalesce("l.bbox", F.array().cast(BBOX)).alias("bbox"))
    rows = rows.withColumn("key", X.normalized_key(F.col("text"))).filter((F.col("confidence") >= min_confidence) & (F.length("key") > 0))
    first = F.row_number().over(Window.partitionBy("ocr_id", "key").orderBy("line_no"))
    return rows.withColumn("n", first).filter("n = 1").drop("n")


def repeated_keys(lines: DataFrame, records: DataFrame, ratio: float = 0.5, min_count: int = 3) -> DataFrame:
    """``video_id, key, frames`` of lines in so many of a video's records that they are a watermark.

    The threshold is max(``min_count``, the records of the video x ``ratio``, rounded up).
    """
    total = records.groupBy("video_id").agg(F.count(F.lit(1)).alias("records"))
    counted = lines.groupBy("video_id", "key").agg(F.countDistinct("ocr_id").alias("frames"))
    return counted.join(total, "video_id").filter(F.col("frames") >= F.greatest(F.lit(min_count), F.floor(F.col("records") * ratio + 0.999999))).select("video_id", "key", "frames")


def keyframes(ocr: DataFrame, scenes: DataFrame, lines: DataFrame, repeated: DataFrame, source_fps: float | None = None) -> DataFrame:
    """One row for each OCR record with a frame: times, kept lines, removed lines and mean confidence.

    ``timestamp_seconds`` = frame / fps, or the scene's start without fps; ``scene_local_time_seconds`` is not negative.
    """
    kept = lines.join(repeated.select("video_id", "key").withColumn("repeated", F.lit(True)), ["video_id", "key"], "left")
    ordered = lambda cond: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("line_no", "text", "confidence", "bbox")))), lambda x: F.struct(x["text"].alias("text"), x["confidence"].alias("confidence"), x["bbox"].alias("bbox")))
    per = kept.groupBy("ocr_id").agg(
        ordered(F.col("repeated").isNull()).alias("ocr_lines"), F.transform(ordered(F.col("repeated").isNotNull()), lambda x: x["text"]).alias("removed_repeated_ocr"),
        F.round(F.avg(F.when(F.col("repeated").isNull(), F.col("confidence"))), 6).alias("ocr_confidence_mean"),
    )
    start = F.greatest(F.coalesce("start_seconds", F.lit(0.0)), F.lit(0.0))
    at = F.when(F.col("fps") > 0, F.greatest(F.coalesce("frame_index", F.lit(0)), F.lit(0)) / F.col("fps")).otherwise(start)
    base = ocr.select("ocr_id", "video_id", "scene_id", "frame_index", F.col("keyframe_path").alias("path")).join(scenes.select("video_id", "scene_id", "fps", "start_seconds"), ["video_id", "scene_id"])
    base = base.join(per, "ocr_id", "left").withColumn("at", at)
    number = F.row_number().over(Window.partitionBy("video_id", "scene_id").orderBy("path", "ocr_id")) - 1
    return base.select(
        "video_id", "scene_id", "ocr_id", number.alias("keyframe_no"), "path", F.col("frame_index").alias("proxy_frame_index"),
        (F.bround(F.col("at") * source_fps).cast("bigint") if source_fps else F.lit(None).cast("bigint")).alias("source_frame_index"),
        F.bround("at", 3).alias("timestamp_seconds"), F.bround(F.greatest(F.col("at") - start, F.lit(0.0)), 3).alias("scene_local_time_seconds"),
        X.watch_url(F.col("video_id"), F.col("at")).alias("youtube_url"), F.coalesce("ocr_lines", F.array().cast("array<struct<text:string,confidence:double,bbox:array<array<double>>>>")).alias("ocr_lines"),
        F.array_join(F.transform("ocr_lines", lambda x: x["text"]), "\n").alias("ocr_text"), "ocr_confidence_mean", F.col("at").alias("exact_seconds"), F.coalesce("removed_repeated_ocr", F.array().cast("array<string>")).alias("removed_repeated_ocr"),
    )


def scene_cues(scenes: DataFrame, cues: DataFrame) -> DataFrame:
    """Cues of each scene that they overlap, a cue of equal times and key once: the interval join of the data model."""
    c = clean_cues(cues).select("video_id", "cue_id", F.col("start_seconds").alias("cue_start"), F.col("end_seconds").alias("cue_end"), "text", "language", "path")
    s = scenes.select("video_id", "scene_id", F.col("start_seconds").alias("scene_start"), F.col("end_seconds").alias("scene_end"))
    met = overlap_join(c, s, by=["video_id"], left_span=("cue_start", "cue_end"), right_span=("scene_start", "scene_end"))
    met = met.withColumn("key", X.normalized_key(F.col("text")))
    once = F.row_number().over(Window.partitionBy("video_id", "scene_id", "language", "cue_start", "cue_end", "key").orderBy("cue_id"))
    return met.withColumn("n", once).filter("n = 1").drop("n")


def preferred_text(cues: DataFrame, by: list[str], preferences: tuple[str, ...] = PREFERENCES) -> DataFrame:
    """``by, subtitle_language, subtitle_text``: the texts of the preferred language that has any, else of the first by name.

    Texts come in order of time, those with a key that occurred before are left out, joined by blanks.
    """
    order = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(p) for p in preferences]), F.col("language")), F.lit(0)), F.lit(len(preferences) + 1))
    chosen = F.first("language").over(Window.partitionBy(*by).orderBy(order, "language"))
    first = F.row_number().over(Window.partitionBy(*by, "key").orderBy("cue_start", "cue_end", "cue_id"))
    rows = cues.withColumn("chosen", chosen).filter("language = chosen and length(key) > 0").withColumn("n", first).filter("n = 1")
    listed = F.array_sort(F.collect_list(F.struct("cue_start", "cue_end", "cue_id", "text")))
    return rows.groupBy(*by).agg(F.first("chosen").alias("subtitle_language"), F.array_join(F.transform(listed, lambda x: x["text"]), " ").alias("subtitle_text"))


def subtitle_tracks(cues: DataFrame, by: list[str]) -> DataFrame:
    """``by, subtitle_tracks``: language to its cues in order of time."""
    cue = F.struct(F.bround("cue_start", 3).alias("start_seconds"), F.bround("cue_end", 3).alias("end_seconds"), "text", "path")
    per = cues.groupBy(*by, "language").agg(F.transform(F.array_sort(F.collect_list(F.struct("cue_start", "cue_end", "cue_id", cue.alias("c")))), lambda x: x["c"]).alias("cues"))
    return per.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("language", "cues")))).alias("subtitle_tracks"))


def joined_texts(*parts: Column) -> Column:
    """The non-empty parts, joined by newlines."""
    return F.array_join(F.array_compact(F.array(*[F.when(F.length(p) > 0, p) for p in parts])), "\n")


def scene_documents(scenes: DataFrame, cues: DataFrame, ocr: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """The nested scene documents: preferred subtitles, all tracks, keyframes with their OCR, and the combined text.

    A scene's OCR text is its keyframes' texts, each whole block once, joined by newlines.
    """
    lines = clean_ocr_lines(ocr, min_confidence)
    repeated = repeated_keys(lines, ocr)
    frames = keyframes(ocr, scenes, lines, repeated)
    met = scene_cues(scenes, cues)
    by = ["video_id", "scene_id"]
    local = point_join(
        frames.select(*by, "ocr_id", F.col("exact_seconds").alias("at")), met.select(*by, "cue_id", "cue_start", "cue_end", "text", "language", "key", "path"), by=by, at="at", span=("cue_start", "cue_end")
    )
    frames = frames.join(preferred_text(local, ["ocr_id"]), "ocr_id", "left").join(subtitle_tracks(local, ["ocr_id"]), "ocr_id", "left")
    blocks = frames.withColumn("bkey", X.normalized_key(F.col("ocr_text"))).filter("length(bkey) > 0")
    first = F.row_number().over(Window.partitionBy(*by, "bkey").orderBy("keyframe_no"))
    scene_ocr = blocks.withColumn("n", first).filter("n = 1").groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("keyframe_no", "ocr_text"))), lambda x: x["ocr_text"]), "\n").alias("ocr_text"))
    fields = ["keyframe_no", "path", "proxy_frame_index", "source_frame_index", "timestamp_seconds", "scene_local_time_seconds", "youtube_url", "subtitle_language", "subtitle_text", "subtitle_tracks", "ocr_text", "ocr_confidence_mean", "ocr_lines", "removed_repeated_ocr"]
    nested = frames.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*fields)), lambda x, y: (x["keyframe_no"] - y["keyframe_no"]).cast("int")).alias("keyframes"))
    watermark = repeated.groupBy("video_id").agg(F.sort_array(F.collect_set("key")).alias("repeated_ocr_keys_removed"))
    out = scenes.join(preferred_text(met, by), by, "left").join(subtitle_tracks(met, by), by, "left").join(scene_ocr, by, "left").join(nested, by, "left").join(watermark, "video_id", "left")
    subtitle, text = F.coalesce("subtitle_text", F.lit("")), F.coalesce("ocr_text", F.lit(""))
    return out.select(
        F.concat("video_id", F.lit(":"), "scene_id").alias("document_id"), *by, "start_frame", "end_frame", "start_seconds", "end_seconds", "duration_seconds",
        "keyframes", "subtitle_language", subtitle.alias("subtitle_text"), "subtitle_tracks", text.alias("ocr_text"), joined_texts(subtitle, text).alias("combined_text"),
        X.watch_url(F.col("video_id"), F.coalesce("start_seconds", F.lit(0.0))).alias("youtube_url"), F.coalesce("repeated_ocr_keys_removed", F.array().cast("array<string>")).alias("repeated_ocr_keys_removed"),
    )


def keyframe_documents(scene_docs: DataFrame) -> DataFrame:
    """One flat document for each keyframe of a scene document.

    Missing, empty or zero values fall back to the scene's: time, subtitle and address. The id adds ``frame-%06d``, or
    ``keyframe-%03d`` where the source frame is unknown.
    """
    k = scene_docs.select("document_id", "video_id", "scene_id", F.col("subtitle_text").alias("scene_subtitle"), F.col("start_seconds").alias("scene_start"), F.col("youtube_url").alias("scene_url"), F.posexplode("keyframes").alias("n", "k"))
    at = F.coalesce(F.expr("nullif(k.timestamp_seconds, 0)"), "scene_start", F.lit(0.0))
    token = F.when(F.col("k.source_frame_index").isNotNull(), F.format_string("frame-%06d", "k.source_frame_index")).otherwise(F.format_string("keyframe-%03d", "n"))
    subtitle = F.coalesce(F.expr("nullif(k.subtitle_text, '')"), "scene_subtitle", F.lit(""))
    ocr = F.coalesce("k.ocr_text", F.lit(""))
    return k.select(
        F.concat("document_id", F.lit(":"), token).alias("document_id"), F.col("document_id").alias("parent_document_id"), "video_id", "scene_id", at.alias("start_seconds"), at.alias("end_seconds"),
        F.col("k.source_frame_index").alias("source_start_frame"), F.col("k.source_frame_index").alias("source_end_frame"), subtitle.alias("subtitle_text"), ocr.alias("ocr_text"),
        joined_texts(subtitle, ocr).alias("combined_text"), F.coalesce(F.expr("nullif(k.youtube_url, '')"), "scene_url").alias("youtube_url"), F.col("k").alias("keyframe"), F.lit("keyframe").alias("level"),
    )


def best_keyframe(keyframes_col: str = "keyframes") -> Column:
    """The first keyframe with OCR text, else the first one, else null."""
    return F.coalesce(F.get(F.filter(keyframes_col, lambda k: F.length(k["ocr_text"]) > 0), F.lit(0)), F.get(F.col(keyframes_col), F.lit(0)))


def scene_records(bounds: DataFrame) -> DataFrame:
    """Scenes with an id by their order and an end after the start: ``video_id, start_frame, end_frame, start_seconds, end_seconds, fps``."""
    n = F.row_number().over(Window.partitionBy("video_id").orderBy("start_frame", "end_frame"))
    end = F.greatest(F.col("end_frame"), F.col("start_frame") + 1)
    by_frames = F.when(F.col("fps") > 0, (end - F.col("start_frame")) / F.col("fps"))
    return bounds.select("video_id", F.format_string("scene-%03d", n).alias("scene_id"), "start_frame", end.alias("end_frame"), "start_seconds", "end_seconds", F.greatest(F.col("end_seconds") - F.col("start_seconds"), by_frames).alias("duration_seconds"))


def manifest(docs: DataFrame, **settings: object) -> DataFrame:
    """One row of counts over scene documents, with the settings that made them."""
    has = lambda c: F.count_if(F.length(c) > 0)
    counts = docs.agg(
        F.countDistinct("video_id").alias("videos"), F.count(F.lit(1)).alias("documents"), has("subtitle_text").alias("with_subtitles"), has("ocr_text").alias("with_ocr"), has("combined_text").alias("searchable"),
    )
    return reduce(lambda df, kv: df.withColumn(kv[0], F.lit(kv[1])), settings.items(), counts)
