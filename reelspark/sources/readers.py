"""Sources: lists, JSON lines, subtitles, scene files, alias files, media listings, index tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark.functions import text as X
from reelspark.operators.incremental import Index

SCENES_DDL = (
    "video_id string, video_path string, fps double, frame_size array<int>, downscale int, frame_skip int, detector string, "
    "scenes array<struct<scene_id:string,start_frame:bigint,end_frame:bigint,start_seconds:double,end_seconds:double,duration_seconds:double>>"
)
OCR_DDL = "video_id string, scene_id string, frame_index bigint, scene_local_time_seconds double, keyframe_path string, text string, lines array<struct<text:string,confidence:double,bbox:array<array<double>>>>"
ALIAS_DDL = "canonical string, type string, aliases array<string>"
QUERY_DDL = "query_id string, query string, relevant_document_ids array<string>, query_type string, reviewed boolean, notes string"


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def url_list(spark: SparkSession, path: str, distinct: bool = False) -> DataFrame:
    """``n, url`` of the lines of a text file, trimmed, without blank and ``#`` lines; once each with ``distinct``, at their first place."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("n"), F.trim(F.regexp_replace("value", "^\\uFEFF", "")).alias("url"))
    lines = lines.filter("url <> '' and not startswith(url, '#')")
    return lines.groupBy("url").agg(F.min("n").alias("n")).select("n", "url") if distinct else lines


def parse_item(item: Column) -> Column:
    """``video_id=url`` or a bare address as a struct of id and url; the id from ``v=`` or the last path part."""
    pair = item.rlike("^[A-Za-z0-9_-]+=https?://")
    url = F.when(pair, F.regexp_extract(item, "^[^=]+=(.*)$", 1)).otherwise(item)
    by_query = F.regexp_extract(url, r"[?&]v=([A-Za-z0-9_-]+)", 1)
    found = F.when(pair, F.regexp_extract(item, "^([^=]+)=", 1)).when(by_query != "", by_query).otherwise(F.regexp_extract(url, r"/([A-Za-z0-9_-]+)/?(?:\?.*)?$", 1))
    return F.struct(found.alias("video_id"), url.alias("url"))


def json_lines(spark: SparkSession, path: str, schema: str, required: bool = True, strict: bool = True) -> DataFrame:
    """JSON lines with a fixed schema, a byte-order mark at the beginning or not. A missing path is an error, or no rows unless
    ``required``.

    ``strict`` fails at a malformed line and names it by its number; otherwise such lines come with ``_corrupt_record`` and nulls.
    Lines are numbered where one is malformed only: a file is then read as one text.
    """
    if not required and not exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).select(F.regexp_replace("value", "^\\uFEFF", "").alias("value")).filter("trim(value) <> ''")
    fields = spark.createDataFrame([], schema).schema
    parse = lambda c: F.from_json(c, schema + ", _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = lines.select("value", parse("value").alias("r"))
    if not strict:
        return parsed.select(*[F.col("r")[f.name].alias(f.name) for f in fields], F.col("r._corrupt_record").alias("_corrupt_record"))
    if not parsed.filter("r._corrupt_record is not null").isEmpty():
        whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("n", "value"))
        bad = whole.select("file", "n", F.regexp_replace("value", "^\\uFEFF", "").alias("value")).filter("trim(value) <> ''").select("file", "n", "value", parse("value").alias("r"))
        first = bad.filter("r._corrupt_record is not null").orderBy("file", "n").first()
        raise ValueError(f"{first.file}, line {first.n + 1}: malformed, no JSON object of the expected kind")
    return parsed.select(*[F.col("r")[f.name].alias(f.name) for f in fields])


def scene_files(spark: SparkSession, path: str) -> DataFrame:
    """One row for each scene of the scene files under ``path``."""
    meta = spark.read.schema(SCENES_DDL).option("multiLine", True).json(path)
    return meta.select("video_id", "fps", "detector", F.explode("scenes").alias("s")).select("video_id", "fps", "detector", "s.*")


def alias_file(spark: SparkSession, path: str) -> DataFrame:
    """Alias records of a JSON array; no rows where there is no file."""
    return spark.read.schema(ALIAS_DDL).option("multiLine", True).json(path) if exists(spark, path) else spark.createDataFrame([], ALIAS_DDL)


CUE_LINE = r"(\d{1,2}:\d{2}:\d{2}[,.]\d{3})\s*-->\s*(\d{1,2}:\d{2}:\d{2}[,.]\d{3})"


def _blocks(files: DataFrame) -> DataFrame:
    body = F.regexp_replace(F.regexp_replace("value", "^\\uFEFF", ""), "\r\n?", "\n")
    return files.select("path", F.posexplode(F.split(body, r"\n[ \t]*\n\s*")).alias("block_no", "block"))


def subtitle_texts(spark: SparkSession, path: str) -> DataFrame:
    """``path, value``: whole subtitle files."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.{srt,vtt}").select(F.input_file_name().alias("path"), "value")


def subtitle_cues(files: DataFrame, repair: bool = True) -> DataFrame:
    """``video_id, language, path, cue_no, start_seconds, end_seconds, text`` of SRT and VTT texts (``path, value``).

    A cue is what follows a time line up to a blank line, cleaned; cues without text are dropped and an end before the
    start becomes the start.
    """
    b = _blocks(files).filter(F.col("block").rlike(CUE_LINE))
    text = F.regexp_replace(F.regexp_extract("block", r"-->[^\n]*\n?((?s).*)$", 1), r"\s*\n\s*", " ")
    out = b.select(
        F.regexp_extract("path", r"([^/\\]+)[/\\][^/\\]+$", 1).alias("video_id"), X.subtitle_language(F.col("path")).alias("language"), "path", F.col("block_no").alias("cue_no"),
        X.timestamp_seconds(F.regexp_extract("block", CUE_LINE, 1)).alias("start_seconds"), X.timestamp_seconds(F.regexp_extract("block", CUE_LINE, 2)).alias("end_seconds"),
        X.clean_text(text, repair).alias("text"),
    )
    return out.filter("length(text) > 0").withColumn("end_seconds", F.greatest("start_seconds", "end_seconds"))


def subtitle_blocks(files: DataFrame) -> DataFrame:
    """``path, block_no, prefix, text``: every block with the lines up to its time line apart, so that a translation can be put back.

    A block without a time line (a header) is all prefix.
    """
    b = _blocks(files).withColumn("lines", F.split("block", "\n"))
    at = F.array_position(F.transform("lines", lambda x: F.contains(x, F.lit("-->"))), F.lit(True))
    return b.withColumn("at", at).select("path", "block_no", F.when(F.col("at") > 0, F.slice("lines", F.lit(1), F.col("at").cast("int"))).otherwise(F.col("lines")).alias("prefix"),
                                         F.when(F.col("at") > 0, F.array_join(F.slice("lines", F.col("at").cast("int") + 1, F.size("lines")), "\n")).otherwise("").alias("text"))


def media_files(spark: SparkSession, path: str, suffixes: tuple[str, ...] = ("mp4", "mkv", "webm"), with_content: bool = False) -> DataFrame:
    """``video_id, path, length`` (and ``content``) of the files with a suffix; the id is the directory's or the file's name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}").option("recursiveFileLookup", True).load(path)
    stem = F.regexp_extract("path", r"([^/\\]+)\.[^.]+$", 1)
    cols = [stem.alias("video_id"), "path", "length"] + (["content"] if with_content else [])
    return files.select(*cols)


def first_file(files: DataFrame) -> DataFrame:
    """The first path by name of each video."""
    return files.groupBy("video_id").agg(F.min("path").alias("path"))


def nested_ids(info: DataFrame, entries: str = "entries", id: str = "id") -> DataFrame:
    """The ids of a download result and of the entries of its playlists, nulls left out, however deep its type nests them:
    ``info`` has ``id, entries array<struct<id, entries array<...>>>``; what has entries of its own counts by them only."""
    leaves, now = [], info
    while True:
        deeper = entries in now.columns
        here = now.filter(F.col(entries).isNull()) if deeper else now
        leaves.append(here.select(F.col(id).cast("string").alias("video_id")))
        if not deeper:
            break
        now = now.select(F.explode(entries).alias("x")).filter("x is not null").select("x.*")
    out = leaves[0]
    for leaf in leaves[1:]:
        out = out.unionByName(leaf)
    return out.filter("video_id is not null")


def level_table(spark: SparkSession, root: str, level: str) -> DataFrame:
    """The index documents of a level: a partition of one table."""
    return spark.read.parquet(f"{root}/documents").filter(F.col("level") == level)


def index_tables(spark: SparkSession, root: str, level: str = "scene") -> Index:
    """The stored index of a level, as :func:`sinks.write_index` left it: searches over it read the postings of their terms only."""
    of = lambda name: spark.read.parquet(f"{root}/{name}/level={level}")
    return Index(level_table(spark, root, level), of("terms"), of("idf"), of("norms"), of("entities"), spark.read.parquet(f"{root}/aliases"), of("postings"), of("totals"))


def index_levels(spark: SparkSession, root: str) -> dict[str, Index]:
    """The stored indexes of all levels that there are."""
    return {level: index_tables(spark, root, level) for level in ("scene", "keyframe") if exists(spark, f"{root}/postings/level={level}")}


def vector_index(spark: SparkSession, root: str, level: str = "scene") -> tuple[DataFrame, DataFrame]:
    """The vectors of a level by position, and the one row that describes them."""
    return spark.read.parquet(f"{root}/vectors/level={level}"), spark.read.json(f"{root}/vectors_meta/level={level}")


def frame_scenes(scenes: DataFrame, frames: DataFrame) -> DataFrame:
    """Frames with their scene's start and the time within it: an equi-join on video and scene."""
    s = scenes.select("video_id", "scene_id", "fps", F.col("start_frame").alias("scene_frame"))
    local = F.when(F.col("fps") > 0, F.round(F.greatest(F.col("frame_index") - F.col("scene_frame"), F.lit(0)) / F.col("fps"), 3))
    return frames.join(s, ["video_id", "scene_id"]).withColumn("scene_local_time_seconds", local).drop("scene_frame", "fps")


def latest_by_path(ocr: DataFrame, order: str) -> DataFrame:
    """The last OCR record of each keyframe path, whatever its case and slashes."""
    key = F.lower(F.replace("keyframe_path", F.lit("/"), F.lit("\\")))
    last = F.row_number().over(Window.partitionBy("path_key").orderBy(F.desc(order)))
    return ocr.withColumn("path_key", key).filter("length(path_key) > 0").withColumn("n", last).filter("n = 1").drop("n")
