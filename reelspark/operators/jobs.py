"""State of processing jobs as tables of events: latest state, histograms, timings, work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


STAGES = ("download", "proxy", "scene", "keyframe", "ocr", "gemini")
URL_JOBS_DDL = "url string, status string, error string, video_ids array<string>, seconds double, created_at string, updated_at string"
VIDEO_JOBS_DDL = f"video_id string, url string, {', '.join(f'{s}_status string' for s in STAGES)}, error string, timings map<string,double>, created_at string, updated_at string"


def job_tables(spark: SparkSession, old: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The job tables: empty ones, or ``old`` ones brought to today's columns (a status that they lack is pending)."""
    out = {}
    for name, ddl in (("url_jobs", URL_JOBS_DDL), ("video_jobs", VIDEO_JOBS_DDL)):
        wanted = spark.createDataFrame([], ddl)
        have = (old or {}).get(name)
        if have is None:
            out[name] = wanted
        else:
            missing = lambda f: F.lit("pending" if f.name.endswith("status") else None).cast(f.dataType)
            out[name] = have.select(*[F.col(f.name).cast(f.dataType) if f.name in have.columns else missing(f).alias(f.name) for f in wanted.schema])
    return out


def enqueue(url_jobs: DataFrame, urls: DataFrame, now: str) -> DataFrame:
    """``url_jobs`` with the addresses of ``urls`` (``url``) that it lacks, as pending jobs."""
    new = urls.select("url", F.lit("pending").alias("status"), F.array().cast("array<string>").alias("video_ids"), F.lit(now).alias("created_at"), F.lit(now).alias("updated_at"))
    return insert_new(url_jobs, new, ["url"])


def rows_for_stage(jobs: DataFrame, stage: str, force: bool = False) -> DataFrame:
    """The jobs whose stage is still to be done, in the order of their creation: not done and, for videos, without an error; all with ``force``."""
    if force:
        return jobs.orderBy("created_at")
    open_ = F.coalesce(F.col("status" if stage == "download" else f"{stage}_status"), F.lit("pending")) != "done"
    return jobs.filter(open_ if stage == "download" else open_ & F.col("error").isNull()).orderBy("created_at")


def mark_urls(url_jobs: DataFrame, video_jobs: DataFrame, results: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """Both tables after ``results`` (``url, status, error, video_ids, seconds``; one row for each address).

    The videos of addresses that are done get a job each. A job that there is keeps the stages that are done; its proxy and
    summary are pending else, its error is forgotten. Of a video under several addresses the last address by name counts.
    """
    r = results.select("url", *[F.col(c).alias(f"__{c}") for c in ("status", "error", "video_ids", "seconds")], F.lit(True).alias("__hit"))
    j = url_jobs.join(r, "url", "left")
    new_of = lambda c: F.when(F.col("__hit"), F.coalesce(f"__{c}", F.array().cast("array<string>")) if c == "video_ids" else F.col(f"__{c}")).otherwise(F.col(c)).alias(c)
    urls = j.select("url", *[new_of(c) for c in ("status", "error", "video_ids", "seconds")], "created_at", F.when(F.col("__hit"), F.lit(now)).otherwise(F.col("updated_at")).alias("updated_at"))
    done = fan_out(results.filter("status = 'done'")).groupBy("video_id").agg(F.max("url").alias("__url"))
    v = video_jobs.join(done, "video_id", "full")
    hit, old = F.col("__url").isNotNull(), F.col("created_at").isNotNull()
    kept = lambda c: F.when(~hit, F.col(c)).when(F.col(c) == "done", "done").otherwise("pending")
    as_is = lambda c: F.when(hit & ~old, F.lit("pending")).otherwise(F.col(c))
    status = {s: kept(f"{s}_status") if s in ("proxy", "gemini") else as_is(f"{s}_status") for s in STAGES} | {"download": F.when(hit, F.lit("done")).otherwise(F.col("download_status"))}
    videos = v.select(
        "video_id", F.when(hit, F.col("__url")).otherwise(F.col("url")).alias("url"), *[status[s].alias(f"{s}_status") for s in STAGES], F.when(hit, F.lit(None).cast("string")).otherwise(F.col("error")).alias("error"),
        F.coalesce("timings", F.create_map().cast("map<string,double>")).alias("timings"), F.coalesce("created_at", F.lit(now)).alias("created_at"), F.when(hit, F.lit(now)).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    return urls, videos


def mark_stage(video_jobs: DataFrame, stage: str, results: DataFrame, now: str) -> DataFrame:
    """``video_jobs`` after a stage's ``results`` (``video_id, status, error, seconds``): status, error and the stage's time."""
    r = results.select("video_id", F.col("status").alias("__status"), F.col("error").alias("__error"), F.col("seconds").alias("__seconds"))
    j, hit = video_jobs.join(r, "video_id", "left"), F.col("__status").isNotNull()
    others = F.map_filter(F.coalesce("timings", F.create_map().cast("map<string,double>")), lambda k, _: k != stage)
    new = {f"{stage}_status": F.col("__status"), "error": F.col("__error"), "timings": F.map_concat(others, F.create_map(F.lit(stage), F.bround("__seconds", 3))), "updated_at": F.lit(now)}
    return j.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in video_jobs.columns])


def stages_between(start_at: str, stop_after: str | None = None) -> list[str]:
    """The stages from one to another, both included; an error where the second comes before the first."""
    first, last = STAGES.index(start_at), STAGES.index(stop_after or STAGES[-1])
    if last < first:
        raise ValueError("the last stage comes before the first")
    return list(STAGES[first : last + 1])


def without_outputs(work: DataFrame, outputs: DataFrame, key: str, force: bool = False) -> DataFrame:
    """The work whose output is not there yet (all with ``force``): an anti-join with the keys of the outputs."""
    return work if force else work.join(outputs.select(key).distinct(), key, "left_anti")


def addresses(video_jobs: DataFrame, videos: DataFrame) -> DataFrame:
    """``video_id, url`` of videos; a video without a job or without a web address is an error."""
    met = videos.select("video_id").join(video_jobs.select("video_id", "url"), "video_id", "left")
    bad = F.concat(F.lit("no web address for "), "video_id")
    return met.select("video_id", F.when(F.coalesce(F.startswith("url", F.lit("http")), F.lit(False)), F.col("url")).otherwise(F.raise_error(bad)).alias("url"))


def frame_of_path(path: Column) -> Column:
    """The frame number in a file name (``frame-000123.jpg``), null without one."""
    return F.nullif(F.regexp_extract(path, r"frame-(\d+)[^/\\]*$", 1), F.lit("")).cast("bigint")


def scene_of_path(path: Column) -> Column:
    """The scene that a file's folder names (``scene-012``), else the folder's name."""
    folder = F.regexp_extract(path, r"([^/\\]+)[/\\][^/\\]*$", 1)
    number = F.regexp_extract(folder, r"scene-(\d+)", 1)
    return F.when(number != "", F.concat(F.lit("scene-"), number)).otherwise(folder)


def relative_path(path: Column, root: str) -> Column:
    """The path below ``root``; a path elsewhere as it is."""
    base = root.rstrip("/\\")
    inside = F.startswith(path, F.lit(base + "/")) | F.startswith(path, F.lit(base + "\\"))
    return F.when(inside, F.substr(path, F.lit(len(base) + 2))).otherwise(path)


def languages(value: str) -> list[str]:
    """The languages of a comma-separated list; none is an error."""
    out = [x.strip() for x in value.split(",") if x.strip()]
    if not out:
        raise ValueError("no language is named")
    return out


def to_translate(paths: DataFrame, target: str, path: str = "path") -> DataFrame:
    """Subtitle files that are neither in the target language nor kept originals, by the end of their names."""
    stem = F.lower(F.regexp_replace(F.regexp_extract(path, r"([^/\\]+)$", 1), r"\.[^.]*$", ""))
    low = target.lower()
    there = F.endswith(F.concat(F.lit("."), stem), F.lit(f".{low}")) | F.endswith(stem, F.lit(f"-{low}"))
    return paths.filter(~there & ~F.endswith(stem, F.lit("-orig")))


def latest_state(events: DataFrame, key: str, stage: str, status: str, at: str, tie: str) -> DataFrame:
    """``key, stage, status, at`` of the last event of each key and stage; partial aggregates, no sort of a key's history."""
    last = F.max_by(F.struct(F.col(status).alias("status"), F.col(at).alias("at")), F.struct(at, tie))
    return events.filter(F.col(key).isNotNull()).groupBy(key, stage).agg(last.alias("s")).select(key, stage, "s.status", "s.at")


def stage_columns(states: DataFrame, key: str, stage: str, stages: list[str]) -> DataFrame:
    """One row for each key with a column of its status for each stage."""
    return states.groupBy(key).pivot(stage, stages).agg(F.first("status"))


def status_histogram(states: DataFrame, stage: str) -> DataFrame:
    return states.groupBy(stage, "status").agg(F.count(F.lit(1)).alias("jobs"))


def stage_timings(events: DataFrame, key: str, stage: str, seconds: str) -> DataFrame:
    """``key, timings``: a map of stage to seconds spent, to three decimals."""
    per = events.groupBy(key, stage).agg(F.round(F.sum(seconds), 3).alias("s"))
    return per.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(stage, "s")))).alias("timings"))


def upsert(table: DataFrame, new: DataFrame, key: list[str], keep: list[str] | None = None) -> DataFrame:
    """``table`` with the rows of ``new`` in place of its own; columns in ``keep`` keep the old value where there is one."""
    if keep:
        old = table.select(*key, *[F.col(c).alias(f"__{c}") for c in keep])
        new = new.join(old, key, "left").select(*[F.coalesce(f"__{c}", c).alias(c) if c in keep else c for c in new.columns])
    return table.join(new.select(*key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def insert_new(table: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``table`` and those rows of ``new`` whose key it lacks, each key once."""
    return table.unionByName(new.dropDuplicates(key).join(table.select(*key), key, "left_anti"), allowMissingColumns=True)


def runnable(states: DataFrame, key: str, stage: str, wanted: str, needs: list[str], force: bool = False) -> DataFrame:
    """Keys whose ``needs`` stages are done and whose ``wanted`` stage is not (all of the former with ``force``)."""
    done = lambda s: F.max((F.col(stage) == s) & (F.col("status") == "done"))
    flags = states.groupBy(key).agg(*[F.coalesce(done(s), F.lit(False)).alias(f"n{i}") for i, s in enumerate(needs)], F.coalesce(done(wanted), F.lit(False)).alias("has"))
    for i in range(len(needs)):
        flags = flags.filter(f"n{i}")
    return (flags if force else flags.filter("not has")).select(key)


def fan_out(jobs: DataFrame, key: str = "url", ids: str = "video_ids") -> DataFrame:
    """One row for each distinct video of each job, with its first place in the list."""
    return jobs.select(key, F.posexplode(ids).alias("place", "video_id")).filter("video_id is not null").groupBy(key, "video_id").agg(F.min("place").alias("place"))


def merge_outputs(records: DataFrame, states: DataFrame, key: str, stage: str, wanted: str) -> DataFrame:
    """The records of keys whose stage is done, in order of key."""
    done = states.filter((F.col(stage) == wanted) & (F.col("status") == "done")).select(key)
    return records.join(done, key, "left_semi").orderBy(key)
