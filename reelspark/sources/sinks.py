"""Sinks: documents, manifests, index tables, vectors and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions import scores as S
from reelspark.functions import text as X
from reelspark.operators.incremental import Index
from reelspark.operators.vectors import latest_vectors


def write_json(df: DataFrame, path: str, append: bool = False, by: str | None = None) -> None:
    """JSON lines, in place of what is there or added to it, in a directory for each value of ``by`` if given."""
    writer = df.write.mode("append" if append else "overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def write_manifest(row: DataFrame, path: str) -> None:
    row.coalesce(1).write.mode("overwrite").json(path)


def write_index(index: Index, root: str, level: str = "scene") -> None:
    """The index tables as Parquet; postings sorted by term, so that a search reads few row groups."""
    index.documents.withColumn("level", F.lit(level)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("level").parquet(f"{root}/documents")
    index.terms.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{root}/terms/level={level}")
    index.idf.write.mode("overwrite").parquet(f"{root}/idf/level={level}")
    index.norms.write.mode("overwrite").parquet(f"{root}/norms/level={level}")
    index.entities.repartitionByRange("canonical_key").sortWithinPartitions("canonical_key").write.mode("overwrite").parquet(f"{root}/entities/level={level}")
    index.aliases.write.mode("overwrite").parquet(f"{root}/aliases")
    if index.postings is not None and index.totals is not None:
        index.postings.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{root}/postings/level={level}")
        index.totals.write.mode("overwrite").parquet(f"{root}/totals/level={level}")


def write_vectors(cache: DataFrame, root: str, level: str = "scene") -> None:
    """Unit vectors of the cache's latest entries and their description (provider, model, dimension, count, metric)."""
    rows = latest_vectors(cache).select("document_id", "provider", "model", "dimension", S.unit(F.col("vector")).cast("array<float>").alias("vector"))
    rows.write.mode("overwrite").parquet(f"{root}/vectors/level={level}")
    meta = rows.groupBy("provider", "model", "dimension").agg(F.count(F.lit(1)).alias("count")).withColumn("metric", F.lit("inner_product")).withColumn("level", F.lit(level))
    meta.coalesce(1).write.mode("overwrite").json(f"{root}/vectors_meta/level={level}")


def rendered_subtitles(blocks: DataFrame) -> DataFrame:
    """``path, content`` of translated blocks (``path, block_no, prefix, text``) in their order, blank lines between them."""
    one = F.array_join(F.concat("prefix", F.when(F.length("text") > 0, F.array("text")).otherwise(F.array().cast("array<string>"))), "\n")
    return blocks.groupBy("path").agg(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", one.alias("t")))), lambda x: x["t"]), "\n\n"), F.lit("\n")).alias("content"))


def translated_path(path: Column, language: str) -> Column:
    """The path of a translation: the language in place of the original's, or added before the suffix."""
    return F.concat(F.regexp_replace(path, r"(?:\.[A-Za-z-]+)?\.(srt|vtt)$", ""), F.lit(f".{language}"), F.regexp_extract(path, r"(\.(?:srt|vtt))$", 1))


def job_log_name(url: Column) -> Column:
    """The log file name of a job: the first 12 digits of the address's SHA-1."""
    return F.concat(F.substring(F.sha1(url), 1, 12), F.lit(".log"))


def snippet(text: Column) -> Column:
    return X.snippet(text)
