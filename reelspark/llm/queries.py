"""The queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.llm import lookalike, mixing, mojibake, names, nearest_time, neighbours, packing, pii, rank_fusion

CAPACITY = 2048
SCORES = {"bm25_score": (1.0, False), "semantic_score": (1.0, True), "entity_score": (1.0, True), "reranker_score": (1.0, True)}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _linked(spark: SparkSession, sf: str) -> DataFrame:
    aliases = table(spark, sf, "entity_aliases").select(F.col("alias_id").alias("id"), "canonical", "aliases")
    spellings = F.concat(F.array("canonical"), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = aliases.select("id", F.explode(spellings).alias("name"))
    mentions = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.explode("entities.text").alias("name"))
    return names.link_names(rows, mentions)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return names.linked_pairs(_linked(spark, sf))


def p1_entities(spark: SparkSession, sf: str) -> DataFrame:
    return _linked(spark, sf)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    at = nearest_time.ocr_on_video_clock(table(spark, sf, "ocr_records"), table(spark, sf, "scenes"))
    middle = nearest_time.cue_middle(F.col("start_seconds"), F.col("end_seconds"))
    found = nearest_time.nearest_in_time(
        at, table(spark, sf, "subtitle_cues"), by=["video_id"], left_time=F.col("at"), right_time=middle, left_id="ocr_id", right_id="cue_id", tolerance=1.5
    )
    return found.select("ocr_id", "cue_id")


def p3_fused(spark: SparkSession, sf: str) -> DataFrame:
    fused = rank_fusion.fuse_scores(table(spark, sf, "search_hits"), group="query_id", item="document_id", scores=SCORES)
    return fused.select("query_id", "document_id", F.round("fused_score", 6).alias("fused_score"), F.col("n_scores").cast("bigint").alias("n_scores"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    fused = rank_fusion.fuse_scores(table(spark, sf, "search_hits"), group="query_id", item="document_id", scores=SCORES)
    return fused.filter("fused_rank <= 5").select("query_id", "document_id")


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "embeddings_cache").select("cache_id", "provider", "model", "dimension", "vector")
    return v.filter(neighbours.usable(F.col("vector"), F.col("dimension")))


_MODEL = ["provider", "model", "dimension"]


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    near = neighbours.similar_vectors(_vectors(spark, sf), id="cache_id", vector="vector", groups=_MODEL, k=5, min_cosine=0.9)
    found = neighbours.mutual(near)
    return found.select(F.col("id_a").alias("cache_id_a"), F.col("id_b").alias("cache_id_b"))


def p4_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The five most similar rows of every row of the stated set (ids divisible by 20) among all rows, however far."""
    near = neighbours.similar_vectors(_vectors(spark, sf), id="cache_id", vector="vector", groups=_MODEL, k=5, query=F.col("cache_id") % 20 == 0, sure=0.8)
    return near.select(F.col("id_a").alias("query_id"), F.col("id_b").alias("cache_id"), F.round("cosine", 6).alias("similarity"), F.col("place").cast("int").alias("place"))


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    parts = (("documents", "doc_id", "combined_text"), ("ocr_records", "ocr_id", "text"), ("subtitle_cues", "cue_id", "text"))
    frames = [table(spark, sf, t).select(F.lit(t).alias("src"), F.col(i).alias("id"), F.col(c).alias("text")) for t, i, c in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return lookalike.same_look_pairs(_texts(spark, sf))


def p5_consistent(spark: SparkSession, sf: str) -> DataFrame:
    return lookalike.consistent(_texts(spark, sf)).select("src", "id", "canonical")


def p5_members(spark: SparkSession, sf: str) -> DataFrame:
    return lookalike.variant_members(_texts(spark, sf))


def _maybe_garbled(spark: SparkSession, sf: str) -> DataFrame:
    parts = (("documents", "doc_id", "subtitle_text"), ("documents", "doc_id", "ocr_text"), ("subtitle_cues", "cue_id", "text"))
    frames = [table(spark, sf, t).select(F.lit(f"{t}.{c}").alias("src"), F.col(i).alias("rec_id"), F.col(c).alias("text")) for t, i, c in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return mojibake.restore(_maybe_garbled(spark, sf)).select("src", "rec_id")


def p6_restored(spark: SparkSession, sf: str) -> DataFrame:
    return mojibake.restore(_maybe_garbled(spark, sf))


def p6_mapping(spark: SparkSession, sf: str) -> DataFrame:
    texts = _maybe_garbled(spark, sf).filter("length(text) > 0")
    return mojibake.mapping(mojibake.learn(texts)).select("src", "unit", "letter", F.round("weight", 3).alias("weight"))


def p7_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), capacity=CAPACITY)


def p7_containers(spark: SparkSession, sf: str) -> DataFrame:
    return packing.containers(p7_packing(spark, sf), CAPACITY)


def p8_selection(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(mixing.sized_documents(table(spark, sf, "documents")), table(spark, sf, "mix_targets"), id="doc_id", source="source", size="n_tokens")


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.shares(p8_selection(spark, sf), table(spark, sf, "mix_targets"))


def _pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    entities = docs.select(F.explode("entities").alias("e")).select("e.*")
    return pii.find_pii(docs, entities, id="doc_id", text="text")


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return _pii(spark, sf).select("doc_id", "line_no", "pii_type").distinct()


def p9_redacted(spark: SparkSession, sf: str) -> DataFrame:
    return pii.redact(table(spark, sf, "documents"), _pii(spark, sf), id="doc_id", text="text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_entities": p1_entities,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_fused": p3_fused,
    "p4_found": p4_found,
    "p4_neighbours": p4_neighbours,
    "p5_found": p5_found,
    "p5_consistent": p5_consistent,
    "p5_members": p5_members,
    "p6_found": p6_found,
    "p6_restored": p6_restored,
    "p6_mapping": p6_mapping,
    "p7_packing": p7_packing,
    "p7_containers": p7_containers,
    "p8_selection": p8_selection,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_redacted": p9_redacted,
}
