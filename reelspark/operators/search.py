"""End-to-end search of many queries: retrieve, fuse, find passages, rerank, thin out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.functions import text as X
from reelspark.operators import entities as E
from reelspark.operators import fusion as U
from reelspark.operators import lexical as L
from reelspark.operators import vectors as V
from reelspark.operators.incremental import Index
from reelspark.operators.planner import SearchSettings

Levels = dict[str, Index]


def embed_queries(queries: DataFrame, dimension: int, provider: str = "hashing") -> DataFrame:
    """``query_id, vector`` with the deterministic hashing embedding; other providers plug in here."""
    return queries.select("query_id", X.hashing_embedding(dimension)(X.prepared_query(F.col("query"), provider)).alias("vector"))


def retrieve(index: Index, queries: DataFrame, settings: SearchSettings, cache: DataFrame | None = None, query_vectors: DataFrame | None = None) -> dict[str, DataFrame]:
    """The ranked lists that the mode asks for; vectors only with a cache, query vectors and a weight above 0."""
    limit = settings.candidate_limit
    keys = E.query_entity_keys(queries, index.aliases)
    out = {}
    if settings.mode in ("bm25", "hybrid"):
        flagged = index.entities.join(keys, "canonical_key").select("query_id", "document_id").distinct()
        hits = L.bm25_search(index.documents, queries, limit, flagged, stored=index.postings, totals=index.totals)
        out["bm25"] = hits.select("query_id", "document_id", F.col("bm25_rank").alias("rank"), F.col("bm25_score").alias("score"))
    if settings.mode == "tfidf":
        hits = L.tfidf_search(index.terms, index.idf, index.norms, queries, limit)
        out["tfidf"] = hits.select("query_id", "document_id", F.col("tfidf_rank").alias("rank"), F.col("tfidf_score").alias("score"))
    if settings.mode in ("semantic", "hybrid") and cache is not None and query_vectors is not None and settings.semantic_weight > 0:
        hits = V.semantic_search(cache, query_vectors, limit).join(index.documents.select("document_id"), "document_id", "left_semi")
        out["semantic"] = hits.select("query_id", "document_id", F.col("semantic_rank").alias("rank"), F.col("semantic_score").alias("score"))
    if settings.mode in ("entity", "hybrid"):
        hits = E.entity_search(index.entities, index.documents, keys, limit)
        out["entity"] = hits.select("query_id", "document_id", F.col("entity_rank").alias("rank"), F.col("entity_score").alias("score"), F.col("entity_overlap").alias("overlap"))
    return out


def with_overlap(merged: DataFrame, entities: DataFrame, keys: DataFrame) -> DataFrame:
    """``merged`` with ``entity_overlap``: how many of the query's entities the document has, whichever list it came from."""
    own = merged.select("query_id", "document_id").join(entities.select("document_id", "canonical_key").distinct(), "document_id").join(keys, ["query_id", "canonical_key"])
    own = own.groupBy("query_id", "document_id").agg(F.count(F.lit(1)).cast("int").alias("__own"))
    out = merged.join(own, ["query_id", "document_id"], "left")
    return out.withColumn("entity_overlap", F.greatest(F.coalesce("__own", F.lit(0)), F.coalesce("entity_overlap", F.lit(0)))).drop("__own")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def search(
    index: Index | Levels, queries: DataFrame, settings: SearchSettings | None = None, cache: DataFrame | dict[str, DataFrame] | None = None, query_vectors: DataFrame | None = None,
    reranker: U.Reranker | None = None, keyframes: DataFrame | None = None,
) -> DataFrame:
    """``query_id, document_id, video_id, scene_id, start_seconds, final_score, final_rank, passage, level``, best first.

    ``index`` and ``cache`` are one level's or a mapping of levels; with several the lists of the levels that the settings name
    (``both``: all) are fused, reranked and thinned out together. ``reranker`` None skips reranking;
    :func:`fusion.overlap_reranker` is the deterministic stand-in for a model. A list that is missing takes no part in the
    fusion, but a search by vectors alone without them is an error, as is TF-IDF on keyframes. Wide columns are joined only
    to the few rows that are left.
    """
    s = settings or SearchSettings()
    levels = index if isinstance(index, dict) else {s.level if s.level != "both" else "scene": index}
    chosen = {k: v for k, v in levels.items() if s.level in (k, "both")}
    if not chosen:
        raise ValueError(f"no index of the level {s.level}")
    caches = cache if isinstance(cache, dict) else dict.fromkeys(chosen, cache)
    if s.mode == "semantic" and (query_vectors is None or all(caches.get(k) is None for k in chosen)):
        raise ValueError("a search by vectors needs a cache of vectors and the queries' vectors")
    if s.mode == "tfidf" and s.level != "scene":
        raise ValueError("TF-IDF is for scenes")
    found = [retrieve(ix, queries, s, caches.get(level), query_vectors) for level, ix in chosen.items()]
    lists = {name: _union([f[name] for f in found if name in f]) for name in {n for f in found for n in f}}
    for name in ("bm25", "semantic", "entity"):
        if name not in lists:
            lists[name] = queries.select("query_id", F.lit(None).cast("string").alias("document_id"), F.lit(None).cast("int").alias("rank"), F.lit(None).cast("double").alias("score")).filter("false")
    weights = {"bm25": s.bm25_weight, "semantic": s.semantic_weight, "entity": s.entity_weight}
    merged = U.merge_hits(lists)
    if s.mode == "hybrid":
        keys = E.query_entity_keys(queries, next(iter(chosen.values())).aliases)
        merged = with_overlap(merged, _union([ix.entities for ix in chosen.values()]), keys)
        hits = U.hybrid_rank(merged, weights, s.rrf_k, s.candidate_limit)
    else:
        scored = merged.withColumn("final_score", F.round(U.single_mode_score(s.mode, s.rrf_k), 9))
        hits = L.ranked(scored, [F.desc("final_score"), "document_id"], s.candidate_limit, "final_rank")
    columns = ["document_id", "video_id", "scene_id", "start_seconds", "subtitle_text", "combined_text"]
    wide = _union([ix.documents.select(*columns, F.lit(level).alias("level")) for level, ix in chosen.items()])
    hits = hits.select("query_id", "document_id", "final_score", "final_rank", "entity_overlap").join(wide, "document_id")
    if keyframes is not None:
        hits = hits.join(U.best_passages(hits, keyframes, queries).select("query_id", "document_id", "matched_passage"), ["query_id", "document_id"])
    else:
        hits = hits.withColumn("matched_passage", F.substring("combined_text", 1, 1800))
    if reranker is not None:
        pairs = hits.join(queries.select("query_id", "query"), "query_id")
        qt = F.array_distinct(X.index_terms(F.col("query")))
        coverage = F.when(F.size(qt) > 0, F.size(F.array_intersect(qt, X.index_terms(F.col("matched_passage")))) / F.size(qt)).otherwise(0.0)
        pairs = pairs.filter(F.col("final_rank") <= s.rerank_top).withColumn("reranker_score", reranker(F.col("query"), F.col("matched_passage"))).withColumn("coverage", coverage)
        blended = U.rerank_blend(pairs, s.rerank_top, s.rerank_min_final, s.rerank_max_drop)
        hits = blended.select("query_id", "document_id", "final_score", F.col("rerank_rank").alias("final_rank")).join(hits.drop("final_score", "final_rank"), ["query_id", "document_id"])
    thin = hits.select("query_id", "document_id", "video_id", "scene_id", F.coalesce("start_seconds", F.lit(0.0)).alias("start_seconds"), "final_score", "final_rank", X.snippet(F.col("matched_passage")).alias("passage"), X.index_terms(F.coalesce(F.expr("nullif(matched_passage, '')"), "combined_text")).alias("terms"), "level")
    kept = U.temporal_dedup(thin, s.dedupe_seconds)
    return L.ranked(kept.withColumnRenamed("final_rank", "__r"), ["__r", "document_id"], s.limit, "final_rank").drop("__r")


def by_levels(settings: SearchSettings, indexes: Levels, queries: DataFrame, **kw) -> DataFrame:
    """The search of each level that the settings name (``both``: all), fused to one ranking, with the level."""
    return search(indexes, queries, settings, **kw)
