"""Fusion of ranked lists, passages, reranking and temporal de-duplication, all for many queries at once."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.functions import scores as S
from reelspark.functions import text as X
from reelspark.operators.lexical import ranked

RRF_K = 60
WEIGHTS = {"bm25": 1.0, "semantic": 1.0, "entity": 0.35}


def merge_hits(lists: dict[str, DataFrame], id: str = "document_id") -> DataFrame:
    """The full outer merge of ranked lists: one row for each query and document.

    Each list has ``query_id, id, rank, score`` and, if it knows one, ``overlap``. The result has ``<name>_rank`` and
    ``<name>_score`` for each list, null where the list lacks the document, and the largest ``entity_overlap``.
    """
    parts = []
    for name, hits in lists.items():
        overlap = F.col("overlap") if "overlap" in hits.columns else F.lit(0)
        own = [F.col(c).alias(f"{n}_{c}") if n == name else F.lit(None).cast("int" if c == "rank" else "double").alias(f"{n}_{c}") for n in lists for c in ("rank", "score")]
        parts.append(hits.select("query_id", id, *own, overlap.cast("int").alias("entity_overlap")))
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    best = [F.min(f"{n}_rank").alias(f"{n}_rank") for n in lists] + [F.max(f"{n}_score").alias(f"{n}_score") for n in lists]
    return rows.groupBy("query_id", id).agg(*best, F.max("entity_overlap").alias("entity_overlap"))


def weighted_rrf(weights: dict[str, float] | None = None, k: int = RRF_K, overlap: Column | None = None) -> Column:
    """Sum of weight / (k + rank) over the lists that have the document, plus 0.005 x entity weight x overlap."""
    weights = weights or WEIGHTS
    overlap = F.col("entity_overlap") if overlap is None else overlap
    total = reduce(lambda a, b: a + b, [S.reciprocal_rank(F.col(f"{n}_rank"), w, k) for n, w in weights.items()])
    return total + 0.005 * weights.get("entity", 0.0) * F.coalesce(overlap, F.lit(0))


def first_list() -> Column:
    """0, 1 or 2 for a document first met in the lexical, the vector or the entity list: the order of equal scores."""
    return F.when(F.col("bm25_rank").isNotNull(), 0).when(F.col("semantic_rank").isNotNull(), 1).otherwise(2)


def hybrid_rank(merged: DataFrame, weights: dict[str, float] | None = None, k: int = RRF_K, limit: int = 50, id: str = "document_id") -> DataFrame:
    """``merged`` with ``final_score`` and ``final_rank``; ties by list, then rank in it, then id."""
    scored = merged.withColumn("final_score", F.round(weighted_rrf(weights, k), 9))
    order = [F.desc("final_score"), first_list(), F.coalesce("bm25_rank", "semantic_rank", "entity_rank"), id]
    return ranked(scored, order, limit, "final_rank")


def single_mode_score(mode: str, k: int = RRF_K) -> Column:
    """A hit's final score where only one retriever was asked: 1 / (k + rank) for BM25, else the score itself."""
    return S.reciprocal_rank(F.col("bm25_rank"), 1.0, k) if mode == "bm25" else F.col(f"{mode}_score")


def best_passages(hits: DataFrame, keyframes: DataFrame, queries: DataFrame, id: str = "document_id", width: int = 1800, ocr_width: int = 500, sure: float = 0.75) -> DataFrame:
    """``query_id, id, matched_passage, matched_timestamp, matched_frame``: each hit's keyframe that fits the query best.

    ``hits`` has ``query_id, id, subtitle_text, combined_text, start_seconds``; ``keyframes`` has ``id, keyframe_no,
    subtitle_text, ocr_text, ocr_lines, ocr_confidence_mean, timestamp_seconds, source_frame_index``. A keyframe scores
    2 for each query term in its OCR text, 0.5 for each in its subtitle, and a tenth of its mean confidence; the longer
    passage wins ties, then the earlier keyframe. A hit without keyframes gets the beginning of its combined text.
    """
    k = keyframes.select(id, "keyframe_no", F.col("subtitle_text").alias("local"), F.coalesce("ocr_text", F.lit("")).alias("ocr"), "ocr_lines", "ocr_confidence_mean", "timestamp_seconds", "source_frame_index")
    q = queries.select("query_id", F.array_distinct(X.index_terms(F.col("query"))).alias("qt"))
    base = hits.join(q, "query_id").join(k, id, "left")
    shared = lambda c: F.size(F.array_intersect("qt", X.index_terms(F.coalesce(c, F.lit("")))))
    lines = F.transform(F.coalesce("ocr_lines", F.array().cast("array<struct<text:string,confidence:double>>")), lambda x: F.struct(F.trim(F.regexp_replace(x["text"], r"\s+", " ")).alias("t"), x["confidence"].alias("c")))
    kept = F.transform(F.filter(lines, lambda x: (F.length(x["t"]) > 0) & ((x["c"] >= sure) | (F.size(F.array_intersect("qt", X.index_terms(x["t"]))) > 0))), lambda x: x["t"])
    ocr = F.when(F.size(kept) > 0, F.array_join(kept, " | ")).otherwise(F.trim(F.regexp_replace("ocr", r"\s+", " ")))
    subtitle = F.coalesce("subtitle_text", F.lit(""))
    parts = F.array_compact(F.array(
        F.when(subtitle != "", F.concat(F.lit("SUBTITLE: "), subtitle)),
        F.when((F.coalesce("local", F.lit("")) != "") & ~F.contains(subtitle, F.coalesce("local", F.lit(""))), F.concat(F.lit("LOCAL SUBTITLE: "), F.col("local"))),
        F.when((F.col("ocr") != "") & (ocr != ""), F.concat(F.lit("OCR: "), F.substring(ocr, 1, ocr_width))),
    ))
    passage = F.array_join(parts, "\n")
    score = 2.0 * shared(F.col("ocr")) + 0.5 * shared(F.col("local")) + 0.1 * F.coalesce("ocr_confidence_mean", F.lit(0.0))
    picked = base.withColumn("passage", passage).withColumn("ps", score)
    best = F.max_by(F.struct("passage", "timestamp_seconds", "source_frame_index", "keyframe_no"), F.struct("ps", F.length("passage"), -F.coalesce("keyframe_no", F.lit(0))))
    out = picked.groupBy("query_id", id).agg(best.alias("b"), F.first("combined_text").alias("combined"), F.first("start_seconds").alias("start"))
    none = F.col("b.keyframe_no").isNull()
    return out.select("query_id", id, F.substring(F.when(none, F.col("combined")).otherwise(F.col("b.passage")), 1, width).alias("matched_passage"),
                      F.when(none, F.col("start")).otherwise(F.coalesce(F.expr("nullif(b.timestamp_seconds, 0)"), "start")).alias("matched_timestamp"), F.col("b.source_frame_index").alias("matched_frame"))


#: A reranker scores (query, passage) pairs in batches; a model's can be plugged in, the default counts shared terms.
Reranker = Callable[[Column, Column], Column]


def overlap_reranker(query: Column, passage: Column) -> Column:
    """The deterministic stand-in for a cross-encoder: shared terms against the query's, as a logit-like number."""
    q = F.array_distinct(X.index_terms(query))
    return 6.0 * F.size(F.array_intersect(q, X.index_terms(passage))) / F.greatest(F.size(q), F.lit(1)) - 3.0


def rerank_blend(hits: DataFrame, top: int = 50, min_final: float = 0.20, max_drop: float = 6.0, id: str = "document_id") -> DataFrame:
    """The first ``top`` hits of each query by blended score, cut where they fall off.

    ``hits`` has ``query_id, id, final_score, reranker_score, coverage, entity_overlap``. Blended: 0.60 sigmoid(score) +
    0.25 min-max of the retrieval score + 0.10 coverage + 0.05 for an entity match. Hits without a score are dropped, so
    are hits below ``min_final`` and hits ``max_drop`` below the score of the hit that then stands first.
    """
    window = Window.partitionBy("query_id")
    head = ranked(hits, [F.desc("final_score"), id], top, "retrieval_rank").filter("reranker_score is not null")
    part = S.min_max(F.col("final_score"), F.min("final_score").over(window), F.max("final_score").over(window))
    blended = 0.60 * S.clipped_sigmoid(F.col("reranker_score")) + 0.25 * part + 0.10 * F.col("coverage") + 0.05 * (F.coalesce("entity_overlap", F.lit(0)) > 0).cast("double")
    out = head.withColumn("blended", F.round(blended, 9))
    best = F.first("reranker_score").over(window.orderBy(F.desc("blended"), id))
    out = out.withColumn("best", best).filter((F.col("blended") >= min_final) & (F.col("reranker_score") >= F.col("best") - max_drop))
    return out.withColumn("rerank_rank", F.row_number().over(window.orderBy(F.desc("blended"), id))).select("query_id", id, F.col("blended").alias("final_score"), "reranker_score", "rerank_rank")


def temporal_dedup(hits: DataFrame, seconds: float = 30.0, similar: float = 0.55, id: str = "document_id") -> DataFrame:
    """Hits of each query without those that come too soon after a better one of the same video.

    ``hits`` has ``query_id, id, video_id, start_seconds, final_rank, terms``. A hit falls to an accepted better one at
    most ``seconds`` away, or at most max(3 x seconds, 90) away with a Jaccard similarity of ``similar`` or more.
    ``seconds`` <= 0 keeps all. Videos do not influence each other, so each (query, video) is a group of its own, and no
    group is larger than a query's candidate list.
    """
    if seconds <= 0:
        return hits.drop("terms")
    far = max(3 * seconds, 90.0)
    columns = [c for c in hits.columns if c not in ("query_id", "video_id")]
    first = ["final_rank", id]  # the order in which hits are judged
    listed = F.array_sort(F.collect_list(F.struct(*first, *[c for c in columns if c not in first])))
    gap = lambda a, x: F.abs(a["start_seconds"] - x["start_seconds"])
    words = lambda x: F.coalesce(x["terms"], F.array().cast("array<string>"))
    alike = lambda a, x: F.size(F.array_intersect(words(a), words(x))) / F.greatest(F.size(F.array_union(words(a), words(x))), F.lit(1)) >= similar
    falls = lambda kept, x: F.exists(kept, lambda a: (gap(a, x) <= seconds) | ((gap(a, x) <= far) & alike(a, x)))
    groups = hits.groupBy("query_id", "video_id").agg(listed.alias("all"))
    kept = F.aggregate("all", F.slice("all", 1, 0), lambda acc, x: F.when(falls(acc, x), acc).otherwise(F.concat(acc, F.array(x))))
    return groups.select("query_id", "video_id", F.inline(kept)).select(*[c for c in hits.columns if c != "terms"])
