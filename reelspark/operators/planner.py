"""The adaptive plan of a search as column expressions over a table of queries."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions import text as X

# Folded words that ask for frames, for meaning, or for exact text.
FRAME_WORDS = tuple("frame khung hinh anh man hien xuat ocr chu logo text timestamp thoi diem luc phut giay".split())
SEMANTIC_WORDS = tuple("khac giong tai sao vi nhu the nao giai thich tom tat noi dung y nghia co lam gi cach hoat dong".split())
EXACT_WORDS = tuple("viet ghi hien thi chu dong cau cum tu logo bien bang ocr".split())


#: The most hits that a request may ask for.
MOST = 1000


@dataclass(frozen=True)
class SearchSettings:
    """Defaults of a search; a plan may change them."""

    mode: str = "hybrid"
    level: str = "scene"
    limit: int = 10
    candidate_limit: int = 50
    bm25_weight: float = 1.0
    semantic_weight: float = 1.0
    entity_weight: float = 0.35
    rrf_k: int = 60
    dedupe_seconds: float = 30.0
    reranker: str = "none"
    rerank_top: int = 50
    rerank_min_final: float = 0.20
    rerank_max_drop: float = 6.0
    adaptive: bool = False

    def with_request(self, body: dict) -> SearchSettings:
        """Settings of a request; unknown names are refused, numbers and flags must be of their kind."""
        known = {f: type(getattr(self, f)) for f in self.__dataclass_fields__}
        bad = [k for k, v in body.items() if k != "query" and (k not in known or not isinstance(v, (int, float) if known[k] is float else known[k]))]
        if bad:
            raise ValueError(f"unknown or ill-typed settings: {sorted(bad)}")
        wide = [k for k in ("limit", "candidate_limit", "rerank_top") if not 1 <= body.get(k, 1) <= MOST]
        if wide:
            raise ValueError(f"must be from 1 to {MOST}: {wide}")
        return replace(self, **{k: v for k, v in body.items() if k != "query"})


def adaptive_plans(queries: DataFrame, settings: SearchSettings | None = None) -> DataFrame:
    """``query_id, query`` with mode, level, reranker, limits, weights and reasons chosen by each query's signals."""
    s = settings or SearchSettings()
    q = F.col("query")
    tokens, terms = X.tokens(q), F.array_distinct(X.index_terms(q))
    any_of = lambda words: F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in words]))
    base = queries.select(
        "query_id", "query", F.size(terms).alias("n_terms"), any_of(FRAME_WORDS).alias("frame"), any_of(SEMANTIC_WORDS).alias("semantic"),
        (q.rlike("['\"].+['\"]") | any_of(EXACT_WORDS)).alias("exact"), q.rlike("\\b[A-ZĐ][A-ZĐ0-9_-]{2,}\\b").alias("upper"), (F.size(tokens) > 0).alias("entity"),
    )
    frame, semantic, exact, upper, n = (F.col(c) for c in ("frame", "semantic", "exact", "upper", "n_terms"))
    entity = F.col("entity") | upper
    short, meaning = (n <= 2) & entity & ~semantic, semantic | (n >= 4)
    rerank = meaning & ~short
    reason = lambda cond, text: F.when(cond, F.lit(text))
    reasons = F.array_compact(F.array(
        reason(frame, "frame or time asked for: keyframes too"), reason(exact, "exact text asked for: lexical search counts more, keyframes too"),
        reason(entity, "names in the query: entities count more"), reason(entity & (upper | (n <= 2)), "short or name-like: keyframes too"),
        reason(meaning, "meaning asked for: reranking"), reason(short, "short name: no vectors, no reranking"),
    ))
    semantic_weight: Column = F.when(exact, F.least(F.lit(s.semantic_weight), F.lit(0.75))).otherwise(s.semantic_weight)
    semantic_weight = F.when(meaning, F.greatest(semantic_weight, F.lit(1.0))).otherwise(semantic_weight)
    limit = F.when(short, F.least(F.lit(s.candidate_limit), F.lit(40))).otherwise(F.lit(s.candidate_limit))
    return base.select(
        "query_id", "query", F.lit("hybrid").alias("mode"),
        F.when(frame | exact | (entity & (upper | (n <= 2))), "both").otherwise("scene").alias("level"),
        F.when(rerank, "cross").otherwise("none").alias("reranker"),
        F.when(rerank, F.greatest(limit, F.lit(60))).otherwise(limit).alias("candidate_limit"),
        F.when(rerank, F.greatest(F.lit(s.rerank_top), F.lit(50))).otherwise(F.lit(s.rerank_top)).alias("rerank_top"),
        F.when(exact, F.greatest(F.lit(s.bm25_weight), F.lit(1.35))).otherwise(F.lit(s.bm25_weight)).alias("bm25_weight"),
        F.when(short, 0.0).otherwise(semantic_weight).alias("semantic_weight"),
        F.when(entity, F.greatest(F.lit(s.entity_weight), F.lit(0.65))).otherwise(F.lit(s.entity_weight)).alias("entity_weight"),
        F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit("plain hybrid search of scenes"))).alias("reasons"),
    )
