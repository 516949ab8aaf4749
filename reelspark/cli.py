"""Commands: ``python -m reelspark.cli documents|build|embed|plan|search|seed|validate|report|serve``."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions import text as X
from reelspark.operators import documents, evaluation, incremental
from reelspark.operators import vectors as V
from reelspark.operators.planner import SearchSettings, adaptive_plans
from reelspark.server import RERANKERS, Tables, make_server, planned, run
from reelspark.session import get_session, materialize
from reelspark.sources import readers, sinks

COMMANDS = ("documents", "build", "embed", "plan", "search", "seed", "validate", "report", "serve")
MODES = ("bm25", "tfidf", "semantic", "entity", "hybrid")


def _tables(spark: SparkSession, a: argparse.Namespace) -> Tables:
    """A stored index (``--index``) if one is named, else one planned over the tables; with the cache's vectors where there are any."""
    read = lambda t: spark.read.parquet(f"{a.tables}/{t}.parquet")
    index = readers.index_levels(spark, a.index) if a.index else incremental.build(read("documents"), read("entity_aliases"))
    has = readers.exists(spark, f"{a.tables}/embeddings_cache.parquet")
    cache = read("embeddings_cache").filter((F.col("provider") == a.provider) & (F.col("dimension") == a.dimension)) if has else None
    return Tables(index, cache, a.dimension)


def _show(df: DataFrame) -> None:
    for row in df.toJSON().toLocalIterator():
        print(json.dumps(json.loads(row), ensure_ascii=False))


def _runs(tables: Tables, queries: DataFrame, settings: SearchSettings) -> tuple[DataFrame, DataFrame]:
    """The ranked documents of every mode that the tables allow, and each mode's mean milliseconds for a query."""
    modes = [m for m in MODES if m != "semantic" or tables.cache is not None]
    parts, took = [], []
    for mode in modes:
        began = time.time()
        part = run(tables, queries, settings.with_request({"mode": mode, "dedupe_seconds": 0.0, "level": "scene"})).select(F.lit(mode).alias("mode"), "query_id", "document_id", F.col("final_rank").alias("rank"))
        part = materialize(part, f"run-{mode}")  # run once: its time is this mode's, and the report reads the result
        n = part.select("query_id").distinct().count()
        took.append((mode, round((time.time() - began) * 1000 / max(n, 1), 3)))
        parts.append(part)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every, queries.sparkSession.createDataFrame(took, "mode string, mean_latency_ms double")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="reelspark", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name in COMMANDS:
        s = sub.add_parser(name)
        s.add_argument("--tables", required=True, help="directory of the Parquet tables")
        s.add_argument("--index", help="a stored index; without it one is planned over the tables")
        s.add_argument("--output", help="where the result is written; printed if not given")
        s.add_argument("--query", help="plan, search: the query")
        s.add_argument("--mode", default="hybrid", choices=MODES)
        s.add_argument("--level", default="scene", choices=("scene", "keyframe", "both"))
        s.add_argument("--reranker", default="none", choices=tuple(RERANKERS))
        s.add_argument("--adaptive", action="store_true", help="search, serve: let the query choose the settings")
        s.add_argument("--provider", default="hashing")
        s.add_argument("--dimension", type=int, default=64)
        s.add_argument("--limit", type=int, default=10)
        s.add_argument("--count", type=int, default=60, help="seed: how many queries")
        s.add_argument("--force", action="store_true", help="embed: also what is in the cache")
        s.add_argument("--queries", help="validate, report: JSON lines of labelled queries")
        s.add_argument("--reviewed-only", action="store_true", help="report: queries that a person has reviewed")
        s.add_argument("--details", help="report: where the rows of each query are written")
        s.add_argument("--checkpoint-dir", help="the folder that all executors share")
        s.add_argument("--port", type=int, default=8765)
    a = p.parse_args(argv)
    spark = get_session("reelspark", conf={"spark.checkpoint.dir": a.checkpoint_dir} if a.checkpoint_dir else None)
    settings = SearchSettings().with_request({"mode": a.mode, "level": a.level, "limit": a.limit, "reranker": a.reranker, "adaptive": a.adaptive})
    read = lambda t: spark.read.parquet(f"{a.tables}/{t}.parquet")
    one = lambda: spark.createDataFrame([("q", a.query or "")], "query_id string, query string")
    if a.command == "build":
        root = a.output or f"{a.tables}/index"
        sinks.write_index(incremental.build(read("documents"), read("entity_aliases")), root)
        if all(readers.exists(spark, f"{a.tables}/{t}.parquet") for t in ("scenes", "subtitle_cues", "ocr_records")):
            nested = documents.scene_documents(read("scenes"), read("subtitle_cues"), read("ocr_records"))
            sinks.write_index(incremental.build_levels(nested, read("entity_aliases"))["keyframe"], root, "keyframe")
        return 0
    if a.command == "serve":
        make_server(spark, _tables(spark, a).warm(), port=a.port, defaults=SearchSettings(adaptive=True)).serve_forever()
    if a.command == "documents":
        out = documents.scene_documents(read("scenes"), read("subtitle_cues"), read("ocr_records"))
    elif a.command == "embed":
        docs = incremental.L.latest_documents(read("documents"))
        known = read("embeddings_cache") if readers.exists(spark, f"{a.tables}/embeddings_cache.parquet") else spark.createDataFrame([], V.CACHE_DDL)
        embed = X.hashing_embedding(a.dimension)(X.prepared_document(F.col("document_id"), F.col("combined_text"), a.provider))
        out = V.embed_missing(docs, known, embed, a.provider, "token-bigram-v1", a.dimension, force=a.force)
    elif a.command == "plan":
        out = adaptive_plans(one(), settings)
    elif a.command == "search":
        if settings.adaptive:
            settings = planned(spark, a.query or "", settings).with_request({"adaptive": False})
        out = run(_tables(spark, a), one(), settings).orderBy("final_rank")
    elif a.command == "seed":
        out = evaluation.seed_queries(incremental.L.latest_documents(read("documents")), a.count)
    else:
        queries = readers.json_lines(spark, a.queries, readers.QUERY_DDL)
        if a.command == "validate":
            out = evaluation.violations(queries, incremental.L.latest_documents(read("documents")))
            faults = out.count()
            _show(out)
            return 1 if faults else 0
        queries = evaluation.reviewed(queries) if a.reviewed_only else queries
        every, took = _runs(_tables(spark, a), queries, settings)
        details = evaluation.query_metrics(every, queries)
        if a.details:
            sinks.write_json(details, a.details)
        out = evaluation.report(details).join(took, "mode", "left")
    if a.output:
        sinks.write_json(out, a.output)
    else:
        _show(out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
