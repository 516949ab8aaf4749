"""A small HTTP server: ``GET /health`` and ``POST /search``, answers as JSON."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field
from http import HTTPStatus
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import DataFrame, SparkSession

from reelspark.operators import fusion
from reelspark.operators.incremental import Index
from reelspark.operators.planner import SearchSettings, adaptive_plans
from reelspark.operators.search import embed_queries, search

#: What a setting ``reranker`` can name; models are added here.
RERANKERS = {"none": None, "cross": fusion.overlap_reranker}


@dataclass
class Tables:
    """What searches read: an index and, if there are any, vectors of a dimension and keyframes; by level or of one level."""

    index: Index | dict[str, Index]
    cache: DataFrame | dict[str, DataFrame] | None = None
    dimension: int = 64
    keyframes: DataFrame | None = None
    rerankers: dict = field(default_factory=lambda: dict(RERANKERS))

    def warm(self) -> Tables:
        """Keeps the small tables that every search reads in memory, so that no request plans or reads them anew."""
        for ix in self.index.values() if isinstance(self.index, dict) else [self.index]:
            for df in (ix.aliases, ix.totals, ix.idf):
                if df is not None:
                    df.cache().count()
        return self


def planned(spark: SparkSession, query: str, settings: SearchSettings) -> SearchSettings:
    """The settings with what the adaptive plan of the query changes."""
    plan = adaptive_plans(spark.createDataFrame([("q", query)], "query_id string, query string"), settings).first()
    names = ("mode", "level", "reranker", "candidate_limit", "rerank_top", "bm25_weight", "semantic_weight", "entity_weight")
    return settings.with_request({n: plan[n] for n in names})


def run(tables: Tables, queries: DataFrame, settings: SearchSettings) -> DataFrame:
    """One search with the vectors, the reranker and the keyframes that the settings ask for and the tables have."""
    if settings.reranker not in tables.rerankers:
        raise ValueError(f"unknown reranker {settings.reranker}")
    vectors = embed_queries(queries, tables.dimension) if tables.cache is not None and settings.mode in ("semantic", "hybrid") else None
    if settings.level == "both" and not isinstance(tables.index, dict):
        settings = settings.with_request({"level": "scene"})
    return search(tables.index, queries, settings, tables.cache, vectors, tables.rerankers[settings.reranker], tables.keyframes)


def answer(spark: SparkSession, index: Index | dict[str, Index] | Tables, body: dict, defaults: SearchSettings) -> dict:
    """The hits of a request; a mode named in the request wins over the plan's."""
    query = str(body.get("query") or "").strip()
    if not query:
        raise ValueError("empty query")
    tables = index if isinstance(index, Tables) else Tables(index)
    settings = defaults.with_request(body)
    if settings.adaptive:
        settings = planned(spark, query, settings).with_request({k: v for k, v in body.items() if k == "mode"})
    began = time.time()
    # at most ``limit`` rows, which a request cannot set above planner.MOST
    hits = run(tables, spark.createDataFrame([("q", query)], "query_id string, query string"), settings).drop("query_id").orderBy("final_rank").toJSON().collect()
    return {"query": query, "hits": list(map(json.loads, hits)), "latency_ms": round((time.time() - began) * 1000, 1)}


def make_server(spark: SparkSession, index: Index | dict[str, Index] | Tables, host: str = "127.0.0.1", port: int = 8765, defaults: SearchSettings | None = None) -> ThreadingHTTPServer:
    """The server, not yet serving. Requests cannot name files or addresses, and unknown settings are refused."""
    settings = defaults or SearchSettings()
    routes = {("GET", "/health"): lambda _: {"status": "ok"}, ("POST", "/search"): lambda body: answer(spark, index, body, settings)}

    def respond(method: str, path: str, raw: bytes) -> tuple[HTTPStatus, dict]:
        route = routes.get((method, path))
        if route is None:
            return HTTPStatus.NOT_FOUND, {"error": "not found"}
        try:
            return HTTPStatus.OK, route(json.loads(raw or b"{}"))
        except (ValueError, TypeError) as fault:
            return HTTPStatus.BAD_REQUEST, {"error": str(fault)}
        except Exception as fault:
            return HTTPStatus.INTERNAL_SERVER_ERROR, {"error": type(fault).__name__}

    class Endpoint(BaseHTTPRequestHandler):
        def handle_any(self) -> None:
            sent = int(self.headers.get("Content-Length") or 0)
            status, out = respond(self.command, self.path, self.rfile.read(sent) if sent else b"")
            text = json.dumps(out, ensure_ascii=False).encode()
            self.send_response(status)
            for name, value in (("Content-Type", "application/json; charset=utf-8"), ("Content-Length", str(len(text)))):
                self.send_header(name, value)
            self.end_headers()
            self.wfile.write(text)

        do_GET = do_POST = handle_any

        def log_message(self, *_: object) -> None:
            """Requests are not logged."""

    return ThreadingHTTPServer((host, port), Endpoint)
