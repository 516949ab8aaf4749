"""Embedding cache, exact vector search and histogram distances."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.functions import scores as S
from reelspark.operators.lexical import ranked


CACHE_DDL = "cache_id bigint, document_id string, provider string, model string, dimension int, text_hash string, vector array<float>, updated_at string"


def latest_vectors(cache: DataFrame) -> DataFrame:
    """The entry written last for each document, provider, model and dimension; only whole, non-zero vectors."""
    last = F.row_number().over(Window.partitionBy("document_id", "provider", "model", "dimension").orderBy(F.desc_nulls_last("updated_at"), F.desc("cache_id")))
    sound = cache.filter("document_id is not null and vector is not null and size(vector) = dimension and exists(vector, x -> x <> 0)")
    return sound.withColumn("n", last).filter("n = 1").drop("n")


def cache_misses(docs: DataFrame, cache: DataFrame, provider: str, model: str, dimension: int, text: str = "combined_text") -> DataFrame:
    """``document_id, text_hash`` still to be embedded: no entry of the model with the hash of the text as it is now."""
    wanted = docs.filter(F.length(text) > 0).select("document_id", F.sha2(F.col(text), 256).alias("text_hash"))
    own = cache.filter((F.col("provider") == provider) & (F.col("model") == model) & (F.col("dimension") == dimension))
    return wanted.join(own.select("document_id", "text_hash"), ["document_id", "text_hash"], "left_anti")


def embed_missing(docs: DataFrame, cache: DataFrame, embed: Column, provider: str, model: str, dimension: int, *, text: str = "combined_text", force: bool = False, limit: int | None = None) -> DataFrame:
    """The cache with the documents that it lacks (all of them with ``force``) embedded by the column ``embed``.

    What is to be done is an anti-join on the text's hash, so a broken run goes on where it ended. Vectors of another length
    than ``dimension`` are an error. ``limit`` takes the first documents by id.
    """
    wanted = docs.filter(F.length(text) > 0).select("document_id", F.sha2(F.col(text), 256).alias("text_hash")) if force else cache_misses(docs, cache, provider, model, dimension, text)
    wanted = wanted.orderBy("document_id").limit(limit) if limit is not None else wanted
    made = docs.join(wanted, "document_id").select("document_id", "text_hash", embed.alias("vector"))
    checked = F.when(F.size("vector") == dimension, F.col("vector")).otherwise(F.raise_error(F.concat(F.lit("a vector of another length: "), F.size("vector").cast("string"))))
    new = made.select(F.xxhash64("document_id", F.lit(provider), F.lit(model), F.lit(dimension)).alias("cache_id"), "document_id", F.lit(provider).alias("provider"), F.lit(model).alias("model"),
                      F.lit(dimension).alias("dimension"), "text_hash", checked.cast("array<float>").alias("vector"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"))
    return upsert_cache(cache, new)


def upsert_cache(cache: DataFrame, new: DataFrame) -> DataFrame:
    """The cache with the new entries in place of those of equal document, provider, model and dimension."""
    key = ["document_id", "provider", "model", "dimension"]
    return cache.join(new.select(*key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def exact_knn(vectors: DataFrame, queries: DataFrame, *, id: str, vector: str, k: int = 10, parts: int | None = None, block: int = 2048, rows_per_part: int = 20_000) -> DataFrame:
    """``query_id, id, similarity, place``: the k nearest rows by inner product, exactly, for a stated set of queries.

    ``queries`` has ``query_id, vector``. Rows are cut into ``parts`` (by default as many as keep a part at ``rows_per_part``,
    however many rows there are) and queries into blocks; each (part, block) is one
    matrix product in one task and returns only k rows for a query, from which the last step takes the best. Vectors of
    another length than the query's are left out. A row whose id equals the query's is not its own neighbour.
    """
    kind, qkind = vectors.schema[id].dataType.simpleString(), queries.schema["query_id"].dataType.simpleString()
    n_blocks = max(1, -(-queries.count() // block))
    parts = parts or max(1, -(-vectors.count() // rows_per_part))
    rows = vectors.select(F.pmod(F.xxhash64(id), F.lit(parts)).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("blk"), F.col(id).alias("id"), F.col(vector).alias("v"))
    asks = queries.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int").alias("blk"), "query_id", F.col("vector").alias("v"))

    def local(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values("id")
            for dim, q in left.groupby(left["v"].map(len)):
                r = right[right["v"].map(len) == dim]
                if not len(r):
                    continue
                sim = np.stack(q["v"].to_numpy()).astype(np.float64) @ np.stack(r["v"].to_numpy()).astype(np.float64).T
                sim[q["query_id"].to_numpy()[:, None] == r["id"].to_numpy()[None, :]] = -np.inf
                top = np.argsort(-np.round(sim, 9), axis=1, kind="stable")[:, :k]
                out.append(pd.DataFrame({"query_id": np.repeat(q["query_id"].to_numpy(), top.shape[1]), "id": r["id"].to_numpy()[top].ravel(), "similarity": np.round(np.take_along_axis(sim, top, 1).ravel(), 9)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": left["query_id"][:0], "id": right["id"][:0], "similarity": np.empty(0)})

    found = asks.groupBy("part", "blk").cogroup(rows.groupBy("part", "blk")).applyInPandas(local, f"query_id {qkind}, id {kind}, similarity double")
    return ranked(found.filter("similarity > double('-infinity')"), [F.desc("similarity"), "id"], k, "place").withColumnRenamed("id", id if id != "query_id" else "id")


def semantic_search(cache: DataFrame, query_vectors: DataFrame, limit: int = 50) -> DataFrame:
    """``query_id, document_id, semantic_score, semantic_rank`` by cosine over the cache's latest vectors."""
    index = latest_vectors(cache).select("document_id", S.unit(F.col("vector")).alias("u"))
    asks = query_vectors.select("query_id", S.unit(F.col("vector")).alias("vector"))
    out = exact_knn(index, asks, id="document_id", vector="u", k=limit)
    return out.select("query_id", "document_id", F.col("similarity").alias("semantic_score"), F.col("place").alias("semantic_rank"))


def label_centroids(embeddings: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """``label, centroid, members``: the mean vector of each label, coordinate by coordinate in the JVM."""
    long = embeddings.select(label, F.posexplode(vector).alias("i", "x"))
    means = long.groupBy(label, "i").agg(F.avg(F.col("x").cast("double")).alias("m"), F.count(F.lit(1)).alias("n"))
    return means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda p: p["m"]).alias("centroid"), F.max("n").alias("members"))


def min_distance_to(candidates: DataFrame, selected: DataFrame, by: list[str], histogram: str = "histogram", rows_per_part: int = 20_000) -> DataFrame:
    """Each candidate's smallest histogram distance to the selected ones of its group; 1 where none is selected.

    Candidates and selected rows are cut into parts of about ``rows_per_part``: a task is one matrix product of a part with a
    part, so a group may be of any size, and each vector travels once for each part of the other side, not for each pair.
    """
    keys = [c for c in candidates.columns if c != histogram]
    n_left, n_right = (max(1, -(-df.count() // rows_per_part)) for df in (candidates, selected))
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    part = lambda df, n, name: F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int").alias(name)
    left = candidates.select(*keys, F.col(histogram).alias("__h"), part(candidates, n_left, "__p"), every(n_right, "__q"))
    right = selected.select(*by, F.col(histogram).alias("__h"), every(n_left, "__p"), part(selected, n_right, "__q"))
    schema = T.StructType([candidates.schema[c] for c in keys] + [T.StructField("distance", T.DoubleType())])

    def roots(rows: pd.Series) -> np.ndarray:
        h = np.sqrt(np.maximum(np.stack([np.asarray(r, dtype=np.float64) for r in rows]), 0))
        norm = np.sqrt((h * h).sum(axis=1, keepdims=True))
        return np.divide(h, norm, out=np.zeros_like(h), where=norm > 0)

    def local(mine: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        out = mine[keys].copy()
        out["distance"] = 1.0
        if len(mine) and len(chosen):
            theirs = roots(chosen["__h"])
            near = np.concatenate([(roots(mine["__h"].iloc[at : at + 1024]) @ theirs.T).max(axis=1) for at in range(0, len(mine), 1024)])
            out["distance"] = np.sqrt(np.maximum(0.0, 1 - near))
        return out

    group = [*by, "__p", "__q"]
    met = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(local, schema)
    return met.groupBy(*keys).agg(F.min("distance").alias("distance"))
