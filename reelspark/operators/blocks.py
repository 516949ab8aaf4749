"""Scores of many queries over many documents: postings are packed once, blocks of queries read the packs in turn.

A join of postings with query terms makes a row for each (query, document, term), which grows with the square of the input.
Here such sums are made in arrays within a task, and only results leave it: the best of each query, or all.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Up to so many queries a join is the shorter way: it reads the postings of their terms alone.
FEW = 200
#: Postings of a pack and queries of a block, about.
PACK_ROWS, BLOCK_QUERIES = 600_000, 40_000
OUT_ROWS = 100_000


def many(queries: DataFrame) -> bool:
    return queries.count() > FEW


def billionths(x: np.ndarray) -> np.ndarray:
    """``x`` rounded half up to 9 digits, as whole billionths: what Spark's ``round(x, 9)`` gives."""
    y = x * 1e9
    n = np.floor(y + 0.5)
    for i in np.flatnonzero(np.abs(np.abs(n - y) - 0.5) < 1e-9 + np.abs(y) * 1e-15):  # too near a half to tell by doubles
        n[i] = int(Decimal(repr(float(x[i]))).scaleb(9).quantize(Decimal(1), ROUND_HALF_UP))
    return n.astype(np.int64)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row ``pack, body`` of a partition's postings, which come in order of the id; a pack's number follows its ids."""
    own = [b for b in batches if b.num_rows]
    if not own:
        return
    t = pa.Table.from_batches(own).combine_chunks()
    whole = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    ids, terms = (whole(t.column(c)).dictionary_encode(null_encoding="encode") for c in ("id", "term"))
    doc, term = ids.indices.to_numpy(zero_copy_only=False).astype(np.int64), terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    kind, value = t.column("kind").to_numpy(), t.column("value").to_numpy()
    nd, nt = len(ids.dictionary), len(terms.dictionary)
    at = kind == 0
    if (kind == 1).any():  # lengths to divide by; what has none is left out
        norm = np.full(nd, np.nan)
        norm[doc[kind == 1]] = value[kind == 1]
        value = np.where(at, value / norm[doc], value)
        at &= ~np.isnan(norm[doc])
    key = term[at] * nd + doc[at]
    order = np.argsort(key, kind="stable")
    key, first = np.unique(key[order], return_index=True)
    value = np.add.reduceat(value[at][order], first) if len(first) else np.zeros(0)
    within = np.unique(doc[kind == 2] * nt + term[kind == 2])
    body = {
        "terms": terms.dictionary.to_pylist(), "ptr": np.searchsorted(key, np.arange(nt + 1) * nd).astype(np.int32), "doc": (key % max(nd, 1)).astype(np.uint16 if nd <= 1 << 16 else np.int32), "value": value, "n": nd, "ids": ids.dictionary,
        "own_ptr": np.searchsorted(within, np.arange(nd + 1) * nt).astype(np.int32), "own": (within % max(nt, 1)).astype(np.int32),
    }
    raw = pickle.dumps(body, protocol=5)
    yield pa.RecordBatch.from_pydict({"pack": pa.array([TaskContext.get().partitionId()], pa.int32()), "size": pa.array([len(raw)], pa.int64()), "body": pa.array([pa.compress(raw, "zstd", asbytes=True)], pa.binary())})


class _Block:
    """The queries of a block; equal ones are scored once."""

    def __init__(self, rows: list[tuple]):
        keys: dict[tuple, int] = {}
        groups: dict[tuple, list] = {}
        for query_id, terms, weights, scale in rows:
            groups.setdefault((tuple(keys.setdefault(k, len(keys)) for k in zip(terms, weights)), scale), []).append(query_id)
        self.keys = list(keys)
        self.asked = [(k, 1.0 if s is None else s, ids) for (k, s), ids in groups.items()]

    def sums(self, pack: dict) -> Iterator[tuple[int, np.ndarray]]:
        """Each query's sums over the documents of ``pack``, in one array that the next query overwrites."""
        slot = {t: i for i, t in enumerate(pack["terms"])}
        nd, ptr, of, parts, slots = pack["n"], pack["ptr"], pack["doc"].astype(np.intp), [], []
        for term, weight in self.keys:
            s = slot.get(term)
            slots.append(s)
            if s is None or ptr[s] == ptr[s + 1]:
                parts.append(None)
                continue
            docs, v = of[ptr[s] : ptr[s + 1]], pack["value"][ptr[s] : ptr[s + 1]] * weight
            if len(docs) * 12 > nd:  # a frequent term is added as a whole
                dense = np.zeros(nd)
                dense[docs] = v
                parts.append((None, dense))
            else:
                parts.append((docs, v))
        self.slots, acc = slots, np.zeros(nd)
        for u, (ks, _, _) in enumerate(self.asked):
            acc.fill(0.0)
            met = False
            for k in ks:
                if (part := parts[k]) is not None:
                    met = True
                    if part[0] is None:
                        acc += part[1]
                    else:
                        acc[part[0]] += part[1]
            if met:
                yield u, acc


def _batches(fields: list, columns: list[list], full: int) -> Iterator[pa.RecordBatch]:
    if sum(len(c) for c in columns[0]) >= full and columns[0]:
        yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], schema=pa.schema(fields))
        for c in columns:
            c.clear()


def _scorer(limit: int | None, digits: int | None, query_type: pa.DataType, names: list[str], sign: int) -> Callable:
    """``limit`` None: all sums, rounded to 9 and then ``digits`` digits (None: without the sums)."""
    named = lambda kinds: list(map(pa.field, names, kinds))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Block, dict]]:
        rows, block = [], None
        for b in batches:
            for i, pack in enumerate(b.column("pack").to_pylist()):
                if pack < 0:
                    rows.append((b.column("query_id")[i].as_py(), b.column("terms")[i].as_py(), b.column("weights")[i].as_py(), b.column("scale")[i].as_py()))
                else:
                    block = block or _Block(rows)
                    if block.asked:
                        yield block, pickle.loads(pa.decompress(b.column("body")[i].as_buffer(), decompressed_size=b.column("size")[i].as_py(), codec="zstd", asbytes=True))

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, columns = None, [[], [], []] if digits is not None else [[], []]
        for block, pack in load(batches):
            ids = pack["ids"]
            fields = named([query_type, ids.type, pa.float64()][: len(columns)])
            for u, acc in block.sums(pack):
                found = np.flatnonzero(acc)
                own = ids.take(pa.array(found))
                if digits is not None:
                    n = billionths(acc[found] / block.asked[u][1])
                    score = pa.array(sign * (n if digits >= 9 else (n + 5 * 10 ** (8 - digits)) // 10 ** (9 - digits)) / 10 ** min(digits, 9))
                for q in block.asked[u][2]:
                    columns[0].append(pa.repeat(pa.scalar(q, query_type), len(found)))
                    columns[1].append(own)
                    if digits is not None:
                        columns[2].append(score)
                    yield from _batches(fields, columns, OUT_ROWS)
        if fields:
            yield from _batches(fields, columns, 1)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ids, block = [], None
        for block, pack in load(batches):
            if not all_ids:
                size = len(block.asked)
                n_of, at, overlap, count = np.zeros((size, limit), np.int64), np.zeros((size, limit), np.int64), np.zeros((size, limit), np.int32), np.zeros(size, np.int64)
            base = len(all_ids) << 32
            all_ids.append(pack["ids"])
            own, own_ptr, sets = pack["own"], pack["own_ptr"], {}
            for u, acc in block.sums(pack):
                ks, scale, _ = block.asked[u]
                have = count[u]
                last = n_of[u, limit - 1] if have == limit else -1
                found = np.flatnonzero(acc > (last / 1e9 * (1 - 1e-12) - 1e-12) * scale) if last > 0 else np.flatnonzero(acc)
                if not len(found):
                    continue
                n = billionths(acc[found] / scale)
                if last >= 0:  # ids only grow from pack to pack, so an equal score comes too late
                    later = n > last
                    found, n = found[later], n[later]
                if len(n) > limit:
                    near = n >= np.partition(n, len(n) - limit)[len(n) - limit]
                    found, n = found[near], n[near]
                if not len(n):
                    continue
                order = np.argsort(-n, kind="stable")[:limit]
                found, n = found[order], n[order]
                shared = np.zeros(len(n), np.int32)
                if len(own):
                    asked = {block.slots[k] for k in ks}
                    for i, d in enumerate(found.tolist()):
                        if (words := sets.get(d)) is None:
                            words = sets[d] = frozenset(own[own_ptr[d] : own_ptr[d + 1]].tolist())
                        shared[i] = len(asked & words)
                if have:
                    n, found, shared = np.concatenate((n_of[u, :have], n)), np.concatenate((at[u, :have], found + base)), np.concatenate((overlap[u, :have], shared))
                    order = np.argsort(-n, kind="stable")[:limit]
                    n, found, shared = n[order], found[order], shared[order]
                else:
                    found = found + base
                count[u] = len(n)
                n_of[u, : len(n)], at[u, : len(n)], overlap[u, : len(n)] = n, found, shared
        if block is None or not all_ids:
            return
        fields = named([query_type, all_ids[0].type, pa.float64(), pa.int32()])
        starts = np.cumsum([0, *map(len, all_ids)])
        ids, columns = pa.chunked_array(all_ids).combine_chunks(), [[], [], [], []]
        for u, (_, _, same) in enumerate(block.asked):
            if c := int(count[u]):
                own = ids.take(pa.array(starts[at[u, :c] >> 32] + (at[u, :c] & 0xFFFFFFFF)))
                for q in same:
                    for column, x in zip(columns, (pa.repeat(pa.scalar(q, query_type), c), own, pa.array(sign * n_of[u, :c] / 1e9), pa.array(overlap[u, :c]))):
                        column.append(x)
                    yield from _batches(fields, columns, OUT_ROWS // 10)
        yield from _batches(fields, columns, 1)

    return every if limit is None else best


def block_scores(values: DataFrame, asked: DataFrame, id: str = "document_id", limit: int | None = None, norms: DataFrame | None = None, texts: DataFrame | None = None, digits: int | None = 9, score: str = "score", sign: int = 1) -> DataFrame:
    """``query_id, id, score`` of every document with a term that a query asks: the sum of weight x value, rounded to 9 digits.

    ``values`` has ``term, id, value`` (to be stored: it is read twice), ``asked`` ``query_id, term, weight`` and maybe ``scale``, by which
    a query's sums are divided; ``norms`` (``id, norm``) divides a document's values. Values and weights are above 0. With
    ``limit`` only the best of each query stay, the smaller id first where scores are equal, with ``overlap``: how many of the
    query's terms are in ``texts`` (``term, id``). Without it all stay, rounded once more to ``digits``; None gives the pairs alone.
    Scores are called ``score`` and have the ``sign``; tasks give them so, for another step would copy every row.

    A task holds one pack of postings, its queries with their best, and the ids of all documents.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = values.sparkSession
    row = lambda df, kind, term, value: df.select(F.lit(kind).cast("byte").alias("kind"), term.alias("term"), F.col(id).alias("id"), value.cast("double").alias("value"))
    none, rows = F.lit(None).cast("string"), [row(values, 0, F.col("term"), F.col("value"))]
    if norms is not None:
        rows.append(row(norms, 1, none, F.col("norm")))
    if texts is not None:
        rows.append(row(texts, 2, F.col("term"), F.lit(None)))
    n_packs = max(1, -(-values.count() // PACK_ROWS))
    sorted_rows = reduce(lambda a, b: a.unionByName(b), rows).repartitionByRange(n_packs, "id").sortWithinPartitions("id")
    packs = sorted_rows.mapInArrow(_pack, "pack int, size bigint, body binary")
    scale = F.first("scale") if "scale" in asked.columns else F.lit(None).cast("double")
    own = asked.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", F.col("weight").cast("double").alias("weight")))).alias("t"), scale.alias("scale"))
    n_blocks = max(spark.sparkContext.defaultParallelism, -(-asked.select("query_id").distinct().count() // BLOCK_QUERIES))
    queries = own.select(F.pmod(F.xxhash64("t"), F.lit(n_blocks)).cast("int").alias("block"), F.lit(-1).alias("pack"), "query_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"), "scale")
    each = packs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    mixed = queries.unionByName(each, allowMissingColumns=True).repartitionById(n_blocks, F.col("block")).sortWithinPartitions("pack")
    id_type, query_type = values.schema[id].dataType, asked.schema["query_id"].dataType
    out = [T.StructField("query_id", query_type), T.StructField(id, id_type), T.StructField(score, T.DoubleType()), T.StructField("overlap", T.IntegerType())]
    schema = T.StructType(out if limit is not None else out[: 2 + (digits is not None)])
    return mixed.drop("block").mapInArrow(_scorer(limit, digits, to_arrow_type(query_type), schema.names, sign), schema)
