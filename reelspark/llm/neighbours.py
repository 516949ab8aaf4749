"""Problem 4: the most similar vectors of every vector by cross-polytope hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.session import materialize


def usable(vector: Column, dimension: Column | None = None) -> Column:
    """True where a vector is not null, has the full length, only finite numbers, and is not zero."""
    # the ends of the range tell most, NaN being the greatest number; only then is each element looked at
    top, low = F.array_max(vector), F.array_min(vector)
    infinity = F.lit(float("inf"))
    sound = (top < infinity) & (low > -infinity) & ((top != 0) | (low != 0)) & ~F.exists(vector, lambda x: x.isNull())
    return F.coalesce(vector.isNotNull() & ((F.size(vector) == dimension) if dimension is not None else F.lit(True)) & sound, F.lit(False))


def _unit(rows: list, dim: int) -> np.ndarray:
    v = np.asarray(rows, dtype=np.float64).reshape(-1, dim)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # whatever their scale, the squares stay in range
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _coarse(unit: np.ndarray) -> np.ndarray:
    """Unit vectors in one byte a coordinate, the largest as 127: enough to screen pairs to within SCREEN in cosine."""
    return np.rint(unit * (127 / np.abs(unit).max(axis=1, keepdims=True))).astype(np.int8)


def _float(coarse: np.ndarray) -> np.ndarray:
    unit = coarse.astype(np.float32)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def _rotate(v: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Three rounds of random signs and a fast Walsh-Hadamard transform, over the next power of two of coordinates."""
    n, size = v.shape[0], signs.shape[1]
    x = np.zeros((n, size), dtype=np.float32)
    x[:, : v.shape[1]] = v
    for sign in signs:
        x *= sign
        h = 1
        while h < size:
            x = x.reshape(n, size // (2 * h), 2, h)
            x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, size)
            h *= 2
    return x


def _axes(x: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, the nearest first: axis i as 2i, or 2i + 1 where negative."""
    size = np.abs(x)
    probes = min(probes, x.shape[1])
    top = np.argpartition(-size, probes - 1, axis=1)[:, :probes] if probes < x.shape[1] else np.broadcast_to(np.arange(x.shape[1]), x.shape).copy()
    top = np.take_along_axis(top, np.argsort(-np.take_along_axis(size, top, 1), axis=1, kind="stable"), 1)
    return (2 * top + (np.take_along_axis(x, top, 1) < 0)).astype(np.int64)


#: Above the error of a cosine between coarse vectors: rows within it of the k-th best are kept for the exact comparison.
SCREEN = 0.01
#: Up to so many groups (of 16 bytes each) are broadcast.
FEW_GROUPS = 50_000
#: About so many bytes of coarse vectors are compared by one call.
PART_BYTES = 32_000_000


class CrossPolytope:
    """Hash tables for unit vectors of one dimension; the same seed gives the same functions on every executor.

    A table's code is one nearest signed axis over all coordinates, then one over the first ``last`` coordinates of a
    second rotation, so the number of buckets (2 size x 2 last) can follow the number of vectors.
    """

    def __init__(self, dim: int, tables: int, last: int, seed: int) -> None:
        self.size = 1 << max(1, (dim - 1).bit_length())
        rng = np.random.default_rng([seed, dim])
        # the third rotation isn't used; it is drawn so that the others stay those of the README's measurements
        self.signs = rng.choice(np.array([-1, 1], dtype=np.float32), size=(tables, 3, 3, self.size))
        self.tables, self.last = tables, min(last, self.size)

    def codes(self, unit: np.ndarray, table: int, probes: int) -> np.ndarray:
        """The first ``probes`` buckets of each row in a table, its own first; with a second axis one more, of its runner-up."""
        first, second = self.signs[table, 0], self.signs[table, 1]
        code = _axes(_rotate(unit, first), probes)
        if self.last:
            last = _axes(_rotate(unit, second)[:, : self.last], 2 if probes > 1 else 1)
            near = code * (2 * self.last)
            # the second axis is probed as well, beside the nearest first one
            code = np.concatenate([near + last[:, :1], near[:, :1] + last[:, 1:]], axis=1)
        return code

    def places(self, unit: np.ndarray, table: int, probes: int, blocks: int) -> Iterator[tuple[np.ndarray, ...]]:
        """``row, part, one, two, home``: where rows stand and ask in a table. A part holds the buckets of one nearest axis, or one
        of ``blocks`` of them; ``one`` and ``two`` (-1 where there is none) are buckets in it. A row's own bucket comes first; as
        that of the second axis' runner-up has the same nearest axis, the row goes to their part once and asks in both."""
        codes, wide, first = self.codes(unit, table, probes), max(1, 2 * self.last), min(probes, self.size)
        part, one = codes // wide * blocks + codes % wide % blocks, (codes % wide).astype(np.int32)
        two, rows = np.full(len(unit), -1, np.int32), np.arange(len(unit))
        apart = np.zeros(len(unit), bool)
        if codes.shape[1] > first:
            apart = part[:, 0] != part[:, first]
            yield rows, part[:, 0], one[:, 0], np.where(apart, -1, one[:, first]).astype(np.int32), True
            yield rows[apart], part[apart, first], one[apart, first], two[apart], False
        else:
            yield rows, part[:, 0], one[:, 0], two, True
        for probe in range(1, first):
            yield rows, part[:, probe], one[:, probe], two, False


def similar_vectors(
    vectors: DataFrame, *, id: str, vector: str, groups: list[str], k: int = 5, min_cosine: float = -1.0,
    tables: int = 5, probes: int = 2, rows_per_bucket: int = 256, full_bucket: int = 4096, query: Column | None = None, seed: int = 5,
    sure: float | None = None, rows_per_part: int = 20_000, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``id_a, id_b, cosine, place``: for each row its ``k`` most similar rows among those of equal ``groups``.

    Unit vectors are hashed to the nearest signed axis after fast pseudo-random rotations. Every row stands in one bucket
    of each of ``tables`` tables and asks in ``probes`` buckets of it; the rows met there are compared exactly. ``query``
    restricts the asking rows, not the rows asked. Recall grows with tables and probes; see the README for measurements.

    The number of buckets follows each group's number of rows. Neighbouring buckets, up to about ``part_bytes`` of coarse
    vectors, make a part, to which a row is sent once whatever buckets of it concern it. A bucket with more than ``full_bucket`` rows is cut into
    squares that together compare all its pairs, so that no task holds an unbounded bucket and no pair is lost; the work
    in such a bucket grows with the square of its rows. Rows with exactly the same direction are hashed once: one of
    them asks, and its copies, being at cosine 1 to each other, come before all others in the order of their ids.

    Neighbours that are hardly nearer than any other vector share no bucket. With ``sure`` an asking row whose k-th find is
    less similar than that (or that found fewer) is compared exactly with all rows of its group, in blocks: queries x rows
    in work, so meant for a stated query set.

    Ties in cosine are broken by the smaller id. ``vector`` must hold usable vectors of one length for each group (see
    :func:`usable`); nulls in ``groups`` form a group of their own. Null ids are left out, ids must be distinct. An empty
    table gives an empty result. Other columns are ignored.
    """
    kind = vectors.schema[id].dataType.simpleString()
    grouped = F.xxhash64(*[F.coalesce(F.col(f"`{g}`").cast("string"), F.lit("\0")) for g in groups]) if groups else F.lit(0).cast("bigint")
    asks = F.lit(True) if query is None else F.coalesce(query, F.lit(False))
    base = vectors.filter(F.col(f"`{id}`").isNotNull()).select(grouped.alias("g"), F.col(f"`{id}`").alias("id"), asks.alias("asks"), F.col(f"`{vector}`").cast("array<float>").alias("v"))

    # exact copies: the smallest id stands for all of them. Only rows whose hash occurs again are shuffled with their vector
    base = base.withColumn("h", F.xxhash64("v"))
    again = materialize(base.groupBy("g", "h").count().filter("count > 1").select("g", "h"), "again")
    suspects = base.join(again, ["g", "h"], "left_semi")
    copies = suspects.groupBy("g", "h", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.max("asks").alias("any_asks"))
    members = materialize(suspects.join(copies.filter("n > 1"), ["g", "h", "v"]).select("g", "rep", "id", "asks"), "copies")
    columns = ["g", "id", "asks", "v"]
    rows = materialize(base.join(again, ["g", "h"], "left_anti").select(*columns).unionByName(copies.select("g", F.col("rep").alias("id"), F.col("any_asks").alias("asks"), "v")), "rows")

    # the last axis of the codes and the parts follow each group's size: two numbers for each group
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("v")).alias("dim"))
    power = F.ceil(F.log2(F.greatest(F.col("dim"), F.lit(2))))
    wanted = F.col("rows") / F.lit(float(rows_per_bucket)) / F.pow(2.0, power + 1)
    last = F.when(wanted <= 1, 0).otherwise(F.least(F.pow(2.0, power), F.pow(2.0, F.ceil(F.log2(wanted)) - 1))).cast("int")
    # one row a group: broadcast if they are few, else a join on the group would put each group into one task
    bytes_ = F.col("rows") / F.pow(2.0, power + 1) * F.col("dim") * probes
    blocks = F.least(F.greatest(2 * last, F.lit(1)), F.pow(2.0, F.ceil(F.log2(F.greatest(bytes_ / part_bytes, F.lit(1.0)))))).cast("int")
    sizes = materialize(sizes.select("g", last.alias("last"), blocks.alias("blocks")), "groups")
    hashable = rows.join(F.broadcast(sizes) if sizes.count() <= FEW_GROUPS else sizes, "g")

    def hashed(homes_only: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made: dict[tuple[int, int], CrossPolytope] = {}
            for batch in batches:
                pdf = batch.to_pandas()
                dims = pdf["v"].map(len)
                for (dim, last_, blocks_), rows_ in pdf.groupby([dims, "last", "blocks"], sort=False):
                    dim, last_ = int(dim), int(last_)
                    if (dim, last_) not in made:
                        made[dim, last_] = CrossPolytope(dim, tables, last_, seed)
                    hash_, unit, asking = made[dim, last_], _unit(list(rows_["v"]), dim), rows_["asks"].to_numpy(bool)
                    for table in range(tables):
                        for at, part, one, two, home in hash_.places(unit, table, 1 if homes_only else probes, int(blocks_)):
                            keep = np.ones(len(at), bool) if home else asking[at]
                            if not keep.any():
                                continue
                            out, at = rows_.iloc[at[keep]], at[keep]
                            cols = {"g": pa.array(out["g"]), "table": pa.array(np.full(len(out), table, np.int32)), "part": pa.array(part[keep]), "one": pa.array(one[keep])}
                            if not homes_only:
                                blob = pa.array([r.tobytes() for r in _coarse(unit[at])], pa.binary())
                                other = np.where(asking[at], two[keep], -1).astype(np.int32)
                                cols |= {"two": pa.array(other), "id": pa.array(out["id"]), "home": pa.array(np.full(len(out), home)), "asks": pa.array(asking[at]), "u": blob}
                            yield pa.RecordBatch.from_pydict(cols)

        return run

    key = ["g", "table", "part"]
    layout = f"g bigint, table int, part bigint, one int, two int, id {kind}, home boolean, asks boolean, u binary"
    tasks = hashable.mapInArrow(hashed(False), layout)
    counted = hashable.mapInArrow(hashed(True), "g bigint, table int, part bigint, one int").groupBy(*key, "one").count()
    full = counted.filter(F.col("count") > full_bucket).select(*key, "one", F.ceil(F.col("count") / full_bucket).cast("int").alias("side"))
    full = materialize(full, "full")
    if not full.isEmpty():
        tasks, key = _in_chunks(tasks, full, key), [*key, "bucket", "chunk"]

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, one, two = (pdf[c].to_numpy() for c in ("id", "one", "two"))
        home, asks = pdf["home"].to_numpy(bool), pdf["asks"].to_numpy(bool)
        coarse = np.frombuffer(b"".join(pdf["u"]), dtype=np.int8).reshape(len(pdf), -1)
        out_a, out_b = [ids[:0]], [ids[:0]]
        # the rows of each bucket lie together: those that stand in it, and those that ask in it by one code or the other
        stand, ask = np.flatnonzero(home), np.concatenate([np.flatnonzero(asks), np.flatnonzero(asks & (two >= 0))])
        asked = np.concatenate([one[asks], two[asks & (two >= 0)]])
        stand, order = stand[np.argsort(one[stand], kind="stable")], np.argsort(asked, kind="stable")
        ask, asked = ask[order], asked[order]
        for bucket in np.unique(asked):
            here = stand[slice(*np.searchsorted(one[stand], [bucket, bucket + 1]))]
            asking = ask[slice(*np.searchsorted(asked, [bucket, bucket + 1]))]
            if not len(here):
                continue
            there = _float(coarse[here])
            for at in range(0, len(asking), 1024):
                q = asking[at : at + 1024]
                cos = _float(coarse[q]) @ there.T
                cos[ids[q][:, None] == ids[here][None, :]] = -2
                floor = np.full(len(q), max(min_cosine, -1.0) - SCREEN, np.float32)
                if k < len(here):
                    floor = np.maximum(floor, -np.partition(-cos, k - 1, axis=1)[:, k - 1] - 2 * SCREEN)
                r, c = np.nonzero(cos >= floor[:, None])
                out_a.append(ids[q][r])
                out_b.append(ids[here][c])
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        return pd.DataFrame({"g": np.full(len(a), pdf["g"].iloc[0], np.int64), "id_a": a, "id_b": b})

    met = tasks.groupBy(*key).applyInPandas(compare, f"g bigint, id_a {kind}, id_b {kind}").distinct()
    # few and narrow rows that several branches read: written once, or every branch would compare the buckets again
    met = materialize(met, "met")
    met = materialize(_exact_cosine(met, rows).filter(F.col("cosine") >= min_cosine), "cosines")
    if sure is not None:
        met = _made_sure(met, rows, k, min_cosine, sure, rows_per_part, kind)
    return _with_copies(met, members, rows.select("g", "id", "asks"), k).select("id_a", "id_b", "cosine", "place")


def _made_sure(met: DataFrame, rows: DataFrame, k: int, min_cosine: float, sure: float, rows_per_part: int, kind: str) -> DataFrame:
    """``met`` with the k nearest of all rows for the asking rows whose k-th find is below ``sure``.

    Rows are cut into parts and the unsure ones into blocks; a task compares one part with one block and returns k rows for each
    unsure row. The screen in one-byte vectors and the exact cosines are those of the hashed candidates.
    """
    best = F.row_number().over(Window.partitionBy("g", "id_a").orderBy(F.desc("cosine"), "id_b"))
    certain = met.withColumn("r", best).filter((F.col("r") == k) & (F.col("cosine") >= sure)).select("g", F.col("id_a").alias("id"))
    unsure = materialize(rows.filter("asks").select("g", "id", "v").join(certain, ["g", "id"], "left_anti"), "unsure")
    n_parts = max(1, -(-rows.count() // rows_per_part))
    n_blocks = max(1, -(-unsure.count() // rows_per_part))
    part = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(n_parts)).cast("int").alias("part")
    block = F.pmod(F.xxhash64("id", F.lit(12)), F.lit(n_blocks)).cast("int").alias("block")
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    here = rows.select("g", part, every(n_blocks, "block"), "id", "v")
    asking = unsure.select("g", every(n_parts, "part"), block, "id", "v")

    def local(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out_a, out_b = [left["id"].to_numpy()[:0]], [right["id"].to_numpy()[:0]]
        if len(left) and len(right):
            dim, ids = len(right["v"].iloc[0]), right["id"].to_numpy()
            unit = _unit(list(right["v"]), dim).astype(np.float32)
            for at in range(0, len(left), 512):
                q = left.iloc[at : at + 512]
                cos = _unit(list(q["v"]), dim).astype(np.float32) @ unit.T
                cos[q["id"].to_numpy()[:, None] == ids[None, :]] = -2
                floor = np.full(len(q), max(min_cosine, -1.0) - SCREEN, np.float32)
                if k < len(ids):
                    floor = np.maximum(floor, -np.partition(-cos, k - 1, axis=1)[:, k - 1] - 1e-5)
                r, c = np.nonzero(cos >= floor[:, None])
                out_a.append(q["id"].to_numpy()[r])
                out_b.append(ids[c])
        a = np.concatenate(out_a)
        g = (left if len(left) else right)["g"].iloc[0]
        return pd.DataFrame({"g": np.full(len(a), g, np.int64), "id_a": a, "id_b": np.concatenate(out_b)})

    key = ["g", "part", "block"]
    found = asking.groupBy(*key).cogroup(here.groupBy(*key)).applyInPandas(local, f"g bigint, id_a {kind}, id_b {kind}")
    exact = _exact_cosine(materialize(found, "unsure-met"), rows).filter(F.col("cosine") >= min_cosine)
    return materialize(met.unionByName(exact).distinct(), "made-sure")


def _in_chunks(tasks: DataFrame, full: DataFrame, key: list[str]) -> DataFrame:
    """``tasks`` with ``bucket`` and ``chunk``: the buckets in ``full`` are cut into ``side`` x ``side`` squares of home rows
    against asking rows; what is not full stays together, as bucket -1.

    A home row goes to the squares of its column, an asking row to those of its line, so that every pair of the bucket
    meets in one square, which holds a ``side``-th of the bucket's home rows and of its asking rows.
    """
    sides = full.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("one", "side"))).alias("sides"))
    side = {c: F.try_element_at("sides", F.col(c)) for c in ("one", "two")}
    no, yes, apart = F.lit(False), F.lit(True), F.lit(-1)
    place = lambda bucket, chunk, one, two, home, asks: F.struct(*[x.cast(t).alias(n) for x, t, n in ((bucket, "int", "bucket"), (chunk, "int", "chunk"), (one, "int", "one"), (two, "int", "two"), (home, "boolean", "home"), (asks, "boolean", "asks"))])
    none = F.array().cast("array<struct<bucket:int,chunk:int,one:int,two:int,home:boolean,asks:boolean>>")

    def squares(of: str, home: Column, asks: Column) -> Column:
        n, bucket = side[of], F.col(of)
        own, across = F.pmod(F.xxhash64("id", F.lit(3)), n).cast("int"), F.sequence(F.lit(0), n - 1)
        column = F.when(home, F.transform(across, lambda j: place(bucket, own * n + j, bucket, apart, yes, no))).otherwise(none)
        line = F.when(asks, F.transform(across, lambda j: place(bucket, j * n + own, bucket, apart, no, yes))).otherwise(none)
        return F.concat(column, line)

    home, asks, one, two = (F.col(c) for c in ("home", "asks", "one", "two"))
    first = F.when(side["one"].isNull(), F.array(place(apart, F.lit(0), one, apart, home, asks))).otherwise(squares("one", home, asks))
    second = F.when(two < 0, none).when(side["two"].isNull(), F.array(place(apart, F.lit(0), two, apart, no, yes))).otherwise(squares("two", no, yes))
    together = F.array(place(apart, F.lit(0), one, two, home, asks))
    places = F.when(side["one"].isNull() & side["two"].isNull(), together).otherwise(F.concat(first, second))
    others = [*key, "id", "u"]
    return tasks.join(sides, key, "left").select(*others, F.explode(places).alias("at")).select(*others, "at.*")


def _exact_cosine(met: DataFrame, rows: DataFrame) -> DataFrame:
    """``met`` with the cosine of the original vectors in double precision, rounded to nine decimals.

    Each unordered pair is computed once; both joins use one exchange of the vectors.
    """
    pairs = met.select("g", F.least("id_a", "id_b").alias("lo"), F.greatest("id_a", "id_b").alias("hi")).distinct()
    of = lambda name: rows.select("g", F.col("id").alias(name), F.col("v").alias("v_" + name))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda acc, p: acc + p)
    both = pairs.join(of("lo"), ["g", "lo"]).join(of("hi"), ["g", "hi"])
    cosine = F.round(dot(F.col("v_lo"), F.col("v_hi")) / F.sqrt(dot(F.col("v_lo"), F.col("v_lo")) * dot(F.col("v_hi"), F.col("v_hi"))), 9)
    known = both.select("g", "lo", "hi", cosine.alias("cosine"))
    ordered = met.withColumn("lo", F.least("id_a", "id_b")).withColumn("hi", F.greatest("id_a", "id_b"))
    return ordered.join(known, ["g", "lo", "hi"]).select("g", "id_a", "id_b", "cosine")


def _with_copies(met: DataFrame, members: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """The k best of each asking row, exact copies included.

    A copy's partners are the first k other copies and what its representative met; a met representative brings its first
    k + 1 copies along. Only the first k + 1 copies of a group can be anyone's partner, so nothing grows with the copies
    but their own rows.
    """
    order = F.row_number().over(Window.partitionBy("g", "rep").orderBy("id"))
    ordered = members.withColumn("i", order)
    front = ordered.filter(F.col("i") <= k + 1).select("g", "rep", F.col("id").alias("front"))
    reps = members.select("g", F.col("rep").alias("id_a")).distinct()
    # what each representative met, its partners expanded to the first copies of them
    wide = met.join(front.withColumnRenamed("rep", "id_b"), ["g", "id_b"], "left").select("g", "id_a", F.coalesce("front", "id_b").alias("id_b"), "cosine")
    best = F.row_number().over(Window.partitionBy("g", "id_a").orderBy(F.desc("cosine"), "id_b"))
    wide = wide.withColumn("place", best).filter(F.col("place") <= k).drop("place")
    single = wide.join(reps, ["g", "id_a"], "left_anti")
    askers = members.filter("asks").select("g", F.col("rep").alias("id_a"), F.col("id").alias("asker"))
    met_by_copies = wide.join(askers, ["g", "id_a"]).select("g", F.col("asker").alias("id_a"), "id_b", "cosine")
    each_other = askers.join(front.withColumnRenamed("rep", "id_a"), ["g", "id_a"]).filter("asker <> front").select("g", F.col("asker").alias("id_a"), F.col("front").alias("id_b"), F.lit(1.0).alias("cosine"))
    asking = rows.filter("asks").select("g", F.col("id").alias("id_a"))
    everything = single.join(asking, ["g", "id_a"], "left_semi").unionByName(met_by_copies).unionByName(each_other)
    return everything.withColumn("place", best).filter(F.col("place") <= k)


def mutual(similar: DataFrame) -> DataFrame:
    """``id_a, id_b`` of the rows that are among each other's most similar, the smaller id first."""
    back = similar.select(F.col("id_b").alias("id_a"), F.col("id_a").alias("id_b"))
    return similar.select("id_a", "id_b").filter("id_a < id_b").join(back, ["id_a", "id_b"], "left_semi")
