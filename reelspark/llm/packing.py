"""Problem 7: fill fixed-capacity containers by multiway number differencing (Karmarkar and Karp)."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.tokens import with_token_counts
from reelspark.session import materialize


#: A partition holds several shards, one after another, where there are more than twice as many.
MOST_PARTITIONS = 20_000


def differencing(sizes: np.ndarray, ways: int) -> np.ndarray:
    """The subset (0 .. ways-1) of each size by largest differencing over ``ways`` subsets.

    A partial partition is kept as its non-zero subset sums in falling order, less their minimum once all subsets are in
    use. The two partitions with the largest spread are merged so that large sums of one meet small sums of the other.
    """
    n = len(sizes)
    parent = np.arange(n)
    order = np.argsort(-sizes, kind="stable")
    state = {int(i): (np.array([sizes[i]], dtype=np.int64), np.array([i])) for i in order}
    heap = [(-int(sizes[i]), k, int(i)) for k, i in enumerate(order)]  # sorted, so already a heap
    tick = n
    while len(heap) > 1:
        (_, _, a), (_, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        (sa, ra), (sb, rb) = state.pop(a), state.pop(b)
        if len(sa) < len(sb):
            (sa, ra), (sb, rb) = (sb, rb), (sa, ra)
        over = len(sa) + len(sb) - ways
        if over > 0:  # the smallest sums of a take the largest of b, in opposite order
            at = np.arange(len(sa) - over, len(sa))
            sa = sa.copy()
            sa[at] += sb[:over][::-1]
            parent[rb[:over]] = ra[at][::-1]
            sb, rb = sb[over:], rb[over:]
        sums, roots = np.concatenate([sa, sb]), np.concatenate([ra, rb])
        by = np.argsort(-sums, kind="stable")
        sums, roots = sums[by], roots[by]
        if len(sums) == ways:
            sums = sums - sums[-1]
        key = int(roots[0])
        state[key] = (sums, roots)
        heapq.heappush(heap, (-int(sums[0]), tick, key))
        tick += 1
    for _ in range(64):  # path halving until every item points at a root
        up = parent[parent]
        if np.array_equal(up, parent):
            break
        parent = up
    return np.unique(parent, return_inverse=True)[1] if n else parent


def fill(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """A container for each size, none above ``capacity``; starts at the least possible number of containers."""
    ways = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        at = differencing(sizes, ways)
        if len(at) == 0 or np.bincount(at, weights=sizes).max() <= capacity:
            return at
        ways += max(1, ways // 400)


def pack(
    items: DataFrame, *, id: str, size: str, capacity: int, items_per_shard: int = 2048,
) -> DataFrame:
    """Assign items to containers of ``capacity`` with little room left over.

    Returns ``id, piece_no, piece_start, piece_size, container_id``. An item is whole (one piece 0) unless it alone is
    larger than a container; then full containers are cut off it and the rest is packed like any item.

    Items are spread over shards by a hash of the id, each shard is packed by differencing in one task; a shard's waste is
    about one container in ``items_per_shard`` items, whatever the table's size. No shard depends on another, so skew in
    the sizes only changes how many containers a shard has.

    Items with a null or non-positive size, or a null id, are left out. Equal sizes are taken in order of id, so the
    result does not depend on the order of the rows; repeated ids are packed as separate items. An empty table gives an
    empty result.
    """
    kept = items.select(F.col(f"`{id}`").alias("id"), F.col(f"`{size}`").cast("bigint").alias("size")).filter("id is not null and size > 0")
    shards = max(1, -(-kept.count() // items_per_shard))
    full = F.floor(F.col("size") / capacity).cast("bigint")
    kept = kept.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(shards)))
    whole = kept.filter(F.col("size") > capacity).select("id", "shard", "size", F.explode(F.sequence(F.lit(0), full - 1)).alias("piece_no"))
    whole = whole.select("id", F.col("piece_no").cast("bigint").alias("piece_no"), (F.col("piece_no") * capacity).cast("bigint").alias("piece_start"),
                         F.lit(capacity).cast("bigint").alias("piece_size"), F.concat(F.lit("f"), F.col("id").cast("string"), F.lit("-"), F.col("piece_no").cast("string")).alias("container_id"))
    rest = kept.select("id", "shard", F.when(F.col("size") > capacity, F.pmod("size", F.lit(capacity))).otherwise(F.col("size")).cast("bigint").alias("piece_size"),
                       F.when(F.col("size") > capacity, full).otherwise(0).cast("bigint").alias("piece_no")).filter("piece_size > 0")
    kind = rest.schema["id"].dataType.simpleString()

    def shard_fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "piece_size"], kind="stable")
        at = fill(pdf["piece_size"].to_numpy(np.int64), capacity)
        name = pdf["shard"].astype(str) + "-" + pd.Series(at, index=pdf.index).astype(str)
        return pd.DataFrame({"id": pdf["id"], "piece_no": pdf["piece_no"], "piece_start": pdf["piece_no"] * capacity, "piece_size": pdf["piece_size"], "container_id": name})

    # the rows are few bytes but much work: an explicit number of partitions keeps the shards apart
    packed = rest.repartition(min(max(1, shards // 2), MOST_PARTITIONS), "shard").groupBy("shard").applyInPandas(shard_fill, f"id {kind}, piece_no bigint, piece_start bigint, piece_size bigint, container_id string")
    return packed.unionByName(whole).withColumnRenamed("id", id)


def pack_documents(docs: DataFrame, *, capacity: int = 2048, tokenizer: str | None = None, items_per_shard: int = 2048) -> DataFrame:
    """Containers for the non-empty ``text`` of each ``doc_id``, sized in tokens."""
    sized = materialize(with_token_counts(docs.select("doc_id", "text").filter("doc_id is not null and length(text) > 0"), "text", tokenizer=tokenizer), "sizes")
    return pack(sized, id="doc_id", size="n_tokens", capacity=capacity, items_per_shard=items_per_shard)


def containers(packed: DataFrame, capacity: int) -> DataFrame:
    """``container_id, n_pieces, n_tokens, n_free`` of a packing."""
    return packed.groupBy("container_id").agg(F.count(F.lit(1)).alias("n_pieces"), F.sum("piece_size").alias("n_tokens"), (F.lit(capacity) - F.sum("piece_size")).alias("n_free"))
