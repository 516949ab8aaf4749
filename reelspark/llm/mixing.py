"""Problem 8: mix sources to target shares by subset-sum budget fitting."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.llm.tokens import with_token_counts
from reelspark.session import materialize


def clean_source(source: Column) -> Column:
    """One label for a source however it was typed: lower case, trimmed, blanks and hyphens as underscores."""
    return F.regexp_replace(F.lower(F.trim(source)), r"[\s\-_]+", "_")


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int, exact_below: int = 16384) -> np.ndarray:
    """How many items of each length to take so that their sum comes as near to ``budget`` from below as possible.

    Every length first gets its proportional share, further single items in seeded order bring the rest below
    ``exact_below``, and a bounded knapsack over the remaining counts fits that rest exactly wherever it can be fitted.
    """
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    take = (counts * (budget / total)).astype(np.int64) if budget > 0 else np.zeros_like(counts)
    take = np.minimum(take, counts)
    rest = budget - int((take * lengths).sum())
    for k in np.argsort(-take, kind="stable"):  # the proportional part may be above by rounding of doubles
        while rest < 0 and take[k] > 0:
            take[k] -= 1
            rest += int(lengths[k])
    order = np.random.default_rng(seed).permutation(len(lengths))
    moved = True
    while rest > exact_below and moved:
        moved = False
        for k in order:
            if rest > exact_below and take[k] < counts[k] and lengths[k] <= rest:
                take[k] += 1
                rest -= int(lengths[k])
                moved = True
    if rest <= 0:
        return take
    # bounded knapsack by bit sets: bit s is set where the sum s can be reached; counts are split into powers of two
    reach, mask, steps = 1, (1 << (rest + 1)) - 1, []
    for k in order:
        left, part = min(int(counts[k] - take[k]), rest // int(lengths[k])), 1
        while left > 0 and not reach >> rest & 1:
            use = min(part, left)
            steps.append((k, use, reach))
            reach |= (reach << use * int(lengths[k])) & mask
            left, part = left - use, part * 2
        if reach >> rest & 1:
            break
    at = reach.bit_length() - 1
    for k, use, earlier in reversed(steps):
        if not earlier >> at & 1:
            take[k] += use
            at -= use * int(lengths[k])
    return take


def mix(docs: DataFrame, targets: DataFrame, *, id: str, source: str, size: str, seed: int = 11, per_bucket: int = 20_000) -> DataFrame:
    """Choose items so that each source has its target share of the total size.

    ``docs`` has an id, a clean source and a size; ``targets`` has ``source, target_share, max_repeats``. The total is
    the largest for which no source needs more than its items ``max_repeats`` times. A source's budget is first spent on
    whole passes over it, the remainder by :func:`fit_budget` on the counts by exact length; which items of a length are
    taken is decided by a seeded hash. Returns ``id, source, size, copies`` with ``copies`` from 1 to ``max_repeats``.

    Items of a source without target, with a null id or source, or of size 0 are not used. A target without items is
    ignored and the shares of the others keep their proportions. Items of one length are ordered in buckets of about
    ``per_bucket``, however many there are. Repeated ids count as separate items. An empty table
    gives an empty result. ``docs`` is read three times, so pass a written table.
    """
    d = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{source}`").alias("src"), F.col(f"`{size}`").cast("bigint").alias("len")).filter("id is not null and src is not null and len > 0")
    t = targets.select(F.col("source").alias("src"), F.col("target_share").cast("double").alias("share"), F.greatest(F.col("max_repeats").cast("bigint"), F.lit(0)).alias("reps")).filter("src is not null and share > 0 and reps > 0").dropDuplicates(["src"])
    # templated items may have one length: the number of buckets follows the number of items
    buckets = max(1, -(-d.count() // per_bucket))
    d = d.withColumn("b", F.pmod(F.shiftright(F.xxhash64("id", F.lit(seed)), 20), F.lit(buckets)))
    by_bucket = d.groupBy("src", "len", "b").agg(F.count(F.lit(1)).alias("c"))
    by_length = by_bucket.groupBy("src", "len").agg(F.sum("c").alias("c"))
    # one row a source from here: the total that all sources can reach, and each source's budget
    sums = by_length.groupBy("src").agg(F.sum(F.col("len") * F.col("c")).alias("tokens")).join(t, "src")
    everything = Window.partitionBy(F.lit(0))
    sums = sums.withColumn("whole", F.sum("share").over(everything)).withColumn("total", F.min(F.col("tokens") * F.col("reps") * F.col("whole") / F.col("share")).over(everything))
    budget = F.least(F.floor(F.col("total") * F.col("share") / F.col("whole") + 1e-6).cast("bigint"), F.col("tokens") * F.col("reps"))
    plan_in = by_length.join(sums.select("src", "tokens", "reps", budget.alias("budget")), "src")

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("len")
        tokens, want = int(pdf["tokens"].iloc[0]), int(pdf["budget"].iloc[0])
        passes = want // tokens
        extra = fit_budget(pdf["len"].to_numpy(np.int64), pdf["c"].to_numpy(np.int64), want - passes * tokens, seed)
        return pd.DataFrame({"src": pdf["src"], "len": pdf["len"], "passes": passes, "extra": extra})

    # at most one row for each length that occurs in a source, however many items there are
    plans = plan_in.groupBy("src").applyInPandas(plan, "src string, len bigint, passes bigint, extra bigint")
    before = F.sum("c").over(Window.partitionBy("src", "len").orderBy("b")) - F.col("c")
    quota = by_bucket.withColumn("before", before).join(plans, ["src", "len"]).select("src", "len", "b", "passes", (F.col("extra") - F.col("before")).alias("quota"))
    place = F.row_number().over(Window.partitionBy("src", "len", "b").orderBy(F.xxhash64("id", F.lit(seed)), "id"))
    chosen = d.withColumn("place", place).join(quota, ["src", "len", "b"])
    copies = F.col("passes") + (F.col("place") <= F.col("quota")).cast("bigint")
    return chosen.select(F.col("id").alias(id), F.col("src").alias("source"), F.col("len").alias(size), copies.alias("copies")).filter("copies > 0")


def sized_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, source, n_tokens`` with the clean source, written once to the shared folder."""
    d = docs.select("doc_id", clean_source(F.col("source")).alias("source"), "text").filter("doc_id is not null and source is not null and length(text) > 0")
    return materialize(with_token_counts(d, "text", tokenizer=tokenizer), "mix")


def shares(selection: DataFrame, targets: DataFrame, size: str = "n_tokens") -> DataFrame:
    """Reached next to wanted shares: one row for each target."""
    got = selection.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), F.sum(F.col(size) * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"))
    total = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    return (
        targets.select("source", "target_share", "max_repeats").join(got, "source", "left")
        .select("source", "target_share", (F.coalesce("tokens", F.lit(0)) / total).alias("actual_share"), "max_repeats", F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
                F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.coalesce("tokens", F.lit(0)).alias("tokens"))
    )
