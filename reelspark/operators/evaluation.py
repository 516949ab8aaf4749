"""Query sets for retrieval evaluation: seeding, validation and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.functions import text as X


def eligible(docs: DataFrame, min_length: int = 120, text: str = "combined_text") -> DataFrame:
    return docs.filter(F.length(text) >= min_length)


def stratified(docs: DataFrame, count: int) -> DataFrame:
    """``count`` documents taken round by round from every video in turn, with ``n`` from 1.

    A video gives in round r its document at place floor((r + 1) x size / (rounds + 1)) by time, so a video with few
    documents can give one twice; an unknown time comes first, documents without video are left out. The number of rounds is ``count`` over the number of videos, rounded up.
    """
    docs, by = docs.filter("video_id is not null"), Window.partitionBy("video_id")
    placed = docs.withColumn("place", F.row_number().over(by.orderBy("start_seconds", "document_id")) - 1).withColumn("size", F.count(F.lit(1)).over(by))
    rounds = docs.agg(F.ceil(F.lit(count) / F.greatest(F.countDistinct("video_id"), F.lit(1))).cast("bigint").alias("rounds"))
    turns = placed.select("video_id", "size").distinct().crossJoin(F.broadcast(rounds))  # one row
    turns = turns.withColumn("round", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rounds") - 1)))
    turns = turns.withColumn("place", F.least(F.floor((F.col("round") + 1) * F.col("size") / (F.col("rounds") + 1)), F.col("size") - 1)).select("video_id", "round", "place")
    first = turns.join(placed, ["video_id", "place"]).orderBy("round", "video_id").limit(count)
    return first.withColumn("n", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("round", "video_id"))).drop("place", "size", "round")


def token_frequencies(docs: DataFrame, text: str = "combined_text") -> DataFrame:
    """``token, df``: in how many documents a lower-case token occurs."""
    return docs.select(F.explode(F.array_distinct(F.transform(X.raw_tokens(F.col(text)), F.lower))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def seed_queries(docs: DataFrame, count: int = 60, min_length: int = 120) -> DataFrame:
    """``query_id, query, query_type, relevant_document_ids``: bootstrap queries in three kinds by turns.

    The first 14 tokens of the richest sentence; the six rarest of its tokens (rarer, then longer, then by name); the
    document's first entity with four of those. They are no human judgements.
    """
    pool = eligible(docs, min_length)
    picked = stratified(pool, count).withColumn("sentence", X.choose_sentence(F.col("combined_text"))).withColumn("tokens", X.raw_tokens(F.col("sentence")))
    long = picked.select("n", F.explode(F.array_distinct("tokens")).alias("token")).filter(F.length("token") >= 3).withColumn("low", F.lower("token"))
    long = long.filter(~F.col("low").isin(*X.GENERIC_WORDS)).groupBy("n", "low").agg(F.min("token").alias("token"))
    df = token_frequencies(pool)
    ranked = long.join(df, long.low == df.token).select("n", long.low, long.token, "df")
    keys = ranked.groupBy("n").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", (-F.length("low")).alias("l"), "low", "token"))), lambda x: x["token"]).alias("rare"))
    named = F.get(F.filter(F.transform(F.coalesce("entities", F.array().cast("array<struct<text:string,type:string>>")), lambda e: e["text"]), lambda t: F.length(t) >= 3), F.lit(0))
    out = picked.join(keys, "n", "left").withColumn("rare", F.coalesce("rare", F.array().cast("array<string>"))).withColumn("named", named)
    kind = (F.col("n") - 1) % 3
    words = lambda c, k: F.array_join(F.slice(c, 1, k), " ")
    keyed, both = (kind == 1) & (F.size("rare") > 0), (kind == 2) & F.col("named").isNotNull() & (F.size("rare") > 0)
    query = F.when(keyed, words("rare", 6)).when(both, F.concat_ws(" ", "named", words("rare", 4))).when(kind == 0, words("tokens", 14)).otherwise(words("tokens", 12))
    label = F.when(keyed, "distinct_keywords").when(both, "entity_context").otherwise("sentence_excerpt")
    return out.select(F.format_string("q%03d", "n").alias("query_id"), query.alias("query"), label.alias("query_type"), F.array("document_id").alias("relevant_document_ids"), F.lit(False).alias("reviewed"))


def violations(queries: DataFrame, docs: DataFrame) -> DataFrame:
    """``query_id, problem``: all faults of a query set at once."""
    of = lambda cond, text: queries.filter(cond).select("query_id", F.lit(text).alias("problem"))
    twice = queries.filter("query_id is not null").groupBy("query_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("query_id", F.lit("duplicate id").alias("problem"))
    labels = queries.select("query_id", F.explode("relevant_document_ids").alias("document_id"))
    unknown = labels.join(docs.select("document_id").distinct(), "document_id", "left_anti").select("query_id", F.concat(F.lit("unknown document "), "document_id").alias("problem"))
    return (
        of(F.coalesce(F.trim("query_id"), F.lit("")) == "", "missing id").unionByName(twice).unionByName(of(F.coalesce(F.trim("query"), F.lit("")) == "", "empty query"))
        .unionByName(of(F.coalesce(F.size("relevant_document_ids"), F.lit(0)) <= 0, "no labels")).unionByName(unknown)
    )


def reviewed(queries: DataFrame) -> DataFrame:
    """The queries that a person has reviewed."""
    return queries.filter(F.coalesce("reviewed", F.lit(False)))


def query_metrics(runs: DataFrame, queries: DataFrame, rank: str = "rank", id: str = "document_id") -> DataFrame:
    """``mode, query_id, first_relevant_rank, recall_at_5, recall_at_10, reciprocal_rank`` of each mode and labelled query.

    ``runs`` has ``mode, query_id, id, rank``; a query without a relevant hit scores zero in every mode that was run.
    """
    labels = queries.select("query_id", F.explode(F.array_distinct("relevant_document_ids")).alias(id))
    size = labels.groupBy("query_id").agg(F.count(F.lit(1)).alias("labels"))
    hits = runs.join(labels, ["query_id", id]).groupBy("mode", "query_id").agg(F.min(rank).alias("first_relevant_rank"), F.count_if(F.col(rank) <= 5).alias("h5"), F.count_if(F.col(rank) <= 10).alias("h10"))
    every = size.crossJoin(runs.select("mode").distinct())  # the few modes of a run
    out = every.join(hits, ["mode", "query_id"], "left")
    part = lambda c: F.coalesce(F.col(c), F.lit(0)) / F.col("labels")
    return out.select("mode", "query_id", "first_relevant_rank", part("h5").alias("recall_at_5"), part("h10").alias("recall_at_10"), F.coalesce(1 / F.col("first_relevant_rank"), F.lit(0.0)).alias("reciprocal_rank"))


def report(metrics: DataFrame) -> DataFrame:
    """Means over the queries of each mode."""
    mean = lambda c, name: F.round(F.avg(c), 9).alias(name)
    return metrics.groupBy("mode").agg(F.count(F.lit(1)).alias("queries"), mean("recall_at_5", "recall_at_5"), mean("recall_at_10", "recall_at_10"), mean("reciprocal_rank", "mrr"))


def interpolated_percentile(value: str | Column, ratio: float) -> Column:
    """The percentile with linear interpolation; 0 for no values."""
    return F.coalesce(F.percentile(value, F.lit(ratio)), F.lit(0.0))
