"""Terms, postings and lexical search as plain DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelspark.functions import scores as S
from reelspark.functions import text as X
from reelspark.operators.blocks import block_scores, many
from reelspark.session import materialize

# The weight of each text field in BM25.
FIELD_WEIGHTS = {"subtitle_text": 1.5, "ocr_text": 0.7, "combined_text": 1.0, "entities_text": 2.5}


def latest_documents(docs: DataFrame) -> DataFrame:
    """One row for each ``document_id``, the one written last: insert-or-replace as a top-1 by time, then by ``doc_id``."""
    last = F.row_number().over(Window.partitionBy("document_id").orderBy(F.desc_nulls_last("generated_at"), F.desc("doc_id")))
    return docs.filter("document_id is not null").withColumn("__last", last).filter("__last = 1").drop("__last")


def term_frequencies(docs: DataFrame, text: str = "combined_text", id: str = "document_id") -> DataFrame:
    """``id, term, tf`` of the index terms; texts without any give no rows."""
    return docs.select(id, F.explode(X.index_terms(F.col(text))).alias("term")).groupBy(id, "term").agg(F.count(F.lit(1)).alias("tf"))


def idf_stats(tf: DataFrame, id: str = "document_id") -> DataFrame:
    """``term, document_frequency, inverse_document_frequency``; N counts the documents with at least one term, at least 1."""
    n = tf.agg(F.greatest(F.countDistinct(id), F.lit(1)).alias("n"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("document_frequency"))
    return df.crossJoin(F.broadcast(n)).select("term", "document_frequency", S.smoothed_idf(F.col("document_frequency"), F.col("n")).alias("inverse_document_frequency"))  # n is one row


def document_norms(tf: DataFrame, idf: DataFrame, id: str = "document_id") -> DataFrame:
    """``id, vector_norm`` of the (1 + ln tf) idf vectors; 0 counts as 1."""
    w = S.log_tf(F.col("tf")) * F.col("inverse_document_frequency")
    norm = F.sqrt(F.sum(w * w))
    return tf.join(idf, "term").groupBy(id).agg(F.when(norm > 0, norm).otherwise(1.0).alias("vector_norm"))


def terms_of_queries(queries: DataFrame, fallback: bool) -> DataFrame:
    """``query_id, term, qtf``; with ``fallback`` a query of stopwords alone keeps all its tokens (once each)."""
    if fallback:
        return queries.select("query_id", F.explode(X.query_terms(F.col("query"))).alias("term")).withColumn("qtf", F.lit(1))
    return queries.select("query_id", F.explode(X.index_terms(F.col("query"))).alias("term")).groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))


def ranked(df: DataFrame, order: list, limit: int, rank: str, by: str = "query_id") -> DataFrame:
    """The first ``limit`` rows of each query with their rank from 1; Spark cuts before the shuffle as well."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col(rank) <= limit)


def tfidf_search(tf: DataFrame, idf: DataFrame, norms: DataFrame, queries: DataFrame, limit: int = 50, id: str = "document_id") -> DataFrame:
    """``query_id, id, tfidf_score, tfidf_rank``: cosine of the tf-idf vectors; terms unknown to the index are ignored.

    Many queries are scored in blocks; ``tf`` is then read more than once and should be stored.
    """
    q = terms_of_queries(queries, False).join(idf, "term").withColumn("qw", S.log_tf(F.col("qtf")) * F.col("inverse_document_frequency"))
    qnorm = q.groupBy("query_id").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qnorm"))
    if many(queries):
        asked = q.join(qnorm, "query_id").select("query_id", "term", (F.col("qw") * F.col("inverse_document_frequency")).alias("weight"), F.col("qnorm").alias("scale"))
        values = tf.filter(F.col(id).isNotNull()).select("term", id, S.log_tf(F.col("tf")).alias("value"))
        best = block_scores(values, asked, id, limit, norms.filter(F.col(id).isNotNull()).select(id, F.col("vector_norm").alias("norm")))
        return ranked(best.select("query_id", id, F.col("score").alias("tfidf_score")), [F.desc("tfidf_score"), id], limit, "tfidf_rank")
    dots = tf.join(q, "term").groupBy("query_id", id).agg(F.sum(F.col("qw") * S.log_tf(F.col("tf")) * F.col("inverse_document_frequency")).alias("dot"))
    scored = dots.join(qnorm, "query_id").join(norms, id).select("query_id", id, F.round(F.col("dot") / (F.col("qnorm") * F.col("vector_norm")), 9).alias("tfidf_score"))
    return ranked(scored, [F.desc("tfidf_score"), id], limit, "tfidf_rank")


def _weighed_terms(docs: DataFrame, weights: dict[str, float], id: str, terms: DataFrame | None = None, text: str | None = None) -> DataFrame:
    """``term, id, f, dl``: each document's terms (of ``terms`` only, if given) with their weighted frequency and its length; with ``text`` also ``own``: whether that field has the term."""
    words = docs.select(id, *[X.tokens(F.col(f)).alias(f) for f in weights]).withColumn("dl", reduce(lambda a, c: a + c, [F.size(f) for f in weights]))
    fields = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(f == text).alias("own"), F.col(f).alias("t")) for f, w in weights.items()])
    each = words.select(id, "dl", F.explode(fields).alias("f")).select(id, "dl", F.col("f.w").alias("w"), F.col("f.own").alias("own"), F.explode("f.t").alias("term"))
    if terms is not None:
        each = each.join(terms, "term")
    return each.groupBy("term", id, "dl").agg(F.sum("w").alias("f"), *([F.max("own").alias("own")] if text else []))


def postings(docs: DataFrame, weights: dict[str, float] | None = None, id: str = "document_id") -> DataFrame:
    """``term, id, f, dl`` of every document and term, to be stored in order of term: a search then reads its terms alone."""
    return _weighed_terms(docs, weights or FIELD_WEIGHTS, id).select("term", id, "f", "dl")


def corpus_totals(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """One row ``n, avgdl``: the number of documents and their mean length in tokens."""
    length = reduce(lambda a, c: a + c, [F.size(X.tokens(F.col(f))) for f in weights or FIELD_WEIGHTS])
    return docs.select(length.alias("dl")).agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"))


def bm25_by_postings(hits: DataFrame, totals: DataFrame, asked: DataFrame, id: str = "document_id", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """``query_id, id, bm25_score`` from the postings of the asked terms (``query_id, term``)."""
    df = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    f, dl = F.col("f"), F.col("dl")
    part = S.bm25_idf(F.col("df"), F.col("n")) * f * (k1 + 1) / (f + k1 * (1 - b + b * dl / F.col("avgdl")))
    weighed = hits.join(df, "term").crossJoin(F.broadcast(totals)).select("term", id, part.alias("part"))  # totals is one row
    return weighed.join(asked, "term").groupBy("query_id", id).agg(F.round(-F.sum("part"), 9).alias("bm25_score"))


def bm25_in_blocks(docs: DataFrame, queries: DataFrame, weights: dict[str, float], id: str, k1: float = 1.2, b: float = 0.75, stored: DataFrame | None = None, totals: DataFrame | None = None, text: str | None = None, **kw) -> DataFrame:
    """The rows of :func:`bm25_scores` for many queries: postings are packed, nothing is shuffled by query and document.

    With ``text``, one of the fields, and a ``limit`` the query's terms in that text are counted as ``overlap``.
    """
    if stored is None or totals is None:
        stored, totals = materialize(_weighed_terms(docs, weights, id, text=text), "postings"), materialize(corpus_totals(docs, weights), "totals")
    if text:
        own = stored.filter("own").select("term", id) if "own" in stored.columns else docs.select(id, F.explode(F.array_distinct(X.tokens(F.col(text)))).alias("term"))
        kw["texts"] = own
    f, dl = F.col("f"), F.col("dl")
    values = stored.crossJoin(F.broadcast(totals)).select("term", id, (f * (k1 + 1) / (f + k1 * (1 - b + b * dl / F.col("avgdl")))).alias("value"))  # totals is one row
    df = stored.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    asked = terms_of_queries(queries, True).join(df, "term").crossJoin(F.broadcast(totals)).select("query_id", "term", S.bm25_idf(F.col("df"), F.col("n")).alias("weight"))
    return block_scores(values, asked, id, score="bm25_score", sign=-1, **kw)


def bm25_scores(docs: DataFrame, queries: DataFrame, weights: dict[str, float] | None = None, id: str = "document_id", k1: float = 1.2, b: float = 0.75, stored: DataFrame | None = None, totals: DataFrame | None = None, digits: int = 9) -> DataFrame:
    """``query_id, id, bm25_score`` of every document with a query term in any field; the more negative the better.

    A term's frequency is the weighted sum over the fields, its document frequency counts rows with it in any field, and
    a row's length is its number of tokens over all fields. Only the query's terms are ever shuffled; with ``stored``
    postings and ``totals`` no text is read. Many queries are scored in blocks (if all weights are above 0).
    """
    if min((weights or FIELD_WEIGHTS).values()) > 0 and many(queries):
        return bm25_in_blocks(docs, queries, weights or FIELD_WEIGHTS, id, k1, b, stored, totals, digits=digits)
    asked = terms_of_queries(queries, True).select("query_id", "term")
    terms = asked.select("term").distinct()
    if stored is not None and totals is not None:
        hits = stored.join(terms, "term")
    else:
        hits, totals = _weighed_terms(docs, weights or FIELD_WEIGHTS, id, terms), corpus_totals(docs, weights)
    scores = bm25_by_postings(hits, totals, asked, id, k1, b)
    return scores if digits >= 9 else scores.withColumn("bm25_score", F.round("bm25_score", digits))


def bm25_search(docs: DataFrame, queries: DataFrame, limit: int = 50, entity_hits: DataFrame | None = None, id: str = "document_id", text: str = "combined_text", stored: DataFrame | None = None, totals: DataFrame | None = None) -> DataFrame:
    """``query_id, id, bm25_score, entity_hit, overlap, bm25_rank``.

    The best 4 x ``limit`` by score are put in the order: matched by a query entity (``entity_hits``: ``query_id, id``),
    then more distinct query terms in the text, then the better score, then the id. Many queries are scored in blocks.
    """
    if text in FIELD_WEIGHTS and many(queries):
        wide = bm25_in_blocks(docs, queries, FIELD_WEIGHTS, id, stored=stored, totals=totals, limit=4 * limit, text=text).filter(F.col("query_id").isNotNull() & F.col(id).isNotNull())
    else:
        wide = ranked(bm25_scores(docs, queries, id=id, stored=stored, totals=totals), ["bm25_score", id], 4 * limit, "by_score")
        asked = queries.select("query_id", X.query_terms(F.col("query")).alias("qt"))
        wide = wide.join(docs.select(id, F.col(text).alias("__text")), id).join(asked, "query_id")
        wide = wide.withColumn("overlap", F.size(F.array_intersect("qt", X.tokens(F.col("__text")))))
    if entity_hits is not None:
        wide = wide.join(entity_hits.select("query_id", id).distinct().withColumn("hit", F.lit(True)), ["query_id", id], "left")
        wide = wide.withColumn("entity_hit", F.coalesce("hit", F.lit(False)))
    else:
        wide = wide.withColumn("entity_hit", F.lit(False))
    out = ranked(wide, [F.desc("entity_hit"), F.desc("overlap"), "bm25_score", id], limit, "bm25_rank")
    return out.select("query_id", id, "bm25_score", "entity_hit", "overlap", "bm25_rank")


def match_any(docs: DataFrame, queries: DataFrame, id: str = "document_id", fields: tuple[str, ...] = tuple(FIELD_WEIGHTS)) -> DataFrame:
    """``query_id, id`` of the documents with any of a query's terms in any of the indexed fields; of many queries in blocks."""
    every = F.array_distinct(F.flatten(F.array(*[F.coalesce(X.tokens(F.col(f)), F.array().cast("array<string>")) for f in fields])))
    words = docs.select(id, F.explode(every).alias("term"))
    if many(queries):
        values, asked = materialize(words, "words").withColumn("value", F.lit(1.0)), terms_of_queries(queries, True)
        return block_scores(values, asked.select("query_id", "term", F.lit(1.0).alias("weight")), id, digits=None)
    return words.join(terms_of_queries(queries, True).select("query_id", "term"), "term").select("query_id", id).distinct()
