"""The queries of the reference operators, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions import scores as S
from reelspark.functions import text as X
from reelspark.operators import documents as D
from reelspark.operators import entities as E
from reelspark.operators import evaluation as V
from reelspark.operators import fusion as U
from reelspark.operators import incremental as I
from reelspark.operators import interval as N
from reelspark.operators import jobs as J
from reelspark.operators import keyframes as K
from reelspark.operators import lexical as L
from reelspark.operators import planner as P
from reelspark.operators import search as R
from reelspark.operators import vectors as W
from reelspark.session import materialize, shared_dir
from reelspark.sources import readers, sinks

SEARCHES = (
    ("s1", "cây cầu treo"), ("s2", "lò nung gốm trước ống kính"), ("s3", "the coastal road in front of the lens"), ("s4", "Silverfen Data Systems Corporation"),
    ("s5", "vườn ươm bên bờ sông"), ("s6", "карту приливов"), ("s7", "Richard Lysterfjeld"), ("s8", "tại sao cần giống lúa chịu mặn"), ("s9", '"K11 TV" logo trên màn hình'), ("s10", "của và là"),
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def searches(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEARCHES, "query_id string, query string")


def stated_searches(spark: SparkSession, sf: str) -> DataFrame:
    """The stated query set: the text of every cue with an id divisible by 20; null and empty texts ask nothing."""
    cues = table(spark, sf, "subtitle_cues").filter("cue_id % 20 = 0 and length(text) > 0")
    return cues.select(F.concat(F.lit("c"), F.col("cue_id").cast("string")).alias("query_id"), F.col("text").alias("query"))


def _asked(spark: SparkSession, asked: DataFrame | None) -> DataFrame:
    return searches(spark) if asked is None else asked


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return L.latest_documents(table(spark, sf, "documents"))


def _terms(spark: SparkSession, sf: str) -> DataFrame:
    return L.term_frequencies(_docs(spark, sf))


def latest_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("document_id", "doc_id", "generated_at")


def term_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return _terms(spark, sf)


def idf_stats(spark: SparkSession, sf: str) -> DataFrame:
    return L.idf_stats(_terms(spark, sf)).withColumn("inverse_document_frequency", F.round("inverse_document_frequency", 9))


def document_norms(spark: SparkSession, sf: str) -> DataFrame:
    tf = _terms(spark, sf)
    return L.document_norms(tf, L.idf_stats(tf)).withColumn("vector_norm", F.round("vector_norm", 6))


def tfidf_search(spark: SparkSession, sf: str, asked: DataFrame | None = None) -> DataFrame:
    tf = _terms(spark, sf) if asked is None else materialize(_terms(spark, sf), "terms")
    idf = L.idf_stats(tf)
    out = L.tfidf_search(tf, idf, L.document_norms(tf, idf), _asked(spark, asked))
    return out.select("query_id", "document_id", F.round("tfidf_score", 6).alias("tfidf_score"), "tfidf_rank")


def _aliases(spark: SparkSession, sf: str) -> DataFrame:
    return E.alias_dimension(table(spark, sf, "entity_aliases"))


def _entities(spark: SparkSession, sf: str) -> DataFrame:
    return E.canonicalize(E.listed_entities(_docs(spark, sf)), _aliases(spark, sf))


def _alias_keys(spark: SparkSession, sf: str, asked: DataFrame | None = None) -> DataFrame:
    return E.alias_hits(_asked(spark, asked), _aliases(spark, sf), "query", "query_id").select("query_id", "canonical_key").distinct()


def bm25_search(spark: SparkSession, sf: str, asked: DataFrame | None = None) -> DataFrame:
    hits = _entities(spark, sf).join(_alias_keys(spark, sf, asked), "canonical_key").select("query_id", "document_id")
    docs = _docs(spark, sf).select("document_id", *L.FIELD_WEIGHTS)
    out = L.bm25_search(docs if asked is None else materialize(docs, "documents"), _asked(spark, asked), 20, hits)
    return out.withColumn("bm25_score", F.round("bm25_score", 6))


def bm25_scores(spark: SparkSession, sf: str, asked: DataFrame | None = None) -> DataFrame:
    return L.bm25_scores(_docs(spark, sf), _asked(spark, asked), digits=6)


def fts_match(spark: SparkSession, sf: str, asked: DataFrame | None = None) -> DataFrame:
    return L.match_any(_docs(spark, sf), _asked(spark, asked))


def entity_email(spark: SparkSession, sf: str) -> DataFrame:
    return E.pattern_entities(table(spark, sf, "documents"), "text", E.EMAIL, "EMAIL", "doc_id")


def entity_acronym(spark: SparkSession, sf: str) -> DataFrame:
    return E.pattern_entities(table(spark, sf, "documents"), "combined_text", E.ACRONYM, "ORG", "doc_id")


def entity_rules(spark: SparkSession, sf: str) -> DataFrame:
    return E.rule_entities(_docs(spark, sf))


def document_entities(spark: SparkSession, sf: str) -> DataFrame:
    return E.document_entities(_docs(spark, sf), _aliases(spark, sf))


def alias_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return _aliases(spark, sf)


def alias_containment(spark: SparkSession, sf: str) -> DataFrame:
    return E.alias_hits(_docs(spark, sf), _aliases(spark, sf)).select("document_id", "alias_key", "canonical_key", "entity_type").distinct()


def canonical_entities(spark: SparkSession, sf: str) -> DataFrame:
    return _entities(spark, sf).select("document_id", "canonical_key", "entity_type").distinct()


def entity_search(spark: SparkSession, sf: str, asked: DataFrame | None = None) -> DataFrame:
    return E.entity_search(_entities(spark, sf), _docs(spark, sf), _alias_keys(spark, sf, asked)).withColumn("entity_score", F.round("entity_score", 6))


def query_entity_keys(spark: SparkSession, sf: str, asked: DataFrame | None = None) -> DataFrame:
    return E.query_entity_keys(_asked(spark, asked), _aliases(spark, sf))


def adaptive_plan(spark: SparkSession, sf: str) -> DataFrame:
    return P.adaptive_plans(_batch_queries(spark, sf)).drop("reasons", "query")


def _batch_queries(spark: SparkSession, sf: str) -> DataFrame:
    cues = table(spark, sf, "subtitle_cues").filter("length(text) > 0")
    return cues.select(F.concat(F.lit("c"), F.col("cue_id").cast("string")).alias("query_id"), F.col("text").alias("query"))


def vector_normalize(spark: SparkSession, sf: str) -> DataFrame:
    v = W.latest_vectors(table(spark, sf, "embeddings_cache"))
    return v.select("document_id", "model", "dimension", F.posexplode(S.unit(F.col("vector"))).alias("i", "x")).withColumn("x", F.round("x", 5) + 0.0)


def semantic_knn(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    asks = e.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), S.unit(F.col("embedding")).alias("vector"))
    out = W.exact_knn(e.select("vec_id", S.unit(F.col("embedding")).alias("u")), asks, id="vec_id", vector="u", k=10)
    return out.select("query_id", "vec_id", F.round("similarity", 6).alias("similarity"), "place")


def cache_knn(spark: SparkSession, sf: str) -> DataFrame:
    """Queries are the stated set: every row with an id divisible by 20, against all rows of its model."""
    v = table(spark, sf, "embeddings_cache").filter("vector is not null and size(vector) = dimension and exists(vector, x -> x <> 0)").select("cache_id", S.unit(F.col("vector")).alias("u"))
    out = W.exact_knn(v, v.filter("cache_id % 20 = 0").select(F.col("cache_id").alias("query_id"), F.col("u").alias("vector")), id="cache_id", vector="u", k=5)
    return out.select("query_id", "cache_id", F.round("similarity", 6).alias("similarity"), "place")


def label_centroids(spark: SparkSession, sf: str) -> DataFrame:
    c = W.label_centroids(table(spark, sf, "embeddings"))
    return c.select("label", "members", F.posexplode("centroid").alias("i", "x")).withColumn("x", F.round("x", 6) + 0.0)


def histogram_distance(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: F.abs(x)).alias("histogram"))
    return W.min_distance_to(e, e.filter("vec_id % 20 = 0"), ["label"]).withColumn("distance", F.round("distance", 5))


def embedding_misses(spark: SparkSession, sf: str) -> DataFrame:
    return W.cache_misses(_docs(spark, sf), table(spark, sf, "embeddings_cache"), "hashing", "token-bigram-v1", 64)


def hashing_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).filter("length(combined_text) > 0")
    return d.select("document_id", X.hashing_embedding(64)(X.prepared_document(F.col("document_id"), F.col("combined_text"), "hashing")).alias("vector"))


def _hit_lists(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    hits = table(spark, sf, "search_hits").filter("query_id is not null and document_id is not null")
    return {n: hits.filter(f"{n}_rank is not null").select("query_id", "document_id", F.col(f"{n}_rank").alias("rank"), F.col(f"{n}_score").alias("score"), F.col("entity_overlap").alias("overlap")) for n in U.WEIGHTS}


def hybrid_rrf(spark: SparkSession, sf: str) -> DataFrame:
    out = U.hybrid_rank(U.merge_hits(_hit_lists(spark, sf)), limit=10)
    return out.select("query_id", "document_id", "final_score", "final_rank")


def merged_hits(spark: SparkSession, sf: str) -> DataFrame:
    ranks = [F.col(f"{n}_rank").cast("double").alias(f"{n}_rank") for n in U.WEIGHTS]
    return U.merge_hits(_hit_lists(spark, sf)).select("query_id", "document_id", *ranks, "entity_overlap")


def rerank_blend(spark: SparkSession, sf: str) -> DataFrame:
    best = table(spark, sf, "search_hits").filter("query_id is not null and document_id is not null").groupBy("query_id", "document_id").agg(F.max("reranker_score").alias("reranker_score"))
    hits = U.hybrid_rank(U.merge_hits(_hit_lists(spark, sf))).join(best, ["query_id", "document_id"])
    hits = hits.withColumn("coverage", F.least(F.col("entity_overlap"), F.lit(5)) / 5)
    return U.rerank_blend(hits, top=20).withColumn("final_score", F.round("final_score", 6)).drop("reranker_score")


def temporal_dedup(spark: SparkSession, sf: str) -> DataFrame:
    hits = U.hybrid_rank(U.merge_hits(_hit_lists(spark, sf))).select("query_id", "document_id", "final_score", "final_rank")
    docs = _docs(spark, sf).select("document_id", "video_id", F.coalesce("start_seconds", F.lit(0.0)).alias("start_seconds"), X.index_terms(F.col("combined_text")).alias("terms"))
    return U.temporal_dedup(hits.join(docs, "document_id"))


def cue_scene_overlap(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "subtitle_cues").select("video_id", "cue_id", F.col("start_seconds").alias("cs"), F.greatest("start_seconds", "end_seconds").alias("ce"))
    s = table(spark, sf, "scenes").select("video_id", "scene_id", F.col("start_seconds").alias("ss"), F.col("end_seconds").alias("se"))
    return N.overlap_join(c, s, by=["video_id"], left_span=("cs", "ce"), right_span=("ss", "se")).select("video_id", "scene_id", "cue_id")


def cue_at_frame(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "scenes").select("video_id", "scene_id", "start_seconds")
    o = table(spark, sf, "ocr_records").join(s, ["video_id", "scene_id"]).select("video_id", "ocr_id", (F.col("start_seconds") + F.col("scene_local_time_seconds")).alias("at"))
    c = table(spark, sf, "subtitle_cues").select("video_id", "cue_id", F.col("start_seconds").alias("cs"), F.col("end_seconds").alias("ce"))
    return N.point_join(o, c, by=["video_id"], at="at", span=("cs", "ce")).select("ocr_id", "cue_id")


def ocr_lines(spark: SparkSession, sf: str) -> DataFrame:
    return D.clean_ocr_lines(table(spark, sf, "ocr_records")).select("ocr_id", "line_no", "key", "confidence")


def repeated_ocr_keys(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "ocr_records")
    return D.repeated_keys(D.clean_ocr_lines(o), o)


def keyframe_table(spark: SparkSession, sf: str) -> DataFrame:
    o, s = table(spark, sf, "ocr_records"), table(spark, sf, "scenes")
    lines = D.clean_ocr_lines(o)
    k = D.keyframes(o, s, lines, D.repeated_keys(lines, o))
    keys = lambda c: F.array_join(F.transform(c, X.normalized_key), "|")
    return k.select("ocr_id", "keyframe_no", keys(F.transform("ocr_lines", lambda x: x["text"])).alias("kept"), keys(F.col("removed_repeated_ocr")).alias("removed"), "ocr_confidence_mean")


def preferred_subtitles(spark: SparkSession, sf: str) -> DataFrame:
    met = D.scene_cues(table(spark, sf, "scenes"), table(spark, sf, "subtitle_cues"))
    return D.preferred_text(met, ["video_id", "scene_id"])


def _scene_documents(spark: SparkSession, sf: str) -> DataFrame:
    return D.scene_documents(table(spark, sf, "scenes"), table(spark, sf, "subtitle_cues"), table(spark, sf, "ocr_records"))


def scene_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _scene_documents(spark, sf).withColumn("subtitle_tracks", F.to_json("subtitle_tracks"))


def keyframe_documents(spark: SparkSession, sf: str) -> DataFrame:
    return D.keyframe_documents(_scene_documents(spark, sf)).select("document_id", "parent_document_id", "start_seconds", "combined_text", "youtube_url", "level")


def best_keyframes(spark: SparkSession, sf: str) -> DataFrame:
    return _scene_documents(spark, sf).select("document_id", D.best_keyframe().alias("k")).select("document_id", "k.path", "k.ocr_text")


def manifest_summary(spark: SparkSession, sf: str) -> DataFrame:
    return D.manifest(_docs(spark, sf), min_confidence=0.5)


def search_keys(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "subtitle_cues").filter("text is not null")
    return c.select("cue_id", X.search_key(F.col("text")).alias("search_key"), X.normalized_key(X.nfc(F.col("text"))).alias("normalized_key"))


def clean_texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "subtitle_cues").select("cue_id", X.normalize_text(F.col("text")).alias("clean"))


def mojibake_repair(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "subtitle_cues").select("cue_id", "text", X.repair_mojibake(F.col("text")).alias("repaired"))
    return t.filter("text <> repaired")


def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").filter("length(text) > 0")
    s = d.select("doc_id", F.posexplode(X.sentences(F.col("text"))).alias("n", "sentence"))
    return s.filter("sentence <> ''").select("doc_id", "sentence", F.size(X.raw_tokens(F.col("sentence"))).alias("n_tokens"))


def chunk_packing(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").filter("length(text) > 0")
    chunks = X.chunks_by_length(F.filter(X.sentences(F.col("text")), lambda s: s != ""), 600)
    return d.select("doc_id", F.posexplode(chunks).alias("chunk_no", "chunk")).select("doc_id", "chunk_no", "chunk")


def hit_links(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("document_id", X.watch_url(F.col("video_id"), F.coalesce("start_seconds", F.lit(0.0))).alias("url"), X.snippet(F.col("combined_text")).alias("snippet"))


def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return V.stratified(V.eligible(_docs(spark, sf)), 60).select("n", "video_id", "document_id")


def token_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return V.token_frequencies(V.eligible(_docs(spark, sf)))


def seed_queries(spark: SparkSession, sf: str) -> DataFrame:
    return V.seed_queries(_docs(spark, sf))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    h = table(spark, sf, "search_hits").filter("reranker_score > 0")
    return h.groupBy("query_id").agg(F.collect_set("document_id").alias("relevant_document_ids"))


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    h = table(spark, sf, "search_hits")
    modes = F.explode(F.array(*[F.struct(F.lit(m).alias("mode"), F.col(f"{m}_rank").alias("rank")) for m in U.WEIGHTS]))
    return h.select("query_id", "document_id", modes.alias("m")).select("query_id", "document_id", "m.mode", "m.rank").filter("rank is not null").groupBy("mode", "query_id", "document_id").agg(F.min("rank").alias("rank"))


def eval_details(spark: SparkSession, sf: str) -> DataFrame:
    m = V.query_metrics(_runs(spark, sf), _labelled(spark, sf))
    return m.select("mode", "query_id", F.col("first_relevant_rank").cast("double").alias("first_relevant_rank"), *[F.round(c, 9).alias(c) for c in ("recall_at_5", "recall_at_10", "reciprocal_rank")])


def eval_report(spark: SparkSession, sf: str) -> DataFrame:
    return V.report(V.query_metrics(_runs(spark, sf), _labelled(spark, sf)))


def latency_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.groupBy("event_type").agg(*[F.round(V.interpolated_percentile("value", r), 6).alias(n) for n, r in (("p50", 0.5), ("p95", 0.95))], F.round(F.avg("value"), 6).alias("mean"))


def validate_labels(spark: SparkSession, sf: str) -> DataFrame:
    q = _labelled(spark, sf).withColumn("query", F.when(F.col("query_id").endswith("7"), F.lit(" ")).otherwise(F.col("query_id")))
    return V.violations(q, table(spark, sf, "documents").filter("length(combined_text) >= 200"))


def scene_segmentation(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    return K.segment(e, "user_id", "at", "value", 40.0).select("user_id", "scene_no", F.col("start_at.event_id").alias("first_event"), "n")


def sample_frames(spark: SparkSession, sf: str) -> DataFrame:
    s = K.sample_frames(table(spark, sf, "scenes").filter("duration_seconds is not null"))
    return s.select("video_id", "scene_id", "target", F.array_join(F.col("frames").cast("array<string>"), ",").alias("frames"))


def _frames(spark: SparkSession, sf: str) -> DataFrame:
    i = table(spark, sf, "lineitem")
    return i.select("l_orderkey", F.col("l_linenumber").alias("frame_index"), (F.col("l_quantity") * 2).alias("sharpness"), (F.col("l_quantity") * 5).alias("brightness"), F.col("l_discount").alias("motion"))


def frame_gate(spark: SparkSession, sf: str) -> DataFrame:
    return K.gate(_frames(spark, sf), ["l_orderkey"]).select("l_orderkey", "frame_index")


def selection_score(spark: SparkSession, sf: str) -> DataFrame:
    return K.with_selection_scores(_frames(spark, sf), ["l_orderkey"]).select("l_orderkey", "frame_index", F.round("selection_score", 6).alias("selection_score"))


def temporal_windows(spark: SparkSession, sf: str) -> DataFrame:
    return _frames(spark, sf).select("l_orderkey", "frame_index", K.temporal_window(F.col("frame_index"), ["l_orderkey"], 3).alias("window_no"))


def keyframe_selection(spark: SparkSession, sf: str) -> DataFrame:
    h = F.transform("embedding", lambda x: F.abs(x))
    e = table(spark, sf, "embeddings").select(
        F.col("label").cast("string").alias("video_id"), F.format_string("scene-%03d", F.floor(F.col("vec_id") / 12)).alias("scene_id"), F.floor(F.col("vec_id") / 12).alias("scene_order"), F.lit(3).alias("target"),
        F.col("vec_id").alias("frame_index"), F.get("embedding", F.lit(0)).cast("double").alias("selection_score"), F.abs(F.get("embedding", F.lit(1))).cast("double").alias("edge_density"), h.alias("histogram"), F.slice(h, 1, 8).alias("flow"),
    )
    return K.select_diverse(e)


def scene_keyframes(spark: SparkSession, sf: str) -> DataFrame:
    h = F.transform("embedding", lambda x: F.abs(x))
    e = table(spark, sf, "embeddings").select(
        F.col("label").cast("string").alias("video_id"), F.format_string("scene-%03d", F.floor(F.col("vec_id") / 12)).alias("scene_id"), F.lit(3).alias("target"), F.col("vec_id").alias("frame_index"),
        F.get("embedding", F.lit(0)).cast("double").alias("selection_score"), F.abs(F.get("embedding", F.lit(1))).cast("double").alias("edge_density"), h.alias("histogram"), F.slice(h, 1, 8).alias("flow"),
    )
    return K.select_in_scene(e)


def _states(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("status", F.when(F.col("value") >= 50, "done").otherwise("failed"))
    return J.latest_state(e, "user_id", "event_type", "status", "ts", "event_id")


def job_latest_state(spark: SparkSession, sf: str) -> DataFrame:
    return _states(spark, sf).select("user_id", "event_type", "status")


def job_status_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return J.status_histogram(_states(spark, sf), "event_type")


def job_runnable(spark: SparkSession, sf: str) -> DataFrame:
    return J.runnable(_states(spark, sf), "user_id", "event_type", "purchase", ["click", "view"])


def stage_timings(spark: SparkSession, sf: str) -> DataFrame:
    t = J.stage_timings(table(spark, sf, "events"), "user_id", "event_type", "value")
    return t.select("user_id", F.explode("timings").alias("event_type", "seconds"))


def index_remove_videos(spark: SparkSession, sf: str) -> DataFrame:
    index = I.build(table(spark, sf, "documents"), table(spark, sf, "entity_aliases"))
    hot = table(spark, sf, "documents").groupBy("video_id").count().orderBy(F.desc("count"), "video_id").limit(1).select("video_id")
    return I.remove_videos(index, hot).idf.withColumn("inverse_document_frequency", F.round("inverse_document_frequency", 9))


def index_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """An index of half the videos, brought up to date with the others: its statistics equal those of a whole build."""
    docs = table(spark, sf, "documents")
    late = F.pmod(F.xxhash64("video_id"), F.lit(2)) == 1
    index = I.update(I.build(docs.filter(~late), table(spark, sf, "entity_aliases")), docs.filter(late))
    return index.idf.withColumn("inverse_document_frequency", F.round("inverse_document_frequency", 9))


def _stored(spark: SparkSession, sf: str, level: str = "scene") -> I.Index:
    """The index written to the shared folder and read back: searches over it see its tables, not the documents' texts."""
    root = f"{shared_dir(spark)}/reelspark/index-{uuid.uuid4().hex}"
    if level == "scene":
        index = I.build(table(spark, sf, "documents"), table(spark, sf, "entity_aliases"), once=True)
    else:
        index = I.keyframe_index(_scene_documents(spark, sf), table(spark, sf, "entity_aliases"), once=True)
    sinks.write_index(index, root, level)
    return readers.index_tables(spark, root, level)


def bm25_index_search(spark: SparkSession, sf: str) -> DataFrame:
    index = _stored(spark, sf)
    out = L.bm25_scores(index.documents, searches(spark), stored=index.postings, totals=index.totals)
    return out.withColumn("bm25_score", F.round("bm25_score", 6))


def tfidf_index_search(spark: SparkSession, sf: str) -> DataFrame:
    index = _stored(spark, sf)
    out = L.tfidf_search(index.terms, index.idf, index.norms, searches(spark))
    return out.select("query_id", "document_id", F.round("tfidf_score", 6).alias("tfidf_score"), "tfidf_rank")


def keyframe_level_search(spark: SparkSession, sf: str) -> DataFrame:
    return R.search({"keyframe": _stored(spark, sf, "keyframe")}, searches(spark), P.SearchSettings(level="keyframe"))


def index_entities(spark: SparkSession, sf: str) -> DataFrame:
    return _stored(spark, sf).entities.select("document_id", "canonical_key", "entity_type").distinct()


def hybrid_search(spark: SparkSession, sf: str, asked: DataFrame | None = None) -> DataFrame:
    return flagship(spark, sf, asked)


def tfidf_mode_search(spark: SparkSession, sf: str, asked: DataFrame | None = None) -> DataFrame:
    return R.search(_stored(spark, sf), _asked(spark, asked), P.SearchSettings(mode="tfidf"))


def flagship(spark: SparkSession, sf: str, asked: DataFrame | None = None) -> DataFrame:
    """Hybrid search: BM25, vector and entity lists fused, reranked by the stand-in, thinned out in time; over a stored index."""
    cache = table(spark, sf, "embeddings_cache").filter("provider = 'hashing'")
    return R.search(_stored(spark, sf), _asked(spark, asked), P.SearchSettings(), cache, R.embed_queries(_asked(spark, asked), 64), U.overlap_reranker)


_NAMES = """latest_documents term_frequency idf_stats document_norms tfidf_search bm25_scores bm25_search fts_match entity_email entity_acronym entity_rules document_entities
alias_dimension alias_containment canonical_entities entity_search query_entity_keys adaptive_plan vector_normalize semantic_knn cache_knn label_centroids histogram_distance embedding_misses
hashing_embeddings merged_hits hybrid_rrf rerank_blend temporal_dedup cue_scene_overlap cue_at_frame ocr_lines repeated_ocr_keys keyframe_table preferred_subtitles scene_documents
keyframe_documents best_keyframes manifest_summary search_keys clean_texts mojibake_repair sentence_split chunk_packing hit_links stratified_sample token_frequencies seed_queries eval_details
eval_report latency_percentiles validate_labels scene_segmentation sample_frames frame_gate selection_score temporal_windows keyframe_selection job_latest_state job_status_histogram job_runnable
stage_timings index_remove_videos index_incremental hybrid_search tfidf_mode_search bm25_index_search tfidf_index_search keyframe_level_search index_entities scene_keyframes""".split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: globals()[name] for name in _NAMES}

#: The searches of ten strings (the SQL has these strings) again over the stated query set: tfidf_search_stated and so on.
_STATED = "tfidf_search bm25_scores bm25_search fts_match entity_search query_entity_keys hybrid_search tfidf_mode_search".split()


def _stated(search: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: search(spark, sf, stated_searches(spark, sf))


QUERIES |= {f"{name}_stated": _stated(globals()[name]) for name in _STATED}
