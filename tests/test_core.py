"""Operators of the core on hand-made rows and against brute force."""

import json
import math
import os
import random
import sqlite3

import pytest
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
from reelspark.plans import queries as Q
from reelspark.sources import readers, sinks
from reelspark.streaming import ingest


def rows(df):
    return [tuple(r) for r in df.collect()]


def one(spark, col, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(col(F.col("x"))).first()[0]


# --- text ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("text", "key"), [
    ("Đường ĐI, Straße x²_y", "duong di strasse x2 y"), ("ＴＰ．Hồ Chí Minh", "tp ho chi minh"), ("đường", "duong"), ("Ёлка Й", "елка и"), ("", ""),
])
def test_search_key(spark, text, key):
    assert one(spark, X.search_key, text) == key


def test_terms_and_queries(spark):
    assert one(spark, X.index_terms, "Của một con CON a đo") == ["con", "con"]
    assert one(spark, X.query_terms, "của và là") == ["cua", "va", "la"] and one(spark, X.query_terms, "con của con") == ["con"]
    assert one(spark, X.tokens, None) == []


def test_clean_text(spark):
    assert one(spark, X.clean_text, "﻿<b>Tom</b> &amp;\n  Jerry ") == "Tom & Jerry"
    assert one(spark, X.repair_mojibake, "nhÃ\xa0 vÆ°á»\x9dn") == "nhà vườn" and one(spark, X.repair_mojibake, "SÃO PAULO") == "SÃO PAULO"
    assert one(spark, X.normalized_key, "Lò nung, GỐM １２!") == "lònunggốm12" and one(spark, X.clean_text, None) is None


def test_sentences_chunks_and_times(spark):
    assert one(spark, X.sentences, "One  two. Three!\nFour") == ["One two.", "Three!", "Four"]
    long = "a b c d e f g. one two three four five six seven eight. x"
    assert one(spark, X.choose_sentence, long) == "one two three four five six seven eight." and one(spark, X.choose_sentence, "just  two") == "just two"
    assert one(spark, lambda c: X.chunks_by_length(c, 5), ["ab", "cd", "efghijk", "l"], "array<string>") == ["ab cd", "efghijk", "l"] and one(spark, lambda c: X.chunks_by_length(c, 5), [], "array<string>") == []
    assert one(spark, X.timestamp_seconds, "01:02:03,500") == 3723.5 and one(spark, X.timestamp_seconds, "bad") is None
    assert one(spark, X.subtitle_language, "/a/b/x.vi-orig.srt") == "vi-orig" and one(spark, X.subtitle_language, "/a/b.c/x.srt") == "unknown"
    assert one(spark, lambda c: X.first_by_key(c, X.normalized_key), ["A b", "ab!", "?", "c"], "array<string>") == ["A b", "c"]


def test_hashing_embedding(spark):
    v = one(spark, X.hashing_embedding(32), "Hello hello world")
    assert len(v) == 32 and abs(math.sqrt(sum(x * x for x in v)) - 1) < 1e-6 and one(spark, X.hashing_embedding(8), "") == [0.0] * 8
    assert v == one(spark, X.hashing_embedding(32), "hello HELLO  world")


# --- scores -------------------------------------------------------------------------------------------------------------


def test_scores(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, z array<double>")
    r = df.select(S.unit(F.col("a")), S.unit(F.col("z")), S.bhattacharyya(F.col("a"), F.col("a")), S.normalized_histogram(F.col("a")), S.clipped_sigmoid(F.lit(1e9)), S.min_max(F.lit(1), F.lit(2), F.lit(2)), S.bm25_idf(F.lit(9), F.lit(10)), S.clamp_ratio(F.lit(3.0), F.lit(0.0)), S.reciprocal_rank(F.lit(None).cast("int"), 1.0, 60)).first()
    assert r[0] == [0.6, 0.8] and r[1] == [0.0, 0.0] and r[2] < 1e-7 and r[3] == pytest.approx([3 / 7, 4 / 7]) and r[4] == pytest.approx(1.0) and r[5] == 1.0 and r[6] == 1e-6 and r[7] == 0.0 and r[8] == 0.0


# --- lexical: a third, independent check by SQLite's full-text search ---------------------------------------------------------


def test_bm25_equals_full_text_search_of_sqlite(spark):
    rnd = random.Random(3)
    words = "lamp river stone cloud bridge night market boat paper glass".split()
    data = []
    for k in range(60):
        a, b = (" ".join(rnd.choices(words, k=rnd.randrange(0, 9))) for _ in range(2))
        data.append((f"d{k:02d}", a, b, f"{a} {b}".strip(), rnd.choice(["", "lamp", "stone cloud"])))
    cols = ["subtitle_text", "ocr_text", "combined_text", "entities_text"]
    db = sqlite3.connect(":memory:")
    try:
        db.execute(f"create virtual table t using fts5(id unindexed, {', '.join(cols)})")
    except sqlite3.OperationalError:
        pytest.skip("no full-text search in this SQLite")
    db.executemany("insert into t values (?,?,?,?,?)", data)
    docs = spark.createDataFrame(data, "document_id string, " + ", ".join(f"{c} string" for c in cols))
    queries = spark.createDataFrame([("q1", "lamp river"), ("q2", "boat")], "query_id string, query string")
    got = {(q, d): s for q, d, s in rows(L.bm25_scores(docs, queries))}
    for q, text in (("q1", "lamp OR river"), ("q2", "boat")):
        for d, s in db.execute("select id, bm25(t, 0, 1.5, 0.7, 1.0, 2.5) from t where t match ?", (text,)):
            assert got.pop((q, d)) == pytest.approx(s, abs=1e-6)
    assert not got


def test_tfidf_and_norms(spark):
    docs = spark.createDataFrame([("a", "lamp lamp river"), ("b", "river"), ("c", "của và"), ("d", None)], "document_id string, combined_text string")
    tf = L.term_frequencies(docs)
    idf = L.idf_stats(tf)
    assert {t: (n, round(i, 6)) for t, n, i in rows(idf)} == {"lamp": (1, round(math.log(3 / 2) + 1, 6)), "river": (2, 1.0)}
    q = spark.createDataFrame([("q", "river"), ("none", "và của"), ("miss", "zebra")], "query_id string, query string")
    assert [(a, b, r) for a, b, _, r in rows(L.tfidf_search(tf, idf, L.document_norms(tf, idf), q).orderBy("tfidf_rank"))] == [("q", "b", 1), ("q", "a", 2)]


def test_latest_documents(spark):
    d = spark.createDataFrame([(1, "a", "2025"), (2, "a", "2025"), (3, "a", None), (4, None, "2026"), (5, "b", None)], "doc_id bigint, document_id string, generated_at string")
    assert sorted(r[0] for r in rows(L.latest_documents(d))) == [2, 5]


# --- intervals ------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bucket", [0.5, 7.0, 1e6])
def test_interval_joins_against_brute_force(spark, bucket):
    rnd = random.Random(5)
    span = lambda: (lambda s: (s, s + rnd.choice([0.0, 1.0, 2.5, 40.0])))(float(rnd.randrange(0, 100)) / 2)
    a = [(rnd.choice("xy"), k, *span()) for k in range(80)] + [("x", 900, None, 1.0), (None, 901, 0.0, 1.0), ("x", 902, 5.0, 1.0)]
    b = [(rnd.choice("xy"), k, *span()) for k in range(80)]
    da, db = spark.createDataFrame(a, "v string, i int, s double, e double"), spark.createDataFrame(b, "v string, j int, p double, q double")
    met = sorted((r["i"], r["j"]) for r in N.overlap_join(da, db, by=["v"], left_span=("s", "e"), right_span=("p", "q"), bucket=bucket).collect())
    ok = [r for r in a if None not in r and r[3] >= r[2]]
    assert met == sorted((i, j) for v, i, s, e in ok for w, j, p, q in b if v == w and e > p and s < q)
    inside = sorted((r["i"], r["j"]) for r in N.point_join(da, db, by=["v"], at="s", span=("p", "q"), bucket=bucket).collect())
    assert inside == sorted((i, j) for v, i, s, _ in a if v is not None and s is not None for w, j, p, q in b if v == w and p <= s <= q)


# --- documents ------------------------------------------------------------------------------------------------------------------


def scene_fixture(spark):
    scenes = spark.createDataFrame([("v", "s1", 10.0, "x", 0, 100, 0.0, 10.0, 10.0), ("v", "s2", 10.0, "x", 100, 200, 10.0, 20.0, 10.0), ("v", "s3", 0.0, "x", 200, 201, None, None, 0.1)], "video_id string, scene_id string, fps double, detector string, start_frame bigint, end_frame bigint, start_seconds double, end_seconds double, duration_seconds double")
    cue = "cue_id bigint, video_id string, start_seconds double, end_seconds double, text string, language string, path string, ingested_at timestamp"
    cues = spark.createDataFrame([
        (1, "v", 0.0, 5.0, "Xin  chào", "vi", "p", None), (2, "v", 0.0, 5.0, "xin chào!", "vi", "p", None), (3, "v", 9.0, 10.0, "tạm biệt", "vi", "p", None), (4, "v", 1.0, 2.0, "hello", "en", "p", None),
        (5, "v", 15.0, 12.0, "late", "en", "p", None), (6, "v", 16.0, 17.0, None, "vi", "p", None), (7, "v", None, 17.0, "x", "vi", "p", None), (8, "v", 16.0, 17.0, "<i> </i>", "vi", "p", None),
    ], cue)
    ocr = "ocr_id bigint, video_id string, scene_id string, frame_index bigint, scene_local_time_seconds double, keyframe_path string, text string, lines array<struct<text:string,confidence:double,bbox:array<array<double>>>>"
    line = lambda t, c=0.9: (t, c, None)
    recs = spark.createDataFrame([
        (1, "v", "s1", 10, 1.0, "k/frame-10.jpg", "", [line("K1 TV"), line("lò nung"), line("LÒ NUNG"), line("faint", 0.2), line("", 0.9)]), (2, "v", "s1", 20, 2.0, "k/frame-20.jpg", "", [line("K1 TV"), line("lò nung")]),
        (3, "v", "s2", 110, 1.0, "k/frame-110.jpg", "", [line("k1 tv"), line("cầu")]), (4, "v", "s2", None, None, "k/frame-x.jpg", "", None),
    ], ocr)
    return scenes, cues, recs


def test_scene_documents(spark):
    docs = {r["scene_id"]: r for r in D.scene_documents(*scene_fixture(spark)).collect()}
    a, b, c = docs["s1"], docs["s2"], docs["s3"]
    assert a["subtitle_language"] == "vi" and a["subtitle_text"] == "Xin chào tạm biệt" and a["ocr_text"] == "lò nung" and a["combined_text"] == "Xin chào tạm biệt\nlò nung"
    assert a["repeated_ocr_keys_removed"] == ["k1tv"] and [k["removed_repeated_ocr"] for k in a["keyframes"]] == [["K1 TV"]] * 2 and a["keyframes"][0]["timestamp_seconds"] == 1.0
    assert set(a["subtitle_tracks"]) == {"vi", "en"} and a["keyframes"][0]["subtitle_text"] == "Xin chào"
    assert b["subtitle_text"] == "late" and b["ocr_text"] == "cầu" and len(b["keyframes"]) == 2 and c["combined_text"] == "" and c["keyframes"] is None
    flat = {r["document_id"]: r for r in D.keyframe_documents(D.scene_documents(*scene_fixture(spark))).collect()}
    assert "v:s1:keyframe-000" in flat and flat["v:s1:keyframe-000"]["combined_text"].startswith("Xin chào") and all(r["level"] == "keyframe" for r in flat.values())
    m = D.manifest(D.scene_documents(*scene_fixture(spark)), note="n").first()
    assert (m["videos"], m["documents"], m["with_ocr"], m["searchable"], m["note"]) == (1, 3, 2, 2, "n")


def test_watermarks_need_enough_frames(spark):
    lines = spark.createDataFrame([(k, "v", "w") for k in range(2)] + [(k, "u", "w") for k in range(3)], "ocr_id int, video_id string, key string")
    recs = spark.createDataFrame([("v",)] * 2 + [("u",)] * 6, "video_id string")
    assert rows(D.repeated_keys(lines, recs)) == [("u", "w", 3)]


def test_best_keyframe_and_scene_records(spark):
    k = "array<struct<path:string,ocr_text:string>>"
    df = spark.createDataFrame([([("a", ""), ("b", "x")],), ([("a", "")],), ([],), (None,)], f"keyframes {k}")
    assert [r[0] and r[0]["path"] for r in rows(df.select(D.best_keyframe()))] == ["b", "a", None, None]
    b = spark.createDataFrame([("v", 50, 50, 5.0, 5.0, 10.0), ("v", 0, 40, 0.0, 4.0, 10.0)], "video_id string, start_frame bigint, end_frame bigint, start_seconds double, end_seconds double, fps double")
    assert sorted(rows(D.scene_records(b))) == [("v", "scene-001", 0, 40, 0.0, 4.0, 4.0), ("v", "scene-002", 50, 51, 5.0, 5.0, 0.1)]


# --- entities -----------------------------------------------------------------------------------------------------------------------


def test_rule_entities(spark):
    of = lambda text: [(r["entity_text"], r["entity_type"]) for r in E.rule_entities(spark.createDataFrame([("d", text)], "document_id string, combined_text string")).orderBy("ordinal").collect()]
    got = of("Ông Nguyễn Văn An gặp OpenAI và ca sĩ Mỹ Tâm ở VTV, mail a@b.io, https://x.y/z. Hà Nội")
    assert ("a@b.io", "EMAIL") in got and ("https://x.y/z", "URL") in got and ("VTV", "ORG") in got and ("Mỹ Tâm", "PERSON") in got and ("OpenAI", "ORG") in got and ("Hà Nội", "MISC") in got
    assert of("Các Bạn") == [] and of("") == [] and of(None) == []


def test_aliases_and_canonical_names(spark):
    records = spark.createDataFrame([("Thành phố Hồ Chí Minh", "LOCATION", ["TP HCM", "Sài Gòn", " "]), ("Hồ Chí Minh", "person", None), (" ", "ORG", ["x"]), ("OpenAI", None, ["Open AI", None])], "canonical string, type string, aliases array<string>")
    dim = E.alias_dimension(records)
    assert {r["alias_key"] for r in dim.collect()} == {"thanh pho ho chi minh", "tp hcm", "sai gon", "ho chi minh", "openai", "open ai"}
    docs = spark.createDataFrame([("d", "ở thành phố Hồ Chí Minh, open ai mở cửa"), ("e", None)], "document_id string, combined_text string")
    hits = {(r["alias_key"], r["entity_type"]) for r in E.alias_hits(docs, dim, longest=2).collect()}
    assert hits == {("thanh pho ho chi minh", "LOCATION"), ("ho chi minh", "PERSON"), ("open ai", "MISC")}
    suppress = spark.createDataFrame([("thanh pho ho chi minh", "LOCATION", "ho chi minh")], "winner_key string, winner_type string, loser_key string")
    kept = {(r["canonical_key"], r["entity_type"]) for r in E.document_entities(docs, dim, suppress=suppress).collect()}
    assert ("ho chi minh", "PERSON") not in kept and ("thanh pho ho chi minh", "LOCATION") in kept and ("openai", "MISC") in kept


# --- fusion ---------------------------------------------------------------------------------------------------------------------------


def lists(spark):
    make = lambda data: spark.createDataFrame(data, "query_id string, document_id string, rank int, score double, overlap int")
    return {"bm25": make([("q", "a", 1, -2.0, 0), ("q", "b", 2, -1.0, 0)]), "semantic": make([("q", "b", 1, 0.9, 0)]), "entity": make([("q", "c", 1, 2.1, 2)])}


def test_weighted_rank_fusion(spark):
    got = {r["document_id"]: (r["final_rank"], r["final_score"]) for r in U.hybrid_rank(U.merge_hits(lists(spark))).collect()}
    assert got["b"] == (1, round(1 / 62 + 1 / 61, 9)) and got["a"] == (2, round(1 / 61, 9)) and got["c"][1] == round(0.35 / 61 + 0.005 * 0.35 * 2, 9)


def test_rerank_blend_cuts(spark):
    h = spark.createDataFrame([("q", "a", 0.9, 5.0, 1.0, 1), ("q", "b", 0.5, 4.0, 0.0, 0), ("q", "c", 0.8, -5.0, 0.0, 0), ("q", "d", 0.7, None, 1.0, 1), ("r", "x", 0.1, 0.0, 0.0, 0)], "query_id string, document_id string, final_score double, reranker_score double, coverage double, entity_overlap int")
    got = {(r["query_id"], r["document_id"]): r["rerank_rank"] for r in U.rerank_blend(h).collect()}
    assert got == {("q", "a"): 1, ("q", "b"): 2, ("r", "x"): 1}  # c fell too far, d has no score; a single hit's span counts 1


def test_temporal_dedup(spark):
    t = lambda s: s.split()
    data = [("q", "a", "v", 0.0, 1, t("x y")), ("q", "b", "v", 30.0, 2, t("z")), ("q", "c", "v", 80.0, 3, t("x y")), ("q", "d", "v", 80.0, 4, t("other words")), ("q", "e", "w", 1.0, 5, t("x y")), ("q", "f", "v", 200.0, 6, None)]
    df = spark.createDataFrame(data, "query_id string, document_id string, video_id string, start_seconds double, final_rank int, terms array<string>")
    assert sorted(r["document_id"] for r in U.temporal_dedup(df).collect()) == ["a", "d", "e", "f"] and U.temporal_dedup(df, 0).count() == 6


def test_best_passages(spark):
    hits = spark.createDataFrame([("q", "d", "cây cầu", "all", 3.0), ("q", "e", "", "whole text", 4.0)], "query_id string, document_id string, subtitle_text string, combined_text string, start_seconds double")
    line = "array<struct<text:string,confidence:double>>"
    k = spark.createDataFrame([("d", 0, "cây", "mờ", [("mờ", 0.1)], 0.1, 1.0, 10), ("d", 1, "lò nung", "lò  nung\nxa", [("lò  nung", 0.2), ("xa", 0.9), ("kém", 0.3)], 0.5, 0.0, None)], f"document_id string, keyframe_no int, subtitle_text string, ocr_text string, ocr_lines {line}, ocr_confidence_mean double, timestamp_seconds double, source_frame_index bigint")
    q = spark.createDataFrame([("q", "lò nung gốm")], "query_id string, query string")
    got = {r["document_id"]: tuple(r)[2:] for r in U.best_passages(hits, k, q).collect()}
    assert got["d"] == ("SUBTITLE: cây cầu\nLOCAL SUBTITLE: lò nung\nOCR: lò nung | xa", 3.0, None) and got["e"] == ("whole text", 4.0, None)


# --- vectors ----------------------------------------------------------------------------------------------------------------------------


def test_exact_neighbours(spark):
    rnd = random.Random(4)
    v = [(k, [rnd.gauss(0, 1) for _ in range(6)]) for k in range(90)] + [(200, [1.0, 2.0])]
    df = spark.createDataFrame(v, "id bigint, u array<double>")
    asks = df.filter("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("u").alias("vector"))
    got = {}
    for q, i, _, p in rows(W.exact_knn(df, asks, id="id", vector="u", k=4, parts=3, block=2)):
        got.setdefault(q, []).append((p, i))
    for q, u in v[:90:20]:
        best = sorted((-round(sum(a * b for a, b in zip(u, w)), 9), i) for i, w in v[:90] if i != q)[:4]
        assert [i for _, i in sorted(got[q])] == [i for _, i in best]
    assert W.exact_knn(df, asks.limit(0), id="id", vector="u").count() == 0


def test_embedding_cache(spark):
    kind = "cache_id bigint, document_id string, provider string, model string, dimension int, text_hash string, vector array<float>, updated_at string"
    cache = spark.createDataFrame([(1, "a", "p", "m", 2, "h", [1.0, 0.0], "1"), (2, "a", "p", "m", 2, "h2", [0.0, 1.0], "2"), (3, "b", "p", "m", 2, "h", [0.0, 0.0], "1"), (4, "c", "p", "m", 2, "h", None, "1")], kind)
    assert [r["cache_id"] for r in W.latest_vectors(cache).collect()] == [2]
    docs = spark.createDataFrame([("a", "x"), ("z", "y"), ("e", "")], "document_id string, combined_text string")
    assert sorted(r[0] for r in rows(W.cache_misses(docs, cache, "p", "m", 2))) == ["a", "z"]
    new = cache.filter("cache_id = 1").withColumn("cache_id", F.lit(9).cast("bigint"))
    assert sorted(r["cache_id"] for r in W.upsert_cache(cache, new).collect()) == [3, 4, 9]
    hits = W.semantic_search(cache, spark.createDataFrame([("q", [0.0, 2.0])], "query_id string, vector array<double>"))
    assert rows(hits) == [("q", "a", 1.0, 1)]


# --- plans, keyframes, jobs ----------------------------------------------------------------------------------------------------------------


def test_adaptive_plans(spark):
    q = [("name", "OpenAI"), ("quoted", "'K11 TV' chữ"), ("why", "tại sao cần giống lúa chịu mặn như vậy"), ("frame", "khung đỏ"), ("none", "???")]
    got = {r["query_id"]: r for r in P.adaptive_plans(spark.createDataFrame(q, "query_id string, query string")).collect()}
    assert got["name"]["semantic_weight"] == 0.0 and got["name"]["reranker"] == "none" and got["name"]["candidate_limit"] == 40 and got["name"]["level"] == "both"
    assert got["quoted"]["bm25_weight"] == 1.35 and got["quoted"]["level"] == "both" and got["why"]["reranker"] == "cross" and got["why"]["candidate_limit"] == 60 and got["frame"]["level"] == "both"
    assert got["none"]["entity_weight"] == 0.35 and got["none"]["level"] == "scene"
    with pytest.raises(ValueError, match="path"):
        P.SearchSettings().with_request({"query": "x", "path": "/etc"})
    with pytest.raises(ValueError, match="adaptive"):
        P.SearchSettings().with_request({"adaptive": "false"})
    assert P.SearchSettings().with_request({"limit": 3}).limit == 3


def test_sampling(spark):
    s = spark.createDataFrame([("v", "long", 0, 1000, 40.0), ("v", "short", 7, 9, 0.5), ("v", "one", 5, 6, 3.0)], "video_id string, scene_id string, start_frame bigint, end_frame bigint, duration_seconds double")
    got = {r["scene_id"]: r for r in K.sample_frames(s, K.KeyframeSettings(candidate_multiplier=2, edge_margin=0.08, short_scene_seconds=1.0, short_scene_strategy="first")).collect()}
    assert got["long"]["target"] == 5 and len(got["long"]["frames"]) == 10 and got["long"]["frames"][0] == 80 and got["long"]["frames"][-1] == 919
    assert got["short"]["frames"] == [7] and got["one"]["frames"] == [5]


def test_gate_keeps_all_if_none_passes(spark):
    f = spark.createDataFrame([("a", 1, 100.0, 100.0), ("a", 2, 10.0, 100.0), ("b", 1, 1.0, 1.0), ("b", 2, 2.0, 300.0), ("c", 1, None, None), ("c", 2, 50.0, 100.0), ("c", 3, 100.0, 100.0)], "s string, frame_index int, sharpness double, brightness double")
    assert sorted((r["s"], r["frame_index"]) for r in K.gate(f, ["s"], K.KeyframeSettings(blur_neighbours=1)).collect()) == [("a", 1), ("b", 1), ("b", 2), ("c", 3)]


def test_diverse_selection(spark):
    h1, h2, h3 = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    f = [("v", "s1", 0, 2, 0, 0.9, 0.1, h1, [1.0]), ("v", "s1", 0, 2, 50, 0.8, 0.1, h1, [1.0]), ("v", "s1", 0, 2, 100, 0.7, 0.5, h2, [1.0]), ("v", "s2", 1, 1, 200, 0.9, 0.1, h1, [1.0]), ("v", "s3", 2, 1, 300, 0.5, 0.1, h3, None)]
    df = spark.createDataFrame(f, "video_id string, scene_id string, scene_order int, target int, frame_index bigint, selection_score double, edge_density double, histogram array<double>, flow array<double>")
    assert sorted((r["scene_id"], r["frame_index"]) for r in K.select_diverse(df).collect()) == [("s1", 0), ("s1", 100), ("s3", 300)]
    both = K.select_diverse(df, K.KeyframeSettings(skip_similar_scenes=False)).collect()
    assert ("s2", 200) in {(r["scene_id"], r["frame_index"]) for r in both}


def test_segments(spark):
    f = spark.createDataFrame([("v", k, s) for k, s in enumerate([1.0, 1.1, 9.0, 1.0, 1.2])] + [("w", 0, 1.0), (None, 0, 1.0)], "v string, t int, s double")
    assert sorted((r["v"], r["start_at"], r["n"]) for r in K.segment(f, "v", "t", "s", 3.0).collect()) == [("v", 0, 2), ("v", 2, 1), ("v", 3, 2), ("w", 0, 1)]
    assert sorted((r["v"], r["start_at"], r["n"]) for r in K.segment(f, "v", "t", "s", 3.0, 2).collect()) == [("v", 0, 2), ("v", 2, 3), ("w", 0, 1)]


def test_job_tables(spark):
    e = spark.createDataFrame([("v", "scene", "failed", 1, 1), ("v", "scene", "done", 2, 2), ("v", "proxy", "done", 1, 3), ("w", "scene", "done", 5, 4), ("w", "scene", "failed", 5, 5), (None, "scene", "done", 5, 6)], "video_id string, stage string, status string, at int, n int")
    s = J.latest_state(e, "video_id", "stage", "status", "at", "n")
    assert sorted((r["video_id"], r["stage"], r["status"]) for r in s.collect()) == [("v", "proxy", "done"), ("v", "scene", "done"), ("w", "scene", "failed")]
    assert rows(J.runnable(s, "video_id", "stage", "ocr", ["proxy", "scene"])) == [("v",)] and {tuple(r) for r in J.stage_columns(s, "video_id", "stage", ["proxy", "scene"]).collect()} == {("v", "done", "done"), ("w", None, "failed")}
    t = spark.createDataFrame([("a", "old", 1), ("b", "old", 1)], "k string, x string, made int")
    n = spark.createDataFrame([("b", "new", 2), ("c", "new", 2)], "k string, x string, made int")
    assert sorted(rows(J.upsert(t, n, ["k"], keep=["made"]))) == [("a", "old", 1), ("b", "new", 1), ("c", "new", 2)] and sorted(rows(J.insert_new(t, n, ["k"]))) == [("a", "old", 1), ("b", "old", 1), ("c", "new", 2)]
    jobs = spark.createDataFrame([("u", ["b", "a", "b", None])], "url string, video_ids array<string>")
    assert sorted(rows(J.fan_out(jobs))) == [("u", "a", 1), ("u", "b", 0)]
    rec = spark.createDataFrame([("w", 1), ("v", 2)], "video_id string, x int")
    assert rows(J.merge_outputs(rec, s, "video_id", "stage", "scene")) == [("v", 2)]


# --- evaluation -----------------------------------------------------------------------------------------------------------------------------


def test_evaluation(spark):
    q = spark.createDataFrame([("q1", "x", ["a", "b"]), ("q1", "y", ["a"]), ("q2", " ", []), (None, "z", ["nope"])], "query_id string, query string, relevant_document_ids array<string>")
    d = spark.createDataFrame([("a",), ("b",)], "document_id string")
    assert sorted((a or "", b) for a, b in rows(V.violations(q, d))) == [("", "missing id"), ("", "unknown document nope"), ("q1", "duplicate id"), ("q2", "empty query"), ("q2", "no labels")]
    runs = spark.createDataFrame([("m", "q1", "z", 1), ("m", "q1", "a", 2), ("m", "q1", "b", 7)], "mode string, query_id string, document_id string, rank int")
    labels = spark.createDataFrame([("q1", ["a", "b"]), ("q2", ["c"])], "query_id string, relevant_document_ids array<string>")
    got = {r["query_id"]: tuple(r)[2:] for r in V.query_metrics(runs, labels).collect()}
    assert got == {"q1": (2, 0.5, 1.0, 0.5), "q2": (None, 0.0, 0.0, 0.0)} and rows(V.report(V.query_metrics(runs, labels))) == [("m", 2, 0.25, 0.5, 0.25)]
    v = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    assert v.agg(V.interpolated_percentile("x", 0.95)).first()[0] == pytest.approx(3.8) and v.limit(0).agg(V.interpolated_percentile("x", 0.5)).first()[0] == 0.0


# --- index and search --------------------------------------------------------------------------------------------------------------------------


def corpus(spark):
    rnd = random.Random(9)
    words = "lamp river stone cloud bridge night market boat paper glass".split()
    ent = [("Open AI", "ORG"), ("Lake Placid", "LOCATION")]
    data = []
    for k in range(40):
        t = " ".join(rnd.choices(words, k=8))
        data.append((k, f"v{k % 4}:s{k}", f"v{k % 4}", f"s{k}", float(k * 40), t, "", t, "Open AI", ent[: k % 3], "2025"))
    return spark.createDataFrame(data, "doc_id bigint, document_id string, video_id string, scene_id string, start_seconds double, subtitle_text string, ocr_text string, combined_text string, entities_text string, entities array<struct<text:string,type:string>>, generated_at string")


def aliases(spark):
    return spark.createDataFrame([("OpenAI", "ORG", ["Open AI"])], "canonical string, type string, aliases array<string>")


def test_incremental_equals_full_build(spark):
    docs, al = corpus(spark), aliases(spark)
    changed = docs.filter("video_id in ('v1', 'v2')").withColumn("combined_text", F.concat("combined_text", F.lit(" fresh")))
    part = I.update(I.build(docs, al), changed)
    whole = I.build(docs.filter("video_id in ('v0', 'v3')").unionByName(changed), al)
    for name in ("terms", "idf", "norms", "entities"):
        rounded = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows(df.select(*sorted(df.columns))))
        assert rounded(getattr(part, name)) == rounded(getattr(whole, name)), name


@pytest.mark.parametrize("mode", ["bm25", "tfidf", "entity", "hybrid"])
def test_search_modes(spark, mode):
    index = I.build(corpus(spark), aliases(spark))
    q = spark.createDataFrame([("q1", "boat market"), ("q2", "OpenAI"), ("q3", "zzz")], "query_id string, query string")
    out = R.search(index, q, P.SearchSettings(mode=mode, limit=5), reranker=U.overlap_reranker if mode == "hybrid" else None).collect()
    assert out and all(1 <= r["final_rank"] <= 5 for r in out) and "q3" not in {r["query_id"] for r in out}
    assert not [1 for a in out for b in out if a["query_id"] == b["query_id"] and a["document_id"] < b["document_id"] and a["document_id"][:2] == b["document_id"][:2] and abs(a["start_seconds"] - b["start_seconds"]) <= 30]


# --- sources, sinks, streams ---------------------------------------------------------------------------------------------------------------------


SRT = "﻿1\r\n00:00:01,000 --> 00:00:02,500\r\n<i>Xin</i>\r\nchào\r\n\r\n2\r\n00:00:04,000 --> 00:00:03,000\r\ntạm &amp; biệt\r\n\r\n3\r\n00:00:05,000 --> 00:00:06,000\r\n\r\n"


def test_subtitle_files(spark, tmp_path):
    d = tmp_path / "subs" / "vid1"
    d.mkdir(parents=True)
    (d / "vid1.vi.srt").write_bytes(SRT.encode())
    (d / "vid1.vtt").write_text("WEBVTT\nKind: captions\n\n00:00:01.000 --> 00:00:02.000\nhello\n")
    (d / "x.txt").write_text("no")
    files = readers.subtitle_texts(spark, str(tmp_path / "subs"))
    got = sorted((r["language"], r["start_seconds"], r["end_seconds"], r["text"], r["video_id"]) for r in readers.subtitle_cues(files).collect())
    assert got == [("unknown", 1.0, 2.0, "hello", "vid1"), ("vi", 1.0, 2.5, "Xin chào", "vid1"), ("vi", 4.0, 4.0, "tạm & biệt", "vid1")]
    out = {r["path"].rsplit("/", 1)[1]: r["content"] for r in sinks.rendered_subtitles(readers.subtitle_blocks(files)).collect()}
    assert out["vid1.vtt"].startswith("WEBVTT\nKind: captions\n\n00:00:01.000 --> 00:00:02.000\nhello") and "Xin" in out["vid1.vi.srt"]


def test_lists_json_and_media(spark, tmp_path):
    (tmp_path / "u.txt").write_text("# c\n https://a \n\nhttps://b\nhttps://a\n")
    assert [r["url"] for r in readers.url_list(spark, str(tmp_path / "u.txt")).orderBy("n").collect()] == ["https://a", "https://b", "https://a"]
    assert [r["url"] for r in readers.url_list(spark, str(tmp_path / "u.txt"), True).orderBy("n").collect()] == ["https://a", "https://b"]
    (tmp_path / "o.jsonl").write_text('{"video_id":"v","frame_index":1}\nbroken\n')
    bad = readers.json_lines(spark, str(tmp_path / "o.jsonl"), readers.OCR_DDL, strict=False)
    assert sorted((r["video_id"] or "", r["_corrupt_record"] or "") for r in bad.cache().collect()) == [("", "broken"), ("v", "")]
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|FAILED_READ"):
        readers.json_lines(spark, str(tmp_path / "o.jsonl"), readers.OCR_DDL).collect()
    assert readers.json_lines(spark, str(tmp_path / "missing"), readers.OCR_DDL, required=False).count() == 0 and readers.alias_file(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "s.json").write_text(json.dumps({"video_id": "v", "fps": 25.0, "scenes": [{"scene_id": "scene-001", "start_frame": 0, "end_frame": 5, "start_seconds": 0.0, "end_seconds": 0.2, "duration_seconds": 0.2}]}))
    assert rows(readers.scene_files(spark, str(tmp_path / "s.json")).select("video_id", "scene_id", "end_frame")) == [("v", "scene-001", 5)]
    (tmp_path / "a.mp4").write_bytes(b"xx")
    (tmp_path / "a.txt").write_bytes(b"x")
    assert [(r["video_id"], r["length"]) for r in readers.first_file(readers.media_files(spark, str(tmp_path))).join(readers.media_files(spark, str(tmp_path)), "video_id").collect()] == [("a", 2)]
    items = spark.createDataFrame([("abc=https://y/z",), ("https://y/watch?v=Q_1-",), ("https://y/tail",)], "i string").select(readers.parse_item(F.col("i")).alias("p"))
    assert [r["p"]["video_id"] for r in items.collect()] == ["abc", "Q_1-", "tail"]
    nested = spark.createDataFrame([("p", [("x", None), (None, None), ("q", [("y",), (None,)])]), ("z", None)], "id string, entries array<struct<id:string,entries:array<struct<id:string>>>>")
    assert sorted(r[0] for r in rows(readers.nested_ids(nested))) == ["x", "y", "z"]


def test_index_round_trip(spark, tmp_path):
    index = I.build(corpus(spark), aliases(spark))
    sinks.write_index(index, str(tmp_path / "ix"))
    assert readers.level_table(spark, str(tmp_path / "ix"), "scene").count() == 40 and spark.read.parquet(str(tmp_path / "ix/terms/level=scene")).count() == index.terms.count()
    cache = spark.createDataFrame([(1, "a", "p", "m", 2, "h", [3.0, 4.0], "1")], "cache_id bigint, document_id string, provider string, model string, dimension int, text_hash string, vector array<float>, updated_at string")
    sinks.write_vectors(cache, str(tmp_path / "ix"))
    v, meta = readers.vector_index(spark, str(tmp_path / "ix"))
    assert v.first()["vector"] == pytest.approx([0.6, 0.8]) and meta.first()["count"] == 1
    df = spark.createDataFrame([("/a/v.en.srt", "https://x")], "p string, u string")
    assert df.select(sinks.translated_path(F.col("p"), "vi"), F.length(sinks.job_log_name(F.col("u")))).first() == ("/a/v.vi.srt", 16)


def test_stream_of_cues(spark, tmp_path):
    _, cues, _ = scene_fixture(spark)
    cues = cues.withColumn("ingested_at", F.timestamp_seconds(F.col("cue_id") * 3600))
    cues.unionByName(cues.filter("cue_id = 1").withColumn("cue_id", F.lit(99).cast("bigint"))).write.parquet(str(tmp_path / "in"))
    stream = ingest.fresh_cues(ingest.cue_stream(spark, str(tmp_path / "in"), cues.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")))
    ingest.keep(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(90)
    from reelspark.operators.documents import clean_cues

    assert spark.read.parquet(str(tmp_path / "out")).count() == clean_cues(cues).select("video_id", "language", "start_seconds", "end_seconds", "text").distinct().count()
    counted = ingest.cues_per_window(cues)
    assert sum(r["cues"] for r in counted.collect()) == cues.count()


# --- the stated query set ---------------------------------------------------------------------------------------------


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_searches_answer_the_stated_set(spark):
    """Every cue with an id divisible by 20 asks; its document set is what its own words say."""
    sf = "/root/testdata/sf0.001"
    asked = {f"c{r.cue_id}": r.text for r in spark.read.parquet(f"{sf}/subtitle_cues.parquet").filter("cue_id % 20 = 0 and length(text) > 0").collect()}
    assert len(asked) > 10
    docs = L.latest_documents(spark.read.parquet(f"{sf}/documents.parquet")).select("document_id", X.tokens(F.concat_ws(" ", *L.FIELD_WEIGHTS)).alias("t")).collect()
    terms = {r.query_id: set(r.qt) for r in Q.stated_searches(spark, sf).select("query_id", X.query_terms(F.col("query")).alias("qt")).collect()}
    assert set(terms) == set(asked)
    expected = {(q, d.document_id) for q, qt in terms.items() for d in docs if qt & set(d.t or ())}
    assert {tuple(r) for r in Q.QUERIES["fts_match_stated"](spark, sf).select("query_id", "document_id").collect()} == expected
    best = Q.QUERIES["bm25_search_stated"](spark, sf).groupBy("query_id").count().collect()
    assert {r.query_id for r in best} >= {q for q, _ in expected} and max(r["count"] for r in best) <= 20
    assert {n for n in Q.QUERIES if n.endswith("_stated")} == {f"{n}_stated" for n in "tfidf_search bm25_scores bm25_search fts_match entity_search query_entity_keys hybrid_search tfidf_mode_search".split()}
