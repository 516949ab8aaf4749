"""Keyframe settings and selection, detectors, job tables, readers, stored indexes, levels, the shared folder."""

import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark import session
from reelspark.functions import scores as S
from reelspark.operators import entities as E
from reelspark.operators import evaluation as V
from reelspark.operators import incremental as I
from reelspark.operators import jobs as J
from reelspark.operators import keyframes as K
from reelspark.operators import lexical as L
from reelspark.operators import search as R
from reelspark.operators import vectors as W
from reelspark.operators.planner import SearchSettings
from reelspark.sources import readers, sinks


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_no_private_folder_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    df = session.materialize(spark.range(5), "t")
    assert df.count() == 5 and session.release(spark) >= 1 and session.release(spark) == 0


def test_default_settings():
    s = K.KeyframeSettings()
    assert (s.edge_margin, s.short_scene_seconds, s.short_scene_strategy, s.min_brightness, s.max_brightness) == (0.10, 5.0, "diverse", 25.0, 235.0)
    assert (s.blur_ratio, s.blur_neighbours, s.mode, s.motion_weight) == (0.65, 2, "flow", 0.55)
    assert (K.STAGED.sample_every_seconds, K.STAGED.max_frames, K.STAGED.short_scene_strategy, K.STAGED.reject_blur) == (20.0, 2, "first", False)


def test_blur_is_judged_by_frame_number(spark):
    f = spark.createDataFrame([("a", 10, 50.0, 100.0), ("a", 12, 100.0, 100.0), ("a", 13, 40.0, 100.0), ("a", 20, 60.0, 100.0)], "s string, frame_index bigint, sharpness double, brightness double")
    assert sorted(r.frame_index for r in K.gate(f, ["s"]).collect()) == [12, 13, 20]
    short = f.withColumn("d", F.lit(1.0))
    assert K.gate(short, ["s"], duration="d").count() == 4
    assert K.gate(f, ["s"], K.STAGED).count() == 4


def frames(spark, data):
    cols = "video_id string, scene_id string, scene_order int, target int, frame_index bigint, selection_score double, edge_density double, histogram array<double>, flow array<double>"
    return spark.createDataFrame(data, cols)


def hist(k, n=8):
    return [1.0 if i == k else 0.0 for i in range(n)]


def test_windows_then_fill(spark):
    data = [("v", "s", 0, 2, 0, 0.1, 0.0, hist(0), hist(0)), ("v", "s", 0, 2, 50, 0.9, 0.5, hist(1), hist(1)), ("v", "s", 0, 2, 99, 0.8, 0.2, hist(2), hist(2))]
    assert [r.frame_index for r in K.select_in_scene(frames(spark, data)).orderBy("pick").collect()] == [0, 50]
    free = K.KeyframeSettings(diverse_windows=False)
    assert [r.frame_index for r in K.select_in_scene(frames(spark, data), free).orderBy("pick").collect()] == [50, 99]
    same = [("v", "s", 0, 3, k, 1.0 - k / 10, 0.0, hist(0), hist(0)) for k in range(3)]
    assert K.select_in_scene(frames(spark, same)).count() == 1
    assert K.select_in_scene(frames(spark, same), K.KeyframeSettings(fill_duplicates=True)).count() == 3


def test_edge_breaks_ties_of_the_last_resort(spark):
    data = [("v", "a", 0, 1, 0, 0.5, 0.1, hist(0), hist(0)), ("v", "b", 1, 1, 10, 0.9, 0.1, hist(0), hist(0)), ("v", "b", 1, 1, 11, 0.5, 0.7, hist(0), hist(0))]
    out = K.select_diverse(frames(spark, data), K.KeyframeSettings(skip_similar_scenes=False))
    assert sorted(r.frame_index for r in out.collect()) == [0, 11]


def test_many_scenes_stream_through(spark):
    """More scenes than a batch holds; the choice of each depends on the last ones only."""
    data = [(f"v{v}", f"s{k:04d}", k, 1, k, 0.5, 0.0, hist(k % 3, 4), hist(0)) for v in range(2) for k in range(300)]
    out = K.select_diverse(frames(spark, data), K.KeyframeSettings(lookback=2))
    assert out.count() == 600


def test_min_length_counts_from_the_last_accepted_cut(spark):
    cuts = {10, 20, 30}
    data = [("v", k, 100.0 if sum(c <= k for c in cuts) % 2 else 0.0) for k in range(40)]
    df = spark.createDataFrame(data, "v string, t int, s double")
    assert [r.start_at for r in K.segment(df, "v", "t", "s", 50.0, 15).orderBy("scene_no").collect()] == [0, 20]


def test_detectors(spark):
    content = [("v", k, 80.0 if k in (20, 45) else 20.0 if k == 30 else 2.0) for k in range(60)]
    df = spark.createDataFrame(content, "v string, t int, s double")
    assert [r.start_at for r in K.segment_by_content(df, "v", "t", "s").orderBy("scene_no").collect()] == [0, 20, 45]
    assert [r.start_at for r in K.segment_adaptive(df, "v", "t", "s", min_length=5).orderBy("scene_no").collect()] == [0, 20, 30, 45]
    h = spark.createDataFrame([("v", k, hist(0 if k < 25 else 3)) for k in range(50)], "v string, t int, h array<double>")
    assert [r.start_at for r in K.segment_by_histogram(h, "v", "t", "h").orderBy("scene_no").collect()] == [0, 25]


def test_correlation(spark):
    a, b = [1.0, 2.0, 4.0], [2.0, 1.0, 5.0]
    df = spark.createDataFrame([(a, b), (a, a), (a, [3.0, 3.0, 3.0]), (a, None)], "a array<double>, b array<double>")
    got = [r[0] for r in rows(df.select(S.correlation(F.col("a"), F.col("b"))))]
    assert abs(got[0] - np.corrcoef(a, b)[0, 1]) < 1e-12 and got[1] == pytest.approx(1.0) and got[2:] == [1.0, None]


def test_job_tables(spark):
    t = J.job_tables(spark)
    urls = J.enqueue(t["url_jobs"], spark.createDataFrame([("http://a",), ("http://b",), ("http://a",)], "url string"), "t0")
    assert sorted(r.url for r in urls.collect()) == ["http://a", "http://b"]
    assert J.rows_for_stage(urls, "download").count() == 2
    res = spark.createDataFrame([("http://a", "done", None, ["v1", "v2", "v1"], 1.5), ("http://b", "failed", "gone", None, 0.1)], "url string, status string, error string, video_ids array<string>, seconds double")
    urls, videos = J.mark_urls(urls, t["video_jobs"], res, "t1")
    assert {r.url: (r.status, r.updated_at) for r in urls.collect()} == {"http://a": ("done", "t1"), "http://b": ("failed", "t1")}
    assert {r.video_id: (r.download_status, r.scene_status, r.created_at) for r in videos.collect()} == {"v1": ("done", "pending", "t1"), "v2": ("done", "pending", "t1")}
    step = spark.createDataFrame([("v1", "done", None, 2.0), ("v2", "failed", "bad", 1.0)], "video_id string, status string, error string, seconds double")
    videos = J.mark_stage(J.mark_stage(videos, "proxy", step, "t2"), "scene", step.filter("video_id = 'v1'"), "t3")
    assert [r.video_id for r in J.rows_for_stage(videos, "scene").collect()] == []  # v2 has an error, v1 is done
    assert [r.video_id for r in J.rows_for_stage(videos, "keyframe").collect()] == ["v1"]
    assert J.rows_for_stage(videos, "keyframe", force=True).count() == 2
    _, again = J.mark_urls(urls, videos, res.filter("status = 'done'"), "t4")
    kept = {r.video_id: (r.proxy_status, r.scene_status, r.error) for r in again.collect()}
    assert kept == {"v1": ("done", "done", None), "v2": ("pending", "pending", None)}
    assert {r.video_id: r.timings for r in videos.collect()}["v1"] == {"proxy": 2.0, "scene": 2.0}
    old = J.job_tables(spark, {"video_jobs": videos.drop("gemini_status")})["video_jobs"]
    assert {r.gemini_status for r in old.collect()} == {"pending"}
    assert J.stages_between("scene", "ocr") == ["scene", "keyframe", "ocr"]
    with pytest.raises(ValueError):
        J.stages_between("ocr", "scene")
    assert [r.video_id for r in J.without_outputs(videos, videos.filter("video_id = 'v1'"), "video_id").collect()] == ["v2"]
    assert J.addresses(videos, spark.createDataFrame([("v1",)], "video_id string")).first().url == "http://a"
    with pytest.raises(Exception, match="no web address"):
        J.addresses(videos, spark.createDataFrame([("zz",)], "video_id string")).collect()


def test_paths_and_languages(spark):
    df = spark.createDataFrame([("/d/v/scene-012/frame-000123.jpg",), ("/d/v/other/x.jpg",)], "p string")
    got = rows(df.select(J.frame_of_path(F.col("p")), J.scene_of_path(F.col("p")), J.relative_path(F.col("p"), "/d/v/")))
    assert got == [(123, "scene-012", "scene-012/frame-000123.jpg"), (None, "other", "other/x.jpg")]
    assert J.languages(" vi, en ,") == ["vi", "en"]
    with pytest.raises(ValueError):
        J.languages(" , ")
    files = spark.createDataFrame([("a.en.srt",), ("a.VI.srt",), ("a-vi.srt",), ("a.en-orig.srt",)], "path string")
    assert [r.path for r in J.to_translate(files, "vi").collect()] == ["a.en.srt"]


def test_json_lines(spark, tmp_path):
    good = tmp_path / "a.jsonl"
    good.write_bytes("﻿".encode() + b'{"query_id": "q1", "query": "x"}\n\n{"query_id": "q2"}\n')
    assert sorted(r.query_id for r in readers.json_lines(spark, str(good), readers.QUERY_DDL).collect()) == ["q1", "q2"]
    bad = tmp_path / "b.jsonl"
    bad.write_text('{"query_id": "q1"}\n{"query_id": \n')
    with pytest.raises(ValueError, match="line 2"):
        readers.json_lines(spark, str(bad), readers.QUERY_DDL)
    assert readers.json_lines(spark, str(tmp_path / "none"), readers.QUERY_DDL, required=False).count() == 0
    loose = readers.json_lines(spark, str(bad), readers.QUERY_DDL, strict=False)
    assert loose.filter("_corrupt_record is not null").count() == 1


def test_ids_at_any_depth(spark):
    kind = "struct<id:string,entries:array<struct<id:string,entries:array<struct<id:string,entries:array<struct<id:string>>>>>>>"
    text = json.dumps({"id": "list", "entries": [{"id": "a"}, None, {"id": "inner", "entries": [{"id": "b"}, {"id": "deep", "entries": [{"id": "c"}, {"id": None}]}]}]})
    info = spark.createDataFrame([(text,)], "j string").select(F.from_json("j", kind).alias("x")).select("x.*")
    assert sorted(r.video_id for r in readers.nested_ids(info).collect()) == ["a", "b", "c"]


def corpus(spark):
    made = [(k, f"v{k % 3}:s{k}", f"v{k % 3}", f"s{k}", float(k), f"the boat {w} river", "VTV news", f"the boat {w} river\nVTV news", "", None, "2024") for k, w in enumerate(["crosses", "leaves", "reaches", "Nguyễn Văn An crosses", "leaves"])]
    return spark.createDataFrame(made, "doc_id bigint, document_id string, video_id string, scene_id string, start_seconds double, subtitle_text string, ocr_text string, combined_text string, entities_text string, entities array<struct<text:string,type:string>>, generated_at string")


def aliases(spark):
    return spark.createDataFrame([("Nguyễn Văn An", "PERSON", ["anh An"]), ("Thành phố Hồ Chí Minh", "LOCATION", ["Sài Gòn"]), ("Hồ Chí Minh", "PERSON", None)], "canonical string, type string, aliases array<string>")


def asked(spark):
    return spark.createDataFrame([("a", "boat river"), ("b", "Nguyễn Văn An"), ("c", "vtv")], "query_id string, query string")


def test_stored_index_gives_the_same_search(spark, tmp_path):
    index = I.build(corpus(spark), aliases(spark))
    sinks.write_index(index, str(tmp_path / "ix"))
    stored = readers.index_levels(spark, str(tmp_path / "ix"))["scene"]
    plain = L.bm25_scores(index.documents, asked(spark))
    by_postings = L.bm25_scores(stored.documents, asked(spark), stored=stored.postings, totals=stored.totals)
    assert sorted(rows(plain)) == sorted(rows(by_postings))
    plan = by_postings._jdf.queryExecution().executedPlan().toString()
    assert "combined_text" not in plan and re.search(r"postings|term", plan)
    for mode in ("bm25", "tfidf", "entity", "hybrid"):
        s = SearchSettings(mode=mode)
        assert sorted(rows(R.search(index, asked(spark), s))) == sorted(rows(R.search(stored, asked(spark), s)))


def test_index_finds_entities_in_texts(spark):
    docs = corpus(spark).withColumn("combined_text", F.when(F.col("doc_id") == 4, "từ thành phố Hồ Chí Minh").otherwise(F.col("combined_text")))
    found = {(r.document_id, r.canonical_key, r.entity_type) for r in I.build(docs, aliases(spark)).entities.collect()}
    assert ("v0:s3", "nguyen van an", "PERSON") in found and ("v0:s0", "vtv", "ORG") in found
    city = {(k, t) for d, k, t in found if d == "v1:s4"}
    assert ("thanh pho ho chi minh", "LOCATION") in city and ("ho chi minh", "PERSON") not in city


def test_levels_are_fused_to_one_ranking(spark):
    scene = I.build(corpus(spark), aliases(spark))
    keyframe = I.build(corpus(spark).withColumn("document_id", F.concat("document_id", F.lit(":k"))), aliases(spark))
    out = R.search({"scene": scene, "keyframe": keyframe}, asked(spark), SearchSettings(level="both", dedupe_seconds=0))
    assert {r.level for r in out.collect()} == {"scene", "keyframe"}
    for q in "abc":
        ranks = sorted(r.final_rank for r in out.filter(F.col("query_id") == q).collect())
        assert ranks == list(range(1, len(ranks) + 1))
    with pytest.raises(ValueError):
        R.search(scene, asked(spark), SearchSettings(mode="semantic"))
    with pytest.raises(ValueError):
        R.search({"keyframe": keyframe}, asked(spark), SearchSettings(mode="tfidf", level="keyframe"))


def test_overlap_counts_for_every_list(spark):
    merged = spark.createDataFrame([("b", "v0:s3", 1, 0), ("b", "v0:s0", 2, 0)], "query_id string, document_id string, bm25_rank int, entity_overlap int")
    found = spark.createDataFrame([("v0:s3", "nguyen van an"), ("v0:s0", "vtv")], "document_id string, canonical_key string")
    keys = spark.createDataFrame([("b", "nguyen van an")], "query_id string, canonical_key string")
    assert {r.document_id: r.entity_overlap for r in R.with_overlap(merged, found, keys).collect()} == {"v0:s3": 1, "v0:s0": 0}


def test_long_aliases_are_met_whole(spark):
    dim = E.alias_dimension(spark.createDataFrame([("a b c d e f g h", "ORG", ["a b"]), ("b c", "ORG", None)], "canonical string, type string, aliases array<string>"))
    docs = spark.createDataFrame([("x", "z a b c d e f g h"), ("y", "a b c d e f g"), ("z", None)], "document_id string, combined_text string")
    got = {(r.document_id, r.alias_key) for r in E.alias_hits(docs, dim).collect()}
    assert got == {("x", "a b c d e f g h"), ("x", "a b"), ("x", "b c"), ("y", "a b"), ("y", "b c")}


def test_embedding_build(spark):
    docs = spark.createDataFrame([("d1", "boat"), ("d2", "river"), ("d3", "")], "document_id string, combined_text string")
    vector = F.array(*[F.lit(float(k)) for k in range(4)])
    cache = W.embed_missing(docs, spark.createDataFrame([], W.CACHE_DDL), vector, "p", "m", 4)
    assert sorted(r.document_id for r in cache.collect()) == ["d1", "d2"]
    assert W.embed_missing(docs.withColumn("combined_text", F.lit("new")), cache, vector, "p", "m", 4).count() == 3
    assert W.cache_misses(docs, cache, "p", "m", 4).count() == 0
    with pytest.raises(Exception, match="another length"):
        W.embed_missing(docs, spark.createDataFrame([], W.CACHE_DDL), vector, "p", "m", 5).collect()


def test_min_distance_in_blocks(spark):
    rng = np.random.default_rng(3)
    data = [(k, k % 3, rng.random(6).tolist()) for k in range(90)]
    df = spark.createDataFrame(data, "id bigint, g int, histogram array<double>")
    chosen = df.filter("id % 7 = 0 and g <> 2")
    for size in (10, 1000):
        got = {r.id: r.distance for r in W.min_distance_to(df, chosen, ["g"], rows_per_part=size).collect()}
        for i, g, h in data:
            others = [np.array(x) for j, gg, x in data if gg == g and j % 7 == 0 and g != 2]
            want = min((np.sqrt(max(0.0, 1 - np.sqrt(np.array(h) * o).sum() / np.sqrt(sum(h) * o.sum()))) for o in others), default=1.0)
            assert abs(got[i] - want) < 1e-6


def test_reviewed_and_bounds(spark):
    q = spark.createDataFrame([("a", True), ("b", None), ("c", False)], "query_id string, reviewed boolean")
    assert [r.query_id for r in V.reviewed(q).collect()] == ["a"]
    with pytest.raises(ValueError):
        SearchSettings().with_request({"limit": 10**6})
