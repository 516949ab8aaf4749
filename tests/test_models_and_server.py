"""Model boundaries, frame features, the server and the commands."""

import json
import threading
import urllib.error
import urllib.request

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelspark import cli
from reelspark.operators import frames, incremental, models
from reelspark.server import make_server
from tests.test_core import aliases, corpus


def upper():
    return lambda batch: pd.DataFrame({"out": batch.iloc[:, 0].str.upper()})


def broken():
    raise OSError("no model")


def test_map_model(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, text string")
    assert sorted(tuple(r) for r in models.map_model(df, ["text"], upper, "loud string", "upper").collect()) == [(1, "a", "A"), (2, None, None)]
    failed = models.map_model(df, ["text"], broken, "loud string", "broken", on_error="status").collect()
    assert all(r["loud"] is None and "no model" in r["error"] for r in failed)
    with pytest.raises(Exception, match="no model"):
        models.map_model(df, ["text"], broken, "loud string", "broken").collect()


def test_translation_falls_back_to_single_blocks(spark):
    blocks = spark.createDataFrame([("p", 0, ["WEBVTT"], ""), ("p", 1, ["t1"], "one"), ("p", 2, ["t2"], "two")], "path string, block_no int, prefix array<string>, text string")
    def loses_marks():
        return lambda batch: pd.DataFrame({"t": batch["text"].map(lambda t: t.replace("\n␞\n", " ").upper())})
    for n, loader in enumerate((upper, loses_marks)):
        models._LOADED.clear()
        out = {r["block_no"]: r["text"] for r in models.translate_blocks(blocks.withColumn("path", F.lit(f"p{n}")), loader).collect()}
        assert out == {0: "", 1: "ONE", 2: "TWO"}


def test_model_entities_and_summaries(spark):
    found = spark.createDataFrame([("d", "An", "B-PER", 0.9), ("d", "an", "PER", 0.8), ("d", "x", "ORG", 0.9), ("d", "Acme", "ORG", 0.2)], "document_id string, entity_text string, label string, score double")
    assert [(r["entity_text"], r["entity_type"], r["score"]) for r in models.model_entities(found).collect()] == [("An", "PERSON", 0.9)]
    s = spark.createDataFrame([("```json\n{\"a\": 1}\n```",), ("no json",)], "text string").select(F.to_json(models.parsed_summary()).alias("j"))
    assert [r["j"] for r in s.collect()] == ['{"a":1}', None]
    docs = spark.createDataFrame([("d", "One. Two. Three."), ("e", None)], "document_id string, combined_text string")
    assert [r["chunk"] for r in models.sentence_chunks(docs, limit=9).orderBy("chunk_no").collect()] == ["One. Two.", "Three."]


def test_frame_features(spark):
    flat, split = np.full((8, 8, 3), 120, np.uint8), np.zeros((8, 8, 3), np.uint8)
    split[:, 4:] = 255
    data = [("v", "s", 1, 8, 8, split.tobytes()), ("v", "s", 0, 8, 8, flat.tobytes()), ("v", "s", 2, 9, 9, b"xx"), ("v", "s", 3, 1, 1, bytes([255, 0, 0]))]
    out = {r["frame_index"]: r for r in frames.frame_features(spark.createDataFrame(data, "video_id string, scene_id string, frame_index bigint, height int, width int, rgb binary")).collect()}
    assert set(out) == {0, 1, 3} and out[0]["sharpness"] == 0 and out[0]["motion"] == 0 and out[1]["sharpness"] > 100 and out[1]["motion"] > 100 and out[1]["edge_density"] > 0
    assert all(abs(sum(r["histogram"]) - 1) < 1e-9 and len(r["histogram"]) == 512 for r in out.values())


def test_server(spark):
    server = make_server(spark, incremental.build(corpus(spark), aliases(spark)), port=0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_address[1]}"

    def post(body, path="/search"):
        try:
            with urllib.request.urlopen(urllib.request.Request(base + path, json.dumps(body).encode())) as r:
                return r.status, json.loads(r.read())
        except urllib.error.HTTPError as e:
            return e.code, json.loads(e.read())

    try:
        assert json.loads(urllib.request.urlopen(base + "/health").read()) == {"status": "ok"}
        code, body = post({"query": "boat market", "limit": 3, "adaptive": True, "mode": "bm25"})
        assert code == 200 and 1 <= len(body["hits"]) <= 3 and body["hits"][0]["final_rank"] == 1
        assert post({"query": " "})[0] == 400 and post({"query": "x", "db": "/etc/passwd"})[0] == 400 and post({}, "/nope")[0] == 404
    finally:
        server.shutdown()


def test_commands(spark, tmp_path, capsys):
    corpus(spark).write.parquet(str(tmp_path / "documents.parquet"))
    aliases(spark).write.parquet(str(tmp_path / "entity_aliases.parquet"))
    assert cli.main(["search", "--tables", str(tmp_path), "--query", "boat", "--mode", "bm25", "--limit", "2"]) == 0
    assert len(capsys.readouterr().out.strip().split("\n")) == 2
    (tmp_path / "q.jsonl").write_text(json.dumps({"query_id": "q1", "query": "boat", "relevant_document_ids": ["v0:s0"]}) + "\n")
    assert cli.main(["validate", "--tables", str(tmp_path), "--queries", str(tmp_path / "q.jsonl")]) == 0
    assert cli.main(["report", "--tables", str(tmp_path), "--queries", str(tmp_path / "q.jsonl"), "--output", str(tmp_path / "r")]) == 0
    assert spark.read.json(str(tmp_path / "r")).count() >= 1
    assert cli.main(["build", "--tables", str(tmp_path), "--output", str(tmp_path / "ix")]) == 0
