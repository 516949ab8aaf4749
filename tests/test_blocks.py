"""Searches of many queries in blocks: the same rows as by joins, and no shuffle by query and document."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.operators import blocks as B
from reelspark.operators import incremental as I
from reelspark.operators import lexical as L

WORDS = "lua gom song treo cau bien duong vuon nha phim den may".split()


@pytest.fixture(autouse=True)
def small_packs(monkeypatch):
    monkeypatch.setattr(B, "PACK_ROWS", 40)


@pytest.fixture(scope="module")
def docs(spark):
    """Repeated texts (equal scores), a null text, a null id, one without words."""
    text = lambda i: " ".join(WORDS[j % 12] for j in range(i % 7, i % 7 + 2 + i % 5))
    rows = [(f"d{i:03}", text(i), "treo " * (i % 3), text(i + 1), "Gom" if i % 9 == 0 else None) for i in range(90)]
    rows += [("d900", None, None, None, None), (None, "gom", "gom", "gom", "gom"), ("d901", "...", "", "!", None)]
    return spark.createDataFrame(rows, "document_id string, subtitle_text string, ocr_text string, combined_text string, entities_text string").cache()


@pytest.fixture(scope="module")
def queries(spark):
    """More than the few that are joined: repeated ones, stopwords alone, none known, repeated words, empty."""
    rows = [(f"q{i:03}", " ".join(WORDS[(i * j) % 12] for j in range(1, 2 + i % 4))) for i in range(B.FEW + 5)]
    return spark.createDataFrame(rows + [("s", "của và là"), ("u", "unknown"), ("r", "gom gom gom treo"), ("e", ""), ("n", None)], "query_id string, query string").cache()


def both(monkeypatch, make):
    plan = (new := make())._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(L, "many", lambda q: False)
    old = make()
    assert new.columns == old.columns and [f.dataType for f in new.schema] == [f.dataType for f in old.schema]
    got, expected = (sorted(map(tuple, df.collect()), key=repr) for df in (new, old))
    assert len(got) == len(expected) > 0 and got == expected
    return plan


def test_many_bm25_scores(monkeypatch, docs, queries):
    for digits in (9, 6):
        plan = both(monkeypatch, lambda: L.bm25_scores(docs, queries, digits=digits))
        monkeypatch.undo()
        monkeypatch.setattr(B, "PACK_ROWS", 40)
    assert "hashpartitioning(query_id" not in plan.split("MapInArrow")[0]  # sums are made in tasks: no shuffle of pairs


def test_billionths():
    x = np.array([0.0, 1e-9, 1.4999999994, 12.3456789125, 0.1234567895, 1234.5678901235, 5e-10, 3.0000000005])
    assert B.billionths(x).tolist() == [0, 1, 1499999999, 12345678913, 123456790, 1234567890124, 1, 3000000001]


def test_few_queries_are_joined(docs, queries):
    plan = L.bm25_scores(docs, queries.limit(3))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan


def test_other_ids(spark, monkeypatch, docs, queries):
    """Ids of another type, and packs whose number follows their order."""
    d = docs.filter("document_id is not null").withColumn("document_id", F.substring("document_id", 2, 3).cast("bigint"))
    both(monkeypatch, lambda: L.bm25_scores(d, queries))


def test_many_matches(monkeypatch, docs, queries):
    plan = both(monkeypatch, lambda: L.match_any(docs.filter("document_id is not null"), queries))
    assert plan.count("MapInArrow") == 2 and "hashpartitioning(query_id" not in plan.split("MapInArrow")[0]


def test_many_tfidf_searches(monkeypatch, docs, queries):
    d = docs.filter("document_id is not null")
    tf = L.term_frequencies(d).cache()
    idf = L.idf_stats(tf)
    for limit in (3, 50):
        plan = both(monkeypatch, lambda: L.tfidf_search(tf, idf, L.document_norms(tf, idf), queries, limit))
        assert plan.count("MapInArrow") == 2
        monkeypatch.undo()
        monkeypatch.setattr(B, "PACK_ROWS", 40)


def test_many_bm25_searches(monkeypatch, docs, queries):
    """Also with entity hits and over stored postings; texts are read once, not for each hit."""
    d = docs.filter("document_id is not null")
    flagged = queries.filter("query_id < 'q100'").select("query_id", F.lit("d017").alias("document_id"))
    for stored in ({}, {"stored": L.postings(d).cache(), "totals": L.corpus_totals(d)}):
        for limit in (2, 30):
            plan = both(monkeypatch, lambda: L.bm25_search(d, queries, limit, flagged, **stored))
            assert plan.count("MapInArrow") == 2
            monkeypatch.undo()
            monkeypatch.setattr(B, "PACK_ROWS", 40)


def test_index_tables_begin_with_stored_parts(spark):
    """With ``once`` no table of an index makes its documents again."""
    d = spark.range(30).selectExpr("concat('d', id) document_id", "id doc_id", "'2026' generated_at", "concat('v', id % 3) video_id", *[f"'lua gom' {f}" for f in L.FIELD_WEIGHTS])
    aliases = spark.createDataFrame([("Gom", "org", ["lua"])], "canonical string, type string, aliases array<string>")
    again, once = I.build(d, aliases), I.build(d, aliases, once=True)
    for name in ("documents", "terms", "idf", "norms", "entities", "postings", "totals"):
        old, new = getattr(again, name), getattr(once, name)
        assert sorted(map(str, old.collect())) == sorted(map(str, new.select(*old.columns).collect()))
        assert " Range (" in old._jdf.queryExecution().executedPlan().toString() and " Range (" not in new._jdf.queryExecution().executedPlan().toString()
