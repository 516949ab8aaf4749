"""Index tables of scene and keyframe documents, built whole or brought up to date for some videos."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.operators import documents as D
from reelspark.operators import entities as E
from reelspark.operators import lexical as L
from reelspark.session import materialize


@dataclass(frozen=True)
class Index:
    """The tables that the searches read."""

    documents: DataFrame
    terms: DataFrame
    idf: DataFrame
    norms: DataFrame
    entities: DataFrame
    aliases: DataFrame
    #: ``term, document_id, f, dl`` (weighted frequency, length) and one row ``n, avgdl``; without them BM25 reads the texts
    postings: DataFrame | None = None
    totals: DataFrame | None = None


def _statistics(documents: DataFrame, terms: DataFrame, entities: DataFrame, aliases: DataFrame) -> Index:
    idf = L.idf_stats(terms)
    postings = L.postings(documents)
    return Index(documents, terms, idf, L.document_norms(terms, idf), entities, aliases, postings, L.corpus_totals(documents))


def found_entities(documents: DataFrame, aliases: DataFrame) -> DataFrame:
    """The entities of documents: by rules and aliases in their texts, and those that they list (a model's), in canonical form."""
    listed = E.listed_entities(documents) if "entities" in documents.columns else None
    return E.document_entities(documents, aliases, suppress=E.suppressed(documents.sparkSession), listed=listed)


def build(docs: DataFrame, aliases: DataFrame, once: bool = False) -> Index:
    """The whole index from documents (insert-or-replace by ``document_id``) and alias records.

    Each of its tables is a plan of its own that begins with ``docs``. With ``once`` documents and terms are stored first, so that
    to write them all makes the documents a single time.
    """
    keep = materialize if once else lambda df, name: df
    documents, dim = keep(L.latest_documents(docs), "documents"), E.alias_dimension(aliases)
    return _statistics(documents, keep(L.term_frequencies(documents), "terms"), found_entities(documents, dim), dim)


def _stamped(docs: DataFrame) -> DataFrame:
    return docs.withColumn("generated_at", F.lit(None).cast("string")).withColumn("doc_id", F.lit(0).cast("bigint")).withColumn("entities_text", F.lit(""))


def keyframe_index(scene_docs: DataFrame, aliases: DataFrame, once: bool = False) -> Index:
    """The index of the keyframes of scene documents (:func:`documents.scene_documents`)."""
    return build(_stamped(D.keyframe_documents(scene_docs)), aliases, once)


def build_levels(scene_docs: DataFrame, aliases: DataFrame) -> dict[str, Index]:
    """An index of scene documents (:func:`documents.scene_documents`) and one of their keyframes."""
    return {"scene": build(_stamped(scene_docs), aliases), "keyframe": keyframe_index(scene_docs, aliases)}


def remove_videos(index: Index, videos: DataFrame) -> Index:
    """The index without the documents of ``videos`` (``video_id``): anti-joins, statistics made anew. Null videos name none."""
    gone = index.documents.join(videos.select("video_id").distinct(), "video_id", "left_semi").select("document_id")
    less = lambda df: df.join(gone, "document_id", "left_anti")
    return _statistics(less(index.documents), less(index.terms), less(index.entities), index.aliases)


def update(index: Index, changed: DataFrame) -> Index:
    """The index with all documents of the changed videos replaced by ``changed``; equal to a whole build on the result."""
    documents = L.latest_documents(changed)
    rest = remove_videos(index, documents.select("video_id"))
    return _statistics(
        rest.documents.unionByName(documents, allowMissingColumns=True), rest.terms.unionByName(L.term_frequencies(documents)),
        rest.entities.unionByName(found_entities(documents, index.aliases)), index.aliases,
    )
