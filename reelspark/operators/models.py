"""Where models plug in: one loader for each worker, batches in, columns out.

Every model-backed step of the reference (embedding, reranking, entity recognition, OCR, translation, summaries) is one
call of :func:`map_model` with a loader. The loaders here are deterministic stand-ins that need no model files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.functions import text as X

#: Loads a model once for each Python worker and returns a function from batches of input columns to batches of output columns.
Loader = Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]
_LOADED: dict[str, Callable[[pd.DataFrame], pd.DataFrame]] = {}


def map_model(df: DataFrame, inputs: list[str], loader: Loader, output: str, name: str, on_error: str = "raise") -> DataFrame:
    """``df`` with the model's ``output`` columns (DDL) added, read from ``inputs`` in Arrow batches.

    The model is loaded at the first batch of a worker and kept under ``name``. With ``on_error="status"`` a batch that
    fails gives null outputs and its error in ``error`` instead of ending the job.
    """
    out_names = [part.split()[0] for part in output.split(", ")]
    extra = output + (", error string" if on_error == "status" else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            error = None
            try:
                if name not in _LOADED:
                    _LOADED[name] = loader()
                made = _LOADED[name](batch[inputs]).set_axis(out_names, axis=1)
            except Exception as exc:
                if on_error != "status":
                    raise
                made, error = pd.DataFrame({c: [None] * len(batch) for c in out_names}, index=batch.index), f"{type(exc).__name__}: {exc}"[:500]
            made.index = batch.index
            if on_error == "status":
                made["error"] = error
            yield pd.concat([batch, made], axis=1)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{ddl}, {extra}")


def translate_blocks(blocks: DataFrame, loader: Loader, limit: int = 4000) -> DataFrame:
    """Subtitle blocks (``path, block_no, prefix, text``) with their text translated.

    Neighbouring texts of a file go to the model in one request of up to ``limit`` characters, joined by a mark that a
    translation keeps; where the parts that come back are not as many as were sent, each text is translated by itself.
    """
    mark = "\n␞\n"

    def both() -> Callable[[pd.DataFrame], pd.DataFrame]:
        model = loader()

        def run(batch: pd.DataFrame) -> pd.DataFrame:
            out = []
            for sent in batch["request"]:
                parts = sent.split(mark)
                back = model(pd.DataFrame({"text": [sent]})).iloc[0, 0].split(mark)
                out.append(back if len(back) == len(parts) else [model(pd.DataFrame({"text": [p]})).iloc[0, 0] for p in parts])
            return pd.DataFrame({"parts": out})

        return run

    texts = blocks.filter(F.length("text") > 0).groupBy("path").agg(F.array_sort(F.collect_list(F.struct("block_no", "text"))).alias("b"))
    requests = texts.select("path", F.transform("b", lambda x: x["block_no"]).alias("numbers"), F.posexplode(X.chunks_by_length(F.transform("b", lambda x: x["text"]), limit, mark)).alias("n", "request"))
    done = map_model(requests, ["request"], both, "parts array<string>", "translate")
    flat = done.groupBy("path").agg(F.first("numbers").alias("numbers"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("n", "parts"))), lambda x: x["parts"])).alias("all"))
    pairs = flat.select("path", F.explode(F.arrays_zip("numbers", "all")).alias("z")).select("path", F.col("z.numbers").alias("block_no"), F.col("z.all").alias("translated"))
    return blocks.join(pairs, ["path", "block_no"], "left").select("path", "block_no", "prefix", F.coalesce("translated", "text").alias("text"))


def sentence_chunks(docs: DataFrame, id: str = "document_id", text: str = "combined_text", limit: int = 600) -> DataFrame:
    """``id, chunk_no, chunk``: whole sentences packed into pieces of up to ``limit`` characters for a recognition model."""
    return docs.select(id, F.posexplode(X.chunks_by_length(F.filter(X.sentences(F.col(text)), lambda s: s != ""), limit)).alias("chunk_no", "chunk"))


def model_entities(found: DataFrame, id: str = "document_id", min_score: float = 0.5) -> DataFrame:
    """Entities of a recognition model (``id, entity_text, label, score``) in the form of the rule entities.

    Labels are mapped to the engine's types; weak, short and repeated ones are dropped, the best score of a name counts.
    """
    low = F.upper(F.regexp_replace("label", "^[BI]-", ""))
    kind = F.when(low.isin("PER", "PERSON"), "PERSON").when(low.isin("ORG", "ORGANIZATION"), "ORG").when(low.isin("LOC", "LOCATION", "GPE"), "LOCATION").otherwise("MISC")
    kept = found.withColumn("entity_type", kind).filter((F.col("score") >= min_score) & (F.length(F.trim("entity_text")) >= 2)).withColumn("k", X.search_key(F.col("entity_text")))
    best = kept.groupBy(id, "k", "entity_type").agg(F.max("score").alias("score"), F.min("entity_text").alias("entity_text"))
    return best.select(id, F.lit(500_000).alias("ordinal"), "entity_text", "entity_type", F.lit("model").alias("source"), "score")


def parsed_summary(text: str = "text"):
    """A model's answer as JSON, fenced or not; null where it is none."""
    bare = F.trim(F.regexp_replace(F.col(text), r"^\s*```(?:json)?\s*|\s*```\s*$", ""))
    return F.try_parse_json(bare)
