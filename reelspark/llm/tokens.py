"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

#: Where the public tokenizers' vocabulary files lie; always a parameter of the operators.
TOKENIZER_DIR = os.environ.get("REELSPARK_TOKENIZERS", "/opt/tokenizers")
TOKENIZER_FILE = "byte_bpe_multi_50k.tiktoken"
# Fixed value: the pre-tokenisation pattern published with the byte-level vocabularies.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoding(path: str):
    """The tokenizer of a rank file, loaded once for each Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(df: DataFrame, text: str, out: str = "n_tokens", tokenizer: str | None = None) -> DataFrame:
    """``df`` without the text but with ``out``, the whole text's number of tokens; null and empty texts have 0.

    One Arrow pass: text goes to Python in batches and only a number comes back, so later steps never carry it.
    """
    path = tokenizer or os.path.join(TOKENIZER_DIR, TOKENIZER_FILE)
    rest = [c for c in df.columns if c != text]
    if out in rest:
        raise ValueError(f"the input already has a column {out}")
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest] + [f"`{out}` bigint"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)
        for batch in batches:
            sizes = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [pa.array(sizes, pa.int64())], names=[*rest, out])

    return df.mapInArrow(count, schema)
