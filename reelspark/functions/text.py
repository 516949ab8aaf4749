"""Text functions as column expressions; Python only where Spark has no equivalent."""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that are no index terms, in the folded form that a term has, and accented ones, which no term has.
STOPWORDS = tuple(sorted(set("""bao bằng bị các cái cần cho chúng có của đang đâu đây đến đoạn đó được gì hay hiện khi không là làm lúc mà một nào này nhắc những ở ra sao sẽ ta thì thời trong từ và vào về với xuất
bao bang bi cac cai can cho chung co cua dang dau day den do duoc gi hay hien khi khac khong la lam luc ma mot nao nay nhu nhung o ra sao se ta the thi thoi trong tu va vao ve voi xuat""".split())))
# Words left out of generated keyword queries.
GENERIC_WORDS = tuple("các của cho được đang đây đó khi là một những này nó ra sẽ thì trong và về với video chúng ta".split())
TOKEN = r"[\p{L}\p{N}]+"
SENTENCE_BREAK = r"(?<=[.!?])\s+|\n+"


def _fold_table() -> tuple[str, str]:
    """Letters and digits with a one-character folded form (decomposed, lower case, without accents), by rule."""
    source, target = [], []
    for low, high in ((0xA0, 0x530), (0x1E00, 0x2000), (0x2070, 0x20A0), (0x2100, 0x2190), (0x2460, 0x24EA), (0xFF01, 0xFFE7)):
        for code in range(low, high):
            char = chr(code)
            folded = "".join(c for c in unicodedata.normalize("NFKD", char).casefold() if not unicodedata.combining(c)).replace("đ", "d")
            if len(folded) == 1 and folded != char:
                source.append(char)
                target.append(folded)
    return "".join(source), "".join(target)


FOLD_FROM, FOLD_TO = _fold_table()
#: Combining marks; translate() deletes what has no counterpart.
MARKS = "".join(chr(c) for low, high in ((0x300, 0x370), (0x483, 0x48A), (0x1AB0, 0x1B00), (0x1DC0, 0x1E00), (0x20D0, 0x2100), (0xFE20, 0xFE30)) for c in range(low, high) if unicodedata.category(chr(c))[0] == "M")


def fold(text: Column) -> Column:
    """Lower case without accents, widths and compatibility forms; sharp s as ss, d with stroke as d."""
    return F.replace(F.translate(F.lower(text), FOLD_FROM + MARKS, FOLD_TO), F.lit("ß"), F.lit("ss"))


def tokens(text: Column) -> Column:
    """Maximal runs of letters and digits of the folded text; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(fold(text), F.lit(f"({TOKEN})")), F.array().cast("array<string>"))


def search_key(text: Column) -> Column:
    """The folded tokens joined by single blanks."""
    return F.array_join(tokens(text), " ")


def index_terms(text: Column) -> Column:
    """The tokens of two characters or more that are no stopwords, in text order with repetitions."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    return F.filter(tokens(text), lambda t: (F.length(t) >= 2) & ~F.array_contains(stop, t))


def query_terms(text: Column) -> Column:
    """Terms of a full-text query: distinct index terms, or every token where nothing but stopwords is left."""
    terms = F.array_distinct(index_terms(text))
    return F.when(F.size(terms) > 0, terms).otherwise(F.array_distinct(tokens(text)))


def normalized_key(text: Column) -> Column:
    """Lower-case letters and digits only, accents kept, full-width forms as plain ones."""
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
    plain = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))
    return F.regexp_replace(F.lower(F.translate(text, wide, plain)), r"[^\p{L}\p{N}]", "")


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition; Spark has no Unicode normalisation."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(T.StringType())
def unescape_html(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else html.unescape(t))


def normalize_text(text: Column) -> Column:
    """HTML entities, tags, byte-order marks and blanks cleaned; composed form. Python sees only texts that need it."""
    bare = F.regexp_replace(text, "﻿", " ")
    bare = F.coalesce(unescape_html(F.when(F.contains(bare, F.lit("&")), bare)), bare)
    bare = F.regexp_replace(bare, "<[^>]+>", " ")
    bare = F.coalesce(nfc(F.when(bare.rlike(r"\p{M}"), bare)), bare)
    return F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))


# Character pairs that betray UTF-8 read as a single-byte encoding.
MOJIBAKE_MARKERS = ("Ã", "Â", "Æ", "Ä", "áº", "á»", "â€")


@F.pandas_udf(T.StringType())
def _latin1_round_trip(text: pd.Series) -> pd.Series:
    def back(t: str | None) -> str | None:
        try:
            return None if t is None else t.encode("latin-1").decode("utf-8")
        except UnicodeError:
            return None

    return text.map(back)


def repair_mojibake(text: Column) -> Column:
    """UTF-8 read as Latin-1 read back, where that is possible for the whole text and leaves fewer markers."""
    count = lambda c: sum((F.size(F.split(c, re.escape(m))) - 1 for m in MOJIBAKE_MARKERS), F.lit(0))
    back = _latin1_round_trip(F.when(text.rlike("|".join(MOJIBAKE_MARKERS)), text))
    return F.when(back.isNotNull() & (count(back) < count(text)), back).otherwise(text)


def clean_text(text: Column, repair: bool = True) -> Column:
    return normalize_text(repair_mojibake(text) if repair else text)


def first_by_key(items: Column, key) -> Column:
    """The items whose key is not empty and did not occur before, in their order."""
    keyed = F.filter(F.transform(items, lambda x: F.struct(key(x).alias("k"), x.alias("v"))), lambda p: F.length(p["k"]) > 0)
    keys = F.transform(keyed, lambda p: p["k"])
    return F.transform(F.filter(F.transform(keyed, lambda p, i: F.struct(p["k"].alias("k"), p["v"].alias("v"), i.alias("i"))), lambda p: F.array_position(keys, p["k"]) == p["i"] + 1), lambda p: p["v"])


def timestamp_seconds(text: Column) -> Column:
    """``HH:MM:SS,mmm`` as seconds."""
    part = F.split(F.replace(text, F.lit(","), F.lit(".")), ":")
    at = lambda i: F.try_element_at(part, F.lit(i)).try_cast("double")
    return at(1) * 3600 + at(2) * 60 + at(3)


def subtitle_language(path: Column) -> Column:
    """What stands between the first point of the file name and its suffix, else ``unknown``."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/\\]+)$", 1), r"\.[^.]*$", "")
    return F.when(F.contains(stem, F.lit(".")), F.regexp_extract(stem, r"^[^.]*\.(.*)$", 1)).otherwise("unknown")


def watch_url(video_id: Column, seconds: Column) -> Column:
    return F.format_string("https://www.youtube.com/watch?v=%s&t=%ds", video_id, F.greatest(F.bround(seconds), F.lit(0)).cast("bigint"))


def snippet(text: Column, width: int = 320) -> Column:
    """A passage without its field labels, at most ``width`` characters."""
    return F.substring(F.regexp_replace(F.regexp_replace(text, r"(?:LOCAL )?SUBTITLE: |OCR: ", ""), r"\s+", " "), 1, width)


def sentences(text: Column) -> Column:
    """Sentences with single blanks, split after full stops and at newlines."""
    return F.transform(F.split(text, SENTENCE_BREAK), lambda s: F.trim(F.regexp_replace(s, r"\s+", " ")))


def raw_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({TOKEN})")), F.array().cast("array<string>"))


def choose_sentence(text: Column) -> Column:
    """The sentence of 7 to 35 tokens with most distinct ones, the first of equal ones; the whole text if there is none."""
    scored = F.transform(sentences(text), lambda s, i: F.struct(F.size(F.array_distinct(F.transform(raw_tokens(s), F.lower))).alias("n"), (-i).alias("i"), s.alias("s"), F.size(raw_tokens(s)).alias("t")))
    best = F.array_max(F.filter(scored, lambda x: x["t"].between(7, 35)))
    return F.coalesce(best["s"], F.trim(F.regexp_replace(text, r"\s+", " ")))


def hashing_embedding(dimension: int):
    """A pandas UDF for the deterministic hashing embedding of tokens and neighbouring pairs (BLAKE2b is not in Spark)."""
    word = re.compile(r"[^\W_]+")

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(text: pd.Series) -> pd.Series:
        def one(t: str | None):
            if t is None:
                return None
            words = word.findall(unicodedata.normalize("NFKC", t).casefold())
            vector = np.zeros(dimension, dtype=np.float32)
            for feature in [*words, *map("_".join, zip(words, words[1:]))]:
                digest = hashlib.blake2b(feature.encode(), digest_size=8).digest()
                vector[int.from_bytes(digest[:4], "little") % dimension] += 1.0 if digest[4] & 1 else -1.0
            norm = float(np.linalg.norm(vector))
            return vector / norm if norm else vector

        return text.map(one)

    return embed


def prepared_document(document_id: Column, text: Column, provider: str) -> Column:
    return F.concat(F.lit("search_document: "), text) if provider == "ollama" else F.concat(F.lit("title: "), document_id, F.lit(" | text: "), text)


def prepared_query(text: Column, provider: str) -> Column:
    return F.concat(F.lit("search_query: " if provider == "ollama" else "task: search result | query: "), text)


def chunks_by_length(items: Column, limit: int, joiner: str = " ") -> Column:
    """Neighbouring texts joined greedily while they stay within ``limit`` characters; a longer text stands alone."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def add(acc: Column, item: Column) -> Column:
        fits = acc["open"].isNotNull() & (F.length(acc["open"]) + len(joiner) + F.length(item) <= limit)
        closed = F.when(acc["open"].isNull() | fits, acc["done"]).otherwise(F.array_append(acc["done"], acc["open"]))
        return F.struct(closed.alias("done"), F.when(fits, F.concat(acc["open"], F.lit(joiner), item)).otherwise(item).alias("open"))

    end = F.aggregate(items, start, add)
    return F.when(end["open"].isNull(), end["done"]).otherwise(F.array_append(end["done"], end["open"]))
