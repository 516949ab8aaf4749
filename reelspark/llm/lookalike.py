"""Problem 5: texts that look the same in one form: look-alike mapping, then accent-sensitive Unicode collation."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.session import materialize

#: ICU root collation at its default strength: it tells accents, case and digits apart, not invisible or canonically equal characters.
COLLATION = "UNICODE"

# Letters of one script that look like a letter of another, each with its Latin twin in the same place.
_CYRILLIC = ("асеорхуѕіјһԁԛԝѵӏАВЕКМНОРСТХУІЈЅҮԌԚԜ", "aceopxysijhdqwvlABEKMHOPCTXYIJSYGQW")
_GREEK = ("οναρΑΒΕΖΗΙΚΜΝΟΡΤΥΧϳ", "ovapABEZHIKMNOPTYXj")
_OTHER = ("ÐƉɑɡıꓲ", "ĐĐagiI")
_ARMENIAN_AND_CHEROKEE = ("ՕօՍոսցհՏᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏚᎢᏙᎳᏃᏀ", "OoUnughSABCDEHJKLMPSTVWZG")
_SMALL = ("ᴄᴏᴠᴡᴢ", "covwz")
_BLANKS = "               　\t"
_INVISIBLE = "­͏؜ᅟᅠ឴឵᠋᠌᠍᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩︀︁︂︎️﻿"


def _single_letters() -> dict[str, str]:
    """Every one-to-one replacement, by rule: look-alikes, accented look-alikes, full-width and half-width forms, blanks."""
    out: dict[str, str] = {}
    for foreign, latin in (_CYRILLIC, _GREEK, _OTHER, _ARMENIAN_AND_CHEROKEE, _SMALL):
        out |= dict(zip(foreign, latin, strict=True))
    for code in [*range(0x370, 0x530), *range(0x1F00, 0x2000)]:  # accented Greek and Cyrillic: the twin of the base with the same accents
        char = chr(code)
        parts = unicodedata.normalize("NFD", char)
        if len(parts) > 1 and parts[0] in out:
            twin = unicodedata.normalize("NFC", out[parts[0]] + parts[1:])
            if len(twin) == 1:
                out[char] = twin
    for code in range(0xFF01, 0xFFE7):
        wide = unicodedata.normalize("NFKC", chr(code))
        if len(wide) == 1 and wide != chr(code):
            out[chr(code)] = out.get(wide, wide)
    for code in [*range(0x2100, 0x2189), *range(0x1D400, 0x1D800)]:  # letters and digits of another font, Roman numerals
        kind, _, plain = unicodedata.decomposition(chr(code)).partition(" ")
        letter = chr(int(plain, 16)) if kind in ("<font>", "<compat>") and plain and " " not in plain else ""
        if letter.isalnum():
            out[chr(code)] = out.get(letter, letter)
    out |= {c: " " for c in _BLANKS}
    return out


_LETTERS = _single_letters()
_FROM = "".join(_LETTERS) + _INVISIBLE  # translate() deletes what has no counterpart
_TO = "".join(_LETTERS.values())
#: Ligatures of letters look like the letters; marks that do not stand on their own need composing before comparison.
_NEEDS_COMPOSING = "[\\p{M}ﬀ-ﬆᄀ-ᇿ]"


@F.pandas_udf(T.StringType())
def _composed(text: pd.Series) -> pd.Series:
    def one(t: str | None) -> str | None:
        if t is None:
            return None
        for ligature in "ﬀﬁﬂﬃﬄﬅﬆ":
            if ligature in t:
                t = t.replace(ligature, unicodedata.normalize("NFKC", ligature))
        return unicodedata.normalize("NFC", t)

    return text.map(one)


def visible_form(text: Column) -> Column:
    """``text`` with look-alike letters, widths and blanks in one form and invisible characters gone.

    Runs in the JVM but for texts with combining marks or ligatures, the only ones that Python gets to compose.
    """
    plain = F.translate(text, _FROM, _TO)
    composed = F.coalesce(_composed(F.when(plain.rlike(_NEEDS_COMPOSING), plain)), plain)
    return F.trim(F.regexp_replace(F.regexp_replace(composed, " {2,}", " "), " ?(\r\n|\r|\n) ?", "\n"))


def _blocked(texts: DataFrame) -> DataFrame:
    """Rows with their visible form and a hash that is equal wherever the collation holds two forms equal.

    The collation tells letters and digits apart and ignores some characters altogether; a hash of the letters and digits
    alone is therefore coarser. It is what gets aggregated over all rows: grouping all of them under the collation itself
    would sort them by Unicode comparisons.
    """
    rows = texts.filter("id is not null and length(text) > 0").select("src", "id", "text", visible_form(F.col("text")).alias("look"))
    return rows.withColumn("block", F.xxhash64("src", F.lower(F.regexp_replace("look", r"[^\p{L}\p{N}]+", ""))))


def variant_classes(texts: DataFrame) -> DataFrame:
    """``src, id, text, class_id, canonical`` of each row whose class holds more than one spelling.

    ``texts`` has ``src, id, text``. A class is the rows of one ``src`` with equal visible form under the collation; its
    canonical member is the most frequent spelling, of equally frequent ones the smallest by code points. Rows whose text
    stands alone are their own canonical member and are not returned.

    Spellings are aggregated before the shuffle, so a phrase that makes up a third of all rows is a single row of it.
    Null and empty texts and null ids belong to no class. Repeated rows are separate members.
    """
    rows = _blocked(texts)
    # hashes, not texts: numbers are aggregated without sorting the rows
    several = rows.groupBy("block").agg(F.min(F.xxhash64("text")).alias("lo"), F.max(F.xxhash64("text")).alias("hi")).filter("lo <> hi").select("block")
    members = rows.join(several, "block", "left_semi").select("src", "id", "text", F.collate("look", COLLATION).alias("look"))
    members = materialize(members, "looks")
    spellings = members.groupBy("src", "look", "text").agg(F.count(F.lit(1)).alias("n"))
    canonical = spellings.groupBy("src", "look").agg(F.min_by("text", F.struct(-F.col("n"), "text")).alias("canonical"), F.count(F.lit(1)).alias("spellings"))
    classes = members.join(canonical.filter("spellings > 1"), ["src", "look"])
    return classes.select("src", "id", "text", F.xxhash64("src", "canonical").alias("class_id"), "canonical")


def consistent(texts: DataFrame) -> DataFrame:
    """Every row of ``texts`` (``src, id, text``) with ``canonical``, the spelling of its class; null and empty texts stay as they are."""
    changed = variant_classes(texts).filter("text <> canonical").select("src", "id", "canonical").dropDuplicates(["src", "id"])
    return texts.join(changed, ["src", "id"], "left").select("src", "id", "text", F.coalesce("canonical", "text").alias("canonical"))


def same_look_pairs(texts: DataFrame) -> DataFrame:
    """``src, id_a, id_b``: rows that look the same but are different strings, the smaller id first.

    Spellings are paired first, then each spelling's rows with those of its partner: equal rows, however many, meet no
    other row but those that the result names.
    """
    rows = materialize(variant_classes(texts).select("src", "class_id", F.xxhash64("text").alias("t"), "text", "id"), "variants")
    spellings = rows.select("src", "class_id", "t", "text").distinct()
    other = spellings.select("src", "class_id", F.col("t").alias("u"), F.col("text").alias("other"))
    differing = spellings.join(other, ["src", "class_id"]).filter("text < other").select("src", "class_id", "t", "u", "text", "other")
    left = rows.select("src", "class_id", "t", "text", F.col("id").alias("x"))
    right = rows.select("src", "class_id", F.col("t").alias("u"), F.col("text").alias("other"), F.col("id").alias("y"))
    pairs = differing.join(left, ["src", "class_id", "t", "text"]).join(right, ["src", "class_id", "u", "other"]).filter("x <> y")
    return pairs.select("src", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def variant_members(texts: DataFrame) -> DataFrame:
    """``src, id, class_id, spellings, rows``: one row for each row of a class of several spellings, with the class's size."""
    rows = variant_classes(texts)
    size = rows.groupBy("src", "class_id").agg(F.countDistinct("text").alias("spellings"), F.count(F.lit(1)).alias("rows"))
    return rows.select("src", "id", "class_id").join(size, ["src", "class_id"]).select("src", "id", "class_id", "spellings", "rows")
