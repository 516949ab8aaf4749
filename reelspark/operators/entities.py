"""Entities: rules, aliases, canonical forms and entity search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark.functions import text as X
from reelspark.operators.lexical import ranked

# Words before a name that tell its type, in order of preference.
PREFIXES = {
    "PERSON": ("ông ", "bà ", "anh ", "chị ", "nhà thơ ", "ca sĩ ", "diễn viên ", "tiến sĩ "),
    "ORG": ("công ty ", "tập đoàn ", "đại học ", "trường ", "đài ", "bộ ", "ủy ban ", "ngân hàng "),
    "LOCATION": ("thành phố ", "tỉnh ", "quận ", "huyện ", "xã ", "phường ", "nước ", "đảo "),
}
# Capitalised phrases that are no entities, and organisations known by one word.
PHRASES = frozenset(("thưa quý", "quý vị", "các bạn", "chúng ta", "hiện nay", "tuy nhiên", "trong đó", "sau đó", "đây là", "điều này", "video này", "hôm nay", "vì vậy", "ngoài ra"))
KNOWN_ORGS = frozenset("anthropic openai google microsoft facebook meta nvidia openbsd youtube gemini claude chatgpt vtv bbc cnn".split())
EMAIL = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
URL = r"(?i)https?://\S+"
ACRONYM = r"\b[A-ZĐ][A-ZĐ0-9._-]+\b"
LONGEST_RUN = 6
# Where the city is named, the name of the person that it is called after is not the person.
SUPPRESSED = (("thanh pho ho chi minh", "LOCATION", "ho chi minh"),)

# A word of letters, also joined by hyphens or apostrophes, whose first letter alone need be a capital (not all of them are);
# or a known organisation however written; neighbours with nothing but blanks between them make a name.
_LETTERS = r"\p{L}+(?:[-']\p{L}+)*"
_CAPITALISED = r"(?=[\p{L}'-]*[\p{Ll}\p{Lo}])\p{Lu}\p{L}*(?:[-']\p{L}+)*"
_NAME = rf"(?:{_CAPITALISED}|(?i:{'|'.join(sorted(KNOWN_ORGS))})(?![-']?\p{{L}}))"
RUN = rf"(?U)(?<!\p{{L}})(?<!\p{{L}}[-']){_NAME}(?:\s+{_NAME})*"


def _found(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({pattern})")), F.array().cast("array<string>"))


def pattern_entities(docs: DataFrame, text: str, pattern: str, kind: str, id: str = "document_id") -> DataFrame:
    """``id, entity_text, entity_type`` of a pattern's matches, each once in a document; letters of all scripts bound words."""
    found = F.explode(F.array_distinct(_found(F.col(text), "(?U)" + pattern)))
    return docs.select(id, found.alias("entity_text")).withColumn("entity_type", F.lit(kind))


def entity_type(name: Column, context: Column) -> Column:
    """The type that a word before the name tells (``context`` is the lower-case text), else ORG for a known organisation or
    a short name in capitals, else MISC."""
    low = F.lower(name)
    told = F.lit(None).cast("string")
    for kind, prefixes in reversed(PREFIXES.items()):
        told = F.when(reduce(lambda a, b: a | b, [F.contains(context, F.concat(F.lit(p), low)) for p in prefixes]), kind).otherwise(told)
    capitals = (F.length(name) <= 12) & (F.upper(name) == name) & (low != name)
    return F.coalesce(told, F.when(low.isin(*KNOWN_ORGS) | capitals, "ORG").otherwise("MISC"))


def rule_entities(docs: DataFrame, text: str = "combined_text", id: str = "document_id") -> DataFrame:
    """``id, ordinal, entity_text, entity_type, source, score`` of the rule entities of whole texts, within the JVM.

    In the order of the rules: addresses of mail and of pages, words in capitals, runs of capitalised words (their first six
    words; a single one only if it is a known organisation, and no stock phrases). Of equal names of one type the first counts.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    context = F.lower(t)
    typed = lambda kind: lambda x: F.struct(x.alias("name"), F.lit(kind).alias("kind"))
    named = lambda x: F.struct(x.alias("name"), entity_type(x, F.col("__context")).alias("kind"))
    runs = F.transform(_found(t, RUN), lambda r: F.array_join(F.slice(F.split(trimmed_entity(r), " "), 1, LONGEST_RUN), " "))
    runs = F.filter(runs, lambda r: ~F.lower(r).isin(*PHRASES) & (F.contains(r, F.lit(" ")) | F.lower(r).isin(*KNOWN_ORGS)))
    rows = docs.select(id, context.alias("__context"), _found(t, "(?U)" + EMAIL).alias("__mail"), F.transform(_found(t, URL), lambda u: F.regexp_replace(u, "[.,;]+$", "")).alias("__page"),
                       F.concat(_found(t, "(?U)" + ACRONYM), runs).alias("__names"))
    every = F.concat(F.transform("__mail", typed("EMAIL")), F.transform("__page", typed("URL")), F.transform("__names", named))
    every = F.filter(F.transform(every, lambda e: F.struct(trimmed_entity(e["name"]).alias("name"), e["kind"].alias("kind"))), lambda e: F.length(e["name"]) >= 2)
    once = X.first_by_key(every, lambda e: F.concat(F.lower(e["name"]), F.lit("\n"), e["kind"]))
    out = rows.select(id, F.posexplode(once).alias("ordinal", "e"))
    return out.select(id, "ordinal", F.col("e.name").alias("entity_text"), F.col("e.kind").alias("entity_type"), F.lit("rules").alias("source"), F.lit(None).cast("double").alias("score"))


def trimmed_entity(value: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(value, r"\s+", " "), r"""^[ .,:;!?()\[\]{}"']+|[ .,:;!?()\[\]{}"']+$""", ""))


def alias_dimension(records: DataFrame) -> DataFrame:
    """``canonical, canonical_key, entity_type, alias, alias_key`` from ``canonical, type, aliases``.

    Names are trimmed, the canonical name is an alias of its own, types are upper-case (missing: MISC), empty names and
    repetitions are dropped.
    """
    names = F.concat(F.array("canonical"), F.coalesce("aliases", F.array().cast("array<string>")))
    out = records.select(trimmed_entity(F.col("canonical")).alias("canonical"), F.coalesce(F.upper(F.trim("type")), F.lit("MISC")).alias("entity_type"), F.explode(names).alias("raw"))
    out = out.select("canonical", X.search_key(F.col("canonical")).alias("canonical_key"), "entity_type", trimmed_entity(F.col("raw")).alias("alias"))
    out = out.withColumn("alias_key", X.search_key(F.col("alias")))
    return out.filter("canonical_key <> '' and alias_key <> ''").distinct()


def alias_hits(docs: DataFrame, aliases: DataFrame, text: str = "combined_text", id: str = "document_id", longest: int = 2) -> DataFrame:
    """``id, canonical, canonical_key, entity_type, alias, alias_key`` of aliases that occur as whole words in a text.

    The containment join as an equi-join on an alias's first ``longest`` words (all of a shorter one): what a text offers are
    its runs of up to so many words, and only those that begin some alias go on; longer aliases are then compared with the
    words that follow the place. An alias's length does not matter.
    """
    words_of = F.split("alias_key", " ")
    dim = aliases.withColumn("n", F.size(words_of)).withColumn("first", F.array_join(F.slice(words_of, 1, longest), " "))
    tokens = docs.select(id, X.tokens(F.col(text)).alias("t")).filter("size(t) > 0")
    runs = lambda n: F.transform("t", lambda _, i: F.struct(F.when(i + n <= F.size("t"), F.array_join(F.slice("t", i + 1, n), " ")).alias("first"), i.alias("at")))
    starts = F.concat(*[runs(n) for n in range(1, longest + 1)])
    # one row for each beginning of an alias, with the number of words that the longest alias of that beginning needs
    begins = dim.groupBy("first").agg(F.max("n").alias("longest"))
    met = tokens.select(id, "t", F.explode(starts).alias("s")).filter("s.first is not null").select(id, "s.first", "s.at", "t").join(begins, "first")
    met = met.select(id, "first", F.array_join(F.slice("t", F.col("at") + 1, F.col("longest")), " ").alias("here")).distinct()
    hits = met.join(dim, "first").filter(F.startswith(F.concat("here", F.lit(" ")), F.concat("alias_key", F.lit(" "))))
    return hits.select(id, "canonical", "canonical_key", "entity_type", "alias", "alias_key").distinct()


def canonicalize(entities: DataFrame, aliases: DataFrame, id: str = "document_id") -> DataFrame:
    """``id, canonical, canonical_key, entity_type, matched_text, source, score``: alias names of the same type replace an entity.

    An entity without such an alias stays as it is. Of entities with one canonical key and type in a document the first
    (by ``ordinal``, then name) is kept.
    """
    e = entities.withColumn("alias_key", X.search_key(F.col("entity_text")))
    named = e.join(aliases.select("alias_key", "entity_type", "canonical").distinct(), ["alias_key", "entity_type"], "left").withColumn("canonical", F.coalesce("canonical", "entity_text"))
    named = named.withColumn("canonical_key", X.search_key(F.col("canonical")))
    first = F.row_number().over(Window.partitionBy(id, "canonical_key", "entity_type").orderBy("ordinal", "canonical", "entity_text"))
    return named.withColumn("n", first).filter("n = 1").select(id, "canonical", "canonical_key", "entity_type", F.col("entity_text").alias("matched_text"), "source", "score")


def document_entities(docs: DataFrame, aliases: DataFrame, text: str = "combined_text", id: str = "document_id", suppress: DataFrame | None = None, listed: DataFrame | None = None) -> DataFrame:
    """Rule entities, ``listed`` ones (see :func:`listed_entities`) and alias hits of each text in canonical form.

    ``suppress`` has ``winner_key, winner_type, loser_key``: where the winner is present, entities of the loser's key and
    another type are dropped (a city named after a person, say).
    """
    hits = alias_hits(docs, aliases, text, id).select(id, F.lit(1_000_000).alias("ordinal"), F.col("alias").alias("entity_text"), "entity_type", F.lit("alias").alias("source"), F.lit(1.0).alias("score"))
    found = rule_entities(docs, text, id)
    if listed is not None:
        found = found.unionByName(listed.withColumn("ordinal", F.col("ordinal") + 500_000))
    out = canonicalize(found.unionByName(hits), aliases, id)
    if suppress is not None:
        winners = out.join(suppress, (out.canonical_key == suppress.winner_key) & (out.entity_type == suppress.winner_type)).select(id, F.col("loser_key").alias("canonical_key"), F.col("winner_type").alias("kept"))
        out = out.join(winners.distinct(), [id, "canonical_key"], "left").filter("kept is null or entity_type = kept").drop("kept")
    return out


def listed_entities(docs: DataFrame, id: str = "document_id") -> DataFrame:
    """``id, ordinal, entity_text, entity_type, source, score`` of the entities that a document lists (a model's finds)."""
    e = docs.select(id, F.posexplode("entities").alias("ordinal", "e"))
    return e.select(id, "ordinal", F.col("e.text").alias("entity_text"), F.upper("e.type").alias("entity_type"), F.lit("model").alias("source"), F.lit(0.9).alias("score")).filter("length(entity_text) >= 2")


def suppressed(spark: SparkSession) -> DataFrame:
    """The rows of :data:`SUPPRESSED` for :func:`document_entities`."""
    return spark.createDataFrame(list(SUPPRESSED), "winner_key string, winner_type string, loser_key string")


def query_entity_keys(queries: DataFrame, aliases: DataFrame) -> DataFrame:
    """``query_id, canonical_key``: aliases contained in the query; and its rule entities, by alias or, from two words on, as they are."""
    hits = alias_hits(queries, aliases, "query", "query_id").select("query_id", "canonical_key")
    own = rule_entities(queries, "query", "query_id").withColumn("alias_key", X.search_key(F.col("entity_text")))
    matched = own.join(aliases.select("alias_key", "canonical_key").distinct(), "alias_key", "left")
    raw = matched.filter("canonical_key is null and alias_key like '% %'").select("query_id", F.col("alias_key").alias("canonical_key"))
    return hits.unionByName(matched.filter("canonical_key is not null").select("query_id", "canonical_key")).unionByName(raw).filter("canonical_key <> ''").distinct()


def entity_search(entities: DataFrame, docs: DataFrame, keys: DataFrame, limit: int = 50, id: str = "document_id", text: str = "combined_text") -> DataFrame:
    """``query_id, id, entity_score, entity_overlap, entity_rank``: distinct matched keys + confidence / 10.

    ``keys`` has ``query_id, canonical_key``. A missing confidence counts 0.5; entities of unknown documents are dropped;
    ties go to the longer text, then to the id.
    """
    met = entities.join(keys, "canonical_key").groupBy("query_id", id).agg(F.countDistinct("canonical_key").alias("matched"), F.max(F.coalesce("score", F.lit(0.5))).alias("confidence"))
    met = met.join(docs.select(id, F.coalesce(F.length(text), F.lit(0)).alias("size")), id)
    out = ranked(met, [F.desc("matched"), F.desc("confidence"), F.desc("size"), id], limit, "entity_rank")
    return out.select("query_id", id, (F.col("matched") + F.col("confidence") / 10).alias("entity_score"), F.col("matched").alias("entity_overlap"), "entity_rank")
