"""Problem 1: variant spellings of names, linked by canonical rewritings.

Every name is rewritten by rules - accents and case, joined words, word order, titles, nicknames, initials, legal forms,
abbreviations, acronyms, and a lost letter or word on either side, which covers typing errors - and names that share a
rewriting are met by an equi-join. A rewriting counts by its rarity: one that few rows produce says much, one that many
produce says little. What meets is compared word by word, and a name goes to the one entity that it is nearest to.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelspark.session import materialize

# --- fixed values ---------------------------------------------------------------------------------------------------

#: Given names with their nicknames.
_NICKNAMES = """alexander: alex sandy al lex xander; anthony: tony ant; benjamin: ben benny; charles: charlie chuck chas; christopher: chris kit; daniel: dan danny;
david: dave davy; deborah: deb debbie debby; dorothy: dot dolly dottie dora; edward: ed eddie ted ned teddy; elizabeth: liz beth betty lizzie eliza bess lisa betsy;
frederick: fred freddie freddy; gabriel: gabe gab; gerald: gerry jerry; gregory: greg; henry: harry hank hal; james: jim jimmy jamie; jennifer: jen jenny jenn;
john: jack johnny; joseph: joe joey jo; katherine: kathy kate katie kat kitty; lawrence: larry laurie lars; margaret: maggie peggy meg marge madge; matthew: matt; michael: mike mick mickey;
nicholas: nick nicky; patricia: pat patty trish tricia; peter: pete; philip: phil; rebecca: becky becca bec; richard: rick dick rich ricky richie; robert: bob rob bobby robbie bert;
ronald: ron; samuel: sam sammy; stephen: steve; susan: sue susie suzy; theodore: theo ted teddy; thomas: tom tommy; timothy: tim; victoria: vicky vicki tori; walter: walt;
william: bill will billy willy; zachary: zach zack zak"""
#: Abbreviations of words, and of Vietnamese phrases in full.
_SHORT = """corp: corporation; inc: incorporated; ltd: limited; co: company; inst: institute; fdn: foundation; found: foundation; grp: group; svc: service; sys: systems; res: research; lab: laboratory; labs: laboratory;
univ: university; intl: international; assn: association; dept: department; mfg: manufacturing; st: saint; mt: mount; htx: hop tac xa; ctcp: cong ty co phan; cty: cong ty; tnhh: trach nhiem huu han;
dh: truong dai hoc; tp: thanh pho; tt: thi tran; tx: thi xa; th: truyen hinh; q: quan; h: huyen"""
_TITLES = frozenset("mr mrs ms miss dr prof professor sir madam capt captain mx rev hon ong ba anh chi co chu bac thay ts gs ths pgs nsut nsnd monsieur madame mme mlle senhor senhora sr sra dona".split())
_TITLE_PAIRS = frozenset({("nha", "bao"), ("bac", "si"), ("nghe", "si"), ("giao", "su"), ("ca", "si")})
_LEGAL = frozenset("incorporated limited corporation company foundation institute group association holdings llc plc gmbh sa".split())
_OPTIONAL = frozenset("the of and huyen de du la le".split())


def _table(text: str) -> dict[str, tuple[str, ...]]:
    out: dict[str, tuple[str, ...]] = {}
    for entry in text.replace("\n", " ").split(";"):
        full, _, shorts = entry.partition(":")
        for short in shorts.split():
            out[short] = (*out.get(short, ()), full.strip())
    return out


_FULL_GIVEN = _table(_NICKNAMES)
_NICKS_OF = {full.strip(): tuple(shorts.split()) for full, _, shorts in (e.partition(":") for e in _NICKNAMES.replace("\n", " ").split(";"))}
_EXPAND = {short.strip(): tuple(full.split()) for short, _, full in (e.partition(":") for e in _SHORT.replace("\n", " ").split(";"))}

# --- names into words -----------------------------------------------------------------------------------------------


#: Of longer names the forms without two words would be too many: such names meet by parts of their words, see :func:`_parts`.
_MANY_WORDS = 24
#: Of longer words written as one the forms without two letters would be too many: they meet by halves, see :func:`_halves`.
_MANY_LETTERS = 60


def fold(text: str) -> str:
    """Lower case without accents; the letter d with stroke as d."""
    text = unicodedata.normalize("NFKD", text.replace("Đ", "D").replace("đ", "d")).casefold()
    return "".join(c for c in text if not unicodedata.combining(c))


@lru_cache(maxsize=100_000)
def parse(name: str) -> tuple[tuple[str, ...], str]:
    """(words, acronym): the folded words without titles, abbreviations written out; letters of an acronym, if the name is one."""
    name = unicodedata.normalize("NFC", name).strip()
    dotted = re.fullmatch(r"(?:\w\.){3,}\w?\.?", name)
    solid = re.fullmatch(r"[^\W\d_a-z]{3,12}", name) and name.isupper()
    acronym = fold(re.sub(r"\W", "", name)) if dotted or solid else ""
    name = re.sub(r"(?<=[^\W\d_])(?<![A-ZÀ-ÞĐĨŨƠƯ])(?=[A-ZÀ-ÞĐ])(?<=[^\s])", " ", name) if " " not in name and not name.isupper() else name
    words = [w for w in re.split(r"[^\w]+|_", fold(name)) if w]
    out: list[str] = []
    for w in words:
        out.extend(_EXPAND.get(w, (w,)) if len(words) > 1 else (w,))
    while len(out) > 2 and tuple(out[:2]) in _TITLE_PAIRS:
        out = out[2:]
    # a title stands in front, or behind a comma; two words at least must remain
    while len(out) > 2 and out[0] in _TITLES:
        out = out[1:]
    if len(out) > 3 and out[-1] in _TITLES:
        out = out[:-1]
    return tuple(out), acronym


def _lost(word: str) -> list[str]:
    """The word and every form of it that lacks one letter."""
    return [word] if len(word) < 3 else [word, *{word[:i] + word[i + 1 :] for i in range(len(word))}]


def _given(words: tuple[str, ...], listed: bool) -> list[tuple[str, ...]]:
    """The words of a name with nicknames written out in each way they can be; for a listed name also each given name as
    its nicknames, which may have been typed with an error. Names of more than four words take one such change at a time:
    two further words may be lost on either side."""
    ways = [(*(_FULL_GIVEN.get(w, ()) or (w,)), *(_NICKS_OF.get(w, ()) if listed else ())) for w in words]
    if len(words) <= 4:
        return list(itertools.product(*ways))
    plain = tuple(w[0] for w in ways)
    return [plain, *[(*words[:i], x, *words[i + 1 :]) for i, options in enumerate(ways) for x in options if x != words[i]]]


def _parts(core: tuple[str, ...]) -> list[str]:
    """The words of a long name in five parts by hash: two lost or altered words leave at least one part as it was."""
    parts: list[list[str]] = [[], [], [], [], []]
    for w in sorted(core):
        parts[xxhash.xxh32_intdigest(w) % 5].append(w)
    return [f"{i}:" + " ".join(p) for i, p in enumerate(parts) if p]


def _halves(solid: str) -> set[str]:
    """Forms of a long solid name by which two errors still leave one half with at most one of them."""
    out = set()
    for h in range(len(solid) // 2 - 1, len(solid) // 2 + 2):
        out.update("<" + x for x in _lost(solid[:h]))
        out.update(">" + x for x in _lost(solid[len(solid) - h :]))
    return out


def _hash(form: str) -> int:
    return xxhash.xxh64_intdigest(form) - (1 << 63)


#: Words that one spelling may have and another lack; :func:`name_cost` asks little for them.
_DROPPED = _LEGAL | _OPTIONAL


def _without(core: tuple[str, ...]) -> set[tuple[str, ...]]:
    """The forms of up to three words that are left of a name when words of _DROPPED are left out, each with and without
    the others; nothing where more than three other words remain, or no word but letters."""
    own = [i for i, w in enumerate(core) if w not in _DROPPED]
    may = [i for i, w in enumerate(core) if w in _DROPPED]
    out: set[tuple[str, ...]] = set()
    if len(own) <= 3:
        for n in range(min(len(may) - 1, 3 - len(own)) + 1):
            for kept in itertools.combinations(may, n):
                out.add(tuple(core[i] for i in sorted([*own, *kept])))
    return {c for c in out if any(len(w) > 1 for w in c)}


@lru_cache(maxsize=100_000)
def rewritings(name: str, listed: bool = False) -> frozenset[int]:
    """Hashes of every canonical rewriting of a name; of a ``listed`` one, an alias row's, those of its nicknames too."""
    words, acronym = parse(name)
    forms: set[str] = set()
    hashes: set[int] = set()
    if acronym:
        forms.add("@" + acronym)
    if not words:
        return frozenset()
    joined = "".join(words)
    for solid in {joined, "".join(sorted(words))}:  # for names written as one word
        forms.add("=" + solid)
        if len(solid) >= 3:  # hashed one by one: of a long text they would take the square of its length
            hashes.update(_hash("=" + solid[:i] + solid[i + 1 :]) for i in range(len(solid)))
    if len(words) <= 2 and len(joined) >= 6:  # one invented word takes two errors
        forms.update(_halves(joined) if len(joined) > _MANY_LETTERS else ("=" + b for a in _lost(joined) for b in _lost(a)))
    for way in {*_given(words, listed), words}:
        strong = tuple(w for w in way if len(w) > 1)
        cores = {way, strong} if len(strong) >= 2 else {way}
        for core in cores.union(*map(_without, cores)):
            if len(core) <= 3:
                options = [_lost(w) for w in core]
                for choice in itertools.product(*options):
                    if sum(a != b for a, b in zip(choice, core)) <= 2:
                        forms.add(" ".join(sorted(choice)))
                if 2 <= len(core) <= 3:
                    for keep in itertools.product((True, False), repeat=len(core)):
                        if any(keep) and not all(keep):
                            short = [w if k else w[0] for w, k in zip(core, keep)]
                            forms.add(" ".join(sorted(short)))
                            for i, k in enumerate(keep):
                                if k and len(core[i]) >= 3:
                                    forms.update(" ".join(sorted([*short[:i], less, *short[i + 1 :]])) for less in _lost(core[i])[1:])
            elif len(core) <= _MANY_WORDS:
                for gone in (0, 1, 2):
                    for left in itertools.combinations(core, len(core) - gone):
                        forms.add(" ".join(sorted(left)))
                if len(core) == 4:  # errors in three of four words: one word in full beside the others' initials
                    for whole in range(4):
                        forms.add(" ".join(sorted(w if i == whole else w[0] for i, w in enumerate(core))))
            else:
                forms.update([" ".join(sorted(core)), *_parts(core)])
        if len(words) >= 3:
            first = "".join(w[0] for w in words)
            forms.update({"@" + first, "@" + "".join(w[0] for w in words if w not in _LEGAL)} if not acronym else ())
    return frozenset(hashes.union(map(_hash, forms)))


# --- comparing two names --------------------------------------------------------------------------------------------


def _distance(a: str, b: str, most: int) -> int:
    """Edits of one letter, neighbours swapped counting one; ``most`` + 1 where there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now.append(d)
        if min(now) > most:
            return most + 1
        before, last = last, now
    return min(last[-1], most + 1)


_FAR = 9.0


def _word_cost(a: str, b: str, known: frozenset[str]) -> float:
    if a == b:
        return 0.0
    if a in _FULL_GIVEN or b in _FULL_GIVEN:
        if {*_FULL_GIVEN.get(a, (a,))} & {*_FULL_GIVEN.get(b, (b,))}:
            return 1.4 if max(len(_FULL_GIVEN.get(a, ())), len(_FULL_GIVEN.get(b, ()))) > 1 else 0.2
    if len(a) == 1 or len(b) == 1:
        return 0.8 if a[0] == b[0] else _FAR
    if a in known and b in known:
        return _FAR  # two words in common use are two words, however alike
    short, long_ = sorted((a, b), key=len)
    most = 1 if len(short) <= 4 else 2 if len(short) <= 9 else 3
    d = _distance(a, b, most)
    if d <= most:
        return d * (1.0 if len(short) > 3 else 1.3)
    if len(short) >= 3 and long_.startswith(short):
        return 0.7
    # a nickname or a given name with an error in it
    if any(_distance(x, y, 1) <= 1 for x in _FULL_GIVEN.get(a, (a,)) for y in _FULL_GIVEN.get(b, (b,))) and (a in _FULL_GIVEN or b in _FULL_GIVEN):
        return 1.2
    if any(len(nick) > 3 and _distance(x, nick, 1) <= 1 for x, y in ((a, b), (b, a)) for nick in _NICKS_OF.get(y, ())):
        return 1.2
    return _FAR


def name_cost(a: str, b: str, known: frozenset[str]) -> float:
    """How much must have happened for both names to be one entity's: 0 nothing, 1 an error, 9 and more: too much."""
    (wa, aa), (wb, ab) = parse(a), parse(b)
    if not wa or not wb:
        return _FAR
    if wa == wb:
        return 0.0
    if aa or ab:
        if aa and ab:
            return 0.0 if aa == ab else _FAR
        letters, words = (aa, wb) if aa else (ab, wa)
        if len(words) >= 3 and letters in ("".join(w[0] for w in words), "".join(w[0] for w in words if w not in _LEGAL)):
            return 1.0
    if len(wa) > len(wb):
        wa, wb = wb, wa
    pairs = sorted((c, i, j) for i, x in enumerate(wa) for j, y in enumerate(wb) if (c := _word_cost(x, y, known)) < _FAR)
    used_a, used_b, chosen = set(), set(), []
    for c, i, j in pairs:
        if i not in used_a and j not in used_b:
            used_a.add(i)
            used_b.add(j)
            chosen.append(c)
    cost = float(sum(chosen))
    full = sum(len(wa[i]) > 1 for i in used_a)
    letters = all(any(len(w) == 1 and k not in used for k, w in enumerate(ws)) for ws, used in ((wa, used_a), (wb, used_b)))
    rest = [w for k, w in enumerate(wa) if k not in used_a] + [w for k, w in enumerate(wb) if k not in used_b]
    both_legal = any(w in _LEGAL for k, w in enumerate(wa) if k not in used_a) and any(w in _LEGAL for k, w in enumerate(wb) if k not in used_b)
    for w in rest:
        cost += (1.5 if both_legal else 0.4) if w in _LEGAL else 0.3 if w in _OPTIONAL or w in _TITLES else (3.0 if letters else 0.5) if len(w) == 1 else 3.0
    if not full:
        cost = _FAR
    # four words and more that agree but for one letter each, and one of them in full
    if 2.3 < cost < _FAR and len(wa) == len(wb) == len(chosen) >= 4 and max(chosen) <= 1.0 and min(chosen) == 0:
        cost = 2.3
    ja, jb = "".join(wa), "".join(wb)
    if cost > 1 and min(len(ja), len(jb)) >= 6 and (len(wa) == 1 or len(wb) == 1 or len(wa) != len(wb)):
        for x in {ja, "".join(sorted(wa))}:
            d = _distance(x, jb if x == ja else "".join(sorted(wb)), 2)
            if d <= 2:
                cost = min(cost, float(d) + 0.1)
    return cost


#: Up to so many rewritings or names (some 100 bytes each) are sent to every executor.
MOST_SENT = 250_000

# --- linking ----------------------------------------------------------------------------------------------------------

def _forms(names: DataFrame, listed: bool = False) -> DataFrame:
    """``name, form`` for every rewriting of each distinct name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, forms = [], []
            for name in batch.column(0).to_pylist():
                for form in rewritings(name, listed):
                    keys.append(name)
                    forms.append(form)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(forms, pa.int64())], names=["name", "form"])

    # few short rows become many: as many parts as there are cores, whatever their size on disk
    spread = names.select("name").repartition(names.sparkSession.sparkContext.defaultParallelism, F.xxhash64("name"))
    return spread.mapInArrow(run, "name string, form bigint")


def _costs(pairs: DataFrame) -> DataFrame:
    """``a, b, known`` with ``cost``: the word-by-word comparison of names that met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, known = (c.to_pylist() for c in batch.columns)
            cost = [name_cost(x, y, frozenset(k or ())) for x, y, k in zip(a, b, known)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cost, pa.float64())], names=["a", "b", "cost"])

    spread = pairs.select("a", "b", "known").repartition(pairs.sparkSession.sparkContext.defaultParallelism, F.xxhash64("a", "b"))
    return spread.mapInArrow(run, "a string, b string, cost double")


def strong(name: str) -> bool:
    """True for names in which no word is a mere letter and which are no acronym: enough to tell two alias rows apart."""
    words, acronym = parse(name)
    return not acronym and bool(words) and all(len(w) > 1 for w in words)


def _words_of(names: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names_ = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([list(parse(n)[0]) for n in names_], pa.list_(pa.string())), pa.array([strong(n) for n in names_])], names=["name", "words", "strong"])

    return names.select("name").mapInArrow(run, "name string, words array<string>, strong boolean")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node is linked to; ``edges`` has ``a, b``.

    Each round takes the smallest label among the neighbours and then the label of that label, so the number of rounds
    grows with the logarithm of the longest chain; it ends when none changes. Every round is written to the shared folder.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    now = materialize(nodes.select("node", F.col("node").alias("root")), "roots")
    moved = True
    while moved:
        nearer = both.join(now, both.a == now.node).groupBy(F.col("b").alias("node")).agg(F.min("root").alias("near"))
        step = now.join(nearer, "node", "left").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        # the label of the label: a node's own label may have fallen in the same round
        jump = now.select(F.col("node").alias("root"), F.col("root").alias("further"))
        after = step.join(jump, "root", "left").select("node", F.least("root", "further").alias("root"), (F.least("root", "further") < F.col("was")).alias("moved"))
        after = materialize(after, "roots")
        moved = not after.filter("moved").isEmpty()
        now = after.select("node", "root")
    return now


def link_names(rows: DataFrame, mentions: DataFrame, *, most: float = 2.3, same_row: float = 1.3, apart: float = 0.25, common: int = 3, leading: float = 4.0, price: float = 2.3) -> DataFrame:
    """``entity, kind, id``: the records of each entity, rows (kind ``row``) and mentions' records (kind ``mention``).

    ``rows`` has ``id, name``, one line for each spelling of an alias row; ``mentions`` has ``id, name``. Rows are one
    entity if spellings of theirs cost at most ``same_row`` to turn into each other, directly or through other rows. A
    mention goes to the entity with the best score: the rarity of the rarest rewriting that they share, as the logarithm of
    how few entities' rows produce it, less ``price`` for each unit of cost. A rewriting of its own bears a cost of ``most``,
    a common one less. Where another entity comes within ``apart`` (in units of cost) the name may be either's, and it goes
    to the one that is mentioned ``leading`` times as often by names that can only be its own, and to none if neither is. Names with mere initials and
    acronyms do not make two rows one entity; a row that has no other names joins the one entity that it fits, if it is one.
    Words that ``common`` rows or more use are held to be different words however alike.

    Names are compared once for each distinct spelling, so a name that makes up a third of all mentions costs no more
    than a rare one. Null, empty and blank names are left out; repeated records come out once.
    """
    clean = lambda df: df.filter("id is not null and length(trim(name)) > 0").select("id", F.trim("name").alias("name")).distinct()
    rows, mentions = materialize(clean(rows), "rows"), clean(mentions)
    alias_names = rows.select("name").distinct()
    typed = materialize(mentions.groupBy("name").agg(F.count(F.lit(1)).alias("n")), "typed")
    names = typed.select("name").unionByName(alias_names).distinct()
    # words in common use, by alias rows
    parsed = materialize(_words_of(names), "words")
    used = parsed.join(rows, "name").select("id", F.explode("words").alias("word")).distinct().groupBy("word").count().filter(F.col("count") >= common)
    known = parsed.select("name", F.explode("words").alias("word")).join(used, "word").groupBy("name").agg(F.collect_set("word").alias("known"))
    # the equi-join on rewritings; a rewriting is the rarer, the fewer alias rows produce it
    alias_forms = materialize(_forms(alias_names, listed=True), "alias-forms")
    spread = alias_forms.join(rows, "name").groupBy("form").agg(F.countDistinct("id").alias("rows"))
    rare = spread.select("form", (-F.log("rows")).alias("rarity"))
    # the rewritings of the alias rows are broadcast only if they are few; what grows with the mentions never is
    small = alias_forms.count() <= MOST_SENT
    sent = (lambda df: F.broadcast(df)) if small else (lambda df: df.hint("merge"))
    met = (
        _forms(names).withColumnRenamed("name", "a").join(sent(alias_forms.withColumnRenamed("name", "b").join(rare.hint("merge"), "form")), "form")
        .groupBy("a", "b").agg(F.max("rarity").alias("rarity"), F.max_by("form", F.struct("rarity", "form")).alias("form"))
    )
    k = known.withColumnRenamed("name", "b").withColumnRenamed("known", "kb")
    met = met.join(known.withColumnRenamed("name", "a").hint("merge"), "a", "left").join(k.hint("merge"), "b", "left").select("a", "b", "form", F.concat(F.coalesce("known", F.array().cast("array<string>")), F.coalesce("kb", F.array().cast("array<string>"))).alias("known"))
    met = materialize(met, "met")
    costs = materialize(_costs(met).filter(F.col("cost") <= most).join(met.select("a", "b", "form").hint("merge"), ["a", "b"]), "costs")

    # rows into entities
    telling = rows.join(parsed.filter("strong").select("name"), "name")
    ra, rb = telling.select(F.col("name").alias("a"), F.col("id").alias("ia")), telling.select(F.col("name").alias("b"), F.col("id").alias("ib"))
    near = costs.join(ra, "a").join(rb, "b").filter("ia < ib").groupBy("ia", "ib").agg(F.min("cost").alias("cost"))
    edges = near.filter(F.col("cost") <= same_row).select(F.col("ia").alias("a"), F.col("ib").alias("b"))
    entity = components(rows.select(F.col("id").alias("node")).distinct(), edges).select(F.col("node").alias("id"), F.col("root").alias("entity"))

    # rows of initials or an acronym only: to the one entity that they can be short for, if there is just one
    full_rows = telling.select("id").distinct()
    short = rows.join(full_rows, "id", "left_anti").select(F.col("name").alias("a"), F.col("id").alias("short"))
    full = rows.join(full_rows, "id", "left_semi").withColumnRenamed("name", "b").join(entity, "id").select("b", F.col("entity").alias("of"))
    fits = costs.join(short, "a").join(full, "b").groupBy("short", "of").agg(F.min("cost").alias("cost"))
    nearest = Window.partitionBy("short").orderBy("cost", "of")
    fits = fits.withColumn("n", F.row_number().over(nearest)).withColumn("second", F.lead("cost").over(nearest))
    fits = fits.filter((F.col("n") == 1) & (F.col("second").isNull() | (F.col("second") - F.col("cost") >= apart))).select(F.col("short").alias("id"), "of")
    entity = materialize(entity.join(fits, "id", "left").select("id", F.coalesce("of", "entity").alias("entity")), "entities")

    # each mentioned spelling to one entity, by the rarity of what they share less the price of the rewriting: a form that
    # two entities' rows produce says less than one that a single entity's rows produce, however many rows that has
    own_of = rows.join(entity, "id")
    produced = alias_forms.join(costs.select("form").distinct(), "form", "left_semi").join(own_of.select("name", "entity"), "name").groupBy("form").agg(F.countDistinct("entity").alias("entities"))
    to = costs.join(own_of.withColumnRenamed("name", "b"), "b").join(produced, "form")
    score = -F.log("entities") - price * F.col("cost")
    to = to.groupBy("a", "entity").agg(F.max(score).alias("score")).filter(F.col("score") >= -price * most - 1e-9)
    by = Window.partitionBy("a").orderBy(F.desc("score"), "entity")
    to = to.withColumn("place", F.row_number().over(by)).withColumn("next", F.lead("score").over(by))
    sure = F.col("next").isNull() | (F.col("score") - F.col("next") >= price * apart)
    to = to.withColumn("sure", F.first(sure).over(by)).withColumn("top", F.first("score").over(by))
    own = to.filter("sure and place = 1").select(F.col("a").alias("name"), "entity")
    often = own.join(typed, "name").groupBy("entity").agg(F.sum("n").alias("often"))
    either = to.filter(~F.col("sure") & (F.col("top") - F.col("score") < price * apart)).join(often, "entity", "left").withColumn("often", F.coalesce("often", F.lit(0)))
    lead = Window.partitionBy("a").orderBy(F.desc("often"), "entity")
    either = either.withColumn("place", F.row_number().over(lead)).withColumn("second", F.lead("often").over(lead))
    led = either.filter((F.col("place") == 1) & (F.col("often") >= leading * F.greatest("second", F.lit(1)))).select(F.col("a").alias("name"), "entity")
    best = materialize(own.unionByName(led), "best")
    best = F.broadcast(best) if best.count() <= MOST_SENT else best.hint("merge")
    found = mentions.join(best, "name").select("entity", F.lit("mention").alias("kind"), "id").distinct()
    return entity.select("entity", F.lit("row").alias("kind"), "id").unionByName(found)


def linked_pairs(linked: DataFrame) -> DataFrame:
    """``id_a, id_b``: an alias row with every other record of its entity, each pair once, the smaller id first."""
    # an entity that a third of all documents name: its records are cut into salts, its few rows stand in each
    salts = 16
    rows = linked.filter("kind = 'row'").select("entity", F.col("id").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    others = linked.select("entity", F.col("id").alias("y"), F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"))
    pairs = rows.join(others, ["entity", "salt"]).filter("x <> y")
    return pairs.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()
