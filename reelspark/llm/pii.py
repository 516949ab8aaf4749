"""Problem 9: personal information in free text, found and replaced by typed placeholders.

Email addresses, phone numbers, identity numbers and addresses have a form of their own and are found by grammar; numbers
that no form claims are judged by corpus co-occurrence, which learns from the claimed ones what a left word, a right word and a
shape of digits disclose. Names have no form: a run of capitalised words is protected where corpus co-occurrence says that its neighbours and its words
disclose a person. Every run's context and words get a weight of evidence (log likelihood ratio of standing with a
person rather than with anything else), estimated over all documents by expectation-maximisation from the PERSON
entities of the corpus and a few words that introduce persons or places; runs above the threshold are replaced.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.session import materialize

TYPES = ("EMAIL", "PHONE", "ID_NUMBER", "ADDRESS", "PERSON")

# --- fixed values: words of the languages at hand -----------------------------------------------------------------

#: Words that stand before a person's name.
PERSON_CUES = """mr mrs ms miss dr prof sir madam by named called ask_for name_is contact_person
ông bà anh chị cô chú bác cậu tên_là của_ông của_bà gặp_chị gặp_anh
monsieur madame mademoiselle m mme mlle demandez appelle
senhor senhora sr sra dona fale_com chamo
господин госпожа зовут входа спросите""".split()
#: Words that stand before or inside the name of a place, road, building, programme or group.
PLACE_CUES = """road street lane avenue ave square bay bridge pier port harbour lake cape island club choir stage festival show
đường phố ngõ cảng quận huyện xã phường thôn tỉnh đảo chợ cầu thành thị công trường viện đài chương
rue avenue place gare port quai impasse rua praça praia travessa barco ponte cidade de_são
улица ул площадь пер переулок город порт""".split()
#: Titles that may be caught at the beginning of a run of capitalised words, but are not part of the name.
TITLES = set("mr mrs ms miss dr prof sir madam capt monsieur madame mlle mme m ông bà anh chị cô chú senhor senhora dona sr sra господин госпожа".split())

_AT = r"(?: ?[@＠] ?| ?[\(\[\{] ?(?:at|a còng|arroba|собака|arobase) ?[\)\]\}] ?| (?:at|a còng|arroba|собака|arobase) )"
_DOT = r"(?:\.| ?[\(\[\{] ?(?:dot|chấm|ponto|точка|point|\.) ?[\)\]\}] ?| (?:dot|chấm|ponto|точка|point) )"
_EMAIL = rf"(?<![\w.+-])\w[\w.+%-]*{_AT}\w[\w-]*(?:{_DOT}\w[\w-]*)*{_DOT}[A-Za-z]{{2,24}}(?![\w@-])"

_DIGIT_WORDS = (
    "zero oh one two three four five six seven eight nine", "không một hai ba bốn năm sáu bảy tám chín", "zéro un deux trois quatre cinq six sept huit neuf",
    "zero um dois três quatro cinco seis meia sete oito nove", "ноль один два три четыре пять шесть семь восемь девять",
)
_SPOKEN = "|".join(rf"(?:(?:{'|'.join(words.split())})[ ,-]+){{6,}}(?:{'|'.join(words.split())})\b" for words in _DIGIT_WORDS)
_S = r"[ .-]"
_PHONE = "|".join((
    r"\(?\+\d{1,3}\)?(?:[ .-]{0,3}\(?\d{1,5}\)?){2,6}",  # international
    r"00[1-9]\d{9,12}",
    rf"\(\d{{3}}\) ?\d{{3}}{_S}\d{{4}}",  # three, three, four
    rf"(?:1{_S})?\d{{3}}{_S}\d{{3}}{_S}\d{{4}}",
    r"1[2-9]\d{9}",
    r"0\d{1,4}(?: - |[ .-])\d{6,8}",
    rf"0\d{{2,4}}{_S}\d{{3,4}}{_S}\d{{3,4}}",
    rf"0\d(?:{_S}\d\d){{4}}",  # pairs
    r"0\d{9,10}",
    r"\(\d{2}\) ?\d{4,5}[ -]\d{4}", r"\d{2} 9\d{4}[ -]\d{4}",
    r"8[ -]?\(?\d{3}\)?[ -]?\d{3}(?:[ -]?\d{2}){2}",
))
_PHONE = rf"(?<![\w+,$€.-])(?<!\d )(?:{_PHONE})(?![\w-]|[.,]\d| ?[%€$])"
#: Shorter numbers and those of other shapes are a phone number behind a word that says so.
_PHONE_CUES = frozenset("phone telephone tel mobile cell fax call dial whatsapp zalo gọi điện_thoại số_điện_thoại đt sđt téléphone portable appelez appeler telefone telemóvel celular ligue ligar телефон тел звоните позвоните".replace("_", " ").split()) - {"số", "điện"}

#: Numbers that are an identity number only next to a word that says so: the word before (or after) within one sentence.
_ID_BEFORE = (
    r"(?:\b(?:SSN|social security(?: number| no\.?)?|tax (?:file|number|id)|national id|identity (?:card|number)|id (?:card|number)|passport(?: no\.?| number)?|"
    r"CCCD|CMND|căn cước(?: công dân)?|định danh cá nhân|chứng minh nhân dân|giấy tờ tùy thân|hộ chiếu|mã số thuế|"
    r"sécurité sociale|passeport|carte d'identité|numéro fiscal|CPF|RG|NIF|passaporte|bilhete de identidade|cartão de cidadão|паспорт\w*|СНИЛС|ИНН|удостоверени\w+)"
    r"(?: lists| is| as| no\.?| number| số| nº| n°| numéro| número| номер| серия|:|№)*[ :]*)"
)
_ID_NUMBER = r"(?:[A-Z]{1,3} ?)?\d(?:[ .-]?\d){5,15}|[A-Z]{2} ?\d{6,8}|[A-Z][A-Z0-9]{7,9}"
_ID_CUED = rf"{_ID_BEFORE}(?P<id>{_ID_NUMBER})(?![\w])"
_ID_AFTER = r"(?<![\w.-])(?P<id2>\d{3}[ -]?\d{2}[ -]?\d{4})(?= (?:as|is|for) (?:the|his|her|my|their) (?:SSN|social security|tax))"
_ID_SHAPE = r"(?<![\w.-])(?P<id3>\d{3}\.\d{3}\.\d{3}-\d{2}|[12] \d{2} (?:0\d|1[0-2]) \d{2} \d{3} \d{3}(?: \d{2})?)(?![\w-])"

_U = "".join(c for c in map(chr, range(0x41, 0x250)) if c.isupper()) + "".join(c for c in map(chr, range(0x1E00, 0x1F00)) if c.isupper()) + "А-ЯЁ"
_NAME = rf"[{_U}][\w'’-]*"
_NAMES = rf"{_NAME}(?: {_NAME}){{0,4}}"
_ADDRESS = "|".join((
    rf"(?:[Ss]ố nhà|[Ss]ố) \d+\w?(?:/\d+)*,? (?:(?:ngõ|ngách|hẻm|kiệt) \d+(?:/\d+)*,? )*(?:phố|đường|Đ\.) {_NAMES}(?:, (?:phường|xã|P\.) ?(?:\d+|{_NAMES}))?(?:, (?:quận|huyện|Q\.|TP\.?) ?(?:\d+|{_NAMES}))?",
    rf"\d+\w?(?:/\d+)* (?:phố|đường|Đ\.|ngõ) {_NAMES}(?:, (?:phường|xã|P\.) ?(?:\d+|{_NAMES}))?(?:, (?:quận|huyện|Q\.|TP\.?) ?(?:\d+|{_NAMES}))?",
    rf"(?:thôn|ấp|xóm|tổ|Thôn) (?:\d+|{_NAMES}), (?:xã|phường|thị trấn) {_NAMES}(?:, (?:huyện|quận|thị xã) {_NAMES})?(?:, (?:tỉnh|thành phố) {_NAMES})?",
    rf"(?:(?:Flat|Apt\.?|Unit|Suite) \d+\w?, )?\d+\w? {_NAME}(?: {_NAME}){{0,2}} (?:Road|Street|Lane|Avenue|Ave|St|Rd|Drive|Court|Terrace|Close|Way|Place|Crescent|Boulevard|Blvd)\b\.?(?:, (?:Flat|Apt\.?|Unit|Suite) \d+\w?)?(?:, {_NAMES})?",
    rf"P\.?O\.? Box \d+(?:, {_NAMES})?",
    rf"\d+(?: (?:bis|ter))?,? (?:rue|avenue|impasse|boulevard|place|allée|chemin|quai|cours) (?:(?:de la|de l'|des|du|de|d') ?)?{_NAMES}(?:, \d{{5}}(?: {_NAMES})?)?",
    rf"(?:Rua|Avenida|Av\.|Travessa|Praça|Largo|Alameda|Estrada) (?:(?:da|do|das|dos|de) )?{_NAME}(?: (?:da|do|das|dos|de|{_NAME}))*, \d+(?:, \d+\.?º (?:andar|dto|esq))?(?:, \d{{4,5}}-\d{{3}})?(?:, {_NAMES})?",
    # whatever the language: a street and its number, then a postal code and a place
    rf"{_NAMES} \d+\w?, \d{{4,6}} {_NAMES}", rf"\d+\w?,? {_NAMES}, \d{{4,6}} {_NAMES}",
    rf"(?:\d{{6}}, )?(?:(?:г\.|город) {_NAMES}, )?(?:ул\.|улица|пер\.|переулок|пр\.|проспект|наб\.|бул\.|пл\.|шоссе) ?{_NAMES}, (?:д\.|дом) ?\d+\w?(?:, (?:к|корп|стр)\. ?\d+)?(?:, (?:кв\.|квартира) ?\d+)?",
))

#: Strings one of which every text with the form contains: most texts are spared most patterns.
_AT_SIGNS = ("@", "＠", "at)", "at]", "at}", "(at", "[at", " at ", "a còng", "arroba", "собака", "arobase")
_ID_SIGNS = (
    "ssn", "social", "tax ", "national id", "identity", "id card", "id number", "passport", "cccd", "cmnd", "căn cước", "định danh", "chứng minh", "giấy tờ", "hộ chiếu", "mã số",
    "sécurité", "passeport", "carte d", "numéro fiscal", "cpf", "rg ", "nif ", "passaporte", "bilhete", "cartão", "паспорт", "снилс", "инн", "удостоверени",
)
_DIGITS = frozenset(" ".join(_DIGIT_WORDS).split())
_RE = [
    ("EMAIL", re.compile(_EMAIL, re.I), lambda low: any(x in low for x in _AT_SIGNS)),
    ("ADDRESS", re.compile(rf"(?<!\w)(?:{_ADDRESS})"), None),
    ("ID_NUMBER", re.compile(_ID_CUED, re.I), lambda low: any(x in low for x in _ID_SIGNS)),
    ("ID_NUMBER", re.compile(_ID_AFTER, re.I), lambda low: " as " in low or " is " in low or " for " in low),
    ("ID_NUMBER", re.compile(_ID_SHAPE), None),
    ("PHONE", re.compile(_PHONE), None),
    ("PHONE", re.compile(rf"(?<!\w)(?:{_SPOKEN})", re.I), lambda low: sum(map(_DIGITS.__contains__, low.replace(",", " ").replace("-", " ").split())) >= 6),
]
_ONE = rf"[{_U}](?:\.|[\w'’]*)"  # a word, or an initial with its point
_PARTICLE = r"(?:d[aeou]|das|dos|del|van|von|der|den)"
_RUN = re.compile(rf"(?<![\w@.]){_ONE}(?:[- ](?:{_PARTICLE} ){{0,2}}{_ONE})+(?![\w@])")
#: A single capitalised word; it counts behind a title or a word that introduces a person.
_SINGLE = re.compile(rf"(?<![\w@.])[{_U}][\w'’]+(?![\w@])")
_BEFORE = re.compile(r"(?:(\w+) )?(\w+)\.? $")
_INTRODUCING = TITLES | set(PERSON_CUES)
#: A number that no form claims; the corpus decides by its neighbours and its shape.
_NUMBER = re.compile(r"(?<![\w@.,/+-])\+?\(?\d(?:[ .()-]{0,2}\d){6,14}(?![\w@]|[.,]\d| ?[%€$])")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_ODD = re.compile("[\u0300-\u036f\u200b-\u200f\u2060\ufeff\u00ad\uff00-\uffef\u00a0\u2000-\u200a\u202f\u205f\u3000]")


def _plain(text: str) -> tuple[str, list[int] | None]:
    """The text in composed plain letters for matching, and for each of its characters the place in the original."""
    if not _ODD.search(text):
        return text, None
    out, at, i, n = [], [], 0, len(text)
    while i < n:
        j = i + 1
        while j < n and unicodedata.combining(text[j]):
            j += 1
        piece = text[i:j]
        if not (unicodedata.category(piece[0]) == "Cf"):
            piece = piece if piece == "\n" else unicodedata.normalize("NFKC", piece)
            out.append(piece)
            at.extend([i] * len(piece))
        i = j
    at.append(n)
    return "".join(out), at


class _Taken:
    """Disjoint stretches in order; asked in logarithmic time."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, a: int, b: int) -> bool:
        k = bisect_right(self.ends, a)
        return k == len(self.starts) or b <= self.starts[k]

    def add(self, a: int, b: int) -> None:
        k = bisect_right(self.starts, a)
        self.starts.insert(k, a)
        self.ends.insert(k, b)


def _beside(plain: str, line: tuple[int, int], a: int, b: int) -> tuple[str, str]:
    """The two words before and after a stretch within its line and sentence, however far they stand."""
    size = 60
    while True:  # most neighbours stand near: the window grows only where they do not
        low, high = max(line[0], a - size), min(line[1], b + size)
        before, after = plain[low:a], plain[b:high]
        cut = [x.end() for x in re.finditer(r"[.!?]\s", before)]
        title = re.search(r"\b(\w+)\. $", before)
        if title and title.group(1).lower() in TITLES:
            cut = [x for x in cut if x < title.start()]
        stop = re.search("[.!?]", after)
        left = _WORD.findall(before[cut[-1]:] if cut else before)
        right = _WORD.findall(after[: stop.start()] if stop else after)
        if (cut or low == line[0] or len(left) > 2) and (stop or high == line[1] or len(right) > 2):
            return " ".join(w.lower() for w in left[-2:]) or "^", " ".join(w.lower() for w in right[:2]) or "$"
        size *= 2


def _word_before(plain: str, line: int, a: int) -> str:
    """The word before a place within its line and sentence, else ``^``."""
    i = a
    while i > line and not plain[i - 1].isalnum():
        i -= 1
        if plain[i] in ".!?" and plain[i + 1 : i + 2].isspace():
            return "^"
    j = i
    while j > line and (plain[j - 1].isalnum() or plain[j - 1] == "_"):
        j -= 1
    return plain[j:i].lower() or "^"


def _word_behind(plain: str, line: int, b: int) -> str:
    """The word behind a place within its line and sentence, else ``$``."""
    i = b
    while i < line and not plain[i].isalnum():
        if plain[i] in ".!?":
            return "$"
        i += 1
    j = i
    while j < line and (plain[j].isalnum() or plain[j] == "_"):
        j += 1
    return plain[i:j].lower() or "$"


def _introduced(plain: str, line: int, a: int) -> bool:
    """True where a title or an introducing word stands right before a place."""
    before = _BEFORE.search(plain, max(line, a - 40), a)
    return bool(before) and (before.group(2).lower() in _INTRODUCING or f"{(before.group(1) or '').lower()}_{before.group(2).lower()}" in _INTRODUCING)


def spans(text: str) -> list[tuple[str, int, int, str, str, str]]:
    """(kind, start, end, run, left, right): the grammar's finds and, as CANDIDATE and NUMBER, runs of capitalised words and
    numbers that no form claims. Numbers come with their shape (digits as 0) and their neighbours, names with themselves."""
    plain, at = _plain(text)
    taken, out = _Taken(), []
    place = (lambda k: k) if at is None else at.__getitem__
    low = plain.lower()
    breaks = [m.start() for m in re.finditer("\n", plain)]

    def line(a: int) -> tuple[int, int]:
        k = bisect_right(breaks, a - 1)
        return (breaks[k - 1] + 1 if k else 0), (breaks[k] if k < len(breaks) else len(plain))

    zeros = lambda x: re.sub("[0-9]", "0", x)
    shape = lambda a, b: zeros(plain[a:b])
    near = lambda a, b: (zeros(_word_before(plain, line(a)[0], a)), zeros(_word_behind(plain, line(a)[1], b)))
    for kind, pattern, may in _RE:
        if may is not None and not may(low):
            continue
        for m in pattern.finditer(plain):
            a, b = m.span(m.lastgroup) if m.lastgroup else m.span()
            digits = sum(c.isdigit() for c in plain[a:b])
            if kind == "ID_NUMBER" and digits < 6:
                continue
            if kind == "PHONE" and digits not in range(10, 16) and plain[a:b][-1].isdigit():
                continue
            if taken.free(a, b):
                taken.add(a, b)
                out.append((kind, place(a), place(b), shape(a, b), *near(a, b)) if kind in ("PHONE", "ID_NUMBER") else (kind, place(a), place(b), "", "", ""))
    for m in _NUMBER.finditer(plain):
        a, b = m.span()
        if taken.free(a, b):
            beside = near(a, b)
            # shorter numbers and those of other shapes are a phone number right behind a word that says so
            cued = beside[0] in _PHONE_CUES and plain[max(0, a - 4) : a].rstrip(" :.")[-1:].isalpha()
            if cued:
                taken.add(a, b)
            out.append(("PHONE" if cued else "NUMBER", place(a), place(b), shape(a, b), *beside))
    runs = _Taken()
    found = []
    for m in _RUN.finditer(plain):
        runs.add(*m.span())
        found.append((*m.span(), False))
    for m in _SINGLE.finditer(plain):
        if runs.free(*m.span()) and _introduced(plain, line(m.start())[0], m.start()):
            runs.add(*m.span())
            found.append((*m.span(), True))
    for a, b, titled in sorted(found):
        run = plain[a:b].rstrip(".") if not re.search(r"\b\w\.$", plain[a:b]) else plain[a:b]
        first = _WORD.match(run)
        while first and first.group().lower() in TITLES and " " in run:
            titled = True
            cut = len(run) - len(run[first.end():].lstrip(". "))
            a, run = a + cut, run[cut:]
            first = _WORD.match(run)
        words = _WORD.findall(run)
        b = a + len(run)
        if len(words) < 2 and not (titled and len(run) > 1) or not taken.free(a, b) or any(c.isdigit() for c in run):
            continue
        out.append(("CANDIDATE", place(a), place(b), run, *_beside(plain, line(a), a, b)))
    return out


_SPAN = "line_no int, start int, end int, kind string, run string, left string, right string"


def _find(docs: DataFrame, id: str, text: str) -> DataFrame:
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            for key, value in zip(batch.column(0), batch.column(1).to_pylist()):
                found = spans(value)
                if not found:
                    continue
                breaks = [m.start() for m in re.finditer("\n", value)]
                for what, a, b, words, left, right in found:
                    for col, x in zip(cols, (key.as_py(), bisect_right(breaks, a - 1) + 1, a, b, what, words, left, right)):
                        col.append(x)
            types = [batch.schema.types[0], *[pa.int32()] * 3, *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["id", "line_no", "start", "end", "kind", "run", "left", "right"])

    d = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).filter("id is not null and length(text) > 0")
    return d.mapInArrow(run, f"id {kind}, {_SPAN}")


#: Words that make a run the name of a place or a group when they are part of it.
_INNER = "road street lane avenue square bay bridge pier harbour lake cape island club choir stage festival studio archive".split()


def _words(run: Column) -> Column:
    return F.filter(F.split(F.lower(run), r"[^\p{L}\p{M}']+"), lambda w: F.length(w) > 1)


def _evidence(stat: DataFrame, key: str, out: str) -> DataFrame:
    """Weight of evidence of each key, smoothed towards none: ln of the odds of a person with it, at even prior odds."""
    return stat.select(key, F.greatest(F.lit(-4.0), F.least(F.lit(4.0), F.log((F.col("p") + 0.5) / (F.col("t") - F.col("p") + 0.5)))).alias(out))


def disclosure(candidates: DataFrame, known: DataFrame, rounds: int = 4) -> DataFrame:
    """``run, left, right, person``: how probably each distinct run in its context is a person, over all documents.

    ``known`` has ``word, share``: the share of persons among the named entities that contain the word. The first guess
    of a run comes from these words and from the introducing words; each round then estimates from the whole corpus what
    every left context, right context and word discloses, and guesses again. Only counts by distinct run and context are
    moved, never a document.
    """
    kinds = candidates.groupBy("run", "left", "right").agg(F.count(F.lit(1)).alias("n"))
    kinds = kinds.withColumn("k", F.xxhash64("run", "left", "right")).withColumn("words", _words(F.col("run")))
    last = F.regexp_extract("left", r"(\S+)$", 1)
    both = F.replace("left", F.lit(" "), F.lit("_"))
    cue = lambda cues: last.isin(*cues) | both.isin(*cues)
    exploded = kinds.select("k", F.explode("words").alias("word"))
    share = exploded.join(known.hint("merge"), "word", "left").groupBy("k").agg(F.avg(F.coalesce("share", F.lit(0.5))).alias("share"), F.min(F.coalesce("share", F.lit(0.5))).alias("least"))
    place = cue(PLACE_CUES) | F.arrays_overlap("words", F.array(*[F.lit(w) for w in _INNER])) | F.regexp_extract("right", r"^(\S+)", 1).isin("road", "street", "stage", "square")
    guess = F.when(place, 0.03).when(cue(PERSON_CUES), 0.95).otherwise(0.2 * F.coalesce("share", F.lit(0.5)) + 0.6 * F.coalesce("least", F.lit(0.5)))
    kinds = materialize(kinds.join(share.hint("merge"), "k", "left").select("k", "run", "left", "right", "words", "n", guess.alias("prior"), place.alias("place")), "runs")
    exploded = kinds.select("k", F.explode("words").alias("word"))
    now = kinds.select("k", "left", "right", "n", F.col("prior").alias("r"))
    for step in range(rounds):
        sums = (F.sum(F.col("n") * F.col("r")).alias("p"), F.sum("n").alias("t"))
        left = _evidence(now.filter("left <> '^'").groupBy("left").agg(*sums), "left", "el")
        right = _evidence(now.filter("right <> '$'").groupBy("right").agg(*sums), "right", "er")
        word = _evidence(exploded.join(now.select("k", "n", "r").hint("merge"), "k").groupBy("word").agg(*sums), "word", "ew")
        words = exploded.join(word.hint("merge"), "word").groupBy("k").agg(F.avg("ew").alias("ew"))
        logit = F.coalesce("el", F.lit(0.0)) + 0.7 * F.coalesce("er", F.lit(0.0)) + F.coalesce("ew", F.lit(0.0)) + 0.5 * F.log(F.col("prior") / (1 - F.col("prior")))
        now = (
            # these grow with the distinct runs and contexts of the corpus: sorted and merged, never broadcast
            kinds.join(left.hint("merge"), "left", "left").join(right.hint("merge"), "right", "left").join(words.hint("merge"), "k", "left")
            .select("k", "left", "right", "n", F.when(F.col("place"), F.col("prior")).otherwise(1 / (1 + F.exp(-logit))).alias("r"))
        )
        if step < rounds - 1:
            now = materialize(now, "round")
    return now.join(kinds.select("k", "run").hint("merge"), "k").select("run", "left", "right", F.col("r").alias("person"))


def disclosed_numbers(found: DataFrame, rounds: int = 3, threshold: float = 0.85) -> DataFrame:
    """``run, left, right, pii_type``: shapes and neighbours with which a number that no form claims is a phone or identity number.

    The numbers that the forms claim teach what each left word, right word and shape discloses, over all documents; each round
    weighs the unclaimed numbers anew, and they count as ordinary numbers as far as they do not pass.
    """
    n = found.filter("kind in ('PHONE', 'ID_NUMBER', 'NUMBER')").groupBy("kind", "run", "left", "right").agg(F.count(F.lit(1)).alias("n"))
    features = F.array(F.concat(F.lit("l "), F.regexp_extract("left", r"(\S+)$", 1)), F.concat(F.lit("r "), F.regexp_extract("right", r"^(\S+)", 1)), F.concat(F.lit("s "), F.col("run")))
    n = materialize(n.withColumn("k", F.xxhash64("kind", "run", "left", "right")).withColumn("f", features), "numbers")
    out = None
    for kind in ("PHONE", "ID_NUMBER"):
        now = n.withColumn("p", F.when(F.col("kind") == kind, 1.0).when(F.col("kind") == "NUMBER", 0.02).otherwise(0.0))
        for step in range(rounds):
            each = now.select("n", "p", F.explode("f").alias("x"))
            stat = each.groupBy("x").agg(F.sum(F.col("n") * F.col("p")).alias("p"), F.sum("n").alias("t"))
            # the words beside most numbers and shapes are few: no evidence is broadcast, whatever its size
            weighed = now.select("k", F.explode("f").alias("x")).join(_evidence(stat, "x", "e").hint("merge"), "x").groupBy("k").agg(F.sum("e").alias("e"))
            p = F.when(F.col("kind") == kind, 1.0).when(F.col("kind") == "NUMBER", 1 / (1 + F.exp(2.0 - F.col("e")))).otherwise(0.0)
            now = materialize(n.join(weighed.hint("merge"), "k").withColumn("p", p).drop("e"), "numbers-round")
        passed = now.filter((F.col("kind") == "NUMBER") & (F.col("p") >= threshold)).select("run", "left", "right", F.lit(kind).alias("pii_type"), "p")
        out = passed if out is None else out.unionByName(passed)
    return out.groupBy("run", "left", "right").agg(F.max_by("pii_type", F.struct("p", "pii_type")).alias("pii_type"))


def known_words(entities: DataFrame) -> DataFrame:
    """``word, share`` from ``text, type`` rows of named entities: of the entities with the word, the share typed PERSON, smoothed towards a half."""
    e = entities.filter("text is not null and type is not null").select(F.explode(F.array_distinct(_words(F.col("text")))).alias("word"), (F.upper("type") == "PERSON").cast("double").alias("p"))
    return e.groupBy("word").agg(((F.sum("p") + 0.5) / (F.count(F.lit(1)) + 1)).alias("share"))


def find_pii(docs: DataFrame, entities: DataFrame, *, id: str, text: str, threshold: float = 0.5, rounds: int = 4) -> DataFrame:
    """``id, line_no, start, end, pii_type`` of every piece of personal information; places count characters from 0.

    Lines are split at newline and counted from 1. Null and empty texts and null ids are left out; repeated rows give
    repeated finds. Without entities the names are judged from the introducing words and the corpus alone. Texts are
    processed whole, in one pass over them; very long ones too.
    """
    found = materialize(_find(docs, id, text), "spans")
    candidates = found.filter("kind = 'CANDIDATE'")
    persons = disclosure(candidates, known_words(entities), rounds).filter(F.col("person") >= threshold).select("run", "left", "right")
    names = candidates.join(persons.hint("merge"), ["run", "left", "right"], "left_semi").withColumn("kind", F.lit("PERSON"))
    numbers = found.filter("kind = 'NUMBER'").join(disclosed_numbers(found), ["run", "left", "right"]).withColumn("kind", F.col("pii_type"))
    columns = [F.col("id").alias(id), "line_no", "start", "end", F.col("kind").alias("pii_type")]
    claimed = found.filter("kind not in ('CANDIDATE', 'NUMBER')")
    return claimed.select(*columns).unionByName(names.select(*columns)).unionByName(numbers.select(*columns))


def redact(docs: DataFrame, found: DataFrame, *, id: str, text: str) -> DataFrame:
    """``id, text`` with every find replaced by its type in square brackets and the rest unchanged.

    Of overlapping finds the first is replaced. Ids must be distinct; a null text stays null.
    """
    per = found.groupBy(id).agg(F.sort_array(F.collect_set(F.struct("start", "end", "pii_type"))).alias("finds"))

    @F.udf(T.StringType(), useArrow=True)
    def put(value: str | None, finds: list | None) -> str | None:
        if value is None or not finds:
            return value
        out, done = [], 0
        for a, b, kind in finds:
            if a >= done:
                out += [value[done:a], f"[{kind}]"]
                done = b
        return "".join([*out, value[done:]])

    return docs.select(id, text).join(per, id, "left").select(id, put(F.col(text), F.col("finds")).alias(text))
