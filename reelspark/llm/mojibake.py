"""Problem 6: texts read in a wrong character encoding, marked and restored.

A wrong code page is a substitution cipher over the characters above ASCII. Two kinds occur: bytes of UTF-8 read as single
characters, where a letter became two to four characters, and one single-byte page read as another, where a letter became
another letter. Which byte or letter a character stands for is not looked up but learnt, for each source, by
expectation-maximisation: letter bigrams of the corpus say which letters fit between their neighbours, the present table
says which characters they may have been read as, and the expected counts make the next table. The bigrams are
re-estimated with it, without the words that the table explains. The first tables know nothing (UTF-8), or know only which
words of the corpus have the same pattern of letters (single-byte pages). A learnt table is applied with ``translate()``.

A small corpus cannot teach a table. Code pages that the standard library knows may therefore be offered as further
tables (``start``); expectation-maximisation gives each its share in a source, and a learnt table goes before them.
"""

from __future__ import annotations

import encodings.aliases
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.session import materialize

#: Where words end; the no-break space is not among them, for it is the second half of a misread letter.
SPACES = " \n\t\r\u2000-\u200a\u2028\u202f\u205f\u3000"
#: A character whose original is gone.
LOST = r"[\u0080-\u009f�]|[\p{L}\p{M}]\?[\p{L}\p{M}]"
#: Bytes above ASCII stand in this private range between translate() and the decoding of UTF-8.
_PRIVATE = 0xF700
_RUN = re.compile(r"[^\x00-\x7f]+")
_FLOOR = 1e-7
#: Expected counts are summed as whole millionths, so that their sum does not depend on the order of the parts.
_UNIT = 1_000_000
#: Votes are summed as whole billionths, for in a pattern of many words each is small.
_VOTE = 1_000_000_000


def _framed(word: str) -> str:
    """The word between blanks, digits as 0, control characters as blanks: what the bigrams are counted on."""
    return " " + re.sub("[\x00-\x1f\x7f]", " ", re.sub("[0-9]", "0", word)) + " "


def _words(texts: DataFrame) -> DataFrame:
    return texts.select("src", F.explode(F.split("text", f"[{SPACES}]+")).alias("word")).filter("word <> ''").groupBy("src", "word").agg(F.count(F.lit(1)).alias("n"))


# --- the bigram model ------------------------------------------------------------------------------------------------


class Alphabet:
    """The states of the model: ASCII, then the ``letters`` above it that the corpus has; what is not among them has the last number."""

    def __init__(self, letters: list[str]) -> None:
        self.letters = letters
        self.states = [chr(c) for c in range(32, 127)] + letters
        self.number = {c: i for i, c in enumerate(self.states)}
        self.first = len(self.states) - len(letters)
        self.other = len(self.states)
        encoded = [list(c.encode("utf-8", "replace")) for c in letters]
        #: the letters of two, three and four bytes, and their bytes less 128
        self.of_size = {k: np.array([i for i, b in enumerate(encoded) if len(b) == k], int) for k in (2, 3, 4)}
        self.bytes = {k: np.array([encoded[i] for i in v], int).reshape(-1, k) - 128 for k, v in self.of_size.items()}

    def code(self, text: str) -> list[int]:
        return [self.number.get(c, self.other) for c in text]


def transitions(counts: np.ndarray, weight: float) -> np.ndarray:
    """P(next | letter) with a row and a column for unknown characters; a letter seen less often than ``weight`` says little."""
    kept = np.maximum(counts, 0)
    # half of the pull goes to the single letters' frequencies, half nowhere: rare letters are improbable, not impossible
    single = kept.sum(0) / max(kept.sum(), 1.0)
    known = (kept + 0.5 * weight * single) / (kept.sum(1, keepdims=True) + weight) + _FLOOR
    out = np.full((len(counts) + 1,) * 2, _FLOOR)
    out[:-1, :-1] = known
    return out


def plain_enough(counts: np.ndarray, chain: np.ndarray) -> float:
    """A mean log-likelihood of bigrams above which a word is not looked at as a garbled one: three quarters of the corpus's mean."""
    kept = np.maximum(counts, 0)
    return float(0.75 * (kept * np.log(chain[:-1, :-1])).sum() / max(kept.sum(), 1.0))


def _bigrams(words: DataFrame) -> DataFrame:
    framed = F.concat(F.lit(" "), F.regexp_replace(F.regexp_replace("word", "[0-9]", "0"), "[\\x00-\\x1f\\x7f]", " "), F.lit(" "))
    # numbers are most of the distinct words: with their digits alike they are few
    alike = words.select("src", framed.alias("w"), "n").groupBy("src", "w").agg(F.sum("n").alias("n"))
    pairs = alike.select("src", "n", F.expr("transform(sequence(1, length(w) - 1), i -> substring(w, i, 2))").alias("p"))
    return pairs.select("src", "n", F.explode("p").alias("pair")).groupBy("src", "pair").agg(F.sum("n").alias("n"))


def _alphabet(words: DataFrame, letters: int) -> tuple[Alphabet, np.ndarray, dict[str, np.ndarray], list[str]]:
    """The alphabet, its bigram counts, those of each source as rows (a, b, n), and all characters above ASCII: at most
    ``letters`` squared numbers for each source reach the driver."""
    pairs = materialize(_bigrams(words), "bigrams")
    second = pairs.groupBy(F.substring("pair", 2, 1).alias("c")).agg(F.sum("n").alias("n")).filter(r"c rlike '[^\\x00-\\x7f]'")
    chars = second.orderBy(F.desc("n"), "c").limit(letters).collect()
    alphabet = Alphabet(sorted(r.c for r in chars if r.n >= 3))
    known = F.broadcast(words.sparkSession.createDataFrame([(c,) for c in alphabet.states], "c string"))
    both = pairs.join(known.withColumnRenamed("c", "a"), F.substring("pair", 1, 1) == F.col("a")).join(known.withColumnRenamed("c", "b"), F.substring("pair", 2, 1) == F.col("b"))
    counts = np.zeros((len(alphabet.states),) * 2)
    own: dict[str, list] = defaultdict(list)
    for batch in both.select("src", "a", "b", "n").toArrow().to_batches():
        for src, a, b, n in zip(*(c.to_pylist() for c in batch.columns)):
            counts[alphabet.number[a], alphabet.number[b]] += n
            own[src].append((alphabet.number[a], alphabet.number[b], n))
    return alphabet, counts, {s: np.array(v, dtype=np.int64) for s, v in own.items()}, sorted(r.c for r in chars)


# --- expectation: how a run of characters may be read --------------------------------------------------------------------


def _as_it_stands(log_chain: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log-likelihood of each run as it stands."""
    return log_chain[at[:, :-1], at[:, 1:]].sum(1)


class Reader:
    """Forward and backward sums over all readings of runs of one length; letters of ``k`` bytes take ``k`` characters."""

    def __init__(self, alphabet: Alphabet, chain: np.ndarray, table: np.ndarray, at: np.ndarray, chars: np.ndarray, bytes_: bool) -> None:
        self.alphabet, self.chars, self.bytes_ = alphabet, chars, bytes_
        first, last = alphabet.first, alphabet.other
        chain, table = chain.astype(np.float32), table.astype(np.float32)
        inner, length = chain[first:last, first:last], chars.shape[1]
        self.emit: dict[tuple[int, int], np.ndarray] = {}
        self.of = alphabet.of_size if bytes_ else {1: np.arange(len(alphabet.letters))}
        for k, of in self.of.items():
            for p in range(length - k + 1 if len(of) else 0):
                if bytes_:
                    e = table[chars[:, p]][:, alphabet.bytes[k][:, 0]]
                    for j in range(1, k):
                        e = e * table[chars[:, p + j]][:, alphabet.bytes[k][:, j]]
                else:
                    e = table[chars[:, p]]
                self.emit[k, p] = e
        # each place's sums are kept relative to their largest, with its logarithm: long runs stay within single precision
        self.enter: list[np.ndarray | None] = [None] * (length + 1)
        self.leave: list[np.ndarray | None] = [None] * (length + 1)
        self.enter_log, self.leave_log = np.zeros((length + 1, len(chars))), np.zeros((length + 1, len(chars)))
        self.enter[0], self.leave[length] = chain[at[:, 0]][:, first:last], chain[first:last][:, at[:, -1]].T
        self.log_total = np.full(len(chars), -np.inf)
        for p in range(1, length + 1):
            ends = self._sum([(k, p - k, self.enter[p - k], self.enter_log[p - k]) for k in self.of if p >= k])
            if ends is not None and p < length:
                self.enter[p], self.enter_log[p] = ends[0] @ inner, ends[1]
            elif ends is not None:
                with np.errstate(divide="ignore"):
                    self.log_total = np.log((ends[0].astype(np.float64) * self.leave[length]).sum(1)) + ends[1]
        for p in range(length - 1, 0, -1):
            starts = self._sum([(k, p, self.leave[p + k], self.leave_log[p + k]) for k in self.of if p + k <= length])
            if starts is not None:
                self.leave[p], self.leave_log[p] = starts[0] @ inner.T, starts[1]

    def _sum(self, parts: list) -> tuple[np.ndarray, np.ndarray] | None:
        parts = [(k, p, side, log) for k, p, side, log in parts if side is not None and (k, p) in self.emit]
        if not parts:
            return None
        most = np.max([log for *_, log in parts], axis=0)
        out = np.zeros((len(self.chars), len(self.alphabet.letters)), np.float32)
        for k, p, side, log in parts:
            out[:, self.of[k]] += side[:, self.of[k]] * self.emit[k, p] * np.exp(log - most).astype(np.float32)[:, None]
        top = np.maximum(out.max(1), 1e-30)
        out /= top[:, None]
        out[out < 1e-12] = 0
        return out, most + np.log(top)

    def _posterior(self, k: int, p: int) -> np.ndarray | None:
        """How probably each letter of ``k`` characters stands at place ``p``, for each run."""
        if self.enter[p] is None or self.leave[p + k] is None:
            return None
        of = self.of[k]
        with np.errstate(invalid="ignore"):
            scale = np.exp(np.minimum(np.nan_to_num(self.enter_log[p] + self.leave_log[p + k] - self.log_total, nan=-80.0, posinf=-80.0), 80.0))
        return self.enter[p][:, of] * self.emit[k, p] * self.leave[p + k][:, of] * scale.astype(np.float32)[:, None]

    def count(self, weight: np.ndarray, out: np.ndarray) -> None:
        """Adds the expected number of times that each character stood for each byte (or letter)."""
        for k, p in self.emit:
            post = self._posterior(k, p)
            if post is None:
                continue
            # few letters fit a place: only those are added up
            row, col = np.nonzero(post > 1e-4)
            w = post[row, col] * weight[row]
            for j in range(k):
                to = self.alphabet.bytes[k][col, j] if self.bytes_ else self.of[k][col]
                np.add.at(out, (self.chars[row, p + j], to), w)

    def best(self) -> list[list[tuple[int, int]] | None]:
        """The most probable letters of each run by place, each the best given all other readings, where they fit together."""
        out: list[list[tuple[int, int]] | None] = []
        post = {}
        for k, p in self.emit:
            x = self._posterior(k, p)
            if x is not None:
                top = x.argmax(1)
                post[k, p] = x[np.arange(len(x)), top], self.of[k][top]
        length = self.chars.shape[1]
        for i in range(len(self.chars)):
            p, found = 0, []
            while p < length:
                options = [(post[k, p][0][i], k, post[k, p][1][i]) for k in self.of if (k, p) in post]
                if not options or max(options)[0] <= 0:
                    break
                _, k, letter = max(options)
                found.append((k, int(letter)))
                p += k
            out.append(found if p == length else None)
        return out


_CONTEXT = "src string, left string, run string, right string, n bigint"


def _contexts(words: DataFrame) -> DataFrame:
    """Each run of characters above ASCII with its two neighbours, once for each source, with its count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for src, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                text = _framed(word)
                for m in _RUN.finditer(text):
                    found[src, text[m.start() - 1], m.group(), text[m.end()]] += n
            keys = list(found)
            cols = [pa.array([k[i] for k in keys], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([found[k] for k in keys], pa.int64())], names=["src", "left", "run", "right", "n"])

    made = words.select("src", "word", "n").mapInArrow(run, _CONTEXT)
    return made.groupBy("src", "left", "run", "right").agg(F.sum("n").alias("n"))


class _Step(NamedTuple):
    """What one expectation step needs: small arrays, bounded by the alphabet and the sources."""

    alphabet: Alphabet
    counts: np.ndarray
    own: dict[str, np.ndarray]
    #: the part of a source's own bigrams that its model goes without, and the count below which a letter says little
    without: float
    weight: float
    plain: float
    tables: dict[str, np.ndarray]
    share: dict[str, float]
    chars: dict[str, int]
    bytes_: bool
    pairs: bool


_STAT = "kind int, src int, a int, b int, c int, d int, w bigint"
_STAT_NAMES = ["kind", "src", "a", "b", "c", "d", "w"]
_SHARE, _TABLE, _BIGRAM, _PAIR = range(4)


def _expect(contexts: DataFrame, step: _Step) -> np.ndarray:
    """The summed statistics of one step: rows of _STAT as whole numbers, bounded by sources, characters and letters."""
    sent = contexts.sparkSession.sparkContext.broadcast(step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sent.value
        groups: dict[tuple[str, int], list] = defaultdict(list)
        sums: Counter = Counter()
        chains: dict[str, np.ndarray] = {}
        logs: dict[int, np.ndarray] = {}
        place = {src: i for i, src in enumerate(s.tables)}

        def chain_of(src: str) -> np.ndarray:
            key = src if s.without > 0 else ""
            if key not in chains:
                counts = s.counts.copy()
                if key and src in s.own:
                    a, b, n = s.own[src].T
                    counts[a, b] -= s.without * n
                chains[key] = transitions(counts, s.weight)
            return chains[key]

        def work(src: str, rows: list) -> None:
            at = np.array([s.alphabet.code(l + r + e) for l, r, e, _ in rows])
            chars = np.array([[s.chars.get(c, len(s.chars)) for c in r] for _, r, _, _ in rows])
            n = np.array([x[3] for x in rows], float)
            chain = chain_of(src)
            if id(chain) not in logs:
                logs[id(chain)] = np.log(chain)
            plain = _as_it_stands(logs[id(chain)], at)
            me = place[src]
            sums[_SHARE, me, 1, 0, 0, 0] += round(n.sum() * _UNIT)
            # a run that is as probable as runs are on average is no garbled one
            odd = plain < s.plain * (at.shape[1] - 1)
            if not odd.any():
                return
            at, chars, n, plain = at[odd], chars[odd], n[odd], plain[odd]
            reader = Reader(s.alphabet, chain, s.tables[src], at, chars, s.bytes_)
            pi = s.share[src]
            more = np.log(pi / (1 - pi)) + reader.log_total - plain
            garbled = 1 / (1 + np.exp(-np.clip(more, -500, 500)))
            weight = n * garbled
            sums[_SHARE, me, 0, 0, 0, 0] += round(weight.sum() * _UNIT)
            table = np.zeros_like(s.tables[src])
            reader.count(weight, table)
            for a, b in zip(*np.nonzero(table > 1e-3)):
                sums[_TABLE, me, int(a), int(b), 0, 0] += round(table[a, b] * _UNIT)
            for j in range(at.shape[1] - 1):
                for x, y, w in zip(at[:, j], at[:, j + 1], weight):
                    if w > 1e-3:
                        sums[_BIGRAM, me, int(x), int(y), 0, 0] += round(w * _UNIT)
            if s.pairs:
                for i, read in enumerate(reader.best()):
                    if read is None or garbled[i] < 0.5:
                        continue
                    bytes_ = [b - 128 for k, letter in read for b in s.alphabet.letters[letter].encode()]
                    seen = sorted({(int(c), b) for c, b in zip(chars[i], bytes_)})
                    for x in range(len(seen)):
                        for y in range(x, len(seen)):
                            sums[_PAIR, 0, *seen[x], *seen[y]] += 1

        for batch in batches:
            for src, left, text, right, n in zip(*(c.to_pylist() for c in batch.columns)):
                size = len(text)
                # runs of any length, in groups whose sums stay within some megabytes
                rows = groups[src, size]
                rows.append((left, text, right, n))
                if len(rows) * size >= 2048:
                    work(src, groups.pop((src, size)))
        for (src, _), rows in groups.items():
            work(src, rows)
        keys = list(sums)
        cols = [pa.array([k[i] for k in keys], pa.int32()) for i in range(6)]
        yield pa.RecordBatch.from_arrays([*cols, pa.array([sums[k] for k in keys], pa.int64())], names=_STAT_NAMES)

    made = contexts.select("src", "left", "run", "right", "n").mapInArrow(run, _STAT)
    out = made.groupBy("kind", "src", "a", "b", "c", "d").agg(F.sum("w").alias("w")).toArrow()
    sent.destroy()
    return np.stack([out.column(c).to_numpy().astype(np.int64) for c in _STAT_NAMES], axis=1) if len(out) else np.zeros((0, 7), np.int64)


# --- maximisation: tables ------------------------------------------------------------------------------------------------


class Cipher(NamedTuple):
    """A table for translate(): of bytes (UTF-8 read as single characters) or of letters; ``src`` where it is one source's own."""

    name: str
    table: dict[str, str]
    bytes_: bool
    src: str | None = None
    #: the table by code points, for translate()
    codes: dict[int, str] | None = None


def _pages(pairs: np.ndarray, chars: list[str]) -> list[dict[str, tuple[int, int]]]:
    """Code pages from rows (character, byte, character, byte, runs with both): in a page each character is one byte and each
    byte one character. A page grows from the most frequent pair that no page has yet; each byte comes with its support."""
    if not len(pairs):
        return []
    one, two = pairs[:, 0] * 128 + pairs[:, 1], pairs[:, 2] * 128 + pairs[:, 3]
    same = one == two
    support = dict(zip(one[same].tolist(), pairs[same, 4].tolist()))
    # the rows of each pair lie together, in both directions
    of, to, w = np.concatenate([one[~same], two[~same]]), np.concatenate([two[~same], one[~same]]), np.concatenate([pairs[~same, 4]] * 2)
    order = np.lexsort((to, of))
    of, to, w = of[order], to[order], w[order]
    left, pages = dict(support), []
    while left:
        seed = max(left, key=lambda k: (left[k], k))
        if left[seed] < 2:
            break
        page, bytes_, gain = {}, set(), Counter({seed: 1})
        while gain:
            best = max(gain, key=lambda k: (gain[k], k))
            del gain[best]
            if best // 128 in page or best % 128 in bytes_:
                continue
            page[best // 128] = best % 128
            bytes_.add(best % 128)
            lo, hi = np.searchsorted(of, [best, best + 1])
            for k, n in zip(to[lo:hi].tolist(), w[lo:hi].tolist()):
                if k // 128 not in page and k % 128 not in bytes_:
                    gain[k] += n
        for c, b in page.items():
            left.pop(c * 128 + b, None)
        if len(page) >= 3:
            pages.append({chars[c]: (b, support[c * 128 + b]) for c, b in page.items() if c < len(chars)})
    return pages


def _completed(page: dict[str, tuple[int, int]]) -> dict[str, int]:
    """A learnt page whose well supported bytes agree with a known code page, with that page's bytes for what the corpus did
    not show or hardly showed."""
    firm = {c: b for c, (b, n) in page.items() if n >= 5}
    like = max(standard_pages().values(), key=lambda upper: (sum(upper[b] == c for c, b in firm.items()), upper))
    if not firm or sum(like[b] == c for c, b in firm.items()) < 0.8 * len(firm):
        return {c: b for c, (b, _) in page.items()}
    out, taken = dict(firm), set(firm.values())
    return out | {c: b for b, c in enumerate(like) if c not in out and b not in taken}


def _rounds(contexts: DataFrame, alphabet: Alphabet, counts: np.ndarray, own: dict[str, np.ndarray], chars: list[str], tables: dict[str, np.ndarray], bytes_: bool, rounds: int) -> tuple[dict, dict, np.ndarray]:
    """Expectation and maximisation in turn: by source the expected counts and the bigrams of garbled words; pairs met in one run."""
    number = {c: i for i, c in enumerate(chars)}
    total = counts.sum()
    sources = list(tables)
    share = dict.fromkeys(sources, 0.02)
    size = alphabet.other + 1
    garbled, by_source, expected, pairs = np.zeros((size, size)), {}, {}, np.zeros((0, 5), np.int64)
    for turn in range(rounds):
        # garbled words are among the bigrams at first: a letter's rarity counts for much then, and a source's own words little
        without = 0.5 * 0.5**turn if turn < rounds // 3 else 0.0
        clean, weight = counts - garbled[:-1, :-1], total * 1e-4 * 0.5**turn + 20
        rows = _expect(contexts, _Step(alphabet, clean, own, without, weight, plain_enough(clean, transitions(clean, weight)), tables, share, number, bytes_, bytes_ and turn == rounds - 1))
        of = lambda kind: rows[rows[:, 0] == kind]  # noqa: B023, E731
        expected = {s: np.zeros_like(t) for s, t in tables.items()}
        for i, s in enumerate(sources):
            mine = of(_TABLE)[of(_TABLE)[:, 1] == i]
            expected[s][mine[:, 2], mine[:, 3]] = mine[:, 6] / _UNIT
            tally = {int(r[2]): r[6] / _UNIT for r in of(_SHARE) if r[1] == i}
            share[s] = min(0.999 if not bytes_ else 0.3, max(1e-4, tally.get(0, 0.0) / max(tally.get(1, 0.0), 1)))
        met = of(_BIGRAM)
        garbled = np.zeros((size, size))
        np.add.at(garbled, (met[:, 2], met[:, 3]), met[:, 6] / _UNIT)
        by_source = {s: met[met[:, 1] == i] for i, s in enumerate(sources)}
        pairs = of(_PAIR)[:, 2:]
        if bytes_:
            # a source that shows a character seldom leans on what all sources show
            pool = sum(expected.values()) + 1e-3
            pool = pool / pool.sum(0, keepdims=True)
            tables = {s: (e + 2 * pool) / (e + 2 * pool).sum(0, keepdims=True) for s, e in expected.items()}
        else:
            for s, e in expected.items():
                for c, i in number.items():  # a cipher changes letters
                    if c in alphabet.number and i < len(e):
                        e[i, alphabet.number[c] - alphabet.first] = 0
                # and takes a character for one letter: the surer a character, the more it counts
                sure = e * e / (e.sum(1, keepdims=True) + 1e-9) + 1e-3
                tables[s] = sure / sure.sum(0, keepdims=True)
    return expected, by_source, pairs


def _dense(rows: np.ndarray, alphabet: Alphabet) -> np.ndarray:
    out = np.zeros((alphabet.other + 1,) * 2)
    np.add.at(out, (rows[:, 2], rows[:, 3]), rows[:, 6] / _UNIT)
    return out


def _pattern(word: str) -> str:
    seen: dict[str, int] = {}
    return "".join(c if ord(c) < 128 else chr(0xE000 + min(seen.setdefault(c, len(seen)), 0xFFF)) for c in re.sub("[0-9]", "0", word))


def _votes(words: DataFrame, alphabet: Alphabet, chars: list[str]) -> dict[str, np.ndarray]:
    """For each source a first table of letters: words vote for the words of equal pattern that are more frequent.

    Every pattern votes, whatever number of words it holds. A word with a total count of n gives each other word of at least
    n its square of the share in them. Words of one pattern differ in the characters of their slots only, so that the
    words above n are summed once for each slot and letter: the work grows with the words, not with their pairs.
    """
    number = {c: i for i, c in enumerate(chars)}
    odd = words.filter(F.col("word").rlike("[^\\x00-\\x7f].*[^\\x00-\\x7f]")).withColumn("pattern", F.udf(_pattern, T.StringType(), useArrow=True)("word"))
    lexicon = odd.groupBy("pattern", "word").agg(F.sum("n").alias("n"), F.collect_list("src").alias("sources"))
    letters = {c: i for i, c in enumerate(alphabet.letters)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a source's characters by letters, as whole numbers: their sum does not depend on the order of the parts
        out: dict[tuple[str, str], np.ndarray] = defaultdict(lambda: np.zeros(len(letters), np.int64))
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for _, alike in groupby(rows, key=lambda r: r[0]):
            total, squares = 0, defaultdict(Counter)
            for n, level in groupby(alike, key=lambda r: r[2]):
                voters: dict[int, Counter] = defaultdict(Counter)
                for _, word, _, sources in level:
                    total += n
                    for slot, c in enumerate(dict.fromkeys(c for c in word if ord(c) > 127)):
                        if c in letters:
                            squares[slot][letters[c]] += n * n
                        if c in number:
                            voters[slot].update((src, c) for src in sources)
                if total == n:  # the first word has none above it
                    continue
                for slot, who in voters.items():
                    to = np.fromiter(squares[slot], int)
                    vote = np.fromiter(squares[slot].values(), float) * (_VOTE / (total - n) ** 2)
                    for key, k in who.items():
                        out[key][to] += np.rint(k * vote).astype(np.int64)
        for (src, c), row in out.items():
            if c in letters:  # a word with the same letter there is no vote
                row[letters[c]] = 0
        found = [(src, number[c], int(b), int(row[b])) for (src, c), row in out.items() for b in np.flatnonzero(row)]
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32(), pa.int64()))], names=["src", "a", "b", "w"])

    # the words of a pattern follow each other, the most frequent first, so that none but sums are held
    voted = lexicon.repartition("pattern").sortWithinPartitions("pattern", F.desc("n")).mapInArrow(run, "src string, a int, b int, w bigint")
    out: dict[str, np.ndarray] = defaultdict(lambda: np.full((len(chars) + 1, len(letters)), 1e-3))
    for batch in voted.groupBy("src", "a", "b").agg(F.sum("w").alias("w")).toArrow().to_batches():
        for src, a, b, w in zip(*(c.to_pylist() for c in batch.columns)):
            out[src][a, b] += w / _VOTE
    return {s: v / v.sum(0, keepdims=True) for s, v in out.items()}


# --- code pages of the standard library, as a start ----------------------------------------------------------------------


@lru_cache(maxsize=1)
def standard_pages() -> dict[str, str]:
    """The upper halves of all single-byte code pages over ASCII that the standard library knows; undefined bytes as control characters."""
    out: dict[str, str] = {}
    for name in sorted(set(encodings.aliases.aliases.values())):
        try:
            if bytes(range(32, 127)).decode(name) != "".join(map(chr, range(32, 127))):
                continue
            upper = "".join(bytes([b]).decode(name, "replace").replace("�", chr(b)) for b in range(128, 256))
        except (LookupError, UnicodeError, ValueError, TypeError, AttributeError):
            continue
        if len(upper) == 128 and len(set(upper)) == 128 and upper not in out.values():
            out[name] = upper
    return out


def _one_letter(a: str, b: str) -> bool:
    return a.casefold() == b.casefold()


@lru_cache(maxsize=8)
def _standard_ciphers(letters: frozenset[str]) -> tuple[Cipher, ...]:
    """UTF-8 read in each page, and each pair of pages of which the first writes letters of one more alphabet of the corpus."""
    pages = standard_pages()
    out = [Cipher(f"utf-8>{read}", {c: chr(_PRIVATE + 128 + i) for i, c in enumerate(upper)}, True) for read, upper in pages.items()]
    seen = set()
    for was, written in pages.items():
        if sum(c in letters and c.isalpha() for c in written) < 20:
            continue
        for read, shown in pages.items():
            table = {r: w for w, r in zip(written, shown) if w != r and w in letters and (w.isalpha() or unicodedata.combining(w))}
            key = frozenset(table.items())
            # letters in the other case are no garbled letters
            if len(table) >= 8 and key not in seen and sum(_one_letter(r, w) for r, w in key) <= 0.25 * len(key):
                seen.add(key)
                out.append(Cipher(f"{was}>{read}", table, False))
    return tuple(out)


# --- reading words back --------------------------------------------------------------------------------------------------


def _decoded(text: str, cipher: Cipher) -> tuple[str, list[tuple[str, str]]]:
    """The text read once through a table, with the units that were read and their letters; what does not fit stays."""
    moved = text.translate(cipher.codes or {ord(k): v for k, v in cipher.table.items()})
    if not cipher.bytes_:
        return moved, [(c, cipher.table[c]) for c in text if c in cipher.table]
    out, units, i = [], [], 0
    while i < len(text):
        byte = ord(moved[i]) - _PRIVATE
        size = 0 if moved[i] == text[i] else 2 if 0xC2 <= byte < 0xE0 else 3 if 0xE0 <= byte < 0xF0 else 4 if 0xF0 <= byte < 0xF5 else 0
        rest = [ord(c) - _PRIVATE for c in moved[i : i + size]]
        if size and len(rest) == size and all(128 <= b < 192 for b in rest[1:]):
            try:
                letter = bytes(rest).decode()
                out.append(letter)
                units.append((text[i : i + size], letter))
                i += size
                continue
            except UnicodeDecodeError:
                pass
        out.append(text[i])
        i += 1
    return "".join(out), units


class Books:
    """Ciphers, found by the characters that a garbled word must have; readings much less probable than the word are left out."""

    def __init__(self, ciphers: list[Cipher], alphabet: Alphabet, chain: np.ndarray, plain: float, worst: float) -> None:
        self.alphabet, self.log, self.plain, self.worst = alphabet, np.log(chain).astype(np.float32), plain, worst
        ciphers = [c._replace(codes={ord(k): v for k, v in c.table.items()}) for c in ciphers]
        # the first two characters of a unit: a lead byte and one that continues
        self.pairs: dict[str, list[Cipher]] = defaultdict(list)
        for c in ciphers:
            if c.bytes_:
                low = [char for char, to in c.table.items() if 0xC2 <= ord(to) - _PRIVATE < 0xF5]
                after = [char for char, to in c.table.items() if 0x80 <= ord(to) - _PRIVATE < 0xC0]
                for x in low:
                    for y in after:
                        self.pairs[x + y].append(c)
        # all swaps of letters at once: for each character the state that each swap makes of it, -1 where it has none
        self.swaps = [c for c in ciphers if not c.bytes_]
        self.made: dict[str, np.ndarray] = {}
        for i, c in enumerate(self.swaps):
            for char, to in c.table.items():
                self.made.setdefault(char, np.full(len(self.swaps), -1, np.int32))[i] = alphabet.number.get(to, alphabet.other)
        self.none = np.full(len(self.swaps), -1, np.int32)

    def score(self, text: str) -> float:
        at = self.alphabet.code(_framed(text))
        return float(self.log[at[:-1], at[1:]].sum())

    def own_score(self, word: str) -> float:
        """A word as it stands; invisible characters in it are no letters."""
        shown = "".join(c for c in word if unicodedata.category(c) != "Cf")
        return self.score(word) if shown == word else max(self.score(word), self.score(shown))

    def reading_score(self, text: str, letters: list[str]) -> float:
        """As :meth:`score`; a letter that the corpus does not have otherwise is no likely original."""
        return self.score(text) + float(np.log(_FLOOR)) * sum(x not in self.alphabet.number for x in letters)

    def readings(self, word: str, src: str | None = None, most: int = 1_000_000) -> list[tuple[str, str, list[str], list[str]]]:
        """(cipher, reading, units, letters) for the ``most`` probable ways to read a word: the word as it stands, then the best first."""
        out, seen = [], {word}
        own = self.own_score(word)
        met_pairs = {c.name: c for x, y in zip(word, word[1:]) if x > "\x7f" for c in self.pairs.get(x + y, ()) if c.src in (None, src)}
        tried = set()
        for cipher in met_pairs.values():
            key = tuple(cipher.table.get(c) for c in word)
            if key in tried:
                continue  # the same bytes by another page
            tried.add(key)
            text, units, letters = word, [], []
            while True:  # what was misread several times is read back several times
                text, met = _decoded(text, cipher)
                if not met:
                    break
                units += [u for u, _ in met]
                letters += [x for _, x in met]
                if text not in seen:
                    seen.add(text)
                    score = self.reading_score(text, letters)
                    if score >= own + self.worst:
                        out.append((score, cipher.name, text, list(units), list(letters)))
        high = sum(c.isalpha() for c in word if c > "\x7f")
        foreign = sum(c in self.made for c in word)
        framed = _framed(word)
        # a word as probable as words are on average is not looked at further
        if foreign >= 2 and foreign >= 0.8 * high and own < self.plain * (len(framed) - 1):
            at = np.stack([self.made.get(c, self.none) for c in framed])
            enough = (at >= 0).sum(0) >= 0.8 * high
            fit = np.flatnonzero(enough)
            at = at[:, fit]
            at = np.where(at < 0, np.array(self.alphabet.code(framed), np.int32)[:, None], at)
            gain = self.log[at[:-1], at[1:]].sum(0)
            found = 0
            near = np.flatnonzero(gain >= own + self.worst)
            for i in fit[near[np.argsort(-gain[near], kind="stable")]]:
                if found >= most:
                    break
                cipher = self.swaps[i]
                if cipher.src in (None, src):
                    text, met = _decoded(word, cipher)
                    if text not in seen:
                        seen.add(text)
                        found += 1
                        letters = [x for _, x in met]
                        out.append((self.reading_score(text, letters), cipher.name, text, [u for u, _ in met], letters))
        return [("", word, [], []), *[r[1:] for r in sorted(out, key=lambda r: (-r[0], r[2]))[:most]]]


_READ = "src string, word string, n bigint, ciphers array<string>, readings array<string>, units array<array<string>>, letters array<array<string>>"
_READ_NAMES = ["src", "word", "n", "ciphers", "readings", "units", "letters"]
_READ_TYPES = [pa.string(), pa.string(), pa.int64(), *[pa.list_(pa.string())] * 2, *[pa.list_(pa.list_(pa.string()))] * 2]


def _read_words(words: DataFrame, ciphers: list[Cipher], alphabet: Alphabet, chain: np.ndarray, plain: float, worst: float = -8.0, most: int = 1_000_000) -> DataFrame:
    """Every word that has another reading nearly as probable as itself, with its (``most`` probable) readings."""
    sent = words.sparkSession.sparkContext.broadcast((ciphers, alphabet, chain, plain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = Books(*sent.value, worst)
        for batch in batches:
            rows = []
            for src, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                found = books.readings(word, src, most)
                if len(found) > 1:
                    rows.append((src, word, n, *map(list, zip(*found))))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_READ_TYPES)], names=_READ_NAMES)

    return words.select("src", "word", "n").mapInArrow(run, _READ)


def _weighed(read: DataFrame, alphabet: Alphabet, chain: np.ndarray, prior: dict[tuple[str, str], float]) -> DataFrame:
    """``read`` with ``p``, how probable each reading of a word is."""
    sent = read.sparkSession.sparkContext.broadcast((alphabet, chain, prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet_, chain_, prior_ = sent.value
        books = Books([], alphabet_, chain_, 0.0, 0.0)
        for batch in batches:
            p = []
            for src, ciphers, readings, letters in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 6))):
                score = np.array([(books.reading_score(r, x) if c else books.own_score(r)) + prior_.get((src, c), -12.0 if prior_ else -3.0 * (c != "")) for c, r, x in zip(ciphers, readings, letters)])
                w = np.exp(score - score.max())
                p.append((w / w.sum()).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.list_(pa.float64()))], names=[*_READ_NAMES, "p"])

    return read.select(*_READ_NAMES).mapInArrow(run, _READ + ", p array<double>")


def _garbled_bigrams(read: DataFrame, alphabet: Alphabet) -> np.ndarray:
    """The bigrams of the words themselves, each as often as it is probably garbled."""
    w = read.select("src", "word", (F.round((1 - F.col("p")[0]) * F.col("n"), 6) * _UNIT).cast("bigint").alias("n")).filter("n > 0")
    out = np.zeros((alphabet.other + 1,) * 2)
    known = set(alphabet.states)
    for pair, n in _bigrams(w).groupBy("pair").agg(F.sum("n")).collect():
        if pair[0] in known and pair[1] in known:
            out[alphabet.number[pair[0]], alphabet.number[pair[1]]] += n / _UNIT
    return out


def _held(words: DataFrame, ciphers: list[Cipher], alphabet: Alphabet, chain: np.ndarray, plain: float, least: int) -> list[Cipher]:
    """The ciphers that make known words: half of what they change, and ``least`` of them (one, for a known page), must stand
    elsewhere in the corpus, as a word or, for letters, as a run of three or more. Pages of UTF-8 that are known need no test."""
    tried = _read_words(words, ciphers, alphabet, chain, plain, worst=5.0, most=1)
    # each word speaks of the cipher that reads it best
    tried = tried.select("src", "word", F.col("ciphers")[1].alias("cipher"), F.col("readings")[1].alias("reading"))
    run = F.array_max(F.transform(F.regexp_extract_all("reading", F.lit("([^\\x00-\\x7f]{3,})")), lambda x: F.struct(F.length(x).alias("l"), x.alias("x"))))["x"]
    keys = F.when(F.col("cipher").startswith("utf-8"), F.array("reading")).otherwise(F.array("reading", run))
    # words of one or two letters are known whatever they come from: they count among the changed ones only
    asked = tried.select("src", "word", "cipher", F.explode(keys).alias("key")).filter("key is not null").withColumn("key", F.when(F.length("key") >= 3, F.col("key")))
    runs = words.select(F.explode(F.regexp_extract_all("word", F.lit("([^\\x00-\\x7f]{3,})"))).alias("key"))
    lexicon = words.select(F.col("word").alias("key")).union(runs).distinct().withColumn("known", F.lit(1))
    each = asked.join(lexicon, "key", "left").groupBy("src", "cipher", "word").agg(F.max("known").alias("known"))
    # by source for letters, whose ciphers are a source's; a page of bytes is the same everywhere
    tested = each.groupBy("src", "cipher").agg(F.count(F.lit(1)).alias("n"), F.count("known").alias("known")).collect()
    pages = Counter()
    for r in tested:
        pages[r.cipher, "n"] += r.n
        pages[r.cipher, "known"] += r.known
    swaps: dict[str, set[str]] = defaultdict(set)
    for r in tested:
        needed = least if "learnt" in r.cipher else 1
        if r.known >= needed and r.known >= 0.5 * r.n:
            swaps[r.cipher].add(r.src)
    out = []
    for c in ciphers:
        if c.bytes_:
            if "learnt" not in c.name or (pages[c.name, "known"] >= least and pages[c.name, "known"] >= 0.5 * pages[c.name, "n"]):
                out.append(c)
        else:
            out += [c._replace(src=s) for s in sorted(swaps.get(c.name, ()))]
    return out


def learn(texts: DataFrame, rounds: int = 8, *, start: bool = True, letters: int = 2000, least: int = 3) -> DataFrame:
    """``src, word, n, cipher, reading, units, letters, p``: the readings of each word that may be garbled, with their probabilities.

    ``texts`` has ``src, text``. Counts are over all texts; what is moved is one row for each distinct word of a source. The
    driver holds tables of sources x characters x bytes, at most ``letters`` characters. A learnt table is used if
    at least ``least`` distinct words become words that stand elsewhere in the corpus, and these are half of what it changes.
    ``start`` also offers the code pages of the standard library; without it only learnt tables are used.
    """
    words = materialize(_words(texts), "words")
    alphabet, counts, own, chars = _alphabet(words, letters)
    # small rows, much work: as many parts as there are cores
    parts = words.sparkSession.sparkContext.defaultParallelism
    high = materialize(words.filter(F.col("word").rlike("[^\\x00-\\x7f]")).repartition(parts, "word"), "high")
    contexts = materialize(_contexts(high).repartition(parts, "run"), "contexts")
    sources = [r.src for r in contexts.select("src").distinct().orderBy("src").collect()]
    total = counts.sum()
    ciphers: list[Cipher] = []
    garbled, swapped = np.zeros((alphabet.other + 1,) * 2), {}
    if sources and alphabet.letters:
        even = np.full((len(chars) + 1, 128), 1.0 / (len(chars) + 1))
        runs = contexts.filter("length(run) >= 2")
        _, gone, pairs = _rounds(runs, alphabet, counts, own, chars, dict.fromkeys(sources, even), True, rounds)
        for part in gone.values():
            garbled += _dense(part, alphabet)
        for i, page in enumerate(_pages(pairs, chars)):
            table = _completed(page) if start else {c: b for c, (b, _) in page.items()}
            ciphers.append(Cipher(f"utf-8>learnt {i + 1}", {c: chr(_PRIVATE + 128 + b) for c, b in table.items()}, True))
        votes = _votes(high, alphabet, chars)
        if votes:
            within = contexts.filter(F.col("src").isin(*votes))
            expected, swapped, _ = _rounds(within, alphabet, counts - garbled[:-1, :-1], own, chars, votes, False, max(1, rounds - 3))
            for src, e in expected.items():
                best, sure = e.argmax(1), e.max(1)
                table = {chars[i]: alphabet.letters[best[i]] for i in range(len(chars)) if sure[i] >= 1 and sure[i] >= 0.5 * e[i].sum() and not _one_letter(chars[i], alphabet.letters[best[i]])}
                if len(table) >= 3:
                    ciphers.append(Cipher(f"letters>learnt {src}", table, False, src))
    if start:
        ciphers += _standard_ciphers(frozenset(alphabet.letters))
    # tried without the words that the letters' tables explain, then without those of the tables that hold
    tried = garbled + sum(_dense(part, alphabet) for part in swapped.values())
    chain = transitions(counts - tried[:-1, :-1], total * 1e-6 + 20)
    ciphers = _held(high, ciphers, alphabet, chain, plain_enough(counts - tried[:-1, :-1], chain), least)
    held = {c.src for c in ciphers if c.name.startswith("letters>")}
    garbled += sum(_dense(part, alphabet) for src, part in swapped.items() if src in held)
    chain = transitions(counts - garbled[:-1, :-1], total * 1e-6 + 20)
    read = materialize(_read_words(high, ciphers, alphabet, chain, plain_enough(counts - garbled[:-1, :-1], chain)), "readings")
    prior: dict[tuple[str, str], float] = {}
    now = _weighed(read, alphabet, chain, prior)
    for turn in range(3):
        now = materialize(now, "weighed")
        chain = transitions(counts - _garbled_bigrams(now, alphabet)[:-1, :-1], 20.0)
        each = now.select("src", "n", F.explode(F.arrays_zip("ciphers", "p")).alias("r"))
        sums = each.groupBy("src", F.col("r.ciphers").alias("cipher")).agg(F.sum(F.round(F.col("n") * F.col("r.p"), 6).cast("decimal(30,6)")).alias("c")).collect()
        whole = Counter()
        for r in sums:
            whole[r.src] += float(r.c)
        prior = {(r.src, r.cipher): float(np.log((float(r.c) + 0.1) / (whole[r.src] + 1))) for r in sums}
        now = _weighed(read, alphabet, chain, prior)
    now = materialize(now, "weighed")
    each = now.select("src", "word", "n", F.explode(F.arrays_zip("ciphers", "readings", "units", "letters", "p")).alias("r"))
    return each.select("src", "word", "n", F.col("r.ciphers").alias("cipher"), F.col("r.readings").alias("reading"), F.col("r.units").alias("units"), F.col("r.letters").alias("letters"), F.col("r.p").alias("p"))


def mapping(learnt: DataFrame) -> DataFrame:
    """``src, unit, letter, weight``: what each garbled unit stands for in each source, the most probable letter only."""
    pairs = learnt.filter("cipher <> ''").select("src", (F.col("n") * F.col("p")).alias("w"), F.explode(F.arrays_zip("units", "letters")).alias("m"))
    by = pairs.groupBy("src", F.col("m.units").alias("unit"), F.col("m.letters").alias("letter")).agg(F.sum("w").alias("weight")).filter("weight > 0.5")
    # one row for each unit and letter is left: the best of a unit's few
    best = by.groupBy("src", "unit").agg(F.max(F.struct("weight", "letter")).alias("m"))
    return best.select("src", "unit", "m.letter", "m.weight")


def decisions(learnt: DataFrame) -> DataFrame:
    """``src, word, cipher, reading`` of each word whose most probable reading is not the word itself."""
    best = learnt.groupBy("src", "word").agg(F.max_by(F.struct("cipher", "reading", "units", "letters"), F.struct("p", F.expr("cipher = ''"), "cipher", "reading")).alias("b"))
    return best.select("src", "word", "b.*").filter("cipher <> ''")


#: Up to so many words are sent to every executor (some 300 bytes each); more are joined to the texts' words.
MOST_SENT = 200_000

_CIPHER_WORD = re.compile("[^A-Za-z]*[^\\x00-\\x7f][^A-Za-z]*")
_SPACE = re.compile(f"([{SPACES}]+)")
_GONE = re.compile("[\x80-\x9f\ufffd]")


def _lost(text: str) -> bool:
    """True where a control or replacement character stands, or a question mark between letters."""
    if _GONE.search(text):
        return True
    at = text.find("?")
    letter = lambda c: c.isalpha() or unicodedata.category(c)[0] == "M"
    while at >= 0:
        if 0 < at < len(text) - 1 and letter(text[at - 1]) and letter(text[at + 1]):
            return True
        at = text.find("?", at + 1)
    return False


def _put_back(text: str, to: dict[str, tuple]) -> str | None:
    """The text with its garbled words (word: reading, cipher, units, letters) read back; null without any."""
    parts = _SPACE.split(text)
    mine = [to[p] for p in parts if p in to]
    if not mine:
        return None
    # next to words of a single-byte cipher, words too short to judge by themselves belong to it: read with the same letters
    table = {ord(u): x for _, cipher, units, letters in mine if not cipher.startswith("utf-8") for u, x in zip(units, letters)}
    short = lambda p: len(p) <= 3 and all(ord(c) in table for c in p if ord(c) > 127)
    return "".join(to[p][0] if p in to else p.translate(table) if table and _CIPHER_WORD.fullmatch(p) and short(p) else p for p in parts)


_DONE = "src string, rec_id {kind}, text string, restored string, lost boolean"


def _restored_at_once(kept: DataFrame, fixes: DataFrame) -> DataFrame:
    """All texts in one pass with the words to put back at hand on every executor: nothing is shuffled."""
    to: dict[str, dict[str, tuple]] = defaultdict(dict)
    for batch in fixes.select("src", "word", "reading", "cipher", "units", "letters").toArrow().to_batches():
        for src, word, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            to[src][word] = tuple(rest)
    sent = kept.sparkSession.sparkContext.broadcast(dict(to))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, out, lost = [], [], []
            for i, (src, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                if text.isascii() and "?" not in text:
                    continue
                back = _put_back(text, sent.value.get(src, {}))
                gone = _lost(text if back is None else back)
                if back is not None or gone:
                    place.append(i)
                    out.append(text if back is None else back)
                    lost.append(gone)
            at = pa.array(place, pa.int32())
            yield pa.RecordBatch.from_arrays([*[c.take(at) for c in batch.columns], pa.array(out, pa.string()), pa.array(lost, pa.bool_())], names=["src", "rec_id", "text", "restored", "lost"])

    return kept.mapInArrow(run, _DONE.format(kind=kept.schema["rec_id"].dataType.simpleString()))


def _restored_by_join(kept: DataFrame, fixes: DataFrame) -> DataFrame:
    """The same for any number of words: each text's words are joined to those to put back."""
    rows = materialize(kept.withColumn("row", F.monotonically_increasing_id()), "rows")
    words = rows.select("row", "src", F.explode(F.array_distinct(F.split("text", f"[{SPACES}]+"))).alias("word")).filter(F.col("word").rlike("[^\\x00-\\x7f]"))
    mine = words.join(fixes, ["src", "word"]).groupBy("row").agg(F.collect_list(F.struct("word", "reading", "cipher", "units", "letters")).alias("fixes"))

    @F.udf("struct<restored:string,lost:boolean>", useArrow=True)
    def back(text: str, found: list | None) -> tuple[str, bool] | None:
        done = _put_back(text, {w: tuple(rest) for w, *rest in found or []})
        gone = _lost(text if done is None else done)
        return (text if done is None else done, gone) if done is not None or gone else None

    done = rows.join(mine, "row", "left").filter(F.col("fixes").isNotNull() | F.col("text").rlike(LOST)).withColumn("b", back("text", "fixes"))
    return done.filter("b is not null").select("src", "rec_id", "text", "b.restored", "b.lost")


def restore(texts: DataFrame, rounds: int = 8, *, start: bool = True, most_sent: int = MOST_SENT) -> DataFrame:
    """``src, rec_id, text, restored, lost`` of every garbled value: ``restored`` is the original as far as it can be read
    back, ``lost`` tells that replacement characters or the like remain, whose original is gone.

    ``texts`` has ``src, rec_id, text``. Values that are not garbled, null and empty ones are not returned; null ids
    are left out; repeated rows are returned as often as they stand there. See :func:`learn` for ``start``. Up to ``most_sent``
    words to put back are sent to the executors, more are joined; the result is the same.
    """
    kept = texts.filter("rec_id is not null and length(text) > 0").select("src", "rec_id", "text")
    fixes = materialize(decisions(learn(kept.select("src", "text"), rounds, start=start)), "fixes")
    return _restored_at_once(kept, fixes) if fixes.count() <= most_sent else _restored_by_join(kept, fixes)
