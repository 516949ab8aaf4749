"""What lies beyond the usual sizes and forms: long names, huge numbers, short phones, single names, hot phrases."""

import random
import time
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from reelspark.llm import lookalike, mixing, mojibake, names, neighbours, pii, rank_fusion


def rows(df):
    return [tuple(r) for r in df.collect()]


def linked(spark, aliases, mentions):
    out = names.link_names(spark.createDataFrame(aliases, "id bigint, name string"), spark.createDataFrame(mentions, "id bigint, name string"))
    return {i: e for e, k, i in rows(out) if k == "mention"}


LONG = " ".join(f"{a}ubilee{b}" for a in "bcdfgh" for b in "klmnp")


def test_name_of_thirty_words_with_two_errors(spark):
    typed = LONG.replace("bubileek", "bubilek").replace("hubileep", "hubileepp").title()
    assert len(LONG.split()) == 30
    assert linked(spark, [(1, LONG.title()), (2, "Quite Another Thing")], [(100, typed), (101, " ".join(reversed(typed.split())))]) == {100: 1, 101: 1}


def test_four_words_with_errors_in_three(spark):
    assert linked(spark, [(1, "Katarina Bergstrom Halvorsen Lindqvist"), (2, "Maria Petersen Olsen Dahl")], [(100, "Katarina Bergstrem Halvorsan Lindqvost")]) == {100: 1}


def test_long_word_with_two_errors():
    solid = "".join(random.Random(4).choice("abcdefghij") for _ in range(90))
    typed = solid[:20] + "z" + solid[20:60] + solid[61:]
    assert names.rewritings(solid) & names.rewritings(typed)


def test_rarer_rewriting_wins(spark):
    """A form that several entities' rows produce says less than one that only one entity's rows do."""
    aliases = [(1, "Anna Brook"), (2, "Anna Krantz"), (3, "Anna Kelso"), (4, "Ludmila Krantz")]
    assert linked(spark, aliases, [(100, "A. Brook"), (101, "Ludmila K")]) == {100: 1, 101: 4}


def test_huge_and_tiny_coordinates_are_usable(spark):
    v = [(1, [1e31, 0.0]), (2, [2e31, 1e29]), (3, [1e-30, 0.0]), (4, [float("inf"), 1.0]), (5, [float("nan"), 1.0]), (6, [0.0, 3e38])]
    df = spark.createDataFrame(v, "id bigint, v array<float>")
    kept = df.filter(neighbours.usable(F.col("v")))
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3, 6]
    near = {(a, b): round(c, 3) for a, b, c, _ in rows(neighbours.similar_vectors(kept, id="id", vector="v", groups=[], k=1, sure=2.0))}
    assert near[(1, 3)] == 1.0 and near[(3, 1)] == 1.0 and (2, 1) in near


def test_unsure_rows_are_answered_exactly(spark):
    """Random vectors share few buckets; with ``sure`` the stated query set gets all its neighbours, beside exact copies."""
    rng = np.random.default_rng(1)
    data = [(k, "g" if k % 3 else None, rng.normal(size=16).astype(np.float32).tolist()) for k in range(400)]
    data += [(1000 + k, "g", data[1][2]) for k in range(9)]
    df = spark.createDataFrame(data, "id bigint, g string, v array<float>")
    out = {}
    for a, b, _, p in rows(neighbours.similar_vectors(df, id="id", vector="v", groups=["g"], k=5, query=F.col("id") % 20 == 0, sure=0.8, rows_per_part=50)):
        out.setdefault(a, {})[p] = b
    unit = {k: np.array(v) / np.linalg.norm(v) for k, _, v in data}
    group = {k: g for k, g, _ in data}
    for q in [k for k in unit if k % 20 == 0]:
        best = sorted((-round(float(unit[q].astype(float) @ unit[o].astype(float)), 6), o) for o in unit if o != q and group[o] == group[q])[:5]
        assert [out[q][p] for p in range(1, 6)] == [o for _, o in best]


def test_loose_dense_bucket(spark):
    """Many rows of one bucket that are no tight cluster are compared in full."""
    rng = np.random.default_rng(2)
    base = np.eye(8)[0] * 3
    data = [(k, (base + rng.normal(size=8)).astype(np.float32).tolist()) for k in range(600)]
    df = spark.createDataFrame(data, "id bigint, v array<float>")
    near = neighbours.similar_vectors(df, id="id", vector="v", groups=[], k=5, min_cosine=0.9, full_bucket=100)
    got = {}
    for a, b, *_ in rows(near):
        got.setdefault(a, set()).add(b)
    u = np.array([v for _, v in data], dtype=float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    cos = u @ u.T
    np.fill_diagonal(cos, -1)
    wanted = [(i, j) for i in range(600) for j in np.argsort(-cos[i], kind="stable")[:5] if cos[i, j] >= 0.9]
    assert sum(j in got.get(i, ()) for i, j in wanted) >= 0.97 * len(wanted)


def kinds(text):
    return [(k, text[a:b]) for k, a, b, *_ in pii.spans(text)]


def test_short_phones_single_names_and_general_addresses():
    assert ("PHONE", "912 345 678") in kinds("ligue 912 345 678 hoje")
    assert ("PHONE", "555-0134") in kinds("phone 555-0134 now")
    assert ("CANDIDATE", "Tan") in kinds("Sr. Tan") and ("CANDIDATE", "John") in kinds("ask for John tomorrow")
    assert kinds("Hauptstraße 12, 10115 Berlin") == [("ADDRESS", "Hauptstraße 12, 10115 Berlin")]
    assert ("CANDIDATE", "Maria Clara de Souza Andrade Lima Pereira") in kinds("Maria Clara de Souza Andrade Lima Pereira")
    far = "gặp " + " " * 500 + "Nguyễn Văn An"
    assert pii.spans(far)[0][4] == "gặp"
    began = time.time()
    many = " ".join(f"a{k}@b.io" for k in range(20_000))
    assert len(pii.spans(many)) == 20_000 and time.time() - began < 20


def test_numbers_are_judged_by_what_stands_beside_them(spark):
    """No form knows this shape; the numbers that the forms find behind the same word teach that it is a phone number."""
    texts = [f"voz 0{k % 9 + 1}12 345 {6700 + k} agora" for k in range(200)] + [f"voz {k + 10}#{k + 10}-12 34 567 agora".replace("#", " ") for k in range(10)] + [f"lote {5261491 + k} hoje" for k in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    none = spark.createDataFrame([], "text string, type string")
    found = {i: t for i, _, _, _, t in rows(pii.find_pii(docs, none, id="id", text="text"))}
    assert all(found.get(k) == "PHONE" for k in range(210)) and not any(k in found for k in range(210, 410))


def test_a_stock_phrase_meets_its_variants_only(spark):
    """Twenty thousand equal rows and three variants: the pairs that there are, in seconds."""
    data = [("t", k, "cây cầu treo") for k in range(20_000)] + [("t", 50_000, "cây cầu treo"), ("t", 50_001, "cây cầu trеo"), ("t", 50_002, "cây​ cầu treo")]
    df = spark.createDataFrame(data, "src string, id bigint, text string")
    began = time.time()
    pairs = lookalike.same_look_pairs(df)
    assert pairs.count() == 3 * 20_000 + 3 and time.time() - began < 60
    members = {r.id: (r.spellings, r.rows) for r in lookalike.variant_members(df).filter("id >= 50000 or id = 7").collect()}
    assert members == {k: (4, 20_003) for k in (7, 50_000, 50_001, 50_002)}


def test_letters_of_other_fonts_and_scripts(spark):
    same = [("𝐀𝐫𝐢𝐚", "Aria"), ("Ⅰ", "I"), ("ℓight", "light"), ("ᎪᏟ", "AC"), ("Օk", "Ok"), ("𝟘𝟙", "01")]
    other = [("x²", "x2"), ("①", "1"), ("½", "1/2")]
    df = spark.createDataFrame([("t", 10 * k + j, x) for k, pair in enumerate(same + other) for j, x in enumerate(pair)], "src string, id bigint, text string")
    assert sorted(rows(lookalike.same_look_pairs(df).select("id_a", "id_b"))) == [(10 * k, 10 * k + 1) for k in range(len(same))]


def test_items_of_one_length_are_spread(spark):
    docs = spark.createDataFrame([(k, "a", 10) for k in range(3000)] + [(9000 + k, "b", 10) for k in range(3000)], "id bigint, s string, n bigint")
    targets = spark.createDataFrame([("a", 0.25, 1), ("b", 0.75, 1)], "source string, target_share double, max_repeats int")
    few, many = (mixing.mix(docs, targets, id="id", source="s", size="n", per_bucket=p) for p in (100, 10**6))
    for out in (few, many):
        assert {r.source: r.t for r in out.groupBy("source").agg(F.sum(F.col("n") * F.col("copies")).alias("t")).collect()} == {"a": 10_000, "b": 30_000}


def test_fusion_with_clashing_names_and_one_group(spark):
    df = spark.createDataFrame([("q", f"d{k}", float(k), -1.0) for k in range(50)], "q string, d string, x double, m double")
    out = rank_fusion.fuse_scores(df, group="q", item="d", scores={"x": (1.0, True), "m": (1.0, True)})
    assert [r.d for r in out.orderBy("fused_rank").limit(2).collect()] == ["d49", "d48"]


def test_words_of_every_pattern_vote(spark):
    """120 words of one pattern, many with equal counts, and some of smaller ones: the votes are those of all pairs of words."""
    rnd = random.Random(9)
    letters = list("абвгде")
    data = [(rnd.choice("st"), "".join(w), rnd.choice([1, 1, 2, 5, 40])) for w in permutations(letters, 3)]
    data += [("t", w, 3) for _, w, _ in data[::4]] + [("s", "x" + "".join(w), 2 + i) for i, w in enumerate(permutations("абв", 2))] + [("t", "еxе", 4), ("s", "аxа", 7), ("t", "ггдд", 9)]
    data = list({(s, w): (s, w, n) for s, w, n in data}.values())
    total, alike = Counter(), defaultdict(set)
    for _, w, n in data:
        total[w] += n
        alike[mojibake._pattern(w)].add(w)
    assert max(map(len, alike.values())) == 120
    votes = defaultdict(lambda: np.full((len(letters) + 1, len(letters)), 1e-3))
    for s, w, _ in data:
        better = [x for x in alike[mojibake._pattern(w)] if x != w and total[x] >= total[w]]
        for x in better:
            for a, b in {(a, b) for a, b in zip(w, x) if a != b}:
                votes[s][letters.index(a), letters.index(b)] += (total[x] / sum(total[y] for y in better)) ** 2
    got = mojibake._votes(spark.createDataFrame(data, "src string, word string, n bigint").repartition(7), mojibake.Alphabet(letters), letters)
    assert set(got) == {"s", "t"}
    for s, v in votes.items():
        assert np.allclose(got[s], v / v.sum(0, keepdims=True), atol=1e-7)


def test_a_row_goes_once_to_the_buckets_of_its_nearest_axis():
    """Two rows a table instead of three, for the same buckets; with blocks more rows, and still the same buckets."""
    unit = np.random.default_rng(4).normal(size=(500, 24))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    hash_ = neighbours.CrossPolytope(24, 5, 8, 5)
    for table in range(5):
        codes = hash_.codes(unit, table, 2)
        for blocks, sent in ((1, [1000]), (4, range(1001, 1500)), (16, [1500])):
            got, homes, n = defaultdict(set), {}, 0
            for at, part, one, two, home in hash_.places(unit, table, 2, blocks):
                n += len(at)
                for i, p, x, y in zip(at, part, one, two):
                    assert x % blocks == p % blocks and (y < 0 or y % blocks == p % blocks)
                    got[i] |= {p // blocks * 16 + z for z in (x, y) if z >= 0}
                    if home:
                        homes[i] = p // blocks * 16 + x
            assert n in sent, (blocks, n)
            assert all(got[i] == set(codes[i]) and homes[i] == codes[i, 0] for i in range(500))


def test_parts_do_not_change_the_result(spark):
    """Whole parts, parts of some buckets and full buckets in squares give the same neighbours."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(300, 16))
    v = centres[rng.integers(0, 300, 1500)] + 0.2 * rng.normal(size=(1500, 16))
    df = spark.createDataFrame([(i, x.astype(np.float32).tolist()) for i, x in enumerate(v)], "id bigint, v array<float>")
    near = lambda **kw: sorted(rows(neighbours.similar_vectors(df, id="id", vector="v", groups=[], k=5, min_cosine=0.9, rows_per_bucket=8, query=F.col("id") % 3 < 2, **kw)))
    whole = near()
    assert len(whole) > 2000 and near(part_bytes=400) == whole and near(full_bucket=10) == whole and near(part_bytes=400, full_bucket=10) == whole
