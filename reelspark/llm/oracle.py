"""SQL that gives the same rows as a query of this subpackage, where SQL can express the operator."""

from __future__ import annotations

from reelspark.llm import lookalike, rank_fusion

_P2 = """
with o as (
  select o.ocr_id, o.video_id, cast(round((s.start_seconds + o.scene_local_time_seconds) * 1e6) as bigint) as t
  from ocr_records o join scenes s using (video_id, scene_id)
  where s.start_seconds is not null and o.scene_local_time_seconds is not null and o.ocr_id is not null
), c as (
  select cue_id, video_id, cast(round((start_seconds + case when end_seconds < start_seconds then start_seconds else end_seconds end) / 2 * 1e6) as bigint) as t
  from subtitle_cues where start_seconds is not null and end_seconds is not null and cue_id is not null
)
select ocr_id, cue_id from (
  select o.ocr_id, c.cue_id, row_number() over (partition by o.ocr_id order by abs(o.t - c.t), c.cue_id) as r
  from o join c on o.video_id = c.video_id and c.t between o.t - 1500000 and o.t + 1500000
) where r = 1
"""


def _horner(x: str, coefficients) -> str:
    out = repr(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c!r})"
    return out


def _inverse_normal(p: str) -> str:
    f = rank_fusion
    tail = lambda q: f"{_horner(q, f._C)} / {_horner(q, (*f._D, 1.0))}"
    return (
        f"case when {p} < {f._LOW} then {tail(f'sqrt(-2 * ln({p}))')} when {p} > {1 - f._LOW!r} then -({tail(f'sqrt(-2 * ln(1 - {p}))')}) "
        f"else ({p} - 0.5) * {_horner(f'(({p} - 0.5) * ({p} - 0.5))', f._A)} / {_horner(f'(({p} - 0.5) * ({p} - 0.5))', (*f._B, 1.0))} end"
    )


_P3 = f"""
with items as (
  select query_id, document_id, -min(bm25_score) as s0, max(semantic_score) as s1, max(entity_score) as s2, max(reranker_score) as s3
  from search_hits where query_id is not null and document_id is not null group by all
), long as (
  select query_id, document_id, 0 as m, s0 as s from items union all select query_id, document_id, 1, s1 from items
  union all select query_id, document_id, 2, s2 from items union all select query_id, document_id, 3, s3 from items
), pct as (
  select query_id, document_id, s, (rank() over (partition by query_id, m order by s) - 1 + count(*) over (partition by query_id, m, s) / 2.0)
    / count(*) over (partition by query_id, m) as p from long where s is not null
), z as (
  select l.query_id, l.document_id, avg({_inverse_normal('p')}) as fused_score, count(p) as n_scores
  from items l left join pct using (query_id, document_id) group by all
)
"""

def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_LOOK = f"trim(regexp_replace(regexp_replace(nfc_normalize(replace(replace(translate(text, {_quoted(lookalike._FROM)}, {_quoted(lookalike._TO)}), 'ﬁ', 'fi'), 'ﬂ', 'fl')), ' {{2,}}', ' ', 'g'), ' ?\\n ?', '\n', 'g'))"
_P5 = f"""
with t as (
  select 'documents' as src, doc_id as id, combined_text as text from documents union all select 'ocr_records', ocr_id, text from ocr_records
  union all select 'subtitle_cues', cue_id, text from subtitle_cues
), k as (select src, id, text, {_LOOK} as look from t where length(text) > 0)
select distinct a.src, a.id as id_a, b.id as id_b from k a join k b on a.src = b.src and a.look = b.look and a.id < b.id and a.text <> b.text
"""

_P4 = """
with v as (
  select cache_id, provider, model, dimension, vector::double[] as v from embeddings_cache
  where vector is not null and len(vector) = dimension and list_sum(list_transform(vector, lambda x: abs(x))) > 0
), p as (
  select a.cache_id as a, b.cache_id as b, round(list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)), 9) as c
  from v a join v b on a.provider = b.provider and a.model = b.model and a.dimension = b.dimension and a.cache_id <> b.cache_id
), r as (select a, b from (select *, row_number() over (partition by a order by c desc, b) as n from p) where n <= 5 and c >= 0.9)
select x.a as cache_id_a, x.b as cache_id_b from r x join r y on x.a = y.b and x.b = y.a where x.a < x.b
"""

# the same brute force for the stated query set, whatever the similarity
_P4_STATED = _P4[: _P4.index("), r as")].replace("a.cache_id <> b.cache_id", "a.cache_id <> b.cache_id and a.cache_id % 20 = 0") + """), r as (
  select a as query_id, b as cache_id, round(c, 6) as similarity, row_number() over (partition by a order by c desc, b) as place from p)
select query_id, cache_id, similarity, place::int as place from r where place <= 5
"""

# one form for each class: the most frequent spelling, of equally frequent ones the smallest
_P5_CLASSES = _P5[: _P5.index("select distinct a.src")] + """, s as (select src, look, text, count(*) as n from k group by all),
c as (select src, look, first(text order by n desc, text) as canonical, count(*) as spellings from s group by all)
"""

ORACLE: dict[str, str] = {
    "p4_neighbours": _P4_STATED,
    "p5_consistent": _P5_CLASSES + "select t.src, t.id, coalesce(c.canonical, t.text) as canonical from t left join k on t.src = k.src and t.id = k.id left join c on c.src = k.src and c.look = k.look and c.spellings > 1",
    "p4_found": _P4,
    "p5_found": _P5,
    "p2_found": _P2,
    "p3_fused": _P3 + "select query_id, document_id, round(fused_score, 6) as fused_score, n_scores from z",
    "p3_found": _P3 + """select query_id, document_id from (select *, row_number() over (partition by query_id
      order by round(fused_score, 9) desc nulls last, document_id) as r from z) where r <= 5""",
}
