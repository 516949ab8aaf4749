"""SQL that gives the same rows as a core query on the same tables."""

from __future__ import annotations

from reelspark.functions import text as X
from reelspark.operators import planner as P
from reelspark.operators.fusion import WEIGHTS
from reelspark.operators.lexical import FIELD_WEIGHTS
from reelspark.plans.queries import SEARCHES


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(map(_lit, words)) + "]"


def _fold(e: str) -> str:
    return f"regexp_replace(replace(translate(lower({e}), {_lit(X.FOLD_FROM)}, {_lit(X.FOLD_TO)}), 'ß', 'ss'), '\\p{{M}}+', '', 'g')"


def _tokens(e: str) -> str:
    return f"coalesce(regexp_extract_all({_fold(e)}, '[\\p{{L}}\\p{{N}}]+'), []::varchar[])"


def _raw(e: str) -> str:
    return f"coalesce(regexp_extract_all({e}, '[\\p{{L}}\\p{{N}}]+'), []::varchar[])"


def _terms(e: str) -> str:
    return f"list_filter({_tokens(e)}, lambda t: length(t) >= 2 and not list_contains({_list(X.STOPWORDS)}, t))"


def _key(e: str) -> str:
    return f"array_to_string({_tokens(e)}, ' ')"


_WIDE, _PLAIN = "".join(map(chr, range(0xFF01, 0xFF5F))), "".join(map(chr, range(0x21, 0x7F)))


def _norm_key(e: str) -> str:
    return f"regexp_replace(lower(translate({e}, {_lit(_WIDE)}, {_lit(_PLAIN)})), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


def _clean(e: str) -> str:
    """Without HTML entities, which DuckDB cannot resolve and the test tables do not have."""
    blank = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
    return f"trim(regexp_replace(nfc_normalize(regexp_replace(replace({e}, chr(65279), ' '), '<[^>]+>', ' ', 'g')), '{blank}', ' ', 'g'))"


def _repaired(e: str) -> str:
    """UTF-8 read as Latin-1 read back where all characters allow it and fewer marks of it are left."""
    count = lambda c: " + ".join(f"(length({c}) - length(replace({c}, {_lit(m)}, ''))) // {len(m)}" for m in X.MOJIBAKE_MARKERS)
    back = f"(case when regexp_full_match({e}, '[\\x{{00}}-\\x{{ff}}]*') then try(decode(from_hex(array_to_string(list_transform(string_split({e}, ''), lambda c: printf('%02x', unicode(c))), '')))) end)"
    return f"(case when ({count(e)}) > 0 and {back} is not null and ({count(back)}) < ({count(e)}) then {back} else {e} end)"


_DOCS = "docs as (select * from documents where document_id is not null qualify row_number() over (partition by document_id order by generated_at desc nulls last, doc_id desc) = 1)"
_SEARCHES = "searches(query_id, query) as (values " + ", ".join(f"({_lit(a)}, {_lit(b)})" for a, b in SEARCHES) + ")"
_TF = f"tf as (select document_id, term, count(*) as tf from (select document_id, unnest({_terms('combined_text')}) as term from docs) group by all)"
_IDF = """n as (select greatest(count(distinct document_id), 1) as n from tf),
idf as (select term, count(*) as document_frequency, ln((any_value(n.n) + 1) / (count(*) + 1)) + 1 as inverse_document_frequency from tf, n group by term)"""
_NORMS = """norms as (select document_id, case when sqrt(sum(((1 + ln(tf)) * inverse_document_frequency) ** 2)) > 0 then sqrt(sum(((1 + ln(tf)) * inverse_document_frequency) ** 2)) else 1 end as vector_norm
from tf join idf using (term) group by 1)"""
_QTERMS = f"asked as (select distinct query_id, unnest(case when len({_terms('query')}) > 0 then {_terms('query')} else {_tokens('query')} end) as term from searches)"
_BM25 = (
    "words as (" + " union all ".join(f"select document_id, {w} as w, unnest({_tokens(f)}) as term from docs" for f, w in FIELD_WEIGHTS.items()) + "), "
    + "lengths as (select document_id, " + " + ".join(f"len({_tokens(f)})" for f in FIELD_WEIGHTS) + " as dl from docs), "
    + """total as (select count(*) as n, avg(dl) as avgdl from lengths),
hits as (select document_id, term, sum(w) as f from words where term in (select term from asked) group by all),
df as (select term, count(*) as df from hits group by 1),
bm25 as (select query_id, document_id, round(-sum((case when ln((n - df + 0.5) / (df + 0.5)) <= 0 then 1e-6 else ln((n - df + 0.5) / (df + 0.5)) end)
  * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / avgdl))), 9) as bm25_score
  from hits join df using (term) join lengths using (document_id) join asked using (term), total group by all)"""
)
_TRIM = lambda e: f"trim(regexp_replace(regexp_replace({e}, '\\s+', ' ', 'g'), '^[ .,:;!?()\\[\\]{{}}\"'']+|[ .,:;!?()\\[\\]{{}}\"'']+$', '', 'g'))"
_ALIASES = f"""aliases0 as (select {_TRIM('canonical')} as canonical, coalesce(upper(trim(type)), 'MISC') as entity_type, unnest(list_concat([canonical], coalesce(aliases, []))) as raw from entity_aliases),
aliases1 as (select canonical, entity_type, {_TRIM('raw')} as alias from aliases0),
dim as (select distinct canonical, {_key('canonical')} as canonical_key, entity_type, alias, {_key('alias')} as alias_key from aliases1 where {_key('canonical')} <> '' and {_key('alias')} <> '')"""
_ENTITIES = f"""listed0 as (select document_id, unnest(entities) as e, generate_subscripts(entities, 1) - 1 as ordinal from docs),
listed as (select document_id, ordinal, e.text as entity_text, upper(e.type) as entity_type, {_key('e.text')} as alias_key from listed0 where length(e.text) >= 2),
named as (select l.document_id, l.entity_type, coalesce(d.canonical, l.entity_text) as canonical from listed l left join (select distinct alias_key, entity_type, canonical from dim) d using (alias_key, entity_type)),
canon as (select distinct document_id, {_key('canonical')} as canonical_key, entity_type from named)"""
_KEYS = f"keys as (select distinct query_id, canonical_key from searches, dim where contains(' ' || {_key('query')} || ' ', ' ' || alias_key || ' '))"
_MERGED = (
    "hits as (select * from search_hits where query_id is not null and document_id is not null), "
    "merged as (select query_id, document_id, " + ", ".join(f"min({n}_rank) as {n}_rank" for n in WEIGHTS)
    + ", max(entity_overlap) as entity_overlap from hits where " + " or ".join(f"{n}_rank is not null" for n in WEIGHTS) + " group by all), "
    + "scored as (select *, round(" + " + ".join(f"coalesce({w} / (60 + {n}_rank), 0)" for n, w in WEIGHTS.items()) + f" + 0.005 * {WEIGHTS['entity']} * coalesce(entity_overlap, 0), 9) as final_score from merged), "
    + """ranked as (select *, row_number() over (partition by query_id order by final_score desc, case when bm25_rank is not null then 0 when semantic_rank is not null then 1 else 2 end,
  coalesce(bm25_rank, semantic_rank, entity_rank), document_id) as final_rank from scored)"""
)
_LINES = f"""lines0 as (select ocr_id, video_id, unnest(lines) as l, generate_subscripts(lines, 1) - 1 as line_no from ocr_records),
lines1 as (select ocr_id, video_id, line_no, coalesce(l.confidence, 0) as confidence, {_norm_key('nfc_normalize(' + _repaired('l.text') + ')')} as key from lines0),
lines as (select * from lines1 where confidence >= 0.5 and length(key) > 0 qualify row_number() over (partition by ocr_id, key order by line_no) = 1)"""
_REPEATED = """repeated as (select k.video_id, key, frames from (select video_id, key, count(distinct ocr_id) as frames from lines group by all) k
join (select video_id, count(*) as records from ocr_records group by 1) r using (video_id) where frames >= greatest(3, floor(records * 0.5 + 0.999999)))"""
_UNIT_CACHE = "v as (select cache_id, provider, model, dimension, vector::double[] as v from embeddings_cache where vector is not null and len(vector) = dimension and list_sum(list_transform(vector, lambda x: abs(x))) > 0)"
_LABELS = """labels as (select distinct query_id, document_id from search_hits where reranker_score > 0),
runs as (select mode, query_id, document_id, min(rank) as rank from (
  select 'bm25' as mode, query_id, document_id, bm25_rank as rank from search_hits union all select 'semantic', query_id, document_id, semantic_rank from search_hits
  union all select 'entity', query_id, document_id, entity_rank from search_hits) where rank is not null group by all),
size as (select query_id, count(*) as labels from labels group by 1),
met as (select mode, query_id, min(rank) as first_relevant_rank, count(*) filter (rank <= 5) as h5, count(*) filter (rank <= 10) as h10 from runs join labels using (query_id, document_id) group by all),
details as (select m.mode, s.query_id, first_relevant_rank, coalesce(h5, 0) / labels as recall_at_5, coalesce(h10, 0) / labels as recall_at_10, coalesce(1 / first_relevant_rank, 0) as reciprocal_rank
  from size s cross join (select distinct mode from runs) m left join met on met.mode = m.mode and met.query_id = s.query_id)"""
_FRAMES = "frames as (select l_orderkey, l_linenumber as frame_index, l_quantity * 2 as sharpness, l_quantity * 5 as brightness, l_discount as motion from lineitem)"
_STATES = """states as (select user_id, event_type, case when value >= 50 then 'done' else 'failed' end as status from events where user_id is not null
  qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1)"""
_ELIGIBLE = "pool as (select * from docs where length(combined_text) >= 120)"


def _with(*parts: str) -> str:
    return "with " + ", ".join(parts) + " "


def _plan_sql() -> str:
    any_of = lambda words: f"list_has_any(tokens, {_list(words)})"
    return f"""with q as (select 'c' || cue_id as query_id, text as query from subtitle_cues where length(text) > 0),
base as (select query_id, query, {_tokens('query')} as tokens, len(list_distinct({_terms('query')})) as n from q),
sig as (select query_id, n, {any_of(P.FRAME_WORDS)} as frame, {any_of(P.SEMANTIC_WORDS)} as semantic, regexp_matches(query, '[''"].+[''"]') or {any_of(P.EXACT_WORDS)} as exact,
  regexp_matches(query, '(^|[^\\p{{L}}\\p{{N}}_])[A-ZĐ][A-ZĐ0-9_-]{{2,}}($|[^\\p{{L}}\\p{{N}}_])') as upper_, len(tokens) > 0 as tok from base),
s as (select *, tok or upper_ as entity, semantic or n >= 4 as meaning from sig), p as (select *, n <= 2 and entity and not semantic as short from s)
select query_id, 'hybrid' as mode, case when frame or exact or (entity and (upper_ or n <= 2)) then 'both' else 'scene' end as level,
 case when meaning and not short then 'cross' else 'none' end as reranker,
 case when meaning and not short then 60 when short then 40 else 50 end as candidate_limit, 50 as rerank_top, case when exact then 1.35 else 1.0 end as bm25_weight,
 case when short then 0.0 when meaning then 1.0 when exact then 0.75 else 1.0 end as semantic_weight, case when entity then 0.65 else 0.35 end as entity_weight from p"""


ORACLE: dict[str, str] = {
    "latest_documents": _with(_DOCS) + "select document_id, doc_id, generated_at from docs",
    "term_frequency": _with(_DOCS, _TF) + "select * from tf",
    "idf_stats": _with(_DOCS, _TF, _IDF) + "select term, document_frequency, round(inverse_document_frequency, 9) as inverse_document_frequency from idf",
    "document_norms": _with(_DOCS, _TF, _IDF, _NORMS) + "select document_id, round(vector_norm, 6) as vector_norm from norms",
    "tfidf_search": _with(_DOCS, _TF, _IDF, _NORMS, _SEARCHES) + f""", qt as (select query_id, term, count(*) as qtf from (select query_id, unnest({_terms('query')}) as term from searches) group by all),
q as (select query_id, term, (1 + ln(qtf)) * inverse_document_frequency as qw, inverse_document_frequency as i from qt join idf using (term)),
qn as (select query_id, sqrt(sum(qw * qw)) as qnorm from q group by 1),
s as (select query_id, document_id, round(sum(qw * (1 + ln(tf)) * i) / (any_value(qnorm) * any_value(vector_norm)), 9) as s from tf join q using (term) join qn using (query_id) join norms using (document_id) group by all),
r as (select *, row_number() over (partition by query_id order by s desc, document_id) as tfidf_rank from s)
select query_id, document_id, round(s, 6) as tfidf_score, tfidf_rank from r where tfidf_rank <= 50""".replace("with ", "", 0),
    "bm25_scores": _with(_DOCS, _SEARCHES, _QTERMS, _BM25) + "select query_id, document_id, round(bm25_score, 6) as bm25_score from bm25",
    "bm25_search": _with(_DOCS, _SEARCHES, _QTERMS, _BM25, _ALIASES, _ENTITIES, _KEYS) + f""", wide as (select * from bm25 qualify row_number() over (partition by query_id order by bm25_score, document_id) <= 80),
flagged as (select distinct query_id, document_id from canon join keys using (canonical_key)),
qts as (select query_id, list(term) as qt from asked group by 1),
o as (select w.query_id, w.document_id, w.bm25_score, f.document_id is not null as entity_hit, len(list_intersect(qt, {_tokens('combined_text')})) as overlap
  from wide w join docs using (document_id) join qts using (query_id) left join flagged f on f.query_id = w.query_id and f.document_id = w.document_id),
r as (select *, row_number() over (partition by query_id order by entity_hit desc, overlap desc, bm25_score, document_id) as bm25_rank from o)
select query_id, document_id, round(bm25_score, 6) as bm25_score, entity_hit, overlap, bm25_rank from r where bm25_rank <= 20""",
    "fts_match": _with(_DOCS, _SEARCHES, _QTERMS) + "select distinct query_id, document_id from (" + " union all ".join(f"select document_id, unnest({_tokens(f)}) as term from docs" for f in FIELD_WEIGHTS) + ") join asked using (term)",
    "entity_email": r"select distinct doc_id, unnest(regexp_extract_all(text, '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b')) as entity_text, 'EMAIL' as entity_type from documents",
    "alias_dimension": _with(_ALIASES) + "select * from dim",
    "alias_containment": _with(_DOCS, _ALIASES) + f""", t as (select document_id, ' ' || {_key('combined_text')} || ' ' as padded from docs)
select distinct document_id, alias_key, canonical_key, entity_type from t, dim where contains(padded, ' ' || alias_key || ' ')""",
    "canonical_entities": _with(_DOCS, _ALIASES, _ENTITIES) + "select * from canon",
    "entity_search": _with(_DOCS, _ALIASES, _ENTITIES, _SEARCHES, _KEYS) + """, m as (select query_id, document_id, count(distinct canonical_key) as matched, 0.9 as confidence from canon join keys using (canonical_key) group by all),
r as (select query_id, document_id, matched, confidence, row_number() over (partition by query_id order by matched desc, confidence desc, coalesce(length(combined_text), 0) desc, document_id) as entity_rank from m join docs using (document_id))
select query_id, document_id, round(matched + confidence / 10, 6) as entity_score, matched as entity_overlap, entity_rank from r where entity_rank <= 50""",
    "adaptive_plan": _plan_sql(),
    "vector_normalize": "with " + _UNIT_CACHE + """, l as (select c.document_id, c.model, v.v, list_dot_product(v.v, v.v) as d, c.updated_at, c.cache_id, c.provider, c.dimension from v join embeddings_cache c using (cache_id)
  where c.document_id is not null qualify row_number() over (partition by c.document_id, c.provider, c.model, c.dimension order by c.updated_at desc nulls last, c.cache_id desc) = 1)
select document_id, model, dimension, i - 1 as i, round(v[i] / sqrt(d), 5) + 0.0 as x from l, unnest(range(1, len(v) + 1)) as t(i)""",
    "semantic_knn": """with e as (select vec_id, embedding::double[] as v from embeddings),
s as (select q.vec_id as query_id, e.vec_id, round(list_dot_product(q.v, e.v) / sqrt(list_dot_product(q.v, q.v) * list_dot_product(e.v, e.v)), 9) as s from e q, e where q.vec_id % 20 = 0 and q.vec_id <> e.vec_id),
r as (select *, row_number() over (partition by query_id order by s desc, vec_id) as place from s) select query_id, vec_id, round(s, 6) as similarity, place from r where place <= 10""",
    "cache_knn": "with " + _UNIT_CACHE + """, s as (select q.cache_id as query_id, v.cache_id, round(list_dot_product(q.v, v.v) / sqrt(list_dot_product(q.v, q.v) * list_dot_product(v.v, v.v)), 9) as s
  from v q join v on len(q.v) = len(v.v) where q.cache_id % 20 = 0 and q.cache_id <> v.cache_id),
r as (select *, row_number() over (partition by query_id order by s desc, cache_id) as place from s) select query_id, cache_id, round(s, 6) as similarity, place from r where place <= 5""",
    "label_centroids": """with x as (select label, vec_id, generate_subscripts(embedding, 1) as i, unnest(embedding)::double as x from embeddings),
m as (select label, i, avg(x) as m, count(*) as n from x group by all) select label, n as members, (i - 1)::int as i, round(m, 6) + 0.0 as x from m""",
    "histogram_distance": """with e as (select vec_id, label, list_transform(embedding::double[], lambda x: abs(x)) as h from embeddings),
p as (select a.vec_id, a.label, case when b.vec_id is null then 1.0 else sqrt(greatest(0, 1 - list_dot_product(list_transform(a.h, lambda x: sqrt(x)), list_transform(b.h, lambda x: sqrt(x))) / sqrt(list_sum(a.h) * list_sum(b.h)))) end as d
  from e a left join e b on a.label = b.label and b.vec_id % 20 = 0) select vec_id, label, round(min(d), 5) as distance from p group by all""",
    "embedding_misses": _with(_DOCS) + """select document_id, sha256(combined_text) as text_hash from docs where length(combined_text) > 0 and not exists (select 1 from embeddings_cache c
  where c.document_id = docs.document_id and c.text_hash = sha256(docs.combined_text) and provider = 'hashing' and model = 'token-bigram-v1' and dimension = 64)""",
    "merged_hits": _with(_MERGED) + "select query_id, document_id, bm25_rank::double as bm25_rank, semantic_rank::double as semantic_rank, entity_rank::double as entity_rank, entity_overlap from merged",
    "hybrid_rrf": _with(_MERGED) + "select query_id, document_id, final_score, final_rank from ranked where final_rank <= 10",
    "rerank_blend": _with(_MERGED) + """, best as (select query_id, document_id, max(reranker_score) as reranker_score from hits group by all),
head0 as (select r.query_id, r.document_id, r.final_score, b.reranker_score, least(r.entity_overlap, 5) / 5 as coverage, r.entity_overlap, row_number() over (partition by r.query_id order by r.final_score desc, r.document_id) as n
  from ranked r join best b using (query_id, document_id) where r.final_rank <= 50),
head as (select * from head0 where n <= 20 and reranker_score is not null),
w as (select *, min(final_score) over (partition by query_id) as lo, max(final_score) over (partition by query_id) as hi from head),
b as (select *, round(0.60 / (1 + exp(-greatest(-30, least(30, reranker_score)))) + 0.25 * (case when hi > lo then (final_score - lo) / (hi - lo) else 1 end) + 0.10 * coverage
  + 0.05 * (case when entity_overlap > 0 then 1 else 0 end), 9) as blended from w),
c as (select *, first_value(reranker_score) over (partition by query_id order by blended desc, document_id) as top from b)
select query_id, document_id, round(blended, 6) as final_score, row_number() over (partition by query_id order by blended desc, document_id) as rerank_rank from c where blended >= 0.2 and reranker_score >= top - 6""",
    "cue_scene_overlap": """select c.video_id, s.scene_id, c.cue_id from subtitle_cues c join scenes s on c.video_id = s.video_id and greatest(c.start_seconds, c.end_seconds) > s.start_seconds and c.start_seconds < s.end_seconds
where c.start_seconds is not null and s.start_seconds is not null and s.end_seconds is not null""",
    "cue_at_frame": """select o.ocr_id, c.cue_id from ocr_records o join scenes s using (video_id, scene_id) join subtitle_cues c on c.video_id = o.video_id
and s.start_seconds + o.scene_local_time_seconds between c.start_seconds and c.end_seconds""",
    "ocr_lines": _with(_LINES) + "select ocr_id, line_no, key, confidence from lines",
    "repeated_ocr_keys": _with(_LINES, _REPEATED) + "select * from repeated",
    "keyframe_table": _with(_LINES, _REPEATED) + """, per as (select ocr_id, string_agg(l.key, '|' order by line_no) filter (r.key is null) as kept, string_agg(l.key, '|' order by line_no) filter (r.key is not null) as removed, round(avg(confidence) filter (r.key is null), 6) as c
  from lines l left join repeated r using (video_id, key) group by 1)
select o.ocr_id, row_number() over (partition by o.video_id, o.scene_id order by keyframe_path nulls first, o.ocr_id) - 1 as keyframe_no, coalesce(kept, '') as kept, coalesce(removed, '') as removed, c as ocr_confidence_mean
from ocr_records o join scenes s using (video_id, scene_id) left join per using (ocr_id)""",
    "clean_texts": f"select cue_id, {_clean('text')} as clean from subtitle_cues",
    "mojibake_repair": f"select cue_id, text, {_repaired('text')} as repaired from subtitle_cues where {_repaired('text')} <> text",
    "preferred_subtitles": f"""with c0 as (select cue_id, video_id, start_seconds as s, greatest(end_seconds, start_seconds) as e, {_clean(_repaired('text'))} as text, coalesce(language, 'unknown') as language
  from subtitle_cues where video_id is not null and start_seconds is not null),
c as (select *, {_norm_key('text')} as key from c0 where length(text) > 0),
once as (select c.*, sc.scene_id from c join scenes sc on c.video_id = sc.video_id and c.e > sc.start_seconds and c.s < sc.end_seconds
  qualify row_number() over (partition by c.video_id, sc.scene_id, c.language, c.s, c.e, c.key order by c.cue_id) = 1),
chosen as (select *, first_value(language) over (partition by video_id, scene_id order by case language when 'vi' then 1 when 'en' then 2 when 'vi-orig' then 3 else 4 end, language) as ch from once),
r as (select * from chosen where language = ch and length(key) > 0 qualify row_number() over (partition by video_id, scene_id, key order by s, e, cue_id) = 1)
select video_id, scene_id, any_value(ch) as subtitle_language, string_agg(text, ' ' order by s, e, cue_id) as subtitle_text from r group by 1, 2""",
    "manifest_summary": _with(_DOCS) + """select count(distinct video_id) as videos, count(*) as documents, count(*) filter (length(subtitle_text) > 0) as with_subtitles, count(*) filter (length(ocr_text) > 0) as with_ocr,
count(*) filter (length(combined_text) > 0) as searchable, 0.5 as min_confidence from docs""",
    "search_keys": f"select cue_id, {_key('text')} as search_key, {_norm_key('nfc_normalize(text)')} as normalized_key from subtitle_cues where text is not null",
    "sentence_split": f"""with s as (select doc_id, unnest(string_split_regex(regexp_replace(text, '([.!?])\\s+', '\\1\n', 'g'), '\n+')) as s from documents where length(text) > 0),
t as (select doc_id, trim(regexp_replace(s, '\\s+', ' ', 'g')) as sentence from s) select doc_id, sentence, len({_raw('sentence')}) as n_tokens from t where sentence <> ''""",
    "chunk_packing": r"""with d as (select doc_id, list_filter(list_transform(string_split_regex(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'), '\n+'), lambda s: trim(regexp_replace(s, '\s+', ' ', 'g'))), lambda s: s <> '') as items
  from documents where length(text) > 0),
c as (select doc_id, list_reduce(items, lambda acc, s: case when len(acc) > 0 and length(acc[-1]) + 1 + length(s) <= 600 then list_append(list_slice(acc, 1, len(acc) - 1), acc[-1] || ' ' || s) else list_append(acc, s) end, []::varchar[]) as chunks from d)
select doc_id, (i - 1)::int as chunk_no, chunks[i] as chunk from c, unnest(range(1, len(chunks) + 1)) as t(i)""",
    "hit_links": _with(_DOCS) + """select document_id, 'https://www.youtube.com/watch?v=' || video_id || '&t=' || greatest(round_even(coalesce(start_seconds, 0), 0), 0)::bigint || 's' as url,
substring(regexp_replace(regexp_replace(combined_text, '(LOCAL )?SUBTITLE: |OCR: ', '', 'g'), '\\s+', ' ', 'g'), 1, 320) as snippet from docs""",
    "stratified_sample": _with(_DOCS, _ELIGIBLE) + """, placed as (select video_id, document_id, row_number() over (partition by video_id order by start_seconds nulls first, document_id) - 1 as place, count(*) over (partition by video_id) as size from pool where video_id is not null),
rounds as (select ceil(60 / greatest(count(distinct video_id), 1))::bigint as r from placed),
turns as (select video_id, round, least(floor((round + 1) * size / (r + 1))::bigint, size - 1) as place from (select distinct video_id, size from placed), rounds, unnest(range(r)) as t(round)),
picked as (select row_number() over (order by round, video_id) as n, video_id, document_id from turns join placed using (video_id, place)) select * from picked where n <= 60""",
    "token_frequencies": _with(_DOCS, _ELIGIBLE) + f"select token, count(*) as df from (select distinct document_id, unnest(list_transform({_raw('combined_text')}, lambda t: lower(t))) as token from pool) group by 1",
    "eval_details": _with(_LABELS) + "select mode, query_id, first_relevant_rank::double as first_relevant_rank, round(recall_at_5, 9) as recall_at_5, round(recall_at_10, 9) as recall_at_10, round(reciprocal_rank, 9) as reciprocal_rank from details",
    "eval_report": _with(_LABELS) + "select mode, count(*) as queries, round(avg(recall_at_5), 9) as recall_at_5, round(avg(recall_at_10), 9) as recall_at_10, round(avg(reciprocal_rank), 9) as mrr from details group by 1",
    "latency_percentiles": "select event_type, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.95), 6) as p95, round(avg(value), 6) as mean from events group by 1",
    "validate_labels": """with q as (select query_id, list(distinct document_id) as ids from search_hits where reranker_score > 0 group by 1),
d as (select distinct document_id from documents where length(combined_text) >= 200)
select query_id, 'empty query' as problem from q where query_id like '%7'
union all select query_id, 'unknown document ' || x as problem from (select query_id, unnest(ids) as x from q) where x not in (select document_id from d where document_id is not null)""",
    "scene_segmentation": """with c as (select *, coalesce(abs(value - lag(value) over w) > 40, false) as cut from events where user_id is not null window w as (partition by user_id order by ts, event_id)),
n as (select *, (sum(cut::int) over (partition by user_id order by ts, event_id))::bigint as scene_no from c)
select user_id, scene_no, arg_min(event_id, (ts, event_id)) as first_event, count(*) as n from n group by 1, 2""",
    "sample_frames": """with s as (select *, greatest(end_frame - start_frame, 1) as total, greatest(1, least(8, ceil(duration_seconds / 8)))::bigint as wanted from scenes where duration_seconds is not null),
e as (select *, start_frame + floor(total * 0.10)::bigint as lo0, start_frame + floor(total * 0.90)::bigint - 1 as hi0, greatest(end_frame - 1, start_frame) as final from s),
f as (select *, case when lo0 >= hi0 then start_frame else lo0 end as lo, case when lo0 >= hi0 then final else hi0 end as hi from e),
g as (select video_id, scene_id, case when duration_seconds < 5 then 1 else wanted end as target, list_sort(list_distinct(case when duration_seconds < 5
  then list_transform(range(3), lambda i: round_even(start_frame + (final - start_frame) / 2 * i, 0)::bigint)
  else list_transform(range(wanted * 12), lambda i: round_even(lo + (hi - lo) / (wanted * 12 - 1) * i, 0)::bigint) end)) as frames from f)
select video_id, scene_id, target, array_to_string(frames, ',') as frames from g""",
    "frame_gate": _with(_FRAMES) + """, once as (select l_orderkey, frame_index, max(sharpness) as sharpness from frames group by all), g as (select f.*, greatest(a.sharpness, b.sharpness) as around from frames f
  left join once a on a.l_orderkey = f.l_orderkey and a.frame_index = f.frame_index - 2 left join once b on b.l_orderkey = f.l_orderkey and b.frame_index = f.frame_index + 2),
m as (select *, coalesce(sharpness >= 35 and brightness between 25 and 235 and not coalesce(sharpness < around * 0.65, false), false) as ok from g),
a as (select *, bool_or(ok) over (partition by l_orderkey) as any_ok from m) select l_orderkey, frame_index from a where ok or not any_ok""",
    "selection_score": _with(_FRAMES) + """, q as (select *, sharpness * (0.5 + greatest(0, 1 - abs(brightness - 127.5) / 127.5)) as quality from frames),
m as (select *, max(quality) over (partition by l_orderkey) as mq, max(motion) over (partition by l_orderkey) as mm from q)
select l_orderkey, frame_index, round(round(0.75 * (case when mm > 0 then greatest(0, least(1, motion / mm)) else 0 end) + 0.25 * (case when mq > 0 then greatest(0, least(1, quality / mq)) else 0 end), 9), 6) as selection_score from m""",
    "temporal_windows": _with(_FRAMES) + """, m as (select *, min(frame_index) over (partition by l_orderkey) as a, max(frame_index) over (partition by l_orderkey) as b from frames)
select l_orderkey, frame_index, least(floor((frame_index - a) / greatest(b - a + 1, 1) * 3), 2)::int as window_no from m""",
    "job_latest_state": _with(_STATES) + "select * from states",
    "job_status_histogram": _with(_STATES) + "select event_type, status, count(*) as jobs from states group by all",
    "job_runnable": _with(_STATES) + """select user_id from states group by 1 having coalesce(bool_or(event_type = 'click' and status = 'done'), false) and coalesce(bool_or(event_type = 'view' and status = 'done'), false)
and not coalesce(bool_or(event_type = 'purchase' and status = 'done'), false)""",
    "stage_timings": "select user_id, event_type, round(sum(value), 3) as seconds from events group by all",
    "index_remove_videos": _with(
        "hot as (select video_id from documents group by 1 order by count(*) desc, video_id limit 1)", _DOCS.replace("docs as", "docs0 as"), "docs as (select * from docs0 where video_id is null or video_id not in (select video_id from hot))", _TF, _IDF
    ) + "select term, document_frequency, round(inverse_document_frequency, 9) as inverse_document_frequency from idf",
    "index_incremental": _with(_DOCS, _TF, _IDF) + "select term, document_frequency, round(inverse_document_frequency, 9) as inverse_document_frequency from idf",
}

# the same rows, from the stored index
ORACLE |= {"bm25_index_search": ORACLE["bm25_scores"], "tfidf_index_search": ORACLE["tfidf_search"]}
