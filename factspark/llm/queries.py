"""The queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factspark.llm.chat import _LAST, ALIASES, CLOSE, INSERT, JOIN, MERGE, NAME, NEVER, OPEN, RELABEL, ROLES, moves, op6_chat_format
from factspark.llm.decontaminate import op8_benchmark_decontamination
from factspark.llm.embeddings import op10_embedding_near_dedup
from factspark.llm.html import op3_html_text
from factspark.llm.langid import op4_language_id
from factspark.llm.lines import OP5_SQL, op5_line_dedup
from factspark.llm.mixing import op7_source_mixing
from factspark.llm.secrets import BASE, RULES, op1_secret_scan
from factspark.llm.simhash import op9_simhash_near_dedup
from factspark.llm.tokens import op2_token_counts


def _secrets_sql() -> str:
    """Matches are placed by the lengths of the gaps between them and of the matches before them."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rules = " union all ".join(
        f"select doc_id, {k} as r, {quote(r.kind)} as kind, {r.group} as g, {r.least} as least, {quote(p)} as p, string_split_regex(t, {quote(p)}) as gaps, regexp_extract_all(t, {quote(p)}) as ms from docs"
        for k, r in enumerate(RULES)
        for p in ["(?i)" * r.ignore_case + r.pattern]
    )
    base = ", ".join(quote(r.kind) for r in BASE)
    counts = ", ".join(f"count(kept.kind) filter (where kept.kind = {quote(r.kind)}) as n_{r.kind}" for r in BASE)
    return f"""
with docs as (select doc_id, coalesce(text, '') as t from documents),
raw as ({rules}),
flat as (select doc_id, r, kind, g, least, p, unnest(range(1, len(ms) + 1)) as i, unnest(ms) as m, unnest(gaps[1:len(ms)]) as gap from raw where len(ms) > 0),
placed as (select *, sum(length(gap) + length(m)) over (partition by doc_id, r order by i) - length(m) as s from flat),
kept as (select doc_id, r, kind, s::bigint as s, (s + length(m))::bigint as e from placed where length(case g when 0 then m else regexp_extract(m, p, 2) end) >= least)
select docs.doc_id, {counts},
  sha256(coalesce(string_agg(kept.kind || ':' || s || ':' || e, ',' order by s, r) filter (where kept.kind in ({base})), '')) as base_sha256,
  coalesce(string_agg(kept.kind || ':' || s || ':' || e, ',' order by s, r), '') as spans
from docs left join kept on docs.doc_id = kept.doc_id group by docs.doc_id
"""


def _chat_sql() -> str:
    """The least costs forwards, then the moves backwards, turn by turn (of conversations that are one chunk)."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    opened = lambda s: quote(OPEN.format(role=ROLES[s - 1]))
    names = " ".join(f"when name in ({', '.join(quote(a) for a in [r, *(x for x, y in ALIASES.items() if y == r)])}) then {k}" for k, r in enumerate(ROLES, 1))
    ways = "[" + ", ".join("[" + ", ".join(f"{{'a': {a}, 'b': {b}, 'cost': {cost}, 'merged': {merged}, 'gap': {between[0] if between else 0}}}" for a, b, cost, merged, between in moves(code)) + "]" for code in range(4)) + "]"
    step = ", ".join(f"list_min([c[y.a + 1] + y.cost for y in ways[code + 1] if y.b = {b}])" for b in range(1, 4))
    ends = ", ".join(f"c[{s + 1}] + {INSERT * len(_LAST[s])}" for s in range(4))
    tail = " ".join(f"when {s} then {quote(CLOSE)} || {' || '.join([opened(x) + ' || ' + quote(CLOSE) for x in _LAST[s]] or [quote('')])}" for s in (1, 2, 3))
    role = "case b " + " ".join(f"when {k} then {opened(k)}" for k in (1, 2, 3)) + " end"
    gap = "case gap " + " ".join(f"when {k} then {opened(k)} || {quote(CLOSE)}" for k in (1, 2, 3)) + " else '' end"
    return f"""
with recursive t as (
  select conv_id, turn, coalesce(text, '') as text, case {names} else 0 end as code, row_number() over (partition by conv_id order by turn, role, sha256(coalesce(text, ''))) as i
  from (select *, lower(trim(coalesce(role, ''))) as name from conversations)),
n as (select conv_id, count(*) as n, 0 as chunk from t group by conv_id),
w as (select {ways} as ways),
fw(conv_id, i, c) as (
  select conv_id, 0::bigint, [0, {NEVER}, {NEVER}, {NEVER}]::bigint[] from n
  union all select fw.conv_id, t.i, [{NEVER}, {step}]::bigint[] from fw join t on t.conv_id = fw.conv_id and t.i = fw.i + 1, w),
last as (select conv_id, n, chunk, list_position([{ends}], list_min([{ends}])) - 1 as e from fw join n using (conv_id) where fw.i = n.n),
bw(conv_id, i, e, m) as (
  select conv_id, n + 1, e::bigint, null::struct(a integer, b integer, "cost" integer, merged boolean, gap integer) from last
  union all select conv_id, i, best.a, best from (
    select bw.conv_id, t.i, list_filter(ways[code + 1], lambda y: y.b = bw.e) as own, [c[y.a + 1] + y.cost for y in ways[code + 1] if y.b = bw.e] as totals, own[list_position(totals, list_min(totals))] as best
    from bw join t on t.conv_id = bw.conv_id and t.i = bw.i - 1 join fw on fw.conv_id = bw.conv_id and fw.i = bw.i - 2, w)),
done as (
  select t.conv_id, t.i, t.code, text, m.a as a, m.b as b, m.merged as merged, m.gap as gap from bw join t on t.conv_id = bw.conv_id and t.i = bw.i where m is not null)
select d.conv_id, any_value(chunk)::bigint as chunk, count(*) as n_turns, count(*) filter (where merged) as n_merged, count(*) filter (where code <> b) as n_relabelled,
  (count(*) filter (where gap > 0) + any_value(case e when 1 then {len(_LAST[1])} when 2 then {len(_LAST[2])} else 0 end))::bigint as n_inserted,
  (sum(case when code = 0 then {NAME} when code <> b then {RELABEL} else 0 end) + {MERGE} * count(*) filter (where merged) + {INSERT} * (count(*) filter (where gap > 0) + any_value(case e when 1 then {len(_LAST[1])} when 2 then {len(_LAST[2])} else 0 end)))::bigint as cost,
  string_agg(case when merged then {quote(JOIN)} || text else case when a > 0 then {quote(CLOSE)} else '' end || {gap} || {role} || text end, '' order by i) || any_value(case e {tail} else '' end) as text
from done d join last on last.conv_id = d.conv_id group by d.conv_id
"""


#: Earliest deadline first, slot by slot, over one period.
_MIXING_SQL = """
with recursive sizes as (select source, count(*) as n from documents group by source),
parts as (select source, greatest(1, floor(sqrt(n) / (sum(sqrt(n)) over ()) * 1000 + 0.5))::bigint as p from sizes),
s as (select list(source order by source) as names, list(p order by source) as ps, sum(p)::bigint as w from parts),
slots(t, done, i) as (
  select -1::bigint, list_transform(ps, lambda x: 0::bigint), 0::bigint from s
  union all
  select t + 1, list_transform(done, lambda d, k: d + case when k = best.i then 1 else 0 end), best.i
  from (select t, done, w, list_min([{'due': ((done[k] + 1) * w + ps[k] - 1) // ps[k], 'i': k} for k in range(1, len(ps) + 1) if (done[k] * w) // ps[k] <= t + 1]) as best from slots, s where t + 1 < w)),
period as (select names[i] as source, ps[i] as p, w, t as slot, row_number() over (partition by i order by t) - 1 as k from slots, s where i > 0),
ranked as (select doc_id, source, row_number() over (partition by source order by md5(doc_id::varchar)) - 1 as rank from documents),
placed as (select doc_id, r.source, rank, (rank // 64) // q.p * q.w + slot as mix_slot
  from ranked r join (select distinct source, p from period) f on r.source = f.source join period q on q.source = r.source and q.k = (rank // 64) % f.p)
select doc_id, source, mix_slot::bigint as mix_slot, (mix_slot * 64 + rank % 64)::bigint as mix_position from placed
"""

_VECTORS_SQL = """
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings
  where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
u as (select vec_id, label, e, sqrt(list_dot_product(e, e)) as norm from v where list_dot_product(e, e) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from u a join u b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach(x, y) as (select vec_id, vec_id from embeddings union select reach.x, links.b from reach join links on links.a = reach.y)
select e.vec_id, coalesce(n, 0)::bigint as n_links, c as component_id, c = e.vec_id as kept
from embeddings e left join (select a, count(*) as n from links group by a) l on l.a = e.vec_id join (select x, min(y) as c from reach group by x) r on r.x = e.vec_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (op1_secret_scan, op2_token_counts, op3_html_text, op4_language_id, op5_line_dedup, op6_chat_format, op7_source_mixing, op8_benchmark_decontamination, op9_simhash_near_dedup, op10_embedding_near_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op1_secret_scan": _secrets_sql(), "op5_line_dedup": OP5_SQL, "op6_chat_format": _chat_sql(), "op7_source_mixing": _MIXING_SQL, "op10_embedding_near_dedup": _VECTORS_SQL}
