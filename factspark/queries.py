"""The engine's operators on the driver's tables, each with the SQL that DuckDB runs for the same rows.

Parts, suppliers, customers and orders stand for subjects, foreign keys for
properties whose values are items, and dates for dates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factspark import catalog, fixed, schemas
from factspark.functions import dates, text
from factspark.operators import ambiguity, evaluate, graph, harvest, report, rewrite, select, validate
from factspark.plans.settings import Settings
from factspark.sources.readers import DOCUMENT, entities_of, names_of, statements_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _day(c: str):
    return F.col(c).cast("date")


def _id(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _statement(df: DataFrame, subject, pid: str, item=None, time: str | None = None, rank=None, qualifiers=None, order=None) -> DataFrame:
    """Rows as statements of a property: an item, or the day of a column."""
    given = {
        "subject": subject, "pid": F.lit(pid), "stmt_ord": F.lit(0) if order is None else order, "rank": F.lit("normal") if rank is None else rank, "value_kind": F.lit("item" if time is None else "time"),
        "value_id": item if time is None else None, "value_time": None if time is None else F.concat(F.lit("+"), F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")), "time_precision": F.lit(11), "qualifiers": qualifiers,
    }
    col = lambda v: F.lit(None) if v is None else F.col(v) if isinstance(v, str) else v
    return df.select(*(col(given.get(f.name)).cast(f.dataType).alias(f.name) for f in schemas.STATEMENTS.fields))


def _at(pid: str, day: str, **more):
    """Qualifiers: a day, and items of other properties."""
    empty = {"id": F.lit(None).cast("string"), "time": F.lit(None).cast("string"), "precision": F.lit(None).cast("int"), "text": F.lit(None).cast("string")}
    snak = lambda **v: F.array(F.struct(*(v.get(n, c).alias(n) for n, c in empty.items())))
    moment = F.concat(F.lit("+"), F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    return F.create_map(F.lit(pid), snak(time=moment, precision=F.lit(11)), *(x for p, v in more.items() for x in (F.lit(p), snak(id=v))))


def _entities(*parts: tuple[DataFrame, Column, str]) -> DataFrame:
    out = None
    for df, qid, label in parts:
        part = df.select(qid.alias("qid"), F.col(label).alias("label_en"), F.lit("").alias("description_en"), F.array().cast("array<string>").alias("aliases_en"))
        out = part if out is None else out.unionByName(part)
    return out


def _candidates(df: DataFrame, **values) -> DataFrame:
    """Rows as candidates: the given columns, and nulls (empty lists) for the others."""
    col = lambda v: F.col(v) if isinstance(v, str) else v
    filled = {f.name: values[f.name] if f.name in values else F.array().cast(f.dataType) if f.dataType.typeName() == "array" else F.lit(None).cast(f.dataType) for f in schemas.CANDIDATES.fields}
    more = {k: v for k, v in values.items() if k not in filled}
    return df.select(*(col(v).cast(schemas.CANDIDATES[k].dataType).alias(k) for k, v in filled.items()), *(col(v).alias(k) for k, v in more.items()))


_HOPS = [
    {"source_qid": "Qf", "source_label": "Example Film", "property_pid": "P144", "property_label": "based on", "target_qid": "Qb", "target_label": "Hidden Work", "role": "bridge"},
    {"source_qid": "Qb", "source_label": "Hidden Work", "property_pid": "P50", "property_label": "author", "target_qid": "Qa", "target_label": "Example Author", "role": "answer"},
]
_META = {"required_reasoning_clues": ["based on"], "multi_hop_unique": True}
#: A candidate that breaks no rule, ways to break it, and what is wrong then. The last two are wrong in two ways.
SOUND = {
    "tpl_ord": 0, "cand_ord": 1, "subject_qid": "Qf", "subject_label": "Example Film", "subject_aliases": [], "answer_type": "Person", "target_property_pid": "P50", "answer_qids": ["Qa"], "answer_labels": ["Example Author"], "answer_aliases": [],
    "date_value": "1995-02-01", "reasoning_style": "multi_hop_join", "hop_count": 2, "reasoning_path": _HOPS, "bridge_entities": [{"qid": "Qb", "label": "Hidden Work", "role": "source_work"}], "derivation_signature": {"style": "multi_hop_join", "rule": "r"},
    "provenance_complete": True, "canonical_question": "Who wrote what Example Film was based on?", "source_metadata": _META,
}
_ORDINAL = lambda **m: {"reasoning_style": "multi_hop_ordinal", "source_metadata": {**_META, "ordinal_metadata": {"series_history_complete": True, "descriptor": "Green Cup", **m}}}
BROKEN = [
    ({}, None), ({"subject_label": ""}, "no_english_label"), ({"subject_label": None}, "no_english_label"), ({"answer_labels": []}, "no_answer_label"), ({"answer_labels": None}, "no_answer_label"), ({"subject_label": "Film 1996"}, "subject_label_contains_year"),
    ({"subject_label": "Latest Film"}, "subject_label_contains_temporal_expression"), ({"subject_label": "May Queen"}, "subject_label_contains_temporal_expression"), ({"date_value": "1999-12-01"}, "answer_not_time_invariant"),
    ({"date_value": "1999-12-01", "target_property_pid": "P57"}, "future_dated_or_unsettled_fact"), ({"date_value": "1996-00-00"}, "answer_not_time_invariant"), ({"target_property_pid": "P26"}, "answer_not_time_invariant"), ({"target_property_pid": "P1082"}, "answer_not_time_invariant"),
    ({"reasoning_path": [{**_HOPS[0], "property_pid": "P26"}, _HOPS[1]]}, "answer_not_time_invariant"), ({"answer_qids": ["Qa", "Qc"]}, "answer_not_unique"), ({"source_metadata": {**_META, "multi_hop_unique": False}}, "answer_not_unique"), ({"answer_qids": []}, "answer_not_unique"),
    ({"provenance_complete": False}, "provenance_incomplete"), ({"provenance_complete": None}, "provenance_incomplete"), ({"hop_count": 3}, "provenance_incomplete"), ({"derivation_signature": None}, "provenance_incomplete"),
    ({"reasoning_path": [_HOPS[0], {**_HOPS[1], "target_label": "Author of 1999"}]}, "same_label_competitor_requires_temporal_disambiguation"), ({"reasoning_path": [{**_HOPS[0], "target_label": "Work 1999"}, {**_HOPS[1], "source_label": "Work 1999"}]}, None),
    ({"reasoning_path": [{**_HOPS[0], "target_label": "Work 1999"}, _HOPS[1]], "source_metadata": {**_META, "surface_bridge_entities": True}}, "same_label_competitor_requires_temporal_disambiguation"),
    ({"answer_type": "Date", "reasoning_path": [_HOPS[0], {**_HOPS[1], "target_label": "22 January 1988"}]}, None), ({"reasoning_path": [_HOPS[0], {**_HOPS[1], "source_qid": "Qx"}]}, "reasoning_path_not_connected"),
    ({"reasoning_path": [{**_HOPS[0], "target_qid": None}, _HOPS[1]]}, "reasoning_path_not_connected"), ({"reasoning_path": _HOPS[:1], "hop_count": 1}, "reasoning_path_not_connected"), ({"reasoning_style": "ordinal_fact"}, "ordinal_derivation_not_safe"),
    (_ORDINAL(), None), (_ORDINAL(descriptor="Green Cup 1999"), "ordinal_derivation_not_safe"), (_ORDINAL(series_history_complete=False), "ordinal_derivation_not_safe"), (_ORDINAL(descriptor=""), "ordinal_derivation_not_safe"),
    ({"subject_label": "Film 1996", "answer_labels": []}, "no_answer_label"), ({"provenance_complete": False, "answer_qids": ["Qa", "Qc"]}, "answer_not_unique"),
]
#: What is looked at after the day.
AFTER_TIME = ("answer_not_unique", "provenance_incomplete", "same_label_competitor_requires_temporal_disambiguation", "reasoning_path_not_connected", "ordinal_derivation_not_safe")


# DuckDB's forms of the text rules.
NORM = "trim(regexp_replace(regexp_replace(lower(strip_accents({})), '\\([^)]*\\)', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"
YEAR_SQL = r"\b(17|18|19|20|21)\d{2}\b"
TEMPORAL_SQL = "(?i)" + YEAR_SQL + r"|\b\d{4}-\d{2}-\d{2}\b|\b(" + "|".join((*fixed.MONTHS, *fixed.TEMPORAL_PHRASES)) + r")\b"


# -- filters, joins -------------------------------------------------------------------------------------------------------


@query("select o_orderkey, cast(o_orderdate as date) as day from orders where cast(o_orderdate as date) between date '1996-03-01' and date '1997-06-30'")
def date_window(spark, d):
    """FLT-1: both ends included; the bounds reach the scan, and days as text pass the same window."""
    window = Settings("1996-03", run_date="1998-01-01", date_upper_bound="1997-06-30")
    rows = _t(spark, d, "orders").where(dates.moment_in_window(F.col("o_orderdate"), window.target_start_date, window.date_upper_bound))
    rows = rows.select("o_orderkey", _day("o_orderdate").alias("day"))
    return rows.withColumn("text", F.col("day").cast("string")).where(harvest._within("text", window)).drop("text")


@query("""
select l_partkey, day, min(l_suppkey) as l_suppkey from (select l_partkey, cast(l_shipdate as date) as day, l_suppkey from lineitem)
group by l_partkey, day having count(distinct l_suppkey) = 1""")
def unique_answer(spark, d):
    """AGG-1, AGG-15: groups with one different answer."""
    rows = _t(spark, d, "lineitem").select("l_partkey", _day("l_shipdate").alias("day"), "l_suppkey")
    return graph.having_one(rows, ["l_partkey", "day"], F.col("l_suppkey"), ["l_suppkey"])


@query("""
select l_partkey, s_suppkey, 'R' || n_regionkey as region, count(*) as n from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
where n_regionkey <> 2 group by l_partkey, s_suppkey, n_regionkey""")
def two_hop(spark, d):
    """JOIN-1, JOIN-6: a chain of properties, as a bag; a hop that is missing ends it."""
    hops = _statement(_t(spark, d, "supplier"), _id("S", "s_suppkey"), "P17", item=_id("N", "s_nationkey")).unionByName(_statement(_t(spark, d, "nation").where("n_regionkey <> 2"), _id("N", "n_nationkey"), "P30", item=_id("R", "n_regionkey")))
    rows = _t(spark, d, "lineitem").select("l_partkey", F.col("l_suppkey").alias("s_suppkey"), _id("S", "l_suppkey").alias("supplier"))
    rows = graph.chain(graph.chain(rows, hops, "supplier", "P17", "nation"), hops, "nation", "P30", "region")
    return rows.groupBy("l_partkey", "s_suppkey", "region").agg(F.count("*").alias("n"))


@query("""
select o_custkey, o_orderkey from orders a where not exists
(select 1 from orders b where b.o_custkey = a.o_custkey and cast(b.o_orderdate as date) = cast(a.o_orderdate as date) and b.o_orderkey <> a.o_orderkey)""")
def anti_unique(spark, d):
    """JOIN-7: no other value, by aggregation instead of a join of the table with itself."""
    rows = _t(spark, d, "orders").select("o_custkey", "o_orderkey", _day("o_orderdate").alias("day"))
    return graph.without_other(rows, ["o_custkey", "day"], "o_orderkey").select("o_custkey", "o_orderkey")


_EDGES = """
select 'N' || n_nationkey as child, 'R' || n_regionkey as parent from nation union all select 'S' || s_suppkey, 'N' || s_nationkey from supplier
union all select 'R' || r_regionkey, 'W' from region union all select 'W', 'R0'"""


@query(f"""
with recursive e as ({_EDGES}), t(cls, root) as (
  select distinct x, x from (select child as x from e union select parent from e) union select e.child, t.root from t join e on e.parent = t.cls)
select distinct cls, root from t""")
def class_closure(spark, d):
    """JOIN-3: the reflexive closure of a hierarchy that has a cycle."""
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = _t(spark, d, "nation").select(name("N", "n_nationkey").alias("child"), name("R", "n_regionkey").alias("parent"))
    edges = edges.unionByName(_t(spark, d, "supplier").select(name("S", "s_suppkey").alias("child"), name("N", "s_nationkey").alias("parent")))
    edges = edges.unionByName(_t(spark, d, "region").select(name("R", "r_regionkey").alias("child"), F.lit("W").alias("parent")))
    return graph.class_closure(edges.unionByName(spark.range(1).select(F.lit("W").alias("child"), F.lit("R0").alias("parent"))))


@query("""
select o_orderkey, cast(o_orderdate as date) as day, 'P585' as pid, 'F' as kind from orders where o_orderstatus = 'F'
union all select o_orderkey, cast(o_orderdate as date), case when o_totalprice > 150000 then 'P582' else 'P580' end, 'O' from orders where o_orderstatus = 'O'""")
def union_branches(spark, d):
    """SET-1, PRJ-3, PRJ-5: branches with constant and conditional columns, repeated rows kept."""
    rows = _t(spark, d, "orders").select("o_orderkey", _day("o_orderdate").alias("day"), "o_orderstatus", "o_totalprice")
    first, second = rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus = 'O'")
    return graph.union_branches([
        (first, {"pid": F.lit("P585"), "kind": F.lit("F")}), (second, {"pid": F.when(F.col("o_totalprice") > 150000, "P582").otherwise("P580"), "kind": F.lit("O")}),
    ]).select("o_orderkey", "day", "pid", "kind")


@query("""
with s as (select l_orderkey, max(cast(l_shipdate as date)) as ended from lineitem where l_returnflag = 'R' group by l_orderkey)
select o_orderkey, coalesce(ended, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end) as day, ended is not null as has_end
from orders left join s on o_orderkey = l_orderkey where coalesce(ended, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end) is not null""")
def optional_coalesce(spark, d):
    """JOIN-8, PRJ-4, FLT-4: optional values, the first that is bound, rows that have one."""
    ended = _t(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("ended"))
    known = _statement(ended, _id("O", "l_orderkey"), "P582", time="ended").unionByName(_statement(_t(spark, d, "orders").where("o_orderstatus <> 'P'"), _id("O", "o_orderkey"), "P580", time="o_orderdate"))
    rows = _t(spark, d, "orders").select("o_orderkey", _id("O", "o_orderkey").alias("season"))
    rows = graph.optional(graph.optional(rows, known, "season", "P582", "end"), known, "season", "P580", "start")
    rows = rows.withColumn("day", graph.first_bound(F.col("end"), F.col("start"))).where("day is not null")
    return rows.select("o_orderkey", F.col("day").cast("date").alias("day"), F.col("end").isNotNull().alias("has_end"))


@query("""
with e as (select l_partkey as a, l_suppkey as b from lineitem union select l_suppkey, l_partkey from lineitem)
select a as k1, b as k2 from e where cast(a as varchar) < cast(b as varchar)""")
def pair_canonical(spark, d):
    """FLT-5, JOIN-5: edges that are stated from both sides, once, by their order as text."""
    e = _t(spark, d, "lineitem").select(F.col("l_partkey").alias("k1"), F.col("l_suppkey").alias("k2")).distinct()
    both = e.unionByName(e.select(F.col("k2").alias("k1"), F.col("k1").alias("k2")))
    return graph.pairs_once(both, "k1", "k2").distinct()


@query("""
with s as (select l_partkey, l_suppkey from lineitem group by l_partkey, l_suppkey)
select l_partkey, l_suppkey, coalesce(p_name, '') as part_label, coalesce(s_name, '') as supplier_label from s
left join (select * from part where p_size > 10) on l_partkey = p_partkey left join (select * from supplier where s_acctbal > 0) on l_suppkey = s_suppkey""")
def hydrate(spark, d):
    """SRC-2, JOIN-9, JOIN-10, PRJ-2: labels of two sides, empty where the entity isn't known."""
    entity = lambda t, k, n: _t(spark, d, t).select(F.col(k).alias("qid"), F.col(n).alias("label_en"), F.lit("").alias("description_en"), F.array().cast("array<string>").alias("aliases_en"))
    rows = _t(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    rows = graph.hydrate(rows, entity("part", "p_partkey", "p_name").join(_t(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("qid")), "qid", "left_semi"), "l_partkey", "part")
    rows = graph.hydrate(rows, entity("supplier", "s_suppkey", "s_name").join(_t(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("qid")), "qid", "left_semi"), "l_suppkey", "supplier")
    return rows.select("l_partkey", "l_suppkey", "part_label", "supplier_label")


# -- ranks, sorts, sets ------------------------------------------------------------------------------------------------------


@query("""
select o_custkey, o_orderkey, n, n || case when n % 100 between 10 and 20 then 'th' when n % 10 = 1 then 'st' when n % 10 = 2 then 'nd' when n % 10 = 3 then 'rd' else 'th' end as nth
from (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by cast(o_orderdate as date), cast(o_orderkey as varchar)) as n from orders)""")
def ordinal_position(spark, d):
    """WIN-1, JOIN-13, STR-7: the place of each edition in its series, one window instead of a lookup for each row."""
    rows = _t(spark, d, "orders").select("o_custkey", "o_orderkey", _day("o_orderdate").cast("string").alias("day"), F.col("o_orderkey").cast("string").alias("edition"))
    placed = graph.series_positions(rows, ["o_custkey"], "day", "edition").withColumn("n", F.col("position").cast("long"))
    return placed.select("o_custkey", "o_orderkey", "n", text.ordinal(F.col("n")).alias("nth"))


@query("""
select o_custkey, o_orderkey, day from (select o_custkey, o_orderkey, cast(o_orderdate as date) as day, rank() over (partition by o_custkey order by cast(o_orderdate as date)) as r,
count(*) over (partition by o_custkey, cast(o_orderdate as date)) as n from orders) where r = 1 and n = 1""")
def earliest_unique(spark, d):
    """WIN-2: the earliest of each group, none on a tie."""
    return graph.earliest_unique(_t(spark, d, "orders").select("o_custkey", "o_orderkey", _day("o_orderdate").alias("day")), ["o_custkey"], "day")


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) as rn from lineitem) where rn = 1""")
def first_claim(spark, d):
    """WIN-3, WIN-4, AGG-6: the first of each group in a total order."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    return graph.first_by(_t(spark, d, "lineitem").select("l_orderkey", *order), ["l_orderkey"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("select o_orderkey, cast(o_orderdate as date) as day from orders order by o_orderdate, o_orderkey limit 50")
def topn_order_limit(spark, d):
    """SRT-1, SRT-3: the first rows of a total order, as a template's candidates are."""
    rows = _t(spark, d, "orders").select(F.lit(0).alias("tpl_ord"), "o_orderkey", "o_orderdate")
    return harvest.numbered(rows, 50, ["o_orderdate", "o_orderkey"]).select("o_orderkey", _day("o_orderdate").alias("day"))


@query("""
select l_partkey, day, l_suppkey from (select l_partkey, cast(l_shipdate as date) as day, min(l_suppkey) as l_suppkey from lineitem group by 1, 2 having count(distinct l_suppkey) = 1)
order by day, l_partkey limit least(100, 20) * 5""")
def over_fetch(spark, d):
    """SRT-2, SRT-4: the limit comes after the uniqueness filter."""
    rows = graph.having_one(_t(spark, d, "lineitem").select("l_partkey", _day("l_shipdate").alias("day"), "l_suppkey"), ["l_partkey", "day"], F.col("l_suppkey"), ["l_suppkey"])
    return rows.orderBy("day", "l_partkey").limit(min(100, 20) * 5)


@query("""
select o_orderpriority, o_orderkey from (select o_orderpriority, o_orderkey, row_number() over (partition by o_orderpriority order by o_orderdate, o_orderkey) as rn from orders) where rn <= 3""")
def quota_per_group(spark, d):
    """SEL-10, SRT-5: a quota for each group."""
    return select.quota(_t(spark, d, "orders"), "o_orderpriority", 3, ["o_orderdate", "o_orderkey"]).select("o_orderpriority", "o_orderkey")


@query("""
with a as (select o_orderstatus as domain, count(*) as n from orders group by 1), r as (select domain, t.turn from a, lateral (select unnest(range(1, n + 1)) as turn) t),
g as (select domain, max(turn) as quota from (select * from r order by turn, domain limit 3000) group by 1) select a.domain, coalesce(quota, 0)::bigint as quota from a left join g using (domain)""")
def quota_redistribution(spark, d):
    """SEL-10, SEL-13, DSN-7: what small groups leave goes to larger ones."""
    return select.spread_quota(_t(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("domain")).agg(F.count("*").alias("n")), 3000)


@query("""
with n as (select p_partkey, p_brand, %s as norm from part), k as (select a.p_partkey, b.p_partkey as other, row_number() over (partition by a.p_partkey order by cast(b.p_partkey as varchar)) as rn
from n a join n b on a.norm = b.norm and a.p_partkey <> b.p_partkey) select p_partkey, other from k where rn <= 10""" % NORM.format("p_name"))
def competitors(spark, d):
    """SRC-3, JOIN-11: others of the same normalised name, up to the search's cap."""
    part = _t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("qid"), F.col("p_name").alias("name"))
    names = part.select("qid", "name", text.normalize_name(F.col("name")).alias("norm_name"), F.lit(False).alias("is_alias"))
    met = ambiguity.competitors(part.select(F.col("qid").alias("row_id"), "qid", F.array("name").alias("names")), names)
    return met.select(F.col("row_id").cast("long").alias("p_partkey"), F.col("competitor").cast("long").alias("other"))


@query("""
with n as (select p_partkey, p_brand, p_name, %s as norm from part),
k as (select a.p_partkey, a.p_brand, b.p_partkey as other, b.p_brand as kind, row_number() over (partition by a.p_partkey order by 'P' || b.p_partkey) as rn from n a join n b on a.norm = b.norm and a.p_partkey <> b.p_partkey),
f as (select p_partkey, string_agg('P' || other, ',' order by 'P' || other) as found, bool_or(kind = p_brand) as same from k where rn <= 10 group by p_partkey)
select n.p_partkey, case when found is null then 'label_unique' when not same then 'resolved_by_non_temporal_descriptor' when p_partkey %% 3 = 0 then 'resolved_by_non_temporal_descriptor' end as status,
  case when found is null or not same then p_name when p_partkey %% 3 = 0 then p_name || ' in Lyon' end as descriptor, coalesce(found, '') as competitors
from n left join f using (p_partkey)""" % NORM.format("p_name"))
def competitor_type_exists(spark, d):
    """JOIN-12, VAL-11, VAL-12, VAL-13, FLT-16, ARR-2: subjects with competitors, by the competitors' types and their own place."""
    part = _t(spark, d, "part")
    entities = part.select(_id("P", "p_partkey").alias("qid"), F.col("p_name").alias("label_en"), F.array().cast("array<string>").alias("aliases_en"))
    places = F.when(F.col("p_partkey") % 3 == 0, F.array(F.lit("The Answer"), F.lit("Lyon"))).otherwise(F.array(F.lit("The Answer")))
    rows = _candidates(part, p_partkey="p_partkey", tpl_ord=F.lit(0), cand_ord=F.col("p_partkey").cast("int"), subject_qid=_id("P", "p_partkey"), subject_label="p_name", subject_type_qid="p_brand", subject_type_label=F.lit("part"),
                       target_property_pid=F.lit("P50"), answer_labels=F.array(F.lit("the answer")), source_metadata=harvest.record(schemas.SOURCE, subject_location_labels=places))
    out = ambiguity.resolve(rows, names_of(entities), _statement(part, _id("P", "p_partkey"), "P31", item="p_brand"))
    return out.select("p_partkey", "resolution.status", "resolution.descriptor", F.array_join("found_competitors", ",").alias("competitors"))


@query("select l_partkey as id from lineitem union select l_suppkey from lineitem")
def distinct_refs(spark, d):
    """AGG-2, AGG-3, AGG-4, AGG-5, SRT-6: the ids that rows refer to, once each, in one pass."""
    return graph.references(_t(spark, d, "lineitem"), ["l_partkey", "l_suppkey"])


@query("select c_custkey from customer except select o_custkey from orders where o_orderstatus = 'P'")
def missing_set(spark, d):
    """SET-5, AGG-14: what is asked for and not there."""
    return report.missing_domains(_t(spark, d, "customer").select(F.col("c_custkey").alias("domain")), _t(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("domain"))).withColumnRenamed("domain", "c_custkey")


@query("""
with p as (select 0 as part, c_custkey as t, 'customer' as kind, c_custkey as id from customer where c_acctbal > 9000 union all select 1, s_suppkey, 'supplier', s_suppkey from supplier union all select 2, s_suppkey, 'supplier', s_suppkey from supplier where s_acctbal > 0)
select kind, id, (row_number() over (order by part, t) - 1)::int as tpl_ord from p""")
def catalog_concatenation(spark, d):
    """SET-2: one list after the other, repeated rows kept, numbered anew."""
    named = lambda df, kind, key: df.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), F.col(key).alias("tpl_ord"))
    s = _t(spark, d, "supplier")
    return catalog.concatenated(named(_t(spark, d, "customer").where("c_acctbal > 9000"), "customer", "c_custkey"), named(s, "supplier", "s_suppkey"), named(s.where("s_acctbal > 0"), "supplier", "s_suppkey"))


@query("select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def resume_anti(spark, d):
    """SEL-7: work that no earlier run has done."""
    manifest = _t(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("domain"), F.lit(1).alias("resume_version"), F.lit("2026").alias("target_time"))
    return select.not_resumed(_t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("domain")), manifest, 1, "2026").select("o_orderkey", F.col("domain").alias("o_custkey"))


@query("""
select o_orderkey from (select *, rank() over (partition by o_custkey order by case o_orderstatus when 'F' then 2 when 'O' then 1 else 0 end desc) as r from orders where o_orderstatus <> 'P') where r = 1""")
def truthy_rank(spark, d):
    """D3: statements of the best rank of their subject and property, deprecated ones never."""
    rank = F.when(F.col("o_orderstatus") == "F", "preferred").when(F.col("o_orderstatus") == "P", "deprecated").otherwise("normal")
    return graph.truthy(_t(spark, d, "orders").select(F.col("o_custkey").alias("subject"), F.lit("P1").alias("pid"), rank.alias("rank"), "o_orderkey")).select("o_orderkey")


@query("""
with own as (select c_custkey as s, 'N' || c_nationkey as cls from customer), e as (select 'N' || n_nationkey as child, 'R' || n_regionkey as parent from nation)
select s as subject, root from (select s, cls as root from own where cls = 'N3' union select s, parent from own join e on cls = child where parent = 'R1' union select s, cls from own where cls = 'R1')""")
def instance_types(spark, d):
    """FLT-2, FLT-3: types stated exactly, and types through their subclasses."""
    own = _t(spark, d, "customer").select(F.col("c_custkey").alias("subject"), F.lit("P31").alias("pid"), F.lit("normal").alias("rank"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("value_id"))
    edges = _t(spark, d, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("child"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent"))
    types = spark.range(2).select(F.when(F.col("id") == 0, "N3").otherwise("R1").alias("root"), (F.col("id") == 0).alias("exact"))
    return graph.instances(own, types, graph.class_closure(edges, types.select("root"))).select("subject", "root")


@query("select l_partkey as subject, count(distinct l_suppkey) as n from lineitem group by 1")
def value_counts(spark, d):
    """AGG-17: how many different values a subject has."""
    rows = _t(spark, d, "lineitem").select(F.col("l_partkey").alias("subject"), F.lit("P1").alias("pid"), F.lit("normal").alias("rank"), F.col("l_suppkey").cast("string").alias("value_id"), F.lit(None).cast("string").alias("value_time"), F.lit(None).cast("string").alias("value_text"))
    return graph.count_values(rows, "P1")


@query("""
select l_partkey as subject, count(distinct l_suppkey) = 1 and not bool_or(l_returnflag = 'R') as is_unique from lineitem where l_linestatus = 'O' group by 1""")
def full_statement_unique(spark, d):
    """DSN-2: one value among all statements that aren't deprecated, and no qualifier of time."""
    rank = F.when(F.col("l_linestatus") == "O", "normal").otherwise("deprecated")
    quals = F.when(F.col("l_returnflag") == "R", F.create_map(F.lit("P580"), F.array(F.lit("x"))))
    rows = _t(spark, d, "lineitem").select(F.col("l_partkey").alias("subject"), F.lit("P1").alias("pid"), rank.alias("rank"), F.col("l_suppkey").cast("string").alias("value_id"), F.lit(None).cast("string").alias("value_time"), F.lit(None).cast("string").alias("value_text"), quals.alias("qualifiers"))
    return graph.full_statement_unique(rows).select("subject", "is_unique")


@query("""
with a as (select p_partkey as id, p_brand, 'size: ' || p_size as d1, 'type: ' || p_type as d2 from part),
f as (select id, p_brand, d1 as d from a union select id, p_brand, d2 from a),
one as (select x.id, min(x.d) as d from f x where not exists (select 1 from f y where y.p_brand = x.p_brand and y.id <> x.id and y.d = x.d) group by x.id),
two as (select id, d1, d2 from a x where not exists (select 1 from a y where y.p_brand = x.p_brand and y.id <> x.id and y.d1 = x.d1 and y.d2 = x.d2))
select a.id, case when one.d is not null then one.d when two.d1 is not null then two.d1 || '; ' || two.d2 end as signature
from a left join one on one.id = a.id left join two on two.id = a.id""")
def smallest_signature(spark, d):
    """SEL-11, DSN-4: the fewest descriptors that tell a part from all others of its brand."""
    return part_signatures(_t(spark, d, "part"))


def part_signatures(part):
    """``(id, signature)`` of every part given, among all parts given of its brand."""
    facts = part.select(F.col("p_partkey").alias("qid"), F.explode(F.array(F.struct(F.lit("size").alias("kind"), F.col("p_size").cast("string").alias("label")), F.struct(F.lit("type").alias("kind"), F.col("p_type").alias("label")))).alias("x")).select("qid", "x.kind", "x.label")
    found = ambiguity.unique_signature(part.select(F.col("p_partkey").alias("qid"), F.col("p_brand").alias("group")), facts)
    return found.select(F.col("qid").alias("id"), F.array_join("signature", "; ").alias("signature"))


# -- text, dates --------------------------------------------------------------------------------------------------------------


@query("""
select 'doc' as kind, doc_id as id, md5(%s) as h from documents union all select 'part', p_partkey, md5(%s) from part union all select 'turn', conv_id * 1000 + turn, md5(%s) from conversations"""
       % (NORM.format("text"), NORM.format("p_name"), NORM.format("text")))
def normalize_name(spark, d):
    """STR-1, on whole texts."""
    named = lambda t, kind, key, c: _t(spark, d, t).select(F.lit(kind).alias("kind"), key.alias("id"), F.md5(text.normalize_name(F.col(c))).alias("h"))
    out = named("documents", "doc", F.col("doc_id"), "text").unionByName(named("part", "part", F.col("p_partkey"), "p_name"))
    return out.unionByName(named("conversations", "turn", F.col("conv_id") * 1000 + F.col("turn"), "text"))


@query(f"select page_id, regexp_matches(html, '{YEAR_SQL}') as in_page, regexp_matches(url, '{YEAR_SQL}') as in_url from pages")
def has_year(spark, d):
    """STR-2."""
    return _t(spark, d, "pages").select("page_id", text.has_year(F.col("html")).alias("in_page"), text.has_year(F.col("url")).alias("in_url"))


@query(f"select page_id, regexp_matches(html, '{TEMPORAL_SQL}') as timed from pages")
def temporal_text(spark, d):
    """STR-3."""
    return _t(spark, d, "pages").select("page_id", text.has_temporal_text(F.col("html")).alias("timed"))


@query("select conv_id, turn, not regexp_matches(lower(text), '%s') and length(trim(text)) <= 200 as simple from conversations" % "|".join(fixed.NOT_SIMPLE))
def simple_question(spark, d):
    """STR-5."""
    return _t(spark, d, "conversations").select("conv_id", "turn", text.is_simple_question(F.col("text")).alias("simple"))


@query("select conv_id, turn, %s as mutable from conversations" % " or ".join(f"contains(lower(text), '{h}')" for h in (*fixed.RELATIONSHIP_HINTS, *fixed.STATISTIC_HINTS)))
def mutable_wording(spark, d):
    """STR-4."""
    return _t(spark, d, "conversations").select("conv_id", "turn", text.targets_mutable_fact(F.col("text")).alias("mutable"))


@query("select doc_id, item_id from (select doc_id, %s as n from documents) d join (select item_id, %s as m from benchmark) b on m <> '' and contains(n, m)" % (NORM.format("text"), NORM.format("text")))
def answer_leak(spark, d):
    """JOIN-16: which texts hold which names."""
    norm = text.normalize_name(F.col("text")).alias("norm")
    return validate.texts_that_hold(_t(spark, d, "documents").select("doc_id", norm), _t(spark, d, "benchmark").select("item_id", norm), "doc_id", "item_id")


@query("select o_orderkey, strftime(o_orderdate, '%-d %B %Y') as day from orders")
def date_answer(spark, d):
    """DAT-3, DAT-4, PRJ-7."""
    return _t(spark, d, "orders").select("o_orderkey", dates.spelled(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("day"))


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, (year(l_shipdate) - year(o_orderdate) - case when (month(l_shipdate), day(l_shipdate)) < (month(o_orderdate), day(o_orderdate)) then 1 else 0 end)::int as age
from lineitem join orders on l_orderkey = o_orderkey""")
def age_on_date(spark, d):
    """DAT-6, MTH-1."""
    rows = _t(spark, d, "lineitem").join(_t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dates.age_on(_day("o_orderdate"), _day("l_shipdate")).alias("age"))


@query("""
with p as (select l_orderkey, min(cast(l_shipdate as date)) as a, max(cast(l_shipdate as date)) as b from lineitem group by 1), e as (select o_orderkey, a, b, cast(o_orderdate as date) + 400 as e from p join orders on l_orderkey = o_orderkey),
y as (select o_orderkey, a, b, e, year(e) - year(a) - case when (month(e), day(e)) < (month(a), day(a)) then 1 else 0 end as x, year(e) - year(b) - case when (month(e), day(e)) < (month(b), day(b)) then 1 else 0 end as z from e)
select o_orderkey, case when a <= e and b <= e then abs(x - z)::int end as gap from y""")
def age_gap(spark, d):
    """DAT-7, FLT-11: null where someone is born after the event."""
    line = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min(_day("l_shipdate")).cast("string").alias("a"), F.max(_day("l_shipdate")).cast("string").alias("b"))
    rows = line.join(_t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select("o_orderkey", dates.age_gap(F.col("a"), F.col("b"), F.date_add(_day("o_orderdate"), 400).cast("string")).alias("gap"))


@query("select o_orderkey, cast(o_orderdate as date) <= date '1998-06-01' as settled from orders")
def settled_by_run_date(spark, d):
    """DAT-8."""
    return _t(spark, d, "orders").select("o_orderkey", dates.settled(F.col("o_orderdate").cast("string"), "1998-06-01").alias("settled"))


@query("select page_id, regexp_extract(url, '[^/]*$') as last from pages")
def last_path_segment(spark, d):
    """STR-8."""
    return _t(spark, d, "pages").select("page_id", text.last_segment(F.col("url")).alias("last"))


@query("select page_id, case when starts_with(url, 'https://') then regexp_extract(url, '[^/]*$') end as id from pages")
def entity_id(spark, d):
    """STR-9: only addresses of one kind give an id."""
    url = F.col("url")
    return _t(spark, d, "pages").select("page_id", text.entity_id(F.when(url.startswith("https://"), "uri").otherwise("literal"), F.concat(F.lit(fixed.ENTITY_PREFIX), text.last_segment(url))).alias("id"))


@query("select doc_id, sha256(lang || chr(10) || text) as key from documents")
def cache_key(spark, d):
    """SRC-5, STR-15."""
    return _t(spark, d, "documents").select("doc_id", text.cache_key(F.col("lang"), F.col("text")).alias("key"))


@query(r"select page_id, trim(regexp_replace(regexp_replace(url || ' 1999 - 2026', '\b(17|18|19|20|21)\d{2}\b', '', 'g'), '\s+', ' ', 'g'), ' -,:') as stripped from pages")
def strip_year(spark, d):
    """STR-6, FLT-10."""
    return _t(spark, d, "pages").select("page_id", text.strip_year_tokens(F.concat("url", F.lit(" 1999 - 2026"))).alias("stripped"))


@query("select event_id, case when event_type = 'click' then 'U' || user_id else concat_ws(':', 'VALUE', case when event_type = 'view' then 'literal' else event_type end, cast(user_id as varchar)) end as key from events")
def answer_key(spark, d):
    """STR-10."""
    uri = F.when(F.col("event_type") == "click", "uri").otherwise("literal")
    value = F.when(F.col("event_type") == "click", F.concat(F.lit(fixed.ENTITY_PREFIX + "U"), F.col("user_id").cast("string"))).otherwise(F.col("user_id").cast("string"))
    return _t(spark, d, "events").select("event_id", text.answer_key(uri, value, F.when(F.col("event_type") != "view", F.col("event_type"))).alias("key"))


@query("""
select 'C' || c_custkey as qid, c_name as label, case when c_custkey % 3 = 0 then '' else c_mktsegment end as description, case when c_custkey % 4 = 0 then '' else 'No. ' || c_nationkey || '|x' end as aliases from customer""")
def document_entities(spark, d):
    """SRC-1, PRJ-9, MAP-1, JSN-1: names of entity documents; fields that are missing are empty."""
    out = entities_of(_documents(spark, d))
    return out.select("qid", F.col("label_en").alias("label"), F.col("description_en").alias("description"), F.array_join("aliases_en", "|").alias("aliases"))


@query("""
with c as (select 'C' || c_custkey as subject, *, date '1950-01-01' + (c_custkey % 9000)::int as born from customer)
select subject, 'P31' as pid, 0 as stmt_ord, 'normal' as rank, 'item' as kind, 'Q5' as value, null::int as precision, null as since from c
union all select subject, 'P17', 0, 'preferred', 'item', 'N' || c_nationkey, null, '+' || born || 'T00:00:00Z' from c union all select subject, 'P17', 1, 'deprecated', 'item', 'N0', null, null from c
union all select subject, 'P569', 0, 'normal', 'time', '+' || born || 'T00:00:00Z', 11, null from c
union all select subject, 'P1448', 0, 'normal', 'string', c_name, null, null from c union all select subject, 'P1448', 1, 'normal', 'string', c_mktsegment, null, null from c union all select subject, 'P1448', 2, 'normal', 'string', null, null, null from c""")
def document_claims(spark, d):
    """SRC-1, ARR-1, JSN-1: the claims of entity documents, in their order, with ranks, kinds of values and qualifiers; a claim without a value stays."""
    out = statements_of(_documents(spark, d))
    since = F.get(F.try_element_at("qualifiers", F.lit("P580")), F.lit(0))["time"]
    value = F.coalesce("value_id", "value_time", "value_text")
    return out.select("subject", "pid", "stmt_ord", "rank", F.col("value_kind").alias("kind"), value.alias("value"), F.col("time_precision").alias("precision"), since.alias("since"))


def _documents(spark, d):
    """Customers as entity documents: JSON texts, read as the reader of files does."""
    c, born = _t(spark, d, "customer"), F.concat(F.lit('{"time":"+'), F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 9000).cast("int")).cast("string"), F.lit('T00:00:00Z","precision":11}'))
    quote = lambda x: F.to_json(F.struct(x.alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(x.alias("v")))) - 6)
    snak = lambda v: F.concat(F.lit('{"datavalue":{"value":'), v, F.lit("}}"))
    claim = lambda v, more="": F.concat(F.lit('{"mainsnak":'), snak(v), F.lit(more if isinstance(more, str) else ""), *([] if isinstance(more, str) else [more]), F.lit("}"))
    item = lambda x: F.concat(F.lit('{"id":"'), x, F.lit('"}'))
    since = F.concat(F.lit(',"rank":"preferred","qualifiers":{"P580":['), snak(born), F.lit("]}"))
    claims = [
        F.lit('"P31":['), claim(item(F.lit("Q5"))), F.lit('],"P17":['), claim(item(_id("N", "c_nationkey")), since), F.lit(","), claim(item(F.lit("N0")), ',"rank":"deprecated"'), F.lit('],"P569":['), claim(born),
        F.lit('],"P1448":['), claim(quote(F.col("c_name"))), F.lit(","), claim(F.concat(F.lit('{"text":'), quote(F.col("c_mktsegment")), F.lit(',"language":"en"}'))), F.lit(',{"mainsnak":{"snaktype":"novalue"}}]'),
    ]
    described = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit('"descriptions":{"en":{"value":'), quote(F.col("c_mktsegment")), F.lit("}},"))).otherwise("")
    named = F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit('"aliases":{"en":[{"value":'), quote(F.concat(F.lit("No. "), F.col("c_nationkey").cast("string"))), F.lit('},{"value":"x"}]},'))).otherwise("")
    body = F.concat(F.lit('{"id":"'), _id("C", "c_custkey"), F.lit('","labels":{"en":{"value":'), quote(F.col("c_name")), F.lit("}},"), described, named, F.lit('"claims":{'), *claims, F.lit("}}"))
    return c.select(F.from_json(body, DOCUMENT).alias("x")).select("x.*")


@query("select p_partkey, 'Who made the ' || lower(p_type) || ' ' || p_name || '?' as question from part")
def question_render(spark, d):
    """PRJ-12: slots are filled in one pass."""
    return _t(spark, d, "part").select("p_partkey", text.fill(F.lit("Who made the {subject_kind} {descriptor}?"), {"subject_kind": F.lower("p_type"), "descriptor": F.col("p_name")}).alias("question"))


@query("""
select p_partkey, coalesce(case when regexp_matches(p_type, '^Q[0-9]+$') then null else nullif(p_type, '') end, p_brand) as label from part""")
def select_label(spark, d):
    """PRJ-8, STR-11: the first label that is one."""
    hydrated = F.col("p_type")
    return _t(spark, d, "part").select("p_partkey", harvest.select_label(hydrated, F.col("p_brand"))["label"].alias("label"))


@query("select conv_id, turn, len(string_split_regex(trim(text), '\\s+'))::int as n from conversations where trim(text) <> ''")
def word_count(spark, d):
    """STR-14."""
    return _t(spark, d, "conversations").where(F.trim("text") != "").select("conv_id", "turn", F.size(text.words(F.col("text"))).alias("n"))


@query("select event_id, regexp_extract('answer: ' || props || ' end', '(?s)\\{.*\\}') as object from events")
def json_carve_out(spark, d):
    """STR-12."""
    return _t(spark, d, "events").select("event_id", text.json_object(F.concat(F.lit("answer: "), "props", F.lit(" end"))).alias("object"))


@query("select o_orderkey, case o_orderpriority when '1-URGENT' then 'multi_hop_join' when '2-HIGH' then 'multi_hop_ordinal' else o_orderpriority end as style, o_orderpriority in ('1-URGENT', '2-HIGH') as multi from orders")
def reasoning_style(spark, d):
    """STR-16: known names of styles, others as they are."""
    p = F.col("o_orderpriority")
    style = F.when(p == "1-URGENT", "fact_join").when(p == "2-HIGH", "ordinal_fact").otherwise(p)
    return _t(spark, d, "orders").select("o_orderkey", text.normalize_style(style).alias("style"), text.is_multi_hop(style).alias("multi"))


@query("select s_suppkey, s_name || ' in ' || n_name as label from supplier join nation on s_nationkey = n_nationkey")
def location_descriptor(spark, d):
    """STR-13, VAL-13."""
    rows = _t(spark, d, "supplier").join(_t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select("s_suppkey", ambiguity.safe_location(F.col("s_name"), F.array("n_name"), F.array().cast("array<string>"), F.lit("P50")).alias("label"))


# -- aggregates, validators, selection ---------------------------------------------------------------------------------------


@query("""
select case grouping_id(o_orderstatus, o_orderpriority) when 1 then 'o_orderstatus' else 'o_orderpriority' end as axis, coalesce(o_orderstatus, o_orderpriority) as value, count(*) as n
from orders group by grouping sets ((o_orderstatus), (o_orderpriority))""")
def axis_counts(spark, d):
    """AGG-9, SNK-5: counts by several columns in one pass."""
    return report.axis_counts(_t(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("""
with e as (select event_type as t, case when event_id % 3 = 0 then 'HTTP 429 timed out' when event_id % 3 = 1 then 'Timeout' else 'other' end as m from events where value > 50)
select key, count(*) as n from (select 'request_error:' || t as key from e union all select 'network_limit:http_429' from e where contains(m, '429')
union all select 'network_limit:timeout' from e where contains(lower(m), 'timed out') or contains(lower(m), 'timeout')) group by key""")
def problem_counts(spark, d):
    """AGG-11: an event may count under several keys."""
    k = F.col("event_id") % 3
    rows = _t(spark, d, "events").select(F.when(F.col("value") > 50, "error").otherwise("ok").alias("status"), F.col("event_type").alias("error_type"), F.when(k == 0, "HTTP 429 timed out").when(k == 1, "Timeout").otherwise("other").alias("error_message"))
    return report.problem_counts(rows)


@query("""
select count(*) as total_requests, count(*) filter (where event_type = 'view') as network_requests, count(*) filter (where event_type = 'click') as cache_hits,
count(*) filter (where user_id % 5 + 1 > 1) as retries, count(*) filter (where event_type = 'error') as errors from events""")
def conditional_totals(spark, d):
    """AGG-10, AGG-12, AGG-18, AGG-19."""
    t = F.col("event_type")
    rows = _t(spark, d, "events").select(F.when(t == "view", "network").when(t == "click", "cache_hit").alias("kind"), F.when(t == "error", "error").otherwise("ok").alias("status"), (F.col("user_id") % 5 + 1).alias("attempt"))
    return report.counters_only(rows)


@query("""
with g as (select case when quality = 1 then 'CORRECT' when toxic = 1 then 'NOT_ATTEMPTED' else 'INCORRECT' end as grade from labels),
c as (select count(*) as n, count(*) filter (where grade = 'CORRECT') as correct, count(*) filter (where grade = 'INCORRECT') as incorrect, count(*) filter (where grade = 'NOT_ATTEMPTED') as not_attempted from g),
r as (select *, correct + incorrect as attempted, case when n > 0 then correct / n else 0 end as accuracy, case when correct + incorrect > 0 then correct / (correct + incorrect) else 0 end as given from c)
select n, correct, incorrect, not_attempted, attempted, round(accuracy, 9) as accuracy, round(given, 9) as accuracy_given_attempted,
round(case when accuracy + given > 0 then 2 * accuracy * given / (accuracy + given) else 0 end, 9) as f1 from r""")
def evaluation_metrics(spark, d):
    """AGG-16, SEL-12, DSN-9."""
    grade = F.when(F.col("quality") == 1, "CORRECT").when(F.col("toxic") == 1, "NOT_ATTEMPTED").otherwise("INCORRECT")
    m = evaluate.metrics(_t(spark, d, "labels").select(grade.alias("grade")))
    return m.select("n", "correct", "incorrect", "not_attempted", "attempted", *(F.round(c, 9).alias(c) for c in ("accuracy", "accuracy_given_attempted", "f1")))


@query(f"""
with w as (select a.conv_id, a.turn, {NORM.format("a.text")} as p, {NORM.format("b.text")} as q from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = 0)
select conv_id, turn, case when p = '' or p = 'unknown' then 'NOT_ATTEMPTED' when p = q then 'CORRECT' when not (contains(p, q) or contains(q, p)) then 'INCORRECT' end as grade from w""")
def answer_grades(spark, d):
    """SEL-12: an answer against the first turn of its conversation."""
    c = _t(spark, d, "conversations").select("conv_id", "turn", "text")
    first = c.where("turn = 0").select("conv_id", F.col("text").alias("answer"))
    return c.join(first, "conv_id").select("conv_id", "turn", evaluate.grade(F.col("text"), F.col("answer"), F.array().cast("array<string>")).alias("grade"))


def _variants(f):
    return ", ".join(f"({k}, {'null' if why is None else repr(why)})" for k, (_, why) in enumerate(f))


@query(f"""
with v(v, reason) as (values {_variants(BROKEN)})
select o_orderkey, case when v.v in {tuple(k for k, (x, _) in enumerate(BROKEN) if 'date_value' not in x)} and (reason is null or {' or '.join(f"reason = '{x}'" for x in AFTER_TIME)}) and cast(o_orderdate as date) > date '1997-06-30' then 'answer_not_time_invariant' else reason end as reason
from orders join v on v.v = o_orderkey % {len(BROKEN)}""")
def reject_reason(spark, d):
    """VAL-1 to VAL-10, FLT-11, FLT-13: candidates that break each of the rules, one or several, on the days of orders: the first rule that is broken."""
    why, _ = validate.rejection(Settings("1992", run_date="1997-06-30"))
    return _broken(spark, d).select("o_orderkey", why.alias("reason"))


def _broken(spark, d):
    """Orders' days in candidates of which each is broken in one of the ways of ``BROKEN``."""
    made = spark.createDataFrame([{**SOUND, **{k: v for k, v in changes.items()}, "tpl_ord": i} for i, (changes, _) in enumerate(BROKEN)], schemas.CANDIDATES)
    own = made.withColumn("keeps_day", ~F.col("tpl_ord").isin([i for i, (x, _) in enumerate(BROKEN) if "date_value" in x]))
    rows = _t(spark, d, "orders").select("o_orderkey", _day("o_orderdate").cast("string").alias("day"), (F.col("o_orderkey") % len(BROKEN)).cast("int").alias("tpl_ord"))
    return rows.join(own, "tpl_ord").withColumn("date_value", F.when(F.col("keeps_day"), F.col("day")).otherwise(F.col("date_value")))


@query("select pid, reason from (values ('P26', 'mutable_relationship_or_status'), ('P451', 'mutable_relationship_or_status'), ('P39', 'mutable_affiliation_or_office'), ('P54', 'mutable_affiliation_or_office'), ('P102', 'mutable_affiliation_or_office'), ('P108', 'mutable_affiliation_or_office'), ('P1082', 'cumulative_statistic'), ('P1128', 'cumulative_statistic'), ('P106', 'answer_not_time_invariant'), ('P50', null)) as t(pid, reason)")
def finer_reasons(spark, d):
    """VAL-22, DSN-6: the reasons that tell apart why a property changes."""
    pids = ["P26", "P451", "P39", "P54", "P102", "P108", "P1082", "P1128", "P106", "P50"]
    why, _ = validate.rejection(Settings("1992", run_date="1999-06-30", finer_reasons=True))
    rows = spark.createDataFrame([{**SOUND, "target_property_pid": p} for p in pids], schemas.CANDIDATES)
    return rows.select(F.col("target_property_pid").alias("pid"), why.alias("reason"))


_PRONE = """
with c as (select *, turn %% 3 = 0 as multi, split_part(text, ' ', 3) as third, split_part(text, ' ', 5) as fifth, case when conv_id %% 2 = 0 then 'P17' else 'P50' end as pid, case when turn %% 5 = 4 then 'Date' else 'Person' end as kind from conversations),
n as (select conv_id, turn, text, multi, pid, kind, third, fifth, %s as q, %s as n3, %s as n5, %s as nc from c)""" % tuple(NORM.format(x) for x in ("text", "third", "fifth", "'the ' || conv_id"))  # fmt: skip


@query(_PRONE + f"""
, f as (select conv_id, turn, kind = 'Date' or not regexp_matches(text, '{YEAR_SQL}') as no_year, kind = 'Date' or not regexp_matches(text, '{TEMPORAL_SQL}') as no_temporal_expression,
  not (n3 <> '' and contains(q, n3) and turn % 2 = 0) as answer_not_leaked, not (pid = 'P17' and n5 <> '' and contains(q, n5)) as location_context_not_leaked,
  not (multi and n5 <> '' and contains(q, n5) and n5 <> 'the subject') as bridge_not_leaked, not multi or nc = '' or contains(q, nc) as question_requires_all_hops from n)
select *, question_requires_all_hops as shortcut_free, no_year and no_temporal_expression and answer_not_leaked and location_context_not_leaked and bridge_not_leaked and question_requires_all_hops as all_flags from f""")
def all_flags(spark, d):
    """VAL-14 to VAL-18, VAL-20, FLT-14, ARR-3: turns as questions, their words as answers, places and bridges: each flag, and whether all hold."""
    out = validate.flag(_prone(spark, d))
    names = ("no_year", "no_temporal_expression", "answer_not_leaked", "location_context_not_leaked", "bridge_not_leaked", "question_requires_all_hops", "shortcut_free")
    return out.select("conv_id", "turn", *(F.col(f"validation_flags.{n}").alias(n) for n in names), F.col("flags_ok").alias("all_flags"))


@query(_PRONE + f"""
select conv_id, turn, case when trim(coalesce(text, '')) = '' then 'rewrite_missing_question' when kind <> 'Date' and regexp_matches(text, '{YEAR_SQL}') then 'rewrite_contains_year' when kind <> 'Date' and regexp_matches(text, '{TEMPORAL_SQL}') then 'rewrite_contains_temporal_expression'
  when not contains(q, nc) then 'rewrite_lost_required_anchor' when n3 <> '' and turn % 2 = 0 and contains(q, n3) then 'rewrite_leaks_answer' when multi and n5 <> '' and contains(q, n5) then 'rewrite_leaks_answer'
  when regexp_matches(lower(text), '{"|".join(fixed.NOT_SIMPLE)}') or length(trim(text)) > 200 then 'rewrite_not_simple_question' end as failure
from (select * replace (case when conv_id % 4 > 0 then '' else nc end as nc) from n)""")
def rewrite_failures(spark, d):
    """VAL-19, VAL-21, PRJ-14: turns as rewritten questions: the first check that each fails."""
    rows = _prone(spark, d)
    clues = F.when(F.col("conv_id") % 4 > 0, F.array().cast("array<string>")).otherwise(F.col("source_metadata.required_reasoning_clues"))
    rows = rows.withColumn("source_metadata", F.col("source_metadata").withField("required_reasoning_clues", clues)).withColumn("subject_label", F.lit(""))
    return rewrite.failure(rows, "canonical_question").select("conv_id", "turn", F.col("rewrite_failure").alias("failure"))


def _prone(spark, d):
    """Turns as questions that may give away their own words, which stand for answers, places and bridges."""
    turns = _t(spark, d, "conversations")
    word = lambda k: F.coalesce(F.get(F.split("text", " "), F.lit(k)), F.lit(""))
    even = F.col("turn") % 2 == 0
    return _candidates(
        turns, conv_id="conv_id", turn="turn", canonical_question="text", subject_label=F.lit("the subject"), target_property_pid=F.when(F.col("conv_id") % 2 == 0, "P17").otherwise("P50"), answer_type=F.when(F.col("turn") % 5 == 4, "Date").otherwise("Person"),
        reasoning_style=F.when(F.col("turn") % 3 == 0, "multi_hop_join").otherwise("single_fact"), answer_labels=F.when(even, F.array(word(2), F.lit("..."))).otherwise(F.array(F.lit("no such words here"))), answer_aliases=F.array().cast("array<string>"),
        bridge_entities=F.array(harvest.record(schemas.BRIDGE, qid=F.lit("Qb"), label=word(4)), harvest.record(schemas.BRIDGE, qid=F.lit("Qs"), label=F.lit("The Subject"))),
        provenance_complete=F.lit(True), hop_count=F.lit(0), reasoning_path=F.array().cast(schemas.CANDIDATES["reasoning_path"].dataType), derivation_signature=harvest.record(schemas.DERIVATION, rule=F.lit("r")),
        source_metadata=harvest.record(schemas.SOURCE, subject_location_labels=F.array(word(4)), required_reasoning_clues=F.array(F.concat(F.lit("the "), F.col("conv_id").cast("string")))),
    )


@query("select doc_id from (select doc_id, row_number() over (partition by source, n order by doc_id) as rn from (select doc_id, source, %s as n from documents)) where rn = 1" % NORM.format("text"))
def dedup_norm_question(spark, d):
    """SEL-9, AGG-8: the first of each normalised text of its source. Texts are told apart by a digest, so they aren't shuffled."""
    rows = _t(spark, d, "documents").select("doc_id", "source", F.sha2(text.normalize_name(F.col("text")), 256).alias("h"))
    return select.dedup(rows, [["source", "h"]], ["doc_id"]).select("doc_id")


@query("""
with e as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, s_nationkey, n_nationkey, n_regionkey from lineitem left join (select * from supplier where s_acctbal > 0) on l_suppkey = s_suppkey left join (select * from nation where n_regionkey < 4) on s_nationkey = n_nationkey)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, s_nationkey is not null and n_nationkey is not null as connected from e""")
def path_connected(spark, d):
    """JOIN-17, VAL-9, WIN-6, PRJ-13: each hop's target is the next one's source."""
    rows = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = rows.join(_t(spark, d, "supplier").where("s_acctbal > 0"), F.col("l_suppkey") == F.col("s_suppkey"), "left").join(_t(spark, d, "nation").where("n_regionkey < 4"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    hop = lambda a, b: F.struct(F.col(a).cast("long").alias("source_qid"), F.col(b).cast("long").alias("target_qid"))
    path = F.array(hop("l_partkey", "l_suppkey"), hop("s_suppkey", "s_nationkey"), hop("n_nationkey", "n_regionkey"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", graph.path_connected(path).alias("connected"))


@query("""
with recursive p as (select p_partkey, p_brand as t, row_number() over (partition by p_brand order by p_partkey) as c, p_name as q from part),
b as (select t, row_number() over (order by t) as k from (select distinct p_brand as t from part)), g(k, qs, ts, cs) as (
  select 0::bigint, []::varchar[], []::varchar[], []::bigint[] union all
  select g.k + 1, case when w.q is null then g.qs else list_append(g.qs, w.q) end, case when w.q is null then g.ts else list_append(g.ts, b.t) end, case when w.q is null then g.cs else list_append(g.cs, w.c) end
  from g join b on b.k = g.k + 1 left join lateral (select q, c from p where p.t = b.t and not list_contains(g.qs, p.q) and len(g.qs) < 20 order by c limit 1) w on true)
select unnest(ts) as brand, unnest(cs)::int as nth, unnest(qs) as question from (select * from g order by k desc limit 1)""")
def greedy_select(spark, d):
    """SEL-1 to SEL-5, AGG-8: one question a template, none twice, up to a total."""
    part = _t(spark, d, "part").select("p_partkey", "p_brand", F.col("p_name").alias("question"))
    brands = part.select("p_brand").distinct().withColumn("tpl_ord", F.row_number().over(Window.partitionBy().orderBy("p_brand")))
    rows = part.withColumn("cand_ord", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))).join(brands, "p_brand").withColumn("ok", F.lit(True))
    return select.greedy(rows, 20).where("outcome = 'accepted'").select(F.col("p_brand").alias("brand"), F.col("cand_ord").alias("nth"), "question")


@query("""
with p as (select p_partkey, p_brand, p_type, p_size, %s as q from part), a as (select *, row_number() over (partition by q order by p_brand, p_partkey) as n from p), b as (select *, row_number() over (partition by p_type, p_size order by p_brand, p_partkey) as m from a where n = 1),
k as (select *, row_number() over (partition by p_brand order by p_partkey) as c, count(*) over (partition by p_brand) as size from b where m = 1),
t as (select p_partkey, row_number() over (order by c, p_brand) <= 60 as won from k)
select p_partkey, case when t.won then 'accepted' else 'rejected' end as outcome, t.won is null as is_duplicate, t.won is not null and not t.won as over_quota from p left join t using (p_partkey)""" % NORM.format("p_name"))
def quota_select(spark, d):
    """SEL-9, SEL-10, SEL-13, DSN-7: questions once, subjects with their property once, even quotas for each brand."""
    part = _t(spark, d, "part")
    rows = part.select("p_partkey", F.dense_rank().over(Window.orderBy("p_brand")).alias("tpl_ord"), F.col("p_partkey").cast("int").alias("cand_ord"), F.col("p_brand").alias("domain"), F.col("p_name").alias("question"), F.col("p_type").alias("subject_qid"), F.col("p_size").cast("string").alias("target_property_pid"), F.lit(True).alias("ok"))
    return select.by_quota(rows, 60).select("p_partkey", "outcome", "is_duplicate", "over_quota")


@query("""
with c as (select o_custkey, count(*) filter (where o_orderstatus = 'F') as a, count(*) filter (where o_orderstatus = 'O') as r from orders group by 1)
select c_custkey as domain, coalesce(a, 0)::bigint as accepted, coalesce(r, 0)::bigint as rejected, case when coalesce(a, 0) > 0 then 'accepted' when coalesce(r, 0) > 0 then 'rejected_only' else 'no_result' end as status
from customer left join c on c_custkey = o_custkey""")
def template_status(spark, d):
    """SEL-8, AGG-14."""
    outcome = F.when(F.col("o_orderstatus") == "F", "accepted").when(F.col("o_orderstatus") == "O", "rejected")
    return select.template_status(_t(spark, d, "customer").select(F.col("c_custkey").alias("domain")), _t(spark, d, "orders").select(F.col("o_custkey").alias("domain"), outcome.alias("outcome")))


@query("select o_custkey as domain, array_to_string(list_sort(list_distinct(list(o_orderpriority))), ',') as reasons from orders where o_orderstatus <> 'F' group by 1")
def rejection_reasons(spark, d):
    """AGG-13: the different reasons of each template."""
    rows = _t(spark, d, "orders").where("o_orderstatus <> 'F'").select(F.col("o_custkey").alias("domain"), F.col("o_orderpriority").alias("rejection_reason"))
    return report.reasons_by_domain(rows).select("domain", F.array_join("reasons", ",").alias("reasons"))


@query("select printf('order_%06d', row_number() over (order by o_orderdate, o_orderkey)) as id, o_orderkey from orders")
def sequential_ids(spark, d):
    """PRJ-18, PRJ-19, WIN-5: numbers in a total order, over ranges of it."""
    return select.numbered(_t(spark, d, "orders"), "order", ["o_orderdate", "o_orderkey"]).select("id", "o_orderkey")


@query("""
select c_custkey, case when c_mktsegment <> 'BUILDING' and n_name is not null then n_name || ',run' else '' end as runs, case when c_mktsegment <> 'BUILDING' and n_name is not null then 'proven_in_runs' else 'not_yet_proven' end as evidence_status
from customer left join nation on c_nationkey = n_nationkey and n_regionkey = 1""")
def evidence_join(spark, d):
    """JOIN-14, JOIN-15, PRJ-17: recorded runs beside templates, which count only for those that are used."""
    rows = _t(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("domain"), F.when(F.col("c_mktsegment") == "BUILDING", "blueprint").otherwise("active").alias("status"), F.lit("").alias("evidence_status"), F.array().cast("array<string>").alias("evidence_runs"))
    runs = _t(spark, d, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").cast("string").alias("domain"), F.array("n_name", F.lit("run")).alias("evidence_runs"))
    return catalog.with_evidence(rows, runs).select("c_custkey", F.array_join("evidence_runs", ",").alias("runs"), "evidence_status")


def _catalog_sql() -> str:
    """The catalog's export, straight from its rows."""
    names = schemas.TEMPLATES.names
    text_of = lambda v: "" if v is None else ",".join(v) if isinstance(v, (list, tuple)) else str(v).lower() if isinstance(v, bool) else str(v)
    lines = []
    for row in catalog.rows():
        r = dict(zip(names, row, strict=True))
        recipe = dict(zip(schemas.TEMPLATES["reasoning_recipe"].dataType.names, r["reasoning_recipe"], strict=True))
        r |= {"activation_status": r["status"], **{k: recipe[k] for k in ("new_element_slot", "new_element_hop", "required_reasoning_clues")}}
        lines.append(f"({r['tpl_ord']}, " + ", ".join("'" + text_of(r[c]).replace("'", "''") + "'" for c in report.EXPORT) + ")")
    return f"select * from (values {', '.join(lines)}) as t(tpl_ord, {', '.join(report.EXPORT)})"


@query(f"""
select count(*) as total, count(*) filter (where answer_type = 'Number' or answer_format = 'number') as number_total, count(*) filter (where answer_format = 'date') as date_total, count(*) filter (where temporal_mode <> 'atemporal') as temporal_total from ({_catalog_sql()})""")
def catalog_totals(spark, d):
    """SRC-7, SRC-12, FLT-12, FLT-15: the catalog's own totals."""
    return report.catalog_totals(catalog.templates(spark))


@query(_catalog_sql())
def catalog_export(spark, d):
    """PRJ-16, SNK-4: the catalog as text columns."""
    return report.catalog_rows(catalog.templates(spark))


_RUN_TEMPLATES = "[active]\n" + "\n".join(f"orders_{p[0]} | Orders | Person | who_placed_order | {p} | order | P577 | P50 | customer | Who placed the {{subject_kind}} {{descriptor}}?" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))


@query(rf"""
with c as (
  select o_orderpriority as p, 'O' || o_orderkey as subject, 'Order ' || o_orderkey as label, c_name as answer, cast(o_orderdate as date) as day,
    row_number() over (partition by o_orderpriority order by cast(o_orderdate as date), 'O' || o_orderkey) as n
  from orders join customer on o_custkey = c_custkey where cast(o_orderdate as date) between date '1996-01-01' and date '1999-06-30'),
k as (select *, row_number() over (partition by p order by n) as m from c where n <= 500 and not regexp_matches(label, '{YEAR_SQL}'))
select 'orders_' || p[1] as domain, 'Who placed the order ' || label || '?' as question, answer, subject as subject_qid, cast(day as varchar) as date_value from k where m = 1""")
def question_run(spark, d):
    """EXE-1, EXE-2, VAL-1 to VAL-20, SEL-1 to SEL-3, SNK-2: a whole run, with orders as subjects and their customers as answers."""
    from factspark.plans import pipeline
    from factspark.plans.settings import Settings
    from factspark.sources.readers import names_of

    orders, customers = _t(spark, d, "orders"), _t(spark, d, "customer")
    subject, none = F.concat(F.lit("O"), F.col("o_orderkey").cast("string")), F.lit(None).cast("string")
    row = lambda pid, item, time: orders.select(
        subject.alias("subject"), F.lit(pid).alias("pid"), F.lit(0).alias("stmt_ord"), F.lit("normal").alias("rank"), F.lit("item" if time is none else "time").alias("value_kind"), item.alias("value_id"), time.alias("value_time"),
        F.lit(11).alias("time_precision"), none.alias("value_text"), F.lit(None).cast("map<string,array<struct<id:string,time:string,precision:int,text:string>>>").alias("qualifiers"),
    )
    day = F.concat(F.lit("+"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    statements = row("P31", F.col("o_orderpriority"), none).unionByName(row("P577", none, day)).unionByName(row("P50", F.concat(F.lit("C"), F.col("o_custkey").cast("string")), none))
    entity = lambda qid, label: (qid.alias("qid"), label.alias("label_en"), F.lit("").alias("description_en"), F.array().cast("array<string>").alias("aliases_en"))
    entities = orders.select(*entity(subject, F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")))).unionByName(customers.select(*entity(F.concat(F.lit("C"), F.col("c_custkey").cast("string")), F.col("c_name"))))
    tables = {"statements": statements, "entities": entities, "names": names_of(entities)}
    result = pipeline.run(tables, catalog.templates(spark, _RUN_TEMPLATES), Settings("1996", run_date="1999-06-30"))
    return result.accepted.select("domain", "question", "answer", "subject_qid", F.col("date_filter.value").alias("date_value"))


# -- executors: orders and customers as subjects of several hops -------------------------------------------------------------


_WINDOW = "between date '1996-01-01' and date '1997-06-30'"


def _harvested(executor, tables: dict[str, DataFrame], line: str) -> DataFrame:
    """The candidates of one template, all of them."""
    spark = tables["statements"].sparkSession
    templates = catalog.templates(spark, "[active]\n" + line)
    settings = Settings("1996", run_date="1997-06-30", harvest_limit_per_template=1 << 30)
    edges = tables["statements"].where("pid = 'P279'").select(F.col("subject").alias("child"), F.col("value_id").alias("parent"))
    roots = spark.createDataFrame([(x,) for x in (fixed.FILM_CLASS, fixed.UNIVERSITY_CLASS, fixed.SEASON_CLASS, fixed.HUMAN_CLASS, "Q132241")], "root string")
    return executor(tables, graph.class_closure(edges, roots), templates, settings)


def _suppliers_of_orders(spark, d) -> DataFrame:
    return _t(spark, d, "lineitem").select("l_orderkey", "l_suppkey").distinct()


@query(f"""
with f as (select o_orderkey, cast(o_orderdate as date) as day from orders where o_orderpriority <> '5-LOW' and cast(o_orderdate as date) {_WINDOW}),
w as (select l_orderkey, min(l_suppkey) as work from lineitem group by 1 having count(distinct l_suppkey) = 1),
c as (select 'F' || o_orderkey as film, 'W' || work as work, 'N' || s_nationkey as author, n_name, day from f join w on o_orderkey = l_orderkey join supplier on s_suppkey = work join nation on n_nationkey = s_nationkey where s_acctbal > 0)
select film, work, author, n_name as label, cast(day as varchar) as day, row_number() over (order by day, film, author)::int as nth from c""")
def source_works(spark, d):
    """EXE-9, FLT-7: orders as films (most of them by a subclass), their one supplier as the work they are based on, its nation as the author."""
    orders, suppliers, film = _t(spark, d, "orders"), _t(spark, d, "supplier"), _id("F", "o_orderkey")
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "Q11424").when(F.col("o_orderpriority") == "5-LOW", "Q571").otherwise("Q24862")
    short = _statement(spark.range(1), F.lit("Q24862"), "P279", item=F.lit("Q11424"))
    st = short.unionByName(_statement(orders, film, "P31", item=kind)).unionByName(_statement(orders, film, "P577", time="o_orderdate"))
    st = st.unionByName(_statement(_suppliers_of_orders(spark, d), _id("F", "l_orderkey"), "P144", item=_id("W", "l_suppkey")))
    st = st.unionByName(_statement(suppliers, _id("W", "s_suppkey"), "P50", item=_id("N", "s_nationkey"), rank=F.when(F.col("s_acctbal") > 0, "preferred").otherwise("deprecated")))
    entities = _entities((_t(spark, d, "nation"), _id("N", "n_nationkey"), "n_name"))
    out = _harvested(harvest.source_work_authors, {"statements": st, "entities": entities}, "film_source_work_author | Arts | Person | f | Q11424 | film | P577 | P50 | author | Who wrote {descriptor}? | style=fact_join")
    work = F.get("bridge_entities", F.lit(0))["qid"]
    return out.select(F.col("subject_qid").alias("film"), work.alias("work"), F.get("answer_qids", F.lit(0)).alias("author"), F.get("answer_labels", F.lit(0)).alias("label"), F.col("date_value").alias("day"), F.col("cand_ord").alias("nth"))


@query(f"""
with e as (select o_custkey, 'E' || o_orderkey as edition, o_orderkey, cast(o_orderdate as date) as day, row_number() over (partition by o_custkey order by cast(o_orderdate as date), 'E' || o_orderkey) as place from orders),
w as (select l_orderkey, min(l_suppkey) as winner from lineitem group by 1 having count(distinct l_suppkey) = 1)
select 'C' || o_custkey as series, edition, 'S' || winner as winner, place::int as place, c_name || ' Cup' as descriptor, cast(day as varchar) as day
from e join w on o_orderkey = l_orderkey join customer on o_custkey = c_custkey where day {_WINDOW}""")
def ordinal_winners(spark, d):
    """EXE-10, EXE-11, EXE-12, FLT-8, FLT-9, FLT-10, WIN-1: orders as editions of their customer's tournament, one supplier as the winner; places are those in the whole history."""
    orders, edition = _t(spark, d, "orders"), _id("E", "o_orderkey")
    series = _t(spark, d, "customer").select("c_custkey", F.concat("c_name", F.lit(" Cup 1996")).alias("label"))
    st = _statement(orders, edition, "P31", item=F.lit("Q132241")).unionByName(_statement(orders, edition, "P179", item=_id("C", "o_custkey"))).unionByName(_statement(orders, edition, "P585", time="o_orderdate"))
    st = st.unionByName(_statement(_suppliers_of_orders(spark, d), _id("E", "l_orderkey"), "P1346", item=_id("S", "l_suppkey")))
    entities = _entities((series, _id("C", "c_custkey"), "label"), (_t(spark, d, "supplier"), _id("S", "s_suppkey"), "s_name"))
    out = _harvested(harvest.tournament_winners, {"statements": st, "entities": entities}, "ordinal_tournament_winner | Sports | Person | f | Q132241 | tournament | P585 | P1346 | winner | Who won the {ordinal} {descriptor}? | style=ordinal_fact")
    meta = F.col("source_metadata.ordinal_metadata")
    return out.select(F.col("subject_qid").alias("series"), meta["edition_qid"].alias("edition"), F.get("answer_qids", F.lit(0)).alias("winner"), meta["ordinal_value"].alias("place"), meta["descriptor"].alias("descriptor"), F.col("date_value").alias("day"))


@query(f"""
with s as (select o_custkey, o_orderkey % 40 as u, cast(o_orderdate as date) as day from orders where o_orderkey % 40 % 4 <> 3 and o_orderstatus <> 'P'),
e as (select *, min(day) over (partition by o_custkey) as least from s), o as (select *, count(*) over (partition by o_custkey) as n from e where day = least)
select 'C' || o_custkey as person, 'U' || u as university, cast(day as varchar) as day from o where n = 1 and day {_WINDOW}""")
def first_degrees(spark, d):
    """EXE-8, VAL-9, WIN-2: orders as degrees that customers took at universities: the earliest, if it is the only one of its day, of those of the right kind."""
    orders, customers = _t(spark, d, "orders"), _t(spark, d, "customer")
    degree = F.when(F.col("o_orderstatus") != "P", "D1")
    at = F.when(degree.isNotNull(), _at("P582", "o_orderdate", P512=degree)).otherwise(_at("P582", "o_orderdate"))
    university = F.concat(F.lit("U"), (F.col("o_orderkey") % 40).cast("string"))
    st = _statement(orders, _id("C", "o_custkey"), "P69", item=university, qualifiers=at).unionByName(_statement(customers, _id("C", "c_custkey"), "P31", item=F.lit("Q5")))
    places = spark.range(40).select("id", F.concat(F.lit("College "), F.col("id").cast("string")).alias("label"))
    st = st.unionByName(_statement(places, _id("U", "id"), "P31", item=F.when(F.col("id") % 4 == 3, "Q515").otherwise("Q3918")))
    entities = _entities((customers, _id("C", "c_custkey"), "c_name"), (places, _id("U", "id"), "label"))
    out = _harvested(harvest.first_degrees, {"statements": st, "entities": entities}, "person_first_degree_university | Education | Organization | f | Q5 | human | P582 | P69 | university | Where did {descriptor} study? | style=fact_join")
    return out.select(F.col("subject_qid").alias("person"), F.get("answer_qids", F.lit(0)).alias("university"), F.col("date_value").alias("day"))


_BORN = "date '1940-01-01' + (x * 37 % 18000)::int"
_COUPLES = f"""
with c as (select distinct 'C' || o_custkey as a, o_custkey as ka, 'C' || (o_orderkey % 97 + 1) as b, o_orderkey % 97 + 1 as kb, o_orderkey, cast(o_orderdate as date) as day from orders),
g as (select *, {_BORN.replace('x', 'ka')} as born_a, {_BORN.replace('x', 'kb')} as born_b from c where day {_WINDOW}),
y as (select *, year(day) - year(born_a) - case when (month(day), day(day)) < (month(born_a), day(born_a)) then 1 else 0 end as age_a, year(day) - year(born_b) - case when (month(day), day(day)) < (month(born_b), day(born_b)) then 1 else 0 end as age_b from g where born_a <= day and born_b <= day)"""


def _couples(spark, d) -> dict[str, DataFrame]:
    """Orders as marriages of their customer and one of 97 others."""
    customers = _t(spark, d, "customer")
    spouse = F.concat(F.lit("C"), (F.col("o_orderkey") % 97 + 1).cast("string"))
    st = _statement(_t(spark, d, "orders"), _id("C", "o_custkey"), "P26", item=spouse, qualifiers=_at("P580", "o_orderdate"), order=F.col("o_orderkey").cast("int"))
    born = customers.withColumn("born", F.date_add(F.lit("1940-01-01").cast("date"), (F.col("c_custkey") * 37 % 18000).cast("int")))
    st = st.unionByName(_statement(born, _id("C", "c_custkey"), "P569", time="born"))
    return {"statements": st, "entities": _entities((customers, _id("C", "c_custkey"), "c_name"))}


_WEDDING = "wedding_age_gap | Society | Number | f | Q5 | human | P580 | P26 | spouse | What was the age gap of {descriptor}? | format=number; style=fact_join"


@query(_COUPLES + "\nselect distinct a as person, b as spouse, abs(age_a - age_b)::varchar as gap, cast(day as varchar) as day from y where a < b")
def wedding_gaps(spark, d):
    """EXE-6, JOIN-4, JOIN-5, FLT-5, FLT-6, DAT-7: couples once, by the order of their ids, and the difference of their ages at the wedding."""
    out = _harvested(harvest.wedding_age_gaps, _couples(spark, d), _WEDDING)
    spouse = F.get("bridge_entities", F.lit(0))["qid"]
    return out.select(F.col("subject_qid").alias("person"), spouse.alias("spouse"), F.get("answer_labels", F.lit(0)).alias("gap"), F.col("date_value").alias("day"))


@query(_COUPLES + """
select a as person, b as spouse, abs(age_a - age_b)::varchar as gap, cast(day as varchar) as day from (select *, row_number() over (partition by a order by o_orderkey, b) as rn from y) where rn = 1""")
def first_weddings(spark, d):
    """EXE-7, FLT-6, WIN-3, AGG-6: of each person, the first marriage in the order of the claims that has all it needs."""
    out = _harvested(harvest.wedding_age_gaps_by_person, _couples(spark, d), _WEDDING)
    spouse = F.get("bridge_entities", F.lit(0))["qid"]
    return out.select(F.col("subject_qid").alias("person"), spouse.alias("spouse"), F.get("answer_labels", F.lit(0)).alias("gap"), F.col("date_value").alias("day"))


@query("""
with e as (select user_id % 7 as run, event_type as t, event_id, user_id % 5 + 1 as attempt from events),
n as (select run, event_id, (row_number() over (partition by run order by event_id) - 1) // 100 as part from e)
select run, part, count(*) as n, min(event_id) as first, max(event_id) as last, any_value(total) as total, any_value(retries) as retries
from n join (select run, count(*) as total, count(*) filter (where attempt > 1) as retries from e group by run) c using (run) group by run, part""")
def telemetry_snapshot(spark, d):
    """AGG-18: counters of several runs beside copies of their events, of which no row holds more than a part."""
    e = _t(spark, d, "events").select((F.col("user_id") % 7).alias("run"), "event_id", F.when(F.col("event_type") == "view", "network").alias("kind"), F.lit("ok").alias("status"), (F.col("user_id") % 5 + 1).alias("attempt"))
    counters, parts = report.snapshot(e, ["run"], ["event_id"], per_row=100)
    ids = F.transform("events", lambda x: x["event_id"])
    parts = parts.select("run", "part", F.size(ids).cast("long").alias("n"), F.array_min(ids).alias("first"), F.array_max(ids).alias("last"))
    return parts.join(counters.select("run", F.col("total_requests").alias("total"), "retries"), "run")


@query("""
select o_orderkey, case when o_orderkey % 3 = 0 then 'http://www.wikidata.org/entity/' || 'Q' || o_custkey else o_comment_like end as value, case when o_orderkey % 3 = 0 then 'Q' || o_custkey end as id
from (select *, 'literal ' || o_orderpriority as o_comment_like from orders)""")
def query_bindings(spark, d):
    """SRC-2, SRC-9, STR-9: the bindings of stored answers of a query service; only addresses of entities have ids."""
    from factspark.sources import ingest

    bound = F.when(F.col("o_orderkey") % 3 == 0, F.struct(F.lit("uri").alias("type"), F.concat(F.lit(fixed.ENTITY_PREFIX + "Q"), F.col("o_custkey").cast("string")).alias("value"))).otherwise(F.struct(F.lit("literal").alias("type"), F.concat(F.lit("literal "), "o_orderpriority").alias("value")))
    key = F.struct(F.lit("literal").alias("type"), F.col("o_orderkey").cast("string").alias("value"))
    rows = _t(spark, d, "orders").select((F.col("o_orderkey") % 50).alias("page"), F.struct(key.alias("k"), bound.alias("v")).alias("b")).groupBy("page").agg(F.to_json(F.struct(F.struct(F.collect_list("b").alias("bindings")).alias("results"))).alias("body"))
    answers = rows.select(F.col("page").cast("string").alias("cache_key"), F.lit(1.0).alias("fetched_at"), F.lit(None).cast("string").alias("error"), "body")
    stale = answers.select("cache_key", F.lit(2.0).alias("fetched_at"), F.lit("HTTP 500").alias("error"), F.lit(None).cast("string").alias("body"))
    out = ingest.binding_rows(answers.unionByName(stale), ["k", "v"])
    return out.select(F.col("k").cast("long").alias("o_orderkey"), F.col("v").alias("value"), F.col("v_qid").alias("id"))


@query("""
with s as (select o_custkey, o_orderkey, cast(o_orderdate as date) as day, o_orderstatus from orders)
select 'C' || o_custkey as subject, count(distinct o_orderkey) as n, bool_and(o_orderstatus = 'F') as is_stable from s where o_orderstatus <> 'P' group by 1""")
def stable_counts(spark, d):
    """DSN-8, AGG-17: counts of values, and whether nothing ties them to a time."""
    rank = F.when(F.col("o_orderpriority") == "x", "preferred").otherwise("normal")
    orders = _t(spark, d, "orders").where("o_orderstatus <> 'P'")
    timed = F.when(F.col("o_orderstatus") == "O", _at("P585", "o_orderdate"))
    return graph.stable_counts(_statement(orders, _id("C", "o_custkey"), "P1", item=_id("O", "o_orderkey"), rank=rank, qualifiers=timed), "P1")


@query("""
with own as (select o_custkey, o_orderkey, cast(o_orderdate as date) as day from orders where o_orderstatus <> 'O'), later as (select o_custkey, min(cast(o_orderdate as date)) as begun from orders where o_orderstatus = 'O' group by 1),
m as (select own.*, max(day) over (partition by own.o_custkey) as last from own join later using (o_custkey) where day <= begun), k as (select *, count(*) over (partition by o_custkey) as n from m where day = last)
select 'C' || o_custkey as subject, 'O' || o_orderkey as value_id, cast(day as varchar) as ended from k where n = 1""")
def claims_before(spark, d):
    """DSN-8: the last claim that ended before the first of another kind began, none on a tie."""
    orders = _t(spark, d, "orders")
    own = lambda where, pid, at: _statement(orders.where(where), _id("C", "o_custkey"), pid, item=_id("O", "o_orderkey"), qualifiers=_at(at, "o_orderdate"))
    return graph.claims_before(own("o_orderstatus <> 'O'", "P69", "P582").unionByName(own("o_orderstatus = 'O'", "P108", "P580")), "P69", "P108")


# -- a run's parts ---------------------------------------------------------------------------------------------------------


@query(rf"""
with s as (select o_orderkey as k, o_custkey, cast(o_orderdate as date) as day, case when o_orderkey % 7 = 0 then '' when o_orderkey % 11 = 0 then 'Order 1996' when o_orderkey % 13 = 0 then 'Twin' else 'Order ' || o_orderkey end as label from orders),
c as (select s.*, case when o_custkey % 19 = 0 then '' else c_name end as answer, row_number() over (order by day, 'Q' || (1000000 + k)) as nth from s join customer on o_custkey = c_custkey where k % 17 <> 0 and day between date '1996-01-01' and date '1997-06-30'),
r as (select *, case when label = '' then 'no_english_label' when answer = '' then 'no_answer_label' when regexp_matches(label, '{YEAR_SQL}') then 'subject_label_contains_year' when label = 'Twin' then 'same_label_competitor_requires_temporal_disambiguation' end as reason from c)
select 'Q' || (1000000 + k) as subject, nth::int as nth, label, answer, cast(day as varchar) as day, reason, case when reason is null then 'Who placed the order ' || label || '?' else '' end as question from r""")
def judged_candidates(spark, d):
    """PRJ-1, PRJ-6, JOIN-2, EXE-1, VAL-1 to VAL-12, AGG-7: all candidates of a template of one fact, with orders as subjects of which some have no label, a year in it, one that others have too, or two answers."""
    from factspark.plans import pipeline

    orders, customers = _t(spark, d, "orders"), _t(spark, d, "customer")
    # Ids of customers begin with a zero, which no number does: whatever the keys, none is an order's.
    k, subject, answer = F.col("o_orderkey"), F.concat(F.lit("Q"), (F.lit(1_000_000) + F.col("o_orderkey")).cast("string")), _id("Q0", "o_custkey")
    st = _statement(orders, subject, "P31", item=F.lit("Q77")).unionByName(_statement(orders, subject, "P577", time="o_orderdate")).unionByName(_statement(orders, subject, "P50", item=answer))
    st = st.unionByName(_statement(orders.where(k % 17 == 0).withColumn("o_custkey", F.col("o_custkey") + 1), subject, "P50", item=answer, order=F.lit(1)))
    labelled = orders.withColumn("label", F.when(k % 7 == 0, "").when(k % 11 == 0, "Order 1996").when(k % 13 == 0, "Twin").otherwise(F.concat(F.lit("Order "), k.cast("string"))))
    named = customers.withColumn("label", F.when(F.col("c_custkey") % 19 == 0, "").otherwise(F.col("c_name")))
    entities = _entities((labelled, subject, "label"), (named, _id("Q0", "c_custkey"), "label"))
    tables = {"statements": st, "entities": entities, "names": names_of(entities)}
    templates = catalog.templates(spark, "[active]\norders | Orders | Person | f | Q77 | order | P577 | P50 | author | Who placed the {subject_kind} {descriptor}? | exact")
    settings = Settings("1996", run_date="1997-06-30", harvest_limit_per_template=1 << 30, over_fetch=1 << 20)
    rows = pipeline.judge(harvest.harvest(tables, pipeline.closure_of(tables, templates), templates, settings), tables, templates, settings)
    label = F.coalesce(F.get("answer_labels", F.lit(0)), F.lit(""))
    return rows.select(F.col("subject_qid").alias("subject"), F.col("cand_ord").alias("nth"), F.col("subject_label").alias("label"), label.alias("answer"), F.col("date_value").alias("day"), F.col("rejection_reason").alias("reason"), F.col("canonical_question").alias("question"))


@query("""
with c as (select l_orderkey, l_linenumber, 'P' || l_partkey as qid, case when p_size > 10 then p_name else '' end as label from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey where o_orderstatus = 'F')
select 'O' || l_orderkey as subject, string_agg(qid, ',' order by l_linenumber, qid) as qids, coalesce(string_agg(label, ',' order by l_linenumber, qid) filter (where label <> ''), '') as labels from c group by l_orderkey""")
def claim_labels(spark, d):
    """PRJ-10, ARR-1, ARR-2, JOIN-10: the items of a property in the order of its claims, and their labels without the empty ones."""
    claims = _statement(_t(spark, d, "lineitem"), _id("O", "l_orderkey"), "P31", item=_id("P", "l_partkey"), order=F.col("l_linenumber"))
    part = _t(spark, d, "part").withColumn("label", F.when(F.col("p_size") > 10, F.col("p_name")).otherwise(""))
    out = harvest.items_of(claims, _entities((part, _id("P", "p_partkey"), "label")), _t(spark, d, "orders").where("o_orderstatus = 'F'").select(_id("O", "o_orderkey").alias("subject")), ["P31"])
    return out.select("subject", F.array_join("qids", ",").alias("qids"), F.array_join("labels", ",").alias("labels"))


@query("""
with k as (select p_partkey, p_size, lower(p_type) as t, case p_size % 3 when 0 then 'film' when 1 then 'artwork' else 'building' end as kind from part)
select p_partkey, case when p_size % 2 = 1 then t || ' ' || kind when kind = 'artwork' then 'mural' when kind = 'building' then 'tower' else 'film' end as kind from k""")
def subject_kinds(spark, d):
    """PRJ-11, SET-3: the first type label that says more than the default kind and agrees with it."""
    kind = F.when(F.col("p_size") % 3 == 0, "film").when(F.col("p_size") % 3 == 1, "artwork").otherwise("building")
    finer = F.when(F.col("p_size") % 2 == 1, F.concat(F.lower("p_type"), F.lit(" "), kind)).otherwise(F.concat(F.lit("a very very long "), kind))
    return _t(spark, d, "part").select("p_partkey", harvest.subject_kind(kind, F.array("p_name", F.lit("work"), kind, finer, F.lit("mural"), F.lit("tower"))).alias("kind"))


@query("""
select p_partkey, p_brand || '|clue ' || p_size || case when p_size % 4 > 0 then '|' || p_name else '' end as anchors, 'Who made ' || p_name || '?' as asked, p_type as relation from part""")
def rewrite_payloads(spark, d):
    """PRJ-14, PRJ-15, MAP-2: what a rewriting client is told: the anchors, and the payload at the end of the prompt."""
    part = _t(spark, d, "part")
    rows = _candidates(part, p_partkey="p_partkey", canonical_question=F.concat(F.lit("Who made "), "p_name", F.lit("?")), disambiguation_signature=F.array("p_brand"), subject_label=F.when(F.col("p_size") % 4 > 0, F.col("p_name")).otherwise(""), target_property_label="p_type",
                       source_metadata=harvest.record(schemas.SOURCE, required_reasoning_clues=F.array(F.concat(F.lit("clue "), F.col("p_size").cast("string")))))
    payload = F.substring_index(rewrite.prompt(), "Payload:\n", -1)
    return rows.select("p_partkey", F.array_join(rewrite.anchors(), "|").alias("anchors"), F.get_json_object(payload, "$.canonical_question").alias("asked"), F.get_json_object(payload, "$.target_property").alias("relation"))


class _Polite(rewrite.RewriteClient):
    """Fails for some, names a year for some."""

    def rewrite_question(self, payload):
        size = int(payload["domain"])
        if size % 10 == 0:
            raise ValueError("busy")
        return {"question": ("Say, " if size % 2 else "In 1999, ") + payload["canonical_question"]}


@query("""
select p_partkey, case when p_size % 10 > 0 and p_size % 2 = 1 then 'Say, who made the ' || p_name || '?' end as rewritten, p_size % 10 > 0 and p_size % 2 = 1 as used,
  case when p_size % 10 = 0 then 'rewrite_request_failed:ValueError' when p_size % 2 = 0 then 'rewrite_contains_year' end as failure from part""")
def rewritten_questions(spark, d):
    """UDF-1, UDF-5, VAL-21: questions rewritten by an injected client; one that fails or breaks a rule leaves the question as it was, and says why."""
    part = _t(spark, d, "part")
    rows = _candidates(part, p_partkey="p_partkey", tpl_ord=F.lit(0), cand_ord=F.col("p_partkey").cast("int"), domain=F.col("p_size").cast("string"), canonical_question=F.concat(F.lit("who made the "), "p_name", F.lit("?")), subject_label="p_name",
                       answer_labels=F.array("p_brand"), answer_type=F.lit("Organization"), reasoning_style=F.lit("single_fact"), validation_flags=harvest.record(schemas.FLAGS, no_year=F.lit(True)))
    out = rewrite.rewrite(rows, _Polite)
    return out.select("p_partkey", F.col("rewritten_question").alias("rewritten"), F.col("validation_flags.llm_rewrite_used").alias("used"), F.col("validation_flags.rewrite_failure_reason").alias("failure"))


class _ByLength(evaluate.GraderClient):
    def grade(self, question, answer, prediction):
        return "CORRECT" if len(prediction) % 2 == 0 else "perhaps"


@query(f"""
with w as (select a.conv_id, a.turn, a.text, {NORM.format("a.text")} as p, {NORM.format("b.third")} as q from conversations a join (select conv_id, split_part(text, ' ', 3) as third from conversations where turn = 0) b on a.conv_id = b.conv_id)
select conv_id * 1000 + turn as id, case when p = '' or p = 'unknown' then 'NOT_ATTEMPTED' when q <> '' and p = q then 'CORRECT' when q = '' or not (contains(p, q) or contains(q, p)) then 'INCORRECT' when length(text) % 2 = 0 then 'CORRECT' else 'INCORRECT' end as grade from w""")
def graded_by_client(spark, d):
    """UDF-6, SEL-12, DSN-9: what rules can't decide is graded by an injected client; an answer that is no grade grants nothing."""
    c = _t(spark, d, "conversations")
    answer = c.where("turn = 0").select("conv_id", F.coalesce(F.get(F.split("text", " "), F.lit(2)), F.lit("")).alias("answer"))
    questions = c.join(answer, "conv_id").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lit("?").alias("question"), "answer", F.array().cast("array<string>").alias("answer_aliases"), "text")
    return evaluate.graded(questions.drop("text"), questions.select("id", F.col("text").alias("prediction")), _ByLength).select("id", "grade")


@query(_COUPLES + """
select a as person, 'What was the age gap between the couple in ' || x.c_name || ' and ' || z.c_name || ' at their wedding?' as question, true as no_year, true as no_temporal_expression, true as provenance_complete
from (select *, row_number() over (partition by a order by o_orderkey, b) as rn from y) join customer x on a = 'C' || x.c_custkey join customer z on b = 'C' || z.c_custkey where rn = 1""")
def demo_questions(spark, d):
    """SEL-14, PRJ-12: composed candidates with their question and three flags, whatever the rules say."""
    from factspark.plans import pipeline

    out = pipeline.demo(_harvested(harvest.wedding_age_gaps_by_person, _couples(spark, d), _WEDDING))
    return out.select(F.col("subject_qid").alias("person"), F.col("canonical_question").alias("question"), "flags.*")


@query("""
with o as (select n_name as domain, count(*) filter (where c_acctbal > 9500) as a, count(*) filter (where c_acctbal < 0) as r from customer join nation on c_nationkey = n_nationkey where n_nationkey < 20 group by 1),
s as (select n_name as domain, coalesce(a, 0) as a, coalesce(r, 0) as r from nation left join o on o.domain = n_name)
select sum(a)::bigint as accepted_total, sum(r)::bigint as rejected_total, count(*) as template_total, coalesce(string_agg(domain, ',' order by domain) filter (where a > 0), '') as accepted_domains, coalesce(string_agg(domain, ',' order by domain) filter (where a = 0 and r > 0), '') as rejected_only,
  coalesce(string_agg(domain, ',' order by domain) filter (where a = 0 and r = 0), '') as no_result, coalesce(string_agg(domain, ',' order by domain) filter (where a = 0), '') as missing from s""")
def run_summary(spark, d):
    """SNK-6, AGG-12, AGG-14, SEL-8: one row on a run: its totals, and the domains by what came of them."""
    nation = _t(spark, d, "nation").select(F.col("n_name").alias("domain"), "n_nationkey")
    rows = _t(spark, d, "customer").join(nation.where("n_nationkey < 20"), F.col("c_nationkey") == F.col("n_nationkey"))
    outcomes = rows.select("domain", F.when(F.col("c_acctbal") > 9500, "accepted").when(F.col("c_acctbal") < 0, "rejected").alias("outcome")).where("outcome is not null")
    accepted, rejected = outcomes.where("outcome = 'accepted'"), outcomes.where("outcome = 'rejected'")
    row = report.summary(accepted, rejected, nation, select.template_status(nation, outcomes), "1996")
    named = {"accepted_domains": "accepted_domains", "rejected_only": "rejected_only_domains", "no_result": "no_result_domains", "missing": "missing_domains"}
    return row.select("accepted_total", "rejected_total", "template_total", *(F.array_join(c, ",").alias(n) for n, c in named.items()))


@query(f"""
with c as ({_catalog_sql()}), first as (select domain, min(tpl_ord) as tpl_ord from c group by domain)
select 'asked' as list, tpl_ord, domain from first where domain in ('museum_country', 'wedding_age_gap', 'person_first_degree_university') union all select 'unproven', tpl_ord, domain from c where evidence_status <> 'proven_in_runs'
union all select activation_status, tpl_ord, domain from c""")
def template_lists(spark, d):
    """SRC-7, SRC-11, FLT-12, FLT-15, UDF-4: templates by name (the first of a name), by status, and those that no run has proven."""
    every = catalog.templates(spark)
    lists = [("asked", catalog.by_domains(every, ["museum_country", "wedding_age_gap", "person_first_degree_university"])), ("unproven", catalog.unproven(every)), ("active", catalog.active(every)), ("multi_hop_pilot", catalog.multi_hop_pilot(every)), ("date_answer_pilot", catalog.date_answer_pilot(every)), ("blueprint", catalog.blueprint(every))]
    return graph.union_branches([(df, {"list": F.lit(name)}) for name, df in lists]).select("list", "tpl_ord", "domain")


def _service():
    """A service that knows an entity for every id but those that end in 9, and answers every first request for some with an error."""
    import json

    asked: set[str] = set()

    def call(url: str, accept: str) -> tuple[int, str]:
        ids = url.split("ids=")[1].split("&")[0].split("|")
        if url not in asked and "C7" in ids:
            asked.add(url)
            return 503, "busy"
        return 200, json.dumps({"entities": {i: {"id": i, "labels": {"en": {"value": f"Customer {i}"}}} for i in ids if not i.endswith("9")}})

    return call


@query("select 'C' || c_custkey as qid, 'Customer C' || c_custkey as label from customer where c_custkey % 10 <> 9")
def fetched_documents(spark, d):
    """SRC-4, SRT-7, AGG-2: ids in requests of up to 50, what isn't stored yet is asked for through an injected transport, again after an error, and the answers are documents."""
    from factspark.sources import ingest
    from factspark.storage import stored

    refs = _t(spark, d, "orders").select(_id("C", "o_custkey").alias("qid")).unionByName(_t(spark, d, "customer").select(_id("C", "c_custkey").alias("qid")))
    requests = stored(ingest.entity_requests(refs, "https://example.org/api"))
    nothing = spark.createDataFrame([], ingest.ANSWERS)
    answers = stored(ingest.fetch(ingest.missing(requests, nothing), _service, wait=_no_wait))
    more = ingest.fetch(ingest.missing(requests, answers), _service, wait=_no_wait)  # nothing is left to ask
    out = entities_of(ingest.documents_of(answers.unionByName(more)))
    return out.select("qid", F.col("label_en").alias("label"))


def _no_wait(seconds: float) -> None:
    pass
