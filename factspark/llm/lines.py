"""Removal of lines that are boilerplate of their site.

A line's frequency is relative to its host: the host's different pages that
hold it, divided by all different pages of the host. Copies of a page count
once, so that a page that was stored many times doesn't make its own lines
boilerplate. Built-in functions only: lines are counted as pairs of 64-bit
hashes with partial aggregation before each shuffle, and no text is shuffled
while the boilerplate of all hosts is small enough to be broadcast; beyond, texts
are shuffled by page, never by host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factspark.llm.common import checkpointed, fresh, table

#: Boilerplate of all hosts up to this many lines (16 bytes each) is broadcast; beyond, each page is joined to its own.
BROADCAST_LINES = 200_000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _key(line: Column) -> Column:
    """Two independent 64-bit hashes of the line without blanks around it."""
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.struct(F.xxhash64(bare).alias("x"), F.xxhash64(F.lit("line"), bare).alias("y"))


def _is_blank(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r")) == ""


def _keys(text: Column) -> Column:
    """The keys of a text's lines, each once, blank ones left out."""
    return F.array_distinct(F.transform(F.filter(_lines(text), lambda x: ~_is_blank(x)), _key))


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = 0.1, least_pages: int = 5) -> DataFrame:
    """``(host, x, y)``: the keys of each host's lines on more than ``ratio`` of its pages, and on ``least_pages`` pages or more.

    Pages are the different texts of a host (null is empty; rows that repeat are
    one page). A line counts once a page; blank lines never do. The null host is
    one like any other. A host has fewer such lines than (mean lines of a page)
    / ``ratio``; an empty table has none.
    """
    pages = docs.select(F.col(host_col).cast("string").alias("host"), F.col(text_col).cast("string").alias("text"))
    pages = pages.select("host", F.xxhash64(F.coalesce("text", F.lit(""))).alias("page"), "text")
    totals = pages.groupBy("host").agg(F.count_distinct("page").alias("total"))
    lines = pages.select("host", "page", F.explode(_keys(F.col("text"))).alias("line"))
    counts = lines.select("host", "page", "line.x", "line.y").groupBy("host", "x", "y").agg(F.count_distinct("page").alias("n")).where(F.col("n") >= least_pages)
    frequent = counts.alias("c").join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host"))).where(F.col("n") > F.lit(ratio) * F.col("total"))
    return frequent.select("c.host", "x", "y")


def line_dedup(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = 0.1, least_pages: int = 5) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and the columns ``n_lines`` and ``n_dropped``.

    Lines end at ``\\n`` and compare without blanks, tabs and carriage returns
    around them; blank lines are never counted nor dropped. Rows with a null
    host are a site of their own. A null text stays null (0 lines); a text of
    boilerplate alone becomes empty. All rows and other columns are kept,
    whatever they are called; columns called ``n_lines`` or ``n_dropped`` are
    replaced. An empty table gives an empty result.
    """
    host, page, other, bad, clean = fresh(docs.columns, "host_of_row", "page_of_row", "page_of_row_2", "bad_lines", "clean_lines")
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    found = checkpointed(boilerplate(docs, host_col, text_col, ratio, least_pages))
    own_host, own_text = F.col(host_col).cast("string"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if found.count() <= BROADCAST_LINES:
        side = found.groupBy("host").agg(F.collect_list(F.struct("x", "y")).alias(bad)).withColumnRenamed("host", host)
        joined = docs.select(*_quoted(kept)).join(F.broadcast(side), own_host.eqNullSafe(F.col(host)), "left")
    else:
        # Each page's own boilerplate, found by its lines; texts then meet it by page, of which none is as large as a host.
        keys = [F.xxhash64(own_text), F.xxhash64(F.lit("page"), own_text)]
        lines = docs.select(own_host.alias(host), keys[0].alias(page), keys[1].alias(other), F.explode(_keys(F.col(text_col).cast("string"))).alias("line"))
        hit = lines.join(found, F.col(host).eqNullSafe(found["host"]) & (F.col("line.x") == found["x"]) & (F.col("line.y") == found["y"]), "left_semi")
        side = hit.groupBy(host, page, other).agg(F.collect_set("line").alias(bad))
        joined = docs.select(*_quoted(kept)).join(side, own_host.eqNullSafe(F.col(host)) & (keys[0] == F.col(page)) & (keys[1] == F.col(other)), "left")
    lines = _lines(F.col(text_col).cast("string"))
    left = F.when(F.col(bad).isNull(), lines).otherwise(F.filter(lines, lambda x: _is_blank(x) | ~F.array_contains(bad, _key(x))))
    joined = joined.withColumn(clean, left)
    before, after = F.size(lines), F.size(clean)
    return joined.select(
        *(F.when(F.col(text_col).isNotNull(), F.array_join(clean, "\n")).alias(c) if c == text_col else F.col(f"`{c}`") for c in kept),
        F.when(F.col(text_col).isNull(), 0).otherwise(before).cast("long").alias("n_lines"),
        F.when(F.col(text_col).isNull(), 0).otherwise(before - after).cast("long").alias("n_dropped"),
    )


def _quoted(names: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its source's boilerplate lines: how many went, and a digest of what stays."""
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


OP5_SQL = r"""
with pages as (
  select doc_id, source, coalesce(text, '') as t, text is null as is_null from documents),
totals as (select source, count(distinct t) as total from pages group by source),
lines as (
  select distinct source, t, trim(l, E' \t\r') as line
  from (select source, t, unnest(string_split(t, chr(10))) as l from pages) where trim(l, E' \t\r') <> ''),
bad as (
  select c.source, c.line from (select source, line, count(*) as n from lines group by source, line) c
  join totals on c.source is not distinct from totals.source where n >= 5 and n > 0.1 * total),
lists as (select source, list(line) as bad from bad group by source),
cleaned as (
  select doc_id, is_null, string_split(t, chr(10)) as before,
    list_filter(string_split(t, chr(10)), lambda x: trim(x, E' \t\r') = '' or not list_contains(coalesce(lists.bad, []), trim(x, E' \t\r'))) as after
  from pages left join lists on pages.source is not distinct from lists.source)
select doc_id, case when is_null then 0 else len(before) end::bigint as n_lines,
  case when is_null then 0 else len(before) - len(after) end::bigint as n_dropped,
  md5(array_to_string(after, chr(10))) as kept_md5
from cleaned
"""
