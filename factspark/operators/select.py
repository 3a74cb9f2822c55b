"""Selection: which candidates become examples.

Greedy selection is sequential by its nature. It is one fold, for which each
template gives only its first few different questions: a template's example is
the first one whose question isn't taken, and no more questions are ever taken
than examples are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factspark.functions import text
from factspark.storage import stored

_FOLD = """
aggregate(array_sort(collect_list(struct(t, c, q))),
  named_struct('last', cast(null as int), 'qs', cast(array() as array<string>), 'acc', cast(array() as array<struct<t:int,c:int,q:string>>)),
  (a, x) -> if(coalesce(a.last = x.t, false) or size(a.acc) >= {total} or array_contains(a.qs, x.q), a,
    named_struct('last', x.t, 'qs', array_append(a.qs, x.q), 'acc', array_append(a.acc, x)))).acc
"""


def greedy(rows: DataFrame, total: int, ok: str = "ok", template: str = "tpl_ord", order: str = "cand_ord", question: str = "question", separate: bool = False) -> DataFrame:
    """``rows`` with ``outcome``: accepted, rejected, or null for rows that were never looked at.

    Templates are taken in order, and their candidates in order. The first one
    that is ``ok``, and whose question (without white space around it) is new, is
    accepted and ends its template; those before it are rejected (with
    ``is_duplicate`` if only the question is known already). When ``total`` are
    accepted, later templates aren't looked at. ``sequence`` numbers the
    accepted ones. A total of 0 still looks at the first template. With
    ``separate``, questions are compared within their template only. The fold
    gets at most ``total`` rows of each template, whatever the table holds.
    """
    ordered = rows.withColumn("__t", F.col(template).cast("int")).withColumn("__c", F.col(order).cast("int")).withColumn("__q", text.strip(F.col(question)))
    if total <= 0:
        ordered = ordered.join(ordered.groupBy().agg(F.min("__t").alias("__first")), F.col("__t") == F.col("__first"), "left_semi")
    most = max(total, 1)
    q = F.concat(F.col("__t").cast("string"), F.lit(":"), F.col("__q")) if separate else F.col("__q")
    kept = ordered.where(F.coalesce(F.col(ok), F.lit(False))).select(F.col("__t").alias("t"), F.col("__c").alias("c"), q.alias("q"))
    # Of a template, only the first ``most`` different questions can matter: one of them is new when it is looked at.
    kept = kept.groupBy("t", "q").agg(F.min("c").alias("c")).withColumn("n", F.row_number().over(Window.partitionBy("t").orderBy("c"))).where(F.col("n") <= most)
    folded = kept.groupBy().agg(F.expr(_FOLD.format(total=most)).alias("acc"))
    accepted = folded.select(F.posexplode("acc").alias("n", "x")).select(F.col("x.t").alias("__t"), F.col("x.c").alias("__won"), (F.col("n") + 1).alias("sequence"))
    last = folded.select(F.when(F.size("acc") >= most, F.element_at("acc", -1)["t"]).alias("__last"))
    # One row for the run, and one for each accepted example, of which there are ``total`` at most.
    side = F.broadcast if most <= 100_000 else lambda df: df
    joined = ordered.join(side(accepted), "__t", "left").withColumn("__one", F.lit(1)).join(F.broadcast(last.withColumn("__one", F.lit(1))), "__one")
    c, won = F.col("__c"), F.col("__won")
    seen = F.col("__last").isNull() | (F.col("__t") <= F.col("__last"))
    outcome = F.when(c == won, "accepted").when(seen & (won.isNull() | (c < won)), "rejected")
    return joined.withColumns({
        "outcome": outcome,
        "is_duplicate": F.coalesce((outcome == "rejected") & F.col(ok), F.lit(False)),
        "sequence": F.when(c == won, F.col("sequence")),
    }).drop("__t", "__c", "__q", "__won", "__one", "__last", "__first")


def by_quota(rows: DataFrame, total: int, group: str = "domain", ok: str = "ok", question: str = "question", subject_property: bool = True) -> DataFrame:
    """``rows`` with ``outcome`` and ``sequence``, several examples of a template if its group's quota allows.

    Of rows that are ``ok``, the first of each normalised question stays and,
    with ``subject_property``, of those the first of each subject and property
    (the others have ``is_duplicate``). The groups' quotas of ``total`` are even,
    and what small groups leave goes to larger ones; rows beyond have
    ``over_quota``. All rows that aren't accepted are rejected.
    """
    order = ["tpl_ord", "cand_ord"]
    norm = text.normalize_name(F.col(question))
    good = rows.where(F.coalesce(F.col(ok), F.lit(False))).select(*dict.fromkeys([*order, group, "subject_qid", "target_property_pid"]), F.when(norm != "", norm).otherwise(text.strip(F.col(question))).alias("q"))
    kept = stored(dedup(good, [["q"], *([["subject_qid", "target_property_pid"]] if subject_property else [])], order).select(*dict.fromkeys([*order, group])))
    quotas = spread_quota(kept.groupBy(F.col(group).alias("domain")).agg(F.count("*").alias("n")), total).withColumnRenamed("domain", "__group")
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).join(quotas, F.col(group).eqNullSafe(F.col("__group"))).select(*order, (F.col("rank") <= F.col("quota")).alias("within"))
    # At most ``total`` examples are numbered.
    numbers = ranked.where("within").withColumn("sequence", F.row_number().over(Window.partitionBy().orderBy(*order))).select(*order, "sequence")
    out = rows.join(ranked, order, "left").join(numbers, order, "left")
    passed, within = F.coalesce(F.col(ok), F.lit(False)), F.col("within")
    return out.withColumns({
        "outcome": F.when(within, "accepted").otherwise("rejected"), "is_duplicate": passed & within.isNull(), "over_quota": passed & F.coalesce(~within, F.lit(False)),
    }).drop("within")


def numbered(rows: DataFrame, prefix: str, order: list[str | Column], name: str = "id") -> DataFrame:
    """``rows`` with ids ``prefix_000001`` and on, in the given order.

    Rows are cut into ranges of the order and sorted within them, and stored;
    each range then starts where the rows before it end.
    """
    first, last = 33, (1 << 33) - 1  # an id of ``monotonically_increasing_id`` is the partition, then 33 bits for the row in it
    ranged = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id()))
    sizes = ranged.groupBy(F.shiftright("__m", first).alias("__p")).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy().orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.withColumn("__p", F.shiftright("__m", first)).join(F.broadcast(sizes.select("__p", before.alias("__before"))), "__p")  # one row a partition
    number = F.col("__before") + F.col("__m").bitwiseAND(last) + 1
    return placed.withColumn(name, F.format_string("%s_%06d", F.lit(prefix), number)).drop("__m", "__p", "__before")


def quota(rows: DataFrame, group: str, most: Column | int, order: list[str]) -> DataFrame:
    """The first rows of each group, up to its quota."""
    ranked = rows.withColumn("__rn", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.where(F.col("__rn") <= most).drop("__rn")


def spread_quota(available: DataFrame, total: int) -> DataFrame:
    """``(domain, quota)`` from ``(domain, n)``: an even share of ``total``, and what small domains leave goes to the larger ones.

    Shares rise evenly until the total is given away: of two domains with rows
    left, the one with the smaller share, then name, gets the next.
    """
    turns = available.where("n > 0").select("domain", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(total)).cast("int"))).alias("turn"))
    given = turns.orderBy("turn", "domain").limit(total).groupBy("domain").agg(F.max("turn").cast("long").alias("quota"))
    return available.select("domain").join(given, "domain", "left").select("domain", F.coalesce("quota", F.lit(0).cast("long")).alias("quota"))


def dedup(rows: DataFrame, keys: list[list[Column | str]], order: list[str]) -> DataFrame:
    """Rows that come first, in order, under each of several keys (a normalised question, a subject with its property)."""
    for key in keys:
        rows = rows.withColumn("__rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__rn = 1").drop("__rn")
    return rows


def not_resumed(work: DataFrame, manifest: DataFrame, version: int, target_time: str) -> DataFrame:
    """Templates that no earlier run of the same version and target time has done."""
    done = manifest.where((F.col("resume_version") == version) & (F.col("target_time") == target_time)).select("domain").distinct()
    return work.join(done, "domain", "left_anti")


def template_status(domains: DataFrame, outcomes: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """``(domain, accepted, rejected, status)``: accepted, rejected_only, no_result, or error:<type>."""
    counts = outcomes.groupBy("domain").agg(F.count_if(F.col("outcome") == "accepted").alias("accepted"), F.count_if(F.col("outcome") == "rejected").alias("rejected"))
    out = domains.select("domain").distinct().join(counts, "domain", "left").na.fill(0, ["accepted", "rejected"])
    status = F.when(F.col("accepted") > 0, "accepted").when(F.col("rejected") > 0, "rejected_only").otherwise("no_result")
    if errors is not None:
        out = out.join(errors.groupBy("domain").agg(F.min("error_type").alias("__error")), "domain", "left")
        status = F.when(F.col("__error").isNotNull(), F.concat(F.lit("error:"), F.col("__error"))).otherwise(status)
    return out.withColumn("status", status).drop("__error")
