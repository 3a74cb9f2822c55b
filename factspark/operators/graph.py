"""Graph patterns over the statements table.

Every pattern is a declarative composition of joins and aggregates; the sizes
that Spark knows at run time decide how they are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factspark.storage import discard, stored


def truthy(statements: DataFrame) -> DataFrame:
    """Statements of the best rank of their subject and property; deprecated ones never."""
    weight = F.when(F.col("rank") == "preferred", 2).when(F.col("rank") == "deprecated", 0).otherwise(1)
    live = statements.where(F.coalesce(F.col("rank"), F.lit("normal")) != "deprecated").withColumn("__w", weight)
    best = live.withColumn("__best", F.max("__w").over(Window.partitionBy("subject", "pid")))
    return best.where("__w = __best").drop("__w", "__best")


def value_key(prefix: str = "") -> Column:
    """A statement's value as one text: the item's id, the time, or the text."""
    return F.coalesce(F.col(f"{prefix}value_id"), F.col(f"{prefix}value_time"), F.col(f"{prefix}value_text"))


def class_closure(subclass_of: DataFrame, roots: DataFrame | None = None, child: str = "child", parent: str = "parent", most_rounds: int | None = None) -> DataFrame:
    """``(cls, root)``: every class and the classes above it, itself included; with ``roots`` (one column), only those above.

    The pairs that are new in a round are joined with the edges, until no new
    ones come, so cycles end and several paths are one pair. Each round stores
    its new pairs only; ``most_rounds`` stops a hierarchy that is too deep.
    """
    edges = subclass_of.select(F.col(child).alias("c"), F.col(parent).alias("p")).where("c is not null and p is not null").distinct()
    if roots is None:
        roots = edges.select(F.explode(F.array("c", "p")).alias("root"))
    known = stored(roots.select(F.col(roots.columns[0]).alias("root")).where("root is not null").distinct().select(F.col("root").alias("cls"), "root"))
    edge, new, rounds = stored(edges), known, 0
    if edge.isEmpty():
        return known
    while True:
        step = new.join(edge, new["cls"] == edge["p"]).select(edge["c"].alias("cls"), "root").distinct()
        new = stored(step.join(known, ["cls", "root"], "left_anti"))
        if new.isEmpty():
            discard(new)
            return known
        rounds += 1
        if most_rounds is not None and rounds >= most_rounds:
            raise ValueError(f"the class hierarchy is deeper than {most_rounds}")
        known = known.unionByName(new)


def instances(statements: DataFrame, types: DataFrame, closure: DataFrame, type_pid: str = "P31") -> DataFrame:
    """``(subject, root)``: subjects by the types asked for.

    ``types`` has ``(root, exact)``: exact types count only when they are stated
    themselves, others also through their subclasses. A subject that comes to
    a type on several paths is one row.
    """
    own = truthy(statements.where(F.col("pid") == type_pid)).where("value_id is not null").select("subject", F.col("value_id").alias("cls")).distinct()
    exact = own.join(types.where("exact").select("root").distinct(), own["cls"] == F.col("root")).select("subject", "root", F.lit(True).alias("exact"))
    wide = own.join(closure, "cls").join(types.where("not exact").select("root").distinct(), "root", "left_semi").select("subject", "root", F.lit(False).alias("exact"))
    return exact.unionByName(wide).distinct()


def having_one(rows: DataFrame, keys: Sequence[str], value: Column, order: Sequence[str]) -> DataFrame:
    """Of each group, its first row in the given order, if the group has one different value only.

    One aggregation instead of a join of the rows with themselves.
    """
    first = F.min_by(F.struct(*rows.columns), F.struct(*order))
    groups = rows.groupBy(*keys).agg(F.count_distinct(value).alias("__n"), first.alias("__row"))
    return groups.where("__n = 1").select("__row.*")


def without_other(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows for which no other row with the same keys has another value (``NOT EXISTS``), duplicates kept."""
    one = rows.groupBy(*keys).agg(F.min(value).alias("__a"), F.max(value).alias("__b")).where("__a = __b").select(*keys)
    return rows.join(one, list(keys), "left_semi")


def pairs_once(rows: DataFrame, left: str, right: str) -> DataFrame:
    """Of symmetric pairs, those whose left side is less, as text."""
    return rows.where(F.col(left).cast("string") < F.col(right).cast("string"))


def earliest_unique(rows: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """The row of each group with the least ``by``, if no other row of the group shares it."""
    w = Window.partitionBy(*keys)
    ranked = rows.withColumn("__least", F.min(by).over(w)).where(F.col(by) == F.col("__least"))
    return ranked.withColumn("__n", F.count("*").over(w)).where("__n = 1").drop("__least", "__n")


def first_by(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each group in a total order."""
    return rows.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")


def series_positions(rows: DataFrame, series: Sequence[str], date: str, edition: str) -> DataFrame:
    """``rows`` with ``position``: the 1-based place of each edition in its series by date, then id.

    An edition with several dates takes several places, and its last one counts.
    """
    w = Window.partitionBy(*series).orderBy(date, edition)
    placed = rows.withColumn("__rn", F.row_number().over(w))
    return placed.withColumn("position", F.max("__rn").over(Window.partitionBy(*series, edition))).drop("__rn")


def references(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(id,)``: what the columns refer to, each once; one pass over the rows."""
    return rows.select(F.explode(F.array(*columns)).alias("id")).where("id is not null").distinct()


def first_bound(*values: Column) -> Column:
    """The first optional value that is there."""
    return F.coalesce(*values)


def union_branches(branches: Sequence[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """The rows of all branches (repeated ones kept), each with the constant columns of its branch."""
    out = None
    for df, constants in branches:
        part = df.select("*", *(c.alias(name) for name, c in constants.items()))
        out = part if out is None else out.unionByName(part)
    return out


def hydrate(rows: DataFrame, entities: DataFrame, id_col: str, prefix: str) -> DataFrame:
    """``rows`` with label, description and aliases of an entity; empty ones where it isn't known."""
    known = entities.select(F.col("qid").alias("__qid"), F.col("label_en").alias(f"{prefix}_label"), F.col("description_en").alias(f"{prefix}_description"), F.col("aliases_en").alias(f"{prefix}_aliases"))
    joined = rows.join(known, F.col(id_col) == F.col("__qid"), "left").drop("__qid")
    return joined.withColumns({
        f"{prefix}_label": F.coalesce(f"{prefix}_label", F.lit("")),
        f"{prefix}_description": F.coalesce(f"{prefix}_description", F.lit("")),
        f"{prefix}_aliases": F.coalesce(f"{prefix}_aliases", F.array().cast("array<string>")),
    })


def chain(rows: DataFrame, statements: DataFrame, from_col: str, pid: str, to_col: str) -> DataFrame:
    """``rows`` followed along one property to items (inner join, repeated rows kept)."""
    hop = truthy(statements.where(F.col("pid") == pid)).where("value_id is not null").select(F.col("subject").alias("__from"), F.col("value_id").alias(to_col))
    return rows.join(hop, F.col(from_col) == F.col("__from")).drop("__from")


def optional(rows: DataFrame, statements: DataFrame, subject_col: str, pid: str, to_col: str) -> DataFrame:
    """``rows`` with a property's time where there is one (left join)."""
    side = truthy(statements.where(F.col("pid") == pid)).where("value_time is not null").select(F.col("subject").alias("__from"), F.substring("value_time", 2, 10).alias(to_col))
    return rows.join(side, F.col(subject_col) == F.col("__from"), "left").drop("__from")


def count_values(statements: DataFrame, pid: str) -> DataFrame:
    """``(subject, n)``: different values of a property, for questions that ask how many."""
    rows = truthy(statements.where(F.col("pid") == pid))
    return rows.groupBy("subject").agg(F.count_distinct(value_key()).alias("n"))


def full_statement_unique(statements: DataFrame, temporal_qualifiers: Sequence[str] = ("P580", "P582", "P585")) -> DataFrame:
    """``(subject, pid, is_unique)``: one value among all statements that aren't deprecated, and none with a qualifier of time."""
    timed = F.exists(F.coalesce(F.map_keys("qualifiers"), F.array().cast("array<string>")), lambda k: k.isin(*temporal_qualifiers))
    rows = statements.where(F.coalesce(F.col("rank"), F.lit("normal")) != "deprecated")
    groups = rows.groupBy("subject", "pid").agg(F.count_distinct(value_key()).alias("n"), F.coalesce(F.bool_or(timed), F.lit(False)).alias("timed"))
    return groups.select("subject", "pid", ((F.col("n") == 1) & ~F.col("timed")).alias("is_unique"))


def stable_counts(statements: DataFrame, pid: str, temporal_qualifiers: Sequence[str] = ("P580", "P582", "P585")) -> DataFrame:
    """``(subject, n, is_stable)``: different values, and whether none of them is deprecated, preferred to others, or tied to a time."""
    timed = F.exists(F.coalesce(F.map_keys("qualifiers"), F.array().cast("array<string>")), lambda k: k.isin(*temporal_qualifiers))
    plain = F.coalesce(F.col("rank"), F.lit("normal")) == "normal"
    rows = statements.where(F.col("pid") == pid)
    return rows.groupBy("subject").agg(F.count_distinct(value_key()).alias("n"), F.bool_and(plain & ~F.coalesce(timed, F.lit(False))).alias("is_stable"))


def claims_before(statements: DataFrame, pid: str, later_pid: str) -> DataFrame:
    """``(subject, value_id, ended)``: the last claim of a property that ended by the start of the subject's first claim of another.

    Both sides are reduced to what decides before they meet, so the join is by
    subject and no pairs of claims are made.
    """
    end = F.get(F.try_element_at("qualifiers", F.lit("P582")), F.lit(0))["time"]
    start = F.get(F.try_element_at("qualifiers", F.lit("P580")), F.lit(0))["time"]
    first = statements.where(F.col("pid") == later_pid).groupBy("subject").agg(F.min(F.substring(start, 2, 10)).alias("begun")).where("begun is not null")
    own = statements.where((F.col("pid") == pid) & F.col("value_id").isNotNull()).select("subject", "value_id", F.substring(end, 2, 10).alias("ended")).where("ended is not null")
    return earliest_unique(own.join(first, "subject").where("ended <= begun").select("subject", "value_id", "ended").withColumn("__back", F.datediff(F.lit("9999-12-31"), F.col("ended").try_cast("date"))).where("__back is not null"), ["subject"], "__back").drop("__back")


def path_connected(path: Column, source: str = "source_qid", target: str = "target_qid") -> Column:
    """Whether each hop's target is the next one's source; a missing end connects to nothing."""
    n = F.size(path)
    ends = F.zip_with(F.slice(path, F.lit(1), n - 1), F.slice(path, F.lit(2), n - 1), lambda a, b: F.coalesce(a[target] == b[source], F.lit(False)))
    return F.when(n >= 2, F.forall(ends, lambda x: x)).otherwise(False)
