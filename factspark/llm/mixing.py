"""Mixing sources to target weights by proportionate-fair scheduling.

Every source is cut into blocks of rows. With ``c`` of ``W`` parts, block ``j``
(from 0) of a source is released in slot ``floor(j W / c)`` and due by slot
``ceil((j + 1) W / c)``; each slot goes to the released block with the earliest
deadline.  As the parts add up to ``W``, all deadlines are met, so in every slot
every source that lasts has been given its share to within less than one block.

Windows repeat every ``W`` slots, so the schedule of one period (``W`` rows) is
all that is ever simulated, by a fold over its slots; blocks of any number of
rows find their slots by a join with it. When a source has ended its slots stay
empty and the others keep their order, so every row has a place. Built-in
functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factspark.llm.common import checkpointed, table

#: Rows of a source are ranked in buckets of about this many rows.
BUCKET_ROWS = 1 << 16
#: Slots that are simulated before they are put away: appending copies what is there.
_GROUP = 1024


def schedule(parts: DataFrame) -> DataFrame:
    """``(source, k, slot, parts, period)``: the slots of one period, from ``(source, parts)``.

    Sources with equally many parts have the same windows and take turns, so
    the fold goes over the different numbers of parts, of which there are at
    most the square root of twice the period, and takes time in proportion to
    that number times the period, however many sources there are. ``k`` numbers
    a source's blocks in the period. Rows with fewer than one part (or null) are
    left out; of equal deadlines the source that sorts first (null before all)
    is first; a source that comes twice is two sources of that name; an empty
    table gives an empty result.
    """
    sources = parts.where("parts >= 1").select("source", F.col("parts").cast("long").alias("parts"))
    sources = sources.withColumn("idx", F.row_number().over(Window.partitionBy().orderBy("source", "parts")))  # one row a source
    classes = sources.groupBy("parts").agg(F.array_sort(F.collect_list("idx")).alias("ids"))
    one = classes.groupBy().agg(F.array_sort(F.collect_list(F.struct("parts", "ids"))).alias("s")).where("size(s) > 0")
    one = one.withColumn("w", F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["parts"] * F.size(x["ids"])))
    kind = "array<struct<idx:int,k:bigint,parts:bigint>>"
    # A class of m sources has done n blocks: the next is block n div m of its member n % m.
    waiting = """
      transform(s, (x, i) -> named_struct(
        'due', ((b.done[i] div size(x.ids) + 1) * w + x.parts - 1) div x.parts, 'idx', x.ids[cast(b.done[i] % size(x.ids) as int)], 'i', i,
        'k', b.done[i] div size(x.ids), 'parts', x.parts, 'open', ((b.done[i] div size(x.ids)) * w) div x.parts <= t))"""
    group = f"""
      aggregate(sequence(g * {_GROUP}, least(g * {_GROUP} + {_GROUP - 1}, w - 1)), named_struct('done', a.done, 'picked', cast(array() as {kind})),
        (b, t) -> element_at(transform(array(array_min(filter({waiting}, y -> y.open))),
          z -> named_struct('done', transform(b.done, (d, i) -> d + if(i = z.i, 1L, 0L)), 'picked', array_append(b.picked, named_struct('idx', z.idx, 'k', z.k, 'parts', z.parts)))), 1))"""
    fold = f"""
      flatten(aggregate(sequence(0L, (w - 1) div {_GROUP}), named_struct('done', transform(s, x -> 0L), 'out', cast(array() as array<{kind}>)),
        (a, g) -> element_at(transform(array({group}), z -> named_struct('done', z.done, 'out', array_append(a.out, z.picked))), 1)).out)"""
    picked = one.select("w", F.expr(fold).alias("picked")).select("w", F.posexplode("picked").alias("slot", "x"))
    named = picked.select("x.idx", "x.k", F.col("slot").cast("long").alias("slot"), "x.parts", F.col("w").alias("period"))
    return named.join(sources.select("idx", "source"), "idx").select("source", "k", "slot", "parts", "period")


def root_parts(docs: DataFrame, source_col: str = "source", total: int = 1000) -> DataFrame:
    """``(source, parts)``: weights in proportion to the square root of each source's rows, in about ``total`` parts.

    Rows count as often as they come, whatever their other columns hold. The
    null source is one like any other, every source has one part at least, and
    an empty table gives an empty result.
    """
    sizes = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count("*").alias("n"))
    share = F.sqrt("n") / F.sum(F.sqrt("n")).over(Window.partitionBy())
    return sizes.select("source", F.greatest(F.lit(1), F.floor(share * total + 0.5)).cast("long").alias("parts"))


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType)) or (isinstance(kind, T.ArrayType) and _has_map(kind.elementType))


def mix(docs: DataFrame, parts: DataFrame, block: int = 64, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` with ``mix_slot`` (of the row's block) and ``mix_position`` (by which rows are in mixed order).

    Within a source, rows come in the order of the MD5 of their id, which is an
    even shuffle; rows with equal (or null) ids are next to one another, in the
    order of a hash of the whole row. Each source is ranked in buckets of that
    order, as many as its size asks for, and ids that very many rows share are
    ranked in buckets of the rows' hash, so no task ever holds a whole source or
    id (rows that are equal in all columns are ranked together, by a sort). Rows
    of sources without parts (the null source is one like any other) come last:
    their slot and position are null. All rows and columns are kept, but for
    earlier columns of these two names. An empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c.lower() not in ("mix_slot", "mix_position")]
    source = F.col(source_col).cast("string")
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    # Maps can't be hashed, but written as text they can.
    content = [F.col(f"`{f.name}`").cast("string") if _has_map(f.dataType) else F.col(f"`{f.name}`") for f in docs.schema.fields if f.name in kept]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.coalesce(source, F.lit("")).alias("s"), source.isNull().alias("none"), key.alias("key"), F.xxhash64(*content).alias("tie"))
    rows = _placed(rows)
    place = ["s", "none", "bucket", "piece", "sub"]
    sizes = rows.groupBy(place).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("s", "none").orderBy("bucket", "piece", "sub").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(*place, before.alias("before"))
    within = F.row_number().over(Window.partitionBy(place).orderBy("key", "tie")) - 1
    ranked = rows.withColumn("rank", within).join(offsets, place).withColumn("rank", F.col("rank") + F.col("before"))
    slots = schedule(parts).select(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("none"), "k", "slot", "parts", "period")
    known = slots.where("k = 0").select("s", "none", F.col("parts").alias("own_parts"))
    # Both sides are as small as the weights (one row for each part): their size decides whether they are broadcast.
    nth = F.floor(F.col("rank") / block).cast("long")
    placed = ranked.join(known, ["s", "none"], "left").withColumn("j", nth).withColumn("k", F.col("j") % F.col("own_parts"))
    placed = placed.join(slots.drop("parts"), ["s", "none", "k"], "left")
    slot = F.floor(F.col("j") / F.col("own_parts")).cast("long") * F.col("period") + F.col("slot")
    return placed.select("row.*", slot.alias("mix_slot"), (slot * block + F.col("rank") % block).cast("long").alias("mix_position"))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``bucket``, ``piece`` and ``sub``, which together rise with (key, tie) within a source, each combination for few rows."""
    largest = rows.groupBy("s", "none").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    digits = 3
    while largest > BUCKET_ROWS << (4 * digits):
        digits += 1
    rows = rows.withColumn("bucket", F.conv(F.substring("key", 1, digits), 16, 10).cast("long"))
    # MD5 is even: a bucket far beyond its share holds a key of many rows.
    full = rows.groupBy("s", "none", "bucket").agg(F.count("*").alias("n")).where(F.col("n") > 4 * BUCKET_ROWS).select("s", "none", "bucket")
    if largest <= 4 * BUCKET_ROWS or (full := checkpointed(full)).isEmpty():
        return rows.withColumns({"piece": F.lit(0), "sub": F.lit(0)})
    keys = rows.join(full, ["s", "none", "bucket"], "left_semi").groupBy("s", "none", "bucket", "key").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_ROWS)
    hot = checkpointed(keys.groupBy("s", "none", "bucket").agg(F.array_sort(F.collect_list("key")).alias("hot")))  # some keys of many rows each
    rows = rows.join(hot, ["s", "none", "bucket"], "left")
    shared = F.coalesce(F.array_contains("hot", F.col("key")), F.lit(False))
    below = F.coalesce(F.size(F.filter("hot", lambda h: h < F.col("key"))), F.lit(0))
    piece = F.when(F.col("hot").isNull(), 0).otherwise(2 * below + shared.cast("int"))
    return rows.withColumns({"piece": piece, "sub": F.when(shared, F.shiftright("tie", 52)).otherwise(0).cast("int")}).drop("hot")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a mixture of the sources by the square root of their sizes, in blocks of 64."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs, root_parts(docs)).select("doc_id", "source", "mix_slot", "mix_position")
