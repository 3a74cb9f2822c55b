"""Chat formatting with a minimum-cost repair of roles.

Legal conversations are those that an automaton over roles accepts: at most one
system turn, first; then user and assistant turns in turn, the user first; the
assistant last. Dynamic programming over the automaton's states chooses, at the
least cost, which turns are merged with the one before, which get another role,
and where empty turns are inserted; the repaired turns are then rendered.

A run of turns is a matrix of least costs between states, and such matrices
compose by (min, +). So a long conversation is cut, by the rank of its turns,
into chunks of bounded size: the chunks' matrices are made in parallel from the
roles alone and composed in a tree of bounded width; going down the tree picks
the states at the chunks' borders, and the chunks are repaired and rendered in
parallel between those. Most conversations are one chunk and take none of this.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factspark.llm.common import checkpointed, table
from factspark.shipping import shipped

ROLES = ("system", "user", "assistant")
# States: the role of the last turn so far, or the beginning.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
#: Other names under which the roles are known.
ALIASES = {"human": "user", "prompter": "user", "customer": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant", "chatbot": "assistant", "developer": "system"}
MERGE, INSERT, RELABEL = 2, 3, 6
#: A turn without a role, or with one that isn't known, gets one at this cost.
NAME = 1
NEVER = 1 << 40
CHUNK = 1024
#: Matrices that are composed into one.
FAN = 1024
#: Long conversations up to this many are broadcast to find their turns.
BROADCAST_LONG = 100_000

#: Turns that are inserted so that a turn of the given role may follow the state (absent: never).
_BETWEEN = {
    (BEGIN, SYSTEM): (), (BEGIN, USER): (), (BEGIN, ASSISTANT): (USER,), (SYSTEM, USER): (), (SYSTEM, ASSISTANT): (USER,),
    (USER, ASSISTANT): (), (USER, USER): (ASSISTANT,), (ASSISTANT, USER): (), (ASSISTANT, ASSISTANT): (USER,),
}
#: Turns that are inserted at the end.
_LAST = {BEGIN: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def role_code(role: str | None) -> int:
    """The state that a role's turn leads to; 0 for a role that isn't known."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else 0


@lru_cache(None)
def moves(code: int) -> tuple[tuple[int, int, int, bool, tuple[int, ...]], ...]:
    """All ways to take a turn: (from, to, cost, merged, inserted), the preferred one first among equals."""
    out = []
    for to in (SYSTEM, USER, ASSISTANT):
        named = NAME if code == 0 else RELABEL * (code != to)
        for state in range(4):
            if state == to:
                out.append((state, to, named + MERGE, True, ()))
            if (state, to) in _BETWEEN:
                between = _BETWEEN[state, to]
                out.append((state, to, named + INSERT * len(between), False, between))
    return tuple(sorted(out, key=lambda m: (m[2], len(m[4]), not m[3], m[0], m[1])))


def _costs(codes: list[int], start: int | None = None) -> list[list[int]]:
    """Least costs between states; with ``start``, one row a turn: those from the start to each state."""
    if start is not None:
        rows = [[0 if s == start else NEVER for s in range(4)]]
        for code in codes:
            row, above = [NEVER] * 4, rows[-1]
            for a, b, cost, _, _ in moves(code):
                if above[a] + cost < row[b]:
                    row[b] = above[a] + cost
            rows.append(row)
        return rows
    return [_costs(codes, s)[-1] for s in range(4)]


def compose(matrices: list[list[int]]) -> list[int]:
    """The (min, +) product of matrices of 16 costs each, in order."""
    out = matrices[0]
    for m in matrices[1:]:
        out = [min(min(out[4 * a + k] + m[4 * k + b] for k in range(4)), NEVER) for a in range(4) for b in range(4)]
    return out


def best_states(matrices: list[list[int]], start: int = BEGIN, end: int | None = None) -> list[int]:
    """For the matrices of runs of turns in order, the states at their borders, from ``start`` to ``end`` (None: the cheapest legal end)."""
    rows = [[0 if s == start else NEVER for s in range(4)]]
    for m in matrices:
        rows.append([min(rows[-1][a] + m[4 * a + b] for a in range(4)) for b in range(4)])
    if end is None:
        end = min(range(4), key=lambda s: (rows[-1][s] + INSERT * len(_LAST[s]), s))
    states = [end]
    for k in range(len(matrices) - 1, -1, -1):
        states.append(min(range(4), key=lambda a: (rows[k][a] + matrices[k][4 * a + states[-1]], a)))
    return states[::-1]


def repair(codes: list[int], start: int = BEGIN, end: int | None = None) -> list[tuple[int, bool, tuple[int, ...]]]:
    """For each turn: its role, whether it is merged with the one before, and the empty turns before it.

    The turns lead from the state ``start`` to ``end`` (None: to the cheapest
    legal end of a conversation) at the least cost; of equal repairs, the one
    whose last turns change least is taken.
    """
    rows = _costs(codes, start)
    if end is None:
        end = min(range(4), key=lambda s: (rows[-1][s] + INSERT * len(_LAST[s]), s))
    out = []
    for k in range(len(codes), 0, -1):
        a, b, _, merged, between = min((m for m in moves(codes[k - 1]) if m[1] == end), key=lambda m: rows[k - 1][m[0]] + m[2])
        out.append((b, merged, between))
        end = a
    return out[::-1]


OPEN, CLOSE, JOIN = "<|{role}|>\n", "\n<|end|>\n", "\n\n"


def render(texts: list[str], plan: list[tuple[int, bool, tuple[int, ...]]], start: int, last: bool) -> str:
    """A chunk of the rendered conversation: it closes what the chunk before left open, and what it opens only if it is the last."""
    out, state = [], start
    name = lambda s: OPEN.format(role=ROLES[s - 1])
    for text, (role, merged, between) in zip(texts, plan, strict=True):
        if merged:
            out.append(JOIN + text)
        else:
            for empty in between:
                out.append((CLOSE if state else "") + name(empty))
                state = empty
            out.append((CLOSE if state else "") + name(role) + text)
        state = role
    if last:
        for empty in _LAST[state]:
            out.append((CLOSE if state else "") + name(empty))
            state = empty
        out.append(CLOSE if state else "")
    return "".join(out)


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``(id, chunk, n_turns, n_merged, n_relabelled, n_inserted, cost, text)``: repaired conversations, in chunks.

    A chunk holds ``chunk`` turns, the last one of a conversation up to as many,
    whatever the turns' numbers are; a conversation's text is that of its chunks
    0, 1, ... in order (most have one). Turns are ordered by number (null first),
    then role (null first), then the SHA-256 of the text; turns that are equal
    in all three all stay. Null texts are empty; roles are compared without case
    and blanks, by their usual other names, and one that isn't known is named at
    the cost of 1. Turns of a null id are one conversation. An empty table gives
    an empty result. Other columns are never read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = turns.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"),
    )
    kind = turns.schema[id_col].dataType.simpleString()
    long = checkpointed(rows.groupBy("key", "none").agg(F.count("*").alias("n")).where(F.col("n") > chunk).select("key", "none"))
    count = long.count()
    turn = F.struct("turn", "role", "digest", "text")
    ready = ["id", "chunk", "turns", "first", "final", "is_last"]
    whole = lambda df, *at: df.groupBy("key", "none", *at).agg(F.first("id").alias("id"), F.array_sort(F.collect_list(turn)).alias("turns"))
    side = F.broadcast(long) if count <= BROADCAST_LONG else long
    short = whole(rows.join(side, ["key", "none"], "left_anti") if count else rows)
    out = short.select("id", F.lit(0).cast("long").alias("chunk"), "turns", F.lit(BEGIN).alias("first"), F.lit(None).cast("int").alias("final"), F.lit(True).alias("is_last"))
    if count:
        chunks = checkpointed(whole(_ranked(rows.join(side, ["key", "none"], "left_semi"), chunk), "chunk"))
        out = out.unionByName(chunks.join(_borders(chunks), ["key", "none", "chunk"]).select(*ready))

    def fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # rendered texts are as large as what is read: a few at a time
                part = batch.slice(at, 64)
                first, final, last = (part.column(c).to_pylist() for c in ("first", "final", "is_last"))
                columns: dict[str, list] = {c: [] for c in ("n_turns", "n_merged", "n_relabelled", "n_inserted", "cost", "text")}
                for k, own in enumerate(part.column("turns").to_pylist()):
                    codes = [role_code(x["role"]) for x in own]
                    plan = repair(codes, first[k], final[k])
                    tail = _LAST[plan[-1][0] if plan else first[k]] if last[k] else ()
                    inserted = sum(len(x[2]) for x in plan) + len(tail)
                    merged, named = sum(x[1] for x in plan), sum(c != x[0] for c, x in zip(codes, plan, strict=True))
                    cost = MERGE * merged + INSERT * inserted + sum(NAME if c == 0 else RELABEL * (c != x[0]) for c, x in zip(codes, plan, strict=True))
                    text = render([x["text"] for x in own], plan, first[k], last[k])
                    for c, v in zip(columns, (len(own), merged, named, inserted, cost, text), strict=True):
                        columns[c].append(v)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("chunk"), *(pa.array(v, pa.string() if c == "text" else pa.int64()) for c, v in columns.items())], names=["id", "chunk", *columns])

    return out.select(*ready).transform(shipped).mapInArrow(fix, f"id {kind}, chunk bigint, n_turns bigint, n_merged bigint, n_relabelled bigint, n_inserted bigint, cost bigint, text string")


def _ranked(rows: DataFrame, chunk: int) -> DataFrame:
    """Turns of long conversations with ``chunk``, by their rank in the conversation.

    Turns are counted in cells: those of one number and role, split by the first
    12 bits of the digest. Cells are in order, so a turn's rank is its place in
    its cell, and the turns in the cells before; those are summed up within runs
    of turn numbers first, then over the runs.
    """
    part = F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("int")
    run = F.coalesce(F.floor(F.col("turn").try_cast("double") / chunk).cast("long"), F.lit(-(1 << 62)))
    rows = rows.withColumns({"run": run, "part": F.shiftright(part, 4)})
    cell = ["key", "none", "run", "turn", "role", "part"]
    rows = rows.withColumns({"x": F.xxhash64(*cell), "y": F.xxhash64(F.lit("cell"), *cell)})
    cells = rows.groupBy(*cell, "x", "y").agg(F.count("*").alias("n"))
    start = Window.unboundedPreceding
    in_run = F.coalesce(F.sum("n").over(Window.partitionBy("key", "none", "run").orderBy("turn", "role", "part").rowsBetween(start, -1)), F.lit(0))
    runs = cells.groupBy("key", "none", "run").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("key", "none").orderBy("run").rowsBetween(start, -1)), F.lit(0))
    offsets = cells.withColumn("in_run", in_run).join(runs.select("key", "none", "run", before.alias("before")), ["key", "none", "run"]).select("x", "y", (F.col("in_run") + F.col("before")).alias("offset"))
    nth = F.row_number().over(Window.partitionBy("x", "y").orderBy("digest")) - 1
    placed = rows.withColumn("nth", nth).join(offsets, ["x", "y"])
    return placed.withColumn("chunk", F.floor((F.col("nth") + F.col("offset")) / chunk).cast("long")).select("key", "none", "id", "turn", "role", "digest", "text", "chunk")


def _borders(chunks: DataFrame) -> DataFrame:
    """``(key, none, chunk, first, final, is_last)``: the states between which each chunk is repaired."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, list[int]] = {}
        for batch in batches:
            out = []
            for own in batch.column("roles").to_pylist():
                codes = tuple(map(role_code, own))
                if codes not in known:
                    if len(known) > 1 << 10:
                        known.clear()
                    known[codes] = [x for row in _costs(list(codes)) for x in row]
                out.append(known[codes])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("key", "none", "at")] + [pa.array(out, pa.list_(pa.int64()))], names=["key", "none", "at", "costs"])

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [compose([x["costs"] for x in own]) for own in batch.column("own").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("key", "none", "at")] + [pa.array(out, pa.list_(pa.int64()))], names=["key", "none", "at", "costs"])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("at", pa.int64()), ("first", pa.int32()), ("final", pa.int32()), ("is_last", pa.bool_())]))
        for batch in batches:
            out = []
            for own, first, final, last in zip(*(batch.column(c).to_pylist() for c in ("own", "first", "final", "is_last")), strict=True):
                states = best_states([x["costs"] for x in own], first, final)
                out.append([{"at": x["at"], "first": a, "final": b, "is_last": last and k == len(own) - 1} for k, (x, a, b) in enumerate(zip(own, states, states[1:], strict=False))])
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("none"), pa.array(out, kind)], names=["key", "none", "picked"])

    # Up: the matrices of FAN neighbours become one, until each conversation has one group of them.
    group = lambda df: df.groupBy("key", "none", F.floor(F.col("at") / FAN).cast("long").alias("at")).agg(F.array_sort(F.collect_list(F.struct("at", "costs"))).alias("own"))
    node = "key string, none boolean, at bigint, costs array<bigint>"
    levels = [checkpointed(chunks.select("key", "none", F.col("chunk").alias("at"), F.col("turns.role").alias("roles")).transform(shipped).mapInArrow(measure, node))]
    while levels[-1].agg(F.max("at")).first()[0] >= FAN:
        levels.append(checkpointed(group(levels[-1]).transform(shipped).mapInArrow(join_up, node)))
    # Down: each group's ends are given by the group above.
    ends = group(levels[-1]).select("key", "none", "at", F.lit(BEGIN).alias("first"), F.lit(None).cast("int").alias("final"), F.lit(True).alias("is_last"))
    for level in levels[::-1]:
        asked = group(level).join(ends, ["key", "none", "at"])
        picked = asked.transform(shipped).mapInArrow(pick, "key string, none boolean, picked array<struct<at:bigint,first:int,final:int,is_last:boolean>>")
        ends = checkpointed(picked.select("key", "none", F.explode("picked").alias("x")).select("key", "none", "x.*"))
    return ends.withColumnRenamed("at", "chunk")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, repaired and rendered."""
    return format_chats(table(spark, sf_dir, "conversations")).withColumnRenamed("id", "conv_id")
