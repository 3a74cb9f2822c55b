import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from pyspark.sql import functions as F

from factspark.llm import mixing as module
from factspark.llm.mixing import mix, op7_source_mixing, root_parts, schedule


def slow_schedule(parts):
    """Earliest deadline first, from its definition, over one period."""
    total, done, out = sum(parts.values()), dict.fromkeys(parts, 0), []
    for t in range(total):
        ready = [(-(-(done[s] + 1) * total // parts[s]), s) for s in sorted(parts) if done[s] * total // parts[s] <= t]
        due, s = min(ready)
        assert due > t, "a deadline was missed"
        done[s] += 1
        out.append(s)
    return out


def slow_mix(rows, parts, block):
    order, own = slow_schedule(parts), defaultdict(list)
    for doc, source in rows:
        own[source].append((hashlib.md5(str(doc).encode()).hexdigest(), doc))
    queue = {s: [x[1] for x in sorted(v)] for s, v in own.items()}
    out, slot = {}, 0
    while any(queue.values()):
        s = order[slot % len(order)]
        for k, doc in enumerate(queue.get(s, [])[:block]):
            out[doc] = (slot, slot * block + k)
        queue[s] = queue.get(s, [])[block:]
        slot += 1
    return out


@pytest.mark.parametrize("parts", [{"a": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 1, "b": 1, "c": 97}, {f"s{i:02}": i * i % 17 + 1 for i in range(30)}, {f"s{i:04}": 1 + (i % 50 == 0) + 5 * (i == 7) for i in range(1500)}])
def test_schedule(spark, parts):
    got = schedule(spark.createDataFrame(list(parts.items()), "source string, parts int")).orderBy("slot").collect()
    assert [r.source for r in got] == slow_schedule(parts)
    total, seen = sum(parts.values()), Counter()
    for t, r in enumerate(got, 1):
        assert (r.k, r.parts, r.period) == (seen[r.source], parts[r.source], total)
        seen[r.source] += 1
        if total < 1000 or t % 97 == 0:
            assert all(abs(seen[s] - Fraction(t * parts[s], total)) < 1 for s in parts)


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.source) for r in docs.collect()]
    parts = {r.source: r.parts for r in root_parts(docs).collect()}
    got = {r.doc_id: (r.mix_slot, r.mix_position) for r in op7_source_mixing(spark, sf).collect()}
    assert got == slow_mix(rows, parts, 64)


def test_uneven_sources_and_edges(spark):
    rows = [(i, "big", "x", None) for i in range(500)] + [(1000 + i, "small", None, 3) for i in range(30)] + [(2000 + i, None, "y", 1) for i in range(7)] + [(3000, "", "z", 1), (4000, "other", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, mix_slot int")
    parts = {"big": 3, "small": 2, "": 1}
    given = spark.createDataFrame([*parts.items(), (None, 2), ("absent", 1), ("zero", 0)], "source string, parts int")
    out = mix(df, given, block=4)
    assert out.columns == ["doc_id", "source", "text", "mix_slot", "mix_position"]
    got = {r.doc_id: (r.mix_slot, r.mix_position) for r in out.collect()}
    assert len(got) == len(rows)
    assert got[4000] == (None, None)
    placed = {k: v[1] for k, v in got.items() if v[1] is not None}
    assert len(set(placed.values())) == len(rows) - 1
    assert all(got[2000 + i][0] is not None for i in range(7)) and got[3000][0] is not None
    again = df.where("source in ('big', 'small')")
    got = {r.doc_id: (r.mix_slot, r.mix_position) for r in mix(again, given.where("source in ('big', 'small')"), block=4).collect()}
    assert got == slow_mix([(r[0], r[1]) for r in rows if r[1] in ("big", "small")], {"big": 3, "small": 2}, 4)


def test_repeated_and_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a")] * 5 + [(None, "a")] * 3, "doc_id long, source string")
    got = mix(df, root_parts(df), block=2).collect()
    assert len(got) == 8 and len({r.mix_position for r in got}) == 8
    empty = df.limit(0)
    assert mix(empty, root_parts(empty)).count() == 0
    assert mix(df, root_parts(empty)).where("mix_slot is null").count() == 8


def test_many_sources(spark):
    n = 60_000
    parts = spark.range(n).selectExpr("concat('s', id) as source", "if(id < 100, id + 1, 1) as parts")
    got = schedule(parts).agg(F.count("*"), F.count_distinct("source"), F.max("slot")).first()
    total = n - 100 + 5050
    assert tuple(got) == (total, n, total - 1)


@pytest.mark.parametrize("hot_id", [None, 7])
def test_a_hot_id_is_ranked_in_many_tasks(spark, monkeypatch, hot_id):
    monkeypatch.setattr(module, "BUCKET_ROWS", 16)
    hot = "cast(null as long)" if hot_id is None else f"{hot_id}L"
    df = spark.range(4000).selectExpr(f"if(id < 3000, {hot}, id) as doc_id", "'a' as source", "concat('row ', id) as text")
    got = mix(df, root_parts(df), block=1).collect()
    assert sorted(r.mix_position for r in got) == list(range(4000))
    order = sorted(got, key=lambda r: r.mix_position)
    key = lambda r: hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()
    assert [key(r) for r in order] == sorted(map(key, order))
    rows = df.select(F.struct("*").alias("row"), F.lit("a").alias("s"), F.lit(False).alias("none"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("key"), F.xxhash64("text").alias("tie"))
    assert module._placed(rows).groupBy("bucket", "piece", "sub").count().agg(F.max("count")).first()[0] < 100


def test_maps_and_clashing_names(spark):
    df = spark.createDataFrame([(i, "a", {"k": i}, "r", "b", 1, [{"x": 1}]) for i in range(9)], "doc_id long, source string, row map<string,int>, bucket string, s string, MIX_SLOT int, deep array<map<string,int>>")
    out = mix(df, root_parts(df), block=2)
    assert out.columns == ["doc_id", "source", "row", "bucket", "s", "deep", "mix_slot", "mix_position"]
    got = out.collect()
    assert len({r.mix_position for r in got}) == 9 and all(r.row == {"k": r.doc_id} for r in got)
