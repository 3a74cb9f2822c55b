from collections import defaultdict

import pytest

from factspark.llm import lines as module
from factspark.llm.lines import line_dedup

SCHEMA = "doc_id long, source string, text string, n_lines string, bad string, host string"
CLASH = "doc_id long, source string, text string, N_Dropped string, `x.y` string, __host string, __bad string, __clean string, host_of_row string, Bad_Lines string, page string"


def slow(rows, ratio=0.1, least=5):
    pages, on = defaultdict(set), defaultdict(set)
    for _, host, text, *_ in rows:
        pages[host].add(text or "")
        for line in (text or "").split("\n"):
            if line.strip(" \t\r"):
                on[host, line.strip(" \t\r")].add(text or "")
    bad = {k for k, v in on.items() if len(v) >= least and len(v) > ratio * len(pages[k[0]])}
    return [(r[0], None if r[2] is None else "\n".join(x for x in r[2].split("\n") if (r[1], x.strip(" \t\r")) not in bad)) for r in rows]


def rows_of():
    rows = [(i, "a", f"menu\n  body {i} \n\ncopyright {i % 30}\t", "x", None, "h") for i in range(60)]
    rows += [(100 + i, "b", f"menu\nother {i}", None, None, None) for i in range(4)]
    rows += [(200 + i, None, f"menu\nnone {i}", None, None, None) for i in range(6)]
    rows += [(300 + i, "copies", "the same\npage", None, None, None) for i in range(50)]
    rows += [(400, "a", None, None, None, None), (401, "a", "", None, None, None), (402, "a", "menu", None, None, None), (403, "a", "word " * 100_000 + "\nmenu\r\nlast", None, None, None)]
    return rows + rows[:1]


@pytest.mark.parametrize("most", [0, 200_000])
def test_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(module, "BROADCAST_LINES", most)
    rows = rows_of()
    out = line_dedup(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "source", "text", "bad", "host", "n_lines", "n_dropped"]
    got = out.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(slow(rows), key=str)
    by = {r.doc_id: r for r in got}
    assert (by[5].n_lines, by[5].n_dropped, by[400].n_lines, by[402].text, by[300].n_dropped) == (4, 1, 0, "", 0)


def test_empty(spark):
    assert line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("most", [0, 200_000])
def test_clashing_names(spark, monkeypatch, most):
    monkeypatch.setattr(module, "BROADCAST_LINES", most)
    rows = [(i, "a", f"menu\nbody {i}", *"dxhbcrlp") for i in range(12)]
    out = line_dedup(spark.createDataFrame(rows, CLASH))
    assert out.columns == ["doc_id", "source", "text", "x.y", "__host", "__bad", "__clean", "host_of_row", "Bad_Lines", "page", "n_lines", "n_dropped"]
    assert sorted(map(tuple, out.collect())) == [(i, "a", f"body {i}", *"xhbcrlp", 2, 1) for i in range(12)]


def test_a_hot_host_is_not_one_task_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(module, "BROADCAST_LINES", 0)
    df = spark.range(20_000).selectExpr("id as doc_id", "'hot' as source", "concat('menu\n', 'body ', id) as text")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r[0] for r in line_dedup(df).rdd.mapPartitions(lambda rows: [(sum(1 for _ in rows),)]).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20_000 and max(sizes) < 8_000
