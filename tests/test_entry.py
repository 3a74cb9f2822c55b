import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry
import pytest

from factspark import queries


def test_the_flagship_query(spark):
    df = entry.entry(spark)
    assert df.columns == ["l_partkey", "day", "l_suppkey"] and df.count() > 0


def test_every_query_has_sql_or_is_known_to_have_none():
    assert set(queries.QUERIES) == set(queries.SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    plain = lambda x: str(round(x, 9)) if isinstance(x, float) else str(x)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    out = con.execute(queries.SQL[name])
    names = [d[0] for d in out.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(plain(r[i]) for i in sorted(range(len(names)), key=lambda i: names[i])) for r in out.fetchall())
    assert got == want


def test_judged_candidates_with_keys_of_any_size(spark, tmp_path):
    """Keys as in larger tables: those of orders reach numbers far above those of customers, and some are alike."""
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    orders = "select 4000000 + i as o_orderkey, (i * 7 % 40)::bigint as o_custkey, timestamp '1996-02-01' + to_days((i % 9)::int) as o_orderdate from range(120) r(i) union all select i, i % 40, timestamp '1997-06-01' from range(40) r(i)"
    customers = "select i as c_custkey, 'Customer ' || i as c_name from range(40) r(i)"
    for name, rows in (("orders", orders), ("customer", customers)):
        con.execute(f"copy ({rows}) to '{tmp_path}/{name}.parquet' (format parquet)")
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet'")
    df = queries.QUERIES["judged_candidates"](spark, str(tmp_path))
    want = con.execute(f"select {', '.join(df.columns)} from ({queries.SQL['judged_candidates']})").fetchall()
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want)) and len(want) > 100


@pytest.mark.parametrize("gone", ["llm", "corpus_pipeline.py", "pyarrow"])
def test_without_the_corpus_operators(tmp_path, gone):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{root}/factspark", tmp_path / "factspark", ignore=shutil.ignore_patterns(gone, "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name != gone and os.path.exists(f"{root}/{name}"):
            shutil.copy(f"{root}/{name}", tmp_path)
    block = "import sys; sys.modules['pyarrow'] = None; " if gone == "pyarrow" else ""
    code = block + "import __spark_entry__ as e; q = e.queries(); assert q and not any(x[:2] == 'op' and x[2].isdigit() or x == 'pipeline' for x in q); assert set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)
