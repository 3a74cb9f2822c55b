import random

import pytest

from factspark.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


def compare(spark, name, folder):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    df = queries.queries()[name](spark, folder)
    got = sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
    out = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in out.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(str(r[i]) for i in sorted(range(len(names)), key=lambda i: names[i])) for r in out.fetchall())
    assert got == want and got


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_on_the_test_tables(spark, name):
    compare(spark, name, "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def messy(tmp_path_factory):
    """Tables with nulls, copies and every kind of illegal conversation, one file each."""
    pa, pq = pytest.importorskip("pyarrow"), pytest.importorskip("pyarrow.parquet")
    rng, folder = random.Random(6), tmp_path_factory.mktemp("messy")
    roles = ["user", "assistant", "system", "Human ", "gpt", "tool", None]
    turns = [(c, t, rng.choice(roles), rng.choice([None, "", f"text {c} {t} é"])) for c in range(150) for t in range(rng.randrange(1, 9))]
    pieces = ["token = abcdef1", "API_KEY:'zzz'", "AKIA" + "Z9" * 9, "a" * 25, "é", "password=", "xoxb-0123456789-ab", "://u:p@h", "\n", "Bearer abcdefghijklmnopq"]
    docs = [(i, None if i % 17 == 0 else " ".join(rng.choice(pieces) for _ in range(rng.randrange(9))), "en", None if i % 5 == 0 else f"s{i % 3}", 1) for i in range(300)]
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(20)]
    vectors = [(i, None if i % 23 == 0 else [x + rng.gauss(0, 0.02) for x in base[i % 20]] if i % 7 else base[i % 20] if i % 2 else [0.0] * 8, None if i % 29 == 0 else i % 2) for i in range(200)]
    table = lambda rows, **kinds: pa.table({k: pa.array([r[j] for r in rows], t) for j, (k, t) in enumerate(kinds.items())})
    i64, s = pa.int64(), pa.string()
    made = {
        "conversations": table(turns, conv_id=i64, turn=i64, role=s, text=s), "documents": table(docs, doc_id=i64, text=s, lang=s, source=s, n_chars=i64),
        "embeddings": table(vectors, vec_id=i64, embedding=pa.list_(pa.float32()), label=pa.int32()), "pages": table([(1, "u", "h")], page_id=i64, url=s, html=s),
        "benchmark": table([(1, "x")], item_id=i64, text=s), "labels": table([(1, 0, 0)], doc_id=i64, quality=pa.int32(), toxic=pa.int32()),
    }
    for name, t in made.items():
        pq.write_table(t, folder / f"{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["op1_secret_scan", "op5_line_dedup", "op6_chat_format", "op10_embedding_near_dedup"])
def test_on_messy_tables(spark, messy, name):
    compare(spark, name, messy)
