import hashlib
import re

import pytest

from factspark.llm.secrets import RULES, Rule, op1_secret_scan, scan, trigram_query


def slow(text):
    """The base rules, from their definition."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [("assign access hex".split()[k], s, e) for s, k, e in sorted(found)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def test_whole_table_against_the_definition(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op1_secret_scan(spark, sf).collect()
    assert len(got) == len(texts) and any(r.n_assign for r in got)
    for r in got:
        want = slow(texts[r.doc_id])
        assert r.base_sha256 == digest(want)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[0] == k for x in want) for k in ("assign", "access", "hex")]
        assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(r.spans.split(","))


def test_edges(spark):
    texts = [
        None, "", "é password: \"abcdef\" tail", "PASSWORD=short api_key='12345' APIKEY=123456", "AKIA" + "A" * 16, "AKIA" + "A" * 15, "f" * 24 + " " + "f" * 23, "token=token=abcdef",
        "x" * 200_000 + " secret = " + "ab" * 30, "Authorization: Bearer abcdefghijklmnop.qr", "postgres://me:hunter2@host/db", "-----BEGIN RSA PRIVATE KEY-----", "to ken = abcdefgh", "toke", "n=abcdefgh",
    ]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(2, texts[2], None)], "doc_id long, text string, spans string")
    rows = scan(df).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        base = [(s.kind, s.start, s.end) for s in r.spans if s.kind in ("assign", "access", "hex")]
        assert base == slow(texts[r.id])
    kinds = {r.id: {s.kind for s in r.spans} for r in rows}
    assert "bearer" in kinds[9] and "url_login" in kinds[10] and "private_key" in kinds[11]
    assert scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert scan(df, rules=[]).where("size(spans) > 0").count() == 0


def test_queries_of_the_rules():
    q = {r.kind: trigram_query(r.pattern, r.flags) for r in RULES}
    assert q["hex"] is True
    assert q["access"] == ("and", [b"aki", b"kia"])
    assert q["assign"][0] == "or" and all(x[0] == "and" for x in q["assign"][1])
    assert trigram_query("a(bc|d)e?f")[0] == "or"
    assert trigram_query("(abc)+x") == b"abc"
    assert trigram_query("(abc)*") is True
    assert trigram_query("abc|d") is True
    assert trigram_query("token", re.A | re.I) == ("and", [b"tok", b"oke", b"ken"])
    assert trigram_query("token", re.I) is True  # "k" also matches the Kelvin sign


@pytest.mark.parametrize("pattern", ["ab[cd]e.f", "(ab|cd){2}e", "x{0,3}yz", r"\bfoo(?=bar)", "[^a]bcd", "(?i:AbC)d"])
def test_queries_are_sound(pattern):
    import itertools

    def holds(q, text):
        return q is True or (q in text if isinstance(q, bytes) else (all if q[0] == "and" else any)(holds(x, text) for x in q[1]))

    q = trigram_query(pattern, re.A)
    for word in ("abcexf", "abdezf", "ababe", "abcde", "xxyz", "yz", "foobar", "zbcd", "ABCd", "abcd"):
        for a, b in itertools.product(("", "q"), repeat=2):
            if re.search(pattern, a + word + b, re.A):
                assert holds(q, (a + word + b).lower().encode()), (pattern, word, q)


def test_a_rule_of_ones_own(spark):
    df = spark.createDataFrame([(1, "id-12 ID-345"), (2, "nothing")], "doc_id long, text string")
    rows = {r.id: [(s.kind, s.start, s.end) for s in r.spans] for r in scan(df, [Rule("ticket", r"id-[0-9]+", 2, ignore_case=True)]).collect()}
    assert rows == {1: [("ticket", 0, 5), ("ticket", 6, 12)], 2: []}
