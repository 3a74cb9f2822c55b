import json

import pytest
from golden import DOCUMENTS
from pyspark.sql import functions as F

from factspark import catalog, schemas
from factspark.operators import graph
from factspark.plans.settings import Settings
from factspark.sources import ingest, readers

BASE = "https://example.org/api"


def test_requests_answers_and_documents(spark):
    # The service stands in for a module that executors can't import: it travels by value.
    documents = [d for d in DOCUMENTS if d["id"] != "Q5"]
    bodies = json.dumps(documents)

    def service():
        known = {d["id"]: d for d in json.loads(bodies)}
        asked: dict[str, int] = {}

        def call(url, accept):
            asked[url] = asked.get(url, 0) + 1
            ids = url.split("ids=")[1].split("&")[0].split("|")
            if "Q404404" in ids:
                raise TimeoutError("timed out")
            return (503, "busy") if asked[url] == 1 else (200, json.dumps({"entities": {i: known[i] for i in ids}}))

        return call

    ids = spark.createDataFrame([(d["id"],) for d in documents] * 2 + [(None,)], "qid string").coalesce(1)
    requests = ingest.entity_requests(ids.coalesce(1), BASE, per_request=20)
    seen = [i for r in requests.collect() for i in r.url.split("ids=")[1].split("&")[0].split("|")]
    assert sorted(seen) == sorted(d["id"] for d in documents)
    bad = spark.createDataFrame([(f"{BASE}?ids=Q404404&x", "application/json")], "url string, accept string")
    empty = spark.createDataFrame([], ingest.ANSWERS)
    todo = ingest.missing(requests.unionByName(bad), empty)
    answers = ingest.fetch(todo, service, wait=lambda s: None).cache()
    states = [(r.status, r.attempt) for r in answers.collect()]
    assert ("ok", 2) in states and ("retry", 1) in states and ("error", 3) in states
    assert ingest.missing(requests, answers).count() == 0
    assert ingest.missing(bad, answers).count() == 1
    tables = readers.graph(spark, ingest.documents_of(answers))
    direct = readers.graph(spark, spark.read.schema(readers.DOCUMENT).json(spark.sparkContext.parallelize([json.dumps(d) for d in documents])))
    for name in ("statements", "entities", "names"):
        assert sorted(map(str, tables[name].collect())) == sorted(map(str, direct[name].collect()))


def test_bindings_and_queries(spark):
    body = json.dumps({"results": {"bindings": [{"item": {"type": "uri", "value": "http://www.wikidata.org/entity/Q7"}}]}})
    answers = spark.createDataFrame([("k", "u", "a", "ok", 200, 1, 5, 1.0, None, None, None, body)], ingest.ANSWERS)
    assert ingest.binding_rows(answers, ["item"]).first().item_qid == "Q7"
    every = catalog.templates(spark)
    settings = Settings("2026", run_date="2026-06-01")
    query = ingest.candidate_query(catalog.by_domain(every, "film_director").first(), settings)
    assert "wdt:P31/wdt:P279* wd:Q11424" in query and "wdt:P57 ?answer" in query and query.endswith("LIMIT 500") and '"2026-01-01T00:00:00Z"' in query
    assert "wdt:P31 wd:Q33506" in ingest.candidate_query(catalog.by_domain(every, "museum_country").first(), settings)
    assert ingest.query_url(BASE, "a b").endswith("query=a%20b&format=json")
    with pytest.raises(ValueError):
        ingest.urllib_transport(proxy="ftp://x")


@pytest.mark.parametrize(("scheme", "login"), [("socks5", ""), ("socks5h", ""), ("socks5h", "me:se%20cret@"), ("socks5h", "me:wrong@")])
def test_socks_proxies(scheme, login):
    import http.server
    import socketserver
    import threading

    class Page(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200)
            self.end_headers()
            self.wfile.write(b"hello " + self.headers["Accept"].encode())

        def log_message(self, *args):
            pass

    kinds = []

    class Proxy(socketserver.StreamRequestHandler):
        def handle(self):
            import socket

            methods = self.rfile.read(self.rfile.read(2)[1])
            self.wfile.write(b"\x05\x02" if 2 in methods else b"\x05\x00")
            if 2 in methods:
                user = self.rfile.read(self.rfile.read(2)[1])
                word = self.rfile.read(self.rfile.read(1)[0])
                good = (user, word) == (b"me", b"se cret")
                self.wfile.write(b"\x01\x00" if good else b"\x01\x01")
                if not good:
                    return
            kind = self.rfile.read(4)[3]
            kinds.append(kind)
            host = socket.inet_ntoa(self.rfile.read(4)) if kind == 1 else self.rfile.read(self.rfile.read(1)[0]).decode()
            onward = socket.create_connection((host, int.from_bytes(self.rfile.read(2), "big")))
            self.wfile.write(b"\x05\x00\x00\x01" + bytes(6))
            request = b""
            while b"\r\n\r\n" not in request:
                request += self.connection.recv(4096)
            onward.sendall(request)
            while more := onward.recv(4096):
                self.wfile.write(more)

    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), Page) as page, socketserver.ThreadingTCPServer(("127.0.0.1", 0), Proxy) as proxy:
        for server in (page, proxy):
            threading.Thread(target=server.serve_forever, daemon=True).start()
        call = ingest.urllib_transport(timeout=5, proxy=f"{scheme}://{login}127.0.0.1:{proxy.server_address[1]}")()
        url = f"http://127.0.0.1:{page.server_address[1]}/x"
        if "wrong" in login:
            with pytest.raises(OSError):
                call(url, "text/plain")
        else:
            assert call(url, "text/plain") == (200, "hello text/plain")
            assert kinds == [1 if scheme == "socks5" else 3]
        for server in (page, proxy):
            server.shutdown()


def test_keys_of_stored_answers(spark):
    rows = spark.createDataFrame([("The  Café (film)", "select ?x\n where"), ("東京", " select ?x where ")], "name string, query string")
    got = rows.select(ingest.search_key(F.col("name")).alias("s"), ingest.query_key(F.col("query")).alias("q"), ingest.entity_key(F.lit("Q1")).alias("e")).collect()
    assert [r.s for r in got] == ["search:the cafe", "search:東京"] and got[0].q == got[1].q and got[0].e == "entity:Q1"


def test_ordered_claims_and_stable_counts(spark):
    q = lambda **k: {p: [{"time": f"+{v}T00:00:00Z"}] for p, v in k.items()}
    rows = [("A", "P69", 0, "normal", "item", "U1", None, None, None, q(P582="2000-01-01")), ("A", "P69", 1, "normal", "item", "U2", None, None, None, q(P582="2003-01-01")), ("A", "P69", 2, "normal", "item", "U3", None, None, None, q(P582="2009-01-01")),
            ("A", "P108", 0, "normal", "item", "E1", None, None, None, q(P580="2004-01-01")), ("B", "P69", 0, "normal", "item", "U1", None, None, None, q(P582="2000-01-01")), ("C", "P50", 0, "normal", "item", "X", None, None, None, None), ("C", "P50", 1, "normal", "item", "Y", None, None, None, None)]
    df = spark.createDataFrame(rows, schemas.STATEMENTS)
    assert [tuple(r) for r in graph.claims_before(df, "P69", "P108").collect()] == [("A", "U2", "2003-01-01")]
    assert {tuple(r) for r in graph.stable_counts(df, "P50").collect()} == {("C", 2, True)}
    assert {tuple(r) for r in graph.stable_counts(df, "P69").collect()} == {("A", 3, False), ("B", 1, False)}
