"""Ingestion: requests to remote services as a table, their answers as another.

This is the only place where a transport is called, and it is always an
injected one. Answers are stored under a key of their request, so a repeated
run asks only for what isn't there, and errors are rows that hide no answer.
"""

from __future__ import annotations

import http.client
import socket
import ssl
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote, urlencode, urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspark.functions.text import cache_key, normalize_name, strip
from factspark.plans.settings import Settings
from factspark.shipping import shipped

#: Answers worth another attempt. Fixed values.
RETRY_STATUSES = (429, 500, 502, 503, 504)
ANSWERS = "cache_key string, url string, accept string, status string, http_status int, attempt int, duration_ms bigint, fetched_at double, error_type string, error_message string, error string, body string"
Transport = Callable[[str, str], tuple[int, str]]


def candidate_query(template, settings: Settings) -> str:
    """A template of one fact as a graph query for a remote service. Its limit must leave room for the uniqueness filter."""
    kind = f"wdt:P31 wd:{template.subject_type_qid}" if template.exact_instance_only else f"wdt:P31/wdt:P279* wd:{template.subject_type_qid}"
    most = min(settings.harvest_limit_per_template, template.retrieval_limit) * settings.over_fetch
    lines = [
        "SELECT ?item ?itemLabel ?answer ?answerLabel ?date WHERE {",
        f"  ?item {kind} ; wdt:{template.date_property_pid} ?date ; wdt:{template.target_property_pid} ?answer .",
        f'  FILTER(?date >= "{settings.target_start_date}T00:00:00Z"^^xsd:dateTime && ?date <= "{settings.date_upper_bound}T23:59:59Z"^^xsd:dateTime)',
        '  SERVICE wikibase:label { bd:serviceParam wikibase:language "en". }',
        f"}} LIMIT {most}",
    ]
    return "\n".join(lines)


def query_url(base: str, query: str) -> str:
    return f"{base}?{urlencode({'query': query, 'format': 'json'}, quote_via=quote)}"


def entity_requests(ids: DataFrame, base: str, id_col: str = "qid", per_request: int = 50, accept: str = "application/json") -> DataFrame:
    """``(url, accept)``: requests for the documents of entities, up to ``per_request`` ids each, every id once."""

    def group(batches: Iterator) -> Iterator:
        import pandas as pd

        rest: list[str] = []
        for pdf in batches:
            rest += pdf["id"].tolist()
            urls = []
            while len(rest) >= per_request:
                urls.append(rest[:per_request])
                rest = rest[per_request:]
            yield pd.DataFrame({"ids": urls})
        if rest:
            yield pd.DataFrame({"ids": [rest]})

    groups = ids.select(F.col(id_col).alias("id")).where("id is not null").distinct().transform(shipped).mapInPandas(group, "ids array<string>")
    tail = F.lit("&props=labels|aliases|descriptions|claims&languages=en&format=json")
    return groups.select(F.concat(F.lit(f"{base}?action=wbgetentities&ids="), F.array_join(F.array_sort("ids"), "|"), tail).alias("url"), F.lit(accept).alias("accept"))


def search_key(name: Column) -> Column:
    """The key of a stored search: the name as it is normalised (as it is written, if nothing is left of it)."""
    norm = normalize_name(name)
    return F.concat(F.lit("search:"), F.when(norm != "", norm).otherwise(F.lower(name)))


def entity_key(qid: Column) -> Column:
    return F.concat(F.lit("entity:"), qid)


def query_key(query: Column) -> Column:
    """The key of a stored query: a hash of its text, white space apart."""
    return F.concat(F.lit("query:"), F.sha2(strip(F.regexp_replace(query, r"(?U)\s+", " ")), 256))


def missing(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Requests that no stored answer without an error is there for."""
    keyed = requests.withColumn("cache_key", cache_key(F.col("accept"), F.col("url"))).dropDuplicates(["cache_key"])
    return keyed.join(answers.where("error is null").select("cache_key"), "cache_key", "left_anti")


def fetch(requests: DataFrame, transport: Callable[[], Transport], attempts: int = 3, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """Answers to ``(cache_key, url, accept)``: a row for every attempt, the last one with the body or the error.

    ``transport`` makes a function of (url, accept) that returns a status and a
    body, on each executor. Waits double from one second up to four. Store the
    result before it is used twice: a plan that runs again asks again.
    """

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        call = transport()
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                for attempt in range(1, attempts + 1):
                    began, status, body, kind, message = time.time(), None, None, None, None
                    try:
                        status, body = call(r.url, r.accept)
                        if status >= 400:
                            kind, message = "HTTPError", f"HTTP {status}"
                    except Exception as error:  # every failure is a row, never the end of the run
                        kind, message = type(error).__name__, str(error)
                    again = kind is not None and attempt < attempts and (status is None or status in RETRY_STATUSES)
                    state = "ok" if kind is None else "retry" if again else "error"
                    rows.append((r.cache_key, r.url, r.accept, state, status, attempt, int(1000 * (time.time() - began)), began, kind, message, message, body if kind is None else None))
                    if not again:
                        break
                    wait(min(2.0 ** (attempt - 1), 4.0))
            names = [x.split()[0] for x in ANSWERS.split(", ")]
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"http_status": "Int32"})

    return requests.select("cache_key", "url", "accept").transform(shipped).mapInPandas(run, ANSWERS)


def documents_of(answers: DataFrame) -> DataFrame:
    """The entity documents in stored answers: the last answer that holds an entity wins."""
    from factspark.sources.readers import DOCUMENT, latest_answers

    bodies = latest_answers(answers).select("fetched_at", F.from_json(F.get_json_object("body", "$.entities"), f"map<string,{DOCUMENT.simpleString()}>").alias("entities"))
    rows = bodies.select("fetched_at", F.explode("entities").alias("id", "doc"))
    last = rows.groupBy("id").agg(F.max_by("doc", "fetched_at").alias("doc"))
    return last.select("id", *(F.col(f"doc.{c}").alias(c) for c in DOCUMENT.names if c != "id"))


def socks_connection(proxy: str, host: str, port: int, timeout: float) -> socket.socket:
    """A connection to a host through a SOCKS 5 proxy (RFC 1928, 1929). ``socks5h`` leaves names to the proxy, ``socks5`` resolves them here."""
    at = urlsplit(proxy)
    conn = socket.create_connection((at.hostname, at.port or 1080), timeout)

    def read(n: int) -> bytes:
        got = b""
        while len(got) < n:
            more = conn.recv(n - len(got))
            if not more:
                raise ConnectionError("the proxy closed the connection")
            got += more
        return got

    try:
        conn.sendall(b"\x05\x02\x00\x02" if at.username else b"\x05\x01\x00")
        method = read(2)[1]
        if method == 2 and at.username:
            user, word = unquote(at.username).encode(), unquote(at.password or "").encode()
            conn.sendall(b"\x01" + bytes([len(user)]) + user + bytes([len(word)]) + word)
            if read(2)[1]:
                raise ConnectionError("the proxy refused the login")
        elif method:
            raise ConnectionError("the proxy offers no login that is known")
        if at.scheme == "socks5h":
            name = host.encode("idna")
            where = b"\x03" + bytes([len(name)]) + name
        else:
            family, *_, address = socket.getaddrinfo(host, port, type=socket.SOCK_STREAM)[0]
            where = (b"\x04" if family == socket.AF_INET6 else b"\x01") + socket.inet_pton(family, address[0])
        conn.sendall(b"\x05\x01\x00" + where + port.to_bytes(2, "big"))
        _, failed, _, kind = read(4)
        if failed:
            raise ConnectionError(f"the proxy could not connect: reply {failed}")
        read({1: 4, 4: 16}.get(kind) or read(1)[0])
        read(2)
    except BaseException:
        conn.close()
        raise
    return conn


def proxy_handlers(proxy: str | None, timeout: float = 30.0) -> list:
    """What ``urllib.request.build_opener`` needs to go through an HTTP(S) or SOCKS 5 proxy; ``ValueError`` for others."""
    if not proxy:
        return []
    scheme = urlsplit(proxy).scheme.lower()
    if scheme in ("http", "https"):
        return [urllib.request.ProxyHandler({"http": proxy, "https": proxy})]
    if scheme not in ("socks5", "socks5h"):
        raise ValueError(f"unsupported proxy: {proxy}")

    class Plain(http.client.HTTPConnection):
        def connect(self) -> None:
            self.sock = socks_connection(proxy, self.host, self.port, timeout)

    class Secure(http.client.HTTPSConnection):
        def connect(self) -> None:
            self.sock = ssl.create_default_context().wrap_socket(socks_connection(proxy, self.host, self.port, timeout), server_hostname=self.host)

    class Handler(urllib.request.HTTPHandler, urllib.request.HTTPSHandler):
        def http_open(self, request):
            return self.do_open(Plain, request)

        def https_open(self, request):
            return self.do_open(Secure, request)

    return [urllib.request.ProxyHandler({}), Handler()]


def urllib_transport(timeout: float = 30.0, user_agent: str = "factspark", proxy: str | None = None) -> Callable[[], Transport]:
    """A transport over HTTP, through an HTTP(S) or SOCKS 5 proxy if there is one (``ValueError`` for other kinds)."""
    proxy_handlers(proxy)

    def make() -> Transport:
        opener = urllib.request.build_opener(*proxy_handlers(proxy, timeout))

        def call(url: str, accept: str) -> tuple[int, str]:
            try:
                with opener.open(urllib.request.Request(url, headers={"Accept": accept, "User-Agent": user_agent}), timeout=timeout) as answer:
                    return answer.status, answer.read().decode()
            except urllib.error.HTTPError as error:
                return error.code, error.read().decode(errors="replace")

        return call

    return make


def binding_rows(answers: DataFrame, variables: list[str]) -> DataFrame:
    """The bindings in stored answers of a query service, as flat columns."""
    from factspark.sources.readers import bindings, latest_answers, results_schema

    parsed = latest_answers(answers).select(F.from_json("body", results_schema(variables)).alias("x"))
    return bindings(parsed.select("x.results"), variables)
