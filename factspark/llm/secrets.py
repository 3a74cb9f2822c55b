"""Secret scans through a trigram inverted index.

For every rule, a Boolean query over trigrams is derived from its regular
expression's syntax tree: whatever matches the expression must hold those
trigrams.  Texts are indexed block by block (trigram -> bitmap of the block's
texts, only for trigrams that some query names); the query's postings are
intersected and united, and the expression runs over the candidates alone. A
rule from which no trigram follows (a bare character class) scans every text.

The index is local to a block, so nothing is shuffled, a task needs memory for
one block at a time, and a lost executor costs its tasks only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factspark.llm.common import blocks, table
from factspark.shipping import shipped


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if group ``group`` of it has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    ignore_case: bool = False

    @property
    def flags(self) -> int:
        return re.ASCII | (re.IGNORECASE if self.ignore_case else 0)


#: The base rules, in their order, and after them the further ones.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # the runs of [0-9a-f]+ that have 24 characters or more
)
FURTHER = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("forge", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/=-]{16,}", ignore_case=True),
    Rule("url_login", r"://[A-Za-z0-9._~%+-]{1,64}:[^\s:/@]{1,64}@"),
)
RULES = BASE + FURTHER

# A query is True (no condition), a trigram (three bytes, lower case), or ("and" | "or", [queries]).
Query = bool | bytes | tuple
_MOST_STRINGS, _MOST_CLASS = 64, 4


def _and(queries: Sequence[Query]) -> Query:
    flat = list(dict.fromkeys(str(q) for q in queries))
    by_text = {str(q): q for q in queries}
    kept = [by_text[x] for x in flat if by_text[x] is not True]
    return True if not kept else kept[0] if len(kept) == 1 else ("and", kept)


def _or(queries: Sequence[Query]) -> Query:
    by_text = {str(q): q for q in queries}
    return True if not queries or True in by_text.values() else next(iter(by_text.values())) if len(by_text) == 1 else ("or", list(by_text.values()))


def _of_strings(strings: set[bytes]) -> Query:
    """What a text that holds one of the strings must satisfy."""
    return _or([_and([s[i : i + 3] for i in range(len(s) - 2)]) if len(s) > 2 else True for s in sorted(strings)])


def trigram_query(pattern: str, flags: int = 0) -> Query:
    """The trigrams that any text with a match must hold; True where none follow.

    Sound for every pattern that ``re`` accepts: what isn't understood puts no
    condition. Letters are lower-cased, as the index is.
    """

    def fold(code: int) -> bytes | None:
        # Under IGNORECASE without ASCII, some ASCII letters match others outside of ASCII.
        if code > 127 or (flags & re.IGNORECASE and not flags & re.ASCII and chr(code).lower() in "ksi"):
            return None
        return chr(code).lower().encode()

    def strings(op, arg) -> set[bytes] | None:
        """All that the element can match, folded, if that is a small set."""
        if op is sre.LITERAL:
            return None if (c := fold(arg)) is None else {c}
        if op is sre.IN:
            chars: set[bytes] = set()
            for kind, value in arg:
                span = range(value, value + 1) if kind is sre.LITERAL else range(value[0], value[1] + 1) if kind is sre.RANGE else None
                if span is None or len(span) > 2 * _MOST_CLASS or any(fold(x) is None for x in span):
                    return None
                chars |= {fold(x) for x in span}
            return chars if len(chars) <= _MOST_CLASS else None
        if op is sre.AT or op in (sre.ASSERT, sre.ASSERT_NOT):
            return {b""}
        if op is sre.SUBPATTERN:
            return None if arg[1] or arg[2] else of_sequence(arg[3])[0]
        if op is sre.BRANCH:
            sets = [of_sequence(x)[0] for x in arg[1]]
            return None if any(x is None for x in sets) or sum(map(len, sets)) > _MOST_STRINGS else set().union(*sets)
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] <= 3 and (one := of_sequence(arg[2])[0]) is not None:
            found, power = set(), {b""}
            for n in range(arg[1] + 1):
                found |= power if n >= arg[0] else set()
                power = {a + b for a in power for b in one}
                if len(found) + len(power) > _MOST_STRINGS:
                    return None
            return found
        return None

    def condition(op, arg) -> Query:
        """A condition for an element whose strings aren't a small set."""
        if op is sre.SUBPATTERN and not arg[1] and not arg[2]:
            return of_sequence(arg[3])[1]
        if op is sre.BRANCH:
            return _or([of_sequence(x)[1] for x in arg[1]])
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
            return of_sequence(arg[2])[1]
        return True

    def of_sequence(items) -> tuple[set[bytes] | None, Query]:
        run, whole, found = {b""}, True, []
        for op, arg in items:
            more = strings(op, arg)
            joined = {a + b for a in run for b in more} if more is not None else set()
            if more is None or len(joined) > _MOST_STRINGS:
                found += [_of_strings(run), condition(op, arg) if more is None else True]
                run, whole = (more or {b""}), False
            else:
                run = joined
        found.append(_of_strings(run))
        return (run if whole else None), _and(found)

    return of_sequence(sre_parser.parse(pattern, flags))[1]


def _trigrams(query: Query) -> set[bytes]:
    return {query} if isinstance(query, bytes) else set() if query is True else set().union(*map(_trigrams, query[1]))


_LOWER = np.array([ord(chr(i).lower()) if i < 128 else i for i in range(256)], np.uint8)


class TrigramIndex:
    """Postings of a block's texts, as bitmaps, for the trigrams that the queries name."""

    def __init__(self, wanted: Sequence[bytes]):
        self.slot = {t: i for i, t in enumerate(sorted(set(wanted)))}
        self._first_two = np.zeros(1 << 16, bool)
        self._codes = np.array([t[0] << 16 | t[1] << 8 | t[2] for t in self.slot], np.int64)
        self._first_two[self._codes >> 8] = True
        self.postings = np.zeros((len(self.slot), 0), bool)

    def build(self, data: np.ndarray, offsets: np.ndarray) -> TrigramIndex:
        n = len(offsets) - 1
        self.postings = np.zeros((len(self.slot), n), bool)
        if len(data) < 3 or not self.slot:
            return self
        low = _LOWER[data]
        two = low[:-2].astype(np.uint16) << 8 | low[1:-1]
        at = np.flatnonzero(self._first_two[two])
        code = two[at].astype(np.int64) << 8 | low[at + 2]
        slot = np.searchsorted(self._codes, code)
        hit = self._codes[np.minimum(slot, len(self._codes) - 1)] == code
        at, slot = at[hit], slot[hit]
        row = np.searchsorted(offsets, at, side="right") - 1
        inside = at + 2 < offsets[row + 1]
        self.postings[slot[inside], row[inside]] = True
        return self

    def candidates(self, query: Query) -> np.ndarray:
        """A bitmap of the texts that satisfy the query."""
        if query is True:
            return np.ones(self.postings.shape[1], bool)
        if isinstance(query, bytes):
            return self.postings[self.slot[query]]
        return (np.logical_and if query[0] == "and" else np.logical_or).reduce([self.candidates(q) for q in query[1]])


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans)``: for each row, its matches as ``struct<kind, start, end>`` by start, then in the rules' order.

    Matches of one rule are leftmost and don't overlap; those of different
    rules may. Positions are code points, ends exclusive. A null or empty text
    has an empty list; rows that repeat (or have a null id) are returned as
    often as they came; an empty table gives an empty result. Only the two
    named columns are read.
    """
    rules = tuple(rules)
    queries = [trigram_query(r.pattern, r.flags) for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TrigramIndex(sorted(set().union(*map(_trigrams, queries)) if queries else set()))
        compiled = [re.compile(r.pattern, r.flags) for r in rules]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for rows, data, offsets in blocks(batches):
            index.build(data, offsets)
            raw, at = data.tobytes(), offsets.tolist()
            texts: dict[int, str] = {}
            found: list[list[tuple[int, int, int]]] = [[] for _ in range(rows.num_rows)]
            for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
                search = compiled[k].finditer
                for i in np.flatnonzero(index.candidates(query)).tolist():
                    text = texts.get(i)
                    if text is None:
                        text = texts[i] = raw[at[i] : at[i + 1]].decode(errors="replace")
                    found[i] += [(m.start(), k, m.end()) for m in search(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]
            spans = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in sorted(x)] for x in found]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(spans, kind)], names=["id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).transform(shipped).mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of the secrets in every document."""
    base = [r.kind for r in BASE]
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return scan(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        *(count(k).alias(f"n_{k}") for k in base),
        F.sha2(joined(F.filter("spans", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
