"""Token counts by compiled finite-state transducers.

Two deterministic transducers give the number of tokens that byte-level BPE
makes of a text, without making the tokens:

* ``PIECES`` reads classes of code points and marks where the pieces begin
  that the vocabulary's split pattern makes.  It has 13 states, so that a chunk
  of text is a map of states to states; the maps of all chunks of a block are
  stepped at once, composed by a parallel prefix scan, and from the state that
  results for its start every chunk marks its pieces.
* ``BpeCounter`` reads the bytes of a piece. Its transitions carry the change
  of the token count that the byte brings.  Its states are compiled when they
  are first met: a state is all that the rest of the piece can depend on, which
  is, for each start of a token that may still be going on, the token before it
  and the count up to it.  A piece starts in the initial state, so pieces (and
  hence chunks between piece starts) compose by adding their counts.

That the last token of every prefix determines BPE's result is a known
property: a token sequence is what BPE makes of its bytes exactly if every two
neighbours are what BPE makes of theirs.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factspark.llm.common import blocks, repaired, table
from factspark.shipping import shipped

# Classes of code points. The letters that the split pattern's contractions name.
LETTER, NUMBER, OTHER, SPACE, WHITE, APOSTROPHE, END = range(7)
_NAMED = {c: 7 + i for i, c in enumerate("stmdrvel")}
_N_CLASSES = 16
# States: what the piece that is going on looks like so far.
_STATES = "begin letters numbers others space white spaces whites quote quote_r quote_v quote_l contraction".split()
_S = {name: i for i, name in enumerate(_STATES)}
_SUFFIX = 16
HERE, BEFORE = 1, 2  # a piece begins at this symbol; at the one before it


def _piece_transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next states and marks, by ``state * 16 + class``, for the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
    """
    step, mark = np.zeros(16 * _N_CLASSES, np.uint8), np.zeros(16 * _N_CLASSES, np.uint8)
    fresh = {LETTER: "letters", NUMBER: "numbers", OTHER: "others", SPACE: "space", WHITE: "white", APOSTROPHE: "quote", END: "begin"} | dict.fromkeys(_NAMED.values(), "letters")
    grown = {LETTER: "letters", NUMBER: "numbers", OTHER: "others"}
    named = lambda c: next((k for k, v in _NAMED.items() if v == c), "")
    for state in _STATES:
        for c, start in fresh.items():
            kind = LETTER if c in _NAMED.values() else c
            to, out = start, HERE
            if (state, kind) in {("letters", LETTER), ("numbers", NUMBER), ("others", OTHER), ("others", APOSTROPHE), ("quote", OTHER), ("quote", APOSTROPHE)}:
                to, out = {APOSTROPHE: "others"}.get(kind, grown.get(kind)), 0
            elif state in ("space", "spaces", "white", "whites") and kind in (SPACE, WHITE):
                to, out = ("spaces" if kind == SPACE else "whites"), 0
            elif state in ("space", "spaces") and kind != END:  # a space goes with what follows it
                to, out = ("others" if kind == APOSTROPHE else grown[kind]), (BEFORE if state == "spaces" else 0)
            elif state == "whites" and kind != END:  # the last one of a run is a piece by itself
                out = HERE | BEFORE
            elif state == "quote" and named(c) in tuple("stmd"):
                to, out = "contraction", 0
            elif state == "quote" and named(c) in tuple("rvl"):
                to, out = f"quote_{named(c)}", 0
            elif (state, named(c)) in {("quote_r", "e"), ("quote_v", "e"), ("quote_l", "l")}:
                to, out = "contraction", 0
            elif state in ("quote_r", "quote_v", "quote_l"):  # no contraction: the letter began a piece
                to, out = ("letters", BEFORE) if kind == LETTER else (start, HERE | BEFORE)
            step[_S[state] * _N_CLASSES + c], mark[_S[state] * _N_CLASSES + c] = _S[to], out
    return step, mark


STEP, MARK = _piece_transducer()


# First and last code points of the letters and numbers that Unicode 16 added.
_NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
_NEW_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for i in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(i))[0]
        if kind in "LN":
            out[i] = LETTER if kind == "L" else NUMBER
    for kind, spans in ((LETTER, _NEW_LETTERS), (NUMBER, _NEW_NUMBERS)):
        for a, b in spans:
            out[a : b + 1] = kind
    # The code points with the property White_Space.
    for span in ((0x9, 0xD), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        out[span[0] : span[1] + 1] = WHITE
    out[0x20] = SPACE
    out[ord("'")] = APOSTROPHE
    for c, k in _NAMED.items():
        out[ord(c)] = k
    return out


def _chunk_maps(columns: np.ndarray) -> np.ndarray:
    maps = np.repeat(np.arange(len(_STATES), dtype=np.uint8)[:, None], columns.shape[1], axis=1)
    for c in columns:
        maps = STEP[(maps << 4) | c]
    return maps


def piece_starts(symbols: np.ndarray, chunk: int = 256) -> np.ndarray:
    """Whether a piece begins at each symbol, for texts that each end with END."""
    n = len(symbols)
    if not n:
        return np.zeros(0, bool)
    rows = -(-n // chunk)
    padded = np.full(rows * chunk, END, np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(rows, chunk).T)
    # The map of every chunk: each state, stepped through its symbols. If the last few lead from all states to one, so does the whole chunk.
    maps = _chunk_maps(columns[-_SUFFIX:])
    if len(columns) > _SUFFIX and len(open_ := np.flatnonzero((maps != maps[0]).any(0))):
        maps[:, open_] = _chunk_maps(columns[:, open_])
    # Prefix scan: after the round of width w, maps[:, i] covers the chunks i-2w+1 .. i.
    width = 1
    while width < rows:
        later = np.take_along_axis(maps[:, width:], maps[:, :-width], axis=0)
        maps = np.concatenate([maps[:, :width], later], axis=1)
        width *= 2
    state = np.concatenate([[_S["begin"]], maps[_S["begin"], :-1]]).astype(np.uint8)
    marks = np.empty_like(columns)
    for k, c in enumerate(columns):
        edge = (state << 4) | c
        marks[k] = MARK[edge]
        state = STEP[edge]
    marks = marks.T.reshape(-1)[:n]
    starts = (marks & HERE) > 0
    starts[:-1] |= (marks[1:] & BEFORE) > 0
    return starts


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BpeCounter:
    """A transducer from the bytes of a piece to its number of tokens, compiled as far as texts need it."""

    #: Compiled transitions, and counted pieces, that are kept; beyond, they are dropped and made anew.
    MOST_EDGES, MOST_PIECES = 1 << 20, 1 << 19
    #: Bytes of a long piece whose map is kept.
    CHUNK = 64

    def __init__(self, merges: list[tuple[bytes, bytes]], tokens: list[bytes]):
        self._rank = {pair: i for i, pair in reversed(list(enumerate(merges)))}
        if max(map(len, tokens)) > 128:
            raise ValueError("a count may change by 127 at most in one transition")
        self._next: list[dict[int, int]] = [{}]
        self._token: list[bytes | None] = [None]
        for t in tokens:
            node = 0
            for b in t:
                child = self._next[node].get(b)
                if child is None:
                    child = self._next[node][b] = len(self._next)
                    self._next.append({})
                    self._token.append(None)
                node = child
            self._token[node] = t
        self._fits: dict[tuple[bytes | None, bytes], bool] = {}
        self._spines: tuple[dict[bytes, list | None], dict[bytes, list | None]] = ({}, {})
        self._clear()

    def _clear(self) -> None:
        # A state: for every token that may be going on, its trie node, the token before it, and how many tokens that
        # prefix has less than the whole one. The last of them begins right here, after the last token.
        first = ((0, None, 0),)
        self._states, self._ids = [first], {first: 0}
        self._edges: dict[int, int] = {}
        self._maps: dict[tuple[int, bytes], tuple[int, int]] = {}

    def _merge(self, data: bytes) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
        """What BPE makes of the bytes, straight from its definition, and the pair that it merges last."""
        parts, last = [data[i : i + 1] for i in range(len(data))], None
        while len(parts) > 1:
            best, at = min((self._rank.get((a, b), sys.maxsize), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best == sys.maxsize:
                break
            last = (parts[at], parts[at + 1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, last

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, int]] | None:
        """The parts at one side (0: left) of the token while it is merged, the token first, each with the rank that ends it."""
        known = self._spines[side].get(token)
        if known is None and token not in self._spines[side]:
            parts, last = self._merge(token)
            if parts == [token]:
                known = [(token, sys.maxsize)]
                while last:
                    rank = self._rank[last]
                    known.append((last[side], rank))
                    last = self._merge(last[side])[1]
            self._spines[side][token] = known
        return known

    def _may_follow(self, before: bytes | None, token: bytes) -> bool:
        """Whether BPE leaves the two tokens as they are when they stand side by side."""
        key = (before, token)
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= self.MOST_EDGES:
                self._fits.clear()
            left, right = self._spine(token, 0), [(b"", 0)] if before is None else self._spine(before, 1)
            known = left is not None and right is not None
            if known and before is not None:
                # Two parts merge across the border if their pair's turn comes while both are there; of equal pairs the leftmost is first.
                rank = self._rank.get
                known = not any((r := rank((a, b))) is not None and r < a_ends and r <= b_ends for a, a_ends in right for b, b_ends in left)
            self._fits[key] = known
        return known

    def _compile(self, state: int, byte: int) -> int:
        """The transition, as the next state's number times 256, plus the change of the count and 128."""
        grown, ended = [], None
        for node, before, lag in self._states[state]:
            child = self._next[node].get(byte)
            if child is None:
                continue
            token = self._token[child]
            if token is not None and ended is None and self._may_follow(before, token):
                ended = (token, 1 - lag)
            if self._next[child]:
                grown.append((child, before, lag))
        token, change = ended  # every byte is a token, so one of them ends here
        to = (*((node, before, lag + change) for node, before, lag in grown), (0, token, 0))
        if to not in self._ids:
            self._ids[to] = len(self._states)
            self._states.append(to)
        return self._ids[to] << 8 | change + 128

    def count(self, piece: bytes) -> int:
        if len(self._edges) >= self.MOST_EDGES:
            self._clear()
        if len(piece) <= 2 * self.CHUNK:
            return self._walk(0, piece)[1]
        # A long piece is the composition of its chunks' maps; those that were met before aren't walked again.
        state, total = 0, 0
        for at in range(0, len(piece), self.CHUNK):
            key = (state, piece[at : at + self.CHUNK])
            if key not in self._maps:
                if len(self._maps) >= 1 << 14:
                    self._maps.clear()
                self._maps[key] = self._walk(*key)
            state, more = self._maps[key]
            total += more
        return total

    def _walk(self, state: int, data: bytes) -> tuple[int, int]:
        """The state that the bytes lead to, and how the count changes."""
        edges, total = self._edges, 0
        for byte in data:
            edge = edges.get(state << 8 | byte)
            if edge is None:
                edge = edges[state << 8 | byte] = self._compile(state, byte)
            state = edge >> 8
            total += (edge & 255) - 128
        return state, total


class TokenCounter:
    """Counts tokens as the byte-level BPE tokenizer in a ``.json`` file does."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError(f"{path} isn't a plain byte-level BPE tokenizer")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in what is beside them aren't supported")
        of = _byte_of_char()
        raw = lambda token: bytes(of[c] for c in token)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._special = sorted((t["content"].encode() for t in spec["added_tokens"]), key=lambda t: (-len(t), t))
        special = {t["content"] for t in spec["added_tokens"]}
        self._bpe = BpeCounter([(raw(a), raw(b)) for a, b in pairs], [raw(t) for t in model["vocab"] if t not in special])
        self._pieces: dict[bytes, int] = {}

    def _parts(self, raw: bytes) -> tuple[list[bytes], int]:
        """The text between added tokens, and how many of those there are (leftmost first, the longest of several)."""
        found = re.compile(b"|".join(map(re.escape, self._special))).split(raw)
        return [x for x in found if x], len(found) - 1

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of tokens of every text of a block."""
        data, offsets = repaired(data, offsets)
        n, raw = len(offsets) - 1, data.tobytes()
        out = np.zeros(n, np.int64)
        owners = np.arange(n)
        if any(t in raw for t in self._special):
            parts, owned, at = [], [], offsets.tolist()
            for i in range(n):
                between, specials = self._parts(raw[at[i] : at[i + 1]])
                out[i] += specials
                parts += between
                owned += [i] * len(between)
            raw, owners = b"".join(parts), np.array(owned, np.int64)
            data = np.frombuffer(raw, np.uint8)
            offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
        if not len(data):
            return out
        # One symbol for every code point, and END after every text; and the byte at which each symbol begins.
        plain = int(data.max()) < 128
        first = np.arange(len(data)) if plain else np.flatnonzero((data & 0xC0) != 0x80)
        kinds = _classes()[data if plain else np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)]
        ends = np.searchsorted(first, offsets[1:])
        symbols, at = np.insert(kinds, ends, END), np.insert(first, ends, offsets[1:])
        starts = piece_starts(symbols) & (symbols != END)
        begin = at[starts]
        stops = np.append(begin[1:], len(raw))
        # Each different piece of the block is counted once.
        which, each = different(data, begin, stops)
        sums = np.concatenate([[0], np.cumsum(self._count(raw, begin[which], stops[which])[each])])
        edges = np.searchsorted(begin, offsets)
        np.add.at(out, owners, sums[edges[1:]] - sums[edges[:-1]])
        return out


    def _count(self, raw: bytes, begin: np.ndarray, stops: np.ndarray) -> np.ndarray:
        count, known = self._bpe.count, self._pieces
        if len(known) > self._bpe.MOST_PIECES:
            known.clear()
        out = []
        for piece in map(raw.__getitem__, map(slice, begin.tolist(), stops.tolist())):
            tokens = known.get(piece)
            if tokens is None:
                tokens = count(piece)
                if len(piece) <= 64:
                    known[piece] = tokens
            out.append(tokens)
        return np.array(out, np.int64)


def different(data: np.ndarray, begin: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pieces that lie one after the other, the numbers of different ones, and for each piece which of those it is.

    Pieces are told apart by a hash, and then compared byte by byte with the
    first one of their hash: those that differ from it are taken as different.
    """
    sizes = stops - begin
    place = np.arange(begin[0], stops[-1]) - np.repeat(begin, sizes)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
        own = data[begin[0] : stops[-1]]
        hashes = np.add.reduceat((own.astype(np.uint64) + np.uint64(1)) * powers[place], begin - begin[0])
        hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    _, which, each = np.unique(hashes, return_index=True, return_inverse=True)
    first = which[each]
    odd = np.flatnonzero(sizes != sizes[first])
    like = np.minimum(np.repeat(begin[first], sizes) + place, len(data) - 1)
    odd = np.union1d(odd, np.flatnonzero(np.add.reduceat(own != data[like], begin - begin[0])))
    each[odd] = len(which) + np.arange(len(odd))
    return np.concatenate([which, odd]), each


@lru_cache(2)
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for every row, with the tokenizer file at ``tokenizer``.

    Strings of added tokens inside a text count as the library's default has
    it: one token each. A null or empty text has no bytes and no tokens; texts
    are never cut. Rows that repeat or have a null id are returned as often as
    they came, an empty table gives an empty result; other columns are not read.
    The file must be at the same path on the executors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for rows, data, offsets in blocks(batches):
            tokens = counter.counts(data, offsets)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)], names=["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).transform(shipped).mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in the byte-level vocabulary of 50,257 entries."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")
