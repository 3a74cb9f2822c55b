"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Test items are short and few, training documents are many. Seeds join documents
with items: all three-word sequences of an item, and the rarer half, by the
number of documents that hold each, of its two-word sequences that occur at all.
Longer sequences alone would miss a copy of which every third word was changed;
common short ones would join everything. One long seed, or two different short
ones, make a document and an item a pair; around the seeds that they share, a
window of the document is aligned with the item word by word, and the best local
alignment's score, as a share of the score of the item with itself, is the match.

Items are taken in blocks of bounded size, which travel to the executors;
documents are read where they lie and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from factspark.llm.common import blocks, table
from factspark.shipping import shipped

N, SHORT = 3, 2
MATCH, MISMATCH, GAP = 2, -1, -1
#: Half of a short item is common language: a match is worth so many equal words, or the whole item but for one edit.
LEAST_WORDS = 8
#: Test items that travel together: a block holds at most so many items and characters, some 100 MB of arrays.
BLOCK_ITEMS, BLOCK_CHARS = 1 << 20, 16 << 20
#: Common seeds, each with each of its items, that are held at a time.
_PAIRS = 1 << 21
_SLOTS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def _fold() -> np.ndarray:
    """Letters in lower case, digits and the bytes of other scripts stay; all else is 0."""
    out = np.zeros(256, np.uint8)
    out[128:] = np.arange(128, 256)
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
        out[c] = c
    for c in range(ord("A"), ord("Z") + 1):
        out[c] = c + 32
    return out


_FOLD = _fold()


def _beyond_ascii(data: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``low`` without the punctuation of Latin-1, general, East Asian and full-width blocks, and which bytes are characters of scripts without spaces."""
    second, third = (np.concatenate([data[k:], np.zeros(k, np.uint8)])[: len(data)] for k in (1, 2))
    within = lambda x, a, b: (x >= a) & (x <= b)
    marks2 = (data == 0xC2) & ~np.isin(second, (0xAA, 0xB5, 0xBA))
    marks3 = ((data == 0xE2) & within(second, 0x80, 0x81)) | ((data == 0xE3) & (second == 0x80) & ~within(third, 0x85, 0x87))
    marks3 |= (data == 0xEF) & (second == 0xBC) & ~within(third, 0x90, 0x99) & ~within(third, 0xA1, 0xBA)
    marks3 |= (data == 0xEF) & (second == 0xBD) & ((third == 0x80) | within(third, 0x9B, 0xA5))
    # Kana and ideographs; Thai and Lao, Burmese, Khmer.
    alone3 = within(data, 0xE3, 0xE9) | ((data == 0xEF) & within(second, 0xA4, 0xAB)) | ((data == 0xE0) & within(second, 0xB8, 0xBB))
    alone3 = (alone3 | ((data == 0xE1) & (within(second, 0x80, 0x81) | within(second, 0x9E, 0x9F)))) & ~marks3
    alone4 = (data == 0xF0) & within(second, 0xA0, 0xB3)

    def spread(lead: np.ndarray, n: int) -> np.ndarray:
        out = lead.copy()
        for k in range(1, n):
            out[k:] |= lead[:-k]
        return out

    return np.where(spread(marks2, 2) | spread(marks3, 3), np.uint8(0), low), spread(alone3, 3) | spread(alone4, 4)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block's texts, and where each text's words begin (n + 1 numbers).

    A word is a run of ASCII letters (either case), digits and letters of other
    scripts; accented capital Latin letters count as small. In scripts that are
    written without spaces each character is a word.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = _FOLD[data]
    low[1:] |= ((low[1:] & 0xE0 == 0x80) & (low[:-1] == 0xC3)).astype(np.uint8) << 5
    first = np.empty(len(data), bool)
    if data.max() > 127:
        low, alone = _beyond_ascii(data, low)
        inside = low > 0
        first[:] = inside
        first[1:] &= ~inside[:-1] | (((data[1:] & 0xC0) != 0x80) & (alone[1:] | alone[:-1]))
    else:
        inside = low > 0
        first[:] = inside
        first[1:] &= ~inside[:-1]
    first[offsets[:-1][offsets[:-1] < len(data)]] |= inside[offsets[:-1][offsets[:-1] < len(data)]]
    start = np.flatnonzero(first)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    # A word's hash is a polynomial in its bytes: each byte times a power of its place within the word, summed.
    place = np.arange(len(data)) - start[np.maximum(np.cumsum(first) - 1, 0)]
    powers = np.cumprod(np.full(int(place.max()) + 2 if len(place) < 1 << 31 else 0, _BASE, np.uint64))
    value = np.where(inside, low.astype(np.uint64) * powers[np.maximum(place, 0)], np.uint64(0))
    hashes = np.add.reduceat(value, start)
    hashes ^= hashes >> np.uint64(29)
    return hashes * _MIX, np.searchsorted(start, offsets)


def grams(hashes: np.ndarray, cuts: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of words within texts, and the number of the word each begins with. A shorter text is one gram."""
    out = np.zeros(len(hashes), np.uint64)
    left = np.repeat(cuts[1:], np.diff(cuts)) - np.arange(len(hashes))
    whole = left >= n
    for k in range(n):
        part = hashes[k:]
        out[: len(part)] = (out[: len(part)] * _BASE) + part
    short = np.diff(cuts)
    for i in np.flatnonzero((short > 0) & (short < n)).tolist():
        value = np.uint64(0)
        with np.errstate(over="ignore"):
            for h in hashes[cuts[i] : cuts[i + 1]]:
                value = value * _BASE + h
        out[cuts[i]] = value
        whole[cuts[i]] = True
    at = np.flatnonzero(whole)
    return out[at], at


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """The best local alignment of two sequences of words: its score, and the first and last (exclusive) word of it in the window."""
    n = len(window)
    score, best, end = np.zeros(n + 1, np.int64), 0, 0
    begin = np.arange(n + 1)
    span = np.arange(n + 1)
    found = (0, 0, 0)
    for word in item:
        same = np.where(window == word, MATCH, MISMATCH)
        diagonal = score[:-1] + same
        up = score[1:] + GAP
        own = np.concatenate([[0], np.maximum(diagonal, up)])
        source = np.concatenate([[0], np.where(diagonal >= up, begin[:-1], begin[1:])])
        source = np.where(own > 0, source, span)
        own = np.maximum(own, 0)
        # Gaps in the item: the best of all cells to the left, each less its distance.
        raised = own - GAP * span
        top = np.maximum.accumulate(raised)
        leader = np.maximum.accumulate(np.where(raised == top, span, 0))
        score, begin = top + GAP * span, source[leader]
        k = int(score.argmax())
        if score[k] > best:
            best, end = int(score[k]), k
            found = (best, int(begin[k]), end)
    return found


@dataclass(frozen=True)
class Seeds:
    """n-grams to look for (sorted), each with the items, and places in them, that it comes from: those of gram ``k`` are at ``starts[k]`` to ``starts[k + 1]``."""

    grams: np.ndarray
    starts: np.ndarray
    items: np.ndarray
    places: np.ndarray

    @staticmethod
    def of(gram: np.ndarray, item: np.ndarray, place: np.ndarray) -> Seeds:
        order = np.lexsort((place, item, gram))
        keys, starts = np.unique(gram[order], return_index=True)
        return Seeds(keys, np.append(starts, len(gram)), item[order].astype(np.int32), place[order].astype(np.int32))


@dataclass
class Items:
    """A block of test items: their ids, and their words one after the other."""

    ids: list
    hashes: np.ndarray
    cuts: np.ndarray
    seeds: tuple[Seeds, ...] = ()
    vocabularies: dict[int, frozenset[int]] = field(default_factory=dict)

    @staticmethod
    def of(ids: list, texts: list[str]) -> Items:
        raw = [(t or "").encode(errors="replace") for t in texts]
        return Items(ids, *words(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All n-grams of the items, with the item and the place in it; for ``n`` < N, none of items that are shorter than N."""
        gram, at = grams(self.hashes, self.cuts, n)
        item = np.searchsorted(self.cuts, at, side="right") - 1
        keep = np.ones(len(at), bool) if n == N else (np.diff(self.cuts) >= N)[item]
        return gram[keep], item[keep], (at - self.cuts[item])[keep]

    def words(self, i: int) -> np.ndarray:
        return self.hashes[self.cuts[i] : self.cuts[i + 1]]

    def vocabulary(self, i: int) -> frozenset[int]:
        known = self.vocabularies.get(i)
        if known is None:
            if len(self.vocabularies) > 20_000:
                self.vocabularies.clear()
            known = self.vocabularies[i] = frozenset(self.words(i).tolist())
        return known


def rarer_half(gram: np.ndarray, item: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """Which of the items' grams are in the rarer half of those of their item that occur; all that are as rare as the last of that half."""
    there = np.flatnonzero(frequency > 0)
    order = there[np.lexsort((frequency[there], item[there]))]
    own = item[order]
    bounds = np.flatnonzero(np.diff(own, prepend=-1))
    sizes = np.diff(np.append(bounds, len(own)))
    limit = np.zeros(int(item.max(initial=-1)) + 1, np.int64)
    limit[own[bounds]] = frequency[order[bounds + (sizes + 1) // 2 - 1]]
    return (frequency > 0) & (frequency <= limit[item])


def _hits(gram: np.ndarray, wanted: np.ndarray, filter_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which grams are wanted, and their places among the wanted (sorted) ones."""
    maybe = np.flatnonzero(filter_[(gram >> np.uint64(64 - _SLOTS)).astype(np.int64)])
    place = np.searchsorted(wanted, gram[maybe])
    hit = wanted[np.minimum(place, len(wanted) - 1)] == gram[maybe] if len(wanted) else np.zeros(0, bool)
    return maybe[hit], place[hit]


def _filter(wanted: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << _SLOTS, bool)
    out[(wanted >> np.uint64(64 - _SLOTS)).astype(np.int64)] = True
    return out


def gram_frequencies(docs: DataFrame, wanted: np.ndarray, text_col: str = "text", n: int = N) -> DataFrame:
    """``(gram, n)``: how many texts hold each of the wanted n-grams (as signed longs).

    Grams that no text holds have no row; a null or empty text holds none; rows
    that repeat count as often as they come. Counts are summed up before they
    are shuffled.
    """
    known = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = known.value
        keep, total = _filter(wanted), np.zeros(len(wanted), np.int64)
        for _, data, offsets in blocks(batches):
            hashes, cuts = words(data, offsets)
            gram, at = grams(hashes, cuts, n)
            where, place = _hits(gram, wanted, keep)
            row = np.searchsorted(cuts, at[where], side="right") - 1
            once = np.unique(place.astype(np.int64) * len(offsets) + row) // len(offsets)
            total += np.bincount(once, minlength=len(wanted))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[some].view(np.int64)), pa.array(total[some])], names=["gram", "n"])

    counted = docs.select(F.col(text_col).cast("string").alias("text")).transform(shipped).mapInArrow(run, "gram bigint, n bigint")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def _seeds(texts: DataFrame, items: Items) -> tuple[Seeds, ...]:
    """All long seeds of the items, and the rarer half of their short ones by document frequency (one number a gram comes to the driver)."""
    gram, item, place = items.grams(SHORT)
    wanted = np.unique(gram)
    counts = np.zeros(len(wanted), np.int64)
    if len(wanted):
        got = gram_frequencies(texts, wanted, n=SHORT).toArrow()
        counts[np.searchsorted(wanted, got.column("gram").to_numpy().view(np.uint64))] = got.column("n").to_numpy()
    rare = rarer_half(gram, item, counts[np.searchsorted(wanted, gram)]) if len(gram) else np.zeros(0, bool)
    return Seeds.of(*items.grams(N)), Seeds.of(gram[rare], item[rare], place[rare])


def _shared(seeds: Seeds, keep: np.ndarray, hashes: np.ndarray, cuts: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """``(row, word, place)`` of the seeds that the texts hold: the text, the word of the block at which it is, and which seed."""
    gram, at = grams(hashes, cuts, n)
    where, place = _hits(gram, seeds.grams, keep)
    return np.searchsorted(cuts, at[where], side="right") - 1, at[where], place


def _pairs(items: Items, found: list[tuple[np.ndarray, ...]], cuts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(row, item, words, places)`` for each text and item with one long seed or two different short ones in common."""
    # Texts are taken together as long as their seeds, each with each of its items, are few enough; a longer text by itself.
    weight = np.zeros(len(cuts), np.int64)
    for (row, _, place), seeds in zip(found, items.seeds, strict=True):
        np.add.at(weight, row, (seeds.starts[1:] - seeds.starts[:-1])[place])
    total = np.cumsum(weight)
    at = 0
    while at < len(cuts) - 1:
        end = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + _PAIRS, side="right")), at + 1)
        parts = []
        for kind, ((row, word, place), seeds) in enumerate(zip(found, items.seeds, strict=True)):
            some = slice(*np.searchsorted(row, [at, end]))
            row, word, place = row[some], word[some], place[some]
            n = (seeds.starts[1:] - seeds.starts[:-1])[place]
            each = np.repeat(seeds.starts[place] - np.cumsum(n) + n, n) + np.arange(n.sum())
            parts.append((np.repeat(row, n), np.repeat(word - cuts[row], n), seeds.items[each].astype(np.int64), seeds.places[each].astype(np.int64), np.full(len(each), kind == 0)))
        row, word, item, place, long = (np.concatenate(x) for x in zip(*parts, strict=True))
        at = end
        if not len(row):
            continue
        key = row * len(items.ids) + item
        order = np.lexsort((word - place, key))
        key, word, place, long = key[order], word[order], place[order], long[order]
        bounds = np.flatnonzero(np.diff(key, prepend=-1))
        good = np.logical_or.reduceat(long, bounds) | (np.minimum.reduceat(place, bounds) < np.maximum.reduceat(place, bounds))
        ends = np.append(bounds[1:], len(key))
        for a, b in zip(bounds[good].tolist(), ends[good].tolist(), strict=True):
            yield int(key[a]) // len(items.ids), int(key[a]) % len(items.ids), word[a:b], place[a:b]


def _enough(item: np.ndarray, known: frozenset[int], window: np.ndarray, need: float) -> bool:
    there = window.tolist()
    if sum(w in known for w in there) < need:
        return False
    there = set(there)
    return sum(w in there for w in item.tolist()) >= need


def least_score(length: int, threshold: float) -> float:
    """What an item of so many words must reach: the threshold, or LEAST_WORDS of its words; an item that short may have one word left out or changed, if it has five."""
    return max(threshold, min((length - 1.5) / length if length >= 5 else 1.0, LEAST_WORDS / length))


def _match(items: Items, i: int, rows: np.ndarray, places: list[tuple[int, int]], threshold: float) -> tuple[float, int, int] | None:
    """The best alignment of an item with the words of a text, near their common seeds: (place in text, place in item), in order of the difference."""
    item = items.words(i)
    least = least_score(len(item), threshold)
    known, need = items.vocabulary(i), least * len(item)
    slack = max(4, len(item) // 2)
    windows: list[list[int]] = []
    for p, q in places:
        a, b = max(0, p - q - slack), min(len(rows), p - q + len(item) + slack)
        if windows and a <= windows[-1][1] - len(item) // 2 and b - windows[-1][0] <= 4 * (len(item) + slack):
            windows[-1][1] = max(b, windows[-1][1])
        else:
            windows.append([a, b])
    # A match of that score has at least so many equal words, of the item and of the window.
    windows = [x for x in windows if _enough(item, known, rows[x[0] : x[1]], need)]
    if not windows:
        return None
    best, first, last, at = max(((*align(item, rows[a:b]), a) for a, b in windows), key=lambda x: (x[0], -x[3]))
    score = best / (MATCH * len(item))
    return (score, first + at, last + at) if score >= least else None


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(id, item_id, score, first_word, last_word)`` for every text and item whose alignment reaches ``threshold``.

    The score is 1 for a whole copy. Of an item of L words, each one changed
    costs 1.5 / L, each one left out 1.5 / L and each one added 0.5 / L. An item
    of fewer than three words matches only texts that are no longer either; an
    item of under 16 words needs eight of its words, or all but one edit (of
    five words or more). ``first_word`` and ``last_word`` (exclusive) number the
    words of the text. Only the best place of an item in a text is returned.
    Ids may be of any type. Null texts and items, and those without words, match
    nothing; rows that repeat match each for itself; empty tables give an empty
    result.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    item_type = items.schema[item_id_col].dataType
    schema = f"id {kind}, item_id {item_type.simpleString()}, score double, first_word bigint, last_word bigint"
    arrow_type = to_arrow_type(item_type)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    own = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("text is not null and text <> ''")
    out = None
    for ids, bodies in _item_blocks(own):
        block = Items.of(ids, bodies)
        block.seeds = _seeds(texts, block)
        known = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            block = known.value
            keep = [_filter(s.grams) for s in block.seeds]
            for rows, data, offsets in blocks(batches):
                hashes, cuts = words(data, offsets)
                shared = [_shared(s, k, hashes, cuts, n) for s, k, n in zip(block.seeds, keep, (N, SHORT), strict=True)]
                found = []
                for r, i, at, place in _pairs(block, shared, cuts):
                    if got := _match(block, i, hashes[cuts[r] : cuts[r + 1]], list(zip(at.tolist(), place.tolist(), strict=True)), threshold):
                        found.append((r, i, *got))
                columns = [rows.column("id").take(pa.array([x[0] for x in found], pa.int64())), pa.array([block.ids[x[1]] for x in found], arrow_type), *(pa.array([x[k] for x in found], t) for k, t in ((2, pa.float64()), (3, pa.int64()), (4, pa.int64())))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "item_id", "score", "first_word", "last_word"])

        part = texts.transform(shipped).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else texts.limit(0).select("id", F.lit(None).cast(item_type).alias("item_id"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("first_word"), F.lit(0).cast("long").alias("last_word"))


def _item_blocks(items: DataFrame) -> Iterator[tuple[list, list[str]]]:
    """The test items, a bounded block at a time (an item longer than the bound is a block by itself)."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for r in items.toLocalIterator():
        if ids and (len(ids) == BLOCK_ITEMS or size + len(r.text) > BLOCK_CHARS):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r.item_id)
        texts.append(r.text)
        size += len(r.text)
    if ids:
        yield ids, texts


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item of which it holds a copy, exact or edited."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")
