"""Near-duplicate vectors through a pivot-permutation index.

Every vector is described by the ``nearest`` reference points (pivots) that are
closest to it, in order of their closeness. Pivot lists are inverted: a vector
stands in the list of every set of ``shared`` of its nearest pivots, so that two
vectors meet exactly if they share that many pivots or more. Vectors that meet
are verified by their cosine in double precision.

Equal vectors are one row of the index that counts its copies. A list is read
in blocks of bounded size, every two blocks of a list meet in one group, and a
group returns one row for each vector (how many links, and the least vector of
its links' connected part), so neither lists nor results hold pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factspark.llm.common import checkpointed, table
from factspark.llm.components import components
from factspark.shipping import shipped

#: Rows of a list that are held in one block; a group of two blocks needs memory for twice as many vectors.
BLOCK_ROWS = 2048
#: Lists of more than a block, up to this many, are broadcast; beyond, vectors are joined to them.
BROADCAST_LISTS = 100_000
#: The sample that pivots are fitted on: for each of so many numbers of components (those that most vectors have), so many components in all.
SAMPLE_DIMS, SAMPLE_COMPONENTS = 8, 1 << 20
#: Unit vectors whose mean is this long are a cone.
CONE = 0.5
_SMALL = 48
_ROWS = 2048
#: Cosines that are this close to the threshold are settled by an exact sum.
_CLOSE = 1e-12


def choose_pivots(sample: np.ndarray, most: int, apart: float = 0.8) -> np.ndarray:
    """Up to ``most`` of the sample's unit vectors, in order, each at a cosine below ``apart`` from those before it.

    A large group of near copies gives one pivot, not a share of them: pivots
    that are near one another order their neighbourhood by noise alone. Where
    that gives less than an eighth of ``most``, the gap to 1 is halved, and
    halved again, until there are that many or all different vectors are taken.
    """
    chosen: list[int] = []
    closest = np.full(len(sample), -2.0)
    gap = 1 - apart
    while len(chosen) < max(1, most // 8) and gap > 1e-6:
        for i in np.flatnonzero(closest < 1 - gap).tolist():
            if len(chosen) == most:
                break
            if closest[i] < 1 - gap:
                chosen.append(i)
                np.maximum(closest, sample @ sample[i], out=closest)
        gap /= 2
    return sample[chosen]


@dataclass(frozen=True)
class Marks:
    """The pivots for one number of components, and the point from which vectors are looked at."""

    centre: np.ndarray
    pivots: np.ndarray

    def nearness(self, units: np.ndarray) -> np.ndarray:
        """The cosines with the pivots as seen from the centre: a narrow cone of vectors is spread out."""
        seen = units - self.centre
        return seen @ self.pivots.T / np.maximum(np.sqrt((seen * seen).sum(1, keepdims=True)), 1e-300)


def fit_marks(sample: np.ndarray, most: int) -> Marks:
    """Marks from the sample's unit vectors, seen from their mean if they lie in a cone (a mean of length ``CONE`` or more), else from the origin."""
    centre = sample.mean(0)
    if centre @ centre < CONE * CONE:
        centre = np.zeros_like(centre)
    seen = sample - centre
    norm = np.sqrt((seen * seen).sum(1))
    if norm.max() < 1e-9:  # all vectors are equal
        centre, seen, norm = np.zeros_like(centre), sample, np.ones(len(sample))
    seen, norm = seen[norm >= 1e-9], norm[norm >= 1e-9]
    return Marks(centre, choose_pivots(seen / norm[:, None], most))


def random_marks(dim: int, most: int) -> Marks:
    """Marks for numbers of components that too few vectors have to fit any: fixed directions."""
    return Marks(np.zeros(dim), _units(np.random.default_rng(dim).normal(size=(most, dim))))


def _units(rows: list | np.ndarray) -> np.ndarray:
    v = np.asarray(rows, np.float64)
    v = v / np.abs(v).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(col), dim)


def link_parts(keys: np.ndarray, side: np.ndarray, ids: np.ndarray, copies: np.ndarray, top: np.ndarray, units: np.ndarray, own: np.ndarray, bits: int, shared: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links among the rows of equal ``keys`` (sorted): ``(ids, links, least)`` of the rows that have any.

    ``side`` is 0 or 1 in a group of two different blocks, of which only pairs
    across count, and 2 in a group of one block. A pair counts in one list
    only: that of the ``shared`` least pivots that the two have in common.
    """
    bounds = np.append(np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1)), len(keys))
    sizes = np.diff(bounds)
    lefts, rights = [], []
    small = np.repeat(sizes <= _SMALL, sizes)
    for d in range(1, min(_SMALL, int(sizes.max(initial=0)))):
        a = np.flatnonzero((keys[:-d] == keys[d:]) & small[:-d])
        if not len(a):
            break
        a = a[(side[a] == 2) | (side[a] != side[a + d])]
        a = a[_linked(units, a, a + d, np.einsum("ij,ij->i", units[a], units[a + d]), threshold)]
        lefts.append(a)
        rights.append(a + d)
    for start, size in zip(bounds[:-1][sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist(), strict=True):
        x, s = units[start : start + size], side[start : start + size]
        first, second = (np.arange(size), np.arange(size)) if s[0] == 2 else (np.flatnonzero(s == 0), np.flatnonzero(s == 1))
        cosines = x[first] @ x[second].T
        a, b = np.nonzero(cosines >= threshold - _CLOSE)
        if s[0] == 2:
            a, b = a[a < b], b[a < b]
        sure = _linked(x, first[a], second[b], cosines[a, b], threshold)
        lefts.append(first[a[sure]] + start)
        rights.append(second[b[sure]] + start)
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (lefts, rights))
    a_keys = np.zeros(len(a), np.int64)
    for at in range(0, len(a), 1 << 18):
        part = slice(at, at + (1 << 18))
        x, y = top[a[part]], top[b[part]]
        common = (x[:, :, None] == y[:, None, :]).any(2)
        common &= np.cumsum(common, 1) <= shared
        a_keys[part] = _pack(x[common].reshape(-1, shared), bits)
    here = a_keys == own[a]
    a, b = a[here], b[here]
    links = np.bincount(a, copies[b], len(keys)).astype(np.int64) + np.bincount(b, copies[a], len(keys)).astype(np.int64)
    least = ids.copy()
    while True:  # the least id of each connected part
        before = least.copy()
        low = np.minimum(least[a], least[b])
        np.minimum.at(least, a, low)
        np.minimum.at(least, b, low)
        if (least == before).all():
            break
    some = np.flatnonzero(links)
    return ids[some], links[some], least[some]


def _linked(units: np.ndarray, a: np.ndarray, b: np.ndarray, cosines: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold. Sums depend on their order in the last bits, so close cases are summed exactly, in lists of any size."""
    out = cosines >= threshold
    for k in np.flatnonzero(np.abs(cosines - threshold) < _CLOSE).tolist():
        out[k] = math.fsum((units[a[k]] * units[b[k]]).tolist()) >= threshold
    return out


def _pack(pivots: np.ndarray, bits: int) -> np.ndarray:
    key = np.zeros(len(pivots), np.int64)
    for column in pivots.T:
        key = key << bits | column
    return key


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98, pivots: int = 256, nearest: int = 4, shared: int = 2, sample: int = 2048) -> DataFrame:
    """``(id, n_links, component_id)``: one row per row of ``vectors``.

    Vectors link if their labels are equal and not null, they have equally
    many components, and their cosine is ``threshold`` or more. A vector that
    is null, empty or zero, holds null or non-finite components, or has a null
    id or label links with nothing and is a component by itself. ``n_links``
    counts other rows, copies included. Rows with the same id are vectors of
    their own: each has the links of its own content. An empty table gives an
    empty result.

    The pivots are fitted on at most ``sample`` different vectors (and at most
    2^20 components) for each of the eight numbers of components that most
    vectors have, chosen by hash; for further numbers of components they are
    fixed directions. All vectors are indexed. For larger tables raise
    ``pivots`` with the square root of the rows of a label, to keep lists short.
    """
    if not 0 < shared <= nearest:
        raise ValueError("shared must be between 1 and nearest")
    bits = (pivots + nearest).bit_length()
    if bits * shared > 62:
        raise ValueError("a set of shared pivots must fit a long")
    # Vectors travel in the precision they came in.
    width = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast(width).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    # A class is what has equal labels and vectors; it goes by a number of its own, and is found again by two hashes.
    first, second = F.xxhash64("label", "v"), F.xxhash64(F.lit("class"), "label", "v")
    grouped = rows.where(sound).groupBy("label", "v").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = checkpointed(grouped.select(F.monotonically_increasing_id().alias("cls"), first.alias("x"), second.alias("y"), "label", "v", "rep", "copies"))
    marks = vectors.sparkSession.sparkContext.broadcast(_marks(classes, pivots, sample))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                dims = np.diff(part.column("v").offsets.to_numpy())
                for dim in np.unique(dims).tolist():
                    own = part.filter(pa.array(dims == dim))
                    units = _units(_matrix(own.column("v"), dim))
                    own_marks = marks.value.get(dim) or random_marks(dim, pivots)
                    near = np.argsort(-own_marks.nearness(units), axis=1, kind="stable")[:, :nearest]
                    # Where there are fewer pivots than ``nearest``, numbers that are no pivot's stand in, the same ones for all.
                    near = np.pad(near, ((0, 0), (0, nearest - near.shape[1])), constant_values=0) + np.where(np.arange(nearest) < near.shape[1], 0, len(own_marks.pivots) + np.arange(nearest) - near.shape[1])
                    top = np.sort(near, axis=1)
                    keys = np.stack([_pack(top[:, list(c)], bits) for c in combinations(range(nearest), shared)], 1)
                    yield pa.RecordBatch.from_arrays(
                        [own.column("label"), pa.array([dim] * len(own), pa.int32()), own.column("cls"), own.column("copies"), pa.array(list(top.astype(np.int32)), pa.list_(pa.int32())), pa.array(list(keys), pa.list_(pa.int64())), own.column("v")],
                        names=["label", "dim", "cls", "copies", "top", "keys", "v"],
                    )

    kind = rows.schema["label"].dataType.simpleString()
    described = classes.select("label", "cls", "copies", "v").transform(shipped).mapInArrow(describe, f"label {kind}, dim int, cls bigint, copies bigint, top array<int>, keys array<bigint>, v {width}")
    entries = checkpointed(described)
    # Only lists of more than a block are looked up, of which there are few; the vectors are shuffled once, to their lists.
    lists = entries.select("label", "dim", F.explode("keys").alias("key")).groupBy("label", "dim", "key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_ROWS)
    long = checkpointed(lists.select("label", "dim", "key", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")))
    side = F.broadcast(long) if long.count() <= BROADCAST_LISTS else long
    placed = entries.withColumn("key", F.explode("keys")).drop("keys").join(side, ["label", "dim", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    placed = placed.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = placed.select(
        F.xxhash64("label", "dim", "key", F.least("block", "other"), F.greatest("block", "other")).alias("group"),
        F.struct("label", "dim", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).alias("place"),
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
        "dim", "key", "cls", "copies", "top", "v",
    )
    spread = met.repartition("place").sortWithinPartitions("group", "place")
    tagged = spread.withColumn("place", F.to_json("place"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by group; the last group of what is held waits for the next batch.
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                held.append(batch.slice(at, _ROWS))
                count += held[-1].num_rows
                if count >= 4 * _ROWS:
                    whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    places = whole.column("place")
                    last = places[len(places) - 1]
                    same = np.asarray(pc.equal(places, last).to_numpy(zero_copy_only=False), bool)
                    cut = int(len(same) - np.argmin(same[::-1])) if not same.all() else 0
                    if cut:
                        yield from results(whole.slice(0, cut))
                        whole = whole.slice(cut)
                    held, count = [whole], whole.num_rows
        if count:
            yield from results(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    def results(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            own = batch.filter(pa.array(dims == dim)) if (dims != dim).any() else batch
            keys = own.column("place").dictionary_encode().indices.to_numpy().astype(np.int64)
            top = np.asarray(own.column("top").flatten().to_numpy(), np.int64).reshape(len(own), nearest)
            n = {c: own.column(c).to_numpy() for c in ("side", "cls", "copies", "key")}
            ids, links, least = link_parts(keys, n["side"], n["cls"].copy(), n["copies"], top, _units(_matrix(own.column("v"), dim)), n["key"], bits, shared, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(least)], names=["cls", "links", "least"])

    found = checkpointed(tagged.select("place", "side", "dim", "key", "cls", "copies", "top", "v").transform(shipped).mapInArrow(verify, "cls bigint, links bigint, least bigint"))
    linked = components(found, "cls", "least").withColumnsRenamed({"node": "cls", "component": "root"})
    facts = classes.select("cls", "x", "y", "rep", "copies")
    # The least id of each component, over its classes.
    least = linked.join(facts, "cls").groupBy("root").agg(F.min("rep").alias("component_id"))
    counted = found.groupBy("cls").agg(F.sum("links").alias("links"))
    known = facts.join(counted, "cls", "left").join(linked.join(least, "root").select("cls", "component_id"), "cls", "left")
    known = known.select("x", "y", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    # Only classes that have something to say are joined back; stored, so that adaptive execution can split a hot class.
    known = checkpointed(known.where("n_links > 0"))
    # Rows come back by their hashes, not by their vectors; those that link with nothing are spread by their ids and meet nothing.
    asked = rows.select("id", F.when(sound, first).otherwise(F.xxhash64("id", F.rand(1))).alias("x"), F.when(sound, second).alias("y"))
    out = asked.alias("r").join(known.alias("k"), (F.col("r.x") == F.col("k.x")) & (F.col("r.y") == F.col("k.y")), "left")
    return out.select(F.col("r.id").alias("id"), F.coalesce("k.n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("k.component_id", "r.id").alias("component_id"))


def _marks(classes: DataFrame, pivots: int, sample: int) -> dict[int, Marks]:
    """For the numbers of components that most classes have, the marks, from a bounded sample of the classes."""
    sizes = classes.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(SAMPLE_DIMS).collect()
    out = {}
    for dim in [r.dim for r in sizes if r.dim <= SAMPLE_COMPONENTS]:
        h = F.xxhash64("x", "y")
        buckets = max(1, min(sample, SAMPLE_COMPONENTS // dim))
        rows = classes.where(F.size("v") == dim).select(F.pmod(h, F.lit(buckets)).alias("bucket"), h.alias("h"), "cls")
        chosen = rows.groupBy("bucket").agg(F.min_by("cls", "h").alias("cls"))
        got = classes.join(F.broadcast(chosen), "cls", "left_semi").orderBy(h, "y").select("v").toArrow()  # at most one class a bucket
        out[dim] = fit_marks(_units(_matrix(got.column("v").combine_chunks(), dim)), pivots)
    return out


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every vector at a cosine of 0.98, and the vectors that stay."""
    out = near_duplicates(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
