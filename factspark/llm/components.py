"""Connected components of an edge table, by alternating large and small stars.

Where nodes are long integers, each partition first replaces its edges by a
forest of stars of its own, so that only what several partitions share is left
to the rounds; edges that lie in one partition need none.

Every round replaces the edges of a node by edges to the least node it can
see; the rounds needed grow with the logarithm of the largest component's
diameter. A round is two aggregations and two equi-joins over the edges, and
one aggregation that finds whether another is needed: no node's neighbours are
ever gathered in one row; the neighbours of a hub are spread by adaptive skew
handling.  Every round is checkpointed to the shared checkpoint folder, so a
lost executor costs one round at most; the round before is deleted then.
Each round also costs the driver the plans and generated code of its jobs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspark.llm.common import checkpointed
from factspark.shipping import shipped
from factspark.storage import discard

#: A partition's edges are contracted so many at a time, with what is left of those before.
_EDGES = 1 << 19


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)``: for every node of an edge, the least node it is connected with.

    Edges are undirected; loops and edges with a null end are ignored, and
    repeated edges count once. A node without edges isn't returned. An empty
    table gives an empty result.
    """
    given = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    long = all(kind == "bigint" for _, kind in given.dtypes)
    stars = checkpointed(given.where("u <> v").transform(shipped).mapInArrow(_forests, "u bigint, v bigint") if long else _ordered(given))
    while not _settled(stars):
        after = checkpointed(_small_star(_large_star(stars)))
        discard(stars)
        stars = after
    if long:
        stars = stars.distinct()  # partitions may have the same edge
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _settled(stars: DataFrame) -> bool:
    """Whether the edges are a forest of stars: every edge leads straight to a root, the only one of its node, that has no edge upwards."""
    ends = stars.select(F.col("u").alias("node"), F.col("v").alias("up")).unionByName(stars.select(F.col("v").alias("node"), F.lit(None).alias("up")))
    seen = ends.groupBy("node").agg(F.min("up").alias("least"), F.max("up").alias("most"), F.max(F.col("up").isNull()).alias("below"))
    return seen.where("least <> most or (below and least is not null)").isEmpty()


def _contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges as stars: every node but the least of its component, and that least one."""
    nodes, places = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = places[: len(u)], places[len(u) :]
    root = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        left = low != high
        x, y, low, high = x[left], y[left], low[left], high[left]
        np.minimum.at(root, high, low)  # a root hangs on the least one beside it
        while not np.array_equal(above := root[root], root):
            root = above
    below = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[below], nodes[root[below]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stars of a partition's edges, in bounded memory: those of too many nodes are given out as they are, and begun anew."""
    row = lambda u, v: pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
    us, vs, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for batch in batches:
        us.append(batch.column(0).to_numpy())
        vs.append(batch.column(1).to_numpy())
        n += batch.num_rows
        if n >= _EDGES:
            u, v = _contracted(np.concatenate(us), np.concatenate(vs))
            if len(u) > _EDGES // 2:
                yield row(u, v)
                u, v = u[:0], v[:0]
            us, vs, n = [u], [v], len(u)
    if n:
        yield row(*_contracted(np.concatenate(us), np.concatenate(vs)))


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller node."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    ordered = _ordered(stars)
    least = ordered.groupBy("u").agg(F.min("v").alias("m"))
    near = ordered.join(least, "u")
    return near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
