"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from factspark.storage import stored

#: Arrow batches are cut into blocks of about this many bytes of text before
#: numpy works on them, so that the memory of a Python worker stays bounded
#: whatever the length of the texts (a single longer text is a block by itself).
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the cluster's folder (see ``factspark.storage``)."""
    return stored(df)


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each lengthened until it is none of the columns (in either case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def utf8(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column in one array, and the n + 1 offsets of its rows. Nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    col = col.cast(pa.large_string())
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, np.int64)[col.offset : col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def repaired(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with what isn't UTF-8 replaced (as it is wherever a text is decoded); most often just what was given."""
    raw = data.tobytes()
    try:
        raw.decode()
        return data, offsets
    except UnicodeDecodeError:
        rows = [raw[a:b].decode(errors="replace").encode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return np.frombuffer(b"".join(rows), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches, with the bytes and offsets of their text, of about ``block_bytes`` each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = utf8(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + block_bytes, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
            at = end
