"""Language identification with a string kernel.

The kernel is the blended spectrum of orders 1 to 3 over the presence of byte
n-grams: the share of the n-grams that two texts have in common,
``|G(x) & G(y)| / sqrt(|G(x)| |G(y)|)``, with n-grams of each order hashed to a
fixed number of slots. Nyström's method replaces the kernel by its values at a
few landmark texts, ``phi(x) = K_mm^(-1/2) k(x, landmarks)``, and one-versus-rest
kernel ridge regression is solved in that space. Whole texts are scored in
blocks: one matrix product of the block's presence rows with the landmarks',
one with the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factspark.llm.common import blocks, fresh, table
from factspark.shipping import shipped

#: Slots for n-grams of one, two and three bytes.
SLOTS = (256, 4096, 8192)
WIDTH = sum(SLOTS)
UNKNOWN = "und"
_BLOCK = 1 << 20
_ROWS = 512


def _folded() -> np.ndarray:
    """Lower case for ASCII; what isn't a letter of any script becomes a space."""
    out = np.full(256, 32, np.uint8)
    out[128:] = np.arange(128, 256)
    for c in range(ord("a"), ord("z") + 1):
        out[c] = out[c - 32] = c
    return out


_FOLD = _folded()


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text of a block, which slots its n-grams hit (n-grams never cross texts)."""
    n = len(offsets) - 1
    out = np.zeros((n, WIDTH), bool)
    if not len(data):
        return out
    low = _FOLD[data]
    # Capital accented Latin letters, C3 80 .. C3 9E, are C3 A0 .. C3 BE in lower case.
    low[1:] |= ((low[1:] & 0xE0 == 0x80) & (low[:-1] == 0xC3)).astype(np.uint8) << 5
    row = np.repeat(np.arange(n, dtype=np.int64) * WIDTH, np.diff(offsets))
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    flat, base, code = out.reshape(-1), 0, np.zeros(len(data), np.uint32)
    wide = low.astype(np.uint32)
    for order, slots in enumerate(SLOTS, 1):
        keep = len(data) - order + 1
        if keep <= 0:
            break
        code = code[:keep] << 8 | wide[order - 1 :]
        slot = code if order == 1 else (code * np.uint32(2654435761)) >> np.uint32(32 - slots.bit_length() + 1)
        inside = left[:keep] >= order
        flat[(row[:keep] + base + slot)[inside]] = True
        base += slots
    return out


@dataclass(frozen=True)
class Model:
    """Landmarks (rows of presence, scaled to length one), and one column of weights for each language."""

    landmarks: np.ndarray
    weights: np.ndarray
    languages: tuple[str, ...]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """The regression's values, for presence rows, for each language."""
        size = np.sqrt(np.maximum(rows.sum(1), 1))
        return (rows.astype(np.float32) @ self.landmarks.T / size[:, None].astype(np.float32)).astype(np.float64) @ self.weights


def fit(bits: np.ndarray, labels: list[str], landmarks: int = 160, ridge: float = 1e-3) -> Model:
    """Nyström features from the first texts of each language in turn; ridge regression on all rows.

    ``bits`` are rows of presence, packed eight to a byte. They are opened a
    block at a time, and only sums over blocks are kept, so that the memory
    needed is that of the landmarks.
    """
    languages = tuple(sorted(set(labels)))
    if not languages:
        return Model(np.zeros((0, WIDTH), np.float32), np.zeros((0, 0)), ())
    code = np.searchsorted(languages, labels)
    counts = np.bincount(code, minlength=len(languages))
    order = np.argsort(code, kind="stable")
    nth = np.empty(len(labels), np.int64)
    nth[order] = np.arange(len(labels)) - np.repeat(np.cumsum(counts) - counts, counts)
    marks = _unit_rows(bits[np.argsort(nth, kind="stable")[:landmarks]])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    kept = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, kept] / np.sqrt(values[kept])
    gram, right = np.zeros((root.shape[1], root.shape[1])), np.zeros((root.shape[1], len(languages)))
    for at in range(0, len(labels), _ROWS):
        own = code[at : at + _ROWS]
        phi = (_unit_rows(bits[at : at + _ROWS]) @ marks.T).astype(np.float64) @ root
        # Each language weighs the same, however many of the rows are its own.
        weighed = phi / (len(languages) * counts[own])[:, None]
        gram += phi.T @ weighed
        np.add.at(right.T, own, weighed)
    beta = np.linalg.solve(gram + ridge * np.eye(len(gram)), right)
    return Model(marks, root @ beta, languages)


def _unit_rows(bits: np.ndarray) -> np.ndarray:
    rows = np.unpackbits(bits, axis=1)[:, :WIDTH].astype(np.float32)
    return rows / np.sqrt(np.maximum(rows.sum(1), 1))[:, None]


def _labelled(docs: DataFrame, id_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang")).where("id is not null and lang is not null")


def training_ids(docs: DataFrame, per_language: int, id_col: str, lang_col: str) -> DataFrame:
    """``(id, lang, h)``: at most ``per_language`` labelled ids of each language: of each bucket of ids by hash, the one with the least hash."""
    mixed = F.xxhash64(F.col("id").cast("string"))
    rows = _labelled(docs, id_col, lang_col).select("id", "lang", F.pmod(mixed, F.lit(per_language)).alias("bucket"), mixed.alias("h"))
    return rows.groupBy("lang", "bucket").agg(F.min_by("id", F.struct("h", F.col("id").cast("string"))).alias("id"), F.min("h").alias("h")).select("id", "lang", "h")


def train(docs: DataFrame, per_language: int = 400, landmarks: int = 160, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_rows: int = 16_000) -> Model:
    """A model from a bounded sample of the rows: ``per_language`` texts of each language, ``landmarks`` landmarks.

    With so many languages that the sample would have more than ``most_rows``
    texts, each has fewer, but every label has one text at least, and so is a
    language that can be predicted. With over 80 languages the landmarks are
    two a language, up to 1,024. The driver gets one row of presence bits (about
    1.6 kB) for each text of the sample, and no texts. Rows with a null id, text
    or language are left out. Of rows with the same id and language, the one
    whose text has the least hash counts; an id with several languages may count
    once in each. Without labelled rows the model knows no language and
    predicts ``und``.
    """
    languages = _labelled(docs, id_col, lang_col).select(F.count_distinct("lang")).first()[0]
    ids = training_ids(docs, max(1, min(per_language, most_rows // max(languages, 1))), id_col, lang_col)
    landmarks = max(landmarks, min(2 * languages, 1024))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, block_bytes=_BLOCK):
            for at in range(0, rows.num_rows, _ROWS):
                part = rows.slice(at, _ROWS)
                edges = offsets[at : at + part.num_rows + 1]
                bits = np.packbits(presence(data[edges[0] : edges[-1]], edges - edges[0]), axis=1)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("h"), part.column("lang"), part.column("own"), pa.array([x.tobytes() for x in bits], pa.binary())], names=["id", "h", "lang", "own", "bits"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    # The sample has a fixed bound, so it may be broadcast whatever the size of the table.
    sample = texts.where("text is not null and lang is not null").join(F.broadcast(ids), ["id", "lang"]).select("id", "h", "lang", F.xxhash64("text").alias("own"), "text")
    rows = sample.transform(shipped).mapInArrow(run, f"id {kind}, h bigint, lang string, own bigint, bits binary")
    one = rows.groupBy("lang", "id").agg(F.min("h").alias("h"), F.min(F.struct("own", "bits")).alias("x"))
    got = one.select("h", "lang", F.col("x.bits").alias("bits")).orderBy("h", "lang", "bits").collect()
    bits = np.frombuffer(b"".join(bytes(r.bits) for r in got), np.uint8).reshape(len(got), -1) if got else np.zeros((0, WIDTH // 8), np.uint8)
    return fit(bits, [r.lang for r in got], landmarks)


def _has_letter(text: bytes) -> bool:
    return text.lower() != text.upper() or any(map(str.isalpha, text.decode(errors="replace")))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, lang_pred, score)`` and the columns in ``keep``, for every row, from its whole text alone.

    A column in ``keep`` that is called like one of those three (in either
    case) gives way to it.
    ``lang_pred`` is ``und``, with the score 0, if the text is null or has no
    letter. The score is the winning regression value, held between 0 and 1; a
    tie goes to the language that is first in the alphabet. Rows that repeat are
    returned as often as they came; an empty table gives an empty result.
    """
    keep = tuple(c for c in dict.fromkeys(keep) if c.lower() not in ("id", "lang_pred", "score"))
    own, text = fresh([*keep, "lang_pred", "score"], "id_of_row", "text_of_row")
    if text_col in keep and docs.schema[text_col].dataType.simpleString() == "string":
        text = text_col  # sent once
    cast = docs.select(F.col(id_col).alias(own), *([] if text in keep else [F.col(text_col).cast("string").alias(text)]), *(F.col(f"`{c}`") for c in keep))
    model = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for rows, data, offsets in blocks(batches, text, _BLOCK):
            for at in range(0, rows.num_rows, _ROWS):
                part = rows.slice(at, _ROWS)
                edges = offsets[at : at + part.num_rows + 1]
                inside, edges = data[edges[0] : edges[-1]], edges - edges[0]
                raw, cuts = inside.tobytes(), edges.tolist()
                letters = np.array([_has_letter(raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], bool)
                if known.languages:
                    values = known.scores(presence(inside, edges))
                    best = values.argmax(1)
                    score = np.where(letters, np.clip(values[np.arange(len(best)), best], 0.0, 1.0), 0.0)
                    names = [known.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), letters.tolist(), strict=True)]
                else:
                    score, names = np.zeros(part.num_rows), [UNKNOWN] * part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(own), pa.array(names, pa.string()), pa.array(score), *(part.column(c) for c in keep)], names=[own, "lang_pred", "score", *keep])

    kinds = {f.name: f.dataType.simpleString() for f in cast.schema}
    out = cast.transform(shipped).mapInArrow(run, ", ".join(f"`{c}` {k}" for c, k in [(own, kinds[own]), ("lang_pred", "string"), ("score", "double"), *((c, kinds[c]) for c in keep)]))
    return out.withColumnRenamed(own, "id")


def held_out(id_col: str) -> F.Column:
    """True for the fifth of the ids that a model never learns from."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the documents that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out("doc_id")))
    return predict(docs, model).select(F.col("id").alias("doc_id"), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "lang_pred", "score")
