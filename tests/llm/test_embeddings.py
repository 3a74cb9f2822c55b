import math

import numpy as np
import pytest

from factspark.llm import embeddings
from factspark.llm.embeddings import choose_pivots, near_duplicates, op10_embedding_near_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def slow(rows, threshold=0.98):
    """{position: (links, component)} by comparing all pairs."""
    ok = []
    for i, (vec, v, label, *_) in enumerate(rows):
        if vec is not None and v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok.append(i)
    unit = {i: np.asarray(np.float32(rows[i][1]), np.float64) for i in ok}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    links, root = {i: 0 for i in range(len(rows))}, {i: r[0] for i, r in enumerate(rows)}
    for n, i in enumerate(ok):
        for j in ok[n + 1 :]:
            if rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                if root[i] != root[j]:
                    old, new = max(root[i], root[j]), min(root[i], root[j])
                    root = {k: new if v == old and v is not None else v for k, v in root.items()}
    return [(links[i], root[i]) for i in range(len(rows))]


def groups(rng, n, size, dim=64, noise=0.012):
    base = rng.normal(size=(n, dim))
    base /= np.linalg.norm(base, axis=1)[:, None]
    return np.concatenate([b + noise * rng.normal(size=(size, dim)) for b in base])


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = slow(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op10_embedding_near_dedup(spark, sf).collect()}
    assert got == {r[0]: (n, c, r[0] == c) for r, (n, c) in zip(rows, want, strict=True)}


@pytest.mark.parametrize("block_rows", [40, 2048])
def test_recall_with_a_large_group_of_near_copies(spark, monkeypatch, block_rows):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(size=(600, 64)), groups(rng, 100, 3), groups(rng, 1, 300)]).astype(np.float32)
    v = np.concatenate([v, v[:50], v[-10:]])
    rows = [(i, x.tolist(), int(i % 2), None) for i, x in enumerate(v)]
    want = slow(rows)
    got = {r.id: (r.n_links, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    assert all(got[i][0] <= want[i][0] for i in got), "no link below the threshold, none counted twice"
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want)
    assert sum(got[i][1] == want[i][1] for i in got) >= 0.99 * len(got)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1, "x"), (2, [2.0, 0.0], 1, "x"), (2, [1.0, 0.0], 1, "x"), (3, [1.0, 0.0], None, None), (4, [0.0, 0.0], 1, None), (5, None, 1, None), (6, [1.0, None], 1, None),
        (7, [nan, 1.0], 1, None), (8, [inf, 1.0], 1, None), (9, [1.0, 0.0], 2, None), (10, [], 1, None), (11, [1.0, 0.0, 0.0], 1, None), (12, [1.0, 0.0, 0.0], 1, None),
        (None, [1.0, 0.0], 1, None), (13, [-1.0, 0.0], 1, None), (14, [1e-30, 0.0], 1, None), (15, [0.0, 3e38], 1, None), (16, [0.0, 1.0], 1, None),
    ]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    want = [(r[0], *x) for r, x in zip(rows, slow(rows), strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert near_duplicates(spark.createDataFrame(rows[3:8], SCHEMA)).where("n_links > 0").count() == 0


def test_pivots_of_a_group_of_near_copies():
    rng = np.random.default_rng(1)
    v = np.concatenate([groups(rng, 1, 200), rng.normal(size=(50, 64))])
    v /= np.linalg.norm(v, axis=1)[:, None]
    assert len(choose_pivots(v, 256)) == 51
    assert len(choose_pivots(v[:200], 256)) >= 32


def test_a_cone_has_as_many_pivots_and_short_lists():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(4000, 64)) / 8 + 3 * np.eye(64)[0]
    v /= np.linalg.norm(v, axis=1)[:, None]
    assert 0.85 < (v[:500] @ v[500:1000].T).mean() < 0.95
    marks = embeddings.fit_marks(v[:2048], 256)
    assert len(marks.pivots) == 256
    near = np.sort(np.argsort(-marks.nearness(v), 1)[:, :4], 1)
    lists = np.unique(np.concatenate([near[:, [i, j]] for i in range(4) for j in range(i + 1, 4)]), axis=0, return_counts=True)[1]
    assert lists.max() < 200


def test_recall_in_a_cone(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(700, 32)) / 32**0.5 + 3 * np.eye(32)[0]
    v = np.concatenate([base, *(base[:150] + s * rng.normal(size=(150, 32)) for s in (0.01, 0.02, 0.04))]).astype(np.float32)
    rows = [(i, x.tolist(), 1, None) for i, x in enumerate(v)]
    want = slow(rows)
    got = {r.id: r.n_links for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] <= want[i][0] for i in got)
    assert sum(got.values()) >= 0.9 * sum(n for n, _ in want)


def test_rows_of_one_id_with_different_vectors(spark):
    rows = [(1, [1.0, 0.0], 1, None), (1, [0.0, 1.0], 1, None), (2, [1.0, 0.001], 1, None), (1, [0.0, 1.0], 2, None), (0, [0.001, 1.0], 2, None)]
    for given in (rows, rows[::-1]):
        got = near_duplicates(spark.createDataFrame(given, SCHEMA).repartition(3)).collect()
        assert sorted(map(tuple, got)) == sorted([(1, 1, 1), (1, 0, 1), (2, 1, 1), (1, 1, 0), (0, 1, 0)])


def test_a_pair_at_the_threshold_does_not_depend_on_the_size_of_its_list():
    rng = np.random.default_rng(8)
    a = rng.normal(size=(4000, 64))
    b = a + 0.2 * rng.normal(size=a.shape)
    units = np.concatenate([a, b])
    units /= np.linalg.norm(units, axis=1)[:, None]
    i = np.arange(4000)
    one, other = np.einsum("ij,ij->i", units[i], units[i + 4000]), np.array([units[k] @ units[k + 4000] for k in i])
    for k in i[:200]:
        at = float(one[k])
        assert (embeddings._linked(units, i, i + 4000, one, at) == embeddings._linked(units, i, i + 4000, other, at)).all()


def test_many_numbers_of_components(spark):
    rows = [(100 * d + k, [1.0 + k * 1e-3] + [0.5] * d, 1, None) for d in range(12) for k in range(3)]
    got = {r.id: (r.n_links, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {100 * d + k: (2, 100 * d) for d in range(12) for k in range(3)}
