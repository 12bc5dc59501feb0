"""Vector near-dedup and hard negatives against brute force."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pluvio.llm import hard_negatives, itq, knn, registry

SHAPE = "vec_id long, embedding array<float>"


def _linked(ids, x, threshold=0.95):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    low = np.array(ids)
    while True:
        new = np.minimum(low, np.where(near, low, 1 << 60).min(axis=1))
        if (new == low).all():
            return {i: (int(n), int(c), i == c) for i, n, c in zip(ids, near.sum(axis=1), low, strict=True)}
        low = new


def _classes(vectors, **kw):
    return {r.id: (r.n_links, r.component_id, r.kept) for r in itq.near_vectors(vectors, **kw).collect()}


def _near(rng, x, cosine):
    z = rng.standard_normal(x.shape)
    z -= (z @ x) * x
    return cosine * x + np.sqrt(1 - cosine**2) * z / np.linalg.norm(z)


@pytest.mark.parametrize("piece", [2048, 24])
def test_links_against_all_pairs(spark, piece):
    """A third of the rows are copies of one vector, others lie on chains of links and on both sides of the threshold."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 24)) + 0.3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = np.vstack([x, *[_near(rng, x[0], c) for c in rng.uniform(0.97, 0.999, 150)], *[_near(rng, x[1], 0.999) for _ in range(80)]])
    for i in range(60):
        x = np.vstack([x, _near(rng, x[-1] if i % 6 else x[i], 0.97)])
    x = np.vstack([x, *[_near(rng, x[i], c) for i in range(2, 200) for c in (0.94, 0.96)]])
    x = (x * rng.uniform(0.1, 10, (len(x), 1))).astype(np.float32)
    ids = [int(i) for i in rng.permutation(len(x))]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], SHAPE).repartition(3)
    assert _classes(vectors, piece_vectors=piece) == _linked(ids, x.astype(float))


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((3000, 48)) * np.linspace(0.2, 2, 48) + 0.5
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = np.vstack([x, *[_near(rng, v, 0.9501) for v in x]])
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want, got = _linked(list(range(len(x))), x), _classes(vectors)
    assert all(got[i][0] <= want[i][0] for i in got)
    assert sum(v[0] for v in got.values()) >= 0.99 * sum(v[0] for v in want.values())


def test_rotations_are_orthogonal_and_balance_the_codes():
    rng = np.random.default_rng(7)
    x = itq.units(rng.standard_normal((2000, 32)) * np.linspace(0.1, 3, 32) + 1)
    index = itq.learn(x, 0.95, 8)
    turn = index.turn[:, :32]
    assert np.allclose(turn.T @ turn, np.eye(32)) and index.recall >= itq.RECALL
    ones = ((x - index.mean) @ turn > 0).mean(axis=0)
    assert ones.min() > 0.3 and ones.max() < 0.7
    loss = lambda r: ((np.where(x @ r > 0, 1, -1) - x @ r) ** 2).sum()
    assert loss(itq.rotation(x, np.random.default_rng(1))) < loss(itq.rotation(x, np.random.default_rng(1), turns=0))


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [None, 1.0]), (6, []), (7, [0.0, 0.0]), (8, [1.0]), (9, [1e30, 1e28]), (10, [0.0, 1.0])]
    vectors = spark.createDataFrame(rows, SHAPE).withColumns({"n": F.lit("x"), "keys": F.lit("x")})
    got = sorted((r.id, r.n_links, r.component_id, r.kept) for r in itq.near_vectors(vectors).collect())
    assert got == sorted([(1, 2, 1, True), (2, 2, 1, False), (9, 2, 1, False), (2, 1, 2, True), (10, 1, 2, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True)])
    nameless = spark.createDataFrame([(None, [1.0, 0.0]), (None, [0.0, 1.0]), (4, [1.0, 0.0])], SHAPE)
    assert sorted(map(str, (tuple(r) for r in itq.near_vectors(nameless).collect()))) == ["(4, 1, 4, True)", "(None, 0, None, True)", "(None, 1, 4, False)"]
    assert itq.near_vectors(vectors.limit(0)).count() == 0


def _mined(ids, x, labels, anchors):
    v = np.floor(256 * x)
    out = []
    for a in anchors:
        s = (v @ v[a]).astype(int)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[a]]
        for p in [i for i in order if labels[i] == labels[a]][:5]:
            fits = [i for i in order if labels[i] != labels[a] and 80 * s[p] <= 100 * s[i] <= 100 * s[p]][:5]
            out += [(int(ids[a]), int(ids[p]), r, int(ids[i]), int(s[p]), int(s[i])) for r, i in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("numbers", [(1 << 21, 1 << 21), (16 * 40, 16 * 5)])
def test_hard_negatives_against_all_pairs(spark, numbers):
    """Ties, one label and one vector with a third of the rows, a label of its own, and clusters that can be pruned."""
    rng = np.random.default_rng(8)
    x = np.repeat(rng.standard_normal((12, 16)), 40, axis=0) + 0.3 * rng.standard_normal((480, 16))
    x[300:] = x[300]
    x[:100] = np.round(x[:100])
    labels = [int(n) for n in rng.integers(0, 4, 480)]
    labels[200:] = [1 if n < 3 else 2 for n in labels[200:]]
    labels[0] = 77
    rows = [(i, label, v.tolist()) for i, (label, v) in enumerate(zip(labels, x, strict=True))]
    vectors = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    got = hard_negatives.hard_negatives(vectors, vectors.where("vec_id % 9 = 0"), piece_numbers=numbers[0], block_numbers=numbers[1])
    assert sorted(map(tuple, got.collect())) == _mined(np.arange(480), x, labels, range(0, 480, 9))


def test_hard_negatives_of_odd_rows(spark):
    nan = float("nan")
    shape = "vec_id long, label string, embedding array<float>, own string"
    rows = [(1, "a", [1.0, 0.0]), (2, "a", [0.5, 0.0]), (3, "b", [0.5, 1.0]), (3, "b", [0.45, 1.0]), (4, None, [0.5, 0.0]), (5, "b", None), (6, "b", [nan, 0.0]), (7, "b", [None, 1.0]), (8, "b", []), (9, "b", [0.5]), (None, "b", [0.5, 0.0])]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], shape)
    got = hard_negatives.hard_negatives(vectors, vectors.where("vec_id = 1"))
    assert sorted(map(tuple, got.collect())) == [(1, 2, 1, 3, 32768, 32768), (1, 2, 2, 3, 32768, 29440)]
    assert hard_negatives.hard_negatives(vectors.limit(0), vectors).count() == hard_negatives.hard_negatives(vectors, vectors.limit(0)).count() == 0


def test_node_pairs_are_pruned():
    """Of clustered vectors most pairs are never scored, and none is lost."""
    rng = np.random.default_rng(9)
    x = np.repeat(10 * rng.standard_normal((40, 8)), 100, axis=0) + rng.standard_normal((4000, 8))
    x, ids, labels = np.floor(256 * x), np.arange(4000), np.zeros(4000, int)
    windows = hard_negatives._Windows([[2**63 - 1]] * 200, [[-(2**63)]] * 200, 5)
    scored = hard_negatives.search(x[::20], ids[::20], labels[::20], windows, x, ids, labels, True, (5, 50))
    assert scored < 0.2 * 200 * 4000
    for i, a in enumerate(range(0, 4000, 20)):
        s = x @ x[a]
        best = [j for j in np.lexsort((ids, -s)) if j != a][:5]
        assert list(windows.found[i][0][0]) == best


def test_intervals_hold_all_products():
    rng = np.random.default_rng(10)
    for _ in range(50):
        a, c = (rng.standard_normal((30, 6)) * rng.uniform(0.1, 2) + rng.standard_normal(6) for _ in "ac")
        s, t = hard_negatives.grow(a, 8), hard_negatives.grow(c, 8)
        length = lambda tree: np.sqrt((tree.centre**2).sum(axis=1))
        for i in range(len(s.start)):
            for j in range(len(t.start)):
                products = a[s.order[s.start[i] : s.end[i]]] @ c[t.order[t.start[j] : t.end[j]]].T
                low, high = hard_negatives.interval(s.centre[i] @ t.centre[j], length(s)[i], length(t)[j], s.radius[i], t.radius[j], s.norm[i], t.norm[j])
                assert low <= products.min() and products.max() <= high


def test_queries_over_the_tables(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/embeddings.parquet")
    x = np.stack(table["embedding"].to_numpy(zero_copy_only=False)).astype(float)
    ids, labels = table["vec_id"].to_numpy(), table["label"].to_numpy().copy()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in registry.op11_vector_dedup(spark, sf_dir).collect()}
    assert got == _linked(ids.tolist(), x)
    labels[ids % 7 == 0] = (labels[ids % 7 == 0] + 1) % 10
    got = sorted(map(tuple, registry.op13_hard_negatives(spark, sf_dir).collect()))
    assert got == _mined(ids, x, labels, np.flatnonzero(ids % 100 == 0))


def test_queries_in_many_blocks(spark):
    """Far clusters, of which each block of queries needs but some: its vectors go to the blocks that need it."""
    rng = np.random.default_rng(11)
    x = np.vstack([c + rng.standard_normal((100, 8)) for c in 50 * rng.standard_normal((6, 8))])
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    queries = vectors.where("vec_id % 10 = 0")
    got = knn.top_k(vectors, queries, pivots=12, group_queries=5, piece_vectors=40)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, knn.top_k(vectors, queries, pivots=1).collect()))
