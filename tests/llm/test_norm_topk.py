"""op11 against all products."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from closecast.llm import norm_topk as N
from tests.llm.helpers import clashing

VECS = "vec_id long, embedding array<double>, label int"


def brute(rows, is_query, k):
    usable = [(i, v, [max(-(1 << 24), min(1 << 24, math.floor(1024 * x))) for x in e]) for i, (v, e, _) in enumerate(rows)
              if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, v, e in usable:
        if v is None or not is_query(v):
            continue
        scored = sorted((-sum(a * b for a, b in zip(e, f)), o is None, o or 0) for j, o, f in usable if j != i and len(f) == len(e))
        out += [(v, r + 1, None if null else o, -s) for r, (s, null, o) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def search(spark, rows, k, step=5):
    df = clashing(spark.createDataFrame(rows, VECS), "dim", "norm", "v", "q", "rid", "bucket", "score").repartition(3)
    return sorted((tuple(r) for r in N.top_products(df, F.col("vec_id") % step == 0, k).collect()), key=repr)


def vectors(rng, n, dim=8):
    rows = []
    for i in range(n):
        size = rng.choice([0.01, 1, 1, 3, 40])
        rows.append((i, [rng.gauss(0, 1) * size for _ in range(dim)], i % 3))
    return rows


AWKWARD = [(500, None, 1), (505, [], 1), (506, [], None), (510, [0.0] * 8, 1), (515, [None] + [1.0] * 7, 1), (520, [float("nan")] * 8, 1), (525, [float("inf")] * 8, 1),
           (530, [1.0, 2.0], 1), (531, [3.0, -2.0], 1), (None, [9.0] * 8, 1), (None, [9.0] * 8, None), (535, [2.0] * 8, 1), (535, [2.0] * 8, 1), (535, [2.5] * 8, 1), (540, [1e300] * 8, 1)]


@pytest.mark.parametrize("seed_rows, block_bytes", [(4096, 1 << 20), (8, 512), (1, 256)])
def test_equals_all_products(spark, monkeypatch, seed_rows, block_bytes):
    monkeypatch.setattr(N, "SEED_ROWS", seed_rows)
    monkeypatch.setattr(N, "BLOCK_BYTES", block_bytes)
    rows = vectors(random.Random(1), 200) + AWKWARD
    assert search(spark, rows, 4) == brute(rows, lambda v: v % 5 == 0, 4)


def test_ties_take_the_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(N, "SEED_ROWS", 4)
    monkeypatch.setattr(N, "BLOCK_BYTES", 512)
    rows = [(i, [1.0, -2.0, 0.5], None) for i in range(60)] + [(100 + i, [0.0, 0.0, 0.0], None) for i in range(20)]
    assert search(spark, rows, 7, 10) == brute(rows, lambda v: v % 10 == 0, 7)


def test_fewer_candidates_and_empty_table(spark):
    rows = [(0, [1.0], 1), (1, [2.0], 1)]
    assert search(spark, rows, 10) == [(0, 1, 1, 1024 * 2048)]
    assert search(spark, [], 10) == []


def test_coordinate_pruning_keeps_every_row_of_the_cosine():
    rng = np.random.default_rng(3)
    vecs = rng.integers(-2000, 2000, (500, 12)).astype(np.int32)
    vecs[:50] = vecs[0] + rng.integers(-60, 60, (50, 12))
    norms = np.sqrt((vecs.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-norms)
    b = N.Bucket(np.arange(500), np.arange(500), norms[order], vecs[order])
    unit = vecs[order] / norms[order][:, None]
    thinned = 0
    for q in range(0, 500, 7):
        for t in (0.6, 0.9, 0.99, 1.0):
            near = np.flatnonzero(unit @ unit[q] >= t - 1e-12)
            got = b.by_coordinates(unit[q], t)
            assert set(near) <= set(got)
            thinned += len(got) < 250
    assert thinned > 100


def test_length_pruning_and_exact_products_beyond_doubles():
    vecs = np.array([[1 << 24] * 64, [(1 << 24) - 1] * 64, [5] * 64], dtype=np.int32)
    norms = np.sqrt((vecs.astype(float) ** 2).sum(axis=1))
    b = N.Bucket(np.arange(3), np.arange(3), norms, vecs)
    assert [b.by_length(x) for x in (norms[0] + 1, norms[1], norms[2], 0)] == [0, 2, 3, 3]
    score, ids = N.search(b, 9, vecs[1], float(norms[1]), 2, None)
    assert list(ids) == [0, 1] and score[0] - score[1] == 64 * ((1 << 24) - 1)
