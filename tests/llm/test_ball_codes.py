"""op13 against assigning every part to every entry."""
import hashlib
import math
import random

import numpy as np
import pytest

from closecast.llm import ball_codes as B
from tests.llm.helpers import clashing

VECS = "vec_id long, embedding array<double>, label int"


def brute(rows, rounds=4, parts=4, entries=256):
    kept = [(v, [max(-(1 << 24), min(1 << 24, math.floor(1024 * x))) for x in e], lab) for v, e, lab in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    if not kept:
        return []
    sizes = {}
    for _, e, _ in kept:
        sizes[len(e)] = sizes.get(len(e), 0) + 1
    dim = min(sizes, key=lambda d: (-sizes[d], d))
    width = -(-dim // parts) * parts
    kept = [(v, e + [0] * (width - dim), lab) for v, e, lab in kept if len(e) == dim]
    size = width // parts
    cut = lambda e, p: e[p * size:(p + 1) * size]
    as_bytes = lambda e: np.array(e[:dim], dtype=np.int32).tobytes()
    start = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, as_bytes(r[1])))[:entries]
    books = [[cut(e, p) for _, e, _ in start] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(cut(e, p), c)), k) for k, c in enumerate(books[p])) for p in range(parts)] for _, e, _ in kept]
    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                held = [cut(e, p) for (_, e, _), a in zip(kept, got) if a[p][1] == k]
                if held:
                    books[p][k] = [sum(c) // len(held) for c in zip(*held)]
    got = assign()
    sha = hashlib.sha256(",".join(str(x) for p in books for c in p for x in c).encode()).hexdigest()
    err = [sum(d for d, _ in a) for a in got]
    per = {}
    for (_, _, lab), e in zip(kept, err):
        per[lab] = per.get(lab, 0) + e
    return sorted(((v, "".join(f"{k:02x}" for _, k in a), e, per[lab], sha) for (v, _, lab), a, e in zip(kept, got, err)), key=repr)


def coded(spark, rows):
    df = clashing(spark.createDataFrame(rows, VECS), "dim", "v", "codes", "error", "salt", "n").repartition(3)
    return sorted((tuple(r) for r in B.vector_codes(df).collect()), key=repr)


def clustered(rng, n, dim, spread=0.2):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(9)]
    return [(i, [x + rng.gauss(0, spread) for x in rng.choice(centres)], rng.choice([1, 2, None])) for i in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_BYTES", 4 * 8 * 100)  # several blocks a task
    rows = clustered(random.Random(2), 420, 8)
    rows += [(1000, None, 1), (1001, [None] * 8, 1), (1002, [float("nan")] * 8, None), (3, [0.5] * 8, 7), (3, [0.5] * 8, 7), (None, [0.1] * 8, None), (1003, [1.0] * 5, 1), (1004, [], 1)]
    assert coded(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [
    [], [(1, None, 1)], [(5, [1.5, -0.3, 2.0], None)], [(5, [], 1), (6, [], 1)],
    [(i, [float(i % 3)] * 4, None) for i in range(300)],  # equal entries: ties
    [(i, [10.0 ** (i % 9)] * 4, 1) for i in range(270)]], ids=["empty", "no vector", "one, dimension 3", "dimension 0", "ties", "long components"])
def test_defined_cases(spark, rows):
    assert coded(spark, rows) == brute(rows)


def test_balls_agree_with_a_full_search_and_save_work():
    rng = np.random.default_rng(5)
    centres = rng.integers(-3000, 3000, (40, 6))
    x = (centres[rng.integers(0, 40, 4000)] + rng.integers(-150, 150, (4000, 6))).astype(np.int64)
    entries = x[:64].copy()
    codes = B.nearest_of_all(x, entries)
    work = []
    for _ in range(6):
        new = entries.copy()
        for k in np.unique(codes):
            new[k] = x[codes == k].sum(axis=0) // (codes == k).sum()
        got, dist, done = B.Balls(new, entries).assign(x, codes)
        full = B.square_distances(x, new)
        assert (got == full.argmin(axis=1)).all() and (dist == full.min(axis=1)).all()
        entries, codes = new, got
        work.append(done)
    assert max(work) < 0.5 * len(x) * len(entries)
    assert work[-1] < work[0]
