import base64
import gzip
import hashlib
import io
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from closecast.llm import nearest as N
from closecast.llm.warc import archive_pages, parse_records
from tests.llm.helpers import clashing, prose

PAGES = "page_id long, url string, html string"


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("min_bytes", [0, 30])
def test_round_trip(spark, tmp_path, min_bytes):
    rng = random.Random(10)
    texts = [prose(rng, 30), "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n</p>", "", None, "x", "long " * 40_000, "a\r\n\r\n"]
    rows = [(i, None if i % 7 == 0 else f"http://x/{i}\r\nX: y", rng.choice(texts)) for i in range(60)] + [(60 + k, "u", texts[0]) for k in range(20)]
    pages = spark.createDataFrame(rows, PAGES).repartition(4)
    got = archive_pages(clashing(pages, "key", "payload", "keeper"), str(tmp_path / "w"), min_bytes).collect()
    top = {}
    for i, _, t in rows:
        top[t or ""] = max(top.get(t or "", -1), i)
    want = []
    for i, _, t in rows:
        t = t or ""
        keep = top[t] == i or len(t.encode()) < min_bytes
        want.append((i, len(t.encode()), sha(t), "response" if keep else "revisit", None if keep else top[t]))
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == sorted(want)
    assert all(r.payload_ok for r in got)
    # the archives themselves: framing by Content-Length, original payloads in the responses
    kept = {}
    for f in (tmp_path / "w").glob("*.gz"):
        for h, block in parse_records(io.BytesIO(gzip.decompress(f.read_bytes()))):
            assert h["warc-record-id"].startswith("<urn:") and ("warc-refers-to" in h) == (h["warc-type"] == "revisit")
            if h["warc-type"] == "response":
                kept[int(h["warc-record-id"].strip("<>").split(":")[-1])] = block.partition(b"\r\n\r\n")[2].decode()
    assert kept == {i: next(t or "" for k, _, t in rows if k == i) for i, _, _, kind, _ in want if kind == "response"}


def test_nulls_repeats_and_empty_pages(spark):
    rows = [(1, "u", "same"), (1, "u", "same"), (None, "v", "same"), (None, None, None), (5, "w", None)]
    got = archive_pages(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted((repr(r.page_id), r.record_type, repr(r.refers_to)) for r in got) == [
        ("1", "response", "None"), ("1", "response", "None"), ("5", "response", "None"), ("None", "revisit", "1"), ("None", "revisit", "5")]
    assert archive_pages(spark.createDataFrame([], PAGES)).count() == 0


def brute(rows, k, is_query):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = max(ok.get(i, v), v)
    out = []
    for q, x in ok.items():
        if is_query(q):
            score = []
            for i, y in ok.items():
                if i != q and len(y) == len(x):
                    s = 0.0
                    for a, b in zip(x, y):
                        s += a * b
                    score.append((-s, i))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(score)[:k])]
    return sorted(out)


def test_nearest_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(N, "QUERY_ROWS", 4)
    rng = np.random.default_rng(3)
    f32 = lambda x: [float(np.float32(y)) for y in x]
    rows = [(i, f32(rng.normal(size=8))) for i in range(300)] + [(300 + i, f32([1] * 8)) for i in range(60)]  # ties
    rows += [(400, None), (401, [0.0] * 8), (402, [1.0, None] + [1.0] * 6), (403, [math.nan] + [1.0] * 7), (404, [math.inf] + [1.0] * 7), (None, [1.0] * 8),
             (405, []), (420, f32(rng.normal(size=3))), (421, f32(rng.normal(size=3))), (40, f32([9] * 8)), (40, f32([9] * 8)), (440, [5.0]), (460, [1e-30] * 8), (480, [1e18] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = N.nearest_vectors(clashing(df, "dim", "block", "score"), F.col("vec_id") % 20 == 0)
    f = lambda v: [float(np.float32(y)) if y is not None else None for y in v] if v is not None else None
    assert sorted(tuple(r) for r in got.collect()) == brute([(i, f(v)) for i, v in rows], 20, lambda q: q % 20 == 0)
    assert N.nearest_vectors(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
