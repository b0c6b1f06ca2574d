import hashlib
import random

import numpy as np
import pytest

from closecast.llm.licenses import TEMPLATES, scan_licenses
from closecast.llm.mixing import mix_sources, period, source_units
from closecast.llm.substring_dedup import dedup_substrings, difference_cover
from tests.llm.helpers import clashing, corpus, edited, frame, prose


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 7, "b": 1, "c": 1, "d": 13, "e": 5}, {f"s{k:02d}": 1 + k * k % 11 for k in range(20)}])
def test_deviation_is_under_one_block(spark, weights):
    docs = frame(spark, [(1, "x", "en", min(weights), 1)])
    plan = [(r.source, r.units, r.total, r.nth, r.slot) for r in period(source_units(docs, weights)).collect()]
    total = sum(weights.values())
    assert sorted(p[4] for p in plan) == list(range(total)) and all(p[2] == total for p in plan)
    order = [p[0] for p in sorted(plan, key=lambda p: p[4])]
    for s, u in weights.items():
        had = np.cumsum([x == s for x in order])
        ideal = np.arange(1, total + 1) * u / total
        assert np.abs(had - ideal).max() < 1
    for s, u, t, nth, slot in plan:
        assert nth * t // u <= slot < -(-(nth + 1) * t // u)  # released, and not late


def test_all_rows_stay_and_blocks_are_whole(spark):
    rows = corpus(random.Random(11), 80) + [(700 + k, "t", "en", "hot", 1) for k in range(150)]
    got = mix_sources(clashing(frame(spark, rows), "units", "rows", "slot"), block_docs=4).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.source or "", []).append((r.block, r.in_block, r.slot))
    slots = {}
    for s, places in by.items():
        assert sorted((b, i) for b, i, _ in places) == [(k // 4, k % 4) for k in range(len(places))]
        for b, _, slot in places:
            slots.setdefault((s, b), set()).add(slot)
    assert all(len(x) == 1 for x in slots.values()) and len({min(x) for x in slots.values()}) == len(slots)
    assert mix_sources(frame(spark, rows).limit(0)).count() == 0


def test_difference_covers():
    for length in (1, 5, 11, 20, 50, 200, 1000):
        v, cover = difference_cover(length)
        assert {(a - b) % v for a in cover for b in cover} == set(range(v)) and v <= max(1, length / 3)


def brute(rows, length):
    raw = [(r[1] or "").encode() for r in rows]
    seen = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = []
    for r, b in zip(rows, raw):
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        out.append((repr(r[0]), len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length", [7, 30, 200])
def test_substrings_against_brute_force(spark, length):
    rng = random.Random(12)
    rows = corpus(rng, 12)
    passage = prose(rng, 60)
    rows += [(600 + k, prose(rng, k) + passage + prose(rng, 9 - k), "en", "s", 1) for k in range(8)]
    rows += [(650, "ab" * 300, "en", "s", 1), (651, "z" * length, "en", "s", 1), (652, "y" * (length + 1), "en", "s", 1), (653, edited(rng, passage, 0.1), "en", "s", 1)]
    rows = [r for r in rows if len(r[1] or "") < 20_000] + [(660, prose(rng, 3000), "en", "s", 1)]
    got = dedup_substrings(clashing(frame(spark, rows), "chunk", "ids", "bucket"), length).collect()
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows, length)


def test_substrings_of_no_rows(spark):
    assert dedup_substrings(frame(spark, corpus(random.Random(1), 2)).limit(0)).count() == 0


def test_licences_and_inheritance(spark):
    rng = random.Random(13)
    text = lambda *lines: "\n".join(lines)
    body = prose(rng, 50)
    rows = [
        ("a/LICENSE", text("Released under the MIT License.", body)), ("a/b/one", body), ("a/b/c/two", body), ("a/b/c/d/apache", text(body, "", "// Licensed under the Apache License, Version 2.0.", "")),
        ("a/b/c/d/three", body), ("a/b/own", text(body, "This work is licensed under the GNU General Public License, version 3!", body)), ("z/four", body), ("five", body), (None, body),
        ("a/null", None), ("a/empty", ""), ("z/also", "the license of the river is a public stone"), ("a/b/one", body)]
    df = clashing(spark.createDataFrame(rows, "path string, text string").repartition(3), "given", "depth", "license")
    got = {}
    for r in scan_licenses(df).collect():
        got.setdefault(r.path, set()).add((r.license, r.origin, r.inherited_from))
    assert got == {
        "a/LICENSE": {("MIT", "own", None)}, "a/b/one": {("MIT", "inherited", "a")}, "a/b/c/two": {("MIT", "inherited", "a")}, "a/b/c/d/apache": {("Apache-2.0", "own", None)},
        "a/b/c/d/three": {("Apache-2.0", "inherited", "a/b/c/d")}, "a/b/own": {("GPL-3.0", "own", None)}, "z/four": {(None, "none", None)}, "five": {(None, "none", None)},
        None: {(None, "none", None)}, "a/null": {("MIT", "inherited", "a")}, "a/empty": {("MIT", "inherited", "a")}, "z/also": {(None, "none", None)}}
    assert scan_licenses(df.limit(0)).count() == 0


def test_every_template_finds_itself(spark):
    rows = [(f"x/{k}/{n}", t) for k, own in TEMPLATES.items() for n, t in enumerate(own)] + [(f"y/{i}", prose(random.Random(i), 40)) for i in range(200)]
    got = {r.path: r.license for r in scan_licenses(spark.createDataFrame(rows, "path string, text string")).collect() if r.origin == "own"}
    assert got == {f"x/{k}/{n}": k for k, own in TEMPLATES.items() for n in range(len(own))}
