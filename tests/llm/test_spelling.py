"""op12 against comparing all words."""
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from closecast.llm import spelling as S
from tests.llm.helpers import DOCS, clashing, corpus


def is_letter(c):
    return c.isascii() and c.isalpha() or "À" <= c <= "ÿ"


def counts(rows, drop_every=97):
    total = Counter()
    for doc, text, *_ in rows:
        runs, run = [], ""
        for c in (text or "") + " ":
            if is_letter(c):
                run += c.lower() if c.isascii() else c
            elif run:
                runs.append(run)
                run = ""
        for w in runs:
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % drop_every == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            if len(w) >= 5:
                total[w] += 1
    return {w: n for w, n in total.items() if n >= 3}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    links = {w: set() for w in n}
    for a, b in combinations(sorted(n), 2):
        if near(a, b):
            links[a].add(b)
            links[b].add(a)
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(links[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def misspelt(rng, n_docs=60):
    stems = ["colour", "harbour", "favourite", "théâtre", "naïveté", "aaaaa", "aaaaaa", "aabaa", "ababab", "bababa", "ÿÿÿÿÿ", "ÿÿÿÿÿÿ"]
    rows = []
    for d in range(n_docs):
        words = []
        for _ in range(120):
            w = rng.choice(stems)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abéÿ") + w[k:], w[:k] + rng.choice("abéÿ") + w[k + 1:]])
            words.append(rng.choice([w, w.upper() if w.isascii() else w]))
        text = rng.choice([" ", "-", "1", "\n", " Ω ", "中"]).join(words)
        rows.append((d, text, "en", "s", len(text)))
    return rows


def found(spark, rows, **more):
    df = clashing(spark.createDataFrame(rows, DOCS), "word", "n", "form", "root", "key", "m").repartition(3)
    return sorted((tuple(r) for r in S.spelling_variants(df, **more).collect()), key=repr)


@pytest.mark.parametrize("tile_words", [1 << 14, 7])
def test_equals_all_pairs(spark, tile_words):
    rng = random.Random(4)
    rows = misspelt(rng) + corpus(rng) + [(None, "colour colour colour harbou", None, None, None), (7, "", "en", "s", 0), (7, "colour", "en", "s", 6)]
    want = brute(counts(rows))
    assert sum(r[4] > 1 for r in want) > 50 and any(r[1] and r[2] != r[1] for r in want)
    assert found(spark, rows, tile_words=tile_words) == want


def test_no_words(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "12 !! abc", "en", "s", 9)]) == []


def test_runs_across_slices(monkeypatch):
    monkeypatch.setattr(S, "SLICE_CHARS", 7)
    text = "Alpha  beta_gamma" + "x" * 40 + " ünïcødé×÷ 中文delta"
    got = Counter()
    for c in S.letter_runs(text):
        got += c
    assert {w.decode("latin-1"): n for w, n in got.items()} == {"alpha": 1, "beta": 1, "gamma" + "x" * 40: 1, "ünïcødé×÷": 1, "delta": 1}


def test_one_edit_along_a_sorted_list():
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 8))) for _ in range(150)})
    enc = [w.encode() for w in words]
    zero = np.zeros(len(words), dtype=np.int64)
    listed = S.SortedList(enc, zero, zero)
    q, w = S.one_edit(listed, listed.letters, listed.length, zero)
    assert sorted(zip(q.tolist(), w.tolist())) == sorted((i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b))


def test_chains_end_at_the_last_form(spark):
    rows = [(f"w{i}", f"w{i + 1}") for i in range(19)] + [("x", "w3"), ("y", "x"), ("z", "lone")]
    got = {r["word"]: r["root"] for r in S.roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {**{f"w{i}": "w19" for i in range(19)}, "x": "w19", "y": "w19", "z": "lone"}
