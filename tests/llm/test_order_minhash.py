import random

import numpy as np

from closecast.llm.common import words
from closecast.llm.components import components
from closecast.llm.order_minhash import _verified_links, aligned_words, near_duplicates, order_sketches, passing, similarity
from tests.llm.helpers import clashing, corpus, edited, frame, prose


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            row[j], prev = (prev + 1 if x == y else max(row[j], row[j - 1])), row[j]
    return row[-1]


def test_alignment_is_the_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        a = np.array([rng.randrange(6) for _ in range(rng.randrange(0, 30))], dtype=np.uint64)
        b = np.array([rng.randrange(6) for _ in range(rng.randrange(0, 30))], dtype=np.uint64)
        assert aligned_words(a, b, 40) == lcs(a.tolist(), b.tolist())
        want = lcs(a.tolist(), b.tolist())
        sim = want / (len(a) + len(b) - want) if len(a) + len(b) else 0
        assert (similarity(a, b) >= 0.8) == (sim >= 0.8)
        if sim >= 0.8:
            assert similarity(a, b) == sim


def test_order_and_occurrence_matter():
    h = np.arange(1, 41, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    swapped = np.concatenate([h[20:], h[:20]])
    again = np.concatenate([h, h])
    one, two, three = (order_sketches(x, np.array([0, len(x)]), 64)[0] for x in (h, swapped, again))
    assert (one == order_sketches(h, np.array([0, 40]), 64)[0]).all()
    assert 0 < (one == two).sum() < 64  # the same shingles in another order do not always meet
    assert (one == three).sum() < 64


def brute(rows):
    """Classes over all pairs, by full alignment."""
    tok = [words((r[1] or "").encode()) for r in rows]
    names = {}
    num = [np.array([names.setdefault(w, len(names) + 1) for w in t], dtype=np.uint64) for t in tok]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "") or (tok[i] and tok[i] == tok[j])
            near = not same and len(num[i]) and len(num[j]) and similarity(num[i], num[j]) >= 0.8
            if same or rows[i][0] == rows[j][0] and rows[i][0] is not None or near:
                parent[find(i)] = find(j)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(ids.get(find(i), r[0]), r[0])
    return sorted((repr(r[0]), r[1] or "", repr(ids.get(find(i), "no id"))) for i, r in enumerate(rows))


def classes(spark, rows):
    """near_duplicates over ``rows``, in the form of ``brute``: (doc_id, class)."""
    known = {r[0] for r in rows}
    got = near_duplicates(frame(spark, rows)).collect()
    return sorted((repr(r.doc_id), repr(r.class_id if r.class_id in known else "no id")) for r in got)


def test_classes_against_brute_force(spark):
    rng = random.Random(4)
    rows = corpus(rng)
    base = prose(rng, 120)
    rows += [(400 + k, edited(rng, base, 0.02), "en", "s", 1) for k in range(15)] + [(450, "   " + base.upper() + " ...", "en", "s", 1), (451, base, "en", "s", 1)]
    want = sorted((i, c) for i, _, c in brute(rows))
    assert classes(spark, rows) == want
    assert {c for i, c in want if i in {str(k) for k in range(400, 452)}} == {"400"}


def test_no_words_no_rows_and_clashing_columns(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "--", "en", "s", 0)]
    assert {r.doc_id: r.class_id for r in near_duplicates(clashing(frame(spark, rows), "class_id", "keys", "rep")).collect()} == {1: 1, 2: 1, 3: 3}
    assert near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(30)}}


def test_every_pair_of_a_bucket_is_tried(spark):
    """Links beside unlike texts of one bucket, neither neighbours nor with its first or shortest members."""
    rng = random.Random(21)
    a, b, c, e, f, g = (prose(rng, 60) for _ in range(6))
    texts = [a, b, c, edited(rng, b, 0.03)]  # 1 to 4: only 2 and 4 are alike
    # 12, 14 and 15 hang together by 15 alone
    word = e.split(" ")
    drift = [" ".join([f"x{k}" for k in range(n)] + word[n:]) for n in (0, 5)] + [" ".join(word[:-6] + [f"y{k}" for k in range(6)])]
    rows = [(k + 1, t, "en", "s", 1) for k, t in enumerate(texts)]
    rows += [(11 + k, t, "en", "s", 1) for k, t in enumerate([f, drift[1], g, drift[2], drift[0]])]
    entries = spark.createDataFrame([(7 if r[0] < 10 else 8, 0, 60, r[0]) for r in rows], "key long, t int, n_words long, rep long")
    links, comp = _verified_links(frame(spark, rows).select("doc_id", "text"), entries, 0.8)
    assert {(r.node, r.component) for r in comp.collect()} == {(2, 2), (4, 2), (12, 12), (14, 12), (15, 12)}
    assert {(r.a, r.b) for r in links.collect()} >= {(2, 4)}


def test_null_and_equal_ids_take_part(spark):
    rng = random.Random(41)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (2, edited(rng, b, 0.02), "en", "s", 1), (None, edited(rng, a, 0.02), "en", "s", 1),
            (None, edited(rng, a, 0.02), "en", "s", 1), (None, c, "en", "s", 1), (None, edited(rng, c, 0.02), "en", "s", 1), (None, d, "en", "s", 1), (3, prose(rng, 60), "en", "s", 1)]
    assert classes(spark, rows) == sorted((i, k) for i, _, k in brute(rows))
    got = [r.class_id for r in near_duplicates(frame(spark, rows)).collect() if r.doc_id is None]
    assert sorted(got.count(x) for x in set(got)) == [1, 2, 2]  # those without any id: two copies in one class, one by itself


def test_blocks_hand_on_links_only(spark, monkeypatch):
    """A bucket of many unlike texts that all pass the filters: rows stay linear, however the blocks are cut."""
    from closecast.llm import order_minhash

    rng = random.Random(42)
    words_ = [f"w{k}" for k in range(40)]
    texts = {}
    for k in range(60):  # the same words in another order each: the counters cannot tell them apart
        texts[k] = " ".join(rng.sample(words_, 40))
    for k in range(60, 120):
        texts[k] = edited(rng, texts[k - 60 if k < 100 else 0], 0.05)
    rows = [(k, t, "en", "s", 1) for k, t in texts.items()]
    docs = frame(spark, rows).select("doc_id", "text")
    entries = spark.createDataFrame([(7 + t, t, 40, k) for k in texts for t in range(2)], "key long, t int, n_words long, rep long")
    none = spark.createDataFrame([], "node long, component long")
    tokens = order_minhash._tokens_table(docs, entries.select("rep").distinct())
    want = {}
    for i, t, c in brute(rows):
        want[int(i)] = int(c)
    for size in (1024, 16):
        monkeypatch.setattr(order_minhash, "_BLOCK", size)
        links = order_minhash._remaining_links(entries, none, tokens, 0.8)
        got = {r.node: r.component for r in components(links).collect()}
        assert {k: got.get(k, k) for k in texts} == want
        assert links.count() <= (120 if size == 1024 else 120 * 8)  # of 7,140 pairs a bucket


def test_filters_pass_every_link():
    rng = random.Random(22)
    for _ in range(200):
        a = [rng.randrange(50) for _ in range(rng.randrange(1, 60))]
        b = [rng.randrange(50) if rng.random() < 0.1 else x for x in a][:rng.randrange(1, 61)]
        n, m = (np.array([len(x)]) for x in (a, b))
        count = lambda x: np.bincount(np.array(x) % 7, minlength=7).astype(np.uint8)[None]
        if similarity(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)) >= 0.8:
            assert passing(n, count(a), m, count(b), 0.8)[0].all()


def test_result_holds_no_count_of_sampled_links(spark):
    assert near_duplicates(frame(spark, [(1, "a b", "en", "s", 3)])).columns == ["doc_id", "class_id"]


def test_members_are_not_copied_to_bands_without_active_ones(spark, monkeypatch):
    """A bucket of one big component and one other text: only the groups of a length band are spread over the bands near them."""
    from closecast.llm import order_minhash

    rng = random.Random(43)
    base = prose(rng, 60)
    rows = [(k, edited(rng, base, 0.02), "en", "s", 1) for k in range(12)] + [(50, prose(rng, 61), "en", "s", 1)]
    entries = spark.createDataFrame([(7, 0, len(words(t)), k) for k, t, *_ in rows], "key long, t int, n_words long, rep long")
    comp = spark.createDataFrame([(k, 0) for k in range(12)], "node long, component long")
    tokens = order_minhash._tokens_table(frame(spark, rows).select("doc_id", "text"), entries.select("rep").distinct())
    plans, kept = [], order_minhash.checkpointed
    monkeypatch.setattr(order_minhash, "checkpointed", lambda df, *a, **k: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or kept(df, *a, **k))
    order_minhash._remaining_links(entries, comp, tokens, 0.8)
    spread = [line for plan in plans for line in plan.splitlines() if "Generate explode(sequence((band" in line]
    assert spread and not [line for line in spread if "rep#" in line]
