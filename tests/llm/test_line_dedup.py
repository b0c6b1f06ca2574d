import random

import pytest

from closecast.llm import line_dedup
from closecast.llm.common import words
from closecast.llm.line_dedup import dedup_lines
from tests.llm.helpers import clashing, corpus, edited, frame, prose


def brute(rows):
    """Each row's text without the lines that match a line at an earlier place."""
    places = []  # distinct (doc, text) are one place each
    for doc, text in sorted({(r[0], r[1]) for r in rows if r[1]}, key=lambda x: (x[0] is None, x[0] or 0, x[1])):
        for k, line in enumerate(text.split("\n")):
            s = frozenset(words(line.encode()))
            if s:
                places.append(((doc is None, doc or 0, k), text, s))
    gone = set()
    for at, text, s in places:
        for at2, _, s2 in places:
            if at2 < at and len(s & s2) >= 0.8 * len(s | s2) - 1e-9:
                gone.add((at[:2], at[2], text))
                break
    out = []
    for r in rows:
        doc = (r[0] is None, r[0] or 0)
        out.append((repr(r[0]), None if r[1] is None else "\n".join(x for k, x in enumerate(r[1].split("\n")) if (doc, k, r[1]) not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [32, 2])  # sweeps and blocks give the same
def test_against_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(line_dedup, "SMALL", small)
    rng = random.Random(5)
    rows = corpus(rng)
    base = prose(rng, 80)
    rows += [(500 + k, "the\n" + edited(rng, base, 0.05) + "\n" + prose(rng, 4) + "\nThe end.", "en", "s", 1) for k in range(40)]
    got = dedup_lines(frame(spark, rows)).collect()
    assert sorted(((repr(r.doc_id), r.text) for r in got), key=repr) == brute(rows)
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)


def test_removes_later_lines_only(spark):
    rows = [(1, "a b c d e f g h i j\nunique words here", "en", "s", 1), (2, "tail line\nj i h g f e d c b A!\n\n", "en", "s", 1)]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(frame(spark, rows)).collect()}
    assert got == {1: (rows[0][1], 2, 0), 2: ("tail line\n\n", 4, 1)}


def test_empty_table_and_clashing_columns(spark):
    rows = corpus(random.Random(6), 6)
    docs = clashing(frame(spark, rows), "key", "doc", "tag", "n_removed", "maybe2")
    got = dedup_lines(docs)
    assert got.count() == len(rows) and got.columns.count("n_removed") == 1 and got.first()["key"] == "clash"
    assert dedup_lines(docs.limit(0)).count() == 0


def test_second_pass_finds_every_similar_pair(spark):
    """The pairs of ``_remaining`` for all members hold every earlier similar set, not only the earliest."""
    from pyspark.sql import functions as F

    rng = random.Random(15)
    base = prose(rng, 60)
    texts = {k: edited(rng, base, 0.06) if k % 2 else prose(rng, 40) for k in range(40)}
    docs = frame(spark, [(k, t, "en", "s", 1) for k, t in texts.items()])
    src = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("tag"), "text")
    rare = spark.sparkContext.broadcast(line_dedup.rarity(docs))
    lines = src.mapInArrow(line_dedup._line_sets(rare, 0.8), line_dedup._LINES)
    def tokens(batches):  # every prefix word of every line
        import numpy as np
        import pandas as pd

        for b in batches:
            for doc, line, raw in zip(b["doc"], b["line"], b["prefix"]):
                token = np.frombuffer(raw, dtype=np.uint64) & np.uint64((1 << 44) - 1)
                yield pd.DataFrame({"doc": doc, "line": line, "token": token.astype(np.int64)})
    own = lines.mapInPandas(tokens, "doc long, line int, token long").distinct()
    got = {(r.doc, r.doc2) for r in line_dedup._remaining(lines, own, 0.8).collect()}
    sets = {k: frozenset(words(t.encode())) for k, t in texts.items()}
    want = {(j, i) for j in sets for i in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert len(want) > 50 and want <= got


def test_null_and_equal_ids_with_different_texts(spark):
    """Places of rows with equal or null ids are told apart by their texts; earlier is by (doc, tag, line)."""
    from pyspark.sql import functions as F

    rng = random.Random(31)
    base = [prose(rng, 30) for _ in range(6)]
    rows = [(1, "\n".join([prose(rng, 9), base[0], prose(rng, 9)]), "en", "s", 1)]
    for k in range(24):  # line 1 is a near copy in some, line 0 the same in all of one kind, line 2 clean in all
        lines = [base[1 + k % 5], edited(rng, base[0], 0.05) if k % 3 == 0 else prose(rng, 20), prose(rng, 12)]
        rows.append((None if k % 2 else 5 + k % 4, "\n".join(lines), "en", "s", 1))
    docs = frame(spark, rows)
    tag = {r.text: r.tag for r in docs.select("text", F.xxhash64("text").alias("tag")).collect()}
    places = [((r[0] is None, r[0] or 0, tag[r[1]], k), frozenset(words(x.encode()))) for r in rows for k, x in enumerate(r[1].split("\n"))]
    gone = {at for at, s in places for at2, s2 in places if at2 < at and len(s & s2) >= 0.8 * len(s | s2) - 1e-9}
    want = sorted((repr(r[0]), "\n".join(x for k, x in enumerate(r[1].split("\n")) if (r[0] is None, r[0] or 0, tag[r[1]], k) not in gone)) for r in rows)
    assert sorted((repr(r.doc_id), r.text) for r in dedup_lines(docs).collect()) == want
    assert len(gone) > 20


def test_text_with_more_than_2_to_the_20_lines():
    """Every line keeps its own words, also beyond 2^20 lines of one text."""
    import numpy as np
    import pyarrow as pa

    class Rare:
        value = np.zeros(1 << line_dedup.COUNTER_BITS, dtype=np.uint64)

    n = (1 << 20) + 5
    text = "\n".join(["a", "b c"] + ["x"] * (n - 4) + ["a", "b c"])
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text])], names=["doc", "tag", "text"])
    got = pa.Table.from_batches(list(line_dedup._line_sets(Rare, 0.8)(iter([batch]))))
    assert got["line"].to_pylist() == list(range(n))
    key, size = got["key"].to_numpy(), got["n"].to_numpy()
    assert key[0] == key[n - 2] and key[1] == key[n - 1] and len(set(key.tolist())) == 3
    assert (size == np.array([1, 2] + [1] * (n - 3) + [2])).all()


def test_unlike_lines_of_one_word_number_stay(spark):
    """Two words with the same 44-bit number; and lines of the same words, as often or not, go."""
    rows = [(1, "id0172852", "en", "s", 1), (2, "id0405705", "en", "s", 1), (3, "b a\nx", "en", "s", 1), (4, "a A b\nB a", "en", "s", 1)]
    got = {r.doc_id: (r.text, r.n_removed) for r in dedup_lines(frame(spark, rows)).collect()}
    assert got == {1: ("id0172852", 0), 2: ("id0405705", 0), 3: ("b a\nx", 0), 4: ("", 2)}


def test_lines_collapse_by_bucket():
    """Lines travel as one row a bucket; of each set the earliest place stays, all others but repeated rows are copies."""
    import numpy as np
    import pyarrow as pa

    class Rare:
        value = np.zeros(1 << line_dedup.COUNTER_BITS, dtype=np.uint64)

    rng = random.Random(41)
    common = [prose(rng, n) for n in (1, 2, 9, 30)]
    rows = [(d, d % 3, "\n".join(rng.choice(common) if rng.random() < 0.5 else prose(rng, 8) for _ in range(6))) for d in range(60)]
    rows += rows[:5]
    rng.shuffle(rows)
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[lo:lo + 20], strict=True)], names=["doc", "tag", "text"]) for lo in range(0, len(rows), 20)]
    dealt = [b for x in batches for b in line_dedup._dealt_lines(Rare, 0.8, 4)(iter([x]))]
    assert sum(b.num_rows for b in dealt) <= 4 * len(batches)
    whole = pa.Table.from_batches(dealt).sort_by("bucket").combine_chunks()
    out = list(line_dedup._collapsed(iter(whole.to_batches())))
    first, later = {}, set()
    for d, t, text in sorted(set(rows)):
        for k, line in enumerate(text.split("\n")):
            key = tuple(sorted(words(line.encode())))
            if first.setdefault(key, (d, t, k)) != (d, t, k):
                later.add((d, t, k))
    sets = pa.Table.from_batches(list(line_dedup._sets(iter(out))))
    assert sorted(zip(*(sets[c].to_pylist() for c in ("doc", "tag", "line")), strict=True)) == sorted(first.values())
    assert sum(sum(b.column("words").to_pylist()) for b in out) * 8 == sum(len(x) for x in sets["prefix"].to_pylist())
    copies = pa.Table.from_batches([x for b in out for x in line_dedup._copies(iter([b.filter(b.column("copies").is_valid())]))])
    assert set(zip(*(copies[c].to_pylist() for c in ("doc", "tag", "line")), strict=True)) == later and later


def test_members_of_unlike_sizes_are_not_compared(monkeypatch):
    """In a word's group only sets of near sizes meet the filters, and each keeps its earliest that passes."""
    import numpy as np

    rng = np.random.default_rng(7)
    size = 600
    n = rng.integers(1, 2000, size)
    zero = np.zeros(size, dtype=np.int64)
    g = line_dedup._Posted(zero, np.arange(size), zero, zero, n, zero, zero.view(np.uint64), zero.view(np.uint64))
    asked, passing = [], line_dedup._passing
    monkeypatch.setattr(line_dedup, "_passing", lambda g, i, j, t: asked.append(len(i)) or passing(g, i, j, t))
    near = np.minimum(n[:, None], n) >= 0.8 * np.maximum(n[:, None], n)
    want = {j: (int(np.flatnonzero(near[:j, j])[0]), int(near[:j, j].sum())) for j in range(size) if near[:j, j].any()}
    wide = [x.astype(t) if t else x for x, t in zip(g, (np.uint64, None, None, np.int32, np.int32, np.int32, np.int64, np.int64), strict=True)]
    monkeypatch.setattr(line_dedup, "_bucket_groups", lambda batches: iter([wide]))
    out = next(line_dedup._candidates(0.8, False)(iter([])))
    got = {j: (i, more) for j, i, more in zip(*(out.column(c).to_pylist() for c in ("doc", "doc2", "more")), strict=True)}
    assert got == {j: (i, k > 1) for j, (i, k) in want.items()}
    assert sum(asked) == sum(k for _, k in want.values())


def test_words_between_borders():
    """No word crosses a border; borders may repeat and stand inside, at the edge of or between words."""
    import numpy as np

    from closecast.llm.common import chunk_words

    rng = random.Random(3)
    for _ in range(300):
        rows = ["".join(rng.choice("aB9 \n.é") for _ in range(rng.randrange(6))).encode() for _ in range(rng.randrange(1, 6))]
        w = chunk_words(b"".join(rows), np.cumsum([0, *map(len, rows)]))
        data = b"".join(rows)
        got = [[data[a:b].lower() for a, b in zip(w.start[x:y], w.end[x:y], strict=True)] for x, y in zip(w.first[:-1], w.first[1:], strict=True)]
        assert got == [[x.lower() for x in words(r)] for r in rows]
