import random
import zlib

import numpy as np

from closecast.llm import langid, quality
from closecast.llm.common import chunk_words
from tests.llm.helpers import WORDS, clashing, corpus, frame, prose


def junk(rng, n):
    return " ".join(rng.choice(WORDS).upper() + rng.choice(["!!", "###", " | ", "$$$"]) for _ in range(n))


def labelled(rng, n=400):
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        rows.append((i, (prose if good else junk)(rng, rng.randrange(20, 80)), "en", f"s{i % 3}", 1))
        labels.append((i, int(good), 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy_and_awkward_rows(spark):
    rng = random.Random(7)
    rows, labels = labelled(rng)
    labels += [(None, 1, 0), (3, None, 0), (99999, 0, 0)]
    docs = frame(spark, rows + corpus(rng, 5)[5:])
    got = quality.score_quality(clashing(docs, "score", "quality"), quality.train(docs, spark.createDataFrame(labels, LABELS))).collect()
    truth = {d: q for d, q, _ in labels[:400]}
    out = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(out) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in out]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert len(got) == docs.count()


def test_no_labels_and_no_rows(spark):
    docs = frame(spark, corpus(random.Random(8), 3))
    trees = quality.train(docs, spark.createDataFrame([], LABELS))
    assert {r.score for r in quality.score_quality(docs, trees).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), trees).count() == 0


def test_flat_trees_follow_the_splits():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = quality.fit(x, y)

    def walk(row):
        total = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            i = 0
            while i < len(f):
                i = 2 * i + (2 if row[f[i]] > t[i] else 1)
            total += leaf[i - len(f)]
        return 1 / (1 + np.exp(-total))
    p = quality.predict(trees, x)
    assert np.allclose(p, [walk(r) for r in x]) and ((p > 0.5) == y).mean() > 0.95


def test_word_probability_sums_all_segmentations():
    pieces = [b" a", b"ab", b" ", b"a", b"b", b"aba", b"c"]
    keys = [langid.piece_key(len(p), langid.rolled(np.frombuffer(p, dtype=np.uint8).reshape(1, -1)))[0] for p in pieces]
    vocab = langid.Vocabulary(np.sort(np.array(keys)), 3)
    rng = np.random.default_rng(2)
    value = rng.random((len(pieces), 2))
    prob = value[[keys.index(k) for k in vocab.keys]]

    def total(word, j):
        return sum(value[pieces.index(p), j] * total(word[len(p):], j) for p in pieces if word.startswith(p)) if word else 1.0
    data = b"ab ababa c abcabab " + b"ab" * 60
    w = chunk_words(data, np.array([0, len(data)]))
    got = langid.word_scores(vocab, prob, data, w.start[:4], w.end[:4])
    want = [[np.log(total(b" " + x, j)) for j in range(2)] for x in data.split()[:4]]
    assert np.allclose(got, want)
    # a long word whose probability is below what a double holds
    long = b"ab" * 1500
    tiny = langid.word_scores(vocab, prob * 1e-3, long, np.array([0]), np.array([len(long)]))
    assert np.isfinite(tiny).all() and (tiny < -800).all()
    # expectations: every segmentation of a word covers its bytes
    exp = langid._expected(vocab, prob, data, w.start[:4], w.end[:4], np.ones((4, 2)))
    size = np.array([len(pieces[keys.index(k)]) for k in vocab.keys])
    assert np.allclose((exp * size[:, None]).sum(axis=0), sum(len(x) + 1 for x in data.split()[:4]))


def test_languages(spark):
    rng = random.Random(9)
    own = {"aa": "talo kivi vesi metsä yö järvi".split(), "bb": "huis steen water woud nacht meer".split()}
    rows = [(i, " ".join(rng.choice(own[x]) for _ in range(12)), x, "s", 1) for i in range(120) for x in [rng.choice(["aa", "bb"])]]
    odd = [(500, None, "aa", "s", 1), (501, "123 --- 456", "aa", "s", 1), (502, "", None, "s", 1), (None, "talo kivi", None, "s", 1), (503, "x" * 70_000, None, "s", 1)]
    docs = frame(spark, rows + odd)
    got = {r.doc_id: r for r in langid.identify(clashing(docs, "score", "piece"), langid.train(docs)).collect()}
    assert all(got[i].lang_pred == x for i, _, x, _, _ in rows) and any(got[i].held_out for i in range(120))
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (500, 501, 502)) and got[None].lang_pred == "aa" and got[503].lang_pred in own
    empty = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, empty).collect()} == {"und"} and langid.identify(docs.limit(0), empty).count() == 0


def test_text_without_spaces_teaches(spark):
    """Languages whose words are all runs of hundreds of bytes are learned, from all of the runs."""
    rng = random.Random(41)
    letters = {"zh": "的一是不了人我在有他这为之大来以个中上们", "th": "กขคงจชซญดตถทนบปผพภมย"}
    rows = [(k, "".join(rng.choice(letters[x]) for _ in range(300)), x, "s", 1) for k, x in enumerate(["zh", "th"] * 30)]
    docs = frame(spark, rows)
    model = langid.train(docs)
    assert model.langs == ["th", "zh"]
    assert {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()} == {r[0]: r[2] for r in rows}
    data = rows[0][1].encode() + b" short"
    w = chunk_words(data, np.array([0, len(data)]))
    for longest in (64, 256):
        cut = langid._cut_long(w, data, longest)
        pieces = [data[a:b] for a, b in zip(cut.start, cut.end)]
        assert b"".join(pieces[:-1]).decode() == rows[0][1] and pieces[-1] == b"short" and max(map(len, pieces)) <= longest
        assert all(p.decode() for p in pieces) and cut.first.tolist() == [0, len(pieces)]
