"""Language identification with segmentation-marginalised unigrams over a fixed public vocabulary.

A text is a bag of words (runs of letters and their kin, A-Z lower-cased, with one leading space).
Each language has a probability for every piece of a public byte-level
vocabulary (it holds all single bytes, so every word can be segmented). The
probability of a word is the sum over all its segmentations of the product of
its pieces' probabilities, by the forward algorithm; a text's log likelihood adds its
words', and the language with the largest wins.

Training counts (word, lang) over all documents that are not held out, in
Spark with map-side sums. Expectation-maximisation then runs over the distinct
words: each task runs forward and backward passes and returns expected piece
counts per language, a table of vocabulary x languages whatever the corpus.
All words of a batch advance together, one byte a step, in numpy. Scoring
computes each distinct word of a task once, as long as they fit a bounded table. A word of over
LONGEST_WORD bytes (text without spaces) is segmented run by run of up to that size, cut at
characters; in training the runs have up to _TRAIN_WORD bytes, so all text teaches.

Defined cases: a null text or one without a letter is ``und`` with score 0; a
document without a language or with a null id's teaches as its own fold says
(null ids are not held out); without any labelled text everything is ``und``;
ties go to the smaller language name; repeated rows count and score alike.
``score`` is the winner's share of the likelihoods at equal priors.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closecast.llm.common import FOLD, Words, checkpointed, chunk_words, mix, span_hashes, text_chunks

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
MAX_PIECE = 12  # bytes; longer pieces are left out of the model
ROUNDS = 2
LONGEST_WORD = 256
_SMOOTH = 0.05
_STEP = 4096  # words that advance together
_LETTER = re.compile(r"[^\W\d_]")
_LOWER = np.frombuffer(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)), dtype=np.uint8)
_PIECE_BASE = np.array([0x9E3779B97F4A7C15], dtype=np.uint64)


class Vocabulary(NamedTuple):
    """Pieces as sorted 64-bit keys; ``ids`` are their places in the key order."""
    keys: np.ndarray
    longest: int


def piece_key(length: int, value: np.ndarray) -> np.ndarray:
    """Key of pieces of one length from their rolling value."""
    return mix(value + np.array(length, dtype=np.uint64) * _PIECE_BASE)


def rolled(raw: np.ndarray) -> np.ndarray:
    """Rolling value of each row of a byte matrix."""
    value = np.zeros(len(raw), dtype=np.uint64)
    for j in range(raw.shape[1]):
        value = value * np.uint64(0x100000001B3) + raw[:, j] + np.uint64(1)
    return value


def load_vocabulary(path: str = VOCABULARY, longest: int = MAX_PIECE) -> Vocabulary:
    """Pieces of a ``base64 rank`` file, folded to lower case, up to ``longest`` bytes; all single bytes are there."""
    with open(path, "rb") as f:
        pieces = {base64.b64decode(line.split()[0]).lower() for line in f if line.strip()}
    pieces = {p for p in pieces if 0 < len(p) <= longest} | {bytes([c]) for c in range(256)}
    keys = [piece_key(n, rolled(np.frombuffer(b"".join(own), dtype=np.uint8).reshape(-1, n)))
            for n in range(1, longest + 1) if (own := sorted(p for p in pieces if len(p) == n))]
    return Vocabulary(np.unique(np.concatenate(keys)), longest)


def _matrix(data: bytes, start: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """Words as rows of folded bytes, one leading space, zero-padded to ``width`` + 1."""
    buf = np.append(_LOWER[np.frombuffer(data, dtype=np.uint8)], np.zeros(width, dtype=np.uint8))
    out = np.zeros((len(start), width + 1), dtype=np.uint8)
    out[:, 0] = 32
    inside = np.arange(width) < (end - start)[:, None]
    out[:, 1:] = np.where(inside, buf[np.minimum(start[:, None] + np.arange(width), len(buf) - 1)], 0)
    return out


def lattice(vocab: Vocabulary, raw: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
    """For each end position: (piece length, words, piece ids) of the pieces that end there."""
    out: list[list[tuple[int, np.ndarray, np.ndarray]]] = []
    wide = raw.astype(np.uint64) + np.uint64(1)
    for end in range(1, raw.shape[1] + 1):
        own = []
        live = np.flatnonzero(raw[:, end - 1])
        value, power = np.zeros(len(live), dtype=np.uint64), np.uint64(1)
        for n in range(1, min(end, vocab.longest) + 1):
            value = value + wide[live, end - n] * power
            with np.errstate(over="ignore"):
                power = power * np.uint64(0x100000001B3)
            key = piece_key(n, value)
            at = np.searchsorted(vocab.keys, key)
            at[at == len(vocab.keys)] = 0
            hit = vocab.keys[at] == key
            if hit.any():
                own.append((n, live[hit], at[hit]))
        out.append(own)
    return out


def forward(pieces: list, prob: np.ndarray, words: int, longest: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Scaled forward sums per end position and the log of the scale taken out, words x languages."""
    langs = prob.shape[1]
    alpha = [np.ones((words, langs))]
    log_scale = np.zeros((words, langs))
    for end, own in enumerate(pieces, 1):
        total = np.zeros((words, langs))
        for n, w, ids in own:
            total[w] += alpha[end - n][w] * prob[ids]
        ended = total[:, 0] == 0  # the word is over (or its sums are too small to hold): carry on
        total[ended] = alpha[-1][ended]
        alpha.append(total)
        small = total < 1e-120
        if small.any():
            scale = np.where(small & (total > 0), total, 1.0)
            alpha[-longest:] = [a / scale for a in alpha[-longest:]]
            log_scale += np.log(scale)
    return alpha, log_scale


def word_scores(vocab: Vocabulary, prob: np.ndarray, data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language, over all segmentations."""
    out = np.zeros((len(start), prob.shape[1]))
    size = end - start
    order = np.argsort(size, kind="stable")
    lo = 0
    while lo < len(order):
        # words of about one length advance together; long ones in smaller groups
        width = int(size[order[min(lo + _STEP, len(order)) - 1]])
        hi = lo + max(1, min(_STEP, (1 << 21) // (width + 1) // max(1, prob.shape[1])))
        take = order[lo:hi]
        raw = _matrix(data, start[take], end[take], int(size[take].max()))
        alpha, log_scale = forward(lattice(vocab, raw), prob, len(take), vocab.longest)
        with np.errstate(divide="ignore"):
            out[take] = np.log(alpha[-1]) + log_scale
        lo = hi
    return out


def _expected(vocab: Vocabulary, prob: np.ndarray, data: bytes, start, end, counts: np.ndarray) -> np.ndarray:
    """Expected piece counts (vocabulary x languages) of words seen ``counts`` times (words x languages)."""
    out = np.zeros_like(prob)
    size = end - start
    order = np.argsort(size, kind="stable")
    for lo in range(0, len(order), 1024):
        take = order[lo:lo + 1024]
        raw = _matrix(data, start[take], end[take], int(size[take].max()))
        pieces = lattice(vocab, raw)
        span = raw.shape[1]
        last = (raw != 0).sum(axis=1)
        # words are short here (see train): plain sums hold, no scaling
        alpha = [np.ones((len(take), prob.shape[1]))]
        for e in range(1, span + 1):
            total = np.zeros_like(alpha[0])
            for n, w, ids in pieces[e - 1]:
                total[w] += alpha[e - n][w] * prob[ids]
            alpha.append(total)
        whole = np.stack(alpha)[last, np.arange(len(take))]
        weight = counts[take] / np.maximum(whole, 1e-300)
        beta = [np.zeros_like(whole) for _ in range(span + 1)]
        for e in range(span, 0, -1):
            beta[e][last == e] = 1
            for n, w, ids in pieces[e - 1]:
                flow = beta[e][w] * prob[ids]
                np.add.at(out, ids, alpha[e - n][w] * flow * weight[w])
                np.add.at(beta[e - n], w, flow)
    return out


class Model(NamedTuple):
    vocab: Vocabulary
    langs: list[str]
    prob: np.ndarray  # vocabulary x languages


def held_out(folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each chunk with their counts, one language at a time."""
    for batch in batches:
        lang = np.array(batch.column("lang").to_pylist(), dtype=object)
        for c in text_chunks(batch.column("text")):
            w = _cut_long(chunk_words(c.data, c.offsets), c.data, _TRAIN_WORD)
            own = lang[c.lo:c.hi][np.searchsorted(w.first, np.arange(len(w.hash)), side="right") - 1]
            data = c.data.translate(FOLD)
            for name in dict.fromkeys(lang[c.lo:c.hi]):
                at = np.flatnonzero(own == name)
                _, first, count = np.unique(w.hash[at], return_index=True, return_counts=True)
                at = at[first]
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(at), pa.string()), pa.array([data[a:b] for a, b in zip(w.start[at], w.end[at], strict=True)], pa.binary()),
                    pa.array(count.astype(np.int64))], names=["lang", "word", "n"])


_TRAIN_WORD = 64  # longer words teach in runs of up to so many bytes


def _expect(vocab_of, prob_of, langs: list[str]):
    place = {x: k for k, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, prob = vocab_of.value, prob_of.value
        total = np.zeros_like(prob)
        for batch in batches:
            for lo in range(0, batch.num_rows, 20_000):
                b = batch.slice(lo, 20_000)
                word = b.column("word").to_pylist()
                ends = np.cumsum([len(x) for x in word])
                counts = np.zeros((len(word), len(langs)))
                counts[np.arange(len(word)), [place[x] for x in b.column("lang").to_pylist()]] = np.asarray(b.column("n"))
                total += _expected(vocab, prob, b"".join(word), np.concatenate([[0], ends[:-1]]).astype(np.int64), ends, counts)
        for j, x in enumerate(langs):
            ids = np.flatnonzero(total[:, j])
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(ids), pa.string()), pa.array(ids.astype(np.int32)), pa.array(total[ids, j])], names=["lang", "piece", "n"])
    return run


def train(docs: DataFrame, path: str = VOCABULARY, rounds: int = ROUNDS) -> Model:
    """Piece probabilities of each language, from all documents outside fold 2 of 4 with a language."""
    sc = docs.sparkSession.sparkContext
    vocab = load_vocabulary(path)
    counts = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("lang", "text")
              .mapInArrow(_word_counts, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    counts = checkpointed(counts)
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    prob = np.full((len(vocab.keys), len(langs)), 1 / len(vocab.keys))
    vocab_of = sc.broadcast(vocab)
    for _ in range(rounds if langs else 0):
        got = counts.mapInArrow(_expect(vocab_of, sc.broadcast(prob), langs), "lang string, piece int, n double")
        expected = np.zeros_like(prob)
        rows = got.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()  # vocabulary x languages at most
        expected[rows.column("piece").to_numpy(), [langs.index(x) for x in rows.column("lang").to_pylist()]] = rows.column("n").to_numpy()
        expected += _SMOOTH
        prob = expected / expected.sum(axis=0)
    return Model(vocab, langs, np.round(prob, 12) + 1e-12)


def _cut_long(w: Words, data: bytes, longest: int = LONGEST_WORD) -> Words:
    """Words with those over ``longest`` bytes cut into runs of up to that size, at the borders of characters."""
    size = w.end - w.start
    if not (size > longest).any():
        return w
    step = longest - 3  # a cut moves back by up to three bytes
    runs = np.where(size > longest, -(-size // step), 1)
    at = np.repeat(np.arange(len(size)), runs)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(runs) - runs, runs)
    start = w.start[at] + nth * step
    buf = np.frombuffer(data, dtype=np.uint8)
    for _ in range(3):
        start -= (nth > 0) & (buf[start] & 0xC0 == 0x80)
    end = np.where(nth + 1 < runs[at], np.append(start[1:], 0), w.end[at])
    return Words(start, end, span_hashes(buf, start, end), np.concatenate([[0], np.cumsum(runs)])[w.first])


def has_letter(data: bytes) -> bool:
    return _LETTER.search(data.decode("utf-8", "replace")) is not None


class KnownWords:
    """Scores of words met so far in a task, by hash; starts anew beyond LIMIT words, so its memory is bounded."""

    LIMIT = 400_000

    def __init__(self, langs: int):
        self.hash, self.scores = np.zeros(0, dtype=np.uint64), np.zeros((0, langs))

    def scored(self, model: Model, data: bytes, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Scores of words with distinct, sorted hashes ``h``."""
        if len(self.hash) > self.LIMIT:
            self.__init__(len(model.langs))
        at = np.searchsorted(self.hash, h)
        known = np.zeros(len(h), dtype=bool)
        inside = at < len(self.hash)
        known[inside] = self.hash[at[inside]] == h[inside]
        out = np.empty((len(h), len(model.langs)))
        out[known] = self.scores[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            out[new] = word_scores(model.vocab, model.prob, data, start[new], end[new])
            self.hash = np.insert(self.hash, at[new], h[new])
            self.scores = np.insert(self.scores, at[new], out[new], axis=0)
        return out


def classify(model: Model, data: bytes, offsets: np.ndarray, known: KnownWords) -> tuple[list[str], np.ndarray]:
    """Language and score of each text of a chunk."""
    n, langs = len(offsets) - 1, model.langs
    w = _cut_long(chunk_words(data, offsets), data)
    h, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
    if len(first) == 0 or not langs:
        return ["und"] * n, np.zeros(n)
    each = known.scored(model, data, w.start[first], w.end[first], h)
    total = np.zeros((n, len(langs)))
    row = np.repeat(np.arange(n), np.diff(w.first))
    for j in range(len(langs)):
        total[:, j] = np.bincount(row, each[back, j], minlength=n)
    best = total.argmax(axis=1)
    share = 1 / np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -700)).sum(axis=1)
    letters = [has_letter(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return [langs[b] if ok else "und" for b, ok in zip(best, letters, strict=True)], np.where(letters, share, 0.0)


def _classified(model_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of.value
        known = KnownWords(len(model.langs))
        for batch in batches:
            names, scores = [], []
            for c in text_chunks(batch.column("__text")):
                lang, score = classify(model, c.data, c.offsets, known)
                names += lang
                scores.append(score)
            keep = [i for i, c in enumerate(batch.schema.names) if c != "__text"]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                                             names=[batch.schema.names[i] for i in keep] + ["lang_pred", "score"])
    return run


def identify(docs: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """``docs`` with held_out, lang_pred and score. One narrow pass."""
    kept = [c for c in (columns if columns is not None else docs.columns) if c not in ("lang_pred", "score", "held_out")]
    src = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").alias("__text"))
    schema = T.StructType([f for f in src.schema.fields if f.name != "__text"] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    out = src.mapInArrow(_classified(docs.sparkSession.sparkContext.broadcast(model)), schema)
    return out.select(*[F.col(f"`{c}`") for c in kept], held_out().alias("held_out"), "lang_pred", "score")
