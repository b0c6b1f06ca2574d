"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every whole text is turned into ``FEATURES`` (shares of character classes,
word, line and repetition statistics), computed chunk by chunk with numpy
inside Spark tasks. The trees are fitted on the driver on a hash sample of the
labelled rows whose expected size is bounded by ``max_train_rows`` (rows x 24
numbers), flattened into heap-ordered arrays and broadcast; every text is then
scored by vectorised traversal, one level of one tree at a time.

Defined cases: a null text counts as an empty one (all features 0) and is
scored; labels with a null id, a null quality, or no document teach nothing;
several labels of one document all count; without any usable label every score
is 0.5; repeated rows get equal scores; a null ``doc_id`` is not held out.
Columns of the input pass through; result columns replace equal names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closecast.llm.common import BYTE_VALUE, chunk_words, mix, span_hashes, text_chunks

MAX_TRAIN_ROWS = 20_000
KEEP_AT = 0.3
FEATURES = [
    "log_bytes", "upper", "lower", "digit", "white", "non_ascii", "stop", "other_mark", "control", "pipe_bang",
    "log_words", "word_len", "long_words", "short_words", "distinct_words", "top_word", "word_bytes",
    "log_lines", "line_len", "distinct_lines", "empty_lines", "distinct_pairs", "runs", "word_len_spread",
]


def _classes() -> np.ndarray:
    c = np.full(256, 6, dtype=np.uint8)  # other marks
    c[ord("A"):ord("Z") + 1] = 0
    c[ord("a"):ord("z") + 1] = 1
    c[ord("0"):ord("9") + 1] = 2
    c[[9, 10, 13, 32]] = 3
    c[128:] = 4
    c[[ord(x) for x in ".,;:'\"()-?"]] = 5
    c[:9] = c[11:13] = c[14:32] = 7
    c[127] = 7
    c[[ord("|"), ord("!")]] = 8
    return c


_CLASS = _classes()


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[r]:first[r + 1]]`` (empty rows: 0)."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def _distinct(keys: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: distinct keys, and the count of the most frequent one."""
    if len(keys) == 0:
        return np.zeros(n), np.zeros(n)
    salted = mix(keys ^ mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(salted)
    s, r = salted[order], row[order]
    head = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    count = np.diff(np.append(head, len(s)))
    top = np.zeros(n)
    np.maximum.at(top, r[head], count)
    return np.bincount(r[head], minlength=n).astype(float), top


def statistics(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text of a chunk."""
    n = len(offsets) - 1
    buf = np.frombuffer(data, dtype=np.uint8)
    size = np.diff(offsets).astype(float)
    kinds = _CLASS[buf]
    share = [_ratio(_sums(kinds == k, offsets), size) for k in range(9)]
    same = np.zeros(len(buf), dtype=bool)
    same[1:] = buf[1:] == buf[:-1]

    w = chunk_words(data, offsets)
    n_words = np.diff(w.first).astype(float)
    row = np.repeat(np.arange(n), np.diff(w.first))
    length = (w.end - w.start).astype(float)
    mean_len = _ratio(_sums(length, w.first), n_words)
    spread = np.sqrt(np.maximum(_ratio(_sums(length * length, w.first), n_words) - mean_len ** 2, 0))
    distinct, top = _distinct(w.hash, row, n)
    inner = row[1:] == row[:-1]
    pairs, _ = _distinct(mix(w.hash[:-1] * np.uint64(0x9E3779B97F4A7C15) + w.hash[1:])[inner], row[1:][inner], n)

    breaks = np.flatnonzero(buf == 10)
    starts = np.union1d(offsets[:-1][size > 0], breaks + 1)
    starts = starts[starts < len(buf)]
    owner = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.minimum(np.append(starts[1:], len(buf)), offsets[owner + 1])
    ends = np.where((ends > starts) & (buf[np.maximum(ends, 1) - 1] == 10), ends - 1, ends) if len(starts) else ends
    n_lines = np.bincount(owner, minlength=n).astype(float)
    lines, _ = _distinct(span_hashes(buf, starts, ends, BYTE_VALUE), owner, n) if len(starts) else (np.zeros(n), None)
    empty = np.bincount(owner[ends == starts], minlength=n).astype(float)

    return np.stack([
        np.log1p(size), *share,
        np.log1p(n_words), mean_len, _ratio(_sums(length > 12, w.first), n_words), _ratio(_sums(length < 3, w.first), n_words),
        _ratio(distinct, n_words), _ratio(top, n_words), _ratio(_sums(length, w.first), size),
        np.log1p(n_lines), np.log1p(_ratio(size, n_lines)), _ratio(lines, n_lines), _ratio(empty, n_lines),
        _ratio(pairs, n_words - 1), _ratio(_sums(same, offsets), size), spread,
    ], axis=1)


class Trees(NamedTuple):
    """Heap-ordered trees of one depth: node i's children are 2i + 1 and 2i + 2; value <= threshold goes left."""
    base: float
    feature: np.ndarray  # trees x (2^depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2^depth


def predict(trees: Trees, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each row of ``x``."""
    total = np.full(len(x), trees.base)
    rows = np.arange(len(x))
    inner = trees.feature.shape[1] if trees.feature.size else 0
    for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
        node = np.zeros(len(x), dtype=np.int64)
        while len(node) and node[0] < inner:
            node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
        total += leaf[node - inner]
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 2.0,
        least: float = 4.0) -> Trees:
    """Gradient boosting of the logistic loss on feature histograms."""
    none = np.zeros((0, 2 ** depth - 1))
    if len(y) == 0:
        return Trees(0.0, none.astype(np.int64), none, np.zeros((0, 2 ** depth)))
    p = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(p / (1 - p)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    features, thresholds, leaves = [], [], []
    score = np.full(len(y), base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(2 ** depth - 1, dtype=np.int64), np.full(2 ** depth - 1, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            local = node - first
            best = np.zeros(width)
            cut = np.zeros(width, dtype=np.int64)
            for j in range(x.shape[1]):
                if len(edges[j]) == 0:
                    continue
                at = local * bins + binned[:, j]
                gs = np.cumsum(np.bincount(at, g, width * bins).reshape(width, bins), axis=1)
                hs = np.cumsum(np.bincount(at, h, width * bins).reshape(width, bins), axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt ** 2 / (ht + ridge)
                gain[(hs < least) | (ht - hs < least)] = 0
                gain[:, len(edges[j]):] = 0
                k = gain.argmax(axis=1)
                better = gain[np.arange(width), k] > best + 1e-9
                best = np.where(better, gain[np.arange(width), k], best)
                cut = np.where(better, k, cut)
                feature[first:first + width][better] = j
                threshold[first:first + width][better] = edges[j][k[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        node -= 2 ** depth - 1
        leaf = rate * np.bincount(node, g, 2 ** depth) / (np.bincount(node, h, 2 ** depth) + ridge)
        score += leaf[node]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(thresholds), np.array(leaves))


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for c in text_chunks(batch.column("text")):
            x = statistics(c.data, c.offsets)
            rows = batch.slice(c.lo, c.hi - c.lo)
            x = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([rows.column("quality"), x], names=["quality", "x"])


def held_out(folds: int, fold: int) -> Column:
    """True where crc32 of the id's text leaves the given remainder; null ids are not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> Trees:
    """Trees fitted on a hash sample of the labelled documents that are not held out (fold 0 of 5)."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(5, 0)).select("doc_id", F.col("quality").cast("long").alias("quality"))
    n = usable.count()
    if n > max_train_rows:
        usable = usable.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) < int((1 << 30) * max_train_rows / n))
    # about max_train_rows ids at most, whatever the size of the corpus
    sample = docs.select("doc_id", "text").join(F.broadcast(usable), "doc_id").select("quality", "text")
    got = sample.mapInArrow(_features_of, "quality long, x array<double>").toArrow()
    x = np.array(got.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    y = (np.array(got.column("quality").to_pylist(), dtype=float) > 0).astype(float)
    order = np.lexsort([y, *x.T])  # rows arrive in any order; the fit must not depend on it
    return fit(x[order], y[order])


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = model.value
        for batch in batches:
            score = [predict(trees, statistics(c.data, c.offsets)) for c in text_chunks(batch.column("__text"))]
            keep = [i for i, c in enumerate(batch.schema.names) if c != "__text"]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(np.concatenate(score) if score else [], pa.float64())],
                                             names=[batch.schema.names[i] for i in keep] + ["score"])
    return run


def score_quality(docs: DataFrame, trees: Trees, columns: list[str] | None = None, keep_at: float = KEEP_AT) -> DataFrame:
    """``docs`` with held_out, score (0 to 1) and predicted (1 where score >= keep_at). One narrow pass."""
    spark = docs.sparkSession
    kept = [c for c in (columns if columns is not None else docs.columns) if c not in ("score", "predicted", "held_out")]
    src = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").alias("__text"))
    schema = T.StructType([f for f in src.schema.fields if f.name != "__text"] + [T.StructField("score", T.DoubleType())])
    out = src.mapInArrow(_scored(spark.sparkContext.broadcast(trees)), schema)
    return out.select(*[F.col(f"`{c}`") for c in kept], held_out(5, 0).alias("held_out"), "score",
                      (F.col("score") >= keep_at).cast("int").alias("predicted"))
