"""Product codes of vectors by ball k-means.

Vectors become integers (``intvec``) and are cut into ``PARTS`` equal parts;
each part position has a codebook of ``ENTRIES`` entries. Every round deals
each part to its nearest entry, exactly, and moves the entries to the mean
(floored) of their parts. All distances are integers.

An assignment starts from the previous one. Of one entry's ball (the parts it
holds, in one block of rows), with D the distances between entries and d those
of the parts to their own entry:

* the ball's radius r names its neighbours: entries with D <= 2 r; no other
  entry can win a part of the ball;
* a ball whose entry and neighbours did not move in the last round keeps its
  parts (no distance is computed beyond d);
* the stable core, parts with 2 d < D of the nearest neighbour, stays;
* in the rings around it a part is compared only with the neighbours with
  D <= 2 d, the nearest ones: rings are taken together while their number of
  neighbours doubles.

The comparisons are of squares (D^2 <= 4 d^2) and keep equality, so ties go to
the smaller index exactly.

The rows travel in blocks of bounded bytes, written once per round with their
codes and with the block's sums per entry; the next codebook reads only the
sums. Codebooks have a fixed size (ENTRIES x dimension integers), whatever the
data; they are all that reaches the driver.

Defined cases: a row whose vector is null or holds a null or non-finite
component takes no part; rows with equal ids each take part; the starting
entries are those of the smallest ids, ties by the vector's bytes, null ids
last; with fewer rows than ``ENTRIES`` there are as many entries as rows; only
rows of the commonest dimension (ties: the smaller) take part, and a dimension
that is no multiple of ``PARTS`` is filled up with zeros; an empty table gives
no rows; extra columns are not read. Sums of errors stop at the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closecast.llm.common import checkpointed, scratch_tables
from closecast.llm.intvec import integer_vectors

PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK_BYTES = 1 << 20
_EXACT = float(1 << 53)
_MAX = np.iinfo(np.int64).max
_SALTS = 16
_BLOCK = "n int, ids binary, no_id binary, labels binary, no_label binary, vecs binary, codes binary, error binary, counts binary, sums binary"


class Model(NamedTuple):
    codebooks: np.ndarray  # parts x entries x components, int64

    def entries(self) -> int:
        return self.codebooks.shape[1]

    def sha256(self) -> str:
        """Of all components as decimal text, by part, entry, position."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def square_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of two integer matrices."""
    if not len(x) or not len(y) or not x.shape[1]:
        return np.zeros((len(x), len(y)), dtype=np.int64)
    top = float(max(np.abs(x).max(), np.abs(y).max()))
    if 4 * top * top * x.shape[1] < _EXACT:  # every sum below stays an exact double
        a, b = x.astype(np.float64), y.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(axis=1) for e in y], axis=1)


def own_distances(x: np.ndarray, entries: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return ((x - entries[codes]) ** 2).sum(axis=1)


def nearest_of_all(x: np.ndarray, entries: np.ndarray, step: int = 2048) -> np.ndarray:
    """Index of each row's nearest entry; ties to the smaller index."""
    return np.concatenate([square_distances(x[at:at + step], entries).argmin(axis=1) for at in range(0, len(x), step)] or [np.zeros(0, dtype=np.int64)])


class Balls:
    """One part's codebook: distances between entries, each entry's neighbours nearest first, and what moved."""

    def __init__(self, entries: np.ndarray, before: np.ndarray):
        self.entries = entries
        between = square_distances(entries, entries)
        self.order = np.argsort(between, axis=1, kind="stable")
        self.between = np.take_along_axis(between, self.order, axis=1)
        self.moved = (entries != before).any(axis=1)

    def assign(self, x: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(new codes, squared distances, how many distances were computed) from the previous codes."""
        d = own_distances(x, self.entries, codes)
        new, best, work = codes.copy(), d.copy(), len(x)
        by_ball = np.argsort(codes, kind="stable")
        starts = np.searchsorted(codes[by_ball], np.arange(len(self.entries) + 1))
        for i in range(len(self.entries)):
            ball = by_ball[starts[i]:starts[i + 1]]
            if not len(ball):
                continue
            reach = 4 * d[ball]
            neighbours = int(np.searchsorted(self.between[i], reach.max(), "right"))  # with the entry itself
            if neighbours == 1 or not self.moved[self.order[i, :neighbours]].any():
                continue
            rings = np.searchsorted(self.between[i], reach, "right")
            outer = np.flatnonzero(rings > 1)  # the rest is the stable core
            outer = outer[np.argsort(rings[outer], kind="stable")]
            at = 0
            while at < len(outer):
                widest = min(2 * int(rings[outer[at]]), neighbours)
                end = int(np.searchsorted(rings[outer], widest, "right"))
                rows, near = ball[outer[at:end]], self.order[i, :int(rings[outer[end - 1]])]
                dist = square_distances(x[rows], self.entries[near])
                least = dist.min(axis=1)
                new[rows] = np.where(dist == least[:, None], near[None, :], len(self.entries)).min(axis=1)
                best[rows] = least
                work += dist.size
                at = end
        return new, best, work


def _bytes(*arrays: np.ndarray) -> list[pa.Array]:
    return [pa.array([np.ascontiguousarray(y).tobytes()], pa.binary()) for y in arrays]


def _packer(width: int):
    """Rows of a batch as blocks, without codes yet. ``width`` is the dimension filled up to the parts."""
    step = max(1, BLOCK_BYTES // (4 * max(1, width)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                n, dim = b.num_rows, b.column("dim")[0].as_py()
                vecs = np.zeros((n, width), dtype=np.int32)
                vecs[:, :dim] = np.frombuffer(b"".join(b.column("v").to_pylist()), dtype=np.int32).reshape(n, dim)
                ids, labels = b.column("vec_id"), b.column("label")
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), *_bytes(
                    ids.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(ids.is_null()), labels.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(labels.is_null()), vecs)],
                    names=["n", "ids", "no_id", "labels", "no_label", "vecs"])
    return run


def _assigner(model: Model, before: Model | None):
    """Blocks with the codes of ``model``, from the codes of ``before`` that they hold, and their sums per entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, size = model.codebooks.shape
        balls = [Balls(model.codebooks[p], before.codebooks[p]) for p in range(parts)] if before else None
        for batch in batches:
            for r in range(batch.num_rows):
                n = batch.column("n")[r].as_py()
                vecs = np.frombuffer(batch.column("vecs")[r].as_buffer(), dtype=np.int32).reshape(n, parts, size)
                old = np.frombuffer(batch.column("codes")[r].as_buffer(), dtype=np.int16).reshape(n, parts) if before else None
                codes, error = np.empty((n, parts), dtype=np.int16), np.zeros(n, dtype=np.int64)
                counts, sums = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries, size), dtype=np.int64)
                for p in range(parts):
                    x = vecs[:, p].astype(np.int64)
                    if balls:
                        own, dist, _ = balls[p].assign(x, old[:, p].astype(np.int64))
                    else:
                        own = nearest_of_all(x, model.codebooks[p])
                        dist = own_distances(x, model.codebooks[p], own)
                    codes[:, p] = own
                    error += dist
                    counts[p] = np.bincount(own, minlength=entries)
                    order = np.argsort(own, kind="stable")
                    held = np.flatnonzero(counts[p])
                    if size:
                        sums[p, held] = np.add.reduceat(x[order], np.concatenate([[0], np.cumsum(counts[p, held])[:-1]]).astype(np.int64), axis=0)
                same = [c for c in ("n", "ids", "no_id", "labels", "no_label", "vecs")]
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(r, 1) for c in same], *_bytes(codes, error, counts, sums)], names=[*same, "codes", "error", "counts", "sums"])
    return run


def _moved(blocks: DataFrame, model: Model) -> Model:
    """The entries at the floored means of their parts; unused entries stay."""
    parts, entries, size = model.codebooks.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(parts * entries, dtype=np.int64), np.zeros((parts * entries, size), dtype=np.int64)
        for batch in batches:
            for c, s in zip(batch.column("counts"), batch.column("sums"), strict=True):
                counts += np.frombuffer(c.as_buffer(), dtype=np.int64)
                sums += np.frombuffer(s.as_buffer(), dtype=np.int64).reshape(sums.shape)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held]), pa.array(list(sums[held]), pa.list_(pa.int64()))], names=["entry", "n", "sums"])

    # a row per entry and task, then entries x components numbers in all
    per_task = blocks.select("counts", "sums").mapInArrow(totals, "entry long, n long, sums array<long>")
    added = per_task.groupBy("entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(j))).alias(f"s{j}") for j in range(size)])
    new = model.codebooks.reshape(parts * entries, size).copy()
    for row in added.collect():  # at most parts x entries rows
        new[row["entry"]] = [row[f"s{j}"] // row["n"] for j in range(size)]
    return Model(new.reshape(parts, entries, size))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(batch.num_rows):
            n = batch.column("n")[r].as_py()
            get = lambda c, t: np.frombuffer(batch.column(c)[r].as_buffer(), dtype=t)
            codes = get("codes", np.int16).reshape(n, -1)
            text = np.char.mod("%02x", codes) if n else codes.astype("U2")
            joined = ["".join(c) for c in text.tolist()]
            yield pa.RecordBatch.from_arrays([
                pa.array(get("ids", np.int64), mask=get("no_id", np.bool_)), pa.array(get("labels", np.int64), mask=get("no_label", np.bool_)),
                pa.array(joined, pa.string()), pa.array(get("error", np.int64))], names=["vec_id", "label", "code", "error"])


def starting_model(vectors: DataFrame, dim: int) -> Model:
    """The parts of the vectors with the smallest ids."""
    width = -(-dim // PARTS) * PARTS
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()  # at most ENTRIES rows
    whole = np.zeros((len(first), width), dtype=np.int64)
    for k, row in enumerate(first):
        whole[k, :dim] = np.frombuffer(bytes(row["v"]), dtype=np.int32)
    return Model(np.ascontiguousarray(whole.reshape(len(first), PARTS, width // PARTS).transpose(1, 0, 2)))


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Model | None]:
    """(vec_id, label, code, error) of every usable vector of columns vec_id, embedding and label, and the codebooks (None without vectors)."""
    spark = vectors.sparkSession
    result = "vec_id long, label long, code string, error long"
    with scratch_tables(spark):
        src = checkpointed(integer_vectors(vectors, vec_id=F.col("vec_id").cast("long"), label=F.col("label").cast("long")).drop("norm"))
        dims = src.groupBy("dim").count().orderBy(F.desc("count"), "dim").take(1)
        if not dims:
            return spark.createDataFrame([], result), None
        dim = dims[0]["dim"]
        src = src.where(F.col("dim") == dim)
        model, before = starting_model(src, dim), None
        width = model.codebooks.shape[0] * model.codebooks.shape[2]
        plain = "n int, ids binary, no_id binary, labels binary, no_label binary, vecs binary"
        blocks = src.mapInArrow(_packer(width), plain)
        for _ in range(rounds):
            blocks = checkpointed(blocks.mapInArrow(_assigner(model, before), _BLOCK))
            before, model = model, _moved(blocks, model)
        last = blocks.mapInArrow(_assigner(model, before), _BLOCK)
        return checkpointed(last.select("n", "ids", "no_id", "labels", "no_label", "codes", "error").mapInArrow(_unpacked, result), keep=True), model


def label_errors(coded: DataFrame) -> DataFrame:
    """(label, label_error): the error summed over equal labels, nulls together."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    return coded.groupBy("label").agg(F.least(total, F.lit(int(_MAX)).cast("decimal(38,0)")).cast("long").alias("label_error"))


def vector_codes(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector."""
    coded, model = compress(vectors, rounds)
    # a label may hold a third of the rows: its sum is repeated for a few salts, so that its rows meet it in several tasks
    sums = label_errors(coded).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(_SALTS)).cast("int")).alias("c")
    both = salted.join(sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")) & (F.col("c.salt") == F.col("s.salt")))
    return both.select("c.vec_id", "c.code", "c.error", "s.label_error", F.lit(model.sha256() if model else "").alias("codebooks_sha256"))
