"""Removal of bytes covered by long strings that also start elsewhere, by difference-cover sampling.

Every text is its UTF-8 bytes; a string of ``length`` bytes that starts at two
places of the corpus (one document or two) is repeated, and each byte that a
repeated string covers goes. Nothing is judged on what is left.

Sorting one row per suffix of a corpus moves many times its bytes, so the
suffixes are taken in stages, as difference-cover construction does:

1. Cover sample. D is a difference cover modulo v: for any two places i and j
   some shift s < v puts both i + s and j + s into the sample (places whose
   offset in their document is in D modulo v). With v = q^2 + q + 1 the cover has
   q + 1 members, so for 200 bytes (v = 57) 14 % of the places are sampled. Each
   sampled suffix is ranked by its first w = length - v + 1 bytes: a bucket (a
   range of a 64-bit key of those bytes) is sorted at a time, and a suffix
   whose rank it shares with no other is unique.
2. Ties by cover ranks. If the strings at i and j are equal, the sampled
   suffixes at i + s and j + s share a rank. So only places with a tied
   sample within the next v can be repeated; the rest are resolved.
3. The places left are bucketed by the key of their whole ``length`` bytes, one bucket
   sorted at a time; equal keys are repeated strings.

Suffixes travel as packed arrays of keys, one row per chunk of texts and
bucket, and the answer comes back as one bit each. A key occurs once per chunk
however often the chunk holds it, so a bucket takes at most one key per chunk
from the hottest string. Buckets are sized by the corpus' bytes. Texts are
packed once (zstd) into a table bucketed by chunk in the shared folder: later
stages bring the answers to the texts, never the texts to the answers.

Keys of step 1 keep 40 bits beyond their bucket (a collision there only leaves a
place for step 3), keys of step 3 all 64.

Defined cases: a null text counts as empty; texts shorter than ``length`` lose
nothing; rows with equal texts (repeated rows too) remove each other's bytes;
null ids are kept; other columns are not carried.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closecast.llm.common import BYTE_VALUE, checkpointed, mix, shuffle_partitions, text_chunks
from closecast.session import ensure_checkpoint_dir

LENGTH = 200
PACK_BYTES = 4 << 20
BLOCK_BYTES = 1 << 15
SAMPLE_KEY, WHOLE_KEY = 5, 8  # bytes of a key beyond its bucket
BUCKET_BYTES = 16 << 20  # corpus bytes for each bucket of keys
_M1, _M2 = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)
_CHUNK = "chunk long, ids array<long>, sizes array<int>, z binary, n_bytes long"
_KEYS = "bucket int, chunk long, keys binary"
_BITS = "bucket int, chunk long, bits binary"


@lru_cache(maxsize=8)
def difference_cover(length: int) -> tuple[int, tuple[int, ...]]:
    """(v, D): the largest plane difference cover modulo v = q^2 + q + 1 with v <= 1/3 ``length``; (1, (0,)) if none.

    Members are the powers of a generator of the cubic extension of the field
    of q elements that have no square term (Singer's construction).
    """
    fits = [q for q in range(2, length) if all(q % d for d in range(2, q)) and 3 * (q * q + q + 1) <= length]
    if not fits:
        return 1, (0,)
    q = fits[-1]
    v = q * q + q + 1
    for a, b, c in product(range(q), repeat=3):
        x, cover = (0, 0, 1), []  # coefficients of square, linear and constant term
        for i in range(v):
            if x[0] == 0:
                cover.append(i)
            top = x[0]
            x = ((x[1] + top * a) % q, (x[2] + top * b) % q, top * c % q)
        if len(cover) == q + 1 and len({(s - t) % v for s in cover for t in cover}) == v:
            return v, tuple(cover)
    raise AssertionError("a generator exists for every prime")


def _window_keys(buf: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """64-bit keys of the ``width`` bytes at each of ``places``, by doubling."""
    h, span = BYTE_VALUE[buf], 1
    while span * 2 <= width:
        a, b = h[:-span], h[span:]
        h = a * _M1
        h += (b ^ (b >> np.uint64(31))) * _M2
        span *= 2
    h = h ^ (h >> np.uint64(32))
    return mix(h[places] * _M1 + mix(h[places + width - span]))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in compressed chunks of about PACK_BYTES."""
    part, number = TaskContext.get().partitionId(), 0
    press = zstandard.ZstdCompressor(level=1)
    ids: list = []
    sizes: list[int] = []
    data: list[bytes] = []

    def flush():
        nonlocal number
        whole = b"".join(data)
        out = pa.RecordBatch.from_arrays([
            pa.array([part << 32 | number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
            pa.array([press.compress(whole)], pa.binary()), pa.array([len(whole)], pa.int64())], names=["chunk", "ids", "sizes", "z", "n_bytes"])
        number += 1
        ids.clear(), sizes.clear(), data.clear()
        return out

    for batch in batches:
        doc = batch.column("doc_id")
        for c in text_chunks(batch.column("text")):
            ids += doc.slice(c.lo, c.hi - c.lo).to_pylist()
            sizes += np.diff(c.offsets).tolist()
            data.append(c.data)
            if sum(map(len, data)) >= PACK_BYTES:
                yield flush()
    if ids:
        yield flush()


class _Chunk:
    """A chunk's texts, and its sampled and doubtful places with their keys."""

    def __init__(self, row: dict, length: int):
        self.length, self.ids = length, row["ids"]
        self.data = zstandard.ZstdDecompressor().decompress(row["z"], max_output_size=max(1, row["n_bytes"])) if row["n_bytes"] else b""
        self.buf = np.frombuffer(self.data, dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(row["sizes"], dtype=np.int64)])

    def _blocks(self) -> Iterator[tuple[int, int]]:
        """Byte borders of runs of whole texts of bounded size."""
        lo, n = 0, len(self.offsets) - 1
        while lo < n:
            hi = min(max(int(np.searchsorted(self.offsets, self.offsets[lo] + BLOCK_BYTES, side="right")) - 1, lo + 1), n)
            yield int(self.offsets[lo]), int(self.offsets[hi])
            lo = hi

    def keys_at(self, places: np.ndarray, width: int) -> np.ndarray:
        out = np.empty(len(places), dtype=np.uint64)
        for a, b in self._blocks():
            i, j = np.searchsorted(places, (a, b))
            if i < j:
                out[i:j] = _window_keys(self.buf[a:b], places[i:j] - a, width)
        return out

    def sample(self) -> tuple[np.ndarray, int]:
        """Sampled places, and the width of their keys."""
        v, cover = difference_cover(self.length)
        width = self.length - v + 1
        size = np.diff(self.offsets)
        top = int(size.max(initial=0))
        pattern = (np.arange(0, top + v, v)[:, None] + np.array(cover)).ravel()
        # only texts that can hold a whole string take part
        count = np.where(size >= self.length, np.searchsorted(pattern, size - width + 1), 0)
        ends = np.cumsum(count)
        nth = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)
        return np.repeat(self.offsets[:-1], count) + pattern[nth], width

    def spread(self, places: np.ndarray, before: int, after: int) -> np.ndarray:
        """True from ``before`` bytes ahead of each place to ``after`` bytes behind it."""
        step = np.bincount(np.maximum(places - before, 0), minlength=len(self.buf) + 1)
        step -= np.bincount(np.minimum(places + after + 1, len(self.buf)), minlength=len(self.buf) + 1)
        return np.cumsum(step[:-1]) > 0

    def doubtful(self, tied: np.ndarray) -> np.ndarray:
        """Places whose next v places hold a tied sample and whose string fits their text."""
        v, _ = difference_cover(self.length)
        places = np.flatnonzero(self.spread(tied, v - 1, 0))
        return places[self.offsets[np.searchsorted(self.offsets, places, side="right")] - places >= self.length]


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _cuts(keys: np.ndarray, lg: int) -> np.ndarray:
    return np.searchsorted(keys >> np.uint64(64 - lg), np.arange((1 << lg) + 1)) if lg else np.array([0, len(keys)])


def _emit(chunk: int, unique: np.ndarray, lg: int, width: int) -> pa.RecordBatch:
    """One row of packed keys for each bucket that the chunk has keys in."""
    cuts = _cuts(unique, lg)
    full = np.flatnonzero(np.diff(cuts))
    low = (unique << np.uint64(lg)) >> np.uint64(64 - 8 * width)
    raw = np.ascontiguousarray(low.view(np.uint8).reshape(-1, 8)[:, :width])
    return pa.RecordBatch.from_arrays([
        pa.array(full.astype(np.int32)), pa.array(np.full(len(full), chunk, dtype=np.int64)),
        pa.array([raw[cuts[b]:cuts[b + 1]].tobytes() for b in full], pa.binary())], names=["bucket", "chunk", "keys"])


def _answers(found: list[dict] | None, unique: np.ndarray, lg: int) -> np.ndarray:
    """The answer bits of a chunk's unique keys."""
    cuts = _cuts(unique, lg)
    out = np.zeros(len(unique), dtype=bool)
    for f in found or ():
        a, b = cuts[f["bucket"]], cuts[f["bucket"] + 1]
        out[a:b] = np.unpackbits(np.frombuffer(f["bits"], dtype=np.uint8), count=b - a) > 0
    return out


def _tied(keys: np.ndarray, found, lg: int) -> np.ndarray:
    """Which of ``keys`` occur more than once in the corpus."""
    unique, back, count = np.unique(keys, return_inverse=True, return_counts=True)
    return ((count > 1) | _answers(found, unique, lg))[back]


def _sampled(length: int, lg: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                c = _Chunk(row, length)
                places, width = c.sample()
                if len(places):
                    yield _emit(row["chunk"], np.unique(c.keys_at(places, width)), lg, SAMPLE_KEY)
    return run


def _left(length: int, lg: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                c = _Chunk(row, length)
                places, width = c.sample()
                left = c.doubtful(places[_tied(c.keys_at(places, width), row["ranks"], lg)])
                if len(left):
                    yield _emit(row["chunk"], np.unique(c.keys_at(left, length)), lg, WHOLE_KEY)
    return run


def _bucket_answers(width: int):
    """Rows sorted by bucket: which keys of each row another row of the bucket has too. Holds one bucket at a time."""
    def answer(bucket: int, chunks: list[int], keys: list) -> pa.RecordBatch:
        each = [np.frombuffer(k, dtype=np.uint8) for k in keys]
        size = [len(k) // width for k in each]
        wide = np.zeros((sum(size), 8), dtype=np.uint8)
        wide[:, :width] = np.concatenate(each).reshape(-1, width)
        flat = wide.reshape(-1).view(np.uint64)
        order = np.argsort(flat)
        ranked = flat[order]
        same = ranked[1:] == ranked[:-1]
        again = np.zeros(len(flat), dtype=bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        bits = [np.packbits(again[e - s:e]).tobytes() for s, e in zip(size, np.cumsum(size), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([bucket] * len(chunks), pa.int32()), pa.array(chunks, pa.int64()), pa.array(bits, pa.binary())],
                                          names=["bucket", "chunk", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, chunks, keys = None, [], []
        for batch in batches:
            for b, c, k in zip(batch.column("bucket").to_pylist(), batch.column("chunk").to_pylist(), batch.column("keys"), strict=True):
                if b != bucket and chunks:
                    yield answer(bucket, chunks, keys)
                    chunks, keys = [], []
                bucket = b
                chunks.append(c)
                keys.append(k.as_buffer())
        if chunks:
            yield answer(bucket, chunks, keys)
    return run


def _removed(length: int, lg: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                c = _Chunk(row, length)
                places, width = c.sample()
                left = c.doubtful(places[_tied(c.keys_at(places, width), row["ranks"], lg)])
                starts = left[_tied(c.keys_at(left, length), row["repeats"], lg)] if len(left) else left
                gone = c.spread(starts, 0, length - 1)
                out = [[], [], [], []]
                for a, b in zip(c.offsets[:-1], c.offsets[1:], strict=True):
                    own = gone[a:b]
                    n = int(own.sum())
                    if n == 0:
                        kept, spans = c.data[a:b], []
                    else:
                        kept = c.buf[a:b][~own].tobytes()
                        edge = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                        spans = edge.tolist()
                    out[0].append(int(b - a))
                    out[1].append(n)
                    out[2].append(spans)
                    out[3].append(hashlib.sha256(kept).hexdigest())
                yield pa.RecordBatch.from_arrays([
                    pa.array(c.ids, pa.int64()), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                    pa.array([len(s) // 2 for s in out[2]], pa.int64()), pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.string())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])
    return run


def dedup_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, spans (start, end, start, end, ... in bytes) and kept_sha256."""
    spark = docs.sparkSession
    name = f"closecast_texts_{uuid.uuid4().hex}"
    parts = shuffle_partitions(spark)
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_packed, _CHUNK)
    (packed.write.option("compression", "none").option("path", f"{ensure_checkpoint_dir(spark)}/{name}").bucketBy(parts, "chunk").saveAsTable(name))
    texts = spark.table(name)
    total = texts.agg(F.sum("n_bytes")).first()[0] or 0
    lg = max(6, int(np.ceil(np.log2(total / BUCKET_BYTES + 1))))

    def answers(keys: DataFrame, width: int) -> DataFrame:
        bits = keys.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_bucket_answers(width), _BITS)
        return checkpointed(bits.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("found")))  # one bit for each key of a chunk

    def with_answers(df: DataFrame, found: DataFrame, column: str) -> DataFrame:
        return df.join(found.withColumnRenamed("found", column).hint("shuffle_hash"), "chunk", "left")

    ranks = answers(texts.mapInArrow(_sampled(length, lg), _KEYS), SAMPLE_KEY)
    ranked = with_answers(texts, ranks, "ranks")
    repeats = answers(ranked.mapInArrow(_left(length, lg), _KEYS), WHOLE_KEY)
    return with_answers(ranked, repeats, "repeats").mapInArrow(
        _removed(length, lg), "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<long>, kept_sha256 string")
