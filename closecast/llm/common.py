"""Shared pieces of the training-data operators: whole-text chunks and vectorised word hashing.

Texts reach Python as Arrow batches. Every operator walks them in chunks of a
bounded number of bytes, so memory does not depend on the batch's texts (a
single text longer than the bound is a chunk by itself).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closecast.session import ensure_checkpoint_dir

CHUNK_BYTES = 1 << 18  # the working arrays of a chunk take about 100 times its bytes


ARROW_BYTES = "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. Long texts make large Arrow batches, so a default batch size is lowered to ARROW_BYTES."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") in ("67108864", "67108864b"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that ``checkpointed`` writes inside are deleted at the end, but for those it is told to keep.

    What leaves the block must read kept tables and inputs only.
    """
    paths: list[str] = []
    token = _SCRATCH.set(paths)
    try:
        yield paths
    finally:
        _SCRATCH.reset(token)
        for p in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_table_path(spark: SparkSession, name: str = "table", keep: bool = False) -> str:
    """A fresh place in the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    paths = _SCRATCH.get()
    if paths is not None and not keep:
        paths.append(path)
    return path


def checkpointed(df: DataFrame, keep: bool = False) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read back: lineage is cut, columns are pruned."""
    path = new_table_path(df.sparkSession, keep=keep)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class KeyFilter:
    """A bitmap of fixed size over the hashed keys of a table.

    It thins a large table before an exact join: keys outside the bitmap
    cannot be in the table. It is 2^bits bits whatever the data, so it can be
    broadcast; with more keys it lets more rows through, never fewer.
    """

    def __init__(self, keys: DataFrame, bits: int = 25):
        self.bits, self._types = bits, [f.dataType for f in keys.schema.fields]
        place = self._place(*[F.col(c) for c in keys.columns])
        parts = keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).collect()  # at most 2^bits / 8 bytes
        bitmap = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for r in parts:
            own = np.frombuffer(bytes(r["m"]), dtype=np.uint8)
            at = (r["b"] - 1) * len(own)
            bitmap[at:at + len(own)] = own
        self._bitmap = keys.sparkSession.sparkContext.broadcast(np.packbits(np.unpackbits(bitmap, bitorder="little")))

    def _place(self, *cols):
        same = [c.cast(t) for c, t in zip(cols, self._types, strict=True)]  # the hash depends on the type
        return F.pmod(F.xxhash64(*same), F.lit(1 << self.bits)) + 1

    def split(self, df: DataFrame, *cols: str, only: bool | None = None) -> DataFrame:
        """``df`` with a boolean ``maybe``: False where the key is surely not in the table. ``only``: just the rows of that value."""
        bitmap = self._bitmap

        def run(batches):
            got = bitmap.value
            for batch in batches:
                p = np.asarray(batch.column("__place")) - 1
                maybe = (got[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 > 0
                if only is not None:
                    batch, maybe = batch.filter(pa.array(maybe == only)), maybe[maybe == only]
                keep = [i for i, c in enumerate(batch.schema.names) if c != "__place"]
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(maybe)], names=[batch.schema.names[i] for i in keep] + ["maybe"])

        src = df.withColumn("__place", self._place(*[F.col(c) for c in cols]))
        return src.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("maybe", T.BooleanType())]))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Chunk(NamedTuple):
    lo: int  # first row of the batch
    hi: int
    data: bytes  # the rows' UTF-8 bytes, concatenated (null: empty)
    offsets: np.ndarray  # hi - lo + 1 byte offsets into ``data``


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The rows of a string or binary Arrow column, ``limit`` bytes at a time."""
    arr = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    n = len(arr)
    if n == 0:
        return
    if arr.null_count:
        arr = arr.fill_null(b"")
    _, off_buf, data_buf = arr.buffers()
    offsets = np.frombuffer(off_buf, dtype=np.int64)[arr.offset:arr.offset + n + 1]
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        a, b = int(offsets[lo]), int(offsets[hi])
        yield Chunk(lo, hi, data_buf[a:b].to_pybytes() if b > a else b"", offsets[lo:hi + 1] - a)
        lo = hi


def _word_tables() -> tuple[np.ndarray, bytes]:
    is_word = np.zeros(256, dtype=bool)
    is_word[0x30:0x3A] = is_word[0x41:0x5B] = is_word[0x61:0x7B] = is_word[0x80:] = True
    fold = bytearray(b" " * 256)
    for c in range(256):
        if is_word[c]:
            fold[c] = c + 32 if 0x41 <= c <= 0x5A else c
    return is_word, bytes(fold)


#: Word bytes are ASCII letters and digits and every byte of a non-ASCII character.
IS_WORD, FOLD = _word_tables()
_WORD_FLAGS = IS_WORD.astype(np.uint8).tobytes()


def words(data: bytes) -> list[bytes]:
    """Words of UTF-8 bytes: A-Z lower-cased, runs of word bytes."""
    return data.translate(FOLD).split()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (an invertible mixer)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FOLDED_VALUE = BYTE_VALUE[np.frombuffer(FOLD, dtype=np.uint8)]
_BASE = 0x5851F42D4C957F2D


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, dtype=np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Words(NamedTuple):
    start: np.ndarray  # byte offset of each word in the chunk
    end: np.ndarray
    hash: np.ndarray  # 64-bit hash of the lower-cased word
    first: np.ndarray  # row r's words are first[r]:first[r + 1]


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray = _FOLDED_VALUE) -> np.ndarray:
    """64-bit hashes of the byte spans ``start:end`` of ``buf`` (folded to lower case by default)."""
    n = len(buf)
    size = 1 << max(18, int(n).bit_length())
    up, down = _powers(size)
    total = np.zeros(n + 1, dtype=np.uint64)
    terms = np.take(values, buf)
    terms *= up[:n]
    np.cumsum(terms, out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def chunk_words(data: bytes, cuts: np.ndarray) -> Words:
    """Words of a chunk; no word crosses one of the byte offsets ``cuts`` (its rows' or lines' borders)."""
    buf = np.frombuffer(data, dtype=np.uint8)
    n = len(buf)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, np.zeros(0, dtype=np.uint64), np.zeros(len(cuts), dtype=np.int64))
    word = np.frombuffer(data.translate(_WORD_FLAGS), dtype=bool)
    inner = cuts[(cuts > 0) & (cuts < n)]
    split = np.unique(inner[word[inner] & word[inner - 1]])  # one word ends here and the next begins
    edges = np.concatenate([np.flatnonzero(word[:1]), np.flatnonzero(word[1:] != word[:-1]) + 1, split, split, [n] * int(word[-1])]).astype(np.int64)
    if len(split):
        edges.sort()
    start, end = edges[::2].copy(), edges[1::2].copy()
    return Words(start, end, span_hashes(buf, start, end), np.searchsorted(start, cuts))


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the longs Spark holds."""
    return x.view(np.int64)


def has_rows(df: DataFrame) -> bool:
    return bool(df.select(F.lit(1)).take(1))
