"""Benchmark decontamination with one Aho-Corasick automaton over item windows.

Items are normalised to words (A-Z lower-cased, runs of ASCII letters, digits
and non-ASCII characters). A window is ``width`` consecutive words of an item;
an item with fewer words, but some, is one window. The automaton runs over
word numbers, so a text is scanned once and each match gives word positions,
which map to byte offsets of the original text.

The item table is read in shards of bounded size (``max_shard_words``), one
automaton each: one shard for any usual benchmark, more automata, never a cut
of the items, for a larger one. Each shard's windows are broadcast, so the
bound on a shard bounds the broadcast.

Defined cases: a null or wordless text has no words, no hits and no items; a
null item text has no windows; an item without an id marks hits but is not
counted as an item; repeated rows of either table give the same answer for
each row; rows with a null ``doc_id`` are kept. Other columns pass through
unless ``columns`` says otherwise; the result columns are appended and replace
columns of the same name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closecast.llm.common import text_chunks, words

WIDTH = 10
MAX_SHARD_WORDS = 2_000_000
_STATE = "__found"
_FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.LongType())),  # hit word positions, as start, end, start, end ...
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.LongType())),  # their byte offsets in the text: start, end, ...
])
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def item_windows(text: str | None, width: int = WIDTH) -> list[tuple[bytes, ...]]:
    w = words((text or "").encode())
    if not w:
        return []
    return [tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))]


def _shards(benchmark: DataFrame, width: int, max_words: int) -> Iterator[dict[tuple[bytes, ...], set[str]]]:
    """Window -> item ids, shard by shard; the driver holds one shard at a time."""
    windows: dict[tuple[bytes, ...], set[str]] = {}
    size = 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").toLocalIterator(prefetchPartitions=False)
    for r in rows:
        own = item_windows(r["text"], width)
        if size and size + len(own) > max_words:
            yield windows
            windows, size = {}, 0
        for w in own:
            windows.setdefault(w, set()).update([r["item_id"]] if r["item_id"] is not None else [])
        size += len(own)
    yield windows


class _Scanner:
    """Scans texts for the windows of one shard."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]]):
        self.ids: dict[bytes, int] = {}
        self.items = list(windows.values())
        self.lengths = [len(w) for w in windows]
        self.auto = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for k, w in enumerate(windows):
            self.auto.add_word(tuple(self.ids.setdefault(x, len(self.ids) + 1) for x in w), k)
        self.auto.make_automaton()

    def scan(self, data: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        w = words(data)
        if not self.items:
            return len(w), [], set()
        hits, items = [], set()
        for end, k in self.auto.iter(tuple(map(self.ids.get, w, repeat(0)))):
            hits.append((end + 1 - self.lengths[k], end + 1))
            items |= self.items[k]
        return len(w), merged(hits), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans as sorted, disjoint, non-touching spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _byte_spans(data: bytes, hits: list[tuple[int, int]]) -> list[int]:
    at = [m.span() for m in _WORD.finditer(data)]
    return [x for a, b in hits for x in (at[a][0], at[b - 1][1])]


def _scan_with(shard, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(shard.value)
        found_type = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.int64())), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.int64()))])
        for batch in batches:
            names = batch.schema.names
            before = None if first else batch.column(names.index(_STATE)).to_pylist()
            out = []
            for chunk in text_chunks(batch.column(names.index("text"))):
                for r in range(chunk.hi - chunk.lo):
                    data = chunk.data[chunk.offsets[r]:chunk.offsets[r + 1]]
                    n, hits, items = scanner.scan(data)
                    if before is not None:
                        old = before[chunk.lo + r]
                        items |= set(old["items"])
                        hits = merged(hits + list(zip(old["hits"][::2], old["hits"][1::2], strict=True)))
                    out.append({"n_words": n, "hits": [x for s in hits for x in s], "items": sorted(items), "spans": _byte_spans(data, hits) if hits else []})
            keep = [i for i, c in enumerate(names) if c != _STATE]
            found = pa.array(out, type=found_type)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [found], names=[names[i] for i in keep] + [_STATE])
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, max_shard_words: int = MAX_SHARD_WORDS,
                  columns: list[str] | None = None) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, item_ids, items_sha256, contaminated and hit_spans.

    ``hit_spans`` holds the byte offsets ``{start, end}`` of the hit runs in the
    UTF-8 bytes of the original text. One narrow pass, no shuffle.
    """
    spark = docs.sparkSession
    ours = ["n_words", "n_hit", "n_items", "item_ids", "items_sha256", "contaminated", "hit_spans"]
    kept = [c for c in (columns if columns is not None else docs.columns) if c not in ours]
    out = docs.select(*{c: F.col(f"`{c}`") for c in [*kept, "text"]}.values())
    for k, shard in enumerate(_shards(benchmark, width, max_shard_words)):
        schema = T.StructType([f for f in out.schema.fields if f.name != _STATE] + [T.StructField(_STATE, _FOUND)])
        out = out.mapInArrow(_scan_with(spark.sparkContext.broadcast(shard), k == 0), schema)
    f = F.col(_STATE)
    n_hit = F.aggregate(F.transform(f["hits"], lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x)
    spans = F.filter(F.transform(f["spans"], lambda x, i: F.when(i % 2 == 0, F.struct(x.alias("start"), F.element_at(f["spans"], (i + 2).cast("int")).alias("end")))), lambda s: s.isNotNull())
    return out.select(
        *[F.col(f"`{c}`") for c in kept],
        f["n_words"].alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(f["items"]).cast("long").alias("n_items"),
        f["items"].alias("item_ids"),
        F.sha2(F.concat_ws(",", f["items"]), 256).alias("items_sha256"),
        (F.size(f["hits"]) > 0).alias("contaminated"),
        spans.alias("hit_spans"),
    )
