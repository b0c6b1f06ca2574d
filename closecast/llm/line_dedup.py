"""Line dedup across a corpus: an exact set-similarity join of lines.

A line (text between newlines) is the set of its words (A-Z lower-cased). A
line goes when an earlier line of the corpus, by (doc_id, tag, line number), has
Jaccard similarity ``threshold`` or more with it, whether or not that line
itself stays. The tag is xxhash64 of the whole text: it tells rows with equal
or null ids and different texts apart. The join is exact; its steps only skip what cannot match:

1. Rarity: word counts over the whole corpus in 2^18 hashed counters (a table
   of fixed size). Any fixed order of words keeps the join exact; this one
   puts rare words first.
2. Lines of the same words, as often, collapse first, in each batch and then
   in the bucket of their key: one set for each, with its earliest place. Later
   such lines (copies) go by that. They are told by 96 bits of sums over the 64-bit hashes of all their
   words, so that ten million million lines hold two unlike ones of one key
   with a chance of about one in a thousand. Lines travel as Arrow batches, a
   row for each bucket, in place of millions of rows.
3. Prefix filter: sets that overlap enough share one of their first
   n - ceil(t n) + 1 words in rarity order. Each set is posted under those.
4. In a posting group, each set looks among the earlier ones and keeps the
   earliest that passes the length, positional and bitmap filters (128 bits of
   parity: each differing bit is a differing word). So a group gives at most one pair per
   member, not all pairs. Only members whose pair fails the check, and that
   have others left, are compared with the rest in a second pass.
5. Pairs are verified on the words of the whole lines.

Word identity in steps 3 and 4 is a 44-bit number (12 bits of rarity, 32 of
hash): it only proposes pairs. In steps 2 and 5 it is a 64-bit hash. A line
with two words of one number (a chance of about 2^-32 a pair of its words) counts
one word less in the filters, so a match just at the threshold may be missed there.

Defined cases: lines without words stay; a null text stays null, an empty one
empty; a document that loses all lines keeps its row with an empty text; rows
with equal doc_id and text are the same place and are treated alike; a null
doc_id comes last. All columns of the input pass through; ``n_chars`` is
recomputed where present.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closecast.llm.common import KeyFilter, checkpointed, chunk_words, has_rows, mix, scratch_tables, shuffle_partitions, signed, text_chunks

THRESHOLD = 0.8
COUNTER_BITS = 18
FILTER_BITS = 24  # hashed words in the second pass's filter
_SLICES = 16
_LAST = (1 << 63) - 1  # a null doc_id's place in the order
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xD1B54A32D192ED03)
_ID_BITS = np.uint64(44)
_BATCH = 200_000
POSTINGS_PER_BUCKET = 200_000
WORDS_PER_BUCKET = 2_000_000  # of the texts whose lines a bucket of keys holds
LINES_AT_ONCE = 50_000
CHUNK = 1 << 17  # the working arrays of a chunk stay in a core's cache


def line_borders(data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where the lines of a chunk begin (plus its end), and each line's row."""
    buf = np.frombuffer(data, dtype=np.uint8)
    starts = np.union1d(offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(buf == 10) + 1)
    row = np.searchsorted(offsets, starts, side="right") - 1
    # a newline that ends a text opens an empty line, which has no words: its start is the next text's
    return np.append(starts[starts < len(buf)], len(buf)), row[starts < len(buf)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    held, n = [np.zeros(0, dtype=np.int64)], 0
    for batch in batches:
        for c in text_chunks(batch.column("text"), CHUNK):
            held.append((chunk_words(c.data, c.offsets).hash >> np.uint64(64 - COUNTER_BITS)).astype(np.int64))
            n += len(held[-1])
            if n >= 1 << 20:
                total += np.bincount(np.concatenate(held), minlength=len(total))
                held, n = held[:1], 0
    total += np.bincount(np.concatenate(held), minlength=len(total))
    yield _slices(np.split(total, _SLICES), range(_SLICES))


def _slices(parts: list[np.ndarray], numbers) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(numbers), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], names=["slice", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, x in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
            got = np.frombuffer(x.as_buffer(), dtype=np.int64)
            total[k] = total[k] + got if k in total else got
    yield _slices(list(total.values()), total)


def _word_counts(docs: DataFrame) -> np.ndarray:
    """The 2^COUNTER_BITS hashed word counters over all texts."""
    schema = "slice int, counts binary"
    rows = docs.select("text").mapInArrow(_counts, schema).repartition(_SLICES, "slice").mapInArrow(_summed, schema).collect()
    counts = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    each = len(counts) // _SLICES
    for r in rows:
        counts[r["slice"] * each:(r["slice"] + 1) * each] = np.frombuffer(bytes(r["counts"]), dtype=np.int64)
    return counts


def _classes(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(counts + 1.0) * 100, 4095).astype(np.uint64)


def rarity(docs: DataFrame) -> np.ndarray:
    """12-bit rarity class of each of the hashed word counters."""
    return _classes(_word_counts(docs))


def prefix_length(n: np.ndarray, threshold: float) -> np.ndarray:
    return n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1


def _line_keys(hashes: np.ndarray, first: np.ndarray, full: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits that name the words, with their numbers, of each of the lines ``full``, from 64-bit word hashes."""
    begin = first[full]  # lines without words lie between no two of these
    size = (first[full + 1] - begin).astype(np.uint64)
    key = mix(np.add.reduceat(mix(hashes * _ODD + np.uint64(1)), begin) + size)
    key2 = mix(np.add.reduceat((hashes ^ (hashes >> np.uint64(31))) * _SECOND, begin) + size) >> np.uint64(32)
    return key, key2.astype(np.uint32).view(np.int32)


def _line_sets(rarity_of, threshold: float):
    """Per line with words: its place, a key of its word set, and what the filters need."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = rarity_of.value
        for batch in batches:
            doc_column, tag_column = np.asarray(batch.column("doc")), np.asarray(batch.column("tag"))
            for c in text_chunks(batch.column("text"), CHUNK):
                borders, row = line_borders(c.data, c.offsets)
                if len(row) == 0:
                    continue
                w = chunk_words(c.data, borders)
                line = np.repeat(np.arange(len(row)), np.diff(w.first))
                # the low hash bits name a word, the high ones its counter
                rank = classes[(w.hash >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)] << np.uint64(32) | w.hash & np.uint64(0xFFFFFFFF)
                if len(row) <= 1 << 20:
                    packed = np.sort(line.astype(np.uint64) << _ID_BITS | rank)
                    line, rank = (packed >> _ID_BITS).astype(np.int64), packed & np.uint64((1 << 44) - 1)
                else:  # a long text is a chunk by itself; its lines do not fit the 20 bits
                    order = np.lexsort((rank, line))
                    line, rank = line[order], rank[order]
                new = np.concatenate([[True], (line[1:] != line[:-1]) | (rank[1:] != rank[:-1])])[:len(line)]
                line, rank = line[new], rank[new]
                first = np.searchsorted(line, np.arange(len(row) + 1))
                n = np.diff(first)
                full = np.flatnonzero(n)
                if len(full) == 0:
                    continue
                begin = first[full]
                spread = mix(rank)
                key, key2 = _line_keys(w.hash, w.first, full)
                bit = np.uint64(1) << (spread & np.uint64(63))
                half = (spread >> np.uint64(6)) & np.uint64(1) > 0
                sig, sig2 = (np.bitwise_xor.reduceat(np.where(side, bit, np.uint64(0)), begin) for side in (half, ~half))
                p = prefix_length(n[full], threshold)
                ends = np.cumsum(p)
                pos = np.arange(ends[-1]) - np.repeat(ends - p, p)
                # a place beyond 20 bits counts as an earlier one: its filter only lets more through
                raw = np.minimum(pos, (1 << 20) - 1).astype(np.uint64) << _ID_BITS | rank[pos + np.repeat(begin, p)]
                prefix = pa.Array.from_buffers(pa.binary(), len(full), [None, pa.py_buffer(np.concatenate([[0], ends * 8]).astype(np.int32)), pa.py_buffer(raw.tobytes())])
                number = np.arange(len(row)) - np.searchsorted(row, row)
                place = c.lo + row[full]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_column[place]), pa.array(tag_column[place]), pa.array(number[full].astype(np.int32)), pa.array(signed(key)), pa.array(key2),
                    pa.array(n[full].astype(np.int32)), pa.array(signed(sig)), pa.array(signed(sig2)), prefix,
                ], names=["doc", "tag", "line", "key", "key2", "n", "sig", "sig2", "prefix"])
    return run


_LINES = "doc long, tag long, line int, key long, key2 int, n int, sig long, sig2 long, prefix binary"
_LINE_BATCH = pa.schema([(c, t) for c, t in zip(
    ("doc", "tag", "line", "key", "key2", "n", "sig", "sig2", "prefix"),
    (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)])
_PLACE_BATCH = pa.schema([_LINE_BATCH.field(c) for c in ("doc", "tag", "line")])
_POSTING = "token long, doc long, tag long, line int, n int, pos int, sig long, sig2 long, key long, key2 int"


def _joined(batches: list[pa.RecordBatch], schema: pa.Schema) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches, schema).combine_chunks()
    return pa.RecordBatch.from_arrays([c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns], schema=schema)


def _packed(batch: pa.RecordBatch) -> bytes:
    return batch.serialize().to_pybytes()


def _earliest(lines: pa.RecordBatch) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """The earliest line of each key, by key, and the places of the others."""
    doc, tag, line, key, key2 = (np.asarray(lines.column(c)) for c in ("doc", "tag", "line", "key", "key2"))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    tied = np.flatnonzero(np.concatenate([[False], same]) | np.append(same, False)) if len(same) else np.zeros(0, dtype=np.int64)
    sub = order[tied]
    order[tied] = sub[np.lexsort((line[sub], tag[sub], doc[sub], key2[sub], key[sub]))]
    k, k2 = key[order], key2[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (k2[1:] != k2[:-1])])[:len(order)]
    first, later = order[new], order[~new]
    own = first[np.cumsum(new) - 1][~new]
    later = later[(doc[later] != doc[own]) | (tag[later] != tag[own]) | (line[later] != line[own])]  # repeated rows are one place
    return lines.take(pa.array(first)), lines.select(_PLACE_BATCH.names).take(pa.array(later))


_DEALT = "bucket int, sets binary, copies binary"


def _dealt_lines(rarity_of, threshold: float, buckets: int):
    """Lines as in ``_line_sets``, collapsed within a batch: a row for each bucket of keys, copies with any one of them."""
    def dealt(lines: pa.RecordBatch) -> pa.RecordBatch:
        sets, copies = _earliest(lines)
        key = np.asarray(sets.column("key")).view(np.uint64)
        bucket = (key % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket)
        sets, bucket = sets.take(pa.array(order)), bucket[order]
        begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        size = np.diff(np.append(begin, len(bucket)))
        packed = [None] * len(begin)
        if len(copies):
            packed[int(key[0] >> np.uint64(32)) % len(begin)] = _packed(copies)
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[begin]), pa.array([_packed(sets.slice(b, n)) for b, n in zip(begin.tolist(), size.tolist(), strict=True)], pa.binary()), pa.array(packed, pa.binary())],
            names=["bucket", "sets", "copies"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for lines in _line_sets(rarity_of, threshold)(batches):
            held.append(lines)
            if sum(len(b) for b in held) >= LINES_AT_ONCE:
                yield dealt(_joined(held, _LINE_BATCH))
                held = []
        if held:
            yield dealt(_joined(held, _LINE_BATCH))
    return run


_SETS = "sets binary, words long, copies binary"


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of each bucket, each with its earliest place, the number of their prefix words, and the places of their copies."""
    def whole(parts: list, copies: list) -> pa.RecordBatch:
        sets, more = _earliest(_joined([pa.ipc.read_record_batch(x, _LINE_BATCH) for x in parts], _LINE_BATCH))
        copies = _joined([*(pa.ipc.read_record_batch(x, _PLACE_BATCH) for x in copies), more], _PLACE_BATCH)
        cut = [sets.slice(lo, 20_000) for lo in range(0, len(sets), 20_000)]
        words = [int(pc.sum(pc.binary_length(x.column("prefix"))).as_py()) // 8 for x in cut]
        return pa.RecordBatch.from_arrays(
            [pa.array([_packed(x) for x in cut], pa.binary()), pa.array(words, pa.int64()), pa.array([_packed(copies) if len(copies) and k == 0 else None for k in range(len(cut))], pa.binary())],
            names=["sets", "words", "copies"])

    bucket, parts, copies = None, [], []
    for batch in batches:
        for b, x, y in zip(batch.column("bucket").to_pylist(), batch.column("sets"), batch.column("copies"), strict=True):
            if b != bucket and parts:
                yield whole(parts, copies)
                parts, copies = [], []
            bucket = b
            parts.append(x.as_buffer())
            if y.is_valid:
                copies.append(y.as_buffer())
    if parts:
        yield whole(parts, copies)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns of packed ``sets``; other batches as they are."""
    for batch in batches:
        if "sets" not in batch.schema.names:
            yield batch
            continue
        for x in batch.column("sets"):
            yield pa.ipc.read_record_batch(x.as_buffer(), _LINE_BATCH)


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in batch.column("copies"):
            yield pa.ipc.read_record_batch(x.as_buffer(), _PLACE_BATCH)


def _prefixes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All packed prefix words of a binary column, and each one's row."""
    column = column.cast(pa.large_binary())
    _, off, data = column.buffers()
    ends = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    wide = np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]].view(np.uint64) if ends[-1] > ends[0] else np.zeros(0, dtype=np.uint64)
    return wide, np.repeat(np.arange(len(column)), np.diff(ends) // 8)


def _token_place(token: np.ndarray) -> np.ndarray:
    return (mix(token) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _postings(wanted):
    """A row for each prefix word of a set that may be among the ``wanted`` (packed bits over hashed words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in _sets(batches):
            for lo in range(0, batch.num_rows, 10_000):
                b = batch.slice(lo, 10_000)
                wide, each = _prefixes(b.column("prefix"))
                token = wide & np.uint64((1 << 44) - 1)
                at = _token_place(token)
                keep = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
                wide, each, token = wide[keep], each[keep], token[keep]
                own = {c: pa.array(np.asarray(b.column(c))[each]) for c in ("doc", "tag", "line", "n", "sig", "sig2", "key", "key2")}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(token)), own["doc"], own["tag"], own["line"], own["n"], pa.array((wide >> _ID_BITS).astype(np.int32)), own["sig"], own["sig2"], own["key"], own["key2"]],
                    names=["token", "doc", "tag", "line", "n", "pos", "sig", "sig2", "key", "key2"])
    return run


_COLUMNS = [("wide", np.uint64), ("doc", np.int64), ("tag", np.int64), ("line", np.int32), ("n", np.int32), ("sig", np.int64), ("sig2", np.int64)]  # wide: position, word
_WIDTH = sum(np.dtype(t).itemsize for _, t in _COLUMNS)


def _packed_postings(buckets: int):
    """Postings as in ``_postings``, but one packed row for each bucket of words and batch of sets: millions of rows less to shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sets(batches):
            for lo in range(0, batch.num_rows, 20_000):
                b = batch.slice(lo, 20_000)
                wide, each = _prefixes(b.column("prefix"))
                token = wide & np.uint64((1 << 44) - 1)
                bucket = (mix(token) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                bucket, each = bucket[order], each[order]
                columns = [wide[order] if c == "wide" else np.asarray(b.column(c))[each].astype(t) for c, t in _COLUMNS]
                begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[:len(bucket)])
                end = np.append(begin[1:], len(bucket))
                packed = [b"".join(c[x:y].tobytes() for c in columns) for x, y in zip(begin, end, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[begin]), pa.array(packed, pa.binary())], names=["bucket", "packed"])
    return run


def _unpacked(parts: list) -> list[np.ndarray]:
    """The postings of one bucket that share their word with another, sorted by word and place."""
    columns: list[list[np.ndarray]] = [[] for _ in _COLUMNS]
    for part in parts:
        n, at = len(part) // _WIDTH, 0
        for k, (_, t) in enumerate(_COLUMNS):
            columns[k].append(np.frombuffer(part, dtype=t, count=n, offset=at))
            at += n * np.dtype(t).itemsize
    wide, *whole = [np.concatenate(c) for c in columns]
    whole = [wide & np.uint64((1 << 44) - 1), *whole[:4], (wide >> _ID_BITS).astype(np.int32), *whole[4:]]
    order = np.argsort(whole[0])
    token = whole[0][order]
    same = np.concatenate([[False], token[1:] == token[:-1]])
    order = order[same | np.append(same[1:], False)]
    order = order[_by_word_and_place(*(c[order] for c in whole[:4]))]
    return [c[order] for c in whole]


def _by_word_and_place(token: np.ndarray, doc: np.ndarray, tag: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The order by (token, doc, tag, line); by single numbers where they fit, which numpy sorts several times as fast."""
    by_doc = np.argsort(doc)
    d, t = doc[by_doc], tag[by_doc]
    new = d[1:] != d[:-1]
    if len(doc) >= 1 << 20 or (~new & (t[1:] != t[:-1])).any():  # or one doc with several texts
        return np.lexsort((line, tag, doc, token))
    number = np.concatenate([[0], np.cumsum(new)])[:len(doc)].astype(np.uint64)
    by_place = by_doc[np.argsort(number << np.uint64(32) | line[by_doc].astype(np.uint64))]
    rank = np.sort(token[by_place] << np.uint64(20) | np.arange(len(doc), dtype=np.uint64)) & np.uint64((1 << 20) - 1)
    return by_place[rank.astype(np.int64)]


def _bucket_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Whole posting groups, bucket by bucket, from packed rows sorted by bucket."""
    bucket, parts = None, []
    for batch in batches:
        for b, x in zip(batch.column("bucket").to_pylist(), batch.column("packed"), strict=True):
            if b != bucket and parts:
                yield _unpacked(parts)
                parts = []
            bucket = b
            parts.append(x.as_buffer())
    if parts:
        yield _unpacked(parts)


def _token_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words as a bitmap over their hashes, in slices that hold any."""
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    for batch in batches:
        bits[_token_place(np.asarray(batch.column("token")).view(np.uint64))] = True
    parts = [(k, np.packbits(x)) for k, x in enumerate(np.split(bits, 1024)) if x.any()]
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()), pa.array([x.tobytes() for _, x in parts], pa.binary())], names=["slice", "bits"])


class _Posted(NamedTuple):
    token: np.ndarray
    doc: np.ndarray
    tag: np.ndarray
    line: np.ndarray
    n: np.ndarray
    pos: np.ndarray
    sig: np.ndarray
    sig2: np.ndarray


def _passing(g: _Posted, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (i, j) may still overlap enough; exact for the first word that a pair shares."""
    a, b = g.n[i], g.n[j]
    need = np.ceil(threshold / (1 + threshold) * (a + b) - 1e-9)
    ok = (np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9) & (np.minimum(a - g.pos[i], b - g.pos[j]) >= need)
    i, j = i[ok], j[ok]
    differ = np.bitwise_count(g.sig[i] ^ g.sig[j]).astype(np.int64) + np.bitwise_count(g.sig2[i] ^ g.sig2[j])
    ok[ok] = differ <= (a + b)[ok] - 2 * need[ok]
    return ok


SMALL = 1024


class _Found:
    """What the sweeps find: all pairs (earlier, later), or of each member only the earliest and the number of pairs seen."""

    def __init__(self, members: int, every: bool):
        self.every, self._i, self._j = every, [], []
        self.earliest, self.hits = (np.zeros(0 if every else members, dtype=np.int64) for _ in range(2))

    def some(self, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs in which no j comes twice."""
        if self.every:
            self._i.append(i)
            self._j.append(j)
        else:
            self.earliest[j] = np.where(self.hits[j] > 0, np.minimum(self.earliest[j], i), i)
            self.hits[j] += 1

    def block(self, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs by ascending i, later than those told before of the same j."""
        if self.every:
            self._i.append(i)
            self._j.append(j)
            return
        one, first, n = np.unique(j, return_index=True, return_counts=True)
        new = self.hits[one] == 0
        self.earliest[one[new]] = i[first[new]]
        self.hits[one] += n

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.every:
            j = np.flatnonzero(self.hits)
            return self.earliest[j], j
        none = [np.zeros(0, dtype=np.int64)]
        return np.concatenate(self._i or none), np.concatenate(self._j or none)


def _small_groups(g: _Posted, small: np.ndarray, threshold: float, wanted: np.ndarray, found: _Found) -> None:
    """Groups of up to SMALL members: one sweep per distance over the whole batch, by size, until the sizes are too far apart."""
    members = np.flatnonzero(small)
    group = np.cumsum(np.concatenate([[True], g.token[1:] != g.token[:-1]]))[members]
    members = members[np.argsort(group << 31 | g.n[members])]
    s = _Posted(*(c[members] for c in g))
    left = np.arange(len(members))
    for d in range(1, SMALL):
        left = left[np.searchsorted(left, d):]
        left = left[(s.n[left - d] >= threshold * s.n[left] - 1e-9) & (s.token[left - d] == s.token[left])]
        if len(left) == 0:
            break
        k = left[_passing(s, left - d, left, threshold)]
        x, y = members[k - d], members[k]
        for i, j in ((x, y), (y, x)):  # places go by number
            keep = (i < j) & wanted[j]
            found.some(i[keep], j[keep])


def _large_group(g: _Posted, begin: int, size: int, threshold: float, wanted: np.ndarray, found: _Found) -> None:
    """One group, members in blocks against all earlier ones; unless all pairs are asked for, a member stops at its second."""
    for j0 in range(begin, begin + size, 256):
        js = np.arange(j0, min(j0 + 256, begin + size))
        end, js, i0, step = int(js[-1]) + 1, js[wanted[js]], begin, 64
        while i0 < end and len(js):
            i = np.arange(i0, min(i0 + step, end))
            i0, step = i0 + step, min(2 * step, 2048)  # most members find theirs among the first
            ii, jj = np.repeat(i, len(js)), np.tile(js, len(i))
            before = ii < jj
            ii, jj = ii[before], jj[before]
            ok = _passing(g, ii, jj, threshold)
            found.block(ii[ok], jj[ok])
            if not found.every:
                js = js[found.hits[js] < 2]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Whole posting groups, about _BATCH rows at a time, from batches sorted by token."""
    names = [*_Posted._fields, "wanted"]
    held: list[list[np.ndarray]] = []
    rows = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append([np.asarray(batch.column(c)) if c != "wanted" else np.asarray(batch.column(c).cast(pa.int8())) > 0 for c in names if c in batch.schema.names])
        rows += batch.num_rows
        if rows < _BATCH or held[0][0][0] == held[-1][0][-1]:
            continue
        whole = [np.concatenate(x) for x in zip(*held, strict=True)]
        cut = int(np.searchsorted(whole[0], whole[0][-1]))
        yield [x[:cut] for x in whole]
        held, rows = [[x[cut:] for x in whole]], len(whole[0]) - cut
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _candidates(threshold: float, every: bool):
    """Pairs (later doc, tag, line; earlier doc, tag, line): of each member the earliest that passes, and whether there are ``more``.

    ``every``: all that pass, for the wanted members only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in (_groups if every else _bucket_groups)(batches):
            if len(got[0]) == 0:
                continue
            g = _Posted(*got[:4], *(x.astype(np.int64) for x in got[4:6]), *(x.view(np.uint64) for x in got[6:8]))
            wanted = got[8] if every else np.ones(len(g.token), dtype=bool)
            begin = np.flatnonzero(np.concatenate([[True], g.token[1:] != g.token[:-1]]))
            size = np.diff(np.append(begin, len(g.token)))
            found = _Found(len(g.token), every)
            _small_groups(g, np.repeat(size <= SMALL, size), threshold, wanted, found)
            for b, s in zip(begin[size > SMALL], size[size > SMALL], strict=True):
                _large_group(g, int(b), int(s), threshold, wanted, found)
            i, j = found.pairs()
            more = np.zeros(len(j), dtype=bool) if every else found.hits[j] > 1
            if len(j) == 0:
                continue
            yield pa.RecordBatch.from_arrays([pa.array(g.doc[j]), pa.array(g.tag[j]), pa.array(g.line[j]), pa.array(g.doc[i]), pa.array(g.tag[i]), pa.array(g.line[i]), pa.array(more), pa.array(g.token[j].view(np.int64))],
                                             names=["doc", "tag", "line", "doc2", "tag2", "line2", "more", "token"])
    return run


_PLACES = ["doc", "tag", "line", "doc2", "tag2", "line2"]
_PAIR = "doc long, tag long, line int, doc2 long, tag2 long, line2 int, more boolean, token long"


def _wanted_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes of the listed lines of each document."""
    for batch in batches:
        docs, tags, lists = batch.column("doc"), batch.column("tag"), batch.column("lines")
        for c in text_chunks(batch.column("text")):
            borders, row = line_borders(c.data, c.offsets)
            w = chunk_words(c.data, borders)
            base = np.searchsorted(row, np.arange(c.hi - c.lo + 1))
            out_doc, out_tag, out_line, out_words = [], [], [], []
            for r in range(c.hi - c.lo):
                for k in sorted(lists[c.lo + r].as_py()):
                    at = base[r] + k
                    if at < base[r + 1]:
                        out_doc.append(docs[c.lo + r].as_py())
                        out_tag.append(tags[c.lo + r].as_py())
                        out_line.append(k)
                        out_words.append(np.unique(w.hash[w.first[at]:w.first[at + 1]]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out_doc, pa.int64()), pa.array(out_tag, pa.int64()), pa.array(out_line, pa.int32()), pa.array(out_words, pa.binary())],
                                             names=["doc", "tag", "line", "words"])


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("wa"), batch.column("wb"), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([a, b]))
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(shared >= threshold * (len(both) - shared) - 1e-9)
            yield batch.filter(pa.array(keep, pa.bool_())).select(["doc", "tag", "line"])
    return run


def _matched(docs: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The (doc, tag, line) of pairs whose lines really match, read again from the whole texts."""
    need = pairs.select("doc", "tag", "line").union(pairs.select("doc2", "tag2", "line2")).distinct().groupBy("doc", "tag").agg(F.collect_set("line").alias("lines"))
    need = checkpointed(need)  # a text's own lines: bounded by the text
    thin = KeyFilter(need.select("doc", "tag")).split(docs.select("doc", "tag", "text"), "doc", "tag", only=True).drop("maybe")
    one = thin.join(need, ["doc", "tag"]).groupBy("doc", "tag").agg(F.first("text").alias("text"), F.first("lines").alias("lines"))  # repeated rows are one place
    lines = one.mapInArrow(_wanted_lines, "doc long, tag long, line int, words binary")
    lines = checkpointed(lines)
    a = lines.withColumnRenamed("words", "wa")
    b = lines.select(F.col("doc").alias("doc2"), F.col("tag").alias("tag2"), F.col("line").alias("line2"), F.col("words").alias("wb"))
    both = pairs.join(a, ["doc", "tag", "line"]).join(b, ["doc2", "tag2", "line2"]).select("doc", "tag", "line", "wa", "wb")
    return both.mapInArrow(_verified(threshold), "doc long, tag long, line int").distinct()


def _remaining(lines: DataFrame, doubtful: DataFrame, threshold: float) -> DataFrame:
    """All passing pairs of the ``doubtful`` members (doc, tag, line) under the words (token) that hold more than one for them.

    ``lines``: rows as of ``_line_sets``, or packed ``sets`` of them.

    Members without a tag are those of all texts with that doc."""
    spark = lines.sparkSession
    bits = np.zeros((1024, 1 << (FILTER_BITS - 13)), dtype=np.uint8)
    for r in doubtful.select("token").distinct().mapInArrow(_token_bits, "slice int, bits binary").toLocalIterator():  # a fixed number of bytes from each task
        bits[r["slice"]] |= np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    lines = lines.select("sets") if "sets" in lines.columns else lines.select("doc", "tag", "line", "n", "sig", "sig2", "prefix", "key", "key2")
    postings = lines.mapInArrow(_postings(spark.sparkContext.broadcast(bits.ravel())), _POSTING)
    # lines of one key have equal postings: the earliest place stands for them
    first = postings.groupBy("token", "key", "key2").agg(F.min(F.struct("doc", "tag", "line")).alias("at"), *[F.first(c).alias(c) for c in ("n", "pos", "sig", "sig2")])
    first = first.join(doubtful.select("token").distinct(), "token", "left_semi")
    wanted = first.select("token", "at.doc", "at.tag", "at.line", "n", "pos", "sig", "sig2").join(
        doubtful.withColumn("wanted", F.lit(True)), [c for c in ("doc", "tag", "line", "token") if c in doubtful.columns], "left")
    wanted = wanted.select("token", "doc", "tag", "line", "n", "pos", "sig", "sig2", F.coalesce("wanted", F.lit(False)).alias("wanted"))
    dealt = wanted.repartition(shuffle_partitions(spark), "token").sortWithinPartitions("token", "doc", "tag", "line")
    return dealt.mapInArrow(_candidates(threshold, True), _PAIR).select(*_PLACES).distinct()


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines listed in ``__gone``."""
    for batch in batches:
        names = batch.schema.names
        gone, text = batch.column(names.index("__gone")), batch.column(names.index("text"))
        mask, removed = np.asarray(pc.and_(gone.is_valid(), text.is_valid())), np.zeros(batch.num_rows, dtype=np.int64)
        out = []
        for r in np.flatnonzero(mask).tolist():
            lines = text[r].as_py().split("\n")
            drop = {k for k in gone[r].as_py() if k < len(lines)}
            out.append("\n".join(x for k, x in enumerate(lines) if k not in drop))
            removed[r] = len(drop)
        text = pc.replace_with_mask(text, pa.array(mask), pa.array(out, text.type)) if out else text
        columns = [text if c == "text" else pa.array(removed) if c == "__gone" else batch.column(i) for i, c in enumerate(names)]
        yield pa.RecordBatch.from_arrays(columns, names=["n_removed" if c == "__gone" else c for c in names])


def _lines_to_cut(src: DataFrame, threshold: float) -> DataFrame:
    """(doc, tag, __gone): numbers of the lines that go, for documents that lose any."""
    spark = src.sparkSession
    counts = _word_counts(src)
    rare = spark.sparkContext.broadcast(_classes(counts))
    parts = shuffle_partitions(spark)
    lines = src.mapInArrow(_dealt_lines(rare, threshold, max(parts, int(counts.sum()) // WORDS_PER_BUCKET)), _DEALT)
    sets = checkpointed(lines.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_collapsed, _SETS))
    buckets = max(parts, (sets.agg(F.sum("words")).first()[0] or 0) // POSTINGS_PER_BUCKET)
    postings = sets.select("sets").mapInArrow(_packed_postings(buckets), "bucket int, packed binary")
    dealt = postings.repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = checkpointed(dealt.mapInArrow(_candidates(threshold, False), _PAIR))
    pairs = checkpointed(found.select(*_PLACES).where("doc != doc2 or tag != tag2 or line != line2").distinct())
    settled = checkpointed(_matched(src, pairs, threshold))
    # members whose earliest pairs failed and that have others: compared with all earlier ones that pass the filters
    doubtful = checkpointed(found.where("more").select("doc", "tag", "line", "token").join(settled, ["doc", "tag", "line"], "left_anti"))
    if has_rows(doubtful):
        more = checkpointed(_remaining(sets, doubtful, threshold).join(pairs, _PLACES, "left_anti"))
        settled = settled.union(_matched(src, more, threshold)) if has_rows(more) else settled
    # a line goes if its set matches an earlier set, or if it is not the set's earliest place
    copies = sets.select("copies").where("copies IS NOT NULL").mapInArrow(_copies, "doc long, tag long, line int")
    cut = settled.union(copies).groupBy("doc", "tag").agg(F.collect_set("line").alias("__gone"))
    return checkpointed(cut, keep=True)


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with later matching lines cut out of ``text``, plus n_lines and n_removed (long)."""
    spark = docs.sparkSession
    place = [F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("tag"), F.col("text")]
    src = docs.select(*place)
    with scratch_tables(spark):  # all but the list of lines to cut
        cut = _lines_to_cut(src, threshold)
    thin = KeyFilter(cut.select("doc", "tag"))
    named = docs.withColumn("__doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))).withColumn("__tag", F.xxhash64("text"))
    cut = cut.select(F.col("doc").alias("__doc"), F.col("tag").alias("__tag"), "__gone")
    changed = thin.split(named, "__doc", "__tag", only=True).join(cut.hint("merge"), ["__doc", "__tag"], "left")  # planned alike at every size
    same = thin.split(named, "__doc", "__tag", only=False)
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    wide = [F.col(f"`{c}`") for c in kept] + [F.coalesce(lines, F.lit(0)).cast("long").alias("n_lines")]
    changed = changed.select(*wide, "__gone")
    schema = T.StructType([T.StructField("n_removed", T.LongType()) if f.name == "__gone" else f for f in changed.schema.fields])
    out = changed.mapInArrow(_without, schema).unionByName(same.select(*wide, F.lit(0).cast("long").alias("n_removed")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in kept else out
