"""Near-duplicate groups by Order MinHash, verified by banded alignment.

1. Texts are word sequences (A-Z lower-cased). Equal sequences are copies; one
   document stands for them.
2. Order MinHash: the five-word shingles of a text, numbered by occurrence so
   that repeats differ, are ranked by each of ``sketches`` hash functions; the
   ``two`` smallest, kept in text order, are one sketch. Texts with an equal
   sketch meet in a bucket. Keeping order makes the chance of meeting follow
   edit similarity rather than set overlap.
3. Buckets are laid out by a range sort on (bucket, length, id), so a bucket
   of any size spreads over tasks. Each member is compared with its neighbour
   and with its bucket's first member: a linear number of pairs, never all
   pairs of a group.
4. A pair is verified on whole texts by a banded bit-parallel alignment of the
   words: L aligned words of texts with n and m words give the similarity
   L / (n + m - L), and 0.8 or more is a link. Any pair of texts whose ordered
   five-word shingles agree to 0.8 also aligns to 0.8.
5. Linked texts form components. Further rounds compare, inside every bucket,
   one member of each component in the same way, until a round finds no link.
6. In the buckets that still hold several components, every pair of members of
   different components that passes the length and the shared-word filter is
   verified, in salted blocks of length bands. Both filters only skip pairs
   that cannot be links. A first pass over word counters finds the members that
   have such a pair; the second takes their words into the blocks and verifies
   there, likeliest pairs first, skipping pairs that the block's own links have
   joined by then. So no pair leaves a block, only links that join components:
   fewer than the block has members. A pair that shares several buckets is
   tried in the first of them alone, and only members outside a bucket's
   largest component are set against the others.

A pair at word-level similarity 0.8 by scattered substitutions (one word in
ten) shares a sketch with probability of about 0.18, hence one of 24 with 0.99;
with one word in twenty, above 0.9999.

Defined cases: a text without words is compared as it stands (a null text
equals an empty one), so wordless texts group only when equal; texts under five
words have one shingle, the whole text. Every row takes part by its own text,
also those with equal or null ids: rows with equal ``doc_id`` are one document,
hence one class, whichever of its texts has links. A class is named by its
smallest ``doc_id``; one whose rows are all without an id by a 64-bit hash of one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closecast.llm.common import KeyFilter, checkpointed, chunk_words, has_rows, mix, new_table_path, scratch_tables, shuffle_partitions, signed, text_chunks
from closecast.llm.components import ROWS_PER_TASK, components

SHINGLE = 5
SKETCHES = 24
THRESHOLD = 0.8
FIRST_ROUND = 6  # sketches whose neighbours are compared before the rest
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
_SALT = np.arange(1, 257, dtype=np.uint64) * _ODD
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k-word shingles row by row, and the rows' borders among them (a short text has one shingle)."""
    n = len(hashes)
    count = np.diff(first)
    own = np.where(count >= k, count - k + 1, (count > 0).astype(count.dtype))
    out_first = np.concatenate([[0], np.cumsum(own)])
    row = np.repeat(np.arange(len(count)), own)
    at = np.arange(len(row)) - out_first[row] + first[row]
    end = first[1:][row]
    padded = np.append(hashes, np.zeros(k, dtype=np.uint64))
    g = np.zeros(len(row), dtype=np.uint64)
    for j in range(k):
        word = np.where(at + j < end, padded[np.minimum(at + j, n)], np.uint64(0))
        g = (g ^ (g >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + word
    return mix(g), out_first


def _numbered(s: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Shingle hashes with the number of the occurrence in the row mixed in."""
    key = mix(s ^ mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    begin = np.flatnonzero(head)
    nth = np.arange(len(s)) - np.repeat(begin, np.diff(np.append(begin, len(s))))
    again = nth > 0
    out = s.copy()
    out[order[again]] = mix(s[order[again]] + nth[again].astype(np.uint64) * _ODD)
    return out


def order_sketches(hashes: np.ndarray, first: np.ndarray, sketches: int = SKETCHES) -> np.ndarray:
    """rows x sketches bucket keys; rows without words get zeros."""
    rows = len(first) - 1
    out = np.zeros((rows, sketches), dtype=np.uint64)
    s, border = shingles(hashes, first)
    size = np.diff(border)
    full = np.flatnonzero(size)
    if len(full) == 0:
        return out
    begin, size = border[full], size[full]
    labelled = _numbered(s, np.repeat(np.arange(len(full)), size))
    for t in range(sketches):
        v = labelled * _MULTIPLIERS[t]
        low = np.minimum.reduceat(v, begin)
        is_low = v == np.repeat(low, size)
        at_low = np.flatnonzero(is_low)
        v[is_low] = _MAX
        next_low = np.repeat(np.minimum.reduceat(v, begin), size)
        is_next = (v == next_low) & ~is_low
        # one position per row; equal labelled hashes (collisions) keep the first
        one = np.full(len(full), -1)
        two = np.full(len(full), -1)
        r = np.searchsorted(begin, at_low, side="right") - 1
        one[r[::-1]] = at_low[::-1]
        at_next = np.flatnonzero(is_next)
        r = np.searchsorted(begin, at_next, side="right") - 1
        two[r[::-1]] = at_next[::-1]
        early = np.where(two >= 0, np.minimum(one, two), one)
        late = np.maximum(one, two)
        pair = mix(s[early] + _ODD) * np.uint64(3) + np.where(two >= 0, mix(s[late]), np.uint64(0))
        out[full, t] = mix(pair + _SALT[t])
    return out


def _sequence_keys(hashes: np.ndarray, first: np.ndarray, data: bytes, offsets: np.ndarray) -> np.ndarray:
    """rows x 2 hashes of the word sequences; wordless rows hash their bytes."""
    count = np.diff(first)
    place = np.arange(len(hashes), dtype=np.uint64) - np.repeat(first[:-1], count).astype(np.uint64) + np.uint64(1)
    keys = np.zeros((len(count), 2), dtype=np.uint64)
    for k, odd in enumerate((np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7))):
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(hashes + place * odd), dtype=np.uint64)])
        keys[:, k] = mix(total[first[1:]] - total[first[:-1]] + count.astype(np.uint64))
    for r in np.flatnonzero(count == 0):
        raw = data[offsets[r]:offsets[r + 1]]
        value = np.uint64(int.from_bytes(raw, "little") % 0xFFFFFFFFFFFFFFC5)
        keys[r] = mix(np.array([value, value ^ _ODD])) | np.uint64(1)
    return keys


def _sketched(sketches: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in text_chunks(batch.column("text")):
                w = chunk_words(c.data, c.offsets)
                keys = _sequence_keys(w.hash, w.first, c.data, c.offsets)
                sk = order_sketches(w.hash, w.first, sketches)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(signed(sk.ravel())), sketches).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(x).slice(c.lo, c.hi - c.lo) for x in ("doc_id", "node")), pa.array(signed(keys[:, 0].copy())), pa.array(signed(keys[:, 1].copy())),
                     pa.array(np.diff(w.first).astype(np.int64)), lists],
                    names=["doc_id", "node", "k1", "k2", "n_words", "keys"])
    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's word hashes as packed 64-bit numbers."""
    for batch in batches:
        for c in text_chunks(batch.column("text")):
            w = chunk_words(c.data, c.offsets)
            packed = pa.array([w.hash[a:b].tobytes() for a, b in zip(w.first[:-1], w.first[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("rep").slice(c.lo, c.hi - c.lo), packed], names=["rep", "tokens"])


def aligned_words(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Words aligned in order (longest common subsequence) among those at most ``band`` places apart.

    One big integer holds a row of the alignment matrix inside the band, one bit
    per column; a cleared bit is an aligned word.
    """
    n, m = len(a), len(b)
    head = 0
    least = min(n, m)
    if least:
        differ = np.flatnonzero(a[:least] != b[:least])
        head = int(differ[0]) if len(differ) else least
        differ = np.flatnonzero(a[n - least + head:][::-1] != b[m - least + head:][::-1])
        tail = int(differ[0]) if len(differ) else least - head
        a, b = a[head:n - tail], b[head:m - tail]
        head += tail
    n, m = len(a), len(b)
    if n == 0 or m == 0:
        return head
    places: dict[int, int] = {}
    for j, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | (1 << j)
    row = (1 << n) - 1
    everything = row
    for i, x in enumerate(b.tolist()):
        lo = max(0, i - band)
        if lo >= n:
            break
        width = min(n, i + band + 1) - lo
        mask = (1 << width) - 1
        matches = (places.get(x, 0) >> lo) & mask
        if matches:
            part = (row >> lo) & mask
            hit = part & matches
            new = ((part + hit) | (part & ~matches)) & mask
            row ^= (part ^ new) << lo
    return head + (everything ^ row).bit_count()


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """L / (n + m - L) of the word sequences, exact where it is at least ``threshold``, else smaller than it."""
    n, m = len(a), len(b)
    if n == 0 or m == 0 or min(n, m) < threshold * max(n, m):
        return 0.0
    # L / (n + m - L) >= t  <=>  n + m - 2 L <= (n + m) (1 - t) / (1 + t), which also bounds the drift of an alignment
    band = int((n + m) * (1 - threshold) / (1 + threshold)) + 1
    common = _shared(a, b)
    if common < threshold * (n + m - common):
        return 0.0
    got = aligned_words(a, b, band)
    return got / (n + m - got)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Words in common, as multisets: an upper bound of the aligned words."""
    both = np.sort(np.concatenate([np.unique(a), np.unique(b)]))
    if len(both) == len(a) + len(b):  # no repeats on either side
        return int((both[1:] == both[:-1]).sum())
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    return int(np.minimum(ca[ia], cb[ib]).sum())


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ta, tb = batch.column("ta"), batch.column("tb")
            keep = [similarity(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), threshold) >= threshold
                    for x, y in zip(ta, tb, strict=True)]
            got = batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])
            yield got
    return run


_PAIR = "a long, b long"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (key, n_words, rep): each row with the row before it and with its bucket's first row.

    The first and last rows of a task are handed on (``edge`` = their place in
    the order), for buckets that go on in the next task.
    """
    last = first = None  # (key, rep, comp)
    opening = True
    for batch in batches:
        if batch.num_rows == 0:
            continue
        key, rep, comp = (np.asarray(batch.column(c)) for c in ("key", "rep", "comp"))
        prev_key = np.concatenate([[last[0] if last else key[0]], key[:-1]])
        prev_rep = np.concatenate([[last[1] if last else rep[0]], rep[:-1]])
        prev_comp = np.concatenate([[last[2] if last else comp[0]], comp[:-1]])
        head = key != prev_key
        begin = np.flatnonzero(head)
        hub = np.searchsorted(begin, np.arange(len(key)), side="right") - 1
        f = first or (key[0], rep[0], comp[0])
        hub_rep = np.where(hub >= 0, rep[begin[hub]] if len(begin) else f[1], f[1])
        hub_comp = np.where(hub >= 0, comp[begin[hub]] if len(begin) else f[2], f[2])
        near = ~head & (prev_comp != comp)
        far = ~head & (hub_comp != comp)
        a = np.concatenate([prev_rep[near], hub_rep[far]])
        b = np.concatenate([rep[near], rep[far]])
        yield _pairs(a, b, None, None)
        if opening:
            yield _pairs(rep[:1], comp[:1], key[:1], 0)
            opening = False
        last = (key[-1], rep[-1], comp[-1])
        if len(begin):
            first = (key[begin[-1]], rep[begin[-1]], comp[begin[-1]])
        else:
            first = f
    if last:
        for x in {first, last}:
            yield _pairs(np.array([x[1]]), np.array([x[2]]), np.array([x[0]]), 1)


def _pairs(a, b, key, edge) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays([
        pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)),
        pa.array(key.astype(np.int64)) if key is not None else pa.nulls(n, pa.int64()),
        pa.array([edge] * n, pa.int32()),
    ], names=["a", "b", "key", "edge"])


def _candidates(entries: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of a linear number, from entries (key, n_words, rep, comp)."""
    laid = entries.repartitionByRange(shuffle_partitions(entries.sparkSession), "key", "n_words", "rep").sortWithinPartitions("key", "n_words", "rep")
    found = checkpointed(laid.select("key", "rep", "comp").mapInArrow(_neighbours, _PAIR + ", key long, edge int"))
    inner = found.where("edge is null").select("a", "b")
    # the few border rows of the tasks: rows of one bucket are tied to its smallest row among them
    edge = found.where("edge is not null").select("key", F.col("a").alias("rep"), F.col("b").alias("comp")).distinct()
    low = edge.groupBy("key").agg(F.min("rep").alias("low"))
    border = edge.join(low, "key").select(F.col("low").alias("a"), F.col("rep").alias("b"))
    a, b = F.col("a"), F.col("b")
    return inner.union(border).where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, sketches: int = SKETCHES) -> DataFrame:
    """One row per row of ``docs``: doc_id and class_id (smallest doc_id of its group)."""
    doc_id = F.col("doc_id").cast("long")
    # a row's node is its id and text
    named = docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, doc_id.isNull(), F.col("text")).alias("node"), "text")
    with scratch_tables(docs.sparkSession):  # all but the keys of the rows and the classes of the texts
        rows = checkpointed(named.mapInArrow(_sketched(sketches), "doc_id long, node long, k1 long, k2 long, n_words long, keys array<long>"))
        classes = checkpointed(_classes(named.select(F.col("node").alias("doc_id"), "text"), rows, threshold), keep=True)
        rows = checkpointed(rows.select("doc_id", "k1", "k2"), keep=True)
    return rows.join(classes, ["k1", "k2"]).select("doc_id", "class_id")


_COUNTERS = 128  # hashed word counters of a text for the shared-word filter, one byte each
_BLOCK = 1024  # members of a block, about
_BLOCK_WORDS = 1 << 21  # and their words


def _counted(tokens: np.ndarray) -> np.ndarray:
    """A text's words in hashed counters that stop at 255."""
    place = (mix(tokens) % np.uint64(_COUNTERS)).astype(np.int64)
    return np.minimum(np.bincount(place, minlength=_COUNTERS), 255).astype(np.uint8)


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's word counters."""
    for batch in batches:
        out = [_counted(np.frombuffer(raw.as_buffer(), np.uint64)).tobytes() for raw in batch.column("tokens")]
        yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(out, pa.binary())], names=["rep", "counts"])


def passing(n: np.ndarray, counts: np.ndarray, m: np.ndarray, counts2: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Which texts (rows) may be links of which others (columns), by length and shared words, and how far they differ; every link passes.

    Texts of n and m words with L aligned ones differ in n + m - 2 L words, and
    their counters in no more.
    """
    share = np.ones((len(n), len(m)), dtype=np.float32)
    ok = np.minimum(n[:, None], m) >= threshold * np.maximum(n[:, None], m) - 1e-9
    i, j = np.nonzero(ok)
    for lo in range(0, len(i), 1 << 16):
        x, y = i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)]
        a, b = counts[x], counts2[y]
        differ = (np.maximum(a, b) - np.minimum(a, b)).sum(axis=1, dtype=np.int64)
        ok[x, y] = differ <= (n[x] + m[y]) * (1 - threshold) / (1 + threshold) + 1e-9
        share[x, y] = differ / (n[x] + m[y])
    return ok, share


class _Block:
    """The members of one block: ``left`` (active ones) are set against ``right``."""

    def __init__(self, rows: pa.Table, counts: np.ndarray):
        self.counts = counts
        self.rep, self.comp, self.n = (rows.column(c).to_numpy() for c in ("rep", "comp", "n_words"))
        self.active = rows.column("active").to_numpy()
        role = rows.column("role").to_numpy()
        self.left, self.right = np.flatnonzero(role == 1), np.flatnonzero(role == 0)
        lists = rows.column("keys").combine_chunks()
        at = lists.flatten()
        t, key = (at.field(c).to_numpy(zero_copy_only=False) for c in ("t", "key"))
        self.key = rows.column("key")[0].as_py()
        self.keys = np.zeros((len(rows), int(t.max()) + 1), dtype=np.int64)
        self.has = np.zeros(self.keys.shape, dtype=bool)
        member = np.repeat(np.arange(len(rows)), lists.value_lengths().to_numpy(zero_copy_only=False))
        self.keys[member, t], self.has[member, t] = key, True

    def candidates(self, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs (left, right, how far they differ) of different components that pass the filters, 256 left members at a time."""
        right = self.right
        for lo in range(0, len(self.left), 256):
            x = self.left[lo:lo + 256]
            ok, share = passing(self.n[x], self.counts[x], self.n[right], self.counts[right], threshold)
            # two active members meet twice: once is enough
            i, j = np.nonzero(ok & (self.comp[x][:, None] != self.comp[right]) & (~self.active[right] | (self.rep[x][:, None] < self.rep[right])))
            share, i, j = share[i, j], x[i], right[j]
            first = np.ones(len(i), dtype=bool)
            for at in range(0, len(i), 1 << 16):  # of the buckets that both are in, the first is theirs
                a, b = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
                same = (self.keys[a] == self.keys[b]) & self.has[a] & self.has[b]
                first[at:at + (1 << 16)] = self.keys[a, same.argmax(axis=1)] == self.key
            yield i[first], j[first], share[first]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole blocks from rows sorted by block."""
    block, parts = None, []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        at = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("key", "band", "s", "u")])
        cuts = np.flatnonzero(np.concatenate([[True], (at[:, 1:] != at[:, :-1]).any(axis=0)]))
        for lo, hi in zip(cuts, np.append(cuts[1:], batch.num_rows), strict=True):
            name = tuple(at[:, lo])
            if name != block and parts:
                yield pa.Table.from_batches(parts)
                parts = []
            block = name
            parts.append(batch.slice(lo, hi - lo))
    if parts:
        yield pa.Table.from_batches(parts)


def _live(threshold: float):
    """The rows of a block's members that are in any pair to verify."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            counts = np.frombuffer(b"".join(rows.column("counts").to_pylist()), dtype=np.uint8).reshape(-1, _COUNTERS)
            live = np.zeros(len(rows), dtype=bool)
            for i, j, _ in _Block(rows, counts).candidates(threshold):
                live[i] = live[j] = True
            if live.any():
                yield from rows.drop_columns(["counts"]).filter(pa.array(live)).to_batches()
    return run


def _joining(threshold: float):
    """Links (a < b) that join components inside a block: all pairs are verified but those that earlier links have joined."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            words_of = [np.frombuffer(x.as_buffer(), np.uint64) for chunk in rows.column("tokens").chunks for x in chunk]
            block = _Block(rows, np.stack([_counted(x) for x in words_of]))
            root = np.unique(block.comp, return_inverse=True)[1]  # each member's component, relabelled as components join
            out = []
            for i, j, share in block.candidates(threshold):
                order = np.argsort(share, kind="stable")
                for at in range(0, len(order), 4096):
                    part = order[at:at + 4096]
                    for x, y in zip(i[part].tolist(), j[part].tolist(), strict=True) if (root[i[part]] != root[j[part]]).any() else ():
                        if root[x] != root[y] and similarity(words_of[x], words_of[y], threshold) >= threshold:
                            root[root == root[y]] = root[x]
                            out.append(sorted((int(block.rep[x]), int(block.rep[y]))))
            if out:
                a, b = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


_MEMBER = "key long, band int, rep long, comp long, n_words long, active boolean, s int, u int, keys array<struct<t:int,key:long>>, role int"


def _remaining_links(entries: DataFrame, comp: DataFrame, tokens: DataFrame, threshold: float) -> DataFrame:
    """Links that join all members of different components that share a bucket and are similar."""
    parts = shuffle_partitions(entries.sparkSession)
    placed = checkpointed(entries.select("key", "t", "n_words", "rep").join(comp, F.col("rep") == F.col("node"), "left")
                          .select("key", "t", "n_words", "rep", F.coalesce("component", "rep").alias("comp")))
    sizes = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("key").agg(F.max(F.struct("n", "comp"))["comp"].alias("most"), F.count(F.lit(1)).alias("comps")).where("comps > 1").select("key", "most")
    # texts whose lengths allow a link are in one band or in neighbouring ones
    width = max(-float(np.log(threshold)) * 1.001, 0.01)
    open_ = checkpointed(placed.join(mixed, "key").select("key", "t", "n_words", "rep", "comp", (F.col("comp") != F.col("most")).alias("active"),
                                                          F.floor(F.log("n_words") / width).cast("int").alias("band")))
    # a member's buckets: as many as there are sketches, at most
    keys = open_.groupBy("rep").agg(F.collect_list(F.struct("t", "key")).alias("keys"))
    members = checkpointed(tokens.join(keys.select("rep"), "rep", "left_semi").mapInArrow(_histograms, "rep long, counts binary").join(keys, "rep"))
    reach = F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band")
    own = open_.groupBy("key", "band").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("w"), F.count_if("active").alias("n_active"), F.sum(F.when(F.col("active"), F.col("n_words"))).alias("w_active"))
    near = own.select("key", reach, "n", "w").groupBy("key", "band").agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
    blocks = lambda n, w: F.ceil(F.greatest(F.col(n) / _BLOCK, F.col(w) / _BLOCK_WORDS)).cast("int")
    # blocks of a band: u salts of its active members times s salts of all members they may meet
    salts = checkpointed(own.where("n_active > 0").select("key", "band", "n_active", "w_active").join(near, ["key", "band"]).select(
        "key", "band", blocks("n", "w").alias("ss"), blocks("n_active", "w_active").alias("us")))
    salt = lambda of, seed: F.pmod(F.xxhash64("rep", F.lit(seed)), F.col(of)).cast("int")
    all_of = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    columns = ["key", "band", "rep", "comp", "n_words", "active", "s", "u"]
    left = open_.where("active").join(salts, ["key", "band"]).withColumn("u", salt("us", 1)).withColumn("s", all_of("ss")).select(*columns, F.lit(1).alias("role"))
    # the few bands with active members name the bands that they meet: members are joined to those, not copied to every band near them
    met = salts.select("key", F.col("band").alias("at"), "ss", "us", reach)
    right = (open_.join(met, ["key", "band"]).withColumn("band", F.col("at"))
             .withColumn("s", salt("ss", 2)).withColumn("u", all_of("us")).select(*columns, F.lit(0).alias("role")))
    dealt = lambda x: x.repartition(parts, "key", "band", "s", "u").sortWithinPartitions("key", "band", "s", "u")
    live = checkpointed(dealt(left.union(right).join(members, "rep").select(*columns, "keys", "role", "counts")).mapInArrow(_live(threshold), _MEMBER))
    return checkpointed(dealt(live.join(tokens, "rep").select(*columns, "keys", "role", "tokens")).mapInArrow(_joining(threshold), _PAIR))


def _classes(docs: DataFrame, rows: DataFrame, threshold: float) -> DataFrame:
    """(k1, k2, class_id) of each distinct text; ``docs`` has a row's node as its doc_id."""
    # copies: one row stands for all of a text; copies have equal sketches
    texts = checkpointed(rows.groupBy("k1", "k2").agg(
        F.min("node").alias("rep"), F.min("doc_id").alias("low"), F.max("n_words").alias("n_words"), F.first("keys").alias("keys")))
    entries = texts.where("n_words > 0").select("rep", "n_words", F.posexplode("keys").alias("t", "key"))
    shared = entries.groupBy("key").agg((F.min("rep") != F.max("rep")).alias("many")).where("many").select("key")
    entries = checkpointed(entries.join(shared, "key").select("key", "t", "n_words", "rep"))
    _, comp = _verified_links(docs, entries, threshold)
    one = _texts_of_one_id(rows, texts)
    comp = _joined(comp, one) if has_rows(one) else comp
    placed = texts.select("k1", "k2", "rep", "low").join(comp, F.col("rep") == F.col("node"), "left").drop("node")
    lowest = placed.where("component is not null").groupBy("component").agg(F.min("low").alias("lowest"))
    return placed.join(lowest, "component", "left").select("k1", "k2", F.coalesce("lowest", "low", "component", "rep").alias("class_id"))


def _texts_of_one_id(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between the different texts of rows with equal ids."""
    known = rows.where("doc_id is not null").select("doc_id", "k1", "k2")
    several = known.groupBy("doc_id").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("k1", "k2")])
    several = several.where("min_k1 != max_k1 or min_k2 != max_k2").select("doc_id")
    reps = checkpointed(known.join(several, "doc_id").distinct().join(texts.select("k1", "k2", "rep"), ["k1", "k2"]).select("doc_id", "rep"))
    first = reps.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return reps.join(first, "doc_id").where("rep != a").select("a", F.col("rep").alias("b"))


def _tokens_table(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, tokens) of the texts that share a bucket, laid out by rep so that pairs join it without moving it."""
    spark = docs.sparkSession
    thin = KeyFilter(reps).split(docs.select(F.col("doc_id").cast("long").alias("rep"), "text"), "rep").where("maybe").drop("maybe")
    # repeated rows are one node
    tokens = (thin.join(reps, "rep", "left_semi").mapInArrow(_tokens, "rep long, tokens binary")
              .groupBy("rep").agg(F.max_by("tokens", F.struct(F.length("tokens"), "tokens")).alias("tokens")))
    path = new_table_path(spark, "closecast_tokens")
    name = path.rpartition("/")[2].replace("-", "_")
    (tokens.write.option("compression", "none").option("path", path)
     .bucketBy(shuffle_partitions(spark), "rep").sortBy("rep").saveAsTable(name))
    return spark.table(name)


def _verified_links(docs: DataFrame, entries: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between different texts, and the components (node, component) they form."""
    spark = docs.sparkSession
    tasks = 1 + entries.count() // ROWS_PER_TASK
    links, comp = spark.createDataFrame([], _PAIR), spark.createDataFrame([], "node long, component long")
    if not has_rows(entries):
        return links, comp
    tokens = _tokens_table(docs, checkpointed(entries.select("rep").distinct()))
    tried, number = links, 0
    while True:
        own = entries if number else entries.where(F.col("t") < FIRST_ROUND)
        placed = (own.join(comp, F.col("rep") == F.col("node"), "left")
                  .select("key", "n_words", "rep", F.coalesce("component", "rep").alias("comp")).coalesce(tasks))
        if number > 1:  # one member of each component of a bucket
            placed = (placed.groupBy("key", "comp").agg(F.min(F.struct("n_words", "rep")).alias("x"))
                      .select("key", "x.n_words", "x.rep", "comp").coalesce(tasks))
        pairs = checkpointed(_candidates(placed).join(tried, ["a", "b"], "left_anti"))
        found = _links_of(pairs, tokens, threshold)
        number += 1
        if has_rows(found):
            comp = _joined(comp, found)
        tried, links = tried.union(pairs), links.union(found)
        if number > 2 and not has_rows(found):
            break
    # what the samples left: no link can be outside these
    found = _remaining_links(entries, comp, tokens, threshold)
    return links.union(found), _joined(comp, found) if has_rows(found) else comp


def _links_of(pairs: DataFrame, tokens: DataFrame, threshold: float) -> DataFrame:
    return checkpointed(
        pairs.join(tokens.select(F.col("rep").alias("a"), F.col("tokens").alias("ta")), "a")
        .join(tokens.select(F.col("rep").alias("b"), F.col("tokens").alias("tb")), "b")
        .mapInArrow(_verified(threshold), _PAIR))


def _joined(comp: DataFrame, found: DataFrame) -> DataFrame:
    return components(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).union(found))
