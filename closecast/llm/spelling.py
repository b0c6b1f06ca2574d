"""Spelling variants: words that differ by one edit, found by dynamic programming along sorted lists.

1. Counting. Maximal runs of Latin letters of whole texts, A-Z lower-cased;
   some runs lose a letter by a rule on (document, run). Each task adds up its
   words in a table of bounded size before they are shuffled.
2. Lists. Two words one edit apart, the shorter of m letters, share their
   first or their last m // 2 letters. So a word of n letters is written to
   the lists (m, side, shared letters) for m = n and m = n - 1 and both sides
   (words reversed for the last letters). A list of more than ``TILE_WORDS``
   words is dealt to tiles: its words by hash to parts, each part as queries
   against each part as list, so no list is one task's work.
3. Scan. The words of a list are sorted, with the common prefix (LCP) of
   neighbours. A range of words that share a prefix shares the rows of the
   edit matrix up to there, so a query computes each row once for the whole
   range. A row is a band of three cells, enough for one edit. A range whose
   row has no cell of at most 1 is skipped whole. All queries of a chunk go
   down the ranges together in numpy; a level's ranges are split where the LCP says so.
4. A pair found in lists of both sides counts in that of the first letters.
   Each (word, tile) gives one row: how many near words, and the most frequent.
5. Roots: the form of a form, by pointer doubling over the (word, form) table.

Pairs are never written; a word's near words are bounded by the alphabet.

Defined cases: a null text has no words; a null document id reads as empty in
the rule; rows that repeat count each time; equally frequent forms: the
smallest in code-point order; an empty table gives no rows; extra columns are
not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closecast.llm.common import checkpointed, has_rows, scratch_tables, shuffle_partitions

MIN_LETTERS = 5
MIN_COUNT = 3
DROP_EVERY = 97
TILE_WORDS = 1 << 14
TABLE_WORDS = 1 << 18  # of a task's table of counts before it is written out
SLICE_CHARS = 1 << 18  # of a text counted at a time
QUERY_STEP = 1 << 10
_SALTS = 16


def _letters() -> bytes:
    """For Latin-1 bytes: letters lower-cased if A-Z, all else a blank."""
    fold = bytearray(b" " * 256)
    for c in [*range(0x61, 0x7B), *range(0xC0, 0x100)]:
        fold[c] = c
    for c in range(0x41, 0x5B):
        fold[c] = c + 32
    return bytes(fold)


_FOLD = _letters()


def letter_runs(text: str) -> Iterator[Counter]:
    """The runs of a text with their counts, one slice of the text at a time, as Latin-1 bytes (a byte per code point)."""
    held = b""
    for at in range(0, len(text), SLICE_CHARS):
        data = held + text[at:at + SLICE_CHARS].encode("latin-1", "replace").translate(_FOLD)
        cut = data.rfind(b" ") + 1 if at + SLICE_CHARS < len(text) else len(data)
        held = data[cut:]
        yield Counter(data[:cut].split())


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def _counted(min_letters: int, drop_every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Counter = Counter()

        def rows() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in table], pa.string()), pa.array(list(table.values()), pa.int64())], names=["word", "n"])
            table.clear()
            return got

        for batch in batches:
            for doc, text in zip(batch.column("doc"), batch.column("text"), strict=True):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                for runs in letter_runs(text.as_py()):
                    for word, n in runs.items():
                        h = zlib.crc32(_utf8(word), start)
                        if not h % drop_every:
                            k = h % len(word)
                            word = word[:k] + word[k + 1:]
                        if len(word) >= min_letters:
                            table[word] += n
                    if len(table) >= TABLE_WORDS:
                        yield rows()
        if table:
            yield rows()
    return run


def vocabulary(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY) -> DataFrame:
    """(word, n): the distinct words of columns doc_id and text with at least ``min_count`` occurrences."""
    src = docs.select(F.col("doc_id").cast("string").alias("doc"), "text")
    counts = src.mapInArrow(_counted(min_letters, drop_every), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class SortedList:
    """Words of several lists, sorted within each, as a matrix of their letters after the shared ones."""

    def __init__(self, words: list[bytes], lists: np.ndarray, skip: np.ndarray):
        """``lists`` numbers the list of each word (ascending), ``skip`` the letters that its words share."""
        self.words, self.lists = words, lists
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        self.length = (lengths - skip).astype(np.int64)
        wide = int(self.length.max(initial=0))
        self.letters = np.zeros((len(words), wide + 3), dtype=np.uint8)  # 0: no letter
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum(lengths)
        for d in range(wide):
            has = self.length > d
            self.letters[has, d] = flat[(ends - lengths + skip)[has] + d]
        same = np.zeros(len(words), dtype=np.int64)  # LCP with the word before; -1 where a list starts
        if len(words) > 1:
            differ = self.letters[1:] != self.letters[:-1]
            same[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), self.letters.shape[1])
            same[1:][lists[1:] != lists[:-1]] = -1
        if len(words):
            same[0] = -1
        self.lcp = same


def one_edit(listed: SortedList, queries: np.ndarray, length: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) pairs exactly one edit apart, of queries (letters after the shared ones, 0 filled) against the words of their list.

    A query's state in a range of words that share d letters is row d of its
    edit matrix, cells d-1, d, d+1, where 2 stands for more than one edit.
    """
    found_q, found_w = [], []
    n_words = len(listed.words)
    if not n_words or not len(queries):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    padded = np.zeros((len(queries), max(queries.shape[1], listed.letters.shape[1]) + 3), dtype=np.uint8)
    padded[:, 1:queries.shape[1] + 1] = queries  # letter j of a query stands at j + 1
    lo = np.searchsorted(listed.lists, lists, "left")
    hi = np.searchsorted(listed.lists, lists, "right")
    q = np.flatnonzero(lo < hi)
    lo, hi = lo[q], hi[q]
    left = np.full(len(q), 2, dtype=np.uint8)  # row 0: cells -1, 0, 1
    mid, right = np.zeros(len(q), dtype=np.uint8), np.ones(len(q), dtype=np.uint8)
    right[length[q] < 1] = 2
    depth = 0
    while len(q):
        # ranges of this level, split where neighbours share no more than ``depth`` letters
        borders = np.flatnonzero(listed.lcp <= depth)
        first, last = np.searchsorted(borders, lo), np.searchsorted(borders, hi)
        times = last - first
        of = np.repeat(np.arange(len(q)), times)
        child = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
        start = borders[child]
        q2, l2, m2, r2 = q[of], left[of], mid[of], right[of]
        x = listed.letters[start, depth]
        # a word that ends here: the cell at the query's end tells its distance
        over = listed.length[start] == depth
        end = length[q2] - depth
        at_end = np.where(end == 0, m2, np.where(end == 1, r2, np.where(end == -1, l2, 2)))
        hit = over & (at_end == 1)
        found_q.append(q2[hit])
        found_w.append(start[hit])
        # the next row, for ranges that go on
        q_before, q_here, q_next = (padded[q2, depth + j] for j in (0, 1, 2))
        may = ~over & ((m2 == 0) | ((l2 <= 1) & (x == q_before) & (depth > 0)) | ((m2 <= 1) & (x == q_here)) | ((r2 <= 1) & (x == q_next)))
        of, start, x, child = of[may], start[may], x[may], child[may]
        q2, l2, m2, r2 = q2[may], l2[may], m2[may], r2[may]
        q_before, q_here, q_next = q_before[may], q_here[may], q_next[may]
        size = length[q2]
        new_left = np.minimum(l2 + (x != q_before) if depth else np.full(len(q2), 2), m2 + 1)
        new_left = np.where(depth <= size, np.minimum(new_left, 2), 2)
        new_mid = np.minimum(np.minimum(m2 + (x != q_here), r2 + 1), new_left + 1)
        new_mid = np.where(depth + 1 <= size, np.minimum(new_mid, 2), 2)
        new_right = np.minimum(r2 + (x != q_next), new_mid + 1)
        new_right = np.where(depth + 2 <= size, np.minimum(new_right, 2), 2)
        live = np.minimum(np.minimum(new_left, new_mid), new_right) <= 1  # else the whole range is skipped
        lo = start[live]
        after = child[live] + 1
        hi = np.where(after < len(borders), borders[np.minimum(after, len(borders) - 1)], n_words)
        q, left, mid, right = q2[live], *(c[live].astype(np.uint8) for c in (new_left, new_mid, new_right))
        depth += 1
    return np.concatenate(found_q), np.concatenate(found_w)


def _near_in_tiles(batch_words: int):
    """Rows (list key, m, side, tile, role, word, n), sorted by tile and word: per query word and tile its near words."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        words = [w.encode("latin-1") for w in rows.column("written").to_pylist()]  # a side's letters come first
        tile = rows.column("tile_no").to_numpy()
        half = rows.column("m").to_numpy().astype(np.int64) // 2
        m = rows.column("m").to_numpy().astype(np.int64)
        side, role = rows.column("side").to_numpy(), rows.column("role").to_numpy()
        n = rows.column("n").to_numpy()
        in_list, asks = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
        listed = SortedList([words[i] for i in in_list], tile[in_list], half[in_list])
        every = SortedList([words[i] for i in asks], tile[asks], half[asks])  # for its matrix of letters
        who, near = [], []
        for at in range(0, len(asks), QUERY_STEP):
            sl = slice(at, at + QUERY_STEP)
            a, b = one_edit(listed, every.letters[sl], every.length[sl], every.lists[sl])
            who.append(asks[at + a])
            near.append(in_list[b])
        a, b = np.concatenate(who or [np.zeros(0, np.int64)]), np.concatenate(near or [np.zeros(0, np.int64)])
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        keep = np.minimum(lengths[a], lengths[b]) == m[a]
        a, b = a[keep], b[keep]
        # pairs that share their first letters too are found in that list
        first = np.array([side[i] == 0 or words[i][::-1][:half[i]] != words[j][::-1][:half[i]] for i, j in zip(a.tolist(), b.tolist(), strict=True)], dtype=bool)
        a, b = a[first], b[first]
        original = [words[i] if side[i] == 0 else words[i][::-1] for i in b.tolist()]
        rank = np.empty(len(b), dtype=np.int64)
        rank[sorted(range(len(b)), key=original.__getitem__)] = np.arange(len(b))
        order = np.lexsort((rank, -n[b], a))
        a, b = a[order], b[order]
        heads = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, dtype=np.int64)
        counts = np.diff(np.append(heads, len(a)))
        text = lambda i: (words[i] if side[i] == 0 else words[i][::-1]).decode("latin-1")
        return pa.RecordBatch.from_arrays([
            pa.array([text(i) for i in a[heads].tolist()], pa.string()), pa.array(counts, pa.int64()),
            pa.array(n[b[heads]], pa.int64()), pa.array([text(i) for i in b[heads].tolist()], pa.string())], names=["word", "n_near", "best_n", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, tiles, key = 0, 0, None

        def numbered(batch: pa.RecordBatch) -> pa.RecordBatch:
            """The batch with its tiles numbered through the task (rows come sorted by tile)."""
            nonlocal tiles, key
            cols = [batch.column(c) for c in ("key", "list_part", "query_part")]
            new = np.zeros(batch.num_rows, dtype=bool)
            for c in cols:
                v = c.to_numpy(zero_copy_only=False)
                new[1:] |= v[1:] != v[:-1]
            head = tuple(c[0].as_py() for c in cols)
            new[0] = head != key
            key = tuple(c[-1].as_py() for c in cols)
            no = tiles + np.cumsum(new)
            tiles = int(no[-1])
            return batch.append_column("tile_no", pa.array(no, pa.int64()))

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(numbered(batch))
            size += batch.num_rows
            if size >= batch_words:  # all tiles but the last, which may go on
                whole = pa.Table.from_batches(held)
                no = whole.column("tile_no").to_numpy()
                cut = int(np.searchsorted(no, no[-1]))
                if cut:
                    yield solve(whole.slice(0, cut))
                    held = whole.slice(cut).combine_chunks().to_batches()
                    size -= cut
        if held:
            yield solve(pa.Table.from_batches(held))
    return run


def _postings(words: DataFrame, min_letters: int) -> DataFrame:
    """(key, m, side, written, n): each word in its lists."""
    size = F.length("word")
    sides = F.array(*[F.struct(F.lit(s).alias("side"), w.alias("written")) for s, w in ((0, F.col("word")), (1, F.reverse("word")))])
    m = F.explode(F.filter(F.array(size - 1, size), lambda x: x >= min_letters))
    out = words.select("n", m.alias("m"), sides.alias("s")).select("n", "m", F.inline("s"))
    shared = F.expr("substring(written, 1, cast(floor(m / 2) as int))")
    return out.select(F.concat_ws(" ", F.col("m").cast("string"), F.col("side").cast("string"), shared).alias("key"), "m", "side", "written", "n")


def near_words(words: DataFrame, tile_words: int = TILE_WORDS, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(word, n_near, best_n, best): words of (word, n) with a word one edit away, and the most frequent such word. No word has fewer than ``min_letters`` letters."""
    posted = _postings(words, min_letters)
    large = checkpointed(posted.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > tile_words)
                         .select("key", F.ceil(F.col("size") / tile_words).cast("int").alias("parts")))
    one = F.lit(0)
    if not has_rows(large):
        tiled = posted.select("*", one.alias("list_part"), one.alias("query_part"), F.lit(3).alias("role"))
    else:  # at most one row per tile_words postings; a large list's rows meet it under several salts
        salted = large.select("key", "parts", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
        at = posted.withColumn("salt", F.pmod(F.xxhash64("written"), F.lit(_SALTS)).cast("int")).join(salted, ["key", "salt"], "left")
        parts = F.coalesce("parts", F.lit(1))
        at = at.withColumn("own", F.pmod(F.xxhash64("written", F.lit(7)), parts).cast("int"))
        roles = F.transform(F.sequence(F.lit(0), parts - 1), lambda p: F.when(
            p == F.col("own"), F.array(F.struct(p.alias("list_part"), p.alias("query_part"), F.lit(3).alias("role")))).otherwise(
            F.array(F.struct(F.col("own").alias("list_part"), p.alias("query_part"), F.lit(1).alias("role")),
                    F.struct(p.alias("list_part"), F.col("own").alias("query_part"), F.lit(2).alias("role")))))
        tiled = at.select("key", "m", "side", "written", "n", F.inline(F.flatten(roles)))
    order = ["key", "list_part", "query_part"]
    dealt = tiled.repartition(shuffle_partitions(words.sparkSession), *order).sortWithinPartitions(*order, "written")
    found = dealt.mapInArrow(_near_in_tiles(2 * tile_words), "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last form reached. Counts at least double from form to form, so there is no cycle and a chain is short."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        now = checkpointed(now)
        # only words that are somebody's root and have a form themselves move anything
        inner = now.join(now.select(F.col("root").alias("word")).distinct(), "word", "left_semi")
        if not has_rows(inner):
            return now
        step = inner.select(F.col("word").alias("at"), F.col("root").alias("next"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
        mine = now.withColumn("mine", F.pmod(F.xxhash64("word"), F.lit(_SALTS)).cast("int"))
        now = mine.join(step, (F.col("root") == F.col("at")) & (F.col("mine") == F.col("salt")), "left").select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(docs: DataFrame, ratio: int = 2, tile_words: int = TILE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the corpus.

    ``form`` is the most frequent near word if it is at least ``ratio`` times as frequent, else null.
    """
    with scratch_tables(docs.sparkSession):
        words = checkpointed(vocabulary(docs))
        near = checkpointed(near_words(words, tile_words))
        has_form = F.col("best_n") >= ratio * F.col("n")
        all_words = checkpointed(words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("best")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n")))
        rooted = roots(all_words.where("form IS NOT NULL").select("word", "form"))
        out = all_words.join(rooted, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return checkpointed(out, keep=True)
