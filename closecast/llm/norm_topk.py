"""Exact top-k search by inner product: norm-bucketed retrieval.

Vectors become integers (``intvec``) and are grouped by length: a bucket holds
the vectors whose length lies between two neighbouring powers of 2^(1/4),
longest first, and is cut into blocks of bounded bytes by a hash of the row,
so that no bucket, however full, is one task's work. Query vectors are packed
in blocks as well.

1. The blocks with the longest vectors (about ``SEED_ROWS`` rows) are searched
   first. The k-th best pair found there is the query's threshold.
2. A query with threshold s needs a cosine of t = s / (|q| * |longest of the
   bucket|) in a bucket. Buckets with t > 1 are never joined with that query's
   block unless another query of the block needs them.
3. In a (query block, bucket block) tile each query chooses by its t. From
   ``COORDINATE_FROM`` on, coordinates prune: for the query's largest
   coordinates f, only rows with p_f / |p| inside
   q_f t +- sqrt((1 - t^2)(1 - q_f^2)) (unit q) can reach cosine t, found in
   sorted lists of the block. Below it, length prunes: only the rows whose
   length is at least s / |q|, a prefix of the block. t rises as better pairs are found.
4. Surviving pairs are verified by exact integer products; the best k of each
   tile that beat the threshold are merged per query.

Every bound is widened by a relative 1e-9 and only strictly worse pairs are
dropped, so the result is exact.

Defined cases: a row whose vector is null or holds a null or non-finite
component takes no part; zero and empty vectors do, with score 0; only
vectors of equal dimension are compared; rows that repeat (an id, or id and
vector) are rows of their own, each a query or candidate; equal scores go to
the smaller vec_id, a null vec_id (a candidate only) last; a query with fewer
than k candidates returns them all; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from closecast.llm.common import checkpointed, scratch_tables
from closecast.llm.intvec import integer_vectors

K = 10
BLOCK_BYTES = 1 << 20
QUERY_ROWS = 512
SEED_ROWS = 4096
PER_DOUBLING = 4  # buckets per doubling of the length
COORDINATE_FROM = 0.6
FOCUS = 4  # coordinates that prune
_NO_ID = np.iinfo(np.int64).max
_EXACT = float(1 << 53)  # integers below this are exact in doubles
_ROWS = "dim int, bucket int, block int, longest double, n int, rids binary, ids binary, norms binary, vecs binary"
_FOUND = "rid long, query_id long, score long, vec_id long"


def _rows_packed(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """One block of a bucket, longest vectors first."""
    group = group.sort_by([("norm", "descending"), ("rid", "ascending")])
    norms = group.column("norm").to_numpy()
    ids = group.column("vec_id").fill_null(_NO_ID).to_numpy()
    one = lambda y: pa.array([np.ascontiguousarray(y).tobytes()], pa.binary())
    return pa.table({
        "dim": pa.array([key[0].as_py()], pa.int32()), "bucket": pa.array([key[1].as_py()], pa.int32()), "block": pa.array([key[2].as_py()], pa.int32()),
        "longest": pa.array([norms[0]], pa.float64()), "n": pa.array([len(ids)], pa.int32()),
        "rids": one(group.column("rid").to_numpy()), "ids": one(ids), "norms": one(norms), "vecs": pa.array([b"".join(group.column("v").to_pylist())], pa.binary())})


def _queries_packed(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """One block of queries with their thresholds: (score, id) of the k-th pair found so far, if there are k."""
    has = group.column("floor").is_valid().to_numpy()
    floor = group.column("floor").fill_null(0).to_numpy()
    norms = group.column("norm").to_numpy()
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(has & (norms > 0) & (floor > 0), floor / norms * (1 - 1e-9), 0.0)  # a row shorter than this cannot reach the threshold
    one = lambda y: pa.array([np.ascontiguousarray(y).tobytes()], pa.binary())
    return pa.table({
        "dim": pa.array([key[0].as_py()], pa.int32()), "need": pa.array([need.min()], pa.float64()), "q_n": pa.array([len(has)], pa.int32()),
        "q_rids": one(group.column("rid").to_numpy()), "q_ids": one(group.column("vec_id").to_numpy()), "q_norms": one(norms),
        "q_vecs": pa.array([b"".join(group.column("v").to_pylist())], pa.binary()),
        "q_has": one(has), "q_floor": one(floor), "q_floor_id": one(group.column("floor_id").fill_null(_NO_ID).to_numpy())})


_QUERIES = "dim int, need double, q_n int, q_rids binary, q_ids binary, q_norms binary, q_vecs binary, q_has binary, q_floor binary, q_floor_id binary"


class Bucket:
    """One block of rows, longest first, with sorted lists of their unit coordinates."""

    def __init__(self, rids: np.ndarray, ids: np.ndarray, norms: np.ndarray, vecs: np.ndarray):
        self.rids, self.ids, self.norms = rids, ids, norms
        self.longest = float(norms[0])
        self.ints = vecs
        self.floats = vecs.astype(np.float64)
        self._unit: np.ndarray | None = None
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def unit(self) -> np.ndarray:
        if self._unit is None:
            self._unit = self.floats / np.where(self.norms > 0, self.norms, 1.0)[:, None]
        return self._unit

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and values of coordinate f, in the order of the values."""
        if f not in self._lists:
            order = np.argsort(self.unit()[:, f], kind="stable")
            self._lists[f] = order, self.unit()[order, f]
        return self._lists[f]

    def by_coordinates(self, unit_query: np.ndarray, t: float) -> np.ndarray:
        """Rows whose largest-query-coordinate ranges allow a cosine of t."""
        t = max(min(t, 1.0), 0.0)
        focus = np.argsort(-np.abs(unit_query), kind="stable")[:FOCUS]
        mid = unit_query[focus] * t
        half = np.sqrt(max(1 - t * t, 0.0) * np.maximum(1 - unit_query[focus] ** 2, 0.0)) + 1e-7
        spans = []
        for f, m, h in zip(focus.tolist(), mid.tolist(), half.tolist(), strict=True):
            values = self.sorted_list(f)[1]
            spans.append((int(np.searchsorted(values, m - h, "left")), int(np.searchsorted(values, m + h, "right"))))
        first = min(range(len(spans)), key=lambda i: spans[i][1] - spans[i][0])
        rows = self.sorted_list(int(focus[first]))[0][slice(*spans[first])]
        for i, f in enumerate(focus.tolist()):
            if i != first:
                x = self.unit()[rows, f]
                rows = rows[(x >= mid[i] - half[i]) & (x <= mid[i] + half[i])]
        return rows

    def by_length(self, least: float) -> int:
        """How many rows, from the longest on, have at least this length."""
        return int(np.searchsorted(-self.norms, -least, "right"))


def products(vecs_ints: np.ndarray, vecs_floats: np.ndarray, query: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer inner products of rows with one query: in doubles where no partial sum leaves their exact range."""
    if bound < _EXACT:
        return (vecs_floats @ query.astype(np.float64)).astype(np.int64)
    return vecs_ints.astype(np.int64) @ query.astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if len(score) > 4 * k:  # all ties of the k-th score stay
        least = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= least)
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ids[near], -score[near]))[:k]]


def search(bucket: Bucket, rid: int, query: np.ndarray, norm: float, k: int, floor: tuple[int, int] | None) -> tuple[np.ndarray, np.ndarray]:
    """(score, id) of the query's best k rows in the block, of those that are not behind the threshold pair."""
    none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rows: np.ndarray | slice = slice(None)
    if floor is not None and floor[0] > 0:
        if norm <= 0 or bucket.longest <= 0:
            return none
        t = floor[0] / (norm * bucket.longest) * (1 - 1e-9)
        if t > 1:
            return none
        if t >= COORDINATE_FROM:
            rows = bucket.by_coordinates(query / norm, t)
            rows = rows[bucket.norms[rows] >= floor[0] / norm * (1 - 1e-9)]
        else:
            rows = slice(0, bucket.by_length(floor[0] / norm * (1 - 1e-9)))
    ids = bucket.ids[rows]
    if not len(ids):
        return none
    score = products(bucket.ints[rows], bucket.floats[rows], query, 1.01 * norm * bucket.longest)
    keep = bucket.rids[rows] != rid
    if floor is not None:
        keep &= (score > floor[0]) | ((score == floor[0]) & (ids <= floor[1]))
    score, ids = score[keep], ids[keep]
    top = _best(score, ids, k)
    return score[top], ids[top]


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c, t: np.frombuffer(batch.column(c)[i].as_buffer(), dtype=t)
                dim, n, nq = (batch.column(c)[i].as_py() for c in ("dim", "n", "q_n"))
                bucket = Bucket(get("rids", np.int64), get("ids", np.int64), get("norms", np.float64), get("vecs", np.int32).reshape(n, dim))
                rids, qids, norms, floor, floor_id = get("q_rids", np.int64), get("q_ids", np.int64), get("q_norms", np.float64), get("q_floor", np.int64), get("q_floor_id", np.int64)
                has, vecs = get("q_has", np.bool_), get("q_vecs", np.int32).reshape(nq, dim)
                out: list[tuple[np.ndarray, ...]] = []
                for q in range(nq):
                    score, ids = search(bucket, rids[q], vecs[q], float(norms[q]), k, (int(floor[q]), int(floor_id[q])) if has[q] else None)
                    if len(score):
                        out.append((np.full(len(score), rids[q]), np.full(len(score), qids[q]), score, ids))
                if out:
                    rid, qid, score, ids = (np.concatenate(c) for c in zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(qid), pa.array(score), pa.array(ids)], names=["rid", "query_id", "score", "vec_id"])
    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("rid").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_products(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest integer inner product for each query row, from columns vec_id and embedding."""
    spark = vectors.sparkSession
    with scratch_tables(spark):
        src = integer_vectors(vectors, vec_id=F.col("vec_id").cast("long"), q=F.coalesce(is_query & F.col("vec_id").isNotNull(), F.lit(False)))
        # the row number is kept in the written table, so it is the same wherever the table is read again
        src = checkpointed(src.select("*", F.monotonically_increasing_id().alias("rid"),
                                      F.when(F.col("norm") > 0, F.floor(F.log2("norm") * PER_DOUBLING)).otherwise(-1).cast("int").alias("bucket")))
        # a row per dimension and length bucket, however many vectors there are
        sizes = src.groupBy("dim", "bucket").agg(F.count(F.lit(1)).alias("n"))
        sizes = sizes.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("n") * F.greatest("dim", F.lit(16)) * 4 / BLOCK_BYTES)).cast("int"))
        longest_first = W.partitionBy("dim").orderBy(F.col("bucket").desc()).rowsBetween(W.unboundedPreceding, -1)
        sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(longest_first), F.lit(0)))
        sizes = checkpointed(sizes.withColumn("seeds", F.least("blocks", F.ceil(F.greatest(F.lit(SEED_ROWS) - F.col("before"), F.lit(0)) * F.col("blocks") / F.col("n"))).cast("int")))
        dealt = src.join(sizes.select("dim", "bucket", "blocks"), ["dim", "bucket"]).withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
        rows = checkpointed(dealt.select("dim", "bucket", "block", "rid", "vec_id", "norm", "v").groupBy("dim", "bucket", "block").applyInArrow(_rows_packed, _ROWS))
        queries = src.where("q").select("dim", "rid", "vec_id", "norm", "v")
        q_blocks = queries.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("q_blocks"))
        queries = checkpointed(queries.join(q_blocks, "dim").withColumn("q_block", F.pmod(F.xxhash64("rid", F.lit(1)), F.col("q_blocks")).cast("int")).drop("q_blocks"))

        def met(given: DataFrame, first: bool) -> DataFrame:
            packed = given.groupBy("dim", "q_block").applyInArrow(_queries_packed, _QUERIES)
            b = sizes.where("seeds > 0" if first else "seeds < blocks").select(
                "dim", "bucket", F.pow(F.lit(2.0), (F.col("bucket") + 1) / PER_DOUBLING).alias("longest_of"),
                F.explode(F.sequence(F.lit(0), F.col("seeds") - 1) if first else F.sequence(F.col("seeds"), F.col("blocks") - 1)).alias("block"))
            # a block of queries meets a bucket's block unless the bucket is too short for all of them
            at = packed.join(b, "dim").where("need <= 0 OR longest_of * 1.000001 >= need").drop("longest_of")
            return at.join(rows, ["dim", "bucket", "block"]).mapInArrow(_tiles(k), _FOUND)

        no_floor = queries.withColumns({"floor": F.lit(None).cast("long"), "floor_id": F.lit(None).cast("long")})
        seeds = checkpointed(_ranked(met(no_floor, True), k).drop("rank"))
        kth = _ranked(seeds, k).where(F.col("rank") == k).select("rid", F.col("score").alias("floor"), F.col("vec_id").alias("floor_id"))
        found = _ranked(seeds.unionByName(met(queries.join(kth, "rid", "left"), False)), k)
        result = found.select("query_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("vec_id") != int(_NO_ID), F.col("vec_id")).alias("vec_id"), "score")
        return checkpointed(result, keep=True)
