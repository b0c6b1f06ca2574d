"""Nearest vectors by inner product: an int8 block matrix join with exact recomputation.

Vectors are dealt to row blocks and packed: int8 codes with one scale per
vector, the exact norm of what the codes leave out, and the original floats.
Query vectors are packed likewise and each query block meets each row block
of its dimension once (a tile). Inside a tile

    |<x, y> - <x^, y^>| <= |x - x^| |y| + |x^| |y - y^|

bounds every product of the codes, so a row is dropped only if its upper
bound lies under the query's k-th best score so far. Surviving pairs are
recomputed in double precision from the original components, added in
order, and kept in a heap of k for each query; the heaps of all tiles are merged
per query. The result is exact (recall 1), whatever the rounding.

Defined cases: a vector that is null, empty or all zero, or holds a null, NaN
or infinity takes no part, nor does a null id; rows with equal ids count once
(the largest vector); only vectors of equal dimension are compared; equal scores go to
the smaller id; a query with fewer than k candidates returns them all.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from closecast.llm.common import checkpointed

K = 20
BLOCK_BYTES = 2 << 20  # of original floats in a row block
QUERY_ROWS = 512
_BLOCK = "dim int, block int, ids binary, codes binary, scale binary, lost binary, norm binary, coded binary, floats binary"
_FOUND = "query_id long, vec_id long, score double"
_EXACT_DIM = 1024  # 127^2 x 1024 < 2^24: sums of code products are exact in single precision


def _pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """One block: codes, and the norms that bound their error."""
    dim, block = key[0].as_py(), key[1].as_py()
    ids = group.column("vec_id").to_numpy()
    x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in group.column("v").chunks]).reshape(len(ids), dim).astype(np.float64)
    scale = np.abs(x).max(axis=1) / 127
    scale = np.where(scale > 0, scale, 1)
    codes = np.rint(x / scale[:, None]).clip(-127, 127).astype(np.int8)
    hat = codes * scale[:, None]
    lost, norm, coded = (np.sqrt((y * y).sum(axis=1)) * (1 + 1e-9) for y in (x - hat, x, hat))
    return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int32())} | {
        c: pa.array([np.ascontiguousarray(y).tobytes()], pa.binary())
        for c, y in (("ids", ids.astype(np.int64)), ("codes", codes), ("scale", scale), ("lost", lost), ("norm", norm), ("coded", coded), ("floats", x))})


class _Block:
    def __init__(self, batch: pa.RecordBatch, row: int, prefix: str, dim: int):
        get = lambda c, t: np.frombuffer(batch.column(prefix + c)[row].as_buffer(), dtype=t)
        self.ids = get("ids", np.int64)
        self.codes = get("codes", np.int8).reshape(-1, dim)
        self.floats = get("floats", np.float64).reshape(-1, dim)
        self.scale, self.lost, self.norm, self.coded = (get(c, np.float64) for c in ("scale", "lost", "norm", "coded"))


def _exact(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    total = np.zeros(len(q))
    for j in range(q.shape[1]):
        total += q[:, j] * r[:, j]
    return total


def tile_top(queries: _Block, rows: _Block, k: int, row_step: int = 2048, query_step: int = 256) -> Iterator[tuple[int, list[tuple[float, int]]]]:
    """(query index, its best (score, -id)) among the rows, by bounds on code products and exact recomputation."""
    dim = queries.codes.shape[1]
    for q0 in range(0, len(queries.ids), query_step):
        qs = slice(q0, q0 + query_step)
        heaps: list[list[tuple[float, int]]] = [[] for _ in queries.ids[qs]]
        floor = np.full(len(heaps), -np.inf)
        for r0 in range(0, len(rows.ids), row_step):
            rs = slice(r0, r0 + row_step)
            near = np.zeros((len(heaps), len(rows.ids[rs])))
            for d0 in range(0, dim, _EXACT_DIM):
                ds = slice(d0, d0 + _EXACT_DIM)
                near += queries.codes[qs, ds].astype(np.float32) @ rows.codes[rs, ds].astype(np.float32).T
            near *= queries.scale[qs, None] * rows.scale[None, rs]
            slack = queries.lost[qs, None] * rows.norm[None, rs] + queries.coded[qs, None] * rows.lost[None, rs]
            slack += 1e-12 * queries.norm[qs, None] * rows.norm[None, rs]
            other = queries.ids[qs, None] != rows.ids[None, rs]
            low = np.where(other, near - slack, -np.inf)
            if low.shape[1] > k:
                floor = np.maximum(floor, np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k])
            qi, ri = np.nonzero(other & (near + slack >= floor[:, None]))
            for p in range(0, len(qi), 1 << 16):
                a, b = qi[p:p + (1 << 16)], ri[p:p + (1 << 16)]
                score = _exact(queries.floats[q0 + a], rows.floats[r0 + b])
                for i, s, v in zip(a.tolist(), score.tolist(), rows.ids[r0 + b].tolist(), strict=True):
                    heap = heaps[i]
                    if len(heap) < k:
                        heapq.heappush(heap, (s, -v))
                    elif (s, -v) > heap[0]:
                        heapq.heapreplace(heap, (s, -v))
            floor = np.maximum(floor, [h[0][0] if len(h) == k else -np.inf for h in heaps])
        for i, heap in enumerate(heaps):
            yield q0 + i, heap


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in range(batch.num_rows):
                dim = batch.column("dim")[t].as_py()
                queries, rows = _Block(batch, t, "q_", dim), _Block(batch, t, "", dim)
                query, vec, score = [], [], []
                for i, heap in tile_top(queries, rows, k):
                    query += [queries.ids[i]] * len(heap)
                    vec += [-v for _, v in heap]
                    score += [s for s, _ in heap]
                yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.float64())], names=["query_id", "vec_id", "score"])
    return run


def usable(v: str) -> Column:
    """True for vectors that take part."""
    c = F.col(v)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return c.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(c, lambda x: x != 0)


def nearest_vectors(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each query row, from columns vec_id and embedding."""
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), is_query.alias("q"))
    src = src.where(F.col("vec_id").isNotNull() & usable("v"))
    src = checkpointed(src.groupBy("vec_id").agg(F.max("v").alias("v"), F.first("q").alias("q")).withColumn("dim", F.size("v")))
    # per dimension: how many blocks keep a block within its bytes
    sizes = src.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("q").cast("long")).alias("nq")).select(
        "dim", F.ceil(F.col("n") * F.col("dim") * 8 / BLOCK_BYTES).cast("int").alias("blocks"), F.ceil(F.col("nq") / QUERY_ROWS).cast("int").alias("q_blocks"))
    dealt = src.join(sizes, "dim")
    rows = (dealt.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).select("dim", "block", "vec_id", "v")
            .groupBy("dim", "block").applyInArrow(_pack, _BLOCK))
    queries = (dealt.where("q").withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("q_blocks")).cast("int")).select("dim", "block", "vec_id", "v")
               .groupBy("dim", "block").applyInArrow(_pack, _BLOCK))
    queries = queries.select("dim", *[F.col(c).alias(f"q_{c}") for c in ("ids", "codes", "scale", "lost", "norm", "coded", "floats")])
    # every query block meets every row block of its dimension once
    met = queries.join(sizes.select("dim", "blocks"), "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    found = met.join(rows, ["dim", "block"]).mapInArrow(_tiles(k), _FOUND)
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
