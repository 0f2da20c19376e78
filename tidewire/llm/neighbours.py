"""Nearest neighbours by a block matrix join over int8 codes.

Queries and candidates are dealt into blocks by a hash of their id, and each pair of blocks meets in one task: at most
about ``QUERY_BLOCK`` queries and ``BLOCK`` candidates, whatever the input. There every vector becomes int8 codes and a
scale. The product of a tile of codes (exact in float32, so BLAS can do it) gives an approximate cosine; the norms of
the parts lost in quantising bound its error. Pairs whose upper bound reaches the query's fifth best score so far are
computed again in double precision on the original vectors and go to the query's heap of five. The heaps of all
blocks of a query are merged at the end. So the search is exact; nothing is sampled.

Nulls and edge cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
rows without an id; only vectors of equal length are compared; of rows that repeat an id the one with the smallest
vector counts; ties go to the smaller id; a query with fewer candidates gets all of them; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import importable, read_table, stage

K = 5
EVERY = 50
BLOCK, QUERY_BLOCK = 65_536, 4_096
TILE = 2_048


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, vectors, dims = [], [], []
        for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
            if i is None or not v.is_valid or not len(v.values) or v.values.null_count:
                continue
            x = np.asarray(v.values, np.float64)
            if np.isfinite(x).all() and x.any():
                ids.append(i)
                vectors.append(x)
                dims.append(len(x))
        offsets = np.concatenate([[0], np.cumsum(dims, dtype=np.int64)]).astype(np.int32)
        cells = np.concatenate(vectors) if vectors else np.zeros(0)
        yield pa.RecordBatch.from_pydict({"vec_id": pa.array(ids, pa.int64()), "dim": pa.array(dims, pa.int32()), "x": pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells))})


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids, ascending and each once, and their vectors."""
    ids = table["vec_id"].to_numpy()
    x = table["x"].combine_chunks()
    x = (x if isinstance(x, pa.Array) else pa.concat_arrays(x.chunks)).flatten().to_numpy().reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    if len(np.unique(ids)) < len(ids):
        order = np.lexsort([*x.T[::-1], ids])
    ids, x = ids[order], x[order]
    first = np.concatenate([[True], ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, bool)
    return ids[first], x[first]


def _codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the unit vectors, scales, norms of the coded vectors, and norms of what the codes lose."""
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    back = code * scale[:, None]
    return code, scale, np.sqrt((back * back).sum(axis=1)), np.sqrt(((unit - back) ** 2).sum(axis=1))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes: sums of up to 1,000 products stay below 2^24, so float32 holds them."""
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], 1000):
        out += a[:, i : i + 1000].astype(np.float32) @ b[:, i : i + 1000].astype(np.float32).T
    return out


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of a with the same rows of b, in double precision."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def search_block(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int = K) -> list[tuple[int, int, float]]:
    """The k nearest candidates of each query, as (query, candidate, score)."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in qid]
    floor = np.full(len(qid), -np.inf)
    if len(qid) and len(c):
        # of equal vectors only the k + 1 with the smallest ids can be among a query's nearest
        _, same = np.unique(c, axis=0, return_inverse=True)
        order = np.argsort(same.ravel(), kind="stable")
        run = same.ravel()[order]
        nth = np.arange(len(run)) - np.searchsorted(run, run)
        keep = np.sort(order[nth <= k])
        cid, c = cid[keep], c[keep]
        qc, qs, qn, qr = _codes(q)
        for lo in range(0, len(c), TILE):
            ids, x = cid[lo : lo + TILE], c[lo : lo + TILE]
            cc, cs, cn, cr = _codes(x)
            near = _product(qc, cc) * qs[:, None] * cs
            error = qn[:, None] * cr + qr[:, None] * cn + qr[:, None] * cr + 1e-9
            own = qid[:, None] == ids
            if len(ids) > k + 1:
                low = np.where(own, -np.inf, near - error)
                floor = np.maximum(floor, np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k])
            row, col = np.nonzero((near + error >= floor[:, None]) & ~own)
            for at in range(0, len(row), 100_000):
                r, j = row[at : at + 100_000], col[at : at + 100_000]
                for i, v, s in zip(r.tolist(), ids[j].tolist(), cosine(q[r], x[j]).tolist()):
                    if len(heaps[i]) < k:
                        heapq.heappush(heaps[i], (s, -v))
                    elif (s, -v) > heaps[i][0]:
                        heapq.heapreplace(heaps[i], (s, -v))
            for i, h in enumerate(heaps):
                if len(h) == k:
                    floor[i] = max(floor[i], h[0][0] - 1e-9)
    return [(int(a), -v, s) for a, h in zip(qid, heaps) for s, v in h]


def _join(queries: pa.Table, candidates: pa.Table) -> pa.Table:
    found = search_block(*_matrix(queries), *_matrix(candidates)) if len(queries) and len(candidates) else []
    cols = list(zip(*found)) or [(), (), ()]
    return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})


def nearest(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k rows nearest to each row whose id is divisible by ``every``."""
    importable(vectors.sparkSession)
    rows = stage(vectors.select(F.col("vec_id").cast("bigint"), "embedding").mapInArrow(_valid, "vec_id bigint, dim int, x array<double>"), "vectors")
    queries = rows.filter(F.col("vec_id") % every == 0)
    n, m = rows.count(), queries.count()
    n_blocks, n_query_blocks = max(1, -(-n // BLOCK)), max(1, -(-m // QUERY_BLOCK))
    tasks = 4 * vectors.sparkSession.sparkContext.defaultParallelism
    if n_blocks * n_query_blocks < tasks:  # smaller blocks, so that every core has some
        n_blocks = max(n_blocks, min(max(1, n // 2048), tasks))

    def block(count: int) -> F.Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    def all_of(count: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = queries.withColumn("qb", block(n_query_blocks)).withColumn("cb", all_of(n_blocks))
    right = rows.withColumn("cb", block(n_blocks)).withColumn("qb", all_of(n_query_blocks))
    keys = ["dim", "qb", "cb"]
    part = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_join, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return part.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"))
