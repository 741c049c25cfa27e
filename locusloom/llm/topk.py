"""Exact top-k inner products with vector-approximation files.

Vectors become integers and are kept in blocks: a small column of one-byte cells per component
(the approximation, over a grid of the block's own range) and the exact values beside it.

1. The approximations alone are scanned. A cell bounds its component, so a query has a lower
   and an upper bound of its product with every vector, from one matrix product with the
   centres and one with the half-widths. The k-th largest lower bound over all blocks is the
   threshold of the query.
2. A vector whose upper bound lies under the threshold can't be among the results. In a second
   scan the others of each block have their exact values read in the order of their bounds,
   best first, until the k-th exact product exceeds every bound left.

Queries are a stated part of the rows. They go in blocks of about ``QUERY_BLOCK`` by a hash of
their id, one pair of scans per block, so what a task or the driver holds does not grow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusloom.llm.tables import Scratch

SCALE = 1024
BLOCK = 4096
QUERY_BLOCK = 2048
LARGEST = float(1 << 62)
BLOCKS = "dim int, ids binary, cells binary, grid binary, exact binary"


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, x)`` with ``floor(SCALE * x)`` as longs; unusable vectors are left out, components over a quarter of the longs refused."""
    wide = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    sound = F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))  # NaN compares as larger
    refused = F.raise_error(F.lit(f"a component of {LARGEST / SCALE:.0f} or more: its products exceed a long")).cast("long")
    return wide.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & sound).select(
        "vec_id", F.transform("x", lambda c: F.when(F.abs(c) < LARGEST / SCALE, F.floor(c * SCALE)).otherwise(refused)).alias("x")
    )


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix of the vectors of each length."""
    ids, lists = batch.column("vec_id").to_numpy(zero_copy_only=False), batch.column("x")
    size, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    for dim in np.unique(size):
        own = np.flatnonzero(size == dim)
        yield ids[own], flat[(ends[own] - dim)[:, None] + np.arange(dim)]


def _approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, x in _matrices(batch):
            for at in range(0, len(ids), BLOCK):
                part = x[at : at + BLOCK]
                low = part.min(axis=0)
                step = (part.max(axis=0) - low) // 256 + 1
                cells = ((part - low) // step).astype(np.uint8)
                row = [[part.shape[1]], *([v.tobytes()] for v in (ids[at : at + BLOCK], cells, np.stack([low, step]), part))]
                types = [pa.int32()] + [pa.binary()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["dim", "ids", "cells", "grid", "exact"])


class Queries:
    """A block of queries of one length."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x, self.float, self.size = ids, x, x.astype(np.float64), np.abs(x).astype(np.float64)

    def bounds(self, dim: int, ids: bytes, cells: bytes, grid: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vector ids, centre products (minus infinity for the query's own row) and bound widths per query."""
        low, step = np.frombuffer(grid, np.int64).reshape(2, dim)
        half = (step - 1) / 2
        centre = np.frombuffer(cells, np.uint8).reshape(-1, dim) * step.astype(np.float64) + (low + half)
        numbers = np.frombuffer(ids, np.int64)
        product = self.float @ centre.T
        rounding = self.size @ (np.abs(low) + 256.0 * step) * (dim + 2) * 2.0**-52
        product[self.ids[:, None] == numbers[None, :]] = -np.inf
        return numbers, product, self.size @ half + rounding


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products of the rows of ``x`` with ``y`` as longs; in Python integers where they might not fit, and an error where one doesn't."""
    if not len(x) or (np.abs(x).astype(np.float64) @ np.abs(y).astype(np.float64)).max() < LARGEST:
        return x @ y
    scores = x.astype(object) @ y.astype(object)
    if any(not -(1 << 63) <= score < 1 << 63 for score in scores):
        raise OverflowError("an inner product exceeds a long")
    return scores.astype(np.int64)


def _thresholds(queries: dict[int, Queries], k: int):
    """Each task's ``k`` largest lower bounds of every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {d: np.full((len(q.ids), k), -np.inf) for d, q in queries.items()}
        for batch in batches:
            for dim, ids, cells, grid in zip(*(batch.column(c).to_pylist() for c in ("dim", "ids", "cells", "grid"))):
                if dim in queries:
                    _, product, width = queries[dim].bounds(dim, ids, cells, grid)
                    both = np.concatenate([best[dim], product - width[:, None]], axis=1)
                    best[dim] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        for dim, found in best.items():
            row, column = np.nonzero(np.isfinite(found))
            yield pa.RecordBatch.from_arrays([pa.array(queries[dim].ids[row]), pa.array(found[row, column])], ["query_id", "bound"])

    return run


def _search(queries: dict[int, Queries], limits: dict[int, np.ndarray], k: int):
    """Each block's results that may count: ``k`` largest exact products, ties to the smaller id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["dim"] not in queries:
                    continue
                own, found = queries[row["dim"]], []
                numbers, product, width = own.bounds(row["dim"], row["ids"], row["cells"], row["grid"])
                upper = product + width[:, None]
                exact = np.frombuffer(row["exact"], np.int64).reshape(-1, row["dim"])
                for i in np.flatnonzero((upper >= limits[row["dim"]][:, None]).any(axis=1)):
                    open_ = np.flatnonzero((upper[i] >= limits[row["dim"]][i]) & np.isfinite(upper[i]))
                    open_ = open_[np.argsort(-upper[i][open_], kind="stable")]
                    ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
                    for at in range(0, len(open_), 4 * k):
                        if len(scores) >= k and scores[k - 1] > upper[i][open_[at]]:
                            break
                        some = open_[at : at + 4 * k]
                        ids, scores = np.append(ids, numbers[some]), np.append(scores, exact_products(exact[some], own.x[i]))
                        first = np.lexsort((ids, -scores))[:k]
                        ids, scores = ids[first], scores[first]
                    found.append((np.full(len(ids), own.ids[i]), ids, scores))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["query_id", "vec_id", "score"])

    return run


def _rank_first(rows: DataFrame, k: int, *order) -> DataFrame:
    window = Window.partitionBy("query_id").orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest inner products of each query, ties to the smaller ``vec_id``.

    Both tables have ``vec_id`` and ``embedding``; components become ``floor(1024 * x)``.
    Candidates are all vectors of the query's length but those with its id; with fewer than
    ``k`` all are returned. Vectors that are null or empty, hold a null or non-finite component,
    or have no id take no part. A candidate's product that exceeds a long is an error, as is a component of 2**52 or more. A
    query id with several vectors asks with the smallest of them; repeated candidate rows are
    results each. Other columns are ignored; without queries the result is empty.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    blocks = scratch.keep(integer_vectors(vectors).mapInArrow(_approximate, BLOCKS))
    asked = scratch.keep(integer_vectors(queries).groupBy("vec_id").agg(F.min("x").alias("x")))
    rounds = -(-asked.count() // QUERY_BLOCK)
    out = spark.createDataFrame([], "query_id long, vec_id long, score long")
    for r in range(rounds):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == r).toArrow().to_batches()
        sets: dict[int, list] = {}
        for batch in rows:
            for ids, x in _matrices(batch):
                sets.setdefault(x.shape[1], []).append((ids, x))
        own = {d: Queries(*(np.concatenate(c) for c in zip(*parts))) for d, parts in sets.items()}
        bounds = blocks.select("dim", "ids", "cells", "grid").mapInArrow(_thresholds(own, k), "query_id long, bound double")
        least = _rank_first(bounds, k, F.desc("bound")).groupBy("query_id").agg(F.min("bound").alias("bound"), F.count(F.lit(1)).alias("c"))
        known = {row["query_id"]: row["bound"] for row in least.where(F.col("c") >= k).collect()}
        limits = {d: np.array([known.get(int(i), -np.inf) for i in q.ids]) for d, q in own.items()}
        out = out.unionByName(blocks.mapInArrow(_search(own, limits, k), "query_id long, vec_id long, score long"))
    return _rank_first(out, k, F.desc("score"), "vec_id").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
