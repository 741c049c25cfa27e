"""Fits on whole cohorts that are too large for matrices of samples.

Many fits run side by side by conjugate gradients. One pass over the genes, which stay distributed,
multiplies the samples' products with a column for each fit: a task turns its genes into one
``samples x fits`` table, whose slices are summed in Spark. A block of fits has ``BLOCK_BYTES`` of
scores, and so have its columns on the driver, in a broadcast and in a task; more fits are more
blocks. Each sample of the cohort is trained on, and nothing grows with its square.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.functions.logistic import fit_many
from locusloom.session import cut_lineage, shared_folder

BLOCK_BYTES = 8 * 2**20
SLICES = 32

# Labelings, folds, labels and held-out samples (both samples x fits) of a block of fits.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def dense_rows(cells: pa.Array, n: int) -> np.ndarray:
    """Genes x samples block of an array of cell lists."""
    flat = cells.flatten()
    at, value = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("at", "n"))
    row = np.repeat(np.arange(len(cells)), pc.list_value_length(cells).to_numpy(zero_copy_only=False))
    return np.bincount(row * n + at, value, len(cells) * n).reshape(len(cells), n)


def fits_per_block(n: int) -> int:
    return max(1, BLOCK_BYTES // (8 * n))


def fold_blocks(held: list[np.ndarray], n_labelings: int, n: int, labels: Callable[[np.ndarray], np.ndarray]) -> Iterator[Block]:
    """Blocks of every (fold, labeling); ``held`` are the samples a fold holds out, ``labels`` gives those of labelings."""
    per, total = fits_per_block(n), len(held) * n_labelings
    for first in range(0, total, per):
        fits = np.arange(first, min(first + per, total))
        fold, labeling = fits // n_labelings, fits % n_labelings
        some, place = np.unique(labeling, return_inverse=True)
        tested = np.zeros((n, len(fits)), bool)
        for i, f in enumerate(fold):
            tested[held[f], i] = True
        yield labeling, fold + 1, labels(some)[place].T, tested


def _pass(genes: DataFrame, n: int, v: np.ndarray, place: np.ndarray, trains: np.ndarray, scaled: bool) -> np.ndarray:
    """Product of the samples with ``v`` (samples x fits); column ``place`` of ``trains`` is the training part of a fit.

    Genes are centred on the training part and, with ``scaled``, divided by its deviation, those constant there
    left out. A gene of whole counts is constant if its sums say so exactly, another up to rounding.
    """
    held = genes.sparkSession.sparkContext.broadcast((v, place, trains))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, place, trains = held.value
        size, total, sums = trains.sum(axis=0), v.sum(axis=0), None
        rows = fits_per_block(n)
        for batch in batches:
            for at in range(0, len(batch), rows):
                x = dense_rows(batch.column("cells").slice(at, rows), n)
                mean = (once := x @ trains) / size
                t = x @ v - mean[:, place] * total
                if scaled:
                    squares = size * ((x * x) @ trains)
                    whole = np.all(x == np.floor(x), axis=1)[:, None]
                    varies = squares - once * once > np.where(whole, 0.0, 1e-9 * squares)
                    spread = np.divide(size * size, squares - once * once, out=np.zeros(varies.shape), where=varies)
                    t *= spread[:, place]
                part = x.T @ t - np.sum(mean[:, place] * t, axis=0)
                sums = part if sums is None else sums + part
        if sums is not None:
            parts = np.array_split(sums, SLICES)
            columns = [pa.array(range(len(parts)), pa.int32()), pa.array([p.ravel() for p in parts], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["slice", "k"])

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slice": [rows.iloc[0]["slice"]], "k": [np.sum(np.stack(rows["k"]), axis=0)]})

    schema = "slice int, k array<double>"
    found = genes.mapInArrow(partial, schema).groupBy("slice").applyInPandas(total, schema).toArrow()
    held.destroy()
    out = np.zeros(v.shape)
    for at, k in zip(found.column("slice").to_pylist(), found.column("k")):
        rows = np.array_split(np.arange(n), SLICES)[at]
        out[rows] = k.values.to_numpy().reshape(len(rows), -1)
    return out


def _scores(genes: DataFrame, fold: np.ndarray, y: np.ndarray, tested: np.ndarray, scaled: bool) -> np.ndarray:
    """Scores of all samples in each fit of a block: scaled genes and balanced classes, or raw counts and a free intercept."""
    n, train = len(y), ~tested
    sizes = np.stack([np.sum(train & (y == c), axis=0) for c in (0, 1)])
    if np.any(sizes == 0):
        raise ValueError("a training part has one class only")
    weight = train.astype(float)
    if scaled:
        weight *= np.where(y == 1, *(sizes.sum(axis=0) / (2.0 * sizes[c]) for c in (1, 0)))

    def product(v: np.ndarray, fits: np.ndarray) -> np.ndarray:
        _, first, place = np.unique(fold[fits], return_index=True, return_inverse=True)
        found = _pass(genes, n, v, place, train[:, fits[first]].astype(float), scaled)
        # The added sum is the constant feature of a penalised intercept; a free one makes up for centring.
        return found + v.sum(axis=0) if scaled else found

    return fit_many(product, y, weight, free_intercept=not scaled)


def predictions(genes: DataFrame, n: int, blocks: Iterable[Block], scaled: bool, schema: str) -> DataFrame:
    """Held-out predictions of all blocks of fits on ``genes (cells)``; blocks are written one after the other."""
    spark = genes.sparkSession
    genes = cut_lineage(genes.select("cells").repartition(2 * spark.sparkContext.defaultParallelism))
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).write.parquet(path)
    for labeling, fold, y, tested in blocks:
        # Fits that train on the same samples share the moments of the genes.
        score = _scores(genes, fold if scaled else np.arange(len(fold)), y, tested, scaled)
        fit, at = np.nonzero(tested.T)
        found = score[at, fit]
        columns = {
            "labeling": pa.array(labeling[fit], pa.int64()), "fold": pa.array(fold[fit], pa.int32()), "at": pa.array(at, pa.int32()),
            "y": pa.array(y[at, fit], pa.int32()), "prob_positive": 0.5 * (1.0 + np.tanh(0.5 * found)), "decision_score": found,
        }
        spark.createDataFrame(pa.table(columns), schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
