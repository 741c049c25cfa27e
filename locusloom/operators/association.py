"""Sample-level integration, Spearman association, correlation matrix, condition summary."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusloom.functions.tails import rank_correlation_p_udf
from locusloom.functions.text import INTEGRATION_SUFFIXES, normalize_sample_id
from locusloom.operators.ordered import average_rank, bh_adjust
from locusloom.session import cut_lineage

# Metadata columns kept beside the metrics.
METADATA_COLUMNS = ["condition", "run_id", "sample_title", "gsm"]

#: Numbers of a band of the rank product that a task holds (64 MB).
BAND = 2**23


def regroup_mutation_burden(burden: DataFrame) -> DataFrame:
    """Sums per normalised sample id, every column prefixed with ``mutation_``."""
    columns = [c for c in burden.columns if c != "sample_id"]
    return burden.groupBy(normalize_sample_id(F.col("sample_id"), INTEGRATION_SUFFIXES).alias("sample_id")).agg(
        *[F.sum(c).alias(f"mutation_{c}") for c in columns]
    )


def first_metadata(metadata: DataFrame, order: str | None = None) -> DataFrame:
    """One row per normalised id (the first by ``order``) with the known columns, as text."""
    columns = [c for c in METADATA_COLUMNS if c in metadata.columns]
    keyed = metadata.withColumn("sample_id", normalize_sample_id(F.col("sample_id"), INTEGRATION_SUFFIXES))
    row = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
    first = keyed.groupBy("sample_id").agg((F.min_by(row, order) if order else F.min(row)).alias("_r"))
    return first.select("sample_id", *[F.col(f"_r.{c}").alias(c) for c in columns])


def integrate_samples(
    burden: DataFrame,
    mutations: DataFrame,
    spectra: DataFrame | None = None,
    clusters: DataFrame | None = None,
    cells: DataFrame | None = None,
    metadata: DataFrame | None = None,
) -> DataFrame:
    """One row per sample: burden and mutation totals (either may be absent), then what is known of it, by sample id."""
    merged = burden.join(mutations, "sample_id", "full_outer")
    for extra in (spectra, clusters, cells, metadata):
        if extra is not None:
            merged = merged.join(extra, "sample_id", "left")
    return merged.orderBy("sample_id")


def _named(column: str) -> Column:
    return F.col(f"`{column}`")


def numeric_columns(df: DataFrame, sample: str = "sample_id") -> list[str]:
    return [f.name for f in df.schema.fields if f.name != sample and isinstance(f.dataType, T.NumericType)]


def numeric_metrics(df: DataFrame, sample: str = "sample_id") -> list[str]:
    """Numeric columns that hold at least one value; one aggregation."""
    columns = numeric_columns(df, sample)
    filled = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if filled[c]]


def _missing_counts(wide: DataFrame, metrics: Sequence[str]) -> dict[tuple[str, str], int]:
    """For each ordered pair, rows that have the first metric but not the second.

    Index pairs are spread over the presence flags of a row and counted; at most one
    row per pair of columns comes back.
    """
    n = len(metrics)
    flags = wide.select(F.array(*[_named(m).isNotNull() for m in metrics]).alias("has")).filter(F.exists("has", lambda h: ~h))

    def places(wanted: bool) -> Column:
        return F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get("has", i) == wanted)

    apart = flags.select(F.explode(places(True)).alias("a"), places(False).alias("gaps")).select("a", F.explode("gaps").alias("b"))
    counted = {(r["a"], r["b"]): r["n"] for r in apart.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {
        (metrics[a], metrics[b]): counted.get((a, b), 0) for a in range(n) for b in range(n) if a != b
    }


def _band_products(batches: Iterator[pa.RecordBatch], centre: np.ndarray, pairs: np.ndarray, start: int, stop: int) -> Iterator[pa.RecordBatch]:
    """Sums of products of centred ranks over a task's samples, for pairs whose first ranking is in a band.

    ``centre`` has the mean rank of each ranking and ``pairs`` the columns a, b, i, j (metrics and
    rankings). A task keeps one matrix of band by rankings and sends one row per pair when its samples end.
    """
    n = len(centre)
    products, squares = np.zeros((stop - start, n)), np.zeros(n)
    rows = max(1, 2**21 // n)
    for batch in batches:
        lists = batch.column(0)
        for first in range(0, len(lists), rows):
            part = lists.slice(first, rows)
            cells = part.flatten()
            row = np.repeat(np.arange(len(part)), pc.list_value_length(part).to_numpy(zero_copy_only=False))
            ranking, rank = (cells.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            place = row * n + ranking
            if len(np.unique(place)) < len(place):
                raise ValueError("a sample has more than one row")
            block = np.zeros(len(part) * n)
            block[place] = rank - centre[ranking]
            block = block.reshape(len(part), n)
            products += block[:, start:stop].T @ block
            squares += (block * block).sum(axis=0)
    a, b, i, j = pairs
    yield pa.RecordBatch.from_arrays(
        [pa.array(a), pa.array(b), pa.array(squares[i]), pa.array(squares[j]), pa.array(products[i - start, j])],
        ["a", "b", "vx", "vy", "xy"],
    )


def spearman_pairs(wide: DataFrame, metrics: Sequence[str] | None = None, sample: str = "sample_id") -> DataFrame:
    """Rank correlation of every metric pair over the samples that have both; NaN is a missing value.

    A pair needs three samples and two distinct values on each side. Each metric is
    ranked once; where a partner is missing in some samples it is ranked once more for
    all partners missing in the same samples. Both rankings of a pair so cover the same
    samples, and centred ranks that are zero elsewhere make all pairs one matrix product:
    each task multiplies blocks of its samples and sends one row per pair, however many
    samples it has. Beyond 2,896 rankings the product is cut into bands of 64 MB, each a
    pass over the ranked table. The sample table is read several times and is written to
    the shared folder first; a sample with more than one row is an error.
    """
    floats = {f.name for f in wide.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    wide = cut_lineage(
        wide.select(*(F.when(~F.isnan(_named(c)), _named(c)).alias(c) if c in floats else _named(c) for c in wide.columns))
    )
    columns = list(metrics or numeric_columns(wide, sample))
    filled = wide.agg(*[F.count(_named(c)).alias(c) for c in columns]).first()
    metrics = [c for c in columns if metrics or filled[c]]
    missing = _missing_counts(wide, metrics)
    family: dict[str, str] = {}
    for m in metrics:
        same = [o for o in family.values() if o != m and missing[(m, o)] == 0 and missing[(o, m)] == 0]
        family[m] = same[0] if same else m

    rankings: dict[tuple[str, str], int] = {}

    def ranking(metric: str, partner: str) -> int:
        need = metric if missing[(metric, partner)] == 0 else family[partner]
        return rankings.setdefault((metric, need), len(rankings))

    number = {m: i for i, m in enumerate(metrics)}
    pairs = np.array(
        [(number[a], number[b], ranking(a, b), ranking(b, a)) for a, b in combinations(metrics, 2)], dtype=np.int32
    ).reshape(-1, 4)
    covered = np.array([filled[m] - missing.get((m, need), 0) for m, need in rankings], dtype=np.int64)
    cells = ", ".join(
        f"named_struct('ranking', {n}, 'value', if(`{need}` is not null, cast(`{metric}` as double), null))"
        for (metric, need), n in rankings.items()
    )
    spark = wide.sparkSession
    if not rankings:
        return spark.createDataFrame([], "metric_x string, metric_y string, pair_order int, n_samples bigint, spearman_rho double")
    long = wide.select(sample, F.expr(f"inline(array({cells}))")).filter("value is not null")
    ranked = average_rank(long, ["ranking"], "value")
    # One entry per ranking, so the list of a sample is as long as the table is wide.
    lists = ranked.groupBy(sample).agg(F.collect_list(F.struct("ranking", "rank")).alias("ranks")).select("ranks")
    band = max(1, BAND // len(rankings))
    if band < len(rankings):
        lists = cut_lineage(lists)

    def products(start: int) -> DataFrame:
        own = pairs[(pairs[:, 2] >= start) & (pairs[:, 2] < start + band)].T.copy()
        work = partial(_band_products, centre=(covered + 1) / 2, pairs=own, start=start, stop=min(start + band, len(rankings)))
        return lists.mapInArrow(work, "a int, b int, vx double, vy double, xy double")

    parts = reduce(DataFrame.unionByName, [products(start) for start in range(0, len(rankings), band)])
    sums = parts.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("vx", "vy", "xy")]).filter("vx > 0 and vy > 0")
    # A number per pair of columns, whatever the number of samples.
    sizes = np.zeros((len(metrics), len(metrics)), dtype=np.int64)
    sizes[pairs[:, 0], pairs[:, 1]] = covered[pairs[:, 2]]
    size = F.get(F.get(F.from_json(F.lit(str(sizes.tolist())), "array<array<bigint>>"), F.col("a")), F.col("b"))
    names = F.array(*[F.lit(m) for m in metrics])
    rho = F.expr("least(1.0D, greatest(-1.0D, xy / sqrt(vx * vy)))")
    return (
        sums.withColumn("n", size)
        .filter("n >= 3")
        .select(
            F.get(names, F.col("a")).alias("metric_x"),
            F.get(names, F.col("b")).alias("metric_y"),
            (F.col("a") * len(metrics) + F.col("b")).alias("pair_order"),
            F.col("n").alias("n_samples"),
            rho.alias("spearman_rho"),
        )
    )


def spearman_tests(pairs: DataFrame) -> DataFrame:
    """Add two-sided p-values and their Benjamini-Hochberg adjustment."""
    tested = pairs.withColumn("p_value", rank_correlation_p_udf("spearman_rho", F.col("n_samples").cast("double")))
    return bh_adjust(cut_lineage(tested), "p_value")


def correlation_matrix(pairs: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Square matrix with a unit diagonal; NULL where a pair was not testable."""
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("metric_x").alias("metric"), F.col("metric_y").alias("other"), F.col("spearman_rho").alias("rho")),
                F.struct(F.col("metric_y").alias("metric"), F.col("metric_x").alias("other"), F.col("spearman_rho").alias("rho")),
            )
        )
    )
    names = pairs.sparkSession.createDataFrame([(m, m, 1.0) for m in metrics], "metric string, other string, rho double")
    return (
        sides.unionByName(names)
        .groupBy("metric")
        .agg(*[F.max(F.when(F.col("other") == m, F.col("rho"))).alias(m) for m in metrics])
    )


def top_associations(pairs: DataFrame, k: int = 10) -> DataFrame:
    return pairs.orderBy(F.desc(F.abs("spearman_rho")), "metric_x", "metric_y").limit(k)


def condition_summary(wide: DataFrame, metrics: Sequence[str], condition: str = "condition") -> DataFrame:
    """Samples and mean metrics per condition; a missing condition is a group of its own."""
    return wide.groupBy(condition).agg(
        F.count(F.lit(1)).alias("sample_count"), *[F.avg(m).alias(m) for m in metrics]
    )
