"""Gene burden: distinct cohort variants per gene and sample, totals, hits, enrichment."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.functions.tails import hypergeometric_upper_udf
from locusloom.functions.text import INTEGRATION_SUFFIXES, first_alt, normalize_sample_id
from locusloom.operators import checks
from locusloom.operators.ordered import bh_adjust
from locusloom.session import cut_lineage

LOCUS = ["chrom", "pos", "ref", "alt"]
GENE = ["gene_id", "gene_name"]
STRETCH = 4096
MEETINGS = 1 << 20


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """A number for each value, null among them, and the values."""
    coded = pc.dictionary_encode(pa.concat_arrays(column.chunks), null_encoding="encode")
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _meet(rows: pa.Table) -> pa.Table:
    """Loci per gene and sample of one stretch, from its calls and its (locus, gene) rows."""
    (ref, refs), (alt, alts), (gene, genes), (name, names), (sample, samples) = (
        _codes(rows.column(c)) for c in ("ref", "alt", *GENE, "sample_id")
    )
    pos = rows.column("pos").to_numpy().astype(np.int64)
    locus = ((pos - pos.min()) * len(refs) + ref) * len(alts) + alt
    is_call = rows.column("_call").to_numpy()
    order = np.flatnonzero(is_call)[np.argsort(locus[is_call], kind="stable")]
    called, by = locus[order], sample[order]
    kinds, kind = np.unique(gene[~is_call] * len(names) + name[~is_call], return_inverse=True)
    pairs = np.unique(locus[~is_call] * max(1, len(kinds)) + kind)
    at, kind = np.divmod(pairs, max(1, len(kinds)))
    first, last = np.searchsorted(called, at), np.searchsorted(called, at, side="right")
    met = np.cumsum(last - first)
    n = np.zeros(len(kinds) * len(samples), np.int64)
    begin = 0
    while begin < len(at):  # some pairs at a time, so that what they meet stays small
        end = max(begin + 1, int(np.searchsorted(met, (met[begin - 1] if begin else 0) + MEETINGS, side="right")))
        size = (last - first)[begin:end]
        call = np.arange(size.sum()) + np.repeat(first[begin:end] - np.cumsum(size) + size, size)
        n += np.bincount(np.repeat(kind[begin:end], size) * len(samples) + by[call], minlength=len(n))
        begin = end
    found = np.flatnonzero(n)
    which, who = np.divmod(found, max(1, len(samples)))
    columns = [genes.take(pa.array(kinds[which] // len(names))), names.take(pa.array(kinds[which] % len(names))), samples.take(pa.array(who)), pa.array(n[found])]
    return pa.Table.from_arrays(columns, [*GENE, "sample_id", "n"])


def burden_long(variants: DataFrame, annotated: DataFrame, sample: str = "sample_id") -> DataFrame:
    """Distinct annotated variants per gene and sample: ``(gene_id, gene_name, sample_id, n)``.

    Sample calls are reduced to distinct (locus, sample) rows first, so a locus called over
    and over brings one row per sample. Calls and genes meet by locus in stretches of
    ``STRETCH`` positions, whose rows the distinct loci bound; the loci of a gene are in few
    stretches, and each adds up its counts before these are shuffled.
    """
    calls = variants.select("chrom", "pos", "ref", first_alt(F.col("alt")).alias("alt"), F.col(sample).alias("sample_id")).distinct()
    called = calls.select(*LOCUS, "sample_id", F.lit(True).alias("_call"))
    genes = annotated.select(*LOCUS, *GENE, F.lit(False).alias("_call"))
    rows = called.unionByName(genes, allowMissingColumns=True).dropna(subset=LOCUS)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{c} {types[c]}" for c in (*GENE, "sample_id")) + ", n long"
    met = rows.withColumn("_stretch", F.floor(F.col("pos") / STRETCH)).groupBy("chrom", "_stretch").applyInArrow(_meet, schema)
    return met.groupBy(*GENE, "sample_id").agg(F.sum("n").alias("n"))


def burden_wide(long: DataFrame, annotated: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Gene by sample matrix with zeros; genes without a call in any sample stay in.

    The caller names the columns; a sample of the long table that has none stops the query
    with an error instead of vanishing.
    """
    long = cut_lineage(long)  # read by the check and by the matrix
    named = F.col("sample_id").isin(list(samples))
    checks.require_empty(long.filter(~named).select("sample_id").distinct(), "samples without a matrix column")
    empty = annotated.select(*GENE).distinct().withColumn("sample_id", F.lit(None).cast("string"))
    rows = long.select(*GENE, "sample_id", "n").unionByName(empty.withColumn("n", F.lit(0).cast("long")))
    cells = [F.coalesce(F.sum(F.when(F.col("sample_id") == s, F.col("n"))), F.lit(0)).alias(s) for s in samples]
    return rows.groupBy(*GENE).agg(*cells)


def wide_to_long(matrix: DataFrame) -> DataFrame:
    """Non-zero cells of a gene by sample matrix."""
    samples = [c for c in matrix.columns if c not in GENE]
    long = matrix.unpivot(GENE, samples, "sample_id", "n")
    return long.filter(F.col("n") > 0)


def burden_totals(long: DataFrame, sample: str = "sample_id") -> DataFrame:
    """Burden total and number of burdened genes per normalised sample id."""
    return long.groupBy(normalize_sample_id(F.col(sample), INTEGRATION_SUFFIXES).alias("sample_id")).agg(
        F.sum("n").cast("double").alias("gene_burden_total"),
        F.count_if(F.col("n") > 0).alias("burdened_gene_count"),
    )


def top_genes(long: DataFrame, k: int) -> DataFrame:
    totals = long.groupBy(*GENE).agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("n_samples"))
    return totals.orderBy(F.desc("total"), "gene_id").limit(k)


def driver_hits(long: DataFrame, drivers: DataFrame, gene: str = "gene_name") -> DataFrame:
    """Burden in driver genes per sample; samples without a hit are reported with zeros."""
    marked = long.join(drivers.select(F.col(drivers.columns[0]).alias(gene)).distinct().withColumn("_d", F.lit(1)), gene, "left")
    hit = F.col("_d").isNotNull() & (F.col("n") > 0)
    return marked.groupBy("sample_id").agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("driver_hits"),
        F.count_distinct(F.when(hit, F.col(gene))).alias("driver_genes"),
    )


def pathway_enrichment(hits: DataFrame, gene_sets: DataFrame, universe: DataFrame, gene: str = "gene") -> DataFrame:
    """Over-representation of hit genes per gene set: counts, upper-tail p and BH over the sets.

    Each frame has the gene column; sets add ``term``. Genes outside the universe are ignored.
    """
    known = universe.select(gene).distinct()
    drawn = hits.select(gene).distinct().join(known, gene, "left_semi").withColumn("_hit", F.lit(1))
    members = gene_sets.select("term", gene).distinct().join(known, gene, "left_semi").join(drawn, gene, "left")
    counts = members.groupBy("term").agg(
        F.count(F.lit(1)).alias("set_size"), F.count("_hit").alias("overlap")
    )
    sized = counts.withColumn("universe", known.agg(F.count(F.lit(1))).scalar()).withColumn(
        "n_hits", drawn.agg(F.count(F.lit(1))).scalar()
    )
    tested = sized.withColumn("p_value", hypergeometric_upper_udf("overlap", "universe", "set_size", "n_hits"))
    return bh_adjust(cut_lineage(tested), "p_value")
