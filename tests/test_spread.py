import collections
"""Steps whose share in one task must not grow with the table, and tables that are made once."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from locusloom.functions import text
from locusloom.operators import burden, cells
from locusloom.plans import file_queries, files


def counted(spark, frame):
    """The frame, and an accumulator of how many of its rows were made."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    return frame.mapInArrow(run, frame.schema), made


@pytest.mark.parametrize("ranges", [1, 8])
def test_a_file_is_strung_together_from_ranges(spark, tmp_path, monkeypatch, ranges):
    joined, original = [], files._joined
    monkeypatch.setattr(files, "_joined", lambda folder: joined.append(folder) or original(folder))
    rows = [(name, i, f"{name} {i}") for name in ("a/x=1 é.txt", "b%2F.txt") for i in range(3000)]
    random.Random(2).shuffle(rows)
    lone = [("c.txt", 5, "only")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(ranges == 1).lower())
    try:
        folder = files.named_files(spark, spark.createDataFrame(rows + lone, "name string, line_order long, value string"), str(tmp_path / "made"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(joined) == (ranges > 1)
    for name in ("a/x=1 é.txt", "b%2F.txt"):
        with open(f"{folder}/{name}", encoding="utf-8") as held:
            assert held.read().splitlines() == [f"{name} {i}" for i in range(3000)]
    with open(f"{folder}/c.txt", encoding="utf-8") as held:
        assert held.read() == "only\n"


def test_cell_counts_stay_spread(spark):
    seen = spark.createDataFrame([("s", f"B{i % 9}-1", "chr1", i % 50, "ACGT"[i % 4]) for i in range(400)], "sample_id string, barcode string, chrom string, pos long, base string")
    sites = spark.createDataFrame([("chr1", p, "A", "C") for p in range(50)], "chrom string, pos long, ref string, alt string")
    got = cells.cell_allele_counts(seen, sites)
    tasks = cells.TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    with_part = got.withColumn("part", F.spark_partition_id())
    assert with_part.select("part").distinct().count() > 1 and with_part.agg(F.max("part")).first()[0] < tasks
    assert got.agg(F.sum("dp")).first()[0] == 200


def test_natural_sort_text_orders_as_the_key(spark):
    rng = random.Random(5)
    names = ["", "a", "a1", "a01", "a2", "a10", "a10b", "b", "ab", "a 1", "é1", "a1b2", "a1b10", "a1b", "10", "9", "a" + "9" * 38, "A1", "a!", "a\x001"]
    names += ["".join(rng.choice("ab1290 _é") for _ in range(rng.randrange(8))) for _ in range(300)]
    frame = spark.createDataFrame([(n,) for n in dict.fromkeys(names)], "n string")
    by_key = [r[0] for r in frame.orderBy(F.struct(*text.natural_sort_key(F.col("n")))).collect()]
    assert [r[0] for r in frame.orderBy(text.natural_sort_text(F.col("n"))).collect()] == by_key


def test_tables_that_are_read_twice_are_made_once(spark, monkeypatch):
    long, made = counted(spark, spark.createDataFrame([("g", "n", "S1", 3), ("h", "n", "S2", 4)], "gene_id string, gene_name string, sample_id string, n long"))
    table = spark.createDataFrame([("g", "n"), ("k", "n")], "gene_id string, gene_name string")
    got = burden.burden_wide(long, table, ["S1", "S2"]).orderBy("gene_id").collect()
    assert [tuple(r) for r in got] == [("g", "n", 3, 0), ("h", "n", 0, 4), ("k", "n", 0, 0)] and made.value == 2
    sums = [("S1", "chr1", p, "A", "C", "c0", 4, 8, 0.5) for p in range(3)]
    fields = "sample_id string, chrom string, pos long, ref string, alt string, cluster string, alt_sum long, depth_sum long, vaf double"
    frame, made = counted(spark, spark.createDataFrame(sums, fields))
    monkeypatch.setattr(file_queries, "cluster_sums", lambda spark, sf: frame)
    assert file_queries._cluster_rows(spark, "").count() == 4 and made.value == 3


def _burden_rows(spark):
    calls = [("c", p, "A", "G" if p % 2 else "T,C", s) for p in range(4000, 4300) for s in ("S0", "S1", None) if (p + len(s or "")) % 3]
    calls += [("c", None, "A", "G", "S0"), (None, 4000, "A", "G", "S0")]
    variants = spark.createDataFrame(calls + calls[:50], "chrom string, pos long, ref string, alt string, sample_id string")
    loci = [("c", p, "A", "G" if p % 2 else "T", g, n) for p in range(4050, 4250) for g, n in (("g1", "a"), ("g1", None), (None, "b")) if p % 5]
    annotated = spark.createDataFrame(loci + loci[:30], "chrom string, pos long, ref string, alt string, gene_id string, gene_name string")
    called = {(c, p, r, a.split(",")[0], s) for c, p, r, a, s in calls if c and p}
    want = collections.Counter((g, n, s) for c, p, r, a, g, n in set(loci) for s in ("S0", "S1", None) if (c, p, r, a, s) in called)
    return variants, annotated, want


def test_burden_counts_nulls_and_copies_over_stretches(spark):
    variants, annotated, want = _burden_rows(spark)
    found = burden.burden_long(variants, annotated).collect()
    assert {(r["gene_id"], r["gene_name"], r["sample_id"]): r["n"] for r in found} == want and len(found) == len(want)


@pytest.mark.parametrize("meetings", [1, burden.MEETINGS])
def test_a_stretch_adds_up_its_burden(monkeypatch, meetings):
    """What leaves a stretch is a row per gene and sample, however many loci meet there."""
    monkeypatch.setattr(burden, "MEETINGS", meetings)
    rows = [("A", "G", p, "S%d" % (p % 2), None, None, True) for p in range(300)] + [("A", "G", p, None, "g", "n", False) for p in range(300)]
    names = ["ref", "alt", "pos", "sample_id", "gene_id", "gene_name", "_call"]
    table = pa.table({c: pa.chunked_array([list(v)]) for c, v in zip(names, zip(*rows))})
    assert burden._meet(table).to_pylist() == [{"gene_id": "g", "gene_name": "n", "sample_id": s, "n": 150} for s in ("S0", "S1")]
