"""Readers and writers on small files."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from locusloom.operators import cells, checks, cohort, intervals, metadata
from locusloom.operators.checks import InputError
from locusloom.operators.runlog import contig_offsets, table_preview
from locusloom.sources import genomic, tables, writers
from locusloom.sources.lines import list_files, number_lines, read_lines


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if path.endswith(".gz") else open
    with opener(path, "wt", encoding="utf-8") as f:
        f.write(content)
    return str(path)


def lines_of(folder, packed=False):
    out = []
    for name in sorted(os.listdir(folder)):
        if name.startswith("part-"):
            opener = gzip.open if name.endswith(".gz") else open
            with opener(os.path.join(folder, name), "rt", encoding="utf-8") as f:
                out += f.read().splitlines()
    return out


VCF = "##fileformat=VCFv4.2\n##x=1\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{s}\n"


def test_line_numbers_across_splits(spark, tmp_path):
    wanted = {}
    for name, n in (("a.txt", 4000), ("b.txt", 2500), ("c.txt.gz", 700), ("d.txt", 1)):
        rows = [f"{name}:{i}:" + "x" * (i % 37) for i in range(n)]
        put(str(tmp_path / name), "\n".join(rows) + "\n")
        wanted.update({r: i for i, r in enumerate(rows)})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        lines = read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        got = {r["value"]: r["line_no"] for r in number_lines(lines).collect()}
        ordered = {}
        for r in sorted(lines.collect(), key=lambda r: r["line_order"]):
            ordered.setdefault(r["file_path"], []).append(r["value"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == wanted
    # line_order alone already follows each file
    assert all([wanted[v] for v in rows] == list(range(len(rows))) for rows in ordered.values())


def test_vcf_cohort_round_trip(spark, tmp_path):
    body = {
        "A": "chr2\t5\t.\tA\tC\t9\tPASS\tDP=1\tGT:AF\t0/1:0.1\nchr2\t5\t.\tA\tC\t8\tPASS\tDP=9\tGT:AF\t0/1:0.9\nchr10\t7\tr\tG\tT,A\t9\tPASS\t.\tGT:AD\t0/1:3,1\nshort\t1\n",
        "B": "chr2\t5\tb\tA\tC\t7\tPASS\tDP=2\tGT:AF\t0/1:0.3\nchr10\t7\t.\tG\tT,A\t1\tPASS\tDP=4\nchr10\t8\t.\tG\tT\t9\n",
        "C": "chr10\t7\t.\tG\tT\t9\tPASS\t.\tGT\t0/1\n",
    }
    for s, text in body.items():
        put(str(tmp_path / f"{s}.filtered.vcf"), VCF.format(s=s) + text)
    calls = genomic.read_vcf(spark, str(tmp_path), min_columns=8)
    loci = cohort.cohort_loci(calls, 2, 0.05, unit="file_path", order="line_order", with_first=True)
    found = {(r["chrom"], r["pos"], r["alt"]): (r["cohort_count"], r["max_af"]) for r in loci.collect()}
    # the repeated record of A does not count, neither once more nor with its fraction
    assert found == {("chr2", 5, "C"): (2, 0.3), ("chr10", 7, "T,A"): (2, 1.0)}
    full = cohort.first_records(calls, loci, ["id", "qual", "filter", "info"], "file_path", "line_order")
    header = genomic.vcf_header(spark, str(tmp_path / "A.filtered.vcf"))
    assert len(header) == 3
    out = str(tmp_path / "out")
    writers.write_vcf(cohort.cohort_records(full), header, out)
    assert lines_of(out) == [
        "##fileformat=VCFv4.2",
        "##x=1",
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",
        "chr10\t7\tr\tG\tT,A\t9\tPASS\tCOHORT_COUNT=2;MAX_AF=1.000000",
        "chr2\t5\t.\tA\tC\t9\tPASS\tDP=1;COHORT_COUNT=2;MAX_AF=0.300000",
    ]


def test_count_by_file_counts_every_copy(spark, tmp_path):
    record = "chr1\t5\t.\tA\tC\t9\tPASS\t.\tGT:AF\t0/1:0.5\n"
    for name in ("S.raw.vcf", "S.filtered.vcf"):
        put(str(tmp_path / name), VCF.format(s="S") + record)
    calls = genomic.read_vcf(spark, str(tmp_path), 8)
    assert cohort.cohort_loci(calls, 1).first()["cohort_count"] == 1
    assert cohort.cohort_loci(calls, 1, unit="file_path").first()["cohort_count"] == 2


def test_hard_filter_from_info(spark, tmp_path):
    put(
        str(tmp_path / "S.vcf"),
        VCF.format(s="S")
        + "1\t1\t.\tA\tC\t.\t.\tQD=1.5;FS=31;MQ=50;SOR=1\tGT\t0/1\n1\t2\t.\tA\tC\t.\t.\tQD=2;FS=30;MQ=40;SOR=3\tGT\t0/1\n1\t3\t.\tA\tC\t.\t.\t.\tGT\t0/1\n",
    )
    calls = genomic.read_vcf(spark, str(tmp_path), 8)
    rows = cohort.hard_filter(calls, genomic.info_numbers(["QD", "FS", "MQ", "SOR"])).orderBy("pos").collect()
    assert [r["filter"] for r in rows] == ["LowQD;HighFS", "PASS", "PASS"]


GTF = '#!x\nchr1\ts\tgene\t100\t200\t.\t+\t.\tgene_id "G1"; gene_name "ONE";\nchr1\ts\ttranscript\t1\t999\t.\t+\t.\tgene_id "G1"; gene_name "ONE";\nchr1\ts\tgene\t5\t9\t.\t+\t.\tother "x";\nchr1\ts\tgene\t300\t310\t.\t-\t.\tgene_id "G2"; gene_id "G3";\nshort\trow\n'


def test_gtf_genes_and_fallback(spark, tmp_path):
    genes = genomic.read_genes(spark, put(str(tmp_path / "g.gtf.gz"), GTF))
    got = {(r["gene_id"], r["gene_name"], r["start"], r["end"], r["strand"]) for r in genes.collect()}
    assert got == {("G1", "ONE", 100, 200, "+"), ("G3", "G3", 300, 310, "-")}
    only = "".join(
        f'chr1\ts\ttranscript\t{a}\t{b}\t.\t{st}\t.\tgene_id "G1";\n' for a, b, st in ((50, 60, "-"), (10, 20, "+"), (40, 90, "+"))
    )
    genes = genomic.read_genes(spark, put(str(tmp_path / "t.gtf"), only)).collect()
    assert [(r["start"], r["end"], r["strand"], r["gene_name"]) for r in genes] == [(10, 90, "-", "G1")]
    with pytest.raises(InputError):
        genomic.read_genes(spark, put(str(tmp_path / "e.gtf"), "#x\n"))


def test_matrix_market_to_cluster_counts(spark, tmp_path):
    mm = "%%MatrixMarket matrix coordinate integer general\n% c\n"
    for s, ad, dp in (("S1", "3 4 4\n1 1 2\n1 2 3\n2 4 9\n3 3 1\n", "3 4 5\n1 1 4\n1 2 6\n2 4 9\n3 3 2\n2 1 5\n"),):
        put(str(tmp_path / s / "cellSNP.tag.AD.mtx"), mm + ad)
        put(str(tmp_path / s / "cellSNP.tag.DP.mtx.gz"), mm + dp)
        codes = ["AAAAAAAAAAAAAAAA", "CCCCCCCCCCCCCCCC", "GGGGGGGGGGGGGGGG", "TTTTTTTTTTTTTTTT"]
        put(str(tmp_path / s / "cellSNP.samples.tsv"), "".join(c + "-1\textra\n" for c in codes))
        put(str(tmp_path / s / "cellSNP.base.vcf"), "#h\n" + "".join(f"chr1\t{p}\t.\tA\tC,G\n" for p in (10, 20, 30)))
        put(str(tmp_path / s / "cellSNP.variants.tsv"), "".join(f"chr1\t{p}\tA\tC\n" for p in (10, 20, 30)))
    cell_map = "sample\tcell_id\tcluster\n" + "".join(
        f"S1\tS1_{c}-1\t{k}\n" for c, k in zip(codes, ("zero", "k1", "k2", "k3"))
    ) + f"S1\tS1_{codes[0]}-1\tk1\nbad\n"
    sample = F.element_at(F.split("file_path", "/"), -2)

    def at(df):
        return df.withColumn("sample_id", sample)

    ad, ad_shape = tables.read_matrix_market(spark, str(tmp_path / "S1" / "cellSNP.tag.AD.mtx"))
    dp, dp_shape = tables.read_matrix_market(spark, str(tmp_path / "S1" / "cellSNP.tag.DP.mtx.gz"))
    codes_df = at(tables.read_barcodes(spark, str(tmp_path / "S1" / "cellSNP.samples.tsv")))
    aligned = cells.align_matrices(at(ad), at(dp))
    clusters = cells.cluster_lookup(tables.read_cell_map(spark, put(str(tmp_path / "map.tsv"), cell_map)), "line_no")
    for name, vcf in (("cellSNP.base.vcf", True), ("cellSNP.variants.tsv", False)):
        listed = at(tables.read_cell_variants(spark, str(tmp_path / "S1" / name), vcf))
        assert cells.matrix_shape_violations(at(ad_shape), at(dp_shape), listed).isEmpty()
        sums = cells.cluster_allele_sums(cells.matrix_cells(aligned, listed, codes_df), clusters, 3)
        got = {(r["pos"], r["cluster"], r["alt_sum"], r["depth_sum"], r["vaf"]) for r in sums.collect()}
        # the last map row of the first cell wins, so it joins the second cell's cluster
        assert got == {(10, "k1", 5, 10, 0.5), (20, "k3", 9, 9, 1.0)}
    fewer = listed.filter("idx < 3")
    assert cells.matrix_shape_violations(at(ad_shape), at(dp_shape), fewer).count() == 1
    out = str(tmp_path / "S1.cellsnp.cluster_counts.tsv.gz")
    writers.write_tsv(cells.cluster_sums_text(sums.drop("sample_id")).orderBy("pos"), out)
    back = tables.read_tsv(spark, out, tables.CLUSTER_SCHEMA)
    assert {(r["pos"], r["vaf"]) for r in back.collect()} == {(10, 0.5), (20, 1.0)}


def test_cluster_counts_take_one_copy(spark, tmp_path):
    head = "chrom\tpos\tref\talt\tcluster\talt_sum\tdepth_sum\tvaf\n"
    put(str(tmp_path / "S1.cellsnp.cluster_counts.tsv"), head + "chr1\t1\tA\tC\tk\t3\t6\t0.500000\n")
    put(str(tmp_path / "S1.cellsnp.cluster_counts.tsv.gz"), head + "chr1\t1\tA\tC\tk\t3\t6\t0.500000\n")
    put(str(tmp_path / "S2.cellsnp.cluster_counts.tsv.gz"), head + "chr1\t1\tA\tC\tk\t4\t4\t1.000000\n")
    sums = tables.read_cluster_counts(spark, str(tmp_path))
    metrics = {r["sample_id"]: r for r in cells.cluster_metrics(sums).collect()}
    assert metrics["S1"]["cluster_variant_rows"] == 1 and metrics["S2"]["cluster_mean_vaf"] == 1.0
    everyone = spark.createDataFrame([("S1",), ("S3",)], "sample_id string")
    filled = {r["sample_id"]: r["cluster_alt_sum_total"] for r in cells.cluster_metrics(sums, everyone).collect()}
    assert filled == {"S1": 3.0, "S3": 0.0}


def test_other_barcode_map(spark, tmp_path):
    path = put(str(tmp_path / "m.tsv"), "barcode\tsample_id\tcluster\nAC\tS1\tk\n")
    assert tables.read_barcode_map(spark, path).first().asDict() == {"sample_id": "S1", "barcode": "AC", "cluster": "k"}
    with pytest.raises(InputError):
        tables.read_barcode_map(spark, put(str(tmp_path / "n.tsv"), "cell\tcluster\nAC\tk\n"))


def test_fastq_records_and_merge(spark, tmp_path):
    def fastq(codes, q):
        return "".join(f"@r{i}\n{c}\n+\n{q * len(c)}\n" for i, c in enumerate(codes))

    put(str(tmp_path / "S_R2.fastq"), fastq(["ACGTACGTACGTACGT", "TTTTTTTTTTTTTTTT"], "I"))
    put(str(tmp_path / "S_R3.fastq.gz"), fastq(["AAAAAAAAAA", "CCCCCCCCCC"], "F"))

    def read(name):
        return tables.read_fastq(spark, str(tmp_path / name)).withColumn("sample_id", F.lit("S"))

    merged = cells.merge_barcode_reads(read("S_R2.fastq"), read("S_R3.fastq.gz"))
    first = merged.orderBy("record_idx").first()
    assert (first["header"], first["seq"], first["qual"]) == ("@r0", "ACGTACGTACGTACGT" + "A" * 10, "I" * 16 + "F" * 10)
    split = cells.split_cb_umi(merged).orderBy("record_idx").first()
    assert (split["cb"], split["umi"]) == ("ACGTACGTACGTACGT", "A" * 10)
    out = str(tmp_path / "merged")
    writers.write_fastq(merged, out)
    assert lines_of(out)[:4] == ["@r0", "ACGTACGTACGTACGT" + "A" * 10, "+", "I" * 16 + "F" * 10]
    put(str(tmp_path / "T_R3.fastq"), fastq(["AAAAAAAAAA"], "F"))
    with pytest.raises(Exception, match="differ in length"):
        cells.merge_barcode_reads(read("S_R2.fastq"), read("T_R3.fastq")).collect()
    put(str(tmp_path / "U_R3.fastq"), "@r0\nAAAA\n+\nFFFF\n@r1\nAA\n")
    with pytest.raises(Exception, match="malformed"):
        read("U_R3.fastq").collect()
    put(str(tmp_path / "V_R3.fastq"), "@r0\n\n+\n\n@r1\nCC\n+\nFF\n")
    with pytest.raises(Exception, match="malformed"):
        cells.merge_barcode_reads(read("S_R2.fastq"), read("V_R3.fastq")).collect()


def test_metadata_against_read_files(spark, tmp_path):
    for name in ("a/S1_R1.fastq.gz", "a/b/S1_r2_001.fq", "S2_R3.FASTQ", "S2_R1.fq", "S2_R1.fastq.gz", "x.txt"):
        put(str(tmp_path / "fq" / name), "x")
    files = metadata.read_files(list_files(spark, str(tmp_path / "fq")))
    reads = metadata.reads_per_sample(files)
    assert {r["sample_id"]: r["reads"] for r in reads.collect()} == {"S1": ["R1", "R2"], "S2": ["R1", "R3"]}
    chosen = {(r["sample_id"], r["read"]): r["path"].rsplit("/", 1)[1] for r in metadata.read_path(files).collect()}
    assert chosen[("S2", "R1")] == "S2_R1.fastq.gz"
    sheet = tables.read_metadata(spark, put(str(tmp_path / "m.tsv"), "sample_id\tcondition\trun_id\n S1 \td\t1\n\td\t2\nS2\tc\t3\n"))
    assert metadata.clean_metadata(sheet, reads).count() == 2
    flags = {r["sample_id"]: r["has_R3"] for r in metadata.read_flags(sheet, reads).collect()}
    assert flags == {"S1": False, "S2": True}
    overview = {r["metric"]: r["value"] for r in metadata.input_overview(metadata.read_flags(sheet, reads)).collect()}
    assert overview == {"n_samples": 2, "n_samples_with_R3": 1}
    wrong = tables.read_metadata(spark, put(str(tmp_path / "w.csv"), "sample_id,condition,run_id\nS9,c,1\nS1,c,2\n"))
    with pytest.raises(InputError, match="S9"):
        metadata.clean_metadata(wrong, reads)
    with pytest.raises(InputError, match="run_id"):
        tables.read_metadata(spark, put(str(tmp_path / "v.tsv"), "sample_id\tcondition\nS1\tc\n"))
    with pytest.raises(InputError, match="empty"):
        tables.read_metadata(spark, put(str(tmp_path / "e.tsv"), "sample_id\tcondition\trun_id\n"))


def test_small_readers(spark, tmp_path):
    sets = genomic.read_gene_sets(spark, put(str(tmp_path / "s.gmt"), "T1\tdesc\tA\tB\nT2\td\tC\nbad\n"))
    assert {(r["term"], r["gene"]) for r in sets.collect()} == {("T1", "A"), ("T1", "B"), ("T2", "C")}
    drivers = genomic.read_gene_list(spark, put(str(tmp_path / "d.txt"), "TP53\n\n  KRAS \nTP53\n"))
    assert sorted(r[0] for r in drivers.collect()) == ["KRAS", "TP53"]
    contigs = genomic.read_contigs(spark, put(str(tmp_path / "g.fai"), "chr2\t10\t0\nchr1\t7\t1\nx\nchr10\t5\t2\n"))
    got = {r["contig"]: (r["offset"], r["total"]) for r in contig_offsets(contigs, "line_no").collect()}
    assert got == {"chr2": (0, 22), "chr1": (10, 22), "chr10": (17, 22)}
    for s, name, n in (("S1", "barcodes.tsv", 3), ("S1", "barcodes.tsv.gz", 5), ("S2", "barcodes.tsv.gz", 2)):
        put(str(tmp_path / "solo" / s / "Solo.out" / "Gene" / "filtered" / name), "b\n" * n)
    put(str(tmp_path / "solo" / "S1" / "Solo.out" / "Gene" / "raw" / "barcodes.tsv"), "b\n" * 9)
    counts = cells.first_file_cells(tables.read_detected_cells(spark, str(tmp_path / "solo")))
    assert {r[0]: r[1] for r in counts.collect()} == {"S1": 3, "S2": 2}
    config = put(str(tmp_path / "c.json"), '{"stages": [{"id": "s1", "description": "d", "estimate_seconds": 60}]}')
    assert tables.read_stage_config(spark, config).first().asDict() == {"stage": "s1", "description": "d", "estimate_seconds": 60}
    logs = tables.read_tool_logs(spark, put(str(tmp_path / "SRR1.gatk.log"), "a\nb\n"))
    assert {(r["sample_id"], r["line_no"], r["line"]) for r in logs.collect()} == {("SRR1", 0, "a"), ("SRR1", 1, "b")}


def test_csv_matrix_and_preview(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, 0.5), ("b", 0.5, 1.0)], "metric string, a double, b double")
    writers.write_matrix(df.coalesce(1), str(tmp_path / "m"), "metric")
    assert lines_of(str(tmp_path / "m")) == ["metric\ta\tb", "a\t1.0\t0.5", "b\t0.5\t1.0"]
    writers.write_csv(df.coalesce(1), str(tmp_path / "c"))
    assert lines_of(str(tmp_path / "c"))[0] == "metric,a,b"
    assert table_preview(spark.range(300)) == {"columns": 1, "header": ["id"], "rows_sampled": 200, "truncated": True}
    manifest = spark.createDataFrame([("01", "b", "t2"), ("01", "a", "t1")], "stage string, source string, target string")
    writers.write_manifest(manifest.coalesce(1), str(tmp_path / "k"))
    assert lines_of(str(tmp_path / "k"))[1] == "01\ta\tt1"


def test_counted_write_and_abort(spark, tmp_path):
    rows, seen = checks.counted(spark.range(5), "kept", top=F.max("id"))
    rows.write.parquet(str(tmp_path / "p"))
    assert checks.require_counts(seen, "nothing selected") == {"rows": 5, "top": 4}
    rows, seen = checks.counted(spark.range(5).filter("id > 9"), "none")
    rows.write.parquet(str(tmp_path / "q"))
    with pytest.raises(InputError, match="nothing selected"):
        checks.require_counts(seen, "nothing selected")


def test_annotation_against_brute_force(spark):
    import random

    rng = random.Random(3)
    genes = [(f"chr{rng.randint(1, 2)}", a, a + rng.choice([0, 5, 80, 900]), "+", f"G{i % 30}", f"N{i % 30}") for i, a in enumerate(rng.sample(range(-50, 2000), 60))]
    points = sorted({(f"chr{rng.randint(1, 3)}", rng.randint(1, 2500)) for _ in range(400)})
    gdf = spark.createDataFrame(genes, "chrom string, start long, end long, strand string, gene_id string, gene_name string")
    pdf = spark.createDataFrame([(c, p, "A", "C,G") for c, p in points], "chrom string, pos long, ref string, alt string")
    want = sorted({(c, p, g[4]) for c, p in points for g in genes if g[0] == c and g[1] <= p <= g[2]})
    for size in (None, 1, 64, 100_000):
        rows = intervals.annotate_variants(pdf, gdf, size).collect()
        assert sorted((r["chrom"], r["pos"], r["gene_id"]) for r in rows) == want and all(r["alt"] == "C" for r in rows)
    spread = intervals.interval_join(pdf, gdf, bin_size=64, salts=4)
    plain = intervals.interval_join(pdf, gdf, bin_size=64)
    assert spread.count() == plain.count() and spread.exceptAll(plain).isEmpty()
