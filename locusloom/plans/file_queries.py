"""Registered queries that write files with the sinks and read them with the readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.functions.text import file_name
from locusloom.operators import association, cells, checks, folds, intervals, runlog
from locusloom.operators.checks import InputError
from locusloom.plans import files
from locusloom.plans.oracles import ORACLES, oracle
from locusloom.plans.queries import (
    METRICS,
    cluster_sums,
    full_cohort_records,
    gene_burden_wide,
    integrated,
    listed_files,
    merged_reads,
    plain_time,
    query,
    rounded,
    variants,
    vcf_folder,
)
from locusloom.plans.views import view
from locusloom.session import cut_lineage, shared_folder
from locusloom.sources import blockgzip, genomic, lines, tables, writers


def _place(spark, name: str) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}/{name}"


def _named(df: DataFrame, name, order, value) -> DataFrame:
    return df.select(name.alias("name"), order.cast("long").alias("line_order"), value.alias("value"))


def _tabbed(*columns):
    return F.concat_ws("\t", *[F.col(c).cast("string") if isinstance(c, str) else c for c in columns])


# ---- tables --------------------------------------------------------------------------


@query
def tsv_round_trip(spark, sf):
    place = _place(spark, "customers.tsv")
    writers.write_tsv(view(spark, sf, "fx_customers"), place)
    return tables.read_tsv(spark, place, "sample_id long, label string, gsm string")


oracle("tsv_round_trip", ("fx_customers",), "select * from fx_customers")


@query
def tsv_gzip_round_trip(spark, sf):
    place = _place(spark, "parts.tsv.gz")
    writers.write_tsv(view(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size"), place)
    return lines.read_lines(spark, place).filter("value not like 'p_partkey%'").select("value")


oracle(
    "tsv_gzip_round_trip",
    (),
    "select concat_ws(chr(9), cast(p_partkey as string), p_name, p_brand, cast(p_size as string)) as value from part",
)


@query
def metadata_sheet(spark, sf):
    """Sample sheet as CSV, its required columns, and its first row per sample."""
    place = _place(spark, "sheet.csv")
    sheet = view(spark, sf, "fx_customers").select(
        F.concat(F.lit("S"), F.col("sample_id").cast("string")).alias("sample_id"),
        F.col("label").alias("condition"),
        F.col("gsm").alias("run_id"),
    )
    writers.write_csv(sheet, place)
    return association.first_metadata(tables.read_metadata(spark, place), "condition").select("sample_id", "condition", "run_id")


oracle(
    "metadata_sheet",
    ("fx_customers",),
    "select 'S' || cast(sample_id as string) as sample_id, label as condition, gsm as run_id from fx_customers",
)


@query
def stage_config(spark, sf):
    """Configured stages of a JSON document, read from a file."""
    place = _place(spark, "stages")
    stage = F.struct(
        F.col("stage").alias("id"), F.lit("planned").alias("description"), F.col("estimate_seconds").cast("long").alias("estimate_seconds")
    )
    stages = view(spark, sf, "fx_stage_events").select("stage", "estimate_seconds").distinct()
    stages.agg(F.to_json(F.struct(F.array_sort(F.collect_list(stage)).alias("stages"))).alias("value")).write.text(place)
    return tables.read_stage_config(spark, place)


oracle(
    "stage_config",
    ("fx_stage_events",),
    "select distinct stage, 'planned' as description, cast(estimate_seconds as bigint) as estimate_seconds from fx_stage_events",
)


@query
def run_tables(spark, sf):
    place = _place(spark, "events")
    events = view(spark, sf, "fx_stage_events").select(
        F.col("event_id").alias("id"), "stage", "type", F.col("ts").cast("timestamp").alias("ts"), F.lit("m").alias("message")
    )
    events.write.parquet(place)
    return plain_time(tables.read_run_table(spark, place, tables.EVENT_SCHEMA), "ts")


oracle("run_tables", ("fx_stage_events",), "select event_id as id, stage, type, ts, 'm' as message from fx_stage_events")


# ---- genomic files -------------------------------------------------------------------


@query
def cohort_vcf_file(spark, sf):
    """The cohort VCF, written with its header and read back."""
    place = _place(spark, "cohort.vcf")
    writers.write_vcf(full_cohort_records(spark, sf), ["##fileformat=VCFv4.2", "##source=cohort"], place)
    return genomic.read_vcf(spark, place).select("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info")


ORACLES["cohort_vcf_file"] = ORACLES["cohort_records"]


@query
def vcf_header(spark, sf):
    """How many header lines the first file by name has (S5), and the smallest of them."""
    folder = vcf_folder(spark, sf)
    first = lines.list_files(spark, folder).agg(F.min("path")).first()[0]
    return genomic.vcf_header_lines(spark, first).agg(F.count(F.lit(1)).alias("lines"), F.min("value").alias("line"))


oracle(
    "vcf_header",
    ("fx_variants", "fx_vcf_lines"),
    """select count(*) as lines, min(value) as line from fx_vcf_lines where value like '#%'
     and file_path = (select min(file_path) from fx_vcf_lines)""",
)


@query
def block_gzip_lines(spark, sf):
    """All VCF lines written to block-gzip files and read in ranges of 128 kB, with their numbers in their file."""
    place = _place(spark, "vcf")
    ordered = view(spark, sf, "fx_vcf_lines").repartitionByRange("file_path", "rec_order").sortWithinPartitions("file_path", "rec_order")
    blockgzip.write_block_lines(ordered, place)
    numbered = lines.number_lines(blockgzip.read_block_lines(spark, place, 128 << 10))
    firsts = numbered.groupBy("file_path").agg((F.count_distinct("line_no") == F.max("line_no") + 1).alias("numbered"))
    return numbered.join(firsts, "file_path").select("value", "numbered")


oracle("block_gzip_lines", ("fx_variants", "fx_vcf_lines"), "select value, true as numbered from fx_vcf_lines")


@query
def vcf_files(spark, sf):
    """Files found below a folder, with the sample each belongs to (S1 listing, P1)."""
    folder = vcf_folder(spark, sf)
    return lines.list_files(spark, folder, "*.vcf").select(file_name(F.col("path")).alias("name"), (F.col("size_bytes") > 0).alias("filled"))


oracle(
    "vcf_files",
    ("fx_variants", "fx_vcf_lines"),
    "select distinct split_part(file_path, '/', 2) as name, true as filled from fx_vcf_lines",
)


@query
def gtf_file_intervals(spark, sf):
    """Gene intervals of a GTF file."""
    rows = view(spark, sf, "fx_gtf_lines")
    folder = files.made(spark, sf, "gtf", _named(rows, F.lit("genes.gtf"), F.col("line_order") + 10_000_000, F.col("value")))
    return genomic.read_genes(spark, f"{folder}/genes.gtf")


ORACLES["gtf_file_intervals"] = ORACLES["gtf_scan"]


@query
def transcript_intervals(spark, sf):
    """A GTF without gene rows: transcript bounds per gene (A4)."""
    value = F.regexp_replace(F.regexp_replace("value", "\tgene\t", "\ttranscript\t"), r'gene_id "(G\d*?)\d?"', 'gene_id "$1"')
    named = F.regexp_replace(value, r'gene_name "[^"]*";', "")
    rows = view(spark, sf, "fx_gtf_lines").select(named.alias("value"), F.get(F.split("value", '"'), F.lit(1)).alias("g"))
    order = F.substring("g", F.lit(2), F.length("g")).cast("long")
    folder = files.made(spark, sf, "gtf-transcripts", _named(rows, F.lit("t.gtf"), order, F.col("value")))
    return intervals.gene_intervals(genomic.read_gtf(spark, f"{folder}/t.gtf"))


oracle(
    "transcript_intervals",
    ("fx_genes",),
    r"""select chrom, min(g_start) + 1000 as start, max(g_end) + 1000 as "end", arg_min(strand, cast(substr(gene_id, 2) as bigint)) as strand,
       regexp_replace(gene_id, '^(G\d*?)\d?$', '\1') as gene_id, regexp_replace(gene_id, '^(G\d*?)\d?$', '\1') as gene_name
     from fx_genes group by chrom, 5, 6""",
)


@query
def gene_list_file(spark, sf):
    place = _place(spark, "genes.txt")
    view(spark, sf, "part").select(F.concat(F.lit("  "), "p_brand", F.lit(" ")).alias("value")).write.text(place)
    return genomic.read_gene_list(spark, place)


oracle("gene_list_file", (), "select distinct p_brand as gene_name from part")


@query
def gene_set_file(spark, sf):
    """Gene sets as GMT lines."""
    place = _place(spark, "sets.gmt")
    sets = view(spark, sf, "fx_gene_sets").withColumn("row", F.pmod(F.xxhash64("gene"), F.lit(50)))
    rows = sets.groupBy("term", "row").agg(F.array_join(F.collect_list("gene"), "\t").alias("genes"))
    rows.select(_tabbed("term", F.lit("about"), "genes").alias("value")).write.text(place)
    return genomic.read_gene_sets(spark, place)


oracle("gene_set_file", ("fx_gene_sets",), "select term, 'about' as description, gene from fx_gene_sets")


@query
def contig_file(spark, sf):
    """Contigs of a FASTA index."""
    lengths = variants(spark, sf).groupBy("chrom").agg(F.max("pos").alias("length"))
    value = _tabbed("chrom", "length", F.lit("0"), F.lit("60"))
    rows = _named(lengths, F.lit("genome.fai"), F.substring("chrom", F.lit(4), F.lit(9)), value)
    folder = files.made(spark, sf, "fai", rows)
    return genomic.read_contigs(spark, f"{folder}/genome.fai")


oracle(
    "contig_file",
    ("fx_variants",),
    """select chrom as contig, max(pos) as length, row_number() over (order by cast(substr(chrom, 4) as int)) - 1 as line_no
     from fx_variants group by chrom""",
)


# ---- cells ---------------------------------------------------------------------------


def _site_numbers(spark, sf):
    return variants(spark, sf).select(
        F.concat("sample_id", F.lit(".mtx")).alias("name"),
        (F.col("rec_order") + 1).alias("line_order"),
        F.concat_ws(" ", (F.col("cell") + 1).cast("string"), (F.col("pos") + 1).cast("string"), F.col("qd").cast("int").cast("string")).alias("value"),
    )


@query
def matrix_market_files(spark, sf):
    """Sparse matrices, a file per sample: cells and shapes added up."""
    body = _site_numbers(spark, sf)
    sizes = body.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    head = sizes.select("name", F.lit(0).cast("long").alias("line_order"), F.concat(F.lit("64 9999999 "), F.col("n").cast("string")).alias("value"))
    mark = sizes.select("name", F.lit(-1).cast("long").alias("line_order"), F.lit("%%MatrixMarket matrix coordinate integer general").alias("value"))
    folder = files.made(spark, sf, "mtx", body.unionByName(head).unionByName(mark))
    found, shapes = tables.read_matrix_market(spark, folder)
    sums = found.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"), F.sum("row_idx").alias("rows"), F.sum("col_idx").alias("cols"), F.sum("value").alias("total"))
    return sums.join(shapes, "file_path").select(file_name(F.col("file_path")).alias("name"), "n", "rows", "cols", "total", "n_rows", "n_cols", "n_entries")


oracle(
    "matrix_market_files",
    ("fx_variants",),
    """select sample_id || '.mtx' as name, count(*) as n, cast(sum(cell + 1) as bigint) as rows, cast(sum(pos + 1) as bigint) as cols,
       cast(sum(cast(floor(qd) as int)) as double) as total, cast(64 as bigint) as n_rows, cast(9999999 as bigint) as n_cols, count(*) as n_entries
     from fx_variants group by 1""",
)


@query
def barcode_files(spark, sf):
    """Barcode lists, a file per sample, with matrix positions."""
    rows = view(spark, sf, "fx_cells")
    folder = files.made(
        spark, sf, "barcodes", _named(rows, F.concat("sample_id", F.lit(".tsv")), F.col("cell"), _tabbed("barcode", F.lit("x")))
    )
    return tables.read_barcodes(spark, folder).select(file_name(F.col("file_path")).alias("name"), "idx", "barcode")


oracle(
    "barcode_files",
    ("fx_variants", "fx_cells"),
    """select sample_id || '.tsv' as name, row_number() over (partition by sample_id order by cell) as idx, barcode from fx_cells""",
)


@query
def cell_variant_files(spark, sf):
    """Variant lists of the sparse matrices: positions count the usable rows."""
    sites = variants(spark, sf).groupBy("chrom", "pos", "ref", "alt").agg(F.min("rec_order").alias("seen"))
    letter = lambda c: F.instr(F.lit("ACGT"), F.substring(c, F.lit(1), F.lit(1)))
    order = F.col("pos") * 100 + letter(F.col("ref")) * 20 + letter(F.col("alt")) * 4 + F.length("alt")
    value = F.when(F.col("seen") % 13 == 0, "broken\trow").otherwise(_tabbed("chrom", "pos", "ref", "alt"))
    folder = files.made(spark, sf, "cell-variants", _named(sites, F.concat("chrom", F.lit(".tsv")), order, value))
    return tables.read_cell_variants(spark, folder, vcf=False).drop("file_path")


oracle(
    "cell_variant_files",
    ("fx_variants",),
    """select row_number() over (partition by chrom order by pos, ref, alt) as idx, chrom, pos, ref, alt from (
       select chrom, pos, ref, alt, min(rec_order) as seen from fx_variants group by all) q where seen % 13 <> 0""",
)


@query
def cell_map_file(spark, sf):
    """Cell to cluster map with named columns in another order."""
    place = _place(spark, "cells.tsv")
    writers.write_tsv(view(spark, sf, "fx_cluster_map").select("cluster", "sample", "cell_id"), place)
    return tables.read_cell_map(spark, place).drop("line_no")


oracle("cell_map_file", ("fx_variants", "fx_cells", "fx_all_clusters", "fx_cluster_map"), "select cell_id, sample, cluster from fx_cluster_map")


def _cluster_rows(spark, sf):
    sums = cut_lineage(cluster_sums(spark, sf))  # read by the lines and by their head lines
    rows = sums.select("sample_id", "chrom", "pos", "ref", "alt", "cluster", "alt_sum", "depth_sum", F.round("vaf", 6).alias("vaf"))
    fields = ["chrom", "pos", "ref", "alt", "cluster", "alt_sum", "depth_sum", "vaf"]
    name = F.concat("sample_id", F.lit(".cellsnp.cluster_counts.tsv"))
    body = _named(rows, name, F.lit(1), _tabbed(*fields))
    heads = rows.select(name.alias("name")).distinct().select("name", F.lit(0).cast("long").alias("line_order"), F.lit("\t".join(fields)).alias("value"))
    return body.unionByName(heads)


@query
def cluster_count_files(spark, sf):
    """Cluster tables, a file per sample."""
    folder = files.made(spark, sf, "cluster-counts", _cluster_rows(spark, sf))
    return tables.read_cluster_counts(spark, folder)


ORACLES["cluster_count_files"] = ORACLES["cluster_allele_sums"].replace("select * from sums", "select * replace (round(vaf, 6) as vaf) from sums")


@query
def detected_cell_files(spark, sf):
    """Barcode files of the aligner's folders: cells per sample."""
    rows = view(spark, sf, "fx_cells")
    folder = files.made(
        spark, sf, "solo", _named(rows, F.concat("sample_id", F.lit("/Solo.out/Gene/filtered/barcodes.tsv")), F.col("cell"), F.col("barcode"))
    )
    found = tables.read_detected_cells(spark, folder)
    return found.groupBy("sample_id").agg(F.count(F.lit(1)).alias("cells"), F.countDistinct("value").alias("barcodes"))


oracle(
    "detected_cell_files",
    ("fx_variants", "fx_cells"),
    "select sample_id, count(*) as cells, count(distinct barcode) as barcodes from fx_cells group by 1",
)


@query
def fastq_file(spark, sf):
    """Merged reads as packed FASTQ, read back."""
    place = _place(spark, "merged.fastq")
    writers.write_fastq(merged_reads(spark, sf), place)
    return tables.read_fastq(spark, place).select("header", "seq", "plus", "qual")


ORACLES["fastq_file"] = ORACLES["fastq_merge_r2_r3"].replace("select * from merged", "select header, seq, plus, qual from merged")


# ---- logs and reports ----------------------------------------------------------------


@query
def tool_log_files(spark, sf):
    """Logs, a file per sample, with line numbers."""
    rows = view(spark, sf, "fx_log_lines")
    folder = files.made(spark, sf, "logs", _named(rows, F.concat("sample_id", F.lit(".gatk.log")), F.col("line_no"), F.col("line")))
    return tables.read_tool_logs(spark, folder)


oracle(
    "tool_log_files",
    ("fx_log_lines",),
    "select sample_id, row_number() over (partition by sample_id order by line_no) - 1 as line_no, line from fx_log_lines",
)


@query
def tool_log_timeline(spark, sf):
    """Steps of logs that print their times."""
    rows = view(spark, sf, "events").filter("event_type = 'purchase'").select(
        F.concat(F.lit("S"), (F.col("user_id") % 12).cast("string")).alias("sample_id"),
        F.col("event_id").alias("line_no"),
        F.concat(
            F.lit("["), F.date_format(F.col("ts").cast("timestamp"), "MMMM d, yyyy, h:mm:ss a"), F.lit(" UTC] org.HaplotypeCaller done. Elapsed time: "),
            F.round("value", 2).cast("string"), F.lit(" minutes."),
        ).alias("line"),
    )
    return plain_time(runlog.step_timeline(rows), "start_ts", "end_ts")


oracle(
    "tool_log_timeline",
    (),
    """select 'S' || cast(user_id % 12 as string) as sample_id, 'HaplotypeCaller' as step, cast(null as timestamp) as start_ts,
       arg_max(date_trunc('second', ts), event_id) as end_ts, arg_max(round(value, 2), event_id) as minutes, true as done,
       false as start_inferred, false as end_inferred
     from events where event_type = 'purchase' group by 1""",
)


@query
def correlation_file(spark, sf):
    """The correlation matrix as a table with row labels (K6)."""
    place = _place(spark, "correlation.tsv")
    pairs = association.spearman_pairs(integrated(spark, sf), METRICS)
    writers.write_matrix(rounded(association.correlation_matrix(pairs, METRICS), *METRICS), place)
    schema = "metric string, " + ", ".join(f"{m} double" for m in METRICS)
    return tables.read_tsv(spark, place, schema)


ORACLES["correlation_file"] = ORACLES["correlation_matrix"]


@query
def manifest_file(spark, sf):
    """The report manifest as a table (K7)."""
    place = _place(spark, "manifest.tsv")
    manifest = runlog.report_manifest(listed_files(spark, sf))
    writers.write_manifest(manifest, place)
    return tables.read_tsv(spark, place, manifest.schema)


ORACLES["manifest_file"] = ORACLES["report_manifest"]


# ---- checks --------------------------------------------------------------------------


@query
def blank_sample_ids(spark, sf):
    """Sheet rows with blank ids need no files."""
    sheet = view(spark, sf, "fx_customers").select(
        F.when(F.col("sample_id") % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("sample_id").cast("string"))).alias("sample_id")
    )
    reads = view(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("sample_id")).distinct()
    return checks.samples_without_files(sheet, reads)


oracle(
    "blank_sample_ids",
    ("fx_customers",),
    """select cast(sample_id as string) as sample_id from fx_customers where sample_id % 5 <> 0
     and sample_id not in (select o_custkey from orders)""",
)


@query
def sample_alignment(spark, sf):
    """Samples of a sheet and of a matrix that the other lacks."""
    sheet = view(spark, sf, "fx_customers").select(F.col("sample_id").cast("string"))
    matrix = view(spark, sf, "orders").select((F.col("o_custkey") + 7).cast("string").alias("sample_id"))
    return checks.misaligned_samples(sheet, matrix)


oracle(
    "sample_alignment",
    ("fx_customers",),
    """select cast(a.sample_id as string) as sample_id, 'not in matrix' as problem from fx_customers a
     where a.sample_id not in (select o_custkey + 7 from orders)
     union all select distinct cast(o_custkey + 7 as string), 'not in metadata' from orders
     where o_custkey + 7 not in (select sample_id from fx_customers)""",
)


@query
def label_and_columns(spark, sf):
    """The negative label, the columns a sheet lacks, and its numeric ones."""
    sheet = view(spark, sf, "fx_customers").withColumn("label", F.when(F.col("label") == "BUILDING", "yes").otherwise("no"))
    try:
        checks.require_columns(sheet, ["label", "run_id", "age"], "sheet")
        missing = ""
    except InputError as error:
        missing = str(error)
    wide = view(spark, sf, "customer").withColumn("empty", F.lit(None).cast("double"))
    numbers = ",".join(association.numeric_metrics(wide, "c_custkey"))
    told = [("negative", folds.negative_label(sheet, "label", "yes")), ("missing", missing), ("numeric", numbers)]
    return view(spark, sf, "fx_customers").agg(F.count(F.lit(1)).alias("n")).select(
        "n", *[F.lit(text).alias(name) for name, text in told]
    )


oracle(
    "label_and_columns",
    ("fx_customers",),
    """select count(*) as n, 'no' as negative, 'sheet misses columns: age, run_id' as missing, 'c_nationkey,c_acctbal' as numeric
     from fx_customers""",
)


@query
def preview_lines(spark, sf):
    """The first lines of one log."""
    rows = view(spark, sf, "fx_log_lines").filter("sample_id = 'S03'").orderBy("line_no")
    return rows.select("line_no", "line").limit(40)


oracle("preview_lines", ("fx_log_lines",), "select line_no, line from fx_log_lines where sample_id = 'S03' order by line_no limit 40")


@query
def random_labelings(spark, sf):
    """Distinct drawn labelings keep the class balance and hold the observed one (M8, random branch)."""
    samples = view(spark, sf, "fx_customers").select(
        F.col("sample_id").cast("string").alias("sample_id"), "gsm", (F.substring("gsm", F.lit(2), F.lit(2)).cast("int") < 9).cast("int").alias("y")
    )
    table, complete = folds.group_labelings(samples, "gsm", "y", max_exact=100, n_random=50)
    return table.agg(
        F.count(F.lit(1)).alias("labelings"),
        F.countDistinct("positive_groups").alias("different"),
        F.min(F.size("positive_groups")).alias("least"),
        F.max(F.size("positive_groups")).alias("most"),
        F.count_if("is_observed_labeling").alias("observed"),
    ).withColumn("complete", F.lit(complete))


oracle(
    "random_labelings",
    ("fx_customers",),
    """select cast(50 as bigint) as labelings, cast(50 as bigint) as different, cast(count(distinct gsm) as int) as least,
       cast(count(distinct gsm) as int) as most, cast(1 as bigint) as observed, false as complete
     from fx_customers where cast(substr(gsm, 2, 2) as int) < 9""",
)


@query
def first_sheet_rows(spark, sf):
    """First row per sample of a sheet that lists a sample many times."""
    sheet = view(spark, sf, "orders").select(
        F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("sample_id"), F.col("o_orderstatus").alias("condition"),
        F.col("o_orderpriority").alias("run_id"), F.col("o_orderkey").alias("line_no"),
    )
    return association.first_metadata(sheet, "line_no").select("sample_id", "condition", "run_id")


oracle(
    "first_sheet_rows",
    (),
    """select 'S' || cast(o_custkey as string) as sample_id, arg_min(o_orderstatus, o_orderkey) as condition,
       arg_min(o_orderpriority, o_orderkey) as run_id from orders group by 1""",
)


@query
def burden_matrix_file(spark, sf):
    """The wide gene matrix as a TSV (K4), read back."""
    place = _place(spark, "burden.tsv")
    wide = gene_burden_wide(spark, sf)
    writers.write_tsv(wide, place)
    return tables.read_tsv(spark, place, wide.schema)


ORACLES["burden_matrix_file"] = ORACLES["gene_burden_wide"]


@query
def matrix_shape_check(spark, sf):
    """Samples whose allele and depth matrices or variant lists don't fit each other."""
    rows = cut_lineage(variants(spark, sf).select("sample_id", "cell", "af", "qd"))

    def shape(some):
        return some.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("cell").alias("n_cols"))

    listed = rows.where("sample_id <> 'S03'")
    return cells.matrix_shape_violations(shape(rows), shape(rows.where("sample_id < 'S08' or (sample_id <> 'S11' and qd > 5)")), listed)


oracle(
    "matrix_shape_check",
    ("fx_variants",),
    """select sample_id, ad_rows, ad_cols, dp_rows, dp_cols, n_variants
     from (select sample_id, count(*) as ad_rows, count(distinct cell) as ad_cols from fx_variants group by 1) a
     left join (select sample_id, count(*) as dp_rows, count(distinct cell) as dp_cols from fx_variants
       where sample_id < 'S08' or (sample_id <> 'S11' and qd > 5) group by 1) d using (sample_id)
     left join (select sample_id, count(*) as n_variants from fx_variants where sample_id <> 'S03' group by 1) v using (sample_id)
     where ad_rows is distinct from dp_rows or ad_cols is distinct from dp_cols or ad_rows is distinct from n_variants""",
)


@query
def write_counters(spark, sf):
    """Counters that fill in while a table is written (A36), as one row."""
    rows, seen = checks.counted(
        variants(spark, sf), f"written-{uuid.uuid4().hex}", n_chrom1=F.count_if(F.col("chrom") == "chr1"), max_pos=F.max("pos")
    )
    rows.write.parquet(_place(spark, "calls"))
    counts = checks.require_counts(seen, "no calls")
    return spark.createDataFrame([(counts["rows"], counts["n_chrom1"], counts["max_pos"])], "n_rows long, n_chrom1 long, max_pos long")


oracle(
    "write_counters",
    ("fx_variants",),
    "select count(*) as n_rows, count(*) filter (where chrom = 'chr1') as n_chrom1, max(pos) as max_pos from fx_variants",
)


@query
def table_previews(spark, sf):
    """Previews of the given tables (O8): columns, first names and a bounded number of rows."""
    found = []
    for name in ("orders", "customer", "nation", "region"):
        seen = runlog.table_preview(view(spark, sf, name), max_rows=100, max_columns=2)
        found.append((name, ",".join(seen["header"]), seen["rows_sampled"], seen["truncated"]))
    return spark.createDataFrame(found, "name string, header string, rows_sampled long, truncated boolean")


oracle(
    "table_previews",
    (),
    " union all ".join(
        f"select '{t}' as name, '{h}' as header, least(count(*), 100) as rows_sampled, count(*) >= 100 as truncated from {t}"
        for t, h in (("orders", "o_orderkey,o_custkey"), ("customer", "c_custkey,c_name"), ("nation", "n_nationkey,n_name"), ("region", "r_regionkey,r_name"))
    ),
)


@query
def tool_log_inference(spark, sf):
    """Steps of logs in which the indexing step prints no times: its neighbours' marks give them."""
    date = F.date_format(F.col("ts").cast("timestamp"), "MMMM d, yyyy, h:mm:ss a")
    done = F.concat(F.lit("["), date, F.lit(" UTC] picard.AddOrReplaceReadGroups done. Elapsed time: "), F.round("value", 2).cast("string"), F.lit(" minutes."))
    started = F.concat(F.lit("INFO SplitNCigarReads - Start Date/Time: "), date, F.lit(" UTC"))
    kind = F.col("event_type")
    rows = view(spark, sf, "events").select(
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("sample_id"), F.col("event_id").alias("line_no"),
        F.when(kind == "click", done).when(kind == "view", "CMD: samtools index x.bam").when(kind == "purchase", started).otherwise("INFO other").alias("line"),
    )
    return plain_time(runlog.step_timeline(rows), "start_ts", "end_ts")


oracle(
    "tool_log_inference",
    (),
    """select sample_id, step, start_ts, end_ts, minutes, done, start_inferred, end_inferred from (
       select sample_id, 'AddOrReplaceReadGroups' as step, cast(null as timestamp) as start_ts, c as end_ts, m as minutes, true as done,
         false as start_inferred, false as end_inferred from w where c is not null
       union all select sample_id, 'samtools index', c, p, case when p >= c then (epoch_us(p) / 1e6 - epoch_us(c) / 1e6) / 60 end, p is not null,
         c is not null, p is not null from w where v
       union all select sample_id, 'SplitNCigarReads', p, null, null, false, false, false from w where p is not null) q""",
    """
w as (select 'S' || cast(user_id as string) as sample_id, bool_or(event_type = 'view') as v,
  arg_max(date_trunc('second', ts), event_id) filter (where event_type = 'click') as c,
  arg_max(round(value, 2), event_id) filter (where event_type = 'click') as m,
  arg_max(date_trunc('second', ts), event_id) filter (where event_type = 'purchase') as p from events group by 1)""",
)
