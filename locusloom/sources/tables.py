"""Metadata, TSV, matrix, barcode, cluster-map, FASTQ and run-log readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusloom.functions.text import INTEGRATION_SUFFIXES, file_name, normalize_sample_id
from locusloom.operators.checks import InputError, require_columns, require_rows
from locusloom.session import cut_lineage
from locusloom.sources.lines import number_lines, read_lines


def read_metadata(spark: SparkSession, path: str, required: Sequence[str] = ("sample_id", "condition", "run_id")) -> DataFrame:
    """Sample sheet, tab separated for ``.tsv`` and comma separated otherwise; all columns text."""
    sep = "\t" if path.lower().endswith(".tsv") else ","
    table = spark.read.option("sep", sep).option("header", "true").option("inferSchema", "false").csv(path)
    return require_columns(require_rows(table, f"metadata file is empty: {path}"), required, "metadata")


def read_tsv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """TSV with a header. Types are inferred only where no schema is given."""
    reader = spark.read.option("sep", "\t").option("header", "true")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", "true")
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def read_matrix_market(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Cells ``(file_path, row_idx, col_idx, value)`` and shapes ``(file_path, n_rows, n_cols, n_entries)``.

    The first line after the comments is the shape; indices start at 1.
    """
    lines = read_lines(spark, paths).filter(~F.startswith("value", F.lit("%")) & (F.trim("value") != ""))
    # One row per file, written first so that the join is planned from its real size.
    heads = cut_lineage(lines.groupBy("file_path").agg(F.min("line_order").alias("_head")))
    parts = F.split(F.trim("value"), r"\s+")
    typed = lines.join(heads, "file_path").select(
        "file_path",
        (F.col("line_order") == F.col("_head")).alias("_is_head"),
        F.get(parts, F.lit(0)).cast("long").alias("a"),
        F.get(parts, F.lit(1)).cast("long").alias("b"),
        F.coalesce(F.get(parts, F.lit(2)).cast("double"), F.lit(1.0)).alias("c"),
    )
    cells = typed.filter("not _is_head").select(
        "file_path", F.col("a").alias("row_idx"), F.col("b").alias("col_idx"), F.col("c").alias("value")
    )
    shapes = typed.filter("_is_head").select(
        "file_path", F.col("a").alias("n_rows"), F.col("b").alias("n_cols"), F.col("c").cast("long").alias("n_entries")
    )
    return cells, shapes


def read_barcodes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(file_path, idx, barcode)`` with matrix positions from 1; the first tab field counts."""
    lines = number_lines(read_lines(spark, paths))
    return lines.select(
        "file_path",
        (F.col("line_no") + 1).alias("idx"),
        F.substring_index(F.trim("value"), "\t", 1).alias("barcode"),
    )


def read_cell_variants(spark: SparkSession, paths: str | Sequence[str], vcf: bool) -> DataFrame:
    """``(file_path, idx, chrom, pos, ref, alt)`` of a variant list or of a base VCF.

    Positions count the usable rows only, as the matrix rows do.
    """
    lines = read_lines(spark, paths)
    parts = F.split("value", "\t")
    if vcf:
        lines = lines.filter(~F.startswith("value", F.lit("#")) & (F.size(parts) >= 5))
        ref, alt = 3, 4
    else:
        lines = lines.filter(F.size(parts) >= 4)
        ref, alt = 2, 3
    kept = _number_kept(lines)
    return kept.select(
        "file_path",
        "idx",
        F.get(parts, F.lit(0)).alias("chrom"),
        F.get(parts, F.lit(1)).cast("long").alias("pos"),
        F.get(parts, F.lit(ref)).alias("ref"),
        F.substring_index(F.get(parts, F.lit(alt)), ",", 1).alias("alt") if vcf else F.get(parts, F.lit(alt)).alias("alt"),
    )


def _number_kept(lines: DataFrame) -> DataFrame:
    """``idx`` from 1 over the kept lines of a file: numbered after the filter, from counts per split, so no line moves."""
    kept = number_lines(lines.withColumn("line_order", F.monotonically_increasing_id()))
    return kept.withColumn("idx", F.col("line_no") + 1)


def read_cell_map(spark: SparkSession, path: str) -> DataFrame:
    """Cell to cluster rows ``(cell_id, sample, cluster, line_no)``.

    Header names decide the positions; without them the first three columns are used.
    Rows that are too short are skipped.
    """
    lines = number_lines(read_lines(spark, path))
    header = lines.filter("line_no = 0").select("value").first()
    if header is None:
        raise InputError(f"cell map is empty: {path}")
    names = header[0].split("\t")
    at = {n: names.index(n) if n in names else i for i, n in enumerate(("cell_id", "sample", "cluster"))}
    parts = F.split("value", "\t")
    body = lines.filter((F.col("line_no") > 0) & (F.size(parts) > max(at.values())))
    return body.select(*[F.get(parts, F.lit(i)).alias(n) for n, i in at.items()], "line_no")


def read_barcode_map(spark: SparkSession, path: str) -> DataFrame:
    """The other map layout: ``barcode, cluster`` and optionally ``sample_id``, by header."""
    table = spark.read.option("sep", "\t").option("header", "true").csv(path)
    require_columns(table, ["barcode", "cluster"], "cell cluster map")
    return table.select(*[c for c in ("sample_id", "barcode", "cluster") if c in table.columns])


CLUSTER_SCHEMA = (
    "chrom string, pos long, ref string, alt string, cluster string, alt_sum long, depth_sum long, vaf double"
)


def read_cluster_counts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Cluster tables with the sample id of each file name; a plain and a packed copy count once."""
    table = spark.read.option("sep", "\t").option("header", "true").schema(CLUSTER_SCHEMA)
    table = table.csv(paths if isinstance(paths, str) else list(paths)).select("*", "_metadata.file_path")
    stem = F.regexp_replace(file_name(F.col("file_path")), r"\.cellsnp\.cluster_counts\.tsv(\.gz)?$", "")
    named = table.withColumn("sample_id", normalize_sample_id(stem, INTEGRATION_SUFFIXES))
    packed = F.when(F.endswith("file_path", F.lit(".gz")), 1).otherwise(0)
    files = named.select("sample_id", "file_path", packed.alias("_packed")).distinct()
    chosen = cut_lineage(files.groupBy("sample_id").agg(F.min(F.struct("_packed", "file_path"))["file_path"].alias("file_path")))
    return named.join(chosen, ["sample_id", "file_path"]).drop("file_path")


def read_detected_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Barcode lines ``(sample_id, file_path)`` of ``<sample>/.../Gene/filtered/barcodes.tsv[.gz]``."""
    lines = read_lines(spark, folder, recursive=True, glob="barcodes.tsv*")
    root = folder.rstrip("/")
    inside = F.col("file_path").rlike(r"/Gene/filtered/barcodes\.tsv(\.gz)?$")
    below = F.substring_index(F.col("file_path"), root + "/", -1)
    sample = normalize_sample_id(F.substring_index(below, "/", 1), INTEGRATION_SUFFIXES)
    return lines.filter(inside).select(sample.alias("sample_id"), "file_path", "value")


def read_fastq(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """FASTQ records ``(file_path, record_idx, header, seq, plus, qual)``; four lines each.

    The lines of a record are next to each other, so they are combined before the shuffle.
    """
    lines = number_lines(read_lines(spark, paths))
    field = F.col("line_no") % 4
    record = lines.groupBy("file_path", F.floor(F.col("line_no") / 4).cast("long").alias("record_idx")).agg(
        *[F.max(F.when(field == i, F.col("value"))).alias(n) for i, n in enumerate(("header", "seq", "plus", "qual"))]
    )
    complete = F.col("header").isNotNull() & F.col("seq").isNotNull() & F.col("plus").isNotNull() & F.col("qual").isNotNull()
    header = F.when(complete, F.col("header")).otherwise(F.raise_error(F.lit("malformed FASTQ record")).cast("string"))
    return record.withColumn("header", header)


def read_tool_logs(spark: SparkSession, paths: str | Sequence[str], suffix: str = ".gatk.log") -> DataFrame:
    """Numbered log lines ``(sample_id, line_no, line)``; the sample id is the file name's stem."""
    lines = number_lines(read_lines(spark, paths))
    name = file_name(F.col("file_path"))
    sample = F.when(F.endswith(name, F.lit(suffix)), F.substring(name, F.lit(1), F.length(name) - len(suffix))).otherwise(name)
    return lines.select(sample.alias("sample_id"), "line_no", F.col("value").alias("line"))


# Schemas of the run tables.
EVENT_SCHEMA = "id long, stage string, type string, ts timestamp, message string"
FILE_SCHEMA = "id long, stage string, path string, size_bytes long, ts timestamp"
STAGE_SCHEMA = "stage string, description string, estimate_seconds long, last_status string, last_start_ts timestamp"


def read_run_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One of the run tables kept as Parquet."""
    return spark.read.schema(schema).parquet(path)


def read_stage_config(spark: SparkSession, path: str) -> DataFrame:
    """Configured stages ``(stage, description, estimate_seconds)`` of a JSON file."""
    shape = "stages array<struct<id: string, description: string, estimate_seconds: long>>"
    table = spark.read.schema(shape).option("multiLine", "true").json(path)
    return table.select(F.inline("stages")).withColumnRenamed("id", "stage")
