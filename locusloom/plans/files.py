"""Text files with given names below the shared folder, made from the driver tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from locusloom.session import shared_folder
from locusloom.sources.blockgzip import _system

_MADE: dict[tuple[str, str, str], str] = {}
COPY_BYTES = 8 << 20


def named_files(spark: SparkSession, rows: DataFrame, folder: str) -> str:
    """Write ``rows (name, line_order, value)`` as one file per name, lines in order.

    Lines are sorted and written in ranges of (name, order), so that a task's share does not grow with a
    file; the parts of a file are then strung together, a file by a task that holds ``COPY_BYTES`` at a time.
    """
    parts = f"{folder}/_parts"
    ordered = rows.repartitionByRange("name", "line_order").sortWithinPartitions("name", "line_order")
    ordered.select("value", "name").write.partitionBy("name").text(parts)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    several = []
    for entry in system.listStatus(path(parts)):
        key, _, name = entry.getPath().getName().partition("=")
        if key != "name":
            continue
        target = path(f"{folder}/{unquote(name)}")
        system.mkdirs(target.getParent())
        # Part names begin with the number of their range.
        found = sorted((p.getPath() for p in system.listStatus(entry.getPath()) if p.getPath().getName().startswith("part-")), key=lambda p: p.getName())
        if len(found) == 1:
            system.rename(found[0], target)
        else:
            several.append((unquote(name), json.dumps([f"_parts/{entry.getPath().getName()}/{p.getName()}" for p in found])))
    if several:
        files = spark.createDataFrame(several, "name string, parts string").repartition(len(several), "name")
        files.mapInArrow(_joined(folder), "name string").count()
    system.delete(path(parts), True)
    return folder


def _joined(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_output_stream(f"{base}/{row['name']}", compression=None) as out:
                    for part in json.loads(row["parts"]):
                        with system.open_input_stream(f"{base}/{part}", compression=None) as held:
                            while piece := held.read(COPY_BYTES):
                                out.write(piece)
            yield batch.select(["name"])

    return run


def made(spark: SparkSession, sf_dir: str, kind: str, rows: DataFrame) -> str:
    """Folder of the files of one kind; they are written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _MADE:
        _MADE[key] = named_files(spark, rows, f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}")
    return _MADE[key]
