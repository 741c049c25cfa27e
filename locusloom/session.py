"""Session construction for tests and local runs, and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cores: str = "8", partitions: int = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    """Local session with the settings the library is tested under; ``shared`` is its folder for written tables."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", shared or tempfile.mkdtemp(prefix="locusloom-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Set it when the session is made; :func:`local_session` takes it as ``shared``. Only where
    it is unset and driver and executors are one process, as in tests, a temporary folder
    stands in; anywhere else a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _LOCAL_FOLDERS.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="locusloom-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    What is read several times is computed once, a lost executor loses no work, and
    later joins are planned from the table's real size.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
