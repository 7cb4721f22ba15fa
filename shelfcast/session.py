"""Session settings and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# One row of a lookup table is well under 200 bytes, so this is under 40 MB.
BROADCAST_ROWS = 200_000


def local_session(app: str = "shelfcast", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SHELFCAST_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    It comes from ``spark.checkpoint.dir``. Only a local master, where driver
    and executors share one disk, gets a fresh temporary folder when unset.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shelfcast-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it from there.

    The table survives the loss of executors, later readers take only the
    columns they need, and its size is known when joins are planned.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only when the counted size of ``df`` allows it."""
    return df.hint("broadcast") if rows <= BROADCAST_ROWS else df
