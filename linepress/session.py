"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "linepress", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators expect: AQE, Arrow, UTC."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the setting spark.checkpoint.dir, else the session's checkpoint directory.

    Where neither is set, a session on one machine uses that machine's temporary folder; on a cluster that is an error, as
    each executor would write to its own disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = os.path.join(tempfile.gettempdir(), "linepress-shared")
        spark.sparkContext.setCheckpointDir(path)
        path = spark.sparkContext.getCheckpointDir() or path
    return path.rstrip("/")


def _filesystem(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table, below a folder of this application that is deleted when the driver ends."""
    root = f"{shared_dir(spark)}/linepress-{spark.sparkContext.applicationId}"
    fs, p = _filesystem(spark, root)
    if not fs.exists(p):
        fs.mkdirs(p)
        fs.deleteOnExit(p)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives the loss of an executor."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._linepress_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that materialise wrote and nothing will read again."""
    for t in tables:
        if path := getattr(t, "_linepress_path", None):
            fs, p = _filesystem(t.sparkSession, path)
            fs.delete(p, True)


def is_small(df: DataFrame, max_rows: int = 100_000) -> bool:
    """Whether df has at most max_rows rows; reads no more than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def collect_small(df: DataFrame, max_rows: int = 100_000) -> list:
    """The rows of a table that is small by nature; an error if it has more than max_rows."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows in a table that the driver was to read")
    return rows


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """df with a hint to broadcast it if it is small; else Spark chooses a join by itself."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer parts than there are cores, dealt out to all of them; others as they are. For work that is heavy
    per row on input of a few files; a large table has parts enough and isn't shuffled."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df._jdf.rdd().getNumPartitions() < n else df


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_linepress_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), f"linepress-{uuid.uuid4().hex[:8]}.zip")  # stays: executors fetch it when they start
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("linepress", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._linepress_shipped = True
