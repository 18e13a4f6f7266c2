"""Cut lineage by writing a table into the shared checkpoint folder.

A table that several later stages read is written once to the folder named by ``spark.checkpoint.dir`` and read
back. The files live on shared storage, so a lost executor costs a re-read, never a re-computation, and unlike a local
checkpoint nothing depends on one machine's disk.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []
_tables: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``; a temporary one only in local mode, where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="hammerlot-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def release() -> None:
    """Delete every table written so far. For long sessions, between queries: frames that read them end with it."""
    for spark, name in _tables:
        try:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        except Exception:  # the session is gone, and its catalogue with it
            pass
    _tables.clear()
    for spark, path in _written:
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session is gone; the cluster's own cleaning of the folder applies
            pass
    _written.clear()


atexit.register(release)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and return the table read back.

    Null rows, empty frames and any column types parquet can hold pass through unchanged.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/hammerlot/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, by: str, made: Callable[[DataFrame], DataFrame] | None = None, buckets: int | None = None) -> DataFrame:
    """Write ``df`` bucketed by a column and return the table: joins and groups by that column shuffle nothing.

    The rows are shuffled once here; ``made`` is applied behind the shuffle, so that what it blows up is not sent.
    ``buckets`` defaults to the session's shuffle partitions. The files lie in the shared folder, one per bucket; only
    their names are in the catalogue.
    """
    spark = df.sparkSession
    table = f"hammerlot_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/hammerlot/{name}-{uuid.uuid4().hex}"
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartition(n, by)
    (made(placed) if made else placed).write.mode("error").option("path", path).bucketBy(n, by).format("parquet").saveAsTable(table)
    _tables.append((spark, table))
    _written.append((spark, path))
    return spark.table(table)
