"""Sinks: lots and reports, graph lines, dead letters, and snapshots that may replace what they were made from."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_lots(lots: DataFrame, path: str, fmt: str = "parquet", key: str = "catalogue_id") -> None:
    """Lots in one folder per catalogue; readers of one catalogue then read its folder only."""
    writer = lots.write.mode("overwrite").partitionBy(key)
    (writer.option("header", True).option("escape", '"').csv(path) if fmt == "csv" else writer.parquet(path))


def write_csv(df: DataFrame, path: str) -> None:
    """All rows as CSV with a header, quotes doubled, UTF-8."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("encoding", "utf-8").csv(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """One text line per row of a single string column, such as graph lines."""
    lines.write.mode("overwrite").text(path)


def append_errors(errors: DataFrame, path: str) -> None:
    """Dead letters: rows that failed, appended to those of earlier runs."""
    errors.write.mode("append").parquet(path)


def write_snapshot(df: DataFrame, path: str) -> str:
    """Write ``df`` beside ``path`` and put it in its place, so a frame may be made from the table it replaces.

    The old table is moved away before the new one takes its name and is removed last; a run that breaks off leaves
    one of the two whole.
    """
    spark: SparkSession = df.sparkSession
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(new)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hadoop(path)):
        fs.rename(hadoop(path), hadoop(old))
    if not fs.rename(hadoop(new), hadoop(path)):
        raise OSError(f"cannot put {new} in the place of {path}")
    fs.delete(hadoop(old), True)
    return path
