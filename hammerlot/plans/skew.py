"""Joins of a frame with itself where single keys may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that one task takes on its left side.
KEY_ROWS = 2_000


def salted(df: DataFrame, keys: list[str], key_rows: int = KEY_ROWS) -> tuple[DataFrame, DataFrame]:
    """Two copies of ``df`` with a column ``salt``, to be joined on ``keys`` and ``salt``; every pair meets exactly once.

    A key of more than ``key_rows`` rows is cut into so many parts on the left, and its rows stand once per part on the
    right. Other keys have one part. Null keys keep their rows; an equality join drops them as ever.
    """
    parts = df.groupBy(*keys).agg(F.ceil(F.count("*") / key_rows).cast("int").alias("__parts")).where("__parts > 1")
    rated = df.join(parts, keys, "left").withColumn("__parts", F.coalesce("__parts", F.lit(1)))
    left = rated.withColumn("salt", F.pmod(F.xxhash64(*df.columns), F.col("__parts")).cast("int")).drop("__parts")
    right = rated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))).drop("__parts")
    return left, right
