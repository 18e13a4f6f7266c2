"""Match the number of partitions to the work, not to the bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, per_slot: int = 4) -> DataFrame:
    """Repartition ``df`` only if its scan has fewer partitions than the cluster's slots can use.

    Row-wise Python work is bound by CPU, so a compressed file that fits in one split would keep one core busy. A scan
    that already has at least two partitions per slot passes unchanged and nothing is shuffled, as on large inputs.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 2 * slots else df.repartition(per_slot * slots)


def scatter(df: DataFrame, per_slot: int = 2) -> DataFrame:
    """``df`` over all slots: for few rows that cost much each, which would else end up in one task for their size."""
    spark = df.sparkSession
    return df.repartition(max(per_slot * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
