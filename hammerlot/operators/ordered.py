"""Neighbours, carried values and running sums in the order of a key, safe where one key holds a third of all rows.

A window over a whole key is one task. Here the rows of a key are cut into buckets of a bounded span of the first order
column; windows run inside a bucket, and what crosses its borders comes from one small row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Span of the first order column that one bucket covers.
BUCKET = 20_000


def _bucketed(df: DataFrame, order: list[str], bucket: int) -> DataFrame:
    return df.withColumn("__bucket", F.floor(F.coalesce(F.col(order[0]), F.lit(-1)) / bucket))


def rejoin(rows: DataFrame, narrow: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the further columns of ``narrow``, which was made of it, by columns that may be null."""
    other = narrow.withColumnsRenamed({c: f"__{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on]
    return rows.join(other, same).drop(*[f"__{c}" for c in on])


def neighbours(df: DataFrame, key: str, order: list[str], value: Column, previous: str | None = None, following: str | None = None, bucket: int = BUCKET) -> DataFrame:
    """``df`` with the value of the row before and after in the order of its key; null at the ends.

    ``order``: columns of a total order, the first one numeric. A null key is a key of its own.
    """
    rows = _bucketed(df, order, bucket).withColumn("__value", value).withColumn("__order", F.struct(*order))
    inside = W.partitionBy(key, "__bucket").orderBy(*order)
    edges = rows.groupBy(key, "__bucket").agg(F.min_by(F.struct("__value"), "__order").alias("first"), F.max_by(F.struct("__value"), "__order").alias("last"))
    over = W.partitionBy(key).orderBy("__bucket")
    edges = edges.select(F.col(key).alias("__key"), F.col("__bucket").alias("__edge"), F.lag("last").over(over).alias("__before"), F.lead("first").over(over).alias("__after"))
    marked = rows.withColumn("__box", F.struct("__value")).withColumn("__lag", F.lag("__box").over(inside)).withColumn("__lead", F.lead("__box").over(inside))
    joined = marked.join(edges, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__bucket") == F.col("__edge")), "left")
    if previous:
        joined = joined.withColumn(previous, F.coalesce("__lag", "__before")["__value"])
    if following:
        joined = joined.withColumn(following, F.coalesce("__lead", "__after")["__value"])
    return joined.drop("__bucket", "__value", "__order", "__key", "__edge", "__before", "__after", "__box", "__lag", "__lead")


def last_before(df: DataFrame, key: str, order: list[str], value: Column, out: str, bucket: int = BUCKET) -> DataFrame:
    """``df`` with the last value that is not null among the rows before, in the order of its key."""
    rows = _bucketed(df, order, bucket).withColumn("__value", value).withColumn("__order", F.struct(*order))
    inside = W.partitionBy(key, "__bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    edges = rows.groupBy(key, "__bucket").agg(F.max_by("__value", F.when(F.col("__value").isNotNull(), F.col("__order"))).alias("last"))
    over = W.partitionBy(key).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    edges = edges.select(F.col(key).alias("__key"), F.col("__bucket").alias("__edge"), F.last("last", ignorenulls=True).over(over).alias("__before"))
    marked = rows.withColumn("__last", F.last("__value", ignorenulls=True).over(inside))
    joined = marked.join(edges, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__bucket") == F.col("__edge")), "left")
    return joined.withColumn(out, F.coalesce("__last", "__before")).drop("__bucket", "__value", "__order", "__key", "__edge", "__before", "__last")


def running_sum(df: DataFrame, key: str, order: list[str], value: Column, out: str, bucket: int = BUCKET) -> DataFrame:
    """``df`` with the sum of ``value`` from the first row of its key to this one, this one included."""
    rows = _bucketed(df, order, bucket).withColumn("__value", value)
    inside = W.partitionBy(key, "__bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    edges = rows.groupBy(key, "__bucket").agg(F.sum("__value").alias("s"))
    over = W.partitionBy(key).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    edges = edges.select(F.col(key).alias("__key"), F.col("__bucket").alias("__edge"), F.coalesce(F.sum("s").over(over), F.lit(0)).alias("__before"))
    marked = rows.withColumn("__sum", F.sum("__value").over(inside))
    joined = marked.join(edges, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__bucket") == F.col("__edge")), "left")
    return joined.withColumn(out, (F.col("__sum") + F.col("__before")).cast("int")).drop("__bucket", "__value", "__key", "__edge", "__before", "__sum")
