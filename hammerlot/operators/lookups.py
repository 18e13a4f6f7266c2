"""Look-ups in controlled vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def required_lookup(rows: DataFrame, vocabulary: DataFrame, column: str, out: str = "code") -> DataFrame:
    """``rows`` with ``out``, the code of ``column`` in ``vocabulary(label, code)``; a value that is not there, null
    included, stops the job with its name. Vocabularies are fixed and small, so they are broadcast."""
    listed = F.broadcast(vocabulary.select(F.col("label").alias("__label"), F.col("code").alias("__code"), F.lit(True).alias("__there")))
    joined = rows.join(listed, rows[column] == F.col("__label"), "left")
    missing = F.raise_error(F.concat(F.lit(f"no entry for {column} "), F.coalesce(F.col(column).cast("string"), F.lit("null"))))
    return joined.withColumn(out, F.when(F.col("__there"), F.col("__code")).otherwise(missing.cast("string"))).drop("__label", "__code", "__there")
