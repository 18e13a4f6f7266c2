"""Which lots need revision, and how many per catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerlot.functions import text as T


def cleaned(x: Column | str) -> Column:
    """A text as the flags compare it: stripped, null as the text ``nan``."""
    name = x if isinstance(x, str) else None
    column = F.col(name) if name else x
    return F.coalesce(F.regexp_replace(column.cast("string"), rf"\A{T.SPACE}+|{T.SPACE}+\z", ""), F.lit("nan"))


def flag_needs_revision(lots: DataFrame, found: DataFrame, key: str = "catalogue_id") -> DataFrame:
    """``lots`` with ``needs_revision``: whether an inconsistency names the lot's catalogue, number and text.

    The number is compared as it is written, so ``I3`` never equals 3. The three parts are compared by one digest of all,
    so no text is shuffled for the comparison, and the inconsistencies are few and short enough to be sent to the lots;
    they are reduced to distinct ones, so no lot is repeated. Columns of ``lots`` are kept as they are.
    """
    parts = found.select(cleaned(key).alias("__k"), cleaned("current_num").alias("__n"), cleaned("excerpt").alias("__x"))
    # Only hashes of texts are joined; a digest of 128 bits stands for the text.
    marks = parts.select(F.md5(F.to_json(F.struct("__k", "__n", "__x"))).alias("__mark")).distinct().withColumn("__hit", F.lit(True))
    own = F.struct(cleaned(lots[key]).alias("__k"), cleaned(lots["num"]).alias("__n"), cleaned(lots["text"]).alias("__x"))
    joined = lots.withColumn("__mark", F.md5(F.to_json(own))).join(marks, "__mark", "left")
    return joined.withColumn("needs_revision", F.col("__hit").isNotNull()).drop("__mark", "__hit")


def catalogue_stats(flagged: DataFrame, key: str = "catalogue_id") -> DataFrame:
    """``(key, issues, total, percent_issues)``; per cent to one place, halves to even. Rows of a null catalogue are left out."""
    counted = flagged.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_if("needs_revision").alias("issues"), F.count("needs_revision").alias("total"))
    return counted.withColumn("percent_issues", F.bround(F.col("issues") / F.col("total") * 100, 1))
