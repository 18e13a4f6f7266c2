"""Edits by curators, each a function from one snapshot of the tables to the next; flags are always computed anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hammerlot.functions import text as T
from hammerlot.operators.chunking import inconsistencies
from hammerlot.operators.quality import flag_needs_revision


def view_catalogue(flagged: DataFrame, catalogue_id: str, key: str = "catalogue_id") -> DataFrame:
    """Rows of one catalogue with ``anchor_id``; no rows for an unknown one. Give it a frame made of that catalogue only
    (the repairs work catalogue by catalogue), and no other is read or repaired."""
    return flagged.where(F.col(key) == catalogue_id).withColumn("anchor_id", F.concat(F.lit("chunk-"), F.col("idx").cast("string")))


def form_rows(spark: SparkSession, num: list[str], title: list[str], text: list[str]) -> DataFrame:
    """``(pos, num, title, text)`` of a form's repeated fields, put together by place and cut to the shortest list."""
    rows = [(i, *fields) for i, fields in enumerate(zip(num, title, text, strict=False), 1)]
    return spark.createDataFrame(rows, "pos int, num string, title string, text string")


def save_catalogue(lots: DataFrame, edited: DataFrame, catalogue_id: str, key: str = "catalogue_id") -> DataFrame:
    """``lots`` with the rows of one catalogue replaced by ``edited(pos, num, title, text)``, and all flags computed anew.

    Edited rows are numbered from 1 in the order of ``pos``, then of number, title and text; null positions come last,
    so no row is lost or repeated. Their fields are stripped. An empty edit removes the catalogue. Rows of a null
    catalogue stay. Columns that the edit lacks are null in its rows. Flags compare with the inconsistencies of the new
    state. An edit is one form, so it is numbered in one task.
    """
    kept = lots.drop("needs_revision").where(~F.col(key).eqNullSafe(F.lit(catalogue_id)))
    rows = edited.select(F.lit(catalogue_id).alias(key), "pos", *[F.expr(T.strip(c)).alias(c) for c in ("num", "title", "text")])
    place = F.row_number().over(W.partitionBy(key).orderBy(F.asc_nulls_last("pos"), "num", "title", "text"))
    new = rows.select(key, place.cast("int").alias("idx"), "num", "title", "text")
    saved = kept.unionByName(new, allowMissingColumns=True)
    return flag_needs_revision(saved, inconsistencies(saved, key), key)


def update_chunk(lots: DataFrame, found: DataFrame, catalogue_id: str, idx: int, title: str, text: str, key: str = "catalogue_id") -> DataFrame:
    """``lots`` with title and text of one lot set (stripped), and all flags computed anew; no such lot, no change."""
    here = F.coalesce((F.col(key) == catalogue_id) & (F.col("idx") == idx), F.lit(False))
    edited = lots.withColumn("title", F.when(here, F.lit(title.strip())).otherwise(F.col("title"))).withColumn("text", F.when(here, F.lit(text.strip())).otherwise(F.col("text")))
    return flag_needs_revision(edited.drop("needs_revision"), found, key)


def resolve_inconsistency(found: DataFrame, catalogue_id: str, num: str, by: str = "prev_num", key: str = "catalogue_id") -> DataFrame:
    """``found`` without the records of one catalogue whose ``by`` column (``prev_num`` or ``current_num``) is ``num``."""
    if by not in ("prev_num", "current_num"):
        raise ValueError("by is prev_num or current_num")
    gone = (F.col(key) == catalogue_id) & (F.col(by).cast("string") == num)
    return found.where(~F.coalesce(gone, F.lit(False)))


def removed_any(before: DataFrame, after: DataFrame) -> bool:
    """Whether a resolution removed a record."""
    return before.count() != after.count()
