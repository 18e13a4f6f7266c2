"""Readers of the tables, with fixed schemas so that nothing is inferred and identifiers stay strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Y


def _strings(*names: str) -> Y.StructType:
    return Y.StructType([Y.StructField(n, Y.StringType()) for n in names])


LOTS = Y.StructType([Y.StructField("idx", Y.IntegerType()), *_strings("num", "title", "text", "catalogue_id").fields])
INCONSISTENCIES = Y.StructType(
    [Y.StructField("catalogue_id", Y.StringType()), Y.StructField("prev_num", Y.LongType()), Y.StructField("current_num", Y.LongType()), *_strings("title", "excerpt").fields]
)
PAGES = _strings("filename")
CATALOGUES = _strings("nome_cartella", "titolo", "altri_titoli", "data_pubblicazione", "lingue", "vendita_asta", "autori_principali", "ente_autore_principale", "ente_autore_secondario", "autori_secondari")
AUCTIONS = _strings("inventario", "luogo_vendita", "data_inizio_asta", "data_fine_asta", "collezionisti", "autore_principale", "autore_secondario", "banditore", "tipi_oggetti", "cronologia")
AGENTS = _strings("uri", "label", "agent_type", "wikidata_id", "wikidata_label", "wikidata_description", "match_type")


def read_csv(spark: SparkSession, path: str, schema: Y.StructType) -> DataFrame:
    """A sheet or lot table as CSV with a header, quotes doubled, line breaks inside quotes. Columns go by place."""
    options = {"header": True, "multiLine": True, "escape": '"', "encoding": "utf-8", "enforceSchema": True}
    return spark.read.schema(schema).options(**options).csv(path)


def read_documents(spark: SparkSession, folder: str, catalogues: list[str] | None = None) -> DataFrame:
    """``(catalogue_id, text)`` of ``<folder>/<catalogue>/md/all.md``, one row per file; a missing file gives no row.

    ``catalogues`` limits the listing to these folders, so that others are not read.
    """
    some = "*" if catalogues is None else "{" + ",".join(catalogues) + "}"
    files = spark.read.text(f"{folder}/{some}/md/all.md", wholetext=True)
    return files.select(F.regexp_extract("_metadata.file_path", r"([^/]+)/md/all\.md$", 1).alias("catalogue_id"), F.col("value").alias("text"))


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``(catalogue_id, page, text)`` of all ``*.md`` page files of a folder of catalogues."""
    files = spark.read.option("pathGlobFilter", "*.md").text(f"{folder}/*/md", wholetext=True)
    path = F.col("_metadata.file_path")
    return files.select(F.regexp_extract(path, r"([^/]+)/md/[^/]+$", 1).alias("catalogue_id"), F.regexp_extract(path, r"([^/]+)$", 1).alias("page"), F.col("value").alias("text"))


def read_images(spark: SparkSession, folder: str, pattern: str = "*.jpg") -> DataFrame:
    """``(folder, filename, path, content)`` of page images; the bytes are only read where ``content`` is used."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"), F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), "path", "content")


def page_list(spark: SparkSession, names: list[str]) -> DataFrame:
    """A hand-written list of pages as a frame."""
    return spark.createDataFrame([(n,) for n in names], PAGES)
