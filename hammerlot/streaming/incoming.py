"""New catalogue texts as a stream: each file is cut into lots once, whenever the stream runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hammerlot.operators.chunking import chunk_pipeline


def incoming_documents(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    """Streaming ``(catalogue_id, text)`` of ``<folder>/<catalogue>/md/all.md`` files as they arrive."""
    files = spark.readStream.option("maxFilesPerTrigger", max_files).text(f"{folder}/*/md/all.md", wholetext=True)
    return files.select(F.regexp_extract("_metadata.file_path", r"([^/]+)/md/all\.md$", 1).alias("catalogue_id"), F.col("value").alias("text"))


def run_incoming(spark: SparkSession, folder: str, lots: str, report: str, checkpoint: str) -> StreamingQuery:
    """Cut and repair every new catalogue and append its lots and inconsistencies; stops when all files are read.

    The repairs need a whole catalogue in order, which a file is, so each batch runs the batch pipeline.
    """

    def batch(documents: DataFrame, _: int) -> None:
        found, left = chunk_pipeline(documents)
        found.write.mode("append").parquet(lots)
        left.write.mode("append").parquet(report)

    stream = incoming_documents(spark, folder).writeStream.foreachBatch(batch)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
