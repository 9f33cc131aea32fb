"""Fingerprints of files as they arrive (an extension: the original works on a finished tree)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarrylens.operators.fingerprints import fingerprints


def arriving_files(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """``path, text`` of text files that appear in a folder."""
    rows = spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", files_per_trigger).load(folder)
    return rows.select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def arriving_documents(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """``path, text`` of document rows in Parquet files that appear in a folder."""
    rows = spark.readStream.schema(schema).parquet(folder)
    return rows.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".py")).alias("path"), F.coalesce("text", F.lit("")).alias("text"))


def start(files: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append the fingerprints to Parquet. They need no state, and the file sink with its checkpoint
    writes each file's once, also after a restart."""
    return fingerprints(files).writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
