"""New files of a folder as they arrive: the batch operators over micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.operators.guards import route
from leafmill.sources.documents import blocks, extract

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def watch(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of the folder's supported files."""
    raw = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    return route(raw).where(F.col("reader").isNotNull())


def extract_to(spark: SparkSession, folder: str, target: str, checkpoint: str) -> StreamingQuery:
    """Write the blocks of every new file to ``target`` once, until no file is left."""

    def batch(files: DataFrame, number: int) -> None:
        # The batch number names the folder: a batch that runs again replaces what it had written.
        blocks(extract(files)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return watch(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
