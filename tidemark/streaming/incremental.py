"""New report files since the last run, as a stream that ends when it has caught up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null
from ..sources.reports import normalise_headers
from ..sources.typed import coerce

BATCH = "load_batch"


def report_stream(spark: SparkSession, folder: str, header: Sequence[str]) -> DataFrame:
    """Report files of one header as a stream of trimmed text columns."""
    names = normalise_headers(header)
    if len(set(names)) != len(names):
        raise ValueError("headers normalise alike; rename one")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    lines = (spark.readStream.schema(schema).option("header", True).option("multiLine", True)
             .option("escape", '"').csv(folder))
    return lines.select(*[blank_to_null(F.col(n)).alias(n) for n in names],
                        F.col("_metadata.file_name").alias("_source_filename"))


def load_new_files(spark: SparkSession, folder: str, header: Sequence[str],
                   types: Mapping[str, str], target: str, checkpoint: str) -> int:
    """Append the files that came since the last run; returns the batches written.

    The checkpoint is the ledger of files.  A batch writes its own folder and
    overwrites it when it is repeated after a failure, so every file is loaded
    exactly once.
    """
    written: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        typed, _ = coerce(batch, types, ["_source_filename"])
        (typed.withColumn("_import_timestamp", F.current_timestamp())
         .write.mode("overwrite").parquet(f"{target.rstrip('/')}/{BATCH}={batch_id}"))
        written.append(batch_id)

    query = (report_stream(spark, folder, header).writeStream
             .foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return len(written)


def loaded(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target)
