"""Fitted transforms on a stream.

Every fitted state in this library is either literals or a small lookup
table, so ``transform`` is a projection plus a stream-static join: it runs
unchanged on a streaming DataFrame.  No streaming state is kept (the
reference is batch only); new rows are scored as they arrive and written
with ``foreachBatch`` (idempotent per batch id) under a checkpoint in the
shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabstack.session import scratch_path


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType,
                      max_files_per_trigger: int = 1000) -> DataFrame:
    """Stream the parquet file(s) of one table in ``sf_dir``."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(sf_dir))


def score_stream(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out_path: str,
                 checkpoint: str | None = None):
    """Apply ``transform`` to every micro-batch and append the result to
    ``out_path``; runs until the available input is processed."""
    spark = stream.sparkSession
    ck = checkpoint or scratch_path(spark, "stream-ckpt")

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", ck) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return q
