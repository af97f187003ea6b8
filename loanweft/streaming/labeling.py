"""Incremental labeling and counting: each run takes the files that arrived since the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loanweft.operators.labels import add_target, keep_labeled


def label_new_files(spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str,
                    status: str = "loan_status", files_per_batch: int = 10_000) -> StreamingQuery:
    """S9. Append the labeled rows of new Parquet files to ``sink`` and stop.

    Labeling keeps no state, so no watermark is needed; the checkpoint records
    which files are done, and the file sink commits each batch once.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = (
        keep_labeled(add_target(stream, status)).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)
    )
    query.awaitTermination()
    return query


def count_new_files(spark: SparkSession, source: str, schema: T.StructType, column: str, sink: str, checkpoint: str,
                    files_per_batch: int = 10_000) -> DataFrame:
    """A1, A3. Rows per value of a column over all files that have arrived so far, reading only the new ones.

    The counts are the stream's state, one per value. Each batch writes those it
    has changed under its number, so a batch that is run again replaces itself;
    ``current_counts`` reads the last one of every value.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    counted = stream.groupBy(column).agg(F.count(F.lit(1)).alias("count"))

    def put(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{sink}/batch={batch}")

    counted.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
    return current_counts(spark, sink, column)


def current_counts(spark: SparkSession, sink: str, column: str) -> DataFrame:
    """(column, count): the last count of every value."""
    return spark.read.parquet(sink).groupBy(column).agg(F.max_by("count", "batch").alias("count"))
