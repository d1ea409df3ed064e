"""Incremental file ingestion: every landed file exactly once.

The file source with a checkpoint replaces a hand-kept watermark: a file is
recorded as done only with the batch that wrote it, so a failed run repeats it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.sources import landing as L


def stream_wrapper_json(spark: SparkSession, folder: str, pattern: str, schema: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("multiLine", True).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(folder)


def stream_staged_logs(spark: SparkSession, folder: str, pattern: str = "gateway_logs_*.json") -> DataFrame:
    return L.parse_staged_csv(
        L.route_by_log_type(stream_wrapper_json(spark, folder, pattern, L.STAGED))
    )


def stream_log_csv(spark: SparkSession, folder: str, pattern: str, log_type: str) -> DataFrame:
    """Raw CSV logs as a stream: one file per row, parsed by header name."""
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select(
            F.element_at(F.split("_metadata.file_path", "/"), -1).alias("SourceFileName"),
            F.lit(None).cast("string").alias("GatewayHostName"),
            F.col("_metadata.file_modification_time").cast("string").alias("CollectedAtUtc"),
            F.col("value").alias("RawCsvContent"),
            F.lit(log_type).alias("log_type"),
        )
    )
    return L.typed_staged(L.parse_staged_csv(files), log_type)


def start_bronze(stream: DataFrame, path: str, checkpoint: str, partition: str | None = "partition_date") -> StreamingQuery:
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition:
        writer = writer.partitionBy(partition)
    return writer.trigger(availableNow=True).start(path)


def run_bronze(stream: DataFrame, path: str, checkpoint: str, partition: str | None = "partition_date") -> StreamingQuery:
    query = start_bronze(stream, path, checkpoint, partition)
    query.awaitTermination()
    return query


def stream_upsert(
    stream: DataFrame, merge: Callable[[DataFrame], None], checkpoint: str, output_mode: str = "update"
) -> StreamingQuery:
    """Hand each micro-batch to a keyed upsert; repeating a batch changes nothing."""
    query = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, _: merge(df))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def late_data_report(query: StreamingQuery) -> DataFrame:
    """Rows each stateful step dropped as late, per micro-batch, from the progress metrics."""
    rows = [
        (p["batchId"], i, s.get("operatorName", ""), int(s.get("numRowsDroppedByWatermark", 0)), int(p["numInputRows"]))
        for p in query.recentProgress
        for i, s in enumerate(p["stateOperators"])
    ]
    return SparkSession.active().createDataFrame(
        rows, "batch_id bigint, step int, operator string, dropped_rows bigint, input_rows bigint"
    )
