"""Tables on storage: partitioned writes, tolerant reads, format switch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pulsegrid.session import prepare

FORMATS = ("parquet", "delta", "orc")
#: Partition column of bronze tables: the batch that wrote a row, so that a repeated batch replaces its own rows.
BATCH = "ingest_batch"


def table_format(name: str) -> str:
    if name not in FORMATS:
        raise ValueError(f"unknown table format {name}")
    return name


def write_bronze(
    df: DataFrame, path: str, fmt: str = "parquet", partition: str = "partition_date", batch: str = "appended"
) -> None:
    """Append; rows are gathered per partition first so a day is few files.

    New columns are simply written; readers merge the file schemas.
    """
    gathered = df.withColumn(BATCH, F.lit(batch)).hint("rebalance", F.col(partition))
    writer = gathered.write.format(table_format(fmt)).mode("append").partitionBy(partition, BATCH)
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    writer.save(path)


def write_partitions(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet") -> None:
    """Overwrite just the partitions present in ``df``.

    The rebalance hint lets adaptive execution split a heavy day over several
    tasks and merge light days, which a plain repartition by day would not.
    """
    prepare(df.sparkSession)
    rebalanced = df.hint("rebalance", *[F.col(c) for c in partition_by])
    rebalanced.write.format(table_format(fmt)).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partition_by).save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame | None:
    """The table, an empty frame with ``schema`` when missing, or None without one."""
    reader = spark.read.format(table_format(fmt))
    if fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None if schema is None else spark.createDataFrame([], schema)


def drop_partitions(spark: SparkSession, path: str, partition_by: list[str], values: list[tuple]) -> None:
    """Delete the folders of these values of the (leading) partition columns, with all that is below them."""
    jvm = spark.sparkContext._jvm
    names = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for value in values:
        parts = [names.getPartitionPathString(c, None if v is None else str(v)) for c, v in zip(partition_by, value)]
        folder = jvm.org.apache.hadoop.fs.Path("/".join([path, *parts]))
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def in_partitions(df: DataFrame, start: Column, end: Column, partition: str = "partition_date") -> DataFrame:
    """Date range on the partition column, so only those folders are listed and read."""
    return df.filter(F.col(partition).between(F.to_date(start), F.to_date(end)))


def external_table(spark: SparkSession, fmt: str, path: str, columns: dict[str, str], **options: str) -> DataFrame:
    """Another platform's table with its columns mapped to ours."""
    source = spark.read.format(fmt).options(**options).load(path)
    return source.select(*[F.col(f"`{theirs}`").alias(ours) for theirs, ours in columns.items()])


def with_provenance(df: DataFrame, collector: str, version: str, ingested_at: Column | None = None) -> DataFrame:
    """Source file, collector, version and ingestion time."""
    source = F.col("_metadata.file_path") if "source_file" not in df.columns else F.col("source_file")
    return df.withColumns(
        {
            "source_file": source,
            "collector": F.lit(collector),
            "collector_version": F.lit(version),
            "ingested_at": ingested_at if ingested_at is not None else F.current_timestamp(),
        }
    )
