"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings (never static ones): adaptive plans, skew splitting for
#: joins even where that costs one more exchange, UTC timestamps.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; shuffle partition counts stay the cluster's."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_local_base: list[str] = []


def shared_dir(spark: SparkSession, purpose: str, name: str | None = None) -> str:
    """A folder below ``spark.checkpoint.dir``: fresh, or the same again for ``name``.

    Only a local session without that setting gets a temporary folder; a
    cluster session without it is refused, because executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if not _local_base:
            _local_base.append(tempfile.mkdtemp(prefix="pulsegrid-"))
        base = _local_base[0]
    tail = uuid.uuid4().hex if name is None else hashlib.sha256(name.encode()).hexdigest()[:16]
    return f"{base.rstrip('/')}/{purpose}-{tail}"


def materialize(
    df: DataFrame, purpose: str, partition_by: list[str] | None = None, name: str | None = None
) -> DataFrame:
    """Write once to the shared folder and read back, for inputs used many times.

    The written files replace the lineage, so a lost executor costs a re-read
    and not a recomputation. With ``name`` the files of the last use are replaced.
    """
    path = shared_dir(df.sparkSession, purpose, name)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
