"""Token ids in ORC files, in ascending key order.

Ids are an int column, which ORC stores with integer run-length encoding. Every
stripe holds a row index (min, max and count per ``row_stride`` rows) and a Bloom
filter on the key, so a reader skips stripes and row groups by metadata, and one
file is read by several tasks, stripe by stripe. Each row also holds the range
(``part``) and the place in it (``seq``), which give the global order back.

Null and empty texts are stored as the end id alone; null keys come first;
rows with equal keys are ordered by the hash of their text and all kept.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.frames import lists, map_arrow, written
from pulsegrid.llm.tokens import encoder

SCHEMA = "part int, seq long, ids array<int>"


def write_tokens(
    df: DataFrame, vocabulary: str, out: str, end_id: int = 2, key: str = "doc_id", text: str = "text",
    stripe_bytes: int = 16 << 20, row_stride: int = 1000, false_positives: float = 0.01,
) -> None:
    """Encode every text, append ``end_id`` and write ORC files to ``out``."""
    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    ordered = source.repartitionByRange("k", F.xxhash64("t")).sortWithinPartitions("k", F.xxhash64("t"))

    def make():
        from pyspark import TaskContext

        enc, last = encoder(vocabulary), np.array([end_id], "<i4")
        part, seq = TaskContext.get().partitionId(), 0

        def step(batch):
            nonlocal seq
            found = [np.concatenate([enc.encode(x.as_py()), last]) for x in batch.column(1)]
            n = len(found)
            columns = [batch.column(0), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seq, seq + n)),
                       lists(found, pa.int32())]
            seq += n
            return pa.RecordBatch.from_arrays(columns, [key, "part", "seq", "ids"])

        return step

    rows = map_arrow(ordered, make, f"`{key}` {kind}, {SCHEMA}")
    (
        rows.write.option("orc.bloom.filter.columns", key)
        .option("orc.bloom.filter.fpp", str(false_positives))
        .option("orc.row.index.stride", str(row_stride))
        .option("orc.stripe.size", str(stripe_bytes))
        .orc(out)
    )


def read_tokens(spark: SparkSession, out: str, where: Column | None = None, key_type: str = "long",
                key: str = "doc_id") -> DataFrame:
    """The stored rows; ``where`` on the key prunes stripes by their metadata."""
    df = spark.read.schema(f"`{key}` {key_type}, {SCHEMA}").orc(out)
    return df if where is None else df.filter(where)


def with_starts(rows: DataFrame, size: str = "n_tokens") -> DataFrame:
    """Add ``start``: the ids of all rows before this one in the global order.

    Sums run inside each range; only one total per range meets in one task.
    """
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        rows.groupBy("part").agg(F.sum(size).alias("total"))
        .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    )
    return (
        rows.withColumn("inner", F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .join(base, "part")
        .withColumn("start", F.col("base") + F.col("inner"))
        .drop("base", "inner")
    )


def digests(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: its count of ids and the CRC-32 of them as little-endian words, and ``start``."""
    kind = rows.schema[key].dataType.simpleString()

    def make():
        def step(batch):
            ids = [x.values.to_numpy() for x in batch.column(3)]
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([zlib.crc32(x.astype("<i4").tobytes()) for x in ids], pa.int64())],
                [key, "part", "seq", "n_tokens", "ids_crc32"],
            )

        return step

    narrow = map_arrow(
        rows.select(key, "part", "seq", "ids"), make,
        f"`{key}` {kind}, part int, seq long, n_tokens long, ids_crc32 long",
    )
    return with_starts(written(narrow, "token-digests"))
