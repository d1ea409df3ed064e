"""Small Arrow helpers shared by the operators that run Python inside tasks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pulsegrid import session
from pulsegrid.session import shared_dir

#: Rows that one Arrow batch holds: texts are long, and a worker has a few batches alive.
BATCH_ROWS = "1000"


def prepare(spark: SparkSession) -> SparkSession:
    """The library's runtime settings, batches of few rows, and shuffle files that go when their query has ended.

    Each step is written and the next one reads what was written, so nothing asks for those files again.
    """
    conf = session.prepare(spark).conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, wanted: str) -> str:
    """``wanted``, or it with underscores behind, so that it clashes with no column (any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def ship(spark) -> None:
    """Let Python workers find this package where it lies (a cluster without that path needs --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    found = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in found.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, found) if x)


def map_arrow(df: DataFrame, make: Callable[[], Callable], schema) -> DataFrame:
    """``make()`` runs once per task and returns batch -> batch (or None)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            out = step(batch)
            if out is not None and out.num_rows:
                yield out

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def with_schema(df: DataFrame, extra: str) -> StructType:
    """The columns of ``df`` and then those of the DDL text ``extra``."""
    return StructType(df.schema.fields + StructType.fromDDL(extra).fields)


def texts(column) -> list:
    """The Python strings of an Arrow text column, in pieces so that few are alive at once."""
    return column.to_pylist()


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """One Arrow list per array."""
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(x) for x in parts], out=ends[1:])
    values = np.concatenate(parts) if parts else np.empty(0, kind.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=kind))


def append(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], [*batch.schema.names, *columns])


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.folder = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` whose last reader has been written itself."""
    for table in tables:
        spark = table.sparkSession
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.folder)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
