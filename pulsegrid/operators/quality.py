"""Reports on what arrived and guards on what leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from pulsegrid.contracts import REQUIRED
from pulsegrid.sources.landing import CORRUPT
from pulsegrid.sources.storage import read_table


def schema_drift_report(df: DataFrame, headers: dict[str, tuple[str, str]], table: str, technical: tuple = ()) -> DataFrame:
    """Known columns a batch lacks and new columns it brings; metadata only."""
    known = [ours for ours, _ in headers.values()]
    skip = {CORRUPT, "source_file", "_cast_errors", "partition_date", *technical}
    rows = [(table, c, "missing") for c in known if c not in df.columns]
    rows += [(table, c, "new") for c in df.columns if c not in known and c not in skip]
    return df.sparkSession.createDataFrame(rows, "table_name string, column_name string, change string")


def corrupt_row_report(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNotNull()).select("source_file", F.col(CORRUPT).alias("raw_text"))


def cast_error_report(df: DataFrame) -> DataFrame:
    return df.select(F.explode("_cast_errors").alias("column_name")).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("rows")
    )


class FanoutGuard:
    """Row counts of a plan's input and output, taken in the job that writes it."""

    def __init__(self, name: str):
        self.name = name
        self._in, self._out = Observation(f"{name}-in"), Observation(f"{name}-out")

    def before(self, df: DataFrame) -> DataFrame:
        return df.observe(self._in, F.count(F.lit(1)).alias("n"))

    def after(self, df: DataFrame) -> DataFrame:
        return df.observe(self._out, F.count(F.lit(1)).alias("n"))

    def check(self) -> tuple[int, int]:
        """Call after the write; raises when rows multiplied."""
        rows_in, rows_out = self._in.get["n"], self._out.get["n"]
        if rows_out > rows_in:
            raise ValueError(f"{self.name}: {rows_out} rows from {rows_in}")
        return rows_in, rows_out


def table_presence_report(spark: SparkSession, root: str, tables: list[str] | None = None) -> DataFrame:
    """Expected tables, whether they exist and how many rows they have."""
    report = None
    for name in tables or list(REQUIRED):
        df = read_table(spark, f"{root}/{name}")
        row = (
            spark.createDataFrame([(name, False, 0)], "table_name string, present boolean, rows bigint")
            if df is None
            else df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table_name"), F.lit(True).alias("present"), "rows"
            )
        )
        report = row if report is None else report.unionByName(row)
    return report
