"""All landed files to bronze tables, each file once, whatever fails in between.

Three streams cover the landing folder: log files (by lines, split over tasks), wrapped
JSON objects (whole files) and JSON lines. Each micro-batch is staged once, by kind of file, and
feeds all tables of its stream. What a batch adds to a table carries the batch's name in
the partition column ``ingest_batch``; the files of a batch are fixed by the checkpoint, so
a batch that is repeated after a failure replaces just what it wrote before, in every table,
and a second run adds nothing. The name holds the id of the checkpoint, so a fresh
checkpoint never replaces older rows.

A file that cannot be parsed is set aside in ``landing_rejected`` and the rest of its
batch goes on. Every run first tries set-aside files again, ``RETRY_FILES`` of them at most,
oldest first. Which ones is written down before they are read, so a retry that
was cut off is repeated with the same files under the same name. An empty file has no
rows and is not looked at again, so writers should move whole files into the folder. Read
the tables through ``Lake.read``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pulsegrid.contracts import conform
from pulsegrid.session import materialize
from pulsegrid.sources import landing as L, records
from pulsegrid.sources.storage import BATCH, read_table, write_partitions

REJECTED = "landing_rejected"
REJECTED_SCHEMA = "path string, stream string, reason string, resolved boolean, at timestamp, ingest_batch string"
#: Files set aside that one run tries again; the others wait for the next run.
RETRY_FILES = 1000
_FILE = "_metadata.file_path AS file"


@dataclass(frozen=True)
class Landing:
    """One stream: the files it takes, how they are read, staged and judged, and the tables of each kind of file."""

    name: str
    glob: str
    kinds: dict[str, str]  # kind -> pattern of file names
    read: Callable  # a reader, batch or stream -> path -> rows with ``file``
    stage: Callable[[DataFrame], DataFrame]  # what is written of the rows, ``file`` included
    broken: Callable[[DataFrame], DataFrame]  # staged rows -> (file, reason) of bad files, each once
    tables: dict[str, list[tuple[str, Callable[[DataFrame], DataFrame]]]]  # kind -> tables and their rows


def _named(pattern: str) -> Column:
    """Whether a file's name is like ``pattern`` (``*`` is anything)."""
    return F.element_at(F.split("file", "/"), -1).like(pattern.replace("_", r"\_").replace("*", "%"))


def _lines(reader):
    return lambda path: reader.format("text").option("lineSep", "\n").load(path).selectExpr(*records.LINE_COLUMNS)


def _whole(reader):
    return lambda path: reader.format("text").option("wholetext", True).load(path).selectExpr(_FILE, "value")


def _open_quotes(staged: DataFrame) -> DataFrame:
    """Logs whose last quote is never closed, as when only a part of them has landed."""
    turns = staged.groupBy("file").agg((F.sum("odd") % 2).alias("left"))
    return turns.filter("left = 1").select("file", F.lit("a quote is not closed").alias("reason"))


def _no_objects(staged: DataFrame) -> DataFrame:
    parsed = F.expr("try_parse_json(value)").isNotNull() & F.col("value").rlike(r"^\s*[\[{]")
    return staged.filter(~parsed).select("file", F.lit("not a JSON object").alias("reason"))


def _bad_lines(staged: DataFrame) -> DataFrame:
    """Files with a line that is no JSON object; none of their rows is taken then."""
    bad = (F.trim("value") != "") & (F.expr("try_parse_json(value)").isNull() | ~F.col("value").rlike(r"^\s*\{"))
    return staged.filter(bad).select("file").distinct().withColumn("reason", F.lit("a line is not a JSON object"))


def _log(log_type: str):
    return lambda rows: L.log_by_name(records.parsed(rows).withColumnRenamed("file", "source_file"), log_type)


def _objects(rows: DataFrame, schema: str) -> DataFrame:
    """Each file is one object or an array of them."""
    text = F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(F.concat(F.lit("["), F.col("value"), F.lit("]")))
    kind = f"array<{StructType.fromDDL(schema).simpleString()}>"
    return rows.select(F.explode(F.from_json(text, kind)).alias("x")).select("x.*")


def _flat(table: str, schema: str, flatten):
    return lambda rows: conform(flatten(_objects(rows, schema)), table)


def _staged(log_type: str):
    return lambda rows: L.typed_staged(L.parse_staged_csv(L.route_by_log_type(_objects(rows, L.STAGED))), log_type).drop("log_type")


def _processes(rows: DataFrame) -> DataFrame:
    return L.type_processes(_objects(rows.filter(F.trim("value") != ""), L.PROCESS))


LOG_TABLES = {
    "QueryExecution": "bronze_query_execution", "QueryStart": "bronze_query_start",
    "SystemCounter": "bronze_system_counter", "QueryAggregation": "bronze_query_aggregation",
}
LANDINGS = [
    Landing(
        "logs", "*Report*.{csv,log}",
        {"QueryExecution": "*QueryExecutionReport*", "QueryStart": "*QueryStartReport*",
         "SystemCounter": "*SystemCounterReport*", "QueryAggregation": "*QueryExecutionAggregationReport*"},
        _lines, records.number_lines, _open_quotes, {k: [(t, _log(k))] for k, t in LOG_TABLES.items()},
    ),
    Landing(
        "objects", "*.json",
        {k: f"{k}_*.json" for k in ("network_metrics", "event_log", "disk_spool", "gateway_inventory", "refresh_history", "gateway_logs")},
        _whole, lambda rows: rows, _no_objects,
        {
            "network_metrics": [("bronze_network_metrics", _flat("bronze_network_metrics", L.NETWORK, L.flatten_network_metrics))],
            "event_log": [("bronze_event_log", _flat("bronze_event_log", L.EVENTS, L.flatten_event_log))],
            "disk_spool": [("bronze_disk_spool", _flat("bronze_disk_spool", L.DISK, L.flatten_disk_spool))],
            "gateway_inventory": [
                ("bronze_inventory", _flat("bronze_inventory", L.INVENTORY, L.flatten_inventory)),
                ("bronze_datasources", _flat("bronze_datasources", L.INVENTORY, L.flatten_datasources)),
            ],
            "refresh_history": [("bronze_refresh_history", _flat("bronze_refresh_history", L.REFRESH, L.flatten_refresh_history))],
            "gateway_logs": [(t, _staged(k)) for k, t in LOG_TABLES.items()],
        },
    ),
    Landing(
        "records", "MashupProcesses_*.json", {"processes": "MashupProcesses_*.json"},
        _lines, lambda rows: rows, _bad_lines, {"processes": [("bronze_processes", _processes)]},
    ),
]


class Ingest:
    """Feeds the tables below ``root`` from ``landing``; ``checkpoints`` remembers what was read."""

    def __init__(self, spark: SparkSession, root: str, landing: str, fmt: str = "parquet",
                 checkpoints: str | None = None, max_files: int | None = None):
        self.spark, self.root, self.landing, self.fmt, self.max_files = spark, root, landing, fmt, max_files
        self.checkpoints = checkpoints or f"{root}/_landing"

    def run(self) -> dict[str, int]:
        """Try again what was set aside, then take what has landed since the last run: batches with rows per stream."""
        done = {}
        for source in LANDINGS:
            self._retry(source)
            reader = self.spark.readStream
            if self.max_files:
                reader = reader.option("maxFilesPerTrigger", self.max_files)
            query = (
                source.read(reader)(f"{self.landing}/{source.glob}").writeStream
                .option("checkpointLocation", f"{self.checkpoints}/{source.name}")
                .foreachBatch(lambda rows, number, source=source: self._batch(source, rows, number))
                .trigger(availableNow=True).start()
            )
            query.awaitTermination()
            done[source.name] = sum(p["numInputRows"] > 0 for p in query.recentProgress)
        return done

    def rejected(self) -> DataFrame:
        """Files that are set aside and have not been read since: path, stream, reason, at."""
        rows = read_table(self.spark, f"{self.root}/{REJECTED}", self.fmt)
        if rows is None:
            rows = self.spark.createDataFrame([], REJECTED_SCHEMA)
        state = rows.groupBy("path", "stream").agg(
            F.max_by("reason", "at").alias("reason"), F.min("at").alias("at"), F.max("resolved").alias("resolved")
        )
        return state.filter("not resolved").drop("resolved")

    def _batch(self, source: Landing, rows: DataFrame, number: int) -> None:
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        name = f"{source.name}-{query[:8]}-{number:08d}"
        bad = self._feed(source, rows, name)
        self._mark(source, bad, F.lit(False), name)

    def _feed(self, source: Landing, rows: DataFrame, name: str) -> DataFrame:
        """Write a batch to its tables; (file, reason) of the files that are bad."""
        kind = F.coalesce(*[F.when(_named(p), k) for k, p in source.kinds.items()])
        staged = materialize(
            source.stage(rows).withColumn("kind", kind).filter("kind is not null"), "landing-batch", ["kind"],
            name=f"{self.root} {source.name}",
        )
        bad = materialize(source.broken(staged), "landing-bad", name=f"{self.root} {source.name}")
        good = staged.join(bad.select("file"), "file", "left_anti")
        for found in [r.kind for r in staged.select("kind").distinct().collect()]:  # a handful
            for table, build in source.tables[found]:
                rows_of = build(good.filter(F.col("kind") == found).drop("kind"))
                self._write(rows_of, table, ["partition_date", BATCH], name)
        return bad

    def _mark(self, source: Landing, files: DataFrame, resolved: Column, name: str) -> None:
        rows = files.select(
            F.col("file").alias("path"), F.lit(source.name).alias("stream"), "reason", resolved.alias("resolved"),
            F.current_timestamp().alias("at"),
        )
        self._write(rows, REJECTED, [BATCH], name)

    def _write(self, rows: DataFrame, table: str, partition: list[str], name: str) -> None:
        write_partitions(rows.withColumn(BATCH, F.lit(name)), f"{self.root}/{table}", partition, self.fmt)

    def _retry(self, source: Landing) -> None:
        """Read set-aside files again. The last plan is repeated if it did not come to its end."""
        folder = f"{self.checkpoints}/{source.name}-retries"
        plans = read_table(self.spark, folder)
        last = None if plans is None else plans.agg(F.max("plan")).first()[0]
        marked = read_table(self.spark, f"{self.root}/{REJECTED}", self.fmt)
        name = lambda n: f"retry-{source.name}-{n:08d}"
        if last is None or not marked.filter(F.col(BATCH) == name(last)).isEmpty():
            waiting = self.rejected().filter(F.col("stream") == source.name).orderBy("at", "path").limit(RETRY_FILES).select("path")
            if waiting.isEmpty():
                return
            last = 0 if last is None else last + 1
            write_partitions(waiting.withColumn("plan", F.lit(last)), folder, ["plan"])
            plans = read_table(self.spark, folder)
        paths = [r.path for r in plans.filter(F.col("plan") == last).collect()]  # RETRY_FILES at most
        alive = [p for p in paths if self._exists(p)]
        asked = self.spark.createDataFrame([(p, p in alive) for p in paths], "file string, alive boolean")
        bad = self._feed(source, source.read(self.spark.read)(alive), name(last)) if alive else None
        outcome = asked.withColumn("reason", F.when(~F.col("alive"), "the file is gone"))
        if bad is not None:
            outcome = asked.join(bad, "file", "left").withColumn(
                "reason", F.when(~F.col("alive"), "the file is gone").otherwise(F.col("reason")))
        # what is gone can never be read: it is done with as well
        self._mark(source, outcome, F.col("reason").isNull() | ~F.col("alive"), name(last))

    def _exists(self, path: str) -> bool:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
