"""Landed files exactly once: second runs, failures between tables, files set aside."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixtures import EXEC_HEAD, at, execution, write_landing
from pulsegrid.plans import medallion as M
from pulsegrid.sources import landing as L
from pulsegrid.streaming import landing as S

TABLES = sorted({t for s in S.LANDINGS for feeds in s.tables.values() for t, _ in feeds})


def counts(lake):
    found = {t: lake.read(t) for t in TABLES}
    return {t: df.count() for t, df in found.items() if df is not None}


def log(path, *rows):
    path.write_text("\n".join([EXEC_HEAD, *rows]) + "\n")


def test_every_type_lands_once_and_new_files_are_added(spark, tmp_path):
    landing, lake = tmp_path / "in", M.Lake(spark, str(tmp_path / "lake"))
    landing.mkdir()
    write_landing(landing)
    assert M.ingest(lake, str(landing)) == {}
    first = counts(lake)
    assert first["bronze_query_execution"] == 8 and first["bronze_processes"] == 18 and first["bronze_network_metrics"] == 6
    assert "bronze_query_aggregation" not in first
    direct = L.ingest_log(spark, f"{landing}/QueryExecutionReport*.csv", "QueryExecution").select("request_id", "end_ts", "duration_ms", "error_message")
    assert Counter(direct.collect()) == Counter(lake.read("bronze_query_execution").select(*direct.columns).collect())
    M.ingest(lake, str(landing))
    assert counts(lake) == first
    log(landing / "QueryExecutionReport9.csv", execution("n1", "new", "S", "t", at(40), 5, True))
    (landing / "GatewayPerformanceData_QueryExecutionAggregationReport_1.log").write_text(
        "GatewayObjectId,AggregationEndTimeUTC,Count\nn1,2024-03-05 12:00:00,7\n")
    (landing / "gateway_logs_1.json").write_text(json.dumps([
        {"SourceFileName": "QueryExecutionReport_s.csv", "GatewayHostName": "H", "CollectedAtUtc": at(0),
         "RawCsvContent": EXEC_HEAD + "\n" + execution("n1", "staged", "S", "t", at(41), 5, True, 'two\nlines, "quoted"')}]))
    M.ingest(lake, str(landing), max_files=1)
    assert counts(lake) == {**first, "bronze_query_execution": 10, "bronze_query_aggregation": 1}
    staged = lake.read("bronze_query_execution").filter("request_id = 'staged'").first()
    assert staged.error_message == 'two\nlines, "quoted"'


def test_a_run_killed_between_two_tables_is_repaired_by_the_next(spark, tmp_path, monkeypatch):
    landing, lake = tmp_path / "in", M.Lake(spark, str(tmp_path / "lake"))
    landing.mkdir()
    write_landing(landing)
    write, calls = S.Ingest._write, []

    def fails(self, rows, table, partition, name):
        calls.append(table)
        if len(calls) == 3:
            raise OSError("killed")
        write(self, rows, table, partition, name)

    monkeypatch.setattr(S.Ingest, "_write", fails)
    with pytest.raises(Exception, match="killed"):
        M.ingest(lake, str(landing))
    part = counts(lake)
    assert 0 < len(part) < 10
    monkeypatch.setattr(S.Ingest, "_write", write)
    M.ingest(lake, str(landing))
    whole = M.Lake(spark, str(tmp_path / "other"))
    M.ingest(whole, str(landing))
    assert counts(lake) == counts(whole)
    # a fresh checkpoint is another source: it never replaces older rows
    S.Ingest(spark, lake.root, str(landing), checkpoints=str(tmp_path / "fresh")).run()
    assert counts(lake) == {t: 2 * n for t, n in counts(whole).items()}


def test_bad_files_are_set_aside_and_tried_again(spark, tmp_path, monkeypatch):
    landing, lake = tmp_path / "in", M.Lake(spark, str(tmp_path / "lake"))
    landing.mkdir()
    write_landing(landing)
    M.ingest(lake, str(landing))
    before = counts(lake)
    whole = (landing / "disk_spool_0.json").read_text()
    (landing / "disk_spool_7.json").write_text(whole[:40])
    (landing / "disk_spool_8.json").write_text("[1")
    (landing / "MashupProcesses_7.json").write_text('{"HostName": "H1", "CollectedAtUtc": "2024-03-05T12:00:00Z"}\n{"HostName"')
    log(landing / "QueryExecutionReport7.csv", execution("n1", "half", "S", "t", at(40), 5, True), 'n1,r,"never closed')
    log(landing / "QueryExecutionReport8.csv", execution("n1", "good", "S", "t", at(40), 5, True))
    M.ingest(lake, str(landing))
    ingest = S.Ingest(spark, lake.root, str(landing))
    waiting = lambda: {r.path.rsplit("/", 1)[-1]: r.reason for r in ingest.rejected().collect()}
    assert waiting() == {"disk_spool_7.json": "not a JSON object", "disk_spool_8.json": "not a JSON object",
                         "MashupProcesses_7.json": "a line is not a JSON object", "QueryExecutionReport7.csv": "a quote is not closed"}
    assert counts(lake) == {**before, "bronze_query_execution": before["bronze_query_execution"] + 1}
    # two of them are whole now, one is still bad, one is gone; the first try is cut off before it is marked as done
    (landing / "disk_spool_7.json").write_text(whole)
    log(landing / "QueryExecutionReport7.csv", execution("n1", "half", "S", "t", at(40), 5, True))
    (landing / "disk_spool_8.json").unlink()
    mark = S.Ingest._mark
    monkeypatch.setattr(S.Ingest, "_mark", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError, match="killed"):
        M.ingest(lake, str(landing))
    monkeypatch.setattr(S.Ingest, "_mark", mark)
    M.ingest(lake, str(landing))
    after = {**before, "bronze_query_execution": before["bronze_query_execution"] + 2, "bronze_disk_spool": before["bronze_disk_spool"] + 1}
    assert counts(lake) == after and waiting() == {"MashupProcesses_7.json": "a line is not a JSON object"}
    M.ingest(lake, str(landing))
    assert counts(lake) == after and len(waiting()) == 1
    assert lake.read(S.REJECTED).filter(F.col("path").endswith("disk_spool_8.json") & F.col("resolved")).count() == 1


def test_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lake = M.Lake(spark, str(tmp_path / "lake"))
    assert len(M.ingest(lake, str(tmp_path / "in"))) == len(TABLES) - 1
