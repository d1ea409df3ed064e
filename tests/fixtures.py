"""Small landed files and rows with the awkward cases in them."""

import base64
import json

EXEC_HEAD = (
    "GatewayObjectId,RequestId,DataSource,QueryTrackingId,QueryExecutionEndTimeUTC,"
    "QueryExecutionDuration(ms),QueryType,DataProcessingEndTimeUTC,DataProcessingDuration(ms),Success,"
    "ErrorMessage,SpoolingDiskWritingDuration(ms),SpoolingDiskReadingDuration(ms),"
    "SpoolingTotalDataSize(bytes),DataReadingAndSerializationDuration(ms),DiskRead(byte/sec),DiskWrite(byte/sec)"
)
# a column added in the middle by a newer agent
EXEC_HEAD_NEW = EXEC_HEAD.replace("QueryType,", "QueryType,Retry Count(n),")


def execution(node, request, source, tracking, end, ms, ok, error="", spool=0, kind="Refresh", extra=None):
    quoted = '"' + error.replace('"', '""') + '"' if error else ""
    middle = [] if extra is None else [str(extra)]
    return ",".join(
        [node, request, source, tracking, end, str(ms), kind, *middle, end, "10", str(ok), quoted,
         "5", "2", str(spool), "3", "100.5", "50.5"]
    )


def at(minute, second=0):
    total = 12 * 3600 + minute * 60 + second
    return f"2024-03-05 {total // 3600:02d}:{total % 3600 // 60:02d}:{total % 60:02d}"


def context(artifact, kind="SemanticModel", encoded=False):
    text = json.dumps({"artifactId": artifact, "artifactKind": kind})
    return base64.b64encode(text.encode()).decode() if encoded else text


def write_landing(folder):
    """Eight executions (one replay), seven starts and every other source once."""
    old = [
        EXEC_HEAD,
        execution("n1", "r10", "Sql", "t1", at(0), 1200, True, spool=100),
        execution("n1", "r11", "Sql", "t2", at(1), 90000, False, "Timeout expired, retry failed"),
        execution("n2", "r12", "Ora", "t3", at(2), 500, True, spool=200000, kind="DirectQuery"),
        execution("n2", "r13", "Ora", "t4", at(3), 75000, False, 'Login failed for "svc", locked'),
    ]
    new = [
        EXEC_HEAD_NEW,
        execution("n3", "r20", "Share", "t5", at(5), 60000, False, "Connector crashed", extra=1),
        execution("n3", "r21", "Share", "t6", at(20), 30000, False, "Unknown error", kind="DirectQuery", extra=0),
        execution("n1", "r14", "Sql", "t7", at(0), 800, True, spool=300, extra=0),
        execution("n1", "r14", "Sql", "t7", "2024-03-05 11:50:00", 700, True, spool=250, extra=0),
    ]
    (folder / "QueryExecutionReport1.csv").write_text("\n".join(old) + "\n")
    (folder / "QueryExecutionReport2.csv").write_text("\n".join(new) + "\n")
    start = ["GatewayObjectId,RequestId,QueryTrackingId,QueryStartTimeUTC,QueryType,DataSource,EvaluationContext"]
    for node, request, tracking, minute, ctx in [
        ("n1", "r10", "t1", 0, context("a1")),
        ("n1", "r11", "t2", 0, context("a1", encoded=True)),
        ("n2", "r12", "t3", 1, ""),
        ("n2", "r13", "t4", 2, context("a3")),
        ("n3", "r20", "t5", 4, ""),
        ("n3", "r21", "t6", 19, "not a context"),
        ("n1", "r14", "t7", 0, context("a4", "Dataflow")),
    ]:
        start.append(f'{node},{request},{tracking},{at(minute)},Refresh,S,"' + ctx.replace('"', '""') + '"')
    (folder / "QueryStartReport1.csv").write_text("\n".join(start) + "\n")
    counters = ["GatewayObjectId,CounterTimeUTC,SystemCPUPercent,SystemMEMUsedPercent,GatewayCPUPercent,GatewayMEMKb"]
    counters += [f"n{i},{at(1)},{20 * i},60,{10 * i},{i}000000" for i in (1, 2, 3)]
    (folder / "SystemCounterReport1.csv").write_text("\n".join(counters) + "\n")

    def dump(name, value):
        (folder / name).write_text(json.dumps(value, indent=2))

    def iso(minute):
        return at(minute).replace(" ", "T") + "Z"

    def nic(b, util, bw=1e9):
        return {"NicName": "nic0", "BytesTotalPerSec_avg": b, "CurrentBandwidthBps": bw, "UtilizationPct": util, "SampleCount": 3}

    probe = {"TargetHost": "relay", "LatencyMs_avg": 25.0, "LatencyMs_min": 20.0, "LatencyMs_max": 30.0}
    for i, (host, minute, nics) in enumerate(
        [("H1", 0, [nic(5e7, 40.0), nic(1e7, 5.0)]), ("H1", 2, [nic(4e7, 35.0)]), ("H2", 2, [nic(3e7, 20.0)]),
         ("H3", 5, [nic(2e7, 60.0)]), ("H3", 20, [])]
    ):
        dump(f"network_metrics_{i}.json", {"CollectedAtUtc": iso(minute), "GatewayHostName": host, "NicMetrics": nics,
                                           "LatencyProbe": probe if i != 3 else {"Error": "no route"}})
    event = lambda m, eid, level, text: {
        "TimeCreated": iso(m), "EventId": eid, "LevelDisplayName": level, "ProviderName": "svc", "LogName": "System",
        "Message": text, "GatewayHostName": "H1", "EventSource": "System"}
    dump("event_log_1.json", {"CollectedAtUtc": iso(30), "GatewayHostName": "H1", "EventCount": 1, "CollectionErrors": [],
                              "Events": [event(1, 7031, "Error", "service crashed")]})
    dump("event_log_2.json", {"CollectedAtUtc": iso(30), "GatewayHostName": "H3", "EventCount": 1, "CollectionErrors": [],
                              "Events": [event(122, 7036, "Warning", "memory high")]})
    dump("event_log_3.json", {"CollectedAtUtc": iso(30), "GatewayHostName": "H2", "EventCount": 0, "CollectionErrors": [], "Events": []})
    for i, (host, pct, warn) in enumerate([("H1", 45.0, False), ("H2", 12.0, True), ("H3", None, False)]):
        disk = None if pct is None else {"DriveLetter": "D", "FreeSpaceBytes": int(pct * 1e9), "TotalSpaceBytes": 10**11, "FreeSpacePct": pct}
        dump(f"disk_spool_{i}.json", {"CollectedAtUtc": iso(1), "GatewayHostName": host, "SpoolPath": "D:/s", "SpoolPathExists": True,
                                      "DiskInfo": disk, "SpoolDirSizeBytes": 5000000, "AlertLevel": "OK", "AlertMessage": None,
                                      "StreamBeforeRequestCompletes_Warning": warn})
    node = lambda i, v: {
        "GatewayClusterId": "c1", "GatewayClusterName": "Main", "ClusterScope": "x", "GatewayObjectId": f"n{i}",
        "GatewayNodeName": f"H{i}", "Status": "Live", "Version": v, "DatasourceCount": 3 + i}
    source = lambda i, s: {
        "GatewayClusterId": "c1", "GatewayClusterName": "Main", "DatasourceId": i, "DatasourceName": f"name-{i}",
        "DatasourceType": "Sql", "ConnectionDetails": '{"server":"s"}', "Status": s, "LastUpdated": iso(0)}
    dump("gateway_inventory_1.json", {"CollectedAtUtc": iso(-2), "ClusterCount": 1, "NodeCount": 3,
                                      "Inventory": [node(1, "v2"), node(2, "v2"), node(3, "v1")],
                                      "Datasources": [source("d1", "Error"), source("d2", "Live"), source(None, "Live")]})
    dump("gateway_inventory_2.json", {"CollectedAtUtc": iso(-7), "ClusterCount": 1, "NodeCount": 1, "Inventory": [node(1, "v1")]})
    run = lambda rid, ds, m: {
        "RequestId": rid, "DatasetId": ds, "DatasetName": ds, "WorkspaceId": "w1", "RefreshType": "OnDemand", "Status": "Failed",
        "StartTime": iso(-5), "EndTime": None if m is None else iso(m), "ServiceExceptionJson": '{"errorCode":"X"}'}
    dump("refresh_history_1.json", {"CollectedAtUtc": iso(40), "LookbackHours": 2, "RefreshCount": 6, "CollectionErrors": [],
                                    "RefreshRecords": [run("r11", "a2", 1), run("r13", "a3", 3), run("o1", "a9", 5),
                                                       run("o2", "a1", -300), run(None, "a1", 5), run("o3", "a1", None)]})
    procs = [
        {"CollectedAtUtc": iso(m), "GatewayObjectId": f"n{n}", "HostName": f"H{n}", "ProcessId": 100 + p, "ProcessName": "mashup",
         "IsMashupContainer": p > 0, "WorkingSetMB": 7200.5 if (n, p) == (1, 1) else 900, "PrivateBytesMB": 1, "CpuPercent": 12.5,
         "ThreadCount": 4, "HandleCount": 9, "LogicalCores": 8}
        for m in (0, 5) for n in (1, 2, 3) for p in (0, 1, 2)
    ]
    (folder / "MashupProcesses_1.json").write_text("\n".join(json.dumps(p) for p in procs) + "\n")
