"""Change rows derived from plain business tables (events, lineitem, orders).

Used where no captured tables are at hand: every input row becomes one change
event of a captured table, in wire encoding, with all eight tables covered.
Rows are projected one by one, without shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changeflow.specs import SEQ_WIRE, SPECS, TableSpec
from changeflow.sources.decode import ingest_project

# Reference times just after the last row of the inputs.
AS_OF_EVENTS = "2024-01-31 00:00:00"
AS_OF_ORDERS = "2001-11-05 00:00:00"

EVENTS, LINEITEM, ORDERS = "events", "lineitem", "orders"

# The columns used here; with a given schema no job is needed to infer one.
_INPUT = {
    EVENTS: "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    LINEITEM: "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    ORDERS: "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
}

_MS = {
    EVENTS: "unix_millis(cast(ts as timestamp))",
    LINEITEM: "unix_millis(cast(l_shipdate as timestamp))",
    ORDERS: "unix_millis(cast(o_orderdate as timestamp))",
}

# A call is one user in one half day; later events of it are its updates.
_CALL_ID = "'c' || user_id || '-' || (ms div 43200000)"
_AGENT = "'agent' || (user_id % 20)"
_BRANCH = "'B' || (user_id % 5)"
_TALK = "CASE WHEN event_type IN ('click','purchase') THEN cast(floor(value) as int) ELSE 0 END"

# table -> (input, row filter, delete condition, arrival order, wire column -> expression)
_RULES: dict[str, tuple[str, str, str, str, dict[str, str]]] = {
    "agent_login_status": (
        EVENTS,
        "true",
        "false",
        "event_id",
        {
            "markedBy": _AGENT,
            "state": "CASE event_type WHEN 'click' THEN '1' WHEN 'purchase' THEN '1' WHEN 'view' THEN '2' ELSE '0' END",
            "datestamp": "cast(ms div 86400000 as int)",
            "timestamp": "cast(ms % 86400000 as int)",
            "extension": "cast(100 + user_id % 20 as string)",
            "ipAddress": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE '10.0.0.' || (user_id % 20) END",
        },
    ),
    "cdr": (
        EVENTS,
        "true",
        "event_id % 10 = 9",
        "event_id",
        {
            "uniqueid": _CALL_ID,
            "calldate": "ms - ms % 43200000 + (user_id * 577 % 43200) * 1000",
            "clid": "'ignored'",
            "src": "cast(100 + user_id % 20 as string)",
            "dst": "'08' || user_id",
            "dstchannel": "'SIP/' || (event_id % 7)",
            "duration": f"{_TALK} + 10 + cast(event_id % 20 as int)",
            "billsec": _TALK,
            "disposition": "CASE WHEN event_type IN ('click','purchase') THEN 'ANSWERED' WHEN event_type = 'view' THEN 'NO ANSWER' WHEN event_type = 'signup' THEN 'BUSY' ELSE 'FAILED' END",
            "amaflags": "3",
            "accountcode": "CASE WHEN user_id % 2 = 0 THEN 'ACC' ELSE NULL END",
            "contractNo": "CASE WHEN user_id % 25 = 0 THEN NULL ELSE 'K' || user_id END",
            "customerNo": "'CST-' || user_id",
            "phoneNumber": "'08' || user_id",
            "username": _AGENT,
            "kodeCabang": _BRANCH,
        },
    ),
    "collection_result": (
        EVENTS,
        "event_type IN ('purchase','click','signup')",
        "event_id % 11 = 0",
        "event_id",
        {
            "uniqueId": "event_id div 4",
            "noKontrak": "'K' || user_id",
            "callId": _CALL_ID,
            "agentId": _AGENT,
            "classification": "CASE event_type WHEN 'purchase' THEN 'PTP' WHEN 'click' THEN 'RPC' ELSE 'SKIP' END",
            "subClassification": "CASE WHEN event_type = 'purchase' THEN 'FULL' ELSE NULL END",
            "ptpAmount": "CASE WHEN event_type = 'purchase' THEN floor(value) * 1000.0 ELSE NULL END",
            "ptpDate": "CASE WHEN event_type = 'purchase' THEN cast(ms div 86400000 as int) + 3 ELSE NULL END",
            "createdTimeStamp": "ms",
            "updatedTimeStamp": "ms + 1",
            "kodeCabang": _BRANCH,
        },
    ),
    "collections": (
        ORDERS,
        "true",
        "false",
        "o_orderkey",
        {
            "collections_id": "o_orderkey",
            "noKontrak": "'K' || o_custkey",
            "agentId": "'agent' || (o_custkey % 20)",
            "callDate": "ms",
            "classification": "CASE o_orderstatus WHEN 'F' THEN 'PTP' WHEN 'O' THEN 'RPC' ELSE 'NONE' END",
            "ptpAmount": "floor(o_totalprice) * 1.0",
            "callStatus": "o_orderpriority",
            "createdTimeStamp": "ms",
            "kodeCabang": "'B' || (o_custkey % 5)",
            "overdue": "cast(o_orderkey % 130 as int)",
        },
    ),
    "collection_task": (
        EVENTS,
        "event_type = 'view'",
        "event_id % 13 = 0",
        "event_id",
        {
            "id": "event_id div 10",
            "uniqueId": "'TASK-' || (event_id div 10)",
            "noKontrak": "'K' || user_id",
            "customerName": "'Customer ' || user_id",
            "phoneNumber": "'08' || user_id",
            "overdue": "cast(event_id % 130 - 2 as int)",
            "overdueAmount": "floor(value) * 1000.0",
            "outStdPkk": "floor(value) * 100000.0",
            "angsuran": "floor(value) * 500.0",
            "vehicleType": "CASE WHEN user_id % 2 = 0 THEN 'MOTOR' ELSE 'MOBIL' END",
            "taskType": "'COLLECTION'",
            "priority": "cast(event_id % 3 + 1 as int)",
            "status": "CASE WHEN event_id % 4 = 0 THEN 'DONE' ELSE 'OPEN' END",
            "assignedAgent": _AGENT,
            "kodeCabang": _BRANCH,
            "createdTimestamp": "ms",
            "updatedTimestamp": "ms + 2",
        },
    ),
    "customer_id": (
        EVENTS,
        "true",
        "event_type = 'error' AND event_id % 3 = 0",
        "event_id",
        {
            "id": "user_id",
            "noKontrak": "'K' || user_id",
            "customerName": "'Customer ' || user_id",
            "phoneNumber": "'08' || user_id",
            "callStatus": "CASE event_type WHEN 'click' THEN 'CALLING' WHEN 'signup' THEN 'DONE' WHEN 'purchase' THEN 'PAID' ELSE 'IN_QUEUE' END",
            "priority": "cast(user_id % 3 + 1 as int)",
            "overdue": "cast(floor(value) as int)",
            "outStdPkk": "floor(value) * 1000.0",
            "isPaid": "CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN NULL ELSE 0 END",
            "paymentDate": "CASE WHEN event_type = 'purchase' THEN cast(ms div 86400000 as int) ELSE NULL END",
            "markedBy": "CASE WHEN event_type = 'view' THEN NULL ELSE 'agent' || (event_id % 20) END",
            "kodeCabang": _BRANCH,
            "createdTimestamp": "1704067200000 + user_id * 1000",
            "markedTimestamp": "ms",
        },
    ),
    "user_logs": (
        EVENTS,
        "event_type = 'signup'",
        "event_id % 17 = 0",
        "event_id",
        {
            "id": "event_id div 10",
            "username": _AGENT,
            "ipAddress": "'10.0.0.' || (user_id % 20)",
            "extension": "cast(100 + user_id % 20 as string)",
            "inTimeStamp": "ms",
            "outTimeStamp": "CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE ms + 3600000 END",
            "duration": "CASE WHEN event_id % 4 < 2 THEN NULL ELSE 3600 END",
            "kodeCabang": _BRANCH,
        },
    ),
    "user_releases": (
        LINEITEM,
        "true",
        "l_returnflag = 'R' AND l_linenumber = 7",
        "l_partkey * 100000 + l_suppkey",
        {
            "id": "l_orderkey",
            "hash": "'h' || l_linenumber",
            "username": "'agent' || (l_suppkey % 20)",
            "releaseDate": "cast(ms div 86400000 as int)",
            "totalTask": "cast(l_quantity as int)",
            "totalCalled": "cast(l_quantity as int) - l_linenumber % 2",
            "totalAnswered": "cast(floor(l_quantity / 2) as int)",
            "totalPTP": "cast(floor(l_quantity / 5) as int)",
            "talkTimeSec": "cast(floor(l_extendedprice / 100) as int)",
            "status": "CASE WHEN l_linestatus = 'F' THEN 'CLOSED' ELSE 'ACTIVE' END",
            "kodeCabang": "'B' || (l_suppkey % 5)",
            "createdTimestamp": "ms",
        },
    ),
}


def derived_changes(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Flat change rows of one captured table, in wire encoding."""
    source, where, deleted, seq, columns = _RULES[name]
    wire_type = {f.wire: f.kind.wire.simpleString() for f in SPECS[name].fields}
    rows = spark.read.schema(_INPUT[source]).parquet(f"{sf_dir}/{source}.parquet").where(where)
    return rows.selectExpr("*", f"{_MS[source]} AS ms").selectExpr(
        *(f"cast({e} AS {wire_type[c]}) AS `{c}`" for c, e in columns.items()),
        f"CASE WHEN {deleted} THEN 'd' WHEN ({seq}) % 2 = 0 THEN 'c' ELSE 'u' END AS __op",
        "ms AS __ts_ms",
        "ms - 5 AS __source_ts_ms",
        f"CASE WHEN {deleted} THEN 'true' ELSE 'false' END AS __deleted",
        f"cast({seq} AS bigint) AS {SEQ_WIRE}",
    )


def derived_history(spark: SparkSession, sf_dir: str, spec: TableSpec) -> DataFrame:
    return ingest_project(derived_changes(spark, sf_dir, spec.name), spec)
