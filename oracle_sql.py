"""The registered queries as DuckDB SQL over the given tables.

Fixed values: output names, filter values, day ranges and the funnel steps are the contract
of each query.
"""

from __future__ import annotations

from fixtures import AS_OF_EVENTS, AS_OF_ORDERS

_EV = f"TIMESTAMP '{AS_OF_EVENTS}'"
_OR = f"TIMESTAMP '{AS_OF_ORDERS}'"

# --------------------------------------------------------------------------
# Histories: every input row as one stored version.
# --------------------------------------------------------------------------


def _ms(col: str) -> str:
    return f"(epoch_us({col}) // 1000)"


def _instant(ms: str) -> str:
    return f"make_timestamp(({ms}) * 1000)"


_EPOCH_DAY = "DATE '1970-01-01'"
_EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"
_E = "(SELECT *, epoch_us(ts) // 1000 AS ms FROM events)"


def _meta(seq: str, deleted: str, ms: str = "ms") -> str:
    return (
        f"CASE WHEN {deleted} THEN 'd' WHEN ({seq}) % 2 = 0 THEN 'c' ELSE 'u' END AS _op, "
        f"{ms} AS _ts_ms, {ms} - 5 AS _source_ts_ms, "
        f"CASE WHEN {deleted} THEN 1 ELSE 0 END AS _is_deleted, CAST({seq} AS BIGINT) AS _seq"
    )


_TALK = "CASE WHEN event_type IN ('click','purchase') THEN CAST(floor(value) AS INT) ELSE 0 END"

HISTORY = {
    "agent_login_status": f"""
SELECT 'agent' || (user_id % 20) AS marked_by,
  CASE event_type WHEN 'click' THEN '1' WHEN 'purchase' THEN '1' WHEN 'view' THEN '2' ELSE '0' END AS state,
  CAST(ts AS DATE) AS login_date, CAST(ms % 86400000 AS INT) AS login_time,
  CAST(100 + user_id % 20 AS VARCHAR) AS extension,
  CASE WHEN event_id % 3 = 0 THEN '' ELSE '10.0.0.' || (user_id % 20) END AS ip_address,
  {_meta('event_id', 'false')}
FROM {_E}""",
    "cdr": f"""
SELECT 'c' || user_id || '-' || (ms // 43200000) AS uniqueid,
  {_instant('ms - ms % 43200000 + (user_id * 577 % 43200) * 1000')} AS calldate,
  CAST(100 + user_id % 20 AS VARCHAR) AS src, '08' || user_id AS dst, 'SIP/' || (event_id % 7) AS dstchannel,
  CAST({_TALK} + 10 + event_id % 20 AS INT) AS duration, {_TALK} AS billsec,
  CASE WHEN event_type IN ('click','purchase') THEN 'ANSWERED' WHEN event_type = 'view' THEN 'NO ANSWER' WHEN event_type = 'signup' THEN 'BUSY' ELSE 'FAILED' END AS disposition,
  CASE WHEN user_id % 2 = 0 THEN 'ACC' ELSE '' END AS accountcode,
  CASE WHEN user_id % 25 = 0 THEN '' ELSE 'K' || user_id END AS contract_no,
  'CST-' || user_id AS customer_no, '08' || user_id AS phone_number,
  'agent' || (user_id % 20) AS username, 'B' || (user_id % 5) AS kode_cabang,
  {_meta('event_id', 'event_id % 10 = 9')}
FROM {_E}""",
    "collection_result": f"""
SELECT event_id // 4 AS unique_id, 'K' || user_id AS no_kontrak,
  'c' || user_id || '-' || (ms // 43200000) AS call_id, 'agent' || (user_id % 20) AS agent_id,
  CASE event_type WHEN 'purchase' THEN 'PTP' WHEN 'click' THEN 'RPC' ELSE 'SKIP' END AS classification,
  CASE WHEN event_type = 'purchase' THEN 'FULL' ELSE '' END AS sub_classification,
  CASE WHEN event_type = 'purchase' THEN floor(value) * 1000.0 ELSE 0.0 END AS ptp_amount,
  CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) + 3 ELSE {_EPOCH_DAY} END AS ptp_date,
  '' AS notes, {_instant('ms')} AS created_ts, {_instant('ms + 1')} AS updated_ts,
  'B' || (user_id % 5) AS kode_cabang,
  {_meta('event_id', 'event_id % 11 = 0')}
FROM {_E} WHERE event_type IN ('purchase','click','signup')""",
    "collections": f"""
SELECT o_orderkey AS collections_id, 'K' || o_custkey AS no_kontrak, 'agent' || (o_custkey % 20) AS agent_id,
  {_instant(_ms('o_orderdate'))} AS call_date,
  CASE o_orderstatus WHEN 'F' THEN 'PTP' WHEN 'O' THEN 'RPC' ELSE 'NONE' END AS classification,
  '' AS sub_classification, floor(o_totalprice) * 1.0 AS ptp_amount, {_EPOCH_DAY} AS ptp_date,
  o_orderpriority AS call_status, '' AS notes, {_instant(_ms('o_orderdate'))} AS created_ts, {_EPOCH} AS updated_ts,
  'B' || (o_custkey % 5) AS kode_cabang, CAST(o_orderkey % 130 AS INT) AS overdue,
  {_meta('o_orderkey', 'false', _ms('o_orderdate'))}
FROM orders""",
    "collection_task": f"""
SELECT event_id // 10 AS id, 'TASK-' || (event_id // 10) AS unique_id, 'K' || user_id AS no_kontrak,
  'Customer ' || user_id AS customer_name, '08' || user_id AS phone_number,
  CAST(event_id % 130 - 2 AS INT) AS overdue, floor(value) * 1000.0 AS overdue_amount,
  floor(value) * 100000.0 AS out_std_pkk, floor(value) * 500.0 AS angsuran,
  CASE WHEN user_id % 2 = 0 THEN 'MOTOR' ELSE 'MOBIL' END AS vehicle_type, '' AS vehicle_plate,
  'COLLECTION' AS task_type, CAST(event_id % 3 + 1 AS INT) AS priority,
  CASE WHEN event_id % 4 = 0 THEN 'DONE' ELSE 'OPEN' END AS status,
  'agent' || (user_id % 20) AS assigned_agent, 'B' || (user_id % 5) AS kode_cabang,
  {_instant('ms')} AS created_ts, {_instant('ms + 2')} AS updated_ts,
  {_meta('event_id', 'event_id % 13 = 0')}
FROM {_E} WHERE event_type = 'view'""",
    "customer_id": f"""
SELECT user_id AS id, 'K' || user_id AS no_kontrak, 'Customer ' || user_id AS customer_name,
  '08' || user_id AS phone_number, '' AS alt_phone,
  CASE event_type WHEN 'click' THEN 'CALLING' WHEN 'signup' THEN 'DONE' WHEN 'purchase' THEN 'PAID' ELSE 'IN_QUEUE' END AS call_status,
  CAST(user_id % 3 + 1 AS INT) AS priority, CAST(floor(value) AS INT) AS overdue,
  floor(value) * 1000.0 AS out_std_pkk, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_paid,
  CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) ELSE {_EPOCH_DAY} END AS payment_date,
  CASE WHEN event_type = 'view' THEN '' ELSE 'agent' || (event_id % 20) END AS marked_by,
  'B' || (user_id % 5) AS kode_cabang, {_instant('1704067200000 + user_id * 1000')} AS created_ts,
  {_instant('ms')} AS marked_ts,
  {_meta('event_id', "event_type = 'error' AND event_id % 3 = 0")}
FROM {_E}""",
    "user_logs": f"""
SELECT event_id // 10 AS id, 'agent' || (user_id % 20) AS username, '10.0.0.' || (user_id % 20) AS ip_address,
  CAST(100 + user_id % 20 AS VARCHAR) AS extension, {_instant('ms')} AS in_ts,
  CASE WHEN event_id % 4 < 2 THEN {_EPOCH} ELSE {_instant('ms + 3600000')} END AS out_ts,
  CASE WHEN event_id % 4 < 2 THEN 0 ELSE 3600 END AS duration, 'B' || (user_id % 5) AS kode_cabang,
  {_meta('event_id', 'event_id % 17 = 0')}
FROM {_E} WHERE event_type = 'signup'""",
    "user_releases": f"""
SELECT l_orderkey AS id, 'h' || l_linenumber AS hash, 'agent' || (l_suppkey % 20) AS username,
  CAST(l_shipdate AS DATE) AS release_date, CAST(l_quantity AS INT) AS total_task,
  CAST(l_quantity AS INT) - l_linenumber % 2 AS total_called, CAST(floor(l_quantity / 2) AS INT) AS total_answered,
  CAST(floor(l_quantity / 5) AS INT) AS total_ptp, CAST(floor(l_extendedprice / 100) AS INT) AS talk_time_sec,
  CASE WHEN l_linestatus = 'F' THEN 'CLOSED' ELSE 'ACTIVE' END AS status, 'B' || (l_suppkey % 5) AS kode_cabang,
  {_instant(_ms('l_shipdate'))} AS created_ts, {_EPOCH} AS updated_ts,
  {_meta('l_partkey * 100000 + l_suppkey', "l_returnflag = 'R' AND l_linenumber = 7", _ms('l_shipdate'))}
FROM lineitem""",
}

KEY = {
    "agent_login_status": "marked_by",
    "cdr": "uniqueid, calldate",
    "collection_result": "unique_id",
    "collections": "collections_id",
    "collection_task": "id",
    "customer_id": "id",
    "user_logs": "id",
    "user_releases": "id, hash",
}


def _ctes(*names: str) -> list[str]:
    """<t>_history, <t>_newest (deletes included) and <t> (current rows)."""
    out = []
    for n in names:
        out.append(f"{n}_history AS ({HISTORY[n]})")
        out.append(
            f"{n}_newest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {KEY[n]} ORDER BY _ts_ms DESC, _seq DESC) AS rn FROM {n}_history) WHERE rn = 1)"
        )
        out.append(f"{n} AS (SELECT * FROM {n}_newest WHERE _is_deleted = 0)")
    return out


def _q(tables: str, body: str, *extra: str) -> str:
    # A table of the inventory may be named like an input table only by chance;
    # none is, so plain names are safe here.
    return "WITH " + ",\n".join([*_ctes(*tables.split()), *extra]) + "\n" + body


def _state_cols(n: str) -> str:
    return "* EXCLUDE (_op, _ts_ms, _source_ts_ms, _seq, _is_deleted), _ts_ms AS _version, _is_deleted"


def _round(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


def _pct(part: str, whole: str) -> str:
    p, w = f"CAST({part} AS BIGINT)", f"CAST(nullif({whole}, 0) AS BIGINT)"
    return f"(sign({p}) * sign({w}) * ((abs({p}) * 2000 + abs({w})) // (abs({w}) * 2)) / 10.0::DOUBLE)"


def _mio(x: str) -> str:
    return _round(f"({x}) / 1000000.0::DOUBLE", 2)


_BUCKET = (
    "CASE WHEN overdue <= 30 THEN '1-30' WHEN overdue <= 60 THEN '31-60' "
    "WHEN overdue <= 90 THEN '61-90' ELSE '90+' END"
)

# --------------------------------------------------------------------------
# Pre-aggregates: <rows> is a history (mode ingest) or a state (mode state).
# --------------------------------------------------------------------------


def _agent_daily(rows: str) -> str:
    return f"""SELECT release_date AS work_date, username AS agent_username, kode_cabang AS branch_code,
  CAST(sum(total_task) AS BIGINT) AS tasks_assigned, CAST(sum(total_called) AS BIGINT) AS calls_made,
  CAST(sum(total_answered) AS BIGINT) AS calls_answered, CAST(sum(total_ptp) AS BIGINT) AS ptp_achieved,
  CAST(sum(talk_time_sec) AS BIGINT) AS talk_time_seconds, CAST(0 AS DOUBLE) AS ptp_amount
FROM {rows} WHERE _is_deleted = 0 AND status = 'CLOSED' GROUP BY ALL"""


def _cdr_minutely(rows: str) -> str:
    return f"""SELECT date_trunc('minute', calldate) AS minute, kode_cabang AS branch_code,
  count(*) AS total_calls, count(*) FILTER (disposition = 'ANSWERED') AS answered_calls,
  CAST(sum(duration) AS BIGINT) AS total_duration, CAST(sum(billsec) AS BIGINT) AS total_billsec
FROM {rows} WHERE _is_deleted = 0 GROUP BY 1, 2"""


def _collection_daily(rows: str) -> str:
    return f"""SELECT CAST(created_ts AS DATE) AS event_date, classification, kode_cabang AS branch_code,
  count(*) AS count, sum(ptp_amount) AS ptp_total_amount
FROM {rows} WHERE _is_deleted = 0 GROUP BY 1, 2, 3"""


def _disposition_summary(rows: str) -> str:
    return f"""SELECT CAST(calldate AS DATE) AS count_date, disposition, kode_cabang AS branch_code,
  count(*) AS count, CAST(sum(CAST(CAST(billsec AS FLOAT) AS DOUBLE)) AS DOUBLE) AS avg_talk_sec_sum,
  count(billsec) AS avg_talk_sec_cnt
FROM {rows} WHERE _is_deleted = 0 GROUP BY 1, 2, 3"""


_PREAGG = {
    "agg_agent_daily": ("user_releases", _agent_daily),
    "agg_cdr_minutely": ("cdr", _cdr_minutely),
    "agg_collection_daily": ("collection_result", _collection_daily),
    "agg_disposition_summary": ("cdr", _disposition_summary),
}


def _agg(name: str, mode: str = "ingest") -> str:
    table, sql = _PREAGG[name]
    return sql(f"{table}_history" if mode == "ingest" else table)


def _on(name: str, body: str, mode: str = "ingest") -> str:
    """A query over one pre-aggregate, visible under its name."""
    return _q(_PREAGG[name][0], body, f"{name} AS ({_agg(name, mode)})")


_LIVE = f"""SELECT minute, total_calls AS calls, answered_calls AS answered,
  {_pct('answered_calls', 'total_calls')} AS connect_rate_pct, total_billsec AS total_talk_sec, branch_code
FROM agg_cdr_minutely WHERE minute >= {_EV} - INTERVAL 60 MINUTE"""

_PRODUCTIVITY = f"""SELECT work_date, agent_username, tasks_assigned AS tasks, calls_made AS calls,
  calls_answered AS answered, ptp_achieved AS ptp, talk_time_seconds AS talk_sec, branch_code,
  {_pct('calls_answered', 'calls_made')} AS connect_rate_pct,
  {_pct('ptp_achieved', 'calls_answered')} AS ptp_rate_pct
FROM agg_agent_daily"""

_PROD30 = f"""SELECT work_date, agent_username, tasks, calls, answered, ptp,
  {_round('talk_sec / 60.0::DOUBLE', 1)} AS talk_minutes, connect_rate_pct, ptp_rate_pct, branch_code
FROM ({_PRODUCTIVITY}) WHERE work_date >= CAST({_OR} - INTERVAL 30 DAY AS DATE)"""

# --------------------------------------------------------------------------
# Funnel: greedy chain from every distinct step 1, best level per contract.
# --------------------------------------------------------------------------

_STEPS = f"""funnel_events AS (
  SELECT no_kontrak, created_ts AS ts, 1 AS step FROM collection_task WHERE created_ts >= {_EV} - INTERVAL 7 DAY
  UNION ALL SELECT contract_no, calldate, 2 FROM cdr WHERE calldate >= {_EV} - INTERVAL 7 DAY AND contract_no <> ''
  UNION ALL SELECT contract_no, calldate, 3 FROM cdr WHERE disposition = 'ANSWERED' AND calldate >= {_EV} - INTERVAL 7 DAY AND contract_no <> ''
  UNION ALL SELECT no_kontrak, created_ts, 4 FROM collection_result WHERE classification = 'PTP' AND created_ts >= {_EV} - INTERVAL 7 DAY
  UNION ALL SELECT no_kontrak, CAST(payment_date AS TIMESTAMP), 5 FROM customer_id WHERE is_paid = 1 AND payment_date >= CAST({_EV} - INTERVAL 7 DAY AS DATE))"""

_LEVELS = """sec AS (SELECT DISTINCT no_kontrak AS k, epoch_us(ts) // 1000000 AS t, step FROM funnel_events),
c1 AS (SELECT k, t AS t1, t AS last FROM sec WHERE step = 1),
c2 AS (SELECT c.k, c.t1, min(s.t) AS last FROM c1 c LEFT JOIN sec s ON s.k = c.k AND s.step = 2 AND s.t BETWEEN c.last AND c.t1 + 604800 GROUP BY 1, 2),
c3 AS (SELECT c.k, c.t1, min(s.t) AS last FROM c2 c LEFT JOIN sec s ON s.k = c.k AND s.step = 3 AND s.t BETWEEN c.last AND c.t1 + 604800 GROUP BY 1, 2),
c4 AS (SELECT c.k, c.t1, min(s.t) AS last FROM c3 c LEFT JOIN sec s ON s.k = c.k AND s.step = 4 AND s.t BETWEEN c.last AND c.t1 + 604800 GROUP BY 1, 2),
c5 AS (SELECT c.k, c.t1, min(s.t) AS last FROM c4 c LEFT JOIN sec s ON s.k = c.k AND s.step = 5 AND s.t BETWEEN c.last AND c.t1 + 604800 GROUP BY 1, 2),
chains AS (SELECT c1.k, CASE WHEN c5.last IS NOT NULL THEN 5 WHEN c4.last IS NOT NULL THEN 4 WHEN c3.last IS NOT NULL THEN 3 WHEN c2.last IS NOT NULL THEN 2 ELSE 1 END AS level
  FROM c1 JOIN c2 USING (k, t1) JOIN c3 USING (k, t1) JOIN c4 USING (k, t1) JOIN c5 USING (k, t1)),
levels AS (SELECT k AS no_kontrak, CAST(coalesce(max(level), 0) AS INT) AS level FROM (SELECT DISTINCT k FROM sec) LEFT JOIN chains USING (k) GROUP BY 1)"""

_FUNNEL_TABLES = "collection_task cdr collection_result customer_id"

_FUNNEL = f"""SELECT level, count(*) AS contracts,
  {_pct('count(*)', "(SELECT count(DISTINCT no_kontrak) FROM funnel_events WHERE step = 1)")} AS pct_of_total
FROM levels GROUP BY level"""

# --------------------------------------------------------------------------
# As-of and views
# --------------------------------------------------------------------------

ASOF_DAY = "2024-01-20"
ASOF_DAY_ORDERS = "1998-06-15"
_CUT = f"(epoch_us(TIMESTAMP '{ASOF_DAY} 23:59:59') // 1000)"


def _asof(n: str, day: str = ASOF_DAY) -> str:
    cut = f"(epoch_us(TIMESTAMP '{day} 23:59:59') // 1000)"
    return (
        f"{n}_asof AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {KEY[n]} "
        f"ORDER BY _ts_ms DESC, _seq DESC) AS rn FROM {n}_history WHERE _ts_ms <= {cut}) "
        "WHERE rn = 1 AND _is_deleted = 0)"
    )


_QUEUE_COLS = (
    "no_kontrak, customer_name, phone_number, call_status, priority, overdue, out_std_pkk, "
    "is_paid, marked_by AS current_agent"
)
_ATTRS = (
    "id, no_kontrak, customer_name, phone_number, call_status, priority, overdue, out_std_pkk, "
    "is_paid, payment_date, marked_by, kode_cabang"
)
_QUEUE_VERSIONS = f"""SELECT {_QUEUE_COLS} FROM (SELECT {_ATTRS}, arg_max(_is_deleted, _ts_ms * 1000000000::HUGEINT + _seq) AS gone
  FROM customer_id_history WHERE _ts_ms <= {_CUT} GROUP BY {_ATTRS}) WHERE gone = 0"""


def _v_cdr(results: str) -> str:
    return f"""SELECT c.uniqueid, c.calldate, c.src AS source_number, c.dst AS destination_number, c.duration,
  c.billsec AS talk_seconds, c.disposition, c.accountcode, c.contract_no, c.customer_no, c.phone_number,
  c.username AS agent_username, c.kode_cabang AS branch_code,
  coalesce(r.classification, 'NO_RESULT') AS result_classification, coalesce(r.ptp_amount, 0.0) AS ptp_amount, r.ptp_date
FROM cdr c LEFT JOIN {results} r ON r.call_id = c.uniqueid WHERE r._is_deleted = 0 OR r._is_deleted IS NULL"""


_SESSION = """SELECT id, username AS agent_username, ip_address, extension, in_ts AS login_time, out_ts AS logout_time,
  duration AS session_duration_seconds, CASE WHEN epoch_us(out_ts) = 0 THEN 'ACTIVE' ELSE 'CLOSED' END AS session_status,
  kode_cabang AS branch_code FROM user_logs"""

_AGENT_SUMMARY = f"""SELECT CAST(created_ts AS DATE) AS work_date, username AS agent_username, total_task AS tasks_assigned,
  total_called AS calls_made, total_answered AS calls_answered, total_ptp AS ptp_achieved,
  talk_time_sec AS total_talk_seconds, kode_cabang AS branch_code,
  CASE WHEN total_called > 0 THEN {_pct('total_answered', 'total_called')} ELSE 0 END AS connect_rate_pct,
  CASE WHEN total_answered > 0 THEN {_pct('total_ptp', 'total_answered')} ELSE 0 END AS ptp_closure_rate_pct
FROM user_releases WHERE status = 'CLOSED'"""

_AGING = (
    "count(*) AS kontrak_count, " + _round("avg(overdue)", 1) + " AS avg_days, "
    + _mio("sum(out_std_pkk)") + " AS total_outstanding_mio"
)

_ANSWERED30 = (
    f"disposition = 'ANSWERED' AND CAST(calldate AS DATE) >= CAST({_EV} - INTERVAL 30 DAY AS DATE)"
)


def _quantile(p: float) -> str:
    return (
        f"list_sort(list(billsec))[CAST(least(floor(CAST({p} AS DOUBLE) * count(*)), count(*) - 1) AS BIGINT) + 1]"
    )


_TALK_QUANTILES = f"""SELECT 'talk_duration' AS metric,
  {_quantile(0.5)} AS p50, {_quantile(0.75)} AS p75, {_quantile(0.9)} AS p90, {_quantile(0.95)} AS p95, {_quantile(0.99)} AS p99,
  {_round('avg(billsec)', 1)} AS mean_sec, max(billsec) AS max_sec, min(billsec) AS min_sec
FROM cdr WHERE {_ANSWERED30}"""

_SHARE = f"""SELECT disposition, count(*) AS total, {_pct('count(*)', 'sum(count(*)) OVER ()')} AS pct
FROM cdr WHERE CAST(calldate AS DATE) >= CAST({_EV} - INTERVAL 30 DAY AS DATE) GROUP BY disposition"""

_PTP = f"""SELECT agent_id, count(*) AS ptp_count, count(*) FILTER (classification = 'PTP') AS ptp_yes,
  count(*) FILTER (classification = 'RPC') AS rpc_count,
  {_pct("count(*) FILTER (classification = 'PTP')", 'count(*)')} AS ptp_success_pct
FROM collection_result WHERE created_ts >= {_EV} - INTERVAL 7 DAY GROUP BY agent_id"""

_RESULTS_DAILY = f"""SELECT CAST(created_ts AS DATE) AS date, classification, count(*) AS result_count, {_mio('sum(ptp_amount)')} AS ptp_amount_mio
FROM collection_result WHERE CAST(created_ts AS DATE) >= CAST({_EV} - INTERVAL 30 DAY AS DATE) GROUP BY 1, 2"""

_QUEUE_STATUS = """SELECT count(*) AS total_in_queue, count(*) FILTER (call_status = 'CALLING') AS currently_calling,
  count(*) FILTER (call_status = 'DONE') AS completed, kode_cabang AS branch_code
FROM customer_id WHERE call_status IN ('IN_QUEUE','CALLING','DONE') GROUP BY kode_cabang"""

_TOP_AGENTS = f"""SELECT agent_username, CAST(sum(talk_time_seconds) AS BIGINT) AS total_talk_sec, CAST(sum(calls_made) AS BIGINT) AS total_calls,
  CAST(sum(ptp_achieved) AS BIGINT) AS ptp_count,
  {_round('sum(talk_time_seconds) / CAST(nullif(sum(calls_made), 0) AS DOUBLE)', 1)} AS avg_talk_per_call, branch_code
FROM agg_agent_daily WHERE work_date >= CAST({_OR} - INTERVAL 7 DAY AS DATE)
GROUP BY agent_username, branch_code ORDER BY total_talk_sec DESC, agent_username, branch_code LIMIT 20"""

_PROD_DAILY = f"""SELECT work_date, CAST(sum(tasks_assigned) AS BIGINT) AS total_tasks, CAST(sum(calls_made) AS BIGINT) AS total_calls,
  CAST(sum(calls_answered) AS BIGINT) AS total_answered, CAST(sum(ptp_achieved) AS BIGINT) AS total_ptp,
  {_round('sum(talk_time_seconds) / 60.0::DOUBLE', 0)} AS total_talk_minutes
FROM agg_agent_daily WHERE work_date >= CAST({_OR} - INTERVAL 30 DAY AS DATE) GROUP BY work_date"""

_DISP_DAILY = f"""SELECT count_date, disposition, CAST(sum(count) AS BIGINT) AS total_calls,
  {_round('sum(avg_talk_sec_sum) / sum(avg_talk_sec_cnt)', 1)} AS avg_talk_seconds
FROM agg_disposition_summary WHERE count_date >= CAST({_EV} - INTERVAL 30 DAY AS DATE) GROUP BY 1, 2"""

_COLL_DAILY = f"""SELECT event_date, classification, CAST(sum(count) AS BIGINT) AS result_count, {_mio('sum(ptp_total_amount)')} AS ptp_amount_mio
FROM agg_collection_daily WHERE event_date >= CAST({_EV} - INTERVAL 30 DAY AS DATE) GROUP BY 1, 2"""

_LIVE_MINUTES = f"""SELECT strftime(minute, '%Y-%m-%d %H:%M') AS minute, calls, answered, connect_rate_pct,
  {_round('total_talk_sec / 60.0::DOUBLE', 1)} AS total_talk_min, branch_code
FROM (SELECT * FROM ({_LIVE}) ORDER BY minute DESC, branch_code LIMIT 60)"""

_LIVE_METRICS = f"""SELECT count(*) AS current_calls,
  {_round('coalesce(sum(CAST(round(connect_rate_pct * 10) AS BIGINT)) / count(connect_rate_pct)::DOUBLE / 10.0::DOUBLE, 0)', 1)} AS connect_rate_pct,
  {_round('coalesce(sum(CAST(' + _round('total_talk_sec / calls::DOUBLE', 0) + ' AS BIGINT)) / count(*)::DOUBLE, 0)', 0)} AS avg_talk_sec,
  CAST(coalesce(sum(calls), 0) AS BIGINT) AS calls_last_hour
FROM ({_LIVE})"""

AUDIT_CONTRACT = "K42"


def _counts(rows: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS t, count(*) AS n FROM {rows.format(n)}" for n in KEY)


_ALL = " ".join(KEY)

# --------------------------------------------------------------------------
# Messages: the JSON text of cdr changes, as the engine writes it.
# --------------------------------------------------------------------------

_CDR_JSON = f"""json_object('uniqueid', 'c' || user_id || '-' || (ms // 43200000),
  'calldate', ms - ms % 43200000 + (user_id * 577 % 43200) * 1000, 'clid', 'ignored',
  'src', CAST(100 + user_id % 20 AS VARCHAR), 'dst', '08' || user_id, 'dstchannel', 'SIP/' || (event_id % 7),
  'duration', {_TALK} + 10 + event_id % 20, 'billsec', {_TALK},
  'disposition', CASE WHEN event_type IN ('click','purchase') THEN 'ANSWERED' WHEN event_type = 'view' THEN 'NO ANSWER' WHEN event_type = 'signup' THEN 'BUSY' ELSE 'FAILED' END,
  'amaflags', 3, 'accountcode', 'ACC', 'contractNo', 'K' || user_id, 'customerNo', 'CST-' || user_id,
  'phoneNumber', '08' || user_id, 'username', 'agent' || (user_id % 20), 'kodeCabang', 'B' || (user_id % 5),
  '__op', CASE WHEN event_id % 10 = 9 THEN 'd' WHEN event_id % 2 = 0 THEN 'c' ELSE 'u' END,
  '__ts_ms', ms, '__source_ts_ms', ms - 5, '__deleted', CASE WHEN event_id % 10 = 9 THEN 'true' ELSE 'false' END)"""

# The engine leaves NULL fields out of the text.
_CDR_MESSAGES = f"""(SELECT event_id AS seq, CAST(CASE
  WHEN user_id % 2 <> 0 AND user_id % 25 = 0 THEN replace(replace(j, '"accountcode":"ACC",', ''), '"contractNo":"K' || user_id || '",', '')
  WHEN user_id % 2 <> 0 THEN replace(j, '"accountcode":"ACC",', '')
  WHEN user_id % 25 = 0 THEN replace(j, '"contractNo":"K' || user_id || '",', '')
  ELSE j END AS VARCHAR) AS value
  FROM (SELECT *, CAST({_CDR_JSON} AS VARCHAR) AS j FROM {_E}))"""

SNAPSHOT_MS = 1004918400000  # 2001-11-05
TOPIC = "cdc.tblCallDataRecords"



def _positions(value: str) -> str:
    """Quantiles by position in the sorted values."""
    levels = (0.0, 0.1, 0.5, 0.9, 0.999, 1.0)
    picked = ", ".join(
        f"v[1 + CAST(least(floor(CAST({p} AS DOUBLE) * n), n - 1) AS BIGINT)] AS q{i}" for i, p in enumerate(levels)
    )
    return f"SELECT {picked}, n FROM (SELECT list_sort(list({value})) AS v, count(*) AS n FROM orders)"


# Damage done to the messages by the bad-record query, and where they lie.
_BAD = f"""SELECT seq, reason, '{TOPIC}' AS topic, CAST(seq % 4 AS INT) AS partition, seq // 4 AS "offset",
  {_instant(f'{SNAPSHOT_MS} + seq')} AS time, CASE WHEN seq % 50 = 7 THEN left(value, 40)
  WHEN seq % 50 = 13 THEN replace(value, '"amaflags":3', '"amaflags":"three"') ELSE replace(value, '"__ts_ms"', '"ts"') END AS value
FROM (SELECT *, CASE WHEN seq % 50 IN (7, 13) THEN 'malformed' WHEN seq % 50 = 21 THEN 'no key or version' END AS reason FROM {_CDR_MESSAGES})
WHERE reason IS NOT NULL"""

_WIRE_LOGS = f"""SELECT event_id // 10 AS id, 'agent' || (user_id % 20) AS username, '10.0.0.' || (user_id % 20) AS "ipAddress",
  CAST(100 + user_id % 20 AS VARCHAR) AS extension, ms AS "inTimeStamp",
  CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE ms + 3600000 END AS "outTimeStamp",
  CAST(CASE WHEN event_id % 4 < 2 THEN NULL ELSE 3600 END AS INT) AS duration, 'B' || (user_id % 5) AS "kodeCabang",
  CASE WHEN event_id % 17 = 0 THEN 'd' WHEN event_id % 2 = 0 THEN 'c' ELSE 'u' END AS __op, ms AS __ts_ms, ms - 5 AS __source_ts_ms,
  CASE WHEN event_id % 17 = 0 THEN 'true' ELSE 'false' END AS __deleted, event_id AS __seq
FROM {_E} WHERE event_type = 'signup'"""

_SNAPSHOT = f"""SELECT o_orderkey AS collections_id, 'K' || o_custkey AS no_kontrak, '' AS agent_id,
  {_instant(_ms('o_orderdate'))} AS call_date, o_orderstatus AS classification, '' AS sub_classification,
  CAST(floor(o_totalprice) AS DOUBLE) AS ptp_amount, CAST(o_orderdate AS DATE) AS ptp_date, o_orderpriority AS call_status, '' AS notes,
  {_instant(_ms('o_orderdate'))} AS created_ts, {_EPOCH} AS updated_ts, '' AS kode_cabang, CAST(o_orderkey % 130 AS INT) AS overdue,
  'r' AS _op, CAST({SNAPSHOT_MS} AS BIGINT) AS _ts_ms, CAST({SNAPSHOT_MS} AS BIGINT) AS _source_ts_ms, 0 AS _is_deleted, o_orderkey AS _seq
FROM orders"""

def oracle() -> dict[str, str]:
    sql: dict[str, str] = {}

    # 2.1 sources, scans, sinks
    sql["src_changes"] = f"SELECT seq, value FROM {_CDR_MESSAGES}"
    sql["decode_json_rows"] = _WIRE_LOGS
    sql["route_bad_records"] = _BAD
    sql["drop_tombstones"] = f"SELECT seq, value FROM {_CDR_MESSAGES}"
    sql["unwrap_envelope"] = _q("cdr", "SELECT * FROM cdr_history")
    sql["snapshot_to_changes"] = _SNAPSHOT
    sql["backfill_csv"] = _q("user_logs", "SELECT * FROM user_logs_history")
    sql["append_history"] = _q("cdr", "SELECT * FROM cdr_history")
    for n in KEY:
        sql[f"append_history_{n}"] = _q(n, f"SELECT * FROM {n}_history")
    for n in KEY:
        sql[f"ingest_project_{n}"] = _q(n, f"SELECT * FROM {n}_history")
        sql[f"upsert_state_{n}"] = _q(n, f"SELECT {_state_cols(n)} FROM {n}_newest")
        sql[f"scan_state_{n}"] = _q(n, f"SELECT {_state_cols(n)} FROM {n}")
    sql["result_json_lines"] = _q(
        "cdr",
        f"SELECT CAST(json_object('disposition', disposition, 'total', total, 'pct', pct) AS VARCHAR) AS value FROM ({_SHARE})",
    )

    # 2.2 projections, filters, views
    sql["delete_flag"] = _q("cdr", "SELECT _is_deleted, count(*) AS n FROM cdr_history GROUP BY 1")
    sql["version_col"] = _q("customer_id", "SELECT id, _ts_ms AS _version FROM customer_id_newest")
    sql["filter_recent"] = _q(
        "cdr",
        f"""SELECT count(*) FILTER (calldate >= {_EV} - INTERVAL 60 MINUTE) AS last_hour,
  count(*) FILTER (calldate >= {_EV} - INTERVAL 7 DAY) AS last_week,
  count(*) FILTER (CAST(calldate AS DATE) >= CAST({_EV} - INTERVAL 30 DAY AS DATE)) AS last_month FROM cdr""",
    )
    sql["filter_equality"] = _q(
        "cdr", "SELECT uniqueid, calldate FROM cdr WHERE disposition = 'ANSWERED' AND contract_no <> ''"
    )
    sql["filter_in"] = _q(
        "customer_id", "SELECT id, call_status FROM customer_id WHERE call_status IN ('IN_QUEUE','CALLING','DONE')"
    )
    sql["filter_asof"] = _q(
        "customer_id", f"SELECT id, _ts_ms, _op FROM customer_id_history WHERE _ts_ms <= {_CUT}"
    )
    sql["case_bucket"] = _q(
        "collection_task", f"SELECT id, overdue AS days_overdue, {_BUCKET} AS aging_bucket FROM collection_task"
    )
    sql["rate_pct"] = _q(
        "user_releases",
        f"""SELECT id, hash, {_pct('total_answered', 'total_called')} AS connect_pct,
  CASE WHEN total_answered > 0 THEN {_pct('total_ptp', 'total_answered')} ELSE 0 END AS closure_pct FROM user_releases""",
    )
    sql["lateral_alias"] = _q(
        "collection_result",
        f"""SELECT agent_id, yes, total, {_pct('yes', 'total')} AS pct FROM (SELECT agent_id,
  count(*) FILTER (classification = 'PTP') AS yes, count(*) AS total FROM collection_result GROUP BY 1)""",
    )
    sql["v_agent_login_status"] = _q(
        "agent_login_status",
        f"""SELECT marked_by AS agent_id, state AS status, login_date, login_time, extension, ip_address,
  (epoch_us({_EV}) // 1000 - (date_diff('day', {_EPOCH_DAY}, login_date) * 86400000 + login_time)) / 1000.0::DOUBLE AS session_duration
FROM agent_login_status""",
    )
    sql["v_cdr"] = _q("cdr collection_result", _v_cdr("collection_result_newest"))
    sql["v_cdr_clean"] = _q("cdr collection_result", _v_cdr("collection_result"))
    sql["v_collection_task"] = _q(
        "collection_task",
        f"""SELECT id, unique_id, no_kontrak AS contract_no, customer_name, phone_number, overdue AS days_overdue,
  overdue_amount, out_std_pkk AS outstanding_amount, angsuran AS installment_amount, vehicle_type, vehicle_plate, task_type,
  priority, status, assigned_agent AS agent_username, kode_cabang AS branch_code, created_ts, updated_ts, {_BUCKET} AS aging_bucket
FROM collection_task""",
    )
    sql["v_customer_queue"] = _q(
        "customer_id",
        """SELECT id, no_kontrak AS contract_no, customer_name, phone_number, alt_phone, call_status AS status, priority,
  overdue AS days_overdue, out_std_pkk AS outstanding_amount, is_paid AS already_paid, payment_date, marked_by AS current_agent,
  kode_cabang AS branch_code, created_ts, marked_ts AS last_update_ts FROM customer_id""",
    )
    sql["v_user_session"] = _q("user_logs", _SESSION)
    sql["v_agent_daily_summary"] = _q("user_releases", _AGENT_SUMMARY)
    sql["v_collection_result_summary"] = _q(
        "collection_result",
        """SELECT CAST(created_ts AS DATE) AS event_date, classification AS result_type, count(*) AS count,
  sum(CASE WHEN classification = 'PTP' THEN ptp_amount ELSE 0.0 END) AS ptp_total_amount, kode_cabang AS branch_code
FROM collection_result GROUP BY 1, 2, 5""",
    )

    # 2.3 joins
    for name, results in (
        ("join_calls_results", "collection_result_newest"),
        ("join_calls_results_clean", "collection_result"),
        ("join_calls_results_spread", "collection_result_newest"),
    ):
        sql[name] = _q(
            "cdr collection_result",
            f"""SELECT c.uniqueid, c.calldate, r.unique_id AS result_id, r.classification FROM cdr c
LEFT JOIN {results} r ON r.call_id = c.uniqueid WHERE r._is_deleted = 0 OR r._is_deleted IS NULL""",
        )
    sql["cross_scalar"] = _q(
        "customer_id",
        f"SELECT id, _ts_ms, cut.ms - _ts_ms AS age_ms FROM customer_id_history, (SELECT {_CUT} AS ms) cut WHERE _ts_ms <= cut.ms",
    )
    sql["scalar_subquery"] = _q(
        "collection_task",
        f"""SELECT status, count(*) AS n, {_pct('count(*)', '(SELECT count(DISTINCT no_kontrak) FROM collection_task)')} AS per_contract
FROM collection_task GROUP BY status""",
    )

    # 2.4 aggregations
    sql["agg_count"] = _q("collection_result", "SELECT kode_cabang, count(*) AS n FROM collection_result GROUP BY 1")
    sql["agg_count_if"] = _q(
        "collection_result",
        "SELECT agent_id, count(*) FILTER (classification = 'PTP') AS ptp_yes, count(*) FILTER (classification = 'RPC') AS rpc_count FROM collection_result GROUP BY 1",
    )
    sql["agg_sum"] = _q(
        "collection_task", f"SELECT kode_cabang, sum(out_std_pkk) AS outstanding, {_mio('sum(out_std_pkk)')} AS outstanding_mio FROM collection_task GROUP BY 1"
    )
    sql["agg_sum_if"] = _q(
        "collection_result",
        "SELECT kode_cabang, sum(CASE WHEN classification = 'PTP' THEN ptp_amount ELSE 0.0 END) AS promised FROM collection_result GROUP BY 1",
    )
    cents = "CAST(o_totalprice AS DECIMAL(22,2))"
    sql["agg_sum_cents"] = f"SELECT o_orderpriority, CAST(sum({cents}) AS DOUBLE) AS total FROM orders GROUP BY 1"
    sql["agg_sum_if_cents"] = f"""SELECT o_custkey,
      CAST(sum(CASE WHEN o_orderstatus = 'F' THEN {cents} ELSE 0 END) AS DOUBLE) AS filled FROM orders GROUP BY 1"""
    sql["quantiles_radix_price"] = _positions("o_totalprice")
    sql["quantiles_radix_key"] = _positions(f"o_orderkey * 7000000000003 - {1 << 50}")
    sql["agg_avg"] = _q(
        "cdr",
        f"""SELECT kode_cabang, {_round("coalesce(avg(billsec) FILTER (disposition = 'ANSWERED'), 0)", 3)} AS avg_talk,
  {_round("coalesce(avg(billsec) FILTER (disposition = 'NONE SUCH'), 0)", 3)} AS avg_none FROM cdr GROUP BY 1""",
    )
    sql["agg_min_max"] = _q(
        "cdr", "SELECT disposition, min(billsec) AS min_sec, max(billsec) AS max_sec, min(calldate) AS first_call, max(calldate) AS last_call FROM cdr GROUP BY 1"
    )
    levels = ", ".join(f"{_quantile(p)} AS p{str(p)[2:].ljust(2, '0')}" for p in (0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99))
    sql["quantiles_exact"] = _q("cdr", f"SELECT {levels} FROM (SELECT duration AS billsec FROM cdr)")
    sql["arg_max"] = _q(
        "customer_id",
        "SELECT id, arg_max(call_status, _ts_ms * 1000000000::HUGEINT + _seq) AS final_call_status FROM customer_id_history GROUP BY id",
    )
    sql["window_funnel"] = _q(_FUNNEL_TABLES, "SELECT * FROM levels", _STEPS, _LEVELS)
    sql["group_multi"] = _q(
        "cdr", "SELECT CAST(calldate AS DATE) AS day, disposition, kode_cabang, count(*) AS n FROM cdr GROUP BY ALL"
    )
    sql["group_wide"] = _q(
        "customer_id",
        f"SELECT {_ATTRS}, arg_max(_is_deleted, _ts_ms * 1000000000::HUGEINT + _seq) AS final_is_deleted FROM customer_id_history GROUP BY {_ATTRS}",
    )
    sql["distinct_count_filtered"] = _q(
        _FUNNEL_TABLES, "SELECT count(DISTINCT no_kontrak) AS contracts FROM funnel_events WHERE step = 1", _STEPS
    )
    sql["rollup_disposition"] = _q(
        "cdr", "SELECT disposition, count(*) AS cnt, CAST(sum(billsec) AS BIGINT) AS talk_sec FROM cdr GROUP BY 1"
    )

    # 2.5 pre-aggregates
    for name in _PREAGG:
        sql[name] = _on(name, f"SELECT * FROM {name}")
        sql[f"{name}_state"] = _on(name, f"SELECT * FROM {name}", mode="state")
    sql["partial_sum"] = _on("agg_agent_daily", "SELECT * FROM agg_agent_daily")
    sql["partial_count"] = _on("agg_collection_daily", "SELECT event_date, classification, branch_code, count FROM agg_collection_daily")
    sql["partial_count_if"] = _on("agg_cdr_minutely", "SELECT minute, branch_code, answered_calls FROM agg_cdr_minutely")
    sql["partial_avg"] = _on(
        "agg_disposition_summary",
        "SELECT count_date, disposition, branch_code, avg_talk_sec_sum, avg_talk_sec_cnt FROM agg_disposition_summary",
    )
    sql["merge_sum"] = _on(
        "agg_agent_daily",
        "SELECT agent_username, CAST(sum(tasks_assigned) AS BIGINT) AS tasks_assigned, CAST(sum(talk_time_seconds) AS BIGINT) AS talk_time_seconds FROM agg_agent_daily GROUP BY 1",
    )
    sql["merge_count"] = _on(
        "agg_cdr_minutely",
        "SELECT branch_code, CAST(sum(total_calls) AS BIGINT) AS total_calls, CAST(sum(answered_calls) AS BIGINT) AS answered_calls FROM agg_cdr_minutely GROUP BY 1",
    )
    sql["merge_avg"] = _on(
        "agg_disposition_summary",
        f"SELECT disposition, {_round('sum(avg_talk_sec_sum) / sum(avg_talk_sec_cnt)', 3)} AS avg_talk_sec FROM agg_disposition_summary GROUP BY 1",
    )
    sql["vq_live_cdr_minute"] = _on("agg_cdr_minutely", _LIVE)
    sql["vq_agent_productivity"] = _on("agg_agent_daily", _PRODUCTIVITY)
    sql["vq_disposition_dist"] = _on(
        "agg_disposition_summary", "SELECT count_date, disposition, count AS total, branch_code FROM agg_disposition_summary"
    )

    # 2.6 - 2.8 windows, order, sets
    sql["pct_of_total"] = _q(
        "collection_result", f"SELECT classification, count(*) AS total, {_pct('count(*)', 'sum(count(*)) OVER ()')} AS pct FROM collection_result GROUP BY 1"
    )
    sql["latest_per_key"] = _q("cdr", "SELECT * FROM cdr_newest")
    sql["sort_multi"] = _q(
        "collection_result", "SELECT CAST(created_ts AS DATE) AS day, classification, count(*) AS n FROM collection_result GROUP BY 1, 2"
    )
    sql["sort_custom"] = _q("collection_task", f"SELECT {_BUCKET} AS aging_bucket, count(*) AS n FROM collection_task GROUP BY 1")
    sql["topk"] = _q(
        "cdr", "SELECT uniqueid, calldate, billsec FROM cdr ORDER BY billsec DESC, uniqueid, calldate LIMIT 20"
    )
    sql["union_events"] = _q(_FUNNEL_TABLES, "SELECT * FROM funnel_events", _STEPS)
    sql["union_counts"] = _q(_ALL, _counts("{}"))
    sql["distinct_keys"] = _q(_FUNNEL_TABLES, "SELECT DISTINCT no_kontrak FROM funnel_events WHERE step = 1", _STEPS)

    # 2.9 scalar functions
    sql["scalar_functions"] = _q(
        "customer_id",
        f"""SELECT id, coalesce(nullif(marked_by, ''), 'none') AS marked_by, CAST(payment_date AS TIMESTAMP) AS paid_at,
  CAST(marked_ts AS DATE) AS marked_day, _ts_ms // 1000 AS marked_s, _ts_ms AS marked_ms,
  CAST(strftime(marked_ts, '%Y%m') AS INT) AS marked_month, date_trunc('minute', marked_ts) AS marked_minute,
  strftime(marked_ts, '%Y-%m-%d %H:%M') AS marked_text, epoch_us({_EV}) // 1000000 - _ts_ms // 1000 AS age_s,
  CASE WHEN is_paid = 1 THEN 'paid' ELSE 'open' END AS paid,
  {_round('CAST(overdue AS DOUBLE) / CAST(nullif(priority, 0) AS DOUBLE)', 2)} AS per_priority,
  md5(no_kontrak || customer_name) AS row_hash, CASE priority WHEN 1 THEN 'Task Created' WHEN 2 THEN 'Called' ELSE 'Answered' END AS stage
FROM customer_id""",
    )

    # 2.10 streaming
    sql["stream_ingest"] = _q("cdr", "SELECT * FROM cdr_history")
    sql["stream_state"] = _q("customer_id", f"SELECT {_state_cols('customer_id')} FROM customer_id")
    sql["stream_preagg"] = _on("agg_cdr_minutely", "SELECT * FROM agg_cdr_minutely")
    sql["tumbling_minute"] = _on("agg_cdr_minutely", "SELECT * FROM agg_cdr_minutely")
    sql["stream_minutes"] = _on("agg_cdr_minutely", "SELECT * FROM agg_cdr_minutely")
    sql["late_data"] = _on("agg_collection_daily", "SELECT * FROM agg_collection_daily")
    sql["delete_handling"] = _q(
        "cdr",
        """SELECT uniqueid, calldate, (SELECT count(*) FROM cdr_history h WHERE h.uniqueid = n.uniqueid AND h.calldate = n.calldate) AS versions,
  _is_deleted = 0 AS in_state FROM cdr_newest n""",
    )
    sql["compact_partials"] = _on("agg_disposition_summary", "SELECT * FROM agg_disposition_summary")

    # 2.11 time travel, audit, checks
    for n in KEY:
        day = ASOF_DAY_ORDERS if n in ("collections", "user_releases") else ASOF_DAY
        sql[f"asof_state_{n}"] = _q(n, f"SELECT {_state_cols(n)} FROM {n}_asof", _asof(n, day))
    sql["audit_trail"] = _q(
        "customer_id",
        f"SELECT _ts_ms, _op, call_status, overdue, is_paid, marked_by FROM customer_id_history WHERE no_kontrak = '{AUDIT_CONTRACT}'",
    )
    sql["latest_versions"] = _q(
        "cdr",
        f"""SELECT uniqueid, calldate, disposition, billsec, _ts_ms AS _version FROM cdr
WHERE contract_no = '{AUDIT_CONTRACT}' ORDER BY _version DESC, uniqueid, calldate LIMIT 5""",
    )
    sql["state_row_counts"] = _q(_ALL, _counts("{}"))
    stored = [f"SELECT '{n}_{kind}' AS t, count(*) AS n FROM {n}_{rows}" for n in KEY for kind, rows in (("history", "history"), ("state", "newest"))]
    stored += [f"SELECT '{name}' AS t, count(*) AS n FROM ({_agg(name)})" for name in _PREAGG]
    sql["stored_row_counts"] = _q(_ALL, " UNION ALL ".join(stored))
    sql["history_row_counts"] = _q(_ALL, _counts("{}_history"))

    # 2.13 end-user queries
    sql["live_minutes"] = _on("agg_cdr_minutely", _LIVE_MINUTES)
    sql["live_metrics"] = _on("agg_cdr_minutely", _LIVE_METRICS)
    sql["agent_status_now"] = _q(
        "agent_login_status",
        "SELECT marked_by AS agent_id, state AS status, login_date FROM agent_login_status WHERE state IN ('1','2')",
    )
    sql["queue_status_now"] = _q("customer_id", _QUEUE_STATUS)
    sql["collection_funnel"] = _q(_FUNNEL_TABLES, _FUNNEL, _STEPS, _LEVELS)
    sql["talk_quantiles"] = _q("cdr", _TALK_QUANTILES)
    sql["disposition_share"] = _q("cdr", _SHARE)
    sql["aging_by_branch"] = _q(
        "collection_task", f"SELECT {_BUCKET} AS aging_bucket, kode_cabang AS branch_code, {_AGING} FROM collection_task GROUP BY 1, 2"
    )
    sql["aging_total"] = _q("collection_task", f"SELECT {_BUCKET} AS aging_bucket, {_AGING} FROM collection_task GROUP BY 1")
    sql["ptp_by_agent"] = _q("collection_result", _PTP)
    sql["results_daily"] = _q("collection_result", _RESULTS_DAILY)
    sql["agent_productivity"] = _on("agg_agent_daily", _PROD30)
    sql["agent_productivity_top100"] = _on(
        "agg_agent_daily",
        f"""SELECT work_date, agent_username, tasks, calls, answered, ptp, talk_minutes, connect_rate_pct, ptp_rate_pct, branch_code
FROM (SELECT *, {_round('talk_sec / 60.0::DOUBLE', 1)} AS talk_minutes FROM ({_PRODUCTIVITY}) WHERE work_date >= CAST({_OR} - INTERVAL 30 DAY AS DATE)
ORDER BY work_date DESC, talk_sec DESC, agent_username, branch_code LIMIT 100)""",
    )
    sql["productivity_daily"] = _on("agg_agent_daily", _PROD_DAILY)
    sql["disposition_daily"] = _on("agg_disposition_summary", _DISP_DAILY)
    sql["collection_daily"] = _on("agg_collection_daily", _COLL_DAILY)
    sql["top_agents"] = _on("agg_agent_daily", _TOP_AGENTS)
    sql["queue_asof"] = _q("customer_id", f"SELECT {_QUEUE_COLS} FROM customer_id_asof", _asof("customer_id"))
    sql["queue_asof_versions"] = _q("customer_id", _QUEUE_VERSIONS)
    sql["queue_asof_top1000"] = _q(
        "customer_id",
        f"SELECT {_QUEUE_COLS} FROM (SELECT * FROM customer_id_asof ORDER BY priority, overdue DESC, id LIMIT 1000)",
        _asof("customer_id"),
    )
    for name in ("agent_status", "queue_status"):
        sql[f"stored_{name}"] = sql[f"{name}_now"]
    for name in ("aging_by_branch", "disposition_share", "ptp_by_agent", "v_cdr", "queue_asof", "collection_funnel"):
        sql[f"stored_{name}"] = sql[name]
    return sql
