"""Registered queries: the engine on the given tables.

``queries()`` maps names to callables ``(spark, sf_dir) -> DataFrame``;
``oracle_sql()`` holds the same results as SQL over the same tables.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracle_sql as oracle_module  # noqa: E402
from changeflow.functions import scalars as fn  # noqa: E402
from changeflow.operators import preagg as pre  # noqa: E402
from changeflow.operators.quantiles import quantiles_exact, quantiles_radix  # noqa: E402
from changeflow.operators.sets import per_contract, total, union_counts  # noqa: E402
from changeflow.operators.state import (  # noqa: E402
    age_at_cut,
    arg_max,
    asof_state,
    before_cut,
    latest_per_key,
    scan_state,
    upsert_state,
)
from changeflow.plans import distribution as dist  # noqa: E402
from changeflow.plans import funnel as fun  # noqa: E402
from changeflow.plans import serving as srv  # noqa: E402
from changeflow.plans import timetravel as tt  # noqa: E402
from changeflow.plans import views  # noqa: E402
from changeflow.session import pin_utc, scratch_dir  # noqa: E402
from changeflow.sources.changes import (  # noqa: E402
    ARRIVAL_SCHEMA,
    backfill_csv,
    changes_to_messages,
    snapshot_to_changes,
    src_changes,
    topic,
)
from changeflow.sources.decode import (  # noqa: E402
    decode_json_rows,
    drop_tombstones,
    ingest_project,
    route_bad_records,
    route_envelopes,
    version_col,
)
from changeflow.sources.history import History  # noqa: E402
from changeflow.sources.tables import make_folder  # noqa: E402
from fixtures import (  # noqa: E402
    AS_OF_EVENTS,
    AS_OF_ORDERS,
    derived_changes,
    derived_history,
)
from changeflow.specs import (  # noqa: E402
    AGENT_LOGIN_STATUS,
    CDR,
    COLLECTION_RESULT,
    COLLECTION_TASK,
    COLLECTIONS,
    CUSTOMER_ID,
    SPECS,
    USER_LOGS,
    USER_RELEASES,
    TableSpec,
)
from changeflow.streaming import ingest as stream  # noqa: E402

try:
    import corpus_pipeline
    from changeflow.llm import queries as llm
except ImportError:
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

QUEUE_DAY = oracle_module.ASOF_DAY
ORDERS_DAY = oracle_module.ASOF_DAY_ORDERS
CONTRACT = oracle_module.AUDIT_CONTRACT
MESSAGE_SLICES = 3


def _plain(df: DataFrame) -> DataFrame:
    """Instants as zone-less timestamps, as the given tables have them."""
    instants = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    if not instants:
        return df
    return df.selectExpr(
        *(f"cast(`{c}` AS timestamp_ntz) AS `{c}`" if c in instants else f"`{c}`" for c in df.columns)
    )


def _history(spark: SparkSession, sf: str, spec: TableSpec) -> DataFrame:
    return derived_history(spark, sf, spec)


def _on(spec: TableSpec, body: Callable[[DataFrame], DataFrame]) -> Query:
    """A query over the history of one table."""
    return lambda spark, sf: body(_history(spark, sf, spec))


def _on_state(spec: TableSpec, body: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: body(scan_state(_history(spark, sf, spec), spec))


def _on_partials(p: pre.Preagg, body: Callable[[DataFrame], DataFrame], mode: str = "ingest") -> Query:
    return lambda spark, sf: body(p.build(_history(spark, sf, p.table), mode))


def _messages(spark: SparkSession, sf: str, spec: TableSpec) -> DataFrame:
    return changes_to_messages(derived_changes(spark, sf, spec.name), spec)


# -- sources ----------------------------------------------------------------


def _stream_of(spark: SparkSession, spec: TableSpec, inbox: str) -> DataFrame:
    return src_changes(spark, spec, {"format": "json", "path": f"{inbox}/*"})


def _arrivals(messages: DataFrame, inbox: str, start: Callable[[], object]) -> None:
    """Write the messages in slices; after each one, run the stream dry.

    Every run resumes from the checkpoint of the run before.
    """
    for part in range(MESSAGE_SLICES):
        arrived = messages.where(F.pmod("seq", F.lit(MESSAGE_SLICES)) == part)
        arrived.write.json(f"{inbox}/part{part}")
        query = start()
        query.awaitTermination()


def _ingested(spark: SparkSession, messages: DataFrame, spec: TableSpec, job=None) -> stream.Sinks:
    """Messages that arrive in slices, through one job of the table."""
    sinks = stream.open_sinks(spark, spec, scratch_dir(spark, f"ingest-{spec.name}"))
    inbox = f"{sinks.root}/inbox"
    start = job or stream.stream_ingest
    _arrivals(messages, inbox, lambda: start(_stream_of(spark, spec, inbox), sinks))
    return sinks


def _src_changes(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "src")
    _messages(spark, sf, CDR).write.json(f"{root}/inbox/all")
    query = (
        _stream_of(spark, CDR, f"{root}/inbox")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/messages")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/messages").select("seq", "value")


def _with_tombstones(messages: DataFrame) -> DataFrame:
    """Each delete is followed by a message without value."""
    deletes = messages.where(F.col("value").contains('"__op":"d"'))
    return messages.unionAll(deletes.select(F.lit(None).cast("string").alias("value"), "seq"))


def _damaged(messages: DataFrame) -> DataFrame:
    kind = F.pmod("seq", F.lit(50))
    value = F.col("value")
    return messages.withColumn(
        "value",
        F.when(kind == 7, F.substring(value, 1, 40))
        .when(kind == 13, F.replace(value, F.lit('"amaflags":3'), F.lit('"amaflags":"three"')))
        .when(kind == 21, F.replace(value, F.lit('"__ts_ms"'), F.lit('"ts"')))
        .otherwise(value),
    )


def _placed(messages: DataFrame, spec: TableSpec) -> DataFrame:
    """As they lie in a topic of four partitions."""
    return messages.withColumns(
        {
            "topic": F.lit(topic(spec, "cdc")),
            "partition": F.pmod("seq", F.lit(4)).cast("int"),
            "offset": F.floor(F.col("seq") / 4),
            "time": F.timestamp_millis(F.lit(oracle_module.SNAPSHOT_MS) + F.col("seq")),
        }
    )


def _envelopes(changes: DataFrame, spec: TableSpec) -> DataFrame:
    row = F.struct(*(f.wire for f in spec.fields if f.wire in changes.columns))
    deleted = F.col("__op") == "d"
    return changes.select(
        F.to_json(
            F.struct(
                F.when(deleted | (F.col("__op") == "u"), row).alias("before"),
                F.when(~deleted, row).alias("after"),
                F.col("__op").alias("op"),
                F.col("__ts_ms").alias("ts_ms"),
                F.struct(F.col("__source_ts_ms").alias("ts_ms")).alias("source"),
            )
        ).alias("value"),
        F.col("__seq").alias("seq"),
    )


def _unwrap_envelope(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "envelopes")
    _envelopes(derived_changes(spark, sf, "cdr"), CDR).write.json(root)
    envelopes = spark.read.schema(ARRIVAL_SCHEMA).json(root)
    return ingest_project(route_envelopes(envelopes, CDR).good, CDR)


def _snapshot(spark: SparkSession, sf: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    table = orders.select(
        F.col("o_orderkey").alias("collections_id"),
        F.concat(F.lit("K"), "o_custkey").alias("noKontrak"),
        F.col("o_orderdate").alias("callDate"),
        F.col("o_orderstatus").alias("classification"),
        F.floor("o_totalprice").cast("decimal(15,2)").alias("ptpAmount"),
        F.to_date("o_orderdate").alias("ptpDate"),
        F.col("o_orderpriority").alias("callStatus"),
        F.col("o_orderdate").alias("createdTimeStamp"),
        (F.col("o_orderkey") % 130).cast("int").alias("overdue"),
        F.col("o_orderkey").alias("__seq"),
    )
    changes = snapshot_to_changes(table, COLLECTIONS, oracle_module.SNAPSHOT_MS)
    return ingest_project(changes, COLLECTIONS)


def _backfill_csv(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "backfill")
    exported = _history(spark, sf, USER_LOGS)
    # In another order than the table's: columns are found by name.
    turned = exported.select(*reversed(exported.columns))
    turned.write.option("header", "true").option("emptyValue", "").csv(f"{root}/export")
    sinks = stream.open_sinks(spark, USER_LOGS, root)
    read = backfill_csv(spark, USER_LOGS, f"{root}/export", multi_line=False)
    sinks.write_load(read.good, "backfill")
    _run_dry(spark, sinks)
    return sinks.history.rows().select(*USER_LOGS.history_schema().names)


def _run_dry(spark: SparkSession, sinks: stream.Sinks) -> None:
    """Let the ingest job take loads; no messages are there."""
    make_folder(spark, f"{sinks.root}/inbox/none")
    stream.stream_ingest(_stream_of(spark, sinks.spec, f"{sinks.root}/inbox"), sinks).awaitTermination()


def _append_history(spec: TableSpec) -> Query:
    """Two batches, the second written twice as after a failure."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        history = _history(spark, sf, spec)
        table = History(spark, spec, scratch_dir(spark, f"append-{spec.name}"))
        even = F.pmod("_seq", F.lit(2)) == 0
        table.append(history.where(even), "run", 0)
        for _ in range(2):
            table.append(history.where(~even), "run", 1)
        return table.all_rows().select(*spec.history_schema().names)

    return run


def _append_history_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Loads and messages of one table through the ingest job."""
    sinks = stream.open_sinks(spark, CDR, scratch_dir(spark, "append"))
    even = F.pmod("_seq", F.lit(2)) == 0
    sinks.write_load(_history(spark, sf, CDR).where(even), "first")
    rest = _messages(spark, sf, CDR).where(F.pmod("seq", F.lit(2)) == 1)
    rest.write.json(f"{sinks.root}/inbox/part0")
    stream.stream_ingest(_stream_of(spark, CDR, f"{sinks.root}/inbox"), sinks).awaitTermination()
    return sinks.history.rows().select(*CDR.history_schema().names)


#: Tables that this session has filled, by application, tables and name.
_FILLED: dict[tuple[str, str, str], stream.Sinks] = {}
#: What has run on them: jobs by name, month ends by month.
_DONE: set[tuple[tuple[str, str, str], str | int]] = set()


def _key(spark: SparkSession, sf: str, spec: TableSpec) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, sf, spec.name


def _filled(spark: SparkSession, sf: str, spec: TableSpec) -> stream.Sinks:
    """Sinks with the history as a load, left once a session for all jobs of the table."""
    key = _key(spark, sf, spec)
    if key not in _FILLED:
        sinks = stream.open_sinks(spark, spec, scratch_dir(spark, f"stored-{spec.name}"))
        make_folder(spark, f"{sinks.root}/inbox/none")
        sinks.write_load(_history(spark, sf, spec), "all")
        _FILLED[key] = sinks
    return _FILLED[key]


def _start(spark: SparkSession, sinks: stream.Sinks, job: str):
    messages = _stream_of(spark, sinks.spec, f"{sinks.root}/inbox")
    if job == "ingest":
        return stream.stream_ingest(messages, sinks)
    if job == "state":
        return stream.stream_state(messages, sinks)
    return stream.stream_preagg(messages, sinks, pre.PREAGGS[job])


def _run_jobs(spark: SparkSession, sf: str, wanted: list[tuple[TableSpec, str]]) -> None:
    """Let jobs of tables run dry, beside each other, those that have not run in this session."""
    todo = [(spec, job) for spec, job in wanted if (_key(spark, sf, spec), job) not in _DONE]
    sinks = {spec.name: _filled(spark, sf, spec) for spec, _ in todo}
    started = [(spec, job, _start(spark, sinks[spec.name], job)) for spec, job in todo]
    for spec, job, query in started:
        query.awaitTermination()
        _DONE.add((_key(spark, sf, spec), job))
    for spec in {spec.name: spec for spec, _ in todo}.values():
        if all((_key(spark, sf, spec), job) in _DONE for job in _jobs_of(spec)):
            sinks[spec.name].drop_loads()


def _jobs_of(spec: TableSpec) -> list[str]:
    return ["ingest", "state", *(p.name for p in pre.preaggs_of(spec))]


def _stored(spark: SparkSession, sf: str, spec: TableSpec) -> History:
    """The history as the ingest job stores it.  Stored once a session; queries then read the
    table."""
    _run_jobs(spark, sf, [(spec, "ingest")])
    return _filled(spark, sf, spec).history


def _stored_asof(spark: SparkSession, sf: str, spec: TableSpec, day: str) -> DataFrame:
    """What an as-of query of ``day`` needs of the stored history, which has a month end a year and
    one a month before."""
    history, key = _stored(spark, sf, spec), _key(spark, sf, spec)
    year, month = int(day[:4]), int(day[5:7])
    for end in ((year - 1) * 100 + month, year * 100 + month - 1 if month > 1 else (year - 1) * 100 + 12):
        if (key, end) not in _DONE:
            history.keep_month_end(end)
            _DONE.add((key, end))
    return history.versions_asof(day)


def _state_of(spark: SparkSession, sf: str, spec: TableSpec) -> DataFrame:
    """Newest versions as the state job keeps them.  Kept once a session; queries then read
    the state store and fold nothing."""
    _run_jobs(spark, sf, [(spec, "state")])
    return _filled(spark, sf, spec).state_rows()


def _groups_of(spark: SparkSession, sf: str, preagg: pre.Preagg) -> DataFrame:
    """An aggregate's table as its job keeps it, stored once a session."""
    _run_jobs(spark, sf, [(preagg.table, preagg.name)])
    return _filled(spark, sf, preagg.table).preagg_rows(preagg)


def _size(df: DataFrame) -> int:
    """Bytes, as the planner guesses from the files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _stored_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every stored table: histories, states (delete markers included), aggregates."""
    tables = {}
    for spec in sorted(SPECS.values(), key=lambda spec: -_size(_history(spark, sf, spec))):
        # One after the other, so that the shuffle files of one job are there at a time.
        _run_jobs(spark, sf, [(spec, "state")])
        _run_jobs(spark, sf, [(spec, job) for job in _jobs_of(spec)])
    for name, spec in SPECS.items():
        tables[f"{name}_history"] = _stored(spark, sf, spec).rows()
        tables[f"{name}_state"] = _state_of(spark, sf, spec)
    tables |= {name: _groups_of(spark, sf, p) for name, p in pre.PREAGGS.items()}
    return union_counts(tables)


def _asof_day(spec: TableSpec) -> str:
    return ORDERS_DAY if spec in (COLLECTIONS, USER_RELEASES) else QUEUE_DAY


def _on_stored(spec: TableSpec, body: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: body(_state_of(spark, sf, spec))


# -- streaming ----------------------------------------------------------------


def _stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    sinks = _ingested(spark, _with_tombstones(_messages(spark, sf, CDR)), CDR)
    return sinks.history.rows().select(*CDR.history_schema().names)


def _stream_state(spark: SparkSession, sf: str) -> DataFrame:
    """Read from the state store of the query that keeps it."""
    messages = _messages(spark, sf, CUSTOMER_ID)
    return _ingested(spark, messages, CUSTOMER_ID, stream.stream_state).current_rows()


def _preagg_stream(spark: SparkSession, messages: DataFrame, preagg: pre.Preagg) -> stream.Sinks:
    return _ingested(spark, messages, preagg.table, lambda m, sinks: stream.stream_preagg(m, sinks, preagg))


def _stream_preagg(spark: SparkSession, sf: str) -> DataFrame:
    return _preagg_stream(spark, _messages(spark, sf, CDR), pre.CDR_MINUTELY).preagg_rows(pre.CDR_MINUTELY)


def _late_data(spark: SparkSession, sf: str) -> DataFrame:
    """Slices interleave all days, so every slice but the first is late."""
    messages = _messages(spark, sf, COLLECTION_RESULT)
    return _preagg_stream(spark, messages, pre.COLLECTION_DAILY).preagg_rows(pre.COLLECTION_DAILY)


def _compact_partials(spark: SparkSession, sf: str) -> DataFrame:
    """The aggregate's months rewritten as few sorted files."""
    sinks = _preagg_stream(spark, _messages(spark, sf, CDR), pre.DISPOSITION_SUMMARY)
    sinks.rewrite()
    return sinks.preagg_rows(pre.DISPOSITION_SUMMARY)


def _stream_minutes(spark: SparkSession, sf: str) -> DataFrame:
    """Streaming tumbling windows; every slice adds to minutes of the slices before."""
    root = scratch_dir(spark, "minutes")

    def start():
        messages = _stream_of(spark, CDR, f"{root}/inbox")
        calls = ingest_project(decode_json_rows(messages, CDR), CDR)
        return stream.stream_minutes(calls, root)

    _arrivals(_messages(spark, sf, CDR), f"{root}/inbox", start)
    return stream.minute_rows(spark, root)


# -- compositions over several tables -----------------------------------------


FUNNEL_TABLES = (COLLECTION_TASK, CDR, COLLECTION_RESULT, CUSTOMER_ID)


def _funnel_inputs(spark: SparkSession, sf: str) -> list[DataFrame]:
    return [_history(spark, sf, s) for s in FUNNEL_TABLES]


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return fun.union_events(*_funnel_inputs(spark, sf), as_of=AS_OF_EVENTS)


def _funnel(spark: SparkSession, sf: str) -> DataFrame:
    return fun.collection_funnel(*_funnel_inputs(spark, sf), as_of=AS_OF_EVENTS)


def _stored_funnel(spark: SparkSession, sf: str) -> DataFrame:
    _run_jobs(spark, sf, [(spec, "ingest") for spec in FUNNEL_TABLES])
    histories = [_stored(spark, sf, spec).rows() for spec in FUNNEL_TABLES]
    return fun.collection_funnel(*histories, as_of=AS_OF_EVENTS)


def _calls_results(spark: SparkSession, sf: str) -> list[DataFrame]:
    return [_history(spark, sf, CDR), _history(spark, sf, COLLECTION_RESULT)]


def _joined(mode: str) -> Query:
    return lambda spark, sf: views.join_calls_results(*_calls_results(spark, sf), mode).select("uniqueid", "calldate", "result_id", "classification")


def _histories(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: _history(spark, sf, spec) for name, spec in SPECS.items()}


def _states(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: scan_state(df, SPECS[name]) for name, df in _histories(spark, sf).items()}


def _wide_quantiles(calls: DataFrame) -> DataFrame:
    levels = (0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
    return _spread_array(quantiles_exact(calls, "duration", levels), levels)


def _spread_array(df: DataFrame, levels: tuple, *rest: str) -> DataFrame:
    picked = (
        F.col("quantiles")[i].alias("p" + str(p)[2:].ljust(2, "0")) for i, p in enumerate(levels)
    )
    return df.select(*picked, *rest)


def _talk_quantiles(calls: DataFrame) -> DataFrame:
    result = dist.talk_quantiles(calls, AS_OF_EVENTS)
    return _spread_array(result, dist.LEVELS, "metric", "mean_sec", "max_sec", "min_sec")


def _scalar_functions(queue: DataFrame) -> DataFrame:
    state = latest_per_key(queue, CUSTOMER_ID).where(F.col("_is_deleted") == 0)
    marked = F.col("marked_ts")
    return state.select(
        "id",
        F.coalesce(F.nullif("marked_by", F.lit("")), F.lit("none")).alias("marked_by"),
        F.col("payment_date").cast("timestamp").alias("paid_at"),
        F.to_date(marked).alias("marked_day"),
        F.unix_seconds(marked).alias("marked_s"),
        F.unix_millis(marked).alias("marked_ms"),
        fn.month_key(F.unix_millis(marked)).alias("marked_month"),
        F.date_trunc("minute", marked).alias("marked_minute"),
        F.date_format(marked, "yyyy-MM-dd HH:mm").alias("marked_text"),
        (F.unix_seconds(fn.as_of_ts(AS_OF_EVENTS)) - F.unix_seconds(marked)).alias("age_s"),
        F.when(F.col("is_paid") == 1, F.lit("paid")).otherwise(F.lit("open")).alias("paid"),
        fn.round_half_up(F.col("overdue") / F.nullif("priority", F.lit(0)), 2).alias("per_priority"),
        fn.row_hash(F.col("no_kontrak"), F.col("customer_name")).alias("row_hash"),
        fn.stage_label(F.col("priority")).alias("stage"),
    )


def _filter_recent(calls: DataFrame) -> DataFrame:
    return calls.agg(
        F.count_if(fn.recent("calldate", AS_OF_EVENTS, 60, "MINUTE")).alias("last_hour"),
        F.count_if(fn.recent("calldate", AS_OF_EVENTS, 7, "DAY")).alias("last_week"),
        F.count_if(fn.since_day("calldate", AS_OF_EVENTS, 30)).alias("last_month"),
    )


def _sum_where(amount: str, condition):
    return fn.exact_sum(F.when(condition, F.col(amount)).otherwise(F.lit(0.0)))


def _orders(body: Callable[[DataFrame], DataFrame]) -> Query:
    """A query over amounts with cents."""
    return lambda spark, sf: body(spark.read.parquet(f"{sf}/orders.parquet"))


PRICE_LEVELS = (0.0, 0.1, 0.5, 0.9, 0.999, 1.0)


def _price_quantiles(orders: DataFrame) -> DataFrame:
    found = quantiles_radix(orders, "o_totalprice", PRICE_LEVELS)
    return found.select(*(F.col("quantiles")[i].alias(f"q{i}") for i in range(len(PRICE_LEVELS))), "n")


def _key_quantiles(orders: DataFrame) -> DataFrame:
    """The same of a 64-bit integer that spreads over all of its range.

    Keys beyond 1.3 million pass that range: the numbers are then exact decimals, as long as they
    have to be, and the quantiles too.
    """
    key = F.col("o_orderkey").cast("decimal(19,0)")
    wide = key * F.lit(Decimal(7_000_000_000_003)) - F.lit(Decimal(1 << 50))
    ends = [int(v) for v in orders.agg(F.min(wide), F.max(wide)).first() if v is not None]
    fits = all(-(1 << 63) <= v < 1 << 63 for v in ends)
    digits = max((len(str(abs(v))) for v in ends), default=1)
    spread = orders.select(wide.cast("long" if fits else f"decimal({digits},0)").alias("wide"))
    found = quantiles_radix(spread, "wide", PRICE_LEVELS)
    return found.select(*(F.col("quantiles")[i].alias(f"q{i}") for i in range(len(PRICE_LEVELS))), "n")


def _registry() -> dict[str, Query]:
    n_rows = F.count(F.lit(1)).alias("n")
    is_ptp = F.col("classification") == "PTP"
    is_rpc = F.col("classification") == "RPC"
    q: dict[str, Query] = {}

    # 2.1 sources, scans, sinks
    q["src_changes"] = _src_changes
    q["decode_json_rows"] = lambda s, sf: decode_json_rows(_messages(s, sf, USER_LOGS), USER_LOGS)
    q["route_bad_records"] = lambda s, sf: route_bad_records(
        _placed(_damaged(_messages(s, sf, CDR)), CDR), CDR
    ).bad
    q["drop_tombstones"] = lambda s, sf: drop_tombstones(_with_tombstones(_messages(s, sf, CDR)))
    q["unwrap_envelope"] = _unwrap_envelope
    q["snapshot_to_changes"] = _snapshot
    q["backfill_csv"] = _backfill_csv
    q["append_history"] = _append_history_stream
    for name, spec in SPECS.items():
        q[f"append_history_{name}"] = _append_history(spec)
    for name, spec in SPECS.items():
        q[f"ingest_project_{name}"] = lambda s, sf, spec=spec: ingest_project(
            decode_json_rows(_messages(s, sf, spec), spec), spec
        )
        q[f"upsert_state_{name}"] = _on(spec, lambda h, spec=spec: upsert_state(h, spec))
        q[f"scan_state_{name}"] = _on(spec, lambda h, spec=spec: scan_state(h, spec))
    q["result_json_lines"] = _on(
        CDR, lambda h: tt.result_json_lines(dist.disposition_share(h, AS_OF_EVENTS))
    )

    # 2.2 projections, filters, views
    q["delete_flag"] = _on(CDR, lambda h: h.groupBy("_is_deleted").agg(n_rows))
    q["version_col"] = _on(
        CUSTOMER_ID, lambda h: latest_per_key(h, CUSTOMER_ID).select("id", version_col())
    )
    q["filter_recent"] = _on_state(CDR, _filter_recent)
    q["filter_equality"] = _on_state(
        CDR,
        lambda c: c.where((F.col("disposition") == "ANSWERED") & (F.col("contract_no") != "")).select(
            "uniqueid", "calldate"
        ),
    )
    q["filter_in"] = _on_state(
        CUSTOMER_ID,
        lambda c: c.where(F.col("call_status").isin("IN_QUEUE", "CALLING", "DONE")).select(
            "id", "call_status"
        ),
    )
    q["filter_asof"] = _on(
        CUSTOMER_ID, lambda h: before_cut(h, QUEUE_DAY).select("id", "_ts_ms", "_op")
    )
    q["case_bucket"] = _on(
        COLLECTION_TASK,
        lambda h: views.v_collection_task(h).select("id", "days_overdue", "aging_bucket"),
    )
    q["rate_pct"] = _on_state(
        USER_RELEASES,
        lambda r: r.select(
            "id",
            "hash",
            fn.rate_pct(F.col("total_answered"), F.col("total_called")).alias("connect_pct"),
            fn.rate_pct_positive(F.col("total_ptp"), F.col("total_answered")).alias("closure_pct"),
        ),
    )
    q["lateral_alias"] = _on_state(
        COLLECTION_RESULT,
        lambda r: r.groupBy("agent_id")
        .agg(F.count_if(is_ptp).alias("yes"), F.count(F.lit(1)).alias("total"))
        .withColumn("pct", fn.rate_pct(F.col("yes"), F.col("total"))),
    )
    q["v_agent_login_status"] = _on(
        AGENT_LOGIN_STATUS, lambda h: views.v_agent_login_status(h, AS_OF_EVENTS)
    )
    q["v_cdr"] = lambda s, sf: views.v_cdr(*_calls_results(s, sf), "literal")
    q["v_cdr_clean"] = lambda s, sf: views.v_cdr(*_calls_results(s, sf), "clean")
    q["v_collection_task"] = _on(COLLECTION_TASK, views.v_collection_task)
    q["v_customer_queue"] = _on(CUSTOMER_ID, views.v_customer_queue)
    q["v_user_session"] = _on(USER_LOGS, views.v_user_session)
    q["v_agent_daily_summary"] = _on(USER_RELEASES, views.v_agent_daily_summary)
    q["v_collection_result_summary"] = _on(COLLECTION_RESULT, views.v_collection_result_summary)

    # 2.3 joins
    q["join_calls_results"] = _joined("literal")
    q["join_calls_results_clean"] = _joined("clean")
    q["join_calls_results_spread"] = _joined("literal")  # an older name of the same
    q["cross_scalar"] = _on(CUSTOMER_ID, lambda h: age_at_cut(h, QUEUE_DAY))
    q["scalar_subquery"] = _on_state(COLLECTION_TASK, per_contract)

    # 2.4 aggregations
    q["agg_count"] = _on_state(COLLECTION_RESULT, lambda r: r.groupBy("kode_cabang").agg(n_rows))
    q["agg_count_if"] = _on_state(
        COLLECTION_RESULT,
        lambda r: r.groupBy("agent_id").agg(
            F.count_if(is_ptp).alias("ptp_yes"), F.count_if(is_rpc).alias("rpc_count")
        ),
    )
    q["agg_sum"] = _on_state(
        COLLECTION_TASK,
        lambda t: t.groupBy("kode_cabang").agg(
            fn.exact_sum(F.col("out_std_pkk")).alias("outstanding"),
            fn.millions(fn.exact_sum(F.col("out_std_pkk"))).alias("outstanding_mio"),
        ),
    )
    q["agg_sum_if"] = _on_state(
        COLLECTION_RESULT,
        lambda r: r.groupBy("kode_cabang").agg(_sum_where("ptp_amount", is_ptp).alias("promised")),
    )
    q["agg_sum_cents"] = _orders(
        lambda o: o.groupBy("o_orderpriority").agg(fn.exact_sum(F.col("o_totalprice")).alias("total"))
    )
    q["agg_sum_if_cents"] = _orders(
        lambda o: o.groupBy("o_custkey").agg(
            _sum_where("o_totalprice", F.col("o_orderstatus") == "F").alias("filled")
        )
    )
    q["quantiles_radix_price"] = _orders(_price_quantiles)
    q["quantiles_radix_key"] = _orders(_key_quantiles)
    q["agg_avg"] = _on_state(CDR, dist.mean_talk)
    q["agg_min_max"] = _on_state(
        CDR,
        lambda c: c.groupBy("disposition").agg(
            F.min("billsec").alias("min_sec"),
            F.max("billsec").alias("max_sec"),
            F.min("calldate").alias("first_call"),
            F.max("calldate").alias("last_call"),
        ),
    )
    q["quantiles_exact"] = _on_state(CDR, _wide_quantiles)
    q["arg_max"] = _on(CUSTOMER_ID, lambda h: arg_max(h, ["id"], "call_status"))
    q["window_funnel"] = lambda s, sf: fun.contract_levels(_events(s, sf))
    q["group_multi"] = _on_state(
        CDR,
        lambda c: c.groupBy(F.to_date("calldate").alias("day"), "disposition", "kode_cabang").agg(n_rows),
    )
    q["group_wide"] = _on(
        CUSTOMER_ID,
        lambda h: arg_max(h, tt.QUEUE_ATTRIBUTES, "_is_deleted").withColumnRenamed(
            "final__is_deleted", "final_is_deleted"
        ),
    )
    q["distinct_count_filtered"] = lambda s, sf: _events(s, sf).agg(
        F.count_distinct(F.when(F.col("step") == 1, F.col("no_kontrak"))).alias("contracts")
    )
    q["rollup_disposition"] = _on(CDR, dist.rollup_disposition)

    # 2.5 pre-aggregates
    for name, p in pre.PREAGGS.items():
        q[name] = _on_partials(p, lambda part: part)
        q[f"{name}_state"] = _on_partials(p, lambda part: part, mode="state")
    q["partial_sum"] = _on_partials(pre.AGENT_DAILY, lambda part: part)
    q["partial_count"] = _on_partials(
        pre.COLLECTION_DAILY, lambda part: part.select(*pre.COLLECTION_DAILY.dim_names, "count")
    )
    q["partial_count_if"] = _on_partials(
        pre.CDR_MINUTELY, lambda part: part.select("minute", "branch_code", "answered_calls")
    )
    q["partial_avg"] = _on_partials(pre.DISPOSITION_SUMMARY, lambda part: part.drop("count"))
    q["merge_sum"] = _on_partials(
        pre.AGENT_DAILY,
        lambda part: pre.AGENT_DAILY.merge(
            part, "agent_username", measures=["tasks_assigned", "talk_time_seconds"]
        ),
    )
    q["merge_count"] = _on_partials(
        pre.CDR_MINUTELY,
        lambda part: pre.CDR_MINUTELY.merge(
            part, "branch_code", measures=["total_calls", "answered_calls"]
        ),
    )
    q["merge_avg"] = _on_partials(
        pre.DISPOSITION_SUMMARY,
        lambda part: pre.DISPOSITION_SUMMARY.merge(
            part, "disposition", measures=["avg_talk_sec"]
        ).withColumn("avg_talk_sec", fn.round_half_up(F.col("avg_talk_sec"), 3)),
    )
    q["vq_live_cdr_minute"] = _on_partials(
        pre.CDR_MINUTELY, lambda part: srv.vq_live_cdr_minute(part, AS_OF_EVENTS)
    )
    q["vq_agent_productivity"] = _on_partials(pre.AGENT_DAILY, srv.vq_agent_productivity)
    q["vq_disposition_dist"] = _on_partials(pre.DISPOSITION_SUMMARY, srv.vq_disposition_dist)

    # 2.6 - 2.8 windows, order, sets
    q["pct_of_total"] = _on_state(
        COLLECTION_RESULT,
        lambda r: r.groupBy("classification")
        .agg(F.count(F.lit(1)).alias("total"))
        .withColumn("pct", fn.rate_pct(F.col("total"), total("total"))),
    )
    q["latest_per_key"] = _on(CDR, lambda h: latest_per_key(h, CDR))
    q["sort_multi"] = _on_state(
        COLLECTION_RESULT,
        lambda r: r.groupBy(F.to_date("created_ts").alias("day"), "classification")
        .agg(n_rows)
        .orderBy(F.desc("day"), F.desc("n"), "classification"),
    )
    q["sort_custom"] = _on(
        COLLECTION_TASK,
        lambda h: views.v_collection_task(h)
        .groupBy("aging_bucket")
        .agg(n_rows)
        .orderBy(fn.aging_rank(F.col("aging_bucket"))),
    )
    q["topk"] = _on_state(
        CDR,
        lambda c: c.orderBy(F.desc("billsec"), "uniqueid", "calldate")
        .limit(20)
        .select("uniqueid", "calldate", "billsec"),
    )
    q["union_events"] = _events
    q["union_counts"] = lambda s, sf: union_counts(_states(s, sf))
    q["distinct_keys"] = (
        lambda s, sf: _events(s, sf).where(F.col("step") == 1).select("no_kontrak").distinct()
    )

    # 2.9 scalar functions
    q["scalar_functions"] = _on(CUSTOMER_ID, _scalar_functions)

    # 2.10 streaming
    q["stream_ingest"] = _stream_ingest
    q["stream_state"] = _stream_state
    q["stream_preagg"] = _stream_preagg
    q["tumbling_minute"] = _on(CDR, stream.tumbling_minute)
    q["stream_minutes"] = _stream_minutes
    q["late_data"] = _late_data
    q["delete_handling"] = _on(CDR, tt.version_counts)
    q["compact_partials"] = _compact_partials

    # 2.11 time travel, audit, checks
    for name, spec in SPECS.items():
        day = _asof_day(spec)
        q[f"asof_state_{name}"] = lambda s, sf, spec=spec, day=day: asof_state(
            _stored_asof(s, sf, spec, day), spec, day
        )
    q["audit_trail"] = _on(CUSTOMER_ID, lambda h: tt.audit_trail(h, CONTRACT))
    q["latest_versions"] = _on(CDR, lambda h: tt.latest_versions(h, CONTRACT))
    q["state_row_counts"] = lambda s, sf: tt.state_row_counts(_histories(s, sf))
    q["stored_row_counts"] = _stored_row_counts
    q["history_row_counts"] = lambda s, sf: tt.history_row_counts(_histories(s, sf))

    # The same questions to stored state: nothing is rebuilt from a history.
    q["stored_agent_status"] = _on_stored(AGENT_LOGIN_STATUS, tt.agent_status_now)
    q["stored_queue_status"] = _on_stored(CUSTOMER_ID, tt.queue_status_now)
    q["stored_aging_by_branch"] = _on_stored(COLLECTION_TASK, dist.aging_by_branch)
    q["stored_disposition_share"] = _on_stored(CDR, lambda h: dist.disposition_share(h, AS_OF_EVENTS))
    q["stored_ptp_by_agent"] = _on_stored(COLLECTION_RESULT, lambda h: dist.ptp_by_agent(h, AS_OF_EVENTS))
    q["stored_v_cdr"] = lambda s, sf: views.v_cdr(
        _state_of(s, sf, CDR), _state_of(s, sf, COLLECTION_RESULT), "literal"
    )

    q["stored_collection_funnel"] = _stored_funnel

    # 2.13 end-user queries
    q["live_minutes"] = _on_partials(
        pre.CDR_MINUTELY, lambda part: srv.live_minutes(part, AS_OF_EVENTS)
    )
    q["live_metrics"] = _on_partials(
        pre.CDR_MINUTELY, lambda part: srv.live_metrics(part, AS_OF_EVENTS)
    )
    q["agent_status_now"] = _on(AGENT_LOGIN_STATUS, tt.agent_status_now)
    q["queue_status_now"] = _on(CUSTOMER_ID, tt.queue_status_now)
    q["collection_funnel"] = _funnel
    q["talk_quantiles"] = _on(CDR, _talk_quantiles)
    q["disposition_share"] = _on(CDR, lambda h: dist.disposition_share(h, AS_OF_EVENTS))
    q["aging_by_branch"] = _on(COLLECTION_TASK, dist.aging_by_branch)
    q["aging_total"] = _on(COLLECTION_TASK, dist.aging_total)
    q["ptp_by_agent"] = _on(COLLECTION_RESULT, lambda h: dist.ptp_by_agent(h, AS_OF_EVENTS))
    q["results_daily"] = _on(COLLECTION_RESULT, lambda h: dist.results_daily(h, AS_OF_EVENTS))
    q["agent_productivity"] = _on_partials(
        pre.AGENT_DAILY, lambda part: srv.agent_productivity(part, AS_OF_ORDERS)
    )
    q["agent_productivity_top100"] = _on_partials(
        pre.AGENT_DAILY, lambda part: srv.agent_productivity(part, AS_OF_ORDERS, limit=100)
    )
    q["productivity_daily"] = _on_partials(
        pre.AGENT_DAILY, lambda part: srv.productivity_daily(part, AS_OF_ORDERS)
    )
    q["disposition_daily"] = _on_partials(
        pre.DISPOSITION_SUMMARY, lambda part: srv.disposition_daily(part, AS_OF_EVENTS)
    )
    q["collection_daily"] = _on_partials(
        pre.COLLECTION_DAILY, lambda part: srv.collection_daily(part, AS_OF_EVENTS)
    )
    q["top_agents"] = _on_partials(
        pre.AGENT_DAILY, lambda part: srv.top_agents(part, AS_OF_ORDERS)
    )
    q["queue_asof"] = _on(CUSTOMER_ID, lambda h: tt.queue_asof(h, QUEUE_DAY))
    q["stored_queue_asof"] = lambda s, sf: tt.queue_asof(
        _stored_asof(s, sf, CUSTOMER_ID, QUEUE_DAY), QUEUE_DAY
    )
    q["queue_asof_versions"] = _on(
        CUSTOMER_ID, lambda h: tt.queue_asof(h, QUEUE_DAY, mode="versions")
    )
    q["queue_asof_top1000"] = lambda s, sf: tt.queue_asof(
        _stored_asof(s, sf, CUSTOMER_ID, QUEUE_DAY), QUEUE_DAY, limit=1000
    )
    return q


# -- driver contract ----------------------------------------------------------


def _entry_query(name: str) -> Query:
    # Column expressions need a running session, so the registry is built late.
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)
        return _plain(_registry()[name](spark, sf_dir))

    return run


def entry(spark: SparkSession) -> DataFrame:
    return queries()["collection_funnel"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    found = {name: _entry_query(name) for name in oracle_module.oracle()}
    if llm:
        found |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle_module.oracle()
    if llm:
        found |= llm.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
