"""Edge cases of change capture, in batch and through the stream."""

import datetime as dt
import json
import time
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from changeflow.operators.preagg import COLLECTION_DAILY, PREAGGS, preaggs_of
from changeflow.operators.state import asof_state, lookup_state, scan_state
from changeflow.plans import distribution as dist
from changeflow.plans import timetravel as tt
from changeflow.plans import views
from changeflow.session import scratch_dir
from changeflow.sources.changes import backfill_csv, numbered, snapshot_to_changes, src_changes
from changeflow.sources.decode import decode_json_rows, ingest_project, route_bad_records, route_envelopes
from changeflow.sources.history import History
from changeflow.specs import AGENT_LOGIN_STATUS, CDR, COLLECTION_RESULT, CUSTOMER_ID, SPECS, USER_LOGS
from changeflow.streaming import ingest as stream

DAY1 = 1_700_000_000_000 // 86_400_000 * 86_400_000  # a midnight
DAY_MS = 86_400_000
DAY_TEXT = dt.datetime.fromtimestamp(DAY1 / 1000, dt.timezone.utc).date().isoformat()


def change(key, ts, op="u", **payload):
    return {"id": key, **payload, "__op": op, "__ts_ms": DAY1 + ts, "__source_ts_ms": DAY1 + ts,
            "__deleted": "true" if op == "d" else "false"}


SCENARIO = [
    change(1, 1, "c", callStatus="A"), change(1, 2, callStatus="B"), change(1, 3, callStatus="C"),
    change(2, 1, "c", callStatus="A"), change(2, 2, "d", callStatus="A"), None,
    change(3, 1, "c", callStatus="A"), change(3, 2, "d", callStatus="A"), change(3, 3, "c", callStatus="B"),
    change(4, 5, callStatus="first"), change(4, 5, callStatus="second"),
    change(5, 9, callStatus="new"), change(5, 4, callStatus="late"),
    change(6, 1, "r", callStatus="A"), change(6, 2, callStatus="B"),
    change(7, 1, "c"),
    '{"id": 8, "callStatus": "cut o',
    change(9, 1, "c", priority="high"),
    change(None, 1, "c"),
    change(10, 1, "c", callStatus="A", unknownField=[1, {"x": 2}]),
]
CURRENT = {1: "C", 3: "B", 4: "second", 5: "new", 6: "B", 7: "", 10: "A"}


def test_state_in_batch(history):
    df = history(CUSTOMER_ID, SCENARIO)
    state = {r.id: r.call_status for r in scan_state(df, CUSTOMER_ID).collect()}
    assert state == CURRENT
    assert df.where("id = 1").count() == 3
    assert df.where("id = 5").count() == 2


def test_order_of_arrival_does_not_matter(history):
    df = history(CUSTOMER_ID, SCENARIO).orderBy(F.rand(7)).repartition(3)
    assert {r.id: r.call_status for r in scan_state(df, CUSTOMER_ID).collect()} == CURRENT


def test_nulls_become_zero_values(history):
    row = scan_state(history(CUSTOMER_ID, SCENARIO), CUSTOMER_ID).where("id = 7").first()
    assert (row.no_kontrak, row.priority, row.out_std_pkk, row.is_paid) == ("", 0, 0.0, 0)
    assert row.payment_date == dt.date(1970, 1, 1)


def test_bad_records_keep_their_text(messages):
    good, bad = route_bad_records(messages(SCENARIO), CUSTOMER_ID)
    assert good.count() == len(SCENARIO) - 4  # one tombstone, three bad
    found = {r.seq: (r.reason, r.value) for r in bad.collect()}
    assert found[16] == ("malformed", '{"id": 8, "callStatus": "cut o')
    assert found[17][0] == "malformed" and "high" in found[17][1]
    assert found[18][0] == "no key or version"
    assert len(found) == 3


def test_as_of(history):
    df = history(CUSTOMER_ID, [
        change(1, 0, "c", callStatus="A"), change(1, 86_400_000, "d", callStatus="A"),
        change(2, 86_399_000, "c", callStatus="at the cut"),
        change(3, 86_399_500, "c", callStatus="after the cut"),
    ])
    assert {r.id for r in asof_state(df, CUSTOMER_ID, DAY_TEXT).collect()} == {1, 2}
    assert {r.id for r in scan_state(df, CUSTOMER_ID).collect()} == {2, 3}
    with pytest.raises(ValueError):
        asof_state(df, CUSTOMER_ID, "2024-1-5' OR '1'='1")


def test_queue_as_of_versions(history):
    df = history(CUSTOMER_ID, [
        change(1, 1, "c", callStatus="A"), change(1, 2, callStatus="B"), change(1, 3, "d", callStatus="B"),
    ])
    versions = tt.queue_asof(df, DAY_TEXT, mode="versions").collect()
    assert [r.call_status for r in versions] == ["A"]  # "B" ended as deleted
    assert tt.queue_asof(df, DAY_TEXT).count() == 0


def test_audit_and_lookup(history):
    df = history(CUSTOMER_ID, [change(i % 3, i, noKontrak=f"K{i % 2}", callStatus=str(i)) for i in range(12)])
    assert [r.call_status for r in tt.audit_trail(df, "K1").collect()] == ["1", "3", "5", "7", "9", "11"]
    wanted = F.col("no_kontrak") == "K1"
    expected = set(rows(scan_state(df, CUSTOMER_ID).where(wanted)))
    assert set(rows(lookup_state(df, CUSTOMER_ID, wanted))) == expected


def test_logout(history):
    df = history(USER_LOGS, [change(1, 1, "c", outTimeStamp=None), change(2, 1, "c", outTimeStamp=0),
                             change(3, 1, "c", outTimeStamp=DAY1)])
    found = {r.id: r.session_status for r in views.v_user_session(df).collect()}
    assert found == {1: "ACTIVE", 2: "ACTIVE", 3: "CLOSED"}


def result(key, ts, op, call="x", **payload):
    return change(None, ts, op, uniqueId=key, callId=call, createdTimeStamp=DAY1, **payload)


def test_pre_aggregate_modes(history):
    df = history(COLLECTION_RESULT, [
        result(1, 1, "c", classification="PTP", ptpAmount=5.0),
        result(1, 2, "u", classification="PTP", ptpAmount=7.0),
        result(2, 1, "c", classification="PTP", ptpAmount=1.0), result(2, 2, "d", classification="PTP"),
    ])
    ingest = COLLECTION_DAILY.merge(COLLECTION_DAILY.build(df, "ingest"), "classification")
    state = COLLECTION_DAILY.merge(COLLECTION_DAILY.build(df, "state"), "classification")
    assert rows(ingest) == [("PTP", 3, 13.0)]
    assert rows(state) == [("PTP", 1, 7.0)]
    with pytest.raises(ValueError):
        COLLECTION_DAILY.build(df, "other")


def test_call_whose_only_result_is_deleted(history):
    calls = history(CDR, [change(None, 1, "c", uniqueid=c, calldate=DAY1) for c in "abc"])
    results = history(COLLECTION_RESULT, [
        *(result(i, 1, "c", "a", classification=f"R{i}") for i in range(8)),
        result(90, 1, "c", "b", classification="PTP"), result(90, 2, "d", "b", classification="PTP"),
        result(91, 1, "c", "b", classification="PTP"), result(91, 2, "d", "b", classification="PTP"),
    ])
    many = [("a", f"R{i}") for i in range(8)]
    found = {m: sorted((r.uniqueid, r.result_classification)
                       for r in views.v_cdr(calls, results, m).collect())
             for m in ("literal", "clean")}
    assert found["literal"] == many + [("c", "NO_RESULT")]
    assert found["clean"] == many + [("b", "NO_RESULT"), ("c", "NO_RESULT")]


def test_envelope(messages):
    row = {"id": 1, "callStatus": "A", "isPaid": 1}
    envelope = [
        {"before": None, "after": row, "op": "c", "ts_ms": 5, "source": {"ts_ms": 4}},
        {"before": row, "after": row | {"callStatus": "B"}, "op": "u", "ts_ms": 6, "source": {"ts_ms": 5}},
        {"before": row | {"callStatus": "B"}, "after": None, "op": "d", "ts_ms": 7, "source": {"ts_ms": 6}},
        None,
        "{broken",
    ]
    envelope.append({"before": None, "after": None, "op": "d", "ts_ms": 8, "source": None})
    envelope.append({"before": None, "after": row, "ts_ms": 9})
    good, bad = route_envelopes(messages(envelope), CUSTOMER_ID)
    assert good._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert "to_json" not in good._jdf.queryExecution().optimizedPlan().toString()
    found = rows(ingest_project(good, CUSTOMER_ID).orderBy("_ts_ms").select(
        "id", "call_status", "is_paid", "_op", "_ts_ms", "_source_ts_ms", "_is_deleted"))
    assert found == [(1, "A", 1, "c", 5, 4, 0), (1, "B", 1, "u", 6, 5, 0), (1, "B", 1, "d", 7, 6, 1)]
    assert [(r.seq, r.reason) for r in bad.orderBy("seq").collect()] == [
        (4, "malformed"), (5, "no key or version"), (6, "no operation")]


def test_snapshot_is_an_upsert(spark, history):
    table = spark.sql("SELECT 1L AS id, 'old' AS callStatus, cast(12.5 AS decimal(15,2)) AS outStdPkk, "
                      "date'2024-01-02' AS paymentDate, timestamp'2024-01-02 03:04:05' AS markedTimestamp")
    snap = ingest_project(snapshot_to_changes(table, CUSTOMER_ID, DAY1), CUSTOMER_ID)
    row = scan_state(snap, CUSTOMER_ID).first()
    assert (row.out_std_pkk, row.payment_date) == (12.5, dt.date(2024, 1, 2))
    later = snap.unionByName(history(CUSTOMER_ID, [change(1, 1, callStatus="new")]))
    assert [r.call_status for r in scan_state(later, CUSTOMER_ID).collect()] == ["new"]


# -- the same through the stream ------------------------------------------------


def inbox(spark, sinks):
    return src_changes(spark, sinks.spec, {
        "format": "json", "path": f"{sinks.root}/inbox/*", "maxFilesPerTrigger": "1"})


def ingest(spark, sinks, job=stream.stream_ingest):
    job(inbox(spark, sinks), sinks).awaitTermination()


def deliver(messages, root, name, events, start):
    messages(events, start).coalesce(1).write.json(f"{root}/inbox/{name}")


def plain(df):
    return sorted(map(str, rows(df)))


def states(sinks):
    return {r.id: r.call_status for r in sinks.current_rows().collect()}


def test_a_crash_between_two_sinks(spark, messages, history, monkeypatch):
    """The batch whose quarantine is lost is not seen, and is whole after the restart."""
    sinks = stream.open_sinks(spark, CUSTOMER_ID, scratch_dir(spark, "crash"))
    deliver(messages, sinks.root, "a", SCENARIO[:9], 0)
    ingest(spark, sinks)
    first = history(CUSTOMER_ID, SCENARIO[:9])
    columns = first.columns

    deliver(messages, sinks.root, "b", SCENARIO[9:], 9)
    whole = stream.replace_partitions

    def dies(df, path, *rest):
        if "/quarantine/" in path:
            raise RuntimeError("lost")
        whole(df, path, *rest)

    monkeypatch.setattr(stream, "replace_partitions", dies)
    with pytest.raises(Exception, match="lost"):
        ingest(spark, sinks)
    monkeypatch.undo()
    assert sinks.history.all_rows().count() > first.count()  # there, but not finished
    assert plain(sinks.history.rows().select(*columns)) == plain(first)
    assert sinks.quarantine().count() == 0

    ingest(spark, sinks)  # the same batch again
    assert plain(sinks.history.rows().select(*columns)) == plain(history(CUSTOMER_ID, SCENARIO))
    assert sinks.history.all_rows().count() == sinks.history.rows().count()
    assert sinks.quarantine().count() == 3


def test_a_batch_written_again_replaces_itself(spark, history):
    table = History(spark, CUSTOMER_ID, scratch_dir(spark, "again"))
    assert table.rows().count() == table.all_rows().count() == 0
    table.append(history(CUSTOMER_ID, [change(1, 1), change(2, 90 * DAY_MS)]), "run", 0)
    table.append(history(CUSTOMER_ID, [change(3, 1)]), "run", 1)
    table.append(history(CUSTOMER_ID, [change(1, 1), change(2, 90 * DAY_MS), change(4, 1)]), "run", 0)
    assert sorted(r.id for r in table.all_rows().collect()) == [1, 2, 3, 4]
    # A job that fails while it writes leaves what was there.
    broken = history(CUSTOMER_ID, [change(9, 1)]).withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        table.append(broken, "run", 1)
    assert sorted(r.id for r in table.all_rows().collect()) == [1, 2, 3, 4]


def test_a_new_checkpoint_hides_nothing(spark, messages):
    sinks = stream.open_sinks(spark, CUSTOMER_ID, scratch_dir(spark, "runs"))
    deliver(messages, sinks.root, "a", [change(1, 1)], 0)
    ingest(spark, sinks)
    deliver(messages, sinks.root, "b", [change(2, 1)], 1)
    stream.stream_ingest(inbox(spark, sinks), sinks, job="second").awaitTermination()
    assert sorted(r.id for r in sinks.history.rows().collect()) == [1, 1, 2]


def test_stored_state(spark, messages, history):
    """Restarts, late and repeated versions and loads; what the query itself keeps is the state."""
    sinks = stream.open_sinks(spark, CUSTOMER_ID, scratch_dir(spark, "state"))
    assert sinks.state_rows().count() == 0
    for name, events, start in (("a", SCENARIO[:9], 0), ("b", SCENARIO[9:], 9)):
        deliver(messages, sinks.root, name, events, start)
        ingest(spark, sinks, stream.stream_state)
    assert states(sinks) == CURRENT
    assert plain(sinks.current_rows()) == plain(scan_state(history(CUSTOMER_ID, SCENARIO), CUSTOMER_ID))
    late = [change(2, 0, "r", callStatus="old"), change(3, 2, "d"), change(1, 2, callStatus="B")]
    deliver(messages, sinks.root, "c", late, 0)
    ingest(spark, sinks, stream.stream_state)
    assert states(sinks) == CURRENT
    sinks.write_load(history(CUSTOMER_ID, [change(20, 1, "r", callStatus="Z"), change(2, 0, "r", callStatus="old")]), "csv")
    ingest(spark, sinks, stream.stream_state)
    assert states(sinks) == CURRENT | {20: "Z"}
    assert sinks.state_rows().where("_is_deleted = 1").count() == 1


def test_every_table_streams(spark, messages, history):
    from seed import EVENTS

    for name, spec in SPECS.items():
        sinks = stream.open_sinks(spark, spec, scratch_dir(spark, f"all-{name}"))
        assert sinks.history.rows().count() == 0  # nothing there yet
        deliver(messages, sinks.root, "a", EVENTS[name], 0)
        for query in stream.stream_table(inbox(spark, sinks), sinks):
            query.awaitTermination()
        expected = history(spec, EVENTS[name])
        assert plain(sinks.history.rows().select(*expected.columns)) == plain(expected)
        state = scan_state(expected, spec)
        assert plain(sinks.current_rows()) == plain(state) == plain(scan_state(sinks.state_rows(), spec))
        for preagg in preaggs_of(spec):
            assert plain(sinks.preagg_rows(preagg)) == plain(preagg.build(expected))


def test_aggregates_replace_their_months(spark, messages, history, monkeypatch):
    """One row per group after each batch; a batch that is run again changes nothing."""
    sinks = stream.open_sinks(spark, COLLECTION_RESULT, scratch_dir(spark, "months"))
    events = [result(i, i, "c", classification="AB"[i % 2], ptpAmount=1.5, kodeCabang=None if i % 3 else "x") for i in range(12)]
    other = [e | {"createdTimeStamp": DAY1 + 70 * DAY_MS} for e in events[:4]]

    def job(source, opened):
        return stream.stream_preagg(source, opened, COLLECTION_DAILY)

    whole, seen = stream.replace_partitions, []
    monkeypatch.setattr(stream, "replace_partitions", lambda df, *rest: (seen.append({r[stream.PART] for r in df.select(stream.PART).collect()}), whole(df, *rest)))
    for part, arrived in enumerate((events[:6] + other, events[6:], [])):
        deliver(messages, sinks.root, f"p{part}", arrived, 0)
        ingest(spark, sinks, job)
    assert [len(m) for m in seen][:2] == [2, 1]  # the second batch leaves the other month alone
    stored = sinks.preagg_rows(COLLECTION_DAILY)
    expected = COLLECTION_DAILY.build(history(COLLECTION_RESULT, events + other))
    assert plain(stored) == plain(expected)
    assert "Exchange" not in stored._jdf.queryExecution().executedPlan().toString()
    monkeypatch.undo()

    # The table is written, but the batch is not finished: it is run again.
    deliver(messages, sinks.root, "again", events[:3], 0)

    def dies(*args):
        whole(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(stream, "replace_partitions", dies)
    with pytest.raises(Exception, match="lost"):
        ingest(spark, sinks, job)
    monkeypatch.undo()
    ingest(spark, sinks, job)
    sinks.rewrite()
    expected = COLLECTION_DAILY.build(history(COLLECTION_RESULT, events + other + events[:3]))
    assert plain(sinks.preagg_rows(COLLECTION_DAILY)) == plain(expected)


def test_late_calls_reach_their_minute(spark, messages):
    root = scratch_dir(spark, "late")
    calls = [change(None, 1, "c", uniqueid=str(i), calldate=DAY1 + i * DAY_MS) for i in range(3)]
    late = change(None, 1, "c", uniqueid="late", calldate=DAY1)
    for part, events in enumerate([calls, [late], [late]]):
        deliver(messages, root, f"p{part}", events, 0)
        source = src_changes(spark, CDR, {"format": "json", "path": f"{root}/inbox/*"})
        typed = ingest_project(decode_json_rows(source, CDR), CDR)
        stream.stream_minutes(typed, root).awaitTermination()
    totals = [r.total_calls for r in stream.minute_rows(spark, root).orderBy("minute").collect()]
    assert totals == [3, 1, 1]


def spoil(path, month):
    """Rubbish in place of a month's files: a query that opens them fails."""
    files = list(Path(f"{path.removeprefix('file:')}/_month={month}").rglob("*.parquet"))
    assert files
    for file in files:
        file.write_bytes(b"rubbish")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


# -- month ends ------------------------------------------------------------------


def test_month_ends(spark, history, messages):
    """As-of reads start from the month end before the day, take the months since and late
    batches, and open no other folder."""
    sinks = stream.open_sinks(spark, CUSTOMER_ID, scratch_dir(spark, "ends"))
    month_ms = 31 * DAY_MS
    events = [change(k % 5, m * month_ms + k, "d" if k == 3 else "u", callStatus=f"{m}-{k}") for m in range(6) for k in range(9)]
    sinks.write_load(history(CUSTOMER_ID, events), "all")
    deliver(messages, sinks.root, "none", [], 0)
    ingest(spark, sinks)
    stored = sinks.history
    days = [dt.date.fromtimestamp((DAY1 + m * month_ms + d * DAY_MS) // 1000) for m in range(6) for d in (0, 20)]
    expected = {d: plain(asof_state(history(CUSTOMER_ID, events), CUSTOMER_ID, d)) for d in days}

    def found():
        return {d: plain(asof_state(stored.versions_asof(d), CUSTOMER_ID, d)) for d in days}

    months = sorted({int(d.strftime("%Y%m")) for d in days})
    assert found() == expected
    stored.keep_month_end(months[1])
    assert found() == expected
    stored.keep_month_end(months[3])  # from the one before
    assert found() == expected

    # Versions that arrive late, for a month before the month ends, in a batch of their own.
    late = [change(1, month_ms + 100, callStatus="late"), change(77, 5, "c", callStatus="late key")]
    deliver(messages, sinks.root, "late", late, 0)
    ingest(spark, sinks)
    expected = {d: plain(asof_state(history(CUSTOMER_ID, events + late), CUSTOMER_ID, d)) for d in days}
    assert found() == expected
    stored.keep_month_end(months[3])
    stored.keep_month_end(months[1])
    assert found() == expected

    # Folders that must not be opened hold rubbish.
    for month in months[:4]:
        spoil(stored.path, month)
    last = [d for d in days if int(d.strftime("%Y%m")) > months[3]]
    assert {d: plain(asof_state(stored.versions_asof(d), CUSTOMER_ID, d)) for d in last} == {d: expected[d] for d in last}
    assert tt.queue_asof(stored.versions_asof(last[-1]), last[-1]).count() == len(expected[last[-1]])
    with pytest.raises(Exception):
        stored.rows().select("id").collect()


def test_call_without_time_is_kept(history, messages):
    events = [change(None, 1, "c", uniqueid="x", calldate=None), change(None, 1, "c", uniqueid=None, calldate=DAY1)]
    good, bad = route_bad_records(messages(events), CDR)
    assert (good.count(), bad.count()) == (1, 1)
    row = scan_state(history(CDR, events), CDR).first()
    assert (row.uniqueid, row.calldate) == ("x", dt.datetime(1970, 1, 1))


def test_bad_messages_keep_their_context(spark, messages):
    sinks = stream.open_sinks(spark, CDR, scratch_dir(spark, "bad"))
    events = [change(None, 1, "c", uniqueid="x", calldate=DAY1), "{broken"]
    placed = messages(events).selectExpr("*", "'cdc.cdr' AS topic", "3 AS partition", "seq + 40 AS offset", f"timestamp_millis({DAY1} + seq) AS time")
    placed.coalesce(1).write.json(f"{sinks.root}/inbox/a")
    ingest(spark, sinks)
    ingest(spark, sinks, lambda source, opened: stream.stream_preagg(source, opened, PREAGGS["agg_cdr_minutely"]))
    assert [r.total_calls for r in sinks.preagg_rows(PREAGGS["agg_cdr_minutely"]).collect()] == [1]
    found = sinks.quarantine().select("value", "reason", "topic", "partition", "offset", F.unix_millis("time").alias("ms"))
    assert rows(found) == [("{broken", "malformed", "cdc.cdr", 3, 41, DAY1 + 1)]
    # Sources that do not tell leave it NULL.
    bare = route_bad_records(messages(["{broken"]), CDR).bad.first()
    assert (bare.value, bare.topic, bare.partition, bare.offset, bare.time) == ("{broken", None, None, None, None)


def test_order_survives_new_partitions(spark, history):
    """A key that moves to a new partition starts there with small offsets; with equal times
    its later version still wins."""
    def at(partition, offset, status, ts=5):
        payload = json.dumps(change(1, ts, callStatus=status))
        return payload, "cdc.customer", partition, offset, dt.datetime(2024, 1, 1)

    schema = "value string, topic string, partition int, offset long, time timestamp"
    arrived = [at(0, 900, "before"), at(2, 0, "after"), at(2, 1, "last"), at(0, 5000, "older", ts=4)]
    moved = [{0: 1000, 1: 700, 2: 0}]

    def newest(starts, placed=arrived):
        numbered_ = numbered(spark.createDataFrame(placed, schema), starts)
        return scan_state(ingest_project(decode_json_rows(numbered_, CUSTOMER_ID), CUSTOMER_ID), CUSTOMER_ID).first().call_status

    assert newest(moved) == "last"
    # back to the first partition with the next change of the topic
    again = [*arrived, at(0, 2000, "home")]
    assert newest([*moved, {0: 1500, 1: 1500, 2: 2, 3: 0}], again) == "home"
    largest = numbered(spark.createDataFrame([at(8191, (1 << 43) - 1, "x")], schema), [{8191: 0}] * 127).first().seq
    assert largest == (1 << 63) - 1
    for bad in (at(8192, 0, "x"), at(0, 1 << 43, "x"), at(None, 0, "x")):
        with pytest.raises(Exception, match="out of range"):
            numbered(spark.createDataFrame([bad], schema)).collect()


def test_hot_call_id(spark, history):
    """A third of all results belong to no call; no job runs before the query itself."""
    calls = history(CDR, [change(None, 1, "c", uniqueid=c, calldate=DAY1) for c in ("", "a", "b")])
    results = history(COLLECTION_RESULT, [result(i, 1, "c", "" if i % 3 else "a", classification="R") for i in range(60)])
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup(None)
    joined = views.v_cdr(calls, results)
    assert set(tracker.getJobIdsForGroup(None)) == set(before)
    found = joined.groupBy("uniqueid").count()
    assert dict(rows(found)) == {"": 40, "a": 20, "b": 1}


def test_other_time_zone(spark, history):
    df = history(CUSTOMER_ID, [change(1, 86_398_000, "c", callStatus="A")]).cache()
    df.count()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        from changeflow.functions.scalars import asof_cut
        from changeflow.operators.state import before_cut
        from changeflow.sources.decode import with_month

        assert asof_cut("2024-01-20") == 1705795199000
        assert before_cut(df, DAY_TEXT).count() == 1
        assert with_month(df).first()._month == int(DAY_TEXT[:7].replace("-", ""))
        for call in (
            lambda: scan_state(df, CUSTOMER_ID), lambda: dist.disposition_share(df, "2024-01-01 00:00:00"),
            lambda: COLLECTION_DAILY.build(df), lambda: stream.tumbling_minute(df),
        ):
            with pytest.raises(ValueError, match="time zone"):
                call()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df.unpersist()


def test_back_fill_by_column_name(spark, tmp_path):
    def read(text, **options):
        file = tmp_path / f"{len(list(tmp_path.iterdir()))}.csv"
        file.write_text(text)
        return backfill_csv(spark, AGENT_LOGIN_STATUS, str(file), **options)

    good, bad = read('state,marked_by,login_time\n1,ina,5\n"two\nlines",ben,7\n3,cho,noon\n')
    found = {r.marked_by: (r.state, r.login_time, r._op, r._ts_ms) for r in good.collect()}
    assert found == {"ina": ("1", 5, "r", 0), "ben": ("two\nlines", 7, "r", 0)}
    assert [r.value for r in bad.collect()] == ["3,cho,noon"]
    assert bad.columns == ["value", "seq", "reason"]
    with pytest.raises(ValueError, match="no columns"):
        read("marked_by,colour\nina,red\n")
    with pytest.raises(ValueError, match="key columns"):
        read("state\n1\n")


def test_history_is_pruned_by_month(spark, messages):
    sinks = stream.open_sinks(spark, CUSTOMER_ID, scratch_dir(spark, "pruned"))
    deliver(messages, sinks.root, "a", [change(1, 0), change(2, 90 * DAY_MS)], 0)
    ingest(spark, sinks)
    seen = asof_state(sinks.history.rows(), CUSTOMER_ID, DAY_TEXT)
    assert [r.id for r in seen.collect()] == [1]
    later = dt.datetime.fromtimestamp(DAY1 / 1000, dt.timezone.utc) + dt.timedelta(days=90)
    spoil(sinks.history.path, int(later.strftime("%Y%m")))
    again = asof_state(sinks.history.rows(), CUSTOMER_ID, DAY_TEXT)
    assert [r.id for r in again.collect()] == [1]
    with pytest.raises(Exception):
        sinks.history.rows().select("id").collect()


def test_filters_reach_the_files(spark, messages):
    from seed import AS_OF, EVENTS

    sinks = stream.open_sinks(spark, CDR, scratch_dir(spark, "push"))
    deliver(messages, sinks.root, "a", EVENTS["cdr"], 0)
    ingest(spark, sinks)
    share = dist.disposition_share(sinks.history.rows(), AS_OF)
    plan = share._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(calldate,2025-02-08 00:00:00" in plan
    assert "billsec" not in plan and "WindowGroupLimit" in plan


def test_partial_sum_has_all_sums(spark, tmp_path):
    """Every sum that the aggregate keeps, as the aggregate's own query has them."""
    import __spark_entry__ as registered
    from changeflow.operators.preagg import AGENT_DAILY

    lines = "1L AS l_orderkey, 2L AS l_partkey, 3L AS l_suppkey, 1 AS l_linenumber, 10.0D AS l_quantity, 500.0D AS l_extendedprice"
    row = spark.sql(f"SELECT {lines}, 'R' AS l_returnflag, 'F' AS l_linestatus, timestamp_ntz'1995-03-04 00:00:00' AS l_shipdate")
    row.write.parquet(f"{tmp_path}/lineitem.parquet")
    found = registered.queries()["partial_sum"](spark, str(tmp_path))
    assert found.columns == AGENT_DAILY.schema().names
    assert rows(found.select("tasks_assigned", "calls_made", "calls_answered", "ptp_achieved", "talk_time_seconds", "ptp_amount")) == [(10, 9, 5, 2, 5, 0.0)]


def _little(spark, folder, names):
    for name in names:
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(300).write.parquet(f"{folder}/{name}.parquet")


def test_stored_queries_do_no_work_that_they_do_not_read(spark, tmp_path, monkeypatch):
    """One load a table for all its jobs; month ends for as-of queries alone."""
    import __spark_entry__ as registered
    from changeflow.sources.history import History
    from changeflow.specs import SPECS
    from changeflow.streaming.ingest import Sinks

    _little(spark, tmp_path, ["events", "orders", "lineitem"])
    loads, ends = [], []
    write, keep = Sinks.write_load, History.keep_month_end
    monkeypatch.setattr(Sinks, "write_load", lambda s, rows, name: (loads.append(s.spec.name), write(s, rows, name)))
    monkeypatch.setattr(History, "keep_month_end", lambda h, month: (ends.append(month), keep(h, month)))
    queries = registered.queries()
    queries["stored_collection_funnel"](spark, str(tmp_path)).collect()
    counted = dict(rows(queries["stored_row_counts"](spark, str(tmp_path))))
    assert counted["cdr_history"] == counted["collections_history"] == 300 and len(counted) == 20
    assert sorted(loads) == sorted(SPECS) and ends == []
    for _ in range(2):
        queries["asof_state_customer_id"](spark, str(tmp_path)).collect()
    assert len(ends) == 2 and len(loads) == len(SPECS)


def _shuffled(spark):
    """Bytes of shuffle files that the session has."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))


def _settles(found, most, seconds=10):
    """Files go a moment after what asks for it."""
    until = time.time() + seconds
    while (last := found()) > most and time.time() < until:
        time.sleep(0.2)
    return last


def test_stored_row_counts_leaves_only_what_it_stores(spark, tmp_path, monkeypatch):
    """Loads, shuffle files and executors' copies of stores are gone when the jobs are over."""
    import __spark_entry__ as registered
    from changeflow.streaming.ingest import Sinks

    _little(spark, tmp_path, ["events", "orders", "lineitem"])
    opened = []
    write = Sinks.write_load
    monkeypatch.setattr(Sinks, "write_load", lambda s, rows, name: (opened.append(s), write(s, rows, name)))
    local = Path(spark._jvm.org.apache.spark.util.Utils.getLocalDir(spark.sparkContext._jsc.sc().conf()))
    before, stores = _shuffled(spark), len(list(local.glob("StateStoreId*")))
    found = registered.queries()["stored_row_counts"](spark, str(tmp_path))
    assert len(opened) == len(SPECS) and not any(list(Path(s.loads_path).iterdir()) for s in opened)
    assert _settles(lambda: _shuffled(spark) - before, 0) <= 0
    assert _settles(lambda: len(list(local.glob("StateStoreId*"))) - stores, 0) <= 0
    counted = dict(rows(found))
    assert counted["cdr_history"] == counted["collections_state"] == 300 and len(counted) == 20


def test_large_loads_are_taken_in_two_batches(spark, messages, history, monkeypatch):
    """By the jobs that shuffle whole rows; with the same rows in the end."""
    sinks = stream.open_sinks(spark, CDR, scratch_dir(spark, "halves"))
    events = [
        {"uniqueid": f"c{k % 7}", "calldate": DAY1 + k % 7, "billsec": k, "kodeCabang": "x", "__op": "u", "__ts_ms": DAY1 + k, "__deleted": "false"}
        for k in range(40)
    ]
    expected = history(CDR, events)
    sinks.write_load(expected.repartition(8), "large")
    deliver(messages, sinks.root, "none", [], 0)
    monkeypatch.setattr(stream, "LOAD_BATCH", 1)
    for query in stream.stream_table(inbox(spark, sinks), sinks):
        query.awaitTermination()
    assert [r[0] for r in sinks.history.rows().select("_batch").distinct().orderBy("_batch").collect()] == [0, 1]
    assert plain(sinks.history.rows().select(*expected.columns)) == plain(expected)
    assert plain(sinks.current_rows()) == plain(scan_state(expected, CDR))
    for preagg in preaggs_of(CDR):
        assert plain(sinks.preagg_rows(preagg)) == plain(preagg.build(expected))
    counts = [len(list(Path(sinks.checkpoint(job), "commits").glob("[0-9]*"))) for job in ("state", *(p.name for p in preaggs_of(CDR)))]
    assert counts == [2, 1, 1]


def test_month_ends_are_shuffled_by_key_alone(spark, history, monkeypatch, tmp_path):
    from changeflow.sources.history import History
    from changeflow.specs import CUSTOMER_ID

    hints = []
    kind = type(spark.range(1))
    hint = kind.hint
    monkeypatch.setattr(kind, "hint", lambda df, name, *a: (hints.append(a), hint(df, name, *a))[1])
    table = History(spark, CUSTOMER_ID, str(tmp_path))
    table.append(history(CUSTOMER_ID, []), "run", 0)
    assert hints == [("_month", "_run", "_batch")]
    table.keep_month_end(202401)
    # what it covers, a row for each run, is all that is spread
    assert hints[1:] == [("_month",)]
