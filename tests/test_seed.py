"""Queries on the seed day against results worked out by hand."""

import datetime as dt

import pytest
from conftest import rows
from seed import AS_OF, EVENTS

from changeflow.operators.preagg import AGENT_DAILY, CDR_MINUTELY, COLLECTION_DAILY
from changeflow.plans import distribution as dist
from changeflow.plans import serving as srv
from changeflow.plans import timetravel as tt
from changeflow.plans import views
from changeflow.plans.funnel import collection_funnel
from changeflow.specs import SPECS


@pytest.fixture(scope="module")
def h(spark):
    from changeflow.sources.changes import MESSAGE_SCHEMA
    from changeflow.sources.decode import decode_json_rows, ingest_project
    import json

    out = {}
    for name, events in EVENTS.items():
        values = [(json.dumps(e), i) for i, e in enumerate(events)]
        df = spark.createDataFrame(values, MESSAGE_SCHEMA)
        out[name] = ingest_project(decode_json_rows(df, SPECS[name]), SPECS[name])
    return out


def test_disposition_share(h):
    # nine calls of the last 30 days; the tenth is older
    assert rows(dist.disposition_share(h["cdr"], AS_OF)) == [
        ("ANSWERED", 5, 55.6),
        ("NO ANSWER", 2, 22.2),
        ("BUSY", 1, 11.1),
        ("FAILED", 1, 11.1),
    ]


def test_talk_quantiles(h):
    # 33, 40, 61, 95, 200: positions 2, 3, 4, 4, 4; the sum is 429
    assert rows(dist.talk_quantiles(h["cdr"], AS_OF)) == [
        ("talk_duration", [61, 95, 200, 200, 200], 85.8, 200, 33)
    ]


def test_aging(h):
    assert rows(dist.aging_total(h["collection_task"])) == [
        ("1-30", 2, 17.5, 2.0), ("31-60", 1, 31.0, 2.0), ("61-90", 2, 77.0, 1.0), ("90+", 2, 145.5, 4.0),
    ]
    assert rows(dist.aging_by_branch(h["collection_task"])) == [
        ("1-30", "north", 2, 17.5, 2.0),
        ("31-60", "south", 1, 31.0, 2.0),
        ("61-90", "north", 1, 64.0, 0.5),
        ("61-90", "south", 1, 90.0, 0.5),
        ("90+", "north", 2, 145.5, 4.0),
    ]


def test_funnel(h):
    # no task: C5, C7, C8 and the paid Q5; no call: C10, C11; no answer: C2, C4
    inputs = [h[n] for n in ("collection_task", "cdr", "collection_result", "customer_id")]
    funnel = collection_funnel(*inputs, as_of=AS_OF, labels=True)
    assert rows(funnel) == [
        (0, 4, 57.1, "Start"),
        (1, 2, 28.6, "Task Created"),
        (2, 2, 28.6, "Called"),
        (4, 3, 42.9, "PTP"),
    ]


def test_results(h):
    results = h["collection_result"]
    assert rows(dist.ptp_by_agent(results, AS_OF)) == [("ben", 1, 1, 0, 100.0), ("ina", 3, 2, 1, 66.7), ("cho", 1, 0, 0, 0.0)]
    # 120.55 + 80.45 + 999,799.00
    day = dt.date(2025, 3, 10)
    daily = [(day, "PTP", 3, 1.0), (day, "RPC", 1, 0.0), (day, "SKIP", 1, 0.0)]
    assert rows(dist.results_daily(results, AS_OF)) == daily
    assert rows(srv.collection_daily(COLLECTION_DAILY.build(results), AS_OF)) == daily


def test_productivity(h):
    part = AGENT_DAILY.build(h["user_releases"])
    found = [(r.agent_username, r.talk_minutes, r.connect_rate_pct, r.ptp_rate_pct)
             for r in srv.agent_productivity(part, AS_OF).collect()]
    assert found == [("ina", 90.5, 75.0, 37.5), ("ben", 45.0, 75.0, 66.7), ("ina", 10.0, 50.0, 25.0)]
    assert [r[1:] for r in rows(srv.productivity_daily(part, AS_OF))] == [(56, 44, 33, 15, 136.0), (10, 8, 4, 1, 10.0)]
    top = [(r.agent_username, r.avg_talk_per_call) for r in srv.top_agents(part, AS_OF).collect()]
    assert top == [("ina", 150.8), ("ben", 225.0)]


def test_live(h):
    part = CDR_MINUTELY.build(h["cdr"])
    minutes = rows(srv.live_minutes(part, AS_OF))
    assert len(minutes) == 6
    assert minutes[0] == ("2025-03-10 09:27", 2, 1, 50.0, 0.7, "north")
    assert minutes[2] == ("2025-03-10 09:13", 1, 0, 0.0, 0.0, "south")
    assert len(rows(srv.live_minutes(part, AS_OF, limit=5))) == 5
    # rates 50, 100, 0, 100, 100, 0; talk 20, 95, 0, 61, 200, 0
    assert rows(srv.live_metrics(part, AS_OF)) == [(6, 58.3, 63.0, 7)]
    assert rows(srv.live_metrics(part, "2030-01-01 00:00:00")) == [(0, 0.0, 0.0, 0)]


def test_status(h):
    assert [r.agent_id for r in tt.agent_status_now(h["agent_login_status"]).collect()] == ["ben", "ina"]
    assert sorted(rows(tt.queue_status_now(h["customer_id"]))) == [(2, 1, 0, "south"), (4, 1, 2, "north")]


def test_views(h):
    sessions = views.v_user_session(h["user_logs"]).groupBy("session_status").count()
    assert dict(rows(sessions)) == {"ACTIVE": 2, "CLOSED": 1}
    calls = views.v_cdr(h["cdr"], h["collection_result"]).collect()
    assert len(calls) == 11
    assert {r.uniqueid for r in calls if r.result_classification == "NO_RESULT"} == set("bdghij")
    login = views.v_agent_login_status(h["agent_login_status"], "2025-03-10 09:00:10").collect()
    assert {r.session_duration for r in login} == {10.0}


def test_counts(h):
    counts = dict(rows(tt.state_row_counts(h)))
    assert [counts[n] for n in SPECS] == [len(EVENTS[n]) for n in SPECS]


def test_json_lines(h):
    lines = [r.value for r in tt.result_json_lines(tt.queue_status_now(h["customer_id"])).collect()]
    assert sorted(lines) == [
        '{"total_in_queue":2,"currently_calling":1,"completed":0,"branch_code":"south"}',
        '{"total_in_queue":4,"currently_calling":1,"completed":2,"branch_code":"north"}',
    ]
