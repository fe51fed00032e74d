"""Normalised views over the current state.  Each takes table histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import AsOf, aging_bucket, as_of_ts, exact_sum, rate_pct_positive
from ..operators.state import latest_per_key, scan_state
from ..specs import (
    AGENT_LOGIN_STATUS,
    CDR,
    COLLECTION_RESULT,
    COLLECTION_TASK,
    CUSTOMER_ID,
    USER_LOGS,
    USER_RELEASES,
)

DAY_MS = 86_400_000

# The output columns of the views below are the contract of their users.


def v_agent_login_status(agents: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Agents with the seconds since they logged in."""
    login_ms = F.unix_date("login_date").cast("long") * F.lit(DAY_MS) + F.col("login_time")
    return scan_state(agents, AGENT_LOGIN_STATUS).select(
        F.col("marked_by").alias("agent_id"),
        F.col("state").alias("status"),
        "login_date",
        "login_time",
        "extension",
        "ip_address",
        ((F.unix_millis(as_of_ts(as_of)) - login_ms) / F.lit(1000.0)).alias("session_duration"),
    )


def join_calls_results(calls: DataFrame, results: DataFrame, mode: str = "literal") -> DataFrame:
    """Current calls LEFT JOIN collection results on the call id.

    ``literal`` filters deleted results after the join, so a call whose only
    result is deleted disappears; ``clean`` filters them before, so that call
    stays without result.

    Written as an inner join and the calls without partner: adaptive execution
    splits a skewed key on either side of an inner join, but only on the left of
    a left join; the ids of the second part are made distinct before they meet.
    """
    if mode not in ("literal", "clean"):
        raise ValueError(f"mode must be 'literal' or 'clean', not {mode!r}")
    newest = latest_per_key(results, COLLECTION_RESULT).select(
        F.col("unique_id").alias("result_id"),
        "call_id",
        "classification",
        F.col("ptp_amount").alias("result_amount"),
        F.col("ptp_date").alias("result_date"),
        F.col("_is_deleted").alias("result_deleted"),
    )
    live = newest.where(F.col("result_deleted") == 0)
    partners = newest if mode == "literal" else live
    current = scan_state(calls, CDR)
    met = current.join(live, F.col("uniqueid") == F.col("call_id"))
    ids = partners.select(F.col("call_id").alias("_met")).distinct()
    alone = current.join(ids, F.col("uniqueid") == F.col("_met"), "left_anti")
    missing = (F.lit(None).cast(f.dataType).alias(f.name) for f in newest.schema.fields)
    return met.unionByName(alone.select(*current.columns, *missing))


def v_cdr(calls: DataFrame, results: DataFrame, mode: str = "literal") -> DataFrame:
    return join_calls_results(calls, results, mode).select(
        "uniqueid",
        "calldate",
        F.col("src").alias("source_number"),
        F.col("dst").alias("destination_number"),
        "duration",
        F.col("billsec").alias("talk_seconds"),
        "disposition",
        "accountcode",
        "contract_no",
        "customer_no",
        "phone_number",
        F.col("username").alias("agent_username"),
        F.col("kode_cabang").alias("branch_code"),
        F.coalesce("classification", F.lit("NO_RESULT")).alias("result_classification"),
        F.coalesce("result_amount", F.lit(0.0)).alias("ptp_amount"),
        F.col("result_date").alias("ptp_date"),
    )


def v_collection_task(tasks: DataFrame) -> DataFrame:
    return scan_state(tasks, COLLECTION_TASK).select(
        "id",
        "unique_id",
        F.col("no_kontrak").alias("contract_no"),
        "customer_name",
        "phone_number",
        F.col("overdue").alias("days_overdue"),
        "overdue_amount",
        F.col("out_std_pkk").alias("outstanding_amount"),
        F.col("angsuran").alias("installment_amount"),
        "vehicle_type",
        "vehicle_plate",
        "task_type",
        "priority",
        "status",
        F.col("assigned_agent").alias("agent_username"),
        F.col("kode_cabang").alias("branch_code"),
        "created_ts",
        "updated_ts",
        aging_bucket(F.col("overdue")).alias("aging_bucket"),
    )


def v_customer_queue(queue: DataFrame) -> DataFrame:
    return scan_state(queue, CUSTOMER_ID).select(
        "id",
        F.col("no_kontrak").alias("contract_no"),
        "customer_name",
        "phone_number",
        "alt_phone",
        F.col("call_status").alias("status"),
        "priority",
        F.col("overdue").alias("days_overdue"),
        F.col("out_std_pkk").alias("outstanding_amount"),
        F.col("is_paid").alias("already_paid"),
        "payment_date",
        F.col("marked_by").alias("current_agent"),
        F.col("kode_cabang").alias("branch_code"),
        "created_ts",
        F.col("marked_ts").alias("last_update_ts"),
    )


def v_user_session(sessions: DataFrame) -> DataFrame:
    """Agent sessions; a logout at the epoch means: still logged in."""
    open_session = F.col("out_ts").isNull() | (F.unix_millis("out_ts") == 0)
    return scan_state(sessions, USER_LOGS).select(
        "id",
        F.col("username").alias("agent_username"),
        "ip_address",
        "extension",
        F.col("in_ts").alias("login_time"),
        F.col("out_ts").alias("logout_time"),
        F.col("duration").alias("session_duration_seconds"),
        F.when(open_session, F.lit("ACTIVE")).otherwise(F.lit("CLOSED")).alias("session_status"),
        F.col("kode_cabang").alias("branch_code"),
    )


def v_agent_daily_summary(releases: DataFrame) -> DataFrame:
    """Closed daily releases; the work date is the day of creation."""
    closed = scan_state(releases, USER_RELEASES).where(F.col("status") == "CLOSED")
    return closed.select(
        F.to_date("created_ts").alias("work_date"),
        F.col("username").alias("agent_username"),
        F.col("total_task").alias("tasks_assigned"),
        F.col("total_called").alias("calls_made"),
        F.col("total_answered").alias("calls_answered"),
        F.col("total_ptp").alias("ptp_achieved"),
        F.col("talk_time_sec").alias("total_talk_seconds"),
        F.col("kode_cabang").alias("branch_code"),
        rate_pct_positive(F.col("total_answered"), F.col("total_called")).alias("connect_rate_pct"),
        rate_pct_positive(F.col("total_ptp"), F.col("total_answered")).alias("ptp_closure_rate_pct"),
    )


def v_collection_result_summary(results: DataFrame) -> DataFrame:
    promised = F.when(F.col("classification") == "PTP", F.col("ptp_amount")).otherwise(F.lit(0.0))
    return (
        scan_state(results, COLLECTION_RESULT)
        .groupBy(
            F.to_date("created_ts").alias("event_date"),
            F.col("classification").alias("result_type"),
            F.col("kode_cabang").alias("branch_code"),
        )
        .agg(F.count(F.lit(1)).alias("count"), exact_sum(promised).alias("ptp_total_amount"))
        .select("event_date", "result_type", "count", "ptp_total_amount", "branch_code")
    )
