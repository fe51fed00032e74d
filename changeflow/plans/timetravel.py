"""The queue as of a past day, audit trails, counts, live status."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sets import union_counts
from ..operators.state import alive_counts, arg_max, asof_state, before_cut, lookup_state
from ..specs import CDR, CUSTOMER_ID, SPECS
from .views import v_agent_login_status, v_customer_queue

# Fixed values (column names): what makes two versions of a queue entry different in "versions" mode.
QUEUE_ATTRIBUTES = [
    "id",
    "no_kontrak",
    "customer_name",
    "phone_number",
    "call_status",
    "priority",
    "overdue",
    "out_std_pkk",
    "is_paid",
    "payment_date",
    "marked_by",
    "kode_cabang",
]


def queue_asof(
    queue: DataFrame, day: dt.date | str, mode: str = "latest", limit: int | None = None
) -> DataFrame:
    """The call queue at the end of ``day``, by priority, then most overdue.

    ``latest``: one row per queue entry.  ``versions``: one row per distinct set
    of attribute values an entry has had by then, hidden if its newest
    occurrence is a delete.
    """
    if mode == "latest":
        rows = asof_state(queue, CUSTOMER_ID, day)
    elif mode == "versions":
        # Grouped by all attributes, only the delete marker differs in a group.
        rows = arg_max(before_cut(queue, day), QUEUE_ATTRIBUTES, "_is_deleted").where(
            F.col("final__is_deleted") == 0
        )
    else:
        raise ValueError(f"mode must be 'latest' or 'versions', not {mode!r}")
    ordered = rows.orderBy(
        "priority", F.desc("overdue"), "id", *[c for c in QUEUE_ATTRIBUTES if c != "id"]
    )
    if limit is not None:
        ordered = ordered.limit(limit)
    return ordered.select(
        "no_kontrak",
        "customer_name",
        "phone_number",
        "call_status",
        "priority",
        "overdue",
        "out_std_pkk",
        "is_paid",
        F.col("marked_by").alias("current_agent"),
    )


def audit_trail(queue: DataFrame, contract: str) -> DataFrame:
    """All changes of one contract in time order."""
    return (
        queue.where(F.col("no_kontrak") == contract)
        .orderBy("_ts_ms", "_seq")
        .select("_ts_ms", "_op", "call_status", "overdue", "is_paid", "marked_by")
    )


def latest_versions(calls: DataFrame, contract: str, limit: int = 5) -> DataFrame:
    """The newest current calls of one contract."""
    found = lookup_state(calls, CDR, F.col("contract_no") == contract)
    return (
        found.orderBy(F.desc("_version"), "uniqueid", "calldate")
        .limit(limit)
        .select("uniqueid", "calldate", "disposition", "billsec", "_version")
    )


def state_row_counts(histories: dict[str, DataFrame]) -> DataFrame:
    """Current rows per table."""
    return alive_counts(histories, SPECS)


def history_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Stored rows per table, all versions."""
    return union_counts(tables)


def version_counts(history: DataFrame) -> DataFrame:
    """Versions per call and whether it is still there: deleted rows leave the state and
    keep their versions in the history."""
    versions = history.groupBy(*CDR.key).agg(
        F.count(F.lit(1)).alias("versions"),
        F.max_by("_is_deleted", F.struct("_ts_ms", "_seq")).alias("gone"),
    )
    return versions.select(*CDR.key, "versions", (F.col("gone") == 0).alias("in_state"))


def agent_status_now(agents: DataFrame) -> DataFrame:
    """Agents that are online ('1') or on a break ('2')."""
    return (
        v_agent_login_status(agents)
        .where(F.col("status").isin("1", "2"))
        .select("agent_id", "status", "login_date")
        .orderBy("agent_id")
    )


def queue_status_now(queue: DataFrame) -> DataFrame:
    """Entries in the queue, in a call and done, per branch."""
    return (
        v_customer_queue(queue)
        .where(F.col("status").isin("IN_QUEUE", "CALLING", "DONE"))
        .groupBy("branch_code")
        .agg(
            F.count(F.lit(1)).alias("total_in_queue"),
            F.count_if(F.col("status") == "CALLING").alias("currently_calling"),
            F.count_if(F.col("status") == "DONE").alias("completed"),
        )
        .select("total_in_queue", "currently_calling", "completed", "branch_code")
    )


def result_json_lines(result: DataFrame) -> DataFrame:
    """A query result as one JSON object per row, NULLs included."""
    return result.select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    )
