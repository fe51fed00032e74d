"""Serving views and queries that merge stored pre-aggregates.

Each takes partial rows (``Preagg.build`` or the rows of its store).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    AsOf,
    finite_or,
    millions,
    minutes,
    rate_pct,
    recent,
    recent_day,
    round_half_up,
)
from ..operators.preagg import AGENT_DAILY, CDR_MINUTELY, COLLECTION_DAILY, DISPOSITION_SUMMARY


def vq_live_cdr_minute(partials: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Calls per minute and branch of the last 60 minutes, newest first."""
    merged = CDR_MINUTELY.merge(partials.where(recent("minute", as_of, 60, "MINUTE")))
    return merged.select(
        "minute",
        F.col("total_calls").alias("calls"),
        F.col("answered_calls").alias("answered"),
        rate_pct(F.col("answered_calls"), F.col("total_calls")).alias("connect_rate_pct"),
        F.col("total_billsec").alias("total_talk_sec"),
        "branch_code",
    ).orderBy(F.desc("minute"), "branch_code")


def vq_agent_productivity(partials: DataFrame) -> DataFrame:
    """Per day, agent and branch, with connect and promise rates."""
    merged = AGENT_DAILY.merge(partials)
    return merged.select(
        "work_date",
        "agent_username",
        F.col("tasks_assigned").alias("tasks"),
        F.col("calls_made").alias("calls"),
        F.col("calls_answered").alias("answered"),
        F.col("ptp_achieved").alias("ptp"),
        F.col("talk_time_seconds").alias("talk_sec"),
        "branch_code",
        rate_pct(F.col("calls_answered"), F.col("calls_made")).alias("connect_rate_pct"),
        rate_pct(F.col("ptp_achieved"), F.col("calls_answered")).alias("ptp_rate_pct"),
    ).orderBy(F.desc("work_date"), F.desc("talk_sec"), "agent_username", "branch_code")


def vq_disposition_dist(partials: DataFrame) -> DataFrame:
    merged = DISPOSITION_SUMMARY.merge(partials, measures=["count"])
    return merged.select(
        "count_date", "disposition", F.col("count").alias("total"), "branch_code"
    ).orderBy(F.desc("count_date"), F.desc("total"), "disposition", "branch_code")


def live_minutes(partials: DataFrame, as_of: AsOf = None, limit: int = 60) -> DataFrame:
    """The newest ``limit`` rows (minute and branch), the minute as text."""
    newest = (
        vq_live_cdr_minute(partials, as_of)
        .orderBy(F.desc("minute"), "branch_code")
        .limit(limit)
    )
    return newest.select(
        F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute"),
        "calls",
        "answered",
        "connect_rate_pct",
        minutes(F.col("total_talk_sec")).alias("total_talk_min"),
        "branch_code",
    )


def live_metrics(partials: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One row: rows of the last hour, unweighted mean rates, calls.

    ``current_calls`` counts minute-and-branch rows, as the dashboard does.
    The means are taken over whole tenths and whole seconds, summed as integers,
    so that they do not depend on the order of the rows.
    """
    rows = vq_live_cdr_minute(partials, as_of).select(
        "calls",
        F.round(F.col("connect_rate_pct") * 10).cast("long").alias("rate_tenths"),
        round_half_up(F.col("total_talk_sec") / F.col("calls"), 0).cast("long").alias("talk"),
    )
    counted = rows.agg(
        F.count(F.lit(1)).alias("current_calls"),
        F.sum("rate_tenths").alias("rates"),
        F.count("rate_tenths").alias("n_rates"),
        F.sum("talk").alias("talks"),
        F.count("talk").alias("n_talks"),
        F.coalesce(F.sum("calls"), F.lit(0)).alias("calls_last_hour"),
    )
    mean_rate = F.try_divide(F.col("rates"), F.col("n_rates")) / F.lit(10.0)
    mean_talk = F.try_divide(F.col("talks"), F.col("n_talks"))
    return counted.select(
        "current_calls",
        round_half_up(finite_or(mean_rate, 0), 1).alias("connect_rate_pct"),
        round_half_up(finite_or(mean_talk, 0), 0).alias("avg_talk_sec"),
        "calls_last_hour",
    )


def agent_productivity(
    partials: DataFrame, as_of: AsOf = None, limit: int | None = None
) -> DataFrame:
    """Agent-day table of the last 30 days; the API shows the first 100 rows."""
    recent_rows = vq_agent_productivity(partials.where(recent_day("work_date", as_of, 30)))
    ordered = recent_rows.orderBy(
        F.desc("work_date"), F.desc("talk_sec"), "agent_username", "branch_code"
    )
    if limit is not None:
        ordered = ordered.limit(limit)
    return ordered.select(
        "work_date",
        "agent_username",
        "tasks",
        "calls",
        "answered",
        "ptp",
        minutes(F.col("talk_sec")).alias("talk_minutes"),
        "connect_rate_pct",
        "ptp_rate_pct",
        "branch_code",
    )


def productivity_daily(partials: DataFrame, as_of: AsOf = None) -> DataFrame:
    """All agents together, per day of the last 30 days."""
    merged = AGENT_DAILY.merge(partials.where(recent_day("work_date", as_of, 30)), "work_date")
    return merged.select(
        "work_date",
        F.col("tasks_assigned").alias("total_tasks"),
        F.col("calls_made").alias("total_calls"),
        F.col("calls_answered").alias("total_answered"),
        F.col("ptp_achieved").alias("total_ptp"),
        minutes(F.col("talk_time_seconds"), 0).alias("total_talk_minutes"),
    ).orderBy(F.desc("work_date"))


def disposition_daily(partials: DataFrame, as_of: AsOf = None) -> DataFrame:
    recent_rows = partials.where(recent_day("count_date", as_of, 30))
    merged = DISPOSITION_SUMMARY.merge(recent_rows, "count_date", "disposition")
    return merged.select(
        "count_date",
        "disposition",
        F.col("count").alias("total_calls"),
        round_half_up(F.col("avg_talk_sec"), 1).alias("avg_talk_seconds"),
    ).orderBy(F.desc("count_date"), F.desc("total_calls"), "disposition")


def collection_daily(partials: DataFrame, as_of: AsOf = None) -> DataFrame:
    recent_rows = partials.where(recent_day("event_date", as_of, 30))
    merged = COLLECTION_DAILY.merge(recent_rows, "event_date", "classification")
    return merged.select(
        "event_date",
        "classification",
        F.col("count").alias("result_count"),
        millions(F.col("ptp_total_amount")).alias("ptp_amount_mio"),
    ).orderBy(F.desc("event_date"), F.desc("result_count"), "classification")


def top_agents(partials: DataFrame, as_of: AsOf = None, limit: int = 20) -> DataFrame:
    """Agents (per branch) with the longest talk time of the last 7 days."""
    recent_rows = partials.where(recent_day("work_date", as_of, 7))
    merged = AGENT_DAILY.merge(recent_rows, "agent_username", "branch_code")
    per_call = F.col("talk_time_seconds") / F.nullif(F.col("calls_made"), F.lit(0))
    return (
        merged.select(
            "agent_username",
            F.col("talk_time_seconds").alias("total_talk_sec"),
            F.col("calls_made").alias("total_calls"),
            F.col("ptp_achieved").alias("ptp_count"),
            round_half_up(per_call, 1).alias("avg_talk_per_call"),
            "branch_code",
        )
        .orderBy(F.desc("total_talk_sec"), "agent_username", "branch_code")
        .limit(limit)
    )
