"""Distributions over the current state: durations, shares, aging, results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    AsOf,
    aging_rank,
    finite_or,
    millions,
    rate_pct,
    recent,
    round_half_up,
    since_day,
)
from ..operators.quantiles import quantiles_exact
from ..operators.sets import total
from ..operators.state import scan_state
from ..specs import CDR, COLLECTION_RESULT
from .views import v_collection_task

LEVELS = (0.5, 0.75, 0.9, 0.95, 0.99)


def answered_calls(calls: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Answered calls of the last 30 days."""
    return scan_state(calls, CDR).where(
        (F.col("disposition") == "ANSWERED") & since_day("calldate", as_of, 30)
    )


def talk_quantiles(calls: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Talk time: exact quantiles, mean, longest, shortest."""
    return quantiles_exact(answered_calls(calls, as_of), "billsec", LEVELS).select(
        F.lit("talk_duration").alias("metric"),
        "quantiles",
        round_half_up(F.col("mean"), 1).alias("mean_sec"),
        F.col("max").alias("max_sec"),
        F.col("min").alias("min_sec"),
    )


def disposition_share(calls: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Count and share per disposition, last 30 days."""
    recent_calls = scan_state(calls, CDR).where(since_day("calldate", as_of, 30))
    counted = recent_calls.groupBy("disposition").agg(F.count(F.lit(1)).alias("total"))
    return counted.select(
        "disposition", "total", rate_pct(F.col("total"), total("total")).alias("pct")
    ).orderBy(F.desc("total"), "disposition")


def _aging(tasks: DataFrame, *extra: str) -> DataFrame:
    return (
        v_collection_task(tasks)
        .groupBy("aging_bucket", *extra)
        .agg(
            F.count(F.lit(1)).alias("kontrak_count"),
            round_half_up(F.avg("days_overdue"), 1).alias("avg_days"),
            millions(F.sum("outstanding_amount")).alias("total_outstanding_mio"),
        )
        .orderBy(aging_rank(F.col("aging_bucket")), *extra)
    )


def aging_by_branch(tasks: DataFrame) -> DataFrame:
    return _aging(tasks, "branch_code")


def aging_total(tasks: DataFrame) -> DataFrame:
    return _aging(tasks)


def ptp_by_agent(results: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Promise rate per agent, last 7 days; ``ptp_count`` counts all results."""
    recent_results = scan_state(results, COLLECTION_RESULT).where(
        recent("created_ts", as_of, 7, "DAY")
    )
    counted = recent_results.groupBy("agent_id").agg(
        F.count(F.lit(1)).alias("ptp_count"),
        F.count_if(F.col("classification") == "PTP").alias("ptp_yes"),
        F.count_if(F.col("classification") == "RPC").alias("rpc_count"),
    )
    return counted.withColumn(
        "ptp_success_pct", rate_pct(F.col("ptp_yes"), F.col("ptp_count"))
    ).orderBy(F.desc("ptp_success_pct"), "agent_id")


def results_daily(results: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Results per day and class, last 30 days."""
    day = F.to_date("created_ts")
    return (
        scan_state(results, COLLECTION_RESULT)
        .where(since_day("created_ts", as_of, 30))
        .groupBy(day.alias("date"), "classification")
        .agg(
            F.count(F.lit(1)).alias("result_count"),
            millions(F.sum("ptp_amount")).alias("ptp_amount_mio"),
        )
        .orderBy(F.desc("date"), F.desc("result_count"), "classification")
    )


def rollup_disposition(calls: DataFrame) -> DataFrame:
    """Count and talk seconds per disposition, over all current calls."""
    return (
        scan_state(calls, CDR)
        .groupBy("disposition")
        .agg(F.count(F.lit(1)).alias("cnt"), F.sum("billsec").alias("talk_sec"))
    )


def mean_talk(calls: DataFrame) -> DataFrame:
    """Mean talk time of answered calls per branch, 0 where there are none."""

    def mean_of(disposition: str) -> Column:
        mean = F.avg(F.when(F.col("disposition") == disposition, F.col("billsec")))
        return round_half_up(finite_or(mean, 0), 3)

    return calls.groupBy("kode_cabang").agg(
        mean_of("ANSWERED").alias("avg_talk"), mean_of("NONE SUCH").alias("avg_none")
    )
