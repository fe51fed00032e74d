"""The collection funnel: task, called, answered, promise, paid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import AsOf, rate_pct, recent, recent_day, stage_label
from ..operators.funnel import window_funnel
from ..operators.sets import total, union_all
from ..operators.state import lookup_state, scan_state
from ..specs import CDR, COLLECTION_RESULT, COLLECTION_TASK, CUSTOMER_ID, TableSpec

WINDOW_SECONDS = 7 * 86_400
STEPS = 5


def union_events(
    tasks: DataFrame, calls: DataFrame, results: DataFrame, queue: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """Steps 1..5 of the last 7 days as ``no_kontrak, ts, step``.

    Steps 2 and 3 come from one read of the calls: an answered call gives both.
    Calls without contract number are left out; the other steps keep ''.
    A payment counts at midnight of its day.

    A current row inside the 7 days has a version inside them, so of a stored history only keys
    with such a version are folded; the others are left out before the shuffle.  A history
    that is computed would be computed twice for that, and is folded as it is.
    """

    def current(history: DataFrame, spec: TableSpec, where: Column) -> DataFrame:
        if "_month" in history.columns:
            return lookup_state(history, spec, where)
        return scan_state(history, spec).where(where)

    def step(df: DataFrame, key: str, ts, number) -> DataFrame:
        return df.select(F.col(key).alias("no_kontrak"), ts.alias("ts"), number.alias("step"))

    created = F.col("created_ts")
    task_steps = step(
        current(tasks, COLLECTION_TASK, recent("created_ts", as_of, 7, "DAY")),
        "no_kontrak",
        created,
        F.lit(1),
    )
    call_steps = step(
        current(
            calls, CDR, recent("calldate", as_of, 7, "DAY") & (F.col("contract_no") != "")
        ),
        "contract_no",
        F.col("calldate"),
        F.explode(
            F.when(
                F.col("disposition") == "ANSWERED", F.array(F.lit(2), F.lit(3))
            ).otherwise(F.array(F.lit(2)))
        ),
    )
    promise_steps = step(
        current(
            results,
            COLLECTION_RESULT,
            (F.col("classification") == "PTP") & recent("created_ts", as_of, 7, "DAY"),
        ),
        "no_kontrak",
        created,
        F.lit(4),
    )
    paid_steps = step(
        current(
            queue, CUSTOMER_ID, (F.col("is_paid") == 1) & recent_day("payment_date", as_of, 7)
        ),
        "no_kontrak",
        F.col("payment_date").cast("timestamp"),
        F.lit(5),
    )
    return union_all([task_steps, call_steps, promise_steps, paid_steps])


def contract_levels(events: DataFrame) -> DataFrame:
    return window_funnel(events, "no_kontrak", "ts", "step", WINDOW_SECONDS, STEPS)


def collection_funnel(
    tasks: DataFrame,
    calls: DataFrame,
    results: DataFrame,
    queue: DataFrame,
    as_of: AsOf = None,
    labels: bool = False,
) -> DataFrame:
    """Contracts per highest level reached, not cumulative.

    The share is of the contracts that have step 1, which are those of level 1
    and up, so it needs no second pass over the events.
    """
    levels = contract_levels(union_events(tasks, calls, results, queue, as_of))
    counted = levels.groupBy("level").agg(F.count(F.lit(1)).alias("contracts"))
    started = total(F.when(F.col("level") >= 1, F.col("contracts")).otherwise(F.lit(0)))
    out = counted.select(
        "level", "contracts", rate_pct(F.col("contracts"), started).alias("pct_of_total")
    ).orderBy("level")
    return out.withColumn("stage", stage_label(F.col("level"))) if labels else out
