"""Ordered-step funnel inside a time window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def window_funnel(
    events: DataFrame, key: str, ts: str, step: str, window_s: int, steps: int
) -> DataFrame:
    """Per key the longest chain 1, 2, ... of steps that starts at some step 1
    and stays within ``window_s`` seconds of it.  Other steps may lie between.

    Times count in whole seconds; in one second steps run in order of their
    number.  Returns ``key, level``; level 0 means that step 1 never occurred.

    Events of a key in one second are merged first, partly before the shuffle,
    into one row with a bit per step.  So a key brings at most one row per
    second, however many events it has.

    ``start_i`` is the latest start of a chain that has reached step i so far.
    It only grows, so it is a running maximum over the key's rows in time
    order: step i extends the chain of ``start_{i-1}`` if it lies in that chain's
    window.  The running maxima share one shuffle and one sort and stream over
    the rows; no array of a key's events is built.
    """
    bit = f"CASE WHEN _step BETWEEN 1 AND {int(steps)} THEN shiftleft(1, _step - 1) ELSE 0 END"
    seconds = (
        events.select(
            F.col(key), F.unix_seconds(F.col(ts)).alias("_sec"), F.col(step).cast("int").alias("_step")
        )
        .groupBy(key, "_sec")
        .agg(F.bit_or(F.expr(bit)).alias("_steps"))
    )
    so_far = (
        Window.partitionBy(key)
        .orderBy("_sec")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def has(i: int) -> Column:
        return F.col("_steps").bitwiseAND(1 << (i - 1)) != 0

    chained = seconds.withColumn("_start1", F.max(F.when(has(1), F.col("_sec"))).over(so_far))
    for i in range(2, steps + 1):
        # The frame includes this second, in which steps run in their order.
        previous = F.col(f"_start{i - 1}")
        extends = has(i) & (F.col("_sec") <= previous + F.lit(window_s))
        chained = chained.withColumn(f"_start{i}", F.max(F.when(extends, previous)).over(so_far))

    reached = F.lit(0)
    for i in range(1, steps + 1):
        reached = F.when(F.col(f"_start{i}").isNotNull(), F.lit(i)).otherwise(reached)
    return chained.groupBy(key).agg(F.max(reached).alias("level"))
