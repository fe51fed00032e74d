"""Unions and totals over small aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import rate_pct


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def union_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("t"), "n")
            for name, df in tables.items()
        ]
    )


def total(col: Column | str) -> Column:
    """Total over all rows of an aggregate, repeated on each of them."""
    return F.sum(col).over(Window.partitionBy())


def per_contract(tasks: DataFrame) -> DataFrame:
    """Tasks per status, and in percent of the number of contracts: a share whose
    denominator is a scalar over the same rows.

    The rows are read once: each contract is counted at one of its statuses, and the
    total is taken over the few finished rows.
    """
    pairs = tasks.groupBy("status", "no_kontrak").agg(F.count(F.lit(1)).alias("n"))
    first = F.row_number().over(Window.partitionBy("no_kontrak").orderBy("status")) == 1
    by_status = (
        pairs.withColumn("first", first).groupBy("status")
        .agg(F.sum("n").alias("n"), F.count_if(F.col("first")).alias("contracts"))
    )
    return by_status.select("status", "n", rate_pct(F.col("n"), total("contracts")).alias("per_contract"))
