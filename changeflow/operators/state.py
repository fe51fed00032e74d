"""From history to current state and to the state of a past day.

Functions that need the current state take a history (all versions, with
``_ts_ms``) or stored state rows (one per key, with ``_version``), which pass
through unchanged.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import asof_cut, month_key
from ..session import require_utc
from ..specs import TableSpec
from .sets import union_all


def latest_per_key(history: DataFrame, spec: TableSpec) -> DataFrame:
    """The newest version of every key, deletes included.

    Of two versions with the same time, the one that arrived last wins.
    Every map task keeps one row per key before the shuffle (the rank limit is
    applied on both sides of it), so a key with very many versions does not
    overload a task.  Unlike ``max_by(struct(*))`` it leaves column pruning to
    Catalyst, and a filter on key columns is pushed below it.  Filters on other
    columns must come after it: before it they would revive old versions.
    """
    require_utc(history.sparkSession)
    if "_version" in history.columns:
        return history
    newest = Window.partitionBy(*spec.key).orderBy(F.desc("_ts_ms"), F.desc("_seq"))
    return (
        history.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def upsert_state(history: DataFrame, spec: TableSpec) -> DataFrame:
    """State rows as stored: one per key with version and delete marker."""
    rows = latest_per_key(history, spec)
    version = "_version" if "_version" in rows.columns else "_ts_ms AS _version"
    return rows.selectExpr(*spec.columns, version, "_is_deleted")


def scan_state(history: DataFrame, spec: TableSpec) -> DataFrame:
    """Current rows: the newest version per key unless that is a delete."""
    return upsert_state(history, spec).where(F.col("_is_deleted") == 0)


def lookup_state(history: DataFrame, spec: TableSpec, where: Column) -> DataFrame:
    """``scan_state`` filtered by a selective condition on any column.

    A current row that matches has a version that matches, so only keys with a matching version
    need to be folded.  Finding them reads the key and the condition's columns; where
    the keys turn out few, adaptive execution sends them to the scan, and else Spark
    may filter it by a Bloom filter of them (``spark.sql.optimizer.runtime.bloomFilter``).
    """
    if "_version" in history.columns:
        return scan_state(history, spec).where(where)
    keys = history.where(where & (F.col("_is_deleted") == 0)).select(*spec.key).distinct()
    return scan_state(history.join(keys, list(spec.key), "left_semi"), spec).where(where)


#: Digits of an arrival number.
_SEQ_RANGE = Decimal(10**19)


def alive_counts(histories: dict[str, DataFrame], specs: dict[str, TableSpec]) -> DataFrame:
    """Current rows per table: ``t, n``.

    Time, arrival and delete marker of a version are one number, so the greatest of each key
    is a hash aggregate with a map side, and nothing is sorted or ranked.
    """
    def counted(name: str, rows: DataFrame) -> DataFrame:
        time, seq = ("_version", F.lit(0)) if "_version" in rows.columns else ("_ts_ms", F.col("_seq"))
        wide = T.DecimalType(38, 0)
        place = F.col(time).cast("decimal(18,0)").cast(wide) * F.lit(_SEQ_RANGE) + seq.cast("decimal(19,0)")
        last = F.max((place * F.lit(2) + F.col("_is_deleted")).cast(wide)).alias("last")
        newest = rows.groupBy(*specs[name].key).agg(last)
        return newest.agg(F.count_if(F.col("last") % 2 == 0).alias("n")).select(F.lit(name).alias("t"), "n")

    return union_all([counted(name, rows) for name, rows in histories.items()])


def before_cut(history: DataFrame, day: dt.date | str) -> DataFrame:
    """Versions an as-of query of ``day`` may see.

    Stored history also gets the partition predicate, which a filter on the
    change time alone would not give.
    """
    cut = F.lit(asof_cut(day))
    seen = history.where(F.col("_ts_ms") <= cut)
    if "_month" in history.columns:
        seen = seen.where(F.col("_month") <= month_key(cut))
    return seen


def age_at_cut(history: DataFrame, day: dt.date | str) -> DataFrame:
    """How old each version was at the end of ``day``; later ones are left out."""
    age = F.lit(asof_cut(day)) - F.col("_ts_ms")
    return before_cut(history, day).select("id", "_ts_ms", age.alias("age_ms"))


def asof_state(history: DataFrame, spec: TableSpec, day: dt.date | str) -> DataFrame:
    """State of a table at the end of ``day``; keys deleted by then are hidden."""
    return scan_state(before_cut(history, day), spec)


def arg_max(group: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Per group the value of ``column`` in the newest version."""
    newest = F.max_by(F.col(column), F.struct("_ts_ms", "_seq"))
    return group.groupBy(*keys).agg(newest.alias(f"final_{column}"))
