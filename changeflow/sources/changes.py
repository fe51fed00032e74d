"""Where change events come from: topics, files, snapshots, CSV back-fills.

Every reader returns one row per message with the columns ``value`` (the JSON
text, NULL for a tombstone), ``seq`` (arrival order within the source) and where it
came from: ``topic, partition, offset, time``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import SEQ_WIRE, TableSpec
from .decode import CONTEXT

MESSAGE_SCHEMA = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("seq", T.LongType())]
)


#: Messages with their context.
ARRIVAL_SCHEMA = T.StructType([*MESSAGE_SCHEMA.fields, *CONTEXT])

#: Bits of an arrival number: offset, then partition, then epoch.
_OFFSET_BITS, _PARTITION_BITS, _EPOCH_BITS = 43, 13, 7


def arrival_number(epoch: Column, partition: Column, offset: Column) -> Column:
    """One number that orders messages by epoch, partition and offset.

    A key lies in one partition for as long as the topic has the same partitions, one epoch;
    there its offsets order its events.  When partitions are added it may move to one with
    smaller offsets, but in a later epoch.  Raises where a part does not fit.
    """
    parts = [(epoch, _EPOCH_BITS, "epoch"), (partition, _PARTITION_BITS, "partition"), (offset, _OFFSET_BITS, "offset")]
    out = F.lit(0).cast("long")
    for part, bits, name in parts:
        fits = part.between(0, (1 << bits) - 1)
        whole = F.when(fits, part.cast("long")).otherwise(
            F.raise_error(F.concat(F.lit(f"{name} out of range: "), F.coalesce(part.cast("string"), F.lit("NULL")))).cast("long")
        )
        out = F.shiftleft(out, bits).bitwiseOR(whole)
    return out


def epoch_of(partition: Column, offset: Column, starts: Sequence[dict[int, int]]) -> Column:
    """The epoch of a message.  ``starts[i]`` has, for the (i + 1)th time that partitions were
    added, the first offset after it of every partition the topic then had."""
    epoch = F.lit(0)
    for number, first in enumerate(starts, start=1):
        late = F.lit(False)
        for p, o in first.items():
            late = late | ((partition == p) & (offset >= o))
        epoch = F.when(late, F.lit(number)).otherwise(epoch)
    return epoch


def with_context(messages: DataFrame) -> DataFrame:
    """``ARRIVAL_SCHEMA``; context that the messages do not have is NULL."""
    present = set(messages.columns)
    return messages.select(
        *((F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in ARRIVAL_SCHEMA.fields)
    )


def topic(spec: TableSpec, prefix: str) -> str:
    """One topic per table: ``<prefix>.<source table>``."""
    return f"{prefix}.{spec.source}"


def src_changes(spark: SparkSession, spec: TableSpec, options: dict[str, str]) -> DataFrame:
    """Stream of change messages of one table.

    ``options["format"]`` is ``kafka`` (default), or ``json`` / ``parquet`` for a
    folder of files with the columns of ``ARRIVAL_SCHEMA``; those it lacks are NULL.  ``topic_prefix``
    names the topic; all other options go to the Spark source.  The micro-batch
    size defaults to the table's block size times ``blocks_per_trigger``
    (1000): one block per trigger would spend all its time on scheduling.

    ``epoch_starts`` tells when partitions were added, as JSON for ``epoch_of``:
    ``[{"0": 120, "1": 80, "2": 0}]``.
    """
    opts = dict(options)
    fmt = opts.pop("format", "kafka")
    blocks = int(opts.pop("blocks_per_trigger", 1000))
    starts = [{int(p): int(o) for p, o in first.items()} for first in json.loads(opts.pop("epoch_starts", "[]"))]
    if fmt == "kafka":
        opts.setdefault("subscribe", topic(spec, opts.pop("topic_prefix", "cdc")))
        opts.setdefault("startingOffsets", "earliest")
        opts.setdefault("maxOffsetsPerTrigger", str(spec.block_rows * blocks))
        messages = spark.readStream.format("kafka").options(**opts).load()
        return numbered(messages.withColumnRenamed("timestamp", "time"), starts)
    path = opts.pop("path")
    return spark.readStream.schema(ARRIVAL_SCHEMA).format(fmt).options(**opts).load(path)


def numbered(messages: DataFrame, starts: Sequence[dict[int, int]] = ()) -> DataFrame:
    """``value, topic, partition, offset, time`` with ``seq``, the arrival number."""
    epoch = epoch_of(F.col("partition"), F.col("offset"), starts)
    seq = arrival_number(epoch, F.col("partition"), F.col("offset"))
    return messages.select(F.col("value").cast("string").alias("value"), seq.alias("seq"), "topic", "partition", "offset", "time")


def changes_to_messages(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Flat change rows -> messages, the inverse of ``decode_json_rows``."""
    names = [f.name for f in spec.wire_schema().fields if f.name in changes.columns]
    seq = F.col(SEQ_WIRE) if SEQ_WIRE in changes.columns else F.lit(0).cast("long")
    return changes.select(F.to_json(F.struct(*names)).alias("value"), seq.alias("seq"))


def snapshot_to_changes(rows: DataFrame, spec: TableSpec, snapshot_ts_ms: int | Column) -> DataFrame:
    """A full-table read (JDBC, Parquet) as ``op='r'`` change rows.

    ``rows`` has the source column names with SQL types; dates, timestamps and
    decimals are put in their wire encoding.  Columns that are missing stay NULL.
    """
    at = snapshot_ts_ms if isinstance(snapshot_ts_ms, Column) else F.lit(snapshot_ts_ms)
    types = dict((f.name, f.dataType) for f in rows.schema.fields)

    def encode(name: str, wire: T.DataType) -> Column:
        if name not in types:
            return F.lit(None).cast(wire).alias(name)
        col = F.col(f"`{name}`")
        if isinstance(types[name], T.DateType):
            col = F.unix_date(col)
        elif isinstance(types[name], (T.TimestampType, T.TimestampNTZType)):
            col = F.unix_millis(col.cast("timestamp"))
        return col.cast(wire).alias(name)

    seq = F.col(SEQ_WIRE) if SEQ_WIRE in types else F.lit(0).cast("long")
    return rows.select(
        *(encode(f.wire, f.kind.wire) for f in spec.fields),
        F.lit("r").alias("__op"),
        at.cast("long").alias("__ts_ms"),
        at.cast("long").alias("__source_ts_ms"),
        F.lit("false").alias("__deleted"),
        seq.alias(SEQ_WIRE),
    )


class Backfill(NamedTuple):
    good: DataFrame  # history rows
    bad: DataFrame  # value, seq, reason; a line of a file has no other context


def backfill_csv(spark: SparkSession, spec: TableSpec, path: str, multi_line: bool = True, **options: str) -> Backfill:
    """Historical rows exported as CSV, already in stored form, with a header.

    Columns are taken by name, in any order, the same in all files.  Missing metadata and
    payload columns get their stored defaults (rows without an operation count as snapshot
    rows); a missing key column or one that the table does not have is an error.  Lines
    that do not fit the types go to ``bad``.  Texts may hold line breaks; files without
    them are read in parallel parts with ``multi_line=False``.
    """
    options = {"header": "true", "emptyValue": "", "nullValue": "\\N", "multiLine": str(multi_line)} | options
    names = spark.read.options(**options).csv(path).columns
    known = {f.name: f for f in spec.history_schema().fields}
    if unknown := sorted(set(names) - set(known)):
        raise ValueError(f"{spec.name} has no columns {unknown}")
    if missing := sorted(set(spec.key) - set(names)):
        raise ValueError(f"key columns {missing} of {spec.name} are not in the file")
    broken = "_broken"
    schema = T.StructType([*(known[n] for n in names), T.StructField(broken, T.StringType())])
    rows = (
        spark.read.schema(schema)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=broken, enforceSchema="false", **options)
        .csv(path)
    )
    zeros = {
        **{f.stored: f.kind.stored_expr(None) for f in spec.stored_fields},
        "_op": "'r'",
        "_ts_ms": "0L",
        "_source_ts_ms": "0L",
        "_is_deleted": "0",
        "_seq": "0L",
    }
    good = rows.where(F.col(broken).isNull()).selectExpr(
        *(f"coalesce(`{c}`, {zero}) AS `{c}`" if c in names else f"{zero} AS `{c}`" for c, zero in zeros.items())
    )
    # Only columns that are used are parsed and so checked: both parts use all of them.
    parsed = F.to_json(F.struct(*(F.col(f"`{n}`") for n in names)))
    bad = rows.where(F.col(broken).isNotNull()).select(
        F.col(broken).alias("value"),
        F.lit(None).cast("bigint").alias("seq"),
        F.concat(F.lit("unreadable line, read as "), parsed).alias("reason"),
    )
    return Backfill(good, bad)
