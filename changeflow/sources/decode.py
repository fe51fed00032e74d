"""From change messages to history rows: decode, check, project."""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import month_key
from ..specs import SEQ_WIRE, TableSpec

CORRUPT = "_corrupt_record"
PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


#: Where a message came from; NULL where its source does not tell.
CONTEXT = (
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("time", T.TimestampType()),
)
QUARANTINE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("reason", T.StringType()),
        *CONTEXT,
    ]
)


class Routed(NamedTuple):
    good: DataFrame  # flat change rows
    bad: DataFrame  # the columns of QUARANTINE


def drop_tombstones(messages: DataFrame) -> DataFrame:
    """A delete is followed by a message without value; it carries no news."""
    return messages.where(F.col("value").isNotNull())


def _parse(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds one column per JSON field, parsing each message exactly once.

    Parsing inside a generator keeps the optimizer from copying ``from_json``
    into every filter and projection that uses a field.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", with_corrupt, PARSE_OPTIONS)
    return messages.select("value", "seq", _context(messages), F.inline_outer(F.array(parsed)))


def _context(messages: DataFrame) -> Column:
    """One struct, so that no field of the payload can clash with it."""
    present = set(messages.columns)
    cells = ((F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in CONTEXT)
    return F.struct(*cells).alias("_message")


def _reason(spec: TableSpec) -> Column:
    unusable = reduce(or_, (F.col(n).isNull() for n in (*spec.needed_key, "__ts_ms")))
    return F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed")).when(
        unusable, F.lit("no key or version")
    )


def checked_rows(messages: DataFrame, spec: TableSpec) -> DataFrame:
    """``value, seq, _message``, the wire columns, and ``reason`` (NULL: a good message)."""
    parsed = _parse(drop_tombstones(messages), spec.wire_schema())
    return parsed.withColumn("reason", _reason(spec)).drop(CORRUPT)


def good_rows(checked: DataFrame, spec: TableSpec) -> DataFrame:
    good = checked.where(F.col("reason").isNull())
    return good.select(*spec.wire_schema().names, F.col("seq").alias(SEQ_WIRE))


def bad_rows(checked: DataFrame) -> DataFrame:
    """Text and context of bad messages, with the reason."""
    return checked.where(F.col("reason").isNotNull()).select("value", "seq", "reason", "_message.*")


def route_bad_records(messages: DataFrame, spec: TableSpec) -> Routed:
    """Split messages into decodable change rows and quarantined raw text."""
    checked = checked_rows(messages, spec)
    return Routed(good_rows(checked, spec), bad_rows(checked))


def decode_json_rows(messages: DataFrame, spec: TableSpec) -> DataFrame:
    """One JSON object per message -> typed columns; unknown fields are ignored."""
    return route_bad_records(messages, spec).good


def checked_envelopes(messages: DataFrame, spec: TableSpec) -> DataFrame:
    """``checked_rows`` of full change envelopes ``{before, after, op, ts_ms, source: {ts_ms}}``:
    the new row image, or for a delete the old one, typed as it is parsed."""
    payload = spec.payload_schema()
    envelope = T.StructType(
        [
            T.StructField("before", payload),
            T.StructField("after", payload),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
            T.StructField("source", T.StructType([T.StructField("ts_ms", T.LongType())])),
        ]
    )
    with_corrupt = T.StructType([*envelope.fields, T.StructField(CORRUPT, T.StringType())])

    def flat(e: Column) -> Column:
        deleted = e["op"] == "d"
        image = F.when(deleted, e["before"]).otherwise(e["after"])
        return F.struct(
            *(image[f.wire].alias(f.wire) for f in spec.fields),
            e["op"].alias("__op"),
            e["ts_ms"].alias("__ts_ms"),
            e["source"]["ts_ms"].alias("__source_ts_ms"),
            F.when(deleted, F.lit("true")).otherwise(F.lit("false")).alias("__deleted"),
            e[CORRUPT].alias(CORRUPT),
        )

    # One generator from text to typed row: nothing is parsed twice or printed in between.
    rows = F.transform(F.array(F.from_json("value", with_corrupt, PARSE_OPTIONS)), flat)
    parsed = drop_tombstones(messages)
    parsed = parsed.select("value", "seq", _context(parsed), F.inline_outer(rows))
    unreadable = F.col(CORRUPT).isNull() & F.col("__op").isNull()
    reason = F.when(unreadable, F.lit("no operation")).otherwise(_reason(spec))
    return parsed.withColumn("reason", reason).drop(CORRUPT)


def route_envelopes(messages: DataFrame, spec: TableSpec) -> Routed:
    """Split envelopes into change rows and quarantined raw text."""
    checked = checked_envelopes(messages, spec)
    return Routed(good_rows(checked, spec), bad_rows(checked))


def delete_flag(deleted: str) -> str:
    """SQL: 'true' -> 1, anything else -> 0."""
    return f"CASE WHEN {deleted} = 'true' THEN 1 ELSE 0 END"


def ingest_project(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Flat change rows -> history rows: renamed, typed, NULLs replaced.

    Wire columns that ``changes`` lacks count as NULL.  The state is derived from
    the same rows, so this one projection serves history and state.
    """
    present = set(changes.columns)

    def meta(name: str, kind: str) -> str:
        return name if name in present else f"cast(NULL AS {kind})"

    stored = (
        f"{f.kind.stored_expr(f.wire if f.wire in present else None)} AS {f.stored}"
        for f in spec.stored_fields
    )
    return changes.selectExpr(
        *stored,
        f"coalesce({meta('__op', 'string')}, '') AS _op",
        f"{meta('__ts_ms', 'bigint')} AS _ts_ms",
        f"coalesce({meta('__source_ts_ms', 'bigint')}, 0L) AS _source_ts_ms",
        f"{delete_flag(meta('__deleted', 'string'))} AS _is_deleted",
        f"coalesce({meta(SEQ_WIRE, 'bigint')}, 0L) AS _seq",
    )


def version_col() -> Column:
    """The version of a state row is the time its change was processed."""
    return F.col("_ts_ms").alias("_version")


def with_month(history: DataFrame) -> DataFrame:
    """Adds the storage partition ``_month`` (yyyyMM of the change time, in UTC)."""
    return history.withColumn("_month", month_key(F.col("_ts_ms")))
