"""Structured Streaming: change messages -> history, state, aggregates.

Each table has a job that writes history and quarantine batch by batch, one that keeps the
newest version of every key in Spark's state store, and one for each aggregate.  All take
the same arrivals, messages and bulk loads, and each has a checkpoint of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.preagg import Preagg, preaggs_of
from ..session import require_utc
from ..sources.changes import with_context
from ..sources.decode import QUARANTINE, bad_rows, checked_rows, good_rows, ingest_project
from ..sources.history import History
from ..sources.tables import (
    BATCH,
    PACKED,
    RUN,
    empty_folder,
    file_sizes,
    finished_batches,
    make_folder,
    published,
    query_id,
    replace_partitions,
    rewrite_partitions,
    rows_of,
    upto,
)
from ..specs import TableSpec

LOADED = "_loaded"
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
#: Off: else every row written is looked up once more, for a number that nothing here reads.
_TRACK_KEY = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
#: Stores are packed well, and no file is given room, 4 MB a store, before it has rows.
_SMALL_STORES = {
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: An executor's copy of a store goes when its task ends, not a minute or more after the query.
#: Every batch then fetches the store, so not for a job that keeps running.
_UNLOAD_KEY = "spark.sql.streaming.stateStore.unloadOnCommit"
#: Shuffle files go when the batch that wrote them ends, not when the driver next collects garbage.
_CLEAN_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _in_rocksdb(spark: SparkSession, trigger: dict | None):
    """State that need not fit in memory."""
    unload = "true" if trigger is None or "availableNow" in trigger else "false"
    return _started_with(spark, {_PROVIDER_KEY: STATE_PROVIDER, _TRACK_KEY: "false", _UNLOAD_KEY: unload} | _SMALL_STORES)


@contextmanager
def _started_with(spark: SparkSession, wanted: dict[str, str]):
    """A query takes the settings when it starts."""
    wanted = wanted | {_CLEAN_KEY: "true"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


#: Bytes of loads that a batch takes at once.
LOAD_BATCH = 1 << 30


def _writer(stream: DataFrame, checkpoint: str, trigger: dict | None):
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))


@dataclass(frozen=True)
class Sinks:
    """Where the events of one table go."""

    spark: SparkSession
    spec: TableSpec
    root: str

    @property
    def history(self) -> History:
        return History(self.spark, self.spec, self.root)

    @property
    def quarantine_path(self) -> str:
        return f"{self.root}/quarantine/{self.spec.name}"

    @property
    def loads_path(self) -> str:
        return f"{self.root}/loads/{self.spec.name}"

    def checkpoint(self, job: str) -> str:
        return f"{self.root}/checkpoints/{self.spec.name}/{job}"

    def quarantine(self) -> DataFrame:
        """Bad messages of finished batches."""
        schema = T.StructType([*QUARANTINE.fields, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())])
        return rows_of(self.spark, self.quarantine_path, schema).where(upto(published(self.spark, self.history.checkpoints)))

    def write_load(self, rows: DataFrame, name: str) -> None:
        """Leave history rows (a snapshot, a CSV back-fill) for all jobs of this table, which
        take them as they take messages.  A name is used once."""
        rows.select(*self.spec.history_schema().names).write.parquet(f"{self.loads_path}/{name}", compression=PACKED)

    def drop_loads(self) -> None:
        """Delete the loads.  For when all jobs of this table have taken them: one that has not would
        never see their rows."""
        empty_folder(self.spark, self.loads_path)

    def arrivals(self, messages: DataFrame, halved: bool = False) -> DataFrame:
        """Messages and, in ``_loaded``, rows of loads.

        ``halved`` is for jobs that shuffle whole rows, seven times the bytes that loads have: a
        batch takes half of what lies there if that is over ``LOAD_BATCH``, so that half of
        the shuffle files are there at a time.  In more batches than two a state store would
        be written anew more often, and its older files be kept.
        """
        reader = self.spark.readStream.schema(self.spec.history_schema())
        if halved:
            sizes = file_sizes(self.spark, self.loads_path)
            reader = reader.option("maxBytesPerTrigger", max(LOAD_BATCH, sum(sizes) // 2 + max(sizes, default=0)))
        loads = reader.parquet(f"{self.loads_path}/*")
        loaded = F.struct(*self.spec.history_schema().names)
        messages = with_context(messages)
        kind = self.spec.history_schema().simpleString()
        nothing = (F.lit(None).cast(f.dataType).alias(f.name) for f in messages.schema.fields)
        return messages.withColumn(LOADED, F.lit(None).cast(kind)).unionByName(loads.select(*nothing, loaded.alias(LOADED)))

    def versions(self, messages: DataFrame, halved: bool = False) -> DataFrame:
        """History rows of the good messages and of the loads, as a stream."""
        arrived = self.arrivals(messages, halved)
        return _versions(checked_rows(arrived.where(F.col(LOADED).isNull()), self.spec), arrived, self.spec)

    # -- stored state --------------------------------------------------------------

    def state_rows(self) -> DataFrame:
        """Newest version per key, deletes included, as Spark's state store has them after the
        last finished batch.  Views and queries take these rows in place of a history."""
        spec, checkpoint = self.spec, self.checkpoint("state")
        if finished_batches(self.spark, checkpoint) is None:
            empty = self.spark.createDataFrame([], spec.history_schema())
            return empty.selectExpr(*spec.columns, "_ts_ms AS _version", "_is_deleted")
        stored = self.spark.read.format("statestore").load(checkpoint)
        flat = stored.select("key.*", "value.max.*")
        return flat.selectExpr(*spec.columns, "_ts_ms AS _version", "_is_deleted")

    def current_rows(self) -> DataFrame:
        return self.state_rows().where(F.col("_is_deleted") == 0)

    # -- stored aggregates -----------------------------------------------------------

    def preagg_path(self, preagg: Preagg) -> str:
        return f"{self.root}/preagg/{preagg.name}"

    def preagg_rows(self, preagg: Preagg) -> DataFrame:
        """One partial row per group: ready to serve, nothing to fold."""
        rows = rows_of(self.spark, self.preagg_path(preagg), stored_schema(preagg.schema()))
        return rows.select(*preagg.schema().names)

    def rewrite(self) -> None:
        """Few sorted files per month in the aggregates, by an ordinary job."""
        for preagg in preaggs_of(self.spec):
            rewrite_partitions(self.spark, self.preagg_path(preagg), stored_schema(preagg.schema()), [PART], preagg.dim_names)


def open_sinks(spark: SparkSession, spec: TableSpec, root: str) -> Sinks:
    sinks = Sinks(spark, spec, root.rstrip("/"))
    make_folder(spark, sinks.loads_path)
    return sinks


def _versions(checked: DataFrame, arrived: DataFrame, spec: TableSpec) -> DataFrame:
    loaded = arrived.where(F.col(LOADED).isNotNull()).select(f"{LOADED}.*")
    return ingest_project(good_rows(checked, spec), spec).unionByName(loaded)


# -- the jobs of a table -----------------------------------------------------------


def stream_ingest(messages: DataFrame, sinks: Sinks, trigger: dict | None = None, job: str = "main") -> StreamingQuery:
    """History and quarantine, from one parse per batch.

    Both sinks write the batch into partitions of its run and number, replaced if it is run
    again; readers take a batch once Spark's commit log has it.  So a job that dies between
    the two leaves nothing to see, and after its restart the same rows.

    ``trigger`` defaults to taking what is there and stopping; pass
    ``{"processingTime": "10 seconds"}`` to keep running.
    """
    checkpoint = f"{sinks.history.checkpoints}/{job}"

    def write(df: DataFrame, batch: int) -> None:
        run = query_id(sinks.spark, checkpoint)
        checked = checked_rows(df.where(F.col(LOADED).isNull()), sinks.spec).persist()
        try:
            sinks.history.append(_versions(checked, df, sinks.spec), run, batch)
            bad = bad_rows(checked).withColumns({RUN: F.lit(run), BATCH: F.lit(batch).cast("long")})
            replace_partitions(bad, sinks.quarantine_path, [RUN, BATCH])
        finally:
            checked.unpersist()

    with _started_with(sinks.spark, {}):
        return _writer(sinks.arrivals(messages, halved=True), checkpoint, trigger).foreachBatch(write).start()


def stream_state(messages: DataFrame, sinks: Sinks, trigger: dict | None = None) -> StreamingQuery:
    """The newest version of every key, in keyed state of the query itself.

    The greatest of (time, arrival, row) wins, so order of arrival and repeats do not matter,
    and delete markers stay, so a late older version cannot revive a row.  Nothing is
    written but the state: ``Sinks.state_rows`` reads it.
    """
    spec = sinks.spec
    rest = [n for n in spec.history_schema().names if n not in ("_ts_ms", "_seq", *spec.key)]
    newest = sinks.versions(messages, halved=True).groupBy(*spec.key).agg(F.max(F.struct("_ts_ms", "_seq", *rest)).alias("newest"))
    with _in_rocksdb(sinks.spark, trigger):
        return _writer(newest, sinks.checkpoint("state"), trigger).outputMode("update").format("noop").start()


#: What a batch of an aggregate replaces, and readers of a time range skip.
PART = "_month"


def stored_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())])


def _start_groups(
    groups: DataFrame, dims: Sequence[str], time: str, path: str, checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    """A streaming aggregation whose table has one row per group.

    A batch brings the new totals of the groups it changed.  They take the place of the old
    ones, and the months they lie in are replaced.  A batch that is run again brings
    the same totals.  Without a watermark: a late event always reaches its group.
    """
    spark = groups.sparkSession
    month: Column = (F.year(time) * 100 + F.month(time)).cast("int")
    schema = stored_schema(groups.schema)

    def write(df: DataFrame, batch: int) -> None:
        changed = df.withColumn(PART, month).persist()
        try:
            # a row for each month touched, not for each group
            months = [r[PART] for r in changed.select(PART).distinct().collect()]
            stored = rows_of(spark, path, schema).where(F.col(PART).isin(months))
            keys = changed.select(*(F.col(d).alias(f"_new_{d}") for d in dims))
            same = [F.col(d).eqNullSafe(F.col(f"_new_{d}")) for d in dims]
            rows = stored.join(keys, same, "left_anti").unionByName(changed)
            replace_partitions(rows, path, [PART], list(dims))
        finally:
            changed.unpersist()

    with _in_rocksdb(spark, trigger):
        return _writer(groups, checkpoint, trigger).outputMode("update").foreachBatch(write).start()


def stream_preagg(messages: DataFrame, sinks: Sinks, preagg: Preagg, trigger: dict | None = None) -> StreamingQuery:
    """Keep one aggregate up to date; every version counts, as ``build(mode="ingest")``."""
    groups = preagg.partial(sinks.versions(messages))
    return _start_groups(groups, preagg.dim_names, preagg.dim_names[0], sinks.preagg_path(preagg), sinks.checkpoint(preagg.name), trigger)


def stream_table(messages: DataFrame, sinks: Sinks, trigger: dict | None = None) -> list[StreamingQuery]:
    """All jobs of a table."""
    jobs = [stream_ingest(messages, sinks, trigger), stream_state(messages, sinks, trigger)]
    return jobs + [stream_preagg(messages, sinks, p, trigger) for p in preaggs_of(sinks.spec)]


# -- tumbling windows ------------------------------------------------------------


def tumbling_minute(calls: DataFrame) -> DataFrame:
    """Calls in 1-minute tumbling windows of the call time."""
    require_utc(calls.sparkSession)
    return (
        calls.where(F.col("_is_deleted") == 0)
        .groupBy(F.window("calldate", "1 minute"), F.col("kode_cabang").alias("branch_code"))
        .agg(
            F.count(F.lit(1)).alias("total_calls"),
            F.count_if(F.col("disposition") == "ANSWERED").alias("answered_calls"),
            F.sum("duration").alias("total_duration"),
            F.sum("billsec").alias("total_billsec"),
        )
        .select(
            F.col("window.start").alias("minute"),
            "branch_code",
            "total_calls",
            "answered_calls",
            "total_duration",
            "total_billsec",
        )
    )


MINUTES = T.StructType(
    [
        T.StructField("minute", T.TimestampType()),
        T.StructField("branch_code", T.StringType()),
        *(T.StructField(n, T.LongType()) for n in ("total_calls", "answered_calls", "total_duration", "total_billsec")),
    ]
)


def minute_rows(spark: SparkSession, root: str) -> DataFrame:
    return rows_of(spark, f"{root}/minutes", stored_schema(MINUTES)).select(*MINUTES.names)


def stream_minutes(calls: DataFrame, root: str, trigger: dict | None = None) -> StreamingQuery:
    """``tumbling_minute`` kept up to date: a late call always reaches its minute."""
    return _start_groups(tumbling_minute(calls), ["minute", "branch_code"], "minute", f"{root}/minutes", f"{root}/checkpoints/minutes", trigger)
