"""The append-only history of a table, every version of every row, and its month ends."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import asof_cut
from ..operators.state import latest_per_key
from ..specs import TableSpec
from .decode import with_month
from .tables import BATCH, RUN, published, replace_partitions, rows_of, upto

INGESTED_AT = T.StructField("_ingested_at", T.TimestampType())
MONTH = T.StructField("_month", T.IntegerType())
WRITTEN_BY = (MONTH, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType()))
COVER = T.StructType(
    [T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType()), MONTH]
)


@dataclass(frozen=True)
class History:
    """Partitioned by the month of the change, then by the run (the id of a streaming query)
    and the batch that wrote it.

    A batch that is run again replaces its own partitions.  Readers take batches that Spark's
    commit log has as finished, all sinks of a batch at one moment, so nobody sees half of one.
    """

    spark: SparkSession
    spec: TableSpec
    root: str

    @property
    def path(self) -> str:
        return f"{self.root}/history/{self.spec.name}"

    @property
    def checkpoints(self) -> str:
        """Of the queries that write the history."""
        return f"{self.root}/checkpoints/{self.spec.name}/ingest"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([*self.spec.history_schema().fields, INGESTED_AT, *WRITTEN_BY])

    def append(self, rows: DataFrame, run: str, batch: int) -> None:
        stamped = with_month(rows).withColumns(
            {"_ingested_at": F.current_timestamp(), RUN: F.lit(run), BATCH: F.lit(batch).cast("long")}
        )
        names = [f.name for f in WRITTEN_BY]
        replace_partitions(stamped.select(*self.schema.names), self.path, names, [*self.spec.key, "_ts_ms"])

    def all_rows(self) -> DataFrame:
        """Of finished and unfinished batches."""
        return rows_of(self.spark, self.path, self.schema)

    def rows(self) -> DataFrame:
        return self.all_rows().where(upto(published(self.spark, self.checkpoints)))

    # -- month ends --------------------------------------------------------------

    @property
    def _ends(self) -> str:
        return f"{self.root}/month_ends/{self.spec.name}"

    @property
    def _covers(self) -> str:
        return f"{self.root}/month_ends_cover/{self.spec.name}"

    @property
    def _end_schema(self) -> T.StructType:
        return T.StructType([*self.spec.history_schema().fields, MONTH])

    def _cover_of(self, month: int) -> list[tuple[str, int]]:
        rows = rows_of(self.spark, self._covers, COVER).where(F.col("_month") == month)
        return [(r[RUN], r[BATCH]) for r in rows.collect()]

    def _month_before(self, month: int) -> int | None:
        """The newest month end kept before ``month``."""
        found = rows_of(self.spark, self._covers, COVER).where(F.col("_month") < month)
        return found.agg(F.max("_month")).first()[0]

    def _versions(self, month: int) -> DataFrame:
        """History rows that decide the state at any moment of ``month``: the newest month end
        before it, the versions of the months since, and those that arrived late.

        Only partition columns are compared, so other months are not read: late rows are
        those of batches that the month end does not cover.
        """
        columns = self.spec.history_schema().names
        base = self._month_before(month)
        rows = self.rows().where(F.col("_month") <= month)
        if base is None:
            return rows.select(*columns, "_month")
        late = ~upto(self._cover_of(base))
        since = rows.where((F.col("_month") > base) | late)
        end = rows_of(self.spark, self._ends, self._end_schema).where(F.col("_month") == base)
        return since.select(*columns, "_month").unionByName(end.select(*columns, "_month"))

    def keep_month_end(self, month: int) -> None:
        """Store the newest version of every key, delete markers included, at the end of
        ``month`` (yyyymm).  Starts from the month end before it, so the cost is that of the state
        and of the months between.

        What it covers is written last; without that the month end is not used.
        """
        covered = published(self.spark, self.checkpoints)
        newest = latest_per_key(self._versions(month), self.spec)
        # Folding has shuffled them by key; they are not shuffled again for the one partition.
        replace_partitions(newest.withColumn("_month", F.lit(month)), self._ends, ["_month"], self.spec.key, spread=False)
        cover = self.spark.createDataFrame([(r, b, month) for r, b in covered], COVER)
        replace_partitions(cover, self._covers, ["_month"])

    def versions_asof(self, day: dt.date | str) -> DataFrame:
        """What ``asof_state`` and ``queue_asof`` need of the history for ``day``: enough to
        tell the newest version of each key by then, not all versions."""
        cut = asof_cut(day)
        month = int(dt.datetime.fromtimestamp(cut / 1000, dt.timezone.utc).strftime("%Y%m"))
        return self._versions(month).where(F.col("_ts_ms") <= cut)
