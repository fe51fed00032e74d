"""Plain Parquet tables whose partitions Spark's committer replaces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN, BATCH = "_run", "_batch"
#: How stored tables are compressed.
PACKED = "zstd"


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, fs = _path(spark, path)
    return fs.exists(found)


def make_folder(spark: SparkSession, path: str) -> None:
    found, fs = _path(spark, path)
    fs.mkdirs(found)


def empty_folder(spark: SparkSession, path: str) -> None:
    found, fs = _path(spark, path)
    for status in fs.listStatus(found):
        fs.delete(status.getPath(), True)


def file_sizes(spark: SparkSession, path: str) -> list[int]:
    found, fs = _path(spark, path)
    files, out = fs.listFiles(found, True), []
    while files.hasNext():
        out.append(files.next().getLen())
    return out


def replace_partitions(rows: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = (), spread: bool = True) -> None:
    """Write ``rows`` in place of what the partitions they fall into hold; others stay.

    Spark writes aside and moves each partition when the job commits, so ``rows`` may come
    from the table itself, a failed job changes nothing, and the same job again leaves the same rows.
    Rebalancing gives few files: a partition value with most of the rows is split over
    several tasks and small ones are packed together.  It shuffles all rows once more; without
    ``spread`` they are written as they lie, for rows of one partition fresh from a shuffle.
    """
    out = rows.hint("rebalance", *partition_by) if spread else rows
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path, compression=PACKED)


def rows_of(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table's rows, ``schema`` with its partition columns; none before the first write."""
    if not exists(spark, path):
        # Of no Python rows, for which every core would start a worker.
        return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def rewrite_partitions(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str], sort_by: Sequence[str]) -> None:
    """The same rows in few sorted files per partition."""
    if exists(spark, path):
        replace_partitions(rows_of(spark, path, schema), path, partition_by, sort_by)


# -- batches of streams ------------------------------------------------------------


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query of a checkpoint when it first ran."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def finished_batches(spark: SparkSession, checkpoint: str) -> tuple[str, int] | None:
    """The query's id and the last batch in its commit log, or None before the first one."""
    folder, fs = _path(spark, f"{checkpoint}/commits")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    done = [int(n) for n in names if n.isdigit()]
    return (query_id(spark, checkpoint), max(done)) if done else None


def published(spark: SparkSession, checkpoints: str) -> list[tuple[str, int]]:
    """Queries and their last finished batches, of all checkpoints in a folder."""
    folder, fs = _path(spark, checkpoints)
    names = [s.getPath().toString() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return [found for found in (finished_batches(spark, n) for n in sorted(names)) if found]


def upto(batches: Sequence[tuple[str, int]]) -> Column:
    """Rows of these runs up to these batches: a filter on partition columns alone."""
    out = F.lit(False)
    for run, batch in batches:
        out = out | ((F.col(RUN) == run) & (F.col(BATCH) <= batch))
    return out
