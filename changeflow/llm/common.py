"""Shared tables between steps, and connected components."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that the driver and all executors reach.

    It lies in the folder the cluster names in ``spark.checkpoint.dir`` and is deleted when
    the session's JVM ends.  Only a session on one machine may do without that setting, and
    uses its warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/llm-{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows from a table in the shared folder: later steps start from there,
    also after executors are lost."""
    folder = workspace(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once for each application.

    Needed where it is not installed there; the driver serves the archive.
    """
    context = spark.sparkContext
    if getattr(context, "_changeflow_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp(prefix='changeflow-code-')}/changeflow.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    context.addPyFile(archive)
    context._changeflow_shipped = True


def handed_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches after which the Python worker gives memory back: workers
    outlive their tasks, and what one has freed it would else keep beside the next one."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return whole


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_rows(docs: DataFrame, **columns) -> DataFrame:
    """Every input row as one struct ``row`` beside the working columns, so that no
    column of the input can clash with those."""
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        *(c.alias(name) for name, c in columns.items()),
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One half step.  Edges (u, v) have u > v, before and after.

    The large step hands the neighbours above a node to the smallest neighbour, the
    small step those below it.  The smallest neighbours are written first: a node
    with very many edges is then split by the skew join.
    """
    seen = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    lowest = settled(
        seen.groupBy("u").agg(F.least("u", F.min("v")).alias("low")), "lowest"
    )
    pairs = seen.join(lowest, "u")
    if large:
        return pairs.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
    below = pairs.where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return below.unionByName(lowest.select("u", F.col("low").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected links (a, b): a row (node, root) for each
    linked node, where root is the smallest node reachable.

    Alternates large and small star steps until all trees have depth one; the number
    of rounds grows with the logarithm of the longest path, and no step makes more
    edges than it got.  Loops and repeated links are allowed; no links, no rows.
    """
    edges = settled(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    while not edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty():
        edges = settled(_star(_star(edges, large=True), large=False), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
