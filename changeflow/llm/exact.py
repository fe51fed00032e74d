"""Exact duplicates by content sort.  DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import settled, shuffle_width, whole_rows

#: Bytes of text in one range.
RANGE_BYTES = 32 << 20
#: Ranges at most; the splitters, one less, go through the driver.
MAX_RANGES = 32_768
#: Sampled keys for each range, on average.
SAMPLES = 16
#: Characters of the text at the head of a sort key.
HEAD = 64


def _range_of(key: Column, splitters: list[str]) -> Column:
    """How many splitters lie at or below the key, by binary search."""
    if not splitters:
        return F.lit(0)
    known = F.array(*(F.lit(s) for s in splitters))
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(splitters).bit_length()))))
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(known, at + step - 1) <= key, at + step).otherwise(at),
    )


def _splitters(docs: DataFrame, key: Column, text: Column) -> list[str]:
    """Keys that cut a sample of the rows into equal parts."""
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("bytes")).first()
    ranges = min(MAX_RANGES, max(shuffle_width(docs.sparkSession), size["bytes"] // RANGE_BYTES if size["bytes"] else 1))
    drawn = docs.sample(min(1.0, ranges * SAMPLES / max(size["n"], 1)), seed=7).select(key).collect()
    found = sorted(r[0] for r in drawn)
    return sorted({found[len(found) * k // ranges] for k in range(1, ranges)}) if found else []


def content_sort(docs: DataFrame, id_col: str, text_col: str, normalise: Callable[[Column], Column], carry: bool) -> DataFrame:
    """Every row in its place: ``id, sha, bucket, run, best, size, rank, edge`` and, with
    ``carry``, the input row as ``row`` where it may stay.

    The sort key starts with the normalised text, goes on with its digest and ends with
    a hash of the id: equal texts are adjacent, and a text that holds a third of all rows
    fills several ranges.  ``run`` counts the groups of equal neighbours in a range, by
    comparison of whole texts; ``best`` and ``size`` are of the run's part in this range;
    ``edge`` holds the text of the first and last row of a range.
    """
    text = F.coalesce(normalise(F.col(f"`{text_col}`").cast("string")), F.lit(""))
    id_ = F.col(f"`{id_col}`")

    def content(t):
        return F.concat(F.substring(t, 1, HEAD), F.lit("\x01"), F.sha2(t, 256))

    def place(t, i):
        return F.concat(content(t), F.lpad(F.hex(F.xxhash64(i)), 16, "0"))

    splitters = _splitters(docs, place(text, id_).alias("k"), text)
    keyed = whole_rows(docs, id=id_, norm=text)
    dealt = (
        keyed.withColumn("place", place(F.col("norm"), F.col("id")))
        .withColumn("bucket", _range_of(F.col("place"), splitters))
        .repartitionById(len(splitters) + 1, F.col("bucket"))
    )
    order = Window.partitionBy("bucket").orderBy("place", "norm", "id")
    before, after = F.lag("norm").over(order), F.lead("norm").over(order)
    compared = dealt.select(
        "row",
        "id",
        "bucket",
        "place",
        F.when(before.isNull() | after.isNull(), F.col("norm")).alias("edge"),
        (F.row_number().over(order)).alias("at"),
        F.coalesce(before == F.col("norm"), F.lit(False)).alias("same"),
    )
    numbered = compared.select(
        *(["row"] if carry else []),
        "id",
        "bucket",
        "edge",
        F.regexp_extract("place", "\x01([0-9a-f]{64})[0-9A-F]{16}$", 1).alias("sha"),
        F.sum(F.when(F.col("same"), 0).otherwise(1))
        .over(Window.partitionBy("bucket").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
        .alias("run"),
    )
    return numbered


def _ranked(numbered: DataFrame, largest: bool) -> DataFrame:
    """The part of each run within its range: its best id, its size, each row's rank."""
    run = Window.partitionBy("bucket", "run")
    first = F.col("id").desc_nulls_last() if largest else F.col("id").asc_nulls_last()
    out = numbered.select(
        "*",
        (F.max("id") if largest else F.min("id")).over(run).alias("best"),
        F.count("*").over(run).alias("size"),
        F.row_number().over(run.orderBy(first)).alias("rank"),
    )
    if "row" in out.columns:
        out = out.withColumn("row", F.when(F.col("rank") == 1, F.col("row")))
    return out


def _chains(ranked: DataFrame, largest: bool) -> DataFrame:
    """Runs at the edges of ranges, joined where the text goes on in the next range.

    The edges of two rows a range, ``2 * MAX_RANGES`` at most, meet in one task; it
    compares their whole texts."""
    order = Window.orderBy("bucket", "run")
    edges = ranked.where("edge IS NOT NULL").select("bucket", "run", "edge", "best", "size").dropDuplicates(["bucket", "run"])
    linked = edges.select(
        "*", F.coalesce(F.lag("edge").over(order) == F.col("edge"), F.lit(False)).alias("same")
    ).drop("edge")
    chained = linked.withColumn("chain", F.sum(F.when(F.col("same"), 0).otherwise(1)).over(order))
    chain = Window.partitionBy("chain")
    return chained.select(
        "bucket",
        "run",
        (F.max("best") if largest else F.min("best")).over(chain).alias("chain_best"),
        F.sum("size").over(chain).alias("chain_size"),
    )


def _resolved(docs, id_col, text_col, normalise, largest, carry) -> DataFrame:
    ranked = settled(_ranked(content_sort(docs, id_col, text_col, normalise, carry), largest), "content")
    return (
        ranked.join(F.broadcast(_chains(ranked, largest)), ["bucket", "run"], "left")
        .withColumn("keep_id", F.coalesce("chain_best", "best"))
        .withColumn("group_size", F.coalesce("chain_size", "size"))
        .withColumn("kept", (F.col("rank") == 1) & F.col("id").eqNullSafe(F.col("keep_id")))
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = lambda text: text,
    largest: bool = False,
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, sha`` (digest of the
    normalised text).

    Texts are equal when their normalised forms are.  Of equal texts the row with the
    smallest id stays (``largest``: the largest).  NULL counts as empty text.  A row
    without id stays only if no equal row has one; of rows that repeat both id and
    text one stays.  No rows in, no rows out.
    """
    done = _resolved(docs, id_col, text_col, normalise, largest, carry=False)
    return done.select("id", "keep_id", "group_size", "kept", "sha")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = lambda text: text,
    largest: bool = False,
) -> DataFrame:
    """The input rows that stay, all columns; see ``exact_groups``."""
    return _resolved(docs, id_col, text_col, normalise, largest, carry=True).where("kept").select("row.*")
