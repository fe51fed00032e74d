"""Whitening of embeddings on the leading principal components of an exact integer grid."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import settled
from changeflow.llm.spectrum import leading

GRID = 1024
SHIFT = 100_000
COMPONENTS = 8
#: Entries must stay in the grid's long range.
_LARGEST = 2.0**62 / GRID


@dataclass
class Whitening:
    """What is fitted: ``n`` vectors of ``d`` entries with column sums ``total``, and the
    components as columns with their eigenvalues."""

    n: int
    total: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def grid_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, x``: each entry c as ``floor(1024 c) + 100000``.  Vectors that are NULL or empty
    or hold NULL, non-finite or (beyond 2**52) unrepresentable entries are left out."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    wrong = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > F.lit(_LARGEST)))
    cells = F.transform("v", lambda c: F.floor(c * GRID) + F.lit(SHIFT).cast("long"))
    return (
        rows.select(F.col(f"`{id_col}`").alias("id"), vector.alias("v"))
        .where(F.col("v").isNotNull() & (F.size("v") > 0) & ~wrong)
        .select("id", cells.alias("x"))
    )


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _column_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number and exact sums per dimension of the vectors of the most frequent length (of
    equally frequent ones, the shorter)."""
    schema = "d int, k int, n long, s decimal(38,0)"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            column = batch.column("x")
            lengths = column.value_lengths().to_numpy()
            for d in np.unique(lengths).tolist():
                x = _matrix(column.filter(pa.array(lengths == d)), d)
                held = total.setdefault(d, [0, [0] * d])
                held[0] += len(x)
                # two halves of 31 and 33 bits: neither sum can pass a long
                low, high = (x & 0x7FFFFFFF).sum(axis=0).tolist(), (x >> 31).sum(axis=0).tolist()
                held[1] = [s + a + (b << 31) for s, a, b in zip(held[1], low, high, strict=True)]
        rows = [(d, k, n, s) for d, (n, sums) in total.items() for k, s in enumerate(sums)]
        d, k, n, s = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(d, pa.int32()), pa.array(k, pa.int32()), pa.array(n, pa.int64()), pa.array(s, pa.decimal128(38, 0))],
            names=["d", "k", "n", "s"],
        )

    by_place = vectors.select("x").mapInArrow(sums, schema).groupBy("d", "k").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    best = by_place.groupBy("d").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("k", "s"))).alias("sums"))
    first = best.orderBy(F.desc("n"), "d").limit(1).collect()
    if not first:
        return 0, []
    return first[0]["n"], [int(r["s"]) for r in first[0]["sums"]]


def _covariance(vectors: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """Centred before multiplying.  A task adds up one matrix; they are summed by cell."""
    d = len(total)
    mean = np.array([s / n for s in total])
    upper = np.triu_indices(d)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch.column("x"), d) - mean
            out += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(out[upper])], names=["i", "j", "p"]
        )

    cells = vectors.where(F.size("x") == d).select("x").mapInArrow(products, "i int, j int, p double")
    out = np.zeros((d, d))
    for r in cells.groupBy("i", "j").agg(F.sum("p").alias("p")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["p"] / n
    return out


def fitted(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fitted on all ``grid_vectors``.  The driver sees the column sums and the covariance,
    whose size is that of one vector squared; None without vectors."""
    n, total = _column_sums(vectors)
    if not n:
        return None
    covariance = _covariance(vectors, n, total)
    values, vectors_ = leading(covariance, components)
    return Whitening(n, total, values, vectors_, float(np.trace(covariance)))


def project(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``id, deviation, whitened`` (an array by component) of each vector of the fitted length.

    ``deviation`` is the sum of ``(n x - S)**2`` over the dimensions, exact; NULL where it
    passes a long.
    """
    d, n = len(model.total), model.n
    mean = np.array([s / n for s in model.total])
    weights = model.vectors / np.sqrt(model.values)
    schema = T.StructType([vectors.schema["id"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def exact(x: list[int]) -> int | None:
        out = sum((n * a - s) ** 2 for a, s in zip(x, model.total, strict=True))
        return out if out < 1 << 63 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            centred = x - mean
            far = centred * n
            small = (np.abs(x).max(axis=1) < 2**62 / n) & ((far**2).sum(axis=1) < 2.0**62)
            small &= max(map(abs, model.total)) < 1 << 62
            deviation: list = [None] * len(x)
            if small.any():
                away = n * x[small] - np.array(model.total, dtype=np.int64)
                for k, v in zip(np.flatnonzero(small).tolist(), (away**2).sum(axis=1).tolist(), strict=True):
                    deviation[k] = v
            for k in np.flatnonzero(~small).tolist():
                deviation[k] = exact(x[k].tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(deviation, pa.int64()), pa.array(list(centred @ weights), pa.list_(pa.float64()))],
                names=schema.fieldNames(),
            )

    return vectors.where(F.size("x") == d).mapInArrow(run, schema)


def _identity_error(projected: DataFrame, components: int) -> float:
    """Largest entry of the measured covariance of ``whitened`` minus the identity."""
    if not components:
        return 0.0
    entry = [F.col("whitened")[i] for i in range(components)]
    means = projected.agg(*(F.avg(c).alias(f"m{i}") for i, c in enumerate(entry))).first()
    centred = [c - F.lit(means[i]) for i, c in enumerate(entry)]
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    found = projected.agg(*(F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per remaining vector and component: ``id, component, n, deviation, whitened,
    explained, identity_error``.

    Vectors that are NULL or empty, hold NULL or non-finite entries or ones that the grid cannot
    hold, or have another length than most, are left out.  Fitted on all others; repeated rows
    count as often as they come and ids may be NULL.  Components are numbered from 1 by falling
    eigenvalue.  Directions without variance beyond rounding are no components: equal vectors,
    a single one and an empty table give no rows.
    """
    vectors = grid_vectors(rows, id_col, vector_col)
    schema = T.StructType(
        [
            vectors.schema["id"], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
        ]
    )
    model = fitted(vectors, components)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    projected = settled(project(vectors, model), "whitened")
    error = _identity_error(projected, len(model.values))
    explained = F.array(*(F.lit(float(e / model.trace)) for e in model.values))
    by_component = projected.select("id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return by_component.select(
        "id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"),
    )
