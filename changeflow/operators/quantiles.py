"""Exact quantiles without sorting all rows."""

from __future__ import annotations

import struct
from collections.abc import Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quantiles_exact(df: DataFrame, column: str, levels: Sequence[float]) -> DataFrame:
    """One row with the array ``quantiles``: per level p the value at 0-based
    position ``floor(p * n)`` of the sorted values, without interpolation; and
    ``mean``, ``max``, ``min``, which come from the same counts.

    Rows are first counted per value, so they are shuffled at most once per
    distinct value and task.  Ranks come from running sums in two steps: over
    the upper 16 bits (one task, at most 65,536 rows), and within each upper
    half (at most 65,536 rows each).  No task sorts more than that, whatever the
    number or the distribution of the rows.
    """
    if not isinstance(df.schema[column].dataType, (T.IntegerType, T.ShortType, T.ByteType)):
        raise TypeError("quantiles_exact takes integer columns of up to 32 bits")
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_high", F.shiftright("_value", 16))
    )
    blocks = counts.groupBy("_high").agg(F.sum("_n").alias("_block_n"))
    offsets = blocks.select(
        F.col("_high").alias("_block"),
        (F.sum("_block_n").over(Window.orderBy("_high")) - F.col("_block_n")).alias("_before"),
        F.sum("_block_n").over(Window.partitionBy()).alias("_total"),
    )
    in_block = Window.partitionBy("_high").orderBy("_value")
    # A null-safe join adds no filter to one of the two uses of the counts, so
    # that they stay equal and are computed once.
    same_block = F.col("_high").eqNullSafe(F.col("_block"))
    ranked = counts.join(F.broadcast(offsets), same_block).withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(in_block)
    )

    def pick(p: float) -> Column:
        position = F.least(F.floor(F.lit(float(p)) * F.col("_total")), F.col("_total") - F.lit(1))
        return F.min(F.when(F.col("_upto") > position, F.col("_value")))

    value = F.col("_value").cast("long")
    return ranked.agg(
        F.array(*(pick(p) for p in levels)).alias("quantiles"),
        (F.sum(value * F.col("_n")) / F.sum("_n")).alias("mean"),
        F.max("_value").alias("max"),
        F.min("_value").alias("min"),
    )


# -- 64 bits -------------------------------------------------------------------------

_DIGITS = (48, 32, 16, 0)

#: Digits of a decimal at which no step of ``_whole_digit`` passes 38.
_MAX_PRECISION = 36


@F.arrow_udf(T.LongType())
def _order_bits(values: pa.Array) -> pa.Array:
    """Longs in the order of doubles: -0.0 as 0.0, all NaN the same and last."""
    x = values.to_numpy(zero_copy_only=False) + 0.0
    x[np.isnan(x)] = np.nan
    bits = x.view(np.int64)
    return pa.array(np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits))


def _long_digit(shift: int) -> tuple[Column, Column]:
    """The 16 bits at ``shift`` of a long and the bits above.  The top digit keeps its sign, so
    that it sorts as a number."""
    if shift == _DIGITS[0]:
        return F.lit(0).cast("long"), F.shiftright("bits", shift)
    return F.shiftright("bits", shift + 16), F.shiftrightunsigned("bits", shift).bitwiseAND(F.lit(0xFFFF))


def _whole_digits(precision: int) -> tuple[int, ...]:
    """Shifts of the digits of whole numbers of this precision, sign included."""
    return tuple(range((10**precision).bit_length() // 16 * 16, -1, -16))


def _whole_digit(shift: int, top: bool) -> tuple[Column, Column]:
    """``_long_digit`` of a decimal without fraction; what is divided are multiples."""

    def over(power: int) -> tuple[Column, Column]:
        below = F.pmod("bits", F.lit(Decimal(1 << power)))
        return below, (F.col("bits") - below) / F.lit(Decimal(1 << power))

    if top:
        return F.lit(Decimal(0)), over(shift)[1].cast("long")
    rest, above = over(shift + 16)
    digit = (rest - F.pmod(rest, F.lit(Decimal(1 << shift)))) / F.lit(Decimal(1 << shift))
    return above.cast(f"decimal({_MAX_PRECISION},0)"), digit.cast("long")


def _double_of(bits: int) -> float:
    bits = bits if bits >= 0 else bits ^ (2**63 - 1)
    return struct.unpack("<d", struct.pack("<q", bits))[0]


def quantiles_radix(df: DataFrame, column: str, levels: Sequence[float]) -> DataFrame:
    """One row ``quantiles, n``: as ``quantiles_exact``, for 64-bit integers, doubles and
    decimals of up to 36 digits without fraction too.

    NULL does not count; -0.0 equals 0.0, NaN is greater than all numbers.  Without rows the
    quantiles are NULL.

    Radix selection: four passes (decimals: one for each 16 bits of their precision) count rows by
    the next 16 bits, the first over all rows, the others over those that share the bits found
    so far with some quantile.  A task sends at most 65,536 counts for each level, and the
    driver sees one digit for each.
    """
    kind = df.schema[column].dataType
    real = isinstance(kind, (T.DoubleType, T.FloatType))
    whole = isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision <= _MAX_PRECISION
    if not real and not whole and not isinstance(kind, T.IntegralType):
        raise TypeError("quantiles_radix takes integers, floating-point numbers and decimals of up to 36 digits without fraction")
    value = F.col(f"`{column}`")
    bits = _order_bits(value.cast("double")) if real else value if whole else value.cast("long")
    rows = df.where(value.isNotNull()).select(bits.alias("bits"))
    shifts = _whole_digits(kind.precision) if whole else _DIGITS
    n = 0
    found = [(0, 0)] * len(levels)  # the bits above the digit in turn; rows before those with these bits
    for shift in shifts:
        top = shift == shifts[0]
        above, digit = _whole_digit(shift, top) if whole else _long_digit(shift)

        def bits_of(prefix: int) -> Column:
            return F.lit(Decimal(prefix) if whole else prefix)

        counted = rows.select(above.alias("above"), digit.alias("digit"))
        if not top:
            counted = counted.where(F.col("above").isin([bits_of(p) for p in sorted({prefix for prefix, _ in found})]))
        counts = counted.groupBy("above", "digit").agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("above").orderBy("digit"))
        running = counts.select("above", "digit", "n", upto.alias("upto"), F.sum("n").over(Window.partitionBy("above")).alias("whole"))
        if top:
            n = running.agg(F.max("whole")).first()[0] or 0
            if not n:
                break
        picked = []
        for k, (level, (prefix, before)) in enumerate(zip(levels, found, strict=True)):
            rank = min(int(level * n), n - 1) - before
            here = (F.col("above") == bits_of(prefix)) & (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
            picked.append(F.when(here, F.struct(F.lit(k).alias("k"), "digit", (F.col("upto") - F.col("n")).alias("more"))))
        hits = running.select(F.explode(F.array_compact(F.array(*picked))).alias("hit")).select("hit.*").collect()
        for r in hits:
            prefix, before = found[r["k"]]
            found[r["k"]] = ((prefix << 16) + r["digit"], before + r["more"])
    out = "double" if real else kind.simpleString()
    schema = f"quantiles array<{out}>, n bigint"
    made = _double_of if real else Decimal if whole else int
    values = [made(bits) for bits, _ in found] if n else None
    return df.sparkSession.createDataFrame([(values, n)], schema)
