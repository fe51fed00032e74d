"""Column expressions shared by views and queries."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..session import require_utc

AsOf = dt.datetime | str | Column | None

# Aging bucket labels with their inclusive upper bounds in days.
# Zero and negative days fall into the first bucket.
AGING_BUCKETS = (("1-30", 30), ("31-60", 60), ("61-90", 90))
AGING_LAST = "90+"

# Names of the funnel steps 1..5.
FUNNEL_STAGES = ("Task Created", "Called", "Answered", "PTP", "Paid")


def as_of_ts(as_of: AsOf = None) -> Column:
    """Reference time of relative windows; the current time if not given."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        require_utc(spark)
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    text = as_of.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(as_of, dt.datetime) else as_of
    return F.lit(text).cast("timestamp")


def recent(col: Column | str, as_of: AsOf, amount: int, unit: str) -> Column:
    """``col >= as_of - INTERVAL``; there is no upper bound."""
    start = as_of_ts(as_of) - F.expr(f"INTERVAL {int(amount)} {unit}")
    return (F.col(col) if isinstance(col, str) else col) >= start


def recent_day(col: Column | str, as_of: AsOf, days: int) -> Column:
    """A DATE column from the day of ``as_of - days`` on."""
    start = F.to_date(as_of_ts(as_of) - F.expr(f"INTERVAL {int(days)} DAY"))
    return (F.col(col) if isinstance(col, str) else col) >= start


def since_day(ts: Column | str, as_of: AsOf, days: int) -> Column:
    """The same for the day of a timestamp, written as a bare comparison with
    midnight: that form is pushed down to the files, ``to_date(ts) >= ...`` is not."""
    start = F.date_trunc("day", as_of_ts(as_of) - F.expr(f"INTERVAL {int(days)} DAY"))
    return (F.col(ts) if isinstance(ts, str) else ts) >= start


def asof_cut(day: dt.date | str) -> int:
    """The last instant of a day that an as-of query sees, in milliseconds: 23:59:59.000
    UTC, whatever the session's zone."""
    text = day.isoformat() if isinstance(day, dt.date) else day
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"not a YYYY-MM-DD date: {text!r}")
    return ((dt.date.fromisoformat(text) - dt.date(1970, 1, 1)).days + 1) * 86_400_000 - 1000


def asof_cut_ms(day: dt.date | str) -> Column:
    return F.lit(asof_cut(day)).cast("bigint")


def round_half_up(x: Column, digits: int) -> Column:
    """Round to ``digits``; halves go away from zero, judged at six decimals so
    that a value such as 1.005 does not depend on its binary form."""
    return F.round(x.cast("decimal(38,6)"), digits).cast("double")


def rate_pct(part: Column, whole: Column, empty: float | None = None) -> Column:
    """``100 * part / whole`` of two counts, rounded half up to one decimal;
    ``empty`` (default NULL) when whole is 0.

    Computed in integers, so it is exact and cheap enough for every row.
    """
    n = F.nullif(whole.cast("bigint"), F.lit(0))
    twice = F.abs(n) * 2
    tenths = F.call_function("div", F.abs(part.cast("bigint")) * 2000 + F.abs(n), twice)
    ratio = F.signum(part) * F.signum(n) * tenths / F.lit(10.0)
    return ratio if empty is None else F.coalesce(ratio, F.lit(float(empty)))


def rate_pct_positive(part: Column, whole: Column) -> Column:
    """As ``rate_pct``, but 0 unless ``whole`` is positive."""
    return F.when(whole > 0, rate_pct(part, whole)).otherwise(F.lit(0.0))


def minutes(seconds: Column, digits: int = 1) -> Column:
    return round_half_up(seconds / F.lit(60.0), digits)


def exact_sum(amount: Column, digits: int = 2) -> Column:
    """Sum of amounts in minor units, the same in any order: each is rounded half up to
    ``digits`` decimals first.  Amounts beyond 10**20 and sums beyond 10**36 raise in ANSI
    mode; NaN and infinities have no decimal form and count as NULL."""
    finite = F.when(~F.isnan(amount) & (F.abs(amount) != F.lit(float("inf"))), amount)
    return F.sum(finite.cast(f"decimal({20 + digits},{digits})")).cast("double")


def millions(amount: Column) -> Column:
    return round_half_up(amount / F.lit(1000000.0), 2)


def finite_or(x: Column, default: float) -> Column:
    """NULL, NaN and infinities -> ``default``."""
    finite = F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)
    return F.coalesce(finite, F.lit(float(default)))


def aging_bucket(days: Column) -> Column:
    out = F
    for label, top in AGING_BUCKETS:
        out = out.when(days <= top, F.lit(label))
    return out.otherwise(F.lit(AGING_LAST))


def aging_rank(label: Column) -> Column:
    """Position of an aging bucket in display order."""
    out = F
    for i, (name, _) in enumerate(AGING_BUCKETS, start=1):
        out = out.when(label == name, F.lit(i))
    return out.otherwise(F.lit(len(AGING_BUCKETS) + 1))


def stage_label(level: Column) -> Column:
    names = F.array(*(F.lit(s) for s in FUNNEL_STAGES))
    return F.when(level == 0, F.lit("Start")).otherwise(F.try_element_at(names, level))


def month_key(ms: Column) -> Column:
    """yyyyMM in UTC as an integer, e.g. 202401, of milliseconds; independent of the
    session's zone."""
    day = F.date_from_unix_date(F.floor(ms / F.lit(86_400_000)).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


def row_hash(*cols: Column) -> Column:
    return F.md5(F.concat(*cols))
