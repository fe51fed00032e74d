"""Mergeable pre-aggregates: partial rows that can be summed at any grain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import require_utc
from ..specs import CDR, COLLECTION_RESULT, USER_RELEASES, TableSpec
from .state import scan_state

LIVE = "_is_deleted = 0"


@dataclass(frozen=True)
class Measure:
    """One aggregate and the columns its partial state is kept in."""

    name: str
    func: str  # sum | count | count_if | avg
    expr: str = ""
    dtype: str = "bigint"

    def partial(self) -> list[Column]:
        if self.func == "sum":
            return [F.sum(F.expr(self.expr)).cast(self.dtype).alias(self.name)]
        if self.func == "count":
            return [F.count(F.lit(1)).alias(self.name)]
        if self.func == "count_if":
            return [F.count_if(F.expr(self.expr)).alias(self.name)]
        if self.func == "avg":  # averaged over single precision values
            value = F.expr(self.expr).cast("float").cast("double")
            return [
                F.sum(value).alias(f"{self.name}_sum"),
                F.count(value).alias(f"{self.name}_cnt"),
            ]
        raise ValueError(self.func)

    @property
    def state_columns(self) -> list[tuple[str, str]]:
        if self.func == "avg":
            return [(f"{self.name}_sum", "double"), (f"{self.name}_cnt", "bigint")]
        return [(self.name, self.dtype)]

    def merge_state(self) -> list[Column]:
        return [F.sum(c).alias(c) for c, _ in self.state_columns]

    def merge(self) -> Column:
        if self.func == "avg":
            total, n = F.sum(f"{self.name}_sum"), F.sum(f"{self.name}_cnt")
            return (total / F.nullif(n, F.lit(0)).cast("double")).alias(self.name)
        return F.sum(self.name).alias(self.name)


@dataclass(frozen=True)
class Preagg:
    name: str
    table: TableSpec
    dims: tuple[tuple[str, str, str], ...]  # (name, expression, type)
    measures: tuple[Measure, ...]
    where: str = LIVE

    @property
    def dim_names(self) -> list[str]:
        return [d[0] for d in self.dims]

    def schema(self) -> T.StructType:
        parts = [f"{n} {t}" for n, _, t in self.dims]
        parts += [f"{n} {t}" for m in self.measures for n, t in m.state_columns]
        return T.StructType.fromDDL(", ".join(parts))

    def partial(self, rows: DataFrame) -> DataFrame:
        """Partial aggregate of any set of history or state rows."""
        require_utc(rows.sparkSession)
        dims = [F.expr(e).cast(t).alias(n) for n, e, t in self.dims]
        parts = [c for m in self.measures for c in m.partial()]
        return rows.where(self.where).groupBy(*dims).agg(*parts).select(*self.schema().names)

    def build(self, history: DataFrame, mode: str = "ingest") -> DataFrame:
        """Aggregate a history.

        ``ingest`` adds every inserted version that is not a delete, as the
        incremental aggregates do: an update counts again, a delete takes
        nothing back.  ``state`` counts every current row once.
        """
        if mode == "ingest":
            return self.partial(history)
        if mode == "state":
            return self.partial(scan_state(history, self.table))
        raise ValueError(f"mode must be 'ingest' or 'state', not {mode!r}")

    def fold(self, partials: DataFrame) -> DataFrame:
        """Merge partial rows, keeping the state form and the grain."""
        states = [c for m in self.measures for c in m.merge_state()]
        return partials.groupBy(*self.dim_names).agg(*states)

    def merge(self, partials: DataFrame, *dims: str, measures: list[str] | None = None) -> DataFrame:
        """Final values at the grain ``dims`` (default: the stored grain)."""
        wanted = [m for m in self.measures if measures is None or m.name in measures]
        return partials.groupBy(*(dims or self.dim_names)).agg(*(m.merge() for m in wanted))


# Names and columns of the aggregates.

AGENT_DAILY = Preagg(
    "agg_agent_daily",
    USER_RELEASES,
    (
        ("work_date", "release_date", "date"),
        ("agent_username", "username", "string"),
        ("branch_code", "kode_cabang", "string"),
    ),
    (
        Measure("tasks_assigned", "sum", "total_task"),
        Measure("calls_made", "sum", "total_called"),
        Measure("calls_answered", "sum", "total_answered"),
        Measure("ptp_achieved", "sum", "total_ptp"),
        Measure("talk_time_seconds", "sum", "talk_time_sec"),
        Measure("ptp_amount", "sum", "cast(0 as double)", "double"),  # a placeholder, always 0
    ),
    where=f"{LIVE} AND status = 'CLOSED'",
)

CDR_MINUTELY = Preagg(
    "agg_cdr_minutely",
    CDR,
    (
        ("minute", "date_trunc('MINUTE', calldate)", "timestamp"),
        ("branch_code", "kode_cabang", "string"),
    ),
    (
        Measure("total_calls", "count"),
        Measure("answered_calls", "count_if", "disposition = 'ANSWERED'"),
        Measure("total_duration", "sum", "duration"),
        Measure("total_billsec", "sum", "billsec"),
    ),
)

COLLECTION_DAILY = Preagg(
    "agg_collection_daily",
    COLLECTION_RESULT,
    (
        ("event_date", "to_date(created_ts)", "date"),
        ("classification", "classification", "string"),
        ("branch_code", "kode_cabang", "string"),
    ),
    (
        Measure("count", "count"),
        Measure("ptp_total_amount", "sum", "ptp_amount", "double"),
    ),
)

DISPOSITION_SUMMARY = Preagg(
    "agg_disposition_summary",
    CDR,
    (
        ("count_date", "to_date(calldate)", "date"),
        ("disposition", "disposition", "string"),
        ("branch_code", "kode_cabang", "string"),
    ),
    (
        Measure("count", "count"),
        Measure("avg_talk_sec", "avg", "billsec"),
    ),
)

PREAGGS: dict[str, Preagg] = {
    p.name: p for p in (AGENT_DAILY, CDR_MINUTELY, COLLECTION_DAILY, DISPOSITION_SUMMARY)
}


def preaggs_of(spec: TableSpec) -> list[Preagg]:
    return [p for p in PREAGGS.values() if p.table.name == spec.name]
