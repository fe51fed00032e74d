"""Operators against brute force."""

import math
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from changeflow.functions.scalars import exact_sum, rate_pct, round_half_up, stage_label
from changeflow.operators.funnel import window_funnel
from changeflow.operators.preagg import CDR_MINUTELY, DISPOSITION_SUMMARY
from changeflow.operators.quantiles import quantiles_exact, quantiles_radix
from changeflow.session import scratch_dir
from changeflow.sources.tables import replace_partitions, rewrite_partitions, rows_of
from changeflow.streaming.ingest import tumbling_minute


def funnel_level(events, window, steps):
    """Best chain over every start, by plain search."""
    best = 0
    for start, first in events:
        if first != 1:
            continue
        level, at = 1, (start, 1)
        for t, s in sorted(set(events)):
            if (t, s) > at and s == level + 1 and t <= start + window:
                level, at = s, (t, s)
        best = max(best, level)
    return min(best, steps)


@pytest.mark.parametrize("seed", [1, 2])
def test_window_funnel(spark, seed):
    rnd = random.Random(seed)
    events = defaultdict(list)
    for key in range(400):
        for _ in range(rnd.randint(1, 12)):
            events[f"k{key}"].append((rnd.randint(0, 30), rnd.randint(1, 5)))
    data = [(k, t, s) for k, es in events.items() for t, s in es]
    data += [("hot", t % 50, 1 + t % 5) for t in range(5000)]
    events["hot"] = [(t, s) for k, t, s in data if k == "hot"]
    df = spark.createDataFrame(data, "k string, t long, step int").withColumn(
        "ts", F.timestamp_millis(F.col("t") * 1000 + 250)
    )
    found = dict(rows(window_funnel(df, "k", "ts", "step", 10, 5)))
    assert found == {k: funnel_level(es, 10, 5) for k, es in events.items()}


@pytest.mark.parametrize("n", [1, 2, 4, 10, 100, 1001])
def test_quantiles(spark, n):
    rnd = random.Random(n)
    values = [rnd.choice([0, 7, -3, 2**31 - 1, -(2**31), rnd.randint(-200_000, 200_000)]) for _ in range(n)]
    levels = (0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    found = quantiles_exact(df, "v", levels).first()
    ordered = sorted(values)
    assert found.quantiles == [ordered[min(int(p * n), n - 1)] for p in levels]
    assert (found.max, found.min) == (ordered[-1], ordered[0])
    assert found["mean"] == pytest.approx(sum(values) / n)


def test_quantiles_reuse_the_counts(spark):
    df = spark.range(1000).select((F.col("id") % 77).cast("int").alias("v"))
    result = quantiles_exact(df, "v", (0.5,))
    result.collect()
    final = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Range (0, 1000") == 1 and "ReusedExchange" in final
    with pytest.raises(TypeError):
        quantiles_exact(spark.range(3), "id", (0.5,))


def test_merge_is_independent_of_batches(spark, history):
    from changeflow.specs import CDR

    rnd = random.Random(5)
    events = [
        {"uniqueid": f"u{i % 30}", "calldate": 1_700_000_000_000 + rnd.randint(0, 9) * 60_000, "billsec": rnd.randint(0, 99),
         "duration": 100, "disposition": rnd.choice(["ANSWERED", "BUSY"]), "kodeCabang": rnd.choice("AB"),
         "__op": "c", "__ts_ms": i, "__source_ts_ms": i, "__deleted": "true" if i % 9 == 0 else "false"}
        for i in range(200)
    ]
    df = history(CDR, events).persist()
    for preagg in (CDR_MINUTELY, DISPOSITION_SUMMARY):
        whole = preagg.build(df)
        parts = None
        for b in range(4):
            part = preagg.partial(df.where(F.pmod("_seq", F.lit(4)) == b))
            parts = part if parts is None else parts.unionAll(part)
        assert sorted(rows(preagg.fold(parts))) == sorted(rows(whole))
        assert sorted(rows(preagg.merge(parts, "branch_code"))) == sorted(rows(preagg.merge(whole, "branch_code")))
    assert sorted(rows(tumbling_minute(df))) == sorted(rows(CDR_MINUTELY.build(df)))
    df.unpersist()


def test_partitions_are_replaced(spark):
    path = scratch_dir(spark, "table")
    schema = spark.range(0).selectExpr("'' AS k", "0L AS n", "0 AS part").schema
    assert rows(rows_of(spark, path, schema)) == []
    rewrite_partitions(spark, path, schema, ["part"], ["k"])  # nothing to do is fine
    one = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], schema)
    for _ in range(2):
        replace_partitions(one, path, ["part"])
    assert sorted(rows(rows_of(spark, path, schema))) == [("a", 1, 1), ("b", 2, 2)]
    replace_partitions(spark.createDataFrame([("c", 3, 2)], schema), path, ["part"])
    assert sorted(rows(rows_of(spark, path, schema))) == [("a", 1, 1), ("c", 3, 2)]
    replace_partitions(one.limit(0), path, ["part"])
    # From the table itself.
    own = rows_of(spark, path, schema)
    replace_partitions(own.where("part = 1").unionAll(own).withColumn("n", F.col("n") + 10), path, ["part"])
    rewrite_partitions(spark, path, schema, ["part"], ["k"])
    assert sorted(rows(rows_of(spark, path, schema))) == [("a", 11, 1), ("a", 11, 1), ("c", 13, 2)]


def ordered_value(v):
    return (math.isnan(v), v) if isinstance(v, float) else (False, v)


@pytest.mark.parametrize("kind", ["bigint", "double", "int", "float"])
def test_radix_quantiles(spark, kind):
    rnd = random.Random(3)
    nan, inf = float("nan"), float("inf")
    odd = {"bigint": [2**63 - 1, -(2**63), 0, -1, 2**48, -(2**48)], "int": [2**31 - 1, -(2**31), 0, -1], "double": [nan, inf, -inf, -0.0, 0.0, 5e-324, -5e-324, 1e300, 0.1], "float": [nan, inf, -inf, -0.0, 1.5]}[kind]
    levels = (0.0, 0.001, 0.25, 0.5, 0.5, 0.99, 1.0)
    for n in (1, 2, 7, 400):
        near = [rnd.randint(-9, 9) if kind in ("bigint", "int") else rnd.randint(-99, 99) / 8 for _ in range(n)]
        values = [rnd.choice([*odd, v, v, v]) for v in near]
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], f"`a b` {kind}").repartition(3)
        found = quantiles_radix(df, "a b", levels).first()
        expected = sorted((v + 0.0 if isinstance(v, float) else v for v in values), key=ordered_value)
        assert found.n == n
        assert [repr(v) for v in found.quantiles] == [repr(expected[min(int(p * n), n - 1)]) for p in levels]
    assert tuple(quantiles_radix(df.where("false"), "a b", levels).first()) == (None, 0)
    with pytest.raises(TypeError):
        quantiles_radix(spark.sql("SELECT 'x' AS v"), "v", levels)


def test_radix_quantiles_of_a_hot_value(spark):
    df = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, F.lit(0.25)).otherwise(F.rand(3)).alias("v"))
    ordered = sorted(r.v for r in df.collect())
    found = quantiles_radix(df, "v", (0.1, 0.4, 0.9)).first()
    assert found.quantiles == [ordered[int(p * 90_000)] for p in (0.1, 0.4, 0.9)]


def test_exact_sums(spark):
    rnd = random.Random(4)
    cents = [rnd.randint(-10**9, 10**13) for _ in range(3000)]
    df = spark.createDataFrame([(c / 100,) for c in cents] + [(None,), (float("nan"),), (float("inf"),)], "x double")
    sums = {df.repartition(k).agg(exact_sum(F.col("x")).alias("s")).first().s for k in (1, 3, 8)}
    assert sums == {sum(cents) / 100}
    assert spark.range(1).agg(exact_sum(F.lit(None).cast("double"))).first()[0] is None
    with pytest.raises(Exception):
        spark.range(1).agg(exact_sum(F.lit(1e25))).collect()


def test_counts_of_all_tables(spark, history):
    """Hash aggregates alone; ties of time go by arrival, empty tables count zero."""
    from changeflow.operators.state import alive_counts, scan_state
    from changeflow.specs import CDR, CUSTOMER_ID, SPECS

    def change(key, ts, op):
        return {"id": key, "uniqueid": str(key), "calldate": 0, "__op": op, "__ts_ms": ts, "__deleted": "true" if op == "d" else "false"}

    events = [change(1, 1, "c"), change(1, 1, "d"), change(2, 2, "d"), change(2, 1, "c"), change(2, 3, "c"), change(3, 1, "c")]
    tables = {"cdr": history(CDR, events), "customer_id": history(CUSTOMER_ID, events[:2])}
    tables["user_logs"] = history(SPECS["user_logs"], [])
    found = alive_counts(tables, SPECS)
    assert dict(rows(found)) == {"cdr": 2, "customer_id": 0, "user_logs": 0}
    plan = alive_counts(tables, SPECS)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "ObjectHash" not in plan
    last = [change(5, 2**40, "d") | {"uniqueid": "z"}]
    far = history(CDR, [*events, *last]).withColumn("_seq", F.lit(2**63 - 1) - F.lit(100) + F.col("_seq"))
    assert dict(rows(alive_counts({"cdr": far}, SPECS))) == {"cdr": 2}
    stored = {n: df.selectExpr("*", "_ts_ms AS _version").where("false") for n, df in tables.items()}
    assert set(dict(rows(alive_counts(stored, SPECS))).values()) == {0}
    assert scan_state(tables["cdr"], CDR).count() == 2


def test_funnel_folds_only_candidates(spark):
    """A version outside the days that is not followed by one inside never reaches the fold."""
    from seed import AS_OF, EVENTS

    from changeflow.plans import funnel
    from changeflow.sources.decode import decode_json_rows, ingest_project, with_month
    from changeflow.specs import CDR, COLLECTION_RESULT, COLLECTION_TASK, CUSTOMER_ID

    import json

    parts = []
    for spec in (COLLECTION_TASK, CDR, COLLECTION_RESULT, CUSTOMER_ID):
        texts = [(json.dumps(e), k) for k, e in enumerate(EVENTS[spec.name]) if isinstance(e, dict)]
        messages = spark.createDataFrame(texts, "value string, seq bigint")
        parts.append(with_month(ingest_project(decode_json_rows(messages, spec), spec)))
    events = funnel.union_events(*parts, as_of=AS_OF)
    assert events._jdf.queryExecution().optimizedPlan().toString().count("Join LeftSemi") == 4
    plain = funnel.union_events(*(p.drop("_month") for p in parts), as_of=AS_OF)
    assert sorted(map(str, rows(events))) == sorted(map(str, rows(plain))) and plain.count()


def test_rounding(spark):
    pairs = [(1, 3), (2, 3), (1, 16), (247, 2000), (0, 5), (5, 0), (7, 7), (-1, 3), (1, 8), (3, 400)]
    df = spark.createDataFrame(pairs, "a int, b int")
    found = [r[0] for r in df.select(rate_pct(F.col("a"), F.col("b"))).collect()]
    assert found == [33.3, 66.7, 6.3, 12.4, 0.0, None, 100.0, -33.3, 12.5, 0.8]
    halves = spark.createDataFrame([(1.005,), (2.675,), (0.5,), (-0.125,)], "x double")
    assert [r[0] for r in halves.select(round_half_up(F.col("x"), 2)).collect()] == [1.01, 2.68, 0.5, -0.13]


def test_stage_label(spark):
    found = [r[0] for r in spark.range(0, 7).select(stage_label(F.col("id").cast("int"))).collect()]
    assert found == ["Start", "Task Created", "Called", "Answered", "PTP", "Paid", None]


@pytest.mark.parametrize("digits", [1, 20, 36])
def test_radix_quantiles_of_decimals(spark, digits):
    rnd = random.Random(5)
    end = 10**digits - 1
    levels = (0.0, 0.001, 0.25, 0.5, 0.5, 0.99, 1.0)
    for n in (1, 300):
        values = [rnd.choice([end, -end, 0, -1, end // 3, rnd.randint(-end, end)]) for _ in range(n)]
        df = spark.createDataFrame([(Decimal(v),) for v in values] + [(None,)], f"v decimal({digits},0)").repartition(3)
        found = quantiles_radix(df, "v", levels).first()
        ordered = sorted(values)
        assert found.n == n
        assert [int(v) for v in found.quantiles] == [ordered[min(int(p * n), n - 1)] for p in levels]
    assert tuple(quantiles_radix(df.where("false"), "v", levels).first()) == (None, 0)
    with pytest.raises(TypeError):
        quantiles_radix(spark.sql("SELECT 1.5 AS v"), "v", levels)


def test_key_quantiles_beyond_64_bits(spark, tmp_path):
    """The query's numbers pass a long at keys of 1.3 million, as at 60 times sf0.1."""
    import __spark_entry__ as registered

    for keys in (range(1, 900), range(1, 9_000_000, 10_007), [2**63 - 1, 5], []):
        spark.createDataFrame([(k,) for k in keys], "o_orderkey bigint").write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
        found = registered.queries()["quantiles_radix_key"](spark, str(tmp_path)).first()
        wide, n = sorted(k * 7_000_000_000_003 - (1 << 50) for k in keys), len(keys)
        expected = [wide[min(int(p * n), n - 1)] if n else None for p in registered.PRICE_LEVELS]
        assert list(found) == [*expected, n]
