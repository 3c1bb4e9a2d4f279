"""Property tests: operators against plain-Python statements of the same rules."""

from __future__ import annotations

import datetime as dt
import math
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparksignal.operators import clean, series
from sparksignal.plans import signals

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
finite = st.floats(min_value=-5, max_value=5, allow_nan=False).map(lambda x: round(x, 3))


def _days(n):
    return [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(n)]


@SETTINGS
@given(st.lists(finite, min_size=1, max_size=15), st.integers(min_value=1, max_value=7))
def test_rolling_mean_matches_trailing_window(spark, xs, n):
    df = spark.createDataFrame(list(zip(_days(len(xs)), xs)), "date date, x double")
    got = [r.m for r in series.rolling_mean(df, "x", n, "m", digits=None).orderBy("date")
           .collect()]
    want = [sum(xs[max(0, i - n + 1):i + 1]) / len(xs[max(0, i - n + 1):i + 1])
            for i in range(len(xs))]
    assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got, want))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50), finite), min_size=1,
                max_size=25))
def test_keep_first_is_min_order_per_key(spark, rows):
    rows = [(k, o, v) for (k, o, v) in {(k, o): (k, o, v) for k, o, v in rows}.values()]
    df = spark.createDataFrame(rows, "k int, o int, v double")
    got = {r.k: (r.o, r.v) for r in clean.keep_first(df, ["k"], ["o"]).collect()}
    want = {}
    for k, o, v in sorted(rows, key=lambda r: (r[0], r[1])):
        want.setdefault(k, (o, v))
    assert got == want


@SETTINGS
@given(st.lists(finite, min_size=2, max_size=12))
def test_minmax_scale_matches_formula(spark, xs):
    df = spark.createDataFrame(list(zip(_days(len(xs)), xs)), "date date, x double")
    got = [r.s for r in series.minmax_scale(df, [("x", "s")]).orderBy("date").collect()]
    mn, mx = min(xs), max(xs)
    want = [0.0 if mx == mn else 2 * (x - mn) / (mx - mn) - 1 for x in xs]
    assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(got, want))


def _py_reason(sigs):
    contrib = [(label, v * w) for (name, _, _, _, w, label), v in zip(signals.SIGNALS, sigs)]
    top = sorted(contrib, key=lambda c: abs(c[1]), reverse=True)[:2]  # stable sort
    return " + ".join(f"{label} {'↑' if v > 0 else '↓'}" for label, v in top)


@SETTINGS
@given(st.lists(st.lists(st.sampled_from([-1.0, -0.5, 0.0, 0.5, 1.0]), min_size=6,
                         max_size=6), min_size=1, max_size=6))
def test_reasons_match_stable_sort(spark, rows):
    cols = ", ".join(f"{name} double" for name, *_ in signals.SIGNALS)
    df = spark.createDataFrame([(dt.date(2024, 1, i + 1), *r) for i, r in enumerate(rows)],
                               f"date date, {cols}")
    got = [r.reason for r in signals.reasons(df).orderBy("date").collect()]
    assert got == [_py_reason(r) for r in rows]


@SETTINGS
@given(st.lists(finite, min_size=1, max_size=12))
def test_recent_vs_previous_rule(spark, xs):
    df = spark.createDataFrame(list(zip(_days(len(xs)), xs)), "date date, x double")
    got = [r.d for r in series.recent_vs_previous(df, "x", "d").orderBy("date").collect()]
    for i, g in enumerate(got):
        seen = xs[:i + 1]
        if len(seen) >= 6:
            want = sum(seen[-3:]) / 3 - sum(seen[-6:-3]) / 3
        elif len(seen) >= 2:
            want = seen[-1] - seen[0]
        else:
            want = 0.0
        assert math.isclose(g, want, abs_tol=1e-9)


def test_blocks_equal_one_window(spark):
    rng = random.Random(6)
    days = sorted(rng.sample(range(0, 9000), 900))  # gaps, sparse and dense calendar blocks
    rows = [(dt.date(1990, 1, 1) + dt.timedelta(days=d), rng.uniform(-5, 5) if rng.random() < .95 else None) for d in days]
    df = spark.createDataFrame([(None, 1.0), *rows], "date date, v double").repartition(5)
    whole = series.shift(series.delta(series.rolling_mean(df, "v", 7, "m"), "v", "d"), "v", "next")
    blocked = series.in_blocks(df, before=6, after=1, rows=50, days=100)
    blocked = series.rolling_mean(blocked, "v", 7, "m", partition_by=[series.BLOCK])
    blocked = series.delta(blocked, "v", "d", partition_by=[series.BLOCK])
    blocked = series.own_rows(series.shift(blocked, "v", "next", partition_by=[series.BLOCK]))
    assert blocked.columns == whole.columns and blocked.count() == 901
    assert sorted(map(str, blocked.collect())) == sorted(map(str, whole.collect()))
    run = {r["date"]: r["r"] for r in series.running_mean(df, "v", "r").collect()}
    plain = series.running_mean(df.withColumn("k", F.lit(1)), "v", "r", partition_by=["k"])
    assert all(abs((run[r["date"]] or 0) - (r["r"] or 0)) <= 1.1e-4 for r in plain.collect())
    assert series.own_rows(series.in_blocks(df.limit(0), before=6)).count() == 0


def test_scaling_per_series_equals_each_alone(spark):
    rows = [(k, i, float((i * 7 + j) % 11) if k != "flat" else 3.0) for j, k in enumerate(["a", "b", "flat", None]) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    got = {(r["k"], r["i"]): r["s"] for r in series.minmax_scale(df, [("v", "s")], partition_by=["k"]).collect()}
    for k in ("a", "b", "flat", None):
        alone = series.minmax_scale(df.where(F.col("k").eqNullSafe(F.lit(k))), [("v", "s")])
        assert alone.columns == ["k", "i", "v", "s"]
        assert {(r["k"], r["i"]): r["s"] for r in alone.collect()}.items() <= got.items()
    assert len(got) == 80
