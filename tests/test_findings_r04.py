"""What a review of the fourth round found."""

import datetime as dt
import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from tidemark.functions import instants, rounding
from tidemark.operators import pit, rolling, sizes
from tidemark.plans import QUERIES

D, T = dt.date, dt.datetime


def test_rolling_panel_is_dealt_once(spark, monkeypatch):
    """series that lie in as many partitions as their rows need were dealt again into the session's few."""
    monkeypatch.setattr(sizes, "ROWS_A_TASK", 1000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = QUERIES["pit_rolling_panel"](spark, "/root/testdata/sf0.001")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1
        assert found.rdd.getNumPartitions() == 6
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_release_instant_is_worked_out_once_a_row(spark):
    """the rule of the release stood several times in the plan and was worked out at each."""
    rows = [("1", D(2024, 1, 2), T(2024, 1, d, h)) for d, h in ((2, 9), (3, 1), (4, 1), (4, 2))]
    given = spark.createDataFrame(rows, "k string, d date, recorded_at timestamp_ntz")
    found = pit.with_available_at(given, ["k", "d"], "d", instants.exchange_daily_settled)
    got = [r.available_at for r in found.orderBy("recorded_at").collect()]
    assert got == [T(2024, 1, 2, 19), T(2024, 1, 2, 19), T(2024, 1, 4, 1), T(2024, 1, 4, 2)]
    assert found.columns == ["k", "d", "recorded_at", "available_at"]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("convert_timezone") == 1


def test_values_round_as_in_spark(spark):
    """metrics are rounded where they are computed, to the last bit as Spark's round does."""
    random = np.random.default_rng(6)
    halves = (random.integers(-(10**7), 10**7, 400) + 0.5) / 1e4
    near = [v * (1 + k * 2.0**-52) for v in halves for k in (-40, -1, 0, 1, 40)]
    wide = (random.random(3000) - 0.5) * 10.0 ** random.integers(-9, 18, 3000)
    given = [*near, *wide.tolist(), 0.0, -0.0, -0.00004, 0.00005, 1e20, -1e300, 5e-324, math.inf, -math.inf, math.nan]
    x = spark.createDataFrame([(float(v),) for v in given], "x double").select("x", F.round("x", 4), F.round("x", 6))
    got = rounding.half_up_values(np.column_stack([given, given]), np.array([4, 6]))
    for r, mine in zip(x.collect(), got.tolist()):
        assert [repr(v + 0.0) for v in r[1:]] == [repr(v) for v in mine], r


def test_versions_that_are_written():
    """against each series' versions one after another; ties of instants, late ones and ones that come out of order."""
    random = np.random.default_rng(7)
    cell = random.integers(0, 30, 600)
    turns = cell % 5 + random.integers(0, 4, 600)
    available, recorded = turns * 10 + random.integers(0, 3, 600), random.integers(0, 40, 600)
    want = set()
    for c in range(30):
        newest, last = -1, {}
        for v in sorted(np.flatnonzero(cell == c).tolist(), key=lambda v: (available[v], recorded[v], v)):
            if recorded[v] >= newest:
                newest, last[turns[v]] = recorded[v], v
        want |= set(last.values())
    assert set(rolling.written(cell, turns, available, recorded).tolist()) == want
    none = np.array([], int)
    assert len(rolling.written(none, none, none, none)) == 0


def test_items_of_the_digest():
    days = np.array([-1, 0, 19_782])
    recorded = np.array([-1, 86_399_000_000, 19_783 * 86_400_000_000 + 45_296_001_500])
    got = [x.decode() for x in rolling.input_items(days, recorded)]
    assert got == ["1969-12-31@1969-12-31T23:59:59.999999+00:00", "1970-01-01@1970-01-01T23:59:59+00:00", "2024-02-29@2024-03-01T12:34:56.001500+00:00"]


def test_long_corrections_reach_all_later_states():
    """a correction of the first date seen at the last one gives the row of series that held it from the start."""
    n = 70
    days, close = np.arange(n), 50 + np.random.default_rng(8).normal(0, 5, n).round(2)
    bars = lambda c: np.column_stack([c + 1, c - 1, c, np.arange(1, n + 1)])
    late = np.append(close, 61.5), np.append(days, 0), np.append(days * 10, (n - 1) * 10), np.arange(n + 1)
    values = np.vstack([bars(close), [62.5, 60.5, 61.5, 1]])
    items = [b"%d" % i for i in range(n + 1)]
    ((corrected, counts, prints),) = rolling.scan_series([days], [days * 10], [late[1]], [late[2]], [late[3]], [values], [items])
    whole = close.copy()
    whole[0] = 61.5
    ((held, _, _),) = rolling.scan_series([days], [days * 10], [days], [days * 10], [days], [bars(whole)], [items[:n]])
    np.testing.assert_array_equal(corrected[-1], held[-1])
    assert not np.array_equal(corrected[-2], held[-2], equal_nan=True)
    assert counts == list(range(1, n + 1))
    assert prints[-1] == hashlib.sha256(b",".join([b"70", *items[1:n]])).hexdigest()
