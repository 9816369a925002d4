"""What a review of the third round found."""

import datetime as dt
import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import rounding, scalar
from tidemark.operators import append, derived, incremental, metrics, pit, rolling, sizes, spans, validate, valuation
from tidemark.plans import queries_derived, queries_metrics
from tidemark.sources import payloads

D, T = dt.date, dt.datetime


def test_bounds_and_places_are_compared_exactly(spark):
    """Beside a decimal of 38 whole digits 99999.69 was rounded to 100000."""
    x = spark.createDataFrame([(Decimal("99999.690"),), (Decimal("100000.000"),)], "price decimal(20,3)")
    got = x.select("price", validate.precision_violation({"price": (5, 2)}).alias("v")).orderBy("price").collect()
    assert [r.v for r in got] == [None, "price_too_large"]
    wide = spark.createDataFrame([(Decimal("1.000001"),), (Decimal("-1.000001"),), (Decimal(1),)], "x decimal(38,6)")
    got = wide.select(validate.precision_violation({"x": (5, 2)}).alias("v"), validate.not_whole("x").alias("w"))
    assert [tuple(r) for r in got.collect()] == [("x_too_precise", True), ("x_too_precise", True), (None, False)]


def test_references_that_were_cut_stay(spark):
    x = spark.createDataFrame([("and&ampp &amp;lt; &copy;&middotx &nosuch; &#65;&#66",)], "h string")
    got = x.select(scalar.html_text("h", terminated=True), scalar.html_text("h")).first()
    assert tuple(got) == ("and&ampp &lt; ©&middotx &nosuch; A&#66", "and&p &lt; ©·x &nosuch; AB")


def test_stock_listed_twice_keeps_both_names(spark):
    decisions = spark.createDataFrame([("1", "span", False), ("2", "span", True)], "stock_id string, decision string, by_lookup boolean")
    today = spark.createDataFrame([("1", "sii", "a", "x"), ("1", "sii", "b", "y")], "stock_id string, market string, name string, industry string")
    look = spark.createDataFrame([("2", "k", "z"), ("2", "l", "z")], "stock_id string, name string, industry string")
    events = spark.createDataFrame([("1", "sii", D(2024, 1, 2), "e")], "stock_id string, market string, on_date date, name string")
    got = spans.company_identity(decisions, today, look, events, events).collect()
    assert sorted(map(tuple, got)) == [("1", "a", "x"), ("1", "b", "y"), ("2", "k", "z"), ("2", "l", "z")]


@pytest.mark.parametrize("flip", [False, True])
def test_stored_rows_of_one_instant_give_one_judgement(spark, flip):
    at = T(2024, 1, 3, 12)
    rows = [("1", T(2024, 1, 1), 5), ("1", at, 0), ("1", at, 1)]
    schema = "k string, recorded_at timestamp_ntz, v int"
    stored = spark.createDataFrame(rows[::-1] if flip else rows, schema).coalesce(1)
    incoming = spark.createDataFrame([("1", T(2024, 1, 4), 0), ("1", T(2024, 1, 4), 1), ("2", T(2024, 1, 4), 1)], schema)
    got = append.ingest_counters(incoming, stored, ["k"], ["v"]).first()
    assert (got.parsed, got.appended, got.new_keys, got.unchanged) == (3, 2, 1, 1)
    judged = append.append_changed(incoming, stored, ["k"], ["v"]).collect()
    assert sorted((r.k, r.v) for r in judged) == [("1", 1), ("2", 1)]


def test_recurrences_of_series_that_cross_batches(spark):
    """Series of unlike lengths, cut by batches of Arrow and by chunks, against each alone."""
    rows = [(str(s), "a", D(2024, 1, 1) + dt.timedelta(i), float((s * 7 + i * i) % 13) if (s + i) % 11 else None) for s in range(9) for i in range(1 + s * 13)]
    bars = spark.createDataFrame(rows, "stock_id string, source string, trade_date date, close double")
    bars = bars.withColumn("rsv", F.coalesce("close", F.lit(5.0)) * 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        got = {(r.stock_id, r.trade_date): r for r in metrics.recurrences(bars).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(rows)
    for s in range(9):
        one = pd.DataFrame([r for r in rows if r[0] == str(s)])
        close, rsv = one[3].astype(float), one[3].astype(float).fillna(5.0) * 7
        k = rsv.ewm(alpha=1 / 3, adjust=False, min_periods=1).mean()
        dif = close.ewm(alpha=2 / 13, adjust=False, min_periods=1).mean() - close.ewm(alpha=2 / 27, adjust=False, min_periods=1).mean()
        rise = close.diff().clip(lower=0).ewm(alpha=1 / 6, adjust=True, min_periods=6).mean()
        fall = (-close.diff()).clip(lower=0).ewm(alpha=1 / 6, adjust=True, min_periods=6).mean()
        for i, day in enumerate(one[2]):
            r = got[str(s), day]
            for a, b in ((r.k, k[i]), (r.macd_dif, dif[i]), (r.rsi6, 100 * rise[i] / (rise[i] + fall[i]) if rise[i] + fall[i] else float("nan"))):
                a = float("nan") if a is None else a
                assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(a) and math.isnan(b)), (s, i, a, b)


def test_chunks_hold_whole_series():
    frames = [pd.DataFrame({"stock_id": list(t), "source": "a"}) for t in ("aab", "bb", "bbcc", "d")]
    cuts = [("".join(x["stock_id"]), begins.tolist()) for x, begins in metrics.whole_series(iter(frames), ("stock_id", "source"), 3)]
    assert cuts == [("aa", [0]), ("bbbbb", [0]), ("cc", [0]), ("d", [0])]
    assert list(metrics.whole_series(iter([]), ("stock_id",))) == []


def test_events_of_a_day_are_multiplied_before_the_scan(spark):
    bars = spark.createDataFrame([("1", "a", D(2024, 1, d), 8.0) for d in (1, 3)], "stock_id string, source string, trade_date date, close double")
    events = spark.createDataFrame([("1", "a", D(2024, 1, 2), f) for f in (0.5, 0.5)], "stock_id string, source string, ex_date date, event_factor double")
    found = metrics.cumulative_factors(bars, events)
    assert [r.factor for r in found.orderBy("trade_date").collect()] == [0.25, 1.0]
    assert "product" in found._jdf.queryExecution().optimizedPlan().toString().split("Union")[1]


def test_series_scanned_together_equal_each_alone():
    """Series of unlike lengths with corrections that reach back by one to forty places."""
    random, given = np.random.default_rng(3), []
    for n in (1, 12, 45, 60):
        days = np.arange(n)
        back = np.minimum(random.integers(0, 41, n), days)
        place = np.concatenate([days, days - back])
        available = np.concatenate([days * 10, days * 10 - 3])
        close = random.integers(1, 50, 2 * n).astype(float)
        values = np.column_stack([close + 1, close - 1, close, close * 3])
        given.append((days, days * 10, place, available, np.arange(2 * n), values, [b"%d" % i for i in range(2 * n)]))
    together = rolling.scan_series(*zip(*given))
    for one, x in zip(given, together):
        ((found, counts, prints),) = rolling.scan_series(*([part] for part in one))
        assert counts == x[1] and prints == x[2]
        np.testing.assert_allclose(x[0], found, rtol=1e-12)


def test_lists_with_many_rows_of_few_stocks_are_dealt(spark):
    """Stocks that both lists have often: all rows are there, and no task has those of most stocks."""
    up = spark.createDataFrame([(str(s), "sii", D(2024, 1, 2), "n", "", "f") for s in range(16)], "stock_id string, market string, on_date date, name string, note string, fetch_id string")
    today = spark.createDataFrame([(str(s), "sii", "n", "i", D(2024, 1, 2)) for s in range(16) for _ in range(20)], "stock_id string, market string, name string, industry string, listed_on date")
    look = spark.createDataFrame([(str(s), "n", "i", "stock", None) for s in range(16) for _ in range(20)], "stock_id string, name string, industry string, category string, registered_on date")
    found = spans.assemble(today, up, up.limit(0), look, F.lit("2024-01-01").cast("date"), ["stock"])
    parts = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(parts) == 16 * 400 and max(parts) < 16 * 400 * 0.7
    assert {r.decision for r in found.collect()} == {"span"}


def test_reach_of_segments_is_one_join(spark):
    """Corrections of earlier dates, against each date's own look at the versions; versions meet their segment once."""
    random = np.random.default_rng(4)
    day, rows = dt.timedelta(days=1), []
    for s in range(3):
        for i in range(12):
            on = T(2024, 1, 1) + i * day
            rows.append((str(s), on.date(), on, on, float(i)))
            for k in range(int(random.integers(0, 3))):
                at = on + int(random.integers(1, 7)) * day + dt.timedelta(minutes=k + 1)
                rows.append((str(s), on.date(), at, at, float(random.integers(50, 99))))
    given = spark.createDataFrame(rows, "k string, d date, recorded_at timestamp_ntz, available_at timestamp_ntz, v double")
    look = lambda x, by: x.withColumn("n", F.sum("v").over(Window.partitionBy(*by).orderBy("d").rowsBetween(-2, 0))).select(*by, "d", "n")
    found = pit.rolling_as_of(given, ["k"], "d", lambda c: c.cast("timestamp_ntz"), look, lookback=3)
    want = {}
    for k, d in {(r[0], r[1]) for r in rows}:
        newest = {}
        for r in sorted((r for r in rows if r[0] == k and r[1] <= d and r[3] <= T(d.year, d.month, d.day)), key=lambda r: r[2]):
            newest[r[1]] = r[4]
        want[k, d] = sum(newest[x] for x in sorted(newest)[-3:])
    assert {(r.k, r.d): r.n for r in found.collect()} == want
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2


def test_residues_join_whole_rows(spark):
    """Rows of one side, nulls and ties, without a row a metric in the join."""
    schema = "stock_id string, source string, trade_date date, x double, y double"
    a = spark.createDataFrame([("1", "a", D(2024, 1, d), float(d), None) for d in (1, 2, 3)], schema)
    b = spark.createDataFrame([("1", "a", D(2024, 1, d), 1.0, None) for d in (1, 2)] + [("2", "a", D(2024, 1, 3), 3.0, None)], schema)
    found = incremental.largest_residues(a, b, ["x", "y"])
    got = {r.metric: (r.residue, tuple(r["at"]), r.differ) for r in found.collect()}
    assert got == {"x": (math.inf, ("2", "a", D(2024, 1, 3)), 3), "y": (0.0, ("2", "a", D(2024, 1, 3)), 0)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    assert incremental.largest_residues(a.limit(0), b.limit(0), ["x"]).count() == 0


KEY = ["stock_id", "source", "trade_date"]


def test_runs_are_dealt_by_their_rows(spark, monkeypatch):
    """a task of a run holds about as many rows as it may, not a share of the table; also where streaks restart."""
    monkeypatch.setattr(sizes, "ROWS_A_TASK", 60)
    day, at = dt.timedelta(days=1), T(2024, 3, 1)
    nets = {(s, i): ((s + i * i) % 7 - 3) or None for s in range(20) for i in range(30)} | {(s, i): 1 for s in (0, 1) for i in range(30)}
    flow = [(str(s), "feed", D(2024, 1, 1) + i * day, T(2024, 1, 1) + i * day, net) for (s, i), net in nets.items()]
    flow += [(str(s), "feed", D(2024, 1, 29), at + day, 2) for s in range(0, 20, 2)]
    flow += [("1", "feed", D(2024, 1, 1), at + day, -1)]
    traded = [(k, "board", d, r, 5) for k, _, d, r, _ in flow if r < at]
    schema = "stock_id string, source string, trade_date date, recorded_at timestamp_ntz, "
    given = {"daily_prices": spark.createDataFrame(traded, schema + "volume bigint"), "institutional_flows": spark.createDataFrame(flow, schema + "net bigint")}
    keys = {name: tuple(KEY) for name in given}
    dataset, since = derived.derived_datasets({"feed": "board"}, {})["institutional_streaks"], F.lit(at)
    whole = derived.run(dataset, given, None, None, since, keys)
    parts = [r["count"] for r in whole.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(parts) == 600 and max(parts) <= 240
    before = {name: x.where(F.col("recorded_at") <= since) for name, x in given.items()}
    stored = derived.run(dataset, before, None, None, since, keys)
    touched = derived.run(dataset, given, stored, since, since + F.expr("interval 1 day"), keys)
    assert max(r["count"] for r in touched.groupBy(F.spark_partition_id()).count().collect()) <= 240
    rows = lambda x: {tuple(r[c] for c in (*KEY, "net_streak_days")) for r in x.collect()}
    assert rows(derived.merged(stored, touched)) == rows(whole) and len(rows(whole)) == 600


def test_ratios_are_compiled(spark):
    """Java leaves methods of more than 8000 bytes to its interpreter."""
    schema = ", ".join(f"{side}_{c} bigint" for side in ("margin", "short") for c in ("balance", "previous_balance", "limit"))
    x = spark.createDataFrame([("1", "a", D(2024, 1, 2), 5, 3, 9, 1, 0, None)], "stock_id string, source string, trade_date date, " + schema)
    found = metrics.margin_metrics(x)
    assert tuple(found.first())[3:] == (55.5556, 2, 66.6667, None, 1, None, 20.0)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    code = found._jdf.queryExecution().explainString(mode)
    assert max(int(part.split(";")[0]) for part in code.split("maxMethodCodeSize:")[1:]) < 8000


def test_only_values_beside_a_half_are_spelled_out(spark):
    random = np.random.default_rng(5)
    halves = (random.integers(-(10**7), 10**7, 500) + 0.5) / 1e4
    near = [v * (1 + k * 2.0**-52) for v in halves for k in (-40, -2, 0, 2, 40)]
    wide = (random.random(2000) - 0.5) * 10.0 ** random.integers(-9, 15, 2000)
    given = [*near, *wide.tolist(), 0.0, -0.0, -0.00004, 0.00005, 1e5, 1e20, -1e300, math.inf, -math.inf, math.nan, None]
    x = spark.createDataFrame([(None if v is None else float(v),) for v in given], "x double")
    exact = F.when(F.abs("x") < 1e15, F.format_string("%.14e", "x")).try_cast("decimal(38,15)")
    spelled = F.coalesce(F.round(exact, 4).cast("double"), "x") + F.lit(0.0)
    for r in x.select("x", rounding.round_15_digits(F.col("x")).alias("a"), spelled.alias("b")).collect():
        assert repr(r.a) == repr(r.b), r.x


def test_corrections_do_not_compute_their_rows_twice(spark):
    """one pass gives the first version of every row and the correction of the late ones."""
    x = spark.createDataFrame([("1", D(2024, 1, 2), 5), ("2", D(2024, 3, 2), 5), ("3", D(2024, 1, 3), None)], "k string, d date, v int")
    found = queries_derived.revised(x, "d", {"v": F.col("v") + 1}, F.col("k") != "3", "2024-02-01 00:00:00")
    want = [("1", D(2024, 1, 2), 5, T(2024, 2, 1, 1)), ("1", D(2024, 1, 2), 6, T(2024, 1, 2, 20))]
    want += [("2", D(2024, 3, 2), 5, T(2024, 3, 2, 21)), ("2", D(2024, 3, 2), 6, T(2024, 3, 2, 20)), ("3", D(2024, 1, 3), None, T(2024, 1, 3, 20))]
    assert sorted(map(tuple, found.collect()), key=lambda r: (r[0], r[3])) == sorted(want, key=lambda r: (r[0], r[3]))
    assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_latest_rows_of_few_numbers_are_not_sorted(spark):
    """nulls of the newest row stay null, an older value doesn't stand for them."""
    rows = [("1", T(2024, 1, 1), 5, 2.5), ("1", T(2024, 1, 3), None, 1.5), ("1", T(2024, 1, 2), 7, None), ("2", T(2024, 1, 1), None, None)]
    found = pit.latest_per_key(spark.createDataFrame(rows, "k string, recorded_at timestamp_ntz, a int, b double"), ["k"])
    assert sorted(map(tuple, found.collect())) == [("1", T(2024, 1, 3), None, 1.5), ("2", T(2024, 1, 1), None, None)]
    assert "Sort" not in found._jdf.queryExecution().sparkPlan().toString()


def test_days_of_stocks_without_quarters_stay_out_of_the_window(spark):
    """F16: they have no row; those of other stocks are as before."""
    days = spark.createDataFrame([(s, "a", D(2024, 6, d), 9.0) for s in ("1", "2") for d in (3, 4)], "stock_id string, source string, trade_date date, close double")
    quarters = spark.createDataFrame([("1", q, D(2024, 1, q), 1, 1, 1) for q in (1, 2, 3, 4)], "stock_id string, q int, published_on date, eps bigint, income bigint, equity bigint")
    found = valuation.trailing(days, quarters)
    assert sorted((r.stock_id, r.trade_date, r.ttm_eps) for r in found.collect()) == [("1", D(2024, 6, d), 4) for d in (3, 4)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan.split("Window", 1)[1]


def test_wide_levels_need_no_shuffle_of_their_own(spark):
    """rows that are dealt by stock stay where they are. Levels that come twice, unknown and missing ones, and nulls."""
    rows = [("1", 1, 5, 6), ("1", 1, 7, None), ("1", 16, 2, 3), ("1", 16, None, 4), ("1", 17, 9, 8), ("2", None, 1, 1), ("2", 18, 1, 1), ("3", 16, None, 1)]
    x = spark.createDataFrame([(k, lv, h, s, None if s is None else Decimal(s)) for k, lv, h, s in rows], "k string, level int, holders bigint, shares bigint, percent decimal(5,2)")
    found = payloads.long_to_wide_levels(sizes.clustered(x, ["k"]), ["k"])
    got = {r.k: (r.holders_1, r.shares_1, r.percent_1, r.adjustment_shares, r.adjustment_percent, r.total_holders, r.dropped_holder_counts) for r in found.collect()}
    assert got == {"1": (7, 6, 6, -4, -4, 9, 1), "2": (None,) * 6 + (0,), "3": (None, None, None, -1, -1, None, 0)}
    assert len(found.columns) == 52 and dict(found.dtypes)["percent_15"] == "decimal(5,2)"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = payloads.long_to_wide_levels(sizes.clustered(x, ["k"]), ["k"])
        assert again._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_levels_and_wide_rows_share_one_shuffle(spark):
    """lines are dealt by stock once, for the levels and for the wide rows."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        levels = queries_metrics.levels(spark, "/root/testdata/sf0.001")
        wide = payloads.long_to_wide_levels(levels, ["stock_id", "source", "snapshot_date"])
        assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
