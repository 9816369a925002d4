"""Hand-made scenarios whose answers are known, and plain restatements of the recurrences."""

import datetime as dt
import hashlib
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.datasets import OBSERVED, dataset
from tidemark.functions import instants, scalar
from tidemark.operators import append, derived, incremental, metrics, panel, pit, reads, reconcile, rolling, spans, validate, valuation
from tidemark.sources import payloads, tables

D, T = dt.date, dt.datetime
KEY = ["stock_id", "source", "trade_date"]
SERIES = ["stock_id", "source"]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def versions(spark, rows):
    """(day of January 2024, recorded_at, close)"""
    return spark.createDataFrame(
        [("1", "a", D(2024, 1, d), r, float(c)) for d, r, c in rows],
        "stock_id string, source string, trade_date date, recorded_at timestamp_ntz, close double",
    )


def test_visibility_of_provisional_settled_and_correction(spark):
    released = T(2024, 1, 2, 19)
    v = versions(
        spark, [(2, released - dt.timedelta(hours=1), 1), (2, released, 2), (2, released + dt.timedelta(days=3), 3)]
    )
    a = pit.with_available_at(v, KEY, "trade_date", instants.exchange_daily_settled)
    assert [r.available_at for r in a.orderBy("recorded_at").collect()] == [
        released, released, released + dt.timedelta(days=3)
    ]

    def seen(info, know="2100-01-01"):
        return [r.close for r in pit.market_pit(a, KEY, ts(str(info)), ts(know)).collect()]

    second = dt.timedelta(seconds=1)
    assert seen(released - second) == [] and seen(released) == [2.0]
    late = released + dt.timedelta(days=3)
    assert seen(late - second) == [2.0] and seen(late) == [3.0]
    assert seen(late, str(released - second)) == [1.0] and seen(late, str(released)) == [2.0]
    assert pit.system_pit(v, KEY, ts(str(released - second))).first().close == 1.0


def test_retraction_hides_the_key(spark):
    rows = [
        ("1", "a", D(2024, 3, 5), T(2024, 3, 1), 1.0, False),
        ("1", "a", D(2024, 3, 5), T(2024, 3, 3), 1.0, True),
        ("1", "a", D(2024, 3, 7), T(2024, 3, 6, 16), 2.0, False),
        ("1", "a", D(2024, 3, 7), T(2024, 3, 9), 2.0, True),
    ]
    v = spark.createDataFrame(
        rows, "stock_id string, source string, ex_date date, recorded_at timestamp_ntz, x double, retracted boolean"
    )
    key = ["stock_id", "source", "ex_date"]
    a = pit.with_available_at(v, key, "ex_date", instants.ex_date_midnight)
    see = lambda at: [
        r.ex_date.day for r in pit.market_pit(a, key, ts(at), ts("2100-01-01"), hidden="retracted").collect()
    ]
    assert see("2024-03-05 00:00:00") == [] and see("2024-03-08 00:00:00") == [7] and see("2024-03-10 00:00:00") == []


def test_unpublished_first_row_and_later_correction(spark):
    rows = [
        ("1", T(2024, 1, 1), None, 1), ("1", T(2024, 2, 1), T(2024, 1, 5), 2), ("2", T(2024, 1, 1), T(2023, 12, 30), 1)
    ]
    v = spark.createDataFrame(rows, "stock_id string, recorded_at timestamp_ntz, published_at timestamp_ntz, x int")
    got = {(r.stock_id, r.x): r.available_at for r in pit.with_published_at(v, ["stock_id"]).collect()}
    assert got == {("1", 1): None, ("1", 2): T(2024, 2, 1), ("2", 1): T(2023, 12, 30)}


def test_rolling_as_of_equals_recomputing_every_date(spark):
    r = random.Random(2)
    rows = []
    for d in range(1, 29):
        rows.append((d, T(2024, 1, d, 20), r.randint(1, 99)))
        for _ in range(r.choice([0, 0, 1, 2])):
            rows.append((d, T(2024, 1, d, 20) + dt.timedelta(hours=r.randint(1, 300)), r.randint(1, 99)))
    rows = list({(d, t): (d, t, c) for d, t, c in rows}.values())
    a = pit.with_available_at(versions(spark, rows), KEY, "trade_date", instants.exchange_daily_settled)
    got = {
        x.trade_date.day: x.s
        for x
        in pit.rolling_as_of(
            a,
            SERIES,
            "trade_date",
            instants.exchange_daily_settled,
            lambda df, by: metrics.cumulative_flow(df, "close", by, "trade_date", "s").select(*by, "trade_date", "s"),
        ).collect()
    }
    avail = a.collect()
    for d in range(1, 29):
        cutoff = T(2024, 1, d, 19)
        latest = {}
        for x in sorted(avail, key=lambda x: x.recorded_at):
            if x.trade_date.day <= d and x.available_at <= cutoff:
                latest[x.trade_date] = x.close
        assert got[d] == sum(latest.values())
    segments = pit.rolling_segments(a, SERIES, "trade_date", instants.exchange_daily_settled)
    assert 1 < segments.agg(F.max("segment")).first()[0] < 28


def test_weekly_rule_waits_from_a_sunday(spark):
    d = spark.createDataFrame([(D(2024, 1, 6),), (D(2024, 1, 7),)], "d date")
    assert [
        r[0] for r in d.select(instants.weekly_sunday_noon(F.col("d"))).collect()
    ] == [T(2024, 1, 7, 4), T(2024, 1, 14, 4)]


def plain_ewm(values, alpha, adjust, min_periods):
    """Weights (1 - alpha)^age over observations; without adjustment the first observation keeps the whole remaining
    weight."""
    out, seen = [], 0
    for i, v in enumerate(values):
        seen += v is not None
        points = [(j, x) for j, x in enumerate(values[: i + 1]) if x is not None]
        if seen < min_periods or not points:
            out.append(None)
            continue
        if adjust:
            weights = [(1 - alpha) ** (i - j) for j, _ in points]
            out.append(sum(w * x for w, (_, x) in zip(weights, points)) / sum(weights))
        else:
            mean, last = points[0][1], points[0][0]
            for j, x in points[1:]:
                old = (1 - alpha) ** (j - last)
                mean, last = (old * mean + alpha * x) / (old + alpha), j
            out.append(mean)
    return out


def test_indicators_equal_plain_restatement(spark):
    r = random.Random(6)
    close = [None if r.random() < 0.15 else round(50 + r.gauss(0, 5), 2) for _ in range(60)]
    close[30:45] = [20.0] * 15
    rows = [
        (
            "1",
            "a",
            D(2024, 1, 1) + dt.timedelta(days=i),
            None if c is None else c + 1.0,
            None if c is None else c - 1.0,
            c,
            i + 1,
        )
        for i, c in enumerate(close)
    ]
    bars = spark.createDataFrame(
        rows, "stock_id string, source string, trade_date date, high double, low double, close double, volume bigint"
    )
    got = metrics.technical_panel(bars).orderBy("trade_date").collect()

    def same(name, want):
        for g, w in zip(got, want):
            v = g[name]
            v = None if v is None or math.isnan(v) else v
            assert (v is None) == (w is None) and (w is None or v == pytest.approx(w, abs=1e-9)), name

    rsv = []
    for i in range(60):
        span = close[i - 8 : i + 1] if i >= 8 else []
        if i < 8 or None in span or max(span) + 1 == min(span) - 1:
            rsv.append(50.0)
        else:
            rsv.append((close[i] - min(span) + 1) / (max(span) + 1 - min(span) + 1) * 100)
    k = plain_ewm(rsv, 1 / 3, False, 1)
    same("k", k)
    same("d", plain_ewm(k, 1 / 3, False, 1))
    fast, slow = plain_ewm(close, 2 / 13, False, 1), plain_ewm(close, 2 / 27, False, 1)
    dif = [None if a is None or b is None else a - b for a, b in zip(fast, slow)]
    same("macd_dif", dif)
    same("macd_dea", plain_ewm(dif, 0.2, False, 1))
    for n in (6, 12):
        up = [None] + [None if a is None or b is None else max(b - a, 0.0) for a, b in zip(close, close[1:])]
        down = [None] + [None if a is None or b is None else max(a - b, 0.0) for a, b in zip(close, close[1:])]
        g, l = plain_ewm(up, 1 / n, True, n), plain_ewm(down, 1 / n, True, n)
        same(
            f"rsi{n}",
            [
                None if a is None or b is None else (None if a == 0 else 100.0) if b == 0 else 100 - 100 / (1 + a / b)
                for a, b in zip(g, l)
            ],
        )
    ma = [sum(close[i - 4 : i + 1]) / 5 if i >= 4 and None not in close[i - 4 : i + 1] else None for i in range(60)]
    same("ma5", ma)
    # Causality: a later input changes no earlier value.
    cut = metrics.technical_panel(bars.where("trade_date < date'2024-02-10'")).orderBy("trade_date").collect()
    assert [str(x) for x in cut] == [str(x) for x in got[: len(cut)]]


def test_adjustment_poison_same_day_and_anchor(spark):
    bars = spark.createDataFrame(
        [("1", "a", D(2024, 1, d), 10.0) for d in range(1, 8)],
        "stock_id string, source string, trade_date date, close double",
    )
    ev = lambda rows: spark.createDataFrame(
        [("1", "a", D(2024, 1, d), f) for d, f in rows],
        "stock_id string, source string, ex_date date, event_factor double",
    )
    factors = lambda rows: [
        r.factor for r in metrics.cumulative_factors(bars, ev(rows)).orderBy("trade_date").collect()
    ]
    assert factors([(3, 0.5), (3, 0.8), (6, 0.9), (20, 0.1)]) == pytest.approx([0.36, 0.36, 0.9, 0.9, 0.9, 1, 1])
    assert factors([(3, 0.5), (5, None)]) == [None, None, None, None, 1.0, 1.0, 1.0]
    assert factors([]) == [1.0] * 7


def test_quarters_without_third_and_late_third(spark):
    reports, facts = [], []
    for i, (year, q, on) in enumerate(
        [
            (2023, 1, D(2023, 5, 1)),
            (2023, 2, D(2023, 8, 1)),
            (2023, 3, D(2024, 5, 1)),
            (2023, 4, D(2024, 3, 1)),
            (2022, 4, D(2023, 3, 1)),
        ]
    ):
        reports.append((i, "1", year, q, "consolidated", T(on.year, on.month, on.day), T(on.year, on.month, on.day)))
        end = D(year, q * 3, {1: 31, 2: 30, 3: 30, 4: 31}[q])
        facts += [
            (i, "income_statement", "9750", D(year, q * 3 - 2, 1), end, 1),
            (i, "income_statement", "9750", D(year, 1, 1), end, q),
            (i, "balance_sheet", "31XX", None, end, 100),
        ]
    r = spark.createDataFrame(
        reports,
        "id bigint, stock_id string, report_year int, report_quarter int, report_category string, published_at timestamp_ntz, recorded_at timestamp_ntz",
    )
    f = spark.createDataFrame(
        facts,
        "report_id bigint, statement string, account_code string, period_start date, period_end date, value bigint",
    )
    quarters = valuation.quarter_values(valuation.report_inputs(r, f))
    got = {(x.report_year, x.report_quarter): (x.eps, x.published_on) for x in quarters.collect()}
    assert got[2022, 4][0] is None and got[2023, 4] == (1, D(2024, 5, 1)) and got[2023, 1] == (1, D(2023, 5, 1))
    days = spark.createDataFrame(
        [("1", "a", D(2024, 4, 1), 8.0), ("1", "a", D(2024, 5, 1), 8.0), ("1", "a", D(2024, 5, 2), None)],
        "stock_id string, source string, trade_date date, close double",
    )
    v = valuation.valuation_metrics(days, quarters).orderBy("trade_date").collect()
    assert [(x.trade_date, x.ttm_eps, x.pe_ratio) for x in v][0] == (D(2024, 5, 1), 4.0, 2.0) and len(v) == 2


def test_quarters_of_filings_with_comparatives_and_other_statements(spark):
    """Equity is the quarter's last day's, earnings are the income statement's; two values of one fact are none."""
    on, end, closed = T(2020, 5, 1), D(2020, 3, 31), D(2019, 12, 31)
    reports = [(1, "1", 2020, 1, "consolidated", on, on), (2, "2", 2020, 1, "individual", on, on)]
    facts = [
        (1, "balance_sheet", "31XX", None, end, 100),
        (1, "balance_sheet", "31XX", None, closed, 90),
        (1, "statement_of_equity", "31XX", None, end, 80),
        (1, "income_statement", "8610", D(2020, 1, 1), end, 5),
        (1, "income_statement", "8610", D(2019, 1, 1), D(2019, 3, 31), 4),
        (1, "cash_flow_statement", "8610", D(2020, 1, 1), end, 7),
        (2, "balance_sheet", "3XXX", None, end, 100),
        (2, "balance_sheet", "3XXX", None, end, 101),
        (2, "income_statement", "8200", D(2020, 1, 1), end, 6),
        (2, "income_statement", "8610", D(2020, 1, 1), end, 9),
    ]
    r = spark.createDataFrame(
        reports,
        "id bigint, stock_id string, report_year int, report_quarter int, report_category string, published_at timestamp_ntz, recorded_at timestamp_ntz",
    )
    f = spark.createDataFrame(
        facts,
        "report_id bigint, statement string, account_code string, period_start date, period_end date, value bigint",
    )
    got = {x.stock_id: (x.income, x.equity) for x in valuation.quarter_values(valuation.report_inputs(r, f)).collect()}
    assert got == {"1": (5, 100), "2": (6, None)}


def test_append_keeps_a_b_a(spark):
    stored = spark.createDataFrame(
        [("k", T(2024, 1, 1), 1), ("k", T(2024, 1, 2), 2)], "k string, recorded_at timestamp_ntz, v int"
    )
    incoming = spark.createDataFrame(
        [("k", T(2024, 1, 3), 1), ("n", T(2024, 1, 3), None)], "k string, recorded_at timestamp_ntz, v int"
    )
    assert {r.k for r in append.append_changed(incoming, stored, ["k"], ["v"]).collect()} == {"k", "n"}
    assert append.append_changed(incoming.where("k = 'k'").withColumn("v", F.lit(2)), stored, ["k"], ["v"]).count() == 0


def test_period_end_is_hidden_until_public(spark):
    s = spark.createDataFrame(
        [("1", "sii", D(2020, 1, 1), None)], "stock_id string, market string, listed_on date, delisted_on date"
    )
    changes = spark.createDataFrame(
        [
            ("1", "n", "sii", D(2023, 7, 1), D(2023, 6, 20), "01", "02", T(2023, 6, 20, 17)),
            ("1", "n", "sii", D(2023, 7, 1), D(2023, 6, 20), "01", "03", T(2023, 6, 25)),
        ],
        "stock_id string, source string, market string, effective_date date, announced_on date, old_industry string, new_industry string, recorded_at timestamp_ntz",
    )
    none = spark.createDataFrame(
        [], "stock_id string, market string, listed_on date, delisted_on date, anchor_code string, anchor_on date"
    )
    cats = spark.createDataFrame(
        [(c, "sii", None, None, D(2021, 1, 1) if c == "01" else None) for c in ("01", "02", "03")],
        "code string, market string, valid_from date, valid_to date, renamed_on date",
    )
    v = spans.change_versions(changes)

    def see(at):
        p = spans.category_periods(s, v, none, cats, ts(at), ts("2100-01-01"), ts("2020-12-01"))
        return [
            (r.industry_code, r.basis, r.effective_from, r.effective_to) for r in p.orderBy("effective_from").collect()
        ]

    assert see("2023-06-19 00:00:00") == [
        ("01", "before_change", D(2020, 1, 1), D(2021, 1, 1)), ("01", "rename", D(2021, 1, 1), None)
    ]
    assert see("2023-06-21 00:00:00")[-1] == ("02", "change", D(2023, 7, 1), None)
    assert see("2023-06-26 00:00:00")[-2:] == [
        ("01", "rename", D(2021, 1, 1), D(2023, 7, 1)), ("03", "change", D(2023, 7, 1), None)
    ]


def test_tolerance(spark):
    row = spark.createDataFrame([(1.0, 1.0 + 5e-7, 100.0, None)], "a double, b double, s double, n double")
    c = [F.col(x) for x in "absn"]
    got = row.select(
        incremental.within_tolerance("k", c[0], c[1], c[2]),
        incremental.within_tolerance("ma5", c[0], c[1], c[2]),
        incremental.within_tolerance("macd_dif", c[0], c[1], c[2]),
        incremental.within_tolerance("ma5", c[3], c[3], c[2]),
        incremental.within_tolerance("k", c[0], c[3], c[2]),
    ).first()
    assert list(got) == [True, False, True, True, False]


def test_table_sinks(spark, tmp_path):
    schema = dataset("industry_observations").schema
    rows = spark.createDataFrame(
        [("1", "a", D(2024, 1, 2), "01"), ("2", "a", D(2024, 1, 5), "02")],
        "stock_id string, source string, trade_date date, industry_code string",
    )
    tables.append_rows(rows, str(tmp_path), "industry_observations", "2024-01-06 00:00:00", "f1")
    tables.append_rows(rows.limit(1), str(tmp_path), "industry_observations", "2024-01-07 00:00:00", "f2")
    back = tables.read_table(spark, str(tmp_path), "industry_observations", "2024-01-01", "2024-01-03")
    assert back.count() == 2 and [f.name for f in back.schema] == [f.name for f in schema]
    assert "PushedFilters" in back._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        dataset("nothing")
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path), "industry_observations", "2024-02-01", "2024-01-01")
    assert all(set(d.keys) <= set(d.schema.names) for d in OBSERVED.values())
    path = f"{tmp_path}/derived"
    many = spark.createDataFrame(
        [(str(k), "a", D(2024, 1, d), k * d) for k in range(40) for d in (1, 2)], "stock_id string, source string, trade_date date, v int"
    )
    tables.overwrite_series(many, path, "trade_date", 8)
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "derived").rglob("*.parquet")}
    assert len(files) == 8
    fresh = tables.read_series(spark, path).where("stock_id = '7'").withColumn("v", F.lit(-1))
    tables.overwrite_series(fresh.where("trade_date = '2024-01-02'"), path, "trade_date", 8)
    back = {(r.stock_id, r.trade_date.day): r.v for r in tables.read_series(spark, path).collect()}
    want = {(str(k), d): k * d for k in range(40) for d in (1, 2) if k != 7} | {("7", 2): -1}
    assert back == want
    after = set((tmp_path / "derived").rglob("*.parquet"))
    assert len(after) == 8 and len(after & set(files)) == 7
    tables.overwrite_series(many.limit(0), path, "trade_date", 8)
    assert tables.read_series(spark, path).count() == len(want)


def test_refusals(spark):
    one = spark.createDataFrame([("x", D(2024, 1, 1), 1), ("x", D(2024, 1, 1), 2)], "k string, d date, v int")
    with pytest.raises(Exception, match="two rows"):
        panel.align(one.select("k", "d").distinct(), {"a": one}, ["k", "d"]).collect()
    with pytest.raises(Exception, match="not finite"):
        tables.export_json(spark.sql("select double('NaN') as x")).collect()
    with pytest.raises(Exception, match="unknown institution"):
        panel.flow_panel(
            spark.createDataFrame(
                [("s", D(2024, 1, 1), "moon", 1)], "source string, trade_date date, institution string, net int"
            ),
            ["a"],
        ).collect()


def test_html_and_subjects(spark):
    page = spark.createDataFrame(
        [(1, "<table><tr><th>h</th></tr><tr><td>a<br>b</td><td>1&amp;2</td></tr><tr><td>x</td></tr></table>")],
        "page_id int, html string",
    )
    got = payloads.html_table_rows(page, "page_id", cells=2).orderBy("row_no").collect()
    assert [(r.cells, r.violation) for r in got] == [(["a\nb", "1&2"], None), (["x"], "cell_count")]
    odd = spark.createDataFrame(
        [(1, "<tr><td>&#12288;x&#x4E2D;</td><td></td></tr><tr></tr>")], "page_id int, html string"
    )
    assert [r.cells for r in payloads.html_table_rows(odd, "page_id").orderBy("row_no").collect()] == [["x中", ""], []]
    texts = ["&#12288;a&mdash;b&nbsp;", "x &amp;lt; &copy y", "<p>one</p>two<br/>", None, "plain"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(scalar.html_text(F.col("t"))).collect()
    assert [r[0] for r in got] == ["a—b", "x &lt; © y", "one\ntwo", None, "plain"]
    subjects = {
        "修正要點": "regulation",
        "興櫃公司": "out_of_scope",
        "上櫃及興櫃": "change",
        "創櫃板": "out_of_scope",
        "上（興）櫃": "change",
        "產業類別": "change",
    }
    s = spark.createDataFrame([(t,) for t in subjects], "s string")
    assert [r[0] for r in s.select(payloads.subject_class(F.col("s"))).collect()] == list(subjects.values())


def test_amounts(spark):
    cases = {
        ("12.5", None, -2): (0.125, False),
        ("(1,234)", None, 3): (-1234000.0, False),
        ("5", "-", None): (-5.0, False),
        ("(5)", "-", None): (None, True),
        ("(5)", "+", None): (None, True),
        ("5", "+", 0): (None, True),
        ("-", None, None): (None, False),
        ("n/a", "+", None): (None, False),
        ("see note", None, 1): (None, False),
        ("a long narrative", None, 1): (None, True),
        ("NaN", None, None): (None, True),
        ("Infinity", None, None): (None, True),
        ("1 000", None, 0): (1000.0, False),
        ("0.000001", None, -6): (1e-12, False),
        ("1e30", None, None): (None, True),
        ("9" * 26, None, 6): (None, True),
        ("9" * 26, None, 0): (float("9" * 26), False),
        ("0.0000000000001", None, 0): (None, True),
        ("0.0000000000001", None, 1): (1e-12, False),
        ("1.50e-11", None, 0): (1.5e-11, False),
        ("1000", None, -15): (1e-12, False),
        ("1.0000000000000", None, 0): (1.0, False),
        ("0e900000", None, 0): (0.0, False),
        (".5", "-", 1): (-5.0, False),
    }
    rows = spark.createDataFrame(list(cases), "t string, s string, p int")
    got = rows.select(scalar.accounting_amount(F.col("t"), F.col("s"), F.col("p")).alias("a")).select("a.*").collect()
    assert [(None if r.value is None else float(r.value), r.bad) for r in got] == list(cases.values())


def test_truncation_is_judged_by_file(spark):
    rows = [("f1", c, i, lv) for i, c in enumerate("ab") for lv in range(1, 18) if not (c == "b" and lv > 9)]
    rows += [("f2", c, i, lv) for i, c in enumerate("xyz") for lv in range(1, 18) if not (c == "y" and lv == 3)]
    levels = spark.createDataFrame(
        [(f, c, i, lv, 1, 1, 5.0) for f, c, i, lv in rows],
        "file string, code string, at int, level int, holders int, shares int, percent double",
    )
    got = {
        r.code: (r.violation, r.truncated)
        for r in validate.level_completeness(levels, ["file", "code"], "at", file=["file"]).collect()
    }
    assert got == {
        "a": (None, True),
        "b": ("missing_level", True),
        "x": (None, False),
        "y": ("missing_level", False),
        "z": (None, False),
    }


def test_lineage_to_the_microsecond(spark):
    import hashlib

    at = [T(2024, 1, 2, 20), T(2024, 1, 3, 20, 0, 0, 800000), T(2024, 1, 4, 20, 0, 0, 1)]
    v = versions(spark, [(d, r, 1) for d, r in zip((2, 3, 4), at)])
    got = pit.with_lineage(v, SERIES, "trade_date").orderBy("trade_date").collect()
    for n, r in enumerate(got, 1):
        text = ",".join(f"{D(2024, 1, d)}@{t.isoformat()}+00:00" for d, t in list(zip((2, 3, 4), at))[:n])
        assert (r.input_count, r.input_fingerprint) == (n, hashlib.sha256(text.encode()).hexdigest())
    assert set(got[0].asDict()) == {*v.columns, "input_count", "input_fingerprint"}


def test_announcements(spark):
    text = "公告：代號8000由「K」改為「L」\n一、某公司（代號：1234A）由「甲」調整為「乙」，實施日期：109年2月1日\n二、興櫃公司：\n代號9999由「A」改為「B」\n三、9998 由 A 改為 B"
    two = "自109年2月1日起實施，實施日期：109年3月1日，代號 12349B 由「甲」改為「乙」"
    whole = "興櫃公司 代號1111由「A」改為「B」實施日期：109年2月1日"
    notices = spark.createDataFrame([(1, text), (2, two), (3, whole), (4, None)], "n int, text string")
    got = sorted(
        (r.n, r.stock_id, r.old_industry, r.new_industry, r.effective_date, r.violation)
        for r in payloads.announcement_changes(notices, "n").collect()
    )
    assert got == [
        (1, "1234A", "甲", "乙", D(2020, 2, 1), None),
        (1, "8000", "K", "L", D(2020, 2, 1), None),
        (2, "12349B", "甲", "乙", None, "effective_date_not_unique"),
    ]
    assert payloads.announcement_changes(notices, "n", scoped=False).count() == 5


def test_append_stream(spark, tmp_path):
    from tidemark.streaming.append import append_changed_stream

    schema = "k string, recorded_at timestamp_ntz, v int"
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for n, (v, day) in enumerate([(1, 1), (1, 2), (2, 3), (1, 4)]):
        spark.createDataFrame([("k", T(2024, 1, day), v)], schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        append_changed_stream(stream, out, f"{tmp_path}/chk", ["k"], ["v"]).awaitTermination()
    got = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out)
    assert [r.v for r in got.orderBy("recorded_at").collect()] == [1, 2, 1]


@pytest.mark.parametrize("cuts", [(6,), (1, 1, 1, 1, 1, 1), (2, 1, 3)])
def test_append_stream_is_the_same_however_it_is_cut(spark, tmp_path, cuts):
    from tidemark.streaming.append import append_changed_stream

    schema = "k string, recorded_at timestamp_ntz, v int"
    rows = [("k", T(2024, 1, d), v) for d, v in enumerate((1, 2, 1, 1, None, None), 1)]
    src, out, at = f"{tmp_path}/in", f"{tmp_path}/out", 0
    for n in cuts:
        batch = [*rows[at : at + n], ("z", T(2024, 1, at + 1), 3)]
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        append_changed_stream(stream, out, f"{tmp_path}/chk", ["k"], ["v"]).awaitTermination()
        at += n
    got = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out).orderBy("k", "recorded_at")
    assert [(r.k, r.recorded_at.day, r.v) for r in got.collect()] == [
        ("k", 1, 1), ("k", 2, 2), ("k", 3, 1), ("k", 5, None), ("z", 1, 3)
    ]


def test_append_stream_replays_a_batch(spark, tmp_path):
    """A batch whose commit is lost is run again: nothing is lost or repeated. A new checkpoint can't overwrite
    batches."""
    from tidemark.streaming.append import append_changed_stream

    schema = "k string, recorded_at timestamp_ntz, v int"
    src, out, chk = f"{tmp_path}/in", f"{tmp_path}/out", tmp_path / "chk"
    for key, v, day in [("x", 1, 1), ("y", 5, 2)]:
        spark.createDataFrame([(key, T(2024, 1, day), v)], schema).coalesce(1).write.mode("append").parquet(src)
        append_changed_stream(
            spark.readStream.schema(schema).parquet(src), out, str(chk), ["k"], ["v"]
        ).awaitTermination()
    read = lambda path: sorted((r.k, r.v) for r in spark.read.schema(schema).parquet(path).collect())
    assert read(out) == [("x", 1), ("y", 5)]
    for batch in (1, 0):
        for name in (f"{batch}", f".{batch}.crc"):
            if (chk / "commits" / name).exists():
                (chk / "commits" / name).unlink()
        append_changed_stream(
            spark.readStream.schema(schema).parquet(src), out, str(chk), ["k"], ["v"]
        ).awaitTermination()
        assert read(out) == [("x", 1), ("y", 5)]
    with pytest.raises(ValueError, match="another checkpoint"):
        append_changed_stream(spark.readStream.schema(schema).parquet(src), out, f"{tmp_path}/new", ["k"], ["v"])
    more = f"{tmp_path}/more"
    spark.createDataFrame([("x", T(2024, 1, 9), 1), ("y", T(2024, 1, 9), 6)], schema).write.parquet(more)
    append_changed_stream(
        spark.readStream.schema(schema).parquet(more), f"{tmp_path}/out2", f"{tmp_path}/new", ["k"], ["v"], base=out
    ).awaitTermination()
    assert read(f"{tmp_path}/out2") == [("y", 6)]


def test_request_contexts():
    utc, taipei = dt.UTC, dt.timezone(dt.timedelta(hours=8))
    arrived = T(2024, 6, 1, tzinfo=utc)
    assert reads.context(arrived) == reads.Market(arrived, arrived)
    assert reads.context(arrived, information_as_of="2024-05-01T08:00:00+08:00") == reads.Market(
        T(2024, 5, 1, tzinfo=utc), arrived
    )
    assert reads.context(
        arrived, system_as_of=T(2024, 5, 1, 8, tzinfo=taipei)
    ) == reads.System(T(2024, 5, 1, tzinfo=utc))
    assert reads.context(arrived, knowledge_as_of="latest") == reads.Market(arrived, arrived)
    for bad, message in (
        ({"information_as_of": "2024-05-01"}, "offset"),
        ({"system_as_of": T(2024, 5, 1)}, "offset"),
        ({"when": "now"}, "unknown"),
        ({"knowledge_as_of": "soon"}, "ISO"),
    ):
        with pytest.raises(ValueError, match=message):
            reads.context(arrived, **bad)
    with pytest.raises(ValueError, match="combined"):
        reads.context(arrived, system_as_of="now", knowledge_as_of="now")


def test_reads_by_name(spark, tmp_path):
    schema = dataset("industry_changes").schema
    rows = [
        ("1", "n", D(2024, 3, 1), T(2024, 2, 1), D(2024, 1, 31), "d", "01", "02", None, "f"),
        ("2", "n", D(2024, 4, 1), T(2024, 2, 2), D(2024, 2, 1), "d", "01", "03", None, "f"),
    ]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/industry_changes")
    arrived = T(2024, 6, 1, tzinfo=dt.UTC)
    see = lambda at, **k: [
        r.stock_id
        for r in reads.visible_rows(spark, str(tmp_path), "industry_changes", at, **k).orderBy("stock_id").collect()
    ]
    assert see(reads.context(arrived)) == ["1", "2"] and see(reads.context(arrived), stock_ids=["2"]) == ["2"]
    assert see(reads.context(arrived, information_as_of="2024-02-01T00:00:00+08:00")) == ["1"]
    assert see(reads.context(arrived, system_as_of="2024-02-01T12:00:00Z")) == ["1"]
    assert see(reads.context(arrived), start=D(2024, 2, 1)) == ["2"]
    with pytest.raises(ValueError, match="no index_name"):
        see(reads.context(arrived), index_names=["x"])
    with pytest.raises(ValueError, match="after end"):
        see(reads.context(arrived), start=D(2024, 2, 1), end=D(2024, 1, 1))
    with pytest.raises(ValueError, match="unknown dataset"):
        reads.visible_rows(spark, str(tmp_path), "nothing", reads.context(arrived))
    technical = derived.derived_datasets({}, {})["technical_indicators"]
    with pytest.raises(ValueError, match="earlier cutoff"):
        reads.derived_rows(
            spark.range(1), technical, {}, reads.context(arrived, knowledge_as_of="2024-05-01T00:00:00Z"), arrived
        )


def test_rolling_panel_equals_recomputing_every_segment(spark):
    r = random.Random(9)
    rows = []
    for d in range(60):
        day = D(2024, 1, 1) + dt.timedelta(days=d)
        at = T(day.year, day.month, day.day, 18)
        for extra in [0, *[r.randint(1, 900) for _ in range(r.choice([0, 0, 0, 1, 2]))]]:
            close = None if r.random() < 0.1 else round(50 + r.gauss(0, 5), 2)
            rows.append(
                (
                    "1",
                    "a",
                    day,
                    at + dt.timedelta(hours=extra, microseconds=extra % 3 * 1500),
                    close,
                    None if close is None or r.random() < 0.05 else close + 1,
                    None if close is None else close - 1,
                    r.randint(1, 9),
                )
            )
    schema = "stock_id string, source string, trade_date date, recorded_at timestamp_ntz, close double, high double, low double, volume bigint"
    rows = list({(x[2], x[3]): x for x in rows}.values())
    a = pit.with_available_at(spark.createDataFrame(rows, schema), KEY, "trade_date", instants.exchange_daily_settled)
    want = pit.rolling_as_of(
        a, SERIES, "trade_date", instants.exchange_daily_settled, lambda df, by: metrics.technical_panel(df, by)
    ).orderBy("trade_date").collect()
    got = rolling.rolling_panel(a, instants.exchange_daily_settled).orderBy("trade_date").collect()
    assert len(got) == len(want) == 60
    held = a.withColumn("cutoff", instants.exchange_daily_settled(F.col("trade_date"))).collect()
    cutoffs = {x.trade_date: x.cutoff for x in held}
    for g in got:
        seen = {}
        for x in sorted(held, key=lambda x: x.recorded_at):
            if x.trade_date <= g.trade_date and x.available_at <= cutoffs[g.trade_date]:
                seen[x.trade_date] = f"{x.trade_date}@{x.recorded_at.isoformat()}+00:00"
        text = ",".join(v for _, v in sorted(seen.items()))
        assert (g.input_count, g.input_fingerprint) == (len(seen), hashlib.sha256(text.encode()).hexdigest())
    for g, w in zip(got, want):
        for m in metrics.METRICS:
            x, y = (None if v is None or math.isnan(v) else v for v in (g[m], w[m]))
            assert (x is None) == (y is None) and (x is None or x == pytest.approx(y, abs=1e-9)), (g.trade_date, m)


def test_audit_finds_a_read_that_looks_ahead(spark):
    r = random.Random(4)
    rows = [
        (d, T(2024, 1, d, 20) + dt.timedelta(hours=h), d)
        for d in range(1, 15)
        for h in {0, *(r.randint(1, 200) for _ in range(2))}
    ]
    a = pit.with_available_at(versions(spark, rows), KEY, "trade_date", instants.exchange_daily_settled)
    at = [T(2024, 1, d, h) for d in range(1, 28) for h in (0, 13)]
    probes = spark.createDataFrame([(x,) for x in at], "probe timestamp_ntz")
    held = a.collect()
    for rule, instant in (
        (None, lambda x: max(x.available_at, x.recorded_at)),
        (F.col("recorded_at"), lambda x: x.recorded_at),
        (F.col("available_at"), lambda x: x.available_at),
    ):
        got = {x.probe: (x.leaked, x.visible) for x in pit.look_ahead_audit(a, KEY, probes, rule).collect()}
        for p in at:
            seen = {}
            for x in sorted(held, key=lambda x: x.recorded_at):
                if instant(x) <= p:
                    seen[x.trade_date] = x
            assert got[p] == (sum(x.available_at > p for x in seen.values()), len(seen))
    with pytest.raises(ValueError, match="probes"):
        pit.look_ahead_audit(
            a, KEY, spark.range(1001).select(F.timestamp_seconds("id").cast("timestamp_ntz").alias("probe"))
        )


def test_incremental_runs_touch_changed_series_only(spark):
    day = lambda n: D(2020, 1, 1) + dt.timedelta(days=n)
    rows = [(s, "feed", day(n), T(2020, 1, 1) + dt.timedelta(days=n), 1.0, 1) for s in ("1", "2") for n in range(900)]
    flows = spark.createDataFrame(
        rows, "stock_id string, source string, trade_date date, recorded_at timestamp_ntz, net double, volume bigint"
    )
    prices = flows.select("stock_id", F.lit("board").alias("source"), "trade_date", "recorded_at", "volume")
    new = spark.createDataFrame([("1", "feed", day(900), T(2023, 1, 1), 1.0, 1)], flows.schema)
    found = derived.derived_datasets({"feed": "board"}, {"feed": "holders"})
    inputs = {
        "institutional_flows": flows.unionByName(new),
        "daily_prices": prices.unionByName(
            new.select("stock_id", F.lit("board").alias("source"), "trade_date", "recorded_at", "volume")
        ),
    }
    held = flows.limit(0).select(
        "stock_id", "source", "trade_date", "recorded_at", F.col("volume").alias("issued_shares")
    )
    for name, column in (
        ("institutional_streaks", "net_streak_days"), ("institutional_cumulative_flow", "net_cumulative_net")
    ):
        given = {k: v for k, v in {**inputs, "foreign_holdings": held}.items() if k in found[name].inputs}
        before = {k: v.where("recorded_at < timestamp_ntz'2022-12-01 00:00:00'") for k, v in given.items()}
        stored = derived.run(found[name], before, None, None, ts("2022-12-01 00:00:00"))
        touched = derived.run(found[name], given, stored, ts("2022-12-01 00:00:00"), ts("2023-02-01 00:00:00"))
        last = touched.orderBy(F.desc("trade_date")).first()
        assert last[column] == 901 and {r.stock_id for r in touched.select("stock_id").distinct().collect()} == {"1"}
        assert derived.merged(stored, touched).count() == 1801


def test_sessions_rank_any_day(spark):
    calendar = spark.createDataFrame([(D(2024, 1, d),) for d in (4, 5, 8, 9, 10)], "trade_date date")
    sessions = reconcile.Sessions(calendar)
    days = [D(2023, 12, 1), D(2024, 1, 4), D(2024, 1, 6), D(2024, 1, 7), D(2024, 1, 10), D(2024, 2, 1), None]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d date")
    got = rows.select(
        sessions.through(F.col("d")), sessions.before(F.col("d")), sessions.nth(F.col("d"), F.lit(D(2024, 1, 9)))
    ).orderBy("i").collect()
    assert [tuple(r) for r in got[:-1]] == [(0, 0, 4), (1, 0, 4), (2, 2, 2), (2, 2, 2), (5, 4, 0), (5, 5, -1)]
    assert tuple(got[-1]) == (None, None, None)
    assert reconcile.Sessions(calendar.limit(0)).total == 0


def test_gaps_with_all_details(spark):
    """One stock a detail; a listing on a Sunday, in another market, limits of one and of only one of two events."""
    calendar = spark.createDataFrame([(D(2024, 1, d),) for d in range(1, 32) if d % 7 not in (0, 6)], "trade_date date")
    day = lambda d: D(2024, 1, d)
    bars, events, spans_ = [], [], []
    for stock in ("sunday", "market", "start", "within", "half", "action", "none", "unknown"):
        first = 1 if stock != "start" else 11
        bars += [(stock, "alpha", day(first), None, None), (stock, "alpha", day(first + 1), 10.0, 9.0)]
        bars += [(stock, "alpha", day(15), 90.0, None if stock == "unknown" else 90.0)]
    spans_ = [("sunday", "sii", day(14)), ("market", "otc", day(14)), ("none", "sii", day(16)), ("start", "sii", None)]
    events = [("within", "alpha", day(15), "f1"), ("half", "alpha", day(15), "f1"), ("half", "alpha", day(15), "f2")]
    events += [("action", "alpha", day(9), "f1")]
    body = lambda *rows: json.dumps({"tables": [{"fields": ["date", "code", "漲停價格", "跌停價格"], "data": rows}]})
    store = spark.createDataFrame(
        [
            ("s1", body(["113年01月15日", " within ", "1,021.0", "9.5"], ["113年01月15日", "half", "300", "9"], ["x", "y", "-", "1"])),
            ("s2", body(["113年01月15日", "half", "-", "9"])),
            ("s3", json.dumps({"fields": ["date", "code"], "data": [["113年01月15日", "half"]]})),
        ],
        "sha256 string, content string",
    )
    limits = payloads.published_limits(store)
    assert {(r.sha256, r.stock_id, r.trade_date, float(r.limit_down), float(r.limit_up)) for r in limits.collect()} == {
        ("s1", "within", day(15), 9.5, 1021.0), ("s1", "half", day(15), 9.0, 300.0)
    }
    fetches = spark.createDataFrame([("f1", "s1"), ("f2", "s2")], "fetch_id string, sha256 string")
    e = spark.createDataFrame(events, "stock_id string, source string, ex_date date, fetch_id string")
    allowed = reconcile.event_limits(e, fetches, limits)
    assert [tuple(map(str, r)) for r in allowed.collect()] == [("within", "alpha", "2024-01-15", "9.500000", "1021.000000")]
    got = reconcile.classify_gaps(
        spark.createDataFrame(bars, "stock_id string, source string, trade_date date, close double, adjusted_close double"),
        e,
        reconcile.Sessions(calendar),
        spark.createDataFrame(spans_, "stock_id string, market string, listed_on date"),
        {"alpha": "sii"},
        F.lit(day(1)),
        allowed,
    )
    shown = {(r.stock_id, r.kind): r.detail if r.detail else r.reason for r in got.where("sessions >= 0").collect()}
    assert shown[("sunday", "raw")] == shown[("sunday", "adjusted")] == "new_listing"
    assert shown[("market", "raw")] == shown[("none", "adjusted")] == "unexplained_anomaly"
    assert shown[("start", "raw")] == "series_start"
    assert shown[("within", "raw")] == "corporate_action" and shown[("within", "adjusted")] == "within_published_limits"
    assert shown[("half", "adjusted")] == shown[("action", "adjusted")] == "corporate_action"
    assert shown[("unknown", "adjusted")] == "unknown" and shown[("unknown", "raw")] == "unexplained_anomaly"


def test_chain_issues_by_span(spark):
    """A stock that left one market in B and entered another in C has no broken link; each kind of issue, once."""
    span = "stock_id string, market string, listed_on date, delisted_on date"
    s = spark.createDataFrame(
        [
            ("two", "otc", D(2020, 1, 1), D(2021, 1, 1)), ("two", "sii", D(2021, 1, 1), None),
            ("first", "sii", D(2020, 5, 1), None), ("link", "sii", None, None), ("quoted", "otc", D(2020, 1, 1), D(2022, 1, 1)),
            ("ceased", "sii", D(2020, 1, 1), None), ("anchor", "sii", D(2019, 1, 1), None),
        ],
        span,
    )
    rows = [
        ("two", "otc", D(2020, 6, 1), "A", "B"), ("two", "sii", D(2021, 6, 1), "C", "A"),
        ("first", "sii", D(2020, 5, 1), "A", "B"), ("link", "sii", D(2020, 2, 1), "A", "B"),
        ("link", "sii", D(2020, 3, 1), "C", "A"), ("quoted", "otc", D(2021, 6, 1), "B", "A"),
        ("ceased", "sii", D(2020, 6, 1), "A", "OLD"),
    ]
    versions = spark.createDataFrame(
        [(a, m, d, o, n, T(2020, 1, 1)) for a, m, d, o, n in rows],
        "stock_id string, market string, effective_date date, old_industry string, new_industry string, recorded_at timestamp_ntz",
    )
    anchored = spark.createDataFrame(
        [
            ("two", "sii", D(2021, 1, 1), None, "B", None), ("first", "sii", D(2020, 5, 1), None, "B", None),
            ("quoted", "otc", D(2020, 1, 1), D(2022, 1, 1), "B", D(2021, 5, 1)), ("link", "sii", None, None, "A", None),
            ("anchor", "sii", D(2019, 1, 1), None, "NEW", None),
        ],
        f"{span}, anchor_code string, anchor_on date",
    )
    cats = spark.createDataFrame(
        [("OLD", "sii", None, D(2023, 7, 3)), ("NEW", "sii", D(2021, 1, 1), None), ("A", "sii", None, None)],
        "code string, market string, valid_from date, valid_to date",
    )
    got = {(r.stock_id, r.effective_date, r.issue) for r in spans.chain_issues(s, versions, anchored, cats).collect()}
    assert got == {
        ("two", D(2021, 6, 1), "anchor_disagrees"), ("first", D(2020, 5, 1), "outside_span"),
        ("link", D(2020, 3, 1), "broken_link"), ("ceased", D(2020, 6, 1), "no_longer_existing"),
        ("anchor", D(2019, 1, 1), "not_yet_existing"),
    }


def test_change_on_the_listing_day_leaves_the_anchor(spark):
    s = spark.createDataFrame(
        [("1", "sii", D(2020, 5, 1), None)], "stock_id string, market string, listed_on date, delisted_on date"
    )
    changes = [("1", "n", "sii", D(2020, 5, 1), D(2020, 4, 20), "A", "B", T(2020, 4, 20)), ("1", "m", "otc", D(2020, 6, 1), D(2020, 4, 20), "A", "D", T(2020, 4, 20))]
    v = spans.change_versions(spark.createDataFrame(
        changes,
        "stock_id string, source string, market string, effective_date date, announced_on date, old_industry string, new_industry string, recorded_at timestamp_ntz",
    ))
    anchored = s.withColumns({"anchor_code": F.lit("C"), "anchor_on": F.lit(None).cast("date")})
    cats = spark.createDataFrame([("C", "sii", None, None, None)], "code string, market string, valid_from date, valid_to date, renamed_on date")
    p = spans.category_periods(s, v, anchored, cats, ts("2024-01-01"), ts("2024-01-01"), ts("2020-01-01"))
    assert [(r.industry_code, r.basis, r.effective_from) for r in p.collect()] == [("C", "anchor", D(2020, 5, 1))]


def test_expectation_and_agreement_by_market(spark):
    span = "stock_id string, market string, listed_on date, delisted_on date"
    s = spark.createDataFrame(
        [("1", "otc", D(2020, 1, 1), D(2021, 1, 1)), ("1", "sii", D(2021, 1, 1), None), ("2", "otc", None, D(2020, 3, 1))], span
    )
    anchored = spark.createDataFrame(
        [("1", "otc", D(2020, 1, 1), D(2021, 1, 1), "B", None), ("1", "sii", D(2021, 1, 1), None, "Z", None), ("2", "otc", None, D(2020, 3, 1), "Q", None)],
        f"{span}, anchor_code string, anchor_on date",
    )
    changes = spark.createDataFrame(
        [("1", "otc", D(2020, 6, 1), "A", "B")],
        "stock_id string, market string, effective_date date, old_industry string, new_industry string",
    )
    days = [("1", "otc", D(2020, 3, 1)), ("1", "otc", D(2020, 7, 1)), ("1", "sii", D(2021, 7, 1)), ("2", "otc", D(2020, 5, 1)), ("3", "otc", D(2020, 5, 1))]
    asked = spark.createDataFrame(days, "stock_id string, market string, trade_date date")
    got = {(r.stock_id, r.market, r.trade_date): (r.announced, r.expected, r.basis) for r in spans.expected_category(asked, changes, s, anchored).collect()}
    assert [got[d] for d in days] == [
        ("A", "A", "next_change"), ("B", "B", "anchor"), (None, "Z", "today"), (None, "Q", "anchor"), (None, None, "anchor")
    ]
    quotes = asked.withColumns({"industry_code": F.lit("B")})
    periods = spark.createDataFrame(
        [("1", "otc", "A", D(2020, 1, 1), D(2020, 6, 1)), ("1", "otc", "B", D(2020, 6, 1), None), ("1", "sii", "C", None, None)],
        "stock_id string, market string, industry_code string, effective_from date, effective_to date",
    )
    lagging = spark.createDataFrame([("1", D(2020, 3, 1), D(2020, 3, 2))], "stock_id string, since date, until date")
    rows = {(r.market, r.trade_date): (r.agree, r.no_period, r.known_lag, r.differ) for r in spans.quote_agreement(quotes, periods, lagging).collect()}
    assert rows == {
        ("otc", D(2020, 3, 1)): (0, 0, 1, 0), ("otc", D(2020, 7, 1)): (1, 0, 0, 0), ("sii", D(2021, 7, 1)): (0, 0, 0, 1), ("otc", D(2020, 5, 1)): (0, 2, 0, 0)
    }


def test_interval_ends_are_audited_at_every_instant(spark):
    """Views equal the periods of every probe; an end shown before its change is public is found, and only then."""
    s = spark.createDataFrame(
        [("1", "sii", D(2020, 1, 1), D(2024, 3, 1)), ("2", "sii", None, None)],
        "stock_id string, market string, listed_on date, delisted_on date",
    )
    rows = [
        ("1", "n", "sii", D(2023, 7, 1), D(2023, 6, 20), "01", "02", T(2023, 6, 20, 17)),
        ("1", "n", "sii", D(2023, 7, 1), D(2023, 6, 20), "01", "03", T(2023, 6, 25)),
        ("1", "n", "sii", D(2023, 9, 1), D(2023, 8, 20), "03", "04", T(2023, 8, 20)),
    ]
    v = spans.change_versions(spark.createDataFrame(
        rows,
        "stock_id string, source string, market string, effective_date date, announced_on date, old_industry string, new_industry string, recorded_at timestamp_ntz",
    ))
    anchored = s.where("stock_id = '2'").withColumns({"anchor_code": F.lit("04"), "anchor_on": F.lit(None).cast("date")})
    cats = spark.createDataFrame(
        [(c, "sii", None, D(2024, 1, 1) if c == "04" else None, D(2021, 1, 1) if c == "01" else None) for c in ("01", "02", "03", "04")],
        "code string, market string, valid_from date, valid_to date, renamed_on date",
    )
    known, public = ts("2100-01-01"), ts("2020-12-01")
    views = spans.category_views(s, v, anchored, cats, known, public).cache()
    shown = ["stock_id", "industry_code", "basis", "effective_from", "effective_to", "available_at"]
    probes = [T(2019, 1, 1), T(2020, 6, 1), T(2020, 12, 1), T(2023, 6, 21), T(2023, 6, 25), T(2023, 8, 19), T(2023, 8, 21), T(2024, 2, 29, 16)]
    for at in probes:
        one = spans.category_periods(s, v, anchored, cats, ts(str(at)), known, public).select(shown)
        held = views.where((F.col("seen_from") <= ts(str(at))) & (F.col("seen_until").isNull() | (F.col("seen_until") > ts(str(at))))).select(shown)
        assert sorted(map(str, one.collect())) == sorted(map(str, held.collect())), at
    asked = spark.createDataFrame([(p,) for p in probes], "probe timestamp_ntz")
    right = spans.ends_audit(views, views, cats, public, asked).collect()
    assert all(r.late == 0 and r.ends_not_yet_public == 0 for r in right) and sum(r.visible for r in right) > 8
    leak = views.where("seen_until is null").withColumn("seen_from", F.lit(T(2023, 6, 21)).cast("timestamp_ntz"))
    found = {r.probe: (r.late, r.ends_not_yet_public) for r in spans.ends_audit(leak, views, cats, public, asked).collect()}
    assert found[T(2023, 6, 21)] == (2, 1) and found[T(2023, 8, 19)] == (1, 1) and found[T(2023, 8, 21)] == (0, 0)


def test_several_sources_are_refused_unless_dropped(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a")], "stock_id string, source string")
    with pytest.raises(ValueError, match="stock 1 has several sources"):
        pit.single_source(df)
    assert [r.stock_id for r in pit.single_source(df, several="drop").collect()] == ["2"]
    assert pit.single_source(df.where("stock_id = '2'"), df.where("stock_id = '2'")).count() == 1
    with pytest.raises(ValueError, match="unknown stock 3"):
        pit.single_source(df, df.selectExpr("'3' as stock_id"), several="drop")


def test_streak_and_indicator_classes(spark):
    axis = spark.createDataFrame(
        [
            (stock, "a", D(2024, 1, d), 1.0, -1.0 if d == flip else 1.0, float(d), float(d - (d >= flip)), True, d != gap)
            for stock, flip, gap in (("moved", 3, 0), ("days", 3, 3), ("other", 5, 0), ("sign", 4, 0), ("old", 2, 0))
            for d in range(1, 8)
        ],
        "stock_id string, source string, trade_date date, ours_sign double, theirs_sign double, ours_streak double, theirs_streak double, in_ours boolean, in_theirs boolean",
    )
    axis = axis.withColumns({c: F.when(F.col("stock_id") == "old", F.lit(v)).otherwise(F.col(c)) for c, v in (("ours_streak", 2.0), ("theirs_streak", 1.0))})
    one = lambda v, c: spark.createDataFrame([(v,)], f"{c}")
    got = reconcile.streak_classes(axis, one("moved", "stock_id string"), one(D(2024, 1, 5), "trade_date date"))
    seen = {r.stock_id: r.diff_class for r in got.where("trade_date = '2024-01-07'").collect()}
    assert seen == {"moved": "market_transfer", "days": "day_sets_differ", "other": "captured_another_date", "sign": "net_sign_differs", "old": "unexplained"}

    days = [(s, "a", D(2024, 1, d), False, d == 3 or (s == "two" and d == 4), d == 3) for s in ("one", "two") for d in range(1, 8)]
    axis = spark.createDataFrame(days, "stock_id string, source string, trade_date date, dropped boolean, volume_differs boolean, frozen boolean")
    diff = axis.select(*KEY, F.explode(F.array(F.lit("vma5"), F.lit("ma5"))).alias("metric"), F.lit(1.0).alias("ours"), F.lit(2.0).alias("theirs"))
    found = reconcile.indicator_classes(diff, axis, {"vma5": 5, "ma5": 5}, diff.limit(0)).collect()
    frozen = {(r.stock_id, r.trade_date.day) for r in found if r.diff_class == "frozen_volume"}
    assert frozen == {("one", d) for d in (3, 4, 5, 6, 7)} and {r.metric for r in found if r.diff_class == "frozen_volume"} == {"vma5"}
