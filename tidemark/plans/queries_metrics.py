"""Queries of the derived metrics, valuation and incremental operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.rounding import round_15_digits, round_half_even_scaled, round_half_up
from tidemark.operators import incremental, metrics, valuation
from tidemark.operators.sizes import clustered
from tidemark.plans.panels import bars, actions, facts, flows, reports, table, versions, with_
from tidemark.plans.registry import query
from tidemark.sources import tables
from tidemark.sources.payloads import long_to_wide_levels

SERIES = ["stock_id", "source"]
KEY = [*SERIES, "trade_date"]


def rounded(df, columns, places=6):
    return df.select(*[F.round(c, places).alias(c) if c in columns else F.col(c) for c in df.columns])


def _mean(c, n):
    return f"case when count({c}) over w{n} = {n} then sum({c}::decimal(28,6)) over w{n}::double / {n} end"


def _ma(c, n):
    return f"round({_mean(c, n)}, 6) as {'v' if c == 'volume' else ''}ma{n}"


MOVING_SQL = f"""{with_('bars')} select stock_id, source, trade_date,
    {', '.join(_ma(c, n) for c in ('close', 'volume') for n in metrics.WINDOWS)} from bars
    window {', '.join(f'w{n} as (partition by stock_id, source order by trade_date rows between {n - 1} preceding and current row)' for n in metrics.WINDOWS)}"""


@query("metric_moving_averages", days="trade_date", sql=MOVING_SQL)
def _(spark, d):
    out = metrics.moving_averages(bars(spark, d))
    names = [f"{v}ma{n}" for v in ("", "v") for n in metrics.WINDOWS]
    return rounded(out.select(*KEY, *names), names)


BANDS_SQL = f"""{with_('bars')}, x as (select *, case when count(close) over w = 20 then sum(close::decimal(28,6))
    over w::double / 20 end as mid, case when count(close) over w = 20 then stddev_samp(close) over w end as dev,
    count(*) over v as n, min(low) over v as lo, max(high) over v as hi from bars window w as (partition by stock_id,
    source order by trade_date rows between 19 preceding and current row), v as (partition by stock_id, source order
    by trade_date rows between 8 preceding and current row))
    select stock_id, source, trade_date, round(mid, 4) as bb_middle, round(mid + 2 * dev, 4) as bb_upper, round(mid -
    2 * dev, 4) as bb_lower, round(case when n = 9 and hi > lo then (close - lo) / (hi - lo) * 100 else 50 end, 6) as
    rsv from x"""


@query("metric_bollinger_rsv", days="trade_date", sql=BANDS_SQL)
def _(spark, d):
    out = metrics.rsv(metrics.bollinger(bars(spark, d))).select(*KEY, "bb_middle", "bb_upper", "bb_lower", "rsv")
    return rounded(rounded(out, ["bb_middle", "bb_upper", "bb_lower"], 4), ["rsv"])


KD_SQL = f"""{with_('bars', recursive=True)}, x as (select *, row_number() over (partition by
    stock_id, source order by trade_date) as i, count(*) over v as n, min(low) over v as lo, max(high) over v as hi
    from bars
        window v as (partition by stock_id, source order by trade_date rows between 8 preceding and current row)),
    y as materialized (select stock_id, source, trade_date, i, case when n = 9 and hi > lo then (close - lo) / (hi -
    lo) * 100 else 50.0::double end as rsv, close from x),
    r as (select stock_id, source, trade_date, i, rsv as k, rsv as d, close as fast, close as slow, 0.0::double as dea
    from y where i = 1
        union all select stock_id, source, trade_date, i, k, d * 2 / 3 + k / 3, fast, slow, dea * 0.8 + (fast - slow)
        * 0.2
        from (select y.stock_id, y.source, y.trade_date, y.i, r.k * 2 / 3 + y.rsv / 3 as k, r.d, r.fast * 11 / 13 +
        y.close * 2 / 13 as fast, r.slow * 25 / 27 + y.close * 2 / 27 as slow, r.dea from r join y on y.stock_id =
        r.stock_id and y.source = r.source and y.i = r.i + 1))
    select stock_id, source, trade_date, round(k, 4) as k, round(d, 4) as d, round(fast - slow, 4) as macd_dif,
    round(dea, 4) as macd_dea, round(fast - slow - dea, 4) as macd_hist from r"""


@query("metric_kd_macd", days="trade_date", sql=KD_SQL)
def _(spark, d):
    names = ["k", "d", "macd_dif", "macd_dea", "macd_hist"]
    return rounded(metrics.recurrences(metrics.rsv(bars(spark, d))).select(*KEY, *names), names, 4)


_RSI = f"""{with_('bars', recursive=True)}, y as materialized (select stock_id, source,
    trade_date, row_number() over w as i, close - lag(close) over w as ch from bars window w as (partition by
    stock_id, source order by trade_date)),
    r as (select stock_id, source, trade_date, i, 0.0::double as g6, 0.0::double as l6, 0.0::double as g12,
    0.0::double as l12 from y where i = 1
        union all select y.stock_id, y.source, y.trade_date, y.i, r.g6 * 5 / 6 + greatest(ch, 0), r.l6 * 5 / 6 +
        greatest(-ch, 0), r.g12 * 11 / 12 + greatest(ch, 0), r.l12 * 11 / 12 + greatest(-ch, 0) from r join y on
        y.stock_id = r.stock_id and y.source = r.source and y.i = r.i + 1)
    select stock_id, source, trade_date,
    {', '.join(f"round(case when i > {n} and g{n} + l{n} > 0 then 100 * g{n} / (g{n} + l{n}) end, 4) as rsi{n}" for n in (6, 12))}
    from r"""
#: The whole panel: windows, exponential means and RSI by their own queries, side by side.
PANEL_SQL = f"""select a.stock_id, a.source, a.trade_date,
    {', '.join(f'a.{v}ma{n}' for v in ('', 'v') for n in metrics.WINDOWS)}, b.k, b.d, c.rsi6,
    c.rsi12, b.macd_dif, b.macd_dea, b.macd_hist, e.bb_upper, e.bb_middle, e.bb_lower
    from ({MOVING_SQL}) a join ({KD_SQL}) b using (stock_id, source, trade_date) join ({_RSI}) c using (stock_id,
    source, trade_date) join ({BANDS_SQL}) e using (stock_id, source, trade_date)"""


#: Places of a panel's metrics: averages to six (where no tie of theirs lies) and the others to four.
PLACES = {m: 6 if "ma" in m[:3] and m[-1].isdigit() else 4 for m in metrics.METRICS}


def panel_columns():
    """The metrics of a panel, rounded."""
    none = F.lit(None).cast("double")
    return [F.round(F.nanvl(m, none), PLACES[m]).alias(m) for m in metrics.METRICS]


@query("metric_technical_panel", days="trade_date", sql=PANEL_SQL)
def technical_panel(spark, d):
    """All 22 metrics of every bar."""
    panel = metrics.technical_panel(bars(spark, d))
    return panel.select(*KEY, *panel_columns())


STREAKS_SQL = f"""{with_('flows')}, x as (select *, coalesce(sign(net), 0) as s from flows where volume > 0), y as
    (select *, case when s <> coalesce(lag(s) over w, 9) then 1 else 0 end as b from x window w as (partition by
    stock_id, source order by trade_date)),
    z as (select *, sum(b) over (partition by stock_id, source order by trade_date) as g from y) select stock_id,
    source, trade_date, (s * row_number() over (partition by stock_id, source, g order by trade_date))::bigint as
    net_streak_days from z"""


@query("metric_streaks", days="trade_date", sql=STREAKS_SQL)
def _(spark, d):
    f = flows(spark, d)
    sources = spark.createDataFrame([("feed", "board")], "source string, price_source string")
    axis = metrics.traded_axis(
        f.select(*KEY, "net"), f.select("stock_id", F.lit("board").alias("source"), "trade_date", "volume"), sources
    )
    return metrics.streaks(axis, ["net"]).select(*KEY, F.col("net_streak_days").cast("bigint").alias("net_streak_days"))


CUMULATIVE_SQL = f"""{with_('flows')}, c as (select *, coalesce(sum(net) over (partition by stock_id, source order by
    trade_date rows unbounded preceding), 0)::bigint as cumulative_net from flows)
    select stock_id, source, trade_date, cumulative_net, case when n_events % 3 <> 0 then round(round(cumulative_net *
    100.0::double / (n_events * 1000), 10), 4) end as cumulative_ratio from c"""


@query("metric_cumulative_flow", days="trade_date", sql=CUMULATIVE_SQL)
def _(spark, d):
    f = flows(spark, d)
    held = f.where("n_events % 3 <> 0").select(
        "stock_id", "trade_date", (F.col("n_events") * 1000).alias("issued_shares")
    )
    return metrics.cumulative_ratio(metrics.cumulative_flow(f, "net"), held).select(
        *KEY, F.col("cumulative_net").cast("bigint").alias("cumulative_net"), "cumulative_ratio"
    )


def levels(spark, d):
    """Holder levels: a line's quantity gives its level; every supplier and quarter has all 17.

    Lines are dealt by stock once; levels and wide rows need no further shuffle."""
    lines = table(spark, d, "lineitem")
    li = lines.select(
        F.col("l_suppkey").cast("string").alias("stock_id"),
        F.lit("weekly").alias("source"),
        F.trunc("l_shipdate", "quarter").alias("snapshot_date"),
        (F.col("l_orderkey") % 17 + 1).cast("int").alias("level"),
        F.col("l_quantity").cast("bigint").alias("q"),
    )
    li = clustered(li, ["stock_id"], lines.count())
    return li.groupBy("stock_id", "source", "snapshot_date", "level").agg(
        F.count("*").alias("holders"),
        F.sum("q").alias("shares"),
        ((F.sum("q") % 700) / F.lit(100)).cast("decimal(5,2)").alias("percent"),
    )


_LEVELS = """with levels as (select l_suppkey::varchar as stock_id, 'weekly' as source, date_trunc('quarter',
    l_shipdate)::date as snapshot_date, l_orderkey % 17 + 1 as level, count(*) as holders,
    sum(l_quantity::bigint)::bigint as shares,
    ((sum(l_quantity::bigint)::bigint % 700) / 100.0)::decimal(5,2) as percent from lineitem group by all),
    wide as (select stock_id, source, snapshot_date, """ + ", ".join(
    f"max({c}) filter (level = {i}) as {c}_{i}" for i in range(1, 16) for c in ("holders", "shares", "percent")
) + """,
    -abs(max(shares) filter (level = 16)) as adjustment_shares, -abs(max(percent) filter (level = 16)) as
    adjustment_percent, max(holders) filter (level = 17) as total_holders, max(shares) filter (level = 17) as
    total_shares, max(percent) filter (level = 17) as total_percent,
    count(*) filter (level = 16) as dropped_holder_counts from levels group by 1, 2, 3)"""


@query(
    "source_levels_wide",
    days="snapshot_date",
    sql=f"""{_LEVELS} select stock_id, source, snapshot_date, holders_1, shares_8, percent_15::double as percent_15,
    adjustment_shares, adjustment_percent::double as adjustment_percent, total_holders, total_shares,
    dropped_holder_counts from wide""",
)
def _(spark, d):
    w = long_to_wide_levels(levels(spark, d), ["stock_id", "source", "snapshot_date"])
    return w.select(
        "stock_id",
        "source",
        "snapshot_date",
        "holders_1",
        "shares_8",
        F.col("percent_15").cast("double").alias("percent_15"),
        "adjustment_shares",
        F.col("adjustment_percent").cast("double").alias("adjustment_percent"),
        "total_holders",
        "total_shares",
        "dropped_holder_counts",
    )


def _plus(c, lo, hi):
    return " + ".join(f"{c}_{i}" for i in range(lo, hi))


CONCENTRATION_SQL = f"""{_LEVELS}, g as (select stock_id, source, snapshot_date, ({_plus('percent', 12, 16)})::double
    as l, ({_plus('percent', 9, 12)})::double as m, ({_plus('percent', 1, 9)})::double as s,
    {_plus('holders', 12, 16)} as large_holder_count, {_plus('holders', 1, 9)} as small_holder_count from wide)
    select stock_id, source, snapshot_date, round(l, 2) as large_holder_ratio, round(l - lag(l) over w, 2) as
    large_holder_ratio_wow, round(m, 2) as mid_holder_ratio, round(m - lag(m) over w, 2) as mid_holder_ratio_wow,
    round(s, 2) as small_holder_ratio, round(s - lag(s) over w, 2) as small_holder_ratio_wow,
    round(l - s, 2) as concentration_spread, round((l - s) - lag(l - s) over w, 2) as concentration_spread_wow,
    large_holder_count, small_holder_count from g window w as (partition by stock_id, source order by snapshot_date)"""


@query("metric_concentration", days="snapshot_date", sql=CONCENTRATION_SQL)
def _(spark, d):
    return metrics.concentration(long_to_wide_levels(levels(spark, d), ["stock_id", "source", "snapshot_date"]))


def margin(spark, d):
    b = bars(spark, d)
    v, c = F.col("volume"), F.floor("close")
    return b.select(
        *KEY,
        v.alias("margin_balance"),
        (v + c % 7 - 3).alias("margin_previous_balance"),
        (F.when(c % 5 != 0, v * 4)).alias("margin_limit"),
        (c % 50).alias("short_balance"),
        (c % 48).alias("short_previous_balance"),
        (c % 11 * 30).alias("short_limit"),
    )


def lending(spark, d):
    named = {
        "margin_balance": "balance",
        "margin_previous_balance": "previous_balance",
        "short_balance": "sold",
        "short_previous_balance": "returned",
    }
    return margin(spark, d).select(*KEY, *[F.col(c).alias(n) for c, n in named.items()])


def _pct(n, dd, s=100.0):
    return f"case when {dd} > 0 then round(({n})::double / ({dd})::double * {s}, 4) end"


_MARGIN = f"""{with_('bars')}, m as (select stock_id, source, trade_date, volume as mb, volume + floor(close)::bigint
    % 7 - 3 as mp, case when floor(close)::bigint % 5 <> 0 then volume * 4 end as ml, floor(close)::bigint % 50 as sb,
    floor(close)::bigint % 48 as sp, floor(close)::bigint % 11 * 30 as sl from bars)"""


MARGIN_SQL = f"""{_MARGIN} select stock_id, source, trade_date, {_pct('mb', 'ml')} as margin_usage_ratio, mb - mp as
    margin_balance_change, {_pct('mb - mp', 'mp')} as margin_balance_change_pct,
    {_pct('sb', 'sl')} as short_usage_ratio, sb - sp as short_balance_change, {_pct('sb - sp', 'sp')} as
    short_balance_change_pct, {_pct('sb', 'mb')} as short_cover_pressure from m"""


@query("metric_margin", days="trade_date", sql=MARGIN_SQL)
def _(spark, d):
    return metrics.margin_metrics(margin(spark, d))


SHORT_SQL = f"""{_MARGIN} select stock_id, source, trade_date, mb - mp as sbl_balance_change, {_pct('mb - mp', 'mp')}
    as sbl_balance_change_pct, {_pct('sb', 'sp', 1.0)} as sbl_sell_repay_ratio from m"""


@query("metric_short_interest", days="trade_date", sql=SHORT_SQL)
def _(spark, d):
    return metrics.short_interest_metrics(lending(spark, d))


@query(
    "rounding_three_ways",
    """select l_orderkey, l_linenumber, round(l_extendedprice * l_discount / 7, 4) as fifteen_digits,
    round_even(l_extendedprice / l_quantity * 100.0::double, 0) / 100 as half_even,
    round((l_extendedprice::decimal(20,2) * 3)::decimal(20,4), 1)::double as half_up from lineitem""",
)
def _(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        round_15_digits(F.col("l_extendedprice") * F.col("l_discount") / 7).alias("fifteen_digits"),
        round_half_even_scaled(F.col("l_extendedprice") / F.col("l_quantity")).alias("half_even"),
        round_half_up(
            (F.col("l_extendedprice").cast("decimal(20,2)") * 3).cast("decimal(20,4)"), 1
        ).cast("double").alias("half_up"),
    )


_EVENTS = f"""{with_('bars', 'actions')}, ev as (select * from actions), last as
    (select stock_id, source, max(trade_date) as z from bars group by 1, 2)"""
_FACTOR = f"""{_EVENTS}, f as (select b.stock_id, b.source, b.trade_date, any_value(b.close) as close, case when
    count(*) filter (e.ex_date is not null and e.event_factor is null) = 0 then coalesce(product(e.event_factor), 1)
    end as factor
    from bars b join last l using (stock_id, source) left join ev e on e.stock_id = b.stock_id and e.source = b.source
    and e.ex_date > b.trade_date and e.ex_date <= l.z group by 1, 2, 3)"""


@query(
    "adjusted_prices",
    days="trade_date",
    sql=f"""{_FACTOR} select stock_id, source, trade_date, round(factor, 6) as factor, round(close * factor, 6) as
    adjusted_close from f""",
)
def _(spark, d):
    sources = spark.createDataFrame([("alpha", "alpha"), ("beta", "beta")], "source string, price_source string")
    out = metrics.adjusted_prices(bars(spark, d), actions(spark, d), sources)
    return out.select(*KEY, F.round("factor", 6).alias("factor"), F.round("adjusted_close", 6).alias("adjusted_close"))


@query(
    "adjusted_applied_events",
    days="ex_date",
    sql=f"""{_EVENTS} select e.stock_id, e.source, e.ex_date, e.o_orderkey from ev e join last l using (stock_id,
    source) where ex_date > date '1997-01-01' and ex_date <= z""",
)
def _(spark, d):
    return metrics.applied_events(
        bars(spark, d), actions(spark, d), F.lit("1997-01-01").cast("date")
    ).select(*SERIES, "ex_date", "o_orderkey")


_Q = f"""{with_('facts')}, ver as (select stock_id, report_year, report_quarter, arg_max(id, recorded_at) as rid,
    arg_max(report_category, recorded_at) as cat, min_by(coalesce(published_at, timestamp '1800-01-01'), recorded_at)
    as p from reports group by 1, 2, 3),
    inp as (select v.*, (p + interval 8 hour)::date as published_on, f.* from ver v join facts f on f.report_id =
    v.rid where p > timestamp '1900-01-01'),
    b as (select *, case when period_start is null then 'i' when period_start = make_date(report_year, 1, 1) then case
    report_quarter when 4 then 'a' when 1 then 'q' else 'y' end when period_start = make_date(report_year,
    report_quarter * 3 - 2, 1) then 'q' else 'o' end as basis,
        case when cat = 'consolidated' then '8610' else '8200' end as inc, case when cat = 'consolidated' then '31XX'
        else '3XXX' end as eqa from inp),
    w as (select stock_id, report_year, report_quarter, published_on, """ + ", ".join(
    f"""case when min(value) filter ({c}) = max(value) filter ({c}) then max(value) filter ({c}) end as {n}"""
    for n, c
    in [
        (
            f"{nm}_{k}",
            f"statement = 'income_statement' and account_code = {a} and basis = '{k}' and period_end = last_day(make_date(report_year, report_quarter * 3, 1))",
        )
        for nm, a in (("eps", "'9750'"), ("income", "inc"))
        for k in "qya"
    ]
    + [
        (
            "equity",
            "statement = 'balance_sheet' and account_code = eqa and basis = 'i' and period_end = last_day(make_date(report_year, report_quarter * 3, 1))",
        )
    ]
) + """ from b group by 1, 2, 3, 4),
    quarters as (select w.stock_id, w.report_year, w.report_quarter, w.report_year * 4 + w.report_quarter - 1 as q,
    case when w.report_quarter = 4 then greatest(w.published_on, t.published_on) else w.published_on end as
    published_on,
        case when w.report_quarter = 4 then w.eps_a - t.eps_y else w.eps_q end as eps, case when w.report_quarter = 4
        then w.income_a - t.income_y else w.income_q end as income, w.equity
        from w left join w t on w.report_quarter = 4 and t.stock_id = w.stock_id and t.report_year = w.report_year and
        t.report_quarter = 3)"""


def quarters(spark, d):
    r = reports(spark, d)
    return valuation.quarter_values(valuation.report_inputs(r, facts(r)))


@query(
    "valuation_quarters",
    days="published_on",
    sql=f"""{_Q} select stock_id, report_year, report_quarter, q, published_on, eps::bigint as eps, income::bigint as
    income, equity::bigint as equity from quarters""",
)
def _(spark, d):
    return quarters(spark, d)


_TTM = f"""{_Q}, lines as (select l_suppkey::varchar as stock_id, case when l_suppkey % 2 = 0 then 'alpha' else 'beta'
    end as source, l_shipdate::date as trade_date, floor(l_extendedprice / l_quantity * 100)::bigint / 100.0::double
    as close, l_orderkey * 10 + l_linenumber as ord from lineitem),
    days as (select stock_id, source, trade_date, arg_max(close, ord) as close from lines group by 1, 2, 3),
    latest as (select d.stock_id, d.source, d.trade_date, any_value(d.close) as close, max(k.q) as q from days d join
    quarters k on k.stock_id = d.stock_id and k.published_on <= d.trade_date group by 1, 2, 3),
    ttm as (select l.stock_id, l.source, l.trade_date, any_value(l.close) as close, sum(k.eps)::bigint as ttm_eps,
    case when count(k.income) = 4 then sum(k.income)::bigint end as ttm_income, max(k.equity) filter (k.q = l.q) as
    equity from latest l join quarters k on k.stock_id = l.stock_id and k.q between l.q - 3 and l.q and k.published_on
    <= l.trade_date group by 1, 2, 3 having count(k.eps) = 4),
    val as (select stock_id, source, trade_date, ttm_eps, case when ttm_eps > 0 then round_even(close / ttm_eps * 100,
    0) / 100 end as pe_ratio, case when equity > 0 then round((ttm_income * 100 / equity::decimal(20,2))::double, 2)
    end as roe from ttm)"""


def valued(spark, d):
    return valuation.valuation_metrics(bars(spark, d).select(*KEY, "close"), quarters(spark, d))


VALUATION_SQL = f"""{_TTM} select a.stock_id, a.source, a.trade_date, any_value(a.ttm_eps)::double as ttm_eps,
    any_value(a.pe_ratio) as pe_ratio, round(any_value(a.roe), 1) as roe,
    case when any_value(a.pe_ratio) is not null then round_even((count(*) filter (b.pe_ratio < a.pe_ratio) + (count(*)
    filter (b.pe_ratio = a.pe_ratio) + 1) / 2.0::double) / count(b.pe_ratio) * 100 * 10000, 0) / 10000 end as
    pe_percentile
    from val a join val b on b.stock_id = a.stock_id and b.source = a.source and b.trade_date <= a.trade_date group by
    1, 2, 3"""


@query("valuation_metrics", days="trade_date", sql=VALUATION_SQL)
def _(spark, d):
    v = valued(spark, d)
    return v.select(*KEY, "ttm_eps", "pe_ratio", F.round("roe", 1).alias("roe"), "pe_percentile")


@query(
    "valuation_eps_basis",
    f"""{with_('facts')}, x as (select f.report_id, case when period_start = make_date(report_year, 1, 1) then case
    report_quarter when 4 then 'annual' when 1 then 'quarter' else 'year_to_date' end else 'quarter' end as basis,
    value from facts f join reports r on r.id = f.report_id where account_code = '9750')
    select report_id, basis, case when min(value) = max(value) then max(value)::bigint end as eps, min(value) <>
    max(value) as ambiguous from x group by 1, 2""",
)
def _(spark, d):
    r = reports(spark, d)
    return valuation.eps_by_basis(
        facts(r).join(r.select(F.col("id").alias("report_id"), "report_year", "report_quarter"), "report_id")
    )


SINCE = "2001-06-30 00:00:00"


def since():
    return F.lit(SINCE).cast("timestamp_ntz")


_CHANGED = f"""{with_('versions')}, ch as (select stock_id, source, min(trade_date) as start from versions where
    recorded_at > timestamp '{SINCE}' group by 1, 2)"""


@query("incremental_changed_series", days="start", sql=f"{_CHANGED} select * from ch")
def _(spark, d):
    v = versions(spark, d)
    return incremental.changed_series({"a": v.where("volume % 2 = 0"), "b": v.where("volume % 2 = 1")}, since())


@query(
    "incremental_report_changes",
    days="start",
    sql=f"""{with_('reports', 'bars')}, t as (select stock_id, report_year, report_quarter, max(recorded_at) as r,
    min_by(coalesce(published_at, timestamp '1800-01-01'), recorded_at) as p from reports group by 1, 2, 3 having
    max(recorded_at) > timestamp '1998-01-01'),
    s as (select stock_id, min((p + interval 8 hour)::date) as start from t where p > timestamp '1900-01-01' group by
    1) select distinct b.stock_id, b.source, s.start from bars b join s using (stock_id)""",
)
def _(spark, d):
    return incremental.report_changes(reports(spark, d), bars(spark, d), F.lit("1998-01-01").cast("timestamp_ntz"))


@query(
    "incremental_warm_up",
    days="start read_from",
    sql=f"""{_CHANGED}, r as (select c.stock_id, c.source, c.start, d.trade_date, row_number() over (partition by
    c.stock_id, c.source order by d.trade_date desc) as n from ch c join (select distinct stock_id, source, trade_date
    from versions) d on d.stock_id = c.stock_id and d.source = c.source and d.trade_date < c.start)
    select c.stock_id, c.source, c.start, least(c.start - 500, (select min(trade_date) from r where r.stock_id =
    c.stock_id and r.source = c.source and n <= 240)) as read_from from ch c""",
)
def _(spark, d):
    v = versions(spark, d)
    return incremental.warm_up_start(incremental.changed_series({"a": v}, since()), v.select(*KEY).distinct())


def _panel(spark, d):
    """The table after an incremental run, the full computation and its rows. Versions, rows and the stored table lie in
    files, as they do between two runs; each is read several times."""
    from tidemark.operators.pit import latest_per_key

    v = tables.in_files(versions(spark, d), "versions")
    now = tables.in_files(latest_per_key(v, KEY), "now")
    compute = lambda rows: metrics.moving_averages(rows).select(*KEY, "ma5", "ma20", "vma20")
    before = latest_per_key(v.where(F.col("recorded_at") <= since()), KEY)
    stored = tables.in_files(compute(before).withColumn("computed_at", since()), "stored")
    run = incremental.incremental_run(
        stored, {"v": v}, now, compute, since(), F.lit("2002-01-01").cast("timestamp_ntz")
    )
    return run, compute(now), now


_FULL = f"""{with_('versions')}, n as (select * from versions qualify row_number() over (partition by stock_id,
    source, trade_date order by recorded_at desc) = 1),
    c as (select stock_id, source, trade_date,
    {_mean('close', 5)} as ma5, {_mean('close', 20)} as ma20, {_mean('volume', 20)} as vma20
    from n window
    {', '.join(f'w{k} as (partition by stock_id, source order by trade_date rows between {k - 1} preceding and current row)' for k in (5, 20))})"""


@query(
    "incremental_run",
    days="trade_date",
    sql=f"""{_FULL} select stock_id, source, trade_date, round(ma5, 6) as ma5, round(ma20, 6) as ma20, round(vma20, 6)
    as vma20 from c""",
)
def _(spark, d):
    run, _, _ = _panel(spark, d)
    return rounded(run.drop("computed_at"), ["ma5", "ma20", "vma20"])


@query(
    "incremental_residues",
    """select * from (values ('ma5', 0.0::double, 0::bigint), ('ma20', 0.0, 0), ('vma20', 0.0, 0)) t(metric, residue,
    differ)""",
)
def _(spark, d):
    run, full, _ = _panel(spark, d)
    return incremental.largest_residues(run, full, ["ma5", "ma20", "vma20"]).select("metric", "residue", "differ")


@query(
    "incremental_tolerance",
    f"""{_FULL} select m as metric, count(*) as rows, count(*) as exact, count(*) as within_tolerance from c, (values
    ('ma5'), ('ma20'), ('vma20')) t(m) group by 1""",
)
def _(spark, d):
    run, full, now = _panel(spark, d)
    return incremental.compare_series(run, full, now, ["ma5", "ma20", "vma20"])


@query(
    "incremental_coverage",
    f"""{with_('versions')}, d as (select distinct stock_id, source, trade_date, volume % 41 = 0 as gone from
    versions), s as (select stock_id, source, trade_date from d where not gone), i as (select distinct stock_id,
    source, trade_date from d where day(trade_date) <> 7)
    select stock_id, source, count(*) filter (a) as stored_only, count(*) filter (b) as input_only from (select
    coalesce(s.stock_id, i.stock_id) as stock_id, coalesce(s.source, i.source) as source, i.stock_id is null as a,
    s.stock_id is null as b from (select distinct * from s) s full join i using (stock_id, source, trade_date)) group
    by 1, 2 having count(*) filter (a) > 0 or count(*) filter (b) > 0""",
)
def _(spark, d):
    v = versions(spark, d)
    return incremental.coverage_mismatches(v.where("volume % 41 <> 0"), v.where("day(trade_date) <> 7"))


@query(
    "incremental_streak_restarts",
    f"""{with_('flows')}, x as (select *, coalesce(sign(net), 0) as s from flows),
    y as (select *, case when s <> coalesce(lag(s) over w, 9) then 1 else 0 end as b from x
        window w as (partition by stock_id, source order by trade_date)),
    z as (select *, sum(b) over (partition by stock_id, source order by trade_date) as g from y),
    r as (select *, s * row_number() over (partition by stock_id, source, g order by trade_date) as k from z)
    select stock_id, source from r where trade_date >= date '2024-01-10'
        qualify row_number() over (partition by stock_id, source order by trade_date) = 1 and abs(k) >= 3""",
)
def _(spark, d):
    f = flows(spark, d)
    computed = metrics.streaks(f, ["net"])
    changed = f.select(*SERIES).distinct().withColumn("start", F.lit("2024-01-10").cast("date"))
    return incremental.streak_restarts(computed, changed, ["net"], 3)
