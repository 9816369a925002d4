"""Queries of the point-in-time and append operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import instants
from tidemark.datasets import Dataset, dataset
from tidemark.operators import append, derived, metrics, pit, reads, rolling
from tidemark.plans.panels import actions, facts, reports, table, versions, with_
from tidemark.plans.queries_metrics import PLACES
from tidemark.plans.registry import query
from tidemark.sources import tables

KEY = ["stock_id", "source", "trade_date"]
SERIES = ["stock_id", "source"]
DAILY = instants.exchange_daily_settled
#: The instant that most reads look from.
AT = "1998-06-30 12:00:00"


def at(text: str = AT):
    return F.lit(text).cast("timestamp_ntz")


def available(spark: SparkSession, d: str) -> DataFrame:
    return pit.with_available_at(versions(spark, d), KEY, "trade_date", DAILY)


@query(
    "pit_available_at",
    days="trade_date",
    sql=f"""{with_('available')} select stock_id, source, trade_date, recorded_at, close, volume, available_at from
    available""",
)
def _(spark, d):
    return available(spark, d)


@query(
    "pit_market_latest",
    days="trade_date",
    sql=f"""{with_('available')} select stock_id, source, trade_date, recorded_at, close, volume, available_at from
    available
    where available_at <= timestamp '{AT}' and recorded_at <= timestamp '{AT}' qualify row_number() over (partition by
    stock_id, source, trade_date order by recorded_at desc) = 1""",
)
def _(spark, d):
    return pit.market_pit(available(spark, d), KEY, at(), at())


@query(
    "pit_market_knowledge_cutoff",
    days="trade_date",
    sql=f"""{with_('available')} select stock_id, source, trade_date, recorded_at, close, volume, available_at from
    available
    where available_at <= timestamp '{AT}' and recorded_at <= timestamp '1998-06-01 00:00:00' qualify row_number()
    over (partition by stock_id, source, trade_date order by recorded_at desc) = 1""",
)
def _(spark, d):
    return pit.market_pit(available(spark, d), KEY, at(), at("1998-06-01 00:00:00"))


@query(
    "pit_system_latest",
    days="trade_date",
    sql=f"""{with_('versions')} select * from versions where recorded_at <= timestamp '{AT}' qualify row_number() over
    (partition by stock_id, source, trade_date order by recorded_at desc) = 1""",
)
def _(spark, d):
    return pit.system_pit(versions(spark, d), KEY, at())


MA20_SQL = f"""{with_('available')}, visible as (select * from available where available_at <= timestamp '{AT}' and
    recorded_at <= timestamp '{AT}'
    qualify row_number() over (partition by stock_id, source, trade_date order by recorded_at desc) = 1)
    select stock_id, source, trade_date, round(case when count(close) over w = 20 then sum(close::decimal(28,6)) over
    w::double / 20 end, 6) as ma20 from visible
    window w as (partition by stock_id, source order by trade_date rows between 19 preceding and current row)"""


@query("pit_ma20", days="trade_date", sql=MA20_SQL)
def pit_ma20(spark, d):
    """The 20-day average of close as the market could see it at one instant."""
    visible = pit.market_pit(available(spark, d), KEY, at(), at())
    return visible.select(*KEY, F.round(metrics.moving_average("close", 20), 6).alias("ma20"))


@query(
    "release_rules",
    days="trade_date quarter_start quarter_end",
    sql="""with days as (select distinct l_shipdate::date as d from lineitem)
    select d as trade_date, d::timestamp + interval 19 hour as daily, (d + (7 - isodow(d) + case when isodow(d) = 7
    then 7 else 0 end)::int)::timestamp + interval 4 hour as weekly,
    d::timestamp - interval 8 hour as ex_date, (d + 1)::timestamp - interval 8 hour as announcement,
    (date_trunc('month', d) + interval 2 month)::timestamp - interval 8 hour as monthly_page,
    last_day(d)::timestamp + interval 19 hour as month_file, make_date(year(d) + 1, 1, 1)::timestamp - interval 8 hour
    as year_end,
    case quarter(d) when 1 then make_date(year(d), 5, 16) when 2 then make_date(year(d), 8, 16) when 3 then
    make_date(year(d), 11, 16) else make_date(year(d) + 1, 4, 1) end::timestamp - interval 8 hour as report_deadline,
    make_date(year(d), quarter(d) * 3 - 2, 1) as quarter_start, last_day(make_date(year(d), quarter(d) * 3, 1)) as
    quarter_end, year(d) * 4 + quarter(d) - 1 as quarter_index from days""",
)
def _(spark, d):
    days = table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("trade_date")).distinct()
    c, y, q = F.col("trade_date"), F.year("trade_date"), F.quarter("trade_date")
    return days.select(
        "trade_date",
        instants.exchange_daily_settled(c).alias("daily"),
        instants.weekly_sunday_noon(c).alias("weekly"),
        instants.ex_date_midnight(c).alias("ex_date"),
        instants.announcement_next_day(c).alias("announcement"),
        instants.monthly_page_settled(c).alias("monthly_page"),
        instants.month_file_settled(c).alias("month_file"),
        instants.year_settled(y).alias("year_end"),
        instants.report_deadline(y, q).alias("report_deadline"),
        instants.quarter_start(y, q).alias("quarter_start"),
        instants.quarter_end(y, q).alias("quarter_end"),
        instants.quarter_index(y, q).alias("quarter_index"),
    )


REPORT = ["stock_id", "report_year", "report_quarter"]


@query(
    "pit_published_family",
    f"""{with_('reports')} select id, stock_id, report_year, report_quarter, recorded_at, case when recorded_at =
    min(recorded_at) over (partition by stock_id, report_year, report_quarter) then published_at else recorded_at end
    as available_at from reports""",
)
def _(spark, d):
    return pit.with_published_at(reports(spark, d), REPORT).select("id", *REPORT, "recorded_at", "available_at")


@query(
    "pit_retracted_hidden",
    days="ex_date",
    sql=f"""{with_('actions')}, one as (select * from actions qualify row_number() over (partition by stock_id,
    source, ex_date, recorded_at order by o_orderkey) = 1),
    a as (select *, ex_date::timestamp - interval 8 hour as released, min(case when recorded_at >= ex_date::timestamp
    - interval 8 hour then recorded_at end) over (partition by stock_id, source, ex_date) as settled from one),
    v as (select *, case when recorded_at >= released and recorded_at > settled then recorded_at else released end as
    available_at from a),
    l as (select * from v where available_at <= timestamp '{AT}' and recorded_at <= timestamp '{AT}' qualify
    row_number() over (partition by stock_id, source, ex_date order by recorded_at desc) = 1)
    select stock_id, source, ex_date, recorded_at, event_factor from l where not retracted""",
)
def _(spark, d):
    one = pit.latest_per_key(
        actions(spark, d).withColumn("__o", -F.col("o_orderkey")),
        ["stock_id", "source", "ex_date", "recorded_at"],
        "__o",
    )
    a = pit.with_available_at(one, ["stock_id", "source", "ex_date"], "ex_date", instants.ex_date_midnight)
    return pit.market_pit(a, ["stock_id", "source", "ex_date"], at(), at(), hidden="retracted").select(
        "stock_id", "source", "ex_date", "recorded_at", "event_factor"
    )


@query(
    "pit_late_keys",
    days="trade_date",
    sql=f"""{with_('available')} select stock_id, source, trade_date, arg_max(available_at, recorded_at) as late_at
    from available group by 1, 2, 3 having count(*) > 1""",
)
def _(spark, d):
    return pit.late_keys(available(spark, d), KEY)


@query(
    "pit_late_reports",
    days="observed_on",
    sql=f"""{with_('reports')}, l as (select stock_id, report_year, report_quarter, max(recorded_at) as late_at,
        min_by(coalesce(published_at, timestamp '1800-01-01'), recorded_at) as p from reports group by 1, 2, 3
        having count(*) > 1)
    select stock_id, report_year, report_quarter, late_at,
        case when p > timestamp '1900-01-01' then (p + interval 8 hour)::date end as observed_on from l""",
)
def _(spark, d):
    return pit.late_reports(reports(spark, d), REPORT)


_DERIVED = """, late as (select stock_id, source, trade_date, arg_max(available_at, recorded_at) as late_at from
    available group by 1, 2, 3 having count(*) > 1), days as (select distinct stock_id, source, trade_date from
    versions)"""


@query(
    "pit_derived_history",
    days="trade_date",
    sql=f"""{with_('available')}{_DERIVED} select stock_id, source, trade_date, greatest(trade_date::timestamp +
    interval 19 hour, max(late_at) over (partition by stock_id, source order by trade_date)) as available_at from days
    left join late using (stock_id, source, trade_date)""",
)
def _(spark, d):
    return pit.derived_history(available(spark, d), KEY, SERIES, "trade_date", DAILY)


@query(
    "pit_derived_day",
    days="trade_date",
    sql=f"""{with_('available')}{_DERIVED} select stock_id, source, trade_date, greatest(trade_date::timestamp +
    interval 19 hour, late_at) as available_at from days left join late using (stock_id, source, trade_date)""",
)
def _(spark, d):
    a = available(spark, d)
    return pit.derived_available_at(
        a.select(*KEY).distinct(), pit.late_keys(a, KEY), SERIES, "trade_date", DAILY, scope="day"
    )


@query(
    "pit_rolling_as_of",
    days="trade_date",
    sql=f"""{with_('available')}, days as (select stock_id, source, trade_date, row_number() over (partition by
    stock_id, source order by trade_date) as i from (select distinct stock_id, source, trade_date from versions)),
    seen as (select a.stock_id, a.source, a.trade_date as seen_on, v.trade_date, v.close from days a join days b on
    a.stock_id = b.stock_id and a.source = b.source and b.i between a.i - 4 and a.i
        join available v on v.stock_id = b.stock_id and v.source = b.source and v.trade_date = b.trade_date and
        v.available_at <= a.trade_date::timestamp + interval 19 hour
        qualify row_number() over (partition by a.stock_id, a.source, a.trade_date, v.trade_date order by
        v.recorded_at desc) = 1)
    select stock_id, source, seen_on as trade_date, round(case when count(*) = 5 then
    sum(close::decimal(28,6))::double / 5 end, 6) as ma5 from seen group by 1, 2, 3""",
)
def _(spark, d):
    return pit.rolling_as_of(
        available(spark, d),
        SERIES,
        "trade_date",
        DAILY,
        lambda rows, by: rows.select(*by, "trade_date", F.round(metrics.moving_average("close", 5, by), 6).alias("ma5")),
        lookback=5,
    )


def _along(rows: str, first: str, step: str) -> str:
    """A recurrence along a list of a group, in date order: an accumulator that starts as the first element."""
    return f"list_reduce(list_transform({rows}, lambda x: {first}), lambda a, x: {step})"


#: Every date's visible closes and volumes in order, then each metric of the whole list's last place.
_ROLLING = f"""{with_('available')}, cut as (select distinct stock_id, source, trade_date as day,
    trade_date::timestamp + interval 19 hour as cutoff from versions),
    seen as (select c.stock_id, c.source, c.day, v.trade_date, max(v.recorded_at) as seen_at, max_by({{'c': v.close, 'v': v.volume}}, v.recorded_at)
    as r from cut c join available v on v.stock_id = c.stock_id and v.source = c.source and v.trade_date <= c.day and
    v.available_at <= c.cutoff group by 1, 2, 3, 4),
    w as (select stock_id, source, day, trade_date, strftime(trade_date, '%Y-%m-%d') || '@' || strftime(seen_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' as item, r.c as c, r.v as v, case when count(*) over nine = 9 and max(r.c)
    over nine + 1 > min(r.c) over nine - 1 then (r.c - (min(r.c) over nine - 1)) / (max(r.c) over nine + 1 - (min(r.c)
    over nine - 1)) * 100 else 50.0 end as rsv,
        r.c - lag(r.c) over (partition by stock_id, source, day order by trade_date) as change from seen window nine
        as (partition by stock_id, source, day order by trade_date rows between 8 preceding and current row)),
    l as (select stock_id, source, day, count(*) as input_count, sha256(string_agg(item, ',' order by trade_date)) as input_fingerprint, list(c order by trade_date) as c, list(v order by trade_date) as v, list(rsv
    order by trade_date) as rsv, list(change order by trade_date) filter (change is not null) as ch from w group by 1,
    2, 3),
    m as (select stock_id, source, day as trade_date, input_count, input_fingerprint, c, v, len(c) as n, c[-20:] as c20,
        {_along("rsv", "{'k': x, 'd': x}", "{'k': a.k * 2 / 3 + x.k / 3, 'd': a.d * 2 / 3 + (a.k * 2 / 3 + x.k / 3) / 3}")}
        as kd,
        {_along("c", "{'f': x, 's': x, 'e': 0.0::double}", "{'f': a.f * 11 / 13 + x.f * 2 / 13, 's': a.s * 25 / 27 + x.s * 2 / 27, 'e': a.e * 0.8 + ((a.f * 11 / 13 + x.f * 2 / 13) - (a.s * 25 / 27 + x.s * 2 / 27)) * 0.2}")}
        as macd,
        {_along("ch", "{'g': greatest(x, 0), 'l': greatest(-x, 0)}", "{'g': a.g * 5 / 6 + x.g, 'l': a.l * 5 / 6 + x.l}")}
        as r6,
        {_along("ch", "{'g': greatest(x, 0), 'l': greatest(-x, 0)}", "{'g': a.g * 11 / 12 + x.g, 'l': a.l * 11 / 12 + x.l}")}
        as r12 from l)
    select stock_id, source, trade_date, input_count, input_fingerprint,
    {', '.join(f"round(case when n >= {k} then list_sum({c}[-{k}:])::double / {k} end, 6) as {p}ma{k}" for p, c in (('', 'c'), ('v', 'v')) for k in metrics.WINDOWS)},
    round(kd.k, 4) as k, round(kd.d, 4) as d,
    {', '.join(f"round(case when n > {k} and r{k}.g + r{k}.l > 0 then 100 * r{k}.g / (r{k}.g + r{k}.l) end, 4) as rsi{k}" for k in (6, 12))},
    round(macd.f - macd.s, 4) as macd_dif, round(macd.e, 4) as macd_dea, round(macd.f - macd.s - macd.e, 4) as
    macd_hist,
    {', '.join(f"round(case when n >= 20 then list_sum(c20)::double / 20 {w} end, 4) as bb_{b}" for b, w in (('upper', '+ 2 * list_stddev_samp(c20)'), ('middle', ''), ('lower', '- 2 * list_stddev_samp(c20)')))}
    from m"""


@query("pit_rolling_panel", days="trade_date", sql=_ROLLING)
def _(spark, d):
    """All 22 metrics of every date as the market saw them at its own release instant."""
    rows = available(spark, d).withColumn("high", F.col("close") + 1).withColumn("low", F.col("close") - 1)
    return rolling.rolling_panel(rows, DAILY, places=PLACES, dealt=True)


@query(
    "pit_lineage",
    days="trade_date",
    sql=f"""{with_('versions')}, m as (select * replace (recorded_at + to_microseconds(volume % 4 * 250100) as
    recorded_at) from versions),
    v as (select * from m qualify row_number() over (partition by stock_id, source, trade_date order by recorded_at
    desc) = 1),
    i as (select *, strftime(trade_date, '%Y-%m-%d') || '@' || case when volume % 4 = 0 then strftime(recorded_at,
    '%Y-%m-%dT%H:%M:%S') else strftime(recorded_at, '%Y-%m-%dT%H:%M:%S.%f') end || '+00:00' as item from v)
    select stock_id, source, trade_date, count(*) over w as input_count, sha256(string_agg(item, ',') over w) as
    input_fingerprint
    from i window w as (partition by stock_id, source order by trade_date rows between unbounded preceding and current
    row)""",
)
def _(spark, d):
    """Three of four versions are recorded at a fraction of a second."""
    micros = F.expr("make_dt_interval(0, 0, 0, cast(volume % 4 * 0.2501 as decimal(18, 6)))")
    rows = pit.latest_per_key(versions(spark, d).withColumn("recorded_at", F.col("recorded_at") + micros), KEY)
    return pit.with_lineage(rows, SERIES, "trade_date").select(*KEY, "input_count", "input_fingerprint")


@query(
    "pit_look_ahead_audit",
    f"""{with_('available')}, probes as (select available_at + to_seconds(s) as probe from (select min(available_at)
    as available_at from available group by date_trunc('month', available_at)), (select unnest([-1, 1]) as s))
    select probe, 0::bigint as leaked, count(distinct (stock_id, source, trade_date)) filter (stock_id is not null) as
    visible from probes left join available on available_at <= probe and recorded_at <= probe group by probe""",
)
def _(spark, d):
    a = available(spark, d)
    instants_ = a.groupBy(F.date_trunc("month", "available_at")).agg(F.min("available_at").alias("available_at"))
    probes = instants_.select(
        F.explode(
            F.array(
                F.col("available_at") - F.expr("interval 1 second"), F.col("available_at") + F.expr("interval 1 second")
            )
        ).alias("probe")
    ).distinct()
    return pit.look_ahead_audit(a, KEY, probes)


@query(
    "pit_single_source",
    f"""{with_('versions')}, m as (select *, case when stock_id::int % 5 = 0 and volume % 2 = 0 then 'gamma' else
    source end as s2 from versions)
    select stock_id, min(s2) as source, count(*) as n from m group by 1 having min(s2) = max(s2)""",
)
def _(spark, d):
    v = versions(spark, d).withColumn(
        "source",
        F.when(
            (F.col("stock_id").cast("int") % 5 == 0) & (F.col("volume") % 2 == 0), "gamma"
        ).otherwise(F.col("source")),
    )
    return pit.single_source(v, several="drop").groupBy("stock_id", "source").agg(F.count("*").alias("n"))


@query(
    "pit_report_facts",
    days="period_start period_end",
    sql=f"""{with_('facts')}, latest as (select * from reports qualify row_number() over (partition by stock_id,
    report_year, report_quarter order by recorded_at desc) = 1)
    select report_id, statement, account_code, period_start, period_end, value, stock_id, report_year, report_quarter
    from facts join latest on id = report_id where statement = 'income_statement' and account_code in ('9750',
    '8610')""",
)
def _(spark, d):
    r = reports(spark, d)
    latest = pit.latest_per_key(r, REPORT)
    f = facts(r).withColumn("concept", F.lit("c"))
    return pit.report_facts(latest, f, ["income_statement"], ["9750", "8610"]).drop("concept")


def split_versions(spark, d):
    v = versions(spark, d)
    return v.where("recorded_at >= timestamp_ntz'1998-01-01 00:00:00'"), v.where(
        "recorded_at < timestamp_ntz'1998-01-01 00:00:00'"
    )


_INCOMING = """, stored as (select * from changed_days where part = 0), incoming as (select * from changed_days where
    part = 1)"""
_CHANGED = """, changed_days as (select stock_id, source, l_shipdate_month as trade_date, volume, close, recorded_at,
    part from (select stock_id, source, date_trunc('month', trade_date)::date as l_shipdate_month, volume, close,
    recorded_at,
    case when volume % 3 = 0 then 1 else 0 end as part from versions))"""
_OLD = """, old as (select * from stored qualify row_number() over (partition by stock_id, source, trade_date order by
    recorded_at desc) = 1)"""


def monthly(spark, d):
    v = versions(spark, d).withColumn("trade_date", F.trunc("trade_date", "month"))
    return v.where("volume % 3 = 0"), v.where("volume % 3 <> 0")


@query(
    "append_changed",
    days="trade_date",
    sql=f"""{with_('versions')}{_CHANGED}{_INCOMING}{_OLD} select i.stock_id, i.source, i.trade_date, i.recorded_at,
    i.close, i.volume from incoming i left join old o using (stock_id, source, trade_date)
    where o.stock_id is null or o.volume is distinct from i.volume or floor(o.close) is distinct from floor(i.close)""",
)
def _(spark, d):
    incoming, stored = monthly(spark, d)
    flat = lambda df: df.withColumn("c", F.floor("close"))
    return append.append_changed(flat(incoming), flat(stored), KEY, ["volume", "c"]).drop("c")


@query(
    "append_versions",
    days="trade_date",
    sql=f"""{with_('versions')}, x as (select *, lag({{'v': volume % 3}}) over (partition by stock_id, source, trade_date
    order by recorded_at) as before, volume % 3 as v from versions)
    select stock_id, source, trade_date, recorded_at, v from x where before is null or before.v <> v""",
)
def _(spark, d):
    """All versions of all keys, those before 1996 stored and all others coming in one batch."""
    v = versions(spark, d).select(*KEY, "recorded_at", (F.col("volume") % 3).alias("v"))
    early, none = F.col("recorded_at") < F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"), v.limit(0)
    stored = append.append_versions(v.where(early), none, KEY, ["v"])
    return stored.unionByName(append.append_versions(v.where(~early), stored, KEY, ["v"]))


@query(
    "append_counters",
    f"""{with_('versions')}{_CHANGED}{_INCOMING}{_OLD} select source, count(*) as parsed, count(*) filter (not oos and
    (vo is null or vo <> v)) as appended, count(*) filter (not oos and vo is null) as new_keys,
    count(*) filter (not oos and vo = v) as unchanged, count(*) filter (oos) as out_of_scope from (select i.source,
    i.volume % 2 as v, o.volume % 2 as vo, i.stock_id::int % 7 = 0 as oos from incoming i left join old o using
    (stock_id, source, trade_date)) group by 1""",
)
def _(spark, d):
    incoming, stored = monthly(spark, d)
    v = F.col("volume") % 2
    return append.ingest_counters(
        incoming.withColumn("v", v).withColumn("out_of_scope", F.col("stock_id").cast("int") % 7 == 0),
        stored.withColumn("v", v),
        KEY,
        ["v"],
        ["source"],
    )


@query(
    "append_published_stamp",
    f"""{with_('reports')}, i as (select * from reports where n % 2 = 0), o as (select * from reports where n % 2 = 1
    qualify row_number() over (partition by stock_id, report_year, report_category order by recorded_at desc, id desc)
    = 1)
    select i.id, case when o.id is null then i.published_at end as published_at from i left join o using (stock_id,
    report_year, report_category)""",
)
def _(spark, d):
    r = reports(spark, d)
    judged = append.with_latest(
        r.where("n % 2 = 0"), r.where("n % 2 = 1"), ["stock_id", "report_year", "report_category"], ["n"]
    )
    return append.stamp_published(judged, "first_capture").select("id", "published_at")


@query(
    "append_retractions",
    days="ex_date",
    sql=f"""{with_('actions')}, one as (select * from actions qualify row_number() over (partition by stock_id,
    source, ex_date order by recorded_at desc, o_orderkey desc) = 1)
    select stock_id, source, ex_date from one where not retracted and ex_date between date '1996-01-01' and date
    '1997-12-31' and (stock_id, source, ex_date) not in (select (stock_id, source, ex_date) from actions where
    o_orderkey % 3 = 0)""",
)
def _(spark, d):
    a = actions(spark, d)
    return append.retractions(
        a.where("o_orderkey % 3 = 0"),
        pit.latest_per_key(
            a.withColumn("__b", F.struct("recorded_at", "o_orderkey")), ["stock_id", "source", "ex_date"], "__b"
        ).drop("__b"),
        ["stock_id", "source", "ex_date"],
        F.lit("1996-01-01").cast("date"),
        F.lit("1997-12-31").cast("date"),
        "ex_date",
    ).select("stock_id", "source", "ex_date")


@query(
    "append_executed_counts",
    f"""{with_('actions')} select count(*) filter (ex_date <= date '1998-06-30') as kept, count(*) filter (ex_date >
    date '1998-06-30') as future from actions""",
)
def _(spark, d):
    return append.executed_counts(actions(spark, d), "ex_date", F.lit("1998-06-30").cast("date"))


@query(
    "append_report_fingerprints",
    f"""{with_('facts')} select report_id, sha256(string_agg(line, chr(10) order by line)) as fingerprint, count(*) as
    facts from
    (select report_id, statement || '|' || account_code || '|' || coalesce(period_start::varchar, '\\N') || '|' ||
    period_end::varchar || '|' || value::varchar as line from facts) group by 1""",
)
def _(spark, d):
    f = facts(reports(spark, d)).withColumn("value", F.col("value").cast("decimal(20,2)"))
    return append.fact_fingerprints(
        f, ["report_id"], ["statement", "account_code", "period_start", "period_end", "value"]
    )


@query(
    "append_category_fallback",
    f"""{with_('reports')}, c as (select *, case when report_category = 'consolidated' then 'C' else 'A' end as
    category from reports where id < 50000000)
    select stock_id, report_year, case when bool_or(category = 'C') then 'C' else 'A' end as category from c group by
    1, 2""",
)
def _(spark, d):
    r = reports(spark, d).where("id < 50000000").select(
        "stock_id",
        "report_year",
        F.when(F.col("report_category") == "consolidated", "C").otherwise("A").alias("category"),
    )
    return append.category_fallback(r, ["stock_id", "report_year"])


def fetches(spark, d):
    """A fetch log from events: user and page to resource, kind to status."""
    e = table(spark, d, "events")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "empty").when(
        F.col("event_type") == "click", "quarantined"
    ).otherwise("succeeded")
    return e.select(
        (F.col("user_id") % 3).cast("string").alias("dataset"),
        F.lit("feed").alias("source"),
        F.concat_ws("/", F.col("user_id").cast("string"), F.dayofmonth("ts").cast("string")).alias("resource_key"),
        status.alias("status"),
        F.when(
            F.col("event_type") == "click",
            F.when(F.col("event_id") % 2 == 0, "outside_universe").otherwise("malformed"),
        ).alias("reason_code"),
        F.col("ts").alias("fetched_at"),
        F.col("event_id").alias("attempt"),
        F.col("event_id").cast("string").alias("id"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("hex"),
    )


_FETCH = """with fetches as (select (user_id % 3)::varchar as dataset, 'feed' as source, user_id::varchar || '/' ||
    day(ts)::varchar as resource_key,
    case event_type when 'error' then 'failed' when 'signup' then 'empty' when 'click' then 'quarantined' else
    'succeeded' end as status, case when event_type = 'click' then case when event_id % 2 = 0 then 'outside_universe'
    else 'malformed' end end as reason_code,
    ts as fetched_at, event_id as attempt from events), latest as (select * from fetches qualify row_number() over
    (partition by dataset, source, resource_key order by fetched_at desc, attempt desc) = 1)"""


@query("fetch_latest", f"{_FETCH} select * from latest")
def _(spark, d):
    return append.latest_fetch(fetches(spark, d).drop("id", "hex"))


@query(
    "fetch_pending",
    f"""{_FETCH}, expected as (select distinct (user_id % 3)::varchar as dataset, 'feed' as source, user_id::varchar
    || '/' || g::varchar as resource_key, make_date(2024, 1, g::int)::timestamp + interval 6 hour as settled_at from
    events, generate_series(1, 31) t(g))
    select e.* from expected e left join latest l using (dataset, source, resource_key) where not coalesce((l.status =
    'succeeded' and l.fetched_at >= e.settled_at) or (l.status = 'quarantined' and l.reason_code =
    'outside_universe'), false)""",
)
def _(spark, d):
    days = spark.sql("select explode(sequence(1, 31)) as g")
    users = table(spark, d, "events").select("user_id").distinct()
    grid = append.expected_grid(users, days)
    expected = grid.select(
        (F.col("user_id") % 3).cast("string").alias("dataset"),
        F.lit("feed").alias("source"),
        F.concat_ws("/", F.col("user_id").cast("string"), F.col("g").cast("string")).alias("resource_key"),
        (F.make_date(F.lit(2024), F.lit(1), "g").cast("timestamp_ntz") + F.expr("interval 6 hours")).alias("settled_at"),
    )
    return append.pending(expected, fetches(spark, d), final=["outside_universe"])


@query(
    "fetch_run_report",
    f"""{_FETCH} select dataset, count(*) filter (status = 'succeeded') as succeeded, count(*) filter (status =
    'empty') as empty, count(*) filter (status = 'failed') as failed, count(*) filter (status = 'quarantined') as
    quarantined,
    count(*) filter (status in ('failed', 'empty')) > 0 as needs_attention from latest group by 1""",
)
def _(spark, d):
    return append.run_report(append.latest_fetch(fetches(spark, d)))


@query(
    "fetch_sweeps_done",
    f"""{_FETCH} select split_part(resource_key, '/', 2) as day, bool_and(status = 'succeeded') as done, count(*) as
    pages from latest group by 1""",
)
def _(spark, d):
    f = fetches(spark, d)
    expected = f.select(
        "dataset", "source", "resource_key", F.split_part("resource_key", F.lit("/"), F.lit(2)).alias("day")
    ).distinct()
    return append.sweeps_done(expected, f, ["day"])


@query(
    "fetch_provenance",
    """select event_id::varchar as fetch_id, sha256(event_id::varchar) as sha256 from events where event_id % 10 = 0
    or event_id % 15 = 1""",
)
def _(spark, d):
    f = fetches(spark, d).withColumn("sha256", F.unhex("hex"))
    n = F.col("id").cast("bigint")
    rows = f.select(
        F.when(n % 10 == 0, F.col("id")).alias("fetch_id"), F.when(n % 15 == 1, F.col("id")).alias("detail_fetch_id")
    )
    return append.provenance(rows, f, ["fetch_id", "detail_fetch_id"])


def calendar(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("trade_date")).distinct()


@query(
    "expected_periods",
    """with cal as (select distinct l_shipdate::date as trade_date from lineitem), x as (select trade_date from cal
    where trade_date between date '1996-01-10' and date '1997-02-20')
    select 'day' as kind, trade_date::varchar as period from x union all select distinct 'month', date_trunc('month',
    trade_date)::date::varchar from x
    union all select 'quarter', year(q)::varchar || 'Q' || quarter(q)::varchar from generate_series(date '1996-01-01',
    date '1997-02-20', interval 3 month) t(q) where last_day(q + interval 2 month) between date '1996-01-10' and date
    '1997-02-20'""",
)
def _(spark, d):
    cal, a, z = calendar(spark, d), F.lit("1996-01-10").cast("date"), F.lit("1997-02-20").cast("date")
    days = append.expected_days(cal, a, z).select(
        F.lit("day").alias("kind"), F.col("period").cast("string").alias("period")
    )
    months = append.expected_months(cal, a, z).select(
        F.lit("month").alias("kind"), F.col("period").cast("string").alias("period")
    )
    quarters = append.expected_quarters(spark, "1996-01-10", "1997-02-20").select(
        F.lit("quarter").alias("kind"),
        F.concat(
            F.col("report_year").cast("string"), F.lit("Q"), F.col("report_quarter").cast("string")
        ).alias("period"),
    )
    return days.unionByName(months).unionByName(quarters)


@query(
    "reconciliation_dates",
    days="trade_date",
    sql="""with cal as (select distinct l_shipdate::date as d from lineitem),
    eff as (select distinct o_orderdate::date as e from orders),
    x as (select (select max(d) from cal where d < e) as b, (select min(d) from cal where d >= e) as a from eff
        union all select min(d), max(d) from cal)
    select distinct trade_date from (select unnest([b, a]) as trade_date from x) where trade_date is not null""",
)
def _(spark, d):
    eff = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("effective_date"))
    return append.reconciliation_dates(calendar(spark, d), eff)


@query(
    "latest_payload_listing",
    days="listed_on delisted_on last_listed",
    sql="""with p as (select user_id % 5 as s, ts::date as trade_date, max(ts) as fetched_at from events group by 1,
    2), spans as (select distinct user_id::varchar as stock_id, date '2024-01-05' as listed_on, case when user_id % 2
    = 0 then date '2024-01-20' end as delisted_on from events),
    listed as (select distinct user_id::varchar as stock_id, ts::date as trade_date from events) select s.stock_id,
    s.listed_on, s.delisted_on, max(l.trade_date) as last_listed from spans s left join listed l on s.stock_id =
    l.stock_id and l.trade_date >= listed_on and (delisted_on is null or l.trade_date < delisted_on) group by 1, 2, 3""",
)
def _(spark, d):
    e = table(spark, d, "events")
    whole = e.groupBy(
        (F.col("user_id") % 5).cast("string").alias("source"), F.col("ts").cast("date").alias("trade_date")
    ).agg(
        F.max("ts").alias("fetched_at"), F.collect_set(F.col("user_id").cast("string")).alias("stock_ids")
    )
    older = whole.withColumn("fetched_at", F.col("fetched_at") - F.expr("interval 1 day")).withColumn(
        "stock_ids", F.array().cast("array<string>")
    )
    spans = e.select(
        F.col("user_id").cast("string").alias("stock_id"),
        F.lit("2024-01-05").cast("date").alias("listed_on"),
        F.when(F.col("user_id") % 2 == 0, F.lit("2024-01-20").cast("date")).alias("delisted_on"),
    ).distinct()
    return append.latest_payload_listing(whole.unionByName(older), spans)


ARRIVED = dt.datetime(2024, 6, 1, tzinfo=dt.UTC)
#: The version panel as a dataset.
PANEL = Dataset("panel", dataset("daily_prices").schema, tuple(KEY), "trade_date", DAILY)


@query(
    "read_market_context",
    days="trade_date",
    sql=f"""{with_('available')} select stock_id, source, trade_date, recorded_at, close, volume, available_at from
    available
    where stock_id in ('1', '2', '3', '5') and source = 'beta' and trade_date between date '1996-01-01' and date
    '1998-12-31' and available_at <= timestamp '{AT}' and recorded_at <= timestamp '1998-06-01 00:00:00'
    qualify row_number() over (partition by stock_id, source, trade_date order by recorded_at desc) = 1""",
)
def _(spark, d):
    """A read by descriptor at two instants given with different offsets, narrowed by range, stocks and source."""
    at = reads.context(ARRIVED, information_as_of="1998-06-30T20:00:00+08:00", knowledge_as_of="1998-06-01T00:00:00Z")
    return reads.visible(
        versions(spark, d), PANEL, at, dt.date(1996, 1, 1), dt.date(1998, 12, 31), ["1", "2", "3", "5"], ["beta"]
    )


@query(
    "read_system_context",
    days="trade_date",
    sql=f"""{with_('available')} select stock_id, source, trade_date, recorded_at, close, volume, available_at from
    available
    where recorded_at <= timestamp '{AT}' qualify row_number() over (partition by stock_id, source, trade_date order
    by recorded_at desc) = 1""",
)
def _(spark, d):
    return reads.visible(versions(spark, d), PANEL, reads.context(ARRIVED, system_as_of="1998-06-30T12:00:00+00:00"))


@query(
    "read_reports_context",
    days="",
    sql=f"""{with_('reports')}, a as (select *, case when recorded_at = min(recorded_at) over (partition by stock_id,
    report_year, report_quarter) then published_at else recorded_at end as available_at from reports
    where last_day(make_date(report_year, report_quarter * 3, 1)) between date '1996-03-31' and date '1998-06-30')
    select id, stock_id, report_year, report_quarter, recorded_at, available_at from a
    where available_at <= timestamp '1998-03-01' qualify row_number() over (partition by stock_id, report_year,
    report_quarter order by recorded_at desc) = 1""",
)
def _(spark, d):
    """Reports are filed under the last day of their quarter and public as published."""
    at = reads.context(ARRIVED, information_as_of="1998-03-01T00:00:00+00:00")
    found = reads.visible(
        reports(spark, d), dataset("financial_reports"), at, dt.date(1996, 3, 31), dt.date(1998, 6, 30)
    )
    return found.select("id", *REPORT, "recorded_at", "available_at")


@query(
    "read_derived_context",
    days="trade_date",
    sql=f"""{with_('available')}{_DERIVED}, x as (select stock_id, source, trade_date, greatest(trade_date::timestamp
    + interval 19 hour, max(late_at) over (partition by stock_id, source order by trade_date)) as available_at from
    days left join late using (stock_id, source, trade_date))
    select * from x where available_at <= timestamp '{AT}' and trade_date >= date '1996-01-01'""",
)
def _(spark, d):
    """Stored rows of a derived dataset that were public at an instant: none before the latest correction of its
    inputs."""
    v = versions(spark, d)
    dataset_ = derived.derived_datasets({}, {})["technical_indicators"]
    at = reads.context(ARRIVED, information_as_of="1998-06-30T12:00:00+00:00")
    return reads.derived_rows(
        v.select(*KEY).distinct(), dataset_, {"daily_prices": (v, PANEL)}, at, ARRIVED, dt.date(1996, 1, 1)
    )


@query(
    "store_append_and_read",
    days="trade_date",
    sql="""with o as (select distinct o_custkey::varchar as stock_id, case when o_custkey % 2 = 0 then 'alpha' else
    'beta' end as source, o_orderdate::date as trade_date, (o_custkey % 30)::varchar as industry_code from orders)
    select *, timestamp '2024-01-06 00:00:00' as recorded_at, 'f' || (case when trade_date < date '1997-01-01' then 1
    else 2 end)::varchar as fetch_id from o where trade_date between date '1996-01-01' and date '1998-12-31'""",
)
def _(spark, d):
    """Rows of all orders appended to a stored dataset in two batches and read back by key date."""
    c = F.col("o_custkey")
    o = table(spark, d, "orders").select(
        c.cast("string").alias("stock_id"),
        F.when(c % 2 == 0, "alpha").otherwise("beta").alias("source"),
        F.col("o_orderdate").cast("date").alias("trade_date"),
        (c % 30).cast("string").alias("industry_code"),
    ).distinct()
    root = tables.scratch_folder(spark, "store")
    for fetch, part in (("f1", F.col("trade_date") < "1997-01-01"), ("f2", F.col("trade_date") >= "1997-01-01")):
        tables.append_rows(o.where(part), root, "industry_observations", "2024-01-06 00:00:00", fetch)
    return tables.read_table(spark, root, "industry_observations", "1996-01-01", "1998-12-31")


@query(
    "fetch_pending_reports",
    f"""with l as (select o_custkey % 100 as s, year(o_orderdate) as y, quarter(o_orderdate) as q, count(*) as n from
    orders group by 1, 2, 3), e as (select s::varchar as stock_id, y as report_year, q as report_quarter, n, s *
    100000 + y * 10 + q as k from l),
    x as (select *, k % 4 = 0 or (k % 7 = 0 and k % 3 = 0) or (k % 11 = 0 and k % 7 <> 0) as done from e) select
    stock_id, report_year, report_quarter from x where not done""",
)
def _(spark, d):
    """Report quarters that neither of their two report ids has fetched: one succeeds after the quarter settled, one
    is of a final kind."""
    o = table(spark, d, "orders")
    e = o.groupBy(
        (F.col("o_custkey") % 100).alias("s"),
        F.year("o_orderdate").alias("report_year"),
        F.quarter("o_orderdate").alias("report_quarter"),
    ).agg(F.count("*").alias("n"))
    k = F.col("s") * 100000 + F.col("report_year") * 10 + F.col("report_quarter")
    settled = instants.quarter_end(
        F.col("report_year"), F.col("report_quarter")
    ).cast("timestamp_ntz") + F.expr("interval 60 days")
    e = e.select(
        F.col("s").cast("string").alias("stock_id"),
        "report_year",
        "report_quarter",
        k.alias("k"),
        settled.alias("settled_at"),
        F.lit("reports").alias("dataset"),
        F.lit("feed").alias("source"),
        F.concat(F.lit("C/"), k.cast("string")).alias("consolidated"),
        F.concat(F.lit("A/"), k.cast("string")).alias("individual"),
    )
    log = lambda key, status, reason, hours: F.struct(
        F.col(key).alias("resource_key"),
        F.lit(status).alias("status"),
        F.lit(reason).cast("string").alias("reason_code"),
        (F.col("settled_at") + F.expr(f"interval {hours} hours")).alias("fetched_at"),
    )
    none = F.array().cast(
        """array<struct<resource_key: string, status: string, reason_code: string, fetched_at: timestamp_ntz>>"""
    )
    when = lambda condition, *entries: F.when(condition, F.array(*entries)).otherwise(none)
    c = F.col("k")
    entries = F.concat(
        when(c % 4 == 0, log("consolidated", "succeeded", None, 5)),
        when((c % 7 == 0) & (c % 3 == 0), log("individual", "succeeded", None, 0)),
        when(c % 7 == 1, log("individual", "succeeded", None, -5)),
        when(c % 11 == 0, log("individual", "quarantined", "outside_universe", 1)),
        when(c % 13 == 0, log("consolidated", "empty", None, 1)),
    )
    fetches_ = e.select(
        "dataset", "source", F.explode(entries).alias("f"), F.lit(1).alias("attempt")
    ).select("dataset", "source", "f.*", "attempt")
    latest = fetches_.where(
        """not (resource_key like 'C/%' and status = 'empty' and cast(substring(resource_key, 3) as bigint) % 4 = 0)"""
    ).where(
        """not (resource_key like 'A/%' and status = 'quarantined' and cast(substring(resource_key, 3) as bigint) % 7
    = 0)"""
    )
    return append.pending_any(e, latest, ["consolidated", "individual"], final=["outside_universe"]).select(
        "stock_id", "report_year", "report_quarter"
    )
