"""Panels derived from the supplied tables, each as a DataFrame and as the same rows in SQL.

The operators need bitemporal rows, bars, flows, reports and events; these are computed from the
order, line-item and event tables with whole-number arithmetic, so both sides agree to the last digit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sizes import clustered


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("string").alias("stock_id"),
        F.when(F.col("l_suppkey") % 2 == 0, "alpha").otherwise("beta").alias("source"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        F.expr("l_shipdate + make_dt_interval(0, l_linenumber * 12, 0, l_orderkey % 3600)").alias("recorded_at"),
        (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100) / 100.0).alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
        "l_orderkey",
        "l_linenumber",
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price versions: every line is a version of (supplier, ship date), recorded 12 hours a line later."""
    rows = clustered(_lines(spark, sf_dir), ["stock_id", "source"], table(spark, sf_dir, "lineitem").count())
    return rows.groupBy("stock_id", "source", "trade_date", "recorded_at").agg(
        F.min_by("close", "ord").alias("close"), F.min_by("volume", "ord").alias("volume")
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of each supplier, dealt by series as lines: nearly every line is a bar, so combining them before the
    shuffle would only fill the reading tasks' memory."""
    rows = clustered(_lines(spark, sf_dir), ["stock_id", "source"], table(spark, sf_dir, "lineitem").count())
    return rows.groupBy("stock_id", "source", "trade_date").agg(
        F.min_by("close", "ord").alias("open"),
        F.max("close").alias("high"),
        F.min("close").alias("low"),
        F.max_by("close", "ord").alias("close"),
        F.sum("volume").alias("volume"),
    )


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed daily flows of each user: purchases in, errors out, other kinds nothing; days with a view have volume."""
    e = table(spark, sf_dir, "events")
    cents = F.floor(F.col("value") * 100)
    net = F.when(F.col("event_type") == "purchase", cents).when(F.col("event_type") == "error", -cents)
    return e.groupBy(
        F.col("user_id").cast("string").alias("stock_id"),
        F.lit("feed").alias("source"),
        F.col("ts").cast("date").alias("trade_date"),
    ).agg(
        F.sum(net).alias("net"),
        F.count_if(F.col("event_type") == "view").alias("volume"),
        F.max("ts").alias("recorded_at"),
        F.count("*").alias("n_events"),
    )


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of suppliers from orders: factor, unknown factors and retractions by order number."""
    o = table(spark, sf_dir, "orders")
    stock = (F.col("o_custkey") % 100 + 1).cast("string")
    return o.select(
        stock.alias("stock_id"),
        F.when((F.col("o_custkey") % 100 + 1) % 2 == 0, "alpha").otherwise("beta").alias("source"),
        F.col("o_orderdate").cast("date").alias("ex_date"),
        F.expr("o_orderdate + make_dt_interval(0, o_orderkey % 48, 0, o_orderkey % 3600)").alias("recorded_at"),
        F.when(F.col("o_orderkey") % 997 != 0, 1 - (F.col("o_orderkey") % 5) / 99991.0).alias("event_factor"),
        (F.col("o_orderkey") % 31 == 0).alias("retracted"),
        F.floor("o_totalprice").cast("bigint").alias("close_before"),
        "o_orderkey",
        F.concat(
            F.lit("f"), F.col("o_orderdate").cast("date").cast("string"), (F.col("o_orderkey") % 2).cast("string")
        ).alias("fetch_id"),
    )


def limit_payloads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The result feeds that events were fetched from: (fetch_id, sha256) and the store's (sha256, content). A feed is
    the list of one day's events with odd or even numbers, with limits for most stocks."""
    e = actions(spark, sf_dir).groupBy("fetch_id", "ex_date", "stock_id").agg(F.min("o_orderkey").alias("m"))
    low = 900 + F.col("m") % 300
    price = lambda p: F.when(F.col("m") % 11 == 0, "-").otherwise(F.format_number(p, 2))
    day = F.concat((F.year("ex_date") - 1911).cast("string"), F.date_format("ex_date", "'年'MM'月'dd'日'"))
    line = F.array(day, F.col("stock_id"), price(low + 100 + F.col("m") % 700), price(low))
    lists = e.groupBy("fetch_id").agg(F.sort_array(F.collect_list(line)).alias("data"))
    head = F.array(*[F.lit(h) for h in ("資料日期", "股票代號", "漲停價格", "跌停價格")])
    stored = lists.select(
        "fetch_id", F.to_json(F.struct(F.lit("OK").alias("stat"), head.alias("fields"), "data")).alias("content")
    ).withColumn("sha256", F.sha2("content", 256))
    return stored.select("fetch_id", "sha256"), stored.select("sha256", "content").distinct()


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report versions by group of customers and quarter; ids divisible by 13 never published, odd ones with a second
    version."""
    o = table(spark, sf_dir, "orders")
    g = o.groupBy(
        (F.col("o_custkey") % 100 + 1).alias("s"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")
    ).agg(
        F.sum(F.floor("o_totalprice")).cast("bigint").alias("total"), F.count("*").alias("n")
    )
    base = g.select(
        F.col("s").cast("string").alias("stock_id"),
        F.col("y").alias("report_year"),
        F.col("q").alias("report_quarter"),
        "total",
        "n",
        (F.col("s") * 100000 + F.col("y") * 10 + F.col("q")).alias("id"),
    )
    end = F.last_day(F.make_date("report_year", F.col("report_quarter") * 3, F.lit(1))).cast("timestamp_ntz")
    category = F.when(F.col("id") % 3 == 0, "individual").otherwise("consolidated")
    first = base.select(
        "id",
        "stock_id",
        "report_year",
        "report_quarter",
        category.alias("report_category"),
        F.when(F.col("id") % 13 != 0, end + F.expr("interval 45 days")).alias("published_at"),
        (end + F.expr("interval 46 days")).alias("recorded_at"),
        "total",
        "n",
    )
    second = base.where("id % 2 = 1").select(
        (F.col("id") + 50000000).alias("id"),
        "stock_id",
        "report_year",
        "report_quarter",
        category.alias("report_category"),
        F.lit(None).cast("timestamp_ntz").alias("published_at"),
        (end + F.expr("interval 90 days")).alias("recorded_at"),
        (F.col("total") + 1).alias("total"),
        "n",
    )
    return first.unionByName(second)


def facts(reports: DataFrame) -> DataFrame:
    """Facts of report versions: EPS and income by basis, equity as an instant; beside these, as filings have them, last
    year's closing equity and quarter, and the income again in the statement of cash flows."""
    y, q = F.col("report_year"), F.col("report_quarter")
    end = F.last_day(F.make_date(y, q * 3, F.lit(1)))
    start, year = F.make_date(y, q * 3 - 2, F.lit(1)), F.make_date(y, F.lit(1), F.lit(1))
    income = F.when(F.col("report_category") == "consolidated", "8610").otherwise("8200")
    equity = F.when(F.col("report_category") == "consolidated", "31XX").otherwise("3XXX")
    cum = F.col("total") * q

    def fact(statement, account, since, value, until=end):
        return F.struct(
            F.lit(statement).alias("statement"),
            account.alias("account_code"),
            since.alias("period_start"),
            until.alias("period_end"),
            value.cast("bigint").alias("value"),
        )

    none = F.lit(None).cast("date")
    items = F.array(
        fact("income_statement", F.lit("9750"), start, F.col("total") % 1000 - 100),
        fact("income_statement", F.lit("9750"), year, F.when(q == 1, F.col("total") % 1000 - 100).otherwise(cum % 3000)),
        fact("income_statement", income, start, F.col("total")),
        fact("income_statement", income, year, cum),
        fact("balance_sheet", equity, none, F.col("total") * 7 + 1000),
        fact("balance_sheet", equity, none, F.col("total") * 6 + 900, F.date_sub(year, 1)),
        fact("income_statement", income, F.add_months(start, -12), F.col("total") - 1, F.last_day(F.add_months(end, -12))),
        fact("cash_flow_statement", income, start, F.col("total") + 7),
        fact("cash_flow_statement", income, year, cum + 7),
    )
    return reports.select(
        F.col("id").alias("report_id"), F.explode(items).alias("f")
    ).select("report_id", "f.*").distinct()


#: The same rows in SQL, as common table expressions.
CTE = {
    "lines": """lines as (select l_suppkey::varchar as stock_id, case when l_suppkey % 2 = 0 then 'alpha' else 'beta'
    end as source, l_shipdate::date as trade_date,
        l_shipdate + to_hours((l_linenumber * 12)::bigint) + to_seconds(l_orderkey % 3600) as recorded_at,
        floor(l_extendedprice / l_quantity * 100)::bigint / 100.0::double as close,
        l_quantity::bigint as volume, l_orderkey * 10 + l_linenumber as ord, l_orderkey, l_linenumber from lineitem)""",
    "versions": """versions as (select stock_id, source, trade_date, recorded_at, close, volume from lines
        qualify row_number() over (partition by stock_id, source, trade_date, recorded_at order by ord) = 1)""",
    "bars": """bars as (select stock_id, source, trade_date, arg_min(close, ord) as open, max(close) as high,
    min(close) as low, arg_max(close, ord) as close, sum(volume)::bigint as volume
        from lines group by all)""",
    "flows": """flows as (select user_id::varchar as stock_id, 'feed' as source, ts::date as trade_date,
        sum(case event_type when 'purchase' then floor(value * 100)::bigint when 'error' then -floor(value *
        100)::bigint end)::bigint as net,
        count(*) filter (event_type = 'view') as volume, max(ts) as recorded_at, count(*) as n_events from events
        group by 1, 2, 3)""",
    "actions": """actions as (select (o_custkey % 100 + 1)::varchar as stock_id, case when (o_custkey % 100 + 1) % 2 =
    0 then 'alpha' else 'beta' end as source, o_orderdate::date as ex_date,
        o_orderdate + to_hours(o_orderkey % 48) + to_seconds(o_orderkey % 3600) as recorded_at, case when o_orderkey %
        997 <> 0 then 1 - (o_orderkey % 5) / 99991.0::double end as event_factor,
        o_orderkey % 31 = 0 as retracted, floor(o_totalprice)::bigint as close_before, o_orderkey, o_orderkey % 2 as feed
        from orders)""",
    "reports": """report_base as (select (o_custkey % 100 + 1) as s, year(o_orderdate) as report_year,
    quarter(o_orderdate) as report_quarter, sum(floor(o_totalprice)::bigint)::bigint as total, count(*) as n from
    orders group by 1, 2, 3),
        report_ids as (select *, s::varchar as stock_id, s * 100000 + report_year * 10 + report_quarter as id0,
        last_day(make_date(report_year, report_quarter * 3, 1))::timestamp as pe from report_base),
        reports as (select id0 as id, stock_id, report_year, report_quarter, case when id0 % 3 = 0 then 'individual'
        else 'consolidated' end as report_category,
            case when id0 % 13 <> 0 then pe + interval 45 day end as published_at, pe + interval 46 day as
            recorded_at, total, n from report_ids
            union all select id0 + 50000000, stock_id, report_year, report_quarter, case when id0 % 3 = 0 then
            'individual' else 'consolidated' end, null, pe + interval 90 day, total + 1, n from report_ids where id0 %
            2 = 1)""",
    "facts": """facts as (select distinct r.id as report_id, f.* from (select *, last_day(make_date(report_year,
    report_quarter * 3, 1)) as period_end, make_date(report_year, report_quarter * 3 - 2, 1) as qs,
    make_date(report_year, 1, 1) as ys,
            case when report_category = 'consolidated' then '8610' else '8200' end as inc, case when report_category =
            'consolidated' then '31XX' else '3XXX' end as eq from reports) r,
            lateral (select 'income_statement' as statement, '9750' as account_code, qs as period_start, period_end,
            total % 1000 - 100 as value union all select 'income_statement', '9750', ys, period_end, case when
            report_quarter = 1 then total % 1000 - 100 else total * report_quarter % 3000 end
            union all select 'income_statement', inc, qs, period_end, total union all select 'income_statement', inc,
            ys, period_end, total * report_quarter union all select 'balance_sheet', eq, null, period_end, total * 7 +
            1000 union all select 'balance_sheet', eq, null, ys - 1, total * 6 + 900 union all select
            'income_statement', inc, (qs - interval 1 year)::date, last_day((period_end - interval 1 year)::date),
            total - 1 union all select 'cash_flow_statement', inc, qs, period_end, total + 7 union all select
            'cash_flow_statement', inc, ys, period_end, total * report_quarter + 7) f)""",
    "available": """available as (select v.*, case when recorded_at >= released and recorded_at > settled then
    recorded_at else released end as available_at from (
            select *, trade_date::timestamp + interval 19 hour as released, min(case when recorded_at >=
            trade_date::timestamp + interval 19 hour then recorded_at end) over (partition by stock_id, source,
            trade_date) as settled from versions) v)""",
}

_NEEDS = {"versions": ["lines"], "bars": ["lines"], "available": ["lines", "versions"], "facts": ["reports"]}


def with_(*names: str, recursive: bool = False) -> str:
    """``with`` clause of the named panels and what they need; ``recursive`` if a query's own expressions are."""
    order: list[str] = []
    for n in names:
        for m in [*_NEEDS.get(n, []), n]:
            if m not in order:
                order.append(m)
    return ("with recursive " if recursive else "with ") + ",\n".join(CTE[n] for n in order)
