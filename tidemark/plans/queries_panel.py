"""Queries of the span, panel and reconciliation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import metrics, panel, pit, reconcile, spans
from tidemark.plans.panels import actions, bars, facts, flows, limit_payloads, reports, table, versions, with_
from tidemark.plans.queries_metrics import _LEVELS, _Q, levels
from tidemark.plans.registry import query
from tidemark.sources import payloads
from tidemark.sources.payloads import long_to_wide_levels
from tidemark.sources.tables import scratch_folder

SERIES = ["stock_id", "source"]
KEY = [*SERIES, "trade_date"]


def day(text):
    return F.lit(text).cast("date")


# Listing events: signups and errors of users, one a day and kind; the market by user.
def listing_events(spark, d):
    e = table(spark, d, "events")
    one = e.where("event_type in ('signup', 'error')").groupBy(
        (F.col("user_id") % 1000).cast("string").alias("stock_id"),
        F.when(F.col("user_id") % 2 == 0, "sii").otherwise("otc").alias("market"),
        F.col("ts").cast("date").alias("on_date"),
        "event_type",
    ).agg(F.min("event_id").alias("i"))
    rows = one.select(
        "stock_id",
        "market",
        "on_date",
        F.concat(F.lit("n"), F.col("i").cast("string")).alias("name"),
        F.when(F.col("i") % 7 == 0, "innovation board").otherwise("").alias("note"),
        F.col("i").cast("string").alias("fetch_id"),
        "event_type",
    )
    return rows.where("event_type = 'signup'").drop("event_type"), rows.where("event_type = 'error'").drop("event_type")


def today(spark, d):
    e = table(spark, d, "events").select("user_id").distinct().where("user_id % 3 <> 0")
    u = F.col("user_id")
    return e.select(
        (u % 1000).cast("string").alias("stock_id"),
        F.when(u % 2 == 0, "sii").otherwise("otc").alias("market"),
        F.concat(F.lit("t"), u.cast("string")).alias("name"),
        (u % 5).cast("string").alias("industry"),
        (u % 5).cast("string").alias("industry_code"),
        F.date_add(day("2024-01-01"), (u % 30).cast("int")).alias("listed_on"),
    )


def lookups(spark, d):
    e = table(spark, d, "events").select("user_id").distinct().where("user_id % 4 <> 1")
    u = F.col("user_id")
    return e.select(
        (u % 1000).cast("string").alias("stock_id"),
        F.concat(F.lit("k"), u.cast("string")).alias("name"),
        F.lit("x").alias("industry"),
        F.when(u % 5 == 0, "fund").otherwise("stock").alias("category"),
        F.when(u % 6 != 0, F.date_add(day("2023-12-20"), (u % 30).cast("int"))).alias("registered_on"),
    )


_LIST = """with ev as (select (user_id % 1000)::varchar as stock_id, case when user_id % 2 = 0 then 'sii' else 'otc'
    end as market, ts::date as on_date, event_type, min(event_id) as i from events where event_type in ('signup',
    'error') group by 1, 2, 3, 4),
    e2 as (select *, case when event_type = 'signup' then 1 else 0 end as up from ev), ep as (select *, coalesce(sum(1
    - up) over (partition by stock_id, market order by on_date, up rows between unbounded preceding and 1 preceding),
    0) as episode from e2),
    pairs as (select stock_id, market, any_value(ep.episode)::int as episode, max(on_date) filter (up = 1) as
    listed_on, max(on_date) filter (up = 0) as delisted_on, arg_max(i, on_date) filter (up = 1) as note_i,
        case when count(*) filter (up = 1) > 1 then 'listed_twice' when count(*) filter (up = 1) = 0 and
        any_value(ep.episode) > 0 then 'delisted_twice' end as problem from ep group by stock_id, market, ep.episode),
    today as (select distinct (user_id % 1000)::varchar as stock_id, case when user_id % 2 = 0 then 'sii' else 'otc'
    end as market, 't' || user_id as name, date '2024-01-01' + (user_id % 30)::int as isin from events where user_id %
    3 <> 0),
    look as (select distinct (user_id % 1000)::varchar as stock_id, 'k' || user_id as name, case when user_id % 5 = 0
    then 'fund' else 'stock' end as category, case when user_id % 6 <> 0 then date '2023-12-20' + (user_id % 30)::int
    end as reg from events where user_id % 4 <> 1)"""


@query(
    "span_pairs",
    days="listed_on delisted_on",
    sql=f"{_LIST} select stock_id, market, episode, listed_on, delisted_on, problem from pairs",
)
def _(spark, d):
    return spans.pair_events(*listing_events(spark, d)).select(
        "stock_id", "market", F.col("episode").cast("int").alias("episode"), "listed_on", "delisted_on", "problem"
    )


@query(
    "span_needs_lookup",
    f"""{_LIST} select distinct stock_id from pairs where delisted_on >= date '2024-01-05' and listed_on is null""",
)
def _(spark, d):
    return spans.needs_lookup(spans.pair_events(*listing_events(spark, d)), day("2024-01-05"))


_DECIDE = f"""{_LIST}, j as (select p.*, t.isin, t.stock_id is not null as on_list, l.stock_id is not null as found,
    l.reg, l.category, p.listed_on is not null and note_i % 7 = 0 as board from pairs p left join today t using
    (stock_id, market) left join look l on l.stock_id = p.stock_id),
    v as (select *, case when delisted_on < date '2024-01-05' then 'before_window' when problem is not null then
    'quarantined' when delisted_on is null and on_list then 'span' when board then 'excluded' when delisted_on is null
    then 'quarantined' when listed_on is not null then 'span' when not found then 'quarantined' when reg is null or
    reg > delisted_on then 'quarantined' when category <> 'stock' then 'excluded' else 'span' end as decision,
        case when delisted_on < date '2024-01-05' then null when problem is not null then problem when delisted_on is
        null and on_list then null when board then 'innovation_board' when delisted_on is null then
        'listed_not_on_isin' when listed_on is not null then null when not found then 'unproven_category' when reg is
        null or reg > delisted_on then 'isin_lookup_is_another_security' when category <> 'stock' then 'category:' ||
        category end as reason from j),
    st as (select stock_id, market, bool_or(decision = 'span' and delisted_on is null) as op, max(delisted_on) as z,
    bool_or(delisted_on is null and problem is not null) as amb from v group by 1, 2),
    own as (select t.stock_id, t.market, z, case when (z is not null or coalesce(amb, false)) and (z is null or isin
    >= z) then isin end as s from today t left join st using (stock_id, market) where not coalesce(op, false)),
    decided as (select stock_id, market, decision, reason, case when delisted_on is null and board then isin else
    listed_on end as listed_on, delisted_on, delisted_on is not null and listed_on is null and decision = 'span' as
    by_lookup from v
        union all select stock_id, market, 'span', null, s, null, false from own union all select stock_id, market,
        'warning', 'relisted_without_listing_row', null, null, false from own where z is not null)"""


def decided(spark, d):
    up, down = listing_events(spark, d)
    return spans.assemble(today(spark, d), up, down, lookups(spark, d), day("2024-01-05"), ["stock"])


@query("span_assembly", days="listed_on delisted_on", sql=f"{_DECIDE} select * from decided")
def _(spark, d):
    return decided(spark, d)


@query(
    "span_company_identity",
    f"""{_DECIDE}, k as (select stock_id, bool_or(by_lookup) as b from decided where decision = 'span' group by 1),
    last as (select stock_id, arg_max('n' || i, on_date::varchar || market || 'n' || i) as n from e2 group by 1)
    select k.stock_id, case when t.stock_id is not null then t.name when b and l.stock_id is not null then l.name else
    last.n end as name from k left join today t using (stock_id) left join look l using (stock_id) left join last
    using (stock_id)""",
)
def _(spark, d):
    up, down = listing_events(spark, d)
    return spans.company_identity(
        decided(spark, d), today(spark, d), lookups(spark, d), up, down
    ).select("stock_id", "name")


def span_table(spark, d):
    """Proven spans from users: listed by the first event, ended for some; every seventh was in the other market for its first
    eight days."""
    e = table(spark, d, "events").groupBy("user_id").agg(
        F.min(F.col("ts").cast("date")).alias("a"), F.max(F.col("ts").cast("date")).alias("z")
    )
    u, moved = F.col("user_id"), F.date_add("a", 8)
    last = e.select(
        u.cast("string").alias("stock_id"),
        F.when(u % 2 == 0, "sii").otherwise("otc").alias("market"),
        F.when(u % 7 == 0, moved).when(u % 9 != 0, F.col("a")).alias("listed_on"),
        F.when(u % 5 == 0, F.greatest("z", moved)).alias("delisted_on"),
    )
    before = e.where(u % 7 == 0).select(
        u.cast("string").alias("stock_id"),
        F.when(u % 2 == 0, "otc").otherwise("sii").alias("market"),
        F.when(u % 9 != 0, F.col("a")).alias("listed_on"),
        moved.alias("delisted_on"),
    )
    return last.unionByName(before)


_SPANS = """with users as (select user_id, min(ts::date) as a, max(ts::date) as z from events group by 1),
    spans as (
        select user_id::varchar as stock_id, case when user_id % 2 = 0 then 'sii' else 'otc' end as market,
            case when user_id % 7 = 0 then a + 8 when user_id % 9 <> 0 then a end as listed_on,
            case when user_id % 5 = 0 then greatest(z, a + 8) end as delisted_on from users
        union all select user_id::varchar, case when user_id % 2 = 0 then 'otc' else 'sii' end,
            case when user_id % 9 <> 0 then a end, a + 8 from users where user_id % 7 = 0)"""


@query(
    "span_members",
    days="listed_on delisted_on",
    sql=f"""{_SPANS} select * from spans where (listed_on is null or listed_on <= date '2024-01-15') and (delisted_on
    is null or delisted_on > date '2024-01-15')""",
)
def _(spark, d):
    return spans.members(span_table(spark, d), day("2024-01-15"))


@query(
    "span_stock_records",
    f"""{_SPANS}, two as (select * from spans union all select stock_id, 'old', date '2020-01-01', date '2021-01-01'
    from spans where stock_id::int % 3 = 0)
    select stock_id, max(market) filter (delisted_on is null) as current_market, string_agg(market || ':' ||
    coalesce(listed_on::varchar, '-') || ':' || coalesce(delisted_on::varchar, '-'), ',' order by listed_on nulls
    first) as spans from two group by 1""",
)
def _(spark, d):
    s = span_table(spark, d)
    two = s.unionByName(
        s.where("cast(stock_id as int) % 3 = 0").select(
            "stock_id",
            F.lit("old").alias("market"),
            day("2020-01-01").alias("listed_on"),
            day("2021-01-01").alias("delisted_on"),
        )
    )
    r = spans.stock_records(s.select("stock_id").distinct(), two)
    text = F.array_join(
        F.transform(
            "spans",
            lambda x: F.concat_ws(
                ":",
                x["market"],
                F.coalesce(x["listed_on"].cast("string"), F.lit("-")),
                F.coalesce(x["delisted_on"].cast("string"), F.lit("-")),
            ),
        ),
        ",",
    )
    return r.select("stock_id", "current_market", text.alias("spans"))


def other_market(user, event):
    """The market of a user, every sixth time the other one."""
    return F.when((user % 2 == 0) != (event % 6 == 0), "sii").otherwise("otc")


def changes(spark, d):
    """Category changes from errors: old and new category by event, announced three days before, re-announced for
    some, every sixth by the other market's exchange."""
    e = table(spark, d, "events").where("event_type = 'error'")
    i = F.col("event_id")
    g = e.groupBy(
        F.col("user_id").cast("string").alias("stock_id"), F.col("ts").cast("date").alias("effective_date")
    ).agg(F.min("event_id").alias("event_id"))
    market = other_market(F.col("stock_id").cast("int"), i)
    base = g.select(
        "stock_id",
        F.when(market == "sii", "notices").otherwise("otc_notices").alias("source"),
        market.alias("market"),
        "effective_date",
        F.date_sub("effective_date", 3).alias("announced_on"),
        (i % 5).cast("string").alias("old_industry"),
        (i % 4 + 1).cast("string").alias("new_industry"),
        (F.date_sub("effective_date", 3).cast("timestamp_ntz") + F.expr("interval 20 hours")).alias("recorded_at"),
        "event_id",
    )
    again = base.where("event_id % 2 = 0").withColumn("new_industry", (i % 3 + 1).cast("string")).withColumn(
        "recorded_at", F.col("effective_date").cast("timestamp_ntz") + F.expr("interval 30 hours")
    )
    return base.unionByName(again).drop("event_id")


_CHG = """chg0 as (select user_id::varchar as stock_id, ts::date as effective_date, min(event_id) as i from events
    where event_type = 'error' group by 1, 2),
    chg as (select stock_id, case when (stock_id::int % 2 = 0) <> (i % 6 = 0) then 'sii' else 'otc' end as market,
        effective_date, effective_date - 3 as announced_on, (i % 5)::varchar as old_industry, (i
    % 4 + 1)::varchar as new_industry, (effective_date - 3)::timestamp + interval 20 hour as recorded_at from chg0
        union all select stock_id, case when (stock_id::int % 2 = 0) <> (i % 6 = 0) then 'sii' else 'otc' end,
        effective_date, effective_date - 3, (i % 5)::varchar, (i % 3 + 1)::varchar,
        effective_date::timestamp + interval 30 hour from chg0 where i % 2 = 0),
    cv0 as (select *, (announced_on + 1)::timestamp - interval 8 hour as released from chg), cv as (select *, case
    when recorded_at >= released and recorded_at > min(case when recorded_at >= released then recorded_at end) over
    (partition by stock_id, effective_date) then recorded_at else released end as available_at from cv0)"""


@query(
    "span_change_versions",
    days="effective_date",
    sql=f"""with {_CHG} select stock_id, effective_date, new_industry, recorded_at, available_at from cv""",
)
def _(spark, d):
    return spans.change_versions(changes(spark, d)).select(
        "stock_id", "effective_date", "new_industry", "recorded_at", "available_at"
    )


def quotes(spark, d):
    e = table(spark, d, "events")
    return e.groupBy(
        F.col("user_id").cast("string").alias("stock_id"),
        F.lit("quote").alias("source"),
        F.col("ts").cast("date").alias("trade_date"),
    ).agg(
        other_market(F.col("stock_id").cast("int"), F.min("event_id")).alias("market"),
        (F.min("event_id") % 5).cast("string").alias("industry_code"),
        F.max("ts").alias("recorded_at"),
    )


_QUOTES = """quotes as (select user_id::varchar as stock_id, ts::date as trade_date, (min(event_id) % 5)::varchar as
    industry_code, max(ts) as recorded_at,
    case when (any_value(user_id) % 2 = 0) <> (min(event_id) % 6 = 0) then 'sii' else 'otc' end as market
    from events group by 1, 2)"""
_ANCHOR = f"""{_SPANS}, {_QUOTES}, tod as (select distinct user_id::varchar as stock_id, (user_id % 5)::varchar as c
    from events),
    anc as (select s.*, arg_max(q.industry_code, q.trade_date) as anchor_code, max(q.trade_date) as anchor_on from
    spans s join quotes q on q.stock_id = s.stock_id and q.market = s.market and (listed_on is null or trade_date >= listed_on) and trade_date
    < delisted_on and q.recorded_at <= timestamp '2024-01-25' group by 1, 2, 3, 4
        union all select s.*, c, null from spans s join tod using (stock_id) where delisted_on is null)"""


def anchored(spark, d):
    e = table(spark, d, "events").select("user_id").distinct().select(
        F.col("user_id").cast("string").alias("stock_id"), (F.col("user_id") % 5).cast("string").alias("industry_code")
    )
    return spans.anchors(span_table(spark, d), e, quotes(spark, d), F.lit("2024-01-25").cast("timestamp_ntz"))


@query("span_anchors", days="listed_on delisted_on anchor_on", sql=f"{_ANCHOR} select * from anc")
def _(spark, d):
    return anchored(spark, d)


def categories(spark):
    return spark.sql(
        """select cast(c as string) as code, m as market, case when c = 3 then date'2024-01-10' end as valid_from,
    case when c = 4 then date'2024-01-20' end as valid_to, case when c = 2 then date'2024-01-12' end as renamed_on
    from (select explode(sequence(0, 4)) as c) cross join (select explode(array('sii', 'otc')) as m)"""
    )


def periods(spark, d):
    t = lambda x: F.lit(x).cast("timestamp_ntz")
    return spans.category_periods(
        span_table(spark, d),
        spans.change_versions(changes(spark, d)),
        anchored(spark, d),
        categories(spark),
        t("2024-01-22 00:00:00"),
        t("2024-01-25 00:00:00"),
        t("2024-01-05 00:00:00"),
    )


def _seen(instants):
    """The periods by plain joins and windows, as every instant t of ``instants`` sees them."""
    return f"""{_ANCHOR}, {_CHG}, instant as ({instants}),
    cat as (select c::varchar as code, m as market, case when c = 3 then date '2024-01-10' end as valid_from,
        case when c = 4 then date '2024-01-20' end as valid_to, case when c = 2 then date '2024-01-12' end as renamed_on
        from range(5) t(c), (values ('sii'), ('otc')) u(m)),
    inside as (select t, s.stock_id, s.market, s.listed_on as a, s.delisted_on as z, v.effective_date as e, v.old_industry,
        v.new_industry, v.recorded_at, v.available_at, v.available_at <= t as public
        from spans s join cv v using (stock_id, market) cross join instant where v.recorded_at <= timestamp '2024-01-25'
        and (listed_on is null or listed_on < effective_date) and (delisted_on is null or effective_date < delisted_on)),
    days as (select t, stock_id, market, a, z, e, arg_max(new_industry, recorded_at) filter (public) as said,
        arg_max(old_industry, recorded_at) filter (public) as was, arg_max(available_at, recorded_at) filter (public) as said_at,
        arg_min(old_industry, recorded_at) as first_was, row_number() over (partition by t, stock_id, market, a, z order by e) as k
        from inside group by 1, 2, 3, 4, 5, 6),
    drafts as (
        select t, stock_id, market, a, z, 0 as n, a as since, coalesce(was, first_was) as code, 'before_change' as basis,
            coalesce(a::timestamp - interval 8 hour, timestamp '1900-01-01') as public_at from days where k = 1
        union all select t, stock_id, market, a, z, k, e, said, 'change', said_at from days where said is not null
        union all select t, stock_id, market, listed_on, delisted_on, 0, listed_on, anchor_code, 'anchor',
            coalesce(listed_on::timestamp - interval 8 hour, timestamp '1900-01-01') from anc x cross join instant where not exists (
            select 1 from days d where d.t = instant.t and d.stock_id = x.stock_id and d.market = x.market
            and d.a is not distinct from x.listed_on and d.z is not distinct from x.delisted_on)),
    followed as (select *, lead(since) over (partition by t, stock_id, market, a, z order by n) as next from drafts),
    named as (select f.*, coalesce(next, z) as until, valid_from, valid_to, renamed_on,
        case when next is null then z::timestamp - interval 8 hour end as ended
        from followed f left join cat using (code, market)),
    clipped as (select t, stock_id, market, a, z, n, code, basis, renamed_on,
        case when late then valid_from else since end as since,
        case when late then greatest(public_at, valid_from::timestamp - interval 8 hour) else public_at end as public_at,
        case when early then valid_to else until end as until,
        case when early then timestamp '2024-01-05' else ended end as ended
        from (select *, valid_from is not null and (since is null or since < valid_from) as late,
            valid_to is not null and (until is null or valid_to < until) as early from named)),
    marked as (select *, renamed_on is not null and (since is null or since < renamed_on)
        and (until is null or renamed_on < until) as cut from clipped where until is null or since is null or since < until),
    pieces as (
        select t, stock_id, market, a, z, n, code, since, until, basis, public_at, ended from marked where not cut
        union all select t, stock_id, market, a, z, n, code, since, renamed_on, basis, public_at, timestamp '2024-01-05' from marked where cut
        union all select t, stock_id, market, a, z, n, code, renamed_on, until, 'rename', greatest(public_at, timestamp '2024-01-05'), ended
            from marked where cut),
    seen as (select *, lead(since) over (partition by t, stock_id, market, a, z order by n, since nulls first) as next,
        until is not null and coalesce(ended <= t, false) as ceased from pieces
        where public_at <= t),
    periods as (select t, stock_id, market, code as industry_code, basis, since as effective_from,
        case when next is not null then case when ceased and until < next then until else next end
            when ceased then until end as effective_to, public_at as available_at from seen)"""


_PERIODS = _seen("select timestamp '2024-01-22' as t")


@query(
    "span_category_periods", days="effective_from effective_to", sql=f"{_PERIODS} select * exclude (t) from periods"
)
def category_periods(spark, d):
    """Category periods as one instant sees them; scenarios with hand-made answers are in the tests."""
    return periods(spark, d)


@query(
    "span_overlap_and_last",
    f"""{_PERIODS} select basis, count(*) as n from periods where (effective_from is null or effective_from <= date '2024-01-21')
        and (effective_to is null or effective_to > date '2024-01-08') group by 1
    union all select 'last_known', count(*) from (select stock_id from periods group by 1 having count(*) = count(effective_to))""",
)
def overlap_and_last(spark, d):
    """Periods that overlap a fortnight, and the last category of stocks without a current one."""
    p = periods(spark, d)
    a = spans.overlapping(p, day("2024-01-08"), day("2024-01-21")).groupBy("basis").agg(F.count("*").alias("n"))
    b = spans.last_known_category(p).agg(F.lit("last_known").alias("basis"), F.count("*").alias("n"))
    return a.unionByName(b)


#: Two reads at every probe: as each instant sees it, and what is known last shown from each period's own instant on.
_ENDS = _seen(
    """select distinct available_at + to_seconds(x) as t from cv, (select unnest([-1, 0]) as x)
        union select timestamp '2024-01-10 12:00:00' union select timestamp '2100-01-01'"""
)


@query(
    "span_interval_ends",
    f"""{_ENDS}, public as (select stock_id, market, effective_from as d, min(available_at) as at_first from periods
        where basis in ('change', 'rename') group by 1, 2, 3),
    reads as (select 'by_instant' as read, * from periods
        union all select 'all_known', i.t, p.* exclude (t) from periods p, instant i where p.t = timestamp '2100-01-01' and available_at <= i.t),
    judged as (select read, t, available_at > t as late, effective_to is not null and effective_to > (t + interval 8 hour)::date
            and coalesce(at_first > t, true) and not (effective_to = date '2024-01-20' and t >= timestamp '2024-01-05') as leaked
        from reads r left join public u on u.stock_id = r.stock_id and u.market = r.market and u.d = r.effective_to)
    select k.read, a.t as probe, count(j.t) as visible, count(*) filter (late) as late, count(*) filter (leaked) as ends_not_yet_public
    from instant a cross join (values ('by_instant'), ('all_known')) k(read) left join judged j on j.t = a.t and j.read = k.read
    group by 1, 2""",
)
def _(spark, d):
    """The right read has no end before it is public; one that shows what is known last has."""
    t = lambda x: F.lit(x).cast("timestamp_ntz")
    v, cats, public_at = spans.change_versions(changes(spark, d)), categories(spark), t("2024-01-05 00:00:00")
    path = scratch_folder(spark, "views")
    spans.category_views(
        span_table(spark, d), v, anchored(spark, d), cats, t("2024-01-25 00:00:00"), public_at
    ).write.parquet(path)
    views = spark.read.parquet(path)
    known = views.where("seen_until is null").withColumn("seen_from", F.col("available_at"))
    instants = v.select(F.explode(F.array(F.col("available_at") - F.expr("interval 1 second"), "available_at")).alias("probe"))
    probes = instants.unionByName(spark.range(1).select(F.explode(F.array(t("2024-01-10 12:00:00"), t("2100-01-01"))).alias("probe"))).distinct()
    audits = [
        spans.ends_audit(read, views, cats, public_at, probes).select(F.lit(name).alias("read"), "*")
        for name, read in (("by_instant", views), ("all_known", known))
    ]
    return audits[0].unionByName(audits[1])


@query(
    "span_chain_issues",
    days="listed_on delisted_on effective_date",
    sql=f"""{_ANCHOR}, {_CHG},
    cat as (select c::varchar as code, m as market, case when c = 3 then date '2024-01-10' end as valid_from,
        case when c = 4 then date '2024-01-20' end as valid_to from range(5) t(c), (values ('sii'), ('otc')) u(m)),
    l as (select stock_id, market, effective_date as e, arg_max(old_industry, recorded_at) as o,
        arg_max(new_industry, recorded_at) as n from chg group by 1, 2, 3),
    placed as (select s.*, l.e, l.o, l.n, coalesce(listed_on < e, true) and coalesce(e < delisted_on, true) as within
        from spans s join l using (stock_id, market)),
    own as (select *, lag(n) over w as before, lead(e) over w as after, row_number() over w as k from placed where within
        window w as (partition by stock_id, market, listed_on, delisted_on order by e)),
    of_anchor as (select a.*, (select arg_min(o, e) from own x where x.stock_id = a.stock_id and x.market = a.market and
            x.listed_on is not distinct from a.listed_on and x.delisted_on is not distinct from a.delisted_on and e > anchor_on) as later,
        (select min(e) from own x where x.stock_id = a.stock_id and x.market = a.market and
            x.listed_on is not distinct from a.listed_on and x.delisted_on is not distinct from a.delisted_on and e > anchor_on) as later_on,
        (select arg_max(n, e) from own x where x.stock_id = a.stock_id and x.market = a.market and
            x.listed_on is not distinct from a.listed_on and x.delisted_on is not distinct from a.delisted_on) as last,
        (select max(e) from own x where x.stock_id = a.stock_id and x.market = a.market and
            x.listed_on is not distinct from a.listed_on and x.delisted_on is not distinct from a.delisted_on) as last_on
        from anc a),
    pieces as (
        select stock_id, market, listed_on, delisted_on, listed_on as since, e as until, o as code from own where k = 1
        union all select stock_id, market, listed_on, delisted_on, e, coalesce(after, delisted_on), n from own
        union all select stock_id, market, listed_on, delisted_on, listed_on, delisted_on, anchor_code from of_anchor where last_on is null)
    select stock_id, market, listed_on, delisted_on, e as effective_date, 'outside_span' as issue from placed where not within
    union all select stock_id, market, listed_on, delisted_on, e, 'broken_link' from own where before <> o
    union all select stock_id, market, listed_on, delisted_on, coalesce(later_on, last_on), 'anchor_disagrees' from of_anchor
        where coalesce(later, last) <> anchor_code
    union all select stock_id, market, listed_on, delisted_on, since, 'not_yet_existing' from pieces join cat using (code, market)
        where coalesce(since, date '1900-01-01') < valid_from
    union all select stock_id, market, listed_on, delisted_on, since, 'no_longer_existing' from pieces join cat using (code, market)
        where valid_to < coalesce(until, date '2900-01-01')""",
)
def _(spark, d):
    return spans.chain_issues(span_table(spark, d), changes(spark, d), anchored(spark, d), categories(spark))


@query(
    "span_quote_agreement",
    days="trade_date",
    sql=f"""with {_QUOTES}, p as (select user_id::varchar as stock_id, case when user_id % 2 = 0 then 'sii' else 'otc' end as market,
        (user_id % 5)::varchar as c, date '2024-01-03' + (user_id % 10)::int as a,
        case when user_id % 4 = 0 then date '2024-01-20' end as z from events group by user_id),
    slow as (select distinct user_id::varchar as stock_id from events where user_id % 3 = 0),
    x as (select q.*, c, s.stock_id is not null and trade_date >= date '2024-01-08' and trade_date < date '2024-01-16' as late
        from quotes q left join p on p.stock_id = q.stock_id and p.market = q.market and trade_date >= a
        and (z is null or trade_date < z) left join slow s on s.stock_id = q.stock_id)
    select market, trade_date, count(*) filter (c = industry_code) as agree, count(*) filter (c is null) as no_period,
        count(*) filter (c <> industry_code and late) as known_lag,
        count(*) filter (c <> industry_code and not late) as differ from x group by 1, 2""",
)
def _(spark, d):
    u = F.col("user_id")
    users = table(spark, d, "events").select("user_id").distinct()
    p = users.select(
        u.cast("string").alias("stock_id"),
        F.when(u % 2 == 0, "sii").otherwise("otc").alias("market"),
        (u % 5).cast("string").alias("industry_code"),
        F.date_add(day("2024-01-03"), (u % 10).cast("int")).alias("effective_from"),
        F.when(u % 4 == 0, day("2024-01-20")).alias("effective_to"),
    )
    lagging = users.where("user_id % 3 = 0").select(
        u.cast("string").alias("stock_id"), day("2024-01-08").alias("since"), day("2024-01-16").alias("until")
    )
    return spans.quote_agreement(quotes(spark, d), p, lagging)


@query(
    "span_expected_category",
    days="trade_date",
    sql=f"""{_ANCHOR}, {_CHG}, l as (select stock_id, market, effective_date, arg_max(old_industry, recorded_at) as o,
        arg_max(new_industry, recorded_at) as n from chg group by 1, 2, 3),
    own as (select s.*, anchor_code from spans s left join anc a on a.stock_id = s.stock_id and a.market = s.market
        and a.listed_on is not distinct from s.listed_on and a.delisted_on is not distinct from s.delisted_on),
    x as (select q.stock_id, q.market, q.trade_date,
        (select arg_min(o, effective_date) from l where l.stock_id = q.stock_id and l.market = q.market and effective_date > q.trade_date) as later,
        (select arg_max(n, effective_date) from l where l.stock_id = q.stock_id and l.market = q.market and effective_date <= q.trade_date) as earlier,
        (select arg_max(anchor_code, delisted_on) from own s where s.stock_id = q.stock_id and s.market = q.market) as ended,
        s.stock_id is not null and s.delisted_on is null as in_open, s.anchor_code
        from quotes q left join own s on s.stock_id = q.stock_id and s.market = q.market and coalesce(listed_on <= trade_date, true)
        and coalesce(trade_date < delisted_on, true))
    select stock_id, market, trade_date, coalesce(later, earlier) as announced,
        case when later is not null then later when in_open then anchor_code else coalesce(anchor_code, ended) end as expected,
        case when later is not null then 'next_change' when in_open then 'today' else 'anchor' end as basis from x""",
)
def _(spark, d):
    latest = pit.latest_per_key(changes(spark, d), ["stock_id", "source", "effective_date"])
    return spans.expected_category(quotes(spark, d), latest, span_table(spark, d), anchored(spark, d))


@query(
    "span_sweep_coverage",
    days="trade_date",
    sql=f"""{_SPANS}, {_QUOTES} select stock_id, trade_date from quotes q where exists (select 1 from spans s where
    s.stock_id = q.stock_id and (listed_on is null or trade_date >= listed_on) and (delisted_on is null or trade_date
    < delisted_on)) and industry_code not in ('0', '1')""",
)
def _(spark, d):
    q = quotes(spark, d)
    return spans.sweep_coverage(q, span_table(spark, d), q.where("industry_code = '0'"), q.where("industry_code = '1'"))


@query(
    "span_member_counts",
    f"""{_SPANS}, x as (select market, (stock_id::int % 5)::varchar as industry_code, count(*) as n, count(*) filter
    (stock_id::int % 7 <> 0) as m from spans group by 1, 2) select market, industry_code, n as first, m as second, n =
    m as equal from x""",
)
def _(spark, d):
    s = span_table(spark, d).withColumn("industry_code", (F.col("stock_id").cast("int") % 5).cast("string"))
    return spans.member_counts(s, s.where("cast(stock_id as int) % 7 <> 0"))


UNSOURCED = {"alpha": ["low"], "beta": ["open", "high"]}


@query(
    "panel_unsourced",
    f"""{with_('bars')} select source, count(*) as n, count(open) as opens, count(high) as highs, count(low) as lows,
    case source when 'alpha' then 'low' else 'high,open' end as unsourced from
    (select source, case when source = 'alpha' then open end as open, case when source = 'alpha' then high end as
    high, case when source = 'beta' then low end as low from bars) group by 1""",
)
def _(spark, d):
    m = panel.mark_unsourced(bars(spark, d), UNSOURCED)
    return m.groupBy("source", F.array_join("unsourced", ",").alias("unsourced")).agg(
        F.count("*").alias("n"),
        F.count("open").alias("opens"),
        F.count("high").alias("highs"),
        F.count("low").alias("lows"),
    )


@query(
    "panel_unsourced_audit",
    f"""{with_('bars')} select source, c as column, count(*) as n_values from (select 'alpha' as source, 'low' as c
    from bars where source = 'alpha' union all select 'beta', 'open' from bars where source = 'beta' union all select
    'beta', 'high' from bars where source = 'beta') group by 1, 2""",
)
def _(spark, d):
    return panel.unsourced_audit(bars(spark, d), UNSOURCED)


@query(
    "panel_json_rows",
    f"""{with_('flows')} select
    '{{"stock_id":"' || stock_id || '"' || case when stock_id::int % 2 = 0 then ',"net":' || coalesce(net::varchar, 'null') else '' end || '}}'
    as json from flows""",
)
def _(spark, d):
    f = flows(spark, d).withColumn("source", F.when(F.col("stock_id").cast("int") % 2 == 0, "a").otherwise("b"))
    m = panel.mark_unsourced(f.select("stock_id", "source", "net"), {"b": ["net"]})
    return panel.json_rows(m.drop("source"))


@query(
    "panel_reports_with_facts",
    f"""{with_('facts')} select id, count(report_id) as n_facts, sum(value)::bigint as total_value from reports left
    join facts on report_id = id group by 1""",
)
def _(spark, d):
    r = reports(spark, d)
    x = panel.reports_with_facts(r, facts(r).withColumn("concept", F.lit("c")))
    return x.select(
        "id",
        F.coalesce(F.size("facts"), F.lit(0)).cast("bigint").alias("n_facts"),
        F.aggregate("facts", F.lit(0).cast("bigint"), lambda a, f: a + f["value"]).alias("total_value"),
    )


_CAL = "cal as (select distinct l_shipdate::date as trade_date from lineitem where isodow(l_shipdate) <> 7)"


def calendar(spark, d):
    return table(spark, d, "lineitem").where("dayofweek(l_shipdate) <> 1").select(
        F.col("l_shipdate").cast("date").alias("trade_date")
    ).distinct()


@query(
    "panel_calendar_range",
    days="trade_date",
    sql=f"""with {_CAL} select trade_date from cal where trade_date between date '1996-02-01' and date '1996-09-30'""",
)
def _(spark, d):
    return panel.calendar_range(calendar(spark, d), day("1996-02-01"), day("1996-09-30"))


@query(
    "panel_trading_axis",
    days="trade_date",
    sql=f"""{with_('bars')}, {_CAL}, e as (select stock_id, source, min(trade_date) as a, max(trade_date) as z from
    bars group by 1, 2) select stock_id, source, trade_date, true as on_calendar from e join cal on trade_date between
    a and z
    union all select stock_id, source, trade_date, false from bars where trade_date not in (select trade_date from
    cal)""",
)
def _(spark, d):
    return panel.trading_axis(calendar(spark, d), bars(spark, d), SERIES)


@query(
    "panel_aligned",
    days="trade_date",
    sql=f"""{with_('bars')}, {_CAL}, e as (select stock_id, source, min(trade_date) as a, max(trade_date) as z from
    bars group by 1, 2), x as (select stock_id, source, trade_date from e join cal on trade_date between a and z union
    select stock_id, source, trade_date from bars)
    select x.*, p.close as price_close, v.volume as flow_volume from x left join bars p using (stock_id, source,
    trade_date) left join (select * from bars where volume % 2 = 0) v using (stock_id, source, trade_date)""",
)
def _(spark, d):
    b = bars(spark, d)
    axis = panel.trading_axis(calendar(spark, d), b, SERIES).drop("on_calendar")
    return panel.align(
        axis, {"price": b.select(*KEY, "close"), "flow": b.where("volume % 2 = 0").select(*KEY, "volume")}, KEY
    )


@query(
    "panel_month_axis",
    days="month",
    sql="""with r as (select o_custkey, date_trunc('month', o_orderdate)::date as month, count(*) as n from orders
    group by 1, 2), e as (select o_custkey, min(month) as a, max(month) as z from r group by 1), x as (select
    o_custkey, unnest(generate_series(a, z, interval 1 month))::date as month from e) select x.o_custkey, x.month, n
    from x left join r using (o_custkey, month)""",
)
def _(spark, d):
    r = table(spark, d, "orders").groupBy(
        "o_custkey", F.trunc("o_orderdate", "month").alias("month")
    ).agg(F.count("*").alias("n"))
    return panel.month_axis(r, "o_custkey", "month")


@query(
    "panel_latest_indices",
    days="trade_date",
    sql=f"""{with_('bars')} select source, stock_id as index_name, max(trade_date) as trade_date, arg_max(close,
    trade_date) as close from bars group by 1, 2""",
)
def _(spark, d):
    return panel.latest_indices(
        bars(spark, d).select("source", F.col("stock_id").alias("index_name"), "trade_date", "close")
    )


@query(
    "panel_default_source",
    """select l_suppkey::varchar as stock_id, arg_max(l_returnflag, l_shipdate::date::varchar || l_returnflag) as
    source from lineitem group by 1""",
)
def _(spark, d):
    return panel.default_source(
        table(spark, d, "lineitem").select(
            F.col("l_suppkey").cast("string").alias("stock_id"),
            F.col("l_shipdate").cast("date").alias("trade_date"),
            F.col("l_returnflag").alias("source"),
        )
    )


@query(
    "panel_market_flows",
    days="trade_date",
    sql="""select 'feed' as source, ts::date as trade_date, sum(event_id) filter (event_type = 'view')::bigint as
    view, sum(event_id) filter (event_type = 'click')::bigint as click, sum(event_id) filter (event_type =
    'purchase')::bigint as purchase from events where event_type in ('view', 'click', 'purchase') group by 2""",
)
def _(spark, d):
    e = table(spark, d, "events").groupBy(
        F.lit("feed").alias("source"),
        F.col("ts").cast("date").alias("trade_date"),
        F.col("event_type").alias("institution"),
    ).agg(F.sum("event_id").alias("net"))
    return panel.flow_panel(e, ["view", "click", "purchase"], totals=["signup", "error"])


@query(
    "panel_distribution_rows",
    days="snapshot_date",
    sql=_LEVELS + """ select stock_id, snapshot_date, position, label, holders, shares, percent::double as percent
    from wide, lateral (""" + " union all ".join(
        f"""select {i} as position, 'L{i}' as label, holders_{i} as holders, shares_{i} as shares, percent_{i} as
    percent"""
        for i in range(1, 16)
    ) + """ union all select 16, 'adjustment', null, adjustment_shares, adjustment_percent union all select 17,
    'total', total_holders, total_shares, total_percent) t""",
)
def _(spark, d):
    w = long_to_wide_levels(levels(spark, d), ["stock_id", "source", "snapshot_date"])
    return panel.distribution_rows(w, [f"L{i}" for i in range(1, 16)], ["stock_id", "snapshot_date"])


@query(
    "panel_report_lines",
    f"""{_Q}, y as (select report_id, stock_id, report_year, report_quarter, case when period_end <>
    last_day(make_date(report_year, report_quarter * 3, 1)) then 'o' when period_start =
    make_date(report_year, 1, 1) then case report_quarter when 4 then 'a' when 1 then 'q' else 'y' end when
    period_start is null then 'o' else 'q' end as basis, account_code, value, case when report_category =
    'consolidated' then '8610' else '8200' end as acc from facts f join reports r on r.id = f.report_id
    where statement = 'income_statement')
    select report_id, stock_id, report_year, report_quarter, case when min(value) filter (account_code = '9750' and
    basis = 'q') = max(value) filter (account_code = '9750' and basis = 'q') then max(value) filter (account_code =
    '9750' and basis = 'q') end::bigint as eps, max(value) filter (account_code = acc and basis = 'q')::bigint as
    income, false as conflict, report_quarter = 4 as quarter_missing from y group by 1, 2, 3, 4""",
)
def _(spark, d):
    from tidemark.operators.valuation import period_basis

    r = reports(spark, d)
    f = facts(r).where("statement = 'income_statement'").join(
        r.select(F.col("id").alias("report_id"), "stock_id", "report_year", "report_quarter", "report_category"),
        "report_id",
    )
    basis = period_basis(F.col("report_year"), F.col("report_quarter"), F.col("period_start"), F.col("period_end"))
    return panel.report_lines(
        f,
        {
            "eps": {"consolidated": "9750", "individual": "9750"},
            "income": {"consolidated": "8610", "individual": "8200"},
        },
        basis,
        "quarter",
    )


@query(
    "panel_cell_states",
    f"""{with_('flows')} select case when stock_id::int % 3 = 0 then 'unsourced' when net is null then 'empty' else
    'value' end as state, count(*) as n from flows group by 1""",
)
def _(spark, d):
    return flows(spark, d).groupBy(
        panel.cell_state(F.col("net"), F.col("stock_id").cast("int") % 3 == 0).alias("state")
    ).agg(F.count("*").alias("n"))


@query(
    "panel_search",
    """select c_custkey::varchar as stock_id, c_name as name, c_nationkey % 2 = 0 as listed, case when
    c_custkey::varchar = '12' then 0 when starts_with(c_custkey::varchar, '12') then 1 when contains(c_name, '12')
    then 2 end as rank from customer where c_custkey::varchar = '12' or starts_with(c_custkey::varchar, '12') or
    contains(c_name, '12') order by rank, listed desc, stock_id limit 10""",
)
def _(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("stock_id"),
        F.col("c_name").alias("name"),
        (F.col("c_nationkey") % 2 == 0).alias("listed"),
    )
    return panel.search(c, "12")


@query(
    "panel_price_gaps",
    f"""{with_('versions')}, l as (select * from versions qualify row_number() over (partition by stock_id, source,
    trade_date order by recorded_at desc) = 1), r as (select close / nullif(lag(close) over (partition by stock_id,
    source order by trade_date), 0) as r from l) select count(*) as n_rows, count(*) filter (abs(r - 1) > 0.1) as
    n_gaps from r""",
)
def _(spark, d):
    return panel.price_gap_count(versions(spark, d))


def other_copy(spark, d):
    """The bars as another system might hold them: some days missing, some volumes off, some captured a day late."""
    b = bars(spark, d)
    return b.where("volume % 37 <> 0").withColumn(
        "volume", F.col("volume") + F.when(F.col("volume") % 11 == 0, 1).otherwise(0)
    )


_TWO = f"""{with_('bars')}, theirs as (select stock_id, source, trade_date, close, volume + case when volume % 11 = 0
    then 1 else 0 end as volume from bars where volume % 37 <> 0), ours as (select * from bars where volume % 41 <>
    0)"""


@query(
    "reconcile_key_classes",
    f"""{_TWO}, k as (select stock_id, source, trade_date, volume % 41 <> 0 as o, volume % 37 <> 0 as t,
    day(trade_date) <> 3 as oi, day(trade_date) <> 4 as ti from bars)
    select case when o and t then 'both' when o and not ti then 'ours_only_input_missing_there' when o then
    'ours_only_unexplained' when t and not oi then 'theirs_only_input_missing_here' when t then
    'theirs_only_unexplained' else 'inputs_only' end as key_class, count(*) as n, sum(case when o then volume_o
    end)::bigint as ours_volume, sum(case when t then volume_t end)::bigint as theirs_volume
    from (select k.*, b.volume as volume_o, b.volume + case when b.volume % 11 = 0 then 1 else 0 end as volume_t from
    k join bars b using (stock_id, source, trade_date)) where o or t or oi or ti group by 1""",
)
def _(spark, d):
    b = bars(spark, d)
    v = [*KEY, "volume"]
    m = reconcile.merge_sides(
        {
            "ours": b.where("volume % 41 <> 0").select(*v),
            "our_input": b.where("day(trade_date) <> 3").select(*v),
            "theirs": other_copy(spark, d).select(*v),
            "their_input": b.where("day(trade_date) <> 4").select(*v),
        },
        KEY,
    )
    return reconcile.key_differences(m).groupBy("key_class").agg(
        F.count("*").alias("n"),
        F.sum("ours_volume").alias("ours_volume"),
        F.sum("theirs_volume").alias("theirs_volume"),
    )


@query(
    "reconcile_another_date",
    f"""{_TWO}, x as (select o.volume as a, t.volume as b, n.volume as c from bars o join theirs t using (stock_id,
    source, trade_date) left join bars n on n.stock_id = o.stock_id and n.source = o.source and n.trade_date =
    o.trade_date + 1 and day(o.trade_date) % 2 = 0)
    select case when a = b then 'equal' when b = c then 'captured_another_date' else 'differ' end as diff_class,
    count(*) as n from x group by 1""",
)
def _(spark, d):
    b = bars(spark, d)
    mapping = b.select("trade_date").distinct().where("day(trade_date) % 2 = 0").withColumn(
        "mapped_date", F.date_add("trade_date", 1)
    )
    return reconcile.captured_another_date(
        b, other_copy(spark, d), mapping, SERIES, "volume"
    ).groupBy("diff_class").agg(F.count("*").alias("n"))


@query(
    "reconcile_top_and_samples",
    f"""{_TWO}, x as (select o.stock_id, o.source, o.trade_date from bars o join theirs t using (stock_id, source,
    trade_date) where o.volume <> t.volume), s as (select *, row_number() over (partition by source order by stock_id,
    trade_date) as r from x),
    top as (select source, year(trade_date) as y, count(*) as n from x group by 1, 2 order by n desc, source, y limit
    20)
    select 'sample' as kind, source, stock_id || ' ' || trade_date::varchar as item, 1::bigint as n from s where r <=
    10 union all select 'top', source, y::varchar, n from top""",
)
def _(spark, d):
    o, t = bars(spark, d), other_copy(spark, d).select(*KEY, F.col("volume").alias("v"))
    x = o.join(t, KEY).where("volume <> v").select(*KEY)
    s = reconcile.samples(x, "source", ["stock_id", "trade_date"]).select(
        F.lit("sample").alias("kind"),
        "source",
        F.concat_ws(" ", "stock_id", F.col("trade_date").cast("string")).alias("item"),
        F.lit(1).cast("bigint").alias("n"),
    )
    top = reconcile.top_counts(x.withColumn("y", F.year("trade_date")), ["source", "y"]).select(
        F.lit("top").alias("kind"), "source", F.col("y").cast("string").alias("item"), "n"
    )
    return s.unionByName(top)


@query(
    "reconcile_drift",
    f"""{with_('flows')}, x as (select stock_id, source, trade_date, coalesce(net, 0) as a, coalesce(net, 0) + case
    when stock_id::int % 4 = 0 and day(trade_date) = 9 then 500 else 0 end as b from flows),
    y as (select *, sum(a) over w as sa, sum(b) over w + case when stock_id::int % 10 = 1 then 7 else 0 end as sb,
    sum(a - b) over w as drift from x window w as (partition by stock_id, source order by trade_date rows unbounded
    preceding))
    select case when sa = sb then 'equal' when sa - sb = drift then 'explained_by_net_drift' else 'unexplained' end as
    diff_class, count(*) as n, sum(drift)::bigint as drift from y group by 1""",
)
def _(spark, d):
    f = flows(spark, d).select(*KEY, F.coalesce("net", F.lit(0)).alias("a"))
    f = f.withColumn(
        "b",
        F.col("a")
        + F.when((F.col("stock_id").cast("int") % 4 == 0) & (F.dayofmonth("trade_date") == 9), 500).otherwise(0),
    )
    s = metrics.cumulative_flow(metrics.cumulative_flow(f, "a", out="sa"), "b", out="sb").withColumn(
        "sb", F.col("sb") + F.when(F.col("stock_id").cast("int") % 10 == 1, 7).otherwise(0)
    )
    return reconcile.cumulative_drift(s, "a", "b", "sa", "sb").groupBy("diff_class").agg(
        F.count("*").alias("n"), F.sum("drift").alias("drift")
    )


@query(
    "reconcile_ratios",
    f"""{with_('flows')} select case when n_events % 5 <> 0 then 'equal' when day(trade_date) = 9 then 'known_date'
    when volume = 0 then 'issued_shares_missing' else 'unexplained' end as diff_class, count(*) as n from flows group
    by 1""",
)
def _(spark, d):
    f = flows(spark, d).select(
        "trade_date",
        (F.col("n_events") / 7.0).alias("a"),
        (F.col("n_events") / 7.0 + F.when(F.col("n_events") % 5 == 0, 1).otherwise(0)).alias("b"),
        F.nullif("volume", F.lit(0)).alias("issued"),
    )
    known = f.where("day(trade_date) = 9").select("trade_date")
    return reconcile.ratio_classes(f, known, "a", "b", "issued").groupBy("diff_class").agg(F.count("*").alias("n"))


_AXIS = f"""{with_('flows')}, x as (select stock_id, source, trade_date, coalesce(sign(net), 0) as a, case when
    day(trade_date) = 9 then 0 when day(trade_date) = 17 then -coalesce(sign(net), 0) else coalesce(sign(net), 0) end as b, true as o, day(trade_date) % 8 <> 5 as t,
    row_number() over (partition by stock_id, source order by trade_date) as i from flows),
    oa as (select *, row_number() over (partition by stock_id, source, g order by trade_date) * a as k from (select *,
    sum(c) over (partition by stock_id, source order by trade_date) as g from (select *, case when a <>
    coalesce(lag(a) over (partition by stock_id, source order by trade_date), 9) then 1 else 0 end as c from x))),
    tb as (select *, row_number() over (partition by stock_id, source, g order by trade_date) * b as k from (select *,
    sum(c) over (partition by stock_id, source order by trade_date) as g from (select *, case when b <>
    coalesce(lag(b) over (partition by stock_id, source order by trade_date), 9) then 1 else 0 end as c from x where
    t)))"""


@query(
    "reconcile_streaks",
    f"""{_AXIS}, d as (select oa.stock_id, oa.source, oa.i, greatest(abs(oa.k), abs(tb.k)) as reach from oa join tb
    using (stock_id, source, trade_date) where oa.k <> tb.k)
    select case when d.stock_id::int % 10 = 3 then 'market_transfer' when exists (select 1 from x where x.stock_id = d.stock_id
    and x.source = d.source and x.i between d.i - reach and d.i and not t) then 'day_sets_differ' when exists (select 1 from x where
    x.stock_id = d.stock_id and x.source = d.source and x.i between d.i - reach and d.i and a <> b and day(trade_date) = 9)
    then 'captured_another_date' when exists (select 1 from x where x.stock_id = d.stock_id and
    x.source = d.source and x.i between d.i - reach and d.i and a <> b) then 'net_sign_differs' else 'unexplained' end
    as diff_class, count(*) as n from d group by 1""",
)
def _(spark, d):
    f = flows(spark, d).select(*KEY, F.coalesce(F.signum(F.col("net").cast("double")), F.lit(0.0)).alias("a"))
    on = F.dayofmonth("trade_date")
    f = f.withColumn("b", F.when(on == 9, 0.0).when(on == 17, -F.col("a")).otherwise(F.col("a"))).withColumn(
        "t", F.dayofmonth("trade_date") % 8 != 5
    )
    mine = metrics.streaks(f, ["a"]).select(*KEY, F.col("a_streak_days").alias("ours_streak"))
    their = metrics.streaks(f.where("t"), ["b"]).select(*KEY, F.col("b_streak_days").alias("theirs_streak"))
    axis = f.join(mine, KEY).join(their, KEY, "left").withColumns(
        {"in_ours": F.lit(True), "in_theirs": F.col("t"), "ours_sign": F.col("a"), "theirs_sign": F.col("b")}
    )
    transfers = f.where("cast(stock_id as int) % 10 = 3")
    return reconcile.streak_classes(axis, transfers, f.where(on == 9)).groupBy("diff_class").agg(F.count("*").alias("n"))


@query(
    "reconcile_indicators",
    f"""{with_('bars')}, i as (select *, row_number() over (partition by stock_id, source order by trade_date) as i,
    volume % 97 = 0 as dr, trade_date = date '1996-03-13' or (stock_id::int % 3 = 0 and trade_date = date '1997-05-20') as fr,
    trade_date = date '1996-03-13' as frozen from bars),
    one as (select stock_id from i where fr group by 1 having min(trade_date) = max(trade_date) and bool_and(frozen)),
    f as (select *, max(case when dr then i end) over w as ld, max(case when fr then i end) over w as lf from i window
    w as (partition by stock_id, source order by trade_date rows unbounded preceding)), m as (select f.*, metric, len,
    case when volume % 3 = 0 then 0.0000001 when volume % 3 = 1 then 0.01 else 5 end as gap from f, (values ('ma5',
    5), ('vma20', 20), ('macd_dif', null)) t(metric, len))
    select metric, case when stock_id::int % 50 = 1 then 'market_transfer' when ld is not null and (len is null or i -
    ld < len) then 'dropped_no_trade_days' when metric = 'vma20' and lf is not null and i - lf < 20 and stock_id in (select stock_id from one) then
    'frozen_volume' else 'unexplained' end as diff_class, case when gap < 1e-6 then 'below_1e-6' when gap < 1 then
    'below_1' else 'at_or_above_1' end as magnitude, count(*) as n from m group by 1, 2, 3""",
)
def _(spark, d):
    b, frozen = bars(spark, d), F.col("trade_date") == day("1996-03-13")
    axis = b.select(
        *KEY,
        (F.col("volume") % 97 == 0).alias("dropped"),
        (frozen | ((F.col("stock_id").cast("int") % 3 == 0) & (F.col("trade_date") == day("1997-05-20")))).alias("volume_differs"),
        frozen.alias("frozen"),
    )
    gap = F.when(F.col("volume") % 3 == 0, 1e-7).when(F.col("volume") % 3 == 1, 0.01).otherwise(5.0)
    diff = b.select(
        *KEY,
        F.explode(F.array(F.lit("ma5"), F.lit("vma20"), F.lit("macd_dif"))).alias("metric"),
        F.lit(0.0).alias("ours"),
        gap.alias("theirs"),
    )
    transfers = b.where("cast(stock_id as int) % 50 = 1").select("stock_id")
    return reconcile.indicator_classes(diff, axis, {"ma5": 5, "vma20": 20}, transfers).groupBy(
        "metric", "diff_class", "magnitude"
    ).agg(
        F.count("*").alias("n")
    )


@query(
    "reconcile_rebased_changes",
    days="snapshot_date",
    sql="""with o as (select l_suppkey::varchar as stock_id, 'weekly' as source, date_trunc('month', l_shipdate)::date
    as snapshot_date, sum(l_quantity::bigint)::bigint as v from lineitem group by 1, 2, 3), t as (select * from o
    where v % 5 <> 0), tt as (select *, lag(snapshot_date) over w as p, v - lag(v) over w as c from t window w as
    (partition by stock_id order by snapshot_date)), oo as (select *, v - lag(v) over (partition by stock_id order by
    snapshot_date) as c from o)
    select oo.stock_id, oo.source, oo.snapshot_date, oo.c as our_change, tt.c as their_change, oo.v - x.v as
    rebased_change from oo join tt using (stock_id, snapshot_date) left join o x on x.stock_id = tt.stock_id and
    x.snapshot_date = tt.p""",
)
def _(spark, d):
    o = table(spark, d, "lineitem").groupBy(
        F.col("l_suppkey").cast("string").alias("stock_id"),
        F.lit("weekly").alias("source"),
        F.trunc("l_shipdate", "month").alias("snapshot_date"),
    ).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("v"))
    return reconcile.rebased_change(o, o.where("v % 5 <> 0"), "v")


@query(
    "reconcile_valuation",
    f"""{_TWO} select case when volume % 37 = 0 and volume % 41 <> 0 then 'ours_only' when volume % 41 = 0 and volume
    % 37 <> 0 then 'theirs_only' when volume % 11 <> 0 then 'equal' when volume % 2 = 0 then 'publication_date' else
    'unexplained' end as diff_class, count(*) as n from bars where not (volume % 37 = 0 and volume % 41 = 0) group by
    1""",
)
def _(spark, d):
    b = bars(spark, d)
    alternative = b.withColumn(
        "volume", F.when(F.col("volume") % 2 == 0, F.col("volume") + 1).otherwise(F.col("volume"))
    )
    return reconcile.valuation_classes(
        b.where("volume % 41 <> 0"), other_copy(spark, d), alternative, KEY, "volume"
    ).groupBy("diff_class").agg(F.count("*").alias("n"))


_GAPS = f"""{with_('bars', 'actions')},
    cal as (select distinct trade_date as d from bars where isodow(trade_date) <> 7),
    sp as (select distinct stock_id, case when stock_id::int % 12 = 0 or stock_id::int % 2 = 1 then 'otc' else 'sii' end as market,
        date '1996-01-07' as listed_on from bars where stock_id::int % 3 = 0),
    days as (select distinct trade_date as d from bars union select date '1996-01-07'),
    ranks as (select d, (select count(*) from cal where cal.d <= days.d) as upto, (select count(*) from cal where cal.d < days.d) as before from days),
    ends as (select stock_id, source, max(trade_date) as z, min(trade_date) as first from bars group by 1, 2),
    b as (select *, case when volume % 23 <> 0 then close end as c from bars),
    f as (select b.stock_id, b.source, b.trade_date, any_value(b.c) as c, case when count(*) filter (e.ex_date is not null and
        e.event_factor is null) = 0 then coalesce(product(e.event_factor), 1) end as factor from b join ends using (stock_id, source)
        left join actions e on e.stock_id = b.stock_id and e.source = b.source and e.ex_date > b.trade_date and e.ex_date <= z group by 1, 2, 3),
    t as (select f.*, c * factor as a, lag(trade_date) over w as pd, lag(c) over w as pc, lag(c * factor) over w as pa from f
        where c is not null window w as (partition by stock_id, source order by trade_date)),
    lim0 as (select stock_id, ex_date, feed, min(o_orderkey) as m from actions group by 1, 2, 3),
    lim as (select stock_id, ex_date, bool_and(m % 11 <> 0) as known, max(900 + m % 300) as lowest, min(1000 + m % 300 + m % 700) as highest
        from lim0 group by 1, 2),
    g as (select t.*, first, case when sp.listed_on <= t.trade_date then listed_on end as listed,
        exists (select 1 from actions e where e.stock_id = t.stock_id and e.source = t.source and ex_date > pd and ex_date <= t.trade_date) as e,
        r.upto - p.upto as k, r.upto - l.before as nth_listed, r.upto - x.before as nth_first,
        coalesce(known and c between lowest and highest, false) as held
        from t join ends using (stock_id, source) join ranks r on r.d = t.trade_date join ranks p on p.d = pd join ranks x on x.d = first
        left join sp on sp.stock_id = t.stock_id and sp.market = case t.source when 'alpha' then 'sii' else 'otc' end
        left join ranks l on l.d = listed_on and listed_on <= t.trade_date
        left join lim on lim.stock_id = t.stock_id and lim.ex_date = t.trade_date
            and exists (select 1 from actions e where e.stock_id = t.stock_id and e.source = t.source and e.ex_date = t.trade_date)),
    kinds as (select 'raw' as kind, c / nullif(pc, 0) as ratio, g.* from g union all select 'adjusted', a / nullif(pa, 0), g.* from g),
    h as (select *, case when coalesce(nth_listed <= 5, false) then 'new_listing'
            when first > date '1995-01-03' and nth_first <= 5 and not coalesce(listed >= first, false) then 'series_start'
            when kind = 'adjusted' and e and held then 'within_published_limits' end as dt
        from kinds where ratio is null or ratio > pow(1.1::double, k) + 1e-9 or ratio < pow(0.9::double, k) - 1e-9)"""


@query(
    "reconcile_gap_classes",
    f"""{_GAPS} select kind, case when ratio is null then 'unknown' when dt is not null then
        'explained_by_other_documented_market_event' when e then 'explained_by_corporate_action' else 'unexplained_anomaly' end as reason,
        case when ratio is not null then coalesce(dt, case when e then 'corporate_action' end) end as detail, count(*) as n,
        sum(k)::bigint as sessions from h group by 1, 2, 3""",
)
def _(spark, d):
    b = bars(spark, d).withColumn("close", F.when(F.col("volume") % 23 != 0, F.col("close")))
    events, u = actions(spark, d), F.col("stock_id").cast("int")
    sources = spark.createDataFrame([("alpha", "alpha"), ("beta", "beta")], "source string, price_source string")
    prices = metrics.adjusted_prices(b, events, sources)
    sp = b.where(u % 3 == 0).select("stock_id").distinct().select(
        "stock_id",
        F.when((u % 12 == 0) | (u % 2 == 1), "otc").otherwise("sii").alias("market"),
        day("1996-01-07").alias("listed_on"),
    )
    fetches, store = limit_payloads(spark, d)
    allowed = reconcile.event_limits(events, fetches, payloads.published_limits(store))
    sessions = reconcile.Sessions(b.where("dayofweek(trade_date) <> 1"))
    markets = {"alpha": "sii", "beta": "otc"}
    x = reconcile.classify_gaps(prices, events, sessions, sp, markets, day("1995-01-03"), allowed)
    return x.groupBy("kind", "reason", "detail").agg(F.count("*").alias("n"), F.sum("sessions").alias("sessions"))


@query(
    "reconcile_event_continuity",
    days="ex_date",
    sql=f"""{with_('bars', 'actions')}, ev as (select * from actions) select
    e.stock_id, e.source, e.ex_date, e.close_before::double as close_before, b.close as previous_close,
    coalesce(e.close_before::double = b.close, false) as continuous from ev e asof left join bars b on b.stock_id =
    e.stock_id and b.source = e.source and e.ex_date > b.trade_date""",
)
def _(spark, d):
    return reconcile.event_continuity(actions(spark, d), bars(spark, d))


@query(
    "reconcile_table_equality",
    f"""{_TWO}, a as (select stock_id, source, volume from ours), b as (select stock_id, source, volume from theirs)
    select 'first' as side, count(*) as n, sum(volume)::bigint as v from (select * from a except all select * from b)
    union all select 'second', count(*), sum(volume)::bigint from (select * from b except all select * from a)""",
)
def _(spark, d):
    c = ["stock_id", "source", "volume"]
    return reconcile.table_differences(
        bars(spark, d).where("volume % 41 <> 0").select(*c), other_copy(spark, d).select(*c)
    ).groupBy("side").agg(
        F.count("*").alias("n"), F.sum("volume").alias("v")
    )


@query(
    "reconcile_version_changes",
    days="trade_date",
    sql=f"""{with_('versions')}, x as (select *, lag(volume) over w as ov, lag(close) over w as oc from versions
    window w as (partition by stock_id, source, trade_date order by recorded_at)) select stock_id, source, trade_date,
    recorded_at, (case when ov <> volume then 1 else 0 end + case when oc <> close then 1 else 0 end)::int as
    n_changed, case when ov <> volume then ov::varchar || ' -> ' || volume::varchar end as volume_change from x where
    ov is not null""",
)
def _(spark, d):
    x = reconcile.version_changes(versions(spark, d), KEY, ["volume", "close"])
    return x.select(
        *KEY,
        "recorded_at",
        F.size("changes").alias("n_changed"),
        F.try_element_at("changes", F.lit("volume")).alias("volume_change"),
    )


@query("reconcile_idempotence", """select 0::bigint as appended""")
def idempotence(spark, d):
    """Rows that ingesting the stored versions again would append: none."""
    from tidemark.operators.append import append_changed

    v = versions(spark, d)
    return append_changed(pit.latest_per_key(v, KEY), v, KEY, ["close", "volume"]).agg(F.count("*").alias("appended"))
