"""Incremental runs of the seven derived datasets: each equals the full computation, whose SQL it is held against.

Inputs are revised versions: of some rows a first version with other values was recorded on their day and the right
one after the last run; rows dated after the last run are new.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import derived
from tidemark.plans import queries_metrics as q
from tidemark.plans.panels import bars, facts, flows, reports
from tidemark.plans.registry import query
from tidemark.sources import tables
from tidemark.sources.payloads import long_to_wide_levels

SERIES = ["stock_id", "source"]
KEY = [*SERIES, "trade_date"]
DATASETS = derived.derived_datasets({"feed": "board"}, {"feed": "holders"})


def revised(rows: DataFrame, date: str, wrong: dict[str, Column], late: Column, since: str) -> DataFrame:
    """All rows as recorded on their day; where ``late``, wrong then and right only after ``since``."""
    then = F.col(date).cast("timestamp_ntz") + F.expr("interval 20 hours")
    after = F.greatest(then + F.expr("interval 1 hour"), F.lit(since).cast("timestamp_ntz") + F.expr("interval 1 hour"))
    # A correction is made from its row, not by computing the rows a second time.
    both = rows.withColumn("__late", late).withColumn(
        "__again", F.explode(F.when(F.col("__late"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    )
    first = F.col("__late") & ~F.col("__again")
    return both.withColumns(
        {c: F.when(first, v).otherwise(F.col(c)) for c, v in wrong.items()}
    ).withColumn("recorded_at", F.when(F.col("__again"), after).otherwise(then)).drop("__late", "__again")


def updated(name: str, inputs: dict[str, DataFrame], keys: dict[str, tuple[str, ...]], since: str) -> DataFrame:
    """The table after a run at ``since`` over what was recorded by then and an incremental run over the rest. Inputs and
    the stored table lie in files, as they do between two runs."""
    dataset, at = DATASETS[name], F.lit(since).cast("timestamp_ntz")
    inputs = {k: tables.in_files(v, k) for k, v in inputs.items()}
    earlier = {k: v.where(F.col("recorded_at") <= at) if "recorded_at" in v.columns else v for k, v in inputs.items()}
    stored = tables.in_files(derived.run(dataset, earlier, None, None, at, keys), name)
    touched = tables.in_files(derived.run(dataset, inputs, stored, at, at + F.expr("interval 1 day"), keys), name)
    return derived.merged(stored, touched).drop("computed_at")


LINES_SINCE, EVENTS_SINCE = "2000-09-30 00:00:00", "2024-01-20 00:00:00"


def _late(*columns: str) -> Column:
    """A fixed twentieth of the days of half the series."""
    return (F.pmod(F.xxhash64("stock_id"), F.lit(2)) == 0) & (F.pmod(F.xxhash64(*columns), F.lit(20)) == 0)


@query(
    "incremental_technical",
    days="trade_date",
    sql=f"""select a.stock_id, a.source, a.trade_date, a.ma5, a.ma240, a.vma20, b.k, b.d
    from ({q.MOVING_SQL}) a join ({q.KD_SQL}) b using (stock_id, source, trade_date)""",
)
def _(spark, d):
    late = _late(*KEY)
    prices = revised(
        bars(spark, d), "trade_date", {"close": F.col("low"), "volume": F.col("volume") + 1}, late, LINES_SINCE
    )
    out = updated("technical_indicators", {"daily_prices": prices}, {"daily_prices": tuple(KEY)}, LINES_SINCE)
    names = ["ma5", "ma240", "vma20"]
    return out.select(*KEY, *[F.round(c, 6).alias(c) for c in names], *[F.round(c, 4).alias(c) for c in ("k", "d")])


@query("incremental_streaks", days="trade_date", sql=q.STREAKS_SQL)
def _(spark, d):
    f = flows(spark, d)
    late = _late(*KEY)
    given = revised(f.select(*KEY, "net"), "trade_date", {"net": -F.col("net")}, late, EVENTS_SINCE)
    traded = f.select("stock_id", F.lit("board").alias("source"), "trade_date", "volume")
    traded = revised(traded, "trade_date", {"volume": F.lit(0).cast("bigint")}, late, EVENTS_SINCE)
    out = updated(
        "institutional_streaks",
        {"daily_prices": traded, "institutional_flows": given},
        {"daily_prices": tuple(KEY), "institutional_flows": tuple(KEY)},
        EVENTS_SINCE,
    )
    return out.select(*KEY, F.col("net_streak_days").cast("bigint").alias("net_streak_days"))


@query("incremental_cumulative_flow", days="trade_date", sql=q.CUMULATIVE_SQL)
def _(spark, d):
    f = flows(spark, d)
    late = _late(*KEY)
    given = revised(f.select(*KEY, "net"), "trade_date", {"net": F.col("net") + 5}, late, EVENTS_SINCE)
    held = f.where("n_events % 3 <> 0").select(
        "stock_id", F.lit("holders").alias("source"), "trade_date", (F.col("n_events") * 1000).alias("issued_shares")
    )
    held = revised(
        held, "trade_date", {"issued_shares": F.col("issued_shares") + 1}, _late("stock_id", "trade_date"), EVENTS_SINCE
    )
    out = updated(
        "institutional_cumulative_flow",
        {"institutional_flows": given, "foreign_holdings": held},
        {"institutional_flows": tuple(KEY), "foreign_holdings": tuple(KEY)},
        EVENTS_SINCE,
    )
    return out.select(
        *KEY,
        F.col("net_cumulative_net").cast("bigint").alias("cumulative_net"),
        F.col("net_cumulative_ratio").alias("cumulative_ratio"),
    )


@query("incremental_concentration", days="snapshot_date", sql=q.CONCENTRATION_SQL)
def _(spark, d):
    key = [*SERIES, "snapshot_date"]
    wide = long_to_wide_levels(q.levels(spark, d), key)
    wrong = {"percent_15": F.col("percent_15") + 1, "holders_1": F.col("holders_1") + 1}
    snapshots = revised(
        wide, "snapshot_date", {c: v.cast(wide.schema[c].dataType) for c, v in wrong.items()}, _late(*key), LINES_SINCE
    )
    return updated(
        "shareholding_concentration",
        {"shareholding_distributions": snapshots},
        {"shareholding_distributions": tuple(key)},
        LINES_SINCE,
    )


@query("incremental_margin", days="trade_date", sql=q.MARGIN_SQL)
def _(spark, d):
    given = revised(
        q.margin(spark, d), "trade_date", {"margin_balance": F.col("margin_balance") + 1}, _late(*KEY), LINES_SINCE
    )
    return updated("margin_metrics", {"margin_trading": given}, {"margin_trading": tuple(KEY)}, LINES_SINCE)


@query("incremental_stored_run", days="trade_date", sql=q.MARGIN_SQL)
def _(spark, d):
    """Two runs through the table: the first writes all series, the second reads, computes and rewrites what changed."""
    given = revised(
        q.margin(spark, d), "trade_date", {"margin_balance": F.col("margin_balance") + 1}, _late(*KEY), LINES_SINCE
    )
    given = tables.in_files(given, "margin_trading")
    dataset, at = DATASETS["margin_metrics"], F.lit(LINES_SINCE).cast("timestamp_ntz")
    keys, path = {"margin_trading": tuple(KEY)}, tables.scratch_folder(spark, "margin")
    earlier = {"margin_trading": given.where(F.col("recorded_at") <= at)}
    tables.overwrite_series(derived.run(dataset, earlier, None, None, at, keys), path, "trade_date")
    stored = tables.read_series(spark, path)
    touched = derived.run(dataset, {"margin_trading": given}, stored, at, at + F.expr("interval 1 day"), keys)
    tables.overwrite_series(touched, path, "trade_date")
    return tables.read_series(spark, path).drop("computed_at")


@query("incremental_short_interest", days="trade_date", sql=q.SHORT_SQL)
def _(spark, d):
    given = revised(q.lending(spark, d), "trade_date", {"balance": F.col("balance") + 1}, _late(*KEY), LINES_SINCE)
    return updated(
        "short_interest_metrics", {"securities_lending": given}, {"securities_lending": tuple(KEY)}, LINES_SINCE
    )


@query("incremental_valuation", days="trade_date", sql=q.VALUATION_SQL)
def _(spark, d):
    prices = revised(bars(spark, d), "trade_date", {"close": F.col("low")}, _late(*KEY), LINES_SINCE)
    r = reports(spark, d)
    inputs = {"daily_prices": prices, "financial_reports": r, "financial_report_facts": facts(r)}
    out = updated("valuation_metrics", inputs, {"daily_prices": tuple(KEY)}, LINES_SINCE)
    return out.select(*KEY, "ttm_eps", "pe_ratio", F.round("roe", 1).alias("roe"), "pe_percentile")
