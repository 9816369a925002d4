"""Quarter values, trailing earnings, price-earnings and their percentile, return on equity."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.instants import quarter_end, quarter_index, quarter_start
from tidemark.functions.rounding import round_half_even_scaled, round_half_up

#: Accounts of net income and equity by report category.
INCOME_ACCOUNT = {"consolidated": "8610", "individual": "8200"}
EQUITY_ACCOUNT = {"consolidated": "31XX", "individual": "3XXX"}
EPS_ACCOUNT = "9750"


def period_basis(year: Column, quarter: Column, start: Column, end: Column) -> Column:
    """Role of a dimensionless own duration ending at the period's end (A9): quarter, year_to_date, annual or other.

    From 1 January: the full year in Q4, the single quarter in Q1, else year to date; from the quarter's start: quarter.
    """
    closes = end == quarter_end(year, quarter)
    year_start = F.make_date(year.cast("int"), F.lit(1), F.lit(1))
    from_year = F.when(quarter == 4, "annual").when(quarter == 1, "quarter").otherwise("year_to_date")
    return F.when(~closes | start.isNull(), "other").when(start == year_start, from_year).when(
        start == quarter_start(year, quarter), "quarter"
    ).otherwise("other")


def report_inputs(reports: DataFrame, facts: DataFrame) -> DataFrame:
    """Each report's first publication day in Taipei and its latest version's facts (F22); never-published reports
    drop out."""
    key = ["stock_id", "report_year", "report_quarter"]
    first = reports.groupBy(*key).agg(
        F.min_by("published_at", "recorded_at").alias("p"),
        F.max_by(F.struct("id", "report_category"), F.col("recorded_at")).alias("v"),
    )
    day = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Taipei"), F.col("p")).cast("date")
    known = first.where("p is not null").select(
        *key,
        day.alias("published_on"),
        F.col("v.id").alias("report_id"),
        F.col("v.report_category").alias("report_category"),
    )
    return known.join(facts, "report_id")


def quarter_values(inputs: DataFrame) -> DataFrame:
    """One row per report: single-quarter EPS and net income, and equity.

    Q1 is its year to date; Q2 and Q3 their own quarter; Q4 the annual value less Q3's year to date (null without it)
    and public when both are. Accounts follow the report's category; earnings are read from the income statement and
    equity from the balance sheet, at the quarter's last day, so comparative figures and other statements that name the
    same accounts don't count. A basis with two different values is null (F32).
    """
    key = ["stock_id", "report_year", "report_quarter", "published_on"]
    basis = period_basis(F.col("report_year"), F.col("report_quarter"), F.col("period_start"), F.col("period_end"))
    consolidated = F.col("report_category") == "consolidated"
    income = F.when(consolidated, INCOME_ACCOUNT["consolidated"]).otherwise(INCOME_ACCOUNT["individual"])
    equity = F.when(consolidated, EQUITY_ACCOUNT["consolidated"]).otherwise(EQUITY_ACCOUNT["individual"])
    tagged = inputs.withColumn("__b", basis)

    def one(account: Column | str, kind: str) -> Column:
        earned = (F.col("statement") == "income_statement") & (F.col("account_code") == account)
        v = F.when(earned & (F.col("__b") == kind), F.col("value"))
        return F.when(F.min(v) == F.max(v), F.max(v))

    last_day = quarter_end(F.col("report_year"), F.col("report_quarter"))
    closing = F.col("period_start").isNull() & (F.col("period_end") == last_day)
    owned = (F.col("statement") == "balance_sheet") & (F.col("account_code") == equity)
    eq = F.when(owned & closing, F.col("value"))
    cols = [F.when(F.min(eq) == F.max(eq), F.max(eq)).alias("equity")]
    for name, account in (("eps", F.lit(EPS_ACCOUNT)), ("income", income)):
        cols += [one(account, b).alias(f"{name}_{b}") for b in ("quarter", "year_to_date", "annual")]
    wide = tagged.groupBy(*key).agg(*cols)
    q3 = wide.where("report_quarter = 3").select(
        "stock_id",
        "report_year",
        F.lit(4).alias("report_quarter"),
        F.col("published_on").alias("__q3_on"),
        F.col("eps_year_to_date").alias("__q3_eps"),
        F.col("income_year_to_date").alias("__q3_income"),
    )
    joined = wide.join(q3, ["stock_id", "report_year", "report_quarter"], "left")
    last = F.col("report_quarter") == 4
    return joined.select(
        "stock_id",
        "report_year",
        "report_quarter",
        quarter_index(F.col("report_year"), F.col("report_quarter")).alias("q"),
        F.when(last, F.greatest("published_on", "__q3_on")).otherwise(F.col("published_on")).alias("published_on"),
        F.when(last, F.col("eps_annual") - F.col("__q3_eps")).otherwise(F.col("eps_quarter")).alias("eps"),
        F.when(last, F.col("income_annual") - F.col("__q3_income")).otherwise(F.col("income_quarter")).alias("income"),
        "equity",
    )


def trailing(days: DataFrame, quarters: DataFrame) -> DataFrame:
    """Trailing four quarters of every day (F23): the largest quarter public by the day and the three before it, all
    public and with EPS, else no row.

    The largest public quarter is a running maximum over days and publications in one window per stock; the four
    quarters come by one join on (stock, quarter). ``days`` has stock_id, source, trade_date and close; days of stocks
    without quarters, which have no row, stay out of the window.
    """
    days = days.join(quarters.select("stock_id").distinct(), "stock_id", "left_semi")
    marks = quarters.where("published_on is not null").select(
        "stock_id",
        F.col("published_on").alias("trade_date"),
        F.lit(None).cast("string").alias("source"),
        F.lit(None).cast(days.schema["close"].dataType).alias("close"),
        "q",
        F.lit(0).alias("__day"),
    )
    rows = days.select(
        "stock_id", "trade_date", "source", "close", F.lit(None).cast("int").alias("q"), F.lit(1).alias("__day")
    )
    w = Window.partitionBy("stock_id").orderBy("trade_date", "__day").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = rows.unionByName(marks).withColumn("q", F.max("q").over(w)).where(
        "__day = 1 and q is not null"
    ).drop("__day")
    back = Window.partitionBy("stock_id").orderBy("q").rangeBetween(-3, 0)
    four = quarters.where("published_on is not null").select(
        "stock_id",
        "q",
        F.col("equity").alias("equity"),
        F.max("published_on").over(back).alias("__on"),
        F.count("eps").over(back).alias("__n"),
        F.sum("eps").over(back).alias("ttm_eps"),
        F.count("income").over(back).alias("__ni"),
        F.sum("income").over(back).alias("ttm_income"),
    )
    out = placed.join(four, ["stock_id", "q"]).where((F.col("__n") == 4) & (F.col("__on") <= F.col("trade_date")))
    return out.withColumn("ttm_income", F.when(F.col("__ni") == 4, F.col("ttm_income"))).drop("__on", "__n", "__ni")


def price_earnings(close: Column, ttm_eps: Column) -> Column:
    """Close over trailing EPS, rounded half-even on the scaled value (F24); null unless EPS is positive and a close
    is present."""
    return F.when(
        (ttm_eps > 0) & close.isNotNull(), round_half_even_scaled(close.cast("double") / ttm_eps.cast("double"), 2)
    )


def return_on_equity(ttm_income: Column, equity: Column) -> Column:
    """Trailing income over the latest equity in percent, half up."""
    return F.when(
        (equity > 0) & ttm_income.isNotNull(),
        round_half_up(
            (ttm_income.cast("decimal(24,2)") * 100 / equity.cast("decimal(20,2)")).cast("decimal(38,10)"), 2
        ).cast("double"),
    )


def expanding_percentile(
    rows: DataFrame, column: str, out: str, series: Sequence[str] = ("stock_id", "source"), date: str = "trade_date"
) -> DataFrame:
    """Average rank of a value among the series' values so far, itself included, in percent."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema.fields)}, {out} double"

    def rank(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(date, kind="stable").reset_index(drop=True)
        values = group[column].to_numpy(float)
        held: list[float] = []
        found = np.full(len(values), np.nan)
        for i, v in enumerate(values):
            if not np.isnan(v):
                low, high = bisect_left(held, v), bisect_right(held, v)
                held.insert(high, v)
                found[i] = np.rint((low + high + 2) / 2 / len(held) * 100 * 1e4) / 1e4
        group[out] = found
        return group

    return rows.groupBy(*series).applyInPandas(rank, schema)


def valuation_metrics(days: DataFrame, quarters: DataFrame) -> DataFrame:
    """ttm_eps, pe_ratio, pe_percentile and roe of every day with four public quarters."""
    base = trailing(days, quarters)
    priced = base.select(
        "stock_id",
        "source",
        "trade_date",
        F.col("ttm_eps").cast("double").alias("ttm_eps"),
        price_earnings(F.col("close"), F.col("ttm_eps")).alias("pe_ratio"),
        return_on_equity(F.col("ttm_income"), F.col("equity")).alias("roe"),
    )
    return expanding_percentile(priced, "pe_ratio", "pe_percentile")


def eps_by_basis(facts: DataFrame) -> DataFrame:
    """Basic EPS per report and basis (F32): null and ``ambiguous`` where two facts differ. Facts carry report_year
    and report_quarter."""
    basis = period_basis(F.col("report_year"), F.col("report_quarter"), F.col("period_start"), F.col("period_end"))
    own = facts.where(
        (F.col("statement") == "income_statement") & (F.col("account_code") == EPS_ACCOUNT)
    ).withColumn("basis", basis).where("basis <> 'other'")
    stats = own.groupBy("report_id", "basis").agg(F.min("value").alias("a"), F.max("value").alias("z"))
    return stats.select(
        "report_id",
        "basis",
        F.when(F.col("a") == F.col("z"), F.col("a")).alias("eps"),
        (F.col("a") != F.col("z")).alias("ambiguous"),
    )
