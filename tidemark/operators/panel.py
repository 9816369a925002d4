"""Query-surface and panel operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.pit import latest_per_key


def mark_unsourced(df: DataFrame, unsourced: Mapping[str, Sequence[str]]) -> DataFrame:
    """Columns a source never publishes (I3): nulled, and named in ``unsourced``, apart from published nulls."""
    out, names = df, []
    columns = sorted({c for cs in unsourced.values() for c in cs})
    for c in columns:
        never = F.col("source").isin([s for s, cs in unsourced.items() if c in cs])
        out = out.withColumn(c, F.when(~never, F.col(c)))
        names.append(F.when(never, F.lit(c)))
    return out.withColumn("unsourced", F.array_compact(F.array(*names)))


def json_rows(df: DataFrame) -> DataFrame:
    """Rows as JSON objects without their unsourced columns; other nulls stay."""
    keep = [c for c in df.columns if c != "unsourced"]
    values = F.map_from_arrays(
        F.array(*[F.lit(c) for c in keep]),
        F.array(*[F.coalesce(F.to_json(F.struct(F.col(c).alias("v"))), F.lit("{}")) for c in keep]),
    )
    shown = F.filter(F.map_entries(values), lambda e: ~F.array_contains("unsourced", e["key"]))
    cell = F.transform(
        shown,
        lambda e: F.concat(
            F.lit('"'),
            e["key"],
            F.lit('":'),
            F.when(e["value"] == "{}", "null").otherwise(F.regexp_replace(e["value"], r'^\{"v":|\}$', "")),
        ),
    )
    return df.select(F.concat(F.lit("{"), F.array_join(cell, ","), F.lit("}")).alias("json"))


def unsourced_audit(df: DataFrame, unsourced: Mapping[str, Sequence[str]]) -> DataFrame:
    """(source, column, values) of unsourced columns that do hold values (I4)."""
    columns = sorted({c for cs in unsourced.values() for c in cs})
    counts = df.groupBy("source").agg(*[F.count(c).alias(c) for c in columns]).unpivot(
        ["source"], columns, "column", "n_values"
    )
    bad = F.lit(False)
    for s, cs in unsourced.items():
        bad = bad | ((F.col("source") == s) & F.col("column").isin(list(cs)))
    return counts.where(bad & (F.col("n_values") > 0))


def reports_with_facts(reports: DataFrame, facts: DataFrame) -> DataFrame:
    """Each report with its facts nested in order."""
    f = F.struct("statement", "account_code", "concept", "period_start", "period_end", "value")
    nested = facts.groupBy("report_id").agg(F.array_sort(F.collect_list(f)).alias("facts"))
    return reports.join(nested, reports.id == nested.report_id, "left").drop("report_id")


def calendar_range(calendar: DataFrame, start: Column, end: Column) -> DataFrame:
    """Trading days of a range in order."""
    return calendar.where(F.col("trade_date").between(start, end)).orderBy("trade_date")


def trading_axis(calendar: DataFrame, rows: DataFrame, series: Sequence[str]) -> DataFrame:
    """Per series the calendar days between its first and last row and its own off-calendar days, flagged.

    A series' days are counted out from its first to its last and joined with the calendar by equality."""
    ends = rows.groupBy(*series).agg(F.min("trade_date").alias("__a"), F.max("trade_date").alias("__z"))
    cal = calendar.select(F.col("trade_date")).distinct()
    every = ends.select(*series, F.explode(F.sequence("__a", "__z")).alias("trade_date"))
    days = every.join(cal, "trade_date", "left_semi").select(*series, "trade_date", F.lit(True).alias("on_calendar"))
    off = rows.select(*series, "trade_date").distinct().join(cal, "trade_date", "left_anti").select(
        *series, "trade_date", F.lit(False).alias("on_calendar")
    )
    return days.unionByName(off)


def align(axis: DataFrame, datasets: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Datasets side by side on an axis (I8); two rows of a dataset on a key fail the job. Value columns get the
    dataset's name in front."""
    out = axis
    for name, df in datasets.items():
        values = [c for c in df.columns if c not in keys]
        one = df.groupBy(*keys).agg(F.count("*").alias("__n"), *[F.first(c).alias(f"{name}_{c}") for c in values])
        checked = one.withColumn(
            "__ok",
            F.when(F.col("__n") > 1, F.raise_error(F.lit(f"two rows of {name} on a key")).cast("int")).otherwise(1),
        )
        out = out.join(checked.where("__ok = 1").drop("__n", "__ok"), list(keys), "left")
    return out


def month_axis(rows: DataFrame, key: str, month: str) -> DataFrame:
    """Every month from a key's first to its last, gap months with nulls."""
    ends = rows.groupBy(key).agg(
        F.trunc(F.min(month), "month").alias("__a"), F.trunc(F.max(month), "month").alias("__z")
    )
    axis = ends.select(key, F.explode(F.sequence("__a", "__z", F.expr("interval 1 month"))).alias(month))
    return axis.join(rows.withColumn(month, F.trunc(month, "month")), [key, month], "left")


def latest_indices(rows: DataFrame) -> DataFrame:
    """The last row of every (source, index)."""
    return latest_per_key(rows, ["source", "index_name"], "trade_date")


def default_source(rows: DataFrame, key: str = "stock_id") -> DataFrame:
    """The source of a key's latest row (I11); of two on one day the larger name."""
    return rows.groupBy(key).agg(F.max_by("source", F.struct("trade_date", "source")).alias("source"))


def flow_panel(rows: DataFrame, institutions: Sequence[str], totals: Sequence[str] = ("total",)) -> DataFrame:
    """Institutions' nets as columns by date (I12), totals dropped. An institution outside the list fails the job."""
    known = rows.where(~F.col("institution").isin(list(totals)))
    checked = known.withColumn(
        "institution",
        F.when(F.col("institution").isin(list(institutions)), F.col("institution")).otherwise(
            F.raise_error(F.concat(F.lit("unknown institution "), F.col("institution"))).cast("string")
        ),
    )
    return checked.groupBy("source", "trade_date").pivot("institution", list(institutions)).agg(F.first("net"))


def distribution_rows(wide: DataFrame, labels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Wide levels as rows with range labels, then adjustment and total."""
    items = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(label).alias("label"),
            F.col(f"holders_{i}").cast("bigint").alias("holders"),
            F.col(f"shares_{i}").cast("bigint").alias("shares"),
            F.col(f"percent_{i}").cast("double").alias("percent"),
        )
        for i, label in enumerate(labels, 1)
    ]
    n = len(labels)
    items.append(
        F.struct(
            F.lit(n + 1).alias("position"),
            F.lit("adjustment").alias("label"),
            F.lit(None).cast("bigint").alias("holders"),
            F.col("adjustment_shares").cast("bigint").alias("shares"),
            F.col("adjustment_percent").cast("double").alias("percent"),
        )
    )
    items.append(
        F.struct(
            F.lit(n + 2).alias("position"),
            F.lit("total").alias("label"),
            F.col("total_holders").cast("bigint").alias("holders"),
            F.col("total_shares").cast("bigint").alias("shares"),
            F.col("total_percent").cast("double").alias("percent"),
        )
    )
    return wide.select(*keys, F.explode(F.array(*items)).alias("x")).select(*keys, "x.*")


def report_lines(facts: DataFrame, accounts: Mapping[str, Mapping[str, str]], basis: Column, want: str) -> DataFrame:
    """Named lines per report from category-specific accounts at one basis (I14). Facts of whatever statements the caller
    chose count. Conflicting duplicates give null and set ``conflict``; Q4 has no single quarter of its own, which
    ``quarter_missing`` says."""
    tagged = facts.withColumn("__b", basis)
    cols, conflict = [], F.lit(False)
    for line, by_category in accounts.items():
        account = F.lit(None).cast("string")
        for category, code in by_category.items():
            account = F.when(F.col("report_category") == category, code).otherwise(account)
        v = F.when((F.col("account_code") == account) & (F.col("__b") == want), F.col("value"))
        cols.append(F.when(F.min(v) == F.max(v), F.max(v)).alias(line))
        conflict = conflict | F.coalesce(F.min(v) != F.max(v), F.lit(False))
    key = ["report_id", "stock_id", "report_year", "report_quarter"]
    return tagged.groupBy(*key).agg(*cols, conflict.alias("conflict")).withColumn(
        "quarter_missing", F.lit(want == "quarter") & (F.col("report_quarter") == 4)
    )


def cell_state(value: Column, unsourced: Column) -> Column:
    """value, empty or unsourced."""
    return F.when(unsourced, "unsourced").when(value.isNull(), "empty").otherwise("value")


def search(stocks: DataFrame, text: str, k: int = 10) -> DataFrame:
    """The k best stocks for a text (I17): exact code, code prefix, name contains; listed ones first."""
    rank = F.when(F.col("stock_id") == text, 0).when(F.startswith("stock_id", F.lit(text)), 1).when(
        F.contains("name", F.lit(text)), 2
    )
    return stocks.withColumn("rank", rank).where("rank is not null").orderBy(
        "rank", F.desc("listed"), "stock_id"
    ).limit(k)


def price_gap_count(
    rows: DataFrame, series: Sequence[str] = ("stock_id", "source"), threshold: float = 0.1
) -> DataFrame:
    """Closes of latest versions that moved more than the threshold from the previous row (I19): rows, gaps."""
    latest = latest_per_key(rows, [*series, "trade_date"])
    w = Window.partitionBy(*series).orderBy("trade_date")
    r = F.col("close").cast("double") / F.nullif(F.lag("close").over(w).cast("double"), F.lit(0.0))
    return latest.withColumn("r", r).agg(
        F.count("*").alias("n_rows"), F.count_if(F.abs(F.col("r") - 1) > threshold).alias("n_gaps")
    )
