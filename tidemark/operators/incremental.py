"""Incremental maintenance of derived tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.rounding import strict_difference

SERIES = ("stock_id", "source")


def changed_series(inputs: Mapping[str, DataFrame], since: Column, sources: DataFrame | None = None) -> DataFrame:
    """(stock_id, source, start): per series the earliest input date recorded after ``since``, over all inputs (G1).

    ``sources`` maps (feed) source to price_source for inputs of other feeds; unmapped sources stand for themselves."""
    out = None
    for df in inputs.values():
        late = df.where(F.col("recorded_at") > since).groupBy(*SERIES).agg(F.min("trade_date").alias("start"))
        if sources is not None:
            m = sources.select(F.col("source"), "price_source")
            late = late.join(m, "source", "left").select(
                "stock_id", F.coalesce("price_source", "source").alias("source"), "start"
            )
        out = late if out is None else out.unionByName(late)
    return out.groupBy(*SERIES).agg(F.min("start").alias("start"))


def report_changes(reports: DataFrame, prices: DataFrame, since: Column) -> DataFrame:
    """Series touched by reports recorded after ``since`` (G2): every price series of the stock, from the report's
    first publication day."""
    key = ["stock_id", "report_year", "report_quarter"]
    touched = reports.groupBy(*key).agg(
        F.max("recorded_at").alias("__r"), F.min_by("published_at", "recorded_at").alias("__p")
    ).where(
        (F.col("__r") > since) & F.col("__p").isNotNull()
    )
    day = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Taipei"), F.col("__p")).cast("date")
    starts = touched.groupBy("stock_id").agg(F.min(day).alias("start"))
    return prices.select(*SERIES).distinct().join(starts, "stock_id")


def warm_up_start(changed: DataFrame, rows: DataFrame, days: int = 500, earlier: int = 240) -> DataFrame:
    """``read_from`` (G3): the earlier of start - ``days`` and the date of the ``earlier``-th row before start.

    The rows before start are counted from behind in one window per changed series."""
    before = rows.select(*SERIES, "trade_date").join(changed, list(SERIES)).where("trade_date < start")
    ranked = before.withColumn("__n", F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.desc("trade_date"))))
    first = ranked.where(F.col("__n") <= earlier).groupBy(*SERIES).agg(F.min("trade_date").alias("__d"))
    return changed.join(first, list(SERIES), "left").withColumn(
        "read_from", F.least(F.date_sub("start", days), F.col("__d"))
    ).drop("__d")


def streak_restarts(computed: DataFrame, changed: DataFrame, columns: Sequence[str], buffer: int) -> DataFrame:
    """Series whose first new row's streak spans the whole buffer, to be recounted from the start."""
    w = Window.partitionBy(*SERIES).orderBy("trade_date")
    first = computed.join(changed, list(SERIES)).where("trade_date >= start").withColumn(
        "__n", F.row_number().over(w)
    ).where("__n = 1")
    long = F.greatest(*[F.abs(f"{c}_streak_days") for c in columns]) >= buffer if len(columns) > 1 else F.abs(
        f"{columns[0]}_streak_days"
    ) >= buffer
    return first.where(long).select(*SERIES)


def replace_series(stored: DataFrame, fresh: DataFrame, changed: DataFrame, date: str = "trade_date") -> DataFrame:
    """Stored rows before each changed series' start, its fresh rows from there on, other series as they are."""
    joined = stored.join(changed.select(*SERIES, F.col("start").alias("__start")), list(SERIES), "left")
    keep = joined.where(F.col("__start").isNull() | (F.col(date) < F.col("__start"))).drop("__start")
    new = fresh.join(changed, list(SERIES)).where(F.col(date) >= F.col("start")).drop("start")
    return keep.unionByName(new.select(*stored.columns))


def incremental_run(
    stored: DataFrame,
    inputs: Mapping[str, DataFrame],
    rows: DataFrame,
    compute: Callable[[DataFrame], DataFrame],
    since: Column,
    computed_at: Column,
    full: bool = False,
) -> DataFrame:
    """One run (G5): changed series, computed over their rows with warm-up, replace what is stored. ``full`` computes
    everything anew."""
    if full:
        return compute(rows).withColumn("computed_at", computed_at)
    changed = warm_up_start(changed_series(inputs, since), rows)
    read = rows.join(
        changed.select(*SERIES, "read_from"), list(SERIES)
    ).where("trade_date >= read_from").drop("read_from")
    fresh = compute(read).withColumn("computed_at", computed_at)
    return replace_series(stored, fresh, changed.select(*SERIES, "start"))


def within_tolerance(metric: str, a: Column, b: Column, scale: Column) -> Column:
    """Windowed metrics are equal; MACD within 1e-5 of the close; K, D and RSI within 1e-6; nulls match nulls."""
    gap = F.abs(strict_difference(a, b))
    if metric.startswith("macd"):
        near = gap <= scale * 1e-5
    elif metric in ("k", "d", "rsi6", "rsi12"):
        near = gap <= 1e-6
    else:
        near = a == b
    return F.coalesce(near, F.lit(False)) | (a.isNull() & b.isNull())


def coverage_mismatches(stored: DataFrame, inputs: DataFrame, subset: bool = False) -> DataFrame:
    """Per series, dates stored without input and input dates not stored (G8); with ``subset`` the latter are
    allowed."""
    a = stored.select(*SERIES, "trade_date").distinct().withColumn("__s", F.lit(1))
    b = inputs.select(*SERIES, "trade_date").distinct().withColumn("__i", F.lit(1))
    counts = a.join(b, [*SERIES, "trade_date"], "full").groupBy(*SERIES).agg(
        F.count_if(F.col("__i").isNull()).alias("stored_only"), F.count_if(F.col("__s").isNull()).alias("input_only")
    )
    return counts.where(F.col("stored_only") > 0) if subset else counts.where(
        (F.col("stored_only") > 0) | (F.col("input_only") > 0)
    )


def largest_residues(incremental: DataFrame, full: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Per metric the largest difference of two computations and where it is (G9), and how many rows differ.

    Rows are joined once, whole, not once a metric."""
    key = [*SERIES, "trade_date"]
    a = incremental.select(*key, *[F.col(m).alias(f"__a_{m}") for m in metrics])
    b = full.select(*key, *[F.col(m).alias(f"__b_{m}") for m in metrics])
    joined = a.join(b, key, "full")
    found = []
    for m in metrics:
        x, y = F.col(f"__a_{m}"), F.col(f"__b_{m}")
        gap = F.coalesce(
            F.abs(x - y), F.when(x.isNull() & y.isNull(), 0.0).otherwise(F.lit(float("inf")))
        )
        last = F.max(F.struct(gap.alias("residue"), *key))
        found.append(F.struct(F.lit(m).alias("metric"), last.alias("last"), F.count_if(gap > 0).alias("differ")))
    one = joined.agg(F.array(*found).alias("x"), F.count("*").alias("__n")).where("__n > 0")
    return one.select(F.inline("x")).select(
        "metric", F.col("last.residue").alias("residue"), F.struct(*[F.col(f"last.{c}") for c in key]).alias("at"), "differ"
    )


def compare_series(stored: DataFrame, on_demand: DataFrame, bars: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Stored against on-demand values per metric: exact and within-tolerance counts (G10). The scale is the last
    close carried forward."""
    w = Window.partitionBy(*SERIES).orderBy("trade_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scale = bars.select(*SERIES, "trade_date", F.last("close", True).over(w).cast("double").alias("scale"))
    a = stored.select(*SERIES, "trade_date", *[F.col(m).alias(f"__a_{m}") for m in metrics])
    joined = on_demand.select(*SERIES, "trade_date", *metrics).join(a, [*SERIES, "trade_date"]).join(
        scale, [*SERIES, "trade_date"]
    )
    per = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"__a_{m}").eqNullSafe(F.col(m)).alias("exact"),
            within_tolerance(m, F.col(f"__a_{m}"), F.col(m), F.col("scale")).alias("near"),
        )
        for m in metrics
    ]
    return joined.select(F.explode(F.array(*per)).alias("x")).groupBy("x.metric").agg(
        F.count("*").alias("rows"), F.count_if("x.exact").alias("exact"), F.count_if("x.near").alias("within_tolerance")
    )
