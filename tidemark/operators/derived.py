"""Stored derived datasets: what each reads, how far back, and one incremental run of it.

A run finds the series whose inputs were recorded after the last run, reads as much of their history as the
dataset needs, computes, and returns the rows of the touched series only; series without changes are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import metrics, valuation
from tidemark.operators.incremental import SERIES, report_changes, warm_up_start
from tidemark.operators.pit import latest_per_key
from tidemark.operators.sizes import clustered
from tidemark.sources.tables import in_files

#: How far back a run reads: the changed days alone, a buffer before them, or whole series.
DAY, BUFFER, WHOLE = "day", "buffer", "whole"


@dataclass(frozen=True)
class Input:
    """An input: its date column, whether its changes restart series, the series source of its own sources (others stand
    for themselves), and whether a derived row reads its day or its history up to it."""

    date: str = "trade_date"
    restarts: bool = True
    sources: Mapping[str, str] = field(default_factory=dict)
    scope: str = "history"

    def in_series(self, rows: DataFrame) -> DataFrame:
        """Rows with the source of the series that they belong to."""
        if not self.sources:
            return rows
        pairs = F.create_map(*[F.lit(x) for pair in self.sources.items() for x in pair])
        return rows.withColumn("source", F.coalesce(pairs[F.col("source")], F.col("source")))


@dataclass(frozen=True)
class Derived:
    """``compute`` gets the latest rows of every input, by name, with the sources of the series.

    The first input is the axis. ``restart``: columns of run lengths; a series whose first new row has one that spans
    all rows read is computed from its start. ``more_changes`` (inputs, since) gives further (series, start)."""

    name: str
    inputs: Mapping[str, Input]
    compute: Callable[[Mapping[str, DataFrame]], DataFrame]
    reach: str = BUFFER
    restart: tuple[str, ...] = ()
    more_changes: Callable[[Mapping[str, DataFrame], Column], DataFrame] | None = None
    date: str = "trade_date"

    @property
    def depends(self) -> tuple[str, ...]:
        return tuple(self.inputs)


def _streaks(parties: tuple[str, ...]) -> Callable[[Mapping[str, DataFrame]], DataFrame]:
    def compute(inputs: Mapping[str, DataFrame]) -> DataFrame:
        traded = inputs["daily_prices"].where("volume > 0").select(*SERIES, "trade_date")
        given = inputs["institutional_flows"].select(*SERIES, "trade_date", *parties)
        rows = metrics.beside(traded, given, [*SERIES, "trade_date"])
        return metrics.streaks(rows, parties).select(*SERIES, "trade_date", *[f"{p}_streak_days" for p in parties])

    return compute


def _cumulative(parties: tuple[str, ...]) -> Callable[[Mapping[str, DataFrame]], DataFrame]:
    def compute(inputs: Mapping[str, DataFrame]) -> DataFrame:
        held = inputs["foreign_holdings"].select(*SERIES, "trade_date", "issued_shares")
        rows = inputs["institutional_flows"].select(*SERIES, "trade_date", *parties)
        rows = metrics.beside(rows, held, [*SERIES, "trade_date"])
        for p in parties:
            rows = metrics.cumulative_flow(rows, p, out=f"{p}_cumulative_net")
            rows = rows.withColumn(
                f"{p}_cumulative_ratio", metrics.flow_ratio(F.col(f"{p}_cumulative_net"), F.col("issued_shares"))
            )
        return rows.select(*SERIES, "trade_date", *[f"{p}_cumulative_{x}" for p in parties for x in ("net", "ratio")])

    return compute


def _valuations(inputs: Mapping[str, DataFrame]) -> DataFrame:
    quarters = valuation.quarter_values(
        valuation.report_inputs(inputs["financial_reports"], inputs["financial_report_facts"])
    )
    quarters = in_files(quarters, "quarters")
    days = inputs["daily_prices"].where("volume > 0").select(*SERIES, "trade_date", "close")
    return valuation.valuation_metrics(days, quarters)


def _report_changes(inputs: Mapping[str, DataFrame], since: Column) -> DataFrame:
    return report_changes(inputs["financial_reports"], inputs["daily_prices"], since)


def derived_datasets(
    price_source: Mapping[str, str], holding_source: Mapping[str, str], parties: tuple[str, ...] = ("net",)
) -> dict[str, Derived]:
    """The seven derived datasets. ``price_source`` and ``holding_source`` name a flow source's price and holding
    source."""
    flow_of_price = {price: flow for flow, price in price_source.items()}
    flow_of_holding = {holding: flow for flow, holding in holding_source.items()}
    prices, snapshots = Input(), Input(date="snapshot_date")
    found = [
        Derived("technical_indicators", {"daily_prices": prices}, lambda x: metrics.technical_panel(x["daily_prices"])),
        Derived(
            "institutional_streaks",
            {"daily_prices": Input(sources=flow_of_price), "institutional_flows": Input()},
            _streaks(parties),
            restart=tuple(f"{p}_streak_days" for p in parties),
        ),
        Derived(
            "institutional_cumulative_flow",
            {"institutional_flows": Input(), "foreign_holdings": Input(sources=flow_of_holding, scope="day")},
            _cumulative(parties),
            WHOLE,
        ),
        Derived(
            "shareholding_concentration",
            {"shareholding_distributions": snapshots},
            lambda x: metrics.concentration(x["shareholding_distributions"]),
            WHOLE,
            date="snapshot_date",
        ),
        Derived(
            "margin_metrics",
            {"margin_trading": Input(scope="day")},
            lambda x: metrics.margin_metrics(x["margin_trading"]),
            DAY,
        ),
        Derived(
            "short_interest_metrics",
            {"securities_lending": Input(scope="day")},
            lambda x: metrics.short_interest_metrics(x["securities_lending"]),
            DAY,
        ),
        Derived(
            "valuation_metrics",
            {
                "daily_prices": prices,
                "financial_reports": Input(restarts=False),
                "financial_report_facts": Input(restarts=False),
            },
            _valuations,
            WHOLE,
            more_changes=_report_changes,
        ),
    ]
    return {d.name: d for d in found}


def changes(dataset: Derived, inputs: Mapping[str, DataFrame], since: Column) -> DataFrame:
    """(stock_id, source, start): per series the earliest date of an input recorded after ``since``."""
    found = []
    for name, i in dataset.inputs.items():
        if i.restarts:
            late = i.in_series(inputs[name].where(F.col("recorded_at") > since))
            found.append(late.groupBy(*SERIES).agg(F.min(i.date).alias("start")))
    if dataset.more_changes:
        found.append(dataset.more_changes(inputs, since).select(*SERIES, "start"))
    return reduce(DataFrame.unionByName, found).groupBy(*SERIES).agg(F.min("start").alias("start"))


def latest_inputs(
    dataset: Derived,
    inputs: Mapping[str, DataFrame],
    keys: Mapping[str, tuple[str, ...]],
    series: DataFrame | None = None,
    rows: int = 0,
) -> dict[str, DataFrame]:
    """The latest row of every key of every input (``keys`` by input; none: rows are as they should be), in the
    series' sources.

    With ``series`` (stock_id, source, read_from; null: whole) only these series, from that date on; a key has its series
    and date, so versions are left out before they are shuffled. All inputs are dealt by series in the same way, for
    ``rows`` rows, and nothing that a series' metrics need is shuffled again."""
    out = {}
    for name, i in dataset.inputs.items():
        found, key = inputs[name], list(keys.get(name) or ())
        if not i.restarts:
            out[name] = latest_per_key(found, key) if key else found
            continue
        if i.sources:
            found, key = i.in_series(found.withColumn("__own", F.col("source"))), key and [*key, "__own"]
        if series is not None:
            near = found.join(series.select(*SERIES, "read_from"), list(SERIES))
            found = near.where(F.col("read_from").isNull() | (F.col(i.date) >= F.col("read_from"))).drop("read_from")
        found = clustered(found, SERIES, rows)
        out[name] = (latest_per_key(found, key) if key else found).drop("__own")
    return out


def run(
    dataset: Derived,
    inputs: Mapping[str, DataFrame],
    stored: DataFrame | None,
    since: Column | None,
    computed_at: Column,
    keys: Mapping[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """The rows of the touched series after one run: what is stored before a series' first change, and fresh rows from
    there on.

    ``inputs`` hold all versions recorded so far (``recorded_at``), ``keys`` what identifies a row in each. Without
    ``stored`` or ``since`` everything is computed. Inputs are counted first and read several times, so they should lie in
    files. The result is what a sink replaces series by series
    (``sources.tables.overwrite_series``); ``merged`` adds the other series.
    """
    keys = keys or {}
    size = sum(inputs[name].count() for name, i in dataset.inputs.items() if i.restarts)
    if stored is None or since is None:
        return dataset.compute(latest_inputs(dataset, inputs, keys, rows=size)).withColumn("computed_at", computed_at)
    changed = in_files(changes(dataset, inputs, since), "changed")
    if dataset.reach == BUFFER:
        name, axis = next(iter(dataset.inputs.items()))
        own = [*SERIES, F.col(dataset.date).alias("trade_date")]
        dates = clustered(axis.in_series(inputs[name]).select(*own).join(changed, list(SERIES), "left_semi"), SERIES, size)
        changed = in_files(warm_up_start(changed, dates.distinct()), "changed")
    else:
        changed = changed.withColumn("read_from", F.col("start") if dataset.reach == DAY else F.lit(None).cast("date"))

    fresh = dataset.compute(latest_inputs(dataset, inputs, keys, changed, size))
    if dataset.restart:
        fresh = in_files(fresh, "fresh")
        day, late = F.col(dataset.date), F.col(dataset.date) >= F.col("start")
        first = fresh.join(changed.select(*SERIES, "start"), list(SERIES)).groupBy(*SERIES).agg(
            (F.count_if(~late) + 1).alias("__n"),
            *[F.min_by(F.when(late, F.col(c)), F.when(late, day)).alias(c) for c in dataset.restart],
        )
        spans = reduce(lambda a, b: a | b, [F.abs(c) == F.col("__n") for c in dataset.restart])
        again = in_files(first.where(spans).select(*SERIES), "again")
        whole = again.withColumn("read_from", F.lit(None).cast("date"))
        fresh = fresh.join(again, list(SERIES), "left_anti").unionByName(
            dataset.compute(latest_inputs(dataset, inputs, keys, whole, size))
        )
    begun = changed.select(*SERIES, F.col("start").alias("__start"))
    keep = stored.join(begun, list(SERIES)).where(F.col(dataset.date) < F.col("__start")).drop("__start")
    new = fresh.withColumn("computed_at", computed_at).join(begun, list(SERIES))
    new = new.where(F.col(dataset.date) >= F.col("__start")).select(*stored.columns)
    return keep.unionByName(new)


def merged(stored: DataFrame, touched: DataFrame) -> DataFrame:
    """The whole table after a run: its touched series beside the others as they were. The list of touched series is
    written first, so that Spark knows its size and, while it is short, doesn't shuffle the stored rows."""
    rest = stored.join(in_files(touched.select(*SERIES).distinct(), "touched"), list(SERIES), "left_anti")
    return rest.unionByName(touched.select(*stored.columns))
