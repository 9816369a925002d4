"""Reconciliation: key diff, metric compare, classification of every difference by rule order."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sizes import small

SERIES = ("stock_id", "source")


def merge_sides(sides: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Any number of tables on their keys (J1): value columns as ``<side>_<column>`` and a presence flag ``has_<side>``.

    Tables are united and grouped once, so one shuffle serves all sides. A key has one row per side."""
    types: dict[str, str] = {}
    for name, df in sides.items():
        types |= {f"{name}_{c}": t for c, t in df.dtypes if c not in keys}
    parts = [
        df.select(
            *keys,
            *[
                (
                    F.col(n.removeprefix(f"{name}_"))
                    if n.startswith(f"{name}_") and n.removeprefix(f"{name}_") in df.columns
                    else F.lit(None)
                ).cast(t).alias(n)
                for n, t in types.items()
            ],
            F.lit(name).alias("__side"),
        )
        for name, df in sides.items()
    ]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy(*keys).agg(
        *[F.max(n).alias(n) for n in types],
        *[F.bool_or(F.col("__side") == name).alias(f"has_{name}") for name in sides],
    )


def key_differences(merged: DataFrame) -> DataFrame:
    """``key_class`` (J3): both, or which side alone, explained where its input is alone too. Sides: ours, our_input,
    theirs, their_input."""
    kind = (
        F.when(F.col("has_ours") & F.col("has_theirs"), "both")
        .when(F.col("has_ours") & ~F.col("has_their_input"), "ours_only_input_missing_there")
        .when(F.col("has_ours"), "ours_only_unexplained")
        .when(F.col("has_theirs") & ~F.col("has_our_input"), "theirs_only_input_missing_here")
        .when(F.col("has_theirs"), "theirs_only_unexplained")
        .otherwise("inputs_only")
    )
    return merged.withColumn("key_class", kind)


def captured_another_date(
    ours: DataFrame, theirs: DataFrame, mapping: DataFrame, keys: Sequence[str], value: str, date: str = "trade_date"
) -> DataFrame:
    """Class of each common key (J4): equal, captured_another_date (theirs on D equals ours on the mapped date) or
    differ."""
    a = ours.select(*keys, date, F.col(value).alias("mine"))
    b = theirs.select(*keys, date, F.col(value).alias("their_value"))
    other = ours.select(*keys, F.col(date).alias("mapped_date"), F.col(value).alias("mine_there"))
    j = a.join(b, [*keys, date]).join(mapping.select(date, "mapped_date"), date, "left").join(
        other, [*keys, "mapped_date"], "left"
    )
    kind = F.when(F.col("mine").eqNullSafe(F.col("their_value")), "equal").when(
        F.col("mine_there").eqNullSafe(F.col("their_value")) & F.col("mapped_date").isNotNull(), "captured_another_date"
    ).otherwise("differ")
    return j.select(*keys, date, "mine", "their_value", kind.alias("diff_class"))


def top_counts(differences: DataFrame, by: Sequence[str], k: int = 20) -> DataFrame:
    """The k groups with the most differences."""
    return differences.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by).limit(k)


def samples(differences: DataFrame, kind: str, order: Sequence[str], k: int = 10) -> DataFrame:
    """The first k differences of every class.

    Each partition first keeps its own k per class, so a class with most of the rows sends k rows a task."""
    w = Window.partitionBy(kind).orderBy(*order)
    local = Window.partitionBy(kind, "__p").orderBy(*order)
    few = differences.withColumn(
        "__p", F.pmod(F.xxhash64(*order), F.lit(64))
    ).withColumn("__n", F.row_number().over(local)).where(F.col("__n") <= k)
    return few.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= k).drop("__n", "__p")


def cumulative_drift(
    merged: DataFrame,
    ours_net: str,
    theirs_net: str,
    ours_sum: str,
    theirs_sum: str,
    series: Sequence[str] = SERIES,
    date: str = "trade_date",
) -> DataFrame:
    """``drift`` (J7): the running difference of nets; a difference of sums equal to it is
    ``explained_by_net_drift``."""
    w = Window.partitionBy(*series).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    drift = F.sum(F.coalesce(F.col(ours_net), F.lit(0)) - F.coalesce(F.col(theirs_net), F.lit(0))).over(w)
    gap = F.col(ours_sum) - F.col(theirs_sum)
    kind = F.when(gap.isNull(), "one_sided").when(F.abs(gap) < 1e-9, "equal").when(
        F.abs(gap - F.col("drift")) < 1e-6, "explained_by_net_drift"
    ).otherwise("unexplained")
    return merged.withColumn("drift", drift).withColumn("diff_class", kind)


def ratio_classes(
    rows: DataFrame,
    known_dates: DataFrame,
    ours: str,
    theirs: str,
    issued: str,
    date: str = "trade_date",
    tolerance: float = 1e-4,
) -> DataFrame:
    """Ratio differences (J8): equal, on a listed date, without issued shares, else unexplained."""
    d = known_dates.select(date).distinct().withColumn("__k", F.lit(True))
    j = rows.join(d, date, "left")
    kind = F.when(
        F.col(ours).eqNullSafe(F.col(theirs)) | (F.abs(F.col(ours) - F.col(theirs)) <= tolerance), "equal"
    ).when(F.col("__k"), "known_date").when(F.col(issued).isNull(), "issued_shares_missing").otherwise("unexplained")
    return j.withColumn("diff_class", kind).drop("__k")


def streak_classes(
    axis: DataFrame,
    transfers: DataFrame,
    other_dates: DataFrame,
    series: Sequence[str] = SERIES,
    date: str = "trade_date",
) -> DataFrame:
    """Streak differences (J9) on the united axis: rows have ours_streak, theirs_streak, ours_sign, theirs_sign,
    in_ours, in_theirs.

    Classes, in the order they are tried: ``market_transfer`` (the stock is among ``transfers``), ``day_sets_differ``,
    ``captured_another_date`` (a day of the run on which signs differ is one of ``other_dates``, on which the other side is known
    to hold another day's file), ``net_sign_differs``, ``unexplained``. A difference reaches back max(|a|, |b|) + 1 rows. Instead of joining that run, the index of the last row where the
    axes (or signs) differ is carried forward; it lies in the run if it is at most the reach back.
    """
    w = Window.partitionBy(*series).orderBy(date)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    moved = small(transfers.select("stock_id").distinct().withColumn("__moved", F.lit(True)))
    another = small(other_dates.select(date).distinct().withColumn("__another", F.lit(True)))
    i = axis.join(moved, "stock_id", "left").join(another, date, "left").withColumn("__i", F.row_number().over(w))
    signs = F.coalesce("ours_sign", F.lit(0)) != F.coalesce("theirs_sign", F.lit(0))
    last = lambda met: F.max(F.when(met, F.col("__i"))).over(run)
    i = i.withColumns(
        {
            "__axis": last(F.col("in_ours") != F.col("in_theirs")),
            "__sign": last(signs),
            "__other": last(signs & F.col("__another")),
        }
    )
    low = F.col("__i") - F.greatest(F.abs("ours_streak"), F.abs("theirs_streak"))
    # The classes of differences, in the order they are tried.
    kind = F.when(F.col("__moved"), "market_transfer").when(F.col("__axis") >= low, "day_sets_differ").when(
        F.col("__other") >= low, "captured_another_date"
    ).when(F.col("__sign") >= low, "net_sign_differs").otherwise("unexplained")
    return i.where(
        F.col("in_ours") & F.col("in_theirs") & (F.col("ours_streak") != F.col("theirs_streak"))
    ).withColumn("diff_class", kind).drop("__i", "__axis", "__sign", "__other", "__moved", "__another")


#: Upper bounds of difference magnitudes and their names.
MAGNITUDES = ((1e-9, "at_float_noise"), (1e-6, "below_1e-6"), (1e-3, "below_1e-3"), (1.0, "below_1"))


def magnitude(gap: Column) -> Column:
    out = None
    for limit, name in MAGNITUDES:
        out = F.when(gap < limit, name) if out is None else out.when(gap < limit, name)
    return out.otherwise("at_or_above_1")


def indicator_classes(
    differences: DataFrame,
    axis: DataFrame,
    lengths: Mapping[str, int],
    transfers: DataFrame,
    series: Sequence[str] = SERIES,
    date: str = "trade_date",
) -> DataFrame:
    """Indicator differences (J10): market transfer first, then whether the metric's window touches a dropped or a
    frozen-volume day.

    ``differences`` has metric, ours, theirs; ``axis`` the series' days with flags dropped, volume_differs and frozen. The index
    of the last flagged day is carried forward once; a window of n days touches it if it is less than n days back (no
    length: ever before). A frozen day explains a volume average only if it is the one day on which the stock's volumes differ
    at all: with another such day the average may differ for that one's sake.
    """
    w = Window.partitionBy(*series).orderBy(date)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    differing = axis.where("volume_differs").groupBy("stock_id").agg(
        F.min(date).alias("__a"), F.max(date).alias("__z"), F.bool_and("frozen").alias("__frozen")
    )
    only = differing.where("__frozen and __a = __z").select("stock_id", F.lit(True).alias("__only"))
    i = axis.withColumn("__i", F.row_number().over(w)).select(*series, date, "__i", "dropped", "volume_differs")
    i = i.withColumn(
        "__d", F.max(F.when(F.col("dropped"), F.col("__i"))).over(run)
    ).withColumn("__f", F.max(F.when(F.col("volume_differs"), F.col("__i"))).over(run)).drop("dropped", "volume_differs")
    n = F.lit(None).cast("int")
    for metric, length in lengths.items():
        n = F.when(F.col("metric") == metric, length).otherwise(n)
    t = transfers.select("stock_id").distinct().withColumn("__t", F.lit(True))
    j = differences.join(i, [*series, date]).join(t, "stock_id", "left").join(only, "stock_id", "left")
    j = j.withColumn("__n", n)
    touches = lambda c: F.col(c).isNotNull() & (F.col("__n").isNull() | (F.col("__i") - F.col(c) < F.col("__n")))
    # The classes of differences, in the order they are tried.
    kind = F.when(F.col("__t"), "market_transfer").when(touches("__d"), "dropped_no_trade_days").when(
        F.startswith("metric", F.lit("vma")) & F.coalesce("__only", F.lit(False)) & touches("__f"), "frozen_volume"
    ).otherwise("unexplained")
    return j.withColumn("diff_class", kind).withColumn(
        "magnitude", magnitude(F.abs(F.col("ours") - F.col("theirs")))
    ).drop(
        "__i", "__d", "__f", "__n", "__t", "__only"
    )


def rebased_change(
    ours: DataFrame, theirs: DataFrame, value: str, series: Sequence[str] = SERIES, date: str = "snapshot_date"
) -> DataFrame:
    """Our change against the other side's previous snapshot (J11): ours now less ours on their previous date."""
    w = Window.partitionBy(*series).orderBy(date)
    their = theirs.select(
        *series,
        date,
        F.lag(date).over(w).alias("their_previous"),
        (F.col(value) - F.lag(value).over(w)).alias("their_change"),
    )
    mine = ours.select(
        *series, date, F.col(value).alias("mine"), (F.col(value) - F.lag(value).over(w)).alias("our_change")
    )
    then = ours.select(*series, F.col(date).alias("their_previous"), F.col(value).alias("mine_then"))
    j = mine.join(their, [*series, date]).join(then, [*series, "their_previous"], "left")
    return j.select(
        *series, date, "our_change", "their_change", (F.col("mine") - F.col("mine_then")).alias("rebased_change")
    )


def valuation_classes(
    ours: DataFrame, theirs: DataFrame, alternative: DataFrame, keys: Sequence[str], column: str = "ttm_eps"
) -> DataFrame:
    """Valuation differences (J12): equal, explained by alternative publication dates, a row missing on a side, else
    unexplained.

    ``alternative`` is our computation run again with the other side's publication dates."""
    v = lambda df, n: df.select(*keys, F.col(column).alias(n), F.lit(True).alias(f"__{n}"))
    j = v(ours, "mine").join(v(theirs, "their_value"), list(keys), "full").join(
        v(alternative, "alternative"), list(keys), "left"
    )
    kind = F.when(F.col("__their_value").isNull(), "ours_only").when(F.col("__mine").isNull(), "theirs_only").when(
        F.col("mine").eqNullSafe(F.col("their_value")), "equal"
    ).when(
        F.col("alternative").eqNullSafe(F.col("their_value")) & F.col("__alternative").isNotNull(), "publication_date"
    ).otherwise("unexplained")
    return j.select(*keys, "mine", "their_value", kind.alias("diff_class"))


class Sessions:
    """Trading days that any day, traded or not, is ranked among.

    The calendar (a row a day, at most ``MOST`` days) becomes one array literal with the number of trading days up to each
    calendar day, so a rank is an array lookup in the row: no join, no window over the calendar.
    """

    MOST = 200_000

    def __init__(self, calendar: DataFrame):
        known = calendar.select("trade_date").where("trade_date is not null").distinct()
        days = [r[0] for r in known.limit(self.MOST + 1).collect()]
        if len(days) > self.MOST:
            raise ValueError("a calendar has a row a day")
        self.first, numbers = min(days, default=None), sorted(d.toordinal() for d in days)
        ranks = [bisect_right(numbers, n) for n in range(numbers[0], numbers[-1] + 1)] if numbers else []
        self.total, self.ranks = len(numbers), F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<int>")

    def through(self, day: Column) -> Column:
        """Trading days up to ``day``, itself included."""
        if self.first is None:
            return F.when(day.isNotNull(), 0)
        at = F.date_diff(day, F.lit(self.first))
        found = F.get(self.ranks, F.greatest(at, F.lit(0)))
        return F.when(at < 0, 0).when(day.isNotNull(), F.coalesce(found, F.lit(self.total)))

    def before(self, day: Column) -> Column:
        """Trading days before ``day``."""
        return self.through(F.date_sub(day, 1))

    def between(self, after: Column, through: Column) -> Column:
        """Sessions after one day and up to another."""
        return self.through(through) - self.through(after)

    def nth(self, start: Column, day: Column) -> Column:
        """The how manieth trading day ``day`` is since ``start``, which need not be one."""
        return self.through(day) - self.before(start)


def beyond_limit(ratio: Column, sessions: Column, limit: float = 0.1) -> Column:
    """Whether a move exceeds what daily limits allow over the sessions."""
    return (ratio > F.pow(F.lit(1 + limit), sessions) + 1e-9) | (ratio < F.pow(F.lit(1 - limit), sessions) - 1e-9)


def event_limits(events: DataFrame, fetches: DataFrame, limits: DataFrame) -> DataFrame:
    """(series, ex_date, lowest, highest): the closes that the published limits of all events of a series' day allow.

    An event's limits stand in the payload its fetch stored: ``fetches`` (fetch_id, sha256) leads from one to the other,
    ``limits`` (sha256, stock_id, trade_date, limit_down, limit_up) holds what was read there. A day of which an event has
    no limits has none.
    """
    on = [events.stock_id == limits.stock_id, events.ex_date == limits.trade_date, fetches.sha256 == limits.sha256]
    found = events.join(fetches, "fetch_id", "left").join(limits, on, "left").select(
        *[events[c] for c in SERIES], events.ex_date, "limit_down", "limit_up"
    )
    days = found.groupBy(*SERIES, "ex_date").agg(
        F.max("limit_down").alias("lowest"),
        F.min("limit_up").alias("highest"),
        F.bool_and(F.col("limit_down").isNotNull() & F.col("limit_up").isNotNull()).alias("__all"),
    )
    return days.where("__all").drop("__all")


def classify_gaps(
    bars: DataFrame,
    events: DataFrame,
    sessions: Sessions,
    spans: DataFrame,
    markets: Mapping[str, str],
    start: Column,
    allowed: DataFrame,
    free_sessions: int = 5,
) -> DataFrame:
    """Moves beyond the daily limits and why (J15): (kind, series, previous_date, trade_date, sessions, previous_close,
    close, ratio, reason, detail).

    ``bars`` have close and adjusted_close; kinds are ``raw`` and ``adjusted``, each from one traded day to the next. A move
    of which a price is missing (or the first is zero) has the reason ``unknown``. Details: ``new_listing`` (one of the
    first sessions since a listing in the source's market), ``series_start`` (one since the series' first bar, if that is
    after ``start`` and no listing is as late), ``within_published_limits`` (adjusted moves at an event whose day's
    ``allowed`` closes, see ``event_limits``, hold the raw close), ``corporate_action`` (an event after the day before and
    up to the day). ``spans`` have stock_id, market and listed_on, ``markets`` the market of a source.

    Events and listings are found by carrying the last one forward in the series' window; no range join.
    """
    none = F.lit(None)
    values = [F.col("close").cast("double").alias("c"), F.col("adjusted_close").cast("double").alias("a")]
    no_values = [none.cast("double").alias("c"), none.cast("double").alias("a")]
    dates = lambda e, l: [e.cast("date").alias("e"), l.cast("date").alias("l")]
    rows = bars.select(*SERIES, "trade_date", *values, F.lit(2).alias("k"), *dates(none, none))
    day = F.col("ex_date")
    ev = events.select(*SERIES, day.alias("trade_date"), *no_values, F.lit(0).alias("k"), *dates(day, none))
    market = F.create_map(*[F.lit(x) for pair in markets.items() for x in pair])[F.col("source")]
    listed = F.col("listed_on")
    ls = bars.select(*SERIES).distinct().withColumn("market", market).join(
        spans.where("listed_on is not null").select("stock_id", "market", "listed_on"), ["stock_id", "market"]
    ).select(*SERIES, listed.alias("trade_date"), *no_values, F.lit(1).alias("k"), *dates(none, listed))
    o = Window.partitionBy(*SERIES).orderBy("trade_date", "k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.unionByName(ev).unionByName(ls).select(
        *SERIES, "trade_date", "c", "a", "k",
        F.max("e").over(o).alias("event"),
        F.max("l").over(o).alias("listed"),
        F.min(F.when(F.col("k") == 2, F.col("trade_date"))).over(o).alias("first"),
    ).where("k = 2 and c is not null")
    w = Window.partitionBy(*SERIES).orderBy("trade_date")
    pairs = placed.select(
        "*", *[F.lag(c).over(w).alias(f"p_{c}") for c in ("trade_date", "c", "a")]
    ).where("p_trade_date is not null")
    moves = F.array(
        F.struct(F.lit("raw").alias("kind"), F.col("p_c").alias("previous_close"), F.col("c").alias("close")),
        F.struct(F.lit("adjusted").alias("kind"), F.col("p_a").alias("previous_close"), F.col("a").alias("close")),
    )
    kinds = pairs.withColumn("sessions", sessions.between(F.col("p_trade_date"), F.col("trade_date"))).select(
        "*", F.explode(moves).alias("m")
    ).select("*", "m.*").withColumn(
        "ratio", F.when(F.col("previous_close") != 0, F.col("close") / F.col("previous_close"))
    )
    beyond = kinds.where(F.col("ratio").isNull() | beyond_limit(F.col("ratio"), F.col("sessions")))
    soon = lambda since: sessions.nth(F.col(since), F.col("trade_date")) <= free_sessions
    listing = F.when(F.coalesce(soon("listed"), F.lit(False)), "new_listing").when(
        (F.col("first") > start) & soon("first") & ~F.coalesce(F.col("listed") >= F.col("first"), F.lit(False)),
        "series_start",
    )
    g = beyond.select(
        "kind", *SERIES, F.col("p_trade_date").alias("previous_date"), "trade_date", "sessions", "previous_close", "close",
        "ratio", "c", listing.alias("listing"),
        F.coalesce(F.col("event") > F.col("p_trade_date"), F.lit(False)).alias("has_event"),
    )
    g = g.join(allowed.withColumnRenamed("ex_date", "trade_date"), [*SERIES, "trade_date"], "left")
    held = (F.col("kind") == "adjusted") & F.col("has_event") & F.coalesce(
        F.col("c").between(F.col("lowest"), F.col("highest")), F.lit(False)
    )
    detail = F.coalesce("listing", F.when(held, "within_published_limits"))
    # The reasons of gaps, in the order they are tried.
    reason = F.when(F.col("ratio").isNull(), "unknown").when(
        detail.isNotNull(), "explained_by_other_documented_market_event"
    ).when(F.col("has_event"), "explained_by_corporate_action").otherwise("unexplained_anomaly")
    shown = F.when(F.col("ratio").isNotNull(), F.coalesce(detail, F.when(F.col("has_event"), "corporate_action")))
    return g.select(
        "kind", *SERIES, "previous_date", "trade_date", "sessions", "previous_close", "close", "ratio",
        reason.alias("reason"), shown.alias("detail"),
    )


def event_continuity(events: DataFrame, bars: DataFrame) -> DataFrame:
    """Whether each event's close_before is the last traded close before its ex-date (J16); as-of by carrying the
    close forward."""
    none = F.lit(None)
    rows = bars.select(
        *SERIES,
        F.col("trade_date").alias("d"),
        F.col("close").cast("double").alias("c"),
        F.lit(1).alias("k"),
        none.cast("double").alias("close_before"),
    )
    marks = events.select(
        *SERIES,
        F.col("ex_date").alias("d"),
        none.cast("double").alias("c"),
        F.lit(0).alias("k"),
        F.col("close_before").cast("double").alias("close_before"),
    )
    w = Window.partitionBy(*SERIES).orderBy("d", "k").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.unionByName(marks).withColumn("previous_close", F.last("c", True).over(w)).where("k = 0")
    return placed.select(
        *SERIES,
        F.col("d").alias("ex_date"),
        "close_before",
        "previous_close",
        F.col("close_before").eqNullSafe(F.col("previous_close")).alias("continuous"),
    )


def table_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two tables holds, with repeats."""
    cols = a.columns
    return a.exceptAll(b.select(*cols)).withColumn("side", F.lit("first")).unionByName(
        b.select(*cols).exceptAll(a).withColumn("side", F.lit("second"))
    )


def version_changes(rows: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Each appended version beside its predecessor, changed columns only (J18): ``changes`` maps a column to "old ->
    new"."""
    w = Window.partitionBy(*keys).orderBy("recorded_at")
    old = rows.withColumn("__old", F.lag(F.struct(*values)).over(w)).where("__old is not null")
    cells = F.map_from_arrays(
        F.array(*[F.lit(v) for v in values]),
        F.array(
            *[
                F.when(
                    ~F.col(v).eqNullSafe(F.col(f"__old.{v}")),
                    F.concat(
                        F.coalesce(F.col(f"__old.{v}").cast("string"), F.lit("null")),
                        F.lit(" -> "),
                        F.coalesce(F.col(v).cast("string"), F.lit("null")),
                    ),
                )
                for v in values
            ]
        ),
    )
    return old.select(*keys, "recorded_at", F.map_filter(cells, lambda _, x: x.isNotNull()).alias("changes"))
