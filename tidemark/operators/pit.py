"""Point-in-time visibility: when a recorded row became public, and what an instant may see.

``available_at`` of a row depends on all rows of its key, so it is computed before any cutoff on
``recorded_at`` is applied; filters on key columns may come first or last (they are pushed below the
window). Ties of ``recorded_at`` within a key don't occur in an append-only table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rule = Callable[[Column], Column]

#: Columns and types that an aggregate changes in place.
FEW = 12
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def latest_per_key(df: DataFrame, keys: Sequence[str], by: str = "recorded_at") -> DataFrame:
    """The row with the newest ``by`` of every key.

    An aggregate, not a window: rows are combined before the shuffle, so a key with very many versions
    moves one row per task. Few columns of fixed width are kept one by one, in a hash map; others as a struct, in a sort.
    """
    rest = [c for c in df.columns if c not in keys and c != by]
    if len(rest) <= FEW and all(isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in (by, *rest)):
        newest = df.groupBy(*keys).agg(F.max(by).alias(by), *[F.max_by(c, by).alias(c) for c in rest])
        return newest.select(*df.columns)
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(by, *rest), F.col(by)).alias("__row"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def with_available_at(df: DataFrame, keys: Sequence[str], period: str, rule: Rule) -> DataFrame:
    """Rule family (E5): rows recorded before their release instant, and the first one at or after it,
    are public at the release instant; later ones are corrections, public when recorded. The rule is worked out once a row."""
    released = F.col("__released")
    settled = F.min(F.when(F.col("recorded_at") >= released, F.col("recorded_at"))).over(Window.partitionBy(*keys))
    correction = (F.col("recorded_at") >= released) & (F.col("recorded_at") > settled)
    judged = df.withColumn("__released", rule(F.col(period))).withColumn(
        "available_at", F.when(correction, F.col("recorded_at")).otherwise(released)
    )
    return judged.drop("__released")


def with_published_at(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Published family (E6): a key's first row is public at its stored ``published_at`` (null: never), later rows
    when recorded."""
    first = F.min("recorded_at").over(Window.partitionBy(*keys))
    return df.withColumn(
        "available_at", F.when(F.col("recorded_at") == first, F.col("published_at")).otherwise(F.col("recorded_at"))
    )


def market_pit(
    available: DataFrame,
    keys: Sequence[str],
    information_as_of: Column,
    knowledge_as_of: Column,
    hidden: str | None = None,
) -> DataFrame:
    """What the market could see at ``information_as_of``, from rows recorded by ``knowledge_as_of``.

    ``available`` carries ``available_at``. A key whose visible row is a retraction (column ``hidden``) vanishes; the
    retraction is dropped after the latest row is chosen, so no older version resurfaces (E9).
    """
    eligible = available.where((F.col("available_at") <= information_as_of) & (F.col("recorded_at") <= knowledge_as_of))
    visible = latest_per_key(eligible, keys)
    return visible.where(~F.col(hidden)) if hidden else visible


def system_pit(df: DataFrame, keys: Sequence[str], system_as_of: Column, hidden: str | None = None) -> DataFrame:
    """What the store itself held at ``system_as_of``."""
    visible = latest_per_key(df.where(F.col("recorded_at") <= system_as_of), keys)
    return visible.where(~F.col(hidden)) if hidden else visible


def late_keys(available: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row and the latest row's ``available_at``."""
    stats = available.groupBy(*keys).agg(
        F.count("*").alias("n"), F.max_by("available_at", "recorded_at").alias("late_at")
    )
    return stats.where("n > 1").drop("n")


def late_reports(reports: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reports with several versions: (first publication day in Taipei, last version's ``recorded_at``)."""
    stats = reports.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.min_by("published_at", "recorded_at").alias("p"),
        F.max("recorded_at").alias("late_at"),
    )
    day = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Taipei"), F.col("p")).cast("date")
    return stats.where("n > 1").select(*keys, day.alias("observed_on"), "late_at")


def derived_available_at(
    rows: DataFrame, late: DataFrame, series: Sequence[str], date: str, rule: Rule, scope: str = "history"
) -> DataFrame:
    """``available_at`` of derived rows (E13): their own release instant, or the latest late correction among
    inputs at or before their date (scope ``history``) or on their date (scope ``day``), whichever is later.

    ``late`` has the series columns, ``date`` and ``late_at``. History: rows and corrections are united and a
    running maximum is taken in one window per series.
    """
    own = rule(F.col(date))
    if scope == "day":
        day = late.groupBy(*series, date).agg(F.max("late_at").alias("late_at"))
        return rows.join(day, [*series, date], "left").withColumn(
            "available_at", F.greatest(own, F.col("late_at"))
        ).drop("late_at")
    cols = rows.columns
    marked = rows.select(*cols, F.lit(None).cast("timestamp_ntz").alias("late_at"), F.lit(1).alias("__row"))
    events = late.select(
        *[F.col(c) if c in (*series, date) else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in cols],
        "late_at",
        F.lit(0).alias("__row"),
    )
    w = Window.partitionBy(*series).orderBy(date, "__row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = marked.unionByName(events).withColumn("late_at", F.max("late_at").over(w))
    return running.where("__row = 1").withColumn(
        "available_at", F.greatest(own, F.col("late_at"))
    ).drop("late_at", "__row")


def derived_history(
    available: DataFrame, keys: Sequence[str], series: Sequence[str], date: str, rule: Rule
) -> DataFrame:
    """Keys of ``available`` with the ``available_at`` of rows derived from the history up to their date.

    For datasets whose rows are the keys of their one input: keys, their late corrections and the running maximum come
    from one pass over the versions."""
    per_key = available.groupBy(*keys).agg(
        F.count("*").alias("__n"), F.max_by("available_at", "recorded_at").alias("__late")
    )
    w = Window.partitionBy(*series).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    late = F.max(F.when(F.col("__n") > 1, F.col("__late"))).over(w)
    return per_key.select(*keys, F.greatest(rule(F.col(date)), late).alias("available_at"))


def rolling_segments(available: DataFrame, series: Sequence[str], date: str, rule: Rule) -> DataFrame:
    """Dates of each series cut where a correction of an earlier date became public between two dates' own
    release instants (E16): (series, date, segment).

    Inside a segment one pass over the history visible at its last date's instant serves all its dates. A
    correction public at instant A cuts at the first date whose release instant is at or after A, if that date's
    predecessor is not before the corrected date.
    """
    dates = available.select(*series, date).distinct()
    w = Window.partitionBy(*series).orderBy(date)
    axis = dates.withColumn("__at", rule(F.col(date)))
    events = available.where(F.col("available_at") > rule(F.col(date))).select(
        *series, F.col(date).alias("__of"), F.col("available_at").alias("__at")
    ).distinct()
    both = axis.select(
        *series, F.col(date).alias("__day"), F.lit(None).cast("date").alias("__of"), "__at", F.lit(1).alias("__kind")
    )
    both = both.unionByName(
        events.select(*series, F.lit(None).cast("date").alias("__day"), "__of", "__at", F.lit(0).alias("__kind"))
    )
    ordered = Window.partitionBy(*series).orderBy("__at", "__kind")
    placed = both.withColumn("__prev", F.last("__day", True).over(ordered.rowsBetween(Window.unboundedPreceding, -1)))
    cut = placed.withColumn("__cut", (F.col("__kind") == 0) & (F.col("__of") <= F.col("__prev")))
    block = cut.withColumn("__block", F.count("__day").over(ordered.rowsBetween(Window.unboundedPreceding, -1)))
    cuts = block.groupBy(*series, "__block").agg(
        F.max("__day").alias(date), F.coalesce(F.max("__cut"), F.lit(False)).alias("__cut")
    ).where(F.col(date).isNotNull())
    first = F.row_number().over(w) == 1
    return cuts.withColumn("__starts", (first | F.col("__cut")).cast("int")).withColumn(
        "segment", F.sum("__starts").over(w)
    ).select(
        *series, date, "segment"
    )


def _within_reach(
    available: DataFrame, segments: DataFrame, series: Sequence[str], date: str, rule: Rule, lookback: int
) -> DataFrame:
    """The latest version visible at a segment's last instant of every date of the segment and of the ``lookback`` - 1
    dates before it: the columns of ``available`` and ``segment``.

    A date's versions travel as one row, so versions meet their segment in one join and those before a segment's first
    date come from the window's frame."""
    rest = [c for c in available.columns if c not in (*series, date, "recorded_at")]
    version = F.struct("recorded_at", *rest)
    days = available.groupBy(*series, date).agg(F.collect_list(version).alias("__v")).join(segments, [*series, date])
    along, inside = Window.partitionBy(*series).orderBy(date), Window.partitionBy(*series, "segment")
    day = F.array(F.struct(F.col(date), "__v"))
    if lookback > 1:
        before = F.collect_list(F.struct(F.col(date), "__v")).over(along.rowsBetween(1 - lookback, -1))
        first = F.coalesce(F.lag("segment").over(along) != F.col("segment"), F.lit(True))
        days = days.withColumn("__days", F.when(first, F.concat(before, day)).otherwise(day))
    else:
        days = days.withColumn("__days", day)
    placed = days.withColumn("__cutoff", rule(F.max(date).over(inside))).select(
        *series, "segment", "__cutoff", F.explode("__days").alias("__d")
    )
    seen = F.array_max(F.filter("__d.__v", lambda v: v["available_at"] <= F.col("__cutoff")))
    found = placed.select(*series, "segment", F.col(f"__d.{date}").alias(date), seen.alias("__row")).where("__row is not null")
    here = {c: F.col(c) for c in (*series, date)}
    return found.select(*[here.get(c, F.col(f"__row.{c}").alias(c)) for c in available.columns], "segment")


def rolling_as_of(
    available: DataFrame,
    series: Sequence[str],
    date: str,
    rule: Rule,
    compute: Callable[[DataFrame, list[str]], DataFrame],
    lookback: int | None = None,
) -> DataFrame:
    """Each date's metrics as the market saw them at that date's own release instant.

    Versions are joined with the segments (equal series, available by the segment's last instant, date not after its
    last date), the latest per date is kept, and ``compute(rows, series + ["segment"])`` runs once per segment.
    Metrics that reach back a fixed number of dates name it as ``lookback``: a segment then sees its own dates and those
    within reach before its first, instead of all earlier ones of the series.
    """
    segments = rolling_segments(available, series, date, rule)
    if lookback:
        near = _within_reach(available, segments, series, date, rule, lookback)
        return compute(near, [*series, "segment"]).join(
            segments, [*series, "segment", date], "left_semi"
        ).drop("segment")
    spans = segments.groupBy(*series, "segment").agg(F.max(date).alias("__last")).withColumn(
        "__cutoff", rule(F.col("__last"))
    )
    seen = available.join(spans, list(series)).where(
        (F.col("available_at") <= F.col("__cutoff")) & (F.col(date) <= F.col("__last"))
    )
    visible = latest_per_key(seen.drop("__last", "__cutoff"), [*series, "segment", date])
    return compute(visible, [*series, "segment"]).join(
        segments, [*series, "segment", date], "left_semi"
    ).drop("segment")


def with_lineage(df: DataFrame, series: Sequence[str], date: str) -> DataFrame:
    """``input_count`` and ``input_fingerprint`` (E18): SHA-256 over ``date@recorded`` of all rows up to a date,
    comma-joined.

    Instants are written to the microsecond, without a fraction where there is none. One digest runs along each
    series, so a row costs the same however long the series before it; rows keep their columns on the way, so there is one
    exchange, by the series.
    """
    keys = [*series, date]
    micros = F.date_format("recorded_at", "SSSSSS")
    fraction = F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise("")
    seconds = F.date_format("recorded_at", "yyyy-MM-dd'T'HH:mm:ss")
    item = F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit("@"), seconds, fraction, F.lit("+00:00"))
    rows = df.select(*keys, *[c for c in df.columns if c not in keys], item.alias("__item"))
    found = T.StructType(
        [f for f in rows.schema.fields if f.name != "__item"]
        + [T.StructField("input_count", T.LongType()), T.StructField("input_fingerprint", T.StringType())]
    )

    def along(group: pa.Table) -> pa.Table:
        group = group.sort_by(date)
        digest, prints = hashlib.sha256(), []
        for i, text in enumerate(group["__item"].to_pylist()):
            digest.update(f"{',' if i else ''}{text}".encode())
            prints.append(digest.hexdigest())
        counts = pa.array(range(1, len(group) + 1), pa.int64())
        out = group.drop_columns(["__item"]).append_column("input_count", counts)
        return out.append_column("input_fingerprint", pa.array(prints, pa.string()))

    return rows.groupBy(*series).applyInArrow(along, found)


def single_source(df: DataFrame, stocks: DataFrame | None = None, several: str = "refuse") -> DataFrame:
    """The rows of stocks with exactly one source (E19); with ``stocks``, one without any rows fails the job.

    Sources of a stock are never joined: one with several is refused by name, or left out where the caller says
    ``several="drop"``.
    """
    if several not in ("refuse", "drop"):
        raise ValueError(f"several is refuse or drop, not {several}")
    per_stock = df.groupBy("stock_id").agg(F.min("source").alias("a"), F.max("source").alias("z"))
    if stocks is not None:
        unknown = stocks.join(per_stock, "stock_id", "left_anti").limit(1).collect()
        if unknown:
            raise ValueError(f"unknown stock {unknown[0].stock_id}")
    if several == "refuse":
        many = per_stock.where("a <> z").limit(1).collect()
        if many:
            raise ValueError(f"stock {many[0].stock_id} has several sources, {many[0].a} and {many[0].z}; choose one")
    return df.join(per_stock.where("a = z").select("stock_id"), "stock_id", "left_semi")


def report_facts(
    versions: DataFrame,
    facts: DataFrame,
    statements: Sequence[str] | None = None,
    accounts: Sequence[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Each report version's own facts, ordered (E12). With ``limit`` one more row is returned, by which an overflow
    shows."""
    if statements:
        facts = facts.where(F.col("statement").isin(list(statements)))
    if accounts:
        facts = facts.where(F.col("account_code").isin(list(accounts)))
    joined = facts.join(
        versions.select(F.col("id").alias("report_id"), "stock_id", "report_year", "report_quarter"), "report_id"
    )
    order = [
        "stock_id", "report_year", "report_quarter", "report_id", "statement", "account_code", "concept", "period_end"
    ]
    return joined.orderBy(*order).limit(limit + 1) if limit is not None else joined


#: Probes of an audit: they stand in the plan.
MAX_PROBES = 1_000


def probe_instants(probes: DataFrame) -> list:
    """The distinct instants of ``probes`` in order, ``MAX_PROBES`` at most."""
    at = [r[0] for r in probes.select("probe").distinct().orderBy("probe").limit(MAX_PROBES + 1).collect()]
    if len(at) > MAX_PROBES:
        raise ValueError(f"more than {MAX_PROBES} probes; audit them in parts")
    return at


def probes_before(at: list, instant: Column) -> Column:
    """How many of the probes ``at`` are before an instant, all of them if it is null: a binary search in halving steps."""
    instants = F.array(*[F.lit(p) for p in at])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(at).bit_length()))])

    def halve(place: Column, step: Column) -> Column:
        return F.when(F.try_element_at(instants, place + step) < instant, place + step).otherwise(place)

    place = F.aggregate(steps, F.lit(0), halve)
    return F.coalesce(F.when(instant.isNull(), len(at)).otherwise(place), F.lit(len(at)))


def interval_counts(intervals: DataFrame, probes: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """(probe, a column for each kind): how many ``intervals`` (kind, since, until; half-open, null until: for ever) hold
    each probe. An interval is two steps at probes; their running sums are the counts, so nothing is multiplied."""
    at = probe_instants(probes)
    if not at:
        return probes.select("probe", *[F.lit(0).cast("bigint").alias(k) for k in kinds])
    placed = intervals.select(
        "kind", probes_before(at, F.col("since")).alias("a"), probes_before(at, F.col("until")).alias("z")
    ).where("a < z")
    ends = F.array(
        F.struct(F.col("a").alias("i"), F.lit(1).alias("v")), F.struct(F.col("z").alias("i"), F.lit(-1).alias("v"))
    )
    steps = placed.select("kind", F.explode(ends).alias("e")).groupBy("e.i").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("e.v"))).alias(k) for k in kinds]
    )
    instants = F.array(*[F.lit(p) for p in at])
    axis = probes.sparkSession.range(len(at)).select(
        F.col("id").cast("int").alias("i"), F.element_at(instants, F.col("id").cast("int") + 1).alias("probe")
    )
    run = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = axis.join(steps, "i", "left").select(
        "probe", *[F.coalesce(F.sum(k).over(run), F.lit(0)).alias(k) for k in kinds]
    )
    return probes.join(counted, "probe")


def look_ahead_audit(
    available: DataFrame, keys: Sequence[str], probes: DataFrame, visible_from: Column | None = None
) -> DataFrame:
    """(probe, leaked, visible) at every probe instant (E22): visible rows of the probe, and those that became public
    after it.

    ``visible_from`` is the read under test: the instant from which it shows a row (by default the later of available_at
    and recorded_at, as ``market_pit`` does). A row is shown until a later recorded row of its key is, so every row
    is an interval; its first and last probe are counted, and running sums of the counts give all probes. Rows are
    compared with their key's alone and nothing is multiplied by the number of probes (``MAX_PROBES`` at most).
    """
    at = probe_instants(probes)
    if not at:
        return probes.select("probe", F.lit(0).cast("bigint").alias("leaked"), F.lit(0).cast("bigint").alias("visible"))
    seen = F.greatest("available_at", "recorded_at") if visible_from is None else visible_from
    later = Window.partitionBy(*keys).orderBy("recorded_at").rowsBetween(1, Window.unboundedFollowing)
    shown = available.select(*keys, "recorded_at", "available_at", seen.alias("__from")).where("__from is not null")
    shown = shown.withColumn("__until", F.min("__from").over(later))
    instants = F.array(*[F.lit(p) for p in at])
    before = lambda instant: probes_before(at, F.col(instant))
    placed = shown.select(before("__from").alias("a"), before("__until").alias("z"), before("available_at").alias("p"))
    ends = F.array(
        F.struct(F.col("a").alias("i"), F.lit(1).alias("v"), F.lit(0).alias("n")),
        F.struct(F.col("z").alias("i"), F.lit(-1).alias("v"), F.lit(0).alias("n")),
        F.struct(
            F.col("a").alias("i"),
            F.lit(0).alias("v"),
            F.when(F.col("a") < F.least("z", "p"), 1).otherwise(0).alias("n"),
        ),
        F.struct(
            F.least("z", "p").alias("i"),
            F.lit(0).alias("v"),
            F.when(F.col("a") < F.least("z", "p"), -1).otherwise(0).alias("n"),
        ),
    )
    steps = placed.where("a < z").select(F.explode(ends).alias("e")).groupBy("e.i").agg(
        F.sum("e.v").alias("v"), F.sum("e.n").alias("n")
    )
    axis = probes.sparkSession.range(len(at)).select(
        F.col("id").cast("int").alias("i"), F.element_at(instants, F.col("id").cast("int") + 1).alias("probe")
    )
    run = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = axis.join(steps, "i", "left").select(
        "probe",
        F.coalesce(F.sum("n").over(run), F.lit(0)).alias("leaked"),
        F.coalesce(F.sum("v").over(run), F.lit(0)).alias("visible"),
    )
    return probes.join(counted, "probe")
