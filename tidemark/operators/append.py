"""Append-on-change ingestion, coverage and fetch-log operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.pit import latest_per_key


def _differs(values: Sequence[str], old: str = "__old") -> Column:
    out = F.lit(False)
    for v in values:
        out = out | ~F.col(v).eqNullSafe(F.col(f"{old}.{v}"))
    return out


def with_latest(incoming: DataFrame, stored: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Incoming rows beside the stored latest: ``__old`` (values), ``is_new`` and ``is_changed``. Of stored rows that
    were recorded at one latest instant that with the smallest values counts, so the judgement doesn't depend on the
    order that tasks end in."""
    age = (F.lit("9999-12-31").cast("timestamp_ntz") - F.col("recorded_at")).alias("__age")
    newest = F.min(F.when(F.col("recorded_at").isNotNull(), F.struct(age, *values))).alias("__row")
    old = stored.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(newest)
    old = old.select(*[f"__{k}" for k in keys], F.struct(*[F.col(f"__row.{v}").alias(v) for v in values]).alias("__old"))
    same = [incoming[k].eqNullSafe(F.col(f"__{k}")) for k in keys]
    joined = incoming.join(old, same, "left").drop(*[f"__{k}" for k in keys])
    return joined.withColumn("is_new", F.col("__old").isNull()).withColumn(
        "is_changed", F.col("__old").isNull() | _differs(values)
    )


def append_changed(incoming: DataFrame, stored: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is new or whose values differ from the key's latest row (D2): A, B, A appends three."""
    return with_latest(incoming, stored, keys, values).where("is_changed").drop("__old", "is_new", "is_changed")


def append_versions(incoming: DataFrame, stored: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Incoming versions whose values differ from the version before them (D2): that of their key in ``incoming`` by
    recorded_at, for its first one the key's stored latest; a key without one is new.

    A key may have any number of versions in ``incoming``; 1, 2, 1 appends three. What is appended doesn't depend on how
    versions are cut into batches, as long as those of a key come in the order of recorded_at. Versions of one instant are
    ordered by their values. One window over the keys that come; the stored ones are reduced to these and to their latest
    first.
    """
    came = incoming.select(*keys).distinct()
    known = stored.select(*keys, "recorded_at", *values)
    same = [known[k].eqNullSafe(came[k]) for k in keys]
    seed = latest_per_key(known.join(came, same, "left_semi"), keys)
    rows = incoming.withColumn("__own", F.lit(True)).unionByName(
        seed.withColumn("__own", F.lit(False)), allowMissingColumns=True
    )
    w = Window.partitionBy(*keys).orderBy("__own", "recorded_at", *values)
    before = F.lag(F.struct(*values)).over(w)
    judged = rows.withColumn("__old", before)
    return judged.where(F.col("__own") & (F.col("__old").isNull() | _differs(values))).drop("__own", "__old")


def stamp_published(changed: DataFrame, purpose: str, published: str = "published_at") -> DataFrame:
    """``published_at`` stays on a key's first row and only for a first capture (D3); needs ``is_new``."""
    keep = F.col("is_new") & F.lit(purpose == "first_capture")
    return changed.withColumn(published, F.when(keep, F.col(published)))


def in_universe(rows: DataFrame, spans: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """(rows of stocks listed on their date, count of the others)."""
    s = spans.select(F.col("stock_id").alias("__s"), "listed_on", "delisted_on")
    inside = (rows.stock_id == F.col("__s")) & (F.col("listed_on").isNull() | (rows[date] >= F.col("listed_on"))) & (
        F.col("delisted_on").isNull() | (rows[date] < F.col("delisted_on"))
    )
    return rows.join(s, inside, "left_semi"), rows.join(s, inside, "left_anti").agg(F.count("*").alias("out_of_scope"))


def ingest_counters(
    incoming: DataFrame, stored: DataFrame, keys: Sequence[str], values: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """parsed, appended, new_keys and unchanged rows, per ``by`` if given (D5). Flag columns out_of_scope,
    unverified and rejected are counted where present and such rows are not appended."""
    flags = [c for c in ("out_of_scope", "unverified", "rejected") if c in incoming.columns]
    dropped = F.lit(False)
    for f in flags:
        dropped = dropped | F.col(f)
    judged = with_latest(incoming, stored, keys, values)
    counts = [
        F.count("*").alias("parsed"),
        F.count_if(F.col("is_changed") & ~dropped).alias("appended"),
        F.count_if(F.col("is_new") & ~dropped).alias("new_keys"),
    ]
    return judged.groupBy(*by).agg(
        *counts,
        F.count_if(~F.col("is_changed") & ~dropped).alias("unchanged"),
        *[F.count_if(F.col(f)).alias(f) for f in flags],
    )


def retractions(
    listed: DataFrame, stored: DataFrame, keys: Sequence[str], start: Column, end: Column, date: str
) -> DataFrame:
    """Tombstones (D6): stored, not retracted events in the executed range that are no longer listed."""
    live = latest_per_key(stored, keys).where(~F.col("retracted") & F.col(date).between(start, end))
    return live.join(listed.select(*keys).distinct(), list(keys), "left_anti").withColumn("retracted", F.lit(True))


def executed(rows: DataFrame, date: str, through: Column) -> DataFrame:
    """Rows dated through the executed day."""
    return rows.where(F.col(date) <= through)


def executed_counts(rows: DataFrame, date: str, through: Column) -> DataFrame:
    """How many rows are kept and how many are future-dated."""
    return rows.agg(F.count_if(F.col(date) <= through).alias("kept"), F.count_if(F.col(date) > through).alias("future"))


def needs_detail(
    listed: DataFrame, stored: DataFrame, keys: Sequence[str], published: Sequence[str], correction_check: bool = False
) -> DataFrame:
    """Listed rows whose detail must be fetched (D8): new, or differing from the stored row on its published columns."""
    judged = with_latest(listed, stored, keys, published)
    return (judged if correction_check else judged.where("is_changed")).drop("__old", "is_new", "is_changed")


def complete_with_detail(listed: DataFrame, detail: DataFrame, locator: str, identity: str) -> DataFrame:
    """List rows joined with their detail; ``violation`` where it is missing or names another identity."""
    d = detail.select(
        F.col(locator),
        F.col(identity).alias("__identity"),
        *[c for c in detail.columns if c not in (locator, identity)],
    )
    joined = listed.join(d, locator, "left")
    violation = F.when(F.col("__identity").isNull(), "detail_missing").when(
        F.col("__identity") != F.col(identity), "identity_mismatch"
    )
    return joined.withColumn("violation", violation).drop("__identity")


def fact_fingerprints(facts: DataFrame, report: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """SHA-256 of each report's fact set (D10): one canonical line per fact, sorted, numbers without trailing zeros."""
    def text(c: str) -> Column:
        kind = dict(facts.dtypes)[c]
        value = F.col(c).cast("string")
        if kind.startswith("decimal"):
            value = F.regexp_replace(F.regexp_replace(value, r"(\.\d*?)0+$", "$1"), r"\.$", "")
        return F.coalesce(value, F.lit("\\N"))

    line = F.concat_ws("|", *[text(c) for c in columns])
    return facts.groupBy(*report).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("fingerprint"),
        F.count("*").alias("facts"),
    )


def new_report_versions(incoming: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming reports (keys, category, fingerprint) whose category or fact set differs from the latest version
    (D10)."""
    return append_changed(incoming, stored, keys, ["report_category", "fingerprint"])


def category_fallback(reports: DataFrame, keys: Sequence[str], preference: Sequence[str] = ("C", "A")) -> DataFrame:
    """Of the documents of a key, that of the most preferred category."""
    rank = F.array_position(F.array(*[F.lit(p) for p in preference]), F.col("category"))
    return latest_per_key(reports.where(rank > 0).withColumn("__rank", -rank), keys, "__rank").drop("__rank")


def latest_fetch(fetches: DataFrame) -> DataFrame:
    """The last fetch of every resource, by time and then attempt."""
    return latest_per_key(
        fetches.withColumn("__by", F.struct("fetched_at", "attempt")), ["dataset", "source", "resource_key"], "__by"
    ).drop("__by")


def pending(
    expected: DataFrame, fetches: DataFrame, held_back: Sequence[str] = (), final: Sequence[str] = ()
) -> DataFrame:
    """Expected resources (dataset, source, resource_key, settled_at) that are not done.

    Done: the latest fetch succeeded, bears no held-back reason and is not before the settled instant; or it was
    quarantined for a reason that will not change (``final``, D14).
    """
    latest = latest_fetch(fetches).select("dataset", "source", "resource_key", "status", "reason_code", "fetched_at")
    key = ["dataset", "source", "resource_key"]
    joined = expected.join(latest, key, "left")
    reason = F.coalesce(F.col("reason_code"), F.lit(""))
    done = (F.col("status") == "succeeded") & ~reason.isin(list(held_back)) & (
        F.col("fetched_at") >= F.col("settled_at")
    )
    done = done | ((F.col("status") == "quarantined") & reason.isin(list(final)))
    return joined.where(~F.coalesce(done, F.lit(False))).select(*expected.columns)


def pending_any(
    expected: DataFrame,
    fetches: DataFrame,
    ids: Sequence[str],
    held_back: Sequence[str] = (),
    final: Sequence[str] = (),
) -> DataFrame:
    """Expected items that no one of their alternative resource ids (columns ``ids``) has done."""
    done = None
    for column in ids:
        one = expected.withColumn("resource_key", F.col(column))
        open_ = pending(one, fetches, held_back, final)
        closed = one.join(open_.select(*ids), list(ids), "left_anti").select(*ids)
        done = closed if done is None else done.unionByName(closed)
    return expected.join(done.distinct(), list(ids), "left_anti")


def expected_days(calendar: DataFrame, start: Column, end: Column) -> DataFrame:
    """Trading days in a range."""
    return calendar.where(F.col("trade_date").between(start, end)).select(F.col("trade_date").alias("period"))


def expected_months(calendar: DataFrame, start: Column, end: Column) -> DataFrame:
    """Months with a trading day in a range."""
    return calendar.where(F.col("trade_date").between(start, end)).select(
        F.trunc("trade_date", "month").alias("period")
    ).distinct()


def expected_quarters(spark, start: str, end: str) -> DataFrame:
    """(report_year, report_quarter) of quarters that end in a range."""
    day = spark.sql(f"select explode(sequence(trunc(date'{start}', 'quarter'), date'{end}', interval 3 months)) as q")
    last = F.last_day(F.add_months("q", 2))
    return day.where(last.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(
        F.year("q").alias("report_year"), F.quarter("q").alias("report_quarter")
    )


#: Periods of a grid: they stand in the plan.
MAX_PERIODS = 5_000


def expected_grid(stocks: DataFrame, periods: DataFrame) -> DataFrame:
    """Every stock with every period (D16): each stock's row carries the periods as one array and is exploded, so
    no join is needed. Periods are a calendar's; more than ``MAX_PERIODS`` are refused."""
    if periods.limit(MAX_PERIODS + 1).count() > MAX_PERIODS:
        raise ValueError(f"more than {MAX_PERIODS} periods")
    held = periods.agg(F.array_sort(F.collect_list(F.struct(*periods.columns))).alias("__p")).first()
    if not held or not held["__p"]:
        return stocks.limit(0)
    literal = F.array(
        *[
            F.struct(*[F.lit(p[c]).cast(periods.schema[c].dataType).alias(c) for c in periods.columns])
            for p in held["__p"]
        ]
    )
    return stocks.select("*", F.explode(literal).alias("__q")).select(
        *stocks.columns, *[F.col(f"__q.{c}").alias(c) for c in periods.columns]
    )


#: What a fetch may end as.
STATUSES = ("succeeded", "empty", "failed", "quarantined")


def run_report(fetches: DataFrame, job: Sequence[str] = ("dataset",)) -> DataFrame:
    """Fetches per job and status, and whether any failed or came empty."""
    counts = fetches.groupBy(*job).agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    return counts.withColumn("needs_attention", (F.col("failed") + F.col("empty")) > 0)


def sweeps_done(expected: DataFrame, fetches: DataFrame, sweep: Sequence[str]) -> DataFrame:
    """Sweeps every expected page of which was last fetched with success."""
    latest = latest_fetch(fetches).select("dataset", "source", "resource_key", "status")
    joined = expected.join(latest, ["dataset", "source", "resource_key"], "left")
    return joined.groupBy(*sweep).agg(
        F.every(F.coalesce(F.col("status") == "succeeded", F.lit(False))).alias("done"), F.count("*").alias("pages")
    )


def reconciliation_dates(calendar: DataFrame, effective: DataFrame) -> DataFrame:
    """First and last calendar day, and for each effective date the trading day before it and the first at or after it
    (D19).

    Days and effective dates are merged in one ordered window; calendars are small.
    """
    days = calendar.select(F.col("trade_date").alias("d"), F.lit(1).alias("is_day"))
    marks = effective.select(F.col("effective_date").alias("d"), F.lit(0).alias("is_day")).distinct()
    both = days.unionByName(marks)
    w = Window.partitionBy(F.lit(0)).orderBy("d", "is_day")
    before = F.max(F.when(F.col("is_day") == 1, F.col("d"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("is_day") == 1, F.col("d"))).over(w.rowsBetween(1, Window.unboundedFollowing))
    around = both.select("is_day", before.alias("b"), after.alias("a")).where("is_day = 0")
    ends = calendar.agg(F.min("trade_date").alias("b"), F.max("trade_date").alias("a"))
    return around.select("b", "a").unionByName(ends).select(F.explode(F.array("b", "a")).alias("trade_date")).where(
        "trade_date is not null"
    ).distinct()


def provenance(rows: DataFrame, fetches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(fetch_id, sha256 in hex) of every fetch named in any of the columns."""
    ids = rows.select(F.explode(F.array(*columns)).alias("id")).where("id is not null").distinct()
    return ids.join(
        fetches.select("id", F.lower(F.hex("sha256")).alias("sha256")), "id"
    ).withColumnRenamed("id", "fetch_id")


def latest_payload_listing(payloads: DataFrame, spans: DataFrame) -> DataFrame:
    """For each span, the last file that lists its stock inside it, from every key's latest stored payload.

    ``payloads`` has (source, trade_date, fetched_at, stock_ids array); spans are half-open.
    """
    latest = latest_per_key(payloads, ["source", "trade_date"], "fetched_at")
    listed = latest.select("source", "trade_date", F.explode("stock_ids").alias("__stock"))
    inside = (spans.stock_id == F.col("__stock")) & (F.col("trade_date") >= F.col("listed_on")) & (
        F.col("delisted_on").isNull() | (F.col("trade_date") < F.col("delisted_on"))
    )
    return spans.join(listed, inside, "left").groupBy(*spans.columns).agg(F.max("trade_date").alias("last_listed"))
