"""Validation and quarantine: predicates with reason codes.

A check adds a ``violation`` column (the first reason that applies, else null) or returns the offending
rows; ``split`` separates accepted from rejected rows, ``quarantine_files`` a whole file with any bad row.

Fixed values: the reason texts that the checks give stand beside their conditions, in the order they are tried.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sizes import small


def first_reason(*rules: tuple[Column, str]) -> Column:
    """The reason of the first rule whose condition holds."""
    return F.coalesce(*[F.when(F.coalesce(condition, F.lit(False)), reason) for condition, reason in rules])


def split(df: DataFrame, violation: str = "violation") -> tuple[DataFrame, DataFrame]:
    """(accepted rows without the reason, rejected rows with it)."""
    return df.where(F.col(violation).isNull()).drop(violation), df.where(F.col(violation).isNotNull())


def quarantine_files(df: DataFrame, file: Sequence[str], violation: str = "violation") -> DataFrame:
    """The files with a bad row and their first reason; joined back by ``left_anti`` they vanish whole."""
    return df.where(F.col(violation).isNotNull()).groupBy(*file).agg(
        F.min(violation).alias("reason_code"), F.count("*").alias("bad_rows")
    )


def file_gate(files: DataFrame) -> DataFrame:
    """``status`` and ``reason_code`` of each file (C1): columns stat, asked_date, answered_date, unit, known_unit,
    declared_rows and actual_rows."""
    reason = first_reason(
        (F.col("stat").isNull() | ~F.col("stat").isin("OK", "no_data"), "bad_status"),
        (F.col("stat") == "no_data", "no_data"),
        (F.col("answered_date") != F.col("asked_date"), "date_mismatch"),
        (F.col("unit") != F.col("known_unit"), "unit_changed"),
        (F.col("declared_rows") != F.col("actual_rows"), "row_count_mismatch"),
    )
    return route_outcomes(files.withColumn("reason_code", reason))


#: Reasons worth a retry, and reasons that mean an empty day.
RETRYABLE, EMPTY = ("bad_status", "timeout"), ("no_data",)


def route_outcomes(files: DataFrame, retryable: Sequence[str] = RETRYABLE, empty: Sequence[str] = EMPTY) -> DataFrame:
    """Reason code to status (C2): failed, empty or quarantined; none is succeeded."""
    r = F.col("reason_code")
    return files.withColumn(
        "status",
        F.when(r.isNull(), "succeeded").when(
            r.isin(list(retryable)), "failed"
        ).when(r.isin(list(empty)), "empty").otherwise("quarantined"),
    )


def duplicate_keys(df: DataFrame, file: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Files that hold a key twice (C3), with the number of such keys."""
    return df.groupBy(*file, *keys).agg(F.count("*").alias("n")).where("n > 1").groupBy(*file).agg(
        F.count("*").alias("duplicate_keys")
    )


def ohlc_violation(open_: str = "open", high: str = "high", low: str = "low", close: str = "close") -> Column:
    """C4: no negative price, high at least low, open and close between them."""
    o, h, lo, c = F.col(open_), F.col(high), F.col(low), F.col(close)
    return first_reason(
        (F.least(o, h, lo, c) < 0, "negative_price"),
        (h < lo, "high_below_low"),
        ((o < lo) | (o > h), "open_outside"),
        ((c < lo) | (c > h), "close_outside"),
    )


def sign_violation(columns: Sequence[str], signed: Sequence[str] = ()) -> Column:
    """No negative value outside the signed columns, at least one value present."""
    negative = F.lit(False)
    for c in columns:
        if c not in signed:
            negative = negative | F.coalesce(F.col(c) < 0, F.lit(False))
    return first_reason((F.coalesce(*columns).isNull(), "no_value"), (negative, "negative_value"))


def ratio_violation(bounded: Sequence[str], unbounded: Sequence[str] = ()) -> Column:
    """Declared ratios lie in 0..100, utilisation is only non-negative."""
    return first_reason(
        *[((F.col(c) < 0) | (F.col(c) > 100), f"{c}_out_of_bounds") for c in bounded],
        *[(F.col(c) < 0, f"{c}_negative") for c in unbounded],
    )


def valuation_violation() -> Column:
    """Ratios are positive, yields not negative, something is published."""
    return first_reason(
        (F.coalesce("pe_ratio", "pb_ratio", "dividend_yield").isNull(), "nothing_published"),
        ((F.col("pe_ratio") <= 0) | (F.col("pb_ratio") <= 0), "ratio_not_positive"),
        (F.col("dividend_yield") < 0, "negative_yield"),
    )


def reject_summary(rejected: DataFrame, by: Sequence[str], item: str, most: int = 20) -> DataFrame:
    """Rejected rows per group: their number and the first ``most`` items, comma-joined."""
    w = Window.partitionBy(*by).orderBy(item)
    first = rejected.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most)
    listed = first.groupBy(*by).agg(
        F.array_join(F.array_sort(F.collect_list(F.col(item).cast("string"))), ",").alias("items")
    )
    return rejected.groupBy(*by).agg(F.count("*").alias("rejected")).join(listed, list(by))


def action_term_violation() -> Column:
    """Terms agree with the event type. Columns: event_type, cash, shares, rights_ratio, subscription_price,
    cash_return, halt_from, locator_date, resume_on, old_shares, new_shares."""
    t = F.col("event_type")
    has = lambda c: F.col(c).isNotNull() & (F.col(c) != 0)
    return first_reason(
        (t.isin("dividend", "dividend_and_rights") & ~has("cash"), "cash_missing"),
        (t.isin("rights", "dividend_and_rights") & ~has("shares") & ~has("rights_ratio"), "shares_missing"),
        (has("rights_ratio") != has("subscription_price"), "rights_without_price"),
        ((t == "refund") & ~has("cash_return"), "refund_without_cash"),
        ((t == "cash_increase") & ~has("rights_ratio"), "increase_without_rights"),
        ((F.col("halt_from") < F.col("locator_date")) | (F.col("halt_from") > F.col("resume_on")), "halt_outside"),
        (
            (t == "par_change")
            & (~has("old_shares") | ~has("new_shares") | (F.col("old_shares") == F.col("new_shares"))),
            "par_unchanged",
        ),
    )


def action_invariant_violation() -> Column:
    """Announcement <= ex <= record <= payment, shares come in pairs, a split has more and a merge fewer shares."""
    return first_reason(
        (F.col("announced_on") > F.col("ex_date"), "announced_after_ex"),
        (F.col("ex_date") > F.col("record_date"), "ex_after_record"),
        (F.col("record_date") > F.col("payment_date"), "record_after_payment"),
        (F.col("old_shares").isNull() != F.col("new_shares").isNull(), "share_pair"),
        ((F.col("event_type") == "split") & (F.col("new_shares") <= F.col("old_shares")), "split_direction"),
        ((F.col("event_type") == "reverse_split") & (F.col("new_shares") >= F.col("old_shares")), "split_direction"),
    )


def ambiguous_events(df: DataFrame) -> DataFrame:
    """Rows whose (code, locator) or (code, date) is not unique."""
    marked = df.withColumn("__l", F.count("*").over(Window.partitionBy("stock_id", "locator"))).withColumn(
        "__d", F.count("*").over(Window.partitionBy("stock_id", "ex_date"))
    )
    return marked.where("__l > 1 or __d > 1").withColumn(
        "violation", F.when(F.col("__l") > 1, "locator_repeats").otherwise("date_repeats")
    ).drop("__l", "__d")


def level_completeness(
    levels: DataFrame, key: Sequence[str], position: str | None = None, last: int = 17, file: Sequence[str] = ()
) -> DataFrame:
    """C11: per security the missing and unknown levels, negative holdings and shares above 100 percent. With a
    ``position`` also ``truncated``, of every security of a file (``file``: columns among ``key``): the file's last
    security by position has a violation."""
    want = F.sequence(F.lit(1), F.lit(last))
    agg = [
        F.array_sort(F.collect_set("level")).alias("levels"),
        F.count_if((F.col("holders") < 0) | ((F.col("shares") < 0) & (F.col("level") != last - 1))).alias("__neg"),
        F.count_if(F.col("percent") > 100).alias("__over"),
    ]
    agg += [F.max(position).alias("__at")] if position else []
    per = levels.groupBy(*key).agg(*agg)
    reason = first_reason(
        (F.size(F.array_except("levels", want)) > 0, "unknown_level"),
        (F.size(F.array_except(want, F.col("levels"))) > 0, "missing_level"),
        (F.col("__neg") > 0, "negative_holding"),
        (F.col("__over") > 0, "over_hundred_percent"),
    )
    out = per.withColumn("violation", reason)
    if position:
        whole = Window.partitionBy(*file) if file else Window.partitionBy(F.lit(0))
        out = out.withColumn(
            "truncated", F.max_by(F.col("violation").isNotNull(), F.col("__at")).over(whole)
        ).drop("__at")
    return out.drop("__neg", "__over")


def precision_violation(digits: Mapping[str, tuple[int, int]], bigints: Sequence[str] = ()) -> Column:
    """A value must fit its (integer digits, places) without rounding, a whole number a bigint. Columns are wide
    decimals."""
    rules = []
    for c, (whole, places) in digits.items():
        rules += [
            (F.col(c) % F.lit(Decimal(1).scaleb(-places)) != 0, f"{c}_too_precise"),
            (F.abs(c) >= F.lit(Decimal(10**whole)), f"{c}_too_large"),
        ]
    for c in bigints:
        rules += [(not_whole(c), f"{c}_not_whole"), (F.abs(c) > F.lit(Decimal(2**63 - 1)), f"{c}_too_large")]
    return first_reason(*rules)


def not_whole(column: str) -> Column:
    """C13. Remainders and narrow bounds: beside a wider decimal, a comparison would round the column's own places."""
    return F.col(column) % F.lit(Decimal(1)) != 0


def cross_source_check(
    incoming: DataFrame, other_latest: DataFrame, keys: Sequence[str], value: str, file: Sequence[str]
) -> DataFrame:
    """C14: each row is verified (equal in the other source), held_back (absent there) or different; a file with a
    difference is quarantined whole (``file_quarantined``)."""
    other = other_latest.select(*keys, F.col(value).alias("__other"))
    joined = incoming.join(other, list(keys), "left")
    outcome = F.when(F.col("__other").isNull(), "held_back").when(
        F.col("__other").eqNullSafe(F.col(value)), "verified"
    ).otherwise("different")
    marked = joined.withColumn("outcome", outcome).drop("__other")
    bad = marked.where("outcome = 'different'").select(*file).distinct().withColumn("__bad", F.lit(True))
    return marked.join(bad, list(file), "left").withColumn(
        "file_quarantined", F.coalesce("__bad", F.lit(False))
    ).drop("__bad")


def sweep_violations(sweep: DataFrame, categories: DataFrame, managed: str | None = None) -> DataFrame:
    """Stocks in two categories of a day's sweep, and rows of a category not in effect on the day; the managed
    bucket is split off."""
    rows = sweep.where(F.col("industry_code") != managed) if managed else sweep
    twice = rows.groupBy("trade_date", "stock_id").agg(
        F.countDistinct("industry_code").alias("n")
    ).where("n > 1").select(
        "trade_date", "stock_id", F.lit("two_categories").alias("violation")
    )
    c = categories.select(F.col("code").alias("industry_code"), "valid_from", "valid_to")
    valid = (rows.industry_code == c.industry_code) & (c.valid_from.isNull() | (rows.trade_date >= c.valid_from)) & (
        c.valid_to.isNull() | (rows.trade_date < c.valid_to)
    )
    stray = rows.join(c, valid, "left_anti").select(
        "trade_date", "stock_id", F.lit("category_not_in_effect").alias("violation")
    )
    return twice.unionByName(stray).distinct()


def notice_violations(changes: DataFrame, categories: DataFrame) -> DataFrame:
    """Reason per change of a notice (document_number, stock_id, effective_date, old_industry, new_industry)."""
    c = small(categories.select("code", "valid_from", "valid_to", F.lit(1).alias("__hit")))
    w = Window.partitionBy("document_number", "stock_id")

    def in_effect(rows: DataFrame, column: str, day: Column, out: str) -> DataFrame:
        hit = (F.col(column) == F.col("code")) & (F.col("valid_from").isNull() | (day >= F.col("valid_from"))) & (
            F.col("valid_to").isNull() | (day < F.col("valid_to"))
        )
        return rows.join(c, hit, "left").withColumn(out, F.col("__hit").isNotNull()).drop(
            "code", "valid_from", "valid_to", "__hit"
        )

    out = in_effect(
        in_effect(changes, "old_industry", F.date_sub("effective_date", 1), "__old"),
        "new_industry",
        F.col("effective_date"),
        "__new",
    )
    out = out.withColumn("__n", F.count("*").over(w))
    reason = first_reason(
        (F.col("__n") > 1, "duplicate_stock"),
        (F.col("old_industry") == F.col("new_industry"), "no_change"),
        (~F.col("__old"), "old_not_in_effect"),
        (~F.col("__new"), "new_not_in_effect"),
    )
    return out.withColumn("violation", reason).drop("__old", "__new", "__n")


def withdrawn_keys(stored: DataFrame, reread: DataFrame, document: str, keys: Sequence[str]) -> DataFrame:
    """C17: keys a document held that its re-read no longer lists (only documents that were re-read)."""
    again = reread.select(document).distinct()
    return stored.join(again, document, "left_semi").select(document, *keys).join(
        reread.select(document, *keys), [document, *keys], "left_anti"
    )


def conflicts(incoming: DataFrame, stored: DataFrame, document: str, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key another document holds."""
    held = stored.select(*keys, F.col(document).alias("held_by")).distinct()
    return incoming.join(held, list(keys)).where(F.col("held_by") != F.col(document))


def fact_violations(facts: DataFrame) -> DataFrame:
    """Documents with a repeated fact identity (null-safe), a dimensioned or a non-numeric fact."""
    key = ["report_id", "statement", "concept", "period_start", "period_end"]
    per = facts.groupBy(*key).agg(
        F.count("*").alias("n"),
        F.bool_or(F.col("dimensioned")).alias("dim"),
        F.bool_or(F.col("value").isNull()).alias("nan"),
    )
    doc = per.groupBy("report_id").agg(
        F.max(F.col("n") > 1).alias("dup"), F.bool_or("dim").alias("dim"), F.bool_or("nan").alias("nan")
    )
    return doc.withColumn(
        "violation",
        first_reason(
            (F.col("dup"), "duplicate_fact"), (F.col("dim"), "dimensioned_fact"), (F.col("nan"), "non_numeric_fact")
        ),
    ).select("report_id", "violation").where("violation is not null")


def require_known(df: DataFrame, column: str, known: Sequence[str]) -> DataFrame:
    """C20: the rows as they are; a value outside the known list fails the job."""
    stray = df.where(~F.col(column).isin(list(known)) | F.col(column).isNull()).select(column).limit(1).collect()
    if stray:
        raise ValueError(f"unknown {column} {stray[0][0]!r}")
    return df


def reason_tally(outcomes: DataFrame, by: Sequence[str] = ("dataset", "source", "status")) -> DataFrame:
    """Outcomes per group and reason."""
    return outcomes.groupBy(*by, "reason_code").agg(F.count("*").alias("n"))


def paged_answer(pages: DataFrame, unpaged: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per list, whether its paged rows reach the declared total and begin with the unpaged page's rows in order.

    Both have ``position`` (from 1); ``pages`` also ``declared_total``."""
    u = unpaged.select(*by, "position", F.struct(*columns).alias("__u"))
    joined = pages.join(u, [*by, "position"], "left")
    same = F.col("__u").isNull() | F.struct(*columns).eqNullSafe(F.col("__u"))
    return joined.groupBy(*by).agg(
        (F.count("*") == F.max("declared_total")).alias("complete"), F.bool_and(same).alias("same_order")
    )


def label_order(rows: DataFrame, by: Sequence[str], expected: Sequence[str]) -> DataFrame:
    """Whether each group's labels in order are exactly the expected ones. Groups are a table's label columns, a
    few rows."""
    got = F.transform(F.array_sort(F.collect_list(F.struct("position", "label"))), lambda x: x["label"])
    return rows.groupBy(*by).agg(got.alias("labels")).withColumn(
        "as_expected", F.col("labels") == F.array(*[F.lit(x) for x in expected])
    )


def code_set_difference(a: DataFrame, b: DataFrame, by: Sequence[str], code: str) -> DataFrame:
    """Codes that only one of two documents names, with the side."""
    left = a.select(*by, code).distinct()
    right = b.select(*by, code).distinct()
    return left.join(right, [*by, code], "left_anti").withColumn("side", F.lit("first")).unionByName(
        right.join(left, [*by, code], "left_anti").withColumn("side", F.lit("second"))
    )


def section_numbering(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Whether each section's row numbers are 1..declared."""
    ok = (F.count("*") == F.max("declared")) & (F.min("row_number") == 1) & (
        F.max("row_number") == F.max("declared")
    ) & (
        F.countDistinct("row_number") == F.count("*")
    )
    return rows.groupBy(*by).agg(ok.alias("numbered"))


#: The statements of a report.
STATEMENTS = ("balance_sheet", "cash_flow", "income_statement")


def report_gate(
    headers: DataFrame, rows: DataFrame, excluded_sectors: Sequence[str], markets: Sequence[str]
) -> DataFrame:
    """Reason per report. Headers: report_id, stock_id, asked_stock_id, category, asked_category, sector,
    market."""
    have = rows.groupBy("report_id").agg(
        F.collect_set("statement").alias("statements"), F.bool_or(F.col("account_code").isNull()).alias("uncoded")
    )
    joined = headers.join(have, "report_id", "left")
    missing = F.size(
        F.array_except(
            F.array(*[F.lit(s) for s in STATEMENTS]), F.coalesce("statements", F.array().cast("array<string>"))
        )
    ) > 0
    reason = first_reason(
        (F.col("stock_id") != F.col("asked_stock_id"), "identity_mismatch"),
        (F.col("sector").isin(list(excluded_sectors)), "financial_industry_issuer"),
        (~F.col("market").isin(list(markets)), "outside_universe"),
        (F.col("category") != F.col("asked_category"), "category_mismatch"),
        (missing, "statement_missing"),
        (F.col("uncoded"), "row_without_code"),
    )
    return joined.withColumn("violation", reason).drop("statements", "uncoded")
