"""Column functions that read published text values and normalise units, labels and periods.

Parsers return null for what they cannot read; ``*_violation`` columns or a struct's ``bad`` field tell an
unreadable value from a missing one.
"""

from __future__ import annotations

import html as html_module
import html.entities
import re
from collections.abc import Iterable, Iterator, Mapping
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Years between the ROC and the Gregorian calendar.
ROC_OFFSET = 1911
#: Texts that stand for a missing number.
MISSING = ("", "-", "--", "---", "N/A", "NA", "null")


def roc_date(text: Column) -> Column:
    """A ROC date in any published notation as a date; null if it is none.

    Notations: ``113/01/02``, ``113.01.02``, ``113-01-02``, ``1130102`` and the one with year, month and day signs.
    """
    compact = F.regexp_replace(F.trim(text), r"\s+", "")
    marked = F.regexp_replace(compact, "^(\\d{2,3})年(\\d{1,2})月(\\d{1,2})日$", "$1/$2/$3")
    packed = F.regexp_replace(marked, r"^(\d{2,3})(\d{2})(\d{2})$", "$1/$2/$3")
    even = F.regexp_replace(packed, r"^(\d{2,3})[./-](\d{1,2})[./-](\d{1,2})$", "$1-$2-$3")
    year = F.regexp_extract(even, r"^(\d{2,3})-\d{1,2}-\d{1,2}$", 1)
    rest = F.regexp_extract(even, r"^\d{2,3}(-\d{1,2}-\d{1,2})$", 1)
    return F.when(
        year != "",
        F.try_to_timestamp(
            F.concat((year.try_cast("int") + ROC_OFFSET).cast("string"), rest), F.lit("yyyy-M-d")
        ).cast("date"),
    )


def number(text: Column, scale: int = 6, missing: Iterable[str] = MISSING) -> Column:
    """(value, bad): tags and thousands separators removed; missing markers are null, other texts bad."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(text, "<[^>]*>", ""), ",", ""))
    value = F.when(~bare.isin(list(missing)), bare).try_cast(f"decimal(38,{scale})")
    return F.struct(value.alias("value"), (text.isNotNull() & ~bare.isin(list(missing)) & value.isNull()).alias("bad"))


def signed_change(sign: Column, magnitude: Column) -> Column:
    """(change, direction, bad) of a sign marker and a magnitude.

    ``X``: no comparison, the change is null. A blank sign needs a zero magnitude: ``flat``. ``+`` and ``-`` as they
    say.
    """
    mark = F.upper(F.trim(F.coalesce(sign, F.lit(""))))
    change = F.when(mark == "-", -magnitude).when(mark == "+", magnitude).when(
        (mark == "") & (magnitude == 0), magnitude
    )
    direction = F.when(mark.isin("X", "+", "-"), mark).when((mark == "") & (magnitude == 0), "flat")
    return F.struct(change.alias("change"), direction.alias("direction"), direction.isNull().alias("bad"))


def reason_direction(text: Column, reasons: Iterable[str]) -> Column:
    """``X`` where a number column holds one of the reason texts."""
    hit = F.lit(False)
    for reason in reasons:
        hit = hit | F.coalesce(F.startswith(F.trim(text), F.lit(reason)), F.lit(False))
    return F.when(hit, "X")


def to_base_unit(value: Column, unit: Column) -> Column:
    """Lots and thousands times a thousand, single units as they are; an unknown unit gives null."""
    return F.when(unit.isin("lot", "thousand"), value * 1000).when(unit.isin("share", "unit"), value)


def apply_lot_sizes(
    df: DataFrame, exceptions: DataFrame, code: str, date: str, lots: str, default: int = 1000
) -> DataFrame:
    """Lots to shares with dated lot sizes (code, valid_from, valid_to, lot_size).

    A code of the exception table uses its own size inside its dates; outside them the row is flagged
    ``lot_violation`` and has no shares. Spark broadcasts the table when it is below its size threshold.
    """
    sized = exceptions.select(F.col("code").alias("__code"), "valid_from", "valid_to", "lot_size")
    inside = (df[code] == F.col("__code")) & (df[date] >= F.col("valid_from")) & (df[date] <= F.col("valid_to"))
    known = exceptions.select(F.col("code").alias("__known")).distinct()
    joined = df.join(sized, inside, "left").join(known, df[code] == F.col("__known"), "left")
    bad = F.col("__known").isNotNull() & F.col("lot_size").isNull()
    shares = F.when(~bad, F.col(lots) * F.coalesce("lot_size", F.lit(default)))
    return joined.select(*df.columns, shares.alias("shares"), bad.alias("lot_violation"))


def per_thousand(value: Column) -> Column:
    """A term per thousand as a ratio; zero means that the term does not apply."""
    return F.nullif(value, F.lit(0)) / F.lit(1000)


def quantity(text: Column, unit: str) -> Column:
    """The number of a text that must end in ``unit``; null otherwise."""
    found = F.regexp_extract(F.regexp_replace(F.trim(text), ",", ""), rf"^([-+]?\d+(?:\.\d+)?)\s*\Q{unit}\E$", 1)
    return F.when(found != "", found).try_cast("decimal(38,12)")


def label_code(label: Column, codes: Mapping[str, str]) -> Column:
    """The code of a label; null for labels outside the map."""
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain(*codes.items())]), F.trim(label))


def report_period(text: Column) -> Column:
    """``115/2`` or ``115Q2`` as ``2026Q2``; null if it is none."""
    year, quarter = F.regexp_extract(text, r"^\s*(\d{2,3})\s*[/Q]\s*([1-4])\s*$", 1), F.regexp_extract(
        text, r"^\s*(\d{2,3})\s*[/Q]\s*([1-4])\s*$", 2
    )
    return F.when(year != "", F.concat((year.try_cast("int") + ROC_OFFSET).cast("string"), F.lit("Q"), quarter))


def gregorian_year(roc_year: Column) -> Column:
    return (roc_year.try_cast("int") + ROC_OFFSET).cast("smallint")


def digit_codes(text: Column) -> Column:
    """The distinct digits of a cell, sorted and comma-joined; null for none."""
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(\d)"))))
    return F.when(F.size(found) > 0, F.array_join(found, ","))


def _unescaped(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([None if t is None else html_module.unescape(t) for t in batch.to_pylist()], pa.string())


_TERMINATED = re.compile("&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")


def _reference(match: re.Match[str]) -> str:
    text = match[0]
    return html_module.unescape(text) if text[1] == "#" or text[1:] in html_module.entities.html5 else text


def _unescaped_terminated(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([None if t is None else _TERMINATED.sub(_reference, t) for t in batch.to_pylist()], pa.string())


def stripped(text: Column) -> Column:
    """A text without white space, of whatever script, at its ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def untagged(html: Column, terminated: bool = False) -> Column:
    """An HTML fragment with line breaks and paragraph ends as newlines, without tags, and with all named and numeric
    character references decoded (only texts with an ampersand go through Python).

    Like browsers, this also reads some references that lack their semicolon; with ``terminated`` these stay as they
    are, such as the rest of a reference that a text was cut in."""
    out = F.regexp_replace(F.regexp_replace(html, r"(?i)<br\s*/?>|</p>", "\n"), "<[^>]+>", "")
    decoded = F.arrow_udf(_unescaped_terminated if terminated else _unescaped, "string")(F.when(F.contains(out, F.lit("&")), out))
    return F.coalesce(decoded, out)


def html_text(html: Column, terminated: bool = False) -> Column:
    """Text of an HTML fragment, without white space at its ends."""
    return stripped(untagged(html, terminated))


#: Fixed value: texts up to this length that are no number stand for "no value".
PLACEHOLDER_LENGTH = 8


def accounting_amount(text: Column, sign: Column, power: Column) -> Column:
    """(value, bad): an amount with parentheses for minus, a sign attribute and a power-of-ten scale of either sign.

    A text that is no number is a placeholder (null) if it is short, else bad. Parentheses beside a sign attribute,
    a sign attribute other than a minus, and numbers that aren't finite are bad; so is an amount that the result's
    decimal(38,12) can't hold to the last digit, which must not pass for a missing one.
    """
    bare = F.regexp_replace(text, r"[,\s]", "")
    closed = bare.rlike(r"^\(.*\)$")
    cleaned = F.when(closed, F.concat(F.lit("-"), F.regexp_extract(bare, r"^\((.*)\)$", 1))).otherwise(bare)
    signed, minus = F.coalesce(sign != "", F.lit(False)), F.coalesce(sign == "-", F.lit(False))
    infinite = cleaned.rlike(r"(?i)^[+-]?(s?nan\d*|inf|infinity)$")
    number = F.coalesce(cleaned.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,6})?$"), F.lit(False))

    mantissa = F.regexp_extract(cleaned, r"^([^eE]*)", 1)
    own = F.coalesce(F.regexp_extract(cleaned, r"[eE]([+-]?\d+)$", 1).try_cast("int"), F.lit(0))
    exponent = own + F.coalesce(power, F.lit(0))
    decimals = F.length(F.regexp_extract(mantissa, r"\.(\d*?)0*$", 1))
    zeros = F.when(decimals == 0, F.length(F.regexp_extract(mantissa, r"(0*)\.?0*$", 1))).otherwise(0)
    scaled = F.when(mantissa.rlike("[1-9]"), F.concat(mantissa, F.lit("E"), exponent.cast("string"))).otherwise("0")
    value = scaled.try_cast("decimal(38,12)")
    lost = value.isNull() | (mantissa.rlike("[1-9]") & (decimals - zeros - exponent > 12))
    bad = (closed & signed) | infinite | F.when(~number, F.length(cleaned) > PLACEHOLDER_LENGTH).otherwise(
        (signed & ~minus) | lost
    )
    shown = F.when(number & ~bad, F.when(minus, -value).otherwise(value))
    return F.struct(shown.cast("decimal(38,12)").alias("value"), bad.alias("bad"))


def split_code_name(text: Column) -> Column:
    """(code, name) of ``code<full-width space>name``."""
    parts = F.split(text, "　", 2)
    return F.struct(F.trim(parts[0]).alias("code"), F.trim(F.try_element_at(parts, F.lit(2))).alias("name"))


def with_category(df: DataFrame, dimension: DataFrame, label: str, date: str, suffix: str = "業") -> DataFrame:
    """Add ``category_code``: the label without its suffix, by current, former or alias name, valid on the date.

    ``dimension`` has (name, code, valid_from, valid_to), a row per name with open ends null.
    """
    bare = F.regexp_replace(F.trim(F.col(label)), f"\\Q{suffix}\\E$", "")
    d = dimension.select(
        F.col("name").alias("__name"),
        F.col("code").alias("category_code"),
        F.col("valid_from").alias("__from"),
        F.col("valid_to").alias("__to"),
    )
    during = (F.col("__from").isNull() | (df[date] >= F.col("__from"))) & (
        F.col("__to").isNull() | (df[date] < F.col("__to"))
    )
    return df.join(d, (bare == F.col("__name")) & during, "left").select(*df.columns, "category_code")


def category_exists(df: DataFrame, dimension: DataFrame, code: str, date: str) -> DataFrame:
    """Add ``category_exists``: whether the code is in effect on the date."""
    d = dimension.select(
        F.col("code").alias("__code"), F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to")
    ).distinct()
    during = (F.col("__from").isNull() | (df[date] >= F.col("__from"))) & (
        F.col("__to").isNull() | (df[date] < F.col("__to"))
    )
    hits = df.join(d, (df[code] == F.col("__code")) & during, "left")
    return hits.groupBy(*df.columns).agg((F.count("__code") > 0).alias("category_exists"))


def movement(change: Column, direction: Column) -> Column:
    """unmatched, flat, up or down."""
    return F.when(direction == "X", "unmatched").when(
        change.isNull() | (change == 0), "flat"
    ).when(change > 0, "up").otherwise("down")


def exchange_of(source: Column, exchanges: Mapping[str, str]) -> Column:
    """The exchange of a source; an unknown source fails the job."""
    found = label_code(source, exchanges)
    return F.when(found.isNotNull(), found).otherwise(
        F.raise_error(F.concat(F.lit("unknown source "), F.coalesce(source, F.lit("null")))).cast("string")
    )


def index_identity(section: Column, title: Column, name: Column) -> Column:
    """Section, the provider named in the title's trailing parentheses (if any) and the name, joined by slashes."""
    provider = F.regexp_extract(title, r"[(（]([^()（）]+)[)）]\s*$", 1)
    return F.concat_ws("/", section, F.when(provider != "", provider), name)
