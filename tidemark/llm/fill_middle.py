"""Fill-in-the-middle by a regular expression with counted quantifiers, in DataFrame functions alone.

``regexp_count`` counts the units of a text. A pattern of its own for every row, with the possessive groups
``(unit{a})`` and ``(unit{b-a})`` and the rest, matches the whole text once and captures prefix, middle and suffix;
the form's order of sentinels and groups is the replacement of that one match. Possessive quantifiers never give
back, so a match is one walk along the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A code point, line ends included.
UNIT = r"(?s:.)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: Units that are counted at a time: a count keeps what it matched until it ends.
COUNTED = 1_000


def count_units(text: Column, unit: str = UNIT) -> Column:
    """The units of ``text``, which follow each other without gaps.

    Whole runs of ``COUNTED`` units are counted first, then the units of the rest, so that the number of matches
    that are held is a thousandth of the units.
    """
    run = f"(?:{unit}){{{COUNTED}}}+"
    rest = F.regexp_replace(text, F.lit(rf"\A(?:{run})*+"), F.lit(""))
    return (F.regexp_count(text, F.lit(run)) * COUNTED + F.regexp_count(rest, F.lit(unit))).cast("bigint")


def draws(key: Column, seed: int = 1) -> list[Column]:
    """Four whole numbers from 0 to 2^32 - 1, the first groups of the SHA-256 of ``seed:key`` (null: empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = UNIT,
    seed: int = 1,
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """(id, n, form, prefix_units, middle_units, output) of every row of ``docs``.

    The draws of the id give two cuts among 0 to n and the form: ``plain`` (the text as it is; always so for empty
    texts and those that hold a sentinel), ``psm`` or ``spm``. Lengths are null for plain rows. A null text is
    empty, a null id draws like an empty key. Repeated rows and ids are cut alike. Other columns are not read. Units must
    follow each other without gaps from the first character on; what follows the last unit goes to the suffix.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    rows = rows.select("id", "text", count_units(F.col("text"), unit).alias("n"), F.array(*draws(F.col("id"), seed)).alias("h"))
    cuts = [F.col("h")[k] % (F.col("n") + 1) for k in (0, 1)]
    marked = F.col("text") == ""
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(sentinel))
    form = (
        F.when(marked | (F.col("h")[2] % 100 >= 100 - plain_percent), "plain")
        .when(F.col("h")[3] % 100 < spm_percent, "spm")
        .otherwise("psm")
    )
    cut = rows.select("id", "text", "n", form.alias("form"), F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"))
    group = lambda n: F.concat(F.lit(f"((?:{unit}){{"), n.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit(r"\A"), group(F.col("a")), group(F.col("b") - F.col("a")), F.lit(r"((?s:.*))\z"))
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    plain = F.col("form") == "plain"
    return cut.select(
        F.col("id").alias(id_col),
        "n",
        "form",
        F.when(~plain, F.col("a")).alias("prefix_units"),
        F.when(~plain, F.col("b") - F.col("a")).alias("middle_units"),
        F.when(plain, F.col("text")).otherwise(F.regexp_replace("text", pattern, order)).alias("output"),
    )


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` in the given form was made of; one match. Sentinels stand where they first occur, since no
    text in these forms holds one."""
    part = r"((?s:.*?))"
    psm = F.lit(rf"\A{PREFIX}{part}{SUFFIX}{part}{MIDDLE}((?s:.*))\z")
    spm = F.lit(rf"\A{SUFFIX}{part}{PREFIX}{part}{MIDDLE}((?s:.*))\z")
    return (
        F.when(form == "psm", F.regexp_replace(output, psm, F.lit("$1$3$2")))
        .when(form == "spm", F.regexp_replace(output, spm, F.lit("$2$3$1")))
        .otherwise(output)
    )
