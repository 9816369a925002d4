"""Normalisation of raw payload tables: JSON tables, level files, HTML, tagged reports, notices, calendars."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import roc_date, stripped, untagged

TABLE = "struct<title:string, fields:array<string>, data:array<array<string>>>"
PAYLOAD = f"stat string, date string, total int, title string, fields array<string>, data array<array<string>>, tables array<{TABLE}>"


def payload_tables(raw: DataFrame, body: str = "body") -> DataFrame:
    """One row per table of each payload, from either layout (fields/data at the top, or tables[])."""
    keep = [c for c in raw.columns if c != body]
    p = raw.withColumn("__p", F.from_json(body, PAYLOAD))
    own = F.when(
        F.col("__p.fields").isNotNull(),
        F.array(
            F.struct(
                F.col("__p.title").alias("title"), F.col("__p.fields").alias("fields"), F.col("__p.data").alias("data")
            )
        ),
    ).otherwise(F.array().cast(f"array<{TABLE}>"))
    return p.select(
        *keep,
        F.posexplode(F.concat(own, F.coalesce("__p.tables", F.array().cast(f"array<{TABLE}>")))).alias("table_no", "t"),
    ).select(*keep, "table_no", "t.title", "t.fields", "t.data")


def explode_fields_data(raw: DataFrame, header: Sequence[str], file: str, body: str = "body") -> DataFrame:
    """Rows of the table with exactly this header (A2): one column per field, ``row_no`` and ``violation``.

    A payload without such a table, or with several, gives one row with ``header_mismatch``."""
    tables = payload_tables(raw, body).where(F.col("fields") == F.array(*[F.lit(h) for h in header]))
    counts = tables.groupBy(file).agg(F.count("*").alias("__n"), F.first("data").alias("data"))
    one = counts.where("__n = 1").select(file, F.posexplode("data").alias("row_no", "r"))
    good = one.select(
        file,
        "row_no",
        *[F.try_element_at("r", F.lit(i)).alias(h) for i, h in enumerate(header, 1)],
        F.when(F.size("r") != len(header), "cell_count").alias("violation"),
    )
    bad = raw.select(file).join(counts.where("__n = 1").select(file), file, "left_anti")
    return good.unionByName(
        bad.select(
            file,
            F.lit(None).cast("int").alias("row_no"),
            *[F.lit(None).cast("string").alias(h) for h in header],
            F.lit("header_mismatch").alias("violation"),
        )
    )


def by_header_variant(
    tables: DataFrame,
    variants: Mapping[tuple[str, ...], Mapping[str, int]],
    units: Mapping[tuple[str, ...], str] | None = None,
) -> DataFrame:
    """Named columns from whichever known header a table has (A3): each variant maps a name to its cell position (from
    0), and may state a unit."""
    names = list(dict.fromkeys(n for v in variants.values() for n in v))
    rows = tables.select(*[c for c in tables.columns if c != "data"], F.posexplode("data").alias("row_no", "r"))

    def pick(of: Mapping[tuple[str, ...], object]) -> Column:
        out = F.lit(None)
        for header, value in of.items():
            out = F.when(F.col("fields") == F.array(*[F.lit(h) for h in header]), F.lit(value)).otherwise(out)
        return out

    cells = [
        F.try_element_at("r", (pick({h: v[n] for h, v in variants.items() if n in v}) + 1).cast("int")).alias(n)
        for n in names
    ]
    known = pick({h: True for h in variants}).cast("boolean")
    return rows.select(
        *[c for c in tables.columns if c not in ("data", "fields")],
        "row_no",
        *cells,
        (pick(units).cast("string") if units else F.lit(None).cast("string")).alias("unit"),
        F.coalesce(known, F.lit(False)).alias("known_header"),
    )


def explode_sections(
    raw: DataFrame, sections: Mapping[tuple[str, ...], str], file: str, body: str = "body"
) -> DataFrame:
    """Rows of several sections (A4): a section is known by its columns and its title must then contain the label.

    ``identity`` is section and name."""
    t = payload_tables(raw, body)
    label = F.lit(None).cast("string")
    for header, name in sections.items():
        label = F.when(F.col("fields") == F.array(*[F.lit(h) for h in header]), name).otherwise(label)
    known = t.withColumn("section", label).where("section is not null")
    return known.select(
        file,
        "section",
        F.when(~F.contains("title", F.col("section")), "label_mismatch").alias("violation"),
        F.posexplode("data").alias("row_no", "r"),
    ).select(
        file,
        "section",
        "violation",
        "row_no",
        F.concat_ws("/", "section", F.try_element_at("r", F.lit(1))).alias("identity"),
        "r",
    )


def long_to_wide_levels(levels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Level rows to a wide row (A5): levels 1-15, adjustment (16) and total (17) from the known levels.

    A level's rows are combined first and then put to their places, so that no row passes fifty aggregates. The
    adjustment's magnitude is published unsigned and stored negative; its holder count is dropped (A6)."""
    values = ("holders", "shares", "percent")
    wide = levels.withColumn("level", F.col("level").cast("int")).groupBy(*keys).pivot("level", list(range(1, 18))).agg(
        *[F.max(c).alias(c) for c in values], F.count("holders").alias("n")
    )
    return wide.select(
        *keys,
        *[F.col(f"{i}_{c}").alias(f"{c}_{i}") for i in range(1, 16) for c in values],
        *[(-F.abs(F.col(f"16_{c}"))).alias(f"adjustment_{c}") for c in ("shares", "percent")],
        *[F.col(f"17_{c}").alias(f"total_{c}") for c in values],
        F.coalesce("16_n", F.lit(0)).alias("dropped_holder_counts"),
    )


_MARK = "\x01"


def html_table_rows(pages: DataFrame, id_col: str, html: str = "html", cells: int | None = None) -> DataFrame:
    """(id, row_no, cells, violation) of HTML table rows (A7); rows whose first cell is a header are skipped, a wrong
    cell count is a violation."""
    row = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"))
    rows = pages.select(id_col, F.posexplode(row).alias("row_no", "tr")).where(~F.col("tr").rlike(r"(?is)^\s*<th\b"))
    found = F.regexp_extract_all("tr", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"))
    # A row's cells are decoded in one text; no character reference stands for the mark between them.
    joined = untagged(F.array_join(F.transform(found, lambda c: F.replace(c, F.lit(_MARK), F.lit(""))), _MARK))
    cell = F.when(
        F.size(found) > 0, F.transform(F.split(joined, _MARK, -1), stripped)
    ).otherwise(F.array().cast("array<string>"))
    out = rows.select(id_col, "row_no", cell.alias("cells"))
    return out.withColumn(
        "violation", F.when(F.size("cells") != cells, "cell_count") if cells else F.lit(None).cast("string")
    )


def extract_facts(documents: DataFrame, id_col: str, body: str = "body") -> DataFrame:
    """Inline-tagged numeric facts with their document's own context and unit.

    Columns: id, fact_no, concept, value_text, sign, scale, period_start, period_end, unit, statement, violation.
    Context and unit definitions are joined by (document, reference). A fact's statement is the last
    ``data-statement`` anchor before it."""
    attr = lambda t, n: F.nullif(F.regexp_extract(t, rf'(?i)\b{n}="([^"]*)"', 1), F.lit(""))
    token = F.regexp_extract_all(
        body, F.lit(r"(?is)(<ix:nonfraction\b[^>]*>.*?</ix:nonfraction>|<a\b[^>]*data-statement=\"[^\"]*\"[^>]*>)")
    )
    marks = documents.select(id_col, F.posexplode(token).alias("fact_no", "t"))
    from pyspark.sql import Window

    w = Window.partitionBy(id_col).orderBy("fact_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    facts = marks.withColumn(
        "statement", F.last(attr(F.col("t"), "data-statement"), True).over(w)
    ).where(F.col("t").rlike("(?i)^<ix:"))
    f = facts.select(
        id_col,
        "fact_no",
        "statement",
        attr(F.col("t"), "name").alias("concept"),
        attr(F.col("t"), "contextref").alias("context_ref"),
        attr(F.col("t"), "unitref").alias("unit_ref"),
        attr(F.col("t"), "sign").alias("sign"),
        attr(F.col("t"), "scale").try_cast("int").alias("scale"),
        F.trim(F.regexp_extract("t", r"(?is)>(.*?)</ix:", 1)).alias("value_text"),
    )
    ctx = documents.select(
        id_col, F.explode(F.regexp_extract_all(body, F.lit(r"(?is)(<xbrli:context\b.*?</xbrli:context>)"))).alias("c")
    )
    inner = lambda t, n: F.nullif(F.regexp_extract(t, rf"(?is)<xbrli:{n}>\s*(.*?)\s*</xbrli:{n}>", 1), F.lit(""))
    contexts = ctx.select(
        id_col,
        attr(F.col("c"), "id").alias("context_ref"),
        inner(F.col("c"), "startDate").try_cast("date").alias("period_start"),
        F.coalesce(inner(F.col("c"), "endDate"), inner(F.col("c"), "instant")).try_cast("date").alias("period_end"),
        F.lit(True).alias("__c"),
    )
    un = documents.select(
        id_col, F.explode(F.regexp_extract_all(body, F.lit(r"(?is)(<xbrli:unit\b.*?</xbrli:unit>)"))).alias("u")
    )
    units = un.select(
        id_col,
        attr(F.col("u"), "id").alias("unit_ref"),
        F.coalesce(inner(F.col("u"), "measure"), F.lit("")).alias("unit"),
        F.lit(True).alias("__u"),
    )
    j = f.join(contexts, [id_col, "context_ref"], "left").join(units, [id_col, "unit_ref"], "left")
    reason = F.when(F.col("__c").isNull(), "undefined_context").when(F.col("__u").isNull(), "undefined_unit").when(
        F.col("unit") == "", "malformed_unit"
    )
    return j.select(
        id_col,
        "fact_no",
        "statement",
        "concept",
        "value_text",
        "sign",
        "scale",
        "period_start",
        "period_end",
        "unit",
        reason.alias("violation"),
    )


#: How notices name a change of category, its effective date, a numbered paragraph and the board whose
#: paragraphs don't count.
CHANGE = r"代號[：:\s]*([0-9]{4}[0-9A-Z]{0,2})\s*[)）]?\s*由「([^「」]+)」+\s*(?:改為|調整為)「([^「」]+)」"
EFFECTIVE = (r"實施日期[：:]\s*(\d{2,3}年\d{1,2}月\d{1,2}日)", r"(?:自|於)(\d{2,3}年\d{1,2}月\d{1,2}日)起實施")
PARAGRAPH = r"[一二三四五六七八九十]+、"
EMERGING = "興櫃公司"


def scoped_text(text: Column, skip: str = EMERGING) -> Column:
    """A notice without the numbered paragraphs whose first line names ``skip``. What stands before the first numbered
    paragraph stays; a text without any is one paragraph."""
    parts = F.split(text, rf"(?m)(?=^{PARAGRAPH})")
    numbered = F.exists(parts, lambda p: p.rlike(f"^{PARAGRAPH}"))
    named = lambda p: F.contains(F.split(p, "\n", 2)[0], F.lit(skip))
    return F.array_join(F.filter(parts, lambda p: ~(named(p) & (p.rlike(f"^{PARAGRAPH}") | ~numbered))), "")


def announcement_changes(
    notices: DataFrame, id_col: str, text: str = "text", subject: str | None = None, scoped: bool = True
) -> DataFrame:
    """Category changes named in notice texts (A10): one row per ``code from A to B``.

    The effective date, stated in the text or the subject, must be one. With ``scoped`` the paragraphs about the
    emerging board are left out of the changes (not of the dates)."""
    said = F.concat_ws("\n", *([subject] if subject else []), text)
    found = F.concat(*[F.regexp_extract_all(said, F.lit(p), 1) for p in EFFECTIVE])
    dates = F.array_distinct(F.transform(found, roc_date))
    body = scoped_text(F.col(text)) if scoped else F.col(text)
    n = notices.select(id_col, dates.alias("d"), body.alias("__t"))
    parts = [F.regexp_extract_all("__t", F.lit(CHANGE), i).alias(c) for i, c in enumerate("cab", 1)]
    rows = n.select(id_col, "d", F.explode(F.arrays_zip(*parts)).alias("h"))
    one = F.size("d") == 1
    return rows.select(
        id_col,
        F.col("h.c").alias("stock_id"),
        F.trim("h.a").alias("old_industry"),
        F.trim("h.b").alias("new_industry"),
        F.when(one, F.col("d")[0]).alias("effective_date"),
        F.when(~one, "effective_date_not_unique").alias("violation"),
    )


#: Words of a notice's subject that make it a regulation or leave it out of scope.
REGULATION_WORDS = ("要點", "準則")


def subject_class(subject: Column) -> Column:
    """change, regulation or out_of_scope by a notice's subject (A10): notices of the emerging board alone are out of
    scope."""
    has = lambda word: F.contains(subject, F.lit(word))
    emerging = has("創櫃") | (has("興櫃") & ~has("上櫃") & ~has("上（興）櫃"))
    regulation = has(REGULATION_WORDS[0]) | has(REGULATION_WORDS[1])
    return F.when(regulation, "regulation").when(emerging, "out_of_scope").otherwise("change")


def trading_days(raw: DataFrame, asked_month: str, body: str = "body") -> DataFrame:
    """Days of monthly calendar files (A21): (asked month, trade_date, violation). A day outside the asked month or an
    unreadable one is a violation; so is a month without days."""
    t = payload_tables(raw, body)
    days = t.select(asked_month, F.explode("data").alias("r")).select(
        asked_month, roc_date(F.try_element_at("r", F.lit(1))).alias("trade_date")
    ).distinct()
    reason = F.when(F.col("trade_date").isNull(), "bad_date").when(
        F.trunc("trade_date", "month") != F.trunc(asked_month, "month"), "outside_month"
    )
    none = raw.select(asked_month).join(days.select(asked_month), asked_month, "left_anti").select(
        asked_month, F.lit(None).cast("date").alias("trade_date"), F.lit("empty_month").alias("violation")
    )
    return days.withColumn("violation", reason).unionByName(none)


#: How the columns of the daily limits are headed.
LIMIT_UP, LIMIT_DOWN = "漲停價", "跌停價"


def published_limits(payloads: DataFrame, body: str = "content") -> DataFrame:
    """(payload's other columns, stock_id, trade_date, limit_down, limit_up) of result-feed lists.

    Lists have the date first, the code second and the limits in the columns so headed; payloads without these columns have
    none. Rows whose date or limits aren't readable are left out; of rows with equal code and date the last counts.
    """
    keep = [c for c in payloads.columns if c != body]
    tables = payload_tables(payloads, body).where("table_no = 0")
    at = lambda head: F.array_position(F.transform("fields", lambda f: F.startswith(f, F.lit(head))), True)
    rows = tables.select(*keep, at(LIMIT_DOWN).alias("__d"), at(LIMIT_UP).alias("__u"), F.posexplode("data").alias("__n", "r"))
    cell = lambda i: F.try_element_at("r", i.cast("int"))
    price = lambda i: F.regexp_replace(cell(i), ",", "").try_cast("decimal(20,6)")
    read = rows.where("__d > 0 and __u > 0").select(
        *keep, "__n", F.trim(cell(F.lit(2))).alias("stock_id"), roc_date(cell(F.lit(1))).alias("trade_date"),
        price(F.col("__d")).alias("limit_down"), price(F.col("__u")).alias("limit_up"),
    ).where("trade_date is not null and limit_down is not null and limit_up is not null")
    last = read.groupBy(*keep, "stock_id", "trade_date").agg(F.max_by(F.struct("limit_down", "limit_up"), "__n").alias("x"))
    return last.select(*keep, "stock_id", "trade_date", "x.*")
