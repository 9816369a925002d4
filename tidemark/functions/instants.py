"""Quarter helpers, statutory instants and release rules.

All instants are timestamps without zone that show UTC, so results don't depend on the session's zone;
source-local days are Taipei's.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Asia/Taipei"


def local_instant(day: Column, hours: int = 0) -> Column:
    """The instant at which the source-local clock shows ``hours`` o'clock on ``day``."""
    return F.convert_timezone(F.lit(ZONE), F.lit("UTC"), day.cast("timestamp_ntz") + F.expr(f"interval {hours} hours"))


def exchange_daily_settled(day: Column) -> Column:
    """03:00 on the day after."""
    return local_instant(F.date_add(day, 1), 3)


def weekly_sunday_noon(day: Column) -> Column:
    """12:00 on the first Sunday strictly after."""
    return local_instant(F.next_day(day, "Sunday"), 12)


def ex_date_midnight(day: Column) -> Column:
    """00:00 on the ex-date itself."""
    return local_instant(day, 0)


def announcement_next_day(day: Column) -> Column:
    """00:00 on the next day."""
    return local_instant(F.date_add(day, 1), 0)


def quarter_index(year: Column, quarter: Column) -> Column:
    """Consecutive quarters have consecutive numbers."""
    return year.cast("int") * 4 + quarter.cast("int") - 1


def quarter_start(year: Column, quarter: Column) -> Column:
    return F.make_date(year.cast("int"), (quarter * 3 - 2).cast("int"), F.lit(1))


def quarter_end(year: Column, quarter: Column) -> Column:
    return F.last_day(F.make_date(year.cast("int"), (quarter * 3).cast("int"), F.lit(1)))


def previous_quarter(year: Column, quarter: Column) -> Column:
    """(year, quarter) before."""
    return F.struct(
        F.when(quarter == 1, year - 1).otherwise(year).alias("year"),
        F.when(quarter == 1, F.lit(4)).otherwise(quarter - 1).alias("quarter"),
    )


def monthly_page_settled(month: Column) -> Column:
    """The first of the month after next, midnight: a month's revenue page no longer changes."""
    return local_instant(F.add_months(F.trunc(month, "month"), 2), 0)


def report_deadline(year: Column, quarter: Column) -> Column:
    """The day after the filing deadline: 15 May, 15 August, 15 November, 31 March of the next year."""
    day = F.when(quarter == 1, F.make_date(year.cast("int"), F.lit(5), F.lit(15))).when(
        quarter == 2, F.make_date(year.cast("int"), F.lit(8), F.lit(15))
    )
    day = day.when(quarter == 3, F.make_date(year.cast("int"), F.lit(11), F.lit(15))).otherwise(
        F.make_date(year.cast("int") + 1, F.lit(3), F.lit(31))
    )
    return local_instant(F.date_add(day, 1), 0)


def year_settled(year: Column) -> Column:
    """The first instant of the next year."""
    return local_instant(F.make_date(year.cast("int") + 1, F.lit(1), F.lit(1)), 0)


def month_file_settled(month: Column) -> Column:
    """The release instant of the month's last day: a monthly file of daily rows is complete."""
    return exchange_daily_settled(F.last_day(month))
