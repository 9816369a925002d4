"""Dataset descriptors: schema, key, period column, release rule and dependencies, one frozen value each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import instants


@dataclass(frozen=True)
class Dataset:
    """``rule`` is the release rule of the period column; None with ``published``: first rows are public at
    ``published_at``."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    period: str
    rule: Callable[[Column], Column] | None = None
    published: bool = False
    hidden: str | None = None

    def day(self) -> Column:
        """The date that a key is filed under: the period column, of a report the last day of its quarter."""
        if "report_quarter" in self.keys:
            return instants.quarter_end(F.col("report_year"), F.col("report_quarter"))
        return F.col(self.period)


def _type(kind: str) -> T.DataType:
    if kind.startswith("decimal"):
        digits, places = kind.removeprefix("decimal(").rstrip(")").split(",")
        return T.DecimalType(int(digits), int(places))
    simple = {
        "string": T.StringType,
        "bigint": T.LongType,
        "int": T.IntegerType,
        "smallint": T.ShortType,
        "date": T.DateType,
        "timestamp_ntz": T.TimestampNTZType,
        "boolean": T.BooleanType,
    }
    return simple[kind]()


def _schema(key: str, values: str) -> T.StructType:
    fields = f"{key}, recorded_at timestamp_ntz, {values}, fetch_id string".split(", ")
    return T.StructType([T.StructField(name, _type(kind)) for name, kind in (f.split(" ") for f in fields)])


_STOCK = "stock_id string, source string, trade_date date"
_PARTIES = ("foreign", "foreign_dealer", "trust", "dealer_self", "dealer_hedge")
_LEVELS = ", ".join(
    [
        *(f"holders_{i} bigint" for i in range(1, 16)),
        *(f"shares_{i} bigint" for i in range(1, 16)),
        *(f"percent_{i} decimal(5,2)" for i in range(1, 16)),
    ]
)
_SIDES = ", ".join(
    f"{s}_{c} bigint"
    for s in ("margin", "short")
    for c
    in ("buy", "sell", "cash_repayment" if s == "margin" else "stock_repayment", "previous_balance", "balance", "limit")
)


def _observed() -> dict[str, Dataset]:
    daily = instants.exchange_daily_settled
    day = ("stock_id", "source", "trade_date")
    found = [
        Dataset(
            "daily_prices",
            _schema(
                _STOCK,
                "open_price decimal(10,2), high_price decimal(10,2), low_price decimal(10,2), close_price decimal(10,2), volume bigint, trade_value bigint, trade_count int, price_change decimal(10,2), price_direction string, last_bid_price decimal(10,2), last_ask_price decimal(10,2), last_bid_volume bigint, last_ask_volume bigint",
            ),
            day,
            "trade_date",
            daily,
        ),
        Dataset(
            "index_prices",
            _schema(
                "source string, index_name string, trade_date date",
                "open_value decimal(12,2), high_value decimal(12,2), low_value decimal(12,2), close_value decimal(12,2), change_points decimal(12,2), change_percent decimal(8,2)",
            ),
            ("source", "index_name", "trade_date"),
            "trade_date",
            daily,
        ),
        Dataset(
            "valuations",
            _schema(
                _STOCK,
                "pe_ratio decimal(10,2), pb_ratio decimal(10,2), dividend_yield decimal(8,2), dividend_year smallint, report_period string",
            ),
            day,
            "trade_date",
            daily,
        ),
        Dataset(
            "institutional_flows",
            _schema(
                _STOCK,
                ", ".join(f"{p}_{c} bigint" for p in _PARTIES for c in ("buy", "sell", "net"))
                + ", dealer_net bigint, total_net bigint",
            ),
            day,
            "trade_date",
            daily,
        ),
        Dataset(
            "institutional_market_flows",
            _schema("source string, trade_date date, institution string", "buy bigint, sell bigint, net bigint"),
            ("source", "trade_date", "institution"),
            "trade_date",
            daily,
        ),
        Dataset(
            "foreign_holdings",
            _schema(
                _STOCK,
                "issued_shares bigint, investable_shares bigint, held_shares bigint, investable_ratio decimal(6,2), held_ratio decimal(6,2), foreign_legal_limit_ratio decimal(6,2)",
            ),
            day,
            "trade_date",
            daily,
        ),
        Dataset("margin_trading", _schema(_STOCK, f"{_SIDES}, offset_balance bigint"), day, "trade_date", daily),
        Dataset(
            "securities_lending",
            _schema(
                _STOCK,
                "previous_balance bigint, sold bigint, returned bigint, adjustment bigint, balance bigint, next_limit bigint, next_available_limit bigint",
            ),
            day,
            "trade_date",
            daily,
        ),
        Dataset(
            "shareholding_distributions",
            _schema(
                "stock_id string, source string, snapshot_date date",
                f"{_LEVELS}, adjustment_shares bigint, adjustment_percent decimal(5,2), total_holders bigint, total_shares bigint, total_percent decimal(5,2)",
            ),
            ("stock_id", "source", "snapshot_date"),
            "snapshot_date",
            instants.weekly_sunday_noon,
        ),
        Dataset(
            "corporate_actions",
            _schema(
                "stock_id string, source string, ex_date date",
                "event_type string, close_before decimal(10,2), reference_price decimal(10,2), subscription_price decimal(10,2), rights_dividend_value decimal(14,6), cash_dividend_per_share decimal(12,8), cash_return_per_share decimal(12,8), free_share_ratio decimal(14,12), rights_ratio decimal(14,12), old_shares decimal(13,8), new_shares decimal(13,8), retracted boolean, detail_fetch_id string",
            ),
            ("stock_id", "source", "ex_date"),
            "ex_date",
            instants.ex_date_midnight,
            hidden="retracted",
        ),
        Dataset(
            "monthly_revenues",
            _schema(
                "stock_id string, source string, revenue_month date",
                "revenue bigint, revenue_last_month bigint, revenue_last_year_month bigint, cumulative_revenue bigint, cumulative_revenue_last_year bigint, mom_pct decimal(10,2), yoy_pct decimal(10,2), cumulative_yoy_pct decimal(10,2), note string, published_at timestamp_ntz",
            ),
            ("stock_id", "source", "revenue_month"),
            "revenue_month",
            published=True,
        ),
        Dataset(
            "financial_reports",
            _schema(
                "id bigint, stock_id string, report_year smallint, report_quarter smallint",
                "report_category string, published_at timestamp_ntz",
            ),
            ("stock_id", "report_year", "report_quarter"),
            "report_year",
            published=True,
        ),
        Dataset(
            "industry_changes",
            _schema(
                "stock_id string, source string, effective_date date",
                "announced_on date, document_number string, old_industry string, new_industry string, attachment_fetch_id string",
            ),
            ("stock_id", "source", "effective_date"),
            "announced_on",
            instants.announcement_next_day,
        ),
        Dataset("industry_observations", _schema(_STOCK, "industry_code string"), day, "trade_date", daily),
    ]
    return {d.name: d for d in found}


OBSERVED = _observed()

def dataset(name: str) -> Dataset:
    """The descriptor of an observed dataset; an unknown name is refused."""
    try:
        return OBSERVED[name]
    except KeyError:
        raise ValueError(f"unknown dataset {name!r}; known: {', '.join(sorted(OBSERVED))}") from None
