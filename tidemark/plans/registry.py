"""Registered queries: name -> (callable, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, days: str = ""):
    """Register a function (spark, sf_dir) -> DataFrame, with the SQL that gives the same rows.

    ``days`` names date columns, which both sides return as ISO text (clients differ in how they show dates)."""
    columns = days.split()

    def add(f: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.withColumns({c: F.col(c).cast("string") for c in columns}) if columns else df

        run.__module__, run.__doc__ = f.__module__, f.__doc__
        QUERIES[name] = run
        if sql is not None:
            text = ", ".join(f"{c}::varchar as {c}" for c in columns)
            ORACLE_SQL[name] = f"select * replace ({text}) from (\n{sql}\n)" if columns else sql
        return f

    return add
