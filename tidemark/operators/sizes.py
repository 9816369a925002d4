"""Broadcasts and partitions of tables whose size is looked at first."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of few columns that may be broadcast.
BROADCAST_ROWS = 200_000


def small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` marked for broadcast if it has at most ``rows`` rows, else as it is (Spark picks the join)."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


#: Rows that a task sorts or holds at once.
ROWS_A_TASK = 400_000


def clustered(df: DataFrame, by: Sequence[str], rows: int = 0) -> DataFrame:
    """``df`` dealt by the columns ``by`` into the session's number of shuffle partitions, more if ``rows`` rows need it.

    Adaptive execution keeps a number that is asked for; left alone it joins partitions by their packed bytes, and a
    task then sorts several times as much in memory."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, math.ceil(rows / ROWS_A_TASK)), *by)
