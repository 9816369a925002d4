"""Append-on-change over a stream: every micro-batch appends the rows that differ from the stored latest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from tidemark.operators.append import append_versions


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """A Parquet table with its ``batch`` partitions; None where there is none yet."""
    try:
        return spark.read.schema(StructType(schema.fields).add("batch", LongType())).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append_changed_stream(
    stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str], values: Sequence[str], base: str | None = None
) -> StreamingQuery:
    """Run ``append_versions`` in ``foreachBatch`` against the Parquet table at ``table`` until the source is drained.

    Rows carry ``recorded_at``. Versions of a key within a batch are compared one after another, so the table is the same
    however the stream was cut, as long as a key's versions come in the order of recorded_at. Each batch writes to its own
    directory ``batch=N`` and is compared with the earlier batches and the table ``base`` alone, so a batch that is run
    again finds what it found the first time and replaces its own rows. ``table`` belongs to one checkpoint: a new
    checkpoint starts a new ``table`` and names the existing one as ``base`` (starting it on a table that already
    holds batches is refused, because its numbers would overwrite them)."""

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        schema = StructType([f for f in rows.schema.fields if f.name != "batch"])
        own = _stored(spark, table, schema)
        earlier = [] if own is None else [own.where(F.col("batch") < number).drop("batch")]
        if base is not None:
            earlier.append(spark.read.schema(schema).parquet(base))
        stored = reduce(DataFrame.unionByName, earlier) if earlier else rows.limit(0)
        changed = append_versions(rows, stored, keys, values)
        changed.write.mode("overwrite").parquet(f"{table}/batch={number}")

    spark = stream.sparkSession
    if not _has_offsets(spark, checkpoint) and _stored(spark, table, StructType(stream.schema.fields)) is not None:
        raise ValueError(f"{table} holds batches of another checkpoint; name it as base of a new table")
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _has_offsets(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a checkpoint has planned a batch before."""
    try:
        return not spark.read.text(f"{checkpoint}/offsets").isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
