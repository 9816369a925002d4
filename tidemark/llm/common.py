"""Helpers shared by the text operators: words, text UDFs and shared-folder tables.

A *word* is a maximal run of bytes outside 0x20 and 0x09-0x0D, so ``bytes.split()``
is the word rule; every operator of this subpackage uses it.
"""

from __future__ import annotations

import ctypes
import gc
import math
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lower-cases A-Z and leaves every other byte alone.
ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

#: Texts that a task turns into Python objects at a time.
SLICE = 256


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that all executors share (``spark.checkpoint.dir``).

    Where the session names none, a local temporary folder is set once if the master is local (tests); on a
    cluster, where executors would write to their own disks, this is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Partitions that a table is spread over at most.
MOST_PARTITIONS = 20_000


def spread(df: DataFrame, rows: int) -> DataFrame:
    """A written table ``df`` over a number of partitions that follows its row count: about ``rows`` rows each.

    For narrow rows that later work widens: adaptive execution judges partitions by their bytes and would
    leave them in a few tasks, but keeps a number that is asked for.
    """
    return df.repartition(min(max(1, math.ceil(df.count() / rows)), MOST_PARTITIONS))


def listed(ids: DataFrame) -> DataFrame:
    """Written rows of a few numbers as the small side of a join: broadcast up to ``BROADCAST_IDS`` rows, beyond it
    merged."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("merge")


def release_memory() -> None:
    """Give what a finished task held back to the system: workers live on for other stages, and freed memory that they
    keep would add up over these."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_udf(make: Callable[[], Callable[[list], pa.Array]], schema: str):
    """An Arrow UDF over a text column.

    ``make`` runs once per task and returns a function from a list of texts (None for null) to an Arrow array of type
    ``schema``; it gets ``SLICE`` texts at a time and what it returns is sent on at once, which bounds what a task holds
    on either side. Marked nondeterministic so that Catalyst keeps one evaluation
    where several fields of the result are used.
    """

    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                yield work(batch.slice(at, SLICE).to_pylist())
        del work
        release_memory()

    return F.arrow_udf(apply, schema).asNondeterministic()


def struct_array(columns: dict[str, tuple[list, pa.DataType]]) -> pa.Array:
    """A struct array of the given name -> (values, type) columns."""
    return pa.StructArray.from_arrays(
        [pa.array(v, t) if not isinstance(v, pa.Array) else v for v, t in columns.values()],
        fields=[pa.field(n, t) for n, (_, t) in columns.items()],
    )


def id_bucket(doc_id: Column | str, buckets: int = 3) -> Column:
    """crc32 of the id as text, modulo ``buckets``."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(doc_id.cast("string").cast("binary")) % buckets


def sample_rows(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by the hash of ``key``; all rows if there are no more.

    Deterministic, spread evenly over the key, and fixed before any text is read: only the key
    column is scanned to count the rows.
    """
    n = df.select(key).count()
    if n <= bound:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * bound / n))


#: Id lists up to this many rows may be broadcast (16 bytes a row or so).
BROADCAST_IDS = 500_000


def without_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``ids`` (one column, written beforehand).

    The list is counted first: it is broadcast up to ``BROADCAST_IDS`` rows, joined by shuffle beyond. Rows with
    a null key stay.
    """
    other = ids.select(F.col(ids.columns[0]).alias("__gone"))
    small = other.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(other) if small else other, docs[key] == F.col("__gone"), "left_anti")
