"""Typed scans and sinks of dataset tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.datasets import dataset


def read_table(
    spark: SparkSession, root: str, name: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """A dataset's rows with its key date in [start, end] (A1); the filter reaches the scan."""
    d = dataset(name)
    if start and end and start > end:
        raise ValueError(f"start {start} is after end {end}")
    df = spark.read.schema(d.schema).parquet(f"{root}/{name}")
    if start:
        df = df.where(F.col(d.period) >= F.lit(start).cast(d.schema[d.period].dataType))
    return df.where(F.col(d.period) <= F.lit(end).cast(d.schema[d.period].dataType)) if end else df


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that driver and executors share (``spark.checkpoint.dir``); on a local master
    without one a temporary folder is set, on a cluster its absence is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def in_files(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read back."""
    path = scratch_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def append_rows(rows: DataFrame, root: str, name: str, recorded_at: str, fetch_id: str) -> None:
    """Append rows stamped with one batch instant and fetch (A13); the stamp is a literal, so every row bears the same.

    Rows are clustered by the key date before the write, so files' date ranges are narrow and scans skip them."""
    d = dataset(name)
    stamped = rows.withColumn("recorded_at", F.lit(recorded_at).cast("timestamp_ntz")).withColumn(
        "fetch_id", F.lit(fetch_id)
    )
    stamped.select(
        *[F.col(f.name).cast(f.dataType) for f in d.schema.fields]
    ).repartitionByRange(d.period).sortWithinPartitions(d.period).write.mode("append").parquet(f"{root}/{name}")


SERIES = ("stock_id", "source")
#: Files that a derived table's series are dealt to; a run rewrites those that hold a touched series.
BUCKETS = 64


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """A derived table that ``overwrite_series`` wrote."""
    return spark.read.parquet(path).drop("bucket")


def overwrite_series(rows: DataFrame, path: str, date: str, buckets: int = BUCKETS) -> None:
    """Replace the series that ``rows`` holds in the derived table at ``path``, leaving the others (A14's sink).

    Series are dealt to a fixed number of buckets by hash, a folder and file each and sorted by series and date. A run
    reads the buckets of its series, no others, puts their other series beside its rows, and replaces these buckets
    alone. What it has computed is written to the shared folder first, so ``rows`` may be read from the table
    itself and a failed run leaves the table as it was until the last commit. ``buckets`` belongs to the table.
    """
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in SERIES]), F.lit(buckets)).cast("int")
    staged = scratch_folder(spark, "series")
    rows.withColumn("bucket", bucket).write.parquet(staged)
    fresh = spark.read.parquet(staged)
    touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]
    whole = fresh
    if _exists(spark, path):
        held = spark.read.parquet(path).where(F.col("bucket").isin(touched))
        own = fresh.select(*SERIES).distinct()
        same = [held[c].eqNullSafe(own[c]) for c in SERIES]
        whole = scratch_folder(spark, "buckets")
        held.join(own, same, "left_anti").select(*fresh.columns).unionByName(fresh).write.parquet(whole)
        whole = spark.read.parquet(whole)
    dealt = whole.repartition(len(touched) or 1, "bucket").sortWithinPartitions("bucket", *SERIES, date)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def upsert_reference(
    stored: DataFrame, incoming: DataFrame, keys: Sequence[str], values: Sequence[str], provenance: str = "fetch_id"
) -> DataFrame:
    """The reference table after an update on key (A15): the provenance column moves only if a value changed,
    null-safely."""
    old = stored.select(*keys, F.struct(*values, provenance).alias("__old"))
    new = incoming.select(*keys, F.struct(*values, provenance).alias("__new"))
    changed = F.lit(False)
    for v in values:
        changed = changed | ~F.col(f"__old.{v}").eqNullSafe(F.col(f"__new.{v}"))
    row = F.when(F.col("__new").isNull(), F.col("__old")).when(
        F.col("__old").isNull() | changed, F.col("__new")
    ).otherwise(F.col("__old"))
    return old.join(new, list(keys), "full").withColumn("__row", row).select(*keys, "__row.*")


def export_json(df: DataFrame) -> DataFrame:
    """Rows as JSON text (A17): decimals keep every digit, dates are ISO, a double that is not finite fails the job."""
    out = df
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            c = F.col(name)
            odd = F.isnan(c) | (F.abs(c) == float("inf"))
            out = out.withColumn(
                name, F.when(~odd | c.isNull(), c).otherwise(F.raise_error(F.lit(f"{name} is not finite")).cast(kind))
            )
    return out.select(
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd"}).alias("json")
    )


def keep_listed(rows: DataFrame, allowed: DataFrame, keys: Sequence[str] = ("source", "index_name")) -> DataFrame:
    """Rows whose name is on the allow list of their source."""
    return rows.join(allowed.select(*keys).distinct(), list(keys), "left_semi")


def content_addressed(raw: DataFrame, store: DataFrame, content: str = "content") -> DataFrame:
    """Each payload's digest and whether storing it would create something (A11): new bytes, counted once however
    often they come."""
    hashed = raw.withColumn("sha256", F.sha2(F.col(content).cast("binary"), 256)).withColumn(
        "byte_size", F.octet_length(content)
    )
    known = store.select("sha256").distinct().withColumn("__k", F.lit(True))
    per = hashed.groupBy("sha256").agg(F.first("byte_size").alias("byte_size"), F.count("*").alias("puts"))
    return per.join(known, "sha256", "left").select(
        "sha256", "byte_size", "puts", F.col("__k").isNull().alias("created")
    )


def verify_content(store: DataFrame, log: DataFrame, content: str = "content") -> DataFrame:
    """Violations of recorded size or digest against the stored bytes."""
    have = store.select(
        F.col("resource_key"),
        F.sha2(F.col(content).cast("binary"), 256).alias("__sha"),
        F.octet_length(content).alias("__size"),
    )
    j = log.join(have, "resource_key", "left")
    reason = F.when(F.col("__sha").isNull(), "missing").when(
        F.col("__size") != F.col("byte_size"), "size_differs"
    ).when(
        F.col("__sha") != F.col("sha256"), "digest_differs"
    )
    return j.withColumn("violation", reason).where("violation is not null").drop("__sha", "__size")
