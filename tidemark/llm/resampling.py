"""Importance resampling of documents towards a target.

Hashed word unigrams and bigrams give two generative models, one of the target texts and one of all
texts. A text's weight is the log ratio of its probability under them; Gumbel noise is added and the
k largest keys are kept, which samples k texts without replacement in proportion to their weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_LOWER, SLICE, sample_rows, text_udf, written

#: Word hashes kept in a task; beyond it the cache starts anew (results don't change).
CACHE_WORDS = 300_000


@dataclass(frozen=True)
class ResamplingRules:
    """Hash buckets, share of rows to keep, seed of the noise, bound on target rows, and the length that a text's
    log ratio is scaled to (None: the log ratio of the whole text; n: its mean times n, so that length doesn't
    count)."""

    buckets: int = 1 << 16
    keep: float = 0.8
    seed: int = 11
    fit_rows: int = 40_000
    length: int | None = None
    smoothing: float = 0.5


class HashedGrams:
    """Bucket numbers of a text's unigrams and bigrams."""

    def __init__(self, buckets: int):
        self.buckets = np.uint64(buckets)
        self.known: dict[bytes, int] = {}

    def of(self, text: str) -> np.ndarray:
        words = text.encode().translate(ASCII_LOWER).split()
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = set(words)
        for w in new:
            self.known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ h[1:]
        pairs = (pairs ^ (pairs >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (np.concatenate([h, pairs]) >> np.uint64(20)) % self.buckets


def fit(
    docs: DataFrame,
    target_ids: DataFrame,
    rules: ResamplingRules | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> np.ndarray:
    """Log ratio of the target's and all texts' probability of each bucket.

    All documents are counted for the raw model, those of ``target_ids`` (at most about ``rules.fit_rows``, which
    bounds what is broadcast) for the target. Two numbers a bucket reach the driver.
    """
    rules = rules or ResamplingRules()
    ids = sample_rows(
        target_ids.select(F.col(target_ids.columns[0]).alias("__target")).where("__target is not null").distinct(),
        "__target",
        rules.fit_rows,
    )
    marked = docs.select(id_col, text_col).join(F.broadcast(ids), F.col(id_col) == F.col("__target"), "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, raw, target = HashedGrams(rules.buckets), np.zeros(rules.buckets, np.int64), np.zeros(
            rules.buckets, np.int64
        )
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                texts, chosen = (c.slice(at, SLICE).to_pylist() for c in batch.columns)
                for counts, some in ((raw, texts), (target, [t for t, c in zip(texts, chosen) if c])):
                    if found := [grams.of(t) for t in some if t]:
                        counts += np.bincount(np.concatenate(found), minlength=rules.buckets)
        used = np.flatnonzero(raw)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])],
                ["bucket", "raw", "target"],
            )

    parts = marked.select(text_col, F.col("__target").isNotNull().alias("chosen")).mapInArrow(
        count, "bucket int, raw bigint, target bigint"
    )
    table = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.full(rules.buckets, rules.smoothing), np.full(rules.buckets, rules.smoothing)
    if len(table):
        raw[table["bucket"]] += table["raw"].to_numpy(float)
        target[table["bucket"]] += table["target"].to_numpy(float)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(
    docs: DataFrame,
    ratios: np.ndarray,
    rules: ResamplingRules | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, log_weight, key): null weight and key for texts without words."""
    rules = rules or ResamplingRules()

    def make():
        grams = HashedGrams(rules.buckets)

        def weight(text: str | None) -> float | None:
            at = grams.of(text) if text else ()
            if not len(at):
                return None
            total = float(ratios[at].sum())
            return total if rules.length is None else total / len(at) * rules.length

        return lambda texts: pa.array([weight(t) for t in texts], pa.float64())

    own = F.when(F.col(id_col).isNull(), F.xxhash64(F.col(text_col))).otherwise(F.xxhash64(F.col(id_col)))
    unit = (F.pmod(F.xxhash64(own, F.lit(rules.seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    noise = (-F.log(-F.log(unit))).alias("noise")
    weighed = docs.select(F.col(id_col), noise, text_udf(make, "double")(F.col(text_col)).alias("log_weight"))
    return weighed.select(id_col, "log_weight", (F.col("log_weight") + F.col("noise")).alias("key"))


def kth_largest(rows: DataFrame, column: str, k: int, buckets: int = 4096, enough: int = 10_000) -> float:
    """The exact k-th largest value of a column without nulls (k from 1 to the number of rows).

    Each round counts the values of an ever narrower range in equal slices; only the counts reach the
    driver. When at most ``enough`` values are left, they are looked at one by one.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    above = 0
    while low < high:
        inside = rows.where(F.col(column).between(low, high))
        width = (high - low) / buckets
        slices = F.least(F.floor((F.col(column) - low) / width), F.lit(buckets - 1)).alias("slice")
        stats = inside.groupBy(slices).agg(
            F.count("*").alias("n"), F.min(column).alias("a"), F.max(column).alias("z")
        ).orderBy(F.desc("slice")).collect()
        for row in stats:
            if above + row.n >= k:
                break
            above += row.n
        if row.n <= enough:
            values = sorted(
                (r[0] for r in rows.where(F.col(column).between(row.a, row.z)).select(column).collect()), reverse=True
            )
            return values[k - above - 1]
        low, high = row.a, row.z
    return low


def resample(
    docs: DataFrame,
    target_ids: DataFrame,
    rules: ResamplingRules | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, log_weight, key, selected) of every row of ``docs``.

    ``selected`` marks the k = round(keep x rows) largest keys; texts without words have no key and are never
    selected. Rows with a key equal to the k-th are all selected, so repeated rows are treated alike. Noise
    depends on the id and seed alone (without an id on the text and seed). Other columns are not read; an
    empty table gives an empty table, an empty target gives every text the weights of the smoothing alone.
    """
    rules = rules or ResamplingRules()
    ratios = fit(docs, target_ids, rules, id_col, text_col)
    weighed = written(weigh(docs, ratios, rules, id_col, text_col), "resampling")
    total, keyed = weighed.agg(F.count("*"), F.count("key")).first()
    k = min(round(rules.keep * total), keyed)
    bar = kth_largest(weighed.where("key is not null"), "key", k) if k else None
    chosen = F.coalesce(F.col("key") >= F.lit(bar), F.lit(False)) if k else F.lit(False)
    return weighed.withColumn("selected", chosen)
