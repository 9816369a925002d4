"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments, so that of two fingerprints at distance two or
less at least one segment differs by at most one bit. Every segment is indexed under its 32
one-wildcard variants (one bit left open); fingerprints that share a variant are candidates and
are verified on all 64 bits.

A variant shared by two to ``PAIRED`` fingerprints gives its pairs directly. A variant shared by more
("crowded") is never expanded into pairs: its members are linked exactly through *ball centres*.
Two fingerprints are within two bits of each other if and only if some 64-bit value is within one
bit of both, so all members of a centre are truly linked and a star from each member to the
centre's smallest member keeps every connection with a linear number of edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_LOWER, listed, spread, struct_array, text_udf, written
from tidemark.llm.components import connected_components

BITS, SEGMENTS, MAX_DISTANCE, SHINGLE, SEED = 64, 2, 2, 3, 42
SEGMENT_BITS = BITS // SEGMENTS
#: Fingerprints of a variant that are compared in pairs at most; this many make under half as many pairs each.
PAIRED = 8
#: Fingerprints that a task expands into 64 variants each.
FINGERPRINTS_A_TASK = 16_000


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text: bit b is 1 if over half the shingles' hashes set it.

    Shingles are ``shingle`` words joined by a space, repeats included; a shorter text is one
    shingle; a text without words (or null) has fingerprint zero.
    """
    words = text.encode().translate(ASCII_LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:z], SEED) for a, z in zip(starts, ends[size - 1 :].tolist())]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of unsigned 64-bit hashes: the bits that over half of them have."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = bits.sum(0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, *more: str
) -> DataFrame:
    """(id, fp) and the columns ``more``: the fingerprint of every row as a signed 64-bit long; nothing is shuffled."""

    def make():
        return lambda texts: struct_array(
            {"fp": (np.array([simhash(t, shingle) for t in texts], np.uint64).view(np.int64), pa.int64())}
        )

    found = text_udf(make, "struct<fp: bigint>")(F.col(text_col)).alias("f")
    return docs.select(F.col(id_col), *more, found).select(id_col, "f.fp", *more)


def _variants(fps: DataFrame) -> DataFrame:
    """(key, fp): bits 32-37 of a key number the open bit, its low 32 bits are the rest of the segment."""
    key = F.expr(
        f"explode(transform(sequence(0, {BITS - 1}), i -> (cast(i as bigint) << {SEGMENT_BITS}) | " f"(shiftrightunsigned(fp, (i div {SEGMENT_BITS}) * {SEGMENT_BITS}) & 4294967295L & ~(1L << (i % {SEGMENT_BITS})))))"
    )
    return fps.select(key.alias("key"), "fp")


def _centres(fps: DataFrame) -> DataFrame:
    """(centre, fp): the fingerprint itself and its 64 one-bit neighbours."""
    return fps.select(
        F.expr(f"explode(concat(array(fp), transform(sequence(0, {BITS - 1}), i -> fp ^ (1L << i))))").alias("centre"),
        "fp",
    )


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """(a, b) with a > b: links among distinct fingerprints whose connected components are those of
    "two or fewer bits differ". ``fps`` (a written table) has one column ``fp`` without repeats.

    Fingerprints are dealt by number before they are expanded. Variants are counted with a map-side combine, so
    one that many fingerprints share isn't gathered; those that share a crowded one are found where they lie, by the
    list of crowded variants if it is short, else by a merge join that adaptive execution splits where a variant is hot.
    """
    variants = _variants(spread(fps, FINGERPRINTS_A_TASK))
    counted = variants.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("b"), F.max("fp").alias("a"))
    shared = written(counted.where("n > 1"), "simhash-shared")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE
    pairs = shared.where("n = 2").where(near).select("a", "b")
    keys = shared.where("n > 2").select("key", "n")
    members = written(variants.join(listed(keys), "key").select("key", "n", "fp"), "simhash-members")
    few = members.where(F.col("n") <= PAIRED).groupBy("key").agg(F.collect_list("fp").alias("x"))
    within = F.expr(
        "filter(flatten(transform(x, p -> transform(x, q -> struct(p as a, q as b)))), "
        f"y -> y.a > y.b and bit_count(y.a ^ y.b) <= {MAX_DISTANCE})"
    )
    pairs = pairs.unionByName(few.select(F.inline(within)))
    crowded = written(members.where(F.col("n") > PAIRED).select("fp").distinct(), "simhash-crowded")
    centres = _centres(spread(crowded, FINGERPRINTS_A_TASK))
    least = centres.groupBy("centre").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    stars = centres.join(least.select("centre", "b").hint("merge"), "centre").where("fp > b")
    return pairs.unionByName(stars.select(F.col("fp").alias("a"), "b")).distinct()


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, text_hash, fp, component_id) of every row of ``docs``."""
    prints = fingerprints(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")),
        "id",
        "text",
        shingle,
        "text_hash",
    )
    rows = written(prints, "simhash-rows")
    distinct = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = connected_components(fingerprint_links(distinct.select("fp"))).hint("merge")
    root = F.coalesce("root", "fp").alias("root")
    linked = written(
        distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", root), "simhash-linked"
    )
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = written(
        linked.join(smallest.hint("merge"), "root").select("fp", "component_id", "root"), "simhash-classes"
    )
    return rows.join(classes.hint("merge"), "fp")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` is the smallest id reachable over
    links of two or fewer differing bits, itself included. Rows with equal fingerprints are linked;
    null and wordless texts share fingerprint zero and are linked like any other. Ids may repeat
    (each row is kept); a null id is kept and is never the smallest id unless its whole component has
    null ids. Other columns of ``docs`` are not read. An empty table gives an empty table.

    Work is done on distinct fingerprints, so a group of copies of any size counts once.
    """
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return _classes(docs, id_col, text_col, shingle).select(F.col("id").alias(id_col), fingerprint, "component_id")


def keep_representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``docs`` with one row of each component (see ``keep_one``), every column as it is."""
    classes = _classes(docs, id_col, text_col, shingle).select("id", "text_hash", F.col("root").alias("component"))
    return keep_one(docs, classes, id_col, text_col)


def keep_one(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with one row of each component of ``classes`` (id, text_hash, component; a row for every row of
    ``docs``).

    The row with the smallest id stays (null ids last; of equal ids that with the smallest hash of its text; of
    rows equal in both any one, chosen by the values of all columns). Only ids and hashes are gathered; the rows to go
    are joined back by both, those that must be thinned out are few columns wide until then.
    """
    classes = written(classes, "copies-members")
    order = F.struct(F.col("id").isNull(), "id", "text_hash")
    best = classes.groupBy("component").agg(F.min(order).alias("best"), F.count("*").alias("n"))
    joined = classes.join(best.where("n > 1").hint("merge"), "component").select(
        "id", "text_hash", (order == F.col("best")).alias("stays")
    )
    counted = written(
        joined.groupBy("id", "text_hash").agg(F.max("stays").alias("stays"), F.count("*").alias("n")), "copies-counted"
    )
    gone = counted.where("not stays").select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"))
    again = counted.where("stays and n > 1").select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"))
    same = docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__hash"))

    kept = docs.join(listed(gone), same, "left_anti")
    if again.isEmpty():
        return kept
    repeats = kept.join(listed(again), same, "left_semi")
    row = F.struct(*[F.col(c) for c in docs.columns])
    one = repeats.groupBy(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__hash"))
    thinned = one.agg(F.min_by(row, F.to_json(row)).alias("__row")).select("__row.*")
    return kept.join(listed(again), same, "left_anti").unionByName(thinned)
