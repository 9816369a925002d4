"""Near copies by the Jaccard similarity of word-shingle sets.

A text is the set of its five-word shingles (64-bit hashes). Texts with equal sets are one *node*.
The SimHash operator (``llm.simhash``: deletion variants, at most two of 64 bits) gives the first candidates, from
the fingerprints of these sets. At similarity 0.8 about ten bits differ, beyond what segments with one open bit can
index, so nodes that share one of 32 bands of five MinHash values with another are candidates too; among these, pairs
that share a shingle of their prefixes (the rarest fifth) are taken. All pairs are verified on the whole sets, so a
link is exact. Missed is only what neither finds: two texts of similarity s share no band with probability
(1 - s^5)^32, 3e-6 at 0.8, less above.

A shingle shared by many nodes is not expanded into pairs: its nodes are compared first with the one that has the
fewest rarer shingles. After that only pairs whose nodes are still in different components are compared, all of them,
so the components are those of all links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_LOWER, listed, struct_array, text_udf, written
from tidemark.llm.components import connected_components
from tidemark.llm.simhash import fingerprint_links, keep_one, majority

SHINGLE, SIMILARITY, BANDS, ROWS, SEED = 5, 0.8, 32, 5, 42
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; a shorter text is one shingle, a wordless one has none."""
    words = text.encode().translate(ASCII_LOWER).split() if text else []
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist() if words else []
    digest = xxhash.xxh64_intdigest
    return np.unique(
        np.array([digest(joined[a:z], SEED) for a, z in zip(starts, ends[max(size, 1) - 1 :].tolist())], np.uint64)
    )


class MinHash:
    """Band keys of shingle sets."""

    def __init__(self) -> None:
        rng = np.random.default_rng(SEED)
        self.factors, self.offsets = (rng.integers(0, 1 << 32, BANDS * ROWS, np.uint32) for _ in range(2))
        self.factors |= np.uint32(1)

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(BANDS * ROWS, (1 << 32) - 1, np.uint32)
        for at in range(0, len(low), 512):
            least = np.minimum(least, (low[at : at + 512, None] * self.factors + self.offsets).min(0))
        keys = np.arange(BANDS, dtype=np.uint64)
        for column in least.reshape(BANDS, ROWS).T:
            keys = (keys ^ column) * _MIX
            keys ^= keys >> np.uint64(29)
        return keys.view(np.int64)


def _signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, text_hash, node, bands, fp): node is the digest of the shingle set, fp its SimHash fingerprint; a wordless
    text has no bands."""

    def make():
        minhash = MinHash()

        def work(texts: list) -> pa.Array:
            sets = [shingle_set(t, shingle) for t in texts]
            nodes = np.array([xxhash.xxh3_64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            return struct_array(
                {
                    "node": (nodes, pa.int64()),
                    "bands": ([minhash.bands(s) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                    "fp": (np.array([majority(s) if len(s) else 0 for s in sets], np.uint64).view(np.int64), pa.int64()),
                }
            )

        return work

    found = text_udf(make, "struct<node: bigint, bands: array<bigint>, fp: bigint>")(F.col(text_col))
    return docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), found.alias("f")
    ).select("id", "text_hash", "f.node", "f.bands", "f.fp")


def _sets(docs: DataFrame, of: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(node, shingles) of the nodes of ``of`` (node, id, text_hash), each from the text of its own row."""

    def make():
        return lambda texts: pa.array([shingle_set(t, shingle).view(np.int64) for t in texts], pa.list_(pa.int64()))

    texts = docs.select(
        F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__hash"), F.col(text_col).alias("__text")
    )
    own = texts.join(listed(of), F.col("__id").eqNullSafe(F.col("id")) & (F.col("__hash") == F.col("text_hash")))
    found = written(own.select("node", text_udf(make, "array<bigint>")(F.col("__text")).alias("shingles")), "copies-sets")
    # Only rows that repeat in id and text give a node twice; sets are not shuffled for them unless there are any.
    return found if found.count() == of.count() else written(found.dropDuplicates(["node"]), "copies-sets")


def _simhash_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b) with a > b: the nodes that SimHash's deletion variants link, each by the least node of its fingerprint."""
    least = written(nodes.groupBy("fp").agg(F.min("node").alias("least")), "copies-prints")
    same = nodes.join(least.hint("merge"), "fp").where("node <> least").select(F.col("node").alias("x"), F.col("least").alias("y"))
    links = fingerprint_links(least.select("fp")).join(least.toDF("a", "x").hint("merge"), "a")
    links = links.join(least.toDF("b", "y").hint("merge"), "b").select("x", "y")
    return same.unionByName(links).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity."""
    pairs = written(pairs.distinct(), "copies-pairs")
    named = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = sets.join(listed(written(named, "copies-named")), "node", "left_semi")
    both = pairs.join(sets.toDF("a", "x").hint("merge"), "a").join(sets.toDF("b", "y").hint("merge"), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common * (1 + similarity) >= (F.size("x") + F.size("y")) * similarity - 1e-9).select("a", "b")


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(shingle, node, size, at): the rarest shingles of each set, at least one of which any similar set shares.

    Ordered by rarity, two sets of the similarity meet within their first (1 - similarity) * size + 1 shingles.
    """
    each = sets.select("node", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    counts = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    # Shingles of one set alone come first and meet no other: only their number is needed.
    ordered = each.join(counts.hint("merge"), "shingle").groupBy("node", "size").agg(
        F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("x")
    )
    prefix = F.col("size") - F.ceil(F.col("size") * similarity - 1e-9) + 1
    alone = F.col("size") - F.size("x")
    shared = F.slice("x", F.lit(1), F.greatest(prefix - alone, F.lit(0)).cast("int"))
    rows = ordered.select("node", "size", alone.alias("alone"), F.posexplode(shared).alias("at", "x"))
    return rows.select(F.col("x.shingle").alias("shingle"), "node", "size", (F.col("alone") + F.col("at")).alias("at"))


def _pairs(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b) with a > b: the pairs of ``rows`` that can reach the similarity if the row's shingle is their first
    common one."""
    need = (F.col("size") + F.col("other_size")) * (similarity / (1 + similarity)) - 1e-9
    able = F.least(F.col("size") - F.col("at"), F.col("other_size") - F.col("other_at")) >= need
    return rows.where((F.col("node") != F.col("other")) & able).select(
        F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")
    ).distinct()


def _linked(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float
) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, node) of every row, and (node, root) of the linked nodes."""
    rows = written(_signatures(docs, id_col, text_col, shingle), "copies-rows")
    nodes = written(rows.where(F.size("bands") > 0).dropDuplicates(["node"]), "copies-nodes")
    bands = nodes.select(F.explode("bands").alias("band"), "node").repartition("band")
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    simhash_pairs = written(_simhash_pairs(nodes.select("node", "fp")), "copies-simhash")
    ends = [simhash_pairs.select(F.col(c).alias("node")) for c in ("a", "b")]
    near = bands.join(shared.hint("merge"), "band", "left_semi").select("node")
    near = near.unionByName(ends[0]).unionByName(ends[1]).distinct()
    of = written(nodes.join(near.hint("merge"), "node", "left_semi").select("node", "id", "text_hash"), "copies-of")
    sets = _sets(docs, of, id_col, text_col, shingle)
    members = written(_prefixes(sets, similarity), "copies-members")
    least = members.groupBy("shingle").agg(F.min(F.struct("at", "node", "size")).alias("y")).select(
        "shingle", F.col("y.node").alias("other"), F.col("y.size").alias("other_size"), F.col("y.at").alias("other_at")
    )
    compared = _pairs(members.join(least.hint("merge"), "shingle"), similarity).unionByName(simhash_pairs)
    stars = written(_verified(compared, sets, similarity), "copies-stars")
    roots = written(connected_components(stars), "copies-roots")
    placed = members.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = placed.groupBy("shingle", "root").agg(F.count("*").alias("n"))
    largest = parts.groupBy("shingle").agg(
        F.max(F.struct("n", "root"))["root"].alias("largest"), F.count("*").alias("parts")
    ).where("parts > 1").select("shingle", "largest")
    mixed = written(placed.join(largest.hint("merge"), "shingle"), "copies-mixed")
    apart = mixed.where("root <> largest").select(
        "shingle", *[F.col(c).alias(f"other_{c}") for c in ("size", "at", "root")], F.col("node").alias("other")
    )
    rest = _pairs(mixed.join(apart.hint("merge"), "shingle").where("root <> other_root"), similarity)
    links = stars.unionByName(written(_verified(rest, sets, similarity), "copies-rest"))
    return rows, connected_components(links)


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(id, component_id) for every row: the smallest id reachable over pairs of at least ``similarity``.

    Null and wordless texts are one class. Ids may repeat; a null id is kept and is never the smallest
    unless its whole component has null ids. Other columns are not read. An empty table gives an empty table.
    """
    rows, roots = _linked(docs, id_col, text_col, shingle, similarity)
    linked = rows.groupBy("node").agg(F.min("id").alias("least")).join(roots.hint("merge"), "node", "left").select(
        "node", "least", F.coalesce("root", "node").alias("root")
    )
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = written(linked.join(smallest.hint("merge"), "root").select("node", "component_id"), "copies-classes")
    return rows.join(classes.hint("merge"), "node").select(F.col("id").alias(id_col), "component_id")


def keep_representatives(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``docs`` with one row of each component of near copies (see ``simhash.keep_one``), every column as it is."""
    rows, roots = _linked(docs, id_col, text_col, shingle, similarity)
    placed = rows.join(roots.hint("merge"), "node", "left")
    return keep_one(
        docs, placed.select("id", "text_hash", F.coalesce("root", "node").alias("component")), id_col, text_col
    )
