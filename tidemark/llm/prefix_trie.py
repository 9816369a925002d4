"""Prefix trie of conversations by union-find over sorted neighbours.

A conversation is the sequence of its turns' 16-byte digests, joined; sequences are dealt by range and sorted, so that
those with a common prefix are neighbours. In a partition the common prefix lengths of neighbours are edges,
taken in descending depth: an edge of depth d joins the components on both sides under a branching node at depth d
(or under the node that one of them has there already). What comes out is the compressed trie; the turns between
two nodes of it are chain nodes with the same members.

A node is *closed* when it isn't a prefix of the partition's first or last sequence: no other partition can hold
a member of it. Closed nodes are final. The others, those along the two outer paths, are contracted to one item
each (its own members and the sums of its closed children), and sixteen neighbouring partitions' items go through
the same union-find again, until one group is left. No step gathers more than sixteen outer paths, and no node passes
through the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import MOST_PARTITIONS, listed, release_memory, written

#: Bytes of a turn's digest.
WIDTH = 16
#: Sequences of a partition, about, and contracted partitions that are merged at a time.
SEQUENCES_A_TASK, FAN_IN = 20_000, 16
#: Decimal ids that are put in one piece of text before it is hashed.
IDS_A_PIECE = 1_000

_NODE = [
    ("node", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent", pa.binary()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()),
]
_ITEM = [
    ("key", pa.binary()), ("sizes", pa.list_(pa.int64())), ("n", pa.int64()), ("least", pa.int64()),
    ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("first", pa.bool_()),
]
_OUT = pa.schema([("block", pa.int64()), ("level", pa.int32()), ("item", pa.struct(_ITEM)), ("found", pa.struct(_NODE))])
_OUT_SQL = (
    "block bigint, level int, item struct<key: binary, sizes: array<bigint>, n: bigint, least: bigint, children: bigint, "
    "leaves: bigint, saved: bigint, first: boolean>, found struct<node: binary, conv_id: bigint, depth: bigint, parent: binary, "
    "parent_conv_id: bigint, n_convs: bigint, n_children: bigint, n_leaves: bigint, saved_tokens: bigint>"
)


@dataclass(slots=True)
class Node:
    """A node of the compressed trie; its sums grow as children are put below it."""

    key: bytes
    sizes: np.ndarray
    n: int = 0
    least: int | None = None
    children: int = 0
    leaves: int = 0
    saved: int = 0
    first: bool = False  # whether it is the least sequence of its partition
    below: list[Node] = field(default_factory=list)

    @property
    def depth(self) -> int:
        return len(self.key) // WIDTH


def node_id(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _smaller(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def common_depth(a: bytes, b: bytes) -> int:
    """The turns that two sequences share from the first on."""
    most = min(len(a), len(b)) // WIDTH
    if a[: most * WIDTH] == b[: most * WIDTH]:
        return most
    x, y = (np.frombuffer(k, f"V{WIDTH}", most) for k in (a, b))
    return int(np.argmax(x != y))


def grow(items: list[Node]) -> Node:
    """The top of the compressed trie over sorted items, by edges between neighbours in descending depth."""
    edges = [common_depth(a.key, b.key) for a, b in zip(items, items[1:])]
    root, top = list(range(len(items))), list(items)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in sorted(range(len(edges)), key=lambda i: -edges[i]):
        depth, a, b = edges[i], find(i), find(i + 1)
        x, y = top[a], top[b]
        root[b] = a
        if x.depth > depth and y.depth > depth:
            top[a] = Node(x.key[: depth * WIDTH], x.sizes[:depth], below=[x, y])
        elif x.depth == y.depth:
            x.n, x.least = x.n + y.n, _smaller(x.least, y.least)
            x.children, x.leaves, x.saved = x.children + y.children, x.leaves + y.leaves, x.saved + y.saved
            x.below += y.below
        else:
            top[a], lower = (x, y) if x.depth == depth else (y, x)
            top[a].below.append(lower)
    return top[find(0)]


def settle(items: list[Node], last: bool) -> tuple[list[Node], list[list]]:
    """Items for the next level, and the rows of closed nodes; with ``last`` every node is closed.

    Own members and sums of an open node stay apart from those of its open children.
    """
    top = grow(items)
    # prefixes sort before what they begin, so the greatest item is the last sequence, but the least isn't the first one
    first_key, last_key = min(item.key for item in items if item.first), items[-1].key
    is_open = lambda key: not last and (first_key.startswith(key) or last_key.startswith(key))
    ordered, stack = [], [top]
    while stack:
        ordered.append(node := stack.pop())
        stack += node.below
    kept, rows = [], []
    for node in reversed(ordered):
        if is_open(node.key):
            down = [c for c in node.below if not is_open(c.key)]
            node.first = node.key == first_key
            kept.append(node)
        else:
            down = node.below
        node.children += len(down)
        for child in down:
            between = child.sizes[node.depth : child.depth - 1]
            node.n, node.least = node.n + child.n, _smaller(node.least, child.least)
            node.leaves += child.leaves
            node.saved += child.saved + (child.n - 1) * int(between.sum())
        if not is_open(node.key):
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * int(node.sizes[-1]) if node.depth else 0

    def chain(node: Node, above: int, parent: Node | None) -> None:
        """Rows of ``node`` and of the chain nodes between it and depth ``above``."""
        saved, key = node.saved, node.key
        for depth in range(node.depth, above, -1):
            # above is a chain node with the same members, then ``parent``; an open one is found later
            in_chain = depth - 1 > above
            later = node_id(key[: (depth - 1) * WIDTH]) if depth and not in_chain and parent is None else None
            up = node.least if in_chain and depth else parent.least if parent else None
            children = node.children if depth == node.depth else 1
            own = node_id(key[: depth * WIDTH])
            rows.append([own, node.least, depth, later, up, node.n, children, node.leaves, saved])
            if depth > 1:
                saved += (node.n - 1) * int(node.sizes[depth - 2])

    for node in ordered:
        shut = not is_open(node.key)
        for child in node.below:
            if shut or not is_open(child.key):
                chain(child, node.depth, node if shut else None)
    if not is_open(top.key):
        chain(top, -1, None)
    return sorted(kept, key=lambda n: n.key), rows


def _batch(block: int, level: int, kept: list[Node], rows: list[list]) -> pa.RecordBatch:
    items = [[n.key, n.sizes.tolist(), n.n, n.least, n.children, n.leaves, n.saved, n.first] for n in kept]
    columns = []
    for kind, own, before, after in ((_ITEM, items, 0, len(rows)), (_NODE, rows, len(items), 0)):
        fields = [pa.array([r[k] for r in own], t) for k, (_, t) in enumerate(kind)]
        full = pa.StructArray.from_arrays(fields, fields=[pa.field(*f) for f in kind])
        columns.append(pa.concat_arrays([pa.nulls(before, full.type), full, pa.nulls(after, full.type)]))
    n = len(items) + len(rows)
    head = [pa.array(np.full(n, block), pa.int64()), pa.array(np.full(n, level), pa.int32())]
    return pa.RecordBatch.from_arrays(head + columns, schema=_OUT)


def _first_level(sorted_rows: DataFrame, last: bool) -> DataFrame:
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, block = [], 0
        for batch in batches:
            block = batch["block"][0].as_py() if len(batch) else block
            keys, sizes, ids = batch["key"].to_pylist(), batch["sizes"], batch["conv_id"].to_pylist()
            ends, flat = sizes.offsets.to_numpy(), sizes.values.to_numpy(zero_copy_only=False)
            for i, (key, own) in enumerate(zip(keys, ids)):
                if items and items[-1].key == key:  # equal sequences are one item
                    items[-1].n, items[-1].least = items[-1].n + 1, _smaller(items[-1].least, own)
                else:
                    items.append(Node(key, flat[ends[i] : ends[i + 1]].copy(), 1, own))
        if items:
            items[0].first = True
            yield _batch(block, 0, *settle(items, last))
        release_memory()

    return sorted_rows.mapInArrow(apply, _OUT_SQL)


def _next_level(items: DataFrame, level: int, last: bool) -> DataFrame:
    def apply(group: pa.Table) -> pa.Table:
        rows = group.select(["item"]).to_pylist()
        items = sorted((r["item"] for r in rows), key=lambda item: item["key"])
        nodes = [Node(**{**item, "sizes": np.array(item["sizes"], np.int64)}) for item in items]
        return pa.Table.from_batches([_batch(group["block"][0].as_py(), level, *settle(nodes, last))])

    grouped = items.select((F.col("block") / FAN_IN).cast("bigint").alias("block"), "item").groupBy("block")
    return grouped.applyInArrow(apply, _OUT_SQL)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns: array of (digest, size)) of every conversation: one row each, its turns by turn (null first), those
    of one turn by role and digest, all kept.

    The digest is that of role and text (null: empty), the size that of the text in UTF-8 bytes. Texts are reduced to these
    before the shuffle. Rows with a null conv_id are one conversation. Other columns are not read.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.select(
        "conv_id",
        F.struct(
            "turn", role.alias("role"), F.substring(F.unhex(whole), 1, WIDTH).alias("digest"),
            F.octet_length(text).alias("size"),
        ).alias("t"),
    )
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    short = F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size")))
    return turns.select("conv_id", short.alias("turns"))


def with_shared_heads(sequences: DataFrame, group: int = 5, most: int = 8) -> DataFrame:
    """``sequences`` (conv_id, turns) rebuilt: the first h turns of conversation ``c - c % group`` (all if it has fewer,
    none if there is none), then c's own turns after its first h; h is crc32 of the decimal c modulo ``most + 1``.

    A row with a null conv_id keeps its turns.
    """
    own, h = F.col("conv_id"), F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    rows = sequences.withColumn("__base", own - own % group).withColumn("__h", F.coalesce(h, F.lit(0)).cast("int"))
    heads = sequences.where(own % group == 0).select(own.alias("__of"), F.slice("turns", 1, most).alias("__head"))
    both = rows.join(heads, F.col("__base") == F.col("__of"), "left")
    head = F.slice(F.coalesce("__head", F.slice("turns", 1, 0)), F.lit(1), F.col("__h"))
    rest = F.slice("turns", F.col("__h") + 1, F.size("turns"))
    return both.select("conv_id", F.concat(head, rest).alias("turns"))


def prefix_trie(sequences: DataFrame, id_col: str = "conv_id", turns_col: str = "turns") -> tuple[DataFrame, DataFrame]:
    """The trie of ``sequences`` (id, turns: array of (digest, size)): its nodes, and (id, node) of every row, the node
    at which the row ends. Both are written tables.

    Nodes are (node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens): a digest of the prefix,
    the smallest member's id, the number of turns, the parent's conv_id (null for the root), members, children,
    childless nodes at or below it, and the sum over the nodes at or below it of (members - 1) times the size
    of the last turn. A row whose turns are null has none. The root is the empty prefix and the parent of all first turns; a row without turns ends there. Rows
    that repeat are members each; a null id is a member, but the smallest only where no other is. No rows, no nodes.
    A sequence's digests are kept as they are, so it is bounded by what a row may hold.
    """
    digests = F.array_join(F.transform(turns_col, lambda t: F.hex(t["digest"])), "")
    sizes = F.transform(turns_col, lambda t: t["size"].cast("bigint"))
    keyed = sequences.select(
        F.col(id_col).alias("conv_id"),
        F.unhex(F.coalesce(digests, F.lit(""))).alias("key"),
        F.coalesce(sizes, F.array().cast("array<bigint>")).alias("sizes"),
    )
    keyed = written(keyed, "trie-sequences")
    parts = min(max(1, math.ceil(keyed.count() / SEQUENCES_A_TASK)), MOST_PARTITIONS)
    # equal sequences are parted by their ids, so that a very common one is spread
    dealt = keyed.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    dealt = dealt.withColumn("block", F.spark_partition_id().cast("bigint"))
    blocks, level, levels = parts, 0, []
    levels.append(written(_first_level(dealt, parts == 1), "trie-level-0"))
    while blocks > 1:
        blocks, level = math.ceil(blocks / FAN_IN), level + 1
        open_items = levels[-1].where("item is not null").select("block", "item")
        levels.append(written(_next_level(open_items, level, blocks == 1), f"trie-level-{level}"))
    found = levels[0]
    for more in levels[1:]:
        found = found.unionByName(more)
    rows = found.where("found is not null").select("level", "found.*")
    upper = rows.where("level > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("up"))
    joined = rows.where("parent is not null").join(listed(upper), "parent").withColumn("parent_conv_id", F.col("up"))
    columns = [n for n, _ in _NODE if n != "parent"]
    nodes = written(rows.where("parent is null").select(columns).unionByName(joined.select(columns)), "trie-nodes")

    def ends(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for keys in batches:
            yield pa.array([node_id(k) for k in keys.to_pylist()], pa.binary())

    ended = keyed.select("conv_id", F.arrow_udf(ends, "binary")("key").alias("node"))
    return nodes, written(ended, "trie-ends")


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which rows of ``ends`` (conv_id, node) end: the SHA-256 of their decimal ids,
    ascending and joined by commas; null ids are left out.

    The digest runs through the ids one after another, by definition; so that a node of very many ids costs little in one
    task, they are sorted and put into text by range, ``IDS_A_PIECE`` to a piece, and only pieces meet.
    """
    parts = min(max(1, math.ceil(ends.count() / SEQUENCES_A_TASK)), MOST_PARTITIONS)
    ordered = ends.where("conv_id is not null").repartitionByRange(parts, "node", "conv_id")
    ordered = ordered.sortWithinPartitions("node", "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids = batch["node"].to_pylist(), batch["conv_id"].to_pylist()
            cuts = [0] if ids else []
            for i in range(1, len(ids)):
                if nodes[i] != nodes[i - 1] or i - cuts[-1] == IDS_A_PIECE:
                    cuts.append(i)
            spans = list(zip(cuts, cuts[1:] + [len(ids)]))
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array([nodes[a] for a, _ in spans], pa.binary()),
                    "first": pa.array([ids[a] for a, _ in spans], pa.int64()),
                    "last": pa.array([ids[z - 1] for _, z in spans], pa.int64()),
                    "piece": pa.array([",".join(map(str, ids[a:z])) for a, z in spans], pa.string()),
                }
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []
        for batch in batches:
            for own, piece in zip(batch["node"].to_pylist(), batch["piece"].to_pylist()):
                if own != node:
                    done += [(node, state.hexdigest())] if state else []
                    node, state = own, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            if len(done) > 10_000:
                yield _pairs(done)
                done = []
        yield _pairs(done + ([(node, state.hexdigest())] if state else []))

    def _pairs(rows: list) -> pa.RecordBatch:
        node, value = ([r[k] for r in rows] for k in (0, 1))
        return pa.RecordBatch.from_pydict({"node": pa.array(node, pa.binary()), "ends_sha256": pa.array(value, pa.string())})

    cut = ordered.mapInArrow(pieces, "node binary, first bigint, last bigint, piece string")
    met = cut.repartition("node").sortWithinPartitions("node", "first", "last")
    return met.mapInArrow(digest, "node binary, ends_sha256 string")
