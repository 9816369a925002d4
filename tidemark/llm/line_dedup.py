"""Line deduplication by a sharded minimal perfect hash over line hashes.

A line's key is the line stripped of blanks at both ends with A-Z lower-cased. Keys of ``min_chars`` code points
are hashed to 128 bits and counted by documents; hashes found in ``min_docs`` documents are dealt to shards by
their bits, and each shard gets a minimal perfect hash: levels of bit arrays in which a hash that has a place of its own
sets a bit and all others go on to the next level; the rank of its bit is its number. At that number stand three
arrays: a 64-bit fingerprint, the number of documents, and the largest id that holds the line. Lines that fewer documents
hold can't be dropped and have no place; the fingerprint tells them apart from those that have.

Documents probe the arrays where they lie: lines are never joined. An index of up to ``RESIDENT_BYTES`` goes to every
task; beyond it hashes (never texts) are dealt to the shards, each of which is dealt as often as its probes need.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_LOWER, SLICE, listed, release_memory, struct_array, written

MIN_CHARS, MIN_DOCS = 40, 5
#: Keys of a shard, on average.
KEYS_A_SHARD = 65_536
#: Bits of a level for each of its keys.
LOAD = 1.5
#: An index up to this size is broadcast (about 21 bytes a key).
RESIDENT_BYTES = 64 << 20
#: Probes that a task of the dealt way takes, about.
PROBES_A_TASK = 1_000_000
BLANKS = " \t\n\v\f\r"
#: A null id: smaller than any other.
NO_ID = -(1 << 63)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(29))
_HASH = pa.struct([("hi", pa.int64()), ("lo", pa.int64())])
SHARD_SCHEMA = "shard int, n int, sizes array<int>, words binary, ranks binary, prints binary, counts binary, last binary"


def line_digests(lines: list[str], min_chars: int) -> tuple[list[int], list[bytes]]:
    """The numbers of the lines whose key is long enough, and the 16-byte digests of these keys."""
    at, digests = [], []
    digest = xxhash.xxh3_128_digest
    for i, line in enumerate(lines):
        if len(line) >= min_chars and len(key := line.strip(BLANKS)) >= min_chars:
            at.append(i)
            digests.append(digest(key.encode().translate(ASCII_LOWER)))
    return at, digests


def _halves(digests: list[bytes]) -> np.ndarray:
    """(n, 2) unsigned halves of the digests."""
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


def _place(pairs: np.ndarray, level: int, size: int) -> np.ndarray:
    x = (pairs[:, 1] ^ (pairs[:, 0] * np.uint64(2 * level + 1))) * _MIX[0]
    x = (x ^ (x >> _MIX[2])) * _MIX[1]
    return (x ^ (x >> _MIX[2])) % np.uint64(size)


class PerfectHash:
    """A minimal perfect hash over distinct 128-bit keys, (n, 2) unsigned halves."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, ranks: np.ndarray):
        self.sizes, self.words, self.ranks = sizes, words, ranks

    @classmethod
    def over(cls, pairs: np.ndarray) -> PerfectHash:
        left, sizes, words = pairs, [], [np.zeros(0, np.uint64)]
        while len(left):
            size = 64 * max(1, math.ceil(len(left) * LOAD / 64))
            at = _place(left, len(sizes), size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[at]]
        joined = np.concatenate(words)
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(joined), dtype=np.int64)]).astype(np.uint32)
        return cls(np.array(sizes, np.int32), joined, ranks)

    def __call__(self, pairs: np.ndarray) -> np.ndarray:
        """The number of each key; any number or -1 for others."""
        found = np.full(len(pairs), -1, np.int64)
        pending, base = np.arange(len(pairs)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = _place(pairs[pending], level, size)
            word, bit = (at >> np.uint64(6)).astype(np.int64) + base, at & np.uint64(63)
            here = self.words[word]
            hit = (here >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(here & ((np.uint64(1) << bit) - np.uint64(1)))
            found[pending[hit]] = (self.ranks[word] + below)[hit]
            pending, base = pending[~hit], base + size // 64
        return found


class Shard:
    """A perfect hash with the arrays that it numbers."""

    def __init__(self, row: dict):
        view = lambda name, kind: np.frombuffer(row[name], kind)
        self.hash = PerfectHash(np.array(row["sizes"], np.int32), view("words", "<u8"), view("ranks", "<u4"))
        self.prints, self.counts, self.last = view("prints", "<u8"), view("counts", "<u4"), view("last", "<i8")

    @staticmethod
    def row(shard: int, pairs: np.ndarray, counts: np.ndarray, last: np.ndarray) -> dict:
        """The shard over distinct ``pairs`` as a row of ``SHARD_SCHEMA``."""
        made = PerfectHash.over(pairs)
        order = np.empty(len(pairs), np.int64)
        order[made(pairs)] = np.arange(len(pairs))
        most = np.minimum(counts, (1 << 32) - 1).astype("<u4")
        arrays = made.words, made.ranks, pairs[order, 1], most[order], last[order]
        names = ("words", "ranks", "prints", "counts", "last")
        return {"shard": shard, "n": len(pairs), "sizes": made.sizes.tolist()} | {
            k: a.tobytes() for k, a in zip(names, arrays)
        }

    def falls(self, pairs: np.ndarray, ids: np.ndarray, min_docs: int) -> np.ndarray:
        """Whether each line is dropped: held by ``min_docs`` documents, and by one with a larger id."""
        at = self.hash(pairs)
        known = (at >= 0) & (self.prints[at] == pairs[:, 1])
        return known & (self.counts[at] >= min_docs) & (self.last[at] != ids)


def shard_of(pairs: np.ndarray, shards: int) -> np.ndarray:
    return ((pairs[:, 0] >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


class Index:
    """All shards of a small index."""

    def __init__(self, rows: list[dict], shards: int):
        self.shards, self.parts = shards, {r["shard"]: Shard(r) for r in rows}

    def falls(self, pairs: np.ndarray, ids: np.ndarray, min_docs: int) -> np.ndarray:
        out, of = np.zeros(len(pairs), bool), shard_of(pairs, self.shards)
        order = np.argsort(of, kind="stable")
        cuts = np.flatnonzero(np.diff(of[order])) + 1
        for part in np.split(order, cuts) if len(order) else []:
            if (own := self.parts.get(int(of[part[0]]))) is not None:
                out[part] = own.falls(pairs[part], ids[part], min_docs)
        return out


def _hashed(docs: DataFrame, id_col: str, text_col: str, min_chars: int, *more: str) -> DataFrame:
    """(id, hi, lo) and the columns ``more``: the distinct long lines of every row as hashes."""

    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                offsets, digests = [0], []
                for text in batch.slice(at, SLICE).to_pylist():
                    digests += set(line_digests(text.split("\n"), min_chars)[1]) if text else ()
                    offsets.append(len(digests))
                halves = _halves(digests).view(np.int64)
                both = [pa.array(np.ascontiguousarray(halves[:, k])) for k in (0, 1)]
                hashes = pa.StructArray.from_arrays(both, fields=list(_HASH))
                yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), hashes)
        release_memory()

    hashes = F.arrow_udf(apply, "array<struct<hi: bigint, lo: bigint>>")(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), *more, F.explode(hashes).alias("h"))
    return rows.select("id", *more, "h.hi", "h.lo")


def line_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(hi, lo, n, last) of every distinct long line: the documents (rows) that hold it and the largest id of these, null
    if none has one. Counted before the shuffle, so a line that many documents hold costs a row a task."""
    return _hashed(docs, id_col, text_col, min_chars).groupBy("hi", "lo").agg(
        F.count("*").alias("n"), F.max("id").alias("last")
    )


def build_index(counts: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, int]:
    """The shards (``SHARD_SCHEMA``, written) over the hashes of ``counts`` with ``n >= min_docs``, and their number.

    It answers for any number of documents from ``min_docs`` on. A shard is a task's group of about ``KEYS_A_SHARD``
    distinct hashes, whatever the number of documents that hold them. No hash gives no shard.
    """
    keys = written(counts.where(F.col("n") >= min_docs), "lines-frequent")
    shards = min(max(1, math.ceil(keys.count() / KEYS_A_SHARD)), 1 << 24)
    own = (F.shiftrightunsigned("hi", 40) % shards).cast("int").alias("shard")

    def build(group: pa.Table) -> pa.Table:
        pairs = np.stack([group[c].to_numpy().view(np.uint64) for c in ("hi", "lo")], axis=1)
        row = Shard.row(group["shard"][0].as_py(), pairs, group["n"].to_numpy(), group["last"].to_numpy())
        kinds = [("shard", pa.int32()), ("n", pa.int32()), ("sizes", pa.list_(pa.int32()))]
        schema = pa.schema(kinds + [(c, pa.binary()) for c in ("words", "ranks", "prints", "counts", "last")])
        return pa.Table.from_pylist([row], schema)

    rows = keys.select("hi", "lo", "n", F.coalesce("last", F.lit(NO_ID)).alias("last"), own)
    return written(rows.groupBy("shard").applyInArrow(build, SHARD_SCHEMA), "lines-index"), shards


def _rewritten(docs: DataFrame, id_col: str, text_col: str, min_chars: int, falls: Callable, *more: str) -> DataFrame:
    """(id, n_lines, n_dropped, kept_text) of every row; ``falls(pairs, ids, *more)`` marks the lines to drop, where ids
    and more hold a row's value for each of its lines."""
    out = "struct<n_lines: bigint, n_dropped: bigint, kept_text: string>"

    def work(texts: list, ids: list, *rest: list) -> pa.Array:
        lines = [(t or "").split("\n") for t in texts]
        found = [line_digests(x, min_chars) for x in lines]
        sizes = np.fromiter((len(at) for at, _ in found), np.int64, len(texts))
        of = np.repeat(np.arange(len(texts)), sizes)
        numbers = np.array([NO_ID if i is None else i for i in ids], np.int64)
        gone = falls(_halves([d for _, own in found for d in own]), numbers[of], of, *rest)
        kept, dropped, ends = [], [], np.cumsum(sizes).tolist()
        for own, (at, _), end in zip(lines, found, ends):
            bad = set(itertools.compress(at, gone[end - len(at) : end].tolist()))
            dropped.append(len(bad))
            kept.append("\n".join([line for k, line in enumerate(own) if k not in bad]))
        return struct_array(
            {
                "n_lines": ([len(x) for x in lines], pa.int64()),
                "n_dropped": (dropped, pa.int64()),
                "kept_text": (kept, pa.string()),
            }
        )

    def apply(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            for at in range(0, len(batch[0]), SLICE):
                yield work(*[column.slice(at, SLICE).to_pylist() for column in batch])
        release_memory()

    made = F.arrow_udf(apply, out).asNondeterministic()(F.col(text_col), F.col(id_col).cast("bigint"), *map(F.col, more))
    return docs.select(F.col(id_col), made.alias("__lines")).select(id_col, "__lines.*")


def _dealt(docs: DataFrame, index: DataFrame, shards: int, min_docs: int, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``docs`` (id, text) with ``gone``, the hashes of its lines that fall, found at the shards."""
    keyed = docs.withColumn("text_hash", F.xxhash64(text_col))
    probes = _hashed(keyed, id_col, text_col, min_chars, "text_hash").withColumn(
        "shard", (F.shiftrightunsigned("hi", 40) % shards).cast("int")
    )
    tasks = probes.groupBy("shard").agg(F.ceil(F.count("*") / PROBES_A_TASK).cast("int").alias("tasks"))
    tasks = listed(written(tasks, "lines-tasks"))
    salt = F.pmod(F.xxhash64("id", "text_hash"), F.col("tasks")).cast("int").alias("salt")
    left = probes.join(tasks, "shard").select("shard", salt, "id", "text_hash", "hi", "lo")
    copies = index.join(tasks, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))
    schema = "id bigint, text_hash bigint, hi bigint, lo bigint"

    def probe(mine: pa.Table, own: pa.Table) -> pa.Table:
        names = ["id", "text_hash", "hi", "lo"]
        if not len(own) or not len(mine):
            return mine.select(names).slice(0, 0)
        pairs = np.stack([mine[c].to_numpy().view(np.uint64) for c in ("hi", "lo")], axis=1)
        ids = mine["id"].fill_null(NO_ID).to_numpy()
        return mine.select(names).filter(pa.array(Shard(own.to_pylist()[0]).falls(pairs, ids, min_docs)))

    found = left.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInArrow(probe, schema)
    gone = found.groupBy("id", "text_hash").agg(F.collect_set(F.struct("hi", "lo")).alias("gone"))
    gone = written(gone, "lines-gone").select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), "gone")
    same = keyed[id_col].eqNullSafe(F.col("__id")) & (keyed["text_hash"] == F.col("__hash"))
    return keyed.join(gone.hint("merge"), same, "left").select(id_col, text_col, "gone")


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    resident_bytes: int = RESIDENT_BYTES,
) -> DataFrame:
    """(id, n_lines, n_dropped, kept_text) of every row of ``docs``.

    Lines whose key has ``min_chars`` code points and is found in ``min_docs`` rows fall, except in the rows with the
    largest id that holds them (there all of them stay). A null or empty text is one empty line. A null id is smaller
    than any other: its lines stay only where no id holds them. Rows that repeat, with their ids, count one by one
    and get equal results. Ids are whole numbers. Other columns are not read. An empty table gives an empty table.
    """
    index, shards = build_index(line_counts(docs, id_col, text_col, min_chars), min_docs)
    parts = ("words", "ranks", "prints", "counts", "last")
    size = index.agg(F.sum(sum(F.length(c) for c in parts))).first()[0] or 0
    texts = docs.select(id_col, text_col)
    if size > resident_bytes:
        dealt = _dealt(texts, index, shards, min_docs, id_col, text_col, min_chars)

        def listed_lines(pairs: np.ndarray, ids: np.ndarray, of: np.ndarray, gone: list) -> np.ndarray:
            bad = [{(h["hi"], h["lo"]) for h in row or ()} for row in gone]
            signed = pairs.view(np.int64).tolist()
            return np.array([(hi, lo) in bad[row] for (hi, lo), row in zip(signed, of.tolist())], bool)

        return _rewritten(dealt, id_col, text_col, min_chars, listed_lines, "gone")

    shared = docs.sparkSession.sparkContext.broadcast([r.asDict() for r in index.collect()])
    held: dict = {}

    def resident(pairs: np.ndarray, ids: np.ndarray, of: np.ndarray) -> np.ndarray:
        if not held:
            held["index"] = Index(shared.value, shards)
        return held["index"].falls(pairs, ids, min_docs)

    return _rewritten(texts, id_col, text_col, min_chars, resident)
