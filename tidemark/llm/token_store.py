"""Token ids as Parquet list columns.

Documents are dealt by ranges of their id, sorted inside each range and encoded where they lie; a
range becomes one shard file with columns (doc_id, tokens, n_tokens, shard, shard_start). Tokens
are dictionary- or delta-encoded, row groups are bounded in bytes and pages in rows, and the writer
adds page indexes, so a reader may fetch single columns (counts without tokens) and single ranges
of ids (row groups and pages outside the range are skipped).
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tidemark.llm.common import shared_folder
from tidemark.llm.vocabularies import path, pattern

#: Encoded chunks and pieces kept in a worker; beyond it a cache starts anew (results don't change).
CACHE_CHUNKS = 300_000


@dataclass(frozen=True)
class TokenFormat:
    """How shards are written: token encoding, row-group and page sizes, compression."""

    encoding: str = "dictionary"
    row_group_bytes: int = 32 << 20
    page_rows: int = 2_000
    compression: str = "zstd"

    def options(self) -> dict[str, str]:
        if self.encoding not in ("dictionary", "delta"):
            raise ValueError(f"unknown token encoding {self.encoding!r}")
        return {
            "compression": self.compression,
            "parquet.block.size": str(self.row_group_bytes),
            "parquet.page.row.count.limit": str(self.page_rows),
            "parquet.writer.version": "v1" if self.encoding == "dictionary" else "v2",
            "parquet.enable.dictionary": str(self.encoding == "dictionary").lower(),
        }


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer file, the id that ends every document (None: no end id), and whether the strings of
    special tokens in a text are ordinary text (by default they become the special ids, as in the library)."""

    file: str = field(default_factory=lambda: path("byte_bpe_50k.json"))
    end_id: int | None = 2
    special_as_text: bool = False


class _Cache(dict):
    """Values made on first use."""

    def __init__(self, make, start=()):
        super().__init__(start)
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


class Encoder:
    """Whole-text encoding with the tokenizers library, one library call per distinct chunk.

    The byte-level pre-tokeniser always cuts before a single space between two other characters, and
    around a single newline between two other characters, so the chunks between them can be encoded
    apart and joined. Other white space (double, leading, trailing, tabs) and strings of added tokens send the whole
    text to the library.
    """

    def __init__(self, tokenizer: Tokenizer):
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(tokenizer.file)
        self.library.encode_special_tokens = tokenizer.special_as_text
        #: Strings that the library takes out of a text before anything else; texts with one go to it whole.
        added = [
            t.content
            for t in self.library.get_added_tokens_decoder().values() if not (t.special and tokenizer.special_as_text)
        ]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)").search
        self.end = b"" if tokenizer.end_id is None else np.uint32(tokenizer.end_id).astype("<u4").tobytes()
        self.pieces = _Cache(self._piece)
        self.cut = regex.compile(pattern()).findall
        self.tokenize = self.library.model.tokenize
        # Byte-level vocabularies name printable bytes by themselves and number the others from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(printable)]
        self.names = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        #: None: a chunk that must be encoded with its neighbours.
        self.fixed: dict[str, bytes | None] = {"\n": self._whole("\n"), "": None, " ": None}
        self.chunks = _Cache(self._chunk, self.fixed)

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isascii():
            named = "Ġ" + piece[1:] if piece[0] == " " else piece
        else:
            named = piece.encode().decode("latin-1").translate(self.names)
        return array("I", [t.id for t in self.tokenize(named)]).tobytes()

    def _chunk(self, chunk: str) -> bytes | None:
        """The ids of a word, with a blank in front unless it begins a line; None if white space is inside."""
        word = chunk[1:] if chunk[0] == " " else chunk
        if not (chunk.isascii() or max(chunk) < "ɐ"):
            return self._whole(chunk) if word.split() == [word] else None
        pieces = self.pieces
        if word.isalpha():
            return pieces[chunk]
        if word[-1] in ".,;:!?" and word[:-1].isalpha():
            return pieces[chunk[:-1]] + pieces[chunk[-1]]
        return b"".join([pieces[p] for p in self.cut(chunk)]) if word.split() == [word] else None

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` and the end id as little-endian unsigned 32-bit integers."""
        if not text:
            return self.end
        if "\0" in text or self.added(text):
            return self._whole(text) + self.end
        chunks = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        if len(self.chunks) > CACHE_CHUNKS:
            self.chunks = _Cache(self._chunk, self.fixed)
        if len(self.pieces) > CACHE_CHUNKS:
            self.pieces = _Cache(self._piece)
        try:
            return b"".join(map(self.chunks.__getitem__, chunks)) + self.end
        except TypeError:  # a chunk is None
            return self._whole(text) + self.end


_ENCODERS: dict[Tokenizer, Encoder] = {}


def _encoder(tokenizer: Tokenizer) -> Encoder:
    """The worker's encoder, which keeps its caches from task to task."""
    if tokenizer not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer] = Encoder(tokenizer)
    return _ENCODERS[tokenizer]


def write_tokens(
    docs: DataFrame,
    to: str,
    tokenizer: Tokenizer | None = None,
    fmt: TokenFormat | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every row of ``docs`` (null text: empty) and write shards in ascending id order to ``to``.

    Rows with equal ids stay next to each other, ordered by text; null ids come first. Other columns
    are not read. An empty table writes an empty store. A range never holds more than its share of
    ids, whatever the sizes of groups in other columns; rows that share one id (or have none) are one range, since
    their order by text is part of the store, so an id that very many rows share is one task's work.
    """
    tokenizer, fmt = tokenizer or Tokenizer(), fmt or TokenFormat()
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("tokens", pa.list_(pa.int32())),
            ("n_tokens", pa.int64()),
            ("shard_start", pa.int64()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start = _encoder(tokenizer), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = [encoder.encode(t or "") for t in part.column(1).to_pylist()]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                ends = np.concatenate([[0], np.cumsum(sizes)])
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), tokens, pa.array(sizes), pa.array(start + ends[:-1])], schema=schema
                )
                start += int(ends[-1])

    kind = StructType(
        [
            StructField("doc_id", LongType()),
            StructField("tokens", ArrayType(IntegerType())),
            StructField("n_tokens", LongType()),
            StructField("shard_start", LongType()),
        ]
    )
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ranged.mapInArrow(encode, kind).withColumn(
        "shard", F.spark_partition_id()
    ).write.options(**fmt.options()).parquet(to)


def read_tokens(spark: SparkSession, path: str, columns: tuple[str, ...] = ("tokens",)) -> DataFrame:
    """doc_id, start, n_tokens and the asked ``columns`` of a store.

    ``start`` counts the ids of all documents before a row in ascending id order: the row's place in
    its shard plus the sizes of the earlier shards (one row per shard, which is what is broadcast).
    Filters on doc_id reach the files; columns that aren't asked for are not read.
    """
    store = spark.read.parquet(path)
    sizes = store.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    earlier = sizes.selectExpr(
        "shard", "sum(size) over (order by shard rows between unbounded preceding and current row) - size as before"
    )
    placed = store.join(F.broadcast(earlier), "shard")
    return placed.select("doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", *columns)


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of each row's ids as little-endian 32-bit integers."""

    def crc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = np.asarray(batch.values, "<u4")
            ends = np.asarray(batch.offsets).tolist()
            yield pa.array([zlib.crc32(values[a:z].tobytes()) for a, z in zip(ends, ends[1:])], pa.int64())

    return tokens.select("doc_id", "start", "n_tokens", F.arrow_udf(crc, "bigint")("tokens").alias("ids_crc32"))


def store_and_check(docs: DataFrame, tokenizer: Tokenizer | None = None, fmt: TokenFormat | None = None) -> DataFrame:
    """Write ``docs`` as a store in the shared folder and read its checksums back."""
    to = shared_folder(docs.sparkSession, "tokens")
    write_tokens(docs, to, tokenizer, fmt)
    return checksums(read_tokens(docs.sparkSession, to))
