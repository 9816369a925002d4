"""WARC archives: whole-file gzip streams rewritten as one gzip member per record, with offset index.

``write_monolithic`` stores records as they arrive, one whole-file stream per input partition.
``normalise`` inflates each stream once and rewrites every record as its own member, turning
records whose payload another record already holds into revisits, and writes a sidecar index
(archive, offset, length, ...) beside each archive. ``read_records`` fetches members by their
offsets alone, so any part of an archive can be read in parallel.

Archives are streamed through tasks chunk by chunk; a task holds one record at a time. Files are
written under a task-private name and renamed, so a repeated task leaves one whole file.
Any folder that pyarrow's file systems can open serves (shared local path, HDFS, object store).
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import shared_folder, written

#: Payloads below this many bytes are never replaced by a revisit.
MIN_REVISIT_BYTES = 100
LEVEL, CHUNK = 4, 1 << 20
#: Index rows of one such stretch of an archive are read by one task.
STRETCH = 16 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


class _Target:
    """A file under a task-private name that takes its final name when complete."""

    def __init__(self, folder: str, name: str):
        self.fs, base = _store(folder)
        self.fs.create_dir(base, recursive=True)
        context = TaskContext.get()
        self.final = f"{base}/{name}"
        self.temporary = f"{base}/.{name}.{context.taskAttemptId() if context else 0}"
        self.out, self.offset = self.fs.open_output_stream(self.temporary), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.offset += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.temporary, self.final)


def record(headers: dict[str, str], block: bytes) -> bytes:
    """One WARC record."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(head: bytes) -> dict[str, str]:
    """Header lines after the version line; names in lower case."""
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an inflated stream."""
    buffer = bytearray()
    chunks = iter(chunks)

    def fill(n: int) -> bool:
        while len(buffer) < n:
            more = next(chunks, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    while fill(1):
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not fill(len(buffer) + 1):
                raise ValueError("truncated WARC header")
        headers = parse(bytes(buffer[:end]))
        size = int(headers["content-length"])
        if not fill(end + 8 + size):
            raise ValueError("truncated WARC record")
        yield headers, bytes(buffer[end + 4 : end + 4 + size])
        del buffer[: end + 8 + size]


def inflated(stream, size: int = CHUNK) -> Iterator[bytes]:
    """The inflated chunks of a gzip stream of one or more members; output chunks are bounded too."""
    inflate = zlib.decompressobj(31)
    while data := stream.read(size):
        while data:
            yield inflate.decompress(data, 4 * size)
            data = inflate.unconsumed_tail
            if inflate.eof:
                data = inflate.unused_data
                inflate = zlib.decompressobj(31)
    if rest := inflate.flush():
        yield rest


def _member(data: bytes) -> bytes:
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def _http(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)


def write_monolithic(pages: DataFrame, folder: str) -> DataFrame:
    """Store every row of ``pages`` (page_id, url, html; null html: empty) as a response record.

    Each input partition becomes one whole-file gzip stream ``part-NNNNN.warc.gz``. Returns the
    manifest (page_id, part, seq, payload_bytes, payload_digest), one row per record; nothing is shuffled.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("part", pa.int32()),
            ("seq", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
        ]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, target, deflate = TaskContext.get().partitionId(), 0, None, zlib.compressobj(
            LEVEL, zlib.DEFLATED, 31
        )
        for batch in batches:
            rows = []
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                payload = (html or "").encode()
                digest = hashlib.sha256(payload).hexdigest()
                headers = {
                    "WARC-Type": "response",
                    "WARC-Record-ID": f"<urn:page:{'' if page is None else page}:{part}-{seq}>",
                    "WARC-Date": DATE,
                }
                headers |= {
                    "WARC-Target-URI": quote(url or "urn:unknown", safe="!#$&'()*+,/:;=?@[]%~"),
                    "WARC-Payload-Digest": f"sha256:{digest}",
                    "Content-Type": "application/http;msgtype=response",
                }
                target = target or _Target(folder, f"part-{part:05d}.warc.gz")
                target.write(deflate.compress(record(headers, _http(payload) + payload)))
                rows.append((page, part, seq, len(payload), digest))
                seq += 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema
                )
        if target:
            target.write(deflate.flush())
            target.close()

    rows = pages.select(F.col("page_id").cast("bigint"), "url", "html")
    return written(
        rows.mapInArrow(write, "page_id bigint, part int, seq bigint, payload_bytes bigint, payload_digest string"),
        "warc-manifest",
    )


def revisits(manifest: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(part, seq, refers_to): records to be replaced by a revisit, and the page they refer to.

    Of equal payloads of at least ``min_bytes`` the record with the smallest page_id stays (null ids
    last; of equal ids the first written). Only digests move; a digest that a third of all pages share is a
    skewed join key of narrow rows, which adaptive execution splits.
    """
    order = F.struct(F.col("page_id").isNull(), "page_id", "part", "seq")
    large = manifest.where(F.col("payload_bytes") >= min_bytes)
    first = large.groupBy("payload_digest").agg(
        F.min(order).alias("first"), F.count("*").alias("n")
    ).where("n > 1").drop("n")
    others = large.join(first, "payload_digest").where(
        (F.col("first.part") != F.col("part")) | (F.col("first.seq") != F.col("seq"))
    )
    return others.select("part", "seq", F.col("first.page_id").alias("refers_to"))


def normalise(folder: str, manifest: DataFrame, to: str) -> None:
    """Rewrite the archives of ``folder`` to ``to``: a gzip member per record and a sidecar index each.

    One task per archive streams it once; as many partitions are asked for as there are archives, because the rows
    that name the work are too narrow for adaptive execution to see its size. The sidecar ``part-NNNNN.warc.gz.idx``
    has a JSON line per record with archive, offset, length, page_id and record_type.
    """
    parts = manifest.select("part").distinct().select(
        "part", F.lit(-1).cast("bigint").alias("seq"), F.lit(None).cast("bigint").alias("refers_to")
    )
    todo = parts.unionByName(revisits(manifest)).repartition(parts.count(), "part")

    def rewrite(group: pd.DataFrame) -> pd.DataFrame:
        name = f"part-{int(group['part'].iloc[0]):05d}.warc.gz"
        moved = {int(s): r for s, r in zip(group["seq"], group["refers_to"]) if s >= 0}
        source, base = _store(folder)
        target, index = _Target(to, name), []
        with source.open_input_stream(f"{base}/{name}", compression=None) as stream:
            for seq, (headers, block) in enumerate(records(inflated(stream))):
                page = headers["warc-record-id"].split(":")[2]
                out = {
                    "WARC-Type": "response",
                    "WARC-Record-ID": headers["warc-record-id"],
                    "WARC-Date": headers["warc-date"],
                    "WARC-Target-URI": headers["warc-target-uri"],
                    "WARC-Payload-Digest": headers["warc-payload-digest"],
                    "Content-Type": headers["content-type"],
                }
                if seq in moved:
                    refers = "" if pd.isna(moved[seq]) else int(moved[seq])
                    out |= {"WARC-Type": "revisit", "WARC-Refers-To": f"<urn:page:{refers}>", "WARC-Profile": PROFILE}
                    block = block[: block.index(b"\r\n\r\n") + 4]
                member = _member(record(out, block))
                index.append(
                    {
                        "archive": name,
                        "offset": target.offset,
                        "length": len(member),
                        "page_id": int(page) if page else None,
                        "record_type": out["WARC-Type"],
                    }
                )
                target.write(member)
        target.close()
        sidecar = _Target(to, f"{name}.idx")
        sidecar.write("".join(json.dumps(x) + "\n" for x in index).encode())
        sidecar.close()
        return pd.DataFrame({"archive": [name], "records": [len(index)]})

    written(todo.groupBy("part").applyInPandas(rewrite, "archive string, records bigint"), "warc-normalised").count()


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecar indexes of a folder as one table."""
    kind = "archive string, offset bigint, length bigint, page_id bigint, record_type string"
    return spark.read.schema(kind).option("pathGlobFilter", "*.idx").json(folder)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Fetch the indexed members: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's size and digest are taken from its payload; a revisit's from its headers (the kept
    HTTP Content-Length and the payload digest). Stretches of an archive are read by different tasks.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
        ]
    )

    def page_of(name: str | None) -> int | None:
        part = name.strip("<>").split(":")[2] if name else ""
        return int(part) if part else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        name, source = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != name:
                    name, source = archive, store.open_input_file(f"{base}/{archive}")
                source.seek(offset)
                ((headers, block),) = records(iter([zlib.decompress(source.read(length), 31)]))
                head, _, payload = block.partition(b"\r\n\r\n")
                response = headers["warc-type"] == "response"
                size = len(payload) if response else int(parse(head)["content-length"])
                digest = hashlib.sha256(payload).hexdigest() if response else headers[
                    "warc-payload-digest"
                ].removeprefix("sha256:")
                rows.append(
                    (
                        page_of(headers["warc-record-id"]),
                        size,
                        digest,
                        headers["warc-type"],
                        page_of(headers.get("warc-refers-to")),
                    )
                )
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema
                )

    stretch = (F.col("offset") / STRETCH).cast("bigint").alias("stretch")
    n = max(1, index.select("archive", stretch).distinct().count())
    dealt = index.repartition(n, "archive", stretch).sortWithinPartitions("archive", "offset")
    return dealt.select("archive", "offset", "length").mapInArrow(
        read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    )


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to monolithic archives in the shared folder, normalise them and read them back.

    Every row of ``pages`` gives one row. Null or empty html is an empty payload; null urls and ids are
    kept as unknown; repeated rows give a record each. Columns other than page_id, url and html are
    not read. An empty table writes no archive and gives an empty table.
    """
    spark = pages.sparkSession
    whole, members = shared_folder(spark, "warc-whole"), shared_folder(spark, "warc-members")
    manifest = write_monolithic(pages, whole)
    if manifest.isEmpty():
        return spark.createDataFrame(
            [], "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
        )
    normalise(whole, manifest, members)
    return read_records(read_index(spark, members), members)
