"""Deterministic sharded WARC writer, and the reader of what it wrote.

Pages are dealt to shards by ranges of (page_id, digest), cut where the running sum of bytes along that order
passes the shard size, so the same table gives the same shards, whatever the gaps between its ids. Rows are
sorted and written as one gzip member a record; a file is closed once its compressed size passes the roll size,
so a payload over that has a file of its own. Headers, digests and record ids are made anew from the payload and
page_id alone, so a repeated task writes the same bytes. A task writes under a temporary name and renames when the
file is whole; a task that runs again leaves whole files of the same bytes as they are and replaces others; the
manifest of files, written last, is the commit: readers open only what it lists.

Of pages with equal payloads of at least min_bytes bytes, that with the largest page_id is the response and
the others revisit it; a repeated row revisits its first. Smaller payloads are all responses.
Defined results: a null html is an empty payload; a null url is written as urn:page:<id>; a null page_id sorts
first and is written as an empty id; an empty table gives a manifest without files; further columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import fs_path, scratch, stored, table
from chatloom.operators.ordering import running_total

SHARD_BYTES, ROLL_BYTES = 16 << 20, 4 << 20
#: Shards, but not their files, are larger where there would be more than this many of them, so their bounds can be broadcast: of
#: 1 GB for 100 TB. A task holds one file at a time.
MAX_SHARDS = 100_000
#: Bytes that a record's headers count for, and shards whose files one file of the manifest lists.
HEAD_BYTES, LISTED = 600, 2000
#: Where a null page_id sorts.
NO_PAGE = -(1 << 63)
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST = "file string, records long, bytes long, sha1 string"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}')}>"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    shown = "" if page_id is None else page_id
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join((url or f'urn:page:{shown}').split())}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"Content-Length: {len(block)}",
        f"X-Page-Id: {shown}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Refers-To-Page-Id: {refers_to}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Shard:
    """The open file of one shard."""

    def __init__(self, root: str, shard: int, roll: int) -> None:
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(root)
        self.shard, self.roll, self.number = shard, roll, 0
        self.done: list[tuple[str, int, int, str]] = []
        self.parts: list[bytes] = []
        self.size = self.records = 0

    def add(self, data: bytes) -> None:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member = packer.compress(data) + packer.flush()
        self.parts.append(member)
        self.size += len(member)
        self.records += 1
        if self.size >= self.roll:
            self.close()

    def holds(self, target: str, data: bytes) -> bool:
        """Whether the target is a file of just these bytes; a file of others, from an attempt that was cut off, is deleted."""
        from pyarrow import fs

        info = self.fs.get_file_info(target)
        if info.type == fs.FileType.NotFound:
            return False
        if info.size == len(data):
            with self.fs.open_input_stream(target, compression=None) as there:
                if there.read() == data:
                    return True
        self.fs.delete_file(target)
        return False

    def close(self) -> None:
        if not self.records:
            return
        name = f"shard-{self.shard:06d}-{self.number:05d}.warc.gz"
        data = b"".join(self.parts)
        target = posixpath.join(self.root, "records", name)
        if not self.holds(target, data):
            own = posixpath.join(self.root, "_temporary", uuid.uuid4().hex)
            self.fs.create_dir(own, recursive=True)
            with self.fs.open_output_stream(posixpath.join(own, name), compression=None) as out:
                out.write(data)
            self.fs.create_dir(posixpath.join(self.root, "records"), recursive=True)
            try:
                self.fs.move(posixpath.join(own, name), target)
            except OSError:
                # Another attempt of this task was faster: what it left is as good, if it is the same.
                if not self.holds(target, data):
                    raise
            self.fs.delete_dir(own)
        self.done.append((name, self.records, self.size, hashlib.sha1(data).hexdigest()))
        self.parts, self.size, self.records, self.number = [], 0, 0, self.number + 1


def _write(batches: Iterator[pa.RecordBatch], root: str, roll: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, page_id, sha1, page last): a row without payload says what the page with its id and digest refers to."""
    open_: _Shard | None = None
    note: tuple = ()
    last: tuple = ()
    files: list[tuple[str, int, int, str]] = []
    for batch in batches:
        for shard, page_id, sha1, url, payload, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if open_ is None or open_.shard != shard:
                if open_ is not None:
                    open_.close()
                    files += open_.done
                open_ = _Shard(root, shard, roll)
            if payload is None:
                note = (page_id, sha1, refers)
                continue
            to = note[2] if note[:2] == (page_id, sha1) else None
            revisit = to is not None and (to != page_id or last == (page_id, sha1))
            digest = base64.b32encode(bytes.fromhex(sha1)).decode()
            open_.add(record(page_id, url, payload, digest, to, revisit))
            last = (page_id, sha1)
    if open_ is not None:
        open_.close()
        files += open_.done
    yield pa.RecordBatch.from_arrays(
        [pa.array([f[k] for f in files], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))],
        ["file", "records", "bytes", "sha1"],
    )


def shard_bounds(light: DataFrame, shard_bytes: int) -> list[tuple[int, str]]:
    """The least (page_id, sha1) of each shard of light(page_id, sha1, n), in order: shards are cut by bytes along that order."""
    amount = F.col("n") + HEAD_BYTES
    total = light.agg(F.sum(amount)).first()[0] or 0
    size = max(shard_bytes, -(-total // MAX_SHARDS))
    placed = running_total(light, ["page_id", "sha1"], amount, "at")
    lows = placed.groupBy(F.floor(F.col("at") / size).alias("shard")).agg(F.min(F.struct("page_id", "sha1")).alias("low"))
    return sorted({(r.low.page_id, r.low.sha1) for r in lows.select("low").collect()})


def place_of(bounds: tuple[np.ndarray, list[str]], page_id: np.ndarray, sha1: pd.Series) -> np.ndarray:
    """The number of the last of the bounds (page_ids in order, and digests) that is at or before each row."""
    pages, digests = bounds
    first, end = np.searchsorted(pages, page_id, "left"), np.searchsorted(pages, page_id, "right")
    out = (end - 1).astype(np.int32)
    # Digests decide only for pages at which a shard begins.
    for i in np.flatnonzero(first < end):
        out[i] = bisect.bisect_right(digests, sha1.iloc[i], first[i], end[i]) - 1
    return out


def write_archive(pages: DataFrame, root: str, min_bytes: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> None:
    """Writes pages(page_id, url, html) under root and commits its manifest; an error if root holds a committed archive."""
    spark = pages.sparkSession
    files, done = fs_path(spark, f"{root}/manifest/_SUCCESS")
    if files.exists(done):
        raise FileExistsError(root)
    payload = F.coalesce("html", F.lit("")).cast("binary")
    own = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    light = stored(own.select("page_id", "sha1", F.octet_length("payload").alias("n")), "pages")
    place = F.coalesce("page_id", F.lit(NO_PAGE))
    lows = shard_bounds(light.select(place.alias("page_id"), "sha1", "n"), shard_bytes)
    bounds = spark.sparkContext.broadcast((np.array([p for p, _ in lows], dtype=np.int64), [d for _, d in lows]))

    @F.pandas_udf("int")
    def shard_of(page_id: pd.Series, sha1: pd.Series) -> pd.Series:
        return pd.Series(place_of(bounds.value, page_id.to_numpy(), sha1))

    copies = light.where(F.col("n") >= min_bytes).groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("k"))
    copies = stored(copies.where("k > 1"), "copies").select("sha1", "refers_to")
    notes = light.select("page_id", "sha1").join(copies, "sha1").distinct()
    shard = shard_of(place, F.col("sha1"))
    rows = (
        own.select(shard.alias("shard"), "page_id", "sha1", "url", "payload", F.lit(None).cast("long").alias("refers_to"))
        .unionByName(notes.select(shard.alias("shard"), "page_id", "sha1", "refers_to"), allowMissingColumns=True)
        .repartitionById(max(1, len(lows)), F.col("shard"))
        .sortWithinPartitions("shard", "page_id", "sha1", F.col("payload").isNotNull())
    )
    files = rows.select("shard", "page_id", "sha1", "url", "payload", "refers_to").mapInArrow(lambda b: _write(b, root, roll_bytes), MANIFEST)
    # The list of files is written once by the tasks that write them; bringing it into few files comes after.
    listed = stored(files, "warc-files")
    listed.coalesce(len(lows) // LISTED + 1).write.json(f"{root}/manifest")


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record in a gzip-per-record stream, read piece by piece."""
    packed = zlib.decompressobj(31)
    data = bytearray()
    while True:
        piece = stream.read(1 << 20)
        if not piece:
            return
        while piece:
            data += packed.decompress(piece)
            if not packed.eof:
                break
            head, _, rest = bytes(data).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
            yield fields, rest[: int(fields["Content-Length"])]
            piece, packed, data = packed.unused_data, zlib.decompressobj(31), bytearray()


def _read(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    files, at = fs.FileSystem.from_uri(root)
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        out = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
        rows.clear()
        return pa.RecordBatch.from_arrays(out, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    for names in batches:
        for name in names.column("file").to_pylist():
            with files.open_input_stream(posixpath.join(at, "records", name), compression=None) as stream:
                for fields, block in records_of(stream):
                    payload = block.partition(b"\r\n\r\n")[2]
                    size, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response" and (len(payload) != size or base32_sha1(payload) != digest):
                        raise ValueError(f"{name}: record {fields['WARC-Record-ID']} does not match its digest")
                    refers = fields.get("X-Refers-To-Page-Id")
                    page = fields["X-Page-Id"]
                    rows.append((int(page) if page else None, size, digest, fields["WARC-Type"], int(refers) if refers else None))
                    if len(rows) >= 2000:
                        yield batch()
    yield batch()


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """A row per record of the archive's committed files."""
    files = spark.read.schema(MANIFEST).json(f"{root}/manifest").select("file")
    n = max(1, min(files.count(), 4096))
    return files.repartition(n, "file").mapInArrow(lambda b: _read(b, root), RECORD)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), root)
    return read_archive(spark, root)


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex,
    max(page_id) OVER (PARTITION BY html) AS best FROM p)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (k // 4), 5))::INT >> (15 - 5 * (k % 4))) & 31), 1)
    FOR k IN range(0, 32)], '') AS payload_digest,
  CASE WHEN best = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN best = page_id THEN NULL ELSE best END AS refers_to
FROM h
"""
