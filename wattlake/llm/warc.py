"""WARC archives as tables of chunks.

Writing: each task streams its rows into archives of its own, one gzip member a record, rolled at a size.
Reading: each archive is streamed by one task into rows of record and chunk number; every row carries the
digest and the length of the payload up to its end, so neither side ever holds a whole record besides the
cell that a page's html already is. The last chunk of a record carries the whole payload's digest, and a
record's summary is that row: nothing is joined or collected again.

Payloads that occur again are revisit records without a payload. They name the record that has it, and
carry its digest and length.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.common import in_small_batches
from wattlake.session import materialise, scratch_path

#: Bytes of a payload in one row, and bytes read from an archive at a time.
CHUNK_BYTES = 1 << 20
READ_BYTES = 1 << 18
#: An archive is closed when it is larger than this; it is also what one task reads.
ARCHIVE_BYTES = 128 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CHUNKS = (
    "record_id string, record_type string, target_uri string, refers_to string, chunk long, data binary, "
    "payload_bytes long, payload_digest string, last boolean"
)


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _open_target(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class _Archives:
    """Archives of one task attempt. Names hold a fresh id: a repeated attempt never touches another's files."""

    def __init__(self, folder: str, archive_bytes: int) -> None:
        self.files, self.path = _open_target(folder)
        self.uri, self.limit = folder.rstrip("/"), archive_bytes
        self.stream, self.name, self.records = None, "", 0
        self.done: list[tuple[str, int]] = []

    def write(self, head: dict[str, str], payload: memoryview) -> None:
        if self.stream is None:
            self.name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
            self.files.create_dir(self.path, recursive=True)
            self.stream, self.records = self.files.open_output_stream(f"{self.path}/{self.name}", compression=None), 0
        pack = zlib.compressobj(3, zlib.DEFLATED, 31)
        lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in head.items())]
        self.stream.write(pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n"))
        if head["WARC-Type"] == "response":
            self.stream.write(pack.compress(_HTTP))
        for start in range(0, len(payload), READ_BYTES):
            self.stream.write(pack.compress(payload[start:start + READ_BYTES]))
        self.stream.write(pack.compress(b"\r\n\r\n") + pack.flush())
        self.records += 1
        if self.stream.tell() >= self.limit:
            self.close()

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.done.append((f"{self.uri}/{self.name}", self.records))
            self.stream = None


def _placed(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, place``; a row has the same place however often and in whatever splits it is read.

    Rows of Parquet files stand where their file says. What isn't read as it is from files is computed once.
    """
    columns = ["page_id", "url", "html"]
    if pages._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation":
        try:
            return pages.select(*columns, F.struct("_metadata.file_path", "_metadata.row_index").alias("place"))
        except AnalysisException:  # files whose rows have no numbers
            pass
    numbered = F.struct(F.lit("").alias("file_path"), F.monotonically_increasing_id().alias("row_index"))
    return materialise(pages.select(*columns, numbered.alias("place")))


def _spelled(place: str) -> tuple[Column, ...]:
    return F.hex(F.xxhash64(f"{place}.file_path")), F.lit("-"), F.col(f"{place}.row_index").cast("string")


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, record_id, refers_to``: which record each page's record repeats, or null.

    Payloads are equal if their SHA-1, length and 64-bit hash are. Of those with ``least_bytes`` or more, the
    record of the largest page_id stays (null ids come before all others; of equal ids, the later row), and the others
    refer to it. Only payloads that occur again are joined back; the join is broadcast when they are few and
    split where one payload is very common.
    """
    source = _placed(pages).select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), "place")
    keys = ["sha", "size", "hash"]
    keyed = source.select(
        "*", F.unhex(F.sha1(F.encode("html", "utf-8"))).alias("sha"), F.octet_length("html").alias("size"),
        F.xxhash64("html").alias("hash"),
        F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(":"),
                 *_spelled("place"), F.lit(">")).alias("record_id"),
    )
    often = (
        keyed.select("page_id", "place", *keys).where(F.col("size") >= least_bytes).groupBy(*keys)
        .agg(F.max(F.struct("page_id", "place")).alias("kept"), F.count("*").alias("n")).where("n > 1")
        .select(*keys, "kept.place", F.concat(
            F.lit("<urn:x-page:"), F.coalesce(F.col("kept.page_id").cast("string"), F.lit("null")), F.lit(":"),
            *_spelled("kept.place"), F.lit(">")).alias("refers_to"))
        .withColumnRenamed("place", "kept_place")
    )
    return keyed.join(often, keys, "left").select(
        "page_id", "url", "html", "record_id",
        F.when(F.col("place") != F.col("kept_place"), F.col("refers_to")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Writes a record for each row of ``pages(page_id, url, html)``; returns ``path, records`` of the archives.

    A null html is an empty payload, a null url leaves out the target. Repeated rows get records of their
    own. ``folder`` must be one that all executors share. Archives of failed attempts may stay there; they
    are not in the returned table, which is kept as a file, so reading never sees them. No pages, no archives.
    """

    def write(batches):
        archives = _Archives(folder, archive_bytes)
        for rows in batches:
            for url, html, record, refers in zip(*(rows.column(i) for i in range(4)), strict=True):
                payload = memoryview(html.as_buffer())
                head = {"WARC-Type": "response" if refers.as_py() is None else "revisit", "WARC-Record-ID": record.as_py()}
                if url.as_py() is not None:
                    head["WARC-Target-URI"] = " ".join(url.as_py().split())
                head["WARC-Payload-Digest"] = f"sha1:{base32_sha1(hashlib.sha1(payload).digest())}"
                if refers.as_py() is None:
                    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(_HTTP) + len(payload))}
                else:
                    head |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": refers.as_py(),
                             "X-Payload-Length": str(len(payload)), "Content-Length": "0"}
                    payload = payload[:0]
                archives.write(head, payload)
        archives.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in archives.done], pa.string()), pa.array([x[1] for x in archives.done], pa.int64())],
            ["path", "records"],
        )

    marked = mark_revisits(pages, least_bytes).select("url", "html", "record_id", "refers_to")
    return materialise(in_small_batches(marked).mapInArrow(write, "path string, records long"))


@dataclass
class _Record:
    head: dict[str, str]
    left: int
    sha: "hashlib._Hash"
    read: int = 0
    chunk: int = 0


def _inflated(stream, size: int) -> Iterator[bytes]:
    """The archive's bytes, at most ``size`` at a time, whatever its members' sizes."""
    unpack = zlib.decompressobj(31)
    while raw := stream.read(READ_BYTES):
        while raw:
            yield unpack.decompress(raw, size)
            if unpack.eof:
                raw, unpack = unpack.unused_data, zlib.decompressobj(31)
            else:
                raw = unpack.unconsumed_tail
    while rest := unpack.decompress(unpack.unconsumed_tail, size):
        yield rest


class _Window:
    """Buffered bytes of a stream: lines of heads and bounded pieces of blocks."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.held = pieces, bytearray()

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is not None:
            self.held += piece
        return piece is not None

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before the mark, which is skipped; None at the end of the archive."""
        seen = 0
        while (at := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if not self.more():
                if self.held.strip():
                    raise ValueError("the archive ends within a record")
                return None
        found = bytes(self.held[:at])
        del self.held[:at + len(mark)]
        return found

    def take(self, most: int, full: bool) -> bytes:
        """Up to ``most`` bytes; just so many if ``full``."""
        while len(self.held) < (most if full else 1):
            if not self.more():
                raise ValueError("the archive ends within a record")
        found = bytes(self.held[:most])
        del self.held[:most]
        return found


def read_records(stream, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple]:
    """Rows of ``CHUNKS`` for every record of an opened archive, in order."""
    window = _Window(_inflated(stream, READ_BYTES))
    while (lines := window.until(b"\r\n\r\n")) is not None:
        names = [line.partition(":") for line in lines.decode().split("\r\n")[1:]]
        head = {name.strip().lower(): value.strip() for name, _, value in names}
        kind, left = head["warc-type"], int(head["content-length"])
        claimed = head.get("warc-payload-digest", "").removeprefix("sha1:")
        about = (head["warc-record-id"], kind, head.get("warc-target-uri"), head.get("warc-refers-to"))
        if kind == "revisit":
            window.take(left, True)
            yield (*about, 0, b"", int(head["x-payload-length"]), claimed, True)
        else:
            if "application/http" in head.get("content-type", ""):
                left -= len(window.until(b"\r\n\r\n")) + 4
            sha, read, chunk = hashlib.sha1(), 0, 0
            while True:
                data = window.take(min(chunk_bytes, left - read), True)
                sha.update(data)
                read += len(data)
                digest = base32_sha1(sha.digest())
                if read == left and claimed and digest != claimed:
                    raise ValueError(f"{about[0]}: the payload's digest is {digest}, not {claimed}")
                yield (*about, chunk, data, read, digest, read == left)
                chunk += 1
                if read == left:
                    break
        if window.take(4, True) != b"\r\n\r\n":
            raise ValueError(f"{about[0]}: no end of the record")


def read_chunks(archives: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``CHUNKS`` of every record in the archives of ``archives(path)``: one row a chunk.

    ``payload_bytes`` and ``payload_digest`` are those of the payload up to the chunk's end, for a revisit
    those of the payload it stands for. A record without payload has one empty chunk. A damaged archive, or a
    payload that doesn't have its record's digest, raises.
    """

    def read(batches):
        columns = [part.split()[0] for part in CHUNKS.split(", ")]
        kinds = [pa.string()] * 4 + [pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

        def batch(rows):
            values = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(values, kinds, strict=True)], columns)

        for paths in batches:
            for path in paths.column(0).to_pylist():
                files, place = _open_target(path)
                held, size = [], 0
                with files.open_input_stream(place, compression=None) as stream:
                    for row in read_records(stream, chunk_bytes):
                        held.append(row)
                        size += len(row[5])
                        if size >= chunk_bytes or len(held) == 1024:
                            yield batch(held)
                            held, size = [], 0
                if held:
                    yield batch(held)

    # One archive a task, as far as there are tasks.
    count = max(1, archives.count())
    spread = archives.select("path").repartition(min(count, 1 << 16), "path")
    return in_small_batches(spread).mapInArrow(read, CHUNKS)


def summaries(chunks: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record that a page got."""
    number = lambda name: F.nullif(F.split_part(F.col(name), F.lit(":"), F.lit(3)), F.lit("null")).cast("long")
    return chunks.where("last").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )


def archive_and_read(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes the pages to archives in the shared folder and returns the summaries of what is read back."""
    return summaries(read_chunks(write_archives(pages, scratch_path(spark, "warc"), least_bytes)))
