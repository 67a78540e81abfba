"""WARC archives written and read as tables of chunks.

A record is a run of rows with its identifier and a chunk number, so a payload of any size passes
through in pieces. Each row of the table that is read carries the bytes and the digest of the
payload up to and with its chunk; the last one has those of the whole.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epochfold.llm.shared import pick, shared_folder

#: Bytes of payload in a row.
CHUNK = 1 << 20
#: A file is closed after the record with which it reaches so many compressed bytes.
FILE_BYTES = 512 << 20
#: Bytes of a file that are read at a time, and the most that a record's headers may take.
READ, HEADERS = 1 << 18, 1 << 16
_CRLF = b"\r\n"

_FILES = "file string, n_records long, n_bytes long"
_CHUNKS = (
    "record_id string, page_id long, record_type string, refers_to long, target string, "
    "chunk_no int, data binary, bytes_so_far long, digest_so_far string, last boolean"
)


def base32_sha1(raw: bytes) -> str:
    """A SHA-1 as WARC files show it: 32 capital letters and digits."""
    return base64.b32encode(raw).decode("ascii")


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    name = urn.rpartition(":")[2].rstrip(">")
    return None if name == "none" else int(name)


def _target(url: str) -> str:
    """A URL on one line of a header."""
    return "".join(c if c.isprintable() and c != " " else f"%{ord(c):02X}" for c in url)


# -- writing ----------------------------------------------------------------------------------


class Writer:
    """Writes records chunk by chunk, each record as a gzip member of its own."""

    def __init__(self, out):
        self.out = out
        self.n_bytes = self.n_records = 0
        self.member = self.sha1 = None
        self.left = 0

    def _put(self, data: bytes) -> None:
        packed = self.member.compress(data)
        self.out.write(packed)
        self.n_bytes += len(packed)

    def begin(self, row: dict) -> None:
        revisit = row["record_type"] == "revisit"
        size = 0 if revisit else row["n_bytes"]
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        http += b"Content-Length: %d\r\n\r\n" % row["n_bytes"]
        lines = [
            "WARC/1.1",
            f"WARC-Type: {row['record_type']}",
            f"WARC-Record-ID: {_urn(row['page_id'])}",
            "WARC-Date: 1970-01-01T00:00:00Z",
            "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(http) + size}",
            f"WARC-Payload-Digest: sha1:{base32_sha1(bytes.fromhex(row['sha1']))}",
        ]
        if row["url"]:
            lines.append(f"WARC-Target-URI: {_target(row['url'])}")
        if revisit:
            lines.append(f"WARC-Refers-To: {_urn(row['refers_to'])}")
            lines.append(
                "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
            )
        self.member, self.sha1, self.left = zlib.compressobj(3, wbits=31), hashlib.sha1(), size
        self.declared = None if revisit else row["sha1"]
        self._put("\r\n".join(lines).encode() + _CRLF + _CRLF + http)

    def chunk(self, data: bytes) -> None:
        self.sha1.update(data)
        self.left -= len(data)
        self._put(data)

    def end(self) -> None:
        if self.left or self.declared not in (None, self.sha1.hexdigest()):
            raise ValueError("a payload differs from its declared size or digest")
        self._put(_CRLF + _CRLF)
        packed = self.member.flush()
        self.out.write(packed)
        self.n_bytes += len(packed)
        self.n_records += 1


def _classified(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Pages with size, digest, record type and the page referred to.

    Only digests that occur twice are joined, one row each.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    sized = pages.select("page_id", "url", payload.alias("payload"))
    sized = sized.withColumn("n_bytes", F.octet_length("payload").cast("long"))
    sized = sized.withColumn("sha1", F.sha1("payload"))
    seen = sized.where(F.col("n_bytes") >= least_bytes).groupBy("sha1")
    seen = seen.agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("latest"))
    seen = seen.where("n > 1 and latest is not null").select("sha1", "latest")
    both = sized.join(seen, "sha1", "left")
    # a row without an id is never the one referred to
    again = F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest"))
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    refers = F.when(again, F.col("latest")).alias("refers_to")
    return both.select("page_id", "url", "payload", "n_bytes", "sha1", kind.alias("record_type"), refers)


def write(pages: DataFrame, folder: str, least_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Write a record for every page; return the list of files, stored beside them.

    Of records with equal payloads of at least `least_bytes` bytes, that with the largest page_id
    is a response and the others revisit it; rows that share this page_id are all responses, and a
    row without a page_id is a response only if no equal payload has one. A null html is empty.

    Payloads are cut into rows of `chunk` bytes before they leave the JVM. Files are named anew at
    each attempt, and only those of attempts that succeeded are listed.
    """
    spark = pages.sparkSession
    filesystem, base = pafs.FileSystem.from_uri(folder)
    filesystem.create_dir(f"{base}/warc", recursive=True)
    records = _classified(pick(pages, "page_id", "url", "html"), least_bytes)
    size = F.when(F.col("record_type") == "response", F.col("n_bytes")).otherwise(F.lit(0))
    last = F.greatest(F.lit(0), F.ceil(size / chunk).cast("int") - 1).alias("last")
    rows = records.select("*", last)
    rows = rows.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("last"))))
    data = F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk))
    data = F.when(F.col("record_type") == "response", data).alias("data")
    rows = rows.select(
        "page_id", "url", "n_bytes", "sha1", "record_type", "refers_to", "last", "chunk_no", data
    )

    def run(batches):
        part = TaskContext.get().partitionId()
        files, at = pafs.FileSystem.from_uri(folder)
        writer = name = None
        listed = []

        def close():
            writer.out.close()
            listed.append((name, writer.n_records, writer.n_bytes))

        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if row["chunk_no"] == 0:
                    if writer and writer.n_bytes >= FILE_BYTES:
                        close()
                        writer = None
                    if writer is None:
                        name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                        writer = Writer(files.open_output_stream(f"{at}/warc/{name}", compression=None))
                    writer.begin(row)
                writer.chunk(row["data"] or b"")
                if row["chunk_no"] == row["last"]:
                    writer.end()
        if writer:
            close()
        columns = [pa.array(c) for c in zip(*listed, strict=True)] if listed else []
        if columns:
            yield pa.RecordBatch.from_arrays(columns, names=["file", "n_records", "n_bytes"])

    rows.mapInArrow(run, _FILES).write.parquet(f"{folder}/files")
    return spark.read.schema(_FILES).parquet(f"{folder}/files")


# -- reading ----------------------------------------------------------------------------------


class Stream:
    """The bytes of a file of gzip members, unpacked on demand."""

    def __init__(self, source):
        self.source, self.raw, self.plain = source, b"", b""
        self.member = zlib.decompressobj(wbits=31)

    def more(self) -> bool:
        """Unpack some more; False at the end of the file."""
        while True:
            if not self.raw:
                self.raw = self.source.read(READ)
                if not self.raw:
                    return False
            out = self.member.decompress(self.raw, READ)
            self.raw = self.member.unconsumed_tail
            if self.member.eof:
                self.raw = self.member.unused_data
                self.member = zlib.decompressobj(wbits=31)
            if out:
                self.plain += out
                return True

    def headers(self) -> list[str] | None:
        """The lines up to an empty one; None at the end of the file."""
        while (at := self.plain.find(_CRLF + _CRLF)) < 0:
            if len(self.plain) > HEADERS:
                raise ValueError("headers without an end")
            if not self.more():
                if self.plain:
                    raise ValueError("the file is cut short")
                return None
        lines, self.plain = self.plain[:at], self.plain[at + 4 :]
        return lines.decode("utf-8").split("\r\n")

    def take(self, size: int) -> bytes:
        while len(self.plain) < size:
            if not self.more():
                raise ValueError("the file is cut short")
        out, self.plain = self.plain[:size], self.plain[size:]
        return out


def records(source, chunk: int = CHUNK) -> Iterator[tuple]:
    """Rows of the chunk table from an archive; at most about a chunk is held."""
    stream = Stream(source)
    while (lines := stream.headers()) is not None:
        if lines[0] != "WARC/1.1":
            raise ValueError(f"not a record: {lines[0][:40]}")
        head = {name.lower(): value for name, _, value in (x.partition(": ") for x in lines[1:])}
        block = int(head["content-length"])
        before = stream.headers()
        http = {name.lower(): value for name, _, value in (x.partition(": ") for x in before[1:])}
        left = block - sum(len(x.encode()) + 2 for x in before) - 2
        urn, kind = head["warc-record-id"], head["warc-type"]
        refers = _page(head["warc-refers-to"]) if "warc-refers-to" in head else None
        same = (urn, _page(urn), kind, refers, head.get("warc-target-uri"))
        if kind == "revisit":  # the payload is elsewhere; its size and digest are declared here
            digest = head["warc-payload-digest"].removeprefix("sha1:")
            yield (*same, 0, None, int(http["content-length"]), digest, True)
        else:
            sha1, so_far, number = hashlib.sha1(), 0, 0
            while number == 0 or left:
                data = stream.take(min(chunk, left))
                left -= len(data)
                so_far += len(data)
                sha1.update(data)
                yield (*same, number, data, so_far, base32_sha1(sha1.digest()), left == 0)
                number += 1
            if base32_sha1(sha1.digest()) != head["warc-payload-digest"].removeprefix("sha1:"):
                raise ValueError(f"{urn}: the payload does not match its digest")
        if stream.take(4) != _CRLF + _CRLF:
            raise ValueError(f"{urn}: no end of record")


def read(spark: SparkSession, folder: str, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of all listed archives.

    (record_id, page_id, record_type, refers_to, target, chunk_no, data, bytes_so_far,
    digest_so_far, last). A revisit is one row without data and with the declared size and digest.
    """
    files = spark.read.schema(_FILES).parquet(f"{folder}/files")
    dealt = files.select("file").repartition(max(1, files.count()))
    names = [c.split()[0] for c in _CHUNKS.split(", ")]

    def run(batches):
        store, at = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with store.open_input_stream(f"{at}/warc/{name}", compression=None) as f:
                    held, size = [], 0
                    for row in records(f, chunk):
                        held.append(row)
                        size += len(row[6] or b"") + 200
                        if size >= 4 * chunk:
                            yield _batch(held, names)
                            held, size = [], 0
                    if held:
                        yield _batch(held, names)

    return dealt.mapInArrow(run, _CHUNKS)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    text, long = pa.string(), pa.int64()
    kinds = [text, long, text, long, text, pa.int32(), pa.binary(), long, text, pa.bool_()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def round_trip(pages: DataFrame, least_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Write new archives in the shared folder and read them back as the chunk table.

    One record for each row of `pages`, equal rows included; an empty table gives no files and no
    rows. Columns other than page_id, url and html are not read.
    """
    folder = shared_folder(pages.sparkSession, "warc")
    write(pages, folder, least_bytes, chunk)
    return read(pages.sparkSession, folder, chunk)


def payloads(chunks: DataFrame) -> DataFrame:
    """One row a record: what its last chunk knows."""
    return chunks.where("last").select(
        "page_id",
        F.col("bytes_so_far").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
