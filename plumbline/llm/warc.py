"""Web archives: one gzip member per record, written and read back as files in the shared folder."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.storage import run_folder

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
#: An archive is closed when it has reached this many compressed bytes.
ARCHIVE_BYTES = 256 << 20
#: Bytes read, inflated and taken from a payload at a time.
STEP = 1 << 18
LEVEL = 3


class WarcError(ValueError):
    """An archive that does not keep to the format, or whose digests do not hold."""


def digest_text(raw: bytes) -> str:
    return base64.b32encode(raw).decode()


# ---- writing ----


def record(fields: list[tuple[str, object]], block: list[bytes], level: int = LEVEL) -> bytes:
    """One record as one gzip member."""
    head = VERSION + b"\r\n" + b"".join(f"{name}: {value}\r\n".encode() for name, value in fields) + b"\r\n"
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return b"".join([pack.compress(head), *map(pack.compress, block), pack.compress(b"\r\n\r\n"), pack.flush()])


def page_record(page_id: int, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    raw = hashlib.sha1(payload).digest()
    head = HTTP % len(payload)
    kept = payload if refers_to is None else b""
    block = hashlib.sha1(head)
    block.update(kept)
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}')}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%")),
        ("WARC-Payload-Digest", f"sha1:{digest_text(raw)}"),
        ("WARC-Block-Digest", f"sha1:{digest_text(block.digest())}"),
        ("X-Page-ID", page_id),
        ("X-Payload-Length", len(payload)),
    ]
    if refers_to is not None:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{refers_to}')}>"),
            ("X-Refers-To-Page-ID", refers_to),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(head) + len(kept))]
    return record(fields, [head, kept])


def write_archives(pages: DataFrame, folder: str, date: str = "2026-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write (page_id, url, payload, refers_to) to `folder`; (archive, records, bytes) of the files.

    A file gets its final name when it is complete, and the name does not depend on the attempt, so a task that runs again
    replaces its own files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        done, out, records, size = [], None, 0, 0

        def close():
            nonlocal out, records, size
            out.close()
            name = f"{root}/part-{task.partitionId():06d}-{len(done):05d}.warc.gz"
            store.move(part, name)
            done.append((name.removeprefix(root + "/"), records, size))
            out, records, size = None, 0, 0

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    part = f"{root}/.{task.partitionId():06d}-{len(done):05d}-{task.taskAttemptId()}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(part, compression=None)
                member = page_record(page_id, url, payload, refers_to, date)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    close()
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["archive", "records", "bytes"])

    chosen = pages.select("page_id", "url", "payload", "refers_to")
    return chosen.mapInArrow(run, "archive string, records bigint, bytes bigint")


# ---- reading ----


class Inflated:
    """The bytes of one gzip member after another, inflated as they are asked for."""

    def __init__(self, source):
        self.source, self.raw, self.left, self.over = source, b"", b"", True

    def next_member(self) -> bool:
        """Go to the next member; False at the end of the file. The member before must have been read to its end."""
        if self.left or not self.over:
            raise WarcError("bytes after the end of a record")
        if not self.raw:
            self.raw = self.source.read(STEP)
        if not self.raw:
            return False
        self.inflate, self.over = zlib.decompressobj(31), False
        return True

    def _more(self) -> bool:
        while not self.over:
            if not self.raw:
                self.raw = self.source.read(STEP)
                if not self.raw:
                    raise WarcError("the file ends inside a record")
            try:
                found = self.inflate.decompress(self.raw, STEP)
            except zlib.error as error:
                raise WarcError(f"not a gzip member: {error}") from error
            self.over = self.inflate.eof
            self.raw = self.inflate.unused_data if self.over else self.inflate.unconsumed_tail
            if found:
                self.left += found
                return True
        return False

    def line(self) -> bytes:
        while (at := self.left.find(b"\r\n")) < 0:
            if not self._more():
                raise WarcError("the record ends inside its header")
        found, self.left = self.left[:at], self.left[at + 2 :]
        return found

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.left and not self._more():
                raise WarcError("the record is shorter than its Content-Length")
            found, self.left = self.left[:n], self.left[n:]
            n -= len(found)
            yield found

    def close(self) -> None:
        if b"".join(self.take(4)) != b"\r\n\r\n" or self.left or self._more():
            raise WarcError("the record is longer than its Content-Length")


def read_headers(data: Inflated) -> dict[str, str]:
    found: dict[str, str] = {}
    name = ""
    while line := data.line():
        if line[:1] in b" \t":
            found[name] += " " + line.strip().decode()
            continue
        raw, colon, value = line.partition(b":")
        if not colon:
            raise WarcError(f"not a header line: {line[:80]!r}")
        name = raw.strip().lower().decode()
        found[name] = value.strip().decode()
    return found


def read_records(source) -> Iterator[dict]:
    """The records of an open archive, in order; each block's length and both digests are checked.

    The payload of a response is given as bytes; a revisit has none, and its payload digest is that of the record it
    refers to.
    """
    data = Inflated(source)
    while data.next_member():
        version = data.line()
        if not version.startswith(b"WARC/"):
            raise WarcError(f"not a record: {version[:80]!r}")
        fields = read_headers(data)
        length = int(fields["content-length"])
        block, whole = hashlib.sha1(), []
        for part in data.take(length):
            block.update(part)
            whole.append(part)
        data.close()
        body = b"".join(whole)
        head, blank, payload = body.partition(b"\r\n\r\n")
        if fields.get("content-type", "").startswith("application/http"):
            if not blank:
                raise WarcError("the block has no end of its HTTP header")
        else:
            payload = body
        said = fields.get("warc-block-digest")
        if said and said != f"sha1:{digest_text(block.digest())}":
            raise WarcError(f"block digest of {fields.get('warc-record-id')} does not hold")
        revisit = fields["warc-type"] == "revisit"
        said = fields.get("warc-payload-digest")
        if said and not revisit and said != f"sha1:{digest_text(hashlib.sha1(payload).digest())}":
            raise WarcError(f"payload digest of {fields.get('warc-record-id')} does not hold")
        yield {"fields": fields, "payload": None if revisit else payload}


FIELDS = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"


def read_archives(archives: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records of the named archives of `folder`, one task per archive; `payload` adds the payload as binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        names = [x.split()[0] for x in FIELDS.split(", ")] + ["payload"] * payload
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * payload

        def rows(found):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                found, size = [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                    for one in read_records(source):
                        f = one["fields"]
                        row = (
                            int(f["x-page-id"]),
                            f.get("warc-target-uri"),
                            f["warc-type"],
                            int(f["x-payload-length"]) if one["payload"] is None else len(one["payload"]),
                            f["warc-payload-digest"].removeprefix("sha1:"),
                            int(f["x-refers-to-page-id"]) if "x-refers-to-page-id" in f else None,
                        )
                        found.append(row + (one["payload"],) * payload)
                        size += len(one["payload"] or b"") * payload + 200
                        if size > 8 << 20:
                            yield rows(found)
                            found, size = [], 0
                if found:
                    yield rows(found)

    return archives.select("archive").mapInArrow(run, FIELDS + ", payload binary" * payload)


# ---- operator ----


def archive_pages(pages: DataFrame, folder: str, min_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write every page as a record below `folder`; (archive, records, bytes).

    Of the pages with equal payloads of at least `min_bytes` bytes, the one with the smallest id is the response and the
    others refer to it; smaller payloads are all responses. A null html is the empty payload, a null url the empty one;
    rows with a null id are an error. A repeated id with an equal payload is a response again, not a revisit of itself.
    An empty table writes no archive. Other columns are ignored.
    """
    rows = pages.select(
        F.when(F.col(page_id).isNotNull(), F.col(page_id).cast("bigint"))
        .otherwise(F.raise_error(F.lit("a page has no id"))).alias("page_id"),
        F.col(url).alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    first = rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").select("digest", "first")
    placed = rows.join(first, "digest", "left").select(
        "page_id", "url", "payload",
        F.when((F.col("first") != F.col("page_id")) & (F.octet_length("payload") >= min_bytes), F.col("first")).alias("refers_to"),
    )
    return write_archives(placed, folder)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0, payload: bool = False) -> DataFrame:
    """Archive the pages in a new folder and read the archives back."""
    folder = run_folder(spark, "warc")
    listing = f"{folder}/archives.parquet"
    files = f"{folder}/files"
    if "://" not in files and not files.startswith("file:"):
        files = f"file://{files}"
    archive_pages(pages, files, min_bytes).write.parquet(listing)
    names = spark.read.parquet(listing)
    return read_archives(names.repartition(max(1, names.count())), files, payload)


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page archived and read back."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return round_trip(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
