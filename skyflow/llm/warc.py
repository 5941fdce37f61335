"""Web archives (WARC) compressed with Zstandard: written by tasks, read record by record.

An archive starts with a skippable frame that holds a dictionary, trained on the archive's first
records; each record after it is one frame. Readers load the dictionary, decode a frame at a time
and check headers and lengths. Tasks write archives of their own under names used once, and hand
back the names, so an archive that a lost task has left behind is in no list and is not read.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm import common
from skyflow.plans.staging import new_folder, staged

# Numbers of the frame formats, and names of the record format.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE_FRAMES = range(0x184D2A50, 0x184D2A60)
ZSTANDARD_FRAME = bytes.fromhex("28b52ffd")
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
REQUIRED = ("warc-record-id", "warc-date", "warc-type", "content-length")
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads with fewer bytes are stored as often as they occur.
LEAST_SHARED = 100
#: Bytes of an archive after which a task starts another.
ARCHIVE_BYTES = 256 * 1024 * 1024
#: Bytes of the first records a dictionary is trained on, the largest record used, and the dictionary's size.
TRAIN_BYTES, TRAIN_RECORD, DICTIONARY_BYTES = 1024 * 1024, 64 * 1024, 16 * 1024
LEVEL = 3
#: Bytes read at a time.
CHUNK = 64 * 1024
#: Tasks that read archives, if there are so many.
MOST_TASKS = 20_000
PAGE_ID = "<urn:page:"

RECORDS = (
    "archive string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary, problem string"
)


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark names it, and the path there."""
    path = re.sub(r"^file:/*", "/", path)
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record; the length of its block is added to ``fields``."""
    lines = [*(f"{name}: {value}" for name, value in fields), f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _uri(url: str | None) -> str:
    """A value for a header line: white space and control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:none")


def page_record(page: dict, date: str) -> bytes:
    """The record of a page: a response with its payload, or a revisit of the page ``first``.

    Both have the payload's digest, and its length in the header of the stored HTTP message.
    """
    payload = (page["html"] or "").encode()
    number = "null:" + uuid.uuid4().hex if page["page_id"] is None else page["page_id"]
    kind = "response" if page["first"] is None else "revisit"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"{PAGE_ID}{number}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", _uri(page["url"])),
        ("WARC-Payload-Digest", f"sha256:{page['digest']}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"{PAGE_ID}{page['first']}>")]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['n_bytes']}\r\n\r\n"
    return record(fields, head.encode() + (payload if kind == "response" else b""))


class _Archive:
    """An archive being written; its first records wait until there are enough to train on."""

    def __init__(self, system: pafs.FileSystem, folder: str, date: str):
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        # By the file's name the stream would compress once more.
        self.stream = system.open_output_stream(f"{folder}/{self.name}", compression=None)
        self.waiting, self.held, self.records, self.compressor = [], 0, 0, None
        info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date)]
        self.add(record([*info, ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))

    def add(self, data: bytes) -> None:
        self.records += 1
        if self.compressor:
            self.stream.write(self.compressor.compress(data))
        else:
            self.waiting.append(data)
            self.held += len(data)
            if self.held >= TRAIN_BYTES:
                self._start()

    def _start(self) -> None:
        try:
            samples = [x for x in self.waiting if len(x) <= TRAIN_RECORD]
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
        except zstandard.ZstdError:  # too little to train on: an archive may go without a dictionary
            trained = None
        if trained:
            content = trained.as_bytes()
            self.stream.write(DICTIONARY_FRAME.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
        for data in self.waiting:
            self.stream.write(self.compressor.compress(data))
        self.waiting = []

    def size(self) -> int:
        return self.stream.tell()

    def close(self) -> dict:
        if not self.compressor:
            self._start()
        size = self.stream.tell()
        self.stream.close()
        return {"name": self.name, "records": self.records, "bytes": size}


def with_first(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, url, html, n_bytes, digest, first), one per page.

    ``first`` is the smallest id among pages with the same payload of ``LEAST_SHARED`` bytes or more, where it is another
    one; html is null then, as the record holds none. Only payloads that occur under several ids are looked up. Those with
    more than a thousandth of all rows are sent to every task, a thousand at most, so a hot payload needs no task of its own.
    """
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), html.alias("html")
    ).select("*", F.octet_length("html").cast("long").alias("n_bytes"), F.sha2(F.col("html").cast("binary"), 256).alias("digest"))
    groups = rows.filter(F.col("n_bytes") >= LEAST_SHARED).groupBy("digest").agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
    shared = staged(groups.filter("n > 1"), "warc-shared")
    found = common.hot_lookup(rows, shared, "digest", {"least": "least"}, "n")
    first = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("least")), F.col("least"))
    return found.withColumn("first", first).select(
        "page_id", "url", F.when(F.col("first").isNull(), F.col("html")).alias("html"), "n_bytes", "digest", "first"
    )


def write_archives(pages: DataFrame, folder: str, *, date: str | None = None, **columns: str) -> DataFrame:
    """Write a record per page to archives in ``folder``; rows (path, records, bytes) of the archives, stored beside them.

    ``folder`` is one that all executors reach. Records have ``date``, by default the time of the call. Null html is an
    empty payload, a null url is written as ``urn:none``. Pages without id get a record id that is used nowhere else; they
    are revisits if a page with an id has their payload, else responses. Rows that repeat the first page of a payload
    are responses like it. Without pages there are no archives.
    """
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        system, place = _opened(folder)
        for batch in common.slices(batches):
            for page in batch.to_pylist():
                if archive is None:
                    system.create_dir(place, recursive=True)
                    archive = _Archive(system, place, date)
                archive.add(page_record(page, date))
                if archive.size() >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        for made in done:
            made["path"] = f"{folder}/{made.pop('name')}"
        yield pa.RecordBatch.from_pylist(done, pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    made = with_first(pages, **columns).mapInArrow(common.releasing(run), "path string, records long, bytes long")
    return staged(made, "archives", f"{folder}/list")


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (path, bytes) of all archives below ``folder``, for archives that others wrote."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("length").alias("bytes"))


def frames(stream) -> Iterator[tuple[int, bytes | None, str | None]]:
    """Place, content and fault of every frame of an archive.

    What follows a frame that cannot be decoded is not found, so it is the last.
    """
    buffer, offset, decoder = b"", 0, None

    def has(size: int) -> bool:
        nonlocal buffer
        parts, there = [buffer], len(buffer)
        while there < size and (chunk := stream.read(max(CHUNK, size - there))):
            parts.append(chunk)
            there += len(chunk)
        buffer = b"".join(parts)
        return there >= size

    while has(1):
        if not has(4):
            yield offset, None, "frame cut off"
            return
        if int.from_bytes(buffer[:4], "little") in SKIPPABLE_FRAMES:
            size = int.from_bytes(buffer[4:8], "little") if has(8) else 0
            if not has(8 + size) or len(buffer) < 8:
                yield offset, None, "frame cut off"
                return
            if offset == 0 and int.from_bytes(buffer[:4], "little") == DICTIONARY_FRAME:
                content = buffer[8 : 8 + size]
                try:
                    if content.startswith(ZSTANDARD_FRAME):  # the dictionary itself may be compressed
                        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
                except zstandard.ZstdError as error:
                    yield offset, None, f"dictionary: {error}"
                    return
            buffer, offset = buffer[8 + size :], offset + 8 + size
            continue
        decoder = decoder or zstandard.ZstdDecompressor()
        frame, parts, used = decoder.decompressobj(), [], 0
        try:
            while True:
                parts.append(frame.decompress(buffer))
                used += len(buffer)
                if frame.eof:
                    break
                buffer = stream.read(CHUNK)
                if not buffer:
                    yield offset, None, "frame cut off"
                    return
        except zstandard.ZstdError as error:
            yield offset, None, f"frame: {error}"
            return
        buffer = frame.unused_data
        yield offset, b"".join(parts), None
        offset += used - len(buffer)


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Header fields by lower-case name; a line that starts with white space continues the one before."""
    found: dict[str, str] = {}
    name = None
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and name:
            found[name] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        name = name.strip().lower()
        if not colon or not name:
            raise ValueError("header line without a name")
        if name in found and name in REQUIRED:
            raise ValueError(f"{name} stands twice")
        found[name] = value.strip()
    return found


def parsed(data: bytes) -> dict:
    """A record's type, ids, payload and digest; ValueError if headers, lengths or the digest are wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version not in VERSIONS or not gap:
        raise ValueError("no record header")
    fields = _fields(lines)
    for name in REQUIRED:
        if not fields.get(name):
            raise ValueError(f"{name} is missing")
    if not re.fullmatch("[0-9]+", fields["content-length"]):
        raise ValueError("content-length is no number")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, content-length {length}")
    payload = rest[:length]
    kind, size = fields["warc-type"], length
    if fields.get("content-type", "").startswith("application/http"):
        message, gap, payload = payload.partition(b"\r\n\r\n")
        if not gap:
            raise ValueError("HTTP header without an end")
        told = _fields(message.split(b"\r\n")[1:]).get("content-length", str(len(payload)))
        if not re.fullmatch("[0-9]+", told):
            raise ValueError("HTTP content-length is no number")
        size = int(told)
        if kind != "revisit" and size != len(payload):
            raise ValueError(f"payload of {len(payload)} bytes, HTTP content-length {size}")
    if kind == "revisit" and not fields.get("warc-refers-to"):
        raise ValueError("revisit without warc-refers-to")
    algorithm, _, digest = fields.get("warc-payload-digest", "").partition(":")
    if kind != "revisit":
        own = hashlib.sha256(payload).hexdigest()
        if algorithm == "sha256" and digest != own:
            raise ValueError("payload differs from its digest")
        digest = own
    return {
        "record_type": kind,
        "record_id": fields["warc-record-id"],
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload,
    }


def read_archives(archives: DataFrame, *, payloads: bool = True) -> DataFrame:
    """Rows ``RECORDS`` of the archives of column ``path``; a task reads an archive piece by piece.

    ``payload_digest`` is the SHA-256 of the payload, of revisits what their record says; ``payload`` is null unless
    wanted. A record with wrong headers, lengths or digest has only its place and the ``problem``. So has a frame that
    cannot be decoded, after which the archive is not read further. Empty archives have no records.
    """
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in RECORDS.split(", ")])

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{name: row.get(name) for name in names} for row in rows], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (path for batch in batches for path in batch["path"].to_pylist()):
            system, place = _opened(path)
            rows, held = [], 0
            with system.open_input_stream(place, compression=None) as stream:
                for offset, data, problem in frames(stream):
                    row = {"archive": path, "offset": offset, "problem": problem}
                    if data is not None:
                        try:
                            row |= parsed(data)
                        except ValueError as error:
                            row["problem"] = str(error)
                    if not payloads:
                        row.pop("payload", None)
                    rows.append(row)
                    held += len(row.get("payload") or b"")
                    if len(rows) >= 4096 or held >= 1 << 24:
                        yield batch_of(rows)
                        rows, held = [], 0
            yield batch_of(rows)

    tasks = max(1, min(archives.count(), MOST_TASKS))
    return archives.select("path").repartition(tasks).mapInArrow(common.releasing(run), RECORDS)


def report(pages: DataFrame, **columns: str) -> DataFrame:
    """Rows (page_id, payload_bytes, payload_digest, record_type, refers_to), read back from archives of all pages.

    Archives lie in a new folder below the shared one. A record with a problem fails the query. Very long payloads
    are one record each and stand in memory one at a time. Other columns of ``pages`` are not looked at.
    """
    archives = write_archives(pages, new_folder(pages.sparkSession, "warc"), **columns)
    records = read_archives(archives, payloads=False)
    sound = F.when(F.col("problem").isNull(), F.col("record_type")).otherwise(
        F.raise_error(F.concat_ws(" ", "archive", "offset", "problem"))
    )
    number = lambda name: F.regexp_extract(name, f"^{PAGE_ID}(-?[0-9]+)>$", 1).try_cast("long")
    return (
        records.withColumn("record_type", sound)
        .filter(F.col("record_type").isin("response", "revisit"))
        .select(
            number("record_id").alias("page_id"),
            "payload_bytes",
            "payload_digest",
            "record_type",
            number("refers_to").alias("refers_to"),
        )
    )
