"""WARC archives compressed with Zstandard, written and read by tasks.

An archive starts with a skippable frame that holds a dictionary; then comes one
frame per record, so that each can be decoded alone. The dictionary is made
from the first ``SAMPLE_BYTES`` of an archive's own payloads: it changes the
size of the file, never what is read back. Each task writes its rows to files of
about ``archive_bytes`` of payload under names of its own attempt; the names go
to a manifest that Spark commits, so files of lost or repeated attempts are never
read.

``write`` gives every row one record. Of rows with equal payloads (same SHA-256)
of at least ``min_bytes`` bytes, those with the largest id are responses and the
others revisit it, as records without a payload: their HTTP header and their
digest tell the full one. Of rows with the largest id, copies are all responses;
null ids come below all others, and if all are null, all are responses. Smaller payloads
are all responses. A null payload is empty, a null url has no target field; in urls,
control characters, blanks and what is not ASCII are percent-encoded. An empty table gives
a manifest without rows; extra columns are ignored. Payloads of any length stay whole: a task
holds one record at a time, and the sample.

``read`` streams each archive frame by frame and fails on a bad magic number, a
frame that is cut off, a header without its fields, a wrong length or digest, or
a number of records that is not the manifest's.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm.common import release, store_of, text_slices
from fleetscope.operators.spread import spread_lookup

#: Fixed values of the formats: a skippable frame for dictionaries, other skippable frames, a frame of data, a
#: dictionary, the version line, and the profile of a revisit.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME = 0xFD2FB528
DICTIONARY = 0xEC30A437
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 64 << 20
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
#: The date of records for rows that have none.
DATE = dt.datetime(2000, 1, 1)
READ_BYTES = 1 << 20


class Record(NamedTuple):
    """A record's type, its named fields in lower case, and its block."""

    kind: str
    fields: dict[str, str]
    block: bytes


class BadArchive(ValueError):
    pass


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- Records --------------------------------------------------------------------------


def record_bytes(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}".encode()]
    lines += [f"{name}: {value}".encode() for name, value in fields.items()]
    return b"\r\n".join([*lines, b"Content-Length: %d" % len(block), b"", block, b"", b""])


def parse_record(data: bytes) -> Record:
    """The one record that a frame holds."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not lines[0].startswith(b"WARC/1."):
        raise BadArchive("a frame holds no WARC record")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise BadArchive(f"not a header field: {line[:80]!r}")
        fields[name.strip().lower().decode()] = value.strip().decode()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise BadArchive(f"a record without {name}")
    if not fields["content-length"].isdigit() or rest[int(fields["content-length"]) :] != b"\r\n\r\n":
        raise BadArchive(f"{fields['warc-record-id']}: the length is wrong")
    return Record(fields["warc-type"], fields, rest[:-4])


def payload_of(record: Record) -> tuple[int, str, bytes | None]:
    """Bytes and digest of the full payload of a response or revisit, and the payload itself if the record has it."""
    head, gap, payload = record.block.partition(b"\r\n\r\n")
    lengths = [x.partition(b":")[2].strip() for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not gap or len(lengths) != 1 or not lengths[0].isdigit():
        raise BadArchive(f"{record.fields['warc-record-id']}: no HTTP header")
    name, _, digest = record.fields.get("warc-payload-digest", "").partition(":")
    if name != "sha1" or not digest:
        raise BadArchive(f"{record.fields['warc-record-id']}: no payload digest")
    if record.kind == "revisit":
        if payload or "warc-refers-to" not in record.fields:
            raise BadArchive(f"{record.fields['warc-record-id']}: not a revisit of an equal payload")
        return int(lengths[0]), digest, None
    if len(payload) != int(lengths[0]) or digest_of(payload) != digest:
        raise BadArchive(f"{record.fields['warc-record-id']}: payload and digest or length differ")
    return len(payload), digest, payload


# --- Frames ---------------------------------------------------------------------------


def dictionary_frame(data: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(data)) + data


class _Input:
    """A file that gives exact numbers of bytes, and takes back what was not used."""

    def __init__(self, file: BinaryIO):
        self.file, self.held = file, b""

    def some(self) -> bytes:
        data, self.held = self.held or self.file.read(READ_BYTES), b""
        return data

    def exactly(self, n: int) -> bytes:
        out = [self.some()]
        size = len(out[0])
        while size < n and (more := self.some()):
            out.append(more)
            size += len(more)
        data = b"".join(out)
        self.held = data[n:]
        return data[:n]


def frames(file: BinaryIO) -> Iterator[bytes]:
    """The data of each frame, one after the other; the dictionary in front is loaded."""
    import zstandard

    source, first, dictionary = _Input(file), True, None
    while magic := source.exactly(4):
        number = struct.unpack("<I", magic)[0] if len(magic) == 4 else 0
        if number in SKIPPABLE:
            size = source.exactly(4)
            body = source.exactly(struct.unpack("<I", size)[0]) if len(size) == 4 else b""
            if len(size) < 4 or len(body) < struct.unpack("<I", size)[0]:
                raise BadArchive("a skippable frame is cut off")
            if first and number == DICTIONARY_FRAME:
                if body[:4] == struct.pack("<I", FRAME):
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                if body[:4] != struct.pack("<I", DICTIONARY):
                    raise BadArchive("the frame in front holds no dictionary")
                dictionary = zstandard.ZstdCompressionDict(body)
        elif number == FRAME:
            # Frames of one archive share the dictionary; a decoder ends with its frame.
            decoder = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            out, chunk = [], magic
            try:
                while not decoder.eof:
                    if not chunk:
                        raise BadArchive("a frame is cut off")
                    out.append(decoder.decompress(chunk))
                    chunk = b"" if decoder.eof else source.some()
            except zstandard.ZstdError as error:
                raise BadArchive(str(error)) from error
            source.held = decoder.unused_data + source.held
            yield b"".join(out)
        else:
            raise BadArchive("not a frame")
        first = False


def records(file: BinaryIO) -> Iterator[Record]:
    for frame in frames(file):
        yield parse_record(frame)


# --- Files of any store that Arrow knows ----------------------------------------------


class Archive:
    """An open archive. The first records wait until there is enough text for a dictionary."""

    def __init__(self, folder: str, date: str):
        task = TaskContext.get()
        self.name = f"part-{task.partitionId() if task else 0:05d}-{uuid.uuid4().hex}.warc.zst"
        store, path = store_of(folder)
        self.file = store.open_output_stream(f"{path}/{self.name}", compression=None)
        self.size = self.records = self.payload = self.waiting_bytes = 0
        self.waiting: list[bytes] = []
        self.coder = None
        about = f"software: fleetscope\r\nformat: {VERSION.decode()}\r\n".encode()
        self.add(record_bytes("warcinfo", {
            "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, self.name)}>", "WARC-Date": date,
            "WARC-Filename": self.name, "Content-Type": "application/warc-fields"}, about), 0)

    def add(self, record: bytes, payload: int) -> None:
        self.records += 1
        self.payload += payload
        if self.coder:
            return self._put(self.coder.compress(record))
        self.waiting.append(record)
        self.waiting_bytes += len(record)
        if self.waiting_bytes >= SAMPLE_BYTES:
            self._start()

    def _start(self) -> None:
        import zstandard

        dictionary = None
        samples = [r[:SAMPLE_BYTES] for r in self.waiting]
        try:
            dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8, threads=0)
        except zstandard.ZstdError:  # too few records, or too much alike
            pass
        if dictionary:
            self._put(dictionary_frame(dictionary.as_bytes()))
            dictionary.precompute_compress(level=LEVEL)
        self.coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        for record in self.waiting:
            self._put(self.coder.compress(record))
        self.waiting = []

    def _put(self, data: bytes) -> None:
        self.file.write(data)
        self.size += len(data)

    def close(self) -> dict[str, object]:
        if not self.coder:
            self._start()
        self.file.close()
        return {"file": self.name, "bytes": self.size, "records": self.records}


# --- Writing --------------------------------------------------------------------------


def _http_head(length: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length


def _urn(key: int | None) -> str:
    return f"<urn:row:{'' if key is None else key}>"


def _row_id(urn: str) -> int | None:
    number = urn.removeprefix("<urn:row:").removesuffix(">")
    if urn != f"<urn:row:{number}>":
        raise BadArchive(f"not an id of a row: {urn}")
    return int(number) if number else None


_MANIFEST = "file string, bytes long, records long"


def _writer(folder: str, archive_bytes: int, date: str) -> Callable:
    schema = pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])

    def run(batches):
        archive = None
        for batch in text_slices(batches, "_payload"):
            for row in batch.to_pylist():
                payload = (row["_payload"] or "").encode()
                fields = {"WARC-Record-ID": _urn(row["_id"]), "WARC-Date": date}
                if row["_url"] is not None:
                    fields["WARC-Target-URI"] = quote(row["_url"], safe="!#$%&'()*+,/:;=?@[]~\"<>\\^`{|}")
                fields["WARC-Payload-Digest"] = f"sha1:{digest_of(payload)}"
                fields["Content-Type"] = "application/http;msgtype=response"
                head, kind = _http_head(len(payload)), "response"
                if row["_revisits"]:
                    kind, fields["WARC-Profile"], fields["WARC-Refers-To"] = "revisit", SAME_PAYLOAD, _urn(row["_last"])
                    payload = b""
                if archive is None:
                    archive = Archive(folder, date)
                archive.add(record_bytes(kind, fields, head + payload), len(payload))
                if archive.payload >= archive_bytes:
                    yield pa.RecordBatch.from_pylist([archive.close()], schema)
                    archive = None
        if archive is not None:
            yield pa.RecordBatch.from_pylist([archive.close()], schema)
        release()

    return run


def with_revisits(rows: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds _last, the largest id with the row's payload, and _revisits.

    Payloads are counted by digest before anything is joined; the rows of a
    frequent one are spread.
    """
    marked = rows.withColumn("_same", F.sha2(F.coalesce("_payload", F.lit("")), 256))
    counted = marked.filter(F.coalesce(F.octet_length("_payload"), F.lit(0)) >= min_bytes)
    last = counted.groupBy("_same").agg(F.max("_id").alias("_last"), F.count(F.lit(1)).alias("_copies"))
    last = last.filter("_copies > 1").drop("_copies")
    joined = spread_lookup(marked, last, ["_same"], "_id", "left")
    revisits = F.col("_last").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_last"))
    return joined.withColumn("_revisits", revisits).drop("_same")


def write(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    date: dt.datetime = DATE,
) -> None:
    """Write archives and their manifest to ``folder``, which all executors share."""
    rows = pages.select(F.col(key).cast("long").alias("_id"), F.col(url).alias("_url"), F.col(payload).alias("_payload"))
    spark = pages.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/archives")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    run = _writer(f"{folder}/archives", archive_bytes, date.strftime("%Y-%m-%dT%H:%M:%SZ"))
    written = with_revisits(rows, min_bytes).select("_id", "_url", "_payload", "_last", "_revisits")
    written.mapInArrow(run, _MANIFEST).write.parquet(f"{folder}/manifest")


# --- Reading --------------------------------------------------------------------------

RECORDS = (
    "file string, record_type string, row_id long, url string, payload_bytes long, payload_digest string, "
    "refers_to long, payload string"
)


def _reader(folder: str, with_payload: bool) -> Callable:
    schema = pa.schema(
        [("file", pa.string()), ("record_type", pa.string()), ("row_id", pa.int64()), ("url", pa.string()),
         ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
         ("payload", pa.string())]
    )

    def rows(file: str, count: int | None) -> Iterator[tuple]:
        store, path = store_of(folder)
        number = 0
        with store.open_input_stream(f"{path}/{file}", compression=None) as data:
            for record in records(data):
                number += 1
                if record.kind in ("response", "revisit"):
                    size, digest, payload = payload_of(record)
                    to = _row_id(record.fields["warc-refers-to"]) if record.kind == "revisit" else None
                    text = payload.decode() if with_payload and payload is not None else None
                    target = record.fields.get("warc-target-uri")
                    yield file, record.kind, _row_id(record.fields["warc-record-id"]), target, size, digest, to, text
        if count is not None and number != count:
            raise BadArchive(f"{file} has {number} records instead of {count}")

    def run(batches):
        for batch in batches:
            for file in batch.to_pylist():
                held, size = [], 0
                for row in rows(file["file"], file["records"]):
                    held.append(row)
                    size += len(row[-1] or "") + 100
                    if size >= READ_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
        release()

    return run


def read_archives(files: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Records (RECORDS) of the archives ``files`` (file, records or null) below ``folder``."""
    # A file is a task's work; they are few rows, so the shuffle is small.
    many = max(1, files.count())
    return files.select("file", "records").repartition(many).mapInArrow(_reader(folder, with_payload), RECORDS)


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The responses and revisits of all archives that ``write`` committed to ``folder``."""
    files = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    return read_archives(files, f"{folder}/archives", with_payload)
