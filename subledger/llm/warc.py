"""WARC archives as a Python data source, read and written in parallel.

Reading plans one partition per file. Predicates on the record type and on other header fields are pushed down:
a record's headers are parsed first, and a record that fails them, or whose payload no requested column needs, is
skipped without decoding its payload. In compressed files the skip uses the length that the writer stores in each
member's gzip header; files without it are read through. Which columns are wanted follows from the schema given to
the reader.

Writing makes one record per row and one gzip member per record. Tasks write aside, and the commit moves finished
files into place, so a repeated task leaves no second copy.

Null or empty payloads are records with an empty payload; null ids and addresses leave out their header line; line
breaks in header values are percent-encoded. Repeated rows are repeated records; an empty table gives no record.
Columns that the writer does not know are not written.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull,
    StringStartsWith, WriterCommitMessage,
)

from subledger.llm.common import table
from subledger.session import scratch_path

RECORD = (
    "file string, offset long, record_type string, record_id string, target_uri string, date string, digest string, "
    "refers_to string, content_length long, http_length long, payload_length long, payload_digest string, payload binary"
)
# Columns that only the decoded payload gives.
DECODED = {"payload_length", "payload_digest", "payload"}
# Header names and the revisit profile of the format's public specification.
HEADERS = {
    "record_type": b"WARC-Type", "record_id": b"WARC-Record-ID", "target_uri": b"WARC-Target-URI",
    "date": b"WARC-Date", "digest": b"WARC-Payload-Digest", "refers_to": b"WARC-Refers-To",
}
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
HEAD_BYTES = 4096
FILE_BYTES = 64 << 20
LEVEL = 1


def base32_sha1(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it, for any address that pyarrow knows."""
    if "://" not in path and path.startswith("file:"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def member(record: bytes) -> bytes:
    """A gzip member whose header tells its own length, so that readers can skip it."""
    deflater = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = deflater.compress(record) + deflater.flush()
    size = 24 + len(body) + 8
    told = (size, len(record)) if size < 1 << 32 and len(record) < 1 << 32 else (0, 0)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"SL", 8, *told)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _value(text: str) -> bytes:
    return text.replace("\r", "%0D").replace("\n", "%0A").encode()


def record(row: dict) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP header alone."""
    payload = row.get("payload") or b""
    if isinstance(payload, str):
        payload = payload.encode()
    revisit = row["record_type"] == "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + END
    block = http if revisit else http + payload
    lines = [b"WARC/1.1"]
    fields = {**row, "digest": f"sha1:{base32_sha1(payload)}", "date": row.get("date") or "1970-01-01T00:00:00Z"}
    for column, name in HEADERS.items():
        value = fields.get(column)
        if value is not None:
            value = f"<{value}>" if column in ("record_id", "refers_to") else value
            lines.append(name + b": " + _value(value))
    if revisit:
        lines.append(b"WARC-Profile: " + PROFILE)
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + END + block + END


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceArrowWriter):
    """Writes columns of ``RECORD`` (``payload`` binary or string; digests are computed)."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.most = int(options.get("file_bytes", FILE_BYTES))
        self.aside = f".writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = opened(self.path)
        names, out = [], None
        for batch in iterator:
            for row in range(batch.num_rows):
                data = member(record({n: batch.column(i)[row].as_py() for i, n in enumerate(batch.schema.names)}))
                if out is None or out.tell() + len(data) > self.most:
                    if out is not None:
                        out.close()
                    else:
                        system.create_dir(f"{root}/{self.aside}", recursive=True)
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out = system.open_output_stream(f"{root}/{self.aside}/{names[-1]}", compression=None)
                out.write(data)
        if out is not None:
            out.close()
        return _Written(names)

    def commit(self, messages: list) -> None:
        system, root = opened(self.path)
        system.create_dir(root, recursive=True)
        for message in messages:
            for name in message.names if message else ():
                system.move(f"{root}/{self.aside}/{name}", f"{root}/{name}")
        self._clear(system, root)

    def abort(self, messages: list) -> None:
        self._clear(*opened(self.path))

    def _clear(self, system, root):
        if system.get_file_info(f"{root}/{self.aside}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{self.aside}")


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    """Reads the columns of its schema; see the module."""

    def __init__(self, schema, options: dict):
        self.schema, self.path = schema, options["path"]
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            on_header = len(one.attribute) == 1 and one.attribute[0] in HEADERS if hasattr(one, "attribute") else False
            if on_header and isinstance(one, (EqualTo, In, IsNotNull, IsNull, StringStartsWith)):
                self.filters.append(one)
            else:
                yield one

    def partitions(self) -> list[InputPartition]:
        system, root = opened(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        # Largest first, so that the last tasks are short.
        files = sorted((f for f in found if f.is_file and f.path.endswith((".warc", ".warc.gz"))), key=lambda f: (-f.size, f.path))
        inside = [f for f in files if "/.writing-" not in f.path]
        return [_File(f.path) for f in inside] or [_File("")]

    def _passes(self, fields: dict) -> bool:
        for one in self.filters:
            value = fields.get(one.attribute[0])
            if isinstance(one, IsNull):
                ok = value is None
            elif value is None:
                ok = False
            elif isinstance(one, EqualTo):
                ok = value == one.value
            elif isinstance(one, In):
                ok = value in one.value
            elif isinstance(one, StringStartsWith):
                ok = value.startswith(one.value)
            else:
                ok = True
            if not ok:
                return False
        return True

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        if not partition.path:
            return
        shape = to_arrow_schema(self.schema)
        decode = bool(DECODED & set(shape.names))
        system, _ = opened(self.path)
        rows, held = [], 0
        with system.open_input_file(partition.path) as file:
            for fields in records(file, partition.path.endswith(".gz"), decode, self._passes):
                fields["file"] = partition.path
                rows.append({n: fields.get(n) for n in shape.names})
                held += 256 + (len(fields["payload"] or b"") if "payload" in shape.names else 0)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=shape)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=shape)


def _fields(head: bytes) -> dict:
    lines = dict(line.split(b":", 1) for line in head.split(b"\r\n")[1:] if b":" in line)
    found = {c: v.strip().decode() for c, n in HEADERS.items() if (v := lines.get(n)) is not None}
    for column in ("record_id", "refers_to"):
        if column in found:
            found[column] = found[column].removeprefix("<").removesuffix(">")
    if "digest" in found:
        found["digest"] = found["digest"].removeprefix("sha1:")
    found["content_length"] = int(lines[b"Content-Length"])
    return found


def _http(block: bytes) -> tuple[int, int | None]:
    """Where the payload begins in a block, and the length its header states."""
    end = block.find(END)
    if not block.startswith(b"HTTP/") or end < 0:
        return 0, None
    for line in block[:end].split(b"\r\n"):
        if line.lower().startswith(b"content-length:"):
            return end + 4, int(line[15:])
    return end + 4, None


def records(file, packed: bool, decode: bool, wanted) -> Iterator[dict]:
    """Records of an archive file that ``wanted`` accepts by their headers; payloads only if ``decode``."""
    at, size = 0, file.size()

    def from_plain(start, first):
        file.seek(start)
        return file.read(first)

    while at < size:
        if packed:
            skip, read = _packed(file, at)
        else:
            skip, read = None, lambda first, start=at: from_plain(start, first)
        head, grown = read(HEAD_BYTES), HEAD_BYTES
        while (end := head.find(END)) < 0 and len(head) >= grown:
            grown *= 4
            head = read(grown)
        if end < 0:
            raise ValueError("a record without end of headers")
        fields = _fields(head[:end])
        fields["offset"] = at
        total = end + 4 + fields["content_length"]
        if wanted(fields):
            # The HTTP header stands at the head of the block; only a decoded payload needs the whole.
            while len(head) < total and b"HTTP/".startswith(head[end + 4:end + 9]) and head.find(END, end + 4) < 0:
                grown *= 4
                head = read(min(grown, total))
            block = (read(total) if decode and len(head) < total else head)[end + 4:total]
            start, fields["http_length"] = _http(block)
            if decode:
                payload = block[start:]
                fields["payload"] = payload
                if fields.get("record_type") != "revisit":
                    fields["payload_length"], fields["payload_digest"] = len(payload), base32_sha1(payload)
            yield fields
        at = at + total + 4 if not packed else skip() if callable(skip) else at + skip


def _packed(file, at: int):
    """(Length of the member at ``at`` or a function that finds its end, reader of its first bytes)."""
    file.seek(at)
    head = file.read(24)
    told = 0
    if head[:4] == b"\x1f\x8b\x08\x04" and head[12:14] == b"SL":
        told = struct.unpack("<I", head[16:20])[0]

    def read(first):
        file.seek(at)
        inflater, out, source = zlib.decompressobj(31), b"", b""
        step = min(told, HEAD_BYTES) or HEAD_BYTES
        if first > HEAD_BYTES:
            step = told or 1 << 20
        while len(out) < first and not inflater.eof:
            source = inflater.unconsumed_tail or file.read(step)
            if not source:
                break
            out += inflater.decompress(source, first - len(out))
        return out

    def end():
        file.seek(at)
        inflater, used = zlib.decompressobj(31), 0
        while not inflater.eof:
            source = file.read(1 << 20)
            if not source:
                raise ValueError("a member is cut off")
            inflater.decompress(source)
            used += len(source)
        return at + used - len(inflater.unused_data)

    return told or end, read


class WarcDataSource(DataSource):
    """``spark.read.format("warc").schema(columns).load(path)`` and ``df.write.format("warc").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema, overwrite) -> DataSourceArrowWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Makes the format known to a session and lets it push predicates down."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """Records of ``pages`` (``id``, ``url``, ``html``): of equal payloads of ``least`` bytes or more, the one with
    the largest id is the response and the others revisit it; rows that tie for it are all responses."""
    payload = F.coalesce("html", F.lit(""))
    hashed = pages.select("id", "url", "html", F.sha1(payload).alias("_sha1"))
    lead = (
        hashed.where(F.octet_length(payload) >= least).groupBy(F.col("_sha1").alias("_same"))
        .agg(F.max("id").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    )
    revisit = F.col("_first").isNotNull() & ~F.col("id").eqNullSafe(F.col("_first"))
    return hashed.join(lead, F.col("_sha1") == F.col("_same"), "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("urn:page:"), F.col("id").cast("string")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(revisit, F.concat(F.lit("urn:page:"), F.col("_first").cast("string"))).alias("refers_to"),
        F.col("html").alias("payload"),
    )


def op3_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as archives and read back."""
    register(spark)
    path = scratch_path(spark, "warc")
    pages = table(spark, folder, "pages").select(F.col("page_id").alias("id"), "url", "html")
    with_revisits(pages).write.format("warc").mode("append").save(path)

    def page(column):
        return F.substring(column, len("urn:page:") + 1, 20).cast("long")

    def archive(columns):
        return spark.read.format("warc").schema(columns).load(path)

    # Responses are decoded, and length and digest taken from the payload; revisits are told by their headers.
    responses = archive("record_type string, record_id string, payload_length long, payload_digest string").where(
        "record_type = 'response'").select(
        page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type",
        F.lit(None).cast("long").alias("refers_to"))
    revisits = archive("record_type string, record_id string, refers_to string, http_length long, digest string").where(
        "record_type = 'revisit'").select(
        page("record_id").alias("page_id"), F.col("http_length").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", page("refers_to").alias("refers_to"))
    return responses.union(revisits)
