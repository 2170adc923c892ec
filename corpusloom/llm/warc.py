"""WARC archives as a PySpark Python data source.

Writing: a task writes files of its own, with one gzip member for each record and the member's length in the gzip header's "sl" field; only the
commit lists them in a manifest, so that what a lost or repeated task left behind is never read. Reading: whole files are packed into
partitions of about SPLIT bytes; equality and set predicates on the record type and the other header columns are taken over from
Spark; of each record only the first bytes are decompressed to parse its headers, and the payload of a record that the
predicates exclude, or of any record with the option payload=false, is skipped without decoding. Archives of others (without a manifest,
without "sl", or not compressed) are read too.

Files are opened through pyarrow.fs, by their uri. Null payloads are empty; null ids have an empty record id and are read back as null.
"""

from __future__ import annotations

import base64
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from corpusloom.llm.common import cut, shared_dir

SPLIT, CHUNK, MIN_REVISIT = 64 << 20, 1024, 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Columns with the header each is read from.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
READ_SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload_bytes long, payload binary"
#: What the writer takes.
WRITE_SCHEMA = "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def member(record: bytes, level: int = 6) -> bytes:
    """The record as a gzip member with its compressed and plain lengths in the field sl (0, 0: too long for it)."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    n, plain = 10 + 2 + 12 + len(body) + 8, len(record)
    n, plain_n = (n, plain) if max(n, plain) < 1 << 32 else (0, 0)
    extra = b"sl" + (8).to_bytes(2, "little") + n.to_bytes(4, "little") + plain_n.to_bytes(4, "little")
    tail = zlib.crc32(record).to_bytes(4, "little") + (plain & 0xFFFFFFFF).to_bytes(4, "little")
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + len(extra).to_bytes(2, "little") + extra + body + tail


def render(row: dict) -> bytes:
    """A record of WARC/1.1: response, or revisit with the HTTP headers only."""
    clean = lambda x: str(x).replace("\r", "%0D").replace("\n", "%0A")
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = http + (row["payload"] or b"") if row["record_type"] == "response" else http
    lines = [f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{clean(row['record_id'])}>", f"WARC-Date: {clean(row['date'])}", f"WARC-Payload-Digest: sha1:{digest}"]
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {clean(row['target_uri'])}")
    if row["record_type"] == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{clean(row['refers_to'])}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


@dataclass
class Files(WriterCommitMessage):
    names: list = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.uri, self.roll = options["path"].rstrip("/"), int(options.get("split", SPLIT))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        fs, root = pafs.FileSystem.from_uri(self.uri)
        fs.create_dir(root, recursive=True)
        done, out = Files(), None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    done.names.append([f"part-{uuid.uuid4().hex}.warc.gz", 0])
                    out = fs.open_output_stream(f"{root}/{done.names[-1][0]}", compression=None)
                out.write(data := member(render(row)))
                done.names[-1][1] += len(data)
                if done.names[-1][1] >= self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return done

    def commit(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.uri)
        fs.create_dir(root, recursive=True)
        names = [n for m in messages if m is not None for n in m.names]
        with fs.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.uri)
        for name, _ in [n for m in messages if m is not None for n in m.names]:
            fs.delete_file(f"{root}/{name}")


def parse_headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


class _Source:
    """Bytes of one record: plain, or a gzip member that is decompressed as far as it is asked for."""

    def __init__(self, f: io.BufferedReader, gz: bool):
        self.f, self.at, self.length, self.unpack, self.buffer = f, f.tell(), 0, None, bytearray()
        if gz:
            head = f.read(24)
            if head[3:4] == b"\x04" and head[12:14] == b"sl":
                self.length = int.from_bytes(head[16:20], "little")
            f.seek(self.at)
            self.unpack = zlib.decompressobj(31)

    def more(self, n: int = CHUNK) -> bool:
        data = self.f.read(n)
        if self.unpack is None:
            self.buffer += data
            return bool(data)
        if not data or self.unpack.eof:
            return False
        self.buffer += self.unpack.decompress(data)
        return True

    def until(self, mark: bytes, start: int = 0) -> int:
        """Position behind the mark, or -1."""
        while (i := self.buffer.find(mark, start)) < 0:
            start = max(start, len(self.buffer) - len(mark) + 1)
            if not self.more():
                return -1
        return i + len(mark)

    def take(self, start: int, end: int) -> bytes:
        while len(self.buffer) < end and self.more(max(CHUNK, 1 << 16)):
            pass
        return bytes(self.buffer[start:end])

    def leave(self, end: int) -> None:
        """Moves on to the next record; end is where this one ends, decompressed."""
        if self.unpack is None:
            self.f.seek(self.at + end)
        elif self.length:
            self.f.seek(self.at + self.length)
        else:
            while not self.unpack.eof:
                data = self.f.read(1 << 16)
                if not data:
                    return
                self.unpack.decompress(data)
            self.f.seek(self.f.tell() - len(self.unpack.unused_data))


def records(f: io.BufferedReader, gz: bool, wanted: dict[str, set], payload: bool) -> Iterator[dict]:
    """The records whose headers are as wanted; their payload only if asked for."""
    while f.peek(1):
        src = _Source(f, gz)
        body = src.until(b"\r\n\r\n")
        if body < 0:
            return
        heads = parse_headers(src.buffer[: body - 4].lstrip(b"\r\n"))
        end = body + int(heads.get("content-length", 0))
        row = {c: heads.get(h) for c, h in HEADERS.items()}
        for c in ("record_id", "refers_to"):
            row[c] = row[c] and row[c].strip("<>")
        if (d := row["payload_digest"]) and d.startswith("sha1:"):
            row["payload_digest"] = base64.b32decode(d[5:]).hex() if len(d) == 37 else d[5:].lower()
        if all(row.get(c) in values for c, values in wanted.items()):
            start, row["payload_bytes"], row["payload"] = body, end - body, None
            if heads.get("content-type", "").startswith("application/http"):
                start = min(src.until(b"\r\n\r\n", body), end)
                length = parse_headers(src.buffer[body : start - 4]).get("content-length", "")
                row["payload_bytes"] = end - start if row["record_type"] != "revisit" else int(length) if length.isdigit() else None
            if payload and row["record_type"] != "revisit":
                row["payload"] = src.take(start, end)
            yield row
        src.leave(end + 4)


@dataclass
class FileGroup(InputPartition):
    files: list

    def __init__(self, files: list):
        super().__init__(files)
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri, self.split, self.payload = options["path"].rstrip("/"), int(options.get("split", SPLIT)), options.get("payload", "true") == "true"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]):
        for x in filters:
            if isinstance(x, (EqualTo, In)) and len(x.attribute) == 1 and x.attribute[0] in HEADERS:
                values = set(x.value) if isinstance(x, In) else {x.value}
                self.wanted[x.attribute[0]] = self.wanted.get(x.attribute[0], values) & values
            else:
                yield x

    def partitions(self) -> list[FileGroup]:
        fs, root = pafs.FileSystem.from_uri(self.uri)
        found = [x for x in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=True)) if x.is_file]
        manifests = [x for x in found if x.base_name.startswith("_manifest-")]
        if manifests:
            listed = [n for m in manifests for n in json.loads(fs.open_input_stream(m.path, compression=None).read())]
            files = [(f"{root}/{name}", size) for name, size in listed]
        else:
            files = [(x.path, x.size) for x in found if x.base_name.endswith((".warc", ".warc.gz"))]
        groups: list[list[str]] = []
        room = 0
        for path, size in sorted(files):
            if not groups or size > room:
                groups.append([])
                room = self.split
            groups[-1].append(path)
            room -= size
        return [FileGroup(g) for g in groups] or [FileGroup([])]

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.uri)
        schema = pa.schema([(c, pa.string()) for c in HEADERS] + [("payload_bytes", pa.int64()), ("payload", pa.binary())])
        rows, held = [], 0
        for path in partition.files:
            with fs.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 20) as f:
                for row in records(f, f.peek(2)[:2] == b"\x1f\x8b", self.wanted, self.payload):
                    rows.append(row)
                    held += len(row["payload"] or b"") + 500
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcDataSource(DataSource):
    """spark.read.format("warc").load(uri); options: payload (true), split (bytes of a partition or of a written file)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, uri: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(uri)


def page_records(pages: DataFrame, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """A record for each row of pages (page_id, url, html). Of equal payloads of MIN_REVISIT bytes or more the one with the largest page_id is
    the response (each row that has it, should rows repeat), the others revisit it. Only ids and digests are compared; the payloads join once, by page_id."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    narrow = cut(rows.select("page_id", "payload_digest", "payload_bytes").filter(F.col("payload_bytes") >= MIN_REVISIT))
    first = narrow.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    again = narrow.join(first, ["payload_digest", "payload_bytes"]).filter("page_id < _first").select("page_id", "payload_digest", "_first").distinct()
    again = cut(again)
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    revisit = F.col("_first").isNotNull()
    return rows.join(again, ["page_id", "payload_digest"], "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), urn("page_id").alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.when(revisit, urn("_first")).alias("refers_to"), "payload_digest", "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"))


def write_pages(pages: DataFrame, uri: str) -> None:
    register(pages.sparkSession)
    page_records(pages).write.format("warc").mode("append").save(uri)


def read_pages(spark: SparkSession, uri: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to. Of responses both are computed from the payload that is read, of revisits read from the headers alone."""
    page = lambda c: F.nullif(F.regexp_extract(c, r"^urn:page:(-?\d*)$", 1), F.lit("")).cast("long")
    full = read(spark, uri).filter(F.col("record_type") == "response").select(page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"))
    heads = read(spark, uri, payload=False).filter(F.col("record_type") == "revisit").select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
    return full.unionAll(heads)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the archives to a new folder of the shared one, then reads them."""
    spark = pages.sparkSession
    uri = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_pages(pages, uri)
    return read_pages(spark, uri)
