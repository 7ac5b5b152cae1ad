"""WARC archives: a writer with identical-payload revisits, and a data source that reads headers before payloads.

Archives are .warc.gz with one gzip member a record. The writer puts an "sl" field (compressed and uncompressed length)
in each member's header, so that the reader can go from record to record and inflate only what it is asked for; members
without it are inflated to find their end. Plain .warc files are read as well, by seeking past unwanted blocks.
"""

import base64
import hashlib
import struct
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith,
)

from tallylake.llm import storage

# Fixed values of the WARC format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MEMBER = struct.Struct("<4sIBBH2sHII")  # magic and flags, time, extra flags, system, extra length, SL, its length, lengths
#: Bytes of archives that one task reads, at least one file; bytes read at first of a compressed record.
TASK_BYTES, HEAD_BYTES = 64 << 20, 4096


def digest(payload):
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(record):
    packer = zlib.compressobj(4, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    size = _MEMBER.size + len(body) + 8
    head = _MEMBER.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"SL", 8, size, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _plain(value):
    """A header value: line ends and other control characters become %XX."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value or "")


def _record_id(source, payload_digest):
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source}:{payload_digest}')}>"


def _record(source, url, payload, refers_to, date):
    """One record: a response, or a revisit of refers_to."""
    own = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_record_id(source, own)}", f"WARC-Date: {date}", f"WARC-Target-URI: {_plain(url)}",
            f"WARC-Payload-Digest: sha1:{own}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if source is not None:
        head.append(f"X-Source-ID: {source}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, own)}",
                 f"X-Refers-To-Source-ID: {refers_to}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def write_warc(pages, folder, page_id="page_id", url="url", html="html", least_bytes=0, date="1970-01-01T00:00:00Z"):
    """Write a record for each page to .warc.gz files in folder; returns the folder.

    The payload is the html in UTF-8, null as empty. Of pages with equal payloads of at least least_bytes, those with
    the smallest page_id are responses (repeated rows of it alike), the others revisits of it; smaller payloads are all
    responses. A null page_id is never the smallest one; where all are null, all are responses. Null urls are empty.
    Other columns are not read; an empty table writes no archive. A retried task replaces its own file as a whole.

    The first page of each payload is a stored table of digests; pages are joined to it with all that is equal split
    over tasks as adaptive execution finds it skewed.
    """
    chosen = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"),
    ).withColumn("sha", F.sha1(F.encode("html", "UTF-8")))
    firsts = chosen.where(F.octet_length("html") >= least_bytes).groupBy("sha").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    ).where("n > 1 and first is not null").select("sha", "first")
    firsts = storage.stored(firsts, "warc-firsts")
    joined = chosen.join(firsts, "sha", "left")
    joined = joined.withColumn(
        "refers_to", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    ).select("page_id", "url", "html", "refers_to")

    def run(batches):
        from pyspark import TaskContext

        written = 0

        def write(out):
            nonlocal written
            for batch in batches:
                for row in zip(*[batch.column(c) for c in ("page_id", "url", "html", "refers_to")]):
                    source, link, text, refers_to = [v.as_py() for v in row]
                    out.write(_member(_record(source, link, text.encode(), refers_to, date)))
                    written += 1

        name = f"part-{TaskContext.get().partitionId():07d}.warc.gz"
        storage.commit_file(folder, name, write)
        yield pa.RecordBatch.from_pydict({"file": [name], "records": [written]})

    joined.mapInArrow(run, "file string, records long").write.format("noop").mode("overwrite").save()
    return folder


class _Archive:
    """The records of one file, headers first: each is (header lines, block start, read(most) of the block)."""

    def __init__(self, uri):
        system, path = storage.locate(uri)
        self.file, self.packed = system.open_input_file(path), uri.endswith(".gz")
        self.size = self.file.size()

    def records(self):
        at = 0
        while at < self.size:
            record = self._packed_record(at) if self.packed else self._plain_record(at)
            if record is None:
                return
            yield at, record
            at = record.end()

    def _packed_record(self, at):
        head = self.file.read_at(min(HEAD_BYTES, self.size - at), at)
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {at}")
        start, length, flags = 10, None, head[3]
        if flags & 4:
            extra = struct.unpack_from("<H", head, 10)[0]
            start = 12 + extra
            if extra >= 12 and head[12:14] == b"SL":
                length = struct.unpack_from("<I", head, 16)[0]
        for bit in (8, 16):  # a name and a comment, each up to a zero byte
            if flags & bit:
                start = head.index(b"\0", start) + 1
        start += 2 if flags & 2 else 0
        return _Packed(self.file, at, start, length, self.size, head)

    def _plain_record(self, at):
        return _Unpacked(self.file, at, self.size)


class _Packed:
    def __init__(self, file, at, start, length, size, head):
        self.file, self.at, self.length, self.size = file, at, length, size
        self.unpacker = zlib.decompressobj(-15)
        self.read, self.place = b"", at + len(head)
        self.data = self.unpacker.decompress(head[start:])

    def fill(self, wanted):
        while len(self.data) < wanted and not self.unpacker.eof and self.place < self.size:
            chunk = self.file.read_at(min(1 << 18, self.size - self.place), self.place)
            self.place += len(chunk)
            self.data += self.unpacker.decompress(chunk)
        return self.data

    def end(self):
        if self.length:
            return self.at + self.length
        while not self.unpacker.eof:
            before = len(self.data)
            self.fill(before + 1)
            if len(self.data) == before and not self.unpacker.eof:
                raise ValueError(f"the member at byte {self.at} is cut off")
        return self.place - len(self.unpacker.unused_data) + 8


class _Unpacked:
    def __init__(self, file, at, size):
        self.file, self.at, self.size = file, at, size
        self.data = b""
        self.block_end = None

    def fill(self, wanted):
        if len(self.data) < wanted:
            more = min(max(wanted, 2 * len(self.data), HEAD_BYTES), self.size - self.at)
            self.data += self.file.read_at(more - len(self.data), self.at + len(self.data))
        return self.data

    def end(self):
        return self.at + self.block_end + 4


def _headers(record):
    """(headers, place of the block) of a record; names in lower case."""
    end = -1
    while end < 0:
        had = len(record.data)
        data = record.fill(had + 1)
        end = data.find(b"\r\n\r\n")
        if end < 0 and len(data) == had:
            raise ValueError("a record without end of headers")
    lines = data[:end].decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    found = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        found[name.strip().lower()] = value.strip()
    return found, end + 4


#: Column -> header that it shows.
COLUMNS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "source_id": "x-source-id",
    "refers_to_source_id": "x-refers-to-source-id",
}
_SCHEMA = ", ".join([*[f"{c} string" for c in COLUMNS], "payload_bytes long", "payload binary", "file string", "offset long"])


class WarcDataSource(DataSource):
    """spark.read.format("warc").option("payload", "false").load(path): one row a record.

    Columns: those of COLUMNS (null where the header is missing; digests without "sha1:"), payload_bytes (of the full
    payload, from its HTTP header, also for revisits), payload (null for records without one, or unless wanted), file
    and offset. Equality, membership and prefix conditions on header columns are decided before a payload is read.
    """

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return _SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)


class Files(InputPartition):
    def __init__(self, uris):
        super().__init__(uris)
        self.uris = uris


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.tests = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in COLUMNS and isinstance(f, (EqualTo, In, IsNotNull, StringStartsWith)):
                self.tests.append((name, type(f).__name__, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        """Files in order, as many to a task as TASK_BYTES hold."""
        tasks, size = [], 0
        for uri, n in storage.list_files(self.path, (".warc", ".warc.gz")):
            if not tasks or size + n > TASK_BYTES:
                tasks.append([])
                size = 0
            tasks[-1].append(uri)
            size += n
        return [Files(t) for t in tasks] or [Files([])]

    def _passes(self, row):
        for name, kind, value in self.tests:
            x = row[name]
            if x is None or (kind == "EqualTo" and x != value) or (kind == "In" and x not in value) or (
                kind == "StringStartsWith" and not x.startswith(value)
            ):
                return False
        return True

    def read(self, partition):
        rows, size = [], 0
        for uri in partition.uris:
            for offset, record in _Archive(uri).records():
                headers, start = _headers(record)
                length = int(headers.get("content-length", 0))
                record.block_end = start + length
                row = {c: headers.get(h) for c, h in COLUMNS.items()}
                row["payload_digest"] = (row["payload_digest"] or "").removeprefix("sha1:") or None
                if not self._passes(row):
                    continue
                n, payload = self._payload(record, headers, start, length)
                rows.append((*row.values(), n, payload, uri, offset))
                size += len(payload or b"") + 500
                if size > 4 << 20:
                    yield self._batch(rows)
                    rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _payload(self, record, headers, start, length):
        """(bytes of the full payload, payload if wanted and there)."""
        if not headers.get("content-type", "").startswith("application/http"):
            if not self.payload:
                return length, None
            return length, record.fill(start + length)[start : start + length]
        end, wanted = -1, start
        while end < 0 and wanted < start + length:
            wanted = min(start + length, wanted + 2048)
            end = record.fill(wanted).find(b"\r\n\r\n", start, start + length)
        if end < 0:
            return None, None
        n = length - (end + 4 - start)
        for line in record.data[start:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length" and value.strip().isdigit():
                n = int(value)
        if not self.payload or headers.get("warc-type") == "revisit":
            return n, None
        return n, record.fill(start + length)[end + 4 : start + length]

    @staticmethod
    def _batch(rows):
        kinds = [*[pa.string()] * len(COLUMNS), pa.int64(), pa.binary(), pa.string(), pa.int64()]
        names = [*COLUMNS, "payload_bytes", "payload", "file", "offset"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds, strict=True)], names)


def read_warc(spark, path, payload=True):
    """The records of the .warc and .warc.gz files in a folder (or of one file); see WarcDataSource.

    An empty or missing folder has no records; a broken record raises ValueError.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
