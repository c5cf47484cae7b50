"""WARC archives with a two-level capture index (operator 10).

Writing: pages with equal payloads (SHA-1, at least ``min_bytes`` bytes) are
found by a pre-aggregated maximum of ``page_id`` for each digest; the page with
the largest id becomes a response record, the others become revisit records
that refer to it.  Each task writes one archive, a gzip member per record, and
returns its captures.

Index: captures sorted by reversed-host URL key.  Level one is a list of index
files with their first and last keys (one row per file).  Level two is in each
file: compressed blocks of capture lines, and a sparse directory with the first
key and place of each block.

Reading: a wanted key goes to the index files whose key range holds it; a
binary search in the directory finds the block, and the captures found are
sorted by archive and offset for range reads.

All files are in the shared folder, and only files that a committed manifest
names are read.

Edge cases: null html is the empty payload; a null url has the empty key and no
target header; a null ``page_id`` is written and read as null and is never the
response that others refer to, unless all its copies' ids are null; rows that
repeat both id and payload are all responses; an empty table writes no file.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import folder, shuffle_partitions, stored
from candlewick.llm.shared_files import make_folder, open_input, open_output
from candlewick.llm.tokens import rows_of

BLOCK_LINES = 3000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "key string, page_id long, path string, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
TAIL = struct.Struct("<QQ8s")
MAGIC = b"CWCDX1\0\0"


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://a.example.com/x?y#z`` is ``com,example,a)/x?y``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url
    if not host:
        return url
    name = host if ":" in host else ",".join(reversed(host.split(".")))
    port_text = "" if port in (None, {"http": 80, "https": 443}.get(parts.scheme)) else f":{port}"
    return f"{name}{port_text}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


# ----------------------------------------------------------------- records


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _header(value: str) -> str:
    """A value on one line: control characters and spaces are percent-encoded."""
    return "".join(quote(c) if c <= " " or c in "\x7f\x85\u2028\u2029" else c for c in value)


def parse(member: bytes) -> dict:
    """A gzip member as its fields; checks the digest of a stored payload."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: (lambda v: int(v) if v else None)(fields.get(name, "<urn:page:>")[10:-1])
    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload": payload,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To"),
    }


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ----------------------------------------------------------------- writing


@dataclass(frozen=True)
class Archive:
    """The committed list of index files: (shard, path, first_key, last_key, captures)."""

    shards: DataFrame


def write_captures(pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the archives; the captures (``CAPTURE``), committed."""
    spark = pages.sparkSession
    to = folder(spark, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    # Only digests that occur again go into the join.
    again = rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha1").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    again = again.where((F.col("n") > 1) & F.col("keeper").isNotNull()).drop("n")
    rows = rows.join(again, "sha1", "left")
    target = F.when(F.col("page_id").eqNullSafe(F.col("keeper")), None).otherwise(F.col("keeper"))
    rows = rows.select("page_id", "url", "payload", "sha1", target.alias("refers_to"))

    def write(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task, out, at, held = TaskContext.get(), None, 0, []
        path = f"{to}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        for page_id, url, body, sha1, refers_to in rows_of(batches, "page_id", "url", "payload", "sha1", "refers_to"):
            if out is None:
                make_folder(to)
                out = open_output(path)
            digest = base64.b32encode(bytes.fromhex(sha1)).decode()
            gz = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = gz.compress(record(page_id, url, body, digest, refers_to, date)) + gz.flush()
            out.write(member)
            held.append({"key": url_key(url), "page_id": page_id, "path": path, "offset": at, "length": len(member)})
            at += len(member)
            if len(held) >= 5000:
                yield pa.RecordBatch.from_pylist(held, _arrow(CAPTURE))
                held = []
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist(held, _arrow(CAPTURE))

    return stored(rows.mapInArrow(write, CAPTURE), "warc_captures")


def _arrow(ddl: str):
    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def write_index(captures: DataFrame, block_lines: int = BLOCK_LINES) -> Archive:
    spark = captures.sparkSession
    to = folder(spark, "warc_index")
    rows = captures.repartitionByRange(shuffle_partitions(spark), "key", "page_id", "path", "offset")
    rows = rows.sortWithinPartitions("key", "page_id", "path", "offset")

    def write(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task, out, at, lines, directory, count, last = TaskContext.get(), None, 0, [], [], 0, ""
        path = f"{to}/part-{task.partitionId():06d}-{task.taskAttemptId()}.cdx"

        def flush():
            nonlocal at
            if lines:
                block = zlib.compress("\n".join("\t".join(x) for x in lines).encode())
                directory.append((lines[0][0], str(at), str(len(block))))
                at += out.write(block)
                lines.clear()

        for key, page_id, *place in rows_of(batches, "key", "page_id", "path", "offset", "length"):
            if out is None:
                make_folder(to)
                out = open_output(path)
            last = key
            lines.append((_line(key), "" if page_id is None else str(page_id), *map(str, place)))
            count += 1
            if len(lines) >= block_lines:
                flush()
        if out is not None:
            flush()
            body = zlib.compress("\n".join("\t".join(x) for x in directory).encode())
            out.write(body + _tail(at, len(body)))
            out.close()
            first = _unline(directory[0][0])
            row = {"shard": task.partitionId(), "path": path, "first_key": first, "last_key": last, "captures": count}
            yield pa.RecordBatch.from_pylist([row], _arrow(SHARD))

    return Archive(stored(rows.mapInArrow(write, SHARD), "warc_shards"))


SHARD = "shard long, path string, first_key string, last_key string, captures long"


def _tail(at: int, size: int) -> bytes:
    return TAIL.pack(at, size, MAGIC)


def _line(key: str) -> str:
    """A key without the characters that part lines and fields."""
    return key.replace("\\", "\\\\").replace("\t", "\\t").replace("\n", "\\n")


def _unline(text: str) -> str:
    out, i = [], 0
    while i < len(text):
        if text[i] == "\\":
            out.append({"\\": "\\", "t": "\t", "n": "\n"}[text[i + 1]])
            i += 1
        else:
            out.append(text[i])
        i += 1
    return "".join(out) if "\\" in text else text


def write_archive(pages: DataFrame, min_bytes: int = 0, block_lines: int = BLOCK_LINES) -> Archive:
    return write_index(write_captures(pages, min_bytes), block_lines)


# ----------------------------------------------------------------- reading


class IndexFile:
    def __init__(self, path: str):
        self.source = open_input(path)
        size = self.source.size()
        at, length, magic = TAIL.unpack(self._read(size - TAIL.size, TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"not an index file, or a cut one: {path}")
        rows = [x.split("\t") for x in zlib.decompress(self._read(at, length)).decode().split("\n")]
        # Keys are compared as UTF-8 bytes, as Spark sorts them.
        self.first = [_unline(r[0]).encode() for r in rows]
        self.places = [(int(r[1]), int(r[2])) for r in rows]
        self.held = (-1, [])

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def _block(self, k: int) -> list:
        if self.held[0] != k:
            text = zlib.decompress(self._read(*self.places[k])).decode()
            rows = [x.split("\t") for x in text.split("\n")]
            self.held = (k, [(_unline(r[0]).encode(), r) for r in rows])
        return self.held[1]

    def find(self, key: str) -> Iterator[list]:
        """The capture lines of a key: binary search in the directory, then in the block."""
        wanted = key.encode()
        k = max(0, bisect_left(self.first, wanted) - 1)
        while k < len(self.first) and self.first[k] <= wanted:
            block = self._block(k)
            at = bisect_left(block, wanted, key=lambda x: x[0])
            while at < len(block) and block[at][0] == wanted:
                yield block[at][1]
                at += 1
            k += 1

    def close(self) -> None:
        self.source.close()


def find_captures(archive: Archive, urls: DataFrame) -> DataFrame:
    """Captures of the distinct URLs in column ``url``, by way of the index."""
    spark = urls.sparkSession
    n = shuffle_partitions(spark)
    shards = [(r.path, r.first_key.encode(), r.last_key.encode()) for r in archive.shards.orderBy("shard").collect()]  # a row per index file

    def route(batches) -> Iterator:
        import pyarrow as pa

        lasts = [s[2] for s in shards]
        out = {"shard": [], "key": []}
        for (url,) in rows_of(batches, "url"):
            key = url_key(url)
            wanted = key.encode()
            k = bisect_left(lasts, wanted)
            while k < len(shards) and shards[k][1] <= wanted:
                out["shard"].append(k)
                out["key"].append(key)
                k += 1
            if len(out["key"]) >= 10_000:
                yield pa.RecordBatch.from_pydict(out, _arrow("shard long, key string"))
                out = {"shard": [], "key": []}
        yield pa.RecordBatch.from_pydict(out, _arrow("shard long, key string"))

    def search(batches) -> Iterator:
        import pyarrow as pa

        at, file, held = -1, None, []
        for shard, key in rows_of(batches, "shard", "key"):
            if shard != at:
                if file is not None:
                    file.close()
                at, file = shard, IndexFile(shards[shard][0])
            for _, page_id, path, offset, length in file.find(key):
                held.append({"key": key, "page_id": int(page_id) if page_id else None, "path": path, "offset": int(offset), "length": int(length)})
                if len(held) >= 5000:
                    yield pa.RecordBatch.from_pylist(held, _arrow(CAPTURE))
                    held = []
        if file is not None:
            file.close()
        yield pa.RecordBatch.from_pylist(held, _arrow(CAPTURE))

    routed = urls.select(F.col("url").cast("string").alias("url")).distinct().mapInArrow(route, "shard long, key string").distinct()
    routed = routed.repartitionByRange(n, "shard", "key").sortWithinPartitions("shard", "key")
    return routed.mapInArrow(search, CAPTURE)


def read_records(captures: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records (``RECORD``; with_payload adds the stored bytes) by range reads in file order."""
    n = shuffle_partitions(captures.sparkSession)
    rows = captures.select("path", "offset", "length").repartitionByRange(n, "path", "offset").sortWithinPartitions("path", "offset")

    def read(batches) -> Iterator:
        import pyarrow as pa

        schema = _arrow(RECORD)
        if with_payload:
            schema = schema.append(pa.field("payload", pa.binary()))
        at, source, held, size = "", None, [], 0
        for path, offset, length in rows_of(batches, "path", "offset", "length"):
            if path != at:
                if source is not None:
                    source.close()
                at, source = path, open_input(path)
            source.seek(offset)
            found = parse(source.read(length))
            size += len(found["payload"])
            held.append(found)
            if not with_payload:
                del found["payload"]
            if len(held) >= 2000 or (with_payload and size > 16_000_000):
                yield pa.RecordBatch.from_pylist(held, schema)
                held, size = [], 0
        if source is not None:
            source.close()
        yield pa.RecordBatch.from_pylist(held, schema)

    return rows.mapInArrow(read, RECORD + (", payload binary" if with_payload else ""))


def lookup(spark: SparkSession, archive: Archive, urls: list[str], with_payload: bool = True) -> DataFrame:
    """The records of a few URLs."""
    return read_records(find_captures(archive, spark.createDataFrame([(u,) for u in urls], "url string")), with_payload)
