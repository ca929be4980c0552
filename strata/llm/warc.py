"""WARC archives compressed record by record with Zstandard and a shared dictionary.

An archive is a leading skippable frame that holds its dictionary, then one frame per record.
Writing: every task writes the archives of its partition to the shared folder, each under a
temporary name that is renamed when complete, so a task that is run again replaces its own file.
Records with equal payloads are found by one aggregation over digests; the join that brings the
result back is an equi-join whose large side adaptive execution can split, so a payload that a
third of the pages share is not one task's work. Reading: Spark's binaryFile source deals out
the archives (rolled at ``max_bytes``), a task decodes frame by frame and checks every record.

Defined cases: a null html is an empty payload; among pages of equal payload those that carry
the smallest id (or no id, if none has one) are responses and the others revisits; a null url has no
target header; control characters and blanks in a url are percent-encoded; an empty table gives
no archive and no rows; columns other than page_id, url and html are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAX_BYTES = 32 << 20
RECORD_SCHEMA = ("archive string, page_id bigint, url string, record_type string, refers_to bigint, "
                 "payload_bytes bigint, payload_digest string, payload binary")


class BadArchive(ValueError):
    """An archive that breaks the format, with the file and the offset of the record."""


# --- one record ------------------------------------------------------------------------------

def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}>"


def page_of(record: str) -> int | None:
    number = record.split(":")[2]
    return int(number) if number else None


def build_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}".encode()]
    lines += [f"{k}: {v}".encode() for k, v in headers]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, sha1: bytes, first_id, is_first: bool, date: str) -> bytes:
    digest = base64.b32encode(sha1).decode()
    headers = [("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date)]
    if url is not None:
        safe = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        headers.append(("WARC-Target-URI", safe))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if is_first:
        return build_record("response", headers, http + payload)
    headers += [("WARC-Refers-To", record_id(first_id, digest)), ("WARC-Profile", PROFILE)]
    return build_record("revisit", headers, http)


def parse_head(head: bytes) -> tuple[bytes, dict[str, str]]:
    first, *lines = head.split(b"\r\n")
    pairs = (line.partition(b":") for line in lines if line)
    return first, {k.strip().lower().decode(): v.strip().decode() for k, _, v in pairs}


def parse_record(raw: bytes) -> dict:
    """Split and validate one record: version, required headers, both lengths, the digest."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    version, h = parse_head(head)
    if not mark or not version.startswith(b"WARC/1."):
        raise ValueError("no WARC version line or header end")
    if missing := [k for k in REQUIRED if k not in h]:
        raise ValueError(f"missing headers {missing}")
    length = int(h["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, header says {length}")
    out = {"record_type": h["warc-type"], "headers": h, "payload": rest[:length]}
    if h["warc-type"] in ("response", "revisit"):
        status, mark, payload = rest[:length].partition(b"\r\n\r\n")
        line, http = parse_head(status)
        if not mark or not line.startswith(b"HTTP/"):
            raise ValueError("no HTTP head")
        size, digest = int(http["content-length"]), h["warc-payload-digest"].partition(":")[2]
        if h["warc-type"] == "response":
            if len(payload) != size:
                raise ValueError(f"payload of {len(payload)} bytes, HTTP header says {size}")
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError("payload does not match its digest")
        out |= {"payload": payload, "payload_bytes": size, "payload_digest": digest,
                "page_id": page_of(h["warc-record-id"]), "url": h.get("warc-target-uri"),
                "refers_to": page_of(h["warc-refers-to"]) if "warc-refers-to" in h else None}
    return out


# --- one archive -----------------------------------------------------------------------------

def train(samples: list[bytes]):
    """A dictionary for these records, or None where they are too few to train one."""
    import zstandard
    size = min(32 << 10, sum(map(len, samples)) // 16)
    if len(samples) < 16 or size < 1024:
        return None
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    """Builds one archive in memory (at most about ``max_bytes``)."""

    def __init__(self, samples: list[bytes]):
        import zstandard
        dictionary = train(samples)
        self.parts, self.size, self.records = [], 0, 0
        if dictionary:
            body = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
            self._put(struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body)
        self.compress = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True).compress

    def _put(self, data: bytes):
        self.parts.append(data)
        self.size += len(data)

    def add(self, record: bytes):
        self._put(self.compress(record))
        self.records += 1


def frames(data):
    """``(magic, start, end)`` of each frame, found from the block headers alone."""
    import zstandard
    at = 0
    while at < len(data):
        start, magic = at, int.from_bytes(data[at:at + 4], "little")
        if magic == FRAME_MAGIC:
            head = bytes(data[at:at + 18])
            at += zstandard.frame_header_size(head)
            last = False
            while not last:
                if at + 3 > len(data):
                    raise ValueError("archive ends within a frame")
                block = int.from_bytes(data[at:at + 3], "little")
                last, kind, size = block & 1, block >> 1 & 3, block >> 3
                at += 3 + (1 if kind == 1 else size)
            at += 4 * zstandard.get_frame_parameters(head).has_checksum
        elif magic & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + int.from_bytes(data[at + 4:at + 8], "little")
        else:
            raise ValueError(f"no frame at offset {start}")
        if at > len(data):
            raise ValueError("archive ends within a frame")
        yield magic, start, at


def read_archive(data):
    """Records of one archive, validated. ``data``: bytes-like."""
    import zstandard
    data = memoryview(data)
    decompress = zstandard.ZstdDecompressor().decompress
    for magic, start, end in frames(data):
        if magic == DICTIONARY_MAGIC and start == 0:
            raw = bytes(data[8:end])
            if raw[:4] == struct.pack("<I", FRAME_MAGIC):
                raw = decompress(raw)
            decompress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw)).decompress
        elif magic == FRAME_MAGIC:
            try:
                yield parse_record(decompress(data[start:end]))
            except (ValueError, KeyError, IndexError, zstandard.ZstdError) as e:
                raise ValueError(f"record at offset {start}: {e}") from e


# --- Spark -----------------------------------------------------------------------------------

def _file_system(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_archives(pages: DataFrame, path: str, date: str = "2024-02-01T06:00:00Z",
                   max_bytes: int = MAX_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives below ``path`` (a shared folder that
    pyarrow can write to); returns the manifest ``archive, records, bytes`` (also a table in
    ``path/manifest``)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    groups = (rows.groupBy("sha").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("sha", "first_id", F.lit(True).alias("shared")))
    marked = rows.join(groups, "sha", "left").select(
        "page_id", "url", F.col("payload").cast("binary").alias("payload"), F.unhex("sha").alias("sha"), "first_id",
        (F.col("shared").isNull() | F.col("page_id").eqNullSafe(F.col("first_id"))).alias("is_first"))

    def write(batches):
        from pyspark import TaskContext
        task, files, system, root = TaskContext.get().partitionId(), [], None, None
        attempt = TaskContext.get().taskAttemptId()  # rows, and so the cut, may differ between attempts

        def close(archive):
            name = f"part-{task:05d}-{attempt}-{len(files):03d}.warc.zst"
            temporary = f"{root}/_{name}.{uuid.uuid4().hex}"
            with system.open_output_stream(temporary) as out:
                for part in archive.parts:
                    out.write(part)
            system.move(temporary, f"{root}/{name}")
            files.append({"archive": name, "records": archive.records, "bytes": archive.size})

        def flush(waiting, archive):
            for record in waiting:
                if archive is None or archive.size >= max_bytes:
                    if archive is not None:
                        close(archive)
                    archive = ArchiveWriter([r[:16384] for r in waiting])
                    archive.add(build_record("warcinfo", [
                        ("WARC-Record-ID", f"<urn:x-archive:{task}:{len(files)}>"), ("WARC-Date", date),
                        ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                archive.add(record)
            return archive

        archive, waiting, held = None, [], 0
        for batch in batches:
            if system is None:
                system, root = _file_system(f"{path}/archives")
            cols = [batch.column(c).to_pylist() for c in ("page_id", "url", "sha", "first_id", "is_first")]
            payloads = batch.column("payload")
            for i, (page_id, url, sha, first_id, is_first) in enumerate(zip(*cols)):
                waiting.append(page_record(page_id, url, payloads[i].as_py(), sha, first_id, is_first, date))
                held += len(waiting[-1])
                if len(waiting) >= 512 or held >= 4 << 20:
                    archive, waiting, held = flush(waiting, archive), [], 0
        archive = flush(waiting, archive)
        if archive is not None:
            close(archive)
        yield pa.RecordBatch.from_pylist(files, pa.schema([
            ("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    system, root = _file_system(f"{path}/archives")
    system.create_dir(root)  # also where there is nothing to write
    manifest = marked.mapInArrow(write, "archive string, records bigint, bytes bigint")
    manifest.write.parquet(f"{path}/manifest")
    return pages.sparkSession.read.schema(manifest.schema).parquet(f"{path}/manifest")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All page records of the archives that ``path/manifest`` names: :data:`RECORD_SCHEMA`. Files
    that lost attempts left beside them are not read; a missing archive fails the read, and a
    broken one with its name and the offset."""
    def read(batches):
        fields = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        schema = pa.schema([("archive", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("payload", pa.binary())])
        for batch in batches:
            for i, name in enumerate(batch.column("path").to_pylist()):
                rows, held = [], 0
                try:
                    for r in read_archive(batch.column("content")[i].as_buffer()):
                        if r["record_type"] not in ("response", "revisit"):
                            continue
                        rows.append({"archive": name} | {f: r[f] for f in fields})
                        held += len(r["payload"])
                        if held >= 8 << 20 or len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                except ValueError as e:
                    raise BadArchive(f"{name}: {e}") from e
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    names = [r.archive for r in spark.read.schema("archive string").parquet(f"{path}/manifest").collect()]
    if not names:
        return spark.createDataFrame([], RECORD_SCHEMA)
    files = (spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
             .load([f"{path}/archives/{n}" for n in sorted(names)]).select("path", "content"))
    return files.mapInArrow(read, RECORD_SCHEMA)
