"""WARC archives in Zstandard: writer, reader and deduplicated records.

An archive (``.warc.zst``) begins with a skippable frame that holds the
dictionary (which may itself be compressed), then has one frame per record.
The reader decodes frame by frame and checks magic numbers, header lines,
Content-Length and digests.
"""
from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import materialize, shared_path

#: Fixed values of the format: magic of the dictionary frame and of a Zstandard frame.
DICT_FRAME, ZSTD_FRAME = 0x184D2A5D, 0xFD2FB528
#: Payload bytes of an archive, samples and size of its dictionary, payloads that revisit records replace.
ARCHIVE_BYTES, SAMPLE_BYTES, DICT_BYTES, REVISIT_MIN = 16 << 20, 1 << 20, 32 << 10, 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


class BadRecord(ValueError):
    """An archive or record that breaks the format."""


def _sha1(data: bytes) -> str:
    return hashlib.sha1(data, usedforsecurity=False).hexdigest()


def _clean(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "%%%02X" % ord(c) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, kind: str,
           refers_to: int | None) -> bytes:
    """One WARC record. Response: HTTP head and payload. Revisit: the head only;
    length and digest of the full payload stay in it and in the WARC head."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{_sha1(block)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archive(records: list[bytes]) -> bytes:
    """Bytes of an archive whose dictionary is made from its first records."""
    samples, size = [], 0
    for r in records:
        if size > SAMPLE_BYTES:
            break
        samples.append(r)
        size += len(r)
    try:
        raw = zstandard.train_dictionary(min(DICT_BYTES, max(256, size // 8)), samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:                       # too few or too equal samples: plain content
        raw = b"".join(samples)[:DICT_BYTES]
    packed = zstandard.ZstdCompressor().compress(raw)
    out = [struct.pack("<II", DICT_FRAME, len(packed)), packed]
    made = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=True)
    out += [made.compress(r) for r in records]
    return b"".join(out)


def frames(data: bytes) -> Iterator[bytes]:
    """Records of an archive, one frame each."""
    if len(data) < 8:
        raise BadRecord("no dictionary frame")
    magic, size = struct.unpack_from("<II", data)
    if magic != DICT_FRAME or 8 + size > len(data):
        raise BadRecord("no dictionary frame")
    raw = data[8:8 + size]
    if raw[:4] == struct.pack("<I", ZSTD_FRAME):
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    view, at = memoryview(data), 8 + size
    while at < len(data):
        if len(data) - at < 4 or struct.unpack_from("<I", data, at)[0] != ZSTD_FRAME:
            raise BadRecord(f"no frame at byte {at}")
        frame = reader.decompressobj()
        out, step = [], at
        while not frame.eof:
            part = view[step:step + (1 << 20)]
            if not part:
                raise BadRecord(f"frame at byte {at} is cut off")
            out.append(frame.decompress(part))
            step += len(part)
        at = step - len(frame.unused_data)
        yield b"".join(out)


def parse(raw: bytes) -> dict:
    """Head lines (lower-case names) and block of a record, checked."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise BadRecord("no WARC head")
    named = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise BadRecord(f"bad head line {line[:60]!r}")
        named[name.strip().lower().decode()] = value.strip().decode()
    for need in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if need not in named:
            raise BadRecord(f"{need} is missing")
    if not named["content-length"].isdigit():
        raise BadRecord("Content-Length is no number")
    size = int(named["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BadRecord(f"the block has not the {size} bytes of Content-Length")
    block = rest[:size]
    if "warc-block-digest" in named and named["warc-block-digest"] != "sha1:" + _sha1(block):
        raise BadRecord("the block has another digest")
    http, sep, payload = block.partition(b"\r\n\r\n")
    length = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not sep or len(length) != 1 or not length[0].isdigit():
        raise BadRecord("no HTTP head")
    if named["warc-type"] == "response":
        if len(payload) != int(length[0]):
            raise BadRecord("the payload has not the bytes of its Content-Length")
        if "sha1:" + _sha1(payload) != named.get("warc-payload-digest"):
            raise BadRecord("the payload has another digest")
    elif named["warc-type"] == "revisit" and (payload or "warc-refers-to-page" not in named):
        raise BadRecord("a revisit must refer to a page and have no payload")
    return {"head": named, "payload": payload, "payload_bytes": int(length[0])}


def _write(folder: str):
    def run(batches):
        from pyarrow import fs
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)

        def put(records: list[bytes]) -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"       # a retried task writes other names; only reported files count
            data = write_archive(records)
            with system.open_output_stream(f"{base}/{name}", compression=None) as f:
                f.write(data)
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(records)], pa.int64()),
                                               pa.array([len(data)], pa.int64())], names=["file", "records", "bytes"])

        waiting, size = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                kind = "response" if r["refers_to"] is None else "revisit"
                payload = (r["html"] or "").encode() if kind == "response" else None
                waiting.append(record(r["page_id"], r["url"], payload, r["size"], r["digest"], kind, r["refers_to"]))
                size += len(waiting[-1])
                if size >= ARCHIVE_BYTES:
                    yield put(waiting)
                    waiting, size = [], 0
        if waiting:
            yield put(waiting)
    return run


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", revisit_min: int = REVISIT_MIN) -> DataFrame:
    """Writes a record per row into archives of ``folder`` (shared by all
    executors) and returns the archives written: file, records, bytes.

    Of records with equal payloads of ``revisit_min`` bytes or more the largest
    id is a response, the others revisit it. Null html is an empty payload; a
    null id is below all others and a group of null ids only has responses; of
    rows that repeat the largest id all are responses."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).alias("html"), F.octet_length(html).cast("long").alias("size"),
                        F.sha1(html).alias("digest"))
    keep = (rows.where(F.col("size") >= revisit_min).groupBy("digest", "size")
            .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
            .select(F.col("digest").alias("d"), F.col("size").alias("s"), "top"))
    other = (F.col("page_id").isNull() | (F.col("page_id") < F.col("top"))) & F.col("top").isNotNull()
    marked = rows.join(keep, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left").select(
        "page_id", "url", F.when(~F.coalesce(other, F.lit(False)), F.col("html")).alias("html"), "size", "digest",
        F.when(other, F.col("top")).alias("refers_to"))
    return materialize(marked.mapInArrow(_write(folder), "file string, records long, bytes long"), "warc-files")


def _read(batches):
    for batch in batches:
        for data in batch.column("content"):
            rows = []
            for raw in frames(data.as_py()):
                got = parse(raw)
                head = got["head"]
                rows.append((int(head["warc-page-id"]) if "warc-page-id" in head else None, got["payload_bytes"],
                             head["warc-payload-digest"].removeprefix("sha1:"), head["warc-type"],
                             int(head["warc-refers-to-page"]) if head["warc-type"] == "revisit" else None,
                             head.get("warc-target-uri")))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=[x.split()[0] for x in READ.split(", ")])


def read_warc(files: DataFrame, folder: str) -> DataFrame:
    """Records of the archives that ``files`` (column ``file``) names in
    ``folder``, read as binary files, one archive at a time."""
    spark = files.sparkSession
    found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").schema(
        "path string, modificationTime timestamp, length long, content binary").load(folder))
    named = found.withColumn("file", F.element_at(F.split("path", "/"), -1)).select("file", "content")
    return named.join(files.select("file"), "file", "left_semi").select("content").mapInArrow(_read, READ)


def warc_pages(pages: DataFrame) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads them back:
    page_id, payload_bytes, payload_digest, record_type, refers_to, url. An
    empty table gives an empty table; other columns are not read."""
    folder = shared_path(pages.sparkSession, "warc")
    files = write_warc(pages, folder)
    if not files.take(1):
        return pages.sparkSession.createDataFrame([], READ)
    return read_warc(files, folder)
