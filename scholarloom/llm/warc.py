"""WARC archives of pages, and a normaliser for archives that are one gzip stream.

write_stream_archives writes pages as the crawler would: whole-file gzip streams of response
records. normalise inflates such a stream once, front to back, and rewrites every record as a gzip
member of its own, with a sidecar index of offsets (one JSON line a record); a record whose payload
another record holds becomes a revisit without payload. read_archives fetches records by the index.

Which record stays is decided on (archive, record number, page_id, digest) rows alone; payloads are
never shuffled. All files lie in the shared folder, under names that a repeated task cannot collide
with; the rows of a finished task say which files count. A task holds one record in memory at a time.

Defined cases: a null payload is empty; equal payloads of at least `min_bytes` bytes have one
response, the smallest page_id (a null one is largest; of equal ids the first written); a null
page_id or url is left out of the record; control characters of a url are percent-encoded, and so is
everything but plain characters of a page_id, which is decoded when it is read; repeated rows are
records of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, drop_path, fresh_path, written

CHUNK = 1 << 20
#: Compressed bytes that are inflated at a time: a thousandfold expansion still fits.
SLICE = 1 << 14
#: Archives are dealt out over at most so many tasks, of several archives then.
MOST_TASKS = 100_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def open_store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def coded(page_id: object) -> str:
    """A page_id as it stands in a header; unquote is the way back."""
    return quote(str(page_id), safe="", errors="surrogatepass")


def decoded(value: str | None) -> str | None:
    return None if value is None else unquote(value, errors="surrogatepass")


def record(kind: str, page_id: object, url: str | None, digest: str, payload: bytes | None, size: int, refers_to: object = None) -> bytes:
    """One WARC/1.1 record. A revisit has the HTTP head alone, which keeps the full payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {coded(page_id)}")
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to} {digest}')}>"]
        if refers_to is not None:
            head.append(f"WARC-Refers-To-Page-ID: {coded(refers_to)}")
    body = http + (payload or b"")
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and the full payload's length of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    body = rest[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
    return fields, payload, int(size[1]) if size else len(payload)


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of a gzip file read once: one stream or many members."""
    inflate, buffer, at, need = zlib.decompressobj(31), bytearray(), 0, -1
    for chunk in (c[lo : lo + SLICE] for c in chunks for lo in range(0, len(c), SLICE)):
        while chunk:
            buffer += inflate.decompress(chunk)
            chunk = b""
            if inflate.eof:
                chunk, inflate = inflate.unused_data, zlib.decompressobj(31)
            while True:
                if need < 0:
                    end = buffer.find(b"\r\n\r\n", at)
                    if end < 0:
                        break
                    length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", bytes(buffer[at : end + 2]))
                    need = end + 4 + int(length[1]) + 4 - at
                if len(buffer) - at < need:
                    break
                yield bytes(buffer[at : at + need])
                at, need = at + need, -1
            del buffer[:at]
            at = 0
    if buffer.strip():
        raise ValueError("the archive ends inside a record")


def chunked(stream) -> Iterator[bytes]:
    while data := stream.read(CHUNK):
        yield data


def _writer(folder: str, roll_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        out = squeeze = None
        name, n, held = "", 0, 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    payload = (html or "").encode("utf-8", "surrogatepass")
                    if out is None or held >= roll_bytes:
                        if out is not None:
                            out.write(squeeze.flush())
                            out.close()
                        name, n, held = f"stream-{uuid.uuid4().hex}.warc.gz", 0, 0
                        out, squeeze = store.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(level, wbits=31)
                    digest = hashlib.sha1(payload).digest()
                    out.write(squeeze.compress(record("response", page_id, url, base64.b32encode(digest).decode(), payload, len(payload))))
                    rows.append((name, n, page_id, digest, len(payload)))
                    n, held = n + 1, held + len(payload) + 400
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], batch.schema.field(0).type), pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.int64())], ["archive", "rec", "page_id", "digest", "bytes"])
        finally:
            if out is not None:
                out.write(squeeze.flush())
                out.close()

    return run


def write_stream_archives(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", roll_bytes: int = 64 << 20, level: int = 4) -> DataFrame:
    """Writes the archives; returns (archive, rec, page_id, digest, bytes), one row per record."""
    bound_batches(pages.sparkSession)
    kind = dict(pages.dtypes)[id_col]
    store, base = open_store(folder)
    store.create_dir(base, recursive=True)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("string").alias("html"))
    return written(rows.mapInArrow(_writer(folder, roll_bytes, level), f"archive string, rec long, page_id {kind}, digest binary, bytes long"), "warc-rows")


def revisits(index: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(archive, rec, refers_to) of records whose payload an earlier page holds."""
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "archive", "rec")
    own = index.where(F.col("bytes") >= min_bytes)
    # Written, so that both sides of the join are plain exchanges: the engine can split a digest that many share.
    firsts = written(own.groupBy("digest").agg(F.min(place).alias("best"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-firsts")
    joined = own.select("archive", "rec", "digest").join(firsts, "digest")
    return joined.where((F.col("archive") != F.col("best.archive")) | (F.col("rec") != F.col("best.rec"))).select("archive", "rec", F.col("best.page_id").alias("refers_to"))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _normaliser(folder: str, to: str, level: int):
    def rewrite(store, base: str, target: str, name: str, marks: Callable[[], tuple | None]) -> tuple[str, int]:
        made, place, mark = f"records-{uuid.uuid4().hex}", 0, marks()
        count = 0
        with store.open_input_stream(f"{base}/{name}", compression=None) as source, store.open_output_stream(f"{target}/{made}.warc.gz", compression=None) as out, store.open_output_stream(f"{target}/{made}.index.jsonl") as sidecar:
            for n, raw in enumerate(records(chunked(source))):
                fields, _, size = parse(raw)
                kind = fields["warc-type"]
                if mark is not None and mark[0] == n:
                    raw = record("revisit", decoded(fields.get("warc-page-id")), fields.get("warc-target-uri"), fields["warc-payload-digest"].removeprefix("sha1:"), None, size, mark[1])
                    kind, mark = "revisit", marks()
                squeeze = zlib.compressobj(level, wbits=31)
                member = squeeze.compress(raw) + squeeze.flush()
                out.write(member)
                sidecar.write((json.dumps({"offset": place, "length": len(member), "id": fields["warc-record-id"], "type": kind}) + "\n").encode())
                place += len(member)
                count += 1
        return made, count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        target = open_store(to)[1]
        rows = _each(batches)
        row = next(rows, None)
        while row is not None:
            name = row[0]  # a row with rec -1 stands first for each archive

            def marks(name: str = name) -> tuple | None:
                nonlocal row
                row = next(rows, None)
                return row[1:] if row is not None and row[0] == name else None

            made, count = rewrite(store, base, target, name, marks)
            while row is not None and row[0] == name:
                row = next(rows, None)
            yield pa.RecordBatch.from_arrays([pa.array([made]), pa.array([count], pa.int64())], ["archive", "records"])

    return run


def normalise(index: DataFrame, marked: DataFrame, folder: str, to: str, *, level: int = 4) -> DataFrame:
    """Rewrites every archive of index from folder into to; returns (archive, records) with the new names."""
    store, base = open_store(to)
    store.create_dir(base, recursive=True)
    names = index.select("archive").distinct()
    n = max(1, min(names.count(), MOST_TASKS))
    kind = dict(marked.dtypes)["refers_to"]
    todo = names.select("archive", F.lit(-1).cast("long").alias("rec"), F.lit(None).cast(kind).alias("refers_to")).unionByName(marked)
    dealt = todo.repartition(n, "archive").sortWithinPartitions("archive", "rec")
    return written(dealt.mapInArrow(_normaliser(folder, to, level), "archive string, records long"), "warc-archives")


def _reader(folder: str, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        cast = (lambda x: None if x is None else int(x)) if pa.types.is_integer(id_type) else decoded
        for name, _ in _each(batches):
            rows = []
            with store.open_input_file(f"{base}/{name}.warc.gz") as archive, store.open_input_stream(f"{base}/{name}.index.jsonl") as sidecar:
                left = b""
                for chunk in chunked(sidecar):
                    *lines, left = (left + chunk).split(b"\n")
                    for line in lines:
                        at = json.loads(line)
                        archive.seek(at["offset"])
                        fields, payload, size = parse(zlib.decompress(archive.read(at["length"]), 31))
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        if fields["warc-type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
                            raise ValueError(f"{name}: the record at {at['offset']} is damaged")
                        rows.append((cast(fields.get("warc-page-id")), size, digest, fields["warc-type"], cast(fields.get("warc-refers-to-page-id")), name, at["offset"], at["length"]))
                    if len(rows) >= 5000:
                        yield table_of(rows, id_type)
                        rows = []
            if rows:
                yield table_of(rows, id_type)

    return run


def table_of(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    kinds = [id_type, pa.int64(), pa.string(), pa.string(), id_type, pa.string(), pa.int64(), pa.int64()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset", "length"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def read_archives(archives: DataFrame, folder: str, id_kind: str = "bigint") -> DataFrame:
    """One row per record of normalised archives, fetched member by member through the sidecar index."""
    types = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}
    kind = id_kind if id_kind in types else "string"
    n = max(1, min(archives.count(), MOST_TASKS))
    return archives.repartition(n, "archive").mapInArrow(
        _reader(folder, types.get(kind, pa.string())),
        f"page_id {kind}, payload_bytes long, payload_digest string, record_type string, refers_to {kind}, archive string, offset long, length long",
    )


def archive_pages(pages: DataFrame, *, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, roll_bytes: int = 64 << 20) -> DataFrame:
    """Pages to normalised archives in folder and back: one row per record."""
    spark: SparkSession = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    streams, members = f"{folder}/streams", f"{folder}/records"
    index = write_stream_archives(pages, streams, id_col=id_col, url_col=url_col, payload_col=payload_col, roll_bytes=roll_bytes)
    archives = normalise(index, revisits(index, min_bytes), streams, members)
    drop_path(spark, streams)  # every record is in members now
    return read_archives(archives, members, dict(pages.dtypes)[id_col])
