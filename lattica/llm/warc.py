"""WARC archives: writing, normalising and reading them.

`write` makes monolithic files, one gzip stream for many records. `normalise`
inflates such a stream once, front to back, writes every record again as a gzip
member of its own, and beside the file an index of the members' places. `read`
goes by that index and needs nothing before a record. Records are streamed: none
of the three holds a file, and the normaliser not even a record, in memory.

A payload that occurs several times is stored once: of records with equal
payloads of at least `min_bytes` bytes that with the smallest page id is a
response, the others are revisits that refer to it; a revisit has the headers,
digest and length of the full payload. Null html is an empty payload; a null
page id comes after all others; of rows with one page id and payload one is the
response, and the others refer to that id. Line breaks in URLs become spaces. An
empty table gives no files.

Files have unique names; a task that is run again writes others, and only those
named in a task's result count. They are written through Arrow's file systems, so
the folder may be any that these open (local and network mounts, s3, gs, hdfs).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import BROADCAST_ROWS, HOT_KEYS, join_hot, map_arrow, new_path, open_file, staged

DATE, LEVEL, FILE_BYTES, _CHUNK = "2024-01-01T00:00:00Z", 6, 64 << 20, 1 << 20
_BREAK = b"\r\n"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    name = uri.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "null" else int(name)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC/1.1 record; a revisit's block has the headers of the response alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", " ".join((url or "").splitlines())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        *([("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")] if revisit else []),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + _BREAK + block + _BREAK + _BREAK


def headers(stream: io.BufferedIOBase) -> tuple[bytes, dict[str, str]] | None:
    """The raw header of the next record and its fields; None at the end."""
    line = stream.readline()
    while line in (b"\n", _BREAK):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record: {line[:40]!r}")
    raw, fields = [line], {}
    while (line := stream.readline()) not in (b"\n", _BREAK):
        if not line:
            raise ValueError("the file ends within a record's header")
        raw.append(line)
        k, _, v = line.decode("utf-8", "replace").partition(":")
        fields[k.strip().lower()] = v.strip()
    return b"".join(raw) + _BREAK, fields


def _inflated(path: str) -> io.BufferedReader:
    return io.BufferedReader(gzip.GzipFile(fileobj=open_file(path, "r")), _CHUNK)


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, file_bytes: int = FILE_BYTES, level: int = LEVEL, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Writes monolithic archives to folder; (path, records) of each."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), F.monotonically_increasing_id().alias("row"))
    # written once with their numbers; then only numbers and digests move, and pages stay where they are
    rows = staged(rows.withColumns({"bytes": F.octet_length("html"), "sha1": F.sha1(F.encode("html", "UTF-8"))}), "pages", compression="zstd")
    narrow = rows.select("row", "id", "bytes", F.concat_ws(":", "sha1", F.col("bytes").cast("string")).alias("payload"))
    least = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("first"), F.col("row").alias("first_row")))
    shared = staged(narrow.groupBy("payload").agg(least.alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1").select("payload", "f.first", "f.first_row", "n"), "payloads")
    again = join_hot(narrow.drop("id"), shared, "payload", "n", hot_keys).where((F.col("row") != F.col("first_row")) & (F.col("bytes") >= min_bytes))
    again = staged(again.select("row", F.col("first").alias("refers_to"), F.lit(True).alias("revisit")), "revisits")
    joined = rows.join(F.broadcast(again) if again.count() <= BROADCAST_ROWS else again, "row", "left").select("id", "url", "html", "sha1", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[str, int]] = []
        out = packer = None
        size = n = 0
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    path = f"{folder}/monolithic-{uuid.uuid4().hex}.warc.gz"
                    out, packer, size, n = open_file(path, "w"), zlib.compressobj(level, zlib.DEFLATED, 31), 0, 0
                data = record(r["id"], r["url"], r["html"].encode("utf-8", "surrogatepass"), base64.b32encode(bytes.fromhex(r["sha1"])).decode(), r["refers_to"], r["revisit"])
                out.write(packer.compress(data))
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    out.write(packer.flush())
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.write(packer.flush())
            out.close()
            done.append((path, n))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "records"])

    return staged(map_arrow(joined, run, "path string, records long"), "warc-files")


def normalise_file(path: str, target: str, level: int = LEVEL) -> int:
    """Rewrites one archive with a gzip member for each record, and target + '.idx'; the number of records."""
    source, out, index, n = _inflated(path), open_file(target, "w"), open_file(f"{target}.idx", "w"), 0
    offset = 0
    while (head := headers(source)) is not None:
        raw, fields = head
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        length = out.write(packer.compress(raw))
        left = int(fields["content-length"])
        while left:
            part = source.read(min(left, _CHUNK))
            if not part:
                raise ValueError(f"{path} ends within a record")
            left -= len(part)
            length += out.write(packer.compress(part))
        length += out.write(packer.compress(_BREAK + _BREAK) + packer.flush())
        index.write(json.dumps({"offset": offset, "length": length, "id": fields.get("warc-record-id"), "type": fields.get("warc-type")}).encode() + b"\n")
        offset, n = offset + length, n + 1
    for f in (source, out, index):
        f.close()
    return n


def _spread(files: DataFrame) -> DataFrame:
    """The paths, a task for each (up to a bound) whatever the size of their table."""
    return files.select("path").repartition(max(1, min(100_000, files.count())))


def normalise(files: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """A normalised copy and its index for each archive of files (path, records); (path, records) of the copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, counts = [], []
            for path in batch.column("path").to_pylist():
                paths.append(f"{folder}/members-{uuid.uuid4().hex}.warc.gz")
                counts.append(normalise_file(path, paths[-1], level))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], names=["path", "records"])

    return staged(_spread(files).mapInArrow(run, "path string, records long"), "warc-members")


def read_at(stream: pa.NativeFile, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """The fields and block of the record in one member."""
    stream.seek(offset)
    source = io.BytesIO(zlib.decompress(stream.read(length), 31))
    _, fields = headers(source)
    return fields, source.read(int(fields["content-length"]))


def read(files: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row for each record of normalised archives: page_id, payload_bytes, payload_digest, record_type, refers_to[, payload]."""

    def parsed(fields: dict[str, str], block: bytes) -> dict:
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        size = next(int(x.split(b":")[1]) for x in http.split(_BREAK) if x.lower().startswith(b"content-length:"))
        revisit = fields["warc-type"] == "revisit"
        if not revisit and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):  # noqa: S324 - WARC's digest
            raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
        return {"page_id": page_of(fields["warc-record-id"]), "payload_bytes": size, "payload_digest": digest, "record_type": fields["warc-type"], "refers_to": page_of(fields["warc-refers-to"]) if revisit else None} | ({"payload": None if revisit else payload} if with_payload else {})

    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * with_payload
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                with open_file(path, "seek") as stream, io.BufferedReader(open_file(f"{path}.idx", "r")) as index:
                    for line in index:
                        at = json.loads(line)
                        rows.append(parsed(*read_at(stream, at["offset"], at["length"])))
                        size += len(rows[-1].get("payload") or b"")
                        if len(rows) >= 10_000 or size >= 32 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return _spread(files).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload)


def round_trip(pages: DataFrame, min_bytes: int = 0, **options) -> DataFrame:
    """Writes, normalises and reads back all pages, in a new place of the shared folder."""
    folder = new_path(pages.sparkSession, "warc")
    return read(normalise(write(pages, f"{folder}/in", min_bytes=min_bytes, **options), f"{folder}/out"))
