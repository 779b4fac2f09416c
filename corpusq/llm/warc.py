"""WARC archives: a writer with one gzip member per record, and a splittable reader.

Reading: archives are cut into byte ranges. A task looks for gzip magic in its
range; a candidate counts only if it inflates to a WARC header. A record belongs
to the range its member starts in, wherever it ends, so every record is read
once, and no index or other task is needed.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusq.operators.joins import sized_join
from corpusq.sources.storage import fresh_path, materialize

MAGIC = b"\x1f\x8b\x08"
MIN_REVISIT_BYTES = 1000
SPLIT_BYTES = 32 * 2**20
_READ = 2**18
_VERSION = b"WARC/1."

RECORD = (
    "archive string, member_start bigint, record_type string, record_id string, target_uri string, "
    "refers_to_id string, payload_digest string, payload_bytes bigint, payload binary"
)


def _file_system(uri: str):
    """The Arrow file system and path of a URI; plain paths are local or mounted ones."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_archives(pages: DataFrame, folder: str, id_: str = "page_id", uri: str = "url", html: str = "html", min_revisit: int = MIN_REVISIT_BYTES) -> DataFrame:
    """One record per row; returns the manifest (archive, bytes, records, starts: where each member begins) of the files that count.

    Of equal payloads of at least ``min_revisit`` bytes the row with the largest id
    is the response and the others revisit it. Rows of the same id and payload are
    all responses if that id is the largest. A null html is an empty payload; a
    null id is written as a response with an id of its own. Only the digests of
    payloads that occur more than once are joined to the pages: by broadcast while they are few, so that
    pages do not move, else by a shuffle that spreads payloads of millions of copies. A task writes a file under a name of its own and
    the manifest names the files of tasks that ended, so a repeated or a lost
    task leaves no records behind.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_).cast("long").alias("id"), F.col(uri).cast("string").alias("uri"), payload.alias("payload"), F.sha1(payload).alias("digest"),
    )
    can_repeat = (F.octet_length("payload") >= min_revisit) & F.col("id").isNotNull()
    many = rows.where(can_repeat).groupBy("digest").agg(F.max("id").alias("newest"), F.count("*").alias("n")).where("n > 1")
    many = materialize(many.select(F.col("digest").alias("key"), "newest", "n"), "repeated_payloads")
    # Rows that cannot be revisits are dealt out on keys of their own, which no payload has.
    key = F.when(can_repeat, F.col("digest")).otherwise(F.concat(F.lit("-"), F.pmod(F.xxhash64("id", "digest"), F.lit(2**20))))
    marked = sized_join(rows.withColumn("key", key), many, ["key"], "left", spread="id", rows="n").withColumn(
        "refers_to", F.when(F.col("id") < F.col("newest"), F.col("newest"))
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size, starts, out = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    system, path = _file_system(name)
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(path, compression=None)
                member = _member(row)
                out.write(member)
                starts.append(size)
                size += len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"archive": name, "bytes": size, "records": len(starts), "starts": starts}])

    columns = marked.select("id", "uri", "payload", "digest", "refers_to")
    return materialize(columns.mapInArrow(write, "archive string, bytes bigint, records bigint, starts array<bigint>"), "warc_manifest")


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _member(row: dict) -> bytes:
    kind = "response" if row["refers_to"] is None else "revisit"
    body = row["payload"] if kind == "response" else b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(row["payload"])
    block = http + body
    header = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(row['id'])}"]
    if row["uri"] is not None:
        header.append("WARC-Target-URI: " + " ".join(row["uri"].split()))
    header.append(f"WARC-Payload-Digest: sha1:{row['digest']}")
    if kind == "revisit":
        header.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        header.append(f"WARC-Refers-To: {_record_id(row['refers_to'])}")
    header.append(f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}")
    raw = "\r\n".join(header).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    gzip = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gzip.compress(raw) + gzip.flush()


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of all archives (archive, bytes), by byte ranges of ``split_bytes``.

    An archive without a record gives no rows. Bytes that are no WARC member are
    passed over. A member that starts as a record but is cut off, has no end of
    its header or does not keep its stated length is an error; headers may have any
    length. If the manifest has the starts of all members, a range with more or
    fewer records is an error. The payload of a revisit is null, its digest and
    length are those of the payload it stands for.
    """
    known = F.col("starts") if "starts" in manifest.columns else F.lit(None).cast("array<bigint>")
    cut = manifest.where("bytes > 0").select(
        "archive", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split_bytes))).alias("start"), "bytes", known.alias("starts")
    )
    inside = F.filter("starts", lambda x: (x >= F.col("start")) & (x < F.col("start") + split_bytes))
    ranges = cut.select("archive", "start", "bytes", F.when(F.col("starts").isNotNull(), F.size(inside)).alias("records"))
    cores = manifest.sparkSession.sparkContext.defaultParallelism
    ranges = ranges.repartition(max(cores, int(manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _file_system(row["archive"])
                with system.open_input_file(path) as file:
                    found, size, count = [], 0, 0
                    for record in _records(file, row["start"], min(row["start"] + split_bytes, row["bytes"]), row["bytes"]):
                        found.append({"archive": row["archive"]} | record)
                        size, count = size + record["payload_bytes"], count + 1
                        if size > 8 * 2**20:
                            yield pa.RecordBatch.from_pylist(found, schema=_ARROW)
                            found, size = [], 0
                    if found:
                        yield pa.RecordBatch.from_pylist(found, schema=_ARROW)
                    if row["records"] is not None and count != row["records"]:
                        raise ValueError(f"{row['archive']} has {count} records from {row['start']} on, and {row['records']} in the manifest")

    return ranges.mapInArrow(read, StructType.fromDDL(RECORD))


_ARROW = pa.schema(
    [(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in RECORD.split(", "))]
)


class _Bytes:
    """The bytes of a file from a place on, read ahead as needed."""

    def __init__(self, file, at: int, size: int):
        self.file, self.at, self.size, self.held = file, at, size, b""

    def get(self, at: int, n: int) -> bytes:
        if not (self.at <= at and at + n <= self.at + len(self.held)):
            want = min(max(n, _READ), self.size - at)
            self.at, self.held = at, self.file.read_at(want, at) if want > 0 else b""
        return self.held[at - self.at : at - self.at + n]


def _records(file, start: int, end: int, size: int) -> Iterator[dict]:
    data, at = _Bytes(file, start, size), start
    while at < end:
        at = _next_magic(data, at, end)
        if at is None:
            return
        if not _is_record(data, at, size):
            at += 1
            continue
        raw, after = _inflate(data, at, size)
        yield _parse(raw, at)
        at = after


def _next_magic(data: _Bytes, at: int, end: int) -> int | None:
    """The first magic that begins before ``end``; its last bytes may lie beyond."""
    while at < end:
        part = data.get(at, min(_READ, end - at) + len(MAGIC) - 1)
        found = part.find(MAGIC)
        if found >= 0:
            return at + found if at + found < end else None
        at += max(1, len(part) - len(MAGIC) + 1)
    return None


def _is_record(data: _Bytes, at: int, size: int) -> bool:
    """Whether a WARC header comes out of the member that would begin here, however long it is."""
    gzip, out, first = zlib.decompressobj(31), bytearray(), at
    while at < size and not gzip.eof:
        part = data.get(at, min(4096, size - at))
        seen = max(0, len(out) - 3)
        try:
            out += gzip.decompress(part)
        except zlib.error as error:
            if len(out) < len(_VERSION):
                return False
            raise ValueError(f"the header of the record at {first} is damaged") from error
        if not out.startswith(_VERSION[: len(out)]):
            return False
        end = out.find(b"\r\n\r\n", seen)
        if end >= 0:
            return b"\r\nWARC-Type:" in out[:end]
        at += len(part)
    if len(out) < len(_VERSION):
        return False
    raise ValueError(f"the record at {first} is cut off: its header has no end")


def _inflate(data: _Bytes, at: int, size: int) -> tuple[bytes, int]:
    gzip, out, first = zlib.decompressobj(31), [], at
    while not gzip.eof:
        part = data.get(at, min(_READ, size - at))
        if not part:
            raise ValueError(f"the record at {first} is cut off")
        out.append(gzip.decompress(part))
        at += len(part)
    return b"".join(out), at - len(gzip.unused_data)


def _parse(raw: bytes, at: int) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("ascii", "replace")] = value.strip().decode("utf-8", "replace")
    length = int(fields["content-length"])
    if len(rest) < length:
        raise ValueError(f"the record at {at} is shorter than it says")
    http, _, body = rest[:length].partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    record = {
        "member_start": at, "record_type": kind, "record_id": fields.get("warc-record-id"), "target_uri": fields.get("warc-target-uri"),
        "refers_to_id": fields.get("warc-refers-to"),
    }
    if kind == "revisit":
        stated = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        return record | {"payload_digest": digest, "payload_bytes": int(stated[0]) if stated else 0, "payload": None}
    return record | {"payload_digest": hashlib.sha1(body).hexdigest(), "payload_bytes": len(body), "payload": body}


def archive_folder(spark: SparkSession) -> str:
    return fresh_path(spark, "warc")
