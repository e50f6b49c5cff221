"""WARC archives: writing, normalising whole-file gzip, reading by index.

``write_archives`` puts records into files that are each one gzip stream over
all of their records, as some crawlers leave them: no record can be reached
but by inflating everything before it. ``normalise`` inflates such a file once,
in pieces, and rewrites every record as a gzip member of its own, with a
sidecar index of offsets; ``read_records`` reads records through that index.

A record is a ``response`` (HTTP head and payload) or a ``revisit`` (HTTP head
only) of the response with the smallest page_id that has the same payload.
Payloads under ``least_bytes`` bytes are never revisits. A null html is the
empty payload; rows that share the smallest page_id of a payload are all
responses, and so are rows whose payload occurs with a null page_id only.
A task holds one record's head and pieces of 256 KB.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import NewFile, new_folder, open_file, saved

PIECE = 256 << 10
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the name space for URLs (RFC 4122)
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"  # fixed value of the WARC standard


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{page_id}')}>"


def with_revisits(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest and refers_to (null: a response)."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))
    own = own.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha2("html", 256)})
    # the smallest page of each payload that occurs again: partial sums before the shuffle
    first = own.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = first.filter("n > 1 AND first IS NOT NULL").drop("n")
    return own.join(first, "payload_digest", "left").select("page_id", "url", "html", "payload_bytes", "payload_digest",
                                                            F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))


def _clean(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in value)


def record(row: dict, date: str) -> bytes:
    """One WARC/1.0 record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    revisit = row["refers_to"] is not None
    block = http if revisit else http + row["html"]
    head = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(row['page_id'])}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {_clean(row['url'] or 'about:blank')}", f"WARC-Payload-Digest: sha256:{row['payload_digest']}"]
    if row["page_id"] is not None:
        head.append(f"X-Page-Id: {row['page_id']}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(row['refers_to'])}", f"X-Refers-To-Page-Id: {row['refers_to']}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 4) -> DataFrame:
    """One archive for each partition, a single gzip stream. Returns the files and their records."""
    def write(batches):
        out = None
        for batch in batches:
            if out is None and batch.num_rows:
                path = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz"
                out, pack, n = NewFile(path), zlib.compressobj(level, zlib.DEFLATED, 31), 0
            for i in range(batch.num_rows):  # a row at a time: the batch is the only copy of the payloads
                row = {c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)}
                out.write(pack.compress(record(row, date)))
                n += 1
        if out is not None:
            out.write(pack.flush())
            out.__exit__(None, None, None)
            yield pa.RecordBatch.from_pylist([{"file": path, "records": n}], pa.schema([("file", pa.string()), ("records", pa.int64())]))

    return saved(records.mapInArrow(write, "file string, records long"), "warc-files")


def inflated(file):
    """The plain bytes of a gzip file in pieces, whether of one member or of many."""
    stream, pending = zlib.decompressobj(31), b""
    while True:
        data = pending or file.read(PIECE)
        if not data:
            return
        if stream.eof:
            stream = zlib.decompressobj(31)
        piece = stream.decompress(data, PIECE)
        pending = stream.unused_data if stream.eof else stream.unconsumed_tail
        if piece:
            yield piece


def fields(head: bytes) -> dict[str, str]:
    """The named fields of a record's head, lower-case names."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def split_records(pieces):
    """(fields, iterator of the record's bytes) for each record of a plain
    WARC stream. The bytes are to be consumed before the next record."""
    pieces, held = iter(pieces), b""

    def more() -> bool:
        nonlocal held
        piece = next(pieces, None)
        held += piece or b""
        return piece is not None

    while True:
        while held.startswith((b"\r", b"\n")):
            held = held.lstrip(b"\r\n")
        if not held:
            if not more():
                return
            continue
        while (at := held.find(b"\r\n\r\n")) < 0:
            if not more():
                raise ValueError("a WARC record's head has no end")
        head, held = held[:at + 4], held[at + 4:]
        found = fields(head)
        left = int(found["content-length"])

        def body(head=head, left=left):
            nonlocal held
            yield head
            while left:
                if not held and not more():
                    raise ValueError("a WARC record is cut short")
                piece, held = held[:left], held[left:]
                left -= len(piece)
                yield piece
            yield b"\r\n\r\n"

        yield found, body()


def normalise_file(source: str, target: str, level: int = 6) -> int:
    """Rewrite one archive with a member for each record and write
    ``target.idx``: JSON lines of offset, length and the record's main fields."""
    n = 0
    with open_file(source) as file, NewFile(target) as out, NewFile(f"{target}.idx") as index:
        for found, body in split_records(inflated(file)):
            begin, pack = out.size, zlib.compressobj(level, zlib.DEFLATED, 31)
            for piece in body:
                out.write(pack.compress(piece))
            out.write(pack.flush())
            index.write(json.dumps({"offset": begin, "length": out.size - begin, "id": found.get("warc-record-id"), "type": found.get("warc-type"),
                                    "uri": found.get("warc-target-uri"), "digest": found.get("warc-payload-digest")}).encode() + b"\n")
            n += 1
    return n


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Normalise the archives of ``files`` (column ``file``), a task for each
    few: gzip can't be entered in the middle. Returns the new files."""
    def rewrite(batches):
        for batch in batches:
            for source in batch.column("file").to_pylist():
                target = f"{folder}/{source.rsplit('/', 1)[-1]}"
                yield pa.RecordBatch.from_pylist([{"file": target, "records": normalise_file(source, target)}],
                                                 pa.schema([("file", pa.string()), ("records", pa.int64())]))

    return saved(_spread(files).mapInArrow(rewrite, "file string, records long"), "warc-members")


def _spread(files: DataFrame) -> DataFrame:
    return files.select("file").repartition(4 * max(1, files.sparkSession.sparkContext.defaultParallelism))


def entries(target: str):
    """The rows of a sidecar index."""
    with open_file(f"{target}.idx") as file:
        rest = b""
        while piece := file.read(PIECE):
            *lines, rest = (rest + piece).split(b"\n")
            yield from map(json.loads, lines)


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string"
_RECORDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                      ("refers_to", pa.int64()), ("target_uri", pa.string())])


def read_record(file, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Fields and block of the record at an offset, from its member alone."""
    file.seek(offset)
    plain = zlib.decompress(file.read(length), 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    found = fields(head)
    return found, rest[:int(found["content-length"])]


def read_records(files: DataFrame) -> DataFrame:
    """All records of normalised archives, each read by its index entry. The
    size and digest of a response are those of the payload as read; those of a
    revisit are what its head says of the full payload."""
    def read(batches):
        for batch in batches:
            for target in batch.column("file").to_pylist():
                rows = []
                with open_file(target) as file:
                    for entry in entries(target):
                        found, block = read_record(file, entry["offset"], entry["length"])
                        http, _, payload = block.partition(b"\r\n\r\n")
                        said = found["warc-payload-digest"].removeprefix("sha256:")
                        revisit = found["warc-type"] == "revisit"
                        own = said if revisit else hashlib.sha256(payload).hexdigest()
                        if own != said:
                            raise ValueError(f"{target}: the payload at {entry['offset']} does not have its digest")
                        size = int(fields(http)["content-length"]) if revisit else len(payload)
                        page, refers = found.get("x-page-id"), found.get("x-refers-to-page-id")
                        rows.append({"page_id": page and int(page), "payload_bytes": size, "payload_digest": own, "record_type": found["warc-type"],
                                     "refers_to": refers and int(refers), "target_uri": found["warc-target-uri"]})
                        if len(rows) == 5_000:
                            yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, _RECORDS)

    return _spread(files).mapInArrow(read, RECORDS)


def archive(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Write ``pages`` as whole-file archives, normalise these, and return the
    records as read back by index."""
    spark = pages.sparkSession
    written = write_archives(with_revisits(pages, least_bytes), new_folder(spark, "warc-whole"))
    return read_records(normalise(written, new_folder(spark, "warc")))
