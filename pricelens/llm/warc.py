"""WARC archives of pages, and a normaliser for archives that are one gzip stream.

write_monolithic() makes such archives: a whole file is one gzip member. normalise() inflates each of them once, as a stream,
writes every record again as a gzip member of its own, and a sidecar index of where each starts and how long it is.
read_index() reads the sidecars, and read_records() fetches records by them alone. Each works on one file and holds one record at
a time; a lost task writes its files anew under the same names. A stream that stops before its trailer, or in a record, is an error.

Defined results: a null payload counts as empty; of equal payloads the one with the least id that isn't null is the response, and
rows that repeat that id are responses too; a page with a null id is a response unless an id has its payload; null URLs get no
URI line, control characters in URLs are percent-encoded; payloads of any length are written whole; only the columns named are read,
whatever the others are called; an empty table gives no archive and an empty index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, new_path, ship, small, stash
from .files import opened, written_whole

#: Equal payloads of so many bytes or more are stored once.
MIN_REVISIT_BYTES = 0
CHUNK = 1 << 18

_DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of bytes in base32: five hex digits at a time are four base32 ones."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_revisits(pages: DataFrame, payload: str = "html", id_col: str = "page_id", url: str = "url", least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """id, url, payload (bytes), digest and refers_to (the response's id for revisits, else null).

    Only digests that several pages share are joined back; payloads stay where they are unless these digests are too many to
    broadcast, when pages are shuffled by digest.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", base32_sha1(F.col("payload")))
    shared = rows.filter(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = small(stash(shared.filter("n > 1 and first is not null").select("digest", "first"), "payloads"))
    joined = rows.join(shared, "digest", "left")
    return joined.select("id", "url", "payload", "digest", F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first")).alias("refers_to"))


def _uri(x: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in x)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, uncompressed: WARC header, HTTP header, and for a response the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8").split("\r\n")[1:])}


def parse(raw: bytes) -> dict:
    """What a record says, with size and digest of its payload; those of a response are taken from the payload itself."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    ident = lambda x: int(v) if (v := x.removeprefix("<urn:page:").removesuffix(">")) else None
    out = {"id": ident(fields["warc-record-id"]), "record_type": fields["warc-type"], "refers_to": None}
    if out["record_type"] == "revisit":
        out |= {"refers_to": ident(fields["warc-refers-to"]), "payload_bytes": int(_fields(http)["content-length"])}
        out["payload_digest"] = fields["warc-payload-digest"].removeprefix("sha1:")
    else:
        out |= {"payload_bytes": len(payload), "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode()}
    return out


def write_monolithic(rows: DataFrame, folder: str) -> DataFrame:
    """One archive for each partition of with_revisits(), each a single gzip stream; archive (path) and n_records."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, n = f"{folder}/{TaskContext.get().partitionId():06d}.warc.gz", 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        with written_whole(path) as out, gzip.GzipFile(fileobj=out, mode="wb", compresslevel=5, mtime=0) as stream:
            for batch in (b for part in ([first], batches) for b in part):
                for i in range(0, batch.num_rows, SLICE_ROWS):
                    for r in batch.slice(i, SLICE_ROWS).to_pylist():
                        stream.write(record(r["id"], r["url"], r["payload"], r["digest"], r["refers_to"]))
                        n += 1
        yield pa.RecordBatch.from_pydict({"archive": [path], "n_records": pa.array([n], pa.int64())})

    return rows.select("id", "url", "payload", "digest", "refers_to").mapInArrow(run, "archive string, n_records bigint")


def inflated_records(stream) -> Iterator[bytes]:
    """The records of a gzip stream of any number of members, in order, with what one record and one chunk need of memory."""
    inflate = zlib.decompressobj(31)
    held = bytearray()
    need, fresh = 0, True
    while data := stream.read(CHUNK):
        while data:
            if fresh and not (data := data.lstrip(b"\0")):  # padding between members
                break
            fresh = False
            held += inflate.decompress(data, CHUNK)
            data = inflate.unconsumed_tail
            if inflate.eof:
                data, inflate, fresh = inflate.unused_data, zlib.decompressobj(31), True
            while (end := held.find(b"\r\n\r\n")) >= 0 and len(held) >= (need or end + 4):
                size = end + 4 + int(_fields(bytes(held[:end]))["content-length"]) + 4
                if len(held) < size:
                    need = size
                    break
                yield bytes(held[:size])
                del held[:size]
                need = 0
    if not fresh:
        raise ValueError("the gzip stream stops before its end")
    if held:
        raise ValueError(f"{len(held)} bytes after the last whole record")


def normalise(archives: DataFrame, folder: str, path: str = "archive") -> DataFrame:
    """Write each archive again with a gzip member for each record, and beside it <name>.idx: a line of record number, offset and
    length for each. Returned are archive (the new path) and n_records.

    An archive is one task's work, as a gzip stream can only be read from its start.
    """
    ship(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column(0).to_pylist():
                target = f"{folder}/{source.rpartition('/')[2]}"
                n, at = 0, 0
                with opened(source) as stream, written_whole(f"{target}.idx") as index, written_whole(target) as out:
                    for raw in inflated_records(stream):
                        member = gzip.compress(raw, compresslevel=5, mtime=0)
                        out.write(member)
                        index.write(f"{n} {at} {len(member)}\n".encode())
                        n, at = n + 1, at + len(member)
                yield pa.RecordBatch.from_pydict({"archive": [target], "n_records": pa.array([n], pa.int64())})

    count = max(1, archives.count())
    return archives.select(path).repartition(count).mapInArrow(run, "archive string, n_records bigint")


def read_index(archives: DataFrame, folder: str) -> DataFrame:
    """archive, number, offset and length of every record, from the sidecars of normalise()'s archives in the folder."""
    spark = archives.sparkSession
    if archives.isEmpty():
        return spark.createDataFrame([], "archive string, number bigint, offset bigint, length bigint")
    lines = spark.read.text(f"{folder}/*.idx")
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.idx$", "")
    part = lambda i: F.split("value", " ")[i].cast("bigint")
    found = lines.select(F.concat(F.lit(folder + "/"), name).alias("archive"), part(0).alias("number"), part(1).alias("offset"), part(2).alias("length"))
    return found.join(small(archives.select("archive")), "archive", "left_semi")


def read_records(index: DataFrame) -> DataFrame:
    """archive, number, and what parse() finds, of each record that the index names; each is fetched by offset and length."""
    ship(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(i, SLICE_ROWS).to_pylist()
                got = []
                for r in part:
                    if r["archive"] != name:
                        if file is not None:
                            file.close()
                        name, file = r["archive"], opened(r["archive"], random=True)
                    file.seek(r["offset"])
                    got.append({"archive": name, "number": r["number"]} | parse(gzip.decompress(file.read(r["length"]))))
                yield pa.RecordBatch.from_pylist(got, schema=schema)
        if file is not None:
            file.close()

    schema = pa.schema(
        [("archive", pa.string()), ("number", pa.int64()), ("id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    )
    ddl = "archive string, number bigint, id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"
    return index.select("archive", "number", "offset", "length").mapInArrow(run, ddl)


def round_trip(pages: DataFrame, payload: str = "html", id_col: str = "page_id", url: str = "url") -> DataFrame:
    """Pages written to monolithic archives, normalised, and read back through the index: id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    folder = new_path(spark, "warc-records")
    archives = stash(write_monolithic(with_revisits(pages, payload, id_col, url), new_path(spark, "warc")), "archives")
    index = read_index(stash(normalise(archives, folder), "normalised"), folder)
    return read_records(index).select(F.col("id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
