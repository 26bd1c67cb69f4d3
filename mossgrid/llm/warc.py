"""WARC archives, index first: records are written with an index row each, and read back by coalesced byte ranges.

Every task appends gzip members, one a record, to archive files of its own below a shared folder and returns index rows
(file, offset, length, URL, digest). Only rows of attempts that succeeded reach the index, so files of failed attempts are
never read. Readers take any selection of the index, sorted by file and offset, and fetch neighbours in one read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mossgrid.llm.common import kept, pieces, prepare, scratch

LEAST_REVISIT = 1000
MOST_FILE = 1 << 30
GAP = 1 << 16
MOST_READ = 1 << 22
BLOCK = 1 << 25
#: Rows, and bytes of payload, that meet under one key; and parts of a group at most.
SALT_ROWS = 100_000
SALT_BYTES = 1 << 26
MOST_SALTS = 1 << 16
MOST_BROADCAST = 100_000
DATE = "1970-01-01T00:00:00Z"
#: Fixed value: the profile that the format names for records of an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, url string, file string, offset long, length long, digest string, record_type string, refers_to long"


def store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a URI, as `qualified` gives it, and the path in it; others than file: need what Arrow has for them."""
    if path.startswith("file:") or "://" not in path:
        return pyarrow.fs.LocalFileSystem(), re.sub("^file:/*", "/", path)
    return pyarrow.fs.FileSystem.from_uri(path)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark gives it, so that every process opens the same one: a plain path belongs to the default file system."""
    probe = f"{folder}/probe-{uuid.uuid4().hex}"
    spark.range(1).coalesce(1).write.parquet(probe)
    file = unquote(spark.read.parquet(probe).select("_metadata.file_path").first()[0])
    return file[: file.rindex("/probe-")]


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC 1.1 record: an HTTP response with the payload, or a revisit with the response's header only."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + (b"" if revisit else payload)
    head = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": record_id(page_id), "WARC-Date": DATE}
    if url is not None:
        head["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head |= {"Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{digest}"}
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to), "X-Refers-To-Page": str(refers_to)}
    if page_id is not None:
        head["X-Page-ID"] = str(page_id)
    head["Content-Length"] = str(len(block))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record's fields; ValueError where it is damaged. payload is None in a revisit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError("a record ends early")
    http, _, payload = block.partition(b"\r\n\r\n")
    n = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    revisit = fields["warc-type"] == "revisit"
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("a payload differs from its digest")
    number = lambda k: int(fields[k]) if fields.get(k, "None") != "None" else None
    return {"page_id": number("x-page-id"), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"], "payload_bytes": n, "payload_digest": digest, "refers_to": number("x-refers-to-page"), "payload": None if revisit else payload}


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Adds digest, revisit and refers_to: of rows with equal payloads of at least `least` bytes, those with another page_id than the largest revisit it.

    A null page_id never is the largest; equal rows of the largest page_id are all responses. Payloads that only rows
    without a page_id have are responses. Groups are (digest, largest page_id), written first: their size then decides how
    they meet the payloads, which move only where groups are many, and a group of many rows or bytes moves in several parts.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha1("payload"))
    groups = pages.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n"), F.max(F.octet_length("payload")).alias("size")).where("n > 1 and last is not null")
    # A group of many rows or bytes stands under several salts, and each row looks for one of them.
    parts = F.greatest(F.col("n") / SALT_ROWS, F.col("n") * F.col("size") / SALT_BYTES)
    salts = F.least(F.floor(parts), F.lit(MOST_SALTS - 1)).cast("int")
    groups = kept(groups.select("digest", "last", F.explode(F.sequence(F.lit(0), salts)).alias("salt"), (salts + 1).alias("salts")), "groups")
    large = groups.where("salt = 0 and salts > 1").select("digest", "salts")
    large = F.broadcast(large) if large.count() <= MOST_BROADCAST else large  # one group for SALT_ROWS pages or SALT_BYTES at most
    row_salt = F.pmod(F.xxhash64("page_id", "url"), F.coalesce("salts", F.lit(1))).cast("int")
    salted = pages.join(large, "digest", "left").withColumn("salt", row_salt).drop("salts")
    out = salted.join(groups.select("digest", "salt", "last"), ["digest", "salt"], "left").drop("salt")
    out = out.withColumn("revisit", F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")))
    return out.select("page_id", "url", "payload", "digest", "revisit", F.when(F.col("revisit"), F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, least: int = LEAST_REVISIT) -> DataFrame:
    """Writes (page_id, url, html) as archives below folder (a scratch folder if None) and returns the index, itself a table.

    Null html is empty. Repeated rows have a record each. Other columns are left out, whatever their names. Tables may be
    empty. The folder is on a file system that Spark and Arrow both know.
    """
    prepare(pages.sparkSession)
    folder = qualified(pages.sparkSession, folder or scratch(pages.sparkSession, "warc"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = store(folder)
        files.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in pieces(batches, "payload"):
                rows = []
                for r in batch.to_pylist():
                    if out is None or at > MOST_FILE:
                        if out is not None:
                            out.close()
                        name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = squeeze.compress(record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"], r["revisit"])) + squeeze.flush()
                    out.write(data)
                    rows.append((r["page_id"], r["url"], f"{folder}/{name}", at, len(data), r["digest"], "revisit" if r["revisit"] else "response", r["refers_to"]))
                    at += len(data)
                types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], [x.split()[0] for x in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    return kept(with_revisits(pages, least).mapInArrow(write, INDEX), "warc-index")


def read_records(index: DataFrame) -> DataFrame:
    """The records that index rows point to: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload (null in a revisit)."""
    prepare(index.sparkSession)
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    fields = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, list]]:
        name, start, end, inside = None, 0, 0, []
        for batch in batches:
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                if inside and (file != name or offset > end + GAP or offset + length - start > MOST_READ):
                    yield name, start, end, inside
                    inside = []
                if not inside:
                    name, start, end = file, offset, offset
                inside.append((offset, length))
                end = max(end, offset + length)
        if inside:
            yield name, start, end, inside

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for file, start, end, inside in ranges(batches):
            if file != name:
                files, path = store(file)
                name, source = file, files.open_input_file(path)
            source.seek(start)
            data = source.read(end - start)
            rows = [parse(zlib.decompress(data[a - start : a - start + n], 31)) for a, n in inside]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in fields.items()], list(fields))

    placed = index.select("file", "offset", "length").withColumn("block", F.floor(F.col("offset") / BLOCK))
    # Index rows are small next to what they name, so the number of tasks follows the archived bytes.
    size = placed.agg(F.sum("length")).first()[0] or 0
    return placed.repartition(max(index.sparkSession.sparkContext.defaultParallelism, size // BLOCK + 1), "file", "block").sortWithinPartitions("file", "offset").mapInArrow(read, schema)


def sql(table: str = "pages") -> str:
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM {table}),
d AS (SELECT page_id, strlen(h)::BIGINT AS n, sha1(h) AS digest FROM p),
g AS (SELECT *, CASE WHEN n >= {LEAST_REVISIT} THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS last FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN last IS NULL OR last IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN last IS DISTINCT FROM page_id THEN last END::BIGINT AS refers_to FROM g"""
