"""WARC archives: writing, normalising monolithic gzip files, and reading by index.

``write_archives`` writes pages as WARC records, one gzip stream per part file,
with Spark's text writer.  Such a monolithic file can only be read from its
start.  ``normalise_archives`` inflates each file's stream once, in pieces of
bounded size, rewrites every record as a gzip member of its own and writes a
sidecar index of offsets beside it.  ``read_records`` then fetches each record
by its offset alone.

Files are reached through the file system of their URI (the JVM lists them,
tasks open them with pyarrow), and a task writes under a name of its own and
renames, so a repeated or lost task leaves no torn file behind.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.llm.common import scratch_path, ship_package, stage

MIN_REVISIT_BYTES = 100
WARC_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_CHUNK = 1 << 20
GZIP_LEVEL = 6

INDEX = ("archive string, ordinal long, offset long, length long, record_id string, record_type string, "
         "page_id long, payload_bytes long, payload_digest string, refers_to long")
RECORDS = ("page_id long, url string, record_type string, payload binary, payload_bytes long, "
           "payload_digest string, refers_to long")


# --- records ---------------------------------------------------------------

def record_plan(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
                min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    Among payloads of at least ``min_bytes`` that are equal, rows with the
    smallest id are responses and the others revisits of it; shorter ones are
    all responses.  Only digests are grouped, pre-aggregated, and only digests
    that occur under several ids are joined back.  Null payloads count as empty;
    rows with a null id are responses."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.withColumn("__payload", payload).withColumn("payload_bytes", F.octet_length("__payload").cast("long"))
    rows = rows.withColumn("payload_digest", F.sha2("__payload", 256))
    first = (rows.where(F.col("payload_bytes") >= min_bytes).groupBy(F.col("payload_digest").alias("d2"))
             .agg(F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id")).where("first_id <> last_id")
             .select("d2", F.col("first_id").cast("long").alias("first_id")))
    later = (rows.select(F.col(id_col).alias("r_id"), F.col("payload_digest").alias("r_digest"))
             .join(first, F.col("r_digest") == F.col("d2")).where("r_id > first_id")
             .select("r_id", "r_digest", F.col("first_id").alias("refers_to")).distinct())
    rows = rows.join(later.hint("merge"), (F.col(id_col) == F.col("r_id")) & (F.col("payload_digest") == F.col("r_digest")), "left")
    return (rows.withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))
            .drop("r_id", "r_digest"))


def _record_id(page_id):
    h = F.md5(F.concat(F.lit("page-"), F.coalesce(page_id.cast("string"), F.lit(""))))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _one_line(c):
    """Header values hold no line breaks."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "[\\r\\n]+", " ")


def _record_text(id_col: str, url_col: str):
    """A WARC/1.1 record without the blank lines that end it.  A revisit holds
    the HTTP header block alone; its Content-Length is the full payload's."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(F.col("record_type") == "revisit", http).otherwise(F.concat(http, F.col("__payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "), _record_id(F.col(id_col)),
        F.lit(f"\r\nWARC-Date: {WARC_DATE}\r\nWARC-Target-URI: "), _one_line(F.col(url_col)),
        F.lit("\r\nX-Page-ID: "), F.coalesce(F.col(id_col).cast("string"), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("payload_digest"),
        F.when(F.col("record_type") == "revisit",
               F.concat(F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), _record_id(F.col("refers_to")),
                        F.lit("\r\nX-Refers-To-Page-ID: "), F.col("refers_to").cast("string"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("__body").cast("string"), F.lit("\r\n\r\n"))
    return body, F.concat(head, F.col("__body"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_bytes: int = MIN_REVISIT_BYTES) -> str:
    """Write one record per row below ``path``, a gzip stream per part file."""
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(payload_col).alias("html"))
    plan = record_plan(pages, min_bytes=min_bytes)
    body, record = _record_text("page_id", "url")
    (plan.withColumn("__body", body).select(record.alias("value"))
     .write.mode("overwrite").option("compression", "gzip").option("lineSep", "\r\n\r\n").text(path))
    return path


# --- files -----------------------------------------------------------------

def _open(uri: str):
    """(pyarrow file system, path in it) of a URI or local path."""
    from pyarrow import fs
    if re.match("file:/[^/]", uri):
        uri = uri.replace("file:/", "file:///", 1)
    if urlparse(uri).scheme:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


class _Records:
    """Cuts a stream of bytes into records: header block, then Content-Length
    bytes, then two line breaks.  Holds at most one record and one chunk."""

    def __init__(self):
        self.buffer, self.need = bytearray(), None

    def feed(self, data: bytes):
        self.buffer += data
        while True:
            if self.need is None:
                at = self.buffer.find(b"\r\n\r\n")
                if at < 0:
                    return
                head = bytes(self.buffer[: at + 4])
                if not head.startswith(b"WARC/"):
                    raise ValueError(f"not a WARC record: {head[:40]!r}")
                self.need = at + 4 + int(_headers(head)["content-length"]) + 4
            if len(self.buffer) < self.need:
                return
            record = bytes(self.buffer[: self.need])
            del self.buffer[: self.need]
            self.need = None
            yield record

    def end(self):
        if self.buffer:
            raise ValueError(f"{len(self.buffer)} bytes after the last whole record")


def _headers(block: bytes) -> dict:
    lines = block.decode("utf-8").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if ":" in x)}


def inflate_stream(source, chunk: int = READ_CHUNK):
    """Inflated bytes of a gzip file (one or more members), piece by piece."""
    z = zlib.decompressobj(wbits=31)
    while data := source.read(chunk):
        while data:
            yield z.decompress(data, 4 * chunk)
            data = z.unconsumed_tail
            if z.eof:
                data, z = z.unused_data, zlib.decompressobj(wbits=31)
    yield z.flush()


def _parse(record: bytes) -> dict:
    """Fields of one record, with its payload (of a revisit: empty)."""
    at = record.index(b"\r\n\r\n") + 4
    h = _headers(record[:at])
    body = record[at: at + int(h["content-length"])]
    cut = body.index(b"\r\n\r\n") + 4
    number = lambda x: int(x) if x else None
    return {"record_id": h["warc-record-id"], "record_type": h["warc-type"], "page_id": number(h["x-page-id"]),
            "url": h["warc-target-uri"], "payload": body[cut:],
            "payload_bytes": int(_headers(body[:cut])["content-length"]),
            "payload_digest": h["warc-payload-digest"].removeprefix("sha256:"),
            "refers_to": number(h.get("x-refers-to-page-id"))}


def _int64(values):
    return pd.array(values, dtype="Int64")


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(archive, bytes): the gzip files below a path, listed by Spark."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
            .select(F.col("path").alias("archive"), F.col("length").alias("bytes")))


def normalise_archives(files: DataFrame, to: str, level: int = GZIP_LEVEL) -> DataFrame:
    """Rewrite each gzip file of ``files`` (column ``archive``) below ``to`` as
    record-wise gzip with a sidecar index, and return the index.

    A file's stream is inflated once.  The new file is named after the old one
    (``<name>.warc.gz``), its index ``<name>.warc.gz.idx`` (tab-separated lines).
    Files without records give an empty archive and index.  A damaged stream
    fails the task: nothing is dropped silently."""
    ship_package(files.sparkSession)
    columns = [f.split()[0] for f in INDEX.split(", ")]

    def rewrite(frames):
        for frame in frames:
            for uri in frame["archive"]:
                src_fs, src = _open(uri)
                out_fs, root = _open(to)
                out_fs.create_dir(root, recursive=True)
                name = src.rsplit("/", 1)[-1].removesuffix(".gz").removesuffix(".txt") + ".warc.gz"
                tmp = f"{root}/.{name}.{uuid.uuid4().hex}"
                rows, offset, cut = [], 0, _Records()

                def member(record, sink):
                    z = zlib.compressobj(level, zlib.DEFLATED, 31)
                    data = z.compress(record) + z.flush()
                    sink.write(data)
                    f = _parse(record)
                    rows.append((f"{to}/{name}", len(rows), offset, len(data), f["record_id"], f["record_type"], f["page_id"],
                                 f["payload_bytes"], f["payload_digest"], f["refers_to"]))
                    return len(data)

                with src_fs.open_input_stream(src, compression=None) as source, out_fs.open_output_stream(tmp, compression=None) as sink:
                    for piece in inflate_stream(source):
                        for record in cut.feed(piece):
                            offset += member(record, sink)
                    cut.end()
                with out_fs.open_output_stream(f"{tmp}.idx", compression=None) as sink:
                    for r in rows:
                        sink.write(("\t".join("" if v is None else str(v) for v in r[1:]) + "\n").encode())
                out_fs.move(tmp, f"{root}/{name}")
                out_fs.move(f"{tmp}.idx", f"{root}/{name}.idx")
                out = pd.DataFrame(rows, columns=columns)
                for c in ("page_id", "refers_to"):
                    out[c] = _int64(out[c].tolist())
                yield out

    # a file is one stream, so one task's work; the list is too small for Spark to keep apart by itself
    return _spread(files.select("archive")).mapInPandas(rewrite, INDEX)


def _spread(rows: DataFrame) -> DataFrame:
    return rows.repartition(max(1, rows.select("archive").distinct().count()), "archive")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The sidecar indexes below a path of normalised archives."""
    fields = INDEX.split(", ", 1)[1]
    idx = spark.read.schema(fields).option("sep", "\t").option("quote", "").option("pathGlobFilter", "*.idx").csv(path)
    return idx.withColumn("archive", F.regexp_replace(F.col("_metadata.file_path"), "\\.idx$", ""))


def read_records(index: DataFrame) -> DataFrame:
    """Fetch the records an index names, each by its offset; the payload of a
    response is checked against its digest."""

    ship_package(index.sparkSession)
    def fetch(frames):
        for frame in frames:
            for uri, part in frame.groupby("archive", sort=False):
                fs_, path = _open(uri)
                rows, held = [], 0
                with fs_.open_input_file(path) as source:
                    for offset, length in zip(part["offset"].tolist(), part["length"].tolist()):
                        f = _parse(zlib.decompress(source.read_at(length, offset), wbits=31))
                        if f["record_type"] == "response" and hashlib.sha256(f["payload"]).hexdigest() != f["payload_digest"]:
                            raise ValueError(f"payload of {f['record_id']} doesn't match its digest")
                        rows.append(f)
                        held += f["payload_bytes"]
                        if held > (8 << 20):
                            yield _records_frame(rows)
                            rows, held = [], 0
                if rows:
                    yield _records_frame(rows)

    return _spread(index.select("archive", "offset", "length")).mapInPandas(fetch, RECORDS)


def _records_frame(rows: list) -> pd.DataFrame:
    out = pd.DataFrame(rows)[["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]]
    for c in ("page_id", "refers_to"):
        out[c] = _int64(out[c].tolist())
    return out


def warc_roundtrip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write, normalise and read back: one row per page, in the form of ``RECORDS``.

    Null payloads are empty records; null urls an empty target; rows with a
    null id keep it; rows that repeat an id and its payload are the same kind of
    record; an empty table gives an empty result; other columns are ignored."""
    spark = pages.sparkSession
    root = scratch_path(spark, "warc")
    write_archives(pages, f"{root}/monolithic", id_col, url_col, payload_col, min_bytes)
    stage(normalise_archives(archive_files(spark, f"{root}/monolithic"), f"{root}/normal"), "warc_index")
    return read_records(read_index(spark, f"{root}/normal"))
