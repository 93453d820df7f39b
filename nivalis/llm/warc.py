"""WARC archives: writing, a normaliser for monolithic gzip files, and reading by index.

write() makes one WARC record per page. Spark's text writer puts them into
whole-file gzip streams, the blank lines that end a record being the line
separator. Of pages with equal payloads of at least `REVISIT_BYTES` bytes one is
stored as a response, the others as revisits without payload. The decision is
made on digests (SHA-1, length and an independent hash must agree), first within
crews of pages (as many as shuffle partitions, 64 at least), then over these; so a payload that a third of all pages share
makes no hot key.

normalise() inflates each whole-file stream once, rewrites every record as a gzip
member of its own, and writes a sidecar index (a JSON line per record with offset,
length, type and id). Files appear under their final name only when complete, so a
task that is run again does no harm.

read_back() finds every record through the sidecar index and inflates that
member only.

Archives lie in the shared folder (or any folder that pyarrow's file systems
reach). An archive has as many records as make `BYTES` bytes on average, `RECORDS` at
most; archives are read as streams, so a task holds one record and an index.

Defined results. A null html is an empty payload; a null url is left out of the
record; line ends in a url are percent-encoded. A null page_id is stored as
such and only becomes a response if no page with an id has its payload. Repeated
rows of a response's page are responses, too. An empty table gives no archive and
an empty result. Further columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nivalis.llm.common import crews, new_folder, stash

REVISIT_BYTES = 1000
RECORDS = 5000
BYTES = 64 << 20
MOST_TASKS = 20_000
DIGEST = ["sha", "length", "other"]
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
DATE = "2025-01-01T00:00:00Z"


def decided(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Pages with their payload's digest and, for revisits, `first`: the page that holds the payload."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("url"),
        payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("sha"),
        F.octet_length(payload).cast("long").alias("length"),
        F.xxhash64(payload).alias("other"),
        F.pmod(F.xxhash64(F.lit("crew"), "page_id"), F.lit(crews(pages.sparkSession))).alias("crew"),
    )
    by_crew = own.where(F.col("length") >= least).groupBy(*DIGEST, "crew").agg(F.max("page_id").alias("page"), F.count("*").alias("n"))
    by_crew = stash(by_crew, "warc-digests")
    shared = by_crew.groupBy(*DIGEST).agg(F.max("page").alias("first"), F.sum("n").alias("n")).where("n > 1").drop("n")
    routes = by_crew.select(*DIGEST, "crew").join(shared, DIGEST)
    return own.join(routes, [*DIGEST, "crew"], "left").withColumn(
        "first", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    )


def records(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """A column `value` with each page's WARC record, but for the blank lines at its end."""
    own = decided(pages, least)
    revisit = F.col("first").isNotNull()
    http = F.concat(F.lit(HTTP), F.col("length"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: <urn:x-page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), F.col("url")), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("sha"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:x-page:"), F.col("first"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block),
        F.lit("\r\n\r\n"),
    )
    return own.select(F.concat(header, block).alias("value"))


def write(pages: DataFrame, folder: str, least: int = REVISIT_BYTES, most_records: int = RECORDS, most_bytes: int = BYTES) -> None:
    """Monolithic archives: each file one gzip stream of whole records."""
    mean = pages.agg(F.avg(F.coalesce(F.octet_length("html"), F.lit(0)) + 500)).first()[0] or 1
    per_archive = max(1, min(most_records, int(most_bytes / mean)))
    out = records(pages, least).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_archive)
    out.option("compression", "gzip").text(folder)


class Inflated:
    """Reads a compressed file of one or several gzip members as one stream."""

    def __init__(self, source, step: int = 1 << 18):
        self.source, self.step, self.rest, self.held = source, step, b"", bytearray()
        self.stream = zlib.decompressobj(31)

    def _more(self) -> bool:
        part = self.rest or self.source.read(self.step)
        if self.stream.eof and part:
            self.stream = zlib.decompressobj(31)
        more = self.stream.decompress(part, 4 * self.step)  # the rest of a part that inflates to more waits
        self.rest = self.stream.unused_data if self.stream.eof else self.stream.unconsumed_tail
        self.held += more
        return bool(part or more)

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the data."""
        seen = 0
        while (i := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark) + 1)
            if not self._more():
                if self.held.strip():
                    raise ValueError("the archive ends within a record")
                return None
        return self.take(i + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def fields(header: bytes) -> dict[str, str]:
    lines = header.decode().split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def raw_records(source):
    """(header fields, whole record with its ending blank lines) of each record of a compressed archive, an open file."""
    stream = Inflated(source)
    while (header := stream.until(b"\r\n\r\n")) is not None:
        named = fields(header)
        body = stream.take(int(named["content-length"]) + 4)
        if not body.endswith(b"\r\n\r\n"):
            raise ValueError("a record does not end in blank lines")
        yield named, header + body


def _put(system, path: str, parts) -> None:
    """Write a file under another name first, then move it into place."""
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(part, compression=None) as out:
        for p in parts:
            out.write(p)
    system.move(part, path)


def normalise(spark, folder: str, out: str, level: int = 6) -> DataFrame:
    """Rewrites all monolithic archives of a folder; returns archive and number of records, already written."""
    schema = "archive string, n long"

    def run(batches):
        from pyarrow.fs import FileSystem

        for batch in batches:
            done = []
            for path in batch.column("path").to_pylist():
                archive = f"{out}/{path.rsplit('/', 1)[-1].split('.')[0]}.warc.gz"
                system, target = FileSystem.from_uri(archive)
                origin, at_origin = FileSystem.from_uri(path)
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                index, at = [], 0

                def members():
                    nonlocal at
                    with origin.open_input_stream(at_origin, compression=None) as source:
                        for named, record in raw_records(source):
                            member = gzip.compress(record, level, mtime=0)
                            index.append({"offset": at, "length": len(member), "type": named["warc-type"], "id": named["warc-record-id"]})
                            at += len(member)
                            yield member

                _put(system, target, members())
                _put(system, target + ".idx", (json.dumps(x).encode() + b"\n" for x in index))
                done.append((archive, len(index)))
            cols = list(zip(*done)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64())], ["archive", "n"])

    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("path")
    return stash(files.mapInArrow(run, schema), "warc-archives")


def parse(record: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and payload (None for a revisit) of one record."""
    header, _, rest = record.partition(b"\r\n\r\n")
    named = fields(header)
    http, _, payload = rest[: int(named["content-length"])].partition(b"\r\n\r\n")
    number = lambda s: int(n) if (n := s.rpartition(":")[2].rstrip(">")) else None
    revisit = named["warc-type"] == "revisit"
    return {
        "page_id": number(named["warc-record-id"]),
        "payload_bytes": int(fields(http)["content-length"]) if revisit else len(payload),
        "payload_digest": named["warc-payload-digest"].removeprefix("sha1:") if revisit else hashlib.sha1(payload).hexdigest(),
        "record_type": named["warc-type"],
        "refers_to": number(named["warc-refers-to"]) if revisit else None,
        "url": named.get("warc-target-uri"),
        "payload": None if revisit else payload,
    }


READ = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())]
)
READ_SQL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def read_back(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """A row per record of the normalised archives, each found by its index; `payloads` False leaves these null."""

    def run(batches):
        from pyarrow.fs import FileSystem

        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                system, path = FileSystem.from_uri(archive)
                with system.open_input_stream(path + ".idx", compression=None) as f:
                    index = [json.loads(x) for x in f.read().splitlines()]
                with system.open_input_file(path) as f:
                    for start in range(0, len(index), 500):
                        rows = []
                        for x in index[start : start + 500]:
                            f.seek(x["offset"])
                            row = parse(gzip.decompress(f.read(x["length"])))
                            rows.append(row if payloads else row | {"payload": None})
                        yield pa.RecordBatch.from_pylist(rows, READ)

    return archives.select("archive").repartition(max(1, min(MOST_TASKS, archives.count()))).mapInArrow(run, READ_SQL)


def round_trip(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Writes, normalises and reads back; the archives stay in the shared folder."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write(pages, f"{folder}/whole", least)
    return read_back(normalise(spark, f"{folder}/whole", f"{folder}/members"), payloads=False)
