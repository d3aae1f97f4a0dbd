"""WARC archives: written as monolithic gzip, normalised to one gzip member per record, read by offset.

The first archive is what many crawlers leave: every file one gzip stream over all its records. The
normaliser inflates each such file once, front to back, and writes every record again as a member of its
own, with a side table of offsets; after that any record can be read without the rest of its file.
Payloads that repeat are written once; later ones are ``revisit`` records that name the first.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import shared_folder, slice_count

LEAST_REVISIT = 100
#: Records of one archive file; with the largest payloads this bounds the file that one task inflates.
RECORDS_PER_FILE = 5_000
END = "\r\n\r\n"
#: Bytes inflated at a time; deflate makes at most about 1,000 times as many of them.
_STEP = 1 << 14


def digests(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, html (null: empty), payload_bytes, payload_digest (lower-case hex SHA-256)."""
    body = F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html")
    slim = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body)
    return slim.select("*", F.octet_length("html").cast("long").alias("payload_bytes"),
                       F.sha2(F.col("html").cast("binary"), 256).alias("payload_digest"))


def _header(kind: str, *more: tuple[str, Column]) -> Column:
    """Header lines of a record, each ended by CRLF; lines with a null value are left out."""
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\n")]
    lines += [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in more]
    return F.concat(*lines, F.lit("\r\n"))


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One column ``value``: the WARC records of ``pages`` without their closing two CRLF.

    Of pages with equal payloads of at least 100 bytes the one with the smallest id is the response and the
    others revisit it; all smaller ones are responses. Rows that repeat that id are responses too. A null id
    is written as ``none`` and is a response only if no row with an id has the payload; then all such are.
    A null url has no header; a line break in one is percent-encoded.
    """
    rows = digests(pages, page_id, url, html)
    firsts = digests(pages, page_id, url, html).where(f"payload_bytes >= {LEAST_REVISIT}").groupBy("payload_digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n")
    # Only digests that occur more than once are looked up; the pages are split if one of them is frequent.
    told = rows.join(firsts, "payload_digest", "left")
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    common = (("WARC-Record-ID", record_id(F.col("page_id"))), ("WARC-Target-URI", target),
              ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
              ("WARC-Payload-Length", F.col("payload_bytes").cast("string")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    size = (F.octet_length(http) + F.col("payload_bytes")).cast("string")
    response = F.concat(_header("response", *common, ("Content-Type", F.lit("application/http; msgtype=response")),
                                ("Content-Length", size)), http, F.col("html"))
    revisit = _header("revisit", *common, ("WARC-Refers-To", record_id(F.col("first"))),
                      ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                      ("Content-Length", F.lit("0")))
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return told.select(F.when(again, revisit).otherwise(response).alias("value"))


def write_monolithic(rows: DataFrame, path: str, per_file: int = RECORDS_PER_FILE) -> None:
    """Write records to ``path``, each file one gzip stream over up to ``per_file`` records."""
    rows.write.option("compression", "gzip").option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


def inflated(packed: bytes) -> Iterator[bytes]:
    """The content of a gzip file, however many members it has, in bounded pieces."""
    view, at = memoryview(packed), 0
    while at < len(view):
        stream = zlib.decompressobj(31)
        while not stream.eof:
            if at >= len(view):
                raise EOFError("the gzip stream ends early")
            yield stream.decompress(view[at:at + _STEP])
            at = min(at + _STEP, len(view))
        at -= len(stream.unused_data)


def split_records(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """Whole records, header to closing CRLFs, from pieces of an inflated archive."""
    held, pieces = bytearray(), iter(pieces)

    def enough(test) -> bool:
        while not test():
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while enough(lambda: len(held) > 0):
        if not enough(lambda: held.find(b"\r\n\r\n") >= 0):
            raise EOFError("a record header is cut off")
        head = held.find(b"\r\n\r\n") + 4
        whole = head + int(headers(bytes(held[:head]))["content-length"]) + 4
        if not enough(lambda: len(held) >= whole):
            raise EOFError("a record is cut off")
        yield bytes(held[:whole])
        del held[:whole]


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines) if name}


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every archive file under ``source`` with one gzip member per record; returns the offset index.

    The index (file, offset, length, record_id, record_type) is written to ``target``/index, the archives to
    ``target``/archive. A file is inflated once, in bounded pieces. Each is written under a name of the
    attempt's own and the index names it, so a task that runs twice leaves at worst a file that nothing names.
    """
    archive = f"{target}/archive"
    fs.FileSystem.from_uri(target)[0].create_dir(fs.FileSystem.from_uri(archive)[1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for packed in batch["content"]:
                name = f"{archive}/{uuid.uuid4().hex}.warc.gz"
                store, path = fs.FileSystem.from_uri(name)
                rows, at = [], 0
                with store.open_output_stream(path, compression=None) as out:
                    for record in split_records(inflated(packed)):
                        squeezer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = squeezer.compress(record) + squeezer.flush()
                        out.write(member)
                        told = headers(record[:record.find(END.encode()) + 4])
                        rows.append((name, at, len(member), told["warc-record-id"], told["warc-type"]))
                        at += len(member)
                yield pd.DataFrame(rows, columns=["file", "offset", "length", "record_id", "record_type"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("content")
    index = files.mapInPandas(run, "file string, offset long, length long, record_id string, record_type string")
    index.write.parquet(f"{target}/index")
    return spark.read.parquet(f"{target}/index")


def read_records(index: DataFrame) -> DataFrame:
    """Read the records an index names, each by its offset.

    page_id, url, record_type, refers_to, payload (null for revisits), payload_bytes, payload_digest. Both of
    the latter are taken anew from a response's payload, and from the header of a revisit.
    """
    schema = ("page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, "
              "payload_digest string")

    def page(name: str | None) -> int | None:
        number = (name or "").removeprefix("<urn:page:").removesuffix(">")
        return None if number in ("", "none") else int(number)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.sort_values(["file", "offset"]).groupby("file", sort=False):
                store, path = fs.FileSystem.from_uri(name)
                with store.open_input_file(path) as archive:
                    rows, held = [], 0
                    for at, size in zip(part["offset"].tolist(), part["length"].tolist()):
                        archive.seek(at)
                        record = zlib.decompress(archive.read(size), 31)
                        head = record.find(b"\r\n\r\n") + 4
                        told = headers(record[:head])
                        payload = None
                        if told["warc-type"] == "response":
                            payload = record[record.find(b"\r\n\r\n", head) + 4:-4]
                        rows.append((
                            page(told["warc-record-id"]), told.get("warc-target-uri"), told["warc-type"],
                            page(told.get("warc-refers-to")), payload,
                            int(told["warc-payload-length"]) if payload is None else len(payload),
                            told["warc-payload-digest"].removeprefix("sha256:") if payload is None
                            else hashlib.sha256(payload).hexdigest()))
                        held += len(record)
                        if held > 1 << 23:
                            yield _frame(rows)
                            rows, held = [], 0
                    yield _frame(rows)

    dealt = index.select("file", "offset", "length").repartition(slice_count(index.sparkSession), "file")
    return dealt.mapInPandas(run, schema)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"])
    return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def archive_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                  folder: str | None = None) -> DataFrame:
    """Write ``pages`` as WARC, normalise the archive and read it back through its index.

    Everything is written under ``folder``, by default a new one in the shared folder. An empty table gives
    an empty archive; columns other than the three named ones are not read.
    """
    spark = pages.sparkSession
    base = folder or os.path.join(shared_folder(spark), "riskloom", uuid.uuid4().hex)
    base = base if "://" in base else f"file://{os.path.abspath(base)}" if not base.startswith("file:") else base
    write_monolithic(records(pages, page_id, url, html), f"{base}/monolithic")
    return read_records(normalise(spark, f"{base}/monolithic", base))
