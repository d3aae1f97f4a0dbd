import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from riskloom.llm import warc

KIND = "page_id long, url string, html string, payload_digest int, first int"


def rows():
    long = "<p>" + "é" * 60 + "\r\n\r\nWARC/1.1\r\n</p>"
    return [(3, "http://a.example/x", long), (1, "http://a.example/y\r\nEvil: 1", long), (2, None, long), (4, "u", "short"), (5, "u", "short"),
            (6, "u", None), (7, "u", ""), (8, "u", "\r\n\r\n" * 40), (9, "u", "x" * 300_000), (1, "again", long), (None, "n", long),
            (None, "m", "q" * 100), (None, "m", "q" * 100), (11, "u", "z" * 99), (12, "u", "z" * 99), (13, "u", "z" * 100), (14, "v", "z" * 100)]


def want():
    first = {}
    for i, _, h in rows():
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows():
        body = (h or "").encode()
        origin = first.get(h or "")
        again = len(body) >= 100 and origin is not None and i != origin
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", origin if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(*r, 0, 0) for r in rows()], KIND)
    got = warc.archive_pages(df, folder=str(tmp_path / "w"))
    told = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect()]
    assert sorted(told, key=str) == want()
    payloads = {r["page_id"]: bytes(r["payload"]) for r in got.where("record_type = 'response' and page_id is not null").collect()}
    assert payloads[9] == b"x" * 300_000 and payloads[6] == b"" and payloads[8] == b"\r\n\r\n" * 40
    # Every indexed member is a gzip file of its own, and in order they make up the whole archive.
    index = spark.read.parquet(f"file://{tmp_path}/w/index").orderBy("file", "offset").collect()
    assert len(index) == len(rows())
    for name in {r["file"] for r in index}:
        raw = open(name.removeprefix("file://"), "rb").read()
        mine = [r for r in index if r["file"] == name]
        assert [r["offset"] for r in mine] == [sum(x["length"] for x in mine[:n]) for n in range(len(mine))]
        assert all(gzip.decompress(raw[r["offset"]:r["offset"] + r["length"]]).startswith(b"WARC/1.1\r\n") for r in mine)
        assert sum(r["length"] for r in mine) == len(raw)


def test_empty_table(spark):
    df = spark.createDataFrame([], KIND)
    assert warc.archive_pages(df).count() == 0


def test_records_across_pieces():
    body = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(x), x) for x in (b"", b"\r\n\r\n", b"abc" * 1000)]
    whole = b"".join(body)
    for step in (1, 7, 1000, len(whole)):
        assert list(warc.split_records(whole[i:i + step] for i in range(0, len(whole), step))) == body
    packed = gzip.compress(whole) + gzip.compress(body[0])
    assert list(warc.split_records(warc.inflated(packed))) == [*body, body[0]]
    with pytest.raises(EOFError):
        list(warc.inflated(packed[:-9]))
    with pytest.raises(EOFError):
        list(warc.split_records([whole[:-1]]))


def test_digest_column(spark):
    df = spark.createDataFrame([(*r, 0, 0) for r in rows()], KIND)
    assert warc.digests(df).where(F.col("payload_digest").isNull()).count() == 0
