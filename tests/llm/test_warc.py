"""Archives: exact round trips, equal payloads, continuations, broken records."""

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import warc

SCHEMA = "page_id bigint, url string, html string"
VERSION = "WARC/1."


def pages_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "page_id")


@pytest.fixture(scope="module")
def rows():
    deal = random.Random(7)
    text = lambda n: "".join(deal.choices("ab é\U0001f984\r\n<>", k=n))
    nasty = ["", None, "\r\n", "\r\n\r\n", "0\r\n\r\n", VERSION, f"W{VERSION}", f"WARC/{VERSION}1\r\n", VERSION * 300,
             f"{VERSION}1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "x\r\n" + VERSION, "\x00\x01",
             "same", "same", "same", text(50_000), text(4096), text(16384), "y" * 200_000]
    rows = [(i, f"https://a.example/{i} ä\r\nX: 1", html) for i, html in enumerate(nasty)]
    rows += [(100 + i, None, text(deal.randrange(1, 400))) for i in range(60)]
    # parts of version lines in every place
    rows += [(200 + i, "u", (VERSION + "1\r\n")[: i % 10 + 1] * 3 + "\n" * i + VERSION) for i in range(40)]
    return rows + [(None, "n", "same"), (None, "n", "only here"), (None, "n", "only here"), (7000, "t", "tie"), (7000, "t", "tie")]


def expected(rows, at_least=0):
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "").encode() == body]
        first = min((p for p in ids if p is not None), default=None)
        later = page != first and len(body) >= at_least
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, "revisit" if later else "response", first if later else None, len(body), digest,
                    None if later else body, True))
    return out


def result(df):
    found = [(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest,
              None if r.payload is None else bytes(r.payload), r.sound) for r in df.collect()]
    return sorted(found, key=repr)


@pytest.mark.parametrize("options", [{}, {"segment_bytes": 64, "chunk_bytes": 7}, {"segment_bytes": 1000}, {"at_least": 5}])
def test_pages_come_back_whole(spark, rows, options):
    got = result(warc.archive(pages_of(spark, rows), **options))
    assert got == sorted(expected(rows, options.get("at_least", 0)), key=repr)


def test_archives_are_plain_warc(spark, rows, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archives(pages_of(spark, rows), path, segment_bytes=5000)
    kinds = []
    for file in (tmp_path / "archive").glob("*.gz"):
        data = gzip.decompress(file.read_bytes())
        while data:  # read by content lengths alone
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            size = int(fields["Content-Length"])
            assert lines[0] == "WARC/1.1" and rest[size : size + 4] == b"\r\n\r\n"
            kinds.append((fields["WARC-Type"], fields["WARC-Record-ID"]))
            data = rest[size + 4 :]
    assert len(set(kinds)) == len(kinds) and {k for k, _ in kinds} == {"response", "revisit", "continuation"}


def test_segments_may_lie_in_other_files_and_order(spark, tmp_path):
    html = "".join(random.Random(1).choices("abc\r\né", k=3000))
    records = list(warc.page_records("5", "u", html.encode(), None, None, "n", 300, 100))
    assert len(records) > 5
    for i, record in enumerate(reversed(records)):
        (tmp_path / f"{i}.gz").write_bytes(gzip.compress(record + b"\r\n"))
    row = warc.read_pages(spark, str(tmp_path)).collect()
    assert [(r.page_id, bytes(r.payload), r.sound) for r in row] == [(5, html.encode(), True)]


def test_broken_archives_are_told(spark, tmp_path):
    html = "".join(random.Random(1).choices("abc", k=900))
    records = list(warc.page_records("5", "u", html.encode(), None, None, "n", 300, 100))
    whole = list(warc.page_records("6", "u", b"fine", None, None, "m"))
    cut = list(warc.page_records("7", "u", b"short" * 9, None, None, "k"))[0][:-30]
    wrong = list(warc.page_records("8", "u", b"some text", None, None, "j"))[0].replace(b"some", b"same")
    lost = records[:1] + records[2:]
    orphan = list(warc.page_records("9", "u", html.encode(), None, None, "o", 300, 100))[1:]
    body = b"junk" + b"".join(r + b"\r\n" for r in [*lost, cut, *whole, wrong, *orphan])
    (tmp_path / "a.gz").write_bytes(gzip.compress(body))
    got = {(r.page_id, r.sound) for r in warc.read_pages(spark, str(tmp_path)).collect()}
    assert got == {(5, False), (6, True), (7, False), (8, False), (None, False)}


def test_foreign_records_without_framing(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\nplain body"
    head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:a>\r\nContent-Length: %d\r\n\r\n" % len(http)
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:b>\r\nContent-Length: 4\r\n\r\na: b\r\n\r\n"
    # one gzip member per record, as crawlers write them
    (tmp_path / "a.gz").write_bytes(gzip.compress(info) + gzip.compress(head + http + b"\r\n\r\n"))
    found = {r.record_type: r for r in warc.read_pages(spark, str(tmp_path)).collect()}
    assert bytes(found["response"].payload) == b"plain body" and found["response"].sound


def test_chunked_framing():
    for n in (0, 1, 6, 7, 8, 100):
        assert warc.dechunked(warc.chunked(b"x" * n, 7)) == b"x" * n
    assert warc.dechunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"", b"3\r\nab\r\n0\r\n\r\n", b"zz\r\n", b"3\r\nabc\r\n", b"-1\r\n", b"3\r\nabc\r\n0\r\n"):
        assert warc.dechunked(broken) is None


def test_empty_table_and_clashing_names(spark, rows):
    assert warc.archive(spark.createDataFrame([], SCHEMA)).collect() == []
    names = "page payload first first_url revisits key same n held record type digest block whole sound parts head file value"
    more = pages_of(spark, rows).withColumns({c: F.lit(1) for c in names.split()})
    assert result(warc.archive(more)) == sorted(expected(rows), key=repr)


def test_page_ids_may_be_strings(spark):
    ids = ["a b", "%41", "+", "é\r\n", None]
    pages = spark.createDataFrame([(i, "u", f"text {i}") for i in ids], "page_id string, url string, html string")
    assert {r.page_id for r in warc.archive(pages).collect()} == set(ids)
