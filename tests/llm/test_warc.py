import pytest
from scopewise.llm import warc
from scopewise.session import scratch_path

TRAP = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [
    (1, "http://a/", "<p>one"), (2, "http://a/b", "<p>one"), (3, None, None), (4, "http://x\r\nWARC-Type: trap", ""),
    (5, "http://trap", TRAP), (6, "http://trap/2", "x" + TRAP * 50 + "WARC/1.1\r\n"), (7, "u", "é😀\x00\r\n\r\n" * 900),
    (7, "u", "é😀\x00\r\n\r\n" * 900), (None, "u", "null id"), (8, "u", "y" * 30_000), (9, "u", "<p>one"),
    (-5, "u", "null id"),
]


def expected(rows, least):
    top = {}
    for page_id, _, html in rows:
        top[html or ""] = max(top.get(html or "", -99), -99 if page_id is None else page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        keep = page_id == top[html or ""] or (page_id is None and top[html or ""] == -99) or len(data) < least
        out.append(
            (page_id, len(data), warc.base32_sha1(data), "response" if keep else "revisit", None if keep else top[html or ""])
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("range_bytes", [64, 5_000, warc.RANGE_BYTES])
@pytest.mark.parametrize("least", [0, 3])
def test_round_trip(spark, range_bytes, least):
    rows = [(i, u, h, "x", 0) for i, u, h in PAGES]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, path string, offset long").coalesce(2)
    folder = scratch_path(spark, "warc")
    warc.write_archives(pages, folder, least, class_bytes=40, file_bytes=200)
    found = warc.read_archives(spark, folder, range_bytes, with_payload=True)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, found.select(columns).collect()), key=str) == expected(PAGES, least)
    payloads = {(r["page_id"], r["payload"].decode()) for r in found.where("record_type = 'response'").collect()}
    assert payloads <= {(i, h or "") for i, _, h in PAGES}


@pytest.mark.parametrize("range_bytes", [5_000, warc.RANGE_BYTES])
def test_long_urls(spark, range_bytes):
    """A page whose url fills more than 64 KB of the header, first, between ordinary pages, and as a revisit."""
    long = "http://a/?q=" + "x: y WARC/1.1" * 16_000
    rows = [(1, long, "<p>first"), (2, "http://a/2", "<p>two"), (3, long + "\r\n\r\nWARC/1.1\r\n", TRAP), (4, "u", "<p>four"),
            (5, "é" * 70_000, "<p>two"), (6, long, "<p>first"), (7, "u", "<p>seven")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    folder = scratch_path(spark, "warc")
    warc.write_archives(pages, folder)
    found = warc.read_archives(spark, folder, range_bytes)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, found.select(columns).collect()), key=str) == expected(rows, 0)


def test_files_are_bounded_by_bytes(spark):
    """Many large pages and many small ones: no file holds much more than asked for."""
    rows = [(i, f"http://a/{i}", f"{i:09d}" * (9_000 if i % 7 == 0 else 3)) for i in range(400)]
    rows += [(1000, "u" * 90_000, "<p>long url"), (1001, "u", "z" * 1_500_000), (1002, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    folder = scratch_path(spark, "warc")
    warc.write_archives(pages, folder, class_bytes=1_000, file_bytes=2_000_000)
    files = spark.read.format("binaryFile").load(folder).select("path", "length").collect()
    assert sum(r["length"] for r in files) > 6_000_000
    assert max(r["length"] for r in files) < 2_000_000
    assert len(files) < 20
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found = warc.read_archives(spark, folder).select(columns).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows, 0)


def test_headers_are_read_once():
    """Many magics and line ends without a record cost no more than their bytes."""
    content = (warc.MAGIC * 200_000) + b"\r\n\r\n" + warc.MAGIC * 200_000
    assert list(warc.candidates("f", content, warc.RANGE_BYTES, False)) == []


def test_candidates_hold_the_traps():
    content = TRAP.encode()
    found = [r for part in warc.candidates("f", content * 3, 40, False) for r in part]
    assert [r["offset"] for r in found] == [0, len(content), 2 * len(content)]
    assert warc.parse_record(content[:-1], 0, False) is None


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc")
    warc.write_archives(pages, folder)
    assert warc.read_archives(spark, folder).collect() == []


def test_whole_table(spark):
    from scopewise.llm.queries import RUN

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, RUN["op7_warc"](spark, sf).collect()), key=str) == expected(rows, 0)
