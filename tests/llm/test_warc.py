import hashlib
from collections import Counter

import pytest

from marquee.llm.common import shared_folder
from marquee.llm.warc import read_archives, round_trip, write_archives

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: {n}\r\n\r\n"


def expected(rows):
    owner = {}
    for i, _, h in rows:
        if i is not None:
            owner[h or ""] = max(owner.get(h or "", i), i)
    count = Counter(h or "" for _, _, h in rows)
    out = Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        again = len(b) >= 1000 and count[h or ""] > 1 and owner.get(h or "") is not None and owner[h or ""] != i
        out[(i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", owner[h or ""] if again else None)] += 1
    return out


def got(df):
    return Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["type"], r["refers_to"]) for r in df.collect())


ROWS = [
    (1, "http://a/\r\nX: y", None), (2, None, ""), (3, "http://b/", "<p>é 你好</p>"), (None, None, "no id"), (5, "u", "x" * 2000), (7, "u", "x" * 2000), (6, "u", "x" * 2000),
    (8, "u", "y" * 999), (9, "u", "y" * 999), (10, "u", "WARC/1.0 and WARC/1.1\r\n WARC/1."), (11, "u", FAKE.format(n=5) + "abcde\r\n\r\n" + FAKE.format(n=10**6) + "tail"),
    (12, "u", "\r\n\r\n" + FAKE.format(n=0) + "\r\n\r\n"), (13, "u", "a\r\n\r\nb\r\n\r\n"), (3, "http://b/", "<p>é 你好</p>"),
]


@pytest.mark.parametrize("split", ["128m", "700b", "97b"])
def test_round_trip_with_magic_in_payloads(spark, split):
    pages = spark.createDataFrame([(*r, 1, "c") for r in ROWS], "page_id long, url string, html string, type int, path string").coalesce(2)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    folder = shared_folder(spark, "test-warc")
    write_archives(pages, folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert got(read_archives(spark, folder)) == expected(ROWS)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_long_payload_of_magic(spark):
    rows = [(i, "u", (FAKE.format(n=17) + "WARC/1.1\r\n") * 300 + str(i % 3)) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000b")
    try:
        assert got(round_trip(pages)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_empty(spark):
    assert round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_many_false_headers_take_little_memory():
    """8000 candidates inside one payload, each with a length beyond the end of the page."""
    import tracemalloc

    from marquee.llm.warc import MAGIC, _Split

    payload = (FAKE.format(n=10**6) + "some text of the page\r\n\r\n") * 8000
    record = f"{MAGIC}1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:5>\r\nContent-Length: {len(payload) + 4}\r\n\r\n\r\n\r\n{payload}\r\n\r\n"
    tracemalloc.start()
    split = _Split("p", 0, len(record))
    for piece in record.encode().split(MAGIC.encode()):
        split.add(piece)
    rows = list(split.rows())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20, peak
    first = min((r for r in rows if "at" in r), key=lambda r: r["at"])
    assert first["complete"] and first["payload_digest"] == hashlib.sha1(payload.encode()).hexdigest() and len(rows) == 8002
