"""WARC round trips against the rows that were written, with payloads that look like archives."""

import gzip
import hashlib
import random

import numpy as np
import pytest

from tracewright.llm import warc as A

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    least = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 100 and i is not None:
            least[h] = min(least.get(h, i), i)
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        refers = least.get(h)
        refers = None if refers == i else refers
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def fake(payload, length=None):
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: {len(payload) if length is None else length}\r\n\r\n{payload}\r\n\r\n"


def pages(seed, n=120):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcé中\r\n <>/") for _ in range(r.randint(1, 12)))
    prose = lambda k: " ".join(word() for _ in range(k))
    hot = "hot " + prose(60)
    html = [None, "", "x" * 99, "x" * 100, "x" * 99, "x" * 100, "WARC/1.1\r\n", "WARC/1.1\r\n" * 40, fake("inner"), fake("a") + fake("b") + fake("c" * 200),
            "\r\n\r\n" + fake(""), fake("x", 5000), fake("x", 10**14), fake(fake(fake("deep"))), "WARC/1.1\r\nContent-Length: 0", "WARC/1.1\r", "W" * 7 + "WARC/1.1\r\nContent-Length: -3\r\n\r\n"]
    for _ in range(n):
        html.append(r.choice([prose(r.randint(0, 60)), hot, prose(5) + fake(prose(20)) + prose(3), fake(prose(30), r.randint(0, 400)) * r.randint(1, 4)]))
    rows = [(i * 37 % 1009 - 5, r.choice([None, "http://a.org/x", "http://b.org/ä b\r\nWARC/1.1\r\n%"]), h) for i, h in enumerate(html)]
    return rows + [(None, "u", hot), (None, "u", "y" * 200), rows[25], rows[25], (rows[3][0], "u", hot)]


def got(records):
    t = A.page_records(records).collect()
    assert all(x.digest_holds is not False for x in t)
    return sorted((tuple(x)[:5] for x in t), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_round_trip(spark, seed):
    rows = pages(seed)
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame([(*r, "mine", 3) for r in rows], SCHEMA + ", payload string, key int").repartition(3)
    assert got(A.warc_round_trip(df)) == brute(rows)


@pytest.mark.parametrize("split", [150, 1500])
def test_files_split_over_many_tasks(spark, tmp_path, split):
    """Uncompressed files in ranges of few bytes: chains run over many splits, records over several."""
    rows = pages(3, 15) + [(5000, "long", "long text " * 300 + fake("y" * 200) * 5)]
    A.write_warc(spark.createDataFrame(rows, SCHEMA).coalesce(2), str(tmp_path / "w"), compression="none")
    conf = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        text = spark.read.option("lineSep", A.MAGIC.decode()).text(str(tmp_path / "w"))
        assert text.rdd.getNumPartitions() > 10
        segments = A.read_warc(spark, str(tmp_path / "w"))
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert got(segments) == brute(rows)


def test_breaks_cut_ends_and_foreign_files(spark, tmp_path):
    def record(i, payload, length=None):
        return (f"WARC/1.1\r\nwarc-type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Type: text/html\r\n"
                f"Content-Length: {len(payload) if length is None else length}\r\n\r\n").encode() + payload + b"\r\n\r\n"
    d = tmp_path / "w"
    d.mkdir()
    whole = record(1, b"\xff\xfe raw bytes") + record(2, b"WARC/1.1\r\n\r\n") + record(3, b"")
    (d / "a.warc").write_bytes(whole)
    (d / "b.warc.gz").write_bytes(gzip.compress(record(4, b"four")) + gzip.compress(record(5, b"five")))  # a member per record
    (d / "c.warc").write_bytes(record(6, b"six") + record(7, b"seven", 9999))      # runs past the end
    (d / "d.warc").write_bytes(record(8, b"eight") + record(9, b"nine", 2) + record(10, b"ten"))  # chain breaks at 9
    (d / "e.warc").write_bytes(b"junk" + record(11, b"eleven"))
    (d / "f.warc").write_bytes(b"")
    records = {r.record_id: bytes(r.payload) for r in A.read_warc(spark, str(d)).collect()}
    assert records == {"<urn:page:1>": b"\xff\xfe raw bytes", "<urn:page:2>": b"WARC/1.1\r\n\r\n", "<urn:page:3>": b"", "<urn:page:4>": b"four",
                       "<urn:page:5>": b"five", "<urn:page:6>": b"six", "<urn:page:8>": b"eight", "<urn:page:9>": b"ni"}


def test_urls_stay_on_their_line_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://a/\r\n\r\nx y%\x7f", "p"), (2, "http://a/ä%41", "q"), (3, None, None)], SCHEMA)
    uris = {r.record_id: r.target_uri for r in A.warc_round_trip(df).collect()}
    assert uris == {"<urn:page:1>": "http://a/%0D%0A%0D%0Ax%20y%25%7F", "<urn:page:2>": "http://a/ä%41", "<urn:page:3>": None}
    assert A.warc_round_trip(df.limit(0)).count() == 0


def test_pointer_jumping_inside_a_split():
    start = np.array([0, 10, 20, 30, 40, 50])
    stop = np.array([20, 33, 40, 99, 55, -1])
    leaves, last = A._exits(start, stop)
    assert leaves.tolist() == [55, 33, 55, 99, 55, -1] and last.tolist() == [40, 10, 40, 30, 40, 50]
