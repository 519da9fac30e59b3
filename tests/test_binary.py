"""Uploads as bytes: files that are no text, large files, previews."""

import hashlib


from tracewright.operators.redact import redact
from tracewright.schemas import MAX_BLOB_BYTES
from tracewright.sources.binary import binary_blobs, decoded_preview


def test_files_become_blobs(spark, tmp_path):
    files = {"a.txt": "mail me: x@example.org é".encode(), "b.bin": bytes(range(256)) * 3, "sub/c.LOG": b"\n", "empty.txt": b"", "big.dat": b"password=hunter2hunter2 " * 60_000 + b"\xfe",
             "text.json": b'{"token": "abcdefgh12345678"}', "cut.txt": "é".encode() * (MAX_BLOB_BYTES // 2 + 1)}
    for name, data in files.items():
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(data)
    rows = {r.source_key.split(str(tmp_path) + "/")[1]: r for r in redact(binary_blobs(spark, str(tmp_path)), "content").collect()}
    assert set(rows) == set(files) - {"empty.txt"}  # Spark's reader passes empty files by
    files.pop("empty.txt")
    for name, data in files.items():
        r = rows[name]
        assert r.blob_id == "sha256:" + hashlib.sha256(data).hexdigest() and r.byte_length == len(data) == r.r_original_length and bytes(r.content) == data
        assert r.storage_uri.endswith(f"/{r.shard}/{r.blob_id[7:]}")
    assert {n: r.content_type for n, r in rows.items()} == {"a.txt": "text/plain", "b.bin": "application/octet-stream", "sub/c.LOG": "text/plain", "big.dat": "application/octet-stream",
                                                             "text.json": "application/json", "cut.txt": "text/plain"}
    assert bytes(rows["a.txt"].r_content) == "mail me: [EMAIL_REDACTED] é".encode() and bytes(rows["b.bin"].r_content) == files["b.bin"]
    assert bytes(rows["big.dat"].r_content) == files["big.dat"][:MAX_BLOB_BYTES] and rows["big.dat"].r_rules_applied == ["truncate_large"]  # no text: secrets are not looked for
    assert bytes(rows["cut.txt"].r_content) == files["cut.txt"][:MAX_BLOB_BYTES] and rows["cut.txt"].r_was_truncated
    assert rows["text.json"].r_rules_applied in ([], ["secret_scan"]) and rows["sub/c.LOG"].r_was_modified is False


def test_previews_decode_as_python_does(spark):
    """Whatever the bytes: cut by code points after decoding with replacement."""
    import random
    r = random.Random(4)
    data = [b"", b"abc", b"\xff" * 30, "é".encode() * 10, "😀".encode() * 12, "😀".encode()[:3] * 20, b"\xe2\x82" * 15] + [
        bytes(r.choice([0x41, 0xC3, 0xA9, 0xF0, 0x9F, 0x98, 0x80, 0xE2, 0xED, 0xA0]) for _ in range(r.randint(0, 60))) for _ in range(200)]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(data)], "i int, content binary")
    got = {x.i: x.p for x in df.select("i", decoded_preview("content", 9).alias("p")).collect()}
    for i, b in enumerate(data):
        t = b.decode("utf-8", "replace")
        assert got[i] == (t[:9] + "..." if len(t) > 9 else t), b
