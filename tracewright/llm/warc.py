"""WARC archives: writing with payload revisits, and reading by boundary-chain verification.

Writing. A record per row: a response holds an HTTP header and the payload, a revisit the HTTP header alone and the id of
the response with an equal payload. Spark's text writer lays the records one after another, a file per task.

Reading. A payload may hold anything, the magic ``WARC/1.1`` or whole records included, so a magic alone is no boundary.

1. Spark's text reader splits the files at the magic, large uncompressed files in ranges over many tasks. Each segment
   begins a candidate record, whose header gives the offset of its successor. The segments are written once: later
   steps read that table, so splits cannot change between steps.
2. Inside a split, candidates point to candidates; pointer jumping in numpy gives each one the first offset that its
   chain reaches outside the split.
3. Across splits, pointer jumping from offset 0 of each file by joins on (file, offset): the number of rounds is the
   logarithm of a file's splits. A split is entered at one offset at most.
4. From its entry each split marks the records of the chain. Other candidates lie inside payloads, or behind a break of the
   chain, and are rejected: the former go back into the payload of the record that holds them.

A file that nothing splits (compressed, or small) is one split, and step 3 ends after one round.

Defined cases: a null payload is empty; a null id is written as none and reads as null, and ranks behind all others when the
least id of a payload is sought (if all are null, all are responses); rows that repeat the least id are responses each. Control characters
and spaces of a url are percent-encoded, a null url leaves the field out. A record is as long as its payload and stands in
one task whole. Records behind a break of a file's chain, and a record cut off by the file's end, are not returned; a file that
does not begin with the magic has no records. An empty table gives no archive records and an empty result. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.llm.common import saved
from tracewright.llm.skew import attach
from tracewright.session import scratch_path

MAGIC = b"WARC/1.1\r\n"
M = len(MAGIC)
REVISIT_BYTES = 100  # least payload that a revisit stands for
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uri(ident: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(ident.cast("string"), F.lit("")), F.lit(">"))


def _encoded(url: Column) -> Column:
    """The url with controls, spaces and DEL percent-encoded, so that it stays on its line."""
    out = F.replace(url, F.lit("%"), F.lit("%25"))
    for c in [*range(0x21), 0x7F]:
        out = F.replace(out, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    return F.when(url.rlike("[\\x00-\\x20\\x7F]"), out).otherwise(url)


def planned(df: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(id, url, payload, digest, refers): refers is the id of the response that a revisit stands for, else null."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn(
        "key", F.when(F.octet_length("payload") >= REVISIT_BYTES, F.col("digest")))
    groups = rows.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    shared = saved(groups.where("n > 1"), "warc-shared")
    other = ~F.col("id").eqNullSafe(F.col("least"))
    return attach(rows, shared, "key", F.xxhash64("id", "digest")).select(
        "id", "url", "payload", "digest", F.when(F.col("least").isNotNull() & other, F.col("least")).alias("refers"))


def _record(date: str) -> Column:
    """The bytes of a record but for the last line feed, which the writer adds."""
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    n = F.octet_length("payload").cast("string")
    http = text("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ", n, "\r\n\r\n")
    revisit = F.col("refers").isNotNull()
    length = (F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.octet_length("payload"))).cast("string")
    head = text("WARC/1.1\r\nWARC-Type: ", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
                "\r\nWARC-Record-ID: ", _uri(F.col("id")), f"\r\nWARC-Date: {date}",
                F.coalesce(text("\r\nWARC-Target-URI: ", _encoded(F.col("url"))), F.lit("")),
                "\r\nWARC-Payload-Digest: sha256:", F.col("digest"),
                F.when(revisit, text(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: ", _uri(F.col("refers")))).otherwise(F.lit("")),
                "\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: ", length, "\r\n\r\n", http)
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    return F.concat(head.cast("binary"), body, F.lit(b"\r\n\r")).cast("string")


def write_warc(df: DataFrame, out_path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               compression: str = "gzip", date: str = "2000-01-01T00:00:00Z") -> str:
    """A record per row under ``out_path``. ``compression``: gzip as archives are kept, or none, whose files split. Returns ``out_path``."""
    planned(df, id_col, url_col, payload_col).select(_record(date).alias("value")).write.option("compression", compression).text(out_path)
    return out_path


def parse_header(record: bytes) -> tuple[dict[str, str], int] | None:
    """Fields (names in lower case) of a record whose magic is cut off, and where its block begins; None if no header ends."""
    end = record.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in record[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            fields.setdefault(name.strip().lower().decode("utf-8", "replace"), value.strip().decode("utf-8", "replace"))
    return fields, end + 4


def _span(segment: bytes) -> int:
    """Bytes from a candidate's magic to its successor; -1 without a header or a length."""
    got = parse_header(segment)
    length = got[0].get("content-length", "") if got else ""
    return M + got[1] + int(length) + 4 if got and length.isascii() and length.isdigit() and len(length) < 16 else -1


_SEGMENT = "file string, split long, idx long, at long, size long, span long, body binary"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the text reader in order: each one's place in its split and the span that its header states."""
    now, idx, at = None, 0, 0
    for b in batches:
        files, splits, body = (b.column(i) for i in range(3))
        out: list[list] = [[], [], [], []]
        for file, split, x in zip(files.to_pylist(), splits.to_pylist(), body):
            if (file, split) != now:
                now, idx, at = (file, split), 0, 0
            raw = x.as_buffer()
            size = raw.size if raw is not None else 0
            for col, v in zip(out, (idx, at, size, _span(raw.to_pybytes() if size else b""))):
                col.append(v)
            idx, at = idx + 1, at + size + M
        yield pa.RecordBatch.from_arrays([files, splits, *(pa.array(c, pa.int64()) for c in out), body], ["file", "split", "idx", "at", "size", "span", "body"])


def _exits(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each candidate of a split (offsets ascending, -1: no successor) where its chain leaves the split, and the chain's last candidate."""
    n = len(start)
    to = np.minimum(np.searchsorted(start, stop), n - 1)
    to = np.where((start[to] == stop) & (stop > start), to, np.arange(n))
    while (to[to] != to).any():
        to = to[to]
    return stop[to], start[to]


def _contract(t: pa.Table) -> pa.Table:
    order = np.argsort(t.column("start").to_numpy())
    start, stop = (t.column(c).to_numpy()[order] for c in ("start", "stop"))
    out, last = _exits(start, stop)
    return pa.table({"file": t.column("file"), "split": t.column("split"), "start": start, "leaves": out, "last": last})


def _verdicts(t: pa.Table) -> pa.Table:
    """A split's segments to the record that holds each: its offset and end; segments of no record go."""
    t = t.take(pa.array(np.argsort(t.column("idx").to_numpy())))
    start, stop = (t.column(c).to_numpy() for c in ("start", "stop"))
    entry, before, until = (t.column(c)[0].as_py() for c in ("entry", "last_before", "leaves_before"))
    record, end = np.full(len(start), -1, dtype=np.int64), np.full(len(start), -1, dtype=np.int64)
    if before is not None:
        inside = start < until
        record[inside], end[inside] = before, until
    i = int(np.searchsorted(start, entry)) if entry is not None else len(start)
    while i < len(start) and stop[i] > start[i]:
        j = int(np.searchsorted(start, stop[i]))
        record[i:j], end[i:j] = start[i], stop[i]
        if j < len(start) and start[j] != stop[i]:
            break
        i = j
    held = np.flatnonzero((record >= 0) & (end <= t.column("eof").to_numpy()))
    whole = (record == start) & (end <= t.column("seg_end").to_numpy())
    return pa.table({"file": t.column("file"), "split": t.column("split"), "idx": t.column("idx"), "start": start, "record": record,
                     "end": end, "whole": whole}).take(pa.array(held))


def _joined(t: pa.Table) -> pa.Table:
    """The segments of a record to its bytes without the first magic: magics between them belong to the payload."""
    t = t.take(pa.array(np.argsort(t.column("start").to_numpy())))
    body = MAGIC.join(t.column("body").to_pylist())
    return pa.table({"file": t.column("file").slice(0, 1), "record": t.column("record").slice(0, 1), "end": t.column("end").slice(0, 1),
                     "body": pa.array([body], pa.binary())})


RECORD = ("file string, offset long, record_type string, record_id string, refers_to string, target_uri string, payload_digest string, "
          "http_length long, payload binary")


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri", "warc-payload-digest"]
    for b in batches:
        fields: list[list] = [[] for _ in names]
        lengths, payloads = [], []
        for start, end, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
            raw = x.as_buffer().to_pybytes()
            head, at = parse_header(raw)
            for col, name in zip(fields, names):
                col.append(head.get(name))
            block = raw[at:end - start - M - 4]
            length = None
            if head.get("content-type", "").startswith("application/http"):
                http = parse_header(block)
                if http:
                    stated = http[0].get("content-length", "")
                    length = int(stated) if stated.isascii() and stated.isdigit() else None
                    block = block[http[1]:]
            lengths.append(length)
            payloads.append(block)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, pa.string()) for c in fields), pa.array(lengths, pa.int64()),
                                          pa.array(payloads, pa.binary())], [f.split()[0] for f in RECORD.split(", ")])


def reachable(nodes: DataFrame) -> DataFrame:
    """Pointer jumping: of nodes (file, split, start, leaves, last) those that the chain from offset 0 of their file enters."""
    targets = nodes.select("file", F.col("leaves").alias("start")).distinct()
    links = saved(nodes.join(targets, ["file", "start"], "left_semi").unionByName(nodes.where("start = 0")).dropDuplicates(["file", "start"]), "warc-links")
    jumps = links.select("file", "start", "leaves")
    reached = saved(links.where("start = 0").select("file", "start"), "warc-reached")
    while True:
        ahead = reached.join(jumps, ["file", "start"]).select("file", F.col("leaves").alias("start"))
        new = saved(ahead.join(links, ["file", "start"], "left_semi").join(reached, ["file", "start"], "left_anti"), "warc-new")
        if new.isEmpty():
            return reached.join(links, ["file", "start"])
        reached = reached.unionByName(new)
        onward = jumps.select("file", F.col("start").alias("leaves"), F.col("leaves").alias("beyond"))
        jumps = saved(jumps.join(onward, ["file", "leaves"], "left").select("file", "start", F.coalesce("beyond", "leaves").alias("leaves")), "warc-jumps")


def _stored(segments: DataFrame) -> DataFrame:
    """The one table that holds payloads, packed by zstd."""
    spark = segments.sparkSession
    path = scratch_path(spark, f"llm/warc-segments-{uuid.uuid4().hex}")
    segments.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(segments.schema).parquet(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under ``path``: RECORD. A revisit has an empty payload; ``http_length`` is the length that its HTTP header states."""
    text = spark.read.option("lineSep", MAGIC.decode()).text(path)
    segments = _stored(text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                                   F.col("value").cast("binary").alias("body")).mapInArrow(_segments, _SEGMENT))
    narrow = segments.drop("body")
    sizes = narrow.groupBy("file", "split").agg(F.sum(F.col("size") + M).alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("file")
    splits = saved(sizes.select("file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"),
                                (F.sum("bytes").over(every) - M).alias("eof")), "warc-splits")
    start = F.col("base") + F.col("at") - M
    first = (F.col("split") == 0) & (F.col("idx") == 0)  # what stands before the first magic is no candidate
    placed = narrow.join(splits, ["file", "split"]).where(~first).select(
        "file", "split", "idx", start.alias("start"), (start + M + F.col("size")).alias("seg_end"), "eof",
        F.when(F.col("span") > 0, start + F.col("span")).otherwise(F.lit(-1)).alias("stop"))
    nodes = saved(placed.groupBy("file", "split").applyInArrow(_contract, "file string, split long, start long, leaves long, last long"), "warc-nodes")
    entered = reachable(nodes).select("file", "split", F.col("start").alias("entry"), "leaves", "last")
    of_split = splits.select("file", "split").join(entered, ["file", "split"], "left")
    of_split = of_split.withColumn("was", F.last(F.when(F.col("entry").isNotNull(), F.struct("last", "leaves")), True).over(before)).select(
        "file", "split", "entry", F.col("was.last").alias("last_before"), F.col("was.leaves").alias("leaves_before"))
    held = placed.join(of_split, ["file", "split"]).groupBy("file", "split").applyInArrow(
        _verdicts, "file string, split long, idx long, start long, record long, end long, whole boolean")
    rows = saved(held, "warc-held").join(segments.select("file", "split", "idx", "body"), ["file", "split", "idx"])
    single = rows.where("whole").select("file", "record", "end", "body")
    several = rows.where("not whole").select("file", "record", "end", "start", "body").groupBy("file", "record").applyInArrow(
        _joined, "file string, record long, end long, body binary")
    return single.unionByName(several).mapInArrow(_parsed, RECORD)


def warc_round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write to a fresh folder under the shared checkpoint folder and read the archives back."""
    spark = df.sparkSession
    return read_warc(spark, write_warc(df, scratch_path(spark, f"llm/warc-{uuid.uuid4().hex}"), id_col, url_col, payload_col))


def page_records(records: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to, digest_holds) per record; a revisit's figures are those that its
    headers state of the full payload, a response's are taken from the payload that was read. ``digest_holds``: it has the digest stated, null for revisits."""
    ident = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    page = lambda c: F.when(ident(c) != "", ident(c)).cast("long")
    revisit = F.col("record_type") == "revisit"
    stated = F.regexp_replace("payload_digest", "^sha256:", "")
    digest = F.sha2("payload", 256)
    return records.select(
        page("record_id").alias(id_col), F.when(revisit, F.col("http_length")).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.when(revisit, stated).otherwise(digest).alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"),
        F.when(~revisit, digest == stated).alias("digest_holds"))
