"""Uploads as bytes (S4): files of any content, one blob per file.

A file is one row with BINARY content, as an upload is one request; files that Spark's reader cannot hold in a row (2 GB) are
refused by it, and empty files are passed by. Nothing here decodes: hashing, length, the text gate and truncation work on bytes, and only previews
decode, with replacement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators.blobs import blob_rows
from tracewright.operators.packet import preview

# Content types by file extension; others have the default type.
TYPES = {"txt": "text/plain", "log": "text/plain", "json": "application/json", "diff": "text/x-diff", "patch": "text/x-diff", "png": "image/png", "gz": "application/gzip"}


def uploads(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(source_key, content_type, created_at_ms, content) of the files under ``path`` and its folders; the source key is the file's path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    extension = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    known = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])
    return files.select(F.col("path").alias("source_key"), F.try_element_at(known, extension).alias("content_type"),
                        F.unix_millis("modificationTime").alias("created_at_ms"), "content")


def binary_blobs(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """The files as blob rows, content kept as bytes."""
    return blob_rows(uploads(spark, path, glob))


def decoded_preview(content: str, n: int) -> Column:
    """The first ``n`` code points of BINARY column ``content``, undecodable bytes replaced. At most four bytes of content
    per code point are decoded, so a preview of a large blob costs no more than one of a small blob."""
    head = F.substring(F.col(content), 1, 4 * (n + 1) + 4)
    return preview(F.make_valid_utf8(head.cast("string")), n)
