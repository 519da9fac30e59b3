"""Content addressing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewright.schemas import BLOB_ID_PREFIX


def sha256_hex(col: Column) -> Column:
    """Hex SHA-256 of the UTF-8 bytes (strings) or raw bytes (binary)."""
    return F.sha2(col.cast("binary"), 256)


def content_address(col: Column) -> Column:
    """``sha256:<hex>``; the id ignores the content type."""
    return F.concat(F.lit(BLOB_ID_PREFIX), sha256_hex(col))


def shard_of(blob_id: Column) -> Column:
    """The two leading hex characters of the hash."""
    return F.substring(blob_id, len(BLOB_ID_PREFIX) + 1, 2)


def parse_blob_id(blob_id: Column) -> Column:
    """Hex part of a ``sha256:`` id; NULL when the prefix is missing."""
    return F.when(blob_id.startswith(BLOB_ID_PREFIX),
                  F.substring(blob_id, len(BLOB_ID_PREFIX) + 1, 1 << 30))


def storage_uri(blob_id: Column, root: str) -> Column:
    """``file://{root}/sha256/{hh}/{hash}`` (root is a plan-time parameter)."""
    hexpart = parse_blob_id(blob_id)
    return F.concat(F.lit(f"file://{root.rstrip('/')}/sha256/"), F.substring(hexpart, 1, 2), F.lit("/"), hexpart)


def byte_length(col: Column) -> Column:
    """P5: number of bytes."""
    return F.octet_length(col.cast("binary")).cast("long")
