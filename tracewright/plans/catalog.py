"""Imports every query module so the registry is complete."""

from tracewright.plans import (  # noqa: F401
    q_blobs, q_ingest, q_judge, q_lifecycle, q_model, q_packet, q_redact, q_stream, q_timeline, q_validate,
)
from tracewright.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
