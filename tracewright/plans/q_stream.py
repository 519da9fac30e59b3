"""Streaming query: incremental ingestion must equal the batch replay."""

from __future__ import annotations

from tracewright.plans import q_ingest
from tracewright.plans.registry import ORACLES, query
from tracewright.sources import bindings as B
from tracewright.streaming.incremental import EVENT_COLS, replay_incremental


@query("incremental_ingest", ORACLES["accepted_events"])
def incremental_ingest(spark, sf):
    """Submissions streamed in six epochs of about equally many rows, each against
    the state index of the ones before it; the stored events equal the batch
    fold's accepted events."""
    return replay_incremental(spark, B.tel_submissions(spark, sf), B.tel_traces(spark, sf)).select(*EVENT_COLS)


_ = q_ingest  # the oracle is shared with accepted_events
