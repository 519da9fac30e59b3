"""JSON-lines sources: quarantine, batch and stream."""

import json

from tracewright.operators.ingest import typed_events
from tracewright.sources import jsonlines as J

EVENT = '{"event_id":"e1","seq":3000000000,"ts_ms":1e300,"type":"commit","zz":1,"aa":2,"actor":{"kind":"human","id":"h"},"payload":{"z":1,"a":[1,2.5]}}'
GOOD = ['{"trace_id":"t1","batch_no":0,"events":[' + EVENT + "," + EVENT.replace("e1", "e2") + '],"more":{"x":[1]}}', '  {"trace_id":"t2","batch_no":1,"events":[]}  ',
        '{"trace_id":"né","batch_no":2,"events":["text",5]}']
BAD = {'{"trace_id":"t1","batch_no":3,"events":[{"a":': "malformed", "[1,2]": "not an object", "plain": "not an object", '"text"': "not an object",
       '{"batch_no":1,"events":[]}': "missing trace_id", '{"trace_id":null,"batch_no":1,"events":[]}': "missing trace_id", '{"trace_id":"t","events":[]}': "missing batch_no",
       '{"trace_id":"t","batch_no":1}': "missing events", '{"trace_id":"t","batch_no":"x","events":[]}': "malformed", '{"trace_id":"t","batch_no":99999999999,"events":[]}': "malformed",
       '{"trace_id":"t","batch_no":1,"events":{}}': "malformed", "{": "malformed", "{}": "missing trace_id"}


def test_lines_are_requests_or_quarantined(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join([*GOOD, "", "   ", *BAD]) + "\n")
    found = J.parsed(J.lines(spark, str(tmp_path)), "submissions")
    assert {r.line.strip(): r.reason for r in J.quarantined(found).collect()} == BAD
    got = {r.trace_id: r.events for r in J.requests(found, "submissions").collect()}
    assert got["t2"] == [] and got["né"] == ["text", "5"] and [json.loads(e) for e in got["t1"]] == [json.loads(EVENT), json.loads(EVENT.replace("e1", "e2"))]
    events = J.submitted_events(J.requests(found, "submissions"))
    t = {(r.trace_id, r.pos): r for r in typed_events(events).collect()}
    assert (t["t1", 0].event_id, t["t1", 0].seq, t["t1", 0].ts_ms, t["t1", 0].actor_id) == ("e1", 3_000_000_000, None, "h")
    assert len(t) == 4 and t["né", 1].seq is None


def test_other_kinds(spark, tmp_path):
    (tmp_path / "a").write_text('{"trace_id":"t","created_at_ms":5,"body":{"repo":{"b":1,"a":2}}}\n{"trace_id":"t","body":7}\n{"trace_id":"u"}\n')
    found = J.parsed(J.lines(spark, str(tmp_path)), "traces")
    assert sorted((r.created_at_ms or 0, r.body) for r in J.requests(found, "traces").collect()) == [(0, "7"), (5, '{"repo":{"b":1,"a":2}}')]
    assert [r.reason for r in J.quarantined(found).collect()] == ["missing body"]
    (tmp_path / "a").write_text('{"trace_id":"t","model":"m","response_text":"{}"}\n{"trace_id":"t","response_text":null}\n')
    found = J.parsed(J.lines(spark, str(tmp_path)), "responses")
    assert J.requests(found, "responses").count() == 1 and J.quarantined(found).count() == 1


def test_the_stream_takes_new_files_only_and_agrees_with_the_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    half = list(BAD)[:6]
    (source / "a.jsonl").write_text("\n".join([GOOD[0], *half]))
    good, bad = J.run_lines(spark, str(source), out, "submissions")
    J.run_lines(spark, str(source), out, "submissions")  # nothing new
    (source / "b.jsonl").write_text("\n".join([*GOOD[1:], *list(BAD)[6:]]))
    J.run_lines(spark, str(source), out, "submissions")
    batch = J.parsed(J.lines(spark, str(source)), "submissions")
    assert sorted(map(str, spark.read.parquet(good).select("trace_id", "batch_no", "events").collect())) == sorted(map(str, J.requests(batch, "submissions").collect()))
    assert sorted(r.line for r in spark.read.parquet(bad).collect()) == sorted(r.line for r in J.quarantined(batch).collect())
    assert {r.epoch for r in spark.read.parquet(good).collect()} == {0, 1}
