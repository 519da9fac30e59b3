"""Packet line rendering traps: key-absent defaults, explicit null, Python
literals, dangling / empty blobs, code-point previews, message cuts."""

import json

from tracewright.operators.packet import blob_previews, event_lines


def _lines(spark, events, blobs):
    ev = spark.createDataFrame(
        [("t", i + 1, 1000 + i, typ, json.dumps(p)) for i, (typ, p) in enumerate(events)],
        "trace_id string, seq int, ts_ms long, type string, payload_json string")
    bl = spark.createDataFrame(blobs, "blob_id string, content string")
    refs = spark.createDataFrame([(b,) for b, _ in blobs] + [("sha256:missing",)], "blob_id string")
    return {r.seq: r.line for r in event_lines(ev, blob_previews(bl, refs)).collect()}


def test_event_lines(spark):
    long_text = "é" * 600
    events = [
        ("file_edit", {}),                                                     # every key absent
        ("file_edit", {"file_path": None, "edit_kind": "patch"}),              # explicit null
        ("test_run", {"command": "pytest", "exit_code": 1, "passed": True, "duration_ms": 12}),
        ("thought", {"content_blob_id": "sha256:missing", "kind": "plan"}),    # dangling blob
        ("thought", {"content_blob_id": "sha256:long", "kind": "plan"}),       # preview cut at 500 code points
        ("terminal_output", {"stream": "stdout", "chunk_blob_id": "sha256:empty"}),  # empty content -> fallback
        ("commit", {"commit_sha": "0123456789abcdef", "message": "m" * 150}),
        ("navigation", {"file_path": "x"}),                                    # not rendered
        ("error", {"error_type": "ValueError"}),
    ]
    got = _lines(spark, events, [("sha256:long", long_text), ("sha256:empty", "")])
    assert got[1] == "[seq=1, ts=1000] **file_edit**: `N/A` (N/A)"
    assert got[2] == "[seq=2, ts=1001] **file_edit**: `None` (patch)"
    assert got[3] == "[seq=3, ts=1002] **test_run**: `pytest` (exit_code=1, passed=True, duration=12ms)"
    assert got[4] == "[seq=4, ts=1003] **thought** (plan): [blob: sha256:missing]"
    assert got[5] == "[seq=5, ts=1004] **thought** (plan): " + "é" * 500 + "..."
    assert got[6] == "[seq=6, ts=1005] **terminal_output** (stdout): [truncated=False]"
    assert got[7] == "[seq=7, ts=1006] **commit**: 0123456789ab - " + "m" * 100
    assert 8 not in got
    assert got[9] == "[seq=9, ts=1008] **error**: ValueError: "


def test_lines_without_a_blob_do_not_meet_in_one_task(spark):
    """They have no key to join by; a shuffle by the null key would gather them all."""
    n = 4000
    events = spark.range(n, numPartitions=8).selectExpr(
        "concat('t', id % 7) as trace_id", "cast(id as int) as seq", "id as ts_ms",
        "case when id % 4 = 0 then 'thought' when id % 4 = 1 then 'terminal_output' when id % 4 = 2 then 'commit' else 'error' end as type",
        "case when id % 4 = 0 and id % 8 = 0 then concat('{\"kind\":\"plan\",\"content_blob_id\":\"b', id % 50, '\"}') when id % 4 = 1 then '{\"chunk_blob_id\":null}' else '{}' end as payload_json")
    previews = spark.range(40).selectExpr("concat('b', id) as blob_id", "concat('long ', id) as p500", "concat('short ', id) as p200")
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    was = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in zip(names, ("false", "-1")):
            spark.conf.set(k, v)
        got = event_lines(events, previews).selectExpr("*", "spark_partition_id() as part").collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert sorted(r.seq for r in got) == list(range(n))
    parts = {}
    for r in got:
        b = r.seq % 50
        want = {0: ("(plan): " + (f"long {b}" if b < 40 else f"[blob: b{b}]")) if r.seq % 8 == 0 else "(N/A): [blob: ]",
                1: "(N/A): [truncated=False]", 2: "N/A - ", 3: "N/A: "}[r.seq % 4]
        assert r.line.startswith(f"[seq={r.seq}, ts={r.seq}] **") and r.line.endswith(want)
        if r.seq % 8:
            parts[r.part] = parts.get(r.part, 0) + 1
    assert len(parts) == 8 and max(parts.values()) < 2 * sum(parts.values()) / 8
