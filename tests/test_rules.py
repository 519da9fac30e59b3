"""Validation rule semantics: missing vs null, lax coercion, bounds, enums, nesting."""

import json

import pytest

from pyspark.sql import functions as F

from tracewright.operators.validate import document_violations, payload_violations
from tracewright.schemas import FINALIZE_RULES, JUDGE_RULES, TRACE_CREATE_RULES


def _payload_codes(spark, rows):
    df = spark.createDataFrame([(str(i), t, json.dumps(p) if not isinstance(p, str) else p)
                                for i, (t, p) in enumerate(rows)], "event_id string, type string, payload_json string")
    out = payload_violations(df, ["event_id"]).select("event_id", "field", "code").collect()
    res = {str(i): [] for i in range(len(rows))}
    for r in out:
        res[r.event_id].append((r.field, r.code))
    return [sorted(res[str(i)]) for i in range(len(rows))]


def test_int_lax_coercion(spark):
    base = {"command": "pytest", "runner": "pytest", "passed": True, "duration_ms": 1}
    vals = [5, "5", " 5 ", "5.0", 5.0, True, 5.5, "5.5", "x", None, [1]]
    rows = [("test_run", dict(base, exit_code=v)) for v in vals]
    codes = _payload_codes(spark, rows)
    assert codes[:6] == [[]] * 6
    assert codes[6] == [("exit_code", "int_from_float")]
    assert codes[7] == [("exit_code", "int_parsing")]
    assert codes[8] == [("exit_code", "int_parsing")]
    assert codes[9] == [("exit_code", "int_type")]
    assert codes[10] == [("exit_code", "int_type")]


def test_missing_vs_null_and_defaults(spark):
    rows = [
        ("file_edit", {"file_path": "a", "edit_kind": "patch", "patch_blob_id": "b"}),
        ("file_edit", {"file_path": "a", "edit_kind": "patch"}),                         # missing required
        ("file_edit", {"file_path": None, "edit_kind": "patch", "patch_blob_id": "b"}),  # null in required str
        ("file_edit", {"file_path": "a", "edit_kind": "patch", "patch_blob_id": "b", "pre_hash": None}),  # optional null
        ("file_edit", {"file_path": "a", "edit_kind": "Patch", "patch_blob_id": "b"}),   # enum is case sensitive
        ("pr_metadata", {"title": None}),
        ("file_edit", {"file_path": "a", "edit_kind": "patch", "patch_blob_id": "b", "extra": 1}),  # extra ignored
    ]
    codes = _payload_codes(spark, rows)
    assert codes[0] == []
    assert codes[1] == [("patch_blob_id", "missing")]
    assert codes[2] == [("file_path", "string_type")]
    assert codes[3] == []
    assert codes[4] == [("edit_kind", "enum")]
    assert codes[5] == []
    assert codes[6] == []


def test_bool_bounds_lists_and_selection(spark):
    rows = [
        ("terminal_output", {"stream": "stdout", "chunk_blob_id": "b", "is_truncated": "yes"}),
        ("terminal_output", {"stream": "stdout", "chunk_blob_id": "b", "is_truncated": 2}),
        ("test_run", {"command": "c", "runner": "go test", "exit_code": 0, "duration_ms": -1, "passed": False}),
        ("thought", {"content_blob_id": "b", "kind": "plan", "links_to": ["a", 3]}),
        ("file_edit", {"file_path": "a", "edit_kind": "patch", "patch_blob_id": "b",
                       "selection": {"start": [1, 2], "end": [3]}}),
        ("file_edit", {"file_path": "a", "edit_kind": "patch", "patch_blob_id": "b",
                       "selection": {"start": [1, 2.5], "end": [3, 4]}}),
        ("debug_action", {"action": "step", "details": {"any": [1, 2]}}),
        ("navigation", {"file_path": "f", "line": 5.5}),
    ]
    codes = _payload_codes(spark, rows)
    assert codes[0] == []
    assert codes[1] == [("is_truncated", "bool_parsing")]
    assert codes[2] == [("duration_ms", "greater_than_equal")]
    assert codes[3] == [("links_to.1", "string_type")]
    assert codes[4] == [("selection.end", "too_short")]
    assert codes[5] == [("selection.start.1", "int_from_float")]
    assert codes[6] == []
    assert codes[7] == [("line", "int_from_float")]


def test_numbers_in_strings(spark):
    """Digits may be grouped by single underscores; nothing else may stand between them."""
    base = {"command": "pytest", "runner": "pytest", "passed": True, "duration_ms": 1}
    good, bad = ["1_000", "1_0.00", "-7", "+7", " 7\t", "007"], ["5x", "5x0", "7-", "1__0", "_1", "1_", "4x2", "", "1e3", "0x1"]
    codes = _payload_codes(spark, [("test_run", dict(base, exit_code=v)) for v in good + bad])
    assert codes == [[]] * len(good) + [[("exit_code", "int_parsing")]] * len(bad)
    low = _payload_codes(spark, [("test_run", dict(base, exit_code=0, duration_ms=v)) for v in ("-1_0", "1_0", "-0")])
    assert low == [[("duration_ms", "greater_than_equal")], [], []]


def test_every_bad_element_is_reported(spark):
    edit = {"file_path": "a", "edit_kind": "patch", "patch_blob_id": "b"}
    pair = lambda v: ("file_edit", dict(edit, selection={"start": v, "end": ["1", 2.0]}))
    codes = _payload_codes(spark, [
        ("thought", {"content_blob_id": "b", "kind": "plan", "links_to": [1, "a", None, ["x"]]}),
        ("commit", {"commit_sha": "s", "message": "m", "parent_shas": {"a": 1}}),
        pair(["1", 2]), pair([True, " 2 "]), pair(["x", 2.5]), pair([None, "5x"]), pair(["x"]), pair([1]), pair([]), pair(["x", 1, 2]), pair("12"),
        ("file_edit", dict(edit, selection=7)), ("file_edit", dict(edit, selection=None)), ("debug_action", {"action": "a", "details": 7}),
    ])
    assert codes[0] == [("links_to.0", "string_type"), ("links_to.2", "string_type"), ("links_to.3", "string_type")]
    assert codes[1] == [("parent_shas", "list_type")]
    assert codes[2] == codes[3] == []
    assert codes[4] == [("selection.start.0", "int_parsing"), ("selection.start.1", "int_from_float")]
    assert codes[5] == [("selection.start.0", "int_type"), ("selection.start.1", "int_parsing")]
    assert codes[6] == [("selection.start.0", "int_parsing")]
    assert codes[7] == codes[8] == [("selection.start", "too_short")]
    assert codes[9] == [("selection.start", "too_long")]
    assert codes[10] == [("selection.start", "list_type")]
    assert codes[11] == [("selection", "dict_type")] and codes[12] == [] and codes[13] == [("details", "dict_type")]


def test_messages_name_the_nested_model(spark):
    df = spark.createDataFrame([("a", "file_edit", '{"file_path":"a","edit_kind":"patch","patch_blob_id":"b","selection":7}'),
                                ("b", "debug_action", '{"action":"x","details":7}')], "event_id string, type string, payload_json string")
    got = {r.event_id: r.message for r in payload_violations(df, ["event_id"]).collect()}
    assert got == {"a": "Input should be a valid dictionary or instance of SelectionRange", "b": "Input should be a valid dictionary"}


def _doc_codes(spark, rules, docs):
    df = spark.createDataFrame([(str(i), json.dumps(d) if not isinstance(d, str) else d) for i, d in enumerate(docs)],
                               "k string, doc string")
    out = document_violations(df, ["k"], "doc", rules).collect()
    res = {str(i): [] for i in range(len(docs))}
    for r in out:
        res[r.k].append((r.field, r.code))
    return [sorted(res[str(i)]) for i in range(len(docs))]


def test_trace_create_and_finalize(spark):
    minimal = {"repo": {"repo_id": "r", "commit_base": "c"}, "task": {"bug_report": {"title": "t", "description": "d"}},
               "developer": {"developer_id": "x"}, "environment": {"ide": {"name": "vim"}}}
    no_task = {k: v for k, v in minimal.items() if k != "task"}
    codes = _doc_codes(spark, TRACE_CREATE_RULES, [minimal, no_task])
    assert codes[0] == []
    assert codes[1] == [("task", "missing")]  # children of a missing parent are not reported
    full = json.loads(json.dumps(minimal))
    full["repo"] |= {"remote_url": "u", "default_branch": None, "repo_fingerprint": {"tree_hash": "t", "dependencies_lock_hash": None}}
    full["task"] |= {"task_id": "1", "labels": ["a"]}
    full["task"]["bug_report"] |= {"repro_steps": None, "expected": "e", "actual": "a", "links": ["l"]}
    full["developer"] |= {"experience_level": "mid", "consent_flags": {"store_raw_code": "no", "allow_llm_judge": 1}}
    full["environment"] |= {"os": "linux", "language": [], "containerized": "yes", "timezone": "UTC"}
    full["environment"]["ide"] |= {"version": "1"}
    bad = json.loads(json.dumps(full))
    bad["repo"]["repo_fingerprint"] = {"tree_hash": 1}
    bad["task"]["task_id"] = 1
    bad["task"]["bug_report"] |= {"expected": 1, "actual": [], "links": ["a", 1, 2]}
    bad["developer"]["consent_flags"] = {"store_raw_code": "maybe", "store_terminal_output": None, "allow_llm_judge": 2}
    bad["environment"] |= {"os": 1, "timezone": 1, "ide": {"name": "n", "version": 2}}
    got = _doc_codes(spark, TRACE_CREATE_RULES, [full, bad])
    assert got[0] == []
    assert got[1] == sorted([
        ("repo.repo_fingerprint.tree_hash", "string_type"), ("task.task_id", "string_type"), ("task.bug_report.expected", "string_type"),
        ("task.bug_report.actual", "string_type"), ("task.bug_report.links.1", "string_type"), ("task.bug_report.links.2", "string_type"),
        ("developer.consent_flags.store_raw_code", "bool_parsing"), ("developer.consent_flags.store_terminal_output", "bool_type"),
        ("developer.consent_flags.allow_llm_judge", "bool_parsing"), ("environment.os", "string_type"), ("environment.timezone", "string_type"),
        ("environment.ide.version", "string_type")])
    f = _doc_codes(spark, FINALIZE_RULES, [{"final_state": {"commit_head": "abc"}}, {"final_state": {}}, {}])
    assert f == [[], [], [("final_state", "missing")]]


def test_judge_rules(spark):
    scores = {n: 4.0 for n in ["root_cause_identification", "plan_quality", "experiment_iterate_loop",
                                "use_of_signals_tests_logs", "minimality_of_fix", "clarity"]}
    ok = {"scores": scores, "overall": 3.99, "rationale": "r", "flags": []}
    bad_score = {"scores": dict(scores, clarity=6.0), "overall": 4.0, "rationale": "r"}
    bad_flag = {"scores": scores, "overall": 4.0, "rationale": "r", "flags": ["made_up"]}
    empty_rat = {"scores": scores, "overall": 5.04, "rationale": ""}
    codes = _doc_codes(spark, JUDGE_RULES, [ok, bad_score, bad_flag, empty_rat])
    assert codes[0] == []
    assert codes[1] == [("scores.clarity", "less_than_equal")]
    assert codes[2] == [("flags.0", "enum")]
    assert codes[3] == [("overall", "less_than_equal"), ("rationale", "string_too_short")]


def test_scores_in_strings_never_end_as_null(spark):
    from tracewright.operators.judge import judge_results, parse_responses
    names = ["root_cause_identification", "plan_quality", "experiment_iterate_loop", "use_of_signals_tests_logs", "minimality_of_fix", "clarity"]
    body = lambda v, o=4: json.dumps({"scores": dict({n: 4 for n in names}, clarity=v), "overall": o, "rationale": "r"})
    rows = [(str(i), b) for i, b in enumerate([body("4x2"), body("4.2"), body("0_4"), body("4_2"), body(" 4. "), body(True), body(4, "3_0.0"), body("4e0")])]
    parsed = parse_responses(spark.createDataFrame(rows, "trace_id string, response_text string"))
    assert {r.trace_id: r.outcome for r in parsed.collect()} == {
        "0": "failed_validation", "1": "ok", "2": "ok", "3": "failed_validation", "4": "ok", "5": "ok", "6": "failed_validation", "7": "ok"}
    got = {r.trace_id: (r.clarity, r.overall) for r in judge_results(parsed).collect()}
    assert got == {"1": (4.2, 4.0), "2": (4.0, 4.0), "4": (4.0, 4.0), "5": (1.0, 4.0), "7": (4.0, 4.0)}


def test_new_event_type_is_one_rule_table_entry(spark):
    """An extra event type is validated by adding its rules, no code."""
    from tracewright.operators.validate import explode_violations, violations_array
    from tracewright.schemas import PAYLOAD_RULES, Field
    rules = dict(PAYLOAD_RULES, review_comment=(Field("file_path", "str"), Field("line", "int", ge=1)))
    df = spark.createDataFrame([("a", "review_comment", json.dumps({"file_path": "f", "line": 3})),
                                ("b", "review_comment", json.dumps({"line": 0}))],
                               "event_id string, type string, payload_json string")
    got = sorted((r.event_id, r.field, r.code) for r in
                 explode_violations(violations_array(df, "payload_json", rules, gate_col="type"), ["event_id"]).collect())
    assert got == [("b", "file_path", "missing"), ("b", "line", "greater_than_equal")]


INT_PROBES = ["5", "5.0", '"5"', '"5."', '"5.0"', '"5.00"', '" 5 "', '"\\u00a05"', '"5\\u3000"', '"\\u001c5"', "1" + "0" * 30, "1e20", "1e300", "9.2e18", "5.5", "true", "null",
              '"1_000"', '"_1"', '"1__0"', '"+5"', '"-5"', '"nan"', '"inf"', '""', "[]", "{}", "3000000000", "-7", "1e2"]
FLOAT_PROBES = ["1", "1.5", '"1.5"', '"1."', '".5"', '"\\u00a02"', '"nan"', '"inf"', '"-inf"', '"Infinity"', '"+Infinity"', '"NaN"', '"infin"', "1e300", "-0.1", "true", '"1_0"', '"4_"', "5.04", "null", '"1e400"']


def test_numbers_as_pydantic_reads_them(spark):
    """Parity of every way to write a number, for an integer of at least 1 and a float of 0 to 5."""
    import json

    pydantic = pytest.importorskip("pydantic")

    class M(pydantic.BaseModel):
        exit_code: int = pydantic.Field(ge=1)

    class S(pydantic.BaseModel):
        overall: float = pydantic.Field(ge=0.0, le=5.0)

    from tracewright.functions.jsonrules import MESSAGES
    from tracewright.operators.validate import document_violations
    from tracewright.schemas import Field
    for model, name, kind, probes, le in ((M, "exit_code", "int", INT_PROBES, None), (S, "overall", "float", FLOAT_PROBES, 5.0)):
        df = spark.createDataFrame([(i, f'{{"{name}":{p}}}') for i, p in enumerate(probes)], "i int, doc string")
        rules = [Field(name, kind, ge=1 if kind == "int" else 0.0, le=le)]
        got = {r.i: (r.code, r.message) for r in document_violations(df, ["i"], "doc", rules).collect()}
        for i, p in enumerate(probes):
            try:
                model(**json.loads(f'{{"{name}":{p}}}'))
                want = None
            except pydantic.ValidationError as e:
                want = (e.errors()[0]["type"], e.errors()[0]["msg"])
            assert got.get(i) == want, p
    assert "int_parsing_size" in MESSAGES


def test_offending_values_are_what_pydantic_was_given(spark):
    """The value of every error of a file_edit payload, as JSON, equal to pydantic's ``input``; null ones are left out."""
    from typing import Optional

    pydantic = pytest.importorskip("pydantic")

    class Range(pydantic.BaseModel):
        start: list[int] = pydantic.Field(min_length=2, max_length=2)
        end: list[int] = pydantic.Field(min_length=2, max_length=2)

    class Edit(pydantic.BaseModel):
        file_path: str
        patch_blob_id: str
        selection: Optional[Range] = None
        reason_ref: Optional[str] = None

    from tracewright.operators.validate import document_violations, offending_value
    from tracewright.schemas import PAYLOAD_RULES
    docs = ["{}", '{"file_path":5,"patch_blob_id":null}', '{"zz":{"b":[1,2.5]},"file_path":"a","patch_blob_id":["x",{"k":1}]}',
            '{"file_path":"a","patch_blob_id":"b","selection":{"end":[1,"x"],"start":[1.5,2]},"reason_ref":7.5}', '{"file_path":"a","patch_blob_id":"b","selection":{"end":[1,2]}}',
            '{"file_path":true,"patch_blob_id":"b","selection":"né"}', '{"file_path":"a","patch_blob_id":"b","selection":{"start":[1],"end":[1,2,3]}}']
    names = {"file_path", "patch_blob_id", "selection", "selection.start", "selection.end", "reason_ref"}
    rules = [f for f in PAYLOAD_RULES["file_edit"] if f.name in names]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, doc string")
    v = document_violations(df, ["i"], "doc", rules).join(df, "i")
    got = {(r.i, r.field): r.value for r in v.select("i", "field", offending_value(F.col("doc"), F.col("field"), F.col("code")).alias("value")).collect()}
    want = {}
    for i, d in enumerate(docs):
        try:
            Edit(**json.loads(d))
        except pydantic.ValidationError as e:
            for x in e.errors():
                want[i, ".".join(map(str, x["loc"]))] = None if x["input"] is None else x["input"]
    assert {k: None if x is None else json.loads(x) for k, x in got.items()} == want


def test_whether_any_rule_is_broken_agrees_with_the_violations(spark):
    """The short form of the rules on every payload rule set against the full one, over mutated documents."""
    import random

    from tracewright.operators.validate import any_violation
    from tracewright.schemas import ENUMS, PAYLOAD_RULES
    r = random.Random(8)
    values = ['"x"', "5", "-1", "5.5", "true", "null", '"yes"', "[]", '["a"]', "[1,2]", '[1,"x"]', "[1]", "[1,2,3]", "{}", '{"start":[1,2],"end":[1,2]}', '{"start":[1,"z"],"end":[3]}']
    rows = []
    for t, fields in PAYLOAD_RULES.items():
        top = [f for f in fields if "." not in f.name]
        for _ in range(60):
            doc = {}
            for f in top:
                good = {"str": '"s"', "int": "3", "bool": "true", "list_str": '["a"]', "dict": "{}" if f.name == "details" else "null"}.get(f.kind, f'"{ENUMS[f.kind[5:]][0]}"' if f.kind.startswith("enum:") else "null")
                if f.required or r.random() < 0.6:
                    doc[f.name] = good if r.random() < 0.85 else r.choice(values)
                if f.required and r.random() < 0.03:
                    doc.pop(f.name)
            rows.append((len(rows), t, "{" + ",".join(f'"{k}":{v}' for k, v in doc.items()) + "}"))
    df = spark.createDataFrame(rows, "i int, type string, payload_json string")
    short = {x.i: x.bad for x in any_violation(df, "payload_json", PAYLOAD_RULES, "type", "bad").collect()}
    broken = {x.i for x in payload_violations(df, ["i"]).select("i").distinct().collect()}
    assert short == {i: i in broken for i, _, _ in rows} and 50 < len(broken) < len(rows) - 50
