"""Typed data model: enum domains, payload rule table, table schemas.

The rule table is declarative: adding an event type (V23) means adding one
entry to ``PAYLOAD_RULES`` and its name to ``ENUMS["event_type"]``; the
validator and the oracles are generated from it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's for identical results).
# Enum domains, in their declared order.
# ---------------------------------------------------------------------------
ENUMS: dict[str, tuple[str, ...]] = {
    "experience_level": ("junior", "mid", "senior", "unknown"),
    "trace_status": ("collecting", "finalizing", "complete", "failed"),
    "ingestion_mode": ("batch", "incremental"),
    "actor_kind": ("human", "tool", "ide"),
    "event_type": (
        "file_edit", "file_snapshot", "terminal_command", "terminal_output", "test_run",
        "debug_action", "navigation", "thought", "commit", "pr_metadata", "error",
    ),
    "edit_kind": ("patch", "replace_range", "keystroke_batch"),
    "snapshot_reason": ("pre_test", "post_test", "manual_checkpoint"),
    "shell": ("bash", "zsh", "pwsh", "cmd"),
    "stream": ("stdout", "stderr"),
    "test_runner": ("pytest", "go test", "npm test", "make test", "custom"),
    "thought_kind": ("hypothesis", "plan", "interpretation", "decision", "postmortem"),
    "judge_flag": ("hallucination_risk", "missing_steps", "unsafe_suggestion", "incomplete_fix", "exemplary_trace"),
    "redaction_rule": ("secret_scan", "pii_mask", "truncate_large"),
}

# Limits and defaults.
MAX_EVENTS_PER_BATCH = 100
MAX_BLOB_BYTES = 1_048_576
TRACE_VERSION = "1.0"
RUBRIC_VERSION = "1.0"
DEFAULT_CONTENT_TYPE = "application/octet-stream"
BLOB_ID_PREFIX = "sha256:"
BLOB_ID_PATTERN = r"^sha256:[a-f0-9]+$"
SCORE_NAMES = (
    "root_cause_identification", "plan_quality", "experiment_iterate_loop",
    "use_of_signals_tests_logs", "minimality_of_fix", "clarity",
)


# ---------------------------------------------------------------------------
# Field rules. kind is one of: str, int, bool, float, enum:<domain>,
# list_str, list_enum:<domain>, dict, int_pair (a list of exactly two ints).
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    required: bool = True
    nullable: bool = False      # Optional[...] (explicit null accepted)
    ge: float | None = None
    le: float | None = None
    min_length: int | None = None
    model: str | None = None    # name of the nested model, for its error text


def _opt(name: str, kind: str, model: str | None = None) -> Field:
    return Field(name, kind, required=False, nullable=True, model=model)


def _obj(name: str, model: str, required: bool = True) -> Field:
    return Field(name, "dict", required=required, model=model)


PAYLOAD_RULES: dict[str, tuple[Field, ...]] = {
    "file_edit": (
        Field("file_path", "str"), Field("edit_kind", "enum:edit_kind"),
        Field("patch_format", "str", required=False), Field("patch_blob_id", "str"),
        _opt("pre_hash", "str"), _opt("post_hash", "str"), _opt("selection", "dict", "SelectionRange"),
        Field("selection.start", "int_pair"), Field("selection.end", "int_pair"),
        _opt("reason_ref", "str"),
    ),
    "file_snapshot": (
        Field("file_path", "str"), Field("content_blob_id", "str"),
        Field("snapshot_reason", "enum:snapshot_reason"),
    ),
    "terminal_command": (
        Field("cwd", "str"), Field("command", "str"),
        Field("shell", "enum:shell", required=False), _opt("env_hash", "str"),
    ),
    "terminal_output": (
        Field("stream", "enum:stream"), Field("chunk_blob_id", "str"),
        Field("is_truncated", "bool", required=False),
    ),
    "test_run": (
        Field("command", "str"), Field("runner", "enum:test_runner"), Field("exit_code", "int"),
        Field("duration_ms", "int", ge=0), Field("passed", "bool"), _opt("report_blob_id", "str"),
    ),
    "thought": (
        Field("content_blob_id", "str"), Field("kind", "enum:thought_kind"),
        Field("links_to", "list_str", required=False),
    ),
    "commit": (
        Field("commit_sha", "str"), Field("message", "str"),
        Field("parent_shas", "list_str", required=False),
    ),
    "pr_metadata": (
        _opt("title", "str"), _opt("description", "str"), _opt("diff_blob_id", "str"), _opt("pr_url", "str"),
    ),
    "error": (Field("error_type", "str"), Field("message", "str"), _opt("stacktrace_blob_id", "str")),
    "debug_action": (Field("action", "str"), _opt("details", "dict")),
    "navigation": (Field("file_path", "str"), _opt("symbol", "str"), _opt("line", "int")),
}

# Event envelope (the payload's own fields are PAYLOAD_RULES).
ENVELOPE_RULES: tuple[Field, ...] = (
    Field("event_id", "str", required=False), Field("seq", "int", ge=1), Field("ts_ms", "int", ge=0),
    Field("type", "enum:event_type"), _obj("actor", "Actor"), Field("actor.kind", "enum:actor_kind"), _opt("actor.id", "str"),
    _opt("context", "dict", "EventContext"), _opt("context.workspace_root", "str"), _opt("context.branch", "str"),
    _opt("context.commit_head", "str"), _opt("context.correlation_id", "str"), _opt("context.parent_event_id", "str"),
    Field("payload", "dict"),
)

# Judge raw output (scores object, overall, rationale, flags).
JUDGE_RULES: tuple[Field, ...] = (_obj("scores", "JudgeScores"),) + tuple(
    Field(f"scores.{n}", "float", ge=0.0, le=5.0) for n in SCORE_NAMES
) + (
    Field("overall", "float", ge=0.0, le=5.0),
    Field("rationale", "str", min_length=1),
    Field("flags", "list_enum:judge_flag", required=False),
)

# Trace-create body (nested required fields and typed optionals).
TRACE_CREATE_RULES: tuple[Field, ...] = (
    _obj("repo", "Repo"), Field("repo.repo_id", "str"),
    _opt("repo.remote_url", "str"), _opt("repo.default_branch", "str"), Field("repo.commit_base", "str"),
    _opt("repo.repo_fingerprint", "dict", "RepoFingerprint"), _opt("repo.repo_fingerprint.tree_hash", "str"),
    _opt("repo.repo_fingerprint.dependencies_lock_hash", "str"),
    _obj("task", "Task"), _opt("task.task_id", "str"), _obj("task.bug_report", "BugReport"),
    Field("task.bug_report.title", "str"), Field("task.bug_report.description", "str"),
    _opt("task.bug_report.repro_steps", "str"), _opt("task.bug_report.expected", "str"),
    _opt("task.bug_report.actual", "str"), Field("task.bug_report.links", "list_str", required=False),
    Field("task.labels", "list_str", required=False),
    _obj("developer", "Developer"), Field("developer.developer_id", "str"),
    Field("developer.experience_level", "enum:experience_level", required=False),
    _obj("developer.consent_flags", "ConsentFlags", required=False),
    Field("developer.consent_flags.store_raw_code", "bool", required=False),
    Field("developer.consent_flags.store_terminal_output", "bool", required=False),
    Field("developer.consent_flags.allow_llm_judge", "bool", required=False),
    _obj("environment", "Environment"), _opt("environment.os", "str"),
    _obj("environment.ide", "IDE"), Field("environment.ide.name", "str"), _opt("environment.ide.version", "str"),
    Field("environment.language", "list_str", required=False),
    Field("environment.containerized", "bool", required=False), _opt("environment.timezone", "str"),
)

FINALIZE_RULES: tuple[Field, ...] = (
    _obj("final_state", "FinalState"), _opt("final_state.commit_head", "str"), _opt("final_state.pr", "dict", "PRFinalState"),
    _opt("final_state.pr.title", "str"), _opt("final_state.pr.description", "str"),
    _opt("final_state.pr.diff_blob_id", "str"),
)


# ---------------------------------------------------------------------------
# Table schemas (Spark side of the relational model).
# ---------------------------------------------------------------------------
EVENT_TABLE = T.StructType([
    T.StructField("trace_id", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("actor_kind", T.StringType()),
    T.StructField("payload_json", T.StringType()),
])

# An event as it is stored: actor and context normalized, the payload as it was sent.
STORED_EVENT = T.StructType([
    *EVENT_TABLE.fields[:2],
    T.StructField("seq", T.LongType()),
    *EVENT_TABLE.fields[3:5],
    T.StructField("actor", T.StructType([T.StructField("kind", T.StringType()), T.StructField("id", T.StringType())])),
    T.StructField("context", T.StructType([T.StructField(n, T.StringType()) for n in (
        "workspace_root", "branch", "commit_head", "correlation_id", "parent_event_id")])),
    T.StructField("payload_json", T.StringType()),
])

SUBMISSION_TABLE = T.StructType([
    T.StructField("trace_id", T.StringType()),
    T.StructField("batch_no", T.IntegerType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("actor_kind", T.StringType()),
    T.StructField("payload_json", T.StringType()),
])
