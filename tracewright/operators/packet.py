"""Judge packet rendering.

The packet of a trace is a text document: bug report, developer actions
(one line per renderable event, by seq), final state, test results. It is
produced as ordered *parts* ``(trace_id, part_no, text)``; joining the parts
of a trace by ``part_no`` with newlines gives the document. Part 0 is the
bug report and the actions header, parts 1..n are bounded chunks of event
lines (``PART_EVENTS`` seq values each), and part ``LAST_PART`` holds the final
state and test results. No group ever holds a whole trace.

Blob previews are cut on the blob side, for referenced ids only, before the
join: at most 500 characters per referenced blob cross the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.operators.timeline import PART_EVENTS, ordered_join, part_no

# Preview and cut sizes, renderable types, section texts.
THOUGHT_PREVIEW = 500
OUTPUT_PREVIEW = 200
MESSAGE_CUT = 100
SHA_CUT = 12
MAX_INVOCATIONS = 5
LAST_PART = 2_000_000_000
RENDERED_TYPES = ("file_edit", "thought", "test_run", "terminal_command", "terminal_output", "commit", "error")
ACTIONS_HEADER = "## Developer Actions (ordered by sequence)"

# payload fields read per type, with the default used when the key is absent
_FIELDS = {
    "file_edit": {"file_path": "N/A", "edit_kind": "N/A"},
    "thought": {"kind": "N/A", "content_blob_id": ""},
    "test_run": {"command": "N/A", "exit_code": "N/A", "passed": "False", "duration_ms": "0"},
    "terminal_command": {"command": "N/A", "cwd": "N/A"},
    "terminal_output": {"stream": "N/A", "is_truncated": "False", "chunk_blob_id": ""},
    "commit": {"commit_sha": "N/A", "message": ""},
    "error": {"error_type": "N/A", "message": ""},
}


def preview(text: Column, n: int) -> Column:
    """First n code points, '...' appended when longer."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def blob_previews(blobs: DataFrame, refs: DataFrame) -> DataFrame:
    """J2 blob side: (blob_id, p500, p200) for referenced, non-empty blobs.

    ``blobs`` has (blob_id, content STRING or BINARY). Content is decoded
    with replacement (P15) and cut before anything is shuffled."""
    ids = refs.select(F.col("blob_id")).where(F.col("blob_id").isNotNull()).distinct()
    text = F.expr("make_valid_utf8(cast(content as string))")
    heads = blobs.select("blob_id", F.substring(text, 1, THOUGHT_PREVIEW + 1).alias("_head"))
    cut = heads.join(ids, "blob_id", "left_semi")
    one = cut.groupBy("blob_id").agg(F.min("_head").alias("_head"))  # copies share content
    return one.where(F.length("_head") > 0).select(
        "blob_id", preview(F.col("_head"), THOUGHT_PREVIEW).alias("p500"),
        preview(F.col("_head"), OUTPUT_PREVIEW).alias("p200"))


def _py_text(j: Column, s: Column, default: str) -> Column:
    """Python ``str(payload.get(k, default))`` from the JSON text ``j`` of the
    value (NULL when the key is absent) and its string form ``s``."""
    return (F.when(j.isNull(), F.lit(default))
            .when(j == "null", F.lit("None"))
            .when(j == "true", F.lit("True"))
            .when(j == "false", F.lit("False"))
            .when(F.substring(j, 1, 1) == '"', s)
            .otherwise(j))


def event_lines(events: DataFrame, previews: DataFrame) -> DataFrame:
    """K2-K9: (trace_id, seq, line) for renderable events."""
    ev = events.where(F.col("type").isin(*RENDERED_TYPES)).withColumn("_v", F.expr("try_parse_json(payload_json)"))
    paths = sorted({k for fs in _FIELDS.values() for k in fs})
    for p in paths:
        users = [t for t, fs in _FIELDS.items() if p in fs]
        sub = F.expr(f"try_variant_get(_v, '$.{p}', 'variant')")
        ev = (ev.withColumn(f"_j_{p}", F.when(F.col("type").isin(*users), F.to_json(sub)))
                .withColumn(f"_s_{p}", F.when(F.col("type").isin(*users),
                                              F.expr(f"try_variant_get(_v, '$.{p}', 'string')"))))

    def val(t: str, p: str) -> Column:
        return _py_text(F.col(f"_j_{p}"), F.col(f"_s_{p}"), _FIELDS[t][p])

    # the blob key is the raw string value (absent -> '', null -> no blob)
    key = (F.when(F.col("type") == "thought", F.col("_s_content_blob_id"))
           .when(F.col("type") == "terminal_output", F.col("_s_chunk_blob_id")))
    ev = ev.withColumn("_bkey", F.when(F.col("_j_content_blob_id").startswith('"') |
                                       F.col("_j_chunk_blob_id").startswith('"'), key))
    pre = F.concat(F.lit("[seq="), F.col("seq").cast("string"), F.lit(", ts="), F.col("ts_ms").cast("string"), F.lit("] "))
    t = F.col("type")
    head = (
        F.when(t == "file_edit", F.concat(pre, F.lit("**file_edit**: `"), val("file_edit", "file_path"), F.lit("` ("),
                                          val("file_edit", "edit_kind"), F.lit(")")))
        .when(t == "thought", F.concat(pre, F.lit("**thought** ("), val("thought", "kind"), F.lit("): ")))
        .when(t == "test_run", F.concat(pre, F.lit("**test_run**: `"), val("test_run", "command"),
                                        F.lit("` (exit_code="), val("test_run", "exit_code"),
                                        F.lit(", passed="), val("test_run", "passed"),
                                        F.lit(", duration="), val("test_run", "duration_ms"), F.lit("ms)")))
        .when(t == "terminal_command", F.concat(pre, F.lit("**terminal_command**: `"), val("terminal_command", "command"),
                                                F.lit("` (cwd: "), val("terminal_command", "cwd"), F.lit(")")))
        .when(t == "terminal_output", F.concat(pre, F.lit("**terminal_output** ("), val("terminal_output", "stream"),
                                               F.lit("): ")))
        .when(t == "commit", F.concat(pre, F.lit("**commit**: "), F.substring(val("commit", "commit_sha"), 1, SHA_CUT),
                                      F.lit(" - "), F.substring(val("commit", "message"), 1, MESSAGE_CUT)))
        .when(t == "error", F.concat(pre, F.lit("**error**: "), val("error", "error_type"), F.lit(": "),
                                     F.substring(val("error", "message"), 1, MESSAGE_CUT))))
    # what follows the head where no preview does
    rest = (F.when(t == "thought", F.concat(F.lit("[blob: "), val("thought", "content_blob_id"), F.lit("]")))
            .when(t == "terminal_output", F.concat(F.lit("[truncated="), val("terminal_output", "is_truncated"), F.lit("]")))
            .otherwise(F.lit("")))
    # only lines that refer to a blob meet the previews: all others would share the null key, and one task
    lines = ev.select("trace_id", "seq", "type", "_bkey", head.alias("_head"), rest.alias("_rest"))
    plain = lines.where(F.col("_bkey").isNull()).select("trace_id", "seq", F.concat("_head", "_rest").alias("line"))
    pv = previews.select(F.col("blob_id").alias("_bkey"), "p500", "p200")
    found = F.when(t == "thought", F.col("p500")).otherwise(F.col("p200"))
    referring = (lines.where(t.isin("thought", "terminal_output") & F.col("_bkey").isNotNull()).join(pv, "_bkey", "left")
                 .select("trace_id", "seq", F.concat("_head", F.coalesce(found, "_rest")).alias("line")))
    return plain.unionByName(referring)


def top_k_per_group(df: DataFrame, keys: list[str], order: list[str], k: int, salt_buckets: int = 64) -> DataFrame:
    """First k rows per group by ``order`` (a total order), skew-safe: rank
    within (keys, salt) slices first, so a hot group is split across
    ``salt_buckets`` tasks, then re-rank the at most k * buckets survivors."""
    salt = (F.xxhash64(*[F.col(c) for c in order]) % salt_buckets).alias("_salt")
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    first = (df.withColumn("_salt", salt).withColumn("_r1", F.row_number().over(w1))
             .where(F.col("_r1") <= k).drop("_r1", "_salt"))
    return first.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


def test_section(runs: DataFrame) -> DataFrame:
    """K11 + A9 + W2/O2: per trace with runs, the rendered test section lines.

    ``runs``: (trace_id, invocation_id, ts_ms, command, exit_code, duration_ms,
    passed). final_passed = passed of the latest run (max_by, a partial
    aggregate); the first five invocations by (ts_ms, invocation_id)."""
    last = (runs.groupBy("trace_id")
            .agg(F.max_by("passed", F.struct("ts_ms", "invocation_id")).alias("final_passed"),
                 F.max_by("command", F.struct("ts_ms", "invocation_id")).alias("runner")))
    top = top_k_per_group(runs, ["trace_id"], ["ts_ms", "invocation_id"], MAX_INVOCATIONS)
    inv_line = F.concat(F.lit("- Invocation "), F.col("rank").cast("string"), F.lit(": command=`"), F.col("command"),
                        F.lit("`, exit_code="), F.col("exit_code").cast("string"),
                        F.lit(", passed="), F.when(F.col("passed"), "True").otherwise("False"),
                        F.lit(", duration_ms="), F.col("duration_ms").cast("string"))
    lines = top.groupBy("trace_id").agg(ordered_join(inv_line, F.col("rank")).alias("_inv"))
    return last.join(lines, "trace_id", "left").select(
        "trace_id",
        F.concat_ws("\n", F.concat(F.lit("**Runner:** "), F.col("runner")),
                    F.concat(F.lit("**Final passed:** "), F.when(F.col("final_passed"), "True").otherwise("False")),
                    F.col("_inv")).alias("tests_text"))


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def packet_parts(traces: DataFrame, events: DataFrame, blobs: DataFrame, finals: DataFrame,
                 runs: DataFrame) -> DataFrame:
    """Ordered packet parts per trace.

    traces: (trace_id, title, description, repro_steps, expected, actual)
    finals: (trace_id, commit_head, pr_present, pr_title, pr_description, pr_diff_blob_id) for
            traces with a stored final state
    runs:   test invocations (see ``test_section``)
    """
    bug = F.concat_ws("\n", F.lit("## Bug Report"),
                      F.concat(F.lit("**Title:** "), F.coalesce(F.col("title"), F.lit("N/A"))),
                      F.concat(F.lit("**Description:** "), F.coalesce(F.col("description"), F.lit("N/A"))),
                      F.when(_truthy(F.col("repro_steps")), F.concat(F.lit("**Repro Steps:** "), F.col("repro_steps"))),
                      F.when(_truthy(F.col("expected")), F.concat(F.lit("**Expected:** "), F.col("expected"))),
                      F.when(_truthy(F.col("actual")), F.concat(F.lit("**Actual:** "), F.col("actual"))),
                      F.lit(""), F.lit(ACTIONS_HEADER))
    head = traces.select("trace_id", F.lit(0).alias("part_no"), bug.alias("text"))

    refs = events.where(F.col("type").isin("thought", "terminal_output")).select("trace_id", "payload_json")
    ref_ids = refs.select(F.coalesce(F.get_json_object("payload_json", "$.content_blob_id"),
                                     F.get_json_object("payload_json", "$.chunk_blob_id")).alias("blob_id"))
    lines = event_lines(events.join(traces.select("trace_id"), "trace_id", "left_semi"),
                        blob_previews(blobs, ref_ids))
    body = (lines.withColumn("part_no", part_no(F.col("seq")) + 1)
            .groupBy("trace_id", "part_no").agg(ordered_join(F.col("line"), F.col("seq")).alias("text")))

    fs = finals
    state = F.concat_ws("\n",
                        F.when(_truthy(F.col("commit_head")), F.concat(F.lit("**Final commit:** "), F.col("commit_head"))),
                        F.when(F.col("pr_present") & _truthy(F.col("pr_title")),
                               F.concat(F.lit("**PR Title:** "), F.col("pr_title"))),
                        F.when(F.col("pr_present") & _truthy(F.col("pr_description")),
                               F.concat(F.lit("**PR Description:** "), F.col("pr_description"))),
                        F.when(F.col("pr_present") & _truthy(F.col("pr_diff_blob_id")),
                               F.concat(F.lit("**Diff blob:** "), F.col("pr_diff_blob_id"))))
    tail_in = (traces.select("trace_id")
               .join(fs.select("trace_id", state.alias("_state"), F.lit(True).alias("_has_final")), "trace_id", "left")
               .join(test_section(runs), "trace_id", "left"))
    final_section = F.when(F.col("_has_final"),
                           F.when(F.col("_state") == "", F.lit(None)).otherwise(F.col("_state"))) \
                     .otherwise(F.lit("No final state recorded."))
    tail = tail_in.select(
        "trace_id", F.lit(LAST_PART).alias("part_no"),
        F.concat_ws("\n", F.lit(""), F.lit("## Final State"), final_section, F.lit(""), F.lit("## Test Results"),
                    F.coalesce(F.col("tests_text"), F.lit("No test results recorded."))).alias("text"))
    return head.unionByName(body).unionByName(tail)
