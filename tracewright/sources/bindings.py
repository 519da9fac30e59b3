"""Telemetry tables derived from the given parquet tables.

The given data is not shaped as sessions, so these bindings derive traces,
events, batch submissions, blobs and judge responses from it, with planted
faults, deterministically. Every derived table grows with its input table.

  tel_traces       one trace per events.user_id (user_id % 10 == 9 has none: orphans)
  tel_blobs        one blob row per document (blob_id = content address of text)
  tel_events       one telemetry event per events row, payload JSON by type
  tel_submissions  tel_events cut into batches of 7 by seq, with repeated ids and lowered seqs
  tel_judge_raw    one judge response text per labels row
  tel_trace_bodies trace-create request bodies (JSON) per trace, with faults
  tel_finalize_bodies finalize request bodies (JSON) per trace, with faults
  tel_test_runs    one test invocation per test_run event (exit code, duration, output)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import hashlib
import os

from tracewright.functions.hashing import content_address
from tracewright.operators.ranking import position_in_group
from tracewright.session import scratch_path

# Fixed values of the fixture binding (event_id % 11 -> type, % 3 -> actor).
EVENT_TYPE_CYCLE = (
    "file_edit", "file_snapshot", "terminal_command", "terminal_output", "test_run",
    "debug_action", "navigation", "thought", "commit", "pr_metadata", "error",
)
ACTOR_CYCLE = ("human", "tool", "ide")
STATUS_BY_USER_MOD6 = {0: "finalizing", 1: "complete", 2: "failed"}  # others: collecting
INPUT_TABLES = ("events", "documents", "labels")
ZERO_BLOB = "sha256:" + "0" * 64
BATCH_WIDTH = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table's scan dealt over all cores where its files give fewer splits than there are cores: rules and regexes cost
    far more than moving so few rows. A table of more splits than cores is left as it is. ``df`` is a plain scan."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _code_version() -> str:
    """Hash of the package source: any code change gives new table paths."""
    h = hashlib.sha1()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for d, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(d, f), "rb") as fh:
                    h.update(f.encode() + fh.read())
    return h.hexdigest()[:12]


_VERSION = _code_version()


def _input_stamp(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and modification times of the files below the input folder."""
    try:
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(sf_dir)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files, seen = fs.listFiles(root, True), []
        while files.hasNext():
            f = files.next()
            seen.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return repr(sorted(seen))
    except Exception:  # no driver-side context
        meta = [table(spark, sf_dir, t).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
                .distinct().collect() for t in INPUT_TABLES]
        return repr([sorted(map(str, rows)) for rows in meta])


def materialized(spark: SparkSession, sf_dir: str, name: str, build, dealt: bool = False) -> DataFrame:
    """Read derived table ``name`` from the shared checkpoint folder, writing it
    first if absent. Keyed by input folder, its files (sizes and modification
    times) and the code version, so changed input or code never reads a
    stale table. The write cuts the lineage: a lost executor recomputes from
    this table, not from the raw inputs."""
    key = hashlib.sha1(f"{os.path.abspath(sf_dir)}|{_input_stamp(spark, sf_dir)}|{_VERSION}".encode()).hexdigest()[:16]
    path = scratch_path(spark, f"tw-bindings/{key}/{name}")
    if not _written(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spread(spark.read.parquet(path)) if dealt else spark.read.parquet(path)


def _written(spark: SparkSession, path: str) -> bool:
    try:
        jvm = spark.sparkContext._jvm
        done = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
        return bool(done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done))
    except Exception:  # no driver-side context: probe by reading
        try:
            spark.read.parquet(path).schema
            return True
        except Exception:
            return False


def ts_millis(col: str = "ts") -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ, floored, independent of the session time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col}) div 1000")


def _cycle(col: Column, values: tuple[str, ...]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(col == i, F.lit(v)) if expr is None else expr.when(col == i, F.lit(v)))
    return expr


def tel_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    uid = F.col("user_id")
    return (ev.where(uid % 10 != 9)
            .groupBy("user_id")
            .agg(F.min(ts_millis()).alias("created_at_ms"))
            .select(F.concat(F.lit("t-"), uid).alias("trace_id"),
                    F.coalesce(_cycle(uid % 6, tuple(STATUS_BY_USER_MOD6.get(i, "collecting") for i in range(6))),
                               F.lit("collecting")).alias("status"),
                    "created_at_ms",
                    F.concat(F.lit("Bug "), uid).alias("bug_title"),
                    F.when(uid % 4 == 0, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("Steps "), uid)).alias("repro_steps")))


def trace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tel_traces as stored: sorted by trace_id, so a lookup by key reads the row groups that may hold it."""
    return materialized(spark, sf_dir, "tel_traces", lambda: tel_traces(spark, sf_dir)
                        .repartitionByRange("trace_id").sortWithinPartitions("trace_id"))


def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalized event table, ranged and sorted by (trace_id, seq)."""
    return materialized(spark, sf_dir, "tel_event_table", lambda: tel_events(spark, sf_dir)
                        .repartitionByRange("trace_id", "seq").sortWithinPartitions("trace_id", "seq"))


def tel_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(content_address(F.col("text")).alias("blob_id"),
                       F.col("doc_id").alias("source_key"),
                       F.col("source").alias("content_type"),
                       F.col("text").alias("content"))


def _payload(eid: Column, typ: Column, blob_id: Column) -> Column:
    m40 = (eid % 40).cast("string")
    file_edit = F.concat(F.lit('{"file_path":"src/f'), m40, F.lit('.py","edit_kind":"'),
                         F.when(eid % 37 == 0, F.lit("rewrite")).otherwise(F.lit("patch")),
                         F.lit('","patch_blob_id":"'), blob_id, F.lit('"}'))
    snapshot = F.concat(F.lit('{"file_path":"src/f'), m40, F.lit('.py","content_blob_id":"'), blob_id,
                        F.lit('","snapshot_reason":"pre_test"}'))
    command = F.concat(F.lit('{"cwd":"/w","command":"pytest -k t'), (eid % 9).cast("string"), F.lit('"}'))
    output = F.concat(F.lit('{"stream":"stdout","chunk_blob_id":"'), blob_id, F.lit('"}'))
    test_run = F.concat(F.lit('{"command":"pytest","runner":"pytest","exit_code":'), (eid % 3).cast("string"),
                        F.lit(',"duration_ms":'),
                        F.when(eid % 41 == 0, F.lit("-1")).otherwise((eid % 5000).cast("string")),
                        F.lit(',"passed":'), F.when(eid % 3 == 0, F.lit("true")).otherwise(F.lit("false")),
                        F.lit("}"))
    navigation = F.concat(F.lit('{"file_path":"src/f'), m40, F.lit('.py","line":'),
                          F.when(eid % 43 == 0, F.lit("5.5")).otherwise(F.lit("42")), F.lit("}"))
    thought = F.concat(F.lit('{"content_blob_id":"'), blob_id, F.lit('","kind":"hypothesis","links_to":[]}'))
    commit = F.concat(F.lit('{"commit_sha":"'), F.substring(blob_id, 8, 40), F.lit('","message":"fix '),
                      eid.cast("string"), F.lit('"}'))
    error = F.concat(F.lit('{"error_type":"ValueError","message":"m'), eid.cast("string"), F.lit('"}'))
    return (F.when(eid % 101 == 0, F.lit("{}"))
            .when(typ == "file_edit", file_edit)
            .when(typ == "file_snapshot", snapshot)
            .when(typ == "terminal_command", command)
            .when(typ == "terminal_output", output)
            .when(typ == "test_run", test_run)
            .when(typ == "debug_action", F.lit('{"action":"step_over","details":{"n":1}}'))
            .when(typ == "navigation", navigation)
            .when(typ == "thought", thought)
            .when(typ == "commit", commit)
            .when(typ == "pr_metadata", F.lit('{"title":null}'))
            .otherwise(error))


def tel_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialized(spark, sf_dir, "tel_events", lambda: build_tel_events(spark, sf_dir), dealt=True)


def build_tel_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    docs = table(spark, sf_dir, "documents")
    blobs = docs.select(F.col("doc_id").alias("_doc"), content_address(F.col("text")).alias("_doc_blob"))
    # events refer to documents in turn, over the whole table: their number is a one-row aggregate in the plan
    n_docs = docs.agg(F.nullif(F.count(F.lit(1)), F.lit(0))).scalar()
    eid = F.col("event_id")
    x = ev.select(F.concat(F.lit("t-"), F.col("user_id")).alias("trace_id"), eid.alias("_eid"), F.col("ts").alias("_ts"),
                  ts_millis().alias("ts_ms"), (eid % n_docs).alias("_ref"))
    x = position_in_group(x, ["trace_id"], ["_ts", "_eid"], out="seq", by=F.col("ts_ms"))
    eid = F.col("_eid")
    # an event whose document is absent keeps its row and refers to the zero blob
    x = (x.join(blobs, F.col("_ref") == F.col("_doc"), "left")
         .withColumn("type", _cycle(eid % 11, EVENT_TYPE_CYCLE))
         .withColumn("actor_kind", _cycle(eid % 3, ACTOR_CYCLE))
         .withColumn("blob_id", F.when(eid % 53 == 0, F.lit(ZERO_BLOB)).otherwise(F.coalesce("_doc_blob", F.lit(ZERO_BLOB)))))
    return x.select("trace_id", F.concat(F.lit("ev-"), eid).alias("event_id"), "seq", "ts_ms", "type", "actor_kind", "blob_id",
                    _payload(eid, F.col("type"), F.col("blob_id")).alias("payload_json"))


def tel_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialized(spark, sf_dir, "tel_submissions", lambda: build_tel_submissions(tel_events(spark, sf_dir)), dealt=True)


def build_tel_submissions(te: DataFrame) -> DataFrame:
    # seq is dense 1..n per trace, so "previous event" is an equi-join on
    # (trace_id, seq - 1): keyed by the pair, a hot trace spreads over tasks.
    prev = te.select("trace_id", (F.col("seq") + 1).alias("seq"), F.col("event_id").alias("_prev_id"))
    n = F.substring(F.col("event_id"), 4, 1 << 20).cast("bigint")
    return (te.join(prev, ["trace_id", "seq"], "left")
            .select("trace_id",
                    ((F.col("seq") - 1) / BATCH_WIDTH).cast("int").alias("batch_no"),
                    ((F.col("seq") - 1) % BATCH_WIDTH).cast("int").alias("pos"),
                    F.when(n % 89 == 0, F.coalesce("_prev_id", "event_id")).otherwise(F.col("event_id")).alias("event_id"),
                    F.when(n % 97 == 0, F.col("seq") - 1).otherwise(F.col("seq")).cast("int").alias("seq"),
                    "ts_ms", "type", "actor_kind", "payload_json"))


def tel_event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submitted events as JSON, (trace_id, batch_no, pos, event_json). Faults and
    oddities by the event's number: % 23 == 1 seq as a string, % 29 == 2 fractional
    seq, % 31 == 3 seq true, % 37 == 4 no actor, % 41 == 5 numeric actor.id,
    % 43 == 6 numeric branch, % 47 == 7 no event_id, % 53 == 8 ts_ms "12x"."""
    s = tel_submissions(spark, sf_dir)
    n = F.substring(F.col("event_id"), 4, 1 << 20).cast("bigint")
    seq = F.col("seq").cast("string")
    value = (F.when(n % 23 == 1, F.concat(F.lit('"'), seq, F.lit('"'))).when(n % 29 == 2, F.concat(seq, F.lit(".5")))
             .when(n % 31 == 3, F.lit("true")).otherwise(seq))
    actor = (F.when(n % 37 == 4, F.lit("")).when(n % 41 == 5, F.concat(F.lit(',"actor":{"kind":"'), "actor_kind", F.lit('","id":7}')))
             .otherwise(F.concat(F.lit(',"actor":{"kind":"'), "actor_kind", F.lit('","id":"a'), (n % 5).cast("string"), F.lit('"}'))))
    context = F.when(n % 43 == 6, F.lit(',"context":{"branch":1}')).when(n % 2 == 0, F.lit(',"context":{"branch":"main","commit_head":null}')).otherwise(F.lit(""))
    ident = F.when(n % 47 == 7, F.lit("")).otherwise(F.concat(F.lit('"event_id":"'), "event_id", F.lit('",')))
    ts = F.when(n % 53 == 8, F.lit('"12x"')).otherwise(F.col("ts_ms").cast("string"))
    doc = F.concat(F.lit("{"), ident, F.lit('"seq":'), value, F.lit(',"ts_ms":'), ts, F.lit(',"type":"'), "type", F.lit('"'), actor, context,
                   F.lit(',"payload":'), "payload_json", F.lit("}"))
    return s.select("trace_id", "batch_no", "pos", doc.alias("event_json"))


def _score(doc: Column, k: int) -> Column:
    v = (doc * 7 + k * 13) % 51
    return F.concat((v / 10).cast("int").cast("string"), F.lit("."), (v % 10).cast("string"))


def tel_judge_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    d = F.col("doc_id")
    ov = (d * 37) % 501
    parts = [F.lit('{"scores":{')]
    from tracewright.schemas import SCORE_NAMES
    for k, name in enumerate(SCORE_NAMES):
        val = _score(d, k)
        if name == "clarity":
            val = F.when(d % 17 == 0, F.lit("6.0")).otherwise(val)
        parts += [F.lit(("," if k else "") + f'"{name}":'), val]
    parts += [F.lit('},"overall":'), (ov / 100).cast("int").cast("string"), F.lit("."),
              F.lpad((ov % 100).cast("string"), 2, "0"),
              F.lit(',"rationale":"'), F.when(d % 29 == 0, F.lit("")).otherwise(F.concat(F.lit("r"), d.cast("string"))),
              F.lit('","flags":['),
              F.when(d % 13 == 0, F.lit('"made_up"')).when(F.col("quality") == 1, F.lit('"exemplary_trace"'))
               .otherwise(F.lit("")),
              F.lit("]}")]
    body = F.concat(*parts)
    text = (F.when(d % 19 == 0, F.lit(""))
            .when(d % 23 == 0, F.substring(body, 1, 60))
            .when(d % 3 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```\ndone")))
            .otherwise(body))
    return lab.select(F.concat(F.lit("t-"), d).alias("trace_id"), text.alias("response_text"))


def tel_trace_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace-create bodies with every field of the model, one per tel_traces row.
    Faults by the numeric id: % 5 == 1 drops developer_id, % 7 == 2 bad
    experience_level, % 11 == 3 numeric title, % 13 == 4 missing
    environment.ide, % 17 == 5 bad consent flag, % 19 == 6 two bad links."""
    tr = tel_traces(spark, sf_dir)
    n = F.substring(F.col("trace_id"), 3, 1 << 20).cast("bigint")
    ns = n.cast("string")
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    title = F.when(n % 11 == 3, ns).otherwise(text('"', F.col("bug_title"), '"'))
    repro = F.when(F.col("repro_steps").isNull(), F.lit("null")).otherwise(text('"', F.col("repro_steps"), '"'))
    flags = (F.when(n % 17 == 5, F.lit(',"consent_flags":{"store_raw_code":"maybe"}'))
             .when(n % 4 == 0, F.lit(',"consent_flags":{"store_raw_code":false,"allow_llm_judge":"no"}')).otherwise(F.lit("")))
    dev = (F.when(n % 5 == 1, F.lit('{"experience_level":"mid"}'))
           .when(n % 7 == 2, text('{"developer_id":"d', ns, '","experience_level":"expert"}'))
           .otherwise(text('{"developer_id":"d', ns, '"', flags, "}")))
    ide = text('{"ide":{"name":"ide', (n % 3).cast("string"), F.when(n % 2 == 0, text('","version":"1.', (n % 4).cast("string"))).otherwise(F.lit("")), '"}',
               F.when(n % 3 == 2, F.lit(',"os":"linux"')).otherwise(F.lit("")), ',"language":["python"],"containerized":',
               F.when(n % 2 == 0, F.lit("true")).otherwise(F.lit("false")), F.when(n % 6 == 0, F.lit(',"timezone":"UTC"')).otherwise(F.lit("")), "}")
    env = F.when(n % 13 == 4, F.lit('{"os":"linux"}')).otherwise(ide)
    repo = text('{"repo_id":"r', ns, '","commit_base":"c', ns, '"', F.when(n % 3 == 0, text(',"remote_url":"git://h/r', ns, '"')).otherwise(F.lit("")),
                F.when(n % 2 == 0, text(',"repo_fingerprint":{"tree_hash":"t', ns, '","dependencies_lock_hash":null}')).otherwise(F.lit("")), "}")
    links = (F.when(n % 19 == 6, F.lit(',"links":[1,"a",2]')).when(n % 3 == 1, text(',"links":["u', ns, '","v"],"expected":"e', ns, '"')).otherwise(F.lit("")))
    body = text('{"repo":', repo, ',"task":{"task_id":"k', ns, '","bug_report":{"title":', title, ',"description":"d', ns, '","repro_steps":', repro, links,
                '},"labels":["l', (n % 4).cast("string"), '"]},"developer":', dev, ',"environment":', env, "}")
    return tr.select("trace_id", body.alias("body_json"))


def tel_finalize_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finalize bodies per trace: % 9 == 0 empty body (rejected), % 9 == 1 empty
    final_state, % 9 == 2 numeric commit_head, else commit_head and a PR."""
    tr = tel_traces(spark, sf_dir)
    n = F.substring(F.col("trace_id"), 3, 1 << 20).cast("bigint")
    ns = n.cast("string")
    body = (F.when(n % 9 == 0, F.lit("{}"))
            .when(n % 9 == 1, F.lit('{"final_state":{}}'))
            .when(n % 9 == 2, F.concat(F.lit('{"final_state":{"commit_head":'), ns, F.lit("}}")))
            .otherwise(F.concat(F.lit('{"final_state":{"commit_head":"h'), ns,
                                F.lit('","pr":{"title":"Fix '), ns, F.lit('","description":'),
                                F.when(n % 2 == 0, F.lit('""')).otherwise(F.lit('"desc"')),
                                F.lit(',"diff_blob_id":null}}}'))))
    return tr.select("trace_id", body.alias("body_json"))


def tel_test_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test invocations (S10): one per test_run event, with its exit code and
    duration, a stdout text, stderr empty unless the run failed."""
    te = tel_events(spark, sf_dir)
    t = te.where(F.col("type") == "test_run")
    n = F.substring(F.col("event_id"), 4, 1 << 20).cast("bigint")
    return t.select("trace_id", F.concat(F.lit("inv-"), n.cast("string")).alias("invocation_id"), "ts_ms",
                    F.lit("pytest -q").alias("command"),
                    (n % 3).cast("int").alias("exit_code"),
                    (n % 5000).cast("long").alias("duration_ms"),
                    F.concat(F.lit("ran "), n.cast("string"), F.lit(" tests")).alias("stdout"),
                    F.when(n % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("E failure "), n.cast("string"))).alias("stderr"))
