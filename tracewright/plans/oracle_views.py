"""DuckDB definitions of the derived telemetry tables, for the oracles.

Written independently of the Spark bindings (plain SQL, window functions,
``sha256``); the oracles compose them as CTEs in front of each query.
"""

from __future__ import annotations

_SCORE = "concat(CAST(floor(((doc_id * 7 + {k} * 13) % 51) / 10.0) AS INT), '.', ((doc_id * 7 + {k} * 13) % 51) % 10)"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "tel_traces": ((), """
SELECT concat('t-', user_id) AS trace_id,
       CASE user_id % 6 WHEN 0 THEN 'finalizing' WHEN 1 THEN 'complete' WHEN 2 THEN 'failed' ELSE 'collecting' END AS status,
       min(epoch_us(ts) // 1000) AS created_at_ms,
       concat('Bug ', user_id) AS bug_title,
       CASE WHEN user_id % 4 = 0 THEN NULL ELSE concat('Steps ', user_id) END AS repro_steps
FROM events WHERE user_id % 10 <> 9 GROUP BY user_id"""),
    "tel_blobs": ((), """
SELECT concat('sha256:', sha256(text)) AS blob_id, doc_id AS source_key, source AS content_type, text AS content
FROM documents"""),
    "tel_events": ((), """
SELECT concat('t-', user_id) AS trace_id, concat('ev-', event_id) AS event_id,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS seq, ts_ms, type, actor_kind, blob_id,
       CASE WHEN event_id % 101 = 0 THEN '{}'
            WHEN type = 'file_edit' THEN concat('{"file_path":"src/f', event_id % 40, '.py","edit_kind":"', CASE WHEN event_id % 37 = 0 THEN 'rewrite' ELSE 'patch' END, '","patch_blob_id":"', blob_id, '"}')
            WHEN type = 'file_snapshot' THEN concat('{"file_path":"src/f', event_id % 40, '.py","content_blob_id":"', blob_id, '","snapshot_reason":"pre_test"}')
            WHEN type = 'terminal_command' THEN concat('{"cwd":"/w","command":"pytest -k t', event_id % 9, '"}')
            WHEN type = 'terminal_output' THEN concat('{"stream":"stdout","chunk_blob_id":"', blob_id, '"}')
            WHEN type = 'test_run' THEN concat('{"command":"pytest","runner":"pytest","exit_code":', event_id % 3, ',"duration_ms":', CASE WHEN event_id % 41 = 0 THEN -1 ELSE event_id % 5000 END, ',"passed":', CASE WHEN event_id % 3 = 0 THEN 'true' ELSE 'false' END, '}')
            WHEN type = 'debug_action' THEN '{"action":"step_over","details":{"n":1}}'
            WHEN type = 'navigation' THEN concat('{"file_path":"src/f', event_id % 40, '.py","line":', CASE WHEN event_id % 43 = 0 THEN '5.5' ELSE '42' END, '}')
            WHEN type = 'thought' THEN concat('{"content_blob_id":"', blob_id, '","kind":"hypothesis","links_to":[]}')
            WHEN type = 'commit' THEN concat('{"commit_sha":"', substring(blob_id, 8, 40), '","message":"fix ', event_id, '"}')
            WHEN type = 'pr_metadata' THEN '{"title":null}'
            ELSE concat('{"error_type":"ValueError","message":"m', event_id, '"}') END AS payload_json
FROM (SELECT e.event_id, e.user_id, e.ts, epoch_us(e.ts) // 1000 AS ts_ms,
             CASE e.event_id % 11 WHEN 0 THEN 'file_edit' WHEN 1 THEN 'file_snapshot' WHEN 2 THEN 'terminal_command' WHEN 3 THEN 'terminal_output' WHEN 4 THEN 'test_run' WHEN 5 THEN 'debug_action' WHEN 6 THEN 'navigation' WHEN 7 THEN 'thought' WHEN 8 THEN 'commit' WHEN 9 THEN 'pr_metadata' WHEN 10 THEN 'error' END AS type,
             CASE e.event_id % 3 WHEN 0 THEN 'human' WHEN 1 THEN 'tool' ELSE 'ide' END AS actor_kind,
             CASE WHEN e.event_id % 53 = 0 THEN concat('sha256:', repeat('0', 64)) WHEN d.text IS NULL THEN concat('sha256:', repeat('0', 64))
                  ELSE concat('sha256:', sha256(d.text)) END AS blob_id
      FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)) x"""),
    "tel_submissions": (("tel_events",), """
SELECT trace_id, CAST(floor((seq - 1) / 7.0) AS INT) AS batch_no, CAST((seq - 1) % 7 AS INT) AS pos,
       CASE WHEN CAST(substring(event_id, 4) AS BIGINT) % 89 = 0 THEN coalesce(lag(event_id) OVER (PARTITION BY trace_id ORDER BY seq), event_id) ELSE event_id END AS event_id,
       CAST(CASE WHEN CAST(substring(event_id, 4) AS BIGINT) % 97 = 0 THEN seq - 1 ELSE seq END AS INT) AS seq, ts_ms, type, actor_kind, payload_json
FROM tel_events"""),
    "tel_event_json": (("tel_submissions",), """
SELECT trace_id, batch_no, pos, concat('{', CASE WHEN n % 47 = 7 THEN '' ELSE concat('"event_id":"', event_id, '",') END,
  '"seq":', CASE WHEN n % 23 = 1 THEN concat('"', seq, '"') WHEN n % 29 = 2 THEN concat(seq, '.5') WHEN n % 31 = 3 THEN 'true' ELSE CAST(seq AS VARCHAR) END,
  ',"ts_ms":', CASE WHEN n % 53 = 8 THEN '"12x"' ELSE CAST(ts_ms AS VARCHAR) END, ',"type":"', type, '"',
  CASE WHEN n % 37 = 4 THEN '' WHEN n % 41 = 5 THEN concat(',"actor":{"kind":"', actor_kind, '","id":7}')
       ELSE concat(',"actor":{"kind":"', actor_kind, '","id":"a', n % 5, '"}') END,
  CASE WHEN n % 43 = 6 THEN ',"context":{"branch":1}' WHEN n % 2 = 0 THEN ',"context":{"branch":"main","commit_head":null}' ELSE '' END,
  ',"payload":', payload_json, '}') AS event_json
FROM (SELECT *, CAST(substring(event_id, 4) AS BIGINT) AS n FROM tel_submissions) s"""),
    "tel_judge_raw": ((), """
SELECT concat('t-', doc_id) AS trace_id,
       CASE WHEN doc_id % 19 = 0 THEN '' WHEN doc_id % 23 = 0 THEN substring(body, 1, 60)
            WHEN doc_id % 3 = 0 THEN concat('```json' || chr(10), body, chr(10) || '```' || chr(10) || 'done') ELSE body END AS response_text
FROM (SELECT doc_id, concat('{"scores":{', '"root_cause_identification":', """ + _SCORE.format(k=0) + """,
      ',"plan_quality":', """ + _SCORE.format(k=1) + """, ',"experiment_iterate_loop":', """ + _SCORE.format(k=2) + """,
      ',"use_of_signals_tests_logs":', """ + _SCORE.format(k=3) + """, ',"minimality_of_fix":', """ + _SCORE.format(k=4) + """,
      ',"clarity":', CASE WHEN doc_id % 17 = 0 THEN '6.0' ELSE """ + _SCORE.format(k=5) + """ END,
      '},"overall":', CAST(floor(((doc_id * 37) % 501) / 100.0) AS INT), '.', lpad(CAST(((doc_id * 37) % 501) % 100 AS VARCHAR), 2, '0'),
      ',"rationale":"', CASE WHEN doc_id % 29 = 0 THEN '' ELSE concat('r', doc_id) END,
      '","flags":[', CASE WHEN doc_id % 13 = 0 THEN '"made_up"' WHEN quality = 1 THEN '"exemplary_trace"' ELSE '' END, ']}') AS body
      FROM labels) x"""),
    "tel_trace_bodies": (("tel_traces",), """
SELECT trace_id, concat('{"repo":{"repo_id":"r', n, '","commit_base":"c', n, '"',
  CASE WHEN n % 3 = 0 THEN concat(',"remote_url":"git://h/r', n, '"') ELSE '' END,
  CASE WHEN n % 2 = 0 THEN concat(',"repo_fingerprint":{"tree_hash":"t', n, '","dependencies_lock_hash":null}') ELSE '' END,
  '},"task":{"task_id":"k', n, '","bug_report":{"title":', CASE WHEN n % 11 = 3 THEN CAST(n AS VARCHAR) ELSE concat('"', bug_title, '"') END,
  ',"description":"d', n, '","repro_steps":', CASE WHEN repro_steps IS NULL THEN 'null' ELSE concat('"', repro_steps, '"') END,
  CASE WHEN n % 19 = 6 THEN ',"links":[1,"a",2]' WHEN n % 3 = 1 THEN concat(',"links":["u', n, '","v"],"expected":"e', n, '"') ELSE '' END,
  '},"labels":["l', n % 4, '"]},"developer":',
  CASE WHEN n % 5 = 1 THEN '{"experience_level":"mid"}' WHEN n % 7 = 2 THEN concat('{"developer_id":"d', n, '","experience_level":"expert"}')
       ELSE concat('{"developer_id":"d', n, '"', CASE WHEN n % 17 = 5 THEN ',"consent_flags":{"store_raw_code":"maybe"}'
            WHEN n % 4 = 0 THEN ',"consent_flags":{"store_raw_code":false,"allow_llm_judge":"no"}' ELSE '' END, '}') END,
  ',"environment":', CASE WHEN n % 13 = 4 THEN '{"os":"linux"}' ELSE concat('{"ide":{"name":"ide', n % 3,
       CASE WHEN n % 2 = 0 THEN concat('","version":"1.', n % 4) ELSE '' END, '"}', CASE WHEN n % 3 = 2 THEN ',"os":"linux"' ELSE '' END,
       ',"language":["python"],"containerized":', CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END,
       CASE WHEN n % 6 = 0 THEN ',"timezone":"UTC"' ELSE '' END, '}') END, '}') AS body_json
FROM (SELECT *, CAST(substring(trace_id, 3) AS BIGINT) AS n FROM tel_traces) t"""),
    "tel_finalize_bodies": (("tel_traces",), """
SELECT trace_id, CASE WHEN n % 9 = 0 THEN '{}' WHEN n % 9 = 1 THEN '{"final_state":{}}'
                      WHEN n % 9 = 2 THEN concat('{"final_state":{"commit_head":', n, '}}')
                      ELSE concat('{"final_state":{"commit_head":"h', n, '","pr":{"title":"Fix ', n, '","description":',
                                  CASE WHEN n % 2 = 0 THEN '""' ELSE '"desc"' END, ',"diff_blob_id":null}}}') END AS body_json
FROM (SELECT *, CAST(substring(trace_id, 3) AS BIGINT) AS n FROM tel_traces) t"""),
    "tel_test_runs": (("tel_events",), """
SELECT trace_id, concat('inv-', n) AS invocation_id, ts_ms, 'pytest -q' AS command, CAST(n % 3 AS INT) AS exit_code, CAST(n % 5000 AS BIGINT) AS duration_ms,
       concat('ran ', n, ' tests') AS stdout, CASE WHEN n % 3 = 0 THEN '' ELSE concat('E failure ', n) END AS stderr
FROM (SELECT *, CAST(substring(event_id, 4) AS BIGINT) AS n FROM tel_events WHERE type = 'test_run') t"""),
}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first).

    ``extra`` adds query-specific CTEs (name -> SQL) after the views.
    """
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    ctes = [f"{n} AS ({VIEWS[n][1]}\n)" for n in order]
    for k, v in (extra or {}).items():
        ctes.append(f"{k} AS ({v}\n)")
    if not ctes:
        return body
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n" + body
