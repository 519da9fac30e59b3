"""DuckDB SQL for the operators that SQL can express; written from the contracts, apart from the Spark code.
Rule lists, patterns and parameters are the operators' own."""

from __future__ import annotations

from tracewright.llm import quality_rules as Q
from tracewright.llm import url_filters as U
from tracewright.llm import vector_codes as V
from tracewright.llm.mixing import SEED, WORD

_SPACES = "[\\x20\\x09-\\x0D]+"


def _quality_rules() -> str:
    stock = " OR ".join(f"contains(lower(line), '{p}')" for p in Q.BOILERPLATE)
    end_mark = Q.END_MARK.replace("'", "''")
    n = "length(line) - length(regexp_replace(line, '{}', '', 'g'))"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{_SPACES}'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{Q.HAS_WORD}')) AS lines FROM d),
pos AS (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 7], ' ')) AS n FROM pos),
rep AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS step FROM win WHERE n > 1),
cov AS (SELECT doc_id, sum(step) AS n_repeat FROM rep GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(lines) AS line FROM w),
judged AS (SELECT doc_id, length(line) AS chars,
     NOT regexp_matches(line, '{end_mark}')
     OR ({n.format('!!')}) / 2 >= {Q.SHOUTS}
     OR {n.format('[|]')} >= {Q.NAVIGATION_BARS}
     OR ({n.format(Q.SYMBOLS)}) * 100 > length(line) * {Q.SYMBOL_SHARE}
     OR {stock} AS fails FROM ln),
lost AS (SELECT doc_id, sum(chars) AS chars, sum(CASE WHEN fails THEN chars ELSE 0 END) AS lost FROM judged GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
     CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
     CAST(length(text) - length(regexp_replace(text, '{Q.SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
     CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
     CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words, coalesce(lost, 0) AS lost, coalesce(chars, 0) AS chars
   FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id LEFT JOIN lost ON lost.doc_id = w.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= 50 * chars AS kept FROM b"""


def _url_filters() -> str:
    def sub(h: str) -> str:
        return f"(host = '{h}' OR ends_with(host, '.{h}'))"

    hosts = [(r.name, r.verdict, *r.name.split("/", 1)) for r in U.HOST_RULES]
    cases = "".join(f"WHEN {sub(h)} AND starts_with(path, '/{p}') THEN '{name}' "
                    for name, _, h, p in sorted(hosts, key=lambda x: (-len(x[0]), x[0])))
    verdicts = "".join(f"WHEN rule = '{name}' THEN '{v}' " for name, v, _, _ in hosts)
    pats = "".join("WHEN regexp_matches(host || path, '{}') THEN '{}' ".format(r.pattern, r.name)
                   for r in sorted(U.PATTERN_RULES, key=lambda r: (len(r.name), r.name), reverse=True))
    return f"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{U.UPPER}', '{U.LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT *, CASE {cases} END AS rule FROM b),
d AS (SELECT *, CASE WHEN rule IS NOT NULL THEN NULL {pats} END AS pattern FROM c)
SELECT page_id, host, path, rule, pattern,
       CASE {verdicts} WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict FROM d"""


def source_mixing(documents: str = "documents") -> str:
    """Row-wise result of mixing ``documents`` (a table or view name)."""
    return f"""
WITH d AS (SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '{WORD}')) END AS BIGINT) AS size,
     CASE WHEN length(coalesce(text, '')) > 0 THEN greatest(0.1::DOUBLE, 1 - ((length(text)
        - length(regexp_replace(text, '[#*$%&|<>]', '', 'g'))) * 10)::DOUBLE / length(text)::DOUBLE) ELSE 0.1::DOUBLE END AS q,
     (('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12))::BIGINT::DOUBLE + 0.5) / {1 << 48}::DOUBLE AS u
   FROM {documents}),
k AS (SELECT doc_id, source, size, (-ln(u)) / q AS e FROM d),
t AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM k GROUP BY source),
t1 AS (SELECT *, (((place - 1) % 3) + 1)::DOUBLE AS weight, source_size * 3.0::DOUBLE AS most FROM t),
t2 AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / weight, place
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY most / weight, place
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM t1),
lv AS (SELECT level FROM t2 WHERE most / weight >= level ORDER BY most / weight, place LIMIT 1),
t3 AS (SELECT source, source_size, most, least(most, coalesce((SELECT level FROM lv) * weight, most)) AS target FROM t2),
t4 AS (SELECT *, CASE WHEN source_size = 0 THEN 0 WHEN target >= most THEN 3 ELSE floor(target / source_size) END::BIGINT AS epochs FROM t3),
t5 AS (SELECT *, greatest(target - epochs * source_size, 0) AS rest FROM t4),
g AS (SELECT source, e, doc_id, sum(size) AS size FROM k WHERE size > 0 GROUP BY source, e, doc_id),
p AS (SELECT g.*, sum(size) OVER (PARTITION BY source ORDER BY e, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto FROM g),
r AS (SELECT p.*, rest, upto <= rest AS chosen FROM p JOIN t5 ON p.source IS NOT DISTINCT FROM t5.source),
gap AS (SELECT source, any_value(rest) - coalesce(max(CASE WHEN chosen THEN upto END), 0) AS gap FROM r GROUP BY source),
f AS (SELECT r.source, r.e, r.doc_id, row_number() OVER (PARTITION BY r.source ORDER BY abs(gap - size), e, doc_id NULLS FIRST) AS nth
      FROM r JOIN gap ON r.source IS NOT DISTINCT FROM gap.source WHERE NOT chosen AND abs(gap - size) < gap),
picked AS (SELECT source, e, doc_id FROM r WHERE chosen UNION ALL SELECT source, e, doc_id FROM f WHERE nth = 1)
SELECT k.doc_id, k.size, t5.source_size, t5.target,
       (k.size * (t5.epochs + CASE WHEN picked.e IS NOT NULL AND k.size > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM k JOIN t5 ON k.source IS NOT DISTINCT FROM t5.source
LEFT JOIN picked ON k.source IS NOT DISTINCT FROM picked.source AND k.e = picked.e AND k.doc_id IS NOT DISTINCT FROM picked.doc_id"""


QUALITY_RULES = _quality_rules()
URL_FILTERS = _url_filters()
SOURCE_MIXING = source_mixing()


def vector_codes(rounds: int = V.ROUNDS) -> str:
    """Lloyd rounds as one pair of tables each; for ids that are not null and vectors of one length."""
    parts = f"least({V.PARTS - 1}, (({V.PARTS} * j + {V.PARTS - 1}) // d))"  # the last part that begins at or before component j
    rounds_sql = "".join(f""",
a{r} AS MATERIALIZED (SELECT i, p, arg_min(e, dist * 100 + e) AS e, min(dist) AS dist FROM
   (SELECT x.i, x.p, b.e, sum((x.x - b.c) * (x.x - b.c)) AS dist FROM x JOIN b{r} b ON b.p = x.p AND b.j = x.j GROUP BY x.i, x.p, b.e) GROUP BY i, p),
b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, b.j, coalesce(n.c, b.c) AS c FROM b{r} b LEFT JOIN
   (SELECT p, e, j, ((s - (((s % n) + n) % n)) // n)::BIGINT AS c FROM
      (SELECT x.p, a.e, x.j, sum(x.x)::BIGINT AS s, count(*) AS n FROM x JOIN a{r} a ON a.i = x.i AND a.p = x.p GROUP BY x.p, a.e, x.j)) n
   ON n.p = b.p AND n.e = b.e AND n.j = b.j)""" for r in range(1, rounds + 1))
    last = rounds + 1
    return f"""
WITH k AS (SELECT vec_id AS i, label, embedding AS v, len(embedding) AS d FROM embeddings WHERE embedding IS NOT NULL
   AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (SELECT i, j, {parts} AS p, floor({V.SCALE} * v[j + 1]::DOUBLE)::BIGINT AS x FROM (SELECT i, d, v, unnest(range(d)) AS j FROM k)),
s AS (SELECT i, row_number() OVER (ORDER BY i) - 1 AS e FROM k ORDER BY i LIMIT {V.ENTRIES}),
b1 AS MATERIALIZED (SELECT x.p, s.e, x.j, x.x AS c FROM x JOIN s ON s.i = x.i){rounds_sql},
f AS (SELECT i, p, arg_min(e, dist * 100 + e) AS e, min(dist) AS dist FROM
   (SELECT x.i, x.p, b.e, sum((x.x - b.c) * (x.x - b.c)) AS dist FROM x JOIN b{last} b ON b.p = x.p AND b.j = x.j GROUP BY x.i, x.p, b.e) GROUP BY i, p),
g AS (SELECT i, string_agg(printf('%02x', e::BIGINT), '' ORDER BY p) AS code, sum(dist)::BIGINT AS error FROM f GROUP BY i),
h AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM b{last})
SELECT k.i AS vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM k JOIN g ON g.i = k.i, h"""


VECTOR_CODES = vector_codes()

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, octet_length(encode(html))::BIGINT AS n, sha256(html) AS digest, min(page_id) OVER (PARTITION BY html) AS least FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN n >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> least THEN least END AS refers_to FROM q"""
