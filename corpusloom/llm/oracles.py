"""DuckDB SQL for the results of the training-data queries."""

from __future__ import annotations

from corpusloom.llm import url_filters
from corpusloom.llm.quality_rules import ALPHA, DELTA, GRIDS, MAX_STRATA

W = r"[^\x20\x09-\x0D]+"

_GRID = ", ".join(f"({i}, {c})" for i, cs in enumerate(GRIDS.values()) for c in cs)

OP3 = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '{W}') AS w FROM docs),
p AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS c FROM p),
cov AS (SELECT rid, count(DISTINCT i + k) AS r FROM g, (VALUES (0), (1), (2)) AS t(k) WHERE c >= 2 GROUP BY rid),
lines AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs),
c AS (
  SELECT docs.rid, doc_id, lang, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words
  FROM docs JOIN w USING (rid) JOIN lines USING (rid) LEFT JOIN cov USING (rid)),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [1000 * n_symbols // greatest(n_words, 1), 1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // greatest(n_words, 1),
     1000 * word_chars // greatest(n_words, 1), -(1000 * word_chars // greatest(n_words, 1))] AS x,
    coalesce('=' || lang, 'null') AS own
  FROM c),
lab AS (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
grid AS (SELECT * FROM (VALUES {_GRID}) AS t(s, cut)),
rows0 AS (SELECT rid, own, q = 1 AS good, substr(md5('quality:' || doc_id), 1, 1) < '8' AS hold, x FROM f JOIN lab USING (doc_id) WHERE NOT base_failed),
large AS (SELECT own FROM (SELECT own, count(*) FILTER (good AND hold) AS most FROM rows0 GROUP BY own) ORDER BY most DESC, own LIMIT {MAX_STRATA}),
rows AS (SELECT *, row_number() OVER () AS r, CASE WHEN own IN (FROM large) THEN own ELSE 'other' END AS stratum FROM rows0),
fit AS (
  SELECT stratum, s, cut, count(*) FILTER (good) AS fg, count(*) FILTER (good AND x[s + 1] > cut) AS fgr, count(*) FILTER (NOT good) AS fb, count(*) FILTER (NOT good AND x[s + 1] > cut) AS fbr
  FROM rows, grid WHERE NOT hold GROUP BY stratum, s, cut),
seq AS (SELECT stratum, s, cut, row_number() OVER (PARTITION BY stratum ORDER BY (fgr + 1) / (fbr + 1), s, cut DESC) AS pos FROM fit WHERE fbr * fg > fgr * fb),
seen AS (SELECT stratum, r, min(pos) FILTER (x[s + 1] > cut) AS pos FROM rows JOIN seq USING (stratum) WHERE good AND hold GROUP BY stratum, r),
tried AS (
  SELECT stratum, s, cut, pos, (SELECT count(*) FROM seen WHERE seen.stratum = seq.stratum) AS n, (SELECT count(*) FROM seen WHERE seen.stratum = seq.stratum AND seen.pos <= seq.pos) AS k FROM seq),
tests AS (
  SELECT *, n > 0 AND k < n * {ALPHA} AND list_sum(list_transform(range(CAST(k AS BIGINT) + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({ALPHA}) + (n - i) * ln({1 - ALPHA}))))
      <= {DELTA} / ((SELECT count(*) FROM large) + 1) AS ok
  FROM tried),
best AS (SELECT stratum, s, min(cut) AS cut FROM (SELECT *, bool_and(ok) OVER (PARTITION BY stratum ORDER BY pos) AS passed FROM tests) WHERE passed GROUP BY stratum, s),
hits AS (SELECT DISTINCT rid FROM f JOIN best ON stratum = CASE WHEN own IN (FROM large) THEN own ELSE 'other' END AND x[s + 1] > cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rid NOT IN (FROM hits) AS kept FROM f
"""

OP5 = rf"""
WITH s AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{W}')) AS BIGINT) AS size, md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
src AS (SELECT source, sum(size) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM s GROUP BY source),
o AS (
  SELECT *, coalesce(sum(3 * source_size) OVER r, 0) AS clamped, coalesce(sum(w) OVER r, 0) AS wc, sum(w) OVER () AS wa, sum(source_size) OVER () AS total, row_number() OVER (ORDER BY 3 * source_size / w, source NULLS LAST) AS k
  FROM src WINDOW r AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stop AS (SELECT coalesce(min(k), 1e18) AS k FROM o WHERE w * CAST(total - clamped AS DOUBLE) / (wa - wc) <= 3 * source_size),
lvl AS (SELECT total - clamped AS rest, wa - wc AS wr FROM o WHERE k = (SELECT k FROM stop)),
t AS (SELECT source, source_size, CASE WHEN k < (SELECT k FROM stop) THEN CAST(3 * source_size AS DOUBLE) ELSE w * CAST((SELECT rest FROM lvl) AS DOUBLE) / CAST((SELECT wr FROM lvl) AS DOUBLE) END AS target FROM o),
g AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS goal FROM t),
d AS (
  SELECT s.*, CAST(source_size AS BIGINT) AS source_size, target, goal, goal // greatest(CAST(source_size AS BIGINT), 1) AS whole,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + least(greatest(goal - whole * source_size - before, 0), size) AS BIGINT) AS taken FROM d
"""

OP6 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (
  SELECT *, length('<|im_start|><|im_end|>') + 2 + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;'))
      + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) AS chars
  FROM t),
r AS (SELECT *, sum(chars) OVER w AS upto, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) = 1 AS final
  FROM f WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(coalesce(sum(upto) FILTER (role = 'assistant' OR final), 0) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""


def _op7() -> str:
    rules = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{'rule': '{h}{p}', 'verdict': '{v}'}}"
        for v, h, p in sorted(url_filters.RULES, key=lambda r: -len(r[1] + r[2]))
    )
    depth = url_filters.DEPTH
    number, number_ext, hexes, _ = (p for p, _ in url_filters.SHAPES)
    mixed = "regexp_full_match(x, '[A-Za-z0-9_.-]{12,}') AND regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Za-z]')"
    shape = f"CASE WHEN regexp_full_match(x, '{number}') THEN '{{number}}' WHEN regexp_full_match(x, '{number_ext}') THEN '{{number.ext}}' WHEN regexp_full_match(x, '{hexes}') THEN '{{hex}}' WHEN {mixed} THEN '{{id}}' ELSE x END"
    out = rf"""
WITH u0 AS (SELECT page_id, coalesce(lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)), '') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
u1 AS (SELECT *, CASE {rules} END AS r, string_split(rtrim(substr(path, 2), '/'), '/') AS raw FROM u0),
u AS (SELECT page_id, host, path, r, list_transform(CASE WHEN len(raw) > {depth + 1} THEN list_append(raw[1:{depth}], array_to_string(raw[{depth + 1}:], '/')) ELSE raw END, lambda x: {shape}) AS segs FROM u1),
r0 AS (SELECT host, segs, '' AS template, count(*) AS n, count(*) FILTER (r IS NOT NULL) AS labelled, count(*) FILTER (r.verdict = 'block') AS bad FROM u GROUP BY host, segs)"""
    u = url_filters

    def differ(x: str, n: str, y: str, m: str) -> str:
        pool = f"(({x} + {y}) / ({n} + {m}))"
        return f"abs({x} / {n} - ({y}) / ({m})) > {u.Z} * sqrt({pool} * (1 - {pool}) * (1 / {n} + 1 / ({m})))"

    for k in range(depth + 1):
        out += rf""",
s{k} AS (SELECT *, coalesce(segs[{k + 1}], '$') AS seg, CASE WHEN segs[{k + 2}] IS NULL THEN n ELSE 0 END AS ends, CASE WHEN starts_with(segs[{k + 2}], '{{') THEN n ELSE 0 END AS shaped FROM r{k}),
g{k} AS (SELECT host, template, seg, sum(n) AS n, sum(labelled) AS l, sum(bad) AS b, sum(ends) AS e, sum(shaped) AS g FROM s{k} GROUP BY host, template, seg),
c{k} AS (
  SELECT *, sum(n) OVER w AS an, sum(l) OVER w AS al, sum(b) OVER w AS ab, count(*) OVER w AS ac, coalesce(sum(n) FILTER (l = 0) OVER w, 0) AS un, coalesce(sum(e) FILTER (l = 0) OVER w, 0) AS ue, coalesce(sum(g) FILTER (l = 0) OVER w, 0) AS ug
  FROM g{k} WINDOW w AS (PARTITION BY host, template)),
k{k} AS (
  SELECT host, template, seg, CASE
    WHEN n = an THEN seg
    WHEN l > 0 THEN CASE WHEN n >= {u.MIN_CHILD} AND al > l AND {differ("b", "l", "ab - b", "al - l")} THEN seg ELSE '*' END
    WHEN ac >= {u.VARIABLE} AND an < {u.MIN_CHILD} * ac AND n < {u.MIN_CHILD} THEN '*'
    WHEN un = n THEN seg
    WHEN n >= {u.MIN_CHILD} AND ({differ("e", "n", "ue - e", "un - n")} OR {differ("g", "n", "ug - g", "un - n")}) THEN seg
    ELSE '~' END AS name
  FROM c{k}),
r{k + 1} AS (SELECT host, segs, template || '/' || name AS template, n, labelled, bad FROM s{k} JOIN k{k} USING (host, template, seg))"""
    return out + rf""",
per AS (SELECT host, template, sum(labelled) AS l, sum(bad) AS b FROM r{depth + 1} GROUP BY host, template),
whole AS (SELECT coalesce(sum(b), 0) / greatest(coalesce(sum(l), 0), 1) AS share FROM per)
SELECT page_id, u.host, path, r.rule AS rule, coalesce(r.verdict, CASE WHEN l >= {u.MIN_LABELS} AND (b + {u.PRIOR} * (SELECT share FROM whole)) / (l + {u.PRIOR}) >= {u.REJECT} THEN 'block' ELSE 'allow' END) AS verdict, t.template
FROM u JOIN r{depth + 1} t ON u.host = t.host AND u.segs = t.segs JOIN per ON per.host = t.host AND per.template = t.template
"""

OP9 = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < first THEN first END AS refers_to
FROM m
"""

SQL: dict[str, str] = {"op3_quality_rules": OP3, "op5_mixing": OP5, "op6_chat_format": OP6, "op7_url_filters": _op7(), "op9_warc": OP9}
