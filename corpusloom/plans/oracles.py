"""DuckDB SQL for the results of the curation queries."""

from __future__ import annotations

from corpusloom.config import Settings
from corpusloom.functions import filters, licence
from corpusloom.functions.text import CONTROLS, WORD, ZERO_WIDTH
from corpusloom.operators.profile import BUCKETS, LAST_BUCKET
from corpusloom.operators.sft import ROLES, SHAREGPT
from corpusloom.plans.queries import LICENCES, RATIOS

S = Settings()
_str = lambda x: "'" + x.replace("'", "''") + "'"
_list = lambda xs: "[" + ", ".join(map(_str, xs)) + "]"
# white space of Unicode, as a class
WS = r"\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
NL = r"\r\n|[\n\x0b\x0c\r\x{85}\x{2028}\x{2029}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def _raw_lines(x: str) -> str:
    return f"string_split(regexp_replace({x}, '{NL}', chr(10), 'g'), chr(10))"


def _lines(x: str) -> str:
    return f"list_filter(list_transform({_raw_lines(x)}, lambda l: {_strip('l')}), lambda l: l <> '')"


def _paragraphs(x: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({x}, '\\n[{WS}]*\\n'), lambda l: {_strip('l')}), lambda l: l <> '')"


def _words(x: str) -> str:
    return f"regexp_extract_all({x}, '{WORD}')"


def _length(x: str) -> str:
    return f"length(array_to_string({x}, ''))"


NORM = f"nfc_normalize(text)"
NORM = f"regexp_replace({NORM}, '[{ZERO_WIDTH}]', '', 'g')"
NORM = f"regexp_replace(regexp_replace(regexp_replace({NORM}, '{CONTROLS}', '', 'g'), '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"
NORM = _strip(NORM)
URL = "'https://' || source || '.example/' || doc_id"
HOST = "coalesce(regexp_extract({}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '')"

#: Statements read the relation d (doc_id, text); each gives the relation it names.
LID = f"""
lid0 AS (SELECT doc_id, regexp_replace(lower(text), '[^\\p{{L}}]+', '', 'g') AS letters, {_words("lower(text)")} AS lw FROM d),
lid1 AS (SELECT doc_id, length(letters) AS n, length(regexp_replace(letters, '[^{filters.VI_LETTERS}]+', '', 'g')) AS vi, length(regexp_replace(letters, '[^a-z]+', '', 'g')) AS a, lw FROM lid0),
lid AS (SELECT doc_id, CASE WHEN n = 0 THEN 'und' WHEN vi / n > 0.02 OR list_has_any(lw, {_list(filters.VI_STOPWORDS)}) THEN 'vi' WHEN a / n > 0.9 THEN 'en' ELSE 'und' END AS lang,
  CAST(CASE WHEN n = 0 THEN 0.0 WHEN vi / n > 0.02 THEN 0.9 WHEN list_has_any(lw, {_list(filters.VI_STOPWORDS)}) THEN 0.7 WHEN a / n > 0.9 THEN CASE WHEN list_has_any(lw, {_list(filters.EN_STOPWORDS)}) THEN 0.9 ELSE 0.65 END ELSE 0.3 END AS DOUBLE) AS score FROM lid1)"""
_allow = ", ".join(map(_str, S.clean.lang_allow))
_least = "CASE lang " + " ".join(f"WHEN {_str(k)} THEN {v}" for k, v in S.clean.lang_score_min.items()) + " ELSE 1.0 END"
LANG_REASON = f"CASE WHEN lang NOT IN ({_allow}) THEN 'lang_not_allowed:' || lang WHEN score < {_least} THEN 'lang_score_low:' || lang END"
_g = S.clean.gopher_quality
_bullet = f"substr(y, 1, 1) IN ({', '.join(map(_str, filters.BULLETS))})"
GOPHER = f"""
go0 AS (SELECT doc_id, text, lang, {_words("text")} AS w, {_lines("text")} AS l, length(regexp_replace(text, '[^#…]+', '', 'g')) AS s FROM d JOIN lid USING (doc_id)),
go AS (SELECT doc_id, CASE WHEN len(w) < {_g.min_words} OR len(w) > {_g.max_words} THEN 'gopher_word_count:' || len(w)
  WHEN lang <> 'vi' AND ({_length("w")} / len(w) < {_g.mean_word_length_min} OR {_length("w")} / len(w) > {_g.mean_word_length_max}) THEN 'gopher_mean_word_len:' || printf('%.1f', {_length("w")} / len(w))
  WHEN s / len(w) > {_g.symbol_to_word_ratio} THEN 'gopher_symbol_ratio'
  WHEN len(list_filter(l, lambda y: {_bullet})) / len(l) > {_g.bullet_line_ratio} THEN 'gopher_bullet_lines'
  WHEN len(list_filter(l, lambda y: ends_with(y, '…'))) / len(l) > {_g.ellipsis_line_ratio} THEN 'gopher_ellipsis_lines'
  WHEN len(list_filter(w, lambda y: regexp_matches(y, '[\\p{{L}}\\p{{Nl}}\\p{{No}}]'))) / len(w) < {_g.alpha_word_ratio} THEN 'gopher_alpha_ratio'
  WHEN len(list_intersect(list_distinct(list_transform(w, lambda y: lower(y))), CASE WHEN lang = 'vi' THEN {_list(filters.VI_STOPWORDS)} ELSE {_list(filters.EN_STOPWORDS)} END)) < {_g.min_stopwords} THEN 'gopher_stopwords' END AS reason FROM go0)"""


def _dups(parts: str) -> str:
    return f"CAST(len({parts}) AS BIGINT) AS n, CAST(len({parts}) - len(list_distinct({parts})) AS BIGINT) AS dups, CAST({_length(parts)} AS BIGINT) AS chars, CAST({_length(parts)} - {_length(f'list_distinct({parts})')} AS BIGINT) AS dup_chars"


def _grams(ns: tuple[int, ...] = (*filters.TOP_CAPS, *filters.DUP_CAPS)) -> str:
    out = f"gw AS (SELECT doc_id, {_words('text')} AS w FROM d),\ngc AS (SELECT doc_id, {_length('w')} AS chars FROM gw)"
    for n in ns:
        out += f""",
gp{n} AS (SELECT doc_id, i, w[i:i + {n - 1}] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM gw)),
gg{n} AS (SELECT doc_id, g, count(*) AS c, min(i) AS first, length(array_to_string(any_value(g), '')) AS k FROM gp{n} GROUP BY doc_id, g),
gr{n} AS (SELECT doc_id, {"CASE WHEN max(c) > 1 THEN arg_max(c * k, c * 1000000000 - first) ELSE 0 END" if n in filters.TOP_CAPS else "coalesce(sum(k) FILTER (c > 1), 0)"} AS x FROM gg{n} GROUP BY doc_id)"""
    cols = ", ".join(f"CAST(coalesce(gr{n}.x, 0) AS BIGINT) AS {'top' if n in filters.TOP_CAPS else 'dup'}_{n}" for n in ns)
    joins = " ".join(f"LEFT JOIN gr{n} USING (doc_id)" for n in ns)
    return out + f",\ngrams AS (SELECT doc_id, CAST(chars AS BIGINT) AS chars, {cols} FROM gc {joins})"


GRAMS = _grams()
_caps = " ".join(f"WHEN {kind}_{n} / gchars > {cap} THEN 'rep_{kind}_{n}gram'" for kind, caps in (("top", filters.TOP_CAPS), ("dup", filters.DUP_CAPS)) for n, cap in caps.items())
REPETITION = f"""
re0 AS (SELECT doc_id, {_lines("text")} AS l, {_paragraphs("text")} AS p FROM d),
re1 AS (SELECT doc_id, len(l) AS ln, len(l) - len(list_distinct(l)) AS ld, {_length("l")} AS lc, {_length("l")} - {_length("list_distinct(l)")} AS ldc, len(p) AS pn, len(p) - len(list_distinct(p)) AS pd, {_length("p")} AS pc, {_length("p")} - {_length("list_distinct(p)")} AS pdc FROM re0),
rep AS (SELECT doc_id, CASE WHEN ld / ln > {filters.LINE_CAP} THEN 'rep_dup_lines' WHEN ldc / lc > {filters.LINE_CHAR_CAP} THEN 'rep_dup_line_chars' WHEN pd / pn > {filters.PARA_CAP} THEN 'rep_dup_paras' WHEN pdc / pc > {filters.PARA_CHAR_CAP} THEN 'rep_dup_para_chars' {_caps} END AS reason
  FROM re1 JOIN (SELECT * RENAME (chars AS gchars) FROM grams) USING (doc_id))"""
_bad = " OR ".join(f"contains(lower(r), {_str(x)})" for x in filters.BAD_LINES)
_keep = f"{_strip('r')} = '' OR NOT ({_bad}) AND right({_strip('r')}, 1) IN ({', '.join(map(_str, filters.TERMINALS))})"
C4 = f"""
cc0 AS (SELECT doc_id, text, {_strip(f"array_to_string(list_filter({_raw_lines('text')}, lambda r: {_keep}), chr(10))")} AS c FROM d),
c4 AS (SELECT doc_id, CASE WHEN contains(lower(text), 'lorem ipsum') THEN text ELSE c END AS text, CASE WHEN contains(lower(text), 'lorem ipsum') THEN 'c4_lorem_ipsum' WHEN c = '' THEN 'c4_all_lines_dropped' END AS reason FROM cc0)"""
_n = f"len(list_filter(regexp_split_to_array(text, '[{WS}]+'), lambda x: x <> ''))"
SHRUNK = f"CASE WHEN {_n} < {_g.min_words} THEN 'c4_shrunk_words:' || {_n} END"
LISTY = f"CASE WHEN len({_lines('text')}) >= 3 AND len(list_filter({_lines('text')}, lambda y: {_bullet} OR len({_words('y')}) < 3)) / len({_lines('text')}) > 0.5 THEN 'fineweb_list_like' END"


def _twice(x: str, pattern: str, by: str) -> str:
    """A replacement between signs that may not be digits; twice, as two neighbours share such a sign."""
    for _ in range(2):
        x = f"regexp_replace({x}, '{pattern}', '{by}', 'g')"
    return x


EMAIL = f"regexp_replace(text, '[\\p{{L}}\\p{{N}}_.+-]+@[\\p{{L}}\\p{{N}}_-]+\\.[\\p{{L}}\\p{{N}}_.-]+', '[EMAIL]', 'g')"
PII = f"""
p1 AS (SELECT doc_id, text, {EMAIL} AS a FROM d),
p2 AS (SELECT *, {_twice("a", "(^|[^0-9])(?:[0-9]{1,3}[.]){3}[0-9]{1,3}($|[^0-9])", "\\1[IP]\\2")} AS b FROM p1),
p3 AS (SELECT *, {_twice("b", "(^|[^0-9+])(?:[+]84|0)[0-9]{9}($|[^0-9])", "\\1[PHONE]\\2")} AS c FROM p2),
p4 AS (SELECT *, {_twice("c", "(^|[^0-9])(?:[0-9]{12}|[0-9]{9})($|[^0-9])", "\\1[ID]\\2")} AS e FROM p3),
pii AS (SELECT doc_id, e AS text, array_to_string(list_filter([CASE WHEN a <> text THEN 'email' END, CASE WHEN b <> a THEN 'ip' END, CASE WHEN c <> b THEN 'phone_vn' END, CASE WHEN e <> c THEN 'cccd_cmnd' END], lambda x: x IS NOT NULL), ',') AS types FROM p4)"""
_N = S.clean.decontam.ngram


def _ngrams(rel: str, key: str) -> str:
    return f"SELECT DISTINCT {key}, array_to_string(w[i:i + {_N - 1}], ' ') AS g FROM (SELECT {key}, w, unnest(range(1, len(w) - {_N - 2})) AS i FROM (SELECT {key}, {_words('lower(text)')} AS w FROM {rel}))"


DECONTAM = f"""
bg AS (SELECT DISTINCT g FROM ({_ngrams("benchmark", "item_id")})),
dec AS (SELECT doc_id, count(*) AS n_hits FROM ({_ngrams("dd", "doc_id")}) JOIN bg USING (g) GROUP BY doc_id)"""
RAW = "WITH d AS (SELECT doc_id, text FROM documents)"
STATUS = f"""
WITH d AS (SELECT doc_id, {NORM} AS text FROM documents), {LID}, {GRAMS}, {REPETITION}, {GOPHER}, {C4},
f0 AS (SELECT d.doc_id, lid.lang, coalesce(CASE WHEN d.text = '' THEN 'no_text' END, {LANG_REASON.replace("lang", "lid.lang").replace("'lid.lang_not", "'lang_not").replace("'lid.lang_score", "'lang_score").replace("score <", "lid.score <")}, rep.reason, go.reason, c4.reason) AS reason, c4.text AS text
  FROM d JOIN lid USING (doc_id) JOIN rep USING (doc_id) JOIN go USING (doc_id) JOIN c4 USING (doc_id)),
f1 AS (SELECT doc_id, lang, text, coalesce(reason, {SHRUNK}, {LISTY}) AS reason FROM f0),
dd0 AS (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first FROM f1 WHERE reason IS NULL),
dd AS (SELECT * FROM dd0 WHERE first = doc_id), {DECONTAM},
status AS (SELECT f1.doc_id, f1.lang, f1.text, coalesce(f1.reason, CASE WHEN dd0.first < f1.doc_id THEN 'exact_dup' END, CASE WHEN n_hits > 0 THEN 'decontam' END) AS drop_reason FROM f1 LEFT JOIN dd0 USING (doc_id) LEFT JOIN dec ON dec.doc_id = f1.doc_id)"""
_tag = lambda k, mod: f"{_list(LICENCES)}[{k} % {mod} + 1]"
FACTS = f"""
WITH d AS (SELECT doc_id, text FROM documents), {PII},
facts AS (SELECT doc_id AS seq, lang, {_tag("doc_id", 4)} AS license, source || '.example' AS host, len({_words("documents.text")}) AS n_words, pii.types FROM documents JOIN pii USING (doc_id)),
b AS (SELECT *, CASE {" ".join(f"WHEN n_words < {n} THEN '{x}'" for x, n in BUCKETS)} ELSE '{LAST_BUCKET}' END AS bucket FROM facts)"""
_ratio = "CASE lang " + " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in RATIOS.items()) + " END"
MIX = f"""
WITH t AS (SELECT doc_id, lang, CAST(len({_words("text")}) AS BIGINT) AS tokens FROM documents),
b AS (SELECT lang, CAST(sum(tokens) AS BIGINT) AS tokens, CAST({_ratio} AS DOUBLE) AS ratio FROM t WHERE lang IN ({", ".join(map(_str, RATIOS))}) GROUP BY lang HAVING sum(tokens) > 0),
budgets AS (SELECT *, min(tokens / ratio) OVER () AS total, ratio * min(tokens / ratio) OVER () AS budget FROM b),
run AS (SELECT t.*, budget, CAST(coalesce(sum(t.tokens) OVER (PARTITION BY t.lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS used_before FROM t JOIN budgets USING (lang)),
sel AS (SELECT doc_id, lang, tokens, used_before FROM run WHERE used_before < budget)"""
_lic = " ".join(f"WHEN regexp_matches(lower(html), '{'|'.join(p)}') THEN '{t}'" for t, p in licence.PATTERNS.items())
_taglen = f"length({_strip("regexp_replace(html, '<[^>]+>', ' ', 'g')")})"
_root = "regexp_matches(html, '(?i)<div[^>]*id=[\"'']?(?:root|app)[\"'']?[^>]*>\\s*</div>')"
_scripts = "len(regexp_extract_all(html, '(?i)<script\\b'))"
CHATS = f"""
WITH c AS (SELECT conv_id, turn, role, text AS content, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos FROM conversations),
g AS (SELECT conv_id, substr(sha256(conv_id || chr(31)), 1, 16) AS id, {_tag("conv_id", 4)} AS license, CASE WHEN conv_id % 11 = 0 THEN 'no_provenance' WHEN conv_id % 4 = 2 THEN 'license_unknown'
  WHEN bool_or(role IS NULL OR role NOT IN ({", ".join(map(_str, ROLES))}) OR content IS NULL) THEN 'invalid_record' END AS drop_reason FROM c GROUP BY conv_id),
k AS (SELECT id, license, pos, role, content, conv_id FROM c JOIN g USING (conv_id) WHERE drop_reason IS NULL)"""

SQL: dict[str, str] = {
    "word_stats": f"SELECT doc_id, CAST(len({_words('text')}) AS BIGINT) AS n_words, CAST({_length(_words('text'))} AS BIGINT) AS n_word_chars, CAST(len({_lines('text')}) AS BIGINT) AS n_lines FROM documents",
    "normalize_text": f"SELECT doc_id, {NORM} AS text FROM documents",
    "stable_ids": f"SELECT doc_id, substr(sha256({URL} || chr(31) || 'htmlparser-fallback' || chr(31)), 1, 16) AS id, substr(sha256(sha256(text) || chr(31)), 1, 16) AS content_id FROM documents",
    "url_hosts": f"SELECT page_id, {HOST.format('url')} AS host FROM pages",
    "lang_detect": f"{RAW}, {LID} SELECT doc_id, lang, score FROM lid",
    "lang_gate": f"{RAW}, {LID} SELECT doc_id, {LANG_REASON} AS reason FROM lid",
    "gopher_quality_reason": f"{RAW}, {LID}, {GOPHER} SELECT doc_id, reason FROM go",
    "dup_line_frac": f"WITH p AS (SELECT doc_id, {_lines('text')} AS l FROM documents) SELECT doc_id, {_dups('l')} FROM p",
    "dup_para_frac": f"WITH p AS (SELECT doc_id, {_paragraphs('text')} AS l FROM documents) SELECT doc_id, {_dups('l')} FROM p",
    "top_ngram_frac": f"{RAW}, {_grams(tuple(filters.TOP_CAPS))} SELECT doc_id, {', '.join(f'top_{n}' for n in filters.TOP_CAPS)} FROM grams",
    "dup_ngram_frac": f"{RAW}, {_grams(tuple(filters.DUP_CAPS))} SELECT doc_id, chars, {', '.join(f'dup_{n}' for n in filters.DUP_CAPS)} FROM grams",
    "repetition_reason": f"{RAW}, {GRAMS}, {REPETITION} SELECT doc_id, reason FROM rep",
    "c4_clean": f"{RAW}, {C4} SELECT doc_id, text, reason FROM c4",
    "c4_shrunk": f"{RAW}, {C4} SELECT doc_id, {SHRUNK} AS reason FROM c4",
    "list_like": f"SELECT doc_id, {LISTY} AS reason FROM documents",
    "exact_dup": "SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first_seq, min(doc_id) OVER (PARTITION BY text) < doc_id AS is_dup FROM documents",
    "decontam_hits": f"WITH dd AS (SELECT doc_id, text FROM documents), {DECONTAM} SELECT doc_id, n_hits FROM dec",
    "pii_types": f"{RAW}, {PII} SELECT doc_id, types FROM pii",
    "pii_redact": f"{RAW}, {PII} SELECT doc_id, text FROM pii",
    "clean_status": f"{STATUS} SELECT doc_id, drop_reason FROM status",
    "clean_funnel": f"{STATUS} SELECT coalesce(split_part(drop_reason, ':', 1), 'kept') AS reason, count(*) AS n FROM status GROUP BY 1",
    "clean_docs": f"{STATUS}, kept AS (SELECT doc_id, lang, text FROM status WHERE drop_reason IS NULL), {PII.replace(' FROM d)', ' FROM kept)')} SELECT doc_id, substr(sha256(sha256(kept.text) || chr(31)), 1, 16) AS id, pii.text AS text, lang, types AS pii_found, 'unknown' AS license, false AS is_publishable, 'lid,gopher,c4,fineweb,dedup,pii,decontam' AS filters_passed FROM kept JOIN pii USING (doc_id)",
    "provenance_problems": f"WITH x AS (SELECT doc_id, {_list((*LICENCES, 'unknown'))}[doc_id % 5 + 1] AS license FROM documents) SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'source_url' END AS problem, license, license <> 'unknown' AS is_publishable FROM x",
    "profile_lang": f"{FACTS} SELECT lang, count(*) AS n FROM b GROUP BY lang",
    "profile_distributions": f"{FACTS} " + " UNION ALL ".join(f"SELECT '{m}' AS metric, {c} AS key, count(*) AS n FROM b GROUP BY {c}" for m, c in (("lang", "lang"), ("license", "license"), ("host", "host"), ("length", "bucket"))),
    "profile_length_hist": f"{FACTS} SELECT bucket, count(*) AS n FROM b GROUP BY bucket",
    "profile_length_stats": f"{FACTS} SELECT count(*) AS n_docs, min(n_words) AS min_words, max(n_words) AS max_words, round(avg(n_words), 1) AS mean_words, median(n_words) AS median_words, count(*) FILTER (n_words < 50) AS near_empty FROM b",
    "profile_domain_top50": f"{FACTS} SELECT host, count(*) AS n, min(seq) AS first_seq FROM b GROUP BY host ORDER BY n DESC, first_seq LIMIT 50",
    "profile_pii": f"{FACTS} SELECT type, count(*) AS n FROM (SELECT unnest(string_split(types, ',')) AS type FROM b WHERE types <> '') GROUP BY type",
    "profile_suggestions": f"{FACTS}, a AS (SELECT count(*) AS docs FROM b), t AS (SELECT 'host' AS kind, host AS key, count(*) AS n FROM b GROUP BY host UNION ALL SELECT 'lang', lang, count(*) FROM b GROUP BY lang) SELECT kind, key, n FROM t, a WHERE n > 0.8 * docs AND (kind = 'host' OR n < docs) UNION ALL SELECT 'license', 'unknown', count(*) FROM b WHERE license = 'unknown' HAVING count(*) > 0 UNION ALL SELECT 'near_empty', '', n FROM (SELECT count(*) FILTER (n_words < 50) AS n, count(*) AS docs FROM b) WHERE n > 0.3 * docs",
    "mix_budget": f"{MIX} SELECT lang, tokens, ratio, total, budget FROM budgets",
    "mix_selected": f"{MIX} SELECT doc_id, lang, tokens, used_before FROM sel",
    "mix_manifest": f"{MIX} SELECT lang, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS docs, CAST({_ratio} AS DOUBLE) AS ratio_target, round(sum(tokens) / sum(sum(tokens)) OVER (), 3) AS ratio_real FROM sel GROUP BY lang",
    "html_license": f"SELECT page_id, CASE {_lic} ELSE 'unknown' END AS license FROM pages",
    "html_links": f"WITH l AS (SELECT page_id, url, list_filter(regexp_extract_all(html, '(?i)<a\\b[^>]*?href=[\"'']([^\"''#]+)', 1), lambda h: NOT regexp_matches(h, '^(mailto|javascript|tel):')) AS l FROM pages), u AS (SELECT page_id, url, l, unnest(range(len(l))) AS pos FROM l) SELECT page_id, pos, regexp_extract(url, '^[a-z]+://[^/?#]*') || l[pos + 1] AS link FROM u",
    "html_render_mode": f"SELECT page_id, CASE WHEN {_root} AND {_scripts} >= 3 AND {_taglen} < 500 OR {_taglen} < 200 AND {_scripts} >= 5 THEN 'browser' ELSE 'http' END AS render, {_taglen} < 200 OR {_root} AS needs_render FROM pages",
    "html_feeds": "SELECT page_id, '/feed/' || page_id || '.xml' AS feed FROM pages",
    "robots_rules": "SELECT page_id, CAST(page_id AS DOUBLE) AS crawl_delay, least(greatest(1.0, CAST(page_id AS DOUBLE)), 30.0) AS delay, url AS sitemaps, '/en/' AS disallow, NOT starts_with(regexp_extract(url, '^[a-z]+://[^/?#]*([^#]*)', 1), '/en/') AS allowed FROM pages",
    "sitemap_urls": f"SELECT page_id, CAST(0 AS BIGINT) AS pos, url AS loc FROM pages UNION ALL SELECT page_id, 1, {HOST.format('url')} FROM pages",
    "source_profiles": f"SELECT url, CASE WHEN {_root} AND {_scripts} >= 3 AND {_taglen} < 500 OR {_taglen} < 200 AND {_scripts} >= 5 THEN 'browser' ELSE 'http' END AS render, CAST(2 AS DOUBLE) AS crawl_delay, CASE {_lic} ELSE 'unknown' END AS license, 'text/html' AS content_type, 'https://a.example/' AS seed_urls, '/x' AS disallow, true AS fetched FROM pages",
    "crawl_frontier": "WITH RECURSIVE s(k, depth) AS (SELECT page_id, 0 FROM pages WHERE page_id % 64 = 0 UNION ALL SELECT k - k % 64 + unnest(range(4 * (k % 64) + 1, least(4 * (k % 64) + 5, 64))), depth + 1 FROM s WHERE depth < 6 AND k IN (SELECT page_id FROM pages) AND k % 20 <> 5), "
    "u AS (SELECT depth, CASE k // 64 % 2 WHEN 0 THEN 'site' ELSE 'other' END AS host, 'https://' || host || '.example/' || (k % 20) || '/' || k AS url, CASE WHEN k % 20 = 5 THEN 'url_excluded' WHEN k % 20 = 7 AND host = 'site' THEN 'robots_disallowed' WHEN k NOT IN (SELECT page_id FROM pages) THEN 'fetch_failed' END AS outcome FROM s), "
    "h AS (SELECT *, row_number() OVER (PARTITION BY host, outcome IS NULL ORDER BY depth, url) <= 100 AS under FROM u), p AS (SELECT *, row_number() OVER (PARTITION BY outcome IS NULL, under ORDER BY depth, url) AS place FROM h) "
    "SELECT url, depth, CASE WHEN outcome IS NOT NULL THEN outcome WHEN NOT under THEN 'host_cap' WHEN place > 150 THEN 'page_cap' ELSE 'fetched' END AS outcome FROM p",
    "sft_gate": f"{CHATS} SELECT conv_id, drop_reason FROM g",
    "sft_chatml": f"{CHATS} SELECT id, pos, role, content FROM k",
    "sft_sharegpt": f"{CHATS} SELECT id, pos, CASE role {' '.join(f'WHEN {_str(a)} THEN {_str(b)}' for a, b in SHAREGPT.items())} END AS speaker, content AS value FROM k",
    "sft_alpaca": f"{CHATS} SELECT id, coalesce(first(content ORDER BY pos) FILTER (role = 'user'), '') AS instruction, '' AS input, coalesce(first(content ORDER BY pos) FILTER (role = 'assistant'), last(content ORDER BY pos)) AS output, any_value(license) AS license, any_value(license) <> 'unknown' AS is_publishable FROM k GROUP BY id",
    "synth_qa": "WITH x AS (SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(text, '') AS t FROM documents) SELECT id, CAST(0 AS BIGINT) AS n, 'How long is it? ' || length(t) AS question, CAST(NULL AS VARCHAR) AS drop_reason, substr(sha256(id || chr(31) || '0' || chr(31)), 1, 16) AS synth_id FROM x",
    "jsonl_round_trip": "SELECT *, false AS bad_json FROM documents",
}
