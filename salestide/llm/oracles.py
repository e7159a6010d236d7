"""DuckDB SQL for the rows of those queries that SQL can express, for checking only.

The others have none: learned or random models (page text, mix), signatures (lines), a few
hundred expressions with look-ahead (licenses), places of matches (personal data), template
windows with typed slots (benchmark), binary records (WARC) and two tokenizers (links). Tests hold those against
plain versions, exact round trips or held-out labels.
"""

from __future__ import annotations

from salestide.llm.quality_rules import Limits
from salestide.llm.rows import LOWER, UPPER

WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"

SHINGLE_JOIN = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS shingle
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON reach.other = ways.a),
tops AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents JOIN tops USING (doc_id) LEFT JOIN sizes USING (doc_id)"""


def _quality() -> str:
    limits = Limits()
    rules = {
        "short": f"n_words < {limits.min_words}",
        "repeats": f"100 * n_repeat_words > {limits.repeat_percent} * n_words",
        "symbols": f"100 * n_symbols > {limits.symbol_percent} * n_words",
        "dup_lines": f"100 * n_dup_lines > {limits.dup_line_percent} * n_lines",
    }

    def each(form: str) -> str:
        return ", ".join(form.replace("$", name) for name in rules)

    weight = f"""least(greatest(CASE WHEN s_$ / total - m_$ * (1 - m_$) * hosts / total > 0
      THEN m_$ * (1 - m_$) / (s_$ / total - m_$ * (1 - m_$) * hosts / total) - 1
      ELSE {limits.prior_most} END, {limits.prior_least}), {limits.prior_most}) AS w_$"""
    return f"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS place,
    unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS said
  FROM texts WHERE len(w) >= 3),
often AS (
  SELECT doc_id, place FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, said) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT place + k) AS n_repeat_words
  FROM often, range(3) AS steps(k) GROUP BY doc_id),
features AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM texts LEFT JOIN repeats USING (doc_id)),
tried AS (SELECT *, {", ".join(f"{rule} AS f_{name}" for name, rule in rules.items())} FROM features),
hosts AS (
  SELECT source, count(*) AS n, {each("sum(f_$::INT) AS f_$")} FROM tried GROUP BY source),
means AS (
  SELECT sum(n) AS total, count(*) AS hosts, {each("sum(f_$) / sum(n) AS m_$")} FROM hosts),
spreads AS (SELECT {each("sum(n * pow(f_$ / n - m_$, 2)) AS s_$")} FROM hosts, means),
priors AS (SELECT means.*, {each(weight)} FROM means, spreads),
verdicts AS (
  SELECT source, greatest({each("(f_$ + m_$ * w_$) / (n + w_$)")}) > {limits.host_rate} AS rejected
  FROM hosts, priors)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  f_short OR f_repeats AS base_failed, NOT (f_short OR f_repeats) AND NOT rejected AS kept
FROM tried JOIN verdicts ON tried.source IS NOT DISTINCT FROM verdicts.source"""


def _escaped(text: str) -> str:
    return f"regexp_replace({text}, '(\\\\|###|</turn>|<(?:image|audio|document)\\|)', '\\\\\\1', 'g')"


def _chat(control: str) -> str:
    return f"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{control}' UNION ALL SELECT -7, 1, 'assistant', '{control}'),
whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS said,
    coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
    sum(length('### ' || replace({_escaped("role")}, ':', '\\:') || ': ' || {_escaped("text")} || '</turn>' || chr(10)))
      AS chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars
FROM whole"""


NEGATIVES = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM met WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank
FROM positives JOIN met USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""


def _url_verdicts() -> str:
    rules = [
        ("net", "/", "block"),
        ("example.net", "/en/", "allow"),
        ("example.com", "/de/", "block"),
        ("org", "/fr/", "allow"),
    ]
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in rules)
    host = f"translate(regexp_extract({{0}}, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"
    path = "regexp_extract({0}, '://[^/?#]*([^?#]*)', 1)"
    node = f"CASE WHEN contains({{0}}, '://') THEN [{host}, {path}, regexp_extract({{0}}, '://[^?#]*(\\?[^#]*)', 1)] END"
    field = (
        "trim(replace(replace(replace(regexp_replace(list_filter(list_zip("
        r"""regexp_extract_all(tag, '([^\s"''<>/=]+)\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), """
        r"""regexp_extract_all(tag, '([^\s"''<>/=]+)\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 2)), """
        """lambda p: lower(p[1]) = '{0}')[1][2], '^["'']|["'']$', '', 'g'), '&amp;', '&'), '&#38;', '&'), '&#x26;', '&'))"""
    )
    walked = r"""(SELECT '/' || array_to_string(s, '/') || CASE WHEN len(s) > 0 AND regexp_matches({0}, '/\.\.?$') THEN '/' ELSE '' END
      FROM (SELECT list_reduce(string_split({0}, '/')[2:], lambda d, x: CASE WHEN x = '..' THEN d[:greatest(len(d) - 1, 0)] WHEN x = '.' THEN d ELSE d || [x] END, []::VARCHAR[]) AS s))"""
    base = "lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || '://' || regexp_extract(url, '://([^/?#]*)', 1)"
    own, query = "regexp_extract(bare, '^([^?]*)', 1)", r"regexp_extract(bare, '(?s)(\?.*)$', 1)"
    beside = f"CASE WHEN beside = '' THEN '/' ELSE beside END || {own}"
    return rf"""
WITH RECURSIVE rules(host, path, verdict) AS (VALUES {values}),
tags AS (
  SELECT DISTINCT url, unnest(regexp_extract_all(
    regexp_replace(html, '(?is)<!--.*?(?:-->|\z)|<(?:script|style)\b.*?(?:</(?:script|style)|\z)', ' ', 'g'),
    '(?i)<(?:link|meta)[\s/](?:[^>"'']|"[^"]*"|''[^'']*'')*>')) AS tag
  FROM pages WHERE contains(url, '://') AND regexp_matches(html, '(?i)canonical|refresh')),
links AS (
  SELECT url, CASE
    WHEN lower(tag[2:5]) = 'link' AND list_contains(regexp_split_to_array(lower({field.format("rel")}), '\s+'), 'canonical')
      THEN {field.format("href")}
    WHEN lower(tag[2:5]) = 'meta' AND lower({field.format("http-equiv")}) = 'refresh'
      THEN nullif(trim(regexp_extract({field.format("content")}, '(?is)^\s*[0-9.]*\s*[;,]?\s*url\s*=\s*["'']?\s*([^"'']*)', 1)), '')
    END AS link FROM tags),
bare AS (
  SELECT url, regexp_replace(link, '(?s)#.*$', '') AS bare,
    regexp_replace({path.format("url")}, '[^/]*$', '') AS beside
  FROM links WHERE link IS NOT NULL),
resolved AS (
  SELECT url, CASE
    WHEN regexp_matches(bare, '^(?i)https?:') AND contains(bare, '://') THEN bare
    WHEN regexp_matches(bare, '^[A-Za-z][A-Za-z0-9+.-]*:') OR bare = '' THEN NULL
    WHEN starts_with(bare, '//') THEN lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || ':' || bare
    WHEN starts_with(bare, '?') THEN {base} || {path.format("url")} || bare
    WHEN starts_with(bare, '/') THEN {base} || {walked.format(own)} || {query}
    ELSE {base} || {walked.format(beside)} || {query} END AS target
  FROM bare),
edges AS (
  SELECT {node.format("url")} AS a, {node.format("target")} AS b FROM resolved
  WHERE contains(target, '://')),
ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT a, a AS b FROM ways UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a),
ruled AS (
  SELECT node, arg_max(rules.host || rules.path, length(rules.host || rules.path)) AS rule,
    arg_max(verdict, length(rules.host || rules.path)) AS verdict
  FROM (SELECT b AS node FROM reach UNION SELECT {node.format("url")} FROM pages) nodes
  JOIN rules ON (node[1] = rules.host OR ends_with(node[1], '.' || rules.host)) AND starts_with(node[2], rules.path)
  GROUP BY node),
passed AS (
  SELECT a AS node FROM reach JOIN ruled ON ruled.node = reach.b
  GROUP BY a HAVING bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow'))
SELECT page_id, coalesce({host.format("url")}, '') AS host, coalesce({path.format("url")}, '') AS path, rule,
  coalesce(verdict, CASE WHEN passed.node IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM pages LEFT JOIN ruled ON ruled.node = {node.format("url")}
LEFT JOIN passed ON passed.node = {node.format("url")}"""


URL_VERDICTS = _url_verdicts()
QUALITY = _quality()
CHAT = _chat("\\### Assistant: </turn> ok")
