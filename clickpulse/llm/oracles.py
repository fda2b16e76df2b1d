"""DuckDB SQL that must give the same rows as the queries, where SQL can express them."""

from __future__ import annotations

from clickpulse.llm.licenses import COPYRIGHT_LINE, LICENSES, SPELLINGS
from clickpulse.llm.lines import BOILERPLATE, ENDED, NAVIGATION
from clickpulse.llm.queries import URL_RULES
from clickpulse.llm.urls import SOFT, SOFT_HITS, STRICT

_W = r"[^\x20\x09-\x0D]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def line_quality(table: str = "documents") -> str:
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{_W}+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_W}')) AS lines
  FROM {table}
), windows AS (
  SELECT doc_id, i, w[i:i + 7] AS span
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, span) AS n FROM windows)
  WHERE n > 1
), hit AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(8) AS t(k) GROUP BY doc_id
), line AS (
  SELECT doc_id, x, len(regexp_extract_all(x, '{_W}+')) AS n_words,
    length(regexp_replace(x, '[\\x20\\x09-\\x0D]+', '', 'g')) AS n_chars
  FROM (SELECT DISTINCT doc_id, unnest(lines) AS x FROM d)
), good AS (
  SELECT doc_id, sum(n_chars) AS n FROM line
  WHERE regexp_matches(x, '[\\p{{L}}\\p{{N}}]')
    AND 100 * (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g'))) <= 10 * n_chars
    AND 100 * len(regexp_extract_all(x, '[!?]{{2,}}|\\.{{3,}}')) <= 20 * n_words
    AND NOT (n_words >= 3 AND regexp_matches(x, '\\p{{Lu}}') AND NOT regexp_matches(x, '\\p{{Ll}}'))
    AND NOT (n_words <= 8 AND regexp_matches(x, {_quoted(NAVIGATION)})
      AND NOT regexp_matches(x, '{ENDED}'))
    AND NOT (n_words <= 16 AND regexp_matches(x, {_quoted(BOILERPLATE)}))
  GROUP BY doc_id
), base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(hit.n, 0)::BIGINT AS n_repeat_words, coalesce(good.n, 0) AS n_good
  FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN good USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
    AND 100 * n_good >= 50 * word_chars AS kept
FROM base"""


def _plain_words(text: str) -> str:
    lowered = (
        f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        "'abcdefghijklmnopqrstuvwxyz')"
    )
    return f"regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def contamination(table: str = "documents") -> str:
    return f"""
WITH d AS (SELECT doc_id, {_plain_words("text")} AS w FROM {table}
), b AS (
  SELECT item_id::VARCHAR AS item, w, least(10, len(w)) AS n
  FROM (SELECT item_id, {_plain_words("text")} AS w FROM benchmark) WHERE len(w) > 0
), phrases AS (
  SELECT DISTINCT item, n, w[i:i + n - 1] AS phrase
  FROM (SELECT item, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM b)
), places AS (
  SELECT doc_id, n, i, w[i:i + n - 1] AS phrase
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM b) WHERE len(w) >= n)
), found AS (SELECT doc_id, item, n, i FROM places JOIN phrases USING (n, phrase)
), hit AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM found, range(10) AS t(k) WHERE k < n GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _license_form(text: str) -> str:
    form = rf"regexp_replace({text}, '\r\n?', chr(10), 'g')"
    form = f"lower(regexp_replace({form}, '{COPYRIGHT_LINE}', '', 'g'))"
    form = f"replace({form}, 'https://', 'http://')"
    form = rf"concat(' ', regexp_replace({form}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' ')"
    form = f"regexp_replace({form}, ' +', ' ', 'g')"
    for old, new in SPELLINGS:
        form = f"replace({form}, ' {old} ', ' {new} ')"
    return f"CASE WHEN {text} IS NOT NULL THEN trim({form}) END"


def license_digests() -> str:
    known = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in LICENSES.items())
    return f"""
WITH known AS (
  SELECT sha256({_license_form("t")}) AS digest, min(name) AS license
  FROM (VALUES {known}) v(name, t) GROUP BY 1
), scanned AS (
  SELECT doc_id, CASE WHEN f <> '' THEN sha256(f) END AS digest
  FROM (SELECT doc_id, {_license_form("text")} AS f FROM documents)
)
SELECT doc_id, digest, license FROM scanned LEFT JOIN known USING (digest)"""


def url_vocabulary() -> str:
    lowered = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def count(terms: tuple[str, ...]) -> str:
        one = "regexp_matches(u, '(^|[^a-z0-9]){}([^a-z0-9]|$)')::INT"
        return " + ".join(one.format(term) for term in terms)

    rules = ", ".join(
        "('{}', '{}', '{}', '/{}')".format(rule, verdict, *rule.split("/", 1))
        for rule, verdict in URL_RULES.items()
    )
    return f"""
WITH parts AS (
  SELECT page_id, {lowered} AS u,
    CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest
  FROM pages
), p AS (
  SELECT page_id, u,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts
), r AS (SELECT * FROM (VALUES {rules}) v(rule, verdict, domain, start))
, fit AS (
  SELECT page_id, u, host, path,
    (SELECT arg_max(struct_pack(rule := rule, verdict := verdict), length(rule)) FROM r
     WHERE (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start)) AS fit
  FROM p
)
SELECT page_id, host, path, fit.rule AS rule,
  coalesce(fit.verdict, CASE WHEN {count(STRICT)} > 0 OR {count(SOFT)} >= {SOFT_HITS}
    THEN 'block' ELSE 'allow' END) AS verdict
FROM fit"""


def walsh_clusters(table: str = "embeddings", k: int = 8, rounds: int = 10) -> str:
    """Every round written out, with plain distances; sums and their floors are integers."""
    kept = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64"
    steps = [
        f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding,
    lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM {table} WHERE {kept}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS n, v
  FROM (SELECT v, sha256('3:' || vec_id) AS h FROM v ORDER BY h, v LIMIT {k})
)"""
    ]
    for r in range(rounds + 1):
        steps.append(f""", a{r} AS MATERIALIZED (
  SELECT vec_id, v, best.n AS n, best.d AS d FROM (
    SELECT vec_id, v, (SELECT min(struct_pack(d := CAST(list_sum(list_transform(
        list_zip(a.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), n := c.n))
      FROM c{r} c) AS best
    FROM v a)
)""")
        if r < rounds:
            steps.append(f""", m{r} AS MATERIALIZED (
  SELECT n, list((s - ((s % t) + t) % t) // t ORDER BY i) AS v
  FROM (SELECT n, i, sum(v[i]) AS s, count(*) AS t FROM a{r}, range(1, 65) AS r(i) GROUP BY n, i)
  GROUP BY n
), c{r + 1} AS MATERIALIZED (
  SELECT n, coalesce(CAST(m.v AS BIGINT[]), c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (n)
)""")
    return "".join(steps) + f"""
SELECT vec_id, CAST(n AS INTEGER) AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY n) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (n)"""


ORACLES = {
    "op3_fm_index": contamination(),
    "op4_line_quality": line_quality(),
    "op9_license_digests": license_digests(),
    "op10_url_vocabulary": url_vocabulary(),
    "op12_walsh_clusters": walsh_clusters(),
}
