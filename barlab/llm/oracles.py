"""Plain SQL for what the corpus queries return by fixed patterns and counts.

A match's place is the length of all that stands before it: the pieces between matches and the matches.
"""

from __future__ import annotations


def spans_sql(kinds: list[tuple[str, str, str]]) -> str:
    """Counts per kind and the digest of all spans; ``kinds`` are (name, pattern, condition on the match ``m``)."""
    parts = [
        f"""
  SELECT r, {k} AS kind, '{name}' AS name, m,
    list_sum([length(x) FOR x IN gaps[1:i]]) + coalesce(list_sum([length(x) FOR x IN found[1:i - 1]]), 0) AS a
  FROM (
    SELECT r, gaps, found, i, found[i] AS m
    FROM (SELECT r, gaps, found, unnest(range(1, len(found) + 1)) AS i
          FROM (SELECT r, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS found FROM d)))
  WHERE {keep}"""
        for k, (name, pattern, keep) in enumerate(kinds)
    ]
    counts = ", ".join(f"CAST(count(*) FILTER (kind = {k}) AS BIGINT) AS n_{name}" for k, (name, _, _) in enumerate(kinds))
    names = ", ".join(f"coalesce(n_{name}, 0) AS n_{name}" for name, _, _ in kinds)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({' UNION ALL '.join(parts)}),
g AS (
  SELECT r, {counts},
    string_agg(name || ':' || CAST(a AS BIGINT) || ':' || CAST(a + length(m) AS BIGINT), ',' ORDER BY a, kind) AS listed
  FROM s GROUP BY r)
SELECT doc_id, {names}, sha256(coalesce(listed, '')) AS base_sha256 FROM d LEFT JOIN g USING (r)"""


def _digits(text: str = "m") -> str:
    return f"regexp_replace({text}, '[^0-9]', '', 'g')"


LUHN = f"""list_sum([CASE WHEN i % 2 = 1 THEN x WHEN x > 4 THEN 2 * x - 9 ELSE 2 * x END FOR x, i IN
  [CAST(c AS INTEGER) FOR c IN string_split(reverse({_digits()}), '')]]) % 10 = 0"""

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
SECRETS = spans_sql([
    ("assign", ASSIGN, f"length(regexp_extract(m, '{ASSIGN}', 1)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 20"),
    ("hex", "[0-9a-f]+", "length(m) >= 24"),
])
PERSONAL = spans_sql([
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "list_max([TRY_CAST(x AS HUGEINT) FOR x IN string_split(m, '.')]) <= 255"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_digits()}) BETWEEN 12 AND 19 AND {LUHN}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_digits()}) BETWEEN 9 AND 15"),
])
COUNTS = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+', 0) AS w
  FROM documents),
l AS (
  SELECT r, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
v AS (SELECT r, p, [w[p], w[p + 1], w[p + 2]] AS x FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) > 2)),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, x) AS n FROM v) WHERE n > 1),
c AS (SELECT r, count(DISTINCT q) AS n_repeat_words FROM (SELECT r, unnest(range(p, p + 3)) AS q FROM twice) GROUP BY r),
n AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN l USING (r) LEFT JOIN c USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM n"""
