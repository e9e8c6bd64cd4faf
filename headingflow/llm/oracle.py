"""SQL that the results of the operators must equal, for DuckDB."""

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _level(levels: list[str], depth: int) -> str:
    """Grants of one level of the tree from those above it."""
    path = ", ".join(levels[: depth + 1])
    above = ", ".join(levels[:depth])
    part = f"PARTITION BY {above}" if above else ""
    joined = f"JOIN grant{depth} USING ({above})" if above else "CROSS JOIN grant0"
    name = levels[depth]
    return f"""
here{depth + 1} AS (
  SELECT {path}, sum(tokens * 4)::HUGEINT AS capacity, coalesce(any_value(w.weight), 1)::HUGEINT AS weight
  FROM leaves LEFT JOIN weights w ON w.level = '{name}' AND w.name = {name} GROUP BY {path}),
fill{depth + 1} AS (
  SELECT h.*, budget,
    coalesce(sum(capacity) OVER ({part} ORDER BY capacity::DOUBLE / weight::DOUBLE, {name}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS before,
    sum(weight) OVER ({part} ORDER BY capacity::DOUBLE / weight::DOUBLE, {name}
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS later
  FROM here{depth + 1} h {joined}),
full{depth + 1} AS (SELECT *, capacity * later + weight * before <= weight * budget AS is_full FROM fill{depth + 1}),
open{depth + 1} AS (
  SELECT *, coalesce(sum(capacity) FILTER (is_full) OVER ({part}), 0)::HUGEINT AS used,
    sum(weight) FILTER (NOT is_full) OVER ({part})::HUGEINT AS open_weight FROM full{depth + 1}),
grant{depth + 1} AS (
  SELECT {path}, CASE WHEN is_full THEN capacity
    ELSE least(weight * (budget - used) // open_weight, capacity) END AS budget FROM open{depth + 1})"""


def mixing_sql(docs: str, weights: list[tuple[str, str, int]], domain: str, seed: int) -> str:
    """``copies`` of every row of ``docs`` that a mix of one epoch's tokens takes, with at most four epochs of a leaf."""
    levels = ["domain", "lang", "source"]
    rows = ", ".join(f"('{a}', '{b}', {w})" for a, b, w in weights)
    steps = ",".join(_level(levels, d) for d in range(3))
    return f"""
WITH weights(level, name, weight) AS (VALUES {rows}),
docs AS (
  SELECT doc_id, coalesce({domain}, '') AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(len({WORDS.format("text")}), 0)::BIGINT AS n_tokens FROM ({docs})),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens FROM docs GROUP BY ALL),
grant0 AS (SELECT least(sum(tokens), sum(tokens * 4))::HUGEINT AS budget FROM leaves),{steps},
granted AS (
  SELECT domain, lang, source, tokens, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
    CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
  FROM leaves JOIN grant3 USING (domain, lang, source)),
keyed AS (
  SELECT d.*, whole, rest, md5(concat_ws(':', '{seed}', (whole + 1)::VARCHAR, doc_id::VARCHAR)) AS key
  FROM docs d JOIN granted USING (domain, lang, source)),
summed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM keyed)
SELECT doc_id, domain, lang, source, n_tokens, (whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM summed"""


SEARCH_SQL = r"""
WITH upper AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u),
texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, u, lower(u)), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents, upper),
counted AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM texts) t GROUP BY r, term),
totals AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms
  FROM texts WHERE len(terms) > 0),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0E0 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, totals GROUP BY term),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, u, lower(u)),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark, upper),
scores AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(terms) * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN counted USING (term) JOIN texts USING (r), totals
  GROUP BY item_id, r)
SELECT * FROM (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
    doc_id, score
  FROM scores WHERE score > 0) t WHERE rank <= 10
"""


REPEATS_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({WORDS.format("text")}, []) AS words FROM documents),
windows AS (
  SELECT r, p, array_to_string(words[p:p + 34], ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS p FROM texts) t),
again AS (SELECT r, p, count(*) OVER (PARTITION BY w) > 1 AS again FROM windows),
places AS (SELECT r, words, unnest(range(1, len(words) + 1)) AS p FROM texts),
judged AS (
  SELECT r, p, words[p] AS word, bool_or(coalesce(again, false))
    OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM places LEFT JOIN again USING (r, p)),
cleaned AS (
  SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept
  FROM judged GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN cleaned USING (r)
"""
