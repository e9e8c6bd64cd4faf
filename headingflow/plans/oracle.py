"""For each deterministic query the SQL, over the base tables only, that it must equal.

Written for DuckDB. Model results depend on the fit and have none; tests cover them.
"""

from headingflow.functions.text import BOILERPLATE
from headingflow.plans.derived import DAYS, FIRST_DAY
from headingflow.plans.queries import KNOWN_DAYS, PREVIEW_ROWS, RUN_DATE, SECOND_MODEL_TURN, WIDE_COUNT

QUESTIONS = f"""
pq_questions AS (
  SELECT doc_id AS pq_id,
    CASE doc_id % 4
      WHEN 0 THEN concat(CAST(doc_id AS VARCHAR), '. Deputy Mary Byrne asked the Minister for ', source,
        ', to outline ', text, ' and if he will make a statement on the matter.')
      WHEN 1 THEN concat('asked the Minister for ', source, ', in relation to ', text)
      WHEN 2 THEN concat('Deputy Seán Ó Sé asked the Taoiseach ',
        'whether she will make a statement on the matter ', text)
      ELSE coalesce(text, '') END AS question,
    source AS department,
    concat(lang, '-', source) AS heading,
    CAST(doc_id % {DAYS} AS INTEGER) AS day_no,
    CAST(DATE '{FIRST_DAY}' + CAST(doc_id % {DAYS} AS INTEGER) AS VARCHAR) AS date
  FROM documents)"""

LABELS = """
pq_labels AS (
  SELECT heading, CAST(row_number() OVER (ORDER BY heading) - 1 AS INTEGER) AS label_id
  FROM (SELECT DISTINCT heading FROM pq_questions) t)"""

COUNTS = """
heading_counts AS (SELECT heading, count(*) AS n FROM pq_questions GROUP BY heading)"""

KNOWN = """
known AS (
  SELECT heading FROM heading_counts WHERE n >= 8 UNION SELECT 'Other')"""


def candidates(name: str = "pq_candidates", turn: int = 0) -> str:
    return f"""
{name} AS (
  SELECT q.pq_id, k.k AS rank, l2.label_id AS class_id, l2.heading AS cand_heading,
    q.c1 * power(1.0E0 - q.c1, CAST(k.k - 1 AS DOUBLE)) AS cand_conf
  FROM (
    SELECT a.pq_id, b.label_id AS t,
      CAST(15 + ((a.pq_id + {turn}) * 37) % 80 AS DOUBLE) / 100.0E0 AS c1,
      CASE WHEN (a.pq_id + {turn}) % 20 < 9 THEN 0
        WHEN (a.pq_id + {turn}) % 20 < 14 THEN 1 + (a.pq_id + {turn}) % 3
        WHEN (a.pq_id + {turn}) % 20 < 17 THEN 4 + (a.pq_id + {turn}) % 6 ELSE 11 END AS r
    FROM pq_questions a JOIN pq_labels b ON a.heading = b.heading) q
  CROSS JOIN (VALUES (1),(2),(3),(4),(5),(6),(7),(8),(9),(10)) k(k)
  CROSS JOIN (SELECT count(*) AS c FROM pq_labels) n
  JOIN pq_labels l2 ON l2.label_id = (q.t + k.k - 1 - q.r + n.c) % n.c)"""


def predictions(name: str = "pq_predictions", source: str = "pq_candidates") -> str:
    return f"""
{name} AS (
  SELECT q.pq_id, q.question, q.department, q.heading, q.day_no, q.date,
    c.pred_heading, c.pred_confidence, c.truth_rank
  FROM pq_questions q JOIN (
    SELECT c.pq_id, max(CASE WHEN rank = 1 THEN cand_heading END) AS pred_heading,
      max(CASE WHEN rank = 1 THEN cand_conf END) AS pred_confidence,
      min(CASE WHEN cand_heading = heading THEN rank END) AS truth_rank
    FROM {source} c JOIN pq_questions q2 ON q2.pq_id = c.pq_id GROUP BY c.pq_id) c ON c.pq_id = q.pq_id)"""


RAW_CONFIDENCE = """
CASE WHEN pq_id % 50 IN (0, 1, 2) THEN NULL
  ELSE CAST(concat('0.', CAST(15 + (pq_id * 37) % 80 AS VARCHAR)) AS DOUBLE) END"""

# Predictions with NULL departments and headings, and confidences that cannot be read.
GAPS = f"""
gaps AS (
  SELECT pq_id, question, CASE WHEN pq_id % 97 <> 1 THEN department END AS department,
    CASE WHEN pq_id % 97 <> 2 THEN heading END AS heading, pred_heading,
    {RAW_CONFIDENCE} AS pred_confidence
  FROM pq_predictions)"""


def cleaned(expression: str) -> str:
    result = f"lower({expression})"
    for pattern in BOILERPLATE:
        quoted = pattern.replace("'", "''")
        result = f"regexp_replace({result}, '{quoted}', ' ', 'g')"
    result = rf"regexp_replace({result}, '[^\p{{L}}\p{{N}}_\s\-]', ' ', 'g')"
    return rf"trim(regexp_replace({result}, '\s+', ' ', 'g'))"


CLEAN = f"""
clean AS (SELECT *, {cleaned("question")} AS question_clean FROM pq_questions)"""

WORDS = r"""
token_lists AS (
  SELECT pq_id, list_filter(
    string_split(regexp_replace(question_clean, '[-_]', ' ', 'g'), ' '), lambda w: w <> '') AS tokens
  FROM clean),
vocab AS (
  SELECT word, CAST(row_number() OVER (ORDER BY n DESC, word) + 1 AS INTEGER) AS word_id, n
  FROM (SELECT word, count(*) AS n FROM (SELECT unnest(tokens) AS word FROM token_lists) t GROUP BY word) c
  QUALIFY row_number() OVER (ORDER BY n DESC, word) + 1 < 20000)"""


# Multinomial naive Bayes with smoothing 0.1 over word counts and the department.
BAYES = r"""
doc_words AS (
  SELECT pq_id, word AS term, count(*) AS x FROM (SELECT pq_id, unnest(tokens) AS word FROM token_lists) t GROUP BY ALL),
model_words AS (
  SELECT word FROM (
    SELECT term AS word, sum(x) AS n FROM doc_words JOIN parts USING (pq_id) WHERE split = 'train' GROUP BY term) c
  QUALIFY row_number() OVER (ORDER BY n DESC, word) + 1 < 20000),
doc_terms AS (
  SELECT pq_id, 'w' || term AS term, x FROM doc_words JOIN model_words ON word = term
  UNION ALL SELECT pq_id, 'd' || department, 1 FROM parts
  WHERE department IN (SELECT department FROM parts WHERE split = 'train')),
class_terms AS (
  SELECT heading_collapsed AS c, term, sum(x) AS n FROM doc_terms JOIN parts USING (pq_id)
  WHERE split = 'train' GROUP BY ALL),
sizes AS (
  SELECT (SELECT count(*) FROM model_words)
      + (SELECT count(DISTINCT department) FROM parts WHERE split = 'train') AS v,
    (SELECT count(*) FROM parts WHERE split = 'train') AS docs,
    (SELECT count(DISTINCT heading_collapsed) FROM parts WHERE split = 'train') AS k),
classes AS (
  SELECT c, ln(d.docs_c + 0.1E0) - ln(s.docs + s.k * 0.1E0) AS prior, ln(t.total + s.v * 0.1E0) AS below
  FROM (SELECT c, sum(n) AS total FROM class_terms GROUP BY c) t
  JOIN (SELECT heading_collapsed AS c, count(*) AS docs_c FROM parts WHERE split = 'train' GROUP BY ALL) d USING (c)
  CROSS JOIN sizes s),
lengths AS (SELECT pq_id, sum(x) AS x FROM doc_terms GROUP BY pq_id),
hits AS (
  SELECT d.pq_id, c, sum(x * (ln(n + 0.1E0) - ln(0.1E0))) AS gain
  FROM doc_terms d JOIN class_terms USING (term) GROUP BY ALL),
scored AS (
  SELECT p.pq_id, split, heading_collapsed, k.c,
    prior + coalesce(gain, 0) + coalesce(l.x, 0) * (ln(0.1E0) - below) AS score
  FROM parts p CROSS JOIN classes k LEFT JOIN lengths l USING (pq_id)
  LEFT JOIN hits h ON h.pq_id = p.pq_id AND h.c = k.c),
bayes AS (
  SELECT pq_id, split, heading_collapsed, c, row_number() OVER (PARTITION BY pq_id ORDER BY score DESC, c) AS place,
    1 / sum(exp(score - top)) OVER (PARTITION BY pq_id) AS conf
  FROM (SELECT *, max(score) OVER (PARTITION BY pq_id) AS top FROM scored) t)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


PREDICTED = (QUESTIONS, LABELS, candidates(), predictions())


def daily_columns(ks=(4, 10), thresholds=(30, 40, 50, 60, 70)) -> str:
    """The daily metrics over rows with ``hit1``, ``truth_rank`` and ``pred_confidence``."""
    top = max(ks)
    share = lambda test: f"round(count(*) FILTER ({test}) / CAST(count(*) AS DOUBLE), 6)"
    shown = ["count(*) AS n", "round(avg(pred_confidence), 6) AS avg_conf", f"{share('hit1')} AS top1"]
    shown += [f"{share(f'coalesce(truth_rank <= {k}, false)')} AS top{k}" for k in ks]
    shown.append(f"{share(f'NOT coalesce(truth_rank <= {top}, false)')} AS outside_top{top}")
    shown.append("count(*) FILTER (hit1) AS n_top1")
    narrower = "hit1"
    for k in ks:
        hit = f"coalesce(truth_rank <= {k}, false)"
        shown.append(f"count(*) FILTER ({hit}) AS n_top{k}")
        shown.append(f"count(*) FILTER ({hit} AND NOT {narrower}) AS n_top{k}_only")
        narrower = hit
    shown.append(f"count(*) FILTER (NOT {narrower}) AS n_outside_top{top}")
    for t in thresholds:
        auto = f"pred_confidence >= {t / 100}E0"
        name = f"t{t:03d}"
        shown.append(f"{share(f'NOT {auto}')} AS review_rate_{name}")
        shown.append(f"{share(auto)} AS auto_coverage_{name}")
        rate = lambda test: (
            f"round(count(*) FILTER ({auto} AND NOT hit1{test})"
            f" / nullif(CAST(count(*) FILTER ({auto}) AS DOUBLE), 0), 6)"
        )
        shown.append(f"{rate('')} AS auto_error_rate_{name}")
        for k in ks:
            rescued = f" AND coalesce(truth_rank <= {k}, false)"
            shown.append(f"{rate(rescued)} AS auto_top{k}_rescue_{name}")
    return ",\n  ".join(shown)


HIT1 = "SELECT *, pred_heading = heading AS hit1 FROM pq_predictions"

TOP1_COLUMNS = """count(*) AS n, round(avg(pred_confidence), 6) AS avg_conf,
  round(count(*) FILTER (hit1) / CAST(count(*) AS DOUBLE), 6) AS top1, count(*) FILTER (hit1) AS n_top1"""

COLLAPSED = """
collapsed AS (
  SELECT p.pq_id, p.pred_confidence,
    CASE WHEN a.n < 8 THEN 'Other' ELSE p.pred_heading END AS pred_heading,
    CASE WHEN b.n < 8 THEN 'Other' ELSE p.heading END AS heading
  FROM pq_predictions p
  LEFT JOIN heading_counts a ON a.heading = p.pred_heading
  LEFT JOIN heading_counts b ON b.heading = p.heading)"""

EVALUATED = """
evaluated AS (
  SELECT p.*, coalesce(k.heading, 'Other') AS heading_eval
  FROM pq_predictions p LEFT JOIN known k ON k.heading = p.heading)"""

WIDE3 = """
wide AS (
  SELECT pq_id,
    max(cand_heading) FILTER (rank = 1) AS alt_heading_1, round(max(cand_conf) FILTER (rank = 1), 6) AS alt_conf_1,
    max(cand_heading) FILTER (rank = 2) AS alt_heading_2, round(max(cand_conf) FILTER (rank = 2), 6) AS alt_conf_2,
    max(cand_heading) FILTER (rank = 3) AS alt_heading_3, round(max(cand_conf) FILTER (rank = 3), 6) AS alt_conf_3
  FROM pq_candidates GROUP BY pq_id)"""


def wide_columns(k: int, first: int = 1) -> str:
    return ",\n  ".join(
        f"max(cand_heading) FILTER (rank = {j + first - 1}) AS alt_heading_{j}, "
        f"round(max(cand_conf) FILTER (rank = {j + first - 1}), 6) AS alt_conf_{j}"
        for j in range(1, k - first + 2)
    )


def split_sql(label: str, table: str) -> str:
    return f"""
    SELECT *, CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY md5(concat(CAST(pq_id AS VARCHAR), '|42')), pq_id)
      <= floor(0.1E0 * count(*) OVER (PARTITION BY {label}) + 0.5E0) THEN 'val' ELSE 'train' END AS split
    FROM {table}"""


RANKED_HEADINGS = """
ranked AS (
  SELECT heading, n, row_number() OVER (ORDER BY n DESC, heading) AS rank,
    CAST(sum(n) OVER (ORDER BY n DESC, heading) AS BIGINT) AS cum,
    CAST(sum(n) OVER () AS BIGINT) AS total
  FROM heading_counts)"""

COLLAPSED_TRAINING = """
collapsed AS (
  SELECT pq_id, department, CASE WHEN n < 8 THEN 'Other' ELSE heading END AS heading_collapsed
  FROM pq_questions JOIN heading_counts USING (heading))"""

# The same model, with the words of the raw question in place of those of the cleaned one.
BAYES_RAW = BAYES.replace(
    "\nclass_terms AS (",
    r"""
raw_words AS (
  SELECT pq_id, word AS term, count(*) AS x FROM (
    SELECT pq_id, unnest(list_filter(
      string_split_regex(lower(question), '[\s_\-]+'), lambda w: w <> '')) AS word FROM pq_questions) t GROUP BY ALL),
raw_terms AS (
  SELECT pq_id, 'w' || term AS term, x FROM raw_words JOIN model_words ON word = term
  UNION ALL SELECT pq_id, 'd' || department, 1 FROM parts
  WHERE department IN (SELECT department FROM parts WHERE split = 'train')),
class_terms AS (""",
).replace("FROM doc_terms GROUP BY pq_id", "FROM raw_terms GROUP BY pq_id").replace(
    "FROM doc_terms d JOIN class_terms", "FROM raw_terms d JOIN class_terms"
)

TRAINED = (
    QUESTIONS, COUNTS, COLLAPSED_TRAINING, f"\nparts AS ({split_sql('heading_collapsed', 'collapsed')})", CLEAN, WORDS, BAYES
)


ORACLE: dict[str, str] = {
    "daily_metrics": with_(*PREDICTED)
    + f"SELECT date, {daily_columns()} FROM ({HIT1}) p GROUP BY date",
    "daily_top1": with_(*PREDICTED, COUNTS, KNOWN, EVALUATED)
    + f"SELECT date, {TOP1_COLUMNS} FROM (SELECT *, pred_heading = heading_eval AS hit1 FROM evaluated) p GROUP BY date",
    "headline_metrics": with_(*PREDICTED, COUNTS, KNOWN, EVALUATED)
    + """SELECT count(*) AS n, round(avg(CAST(pred_heading = heading AS INTEGER)), 6) AS top1,
      round(avg(CAST(coalesce(truth_rank <= 4, false) AS INTEGER)), 6) AS top4,
      round(avg(CAST(coalesce(truth_rank <= 10, false) AS INTEGER)), 6) AS top10,
      round(avg(CAST(truth_rank IS NULL AS INTEGER)), 6) AS outside_top10,
      count(*) FILTER (heading_eval = 'Other') AS n_other,
      round(avg(CAST(heading_eval = 'Other' AS INTEGER)), 6) AS other_share FROM evaluated""",
    "multi_model_metrics": with_(
        *PREDICTED,
        candidates("second_candidates", SECOND_MODEL_TURN),
        predictions("second_predictions", "second_candidates"),
    )
    + f"""SELECT model, date, {daily_columns()} FROM (
      SELECT 'first' AS model, *, pred_heading = heading AS hit1 FROM pq_predictions
      UNION ALL SELECT 'second' AS model, *, pred_heading = heading AS hit1 FROM second_predictions) p
      GROUP BY model, date""",
    "upsert_daily": with_(
        *PREDICTED,
        f"\nhits AS ({HIT1})",
        f"\nold AS (SELECT date, {TOP1_COLUMNS} FROM hits WHERE day_no < 20 GROUP BY date)",
        f"\nnew AS (SELECT date, {daily_columns((4,), ())} FROM hits WHERE day_no >= 15 GROUP BY date)",
    )
    + """SELECT date, n, avg_conf, top1, n_top1, n + 1 AS topk, CAST(NULL AS DOUBLE) AS top4,
        CAST(NULL AS DOUBLE) AS outside_top4, CAST(NULL AS BIGINT) AS n_top4,
        CAST(NULL AS BIGINT) AS n_top4_only, CAST(NULL AS BIGINT) AS n_outside_top4
      FROM old WHERE date NOT IN (SELECT date FROM new)
      UNION ALL
      SELECT date, n, avg_conf, top1, n_top1, NULL, top4, outside_top4, n_top4, n_top4_only, n_outside_top4
      FROM new ORDER BY date""",
    "upsert_partitions": with_(*PREDICTED)
    + f"SELECT date, {TOP1_COLUMNS} FROM ({HIT1}) p GROUP BY date ORDER BY date",
    "holdout_report": with_(*PREDICTED, COUNTS, COLLAPSED)
    + """SELECT count(*) AS n, round(avg(CAST(pred_heading = heading AS INTEGER)), 6) AS top1,
      round(avg(CAST(pred_heading = heading OR EXISTS (
        SELECT 1 FROM pq_candidates c WHERE c.pq_id = p.pq_id AND c.rank <= 5
          AND c.cand_heading = p.heading) AS INTEGER)), 6) AS topk,
      round(avg(CAST(lower(pred_heading) = 'other' AS INTEGER)), 6) AS other_rate FROM collapsed p""",
    "review_sweep": with_(*PREDICTED, GAPS)
    + """SELECT t.t AS threshold,
      round(count(*) FILTER (pred_confidence < t.t) / CAST(count(*) AS DOUBLE), 6) AS review_rate,
      count(*) FILTER (pred_confidence < t.t) AS items
      FROM gaps CROSS JOIN (VALUES (0.20E0), (0.25E0), (0.30E0), (0.35E0), (0.40E0)) t(t) GROUP BY t.t""",
    "department_summary": with_(*PREDICTED, GAPS)
    + """SELECT department, count(*) AS n,
      round(avg(CAST(pred_heading = coalesce(heading, '') AS INTEGER)), 6) AS top1,
      round(avg(pred_confidence), 6) AS avg_conf
      FROM gaps GROUP BY department ORDER BY n DESC, department ASC NULLS FIRST LIMIT 20""",
    "error_sample": with_(
        *PREDICTED,
        GAPS,
        WIDE3,
        """
wrong AS (
  SELECT g.pq_id, question, department, heading, pred_heading,
    coalesce(pred_confidence, -1.0E0) AS pred_confidence, w.* EXCLUDE (pq_id)
  FROM gaps g JOIN wide w ON w.pq_id = g.pq_id WHERE pred_heading <> coalesce(heading, ''))""",
    )
    + """SELECT * FROM (SELECT * FROM wrong ORDER BY pred_confidence DESC, pq_id LIMIT 50)
      UNION SELECT * FROM (SELECT * FROM wrong ORDER BY pred_confidence ASC, pq_id LIMIT 50)""",
    "clean_question": with_(QUESTIONS, CLEAN) + "SELECT pq_id, question_clean FROM clean",
    "clean_preview": with_(QUESTIONS, CLEAN)
    + f"SELECT pq_id, question, question_clean FROM clean ORDER BY pq_id LIMIT {PREVIEW_ROWS}",
    "normalise_ws": with_(QUESTIONS)
    + r"SELECT pq_id, trim(regexp_replace(question, '\s+', ' ', 'g')) AS question_ws FROM pq_questions",
    "model_input_text": with_(QUESTIONS, CLEAN)
    + """SELECT pq_id, concat('[DEPT] ', trim(department), ' [SEP] ', question_clean) AS text_clean,
      concat('[DEPT] ', department, ' [SEP] ', question) AS text_raw FROM clean""",
    "text_length_stats": with_(
        QUESTIONS,
        CLEAN,
        r"""
lengths AS (
  SELECT 'raw' AS kind, len(list_filter(regexp_split_to_array(question, '\s+'), lambda w: w <> '')) AS n FROM clean
  UNION ALL
  SELECT 'clean', len(list_filter(string_split(question_clean, ' '), lambda w: w <> '')) FROM clean)""",
    )
    + """SELECT kind, round(avg(n), 6) AS mean, round(quantile_cont(n, 0.5), 6) AS median,
      round(quantile_cont(n, 0.95), 6) AS p95 FROM lengths GROUP BY kind""",
    "optional_columns": with_(QUESTIONS, CLEAN) + "SELECT pq_id, '' AS department, question_clean FROM clean",
    "canon_extract": with_(QUESTIONS)
    + r"""SELECT regexp_replace(question, '^\s+|\s+$', '', 'g') AS question, heading, department, date
      FROM pq_questions""",
    "canon_large": with_(QUESTIONS)
    + r"""SELECT regexp_replace(question, '^\s+|\s+$', '', 'g') AS question, heading, department, date
      FROM pq_questions WHERE regexp_replace(question, '^\s+|\s+$', '', 'g') <> ''""",
    "canon_rejects": with_(QUESTIONS)
    + r"""SELECT 'read' AS outcome, heading AS detail, count(*) AS n FROM pq_questions
      WHERE pq_id % 11 <> 0 AND regexp_replace(question, '^\s+|\s+$', '', 'g') <> '' GROUP BY heading
      UNION ALL SELECT 'rejected', 'the item is not JSON', count(*) FROM pq_questions WHERE pq_id % 11 = 0""",
    "parse_dates": with_(QUESTIONS)
    + """SELECT pq_id, CASE pq_id % 9
        WHEN 0 THEN date
        WHEN 1 THEN strftime(CAST(date AS DATE), '%Y/%-m/%-d')
        WHEN 2 THEN strftime(CAST(date AS DATE), '%d-%m-%Y')
        WHEN 3 THEN concat(' ', strftime(CAST(date AS DATE), '%-d/%-m/%Y'), ' ')
        WHEN 4 THEN concat(date, 'T08:15:00')
        WHEN 5 THEN concat(date, 'T23:59:59.250Z')
        WHEN 6 THEN concat(date, 'T23:30:00+05:30')
        WHEN 7 THEN ' '
        ELSE '32/13/2026' END AS raw,
      CASE WHEN pq_id % 9 < 7 THEN date END AS day FROM pq_questions""",
    "coerce_confidence": with_(QUESTIONS)
    + f"""SELECT pq_id, coalesce(c, 0.0E0) AS conf_metrics, c AS conf_report, coalesce(c, -1.0E0) AS conf_sample
      FROM (SELECT pq_id, {RAW_CONFIDENCE} AS c FROM pq_questions) t""",
    "parallel_arrays": """SELECT doc_id AS pq_id, CAST(pos - 1 AS BIGINT) AS position,
      CAST((doc_id + pos - 1) % 20 AS INTEGER) AS department_code, line AS question
      FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents) a) b""",
    "csv_roundtrip": with_(QUESTIONS) + "SELECT pq_id, question, department, heading FROM pq_questions",
    "csv_split": with_(QUESTIONS) + "SELECT pq_id, question, department, heading FROM pq_questions",
    "dated_sink": with_(*PREDICTED)
    + f"SELECT pq_id, question, pred_heading, '{RUN_DATE}' AS run_date FROM pq_predictions",
    "load_by_suffix": with_(QUESTIONS)
    + """SELECT question, department, heading, 'csv' AS suffix FROM pq_questions
      UNION ALL SELECT question, department, heading, 'json' FROM pq_questions""",
    "label_encode": with_(
        QUESTIONS,
        LABELS,
        """
departments AS (
  SELECT department, CAST(row_number() OVER (ORDER BY department) - 1 AS INTEGER) AS department_id
  FROM (SELECT DISTINCT department FROM pq_questions) t)""",
    )
    + """SELECT pq_id, heading, department, label_id, department_id
      FROM pq_questions JOIN pq_labels USING (heading) JOIN departments USING (department)""",
    "decode_labels": with_(QUESTIONS, LABELS)
    + """SELECT pq_id, CAST(pq_id % 100 AS INTEGER) AS class_id,
      coalesce(l.heading, CAST(pq_id % 100 AS VARCHAR)) AS heading,
      coalesce(l.heading, concat('__UNK_', CAST(pq_id % 100 AS VARCHAR), '__')) AS heading_marked
      FROM pq_questions q LEFT JOIN pq_labels l ON l.label_id = q.pq_id % 100""",
    "truth_collapse": with_(QUESTIONS, COUNTS, KNOWN)
    + """SELECT pq_id, q.heading, coalesce(k.heading, 'Other') AS heading_eval
      FROM pq_questions q LEFT JOIN known k ON k.heading = q.heading""",
    "unseen_departments": with_(QUESTIONS)
    + f"""SELECT DISTINCT heading AS department FROM pq_questions
      WHERE heading NOT IN (SELECT heading FROM pq_questions WHERE day_no < {KNOWN_DAYS})""",
    "rare_collapse": with_(QUESTIONS, COUNTS)
    + """SELECT pq_id, CASE WHEN n < 8 THEN 'Other' ELSE heading END AS heading_collapsed
      FROM pq_questions JOIN heading_counts USING (heading)""",
    "rare_collapse_wide": with_(QUESTIONS, COUNTS)
    + f"""SELECT pq_id, CASE WHEN n < {WIDE_COUNT} THEN 'Other' ELSE heading END AS heading_collapsed
      FROM pq_questions JOIN heading_counts USING (heading)""",
    "rare_collapse_summary": with_(QUESTIONS, COUNTS)
    + """SELECT count(DISTINCT heading) AS n_before, count(DISTINCT c) AS n_after,
      count(DISTINCT heading) FILTER (n < 8) AS n_rare,
      count(DISTINCT heading) - count(DISTINCT c) AS n_fewer, count(*) FILTER (c = 'Other') AS rows_other
      FROM (SELECT heading, n, CASE WHEN n < 8 THEN 'Other' ELSE heading END AS c
        FROM pq_questions JOIN heading_counts USING (heading)) t""",
    "heading_distribution": with_(QUESTIONS, COUNTS, RANKED_HEADINGS)
    + """SELECT heading, n AS "count", round(n / CAST(total AS DOUBLE), 6) AS share,
      round(cum / CAST(total AS DOUBLE), 6) AS cum_share, rank FROM ranked""",
    "coverage_thresholds": with_(QUESTIONS, COUNTS, RANKED_HEADINGS)
    + """SELECT p.p / 100.0E0 AS threshold, min(rank) FILTER (cum * 100 >= total * p.p) AS top_headings,
      count(*) AS headings, max(total) AS questions
      FROM ranked CROSS JOIN (VALUES (50), (80), (90), (95)) p(p) GROUP BY p.p""",
    "topk_long": with_(QUESTIONS, LABELS, candidates())
    + """SELECT pq_id, rank, heading, conf FROM (
        SELECT pq_id, row_number() OVER (PARTITION BY pq_id ORDER BY cand_conf DESC, class_id) AS rank,
          cand_heading AS heading, round(cand_conf, 6) AS conf FROM pq_candidates) t WHERE rank <= 3""",
    "topk_inrow": with_(QUESTIONS, LABELS, candidates())
    + """SELECT pq_id, rank, cand_heading AS heading, conf FROM (
        SELECT pq_id, row_number() OVER (PARTITION BY pq_id ORDER BY cand_conf DESC, class_id) AS rank,
          cand_heading, class_id, round(cand_conf, 6) AS conf FROM pq_candidates) t WHERE rank <= 3""",
    "decode_sparse": with_(QUESTIONS, LABELS, candidates())
    + """SELECT pq_id, rank, CASE WHEN class_id % 3 = 0 THEN CAST(class_id AS VARCHAR) ELSE cand_heading END AS heading, conf FROM (
        SELECT pq_id, row_number() OVER (PARTITION BY pq_id ORDER BY cand_conf DESC, class_id) AS rank,
          cand_heading, class_id, round(cand_conf, 6) AS conf FROM pq_candidates) t WHERE rank <= 3""",
    "topk_hit": with_(*PREDICTED)
    + """SELECT pq_id, coalesce(truth_rank <= 4, false) AS top4, coalesce(truth_rank <= 10, false) AS top10,
      pred_heading = heading OR coalesce(truth_rank <= 5, false) AS report_hit FROM pq_predictions""",
    "softmax": with_(QUESTIONS, LABELS, candidates())
    + """SELECT pq_id, CAST(rank AS BIGINT) AS rank,
      round(exp(cand_conf * 10) / sum(exp(cand_conf * 10)) OVER (PARTITION BY pq_id), 6) AS probability
      FROM pq_candidates""",
    "never_other": with_(QUESTIONS, LABELS, COUNTS, candidates())
    + """SELECT pq_id, arg_min(name, place) AS pred_heading, round(arg_min(conf, place), 6) AS pred_confidence
      FROM (SELECT q.pq_id, coalesce(cand_conf, 0) AS conf, CASE WHEN n < 8 THEN 'Other' ELSE l.heading END AS name,
          row_number() OVER (PARTITION BY q.pq_id ORDER BY coalesce(cand_conf, 0) DESC, l.label_id)
            + CASE WHEN n < 8 THEN 1000000 ELSE 0 END AS place
        FROM pq_questions q CROSS JOIN pq_labels l JOIN heading_counts h ON h.heading = l.heading
        LEFT JOIN pq_candidates c ON c.pq_id = q.pq_id AND c.class_id = l.label_id) t GROUP BY pq_id""",
    "widen_candidates": with_(QUESTIONS, LABELS, candidates())
    + f"""SELECT pq_id, max(cand_heading) FILTER (rank = 1) AS pred_heading,
      round(max(cand_conf) FILTER (rank = 1), 6) AS pred_confidence,
      {wide_columns(10)} FROM pq_candidates GROUP BY pq_id""",
    "widen_alternates": with_(QUESTIONS, LABELS, candidates())
    + f"""SELECT pq_id, max(cand_heading) FILTER (rank = 1) AS pred_heading,
      round(max(cand_conf) FILTER (rank = 1), 6) AS pred_confidence,
      {wide_columns(4, first=2)} FROM pq_candidates GROUP BY pq_id""",
    "review_flag": with_(*PREDICTED) + "SELECT pq_id, pred_confidence < 0.25E0 AS needs_review FROM pq_predictions",
    "review_count": with_(*PREDICTED)
    + "SELECT count(*) FILTER (pred_confidence < 0.25E0) AS flagged, count(*) AS n FROM pq_predictions",
    "vocabulary": with_(QUESTIONS, CLEAN, WORDS) + "SELECT word, word_id, n FROM vocab",
    "encode_sequences": with_(
        QUESTIONS,
        CLEAN,
        WORDS,
        """
coded AS (
  SELECT t.pq_id, list(coalesce(v.word_id, 1) ORDER BY t.pos) AS ids
  FROM (SELECT pq_id, unnest(tokens[1:300]) AS word,
      unnest(range(1, least(len(tokens), 300) + 1)) AS pos FROM token_lists) t
  LEFT JOIN vocab v ON v.word = t.word GROUP BY t.pq_id)""",
    )
    + """SELECT q.pq_id, array_to_string(list_resize(coalesce(ids, []), 300, 0), ',') AS word_ids
      FROM token_lists q LEFT JOIN coded USING (pq_id)""",
    "stratified_split": with_(QUESTIONS)
    + split_sql("heading", "(SELECT pq_id, heading FROM pq_questions) t"),
    "unstratified_split": with_(QUESTIONS) + split_sql("1", "(SELECT pq_id FROM pq_questions) t"),
    "run_metadata": with_(
        QUESTIONS,
        COUNTS,
        COLLAPSED_TRAINING,
        f"\nparts AS ({split_sql('heading_collapsed', 'collapsed')})",
    )
    + """SELECT count(DISTINCT department) AS n_departments, count(DISTINCT heading_collapsed) AS n_headings,
      count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'val') AS val_rows,
      20000 AS num_words, 300 AS maxlen, 0.1E0 AS val_split, 42 AS seed, 8 AS min_heading_count,
      'Other' AS other_label, '[DEPT] {department} [SEP] {question}' AS text_format FROM parts""",
    "train_score_baseline": with_(*TRAINED)
    + """SELECT split, count(*) AS n, round(avg(conf), 6) AS avg_conf,
      round(avg(CAST(c = heading_collapsed AS INTEGER)), 6) AS top1,
      count(*) FILTER (c = heading_collapsed) AS n_top1 FROM bayes WHERE place = 1 GROUP BY split""",
    "score_raw": with_(*[BAYES_RAW if part is BAYES else part for part in TRAINED])
    + """SELECT split, count(*) AS n, round(avg(conf), 6) AS avg_conf,
      round(avg(CAST(c = heading_collapsed AS INTEGER)), 6) AS top1,
      count(*) FILTER (c = heading_collapsed) AS n_top1 FROM bayes WHERE place = 1 GROUP BY split""",
    "logistic_balance": with_(
        QUESTIONS, COUNTS, COLLAPSED_TRAINING, f"\nparts AS ({split_sql('heading_collapsed', 'collapsed')})"
    )
    + """SELECT heading_collapsed AS heading, count(*) FILTER (split = 'train') AS n_train, true AS balanced
      FROM parts GROUP BY ALL""",
    "training_history": with_(
        QUESTIONS, COUNTS, COLLAPSED_TRAINING, f"\nparts AS ({split_sql('heading_collapsed', 'collapsed')})"
    )
    + """SELECT what, true AS holds, (SELECT count(*) FROM parts WHERE split = 'val') AS n_val
      FROM (VALUES ('epochs are numbered from 1'), ('training ends at the limit or out of patience'),
        ('the loss falls'), ('the model is that of the first best epoch')) t(what)""",
    "run_history": with_(
        QUESTIONS,
        COUNTS,
        """
asked AS (SELECT * FROM (VALUES ('first', 0, 2), ('first', 1, 8), ('second', 0, 8), ('second', 1, 16),
  ('second', 2, 60)) t(run_id, step, least)),
rare AS (
  SELECT run_id, step, least, count(*) AS n_before, count(*) FILTER (n < least) AS n_rare,
    count(*) FILTER (n >= least AND heading <> 'Other')
      + CAST(count(*) FILTER (n < least OR heading = 'Other') > 0 AS INTEGER) AS n_after,
    coalesce(sum(n) FILTER (n < least OR heading = 'Other'), 0) AS rows_other
  FROM asked CROSS JOIN heading_counts GROUP BY ALL)""",
    )
    + """SELECT run_id, CAST(step AS INTEGER) AS step, name, CAST(value AS DOUBLE) AS value,
      CASE WHEN run_id = 'second' THEN CAST(least AS INTEGER) END AS least
      FROM (SELECT run_id, step, least, unnest(['n_before', 'n_after', 'n_rare', 'n_fewer', 'rows_other']) AS name,
        unnest([n_before, n_after, n_rare, n_before - n_after, rows_other]) AS value FROM rare) t""",
    "plugin_scores": with_(QUESTIONS, LABELS)
    + """SELECT model, pq_id, CAST(place AS BIGINT) AS rank, heading, round(conf, 6) AS conf FROM (
      SELECT model, pq_id, heading, conf,
        row_number() OVER (PARTITION BY model, pq_id ORDER BY conf DESC, label_id) AS place
      FROM (SELECT model, pq_id, l.heading, label_id,
          CAST((length(question) * step + label_id * 17) % modulus AS DOUBLE) / modulus AS conf
        FROM pq_questions q CROSS JOIN pq_labels l
        CROSS JOIN (VALUES ('first', 31, 101), ('second', 7, 97)) m(model, step, modulus)) s) t WHERE place <= 3""",
    "validation_metrics": with_(*TRAINED)
    + """SELECT count(*) FILTER (place = 1) AS n,
      round(count(*) FILTER (place = 1 AND c = heading_collapsed) / CAST(count(DISTINCT pq_id) AS DOUBLE), 6)
        AS top1_accuracy,
      round(count(*) FILTER (place <= 3 AND c = heading_collapsed) / CAST(count(DISTINCT pq_id) AS DOUBLE), 6)
        AS top3_accuracy FROM bayes WHERE split = 'val'""",
}
