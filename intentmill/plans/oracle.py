"""The registered queries as SQL for an independent engine over the same tables.

Texts and cue lists are taken from the library; everything else is written out again.
"""

from __future__ import annotations

from intentmill.functions.cues import CUE_WORDS
from intentmill.operators import prompts
from intentmill.options import CLASSES

_IN_CLASSES = "(" + ", ".join(f"'{c}'" for c in CLASSES) + ")"
_CLASS_ROWS = ", ".join(f"({i}, '{c}')" for i, c in enumerate(CLASSES))
CLASS_TABLE = f"classes(ord, class) AS (VALUES {_CLASS_ROWS})"


def _text(value: str) -> str:
    """A Python string as a SQL expression."""
    return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _gold(column: str) -> str:
    return (
        f"CASE {column} % 6 WHEN 0 THEN 'Navigational' WHEN 1 THEN 'Factual' "
        "WHEN 2 THEN ' Transactional ' WHEN 3 THEN 'INSTRUMENTAL' WHEN 4 THEN 'Abstain' END"
    )


# --- inputs ---

EVENTS = f"""
numbered AS (
  SELECT event_id, user_id, event_type, props,
         CAST(round(value * 100) AS BIGINT) % 1200 AS m FROM events),
ev AS (
  SELECT *, CAST(event_id AS VARCHAR) AS qid, {_gold('user_id')} AS gold,
         event_type || ' ' || props AS query,
         CAST(m // 1000 AS VARCHAR) || '.' || lpad(CAST(m % 1000 AS VARCHAR), 3, '0') AS cs
  FROM numbered),
raw_events AS (
  SELECT *, CASE event_type
    WHEN 'click' THEN 'Sure: {{"type": "nav", "confidence": ' || cs || '}}'
    WHEN 'view' THEN '{{"type": "Informational", "confidence": ' || cs || '}}'
    WHEN 'purchase' THEN '{{"type": "purchase", "confidence": "' || cs || '"}}'
    WHEN 'signup' THEN '{{"type": "how-to", "confidence": ' || cs || '}} ok'
    ELSE 'no object here' END AS raw
  FROM ev)"""

_ALIAS = (
    "CASE WHEN {t} IN " + _IN_CLASSES + " THEN {t} "
    "WHEN {t} IN ('info', 'informational', 'informative') THEN 'factual' "
    "WHEN {t} IN ('nav', 'navigation') THEN 'navigational' "
    "WHEN {t} IN ('transact', 'purchase') THEN 'transactional' "
    "WHEN {t} IN ('howto', 'how-to', 'procedural') THEN 'instrumental' ELSE 'abstain' END"
)

PARSED = EVENTS + f""",
blocks AS (
  SELECT *, regexp_extract(raw, '\\{{.*\\}}', 0, 's') AS blk FROM raw_events),
fields AS (
  SELECT * EXCLUDE (raw, blk),
    CASE WHEN blk <> '' AND json_valid(blk)
      THEN lower(trim(json_extract_string(blk, '$.type'))) END AS t,
    CASE WHEN blk <> '' AND json_valid(blk)
      THEN TRY_CAST(json_extract_string(blk, '$.confidence') AS DOUBLE) END AS c
  FROM blocks),
parsed AS (
  SELECT *, {_ALIAS.format(t='t')} AS ai_label,
         greatest(0.0, least(1.0, coalesce(c, 0.0)))::DOUBLE AS ai_confidence
  FROM fields)"""

LABELLED = PARSED + """,
labelled AS (
  SELECT qid, query, gold, CASE WHEN event_type <> 'error' THEN ai_label END AS ai FROM parsed)"""

VOTES = PARSED + """,
per_label AS (
  SELECT CAST(user_id AS VARCHAR) AS qid, CAST(event_id % 2 AS INTEGER) AS attempt, ai_label,
         count(*) AS votes, sum(CAST(round(ai_confidence * 1000000) AS BIGINT)) AS micro,
         max(ai_confidence) AS top, min(event_id) AS seen
  FROM parsed GROUP BY ALL),
ranked AS (
  SELECT *, micro::DOUBLE / (votes * 1000000)::DOUBLE AS ai_confidence,
         row_number() OVER (PARTITION BY qid, attempt
           ORDER BY votes DESC, micro::DOUBLE / (votes * 1000000)::DOUBLE DESC, top DESC, seen) AS place
  FROM per_label),
votes AS (SELECT qid, attempt, ai_label, ai_confidence, votes FROM ranked WHERE place = 1)"""

_FLAGS = (
    "concat_ws(',', "
    f"CASE WHEN NOT coalesce(ai_label IN {_IN_CLASSES} AND ai_confidence BETWEEN 0 AND 1, false)"
    " THEN 'invalid_label' END, "
    "CASE WHEN ai_confidence < 0.6 THEN 'low_confidence' END, "
    "CASE WHEN ai_label = 'abstain' THEN 'abstain' END)"
)


def _fold(votes: str, name: str, retries: int = 1) -> str:
    return f"""
{name}_flagged AS (SELECT *, {_FLAGS} AS flags FROM {votes}),
{name}_settled AS (
  SELECT *, false AS needs_retry,
         row_number() OVER (PARTITION BY qid ORDER BY attempt) AS place
  FROM {name}_flagged WHERE flags = '' OR attempt >= {retries}),
{name}_latest AS (
  SELECT *, true AS needs_retry,
         row_number() OVER (PARTITION BY qid ORDER BY attempt DESC) AS place
  FROM {name}_flagged WHERE qid NOT IN (SELECT qid FROM {name}_settled)),
{name} AS (
  SELECT qid, ai_label, ai_confidence, flags, needs_retry, attempt AS retry_count,
         ai_label AS final_type
  FROM (SELECT * FROM {name}_settled UNION ALL SELECT * FROM {name}_latest)
  WHERE place = 1)"""


LOG = f"""
log AS (
  SELECT CAST(doc_id AS VARCHAR) AS qid, text AS query, {_gold('n_chars')} AS label,
         lang, source FROM documents)"""

RATED = """
rated AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS qid, d.text AS query,
    CASE WHEN quality = 1 AND toxic = 0 THEN 'Factual'
         WHEN quality = 1 AND toxic = 1 THEN 'Transactional'
         WHEN quality = 0 AND toxic = 0 THEN 'Abstain'
         WHEN quality = 0 AND toxic = 1 THEN 'Navigational' END AS label,
    d.lang AS data_split, d.source AS url
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

TURNS = """
turns AS (SELECT conv_id || '-' || turn AS qid, text AS query FROM conversations)"""

_CLEAN = (
    "trim(regexp_replace(regexp_replace(lower(query), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), "
    "'\\s+', ' ', 'g'))"
)


def _digest(column: str, name: str) -> str:
    return f"md5({column}) AS {name}_md5, CAST(length({column}) AS INTEGER) AS {name}_chars"


def _plain_sample(table: str, k: int, columns: str) -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER "
        f"(ORDER BY md5('42:' || qid), qid) AS place FROM {table}) WHERE place <= {k}"
    )


# --- prompts ---

_ASK = _text(prompts.ASK_ZEROSHOT) + " || 'Query: \"' || query || '\"'"
_ASK_WITH_EXAMPLES = _text(prompts.ASK_FEWSHOT) + " || 'Query: \"' || query || '\"'"

POOL = """
pool AS (
  SELECT trim(text) AS query, CASE item_id % 5 WHEN 0 THEN 'navigational' WHEN 1 THEN 'factual'
         WHEN 2 THEN 'transactional' WHEN 3 THEN 'instrumental' ELSE 'abstain' END AS type
  FROM benchmark WHERE trim(text) <> ''),
shots AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || query), query, type) AS place FROM pool
  QUALIFY place <= 8)"""


def _judge_prompt(mode: str) -> str:
    human = (
        "|| chr(10) || 'Human label: ' || coalesce(lower(trim(gold)), '') "
        if mode == "compare_to_human" else ""
    )
    return (
        f"{_text(prompts.DEFINITIONS)} || chr(10) || 'Query: \"' || query || '\"' {human}"
        f"|| chr(10) || 'Model label: ' || coalesce(lower(trim(ai)), '') || chr(10) || "
        f"{_text(prompts.JUDGE_ANSWER[mode])}"
    )


# --- judge ---


def _verdicts(source: str) -> str:
    """Judge replies are readable unless the confidence is a word."""
    return f"""
verdicts AS (
  SELECT qid,
    CASE WHEN m % 7 = 0 OR m % 6 = 5 THEN 'abstain' WHEN m % 6 = 0 THEN 'navigational'
         WHEN m % 6 = 1 THEN 'factual' WHEN m % 6 = 2 THEN 'transactional'
         WHEN m % 6 = 3 THEN 'instrumental' ELSE 'abstain' END AS judge_label,
    CASE WHEN m % 7 <> 0 AND m % 3 = 0 THEN 'correct' ELSE 'incorrect' END AS judge_decision,
    CASE WHEN m % 7 = 0 THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, cs::DOUBLE) END
      AS judge_confidence,
    CASE WHEN m % 7 = 0 THEN 'unreadable reply' ELSE left(repeat('x', m % 200), 120) END
      AS judge_rationale
  FROM {source})"""


def _metrics(rows: str, judged: str | None = None) -> str:
    """CTEs `per` (class rows) and `whole` (one row) over `rows`(gold, ai)."""
    marks = f"SELECT * FROM {judged}" if judged else (
        "SELECT NULL::VARCHAR AS ai, NULL::VARCHAR AS judge_label, NULL::VARCHAR AS judge_decision"
        " WHERE false"
    )
    return f"""
{CLASS_TABLE},
pairs AS (
  SELECT lower(trim(gold)) AS y, lower(trim(ai)) AS p FROM {rows} WHERE gold IS NOT NULL),
marks AS ({marks}),
size AS (SELECT count(*) AS n FROM pairs),
counts AS (
  SELECT ord, class,
    (SELECT count(*) FROM pairs WHERE y = class AND p = class) AS tp,
    (SELECT count(*) FROM pairs WHERE y = class AND p IN {_IN_CLASSES}) AS r_n,
    (SELECT count(*) FROM pairs WHERE p = class AND y IN {_IN_CLASSES}) AS c_n,
    (SELECT count(*) FROM pairs WHERE y = class) AS t_n,
    (SELECT count(*) FROM pairs WHERE p = class) AS q_n,
    (SELECT count(*) FROM marks WHERE ai = class) AS judged,
    (SELECT count(*) FROM marks WHERE ai = class AND judge_decision = 'correct') AS approved,
    (SELECT count(*) FROM marks WHERE ai = class AND judge_label = class) AS j_tp,
    (SELECT count(*) FROM marks WHERE judge_label = class AND ai IN {_IN_CLASSES}) AS j_r,
    (SELECT count(*) FROM marks WHERE ai = class AND judge_label IN {_IN_CLASSES}) AS j_c
  FROM classes),
rates AS (
  SELECT *, CASE WHEN c_n = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / c_n::DOUBLE END AS pr,
    CASE WHEN r_n = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / r_n::DOUBLE END AS re,
    (t_n::HUGEINT * q_n + (n - t_n)::HUGEINT * (n - q_n)) AS chance, n
  FROM counts, size),
per AS (
  SELECT ord, class, pr AS precision, re AS recall,
    CASE WHEN pr + re = 0 THEN 0.0::DOUBLE ELSE 2 * pr * re / (pr + re) END AS f1,
    r_n AS support,
    CASE WHEN judged > 0 THEN approved::DOUBLE / judged::DOUBLE END AS judge_score,
    CASE WHEN n::HUGEINT * n = chance THEN 0.0::DOUBLE
      ELSE (n::HUGEINT * (n - t_n - q_n + 2 * tp) - chance)::DOUBLE
           / (n::HUGEINT * n - chance)::DOUBLE END AS cohen_kappa
  FROM rates),
sums AS (
  SELECT sum(r_n)::HUGEINT AS n_in, sum(tp)::HUGEINT AS agreed,
    sum(r_n::HUGEINT * c_n) AS chance, sum(judged) AS judged, sum(approved) AS approved,
    sum(j_r)::HUGEINT AS j_n, sum(j_tp)::HUGEINT AS j_agreed, sum(j_r::HUGEINT * j_c) AS j_chance
  FROM counts),
lists AS (
  SELECT list(precision ORDER BY ord) AS ps, list(recall ORDER BY ord) AS rs,
         list(f1 ORDER BY ord) AS fs FROM per),
whole AS (
  SELECT (ps[1] + ps[2] + ps[3] + ps[4] + ps[5]) / 5 AS macro_precision,
    (rs[1] + rs[2] + rs[3] + rs[4] + rs[5]) / 5 AS macro_recall,
    (fs[1] + fs[2] + fs[3] + fs[4] + fs[5]) / 5 AS macro_f1,
    n AS support,
    CASE WHEN judged > 0 THEN approved::DOUBLE / judged::DOUBLE END AS judge_score,
    CASE WHEN n_in * n_in = chance THEN 0.0::DOUBLE
      ELSE (n_in * agreed - chance)::DOUBLE / (n_in * n_in - chance)::DOUBLE END AS cohen_kappa,
    CASE WHEN j_n * j_n = j_chance THEN 0.0::DOUBLE
      ELSE (j_n * j_agreed - j_chance)::DOUBLE / (j_n * j_n - j_chance)::DOUBLE END
      AS ai_judge_kappa,
    (SELECT count(*) FROM pairs WHERE y = p)::DOUBLE / n::DOUBLE AS accuracy
  FROM lists, sums, size)"""


_TABLE = """
SELECT class, precision, recall, f1, support, judge_score, cohen_kappa FROM per
UNION ALL
SELECT 'ALL', macro_precision, macro_recall, macro_f1, support, judge_score, cohen_kappa
FROM whole"""

JUDGED_EVENTS = LABELLED + "," + _verdicts("ev") + """,
judged AS (
  SELECT l.ai, v.judge_label, v.judge_decision FROM labelled l JOIN verdicts v USING (qid)
  WHERE gold IS NOT NULL)"""


def _broken(limit: str) -> str:
    return f"""
WITH {EVENTS},
bad AS (
  SELECT event_id AS row_id, 'label' AS path, 'is missing' AS error FROM ev WHERE gold IS NULL
  UNION ALL
  SELECT event_id, 'label', 'abstain is not one of ' || '{", ".join(CLASSES[:4])}'
  FROM ev WHERE lower(trim(gold)) = 'abstain'
  UNION ALL
  SELECT event_id, 'ai_confidence', 'is not between 0.0 and 1.0' FROM ev WHERE cs::DOUBLE > 1
  UNION ALL
  SELECT event_id, 'props', 'does not match [1-9]' FROM ev
  WHERE NOT regexp_matches(props, '[1-9]'))
SELECT * FROM bad {limit}"""


def _cue(name: str) -> str:
    return f"CASE WHEN regexp_matches(w, ' ({'|'.join(CUE_WORDS[name])}) ') THEN 1 ELSE 0 END"


RULES = f"""
worded AS (SELECT *, ' ' || {_CLEAN} || ' ' AS w FROM log),
cued AS (
  SELECT *, {", ".join(f"{_cue(c)} AS {c}" for c in CUE_WORDS)} FROM worded),
ruled AS (
  SELECT qid, label AS gold,
    CASE WHEN navigational = 1 THEN 'navigational' WHEN transactional = 1 THEN 'transactional'
         WHEN instrumental = 1 THEN 'instrumental' WHEN factual = 1 THEN 'factual'
         ELSE 'abstain' END AS ai,
    CASE navigational + transactional + instrumental + factual
      WHEN 0 THEN 0.4 WHEN 1 THEN 0.9 ELSE 0.7 END::DOUBLE AS ai_confidence
  FROM cued)"""

ORACLE_SQL = {
    "load_clean": f"""
WITH {LOG}, cleaned AS (SELECT *, {_CLEAN} AS q FROM log)
SELECT qid, {_digest('q', 'query')}, lang AS human_label_coarse, source AS human_label_fine,
       label AS human_label_gold, label AS human_label, lang AS data_split, source AS url
FROM cleaned""",
    "split_filter": f"""
WITH {LOG} SELECT qid, lang AS data_split, source AS url FROM log WHERE lower(lang) = 'en'""",
    "random_sample": f"""
WITH {LOG} {_plain_sample('log', 200, "qid, " + _digest('query', 'query'))}""",
    "balanced_sample": f"""
WITH {RATED},
named AS (SELECT *, lower(trim(label)) AS cls FROM rated),
classes AS (
  SELECT cls, row_number() OVER (ORDER BY cls) AS i, count(*) OVER () AS m
  FROM (SELECT DISTINCT cls FROM named WHERE cls IS NOT NULL)),
quotas AS (SELECT cls, 200 // m + CASE WHEN i <= 200 % m THEN 1 ELSE 0 END AS quota FROM classes),
ranked AS (
  SELECT n.*, quota, row_number() OVER (PARTITION BY n.cls ORDER BY md5('42:' || qid), qid) AS place
  FROM named n LEFT JOIN quotas q ON n.cls = q.cls),
taken AS (SELECT * FROM ranked WHERE place <= quota),
others AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:topup:' || qid), qid) AS turn
  FROM ranked WHERE quota IS NULL OR place > quota)
SELECT qid, label, {_digest('query', 'query')} FROM taken
UNION ALL
SELECT qid, label, {_digest('query', 'query')} FROM others
WHERE turn <= 200 - (SELECT count(*) FROM taken)""",
    "drop_null_gold": f"""
WITH {RATED} SELECT qid, label AS human_label_gold FROM rated WHERE label IS NOT NULL""",
    "label_normalize": f"""
WITH {PARSED} SELECT qid, lower(trim(gold)) AS human_label, ai_label FROM parsed""",
    "parse_reply": f"WITH {PARSED} SELECT qid, ai_label, ai_confidence FROM parsed",
    "vote": f"WITH {VOTES} SELECT * FROM votes",
    "fewshot_pool": f"WITH {POOL} SELECT query, type FROM shots",
    "prompt_zeroshot": f"""
WITH {TURNS}, asked AS (
  SELECT qid, {_ASK} AS prompt, {_text(prompts.SYSTEM_ZEROSHOT)} AS system FROM turns)
SELECT qid, {_digest('prompt', 'prompt')}, {_digest('system', 'system')} FROM asked""",
    "prompt_fewshot": f"""
WITH {TURNS}, {POOL},
block AS (
  SELECT string_agg('"' || query || '" -> ' || type, chr(10) ORDER BY place) AS b FROM shots),
asked AS (
  SELECT qid, (SELECT b FROM block) || chr(10) || chr(10) || {_ASK_WITH_EXAMPLES} AS prompt
  FROM turns)
SELECT qid, {_digest('prompt', 'prompt')} FROM asked""",
    "replay_join": f"""
WITH {PARSED}
SELECT CAST(user_id AS VARCHAR) AS qid, 'user ' || user_id AS query,
       CAST(event_id % 2 AS INTEGER) AS attempt, event_id AS vote, ai_label, ai_confidence
FROM parsed""",
    "rule_annotate": f"WITH {LOG}, {RULES} SELECT qid, ai AS ai_label, ai_confidence FROM ruled",
    "model_replies": f"""
WITH {TURNS}, asked AS (SELECT qid, length({_ASK}) % 7 AS k FROM turns)
SELECT qid, CASE k WHEN 0 THEN 'navigational' WHEN 1 THEN 'factual' WHEN 2 THEN 'transactional'
            WHEN 3 THEN 'instrumental' ELSE 'abstain' END AS ai_label,
       CASE WHEN k > 4 THEN 0.0 ELSE ('0.' || k || '5')::DOUBLE END AS ai_confidence
FROM asked""",
    "validate_flags": f"""
WITH {EVENTS}, rows AS (
  SELECT qid, CASE event_type WHEN 'click' THEN 'nav' WHEN 'view' THEN 'factual'
              WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'abstain' END AS ai_label,
         CASE WHEN event_type IN ('click', 'view', 'purchase', 'signup')
              THEN cs::DOUBLE END AS ai_confidence
  FROM ev), flagged AS (SELECT *, {_FLAGS} AS flags FROM rows)
SELECT *, flags <> '' AS needs_retry FROM flagged""",
    "retry_fold": f"WITH {VOTES}, {_fold('votes', 'folded')} SELECT * FROM folded",
    "pending_requests": f"""
WITH {VOTES}, {LOG}, {_fold('votes', 'folded', 2)},
waiting AS (
  SELECT l.qid, coalesce(f.retry_count + 1, 0) AS attempt, l.query
  FROM log l LEFT JOIN folded f ON l.qid = f.qid
  WHERE f.ai_label IS NULL OR coalesce(f.needs_retry, false)),
asked AS (SELECT qid, CAST(attempt AS INTEGER) AS attempt, {_ASK} AS prompt FROM waiting)
SELECT qid, attempt, {_digest('prompt', 'prompt')} FROM asked""",
    "merge_labels": f"""
WITH {VOTES},
one AS (SELECT *, {_FLAGS} <> '' AS waits FROM votes WHERE attempt = 0),
two AS (SELECT * FROM votes WHERE attempt = 1)
SELECT one.qid,
  CASE WHEN waits AND two.qid IS NOT NULL THEN two.ai_label ELSE one.ai_label END AS ai_label,
  CASE WHEN waits AND two.qid IS NOT NULL THEN two.ai_confidence ELSE one.ai_confidence END
    AS ai_confidence,
  waits AND two.qid IS NULL AS needs_retry,
  CAST(CASE WHEN waits AND two.qid IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS retry_count,
  CASE WHEN waits AND two.qid IS NOT NULL THEN 'second' ELSE 'first' END AS model_name,
  CASE WHEN waits AND two.qid IS NOT NULL THEN 'v2' ELSE 'v1' END AS prompt_version
FROM one LEFT JOIN two ON one.qid = two.qid""",
    "constraint_errors": _broken(""),
    "constraint_errors_first": _broken("WHERE row_id = (SELECT min(row_id) FROM bad)"),
    "confusion": f"""
WITH {LABELLED}, {CLASS_TABLE}
SELECT a.class AS y, b.class AS p,
       (SELECT count(*) FROM labelled WHERE lower(trim(gold)) = a.class AND ai = b.class) AS n
FROM classes a, classes b""",
    "prf_by_class": f"""
WITH {LABELLED}, {_metrics('labelled')} SELECT class, precision, recall, f1, support FROM per""",
    "kappa_overall": f"WITH {LABELLED}, {_metrics('labelled')} SELECT cohen_kappa FROM whole",
    "kappa_by_class": f"WITH {LABELLED}, {_metrics('labelled')} SELECT class, cohen_kappa FROM per",
    "prediction_counts": f"""
WITH {LABELLED}, {CLASS_TABLE}
SELECT class, (SELECT count(*) FROM labelled WHERE ai = class) AS support FROM classes""",
    "metrics_table": f"WITH {JUDGED_EVENTS}, {_metrics('labelled', 'judged')} {_TABLE}",
    "summary": f"""
WITH {JUDGED_EVENTS}, {_metrics('labelled', 'judged')}
SELECT accuracy, macro_precision, macro_recall, macro_f1, cohen_kappa, judge_score,
       ai_judge_kappa, true AS has_human_labels, 'audit' AS judge_mode FROM whole""",
    "judge_sample": f"""
WITH {LABELLED}, golden AS (SELECT * FROM labelled WHERE gold IS NOT NULL)
{_plain_sample('golden', 500, 'qid, gold AS human_label_gold, ai AS ai_label')}""",
    "judge_prompt": f"""
WITH {LABELLED}, asked AS (
  SELECT qid, {_judge_prompt('compare_to_human')} AS compare, {_judge_prompt('audit')} AS audit
  FROM labelled)
SELECT qid, {_digest('compare', 'compare')}, {_digest('audit', 'audit')} FROM asked""",
    "judge_parse": f"""
WITH {EVENTS}, {_verdicts('ev')}
SELECT qid, judge_decision, judge_confidence, judge_rationale FROM verdicts""",
    "audit_parse": f"""
WITH {EVENTS}, {_verdicts('ev')}
SELECT qid, judge_label, judge_decision, judge_confidence, judge_rationale FROM verdicts""",
    "judge_rows": f"""
WITH {LABELLED}, {_verdicts('ev')},
golden AS (SELECT * FROM labelled WHERE gold IS NOT NULL),
sample AS ({_plain_sample('golden', 500, '*')})
SELECT s.qid, s.query, lower(trim(s.gold)) AS human_label_gold, s.ai AS ai_label,
       v.judge_decision, v.judge_confidence, v.judge_rationale
FROM sample s JOIN verdicts v ON s.qid = v.qid""",
    "judge_score": f"""
WITH {JUDGED_EVENTS}, scored AS (
  SELECT ai, count(*) AS judged, count(*) FILTER (judge_decision = 'correct') AS approved
  FROM judged WHERE ai IN {_IN_CLASSES} GROUP BY ai),
{CLASS_TABLE},
both_levels AS (
  SELECT class, coalesce(judged, 0) AS judged, coalesce(approved, 0) AS approved
  FROM classes LEFT JOIN scored ON ai = class
  UNION ALL SELECT 'ALL', sum(judged)::BIGINT, sum(approved)::BIGINT FROM scored)
SELECT *, CASE WHEN judged > 0 THEN approved::DOUBLE / judged::DOUBLE END AS judge_score
FROM both_levels""",
    "audit_kappa": f"""
WITH {JUDGED_EVENTS}, {_metrics('labelled', 'judged')}
SELECT ai_judge_kappa, judge_score FROM whole""",
    "replay_run": f"""
WITH {VOTES}, {_fold('votes', 'folded')}, {RATED},
answered AS (
  SELECT r.qid, r.label AS gold, coalesce(f.final_type, 'abstain') AS ai
  FROM rated r LEFT JOIN folded f ON r.qid = f.qid),
first_event AS (
  SELECT CAST(user_id AS VARCHAR) AS qid, m, cs FROM numbered_events
  WHERE event_id = first_id),
{_verdicts('first_event')},
golden AS (SELECT * FROM answered WHERE gold IS NOT NULL),
sample AS ({_plain_sample('golden', 500, '*')}),
judged AS (
  SELECT s.ai, v.judge_label, coalesce(v.judge_decision, 'incorrect') AS judge_decision
  FROM sample s LEFT JOIN verdicts v ON s.qid = v.qid),
{_metrics('answered', 'judged')} {_TABLE}""".replace(
        "first_event AS (",
        "numbered_events AS (SELECT *, min(event_id) OVER (PARTITION BY user_id) AS first_id FROM ev),\n"
        "first_event AS (",
    ),
    "replay_labels": f"""
WITH {VOTES}, {_fold('votes', 'folded')}, {RATED}, whole AS (
  SELECT r.qid, {_CLEAN.replace('query', 'r.query')} AS q, r.label AS human_label_gold, r.data_split, r.url,
         coalesce(ai_label, 'abstain') AS ai_label, coalesce(ai_confidence, 0.0::DOUBLE) AS ai_confidence,
         coalesce(flags, 'low_confidence,abstain') AS flags, coalesce(needs_retry, false) AS needs_retry,
         CAST(coalesce(retry_count, 0) AS INTEGER) AS retry_count, coalesce(final_type, 'abstain') AS final_type
  FROM rated r LEFT JOIN folded f ON r.qid = f.qid)
SELECT * EXCLUDE (q), {_digest('q', 'query')}, 'replayed' AS model_name, 'table' AS provider,
       'v1' AS prompt_version, 'v1' AS taxonomy_version FROM whole""",
    "rule_flags": f"""
WITH {LOG}, {RULES.replace('SELECT qid, label AS gold,', 'SELECT qid, q, label AS gold,').replace(
    'SELECT *, ' + "' '", 'SELECT *, ' + _CLEAN + " AS q, ' '")},
flagged AS (SELECT q, ai AS ai_label, ai_confidence FROM ruled),
shown AS (SELECT *, {_FLAGS} AS flags FROM flagged)
SELECT ai_label, flags, flags <> '' AS needs_retry, count(*) AS n, CAST(sum(length(q)) AS BIGINT) AS query_chars
FROM shown GROUP BY ALL""",
    "rule_run": f"WITH {LOG}, {RULES}, {_metrics('ruled')} {_TABLE}",
}
