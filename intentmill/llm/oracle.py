"""SQL for the corpus queries that SQL can express, over whole tables."""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_LETTERS} AS w FROM documents),
b AS (SELECT item_id, {_LETTERS} AS w FROM benchmark),
bi AS (
  SELECT item_id, w, least(13, len(w)) AS n, unnest(range(len(w) - least(13, len(w)) + 1)) AS i
  FROM b WHERE len(w) > 0
),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i + 1 : i + n], ' ') AS span FROM bi),
di AS (
  SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i
  FROM d CROSS JOIN (SELECT DISTINCT n FROM bw) WHERE len(w) >= n
),
dw AS (SELECT doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') AS span FROM di),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, span)),
places AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit),
counted AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN items USING (doc_id)
"""

REPEATS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(len(w) - 19)) AS i FROM d WHERE len(w) >= 20),
windows AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 20], ' ') AS span FROM starts),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY span ORDER BY doc_id, i) AS k FROM windows
  ) WHERE k > 1
),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
words AS (SELECT doc_id, unnest(range(len(w))) AS p, unnest(w) AS word FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
cut AS (
  SELECT doc_id, w, least(3, len(w)) AS n, unnest(range(len(w) - least(3, len(w)) + 1)) AS i
  FROM d WHERE len(w) > 0
),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + n], ' ') AS s FROM cut),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 90 * (p.n + q.n - k)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN sizes USING (doc_id)
"""

PHRASES = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOW}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
starts AS (SELECT lang, w, k, unnest(range(len(w) - k + 1)) AS i FROM w CROSS JOIN range(1, 4) AS t(k) WHERE len(w) >= k),
f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, array_to_string(w[i + 1 : i + k], ' ') AS phrase FROM starts)
  GROUP BY lang, k, phrase
),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 10),
cut AS MATERIALIZED (
  SELECT lang, k, phrase, a, c, array_to_string(w[:c], ' ') AS head, array_to_string(w[c + 1 :], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS c FROM cand)
),
parts AS (
  SELECT cut.lang, cut.k, cut.phrase, a, c, x.f AS l, y.f AS r,
         (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM cut
  JOIN f x ON x.lang = cut.lang AND x.phrase = head JOIN f y ON y.lang = cut.lang AND y.phrase = tail
),
scored AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS first FROM parts) WHERE first = 1
),
around AS (
  SELECT lang, array_to_string(w[s : s + 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest([1, 2]) AS s FROM cand WHERE k = 3) GROUP BY 1, 2
),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase AND s.k = 2
  WHERE o.longer IS NULL OR 100 * o.longer < 50 * a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

ARCHIVE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, octet_length(encode(t)) AS payload_bytes, sha1(t) AS payload_digest FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d),
r AS (SELECT *, payload_bytes >= 1000 AND last IS NOT NULL AND page_id IS DISTINCT FROM last AS again FROM k)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN last END AS refers_to
FROM r
"""

ORACLE_SQL = {
    "op5_winnowing": DECONTAMINATION,
    "op7_count_min": REPEATS,
    "op10_t_occurrence": JACCARD,
    "op12_best_first_phrases": PHRASES,
    "op13_warc_archive": ARCHIVE,
}
