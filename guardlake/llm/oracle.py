"""The same results in SQL, for the queries SQL can express on whole tables."""

from guardlake.llm.exact_dedup import UPPER
from guardlake.llm.queries import SOURCE_WEIGHTS

SQL = {}

SQL["op2_topk_search"] = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""

SQL["op6_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents)
WINDOW w AS (PARTITION BY t)
"""

_WEIGHTS = ", ".join(f"('{s}', {w!r}::DOUBLE)" for s, w in SOURCE_WEIGHTS.items())


def _uniform(key):
    return f"('0x' || substr(md5({key}), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE"


SQL["op7_mix_sources"] = f"""
WITH targets(source, weight) AS (VALUES {_WEIGHTS}),
n AS (SELECT source, count(*) AS n FROM documents JOIN targets USING (source) GROUP BY source),
rates AS (
  SELECT source, weight / sum(weight) OVER () * sum(n) OVER () / n AS rate FROM n JOIN targets USING (source)
), terms AS (
  SELECT source, k, exp(-rate) * CASE k WHEN 0 THEN 1.0::DOUBLE ELSE power(rate, k) END / gamma(k + 1.0) AS p
  FROM rates, range(0, 60) r(k)
), steps AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS upto FROM terms
), drawn AS (
  SELECT *, {_uniform("'42:' || coalesce(doc_id::VARCHAR, '')")} AS u FROM documents
), counted AS (
  SELECT d.doc_id, d.source, d.text,
         CASE WHEN any_value(s.source) IS NULL THEN 1 ELSE count(*) FILTER (s.upto <= d.u) END AS copies
  FROM drawn d LEFT JOIN steps s ON s.source = d.source GROUP BY d.doc_id, d.source, d.text, d.u
)
SELECT doc_id, source, c.copy::INTEGER AS copy,
       {_uniform("'42-place:' || coalesce(doc_id::VARCHAR, '') || ':' || c.copy")} AS place, text
FROM counted, range(1, copies + 1) c(copy)
"""

# Percentages of the rules, as plain numbers.
_GRAMS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}


def _covered(n):
    """Words of w in n-grams that occur twice or more (two), and in those that occurred earlier (again)."""
    frame = f"(PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"""
g{n} AS (
  SELECT doc_id, sum(chars) FILTER (again) AS chars{n}, count(*) FILTER (two) AS words{n} FROM (
    SELECT doc_id, chars, bool_or(g IS NOT NULL AND k > 1) OVER {frame} AS again,
           bool_or(g IS NOT NULL AND c > 1) OVER {frame} AS two
    FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS k, count(*) OVER (PARTITION BY doc_id, g) AS c
      FROM (SELECT doc_id, i, chars, CASE WHEN i + {n - 1} <= len(ws) THEN array_to_string(ws[i : i + {n - 1}], ' ') END AS g FROM w)
    )
  ) GROUP BY doc_id
)"""


_SPACE = r"[\x20\x09-\x0D]"
SQL["op12_repetition_rules"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
w AS (SELECT doc_id, ws, i, length(ws[i]) AS chars FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM s)),
{",".join(_covered(n) for n in _GRAMS)},
l AS (
  SELECT doc_id, count(*) AS n_dup_lines, sum(length(bare)) AS dup_line_chars FROM (
    SELECT doc_id, regexp_replace(line, '{_SPACE}+', '', 'g') AS bare,
           row_number() OVER (PARTITION BY doc_id, line ORDER BY j) AS k
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS j FROM d)
  ) WHERE k > 1 AND bare <> '' GROUP BY doc_id
), m AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(words8, 0) AS n_repeat_words, coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars,
         {", ".join(f"coalesce(chars{n}, 0)::BIGINT AS dup_{n}gram_chars" for n in _GRAMS)}
  FROM s LEFT JOIN l USING (doc_id) {" ".join(f"LEFT JOIN g{n} USING (doc_id)" for n in _GRAMS)}
), b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND 100 * dup_line_chars <= 20 * word_chars
  {" ".join(f"AND 100 * dup_{n}gram_chars <= {p} * word_chars" for n, p in _GRAMS.items())} AS kept
FROM b
"""

_TERMS = f"regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
SQL["op13_ranked_search"] = f"""
WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
l AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY doc_id),
g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM l),
w AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM f, g GROUP BY term
), q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term) JOIN l USING (doc_id), g GROUP BY item_id, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""
