"""DuckDB SQL for the operators that SQL can express."""

from farebox.llm.rules import FOREIGN, FOREIGN_LETTER, STOP_WORDS

_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)

OP3 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
lines AS (
  SELECT r, l FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
of_lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines,
         count(*) FILTER (WHERE regexp_matches(l, '^[\x20\x09-\x0D]*[-*•]')) AS bullets,
         count(*) FILTER (WHERE regexp_matches(l, '(\.\.\.|…)[\x20\x09-\x0D]*$')) AS ellipses
  FROM lines GROUP BY r),
s AS (
  SELECT doc_id, len(w) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         greatest(coalesce(n_lines, 0), 1) AS n_lines, coalesce(bullets, 0) AS bullets,
         coalesce(ellipses, 0) AS ellipses, greatest(len(w), 1) AS n,
         len(regexp_extract_all(t, '!!')) AS shouts, len(regexp_extract_all(t, '{FOREIGN_LETTER}')) AS foreign_letters,
         len([x FOR x IN w IF lower(x) IN ({_STOPS})]) AS stop_words,
         len([x FOR x IN w IF regexp_matches(x, '^[^0-9A-Za-z\x80-\x{{10FFFF}}]*[A-Za-z\x80-\x{{10FFFF}}]')]) AS alphabetic
  FROM d LEFT JOIN covered USING (r) LEFT JOIN of_lines USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n >= 2 AND word_chars / n <= 20 AND n_symbols / n <= 0.2
       AND shouts / n <= 0.4 AND alphabetic / n >= 0.5 AND (foreign_letters > {FOREIGN} * word_chars OR stop_words / n >= 0.02) AND n_dup_lines / n_lines <= 0.5
       AND bullets / n_lines <= 0.9 AND ellipses / n_lines <= 0.4 AS kept
FROM b
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


OP8 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lower('text')}, '{_WORD}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_lower('text')}, '{_WORD}') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, size, list_aggregate(w[s : s + size - 1], 'string_agg', ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 13) AS size, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s
        FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM grams),
probes AS (
  SELECT r, s, size, list_aggregate(w[s : s + size - 1], 'string_agg', ' ') AS g
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)),
found AS (SELECT r, s, size, item_id FROM probes JOIN grams USING (size, g)),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(s, s + size)) AS p FROM (SELECT DISTINCT r, s, size FROM found)) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""



def _clusters(rounds: int) -> str:
    """Every round as two tables: the nearest centroid of each vector, and the centroids that follow."""
    assign = """
    SELECT v, arg_min(j, (d, j)) AS j, min(d) AS d
    FROM (SELECT v, j, list_sum(list_transform(list_zip(x.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
          FROM x, c{r} c)
    GROUP BY v"""
    move = """
    SELECT c.j, coalesce(m.x, c.x) AS x
    FROM c{r} c LEFT JOIN (
      SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x
      FROM (SELECT j, i, sum(e)::BIGINT AS s, count(*) AS n
            FROM (SELECT a.j, generate_subscripts(x.x, 1) AS i, unnest(x.x) AS e FROM a{r} a JOIN x USING (v))
            GROUP BY j, i)
      GROUP BY j) m USING (j)"""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED ({assign.format(r=r)})")
        if r < rounds:
            steps.append(f"c{r + 1} AS MATERIALIZED ({move.format(r=r)})")
    return ",\n".join(steps)


OP13 = f"""
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS v, vec_id,
         list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS j, x FROM x
  ORDER BY sha256('3:' || vec_id), x LIMIT 8),
{_clusters(10)},
inertia AS (SELECT j, sum(d)::BIGINT AS d FROM a10 GROUP BY j)
SELECT x.vec_id, a.j::INTEGER AS cluster, a.d::BIGINT AS distance, i.d AS cluster_inertia,
       (SELECT sum(d)::BIGINT FROM a10) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a10 a JOIN x USING (v) JOIN inertia i USING (j) JOIN c10 c USING (j)
"""

ORACLE = {"op3_quality_rules": OP3, "op8_decontamination": OP8, "op13_centroids": OP13}
