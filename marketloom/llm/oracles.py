"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

BLANKS = r"[\x20\x09-\x0D]"

EXACT_DEDUP = rf"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    sha256(regexp_replace(coalesce(text, ''), '{BLANKS}', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
"""

# The line rules as written in ``quality``.
QUALITY_LINES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
), grams AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM w, unnest(range(1, len(words) - 1)) AS t(i)
), again AS (
  SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), repeats AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, unnest([0, 1, 2]) AS t(k) GROUP BY r
), lines AS (
  SELECT r, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
    len(regexp_extract_all(line, '[#*$%&<>]{{2,}}')) AS symbols,
    len(regexp_extract_all(line, '[!?]{{2,}}')) AS shouts,
    len(regexp_extract_all(line, '[|»›•·]')) AS bars,
    len(regexp_extract_all(array_to_string(regexp_extract_all(lower(line),
      'accept all cookies|all rights reserved|back to top|click here|cookie policy|'
      || 'enable javascript|follow us on|lorem ipsum|privacy policy|sign up for our newsletter|skip to content|'
      || 'terms of service|terms of use'), ' '), '[^\x20\x09-\x0D]+')) AS mentions
  FROM d, unnest(string_split(text, chr(10))) AS t(line)
), failed AS (
  SELECT *, (words >= 10 AND NOT regexp_matches(line, '[.!?:;]')) OR (symbols > 0 AND 5 * symbols >= words)
    OR (shouts > 0 AND 5 * shouts >= words) OR (bars >= 2 AND 5 * bars >= words)
    OR (mentions > 0 AND 5 * mentions >= words) AS fails
  FROM lines
), per AS (
  SELECT r, sum(words) FILTER (fails) AS lost,
    count(*) FILTER (words > 0) - count(DISTINCT line) FILTER (words > 0) AS dup
  FROM failed GROUP BY r
), figures AS (
  SELECT doc_id, len(w.words) AS n_words, length(regexp_replace(text, '{BLANKS}', '', 'g')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, dup AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, CAST(coalesce(lost, 0) AS BIGINT) AS lost_words
  FROM d JOIN w USING (r) JOIN per USING (r) LEFT JOIN repeats USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_words <= 30 * n_words AS kept
FROM figures
"""


def _vector_codes(rounds: int = 2, parts: int = 16, entries: int = 64, width: int = 4) -> str:
    """Rounds of integer k-means by part, over vectors of ``parts * width`` components."""
    names = [f"x{d}" for d in range(width)]
    nearest = f"""
  SELECT r, part, min(struct_pack(d := {" + ".join(f"(p.{x} - c.{x}) * (p.{x} - c.{x})" for x in names)}, e := entry)) AS best
  FROM p JOIN c{{n}} c USING (part) GROUP BY r, part"""
    steps = [
        f"""a{n} AS ({nearest.format(n=n)}
), m{n} AS (
  SELECT part, best.e AS entry, {", ".join(f"CAST(floor(sum({x}) / count(*)) AS BIGINT) AS {x}" for x in names)}
  FROM a{n} JOIN p USING (r, part) GROUP BY part, best.e
), c{n + 1} AS (
  SELECT part, entry, {", ".join(f"coalesce(m.{x}, c.{x}) AS {x}" for x in names)}
  FROM c{n} c LEFT JOIN m{n} m USING (part, entry)
)"""
        for n in range(rounds)
    ]
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT r, vec_id, part, {", ".join(f"x[{width} * part + {d + 1}] AS x{d}" for d in range(width))}
  FROM v, unnest(range({parts})) AS t(part)
), c0 AS (
  SELECT part, place - 1 AS entry, {", ".join(names)}
  FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id NULLS LAST, r) AS place FROM p)
  WHERE place <= {entries}
), {", ".join(steps)}, a AS ({nearest.format(n=rounds)}
), coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg({" || ',' || ".join(names)}, ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM coded JOIN v USING (r)
"""


ORACLES = {
    "op2_quality_lines": QUALITY_LINES,
    "op4_exact_dedup": EXACT_DEDUP,
    "op13_vector_codes": _vector_codes(),
}
