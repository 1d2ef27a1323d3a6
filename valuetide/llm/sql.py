"""DuckDB statements for the queries that SQL can express."""

# One row for each document; the ranking runs over whole sources here.
PARETO_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, text,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS place
  FROM sized GROUP BY source
), weighted AS (
  SELECT source, source_size, CAST(source_size AS DOUBLE) * 2.0 AS stop,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(place - 1) % 3 + 1] AS weight
  FROM per
), levels AS (
  SELECT (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
          - CAST(coalesce(sum(source_size) OVER up, 0) AS DOUBLE) * 2.0::DOUBLE)
         / sum(weight) OVER down AS level
  FROM weighted
  WINDOW up AS (ORDER BY stop / weight, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         down AS (ORDER BY stop / weight, source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), targets AS (
  SELECT source, source_size, least(stop, weight * (SELECT max(level) FROM levels)) AS target
  FROM weighted
), shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets
), drawn AS (
  SELECT d.doc_id, d.size, d.text, s.source, s.source_size, s.target, s.whole,
         s.target - s.whole * s.source_size AS remaining,
         (CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
               AS DOUBLE) + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM sized d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source
), ranked AS (
  SELECT *, CASE WHEN size > 0 AND remaining > 0 THEN
    (u / (1.0::DOUBLE - u)) / ((remaining / source_size) / (1.0::DOUBLE - remaining / source_size)
                               * sqrt(CAST(size AS DOUBLE))) END AS rank
  FROM drawn
), placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size, text
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS words
  FROM ranked
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN rank IS NOT NULL AND 2 * words - size <= 2 * remaining
                                 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""


def vector_codes() -> str:
    """All parts against all entries, as rows of components."""
    rounds, last = [], "book0"
    for k in range(3):
        rounds.append(f"""
apart{k} AS (
  SELECT r, part, entry, sum((c.v - b.v) * (c.v - b.v)) AS d
  FROM components c JOIN {last} b USING (part, place) GROUP BY r, part, entry
), codes{k} AS (
  SELECT r, part, min({{'d': d, 'entry': entry}}).entry AS entry, min(d) AS d FROM apart{k} GROUP BY r, part
)""")
        if k < 2:
            rounds.append(f"""
means{k} AS (
  SELECT part, entry, place, sum(v) AS s, count(*) AS n
  FROM components JOIN codes{k} USING (r, part) GROUP BY part, entry, place
), book{k + 1} AS (
  SELECT part, entry, place, CASE WHEN n IS NULL THEN b.v ELSE CAST((s - ((s % n) + n) % n) / n AS BIGINT) END AS v
  FROM book{k} b LEFT JOIN means{k} USING (part, entry, place)
)""")
            last = f"book{k + 1}"
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbered AS (
  SELECT r, CAST(len(embedding) / 16 AS BIGINT) AS width, unnest(range(0, len(embedding))) AS pos, unnest(embedding) AS x FROM kept
), components AS (
  SELECT r, CAST(floor(pos / width) AS BIGINT) AS part, pos % width AS place, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS v FROM numbered
), book0 AS (
  SELECT part, r AS entry, place, v FROM components WHERE r < 64
),{",".join(rounds)},
books AS (
  SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM {last}
), coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM codes2 GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books
"""


ORACLES = {"op2_pareto_mix": PARETO_MIX}

FOLDED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Windows are compared as joined strings; no word holds a space.
DECONTAMINATION = rf"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r,
         coalesce(regexp_extract_all({FOLDED.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         coalesce(regexp_extract_all({FOLDED.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k:k + 9], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM items WHERE len(w) > 0)
), placed AS (
  SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM docs, (SELECT DISTINCT n FROM windows))
), hits AS (
  SELECT r, k, n, item FROM placed JOIN windows USING (n, win)
), covered AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hits) GROUP BY r
), named AS (
  SELECT r, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS names
  FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

LINE_QUALITY = rf"""
WITH docs AS (
  SELECT doc_id, source AS host, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS raw
  FROM docs
), windows AS (
  SELECT r, k, array_to_string(w[k:k + 2], ' ') AS win
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS k FROM split)
), repeated AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest([k, k + 1, k + 2]) AS p
        FROM (SELECT r, k, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1)
  GROUP BY r
), lines AS (
  SELECT r, host,
         trim(regexp_replace(regexp_replace({FOLDED.format("line")}, '[\x20\x09-\x0D]+', ' ', 'g'),
                             '[0-9]+', '0', 'g'), ' ') AS line
  FROM (SELECT r, host, unnest(raw) AS line FROM split)
), held AS (
  SELECT host, line, count(DISTINCT r) AS n FROM lines GROUP BY host, line
), common AS (
  SELECT host, line FROM held WHERE n >= 3
), lost AS (
  SELECT r, sum(len(string_split(lines.line, ' '))) AS n
  FROM lines JOIN common ON lines.line = common.line AND lines.host IS NOT DISTINCT FROM common.host
  GROUP BY r
), counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(raw) - len(list_distinct(raw)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(lost.n, 0) AS BIGINT) AS n_common_words
  FROM split LEFT JOIN repeated USING (r) LEFT JOIN lost USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - n_common_words >= 0.5::DOUBLE * n_words AS kept, n_common_words
FROM judged
"""


def _places(pattern: str, group: int = 0) -> str:
    """A list of (start, end, string) of the matches of ``pattern`` in text."""
    return f"""
      list_transform(range(1, len(regexp_extract_all(text, '{pattern}')) + 1), lambda i: {{
        'start': list_sum(list_transform(string_split_regex(text, '{pattern}')[1:i], lambda x: length(x)))
                 + coalesce(list_sum(list_transform(regexp_extract_all(text, '{pattern}')[1:i - 1],
                                                    lambda x: length(x))), 0),
        'size': length(regexp_extract_all(text, '{pattern}')[i]),
        'string': regexp_extract_all(text, '{pattern}', {group})[i]}})"""


def secret_scan() -> str:
    """Every window's entropy is counted from scratch here; runs are joined as islands."""
    from . import secrets as s

    quoted = lambda p: p.replace("'", "''")
    kinds = ((quoted(s.ASSIGN), 2), (quoted(s.ACCESS), 0), (quoted(s.HEX), 0))
    base = " UNION ALL ".join(
        f"""SELECT r, {k} AS place, '{s.KINDS[k]}' AS kind, unnest({_places(p, g)}) AS m FROM docs
            WHERE regexp_matches(text, '{p}')"""
        for k, (p, g) in enumerate(kinds)
    )
    most = " ".join(f"WHEN regexp_matches(m.string, '{c}') THEN {s.highest_sum(b)}" for c, b in s.CLASSES)
    barred = " OR ".join(f"regexp_matches(m.string, '{p}')" for p in s.ALLOWED)
    terms = "[" + ", ".join(map(str, s.TERMS)) + "]"
    return f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents
), base AS (
  SELECT r, place, kind, CAST(m.start AS BIGINT) AS a, CAST(m.start + m.size AS BIGINT) AS b
  FROM ({base}) WHERE place > 0 OR length(m.string) >= {s.ASSIGN_LEAST}
), candidates AS (
  SELECT r, m.start AS pos, m.string AS string, CASE {most} END AS most
  FROM (SELECT r, unnest({_places(s.CANDIDATE)}) AS m FROM docs WHERE regexp_matches(text, '{s.CANDIDATE}'))
  WHERE NOT ({barred})
), windows AS (
  SELECT r, pos, most, k, string_split(string[k:k + {s.WINDOW - 1}], '') AS chars
  FROM (SELECT *, unnest(range(1, length(string) - {s.WINDOW - 2})) AS k FROM candidates)
), high AS (
  SELECT r, pos + k - 1 AS a FROM windows
  WHERE NOT regexp_matches(array_to_string(chars, ''), '{"|".join(s.PLACE_HOLDERS)}') AND list_sum(list_transform(list_distinct(chars), lambda c:
        {terms}[len(list_filter(chars, lambda x: x = c)) + 1])) <= most
), stepped AS (
  SELECT r, a, CASE WHEN a - lag(a) OVER (PARTITION BY r ORDER BY a) <= {s.WINDOW} THEN 0 ELSE 1 END AS fresh
  FROM high
), islands AS (
  SELECT r, min(a) AS a, max(a) + {s.WINDOW} AS b
  FROM (SELECT r, a, sum(fresh) OVER (PARTITION BY r ORDER BY a) AS island FROM stepped)
  GROUP BY r, island
), extra AS (
  SELECT r, 3 AS place, 'entropy' AS kind, a, b FROM islands i
  WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.r = i.r AND base.a <= i.a AND i.b <= base.b)
), named AS (
  SELECT r, string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY a, place, b) AS spans,
         count(*) FILTER (place = 3) AS n_entropy
  FROM (SELECT * FROM base UNION ALL SELECT * FROM extra) GROUP BY r
), plain AS (
  SELECT r, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place, b) AS spans,
         count(*) FILTER (place = 0) AS n0, count(*) FILTER (place = 1) AS n1, count(*) FILTER (place = 2) AS n2
  FROM base GROUP BY r
)
SELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n2, 0) AS BIGINT) AS n_hex, sha256(coalesce(plain.spans, '')) AS base_sha256,
       coalesce(named.spans, '') AS spans, CAST(coalesce(n_entropy, 0) AS BIGINT) AS n_entropy
FROM docs LEFT JOIN plain USING (r) LEFT JOIN named USING (r)
"""


ORACLES |= {
    "op1_secret_scan": secret_scan(),
    "op4_line_quality": LINE_QUALITY,
    "op10_decontamination": DECONTAMINATION,
    "op13_vector_codes": vector_codes(),
}
