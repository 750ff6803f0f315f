"""DuckDB SQL of the registered queries."""

from __future__ import annotations

from flightloom.llm import licenses, line_dedup, mixing, quality_rules

SIZE = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT"

OP1 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP3 = f"""
WITH pages AS (
  SELECT doc_id, source, text, coalesce(source, chr(0)) AS host, md5(coalesce(text, '')) AS page,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), lines AS (
  SELECT DISTINCT host, page, trim(regexp_replace(unnest(lines), '[\\t\\r]', ' ', 'g')) AS line FROM pages
), bad AS (
  SELECT host, line
  FROM (SELECT host, line, count(*) AS k FROM lines WHERE line <> '' GROUP BY ALL)
  JOIN (SELECT host, count(DISTINCT page) AS n FROM pages GROUP BY host) USING (host)
  WHERE k >= {line_dedup.LEAST_PAGES} AND k > n * {line_dedup.RATIO}::DOUBLE
), sites AS (SELECT host, list(line) AS bad FROM bad GROUP BY host)
SELECT doc_id, source,
       CASE WHEN text IS NULL THEN NULL ELSE array_to_string(list_filter(lines, lambda x:
         NOT list_contains(coalesce(bad, []), trim(regexp_replace(x, '[\\t\\r]', ' ', 'g')))), chr(10)) END AS text,
       CASE WHEN text IS NULL THEN 0 ELSE len(list_filter(lines, lambda x:
         list_contains(coalesce(bad, []), trim(regexp_replace(x, '[\\t\\r]', ' ', 'g'))))) END::INTEGER AS lines_dropped
FROM pages LEFT JOIN sites USING (host)
"""

OP6 = f"""
WITH d AS (
  SELECT doc_id, source, {SIZE} AS size, md5(coalesce(doc_id::VARCHAR, '')) AS o FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source
), f AS (
  SELECT *, 2 * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER () AS wanted,
         coalesce(sum(2 * source_size) OVER (ORDER BY (2 * source_size)::DOUBLE / w, rank
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS earlier,
         sum(w) OVER (ORDER BY (2 * source_size)::DOUBLE / w, rank
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS rest
  FROM s
), g AS (SELECT *, (wanted - earlier) / rest >= most::DOUBLE / w AS stops FROM f),
h AS (
  SELECT source, source_size, rank % 3 AS class,
         CASE WHEN stops THEN most::DOUBLE ELSE w * (
           (wanted - sum(CASE WHEN stops THEN most ELSE 0 END) OVER ()::DOUBLE)
           / sum(CASE WHEN stops THEN 0 ELSE w END) OVER ()::DOUBLE) END AS target
  FROM g
), r AS (
  SELECT doc_id, size, source_size, target, class,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id NULLS FIRST, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE + size / 2::DOUBLE AS middle
  FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source
), c AS (
  SELECT *, (passes + CASE WHEN target - passes * source_size > 0 AND middle <= target - passes * source_size
             THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM r
)
"""


def when_demanded(share: str, knots) -> str:
    """The curriculum's inverse integral as SQL."""
    areas = [(b - a) * (f + g) / 2 for (a, f), (b, g) in zip(knots, knots[1:])]
    whole, done, out = sum(areas), 0.0, None
    for ((a, f), (b, g)), area in zip(zip(knots, knots[1:]), areas):
        inside, slope = f"greatest({share} * {whole}::DOUBLE - {done}::DOUBLE, 0)", (g - f) / (b - a)
        if slope:
            time = (f"{a}::DOUBLE + (sqrt(greatest({f * f}::DOUBLE + {inside} * {slope * 2}::DOUBLE, 0))"
                    f" - {f}::DOUBLE) / {slope}::DOUBLE")
        else:
            time = f"{a}::DOUBLE + {inside} / {f}::DOUBLE"
        out = time if out is None else f"CASE WHEN {share} * {whole}::DOUBLE > {done}::DOUBLE THEN {time} ELSE {out} END"
        done += area
    return f"least(greatest({out}, {knots[0][0]}::DOUBLE), {knots[-1][0]}::DOUBLE)"


SHARE = "(CASE WHEN target > 0 THEN (k * source_size + middle) / target ELSE 0 END)"
TIME = " ".join(f"WHEN {i} THEN {when_demanded(SHARE, knots)}" for i, knots in enumerate(mixing.CURRICULUM))
OP6 += f"""
SELECT doc_id, size, source_size, target, copies * size AS taken,
       list_transform(range(copies), lambda k: CASE class {TIME} END) AS positions
FROM c
"""

GRAMS = ", ".join(
    f"('{phrase}', '{label}', {base}, {len(words) - 1}, {i}, '{a}', '{b}')"
    for base, phrases in ((True, licenses.BASE), (False, licenses.TEMPLATES))
    for phrase, label in phrases.items()
    for words in [phrase.split(" ")]
    for i, (a, b) in enumerate(zip(words, words[1:]))
)
DECIDED = " ".join(
    f"WHEN phrase = '{phrase}' THEN "
    + " AND ".join(f"list_has_any(voted, {list(places)})" for places in licenses.deciding_grams(phrase, needed))
    for phrase, needed in licenses.DECIDING.items()
)
OP9 = rf"""
WITH t(phrase, label, base, grams, place, a, b) AS (VALUES {GRAMS}),
w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), p AS (
  SELECT doc_id, unnest(words) AS a, unnest(words[2:]) AS b, unnest(list_concat([''], words[:-2])) AS p1,
         unnest(list_concat(['', ''], words[:-3])) AS p2, unnest(range(len(words))) AS pos FROM w
), v AS (
  SELECT doc_id, phrase, label, base, grams, pos - place AS diagonal, list(DISTINCT place) AS places,
         bool_or(p1 IN {licenses.NEGATIONS} OR (p2 IN {licenses.NEGATIONS} AND p1 IN {licenses.FILLERS})) AS denied
  FROM p JOIN t USING (a, b) GROUP BY ALL
), m AS (
  SELECT *, sum(apart) OVER (PARTITION BY doc_id, phrase, label, base ORDER BY diagonal) AS passage
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (
          PARTITION BY doc_id, phrase, label, base ORDER BY diagonal) > {licenses.SLACK} THEN 1 ELSE 0 END AS apart FROM v)
), q AS (
  SELECT doc_id, phrase, label, base, passage,
         list_distinct(flatten(list(places))) AS voted, bool_or(denied) AS denied,
         len(list_distinct(flatten(list(places)))) / any_value(grams) AS coverage,
         count(*) FILTER (len(places) = grams) AS exact,
         min(diagonal) FILTER (len(places) = grams) AS first_exact,
         max(diagonal) FILTER (len(places) = grams) AS last_exact
  FROM m GROUP BY ALL
), z AS (
  SELECT *, CASE {DECIDED} ELSE TRUE END
         AND NOT (denied AND NOT list_has_any(string_split(phrase, ' '), {list(licenses.NEGATIONS)})) AS verified FROM q
), f AS (
  SELECT doc_id, sum(exact) FILTER (base)::BIGINT AS n_base,
         min(first_exact) FILTER (base) AS first_word, max(last_exact) FILTER (base) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (base AND exact > 0)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label) FILTER (
           CASE WHEN base THEN exact > 0 ELSE verified AND coverage >= {licenses.COVERAGE} END)), ',') AS labels,
         max(coverage) FILTER (base OR verified) AS score
  FROM z GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM w LEFT JOIN f USING (doc_id)
"""

BLANK = r"[\x20\x09-\x0D]+"
NORMAL = f"trim(regexp_replace(lower(raw), '{BLANK}', ' ', 'g'))"
OP12 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS lines,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), g AS (
  SELECT doc_id, unnest(range(len(words) - 2)) AS i, unnest(words[:-3]) AS a, unnest(words[2:-2]) AS b, unnest(words[3:]) AS c
  FROM d WHERE len(words) > 2
), r AS (
  SELECT doc_id, count(DISTINCT place)::BIGINT AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k FROM g) WHERE k > 1)
  GROUP BY doc_id
), l AS (
  SELECT doc_id, source, t, raw, place, {NORMAL} AS line,
         len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, source, t, unnest(lines) AS raw, unnest(range(len(lines))) AS place FROM d)
), bad AS (
  SELECT source, line FROM (SELECT source, line, count(DISTINCT md5(t)) AS k FROM l WHERE line <> '' GROUP BY ALL) AS x
  JOIN (SELECT source AS s, count(DISTINCT md5(t)) AS n FROM d GROUP BY source) ON source IS NOT DISTINCT FROM s
  WHERE k >= {quality_rules.LEAST_DOCS} AND k > n * {quality_rules.SHARE}::DOUBLE
), x AS (
  SELECT doc_id, count(bad.line)::BIGINT AS lines_removed,
         sum(CASE WHEN bad.line IS NULL THEN n ELSE 0 END)::BIGINT AS words_left
  FROM l LEFT JOIN bad ON bad.source IS NOT DISTINCT FROM l.source AND bad.line = l.line GROUP BY doc_id
), w AS (
  SELECT doc_id, (count(*) - count(DISTINCT raw))::BIGINT AS n_dup_lines FROM l WHERE line <> '' GROUP BY doc_id
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '{BLANK}', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         len(words) < {quality_rules.LEAST_WORDS}
           OR 100 * coalesce(r.n, 0) > {quality_rules.MOST_REPEATED} * len(words) AS base_failed,
         lines_removed, words_left
  FROM d LEFT JOIN r USING (doc_id) LEFT JOIN w USING (doc_id) JOIN x USING (doc_id)
)
SELECT *, NOT base_failed AND words_left >= {quality_rules.LEAST_WORDS}
       AND 100 * words_left >= {quality_rules.LEAST_LEFT} * n_words AS kept
FROM m
"""

SQL = {
    "op1_exact_dedup": OP1,
    "op3_line_dedup": OP3,
    "op6_mixing": OP6,
    "op9_license_scan": OP9,
    "op12_quality_rules": OP12,
}
