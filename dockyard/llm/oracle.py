r"""DuckDB SQL of the training-data queries that SQL can express.

The others (edit distances, token vocabularies, places of pattern matches, fitted models) are
held against brute force or held-out labels in tests/llm.
"""

from __future__ import annotations

from dockyard.llm.quality_rules import BASE_RULES, RULES, STOP_WORDS, Rule

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIXING = rf"""
WITH s AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents
), t AS (
  SELECT source, sum(size) AS total FROM s GROUP BY source
), w AS (
  SELECT *, 3 * total AS most,
    [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT] AS weight
  FROM t
), r AS (
  SELECT *, (sum(total) OVER () - coalesce(sum(most) OVER o, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::DOUBLE AS rate
  FROM w
  WINDOW o AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), g AS (
  SELECT source, total, least(most::DOUBLE, max(rate) OVER () * weight::DOUBLE) AS target FROM r
), b AS (
  SELECT *, floor(target)::BIGINT AS budget, CASE WHEN total > 0 THEN floor(target)::BIGINT // total ELSE 0 END AS whole
  FROM g
)
SELECT s.doc_id, s.size, b.total::BIGINT AS source_size, b.target,
  (b.whole * s.size + greatest(0, least(s.size, b.budget - b.whole * b.total
    - coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))))::BIGINT AS taken
FROM s JOIN b ON s.source IS NOT DISTINCT FROM b.source
"""

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINE_DEDUP = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS place FROM d
), k AS (
  SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT k.*, coalesce(k.doc_id <> shared.keeper, false) AS gone FROM k LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""


def _breaks(rule: Rule) -> str:
    sides = [f"{rule.measure} < {rule.low}"] if rule.low is not None else []
    sides += [f"{rule.measure} > {rule.high}"] if rule.high is not None else []
    return f"CASE WHEN {' OR '.join(sides)} THEN '{rule.name}' END"


def _quality_rules() -> str:
    stops = ", ".join(f"'{x}'" for x in STOP_WORDS)
    base, every = (", ".join(map(_breaks, x)) for x in (BASE_RULES, BASE_RULES + RULES))
    share = lambda part, whole: f"CASE WHEN {whole} > 0 THEN {part} / {whole} ELSE 0.0 END"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), g AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), twice AS (
  SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, gram) > 1
), c AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), n AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(l) AS n_lines, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper,
    len(list_filter(w, lambda x: NOT regexp_matches(x, '\p{{L}}'))) AS n_bare,
    len(list_intersect(w, [{stops}])) AS n_stop_words,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*\z'))) AS n_ellipsis,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullets
  FROM d LEFT JOIN c USING (r)
), m AS (
  SELECT *, {share("word_chars", "n_words")} AS mean_word_chars, {share("n_symbols", "n_words")} AS symbol_ratio,
    {share("n_upper", "word_chars")} AS upper_ratio, {share("n_dup_lines", "n_lines")} AS dup_line_ratio,
    {share("n_repeat_words", "n_words")} AS repeat_ratio, {share("(n_words - n_bare)", "n_words")} AS letter_word_ratio,
    {share("n_ellipsis", "n_lines")} AS ellipsis_line_ratio, {share("n_bullets", "n_lines")} AS bullet_line_ratio
  FROM n
), v AS (
  SELECT *, list_filter([{base}], lambda x: x IS NOT NULL) AS b, list_filter([{every}], lambda x: x IS NOT NULL) AS f FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, len(b) > 0 AS base_failed,
  len(f) = 0 AS kept, array_to_string(f, ',') AS failed
FROM v
"""


PHRASES = rf"""
WITH w AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'
  )), '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3)) AS sizes(k)
), f AS (
  SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL
), n AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 10
), x AS (
  SELECT *, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)
), s AS (
  SELECT x.lang, x.phrase, x.k, x.a, fl.a AS l, fr.a AS r,
    (1000000::HUGEINT * x.a * x.a // (fl.a::HUGEINT * fr.a))::BIGINT AS score
  FROM x JOIN f AS fl ON fl.lang = x.lang AND fl.phrase = x.first JOIN f AS fr ON fr.lang = x.lang AND fr.phrase = x.rest
  QUALIFY row_number() OVER (PARTITION BY x.lang, x.phrase ORDER BY score, x.cut) = 1
), inner_ AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE k = 3
), longest AS (
  SELECT lang, phrase, max(a) AS longest FROM inner_ GROUP BY ALL
), z AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank
  FROM s LEFT JOIN longest USING (lang, phrase)
  WHERE coalesce(100 * longest < 50 * s.a, true)
)
SELECT z.lang, rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= 2000
"""


EXACT_DEDUP = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""


#: All pairs of different n-gram sets that share an n-gram, exactly; classes by the pairs' closure.
NGRAM_JOIN = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, {_WORDS} AS w FROM documents WHERE doc_id IS NOT NULL
), s AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(
    range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) AS grams
  FROM t WHERE len(w) > 0
), e AS (
  SELECT DISTINCT doc_id, md5(array_to_string(grams, chr(10))) AS k, grams FROM s
), r AS (
  SELECT k, any_value(len(grams)) AS size, count(*) AS copies, min(doc_id) AS doc FROM e GROUP BY k
), g AS (
  SELECT k, unnest(any_value(grams)) AS gram FROM e GROUP BY k
), shared AS (
  SELECT k, gram FROM g QUALIFY count(*) OVER (PARTITION BY gram) > 1
), p AS (
  SELECT a.k AS x, b.k AS y, count(*) AS common FROM shared AS a JOIN shared AS b ON a.gram = b.gram AND a.k < b.k GROUP BY ALL
), near AS (
  SELECT x, y FROM p JOIN r AS a ON a.k = x JOIN r AS b ON b.k = y WHERE common >= 0.8 * (a.size + b.size - common) - 1e-9
), link AS (
  SELECT x, y FROM near UNION ALL SELECT y, x FROM near
), n AS (
  SELECT x AS k, sum(copies) AS links FROM link JOIN r ON r.k = y GROUP BY x
), joined AS (
  SELECT x, y FROM link UNION SELECT a.k, b.k FROM e AS a JOIN e AS b USING (doc_id) WHERE a.k <> b.k
), reach AS (
  SELECT k, k AS other FROM r UNION SELECT reach.k, y FROM reach JOIN joined ON x = other
), class AS (
  SELECT reach.k, min(doc) AS class_doc FROM reach JOIN r ON r.k = other GROUP BY reach.k
), f AS (
  SELECT doc_id, min(class_doc) AS class_id, sum(coalesce(links, 0) + copies - 1)::BIGINT AS n_links,
    (sum(copies - 1) + 1)::BIGINT AS n_copies
  FROM e JOIN r USING (k) JOIN class USING (k) LEFT JOIN n USING (k) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(n_links, 0)::BIGINT AS n_links,
  coalesce(n_copies, 1)::BIGINT AS n_copies
FROM documents AS d LEFT JOIN f USING (doc_id)
"""


ORACLE_SQL = {
    "op4_mixing": MIXING,
    "op5_ngram_join": NGRAM_JOIN,
    "op8_line_dedup": LINE_DEDUP,
    "op10_quality_rules": _quality_rules(),
    "op11_phrase_mining": PHRASES,
    "op13_exact_dedup": EXACT_DEDUP,
}
