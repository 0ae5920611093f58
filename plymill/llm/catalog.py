"""The corpus operators as registered queries, and SQL twins where SQL can express them."""

from __future__ import annotations

from plymill.llm.contamination import op6_benchmark_decontamination
from plymill.llm.jaccard import op2_ngram_jaccard_join
from plymill.llm.language import op5_language_id
from plymill.llm.lines import op4_line_dedup
from plymill.llm.mixing import op7_source_mixing
from plymill.llm.quality import op1_quality_rules
from plymill.llm.scoring import op10_lm_scoring
from plymill.llm.simhash import op12_simhash_near_dedup
from plymill.llm.substrings import op9_substring_dedup
from plymill.llm.suffixes import op3_suffix_array_dedup
from plymill.llm.urls import op8_url_filters
from plymill.llm.variants import op13_spelling_variants
from plymill.llm.whitening import op11_embedding_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_ngram_jaccard_join,
        op3_suffix_array_dedup,
        op4_line_dedup,
        op5_language_id,
        op6_benchmark_decontamination,
        op7_source_mixing,
        op8_url_filters,
        op9_substring_dedup,
        op10_lm_scoring,
        op11_embedding_whitening,
        op12_simhash_near_dedup,
        op13_spelling_variants,
    )
}

WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PLAIN = "coalesce(text, '')"


def _words(table: str, key: str, text: str) -> str:
    return f"SELECT {key}, regexp_extract_all({text}, '{WORD}') AS words FROM {table}"


def _grams(source: str, key: str) -> str:
    """Distinct five-word shingles; shorter texts are one, as in the contract."""
    gram = "array_to_string(list_slice(words, i, i + 4), ' ')"
    return (
        f"SELECT {key}, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')] "
        f"ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: {gram})) END AS grams, len(words) AS n_words FROM {source}"
    )


OP1 = f"""
WITH w AS (
  SELECT doc_id, lang, source, {PLAIN} AS t, regexp_extract_all({PLAIN}, '{WORD}') AS words FROM documents
), win AS (
  SELECT doc_id, i, list_slice(words, i, i + 2) AS g FROM w, unnest(range(1, len(words) - 1)) AS u(i)
), rep AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id
), base AS (
  SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words,
    length(regexp_replace(t, '{WHITE}', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
    len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')))::BIGINT AS n_lines,
    len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}'))))::BIGINT AS n_own,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov USING (doc_id)
), b AS (
  SELECT *, n_lines - n_own AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
), m AS (
  SELECT doc_id, lang, source, base_failed, unnest([
    {{'rule': 'symbols', 'top': n_symbols * 10000, 'below': word_chars, 'room': 600, 'both': false}},
    {{'rule': 'dup_lines', 'top': n_dup_lines * 10000, 'below': n_lines, 'room': 3000, 'both': false}},
    {{'rule': 'repeats', 'top': n_repeat_words * 10000, 'below': n_words, 'room': 2500, 'both': false}},
    {{'rule': 'upper', 'top': n_upper * 10000, 'below': word_chars, 'room': 2500, 'both': false}},
    {{'rule': 'length', 'top': word_chars * 100, 'below': n_words, 'room': 300, 'both': true}}]) AS r
  FROM b
), v AS (
  SELECT doc_id, lang, source, base_failed, r.rule AS rule, r.room AS room, r.both AS both_sides,
    CASE WHEN r.below > 0 THEN r.top // r.below ELSE 0 END AS x FROM m
), s AS (
  SELECT lang, source, rule, room, both_sides,
    CASE WHEN x < 64 THEN x ELSE (x >> (length(bin(x)) - 6)::INTEGER) << (length(bin(x)) - 6)::INTEGER END AS x
  FROM v WHERE NOT base_failed
), lv AS (
  SELECT 0 AS lev, lang, source, rule, room, both_sides, x FROM s
  UNION ALL SELECT 1, lang, NULL, rule, room, both_sides, x FROM s
  UNION ALL SELECT 2, NULL, NULL, rule, room, both_sides, x FROM s
), k AS (
  SELECT lev, lang, source, rule, room, both_sides, x, count(*) AS times FROM lv GROUP BY 1, 2, 3, 4, 5, 6, 7
), c AS (
  SELECT *, sum(times) OVER (PARTITION BY lev, lang, source, rule ORDER BY x) AS upto,
    sum(times) OVER (PARTITION BY lev, lang, source, rule) AS n FROM k
), q AS (
  SELECT lev, lang, source, rule, room, both_sides, max(n) AS n,
    min(x) FILTER (upto * 4 >= n) AS q1, min(x) FILTER (upto * 4 >= n * 3) AS q3
  FROM c GROUP BY 1, 2, 3, 4, 5, 6
), f AS (
  SELECT lev, lang, source, rule, n, CASE WHEN both_sides THEN q1 - greatest(room, 3 * (q3 - q1)) END AS lo,
    q3 + greatest(room, 3 * (q3 - q1)) AS hi FROM q
), l AS (
  SELECT l.lang, l.rule, (l.lo::DOUBLE * l.n + e.lo::DOUBLE * 50) / (l.n + 50) AS lo, (l.hi::DOUBLE * l.n + e.hi::DOUBLE * 50) / (l.n + 50) AS hi
  FROM f l JOIN f e ON e.lev = 2 AND e.rule = l.rule WHERE l.lev = 1
), pick AS (
  SELECT a.lang, a.source, a.rule, (a.lo::DOUBLE * a.n + l.lo * 50) / (a.n + 50) AS lo, (a.hi::DOUBLE * a.n + l.hi * 50) / (a.n + 50) AS hi
  FROM f a JOIN l ON l.rule = a.rule AND l.lang IS NOT DISTINCT FROM a.lang WHERE a.lev = 0
), bad AS (
  SELECT DISTINCT v.doc_id FROM v JOIN pick p ON p.rule = v.rule AND p.lang IS NOT DISTINCT FROM v.lang
    AND p.source IS NOT DISTINCT FROM v.source WHERE v.x > p.hi OR v.x < p.lo
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept
FROM b
"""

OP2 = f"""
WITH RECURSIVE w AS ({_words("documents", "doc_id", LOWER)}),
s AS ({_grams("w", "doc_id")}),
g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared, any_value(a.n) AS an, any_value(b.n) AS bn
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (SELECT a, b FROM p WHERE 100 * shared >= 75 * (an + bn - shared)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT s.doc_id, len(s.grams)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM s JOIN reach r USING (doc_id) GROUP BY 1, 2
"""

OP3 = f"""
WITH w AS ({_words("documents", "doc_id", PLAIN)}),
win AS (
  SELECT doc_id, i - 1 AS pos, md5(array_to_string(list_slice(words, i, i + 49), ' ')) AS g FROM w, unnest(range(1, len(words) - 48)) AS u(i)
), held AS (SELECT g, min(doc_id) AS least FROM win GROUP BY g HAVING count(DISTINCT doc_id) > 1),
hit AS (
  SELECT doc_id, pos, least, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM win JOIN held USING (g)
)
SELECT doc_id, min(pos)::BIGINT AS start_word, (max(pos) + 50)::BIGINT AS end_word, (max(pos) + 50 - min(pos))::BIGINT AS n_words,
  bool_and(least = doc_id) AS is_first
FROM hit GROUP BY doc_id, run
"""

OP4 = f"""
WITH l AS (
  SELECT doc_id, i, lines[i] AS line, regexp_replace(regexp_replace({LOWER.replace("coalesce(text, '')", "lines[i]")}, '^{WHITE}+', ''), '{WHITE}+$', '') AS key
  FROM (SELECT doc_id, string_split({PLAIN}, chr(10)) AS lines FROM documents), unnest(range(1, len(lines) + 1)) AS u(i)
), common AS (SELECT key FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
  sha256(coalesce(string_agg(l.line, chr(10) ORDER BY i) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN common c ON l.key = c.key GROUP BY doc_id
"""

OP6 = f"""
WITH d AS ({_words("documents", "doc_id", LOWER)}), b AS ({_words("benchmark", "item_id", LOWER)}),
bs AS ({_grams("b", "item_id")}),
bg AS (SELECT item_id, len(grams) AS n, least(n_words, 5) AS k, unnest(grams) AS gram FROM bs),
dg AS (
  SELECT DISTINCT doc_id, k, array_to_string(list_slice(words, i, i + k - 1), ' ') AS gram
  FROM (SELECT doc_id, words, k FROM d, (SELECT DISTINCT k FROM bg)), unnest(range(1, len(words) - k + 2)) AS u(i)
)
SELECT doc_id, item_id, count(*)::INTEGER AS n_shared, any_value(n)::INTEGER AS n_item
FROM dg JOIN bg USING (gram, k) GROUP BY doc_id, item_id HAVING 100 * count(*) >= 75 * any_value(n)
"""

OP9 = f"""
WITH w AS ({_words("documents", "doc_id", PLAIN)}),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(words, i, i + 12), ' ')) AS g FROM w, unnest(range(1, len(words) - 11)) AS u(i)),
held AS (SELECT g, min(doc_id) AS least FROM win GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM win JOIN held USING (g), unnest(range(0, 13)) AS v(k) WHERE least < doc_id
), each AS (SELECT doc_id, i, words[i] AS word FROM w, unnest(range(1, len(words) + 1)) AS u(i)),
kept AS (
  SELECT e.doc_id, count(g.i) AS n_removed, string_agg(e.word, ' ' ORDER BY e.i) FILTER (g.i IS NULL) AS kept
  FROM each e LEFT JOIN gone g USING (doc_id, i) GROUP BY e.doc_id
)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

ORACLE = {
    "op1_quality_rules": OP1,
    "op2_ngram_jaccard_join": OP2,
    "op3_suffix_array_dedup": OP3,
    "op4_line_dedup": OP4,
    "op6_benchmark_decontamination": OP6,
    "op9_substring_dedup": OP9,
}
