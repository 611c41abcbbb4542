"""DuckDB SQL for the queries that SQL can express."""

from subledger.llm.rules import BASE, BIT, EVERY_RULE, POLICIES, PRODUCTION, RUN_WORDS

_FAILED = " + ".join(f"(CASE WHEN {condition} THEN {BIT[name]} ELSE 0 END)"
                     for name, (_, condition) in EVERY_RULE.items())


def _any(rules) -> str:
    return " OR ".join(f"({EVERY_RULE[r][1]})" for r in rules)


_RULES = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT row_no, i, array_to_string(w[i:i + 7], ' ') AS words
  FROM (SELECT row_no, w, unnest(range(1, len(w) - 6)) AS i FROM texts WHERE len(w) >= 8)),
repeated AS (
  SELECT row_no, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY row_no, words) > 1),
reach AS (
  SELECT row_no, least(8, coalesce(lead(i) OVER (PARTITION BY row_no ORDER BY i) - i, 8)) AS n FROM repeated),
covered AS (SELECT row_no, sum(n) AS n FROM reach GROUP BY row_no),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, len(list_distinct(w)) AS n_distinct_words,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
         length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_latin,
         len(list_filter(range(2, len(w) + 1), lambda j: w[j] = w[j - 1])) AS n_stutter,
         coalesce(list_sum(list_transform(range(0, len(w), {RUN_WORDS}),
                                          lambda k: len(list_distinct(w[k + 1:k + {RUN_WORDS}])))), 0) AS n_run_distinct_words
  FROM texts LEFT JOIN covered USING (row_no))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({_any(BASE)}) AS base_failed, NOT ({_any(dict.fromkeys(BASE + POLICIES[PRODUCTION]))}) AS kept,
       CAST({_FAILED} AS BIGINT) AS failed_bits, '{PRODUCTION}' AS policy
FROM measured"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = (r"regexp_extract_all(translate(coalesce({0}, ''), '" + _UPPER + "', '" + _LOWER +
          r"'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

_RANKED = f"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS row_no, doc_id, {_TERMS.format("text")} AS terms FROM documents),
totals AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM doc_terms WHERE len(terms) > 0),
counts AS (
  SELECT row_no, any_value(doc_id) AS doc_id, any_value(len(terms)) AS n, term, count(*) AS tf
  FROM doc_terms, unnest(terms) AS u(term) GROUP BY row_no, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, totals GROUP BY term),
impacts AS (
  SELECT row_no, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))) AS impact
  FROM counts JOIN weights USING (term), totals),
items AS (
  SELECT DISTINCT item_no, item_id, term FROM (
    SELECT row_number() OVER () AS item_no, item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark)),
scores AS (
  SELECT item_no, item_id, row_no, doc_id, sum(impact)::BIGINT AS score
  FROM items JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 10"""

ORACLES = {"op11_ranked_search": _RANKED, "op5_quality_rules": _RULES}
