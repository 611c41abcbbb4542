"""Quality rules as a bitmask ledger [native: DataFrame functions only].

``rule_ledger`` evaluates every rule exactly once per document, later ones included, and gives the measurements and one bit
per failed rule; ``stored_ledger`` keeps them as a table.  A *policy* is a named, versioned set of rules: ``apply_policy`` and
``ablations`` need only the stored bits, so a changed policy never reads the texts again.

Defined results: a null or empty text has no words, measures 0 everywhere and fails ``short_text``; a null
doc_id stays a row of its own; repeated rows are judged one by one; an empty table gives an empty ledger.
Texts of any length are measured whole.  Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import SPACE_CLASS, id_and_text, stored

WINDOW_WORDS = 8
RUN_WORDS = 1000

#: Rules in bit order: name -> (description, SQL condition that is true when the rule FAILS).  Ratios are compared as
#: products of integers, so that every engine decides alike.
RULES: dict[str, tuple[str, str]] = {
    "short_text": ("fewer than 20 words", "n_words < 20"),
    "repeated_words": ("over 30 % of the words lie in repeated 8-word windows", "100 * n_repeat_words > 30 * n_words"),
    "symbols": ("over one symbol in ten words", "10 * n_symbols > n_words"),
    "duplicate_lines": ("over half of the lines with words repeat an earlier one", "2 * n_dup_lines > n_lines"),
    "short_words": ("mean word length under 2.5 code points", "2 * word_chars < 5 * n_words"),
    "long_words": ("mean word length over 15 code points", "word_chars > 15 * n_words"),
    "run_on_words": ("under 20 % of the words are distinct in a text of 50 words or more",
                     "n_words >= 50 AND 100 * n_distinct_words < 20 * n_words"),
    "capitals": ("over 60 % of the letters A-Z, a-z are capitals in a text of 50 such letters or more",
                 "n_latin >= 50 AND 100 * n_capitals > 60 * n_latin"),
    "stutter": ("over 30 % of the words equal the word before", "100 * n_stutter > 30 * n_words"),
}
#: Rules that came later; bits of earlier ones stay as they are.  The share of distinct words falls with
#: the length of any prose, so that it is taken per run of ``RUN_WORDS`` words, over all runs of the text.
LATER_RULES: dict[str, tuple[str, str]] = {
    "run_on_stretches": ("under 20 % of the words are distinct in their run of 1000 words, in a text of 50 words or more",
                         "n_words >= 50 AND 100 * n_run_distinct_words < 20 * n_words"),
}
EVERY_RULE = {**RULES, **LATER_RULES}
BIT = {name: 1 << i for i, name in enumerate(EVERY_RULE)}
BASE = ("short_text", "repeated_words")

#: Policies by version.  ``base`` is fixed by contract; ``production/2`` is what ``quality_digest`` reports and the pipeline applies;
#: ``production/1`` rejects long texts by length alone (``run_on_words``) and is kept for comparison.
POLICIES: dict[str, tuple[str, ...]] = {
    "base/1": BASE,
    "production/1": tuple(RULES),
    "production/2": tuple("run_on_stretches" if r == "run_on_words" else r for r in RULES),
    "lenient/1": BASE + ("symbols", "duplicate_lines"),
}
PRODUCTION = "production/2"


def policy_mask(policy: str) -> int:
    return reduce(lambda m, r: m | BIT[r], POLICIES[policy], 0)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE_CLASS}+"), lambda w: w != "")


def _paired(level: str, distance: int) -> Column:
    return F.transform(level, lambda h, i: F.xxhash64(h, F.get(F.col(level), i + distance)))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with all measurements of the rules."""
    return _measure(id_and_text(docs, id_col, text_col), ("doc_id",))


def _run_distinct() -> Column:
    """The distinct words of each run of ``RUN_WORDS`` words, summed over the runs."""
    runs = F.sequence(F.lit(0), F.floor((F.col("n_words") - 1) / RUN_WORDS).cast("int"))
    each = F.transform(runs, lambda i: F.size(F.array_distinct(F.slice("h1", i * RUN_WORDS + 1, RUN_WORDS))).cast("long"))
    return F.when(F.col("n_words") <= RUN_WORDS, F.col("n_distinct_words").cast("long")).otherwise(
        F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x))


def _measure(base: DataFrame, carried: tuple[str, ...]) -> DataFrame:
    """The ``carried`` columns and the measurements of ``text``.

    The repeated-window measure works on arrays inside the row: no shuffle, whatever the size of the corpus.
    """
    k = WINDOW_WORDS
    split = base.select(*carried, "text", _words(F.col("text")).alias("words"),
                        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    counted = split.select(
        *carried,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.length(F.regexp_replace("text", "[^A-Za-z]+", "")).cast("long").alias("n_latin"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h1"))
    # h2, h4, h8: hashes of 2, 4, 8 words from each position on, each from two of the level below
    for span in (1, 2, 4):
        counted = counted.withColumn(f"h{2 * span}", _paired(f"h{span}", span))
    counted = counted.withColumn("n_stutter", F.size(F.filter(
        F.transform("h1", lambda h, i: F.get(F.col("h1"), i - 1) == h), lambda same: same)).cast("long"))
    counted = counted.withColumn("windows", F.slice(
        "h8", F.lit(1), F.greatest(F.col("n_words") - (k - 1), F.lit(0)).cast("int")))
    flagged = counted.withColumn(
        "sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"),
                         F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    # positions of windows that have an equal neighbour, in text order
    starts = flagged.withColumn(
        "starts", F.when(F.col("sorted").isNotNull(), F.sort_array(F.filter(F.transform(
            "sorted", lambda p, j: F.when(
                (F.get(F.col("sorted"), j - 1)["h"] == p["h"]) | (F.get(F.col("sorted"), j + 1)["h"] == p["h"]),
                p["i"])), lambda i: i.isNotNull()))))
    # each start covers its k words, less what the next start covers again
    covered = F.aggregate(
        F.transform("starts", lambda s, j: F.least(
            F.lit(k), F.coalesce(F.get(F.col("starts"), j + 1) - s, F.lit(k)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    measures = starts.select(
        *carried, F.struct(
            "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
            F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
            "n_distinct_words", "n_capitals", "n_latin", "n_stutter",
            _run_distinct().alias("n_run_distinct_words")).alias("m"))
    # a generator of one row: a later filter on a measure stays above it, instead of being pushed down with the whole
    # expression copied into every place that uses it
    return measures.select(*carried, F.inline(F.array("m")))


def _with_bits(measured: DataFrame) -> DataFrame:
    bits = reduce(lambda a, b: a.bitwiseOR(b), (
        F.when(F.expr(sql), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long") for name, (_, sql) in EVERY_RULE.items()))
    return measured.withColumn("failed_bits", bits)


def rule_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements plus ``failed_bits``: bit i is set when rule i of :data:`EVERY_RULE` fails."""
    return _with_bits(measure(docs, id_col, text_col))


def stored_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger as a table of the shared folder: texts are read once, policies and ablations read the bits."""
    return stored(docs.sparkSession, rule_ledger(docs, id_col, text_col), "rule-ledger")


def filter_documents(docs: DataFrame, policy: str = PRODUCTION, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that pass a policy; the row travels beside its measurements, so nothing is joined."""
    base = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    judged = apply_policy(_with_bits(_measure(base, ("row",))), policy)
    return judged.where("kept").select("row.*")


def apply_policy(ledger: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Verdict columns of one policy version over stored bits: ``base_failed``, ``kept``, ``policy``."""
    base, mask = policy_mask("base/1"), policy_mask(policy) | policy_mask("base/1")
    return (ledger
            .withColumn("base_failed", F.col("failed_bits").bitwiseAND(F.lit(base)) != 0)
            .withColumn("kept", F.col("failed_bits").bitwiseAND(F.lit(mask)) == 0)
            .withColumn("policy", F.lit(policy)))


def ablations(ledger: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone (kept if the rule went), and that pass all.

    Counts per distinct bit pattern come first (at most 2^rules rows, combined map-side), then bitwise tests on those.
    """
    mask = policy_mask(policy)
    patterns = ledger.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    rows = [F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in POLICIES[policy]]
    each = patterns.select("bits", "n", F.explode(F.array(*rows)).alias("r")).select("bits", "n", "r.*")
    return (each.groupBy("rule", "bit").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("n_kept"))
        .withColumn("policy", F.lit(policy)))


def quality_digest(docs: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """The contract columns of the query, from the stored ledger."""
    return apply_policy(stored_ledger(docs), policy).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed_bits", "policy")
