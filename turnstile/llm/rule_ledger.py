"""Quality rules as a bitmask ledger.

``rule_ledger`` measures every text once and stores the measurements with one failure bit per
rule.  Versioned policies are masks over those bits: ``apply_policy`` needs no text, and
``ablations`` counts what each rule of a policy decides from the distinct bit patterns alone.
All columns are built-in functions; a document never leaves its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import WORD_SEPARATORS

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: rule -> failure condition over the measurements; the position is the bit
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 14 * n_words",
    "few_distinct_words": "100 * n_distinct_words < 15 * n_words",
    "shouting": "2 * n_upper_words > n_words",
    "stutter": "100 * n_stutter > 30 * n_words",
}

#: version -> rules that reject a document
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "word_length"),
    "v2": tuple(RULES),
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words",
            "n_upper_words", "n_stutter")


def rule_bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def policy_mask(policy: str) -> int:
    return sum(rule_bit(r) for r in POLICIES[policy])


def words_of(text: Column) -> Column:
    """Maximal runs of other characters than blank and tab to carriage return."""
    core = F.btrim(text, F.lit(BLANKS))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, WORD_SEPARATORS))


def rule_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id``, the measurements (long) and ``fail_bits`` (long).

    Null text counts as empty (no words: ``few_words`` fails).  Repeated rows and ids are measured
    row by row; null ids stay.  Other columns are ignored, whatever their names.  Windows are
    compared by their 64-bit hash within one text."""
    t = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    t = t.select("id", "t", words_of(F.col("t")).alias("w"))
    w = F.col("w")
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    t = t.select(
        "id", "w", F.size(w).alias("n_words"),
        F.length(F.translate("t", BLANKS, "")).alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).alias("n_symbols"),
        lines.alias("lines"),
        F.when(F.size(w) >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))).alias("h"))
    t = t.withColumn("s", F.when(F.size("h") > F.size(F.array_distinct("h")), F.sort_array(
        F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    s = F.col("s")
    again = F.transform(F.filter(F.sort_array(F.transform(
        s, lambda e, j: F.struct(
            F.when((F.get(s, j - 1)["x"] == e["x"]) | (F.get(s, j + 1)["x"] == e["x"]), e["i"]).alias("i")))),
        lambda e: e["i"].isNotNull()), lambda e: e["i"])
    covered = F.aggregate(again, F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n")),
                          lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(WINDOW), p - a["at"])).alias("n")),
                          lambda a: a["n"])
    t = t.select(
        "id", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(s.isNull(), 0).otherwise(covered).alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct(w)).alias("n_distinct_words"),
        F.size(F.filter(w, lambda x: (x == F.upper(x)) & (x != F.lower(x)))).alias("n_upper_words"),
        F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))).alias("n_stutter"))
    # one generated row each: a filter on the ledger stays above it and never copies the measuring expressions
    t = t.select("id", F.inline_outer(F.array(F.struct(*[F.col(c).cast("long").alias(c) for c in MEASURES]))))
    bits = sum((F.when(F.expr(test), F.lit(rule_bit(r))).otherwise(F.lit(0)) for r, test in RULES.items()), F.lit(0))
    return t.withColumn("fail_bits", bits.cast("long"))


def apply_policy(ledger: DataFrame, policy: str) -> DataFrame:
    """Adds ``kept``: no rule of the policy failed."""
    return ledger.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0)


def ablations(ledger: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: ``rejected`` by it, ``only`` by it, and ``kept_without`` it; rule null:
    the whole policy.  One aggregate to the distinct patterns of failure bits (2 ** rules at
    most), the rest is bit arithmetic on those counts."""
    mask = policy_mask(policy)
    patterns = ledger.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(
        F.count("*").alias("n"))
    cases = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(rule_bit(r) if r else mask).cast("long").alias("bit"))
                      for r in (None, *POLICIES[policy])])
    e = patterns.select("bits", "n", F.explode(cases).alias("c")).select("bits", "n", "c.rule", "c.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    left = F.col("bits").bitwiseAND(F.lit(mask).cast("long").bitwiseXOR(F.col("bit"))) == 0
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("long")
    return e.groupBy("rule").agg(F.lit(policy).alias("policy"), count(hit).alias("rejected"),
                                 count(hit & left).alias("only"), count(left).alias("kept_without"))
