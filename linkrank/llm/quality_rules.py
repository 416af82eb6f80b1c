"""Quality rules as a ledger: every rule is evaluated once, policies are masks over its bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.text_stats import COUNTS, counted

# A rule's place is its bit in the ledger: append, never reorder. Shares are in percent of
# counts, so every rule is exact integer arithmetic.
RULES = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 12 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "few_alphabetic_words": "100 * n_alpha_words < 70 * n_words",
    "shouting": "100 * n_upper > 50 * n_letters",
    "stutter": "100 * n_stutters > 20 * n_words",
    "many_words": "n_words > 10000000",
}

BASE = ("few_words", "repeated_words")

# Versions of what is rejected; a version never changes once used.
POLICIES = {
    "base": BASE,
    "1": (*BASE, "symbols", "word_length", "duplicate_lines", "few_alphabetic_words"),
    "2": (*BASE, "symbols", "word_length", "duplicate_lines", "few_alphabetic_words", "shouting",
          "stutter"),
}
LATEST = "2"


def mask_of(rules: tuple[str, ...]) -> int:
    places = list(RULES)
    return sum(1 << places.index(name) for name in rules)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of ``docs``, the measured counts and ``failed``, a bit per failed rule.

    A null text counts as an empty one, which fails ``few_words``; repeated rows get a line each.
    """
    bits = [
        F.when(F.expr(rule), F.lit(1 << place)).otherwise(F.lit(0))
        for place, rule in enumerate(RULES.values())
    ]
    return counted(docs, text).withColumn("failed", sum(bits[1:], bits[0]).cast("long"))


def passes(policy: str = LATEST) -> Column:
    """Whether a line of the ledger fails no rule of the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def apply_policy(lines: DataFrame, policy: str = LATEST) -> DataFrame:
    """The ledger with ``kept`` under a policy; nothing is measured again."""
    return lines.withColumn("kept", passes(policy))


def ablation(lines: DataFrame, policy: str = LATEST) -> DataFrame:
    """``rule, n_failed, n_only, n_kept_without``: what each rule of a policy does to the corpus.

    ``n_only`` documents fail this rule and no other of the policy; without it ``n_kept_without``
    would be kept. The ledger shrinks to a row per combination of bits before anything else.
    """
    mask = mask_of(POLICIES[policy])
    combos = lines.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    places = list(RULES)
    parts = []
    for name in POLICIES[policy]:
        bit = 1 << places.index(name)
        parts.append(
            F.struct(
                F.lit(name).alias("rule"),
                F.when(F.col("bits").bitwiseAND(F.lit(bit)) != 0, F.col("n")).alias("failed"),
                F.when(F.col("bits") == bit, F.col("n")).alias("only"),
                F.when(F.col("bits").bitwiseAND(F.lit(mask & ~bit)) == 0, F.col("n")).alias("kept"),
            )
        )
    zero = F.lit(0)
    return (
        combos.select(F.explode(F.array(*parts)).alias("x"))
        .groupBy("x.rule")
        .agg(
            F.coalesce(F.sum("x.failed"), zero).alias("n_failed"),
            F.coalesce(F.sum("x.only"), zero).alias("n_only"),
            F.coalesce(F.sum("x.kept"), zero).alias("n_kept_without"),
        )
    )


MEASURES = COUNTS
