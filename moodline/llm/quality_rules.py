"""Quality rules as a ledger of failure bits (operator 3), in native expressions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one
bit per failed rule, so that any policy, a set of rules with a version, is applied
later with a bitwise AND, and ablations are counts over the distinct masks.

Defined results: a NULL text counts as an empty one (all measurements 0, rule
``few_words`` fails); documents of any length are measured whole; repeated rows give
repeated results; further columns of the input stay out of the ledger, whatever their
names. Windows of five words are compared by 64-bit hashes within one document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.functions.text import once
from moodline.llm.tables import bound, words_of

WINDOW = 5
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")


def _rules() -> dict[str, Column]:
    """Conditions under which a document fails; their order is the order of the bits."""
    c = F.col
    return {
        "few_words": c("n_words") < 10,
        "repeated_windows": 100 * c("n_repeat_words") > 20 * c("n_words"),
        "symbols": 100 * c("n_symbols") > 30 * c("n_words"),
        "word_length": (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 20 * c("n_words")),
        "repeated_lines": (c("n_lines") >= 4) & (2 * c("n_dup_lines") > c("n_lines")),
        "capitals": 10 * c("n_capitals") > 6 * c("word_chars"),
    }


RULE_BITS = {name: 1 << i for i, name in enumerate(("few_words", "repeated_windows", "symbols", "word_length", "repeated_lines", "capitals"))}
BASE = ("few_words", "repeated_windows")
POLICIES = {"v1": BASE, "v2": tuple(RULE_BITS)}
CURRENT = "v2"


def mask_of(rules: tuple[str, ...]) -> int:
    return reduce(lambda mask, rule: mask | RULE_BITS[rule], rules, 0)


def _repeated_words(words: Column) -> Column:
    """Words that lie in a window of five which the document holds twice or more.

    Equal windows become neighbours when (hash, place) pairs are sorted; the places
    of the repeated ones, sorted again, tell the words they cover together.
    """

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def repeated(keyed: Column) -> Column:
        twins = F.filter(keyed, lambda x, i: F.coalesce((F.get(keyed, i - 1)["h"] == x["h"]) | F.lit(False), F.lit(False)) | F.coalesce(F.get(keyed, i + 1)["h"] == x["h"], F.lit(False)))
        return bound(F.sort_array(F.transform(twins, lambda x: x["i"])), covered)

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))

    def count(found: Column) -> Column:
        keyed = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(bound(keyed, repeated))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(bound(hashed, lambda h: bound(windows(h), count)))


def _measures(text: Column) -> Column:
    def by_words(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        return bound(
            lines,
            lambda kept: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                F.size(kept).cast("long").alias("n_lines"),
                (F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
                _repeated_words(words).alias("n_repeat_words"),
                F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
            ),
        )

    return bound(words_of(text), by_words)


def ledger(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep``, the measurements and ``failed``, one bit per rule in the order of RULE_BITS."""
    measured = docs.select(*[F.col(k) for k in keep], once(F.coalesce(F.col("text"), F.lit("")), _measures).alias("_m"))
    rows = measured.select(*keep, *[F.col("_m")[m].alias(m) for m in MEASURES])
    bits = [F.when(rule, F.lit(RULE_BITS[name])).otherwise(F.lit(0)) for name, rule in _rules().items()]
    return rows.withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long"))


def violates(version: str = CURRENT) -> Column:
    """True for ledger rows that the policy rejects."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[version])).cast("long")) != 0


def apply_policy(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    base = F.col("failed").bitwiseAND(F.lit(mask_of(BASE)).cast("long")) != 0
    return rows.withColumn("base_failed", base).withColumn("kept", ~base & ~violates(version))


def ablation(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents failing it, and those that only it rejects.

    Works on the counts of distinct masks, so at most 2^rules rows are looked at twice.
    """
    policy = F.lit(mask_of(POLICIES[version])).cast("long")
    masks = rows.groupBy(F.col("failed").bitwiseAND(policy).alias("mask")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(RULE_BITS[r]).cast("long").alias("bit")) for r in POLICIES[version]])
    per = masks.select("mask", "n", F.explode(rules).alias("r"))
    hit = per["mask"].bitwiseAND(F.col("r.bit")) != 0
    return per.groupBy(F.col("r.rule").alias("rule")).agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("mask") == F.col("r.bit"), F.col("n"))), F.lit(0)).alias("n_only"),
    )


def accepted(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """The documents that a policy keeps, with all their columns."""
    names = docs.columns
    whole = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), F.col("text"))
    return apply_policy(ledger(whole, "_row"), version).where("kept").select("_row.*")
