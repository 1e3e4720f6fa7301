"""Quality rules as a ledger: every rule once, failures as bits, policies over the bits.

``ledger`` measures each text and sets one bit for each rule it fails. A policy is a named set of
rules; applying one, or another version of it, or asking what each rule decides alone, only reads
the bits. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import SPACE

WINDOW = 8

#: Rule by bit: its name and when a text fails it.
RULES = [
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("capitals", "100 * n_capitals > 40 * word_chars"),
    ("punctuation", "n_marks > n_words"),
]


@dataclass(frozen=True)
class Policy:
    """A version of what rejects a text."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [name for name, _ in RULES]
        return sum(1 << names.index(rule) for rule in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
STRICT = Policy("1", tuple(name for name, _ in RULES))


def _count(text: Column, others: str) -> Column:
    """Characters of a text outside a class."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def _repeated(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more, from the hashes by start."""

    def covered(ordered: Column) -> Column:
        last = F.size(ordered) - 1

        def same(k: Column, other: Column) -> Column:
            return F.get(ordered, k)["h"] == F.get(ordered, other)["h"]

        repeated = F.filter(
            ordered, lambda _, k: ((k > 0) & same(k, k - 1)) | ((k < last) & same(k, k + 1))
        )
        starts = F.sort_array(F.transform(repeated, lambda x: x["i"]))
        none = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")
        )
        return F.aggregate(starts, none, step, lambda a: a["n"])

    pairs = F.sort_array(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    # An array of one binds the sorted windows, so that they are made once.
    found = F.get(F.transform(F.array(pairs), covered), F.lit(0))
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(some, found).otherwise(0).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements that the rules read; a null text has none of anything.

    Columns of ``docs`` with a measurement's name are replaced. Windows are compared by a 64-bit
    hash of their words.
    """
    names = [
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        "n_capitals", "n_marks", "_words", "_lines", "_hashes", "_windows",
    ]
    docs = docs.drop(*(n for n in names if n != "text"))
    text = F.coalesce("text", F.lit(""))
    words, lines = F.col("_words"), F.col("_lines")
    hashes = F.col("_hashes")
    windows = F.when(
        F.size(hashes) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            # A slice would copy the whole array for each window.
            lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    out = docs.select(
        "*",
        F.array_remove(F.split(text, SPACE), "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        _count(text, r"[^#*$%&|<>]+").alias("n_symbols"),
        _count(text, "[^A-Z]+").alias("n_capitals"),
        _count(text, "[^.!?,;:]+").alias("n_marks"),
    )
    out = out.select("*", F.transform(words, lambda w: F.xxhash64(w)).alias("_hashes"))
    out = out.select("*", windows.alias("_windows"))
    return out.select(
        *docs.columns,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("_windows")).alias("n_repeat_words"),
        "n_capitals",
        "n_marks",
    )


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with measurements and ``failures``: bit k is set where rule k fails."""
    failed = F.lit(0)
    for k, (_, condition) in enumerate(RULES):
        failed = failed.bitwiseOR(F.when(F.expr(condition), 1 << k).otherwise(0))
    return measure(docs).withColumn("failures", failed)


def passes(policy: Policy, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(policy.mask) == 0


def ablation(ledger: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """For each rule of a policy: texts that fail it, and those that it alone rejects.

    (version, rule, n_failed, n_only, n_kept, n_kept_without). Rows are first counted by bit
    pattern, of which there are at most 2 ** len(RULES).
    """
    patterns = ledger.groupBy(F.col("failures").bitwiseAND(policy.mask).alias("bits")).count()
    names = [name for name, _ in RULES]
    rules = F.explode(
        F.array(*[
            F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).alias("bit"))
            for r in policy.rules
        ])
    )
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("count"))), F.lit(0))
    bits, bit = F.col("bits"), F.col("one.bit")
    return (
        patterns.select("*", rules.alias("one")).groupBy(F.col("one.rule").alias("rule"))
        .agg(
            total(bits.bitwiseAND(bit) != 0).alias("n_failed"),
            total(bits == bit).alias("n_only"),
            total(bits == 0).alias("n_kept"),
            total(bits.bitwiseAND(F.bitwise_not(bit)) == 0).alias("n_kept_without"),
        )
        .select(F.lit(policy.version).alias("version"), "*")
    )


def kept(docs: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with their own columns."""
    plain = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text"))
    # A filter does not move past a column that is no function of the row. Else every mention of a
    # measurement in the filter would compute it anew, and what it is made of.
    keep = passes(policy) & (F.monotonically_increasing_id() >= 0)
    return ledger(plain).select("_row", keep.alias("_keep")).where("_keep").select("_row.*")
