"""Quality rules kept as a bitmask ledger (DataFrame functions only).

Each rule is evaluated once per document and leaves one bit in ``failed`` beside
the measurements.  A *policy* is a named, versioned mask over those bits: a
document passes when none of its bits are set.  Changing a policy, or asking what
each rule alone rejects, only reads the ledger again: ``ablations`` aggregates the
masks, with bitwise functions, and never touches a text.

All measurements are taken within one row, so the ledger needs no shuffle and a
hot source or a very long text changes nothing.

Edge cases: null and empty texts have 0 for all measurements (and fail the length
rule); repeated rows are judged alike; ``doc_id`` is only carried along (null
too); an empty table gives no rows; columns of the caller that are named like an
added column are replaced by it.  Three-word windows are compared by a 64-bit
hash within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiscore.llm.common import ROW, WORD_SPACE, field, once, packed, unpacked, words

#: Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"


def _repeat_words(word_list: Column) -> Column:
    """Words in 3-word windows that the text holds twice or more; ``word_list`` is a stored column."""
    n = F.size(word_list)
    hashes = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
        word_list[i], word_list[i + 1], word_list[i + 2]))).otherwise(F.array().cast("array<bigint>"))

    def covered(starts: Column) -> Column:
        # union of [s, s + 3) over ascending starts: each adds up to the next start, 3 at most
        return F.aggregate(F.transform(starts, lambda s, i: F.coalesce(
            F.least(F.lit(3), F.get(starts, i + 1) - s), F.lit(3))), F.lit(0), lambda a, x: a + x)

    def from_sorted(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return once(F.array_sort(F.transform(twice, lambda x: x["p"])), covered)

    def count(h: Column) -> Column:
        # most texts hold no window twice, which needs no sort to see
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            once(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), from_sorted))

    return once(hashes, count).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """The caller's row with the measurements of its text, each taken once."""
    rows = packed(docs).select(ROW, F.coalesce(field("text"), F.lit("")).alias("_text")).select(
        ROW, "_text", words(F.col("_text")).alias("_words"))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "")
    blank = F.translate("_text", WORD_SPACE, "")
    return rows.select(
        ROW,
        F.size("_words").cast("long").alias("n_words"),
        F.length(blank).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        once(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words")).alias("n_repeat_words"),
        F.length(F.regexp_replace("_text", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace("_text", r"[^\p{L}]+", "")).cast("long").alias("n_letters"))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters")

#: name -> SQL condition of failure on the measurements.  The order gives the bits:
#: append only, so that stored ledgers keep their meaning.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "100 * n_symbols > 10 * word_chars",
    "duplicate_lines": "n_dup_lines > 0 AND 100 * n_dup_lines > 30 * (n_words DIV 5)",
    "upper_case": "2 * n_upper > n_letters",
    "word_length": "word_chars > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)",
    "no_letters": "n_words > 0 AND 2 * n_letters < word_chars",
}


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
POLICIES = (
    BASE,
    Policy("standard", 1, (*BASE.rules, "many_symbols", "upper_case")),
    Policy("standard", 2, tuple(RULES)),
)
#: What ``kept`` of the query follows.
CURRENT = POLICIES[-1]


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements and ``failed``, one bit per rule (long)."""
    bits = [F.when(F.expr(cond), F.lit(1 << k)).otherwise(F.lit(0)) for k, cond in enumerate(RULES.values())]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    measured = measure(docs)
    added = {m: F.col(m) for m in MEASURES}
    return unpacked(measured.withColumn("_failed", failed.cast("long")), {**added, "failed": F.col("_failed")})


def passes(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask)) == 0


def apply_policy(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Adds ``kept`` and ``policy`` (name and version) to ledger rows."""
    return entries.withColumn("kept", passes(policy)).withColumn("policy", F.lit(f"{policy.name}:{policy.version}"))


def ablations(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Per rule of a policy: documents it fails, that it alone rejects, and that its removal brings back.

    One aggregate over at most 2^rules distinct masks, then bit tests on those;
    ``failed_with`` and ``always_with`` are the OR and the AND of the masks it occurs in.
    """
    own = F.col("failed").bitwiseAND(F.lit(policy.mask))
    masks = entries.groupBy(own.alias("_mask")).agg(F.count(F.lit(1)).alias("_n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << list(RULES).index(r)).cast("long").alias("bit"))
                                for r in policy.rules]))
    tested = masks.select("_mask", "_n", rules.alias("r")).select("_mask", "_n", "r.rule", "r.bit")
    hit = F.col("_mask").bitwiseAND(F.col("bit")) != 0
    alone = F.col("_mask") == F.col("bit")
    return tested.groupBy("rule", "bit").agg(
        F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(alone, F.col("_n"))), F.lit(0)).alias("n_only"),
        F.sum("_n").alias("n_docs"),
        F.coalesce(F.bit_or(F.when(hit, F.col("_mask"))), F.lit(0)).alias("failed_with"),
        F.coalesce(F.bit_and(F.when(hit, F.col("_mask"))), F.lit(0)).alias("always_with"))
