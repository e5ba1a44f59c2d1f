"""Spelling variant grouping by permuterm rotations.

Two words are near if exactly one inserted, deleted or replaced character parts them.  A
word ``w`` ends in a terminator ``$``, and all rotations of ``w$`` are made.  If ``x`` is the
edited character of ``a x b``, then

* the rotation ``b $ a x`` begins with ``b$a``: words that share this prefix and skip one
  character after it are replacements of each other;
* ``b $ a`` is a whole rotation of ``a b``: the word without the character.

So rows keyed by the rotation that skips its last character (*cut*), and by the whole
rotation (*whole*), meet in one key exactly if the words are near, and the terminator tells
where the edit lies.  Keys are sorted and their groups scanned by window functions.  A group
holds one whole word at most and one cut word a character of the alphabet, so it is small
whatever the corpus (and a window spills where an alphabet is very large).  Two words meet
in one group only: a character that could be dropped from a run of equal ones is dropped
from the run's first place.

Scanning adds up each word's near words and its best one (largest count, then smallest
in code-point order) without listing pairs; :func:`near_pairs` lists them.  A word's form is its
best near word if that is ``factor`` times as frequent.  Counts grow by that factor along
forms, so they have no cycles and few steps; roots follow by pointer jumping.

Words longer than ``LONG`` characters are keyed by four 31-bit polynomial hashes of each rotation
(with the lengths of both parts) instead of the text, in numpy, so a word of millions of
letters costs rows in proportion to its length and not to its square.

Edge cases: null and empty texts have no words; a null ``doc_id`` reads as empty text;
repeated rows count again; ties go to the smallest word in code-point order; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiscore.llm.common import batches_of, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_LETTERS = "[^A-Za-zÀ-ÿ]+"
END = "$"
#: Words of more characters are keyed by hashes of their rotations.
LONG = 128
#: Primes below 2^31 and the bases of the rotation hashes.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1664525, 22695477, 134775813)


def word_counts(docs: DataFrame, least_length: int = 7, least_count: int = 2, every: int = 31) -> DataFrame:
    """``word, n`` of all texts.  A run whose crc32 with its document is divisible by ``every`` loses
    the character that the crc32 points at."""
    owner = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    runs = docs.select(owner.alias("owner"), F.explode(F.split(F.coalesce(F.col("text"), F.lit("")), NO_LETTERS)).alias("run"))
    runs = runs.where(F.length("run") >= least_length).select("owner", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("owner", "run").cast("binary")).alias("h"))
    cut = F.expr("concat(substring(run, 1, cast(h % length(run) AS int)), substring(run, cast(h % length(run) AS int) + 2))")
    words = hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.col("n") >= least_count) & (F.length("word") >= least_length))


def numbered(words: DataFrame) -> DataFrame:
    """``word, n, at``: ``at`` grows with the word in code-point order (numbers have gaps)."""
    return written(words.select("word", "n").repartitionByRange("word").sortWithinPartitions("word")
                   .withColumn("at", F.monotonically_increasing_id()))


def short_rotations(words: DataFrame) -> DataFrame:
    """``key, at, n, cut, first`` of words of up to ``LONG`` characters (whole ones: one less)."""
    long = words.where(F.length("word") <= LONG).select("word", "at", "n", F.length("word").alias("size"))
    placed = long.select("*", F.explode(F.sequence(F.lit(0), F.col("size"))).alias("i"))
    head = "concat('{end}', substring(word, 1, i))".format(end=END)
    whole = F.struct(F.expr(f"concat(substring(word, i + 1), {head})").alias("key"), F.lit(False).alias("cut"),
                     F.lit(False).alias("first"))
    gone = F.struct(F.expr(f"concat(substring(word, i + 2), {head})").alias("key"), F.lit(True).alias("cut"),
                    F.expr("i = 0 OR substring(word, i + 1, 1) <> substring(word, i, 1)").alias("first"))
    both = placed.select("at", "n", "size", "i", F.explode(F.array(whole, gone)).alias("r"))
    fits = F.when(F.col("r.cut"), F.col("i") < F.col("size")).otherwise(F.col("size") < LONG)
    return both.where(fits).select("r.key", "at", "n", "r.cut", "r.first")


def rotation_hashes(word: str, cut: bool) -> np.ndarray:
    """A row of 4 hashes for each rotation of ``word$`` (whole), or for each without its last character (cut)."""
    c = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64)
    n = len(c)
    places = np.arange(n if cut else n + 1)
    out = np.empty((len(places), len(PRIMES)), np.int64)
    for k, (p, base) in enumerate(zip(PRIMES, BASES)):
        prime = np.uint64(p)

        def powers(b: int) -> np.ndarray:
            got = np.ones(1, np.uint64)
            while len(got) < n + 2:                       # by doubling
                got = np.concatenate([got, got * np.uint64(pow(b, len(got), p)) % prime])
            return got[:n + 2]

        up, down = powers(base % p), powers(pow(base % p, -1, p))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(c * up[:n] % prime) % prime])
        start = places + 1 if cut else places
        tail = (sums[n] + prime - sums[start]) % prime * down[start] % prime
        rest = n - start                                  # the head goes on behind the tail and the terminator
        out[:, k] = (tail + sums[places] * up[rest + 1] % prime) % prime
    return out


def long_rotations(words: DataFrame) -> DataFrame:
    """The rows of :func:`short_rotations` for longer words; keys are hashes and the lengths of both parts."""
    def rotated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for word, at, n in zip(pdf["word"], pdf["at"], pdf["n"]):
                letters = np.frombuffer(word.encode("utf-32-le"), "<u4")
                size = len(letters)
                first = np.concatenate([[True], letters[1:] != letters[:-1]])
                for cut in (False, True):
                    if cut and size <= LONG:
                        continue
                    h = rotation_hashes(word, cut)
                    for i in range(0, len(h), 1 << 16):
                        part = h[i:i + (1 << 16)]
                        head = np.arange(i, i + len(part))
                        yield pd.DataFrame({"head": head, "tail": size - cut - head, "x": part[:, 0] << 31 | part[:, 1],
                                            "y": part[:, 2] << 31 | part[:, 3], "at": at, "n": n, "cut": cut,
                                            "first": first[head] if cut else False})

    rows = words.where(F.length("word") >= LONG).select("word", "at", "n").mapInPandas(
        rotated, "head long, tail long, x long, y long, at long, n long, cut boolean, first boolean")
    return rows.select(F.concat_ws(",", F.lit("#"), "head", "tail", "x", "y").alias("key"), "at", "n", "cut", "first")


def rotations(words: DataFrame, longest: int) -> DataFrame:
    short = short_rotations(words)
    return short.unionByName(long_rotations(words)) if longest >= LONG else short


def _best(n: Column, at: Column) -> Column:
    """Smaller for the better near word: more frequent, then earlier in order."""
    return F.struct((-n).alias("less"), at.alias("at"))


def scan(rows: DataFrame) -> DataFrame:
    """``at, n_near, best`` of the words that have near words: sums and minima over their groups."""
    group = Window.partitionBy("key").orderBy(F.col("n").desc(), "at").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    own = _best(F.col("n"), F.col("at"))
    cut = F.col("cut")
    seen = rows.select(
        "at", "cut", "first",
        F.sum(cut.cast("int")).over(group).alias("cuts"), F.sum(F.col("first").cast("int")).over(group).alias("firsts"),
        F.sum((~cut).cast("int")).over(group).alias("wholes"),
        F.first(F.when(cut, own), ignorenulls=True).over(group).alias("one"),
        F.nth_value(F.when(cut, own), 2, ignoreNulls=True).over(group).alias("two"),
        F.first(F.when(F.col("first"), own), ignorenulls=True).over(group).alias("longer"),
        F.first(F.when(~cut, own), ignorenulls=True).over(group).alias("shorter"))
    other = F.when(F.col("one.at") == F.col("at"), F.col("two")).otherwise(F.col("one"))
    near = F.when(cut, F.col("cuts") - 1 + F.when(F.col("first"), F.col("wholes")).otherwise(0)).otherwise(F.col("firsts"))
    best = F.when(cut, F.least(other, F.when(F.col("first"), F.col("shorter")))).otherwise(F.col("longer"))
    return (seen.select("at", near.cast("long").alias("near"), best.alias("best")).where("near > 0")
            .groupBy("at").agg(F.sum("near").alias("n_near"), F.min("best").alias("best")))


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, near`` for every near pair of ``words`` (word, n), both ways round.  A group has
    one word a letter at most, so its pairs are bounded by the alphabet."""
    own = numbered(words)
    longest = own.agg(F.max(F.length("word"))).first()[0] or 0
    rows = rotations(own, longest)
    a, b = rows.alias("a"), rows.alias("b")
    meet = (F.col("a.key") == F.col("b.key")) & (F.col("a.at") != F.col("b.at")) & (
        (F.col("a.cut") & F.col("b.cut")) | (F.col("a.first") & ~F.col("b.cut")) | (~F.col("a.cut") & F.col("b.first")))
    pairs = a.join(b, meet).select(F.col("a.at").alias("at"), F.col("b.at").alias("near_at"))
    left, right = own.select("at", "word"), own.select(F.col("at").alias("near_at"), F.col("word").alias("near"))
    return pairs.join(left, "at").join(right, "near_at").select("word", "near")


def variant_groups(words: DataFrame, factor: int = 10) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every row of ``words`` (word, n; words differ)."""
    own = numbered(words)
    top = own.agg(F.max(F.length("word")).alias("longest"), F.max("n").alias("n")).first()
    with batches_of(own.sparkSession, 256):
        best = written(scan(rotations(own, top["longest"] or 0)))
    chosen = own.join(best, "at", "left").select(
        "at", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.less") >= factor * F.col("n"), F.col("best.at")).alias("form_at"))
    chosen = written(chosen)
    links = chosen.where("form_at IS NOT NULL").select("at", F.col("form_at").alias("root_at"))
    steps = max(1, math.ceil(math.log(max(top["n"] or 1, 2), factor)))     # counts grow by the factor a step
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        on = links.select(F.col("at").alias("root_at"), F.col("root_at").alias("next"))
        links = links.join(on, "root_at", "left").select("at", F.coalesce("next", "root_at").alias("root_at"))
    ends = chosen.join(links, "at", "left")
    form = own.select(F.col("at").alias("form_at"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    root = own.select(F.col("at").alias("root_at"), F.col("word").alias("root"))
    return (ends.join(form, "form_at", "left").join(root, "root_at", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
