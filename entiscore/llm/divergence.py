"""Source divergence audit by duplicate-text collapse.

How differently do the sources of a language use its terms?  Terms are runs of letters of
A-Z, a-z and of characters beyond ASCII, with A-Z lower-cased; each language keeps the
terms in at least ``least_docs`` of its documents.  Counts become smoothed integer shares
``p = 1 + floor(scale * (count + 2) / (N + 2V))``, and two shares of a term differ by
``floor((p - q)^2 / (p + q))``; all arithmetic is on integers, so results are exact.

1. *Collapse.*  Identical texts of a language (by SHA-256) are one group with its number of
   copies by source.  Counts combine before the shuffle, and one copy of each text travels.
   The list of a group has at most one entry a source of the language.
2. *Tokenise once.*  Each text is cut once; its terms add the number of copies to the
   document frequency, and to each source's counts in proportion.  A task adds its texts up
   in a dictionary that is let out when it holds ``held`` terms.
3. *Sparse pairs.*  A kept term that neither source of a pair uses adds the same value for
   all such terms, so a pair is V times that value plus corrections for the terms that one
   of the two uses (by distinct share) and for the terms that both use.  Terms are dealt
   into blocks of about ``block_cells`` counts by hash; each block adds up its pairs.

Edge cases: null text, lang and source read as empty text, which are a lang or source of
their own; documents without terms still make their source a group; a language without
kept terms has pairs of value 0; a language with one source has no pairs; repeated rows
are copies; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiscore.llm.common import batches_of, written

#: Bytes that belong to terms stay (A-Z as a-z), all others part them; UTF-8 bytes beyond ASCII all stay.
_CUT = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order."""
    return text.translate(_CUT).split()


def text_groups(docs: DataFrame) -> DataFrame:
    """``lang, text, own`` per distinct text of a language: ``own`` lists its sources and copies."""
    empty = F.lit("")
    base = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")])
    named = base.withColumn("_at", F.sha2(F.col("text").cast("binary"), 256))
    copies = named.groupBy("lang", "_at", "source").agg(F.count(F.lit(1)).alias("copies"))
    own = copies.groupBy("lang", "_at").agg(F.collect_list(F.struct("source", "copies")).alias("own"))
    texts = named.groupBy("lang", "_at").agg(F.any_value("text").alias("text"))
    return texts.join(own, ["lang", "_at"]).select("lang", "text", "own")


def term_counts(groups: DataFrame, held: int = 1_000_000) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences by source, and documents of the language by term and
    task beside the first of its sources (add them up).  Partitioned by lang and term.

    A task sends one row a term, with its counts by source, so the term travels once.
    """
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, dict[str, Counter]] = {}
        docs: dict[str, Counter] = {}

        def let_out() -> Iterator[pd.DataFrame]:
            for lang, by_source in sums.items():
                rows: dict[bytes, tuple[list, list]] = {}
                for source, own in by_source.items():
                    for t, n in own.items():
                        row = rows.get(t)
                        if row is None:
                            rows[t] = ([source], [n])
                        else:
                            row[0].append(source)
                            row[1].append(n)
                names, lists, every = list(rows), list(rows.values()), docs[lang]
                for at in range(0, len(names), 1 << 15):
                    part = lists[at:at + (1 << 15)]
                    yield pd.DataFrame({"lang": lang, "term": names[at:at + (1 << 15)], "docs": [every[t] for t in names[at:at + (1 << 15)]],
                                        "source": [x for x, _ in part], "n": [n for _, n in part]})
            sums.clear()
            docs.clear()

        for pdf in batches:
            for lang, text, own in zip(pdf["lang"], pdf["text"], pdf["own"]):
                found = terms(bytes(text))
                if not found:
                    continue
                by_source, every = sums.setdefault(lang, {}), docs.setdefault(lang, Counter())
                if len(own) == 1 and own[0]["copies"] == 1:
                    by_source.setdefault(own[0]["source"], Counter()).update(found)
                    every.update(set(found))
                else:
                    once = Counter(found)
                    for o in own:
                        by_source.setdefault(o["source"], Counter()).update({t: n * o["copies"] for t, n in once.items()})
                    every.update(dict.fromkeys(once, sum(o["copies"] for o in own)))
            if sum(len(c) for by_source in sums.values() for c in by_source.values()) > held:
                yield from let_out()
        yield from let_out()

    rows = groups.withColumn("text", F.col("text").cast("binary")).mapInPandas(
        counted, "lang string, term binary, docs long, source array<string>, n array<long>")
    dealt = rows.select("lang", F.col("term").cast("string").alias("term"), "docs", "source", "n").repartition("lang", "term")
    cells = dealt.select("lang", "term", "docs", F.posexplode(F.arrays_zip("source", "n")).alias("i", "x"))
    return cells.groupBy("lang", "term", F.col("x.source").alias("source")).agg(
        F.sum("x.n").alias("n"), F.sum(F.when(F.col("i") == 0, F.col("docs")).otherwise(0)).alias("docs"))


def share(count: str, total: str, kept: str) -> Column:
    """``1 + floor(10^9 * (count + 2) / (total + 2 * kept))`` of three columns, by long division
    in steps of 1000: exact while the denominator is below 9 * 10^15.  1 without kept terms."""
    by = f"({total} + 2 * {kept})"
    whole, left = f"(({count} + 2) div {by})", f"(({count} + 2) % {by})"
    for _ in range(3):
        whole, left = f"({whole} * 1000 + ({left} * 1000) div {by})", f"(({left} * 1000) % {by})"
    return F.expr(f"CASE WHEN {kept} > 0 THEN 1 + {whole} ELSE 1 END").cast("long")


def difference() -> Column:
    """Of the columns ``p`` and ``q``."""
    return F.expr("((p - q) * (p - q)) div (p + q)")


def block_pairs(source: np.ndarray, term: np.ndarray, p: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Sources x sources: what the block's terms add to ``V`` times the difference of ``rare``.

    ``source, term, p`` are the block's counts (shares ``p``); ``rare`` holds each source's
    share of a term it does not use.
    """
    def f(a, b):
        return (a - b)**2 // (a + b)

    n = len(rare)
    none = f(rare[:, None], rare[None, :])
    out = np.zeros((n, n), np.int64)
    order = np.lexsort((source, term))
    source, term, p = source[order], term[order], p[order]
    for s in np.unique(source):                      # terms one of the two uses, by distinct share
        own, times = np.unique(p[source == s], return_counts=True)
        for at in range(0, len(own), 4096):
            add = ((f(own[at:at + 4096, None], rare[None, :]) - none[s]) * times[at:at + 4096, None]).sum(0)
            out[s] += add
            out[:, s] += add
    step = 1
    while True:                                      # terms both use: the corrections meet
        both = np.flatnonzero(term[step:] == term[:-step]) if step < len(term) else np.zeros(0, np.int64)
        if not len(both):
            break
        a, b = both, both + step
        s, t = source[a], source[b]
        add = f(p[a], p[b]) - f(p[a], rare[t]) - f(rare[s], p[b]) + none[s, t]
        np.add.at(out, (s, t), add)
        np.add.at(out, (t, s), add)
        step += 1
    return out


def audit(docs: DataFrame, least_docs: int = 10, most_terms: int = 10, block_cells: int = 65_536) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` ranks the other sources of the
    language by how far they differ, part ``term`` the terms a source uses more than its language."""
    one = Window.partitionBy("lang", "term")
    with batches_of(docs.sparkSession, 256):
        cells = written(term_counts(text_groups(docs)).select(
            "lang", "source", "term", "n", F.sum("n").over(one).alias("lang_n"), F.sum("docs").over(one).alias("docs"))
            .where(F.col("docs") >= least_docs).drop("docs"))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("cells"))
    kept = cells.groupBy("lang").agg(F.countDistinct("term").alias("kept"), F.sum("n").alias("lang_total"),
                                     F.ceil(F.count(F.lit(1)) / block_cells).cast("long").alias("blocks"))
    empty, zero = F.lit(""), F.lit(0).cast("long")
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source")]).distinct()
    groups = groups.join(sums, ["lang", "source"], "left").join(kept, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "kept", "lang_total", "blocks")])
    groups = written(groups.withColumn("rare", share("0L", "total", "kept")))   # a row a source

    shares = written(cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share("n", "total", "kept").alias("p"),
        share("lang_n", "lang_total", "kept").alias("q"),
        F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")))
    own = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                       difference().alias("value"))

    def added(key, block: pd.DataFrame, every: pd.DataFrame) -> pd.DataFrame:
        every = every.sort_values("source").reset_index(drop=True)
        place = {name: i for i, name in enumerate(every["source"])}
        out = block_pairs(block["source"].map(place).to_numpy(np.int64), pd.factorize(block["term"])[0],
                          block["p"].to_numpy(np.int64), every["rare"].to_numpy(np.int64)) if len(block) else np.zeros((0, 0))
        s, t = np.nonzero(out)
        names = every["source"].to_numpy()
        return pd.DataFrame({"lang": key[0], "source": names[s], "item": names[t], "added": out[s, t].astype(np.int64)})

    everyone = groups.where("blocks > 0").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "source", "rare")
    sums = shares.select("lang", "block", "source", "term", "p").groupBy("lang", "block").cogroup(
        everyone.groupBy("lang", "block")).applyInPandas(added, "lang string, source string, item string, added long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("added").alias("added"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("rare").alias("q"))
    pairs = groups.withColumnRenamed("rare", "p").join(other, "lang").where("source <> item").select(
        "lang", "source", "item", (F.col("kept") * difference()).alias("base"))
    pairs = pairs.join(sums, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", (F.col("base") + F.coalesce("added", zero)).alias("value"))

    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(by)
    return (pairs.withColumn("rank", rank).unionByName(own.withColumn("rank", rank).where(F.col("rank") <= most_terms))
            .select("lang", "source", "part", "item", "value", "rank"))
