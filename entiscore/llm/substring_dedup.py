"""Substring deduplication by super-k-mers.

A window is ``window`` consecutive words of one text.  Its minimiser is the least
hash of the ``gram``-word grams inside it; neighbouring windows mostly share theirs,
so a text falls into *super-k-mers*: runs of windows with one minimiser.  Equal
windows have equal minimisers, so

1. spans (minimiser, first window, windows) are taken from every text, and
   minimisers that occur in one ``doc_id`` only are set aside by counting: none of
   their windows can repeat across documents;
2. the words of each remaining super-k-mer travel as one packed string to the
   bucket of its minimiser (runs of more than ``span`` windows as several strings);
3. a bucket sorts its windows exactly (ranks of 1, 2, 4 ... words, doubled up to the
   window), which gives the smallest ``doc_id`` of every window and so the starts
   that another document has earlier.

Buckets hold about ``bucket_rows`` strings.  A minimiser with more than ``hot_rows``
strings is dealt over several buckets by document and place; what is the first of its kind in
each is then compared across them by a 128-bit digest of the window.  So no task
gets more than its share of a passage that many documents hold, and no string is
left out.

A word is removed if a window that covers it also starts in a document with a
smaller ``doc_id``.

Edge cases: null and empty texts have no words, texts shorter than a window lose
none; rows sharing a ``doc_id`` do not remove each other's words, and repeated rows
are treated alike; a null ``doc_id`` counts as larger than every number; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.llm.common import modest_batches, written

#: A null doc_id in the order of documents.
LAST = 2**63 - 1

_MIX = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Settings:
    window: int = 50
    gram: int = 12
    span: int = 256               # windows of one packed string at most: bounds strings of a text of one word
    bucket_rows: int = 4000
    hot_rows: int = 1000


def text_words(text) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` (bytes split at ASCII white space only)."""
    return text.encode("utf-8", "replace").split() if isinstance(text, str) else []


def super_kmers(words: list[bytes], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, windows) of the runs of windows that share a minimiser."""
    n = len(words) - s.window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    grams = len(words) - s.gram + 1
    g = np.zeros(grams, np.uint64)
    for k in range(s.gram):
        g = g * np.uint64(_MIX) + h[k:k + grams]
    g = (g ^ (g >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(32)
    # least of window - gram + 1 neighbours, by doubling
    width, least, have = s.window - s.gram + 1, g, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[:len(least) - (width - have)], least[width - have:])
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    count = np.diff(np.append(first, n))
    pieces = -(-count // s.span)
    if pieces.max() > 1:
        run = np.repeat(np.arange(len(first)), pieces)
        nth = np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, count = first[run] + nth * s.span, np.minimum(s.span, count[run] - nth * s.span)
    return least[first].view(np.int64), first, count


def window_ranks(codes: np.ndarray, window: int) -> np.ndarray:
    """For every start, a number that is equal for equal windows of ``codes`` and only for those."""
    rank, have = codes.astype(np.int64), 1
    while have < window:
        step = min(have, window - have)
        pair = rank[:-step] * (int(rank.max()) + 1) + rank[step:]
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        have += step
    return rank


def bucket_windows(pdf: pd.DataFrame, s: Settings) -> pd.DataFrame:
    """Windows of a bucket's strings that start in a smaller doc_id too, as runs of starts;
    and, of minimisers dealt over several buckets, the first of each kind with its digest."""
    split = [p.split() for p in pdf["packed"]]
    sizes = np.array([len(w) for w in split])
    flat = [w for ws in split for w in ws]
    rank = window_ranks(pd.factorize(np.array(flat, object))[0], s.window)
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    count = sizes - s.window + 1
    row = np.repeat(np.arange(len(pdf)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    kind = np.unique(rank[base[row] + nth], return_inverse=True)[1]
    ids = pdf["_id"].to_numpy(np.int64)
    first = np.full(kind.max() + 1, LAST, np.int64)
    np.minimum.at(first, kind, ids[row])
    later = ids[row] > first[kind]
    start = pdf["start"].to_numpy(np.int64)[row] + nth
    out = []
    at = np.flatnonzero(later)
    if len(at):
        new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(row[at]) != 0)])
        begin = at[new]
        end = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1]
        out.append(pd.DataFrame({"_id": ids[row[begin]], "_key": pdf["_key"].to_numpy()[row[begin]],
                                 "start": start[begin], "last": start[end], "digest": None}))
    open_ = np.flatnonzero(~later & pdf["hot"].to_numpy(bool)[row])
    if len(open_):
        digest = [hashlib.blake2b(b" ".join(flat[a:a + s.window]), digest_size=16).digest()
                  for a in (base[row] + nth)[open_]]
        out.append(pd.DataFrame({"_id": ids[row[open_]], "_key": pdf["_key"].to_numpy()[row[open_]],
                                 "start": start[open_], "last": start[open_], "digest": digest}))
    return pd.concat(out) if out else pd.DataFrame(columns=["_id", "_key", "start", "last", "digest"])


def repeated_windows(base: DataFrame, s: Settings) -> DataFrame:
    """``_id, _key, start, last``: runs of window starts whose windows a smaller doc_id has too."""
    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [super_kmers(text_words(t), s) for t in pdf["text"]]
            yield pd.DataFrame({"_id": pdf["_id"], "_key": pdf["_key"], "m": [g[0] for g in got],
                                "start": [g[1].astype(np.int32) for g in got],
                                "n": [g[2].astype(np.int32) for g in got]})

    # rows that repeat a text under one doc_id cannot remove each other's words: one of them stands for all
    base = base.dropDuplicates(["_id", "_key"])
    taken = written(base.mapInPandas(spans, "_id long, _key long, m array<long>, start array<int>, n array<int>"))
    rows = taken.select("_id", "_key", F.explode(F.arrays_zip("m", "start", "n")).alias("x")).select(
        "_id", "_key", "x.m", "x.start", "x.n")
    shared = written(rows.groupBy("m").agg(
        F.min("_id").alias("lo"), F.max("_id").alias("hi"), F.count(F.lit(1)).alias("strings"))
        .where("lo < hi").select("m", "strings"))
    total = shared.agg(F.sum("strings")).first()[0] or 0
    buckets = max(1, -(-total // s.bucket_rows))

    deal = F.when(F.col("strings") > s.hot_rows, F.pmod(F.xxhash64("_id", "_key", "start"), F.ceil(F.col("strings") / s.hot_rows)))
    bucket = F.pmod(F.xxhash64("m", F.coalesce(deal, F.lit(-1).cast("long"))), F.lit(buckets)).alias("bucket")
    own = rows.join(shared, "m").select(
        "_id", "_key", F.struct("start", "n", (F.col("strings") > s.hot_rows).alias("hot"), bucket).alias("x"))
    own = own.groupBy(F.col("_id").alias("_sid"), F.col("_key").alias("_skey")).agg(F.collect_list("x").alias("spans"))
    texts = base.join(own, (F.col("_id") == F.col("_sid")) & (F.col("_key") == F.col("_skey"))).select(
        "_id", "_key", "text", "spans.start", "spans.n", "spans.hot", "spans.bucket")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["_id", "_key", "start", "hot", "bucket", "packed"]
        for pdf in batches:
            out = []
            for i, key, text, *lists in pdf.itertuples(index=False):
                words = text_words(text)
                for a, n, hot, b in sorted(zip(*lists)):
                    out.append((i, key, a, hot, b, b" ".join(words[a:a + n + s.window - 1])))
                if len(out) > 4096:
                    yield pd.DataFrame(out, columns=cols)
                    out = []
            yield pd.DataFrame(out, columns=cols)

    packed = texts.mapInPandas(pack, "_id long, _key long, start int, hot boolean, bucket long, packed binary")

    def windows(pdf: pd.DataFrame) -> pd.DataFrame:
        return bucket_windows(pdf, s)

    found = packed.groupBy("bucket").applyInPandas(
        windows, "_id long, _key long, start long, last long, digest binary")
    return found


def dedup_substrings(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, text, n_words, n_removed``: the words that stay, joined by one space."""
    s = settings
    modest_batches(docs.sparkSession)
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_id"),
                       F.xxhash64("text").alias("_key"), "text")
    found = written(repeated_windows(base, s))
    sure = found.where("digest IS NULL").select("_id", "_key", "start", "last")
    # across the buckets of a hot minimiser: the smallest doc_id of each window
    dealt = found.where("digest IS NOT NULL")
    least = written(dealt.groupBy("digest").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi")).where("lo < hi"))
    late = dealt.join(least.select("digest", "lo"), "digest").where("_id > lo").select("_id", "_key", "start", "last")
    runs = sure.unionByName(late).groupBy(F.col("_id").alias("_rid"), F.col("_key").alias("_rkey")).agg(
        F.collect_set(F.struct("start", "last")).alias("runs"))
    rows = base.join(runs, (F.col("_id") == F.col("_rid")) & (F.col("_key") == F.col("_rkey")), "left").select(
        "_id", "text", "runs.start", "runs.last")

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, total, gone = [], [], []
            for text, starts, lasts in zip(pdf["text"], pdf["start"], pdf["last"]):
                words = text_words(text)
                removed = 0
                if starts is not None:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, np.asarray(starts, int), 1)
                    np.add.at(edge, np.asarray(lasts, int) + s.window, -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    removed = int((~stay).sum())
                    kept = [w for w, k in zip(words, stay.tolist()) if k]
                else:
                    kept = words
                texts.append(b" ".join(kept).decode())
                total.append(len(words))
                gone.append(removed)
            yield pd.DataFrame({"_id": pdf["_id"], "text": texts, "n_words": total, "n_removed": gone})

    out = rows.mapInPandas(keep, "_id long, text string, n_words long, n_removed long")
    return out.select(F.nullif(F.col("_id"), F.lit(LAST)).alias("doc_id"), "text", "n_words", "n_removed")
