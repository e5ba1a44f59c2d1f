"""N-gram Jaccard join on count vectors with R-trees.

A document is the set of its distinct ``shingle``-word shingles (lower-cased A-Z).
Shingles are hashed into groups, and the counts by group make the document a point.
For two points the overlap of the sets is at most the sum of the coordinate minima,
and with similarity >= num/den it is at least ``num (|A| + |B|) / (num + den)``.

With 64 groups alone an R-tree prunes little (documents of one size look alike in
64 sums), so the index has two levels, both on group counts and both lossless:

1. *Cells.*  The fine groups (one per shingle hash) are dealt into blocks.  A linked
   pair differs in at most ``(den - num) (|A| + |B|) / (den + num)`` coordinates, so
   of that many + 1 blocks that are not empty in both, one holds equal counts in
   both.  Each document enters the cells (size band, block, counts in the block) of
   its first such blocks; sizes are banded by powers of two, and a document whose
   partners may lie in the next band enters that one's cells too.  Documents with
   fewer blocks than that also enter one common cell of their band.
2. *R-trees.*  The members of a cell are packed by size and coarse counts (64
   groups) into leaves with bounding boxes.  Pairs of leaves, then pairs of points,
   are kept only if the summed coordinate minima reach the needed overlap.

Pairs that survive are bounded once more on finer counts (more groups the larger
the sets) and verified on the full shingle sets.  Equal sets are one class
from the start.  Only the links that components need are sought: first each cell
member against the cell's most connected member, then, where a cell still holds
several components, its members of different components through the R-trees.  A
pair that is linked is either verified or already joined by other links, so the
classes are exact however large a group of near copies is, without listing its
pairs; :func:`linked_pairs` and :func:`link_counts` verify every pair, once, in blocks.  Cells of more than ``chunk`` members are searched as pairs of chunks.

Edge cases: null texts and texts without a word have an empty set and are linked
with nothing; texts shorter than a shingle have their whole word sequence as their
one shingle; repeated rows and rows sharing a ``doc_id`` are documents of their own
(equal sets are linked); a null ``doc_id`` counts as larger than every number; an
empty table gives no rows; columns of the caller that are named like an added
column are replaced by it.  Shingles are compared by a 64-bit hash, sets by a
64-bit digest and their size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.llm.common import ROW, WORD_SPACE, field, modest_batches, packed, unpacked, written
from entiscore.llm.components import connected_components

#: A null doc_id in the order of documents.
LAST = 2**63 - 1

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Settings:
    shingle: int = 4
    num: int = 85
    den: int = 100
    groups: int = 64              # coordinates of the R-trees
    fine: int = 256               # coordinates of the last bound before verification, for small sets
    per_group: int = 4            # larger sets are counted in more groups: about this many shingles each
    leaf: int = 16                # points of an R-tree leaf
    chunk: int = 512              # members of a cell searched in one piece
    unit_rows: int = 8192         # members dealt to one task's group of cells
    homes: int = 8                # largest cells of a set that are compared before a pair is searched again


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    return x ^ (x >> np.uint64(27))


def shingle_set(text, size: int) -> np.ndarray:
    """Ascending distinct hashes of the shingles of a text."""
    words = text.encode("utf-8", "replace").lower().split() if isinstance(text, str) else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(size, len(words))
    g = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        g = _mixed(g * _A + h[i:len(words) - k + 1 + i])
    return np.unique(g)


def set_class(shingles: np.ndarray) -> int:
    """A number naming the set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def largest_difference(a: int, b: int, s: Settings) -> int:
    """Shingles in one of two linked sets of these sizes but not in both, at most."""
    return (s.den - s.num) * (a + b) // (s.den + s.num)


def cells(shingles: np.ndarray, s: Settings) -> np.ndarray:
    """Keys of the cells a set enters."""
    n, out = len(shingles), []
    partner = n * s.den // s.num                  # largest size of a linked set
    if largest_difference(n, partner, s) < 1:     # only equal sets are linked
        return np.zeros(0, np.int64)
    band = n.bit_length()
    mixed = _mixed(shingles * _A)
    for k in range(band, partner.bit_length() + 1):
        top = (1 << k) - 1                        # largest size of the band
        blocks = largest_difference(top, top, s) * 5 // 4 + 3
        differ = largest_difference(n, min(partner, top), s)
        block = ((shingles >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)      # ascending with the hashes
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        counts = np.add.reduceat(mixed, first)    # hash of the count vector of a block: its coordinates summed
        use = slice(0, differ + 1)
        place = block[first[use]] + np.uint64(k << 40)
        out.append(_mixed(counts[use] * _A + place))
        if len(first) <= differ:
            out.append(_mixed(np.array([k], np.uint64) * _A))
    return np.concatenate(out).view(np.int64)


def group_counts(shingles: np.ndarray, s: Settings) -> np.ndarray:
    """Counts by group, in ``fine`` times a power of two groups that grows with the set:
    in a fixed number of groups all large sets look alike."""
    k = s.fine
    while k * s.per_group < len(shingles):
        k *= 2
    return np.bincount((shingles % np.uint64(k)).astype(np.int64), minlength=k).astype(np.uint16)


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """The counts of the same set in fewer groups."""
    return counts.reshape(-1, groups).sum(0, dtype=np.int64) if len(counts) > groups else counts.astype(np.int64)


def most_overlap(a: bytes, b: bytes) -> int:
    """Summed coordinate minima of two sets' group counts."""
    x, y = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
    k = min(len(x), len(y))
    return int(np.minimum(folded(x, k), folded(y, k)).sum())


def may_link(overlap, a, b, s: Settings):
    """Whether an overlap of at most ``overlap`` allows sets of sizes a and b to be linked."""
    return overlap * (s.num + s.den) >= s.num * (a + b)


def tree_pairs(n: np.ndarray, points: np.ndarray, part: np.ndarray, left: np.ndarray, right: np.ndarray,
               s: Settings) -> list[tuple[int, int]]:
    """Index pairs (one of ``left``, one of ``right``) of different ``part`` whose bound allows a link."""
    def packed(at: np.ndarray) -> list[np.ndarray]:
        at = at[np.lexsort((points[at, 0], n[at]))]                  # by size, then counts
        runs = [at[i:i + s.leaf * s.leaf] for i in range(0, len(at), s.leaf * s.leaf)]
        out = []
        for r in runs:
            axis = np.argmax(np.ptp(points[r], axis=0))
            r = r[np.argsort(points[r, axis], kind="stable")]
            out += [r[i:i + s.leaf] for i in range(0, len(r), s.leaf)]
        return out

    if not len(left) or not len(right):
        return []
    a, b = packed(left), packed(right)
    high_a, high_b = (np.array([points[i].max(0) for i in x]) for x in (a, b))
    low_a, low_b = (np.array([n[i].min() for i in x]) for x in (a, b))
    out = []
    for i, own in enumerate(a):
        bound = np.minimum(high_a[i], high_b).sum(1)
        for j in np.flatnonzero(may_link(bound, low_a[i], low_b, s)):
            overlap = np.minimum(points[own][:, None, :], points[b[j]][None, :, :]).sum(2)
            ok = may_link(overlap, n[own][:, None], n[b[j]][None, :], s) & (part[own][:, None] != part[b[j]][None, :])
            out += [(own[x], b[j][y]) for x, y in zip(*np.nonzero(ok))]
    return out


def finer_bound(counts: list[np.ndarray], n: np.ndarray, x: np.ndarray, y: np.ndarray, s: Settings) -> np.ndarray:
    """Whether the summed minima of all their groups allow the pairs (x, y) of sets to be linked."""
    ok = np.zeros(len(x), bool)
    size = np.array([len(v) for v in counts], np.int64)
    least = np.minimum(size[x], size[y])
    for k in np.unique(least):
        at = np.flatnonzero(least == k)
        used, code = np.unique(np.concatenate([x[at], y[at]]), return_inverse=True)
        points = np.stack([folded(counts[u], k) for u in used]).astype(np.int32)
        a, b = code[:len(at)], code[len(at):]
        step = max(1, (1 << 20) // int(k))
        for i in range(0, len(at), step):
            part = slice(i, i + step)
            most = np.minimum(points[a[part]], points[b[part]]).sum(1)
            ok[at[part]] = may_link(most, n[x[at[part]]], n[y[at[part]]], s)
    return ok


def open_pairs(earlier: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs (one of ``left``, one of ``right``) have none of their ``earlier`` cells in common."""
    names, code = np.unique(np.concatenate([earlier[x] for x in (*left, *right)]), return_inverse=True)
    shared = np.zeros((len(left) + len(right), len(names)), np.float32)
    shared[np.repeat(np.arange(len(shared)), [len(earlier[x]) for x in (*left, *right)]), code] = 1
    return shared[:len(left)] @ shared[len(left):].T == 0


def unit_pairs(pdf: pd.DataFrame, s: Settings) -> pd.DataFrame:
    """Pairs that survive the R-trees of the cells (or pairs of chunks) in ``pdf`` and the bound on
    their finer counts, with the blocks of both.  Pairs that meet in one of their ``earlier`` cells
    are left to that cell."""
    n, part, c = pdf["n"].to_numpy(np.int64), pdf["part"].to_numpy(), pdf["c"].to_numpy()
    counts = [np.frombuffer(v, np.uint16) for v in pdf["counts"]]
    points = np.stack([folded(v, s.groups) for v in counts])
    earlier, block, chunk = list(pdf["earlier"]), pdf["block"].to_numpy(), pdf["chunk"].to_numpy()
    found = []
    for _, at in pdf.groupby(["key", "i", "j"], sort=False).indices.items():
        left, right = at[chunk[at] == pdf["i"].iat[at[0]]], at[chunk[at] == pdf["j"].iat[at[0]]]
        if not len(left) or not len(right):
            continue
        free = open_pairs(earlier, left, right)
        row, col = dict(zip(left, range(len(left)))), dict(zip(right, range(len(right))))
        pairs = tree_pairs(n, points, part, left[free.any(1)], right[free.any(0)], s)
        found += [(x, y) for x, y in pairs if free[row[x], col[y]]]
    x, y = np.array(found, np.int64).reshape(-1, 2).T
    x, y = np.where(c[x] < c[y], x, y), np.where(c[x] < c[y], y, x)
    out = pd.DataFrame({"a": c[x], "b": c[y], "block_a": block[x], "block_b": block[y], "x": x, "y": y}).astype("int64")
    out = out.drop_duplicates(["a", "b"])             # near pairs share many cells
    return out.loc[finer_bound(counts, n, out["x"].to_numpy(), out["y"].to_numpy(), s), ["a", "b", "block_a", "block_b"]]


def _sets(rows: DataFrame, s: Settings) -> DataFrame:
    """``c, n, counts, shingles`` of ``c, text`` rows."""
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingle_set(t, s.shingle) for t in pdf["text"]]
            yield pd.DataFrame({"c": pdf["c"], "n": [len(x) for x in sets],
                                "counts": [group_counts(x, s).tobytes() for x in sets],
                                "shingles": [x.tobytes() for x in sets]})

    return rows.mapInPandas(make, "c long, n int, counts binary, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """The pairs ``a, b`` that are linked: bounded by their group counts first, then on the full sets."""
    def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            most = np.array([most_overlap(x, y) for x, y in zip(pdf["ca"], pdf["cb"])], np.int64)
            yield pdf.loc[may_link(most, pdf["na"].to_numpy(), pdf["nb"].to_numpy(), s), ["a", "b"]]

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = []
            for x, y in zip(pdf["sa"], pdf["sb"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(s.den * both >= s.num * (len(x) + len(y) - both))
            yield pdf.loc[ok, ["a", "b"]]

    def side(k: str, *cols: tuple[str, str]) -> DataFrame:
        return sets.select(F.col("c").alias(k), *[F.col(c).alias(n) for c, n in cols])

    near = pairs.join(side("a", ("n", "na"), ("counts", "ca")), "a").join(side("b", ("n", "nb"), ("counts", "cb")), "b")
    near = written(near.mapInPandas(bounded, "a long, b long"))
    # only the sets of these pairs travel on
    wanted = near.select(F.col("a").alias("w")).union(near.select("b")).distinct()
    own = sets.join(wanted, F.col("c") == F.col("w")).select("c", "shingles")
    full = near.join(own.select(F.col("c").alias("a"), F.col("shingles").alias("sa")), "a").join(
        own.select(F.col("c").alias("b"), F.col("shingles").alias("sb")), "b")
    return full.select("a", "b", "sa", "sb").mapInPandas(exact, "a long, b long")


def _indexed(docs: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows ``_id, _key, n, c``, members ``key, c`` of the cells that hold different sets, and the sets
    ``c, n, counts, shingles`` in such cells; ``c`` names the set of a row."""
    modest_batches(docs.sparkSession)
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_id"),
                       F.xxhash64("text").alias("_key"), "text")

    def entered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()                    # copies met by this task enter their cells once
        for pdf in batches:
            n, c, keys = [], [], []
            for t in pdf["text"]:
                x = shingle_set(t, s.shingle)
                n.append(len(x))
                c.append(set_class(x))
                keys.append(np.zeros(0, np.int64) if c[-1] in seen else cells(x, s))
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(c[-1])
            yield pd.DataFrame({"_id": pdf["_id"], "_key": pdf["_key"], "n": n, "c": c, "keys": keys})

    read = written(base.mapInPandas(entered, "_id long, _key long, n int, c long, keys array<long>"))
    rows = read.select("_id", "_key", "n", "c")
    members = read.select("c", F.explode("keys").alias("key"))
    # counts by cell are written before they are joined back: the join then has a shuffle of its
    # own on both sides, which adaptive execution can split where one cell holds very many
    several = written(members.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key"))
    members = written(members.join(several, "key").select("key", "c").distinct())

    # the full sets of the documents that share a cell, one document a class
    wanted = members.select("c").distinct()
    first = rows.join(wanted, "c").groupBy("c").agg(F.min(F.struct("_id", "_key")).alias("x")).select(
        "c", F.col("x._id").alias("_rid"), F.col("x._key").alias("_rkey"))
    texts = base.join(first, (F.col("_id") == F.col("_rid")) & (F.col("_key") == F.col("_rkey")))
    sets = written(_sets(texts.dropDuplicates(["_id", "_key"]).select("c", "text"), s))
    return rows, members, sets


def _searched(members: DataFrame, cells_: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Pairs ``a, b, block_a, block_b`` of members (key, c, part) of different parts in the cells (key, m) that
    survive the R-trees and the finer counts; cells of more than ``chunk`` members as pairs of chunks.  ``sets``
    have the ``block`` of a set and those of its cells in ``homes`` (m, key) that are searched before smaller ones."""
    units = members.join(cells_, "key").withColumn("pieces", F.ceil(F.col("m") / s.chunk).cast("int"))
    units = written(units.withColumn("chunk", F.pmod(F.xxhash64("c"), F.col("pieces")).cast("int")).select(
        "key", "c", "part", "m", "chunk", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other")))
    tasks = max(1, math.ceil(units.count() / s.unit_rows))
    units = units.select("key", "c", "part", "m", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    before = F.filter("homes", lambda h: (h["m"] > F.col("m")) | ((h["m"] == F.col("m")) & (h["key"] > F.col("key"))))
    units = units.join(sets.select("c", "n", "counts", "homes", "block"), "c").withColumn(
        "earlier", F.transform(before, lambda h: h["key"])).drop("homes", "m").withColumn(
        "task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(tasks)))

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        return unit_pairs(pdf, s)

    return written(units.groupBy("task").applyInPandas(pairs, "a long, b long, block_a long, block_b long").distinct())


def common_sizes(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (x, y) of sets that are not empty."""
    if not len(x):
        return np.zeros(0, np.int64)
    size = np.array([len(v) for v in sets], np.int64)
    code = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(size)[:-1])
    own, out = np.zeros(size.sum(), bool), np.zeros(len(x), np.int64)
    order = np.argsort(x, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(x[order])) + 1):
        for part in np.array_split(at, math.ceil(len(at) / 256)):
            others = y[part]
            own[code[x[part[0]]]] = True
            hits = own[np.concatenate([code[j] for j in others])]
            out[part] = np.add.reduceat(hits, np.concatenate([[0], np.cumsum(size[others])[:-1]]), dtype=np.int64)
            own[code[x[part[0]]]] = False
    return out


def _verified_blocks(found: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """The pairs of :func:`_searched` that are linked as ``a, b, n_a, n_b``, verified on the full sets.

    The pairs of two blocks are verified together, so a set travels once for each block it is
    compared with, however many of its pairs there are.
    """
    ends = F.least("block_a", "block_b"), F.greatest("block_a", "block_b")
    needed = written(found.select(F.xxhash64(*ends).alias("unit"), F.explode(F.array("a", "b")).alias("c")).distinct())
    task = F.pmod("unit", F.lit(max(1, math.ceil(needed.count() / (4 * s.chunk)))))
    pairs = found.select("a", "b", F.xxhash64(*ends).alias("unit")).select("a", "b", task.alias("task"))
    own = needed.select(task.alias("task"), "c").distinct().join(sets.select("c", "shingles"), "c")

    def exact(pairs: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(pairs):
            return pd.DataFrame({k: np.zeros(0, np.int64) for k in ("a", "b", "n_a", "n_b")})
        at = pd.Index(own["c"])
        x, y = at.get_indexer(pairs["a"]), at.get_indexer(pairs["b"])
        full = [np.frombuffer(v, np.uint64) for v in own["shingles"]]
        size, both = np.array([len(v) for v in full], np.int64), common_sizes(full, x, y)
        ok = s.den * both >= s.num * (size[x] + size[y] - both)
        return pd.DataFrame({"a": pairs["a"], "b": pairs["b"], "n_a": size[x], "n_b": size[y]}).loc[ok]

    return pairs.groupBy("task").cogroup(own.groupBy("task")).applyInPandas(exact, "a long, b long, n_a int, n_b int")


def link_classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``_id, _key, n_shingles, part, component_id`` of every row; ``_id`` is ``doc_id`` with null
    last, ``_key`` a hash of the text, and ``part`` names the class (null for an empty set)."""
    s = settings
    rows, members, sets = _indexed(docs, s)

    # every member against the member of its cell that shares most cells
    size = written(members.groupBy("key").agg(F.count(F.lit(1)).alias("m")))
    weight = members.join(size, "key").groupBy("c").agg(F.sum("m").alias("w"))
    weighed = members.join(weight, "c")
    top = written(weighed.groupBy("key").agg(F.max(F.struct("w", "c")).alias("x")).select("key", F.col("x.c").alias("top")))
    star = members.join(top, "key").where("c <> top").select(
        F.least("c", "top").alias("a"), F.greatest("c", "top").alias("b")).distinct()
    links = written(_verified(star, sets, s))
    joined = connected_components(links)

    # cells that still hold several components
    parted = members.join(joined.withColumnRenamed("v", "c"), "c", "left").select(
        "key", "c", F.coalesce("label", "c").alias("part"))
    open_ = written(parted.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"),
                                              F.count(F.lit(1)).alias("m")).where("lo < hi").select("key", "m"))
    found = _searched(parted, open_, sets.withColumn("homes", F.expr("CAST(array() AS array<struct<m: bigint, key: bigint>>)"))
                      .withColumn("block", F.lit(0)), s).select("a", "b")
    links = links.unionByName(_verified(found, sets, s))
    joined = connected_components(written(links))

    named = rows.join(joined.withColumnRenamed("v", "c"), "c", "left").select(
        "_id", "_key", "n", F.when(F.col("n") > 0, F.coalesce("label", "c")).alias("part"))
    least = written(named.where("part IS NOT NULL").groupBy("part").agg(F.min("_id").alias("component")))
    return named.join(least, "part", "left").select(
        "_id", "_key", F.col("n").cast("long").alias("n_shingles"), "part",
        F.coalesce("component", "_id").alias("component_id"))


def jaccard_classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    out = link_classes(docs, settings)
    return out.select(F.nullif(F.col("_id"), F.lit(LAST)).alias("doc_id"), "n_shingles",
                      F.nullif(F.col("component_id"), F.lit(LAST)).alias("component_id"))


def keep_one(docs: DataFrame, settings: Settings = Settings(shingle=5, num=80, den=100)) -> DataFrame:
    """The rows of ``docs``, one of each class of linked documents: that of the smallest ``doc_id``.

    Rows without a word are linked with nothing and stay, each of them.  Of a class, among rows
    that share a ``doc_id`` the smaller text hash stays, and of rows that share both the smallest.
    """
    classes = link_classes(docs, settings)
    first = classes.where("part IS NOT NULL").groupBy("part").agg(F.min(F.struct("_id", "_key")).alias("x"))
    keep = first.select(F.col("x._id").alias("_kid"), F.col("x._key").alias("_kkey"))
    rows = packed(docs)
    wordless = F.btrim(F.coalesce(field("text"), F.lit("")), F.lit(WORD_SPACE)) == ""
    named = rows.where(~wordless).select(ROW, F.coalesce(field("doc_id").cast("long"), F.lit(LAST)).alias("_id"),
                                         F.xxhash64(field("text")).alias("_key"))
    kept = named.join(keep, (F.col("_id") == F.col("_kid")) & (F.col("_key") == F.col("_kkey")))
    return unpacked(kept.groupBy("_id", "_key").agg(F.min(ROW).alias(ROW)).select(ROW).unionByName(rows.where(wordless)), {})


def linked_pairs(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Every link: ``a, b, n_a, n_b`` between classes of equal sets (each pair once), and the membership
    ``doc_id, class, n_shingles`` of every row (null class: an empty set).

    Unlike the components, which need no more links than join a class to its group, all pairs of
    different sets that share a cell go through the R-trees and are verified.  Near copies share very many
    cells: a pair is searched in the largest of them (order: members, key), as far as the ``homes`` largest
    cells of both sets tell, and a cell whose members all have one larger cell in common is not searched.
    """
    s = settings
    rows, members, sets = _indexed(docs, s)
    size = written(members.groupBy("key").agg(F.count(F.lit(1)).alias("m")))
    own = written(members.join(size, "key").groupBy("c").agg(
        F.sort_array(F.collect_list(F.struct("m", "key")), asc=False).alias("cells")))
    home = F.col("cells")[0]
    block = F.xxhash64(home["key"], F.pmod(F.xxhash64("c"), F.ceil(home["m"] / s.chunk)))
    homes = own.select("c", F.slice("cells", 1, s.homes).alias("homes"), block.alias("block"))
    placed = own.select("c", F.col("c").alias("part"), home["key"].alias("home"), F.explode("cells").alias("x"))
    search = written(placed.groupBy(F.col("x.key").alias("key")).agg(
        F.min("home").alias("lo"), F.max("home").alias("hi"), F.min("x.m").alias("m")).where("lo < hi OR lo = key").select("key", "m"))
    found = _searched(placed.select("x.key", "c", "part"), search, sets.join(homes, "c"), s)
    return written(_verified_blocks(found, sets, s)), rows.select(
        F.nullif(F.col("_id"), F.lit(LAST)).alias("doc_id"), F.when(F.col("n") > 0, F.col("c")).alias("class"),
        F.col("n").cast("long").alias("n_shingles"))


def link_counts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, class, n_links`` of every row: the number of other rows it is linked with, from
    :func:`linked_pairs` and the sizes of the classes, without listing copies."""
    pairs, membership = linked_pairs(docs, settings)
    sizes = membership.where("class IS NOT NULL").groupBy("class").agg(F.count(F.lit(1)).alias("rows"))
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(sizes.withColumnRenamed("class", "b"), "b").groupBy(F.col("a").alias("class")).agg(F.sum("rows").alias("near"))
    links = sizes.join(near, "class", "left").select(
        "class", (F.col("rows") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    return membership.join(links, "class", "left").select(
        "doc_id", "n_shingles", "class", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
