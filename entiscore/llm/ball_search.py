"""Exact top-k search by inner product: ball trees per shard, branch and bound.

Vectors become integers, ``floor(scale * x)``, and scores are integer inner products, so
every comparison is exact.

Shards.  The top of a ball tree is fitted on a bounded sample (``sample`` vectors) and
splits space into at most ``sample / 16`` regions; every vector goes to its region, and a
region of more than ``shard_rows`` vectors is dealt into shards by a hash of the id, so a
shard is bounded however many copies there are.  A region's ball is its sample mean and
the largest distance of *any* of its vectors, so its bound holds for all of them.

A ball with centre c and radius r cannot hold a score above ``<q, c> + |q| r``.  Each
query is searched first in one shard of the region of the largest bound.  Its k-th score
then travels with it: only regions whose bound reaches that score are asked, and inside a
shard the tree's nodes are cut by the same test, the leaves that are left are visited in
order of their bound, and the k-th score rises on the way.  A bound equal to the k-th
score is still followed, because a smaller id may tie.

A shard's vectors travel once, ahead of the queries that ask it, which are streamed past
the tree.  Where more than ``query_rows`` queries ask one shard, the shard is copied once
for every further ``query_rows`` of them, so copies follow the need.

Edge cases: vectors that are null or hold null or non-finite components, null ids, and
vectors whose length is not the most frequent one (the larger on a tie) take no part;
zero vectors do.  Of rows sharing an id the smallest vector counts.  Components and scores
beyond a long are given as the nearest long.  Ties go to the smaller id; fewer candidates
than ``k`` give fewer rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entiscore.llm.common import uniform, written

LEAST, NO_ID = np.iinfo(np.int64).min, np.iinfo(np.int64).max


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    sample: int = 16384
    shard_rows: int = 16384
    leaf_rows: int = 256
    query_rows: int = 65536


# --- ball trees ----------------------------------------------------------------

def spread(x: np.ndarray) -> np.ndarray:
    """From the point farthest from the mean to the point farthest from that one."""
    a = x[np.argmax(((x - x.mean(0))**2).sum(1))]
    return x[np.argmax(((x - a)**2).sum(1))] - a


class Regions:
    """The top of the tree: node i goes on to 2i + 1 (along <= value) and 2i + 2."""

    def __init__(self, sample: np.ndarray, regions: int):
        self.depth = max(0, math.ceil(math.log2(max(1, min(regions, len(sample) // 16)))))
        n, d = 2**self.depth - 1, sample.shape[1]
        self.along, self.value, own = np.zeros((n, d)), np.zeros(n), {0: sample}
        for i in range(n):
            x = own.pop(i)
            if len(x):
                self.along[i] = spread(x)
                self.value[i] = np.median(x @ self.along[i])
            right = x @ self.along[i] > self.value[i]
            own[2 * i + 1], own[2 * i + 2] = x[~right], x[right]
        middle = sample.mean(0)
        self.centres = np.stack([own[n + i].mean(0) if len(own[n + i]) else middle for i in range(n + 1)])

    def of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (np.einsum("ij,ij->i", x, self.along[node]) > self.value[node])
        return node - (2**self.depth - 1)


def upper_bounds(q: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Queries x balls: no vector of the ball scores above this (rounding included)."""
    norm = np.linalg.norm(q, axis=1)[:, None]
    return q @ centres.T + norm * (radii + 1e-9 * (radii + np.linalg.norm(centres, axis=1) + 1))


class BallTree:
    """Nodes in breadth-first order; a node without ``left`` is a leaf over ``order[start:end]``."""

    def __init__(self, x: np.ndarray, leaf_rows: int):
        self.order = np.arange(len(x))
        self.start, self.end, self.left = [0], [len(x)], []
        centres, radii, i = [], [], 0
        while i < len(self.start):
            at = self.order[self.start[i]:self.end[i]]
            p = x[at]
            centres.append(p.mean(0))
            radii.append(math.sqrt(((p - centres[-1])**2).sum(1).max()))
            if len(at) > leaf_rows:
                self.left.append(len(self.start))
                by = np.argsort(p @ spread(p), kind="stable")
                self.order[self.start[i]:self.end[i]] = at[by]
                middle = self.start[i] + len(at) // 2
                self.start += [self.start[i], middle]
                self.end += [middle, self.end[i]]
            else:
                self.left.append(0)
            i += 1
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.leaves = np.flatnonzero(np.array(self.left) == 0)

    def open_leaves(self, q: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """Queries x leaves: the bound of each leaf, -inf where a node above is cut by the k-th score."""
        bound = upper_bounds(q, self.centres, self.radii)
        bound[bound < kth[:, None]] = -np.inf
        for i, left in enumerate(self.left):
            if left:
                cut = bound[:, i] == -np.inf
                bound[cut, left] = bound[cut, left + 1] = -np.inf
        return bound[:, self.leaves]


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows as longs."""
    most = max(1, q.shape[1]) * _largest(q) * _largest(x)
    if most < 2**53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    if most < 2**63:
        return q @ x.T
    return np.clip(q.astype(object) @ x.astype(object).T, LEAST + 1, NO_ID).astype(np.int64)


def _largest(a: np.ndarray) -> int:
    return max(abs(int(a.max(initial=0))), abs(int(a.min(initial=0))))


def search_shard(tree: BallTree, ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray,
                 kth: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of up to ``k`` best of a shard for each query, of those that may enter its list."""
    at = tree.open_leaves(q.astype(float), kth.astype(float))
    order = np.argsort(-at, axis=1, kind="stable")
    best, name = np.full((len(q), k), LEAST), np.full((len(q), k), NO_ID)
    rows = np.arange(len(q))
    for r in range(order.shape[1]):
        least = np.maximum(best[:, -1], kth)
        bound = at[rows, order[:, r]]
        go = np.flatnonzero((bound > -np.inf) & (bound >= least.astype(float)))
        if not len(go):
            break
        for leaf in np.unique(order[go, r]):
            who = go[order[go, r] == leaf]
            node = tree.leaves[leaf]
            members = tree.order[tree.start[node]:tree.end[node]]
            score = products(q[who], x[members])
            may = (score >= least[who, None]) & (qids[who, None] != ids[members][None, :])
            has, cols = may.any(1), may.any(0)
            if not has.any():
                continue
            who, members, may = who[has], members[cols], may[has][:, cols]
            score = np.where(may, score[has][:, cols], LEAST)
            s = np.concatenate([best[who], score], axis=1)
            n = np.concatenate([name[who], np.where(may, ids[members][None, :], NO_ID)], axis=1)
            top = np.lexsort((n, ~s), axis=1)[:, :k]
            best[who], name[who] = (np.take_along_axis(a, top, 1) for a in (s, n))
    found = name != NO_ID
    return np.repeat(qids, found.sum(1)), name[found], best[found]


# --- Spark -----------------------------------------------------------------------

def scaled_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, v`` (array of long) of the vectors that take part; one row an id."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & fine)
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * F.lit(float(scale)))).alias("v")).groupBy(
        "vec_id").agg(F.min("v").alias("v"))


def top_k(vectors: DataFrame, is_query, k: int = 5, settings: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest integer inner products for each query row."""
    s, spark = settings, vectors.sparkSession
    every = written(scaled_vectors(vectors, s.scale))
    sizes = every.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.col("n").desc(), F.col("d").desc()).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    length, n = sizes[0]["d"], sizes[0]["n"]
    every = every.where(F.size("v") == length)

    def rows_of(v: pd.Series) -> np.ndarray:
        return np.stack(v.to_list()).astype(np.int64).reshape(len(v), length)

    # the top of the tree, from a bounded sample picked by a hash of the id
    u = uniform(F.col("vec_id"), "ball")
    picked = every.where(u <= min(1.0, 2 * s.sample / n)).orderBy(u, "vec_id").limit(s.sample)
    top = Regions(rows_of(picked.select("v").toPandas()["v"]).astype(float), -(-n // s.shard_rows))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = rows_of(pdf["v"]).astype(float)
                region = top.of(x)
                far = np.sqrt(((x - top.centres[region])**2).sum(1))
                yield pdf.assign(region=region.astype(np.int32), far=far)

    placed = written(every.mapInPandas(place, "vec_id long, v array<long>, region int, far double"))
    # one row a region: sample / 16 at most
    balls = {r["region"]: r for r in placed.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
    regions = np.array(sorted(balls), np.int64)
    centres, radii = top.centres[regions], np.array([balls[r]["far"] for r in regions])
    shards_in = np.array([-(-balls[r]["n"] // s.shard_rows) for r in regions], np.int64)
    first_shard = np.cumsum(shards_in) - shards_in
    table = F.broadcast(spark.createDataFrame(
        [(int(r), int(f), int(m)) for r, f, m in zip(regions, first_shard, shards_in)], "region int, first long, shards long"))
    points = placed.join(table, "region").select(
        "vec_id", "v", (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("shards"))).alias("shard"))
    queries = written(every.where(is_query))

    def asked(again: bool):
        """Shards each query asks: one of the region of its largest bound, then all others its k-th score leaves open."""
        def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if not len(pdf):
                    continue
                bound = upper_bounds(rows_of(pdf["v"]).astype(float), centres, radii)
                best = bound.argmax(1)
                ids, kth = pdf["vec_id"].to_numpy(), pdf["kth"].to_numpy()
                home = first_shard[best] + ids % shards_in[best]
                if again:
                    for at in range(0, len(pdf), 64):       # a query may ask every shard
                        open_ = [np.concatenate([np.arange(f, f + m) for f, m in zip(first_shard[o], shards_in[o])] or [np.zeros(0, np.int64)])
                                 for o in bound[at:at + 64] >= kth[at:at + 64, None].astype(float)]
                        yield pdf.iloc[at:at + 64].assign(shard=[o[o != h] for o, h in zip(open_, home[at:at + 64])])
                else:
                    yield pdf.assign(shard=[np.array([h]) for h in home])
        return choose

    def searched(rows: DataFrame, again: bool) -> DataFrame:
        chosen = rows.mapInPandas(asked(again), "vec_id long, v array<long>, kth long, shard array<long>")
        asks = chosen.select("vec_id", "v", "kth", F.explode("shard").alias("shard"))
        units = asks.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / s.query_rows).cast("long").alias("units"))
        own = points.join(units, "shard").select(
            "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("units") - 1)).alias("unit"), F.lit(0).alias("kind"),
            "vec_id", "v", F.lit(LEAST).cast("long").alias("kth"))
        go = asks.join(units, "shard").select(
            "shard", F.pmod(F.xxhash64("vec_id"), F.col("units")).alias("unit"), F.lit(1).alias("kind"), "vec_id", "v", "kth")
        stream = own.unionByName(go).repartition("shard", "unit").sortWithinPartitions("shard", "unit", "kind")
        return stream.mapInPandas(search, "query_id long, vec_id long, score long")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come shard by shard, its vectors before its queries."""
        now, held, tree, ids, x = None, [], None, None, None
        for pdf in batches:
            if not len(pdf):
                continue
            key = pdf[["shard", "unit", "kind"]].to_numpy()
            edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1), len(pdf)]
            for a, b in zip(edges, edges[1:]):
                part, unit = pdf.iloc[a:b], tuple(key[a, :2])
                if unit != now:
                    now, held, tree = unit, [], None
                if key[a, 2] == 0:
                    held.append((part["vec_id"].to_numpy(), rows_of(part["v"])))
                    continue
                if tree is None:
                    ids, x = (np.concatenate(c) for c in zip(*held))
                    held, tree = [], BallTree(x.astype(float), s.leaf_rows)
                for i in range(0, len(part), 1024):
                    ask = part.iloc[i:i + 1024]
                    found = search_shard(tree, ids, x, ask["vec_id"].to_numpy(), rows_of(ask["v"]), ask["kth"].to_numpy(), k)
                    yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    first = written(searched(queries.withColumn("kth", F.lit(LEAST).cast("long")), False))
    reached = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("m"), F.min("score").alias("least")).select(
        F.col("query_id").alias("vec_id"), F.when(F.col("m") >= k, F.col("least")).alias("least"))
    rest = queries.join(reached, "vec_id", "left").select(
        "vec_id", "v", F.coalesce("least", F.lit(LEAST).cast("long")).alias("kth"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (first.unionByName(searched(rest, True)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
