"""Approximate nearest neighbours: stable random projections indexed by a kd-tree.

Largest inner product is turned into smallest distance: with M the largest norm,
a vector x becomes (x, sqrt(M^2 - |x|^2)) and a query is scaled to norm M, so
``distance^2 = 2 M^2 - 2 <q, x> M / |q|``.  Gaussian projections to ``dims`` numbers
are 2-stable: projected distance^2 over distance^2 has a chi-square distribution
with ``dims`` degrees of freedom, whatever the data.

The projected points are indexed by a kd-tree.  Its top splits come from a bounded
sample (``sample`` vectors) and give at most ``sample / 16`` regions; every vector is
put into its region, and regions of more than ``cell_rows`` vectors are dealt into
cells by a hash of the id, so a cell is bounded however many copies there are.
Inside a cell the tree goes on to leaves of ``leaf_rows``.

A query walks the leaves of a cell from the nearest in projected distance and
verifies the vectors of each on the original vectors.  It stops before leaf L when

    P(chi-square(dims) <= dist(L)^2 / d_k^2) >= confidence

with d_k the distance of its k-th best so far: a vector nearer than d_k would have
been met by then with at least that probability.  First each query searches a cell
of its own region, which gives d_k; then only regions that pass the same test with
that d_k are searched.  A cell travels once for every ``query_rows`` queries that ask it.

Edge cases: vectors that are null, zero, or hold null or non-finite components, null
ids, and vectors whose length is not the most frequent one (the larger on a tie)
take no part; of rows sharing an id the smallest vector counts; ties go to the
smaller id; fewer candidates than ``k`` give fewer rows; an empty table gives no
rows; other columns are ignored.
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


@dataclass(frozen=True)
class Settings:
    dims: int = 8                 # even, for the closed form of the chi-square distribution
    confidence: float = 0.95
    sample: int = 16384
    cell_rows: int = 16384
    leaf_rows: int = 512
    query_rows: int = 4096
    seed: int = 5


def chi_square(x: float, dims: int) -> float:
    """P(chi-square with an even number of degrees of freedom <= x)."""
    term = total = 1.0
    for j in range(1, dims // 2):
        term *= x / 2 / j
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, dims: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, dims) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dims) < p else (low, mid)
    return high


@dataclass
class Tree:
    """Splits of the projected space: node i goes on to 2i + 1 (<= value) and 2i + 2."""
    axis: np.ndarray
    value: np.ndarray
    depth: int

    def region(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] > self.value[node])
        return node - (2**self.depth - 1)

    def boxes(self, dims: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper corners of the regions."""
        low, high = [np.full(dims, -np.inf)], [np.full(dims, np.inf)]
        for i in range(2**self.depth - 1):
            a, v = self.axis[i], self.value[i]
            for side in range(2):
                lo, hi = low[i].copy(), high[i].copy()
                (lo if side else hi)[a] = v
                low.append(lo)
                high.append(hi)
        first = 2**self.depth - 1
        return np.array(low[first:]), np.array(high[first:])


def fit_tree(points: np.ndarray, regions: int) -> Tree:
    """Median splits on the widest axis down to about ``regions`` regions of the sample."""
    depth = max(0, math.ceil(math.log2(max(1, min(regions, len(points) // 16)))))
    n = 2**depth - 1
    axis, value, own = np.zeros(n, np.int64), np.zeros(n), {0: points}
    for i in range(n):
        p = own.pop(i)
        axis[i] = np.argmax(np.ptp(p, axis=0)) if len(p) else 0
        value[i] = np.median(p[:, axis[i]]) if len(p) else 0.0
        right = p[:, axis[i]] > value[i]
        own[2 * i + 1], own[2 * i + 2] = p[~right], p[right]
    return Tree(axis, value, depth)


def leaves(points: np.ndarray, rows: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree with at most ``rows`` points each."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        at = todo.pop()
        if len(at) <= rows:
            out.append(at)
            continue
        p = points[at]
        order = np.argsort(p[:, np.argmax(np.ptp(p, axis=0))], kind="stable")
        todo += [at[order[:len(at) // 2]], at[order[len(at) // 2:]]]
    return out


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes, points x boxes."""
    out = np.zeros((len(q), len(low)))
    for d in range(q.shape[1]):
        x = q[:, d, None]
        out += np.maximum(np.maximum(low[None, :, d] - x, x - high[None, :, d]), 0)**2
    return out


class Space:
    """The projection for vectors of one length and largest norm ``top``."""

    def __init__(self, length: int, top: float, s: Settings):
        self.top, self.s = top, s
        self.matrix = np.random.default_rng(s.seed).standard_normal((length + 1, s.dims))
        self.quantile = chi_square_quantile(s.confidence, s.dims)

    def points(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.top**2 - (x**2).sum(1), 0))
        return x @ self.matrix[:-1] + rest[:, None] * self.matrix[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return (q * (self.top / np.linalg.norm(q, axis=1))[:, None]) @ self.matrix[:-1]

    def radius(self, q: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """Squared projected distance beyond which the stopping test holds, for k-th best scores."""
        d2 = 2 * self.top**2 - 2 * kth * self.top / np.linalg.norm(q, axis=1)
        return self.quantile * np.maximum(d2, 0) + 1e-9 * self.top**2


def search_cell(space: Space, ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray,
                kth: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, id, score) of up to ``k`` best of a cell for each query that may still enter its list."""
    points, at = space.points(x), space.queries(q)
    own = leaves(points, space.s.leaf_rows)
    distance = box_distance(at, np.array([points[i].min(0) for i in own]), np.array([points[i].max(0) for i in own]))
    order = np.argsort(distance, axis=1, kind="stable")
    # a matrix product is off the sum of a row by less than this, times both norms
    off = 4 * (q.shape[1] + 2) * np.finfo(float).eps
    long_q, long_x = np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)
    best = np.full((len(q), k), -np.inf)
    name = np.full((len(q), k), np.iinfo(np.int64).max)
    for r in range(len(own)):
        radius = space.radius(q, np.maximum(kth, best[:, -1]))
        go = np.flatnonzero(distance[np.arange(len(q)), order[:, r]] <= radius)
        if not len(go):
            break
        for leaf in np.unique(order[go, r]):
            who, members = go[order[go, r] == leaf], own[leaf]
            score = q[who] @ x[members].T
            score[qids[who, None] == ids[members][None, :]] = -np.inf
            slack = off * long_q[who, None] * long_x[members][None, :]
            least = np.maximum(best[who, -1], kth[who])
            may = np.maximum(least, np.partition(score - slack, -k, axis=1)[:, -k]) if len(members) > k else least
            better = (score + slack >= may[:, None]) & (score > -np.inf)
            one, other = np.nonzero(better)
            for i in range(0, len(one), 1 << 16):          # the same sum wherever a vector lies
                a, b = one[i:i + (1 << 16)], other[i:i + (1 << 16)]
                score[a, b] = (x[members[b]] * q[who[a]]).sum(1)
            better &= score >= least[:, None]
            has = better.any(1)
            who, score = who[has], np.where(better, score, -np.inf)[has]
            cols = better[has].any(0)
            score, members = score[:, cols], members[cols]
            s = np.concatenate([best[who], score], axis=1)
            n = np.concatenate([name[who], np.broadcast_to(ids[members], score.shape)], axis=1)
            top = np.lexsort((n, -s), axis=1)[:, :k]
            best[who], name[who] = (np.take_along_axis(a, top, 1) for a in (s, n))
    out = []
    for i in range(len(q)):
        hit = best[i] > -np.inf
        out += [(int(qids[i]), int(j), float(e)) for j, e in zip(name[i][hit], best[i][hit])]
    return out


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` (array of double) of the vectors that take part; one row an id."""
    v = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda c: c != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def nearest(vectors: DataFrame, is_query, k: int = 20, settings: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for each query row."""
    s, spark = settings, vectors.sparkSession
    every = written(valid_vectors(vectors))
    sizes = every.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.col("n").desc(), F.col("d").desc()).limit(1).collect()
    result = "query_id long, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    length, n = sizes[0]["d"], sizes[0]["n"]
    every = every.where(F.size("v") == length)
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    space = Space(length, math.sqrt(every.agg(F.max(square)).first()[0]), s)

    # the top of the tree, from a bounded sample picked by a hash of the id
    u = uniform(F.col("vec_id"), "tree")
    picked = every.where(u <= min(1.0, 2 * s.sample / n)).orderBy(u, "vec_id").limit(s.sample)
    tree = fit_tree(space.points(np.array([r["v"] for r in picked.select("v").collect()])), -(-n // s.cell_rows))
    low, high = tree.boxes(s.dims)

    @F.pandas_udf("int")
    def region(v: pd.Series) -> pd.Series:
        return pd.Series(tree.region(space.points(np.stack(v.to_list())))).astype("int32")

    @F.pandas_udf("int")
    def query_region(v: pd.Series) -> pd.Series:
        return pd.Series(tree.region(space.queries(np.stack(v.to_list())))).astype("int32")

    placed = written(every.withColumn("region", region("v")))
    counts = placed.groupBy("region").agg(F.count(F.lit(1)).alias("m"))
    cells = F.broadcast(counts.select("region", F.ceil(F.col("m") / s.cell_rows).cast("int").alias("cells")))  # <= sample / 16 rows
    placed = placed.join(cells, "region").select(
        "vec_id", "v", "region", F.pmod(F.xxhash64("vec_id"), F.col("cells")).cast("int").alias("cell"))
    queries = written(every.where(is_query))

    def search(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(p) and len(q):
            found = search_cell(space, p["vec_id"].to_numpy(), np.stack(p["v"].to_list()), q["q_vec_id"].to_numpy(),
                                np.stack(q["q_v"].to_list()), q["q_kth"].to_numpy(), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    key = ["region", "cell", "block"]

    def searched(asked: DataFrame) -> DataFrame:
        # a cell nobody asks does not travel; one that more than query_rows queries ask, once for each so many
        blocks = asked.groupBy("region", "cell").agg(F.ceil(F.count(F.lit(1)) / s.query_rows).cast("int").alias("blocks"))
        own = asked.join(blocks, ["region", "cell"]).withColumn(
            "block", F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.col("blocks")).cast("int"))
        own = own.select(*[F.col(c).alias(f"q_{c}") for c in ("vec_id", "v", "kth", *key)])
        points = placed.join(blocks, ["region", "cell"]).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        return points.groupBy(*key).cogroup(own.groupBy(*[f"q_{c}" for c in key])).applyInPandas(search, result)

    # a cell of the query's own region first
    none = F.lit(float("-inf")).alias("kth")
    home = queries.select("vec_id", "v", query_region("v").alias("region"), none)
    home = home.join(cells, "region").withColumn(
        "cell", F.pmod(F.xxhash64("vec_id"), F.col("cells")).cast("int")).drop("cells")
    first = written(searched(home))
    kth = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("m"), F.min("score").alias("least")).select(
        F.col("query_id").alias("vec_id"), F.when(F.col("m") >= k, F.col("least")).alias("least"))
    asked = queries.join(kth, "vec_id", "left").select(
        "vec_id", "v", F.coalesce("least", F.lit(float("-inf"))).alias("kth"))

    def regions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                q = np.stack(pdf["v"].to_list())
                near = box_distance(space.queries(q), low, high) <= space.radius(q, pdf["kth"].to_numpy())[:, None]
                yield pdf.assign(regions=[np.flatnonzero(r).astype(np.int32) for r in near])

    then = (asked.mapInPandas(regions, "vec_id long, v array<double>, kth double, regions array<int>")
            .select("vec_id", "v", "kth", F.explode("regions").alias("region")).join(cells, "region")
            .withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).drop("cells")
            .join(home.select("vec_id", "region", "cell"), ["vec_id", "region", "cell"], "left_anti"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (first.unionByName(searched(then)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
