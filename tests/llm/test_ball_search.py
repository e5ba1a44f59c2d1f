import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from entiscore.llm import ball_search as B

SMALL = B.Settings(sample=256, shard_rows=32, leaf_rows=4, query_rows=8)


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)


def brute(rows, is_query, k, scale=256):
    own = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [max(-2**63, min(2**63 - 1, math.floor(x * scale))) if abs(x * scale) < 1e300 else (2**63 - 1 if x > 0 else -2**63) for x in v]
        own[i] = min(own.get(i, w), w)
    if not own:
        return set()
    sizes = [len(v) for v in own.values()]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    own = {i: v for i, v in own.items() if len(v) == size}
    out = set()
    for q in own:
        if is_query(q):
            found = sorted((-max(-2**63 + 1, min(2**63 - 1, sum(a * b for a, b in zip(own[q], v)))), i) for i, v in own.items() if i != q)[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found)}
    return out


def found(df):
    rows = [tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("settings", [B.Settings(), SMALL])
def test_equals_brute_force_on_clusters_and_copies(spark, settings):
    r = np.random.default_rng(2)
    middle = r.normal(size=(12, 8))
    rows = [(i, (middle[i % 12] * (i % 7 + 1) + 0.05 * r.normal(size=8)).tolist()) for i in range(900)]
    rows += [(i, rows[3][1]) for i in range(2000, 2400)]              # a third of all rows are one vector
    rows += [(5000, [0.0] * 8), (5010, [0.0] * 8), (5001, None), (5002, [math.nan] + [0.0] * 7), (None, [1.0] * 8),
             (5003, [None] + [1.0] * 7), (5004, [math.inf] * 8), (5005, [1.0, 2.0]), (7, rows[8][1]), (7, rows[8][1])]
    got = found(B.top_k(frame(spark, rows).withColumn("shard", F.lit("x")), F.col("vec_id") % 10 == 0, 5, settings))
    assert got == brute(rows, lambda q: q % 10 == 0, 5)


def test_more_queries_than_a_unit_takes_and_every_row_asks(spark):
    r = random.Random(4)
    rows = [(i, [r.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(300)]      # ties everywhere
    got = found(B.top_k(frame(spark, rows), F.lit(True), 7, SMALL))
    assert got == brute(rows, lambda q: True, 7)


def test_very_large_components_stay_exact(spark):
    r = random.Random(6)
    for top in (2.0**22, 2.0**40, 1e300):
        rows = [(i, [r.uniform(-top, top) for _ in range(5)]) for i in range(60)]
        assert found(B.top_k(frame(spark, rows), F.col("vec_id") % 4 == 0, 5, SMALL)) == brute(rows, lambda q: q % 4 == 0, 5)


def test_few_candidates_and_empty_table(spark):
    assert found(B.top_k(frame(spark, [(0, [1.0]), (1, [2.0])]), F.lit(True), 5)) == {(0, 1, 1, 131072), (1, 1, 0, 131072)}
    assert found(B.top_k(frame(spark, [(0, [1.0])]), F.lit(True), 5)) == set()
    assert B.top_k(frame(spark, [(1, None)]), F.lit(True), 5).count() == 0
    assert B.top_k(frame(spark, []), F.lit(True), 5).count() == 0
    assert found(B.top_k(frame(spark, [(0, []), (1, [])]), F.lit(True), 5)) == {(0, 1, 1, 0), (1, 1, 0, 0)}


def test_tree_cuts_most_leaves_of_clustered_vectors():
    r = np.random.default_rng(1)
    middle = r.normal(size=(64, 16)) * 2000
    x = np.concatenate([np.round(m + r.normal(size=(64, 16)) * 10) for m in middle]).astype(np.int64)
    tree = B.BallTree(x.astype(float), 64)
    q = x[::50]
    score = np.sort(B.products(q, x), axis=1)[:, -6]
    open_ = tree.open_leaves(q.astype(float), score.astype(float)) > -np.inf
    assert open_.mean() < 0.2
