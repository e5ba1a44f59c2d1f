import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from entiscore.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_query, k):
    ok = {}
    for i, v, _ in rows:
        if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            if i not in ok or tuple(x) < tuple(ok[i]):
                ok[i] = x
    out = {}
    for q in filter(is_query, ok):
        s = sorted(((-(x * ok[q]).sum(), i) for i, x in ok.items() if i != q))[:k]
        out[q] = [(i, -d) for d, i in s]
    return out


def grouped(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_small_exact_with_bad_vectors_ties_and_repeats(spark):
    r = np.random.default_rng(0)
    rows = [(i, r.normal(0, 1 + i % 3, 6).round(1).tolist(), 0) for i in range(60)]
    rows += [(100, None, 1), (101, [0.0] * 6, 1), (102, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (103, [float("nan")] * 6, 1),
             (104, [float("inf")] + [0.0] * 5, 1), (None, [1.0] * 6, 1), (105, [], 1), (20, rows[20][1], 1)]
    rows += [(200 + i, rows[3][1], 1) for i in range(30)]                # copies: ties by id
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", F.lit("mine")).withColumn("region", F.lit(1)).repartition(4)
    got = grouped(ann.nearest(df, F.col("vec_id") % 20 == 0, k=7, settings=ann.Settings(confidence=0.999999)))
    want = brute(rows, lambda i: i % 20 == 0, 7)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], rel=1e-12)


@pytest.mark.parametrize("settings", [ann.Settings(), ann.Settings(cell_rows=150, leaf_rows=32, query_rows=20, sample=256)])
def test_recall_over_cells_and_blocks(spark, settings):
    r = np.random.default_rng(1)
    centres = r.normal(0, 1, (8, 24))
    rows = [(i, (centres[i % 8] + r.normal(0, 0.4, 24)).tolist(), 0) for i in range(1500)]
    rows += [(2000 + i, centres[0].tolist(), 0) for i in range(700)]     # one vector, a third of the rows
    df = spark.createDataFrame(rows, SCHEMA)
    got = grouped(ann.nearest(df, F.col("vec_id") % 20 == 0, k=20, settings=settings))
    want = brute(rows, lambda i: i % 20 == 0, 20)
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert all(len(got[q]) == 20 for q in want) and hit / (20 * len(want)) >= 0.95


@pytest.mark.parametrize("huge", [False, True])
def test_ties_over_several_cells_go_to_the_smallest_ids(spark, huge):
    """Copies that top the lists lie over several cells of a region."""
    r = np.random.default_rng(4)
    unit = lambda v: (v / np.linalg.norm(v)).tolist()
    top = r.normal(0, 1, 24)
    rows = [(i, unit(top + r.normal(0, 0.5, 24)), 0) for i in range(300)] + [(300 + i, unit(top), 0) for i in range(400)]
    if huge:
        rows.append((999, (-1e6 * top).tolist(), 0))
    df = spark.createDataFrame(rows, SCHEMA.replace("float", "double"))
    small = ann.Settings(cell_rows=50, leaf_rows=16, query_rows=200, sample=16, confidence=1 - 1e-12)
    got = grouped(ann.nearest(df, F.col("vec_id") % 3 == 0, k=20, settings=small))
    exact = {i: np.array(v) for i, v, _ in rows}
    for q in got:
        want = sorted((i for i in exact if i != q), key=lambda i: (-(exact[i] * exact[q]).sum(), i))[:20]
        assert [i for i, _ in got[q]] == want


def test_fewer_candidates_and_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 0), (1, [2.0, 1.0], 0), (20, [0.5, 0.5], 0), (3, [1.0, 2.0, 3.0], 0)], SCHEMA)
    got = grouped(ann.nearest(df, F.col("vec_id") % 20 == 0, k=20))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [1, 20], 20: [0, 1]}
    assert ann.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_chi_square_and_tree():
    assert ann.chi_square(ann.chi_square_quantile(0.95, 8), 8) == pytest.approx(0.95)
    assert ann.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)     # fixed value of the distribution
    points = np.random.default_rng(3).normal(0, 1, (2000, 4))
    tree = ann.fit_tree(points, 16)
    region = tree.region(points)
    low, high = tree.boxes(4)
    assert len(low) == 16 and set(region) == set(range(16))
    assert ((points >= low[region]) & (points <= high[region])).all()
    own = ann.leaves(points, 100)
    assert sorted(np.concatenate(own)) == list(range(2000)) and max(map(len, own)) <= 100
