import random

import numpy as np
import pandas as pd
import pytest

from entiscore.llm import jaccard as J
from entiscore.llm.components import connected_components


def brute(rows, s):
    """(doc_id, size, component) of every row by comparing all pairs."""
    order = lambda i: float("inf") if i is None else i
    sets = []
    for _, t in rows:
        w = J.shingle_set(t, s.shingle)
        sets.append(frozenset(w.tolist()))
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and s.den * len(sets[a] & sets[b]) >= s.num * len(sets[a] | sets[b]):
                part[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        least[find(a)] = min(least.get(find(a), float("inf")), order(i))
    out = []
    for a, (i, _) in enumerate(rows):
        c = least[find(a)] if sets[a] else order(i)
        out.append((i, len(sets[a]), None if c == float("inf") else c))
    return sorted(out, key=repr)


def near_copies(prose, seed=0, n=110):
    r = random.Random(seed)
    stems = [prose(5000 + k, r.choice((6, 9, 14, 31, 32, 33, 64, 120, 130))) for k in range(12)]
    rows = []
    for i in range(n):
        ws = list(r.choice(stems)) if i % 4 else prose(i, r.randrange(0, 60))
        for _ in range(r.choice((0, 0, 1, 1, 2, 3))):
            if ws:
                at = r.randrange(len(ws))
                r.choice((lambda: ws.pop(at), lambda: ws.insert(at, "neu"), lambda: ws.append("end")))()
        rows.append((i, " ".join(ws)))
    return rows


EDGES = [(500, None), (501, ""), (502, "  \n"), (503, "one two"), (504, "ONE  two"), (505, "one"), (506, "one two three four"),
         (None, "one two"), (503, "one two"), (507, "É é A"), (508, "É é a"), (509, "é é a"), (None, None), (503, "other text here now")]


@pytest.mark.parametrize("settings", [J.Settings(), J.Settings(shingle=5, num=80, den=100),
                                      J.Settings(shingle=1, num=60, den=100, chunk=4, unit_rows=20, leaf=2),
                                      J.Settings(shingle=2, num=85, den=100, chunk=3, groups=8)])
def test_against_all_pairs(spark, make_docs, prose, settings):
    rows = near_copies(prose) + EDGES
    got = J.jaccard_classes(make_docs(rows, c=1, n="x", key="k"), settings).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == brute(rows, settings)


def test_large_group_of_near_copies_without_a_common_centre(spark, make_docs, prose):
    """A chain: each text is linked with its neighbours only, most pairs are not."""
    words = prose(9, 400)
    rows = [(i, " ".join(words[i:i + 120])) for i in range(0, 240, 3)] + [(1000 + i, " ".join(prose(20, 40))) for i in range(50)]
    s = J.Settings(shingle=1, num=85, den=100, chunk=16)
    got = J.jaccard_classes(make_docs(rows), s).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == brute(rows, s)


def test_linked_sets_share_a_cell():
    r = np.random.default_rng(4)
    for s in (J.Settings(), J.Settings(num=80), J.Settings(num=50)):
        for n in (*range(1, 40), 63, 64, 65, 200, 1000):
            a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
            for _ in range(6):
                drop = r.integers(0, n + 1)
                b = np.unique(np.concatenate([a[r.permutation(n)[drop:]], r.integers(0, 2**63, r.integers(0, n + 1)).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if s.den * both >= s.num * (len(a) + len(b) - both) and len(a) != both | len(b) != both:
                    if not np.array_equal(a, b):
                        assert set(J.cells(a, s).tolist()) & set(J.cells(b, s).tolist()), (n, len(b), both)


def test_group_counts_bound_the_overlap():
    r = np.random.default_rng(6)
    s = J.Settings()
    for n, m in ((3, 5), (500, 700), (1000, 1100), (5000, 1200), (40_000, 39_000)):
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[:min(n, m) // 2], r.integers(0, 2**63, m).astype(np.uint64)]))
        x, y = J.group_counts(a, s), J.group_counts(b, s)
        assert x.sum() == len(a) and np.array_equal(J.folded(x, 64), np.bincount(a % np.uint64(64), minlength=64))
        most = J.most_overlap(x.tobytes(), y.tobytes())
        assert len(np.intersect1d(a, b)) <= most <= min(len(a), len(b))
        assert J.most_overlap(x.tobytes(), x.tobytes()) == len(a)


def test_tree_pairs_equal_the_bound_on_all_pairs():
    r = np.random.default_rng(5)
    s = J.Settings(leaf=3)
    points = r.integers(0, 4, (80, 64)).astype(np.int32)
    points[40:60] = points[:20]
    points[40:60, 0] += 1
    n, part = points.sum(1), np.arange(80) // 2
    at = np.arange(80)
    got = {(min(p), max(p)) for p in J.tree_pairs(n, points, part, at, at, s)}
    want = {(a, b) for a in at for b in at[a + 1:] if part[a] != part[b]
            and J.may_link(np.minimum(points[a], points[b]).sum(), n[a], n[b], s)}
    assert got == want and len(got) >= 20


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (-4, -3)] + [(k, k + 1) for k in range(100, 160)]
    got = {r["v"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got[3] == 1 and got[9] == 5 and got[-3] == -4 and got[160] == 100 and len(got) == 10 + 61
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one(spark, make_docs, prose):
    rows = near_copies(prose, 1, 60) + EDGES
    docs = make_docs(rows, _id="mine", part=3)
    out = J.keep_one(docs).collect()
    s = J.Settings(shingle=5, num=80, den=100)
    first = {c for _, n, c in brute(rows, s) if n}
    kept = [r for r in out if J.shingle_set(r["text"], 5).size]
    # 503 heads two classes: its two texts have nothing in common
    assert {r["doc_id"] for r in kept} == first and len(kept) == len(first) + 1
    empty = sorted(((r["doc_id"], r["text"]) for r in out if not J.shingle_set(r["text"], 5).size), key=repr)
    assert empty == sorted([(i, t) for i, t in rows if not J.shingle_set(t, 5).size], key=repr)
    assert all(r["_id"] == "mine" and r["part"] == 3 for r in out)
    assert J.keep_one(make_docs([])).count() == 0 and J.jaccard_classes(make_docs([])).count() == 0


def test_keep_one_keeps_every_row_without_words(make_docs):
    rows = [(None, None, "en", "a"), (None, "", "de", "b"), (None, "", "de", "c"), (None, " \t\x0b", "en", "d"), (4, "", "en", "a"),
            (4, "", "fr", "a"), (None, "one two", "en", "a"), (None, "one two", "de", "b")]
    out = J.keep_one(make_docs(rows)).collect()
    assert sorted(((r["doc_id"], r["text"], r["lang"], r["source"]) for r in out), key=repr) == sorted(rows[:6] + [rows[7]], key=repr)


@pytest.mark.parametrize("settings", [J.Settings(), J.Settings(shingle=1, num=60, den=100, chunk=4, unit_rows=20, leaf=2)])
def test_every_link_is_found(make_docs, prose, settings):
    rows = near_copies(prose, 3, 90) + EDGES
    sets = [frozenset(J.shingle_set(t, settings.shingle).tolist()) for _, t in rows]

    def linked(a, b):
        return bool(a and b) and settings.den * len(a & b) >= settings.num * len(a | b)

    pairs, membership = J.linked_pairs(make_docs(rows, n="x", c=1), settings)
    got = {(frozenset((r["a"], r["b"])), frozenset((r["n_a"], r["n_b"]))) for r in pairs.collect()}
    assert pairs.count() == len(got)
    name = lambda s: J.set_class(np.array(sorted(s), np.uint64))
    distinct = list(set(sets))
    assert got == {(frozenset((name(a), name(b))), frozenset((len(a), len(b)))) for i, a in enumerate(distinct)
                   for b in distinct[:i] if linked(a, b)}
    assert len(got) > 20
    assert sorted(((r["doc_id"], r["class"], r["n_shingles"]) for r in membership.collect()), key=repr) == sorted(
        ((i, name(s) if s else None, len(s)) for (i, _), s in zip(rows, sets)), key=repr)
    counts = J.link_counts(make_docs(rows), settings).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["n_links"]) for r in counts), key=repr) == sorted(
        ((i, len(s), sum(linked(s, t) for k, t in enumerate(sets) if k != j)) for j, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)
    assert J.link_counts(make_docs([])).count() == 0


def test_near_copies_are_searched_in_one_cell_and_sent_once_a_block(make_docs, prose, monkeypatch):
    """Near copies share a hundred cells, and each of their pairs was found in every one of them."""
    stem = prose(77, 700)
    rows = [(i, " ".join([*stem[:7 * i], "neu", *stem[7 * i + 1:]])) for i in range(60)]
    units, verified, local = [], J._verified_blocks, J.Settings()

    def counted(found, sets, s):
        units.append(found.count())
        return verified(found, sets, s)

    monkeypatch.setattr(J, "_verified_blocks", counted)
    pairs, _ = J.linked_pairs(make_docs(rows), local)
    assert pairs.count() == 60 * 59 // 2 and units == [60 * 59 // 2]
    assert {r["n_links"] for r in J.link_counts(make_docs(rows), local).collect()} == {59}

    sets = [J.shingle_set(t, 4) for _, t in rows]
    keys = [J.cells(x, local) for x in sets]
    held = {}
    for i, own in enumerate(keys):
        for k in own.tolist():
            held.setdefault(k, []).append(i)
    order = {k: (len(v), k) for k, v in held.items()}
    homes = [sorted((order[k] for k in own.tolist()), reverse=True)[:local.homes] for own in keys]
    found = []
    for k, v in held.items():
        if len(v) > 1:
            found.append(len(J.unit_pairs(pd.DataFrame({
                "key": k, "i": 0, "j": 0, "chunk": 0, "c": v, "part": v, "block": 0, "n": [len(sets[i]) for i in v],
                "counts": [J.group_counts(sets[i], local).tobytes() for i in v],
                "earlier": [np.array([h[1] for h in homes[i] if h > order[k]], np.int64) for i in v]}), local)))
    assert len(found) > 40 and 60 * 59 // 2 <= sum(found) < 1.2 * 60 * 59 // 2      # 64 times as many before


def test_common_sizes_and_finer_bound():
    r = np.random.default_rng(8)
    sets = [np.unique(r.integers(0, 3 * k, k).astype(np.uint64)) for k in (1, 5, 40, 900, 1100, 3000, 9000) for _ in range(4)]
    x, y = map(np.ravel, np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    assert J.common_sizes(sets, x, y).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(x, y)]
    assert J.common_sizes(sets, x[:0], y[:0]).tolist() == []
    s, n, counts = J.Settings(), np.array([len(v) for v in sets]), [J.group_counts(v, J.Settings()) for v in sets]
    assert J.finer_bound(counts, n, x, y, s).tolist() == [
        bool(J.may_link(J.most_overlap(counts[a].tobytes(), counts[b].tobytes()), n[a], n[b], s)) for a, b in zip(x, y)]
