from collections import defaultdict

import pytest

from entiscore.llm.mixing import emit_copies, mix_sources, source_targets


def fill(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by repeated resharing of the excess."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while open_ and left > 1e-9:
        total, spare = sum(w[s] for s in open_), left
        left = 0.0
        for s in list(open_):
            target[s] += spare * w[s] / total
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 500, "c": 3, "d": 70, None: 41}, {"x": 7}, {"a": 0, "b": 9},
    {"é": 5, "z": 50, "Z": 500, "": 1}, {"a": 0, "b": 0}])
def test_targets_match_resharing(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    got = {r["source"]: r["target"] for r in source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert got == pytest.approx(fill(sizes))


def test_mix_follows_targets_and_reruns_agree(spark, make_docs):
    rows = [(i, " ".join(["w"] * (1 + i % 37)), None, f"s{i % 5}" if i % 3 else "hot") for i in range(900)]
    rows += [(1000 + i, "w w", None, None) for i in range(40)] + [(None, "w", None, "s1"), (7, "w w", None, "s1"),
                                                                 (7, "w w", None, "s1"), (2000, None, None, "s1"),
                                                                 (2001, "", None, "s2")]
    a = mix_sources(make_docs(rows, parts=3, copies="mine", _cell=1)).collect()
    b = mix_sources(make_docs(rows, parts=7, copies="mine", _cell=1)).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["copies"], str(r["source"]))
    assert sorted(map(key, a)) == sorted(map(key, b)) and len(a) == len(rows)
    taken, target = defaultdict(int), {}
    for r in a:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(40, 0.05 * t), (s, taken[s], t)


def test_emitted_copies_and_empty_table(spark, make_docs):
    docs = make_docs([(i, "a b c", None, "s") for i in range(10)])
    mixed = mix_sources(docs)
    out = emit_copies(mixed, docs.columns)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in mixed.collect()) == 15
    assert mix_sources(make_docs([])).count() == 0
    narrow = mix_sources(docs, carry=["doc_id"])
    assert sorted(r["copies"] for r in narrow.collect()) == sorted(r["copies"] for r in mixed.collect())
