"""Pair parsing, top-K, used items and entity features (FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F

from entiscore.operators import behavior as B


def _pairs(spark, texts, lenient=False):
    df = spark.createDataFrame([("e1", t) for t in texts], "entity_id string, text string")
    return sorted((r.item_code, r.value) for r in B.parse_pairs(df, lenient=lenient).collect())


@pytest.mark.parametrize("text,expected", [
    ("a:", []),                       # no value
    ("a:5:", [("a", 5.0)]),           # trailing colon accepted
    ("a:5:6", []),                    # three parts
    (":5", []),                       # empty code dropped
    ("a:1  b:2", [("a", 1.0), ("b", 2.0)]),   # double space
    ("", []),
    (None, []),
    (" \ta:3\x01 ", [("a", 3.0)]),    # control characters trimmed like the JVM trim
    ("a:5::", [("a", 5.0)]),
    ("a:1:\t:", []),                 # a part of control characters only still counts
    ("a\t:1", [("a", 1.0)]),          # parts are trimmed
])
def test_parse_edge_cases(spark, text, expected):
    assert _pairs(spark, [text]) == expected


def test_bad_number_strict_fails_lenient_drops(spark):
    with pytest.raises(Exception):
        _pairs(spark, ["a:x b:1"])
    assert _pairs(spark, ["a:x b:1"], lenient=True) == [("b", 1.0)]


def test_malformed_report(spark):
    df = spark.createDataFrame([("e", "a: :5 a:1:2 b:x c:1")], "entity_id string, text string")
    got = {(r.token, r.status) for r in B.malformed_pairs(df).collect()}
    assert got == {("a:", "arity"), (":5", "empty_code"), ("a:1:2", "arity"), ("b:x", "bad_number")}


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id string, item_name string, installs long")


def test_top_k_total_order_on_ties(spark):
    items = _items(spark, [("1", "n1", 5), ("2", "n2", 5), ("3", "n3", 9), ("2", "n0", 5)])
    got = [(r.item_code, r.item_name) for r in B.top_k_items(items, 3, prefix="12").collect()]
    # installs desc, then code desc, then name desc
    assert got == [("123", "n3"), ("122", "n2"), ("122", "n0")]


def test_top_k_plan_is_take_ordered(spark):
    items = _items(spark, [("1", "a", 1)])
    plan = B.top_k_items(items, 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def _setup(spark):
    items = _items(spark, [("1", "one", 30), ("2", "two", 20), ("3", "three", 10), ("4", "four", 5)])
    beh = spark.createDataFrame([
        ("u1", "121:1 123:2"), ("u1", "123:7"), ("u2", "122:1"), ("u3", "129:1"), ("u4", "121:1 121:2")],
        "entity_id string, text string")
    return B.top_k_items(items, 3, "12"), B.parse_pairs(beh)


def test_used_items_and_features(spark):
    top, pairs = _setup(spark)
    used = {r.item_code: (r.dim_code, r.column_index) for r in B.used_items(top, pairs).collect()}
    # item 4 is not in the top 3; items 1..3 are all seen; index follows top-K order
    assert used == {"121": ("1", 0), "122": ("2", 1), "123": ("3", 2)}
    feats = {r.entity_id: r.features for r in B.user_item_features(pairs, B.used_items(top, pairs)).collect()}
    assert feats == {"u1": "0:1 2:1", "u2": "1:1", "u4": "0:1"}   # u3 used nothing in the top-K


def test_unseen_item_not_in_dimension(spark):
    items = _items(spark, [("1", "one", 30), ("2", "two", 20)])
    beh = spark.createDataFrame([("u1", "122:1")], "entity_id string, text string")
    used = B.used_items(B.top_k_items(items, 5, "12"), B.parse_pairs(beh)).collect()
    assert [(r.item_code, r.column_index) for r in used] == [("122", 0)]


def test_one_pass_build_matches_join_build(spark):
    top, pairs = _setup(spark)
    used1 = B.used_items(top, pairs)
    f1 = {tuple(r) for r in B.user_item_features(pairs, used1).collect()}
    used2, f2 = B.build_item_features(pairs, top)
    assert f1 == {tuple(r) for r in f2.select("entity_id", "features").collect()}
    assert {tuple(r) for r in used1.collect()} == {tuple(r) for r in used2.collect()}


def test_sum_mode(spark):
    top, pairs = _setup(spark)
    feats = {r.entity_id: r.features for r in B.user_item_features(pairs, B.used_items(top, pairs), "sum").collect()}
    assert feats["u1"] == "0:1.0 2:9.0"
    assert feats["u4"] == "0:3.0"


def test_hot_entity_is_exact_and_partially_aggregated(spark):
    """One entity holds a third of all rows: result exact, set aggregated map-side."""
    n = 3000
    rows = [("hot" if i % 3 == 0 else f"u{i}", f"12{i % 5}:1 12{(i + 1) % 5}:2") for i in range(n)]
    beh = spark.createDataFrame(rows, "entity_id string, text string").repartition(8)
    items = spark.createDataFrame([(str(i), f"n{i}", 100 - i) for i in range(5)],
                                  "item_id string, item_name string, installs long")
    top = B.top_k_items(items, 3, "12")
    pairs = B.parse_pairs(beh)
    used, feats = B.build_item_features(pairs, top)
    got = {r.entity_id: r.features for r in feats.select("entity_id", "features").collect()}
    assert got["hot"] == "0:1 1:1 2:1"
    assert len(got) == 1 + sum(1 for i in range(n) if i % 3 and (i % 5 < 3 or (i + 1) % 5 < 3))
    plan = B.entity_top_ranks(pairs, B.rank_items(top))._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_set" in plan


# ------------------------------------------------------------------ JVM-rule model

def _java_trim(s):
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 32:
        i += 1
    while j > i and ord(s[j - 1]) <= 32:
        j -= 1
    return s[i:j]


def _java_split(s, sep):
    if sep not in s:
        return [s]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _model_pairs(text):
    """The reference's parse, in plain Python; empty codes dropped (our ruling)."""
    out = []
    if text is None:
        return out
    for tok in _java_split(_java_trim(text), " "):
        parts = _java_split(_java_trim(tok), ":")
        if len(parts) != 2:
            continue
        code, val = _java_trim(parts[0]), _java_trim(parts[1])
        try:
            v = float(val)
        except ValueError:
            continue
        if code:
            out.append((code, v))
    return out


def test_parse_matches_jvm_rules_on_random_texts(spark):
    import random
    rnd = random.Random(20240101)
    alphabet = ["a", "b", "1", "2", ":", ":", " ", " ", "\t", "\x01", ".", "x"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(f"e{i}", t) for i, t in enumerate(texts)], "entity_id string, text string")
    got = sorted((r.entity_id, r.item_code, r.value) for r in B.parse_pairs(df, lenient=True).collect())
    want = sorted((f"e{i}", c, v) for i, t in enumerate(texts) for c, v in _model_pairs(t))
    assert got == want
