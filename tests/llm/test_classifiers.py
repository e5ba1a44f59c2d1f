import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from entiscore.llm import labelled, langid, quality, toxicity

ALPHABETS = {"xx": ("ba", "ke", "lo", "mi"), "yy": ("tsch", "ung", "ver", "ei"), "zz": ("ción", "ñar", "que", "los")}


@pytest.fixture(scope="module")
def spoken(make_docs, prose):
    rows = [(i, " ".join(prose(i, 20 + i % 60, ALPHABETS[k])), k, "s")
            for i, k in enumerate(k for _ in range(60) for k in ALPHABETS)]
    return rows


SMALL = langid.Settings(landmarks=24, per_language=40)


def test_language_held_out_accuracy_and_edges(spark, make_docs, spoken):
    more = [(900, None, "xx"), (901, "", "xx"), (902, "12 !? \n", "yy"), (903, spoken[0][1], None), (None, spoken[1][1], None),
            (5, spoken[5][1], "xx"), (904, " ".join([spoken[2][1]] * 400), None)]
    docs = make_docs(spoken + more, score="mine", lang_pred=1)
    model = langid.train(make_docs(spoken), SMALL)
    assert model.languages == ["xx", "yy", "zz"]
    got = langid.identify(docs, model).collect()
    assert len(got) == len(spoken) + len(more) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (900, 901, 902))
    assert by[903]["lang_pred"] == "xx" and by[None]["lang_pred"] == "yy" and by[904]["lang_pred"] == "zz"
    fresh = make_docs([(i, t, k) for i, t, k, _ in spoken if i % 2])
    right = [r["lang"] == r["lang_pred"] for r in langid.identify(fresh, langid.train(
        make_docs([x for x in spoken if x[0] % 2 == 0]), SMALL)).collect()]
    assert np.mean(right) == 1


def test_language_scores_are_the_kernel_ridge_formula(spoken):
    texts, langs = [r[1] for r in spoken], [r[2] for r in spoken]
    m = langid.fit(texts, langs, SMALL)
    text = texts[7]
    codes = langid.letter_codes(text)
    grams = langid.presence(codes, np.array([0, len(codes)]), SMALL.bins)[0]
    k = grams @ m.landmarks / np.sqrt(grams.sum() * m.sizes)
    margin = k @ m.weights
    share = np.exp(4 * (margin - margin.max()))
    got = langid.score(pd.Series([text]), m).iloc[0]
    assert got["lang_pred"] == m.languages[margin.argmax()]
    assert got["score"] == pytest.approx((share / share.sum()).max(), rel=1e-4)


def test_language_nothing_to_learn_and_empty_table(spark, make_docs):
    model = langid.train(make_docs([(1, "abc", None)]))
    assert [r["lang_pred"] for r in langid.identify(make_docs([(1, "abc")]), model).collect()] == ["und"]
    assert langid.identify(make_docs([]), model).count() == 0


def label_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_sample_leaves_out_held_out_and_conflicts(spark, make_docs):
    import zlib
    labels = [(i, 1, i % 2) for i in range(200)] + [(0, 1, 1), (1, None, None), (None, 1, 1)]
    known = labelled.known_labels(label_rows(spark, labels), "toxic").collect()
    ids = {r["_id"] for r in known}
    assert ids == {i for i in range(1, 200) if zlib.crc32(str(i).encode()) % 4 != 2}
    docs = make_docs([(i, f"text {i}") for i in range(200)])
    rows, share = labelled.labelled_sample(docs, label_rows(spark, labels), "toxic", 20, "t")
    got = rows.collect()
    assert 0.4 < share < 0.6 and 20 <= len(got) <= 40


def test_machine_learns_pairs_a_linear_model_cannot():
    """Label 1 only for texts with exactly one of two terms (their weights cancel)."""
    r = np.random.default_rng(0)
    x = r.integers(0, 2, (800, 12)).astype(np.uint8)
    y = (x[:, 0] ^ x[:, 1]).astype(float)
    s = toxicity.Settings(steps=2000, batch=64, decay=1e-4)
    bias, w, v = toxicity.fit_machine(x, y, y.mean(), s)
    xv = x @ v
    z = bias + x @ w + 0.5 * ((xv**2).sum(1) - x @ (v**2).sum(1))
    assert ((z > 0) == (y > 0)).mean() > 0.95


def test_machine_score_equals_the_pair_sum(prose):
    r = np.random.default_rng(1)
    words = prose(4, 30)
    terms = np.array(sorted({t for w in words for t in toxicity.word_terms(w, 20)}), np.int64)
    m = toxicity.Model(toxicity.Settings(), 0.2, terms, r.normal(0, 0.2, len(terms)), r.normal(0, 0.2, (len(terms), 8)))
    text = " ".join(words[:9]).title()
    at = [int(np.flatnonzero(terms == t)[0]) for t in toxicity.text_terms(text, 20)]
    z = 0.2 + m.weights[at].sum() + sum(m.vectors[a] @ m.vectors[b] for k, a in enumerate(at) for b in at[:k])
    got = toxicity.score_texts(pd.Series([text, None, ""]), m)
    assert got[0] == pytest.approx(1 / (1 + np.exp(-z))) and got[1] == got[2] == pytest.approx(1 / (1 + np.exp(-0.2)))


@pytest.fixture(scope="module")
def rated(spark, make_docs, prose):
    """Toxic: an insult; low quality: repeated or decorated words."""
    rows, labels = [], []
    for i in range(400):
        ws = prose(i, 30 + i % 50)
        toxic, low = i % 5 == 0, i % 4 == 1
        if toxic:
            ws.insert(i % len(ws), ("idiot", "Moron,", "SCUM")[i % 3])
        if low:
            ws = [w + "***" for w in ws] if i % 8 == 1 else [w for w in ws for _ in range(6)]
        rows.append((i, " ".join(ws)))
        labels.append((i, int(not low), int(toxic)))
    return make_docs(rows), label_rows(spark, labels), {x[0]: x for x in labels}


@pytest.mark.parametrize("module, label, at, place", [(toxicity, "toxic", 0.3, 2), (quality, "quality", 0.7, 1)])
def test_held_out_accuracy(spark, rated, module, label, at, place):
    docs, labels, truth = rated
    model = module.train(docs, labels, label)
    out = module.score_documents(docs, model).select("doc_id", "score", labelled.held_out(F.col("doc_id")).alias("h")).collect()
    held = [r for r in out if r["h"]]
    assert len(held) > 60 and all(0 <= r["score"] <= 1 for r in out)
    assert np.mean([(r["score"] >= at) == (truth[r["doc_id"]][place] == 1) for r in held]) >= 0.95
    again = module.score_documents(docs, module.train(docs.repartition(5), labels.repartition(2), label)).collect()
    assert {r["doc_id"]: round(r["score"], 9) for r in again} == {r["doc_id"]: round(r["score"], 9) for r in out}


@pytest.mark.parametrize("module", [toxicity, quality])
def test_edges(spark, make_docs, module):
    docs = make_docs([(1, None), (2, ""), (None, "a b"), (3, "word " * 20_000), (3, "word " * 20_000)], score="mine")
    model = module.train(docs, label_rows(spark, [(3, 1, 1)]))           # one class only
    got = module.score_documents(docs, model).collect()
    assert len(got) == 5 and len({r["score"] for r in got}) == 1
    model = module.train(docs, label_rows(spark, []))
    assert module.score_documents(docs, model).count() == 5
    assert module.score_documents(make_docs([]), model).count() == 0


def test_shapes_and_dual_descent():
    assert quality.shape("Hello,") == "Xx," and quality.shape("AB12!!") == "X9!"
    r = np.random.default_rng(2)
    x = [(np.arange(3), v) for v in r.normal(0, 1, (300, 3))]
    y = np.where([v[0] - 2 * v[1] + 0.3 > 0 for _, v in x], 1.0, -1.0)
    w = quality.dual_descent(x, y, 3, quality.Settings(passes=100))
    assert np.mean([np.sign(w[:3] @ v + w[3]) == k for (_, v), k in zip(x, y)]) > 0.97


def test_trained_machine_scores_pairs_of_terms_neutral_alone(spark, make_docs, prose):
    """Toxic are texts with exactly one of two words, each as common in clean as in toxic texts."""
    rows, truth = [], {}
    for i in range(1000):
        ws, a, b = prose(i, 30 + i % 50), i // 2 % 2, i % 2
        ws[i % len(ws):i % len(ws)] = ["gelb"] * a
        ws[7 * i % len(ws):7 * i % len(ws)] = ["hut"] * b
        rows.append((i, " ".join(ws)))
        truth[i] = a ^ b
    docs = make_docs(rows)
    model = toxicity.train(docs, label_rows(spark, [(i, 1, y) for i, y in truth.items()]))
    held = toxicity.score_documents(docs, model).where(labelled.held_out(F.col("doc_id"))).collect()
    assert len(held) > 150
    assert np.mean([(r["score"] >= 0.5) == (truth[r["doc_id"]] == 1) for r in held]) >= 0.95


def test_rare_language_keeps_its_sample(spark, make_docs, prose):
    stems = {**ALPHABETS, "ww": ("ghar", "jhu", "bho", "khe")}
    rows = [(i, " ".join(prose(i, 20, stems[k])), k) for i, k in enumerate(k for _ in range(300) for k in stems)]
    rows += [(5000 + i, " ".join(prose(5000 + i, 20, ("ngwa", "mbe", "nzo"))), "rare") for i in range(40)]
    s = langid.Settings(landmarks=24, per_language=30)
    _, langs = langid.training_sample(make_docs(rows), s)
    assert min(langs.count(k) for k in (*stems, "rare")) >= 15 and max(langs.count(k) for k in stems) <= 30
    fresh = make_docs([(i, " ".join(prose(9000 + i, 20, ("ngwa", "mbe", "nzo"))), None) for i in range(20)])
    got = langid.identify(fresh, langid.train(make_docs(rows), s)).collect()
    assert {r["lang_pred"] for r in got} == {"rare"}


def test_quality_tells_very_long_texts_apart(spark, rated):
    """100,000 different words, most of them unknown: only n-grams that were learned count."""
    docs, labels, _ = rated
    model = quality.train(docs, labels)
    r = np.random.default_rng(5)
    good = ["".join(w) for w in r.choice(list("abcdefghijklmnopqrstuvwxyz"), (100_000, 7))]
    low = [w + "***" for w in good]
    words, look = quality._Words(), quality.Keys(model.keys)
    for n in (60, 100_000):
        got = quality.score_texts(pd.Series([" ".join(good[:n]), " ".join(low[:n])]), model, words, look)
        assert got[0] >= 0.7 > got[1] and got[0] - got[1] > 0.3


def test_quality_keys_are_found_whole():
    r = np.random.default_rng(3)
    keys = np.sort(r.integers(0, 1 << 64, 500, np.uint64, endpoint=False))
    grams = np.concatenate([keys[::3], keys[:50], keys + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
    want = [i for i, k in enumerate(keys.tolist()) if k in set(grams.tolist())]
    assert quality.Keys(keys).found(grams).tolist() == want
    assert quality.Keys(keys[:0]).found(grams).tolist() == [] and quality.Keys(keys).found(grams[:0]).tolist() == []


def test_quality_sample_stops_at_its_ngrams_in_each_class(spark):
    rows = spark.createDataFrame([(i, i % 2, list(range(10 + i % 3))) for i in range(40)], "_id long, _y int, g array<long>")
    size = {i: 10 + i % 3 for i in range(40)}
    for most in (1, 100, 10_000):
        kept = [r["_id"] for r in quality.within(rows, most).collect()]
        for y in (0, 1):
            own = [size[i] for i in kept if i % 2 == y]
            assert own and (len(own) == 20 or most // 2 <= sum(own) < max(most // 2, 1) + 12)


@pytest.mark.parametrize("few", [True, False])
def test_class_sample_is_the_least_hashes_of_each_class(spark, few):
    from entiscore.llm.common import class_sample, uniform

    rows = spark.createDataFrame([(i, "often" if i % 10 else "seldom") for i in range(2000)] + [(9999, "once"), (None, None)],
                                 "_id long, k string").repartition(7)
    got = class_sample(rows, "k", "_id", 60, "s", few)
    assert sorted(got.columns) == ["_id", "k"]
    u = {r["_id"]: r["u"] for r in rows.select("_id", uniform(F.col("_id"), "s").alias("u")).collect()}
    by: dict = {}
    for r in got.collect():
        by.setdefault(r["k"], []).append(r["_id"])
    n = {"often": 1800, "seldom": 200, "once": 1}
    for k, m in n.items():
        ids = [i for i in range(2000) if (i % 10 != 0) == (k == "often")] if k != "once" else [9999]
        want = sorted((u[i], i) for i in ids if u[i] < 60 / m)[:60]
        assert sorted(by.get(k, [])) == sorted(i for _, i in want)
    assert None not in by
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) or not few
