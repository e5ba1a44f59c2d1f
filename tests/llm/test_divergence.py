import random
import re
from collections import Counter, defaultdict

import numpy as np

from entiscore.llm import divergence as D


def brute(rows, least=10, most=10):
    docs = [tuple("" if v is None else v for v in r[1:4]) for r in rows]      # text, lang, source
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = [(lang, source, Counter(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text.translate(low)))) for text, lang, source in docs]
    freq, groups = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter))
    for lang, source, c in found:
        freq[lang].update(c.keys())
        groups[lang][source].update(c)
    out = set()
    for lang, own in groups.items():
        kept = [t for t, n in freq[lang].items() if n >= least]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        q = shares(sum(own.values(), Counter()))
        p = {s: shares(c) for s, c in own.items()}

        def rank(source, part, values, limit=None):
            ordered = sorted(values, key=lambda x: (-x[1], x[0].encode()))[:limit]
            out.update((lang, source, part, item, v, i + 1) for i, (item, v) in enumerate(ordered))

        for s in own:
            rank(s, "pair", [(o, sum((p[s][t] - p[o][t])**2 // (p[s][t] + p[o][t]) for t in kept)) for o in own if o != s])
            rank(s, "term", [(t, (p[s][t] - q[t])**2 // (p[s][t] + q[t])) for t in kept if own[s][t] and p[s][t] > q[t]], most)
    return out


def result(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(prose, n=260):
    r = random.Random(8)
    rows = [(i, " ".join(r.choices(prose(1, 60), k=r.randrange(0, 40))), r.choice(["en", "de", None]), f"s{r.randrange(7)}") for i in range(n)]
    rows += [(i, "Same TEXT, same text! ça-va Ça naïve_×x 漢字 é", "en", f"s{i % 5}") for i in range(150)]
    rows += [(1, "same again", "en", "s1")] * 12 + [(2, "same again", "de", "s1")] * 9
    return rows + [(3, None, None, None), (None, "", "en", None), (4, "...", "only", "empty"), (5, "12 !!", "only", "two"),
                   (6, " ".join(["word"] * 5000), "en", ""), (7, None, "de", "never"), (8, "x", "single", "s")]


def test_audit_equals_brute_force(spark, make_docs, prose):
    rows = corpus(prose)
    docs = make_docs(rows, term="mine", n=3, block=1, p=2, rank=9)
    expected = brute(rows)
    assert {r[2] for r in expected} == {"pair", "term"} and len(expected) > 100
    assert result(D.audit(docs)) == expected
    assert result(D.audit(docs, block_cells=25)) == expected           # many blocks a language


def test_counts_let_out_early_add_up(spark, make_docs, prose):
    groups = D.text_groups(make_docs(corpus(prose)))
    few, many = ({tuple(r) for r in df.select("lang", "source", "term", "n").collect()} for df in (
        D.term_counts(groups, held=5), D.term_counts(groups)))
    assert few == many and len(few) > 100
    docs = [{tuple(r) for r in df.groupBy("lang", "term").sum("docs").collect()} for df in (
        D.term_counts(groups, held=5), D.term_counts(groups))]
    assert docs[0] == docs[1]


def test_each_text_is_tokenised_once(spark, make_docs, prose):
    rows = corpus(prose)
    groups = D.text_groups(make_docs(rows)).collect()
    assert len(groups) == len({(r[2] or "", r[1] or "") for r in rows})
    assert sum(o["copies"] for g in groups for o in g["own"]) == len(rows)


def test_sparse_pairs_equal_dense_ones():
    r = np.random.default_rng(3)
    n, terms = 9, 200
    dense = np.where(r.random((terms, n)) < 0.2, r.integers(1, 10**9, (terms, n)), 0)
    rare = r.integers(1, 5000, n)
    term, source = np.nonzero(dense)
    got = D.block_pairs(source, term, dense[term, source], rare)
    full = np.where(dense > 0, dense, rare)
    for s in range(n):
        for t in range(n):
            if s != t:
                none = (rare[s] - rare[t])**2 // (rare[s] + rare[t])
                assert got[s, t] + terms * none == ((full[:, s] - full[:, t])**2 // (full[:, s] + full[:, t])).sum()


def test_shares_stay_exact_for_counts_beyond_a_long_product(spark):
    big = 3 * 10**14 + 7
    df = spark.createDataFrame([(big, 5 * big, 1000), (0, 10, 3), (5, 0, 0)], "n long, total long, kept long")
    got = [r[0] for r in df.select(D.share("n", "total", "kept")).collect()]
    assert got == [1 + 10**9 * (big + 2) // (5 * big + 2000), 1 + 10**9 * 2 // 16, 1]


def test_empty_table(spark, make_docs):
    assert D.audit(make_docs([])).count() == 0
