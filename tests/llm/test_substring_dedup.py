import random

import numpy as np
import pytest

from entiscore.llm import substring_dedup as S


def brute(rows, window):
    first, out = {}, []
    order = lambda i: float("inf") if i is None else i
    split = [(i, S.text_words(t)) for i, t in rows]
    for i, w in split:
        for a in range(len(w) - window + 1):
            k = tuple(w[a:a + window])
            first[k] = min(first.get(k, float("inf")), order(i))
    for i, w in split:
        gone = {a + k for a in range(len(w) - window + 1) if first[tuple(w[a:a + window])] < order(i) for k in range(window)}
        out.append((i, b" ".join(x for k, x in enumerate(w) if k not in gone).decode(), len(w), len(gone)))
    return sorted(out, key=repr)


def texts(prose, n=60):
    r = random.Random(5)
    passages = [prose(1000 + k, 30) for k in range(3)]
    rows = []
    for i in range(n):
        ws = prose(i, r.randrange(0, 80))
        for _ in range(r.randrange(0, 3)):
            at = r.randrange(0, len(ws) + 1)
            ws[at:at] = r.choice(passages)[r.randrange(0, 8):]
        rows.append((i, "  ".join(ws) if i % 2 else "\n".join(ws)))
    return rows


@pytest.mark.parametrize("settings", [S.Settings(window=12, gram=4),
                                      S.Settings(window=12, gram=12, bucket_rows=7, hot_rows=2),
                                      S.Settings(window=5, gram=2, bucket_rows=3, hot_rows=1)])
def test_against_brute_force(spark, make_docs, prose, settings):
    rows = texts(prose) + [(100, None), (101, ""), (102, " \n "), (None, rows_text := " ".join(prose(1000, 30))),
                           (103, rows_text), (103, rows_text), (7, rows_text), (104, "the " * 200), (105, "the " * 90),
                           (None, rows_text), (106, "a b c " + rows_text + " d")]
    got = S.dedup_substrings(make_docs(rows, start=3, m="x", n_words="mine"), settings).collect()
    assert sorted(((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in got), key=repr) == brute(rows, settings.window)


def test_default_window_long_text_and_hot_passage(spark, make_docs, prose):
    long, passage = prose(1, 20_000), prose(2, 60)
    rows = [(1, " ".join(long)), (2, " ".join(prose(3, 10) + long))]
    rows += [(10 + i, " ".join(prose(10 + i, 20) + passage + prose(900 + i, 20))) for i in range(60)]
    s = S.Settings(hot_rows=8, bucket_rows=50)
    got = S.dedup_substrings(make_docs(rows), s).collect()
    assert sorted(((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in got), key=repr) == brute(rows, 50)
    assert {r["doc_id"]: r["n_removed"] for r in got}[2] == 20_000


def test_empty_table(spark, make_docs):
    assert S.dedup_substrings(make_docs([])).count() == 0


def test_super_kmers_cover_every_window_once_and_agree(prose):
    s = S.Settings(window=20, gram=6)
    words = [w.encode() for w in prose(3, 300)]
    m, start, n = S.super_kmers(words, s)
    assert np.concatenate([np.arange(a, a + k) for a, k in zip(start, n)]).tolist() == list(range(281))
    by = {a + k: x for x, a, c in zip(m, start, n) for k in range(c)}
    for a in range(0, 281, 7):
        assert S.super_kmers(words[a:a + 20], s)[0].tolist() == [by[a]]


def test_window_ranks_are_exact():
    codes = np.array([1, 2, 1, 2, 1, 2, 3, 1, 2, 1, 2, 1])
    for w in (1, 2, 3, 5, 7):
        rank = S.window_ranks(codes, w)
        seen = {}
        for a in range(len(codes) - w + 1):
            assert seen.setdefault(tuple(codes[a:a + w]), rank[a]) == rank[a]
        assert len(set(seen.values())) == len(seen)


def test_repeated_rows_and_texts_of_one_word(spark, make_docs, prose):
    text = " ".join(prose(4, 120))
    rows = [(None, text)] * 400 + [(9, text)] * 30 + [(9, "other " + text), (12, "one " * 3000), (11, "one " * 2500), (13, "uno " * 900)]
    for s in (S.Settings(), S.Settings(hot_rows=5, bucket_rows=40, span=16)):
        got = S.dedup_substrings(make_docs(rows), s).collect()
        assert sorted(((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in got), key=repr) == brute(rows, 50)


def test_strings_stay_bounded_whatever_the_text():
    s = S.Settings(span=64)
    m, start, n = S.super_kmers([b"one"] * 100_000, s)
    assert len(set(m.tolist())) == 1 and n.max() <= 64 and n.sum() == 100_000 - 49
    assert np.array_equal(start, np.concatenate([[0], np.cumsum(n)[:-1]]))
