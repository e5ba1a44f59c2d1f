import random
import re
import zlib

import pytest

from entiscore.llm import spelling as S


def near(a, b):
    """Exactly one inserted, deleted or replaced character, by definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words, factor=10):
    out, forms = {}, {}
    for w, n in words.items():
        close = [v for v in words if v != w and near(w, v)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= factor * n else None
        out[w] = [n, len(close), forms[w], words[forms[w]] if forms[w] else None]
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def run_words(docs, least=7, times=2):
    counts = {}
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= times}


def result(df):
    rows = df.select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_words_equal_brute_force(spark, seed):
    r = random.Random(seed)
    words = {}
    for _ in range(400):                       # few letters: runs of equal ones, many near words
        words["".join(r.choice("abé" if seed == 1 else "ab") for _ in range(r.randrange(1, 8)))] = r.choice([1, 2, 9, 10, 90, 1000, 99999])
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    assert result(S.variant_groups(df)) == brute(words)
    pairs = {tuple(p) for p in S.near_pairs(df).collect()}
    assert pairs == {(a, b) for a in words for b in words if a != b and near(a, b)}
    assert S.near_pairs(df).count() == len(pairs)


def test_long_words_meet_short_ones_and_each_other(spark, monkeypatch):
    r = random.Random(5)
    words = {}
    for size in (S.LONG - 2, S.LONG - 1, S.LONG, S.LONG + 1, S.LONG + 40):
        base = "".join(r.choice("ab") for _ in range(size))
        for w in (base, base[1:], base + "a", base[:50] + "c" + base[51:], "a" + base, base[:60] + "b" + base[60:], base[:-1]):
            words[w] = r.randrange(1, 10**5)
    words |= {"a" * n: n for n in range(S.LONG - 2, S.LONG + 4)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(S.variant_groups(df)) == brute(words)


def test_a_word_of_a_million_letters_costs_its_length(spark):
    r = random.Random(9)
    base = "".join(r.choice("abcd") for _ in range(300_000))
    other = base[:150_000] + "z" + base[150_001:]
    df = spark.createDataFrame([(base, 50), (other, 2)], "word string, n long")
    got = result(S.variant_groups(df))
    assert got[other] == (2, 1, base, 50, base) and got[base] == (50, 1, None, None, base)


def test_documents_with_deletions_nulls_repeats_and_ties(spark, make_docs):
    r = random.Random(3)
    vocabulary = ["possible", "Possible", "possibel", "straßenÀé", "straßenÀê", "committee", "comittee", "commitee",
                  "accommodate", "acommodate", "short", "Ünderground", "ünderground"]
    rows = [(i % 300, " ".join(r.choices(vocabulary, [50, 3, 2, 9, 1, 60, 3, 2, 80, 1, 9, 4, 5], k=40)) + " 漢字committee-x1") for i in range(320)]
    rows += [(None, "possible possible"), (None, None), (7, ""), (8, "12 34 --"), rows[0], rows[0]]
    docs = make_docs(rows, word="mine", n=5, at=3)
    expected = run_words(rows)
    assert any(v[2] for v in brute(expected).values()) and len(expected) > 20
    assert result(S.variant_groups(S.word_counts(docs))) == brute(expected)


def test_empty_table(spark, make_docs):
    assert S.variant_groups(S.word_counts(make_docs([]))).count() == 0
    assert S.variant_groups(S.word_counts(make_docs([(1, None), (2, "few")]))).count() == 0
