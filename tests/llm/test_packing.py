import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from entiscore.llm import packing as P
from entiscore.llm.queries import vocabulary


def check_runs(runs, counts, capacity):
    used = {}
    for r in runs:
        assert r.count > 0 and sum(s * k for s, k in r.parts) <= capacity
        for s, k in r.parts:
            used[s] = used.get(s, 0) + k * r.count
    assert used == {s: n for s, n in counts.items() if n}


def fewest(items, capacity):
    """Fewest sequences, by trying every set for the longest item."""
    items = sorted(items, reverse=True)
    memo = {}

    def go(left):
        if not left:
            return 0
        if left not in memo:
            head, rest = left[0], left[1:]
            best = len(left)
            for k in range(len(rest) + 1):
                for pick in set(combinations(rest, k)):
                    if head + sum(pick) <= capacity:
                        other = list(rest)
                        for p in pick:
                            other.remove(p)
                        best = min(best, 1 + go(tuple(other)))
            memo[left] = best
        return memo[left]

    return go(tuple(items))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_reduction_never_costs_a_sequence(items):
    counts = {s: items.count(s) for s in set(items)}
    fixed, left = P.reduce_instance(counts, 20)
    rest = [s for s, n in left.items() for _ in range(n)]
    assert sum(r.count for r in fixed) + fewest(rest, 20) == fewest(items, 20)
    check_runs(P.plan_runs(counts, 20), counts, 20)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_grouped_best_fit_equals_item_by_item(items):
    counts = {s: items.count(s) for s in set(items)}
    bins = []
    for s in sorted(items, reverse=True):
        fit = [b for b in bins if 30 - sum(b) >= s]
        if fit:
            max(fit, key=sum).append(s)
        else:
            bins.append([s])
    runs = P.best_fit(counts, 30)
    check_runs(runs, counts, 30)
    # sequences of equal room are interchangeable: which of them takes a piece is a matter of taste, the rooms are not
    rooms = sorted(30 - sum(s * k for s, k in r.parts) for r in runs for _ in range(r.count))
    assert rooms == sorted(30 - sum(b) for b in bins)


def lower_bound(counts, capacity):
    """Martello and Toth's L2: no packing takes fewer sequences."""
    best = 0
    for alpha in range(0, capacity // 2 + 1):
        alone = sum(n for s, n in counts.items() if s > capacity - alpha)
        large = [(s, n) for s, n in counts.items() if capacity / 2 < s <= capacity - alpha]
        small = sum(s * n for s, n in counts.items() if alpha <= s <= capacity / 2)
        room = sum((capacity - s) * n for s, n in large)
        best = max(best, alone + sum(n for _, n in large) + max(0, -((room - small) // capacity)))
    return best


def test_counts_far_beyond_the_number_of_lengths():
    r = random.Random(1)
    counts = {s: r.randrange(10**9) for s in range(1, 1025)}
    runs = P.plan_runs(counts, 1024)
    check_runs(runs, counts, 1024)
    assert len(runs) < 10 * 1024
    least = lower_bound(counts, 1024)
    assert least >= sum(s * n for s, n in counts.items()) / 1024
    assert least <= sum(x.count for x in runs) <= 1.002 * least


def reference_ids(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary())
    return (t.encode(text, add_special_tokens=False).ids if text else []) + [2]


TEXTS = ["", "a", "Hello, world's  end.\n\n\n tabs\t\t x", "漢字 émigré 😀 naïve non-breaking em", "<|endoftext|> a", "hi <|endoftext|> there",
         "<|endoftext|><|endoftext|>", "word " * 1200 + "<|endoftext|>" + " more" * 900 + "<|endoftext|", "<|endoftext |> <|pad|>",
         "a" * 3000, " " * 2500, "word " * 1500, "\r\n\x0b\x0c 12345 don't we'll I'm #$%"]


def test_ids_equal_the_tokenizers_library(spark, make_docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None)]
    got = {}
    for r in P.tokenize_pieces(make_docs(rows), vocabulary(), with_ids=True).collect():
        got.setdefault(r["doc_id"], {})[r["piece"]] = r
    for i, t in rows:
        ids = reference_ids(t)
        pieces = [got[i][k] for k in range(len(got[i]))]
        assert [x for p in pieces for x in p["ids"]] == ids
        assert [p["start"] for p in pieces] == np.cumsum([0] + [p["length"] for p in pieces])[:-1].tolist()
        assert all(p["length"] == 1024 for p in pieces[1:]) and all(0 < p["length"] <= 1024 for p in pieces)
        assert all(p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) for p in pieces)


@pytest.mark.parametrize("capacity", [8, 64])
def test_every_piece_is_placed_once_and_gapless(spark, make_docs, prose, capacity):
    rows = [(i % 150, " ".join(prose(i, i % 41))) for i in range(200)] + [(None, "x"), (None, None), (3, "same"), (3, "same")]
    out = P.best_fit_pack(make_docs(rows, length=5, sequence_id="mine"), vocabulary(), capacity=capacity)
    rows_out = out.collect()
    expected = [n for i, t in rows for _, n in P.cut(len(reference_ids(t)), capacity)]
    assert sorted(r["length"] for r in rows_out) == sorted(expected)
    by = {}
    for r in rows_out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    assert len(by) <= 1.1 * sum(expected) / capacity + 1


def test_sequences_round_trip_and_empty_table(spark, make_docs, prose):
    docs = make_docs([(i, " ".join(prose(i, 30 + i))) for i in range(20)])
    packed = P.best_fit_pack(docs, vocabulary(), capacity=128)
    seqs = P.sequences(docs, packed, vocabulary(), capacity=128).collect()
    ids = sorted(x for s in seqs for x in s["ids"])
    assert ids == sorted(x for r in docs.collect() for x in reference_ids(r["text"]))
    assert all(len(s["ids"]) <= 128 for s in seqs)
    assert P.best_fit_pack(make_docs([]), vocabulary()).count() == 0
