"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its lower-cased words (runs of letters) and the first 4, 5
and 6 letters of longer words, each hashed to ``2^bits`` values and taken once per
text.  A factorization machine gives each term a weight and a short vector:

    score = sigmoid(w0 + sum_i w_i + sum_{i<j} <v_i, v_j>)

so two terms can mean together what neither means alone.  The pair sum costs one
pass: half of |sum v|^2 - sum |v|^2.

Fitting takes a bounded sample of labelled documents (``per_class`` a class) and every
hashed term of ``least_docs`` of them.  The driver reads them as the places of each
document's terms and fits the machine by Adam on the logistic loss: first over the
terms that tell the label alone or, by a test of all pairs, together with another,
then over all terms, as long as the loss of a quarter left out falls.  The pair test,
whose cost grows with the square of the terms, runs as Spark tasks; the fits cost the
driver a time that ``per_class`` bounds.  Scoring runs over every whole text.

Edge cases: null and empty texts are scored by the constant term; without both
classes to learn from every score is the share of label 1; repeated rows are scored
alike; documents with two different labels are not learned from; an empty table
gives no rows; columns of the caller that are named like an added column are
replaced by it.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.llm.common import ROW, field, modest_batches, packed, unpacked, written
from entiscore.llm.labelled import labelled_sample

_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    least_docs: int = 3
    least_chi: float = 10.8       # the 0.1 % level: terms above it tell the label alone
    factors: int = 8
    per_class: int = 4000
    steps: int = 300
    pair_steps: int = 1200        # if there are pairs to learn
    all_steps: int = 100          # at most, over all terms
    batch: int = 256
    rate: float = 0.03
    all_rate: float = 0.0005
    decay: float = 1e-4


@dataclass
class Model:
    settings: Settings
    bias: float
    terms: np.ndarray       # hashed terms, ascending
    weights: np.ndarray     # one per term
    vectors: np.ndarray     # one row per term


#: The crc32 of a term goes on from that of what stands before it: "w " for words, "4 " for four letters, ...
_WHOLE = zlib.crc32(b"w ")
_HEADS = [(n, zlib.crc32(f"{n} ".encode())) for n in (4, 5, 6)]


def word_terms(word: str, bits: int) -> list[int]:
    """Hashed terms of one lower-cased word."""
    size, down = len(word), 32 - bits
    own = [zlib.crc32(word.encode(), _WHOLE) >> down]
    for n, start in _HEADS:
        if size > n:
            own.append(zlib.crc32(word[:n].encode(), start) >> down)
    return own


def text_terms(text: str, bits: int) -> set[int]:
    return {t for w in set(_WORD.findall(text.lower())) for t in word_terms(w, bits)}


def _sums(by: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``values`` summed by ``by``."""
    return np.stack([np.bincount(by, values[:, f], size) for f in range(values.shape[1])], axis=1)


def margins(x: list[np.ndarray], p: list[np.ndarray]) -> np.ndarray:
    """Scores before the logistic curve of rows that list their places."""
    out = np.empty(len(x))
    for i, at in enumerate(x):
        v = p[2][at]
        out[i] = p[0][0, 0] + p[1][at].sum() + 0.5 * ((v.sum(0)**2).sum() - (v**2).sum())
    return out


def passes(x: list[np.ndarray], y: np.ndarray, p: list[np.ndarray], steps: int, rate: float,
           s: Settings) -> Iterator[None]:
    """Moves bias, weights and vectors ``p`` by about ``steps`` Adam steps; yields after every pass
    over the rows.  A step moves the places of its rows only."""
    rng, n = np.random.default_rng(7), len(x)
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    step = 0
    for _ in range(-(-steps // -(-n // s.batch))):
        order = rng.permutation(n)
        for at in range(0, n, s.batch):
            rows = order[at:at + s.batch]
            row = np.repeat(np.arange(len(rows)), [len(x[i]) for i in rows])
            own, place = np.unique(np.concatenate([x[i] for i in rows]), return_inverse=True)
            w, u = p[1][own], p[2][own]
            both = _sums(row, np.concatenate([w, u, u**2], axis=1)[place], len(rows))
            xv = both[:, 1:1 + s.factors]
            z = p[0][0, 0] + both[:, 0] + 0.5 * (xv**2 - both[:, 1 + s.factors:]).sum(1)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
            back = _sums(place, (err[:, None] * np.column_stack([np.ones(len(rows)), xv]))[row], len(own))
            g = [np.full((1, 1), err.sum()), back[:, :1] + s.decay * w, back[:, 1:] - u * back[:, :1] + s.decay * u]
            step += 1
            for k, i in enumerate((np.zeros(1, np.int64), own, own)):
                m[k][i] = 0.9 * m[k][i] + 0.1 * g[k]
                v[k][i] = 0.999 * v[k][i] + 0.001 * g[k]**2
                p[k][i] -= rate * (m[k][i] / (1 - 0.9**step)) / (np.sqrt(v[k][i] / (1 - 0.999**step)) + 1e-8)
        yield


def started(d: int, s: Settings) -> list[np.ndarray]:
    return [np.zeros((1, 1)), np.zeros((d, 1)), np.random.default_rng(7).normal(0, 0.01, (d, s.factors))]


def finished(p: list[np.ndarray], y: np.ndarray, share: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and vectors, the bias set for ``share`` of label 1."""
    seen = y.mean()
    shift = np.log(share / (1 - share)) - np.log(seen / (1 - seen)) if 0 < share < 1 and 0 < seen < 1 else 0.0
    return float(p[0][0, 0] + shift), p[1][:, 0], p[2]


def fit_machine(x: np.ndarray, y: np.ndarray, share: float, s: Settings) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and vectors for 0/1 rows ``x``; the bias is set for ``share`` of label 1."""
    p = started(x.shape[1], s)
    for _ in passes([np.flatnonzero(r) for r in x], y, p, s.steps, s.rate, s):
        pass
    return finished(p, y, share)


def strong_terms(x: list[np.ndarray], y: np.ndarray, d: int, s: Settings) -> np.ndarray:
    """Places whose terms tell the label alone: chi-square of presence of at least ``least_chi``."""
    n, k = len(y), y.sum()
    at = np.concatenate(x)
    a = np.bincount(at, minlength=d)
    b = np.bincount(at, np.repeat(y, [len(r) for r in x]), d)
    return (b * n - a * k)**2 / (a * (n - a) + 1) * (n / (k * (n - k))) >= s.least_chi


class PairTest:
    """Which terms tell together with another what the machine of the strong terms leaves.

    ``rest`` is label minus probability by a machine fitted on other rows.  In the c rows of a pair
    it is taken less what the two terms leave alone (their means added); with sums S of that and Q
    of its square (at least of its variance under that machine), S^2 / Q is chi-square under chance
    and at most c: all pairs that can reach the level (5 % over all pairs of terms) are looked at.
    A unit of work holds a block of the terms that are not ``known`` to tell alone against block
    after block of all terms; a term leaves it once it is hit, for one partner is enough.
    """

    BLOCK = 1024

    def __init__(self, x: list[np.ndarray], d: int, rest: np.ndarray, known: np.ndarray):
        self.n, self.level = len(x), 2 * np.log(10.0 * max(d, 1)**2)
        at = np.concatenate(x) if len(x) else np.zeros(0, np.int32)
        row = np.repeat(np.arange(len(x), dtype=np.int32), [len(r) for r in x])
        count = np.bincount(at, minlength=d)
        self.able = np.flatnonzero(count >= self.level)
        order = np.argsort(at, kind="stable")
        order = order[count[at[order]] >= self.level]
        self.row = row[order]
        self.first = np.concatenate([[0], np.cumsum(count[self.able])])
        self.rest = rest.astype(np.float32)
        self.alone = (np.bincount(at, rest[row], d) / np.maximum(count, 1) - (rest.mean() if len(rest) else 0.0) / 2)[self.able]

        self.open = np.flatnonzero(~known[self.able])              # places in able

    def units(self) -> range:
        return range(-(-len(self.open) // self.BLOCK))

    def _dense(self, terms: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, len(terms)), np.float32)
        for j, t in enumerate(terms):
            out[self.row[self.first[t]:self.first[t + 1]], j] = 1
        return out

    def hits(self, unit: int) -> np.ndarray:
        """Places of the unit's terms that reach the level with any other term."""
        left = self.open[unit * self.BLOCK:(unit + 1) * self.BLOCK]
        r = self.rest[:, None]
        weigh, squares = self._dense(left), np.maximum(r**2, abs(r) * (1 - abs(r)))
        found, blocks = [], -(-len(self.able) // self.BLOCK)
        for k in range(blocks):
            at = (left[0] // self.BLOCK + k) % blocks * self.BLOCK
            other = np.arange(at, min(at + self.BLOCK, len(self.able)))
            right = self._dense(other)
            c, t, q = weigh.T @ right, weigh.T @ (right * r), weigh.T @ (right * squares)
            e = (self.alone[left][:, None] + self.alone[other][None, :]).astype(np.float32)
            hit = (c >= self.level) & ((t - e * c)**2 >= self.level * np.maximum(q - 2 * e * t + e**2 * c, 1e-6))
            hit = (hit & (left[:, None] != other[None, :])).any(1)
            found.append(left[hit])
            left, weigh = left[~hit], weigh[:, ~hit]
            if not len(left):
                break
        return self.able[np.concatenate(found)]


def tested_here(test: PairTest) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *map(test.hits, test.units())])


def tested_in_tasks(spark) -> Callable[[PairTest], np.ndarray]:
    """Runs the units of a pair test as Spark tasks; only the places that were hit come back."""
    def run(test: PairTest) -> np.ndarray:
        units = test.units()
        if not units:
            return np.zeros(0, np.int64)

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for unit in pdf["unit"]:
                    yield pd.DataFrame({"place": test.hits(unit)})

        rows = spark.range(0, len(units), 1, len(units)).select(F.col("id").alias("unit"))
        # the sample's distinct terms at most
        return rows.mapInPandas(work, "place long").distinct().toPandas()["place"].to_numpy(np.int64)

    return run


def paired_terms(x: list[np.ndarray], d: int, rest: np.ndarray, known: np.ndarray,
                 tested: Callable[[PairTest], np.ndarray] = tested_here) -> np.ndarray:
    """For each place, whether it is ``known`` or :class:`PairTest` finds it in a pair."""
    out = known.copy()
    out[tested(PairTest(x, d, rest, known))] = True
    return out


def fit_rows(x: list[np.ndarray], d: int, y: np.ndarray, share: float, s: Settings,
             tested: Callable[[PairTest], np.ndarray] = tested_here) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and vectors of all ``d`` terms for rows that list their places.

    Terms that tell the label alone or in a pair are fitted first, then all; the passes over
    all terms end where the loss of a quarter left out of them was least.
    """
    def fitted(rows: np.ndarray, use: np.ndarray, steps: int) -> list[np.ndarray]:
        p = started(d, s)
        p[2][~use] = 0
        for _ in passes([x[i][use[x[i]]] for i in rows], y[rows], p, steps, s.rate, s):
            pass
        return p

    def both(rows: np.ndarray) -> bool:
        return 0 < y[rows].sum() < len(rows)

    rows = np.arange(len(y))
    part = np.random.default_rng(3).permutation(len(y)) % 4
    rest = np.zeros(len(y))
    for half in range(2):
        own, other = rows[part % 2 == half], rows[part % 2 != half]
        if len(own) and both(other):
            use = strong_terms([x[i] for i in other], y[other], d, s)
            z = margins([x[i] for i in own], fitted(other, use, s.steps))
            rest[own] = y[own] - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    known = strong_terms(x, y, d, s) if both(rows) else np.zeros(d, bool)
    paired = paired_terms(x, d, rest, known, tested)
    steps = s.pair_steps if (paired & ~known).any() else s.steps

    def fit(rows: np.ndarray) -> Iterator[list[np.ndarray]]:
        """The machine after the passes over the telling terms, then after each pass over all."""
        use = strong_terms([x[i] for i in rows], y[rows], d, s) | paired
        p = fitted(rows, use, steps)
        yield p
        p[2][~use] = started(d, s)[2][~use]
        for _ in passes([x[i] for i in rows], y[rows], p, s.all_steps, s.all_rate, s):
            yield p

    out, best = rows[part == 0], 0
    if both(out) and both(rows[part > 0]):
        sign = np.where(y[out] > 0, -1, 1)
        best = int(np.argmin([np.logaddexp(0, sign * margins([x[i] for i in out], p)).mean()
                              for p in fit(rows[part > 0])]))
    for i, p in enumerate(fit(rows)):
        if i == best:
            break
    return finished(p, y, share)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = Settings()) -> Model:
    s = settings
    sample, share = labelled_sample(docs, labels, label, s.per_class, label)

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"_id": pdf["_id"], "_y": pdf["_y"],
                                "t": [sorted(text_terms(t, s.bits)) for t in pdf["text"]]})

    modest_batches(docs.sparkSession)
    rows = written(sample.mapInPandas(terms, "_id long, _y int, t array<int>"))
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("k")).first()
    n, k = total["n"], total["k"] or 0
    none = Model(s, float(np.log((share + 1e-6) / (1 - share + 1e-6))), np.zeros(0, np.int64), np.zeros(0),
                 np.zeros((0, s.factors)))
    if not 0 < k < n:
        return none
    # every hashed term of the sample that least_docs documents have; at most 2^bits
    counts = rows.select(F.explode("t").alias("t")).groupBy("t").count().where(F.col("count") >= s.least_docs)
    chosen = np.sort(np.array([r["t"] for r in counts.select("t").toLocalIterator()], np.int64))

    def places(t: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(chosen, t), max(len(chosen) - 1, 0))
        return at[chosen[at] == t].astype(np.int32) if len(chosen) else np.zeros(0, np.int32)

    def active(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = [places(np.array(t, np.int64)) for t in pdf["t"]]
            yield pd.DataFrame({"_id": pdf["_id"], "_y": pdf["_y"], "t": at})

    # 2 * per_class rows at most
    x, y = [], []
    for r in rows.mapInPandas(active, "_id long, _y int, t array<int>").orderBy("_id").toLocalIterator():
        x.append(np.array(r["t"], np.int32))
        y.append(r["_y"])
    bias, weights, vectors = fit_rows(x, len(chosen), np.array(y, float), share, s, tested_in_tasks(docs.sparkSession))
    return Model(s, bias, chosen, weights, vectors)


class Scorer:
    """Scores batches of texts; a word's terms are looked up once a task.

    The words known so far have numbers, and ``first[i]:first[i + 1]`` of ``places`` are the terms of
    word i.  The places of a batch's texts are joined into one array, made distinct within each text,
    and summed by text.
    """

    MOST_WORDS = 500_000

    def __init__(self, model: Model):
        self.model = model
        self.place = {int(t): i for i, t in enumerate(model.terms)}
        # a row a term: weight, vector, squared length of the vector
        self.table = np.column_stack([model.weights, model.vectors, (model.vectors**2).sum(1)])
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.places, self.first = array("i"), array("q", [0])

    def known(self, word: str) -> int:
        n = self.number[word] = len(self.first) - 1
        get, places = self.place.get, self.places
        for t in word_terms(word, self.model.settings.bits):
            at = get(t)
            if at is not None:
                places.append(at)
        self.first.append(len(places))
        return n

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        if len(self.number) > self.MOST_WORDS:
            self.forget()
        get, words, sizes = self.number.get, array("q"), []
        for text in texts:
            own = set(_WORD.findall(text.lower())) if isinstance(text, str) else ()
            numbers = list(map(get, own))
            if None in numbers:
                numbers = [self.known(w) if n is None else n for w, n in zip(own, numbers)]
            words.extend(numbers)
            sizes.append(len(numbers))
        m = self.model
        out = np.full(len(sizes), m.bias)
        if len(words):
            word = np.frombuffer(words, np.int64)
            first = np.frombuffer(self.first, np.int64)
            start, size = first[word], first[word + 1] - first[word]
            ends = np.cumsum(size)
            at = np.repeat(start - (ends - size), size) + np.arange(ends[-1])
            row = np.repeat(np.repeat(np.arange(len(sizes)), sizes), size)
            if len(at):
                pairs = row * len(m.terms) + np.frombuffer(self.places, np.int32)[at]
                pairs.sort()
                row, place = np.divmod(pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])], len(m.terms))
                begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                sums = np.add.reduceat(np.take(self.table, place, axis=0), begin, axis=0)
                out[row[begin]] += sums[:, 0] + 0.5 * ((sums[:, 1:-1]**2).sum(1) - sums[:, -1])
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def score_texts(texts: pd.Series, model: Model) -> pd.Series:
    return pd.Series(Scorer(model).scores(texts))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (double, 0 to 1; higher: more likely toxic)."""
    modest_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)                                # once a task
        for texts in batches:
            yield pd.Series(scorer.scores(texts))

    rows = packed(docs)
    return unpacked(rows.select(ROW, predict(field("text")).alias("_p")), {"score": F.col("_p")})
