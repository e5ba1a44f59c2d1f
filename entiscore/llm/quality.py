"""Quality classifier: Naive Bayes support vectors.

Features are n-gram indicators, named by 64-bit hashes: single words and word pairs
(lower-cased), and one to three consecutive *shapes*.  A shape keeps what a word
looks like (runs of small letters ``x``, of capitals ``X``, of digits ``9``, other
characters as they are, each run once) and is ``=`` for a word equal to the one
before it.  Each indicator is scaled by its class log-count ratio

    r = log((alpha + count in label 1) / total 1) - log((alpha + count in label 0) / total 0)

(n-grams of fewer than ``least_docs`` sampled documents are left out), rows are scaled to
length 1, and a linear model with hinge loss is fitted by dual coordinate descent.
Margins become scores through a logistic curve fitted on margins of documents left
out of the fit (three folds), set for the share of label 1 among the labelled
documents.

Spark takes the n-grams of a bounded sample of labelled documents (``per_class`` a
class, together ``most_grams`` n-grams and the last text of each class) and counts them
by class; the driver reads the counts of n-grams in ``least_docs`` documents (so at most
``most_grams / least_docs``) and the sampled rows.  Scoring runs over every whole text
and looks its n-grams up by their whole hash: one that was not learned counts for nothing,
so the longest texts are told apart like short ones.

Edge cases: null and empty texts have no n-gram and are scored by the constant
term; without both classes to learn from every score is the share of label 1;
repeated rows are scored alike; documents with two different labels are not learned
from; an empty table gives no rows; columns of the caller that are named like an
added column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entiscore.llm.common import ROW, field, modest_batches, packed, uniform, unpacked, written
from entiscore.llm.labelled import labelled_sample

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SAME = np.uint64(xxhash.xxh3_64_intdigest(b"="))


@dataclass(frozen=True)
class Settings:
    least_docs: int = 3
    alpha: float = 1.0
    cost: float = 1.0
    passes: int = 20
    per_class: int = 3000
    most_grams: int = 1 << 24


@dataclass
class Model:
    settings: Settings
    keys: np.ndarray        # the n-grams that count, ascending (uint64)
    scaled: np.ndarray      # weight * ratio by key
    squares: np.ndarray     # ratio^2 by key
    bias: float
    slope: float
    shift: float


class Keys:
    """Finds n-grams among ascending keys; most others fall to a look at their first bits."""

    SHIFT = np.uint64(42)

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.seen = np.zeros(1 << (64 - int(self.SHIFT)), bool)
        self.seen[keys >> self.SHIFT] = True

    def found(self, grams: np.ndarray) -> np.ndarray:
        """Ascending places of the keys that occur in ``grams``, each once."""
        g = grams[self.seen[grams >> self.SHIFT]]       # so a key at or above each of their first bits exists
        at = np.searchsorted(self.keys, g)
        near = at < len(self.keys)
        at, g = at[near], g[near]
        return np.unique(at[self.keys[at] == g])


def shape(word: str) -> str:
    """``Hello,`` -> ``Xx,``; ``AB12!!`` -> ``X9!``."""
    out = []
    for c in word:
        k = ("9" if c.isdigit() else ("X" if c.isupper() else "x") if c.isalpha() else c)
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)


class _Words(dict):
    """word -> (hash of the word in lower case, hash of its shape)."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) > 500_000:
            self.clear()
        text = word.decode("utf-8", "replace")
        got = self[word] = (xxhash.xxh3_64_intdigest(text.lower().encode()),
                            xxhash.xxh3_64_intdigest(shape(text).encode()))
        return got


def text_grams(text: str | None, words: _Words) -> np.ndarray:
    """The n-grams of a text (uint64), repeated ones more than once."""
    own = text.encode("utf-8", "replace").split() if text else []      # bytes: ASCII white space only
    if not own:
        return np.zeros(0, np.uint64)
    h = np.array([words[w] for w in own], np.uint64)
    word, form = h[:, 0], h[:, 1].copy()
    form[1:][word[1:] == word[:-1]] = _SAME
    pairs = form[:-1] * _MIX + form[1:]
    grams = [word, word[:-1] * _MIX + word[1:] + np.uint64(2), form + np.uint64(11), pairs + np.uint64(12),
             pairs[:-1] * _MIX + form[2:] + np.uint64(13)]
    g = np.concatenate(grams) * np.uint64(0xD6E8FEB86659FD93)
    return g ^ (g >> np.uint64(31))


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, bins: int, s: Settings) -> np.ndarray:
    """Weights (the last is the constant) of the linear hinge-loss model of sparse rows, y in -1, 1.

    One dual variable per row is moved to its best value at a time; classes weigh alike.
    """
    rng = np.random.default_rng(11)
    w = np.zeros(bins + 1)
    alpha = np.zeros(len(rows))
    diagonal = np.array([v @ v + 1 for _, v in rows])
    positive = max(1, (y > 0).sum())
    most = np.where(y > 0, s.cost * len(y) / (2 * positive), s.cost * len(y) / (2 * max(1, len(y) - positive)))
    for _ in range(s.passes):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            gradient = y[i] * (w[at] @ v + w[-1]) - 1
            new = min(max(alpha[i] - gradient / diagonal[i], 0.0), most[i])
            if (step := (new - alpha[i]) * y[i]) != 0.0:
                w[at] += step * v
                w[-1] += step
                worst = max(worst, abs(step))
                alpha[i] = new
        if worst < 1e-3:
            break
    return w


def logistic_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of sigmoid(slope * margin + shift) for 0/1 labels, by damped Newton steps."""
    k = (y.sum() + 1) / (len(y) + 2)
    low, high = 1 / (len(y) - y.sum() + 2), (y.sum() + 1) / (y.sum() + 2)
    t = np.where(y > 0, high, low)
    a, b = 1.0, float(np.log(k / (1 - k)))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - t) * margin).sum(), (p - t).sum()])
        q = p * (1 - p)
        h = np.array([[(q * margin**2).sum(), (q * margin).sum()], [(q * margin).sum(), q.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def ratios(count1: np.ndarray, count0: np.ndarray, s: Settings) -> np.ndarray:
    return (np.log((s.alpha + count1) / (s.alpha + count1).sum())
            - np.log((s.alpha + count0) / (s.alpha + count0).sum()))


def within(rows: DataFrame, most: int) -> DataFrame:
    """Of each class the rows, in the order of a hash, until they hold ``most / 2`` n-grams (the last one may go beyond).

    The window runs over ids and sizes of the bounded sample only.
    """
    before = (Window.partitionBy("_y").orderBy(uniform(F.col("_id"), "grams"), "_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    sizes = rows.select("_id", "_y", F.size("g").cast("long").alias("n"))
    kept = (sizes.withColumn("b", F.coalesce(F.sum("n").over(before), F.lit(0)))
            .where(F.col("b") < max(most // 2, 1)).select("_id"))
    return rows.join(F.broadcast(kept), "_id", "left_semi")      # at most 2 * per_class ids


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings()) -> Model:
    s = settings
    sample, share = labelled_sample(docs, labels, label, s.per_class, label)

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words()
        for pdf in batches:
            yield pd.DataFrame({"_id": pdf["_id"], "_y": pdf["_y"],
                                "g": [np.unique(text_grams(t, words)).view(np.int64) for t in pdf["text"]]})

    modest_batches(docs.sparkSession)
    rows = within(written(sample.mapInPandas(grams, "_id long, _y int, g array<long>")), s.most_grams)
    counts = (rows.select("_y", F.explode("g").alias("g")).groupBy("g")
              .agg(F.sum("_y").alias("n1"), F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= s.least_docs).toArrow())          # most_grams / least_docs rows at most
    keys, count1, count = (counts.column(c).to_numpy() for c in ("g", "n1", "n"))
    order = np.argsort(keys.view(np.uint64))
    keys, ratio = keys.view(np.uint64)[order], ratios(count1, count - count1, s)[order]
    look = Keys(keys)

    x, y = [], []
    for r in rows.orderBy("_id").toLocalIterator():          # 2 * per_class rows, most_grams n-grams at most
        at = look.found(np.array(r["g"], np.int64).view(np.uint64))
        v = ratio[at]
        x.append((at.astype(np.int32), v / max(np.sqrt(v @ v), 1e-12)))
        y.append(r["_y"])
    y = np.array(y, int)
    level = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    if len(set(y.tolist())) < 2:
        return Model(s, keys[:0], ratio[:0], ratio[:0], 0.0, 0.0, level)
    sign = np.where(y > 0, 1.0, -1.0)
    part = np.arange(len(y)) % 3
    margin = np.zeros(len(y))
    for k in range(3):
        if len(set(y[part != k].tolist())) < 2:
            continue
        w = dual_descent([r for r, p in zip(x, part) if p != k], sign[part != k], len(ratio), s)
        for i in np.flatnonzero(part == k):
            margin[i] = w[x[i][0]] @ x[i][1] + w[-1]
    slope, shift = logistic_curve(margin, y)
    shift += level - float(np.log(y.mean() / (1 - y.mean())))       # from the sample's to the labels' share
    w = dual_descent(x, sign, len(ratio), s)
    return Model(s, keys, w[:-1] * ratio, ratio**2, float(w[-1]), slope, shift)


def score_texts(texts: pd.Series, model: Model, words: _Words, look: Keys) -> pd.Series:
    out = np.full(len(texts), model.bias)
    for i, text in enumerate(texts):
        at = look.found(text_grams(text if isinstance(text, str) else None, words))
        if len(at):
            out[i] += model.scaled[at].sum() / max(np.sqrt(model.squares[at].sum()), 1e-12)
    return pd.Series(1 / (1 + np.exp(-np.clip(model.slope * out + model.shift, -30, 30))))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (double, 0 to 1; higher: label 1 more likely)."""
    modest_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words, look = _Words(), Keys(model.keys)
        for texts in batches:
            yield score_texts(texts, model, words, look)

    rows = packed(docs)
    return unpacked(rows.select(ROW, predict(field("text")).alias("_p")), {"score": F.col("_p")})
