"""Language identification by a string kernel.

The blended spectrum kernel compares two stretches of text by the character
n-grams (n = 1, 2, 3 over letters, everything else one space) present in both.
N-grams are hashed into ``bins``; the presence vectors are scaled to length 1, so
the kernel is a dot product of two 0/1 vectors over the root of their sizes.

Fitting takes a bounded sample of labelled documents (``per_language`` each,
however many languages; ``stretches_per_doc`` evenly spaced stretches of each), picks
``landmarks`` of them, maps the sample to the Nyström features
``K(x, landmarks) K(landmarks, landmarks)^(-1/2)`` and solves one-versus-rest
kernel ridge regression there.  Scoring covers the whole text in stretches of
``stretch`` characters: two matrix products for a batch of stretches, then the
mean per document weighted by letters.

Edge cases: null text and texts without a letter get ``und`` and score 0, and so
does everything if there is nothing to learn from; documents with a null ``lang``
are scored but not learned from; equal scores go to the first language in code
point order; repeated rows are scored alike; an empty table gives no rows; columns
of the caller that are named like an added column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field as _field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiscore.llm.common import ROW, class_sample, field, fold, modest_batches, packed, unpacked

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    bins: int = 8192
    stretch: int = 2048
    landmarks: int = 192
    ridge: float = 1e-2
    sharpness: float = 4.0
    per_language: int = 300
    stretches_per_doc: int = 2


@dataclass
class Model:
    settings: Settings
    languages: list[str] = _field(default_factory=list)
    landmarks: np.ndarray | None = None      # bins x m, 0/1
    sizes: np.ndarray | None = None          # m
    weights: np.ndarray | None = None        # m x languages


_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Which code points are letters; made once in each process."""
    if not _tables:
        _tables["letters"] = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)
    return _tables["letters"]


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text with everything but letters as a space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    return np.where(_letters()[codes], codes, 32)


def presence(codes: np.ndarray, starts: np.ndarray, bins: int) -> np.ndarray:
    """0/1 matrix stretches x bins of the hashed n-grams; stretch i is codes[starts[i]:starts[i + 1]]."""
    out = np.zeros((len(starts) - 1, bins), np.float32)
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    gram = np.zeros(len(codes), np.uint64)
    for n in range(1, 4):
        m = len(codes) - n + 1
        if m <= 0:
            break
        gram = gram[:m] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:].astype(np.uint64) + np.uint64(n)
        mixed = gram * np.uint64(0xD6E8FEB86659FD93)
        index = ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(bins)).astype(np.int64)
        same = row[:m] == row[n - 1:]
        out[row[:m][same], index[same]] = 1
    return out


def _cuts(n: int, step: int) -> list[int]:
    """Bounds of stretches of about ``step``, the last not shorter than half of it."""
    k = max(1, round(n / step))
    return [n * i // k for i in range(k + 1)]


def fit(texts: list[str], languages: list[str], settings: Settings = Settings()) -> Model:
    """Nyström features and one-versus-rest ridge regression on labelled stretches."""
    if not texts:
        return Model(settings)
    names = sorted(set(languages))
    y = np.array([names.index(x) for x in languages])
    # the same number of landmarks from every language, as they come
    rank = np.zeros(len(y), int)
    for k in range(len(names)):
        rank[y == k] = np.arange((y == k).sum())
    chosen = np.sort(np.lexsort((y, rank))[:max(settings.landmarks, len(names))])

    def grams(some: list[str]) -> np.ndarray:
        return np.concatenate([presence(c, np.array([0, len(c)]), settings.bins) for c in map(letter_codes, some)])

    marks = grams([texts[i] for i in chosen])
    sizes = np.maximum(marks.sum(1), 1)
    k_nm = np.empty((len(texts), len(chosen)), np.float32)
    for i in range(0, len(texts), 256):                      # as many n-gram rows at a time, however many languages
        x = grams(texts[i:i + 256])
        k_nm[i:i + 256] = x @ marks.T / np.sqrt(np.outer(np.maximum(x.sum(1), 1), sizes))
    values, vectors = np.linalg.eigh(k_nm[chosen].astype(np.float64))
    inverse = np.where(values > 1e-6 * values.max(), 1 / np.sqrt(np.maximum(values, 1e-12)), 0)
    root = (vectors * inverse) @ vectors.T
    z = k_nm @ root
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    share = np.bincount(y, minlength=len(names)) / len(y)
    weight = (1 / share)[y]                                  # languages count alike
    gram = (z * weight[:, None]).T @ z + settings.ridge * len(y) * np.eye(len(chosen)) / 100
    beta = np.linalg.solve(gram, (z * weight[:, None]).T @ target)
    return Model(settings, names, marks.T.astype(np.uint8), sizes, (root @ beta).astype(np.float32))


def score(texts: pd.Series, model: Model, batch: int = 256) -> pd.DataFrame:
    """``lang_pred, score`` of each text, in batches of stretches."""
    s, lab = model.settings, [UNKNOWN] * len(texts)
    best = np.zeros(len(texts))
    if model.languages:
        landmarks = model.landmarks.astype(np.float32)
        total = np.zeros((len(texts), len(model.languages)))
        letters = np.zeros(len(texts))
        codes: list[np.ndarray] = []
        owner: list[int] = []

        def flush() -> None:
            if not codes:
                return
            starts = np.concatenate([[0], np.cumsum([len(c) for c in codes])])
            x = presence(np.concatenate(codes), starts, s.bins)
            k = x @ landmarks / np.sqrt(np.outer(np.maximum(x.sum(1), 1), model.sizes))
            n = np.array([(c != 32).sum() for c in codes], float)
            np.add.at(total, owner, (k @ model.weights) * n[:, None])
            np.add.at(letters, owner, n)
            codes.clear()
            owner.clear()

        for i, text in enumerate(texts):
            if not isinstance(text, str) or not text:
                continue
            c = letter_codes(text)
            cuts = _cuts(len(c), s.stretch)
            for a, b in zip(cuts, cuts[1:]):
                codes.append(c[a:b])
                owner.append(i)
                if len(codes) == batch:
                    flush()
        flush()
        known = letters > 0
        margin = total[known] / letters[known, None]
        e = np.exp(s.sharpness * (margin - margin.max(1, keepdims=True, initial=-np.inf)))
        share = e / e.sum(1, keepdims=True)
        best[known] = share.max(1, initial=0)
        for i, k in zip(np.flatnonzero(known), share.argmax(1) if len(share) else ()):
            lab[i] = model.languages[k]
    return pd.DataFrame({"lang_pred": lab, "score": best})


def training_sample(docs: DataFrame, settings: Settings) -> tuple[list[str], list[str]]:
    """Stretches of a bounded sample of the labelled documents and their languages."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), "text")
    keys = rows.select("_id", "_lang")                       # the texts are not read to pick the sample
    picked = class_sample(keys, "_lang", "_id", settings.per_language, "langid")

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, lang, text in zip(pdf["_id"], pdf["_lang"], pdf["text"]):
                cuts = _cuts(len(text), settings.stretch)
                k = min(settings.stretches_per_doc, len(cuts) - 1)
                for at in (len(cuts) - 1) * np.arange(k) // k:
                    part = text[cuts[at]:cuts[at + 1]]
                    if any(map(str.isalpha, part)):
                        out.append((i, lang, part))
            yield pd.DataFrame(out, columns=["_id", "_lang", "part"])

    # at most per_language rows a language: bounded, whatever the input; of rows sharing an id the smallest text
    one = rows.join(F.broadcast(picked.distinct()), ["_id", "_lang"]).groupBy("_id", "_lang").agg(F.min("text").alias("text"))
    sample = one.mapInPandas(stretches, "_id long, _lang string, part string")
    got = sorted((r["_id"] is None, r["_id"] or 0, r["part"], r["_lang"]) for r in sample.collect())
    return [g[2] for g in got], [g[3] for g in got]


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    return fit(*training_sample(docs, settings), settings)


def verdict(text: Column, model: Model) -> Column:
    """Struct of ``lang_pred`` and ``score`` of a text column."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return score(texts, model)

    return predict(text)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    modest_batches(docs.sparkSession)
    rows = packed(docs)
    rows = rows.select(ROW, verdict(field("text"), model).alias("_p"))
    return unpacked(rows, {"lang_pred": F.col("_p.lang_pred"), "score": F.col("_p.score")})


def held_out(doc_id: Column) -> Column:
    """True for the documents never learned from."""
    return fold(doc_id, 5) == 0
