"""Feature operators: thin, explicit wrappers over Spark ML transformers.

Each returns ``(transformed DataFrame, fitted stage)`` so the stage can go into
a pipeline or be saved.  Fits are distributed aggregates in Spark ML (counts
per label, column statistics); nothing is collected beyond the fitted
parameters.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.ml import Transformer
from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiscore.session import checkpointed


def assemble(df: DataFrame, input_cols: list[str], output_col: str = "features",
             label_col: str | None = None, handle_invalid: str = "error") -> tuple[DataFrame, Transformer]:
    """Numeric columns and vectors into one vector; the label may not be a feature."""
    if label_col is not None and label_col in input_cols:
        raise ValueError(f"label column {label_col!r} is in the feature list")
    va = VectorAssembler(inputCols=list(input_cols), outputCol=output_col, handleInvalid=handle_invalid)
    return va.transform(df), va


def index_labels(df: DataFrame, input_col: str = "label", output_col: str = "indexed_label",
                 order: str = "frequencyDesc") -> tuple[DataFrame, StringIndexerModel]:
    """Label → index, most frequent first (ties alphabetical)."""
    model = StringIndexer(inputCol=input_col, outputCol=output_col, stringOrderType=order).fit(df)
    return model.transform(df), model


def label_index_expr(col: Column | str, labels: list[str]) -> Column:
    """Index of ``col`` under fitted labels (for a second column, e.g. a predicted class)."""
    c = (F.col(col) if isinstance(col, str) else col).cast("string")
    expr = F.lit(None).cast("double")
    for i, lab in reversed(list(enumerate(labels))):
        expr = F.when(c == lab, F.lit(float(i))).otherwise(expr)
    return expr


def decode_labels(df: DataFrame, model: StringIndexerModel, input_col: str = "prediction",
                  output_col: str = "predicted_label") -> tuple[DataFrame, Transformer]:
    """Index → original label text, with the fitted indexer's labels."""
    its = IndexToString(inputCol=input_col, outputCol=output_col, labels=list(model.labels))
    return its.transform(df), its


def one_hot(df: DataFrame, input_col: str, output_col: str, drop_last: bool = True) -> tuple[DataFrame, Transformer]:
    """Index column → one-hot sparse vector (last category dropped by default)."""
    model = OneHotEncoder(inputCols=[input_col], outputCols=[output_col], dropLast=drop_last).fit(df)
    return model.transform(df), model


def standardize(df: DataFrame, input_col: str = "features", output_col: str = "scaled_features",
                with_std: bool = True, with_mean: bool = False) -> tuple[DataFrame, Transformer]:
    """Divide by the sample standard deviation (0 where it is 0); no centring by default."""
    model = StandardScaler(inputCol=input_col, outputCol=output_col, withStd=with_std,
                           withMean=with_mean).fit(df)
    return model.transform(df), model


def index_vector(df: DataFrame, input_col: str = "features", output_col: str = "indexed_features",
                 max_categories: int = 20) -> tuple[DataFrame, Transformer]:
    """Mark vector slots with few distinct values as categorical."""
    model = VectorIndexer(inputCol=input_col, outputCol=output_col, maxCategories=max_categories).fit(df)
    return model.transform(df), model


#: Slots a key split cuts [0, 1) into; weights are exact to one part in this many.
SLOTS = 100


def _slot(df: DataFrame, key: str, modulus: int):
    """``pmod(key, modulus)`` of integer keys, of the 64-bit hash for others; 0 for null."""
    dtype = dict(df.dtypes)[key]
    base = F.col(key) if dtype in ("int", "bigint", "smallint", "tinyint") else F.xxhash64(F.col(key))
    return F.coalesce(F.pmod(base, F.lit(modulus)), F.lit(0))


def split_by_key(df: DataFrame, key: str, weights: list[float], modulus: int = SLOTS) -> list[DataFrame]:
    """Deterministic split: the key's slot against cumulative weights.

    Every row falls in exactly one part (null keys in the first).  A part's bounds
    are compared as they are, unrounded; for parts below ``1 / modulus`` pass a
    larger ``modulus``.  Reproducible (unlike a random split), without a shuffle.
    """
    total = float(sum(weights))
    slot = _slot(df, key, modulus)
    edges, at = [0.0], 0.0
    for w in weights:
        at += w
        edges.append(round(at / total * modulus, 9))
    edges[-1] = float(modulus)
    return [df.where((slot >= F.lit(lo)) & (slot < F.lit(hi))) for lo, hi in zip(edges, edges[1:])]


def undersample(df: DataFrame, label_col: str, fractions: dict, seed: int = 42) -> DataFrame:
    """Stratified Bernoulli sample: keep ``fractions[c]`` of the rows of class c."""
    return df.sampleBy(label_col, fractions=fractions, seed=seed)


def undersample_by_key(df: DataFrame, label_col: str, fractions: dict, key: str,
                       modulus: int = SLOTS) -> DataFrame:
    """Deterministic form of :func:`undersample`: keep rows whose key's slot is below ``f * modulus``."""
    slot = _slot(df, key, modulus)
    keep = F.lit(False)
    lab = F.col(label_col)
    for cls, frac in fractions.items():
        keep = keep | ((lab == F.lit(cls)) & (slot < F.lit(round(frac * modulus, 9))))
    return df.where(keep)


def exact_fraction(df: DataFrame, key: str, fraction: float, few: int = 1_000_000) -> DataFrame:
    """Exactly ``floor(fraction * rows)`` rows of ``df``, those of the least hashes of ``key``.

    Repeatable, and nothing is sorted as a whole: a histogram of the hash's leading 16
    bits (one aggregate, at most 65,536 rows to the driver) tells the slot the cut falls in; all
    lower slots stay.  A slot of more than ``few`` rows is divided by the next 16 bits, then by a
    hash of the whole row, then (equal rows only) by a running number; the rest of the cut
    slot is sorted.  ``df`` is read several times: hand in a checkpointed frame.
    """
    want = math.floor(Fraction(str(fraction)) * df.count())
    row = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t]
    hashed = df.withColumns({"_h": F.xxhash64(F.col(key)), "_g": F.xxhash64(*row), "_i": F.monotonically_increasing_id()})
    below, inside = F.lit(False), F.lit(True)
    for name, shift in ((c, s) for c in ("_h", "_g", "_i") for s in (48, 32, 16, 0)):
        slot = F.shiftrightunsigned(name, shift).bitwiseAND(F.lit(65535).cast("long"))
        sizes = {r["s"]: r["n"] for r in hashed.where(inside).groupBy(slot.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
        cut = 65536                                  # all slots stay
        for s in sorted(sizes):
            if sizes[s] > want:
                cut = s
                break
            want -= sizes[s]
        below, inside = below | (inside & (slot < cut)), inside & (slot == cut)
        if not want or sizes.get(cut, 0) <= few:
            break
    taken = hashed.where(below)
    if want:
        taken = taken.unionByName(hashed.where(inside).orderBy("_h", "_g", "_i").limit(want))
    return taken.drop("_h", "_g", "_i")


def undersample_correct(predictions: DataFrame, key: str, fraction: float = 0.3, indexed_label_col: str = "indexed_label",
                        prediction_col: str = "prediction") -> DataFrame:
    """Undersampling after a model has spoken: of the majority class (index 0) only the rows predicted
    right, and of those exactly ``fraction``; every row of class 1."""
    lab = F.col(indexed_label_col).cast("double")
    kept = checkpointed(predictions.where(((lab == 0.0) & (F.col(prediction_col).cast("double") == lab)) | (lab == 1.0)))
    return exact_fraction(kept.where(lab == 0.0), key, fraction).unionByName(kept.where(lab == 1.0))
