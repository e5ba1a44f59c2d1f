"""Scalar column functions shared by the operators (all JVM-side expressions)."""

from entiscore.functions.text import (
    jvm_trim,
    normalize_columns,
    strip_newlines,
    strip_prefix,
    prefixed_code,
)
from entiscore.functions.numeric import safe_div, sigmoid, probability_of_one
from entiscore.functions.dates import run_day, day_column
from entiscore.functions.vectors import (
    feature_text_arrays,
    indices_text,
    to_sparse_vector,
    vector_elements,
)

__all__ = [
    "jvm_trim", "normalize_columns", "strip_newlines", "strip_prefix", "prefixed_code",
    "safe_div", "sigmoid", "probability_of_one", "run_day", "day_column",
    "feature_text_arrays", "indices_text", "to_sparse_vector", "vector_elements",
]
