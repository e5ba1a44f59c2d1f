"""Text column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Java's String.trim removes every character up to U+0020 (control characters
# included); Spark's trim removes spaces only.  btrim with an explicit set is a
# plain character scan (no regex).
_EDGE_CHARS = "".join(chr(i) for i in range(0x21))


def jvm_trim(col: Column | str) -> Column:
    """Trim spaces and control characters from both ends."""
    return F.btrim(F.col(col) if isinstance(col, str) else col, F.lit(_EDGE_CHARS))


def rtrim_chars(col: Column | str, chars: str) -> Column:
    """Remove any of ``chars`` from the right end.

    Spark SQL's two-argument ``rtrim`` takes the character set first.
    """
    return F.call_function("rtrim", F.lit(chars), F.col(col) if isinstance(col, str) else col)


def strip_newlines(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, "\n", "")


def normalize_columns(df: DataFrame, cols: list[str] | None = None,
                      null_text: str | None = None) -> DataFrame:
    """Cast the named columns to text, drop newlines and trim them.

    Named-column form of turning a row into delimited text and splitting it
    again; ``null_text`` reproduces the text a null would turn into.
    """
    cols = cols or df.columns
    out = []
    for name in df.columns:
        if name in cols:
            c = jvm_trim(strip_newlines(F.col(name).cast("string")))
            if null_text is not None:
                c = F.coalesce(c, F.lit(null_text))
            out.append(c.alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def prefixed_code(prefix: str, col: Column | str) -> Column:
    """``prefix + trim(id)`` item code."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit(prefix), jvm_trim(c.cast("string")))


def strip_prefix(col: Column | str, n: int = 2) -> Column:
    """Drop the first ``n`` characters when the text is longer than ``n``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.length(c) > n, c.substr(F.lit(n + 1), F.length(c) - n)).otherwise(c)
