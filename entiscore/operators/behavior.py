"""Behaviour operators: top-K items, pair parsing, used items, entity features.

Inputs are DataFrames with named columns:

* items: ``item_id``, ``item_name``, ``installs`` (one row per item)
* behaviour text: ``entity_id``, ``text`` (``"code:value code:value"``), any
  number of rows per entity
* pairs (parsed): ``entity_id``, ``item_code``, ``value``

Scale notes: the only things broadcast are the top-K item list and the used
item list, both bounded by K.  Per-entity aggregation collects a *set* of
column indexes, which is bounded by K whatever the entity's row count, and
the set aggregate combines partially before the shuffle, so a hot entity
ships at most K indexes per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entiscore.functions.text import jvm_trim, prefixed_code, rtrim_chars, strip_newlines, strip_prefix
from entiscore.functions.literals import long_array
from entiscore.functions.vectors import indices_text
from entiscore.operators.cumulative import ONE_TASK, dense_index
from entiscore.session import checkpointed

PAIR_SEPARATOR = " "
VALUE_SEPARATOR = ":"

# Token outcomes of the pair parser.
STATUS_OK = "ok"
STATUS_EMPTY = "empty"
STATUS_ARITY = "arity"
STATUS_EMPTY_CODE = "empty_code"
STATUS_BAD_NUMBER = "bad_number"


def top_k_items(items: DataFrame, k: int = 1000, prefix: str = "",
                id_col: str = "item_id", name_col: str = "item_name",
                installs_col: str = "installs") -> DataFrame:
    """The ``k`` items with most installs.

    Order is total: installs, then code, then name, all descending.  Planned as
    ``TakeOrderedAndProject`` (per-partition top-k, then one merge of k rows
    per partition), never a full sort.
    """
    norm = items.select(
        prefixed_code(prefix, strip_newlines(F.col(id_col).cast("string"))).alias("item_code"),
        jvm_trim(strip_newlines(F.col(name_col).cast("string"))).alias("item_name"),
        F.col(installs_col).cast("long").alias("installs"),
    )
    return norm.orderBy(F.desc("installs"), F.desc("item_code"), F.desc("item_name")).limit(int(k))


# Control characters at a token edge — what the per-token JVM trim removes.
# One regex per text row replaces a trim per token: tokens come from a split on
# single spaces, so they never carry edge spaces themselves.
_EDGE_CONTROL = r"(?<=^| )[\x00-\x1f]+|[\x00-\x1f]+(?= |$)"


def _token_parts(token):
    """Per-token pieces: (colon count, code, value text).

    Trailing ``:`` are dropped first (the JVM split drops trailing empty
    parts; a part of control characters only is not empty there and still
    counts); "exactly two parts" is then "exactly one colon".  Code and value
    are trimmed like the JVM trims each part.
    """
    core = rtrim_chars(token, VALUE_SEPARATOR)
    colons = F.length(core) - F.length(F.replace(core, F.lit(VALUE_SEPARATOR), F.lit("")))
    code = jvm_trim(F.substring_index(core, VALUE_SEPARATOR, 1))
    value_text = jvm_trim(F.substring_index(core, VALUE_SEPARATOR, -1))
    return colons, code, value_text


def _explode_tokens(behavior: DataFrame, entity_col: str, text_col: str) -> DataFrame:
    text = F.regexp_replace(F.col(text_col), _EDGE_CONTROL, "")
    return behavior.select(
        jvm_trim(F.col(entity_col).cast("string")).alias("entity_id"),
        F.explode(F.split(text, PAIR_SEPARATOR)).alias("token"),
    )


def pair_tokens(behavior: DataFrame, entity_col: str = "entity_id", text_col: str = "text") -> DataFrame:
    """Explode behaviour text into classified tokens.

    Returns ``entity_id, token, item_code, value_text, value, status``.  A token
    is trimmed, trailing ``:`` are dropped, and it must then have exactly two
    ``:``-separated parts with a non-empty code and a numeric value.
    """
    exploded = _explode_tokens(behavior, entity_col, text_col)
    colons, code, value_text = _token_parts(F.col("token"))
    staged = exploded.select("entity_id", "token", F.col("token").alias("_tok"), colons.alias("_n"),
                             code.alias("item_code"), value_text.alias("value_text"))
    staged = staged.withColumn("value", F.col("value_text").try_cast("double"))
    status = (
        F.when(F.col("_tok") == "", F.lit(STATUS_EMPTY))
        .when(F.col("_n") != 1, F.lit(STATUS_ARITY))
        .when(F.col("item_code") == "", F.lit(STATUS_EMPTY_CODE))
        .when(F.col("value").isNull(), F.lit(STATUS_BAD_NUMBER))
        .otherwise(F.lit(STATUS_OK))
    )
    return staged.withColumn("status", status).drop("_tok", "_n")


def parse_pairs(behavior: DataFrame, lenient: bool = False, entity_col: str = "entity_id",
                text_col: str = "text") -> DataFrame:
    """``(entity_id, item_code, value)`` for every well-formed ``code:value`` token.

    Strict mode (default) fails the job on a value that is not a number, as the
    text-to-number conversion does; lenient mode drops such tokens.  Narrow:
    a ``Generate`` and string scans inside whole-stage codegen, no shuffle.
    """
    exploded = _explode_tokens(behavior, entity_col, text_col)
    colons, code, value_text = _token_parts(F.col("token"))
    staged = exploded.select("entity_id", "token", colons.alias("_n"), code.alias("item_code"),
                             value_text.alias("_v"))
    kept = staged.where((F.col("_n") == 1) & (F.col("item_code") != ""))
    parsed = F.col("_v").try_cast("double")
    if lenient:
        return kept.select("entity_id", "item_code", parsed.alias("value")).where(F.col("value").isNotNull())
    value = F.when(parsed.isNull(), F.raise_error(F.concat(F.lit("not a number in pair: "), F.col("token")))
                   ).otherwise(parsed)
    return kept.select("entity_id", "item_code", value.cast("double").alias("value"))


def malformed_pairs(behavior: DataFrame, entity_col: str = "entity_id", text_col: str = "text") -> DataFrame:
    """Tokens the parser rejects, with the reason (data-quality report)."""
    return (pair_tokens(behavior, entity_col, text_col)
            .where(F.col("status") != STATUS_OK)
            .select("entity_id", "token", "status"))


def _top_order():
    return [F.desc("installs"), F.desc("item_code"), F.desc("item_name")]


def _ordered(df: DataFrame, order: list, output_col: str, k: int | None) -> DataFrame:
    """Adds the 0-based place in ``order``: a window over the whole (≤ K rows), or a range-wise
    index where ``k`` says that one task should not sort them all."""
    if k is not None and k > ONE_TASK:
        return dense_index(df, order, output_col)
    return df.withColumn(output_col, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))


def used_items(top_items: DataFrame, pairs: DataFrame, prefix_len: int = 2, k: int | None = None) -> DataFrame:
    """Top items that occur in behaviour, with a dense 0-based column index.

    The index follows the top-K order (installs, code, name descending), so it
    is stable run to run.  ``dim_code`` is the code without its prefix, as
    published in the item dimension.

    Plan: behaviour codes are semi-joined against the top-K codes (broadcast by
    Catalyst when the list is as small as a top-K list is), de-duplicated with a
    partial aggregate (at most K keys per task) and only then shuffled; the index
    window runs over at most K rows, or by ranges where ``k`` (the K of the list) is large.
    """
    top = top_items.select("item_code", "item_name", "installs")
    seen = (pairs.select("item_code")
            .join(top.select("item_code"), "item_code", "left_semi")
            .distinct())
    used = _ordered(top.join(seen, "item_code", "left_semi"), _top_order(), "column_index", k)
    return used.select("item_code", strip_prefix("item_code", prefix_len).alias("dim_code"), "item_name", "column_index")


def entity_item_indices(pairs: DataFrame, used: DataFrame, value_mode: str = "binary") -> DataFrame:
    """Per entity: sorted distinct column indexes (and summed values for ``sum``).

    Returns ``entity_id, indices array<bigint>, values array<double>``.
    """
    dims = used.select("item_code", "column_index")
    joined = pairs.join(dims, "item_code")
    if value_mode == "binary":
        agg = joined.groupBy("entity_id").agg(F.array_sort(F.collect_set("column_index")).alias("indices"))
        return agg.withColumn("values", F.transform("indices", lambda _: F.lit(1.0)))
    if value_mode == "sum":
        per_pair = joined.groupBy("entity_id", "column_index").agg(F.sum("value").alias("value"))
        agg = per_pair.groupBy("entity_id").agg(
            F.array_sort(F.collect_list(F.struct("column_index", "value"))).alias("_p"))
        return agg.select("entity_id",
                          F.transform("_p", lambda s: s["column_index"]).alias("indices"),
                          F.transform("_p", lambda s: s["value"]).alias("values"))
    raise ValueError(f"value_mode must be 'binary' or 'sum', got {value_mode!r}")


def user_item_features(pairs: DataFrame, used: DataFrame, value_mode: str = "binary",
                       keep_arrays: bool = False) -> DataFrame:
    """One ``idx:val idx:val`` feature text per entity, indexes ascending.

    ``binary`` (default) writes ``:1`` for every item the entity used, the
    behaviour value is ignored; ``sum`` writes the summed values instead.
    """
    arr = entity_item_indices(pairs, used, value_mode)
    if value_mode == "binary":
        text = indices_text("indices")
    else:
        text = F.array_join(F.transform(F.arrays_zip("indices", "values"),
                                        lambda s: F.concat(s["indices"].cast("string"), F.lit(":"),
                                                           s["values"].cast("string"))), " ")
    out = arr.withColumn("features", text)
    cols = ["entity_id", "features"] + (["indices", "values"] if keep_arrays else [])
    return out.select(*cols)


# ----------------------------------------------------------------- one-pass build

def rank_items(top_items: DataFrame, k: int | None = None) -> DataFrame:
    """Top-K items with their 0-based rank in top-K order (≤ K rows)."""
    ranked = _ordered(top_items.select("item_code", "item_name", "installs"), _top_order(), "top_rank", k)
    return ranked.withColumn("top_rank", F.col("top_rank").cast("int"))


def entity_top_ranks(pairs: DataFrame, ranked: DataFrame, value_mode: str = "binary") -> DataFrame:
    """Per entity: sorted distinct top-K ranks of the items it used (≤ K each); with
    ``sum`` also the summed ``values``."""
    j = pairs.join(ranked.select("item_code", "top_rank"), "item_code")
    if value_mode == "binary":
        return j.groupBy("entity_id").agg(F.array_sort(F.collect_set("top_rank")).alias("ranks"))
    if value_mode != "sum":
        raise ValueError(f"value_mode must be 'binary' or 'sum', got {value_mode!r}")
    summed = j.groupBy("entity_id", "top_rank").agg(F.sum("value").alias("value"))
    p = summed.groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct("top_rank", "value"))).alias("_p"))
    return p.select("entity_id", F.col("_p.top_rank").alias("ranks"), F.col("_p.value").alias("values"))


def build_item_features(pairs: DataFrame, top_items: DataFrame, prefix_len: int = 2,
                        materialize: bool = True, value_mode: str = "binary",
                        k: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Used items and entity features from **one** pass over the behaviour.

    The top-K list (≤ K rows) is written once.  The raw pairs are read once:
    joined to the broadcast top-K and
    reduced to one sorted rank set per entity, which is written with
    ``checkpoint()``.  Used items are the distinct ranks of that (much smaller)
    table; the dense column index of each rank is a ≤ K-entry literal array, so
    the final features are a narrow ``transform`` with no second join.

    Returns ``(used, features)`` with the same rows as :func:`used_items` and
    :func:`user_item_features` in the same ``value_mode``.
    """
    ranked = rank_items(top_items, k)
    if materialize:
        # ≤ K rows, but they summarise a scan of the whole item source: written
        # once so the later jobs (used items, index lookup, weights) reuse them.
        ranked = checkpointed(ranked)
    per_entity = entity_top_ranks(pairs, ranked, value_mode)
    if materialize:
        per_entity = checkpointed(per_entity)
    seen = per_entity.select(F.explode("ranks").alias("top_rank")).distinct()
    used_ranked = ranked.join(F.broadcast(seen), "top_rank", "left_semi")
    used = _ordered(used_ranked, [F.asc("top_rank")], "column_index", k).select(
        "item_code", strip_prefix("item_code", prefix_len).alias("dim_code"), "item_name", "column_index", "top_rank")
    pairs_list = used.select("top_rank", "column_index").collect()        # ≤ K rows
    slots = [-1] * (max([r["top_rank"] for r in pairs_list], default=-1) + 1)
    for r in pairs_list:
        slots[r["top_rank"]] = int(r["column_index"])
    lookup = long_array(slots)
    idx = F.transform("ranks", lambda r: F.element_at(lookup, r + 1))
    if value_mode == "binary":
        features = per_entity.select("entity_id", idx.alias("indices")).select(
            "entity_id", indices_text("indices").alias("features"), "indices")
    else:
        text = F.array_join(F.zip_with("indices", "values", lambda i, v: F.concat(i.cast("string"), F.lit(":"), v.cast("string"))), " ")
        features = per_entity.select("entity_id", idx.alias("indices"), "values").select(
            "entity_id", text.alias("features"), "indices", "values")
    return used.drop("top_rank"), features
