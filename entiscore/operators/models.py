"""Model operators over Spark ML: trees, forests, logistic models, k-means, CV.

Training is Spark ML's distributed implementation (tree aggregates); scoring is
``model.transform`` (the model is broadcast once per task).  Class-1 scores are
read out of the probability vector in the JVM.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.functions.literals import double_array, double_matrix
from entiscore.functions.numeric import probability_of_one, sigmoid
from entiscore.session import checkpointed, scratch_path


def train_forest(train: DataFrame, label_col: str = "label", features_col: str = "features",
                 num_trees: int = 10, max_depth: int = 5, max_bins: int = 32, impurity: str = "gini",
                 subset: str = "auto", seed: int = 42):
    rf = RandomForestClassifier(labelCol=label_col, featuresCol=features_col, numTrees=num_trees,
                                maxDepth=max_depth, maxBins=max_bins, impurity=impurity,
                                featureSubsetStrategy=subset, seed=seed)
    return rf.fit(train)


def train_tree(train: DataFrame, label_col: str = "label", features_col: str = "features",
               max_depth: int = 15, max_bins: int = 100, seed: int = 42):
    dt = DecisionTreeClassifier(labelCol=label_col, featuresCol=features_col, maxDepth=max_depth,
                                maxBins=max_bins, seed=seed)
    return dt.fit(train)


def logistic(label_col: str = "label", features_col: str = "features", reg_param: float = 0.0,
             max_iter: int = 100, fit_intercept: bool = False, tol: float = 1e-6) -> LogisticRegression:
    """Logistic regression; defaults follow the LBFGS trainer: no intercept, no regularisation."""
    return LogisticRegression(labelCol=label_col, featuresCol=features_col, regParam=reg_param,
                              maxIter=max_iter, fitIntercept=fit_intercept, tol=tol)


def train_logistic(train: DataFrame, **params):
    return logistic(**params).fit(train)


def train_cv(train: DataFrame, estimator, grid: dict, evaluator=None, folds: int = 3,
             seed: int = 42, parallelism: int = 1) -> CrossValidatorModel:
    """Cross-validated fit over a parameter grid ``{param: [values]}``."""
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(param, list(values))
    evaluator = evaluator or BinaryClassificationEvaluator(labelCol=estimator.getLabelCol())
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=builder.build(), evaluator=evaluator,
                        numFolds=folds, seed=seed, parallelism=parallelism)
    return cv.fit(train)


def score(model: Transformer, df: DataFrame, keep: list[str] | None = None,
          probability_col: str = "probability") -> DataFrame:
    """``model.transform`` plus ``score`` = class-1 probability."""
    out = model.transform(df)
    cols = (keep or []) + ["prediction"]
    if probability_col in out.columns:
        out = out.withColumn("score", probability_of_one(probability_col))
        cols.append("score")
    return out.select(*[c for c in dict.fromkeys(cols)])


def describe_model(model) -> str:
    """Model text (tree structure where there is one)."""
    if hasattr(model, "toDebugString"):
        return model.toDebugString
    return str(model)


def feature_importances(model, spark) -> DataFrame:
    """``feature, importance`` of a tree model (one row per vector slot with weight)."""
    imp = model.featureImportances                       # vector of the model's dimension
    rows = [(int(i), float(v)) for i, v in zip(imp.indices, imp.values)] if hasattr(imp, "indices") \
        else [(i, float(v)) for i, v in enumerate(imp.toArray()) if v != 0.0]
    return spark.createDataFrame(rows, "feature int, importance double")


def tree_nodes(model, spark) -> DataFrame:
    """The nodes of a decision tree or of a forest's trees as a relation, read from the model's own saved data.

    ``tree, node, parent, is_left, feature, threshold, left_categories, gain, impurity, prediction, rows``.  A
    leaf has no feature; a continuous split goes left at ``<= threshold``, a categorical one if the value is
    among ``left_categories``.  ``rows`` is the (weighted) number of training rows in the node.
    """
    path = scratch_path(spark, "tree-nodes")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    inner = F.col("leftChild") >= 0
    left = F.col("split.leftCategoriesOrThreshold")
    continuous = F.col("split.numCategories") == -1
    nodes = data.select(
        "tree", F.col("id").alias("node"), "leftChild", "rightChild",
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & continuous, F.get(left, F.lit(0))).alias("threshold"),
        F.when(inner & ~continuous, left).alias("left_categories"),
        F.when(inner, F.col("gain")).alias("gain"), "impurity", "prediction",
        F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x).alias("rows"))
    sides = [nodes.where(inner).select("tree", F.col(child).alias("node"), F.col("node").alias("parent"),
                                       F.lit(child == "leftChild").alias("is_left")) for child in ("leftChild", "rightChild")]
    return nodes.drop("leftChild", "rightChild").join(sides[0].unionByName(sides[1]), ["tree", "node"], "left").select(
        "tree", "node", "parent", "is_left", "feature", "threshold", "left_categories", "gain", "impurity", "prediction", "rows")


def tree_rules(nodes: DataFrame) -> DataFrame:
    """``tree, node, depth, rule`` of :func:`tree_nodes`: the conditions from the root down, joined by AND.

    One join a level, all trees at once; a level is written before the next one.
    """
    nodes = checkpointed(nodes)
    up = nodes.where("feature IS NOT NULL").select("tree", F.col("node").alias("parent"), "feature", "threshold", "left_categories")
    among = F.array_join(F.transform("left_categories", lambda c: c.cast("string")), ", ")
    name = F.concat(F.lit("feature "), F.col("feature").cast("string"))
    said = F.when(F.col("threshold").isNotNull(), F.concat(
        name, F.when(F.col("is_left"), F.lit(" <= ")).otherwise(F.lit(" > ")), F.col("threshold").cast("string")
    )).otherwise(F.concat(name, F.when(F.col("is_left"), F.lit(" in {")).otherwise(F.lit(" not in {")), among, F.lit("}")))
    steps = checkpointed(nodes.where("parent IS NOT NULL").select("tree", "node", "parent", "is_left").join(
        up, ["tree", "parent"]).select("tree", "node", "parent", said.alias("step")))
    level = nodes.where("parent IS NULL").select("tree", "node", F.lit(0).alias("depth"), F.lit("").alias("rule"))
    out = level
    while True:
        above = level.select("tree", F.col("node").alias("parent"), "depth", "rule")
        level = checkpointed(steps.join(above, ["tree", "parent"]).select(
            "tree", "node", (F.col("depth") + 1).alias("depth"),
            F.when(F.col("rule") == "", F.col("step")).otherwise(F.concat_ws(" AND ", "rule", "step")).alias("rule")))
        if level.isEmpty():
            return out
        out = out.unionByName(level)


def save_model(model, path: str) -> str:
    """Save, replacing whatever is at ``path``."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str, kind=PipelineModel):
    return kind.load(path)


# --------------------------------------------------------------------------- k-means

def fit_kmeans(vectors: DataFrame, k: int, max_iter: int = 10, seed: int = 1,
               features_col: str = "features"):
    return KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features_col).fit(vectors)


def kmeans_centers(vectors: DataFrame, k: int = 4, max_iter: int = 10, seed: int = 1,
                   features_col: str = "features") -> DataFrame:
    """Fitted centres: ``center_id, center array<double>, center_text`` (``a:b:c``)."""
    model = fit_kmeans(vectors, k, max_iter, seed, features_col)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]  # k rows
    df = vectors.sparkSession.createDataFrame(rows, "center_id int, center array<double>")
    return df.withColumn("center_text", F.array_join(F.transform("center", lambda x: x.cast("string")), ":"))


def centre_costs(vectors: DataFrame, centre_sets: dict[str, list[list[float]]], features_col: str = "features") -> DataFrame:
    """One row, one column a set of centres: the sum over all rows of the squared distance to the nearest of them.

    All sets are assigned in one pass over the rows and added up in one aggregate.  The centres are
    model parameters (k rows a set) and become literals.
    """
    x = vector_to_array(F.col(features_col)).alias("x")
    sums = []
    for name, centres in centre_sets.items():
        far = F.transform(double_matrix(centres), lambda c: F.aggregate(
            F.zip_with("x", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v))
        sums.append(F.coalesce(F.sum(F.array_min(far)), F.lit(0.0)).alias(name))
    return vectors.select(x).agg(*sums)


def kmeans_cost_sweep(vectors: DataFrame, ks=(2, 3, 4, 5, 6), max_iter: int = 10, seed: int = 1,
                      features_col: str = "features", parallelism: int = 4) -> DataFrame:
    """``k, cost, trained_cost``: within-cluster sum of squares for each k, largest cost first.

    The fits are independent Spark jobs; up to ``parallelism`` of them are
    submitted at once (as cross-validation does), each seeded, so the result
    does not depend on the order they finish in.  ``cost`` is that of the fitted centres, of all
    fits in one pass; ``trained_cost`` is what each fit saw before its last move of the centres.
    """
    from concurrent.futures import ThreadPoolExecutor

    def fitted(k):
        model = fit_kmeans(kept, k, max_iter, seed, features_col)
        return [[float(x) for x in c] for c in model.clusterCenters()], float(model.summary.trainingCost)

    kept = vectors.select(features_col).persist(StorageLevel.DISK_ONLY)    # read by every fit
    try:
        with ThreadPoolExecutor(max_workers=max(1, min(int(parallelism), len(ks)))) as pool:
            models = dict(zip(ks, pool.map(fitted, ks)))
        costs = centre_costs(kept, {f"k{k}": centres for k, (centres, _) in models.items()}, features_col).first()
    finally:
        kept.unpersist()
    rows = [(int(k), float(costs[f"k{k}"]), trained) for k, (_, trained) in models.items()]
    df = vectors.sparkSession.createDataFrame(rows, "k int, cost double, trained_cost double")
    return df.orderBy(F.desc("cost"))


def kmeans_assign(vectors: DataFrame, centers: list[list[float]], array_col: str = "embedding") -> DataFrame:
    """Nearest of the given centres (squared distance, lowest id on ties).

    The centre list is a model parameter (k rows); the distance is a JVM
    expression over array columns, so no UDF and no join.
    """
    cent = double_matrix(centers)
    x = F.col(array_col).cast("array<double>")
    dists = F.transform(cent, lambda c: F.aggregate(
        F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v))
    best = F.array_min(F.transform(dists, lambda d, i: F.struct(d.alias("d"), i.alias("i"))))
    return vectors.withColumn("cluster", best["i"].cast("int")).withColumn("distance", best["d"])


#: Weight tables become one array literal up to this many feature slots, and a join beyond.
MOST_SLOTS = 100_000


def logistic_score(entity_indices: DataFrame, weights: DataFrame, entity_col: str = "entity_id",
                   indices_col: str = "indices", values_col: str | None = None,
                   intercept: float = 0.0, most_slots: int = MOST_SLOTS) -> DataFrame:
    """``sigmoid(intercept + Σ w[i]·x[i])`` per entity for a weight table ``(column_index, weight)``.

    A table whose slots lie below ``most_slots`` becomes an array literal, and each entity is scored
    by one narrow expression over its own indices; any larger one is joined
    (:func:`logistic_score_join`), with the same result.  Slots without a weight count 0, and the weights of a
    slot listed twice add up.  An entity without indices scores ``sigmoid(intercept)``.
    """
    top = weights.agg(F.max(F.col("column_index").cast("long")).alias("top"), F.count(F.lit(1)).alias("n")).first()
    if max(top["top"] or 0, top["n"]) > most_slots:
        return logistic_score_join(entity_indices, weights, entity_col, indices_col, values_col, intercept)
    rows = weights.select(F.col("column_index").cast("long").alias("i"), F.col("weight").cast("double").alias("w")
                          ).where("i >= 0 AND w IS NOT NULL").collect()          # at most most_slots
    table = [0.0] * (max((r["i"] for r in rows), default=-1) + 1)
    for r in rows:
        table[r["i"]] += r["w"]
    w = double_array(table)
    weight = lambda i: F.coalesce(F.get(w, i.cast("int")), F.lit(0.0))
    none = F.array().cast("array<int>")
    if values_col is None:
        terms = F.transform(F.coalesce(F.col(indices_col), none), weight)
    else:
        terms = F.zip_with(F.coalesce(F.col(indices_col), none), F.coalesce(F.col(values_col), F.array().cast("array<double>")),
                           lambda i, v: weight(i) * F.coalesce(v.cast("double"), F.lit(0.0)))
    m = F.lit(float(intercept)) + F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    scored = entity_indices.select(entity_col, m.alias("margin"))
    return scored.select(entity_col, "margin", sigmoid("margin").alias("score"))


def _slots(rows: DataFrame, indices_col: str, values_col: str | None, *keep: str) -> DataFrame:
    """``keep…, column_index, x``: one row for every index of every row (its value, or 1)."""
    index = F.coalesce(F.col(indices_col).cast("array<long>"), F.array().cast("array<long>"))
    if values_col is None:
        return rows.select(*keep, F.explode(index).alias("column_index")).withColumn("x", F.lit(1.0))
    value = F.coalesce(F.col(values_col).cast("array<double>"), F.array().cast("array<double>"))
    pairs = rows.select(*keep, F.explode(F.arrays_zip(index.alias("i"), value.alias("x"))).alias("_p"))
    return pairs.select(*keep, F.col("_p.i").alias("column_index"), F.coalesce("_p.x", F.lit(0.0)).alias("x"))


def logistic_score_join(entity_indices: DataFrame, weights: DataFrame, entity_col: str = "entity_id",
                        indices_col: str = "indices", values_col: str | None = None, intercept: float = 0.0) -> DataFrame:
    """:func:`logistic_score` for any number of feature slots: a distributed sparse product.

    Indices are exploded, joined to the weight table on the slot (no hint: the join is sort-merge, split
    where a slot is hot, unless the table turns out small) and added up by row, partial sums first.
    Rows are numbered and written once, so rows sharing an entity keep a score each.
    """
    numbered = checkpointed(entity_indices.withColumn("_row", F.monotonically_increasing_id()))
    table = weights.select(F.col("column_index").cast("long").alias("column_index"),
                           F.col("weight").cast("double").alias("w")).groupBy("column_index").agg(F.sum("w").alias("w"))
    sums = _slots(numbered, indices_col, values_col, "_row").join(table, "column_index").groupBy("_row").agg(
        F.sum(F.col("x") * F.col("w")).alias("m"))
    scored = numbered.select("_row", entity_col).join(sums, "_row", "left").select(
        entity_col, (F.lit(float(intercept)) + F.coalesce("m", F.lit(0.0))).alias("margin"))
    return scored.select(entity_col, "margin", sigmoid("margin").alias("score"))


def logistic_gradient(scored: DataFrame, label_col: str = "label", score_col: str = "score", indices_col: str = "indices",
                      values_col: str | None = None, reg_param: float = 0.0, weights: DataFrame | None = None) -> DataFrame:
    """``column_index, gradient, n_rows``: the slope of the mean logistic loss along each feature slot.

    One sparse aggregate over the training rows, ``sum(x_j (p - y)) / rows``; with ``reg_param`` and the weight
    table the ridge term ``reg_param * w_j`` is added.  At the optimum it is 0 in every slot.
    """
    total = scored.agg(F.count(F.lit(1)).alias("_all"))                   # one row
    rest = scored.select((F.col(score_col) - F.col(label_col)).alias("_rest"), *[c for c in (indices_col, values_col) if c])
    sums = _slots(rest, indices_col, values_col, "_rest").groupBy("column_index").agg(
        F.sum(F.col("x") * F.col("_rest")).alias("_g"), F.count(F.lit(1)).alias("n_rows"))
    mean = F.col("_g") / total.scalar()
    if reg_param and weights is not None:
        sums = sums.join(weights.select(F.col("column_index").cast("long").alias("column_index"), "weight"), "column_index", "left")
        mean = mean + F.lit(float(reg_param)) * F.coalesce("weight", F.lit(0.0))
    return sums.select("column_index", mean.alias("gradient"), "n_rows")
