"""End-to-end jobs wired from the operators.

* :func:`behavior_model_job` — top-K items → parsed behaviour → item dimension
  and entity features (each written to its day partition) → train/predict
  split → logistic model with threshold sweep and positive pruning → final
  classes written to the day partition.
* :func:`tree_refit_job` — labels ⋈ features → vectors → label index,
  scaler, tree pipeline → AUC and accuracy → error-dropping refits.
* :func:`credit_forest_job` — numeric table → group-by profile → assembled
  vector → random forest → accuracy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiscore.functions.numeric import probability_of_one
from entiscore.functions.vectors import feature_text_arrays, to_sparse_vector
from entiscore.operators import behavior as B
from entiscore.operators import features as FE
from entiscore.operators import labels as L
from entiscore.operators import metrics as M
from entiscore.operators import models as MO
from entiscore.operators.training import retrain_dropping_errors, train_with_pruning
from entiscore.sources.readers import read_partition
from entiscore.sources.sinks import overwrite_partition
from entiscore.session import checkpointed


@dataclass
class BehaviorJobResult:
    threshold: float
    gmean: float
    dimension: int
    predictions: DataFrame
    report: DataFrame
    rounds_run: int


def behavior_model_job(spark: SparkSession, items: DataFrame, behavior: DataFrame, labels: DataFrame,
                       day: str, out_root: str, k: int = 1000, prefix: str = "12", rounds: int = 10,
                       class_names: tuple[str, str] = ("1", "0"), holdout: float = 0.2) -> BehaviorJobResult:
    """The batch behaviour model of one day (tables under ``out_root``)."""
    root = out_root.rstrip("/")
    top = B.top_k_items(items, k, prefix)
    pairs = B.parse_pairs(behavior)
    # One pass over the raw behaviour: per-entity rank sets are checkpointed,
    # used items and dense indexes come from them.
    used, feats = B.build_item_features(pairs, top, prefix_len=len(prefix))
    used = checkpointed(used)                               # ≤ k rows
    overwrite_partition(used.select(F.col("dim_code").alias("code"), F.col("item_name").alias("name"),
                                    "column_index"), f"{root}/items", day)
    dim = used.count()
    overwrite_partition(feats.select("entity_id", "features"), f"{root}/features", day)
    # Re-read the written partition: it is the lineage cut for everything below.
    written = read_partition(spark, f"{root}/features", day).drop("stat_date")
    idx, _ = feature_text_arrays("features")
    written = written.withColumn("indices", idx)

    # Read for the held-out rows, the training rows, the scoring and the known classes: joined once.
    tagged = checkpointed(L.split_train_predict(labels, written).select("entity_id", "label", "indices", "role"))
    vecs = to_sparse_vector(tagged, dim, "indices", output_col="vec")
    train = L.train_rows(vecs).select("entity_id", "label", F.col("vec").alias("features"))
    predict = L.predict_rows(vecs).select("entity_id", F.col("vec").alias("features"))

    res = train_with_pruning(train, rounds=rounds, holdout=holdout, model_dir=f"{root}/models/{day}")
    scored = res.model.transform(predict).select("entity_id", probability_of_one("probability").alias("score"))
    classes = L.assign_classes(L.train_rows(tagged), scored, res.threshold, class_names)
    overwrite_partition(classes.select("entity_id", "class"), f"{root}/predictions", day)
    overwrite_partition(res.report, f"{root}/threshold_report", day)
    preds = read_partition(spark, f"{root}/predictions", day)
    return BehaviorJobResult(res.threshold, res.gmean, dim, preds, res.report, res.rounds_run)


@dataclass
class TreeRefitResult:
    area_under_roc: float
    accuracy: float
    tree_text: str
    sizes: list
    final_recall: DataFrame


def tree_refit_job(labeled_vectors: DataFrame, seed: int = 42, drop_rounds: int = 2, tree_depth: int = 15,
                   tree_bins: int = 100, refit_tree_depth: int | None = None) -> TreeRefitResult:
    """``labeled_vectors``: ``entity_id, label, features`` (vector).

    The refits start from the tree pipeline: its errors are dropped first.  They are
    logistic models, or trees of ``refit_tree_depth`` where that is given.  Slots with
    a value that no training row has keep it as a category of its own.
    """
    # Read by the indexer fit, the pipeline fit and the evaluation: written once.
    data = checkpointed(labeled_vectors.withColumn("label_text", F.col("label").cast("int").cast("string")))
    train, test = FE.split_by_key(data, "entity_id", [0.8, 0.2])
    # The label index is fitted once, on training rows, and reused by every round.
    train_idx, indexer = FE.index_labels(train, "label_text", "indexed_label")
    test_idx = indexer.transform(test)
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withStd=True, withMean=False)
    tree = DecisionTreeClassifier(featuresCol="scaled", labelCol="indexed_label", maxDepth=tree_depth,
                                  maxBins=tree_bins, seed=seed)
    model = Pipeline(stages=[scaler, tree]).fit(train_idx)
    pred = model.transform(test_idx)
    ev = M.evaluate_binary(pred, "indexed_label", "prediction", "prediction").first()

    def refit():
        vi = VectorIndexer(inputCol="features", outputCol="indexed_features", handleInvalid="keep")
        if refit_tree_depth:
            return Pipeline(stages=[vi, DecisionTreeClassifier(
                featuresCol="indexed_features", labelCol="indexed_label", maxDepth=refit_tree_depth,
                maxBins=tree_bins, seed=seed)])
        lr = LogisticRegression(featuresCol="indexed_features", labelCol="indexed_label", regParam=0.01, maxIter=10)
        return Pipeline(stages=[vi, lr])

    kept, final, sizes = retrain_dropping_errors(
        train_idx, model, refit, drop_rounds, keep_cols=["entity_id", "label", "features", "indexed_label"])
    recall = M.class_recall(final.transform(test_idx), 1.0, "indexed_label", "prediction")
    return TreeRefitResult(float(ev["area_under_roc"]), float(ev["accuracy"]),
                             MO.describe_model(model.stages[-1]), sizes, recall)


def credit_forest_job(credit: DataFrame, measures: list[str], label_col: str = "label",
                      seed: int = 5043, num_trees: int = 10, id_col: str = "customer_id", subset: str = "auto"):
    """Profile, assemble, index the label, fit a forest and report accuracy."""
    profile = L.label_profile(credit, label_col, measures[:2])
    assembled, _ = FE.assemble(credit, measures, "features", label_col=label_col)
    # Read by the indexer fit, the forest fit and the test scoring: written once.
    assembled = checkpointed(assembled.withColumn("_lt", F.col(label_col).cast("string")))
    train, test = FE.split_by_key(assembled, id_col, [0.7, 0.3])
    train, indexer = FE.index_labels(train, "_lt", "indexed_label")       # the label index is fitted on training rows
    forest = MO.train_forest(train, "indexed_label", "features", num_trees=num_trees, subset=subset, seed=seed)
    pred, _ = FE.decode_labels(forest.transform(indexer.transform(test)), indexer, "prediction", "predicted_label")
    acc = M.accuracy(pred, "indexed_label", "prediction")
    return profile, pred, acc, forest
