"""Iterative training loops: positive pruning and error-dropping refits.

Each round's training set is written with ``checkpoint()`` (to the shared
``spark.checkpoint.dir``) so lineage stays one round deep and a lost executor
only recomputes from the last written round.  The driver sees only counts,
the ≤99-row sweep of each round and the fitted model parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.functions.numeric import probability_of_one
from entiscore.operators.features import split_by_key
from entiscore.operators.labels import class_counts
from entiscore.operators.metrics import prune_positives, threshold_sweep
from entiscore.operators.models import logistic, save_model
from entiscore.session import checkpointed, delete_path


class NoUsableThreshold(ValueError):
    """No threshold gave both classes a non-zero recall."""


def drop_majority_errors(predictions: DataFrame, indexed_label_col: str = "indexed_label",
                         prediction_col: str = "prediction") -> DataFrame:
    """Keep majority-class rows (index 0) predicted right and every class-1 row.

    Index 0 is the most frequent label of the indexer that produced
    ``indexed_label_col``.
    """
    lab = F.col(indexed_label_col).cast("double")
    right = F.col(prediction_col).cast("double") == lab
    return predictions.where(((lab == 0.0) & right) | (lab == 1.0))


@dataclass
class PruningResult:
    threshold: float
    model: Transformer
    gmean: float
    best_round: int
    report: DataFrame
    rounds_run: int
    train_sizes: list = field(default_factory=list)


def _with_score(model: Transformer, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("score", probability_of_one("probability"))


def train_with_pruning(labeled: DataFrame, rounds: int = 10, holdout: float = 0.2,
                       id_col: str = "entity_id", label_col: str = "label",
                       features_col: str = "features", model_dir: str | None = None,
                       estimator=None, thresholds: list[float] | None = None) -> PruningResult:
    """Train, sweep thresholds on held-out rows, prune weak positives, retrain.

    Held-out rows are a fixed hash split of ``id_col`` (deterministic across
    re-runs and recomputation).  Each round: fit the logistic model, sweep the
    thresholds on the held-out rows (one aggregate), take the best geometric
    mean, then keep every negative and the positives scored at or above that
    round's threshold.  The round with the highest geometric mean wins (first
    on ties).  Every round runs, reports and saves its model, whatever it prunes; a
    round without a usable threshold keeps its rows.  ``model_dir`` is emptied first,
    so no model of an earlier run stays.
    """
    spark = labeled.sparkSession
    cols = [id_col, label_col, features_col]
    base = labeled.select(*cols)
    train, held = split_by_key(base, id_col, [1.0 - holdout, holdout])
    held = checkpointed(held)
    train = checkpointed(train)
    estimator = estimator or logistic(label_col=label_col, features_col=features_col)

    best_gmean, best = 0.0, None
    report_rows: list = []
    sizes: list = []
    rounds_run = 0
    counts = class_counts(train, label_col).first()
    if model_dir:
        delete_path(spark, model_dir)
    for k in range(int(rounds)):
        sizes.append((k, int(counts["n1"]), int(counts["n0"])))
        model = estimator.fit(train)
        rounds_run = k + 1
        if model_dir:
            save_model(model, f"{model_dir.rstrip('/')}/model_{k}")
        sweep = threshold_sweep(_with_score(model, held), thresholds, "score", label_col)
        rows = sweep.collect()                       # at most len(thresholds) rows
        for r in rows:
            report_rows.append((k, int(counts["n1"]), int(counts["n0"])) + tuple(r))
        usable = [r for r in rows if r["gmean"] > 0]
        if not usable:
            continue
        top = max(usable, key=lambda r: (r["gmean"], -r["threshold"]))     # the rule of best_threshold
        if top["gmean"] > best_gmean:
            best_gmean, best = float(top["gmean"]), (float(top["threshold"]), model, k)
        if k + 1 < int(rounds):
            pruned = prune_positives(_with_score(model, train), float(top["threshold"]), "score", label_col)
            train = checkpointed(pruned.select(*cols))
            counts = class_counts(train, label_col).first()      # next round's sizes, one aggregate
    if best is None:
        raise NoUsableThreshold("no threshold separates the classes in any round")
    schema = "iteration int, train1 long, train0 long, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in sweep.schema.fields)
    report = spark.createDataFrame(report_rows, schema)
    return PruningResult(threshold=best[0], model=best[1], gmean=best_gmean, best_round=best[2],
                         report=report, rounds_run=rounds_run, train_sizes=sizes)


def retrain_dropping_errors(train: DataFrame, model: Transformer, make_estimator, rounds: int = 2,
                            indexed_label_col: str = "indexed_label",
                            keep_cols: list[str] | None = None):
    """Drop the majority-class rows ``model`` gets wrong, refit; ``rounds`` times.

    The first round drops the errors of the model that is handed in, each later one
    those of the refit before it; there are exactly ``rounds`` fits.  ``train``
    already carries ``indexed_label_col`` from an indexer fitted once, so index 0
    keeps its meaning.  ``make_estimator`` returns a fresh (unfitted) estimator or
    pipeline.  Returns the final rows, the final model and one ``(round, rows)``
    pair per round (round 0: the rows handed in).
    """
    keep_cols = keep_cols or train.columns
    data = checkpointed(train.select(*keep_cols))
    sizes = [(0, data.count())]
    for r in range(1, int(rounds) + 1):
        kept = drop_majority_errors(model.transform(data), indexed_label_col, "prediction")
        data = checkpointed(kept.select(*keep_cols))
        sizes.append((r, data.count()))
        model = make_estimator().fit(data)
    return data, model, sizes
