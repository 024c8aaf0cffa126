"""Folds, metrics, ensembling, drift and the trained models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierframe.catalog.feature_queries import labelled, stored
from tierframe.functions.classes import N_CLASSES, argmax, label_to_class
from tierframe.learning.drift import drift_model as fit_drift_model
from tierframe.learning.folds import train_folds
from tierframe.learning.models import BoostedTrees, assemble, perceptron
from tierframe.learning.search import search
from tierframe.learning.softmax_trees import train_fold_models
from tierframe.learning.stacking import fit_stack
from tierframe.operators import ensemble as EN
from tierframe.operators import folds as FD
from tierframe.operators.columns import stack_targets
from tierframe.operators.drift import drift, histogram
from tierframe.operators.joins import lookup_join
from tierframe.operators.metrics import hard_label_aucs, macro_auc, score_aucs
from tierframe.operators.profile import importance_report
from tierframe.operators.scaling import StandardScale
from tierframe.operators.stats import require_agreement, vote
from tierframe.plans.event_table import event_table
from tierframe.plans.jets import jet_features, jet_table
from tierframe.plans.submission import fan_out, fill_sample, predicted_labels
from tierframe.sources import views as V
from tierframe.sources.predictions import probability_columns, side_by_side
from tierframe.sources.staging import materialize

JET_RAW = [
    "number_of_particles_in_this_jet", "jet_px", "jet_py", "jet_pz", "jet_energy", "jet_mass",
]
MATRIX = [f"c{i}" for i in range(4 * N_CLASSES)]


# folds


def fold_group_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FD.group_folds(V.jets(spark, sf_dir), "event_id").select("jet_id", "event_id", "fold")


def fold_group_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    jets = V.jets(spark, sf_dir).select("jet_id", "event_id")
    return FD.balanced_group_folds(jets, "event_id")


def fold_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = V.events(spark, sf_dir).select("event_id", "label")
    return labelled(FD.stratified_folds(events, "label", "event_id"))


def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FD.holdout(V.jets(spark, sf_dir).select("jet_id"), "jet_id")


def fold_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = FD.group_folds(V.jets(spark, sf_dir), "event_id")
    return FD.training_rows(folded, 0).select("jet_id", "jet_energy", "fold")


# metrics


def _scored(spark: SparkSession, sf_dir: str, model: str = "lgb") -> DataFrame:
    rows = V.predictions(spark, sf_dir).filter((F.col("model") == model) & (F.col("split") == "train"))
    return rows.withColumn("truth", label_to_class(F.col("label")))


def auc_hard_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.predictions(spark, sf_dir).filter(F.col("split") == "train")
    truth, winner = label_to_class(F.col("label")), argmax(F.col("probs"))
    marked = rows.select("model", truth.alias("truth"), winner.alias("winner"))
    per_class = hard_label_aucs(F.col("truth"), F.col("winner"))
    return marked.groupBy("model").agg(
        *[F.round(auc, 6).alias(f"auc_{k}") for k, auc in enumerate(per_class)],
        F.round(macro_auc(F.col("truth"), F.col("winner")), 6).alias("auc"),
    )


def auc_per_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = FD.group_folds(_scored(spark, sf_dir), "id")
    marked = folded.withColumn("winner", argmax(F.col("probs")))
    return marked.groupBy("fold").agg(
        F.round(macro_auc(F.col("truth"), F.col("winner")), 6).alias("auc")
    )


def auc_per_model_and_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.predictions(spark, sf_dir).filter(F.col("split") == "train")
    marked = FD.group_folds(rows, "id").select(
        "model", "fold", label_to_class(F.col("label")).alias("truth"),
        argmax(F.col("probs")).alias("winner"),
    )
    return marked.groupBy("model", "fold").agg(
        F.round(macro_auc(F.col("truth"), F.col("winner")), 6).alias("auc")
    )


def auc_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = [f"p{k}" for k in range(N_CLASSES)]
    rows = _scored(spark, sf_dir).select("truth", *probability_columns("probs", "p", 0))
    return score_aucs(rows, "truth", scores).select("class", F.round("auc", 6).alias("auc"))


# ensembles


def _wide(spark: SparkSession, sf_dir: str, split: str | None = None) -> DataFrame:
    predictions = V.predictions(spark, sf_dir)
    if split:
        predictions = predictions.filter(F.col("split") == split)
    return side_by_side(predictions, V.MODELS)


def _wide_with_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = V.events(spark, sf_dir).select(
        F.col("event_id").alias("id"), label_to_class(F.col("label")).alias("truth")
    )
    return _wide(spark, sf_dir).join(truth, "id")


def stack_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(_wide(spark, sf_dir))


def blend_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = EN.score_blends(_wide_with_truth(spark, sf_dir), "truth")
    return scores.withColumn("auc", F.round("auc", 6))


def blend_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = EN.score_blends(_wide_with_truth(spark, sf_dir), "truth")
    return EN.best_blend(scores, 6)


def blend_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EN.blend(_wide(spark, sf_dir, "test")).select("id", "label")


def fold_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    averaged = EN.average_predictions(V.predictions(spark, sf_dir))
    return stored(averaged.select("id", *probability_columns()))


def model_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    winners = [
        F.max(F.when(F.col("model") == m, argmax(F.col("probs")))).alias(m) for m in V.MODELS
    ]
    wide = V.predictions(spark, sf_dir).groupBy("id").agg(*winners)
    table = EN.label_correlation(wide, V.MODELS)
    return table.withColumn("correlation", F.round("correlation", 6))


def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    jets = V.jets(spark, sf_dir)
    scale = StandardScale.fit(jets.filter(F.col("split") == "train"), JET_RAW)
    return stored(scale.apply(jets).select("jet_id", *JET_RAW))


# drift

DRIFT_FEATURES = [*JET_RAW, "jet_distance", "jet_speed", "angle_xy"]


def _featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jet_features(V.jets(spark, sf_dir)).select("split", *DRIFT_FEATURES)


def drift_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(_featured(spark, sf_dir), DRIFT_FEATURES)


def drift_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = drift(histogram(_featured(spark, sf_dir), DRIFT_FEATURES))
    return table.select("column_name", F.round("psi", 6).alias("psi"), F.round("ks", 6).alias("ks"))


# trained models: no SQL counterpart

TREES = BoostedTrees()


def _features(table: DataFrame) -> list[str]:
    return [c for c in table.columns if c not in ("jet_id", "event_id", "label", "split")]


def _jet_training(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    table = jet_features(V.jets(spark, sf_dir))
    features = _features(table)
    folded = FD.group_folds(table, "event_id").withColumn(
        "class", label_to_class(F.col("label"))
    )
    rows = assemble(folded, features, ["jet_id", "event_id", "class", "fold", "split"])
    rows = materialize(rows, "jet_vectors")
    train = rows.filter(F.col("split") == "train").drop("split", "event_id")
    return train, rows.filter(F.col("split") == "test").select("jet_id", "features"), features


def oof_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, _ = _jet_training(spark, sf_dir)
    result = train_folds(train, TREES, "jet_id", "class")
    return result.oof.select("jet_id", "class", "fold", *probability_columns())


def test_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scored by the mean of the fold models."""
    train, test, _ = _jet_training(spark, sf_dir)
    result = train_folds(train, TREES, "jet_id", "class", test=test)
    return result.test.select("jet_id", *probability_columns())


def tree_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, features = _jet_training(spark, sf_dir)
    model = TREES.fit(train, "class")
    gains = spark.createDataFrame(model.importance(features), "feature string, gain double")
    splits = spark.createDataFrame(model.split_counts(features), "feature string, n_splits int")
    return importance_report(gains, 50).join(splits, "feature")


def _round_one(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold rows of the train jets and test jets by the mean of the fold models,
    on all jet features and statistics of the event."""
    table = jet_table(V.jets(spark, sf_dir)).withColumn("class", label_to_class(F.col("label")))
    features = [c for c in _features(table) if c != "class"]
    rows = materialize(FD.group_folds(table, "event_id"), "round_one")
    train, test = (rows.filter(F.col("split") == s) for s in ("train", "test"))
    oof, scored, _ = train_fold_models(train, features, "jet_id", "class", test=test)
    return oof, scored


def round_one_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    oof, _ = _round_one(spark, sf_dir)
    return oof.select("jet_id", "class", "fold", *probability_columns())


def round_one_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = _round_one(spark, sf_dir)
    return predicted_labels(scored, "jet_id").withColumnRenamed("jet_id", "id")


def _round_two(spark: SparkSession, sf_dir: str, k_particles: int = 16) -> DataFrame:
    """Test events with the mean of the fold models, trained on the flattened event table."""
    jets = V.jets(spark, sf_dir)
    # the label of an event is that of its first jet
    require_agreement(jets, "event_id", "label")
    table = event_table(
        V.particles(spark, sf_dir), jets, V.events(spark, sf_dir), V.PARTICLE_TIES,
        k_particles=k_particles,
    )
    rows = materialize(table.withColumn("class", label_to_class(F.col("label"))), "round_two")
    features = [c for c in _features(rows) if c != "class"]
    train, test = (rows.filter(F.col("split") == s) for s in ("train", "test"))
    folded = FD.stratified_folds(train, "class", "event_id")
    _, scored, _ = train_fold_models(folded, features, "event_id", "class", test=test)
    return scored


def round_two_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test jet with the label of its event; NULL where no jet of it has particles."""
    labels = predicted_labels(_round_two(spark, sf_dir), "event_id")
    jets = V.jets(spark, sf_dir).filter(F.col("split") == "test")
    return fill_sample(jets.select(F.col("jet_id").alias("id")), fan_out(jets, labels))


def oof_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _wide_with_truth(spark, sf_dir)
    scaled = StandardScale.fit(wide, MATRIX).apply(wide)
    rows = FD.group_folds(assemble(scaled, MATRIX, ["id", "truth"]), "id")
    result = train_folds(rows, perceptron(len(MATRIX)), "id", "truth")
    return result.oof.select("id", "truth", "fold", *probability_columns())


def stack_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test events labelled by the meta model, voted and fanned out to jets."""
    train = _wide_with_truth(spark, sf_dir)
    stack = fit_stack(train, "truth")
    test = stack.predict(_wide(spark, sf_dir, "test"), ["id"])
    labels = predicted_labels(test, "id").withColumnRenamed("id", "event_id")
    jets = V.jets(spark, sf_dir).select(F.col("jet_id").alias("id"), "event_id")
    return vote(lookup_join(jets, labels, "event_id"), "event_id", "label").select("id", "label")


def drift_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = jet_features(V.jets(spark, sf_dir))
    train, test = (table.filter(F.col("split") == s) for s in ("train", "test"))
    features = _features(table)
    both = stack_targets(train, test, ["jet_id", *features])
    fitted = fit_drift_model(assemble(both, features, ["jet_id", "target"]), features, "jet_id")
    return fitted.importance.withColumn("auc", F.lit(fitted.auc))


def search_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, _ = _jet_training(spark, sf_dir)
    return search(train, "jet_id", "class")


QUERIES = {
    f.__name__: f
    for f in (
        fold_group_hash,
        fold_group_balanced,
        fold_stratified,
        holdout_split,
        fold_training_rows,
        auc_hard_labels,
        auc_per_fold,
        auc_per_model_and_fold,
        auc_scores,
        stack_matrix,
        blend_grid,
        blend_best,
        blend_fixed,
        fold_average,
        model_correlation,
        standard_scale,
        drift_histogram,
        drift_summary,
        oof_trees,
        test_trees,
        tree_importance,
        round_one_oof,
        round_one_submission,
        round_two_submission,
        oof_mlp,
        stack_fit,
        drift_model,
        search_params,
    )
}
