"""Training set -> year split -> class weights -> fit -> predict -> metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import ml
from ..operators.clean import filter_year_range, parse_dates
from ..operators.evaluate import (
    confusion_counts,
    matrix_from_counts,
    metrics_from_counts,
    per_class_metrics_from_counts,
)
from ..session import materialize
from ..operators.split import add_class_weight, class_weights, split_test, split_train, training_projection
from ..params import LABEL, SplitParams


@dataclass
class TrainResult:
    model: object
    columns: list
    weights: DataFrame
    predictions: DataFrame
    metrics: DataFrame
    confusion: DataFrame
    per_class: DataFrame


def prepare_splits(training_set: DataFrame, split: SplitParams = SplitParams(), as_of=None):
    """Parse dates and re-apply the year filter, split by year, project, weight."""
    df = filter_year_range(parse_dates(training_set), as_of,
                           columns=("invoice_date", "create_date", "due_date", "payment_date"))
    train = training_projection(split_train(df, split))
    test = training_projection(split_test(df, split))
    weights = class_weights(train)
    return add_class_weight(train, weights), test, weights


def train(training_set: DataFrame, estimator=None, split: SplitParams = SplitParams(), include_ids: bool = True,
          as_of=None) -> TrainResult:
    train_df, test_df, weights = prepare_splits(training_set, split, as_of)
    # iterative fitting reads its input many times: read it from one written copy
    train_df = materialize(train_df, "train-split")
    cols = ml.feature_columns(train_df, include_ids)
    model = ml.fit(train_df, estimator or ml.random_forest(), cols)
    # the model scores the test rows once; counts and predictions read the written scores
    scored = materialize(ml.predict(model, test_df), "scored")
    counts = confusion_counts(scored, prediction="predicted_bucket")
    out = scored.drop(LABEL)
    return TrainResult(
        model=model, columns=cols, weights=weights, predictions=out,
        metrics=metrics_from_counts(counts), confusion=matrix_from_counts(counts),
        per_class=per_class_metrics_from_counts(counts),
    )
