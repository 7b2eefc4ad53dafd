"""Scoring open invoices with a model and scoring context fitted on training data."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators import ml
from ..operators.label import region_codes, region_dictionary
from ..operators.open_invoices import open_invoice_features, open_invoice_rows
from ..operators.scoring import (
    add_component_scores,
    bounds_row,
    filter_scorable,
    finish_scores,
    global_max,
    score_bounds,
    with_bounds,
)
from ..params import HistoryParams, ScoreParams
from ..session import materialize


@dataclass
class ScoringContext:
    """What serving must reuse from training: bounds (A7), global maximum (A9), region dictionary (C11).

    Stored as Parquet: one row of bounds and maximum, and the dictionary table.
    """

    bounds: dict
    g_max: float
    dictionary: DataFrame

    def save(self, path: str) -> None:
        spark = self.dictionary.sparkSession
        row = dict(self.bounds, g_max=float(self.g_max))
        spark.createDataFrame([row]).write.mode("overwrite").parquet(os.path.join(path, "bounds"))
        self.dictionary.write.mode("overwrite").parquet(os.path.join(path, "dictionary"))

    def score_stage(self):
        """The bounds and maximum as a Spark ML stage (``ScoreTransformer``)."""
        from ..operators.score_stage import ScoreTransformer

        return ScoreTransformer.from_context(self.bounds, self.g_max)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ScoringContext":
        row = spark.read.parquet(os.path.join(path, "bounds")).first().asDict()
        g_max = row.pop("g_max")
        return ScoringContext(row, g_max, spark.read.parquet(os.path.join(path, "dictionary")))


def fit_scoring_context(features: DataFrame, scores: ScoreParams = ScoreParams()) -> ScoringContext:
    bounds = bounds_row(score_bounds(features))
    scored = add_component_scores(with_bounds(features, bounds), scores)
    g_max = global_max(scored).first()[0]
    kept = filter_scorable(finish_scores(scored, g_max, scores))
    return ScoringContext(bounds, g_max, materialize(region_dictionary(kept), "region-dictionary"))


def score_open_invoices(invoices: DataFrame, paid_features: DataFrame, model: PipelineModel,
                        ctx: ScoringContext, as_of=None, history: HistoryParams = HistoryParams(),
                        scores: ScoreParams = ScoreParams()) -> DataFrame:
    """Open invoices (F14) with as-of features, training-fitted scores and ``predicted_bucket``."""
    feats = open_invoice_features(paid_features, open_invoice_rows(invoices, as_of), history, scores.alpha)
    scored = ctx.score_stage().transform(feats) if scores == ScoreParams() else finish_scores(
        add_component_scores(with_bounds(feats, ctx.bounds), scores), ctx.g_max, scores)
    coded = region_codes(scored, dictionary=ctx.dictionary)
    return ml.predict(model, coded)
