"""Raw invoices -> training set (clean, features, scores, F9, codes, label)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.clean import clean_invoices
from ..operators.features import invoice_features
from ..operators.label import add_payment_bucket, region_codes
from ..operators.scoring import (
    add_component_scores,
    add_score_helpers,
    bounds_row,
    filter_scorable,
    finish_scores,
    global_max,
    score_bounds,
    with_bounds,
)
from ..params import TRAINING_SET_COLUMNS, HistoryParams, ScoreParams
from ..schema import INVOICE_SCHEMA
from ..session import compiled_methods, materialize


def features_table(invoices: DataFrame, as_of=None, history: HistoryParams = HistoryParams(),
                   scores: ScoreParams = ScoreParams(), persist: bool = True) -> DataFrame:
    """Cleaned invoices with every feature and score helper.

    Written once to the checkpoint folder (``persist``): the scores need
    whole-table bounds, so this table is read by three passes (bounds, the
    global maximum, the output) and must not replay the window shuffle.
    """
    feats = clean_invoices(invoices, as_of).transform(lambda d: invoice_features(d, history))
    feats = add_score_helpers(feats, scores)
    if not persist:
        return feats
    with compiled_methods(feats.sparkSession):
        return materialize(feats, "features")


def scored_table(feats: DataFrame, scores: ScoreParams = ScoreParams()) -> DataFrame:
    """All rows with the five scores (-1 when unscorable) and ``is_scorable``."""
    bounds = bounds_row(score_bounds(feats))
    scored = add_component_scores(with_bounds(feats, bounds), scores)
    return finish_scores(scored, global_max(scored), scores)


def extra_columns(invoices: DataFrame) -> list[str]:
    known = {*INVOICE_SCHEMA.names, *TRAINING_SET_COLUMNS}
    return [c for c in invoices.columns if c.lower() not in known]


def preprocess(invoices: DataFrame, as_of=None, history: HistoryParams = HistoryParams(),
               scores: ScoreParams = ScoreParams(), drop_unscorable: bool = True) -> DataFrame:
    """The training set (FIXTURES.md §2 column order), then the caller's own columns.

    Columns of ``invoices`` outside its schema come along unchanged; one with
    the name of a training column gives way to that.
    """
    own = extra_columns(invoices)
    scored = scored_table(features_table(invoices, as_of, history, scores), scores)
    if drop_unscorable:
        scored = filter_scorable(scored)
    out = scored.transform(region_codes).transform(add_payment_bucket)
    return out.select(*TRAINING_SET_COLUMNS, *own)
