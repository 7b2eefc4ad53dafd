"""Serving open invoices: stored model + scoring context give the same predictions."""

import os
import tempfile

from arrears.operators import ml
from arrears.plans.preprocess import features_table, preprocess
from arrears.plans.serve import ScoringContext, fit_scoring_context, score_open_invoices
from arrears.plans.train import train
from arrears.sources.invoices import invoices_table
from arrears.sources import read_predictions
from fixtures import SF01


def test_stored_context_and_model_round_trip(spark):
    inv = invoices_table(spark, SF01)
    feats = features_table(inv)
    result = train(preprocess(inv), ml.random_forest(10, 5))
    ctx = fit_scoring_context(feats)
    root = tempfile.mkdtemp(prefix="arrears-serve-")
    ctx.save(os.path.join(root, "ctx"))
    ml.save_model(result.model, os.path.join(root, "model"))
    first = score_open_invoices(inv, feats, result.model, ctx).select("invoice_id", "predicted_bucket")
    again = score_open_invoices(inv, feats, ml.load_model(os.path.join(root, "model")),
                                ScoringContext.load(spark, os.path.join(root, "ctx"))).select(
        "invoice_id", "predicted_bucket")
    a, b = sorted(map(tuple, first.collect())), sorted(map(tuple, again.collect()))
    assert a == b and len(a) > 0
    assert {p for _, p in a} <= {0, 1, 2, 3, 4}


def test_score_stage_in_a_saved_pipeline(spark):
    from pyspark.ml import PipelineModel

    from arrears.operators.scoring import add_component_scores, finish_scores, with_bounds

    inv = invoices_table(spark, SF01)
    feats = features_table(inv)
    ctx = fit_scoring_context(feats)
    stage = ctx.score_stage()
    path = os.path.join(tempfile.mkdtemp(prefix="arrears-stage-"), "pm")
    PipelineModel(stages=[stage]).write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    cols = ["invoice_id", "risk_tolerance_score", "customer_value_score", "cash_flow_score", "historical_score",
            "global_score", "is_scorable"]
    got = sorted(map(tuple, loaded.transform(feats).select(*cols).collect()))
    ref = finish_scores(add_component_scores(with_bounds(feats, ctx.bounds)), ctx.g_max)
    assert got == sorted(map(tuple, ref.select(*cols).collect()))


def test_two_step_job_with_csv_hand_off(spark):
    from arrears.plans.pipeline import run_pipeline
    from fixtures import SF001

    root = tempfile.mkdtemp(prefix="arrears-x3-")
    res = run_pipeline(spark, invoices_table(spark, SF001), os.path.join(root, "train"), os.path.join(root, "pred"),
                       ml.random_forest(5, 4), fmt="csv")
    m = res.metrics.first()
    assert 0 <= m["accuracy"] <= 1 and 0 <= m["f1"] <= 1
    preds = read_predictions(spark, os.path.join(root, "pred", "predictions"), "csv")
    assert preds.count() == res.predictions.count() > 0
    assert "predicted_bucket" in preds.columns and "payment_bucket" not in preds.columns
