"""Driver contract smoke test and a sample of oracle comparisons at sf0.001."""

import __spark_entry__ as E
from compare import compare
from fixtures import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["payment_bucket", "n_invoices", "avg_delay_days"]


def test_every_sql_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_sample_matches_oracle(spark):
    names = ["training_set", "clean_invoices", "score_bounds", "describe_numeric", "sorted_invoices",
             "per_class_metrics", "anomaly_rows", "correlation_long"]
    res = compare(spark, SF001, names, verbose=True)
    assert all(v[0] == "match" for v in res.values()), res


def test_weighted_boosting_runs_the_whole_preset(spark, monkeypatch):
    import __spark_entry__ as e
    from arrears.params import TUNED_BOOSTING

    asked = []
    monkeypatch.setattr(e, "_fitted", lambda spark, sf, name, estimator: (asked.append(estimator()), None))
    monkeypatch.setattr(e, "_judged_predictions", lambda spark, sf, model: None)
    e.q_weighted_gbt_predictions(spark, "")
    sizes = asked[0].sizes
    assert (sizes.rounds, sizes.num_leaves, sizes.reg_alpha, sizes.reg_lambda, sizes.subsample_freq) == tuple(
        TUNED_BOOSTING[k] for k in ("n_estimators", "num_leaves", "reg_alpha", "reg_lambda", "subsample_freq"))


def test_search_runs_the_whole_search(spark, monkeypatch):
    import inspect

    import __spark_entry__ as e
    from arrears.operators.search import SPACE, search, search_boosting

    rows = spark.createDataFrame([(0.5, 0)], "a double, payment_bucket int")
    asked = []

    def seen(*args, **more):
        asked.append(inspect.signature(search_boosting).bind(*args, **more))
        asked[-1].apply_defaults()
        return None, spark.createDataFrame([(0, 10, 0.9)], "trial int, rounds int, macro_f1 double")

    monkeypatch.setattr(e, "_splits", lambda spark, sf: (rows, rows, None))
    monkeypatch.setattr(e, "search_boosting", seen)
    e.q_searched_params(spark, "")
    sizes = asked[0].arguments
    assert (sizes["points"], sizes["least"], sizes["factor"], sizes["space"]) == (27, 10, 3, None)
    trials = search(lambda sizes, budget: 0.0, SPACE, sizes["points"], sizes["least"], sizes["factor"])
    assert [t.budget for t in trials] == [10] * 27 + [30] * 9 + [90] * 3 + [270]
