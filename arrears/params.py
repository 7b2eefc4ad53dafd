"""Parameters and fixed values of the lateness model.

The numbers in the "fixed values" block must equal the original model's to
give the same features, scores and labels; everything else is tunable.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must match the original model for identical results)
# ---------------------------------------------------------------------------
DATE_COLUMNS = ("invoice_date", "create_date", "due_date", "due_discount_date", "payment_date")
MIN_YEAR = 2010
REGION_COLUMNS = ("region_level1", "region_level2", "region_level3")
# right-closed 15-day buckets: (-inf,15] (15,30] (30,45] (45,60] (60,inf)
BUCKET_EDGES = (15, 30, 45, 60)
BUCKET_LABELS = ("0-15days", "15-30days", "30-45days", "45-60days", "60days")
DECAY_ALPHA = 0.1
ROLLING_ROWS = 3
RISK_WEIGHTS = (
    ("average_delay_days", 0.2, "inverse"),
    ("maximum_delay_days", 0.2, "inverse"),
    ("overall_delay_days_trend", 0.1, "inverse"),
    ("has_delayed_payment_last_3", 0.2, "raw"),
    ("invoice_deviation", 0.1, "scaled"),
    ("number_of_previous_invoices", 0.1, "scaled"),
    ("net_amount", 0.1, "scaled"),
    ("average_invoice_amount", 0.1, "scaled"),
)
VALUE_WEIGHTS = (
    ("net_amount", 0.3, "scaled"),
    ("average_invoice_amount", 0.2, "scaled"),
    ("number_of_previous_invoices", 0.1, "scaled"),
    ("frequency_of_transactions", 0.2, "scaled"),
    ("recency_days", 0.2, "inverse"),
)
CASH_FLOW_WEIGHTS = (
    ("average_delay_days", 0.3, "inverse"),
    ("delay_days_variance", 0.3, "inverse"),
    ("net_amount", 0.4, "scaled"),
)
HISTORICAL_WEIGHTS = (
    ("weighted_delay_days_trend", 0.5, "inverse"),
    ("maximum_delay_days", 0.25, "inverse"),
    ("weighted_delay_days_variance", 0.25, "inverse"),
)
GLOBAL_WEIGHTS = (
    ("risk_tolerance_score", 0.10),
    ("customer_value_score", 0.35),
    ("cash_flow_score", 0.05),
    ("historical_score", 0.50),
)
SCORE_SCALE = 10.0
TRAIN_YEARS = (2019, 2023)  # train: 2019 <= year < 2023
TEST_FROM_YEAR = 2023  # test: year >= 2023
PRODUCTION_TRAIN_FROM_YEAR = 2020
# columns removed before fitting (dates and the raw delay)
NON_FEATURE_COLUMNS = ("due_date", "invoice_date", "create_date", "payment_date", "delay_days")
TUNED_BOOSTING = dict(
    learning_rate=0.022550720790521145,
    max_depth=20,
    min_child_samples=88,
    n_estimators=1580,
    num_leaves=16917,
    reg_alpha=0.513841643356537,
    reg_lambda=2.1667566844499695,
    subsample=0.7859753700282479,
    subsample_freq=8,
    random_state=0,
)
LABEL = "payment_bucket"
PAIR_KEYS = ("customer_id", "company_id")
ORDER_KEYS = ("invoice_date", "invoice_id")

# the twelve min-max normalised columns (whole-table bounds)
NORMALISED_COLUMNS = (
    "average_delay_days",
    "maximum_delay_days",
    "overall_delay_days_trend",
    "invoice_deviation",
    "number_of_previous_invoices",
    "net_amount",
    "average_invoice_amount",
    "frequency_of_transactions",
    "recency_days",
    "delay_days_variance",
    "weighted_delay_days_trend",
    "weighted_delay_days_variance",
)

BEHAVIOUR_FEATURES = (
    "discount_offered",
    "previous_delay_days",
    "average_delay_days",
    "number_of_previous_invoices",
    "total_amount_of_previous_invoices",
    "average_invoice_amount",
    "payment_deviation",
    "invoice_deviation",
    "has_delayed_payment_last_3",
    "has_early_payment_last_3",
    "delay_days_trend",
    "invoice_amount_trend",
    "maximum_delay_days",
    "overall_delay_days_trend",
)
SEASON_FEATURES = (
    "due_date_month",
    "due_date_quarter",
    "due_date_dayofweek",
    "due_date_is_year_end",
    "due_date_is_year_start",
    "due_date_is_summer",
    "delay_days_trend_acceleration",
    "delay_days_variance",
)
SCORE_COLUMNS = (
    "risk_tolerance_score",
    "customer_value_score",
    "cash_flow_score",
    "historical_score",
    "global_score",
)

# column order of the training set
TRAINING_SET_COLUMNS = (
    "invoice_id",
    "customer_id",
    "company_id",
    "invoice_date",
    "create_date",
    "due_date",
    "payment_date",
    "net_amount",
    *REGION_COLUMNS,
    "discount_offered",
    "delay_days",
    *BEHAVIOUR_FEATURES[1:],
    *SEASON_FEATURES,
    "risk_tolerance_score",
    "frequency_of_transactions",
    "customer_value_score",
    "cash_flow_score",
    "weighted_delay_days_trend",
    "weighted_delay_days_variance",
    "historical_score",
    "global_score",
    LABEL,
)
# ---------------------------------------------------------------------------
# End of the fixed values
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class HistoryParams:
    """Controls the ordered per-pair history (window features).

    ``include_current`` keeps the original definitions, where running
    statistics include the current invoice (and the overall trend sees the
    whole pair).  ``False`` gives leak-free features built from earlier
    invoices only, which is the only valid mode for open invoices.

    ``max_chunk_rows``: a (customer, company) pair with more cleaned rows than
    this is split into contiguous chunks of following invoice days (a day that
    is itself larger is cut along its sorted ids), so no single task has to hold a
    hot pair.  ``None`` derives it from the row count and the number of
    shuffle partitions.

    ``rolling_rows``: length of the rolling flags and trends (the ``_last_3``
    columns keep their names; the acceleration is always over three rows).
    """

    include_current: bool = True
    max_chunk_rows: int | None = None
    min_chunk_rows: int = 200_000
    num_partitions: int | None = None
    rolling_rows: int = ROLLING_ROWS

    def __post_init__(self):
        if self.rolling_rows < 1:
            raise ValueError("rolling_rows must be at least 1")


@dataclass(frozen=True)
class ScoreParams:
    risk: tuple = RISK_WEIGHTS
    value: tuple = VALUE_WEIGHTS
    cash_flow: tuple = CASH_FLOW_WEIGHTS
    historical: tuple = HISTORICAL_WEIGHTS
    global_weights: tuple = GLOBAL_WEIGHTS
    alpha: float = DECAY_ALPHA
    scale: float = SCORE_SCALE


@dataclass(frozen=True)
class SplitParams:
    """Year split: train on ``train_from <= year < train_until``, test on ``year >= test_from``."""

    train_from: int = TRAIN_YEARS[0]
    train_until: int = TRAIN_YEARS[1]
    test_from: int = TEST_FROM_YEAR
