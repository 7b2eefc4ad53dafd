"""Whole-table bounds (A7, A9, A10), min-max scores (N1-N7) and F9.

Bounds are one aggregate with 26 outputs over the feature table; the single
result row is cross-joined as a broadcast (1 row, fixed size) so the scores
stay column arithmetic inside whole-stage codegen.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import decay_weighted, minmax
from ..params import NORMALISED_COLUMNS, ScoreParams


def add_score_helpers(df: DataFrame, params: ScoreParams = ScoreParams()) -> DataFrame:
    """C8 decay columns (``frequency_of_transactions`` comes from the history)."""
    return df.withColumns({
        "weighted_delay_days_trend": decay_weighted("delay_days_trend", params.alpha),
        "weighted_delay_days_variance": decay_weighted("delay_days_variance", params.alpha),
    })


def score_bounds(df: DataFrame, columns=NORMALISED_COLUMNS) -> DataFrame:
    """One row: ``min_<c>``/``max_<c>`` for the normalised columns.

    Recency needs no extra pass: its bounds are 0 and max - min of the
    invoice date, so the latest invoice date (A10) is folded in here.
    """
    aggs = [F.max("invoice_date").alias("max_invoice_date"), F.min("invoice_date").alias("min_invoice_date")]
    for c in columns:
        if c == "recency_days":
            continue
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    b = df.agg(*aggs)
    span = F.datediff("max_invoice_date", "min_invoice_date")
    return b.withColumns({"min_recency_days": F.lit(0) * span, "max_recency_days": span})


def bounds_row(bounds: DataFrame) -> dict:
    """Collect the single bounds row (26 scalars) and warn about constant columns."""
    row = bounds.first().asDict()
    constant = [k[4:] for k in row if k.startswith("min_") and row[k] is not None and row[k] == row.get("max_" + k[4:])]
    if constant:
        warnings.warn(f"constant normalised columns make every row unscorable: {constant}")
    return row


def with_bounds(df: DataFrame, bounds) -> DataFrame:
    """Attach the bounds to every row as literals (constant-folded by Catalyst).

    ``bounds`` is the one-row DataFrame of ``score_bounds`` or its collected dict.
    """
    row = bounds if isinstance(bounds, dict) else bounds_row(bounds)
    return df.withColumns({k: F.lit(v) for k, v in row.items()})


def _term(c: str, kind: str) -> Column:
    if kind == "raw":
        return F.col(c)
    m = minmax(c, F.col(f"min_{c}"), F.col(f"max_{c}"))
    return F.lit(1.0) - m if kind == "inverse" else m


def weighted_score(weights, scale: float) -> Column:
    """``scale * (w1*t1 + w2*t2 + ...)``; NULL when a term is undefined."""
    total = reduce(lambda acc, t: acc + t, [F.lit(w) * _term(c, kind) for c, w, kind in weights])
    return total * F.lit(scale)


def add_recency(df: DataFrame) -> DataFrame:
    """Days from the invoice to the latest invoice date."""
    return df.withColumn("recency_days", F.datediff("max_invoice_date", "invoice_date"))


def add_component_scores(df: DataFrame, params: ScoreParams = ScoreParams()) -> DataFrame:
    """N2-N5 plus ``is_scorable`` (N6); requires ``with_bounds`` columns."""
    out = df.transform(add_recency).withColumns({
        "risk_tolerance_score": weighted_score(params.risk, params.scale),
        "customer_value_score": weighted_score(params.value, params.scale),
        "cash_flow_score": weighted_score(params.cash_flow, params.scale),
        "historical_score": weighted_score(params.historical, params.scale),
    })
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c, _ in params.global_weights])
    g = reduce(lambda acc, t: acc + t, [F.col(c) * F.lit(w) for c, w in params.global_weights])
    return out.withColumns({"is_scorable": ok, "_g": F.when(ok, g)})


def global_max(scored: DataFrame) -> DataFrame:
    """Max of the combined score over scorable rows (one row)."""
    return scored.agg(F.max("_g").alias("_g_max"))


def finish_scores(scored: DataFrame, gmax, params: ScoreParams = ScoreParams()) -> DataFrame:
    """N7 and the -1 surface value of unscorable rows.

    ``gmax`` is the one-row DataFrame of ``global_max`` or the scalar itself.
    """
    g_max = gmax.first()[0] if isinstance(gmax, DataFrame) else gmax
    out = scored.withColumn("_g_max", F.lit(g_max).cast("double")).withColumn(
        "global_score", F.try_divide(F.col("_g"), F.col("_g_max")) * F.lit(params.scale)
    )
    ok = F.col("is_scorable")
    cols = {c: F.when(ok, F.col(c)).otherwise(F.lit(-1.0)) for c, _ in params.global_weights}
    cols["global_score"] = F.when(ok, F.coalesce(F.col("global_score"), F.lit(-1.0))).otherwise(F.lit(-1.0))
    # exactly the names of score_bounds; a caller's own min_ and max_ columns stay
    bound_cols = [f"{side}_{c}" for side in ("min", "max") for c in (*NORMALISED_COLUMNS, "recency_days", "invoice_date")]
    return out.withColumns(cols).drop(*bound_cols, "_g", "_g_max")


def filter_scorable(df: DataFrame) -> DataFrame:
    """keep rows with a defined global score."""
    return df.filter(F.col("is_scorable"))
