"""DuckDB twins of the registered queries (the correctness oracle).

plain window functions over whole pairs; they share one CTE chain
``inv -> clean -> f0 -> f1 -> f2 -> feat -> b -> sc -> scored -> ts``.

Both sides bring every output column to a canonical form before hashing:
integers as BIGINT, dates as DATE, doubles as ``round(y + |y| * 1e-11) / 1e4
+ 0.0`` with ``y = x * 1e4`` (same IEEE steps in both engines, no -0.0). The
tiny relative nudge settles exact decimal ties (amounts have cents, divisors
are counts) the same way in both engines even when their sums differ in the
last bit because they were added in a different order.
"""

from __future__ import annotations

# --- canonical column forms -------------------------------------------------
I, D, T, S, B = "bigint", "double", "date", "string", "boolean"
# doubles compared at 6 significant digits: sums over long chunked histories
G = "double6"


def canon_sql(inner: str, spec) -> str:
    """Wrap ``inner`` SQL so every column in ``spec`` has its canonical type."""
    cols = []
    for name, kind in spec:
        q = f'"{name}"'
        if kind == I:
            cols.append(f"CAST({q} AS BIGINT) AS {q}")
        elif kind == D:
            y = f"(CAST({q} AS DOUBLE) * 10000.0)"
            cols.append(f"round({y} + abs({y}) * 1e-11) / 10000.0 + 0.0 AS {q}")
        elif kind == G:
            x = f"CAST({q} AS DOUBLE)"
            k = f"(5 - floor(log10(abs({x}))))"
            cols.append(
                f"CASE WHEN {x} IS NULL OR {x} = 0 THEN {x} WHEN {k} >= 0 "
                f"THEN round({x} * pow(10, {k})) / pow(10, {k}) "
                f"ELSE round({x} / pow(10, -{k})) * pow(10, -{k}) END + 0.0 AS {q}")
        elif kind == T:
            cols.append(f"CAST({q} AS DATE) AS {q}")
        elif kind == B:
            cols.append(f"CAST({q} AS BOOLEAN) AS {q}")
        else:
            cols.append(f"CAST({q} AS VARCHAR) AS {q}")
    return f"SELECT {', '.join(cols)} FROM (\n{inner}\n) AS q"


# --- shared CTE chain -------------------------------------------------------
INVOICES = """
o0 AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
         CAST(o_orderdate + INTERVAL 22 YEAR AS DATE) AS d0,
         ((o_orderkey * 7 + o_custkey * 13) % 41) + (o_custkey % 5) * ((o_orderkey // 3) % 11) - 15 AS delay
  FROM orders
),
o1 AS (
  SELECT *, CASE WHEN o_orderkey % 89 = 7 THEN d0 - 1
                 ELSE d0 + CAST(15 * (1 + o_custkey % 4) AS INTEGER) END AS due
  FROM o0
),
inv AS (
  SELECT
    o_orderkey AS invoice_id,
    o_custkey AS customer_id,
    CAST(CASE WHEN o_orderkey % 97 = 5 THEN -1 ELSE o_orderkey % 3 END AS BIGINT) AS company_id,
    d0 AS invoice_date,
    CASE WHEN o_orderkey % 83 = 4 THEN CAST(o_orderdate AS DATE)
         ELSE d0 + CAST(o_orderkey % 3 AS INTEGER) END AS create_date,
    due AS due_date,
    CASE WHEN o_orderkey % 5 = 0 THEN d0 + 7 END AS due_discount_date,
    CASE WHEN o_orderkey % 53 = 11 THEN NULL ELSE due + CAST(delay AS INTEGER) END AS payment_date,
    CAST(CASE WHEN o_orderkey % 61 = 3 THEN 10 WHEN o_orderkey % 7 = 0 THEN NULL ELSE 0 END AS DOUBLE)
      AS payment_amount,
    CASE WHEN o_orderkey % 53 = 11 OR o_orderkey % 43 = 9 THEN 'N' ELSE 'Y' END AS payment_complete,
    CAST(CASE WHEN o_orderkey % 71 = 2 THEN -o_totalprice WHEN o_orderkey % 101 = 6 THEN NULL
              ELSE o_totalprice END AS DOUBLE) AS net_amount,
    r_name AS region_level1,
    n_name AS region_level2,
    CASE WHEN o_orderkey % 103 = 8 THEN NULL ELSE c_mktsegment END AS region_level3
  FROM o1
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""


def _years_ok(c: str) -> str:
    return f"((year({c}) BETWEEN 2010 AND year(current_date)) OR {c} IS NULL)"


YEAR_OK = " AND ".join(_years_ok(c) for c in
                       ("invoice_date", "create_date", "due_date", "due_discount_date", "payment_date"))
PAID_OK = ("payment_date IS NOT NULL AND NOT coalesce(payment_amount > 0, false) "
           "AND payment_complete = 'Y'")
STALE = ("payment_date IS NULL AND (coalesce(create_date < current_date - INTERVAL 1 YEAR, false) "
         "OR coalesce(invoice_date < current_date - INTERVAL 1 YEAR, false))")
COMPANY_OK = "company_id <> -1 AND customer_id IS NOT NULL AND NOT coalesce(net_amount < 0, false)"

CLEAN = f"""
clean AS (
  SELECT * EXCLUDE (payment_amount, payment_complete) FROM inv
  WHERE {YEAR_OK}
    AND {PAID_OK}
    AND NOT ({STALE})
    AND {COMPANY_OK}
    AND invoice_date < payment_date
    AND invoice_date < due_date
)"""

# pair window: whole history; running; 3-row rolling
W = "PARTITION BY customer_id, company_id ORDER BY invoice_date, invoice_id"
WE = f"({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
# amounts in whole millionths: their sums and squares are exact in any order
UNITS = "CAST(round(net_amount * 1000000) AS HUGEINT)"
W3 = f"({W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
WP = "(PARTITION BY customer_id, company_id)"

FEATURES = f"""
f0 AS (
  SELECT * EXCLUDE (due_discount_date),
    CASE WHEN due_discount_date IS NULL THEN 0 ELSE 1 END AS discount_offered,
    CAST(payment_date - due_date AS BIGINT) AS delay_days
  FROM clean
),
f1 AS (
  SELECT *,
    coalesce(lag(delay_days) OVER ({W}), 0) AS previous_delay_days,
    avg(delay_days) OVER {WE} AS average_delay_days,
    row_number() OVER ({W}) - 1 AS number_of_previous_invoices,
    CAST(sum({UNITS}) OVER {WE} AS DOUBLE) / 1000000 AS total_amount_of_previous_invoices,
    coalesce(stddev_samp(delay_days) OVER {WE}, 0) AS payment_deviation,
    coalesce(CASE WHEN count(net_amount) OVER {WE} > 1 THEN sqrt(CAST(count(net_amount) OVER {WE} * sum({UNITS} * {UNITS}) OVER {WE}
      - sum({UNITS}) OVER {WE} * sum({UNITS}) OVER {WE} AS DOUBLE)
      / (CAST(count(net_amount) OVER {WE} AS DOUBLE) * (count(net_amount) OVER {WE} - 1))) / 1000000 END, 0) AS invoice_deviation,
    CASE WHEN count(delay_days) OVER {W3} = 3 AND max(delay_days) OVER {W3} > 0 THEN 1 ELSE 0 END
      AS has_delayed_payment_last_3,
    CASE WHEN count(delay_days) OVER {W3} = 3 AND max(delay_days) OVER {W3} < 0 THEN 1 ELSE 0 END
      AS has_early_payment_last_3,
    CASE WHEN count(delay_days) OVER {W3} = 3 THEN avg(delay_days) OVER {W3} END AS _rm_delay,
    CASE WHEN count(net_amount) OVER {W3} = 3 THEN avg(net_amount) OVER {W3} END AS _rm_amount,
    max(delay_days) OVER {WE} AS maximum_delay_days,
    coalesce(delay_days - 2 * lag(delay_days, 1) OVER ({W}) + lag(delay_days, 2) OVER ({W}), 0)
      AS delay_days_trend_acceleration,
    count(invoice_id) OVER (PARTITION BY customer_id) AS frequency_of_transactions
  FROM f0
),
f2 AS (
  SELECT *,
    CASE WHEN number_of_previous_invoices = 0 THEN 0.0
         ELSE total_amount_of_previous_invoices / number_of_previous_invoices END AS average_invoice_amount,
    coalesce(_rm_delay - lag(_rm_delay) OVER ({W}), 0) AS delay_days_trend,
    coalesce(_rm_amount - lag(_rm_amount) OVER ({W}), 0) AS invoice_amount_trend,
    CASE WHEN count(*) OVER {WP} > 1
         THEN regr_slope(CAST(delay_days AS DOUBLE), CAST(number_of_previous_invoices AS DOUBLE)) OVER {WP}
         ELSE 0 END AS overall_delay_days_trend,
    payment_deviation AS delay_days_variance,
    CASE WHEN number_of_previous_invoices > 0
         THEN regr_slope(CAST(delay_days AS DOUBLE), CAST(number_of_previous_invoices AS DOUBLE)) OVER {WE}
         ELSE 0 END AS running_delay_days_trend,
    month(due_date) AS due_date_month,
    quarter(due_date) AS due_date_quarter,
    isodow(due_date) - 1 AS due_date_dayofweek,
    CASE WHEN month(due_date) = 12 THEN 1 ELSE 0 END AS due_date_is_year_end,
    CASE WHEN month(due_date) = 1 THEN 1 ELSE 0 END AS due_date_is_year_start,
    CASE WHEN month(due_date) IN (6, 7, 8) THEN 1 ELSE 0 END AS due_date_is_summer
  FROM f1
),
feat AS (
  SELECT * EXCLUDE (_rm_delay, _rm_amount),
    0.1 * pow(0.9, delay_days_trend) * delay_days_trend AS weighted_delay_days_trend,
    0.1 * pow(0.9, delay_days_variance) * delay_days_variance AS weighted_delay_days_variance
  FROM f2
)"""

NORM = ("average_delay_days", "maximum_delay_days", "overall_delay_days_trend", "invoice_deviation",
        "number_of_previous_invoices", "net_amount", "average_invoice_amount", "frequency_of_transactions",
        "delay_days_variance", "weighted_delay_days_trend", "weighted_delay_days_variance")


def _m(c: str) -> str:
    return f"((f.{c} - b.min_{c}) / nullif(b.max_{c} - b.min_{c}, 0))"


def _inv(c: str) -> str:
    return f"(1 - {_m(c)})"


BOUNDS = "b AS (\n  SELECT max(invoice_date) AS max_invoice_date, min(invoice_date) AS min_invoice_date, " + ", ".join(
    f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in NORM) + "\n  FROM feat\n)"

RECENCY_M = ("(CAST(b.max_invoice_date - f.invoice_date AS DOUBLE) "
             "/ nullif(CAST(b.max_invoice_date - b.min_invoice_date AS DOUBLE), 0))")

SCORES = f"""
{BOUNDS},
sc AS (
  SELECT f.*,
    CAST(b.max_invoice_date - f.invoice_date AS BIGINT) AS recency_days,
    (0.2 * {_inv('average_delay_days')} + 0.2 * {_inv('maximum_delay_days')}
     + 0.1 * {_inv('overall_delay_days_trend')} + 0.2 * f.has_delayed_payment_last_3
     + 0.1 * {_m('invoice_deviation')} + 0.1 * {_m('number_of_previous_invoices')}
     + 0.1 * {_m('net_amount')} + 0.1 * {_m('average_invoice_amount')}) * 10 AS risk_tolerance_score,
    (0.3 * {_m('net_amount')} + 0.2 * {_m('average_invoice_amount')} + 0.1 * {_m('number_of_previous_invoices')}
     + 0.2 * {_m('frequency_of_transactions')} + 0.2 * (1 - {RECENCY_M})) * 10 AS customer_value_score,
    (0.3 * {_inv('average_delay_days')} + 0.3 * {_inv('delay_days_variance')}
     + 0.4 * {_m('net_amount')}) * 10 AS cash_flow_score,
    (0.5 * {_inv('weighted_delay_days_trend')} + 0.25 * {_inv('maximum_delay_days')}
     + 0.25 * {_inv('weighted_delay_days_variance')}) * 10 AS historical_score
  FROM feat f CROSS JOIN b
),
sc2 AS (
  SELECT *,
    (risk_tolerance_score IS NOT NULL AND customer_value_score IS NOT NULL
     AND cash_flow_score IS NOT NULL AND historical_score IS NOT NULL) AS is_scorable,
    risk_tolerance_score * 0.10 + customer_value_score * 0.35 + cash_flow_score * 0.05
      + historical_score * 0.50 AS _g
  FROM sc
),
gm AS (SELECT max(_g) AS g_max FROM sc2 WHERE is_scorable),
scored AS (
  SELECT s.* EXCLUDE (risk_tolerance_score, customer_value_score, cash_flow_score, historical_score, _g),
    CASE WHEN is_scorable THEN risk_tolerance_score ELSE -1 END AS risk_tolerance_score,
    CASE WHEN is_scorable THEN customer_value_score ELSE -1 END AS customer_value_score,
    CASE WHEN is_scorable THEN cash_flow_score ELSE -1 END AS cash_flow_score,
    CASE WHEN is_scorable THEN historical_score ELSE -1 END AS historical_score,
    CASE WHEN is_scorable THEN coalesce(_g / nullif(gm.g_max, 0) * 10, -1) ELSE -1 END AS global_score
  FROM sc2 s CROSS JOIN gm
),
kept AS (SELECT * FROM scored WHERE is_scorable),
rc1 AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT region_level1 AS v FROM kept WHERE region_level1 IS NOT NULL)),
rc2 AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT region_level2 AS v FROM kept WHERE region_level2 IS NOT NULL)),
rc3 AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT region_level3 AS v FROM kept WHERE region_level3 IS NOT NULL)),
ts AS (
  SELECT k.* EXCLUDE (region_level1, region_level2, region_level3),
    coalesce(rc1.code, -1) AS region_level1,
    coalesce(rc2.code, -1) AS region_level2,
    coalesce(rc3.code, -1) AS region_level3,
    CASE WHEN delay_days <= 15 THEN 0 WHEN delay_days <= 30 THEN 1 WHEN delay_days <= 45 THEN 2
         WHEN delay_days <= 60 THEN 3 ELSE 4 END AS payment_bucket
  FROM kept k
  LEFT JOIN rc1 ON k.region_level1 = rc1.v
  LEFT JOIN rc2 ON k.region_level2 = rc2.v
  LEFT JOIN rc3 ON k.region_level3 = rc3.v
)"""

CHAIN = "WITH " + ",".join([INVOICES, CLEAN, FEATURES, SCORES])

# skew check: every third invoice re-keyed onto pair (0, 0)
HOT_INVOICES = """
inv_hot AS (
  SELECT * REPLACE (
    CASE WHEN invoice_id % 3 = 0 THEN 0 ELSE customer_id END AS customer_id,
    CAST(CASE WHEN invoice_id % 3 = 0 THEN 0 ELSE company_id END AS BIGINT) AS company_id)
  FROM inv
)"""
# as above, and all of that pair's invoices on one day, with squared ids
_MOVE = "CAST(DATE '2021-06-01' - invoice_date AS INTEGER)"
HOT_DAY_INVOICES = HOT_INVOICES.replace("inv_hot AS", "inv_hot_pair AS") + f""",
inv_hot_day AS (
  SELECT h.* REPLACE (
    CASE WHEN i.invoice_id % 3 = 0 THEN DATE '2021-06-01' ELSE h.invoice_date END AS invoice_date,
    CASE WHEN i.invoice_id % 3 = 0 THEN h.due_date + i.move ELSE h.due_date END AS due_date,
    CASE WHEN i.invoice_id % 3 = 0 THEN h.payment_date + i.move ELSE h.payment_date END AS payment_date,
    CASE WHEN i.invoice_id % 3 = 0 THEN h.create_date + i.move ELSE h.create_date END AS create_date,
    h.invoice_id * h.invoice_id AS invoice_id)
  FROM inv_hot_pair h JOIN (SELECT invoice_id, {_MOVE} AS move FROM inv) i ON h.invoice_id = i.invoice_id
)"""
HOT_DAY_CHAIN = "WITH " + ",".join(
    [INVOICES, HOT_DAY_INVOICES, CLEAN.replace("FROM inv\n", "FROM inv_hot_day\n"), FEATURES])
HOT_CHAIN = "WITH " + ",".join([INVOICES, HOT_INVOICES, CLEAN.replace("FROM inv\n", "FROM inv_hot\n"), FEATURES])


def with_chain(select: str) -> str:
    return f"{CHAIN}\n{select}"


def with_hot_day_chain(select: str) -> str:
    return f"{HOT_DAY_CHAIN}\n{select}"


def with_hot_chain(select: str) -> str:
    return f"{HOT_CHAIN}\n{select}"
