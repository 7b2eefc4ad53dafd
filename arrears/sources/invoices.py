"""The invoice fact table derived from the generated TPC-H-like tables.

One invoice per order: ``orders`` joined to ``customer``, ``nation`` and
``region``. The order date is shifted by 22 years so that the year filter and
the year split of the model see populated years. All other columns follow a
fixed arithmetic rule on the order and customer keys (see FIXTURES.md §4), so
the same table can be written in SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import INVOICE_SCHEMA


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days(d: Column, n: Column) -> Column:
    return F.date_add(d, n.cast("int"))


def invoice_columns(o: DataFrame) -> DataFrame:
    """Per-order invoice columns (no join); pure column arithmetic on ``orders``."""
    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    d0 = F.add_months(F.col("o_orderdate").cast("date"), 264)
    delay = ((k * 7 + ck * 13) % 41) + (ck % 5) * (F.expr("o_orderkey div 3") % 11) - 15
    due = F.when(k % 89 == 7, F.date_sub(d0, 1)).otherwise(_days(d0, F.lit(15) * (1 + ck % 4)))
    return o.select(
        k.alias("invoice_id"),
        ck.alias("customer_id"),
        F.when(k % 97 == 5, F.lit(-1)).otherwise(k % 3).cast("long").alias("company_id"),
        d0.alias("invoice_date"),
        F.when(k % 83 == 4, F.col("o_orderdate").cast("date"))
        .otherwise(_days(d0, k % 3)).alias("create_date"),
        due.alias("due_date"),
        F.when(k % 5 == 0, F.date_add(d0, 7)).alias("due_discount_date"),
        F.when(k % 53 == 11, F.lit(None).cast("date"))
        .otherwise(_days(due, delay)).alias("payment_date"),
        F.when(k % 61 == 3, F.lit(10.0)).when(k % 7 == 0, F.lit(None))
        .otherwise(F.lit(0.0)).cast("double").alias("payment_amount"),
        F.when((k % 53 == 11) | (k % 43 == 9), F.lit("N")).otherwise(F.lit("Y"))
        .alias("payment_complete"),
        F.when(k % 71 == 2, -F.col("o_totalprice")).when(k % 101 == 6, F.lit(None))
        .otherwise(F.col("o_totalprice")).cast("double").alias("net_amount"),
        k.alias("_k"),
    )


def invoices_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invoice fixture written once as a flat Parquet table and read back.

    This mirrors the real input (a stored invoice table): the cleaning
    filters then reach the Parquet scan, instead of re-deriving every date
    expression inside the filter.
    """
    from ..session import materialize

    return materialize(invoices_from_tables(spark, sf_dir), "invoices")


def invoices_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw ``invoices`` table (schema ``INVOICE_SCHEMA``)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # no hints: the stored sizes of the tables decide the joins
    geo = n.join(r, n.n_regionkey == r.r_regionkey)
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        "c_custkey", "c_mktsegment", "n_name", "r_name"
    )
    inv = invoice_columns(o).join(cust, F.col("customer_id") == cust.c_custkey)
    return inv.select(
        *[f.name for f in INVOICE_SCHEMA.fields if not f.name.startswith("region")],
        F.col("r_name").alias("region_level1"),
        F.col("n_name").alias("region_level2"),
        F.when(F.col("_k") % 103 == 8, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment")).alias("region_level3"),
    )


def with_hot_pair(invoices: DataFrame, every: int = 3, customer_id: int = 0, company_id: int = 0) -> DataFrame:
    """Skew check input: every ``every``-th invoice re-keyed onto one (customer, company) pair.

    With the default a third of all invoices share one key, the worst case the
    history operator is built for. No row is dropped.
    """
    hot = F.col("invoice_id") % every == 0
    return invoices.withColumns({
        "customer_id": F.when(hot, F.lit(customer_id).cast("long")).otherwise(F.col("customer_id")),
        "company_id": F.when(hot, F.lit(company_id).cast("long")).otherwise(F.col("company_id")),
    })


def with_hot_day(invoices: DataFrame, every: int = 3, customer_id: int = 0, company_id: int = 0) -> DataFrame:
    """Skew check input: like ``with_hot_pair``, and all of the pair's invoices on one day with uneven ids.

    The day is 1 June 2021, payment and due date move along by the same number
    of days. Ids are squared, so a day's ids lie far from evenly spread.
    """
    hot = F.col("invoice_id") % every == 0
    day = F.lit("2021-06-01").cast("date")
    shift = F.date_diff(day, "invoice_date")
    moved = with_hot_pair(invoices, every, customer_id, company_id).withColumns({
        c: F.when(hot, F.date_add(c, shift)).otherwise(F.col(c)) for c in ("due_date", "payment_date", "create_date")})
    return moved.withColumns({
        "invoice_date": F.when(hot, day).otherwise(F.col("invoice_date")),
        "invoice_id": F.col("invoice_id") * F.col("invoice_id"),
    })
