"""Region codes (C11), delay bucket (C12) and bucket text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import payment_bucket
from ..params import LABEL, REGION_COLUMNS
from ..session import materialize
from .profile import global_index

def region_dictionary(df: DataFrame, columns=REGION_COLUMNS) -> DataFrame:
    """(column_name, value, code) for several columns in one pass.

    The columns are stacked and de-duplicated together; the distinct values
    are numbered by a range-partitioned sort and the codes count from each
    column's first position.
    """
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("kv")).select("kv.*").where(F.col("value").isNotNull()).distinct()
    indexed = global_index(stacked, ["column_name", "value"], "_pos")
    starts = indexed.groupBy("column_name").agg(F.min("_pos").alias("_start"))  # one row per column
    return indexed.join(starts, "column_name").select(
        "column_name", "value", (F.col("_pos") - F.col("_start")).cast("int").alias("code"))


def region_codes(df: DataFrame, columns=REGION_COLUMNS, dictionary: DataFrame | None = None) -> DataFrame:
    """Replace each region column by its category code; NULL or unseen -> -1 (C11).

    One dictionary pass for all columns (or a dictionary fitted earlier, e.g.
    on training data when scoring new invoices). It is written once, so Spark
    picks the join by its size in bytes.
    """
    codes = dictionary if dictionary is not None else materialize(region_dictionary(df, columns), "region-codes")
    out = df
    for c in columns:
        d = codes.where(F.col("column_name") == c).select(F.col("value").alias(c), F.col("code").alias("_code"))
        out = out.join(d, c, "left").withColumn(c, F.coalesce(F.col("_code"), F.lit(-1))).drop("_code")
    return out


def add_payment_bucket(df: DataFrame, delay: str = "delay_days") -> DataFrame:
    """C12 as ``payment_bucket`` (int)."""
    return df.withColumn(LABEL, payment_bucket(delay).cast("int"))
