"""Scans and sinks: CSV and Parquet invoices, training set, predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.columns import bucket_label
from ..schema import INVOICE_CSV_SCHEMA, TRAINING_SET_SCHEMA
from ..session import compiled_methods
from .committed import commit, current_folder


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name (IO3)."""
    return df.toDF(*[c.lower() for c in df.columns])


def read_invoices_csv(spark: SparkSession, path: str, schema=INVOICE_CSV_SCHEMA, infer: bool = True) -> DataFrame:
    """CSV with a header (IO1). Dates stay text until ``parse_dates``.

    Columns are matched by lower-cased name in any order. Those that the schema
    does not know come along with the type that all their values have
    (``infer_types``), or as text without ``infer``.
    """
    return normalize_columns(_csv_by_name(spark, path, schema, infer))


#: types a text column may turn out to have, narrowest first; text is above all
TYPE_LATTICE = ("boolean", "bigint", "double", "date")


def infer_types(df: DataFrame, columns) -> dict[str, str]:
    """{column: type} of text columns: the narrowest of ``TYPE_LATTICE`` that every value can be cast to, else string.

    One aggregate for all columns (combined before the shuffle, one row to the
    driver). Nulls and blanks fit every type; a column without values is text.
    """
    columns = list(columns)
    if not columns:
        return {}
    value = {c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) for c in columns}
    sums = [F.count(value[c]).alias(f"n{i}") for i, c in enumerate(columns)]
    sums += [F.count(value[c].try_cast(t)).alias(f"n{i}{t}") for i, c in enumerate(columns) for t in TYPE_LATTICE]
    seen = df.agg(*sums).first()
    return {c: next((t for t in TYPE_LATTICE if seen[f"n{i}"] and seen[f"n{i}{t}"] == seen[f"n{i}"]), "string") for i, c in enumerate(columns)}


def _csv_by_name(spark: SparkSession, path: str, schema: StructType, infer: bool = False) -> DataFrame:
    kinds = {f.name.lower(): f.dataType for f in schema.fields}
    header = spark.read.option("header", True).csv(path).columns
    found = StructType([StructField(c, kinds.get(c.lower(), StringType())) for c in header])
    rows = spark.read.option("header", True).option("dateFormat", "yyyy-MM-dd").option("enforceSchema", False).schema(found).csv(path)
    if not infer:
        return rows
    types = infer_types(rows, [c for c in header if c.lower() not in kinds])
    return rows.withColumns({c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).try_cast(t) for c, t in types.items() if t != "string"})


def rejected_rows(spark: SparkSession, path: str, schema=INVOICE_CSV_SCHEMA) -> DataFrame:
    """Rows of a CSV in which a declared column holds what its type cannot read: the row as JSON, and reasons (column: value)."""
    kinds = {f.name.lower(): f.dataType for f in schema.fields}
    rows = spark.read.option("header", True).option("inferSchema", False).csv(path)
    reasons = []
    for c in rows.columns:
        kind = kinds.get(c.lower())
        if kind is not None and not isinstance(kind, StringType):
            bad = F.col(f"`{c}`").isNotNull() & F.trim(F.col(f"`{c}`")).try_cast(kind).isNull()
            reasons.append(F.when(bad, F.concat(F.lit(f"{c.lower()}: "), F.col(f"`{c}`"))))
    told = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return rows.select(F.to_json(F.struct("*")).alias("row"), told.alias("reasons")).filter(F.size("reasons") > 0)


def read_invoices_parquet(spark: SparkSession, path_or_table: str) -> DataFrame:
    """Registered table or Parquet folder (IO2)."""
    if "/" in path_or_table or path_or_table.endswith(".parquet"):
        return normalize_columns(spark.read.parquet(path_or_table))
    return normalize_columns(spark.table(path_or_table))


def write_invoices_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def write_training_set(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", fingerprint: str | None = None) -> None:
    """Training-set sink (IO4), partitioned by invoice year so the year split prunes files; committed at once.

    ``mode="append"`` adds new files to the current folder (e.g. for the streaming scorer).
    """
    # rebalanced by year: one year's rows meet in files of the advisory size, large years in several
    out = df.withColumn("invoice_year", F.year("invoice_date")).hint("rebalance", F.col("invoice_year"))

    def write(folder: str, mode: str = "error") -> None:
        writer = out.write.mode(mode).partitionBy("invoice_year")
        with compiled_methods(df.sparkSession):
            if fmt == "csv":
                writer.option("header", True).csv(folder)
            else:
                writer.parquet(folder)

    if mode == "append":
        write(current_folder(df.sparkSession, path), "append")
    else:
        commit(df.sparkSession, path, write, fingerprint)


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet", fingerprint: str | None = None) -> None:
    """Predictions sink (IO5): features of the test rows plus ``predicted_bucket``; committed at once."""
    def write(folder: str) -> None:
        if fmt == "csv":
            df.write.option("header", True).csv(folder)
        else:
            df.write.parquet(folder)

    commit(df.sparkSession, path, write, fingerprint)


def write_labelled_predictions(df: DataFrame, path: str, prediction_col: str = "predicted_bucket") -> None:
    """Predictions with a text label in ``prediction`` (IO6), as CSV; committed at once."""
    out = df.withColumn("prediction", bucket_label(F.col(prediction_col))).drop(prediction_col)
    commit(df.sparkSession, path, lambda folder: out.write.option("header", True).csv(folder))


def read_predictions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Predictions of ``write_predictions``, or as texts those of ``write_labelled_predictions`` (``fmt="csv"``)."""
    folder = current_folder(spark, path)
    return spark.read.option("header", True).csv(folder) if fmt == "csv" else spark.read.parquet(folder)


def read_training_set(spark: SparkSession, path: str, fmt: str = "parquet", extra: StructType | None = None) -> DataFrame:
    """Training set written by ``write_training_set`` (Parquet or CSV with header).

    CSV is read by column name with the declared schema (dates as yyyy-MM-dd),
    so no inference pass runs over them; ``extra`` declares the caller's own
    columns, whose types are told from their values otherwise. ``invoice_year`` (the
    partition column) stays, so that the year split skips the files of other years.
    """
    path = current_folder(spark, path)
    if fmt == "csv":
        known = TRAINING_SET_SCHEMA.fields + [StructField("invoice_year", IntegerType())]
        return _csv_by_name(spark, path, StructType(known + (extra.fields if extra else [])), infer=True)
    return spark.read.parquet(path)
