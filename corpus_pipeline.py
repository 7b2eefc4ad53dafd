"""A training corpus from ``documents``: quality, near-dedup, PII, mixing, BPE.

Every stage takes (spark, docs, sf_dir), works on all rows of its predecessor
and, but for the last, returns the columns of ``docs``. ``run`` writes each
result as Parquet in the shared checkpoint folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.bpe import bpe_encode
from arrears.llm.minhash_join import KEY, set_classes, set_keys
from arrears.llm.mixing import mix_copies
from arrears.llm.pii import detect_pii
from arrears.llm.quality_model import score_quality
from arrears.session import materialize


def _whole_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and all else as one struct, so that no column name can clash with a stage's own."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_row"))


def _columns(docs: DataFrame, new: dict) -> list:
    return [new[c].alias(c) if c in new else F.col("_row").getField(c).alias(c) for c in docs.columns]


def quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; labels of held-out rows are never learned from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(_whole_rows(docs), labels, keep=["_row", "text"]).filter("predicted = 1").select(*_columns(docs, {"text": F.col("text")}))


def near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every near-duplicate class: its smallest doc_id, there by set, then by a hash of the text.

    Rows with a null doc_id and blank texts are in no class and stay.
    """
    _, sets = set_classes(docs.select("doc_id", "text"))
    first = sets.groupBy("class").agg(F.min(F.struct(F.col("first").alias("_id"), *KEY)).alias("one")).select("one.*")
    rows = _whole_rows(docs).withColumn("_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    keep = ("_id", "text", "_row")
    rows = rows.select(*keep).mapInArrow(set_keys(5, keep), ", ".join(f"{c} {kinds[c]}" for c in keep) + ", n_shingles long, lo long, hi long")
    exempt = F.col("_id").isNull() | (F.col("n_shingles") == 0)
    # a number each, so that rows which stay anyway never meet in one task
    rows = rows.withColumn("_stays", exempt).withColumn("lo", F.when(exempt, F.monotonically_increasing_id()).otherwise(F.col("lo")))
    key = ["_id", *KEY]
    met = rows.join(first.withColumn("_first", F.lit(True)), key, "left").filter("_stays or _first")
    nth = met.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("text"))))
    return nth.filter("_stays or _nth = 1").select(*_columns(docs, {"text": F.col("text")}))


def pii(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the new text."""
    found = detect_pii(_whole_rows(docs), keep=["_row"], mask=True)
    new = {"text": F.col("masked"), "n_chars": F.length("masked").cast("long")}
    return found.select(*_columns(docs, new))


def mixing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; rows that share doc_id, source and size are told apart by their texts."""
    key = ("_id", "_source", "_size")
    copies = mix_copies(docs.select("doc_id", "source", "text")).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("copies").alias("_copies"))
    copies = copies.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy("_copies")))
    rows = docs.select(F.struct("*").alias("_row")).select(
        "_row", F.col("_row.doc_id").cast("long").alias("_id"), F.col("_row.source").cast("string").alias("_source"),
        F.coalesce(F.regexp_count("_row.text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("_size"))
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("_row.text"))))
    its = copies.filter("_copies > 0").select(*[F.col(c).alias(f"its{c}") for c in (*key, "_nth")], "_copies")
    taken = rows.join(its, [F.col(c).eqNullSafe(F.col(f"its{c}")) for c in (*key, "_nth")])
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_row.*")


def bpe(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and decoded, the text read back from them."""
    return bpe_encode(docs.select("doc_id", "text"), decode=True)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("pii", pii), ("mixing", mixing), ("bpe", bpe)]
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
