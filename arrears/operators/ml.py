"""Spark ML models of the delay bucket: M1-M7, M10, M11.

* random forest (the default model), multinomial logistic regression after
  scaling, and boosted trees by ``operators/boosting.py`` (Spark's own boosting
  is binary only and has no leaf cap and no L1 or L2);
* the tuned boosting preset keeps all its sizes;
* class weights enter through a weight column.
"""

from __future__ import annotations

import os
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from ..params import LABEL, NON_FEATURE_COLUMNS, TUNED_BOOSTING
from ..session import ensure_checkpoint_dir
from .boosting import BoostingModel, BoostingParams, HistogramBoosting, depthwise_defaults, tuned_params
from .forest import DeepForest, DeepForestModel
from .evaluate import confusion_counts, metrics_from_counts

ID_COLUMNS = ("invoice_id", "customer_id", "company_id")


def feature_columns(df: DataFrame, include_ids: bool = True, label: str = LABEL) -> list[str]:
    """Every number or flag left after the projection (F10), ids included by default (M1).

    The caller's own numeric columns are features too; texts, dates and nested columns are carried only.
    """
    skip = set(NON_FEATURE_COLUMNS) | {label, "weight", "invoice_year"}
    if not include_ids:
        skip |= set(ID_COLUMNS)
    return [f.name for f in df.schema.fields
            if f.name not in skip and isinstance(f.dataType, (NumericType, BooleanType))]


def assembler(columns, output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="keep")


def feature_vector(df: DataFrame, columns) -> DataFrame:
    """M1: the assembled feature vector next to the label."""
    return assembler(columns).transform(df)


def random_forest(num_trees: int = 100, max_depth: int = 10, seed: int = 0, weighted: bool = True,
                  label: str = LABEL) -> RandomForestClassifier:
    """Spark's forest, depth ``max_depth``: the training step's default model."""
    # node ids cached on executors and a larger node batch: about one pass per tree level, so their lineage
    # stays short and is not checkpointed (a checkpoint holds a number per row and tree)
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees, maxDepth=max_depth,
                                seed=seed, maxBins=64, maxMemoryInMB=1024, cacheNodeIds=True,
                                checkpointInterval=-1)
    if weighted:
        rf.setWeightCol("weight")
    return rf


def deep_forest(num_trees: int = 100, seed: int = 0, weighted: bool = False, label: str = LABEL) -> DeepForest:
    """M2 with the original library's defaults: 100 trees without a depth limit."""
    return DeepForest(num_trees, weight="weight" if weighted else None, label=label, seed=seed)


def boosted_trees(params: BoostingParams = depthwise_defaults(), weighted: bool = False, label: str = LABEL) -> HistogramBoosting:
    """M3: boosting of all classes at once, by default with the depth-wise libraries' default sizes;
    ``BoostingParams()`` are those of the leaf-wise ones."""
    return HistogramBoosting(params, weight="weight" if weighted else None, label=label)


def tuned_boosting(rounds: int = TUNED_BOOSTING["n_estimators"], weighted: bool = True,
                   label: str = LABEL) -> HistogramBoosting:
    """M5: the tuned preset with all its sizes and rounds; another number of ``rounds`` is another model."""
    return boosted_trees(tuned_params(rounds), weighted, label)


def logistic_regression(max_iter: int = 100, weighted: bool = True, label: str = LABEL) -> LogisticRegression:
    """M4 (multinomial, on standardised features)."""
    lr = LogisticRegression(featuresCol="scaled", labelCol=label, family="multinomial", maxIter=max_iter)
    if weighted:
        lr.setWeightCol("weight")
    return lr


def model_pipeline(estimator, columns) -> Pipeline:
    stages = [assembler(columns)]
    if isinstance(estimator, LogisticRegression):
        stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True))
    return Pipeline(stages=stages + [estimator])


def spread(train: DataFrame, task_rows: int = 50_000) -> DataFrame:
    """Training rows dealt evenly over at most ``task_rows`` a task: files of a year each would be one task's share."""
    n, cores = train.count(), train.sparkSession.sparkContext.defaultParallelism
    return train.repartition(max(1, -(-n // task_rows), min(cores, n // 2000)))


#: each task of a forest's pass shuffles counters of all nodes of the level (18 KB a node), however few its rows are
FOREST_TASK_ROWS = 500_000


def fit(train: DataFrame, estimator, columns) -> PipelineModel:
    rows = spread(train, FOREST_TASK_ROWS) if isinstance(estimator, RandomForestClassifier) else spread(train)
    return model_pipeline(estimator, columns).fit(rows)


def spread_scoring(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows to score dealt by a hash of their features; their number decides how many tasks share them (adaptive execution)."""
    inputs = [c for stage in model.stages if isinstance(stage, VectorAssembler) for c in stage.getInputCols()]
    return df.repartition(F.xxhash64(*[F.col(f"`{c}`") for c in inputs])) if inputs else df


def predict(model: PipelineModel, df: DataFrame, keep_vectors: bool = False) -> DataFrame:
    """M6: ``predicted_bucket`` (int); M7: ``probability`` kept when asked."""
    out = model.transform(spread_scoring(model, df)).withColumn("predicted_bucket", F.col("prediction").cast("int"))
    if not keep_vectors:
        out = out.drop("features", "scaled", "rawPrediction", "probability", "prediction")
    return out


def class_probabilities(model: PipelineModel, df: DataFrame, n_classes: int = 5) -> DataFrame:
    """M7: per-class probabilities as ``p_0..p_k``."""
    out = model.transform(spread_scoring(model, df))
    arr = vector_to_array("probability")
    return out.select("invoice_id", *[arr[k].alias(f"p_{k}") for k in range(n_classes)],
                      F.col("prediction").cast("int").alias("predicted_bucket"))


def save_model(model: PipelineModel, path: str) -> None:
    """IO7: Spark ML persistence (replaces pickling)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _tree_ensembles(model: PipelineModel):
    """Spark's tree-ensemble models inside a fitted pipeline."""
    return [stage for stage in model.stages if hasattr(stage, "trees")]


def split_counts(spark, model: PipelineModel, columns) -> DataFrame:
    """How often each feature is used in a split, summed over all trees.

    Each tree ensemble is saved under the checkpoint folder and its node table
    (``data``: one row per node) is read back with Spark and aggregated, so
    this works on any file system the cluster uses.
    """
    root = os.path.join(ensure_checkpoint_dir(spark), f"model-{uuid.uuid4().hex}")
    names = spark.createDataFrame([(i, c) for i, c in enumerate(columns)], "feature_index int, feature string")
    for stage in model.stages:
        if isinstance(stage, (BoostingModel, DeepForestModel)):
            return spark.createDataFrame([(columns[f], n) for f, n in stage.split_counts().items()], "feature string, splits long")
    nodes = None
    for k, ensemble in enumerate(_tree_ensembles(model)):
        path = os.path.join(root, str(k))
        ensemble.write().overwrite().save(path)
        t = spark.read.parquet(os.path.join(path, "data")).select(
            F.col("nodeData.split.featureIndex").alias("feature_index"), F.col("nodeData.leftChild").alias("left"))
        nodes = t if nodes is None else nodes.unionByName(t)
    if nodes is None:
        return names.select("feature", F.lit(0).cast("long").alias("splits")).limit(0)
    counts = nodes.where(F.col("left") >= 0).groupBy("feature_index").agg(F.count(F.lit(1)).alias("splits"))
    return counts.join(F.broadcast(names), "feature_index").select("feature", "splits")


def feature_importance_top(spark, model: PipelineModel, columns, k: int = 10) -> DataFrame:
    """Top ``k`` features by split count."""
    return split_counts(spark, model, columns).orderBy(F.desc("splits"), "feature").limit(k)


class MacroF1Evaluator(Evaluator):
    """Macro F1 from the (label, prediction) counts; larger is better."""

    def __init__(self, labelCol: str = LABEL, predictionCol: str = "prediction"):
        super().__init__()
        self.labelCol = labelCol
        self.predictionCol = predictionCol

    def _evaluate(self, dataset: DataFrame) -> float:
        m = metrics_from_counts(confusion_counts(dataset, self.labelCol, self.predictionCol))
        return float(m.first()["f1"])

    def isLargerBetter(self) -> bool:
        return True


def tune(train: DataFrame, columns, grid=None, seed: int = 0, train_ratio: float = 0.75):
    """Grid search on macro F1 with a train/validation split.

    Returns (best pipeline model, DataFrame of (params, macro_f1)).
    """
    rf = random_forest(seed=seed)
    pipe = model_pipeline(rf, columns)
    grid = grid or ParamGridBuilder().addGrid(rf.numTrees, [20, 50]).addGrid(rf.maxDepth, [6, 10]).build()
    tvs = TrainValidationSplit(estimator=pipe, estimatorParamMaps=grid, evaluator=MacroF1Evaluator(),
                               trainRatio=train_ratio, seed=seed, parallelism=2)
    fitted = tvs.fit(spread(train, FOREST_TASK_ROWS))
    rows = [(", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name)), float(m))
            for pm, m in zip(grid, fitted.validationMetrics)]
    spark = train.sparkSession
    return fitted.bestModel, spark.createDataFrame(rows, "params string, macro_f1 double")
