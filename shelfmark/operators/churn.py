"""Out-of-time churn models on Spark ML: fit, evaluate, explain, score, persist."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.functions.exprs import as_double, count_where, rnd
from shelfmark.operators.ranking import value_ranks
from shelfmark.session import durable, fresh_dir

# The model inputs, all known at the cutoff, and the thresholds reported.
FEATURES = (
    "recency_days", "completed_orders", "total_revenue", "total_profit", "average_order_value",
    "active_months", "refund_rate", "cancellation_rate", "recent_revenue_ratio",
    "recent_order_ratio", "revenue_trend", "customer_lifetime_days", "account_age_days",
    "order_frequency_monthly",
)
THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7)
LABEL = "is_churned"
PROBABILITY = "churn_probability"


def model_matrix(dataset: DataFrame, *keep: str) -> DataFrame:
    """Model inputs as doubles plus the label and any key columns."""
    return dataset.select(*keep, *[F.col(c).cast("double").alias(c) for c in FEATURES])


def _balanced(train: DataFrame) -> tuple[DataFrame, int]:
    """Weight rows by n / (2 * rows of the class); also return n.

    The two class counts are the only numbers that reach the driver.
    """
    counts = train.agg(
        F.count("*").alias("n"), F.sum(LABEL).cast("long").alias("ones")
    ).first()
    n, ones = counts["n"], counts["ones"] or 0
    if ones in (0, n):
        raise ValueError("the training cohort needs both churned and retained customers")
    weight = F.when(F.col(LABEL) == 1, n / (2.0 * ones)).otherwise(n / (2.0 * (n - ones)))
    return train.withColumn("class_weight", weight), n


@dataclass(frozen=True)
class ChurnModels:
    """The two fitted pipelines; the logistic one is primary."""

    logistic: PipelineModel
    forest: PipelineModel

    def save(self, path: str) -> None:
        self.logistic.write().overwrite().save(f"{path}/logistic_regression")
        self.forest.write().overwrite().save(f"{path}/random_forest")

    @staticmethod
    def load(path: str) -> "ChurnModels":
        return ChurnModels(
            PipelineModel.load(f"{path}/logistic_regression"),
            PipelineModel.load(f"{path}/random_forest"),
        )


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="inputs")


def _read_back(fitted: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The pipeline with its model saved and loaded, that is, without a training summary.

    The summary holds the session, which cannot be sent to tasks once anything was observed in it.
    """
    model, path = fitted.stages[-1], fresh_dir(spark, "model")
    model.write().save(path)
    return PipelineModel([*fitted.stages[:-1], type(model).load(path)])


def fit_logistic(train: DataFrame) -> PipelineModel:
    """Scaler and class weights come from the training rows only.

    The penalty 1/n makes the mean-loss objective equal a sum-loss with unit C. The scaler
    divides by the n-1 deviation; (n-1)/n of the penalty makes the fit that of inputs scaled by
    the population deviation.
    """
    weighted, n = _balanced(train)
    fitted = Pipeline(
        stages=[
            _assembler(),
            StandardScaler(inputCol="inputs", outputCol="features", withMean=True, withStd=True),
            LogisticRegression(
                labelCol=LABEL, weightCol="class_weight", maxIter=1000, regParam=(n - 1.0) / n**2,
                elasticNetParam=0.0, standardization=False,
            ),
        ]
    ).fit(weighted)
    return _read_back(fitted, train.sparkSession)


def fit_forest(train: DataFrame, seed: int = 42) -> PipelineModel:
    """Trees split on raw values, so no scaling."""
    weighted, _ = _balanced(train)
    fitted = Pipeline(
        stages=[
            _assembler(),
            RandomForestClassifier(
                featuresCol="inputs", labelCol=LABEL, weightCol="class_weight", numTrees=100,
                maxDepth=5, minInstancesPerNode=10, seed=seed,
            ),
        ]
    ).fit(weighted)
    return _read_back(fitted, train.sparkSession)


# ------------------------------------------------------------------- proofs of a fit
def _scaled_inputs(model: PipelineModel) -> list[Column]:
    """The scaled model inputs as expressions; a constant input is 0."""
    scaler = model.stages[1]
    pairs = zip(FEATURES, scaler.mean.toArray().tolist(), scaler.std.toArray().tolist())
    return [(F.col(c) - mean) * (1.0 / std if std else 0.0) for c, mean, std in pairs]


def logistic_score(model: PipelineModel) -> Column:
    """The churn probability of a fitted logistic pipeline as an expression over its inputs."""
    fitted = model.stages[-1]
    z = F.lit(float(fitted.intercept))
    for weight, x in zip(fitted.coefficients.toArray().tolist(), _scaled_inputs(model)):
        z = z + x * weight
    return 1.0 / (1.0 + F.exp(-z))


def optimality(model: PipelineModel, train: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Proof that a logistic pipeline is fitted: its training rows, and the largest slope of the
    weighted, penalised mean loss at the fitted coefficients.

    The loss is strictly convex, so a point without slope is its only minimum. All slopes
    come from one pass over the rows.
    """
    weighted, _ = _balanced(train)
    fitted = model.stages[-1]
    miss = F.col("class_weight") * (logistic_score(model) - F.col(LABEL))
    xs = _scaled_inputs(model)
    sums = weighted.agg(
        F.count("*").alias("train_rows"),
        F.sum(LABEL).cast("long").alias("churned_rows"),
        F.sum("class_weight").alias("_w"),
        F.sum(miss).alias("_slope"),
        *[F.sum(miss * x).alias(f"_slope{i}") for i, x in enumerate(xs)],
    )
    pulls = [fitted.getRegParam() * w for w in fitted.coefficients.toArray().tolist()]
    slopes = [F.abs(F.col("_slope") / F.col("_w"))]
    slopes += [F.abs(F.col(f"_slope{i}") / F.col("_w") + pull) for i, pull in enumerate(pulls)]
    return sums.select(
        "train_rows",
        "churned_rows",
        (F.abs(F.col("_w") - F.col("train_rows")) < 1e-6 * F.col("train_rows")).alias("weights_balanced"),
        (F.greatest(*slopes) < tolerance).alias("slopes_vanish"),
    )


def scaler_table(train: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Mean and population deviation of each input over the training rows, from exact sums, and
    whether the fitted scaler has the same."""
    exact = {c: F.col(c).cast("decimal(18,4)") for c in FEATURES}
    sums = train.agg(
        F.count("*").alias("n"),
        *[F.sum(x).alias(f"s_{c}") for c, x in exact.items()],
        *[F.sum(x * x).alias(f"q_{c}") for c, x in exact.items()],
    )
    cells = []
    for i, c in enumerate(FEATURES):
        mean = as_double(f"s_{c}") / as_double("n")
        deviation = F.sqrt(F.greatest(as_double(f"q_{c}") / as_double("n") - mean * mean, F.lit(0.0)))
        agrees = F.lit(None).cast("boolean")
        if model is not None:
            own_mean, own_std = (float(v.toArray()[i]) for v in (model.stages[1].mean, model.stages[1].std))
            sample = deviation * F.sqrt(as_double("n") / (as_double("n") - 1.0))
            agrees = (F.abs(mean - own_mean) <= 1e-6 * (1.0 + F.abs(mean))) & (F.abs(sample - own_std) <= 1e-6 * (1.0 + sample))
        cells.append(F.struct(
            F.lit(c).alias("feature"), F.col("n").alias("train_rows"), rnd(mean, 4).alias("mean"),
            rnd(deviation, 4).alias("deviation"), agrees.alias("scaler_agrees")))
    return sums.select(F.inline(F.array(*cells)))


def forest_nodes(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """The nodes of a fitted forest: tree, node, feature (its index; -1 in a leaf), threshold, the
    nodes to go to, and the share of churned weight. At most trees * 2 ** (depth + 1) rows."""
    path = fresh_dir(spark, "forest")
    model.stages[-1].write().save(path)
    n = F.col("nodeData")
    stats = n["impurityStats"]
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        (F.get(stats, F.lit(1)) / (F.get(stats, F.lit(0)) + F.get(stats, F.lit(1)))).alias("share"),
    )


def score_by_nodes(nodes: DataFrame, rows: DataFrame, key: str, depth: int = 5) -> DataFrame:
    """key and churn probability: each row walks down every tree, one join a level."""
    trees = nodes.select("tree").distinct()
    inputs = F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("inputs")
    roots = trees.agg(F.sort_array(F.collect_set("tree")).alias("trees")).scalar()  # one small number per tree
    at = rows.select(key, inputs, F.explode(roots).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        goes_left = F.get("inputs", F.col("feature")) <= F.col("threshold")
        below = F.when(F.col("feature") < 0, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = at.join(nodes, ["tree", "node"]).select(key, "inputs", "tree", below.alias("node"))
    leaves = at.join(nodes, ["tree", "node"])
    return leaves.groupBy(key).agg(F.avg("share").alias(PROBABILITY))


def disagreements(a: DataFrame, b: DataFrame, key: str, tolerance: float = 1e-9) -> DataFrame:
    """Rows scored, and rows that two scorings of the same keys disagree on or only one has."""
    other = b.select(F.col(key).alias("_key"), F.col(PROBABILITY).alias("_p"))
    both = a.select(key, PROBABILITY).join(other, F.col(key) == F.col("_key"), "full")
    apart = F.coalesce(F.abs(F.col(PROBABILITY) - F.col("_p")) > tolerance, F.lit(True))
    inside = F.coalesce(F.col(PROBABILITY).between(0, 1), F.lit(False))
    return both.agg(
        F.count("*").alias("rows_scored"), count_where(apart).alias("rows_apart"),
        count_where(~inside).alias("rows_out_of_range"))


def training_rows(dataset: DataFrame) -> DataFrame:
    """Model matrix of a labelled dataset, materialised because fitting passes over it often."""
    return durable(model_matrix(dataset, "customer_id", LABEL))


def fit_models(train: DataFrame) -> ChurnModels:
    return ChurnModels(fit_logistic(train), fit_forest(train))


def probability(model: PipelineModel, rows: DataFrame, *keep: str) -> DataFrame:
    """Unrounded churn probability next to the kept columns."""
    scored = model.transform(model_matrix(rows, *keep))
    return scored.select(*keep, vector_to_array("probability")[1].alias(PROBABILITY))


def score_population(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Every customer, also one without orders, with a probability at four digits."""
    return probability(model, features, "customer_id").withColumn(
        PROBABILITY, rnd(PROBABILITY, 4)
    )


# ------------------------------------------------------------------------- metrics
def _share(num: Column, den: Column) -> Column:
    """0 when undefined, as for a precision without positive predictions."""
    return F.when(den > 0, as_double(num) / as_double(den)).otherwise(F.lit(0.0))


def _confusion(threshold: float | Column) -> list[Column]:
    hit, truth = F.col(PROBABILITY) >= threshold, F.col(LABEL) == 1
    return [
        count_where(~hit & ~truth).alias("true_negative"),
        count_where(hit & ~truth).alias("false_positive"),
        count_where(~hit & truth).alias("false_negative"),
        count_where(hit & truth).alias("true_positive"),
    ]


def _rates() -> dict[str, Column]:
    tn, fp, fn, tp = (
        F.col(c) for c in ("true_negative", "false_positive", "false_negative", "true_positive")
    )
    return {
        "accuracy": rnd(_share(tp + tn, tp + tn + fp + fn), 4),
        "precision": rnd(_share(tp, tp + fp), 4),
        "recall": rnd(_share(tp, tp + fn), 4),
        "f1": rnd(_share(2 * tp, 2 * tp + fp + fn), 4),
    }


def roc_auc(scores: DataFrame) -> DataFrame:
    """Exact area under the curve by rank sum; ties share their average rank."""
    ranks = value_ranks(scores, [PROBABILITY], {"positives": F.col(LABEL).cast("long")})
    p, n = F.sum("positives"), F.sum("n_equal")
    rank_sum = F.sum(F.col("positives") * F.col("avg_rank").cast("decimal(20,1)"))
    wins = as_double(rank_sum) - as_double(p) * (as_double(p) + 1) / 2.0
    pairs = as_double(p) * as_double(n - p)
    return ranks.agg(rnd(F.when(pairs > 0, wins / pairs), 4).alias("roc_auc"))


def classification_metrics(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row: confusion matrix, accuracy, precision, recall, F1 and ROC-AUC."""
    auc = roc_auc(scores).scalar()
    return scores.agg(*_confusion(threshold)).withColumns({**_rates(), "roc_auc": auc})


def threshold_table(scores: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """Precision, recall, F1, targeted customers and false alarms per decision threshold.

    All thresholds are counted in one pass over the scores.
    """
    per_threshold = scores.agg(
        F.array(
            *[F.struct(F.lit(t).alias("threshold"), *_confusion(t)) for t in thresholds]
        ).alias("cells")
    )
    cells = per_threshold.select(F.inline("cells"))
    rates = _rates()
    return cells.select(
        "threshold",
        *[rates[name].alias(name) for name in ("precision", "recall", "f1")],
        (F.col("true_positive") + F.col("false_positive")).alias("targeted_count"),
        F.col("false_positive").alias("false_alarms"),
    )


def _feature_table(spark: SparkSession, values: list[float], name: str) -> DataFrame:
    rows = [(feature, float(v)) for feature, v in zip(FEATURES, values)]
    return spark.createDataFrame(rows, f"feature string, {name} double").orderBy(F.desc(name))


def coefficients(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Coefficients of inputs scaled by the population deviation, largest (most churn) first."""
    fitted = model.stages[-1]
    penalty = fitted.getRegParam()  # (n - 1) / n**2
    n = (1 + math.sqrt(max(0.0, 1 - 4 * penalty))) / (2 * penalty)
    scale = math.sqrt((n - 1) / n)
    return _feature_table(spark, [scale * c for c in fitted.coefficients.toArray()], "coefficient")


def importances(model: PipelineModel, spark: SparkSession) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray().tolist()
    return _feature_table(spark, values, "importance")
