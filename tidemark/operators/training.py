"""Training frames, splits, class-weighted models, evaluation and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isclose
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.worker import once_per_worker
from tidemark.operators.asof import asof_join
from tidemark.operators.featureview import FeatureView
from tidemark.operators.online import model_input
from tidemark.schemas import LABEL, MODEL_FEATURES, MODEL_REFS, PREDICTION_COLUMNS, require_columns
from tidemark.session import scratch_dir


@dataclass(frozen=True)
class TrainingConfig:
    """Split shares, seed, rounds and patience of the default training run."""

    train_split: float = 0.7
    val_split: float = 0.15
    test_split: float = 0.15
    seed: int = 42
    max_iter: int = 50
    threshold: float = 0.5
    reg_params: tuple[float, ...] = (0.0001, 0.01)
    boosted_trees: bool = True
    features: tuple[str, ...] = field(default=MODEL_FEATURES)
    label: str = LABEL

    def __post_init__(self):
        shares = (self.train_split, self.val_split, self.test_split)
        if min(shares) < 0 or not isclose(sum(shares), 1.0, abs_tol=1e-9):
            raise ValueError(f"the shares {shares} do not make up the whole")


def training_frame(spine: DataFrame, views: list[FeatureView], refs=MODEL_REFS, **options) -> DataFrame:
    """Entity rows with their point-in-time features; rows lacking a feature are dropped."""
    features = [r.partition(":")[2] for r in refs]
    require_columns(spine.columns, ("user_id", "event_timestamp", LABEL), "entity rows")
    joined = asof_join(spine, views, refs, **options)
    require_columns(joined.columns, features, "historical features")
    return joined.dropna(subset=features).withColumn(LABEL, F.col(LABEL).cast("int"))


def split_share(keys: list[str], seed: int) -> Column:
    """A number in [0, 1) that depends on the key columns and the seed only."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def split(
    frame: DataFrame, config: TrainingConfig = TrainingConfig(), keys=("user_id", "event_timestamp")
) -> DataFrame:
    """Add ``split`` = train / val / test.

    A hash of the row key decides, so the split needs no shuffle, is the same for any
    partitioning, and holds the shares within each class up to sampling error.
    """
    share = split_share(list(keys), config.seed)
    train, val = config.train_split, config.train_split + config.val_split
    name = F.when(share < train, "train").when(share < val, "val").otherwise("test")
    return frame.withColumn("split", name)


def stratified_split(
    frame: DataFrame, config: TrainingConfig = TrainingConfig(), keys=("user_id", "event_timestamp"), bins: int = 10_000
) -> DataFrame:
    """Add ``split`` with the exact shares within each class (rounded to whole rows).

    Rows are ordered by the same hash as in ``split``. Their order is found in bins of
    the hash: the counts of the bins are accumulated per class (at most ``bins`` rows
    each), the rows are numbered within their bin, which the hash keeps even.
    """
    share = split_share(list(keys), config.seed)
    rows = frame.withColumn("_share", share).withColumn("_bin", F.floor(F.col("_share") * bins).cast("int"))
    counts = rows.groupBy(config.label, "_bin").agg(F.count("*").alias("_n"))
    by_class = Window.partitionBy(config.label)
    before = by_class.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.select(
        config.label,
        "_bin",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(by_class).alias("_total"),
    )
    inside = Window.partitionBy(config.label, "_bin").orderBy("_share", *keys)
    ranked = rows.withColumn("_rank", F.row_number().over(inside)).join(totals, [config.label, "_bin"])
    place = F.col("_before") + F.col("_rank")

    def end(part: float):
        return F.round(F.col("_total") * part)

    name = (
        F.when(place <= end(config.train_split), "train")
        .when(place <= end(config.train_split + config.val_split), "val")
        .otherwise("test")
    )
    return ranked.withColumn("split", name).select(*frame.columns, "split")


def positive_weight(frame: DataFrame, label: str = LABEL) -> float:
    row = frame.agg(F.sum(F.col(label).cast("bigint")).alias("p"), F.count(label).alias("n")).first()
    return (row["n"] - row["p"]) / row["p"] if row["p"] else 1.0


def _candidates(config: TrainingConfig) -> list[tuple[str, list]]:
    common = {"labelCol": config.label, "weightCol": "_weight"}
    scaler = StandardScaler(inputCol="_raw", outputCol="_x", withMean=True, withStd=True)
    out = []
    for reg in config.reg_params:
        lr = LogisticRegression(featuresCol="_x", regParam=reg, maxIter=config.max_iter, **common)
        out.append((f"logistic_{reg}", [scaler, lr]))
    if config.boosted_trees:
        gbt = GBTClassifier(
            featuresCol="_raw", maxDepth=4, maxIter=config.max_iter, seed=config.seed,
            validationIndicatorCol="_held_out", validationTol=0.001, **common,
        )
        out.append(("boosted_trees", [gbt]))
    return out


def _probability(scored: DataFrame) -> Column:
    return vector_to_array(F.col("probability"))[1]


def weighted_loss(scored: DataFrame, weight: float, label: str = LABEL, prob: str = "anomaly_score") -> float:
    """Mean class-weighted log loss."""
    p = F.greatest(F.least(F.col(prob), F.lit(1 - 1e-12)), F.lit(1e-12))
    loss = F.when(F.col(label) > 0, -weight * F.log(p)).otherwise(-F.log(1 - p))
    return scored.agg(F.avg(loss)).first()[0]


def _stored(model: PipelineModel) -> PipelineModel:
    """The model as read back from shared storage.

    A freshly fitted model drags its training summary, and with it the session, into
    every task that applies it.
    """
    path = scratch_dir(SparkSession.active(), "model")
    model.write().save(path)
    return PipelineModel.load(path)


def fit(frame: DataFrame, config: TrainingConfig = TrainingConfig()) -> tuple[PipelineModel, dict[str, float | str]]:
    """Fit the candidates on the train part and keep the one with the least validation loss.

    ``frame`` carries ``split``; pass a written table, it is read once per pass of the
    solver. Boosting stops by itself on the validation part.
    """
    weight = positive_weight(frame.filter("split = 'train'"), config.label)
    ready = frame.filter(F.col("split").isin("train", "val")).withColumns(
        {
            "_weight": F.when(F.col(config.label) > 0, F.lit(weight)).otherwise(F.lit(1.0)),
            "_held_out": F.col("split") == "val",
        }
    )
    train = ready.filter("not _held_out")
    assemble = VectorAssembler(inputCols=list(config.features), outputCol="_raw")
    best = None
    for name, stages in _candidates(config):
        source = ready if name == "boosted_trees" else train
        model = _stored(Pipeline(stages=[assemble, *stages]).fit(source))
        scored = apply_model(model, ready)
        val_loss = weighted_loss(scored.filter("_held_out"), weight, config.label)
        if best is None or val_loss < best[1]["val_loss"]:
            train_loss = weighted_loss(scored.filter("not _held_out"), weight, config.label)
            best = (model, {"model": name, "train_loss": train_loss, "val_loss": val_loss, "train_pos_weight": weight})
    model, metrics = best
    held_out = evaluate(apply_model(model, ready.filter("_held_out")), config.threshold, config.label)
    metrics.update({f"val_{r['metric']}": r["value"] for r in held_out.collect()})
    return model, metrics


def apply_model(model: PipelineModel, frame: DataFrame) -> DataFrame:
    kept = frame.columns
    return model.transform(frame).select(*kept, _probability(frame).alias("anomaly_score"))


def apply_foreign_model(
    frame: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.Series]], features=MODEL_FEATURES
) -> DataFrame:
    """Score with a model from outside Spark ML: ``load`` returns a function from a feature frame to
    probabilities and runs once per Python worker."""
    kept = once_per_worker("model", load)

    @F.pandas_udf("double")
    def probability(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = kept()
        for columns in batches:
            yield pd.Series(model(pd.concat(columns, axis=1, keys=features)))

    inputs = [F.col(c).cast("double") for c in features]
    return frame.withColumn("anomaly_score", probability(*inputs))


def _auc(scored: DataFrame, label: str) -> DataFrame:
    """Exact area under the ROC curve from rank sums.

    Equal scores are counted together first. Sampled quantiles cut the score axis into
    even ranges that are ranked side by side; only the totals of the ranges, of which
    there are at most a thousand, are accumulated in one place.
    """
    cuts = scored.approxQuantile("score", [i / 256 for i in range(1, 256)], 0.002)
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    by_score = scored.groupBy("score").agg(F.sum(label).alias("pos"), F.sum(1 - F.col(label)).alias("neg"))
    ranged = Bucketizer(splits=splits, inputCol="score", outputCol="range").transform(by_score)
    totals = ranged.groupBy("range").agg(F.sum("neg").alias("range_neg"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("range", F.coalesce(F.sum("range_neg").over(before), F.lit(0)).alias("neg_before"))
    inside = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("neg_inside", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(totals, "range")
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg_inside") + F.col("neg") / 2))
    return ranked.agg((wins / (F.sum("pos") * F.sum("neg"))).alias("value")).select(
        F.lit("roc_auc").alias("metric"), "value"
    )


def confusion(scored: DataFrame, threshold: float = 0.5, label: str = LABEL) -> DataFrame:
    hit, pos = F.col("anomaly_score") >= threshold, F.col(label) > 0
    return scored.agg(
        F.count_if(hit & pos).alias("tp"),
        F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"),
        F.count_if(~hit & ~pos).alias("tn"),
    )


def evaluate(scored: DataFrame, threshold: float = 0.5, label: str = LABEL) -> DataFrame:
    """``(metric, value)``: accuracy, precision, recall, f1 and, with both classes present, roc_auc."""
    c = confusion(scored, threshold, label).first()
    tp, fp, fn, tn = c["tp"], c["fp"], c["fn"], c["tn"]
    n = tp + fp + fn + tn
    if n == 0:
        raise ValueError("Evaluation frame is empty.")
    metrics = {
        "accuracy": (tp + tn) / n,
        "precision": tp / (tp + fp) if tp + fp else 0.0,
        "recall": tp / (tp + fn) if tp + fn else 0.0,
        "f1": 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0,
    }
    spark = scored.sparkSession
    out = spark.createDataFrame(sorted(metrics.items()), "metric string, value double")
    if tp + fn and fp + tn:
        narrow = scored.select(F.col("anomaly_score").alias("score"), F.col(label).cast("bigint").alias(label))
        out = out.unionByName(_auc(narrow, label))
    return out


def predict(model: PipelineModel, rows: DataFrame, threshold: float = 0.5, version: str = "1") -> DataFrame:
    """Scored answers: transaction_id, anomaly_score, is_anomaly, model_version."""
    scored = apply_model(model, rows)
    return scored.withColumns(
        {"is_anomaly": F.col("anomaly_score") >= threshold, "model_version": F.lit(version)}
    ).select(*PREDICTION_COLUMNS)


def score(
    looked_up: DataFrame, model: PipelineModel, threshold: float = 0.5, version: str = "1"
) -> tuple[DataFrame, DataFrame]:
    """Score looked-up requests; those lacking a feature come back as rejects with the reason."""
    rows, rejects = model_input(looked_up, carry=("transaction_id",))
    return predict(model, rows, threshold, version), rejects


def predictions_by_result(predictions: DataFrame) -> DataFrame:
    result = F.when(F.col("is_anomaly"), "anomaly").otherwise("normal")
    return predictions.groupBy(result.alias("result")).agg(F.count("*").alias("predictions"))


def run_tables(spark, metrics: dict, config: TrainingConfig, refs=MODEL_REFS) -> dict[str, DataFrame]:
    """Parameters, metrics (sorted by name) and the feature list of a run as small tables."""
    params = {k: str(v) for k, v in vars(config).items()}
    params["feature_count"] = str(len(config.features))
    numbers = {k: float(v) for k, v in metrics.items() if not isinstance(v, str)}
    params.update({k: v for k, v in metrics.items() if isinstance(v, str)})
    features = [(i, f, r) for i, (f, r) in enumerate(zip(config.features, refs, strict=True))]
    return {
        "params": spark.createDataFrame(sorted(params.items()), "name string, value string"),
        "metrics": spark.createDataFrame(sorted(numbers.items()), "metric string, value double").orderBy("metric"),
        "features": spark.createDataFrame(features, "position int, feature string, reference string"),
    }
