"""Training and scoring runs over a feature store."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import online, training
from tidemark.operators.training import TrainingConfig
from tidemark.plans import batch_features as bf
from tidemark.session import materialise
from tidemark.sources import readers, sinks


def train(
    spark: SparkSession, layout: bf.Layout, config: TrainingConfig = TrainingConfig(), entity_path: str | None = None
) -> tuple[PipelineModel, dict]:
    """Entity rows, point-in-time features, fit, evaluation on the test part, published run tables."""
    if entity_path is None:
        bf.write_entity_rows(spark, layout)
        entity_path = layout.export("entity_rows")
    spine = readers.entity_rows(spark, entity_path)
    frame = training.training_frame(spine, bf.register_views(spark, layout)[:2])
    frame = materialise(training.split(frame, config), "training")
    model, metrics = training.fit(frame, config)
    test = training.evaluate(
        training.apply_model(model, frame.filter("split = 'test'")), config.threshold, config.label
    )
    metrics |= {f"test_{r['metric']}": r["value"] for r in test.collect()}
    for name, table in training.run_tables(spark, metrics, config).items():
        sinks.write_table(table, layout.table(f"run_{name}"))
    model.write().overwrite().save(layout.table("model"))
    return model, metrics


def batch_then_train(spark, raw: DataFrame, layout: bf.Layout, until: int, config=TrainingConfig(), **options):
    bf.run(spark, raw, layout, until, **options)
    return train(spark, layout, config)


def score_requests(
    spark: SparkSession, requests: DataFrame, layout: bf.Layout, threshold: float = 0.5, version: str = "1",
    model: PipelineModel | None = None, now=None,
) -> tuple[DataFrame, DataFrame]:
    """Look up the latest features of each request, score, and return (predictions, rejects)."""
    model = PipelineModel.load(layout.table("model")) if model is None else model
    views = bf.register_views(spark, layout)
    snapshots = [(v, bf.online_table(spark, v, layout)) for v in views]
    looked = online.risk_context(online.online_lookup(online.request_rows(requests, now), snapshots, now))
    return training.score(looked, model, threshold, version)


def publish_predictions(predictions: DataFrame, layout: bf.Layout) -> int:
    return sinks.write_predictions(predictions, layout.table("predictions"))


def model_info(layout: bf.Layout, spark: SparkSession, threshold: float = 0.5) -> DataFrame:
    """What a model needs: its features with their references, and the threshold."""
    features = spark.read.parquet(layout.table("run_features"))
    return features.withColumn("anomaly_threshold", F.lit(threshold))
