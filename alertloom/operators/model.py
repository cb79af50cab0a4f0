"""Attack classifier: training, persistence, scoring, true-positive gate."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from alertloom.constants import FEATURES, MODEL_TAG
from alertloom.operators.features import features, training_set
from alertloom.sources import files


def train(rows: DataFrame, label: str = "label", inputs: list[str] | None = None,
          trees: int = 100, depth: int = 6, seed: int = 42) -> PipelineModel:
    """Random forest over numeric columns; classes are numbered in alphabetical order."""
    inputs = inputs or [f"f_{n}" for n in FEATURES]
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=inputs, outputCol="_features"),
        RandomForestClassifier(
            labelCol="_label", featuresCol="_features", probabilityCol="_probability",
            rawPredictionCol="_raw", predictionCol="_prediction",
            numTrees=trees, maxDepth=depth, seed=seed),
    ]).fit(rows)


def classes(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def load_or_train(spark: SparkSession, path: str, rows: DataFrame | None = None) -> PipelineModel:
    """The model saved at ``path``; trained on ``rows`` (the synthetic set) and saved if there is none.

    A model that is there and can't be read is an error, and stays as it is.
    """
    if files.exists(spark, path):
        return PipelineModel.load(path)
    model = train(rows if rows is not None else training_set(spark))
    model.write().save(path)
    return model


def is_true_positive(confidence: Column, attack_class: Column) -> Column:
    return (confidence >= 0.6) & (attack_class != "normal_activity")


def inference(attack_class: Column, confidence: Column, probabilities: Column, tag: str, at: Column) -> Column:
    """The ``ai_inference`` record. The gate sees the confidence before it is rounded."""
    return F.struct(
        attack_class.alias("attack_class"),
        F.round(confidence, 4).alias("confidence"),
        is_true_positive(confidence, attack_class).alias("is_true_positive"),
        F.transform_values(probabilities, lambda _, p: F.round(p, 4)).alias("all_probabilities"),
        F.lit(tag).alias("model"),
        at.alias("inference_timestamp"),
    )


def best_class(names: Column, p: Column) -> list[Column]:
    """``attack_class``, ``confidence`` and ``probabilities`` of an array of probabilities in the order of ``names``. The first class
    wins a tie."""
    best = F.array_position(p, F.array_max(p)).cast("int")
    return [F.element_at(names, best).alias("attack_class"), F.array_max(p).alias("confidence"), F.map_from_arrays(names, p).alias("probabilities")]


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``attack_class``, ``confidence`` and ``probabilities`` per row; map-only, so it works on
    streams."""
    names = F.array(*[F.lit(c) for c in classes(model)])
    kept = rows.columns
    # The fitted label indexer is only needed for its class names.
    scored = PipelineModel(stages=model.stages[1:]).transform(rows)
    return scored.select(*[F.col(f"`{c}`") for c in kept], vector_to_array("_probability").alias("_p")).select(
        *[F.col(f"`{c}`") for c in kept], *best_class(names, F.col("_p")))


def score(model: PipelineModel, incidents: DataFrame, at: Column | None = None) -> DataFrame:
    """Incidents with their ``ai_inference`` record."""
    kept = [F.col(f"`{c}`") for c in incidents.columns]
    record = inference(F.col("attack_class"), F.col("confidence"), F.col("probabilities"), MODEL_TAG,
                       at if at is not None else F.current_timestamp())
    return predict(model, features(incidents)).select(*kept, record.alias("ai_inference"))
