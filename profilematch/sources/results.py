"""Model result files: CSV, flat JSON, training metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

META_SCHEMA = (
    "best_model string, best_accuracy double, sklearn_models array<string>, pyspark_models array<string>"
)


def read_results_csv(spark: SparkSession, path: str) -> DataFrame:
    """(model, accuracy) from a file whose first header cell is blank."""
    return spark.read.schema("model string, accuracy double").option("header", True).option("enforceSchema", True).csv(path)


def read_results_json(spark: SparkSession, path: str) -> DataFrame:
    """(model, accuracy) from one ``{name: accuracy}`` object."""
    text = spark.read.text(path, wholetext=True)
    pairs = text.select(F.explode(F.from_json("value", "map<string,double>")).alias("model", "accuracy"))
    return pairs


def read_training_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(META_SCHEMA).option("multiLine", True).json(path)
