"""Stored artefacts: existence check, pipelines, ranked results."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path names."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def require(spark: SparkSession, path: str) -> str:
    if not exists(spark, path):
        raise FileNotFoundError(f"{path} is missing: fit and save it first")
    return path


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(spark: SparkSession, path: str) -> PipelineModel:
    require(spark, path)
    try:
        return PipelineModel.load(path)
    except Py4JJavaError as error:
        raise ValueError(f"{path} does not hold a pipeline") from error


def write_results(ranked: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Ranked rows with the chosen columns as Parquet."""
    (ranked if columns is None else ranked.select(*columns)).write.mode("overwrite").parquet(path)
