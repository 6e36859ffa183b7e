"""Feature columns for the classifiers: one-hot fields, capped TF-IDF vectors, PCA."""

from __future__ import annotations

import numpy as np
from py4j.protocol import Py4JJavaError
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Transformer
from pyspark.ml.feature import (
    PCA,
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilematch.session import fits, materialize

# Fixed values.
MAX_TERMS = 500
PCA_COMPONENTS = 50
SEED = 42

PCA_SCALES = (1.0, 7.3, 0.37, 53.0, 0.019)

MAX_ENCODED_COLUMNS = 10_000
#: The covariance goes to the driver: half of 8,192 x 8,192 doubles is 268 MB.
MAX_PCA_WIDTH = 8_192


def field_values(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value): one row per non-null value, unpivoted in the row."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    return df.select(F.explode(pairs).alias("x")).select("x.*").where("value is not null")


def encoded_columns(df: DataFrame, fields: list[str]) -> DataFrame:
    """The fitted one-hot columns (field, value)."""
    return field_values(df, fields).distinct()


def one_hot_long(df: DataFrame, id_col: str, fields: list[str], encoded: DataFrame) -> DataFrame:
    """(id, feature): the one-hot columns that are 1. Null and unknown values have none."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    long = df.select(id_col, F.explode(pairs).alias("x")).select(id_col, "x.*")
    known = F.broadcast(encoded) if fits(encoded, MAX_ENCODED_COLUMNS) else encoded
    return long.join(known, ["field", "value"]).select(id_col, F.concat_ws("_", "field", "value").alias("feature"))


def one_hot_wide(df: DataFrame, id_col: str, fields: list[str], encoded: DataFrame) -> DataFrame:
    """The aligned wide form: every fitted column, 0 where it does not apply; no other column.

    A field that ``df`` lacks gives zeros. The column list is bounded, as a table schema must be.
    """
    if not fits(encoded, MAX_ENCODED_COLUMNS):
        raise ValueError(f"more than {MAX_ENCODED_COLUMNS} one-hot columns: use one_hot_long")
    columns = []
    for row in encoded.orderBy("field", "value").collect():
        name = f"{row['field']}_{row['value']}"
        if row["field"] in df.columns:
            hit = F.coalesce((F.col(row["field"]).cast("string") == row["value"]).cast("int"), F.lit(0))
        else:
            hit = F.lit(0)
        columns.append(hit.alias(name))
    return df.select(id_col, *columns)


def fit_features(
    data: DataFrame, fields: list[str], vocab: DataFrame, components: int = PCA_COMPONENTS
) -> PipelineModel:
    """Fitted stages from the fields and ``tokens`` to centred PCA ``features``.

    ``vocab``: (term, idf), capped, so it is small. Null and unseen field values encode to zeros.
    """
    if not fits(vocab, MAX_ENCODED_COLUMNS):
        raise ValueError(f"more than {MAX_ENCODED_COLUMNS} terms: cap the vocabulary")
    if not fits(encoded_columns(data, fields), MAX_ENCODED_COLUMNS):
        raise ValueError(f"more than {MAX_ENCODED_COLUMNS} values in {fields}: group rare ones")
    terms = vocab.orderBy("term").collect()
    idf = Vectors.dense([r["idf"] for r in terms])
    indexed = [f"_{f}_index" for f in fields]
    encoded = [f"_{f}_hot" for f in fields]
    prepared = Pipeline(
        stages=[
            StringIndexer(inputCols=fields, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
            CountVectorizerModel.from_vocabulary([r["term"] for r in terms], inputCol="tokens", outputCol="_tf"),
            ElementwiseProduct(scalingVec=idf, inputCol="_tf", outputCol="_tfidf"),
            Normalizer(p=2.0, inputCol="_tfidf", outputCol="_text"),
            VectorAssembler(inputCols=[*encoded, "_text"], outputCol="_all"),
        ]
    ).fit(data)
    assembled = materialize(prepared.transform(data).select("_all"), "assembled")
    return PipelineModel(stages=[*prepared.stages, *fit_centred_pca(assembled, "_all", components)])


def _signs(loadings: np.ndarray) -> np.ndarray:
    """1 or -1 for each component, so that its largest loading becomes positive."""
    largest = np.abs(loadings).round(9).argmax(axis=0)
    return np.where(loadings[largest, np.arange(loadings.shape[1])] < 0, -1.0, 1.0)


def fit_centred_pca(
    data: DataFrame, input_col: str, components: int = PCA_COMPONENTS, output_col: str = "features"
) -> list[Transformer]:
    """Fitted stages for PCA on centred input; MLlib's projection itself does not centre.

    The largest loading of each component is positive (of equal ones the first), so signs are fixed. The width of the
    input is checked first, as the covariance goes to the driver.
    Its decomposition may fail to converge on a covariance of low rank. The components do not depend on
    the scale of the input, so another scale is tried then, and taken out of the result again.
    """
    width = data.where(F.col(input_col).isNotNull()).select(input_col).first()
    if width and width[0].size > MAX_PCA_WIDTH:
        raise ValueError(f"{width[0].size} columns: PCA takes {MAX_PCA_WIDTH} at most")
    scaler = StandardScaler(withMean=True, withStd=False, inputCol=input_col, outputCol="_centred").fit(data)
    centred = scaler.transform(data)
    size, k = scaler.mean.size, min(components, scaler.mean.size)
    for scale in PCA_SCALES:
        scaled = ElementwiseProduct(scalingVec=Vectors.dense([scale] * size), inputCol="_centred", outputCol="_scaled")
        pca = PCA(k=k, inputCol="_scaled", outputCol="_scores")
        try:
            fitted = pca.fit(scaled.transform(centred))
            signs = Vectors.dense(_signs(fitted.pc.toArray()) / scale)
            return [scaler, scaled, fitted, ElementwiseProduct(scalingVec=signs, inputCol="_scores", outputCol=output_col)]
        except Py4JJavaError as error:
            if "NotConvergedException" not in str(error):
                raise
    raise ArithmeticError(f"PCA of {input_col} did not converge at any scale of {PCA_SCALES}")
