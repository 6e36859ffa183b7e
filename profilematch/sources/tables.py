"""Company tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilematch.sources.records import read_csv

CATEGORICAL = (
    "company_type", "company_industry", "company_size", "country", "working_days", "overtime_policy",
)
DISPLAY_TEXT = ("company_overview", "why_youll_love_working_here", "our_key_skills")
FEATURE_TEXT = (
    "company_overview_new", "why_youll_love_working_here_new", "our_key_skills_new", "keyword",
)

COMPANY_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType(), False), T.StructField("company_name", T.StringType(), False)]
    + [T.StructField(c, T.StringType()) for c in (*CATEGORICAL, "location", "href", *DISPLAY_TEXT, *FEATURE_TEXT)]
)


def snake_case(name: str) -> str:
    """``Why you'll love working here`` -> ``why_youll_love_working_here``."""
    return re.sub(r"\W+", "_", name.replace("'", "").replace("’", "").strip()).strip("_").lower()


def read_companies(spark: SparkSession, path: str, format: str = "parquet", check_ids: bool = True) -> DataFrame:
    """Companies in snake_case columns, from Parquet or from CSV with a header and multi-line cells (see ``records``)."""
    if format == "csv":
        raw = read_csv(spark, path)
    elif format == "parquet":
        raw = spark.read.parquet(path)
    else:
        raise ValueError("format must be 'parquet' or 'csv'")
    types = {f.name: f.dataType for f in COMPANY_SCHEMA}
    columns = []
    for name in raw.columns:
        new = snake_case(name)
        quoted = "`" + name.replace("`", "``") + "`"
        columns.append(F.col(quoted).cast(types[new]).alias(new) if new in types else F.col(quoted).alias(new))
    companies = raw.select(*columns)
    if check_ids:
        assert_unique(companies, "id")
    return companies


def assert_unique(df: DataFrame, key: str) -> None:
    """Raise when a key repeats or is null. Counts are combined map-side; one row comes back."""
    bad = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(key).isNull())
    row = bad.limit(1).collect()
    if row:
        raise ValueError(f"{key} is not a key: {row[0][key]!r} occurs {row[0]['n']} times")
