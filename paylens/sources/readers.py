"""Readers. Schemas are declared, so no read needs an inference pass."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.functions.columns import tokens_to_null
from paylens.schemas import CSV_NA_TOKENS, RAW_EMPLOYEE, RAW_SALARY

CORRUPT = "_corrupt_record"


def read_raw_csv(
    spark: SparkSession, path: str, schema: T.StructType = RAW_EMPLOYEE, keep_corrupt: bool = False
) -> DataFrame:
    """CSV with a header, read as text, tolerating malformed lines.

    With ``keep_corrupt`` a line with too many or too few fields is kept whole
    in ``_corrupt_record``, which is null for a good line.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_employees(spark: SparkSession, path: str) -> DataFrame:
    return read_raw_csv(spark, path, RAW_EMPLOYEE)


def read_salaries(spark: SparkSession, path: str) -> DataFrame:
    return read_raw_csv(spark, path, RAW_SALARY)


def read_csv_na_tokens(
    spark: SparkSession, path: str, schema: T.StructType = RAW_EMPLOYEE,
    tokens: Iterable[str] = CSV_NA_TOKENS,
) -> DataFrame:
    """As ``read_raw_csv``, with missing-value tokens turned into null in every column."""
    raw = read_raw_csv(spark, path, schema)
    return raw.select(*[tokens_to_null(c, tokens).alias(c) for c in raw.columns])


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """Parquet; ``merge_schema`` unions the columns of all part files by name."""
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(
        "job_id bigint, y_true double, y_pred double, split string"
    ).csv(path)


def read_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def load_model(path: str) -> PipelineModel:
    """A fitted pipeline saved by ``writers.save_model``."""
    return PipelineModel.load(path)
