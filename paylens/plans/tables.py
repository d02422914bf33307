"""The pipeline's tables for one input folder, each written once and then scanned."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.models.evaluation import line_predictions
from paylens.operators import cleaning, features, splits
from paylens.schemas import MEDIAN_SALARY_K
from paylens.session import stage_table
from paylens.sources import raw_views


class Tables:
    """Raw tables stay lazy; the merged, clean and feature tables are staged as Parquet.

    Everything after the merge reads a few columns of a staged table, instead
    of repeating the join and the de-duplication per question.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw_employee(self) -> DataFrame:
        return raw_views.raw_employee(self.spark, self.sf_dir)

    @cached_property
    def raw_salary(self) -> DataFrame:
        return raw_views.raw_salary(self.spark, self.sf_dir)

    @cached_property
    def employees(self) -> DataFrame:
        return cleaning.clean_employees(self.raw_employee)

    @cached_property
    def salaries(self) -> DataFrame:
        return cleaning.clean_salaries(self.raw_salary)

    @cached_property
    def merged(self) -> DataFrame:
        """Inner join with its duplicates."""
        return cleaning.inner_join_job(self.employees, self.salaries)

    @cached_property
    def unique(self) -> DataFrame:
        """One row per job, before the outlier rules."""
        return stage_table(cleaning.merge_one_per_key(self.employees, self.salaries), "merged")

    @cached_property
    def valid(self) -> DataFrame:
        """After the sentinel rules, before the fence."""
        return cleaning.sentinel_filters(self.unique)

    @cached_property
    def clean(self) -> DataFrame:
        return stage_table(cleaning.finish_clean(self.unique), "clean")

    @cached_property
    def features(self) -> DataFrame:
        return stage_table(features.build_features(self.clean), "features")

    @cached_property
    def unfiltered_features(self) -> DataFrame:
        """Features of rows the outlier rules would drop: their scores have nulls."""
        return features.build_features(self.unique)

    @cached_property
    def predictions(self) -> DataFrame:
        """Held-out predictions of the line through salary and experience."""
        return stage_table(line_predictions(splits.split_64_16_20(self.features)), "predictions")

    @cached_property
    def below_labels(self) -> DataFrame:
        """Predictions as a yes/no question: is the salary below the median salary?"""
        return self.predictions.select(
            (F.col("y_true") < MEDIAN_SALARY_K).cast("int").alias("y_true"),
            (F.col("y_pred") < MEDIAN_SALARY_K).cast("int").alias("y_pred"),
            (-F.col("y_pred")).alias("score"),
        )


_TABLES: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The tables of one folder, kept for the life of the Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, sf_dir)
    return _TABLES[key]
