"""What the plans must look like: scans, shuffles and jobs per operator."""

import re

import pytest
from pyspark.sql import functions as F

from paylens.operators import cleaning, features, quality, questions, splits


def jobs(spark, run):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    run()
    return len(set(tracker.getJobIdsForGroup(None)) - before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_transforms_start_no_job(spark, tables):
    t = tables
    t.clean, t.features  # staged before
    assert jobs(spark, lambda: (
        cleaning.clean_merge(t.raw_employee, t.raw_salary), features.build_features(t.clean),
        questions.industry_profile(t.clean), questions.spearman(t.clean), splits.split_64_16_20(t.features),
        features.standard_scale(t.features), features.median_impute(t.features, ["years_experience"]),
        questions.correlation_matrix(t.features), questions.pearson_test(t.clean),
    )) == 0


@pytest.mark.parametrize("ask", [questions.industry_profile, questions.role_profile])
def test_a_question_reads_two_columns_once(tables, ask):
    df = ask(tables.clean)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan(df)))
    assert len(schemas) == 1 and len(schemas.pop().split(",")) == 2
    # the counted values are shuffled once; the other branches reuse that shuffle
    assert "ReusedExchange" in plan(df)
    assert len(re.findall(r"FileScan parquet", final)) <= 1


def test_filter_reaches_the_scan(tables):
    df = questions.top_role_in_industry(tables.clean)
    assert "EqualTo(industry,WEB)" in plan(df)


def test_features_and_splits_need_no_shuffle(tables):
    df = splits.split_64_16_20(features.build_features(tables.clean))
    assert "Exchange" not in plan(df) and "Python" not in plan(df)


def test_merge_shuffles_each_side_once(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        e, s = tables.unique.drop("salary_k"), tables.unique.select("job_id", "salary_k")
        text = plan(cleaning.merge_one_per_key(e, s))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning\(job_id", text)) == 2
    assert text.count("Exchange") == 2 and "SortMergeJoin" in text


def test_top_k_needs_no_full_sort(tables):
    from paylens.operators.profiling import top_k_salary
    assert "TakeOrderedAndProject" in plan(top_k_salary(tables.clean))


def test_correlation_matrix_is_one_aggregate(tables):
    assert plan(questions.correlation_matrix(tables.features)).count("Exchange") == 1


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of all rows share a key: each map task sends one row for it."""
    df = spark.range(0, 30_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("job_id"), (F.col("id") % 7).alias("a"),
        F.col("id").cast("string").alias("b"),
    )
    reduced = cleaning.drop_duplicates_key(df)
    text = plan(reduced)
    assert "partial_min" in text
    assert reduced.count() == 20_001


def test_hot_key_on_both_sides_never_forms_its_pairs(spark):
    """A third of both tables share one job: joining the pairs would give 10^10 rows."""
    n = 300_000
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("job_id")
    e = spark.range(n).select(key, (F.col("id") % 1000).alias("company_id"))
    s = spark.range(n).select(key, (F.col("id") % 500 + 3).alias("salary_k"))
    merged = cleaning.merge_one_per_key(e, s)
    assert merged.count() == 200_001
    assert tuple(merged.where("job_id = 0").first()) == (0, 0, 3)
    audit = quality.merge_audit(e, s).first()
    assert audit["merged_rows"] == (n // 3) ** 2 + 200_000
    assert quality.merged_duplicate_counts(e, s).first()["key_duplicates"] == (n // 3) ** 2 - 1
