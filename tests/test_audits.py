from conftest import rows
from pyspark.sql import functions as F

from paylens.operators import cleaning, profiling, quality


def test_merged_duplicate_counts_equal_those_of_the_join(spark):
    e = spark.createDataFrame([(1, "a")] * 5 + [(1, "b"), (2, "a"), (3, "a"), (3, "a")], "job_id int, x string")
    s = spark.createDataFrame([(1, 7), (1, 7), (1, 8), (2, 1), (4, 1)], "job_id int, salary_k int")
    merged = cleaning.inner_join_job(e, s)
    assert rows(quality.merged_duplicate_counts(e, s)) == rows(quality.duplicate_counts(merged))
    audit = quality.merge_audit(e, s).first()
    assert (audit["employee_rows"], audit["salary_rows"], audit["merged_rows"]) == (9, 5, merged.count())
    cover = quality.key_coverage(e, s).first()
    assert tuple(cover) == (3, 3, 1, 1, False, False)


def test_duplicate_listing_keeps_every_copy(spark):
    df = spark.createDataFrame([(2, "x")] * 40 + [(1, "a"), (1, "b"), (3, "c")], "job_id int, v string")
    listed = [tuple(r) for r in quality.duplicate_listing(df).collect()]
    assert listed == [(1, "a"), (1, "b")] + [(2, "x")] * 40


def test_id_format(spark):
    df = spark.createDataFrame([("JOB1",), ("JOBX1",), ("job1",), (None,)], "jobId string")
    assert tuple(quality.id_format_check(df).first()) == (3, 2, False)
    assert tuple(quality.id_format_check(df.limit(1)).first()) == (1, 0, True)


def test_missing_report_rounds_and_sorts(spark):
    df = spark.createDataFrame([(1, None, None)] + [(1, 2, None)] * 2, "a int, b int, c int")
    assert rows(profiling.missing_report(df), "ordered") == [("c", 3, 100.0), ("b", 1, 33.33)]


def test_value_counts_and_distinct_with_null(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "a string")
    assert rows(profiling.value_counts(df, ["a"]), "ordered") == [("a", "x", 2), ("a", "y", 1), ("a", None, 1)]
    assert profiling.nunique_with_null(df, ["a"]).first()["n_unique"] == 3
    assert profiling.nunique_with_null(df, ["a"], approx=True).first()["n_unique"] == 3


def test_describe_text_breaks_ties_alphabetically(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "t string")
    assert tuple(profiling.describe_text(df).first()) == ("t", 4, 2, "a", 2)


def test_describe_of_one_row_has_no_deviation(spark):
    got = profiling.describe_numeric(spark.createDataFrame([(4,)], "x int")).first()
    assert (got["n_rows"], got["std_value"], got["q50"]) == (1, None, 4.0)


def test_top_and_bottom_break_ties_by_key(spark):
    df = spark.createDataFrame([(3, 9), (1, 9), (2, 5), (4, None)], "job_id int, salary_k int")
    assert [r["job_id"] for r in profiling.top_k_salary(df, 3).collect()] == [1, 3, 2]
    assert [r["job_id"] for r in profiling.bottom_k_salary(df, 2).collect()] == [2, 1]


def test_removed_levels_leave_the_domain(tables):
    before = {r["level"] for r in quality.active_category_domain(tables.unique, ["industry"]).collect()}
    after = {r["level"] for r in quality.active_category_domain(tables.valid, ["industry"]).collect()}
    assert before - after == {"GOVERNMENT"}


def test_percent_rounds_halves_to_even(spark):
    from paylens.functions.columns import percent

    row = spark.range(1).select(percent(F.lit(1), F.lit(800)).alias("a"), percent(F.lit(3), F.lit(800)).alias("b")).first()
    assert (row["a"], row["b"]) == (0.12, 0.38)


def test_merged_listing_equals_the_listing_of_the_join(spark):
    e = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (None, "d"), (4, "e")], "job_id long, x string")
    s = spark.createDataFrame([(1, 10), (2, 20), (2, 20), (3, 30), (None, 5)], "job_id long, y int")
    got = [tuple(r) for r in quality.merged_duplicate_listing(e, s).collect()]
    assert got == [tuple(r) for r in quality.duplicate_listing(e.join(s, "job_id")).collect()] == [
        (1, "a", 10), (1, "a", 10), (2, "b", 20), (2, "b", 20)]
