import pytest
from conftest import rows
from pyspark.sql import functions as F

from paylens.operators import cleaning
from paylens.schemas import CLEAN, RAW_EMPLOYEE, RAW_SALARY


def emp(spark, *data):
    """Raw employees; a row may stop early, the rest is filled with good values."""
    good = ["JOB1", "COMP1", "CEO", "MASTERS", "MATH", "WEB", "3", "10"]
    return spark.createDataFrame([tuple(list(r) + good[len(r):]) for r in data], RAW_EMPLOYEE)


def sal(spark, *data):
    return spark.createDataFrame(list(data), RAW_SALARY)


def test_first_digits_and_bad_numbers(spark):
    df = emp(spark, ["JOB12"], ["JOBX12"], [""], ["none"], [None], ["JOB99999999999999999999"])
    got = [r["job_id"] for r in cleaning.type_employees(df).collect()]
    assert got == [12, 12, None, None, None, None]


@pytest.mark.parametrize("text, number", [
    ("7", 7.0), ("7.5", 7.5), ("NA", None), ("NaN", None), ("nan", None), ("NAN", None), ("", None), ("x", None), (None, None),
])
def test_numbers(spark, text, number):
    df = emp(spark, ["JOB1", "COMP1", "CEO", "NONE", "MATH", "WEB", text])
    assert cleaning.type_employees(df).first()["years_experience"] == number


@pytest.mark.parametrize("text, number", [("113", 113), ("113.0", 113), ("1e2", 100), ("NA", None), ("", None)])
def test_salary_numbers(spark, text, number):
    assert cleaning.type_salaries(sal(spark, ("JOB1", text))).first()["salary_k"] == number


def test_tokens_become_none_or_drop_the_row(spark):
    df = emp(
        spark,
        ["JOB1", "COMP1", "CEO", "NA", "<NA>"],
        ["JOB2", "COMP1", "CEO", None, "nan"],
        ["JOB3", "COMP1", "NA"],
        ["JOB4", "COMP1", "CEO", "MASTERS", "MATH", "na"],
        ["JOB5", None],
        ["JOB6", "COMP1", "CEO", "MASTERS", "MATH", "WEB", "NaN"],
    )
    got = rows(cleaning.clean_employees(df).select("job_id", "education", "major"))
    assert got == [(1, "NONE", "NONE"), (2, "NONE", "NONE")]


def test_absent_columns_are_tolerated(spark):
    small = emp(spark, ["JOB1"]).select("jobId", "jobRole")
    assert cleaning.clean_employees(small).columns == ["job_id", "job_role"]
    merged = cleaning.clean_merge(small, sal(spark, ("JOB1", "50")))
    assert rows(merged) == [(1, "CEO", 50)]


def test_missing_key_is_a_clear_error(spark):
    with pytest.raises(KeyError, match="job_id"):
        cleaning.inner_join_job(emp(spark, ["JOB1"]), sal(spark, ("JOB1", "5")))


def test_one_row_per_key_is_the_lowest(spark):
    df = spark.createDataFrame(
        [(1, "b", 1), (1, "a", 9), (1, "a", 2), (1, "a", 2), (2, None, 5), (2, "a", 1)], "k int, x string, y int"
    )
    assert rows(cleaning.drop_duplicates_key(df, "k")) == [(1, "a", 2), (2, None, 5)]


def test_merge_without_pairs_equals_merge_then_deduplicate(spark):
    e = cleaning.clean_employees(emp(spark, *[["JOB7", f"COMP{i % 4}"] for i in range(60)], ["JOB8", "COMP2"], ["JOB9"]))
    s = cleaning.clean_salaries(sal(spark, *[("JOB7", str(50 + i % 3)) for i in range(60)], ("JOB8", "70"), ("JOB10", "1")))
    direct = cleaning.drop_duplicates_key(cleaning.inner_join_job(e, s))
    assert rows(cleaning.merge_one_per_key(e, s)) == rows(direct)
    assert direct.count() == 2


def test_duplicates_go_before_the_sentinels(spark):
    # the lowest duplicate is far away, so the whole job disappears
    e = emp(spark, ["JOB1", "COMP1", "CEO", "MASTERS", "MATH", "WEB", "3", "9999"],
            ["JOB1", "COMP2", "CEO", "MASTERS", "MATH", "WEB", "3", "5"])
    assert cleaning.clean_merge(e, sal(spark, ("JOB1", "50"))).count() == 0


def clean_frame(spark, *data):
    return spark.createDataFrame([(i, 1, r, "NONE", "NONE", ind, 1.0, float(d), s) for i, (r, ind, d, s) in enumerate(data)], CLEAN)


def test_sentinels(spark):
    df = clean_frame(
        spark, ("CEO", "WEB", 100, 50), ("CEO", "WEB", 101, 50), ("PRESIDENT", "GOVERNMENT", 1, 50),
        ("CEO", "WEB", 1, 0), ("CEO", "WEB", 1, 10_000_000), (None, "WEB", 1, 50), ("CEO", "WEB", 1, None),
    )
    assert [r["job_id"] for r in cleaning.sentinel_filters(df).collect()] == [0]


def test_fence_keeps_its_edges_and_other_roles(spark):
    # quartiles 40 and 60: limits 10 and 90
    pay = [40, 40, 40, 50, 60, 60, 60, 10, 90, 9, 91]
    df = clean_frame(spark, *[("JANITOR", "WEB", 1, p) for p in pay], ("CEO", "WEB", 1, 5000))
    fence = cleaning.iqr_fence(df).first()
    assert (fence["q1"], fence["q3"], fence["lower_limit"], fence["upper_limit"]) == (40.0, 60.0, 10.0, 90.0)
    kept = sorted(r["salary_k"] for r in cleaning.iqr_outlier_filter(df).collect())
    assert kept == sorted([p for p in pay if 10 <= p <= 90] + [5000])


def test_fence_of_several_groups_and_without_rows(spark):
    df = clean_frame(spark, *[("CEO", "WEB", 1, p) for p in [10, 10, 10, 10, 99]])
    assert cleaning.iqr_outlier_filter(df).count() == 5
    assert cleaning.iqr_outlier_filter(df, ("JANITOR", "CEO")).count() == 4
    assert cleaning.iqr_outlier_filter(df, ("CEO",), approx=True).count() == 4


def test_union_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert rows(cleaning.union_by_name(a, b)) == [(1, "x"), (2, "y")]


def test_clean_schema_and_unique_ids(tables):
    assert tables.clean.dtypes == [(f.name, f.dataType.simpleString()) for f in CLEAN.fields]
    checks = tables.clean.agg(
        F.count("*"), F.countDistinct("job_id"), *[F.count(F.when(F.col(c).isNull(), 1)) for c in CLEAN.names]
    ).first()
    assert checks[0] == checks[1] and set(checks[2:]) == {0}


def test_cleaning_again_changes_nothing(tables):
    again = cleaning.drop_duplicates_key(cleaning.sentinel_filters(tables.clean))
    assert again.exceptAll(tables.clean).count() == 0 and again.count() == tables.clean.count()


def test_a_value_that_is_tested_and_used_is_computed_once_in_each_place(spark, tables):
    """The optimizer puts a raw column's expression into the filter and into the projection; each holds it once."""
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert plan(cleaning.clean_employees(tables.raw_employee)).count("regexp_extract") <= 4  # two ids
    assert plan(cleaning.clean_salaries(tables.raw_salary)).count("FLOOR((") <= 2
    # the role and the industry are each tested for tokens, then passed on
    assert plan(cleaning.type_salaries(tables.raw_salary)).count("FLOOR((") <= 1
