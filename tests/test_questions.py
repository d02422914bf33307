import math
import random
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from paylens.functions.special import log_gamma_ratio, student_p
from paylens.operators import charts, questions


def test_spearman_equals_brute_force_on_continuous_values(spark):
    rng = random.Random(3)
    data = [(float(rng.randrange(40)), rng.gauss(0, 1)) for _ in range(400)]
    data = [(x, y + x / 10) for x, y in data]
    got = questions.spearman(spark.createDataFrame(data, "a double, b double"), "a", "b", order=None).first()

    def ranks(values):
        order = sorted(values)
        return [order.index(v) + (order.count(v) + 1) / 2 for v in values]

    expected = statistics.correlation(ranks([a for a, _ in data]), ranks([b for _, b in data]))
    assert got["n"] == 400 and got["spearman_rho"] == pytest.approx(expected, rel=1e-10)


def test_spearman_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert questions.spearman(df, "a", "b", None).first()["spearman_rho"] is None


@pytest.mark.parametrize("df, t, p", [
    # fixed values of Student's distribution, by closed forms for 1, 2 and 3 degrees of freedom
    (1, 1.0, 0.5), (1, 0.001, 1 - 2 * math.atan(0.001) / math.pi), (2, 3.0, 1 - 3 / math.sqrt(11)), (2, 1e-9, 1 - 1e-9 / math.sqrt(2)),
    (3, 2.0, 1 - 2 / math.pi * (2 / math.sqrt(3) / (1 + 4 / 3) + math.atan(2 / math.sqrt(3)))), (2, 1e6, 1e-12),
])
def test_student_p_has_closed_forms(spark, df, t, p):
    got = spark.range(1).select(F.lit(float(t)).alias("t"), F.lit(float(df)).alias("df")).select(student_p("t", "df")).first()[0]
    assert got == pytest.approx(p, rel=1e-9 if p > 1e-6 else 1e-4)


def test_student_p_of_many_degrees_is_normal(spark):
    rows = [(t, df) for t in (0.01, 1.0, 1.96, 4.0) for df in (1e5, 1e7)]
    out = spark.createDataFrame(rows, "t double, df double").select("t", "df", student_p("t", "df").alias("p")).collect()
    assert all(r["p"] == pytest.approx(math.erfc(r["t"] / math.sqrt(2)), rel=10 * (1 + r["t"]**4) / r["df"] + 1e-7) for r in out)
    ratio = spark.createDataFrame([(a,) for a in (0.5, 1.0, 7.25, 1000.0)], "a double").select("a", log_gamma_ratio(F.col("a")).alias("r")).collect()
    assert all(r["r"] == pytest.approx(math.lgamma(r["a"] + 0.5) - math.lgamma(r["a"]), abs=1e-12) for r in ratio)


def test_pearson_of_a_perfect_line_and_of_two_rows(spark):
    line = questions.pearson_test(spark.createDataFrame([(float(i), 2.0 * i) for i in range(9)], "a double, b double"), "a", "b").first()
    assert (line["p_value"], line["significant"]) == (0.0, True)
    two = questions.pearson_test(spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "a double, b double"), "a", "b").first()
    assert two["p_value"] is None and two["significant"] is None


def test_pearson_test_agrees_with_t(spark):
    rng = random.Random(5)
    data = [(float(x), 0.02 * x + rng.gauss(0, 1)) for x in range(60)]
    got = questions.pearson_test(spark.createDataFrame(data, "a double, b double"), "a", "b").first()
    r, n = got["pearson_r"], got["n"]
    assert got["t_stat"] == pytest.approx(r * math.sqrt((n - 2) / (1 - r * r)))
    # two-sided tail of t with 58 degrees of freedom, integrated numerically
    scale = math.exp(math.lgamma(29.5) - math.lgamma(29)) / math.sqrt(58 * math.pi)
    step = 1e-3
    tail = sum(scale * (1 + (got["t_stat"] + i * step) ** 2 / 58) ** -29.5 * step for i in range(60_000))
    assert got["p_value"] == pytest.approx(2 * tail, rel=1e-2)
    assert got["significant"] == (got["p_value"] < 0.05)


def test_absent_education_level_stays(spark):
    df = spark.createDataFrame([("MASTERS", 5), ("MASTERS", 8), ("NONE", 1)], "education string, salary_k int")
    assert rows(questions.median_by_education(df), "ordered") == [
        (0, "NONE", 1.0), (1, "HIGH_SCHOOL", None), (2, "BACHELORS", None), (3, "MASTERS", 6.5), (4, "DOCTORAL", None),
    ]


def test_below_median_share(spark):
    df = spark.createDataFrame([("a", 113), ("a", 114), ("a", 1), ("b", 200)], "industry string, salary_k int")
    assert rows(questions.below_median(df, "industry"), "ordered") == [("a", 3, 2, 66.67), ("b", 1, 0, 0.0)]


def test_rankings_are_sorted(tables):
    medians = [r["median_salary"] for r in questions.ranking(tables.clean, "company_id").collect()]
    assert medians == sorted(medians, reverse=True)
    years = [r["years_experience"] for r in questions.median_by_value(tables.clean, "years_experience").collect()]
    assert years == sorted(years)


def test_curves_equal_brute_force(spark):
    rng = random.Random(8)
    data = [(rng.random() < 0.4, round(rng.random(), 2)) for _ in range(300)]
    df = spark.createDataFrame(data, "y_true boolean, score double").repartition(5)
    pos = sum(t for t, _ in data)
    for r in charts.roc_pr_curves(df).collect():
        called = [t for t, s in data if s >= r["threshold"]]
        assert (r["tp"], r["fp"]) == (sum(called), len(called) - sum(called))
        assert r["recall"] == pytest.approx(sum(called) / pos)
    # the area under the first curve is the chance that a positive outranks a negative
    wins = [(a > b) + (a == b) / 2 for t, a in data if t for u, b in data if not u]
    assert charts.roc_pr_auc(df).first()["roc_auc"] == pytest.approx(sum(wins) / len(wins))


def test_confusion_matrix_keeps_zeros_and_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2)], "y_true int, y_pred int")
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in charts.confusion_matrix(df, labels=[0, 1, 2]).collect()}
    assert charts.confusion_matrix(df).count() == 3
    assert len(cells) == 9 and cells[0, 0] == 2 and cells[1, 0] == 1 and cells[1, 1] == 0
    report = {r["label"]: r for r in charts.classification_report(df).collect()}
    assert report["0"]["precision"] == pytest.approx(2 / 3) and report["0"]["recall"] == 1.0
    assert report["1"]["f1"] == 0.0 and report["1"]["support"] == 1
    assert report["accuracy"]["f1"] == 0.75 and report["macro avg"]["recall"] == pytest.approx(2 / 3)


def test_box_counts_outliers(spark):
    df = spark.createDataFrame([("a", v) for v in [1, 2, 3, 4, 5, 100]], "g string, salary_k int")
    box = charts.chart_grouped_box_stats(df, "g").first()
    assert (box["lower_whisker"], box["upper_whisker"], box["n_outliers"]) == (1.0, 5.0, 1)


def test_unknown_estimator(spark):
    df = spark.createDataFrame([("a", 1)], "g string, salary_k int")
    with pytest.raises(ValueError, match="estimator"):
        charts.chart_bar_values(df, "g", estimator="mode")


def test_correlation_leaves_out_incomplete_pairs_and_constants(spark):
    data = [(1.0, 2.0, 7.0), (2.0, None, 7.0), (3.0, 5.0, 7.0), (4.0, 1.0, 7.0), (1e9, 2e9, 7.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in questions.correlation_matrix(df).collect()}
    full = [(a, b) for a, b, _ in data if b is not None]
    assert got["a", "b"] == got["b", "a"] == pytest.approx(statistics.correlation(*zip(*full)))
    assert got["a", "a"] == pytest.approx(1.0) and got["a", "c"] is None


def test_nothing_varies(spark):
    df = spark.createDataFrame([(2.0, 5)] * 3, "years_experience double, salary_k int")
    assert tuple(questions.pearson(df).first()) == (3, None, None)
    assert tuple(questions.median_trend(df, "years_experience").first()) == (None, None)
    from paylens.operators import profiling
    assert profiling.skewness(df).first()["skewness"] in (None, 0.0)
