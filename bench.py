"""Times the pipeline and prints one JSON line.

The raw tables are first written as CSV files, the form the pipeline starts
from; that preparation is reported but not counted. Then every step is timed
once, cold: cleaning and features are written as Parquet, questions and chart
tables are collected, models are fitted and scored.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from paylens.models import evaluation, net, regressors
from paylens.operators import charts, cleaning, features, profiling, quality, questions, splits
from paylens.sources import raw_views, readers, writers


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"{work}/shared")
        # small files: let the scan use all cores
        .config("spark.sql.files.maxPartitionBytes", "2m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    n = int(cpus)
    writers.write_csv(raw_views.raw_employee(spark, sf_dir).repartition(n), f"{work}/employee.csv")
    writers.write_csv(raw_views.raw_salary(spark, sf_dir).repartition(n), f"{work}/salary.csv")
    setup = time.perf_counter() - start

    times: dict[str, float] = {}

    def timed(name, run):
        begin = time.perf_counter()
        result = run()
        times[name] = round(time.perf_counter() - begin, 3)
        return result

    employee = readers.read_employees(spark, f"{work}/employee.csv")
    salary = readers.read_salaries(spark, f"{work}/salary.csv")
    e, s = cleaning.clean_employees(employee), cleaning.clean_salaries(salary)
    timed("clean_merge", lambda: writers.write_parquet(cleaning.clean_merge(employee, salary), f"{work}/clean"))
    clean = readers.read_parquet(spark, f"{work}/clean")
    timed("build_features", lambda: writers.write_parquet(features.build_features(clean), f"{work}/features"))
    rows = readers.read_parquet(spark, f"{work}/features")

    collected = {
        "q_top_role_in_industry": lambda: questions.top_role_in_industry(clean),
        "q_top10_industry_role": lambda: questions.top_industry_roles(clean),
        "q_industry_profile": lambda: questions.industry_profile(clean),
        "q_lowest_paid_role": lambda: questions.lowest_paid(clean, "job_role"),
        "q_lowest_paid_industry": lambda: questions.lowest_paid(clean, "industry"),
        "q_below_median_by_industry": lambda: questions.below_median(clean, "industry"),
        "q_below_median_by_role": lambda: questions.below_median(clean, "job_role"),
        "q_median_by_experience": lambda: questions.median_by_value(clean, "years_experience"),
        "q_experience_trend": lambda: questions.median_trend(clean, "years_experience"),
        "q_experience_pearson": lambda: questions.pearson(clean),
        "q_education_spearman": lambda: questions.spearman(clean),
        "q_median_by_education": lambda: questions.median_by_education(clean),
        "q_major_ranking": lambda: questions.ranking(clean, "major"),
        "q_median_by_distance": lambda: questions.median_by_value(clean, "distance_from_cbd"),
        "q_distance_trend": lambda: questions.median_trend(clean, "distance_from_cbd"),
        "q_company_ranking": lambda: questions.ranking(clean, "company_id"),
        "correlation_matrix": lambda: questions.correlation_matrix(rows),
        "describe_all": lambda: profiling.describe_all(clean.drop("job_id")),
        "missing_report": lambda: profiling.missing_report(employee),
        "value_counts": lambda: profiling.value_counts(employee, ["jobRole", "education", "major", "Industry"]),
        "top_k_salary": lambda: profiling.top_k_salary(clean),
        "skewness": lambda: profiling.skewness(clean),
        "drop_step_report": lambda: quality.drop_step_report(employee, salary),
        "merge_audit": lambda: quality.merge_audit(e, s),
        "key_coverage": lambda: quality.key_coverage(e, s),
        "merged_duplicate_counts": lambda: quality.merged_duplicate_counts(e, s),
        "null_audit": lambda: quality.null_audit(rows),
        "chart_whisker_stats": lambda: charts.chart_whisker_stats(clean),
        "chart_percentile_marks": lambda: charts.chart_percentile_marks(clean, ["years_experience", "distance_from_cbd"]),
        "chart_grouped_box_stats": lambda: charts.chart_grouped_box_stats(clean, "job_role"),
        "split_sizes": lambda: quality.split_sizes(splits.split_64_16_20(rows)),
    }
    for name, build in collected.items():
        timed(name, lambda: build().collect())

    line = writers.write_parquet(evaluation.line_predictions(splits.split_64_16_20(rows)), f"{work}/line")
    predictions = readers.read_parquet(spark, line)
    timed("regression_metrics", lambda: evaluation.regression_metrics(predictions).collect())
    timed("linear_regression", lambda: regressors.linear_regression(rows).metrics().collect())
    timed("random_forest", lambda: regressors.random_forest(rows).metrics().collect())
    timed("random_forest_onehot", lambda: regressors.random_forest_onehot(rows).metrics().collect())
    timed("linear_regression_onehot", lambda: regressors.linear_regression_onehot(rows).metrics().collect())

    def train():
        result = net.embedding_regressor(rows)
        result.metrics().collect()
        return result

    base = timed("embedding_regressor", train)
    timed("finetune_grid", lambda: net.finetune_grid(base)[0].metrics().collect())

    print(json.dumps({
        "metric": "total_runtime", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")), "setup_sec": round(setup, 3), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
