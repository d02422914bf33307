"""The registered queries: key -> function of (spark, folder), one per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.columns import as_double, hash_bucket
from paylens.models import evaluation, net, net_replay, regressors
from paylens.operators import charts, cleaning, features, profiling, quality, questions, splits
from paylens.plans.tables import Tables, tables
from paylens.schemas import NUMERIC_FEATURES, SCORE_COLUMNS
from paylens.session import scratch_path
from paylens.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(key: str):
    """Register a function of the folder's tables under ``key``."""
    def add(build: Callable[[Tables], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: build(tables(spark, sf_dir))
        return build
    return add


def _rounded(df: DataFrame, places: int = 9, **other: int) -> DataFrame:
    """Double columns rounded for comparison; ``other`` sets places per column."""
    doubles = [n for n, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: as_double(F.col(c), other.get(c, places)) for c in doubles})


# --- sources and sinks ---

def _written(t: Tables, write: Callable[[DataFrame, str], str], df: DataFrame, name: str) -> str:
    return write(df, scratch_path(t.spark, name))


@query("read_raw_csv")
def _(t):
    return readers.read_employees(t.spark, _written(t, writers.write_csv, t.raw_employee, "employee_csv"))


@query("read_raw_csv_salary")
def _(t):
    return readers.read_salaries(t.spark, _written(t, writers.write_csv, t.raw_salary, "salary_csv"))


@query("read_csv_na_tokens")
def _(t):
    return readers.read_csv_na_tokens(t.spark, _written(t, writers.write_csv, t.raw_employee, "employee_csv"))


@query("write_parquet_overwrite")
def _(t):
    path = _written(t, writers.write_parquet, t.unique, "clean_table")
    writers.write_parquet(t.clean, path)
    return readers.read_parquet(t.spark, path)


@query("read_parquet_merge_schema")
def _(t):
    path = scratch_path(t.spark, "parts")
    even = F.col("job_id") % 2 == 0
    writers.write_parquet(t.clean.where(even).drop("major"), f"{path}/older")
    writers.write_parquet(t.clean.where(~even), f"{path}/newer")
    merged = readers.read_parquet(t.spark, f"{path}/older", f"{path}/newer", merge_schema=True)
    return merged.select(*t.clean.columns)


@query("read_write_parquet_features")
def _(t):
    return readers.read_parquet(t.spark, _written(t, writers.write_parquet, t.features, "feature_table"))


@query("write_predictions_csv")
def _(t):
    path = _written(t, writers.write_csv, t.predictions, "predictions_csv")
    return _rounded(readers.read_predictions_csv(t.spark, path), 6)


@query("write_metrics_json")
def _(t):
    metrics = evaluation.regression_metrics(t.predictions)
    path = _written(t, writers.write_json, metrics, "metrics_json")
    return _rounded(readers.read_json(t.spark, path, metrics.schema), 6)


def _line_model(t: Tables):
    """The straight line of ``line_predictions`` as a fitted MLlib pipeline, and its split rows."""
    rows = splits.split_64_16_20(t.features.select("job_id", "salary_k", "years_experience"))
    model = Pipeline(stages=[
        VectorAssembler(inputCols=["years_experience"], outputCol="features"),
        LinearRegression(featuresCol="features", labelCol="salary_k", solver="normal"),
    ]).fit(rows.where(F.col("split") == "train"))
    return model, rows.where(F.col("split") != "train")


@query("save_load_model")
def _(t):
    model, held_out = _line_model(t)
    loaded = readers.load_model(writers.save_model(model, scratch_path(t.spark, "model")))
    return _rounded(regressors.predict(loaded, held_out), 6)


# --- cleaning ---

@query("rename_columns")
def _(t):
    return cleaning.rename_columns(t.raw_employee)


@query("extract_id_digits")
def _(t):
    ids = t.raw_employee.select("jobId", "companyId", F.col("jobId").alias("job_id"), F.col("companyId").alias("company_id"))
    return cleaning.extract_id_digits(ids)


@query("id_format_check")
def _(t):
    return quality.id_format_check(t.raw_employee)


@query("coerce_numeric")
def _(t):
    return cleaning.type_employees(t.raw_employee).select("job_id", "years_experience", "distance_from_cbd")


@query("coerce_numeric_salary")
def _(t):
    return cleaning.type_salaries(t.raw_salary)


@query("na_tokens_to_null")
def _(t):
    return cleaning.type_employees(t.raw_employee).select("job_id", "job_role", "education", "major", "industry")


@query("fill_none_label")
def _(t):
    return cleaning.fill_none_label(cleaning.type_employees(t.raw_employee)).select("job_id", "education", "major")


@query("drop_required_nulls")
def _(t):
    return t.employees


@query("drop_required_nulls_salary")
def _(t):
    return t.salaries


@query("drop_step_report")
def _(t):
    return quality.drop_step_report(t.raw_employee, t.raw_salary)


@query("sentinel_filters")
def _(t):
    return t.valid


@query("active_category_domain")
def _(t):
    return quality.active_category_domain(t.valid)


@query("drop_raw_categoricals")
def _(t):
    return features.drop_raw_categoricals(t.clean)


@query("null_audit")
def _(t):
    return quality.null_audit(t.unfiltered_features)


@query("finite_clean")
def _(t):
    df = t.unfiltered_features
    per_km = F.when(df.distance_from_cbd == 0, float("inf")).otherwise(F.try_divide("salary_k", "distance_from_cbd"))
    dirty = df.select("job_id", per_km.alias("per_km"), F.nanvl("years_experience", F.lit(0.0)).alias("years_experience"),
                      "industry_score")
    return features.finite_clean(dirty, ["per_km", "years_experience", "industry_score"])


# --- joins ---

@query("inner_join_job")
def _(t):
    return t.merged


@query("merge_audit")
def _(t):
    return quality.merge_audit(t.employees, t.salaries)


@query("key_coverage")
def _(t):
    return quality.key_coverage(t.employees, t.salaries)


@query("anti_join_remainder")
def _(t):
    sample = t.clean.where(hash_bucket("job_id") < 2000)
    return cleaning.anti_join_remainder(t.clean, sample)


# --- duplicates and outliers ---

@query("duplicate_counts")
def _(t):
    return quality.duplicate_counts(t.employees)


@query("merged_duplicate_counts")
def _(t):
    return quality.merged_duplicate_counts(t.employees, t.salaries)


@query("duplicate_listing")
def _(t):
    return quality.merged_duplicate_listing(t.employees, t.salaries)


@query("drop_duplicates_full")
def _(t):
    # distinct sides first: the join then meets no repeated rows
    return cleaning.inner_join_job(
        cleaning.drop_duplicates_full(t.employees), cleaning.drop_duplicates_full(t.salaries)
    )


@query("drop_duplicates_key")
def _(t):
    return cleaning.merge_one_per_key(t.employees, t.salaries)


@query("iqr_fence")
def _(t):
    return cleaning.iqr_fence(t.valid)


@query("iqr_outlier_filter")
def _(t):
    return cleaning.iqr_outlier_filter(t.valid)


@query("union_by_name")
def _(t):
    fenced = F.col("job_role") == "JANITOR"
    inside = cleaning.iqr_outlier_filter(t.valid.where(fenced))
    return cleaning.union_by_name(inside, t.valid.where(~fenced).select(*reversed(t.valid.columns)))


@query("clean_merge")
def _(t):
    return cleaning.clean_merge(t.raw_employee, t.raw_salary)


# --- profiling ---

@query("table_shape")
def _(t):
    # the size of the join comes from key counts, without building its rows
    merged = quality.merge_audit(t.employees, t.salaries).select(
        F.lit("merged").alias("table_name"), F.col("merged_rows").alias("n_rows"),
        F.lit(len(t.merged.columns)).alias("n_columns"),
    )
    return quality.table_shape(raw_employee=t.raw_employee, raw_salary=t.raw_salary).unionByName(merged)


@query("preview_rows")
def _(t):
    return profiling.preview_rows(t.clean, 5, ["job_id"])


@query("schema_info")
def _(t):
    return profiling.schema_info(cleaning.type_employees(t.raw_employee))


_DESCRIBE_PLACES = {"mean_value": 6, "std_value": 6}


@query("describe_all")
def _(t):
    return _rounded(profiling.describe_all(t.clean.drop("job_id")), **_DESCRIBE_PLACES)


@query("describe_numeric")
def _(t):
    return _rounded(profiling.describe_numeric(t.valid, ["salary_k"]), **_DESCRIBE_PLACES)


@query("missing_report")
def _(t):
    return profiling.missing_report(t.raw_employee)


@query("value_counts")
def _(t):
    return profiling.value_counts(t.raw_employee, ["companyId", "jobRole", "education", "major", "Industry"])


@query("nunique_with_null")
def _(t):
    return profiling.nunique_with_null(t.raw_employee, t.raw_employee.columns)


@query("predicate_count")
def _(t):
    return profiling.predicate_count(t.valid)


@query("outlier_listing")
def _(t):
    return profiling.outlier_listing(t.unique)


@query("top_k_salary")
def _(t):
    return profiling.top_k_salary(t.unique.where(F.col("salary_k") != 0))


@query("bottom_k_salary")
def _(t):
    return profiling.bottom_k_salary(t.valid)


@query("skewness")
def _(t):
    return _rounded(profiling.skewness(t.clean))


# --- salary questions ---

@query("q_top_role_in_industry")
def _(t):
    return questions.top_role_in_industry(t.clean)


@query("q_roles_in_industry")
def _(t):
    return questions.roles_in_industry(t.clean)


@query("q_top10_industry_role")
def _(t):
    return questions.top_industry_roles(t.clean)


@query("q_industry_profile")
def _(t):
    return questions.industry_profile(t.clean)


@query("q_lowest_paid_role")
def _(t):
    return questions.lowest_paid(t.clean, "job_role")


@query("q_role_profile")
def _(t):
    return questions.role_profile(t.clean)


@query("q_lowest_paid_industry")
def _(t):
    return questions.lowest_paid(t.clean, "industry")


@query("q_role_profile_raw")
def _(t):
    return questions.role_profile(t.valid)


@query("q_below_median_by_industry")
def _(t):
    return questions.below_median(t.clean, "industry")


@query("q_below_median_by_role")
def _(t):
    return questions.below_median(t.clean, "job_role")


@query("q_median_by_experience")
def _(t):
    return questions.median_by_value(t.clean, "years_experience")


@query("q_experience_trend")
def _(t):
    return _rounded(questions.median_trend(t.clean, "years_experience"))


@query("q_experience_pearson")
def _(t):
    return _rounded(questions.pearson(t.clean), t_stat=6)


@query("q_experience_pearson_test")
def _(t):
    return _rounded(questions.pearson_test(t.clean), t_stat=6)


@query("q_pearson_pairs")
def _(t):
    # pairs with hardly any correlation, so that the p-value says something
    tests = [
        questions.pearson_test(t.clean, x, y).select(F.lit(x).alias("col_x"), F.lit(y).alias("col_y"), "*")
        for x, y in (("job_id", "salary_k"), ("company_id", "distance_from_cbd"), ("job_id", "years_experience"))
    ]
    return _rounded(tests[0].unionByName(tests[1]).unionByName(tests[2]), t_stat=6)


@query("q_education_spearman")
def _(t):
    return _rounded(questions.spearman(t.clean))


@query("q_median_by_education")
def _(t):
    return questions.median_by_education(t.clean)


@query("q_major_ranking")
def _(t):
    return questions.ranking(t.clean, "major")


@query("q_median_by_distance")
def _(t):
    return questions.median_by_value(t.clean, "distance_from_cbd")


@query("q_distance_trend")
def _(t):
    return _rounded(questions.median_trend(t.clean, "distance_from_cbd"))


@query("q_company_ranking")
def _(t):
    return questions.ranking(t.clean, "company_id")


@query("correlation_matrix")
def _(t):
    return _rounded(questions.correlation_matrix(t.features))


# --- chart tables ---

@query("chart_category_counts")
def _(t):
    return charts.chart_category_counts(t.valid, ["job_role", "education", "major", "industry"])


@query("chart_whisker_stats")
def _(t):
    return charts.chart_whisker_stats(t.clean)


@query("chart_percentile_marks")
def _(t):
    return _rounded(charts.chart_percentile_marks(t.unique, ["years_experience", "distance_from_cbd"]))


@query("chart_grouped_box_stats")
def _(t):
    boxes = [
        charts.chart_grouped_box_stats(t.clean, by).withColumn("dimension", F.lit(by))
        .withColumn("category", F.col(by).cast("string")).drop(by)
        for by in ("job_role", "major", "company_id")
    ]
    return cleaning.union_by_name(*boxes)


@query("chart_bar_values")
def _(t):
    bars = [
        charts.chart_bar_values(t.clean, by, estimator=e)
        .select(F.lit(e).alias("estimator"), F.col(by).alias("category"), as_double(F.col("bar_value"), 6).alias("bar_value"))
        for by, e in (("industry", "mean"), ("major", "median"))
    ]
    return cleaning.union_by_name(*bars)


@query("melt_metrics")
def _(t):
    return charts.melt_metrics(
        questions.industry_profile(t.clean), "industry",
        ["median_salary", "highest_salary", "lowest_salary", "salary_delta"],
    )


@query("confusion_matrix")
def _(t):
    return charts.confusion_matrix(t.below_labels, labels=(0, 1))


@query("classification_report")
def _(t):
    return _rounded(charts.classification_report(t.below_labels))


def _scores(t: Tables) -> DataFrame:
    return t.below_labels.withColumn("y_true", F.col("y_true") == 1)


@query("roc_pr_curves")
def _(t):
    return _rounded(charts.roc_pr_curves(_scores(t)), threshold=6)


@query("roc_pr_auc")
def _(t):
    return _rounded(charts.roc_pr_auc(_scores(t)))


@query("residuals")
def _(t):
    return _rounded(charts.residuals(t.predictions), 6)


@query("residual_line")
def _(t):
    return _rounded(charts.residual_line(t.predictions), 6)


# --- features ---

@query("encode_ordinals")
def _(t):
    return features.encode_ordinals(t.unique).select("job_id", *SCORE_COLUMNS)


@query("handcrafted_score")
def _(t):
    return features.handcrafted_score(features.encode_ordinals(t.unique)).select("job_id", "handcrafted_score")


@query("interaction_features")
def _(t):
    return features.interaction_features(t.unique).select("job_id", "edu_major", "industry_role")


@query("downcast_scores")
def _(t):
    return features.downcast_scores(t.features).select("job_id", *SCORE_COLUMNS)


@query("build_features")
def _(t):
    return features.build_features(t.clean)


@query("category_codes")
def _(t):
    return features.category_codes(t.features.select("job_id", "edu_major", "industry_role"))


@query("string_index")
def _(t):
    rows = splits.split_64_16_20(t.features).select("job_id", "split", "edu_major", "industry_role")
    indexes = features.fit_string_index(rows.where(F.col("split") == "train"))
    return features.string_index(rows, indexes).drop("split")


@query("clamp_codes")
def _(t):
    codes = features.category_codes(t.features.select("job_id", "edu_major", "industry_role"))
    return features.clamp_codes(codes, {"edu_major": 20, "industry_role": 30})


@query("one_hot")
def _(t):
    return features.one_hot_totals(t.features)


@query("one_hot_vectors")
def _(t):
    # the names of the slots that are set, row by row
    encoded, names = features.one_hot(t.features)
    slots = encoded.select("job_id", F.explode(features.slots_set("one_hot")).alias("slot"))
    return slots.join(names, "slot").select("job_id", "feature_name")


@query("cast_numeric_features")
def _(t):
    return features.cast_numeric_features(t.unfiltered_features)


@query("median_impute")
def _(t):
    return features.median_impute(t.unfiltered_features, NUMERIC_FEATURES).select("job_id", *NUMERIC_FEATURES)


@query("minmax_target")
def _(t):
    rows = splits.split_64_16_20(t.features).select("job_id", "split", "salary_k")
    train = rows.where(F.col("split") == "train")
    fitted = features.target_range(train).select(F.struct("y_min", "y_max")).scalar()
    scaled = features.minmax_target(rows, train).withColumn("_r", fitted)

    def restored(y: Column) -> Column:
        return features.invert_target(y, F.col("_r.y_min"), F.col("_r.y_max"))

    return scaled.select(
        "job_id", "split", as_double(F.col("y_scaled")).alias("y_scaled"),
        as_double(restored(F.col("y_scaled")), 6).alias("y_restored"),
    )


@query("assemble_features")
def _(t):
    return regressors.vector_columns(features.assemble_features(t.features), "features", NUMERIC_FEATURES)


@query("standard_scale")
def _(t):
    return _rounded(features.standard_scale(t.features.select("job_id", *NUMERIC_FEATURES)))


# --- splits ---

@query("split_64_16_20")
def _(t):
    return splits.split_64_16_20(t.features).select("job_id", "split")


@query("split_70_15_15")
def _(t):
    return splits.split_70_15_15(t.features).select("job_id", "split")


@query("split_fallbacks")
def _(t):
    # a share too small for any row: the test split must fall back to one percent
    return splits.split_with_fallback(t.features, test_size=0.00001).select("job_id", "split")


@query("split_sizes")
def _(t):
    return quality.split_sizes(splits.split_64_16_20(t.features))


# --- evaluation ---

@query("regression_metrics")
def _(t):
    return _rounded(evaluation.regression_metrics(t.predictions), 6)


@query("predictions_table")
def _(t):
    return _rounded(regressors.predict(*_line_model(t)), 6)


@query("model_comparison")
def _(t):
    rows = splits.split_64_16_20(t.features)
    return evaluation.model_comparison({
        x: evaluation.line_predictions(rows, x) for x in ("years_experience", "distance_from_cbd")
    })


# --- models: fitted once per folder, several outputs each ---

@cache
def _linear(t: Tables) -> regressors.Fitted:
    return regressors.linear_regression(t.features)


@cache
def _forest(t: Tables) -> regressors.FittedTable:
    return regressors.random_forest(t.features)


@cache
def _linear_onehot(t: Tables) -> regressors.FittedTable:
    return regressors.linear_regression_onehot(t.features)


@cache
def _forest_onehot(t: Tables) -> regressors.FittedTable:
    return regressors.random_forest_onehot(t.features)


@cache
def _net(t: Tables) -> net.NetResult:
    return net.embedding_regressor(t.features)


@cache
def _tuned(t: Tables) -> tuple[net.NetResult, DataFrame]:
    return net.finetune_grid(_net(t))


for _key, _fit in {"random_forest": _forest, "random_forest_onehot": _forest_onehot}.items():
    query(_key)(lambda t, fit=_fit: _rounded(fit(t).predictions, 6))
    query(f"{_key}_metrics")(lambda t, fit=_fit: _rounded(fit(t).metrics(), 6))
    query(f"{_key}_weights")(lambda t, fit=_fit: _rounded(fit(t).weights(), 9))

for _key, _fit, _places in (("linear_regression", _linear, 2), ("linear_regression_onehot", _linear_onehot, 4)):
    # metrics are compared to four places; all levels of a text column depend on each other, so one-hot weights are not unique
    query(_key)(lambda t, fit=_fit, places=_places: _rounded(fit(t).predictions, places))
    query(f"{_key}_metrics")(lambda t, fit=_fit: _rounded(fit(t).metrics(), 4))
    query(f"{_key}_weights")(lambda t, fit=_fit: fit(t).weights())

query("embedding_regressor")(lambda t: _net(t).predictions())
query("embedding_regressor_metrics")(lambda t: _net(t).metrics())
query("embedding_regressor_history")(lambda t: _net(t).history())
query("embedding_regressor_metadata")(lambda t: _net(t).metadata())
query("embedding_regressor_weights")(lambda t: _net(t).weights_table())
query("finetune_grid")(lambda t: _tuned(t)[1])
query("finetune_grid_metrics")(lambda t: _tuned(t)[0].metrics())
query("finetune_grid_predictions")(lambda t: _tuned(t)[0].predictions())


def _checks(key: str, predictions: Callable[[Tables], DataFrame], split: Callable[[DataFrame], DataFrame], bounded: bool):
    """What SQL can know of a model that is fitted iteratively.

    ``_rows``: the rows it predicts, and whether each prediction is finite, or lies in the range of the training
    target as a mean of leaves must. ``_beats_line``: is its R2 above that of the straight line, split by split?
    """
    def predicted(t: Tables) -> DataFrame:
        rows = split(t.features)
        y, y_true = F.col("y_pred"), as_double(F.col("y_true"), 3).alias("y_true")  # the network computes with 32 bits
        ok = ~F.isnan(y) & (F.abs(y) < float("inf"))
        if bounded:
            of_train = rows.where(F.col("split") == "train").agg(F.struct(F.min("salary_k").alias("lo"), F.max("salary_k").alias("hi")))
            ok = y.between(F.col("_r.lo"), F.col("_r.hi"))
            return predictions(t).withColumn("_r", of_train.scalar()).select("job_id", y_true, "split", ok.alias("in_range"))
        return predictions(t).select("job_id", y_true, "split", ok.alias("finite"))

    def beats_line(t: Tables) -> DataFrame:
        line = evaluation.regression_metrics(evaluation.line_predictions(split(t.features))).select("split", F.col("r2").alias("line_r2"))
        return evaluation.regression_metrics(predictions(t)).join(line, "split").select(
            "split", "n", (F.col("r2") > F.col("line_r2")).alias("beats_line"))

    query(f"{key}_rows")(predicted)
    query(f"{key}_beats_line")(beats_line)


def _replayed(key: str, result: Callable[[Tables], net.NetResult]):
    """Does the forward pass in SQL functions, over the stored weights, give each row the prediction that the tasks gave it?"""
    def same(t: Tables) -> DataFrame:
        again = net_replay.replay(result(t)).withColumnRenamed("y_pred", "again")
        return result(t).predictions().join(again, "job_id").select("job_id", (F.abs(F.col("y_pred") - F.col("again")) < 1e-6).alias("replayed"))

    query(f"{key}_replay")(same)


_replayed("embedding_regressor", _net)
_replayed("finetune_grid", lambda t: _tuned(t)[0])

_checks("random_forest", lambda t: _forest(t).predictions, splits.split_70_15_15, True)
_checks("linear_regression_onehot", lambda t: _linear_onehot(t).predictions, splits.split_64_16_20, False)
_checks("random_forest_onehot", lambda t: _forest_onehot(t).predictions, splits.split_64_16_20, True)
_checks("embedding_regressor", lambda t: _net(t).predictions(), splits.split_64_16_20, False)
_checks("finetune_grid", lambda t: _tuned(t)[0].predictions(), splits.split_64_16_20, False)


@query("model_comparison_fitted")
def _(t):
    return evaluation.model_comparison({
        "linear_regression": _linear(t).predictions, "random_forest": _forest(t).predictions,
        "linear_regression_onehot": _linear_onehot(t).predictions,
        "random_forest_onehot": _forest_onehot(t).predictions,
        "embedding_regressor": _net(t).predictions(), "finetuned": _tuned(t)[0].predictions(),
    })


def queries() -> dict[str, Query]:
    return dict(QUERIES)
