import pytest
from conftest import rows
from pyspark.sql import functions as F

from paylens.operators import features, splits


def test_unknown_label_gives_null_score(spark):
    df = spark.createDataFrame([("NONE", "MATH", "GOVERNMENT", "CEO")], "education string, major string, industry string, job_role string")
    got = features.handcrafted_score(features.encode_ordinals(df)).first()
    assert (got["education_level"], got["major_score"], got["industry_score"], got["handcrafted_score"]) == (0, 6, None, None)


def test_missing_source_column_is_named(spark):
    with pytest.raises(KeyError, match="major"):
        features.interaction_features(spark.createDataFrame([("a",)], "education string"))


def test_finite_clean(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.5,), (inf,), (-inf,), (float("nan"),), (None,)], "x double")
    assert [r["x"] for r in features.finite_clean(df, ["x", "absent"]).collect()] == [1.5, 0.0, 0.0, 0.0, 0.0]


def test_codes_by_frequency(spark):
    train = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), ("c",), (None,)], "t string")
    index = features.LabelIndex(train, "t", by_frequency=True)
    data = spark.createDataFrame([("a",), ("b",), ("c",), ("new",), (None,)], "t string")
    got = {r["t"]: r["t_code"] for r in index.transform(data, unseen=index.size).collect()}
    assert got == {"b": 0, "c": 1, "a": 2, "new": 3, None: 3}
    assert features.cardinalities({"t": index}) == {"t": 4}


def test_alphabetical_codes(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "id int, t string")
    assert rows(features.category_codes(df, ["t"])) == [(1, 1), (2, 0), (3, -1), (4, 1)]


def test_empty_train_gives_no_labels(spark):
    index = features.LabelIndex(spark.createDataFrame([], "t string"), "t")
    got = index.transform(spark.createDataFrame([("x",)], "t string"), unseen=index.size)
    assert index.size == 0 and got.first()["t_code"] == 0


def test_one_hot_rows_sum_to_one_per_column(tables):
    encoded, names = features.one_hot(tables.features)
    from pyspark.ml.functions import vector_to_array
    sums = encoded.select(F.aggregate(vector_to_array("one_hot"), F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert {r["s"] for r in sums.distinct().collect()} == {2.0}
    named = [r["feature_name"] for r in names.orderBy("slot").collect()]
    levels = {f"{c}_{r[0]}" for c in ("edu_major", "industry_role") for r in tables.features.select(c).distinct().collect()}
    assert [r["slot"] for r in names.orderBy("slot").collect()] == list(range(len(levels))) and set(named) == levels
    both = [sorted(n for n in named if n.startswith(c)) for c in ("edu_major", "industry_role")]
    assert named == both[0] + both[1]


def test_unseen_and_null_levels_are_all_zeros(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "t string")
    fitted = features.OneHot(train, ["t"])
    got = fitted.transform(spark.createDataFrame([(1, "zzz"), (2, None), (3, "b")], "id int, t string"))
    assert {r["id"]: r["one_hot"].toArray().tolist() for r in got.collect()} == {1: [0, 0], 2: [0, 0], 3: [0, 1]}
    assert {r["id"]: r["s"] for r in got.select("id", features.slots_set("one_hot").alias("s")).collect()} == {1: [], 2: [], 3: [1]}
    assert got.columns == ["id", "t", "one_hot"]


def test_one_hot_vectors_stay_sparse_and_labels_distributed(spark):
    df = spark.range(3000).select("id", F.concat(F.lit("l"), F.col("id") % 1500).alias("t"), F.lit("x").alias("u"))
    encoded, names = features.one_hot(df, ["t", "u"])
    assert encoded.where(F.unwrap_udt("one_hot")["type"] != 0).count() == 0 and names.count() == 1501
    totals = {r["feature_name"]: r["n"] for r in features.one_hot_totals(df, ["t", "u"]).collect()}
    assert totals["u_x"] == 3000 and totals["t_l7"] == 2 and len(totals) == 1501
    assert features.one_hot_totals(df.where("false"), ["t"]).collect() == []


def test_median_impute_all_null_is_zero(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None), (9.0, None)], "a double, b double")
    assert rows(features.median_impute(df, ["a", "b"]).where("a = 3 or a = 9")) == [(3.0, 0.0), (3.0, 0.0), (9.0, 0.0)]


def test_minmax_inverts_and_guards_a_zero_range(spark):
    df = spark.createDataFrame([(10,), (20,), (40,)], "salary_k int")
    scaled = features.minmax_target(df)
    assert [r["y_scaled"] for r in scaled.collect()] == [0.0, pytest.approx(1 / 3), 1.0]
    back = scaled.select(features.invert_target(F.col("y_scaled"), F.lit(10.0), F.lit(40.0)).alias("y"))
    assert [r["y"] for r in back.collect()] == [10.0, 20.0, 40.0]
    flat = features.minmax_target(df.where("salary_k = 10"))
    assert flat.first()["y_scaled"] == 0.0


def test_standard_scale_of_a_constant(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "a double, b double")
    got = features.standard_scale(df, ["a", "b"]).collect()
    assert [r["a"] for r in got] == [0.0, 0.0] and got[0]["b"] == pytest.approx(-(0.5 ** 0.5))


def test_assemble_needs_complete_rows(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception, match="null"):
        features.assemble_features(df, ["a", "b"]).collect()


def ids(spark, n=2000):
    return spark.range(n).withColumnRenamed("id", "job_id")


def test_splits_are_complete_and_independent_of_layout(spark):
    one = splits.split_64_16_20(ids(spark).repartition(1))
    many = splits.split_64_16_20(ids(spark).repartition(13))
    assert rows(one) == rows(many)
    sizes = {r["split"]: r["count"] for r in one.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 2000
    assert 0.55 < sizes["train"] / 2000 < 0.73 and 0.1 < sizes["valid"] / 2000 < 0.22
    assert rows(splits.split_64_16_20(ids(spark), seed=1)) != rows(one)


def test_three_way_split_sizes(spark):
    sizes = {r["split"]: r["count"] for r in splits.split_70_15_15(ids(spark)).groupBy("split").count().collect()}
    assert set(sizes) == {"train", "val", "test"} and 0.65 < sizes["train"] / 2000 < 0.75


@pytest.mark.parametrize("test_size, valid_size", [(0.0, 0.2), (0.2, 0.0), (0.2, 1.0), (0.00001, 0.00001)])
def test_empty_splits_are_filled(spark, test_size, valid_size):
    got = splits.split_with_fallback(ids(spark), test_size, valid_size)
    assert {r["split"] for r in got.select("split").distinct().collect()} == {"train", "valid", "test"}


def test_too_few_rows_for_three_splits(spark):
    with pytest.raises(ValueError, match="empty split"):
        splits.split_with_fallback(ids(spark, 1))
