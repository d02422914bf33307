from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from paylens.models import evaluation, net, net_math, net_replay, onehot_line, regressors
from paylens.schemas import FineTuneParams, NetParams, NUMERIC_FEATURES


@pytest.fixture(scope="module")
def base(tables):
    return net.embedding_regressor(tables.features, NetParams(epochs=25, batch_size=32))


def test_metrics_equal_mllib(tables):
    got = {r["split"]: r for r in evaluation.regression_metrics(tables.predictions).collect()}
    for split, r in got.items():
        part = tables.predictions.where(F.col("split") == split)
        for name in ("r2", "mae", "rmse"):
            mllib = RegressionEvaluator(labelCol="y_true", predictionCol="y_pred", metricName=name).evaluate(part)
            assert r[name] == pytest.approx(mllib, rel=1e-9)


def test_constant_truth_has_no_r2(spark):
    df = spark.createDataFrame([("t", 5.0, 4.0), ("t", 5.0, 6.0)], "split string, y_true double, y_pred double")
    r = evaluation.regression_metrics(df).first()
    assert (r["r2"], r["mae"], r["rmse"]) == (None, 1.0, 1.0)


def _arrays(df, columns):
    pdf = df.toPandas()
    return np.c_[np.ones(len(pdf)), pdf[list(columns)].to_numpy(float)], pdf


def test_linear_regression_equals_least_squares(tables):
    from paylens.operators.splits import split_70_15_15
    fitted = regressors.linear_regression(tables.features)
    x, pdf = _arrays(split_70_15_15(tables.features), NUMERIC_FEATURES)
    train = (pdf["split"] == "train").to_numpy()
    weights = np.linalg.lstsq(x[train], pdf.loc[train, "salary_k"].to_numpy(float), rcond=None)[0]
    expected = dict(zip(pdf["job_id"], x @ weights))
    got = fitted.predictions.collect()
    assert {r["split"] for r in got} == {"val", "test"} and len(got) == int((~train).sum())
    assert max(abs(r["y_pred"] - expected[r["job_id"]]) for r in got) < 1e-3
    names = [r["feature"] for r in fitted.weights().collect()]
    assert set(names) == {*NUMERIC_FEATURES, "intercept"}
    assert fitted.weights(2).count() == 2


def test_preparing_on_all_rows_changes_no_prediction_much(tables):
    a = regressors.linear_regression(tables.features).metrics().orderBy("split").collect()
    b = regressors.linear_regression(tables.features, fit_on="all").metrics().orderBy("split").collect()
    assert a[0]["rmse"] == pytest.approx(b[0]["rmse"], rel=1e-6)
    with pytest.raises(ValueError, match="fit_on"):
        regressors.linear_regression(tables.features, fit_on="test")


def test_one_hot_regression_names_its_columns(spark, tables, tmp_path):
    fitted = regressors.linear_regression_onehot(tables.features, fit_on="all")
    names = {r["feature"] for r in fitted.weights().collect()}
    levels = {f"{c}_{r[0]}" for c in ("edu_major", "industry_role") for r in tables.features.select(c).distinct().collect()}
    assert names == {*NUMERIC_FEATURES, *levels, "intercept"} and fitted.weights().count() == len(names)
    assert {r["split"] for r in fitted.predictions.select("split").distinct().collect()} == {"valid", "test"}
    assert all(r["r2"] > 0.5 for r in fitted.metrics().collect())
    stored = onehot_line.OneHotLine.load(spark, fitted.model.save(str(tmp_path / "line")))
    got = stored.predict(tables.features, ["job_id"]).join(fitted.predictions.withColumnRenamed("y_pred", "p"), "job_id")
    assert got.where(F.abs(F.col("p") - F.col("y_pred")) > 1e-9).count() == 0 < got.count()


def test_one_hot_regression_of_dependent_and_unseen_columns(spark):
    """Least norm of the columns at unit length; a constant column and an unseen level count as nothing."""
    rng = np.random.default_rng(3)
    a, c = rng.integers(0, 9, 80), rng.integers(0, 4, 80)
    y = 3 * a + np.array([5, -2, 0, 9])[c] + rng.normal(size=80)
    rows = [(float(i), float(2 * i + 1), 7.0, "wxyz"[j], "only", float(v)) for i, j, v in zip(a, c, y)]
    df = spark.createDataFrame(rows, "a double, b double, k double, t string, u string, y double")
    line = onehot_line.fit(df, ["a", "b", "k"], ["t", "u"], "y")
    x = np.column_stack([a - a.mean(), 2 * (a - a.mean()), *(c == j for j in range(4)), np.ones(80)]).astype(float)
    length = np.sqrt((x * x).sum(axis=0))
    w = np.linalg.lstsq(x / length, y - y.mean(), rcond=None)[0] / length
    got = {r["feature"]: r["weight"] for r in line.weights().collect()}
    assert [got.get(n, 0.0) for n in ("a", "b", "t_w", "t_x", "t_y", "t_z", "u_only")] == pytest.approx(w, abs=1e-7)
    assert got.get("k", 0.0) == 0
    new = spark.createDataFrame([(1, 4.0, 9.0, 7.0, "new", "only")], "id int, a double, b double, k double, t string, u string")
    seen = line.predict(df.withColumn("id", F.monotonically_increasing_id()), ["id"]).agg(F.avg("y_pred")).first()[0]
    assert seen == pytest.approx(y.mean()) and line.predict(new, ["id"]).first()["y_pred"] == pytest.approx(
        got["intercept"] + 4 * got["a"] + 9 * got["b"] + got["u_only"])


def test_too_many_one_hot_columns_are_an_error(tables, monkeypatch):
    monkeypatch.setattr(onehot_line, "MAX_COLUMNS", 10)
    with pytest.raises(ValueError, match="columns"):
        regressors.linear_regression_onehot(tables.features)


def test_one_hot_regression_equals_least_squares(tables):
    from paylens.operators.splits import split_64_16_20
    fitted = regressors.linear_regression_onehot(tables.features)
    pdf = split_64_16_20(tables.features).toPandas()
    train = (pdf["split"] == "train").to_numpy()
    hot = [(pdf[c].to_numpy()[:, None] == sorted(set(pdf.loc[train, c]))).astype(float) for c in ("edu_major", "industry_role")]
    x = np.hstack([np.ones((len(pdf), 1)), pdf[list(NUMERIC_FEATURES)].to_numpy(float), *hot])
    weights = np.linalg.lstsq(x[train], pdf.loc[train, "salary_k"].to_numpy(float), rcond=None)[0]
    # the prediction is unique where both levels were seen in training
    seen = np.logical_and(*[h.sum(axis=1) == 1 for h in hot])
    expected = {j: v for j, v, ok in zip(pdf["job_id"], x @ weights, seen) if ok}
    got = {r["job_id"]: r["y_pred"] for r in fitted.predictions.collect()}
    compared = [abs(got[j] - expected[j]) for j in got if j in expected]
    assert len(compared) > 0.9 * len(got) and max(compared) < 1e-5


def test_missing_target_is_a_clear_error(tables):
    with pytest.raises(KeyError, match="salary_k"):
        regressors.linear_regression(tables.features.drop("salary_k"))


LAYOUT = net_math.Layout(("a", "b"), ("c", "d"), (3, 5), (6, 4))


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(0)
    flat = LAYOUT.start(1)
    numbers, codes, y = rng.normal(size=(9, 2)), rng.integers(0, 3, (9, 2)), rng.normal(size=9)
    y[3] = np.nan  # such a row counts for nothing
    grad, loss = net_math.gradient(flat, numbers, codes, y, LAYOUT)

    def error(w):
        e = net_math.forward(LAYOUT.arrays(w), numbers, codes, LAYOUT)[0] - y
        return np.nanmean(e ** 2)

    assert loss == pytest.approx(error(flat))
    for i in rng.integers(0, len(flat), 60):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        assert grad[i] == pytest.approx((error(flat + step) - error(flat - step)) / 2e-6, abs=1e-5)


def test_embedding_gradients_add_up_by_flat_places(monkeypatch):
    rng = np.random.default_rng(3)
    flat = LAYOUT.start(1)
    batch = rng.normal(size=(40, 2)), rng.integers(0, 3, (40, 2)), rng.normal(size=40)
    expected, kinds = net_math.gradient(flat, *batch, LAYOUT)[0], []

    class Numpy:
        class add:
            @staticmethod
            def at(table, places, values):
                kinds.append(np.ndim(table))
                np.add.at(table, places, values)

        def __getattr__(self, name):
            return getattr(np, name)

    monkeypatch.setattr(net_math, "np", Numpy())
    assert (net_math.gradient(flat, *batch, LAYOUT)[0] == expected).all()
    # rows of a matrix are added many times more slowly
    assert kinds == [1, 1]


def test_layout_sizes():
    shapes = LAYOUT.shapes()
    assert shapes["embedding_c"] == (3, 2) and shapes["embedding_d"] == (5, 3)
    assert shapes["weight_1"] == (7, 6) and shapes["bias_3"] == (1,)
    assert net_math.Layout((), (), (), (2, 2)).shapes()["weight_1"] == (0, 2)


@pytest.mark.parametrize("clip", [5.0, 1e-3])
def test_adamw_first_step(clip):
    state = np.vstack([np.ones(2), np.zeros(2), np.zeros(2)])
    net_math.adamw_step(state, 1, np.array([3.0, -4.0]), lr=0.1, weight_decay=0.5, max_norm=clip)
    # the first step is the sign of the gradient times the rate, after the decay
    assert state[0] == pytest.approx([0.95 - 0.1, 0.95 + 0.1], abs=1e-3)


def test_minibatches_keep_every_row():
    chunks = [(np.arange(i, i + 7), -np.arange(i, i + 7)) for i in range(0, 21, 7)]
    got = list(net_math.minibatches(iter(chunks), 5, np.random.default_rng(0)))
    assert [len(a) for a, _ in got] == [5, 5, 5, 5, 1]
    assert sorted(v for a, _ in got for v in a) == list(range(21))
    assert all((a == -b).all() for a, b in got)


def test_training_lowers_the_loss_and_keeps_the_best(base):
    losses = [v for _, _, v in base.losses]
    assert losses[-1] < losses[0] and base.best_loss == min(losses)
    assert net._valid_losses(base.prepared, {0: base.weights})[0] == pytest.approx(base.best_loss, rel=1e-9)
    metrics = base.metrics().first()
    assert metrics["split"] == "test" and metrics["r2"] > 0.4
    assert base.predictions().columns == ["job_id", "y_true", "y_pred", "split"]


def test_training_does_not_depend_on_the_layout(tables, base):
    again = net.embedding_regressor(tables.features.repartition(11), replace(base.params, epochs=2))
    assert [v for _, _, v in again.losses] == pytest.approx([v for _, _, v in base.losses[:2]], rel=1e-9)


@pytest.mark.parametrize("per_shard", [300, 40])
def test_shards_are_averaged(tables, base, per_shard):
    params = replace(base.params, rows_per_shard=per_shard, epochs=4, batch_size=16)
    result = net.embedding_regressor(tables.features, params)
    shards = result.prepared.shards
    assert shards > 1 and result.prepared.train.rdd.getNumPartitions() == shards
    assert len({r["shard"] for r in result.prepared.train.select("shard").distinct().collect()}) == shards
    assert result.losses[-1][2] < result.losses[0][2]


def test_average_in_two_levels_equals_the_weighted_mean(spark):
    rng = np.random.default_rng(2)
    data = [(k, i, rng.normal(size=3).tolist(), 5, 1.0, float(i + 1)) for k in (0, 3) for i in range(40)]
    df = spark.createDataFrame(data, "run int, shard int, state array<double>, steps bigint, loss double, n double")
    averaged = net._average(df, 40)
    for k in (0, 3):
        got, mine = averaged[k], [d for d in data if d[0] == k]
        expected = np.average([d[2] for d in mine], axis=0, weights=[d[5] for d in mine])
        assert got["state"] == pytest.approx(expected.tolist()) and got["n"] == sum(d[5] for d in mine)


def test_settings_trained_together_equal_those_trained_alone(spark, base):
    params = [replace(base.params, epochs=3, lr=lr, batch_size=size, patience=1) for lr, size in ((1e-3, 32), (5e-2, 64))]
    together = net.fit_all(base.prepared, params, base.weights)
    for p, run in zip(params, together):
        alone = net.fit(base.prepared, p, base.weights)
        assert run.weights == pytest.approx(alone.weights, abs=1e-9) and len(run.losses) == len(alone.losses)
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for n in (1, 4):
        before = len(tracker.getJobIdsForGroup(None))
        net.fit_all(base.prepared, [replace(base.params, epochs=1, lr=1e-3 / (i + 1)) for i in range(n)], base.weights)
        jobs.append(len(tracker.getJobIdsForGroup(None)) - before)
    assert jobs[0] == jobs[1]


def test_a_stopped_run_goes_on_where_it_ended(base, tmp_path, monkeypatch):
    params = replace(base.params, epochs=4)
    unbroken = net.fit(base.prepared, params)
    net.fit(base.prepared, replace(params, epochs=2), progress=str(tmp_path))
    trained = []
    real = net._train_epoch
    monkeypatch.setattr(net, "_train_epoch", lambda prepared, runs, epoch: trained.append(epoch) or real(prepared, runs, epoch))
    resumed = net.fit(base.prepared, params, progress=str(tmp_path))
    assert trained == [3, 4] and len(resumed.losses) == 4
    assert resumed.weights == pytest.approx(unbroken.weights, abs=1e-9) and resumed.best_loss == pytest.approx(unbroken.best_loss)
    net.fit(base.prepared, replace(params, lr=1e-4), progress=str(tmp_path))
    assert trained == [3, 4, 1, 2, 3, 4]  # other settings start anew
    assert net.fit(base.prepared, params, progress=str(tmp_path)).losses == resumed.losses and len(trained) == 6


def test_predictions_are_replayed_in_sql_functions(base):
    from paylens.models.net_replay import replay
    got = {r["job_id"]: r["y_pred"] for r in replay(base).collect()}
    want = {r["job_id"]: r["y_pred"] for r in base.predictions().collect()}
    assert got == pytest.approx(want, abs=1e-3)


def test_fine_tuning_picks_the_lowest_loss(base):
    best, table = net.finetune_grid(base, FineTuneParams(epochs=2))
    losses = [r["val_loss"] for r in table.collect()]
    assert losses == sorted(losses) and best.best_loss == losses[0] and len(losses) == 2
    assert base.weights is not best.weights


def test_weights_and_metadata_survive_a_round_trip(spark, base, tmp_path):
    from paylens.sources import readers, writers
    path = writers.write_parquet(base.weights_table(), str(tmp_path / "weights"))
    loaded = net.load_weights(readers.read_parquet(spark, path), base.prepared.layout)
    assert np.array_equal(loaded, base.weights)
    with pytest.raises(ValueError, match="do not fit"):
        net.load_weights(base.weights_table(), LAYOUT)
    meta = base.metadata().first()
    assert meta["cat_cols"] == ["edu_major", "industry_role"] and meta["epochs"] == 25
    assert base.history().count() == len(base.losses)


def test_categoricals_may_be_absent(tables):
    result = net.embedding_regressor(tables.features.drop("edu_major", "industry_role"), NetParams(epochs=1))
    assert result.prepared.layout.cards == () and result.metrics().count() == 1


def test_a_network_too_large_to_be_sent_is_an_error(tables, monkeypatch):
    monkeypatch.setattr(net, "MAX_WEIGHTS", 10)
    with pytest.raises(ValueError, match="weights"):
        net.prepare(tables.features)


@pytest.mark.parametrize("limit", [1, 4])
def test_a_partition_of_many_shards_passes_on_one_state(base, tables, monkeypatch, limit):
    monkeypatch.setattr(net, "SHARDS", limit)
    params = replace(base.params, rows_per_shard=50, epochs=1, batch_size=16)
    prepared = net.prepare(tables.features, params)
    sent = []
    real = net._average
    monkeypatch.setattr(net, "_average", lambda rows, parts: sent.append(rows.count()) or real(rows, parts))
    net.fit(prepared, params)
    assert prepared.shards > 4 and sent == [-(-prepared.shards // min(limit, max(1, prepared.shards // limit)))]
    assert prepared.train.count() == prepared.shards


def test_replay_carries_no_weights_in_its_rows(base):
    plan = net_replay.replay(base)._jdf.queryExecution().optimizedPlan().toString()
    projects = [line for line in plan.splitlines() if "Generate explode" in line]
    assert len(projects) == 4
    kept = [line.strip() for line in plan.splitlines() if line.strip(" +-:").startswith("Project [job_id") and "scalar-subquery" not in line]
    assert all("_w" not in line for line in kept)


def test_replay_of_many_rows_is_compiled(tables, monkeypatch):
    result = net.embedding_regressor(tables.features, NetParams(epochs=1, hidden=(8, 4)))
    few = {r["job_id"]: r["y_pred"] for r in net_replay.replay(result).collect()}
    monkeypatch.setattr(net_replay, "MANY", 0, raising=False)
    many = net_replay.replay(result)
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(zip_with" not in plan
    assert {r["job_id"]: r["y_pred"] for r in many.collect()} == pytest.approx(few, abs=1e-9)
