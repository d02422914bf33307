from conftest import rows

from paylens.plans import runs
from paylens.schemas import FineTuneParams, NetParams
from paylens.sources import readers, writers

PARAMS = NetParams(epochs=2, batch_size=64)


def test_all_steps_from_csv(spark, tables, tmp_path):
    out = str(tmp_path / "out")
    employee = writers.write_csv(tables.raw_employee, str(tmp_path / "employee"))
    salary = writers.write_csv(tables.raw_salary, str(tmp_path / "salary"))
    runs.process_data(spark, employee, salary, out)
    assert rows(runs.read_clean(spark, out)) == rows(tables.clean)
    assert rows(runs.read_features(spark, out)) == rows(tables.features)

    models = ("linear_regression", "linear_regression_onehot")
    runs.train_models(spark, out, models, PARAMS)
    runs.fine_tune(spark, out, PARAMS, FineTuneParams(epochs=1))
    compared = runs.compare_models(spark, out, (*models, "embedding_regressor", "finetuned"))
    assert {r["model"] for r in compared.collect()} == {*models, "embedding_regressor", "finetuned"}
    path = f"{out}/models/finetuned"
    assert readers.read_json(spark, f"{path}/history", "epoch int, val_loss double").count() == 1
    csv = readers.read_predictions_csv(spark, f"{path}/predictions_csv")
    assert rows(csv) == rows(readers.read_parquet(spark, f"{path}/predictions"))
