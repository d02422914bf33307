from conftest import rows

from paylens.models.regressors import linear_regression, predict
from paylens.operators.splits import split_70_15_15
from paylens.schemas import RAW_SALARY
from paylens.session import scratch_path, shared_dir
from paylens.sources import readers, writers


def test_malformed_lines_are_kept(spark, tmp_path):
    (tmp_path / "s.csv").write_text("jobId,salaryInThousands\nJOB1,5\nJOB2\nJOB3,7,8\n,\n")
    got = readers.read_raw_csv(spark, str(tmp_path / "s.csv"), RAW_SALARY, keep_corrupt=True).collect()
    assert [r["jobId"] for r in got] == ["JOB1", "JOB2", "JOB3", None]
    assert [r["_corrupt_record"] is None for r in got] == [True, False, False, True]


def test_tokens_become_null_in_every_column(spark, tmp_path):
    (tmp_path / "s.csv").write_text("jobId,salaryInThousands\nNA,n/a\nNONE,NULL\n")
    got = readers.read_csv_na_tokens(spark, str(tmp_path / "s.csv"), RAW_SALARY)
    assert rows(got) == [("NONE", None), (None, None)]


def test_overwrite_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_parquet(spark.range(10), path)
    writers.write_parquet(spark.range(3), path)
    assert readers.read_parquet(spark, path).count() == 3


def test_merged_schemas(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    writers.write_parquet(spark.createDataFrame([(1, "x")], "k int, v string"), a)
    writers.write_parquet(spark.createDataFrame([(2,)], "k int"), b)
    got = readers.read_parquet(spark, a, b, merge_schema=True)
    assert rows(got.select("k", "v")) == [(1, "x"), (2, None)]


def test_json_keeps_null_metrics(spark, tmp_path):
    df = spark.createDataFrame([("t", None, 1.5)], "split string, r2 double, mae double")
    path = writers.write_json(df, str(tmp_path / "m"))
    assert '"r2":null' in "".join(p.read_text() for p in (tmp_path / "m").glob("*.json"))
    assert rows(readers.read_json(spark, path, df.schema)) == rows(df)


def test_model_round_trip(tables, tmp_path):
    fitted = linear_regression(tables.features)
    loaded = readers.load_model(writers.save_model(fitted.model, str(tmp_path / "m")))
    held_out = split_70_15_15(tables.features).where("split <> 'train'")
    assert rows(predict(loaded, held_out)) == rows(fitted.predictions)


def test_scratch_paths_are_in_the_shared_folder_and_fresh(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark)) == b.startswith(shared_dir(spark)) is True
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
