"""The embedding network, trained data-parallel without collecting rows.

The training rows are placed once: a hash of the id picks the shard and the
order within it; a shard is one packed row, a partition holds a bounded number
of shards, checkpointed. An epoch is then one Spark job in which every shard
runs mini-batches from the same start weights, followed by a row-weighted
average of weights and optimizer moments, first over a partition's shards. The driver
holds one weight vector, the learning rate and the loss history. The number of
shards follows the rows alone; with one shard this is ordinary mini-batch training.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.columns import hash_bucket, present, require
from paylens.models import net_math
from paylens.models.evaluation import regression_metrics
from paylens.models.net_math import Layout, adamw_step, forward, gradient, inputs, minibatches
from paylens.operators.features import (
    cardinalities, cast_numeric_features, clamp_codes, finite_clean, fit_string_index, median_impute,
    minmax_target, numeric_feature_columns, string_index, target_range,
)
from paylens.operators.splits import split_with_fallback
from paylens.schemas import FineTuneParams, NetParams
from paylens.session import checkpoint, stage_table
from paylens.sources import writers

# executors need not have the package: its few array functions travel with the tasks
cloudpickle.register_pickle_by_value(net_math)

#: States that one task averages.
FAN_IN = 16
#: Partitions that the shards fill before one holds several, and most shards that one holds.
SHARDS = 64
#: Rows that are shuffled together within a shard.
CHUNK = 10_000
#: Most weights a network may have; they are sent to every task, with two moments each while training.
MAX_WEIGHTS = 20_000_000


@dataclass
class Prepared:
    """The placed training rows, the other splits and what was fitted on the training rows."""

    train: DataFrame
    valid: DataFrame
    test: DataFrame
    layout: Layout
    y_min: float
    y_max: float
    shards: int
    id_col: str


def prepare(
    features: DataFrame, params: NetParams = NetParams(), target: str = "salary_k", id_col: str = "job_id"
) -> Prepared:
    """Split, index, impute and scale; everything is fitted on the training rows."""
    require(features, id_col, target)
    cats = present(features, params.cat_cols)
    rows = split_with_fallback(
        features.where(F.col(target).isNotNull()), params.test_size, params.valid_size, id_col,
        params.random_state,
    )
    train = rows.where(F.col("split") == "train")
    indexes = fit_string_index(train, cats)
    numbers = numeric_feature_columns(features, id_col, target, cats)
    cards = cardinalities(indexes)

    def encode(df: DataFrame) -> DataFrame:
        return clamp_codes(string_index(df, indexes), cards)

    typed = cast_numeric_features(encode(rows), id_col, target, [*cats, "split"])
    typed_train = cast_numeric_features(train, id_col, target, [*cats, "split"])
    filled = finite_clean(median_impute(typed, numbers, typed_train), numbers)
    scaled = minmax_target(filled, train, target)
    # by split, so that an epoch's validation opens the validation files only
    staged = stage_table(scaled.select(id_col, target, "split", *numbers, *cats, "y_scaled"), "net_rows", "split")

    weights = sum(int(np.prod(s)) for s in Layout(
        tuple(numbers), tuple(cats), tuple(cards[c] for c in cats), tuple(params.hidden)).shapes().values())
    if weights > MAX_WEIGHTS:
        raise ValueError(f"the network would have {weights} weights; {MAX_WEIGHTS} can be sent to every task")

    # the bounds and the row count: one row
    of_train = staged.where(F.col("split") == "train")
    bounds = target_range(of_train, target).join(of_train.agg(F.count(F.lit(1)).alias("n"))).first()
    shards = max(1, -(-bounds["n"] // params.rows_per_shard))
    layout = Layout(tuple(numbers), tuple(cats), tuple(cards[c] for c in cats), tuple(params.hidden))
    per_task = shards_per_task(shards)
    place = hash_bucket(id_col, params.random_state + 1, 2 ** 31)
    placed = (
        of_train.withColumn("_place", place)
        .withColumn("shard", (F.col("_place") % shards).cast("int"))
        .withColumn("part", F.floor(F.col("shard") / per_task).cast("int"))
        .repartitionById(-(-shards // per_task), "part")
        .sortWithinPartitions("shard", "_place", id_col)
        .select("part", "shard", *numbers, *cats, "y_scaled")
    )
    return Prepared(
        train=checkpoint(_packed(placed, layout)),
        valid=staged.where(F.col("split") == "valid"),
        test=staged.where(F.col("split") == "test"),
        layout=layout,
        y_min=float(bounds["y_min"]), y_max=float(bounds["y_max"]), shards=shards, id_col=id_col,
    )


def shards_per_task(shards: int) -> int:
    """Shards that one partition holds: it passes on one state for all of them, so few states travel however many shards there are."""
    return min(SHARDS, max(1, shards // SHARDS))


def _packed(placed: DataFrame, layout: Layout) -> DataFrame:
    """One row per shard, in chunks of ``CHUNK`` rows: numbers, codes and targets as arrays that every epoch reads as they are."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def row(part: int, shard: int, held: list) -> pd.DataFrame:
            numbers, codes, y = (np.concatenate(parts) for parts in zip(*held))
            return pd.DataFrame({"part": [part], "shard": [shard], "n": [len(y)], "numbers": [numbers.tobytes()],
                                 "codes": [codes.astype(np.int32).tobytes()], "y": [y.tobytes()]})

        at, held = None, []
        for batch in batches:
            for key, rows in batch.groupby(["part", "shard"], sort=False):
                if key != at and held:
                    yield row(*at, held)
                    held = []
                at = key
                held.append(inputs(rows, layout))
        if held:
            yield row(*at, held)

    return placed.mapInPandas(pack, "part int, shard int, n int, numbers binary, codes binary, y binary")


def _average(shard_rows: DataFrame, shards: int) -> dict[int, dict]:
    """Row-weighted mean of the partitions' states, run by run, in a tree: no task reads more than ``FAN_IN`` of them."""
    def mean(df: DataFrame, *by: str) -> DataFrame:
        return df.groupBy(*by).agg(
            Summarizer.mean(F.col("state"), F.col("n")).alias("state"),
            F.max("steps").alias("steps"), F.sum("loss").alias("loss"), F.sum("n").alias("n"),
        )

    level = shard_rows.withColumn("state", array_to_vector("state")).withColumnRenamed("shard", "part")
    while shards > FAN_IN:
        level = mean(level.withColumn("part", F.floor(F.col("part") / FAN_IN)), "run", "part")
        shards = -(-shards // FAN_IN)
    return {r["run"]: r.asDict() for r in mean(level, "run").withColumn("state", vector_to_array("state")).collect()}


def _train_epoch(prepared: Prepared, runs: Mapping[int, Progress], epoch: int) -> dict[int, dict]:
    """One pass of every shard over its rows for every run, and the averages of the results: one job."""
    # plain values only: what the function refers to is sent to the executors
    layout = prepared.layout
    settings = [(k, r.params.random_state, r.params.batch_size, r.lr, r.params.weight_decay, r.params.max_norm, r.steps)
                for k, r in runs.items()]
    shared = prepared.train.sparkSession.sparkContext.broadcast({k: r.state for k, r in runs.items()})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, means = None, {}
        for r in (r for batch in batches for r in batch.itertuples()):
            part = int(r.part)
            numbers = np.frombuffer(r.numbers, np.float32).reshape(r.n, len(layout.numbers))
            codes = np.frombuffer(r.codes, np.int32).reshape(r.n, len(layout.categories)).astype(np.int64)
            y = np.frombuffer(r.y, np.float32)
            # a shard has a bounded number of rows; every run passes over them
            arrays = [tuple(x[at:at + CHUNK] for x in (numbers, codes, y)) for at in range(0, r.n, CHUNK)]
            for k, seed, size, lr, weight_decay, max_norm, done in settings:
                local, rows, loss = shared.value[k].astype(np.float32), 0, 0.0
                for batch in minibatches(arrays, size, np.random.default_rng([seed, epoch, r.shard])):
                    grad, error = gradient(local[0], *batch, layout)
                    done += 1
                    adamw_step(local, done, grad, lr, weight_decay, max_norm)
                    rows += len(batch[0])
                    loss += error * len(batch[0])
                state, n = local.astype(float).ravel(), float(rows)
                if k in means:
                    mean, total, before, steps = means[k]
                    mean += (state - mean) * (n / (total + n))
                    means[k] = mean, total + n, before + loss, max(steps, done)
                else:
                    means[k] = state, n, loss, done
        for k, (mean, n, loss, steps) in means.items():
            yield pd.DataFrame({"run": [k], "shard": [part], "state": [mean], "steps": [steps], "loss": [loss], "n": [n]})

    part_rows = prepared.train.mapInPandas(run, "run int, shard int, state array<double>, steps bigint, loss double, n double")
    result = _average(part_rows, -(-prepared.shards // shards_per_task(prepared.shards)))
    shared.destroy()
    return result


def _valid_losses(prepared: Prepared, weights: Mapping[int, np.ndarray]) -> dict[int, float]:
    """Mean squared error of every run on the validation rows, summed up where they lie: one job."""
    layout = prepared.layout
    shared = prepared.valid.sparkSession.sparkContext.broadcast(dict(weights))

    def run(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in chunks:
            numbers, codes, y = inputs(pdf, layout)
            for k, flat in shared.value.items():
                error = forward(layout.arrays(flat), numbers, codes, layout)[0] - y
                error = error[np.isfinite(error)]
                yield pd.DataFrame({"run": [k], "loss": [float(error @ error)], "n": [len(error)]})

    columns = [*layout.numbers, *layout.categories, "y_scaled"]
    totals = prepared.valid.select(*columns).mapInPandas(run, "run int, loss double, n bigint").groupBy("run").agg(
        F.sum("loss").alias("loss"), F.sum("n").alias("n")
    ).collect()
    shared.destroy()
    return {k: float("nan") for k in weights} | {r["run"]: float(r["loss"] / r["n"]) for r in totals if r["n"]}


def predict(prepared: Prepared, weights: np.ndarray, df: DataFrame | None = None) -> DataFrame:
    """Prediction table of the test rows (or of other prepared rows) in the unit of the target."""
    layout, id_col = prepared.layout, prepared.id_col
    df = prepared.test if df is None else df
    low, span = prepared.y_min, (prepared.y_max - prepared.y_min) or 1e-12
    kind = df.schema[id_col].dataType.simpleString()
    spark_weights = df.sparkSession.sparkContext.broadcast(weights)

    def run(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = layout.arrays(spark_weights.value)
        for pdf in chunks:
            numbers, codes, y = inputs(pdf, layout)
            yield pd.DataFrame({
                id_col: pdf[id_col], "y_true": y * span + low,
                "y_pred": forward(w, numbers, codes, layout)[0] * span + low, "split": pdf["split"],
            })

    columns = [id_col, "split", *layout.numbers, *layout.categories, "y_scaled"]
    return df.select(*columns).mapInPandas(run, f"{id_col} {kind}, y_true double, y_pred double, split string")


@dataclass
class NetResult:
    """A trained network: best weights, loss history, settings, and the rows it was prepared from."""

    weights: np.ndarray
    best_loss: float
    losses: list[tuple[int, float, float]]
    params: NetParams
    prepared: Prepared

    def _spark(self) -> SparkSession:
        return self.prepared.test.sparkSession

    def predictions(self) -> DataFrame:
        return predict(self.prepared, self.weights)

    def metrics(self) -> DataFrame:
        return regression_metrics(self.predictions())

    def history(self) -> DataFrame:
        return self._spark().createDataFrame(self.losses, "epoch int, train_loss double, val_loss double")

    def metadata(self) -> DataFrame:
        """One row: feature names, cardinalities, settings and the range of the target."""
        layout, p = self.prepared.layout, self.params
        settings = {k: v for k, v in asdict(p).items() if isinstance(v, (int, float))}
        row = {
            "num_cols": list(layout.numbers), "cat_cols": list(layout.categories),
            "cat_cardinalities": list(layout.cards), **settings,
            "shards": self.prepared.shards, "y_min": self.prepared.y_min, "y_max": self.prepared.y_max,
        }
        kinds = {list: "array<string>", int: "bigint", float: "double"}
        schema = ", ".join(
            f"{k} array<int>" if k == "cat_cardinalities" else f"{k} {kinds[type(v)]}" for k, v in row.items()
        )
        return self._spark().createDataFrame([tuple(row.values())], schema)

    def weights_table(self) -> DataFrame:
        """One row per array: name, shape and values, to be written as Parquet."""
        arrays = self.prepared.layout.arrays(self.weights)
        rows = [(name, list(a.shape), a.ravel().tolist()) for name, a in arrays.items()]
        return self._spark().createDataFrame(rows, "name string, shape array<int>, content array<double>")


def load_weights(table: DataFrame, layout: Layout) -> np.ndarray:
    """Flat weights from a table written by ``weights_table``: one row per array of the network."""
    stored = {r["name"]: r for r in table.collect()}
    for name, shape in layout.shapes().items():
        if name not in stored or tuple(stored[name]["shape"]) != shape:
            raise ValueError(f"stored weights do not fit the features: {name} should have shape {shape}")
    return np.concatenate([np.asarray(stored[name]["content"], float) for name in layout.shapes()])


@dataclass
class Progress:
    """Where a run stands between two epochs; all that the next epoch depends on."""

    params: NetParams
    state: np.ndarray
    best: np.ndarray
    best_loss: float = float("inf")
    waited: int = 0
    steps: int = 0
    plateau: float = float("inf")
    flat_epochs: int = 0
    lr: float = 0.0
    losses: list[tuple[int, float, float]] = field(default_factory=list)
    stopped: bool = False

    @classmethod
    def start(cls, params: NetParams, weights: np.ndarray) -> Progress:
        weights = np.array(weights, float)
        return cls(params, np.vstack([weights, np.zeros_like(weights), np.zeros_like(weights)]), weights.copy(), lr=params.lr)

    def trained(self, result: dict) -> None:
        self.state, self.steps = np.asarray(result["state"]).reshape(self.state.shape), result["steps"]

    def validated(self, epoch: int, train_loss: float, valid: float) -> None:
        """Early stopping, and the learning rate times ``lr_factor`` after ``lr_patience`` epochs without a relative gain of 1e-4."""
        self.losses.append((epoch, train_loss, valid))
        if valid < self.plateau * (1 - 1e-4):
            self.plateau, self.flat_epochs = valid, 0
        else:
            self.flat_epochs += 1
            if self.flat_epochs > self.params.lr_patience:
                self.lr, self.flat_epochs = self.lr * self.params.lr_factor, 0
        if valid < self.best_loss:
            self.best, self.best_loss, self.waited = self.state[0].copy(), valid, 0
        else:
            self.waited += 1
            self.stopped = self.waited >= self.params.patience

    def packed(self) -> tuple:
        plain = {f: getattr(self, f) for f in _PLAIN}
        return self.state.ravel().tolist(), self.best.tolist(), json.dumps(plain)

    def restore(self, row) -> None:
        self.state, self.best = np.array(row["state"]).reshape(self.state.shape), np.array(row["best"])
        for name, value in json.loads(row["plain"]).items():
            setattr(self, name, [tuple(x) for x in value] if name == "losses" else value)


_PLAIN = ("best_loss", "waited", "steps", "plateau", "flat_epochs", "lr", "losses", "stopped")


def _progress_folder(path: str, prepared: Prepared, runs: list[Progress]) -> str:
    """A folder named after all that decides the course of the runs; the number of epochs does not."""
    told = [repr(replace(r.params, epochs=0)) for r in runs] + [repr((prepared.layout, prepared.y_min, prepared.y_max, prepared.shards))]
    digest = hashlib.sha256("\n".join(told).encode())
    for r in runs:
        digest.update(r.state.tobytes())
    return f"{path}/{digest.hexdigest()[:24]}"


def _stored(spark: SparkSession, path: str) -> bool:
    """Was the table written to its end?"""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def fit_all(
    prepared: Prepared, params: Sequence[NetParams], initial: np.ndarray | None = None, progress: str | None = None
) -> list[NetResult]:
    """Train one network per setting with early stopping on the validation loss, and keep a copy of the best weights of each.

    An epoch is two jobs, however many settings there are. With ``progress``, a folder, every epoch's end is written there, and
    a later call with the same rows and settings goes on after the last one that was written.
    """
    start = prepared.layout.start(params[0].random_state) if initial is None else initial
    runs = [Progress.start(p, start) for p in params]
    spark = prepared.train.sparkSession
    folder = progress and _progress_folder(progress, prepared, runs)
    epoch = 0
    while folder and epoch < max(p.epochs for p in params) and _stored(spark, f"{folder}/epoch{epoch + 1}"):
        epoch += 1
    if epoch:
        for row in spark.read.parquet(f"{folder}/epoch{epoch}").collect():
            runs[row["run"]].restore(row)
    while live := {k: r for k, r in enumerate(runs) if not r.stopped and epoch < r.params.epochs}:
        epoch += 1
        results = _train_epoch(prepared, live, epoch)
        for k, r in live.items():
            r.trained(results[k])
        valid = _valid_losses(prepared, {k: r.state[0] for k, r in live.items()})
        for k, r in live.items():
            r.validated(epoch, float(results[k]["loss"] / results[k]["n"]), valid[k])
        if folder:
            rows = [(k, *r.packed()) for k, r in enumerate(runs)]
            table = spark.createDataFrame(rows, "run int, state array<double>, best array<double>, plain string")
            writers.write_parquet(table, f"{folder}/epoch{epoch}")
    return [NetResult(r.best, r.best_loss, r.losses, r.params, prepared) for r in runs]


def fit(
    prepared: Prepared, params: NetParams = NetParams(), initial: np.ndarray | None = None, progress: str | None = None
) -> NetResult:
    """``fit_all`` with one setting."""
    return fit_all(prepared, [params], initial, progress)[0]


def embedding_regressor(features: DataFrame, params: NetParams = NetParams(), progress: str | None = None, **columns) -> NetResult:
    """Prepare the features and train from random weights; ``progress`` as in ``fit_all``."""
    return fit(prepare(features, params, **columns), params, progress=progress)


def finetune_grid(
    base: NetResult, tuning: FineTuneParams = FineTuneParams(), settings: Sequence[dict] | None = None, progress: str | None = None
) -> tuple[NetResult, DataFrame]:
    """Short runs from the base weights, one per setting and all in the same jobs; the lowest validation loss wins.

    Returns the best run and a table of all settings with their losses.
    """
    params = [
        replace(
            base.params, epochs=tuning.epochs, patience=tuning.patience,
            lr_patience=max(1, tuning.patience // 2),
            lr=chosen.get("lr", 1e-3), batch_size=chosen.get("batch_size", 256),
            weight_decay=chosen.get("weight_decay", 0.0),
        )
        for chosen in settings or tuning.grid
    ]
    runs = fit_all(base.prepared, params, base.weights, progress)
    table = base.prepared.test.sparkSession.createDataFrame(
        [(r.params.lr, r.params.batch_size, r.params.weight_decay, r.best_loss) for r in runs],
        "lr double, batch_size int, weight_decay double, val_loss double",
    ).orderBy("val_loss", "lr", "batch_size")
    return min(runs, key=lambda r: r.best_loss), table
