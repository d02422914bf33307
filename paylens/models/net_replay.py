"""The network's forward pass in SQL functions, over its stored weights: an independent check of its predictions."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.models.net import NetResult, load_weights

#: From so many rows on, layers are written out and compiled: that takes about half a minute, and then little for each row.
MANY = 200_000


def _rows(matrix: Column, rows: int, width: int) -> Column:
    """A matrix stored row by row as an array of its rows."""
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.slice(matrix, i * width + 1, width))


def _units(weight: Column, bias: Column) -> Column:
    """A layer as one struct per unit, its bias and its weights, from the matrix stored row by row."""
    columns = F.size(bias)
    places = F.sequence(F.lit(0), (F.size(weight) / columns).cast("int") - 1)
    return F.transform(bias, lambda b, j: F.struct(
        b.alias("bias"), F.transform(places, lambda i: F.get(weight, i * columns + j)).alias("weights")))


def _dense(x: Column, units: Column, relu: bool) -> Column:
    """x times the layer's weights plus its biases, cut at zero if asked."""
    def value(unit: Column) -> Column:
        total = F.aggregate(F.zip_with(x, unit["weights"], lambda v, w: v * w), unit["bias"], lambda total, t: total + t)
        return F.greatest(total, F.lit(0.0)) if relu else total

    return F.transform(units, value)


def _number(x: float) -> str:
    return f"{x!r}D" if math.isfinite(x) else f"double('{x}')"


def _sum(terms: list[str]) -> str:
    """Added up in pairs: the planner's work on a long chain of sums grows with the square of its length."""
    half = len(terms) // 2
    return f"({_sum(terms[:half])} + {_sum(terms[half:])})" if half else terms[0]


def _written_out(weight: np.ndarray, bias: np.ndarray, relu: bool) -> Column:
    """The same as ``_dense`` of ``_x`` as sums, which are compiled; a lambda function is interpreted for every weight."""
    units = [_sum([_number(b), *(f"get(_x, {i}) * {_number(x)}" for i, x in enumerate(of))]) for of, b in zip(weight.T.tolist(), bias.tolist())]
    return F.expr(f"array({', '.join(f'greatest({u}, 0D)' if relu else u for u in units)})")


def _once(df: DataFrame, id_col: str, value: Column) -> DataFrame:
    """The id and the array as ``_x``. Exploding it keeps the optimizer from computing it anew in every unit of the next layer."""
    return df.select(id_col, F.explode(F.array(value)).alias("_x"))


def replay(result: NetResult, rows: DataFrame | None = None) -> DataFrame:
    """(id, y_pred) of the test rows, or of other prepared rows, from ``weights_table`` alone.

    The weights are scalar subqueries, turned once into one array per unit; no row carries them. Of ``MANY`` rows or more, the weights of the
    dense layers are numbers of the plan.
    """
    layout, id_col = result.prepared.layout, result.prepared.id_col
    rows = result.prepared.test if rows is None else rows
    table = result.weights_table()
    stored = table.agg(F.map_from_entries(F.collect_list(F.struct("name", "content"))).alias("w"))
    w = F.col("w")
    inputs, tables = [F.array(*[F.col(c).cast("double") for c in layout.numbers])], {}
    for c, card in zip(layout.categories, layout.cards):
        name = f"embedding_{c}"
        width = layout.shapes()[name][1]
        tables[f"_{name}"] = stored.select(_rows(w[name], card, width)).scalar()
        inputs.append(F.get(F.col(f"_{name}"), F.col(c).cast("int")))
    out = _once(rows.withColumns(tables) if tables else rows, id_col, F.concat(*inputs))
    many = rows.count() >= MANY
    arrays = layout.arrays(load_weights(table, layout)) if many else {}
    for layer, relu in ((1, True), (2, True), (3, False)):
        if many:
            written = out.select(id_col, _written_out(arrays[f"weight_{layer}"], arrays[f"bias_{layer}"], relu).alias("_v"))
            out = _once(written, id_col, F.col("_v"))
            continue
        units = stored.select(_units(w[f"weight_{layer}"], w[f"bias_{layer}"])).scalar()
        out = _once(out.withColumn("_units", units), id_col, _dense(F.col("_x"), F.col("_units"), relu))
    low, span = result.prepared.y_min, (result.prepared.y_max - result.prepared.y_min) or 1e-12
    return out.select(id_col, (F.col("_x")[0] * span + low).alias("y_pred"))
