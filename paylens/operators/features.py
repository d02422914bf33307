"""Feature engineering: encodings, codes, imputing and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.columns import lookup, present, require
from paylens.operators.ranking import running_totals
from paylens.schemas import (
    CATEGORICAL_FEATURES, ENCODINGS, NUMERIC_FEATURES, RAW_CATEGORICALS, SCORE_COLUMNS,
)
from paylens.session import checkpoint


def encode_ordinals(df: DataFrame, encodings: Mapping[str, tuple] = ENCODINGS) -> DataFrame:
    """Add one integer column per dictionary; an unknown label gives null."""
    require(df, *[source for source, _ in encodings.values()])
    return df.withColumns({name: lookup(source, table) for name, (source, table) in encodings.items()})


def handcrafted_score(df: DataFrame, parts: Sequence[str] = SCORE_COLUMNS) -> DataFrame:
    """Sum of the scores; null if any part is null."""
    require(df, *parts)
    total = F.col(parts[0])
    for p in parts[1:]:
        total = total + F.col(p)
    return df.withColumn("handcrafted_score", total.cast("int"))


def interaction_features(df: DataFrame) -> DataFrame:
    require(df, "education", "major", "industry", "job_role")
    return df.withColumns({
        "edu_major": F.concat(F.col("education"), F.lit("_"), F.col("major")),
        "industry_role": F.concat(F.col("industry"), F.lit("_"), F.col("job_role")),
    })


def downcast_scores(df: DataFrame, columns: Sequence[str] = SCORE_COLUMNS) -> DataFrame:
    """Scores as one-byte integers."""
    return df.withColumns({c: F.col(c).cast("tinyint") for c in present(df, columns)})


def drop_raw_categoricals(df: DataFrame, columns: Sequence[str] = RAW_CATEGORICALS) -> DataFrame:
    return df.drop(*columns)


def build_features(clean: DataFrame, downcast: bool = False) -> DataFrame:
    """Clean rows to model features: one projection over the table, no shuffle."""
    encoded = interaction_features(handcrafted_score(encode_ordinals(clean)))
    return drop_raw_categoricals(downcast_scores(encoded) if downcast else encoded)


def finite_clean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null, NaN and the two infinities become 0 in the given columns."""
    def finite(c: str) -> Column:
        v = F.col(c).cast("double")
        usable = ~F.isnan(v) & (F.abs(v) != float("inf"))
        return F.when(usable, v).otherwise(0.0)

    return df.withColumns({c: finite(c) for c in present(df, columns)})


def label_codes(df: DataFrame, column: str, by_frequency: bool = False) -> DataFrame:
    """Dictionary (label, code) of a text column: codes 0.. in order, nulls left out.

    Labels are ordered alphabetically, or by falling frequency and then
    alphabetically. The code is the number of labels before, found by prefix
    sums, so even a very large dictionary needs no single-task sort.
    """
    require(df, column)
    labels = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    order = F.struct((-F.col("n")).alias("minus_n"), "label") if by_frequency else F.col("label")
    places = running_totals(labels.select("label", order.alias("place"), F.lit(1).alias("one")), "place", ["one"])
    return places.select("label", F.col("before_one").cast("int").alias("code"), F.col("total_one").alias("labels"))


class LabelIndex:
    """Codes fitted on one table, to be applied to others.

    The dictionary is computed once and stays a distributed, checkpointed table
    at every size; it is joined without a hint, so AQE picks the join by its
    measured size and may split a hot label.
    """

    def __init__(self, df: DataFrame, column: str, by_frequency: bool = False):
        self.column = column
        codes = checkpoint(label_codes(df, column, by_frequency))
        self.size = int((codes.agg(F.max("labels")).first() or [0])[0] or 0)
        self.table = codes.select("label", "code")

    def transform(self, df: DataFrame, unseen: int, output: str | None = None) -> DataFrame:
        """Add the code column; nulls and unseen labels get the code ``unseen``."""
        output = output or f"{self.column}_code"
        codes = self.table.select(F.col("label").alias("_label"), F.col("code").alias("_code"))
        joined = df.join(codes, F.col(self.column) == F.col("_label"), "left")
        return joined.withColumn(output, F.coalesce("_code", F.lit(unseen))).drop("_label", "_code")


def category_codes(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Replace each column by its alphabetical code, null by -1."""
    for c in columns:
        df = LabelIndex(df, c).transform(df, unseen=-1, output="_c").drop(c).withColumnRenamed("_c", c)
    return df


def fit_string_index(train: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> dict[str, LabelIndex]:
    """Frequency-ordered codes per column."""
    return {c: LabelIndex(train, c, by_frequency=True) for c in columns}


def string_index(df: DataFrame, indexes: Mapping[str, LabelIndex]) -> DataFrame:
    """Replace each column by its code; unseen and null share the extra last code."""
    for c, index in indexes.items():
        df = index.transform(df, unseen=index.size, output="_c").drop(c).withColumnRenamed("_c", c)
    return df


def cardinalities(indexes: Mapping[str, LabelIndex]) -> dict[str, int]:
    """Codes per column, the bucket for unseen labels included."""
    return {c: index.size + 1 for c, index in indexes.items()}


def clamp_codes(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Keep codes within [0, cardinality - 1]."""
    return df.withColumns({
        c: F.greatest(F.lit(0), F.least(F.col(c), F.lit(card - 1))) for c, card in limits.items()
    })


class OneHot:
    """One slot per level of every column, numbered column by column in alphabetical order.

    Labels stay in the distributed dictionaries; only their numbers reach the driver. The vectors are sparse.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES):
        require(df, *columns)
        self.indexes = {c: LabelIndex(df, c) for c in columns}

    def transform(self, df: DataFrame, output: str = "one_hot") -> DataFrame:
        """Add the vector; a null and a level that the fitted table does not have set no slot."""
        codes, hot = ([f"_{c}_{part}" for c in self.indexes] for part in ("code", "hot"))
        for (c, index), code in zip(self.indexes.items(), codes):
            df = index.transform(df, unseen=index.size, output=code)
        # the encoder learns the number of codes from one row; the last code, that of unseen levels, has no slot
        sizes = df.sparkSession.range(1).select(*[F.lit(i.size).alias(code) for i, code in zip(self.indexes.values(), codes)])
        encoder = OneHotEncoder(inputCols=codes, outputCols=hot, dropLast=True).fit(sizes)
        return VectorAssembler(inputCols=hot, outputCol=output).transform(encoder.transform(df)).drop(*codes, *hot)

    def slots(self) -> DataFrame:
        """(slot, column_name, level) of every slot."""
        out, start = None, 0
        for c, index in self.indexes.items():
            part = index.table.select((F.col("code") + start).alias("slot"), F.lit(c).alias("column_name"), F.col("label").alias("level"))
            out, start = part if out is None else out.unionByName(part), start + index.size
        return out


def slots_set(vector: str) -> Column:
    """Numbers of the slots of a vector that are not zero, whether it is stored sparsely or densely."""
    v = F.unwrap_udt(vector)
    places = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    held = F.filter(F.arrays_zip(places.alias("slot"), v["values"].alias("value")), lambda x: x["value"] != 0)
    return F.when(F.size(v["values"]) > 0, F.transform(held, lambda x: x["slot"])).otherwise(F.array().cast("array<int>"))


def one_hot(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> tuple[DataFrame, DataFrame]:
    """One sparse vector column of all levels, and the table of its slots with their names (``column_level``)."""
    fitted = OneHot(df, columns)
    return fitted.transform(df), fitted.slots().select("slot", F.concat_ws("_", "column_name", "level").alias("feature_name"))


def one_hot_totals(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Name of every one-hot slot with the number of vectors that set it."""
    encoded, names = one_hot(df, columns)
    counts = encoded.select(F.explode(slots_set("one_hot")).alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    return names.join(counts, "slot").select("feature_name", "n")


def numeric_feature_columns(
    df: DataFrame, id_col: str = "job_id", target: str = "salary_k", categoricals: Sequence[str] = CATEGORICAL_FEATURES
) -> list[str]:
    return [c for c in df.columns if c not in {id_col, target, *categoricals}]


def cast_numeric_features(
    df: DataFrame, id_col: str = "job_id", target: str = "salary_k", categoricals: Sequence[str] = CATEGORICAL_FEATURES
) -> DataFrame:
    """Everything but id, target and categoricals as double."""
    names = numeric_feature_columns(df, id_col, target, categoricals)
    return df.withColumns({c: F.col(c).cast("double") for c in names})


def median_impute(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the approximate median, or 0 where a column is all null.

    One aggregate covers all columns; its single row reaches the projection as
    a scalar subquery.
    """
    names = present(df, columns)
    medians = (df if fit_on is None else fit_on).agg(
        F.struct(*[F.percentile_approx(F.col(c).cast("double"), 0.5).alias(c) for c in names]).alias("m")
    )
    with_fit = df.withColumn("_m", medians.scalar())
    return with_fit.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.col(f"_m.{c}"), F.lit(0.0)) for c in names
    }).drop("_m")


def target_range(train: DataFrame, target: str = "salary_k") -> DataFrame:
    """Smallest and largest target of the fitting rows: one row."""
    y = F.col(target).cast("double")
    return train.agg(F.min(y).alias("y_min"), F.max(y).alias("y_max"))


def minmax_target(
    df: DataFrame, fit_on: DataFrame | None = None, target: str = "salary_k", output: str = "y_scaled"
) -> DataFrame:
    """Scale the target by the range of the fitting rows; a zero range counts as 1e-12."""
    fitted = target_range(df if fit_on is None else fit_on, target).select(F.struct("y_min", "y_max"))
    span = F.col("_y.y_max") - F.col("_y.y_min")
    scaled = (F.col(target).cast("double") - F.col("_y.y_min")) / F.when(span == 0, 1e-12).otherwise(span)
    return df.withColumn("_y", fitted.scalar()).withColumn(output, scaled).drop("_y")


def invert_target(scaled: Column, y_min: Column, y_max: Column) -> Column:
    """Inverse of ``minmax_target``."""
    span = y_max - y_min
    return scaled * F.when(span == 0, 1e-12).otherwise(span) + y_min


def assemble_features(
    df: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES, output: str = "features"
) -> DataFrame:
    """Numeric columns as one vector; a null is an error, so impute or drop first."""
    require(df, *columns)
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def standard_scale(
    df: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES, fit_on: DataFrame | None = None
) -> DataFrame:
    """Mean 0 and sample deviation 1 per column; a constant column becomes 0."""
    require(df, *columns)
    fitted = (df if fit_on is None else fit_on).agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("sd")).alias(c) for c in columns
    ]))
    def scaled(c: str) -> Column:
        mean, sd = F.col(f"_s.{c}.mean"), F.col(f"_s.{c}.sd")
        return F.when(sd > 0, (F.col(c) - mean) / sd).otherwise(0.0)

    return df.withColumn("_s", fitted.scalar()).withColumns({c: scaled(c) for c in columns}).drop("_s")
