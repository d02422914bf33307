"""Reproducible train, validation and test splits.

A row's split depends on a hash of its id and the seed alone. It is therefore
the same for every partitioning and every rerun after a lost executor, needs no
shuffle, and two steps that split the same table always agree.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.functions.columns import hash_bucket, require

BUCKETS = 10_000


def split_by_bucket(
    df: DataFrame, limits: Mapping[str, int], last: str, id_col: str = "job_id", seed: int = 42
) -> DataFrame:
    """Add ``split``: the first name whose upper bucket limit is above the row's bucket, else ``last``."""
    require(df, id_col)
    name = F.lit(last)
    for split, limit in reversed(list(limits.items())):
        name = F.when(F.col("_bucket") < limit, split).otherwise(name)
    return df.withColumn("_bucket", hash_bucket(id_col, seed, BUCKETS)).withColumn("split", name).drop("_bucket")


def _hold_out_limits(test_size: float, valid_size: float) -> dict[str, int]:
    test = round(test_size * BUCKETS)
    return {"test": test, "valid": test + round((BUCKETS - test) * valid_size)}


def split_64_16_20(
    df: DataFrame, test_size: float = 0.2, valid_size: float = 0.2, id_col: str = "job_id", seed: int = 42
) -> DataFrame:
    """Hold out the test share, then the validation share of the rest."""
    return split_by_bucket(df, _hold_out_limits(test_size, valid_size), "train", id_col, seed)


def split_70_15_15(df: DataFrame, id_col: str = "job_id", seed: int = 42) -> DataFrame:
    """One three-way split."""
    return split_by_bucket(df, {"train": 7000, "val": 8500}, "test", id_col, seed)


def split_with_fallback(
    df: DataFrame, test_size: float = 0.2, valid_size: float = 0.2, id_col: str = "job_id", seed: int = 42
) -> DataFrame:
    """``split_64_16_20``, moving the limits when a split would stay empty.

    An empty test or validation split is retried with a share between 1 % and
    99 %; an empty training split with validation taking a fifth of the rest. A
    split that is still empty is an error. Only the three counts reach the driver.
    """
    def empty(split_df: DataFrame) -> set[str]:
        found = {r["split"] for r in split_df.groupBy("split").count().collect()}
        return {"train", "valid", "test"} - found

    result = split_64_16_20(df, test_size, valid_size, id_col, seed)
    missing = empty(result)
    if missing:
        if "test" in missing:
            test_size = min(0.99, max(0.01, test_size))
        if "valid" in missing:
            valid_size = min(0.99, max(0.01, valid_size))
        if "train" in missing:
            test_size, valid_size = min(0.99, test_size), 0.2
        result = split_64_16_20(df, test_size, valid_size, id_col, seed)
        missing = empty(result)
    if missing:
        raise ValueError(f"empty split(s): {', '.join(sorted(missing))}; check the shares and the number of rows")
    return result
