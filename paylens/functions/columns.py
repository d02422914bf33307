"""Column expressions. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.schemas import NA_TOKENS


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given names that the table has, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def require(df: DataFrame, *names: str) -> None:
    """Raise ``KeyError`` naming the columns the table lacks."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"missing column(s): {', '.join(missing)}; have: {', '.join(df.columns)}")


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once.

    The optimizer puts what lies behind a column into every place that names it; a value that is tested and then used is otherwise
    computed again each time, and a method of generated code that grows too large for it is not compiled to machine code any more.
    """
    return F.get(F.transform(F.array(value), then), F.lit(0))


def first_digits(name: str) -> Column:
    """First run of digits as a long: ``JOB123`` gives 123, no digits gives null."""
    return F.regexp_extract(F.col(name).cast("string"), "([0-9]+)", 1).try_cast("bigint")


def tokens_to_null(name: str, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """The text column with every missing-value token replaced by null."""
    text = F.col(name).cast("string")
    return F.when(~text.isin(*tokens), text)


def to_double(name: str, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Number as double; tokens, NaN and anything unreadable become null."""
    return F.nanvl(tokens_to_null(name, tokens).try_cast("double"), F.lit(None).cast("double"))


def to_long(name: str, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Number as long; a decimal text loses its fraction, bad text becomes null."""
    whole = lambda text: F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    return once(F.col(name).cast("string"), lambda text: F.when(~text.isin(*tokens), whole(text)))


def lookup(name: str, table: Mapping[str, int], kind: str = "int") -> Column:
    """Value of a small literal dictionary; an unknown key gives null."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.create_map(*pairs)[F.col(name)].cast(kind)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent with two decimals, halves to the even one."""
    return F.bround(part * F.lit(100.0) / whole, 2)


def as_double(value: Column, places: int = 9) -> Column:
    """Double rounded for comparison and display."""
    return F.round(value.cast("double"), places)


def hash_bucket(id_col: str, seed: int = 42, buckets: int = 10_000) -> Column:
    """Bucket of a row id: a pure function of seed and id, whatever the layout."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)
