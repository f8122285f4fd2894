"""Validation and cleaning: null and range rules, de-duplication, quality metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airmill import constants as K


def is_missing(column: str) -> Column:
    return F.col(column).isNull() | F.isnan(F.col(column).cast("double"))


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail when a needed column is absent."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")
    return df


def shared_columns(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns of ``columns`` that both frames have, in the given order; fails when there are none."""
    both = [c for c in columns if c in left.columns and c in right.columns]
    if not both:
        raise ValueError(f"no shared columns among {list(columns)}")
    return both


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Remove rows with a null or NaN in any of ``columns``."""
    return df.na.drop(subset=list(columns))


def in_range(rules: dict[str, tuple[float, float]] = K.VALID_RANGES) -> Column:
    """Inclusive range test over all rule columns."""
    test = F.lit(True)
    for column, (low, high) in rules.items():
        test = test & F.col(column).between(low, high)
    return test


def _counts(df: DataFrame, tests: dict[str, Column], name: str, value: str) -> DataFrame:
    """One aggregate pass, one output row per test."""
    one = df.agg(*[F.count_if(test).alias(key) for key, test in tests.items()])
    return one.unpivot([], list(tests), name, value)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_count), NaN counted as null."""
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    tests = {c: is_missing(c) if c in numeric else F.col(c).isNull() for c in columns}
    return _counts(df, tests, "column_name", "null_count")


def range_violations(
    df: DataFrame, rules: dict[str, tuple[float, float]] = K.VALID_RANGES, required: Sequence[str] = ()
) -> DataFrame:
    """(column_name, out_of_range): every column on its own, over the rows left by the null drop."""
    kept = drop_nulls(df, [*rules, *required])
    tests = {c: (F.col(c) < low) | (F.col(c) > high) for c, (low, high) in rules.items()}
    return _counts(kept, tests, "column_name", "out_of_range")


def keep_valid(df: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Null drop, then the range filter."""
    return drop_nulls(df, [*K.SENSOR_COLUMNS, *required]).where(in_range())


def keep_latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``newest`` tuple. Null keys are equal to each other.

    An aggregate instead of ``row_number``: copies collapse on the map side, so a key with very many copies is never
    gathered in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*newest)).alias("_best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_best.{c}") for c in df.columns])


def quality_metrics(df: DataFrame, keys: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """One row: total_in, clean_rows (before de-duplication), clean_out (after), dropped, quality_score, low_quality."""
    present = F.lit(True)
    for c in [*K.SENSOR_COLUMNS, *required]:
        numeric = c in K.SENSOR_COLUMNS
        present = present & (~is_missing(c) if numeric else F.col(c).isNotNull())
    good = F.coalesce(present & in_range(), F.lit(False))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.count_if(good).alias("good"))
    one = per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_in"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("clean_rows"),
        F.count_if(F.col("good") > 0).alias("clean_out"),
    )
    score = F.coalesce(F.try_divide(F.col("clean_rows"), F.col("total_in")), F.lit(0.0))
    return one.select(
        "total_in",
        "clean_rows",
        "clean_out",
        (F.col("total_in") - F.col("clean_rows")).alias("dropped"),
        score.alias("quality_score"),
        (score < K.LOW_QUALITY_RATIO).alias("low_quality"),
    )
