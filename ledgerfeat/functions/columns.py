"""Choosing, casting and naming columns of a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.NumericType,)
DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def names_by_pattern(df: DataFrame, *, starts_with: Sequence[str] = (), contains: Sequence[str] = ()) -> list[str]:
    """Columns whose name starts with, or contains, one of the texts (case ignored)."""
    heads = tuple(s.lower() for s in starts_with)
    parts = [s.lower() for s in contains]
    return [c for c in df.columns
            if (heads and c.lower().startswith(heads)) or any(p in c.lower() for p in parts)]


def names_by_type(df: DataFrame, *kinds: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def select_by_pattern(df: DataFrame, *, keep: Sequence[str] = (), **patterns: Sequence[str]) -> DataFrame:
    wanted = set(names_by_pattern(df, **patterns)) | set(keep)
    return df.select(*[c for c in df.columns if c in wanted])


def drop_by_pattern(df: DataFrame, *, keep: Sequence[str] = (), **patterns: Sequence[str]) -> DataFrame:
    unwanted = set(names_by_pattern(df, **patterns)) - set(keep)
    return df.drop(*unwanted)


def select_by_type(df: DataFrame, *kinds: type, keep: Sequence[str] = ()) -> DataFrame:
    wanted = set(names_by_type(df, *kinds)) | set(keep)
    return df.select(*[c for c in df.columns if c in wanted])


def convert_by_type(df: DataFrame, kinds: tuple[type, ...], convert: Callable[[Column], Column],
                    skip: Sequence[str] = ()) -> DataFrame:
    """Apply ``convert`` to every column of the given types."""
    names = [c for c in names_by_type(df, *kinds) if c not in skip]
    return df.withColumns({c: convert(F.col(c)) for c in names}) if names else df


def dates_to_numeric(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Dates as day numbers."""
    return convert_by_type(df, DATES, lambda c: F.unix_date(F.to_date(c)), skip)


def numbers_to_double(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    return convert_by_type(df, NUMERIC, lambda c: c.cast("double"), skip)


def fill_null(df: DataFrame, columns: Sequence[str], value: float = 0) -> DataFrame:
    return df.fillna(value, subset=[c for c in columns if c in df.columns])


def drop_higher_moments(df: DataFrame) -> DataFrame:
    return drop_by_pattern(df, starts_with=["kurtosis", "skewness"])


def unpivot_in_place(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column], name: str, value: str) -> DataFrame:
    """One row per row and entry of ``columns``, like ``unpivot``; rows stay in their partitions, known as such to the planner.

    So a grouping by keys that the rows are already spread by needs no shuffle of the long form.
    """
    entries = [F.struct(F.lit(n).alias(name), c.alias(value)) for n, c in columns.items()]
    return df.select(*keys, F.inline(F.array(*entries)))


def widen(df: DataFrame, key: str, by: str, values: Sequence[object], measures: Sequence[str],
          name: Callable[[str, object], str]) -> DataFrame:
    """One row per ``key``: each measure of each ``by`` value in a column of its own.

    ``df`` holds one row per (key, by), so ``first`` only picks that row. The values are given, so
    no pass over the data looks for them.
    """
    wide = df.groupBy(key).pivot(by, list(values)).agg(*[F.first(m).alias(m) for m in measures])
    return wide.toDF(key, *[name(m, v) for v in values for m in measures])
