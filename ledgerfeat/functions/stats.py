"""Aggregate expressions with the sample conventions the features need.

They take SQL text (a column name or expression), so that hundreds of them build quickly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUARTILES = {"p25": 0.25, "p75": 0.75}


def _double(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def sample_skewness(x: str) -> Column:
    """Third central moment over the cubed sample deviation; NULL for a constant group."""
    d = _double(x)
    shrink = f"power((count({d}) - 1) / count({d}), 1.5D)"
    return F.expr(f"CASE WHEN min({d}) < max({d}) THEN skewness({d}) * {shrink} END")


def sample_kurtosis(x: str) -> Column:
    """Excess kurtosis over the squared sample variance; NULL for a constant group."""
    d = _double(x)
    shrink = f"power((count({d}) - 1) / count({d}), 2.0D)"
    return F.expr(f"CASE WHEN min({d}) < max({d}) THEN (kurtosis({d}) + 3) * {shrink} - 3 END")


def exact_quantiles(x: str, names: dict[str, float]) -> list[Column]:
    """Linearly interpolated quantiles (type 7) named by ``names``, from one shared buffer."""
    points = ", ".join(f"{p}D" for p in names.values())
    both = f"percentile({_double(x)}, array({points}))"
    return [F.expr(f"{both}[{i}] AS {name}") for i, name in enumerate(names)]


def quantile_of_sorted(values: str, p: float) -> str:
    """SQL text of the type 7 quantile of a sorted array without NULLs; NULL for an empty one."""
    position = f"(size({values}) - 1) * {p}D"
    low, high = (f"get({values}, CAST({f}({position}) AS INT))" for f in ("floor", "ceil"))
    return f"({low} + ({high} - {low}) * ({position} - floor({position})))"


def basic(x: str, names: dict[str, str]) -> list[Column]:
    """Plain aggregates of a number: ``names`` maps a SQL function to the output name."""
    return [F.expr(f"CAST({f}({x if f == 'sum' else _double(x)}) AS DOUBLE) AS {name}") for f, name in names.items()]


def slope(y: str, x: str) -> Column:
    """Least-squares slope; pass ``x`` as a small offset (for example days to the last date)."""
    return F.expr(f"regr_slope({_double(y)}, {_double(x)})")


def count_where(condition: Column) -> Column:
    return F.count_if(condition)
