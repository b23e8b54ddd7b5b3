"""Small helpers for building Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(udf):
    """Keep the optimizer from copying a costly Python function into inferred or pushed filters."""
    return udf.asNondeterministic()


def blank_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))
