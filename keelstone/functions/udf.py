"""Vectorised functions that are made into Columns when they are used, so that workers can import their modules without a session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def vectorised(returns: str) -> Callable[[Callable], Callable[..., Column]]:
    def mark(f: Callable) -> Callable[..., Column]:
        def apply(*columns) -> Column:
            return F.pandas_udf(f, returns)(*columns)

        apply.__doc__ = f.__doc__
        return apply

    return mark
