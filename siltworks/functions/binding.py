"""Binding a value once inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Inside the lambda of a higher-order function an expression over columns is computed again for every
    element; a bound value is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
