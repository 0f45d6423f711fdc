"""Values bound inside an expression, so that what reads them often computes them once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """make(value), with value computed once a row however often make reads it."""
    return F.transform(F.array(value), make)[0]
