"""Give a value a name inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A column used several times in later expressions may be substituted into
    each of them, even into a lambda that runs per element. Bound this way it
    is a lambda argument and cannot be.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
