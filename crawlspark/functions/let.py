"""Name an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body reads it.

    Writing a sub-expression several times makes the tree grow with every nesting level, and
    Catalyst copies it again when it pushes a filter down.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
