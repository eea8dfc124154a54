"""Helpers for expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once a row. Where use() has a lambda over an array in which value stands, Spark
    would compute value again for every element: an array's mean in a lambda over the array costs its length squared."""
    return F.transform(F.array(value), use)[0]
