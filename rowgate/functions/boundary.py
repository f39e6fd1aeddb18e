"""Keeping expensive derived columns from being evaluated twice.

Catalyst pushes a filter on a derived column below the projection that computes
it, and so repeats the computation; over several layers of parsing the repeats
multiply, until planning itself runs out of memory. A generator is a boundary
that filters on its output do not cross, while filters on other columns do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df.withColumns`` for new columns that later steps filter on or reuse."""
    packed = F.struct(*(value.alias(name) for name, value in columns.items()))
    return df.select("*", F.inline(F.array(packed)))
