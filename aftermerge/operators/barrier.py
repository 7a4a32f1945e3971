"""Evaluate an expensive expression exactly once per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_struct(df: DataFrame, struct: Column, names: Sequence[str]) -> DataFrame:
    """Add the fields of ``struct`` as columns ``names``, through a one-row generator.

    A projected expression is copied into every filter on its result when the filter is
    pushed down, and re-evaluated there (below a shuffle, even). Filters are not pushed
    through a generator whose output they use, so a message parsed here is parsed once. It
    stays in the scan stage and in the JVM; a NULL struct gives NULL columns.

    The struct is a projection of its own below the generator: a generator evaluates what it is given
    expression by expression, a projection as compiled code.
    """
    held = df.select("*", struct.alias("_held"))
    kept = [F.col(f"`{name}`") for name in df.columns]
    return held.select(*kept, F.inline(F.array("_held")).alias(*names))
