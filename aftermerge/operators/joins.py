"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
"""Rows of one key that a single task is expected to handle."""

HOT_KEYS = 50_000
"""Keys that are salted at most, the largest first: what bounds the broadcast of the salt table."""


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join many ``rows`` to few ``lookup`` rows per key, splitting hot keys over many tasks.

    A key with ``n >= hot_rows`` rows is given ``ceil(n / hot_rows)`` salts: its rows are
    spread over them by a hash of the whole row, and its lookup rows are copied to each.
    At most :data:`HOT_KEYS` keys are salted, those with the most rows; any other holds less than
    that part of all rows, which the engine splits at run time. Keys are counted after map-side
    combination, on ``counted`` where the same keys are at hand without the joins behind ``rows``. Rows with a NULL key match
    nothing and are spread as well. Results are those of a plain equi-join.

    Only ``left``, ``inner``, ``left_semi`` and ``left_anti`` keep their meaning when the
    lookup side is copied.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = list(on)
    hot = (
        (rows if counted is None else counted)
        .groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") >= hot_rows)
        .orderBy(F.desc("_n"), *keys)
        .limit(HOT_KEYS)
        .select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_splits"))
    )
    spread = F.xxhash64(*[F.col(c) for c in rows.columns])
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    salt = F.when(no_key, F.pmod(spread, F.lit(4096))).otherwise(
        F.pmod(spread, F.coalesce(F.col("_splits"), F.lit(1)))
    )
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt.cast("int"))
    copies = lookup.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_splits"), F.lit(1)) - 1))
    )
    joined = salted.drop("_splits").join(copies.drop("_splits"), [*keys, "_salt"], how)
    return joined.drop("_salt")
