"""As-of join: for every row the state of its key that was last set at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aftermerge.operators.joins import HOT_ROWS


def time_blocks(times: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Blocks of time for keys with more than ``hot_rows`` rows: ``on...``, ``hour``, ``block``.

    ``times`` has a row per input row with the key and its ``hour``. Rows are counted per key and,
    only for hot keys, of which there is one for ``hot_rows`` rows at most, per hour; running totals
    over those counts cut a hot key into blocks of about ``hot_rows`` rows, each a stretch of whole
    hours. Other keys have no row: they are one block.
    """
    hot = times.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    times = times.join(F.broadcast(hot.select(*on)), list(on), "left_semi")
    hours = times.groupBy(*on, "hour").agg(F.count(F.lit(1)).alias("_n"))
    upward = Window.partitionBy(*on).orderBy("hour")
    before = F.coalesce(F.sum("_n").over(upward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = hours.select(*on, "hour", before.alias("_before"))
    return placed.select(*on, "hour", F.floor(F.col("_before") / hot_rows).cast("int").alias("block"))


def block_begins(blocks: DataFrame, on: Sequence[str]) -> DataFrame:
    """The blocks of :func:`time_blocks` as one row per hot key: ``on...`` and ``_begins``, the hours they
    begin with, in order."""
    begins = blocks.groupBy(*on, "block").agg(F.min("hour").alias("_begin"))
    return begins.groupBy(*on).agg(F.sort_array(F.collect_list("_begin")).alias("_begins"))


def block_at(at: Column) -> Column:
    """How many of ``_begins`` lie at or before ``at``, by bisection; 0 without ``_begins``."""
    count = F.size("_begins")
    steps = F.transform(F.sequence(F.ceil(F.log2(count + 1)), F.lit(0)), lambda i: F.pow(F.lit(2), i).cast("int"))
    reached = lambda n: (n <= count) & (F.get("_begins", n - 1) <= at)
    found = F.aggregate(steps, F.lit(0), lambda n, step: F.when(reached(n + step), n + step).otherwise(n))
    return F.when(F.col("_begins").isNull(), 0).otherwise(found)


def asof_join(
    rows: DataFrame,
    states: DataFrame,
    on: Sequence[str],
    at: str,
    since: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``rows`` with the columns of the state valid at ``at`` (NULL before the first state).

    ``states`` sets the columns besides ``on`` and ``since`` from ``since`` on; of states set at
    the same time the greatest wins. Both sides are laid in one time order per key and the last
    state seen is carried forward, so a row meets one state, not all of its key's. A key that is
    hot on both sides together is cut into blocks of time that are ordered apart; what holds at a
    block's begin is carried into it as a state of its own. Rows without key or time have no state.
    """
    keys = list(on)
    values = [c for c in states.columns if c not in (*keys, since)]
    if clash := {*values} & {*rows.columns}:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    state = F.struct(*[F.col(f"`{c}`") for c in values])
    moment = lambda name: F.col(f"`{name}`").cast("timestamp")
    names = [f"_k{i}" for i in range(len(keys))]

    def side(df: DataFrame, time: str, number: int, **packed: Column | None) -> DataFrame:
        return df.select(
            *[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)],
            moment(time).alias("_t"),
            F.lit(number).alias("_side"),
            *[(F.lit(None) if c is None else c).alias(n) for n, c in packed.items()],
        )

    row_type, state_type = rows.select(row.alias("r")).schema[0], states.select(state.alias("s")).schema[0]
    none_row, none_state = F.lit(None).cast(row_type.dataType), F.lit(None).cast(state_type.dataType)
    def placed(time: str) -> Column:
        known = F.col(f"`{time}`").isNotNull()
        for k in keys:
            known = known & F.col(f"`{k}`").isNotNull()
        return known

    can_match, set_states = rows.where(placed(at)), states.where(placed(since))
    both = side(can_match, at, 1, _row=row, _state=none_state).unionByName(
        side(set_states, since, 0, _row=none_row, _state=state)
    )
    hours = both.select(*names, F.date_trunc("hour", "_t").alias("hour"))
    blocks = time_blocks(hours, names, hot_rows)
    # About one begin for ``hot_rows`` rows: broadcast, so that rows are shuffled once, for the window.
    begun = block_begins(blocks, names)
    cuts = F.broadcast(begun)
    block = block_at(F.col("_t")).alias("block")
    blocked = both.join(cuts, names, "left").select(*names, block, "_t", "_side", "_row", "_state")
    # The state that holds when a later block of a hot key begins.
    last = (
        side(set_states, since, 0, _state=state)
        .join(cuts, names)
        .select(*names, block, "_t", "_state")
        .groupBy(*names, "block")
        .agg(F.max(F.struct("_t", "_state")).alias("_last"))
    )
    numbers = begun.select(*names, F.explode(F.sequence(F.lit(1), F.size("_begins"))).alias("block"))
    every = numbers.join(last, [*names, "block"], "left")
    earlier = Window.partitionBy(*names).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select(*names, "block", F.last("_last", ignorenulls=True).over(earlier).alias("_last"))
    begins = carried.where("_last is not null").select(
        *names,
        "block",
        F.lit(None).cast("timestamp").alias("_t"),
        F.lit(0).alias("_side"),
        none_row.alias("_row"),
        F.col("_last._state").alias("_state"),
    )
    order = Window.partitionBy(*names, "block").orderBy(F.asc_nulls_first("_t"), "_side", "_state")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    valid = blocked.unionByName(begins).withColumn("_valid", F.last("_state", ignorenulls=True).over(upto))
    found = valid.where("_side = 1").select("_row.*", *[F.col("_valid")[c].alias(c) for c in values])
    unplaced = rows.where(~placed(at)).select("*", *[none_state[c].alias(c) for c in values])
    return found.unionByName(unplaced)
