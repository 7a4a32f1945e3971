"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions.

The ring has ``CELLS`` equal cells. A shard owns the cells from its virtual nodes back to the
node before; a document lies in the cell that its key hashes to. Every shard has a capacity, and
the capacities add up to the number of documents and differ by one at most, so the row counts do
too. Within a shard the earlier documents of a cell stay; those that find it full continue
clockwise to the next cell whose owner has room. A new shard takes cells over from its
neighbours and leaves the other cells' owners alone, so few documents move.

Only counts per cell (``CELLS`` rows at most, whatever the input) reach the driver. Ranks come
from counts per cell and source partition and a row number within each of those, so that not
even a third of all rows with one key meets in one task.

Defined cases: a null text has size 1 and checksum 0; a null doc_id is a key like any other;
repeated rows get slots of their own; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aftermerge.llm.common import stage

#: Cells of the ring and virtual nodes of a shard.
CELLS = 4096
NODES = 64


def ring_owners(shards: int, nodes: int = NODES, cells: int = CELLS) -> list[int]:
    """The owner of each cell: the shard of the first virtual node at or after it, clockwise."""
    at: dict[int, int] = {}
    for shard in range(shards):
        for node in range(nodes):
            digest = hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest()
            at.setdefault(int.from_bytes(digest, "big") % cells, shard)
    owners, owner = [0] * cells, at[min(at)]
    for cell in reversed(range(cells)):
        owner = owners[cell] = at.get(cell, owner)
    return owners


def fill_clockwise(
    counts: dict[int, int], owners: list[int], shards: int
) -> list[tuple[int, int, int, int, int]]:
    """Which ranks of a cell go to which shard: (cell, from rank, to rank, shard, first slot)."""
    total = sum(counts.values())
    room = [total // shards + (shard < total % shards) for shard in range(shards)]
    used = [0] * shards
    spans: list[tuple[int, int, int, int, int]] = []

    def give(cell: int, done: int, shard: int) -> int:
        take = min(counts[cell] - done, room[shard] - used[shard])
        if take > 0:
            spans.append((cell, done, done + take, shard, used[shard]))
            used[shard] += take
        return done + max(take, 0)

    stayed = {cell: give(cell, 0, owners[cell]) for cell in sorted(counts)}
    for cell, done in stayed.items():
        step = cell
        while done < counts[cell]:
            step = (step + 1) % len(owners)
            done = give(cell, done, owners[step])
    return spans


def assign_shards(docs: DataFrame, shards: int = 8, nodes: int = NODES) -> DataFrame:
    """Per document its shard and its slot there: counts at most one apart, slots gapless from 0."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.pmod(F.xxhash64("doc_id"), F.lit(CELLS)).cast("int").alias("cell"),
            F.monotonically_increasing_id().alias("rid"),
        ).withColumn("part", F.shiftrightunsigned("rid", 33)),
        "shards",
    )
    parts = rows.groupBy("cell", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "cell", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    counts = {r["cell"]: r["n"] for r in parts.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    spans = fill_clockwise(counts, ring_owners(shards, nodes), shards)
    # At most a span per cell and one more per shard: bounded by the ring, not by the input.
    values = ", ".join(map(str, spans)) or "(0, 0, 0, 0, 0)"
    table = spark.sql(
        "SELECT int(col1) cell, bigint(col2) low, bigint(col3) high, int(col4) shard,"
        f" bigint(col5) base FROM VALUES {values}"
    )
    within = Window.partitionBy("cell", "part").orderBy("rid")
    return (
        rows.withColumn("at", F.row_number().over(within) - 1)
        .join(offsets, ["cell", "part"])
        .withColumn("rank", F.col("earlier") + F.col("at"))
        .join(F.broadcast(table), "cell")
        .where("rank >= low AND rank < high")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("base") + F.col("rank") - F.col("low")).alias("slot"),
        )
    )
