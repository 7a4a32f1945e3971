"""Sinks: versioned Parquet partitions, manifests and staged intermediates.

History is append-only: a partition is identified by what produced it (day or fetch, rule
version, method version), so a rerun under new rules adds partitions and a rerun under the
same ones replaces exactly its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from typing import Any
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

CENSUS_PARTITIONS = ("day", "registry_version", "methodology_version")
SNAPSHOT_PARTITIONS = ("fetched_on", "panel_version")
PANEL_PARTITIONS = ("fetched_on", "panel_version", "registry_version", "methodology_version")


def write_partitions(df: DataFrame, path: str, partitions: Sequence[str], *, spread: bool = False) -> None:
    """Replace the partitions present in ``df`` under ``path``; all others stay.

    Rows are rebalanced by partition first: small partitions end up in one file and a large
    one is split over many tasks, so neither tiny files nor a giant writer arise. Rows that are
    ``spread``, a few large partitions over many tasks, are written where they are instead.
    """
    (
        (df if spread else df.hint("rebalance", *partitions))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partitions)
        .parquet(path)
    )


CENSUS_ORDER = ("pushed_at", "event_id", "sha")


def in_ranges(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Deal rows out by ranges of ``order``, for a later :func:`write_ordered`.

    Range bounds are drawn from a sample, which computes ``df`` once more: give it a stored table,
    and derive dear columns afterwards. Spark joins small ranges unless ``parts`` are asked for.
    """
    return df.repartitionByRange(*order) if parts is None else df.repartitionByRange(parts, *order)


def write_ordered(df: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str]) -> None:
    """Like :func:`write_partitions` for rows dealt out by ranges of the partition and ``order``.

    Files are sorted and hold disjoint ranges, in the order of their names, so a reader of a range
    skips whole files and row groups by their statistics. Times are written as 64-bit integers:
    the older form that a session may still write has no statistics.
    """
    conf, kind = df.sparkSession.conf, "spark.sql.parquet.outputTimestampType"
    before = conf.get(kind)
    conf.set(kind, "TIMESTAMP_MICROS")
    try:
        (
            df.sortWithinPartitions(*partitions, *order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(*partitions)
            .parquet(path)
        )
    finally:
        conf.set(kind, before)


def clear_absent(
    df: DataFrame, path: str, partitions: Sequence[str], requested: Iterable[Sequence[Any]]
) -> None:
    """Leave an empty file in each ``requested`` partition that ``df`` has no row for.

    ``requested`` lists partition values, as many as a job was asked for; a dynamic overwrite
    would keep the old rows there.
    """
    present = {tuple(map(str, r)) for r in df.select(*partitions).distinct().collect()}
    missing = [values for values in requested if tuple(map(str, values)) not in present]
    clear_partitions(df, path, partitions, missing)


def clear_partitions(
    df: DataFrame, path: str, partitions: Sequence[str], values: Iterable[Sequence[Any]]
) -> None:
    """Leave an empty file with ``df``'s columns in each of these partitions."""
    nothing = df.sparkSession.createDataFrame([], df.drop(*partitions).schema)
    for one in values:
        parts = (f"{k}={quote(str(v))}" for k, v in zip(partitions, one, strict=True))
        nothing.write.mode("overwrite").parquet("/".join([path, *parts]))


def write_json(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Manifests: one small JSON line per partition, replaced like the data."""
    (
        df.repartition(1, *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy(*partitions)
        .json(path)
    )


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder every executor can reach, below the one named in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root}/aftermerge-{uuid.uuid4().hex}"


def staging_folder(out: str) -> str:
    """A fresh folder for a job's intermediate tables, below its own output root."""
    return f"{out}/_staging/{uuid.uuid4().hex}"


def stage(df: DataFrame, folder: str, name: str, partitions: Sequence[str] = ()) -> DataFrame:
    """Write an intermediate once and read it back: cuts lineage and survives lost executors.

    Columnar, so a later pass over a few narrow columns reads only those.
    """
    path = f"{folder}/{name}"
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
