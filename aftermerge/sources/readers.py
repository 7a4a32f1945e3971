"""Scans. Every reader passes an explicit schema; partition and type filters reach the files."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aftermerge.operators.census import day_status
from aftermerge.operators.panel import panel_problems
from aftermerge.operators.rules import RuleError, rules_frame, rules_from_mapping
from aftermerge.schemas import (
    CENSUS,
    PANEL_COMMITS,
    PANEL_MEMBERS,
    PANEL_PULLS,
    PANEL_REPOS,
    PUSH_EVENTS,
    RESPONSES,
    columns,
)

try:
    import yaml
except ImportError:  # YAML rule files then need converting to JSON first
    yaml = None  # type: ignore[assignment]


def read_events(
    spark: SparkSession,
    path: str,
    days: Iterable[dt.date] | None = None,
    *,
    file_format: str = "parquet",
) -> DataFrame:
    """Push events of the given UTC days (all days when ``None``) from a ``day=`` archive.

    The day list prunes partitions and the event type is pushed to the files. Any archive day
    can be read this way; what a push lists of its commits depends on the day.
    """
    events = spark.read.schema(PUSH_EVENTS).format(file_format).load(path)
    if days is not None:
        events = events.where(F.col("day").isin(sorted(set(days))))
    return events.where(F.col("type") == "PushEvent")


def read_push_events(
    spark: SparkSession,
    path: str,
    days: Iterable[dt.date] | None = None,
    *,
    file_format: str = "parquet",
) -> DataFrame:
    """The same for days whose pushes list their commits; others are left out, see
    :func:`skipped_days`, and so are rows without a day.
    """
    events = read_events(spark, path, days, file_format=file_format)
    return events.where(F.col("day").isNotNull() & (day_status(F.col("day")) == "ok"))


def skipped_days(spark: SparkSession, days: Iterable[dt.date]) -> DataFrame:
    """Requested days that cannot be read, with the reason."""
    asked = spark.createDataFrame([(d,) for d in sorted(set(days))], "day date")
    return asked.withColumn("status", day_status(F.col("day"))).where("status <> 'ok'")


def read_observations(
    spark: SparkSession, root: str, *, registry_version: int | None = None
) -> DataFrame:
    """All census days under ``root``, of one rule version or all; an empty sink reads as an empty
    table. The version prunes partitions."""
    stored = spark.read.schema(CENSUS).parquet(root).select(*columns(CENSUS))
    return stored if registry_version is None else stored.where(F.col("registry_version") == registry_version)


def read_panel_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One of the panel tables ``repos``, ``commits``, ``pulls`` over all fetches."""
    schema = {"repos": PANEL_REPOS, "commits": PANEL_COMMITS, "pulls": PANEL_PULLS}[table]
    return spark.read.schema(schema).parquet(f"{root}/{table}").select(*columns(schema))


def read_responses(spark: SparkSession, path: str, *, file_format: str = "json") -> DataFrame:
    """Landed API responses."""
    return spark.read.schema(RESPONSES).format(file_format).load(path)


def read_members(spark: SparkSession, path: str, *, version: int | None = None) -> DataFrame:
    """A stored panel, one version or all; partitioned by ``panel_version``."""
    members = spark.read.schema(PANEL_MEMBERS).parquet(path)
    return members if version is None else members.where(F.col("panel_version") == version)


def check_members(members: DataFrame) -> DataFrame:
    """The panel itself, or ``ValueError`` with its first problems."""
    bad = panel_problems(members).limit(20).collect()
    if bad:
        listed = "; ".join(f"{r['repo']}: {r['problem']}" for r in bad)
        raise ValueError(f"invalid panel: {listed}")
    return members


def parse_rules(text: str, *, name: str = "rules") -> list[dict[str, Any]]:
    """Rule rows from a YAML or JSON document ``{version, agents: [...]}``."""
    try:
        document = json.loads(text) if yaml is None else yaml.safe_load(text)
    except Exception as error:
        raise RuleError(f"{name} is not valid: {error}") from error
    if not isinstance(document, Mapping):
        raise RuleError(f"{name}: top level must be a mapping")
    return rules_from_mapping(document)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule table from a YAML or JSON file on any file system Spark can read."""
    found = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(found) != 1:
        raise RuleError(f"expected one rule file at {path}, found {len(found)}")
    return rules_frame(spark, parse_rules(found[0]["value"], name=path))


def scan_budget(
    spark: SparkSession,
    path: str,
    ceiling_bytes: int,
    *,
    days: Sequence[dt.date] = (),
    glob: str = "*.parquet",
) -> DataFrame:
    """Bytes per ``day`` partition and whether a scan of the day stays within the ceiling.

    Only file names and lengths are read, with ``days`` those of their folders alone. An estimate
    equal to the ceiling passes; a day without a folder has no row.
    """
    folders = f"{path}/day={{{','.join(d.isoformat() for d in days)}}}" if days else path
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folders)
        .select("path", "length")
    )
    day = F.nullif(F.regexp_extract("path", r"/day=([^/]+)/", 1), F.lit(""))
    sized = listed.groupBy(day.alias("day")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )
    return sized.withColumns(
        {
            "gib": F.round(F.col("bytes") / F.lit(1024**3), 6),
            "within_budget": F.col("bytes") <= F.lit(ceiling_bytes),
        }
    )
