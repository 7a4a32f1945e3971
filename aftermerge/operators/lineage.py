"""Repository identity through renames: which repository a name meant on which day.

A fetch asks for a repository by name and reports the name and the number it has now. Names move:
repositories are renamed once or again, swap names, or leave a name that another takes later.
So a name is cut into *tenures*, stretches of days in which it answered with one number. Tenures
and numbers are the vertices of a graph, tied where a fetch saw them together, and its connected
components are the repositories.

The stored table holds only names that need it: a repository that always had one name, which no
other ever had, keeps that name as its key and costs nothing at use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aftermerge.operators.components import Keep, connected
from aftermerge.operators.joins import HOT_ROWS, lookup_join

LINEAGE_COLUMNS = "name valid_from valid_to repo_key repo_id".split()


def sightings(activity: DataFrame) -> DataFrame:
    """What fetches saw, from parsed or stored snapshots with ``fetched_on``: ``asked``,
    ``reported``, ``repo_id``, ``seen_on``. Fetches that were not answered saw nothing."""
    answered = activity.where(F.col("name_with_owner").isNotNull() | F.col("repo_id").isNotNull())
    asked = F.lower("repo")
    return answered.select(
        asked.alias("asked"),
        F.coalesce(F.lower("name_with_owner"), asked).alias("reported"),
        "repo_id",
        F.col("fetched_on").alias("seen_on"),
    )


def name_days(seen: DataFrame) -> DataFrame:
    """One row per name and day with its number, if any, and the tenure it falls into.

    A name can be seen under its own and under older names; the fetch that asked for it decides,
    then the least number. A day without a number belongs to the tenure it lies in, one before
    any number to the first. Tenures are counted per name from 0.
    """
    day = F.col("seen_on")
    own = seen.select(F.col("asked").alias("name"), day, "repo_id", F.lit(0).alias("w"))
    told = seen.select(F.col("reported").alias("name"), day, "repo_id", F.lit(1).alias("w"))
    named = F.when(F.col("repo_id").isNotNull(), F.struct("w", "repo_id"))
    days = own.unionByName(told).groupBy("name", "seen_on").agg(F.min(named)["repo_id"].alias("repo_id"))
    by_name = Window.partitionBy("name").orderBy("seen_on")
    last = F.last("repo_id", ignorenulls=True).over(by_name.rowsBetween(Window.unboundedPreceding, -1))
    changed = (F.col("repo_id") != last).cast("int")
    return days.withColumn("tenure", F.sum(F.coalesce(changed, F.lit(0))).over(by_name).cast("int"))


def canonical_repos(seen: DataFrame, keep: Keep) -> DataFrame:
    """Which repository each name meant: ``name``, ``valid_from``, ``valid_to``, ``repo_key``, ``repo_id``.

    The first day is inclusive, the last exclusive; NULL means without bound, so the rows of a
    name cover all days once. ``repo_key`` is the same for all names of a repository: ``#`` and
    its least number, or, where no fetch told one, ``~`` and its least name. Names that need no
    row are left out (see the module).
    """
    days = keep(name_days(seen), "name_days")
    tenures = days.groupBy("name", "tenure").agg(
        F.min("seen_on").alias("seen_from"), F.max("repo_id").alias("repo_id")
    )
    tenures = keep(tenures.withColumn("vertex", _tenure(F.col("name"), F.col("tenure"))), "tenures")
    number = F.concat(F.lit("#"), F.lpad(F.col("repo_id").cast("string"), 20, "0"))
    by_number = tenures.select(F.col("vertex").alias("a"), F.coalesce(number, "vertex").alias("b"))
    # A fetch that told no number still ties the name asked for to the one reported.
    moved = seen.where("asked <> reported and repo_id is null").select("asked", "reported", "seen_on").distinct()
    at = days.select("name", "seen_on", _tenure(F.col("name"), F.col("tenure")).alias("vertex"))
    by_name = (
        moved.join(at.select(F.col("name").alias("asked"), "seen_on", F.col("vertex").alias("a")), ["asked", "seen_on"])
        .join(at.select(F.col("name").alias("reported"), "seen_on", F.col("vertex").alias("b")), ["reported", "seen_on"])
        .select("a", "b")
    )
    least = connected(by_number.unionByName(by_name), keep)
    placed = tenures.join(least, "vertex")
    # Numbers sort before tenures, so a component's least vertex is its least number.
    names = placed.groupBy("least").agg(F.min("name").alias("one"), F.max("name").alias("other"))
    reused = placed.groupBy("name").agg(F.max("tenure").alias("last_tenure"))
    upcoming = F.lead("seen_from").over(Window.partitionBy("name").orderBy("tenure"))
    is_number = F.startswith("least", F.lit("#"))
    repo_id = F.when(is_number, F.substring("least", 2, 20).cast("bigint"))
    spans = placed.withColumn("valid_to", upcoming)
    needed = (F.col("one") != F.col("other")) | (F.col("last_tenure") > 0)
    return (
        spans.join(names, "least")
        .join(reused, "name")
        .where(needed)
        .select(
            "name",
            F.when(F.col("tenure") > 0, F.col("seen_from")).alias("valid_from"),
            "valid_to",
            F.when(is_number, F.concat(F.lit("#"), repo_id)).otherwise(F.col("least")).alias("repo_key"),
            repo_id.alias("repo_id"),
        )
    )


def _tenure(name: Column, tenure: Column) -> Column:
    return F.concat(F.lit("~"), name, F.lit("@"), tenure)


def with_repo_key(
    rows: DataFrame, lineage: DataFrame | None, repo: str = "repo", at: str = "at", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``repo_key``: the repository that the name meant at the row's time.

    Without a ``lineage``, and for names it doesn't hold, that is the lower-cased name. A name
    has few rows there, which cover all days once, so a row meets them by the name and keeps one;
    rows of a hot name are split over many tasks (:func:`lookup_join`).
    """
    key = F.lower(F.col(repo))
    if lineage is None:
        return rows.withColumn("repo_key", key)
    spans = lineage.select(
        F.col("name").alias("_name"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        F.col("repo_key").alias("_key"),
    )
    met = lookup_join(rows.withColumn("_name", key), spans, ["_name"], "left", hot_rows)
    day = F.col(at).cast("date")
    inside = (F.col("_from").isNull() | (day >= F.col("_from"))) & (F.col("_to").isNull() | (day < F.col("_to")))
    # A row without a day can't be placed: it takes the name's first tenure.
    kept = met.where(F.coalesce(inside, F.col("_from").isNull()))
    return kept.withColumn("repo_key", F.coalesce("_key", "_name")).drop("_name", "_from", "_to", "_key")
