"""Estimates with their errors: design-weighted panel rates, bounds of medians, the log-rank test.

The panel is a sample of repositories, drawn at another rate in each cohort, and rows of one
repository are alike; so repositories, not rows, are the units of every error here. Each is
reduced to one row before its group is, and groups to a few sums, so nothing depends on how many
rows a repository or a group has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aftermerge.operators.outcomes import MEDIAN_BUCKET, PERCENT_DIGITS, Z_95, exact_median


def panel_rate(
    rows: DataFrame, members: DataFrame, hit: Column, by: Sequence[str] = (), z: float = Z_95
) -> DataFrame:
    """Design-weighted share of rows with ``hit``, per group, with error and interval.

    ``rows`` have a ``repo``; ``members`` are those of one panel (``repo, cohort, treated_rate,
    control_rate``). A member stands for 1 / rate repositories of its cohort. The share is a ratio
    of weighted totals; its variance is that of the linearised residuals of all members, those
    without rows included, within cohorts, with the finite-population correction 1 - rate. A
    cohort of one member has no variance: the error is NULL. Names compare without case.
    """
    rate = F.when(F.col("cohort") == "treated", F.col("treated_rate")).otherwise(F.col("control_rate"))
    drawn = members.select(F.lower("repo").alias("_repo"), "cohort", rate.alias("_rate"))
    strata = drawn.groupBy("cohort").agg(F.count("*").alias("m"), F.first("_rate").alias("f"))
    per_repo = rows.groupBy(*by, F.lower("repo").alias("_repo")).agg(
        F.count("*").alias("n"), F.count_if(hit).alias("y")
    )
    sums = per_repo.join(drawn.drop("_rate"), "_repo").groupBy(*by, "cohort").agg(
        F.count("*").alias("repos"),
        F.sum("n").alias("n"),
        F.sum("y").alias("y"),
        F.sum(F.col("n") * F.col("n")).cast("double").alias("nn"),
        F.sum(F.col("n") * F.col("y")).cast("double").alias("ny"),
        F.sum(F.col("y") * F.col("y")).cast("double").alias("yy"),
    )
    # From here on a row per group and cohort.
    weighted = sums.join(strata, "cohort").withColumn("w", 1 / F.col("f"))
    group = Window.partitionBy(*([F.col(c) for c in by] or [F.lit(0)]))
    total_n = F.sum(F.col("w") * F.col("n")).over(group)
    share = F.sum(F.col("w") * F.col("y")).over(group) / total_n
    with_share = weighted.withColumns({"p": share, "total": total_n})
    p = F.col("p")
    squares = F.col("yy") - 2 * p * F.col("ny") + p * p * F.col("nn")
    mean = F.col("y") - p * F.col("n")
    spread = F.greatest(squares - mean * mean / F.col("m"), F.lit(0.0))
    scale = F.col("w") * F.col("w") * (1 - F.col("f")) * F.col("m") / (F.col("m") - 1)
    variance = F.when(F.col("m") > 1, scale * spread)
    found = with_share.withColumn("v", variance).groupBy(*by).agg(
        F.sum("repos").alias("repos"),
        F.sum("n").alias("units"),
        F.sum("y").alias("hits"),
        F.max("p").alias("p"),
        F.when(F.count("v") == F.count("*"), F.sqrt(F.sum("v")) / F.max("total")).alias("e"),
    )
    low = F.greatest(F.col("p") - z * F.col("e"), F.lit(0.0))
    high = F.least(F.col("p") + z * F.col("e"), F.lit(1.0))
    return found.select(
        *by,
        "repos",
        "units",
        "hits",
        F.round("p", PERCENT_DIGITS).alias("rate"),
        F.round("e", PERCENT_DIGITS).alias("std_error"),
        F.when(F.col("e").isNotNull(), F.round(low, PERCENT_DIGITS)).alias("ci_low"),
        F.when(F.col("e").isNotNull(), F.round(high, PERCENT_DIGITS)).alias("ci_high"),
    )


def values_at_ranks(counts: DataFrame, by: Sequence[str], ranks: DataFrame) -> DataFrame:
    """Order statistics from a histogram: ``by..., label, value``.

    ``counts`` has ``by..., _v, _n``, a row per value; ``ranks`` has ``by..., label, rank``, few per
    group, counted from 1. A coarse histogram finds the bucket of each rank; only those buckets
    are ordered value by value, so no task sees more than ``MEDIAN_BUCKET`` values of a group.
    """
    bucket = F.floor(F.col("_v") / F.lit(MEDIAN_BUCKET)).cast("bigint")
    counted = counts.select(*by, "_v", "_n", bucket.alias("_b"))
    group = [F.col(name) for name in by] or [F.lit(0)]
    upward = Window.partitionBy(*group).orderBy("_b")
    coarse = counted.groupBy(*by, "_b").agg(F.sum("_n").alias("_bn"))
    placed = coarse.withColumn("_upto", F.sum("_bn").over(upward)).withColumn(
        "_before", F.col("_upto") - F.col("_bn")
    )
    asked = ranks.select(*[F.col(c).alias(f"_r_{c}") for c in by], "label", "rank")
    inside = (F.col("rank") > F.col("_before")) & (F.col("rank") <= F.col("_upto"))
    for name in by:
        inside = inside & F.col(name).eqNullSafe(F.col(f"_r_{name}"))
    chosen = placed.join(asked, inside).select(
        *[F.col(c).alias(f"_g_{c}") for c in by], F.col("_b").alias("_c"), "_before", "label", "rank"
    )
    same = F.col("_b") == F.col("_c")
    for name in by:
        same = same & F.col(name).eqNullSafe(F.col(f"_g_{name}"))
    within = Window.partitionBy(*group, "label", "_b").orderBy("_v")
    fine = counted.join(chosen, same).withColumn("_upto", F.col("_before") + F.sum("_n").over(within))
    reached = F.min(F.when(F.col("_upto") >= F.col("rank"), F.col("_v")))
    return fine.groupBy(*by, "label").agg(reached.alias("value"))


def median_interval(
    rows: DataFrame, value: Column, by: Sequence[str] = (), cluster: str = "repo", z: float = Z_95
) -> DataFrame:
    """Exact median of a whole-number value with the bounds of its interval, per group.

    The bounds are order statistics. Their ranks lie as far from the middle as the share of rows
    at or below the median may err, taken over repositories: for rows that are no more alike
    within a repository than between them, that is the usual interval of a median, and it widens
    as they are. A group of one repository has no bounds. Names compare without case.
    """
    valued = rows.select(*by, F.lower(cluster).alias("_c"), value.cast("bigint").alias("_v")).where(
        "_v is not null"
    )
    counts = valued.groupBy(*by, "_c", "_v").agg(F.count("*").alias("_n"))
    middle = exact_median(counts, by, F.col("_v"), weight=F.col("_n"))
    renamed = middle.select(*[F.col(c).alias(f"_m_{c}") for c in by], "median")
    same = F.lit(True)
    for name in by:
        same = same & F.col(name).eqNullSafe(F.col(f"_m_{name}"))
    at_most = F.when(F.col("_v") <= F.col("median"), F.col("_n")).otherwise(0)
    # The medians are a row per group.
    per_cluster = (
        counts.join(F.broadcast(renamed), same)
        .groupBy(*by, "_c")
        .agg(F.sum("_n").alias("n"), F.sum(at_most).alias("y"), F.max("median").alias("median"))
    )
    sums = per_cluster.groupBy(*by).agg(
        F.count("*").alias("clusters"),
        F.sum("n").alias("n"),
        F.sum("y").alias("y"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("n") * F.col("y")).alias("ny"),
        F.sum(F.col("y") * F.col("y")).alias("yy"),
        F.max("median").alias("median"),
    )
    p, n = F.col("y") / F.col("n"), F.col("n")
    residual = F.greatest(F.col("yy") - 2 * p * F.col("ny") + p * p * F.col("nn"), F.lit(0.0))
    half = z * F.sqrt(residual * F.col("clusters") / (F.col("clusters") - 1))
    low = F.greatest(F.floor(n / 2 - half), F.lit(1)).cast("bigint")
    high = F.least(F.ceil(1 + n / 2 + half), n).cast("bigint")
    ranks = sums.where("clusters > 1").select(
        *by,
        F.explode(
            F.array(
                F.struct(F.lit("low").alias("label"), low.alias("rank")),
                F.struct(F.lit("high").alias("label"), high.alias("rank")),
            )
        ).alias("r"),
    ).select(*by, "r.*")
    plain = counts.groupBy(*by, "_v").agg(F.sum("_n").alias("_n"))
    bounds = values_at_ranks(plain, by, ranks).groupBy(*by).agg(
        F.max(F.when(F.col("label") == "low", F.col("value"))).alias("median_low"),
        F.max(F.when(F.col("label") == "high", F.col("value"))).alias("median_high"),
    )
    renamed = bounds.select(*[F.col(c).alias(f"_m_{c}") for c in by], "median_low", "median_high")
    joined = sums.join(renamed, same, "left")
    return joined.select(*by, "clusters", F.col("n").alias("units"), "median", "median_low", "median_high")


def stratified_logrank(outcomes: DataFrame, data_end: Column, repo: str = "repo_key") -> DataFrame:
    """Per agent: do its commits last as long as unattributed ones of the same repositories.

    The log-rank test with repositories as strata. Commits are counted per repository, agent and
    age in days; an agent's histogram meets the baseline's only in repositories that hold both,
    and numbers at risk are suffix sums over ages, so a window sees at most a row per day of
    history. ``statistic`` is chi-squared with one degree of freedom under no difference.
    """
    end = F.coalesce("reverted_at", data_end)
    age = F.greatest(F.datediff(end, F.col("at")), F.lit(0))
    counted = outcomes.groupBy(F.col(repo).alias("_repo"), "agent_id", age.alias("_age")).agg(
        F.count("reverted_at").alias("d"), F.count("*").alias("l")
    )
    own, base = counted.where("agent_id is not null"), counted.where("agent_id is null").drop("agent_id")
    cells = own.select("agent_id", "_repo").distinct()
    none = F.lit(0).cast("bigint")
    ours = own.join(base.select("_repo").distinct(), "_repo", "left_semi").select(
        "agent_id", "_repo", "_age", F.col("d").alias("d1"), F.col("l").alias("l1"), none.alias("d0"), none.alias("l0")
    )
    theirs = cells.join(base, "_repo").select(
        "agent_id", "_repo", "_age", none.alias("d1"), none.alias("l1"), F.col("d").alias("d0"), F.col("l").alias("l0")
    )
    ages = ours.unionByName(theirs).groupBy("agent_id", "_repo", "_age").agg(
        *[F.sum(c).alias(c) for c in ("d1", "l1", "d0", "l0")]
    )
    older = Window.partitionBy("agent_id", "_repo").orderBy(F.desc("_age"))
    at_risk = ages.withColumns({"n1": F.sum("l1").over(older), "n0": F.sum("l0").over(older)})
    d, n = F.col("d1") + F.col("d0"), F.col("n1") + F.col("n0")
    share = F.col("n1") / n
    variance = F.when(n > 1, d * share * (1 - share) * (n - d) / (n - 1)).otherwise(0.0)
    per_repo = at_risk.groupBy("agent_id", "_repo").agg(
        F.sum("l1").alias("l1"),
        F.sum("d1").alias("d1"),
        F.sum(d * share).alias("e1"),
        F.sum(variance).alias("v"),
    )
    found = per_repo.groupBy("agent_id").agg(
        F.count("*").alias("repos"),
        F.sum("l1").alias("commits"),
        F.sum("d1").alias("reverted"),
        F.sum("e1").alias("e"),
        F.sum("v").alias("v"),
    )
    off = F.col("reverted") - F.col("e")
    return found.select(
        "agent_id",
        "repos",
        "commits",
        "reverted",
        F.round("e", 4).alias("expected"),
        F.round("v", 4).alias("variance"),
        F.round(F.when(F.col("v") > 0, off * off / F.col("v")), 4).alias("statistic"),
    )
