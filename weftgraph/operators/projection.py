"""From monthly activity to a pruned collaboration graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import months
from ..plans.parameters import Parameters
from ..plans.tables import materialize


def monthly_scores(scores: DataFrame, p: Parameters) -> DataFrame:
    """One score per repository and month, the largest of duplicates, with the names of that row."""
    rows = scores.filter((F.col("platform") == p.platform) & (F.col("type") == "Repo") & (F.col("repo_id") != 0) & months.within(F.col("created_at"), p.start, p.end))
    best = F.struct(F.col("openrank").cast("double").alias("v"), "repo_name")
    return rows.groupBy("repo_id", months.month_of(F.col("created_at")).alias("yyyymm")).agg(
        F.max(F.col("openrank").cast("double")).alias("month_openrank"),
        F.max_by("repo_name", best).alias("repo_name"),
        F.max_by("org_login", F.struct(F.col("openrank").cast("double").alias("v"), "org_login")).alias("org_login"),
    )


def yearly_scores(monthly: DataFrame) -> DataFrame:
    name = F.struct("yyyymm", "month_openrank", "repo_name")
    return monthly.groupBy("repo_id").agg(
        F.max_by("repo_name", name).alias("repo_name"),
        F.max_by("org_login", F.struct("yyyymm", "month_openrank", "org_login")).alias("org_login"),
        F.sum("month_openrank").alias("openrank_sum"),
        F.avg("month_openrank").alias("openrank_avg"),
        F.max("month_openrank").alias("openrank_max"),
        F.count("yyyymm").cast("int").alias("months_present"),
    )


def latest_info(info: DataFrame, platform: str) -> DataFrame:
    """The latest version of each repository's metadata: all fields from one version, in a total order."""
    version = F.struct("updated_at", "isFork", "status", "primary_language", "description", F.to_json("topics").alias("t"))
    kept = F.struct("status", F.col("isFork").alias("is_fork"), "primary_language", "topics", "description")
    return info.filter(F.col("platform") == platform).groupBy("id").agg(F.max_by(kept, version).alias("v")).select("id", "v.*")


def top_repos(yearly: DataFrame, latest: DataFrame, p: Parameters) -> DataFrame:
    """The repositories of greatest yearly score that are not known to be forks."""
    known = latest.select(F.col("id").alias("repo_id"), "is_fork")
    return yearly.join(known, "repo_id", "left").filter(F.col("is_fork").isNull() | (F.col("is_fork") == 0)).drop("is_fork").orderBy(F.desc("openrank_sum"), "repo_id").limit(p.top_repos)


def contributions(rows: DataFrame, p: Parameters) -> DataFrame:
    """The window's rows with an actor. Where the source has a date (created_at), the window is
    a range of it too, which reaches the scan; a month number that is computed does not."""
    held = (F.col("platform") == p.platform) & F.col("yyyymm").between(p.start, p.end) & (F.col("actor_id") != 0)
    if "created_at" in rows.columns:
        held &= months.within(F.col("created_at"), p.start, p.end)
    return rows.filter(held)


def monthly_contributions(rows: DataFrame, p: Parameters) -> DataFrame:
    """(repository, actor, month, v, repo_name): duplicates of a month give their largest value, and its name."""
    value = F.col("openrank").cast("double")
    return contributions(rows, p).groupBy("repo_id", "actor_id", "yyyymm").agg(F.max(value).alias("v"), F.max_by("repo_name", F.struct(value.alias("v"), "repo_name")).alias("repo_name"))


def actor_degrees(monthly: DataFrame, p: Parameters) -> DataFrame:
    """Actors of 2 up to the cap of repositories in the window, counted on all of them."""
    pairs = monthly.select("actor_id", "repo_id").distinct()
    return pairs.groupBy("actor_id").agg(F.count("repo_id").alias("degree")).filter(F.col("degree").between(2, p.max_actor_degree))


def actor_repos(monthly: DataFrame, degrees: DataFrame, top: DataFrame) -> DataFrame:
    """(actor, repository, contribution > 0): months add up."""
    held = monthly.join(degrees.select("actor_id"), "actor_id", "left_semi").join(top.select("repo_id"), "repo_id", "left_semi")
    return held.groupBy("actor_id", "repo_id").agg(F.sum("v").alias("contribution")).filter("contribution > 0")


def pair_rows(bipartite: DataFrame, degrees: DataFrame) -> DataFrame:
    """A row per actor and unordered pair of their repositories, weighing 2 / (d (d - 1)).

    Each actor's repositories stay together as one sorted array of at most the degree
    cap's length, so the pairs come from the array where it lies, without a self-join."""
    bundles = bipartite.groupBy("actor_id").agg(F.array_sort(F.collect_list(F.struct("repo_id", "contribution"))).alias("repos")).filter(F.size("repos") >= 2)
    first = bundles.join(degrees, "actor_id").select("actor_id", "repos", F.col("degree").cast("double").alias("d"), F.posexplode("repos").alias("i", "a"))
    pairs = first.select("actor_id", "d", "a", F.explode(F.expr("slice(repos, i + 2, size(repos))")).alias("b"))
    return pairs.select(
        "actor_id", F.col("a.repo_id").alias("source"), F.col("b.repo_id").alias("target"),
        F.col("a.contribution").alias("source_contribution"), F.col("b.contribution").alias("target_contribution"),
        (2.0 / (F.col("d") * (F.col("d") - 1))).alias("actor_weight"),
    )


def edges(pairs: DataFrame, min_shared: int, digits: int = 8) -> DataFrame:
    return pairs.groupBy("source", "target").agg(
        F.round(F.sum("actor_weight"), 8).alias("weight"),
        F.count(F.lit(1)).alias("shared_contributors"),
        F.round(F.sum(F.col("actor_weight") * F.sqrt(F.col("source_contribution") * F.col("target_contribution"))), digits).alias("collaboration_strength"),
    ).filter(F.col("shared_contributors") >= min_shared)


def incident(graph: DataFrame) -> DataFrame:
    """Each edge from either end: node, neighbour and the metrics."""
    ends = F.explode(F.array(F.struct(F.col("source").alias("node"), F.col("target").alias("neighbor")), F.struct(F.col("target").alias("node"), F.col("source").alias("neighbor"))))
    return graph.select(ends.alias("e"), "weight", "shared_contributors", "collaboration_strength").select("e.*", "weight", "shared_contributors", "collaboration_strength")


def prune(graph: DataFrame, most: int) -> DataFrame:
    """Edges that one end at least ranks among its strongest ``most``."""
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("weight"), F.desc("shared_contributors"), "neighbor"))
    named = incident(graph).withColumn("rank", rank).filter(F.col("rank") <= most)
    return named.groupBy(F.least("node", "neighbor").alias("source"), F.greatest("node", "neighbor").alias("target")).agg(*(F.max(c).alias(c) for c in ("weight", "shared_contributors", "collaboration_strength")))


def name_edges(graph: DataFrame, platform: str) -> DataFrame:
    def full(c: str):
        return F.concat(F.lit(f"{platform}:"), F.col(c).cast("string")).alias(c)

    return graph.select(full("source"), full("target"), "weight", "shared_contributors", "collaboration_strength")


def contribution_stats(monthly: DataFrame, top: DataFrame) -> DataFrame:
    held = monthly.join(top.select("repo_id"), "repo_id", "left_semi")
    return held.groupBy("repo_id").agg(F.max_by("repo_name", F.struct("yyyymm", "v", "repo_name")).alias("stats_name"), F.countDistinct("actor_id").alias("contributors"), F.sum("v").alias("normalized_contribution"))


def nodes(top: DataFrame, stats: DataFrame, latest: DataFrame, platform: str, digits: int = 6) -> DataFrame:
    """Node candidates: scores, contribution totals and metadata; what is missing has the type's default."""
    info = latest.withColumnRenamed("id", "repo_id").withColumn("known", F.lit(1))
    j = top.join(stats, "repo_id", "left").join(info, "repo_id", "left")
    name = F.coalesce(F.nullif("repo_name", F.lit("")), "stats_name", F.lit(""))
    return j.select(
        F.concat(F.lit(f"{platform}:"), F.col("repo_id").cast("string")).alias("id"), name.alias("name"), F.lit(platform).alias("platform"), "repo_id",
        *(F.round(c, digits).alias(c) for c in ("openrank_sum", "openrank_avg", "openrank_max")), "months_present",
        F.coalesce("contributors", F.lit(0)).alias("contributors"),
        F.round(F.coalesce("normalized_contribution", F.lit(0.0)), digits).alias("normalized_contribution"),
        F.coalesce(F.nullif("primary_language", F.lit("")), F.lit("Unknown")).alias("primary_language"),
        F.coalesce(F.array_join(F.slice("topics", 1, 12), "|"), F.lit("")).alias("topics"),
        F.coalesce(F.regexp_replace(F.substring("description", 1, 300), "[\\r\\n\\t]+", " "), F.lit("")).alias("description"),
        F.when(F.col("known").isNull(), "missing").otherwise(F.col("status").cast("string")).alias("metadata_status"),
        F.concat(F.lit("https://github.com/"), name).alias("url") if platform == "GitHub" else F.lit("").alias("url"),
    )


def with_labels(candidates: DataFrame, graph: DataFrame, labels: int) -> DataFrame:
    """The candidates that edges touch; the strongest of them carry their name as label."""
    ends = graph.select(F.explode(F.array("source", "target")).alias("id")).distinct()
    kept = candidates.join(ends, "id", "left_semi")
    shown = kept.orderBy(F.desc("openrank_sum"), "repo_id").limit(labels).select("id", F.col("name").alias("display_label"))
    return kept.join(shown, "id", "left").withColumn("display_label", F.coalesce("display_label", F.lit("")))


def guard_rows(df: DataFrame, most: int) -> DataFrame:
    """The result, written once; fails if it has more rows than allowed."""
    out = materialize(df, "guarded")
    if (n := out.count()) > most:
        raise ValueError(f"the result has {n} rows, more than {most}")
    return out
