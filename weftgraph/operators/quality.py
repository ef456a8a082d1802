"""Data-quality gates: each measures in one pass and a verdict raises on what is wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import months
from ..plans.parameters import DUPLICATE_LIMIT, Parameters
from ..plans.ranking import quantiles


class QualityError(ValueError):
    pass


def uniqueness(rows: DataFrame, keys: list[Column], value: str) -> DataFrame:
    """Rows, distinct keys and keys of several values. Null keys count as keys."""
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.col(value).cast("double")).alias("values"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("values") > 1).alias("n_conflicts"))


def source_uniqueness(scores: DataFrame, rows: DataFrame, top: DataFrame, p: Parameters) -> DataFrame:
    ids = top.select("repo_id")
    s = scores.filter((F.col("platform") == p.platform) & (F.col("type") == "Repo") & months.within(F.col("created_at"), p.start, p.end)).join(ids, "repo_id", "left_semi")
    r = rows.filter((F.col("platform") == p.platform) & F.col("yyyymm").between(p.start, p.end)).join(ids, "repo_id", "left_semi")
    a = uniqueness(s, [F.col("repo_id"), months.month_of(F.col("created_at")).alias("yyyymm")], "openrank").select(F.lit("scores").alias("source"), "*")
    return a.unionByName(uniqueness(r, [F.col("repo_id"), F.col("actor_id"), F.col("yyyymm")], "openrank").select(F.lit("contributions").alias("source"), "*"))


def duplicate_verdict(n_rows: int, n_keys: int, n_conflicts: int, limit: float = DUPLICATE_LIMIT) -> dict:
    """Fails if counts contradict each other or the share of duplicates is above the limit."""
    if n_rows <= 0 or not 0 < n_keys <= n_rows or not 0 <= n_conflicts <= n_keys:
        raise QualityError(f"impossible counts: {n_rows} rows, {n_keys} keys, {n_conflicts} conflicts")
    ratio = (n_rows - n_keys) / n_rows
    if ratio > limit:
        raise QualityError(f"{ratio:.2%} of rows are duplicates")
    return {"rows": n_rows, "unique": n_keys, "duplicates": n_rows - n_keys, "ratio": ratio, "conflicts": n_conflicts}


def freshness(scores: DataFrame, rows: DataFrame, platform: str, today) -> DataFrame:
    """Latest month of either source and the last complete month before ``today``."""
    a = scores.filter((F.col("platform") == platform) & (F.col("type") == "Repo")).agg(F.max(months.month_of(F.col("created_at"))).alias("scores_latest"))
    b = rows.filter(F.col("platform") == platform).agg(F.max("yyyymm").alias("contributions_latest"))
    last = months.shifted(F.lit(today.year * 100 + today.month), -1)
    return a.join(b).select("contributions_latest", "scores_latest", last.alias("previous_complete"), F.least("contributions_latest", "scores_latest", last).alias("usable"))


def end_month(usable: int, wanted: int | None) -> int:
    if wanted is not None and wanted > usable:
        raise QualityError(f"{wanted} is not complete yet; the latest usable month is {usable}")
    return wanted or usable


def missing_months(scores: DataFrame, rows: DataFrame, p: Parameters) -> DataFrame:
    """(source, yyyymm) of the window's months that a source has nothing in."""
    spark = scores.sparkSession
    n = (p.end // 100 - p.start // 100) * 12 + p.end % 100 - p.start % 100 + 1
    want = spark.range(n).select(months.shifted(F.lit(p.start), F.col("id")).alias("yyyymm"))
    a = scores.filter((F.col("platform") == p.platform) & (F.col("type") == "Repo") & months.within(F.col("created_at"), p.start, p.end)).select(months.month_of(F.col("created_at")).alias("yyyymm"))
    b = rows.filter((F.col("platform") == p.platform) & F.col("yyyymm").between(p.start, p.end)).select("yyyymm")
    out = None
    for name, there in (("scores", a), ("contributions", b)):
        gone = want.join(there.distinct(), "yyyymm", "left_anti").select(F.lit(name).alias("source"), "yyyymm")
        out = gone if out is None else out.unionByName(gone)
    return out


def month_list(scores: DataFrame) -> DataFrame:
    """The months present, as one sorted text."""
    m = months.month_of(F.col("created_at")).cast("string")
    return scores.agg(F.array_join(F.array_sort(F.collect_set(m)), ",").alias("months"))


def edge_counters(edges: DataFrame, platform: str, min_shared: int) -> DataFrame:
    """What is wrong with edges, and the spread of their metrics, as one row."""
    number = {c: F.regexp_extract(c, rf"^{platform}:(\d+)$", 1).try_cast("long") for c in ("source", "target")}
    e = edges.select("*", number["source"].alias("s"), number["target"].alias("t"))
    bad_number = F.col("weight").isNull() | F.isnan("weight") | (F.abs("weight") == float("inf")) | F.isnan("collaboration_strength") | (F.abs("collaboration_strength") == float("inf"))
    again = e.groupBy("source", "target").agg(F.count(F.lit(1)).alias("n"))
    doubled = again.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
    whole = e.agg(
        F.count(F.lit(1)).alias("n_edges"),
        F.count_if(F.col("s").isNull() | F.col("t").isNull()).alias("bad_ids"),
        F.count_if(F.col("s") == F.col("t")).alias("self_loops"),
        F.count_if(F.col("s") > F.col("t")).alias("misordered"),
        F.count_if(bad_number).alias("not_finite"),
        F.count_if(~bad_number & ((F.col("weight") <= 0) | (F.col("collaboration_strength") <= 0))).alias("not_positive"),
        F.count_if(F.col("shared_contributors") < min_shared).alias("too_few_shared"),
        F.min("weight").alias("weight_min"), F.max("weight").alias("weight_max"),
        F.max("shared_contributors").alias("shared_max"),
    )
    weight = quantiles(e, "weight", {"weight_p50": 0.5, "weight_p90": 0.9, "weight_p99": 0.99})
    shared = quantiles(e, "shared_contributors", {"shared_p50": 0.5, "shared_p90": 0.9, "shared_p99": 0.99})
    return whole.join(doubled).join(weight).join(shared)


FAULTS = ("bad_ids", "self_loops", "misordered", "not_finite", "not_positive", "too_few_shared", "duplicates")


def edge_verdict(counters) -> None:
    row = counters.asDict()
    wrong = {k: row[k] for k in FAULTS if row.get(k)}
    if wrong or not row["n_edges"]:
        raise QualityError(f"edges fail: {wrong or 'there are none'}")


def node_counters(nodes: DataFrame, edges: DataFrame, labels: int) -> DataFrame:
    """Identity, range and coverage counters of nodes, and their agreement with edge endpoints."""
    ends = edges.select(F.explode(F.array("source", "target")).alias("id")).distinct()
    ids = nodes.select("id")
    n = F.count(F.lit(1))
    rel = F.abs(F.col("openrank_sum") - F.col("openrank_avg") * F.col("months_present")) / F.greatest(F.col("openrank_sum"), F.lit(1e-9))
    bad = [F.col(c).isNull() | F.isnan(c) | (F.col(c) < 0) for c in ("openrank_sum", "openrank_avg", "openrank_max", "normalized_contribution")]
    whole = nodes.agg(
        n.alias("n_nodes"), (n - F.countDistinct("id")).alias("duplicates"),
        F.count_if(F.col("id") != F.concat_ws(":", "platform", F.col("repo_id").cast("string"))).alias("bad_identity"),
        F.count_if(bad[0] | bad[1] | bad[2] | bad[3]).alias("bad_numbers"),
        F.count_if((F.col("months_present") < 1) | (F.col("months_present") > 12)).alias("bad_months"),
        F.count_if(F.col("metadata_status") == "missing").alias("no_metadata"),
        F.round(F.count_if(F.col("primary_language") != "Unknown") / n, 6).alias("language_share"),
        F.round(F.count_if(F.col("topics") != "") / n, 6).alias("topics_share"),
        F.round(F.count_if(F.col("description") != "") / n, 6).alias("description_share"),
        F.round(F.max(rel), 6).alias("sum_error_max"),
        (F.count_if(F.col("display_label") != "") > labels).alias("too_many_labels"),
    )
    return whole.join(ends.join(ids, "id", "left_anti").agg(n.alias("ends_without_node"))).join(ids.join(ends, "id", "left_anti").agg(n.alias("nodes_without_edge")))


def node_verdict(counters) -> None:
    row = counters.asDict()
    wrong = {k: row[k] for k in ("duplicates", "bad_identity", "bad_numbers", "bad_months", "too_many_labels", "ends_without_node", "nodes_without_edge") if row.get(k)}
    if wrong or not row["n_nodes"]:
        raise QualityError(f"nodes fail: {wrong or 'there are none'}")


def reconcile(counts: dict[str, tuple[int, int]]) -> None:
    """Fails if two outputs disagree on a number of rows."""
    wrong = {k: v for k, v in counts.items() if v[0] != v[1]}
    if wrong:
        raise QualityError(f"outputs disagree: {wrong}")
