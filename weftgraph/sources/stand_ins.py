"""The graph pipeline's source tables, as views over the star schema that tests have.

Suppliers stand for repositories, customers for actors, lineitems for monthly activity
and metadata versions, parts for topics; hub items are customers (models), parts
(datasets) and suppliers (spaces).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import month_of

PLATFORM = "TPCH"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "orders", "supplier", "nation")}
    lines = t["lineitem"].select("l_orderkey", "l_suppkey", "l_extendedprice")
    return (
        lines.join(t["orders"].select("o_orderkey", "o_custkey", "o_orderdate"), lines["l_orderkey"] == F.col("o_orderkey"))
        .join(t["supplier"].select("s_suppkey", "s_name", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t["nation"].select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _activity(spark, sf_dir).select(
        F.lit(PLATFORM).alias("platform"), F.lit("Repo").alias("type"), F.col("o_orderdate").alias("created_at"), F.col("l_suppkey").alias("repo_id"),
        (F.col("l_extendedprice") / 1000).alias("openrank"), F.col("s_name").alias("repo_name"), F.col("n_name").alias("org_login"),
    )


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _activity(spark, sf_dir).select(
        F.lit(PLATFORM).alias("platform"), F.col("o_orderdate").alias("created_at"), month_of(F.col("o_orderdate")).alias("yyyymm"), F.col("l_suppkey").alias("repo_id"), F.col("o_custkey").alias("actor_id"),
        (F.col("l_extendedprice") / 1000).alias("openrank"), F.col("s_name").alias("repo_name"),
    )


def info(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    j = lines.filter("l_suppkey % 10 != 0").join(part, lines["l_partkey"] == part["p_partkey"])
    return j.select(
        F.lit(PLATFORM).alias("platform"), F.col("l_suppkey").alias("id"), (F.col("l_returnflag") == "R").cast("int").alias("isFork"), F.col("l_shipdate").alias("updated_at"),
        F.col("l_linestatus").alias("status"), F.col("p_type").alias("primary_language"), F.array("p_brand", "p_type").alias("topics"), F.col("p_name").alias("description"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    kinds = F.explode(F.array(F.struct(F.lit("Tech-0").alias("type"), F.col("p_brand").alias("name")), F.struct(F.lit("Domain-0").alias("type"), F.col("p_type").alias("name"))))
    path = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(":technology/ai/"), "p_brand")).otherwise(F.concat(F.lit(":technology/"), "p_brand"))
    return part.select(F.lit(PLATFORM).alias("platform"), F.lit("Repo").alias("entity_type"), F.col("p_partkey").alias("entity_id"), path.alias("id"), kinds.alias("k")).select("platform", "entity_type", "entity_id", "id", "k.name", "k.type")


def hub_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, p, s, n = (table(spark, sf_dir, x) for x in ("customer", "part", "supplier", "nation"))
    ids = lambda prefix, *cols: F.array(*(F.concat(F.lit(prefix), x.cast("string")) for x in cols))
    none = F.array().cast("array<string>")
    bases = F.array(F.struct(F.concat(F.lit("c"), F.expr("c_custkey div 3").cast("string")).alias("id"), F.when(F.col("c_custkey") % 2 == 0, "finetune").otherwise("quantized").alias("relation")))
    no_bases = F.array().cast("array<struct<id:string,relation:string>>")
    models = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.lit("model").alias("type"), F.col("n_name").alias("author"), F.col("c_mktsegment").alias("task"),
        F.substring("c_mktsegment", 1, 1).alias("domain"), F.greatest("c_acctbal", F.lit(0.1)).alias("rank"), bases.alias("base_models"), ids("p", F.col("c_custkey") % 97 + 1).alias("datasets"), none.alias("models"),
    )
    data = p.select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"), F.lit("dataset").alias("type"), F.col("p_brand").alias("author"), F.col("p_type").alias("task"),
        F.substring("p_type", 1, 1).alias("domain"), F.col("p_retailprice").alias("rank"), no_bases.alias("base_models"), none.alias("datasets"), none.alias("models"),
    )
    spaces = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.lit("space").alias("type"), F.col("n_name").alias("author"), F.lit("app").alias("task"), F.lit("a").alias("domain"),
        F.greatest("s_acctbal", F.lit(0.1)).alias("rank"), no_bases.alias("base_models"), ids("p", F.col("s_suppkey") % 89 + 1, F.col("s_suppkey") % 13 + 1).alias("datasets"), ids("c", F.col("s_suppkey") % 101 + 1, F.col("s_suppkey") % 11 + 1).alias("models"),
    )
    return models.unionByName(data).unionByName(spaces)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as laid-out nodes: node, x, y, community, rank."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("node"), ((k * 7919 % 1009) / 1009.0 - 0.5).alias("x"), ((k * 104729 % 1013) / 1013.0 - 0.5).alias("y"), F.col("c_nationkey").alias("community"), F.greatest("c_acctbal", F.lit(0.0)).alias("rank"),
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as repositories to classify: id, topics, description, lang."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.array("source", "lang").alias("topics"), F.col("text").alias("description"), "lang")


#: The same views in SQL.
SQL = """
activity as (select * from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey),
scores as (select 'TPCH' as platform, 'Repo' as type, o_orderdate as created_at, year(o_orderdate) * 100 + month(o_orderdate) as yyyymm, l_suppkey as repo_id, l_extendedprice / 1000 as openrank, s_name as repo_name, n_name as org_login from activity),
contributions as (select 'TPCH' as platform, year(o_orderdate) * 100 + month(o_orderdate) as yyyymm, l_suppkey as repo_id, o_custkey as actor_id, l_extendedprice / 1000 as openrank, s_name as repo_name from activity),
info as (select 'TPCH' as platform, l_suppkey as id, cast(l_returnflag = 'R' as int) as isFork, l_shipdate as updated_at, l_linestatus as status, p_type as primary_language, p_brand, p_type, p_name as description
  from lineitem join part on l_partkey = p_partkey where l_suppkey % 10 != 0)"""
