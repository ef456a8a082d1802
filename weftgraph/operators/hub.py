"""The typed graph of models, datasets and spaces.

Items: id (string), type, author, task, domain, rank, base_models (array of struct id,
relation), datasets, models (arrays of ids).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ranking import global_rank
from ..plans.tables import materialize

# Precedence and weight of each kind of edge.
PRIORITY = {"base-model": 100, "declared-dataset": 95, "uses-model": 90, "uses-dataset": 89, "same-author": 75, "inferred-task": 20, "inferred-taxonomy": 10}
WEIGHT = {"base-model": 9.0, "declared-dataset": 7.5, "uses-model": 8.0, "uses-dataset": 7.7, "same-author": 4.2, "task-chain": 1.35, "domain-star": 0.72, "taxonomy": 0.28}


def _resolved(named: DataFrame, items: DataFrame, type_: str) -> DataFrame:
    """Edges (a, weight, at, ref) to the items of a type that ref names; unknown names drop out."""
    there = items.filter(F.col("type") == type_).select(F.col("id").alias("ref"), F.col("key").alias("b"))
    return named.join(there, "ref")


def with_keys(items: DataFrame) -> DataFrame:
    return items.withColumn("key", F.concat_ws(":", "type", "id"))


def observed(items: DataFrame) -> DataFrame:
    """(a, b, weight, kind, inferred, at): relations that items declare; ``at`` is their order."""
    models, spaces = items.filter(F.col("type") == "model"), items.filter(F.col("type") == "space")

    def part(rows: DataFrame, column: str, most: int, kind: str, type_: str) -> DataFrame:
        named = rows.select(F.col("key").alias("a"), F.posexplode(F.slice(F.coalesce(column, F.array().cast("array<string>")), 1, most)).alias("at", "ref"))
        return _resolved(named, items, type_).select("a", "b", F.lit(WEIGHT[kind]).alias("weight"), F.lit(kind).alias("kind"), F.lit(0).alias("inferred"), "at")

    base = models.select(F.col("key").alias("a"), F.posexplode("base_models").alias("at", "m")).select("a", "at", F.col("m.id").alias("ref"), F.col("m.relation").alias("relation"))
    boost = F.when(F.col("relation").isin("finetune", "adapter"), 1.0).otherwise(0.5)
    base = _resolved(base, items, "model").select("a", "b", (WEIGHT["base-model"] + boost).alias("weight"), F.lit("base-model").alias("kind"), F.lit(0).alias("inferred"), "at")
    return base.unionByName(part(models, "datasets", 8, "declared-dataset", "dataset")).unionByName(part(spaces, "models", 12, "uses-model", "model")).unionByName(part(spaces, "datasets", 12, "uses-dataset", "dataset"))


def author_stars(items: DataFrame) -> DataFrame:
    """Every item of an author hangs on the author's first one: a star, not a clique."""
    hubs = items.groupBy("author").agg(F.min_by("key", F.struct((-F.col("rank")).alias("r"), "id")).alias("hub"))
    j = items.join(hubs, "author").filter(F.col("key") != F.col("hub"))
    return j.select(F.col("hub").alias("a"), F.col("key").alias("b"), F.lit(WEIGHT["same-author"]).alias("weight"), F.lit("same-author").alias("kind"), F.lit(0).alias("inferred"), F.lit(0).alias("at"))


def task_chains(items: DataFrame, unit) -> DataFrame:
    """Items of a task in a chain by hash. ``unit`` hashes text to [0, 1)."""
    # A task may hold a large part of all items: neighbours meet by their place in one global order.
    h = items.select("key", "task", "id", unit(F.concat_ws(":", F.lit("hf-task"), "task", "id")).alias("h"))
    placed = materialize(global_rank(h, [F.asc("task"), F.asc("h"), F.asc("id")]).select("key", "task", "place"), "chain")
    nxt = placed.select("task", (F.col("place") - 1).alias("place"), F.col("key").alias("b"))
    return placed.join(nxt, ["task", "place"]).select(F.col("key").alias("a"), "b", F.lit(WEIGHT["task-chain"]).alias("weight"), F.lit("inferred-task").alias("kind"), F.lit(1).alias("inferred"), F.lit(0).alias("at"))


def domain_spine(items: DataFrame) -> DataFrame:
    """Stars from each domain's first task representative to the others, and a chain of domains."""
    best = F.struct((-F.col("rank")).alias("r"), "id")
    reps = items.groupBy("domain", "task").agg(F.min_by(F.struct("key", "rank", "id"), best).alias("x")).select("domain", "task", "x.*")
    heads = reps.groupBy("domain").agg(F.min_by("key", best).alias("head"))
    star = reps.join(heads, "domain").filter("key != head").select(F.col("head").alias("a"), F.col("key").alias("b"), F.lit(WEIGHT["domain-star"]).alias("weight"), F.lit("inferred-task").alias("kind"), F.lit(1).alias("inferred"), F.lit(1).alias("at"))
    chain = heads.select(F.col("head").alias("a"), F.lead("head").over(Window.orderBy("domain")).alias("b")).filter("b is not null")
    return star.unionByName(chain.select("a", "b", F.lit(WEIGHT["taxonomy"]).alias("weight"), F.lit("inferred-taxonomy").alias("kind"), F.lit(1).alias("inferred"), F.lit(0).alias("at")))


def priority(kind: Column) -> Column:
    out = F.lit(0)
    for k, v in PRIORITY.items():
        out = F.when(kind == k, v).otherwise(out)
    return out


def resolve(edges: DataFrame) -> DataFrame:
    """One edge per unordered pair (s < t): greatest precedence, then weight; ``shared`` counts
    the later edges of the same kind that were no better than the one that stands. Edges count
    in the order (a, at, b), which stands for the order of emission."""
    e = edges.filter("a != b").select(F.least("a", "b").alias("s"), F.greatest("a", "b").alias("t"), "weight", "kind", "inferred", "a", "at", priority(F.col("kind")).alias("p"))
    one = e.groupBy("s", "t").agg(F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("q"), "a", "at", "weight", "kind", "inferred"))).alias("all"))

    def step(state: Column, x: Column) -> Column:
        fresh = F.struct(x["q"].alias("q"), x["weight"].alias("weight"), x["kind"].alias("kind"), x["inferred"].alias("inferred"), F.lit(1).cast("long").alias("shared"))
        more = F.struct(state["q"].alias("q"), state["weight"].alias("weight"), state["kind"].alias("kind"), state["inferred"].alias("inferred"), (state["shared"] + 1).alias("shared"))
        better = state["kind"].isNull() | (x["q"] < state["q"]) | ((x["q"] == state["q"]) & (x["weight"] > state["weight"]))
        return F.when(better, fresh).when((x["q"] == state["q"]) & (x["kind"] == state["kind"]), more).otherwise(state)

    none = F.struct(F.lit(0).alias("q"), F.lit(0.0).alias("weight"), F.lit(None).cast("string").alias("kind"), F.lit(0).alias("inferred"), F.lit(0).cast("long").alias("shared"))
    return one.select("s", "t", F.aggregate("all", none, step).alias("e")).select("s", "t", F.col("e.weight").alias("weight"), F.col("e.kind").alias("kind"), F.col("e.inferred").alias("inferred"), F.col("e.shared").alias("shared"))


def build(items: DataFrame, unit) -> DataFrame:
    k = with_keys(items)
    return resolve(observed(k).unionByName(author_stars(k)).unionByName(task_chains(k, unit)).unionByName(domain_spine(k)))


def space_tasks(spaces: DataFrame, items: DataFrame) -> DataFrame:
    """(id, task): the most frequent task among what a space links, the first by name on a tie."""
    linked = spaces.select("id", F.explode(F.array_distinct(F.concat(F.coalesce("models", F.array().cast("array<string>")), F.coalesce("datasets", F.array().cast("array<string>"))))).alias("ref"))
    tasks = items.filter(F.col("type") != "space").select(F.col("id").alias("ref"), "task")
    n = linked.join(tasks, "ref").groupBy("id", "task").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("id").agg(F.min_by("task", F.struct((-F.col("n")).alias("n"), "task")).alias("task"))


def kind_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("inferred").cast("long").alias("inferred"))
