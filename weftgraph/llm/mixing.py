"""Mixing sources to target weights, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, hash_key, id_text, materialize


def by_rank(rank: Column) -> Column:
    """Weights 1, 2, 3, repeating."""
    return rank % 3 + 1


def targets(totals: DataFrame, weight=by_rank, most: int = 3) -> DataFrame:
    """(skey, source_size, target): the whole size shared by weight, each source held to
    ``most`` times its own and the excess shared again until none is above.

    That fixed point is min(cap, level * weight). With the sources by rising
    cap / weight, the level is (all - caps before) / (weights from here on) at the
    first source that it does not fill, so two running sums replace the rounds."""
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("w", weight(F.col("rank")).cast("long")).withColumn("cap", F.col("source_size") * most)
    ranked = ranked.withColumn("fill", F.col("cap") / F.col("w"))
    up = Window.orderBy("fill", "rank")
    ranked = (
        ranked.withColumn("all", F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("level", (F.col("all") - F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, 0)) + F.col("cap")) / F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("place", F.row_number().over(up))
    )
    level = ranked.filter("fill >= level").agg(F.min_by("level", "place").alias("level_at"))
    return ranked.join(F.broadcast(level), how="inner").select("skey", "source_size", F.least(F.col("cap").cast("double"), F.col("level_at") * F.col("w")).alias("target"))


def sized(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    return docs.select(
        *keep,
        F.col(id_col).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("~null")).alias("skey"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        hash_key(F.concat(F.lit("mix:"), id_text(id_col))).alias("key"),
    )


def mix(docs: DataFrame, weight=by_rank, most: int = 3, text: str = "text", source: str = "source", id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, source, the columns to keep.

    Rows get a key hashed from the id and lie, in each source, in the order of (key,
    id, size). A source's budget is the floor of its target; whole epochs come first,
    then the rows of that order until the rest of the budget is met exactly, the row
    at the cut with the words still open. The order's prefix sums are taken in
    sqrt(n) key ranges a source and shifted by the ranges' running sums, so that
    neither a hot source nor all ranges meet in one task's hands.

    Null texts have size 0 and take 0; null sources are one source, after the others;
    null ids count as the empty text in the key; repeated rows count each; rows that tie in
    key, id and size may stand either way round, and take the same in sum; very long texts
    are counted whole; an empty table gives no rows; other columns are ignored.
    """
    rows = materialize(sized(docs, text, source, id_col, keep), "mix")
    ranges = max(1, math.isqrt(rows.count()))
    rows = rows.withColumn("part", F.expr(f"cast((key div 65536) * {ranges} div {2**36} as int)"))
    parts = rows.groupBy("skey", "source", "part").agg(F.sum("size").alias("part_size"))
    totals = parts.groupBy("skey", "source").agg(F.sum("part_size").alias("source_size"))
    before = (
        parts.withColumn("before", F.sum("part_size").over(Window.partitionBy("skey").orderBy("part")) - F.col("part_size"))
        .join(targets(totals, weight, most), "skey")
        .select("skey", "part", "before", "source_size", "target")
    )
    here = Window.partitionBy("skey", "part").orderBy("key", F.col("doc_id").asc_nulls_first(), "size")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0))
    out = (
        rows.withColumn("within", F.sum("size").over(here.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(before, ["skey", "part"])
        .withColumn("epochs", epochs)
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size") - F.col("before") - F.col("within"))
    )
    taken = F.col("size") * F.col("epochs") + F.least(F.greatest(F.col("rest"), F.lit(0)), F.col("size"))
    return out.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", *keep)


def apply(docs: DataFrame, weight=by_rank, most: int = 3, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The mix itself, with all columns: each row as often as the mix takes it whole. The
    row at a source's cut comes once more with the first of its words that the budget
    still takes, joined by single spaces (n_chars, if there is one, counts them). Rows
    without words take part in nothing and go."""
    numbered = materialize(docs.withColumn("__weft_row", F.monotonically_increasing_id()), "numbered")
    taken = mix(numbered, weight, most, text, source, id_col, ("__weft_row",)).filter("taken > 0").select("__weft_row", (F.expr("taken div size")).cast("int").alias("__weft_times"), (F.col("taken") % F.col("size")).cast("int").alias("__weft_part"))
    rows = numbered.join(taken, "__weft_row")
    whole = rows.withColumn("__weft_copy", F.explode(F.concat(F.array_repeat(F.lit(0), F.col("__weft_times")), F.array_repeat(F.col("__weft_part"), F.when(F.col("__weft_part") > 0, 1).otherwise(0)))))
    cut = F.array_join(F.slice(F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != ""), 1, F.col("__weft_copy")), " ")
    out = whole.withColumn(text, F.when(F.col("__weft_copy") > 0, cut).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__weft_copy") > 0, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


SQL = r"""
with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
    cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint) as key from documents),
t as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as rank from d group by source),
w as (select *, rank % 3 + 1 as w, source_size * 3 as cap, cast(source_size * 3 as double) / (rank % 3 + 1) as fill from t),
l as (select *, row_number() over up as place,
    cast((select sum(source_size) from t) - sum(cap) over (order by fill, rank rows unbounded preceding) + cap as double) / cast(sum(w) over (order by fill, rank rows between current row and unbounded following) as double) as level
  from w window up as (order by fill, rank)),
g as (select source, source_size, least(cast(cap as double), (select arg_min(level, place) from l where fill >= level) * w) as target from l),
p as (select d.doc_id, d.size, g.source_size, g.target, cast(floor(g.target) as bigint) as budget,
    sum(size) over (partition by d.source order by key, d.doc_id nulls first, size rows unbounded preceding) - size as before
  from d join g on d.source is not distinct from g.source)
select doc_id, cast(size as bigint) as size, source_size, target,
  cast(case when source_size = 0 then 0 else size * (budget // source_size) + least(greatest(budget - (budget // source_size) * source_size - before, 0), size) end as bigint) as taken from p"""
