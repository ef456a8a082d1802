"""Contributions kept up to date from a stream of activity.

The batch pipeline reads finished months. This is the same first step, the largest value
per actor and repository, over rows that still arrive: by day, each given out when the
watermark has passed it, and folded into months where it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_contributions(events: DataFrame, time: str = "ts", actor: str = "actor_id", repo: str = "repo_id", value: str = "value", late: str = "2 days") -> DataFrame:
    """(month, day, actor_id, repo_id, contribution) of a streaming (or batch) frame. State holds one
    row per key of the days that the watermark has not passed; later rows are dropped."""
    ts = F.col(time).cast("timestamp")
    rows = events.filter((F.col(actor) != 0) & (F.col(repo) != 0)).select(ts.alias("ts"), F.col(actor).alias("actor_id"), F.col(repo).alias("repo_id"), F.col(value).cast("double").alias("v"))
    day = F.window("ts", "1 day")
    daily = rows.withWatermark("ts", late).groupBy(day.alias("day"), "actor_id", "repo_id").agg(F.max("v").alias("contribution"))
    return daily.select((F.year("day.start") * 100 + F.month("day.start")).alias("month"), F.col("day.start").alias("day"), "actor_id", "repo_id", "contribution")


def fold(days: DataFrame) -> DataFrame:
    """Months out of the days that a stream has written."""
    return days.groupBy("month", "actor_id", "repo_id").agg(F.max("contribution").alias("contribution"))
