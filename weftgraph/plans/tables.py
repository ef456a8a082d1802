"""Cutting lineage by tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in a local session without that setting, a folder of its own."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        folder = tempfile.TemporaryDirectory(prefix="weftgraph-")
        atexit.register(folder.cleanup)
        _own[app] = f"file://{folder.name}"
    return _own[app]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and returns it as read from there: a
    cut of lineage that survives the loss of any executor. It stays until a ``scope`` ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weftgraph-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the tables that were written inside: results must have been stored by then."""
    before = len(_made)
    try:
        yield
    finally:
        gone, _made[before:] = _made[before:], []
        jvm = spark.sparkContext._jvm
        for path in gone:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of plans that nothing refers to any
    more; without it they stay until the driver happens to collect its garbage."""
    gc.collect()
    if hasattr(spark, "_jvm"):
        spark._jvm.System.gc()
