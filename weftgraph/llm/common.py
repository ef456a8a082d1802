"""What the operators of this subpackage share: inputs, shared tables, Arrow helpers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.tables import materialize, release, shared_dir  # noqa: F401

#: A word: a longest run of bytes other than space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(col: str | Column = "doc_id") -> Column:
    """An id as text; null gives the empty string."""
    return F.coalesce(F.col(col).cast("string") if isinstance(col, str) else col.cast("string"), F.lit(""))


def row_key(text: str = "text", id_col: str = "doc_id") -> Column:
    """16 bytes for a row's id and text: half of a SHA-256 over both, each behind its length (-1 for null)."""

    def part(name: str) -> Column:
        body = F.col(name).cast("string")
        return F.concat(F.coalesce(F.octet_length(body), F.lit(-1)).cast("string"), F.lit(":"), F.coalesce(body, F.lit("")))

    return F.unhex(F.substring(F.sha2(F.concat(part(id_col), part(text)), 256), 1, 32))


def hash_key(text: Column, digits: int = 13) -> Column:
    """The first hex digits of md5 as a long: a uniform key that other engines can compute too."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets, without a copy per row; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    off = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, off


def slices(offsets: np.ndarray, most: int):
    """Ranges of rows of about ``most`` bytes each (one row at least), so that work arrays stay small."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end
        at = end
