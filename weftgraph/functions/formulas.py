"""Scalar formulas of the graph pipeline as column expressions."""

from __future__ import annotations

import colorsys
import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def affinity(weight: Column, strength: Column) -> Column:
    """How strongly an edge binds: never below 1e-12."""
    return F.greatest(F.log1p(F.greatest(weight, F.lit(0.0))) + 0.55 * F.log1p(F.greatest(strength, F.lit(0.0))), F.lit(1e-12))


def importance(downloads: Column, likes: Column, trending: Column, bonus: Column) -> Column:
    return F.greatest(F.log1p(downloads) + 1.65 * F.log1p(likes) + 1.9 * F.log1p(trending) + bonus, F.lit(0.1))


def visual_score(rank: Column, degree: Column, contributors: Column) -> Column:
    return 1.55 * F.log1p(rank) + 0.9 * F.log1p(degree) + 0.22 * F.log1p(contributors)


def confidence(score: Column, floor: float) -> Column:
    return F.round(F.least(F.lit(0.99), F.lit(floor) + 0.45 * score / (score + 7)), 2)


def finite(x: Column) -> Column:
    """A number that is finite and not negative; 0 for anything else."""
    y = x.cast("double")
    bad = y.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))
    return F.when(bad, 0.0).otherwise(F.greatest(y, F.lit(0.0)))


def compact(x: Column, digits: int) -> Column:
    """The shortest text of a rounded number: no trailing zeros, no negative zero."""
    y = F.round(x, digits) + F.lit(0.0)
    plain = F.regexp_replace(F.format_string(f"%.{digits}f", y), r"\.?0+$", "") if digits else F.format_string("%.0f", y)
    return F.when(y == 0, "0").otherwise(plain)


@F.pandas_udf(T.DoubleType())
def stable_unit(text: pd.Series) -> pd.Series:
    """A hash of the text in [0, 1) that is the same everywhere: blake2b of 64 bits."""
    return text.map(lambda t: int.from_bytes(hashlib.blake2b((t or "").encode(), digest_size=8).digest(), "big") / 2**64)


def md5_unit(text: Column) -> Column:
    """Like stable_unit, in built-in functions: the first 52 bits of md5."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


@F.pandas_udf(T.StringType())
def hue_color(hue: pd.Series, light: pd.Series, saturation: pd.Series) -> pd.Series:
    def one(h: float, li: float, s: float) -> str:
        return "#" + "".join(f"{round(255 * c):02x}" for c in colorsys.hls_to_rgb(h % 1.0, li, s))

    return pd.Series([one(*x) for x in zip(hue, light, saturation, strict=True)])


def golden_hue(index: Column, start: float = 0.0) -> Column:
    """Hues that stay apart however many are drawn: steps of the golden ratio's fraction."""
    x = F.lit(start) + index * 0.618033988749895
    return x - F.floor(x)
