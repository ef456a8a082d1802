"""Rows that the tests of this folder share."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, part int, label string, token string, size string, key string, `group` string"


def frame(spark, rows):
    """Documents from (doc_id, text[, source]), with extra columns whose names operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 7, 7, "x", "x", "x", "x", "x") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(rnd: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


#: Rows that every operator must take: nulls, blanks, ties, repeats, controls, odd characters.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "Zwei  Wörter"), (6, "zwei  wörter"), (7, "a\x00b \x1fc"), (8, "日本語 のテキスト 🙂"), (9, "x" * 5000), (9, "x" * 5000), (10, "tab\tand\x0bvt"),
    (None, "no id"), (None, "no id"), (11, "the same text here as there"), (12, "the same text here as there"), (13, "THE same text here as there"),
]
