"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(x: Column) -> Column:
    """Lower case, everything but a-z, 0-9, +, # and . as single blanks."""
    return F.trim(F.regexp_replace(F.replace(F.lower(F.coalesce(x, F.lit(""))), F.lit("ß"), F.lit("ss")), "[^a-z0-9+#.]+", " "))


def has_phrase(text: Column, phrase: Column) -> Column:
    """Whether canonical text holds the phrase as whole words."""
    return (phrase != "") & F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), phrase, F.lit(" ")))


def clip(x: Column, limit: int) -> Column:
    """White space collapsed; cut to the limit with an ellipsis."""
    y = F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " "))
    return F.when(F.length(y) > limit, F.concat(F.rtrim(F.substring(y, 1, limit - 1)), F.lit("…"))).otherwise(y)


def stripped_tags(tags: Column, prefix: str) -> Column:
    """The distinct, sorted rest of the tags that begin with a prefix."""
    held = F.filter(tags, lambda t: t.startswith(prefix) & (F.length(F.trim(F.substring(t, len(prefix) + 1, 10_000))) > 0))
    return F.array_sort(F.array_distinct(F.transform(held, lambda t: F.trim(F.substring(t, len(prefix) + 1, 10_000)))))


def trimmed_tags(tags: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(tags, lambda t: F.trim(t)), lambda t: t != ""))


def bare_id(x: Column) -> Column:
    """github:123 to 123."""
    return F.regexp_replace(F.trim(x), r"^(?i)(github|repo):", "")


def owner(x: Column) -> Column:
    """The owner in owner/name, null without one."""
    return F.when(F.contains(x, F.lit("/")), F.split_part(x, F.lit("/"), F.lit(1)))


# Fixed value: characters that XML 1.0 has no place for.
NOT_XML = r"[^\x09\x0A\x0D\x20-퟿-�\x{10000}-\x{10FFFF}]"


def xml(x: Column) -> Column:
    y = F.regexp_replace(x, NOT_XML, "")
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        y = F.replace(y, F.lit(mark), F.lit(name))
    return y


def flag(x: Column) -> Column:
    """A boolean out of the ways people write one."""
    return F.lower(F.trim(x.cast("string"))).isin("1", "true", "yes", "y", "on")


def label_list(x: Column) -> Column:
    """Names in a text parted by commas, semicolons, bars or slashes."""
    return trimmed_tags(F.split(F.coalesce(x, F.lit("")), r"[,;|/]"))


def fill_from_json(columns: dict[str, Column], document: Column) -> list[Column]:
    """Each column, or where it is null or empty the field of that name in a JSON text; a text
    that is no JSON object fills nothing."""
    fields = F.from_json(document, "map<string,string>", {"mode": "PERMISSIVE"})
    return [F.coalesce(F.nullif(c, F.lit("")), F.nullif(F.try_element_at(fields, F.lit(k)), F.lit(""))).alias(k) for k, c in columns.items()]
