"""Rule-based classification of documents against a lexicon.

A lexicon is a DataFrame (category, place, keyword): categories in their order of
precedence and the keywords of each. It is a parameter; nothing here depends on what it
says. ``docs`` have id, topics (array) and description.
"""

from __future__ import annotations

import json
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.formulas import confidence
from ..functions.text import canonical

# Evidence of a keyword that is a topic, a phrase in one, or in the description.
EXACT, PHRASE, PROSE, SHORT_PROSE = 4.6, 3.1, 1.15, 0.9
SIGNAL = 0.9
TAGS = 6
# Confidences (scored ones start from the floors), and names that results carry.
AI_FLOOR, DOMAIN_FLOOR, NO_SIGNAL, FALLBACK = 0.57, 0.52, 0.58, 0.24
NONE, AGENTIC, AGENTIC_DOMAIN, AI_DOMAIN = "Non-AI", "Agents & RAG", "Agentic AI", "AI"
AI_NAME, DOMAIN_NAME = "tech0-ai-lexicon-v1", "tech0-domain-lexicon-v1"
# Tags of models that name no library, and what stands where there is none.
NO_LIBRARY = ("pytorch", "safetensors", "onnx", "tf", "jax", "region:us")
DEFAULT_LIBRARY = {"model": "model-hub", "dataset": "datasets", "space": "static"}
#: Words that the keywords of the lexicons may begin with: they go to every task.
LEXICON_ROWS = 100_000


def builtin(kind: str) -> dict[str, list[str]]:
    """The keywords that come with the library, of "domains" or "areas", by category."""
    return json.loads(resources.files("weftgraph").joinpath("data/lexicon.json").read_text(encoding="utf-8"))[kind]


def lexicon(spark, words: dict[str, list[str]]) -> DataFrame:
    rows = [(c, i, w) for i, (c, ws) in enumerate(words.items()) for w in ws]
    return spark.createDataFrame(rows, "category string, place int, keyword string")


HIT = "struct<kind:string,category:string,place:int,keyword:string,score:double,in_topics:boolean,in_description:boolean>"


def _met(docs: DataFrame, lexicons: dict[str, DataFrame], keep: tuple[str, ...]) -> DataFrame:
    """(id, kept columns, hit): a row for every keyword that a document has, by lexicon; a document
    without one has a row without a hit. Documents are read once: the words that begin
    keywords pick those that may be there, and those alone are looked for in the text."""
    lex = None
    for kind, words in lexicons.items():
        one = words.select(F.lit(kind).alias("kind"), "category", "place", "keyword", canonical(F.col("keyword")).alias("phrase"))
        lex = one if lex is None else lex.unionByName(one)
    lex = lex.filter("phrase != ''").distinct().withColumn("first", F.substring_index("phrase", " ", 1))
    firsts = [r["first"] for r in lex.select("first").distinct().limit(LEXICON_ROWS + 1).collect()]
    if len(firsts) > LEXICON_ROWS:
        raise ValueError(f"a lexicon begins with more than {LEXICON_ROWS} words")
    ts = F.filter(F.transform(F.coalesce("topics", F.array().cast("array<string>")), canonical), lambda t: t != "")
    clean = docs.select("id", *keep, ts.alias("ts"), F.coalesce(canonical(F.col("description")), F.lit("")).alias("d"))
    words = F.concat(F.split("d", " "), F.flatten(F.transform("ts", lambda t: F.split(t, F.lit(" ")))))
    begun = F.array_intersect(words, F.lit(sorted(firsts)) if firsts else F.array().cast("array<string>"))
    some = clean.withColumn("first", F.explode_outer(begun)).join(F.broadcast(lex), "first", "left")

    def within(body: Column) -> Column:
        return F.contains(F.concat(F.lit(" "), body, F.lit(" ")), F.concat(F.lit(" "), F.col("phrase"), F.lit(" ")))

    topic = F.when(F.array_contains("ts", F.col("phrase")), EXACT).when(F.exists("ts", within), PHRASE).otherwise(0.0)
    prose = F.when(within(F.col("d")), F.when(F.length("phrase") > 2, PROSE).otherwise(SHORT_PROSE)).otherwise(0.0)
    some = some.withColumns({"topic": topic, "prose": prose})
    hit = F.struct("kind", "category", "place", "keyword", (F.col("topic") + F.col("prose")).alias("score"), (F.col("topic") > 0).alias("in_topics"), (F.col("prose") > 0).alias("in_description"))
    return some.select("id", *keep, F.when((F.col("topic") > 0) | (F.col("prose") > 0), hit).cast(HIT).alias("hit"))


def evidence(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(id, category, place, keyword, score, in_topics, in_description) of each keyword that a document has."""
    return _met(docs, {"": words}, ()).filter("hit is not null").select("id", "hit.*").drop("kind")


def _hits(docs: DataFrame, lexicons: dict[str, DataFrame], keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: its hits in all lexicons, of which there are no more than keywords."""
    return _met(docs, lexicons, keep).groupBy("id").agg(*(F.first(c).alias(c) for c in keep), F.collect_list("hit").alias("hits"))


def _best(hits: Column) -> Column:
    """(score, category) of the greatest sum, the earlier category on a tie; null without hits."""
    there = F.array_distinct(F.transform(hits, lambda h: F.struct(h["place"].alias("place"), h["category"].alias("category"))))

    def total(c: Column) -> Column:
        own = F.filter(hits, lambda h: (h["place"] == c["place"]) & (h["category"] == c["category"]))
        return F.round(F.aggregate(own, F.lit(0.0), lambda a, h: a + h["score"]), 6)

    return F.array_max(F.transform(there, lambda c: F.struct(total(c).alias("score"), (-c["place"]).alias("o"), c["category"].alias("category"))))


def _tags(hits: Column) -> Column:
    """Keywords by falling evidence, then name, each once."""
    order = F.array_sort(F.transform(hits, lambda h: F.struct((-h["score"]).alias("s"), h["keyword"].alias("k"))))
    return F.slice(F.array_distinct(F.transform(order, lambda x: x["k"])), 1, TAGS)


def _sources(hits: Column) -> Column:
    named = F.array(F.when(F.exists(hits, lambda h: h["in_description"]), "description"), F.when(F.exists(hits, lambda h: h["in_topics"]), "topics"))
    return F.array_join(F.filter(named, lambda x: x.isNotNull()), "+")


def _signal(hits: Column, none: str, name: str) -> dict[str, Column]:
    best = _best(hits)
    yes = F.coalesce(best["score"] >= SIGNAL, F.lit(False))
    return {
        "is_signal": yes, "primary": F.when(yes, best["category"]).otherwise(none),
        "tags": F.when(yes, _tags(hits)).otherwise(F.array().cast("array<string>")),
        "source": F.when(yes, F.concat(F.lit(f"{name}:"), _sources(hits))).otherwise(f"{name}:no-signal"),
        "confidence": F.when(yes, confidence(best["score"], AI_FLOOR)).otherwise(NO_SIGNAL),
    }


def classify_signal(docs: DataFrame, words: DataFrame, none: str = NONE, name: str = AI_NAME) -> DataFrame:
    """(id, is_signal, primary, tags, source, confidence): whether any category has a signal;
    tags are the strongest six keywords over all categories, sources those of all."""
    return _hits(docs, {"": words}).select("id", *(c.alias(k) for k, c in _signal(F.col("hits"), none, name).items()))


def language_fallback(language: Column, families: dict[str, list[str]], default: str) -> Column:
    out = F.lit(default)
    for family, names in families.items():
        out = F.when(language.isin(*names), family).otherwise(out)
    return out


def classify_domain(docs: DataFrame, signals: DataFrame, words: DataFrame, families: dict[str, list[str]], default: str, split: str = AGENTIC, name: str = DOMAIN_NAME) -> DataFrame:
    """(id, primary, tags, source, confidence): documents with a signal in the first lexicon keep
    it as their domain; others take their best category of the second, or what their
    language suggests. ``docs`` have lang, and are read once for both."""
    found = _hits(docs, {"signal": signals, "domain": words}, ("lang",))
    s = _signal(F.filter("hits", lambda h: h["kind"] == "signal"), NONE, name)
    best = _best(F.filter("hits", lambda h: h["kind"] == "domain"))
    own = F.filter("hits", lambda h: (h["kind"] == "domain") & (h["category"] == best["category"]))
    yes, scored = s["is_signal"], best.isNotNull()
    return found.select(
        "id",
        F.when(yes, F.when(s["primary"] == split, AGENTIC_DOMAIN).otherwise(AI_DOMAIN)).when(scored, best["category"]).otherwise(language_fallback(F.col("lang"), families, default)).alias("primary"),
        F.when(yes, s["tags"]).when(scored, _tags(own)).otherwise(F.array(F.coalesce("lang", F.lit("")))).alias("tags"),
        F.when(yes, s["source"]).when(scored, F.concat(F.lit(f"{name}:"), _sources(own))).otherwise(f"{name}:primary_language-fallback").alias("source"),
        F.when(yes, s["confidence"]).when(scored, confidence(best["score"], DOMAIN_FLOOR)).otherwise(FALLBACK).alias("confidence"),
    )


def matched_label(label: Column, names: list[str], aliases: dict[str, str], parts: list[tuple[str, str]]) -> Column:
    """The name that a label stands for: an equal one, else by alias, else by the first of the parts
    in it (at its end, for a part that ends in $); null without."""
    c = canonical(label)
    out = F.lit(None).cast("string")
    for part, name in reversed(parts):
        there = F.endswith(c, F.lit(part[:-1])) if part.endswith("$") else F.contains(c, F.lit(part))
        out = F.when(there, name).otherwise(out)
    for alias, name in aliases.items():
        out = F.when(c == alias, name).otherwise(out)
    for name in names:
        out = F.when(c == canonical(F.lit(name)), name).otherwise(out)
    return out


def canonical_label(label: Column, names: list[str], aliases: dict[str, str], parts: list[tuple[str, str]]) -> Column:
    """A curated label under the name that it stands for, or as it is."""
    return F.coalesce(matched_label(label, names, aliases, parts), F.trim(label))


def curated(labels: DataFrame) -> DataFrame:
    """Curated labels per repository: distinct names by kind, and whether any is an agentic one."""

    def names(cond: Column) -> Column:
        return F.array_sort(F.collect_set(F.when(cond, F.col("name"))))

    ai = F.col("id").startswith(":technology/ai")
    return labels.groupBy(F.col("entity_id").alias("repo_id")).agg(
        names(F.col("type") == "Tech-0").alias("tech0_labels"), names(F.col("type") == "Domain-0").alias("domain0_labels"), names(ai).alias("ai_labels"),
        F.coalesce(F.bool_or(F.lower("name").contains("agent") & ai), F.lit(False)).alias("is_agentic"),
    )


def override(domain: DataFrame, curated_rows: DataFrame) -> DataFrame:
    """Curated labels win over rules: agentic first, then AI labels, then domain labels."""
    j = domain.join(curated_rows.withColumnRenamed("repo_id", "id"), "id", "left")
    ai, dom = F.size(F.coalesce("ai_labels", F.array().cast("array<string>"))) > 0, F.size(F.coalesce("domain0_labels", F.array().cast("array<string>"))) > 0
    agentic = F.coalesce("is_agentic", F.lit(False))
    return j.select(
        "id",
        F.when(agentic, AGENTIC_DOMAIN).when(ai, AI_DOMAIN).when(dom, F.try_element_at("domain0_labels", F.lit(1))).otherwise(F.col("primary")).alias("primary"),
        F.when(agentic | ai, F.col("ai_labels")).when(dom, F.col("domain0_labels")).otherwise(F.col("tags")).alias("tags"),
        F.when(agentic | ai | dom, "curated").otherwise(F.col("source")).alias("source"),
        F.when(agentic | ai | dom, 1.0).otherwise(F.col("confidence")).alias("confidence"),
    )


def by_rules(x: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The name of the first rule whose part the text holds, without regard to case."""
    out = F.lit(default)
    for part, name in reversed(rules):
        out = F.when(F.contains(F.lower(F.coalesce(x, F.lit(""))), F.lit(part.lower())), name).otherwise(out)
    return out


def first_of(tags: Column, wanted: list[str], default: str) -> Column:
    """The first of the wanted names, in their order, that is among the tags."""
    held = F.filter(F.array(*(F.lit(w) for w in wanted)), lambda w: F.array_contains(tags, w))
    return F.coalesce(F.try_element_at(held, F.lit(1)), F.lit(default))


def topic_selection(tags: Column, hidden: list[str], most: int = TAGS) -> Column:
    """The first plain tags: no prefix, not among the hidden ones, each once."""
    plain = F.filter(tags, lambda t: ~F.contains(t, F.lit(":")) & ~t.isin(*hidden) & (F.trim(t) != ""))
    return F.slice(F.array_distinct(plain), 1, most)


def library(kind: str, named: Column, tags: Column, tasks: list[str]) -> Column:
    """The library of a hub item: for a model the one that it names, else its first plain tag that is
    no task, format or place; for a dataset its first library tag; for a space its SDK."""
    held = F.nullif(F.trim(F.coalesce(named, F.lit(""))), F.lit(""))
    if kind == "model":
        plain = F.filter(tags, lambda t: ~F.contains(t, F.lit(":")) & ~t.isin(*tasks, *NO_LIBRARY))
        return F.coalesce(held, F.try_element_at(plain, F.lit(1)), F.lit(DEFAULT_LIBRARY["model"]))
    if kind == "dataset":
        own = F.transform(F.filter(tags, lambda t: t.startswith("library:")), lambda t: F.trim(F.substring(t, 9, 10_000)))
        return F.coalesce(F.try_element_at(F.filter(own, lambda t: t != ""), F.lit(1)), F.lit(DEFAULT_LIBRARY["dataset"]))
    return F.coalesce(held, F.lit(DEFAULT_LIBRARY["space"]))


def lookup_curated(nodes: DataFrame, records: DataFrame) -> DataFrame:
    """Each node's record by repository id, else by its name without regard to case."""
    by_id = records.filter(F.col("key").startswith("repo:")).select(F.substring("key", 6, 1000).alias("k1"), F.col("record").alias("r1"))
    by_name = records.filter(F.col("key").startswith("name:")).select(F.lower(F.substring("key", 6, 1000)).alias("k2"), F.col("record").alias("r2"))
    return nodes.join(by_id, nodes["repo_id"].cast("string") == F.col("k1"), "left").join(by_name, F.lower(nodes["name"]) == F.col("k2"), "left").select(nodes["*"], F.coalesce("r1", "r2").alias("record"))


def facet_counts(areas: DataFrame) -> DataFrame:
    """(facet, value, n, representative): the representative has the greatest rank, then the least id."""
    return areas.groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"), F.max_by("id", F.struct("rank", (-F.col("id")).alias("o"))).alias("representative"))

