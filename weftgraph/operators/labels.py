"""Curated labels: which row of a lookup each id gets, and the names that labels stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .taxonomy import matched_label

# The names of domains and of AI areas, in their order.
DOMAINS = ["AI", "Agentic AI", "Application Software", "Big Data", "Blockchain", "Cloud Native", "Database", "Development Tools", "IoT", "Operating System", "Programming Language", "Web Frameworks"]
AREAS = ["LLM & Generative AI", "Agents & RAG", "ML Frameworks", "Computer Vision", "NLP & Speech", "Data / Evaluation / MLOps", "Robotics", "AI Applications"]

# Other names of domains.
DOMAIN_ALIASES = {
    "AI": "artificial intelligence",
    "Agentic AI": "agentic",
    "Application Software": "applications, application",
    "Big Data": "data, bigdata",
    "Blockchain": "block chain, crypto",
    "Cloud Native": "cloud, cloud infrastructure",
    "Database": "databases",
    "Development Tools": "libraries and frameworks, software tools, developer tooling, devtools, non software",
    "IoT": "internet of things",
    "Operating System": "os, system software",
    "Programming Language": "languages, programming languages",
    "Web Frameworks": "web, web frameworks",
}
# Other names of AI areas.
AREA_ALIASES = {
    "LLM & Generative AI": "llm, large language models, generative ai, genai",
    "Agents & RAG": "agent, agents, agentic ai, rag",
    "ML Frameworks": "machine learning, deep learning",
    "Computer Vision": "computer vision",
    "NLP & Speech": "nlp, speech",
    "Data / Evaluation / MLOps": "mlops, evaluation, data",
    "Robotics": "robotics",
    "AI Applications": "ai application, ai applications",
}
# Parts of labels that name an AI area, in the order in which they are looked for; the last one ends a label.
AREA_PARTS = [
    ("vector database", "Data / Evaluation / MLOps"),
    ("infrastructure data", "Data / Evaluation / MLOps"),
    ("platform environment", "Data / Evaluation / MLOps"),
    ("develop tool", "Data / Evaluation / MLOps"),
    ("framework architecture", "ML Frameworks"),
    ("large language model", "LLM & Generative AI"),
    ("generative artificial intelligence", "LLM & Generative AI"),
    (" application$", "AI Applications"),
]


def _flat(aliases: dict[str, str]) -> dict[str, str]:
    return {a: name for name, text in aliases.items() for a in text.split(", ")}


def _first(labels: Column, names: list[str], aliases: dict[str, str], parts: list[tuple[str, str]]) -> Column:
    found = F.filter(F.transform(labels, lambda x: matched_label(x, names, aliases, parts)), lambda x: x.isNotNull())
    return F.try_element_at(found, F.lit(1))


def domain_of(labels: Column) -> Column:
    """The domain that the first label with one stands for; null without."""
    return _first(labels, DOMAINS, _flat(DOMAIN_ALIASES), [])


def area_of(labels: Column) -> Column:
    """The AI area that the first label with one stands for; null without."""
    return _first(labels, AREAS, _flat(AREA_ALIASES), AREA_PARTS)


def of_ids(labels: DataFrame, ids: DataFrame, most: int = 100_000) -> DataFrame:
    """The label rows of some ids (entity_id). Up to ``most`` ids go to every task; more meet the rows in a shuffle."""
    few = ids.select(F.col("id").alias("entity_id")).distinct()
    if few.limit(most + 1).count() <= most:
        few = F.broadcast(few)
    return labels.join(few, "entity_id", "left_semi")
