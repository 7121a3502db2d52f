"""Counts and frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def entity_frequency(mentions: DataFrame, top: int = 20) -> DataFrame:
    """entity_type, text, n of the most frequent entities; ties in order of first mention."""
    g = mentions.groupBy("entity_type", "text").agg(F.count("*").alias("n"), F.min("mention_id").alias("first"))
    return g.orderBy(F.desc("n"), "first").limit(top).drop("first")


def entities_by_page(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("page_id", "entity_type").agg(F.count("*").alias("n"))


def totals(pages: DataFrame, regions: DataFrame, mentions: DataFrame) -> DataFrame:
    """pages, regions, entities, locations in one row, each from its own scan."""
    a = pages.agg(F.count("*").alias("pages"))
    b = regions.agg(F.count("*").alias("regions"))
    c = mentions.agg(F.count("*").alias("entities"), F.count_if(F.expr("entity_type = 'Location'")).alias("locations"))
    return a.withColumn("k", F.lit(1)).join(b.withColumn("k", F.lit(1)), "k").join(c.withColumn("k", F.lit(1)), "k").drop("k")  # one row each


def region_types(regions: DataFrame) -> DataFrame:
    """journal_id, region_type, n, visual, slips."""
    return regions.groupBy("journal_id", "region_type").agg(F.count("*").alias("n"), F.count_if("is_visual").alias("visual"))


def register_counts(register: DataFrame) -> DataFrame:
    return register.groupBy("kind").agg(F.count("*").alias("n"))


def search(regions: DataFrame, word: str) -> DataFrame:
    """region_id of regions that hold a word, whatever its case."""
    return regions.filter(F.lower("content").contains(word.lower())).select("region_id")
