"""Consistency audit over linked mentions: coverage and issues, each one aggregate over the mentions.

A linked mention has mention_id (its order), page, entity_type, text, normalized_form, ehd_id, link_method,
link_score, link_ambiguous. Pages are sorted distinct lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.text import genus, last_token, norm_key
from .linking import kind_of

REVIEW_SCORE = 0.75


def _pages():
    return F.array_sort(F.collect_set("page")).alias("pages")


def _form():
    return F.nullif(F.trim("normalized_form"), F.lit(""))


def linkable(mentions: DataFrame) -> DataFrame:
    return mentions.filter(kind_of(F.col("entity_type")).isNotNull())


def coverage(mentions: DataFrame) -> DataFrame:
    """entity_type, linked, total, pct."""
    c = linkable(mentions).groupBy("entity_type").agg(F.count("ehd_id").alias("linked"), F.count("*").alias("total"))
    return c.withColumn("pct", F.bround(F.lit(100.0) * F.col("linked") / F.col("total"), 1))


def normalization_conflicts(mentions: DataFrame) -> DataFrame:
    """One surface form with several standard forms."""
    m = linkable(mentions).withColumn("norm_text", norm_key(F.col("text"))).filter("norm_text <> ''")
    g = m.groupBy("entity_type", "norm_text").agg(F.array_sort(F.collect_set(_form())).alias("normalized_forms"), F.min_by("text", "mention_id").alias("surface_form"), _pages())
    return g.filter("size(normalized_forms) > 1")


def link_conflicts(mentions: DataFrame) -> DataFrame:
    """One standard form linked to several entries."""
    m = linkable(mentions).filter("ehd_id is not null").withColumn("form", norm_key(F.coalesce(F.nullif("normalized_form", F.lit("")), "text"))).filter("form <> ''")
    return m.groupBy("entity_type", "form").agg(F.array_sort(F.collect_set("ehd_id")).alias("linked_ids"), _pages()).filter("size(linked_ids) > 1")


def ambiguous_links(mentions: DataFrame) -> DataFrame:
    """Links to review, once per surface form and entry; pages are those of all mentions of the form."""
    m = linkable(mentions).withColumn("norm_text", norm_key(F.col("text")))
    review = m.filter("ehd_id is not null").filter(F.coalesce("link_ambiguous", F.lit(False)) | (F.col("link_score") < REVIEW_SCORE))
    first = review.groupBy("entity_type", "norm_text", "ehd_id").agg(F.min_by(F.struct("text", "link_method", "link_score"), "mention_id").alias("f"))
    keys = first.select("entity_type", "norm_text").distinct()
    pages = m.join(keys, ["entity_type", "norm_text"], "left_semi").groupBy("entity_type", "norm_text").agg(_pages())
    return first.join(pages, ["entity_type", "norm_text"]).select("entity_type", "norm_text", "ehd_id", F.col("f.text").alias("surface_form"), "f.link_method", "f.link_score", "pages")


def variant_merges(mentions: DataFrame) -> DataFrame:
    """Several surface forms that lead to one entry."""
    m = linkable(mentions).filter("ehd_id is not null")
    form = F.nullif(F.trim(F.replace("text", F.lit("\n"), F.lit(" "))), F.lit(""))
    return m.groupBy("entity_type", "ehd_id").agg(F.array_sort(F.collect_set(form)).alias("surface_forms"), _pages()).filter("size(surface_forms) > 1")


def species_conflicts(mentions: DataFrame) -> DataFrame:
    """Species of one epithet with several standard forms and genera that abbreviate one another."""
    m = linkable(mentions).filter(kind_of(F.col("entity_type")) == "plant").withColumn("epithet", last_token(F.col("text"))).filter("epithet <> ''")
    m = m.withColumn("genus", F.nullif(genus(F.col("text")), F.lit("")))
    form = F.trim(F.replace("text", F.lit("\n"), F.lit(" ")))
    g = m.groupBy("entity_type", "epithet").agg(
        F.array_sort(F.collect_set(_form())).alias("normalized_forms"), F.array_sort(F.collect_set(form)).alias("surface_forms"),
        F.collect_set("genus").alias("genera"), F.max(F.struct(F.length("genus"), "genus"))["genus"].alias("longest"), _pages(),
    )
    fits = F.forall("genera", lambda x: F.coalesce(F.col("longest").startswith(x), F.lit(True)))
    return g.filter((F.size("normalized_forms") > 1) & fits).select("entity_type", "epithet", "normalized_forms", "surface_forms", "pages")


def issues(mentions: DataFrame) -> DataFrame:
    """issue_type, severity, entity_type, subject, pages of all checks."""
    parts = (
        ("normalization_conflict", "warning", normalization_conflicts(mentions), "norm_text"), ("link_conflict", "warning", link_conflicts(mentions), "form"),
        ("ambiguous_link", "info", ambiguous_links(mentions), "norm_text"), ("variant_merge", "info", variant_merges(mentions), "ehd_id"),
        ("species_name_conflict", "warning", species_conflicts(mentions), "epithet"),
    )
    rows = [df.select(F.lit(t).alias("issue_type"), F.lit(s).alias("severity"), "entity_type", F.col(c).alias("subject"), "pages") for t, s, df, c in parts]
    return reduce(DataFrame.unionByName, rows)


def rollup(found: DataFrame) -> DataFrame:
    """severity, issue_type, n: counts by either and in total, in one pass (grouping sets)."""
    g = found.select("severity", "issue_type").groupingSets([[F.col("severity")], [F.col("issue_type")], []], "severity", "issue_type")
    return g.agg(F.count("*").alias("n"))


def linked_mentions(mentions: DataFrame, links: DataFrame, pages: DataFrame) -> DataFrame:
    """Mentions in the shape the audit takes."""
    got = links.select("mention_id", "ehd_id", F.col("method").alias("link_method"), F.col("score").alias("link_score"), F.col("ambiguous").alias("link_ambiguous"))
    m = mentions.select("mention_id", "page_id", "entity_type", "text", "normalized_form").join(got, "mention_id", "left")
    return m.join(pages.select("page_id", F.col("page_number").alias("page")), "page_id", "left")
