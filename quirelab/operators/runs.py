"""Runs as a whole: scores with and without a matcher, variants of the text, slices, unions, one composed link-and-check."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import kernels
from ..functions.text import metric_norm, notebook_norm
from . import audit, linking, metrics


def _errors(pairs: DataFrame) -> DataFrame:
    """`pairs` (hyp, ref and keys) with the edits of characters and words and the lengths of ref."""
    p = pairs.withColumn("char_edits", metrics.char_edits(F.col("hyp"), F.col("ref"))).withColumn("ref_chars", F.length("ref"))
    words = F.when(F.col("hyp") == F.col("ref"), 0).otherwise(kernels.u_word_edits("hyp", "ref"))
    return p.withColumn("word_edits", words).withColumn("ref_words", F.size(F.split("ref", " "))).drop("hyp", "ref")


def page_pairs(regions: DataFrame, canonical: DataFrame) -> DataFrame:
    """page_id, hyp, ref: the text of a page's regions in order against its whole ground truth (page_id, canonical); pages without one are left out."""
    shown = regions.filter("content <> '' and not coalesce(is_visual, false)")
    text = shown.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("region_index", "region_id", "content"))).alias("r"))
    hyp = metric_norm(F.array_join(F.transform(F.coalesce("r", F.array().cast("array<struct<region_index:int,region_id:bigint,content:string>>")), lambda x: x["content"]), "\n"))
    return canonical.join(text, "page_id", "left").select("page_id", hyp.alias("hyp"), metric_norm(F.col("canonical")).alias("ref")).filter("ref <> ''")


def canonical_scores(regions: DataFrame, canonical: DataFrame, by: DataFrame, *keys: str) -> DataFrame:
    """keys, pages, cer, wer of whole pages against their ground truth, without a matcher; `by` has page_id and the keys."""
    e = _errors(page_pairs(regions, canonical)).join(by, "page_id")
    g = e.groupBy(*keys).agg(F.count("*").alias("pages"), *[F.sum(c).alias(c) for c in ("char_edits", "ref_chars", "word_edits", "ref_words")])
    return g.filter("ref_chars > 0").withColumn("cer", F.col("char_edits") / F.col("ref_chars")).withColumn("wer", F.col("word_edits") / F.col("ref_words"))


def score_run(regions: DataFrame, canonical: DataFrame, pages: DataFrame) -> DataFrame:
    """run_id, matched_cer, matched_wer, canonical_cer, canonical_wer: both ways of scoring side by side; null where a run has no ground truth of a kind."""
    by = pages.select("page_id", "run_id")
    matched = metrics.book_scores(metrics.page_scores(regions).join(by, "page_id"), "run_id").select("run_id", F.col("cer").alias("matched_cer"), F.col("wer").alias("matched_wer"))
    whole = canonical_scores(regions, canonical, by, "run_id").select("run_id", F.col("cer").alias("canonical_cer"), F.col("wer").alias("canonical_wer"))
    return by.select("run_id").distinct().join(matched, "run_id", "left").join(whole, "run_id", "left")


def macro_cer(ours: DataFrame, truth: DataFrame) -> DataFrame:
    """pages, cer: the older evaluation, the mean over pages of the error rate of (page_id, full_text)."""
    p = ours.select("page_id", notebook_norm(F.col("full_text")).alias("hyp")).join(truth.select("page_id", notebook_norm(F.col("full_text")).alias("ref")), "page_id")
    rate = metrics.char_edits(F.col("hyp"), F.col("ref")) / F.greatest(F.length("ref"), F.lit(1))
    return p.agg(F.count("*").alias("pages"), F.avg(rate).alias("cer"))


def swap_content(regions: DataFrame, merged: DataFrame) -> DataFrame:
    """Regions with the content of `merged` (page_id, region_index, text) where it has one; of several texts the smallest counts."""
    m = merged.filter("text is not null").groupBy("page_id", "region_index").agg(F.min("text").alias("_text"))
    return regions.join(m, ["page_id", "region_index"], "left").withColumn("content", F.coalesce("_text", "content")).drop("_text")


def variant_scores(regions: DataFrame, variants: dict[str, Callable[[DataFrame], Column]]) -> DataFrame:
    """variant, cer, wer of the regions with ground truth and a reading, their content given by each variant's column."""
    some = F.size(F.filter(F.coalesce("ensemble_readings", F.array().cast("array<string>")), lambda x: F.trim(x) != "")) > 0
    usable = metrics.scorable(regions).filter(some | (F.trim("content") != ""))
    one = lambda name, of: metrics.book_scores(metrics.page_scores(usable.withColumn("content", of(usable))).withColumn("variant", F.lit(name)), "variant")
    return reduce(DataFrame.unionByName, [one(name, of) for name, of in variants.items()]).select("variant", "char_edits", "ref_chars", "word_edits", "ref_words", "cer", "wer")


def union_runs(*runs: DataFrame) -> DataFrame:
    """Runs one after the other; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)


def slice_sorted(pages: DataFrame, keys: list[str], order: list[str], start: int | None = None, stop: int | None = None) -> DataFrame:
    """The rows of each group whose place in the given order lies in [start:stop]; negative places count from the end."""
    w = W.partitionBy(*keys)
    p = pages.withColumn("_at", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    place = lambda x: F.greatest(F.col("_n") + x, F.lit(0)) if x < 0 else F.lit(x)
    low = place(start) if start is not None else F.lit(0)
    high = place(stop) if stop is not None else F.col("_n")
    return p.filter((F.col("_at") >= low) & (F.col("_at") < high)).drop("_at", "_n")


def slips(ours: DataFrame, truth: DataFrame) -> DataFrame:
    """page_id, found, wanted: pasted slips of the pages both have."""
    count = lambda df, name: df.groupBy("page_id").agg(F.count_if(F.col("region_type") == "pasted_slip").alias(name))
    return count(ours, "found").join(count(truth, "wanted"), "page_id")


def link_and_check(mentions: DataFrame, names: DataFrame, register: DataFrame, pages: DataFrame, fuzzy: bool = True) -> tuple[DataFrame, DataFrame]:
    """(linked mentions in the audit's shape, all issues): exact and likeness stages for places and plants, and for persons full names, then surnames.

    Persons stand in `names` (name_id, page_id, entity_type, origin, text, normalized_form, surname); their links are
    ids of register rows with the prefix `person:`, and their order comes after that of the mentions."""
    found = linking.link(mentions, register, fuzzy).select("mention_id", "ehd_id", "method", "score", "ambiguous")
    linked = audit.linked_mentions(mentions, found, pages)
    people = names.filter("entity_type = 'Person' and origin = 'entity'")
    own = linking.link_surnames(names).select("name_id", F.concat(F.lit("person:"), F.col("register_id").cast("string")).alias("ehd_id"), "method", "score", "ambiguous")
    persons = audit.linked_mentions(people.withColumnRenamed("name_id", "mention_id"), own.withColumnRenamed("name_id", "mention_id"), pages)
    every = linked.unionByName(persons.withColumn("mention_id", F.col("mention_id") + (1 << 60)))
    return every, audit.issues(every)
