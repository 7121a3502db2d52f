"""Merging of several readings of one region."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import kernels


def readings(regions: DataFrame) -> DataFrame:
    """region_id, ord, reading: non-blank readings in order."""
    x = regions.select("region_id", F.posexplode("ensemble_readings").alias("ord", "reading"))
    return x.filter("trim(reading) <> ''")


def votes(regions: DataFrame) -> DataFrame:
    """region_id, reading, n, first of each different reading, blanks around it removed."""
    r = readings(regions).withColumn("reading", F.trim("reading"))
    return r.groupBy("region_id", "reading").agg(F.count("*").alias("n"), F.min("ord").alias("first"))


def majority(regions: DataFrame) -> DataFrame:
    """region_id, reading: most votes, then longest, then first seen."""
    v = votes(regions)
    return v.groupBy("region_id").agg(F.max_by("reading", F.struct("n", F.length("reading"), -F.col("first"))).alias("reading"))


def annotations(regions: DataFrame) -> DataFrame:
    """region_id, votes: `reading (×n)` of each reading, most agreed and longest first."""
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("a"), (-F.length("reading")).alias("b"), "first", F.format_string("%s (×%d)", "reading", "n").alias("shown"))))
    return votes(regions).groupBy("region_id").agg(F.array_join(F.transform(order, lambda x: x["shown"]), " | ").alias("votes"))


def merge(regions: DataFrame) -> DataFrame:
    """region_id, template, markers, gaps, best, defaults (majority of each gap): the locked skeleton of each region with several different readings.

    Regions on which all agree need no alignment and take the built-in path."""
    r = regions.filter("size(ensemble_readings) > 0").select("region_id", "ensemble_readings")
    kinds = F.array_distinct(F.filter("ensemble_readings", lambda x: F.trim(x) != ""))
    one = r.filter(F.size(kinds) == 1).select("region_id", F.trim(F.regexp_replace(kinds[0], r"[ \t]+", " ")).alias("best"))
    one = one.select("region_id", F.col("best").alias("template"), F.lit("").alias("markers"), F.lit(0).alias("gaps"), "best", F.array().cast("array<string>").alias("defaults"))
    many = r.filter(F.size(kinds) > 1).select("region_id", kernels.u_skeleton("ensemble_readings").alias("s")).select("region_id", "s.template", "s.markers", "s.gaps", "s.best", "s.defaults")
    return one.unionByName(many)


def apply_choices(skeletons: DataFrame, choices: DataFrame) -> DataFrame:
    """region_id, text: gaps filled from recorded answers (region_id, gap, chosen); a gap without one takes its majority.

    Of several answers to a gap the smallest counts; a null answer is none, `∅` an omission."""
    one = choices.filter("chosen is not null").groupBy("region_id", "gap").agg(F.min("chosen").alias("chosen"))
    chosen = one.groupBy("region_id").agg(F.map_from_entries(F.collect_list(F.struct("gap", "chosen"))).alias("m"))
    j = skeletons.join(chosen, "region_id", "left")
    gap = r"^\[\[(M(\d+))\]\]$"
    answer = lambda p: F.coalesce(F.try_element_at("m", F.regexp_extract(p, gap, 1)), F.try_element_at("defaults", F.regexp_extract(p, gap, 2).cast("int")), F.lit(""))
    pieces = F.split(F.col("template"), r"(?=\[\[M\d+\]\])|(?<=\]\])")
    filled = F.transform(pieces, lambda p: F.when(p.rlike(gap), F.nullif(answer(p), F.lit("∅"))).otherwise(F.trim(p)))
    text = F.regexp_replace(F.array_join(F.filter(filled, lambda p: p != ""), " "), r"[ \t]+", " ")
    return j.select("region_id", F.trim(F.regexp_replace(text, r" *\n *", "\n")).alias("text"))


def oracle(regions: DataFrame) -> DataFrame:
    """region_id, text: the best any resolver could do, choosing gap by gap against ground truth."""
    r = regions.filter("size(ensemble_readings) > 0 and trim(ground_truth_content) <> ''")
    return r.select("region_id", kernels.u_oracle("ensemble_readings", "ground_truth_content").alias("text"))


def languages_union(regions: DataFrame) -> DataFrame:
    """region_id, languages: labels without repeats, in order."""
    return regions.select("region_id", F.array_distinct(F.filter(F.coalesce("languages", F.array().cast("array<string>")), lambda x: x.isNotNull())).alias("languages"))
