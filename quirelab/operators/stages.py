"""Stages that apply recorded answers of models and services: detections, reads, layout, entities, places.

Answers come as tables; nothing here calls a model or the network."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import kernels
from ..functions.text import append_note, confidence

# Accepted margin positions, writing layers and entity types.
POSITIONS = ("left", "right", "mTop", "mBottom", "opposite", "inline")
#: Word in a free position text -> margin position; the first that occurs counts.
SAID = (("left", "left"), ("right", "right"), ("top", "mTop"), ("bottom", "mBottom"), ("opposite", "opposite"), ("bleed", "opposite"))
LAYERS = ("primary", "later_addition", "unknown")
ANSWER_KEYS = ("matches", "regions", "results", "items", "data", "ground_truth", "mappings", "output")
ENTITY_TYPES = ("Person", "Location", "Species", "Instrument", "Measurement", "Publication", "Indigenous_Group", "Celestial_Object")


def clean_detections(detections: DataFrame) -> DataFrame:
    """page_id, region_index (renumbered), region_type, has_text, marginal_position, bbox from raw detections in order `ord`.

    The position of a margin that has none (null or empty) is read from the free position text; a given one that
    is not among POSITIONS becomes null, whatever the text says; the facing page's margin has no text of its own."""
    free = F.lower(F.coalesce("position", F.lit("")))
    given = F.col("marginal_position")
    inferred = reduce(lambda rest, x: F.when(free.contains(x[0]), x[1]).otherwise(rest), reversed(SAID), given)
    missing = given.isNull() | (given == "")
    place = F.when(missing & (F.col("region_type") == "marginal_note"), inferred).when(missing | given.isin(*POSITIONS), given)
    w = W.partitionBy("page_id").orderBy("ord")
    d = detections.withColumn("marginal_position", place).withColumn("region_index", F.row_number().over(w) - 1)
    return d.withColumn("has_text", F.when(F.col("marginal_position") == "opposite", False).otherwise(F.coalesce("has_text", F.lit(True)))).select("page_id", "region_index", "region_type", "has_text", "marginal_position", "bbox")


def force_empty(d: DataFrame) -> Column:
    """Regions that are given no reading."""
    return (~d["has_text"]) | (d["region_type"] == "sketch")


def collect_reads(detections: DataFrame, *reads: DataFrame) -> DataFrame:
    """page_id, region_index, candidates: one reading per source in order; missing ones are ''.

    Each source has page_id, region_index, content and, where regions repeat, ord: the first by it counts (without
    it the smallest text); unknown regions are ignored."""
    out = detections.select("page_id", "region_index", force_empty(detections).alias("empty"))
    names = []
    for i, r in enumerate(reads):
        first = F.min_by("content", "ord") if "ord" in r.columns else F.min("content")
        one = r.filter("content is not null").groupBy("page_id", "region_index").agg(first.alias(f"_{i}"))
        out = out.join(one, ["page_id", "region_index"], "left")
        names.append(F.when(F.col("empty"), "").otherwise(F.coalesce(f"_{i}", F.lit(""))))
    return out.select("page_id", "region_index", F.array(*names).alias("candidates"))


def apply_layout(regions: DataFrame, decisions: DataFrame) -> DataFrame:
    """Regions (all their columns, issue, severity) after layout decisions (page_id, region_index, drop, duplicate_of, new_languages, new_layer, note, ord).

    The last decision of a region counts. Dropped and duplicate regions are emptied and noted; others take
    languages, layer and note; wording is never changed and the earlier content is kept. Emptied regions have no
    uncertain readings."""
    last = decisions.groupBy("page_id", "region_index").agg(F.max_by(F.struct("drop", "duplicate_of", "new_languages", "new_layer", "note"), "ord").alias("_d"))
    j = regions.join(last, ["page_id", "region_index"], "left")
    d = F.col("_d")
    dup = F.coalesce(d["duplicate_of"] != F.col("region_index"), F.lit(False))
    gone = F.coalesce(d["drop"], F.lit(False)) | dup
    why = F.when(dup, F.concat(F.lit("Duplicate of region "), d["duplicate_of"].cast("string"), F.lit(" — removed here."))).when(gone, "Dropped by layout pass (not this region's text).")
    note = append_note(F.when(gone, append_note(F.col("editorial_note"), why)).otherwise(F.col("editorial_note")), F.trim(d["note"]))
    layer = F.when(~gone & F.trim(d["new_layer"]).isin(*LAYERS), F.trim(d["new_layer"])).otherwise(F.col("writing_layer"))
    languages = F.when(~gone & (F.size(d["new_languages"]) > 0), d["new_languages"]).otherwise(F.col("languages"))
    issue = F.when(dup, "duplicate_text").when(gone, "dropped_region").when(F.trim(d["note"]) != "", "editorial_note")
    new = {
        "content": F.when(gone, "").otherwise(F.col("content")), "content_pre_consistency": F.coalesce("content_pre_consistency", "content"),
        "languages": languages, "writing_layer": layer, "editorial_note": note, "issue": issue, "severity": F.when(issue.isNotNull(), "warning"),
    }
    if "uncertain_readings" in regions.columns:
        new["uncertain_readings"] = F.when(gone, F.array().cast("array<string>")).otherwise(F.col("uncertain_readings"))
    return j.select(*[F.col(c) for c in regions.columns if c not in new], *[x.alias(c) for c, x in new.items()])


def duplicate_decisions(regions: DataFrame) -> DataFrame:
    """Layout decisions that mark later regions of a page with the same non-blank content as duplicates of the first."""
    w = W.partitionBy("page_id", "content").orderBy("region_index", "region_id")
    r = regions.filter("trim(content) <> '' and not coalesce(is_visual, false)").select("page_id", "content", "region_index", "region_id").withColumn("of", F.first("region_index").over(w)).withColumn("n", F.row_number().over(w))
    r = r.filter("n > 1 and of <> region_index")
    return r.select("page_id", "region_index", F.lit(False).alias("drop"), F.col("of").alias("duplicate_of"), F.lit(None).cast("array<string>").alias("new_languages"), F.lit(None).cast("string").alias("new_layer"), F.lit(None).cast("string").alias("note"), F.col("region_id").alias("ord"))


def valid_entities(answers: DataFrame) -> DataFrame:
    """Entities of known type and non-blank text, the first of each (page, text, type) by `ord`."""
    ok = answers.filter(F.col("entity_type").isin(*ENTITY_TYPES) & (F.trim("text") != ""))
    w = W.partitionBy("page_id", "text", "entity_type").orderBy("ord")
    return ok.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def names_to_resolve(mentions: DataFrame, cache: DataFrame) -> DataFrame:
    """name, context: distinct place names that the cache (name, found) doesn't have, with their first context."""
    m = mentions.filter("entity_type = 'Location'").select(F.coalesce(F.nullif(F.trim("normalized_form"), F.lit("")), F.trim("text")).alias("name"), "context", "mention_id").filter("name <> ''")
    return m.groupBy("name").agg(F.min_by("context", "mention_id").alias("context")).join(cache.select("name"), "name", "left_anti")


def resolve_places(names: DataFrame, *gazetteers: DataFrame) -> DataFrame:
    """name, lat, lon, source, found: the first gazetteer (name, lat, lon, source) that has a name; misses are kept as such.

    Of several entries of a name the first by source, then latitude and longitude counts."""
    every = [g.groupBy("name").agg(F.min_by(F.struct("lat", "lon", "source"), F.struct("source", "lat", "lon")).alias("p")).withColumn("stage", F.lit(i)) for i, g in enumerate(gazetteers)]
    best = reduce(DataFrame.unionByName, every).groupBy("name").agg(F.min_by("p", "stage").alias("p"))
    return names.select("name").distinct().join(best, "name", "left").select("name", "p.lat", "p.lon", "p.source", F.col("p").isNotNull().alias("found"))


def validate_places(places: DataFrame, verdicts: DataFrame, *gazetteers: DataFrame) -> DataFrame:
    """Places after verdicts (name, verdict, confidence, suggested_query, ord): invalid ones are looked up again
    under the suggestion if it differs, else dropped; without a verdict a place stays."""
    v = verdicts.groupBy("name").agg(F.max_by(F.struct("verdict", confidence(F.col("confidence")).alias("confidence"), "suggested_query"), "ord").alias("v"))
    j = places.filter("found").join(v, "name", "left")
    bad = F.coalesce(F.col("v.verdict") == "invalid", F.lit(False))
    kept = j.filter(~bad).select("name", "lat", "lon", "source", F.col("name").alias("resolved_query"))
    retry = j.filter(bad).select("name", F.trim("v.suggested_query").alias("query")).filter("query <> '' and query <> name")
    again = retry.join(resolve_places(retry.select(F.col("query").alias("name")), *gazetteers).filter("found").withColumnRenamed("name", "query"), "query")
    return kept.unionByName(again.select("name", "lat", "lon", "source", F.col("query").alias("resolved_query")))


def centroid(places: DataFrame) -> DataFrame:
    """Mean latitude and longitude of the found places."""
    return places.filter("lat is not null and lon is not null").agg(F.round(F.avg("lat"), 6).alias("lat"), F.round(F.avg("lon"), 6).alias("lon"), F.count("*").alias("n"))


def list_answer(raw: Column) -> Column:
    """A model's list as array of JSON texts, also when an object holds it.

    Of an object: the list under the first known key that has one, else the first list that is empty or begins with
    an object, else the object itself if it has a region_index. Anything else is the empty list. Of a key that is
    repeated the last value counts; what the built-in parser refuses (that, NaN) goes to Python."""
    as_list = lambda x: F.try_variant_get(x, "$", "array<variant>")
    as_map = lambda x: F.try_variant_get(x, "$", "map<string,variant>")

    def items(v):
        known = [F.try_variant_get(v, f"$.{k}", "array<variant>") for k in ANSWER_KEYS]
        lists = F.map_filter(as_map(v), lambda k, x: (F.size(as_list(x)) == 0) | as_map(F.get(as_list(x), 0)).isNotNull())
        # the order of keys is that of the text
        any_list = as_list(F.try_element_at(lists, F.get(F.array_intersect(F.json_object_keys(raw), F.map_keys(lists)), 0)))
        single = F.when(F.try_variant_get(v, "$.region_index", "variant").isNotNull(), F.array(v))
        return F.transform(F.coalesce(as_list(v), *known, any_list, single, F.array().cast("array<variant>")), lambda x: F.to_json(x))

    # the parser passes over what follows a value: here a mark must follow that no text holds by chance
    pair = as_list(F.try_parse_json(F.concat(F.lit("["), raw, F.lit(',"'), F.md5(raw), F.lit('"]'))))
    whole = F.coalesce((F.size(pair) == 2) & (F.try_variant_get(F.get(pair, 1), "$", "string") == F.md5(raw)), F.lit(False))
    native = F.when(whole, F.get(F.transform(F.slice(pair, 1, 1), items), 0))
    return F.coalesce(native, kernels.u_list_answer(F.when(~whole, raw), F.lit(",".join(ANSWER_KEYS))), F.array().cast("array<string>"))
