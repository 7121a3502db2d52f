"""Page results as JSON, images, registers: sources with explicit schemas, and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import folio_label, last_token, norm_key, page_sort_key

ENTITY = (
    "text STRING, entity_type STRING, start_char INT, end_char INT, context STRING, normalized_form STRING, language STRING, ehd_id STRING, ehd_url STRING, "
    "authority_uri STRING, authority_label STRING, link_method STRING, link_score DOUBLE, link_ambiguous BOOLEAN, link_candidates ARRAY<STRING>"
)
LOCATION = "name STRING, lat DOUBLE, lon DOUBLE, display_name STRING, wikidata_id STRING, geonames_id BIGINT, source STRING, resolved_query STRING"
REGION = (
    "region_type STRING, region_index INT, content STRING, is_visual BOOLEAN, table_data STRUCT<cells: ARRAY<ARRAY<STRING>>, caption: STRING>, languages ARRAY<STRING>, "
    "editorial_note STRING, position STRING, uncertain_readings ARRAY<STRING>, crossed_out_text STRING, related_to_entry STRING, bbox ARRAY<DOUBLE>, marginal_position STRING, "
    f"writing_layer STRING, tei_id STRING, ground_truth_content STRING, ground_truth_confidence DOUBLE, ground_truth_entities ARRAY<STRUCT<{ENTITY}>>, content_pre_consistency STRING, "
    "uncertain_readings_pre_consistency ARRAY<STRING>, region_reading STRING, ensemble_readings ARRAY<STRING>"
)
PAGE = (
    "page_number INT, image_filename STRING, folio_label STRING, full_text STRING, processing_timestamp STRING, model_used STRING, entry_numbers ARRAY<STRING>, "
    f"page_languages ARRAY<STRING>, regions ARRAY<STRUCT<{REGION}>>, entities ARRAY<STRUCT<{ENTITY}>>, locations ARRAY<STRUCT<{LOCATION}>>"
)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page results of a file or folder, one object or an array per file; `run` is the folder of each file."""
    d = spark.read.schema(PAGE).option("multiLine", True).json(path)
    return d.withColumn("run", F.element_at(F.split(F.input_file_name(), "/"), -2))


def write_pages(pages: DataFrame, path: str) -> None:
    """Sparse JSON, one page a line, in folders by page number; unset fields are left out."""
    pages.write.mode("overwrite").option("ignoreNullFields", True).partitionBy("page_number").json(path)


def page_json(pages: DataFrame) -> DataFrame:
    """page_number, json: each page as sparse JSON text."""
    return pages.select("page_number", F.to_json(F.struct(*pages.columns), {"ignoreNullFields": "true"}).alias("json"))


def combined_json(pages: DataFrame, path: str) -> None:
    """One JSON array of all pages in order, streamed to a file page by page."""
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for i, r in enumerate(page_json(pages).orderBy("page_number").toLocalIterator()):
            f.write(("," if i else "") + "\n" + r["json"])
        f.write("\n]\n")


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """path, name, folio_label, sort_key of the images in a folder, in foliation order; content is not read."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", "*.{jpg,jpeg,png,tif,tiff,JPG,JPEG,PNG,TIF,TIFF}").load(folder).select("path")
    f = f.withColumn("name", F.element_at(F.split("path", "/"), -1))
    return f.select("path", "name", folio_label(F.col("name")).alias("folio_label"), page_sort_key(F.col("name")).alias("sort_key")).orderBy("sort_key", "name")


def manifest_images(manifests: DataFrame) -> DataFrame:
    """label, seq, url of each canvas of IIIF manifests (json); seq counts from 1."""
    schema = "sequences ARRAY<STRUCT<canvases: ARRAY<STRUCT<label: STRING, images: ARRAY<STRUCT<resource: STRUCT<`@id`: STRING, service: STRUCT<`@id`: STRING>>>>>>>>"
    c = manifests.select(F.from_json("json", schema).alias("m")).select(F.posexplode(F.col("m.sequences")[0]["canvases"]).alias("i", "c"))
    r = F.col("c.images")[0]["resource"]
    return c.select(F.regexp_replace("c.label", r"[^\w.-]+", "_").alias("label"), (F.col("i") + 1).alias("seq"), F.coalesce(F.concat(r["service"]["@id"], F.lit("/full/full/0/default.jpg")), r["@id"]).alias("url"))


def entity_csv(mentions: DataFrame, path: str) -> None:
    mentions.select("page_id", "entity_type", "text", "start_char", "end_char", "context").write.mode("overwrite").option("header", True).csv(path)


def read_register(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """Register entries of an XML folder: rowTag `person`, `place` or `item`; malformed files and entries without a label are left out.

    Of entries with one id the first by file and place counts, and the names of the others are added to its own."""
    named = "ARRAY<STRUCT<_type: STRING, _VALUE: STRING, surname: STRING, forename: STRING>>"
    schema = f"`_xml:id` STRING, persName {named}, placeName {named}, label {named}, idno ARRAY<STRUCT<_type: STRING, _VALUE: STRING>>, note STRING, birth STRING, death STRING, linkGrp ARRAY<STRUCT<desc: STRING, ptr: STRUCT<_target: STRING, _n: STRING>>>"
    d = spark.read.format("xml").option("rowTag", tag).option("mode", "DROPMALFORMED").schema(schema).load(path).withColumn("file", F.regexp_extract(F.input_file_name(), r"([^/]+)\.xml$", 1))
    person = tag == "person"
    names = F.coalesce({"person": "persName", "place": "placeName"}.get(tag, "label"), F.array().cast(named))
    full = lambda x: F.coalesce(F.nullif(F.trim(x["_VALUE"]), F.lit("")), F.nullif(F.concat_ws(", ", F.nullif(F.trim(x["surname"]), F.lit("")), F.nullif(F.trim(x["forename"]), F.lit(""))), F.lit("")))
    reg = F.get(F.filter(names, lambda x: x["_type"] == "reg"), 0)
    with_parts = F.get(F.filter(names, lambda x: x["surname"].isNotNull() | x["forename"].isNotNull()), 0)
    label = F.coalesce(full(reg), full(with_parts)) if person else full(reg)
    # all other names of a person count, of places and plants those marked as such
    others = F.filter(names, lambda x: ~F.coalesce(x["_type"] == "reg", F.lit(False)) if person else x["_type"] == "alt")
    gbif = F.get(F.filter("linkGrp", lambda g: g["desc"].contains("GBIF") & g["ptr"]["_target"].isNotNull()), 0)["ptr"]
    uri = F.coalesce(F.get(F.filter("idno", lambda i: i["_type"] == "uri"), 0)["_VALUE"], gbif["_target"])
    kind = {"person": "person", "place": "place", "item": "plant"}.get(tag, tag)
    plant_id = F.coalesce(F.concat(F.lit("plant:gbif:"), F.substring_index(gbif["_target"], "/", -1)), F.concat(F.lit("plant:"), F.replace(norm_key(label), F.lit(" "), F.lit("_"))))
    r = d.select(
        (plant_id if kind == "plant" else F.coalesce("`_xml:id`", "file")).alias("ehd_id"), F.lit(kind).alias("kind"), label.alias("label"), uri.alias("authority_uri"), gbif["_n"].alias("authority_label"),
        F.filter(F.transform(others, full), lambda x: x.isNotNull()).alias("alt_labels"), F.coalesce(F.nullif(F.trim(with_parts["surname"]), F.lit("")), F.when(F.lit(person), last_token(label))).alias("surname"),
        "birth", "death", "note", F.struct("file", F.monotonically_increasing_id().alias("at")).alias("ord"),
    ).filter("label is not null")
    first = F.min_by(F.struct("label", "authority_uri", "authority_label", "surname", "birth", "death", "note"), "ord").alias("f")
    every = F.array_sort(F.collect_list(F.struct("ord", F.concat(F.array("label"), "alt_labels").alias("names"))))
    merged = r.groupBy("ehd_id", "kind").agg(first, F.array_distinct(F.flatten(F.transform(every, lambda x: x["names"]))).alias("names"))
    return merged.select("ehd_id", "kind", "f.*", F.filter("names", lambda x: x != F.col("f.label")).alias("alt_labels"))
