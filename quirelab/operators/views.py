"""Tables behind the reading view: legend, labels of register ids, panels of a page, images that exist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import pages

# Region types in the order of the legend.
LEGEND = ("entry_heading", "main_text", "marginal_note", "pasted_slip", "calculation", "observation_table", "instrument_list", "sketch", "crossed_out", "page_number")


def legend_key(kind: Column) -> Column:
    """Place in the legend; types it does not know come last, by name."""
    at = F.array_position(F.array(*map(F.lit, LEGEND)), kind)
    return F.struct(F.when(at > 0, at).otherwise(F.lit(1000)).alias("place"), kind.alias("name"))


def legend(regions: DataFrame) -> DataFrame:
    """journal_id, types: the region types of a journal in legend order."""
    used = regions.filter("region_type is not null").select("journal_id", "region_type").distinct()
    return used.groupBy("journal_id").agg(F.transform(F.array_sort(F.collect_list(legend_key(F.col("region_type")))), lambda x: x["name"]).alias("types"))


def with_labels(ids: DataFrame, register: DataFrame) -> DataFrame:
    """`ids` (ehd_id, ...) with `label`: the register's, else the id itself; of several entries with one id the smallest label."""
    one = register.groupBy("ehd_id").agg(F.min(F.trim("label")).alias("_label"))
    return ids.join(one, "ehd_id", "left").withColumn("label", F.coalesce("_label", "ehd_id")).drop("_label")


def with_image(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows whose image_filename is among the files that exist (name)."""
    return rows.join(files.select(F.col("name").alias("image_filename")), "image_filename", "left_semi")


def panels(page_rows: DataFrame, regions: DataFrame) -> DataFrame:
    """page_id, folio_label, heading, text, boxes: what a page's panel shows; boxes as [region_id, left, top, width, height] in reading order."""
    boxes = pages.rectangles(regions).join(pages.reading_order(regions), "region_id")
    shown = boxes.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("position", "region_id", "left", "top", "width", "height"))).alias("boxes"))
    p = page_rows.select("page_id", "folio_label")
    return p.join(pages.contents(regions), "page_id", "left").join(pages.copy_text(regions), "page_id", "left").join(shown, "page_id", "left")
