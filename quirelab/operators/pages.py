"""Pages from their regions: text, languages, entry numbers, reading order, view tables, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import geometry
from ..functions.text import entry_numbers, folio_variants, norm_folio, preview, strip

TABLE = "observation_table"


def region_text_parts(r: Column) -> Column:
    """Text parts of one region: the non-blank cells of a table, else its content."""
    cells = F.filter(F.flatten(r["table_data"]["cells"]), lambda c: F.trim(c) != "")
    return F.when((r["region_type"] == TABLE) & r["table_data"].isNotNull(), F.coalesce(cells, F.array().cast("array<string>"))).otherwise(F.array(F.coalesce(r["content"], F.lit(""))))


def _ordered(regions: DataFrame, *columns: str) -> DataFrame:
    """page_id, rs: regions of each page as structs in order."""
    return regions.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("region_index", "region_id", *columns))).alias("rs"))


def full_text(regions: DataFrame) -> DataFrame:
    """page_id, full_text: non-visual regions in order, tables as cells, joined by a blank line."""
    p = _ordered(regions, "region_type", "content", "is_visual", "table_data")
    shown = F.filter("rs", lambda r: ~F.coalesce(r["is_visual"], F.lit(False)))
    parts = F.filter(F.flatten(F.transform(shown, region_text_parts)), lambda t: F.trim(t) != "")
    return p.select("page_id", F.array_join(parts, "\n\n").alias("full_text"))


def page_languages(regions: DataFrame) -> DataFrame:
    """page_id, languages: sorted distinct labels of the regions."""
    x = regions.select("page_id", F.explode_outer("languages").alias("l"))
    return x.groupBy("page_id").agg(F.array_sort(F.collect_set(F.nullif("l", F.lit("")))).alias("languages"))


def page_entries(regions: DataFrame) -> DataFrame:
    """page_id, entry_numbers from headings and from the starts of main text, in reading order."""
    return _ordered(regions.filter(F.col("region_type").isin("entry_heading", "main_text")), "region_type", "content").select("page_id", entry_numbers(F.col("rs")).alias("entry_numbers"))


def table_text(regions: DataFrame) -> DataFrame:
    """region_id, flat: cells joined by two blanks, rows by line breaks; null cells are empty."""
    rows = F.transform("table_data.cells", lambda row: F.array_join(F.transform(F.coalesce(row, F.array().cast("array<string>")), lambda c: F.coalesce(c, F.lit(""))), "  "))
    return regions.filter("table_data is not null").select("region_id", F.array_join(F.coalesce(rows, F.array().cast("array<string>")), "\n").alias("flat"))


def reading_order(regions: DataFrame) -> DataFrame:
    """region_id, page_id, position: top to bottom, then left to right; regions without a box last."""
    has = F.col("bbox").isNotNull() & (F.size("bbox") == 4)
    w = W.partitionBy("page_id").orderBy((~has).cast("int"), F.when(has, F.col("bbox")[0]).asc_nulls_last(), F.when(has, F.col("bbox")[1]).asc_nulls_last(), "region_index", "region_id")
    return regions.select("region_id", "page_id", F.row_number().over(w).alias("position"))


def rectangles(regions: DataFrame) -> DataFrame:
    """region_id and its rectangle in percent of the page."""
    return regions.select("region_id", geometry.percent(F.col("bbox")).alias("p")).filter("p is not null").select("region_id", *[F.round(F.col("p")[c], 4).alias(c) for c in ("left", "top", "width", "height")])


def crops(regions: DataFrame, width: int = 3000, height: int = 4000) -> DataFrame:
    """region_id and its padded pixel crop on an image of the given size."""
    w, h = F.lit(width), F.lit(height)
    box = geometry.crop(geometry.pixels(F.col("bbox"), w, h), w, h)
    return regions.select("region_id", box.alias("p")).filter("p is not null").select("region_id", "p.left", "p.top", "p.right", "p.bottom")


def other_boxes(regions: DataFrame) -> DataFrame:
    """region_id, other_id: the boxes to mask in each region's crop, all others of its page."""
    b = regions.filter("size(bbox) = 4").select("page_id", "region_id")
    return b.join(b.withColumnRenamed("region_id", "other_id"), "page_id").filter("region_id <> other_id").select("region_id", "other_id")


def contents(regions: DataFrame) -> DataFrame:
    """page_id, heading: the first 72 characters of a page's first heading, else of its first main text, blanks around them removed; null if it has neither."""
    r = regions.groupBy("page_id").agg(*[F.min_by(F.when((F.col("region_type") == t) & (F.col("content") != ""), F.col("content")), F.when((F.col("region_type") == t) & (F.col("content") != ""), F.struct("region_index", "region_id"))).alias(t) for t in ("entry_heading", "main_text")])
    return r.select("page_id", F.coalesce(F.nullif(preview(F.col("entry_heading")), F.lit("")), F.replace(preview(F.col("main_text")), F.lit("\n"), F.lit(" "))).alias("heading"))


def copy_text(regions: DataFrame) -> DataFrame:
    """page_id, text: plain copy of a page in reading order; headings framed, margins and page numbers labelled, parts a blank line apart."""
    box = F.col("bbox")
    has = F.coalesce(F.size(box) == 4, F.lit(False))
    r = regions.withColumn("content", strip(F.coalesce("content", F.lit("")))).filter("content <> ''")
    shown = (
        F.when(F.col("region_type") == "entry_heading", F.concat(F.lit("\n=== "), "content", F.lit(" ===\n"))).when(F.col("region_type") == "marginal_note", F.concat(F.lit("[margin "), F.coalesce("marginal_position", F.lit("")), F.lit("] "), "content"))
        .when(F.col("region_type") == "page_number", F.concat(F.lit("[page_number] "), "content")).otherwise(F.col("content"))
    )
    parts = F.array_sort(F.collect_list(F.struct((~has).alias("boxless"), F.when(has, box[0]).alias("y"), F.when(has, box[1]).alias("x"), "region_index", "region_id", shown.alias("t"))))
    return r.groupBy("page_id").agg(strip(F.array_join(F.transform(parts, lambda x: x["t"]), "\n\n")).alias("text"))


def gt_lookup(pages: DataFrame, truth: DataFrame) -> DataFrame:
    """page_id, gt_page_id: ground-truth page of the same journal by the first folio variant that has one.

    Of several ground-truth pages with one label the last (largest page_id) counts."""
    index = truth.select("journal_id", norm_folio(F.col("folio_label")).alias("k"), F.col("page_id").alias("gt_page_id")).filter("k <> ''").groupBy("journal_id", "k").agg(F.max("gt_page_id").alias("gt_page_id"))
    asked = pages.select("page_id", "journal_id", F.posexplode(folio_variants(F.col("folio_label"))).alias("rank", "k"))
    return asked.join(index, ["journal_id", "k"]).groupBy("page_id").agg(F.min_by("gt_page_id", "rank").alias("gt_page_id"))


def gt_coverage(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """journal_id, pages, with_gt, regions_with_gt, empty: pages that have ground truth in any region."""
    g = regions.groupBy("page_id").agg(F.count_if(F.trim("ground_truth_content") != "").alias("n"))
    j = pages.join(g, "page_id", "left")
    return j.groupBy("journal_id").agg(F.count("*").alias("pages"), F.count_if(F.expr("n > 0")).alias("with_gt"), F.coalesce(F.sum("n"), F.lit(0)).alias("regions_with_gt"), F.count_if(F.expr("n is null")).alias("empty"))


def unprocessed(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """Pages to (re)process: those without a region."""
    return pages.join(regions.select("page_id").distinct(), "page_id", "left_anti")


def carry(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Fill gaps with the last value before, then with the first after."""
    w = W.partitionBy(*keys).orderBy(*order)
    before = F.last(value, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    after = F.first(value, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))
    return df.withColumn(name, F.coalesce(before, after))


def islands(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """keys, island, value, n: runs of equal neighbouring values."""
    w = W.partitionBy(*keys).orderBy(*order)
    new = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("_new", new).withColumn("island", F.sum("_new").over(w)).groupBy(*keys, "island").agg(F.first(value).alias(value), F.count("*").alias("n"))
