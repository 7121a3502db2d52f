"""Assignment of ground truth to regions: alignment page by page, snapping, filling, entities."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions import kernels

# Region types of the main stream, of margins, and those that alignment may fill.
MAIN = ("page_number", "entry_heading", "main_text", "bibliographic_ref", "coordinates", "calculation", "instrument_list", "catch_phrase", "crossed_out")
MARGIN = ("marginal_note", "pasted_slip")
FILL = ("page_number", "entry_heading", "main_text", "marginal_note", "pasted_slip", "bibliographic_ref", "coordinates", "catch_phrase")
ALIGNED, FILLED = 0.6, 0.5


def align(regions: DataFrame, truth: DataFrame) -> DataFrame:
    """region_id, ground_truth_content, confidence: verbatim stretches of the page's truth.

    `truth` has page_id, gt_index, gt_type, gt_content, gt_position. A page is one small group."""
    keep = ("page_id", "region_id", "region_index", "region_type", "content", "is_visual", "marginal_position")

    def one(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        ours, theirs = ours.sort_values(["region_index", "region_id"]), theirs.sort_values("gt_index")
        ours = ours[(ours["marginal_position"] != "opposite")]
        theirs = theirs[theirs["gt_content"].fillna("").str.strip() != ""]
        out = []
        main = ours[ours["region_type"].isin(MAIN) & ~ours["is_visual"].fillna(False).astype(bool)]
        stream = "\n".join(theirs[theirs["gt_type"].isin(MAIN)]["gt_content"]).strip()
        text = main["content"].fillna("").tolist()
        if stream and text:
            out += [(i, s, t) for i, s, t in zip(main["region_id"], kernels.tile(text, stream), text, strict=True) if s]
        margins, blocks = ours[ours["region_type"].isin(MARGIN)], theirs[theirs["gt_type"].isin(MARGIN)]
        a = list(zip(margins["content"].fillna(""), margins["marginal_position"], strict=True))
        b = list(zip(blocks["gt_content"], blocks["gt_position"], strict=True))
        for i, j in kernels.pair_margins(a, b).items():
            out.append((margins["region_id"].iloc[i], b[j][0].strip(), a[i][0]))
        rows = [(int(i), kernels.reflow(s, t), ALIGNED) for i, s, t in out]
        return pd.DataFrame(rows, columns=["region_id", "ground_truth_content", "confidence"])

    # pages without truth never reach Python
    held = truth.select(F.col("page_id").alias("_held")).distinct()
    regions = regions.select(*keep).join(held, F.col("page_id") == F.col("_held"), "left_semi").select(*[F.col(c).alias(c) for c in keep])
    grouped = regions.groupBy("page_id").cogroup(truth.groupBy("page_id"))
    return grouped.applyInPandas(one, "region_id long, ground_truth_content string, confidence double")


def fill(regions: DataFrame, aligned: DataFrame) -> DataFrame:
    """region_id, ground_truth_content, confidence: own truth kept, text regions without one filled by alignment."""
    has = F.coalesce(F.trim("ground_truth_content") != "", F.lit(False))
    a = aligned.select("region_id", F.col("ground_truth_content").alias("found"))
    j = regions.select("region_id", "region_type", "ground_truth_content", F.col("ground_truth_confidence").alias("own")).join(a, "region_id", "left")
    may = ~has & F.col("region_type").isin(*FILL) & F.col("found").isNotNull()
    return j.select("region_id", F.when(may, F.col("found")).otherwise(F.col("ground_truth_content")).alias("ground_truth_content"), F.when(may, F.lit(FILLED)).otherwise(F.col("own")).alias("confidence"))


def truth_blocks(regions: DataFrame) -> DataFrame:
    """Ground truth of pages as the aligner takes it, from regions that carry it."""
    t = regions.filter("trim(ground_truth_content) <> ''")
    return t.select("page_id", F.col("region_index").alias("gt_index"), F.col("region_type").alias("gt_type"), F.col("ground_truth_content").alias("gt_content"), F.col("marginal_position").alias("gt_position"))


def canonical_text(regions: DataFrame) -> DataFrame:
    """page_id, canonical: the page's ground truth in order, one block a line."""
    t = truth_blocks(regions).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("gt_index", "gt_content"))).alias("b"))
    return t.select("page_id", F.array_join(F.transform("b", lambda x: x["gt_content"]), "\n").alias("canonical"))


def accept_matches(regions: DataFrame, matches: DataFrame, canonical: DataFrame) -> DataFrame:
    """region_id, ground_truth_content, confidence of recorded matches (page_id, region_index, answer, confidence, ord).

    The last answer of a region counts; it is cut verbatim from the page's truth, or dropped; a blank region
    never keeps ground truth."""
    last = matches.groupBy("page_id", "region_index").agg(F.max_by(F.struct("answer", "confidence"), "ord").alias("m"))
    j = regions.filter("trim(content) <> ''").join(last, ["page_id", "region_index"]).join(canonical, "page_id")
    snapped = kernels.u_reflow(kernels.u_snap(F.col("m.answer"), F.col("canonical")), F.col("content"))
    return j.select("region_id", snapped.alias("ground_truth_content"), F.col("m.confidence").alias("confidence")).filter("ground_truth_content is not null")


def attach_entities(regions: DataFrame, mentions: DataFrame) -> DataFrame:
    """region_id, mention_id: mentions of the page whose text stands in the region's ground truth (case counts)."""
    r = regions.filter("ground_truth_content is not null").select("page_id", "region_id", "ground_truth_content")
    return r.join(mentions.select("page_id", "mention_id", "text").filter("text <> ''"), "page_id").filter(F.col("ground_truth_content").contains(F.col("text"))).select("region_id", "mention_id")
