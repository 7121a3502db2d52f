"""Error rates against ground truth, entity scores, spread over runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import kernels
from ..functions.text import metric_norm, notebook_norm

#: Region types that are scored, and the error rate from which a match is taken to be wrong.
SCORED = ("page_number", "entry_heading", "main_text", "marginal_note", "pasted_slip", "bibliographic_ref", "coordinates", "instrument_list", "calculation", "crossed_out", "catch_phrase")
BOGUS = 0.85


def scorable(regions: DataFrame, types: tuple[str, ...] = SCORED) -> DataFrame:
    """Text regions of a scored type with ground truth."""
    return regions.filter(F.col("region_type").isin(*types) & ~F.coalesce("is_visual", F.lit(False)) & (F.trim("ground_truth_content") != ""))


def char_edits(a, b):
    """Edit distance with the equality shortcut."""
    return F.when(a == b, 0).otherwise(F.levenshtein(a, b))


def region_scores(regions: DataFrame, types: tuple[str, ...] = SCORED, bogus: float = BOGUS) -> DataFrame:
    """region_id, page_id, region_index, hyp, ref, cer, dropped of regions with usable ground truth."""
    r = scorable(regions, types).select("region_id", "page_id", "region_index", metric_norm(F.col("content")).alias("hyp"), metric_norm(F.col("ground_truth_content")).alias("ref"))
    r = r.filter("ref <> ''").withColumn("cer", char_edits(F.col("hyp"), F.col("ref")) / F.length("ref"))
    return r.withColumn("dropped", F.col("cer") >= bogus)


def page_scores(regions: DataFrame, types: tuple[str, ...] = SCORED, bogus: float = BOGUS, drop_bogus: bool = True) -> DataFrame:
    """Scores of each page: kept regions in order, joined and aligned once. Pages without a kept region are absent."""
    s = region_scores(regions, types, bogus)
    if not drop_bogus:
        s = s.withColumn("dropped", F.lit(False))
    parts = F.array_sort(F.collect_list(F.when(~F.col("dropped"), F.struct("region_index", "region_id", "hyp", "ref"))))
    p = s.groupBy("page_id").agg(parts.alias("kept"), F.count_if(~F.col("dropped")).alias("n_regions"), F.count_if("dropped").alias("n_dropped")).filter("n_regions > 0")
    p = p.withColumn("hyp", F.trim(F.array_join("kept.hyp", " "))).withColumn("ref", F.trim(F.array_join("kept.ref", " "))).drop("kept")
    p = p.withColumn("char_edits", char_edits(F.col("hyp"), F.col("ref"))).withColumn("ref_chars", F.length("ref"))
    p = p.withColumn("word_edits", F.when(F.col("hyp") == F.col("ref"), 0).otherwise(kernels.u_word_edits("hyp", "ref"))).withColumn("ref_words", F.size(F.split("ref", " ")))
    return p.drop("hyp", "ref").withColumn("cer", F.col("char_edits") / F.col("ref_chars")).withColumn("wer", F.col("word_edits") / F.col("ref_words"))


def book_scores(pages: DataFrame, *by: str) -> DataFrame:
    """Micro-average of page scores: sums of edits over sums of lengths."""
    sums = [F.sum(c).alias(c) for c in ("char_edits", "ref_chars", "word_edits", "ref_words", "n_regions", "n_dropped")]
    b = pages.groupBy(*by).agg(*sums).filter("ref_chars > 0")
    return b.withColumn("cer", F.col("char_edits") / F.col("ref_chars")).withColumn("wer", F.col("word_edits") / F.col("ref_words"))


def spread_over_runs(scores: DataFrame, value: str, *by: str) -> DataFrame:
    """n, mean and population deviation of a value over runs; the deviation of one run is 0."""
    return scores.groupBy(*by).agg(F.count(value).alias("n"), F.round(F.avg(value), 6).alias("mean"), F.round(F.coalesce(F.stddev_pop(value), F.lit(0.0)), 6).alias("std"))


def quartiles(scores: DataFrame, value: str, *by: str) -> DataFrame:
    """Low, quartiles and high of a value, for a box plot."""
    return scores.groupBy(*by).agg(*[F.round(F.percentile(value, F.lit(q)), 6).alias(n) for q, n in ((0.0, "low"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "high"))])


def precision_recall(ours: DataFrame, theirs: DataFrame, *by: str) -> DataFrame:
    """tp, fp, fn, precision, recall, f1 over distinct (by, name, entity_type) rows; empty denominators count as 1."""
    keys = [*by, "name", "entity_type"]
    a, b = ours.select(*keys).distinct().withColumn("a", F.lit(1)), theirs.select(*keys).distinct().withColumn("b", F.lit(1))
    both = a.join(b, keys, "full").groupBy(*by).agg(F.count_if(F.expr("a = 1 and b = 1")).alias("tp"), F.count_if(F.expr("a = 1 and b is null")).alias("fp"), F.count_if(F.expr("a is null and b = 1")).alias("fn"))
    p, r = F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1)), F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))
    return both.withColumn("precision", F.round(p, 6)).withColumn("recall", F.round(r, 6)).withColumn("f1", F.round(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), 6))


def margin_recall(ours: DataFrame, truth: DataFrame) -> DataFrame:
    """page_id, found, n, recall: margins (page_id, content) of the truth of which one of the first five words stands in a margin of ours.

    Pages of `truth` without a margin have recall 0; words are those of the older evaluation."""
    words = lambda c: F.filter(F.split(notebook_norm(F.col(c)), " "), lambda w: w != "")
    margin = "region_type = 'marginal_note'"
    have = ours.filter(margin).select("page_id", F.explode(words("content")).alias("w")).groupBy("page_id").agg(F.collect_set("w").alias("have"))
    want = truth.select("page_id", F.expr(f"coalesce({margin}, false)").alias("is_margin"), F.slice(words("content"), 1, 5).alias("want"))
    hit = F.col("is_margin") & F.coalesce(F.arrays_overlap("want", "have"), F.lit(False))
    j = want.join(have, "page_id", "left").groupBy("page_id").agg(F.count_if(hit).alias("found"), F.count_if("is_margin").alias("n"))
    return j.withColumn("recall", F.round(F.col("found") / F.greatest("n", F.lit(1)), 6))
