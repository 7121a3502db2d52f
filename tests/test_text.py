import pytest
from pyspark.sql import functions as F

from quirelab.functions import geometry, kernels, text


def one(spark, column, *values):
    d = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return d.select(column(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


@pytest.mark.parametrize("given, want", [("Trow- bridge", "trowbridge"), ("D. fullon.", "d fullon"), (None, ""), ("  Große\nÉtoile ", "grosse etoile")])
def test_name_key(spark, given, want):
    assert one(spark, text.norm_key, given) == want
    assert kernels.key_exact(given) == want


@pytest.mark.parametrize("given, want", [("Mon[?]te", "mon te"), ("~~s~~als", "s als"), (None, ""), ("Süd-\nseite, ſo", "südseite so")])
def test_metric_text(spark, given, want):
    assert one(spark, text.metric_norm, given) == want


@pytest.mark.parametrize("given, label, key", [("H0019734__67r.jpg", "67r", 133), ("page_001.jpg", "001", 1), ("a__20r.jpg", "20r", 39), ("a__56v.png", "56v", 112), ("x", "x", 0)])
def test_folio(spark, given, label, key):
    assert one(spark, text.folio_label, given) == label
    assert one(spark, text.page_sort_key, given) == key


@pytest.mark.parametrize("given, want", [("[1r]", ["1r"]), ("067r", ["067r", "67r"]), ("fol. 67r", ["fol.67r", "67r"]), (None, [])])
def test_folio_variants(spark, given, want):
    assert one(spark, text.folio_variants, given) == want


@pytest.mark.parametrize("given, want", [("N. 50-52.", ["50", "51", "52"]), ("9)", ["9"]), ("N. 9-3", []), (None, [])])
def test_heading_numbers(spark, given, want):
    assert one(spark, text.heading_numbers, given) == want


def test_entry_numbers_in_order(spark):
    d = spark.createDataFrame([([("entry_heading", "N. 5-6"), ("main_text", "6) a"), ("main_text", "7) b"), ("main_text", None)],)], "rs array<struct<region_type:string,content:string>>")
    assert d.select(text.entry_numbers(F.col("rs")).alias("x")).first()["x"] == ["5", "6", "7"]


def test_notes_and_points(spark):
    assert one(spark, text.append_note, None, "a") == "a"
    assert one(spark, text.append_note, "a", "b") == "a | b"
    assert one(spark, text.append_note, "ab", "b") == "ab"
    assert one(spark, text.append_note, "a", " ") == "a"
    assert one(spark, lambda c: text.wkt_point(c)[0], "Point(16.37 48.2)") == 16.37
    assert one(spark, text.confidence, "x") == 0.0


def test_boxes(spark):
    d = spark.createDataFrame([([5.0, 870.0, 60.0, 980.0],), ([5.0, 980.0, 5.0, 870.0],), (None,)], "b array<double>")
    got = [r["x"] for r in d.select(geometry.pixels(F.col("b"), F.lit(1000), F.lit(2000)).alias("x")).collect()]
    assert tuple(got[0]) == (870, 10, 980, 120)
    assert got[1:] == [None, None]
