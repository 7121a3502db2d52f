import json

from pyspark.sql import functions as F

from quirelab.functions import geometry
from quirelab.operators import ground_truth, stages
from quirelab.sources import pages as io, tei


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_page_results_are_written_sparsely_and_in_order(spark, tmp_path):
    src = tmp_path / "run" / "page_1.json"
    src.parent.mkdir()
    src.write_text(json.dumps([{"page_number": 2, "regions": [{"content": "b"}]}, {"page_number": 1, "folio_label": "1r"}], indent=1))
    p = io.read_pages(spark, str(src.parent))
    assert {r["run"] for r in p.collect()} == {"run"}
    io.combined_json(p.drop("run"), str(tmp_path / "all.json"))
    assert json.loads((tmp_path / "all.json").read_text()) == [{"page_number": 1, "folio_label": "1r"}, {"page_number": 2, "regions": [{"content": "b"}]}]
    io.write_pages(p.drop("run"), str(tmp_path / "out"))
    assert {x.name for x in (tmp_path / "out").iterdir() if x.is_dir()} == {"page_number=1", "page_number=2"}
    m = spark.createDataFrame([(1, "Person", "A, B", 0, -1, None)], "page_id long, entity_type string, text string, start_char int, end_char int, context string")
    io.entity_csv(m, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first()["text"] == "A, B"


def test_images_and_manifests(spark, tmp_path):
    for name in ("X__2r.jpg", "X__1v.JPG", "X__1r.jpg", "notes.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert [r["folio_label"] for r in io.list_images(spark, str(tmp_path)).collect()] == ["1r", "1v", "2r"]
    canvas = lambda label, **r: {"label": label, "images": [{"resource": r}]}
    m = json.dumps({"sequences": [{"canvases": [canvas("f. 1", **{"@id": "http://a", "service": {"@id": "http://s"}}), canvas("2", **{"@id": "http://b"})]}]})
    got = io.manifest_images(spark.createDataFrame([(m,), ("{}",)], "json string"))
    assert rows(got) == [("2", 2, "http://b"), ("f._1", 1, "http://s/full/full/0/default.jpg")]


def test_tei_files_there_and_back(spark, tmp_path):
    f = spark.createDataFrame([(2, 2, '<pb n="2r"/><p>zwei</p>'), (1, 1, '<pb n="1r"/><p>eins</p>')], "page_id long, page_number int, fragment string")
    tei.document(f, "A & B", str(tmp_path / "x.xml"))
    got = tei.read_files(spark, str(tmp_path / "x.xml"))
    assert [(r["folio_label"], r["regions"][0]["content"]) for r in got.orderBy("page_number").collect()] == [("1r", "eins"), ("2r", "zwei")]


def test_reads_and_matches(spark):
    d = spark.createDataFrame([(1, 0, "main_text", True), (1, 1, "sketch", True), (1, 2, "main_text", False)], "page_id long, region_index int, region_type string, has_text boolean")
    a = spark.createDataFrame([(1, 0, "late", 2), (1, 0, "first", 1), (1, 9, "x", 1), (1, 1, "y", 1)], "page_id long, region_index int, content string, ord int")
    b = spark.createDataFrame([(1, 0, None)], "page_id long, region_index int, content string")
    assert rows(stages.collect_reads(d, a, b)) == [(1, 0, ["first", ""]), (1, 1, ["", ""]), (1, 2, ["", ""])]
    r = spark.createDataFrame([(1, 10, 0, "der  Flus"), (1, 11, 1, " "), (1, 12, 2, "qqqq")], "page_id long, region_id long, region_index int, content string")
    m = spark.createDataFrame([(1, 0, "nein", 0.1, 1), (1, 0, "der Fluss", 0.9, 2), (1, 1, "kalt", 0.9, 1), (1, 2, "zzzz", 0.9, 1)], "page_id long, region_index int, answer string, confidence double, ord int")
    c = spark.createDataFrame([(1, "Hier der Fluss war kalt")], "page_id long, canonical string")
    assert rows(ground_truth.accept_matches(r, m, c)) == [(10, "der Fluss", 0.9)]


def test_images_are_scaled_down_only(spark):
    d = spark.createDataFrame([(4000, 1000), (10, 20), (1, 9000)], "w int, h int")
    got = [tuple(x[0]) for x in d.select(geometry.fit(F.col("w"), F.col("h"), 2000)).collect()]
    assert got == [(2000, 500), (10, 20), (1, 2000)]
