import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from quirelab import session
from quirelab.functions import kernels
from quirelab.operators import ensemble, metrics, providers, runs, stages, views
from quirelab.sources import pages as page_files, stores, tei


def rows(df):
    return sorted(tuple(r) for r in df.collect())


REGION = "page_id long, region_id long, region_index int, region_type string, content string, is_visual boolean, ground_truth_content string, ensemble_readings array<string>"


def test_slices_work_like_lists(spark):
    p = spark.createDataFrame([(j, i) for j in "ab" for i in range(5 if j == "a" else 2)], "j string, i int")
    for start, stop in ((1, -1), (-3, None), (None, 2), (2, 9), (-9, -9), (None, None)):
        want = sorted((j, i) for j in "ab" for i in list(range(5 if j == "a" else 2))[start:stop])
        assert rows(runs.slice_sorted(p, ["j"], ["i"], start, stop)) == want
    assert runs.slice_sorted(p.limit(0), ["j"], ["i"], 1).count() == 0


def test_scores_of_whole_pages(spark):
    r = spark.createDataFrame([(1, 1, 0, "main_text", "der Fluss", False, "der Fluss", None), (1, 2, 1, "sketch", "x", True, None, None), (1, 3, 2, "main_text", "kalt", None, "alt", None), (2, 4, 0, "main_text", None, None, None, None)], REGION)
    canonical = spark.createDataFrame([(1, "der Fluss\nalt"), (2, "neu"), (3, " ")], "page_id long, canonical string")
    by = spark.createDataFrame([(1, "R"), (2, "R"), (3, "R"), (4, "S")], "page_id long, run_id string")
    got = {x["run_id"]: x for x in runs.canonical_scores(r, canonical, by, "run_id").collect()}
    assert (got["R"]["char_edits"], got["R"]["ref_chars"], got["R"]["pages"]) == (1 + 3, 13 + 3, 2)
    score = {x["run_id"]: x for x in runs.score_run(r, canonical, by).collect()}
    assert score["S"]["canonical_cer"] is None and score["R"]["matched_cer"] == 1 / 13
    full = spark.createDataFrame([(1, "ab"), (2, "")], "page_id long, full_text string")
    truth = spark.createDataFrame([(1, "ax"), (2, ""), (5, "z")], full.schema)
    assert [tuple(x) for x in runs.macro_cer(full, truth).collect()] == [(2, 0.25)]
    assert runs.macro_cer(full.limit(0), truth).first()["pages"] == 0


def test_variants_and_swaps(spark):
    r = spark.createDataFrame([(1, 1, 0, "main_text", "abxd", None, "abcd", ["abcd", "abxd"]), (1, 2, 1, "main_text", "q", None, None, None)], REGION)
    merged = spark.createDataFrame([(1, 0, "zz"), (1, 0, "aa"), (1, 1, None)], "page_id long, region_index int, text string")
    assert rows(runs.swap_content(r, merged).select("region_id", "content")) == [(1, "aa"), (2, "q")]
    v = runs.variant_scores(r, {"own": lambda d: F.col("content"), "first": lambda d: F.get("ensemble_readings", 0)})
    assert {x["variant"]: x["cer"] for x in v.collect()} == {"own": 0.25, "first": 0.0}


def test_gaps_without_an_answer_take_their_majority(spark):
    r = spark.createDataFrame([(1, ["a b c x e", "a d c y e", "a b c x e"]), (2, ["q", "q"])], "region_id long, ensemble_readings array<string>")
    s = ensemble.merge(r)
    none = spark.createDataFrame([], "region_id long, gap string, chosen string")
    assert rows(ensemble.apply_choices(s, none)) == [(1, "a b c x e"), (2, "q")]
    some = spark.createDataFrame([(1, "M2", "∅"), (1, "M9", "no"), (1, "M1", None)], none.schema)
    assert rows(ensemble.apply_choices(s, some)) == [(1, "a b c e"), (2, "q")]


def test_providers(spark):
    asked = spark.createDataFrame([(1,), (2,), (3,)], "request long")
    said = spark.createDataFrame([(1, 1, "[1]"), (1, 2, "[2]"), (1, 3, "[3"), (2, 1, "no"), (9, 1, "[]")], "request long, ord int, reply string")
    assert rows(providers.answered(asked, said)) == [(1, True, "[2]"), (2, False, "[]"), (3, False, "[]")]
    m = spark.createDataFrame([("HTTP 503",), ("Connection lost",), ("bad key",), (None,)], "m string")
    assert [x[0] for x in m.select(providers.is_retryable(F.col("m"))).collect()] == [True, True, False, False]
    assert [x[0] for x in m.select(providers.attempts_left(F.lit(3), F.col("m"))).collect()] == [True, True, False, False]
    s = providers.Settings(stages={"layout": {"thinking": "high"}})
    assert s.of("layout") == ("recorded", "high") and s.of("x") == ("recorded", "medium")
    assert providers.Settings.from_env("Q_", {"Q_MODEL": "m", "Q_CONCURRENCY": "many"}) == providers.Settings(model="m")
    d = spark.createDataFrame([(1, 0, "sketch", True, None, None), (1, 1, "marginal_note", True, "opposite", None), (1, 2, "main_text", None, None, [1.0])], "page_id long, region_index int, region_type string, has_text boolean, marginal_position string, bbox array<double>")
    read = spark.createDataFrame([(1, 1, "x", ["de"], False, None), (1, 2, "un[?] y", None, None, "n")], "page_id long, region_index int, content string, languages array<string>, is_visual boolean, editorial_note string")
    got = {x["region_index"]: x for x in providers.reconstruct(d, read).collect()}
    assert got[0]["is_visual"] and got[1]["content"] == "" and got[1]["editorial_note"] == providers.OPPOSITE_NOTE
    assert got[2]["uncertain_readings"] == ["un[?]"] and got[2]["languages"] == [] and not got[2]["is_visual"]


def test_answers_of_all_shapes(spark):
    raw = ['[{"a": 1}]', '{"items": [1, 2], "matches": [3]}', '{"x": 1, "odd": [{"b": 2}], "late": []}', '{"region_index": 4}', '{"q": 1}', '{"list": [1]}', "no", None, "3", '{"regions": {"a": 1}}']
    d = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, raw string")
    got = {r["i"]: [json.loads(x) for x in r["x"]] for r in d.select("i", stages.list_answer(F.col("raw")).alias("x")).collect()}
    assert got == {0: [{"a": 1}], 1: [3], 2: [{"b": 2}], 3: [{"region_index": 4}], 4: [], 5: [], 6: [], 7: [], 8: [], 9: []}


def test_answers_that_look_like_lists(spark):
    """Texts are no lists, what follows a value spoils it, of a repeated key the last value counts, the first list of a text counts."""
    raw = [
        '{"note": "[]", "x": [{"a": 1}]}', '{"note": "[{}, {}]"}', '{"note": "[{ x", "region_index": 2}', '[1] 2', '[1],0] x', '[1]],[2', '{"x": [{}]} y',
        '{"matches": [1], "matches": [2, 3]}', '[{"k": 1, "k": "ü"}]', '{"regions": {}, "z": [{"a": 1}, {"b": 2}], "a": []}', '{"a\\"b.c": [{"d": [NaN]}]}', '{"x": [[{}]], "y": [null, {}]}', "[" * 100_000, " ", ",",
    ]
    d = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, raw string")
    got = [[json.loads(x) for x in r["x"]] for r in d.select("i", stages.list_answer(F.col("raw")).alias("x")).orderBy("i").collect()]
    assert got[:10] == [[{"a": 1}], [], [{"note": "[{ x", "region_index": 2}], [], [], [], [], [2, 3], [{"k": "ü"}], [{"a": 1}, {"b": 2}]]
    assert len(got[10]) == 1 and got[11:] == [[], [], [], []]


def test_margin_positions(spark):
    given = [("marginal_note", None, "LEFT side"), ("marginal_note", "", "at the bottom"), ("marginal_note", "Left", "right"), ("marginal_note", "mTop", "left"), ("main_text", None, "left"), ("main_text", "weird", None), ("marginal_note", None, "bleed"), ("marginal_note", None, None)]
    d = spark.createDataFrame([(1, i, t, True, p, m, None) for i, (t, m, p) in enumerate(given)], "page_id long, ord int, region_type string, has_text boolean, position string, marginal_position string, bbox array<double>")
    got = [(r["marginal_position"], r["has_text"]) for r in stages.clean_detections(d).orderBy("region_index").collect()]
    assert got == [("left", True), ("mBottom", True), (None, True), ("mTop", True), (None, True), (None, True), ("opposite", False), (None, True)]


def test_margin_recall(spark):
    s = "page_id long, region_type string, content string"
    truth = spark.createDataFrame([(1, "marginal_note", "eins, zwei drei"), (1, "marginal_note", "q r"), (2, "main_text", "x"), (3, "marginal_note", None)], s)
    ours = spark.createDataFrame([(1, "marginal_note", "Zwei"), (1, "main_text", "q"), (2, "marginal_note", "x")], s)
    assert rows(metrics.margin_recall(ours, truth)) == [(1, 1, 2, 0.5), (2, 0, 0, 0.0), (3, 0, 1, 0.0)]


def test_views(spark):
    r = spark.createDataFrame([("J", "zebra"), ("J", "page_number"), ("J", "entry_heading"), ("J", "apple"), ("J", None)], "journal_id string, region_type string")
    assert views.legend(r).first()["types"] == ["entry_heading", "page_number", "apple", "zebra"]
    ids = spark.createDataFrame([("a",), ("b",), (None,)], "ehd_id string")
    reg = spark.createDataFrame([("a", " Ulm ")], "ehd_id string, label string")
    assert {(x["ehd_id"], x["label"]) for x in views.with_labels(ids, reg).collect()} == {("a", "Ulm"), ("b", "b"), (None, None)}
    p = spark.createDataFrame([(1, "x.jpg"), (2, None), (3, "y.jpg")], "page_id long, image_filename string")
    assert [x["page_id"] for x in views.with_image(p, spark.createDataFrame([("x.jpg",), ("x.jpg",)], "name string")).collect()] == [1]


PERSONS = """<listPerson><person xml:id="H0001"><persName type="reg"><surname>Huber</surname><forename>Anna</forename></persName><persName>A. H.</persName><persName type="alt">Huberin</persName><birth>1770</birth></person>
<person xml:id="H0002"><persName><forename>Nur</forename></persName></person><person xml:id="H0003"><note>ohne Namen</note></person></listPerson>"""
PLACES = '<listPlace><place xml:id="H0010"><placeName type="reg">Ulm</placeName><placeName type="alt">Ulma</placeName><idno type="uri">http://g/1</idno></place><place xml:id="H0011"><placeName type="alt">x</placeName></place></listPlace>'
PLANTS = '<list><item><label type="reg">Viola alba</label><linkGrp><desc>GBIF</desc><ptr target="https://www.gbif.org/species/77" n="Viola alba Besser"/></linkGrp></item><item><label type="reg">Viola albida</label><linkGrp><desc>GBIF</desc><ptr target="https://www.gbif.org/species/77" n="V."/></linkGrp></item><item><label type="reg">Viola rara</label></item></list>'


@pytest.mark.parametrize("tag, xml", [("person", PERSONS), ("place", PLACES), ("item", PLANTS)])
def test_registers(spark, tmp_path, tag, xml):
    (tmp_path / "a.xml").write_text(xml)
    (tmp_path / "b.xml").write_text("<broken")
    got = {r["ehd_id"]: r for r in page_files.read_register(spark, str(tmp_path), tag).collect()}
    if tag == "person":
        assert set(got) == {"H0001", "H0002"} and got["H0001"]["label"] == "Huber, Anna" and got["H0001"]["alt_labels"] == ["A. H.", "Huberin"]
        assert got["H0001"]["surname"] == "Huber" and got["H0001"]["birth"] == "1770" and got["H0002"]["label"] == "Nur"
    elif tag == "place":
        assert set(got) == {"H0010"} and got["H0010"]["alt_labels"] == ["Ulma"] and got["H0010"]["authority_uri"] == "http://g/1"
    else:
        assert set(got) == {"plant:gbif:77", "plant:viola_rara"} and got["plant:gbif:77"]["label"] == "Viola alba" and got["plant:gbif:77"]["alt_labels"] == ["Viola albida"]


def test_stores(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([("a", "Ulm")], "ehd_id string, label string")

    at = str(tmp_path / "store")
    assert stores.stored_register(spark, at, build).count() == 1 and stores.stored_register(spark, at, build).count() == 1 and len(built) == 1
    (tmp_path / "wrap" / "data" / "index" / "person").mkdir(parents=True)
    assert stores.index_folder(spark, str(tmp_path)).endswith("wrap/data/index") and stores.index_folder(spark, str(tmp_path / "wrap")) == f"{tmp_path}/wrap/data/index"
    cache = spark.createDataFrame([("x", 1.0, 2.0, "s", True)], "name string, lat double, lon double, source string, found boolean")
    g = str(tmp_path / "geo")
    assert not stores.write_geocodes(cache.limit(0), g) and stores.read_geocodes(spark, g).count() == 0
    assert stores.write_geocodes(cache, g) and stores.read_geocodes(spark, g).count() == 1
    issues = spark.createDataFrame([("info", "variant_merge", "Species", "x")], "severity string, issue_type string, entity_type string, subject string")
    stores.write_linked(cache, issues, cache, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out" / "report" / "summary")).first()["n"] == 1
    assert "| R | 12.50 % |  |" in stores.accuracy_report(spark.createDataFrame([("R", 0.125, None)], "run_id string, cer double, wer double"), "t")


def test_no_local_checkpoints_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})()})()
        getConf = lambda self: {}

    fake = type("Session", (), {"sparkContext": Context(), "conf": {}})()
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(fake)


def test_tables_and_visual_regions_are_written():
    region = {"region_type": "observation_table", "content": "c", "marginal_position": None, "is_visual": False, "table_data": {"cells": [["1", None, "2"], ["3"]]}}
    xml = tei.fragment("1r", None, [region, dict(region, region_type="main_text", is_visual=True, content="Bild")], [])
    assert "1  2<lb/>\n3" in xml and "<figure><figDesc>Bild</figDesc></figure>" in xml


def test_marks_that_are_no_text():
    body = '<TEI><text><body><pb n="1"/><p>a<metamark>weg</metamark>b<anchor>weg</anchor>c<del> </del>d<seg type="editorial">weg</seg><gap quantity="2"/></p><figure><label>Titel</label></figure></body></text></TEI>'
    page = tei.parse(body)[0]
    assert [r["content"] for r in page["regions"]] == ["abcd[...]", "Titel"]


def test_margins_are_paired_best_first():
    ours = [("a b c d", "left"), ("a b x y", None), ("?", "right"), ("", "right")]
    theirs = [("a b c d", None), ("a b c z", "left"), ("k", "right"), ("l", "right"), ("m", "right")]
    assert kernels.pair_margins(ours, theirs) == {0: 0, 1: 1, 2: 2, 3: 3}
    assert kernels.pair_margins([], theirs) == {}


def test_the_entry_imports_without_a_session():
    """Queries are listed before any session is there."""
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 100 and not set(o) - set(q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__)))).returncode == 0
