import json

import pytest

from quirelab.operators import audit, ensemble, ground_truth, linking, metrics, pages, shred, stages
from quirelab.sources import pages as io, tei
from quirelab.streaming import resume

REGION = "region_id long, page_id long, region_index int, region_type string, content string, is_visual boolean, ground_truth_content string, ground_truth_confidence double, marginal_position string, ensemble_readings array<string>, languages array<string>, bbox array<double>, editorial_note string, writing_layer string, content_pre_consistency string, table_data struct<cells:array<array<string>>,caption:string>"


def region(i, page=1, index=0, kind="main_text", content=None, visual=False, truth=None, readings=None, position=None, table=None):
    return (i, page, index, kind, content, visual, truth, None, position, readings, None, None, None, None, None, table)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_linking_prefers_the_standard_form(spark):
    reg = spark.createDataFrame([("H1", "place", "Ulm", ["Ulma"]), ("H2", "place", "Bonn ", None), ("H3", "place", "Ulm", [])], "ehd_id string, kind string, label string, alt_labels array<string>")
    m = spark.createDataFrame([(1, "Location", "Bonn", "Ulm"), (2, "Location", "ulma.", None), (3, "Species", "Ulm", None), (4, "Location", None, " "), (5, "Location", "Bonnnnnnn", None)], "mention_id long, entity_type string, text string, normalized_form string")
    got = {r["mention_id"]: r for r in linking.link_exact(m, reg).collect()}
    assert set(got) == {1, 2}
    assert (got[1]["ehd_id"], got[1]["method"], got[1]["ambiguous"], got[1]["candidates"]) == ("H1", "normalized_form", True, ["H3"])
    assert (got[2]["ehd_id"], got[2]["method"]) == ("H1", "exact")


def test_fuzzy_links_match_brute_force(spark):
    from quirelab.functions import kernels

    names = ["Glasofestedt", "Rikalrode am See", "Puerto Schoreral", "Kozartartal"]
    asked = ["Glasofestdt", "Rikalrode am Se", "Puerto Schorerall", "Kosartartal", "Ganz anders", "Glasofsetedt"]
    reg = spark.createDataFrame([(f"H{i}", "place", n, None) for i, n in enumerate(names)], "ehd_id string, kind string, label string, alt_labels array<string>")
    m = spark.createDataFrame([(i, "Location", n, None) for i, n in enumerate(asked)], "mention_id long, entity_type string, text string, normalized_form string")
    want = {}
    for i, a in enumerate(asked):
        s, k = max((kernels.ratio(kernels.key_exact(a), kernels.key_exact(n)), -j) for j, n in enumerate(names))
        if s > 0.9:
            want[i] = (f"H{-k}", round(s, 3))
    got = {r["mention_id"]: (r["ehd_id"], r["score"]) for r in linking.link_fuzzy(m, reg).collect()}
    assert got == want


def test_audit(spark):
    s = "mention_id long, page int, entity_type string, text string, normalized_form string, ehd_id string, link_method string, link_score double, link_ambiguous boolean"
    m = spark.createDataFrame([
        (1, 1, "Species", "A. vulgaris", "Achillea vulgaris", "P1", "exact", 1.0, False), (2, 2, "Species", "Achillea vulgaris", "Achilea vulgaris", "P1", "exact", 0.7, False),
        (3, 3, "Location", "Ulm", "Ulm", "H1", "exact", 1.0, False), (4, 3, "Location", "ULM", "Ulma", "H2", "exact", 1.0, True), (5, 4, "Person", None, None, None, None, None, None), (6, 9, "Location", "ulm", " ", None, None, None, None),
    ], s)
    cover = {r["entity_type"]: (r["linked"], r["total"], r["pct"]) for r in audit.coverage(m).collect()}
    assert cover == {"Species": (2, 2, 100.0), "Location": (2, 3, 66.7), "Person": (0, 1, 0.0)}
    conflict = audit.normalization_conflicts(m).collect()
    assert [(r["norm_text"], r["normalized_forms"], r["pages"]) for r in conflict] == [("ulm", ["Ulm", "Ulma"], [3, 9])]
    assert {r["norm_text"] for r in audit.ambiguous_links(m).collect()} == {"achillea vulgaris", "ulm"}
    assert [r["surface_forms"] for r in audit.variant_merges(m).collect()] == [["A. vulgaris", "Achillea vulgaris"]]
    assert [r["epithet"] for r in audit.species_conflicts(m).collect()] == ["vulgaris"]


def test_error_rates(spark):
    r = spark.createDataFrame([region(1, content="abcd", truth="abxd"), region(2, index=1, content="zzzzzz", truth="ab"), region(3, 2, content="gut", truth=" "), region(4, 3, content="a b", truth="a b"), region(5, 3, 1, kind="sketch", content="q", truth="r")], REGION)
    got = {x["page_id"]: x for x in metrics.page_scores(r).collect()}
    assert set(got) == {1, 3}
    assert (got[1]["cer"], got[1]["n_regions"], got[1]["n_dropped"]) == (0.25, 1, 1)
    assert got[3]["cer"] == 0.0


def test_majority_and_merge(spark):
    r = spark.createDataFrame([region(1, readings=["ab", "abc", None, " "]), region(2, readings=["a b c", "a x c", "a b c"]), region(3, readings=None), region(4, readings=["t", "t"])], REGION)
    assert rows(ensemble.majority(r)) == [(1, "abc"), (2, "a b c"), (4, "t")]
    got = {x["region_id"]: x for x in ensemble.merge(r).collect()}
    assert (got[2]["template"], got[2]["gaps"], got[2]["best"]) == ("a [[M1]] c", 1, "a b c")
    assert got[4]["gaps"] == 0
    choices = spark.createDataFrame([(2, "M1", "x")], "region_id long, gap string, chosen string")
    assert dict(rows(ensemble.apply_choices(ensemble.merge(r), choices)))[2] == "a x c"


def test_alignment_takes_verbatim_truth(spark):
    r = spark.createDataFrame([region(1, content="eins zwei drei", truth="Eins zwei drei."), region(2, index=1, content="vier funf sechs", truth="Vier fünf sechs"), region(3, index=2, kind="marginal_note", content="rand notiz", truth="Rand Notiz", position="left")], REGION)
    got = dict((a, b) for a, b, _ in rows(ground_truth.align(r, ground_truth.truth_blocks(r))))
    assert got == {1: "Eins zwei drei.", 2: "Vier fünf sechs", 3: "Rand Notiz"}


def test_layout_never_rewrites(spark):
    r = spark.createDataFrame([region(1, content="x y"), region(2, index=1, content="x y"), region(3, index=2, content="z")], REGION)
    got = {x["region_id"]: x for x in stages.apply_layout(r, stages.duplicate_decisions(r)).collect()}
    assert [got[i]["content"] for i in (1, 2, 3)] == ["x y", "", "z"]
    assert got[2]["content_pre_consistency"] == "x y" and got[2]["issue"] == "duplicate_text"


def test_pages(spark):
    r = spark.createDataFrame([region(1, content="a"), region(2, index=1, kind="observation_table", content="no", table=([["b", " "], [None, "c"]], None)), region(3, index=2, visual=True, content="d"), region(4, 2)], REGION)
    assert rows(pages.full_text(r)) == [(1, "a\n\nb\n\nc"), (2, "")]
    assert rows(pages.table_text(r)) == [(2, "b   \n  c")]


def test_places(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    g1 = spark.createDataFrame([("a", 1.0, 2.0, "x")], "name string, lat double, lon double, source string")
    g2 = spark.createDataFrame([("a", 9.0, 9.0, "y"), ("b", 3.0, 4.0, "y")], g1.schema)
    places = stages.resolve_places(names, g1, g2)
    assert {r["name"]: (r["source"], r["found"]) for r in places.collect()} == {"a": ("x", True), "b": ("y", True), "c": (None, False)}
    v = spark.createDataFrame([("a", "invalid", "0.9", "b", 1), ("b", "invalid", None, "b", 1)], "name string, verdict string, confidence string, suggested_query string, ord int")
    assert rows(stages.validate_places(places, v, g1, g2)) == [("a", 3.0, 4.0, "y", "b")]


PAYLOADS = [
    (1, json.dumps({"page_number": 1, "regions": [{"content": "a", "table_data": [["x", None, 3], None, [" "]]}, None, {"ground_truth_entities": [{"text": "e"}, None]}], "entities": {"text": "t"}, "odd": 1})),
    (2, json.dumps([{"regions": {"table_data": json.dumps({"cells": [["q"]]})}}, None, {"locations": [{"name": "n"}]}])), (3, '{"a": ['), (4, ""), (5, None), (None, "{}"), (6, "null"), (7, "[]"), (2, None),
]


def test_shredding(spark):
    d = spark.createDataFrame([p for p in PAYLOADS if p != (2, None)] + PAYLOADS[:1], "record_id long, payload string").selectExpr("*", "1 as path", "2 as values")
    got = rows(shred.found(d))
    assert got == sorted([
        (1, 0, "region", 0, -1, -1), (1, 0, "region", 2, -1, -1), (1, 0, "table_cell", 0, 0, 0), (1, 0, "table_cell", 0, 0, 2), (1, 0, "gt_entity", 2, 0, -1), (1, 0, "entity", 0, -1, -1),
        (2, 0, "region", 0, -1, -1), (2, 0, "table_cell", 0, 0, 0), (2, 2, "location", 0, -1, -1),
    ])
    assert [(r["record_id"], r["page_pos"], r["page_number"]) for r in shred.flat(d, "page").orderBy("record_id", "page_pos").collect()] == [(1, 0, "1"), (2, 0, None), (2, 2, None)]
    assert shred.found(d.limit(0)).count() == 0


def test_flat_tables_give_the_payload_back(spark):
    """Every value of the schema stands in one of the tables, at its place."""
    entity = {k: f"{k}!" for k in shred.ENTITY_KEYS}
    region = {k: f"{k}?" for k in shred.REGION_KEYS} | {"languages": ["de", "fr"], "bbox": ["1", "2.5", "3", "4"], "uncertain_readings": ["u"], "ensemble_readings": ["r1", None, "r3"], "table_data": {"caption": "cap", "cells": [["a", "b"], ["c"]]}, "ground_truth_entities": [entity]}
    page = {k: f"{k}." for k in shred.PAGE_KEYS} | {"entry_numbers": ["1", "2"], "page_languages": ["la"], "regions": [region, {"content": "x"}, region], "entities": [entity, entity], "locations": [{k: k for k in shred.LOCATION_KEYS}]}
    d = spark.createDataFrame([(1, json.dumps([page, {"page_number": "2"}]))], "record_id long, payload string")
    lists = {"region": "regions", "entity": "entities", "location": "locations", "gt_entity": "ground_truth_entities", "entry_number": "entry_numbers", "page_language": "page_languages", "region_language": "languages", "bbox": "bbox", "uncertain_reading": "uncertain_readings", "ensemble_reading": "ensemble_readings"}
    back: dict = {}

    def put(at, name, k, value):
        at.setdefault(name, {})[k] = value

    for child in shred.TABLES:
        for r in shred.flat(d, child).collect():
            v = {k: x for k, x in r.asDict().items() if k not in ("record_id", "page_pos", "pos1", "pos2", "pos3") and x is not None}
            if child == "page":
                back[r["page_pos"]] = v
                continue
            path = shred.TABLES[child]
            page_ = back[r["page_pos"]]
            if child == "table_cell":
                put(page_["regions"][r["pos1"]].setdefault("table_data", {}).setdefault("cells", {}), r["pos2"], r["pos3"], r["cell"])
                continue
            value = v["value"] if "value" in v and path[-1] not in lists.values() or child == "bbox" else v
            if child == "region" and "caption" in v:
                v["table_data"] = {"caption": v.pop("caption")}
            if path[0] == "regions" and child != "region":
                put(page_["regions"][r["pos1"]], lists[child], r["pos2"], value)
            else:
                put(page_, lists[child], r["pos1"], value)

    def plain(v):
        if isinstance(v, list):
            return {i: plain(x) for i, x in enumerate(v) if x is not None}
        return {k: plain(x) for k, x in v.items()} if isinstance(v, dict) else v

    assert back == {0: plain(page), 1: {"page_number": "2"}}


def test_levels_round_trip():
    value = [{"regions": [{"content": "a", "table_data": {"cells": [["1", "2"], []]}}, {"content": None}]}, {"regions": []}]
    cols = shred.columns_of(shred.SCHEMA)
    shred.shred(value, shred.SCHEMA, cols)
    cells = cols[("regions", "table_data", "cells", "row", "cell")]
    assert [at for _, at, there in shred.places(cells, 4) if there] == [(0, 0, 0, 0), (0, 0, 0, 1)]
    assert cells.reps == [0, 4, 3, 2, 1]
    assert all(len(c.reps) == len(c.defs) == len(c.values) for c in cols.values())


def test_deep_and_long_payloads(spark):
    long = json.dumps({"regions": [{"content": "x" * 300_000, "table_data": {"cells": [["v"] * 2000]}}]})
    deep = "[" * 100_000
    d = spark.createDataFrame([(1, long), (2, deep)], "record_id long, payload string")
    assert shred.found(d).count() == 2001


TEI = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body>lost<pb n="1r" facs="a.jpg"/><fw type="folNum">1r</fw><p>Von <persName ref="#H0001234">Anna</persName> <del>alt</del> un<unclear>klar</unclear><lb/>Zeile <choice><reg>b</reg><orig>a</orig></choice><note type="editorial">weg</note></p><note place="left"><p>am Rand</p></note><pb n="1v"/><pb n="2r"/><p>zwei<supplied>x</supplied></p></body></text></TEI>'


def test_tei_reader(spark):
    d = spark.createDataFrame([(TEI,), ("<broken",), (None,)], "xml string")
    got = {r["folio_label"]: r for r in tei.read(d).collect()}
    assert list(got) == ["1r", "2r"] and got["2r"]["page_number"] == 3
    assert [(r["region_type"], r["content"]) for r in got["1r"]["regions"]] == [("page_number", "1r"), ("main_text", "Von Anna ~~alt~~ unklar[?]\nZeile a"), ("marginal_note", "am Rand")]
    assert got["1r"]["entities"][0]["ehd_id"] == "H0001234"


def test_tei_writer_is_read_back():
    r = [{"region_type": "main_text", "content": "Von Ulm ~~alt~~\nunklar[?] <u>u</u> & mehr", "marginal_position": None}]
    f = tei.fragment("1r", None, r, [{"text": "Ulm", "entity_type": "Location"}])
    back = tei.parse(f"<body>{f}</body>")
    assert back[0]["regions"][0]["content"] == "Von Ulm ~~alt~~\nunklar[?] u & mehr"
    assert back[0]["entities"][0]["text"] == "Ulm"


def test_page_files_and_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "page_0001.json").write_text(json.dumps([{"page_number": 1, "regions": [{"content": "a"}]}, {"page_number": 2}], indent=1))
    assert io.read_pages(spark, str(src)).count() == 2
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    step = lambda d: d.select("page_number")
    resume.process_new(spark, str(src), step, out, check)
    (src / "page_0003.json").write_text(json.dumps({"page_number": 3}))
    resume.process_new(spark, str(src), step, out, check)
    assert rows(spark.read.parquet(out)) == [(1,), (2,), (3,)]


@pytest.mark.parametrize("name", ["link_coverage", "issue_rollup", "page_text", "p2_found"])
def test_queries_run_on_the_smallest_data(spark, name):
    import __spark_entry__

    assert __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
