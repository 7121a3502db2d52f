import hashlib
import random

import pytest

from quirelab.llm import bpe, canonical, consensus_readers, languages, lookalike, mix, queries, repair, resolve, spans

NAMES = "name_id long, entity_type string, text string, normalized_form string, surname string, birth string, death string, note string"
CLASH = ("1 as k", "2 as s", "3 as w", "4 as token", "5 as n", "6 as cid", "7 as h", "8 as tid", "9 as label", "10 as raw", "11 as bucket", "12 as size")


def frame(spark, data, schema, clash=True):
    d = spark.createDataFrame(data, schema)
    return d.selectExpr("*", *[c for c in CLASH if c.split()[-1] not in d.columns]) if clash else d


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# -- 1 ---------------------------------------------------------------------------------------------------------

REGISTER = [("P1", "place", "Glasofestedt", ["Glasofestet am See"]), ("P2", "place", "Sankt Olgarode ", None), ("P3", "place", "Ulm", []), ("T1", "plant", "Achillea montana", [None, " "]), ("T2", "plant", "Viola montana", None)]
MENTIONS = [
    (1, "Location", "GLASOFESTEDT", None), (2, "Location", "St. Olgarode", ""), (3, "Location", "Glasofset=\nedt", None), (4, "Location", "Glasofesttedt", None), (5, "Location", "Rikalrode", None), (6, "Location", None, None),
    (7, "Species", "A. montana", None), (8, "Species", "montana, Viola", None), (9, "Species", "Ulm", None), (10, "Person", "Ulm", None), (11, "Location", "x" * 50_000, "Ulm"), (12, "Location", "  ", None), (None, "Location", "Ulm", None), (1, "Location", "GLASOFESTEDT", None),
]


def test_mapping(spark):
    m = frame(spark, MENTIONS, "mention_id long, entity_type string, text string, normalized_form string")
    r = frame(spark, REGISTER, "ehd_id string, kind string, label string, alt_labels array<string>")
    got = dict(rows(canonical.map_mentions(m, r).select("mention_id", "ehd_id")))
    assert got == {1: "P1", 2: "P2", 3: "P1", 4: "P1", 5: "none", 6: "none", 7: "T1", 8: "T2", 9: "none", 11: "P3", 12: "none"}
    assert canonical.map_mentions(m.limit(0), r).count() == 0
    assert {e for _, e in rows(canonical.map_mentions(m, r.limit(0)).select("mention_id", "ehd_id"))} == {"none"}


def test_pigeonhole_finds_all_within_tolerance(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(5, 16))) for _ in range(60)]
    asked = []
    for w in words:
        i = rng.randrange(len(w))
        asked += [w[:i] + w[i + 1 :], w[:i] + "z" + w[i:], w[:i] + "z" + w[i + 1 :]]
    keys = spark.createDataFrame([("place", w, w) for w in words], "kind string, k string, ehd_id string")
    v = spark.createDataFrame([("place", a, a, 0, False) for a in asked], "kind string, raw string, s string, less int, dot boolean")
    found = {(r["raw"], r["ehd_id"]) for r in canonical._fuzzy(v, keys).collect()}
    for n, a in enumerate(asked):
        if len(words[n // 3]) >= 5:
            assert (a, words[n // 3]) in found


# -- 3 ---------------------------------------------------------------------------------------------------------

DE, FR = "Der Fluss war sehr kalt und die Brücke stand im Wasser.", "La rivière était très froide et le pont restait dans son lit."


def corpus():
    rng, out = random.Random(4), []
    de, fr = DE[:-1].split(), FR[:-1].split()
    for i in range(160):
        words, lang = (de, "de") if i % 2 else (fr, "fr")
        out.append((" ".join(rng.sample(words, len(words))) + ".", [lang] if i % 7 else ["fr" if lang == "de" else "de"]))
    return out


def test_languages(spark):
    field = languages.train(corpus())
    data = [
        (1, 1, "main_text", DE, ["de"]), (2, 1, "main_text", DE + " " + FR, ["de"]), (3, 1, "main_text", None, None), (4, 1, "main_text", " ", []), (5, 2, "main_text", FR, ["FR"]), (6, 2, "main_text", "Zokidel Rikalrode 12", ["de"]),
        (7, 2, "sketch", DE, None), (2, 1, "main_text", DE + " " + FR, ["de"]), (None, 1, "main_text", DE, None), (8, None, "main_text", (DE + " ") * 500, None),
    ]
    r = frame(spark, data, "region_id long, page_id long, region_type string, content string, languages array<string>")
    got = {x["region_id"]: x["langs"] for x in languages.detect(r, field).collect()}
    assert got == {1: ["de"], 2: ["de", "fr"], 5: ["fr"], 6: [], 8: ["de"]}
    assert [(x["segment"], x["lang"]) for x in languages.segments(r, field).filter("region_id = 2").orderBy("segment").collect()] == [(0, "de"), (1, "fr")]
    assert languages.detect(r.limit(0), field).count() == 0
    p = spark.createDataFrame([(1, ["de"]), (2, None), (3, None)], "page_id long, page_languages array<string>")
    assert languages.wrong_labels(r.limit(0), p).count() == 0


def test_field_on_held_out_text():
    data = corpus()
    field = languages.train(data[:120])
    right = [("de" if i % 2 else "fr") for i in range(120, 160)]
    got = [languages.CODES[s[0][0]] for s in languages.sentences(field, [t for t, _ in data[120:]])]
    assert got == right


# -- 4 ---------------------------------------------------------------------------------------------------------


def readings():
    rng, out = random.Random(5), []
    for i in range(400):
        truth = str(rng.randint(100, 999))
        noisy = lambda p, t=truth: "".join(c if rng.random() > p else "0" for c in t)
        out.append((i, "page_number", [truth, noisy(0.5), noisy(0.5)] if i % 2 else [noisy(0.5), noisy(0.02)], ["A", "B", "C"] if i % 2 else ["B", "A"], truth))
    return out


def test_consensus_beats_the_majority(spark):
    data = readings()
    d = frame(spark, [x[:4] for x in data], "region_id long, region_type string, ensemble_readings array<string>, reader_ids array<string>")
    got = {r["region_id"]: r["reading"] for r in consensus_readers.consensus(d, 2, 4)[0].collect()}
    right = sum(got[i] == t for i, _, _, _, t in data)
    votes = sum(max(set(r), key=lambda x: (r.count(x), len(x), x)) == t for _, _, r, _, t in data)
    assert right > 0.93 * len(data) and right > votes
    reliable = {r["reader_id"]: r["reliability"] for r in consensus_readers.reader_reliability(d, 2, 4).collect()}
    assert reliable["A"] > reliable["B"] and reliable["A"] > reliable["C"]


def test_consensus_edges(spark):
    s = "region_id long, region_type string, ensemble_readings array<string>, reader_ids array<string>"
    d = frame(spark, [(1, "page_number", [" 7 ", None, "7"], ["A", "B", None]), (2, "page_number", [None, " "], ["A", "B"]), (3, "page_number", None, None), (4, "main_text", ["x", "y"], ["A", "B"]), (5, "calculation", ["1", "2"], None), (1, "page_number", [" 7 ", None, "7"], ["A", "B", None]), (None, "page_number", ["1"], ["A"]), (6, "calculation", ["9" * 400, "9"], ["A", "B"])], s)
    got = {r["region_id"]: r for r in consensus_readers.consensus(d, 3, 3)[0].collect()}
    assert set(got) == {1, 5, 6}
    assert (got[1]["reading"], got[1]["agreement"], got[1]["kinds"]) == ("7", 1.0, 1)
    assert consensus_readers.consensus(d.limit(0))[0].count() == 0
    assert consensus_readers.reader_reliability(d.limit(0)).count() == 0


def test_consensus_of_all_region_types(spark, tmp_path):
    text = "der Fluss war kalt und das Gestein liegt offen " * 12
    typed = [("main_text", [text, text, text.replace("Fluss", "Flusz")]), ("marginal_note", ["am Rand", "am Rnad"]), ("crossed_out", ["weg", "weg"]), ("pasted_slip", ["Zettel", None]), ("page_number", ["7", "1", "7"]), (None, ["a", "b"])]
    s = "region_id long, region_type string, ensemble_readings array<string>, reader_ids array<string>"
    d = frame(spark, [(i, t, r, ["A", "B", "C"][: len(r)] if t == "page_number" else ["D", "E", "F"][: len(r)]) for i, (t, r) in enumerate(typed)], s)
    d.write.parquet(str(tmp_path / "regions.parquet"))
    got = {r["region_id"]: r for r in queries.p4_consensus(spark, str(tmp_path)).collect()}
    assert set(got) == set(range(6)) and got[0]["reading"] == text.strip() and got[0]["kinds"] == 2
    assert {r["reader_id"] for r in queries.p4_readers(spark, str(tmp_path)).collect()} == {"A", "B", "C", "D", "E", "F"}
    assert {r["region_id"] for r in queries.p4_found(spark, str(tmp_path)).collect()} == {4}


def test_alignment_within_a_band_is_cheapest():
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    for _ in range(300):
        a, b = word(rng.randint(0, 40)), word(rng.randint(0, 40))
        rows, _ = consensus_readers._costs(a, b)
        full = list(range(len(b) + 1))
        for x, c in enumerate(a, 1):
            last, full = full, [x]
            for y, e in enumerate(b, 1):
                full.append(min(last[y - 1] + (c != e), last[y] + 1, full[-1] + 1))
        paired = [e for e in consensus_readers.events(a, b) if e]
        assert rows[-1][-1] == full[-1] == sum(e >> 21 != e & ((1 << 21) - 1) for e in paired)


def test_long_readings_align_at_the_same_cost():
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    low = (1 << 21) - 1
    for n in range(200):
        a = word(rng.randint(0, 90))
        b = word(rng.randint(41, 90)) if n % 3 else "".join(c for c in a if rng.random() > 0.1) + word(3)
        rows, _ = consensus_readers._costs(a, b)
        pairs = consensus_readers._diagonals(a, b)
        assert sum(t != r for t, r in pairs) == rows[-1][-1]
        assert "".join(chr(t) for t, _ in reversed(pairs) if t) == a and "".join(chr(r) for _, r in reversed(pairs) if r) == b
        turned = dict(zip(*consensus_readers._turned(consensus_readers._counted(a, b), len(b)), strict=True))
        assert sum(x for e, x in turned.items() if e >> 21 != e & low) == rows[-1][-1] and turned.get(0, 0) == max(0, len(b) + 1 - sum(x for e, x in turned.items() if 0 < e < 1 << 21))


# -- 5 ---------------------------------------------------------------------------------------------------------


def shared_texts():
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    core, other = word(200), word(150)
    return [
        (1, word(90) + core + word(40), None), (2, core[:130] + word(60), "short"), (3, word(50), word(30) + core[60:]), (4, word(300), word(300)), (5, other, None), (6, other, None), (7, core[:119] + word(80), None), (8, None, None), (9, " " * 300, None), (10, " " * 300, None),
        (11, "x" * 40_000, None), (1, None, None),
    ]


def brute(data, least):
    held = {}
    for i, *texts in data:
        for t in texts:
            for k in range(len(t or "") - least + 1):
                held.setdefault(t[k : k + least], set()).add(i)
    return sorted({(a, b) for s in held.values() for a in s for b in s if a < b})


@pytest.mark.parametrize("hot", [5000, 1, 0])
def test_spans(spark, hot, monkeypatch):
    monkeypatch.setattr(spans, "HOT", hot)
    data = [x for x in shared_texts() if x != (1, None, None)]
    d = frame(spark, data + data[:1], "region_id long, content string, content_pre_consistency string")
    want = brute(data, 120)
    assert (1, 2) in want and (1, 7) not in want
    assert rows(spans.pairs(d)) == want
    assert spans.pairs(d.limit(0)).count() == 0


def test_span_shares(spark):
    data = [x for x in shared_texts() if x != (1, None, None)]
    d = frame(spark, data, "region_id long, content string, content_pre_consistency string")
    got = {r["region_id"]: r for r in spans.shares(d).collect()}
    assert got[5]["share"] == 1.0 and got[4]["share"] == 0.0 and got[8]["share"] == 0.0
    assert got[1]["shared_chars"] >= 200 and got[2]["shared_chars"] >= 130


def test_shares_and_intervals_of_both_fields(spark, tmp_path):
    data = [x for x in shared_texts() if x != (1, None, None)]
    frame(spark, data, "region_id long, content string, content_pre_consistency string").write.parquet(str(tmp_path / "regions.parquet"))
    shares = {(r["region_id"], r["field"]): r for r in queries.p5_shares(spark, str(tmp_path)).collect()}
    assert len(shares) == 2 * len(data)
    texts = {(i, f): t or "" for i, a, b in data for f, t in (("content", a), ("content_pre_consistency", b))}
    held = {}
    for (i, _), t in texts.items():
        for k in range(len(t) - 119):
            held.setdefault(t[k : k + 120], set()).add(i)
    want = {x: {p for k in range(len(t) - 119) if len(held[t[k : k + 120]]) > 1 for p in range(k, k + 120)} for x, t in texts.items()}
    assert want[3, "content_pre_consistency"] and {x: r["shared_chars"] for x, r in shares.items()} == {x: len(p) for x, p in want.items()}
    found = {x: set() for x in texts}
    for r in queries.p5_intervals(spark, str(tmp_path)).collect():
        found[r["region_id"], r["field"]] |= set(range(r["start"], r["stop"]))
    assert found == want


def test_streamed_texts_widen_the_interval():
    """Texts are searched in an index they are not part of: matches break off, are widened, and every shared span is found."""
    rng = random.Random(17)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    core, widened = word(40), []
    texts = [word(rng.randint(0, 9)) + core[i % 5 : 40 - i % 7] + word(rng.randint(0, 9)) for i in range(37)]
    wids, real = [hashlib.md5(str(i).encode()).hexdigest() for i in range(37)], spans.FMIndex._widen
    spans.FMIndex._widen = lambda self, lo, hi: widened.append(len(lo)) or real(self, lo, hi)
    try:
        got = spans.shared_spans([7] * 37, wids, texts, [1 + (i == 3) for i in range(37)], 24)
    finally:
        spans.FMIndex._widen = real
    assert sum(widened) > 100
    held = {}
    for i, t in enumerate(texts):
        for k in range(len(t) - 23):
            held.setdefault(t[k : k + 24], set()).add(i)
    want = {(i, k) for i, t in enumerate(texts) for k in range(len(t) - 23) if len(held[t[k : k + 24]]) > 1 or i == 3}
    assert {(wids.index(w), k) for _, w, a, b in got for k in range(a, b + 1)} == want
    by = {}
    for c, w, *_ in got:
        by.setdefault(c, set()).add(wids.index(w))
    assert {frozenset(x) for x in by.values()} == {frozenset(x) for x in held.values() if len(x) > 1 or x == {3}}


def test_index_counts_like_a_scan():
    rng = random.Random(7)
    texts = ["".join(rng.choice("abc") for _ in range(60)) for _ in range(8)]
    index = spans.FMIndex(texts)
    asked = ["".join(rng.choice("abcd") for _ in range(30)) for _ in range(5)] + [texts[0][5:40]]
    best = {}
    for who, step, got, _ in index.statistics(asked):
        for w, g in zip(who.tolist(), got.tolist(), strict=True):
            best[w, len(asked[w]) - 1 - step] = g
    for (w, at), g in best.items():
        longest = max(n for n in range(len(asked[w]) - at + 1) if any(asked[w][at : at + n] in t for t in texts))
        assert g == longest


# -- 6 ---------------------------------------------------------------------------------------------------------


def scans(n=400):
    rng, out = random.Random(8), []
    words = "der fluss war sehr kalt und die brücke stand im wasser nach dem regen wurde das gestein dunkler als gestern".split()
    for i in range(n):
        t = [rng.choice(words) for _ in range(24)]
        lines = [" ".join(t[j : j + 6]) for j in range(0, 24, 6)]
        if i % 5 == 0:
            k = rng.randrange(3)
            lines[k] += " gest-"
            lines[k + 1] = "ein " + lines[k + 1]
        if i % 33 == 0 and i < 297:
            lines[1] += " " + ("flnss", "wnrde", "dnnkler")[i // 33 % 3]
        if i % 6 == 0:
            lines.insert(0, "Reise von Rikalrode nach Kozartartal")
        out.append((i, "main_text", f"J{i % 9}", "\n".join(lines)))
    return out + [(n + i, "page_number", "J1", str(i + 10)) for i in range(60)] + [(n + 60 + i, "entry_heading", "J1", f"N. {i}.") for i in range(30)]


def test_repair(spark):
    r = frame(spark, scans(), "region_id long, region_type string, journal_id string, content string")
    j = spark.createDataFrame([(f"J{i}", "Reise von Rikalrode nach Kozartartal") for i in range(9)], "journal_id string, title string")
    e = repair.train(r, j)
    assert {"fluss", "gestein"} <= e.lexicon and "flnss" not in e.lexicon
    text = "Reise von Rikalrode nach Kozartartal\nder flnss war kalt und die gest-\n47\nein brücke\nNord-\nund"
    lines, found, fixed = repair.flaws(e, text, "J1")
    assert found == [(1, "header"), (2, "hyphen"), (2, "misread"), (3, "page_number")]
    assert "".join(fixed).split() == "der fluss war kalt und die gestein brücke Nord- und".split()
    edges = spark.createDataFrame([(1, "main_text", "J1", None), (2, "main_text", None, " \n "), (3, "main_text", None, "der fluss"), (None, "main_text", "J1", "x"), (4, "main_text", "J1", "der fluss " * 20_000)], "region_id long, region_type string, journal_id string, content string")
    pages = spark.createDataFrame([(1, "J1", None), (2, None, "12")], "page_id long, journal_id string, full_text string")
    assert {(x["holder"], x["record_id"]) for x in repair.find(edges, pages, j, e).collect()} <= {("page", 2)}
    assert repair.repair(edges, pages, j, e).count() == 3
    assert repair.find(edges.limit(0), pages.limit(0), j, e).count() == 0


def test_words_the_lexicon_does_not_hold_are_repaired(spark):
    """The editor decides by the characters: a digit read for a letter, in words no other text has."""
    rng = random.Random(18)
    words = "oben boden vor noch wolke ordnung stollen morgen sonne kommen grosse trocken norden vogel".split()
    rare = ["".join(rng.choice(("ko", "ra", "lu", "mo", "be", "to", "ni")) for _ in range(4)) for _ in range(150)]
    data = []
    for i in range(600):
        t = [rng.choice(words) for _ in range(14)]
        if i % 4 == 0:
            t[3] = rng.choice(rare)
        if i % 12 == 1:
            t[5] = t[5].replace("o", "0", 1)
        data.append((i, "main_text", f"J{i % 9}", " ".join(t)))
    r = frame(spark, data, "region_id long, region_type string, journal_id string, content string")
    e = repair.train(r, spark.createDataFrame([("J0", "x")], "journal_id string, title string"))
    assert ("o", "0") in e.confusions
    for clean, seen in (("korakomo", "k0rakomo"), ("totolumo", "tot0lumo"), ("rakobeto", "rakobet0"), ("mokomobe", "m0k0mobe")):
        assert clean not in e.lexicon and e.edit(clean) is None and (e.edit(seen) or (0, ""))[1] == clean, seen
    assert e.edit("1800") is None and e.edit("wolke") is None


def test_operations_rebuild_the_word():
    for good, bad in (("m", "rn"), ("rn", "m"), ("a", "o"), ("vv", "w"), ("ab", "b")):
        ops = repair.operations(good, bad)
        chars = {k: "" if op == repair.DELETE else op[1] for k, gap, op in ops if not gap}
        put_in = "".join(op[1] for _, gap, op in ops if gap)
        assert "".join(chars.get(k, c) for k, c in enumerate(bad)) + put_in == good


def test_headers_by_place_and_shape(spark):
    """A header with other names than the title's is found by where it stands and how it looks; long lines are tried too."""
    title = lambda j: f"Reise von {'Rikal Zimal Bodes Fizur Klond Tirel Glana Vorto Stago'.split()[j]}rode nach {'Kozar Pelmer Judol Biliho Nufin Grond Sesas Dodir Lizbu'.split()[j]}tal"
    data = [(i, k, f"J{i % 9}", c.replace("Reise von Rikalrode nach Kozartartal", title(i % 9))) for i, k, _, c in scans()]
    r = frame(spark, data, "region_id long, region_type string, journal_id string, content string")
    e = repair.train(r, spark.createDataFrame([(f"J{i}", title(i)) for i in range(9)], "journal_id string, title string"))
    assert "rikalrode" not in e.lexicon and "reise" in e.lexicon
    text = "Reise von Bodesrode nach Pelmertal\nder fluss war kalt und die brücke stand im wasser\nnach dem regen wurde das gestein dunkler"
    assert repair.flaws(e, text, "J1")[1] == [(1, "header")]
    assert repair.flaws(e, "der fluss war sehr kalt " * 30 + "\n" + " " * 20 + "47" + " " * 20 + "\nund die brücke", None)[1] == [(2, "page_number")]


# -- 7 ---------------------------------------------------------------------------------------------------------


def test_resolution(spark):
    data = [
        (1, "Person", "Thomas Jamavolin", None, None, "1750", None, None), (2, "Person", "Jamavolin, Th.", None, None, None, None, None), (3, "Person", "Tom Jamavolyn", "Thomas Jamavolin", None, None, None, None), (4, "Person", "Dr. Jamavolin", None, None, "um 1750", None, None),
        (5, "Person", "Beatriz Jamavolin", None, None, "1790", None, None), (6, "Person", "Ulrich Hikedemann", None, None, None, None, None), (7, "Person", "Hikedemann", None, None, None, None, None), (8, "Institution", "Bergamt Zortau", None, None, None, None, None),
        (9, "Institution", "B.-Amt Zortau", None, None, None, None, None), (10, "Institution", "Jardin des plantes de Zortau", None, None, None, None, None), (11, "Person", None, None, None, None, None, None), (12, "Person", " ", "", "", "", "", ""), (1, "Person", "Thomas Jamavolin", None, None, "1750", None, None),
        (None, "Person", "Thomas Jamavolin", None, None, None, None, None), (13, None, None, None, None, None, None, None), (14, "Person", "y" * 20_000, None, None, None, None, None),
    ]
    d = frame(spark, data, NAMES)
    assert rows(resolve.pairs(d)) == [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4), (6, 7), (8, 9)]
    assert resolve.pairs(d.limit(0)).count() == 0


def test_spellings_one_edit_apart_meet(spark):
    some = lambda text, n, at, birth=None: [(at + i, "Person", text, None, None, birth, None, None) for i in range(n)]
    data = some("Joseph Jovigewig", 1, 1) + some("Joseph Jovygewig", 1, 2)  # once each
    data += some("Ulrich Hikedemann", 6, 11) + some("Ulrich Hikademann", 5, 21)  # neither rare nor much rarer
    data += some("Robert Prolmartig", 4, 31, "1701") + some("Robert Prolmertig", 4, 41, "1790")  # years contradict
    data += some("Sabrilon", 4, 51) + some("Quirin Sabrylon", 5, 61)  # a bare surname, about as frequent
    found = set(rows(resolve.pairs(frame(spark, data, NAMES))))
    apart = lambda a, b: not any((x, y) in found for x in a for y in b)
    assert (1, 2) in found and all((a, b) in found for a in range(11, 17) for b in range(21, 26))
    assert apart(range(31, 35), range(41, 45)) and apart(range(51, 55), range(61, 66))
    # the same rows sent eight times under new ids: the same links among the first ones
    again = frame(spark, [(x[0] + 1000 * k, *x[1:]) for k in range(8) for x in data], NAMES)
    assert {x for x in rows(resolve.pairs(again)) if max(x) < 1000} == found


def test_a_hot_surname_is_not_scanned():
    """Thousands of persons under one spelling: work grows with the profiles, not with their pairs."""
    sets = lambda **x: {f: set(x.get(f, ())) for f in resolve._SETS}
    persons = [{"cid": i, "type": "Person", "size": 1 + i % 5, "near": False, "lone": False, **sets(spellings=["huber"], firsts=[f"vorname{i}"], initials=["v"], births=[str(1500 + i % 400)])} for i in range(20_000)]
    assert resolve.resolve_names(persons) == []
    bare = [{"cid": 20_000 + i, "type": "Person", "size": 1, "near": False, "lone": False, **sets(spellings=["huber"], callings=[f"c{i}"])} for i in range(20_000)]
    assert resolve.resolve_bare(persons + bare) == []
    dated = {"cid": 50_000, "type": "Person", "size": 1, "near": False, "lone": False, **sets(spellings=["huber"], births=["1500"])}
    assert resolve.resolve_bare([*persons[:300], dated]) == [(50_000, 0, False, 1)]


def test_rounds_go_on_until_none_merges(spark, monkeypatch):
    turns = iter(range(1, 15))

    def one(p, *_):
        """The last profile joins the one before, in 14 rounds."""
        k = next(turns, None)
        return spark.createDataFrame([(16 - k, 15 - k)] if k else [], "cid long, into long")

    monkeypatch.setattr(resolve, "_round", one)
    d = frame(spark, [(i, "Person", "Jamavolin" + "x" * i, None, None, None, None, None) for i in range(1, 16)], NAMES)
    assert {r["cid"] for r in resolve.resolve(d).collect()} == {1}


# -- 8, 9 ------------------------------------------------------------------------------------------------------


def test_encoding_matches_the_public_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    P = pytest.importorskip("public_tokenizers")
    t = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = [None, "", " ", "Die Brücke – 5½ ° R.\n\n  <|endoftext|>", "a" * 30_000, "é​ẞ\U0001f600 α", "x" * 7 + "\t\n y"]
    d = frame(spark, list(enumerate(texts)) + [(None, "Die")], "doc_id long, text string")
    got = {r["doc_id"]: list(r["ids"]) for r in bpe.encode(d).collect()}
    for i, x in enumerate(texts):
        assert got[i] == t.encode(x or "", add_special_tokens=False).ids
    back = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(d)).collect()}
    assert all(back[i] == (x or "") for i, x in enumerate(texts))
    assert bpe.encode(d.limit(0)).count() == 0


def test_budget_flows_to_siblings_first():
    leaves = {("d", "de", "a"): {"weight": 0.4, "room": 10.0}, ("d", "de", "b"): {"weight": 0.2, "room": 100.0}, ("e", "fr", "c"): {"weight": 0.4, "room": 100.0}}
    mix.allot(leaves, 100.0)
    # the shortage of `a` goes to its sibling `b`, not to the other domain
    assert [round(x["budget"]) for x in leaves.values()] == [10, 50, 40]
    mix.allot(leaves, 1000.0)
    assert [round(x["budget"]) for x in leaves.values()] == [10, 100, 100]
    many = {("web", f"l{i % 40}", f"s{i}"): {"weight": 1 + i % 7, "room": float(i % 11)} for i in range(50_000)}
    mix.allot(many, 150_000.0)
    assert abs(sum(x["budget"] for x in many.values()) - 150_000) < 1 and all(x["budget"] <= x["room"] + 1e-6 for x in many.values())
    mix.allot({}, 5.0)


def test_mixing(spark):
    data = [(i, "wort " * (5 + i % 7), "de" if i % 2 else None, "letter" if i % 3 else "gazetteer") for i in range(400)] + [(900, None, "de", "letter"), (901, "", "de", "letter"), (902, "x", "de", None), (903, "z " * 30_000, "de", "other")]
    d = frame(spark, data, "doc_id long, text string, lang string, source string")
    t = spark.createDataFrame([("letter", 0.5, 1), ("gazetteer", 0.5, 3), ("missing", 0.0, None)], "source string, target_share double, max_repeats int")
    docs, report = mix.mix(d, t)
    by = {r["source"]: r for r in report.collect()}
    assert abs(by["letter"]["actual_share"] - 0.5) < 0.02 and by["gazetteer"]["most_copies"] <= 3
    assert docs.count() == docs.select("doc_id").distinct().count()
    again = mix.mix(d, t)[0]
    assert rows(again) == rows(docs)
    tree = {r["domain"] for r in mix.mix(d, t, domains={"letter": "post", "gazetteer": "books"})[0].select("domain").distinct().collect()}
    assert tree == {"post", "books"}
    far = {r["source"]: r for r in mix.mix(d, t, total=1e6)[1].collect()}
    assert far["letter"]["out_of_reach"] and far["letter"]["most_copies"] == 1
    assert mix.mix(d.limit(0), t)[0].count() == 0


# -- 10 --------------------------------------------------------------------------------------------------------


def test_lookalikes(spark):
    data = [
        (1, "Der Fluss"), (2, "Dеr Fluss"), (3, "Ｄｅｒ Flu​ss"), (4, "Der Fluss"), (5, "Dér Fluss"), (6, "Dér Fluss"), (7, "Der Fluss"), (8, None), (9, ""), (10, "​"), (11, " "), (12, "ﬁn"), (13, "fin"), (14, "α Orionis"), (15, "a Orionis"), (1, "Der Fluss"),
        (16, "l" * 30_000), (17, "ǀ" * 10),
    ]
    d = frame(spark, data, "doc_id long, text string")
    assert rows(lookalike.pairs(d)) == [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (2, 7), (3, 4), (3, 7), (4, 7), (5, 6), (12, 13)]
    text = {r["doc_id"]: r["text"] for r in lookalike.normalize(d).collect()}
    assert text[2] == text[3] == text[4] == "Der Fluss" and text[6] == "Dér Fluss" and text[8] is None and text[14] == "α Orionis"
    assert lookalike.pairs(d.limit(0)).count() == 0


def test_the_vocabulary_decides_between_readings(spark):
    """`\u04cf` looks like l and like I, `\u041e` like O and like 0: the table alone would spell these wrongly."""
    data = [(1, "Ilm und Saale"), (2, "\u04cflm und Saale"), (3, "1805 gemessen"), (4, "18\u041e5 gemessen"), (5, "la mano"), (6, "\u04cfa mano"), (7, "\u0391\u03c9 \u041e")]
    d = frame(spark, data, "doc_id long, text string")
    assert lookalike.by_table(data[1][1]) == "llm und Saale" and lookalike.by_table(data[3][1]) == "18O5 gemessen"
    assert rows(lookalike.pairs(d)) == [(1, 2), (3, 4), (5, 6)]
    text = {r["doc_id"]: r["text"] for r in lookalike.normalize(d).collect()}
    assert text[2] == "Ilm und Saale" and text[4] == "1805 gemessen" and text[6] == "la mano"


def test_keys_agree_between_plain_and_suspect_tokens(spark):
    plain = ["Élan", "Ilm", "Öl1805", "αβγ", "\u1ebf\u1e69", "a", "ñandú", "ﬁn".replace("ﬁ", "fi")]
    for want, seen in zip(plain, ["E\u0301lan", "\u04cflm", "O\u03088\u200b".replace("8", "l18\u041e5"), "αβγ\u200b", "e\u0302\u0301s\u0323\u0307", "а", "n\u0303andu\u0301", "ﬁn"], strict=True):
        d = spark.createDataFrame([(want,)], "token string")
        assert d.select(lookalike._key(lookalike.F.col("token"))).first()[0] == lookalike.key_of(seen), want


def test_automaton_costs():
    t = lookalike.Trie()
    for w, n in (("baum", 3), ("raum", 9)):
        t.add(w, n)
    assert t.nearest("bаum") == "baum"
    assert t.nearest("saum") is None
    assert t.nearest("saum", 1) == "raum"
    assert t.nearest("baumm", 1) == "baum"
