"""TEI documents: a streaming reader that splits a body at page breaks, and a writer of page fragments.

Mixed content needs document order, which the built-in XML source loses, so both walk text as event streams
in an Arrow-batched function; a document or page is one row."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, functions as F, types as T

# Entity elements, and margin positions as written in documents.
ENTITIES = {"persName": "Person", "placeName": "Location", "orgName": "Institution"}
PLACES = ("left", "right", "mTop", "mBottom", "opposite", "inline")
PREFERRED = ("orig", "abbr", "reg", "expan")
EXTERNAL = ("d-nb.info", "/gnd/", "viaf.org", "geonames.org", "gbif.org", "wikidata.org")
LANG = "{http://www.w3.org/XML/1998/namespace}lang"


def local(tag: object) -> str:
    return tag.rsplit("}", 1)[-1] if isinstance(tag, str) else ""


def flow(node: ET.Element):
    """Events of a subtree in document order: (`text`, str), (`page`, element), (`note` | `figure` | `fw` | `entity`, element)."""

    def walk(n):
        name = local(n.tag)
        if name == "pb":
            yield "page", n
        elif name in ("anchor", "metamark") or n.get("type") == "editorial":
            return  # marks without text of the page, and what editors say about it
        elif name in ("note", "figure", "fw"):
            yield name, n
        elif name == "lb":
            yield "text", "\n"
        elif name == "gap":
            quantity, unit = n.get("quantity"), n.get("unit")
            yield "text", f"[{quantity} {unit} unleserlich]" if quantity and unit else "[...]"
        elif name == "supplied":
            yield "text", "[...]"
        elif name == "choice":
            options = {local(c.tag): c for c in n}
            pick = next((options[p] for p in PREFERRED if p in options), None)
            if pick is not None:
                yield from inside(pick)
        elif name == "del":
            if struck := " ".join("".join(n.itertext()).split()):
                yield "text", f"~~{struck}~~"
        elif name == "unclear":
            yield from inside(n)
            yield "text", "[?]"
        else:
            if name in ENTITIES:
                yield "entity", n
            yield from inside(n)
            if name in ("p", "head", "div", "bibl"):
                yield "text", "\n"

    def inside(n):
        if n.text:
            yield "text", re.sub(r"\s+", " ", n.text)
        for c in n:
            yield from walk(c)
            if c.tail:
                yield "text", re.sub(r"\s+", " ", c.tail)

    yield from inside(node)


def plain(node: ET.Element) -> str:
    return tidy("".join(v for k, v in flow(node) if k == "text"))


def tidy(s: str) -> str:
    s = re.sub(r"[ \t\r]+", " ", s)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r" *\n *", "\n", s)).strip()


def languages(node: ET.Element) -> list[str]:
    """First two letters of every language mark below a node (so `spa` gives `sp`)."""
    return sorted({n.get(LANG)[:2].lower() for n in node.iter() if n.get(LANG)})


def reference(node: ET.Element) -> tuple[str | None, str | None]:
    """(register id, external authority) that an entity element points to."""
    ref = next((v.strip() for a in ("ref", "key", "corresp", "sameAs") if (v := node.get(a)) and v.strip()), "")
    found = re.search(r"H\d{4,}", ref)
    outside = not found and ref.startswith(("http://", "https://")) or any(h in ref for h in EXTERNAL)  # pages of the register itself are not
    return (found[0] if found else None), (ref if ref and outside else None)


def parse(xml: str | None) -> list[dict]:
    """Pages of a document: folio, facs, regions, entities. Text before the first page break is dropped; a page
    without text, notes or figures is left out, but numbering goes on."""
    try:
        root = ET.fromstring((xml or "").encode())
    except ET.ParseError:
        return []
    body = next((n for n in root.iter() if local(n.tag) == "body"), root)
    pages: list[dict] = []
    for kind, v in flow(body):
        if kind == "page":
            pages.append({"folio": v.get("n"), "facs": v.get("facs"), "text": [], "note": [], "figure": [], "fw": [], "entity": []})
        elif pages:
            pages[-1]["text" if kind == "text" else kind].append(v)
    out = []
    for number, p in enumerate(pages, 1):
        regions, entities = [], []

        def add(kind, content, position=None, langs=(), visual=False, regions=regions):
            if content:
                regions.append({"region_index": len(regions), "region_type": kind, "content": content, "marginal_position": position, "languages": list(langs), "is_visual": visual})

        for n in p["fw"]:
            add("page_number" if "folNum" in n.get("type", "") else "catch_phrase", plain(n), None, ["de"])
        main = tidy("".join(p["text"]))
        add("main_text", main, None, ["de"])
        for n in p["note"]:
            place = n.get("place", "inline")
            position = place if place in PLACES else next((s for s in ("left", "right") if s in place), None)
            add("pasted_slip" if "sticked" in n.get("rend", "") else "marginal_note", plain(n), position, languages(n) or ["de"])
        for n in p["figure"]:
            found = next((x for tag in ("figDesc", "label", "p") if (x := [c for c in n.iter() if c is not n and local(c.tag) == tag])), [])
            labels = [t for c in found if (t := plain(c))]
            add("sketch", " ".join(labels) or "Hand-drawn illustration", None, (), True)
        held = p["entity"] + [e for n in p["note"] + p["figure"] for e in n.iter() if local(e.tag) in ENTITIES]
        seen = set()
        for e in held:
            text, kind = plain(e), ENTITIES[local(e.tag)]
            if text and (text, kind) not in seen:
                seen.add((text, kind))
                register, outside = reference(e)
                entities.append({"text": text, "entity_type": kind, "ehd_id": register, "authority_uri": outside, "language": (e.get(LANG) or "")[:2].lower() or None})
        if main or p["note"] or p["figure"]:
            out.append({"page_number": number, "folio_label": p["folio"], "facs": p["facs"], "regions": regions, "entities": entities})
    return out


_S = T.StringType()
_REGION = T.StructType([T.StructField("region_index", T.IntegerType()), *(T.StructField(n, _S) for n in ("region_type", "content", "marginal_position")), T.StructField("languages", T.ArrayType(_S)), T.StructField("is_visual", T.BooleanType())])
_ENTITY = T.StructType([T.StructField(n, _S) for n in ("text", "entity_type", "ehd_id", "authority_uri", "language")])
PAGES = T.ArrayType(T.StructType([T.StructField("page_number", T.IntegerType()), T.StructField("folio_label", _S), T.StructField("facs", _S), T.StructField("regions", T.ArrayType(_REGION)), T.StructField("entities", T.ArrayType(_ENTITY))]))
_u_parse = F.udf(parse, PAGES, useArrow=True)


def read(documents: DataFrame, xml: str = "xml") -> DataFrame:
    """One row per page of each document (a column of XML text); other columns are kept."""
    keep = [c for c in documents.columns if c != xml]
    return documents.select(*keep, F.explode(_u_parse(F.col(xml))).alias("p")).select(*keep, "p.*")


def read_files(spark, path: str) -> DataFrame:
    return read(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("xml")))


_MARK = re.compile(r"~~(?P<struck>.+?)~~|<u>(?P<under>.+?)</u>|(?P<unsure>\w+)\[\?\]|\[(?P<gap>\.\.\.|[^\]]*unleserlich)\]|\[(?P<given>[^\]\s]+)\]", re.S)


def inline(text: str, names: list[tuple[str, str]]) -> str:
    """Editorial marks and entity names as elements; line breaks as <lb/>."""
    out, at = [], 0
    for m in _MARK.finditer(text):
        out.append(_names(text[at : m.start()], names))
        kind = m.lastgroup
        inner = inline(m[kind], names) if kind in ("struck", "under", "given") else escape(m[kind])
        out.append({"struck": f'<del rendition="#s">{inner}</del>', "under": f'<hi rendition="#u">{inner}</hi>', "unsure": f"<unclear>{inner}</unclear>", "gap": "<gap/>", "given": f"<supplied>{inner}</supplied>"}[kind])
        at = m.end()
    return "".join(out) + _names(text[at:], names)


def _names(text: str, names: list[tuple[str, str]]) -> str:
    if names:
        finder = re.compile("|".join(re.escape(n) for n, _ in sorted(names, key=lambda x: -len(x[0]))))
        tag = dict(names)
        parts, at = [], 0
        for m in finder.finditer(text):
            parts += [escape(text[at : m.start()]), f"<{tag[m[0]]}>{escape(m[0])}</{tag[m[0]]}>"]
            at = m.end()
        return "".join([*parts, escape(text[at:])]).replace("\n", "<lb/>\n")
    return escape(text).replace("\n", "<lb/>\n")


_WRAP = {
    "page_number": '<fw type="folNum">{}</fw>', "catch_phrase": '<fw type="catch">{}</fw>', "entry_heading": "<head>{}</head>", "crossed_out": '<del rendition="#s">{}</del>',
    "bibliographic_ref": "<bibl>{}</bibl>", "pasted_slip": '<note rend="sticked" hand="#author"><p>{}</p></note>', "sketch": "<figure><figDesc>{}</figDesc></figure>",
}


def _field(r, name: str):
    """A field of a row that may lack it."""
    try:
        return r[name]
    except (KeyError, ValueError):
        return None


def _table_lines(table) -> str | None:
    """Cells two blanks apart, rows as lines; null cells are left out; None for a table without rows."""
    rows = (_field(table, "cells") if table is not None else None) or []
    return "\n".join("  ".join(c for c in row if c is not None) for row in rows if row is not None) if rows else None


def fragment(folio: str | None, facs: str | None, regions, entities) -> str:
    """One page: break, page furniture, then a division at each heading; regions come in reading order."""
    tags = {v: k for k, v in ENTITIES.items()}
    names = [(e["text"], tags[e["entity_type"]]) for e in entities if e["text"] and e["entity_type"] in tags]
    top, rest, is_open = [f"<pb n={quoteattr(folio or '')}" + (f" facs={quoteattr(facs)}" if facs else "") + "/>"], [], False
    for r in regions:
        kind, text, place = r["region_type"], r["content"] or "", r["marginal_position"]
        if place == "opposite" and not text.strip():
            continue
        if _field(r, "is_visual") and kind not in ("page_number", "catch_phrase", "entry_heading", "marginal_note", "pasted_slip"):
            kind = "sketch"
        if kind in ("observation_table", "instrument_list") and (lines := _table_lines(_field(r, "table_data"))) is not None:
            text = lines
        body = escape(text or "Hand-drawn illustration") if kind == "sketch" else inline(text, names)
        if kind == "marginal_note":
            one = '<note hand="#author"' + (f" place={quoteattr(place)}" if place in PLACES else "") + f"><p>{body}</p></note>"
        else:
            one = _WRAP.get(kind, "<p>{}</p>").replace("{}", body)
        if kind in ("page_number", "catch_phrase"):
            top.append(one)
            continue
        if kind == "entry_heading" or not is_open:
            rest.append("</div>" * is_open + '<div type="diaryEntry">')
            is_open = True
        rest.append(one)
    return "".join(top + rest + ["</div>" * is_open])


_u_fragment = F.udf(lambda n, f, r, e: fragment(n, f, list(r) if r is not None else [], list(e) if e is not None else []), T.StringType(), useArrow=True)


def write(pages: DataFrame) -> DataFrame:
    """page_id, page_number, fragment of pages with folio_label, image_filename, regions, entities (ordered arrays of structs)."""
    return pages.select("page_id", "page_number", _u_fragment("folio_label", "image_filename", "regions", "entities").alias("fragment"))


def document(fragments: DataFrame, title: str, path: str) -> None:
    """A whole document from page fragments in order, streamed to a file."""
    with open(path, "w", encoding="utf-8") as f:
        f.write(f'<?xml version="1.0" encoding="UTF-8"?>\n<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>{escape(title)}</title></titleStmt></fileDesc></teiHeader><text><body>\n')
        for r in fragments.orderBy("page_number", "page_id").toLocalIterator():
            f.write(r["fragment"] + "\n")
        f.write("</body></text></TEI>\n")


def page_structs(pages: DataFrame, regions: DataFrame, mentions: DataFrame) -> DataFrame:
    """Pages with ordered regions (top to bottom, then left to right) and their entities, as `write` takes them."""
    box = F.col("bbox")
    order = F.struct((~F.coalesce(F.size(box) == 4, F.lit(False))).alias("boxless"), box[0].alias("y"), box[1].alias("x"), "region_index", "region_id", "region_type", "content", "marginal_position", "is_visual", "table_data")
    r = regions.groupBy("page_id").agg(F.array_sort(F.collect_list(order)).alias("regions"))
    m = mentions.filter(F.col("entity_type").isin(*ENTITIES.values())).groupBy("page_id").agg(F.array_sort(F.collect_set(F.struct("text", "entity_type"))).alias("entities"))
    return pages.join(r, "page_id", "left").join(m, "page_id", "left")
