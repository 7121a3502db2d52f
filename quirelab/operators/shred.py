"""Deeply nested page records as flat tables that keep the link from child to parent (problem 2).

A payload is shredded into one column per leaf path, each entry with a repetition level (at which list a
new element began) and a definition level (how far down the path values exist). The table of a repeated
ancestor (pages, regions, entities, locations, cells, ground-truth entities, and each list of plain values:
entry numbers, languages, box coordinates, readings) is put together from the level sequences of the leaves
below it alone: repetition levels give the places, definition levels say whether the element is there. Every
leaf of the schema stands in one table, so the tables together give the payload back. Both steps are per record, in one narrow Python stage; nothing is shuffled but the
removal of records sent twice.

Shapes that vary are brought to the schema first: one page or a list of pages, an object where a list is
meant, a table as JSON text or as bare rows. Unknown keys are ignored, absent keys equal null.

Defined cases: null, empty, blank and incomplete payloads, and payloads that hold no object, give no rows;
null elements and null or blank cells give none but keep their place; a record sent twice counts once;
rows with a null record_id give none.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F


@dataclass
class Node:
    """A field of the nested schema: a leaf, a group of fields, or a list of one element node."""

    name: str
    kind: str
    children: list[Node] = field(default_factory=list)


def leaf(name: str) -> Node:
    return Node(name, "leaf")


def group(name: str, *children: Node) -> Node:
    return Node(name, "group", list(children))


def many(name: str, child: Node) -> Node:
    return Node(name, "list", [child])


def leaves(*names: str) -> list[Node]:
    return [leaf(n) for n in names]


# The keys of a page result.
ENTITY_KEYS = (
    "text", "entity_type", "start_char", "end_char", "context", "normalized_form", "language", "ehd_id",
    "ehd_url", "authority_uri", "authority_label", "link_method", "link_score", "link_ambiguous",
)
LOCATION_KEYS = ("name", "lat", "lon", "display_name", "wikidata_id", "geonames_id", "source", "resolved_query")
REGION_KEYS = (
    "region_type", "region_index", "content", "is_visual", "editorial_note", "position", "crossed_out_text",
    "related_to_entry", "marginal_position", "writing_layer", "tei_id", "ground_truth_content",
    "ground_truth_confidence", "content_pre_consistency", "region_reading",
)
PAGE_KEYS = ("page_number", "image_filename", "folio_label", "full_text", "processing_timestamp", "model_used")

SCHEMA = many("pages", group(
    "page", *leaves(*PAGE_KEYS),
    many("entry_numbers", leaf("number")), many("page_languages", leaf("language")),
    many("regions", group(
        "region", *leaves(*REGION_KEYS),
        many("languages", leaf("language")), many("bbox", leaf("coordinate")),
        many("uncertain_readings", leaf("reading")), many("ensemble_readings", leaf("reading")),
        group("table_data", leaf("caption"), many("cells", many("row", leaf("cell")))),
        many("ground_truth_entities", group("gt_entity", *leaves(*ENTITY_KEYS))),
    )),
    many("entities", group("entity", *leaves(*ENTITY_KEYS))),
    many("locations", group("location", *leaves(*LOCATION_KEYS))),
))

#: Table -> path of the repeated element it has a row for; of a list of plain values, the path of the value.
TABLES = {
    "page": (),
    "region": ("regions",),
    "entity": ("entities",),
    "location": ("locations",),
    "table_cell": ("regions", "table_data", "cells", "row", "cell"),
    "gt_entity": ("regions", "ground_truth_entities"),
    "entry_number": ("entry_numbers", "number"),
    "page_language": ("page_languages", "language"),
    "region_language": ("regions", "languages", "language"),
    "bbox": ("regions", "bbox", "coordinate"),
    "uncertain_reading": ("regions", "uncertain_readings", "reading"),
    "ensemble_reading": ("regions", "ensemble_readings", "reading"),
}
#: The tables found() lists, and single groups whose leaves belong to the row of the element around them.
CHILDREN = ("region", "entity", "location", "table_cell", "gt_entity")
SINGLE = ("table_data",)


@dataclass
class Column:
    """Entries of one leaf path; `defined` has the definition level at which the element of each list on the path exists."""

    path: tuple[str, ...]
    defined: list[int]
    reps: list[int] = field(default_factory=list)
    defs: list[int] = field(default_factory=list)
    values: list[str | None] = field(default_factory=list)


def columns_of(node: Node, path: tuple = (), level: int = 0, defined: tuple = ()) -> dict[tuple, Column]:
    """Empty columns for every leaf below `node`."""
    if node.kind == "leaf":
        return {path: Column(path, list(defined))}
    out = {}
    if node.kind == "list":
        child = node.children[0]
        below = path if child.kind == "group" else (*path, child.name)
        # a list takes a level for being there and one for each element being there
        out |= columns_of(child, below, level + 2, (*defined, level + 2))
    else:
        for child in node.children:
            out |= columns_of(child, (*path, child.name), level + (child.kind != "list"), defined)
    return out


@lru_cache
def _shape() -> tuple[dict[tuple, tuple[int, ...]], dict[tuple, list[tuple]]]:
    """Of the schema: the definition levels of each leaf, and the leaves under each path."""
    cols = columns_of(SCHEMA)
    under: dict[tuple, list[tuple]] = {}
    for p in cols:
        for i in range(len(p) + 1):
            under.setdefault(p[:i], []).append(p)
    return {p: tuple(c.defined) for p, c in cols.items()}, under


def empty_columns() -> dict[tuple, Column]:
    return {p: Column(p, list(d)) for p, d in _shape()[0].items()}


def shred(value: object, node: Node, columns: dict[tuple, Column], under: dict[tuple, list[tuple]] | None = None) -> None:
    """Append one record's entries to `columns`."""
    if under is None:
        under = {}
        for p in columns:
            for i in range(len(p) + 1):
                under.setdefault(p[:i], []).append(p)

    def absent(path: tuple, rep: int, level: int) -> None:
        for p in under[path]:
            c = columns[p]
            c.reps.append(rep)
            c.defs.append(level)
            c.values.append(None)

    def walk(v: object, n: Node, path: tuple, rep: int, depth: int, level: int) -> None:
        """level: definition level of what surrounds v; depth: lists entered so far."""
        if n.kind == "leaf":
            c = columns[path]
            c.reps.append(rep)
            c.defs.append(level)
            c.values.append(v if isinstance(v, str) else json.dumps(v, ensure_ascii=False))
        elif n.kind == "group":
            for child in n.children:
                x = v.get(child.name) if isinstance(v, dict) else None
                if x is None:
                    absent((*path, child.name), rep, level)
                elif child.kind == "list":
                    walk(x, child, (*path, child.name), rep, depth, level)
                else:
                    walk(x, child, (*path, child.name), rep, depth, level + 1)
        else:
            items = v if isinstance(v, list) else [v]
            child = n.children[0]
            below = path if child.kind == "group" else (*path, child.name)
            if not items:
                absent(path, rep, level + 1)
            for k, x in enumerate(items):
                r = rep if k == 0 else depth + 1
                if x is None:
                    absent(path, r, level + 1)
                else:
                    walk(x, child, below, r, depth + 1, level + 2)

    walk(value, node, (), 0, 0, 0)


def places(column: Column, lists: int) -> Iterator[tuple[int, tuple[int, ...], bool]]:
    """(entry, places in the first `lists` lists, is there) for each element of the list at that depth, from levels alone."""
    at = [-1] * (lists + 1)
    need = column.defined[lists - 1]
    for k, (r, d) in enumerate(zip(column.reps, column.defs, strict=True)):
        if r > lists:
            continue
        if r == 0:
            at = [0] * (lists + 1)
        else:
            at[r] += 1
            at[r + 1 :] = [0] * (lists - r)
        yield k, tuple(at[1:]), d >= need


def parse(payload: str | None) -> list | None:
    """Pages of a payload in the schema's shape; None if it is no complete JSON or holds no page."""
    if not payload or not payload.strip():
        return None
    try:
        v = json.loads(payload)
    except (ValueError, RecursionError):
        return None
    if not isinstance(v, dict | list):
        return None
    pages = v if isinstance(v, list) else [v]
    out = []
    for page in pages:
        if not isinstance(page, dict):
            out.append(None)
            continue
        regions = page.get("regions")
        if regions is not None:
            regions = [dict(r, table_data=_table(r.get("table_data"))) if isinstance(r, dict) else r for r in (regions if isinstance(regions, list) else [regions])]
        out.append(dict(page, regions=regions))
    return out


def _table(t: object) -> dict | None:
    """A table as an object with cells, whatever form it came in."""
    if isinstance(t, str):
        try:
            t = json.loads(t)
        except ValueError:
            return None
    if isinstance(t, list):
        t = {"cells": t}
    return t if isinstance(t, dict) else None


def _assemble(cols: dict[tuple, Column], child: str) -> tuple[list[Column], int]:
    """The leaf columns that have one entry per element of a table, and the number of lists above."""
    at = TABLES[child]
    if at in cols:
        return [cols[at]], len(cols[at].defined)
    own = [c for p, c in cols.items() if p[:-1] == at or p[:-2] == at and p[-2] in SINGLE]
    lists = min(len(c.defined) for c in own)
    return [c for c in own if len(c.defined) == lists], lists


def _shredded(b: pd.DataFrame) -> Iterator[tuple[int, dict[tuple, Column]]]:
    """record_id and level columns of each readable payload."""
    under = _shape()[1]
    for record, payload in zip(b["record_id"], b["payload"], strict=True):
        if (pages := parse(payload)) is not None:
            cols = empty_columns()
            shred(pages, SCHEMA, cols, under)
            yield record, cols


def _records(records: DataFrame) -> DataFrame:
    return records.select(F.col("record_id").cast("long").alias("record_id"), F.col("payload").cast("string").alias("payload")).filter("record_id is not null").dropDuplicates(["record_id"])


def found(records: DataFrame) -> DataFrame:
    """record_id, page_pos, child, pos1, pos2, pos3 of each child below the pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for record, cols in _shredded(b):
                for child in CHILDREN:
                    some, lists = _assemble(cols, child)
                    c = some[0]
                    for k, at, there in places(c, lists):
                        if there and (child != "table_cell" or c.values[k].strip()):
                            out.append((record, at[0], child, *at[1:], *[-1] * (4 - len(at))))
            yield pd.DataFrame(out, columns=["record_id", "page_pos", "child", "pos1", "pos2", "pos3"])

    return _records(records).mapInPandas(run, "record_id long, page_pos long, child string, pos1 long, pos2 long, pos3 long")


def flat(records: DataFrame, child: str) -> DataFrame:
    """One flat table: record_id, page_pos, the places of its lists (pos1 to pos3), and its leaf fields as text."""
    some, lists = _assemble(empty_columns(), child)
    names = ["value" if TABLES[child] == c.path and child != "table_cell" else c.path[-1] for c in some]
    places_ = ["page_pos", "pos1", "pos2", "pos3"][:lists]
    schema = ", ".join(["record_id long", *(f"{p} long" for p in places_), *(f"`{n}` string" for n in names)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for record, cols in _shredded(b):
                leafs, n = _assemble(cols, child)
                sequences = [[c.values[k] for k, _, _ in places(c, n)] for c in leafs]
                for i, (_, at, there) in enumerate(places(leafs[0], n)):
                    if there and (child != "table_cell" or sequences[0][i].strip()):
                        out.append((record, *at, *(s[i] for s in sequences)))
            yield pd.DataFrame(out, columns=["record_id", *places_, *names])

    return _records(records).mapInPandas(run, schema)


def levels(records: DataFrame) -> DataFrame:
    """The shredded form itself: record_id, path, reps, defs, values of each leaf column."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(record, ".".join(p), c.reps, c.defs, c.values) for record, cols in _shredded(b) for p, c in cols.items()]
            yield pd.DataFrame(out, columns=["record_id", "path", "reps", "defs", "values"])

    return _records(records).mapInPandas(run, "record_id long, path string, reps array<int>, defs array<int>, values array<string>")
