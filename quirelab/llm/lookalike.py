"""Visually identical text brought to one form (problem 10).

Tokens that hold a suspect character (full-width form, look-alike letter, ignorable or combining mark,
special blank) are matched against the vocabulary of plain tokens of all documents. A trie of the vocabulary,
spelled in base letters and marks, is walked by a weighted edit automaton over the characters of the token as
it stands: ignorables are passed at no cost, a look-alike stands for the letter it is mostly used for at no
cost and for others it could be (`ӏ` for l, I or 1, `Ο` for O or 0) at DOUBT, and a visible edit costs 1. Within
BUDGET the cheapest, then most frequent, then smallest spelling is canonical, so the vocabulary decides where a
character has several readings; tokens it does not hold are normalised by table.

The vocabulary is split by the ends and the length of what all readings have in common (base letters, one
representative for letters that can stand for each other), so a task holds one small trie at a time. A hot
document or token counts once: work is done on distinct texts and distinct tokens. Documents are read twice:
for the classes and the suspect texts, and for the vocabulary. Pairs are made between classes of equal texts
that share a canonical form and only then expanded to documents.

Defined cases: null, empty and blank texts (also those of ignorables only) are no cases; identical texts
are no case; repeated rows count once; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut

# Letters of other scripts that look like Latin letters, and compatibility forms.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТХаеѕіјорсухԁһԛԝ", "ABESIJKMHOPCTXaesijopcyxdhqw", strict=True)) | {"У": "Y", "Ү": "Y", "ѵ": "v", "ӏ": "l", "Ԍ": "G", "ԍ": "g"}
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϲϳ", "ABEZHIKMNOPTYXovcj", strict=True))
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬆ": "st"}
OTHER = {"‐": "-", "‑": "-", "﹣": "-", "µ": "μ", "ꞌ": "'", "＇": "'"}
BLANKS = "               　\t"
#: Invisible: format characters, variation selectors, fillers.
IGNORABLE = "­͏؜ᅟᅠ឴឵᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁪⁫⁬⁭⁮⁯﻿" + "".join(map(chr, range(0xFE00, 0xFE10)))


# What else a look-alike may stand for; each group holds letters the same character can be read as.
READINGS = {"ӏ": "I1", "І": "l1", "Ι": "l1", "Ⅰ": "l1", "ⅼ": "I1", "ｌ": "I1", "Ｉ": "l1", "О": "0", "Ο": "0", "Ｏ": "0"}
GROUPS = ("lI1", "O0")
#: Cost of a reading that is not the usual one, and what a token may cost at most.
DOUBT, BUDGET = 0.25, 0.75


def _folds() -> dict[str, str]:
    """Look-alike or compatibility form -> plain spelling; the blocks follow from their code points."""
    table = CYRILLIC | GREEK | LIGATURES | OTHER
    table |= {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    for block in (range(0x1D400, 0x1D7FF), range(0x2160, 0x2180), range(0x212A, 0x212C)):
        table |= {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in block if unicodedata.normalize("NFKC", chr(c)) != chr(c)}
    return table


FOLD = _folds()
DROP = frozenset(IGNORABLE)


def _ranges(chars) -> str:
    """Inside of a Java character class: runs of code points as ranges (single members would be tried one by one)."""
    out, points = [], sorted(map(ord, chars))
    first = last = points[0]
    for p in [*points[1:], -1]:
        if p != last + 1:
            out.append(f"\\x{{{first:x}}}-\\x{{{last:x}}}")
            first = p
        last = p
    return "".join(out)


#: Most text has none of these; only the rest is held against the long class.
_UNUSUAL = r"[^\n -~À-ÿ°½–]"
_HIDDEN = "[" + _ranges(DROP) + "]"
_VISIBLE = r"[^\s" + _ranges({*DROP, *BLANKS}) + "]"
_SUSPECT = "[" + _ranges({*FOLD, *DROP, *BLANKS, "\r"}) + r"\p{M}]"
_SINGLE = {k: v for k, v in FOLD.items() if len(v) == 1 and ord(k) < 0x10000}


def by_table(token: str) -> str:
    """The table's normal form of a token."""
    return unicodedata.normalize("NFC", "".join(FOLD.get(c, c) for c in token if c not in DROP))


def base_letter(c: str) -> str:
    """The letter under the accents of a composed character."""
    d = unicodedata.normalize("NFD", c)
    return d[0] if len(d) > 1 and all(unicodedata.category(x)[0] == "M" for x in d[1:]) else c


_SAME = {c: g[0] for g in GROUPS for c in g}
#: Character of plain text -> its representative: composed letters of the Basic Multilingual Plane and the groups.
_REPRESENTATIVE = {chr(p): _SAME.get(base_letter(chr(p)), base_letter(chr(p))) for p in range(0x21, 0xD800) if base_letter(chr(p)) != chr(p)} | _SAME


def skeleton(token: str) -> str:
    """What all readings of a token have in common."""
    letters = (x for c in token if c not in DROP and unicodedata.category(c)[0] != "M" for x in FOLD.get(c, c))
    return "".join(_REPRESENTATIVE.get(c, c) for c in letters)


@lru_cache(1 << 14)
def steps(c: str) -> tuple[tuple[str, float], ...]:
    """(what a character spells in base letters and marks, cost) of each of its readings."""
    if c in DROP:
        return (("", 0.0),)
    spell = lambda x: unicodedata.normalize("NFD", x)
    out = {spell(c): 0.0, spell(FOLD.get(c, c)): 0.0}
    for other in READINGS.get(c, ""):
        out.setdefault(spell(other), DOUBT)
    return tuple(out.items())


class Trie:
    """Vocabulary in base letters and marks, with the documents each token stands in."""

    def __init__(self):
        self.root: dict = {}

    def add(self, token: str, n: int) -> None:
        node = self.root
        for c in unicodedata.normalize("NFD", token):
            node = node.setdefault(c, {})
        if "" not in node or (-n, token) < (-node[""][0], node[""][1]):
            node[""] = (n, token)

    def nearest(self, token: str, budget: float = BUDGET) -> str | None:
        """Canonical spelling within `budget`: cheapest, most frequent, smallest; else None."""
        chars = unicodedata.normalize("NFD", "".join(c for c in token if c not in DROP)) if any(map(unicodedata.combining, token)) else token
        best, seen, tick = None, set(), 0
        queue = [(0.0, 0, 0, self.root)]
        while queue:
            cost, _, i, node = heapq.heappop(queue)
            if cost > budget or best and cost > best[0]:
                break
            if (i, id(node)) in seen:
                continue
            seen.add((i, id(node)))
            if i == len(chars):
                if "" in node:
                    n, word = node[""]
                    if best is None or (cost, -n, word) < best:
                        best = (cost, -n, word)
            else:
                for spelled, price in steps(chars[i]):
                    at = node
                    for c in spelled:
                        at = at.get(c)
                        if at is None:
                            break
                    else:
                        tick += 1
                        heapq.heappush(queue, (cost + price, tick, i + 1, at))
            if cost + 1 <= budget:
                moves = [(i, child) for c, child in node.items() if c]
                if i < len(chars):
                    moves += [(i + 1, child) for c, child in node.items() if c] + [(i + 1, node)]
                for k, child in moves:
                    tick += 1
                    heapq.heappush(queue, (cost + 1, tick, k, child))
        return best[2] if best else None


#: Characters at each end of a skeleton that its key keeps.
ENDS = 3


def _key(token: Column) -> Column:
    """Length and ends of a plain token's skeleton."""
    part = F.translate(token, "".join(_REPRESENTATIVE), "".join(_REPRESENTATIVE.values()))
    return F.concat_ws("|", F.length(part).cast("string"), F.substring(part, 1, ENDS), F.substring(part, -ENDS, ENDS))


def key_of(token: str) -> str:
    """The key of a suspect token."""
    part = skeleton(token)
    return f"{len(part)}|{part[:ENDS]}|{part[-ENDS:]}"


def canonical_tokens(vocabulary: DataFrame, suspects: DataFrame, budget: float = BUDGET) -> DataFrame:
    """token, canonical of each of `suspects` (token), by tries of `vocabulary` (token, n)."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": b["token"].map(key_of), "token": b["token"]})

    s = cut(suspects.select("token").distinct().mapInPandas(keys, "key string, token string"))
    v = vocabulary.withColumn("key", _key(F.col("token"))).join(s.select("key").distinct(), "key", "left_semi")
    rows = v.select("key", F.lit(0).alias("kind"), "token", "n").unionByName(s.select("key", F.lit(1).alias("kind"), "token", F.lit(0).cast("long").alias("n")))
    rows = rows.repartition("key").sortWithinPartitions("key", "kind", F.desc("n"), "token")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, trie = None, Trie()
        for b in batches:
            found = []
            for key, kind, token, n in zip(b["key"], b["kind"], b["token"], b["n"], strict=True):
                if key != at:
                    at, trie = key, Trie()
                if kind == 0:
                    trie.add(token, n)
                else:
                    near = trie.nearest(token, budget)
                    found.append((token, by_table(token) if near is None else near))
            yield pd.DataFrame(found, columns=["token", "canonical"])

    return rows.mapInPandas(run, "token string, canonical string")


def is_suspect(c: Column) -> Column:
    """True for text with a character that may stand for another."""
    return c.rlike(_UNUSUAL) & c.rlike(_SUSPECT)


def _pieces(text: Column) -> Column:
    """Blanks of all kinds become a blank; tokens and blanks alternate."""
    text = F.regexp_replace(text, "\r\n?", "\n")
    return F.translate(text, BLANKS, " " * len(BLANKS))


def _words(text: Column) -> Column:
    return F.array_distinct(F.split(text, r"[ \n]+"))


def _classes(docs: DataFrame) -> DataFrame:
    """doc_id, h (md5 of the text), suspect, and the text where it is suspect, of documents with a visible character."""
    base = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull() & F.col("text").rlike(_VISIBLE))
    base = base.withColumn("suspect", is_suspect(F.col("text")))
    return base.select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"), "suspect", F.when(F.col("suspect"), F.col("text")).alias("text"), F.when(~F.col("suspect"), F.md5(F.trim("text").cast("binary"))).alias("form"))


def _canonical(docs: DataFrame, dirty: DataFrame) -> DataFrame:
    """h, canonical of the suspect texts `dirty` (h, text)."""
    suspects = cut(dirty.select("h", F.explode(F.filter(_words(_pieces(F.col("text"))), is_suspect)).alias("token")))
    text = F.col("text").cast("string")
    # a text that is not suspect has plain tokens only, split at blanks and line breaks
    words = F.when(is_suspect(text), F.filter(_words(_pieces(text)), lambda t: ~is_suspect(t))).otherwise(_words(text))
    vocabulary = docs.filter(text.isNotNull()).select(F.explode(words).alias("token")).filter("token <> ''").groupBy("token").agg(F.count("*").alias("n"))
    spelled = canonical_tokens(vocabulary, suspects)
    maps = suspects.join(spelled, "token").groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("token", "canonical"))).alias("m"))
    joined = dirty.join(maps, "h", "left")
    parts = F.regexp_extract_all(_pieces(F.col("text")), F.lit(r"([ \n]+|[^ \n]+)"), 1)
    canonical = F.array_join(F.transform(parts, lambda t: F.coalesce(F.try_element_at(F.coalesce("m", F.expr("map('', '')")), t), t)), "")
    return joined.select("h", canonical.alias("canonical"))


def normalize(docs: DataFrame) -> DataFrame:
    """doc_id, text in canonical form of every document; null stays null, blank texts are unchanged."""
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    dirty = cut(base.filter(F.col("text").rlike(_VISIBLE) & is_suspect(F.col("text"))).select(F.md5(F.col("text").cast("binary")).alias("h"), "text").dropDuplicates(["h"]))
    base = base.withColumn("h", F.when(is_suspect(F.col("text")), F.md5(F.col("text").cast("binary"))))
    return base.join(_canonical(docs, dirty), "h", "left").select("doc_id", F.coalesce("canonical", "text").alias("text"))


def pairs(docs: DataFrame) -> DataFrame:
    """doc_id_a < doc_id_b of documents that look the same but differ as character sequences."""
    rows = cut(_classes(docs).filter("doc_id is not null"))
    dirty = rows.filter("suspect").select("h", "text").dropDuplicates(["h"])
    forms = _canonical(docs, dirty).select("h", F.md5(F.trim("canonical").cast("binary")).alias("form"))
    classes = cut(rows.filter("not suspect").select("h", "form").distinct().unionByName(forms))
    # more than one text of one form
    several = classes.groupBy("form").agg(F.count("*").alias("c")).filter("c > 1")
    classes = cut(classes.join(several, "form", "left_semi"))
    a, b = classes.select("form", F.col("h").alias("ha")), classes.select("form", F.col("h").alias("hb"))
    links = a.join(b, "form").filter("ha < hb").select("ha", "hb")
    members = cut(rows.select("doc_id", "h").join(classes, "h", "left_semi").distinct())
    out = links.join(members.select(F.col("h").alias("ha"), F.col("doc_id").alias("x")), "ha").join(members.select(F.col("h").alias("hb"), F.col("doc_id").alias("y")), "hb")
    return out.select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b")).filter("doc_id_a < doc_id_b").distinct()
