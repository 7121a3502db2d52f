"""Variant spellings of persons and institutions (problem 7): merge-and-rematch resolution.

Every row becomes a profile: spellings of the surname (or of an institution's place), forenames in one
spelling, initials, years, calling. Profiles that agree are merged; a merged profile holds the union of
spellings, initials and years, enters blocking again under all of them, and may now match what its parts
could not. Rounds go on until none merges.

Blocking: a profile stands in the block of each of its spellings, and of every more frequent spelling one edit
away (found by an equality join on strings with one character left out), so any two such spellings meet. Two
kinds of round take turns. In the first a block is split by initial: full forenames are compared first, then
initials that fit one person only. In the second, bare surnames of a block are held against the persons found
so far, by year, calling and size; years must not contradict, so relatives stay apart. Initials and bare surnames
go to another spelling only if it is several times as frequent (frequencies are compared as ratios only, so rows
sent again under new ids change nothing); where both are about as frequent, a full forename or two initials must
agree, or one of the spellings, not above average in frequency, stand without any full forename and a single person fit; of several such links a profile takes the one to the largest person, if its own spelling gave it none.
Rows that say the same are one profile with a count from the start, and within a block persons are looked up by
forename, initial, year and calling, so a hot name costs its distinct forms and no profile is held against all
persons of its block.
Forenames: a fixed table, and nicknames learned from rows that give two forms; a short form that begins several
forenames counts as an initial.

Defined cases: rows without a usable name stand alone; a row sent twice counts once; null ids are left out;
unreadable years are missing; a surname that several persons share is linked only where one of them is far
more frequent or alone shares the calling.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from .sampling import bounded

# Forenames and their short and foreign forms, titles, particles and epithets.
FORENAMES = {
    "wilhelm": "willi wilh", "william": "will bill wm", "guillermo": "guillaume memo guill", "georg": "jörg georges geo george jorge",
    "johann": "hans hannes jean joh johannes juan john", "joseph": "sepp josé pepe jos josef", "friedrich": "fritz frédéric frdr fr frederick",
    "francisco": "paco françois franco franz", "charles": "carl carlos karl chas", "louis": "ludwig luis ls", "étienne": "ét stephan steffen esteban",
    "thomas": "th tom thos tomás", "theodor": "theo teodoro", "ulrich": "ulr uli", "quirin": "quir", "robert": "rob robt bob roberto",
    "elisabeth": "elis liesel betty isabel", "andreas": "andr andrés andré", "marguerite": "margot", "margarethe": "marg grete", "bartholomäus": "barth barthel",
    "antoine": "anton toine ant antonio", "aurora": "", "katharina": "cath käthe trina catherine", "michael": "mich michel miguel", "damián": "dam damian",
    "gottlieb": "gottl", "beatriz": "bea", "leopold": "leop poldi", "heinrich": "heinz heinr henri", "jacob": "jac jakob jacques", "magdalena": "magd lena",
    "peter": "pet pedro pierre", "dolores": "lola", "ignacio": "ign nacho", "eleanor": "ellen nell leonor", "alexander": "alex alejandro alexandre", "maria": "marie",
}
TITLES = frozenset("dr prof hr herr frau don doña mr mrs sr señor mme mlle monsieur der die alte junge the late le la célèbre el young old".split())
PARTICLES = frozenset("de von van du v d der la del den des zu".split())
INSTITUTIONS = (
    ("bergamt", r"bergamt|b\.-? ?amt"), ("plantes", r"jard|plantes|d\. pl\."), ("colegio", r"coleg|miner|\bcol\. de"), ("academie", r"acad|sc\. util|sciences"),
    ("literary", r"liter|\blit\."), ("amigos", r"sociedad|amigos|soc\. am|d\. país"), ("garten", r"botan|garten|\bbot\."), ("naturfreunde", r"naturf|königl|kgl|gesellsch"), ("society", r"society|\bsoc\."),
)
_ALIAS = {a: k for k, v in FORENAMES.items() for a in (k, *v.split())}
#: Short forms that begin another forename too (`Th.`, `Fr.`, `Marg.`): with a full stop they are initials.
_OPEN = frozenset(a for a, k in _ALIAS.items() if any(o != k and f.startswith(a) and len(f) > len(a) for f, o in _ALIAS.items()))
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?\.?")


def plain(s: str) -> str:
    """Lower case without accents; umlauts as two letters."""
    s = s.lower().replace("ä", "ae").replace("ö", "oe").replace("ü", "ue").replace("ß", "ss")
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


# Spellings of one sound.
SOUNDS = (("ph", "f"), ("th", "t"), ("ck", "k"), ("y", "i"))


def sound(s: str) -> str:
    """A surname without differences of spelling that leave its sound."""
    for written, heard in SOUNDS:
        s = s.replace(written, heard)
    return s


def clean(s: str | None) -> str:
    s = re.sub(r"~~[^~]*~~|\[\?\]|</?u>|[\[\]?]", "", s or "")
    return re.sub(r"\s+", " ", re.sub(r"[-=¬⸗­]+ ?\n\s*|(?<=[^\W\d_])- (?=[^\W\d_])", "", s)).strip()


def one_edit(a: str, b: str) -> bool:
    """True if at most one letter is put in, left out, replaced or swapped with the next."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


_NEAR: dict[str, str | None] = {}


def forename(token: str, alias: dict[str, str]) -> str | None:
    """The common form of a forename, typos of one letter included."""
    t = token.lower().rstrip(".")
    hit = alias.get(t)
    if hit is None and len(t) >= 5 and not token.endswith("."):
        if t not in _NEAR:
            if len(_NEAR) > 200_000:
                _NEAR.clear()
            found = {alias[k] for k in alias if len(k) >= 5 and abs(len(k) - len(t)) < 2 and k[:1] + k[-1:] != "" and (k[0] == t[0] or k[-1] == t[-1]) and one_edit(k, t)}
            _NEAR[t] = found.pop() if len(found) == 1 else None
        hit = _NEAR[t]
    return hit


def person(s: str, alias: dict[str, str]) -> tuple[str, list[str], set[str]]:
    """(surname, forenames: full ones in common form, initials as one letter, other first initials) of a name as typed."""
    s = clean(s)
    tokens = _TOKEN.findall(s)
    given, family, other = [], [], set()
    for i, t in enumerate(tokens):
        low = t.lower().rstrip(".")
        if low in PARTICLES and t[0].islower() or low in TITLES:
            continue
        if t.endswith(".") and len(low) == 1:
            if low == "m" and i == 0 and s.find(",") < 0:  # Monsieur, or an initial if another follows
                if len(tokens) > 1 and len(tokens[1]) == 2 and tokens[1].endswith("."):
                    other = {"m"}
                continue
            given.append(low)
        elif t.endswith(".") and low in _OPEN:
            given.append(low[0])
        elif (f := forename(t, alias)) is not None:
            given.append(f)
        elif t.endswith(".") and len(low) < 6 and i + 1 < len(tokens):
            given.append(low[0])
        else:
            joined = next((k for k in alias if len(k) >= 4 and low.startswith(k) and len(low) - len(k) >= 5 and low != t and t[len(k) : len(k) + 1].isupper()), None)
            if joined:
                given.append(alias[joined])
                low = low[len(joined) :]
            family.append(low)
    surname = plain(max(family, key=len)) if family else ""
    return (surname if len(surname) >= 3 else ""), given[:2], other


def institution(s: str) -> tuple[str, str]:
    """(place, kind) of an institution's name; the place is its last word."""
    s = clean(s)
    low = s.lower()
    kind = next((k for k, p in INSTITUTIONS if re.search(p, low)), "")
    if kind == "society":
        kind = ""
    words = re.findall(r"[^\W\d_]+", s)
    return (plain(words[-1]) if words else ""), kind


def year(s: str | None) -> str:
    m = re.search(r"\d{4}", s or "")
    return m[0] if m else ""


def _profile(kind, text, nf, surname, birth, death, note, alias):
    """(type, spellings, firsts, seconds, initials, births, deaths, callings) of a row."""
    spellings, firsts, seconds, initials = set(), set(), set(), set()
    if kind == "Institution":
        for s in (text, nf):
            if s and s.strip():
                place, k = institution(s)
                if place:
                    spellings.add(place)
                if k:
                    firsts.add(k)
    else:
        for s in (text, nf):
            if s and s.strip():
                own, given, other = person(s, alias)
                if own:
                    spellings.add(own)
                firsts |= other
                for g, into in zip(given, (firsts, seconds), strict=False):
                    into.add(g)
        if surname and surname.strip():
            own, _, _ = person(surname, {})
            if own:
                spellings.add(own)
    for s in (firsts, seconds):
        full = {g for g in s if len(g) > 1}
        s -= {g for g in s if len(g) == 1 and any(plain(f)[0] == plain(g) for f in full)}
    initials |= {plain(g)[0] for g in firsts}
    callings = {note} if note and "register" not in note.lower() and kind != "Institution" else set()
    return (kind or "", sorted(spellings), sorted(firsts), sorted(seconds), sorted(initials), [y] if (y := year(birth)) else [], [y] if (y := year(death)) else [], sorted(callings))


#: How many times as frequent a spelling must be to take initials and bare surnames of another.
CLEAR = 3
_FIELDS = "type string, spellings array<string>, firsts array<string>, seconds array<string>, initials array<string>, births array<string>, deaths array<string>, callings array<string>"
_SETS = ("spellings", "firsts", "seconds", "initials", "births", "deaths", "callings")


#: Pairs of forename forms the driver will read.
NICKNAMES = 1_000_000


def nicknames(rows: DataFrame) -> dict[str, str]:
    """Forename forms beyond the table, from rows whose two names share the surname and differ in the forename.

    Counts are over all rows; what is kept grows with the number of nicknames."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen = defaultdict(int)
            for text, nf in zip(b["text"], b["normalized_form"], strict=True):
                if not text or not nf:
                    continue
                x, y = _TOKEN.findall(clean(text)), _TOKEN.findall(clean(nf))
                same = {t.lower() for t in x} & {t.lower() for t in y}
                a = [t.lower().rstrip(".") for t in x if t.lower() not in same and t.lower().rstrip(".") not in PARTICLES | TITLES]
                g = [_ALIAS[t.lower()] for t in y if t.lower() in _ALIAS]
                if len(a) == 1 and len(g) == 1 and a[0] not in _ALIAS and len(a[0]) > 1 and any(len(t) > 4 and t not in _ALIAS for t in same):
                    seen[a[0], g[0]] += 1
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["short", "full", "n"])

    found = rows.select("text", "normalized_form").mapInPandas(run, "short string, full string, n long").groupBy("short", "full").agg(F.sum("n").alias("n")).filter("n >= 5")
    by = defaultdict(dict)
    for r in bounded(found, NICKNAMES, "nicknames"):
        by[r["short"]][r["full"]] = r["n"]
    return {s: max(f, key=f.get) for s, f in by.items() if max(f.values()) >= 0.8 * sum(f.values())}


def profiles(rows: DataFrame) -> DataFrame:
    """name_id and the profile of each row; a row sent twice counts once."""
    names = ("entity_type", "text", "normalized_form", "surname", "birth", "death", "note")
    r = rows.select(F.col("name_id").cast("long").alias("name_id"), *(F.col(c).cast("string").alias(c) for c in names)).filter("name_id is not null").dropDuplicates(["name_id"])
    r = cut(r)
    alias = _ALIAS | nicknames(r.filter("entity_type = 'Person'"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(i, *_profile(*x, alias)) for i, *x in zip(b["name_id"], *(b[c] for c in names), strict=True)]
            yield pd.DataFrame(out, columns=["name_id", "type", *_SETS])

    return r.mapInPandas(run, "name_id long, " + _FIELDS)


def _left_out(s: Column) -> Column:
    """A string and what is left of it without each of its letters."""
    return F.concat(F.array(s), F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s)))))


def _neighbours(p: DataFrame) -> DataFrame:
    """type, s, hub, near, lone: spellings and the more frequent ones an edit away.

    near: only forenames may decide; lone: no full forename goes with `s`, which is no more frequent than the average.
    Merging makes no new spellings, so this is worked out once."""
    full = F.exists("firsts", lambda g: F.length(g) > 1)
    spelled = p.select("type", "size", full.cast("int").alias("full"), F.explode("spellings").alias("s"))
    counts = cut(spelled.groupBy("type", "s").agg(F.sum("size").alias("n"), (F.max("full") == 0).alias("lone")))
    usual = counts.agg(F.avg("n")).first()[0] or 0.0
    heard = F.col("s")
    for written, as_heard in SOUNDS:
        heard = F.replace(heard, F.lit(written), F.lit(as_heard))
    keyed = counts.filter("length(s) >= 5").withColumn("heard", heard).withColumn("lone", F.col("lone") & (F.col("n") <= usual))
    keyed = keyed.select("*", F.explode(F.array_union(_left_out(F.col("s")), _left_out(F.col("heard")))).alias("key"))
    hub = keyed.select("type", "key", F.col("s").alias("hub"), F.col("heard").alias("hub_heard"), F.col("n").alias("m"))
    pairs = keyed.join(hub, ["type", "key"]).filter("n < m or n = m and s > hub")
    # the strings share a remainder; that allows one replacement, insertion, omission or swap, and little else
    edits = F.least(F.levenshtein("s", "hub"), F.levenshtein("heard", "hub_heard"))
    return pairs.filter(edits <= 2).select("type", "s", "hub", F.expr(f"m < {CLEAR} * n").alias("near"), "lone").distinct()


def _blocks(p: DataFrame, neighbours: DataFrame, bare: bool) -> DataFrame:
    """cid, type, block, part, near, lone: each profile under its spellings and their neighbours.

    part is the initial; in the rounds for bare surnames blocks are whole."""
    full = F.exists("firsts", lambda g: F.length(g) > 1)
    spelled = p.select("cid", "type", "firsts", "seconds", "initials", F.explode("spellings").alias("s"))
    own = spelled.select("cid", "type", F.col("s").alias("block"), F.lit(False).alias("near"), F.lit(False).alias("lone"), "initials")
    telling = full | (F.size("firsts") > 0) & (F.size("seconds") > 0) | F.col("lone")
    others = spelled.join(neighbours, ["type", "s"]).filter(~F.col("near") | telling).select("cid", "type", F.col("hub").alias("block"), "near", "lone", "initials")
    every = own.unionByName(others).withColumn("part", F.lit("") if bare else F.explode("initials"))
    return every.groupBy("cid", "type", "block", "part").agg(F.min("near").alias("near"), F.max("lone").alias("lone"))


def _fits(a: dict, b: dict) -> bool:
    """Years and forenames don't contradict."""
    for f in ("births", "deaths"):
        if a[f] and b[f] and not a[f] & b[f]:
            return False
    if a["type"] == "Institution":
        return not a["firsts"] or not b["firsts"] or bool(a["firsts"] & b["firsts"])
    for f in ("firsts", "seconds"):
        x, y = {g for g in a[f] if len(g) > 1}, {g for g in b[f] if len(g) > 1}
        if x and y:
            if not x & y:
                return False
        elif a[f] and b[f] and not {plain(g)[0] for g in a[f]} & {plain(g)[0] for g in b[f]}:
            return False
    return True


def _full(p: dict) -> set[str]:
    return {g for g in p["firsts"] if len(g) > 1}


def _alike(a: dict, b: dict) -> bool:
    """A spelling in common, or two that are one edit apart."""
    return any(one_edit(x, y) or one_edit(sound(x), sound(y)) for x in a["spellings"] for y in b["spellings"])


class _Persons:
    """Persons of one block, found by forename, initial, year or calling without going through all of them."""

    def __init__(self):
        self.links: list[tuple[int, int, bool, int]] = []
        self.every: list[dict] = []
        self.by: dict[tuple[str, str], list[dict]] = defaultdict(list)

    def add(self, p: dict) -> None:
        g = dict(p)
        g["at"] = len(self.every)
        self.every.append(g)
        self._file(g, p)

    def _file(self, g: dict, p: dict) -> None:
        """Put a person under what `p` says; a person may stand in a list twice."""
        for f in ("firsts", "births", "deaths", "callings"):
            for x in p[f]:
                self.by[f, x].append(g)
        for x in p["firsts"]:
            self.by["initial", plain(x)[0]].append(g)

    def join(self, g: dict, p: dict) -> None:
        self.links.append((p["cid"], g["cid"], p["near"] or g["near"], g["size"]))
        self._file(g, {f: p[f] - g[f] for f in _SETS})
        for f in _SETS:
            g[f] = g[f] | p[f]
        g["size"] += p["size"]
        g["near"] = g["near"] and p["near"]

    def under(self, field: str, values) -> list[dict]:
        return list({g["at"]: g for v in sorted(values) for g in self.by.get((field, v), ())}.values())


def resolve_names(members: list[dict]) -> list[tuple[int, int, bool, int]]:
    """(profile, profile it joins, whether across spellings about as frequent, size of what it joins) of profiles with one initial within one block."""
    persons = _Persons()
    members = sorted(members, key=lambda p: (-bool(_full(p)), -len(p["seconds"]), -len(p["firsts"]), -p["size"], p["cid"]))
    known = any(not p["near"] and _full(p) for p in members)
    for p in members:
        full = _full(p)
        if full:
            near = [g for g in persons.under("firsts", full) if _fits(g, p) and (not (g["near"] or p["near"]) or _alike(g, p))]
            strong = [g for g in near if g["seconds"] & p["seconds"] or g["births"] & p["births"] or g["deaths"] & p["deaths"]]
            near = strong or near
            # without a second forename to tell, namesakes stay apart
            if len(near) == 1 or near and not p["seconds"] and near[0]["size"] >= 3 * max(g["size"] for g in near[1:]):
                persons.join(near[0], p)
            elif not near:
                persons.add(p)
            continue
        near = [g for g in persons.under("initial", {plain(f)[0] for f in p["firsts"]}) if _fits(g, p)]
        sure = [g for g in near if not (g["near"] or p["near"])]
        if not sure and near:
            alone = p["lone"] if p["near"] else not known
            sure = [g for g in near if (alone or g["seconds"] and p["seconds"]) and _alike(g, p)]
            if len(sure) > 1:  # across spellings only where one person fits
                continue
        _settle(persons, p, sure)
    return persons.links


def _settle(persons: _Persons, p: dict, near: list[dict]) -> None:
    """Join a profile without a full forename to the one person it can mean, if there is one."""
    if len(near) > 1:
        near = [g for g in near if g["births"] & p["births"] or g["deaths"] & p["deaths"]] or near
    if len(near) > 1 and p["seconds"]:
        near = [g for g in near if g["seconds"]] or near
    if len(near) > 1 and p["callings"]:
        near = [g for g in near if g["callings"] & p["callings"]] or near
    near.sort(key=lambda g: (-g["size"], g["cid"]))
    if len(near) == 1 or near and near[0]["size"] >= 3 * near[1]["size"]:
        persons.join(near[0], p)
    elif not near:
        persons.add(p)


def resolve_bare(members: list[dict]) -> list[tuple[int, int, bool, int]]:
    """The same for the profiles of a whole block that have no forename, against the persons that have one.

    Persons that share a year, then those that share the calling, are looked up; for the rest, those that fit are
    taken by size until a second one is found."""
    bare = sorted((p for p in members if not p["firsts"]), key=lambda p: (-len(p["births"]) - len(p["deaths"]), -p["size"], p["cid"]))
    if not bare:
        return []
    persons, across = _Persons(), _Persons()
    for p in sorted((p for p in members if p["firsts"]), key=lambda p: (-p["size"], p["cid"])):
        (across if p["near"] else persons).add(p)
    own = bool(persons.every)
    for p in bare:
        if p["near"] or not own and across.every:  # another spelling, about as frequent: only where one person fits
            one = list(islice((g for g in (persons if p["near"] else across).every if g["firsts"] and _fits(g, p)), 2))
            if len(one) == 1 and _alike(one[0], p):
                persons.links.append((p["cid"], one[0]["cid"], True, one[0]["size"]))
                continue
            if p["near"]:
                continue
        dated = [g for g in {g["at"]: g for f in ("births", "deaths") for g in persons.under(f, p[f])}.values() if _fits(g, p)]
        if dated:
            _settle(persons, p, dated)
            continue
        near, called = [], [g for g in persons.under("callings", p["callings"]) if _fits(g, p)]
        for g in persons.every:  # by size, apart from what grew here
            if _fits(g, p):
                near.append(g)
                if len(near) > 1 and (called or g["size"] * 3 <= near[0]["size"]):
                    break
                if len(near) > 2 and near[0]["size"] < 3 * near[1]["size"]:
                    break
        _settle(persons, p, called if len(near) > 1 and called else near)
    return persons.links


def _round(p: DataFrame, neighbours: DataFrame, bare: bool, fresh: list[DataFrame] | None) -> DataFrame:
    """cid, into: the merges of one round, in the blocks of the profiles in `fresh` (cid), or in all."""
    blocks = _blocks(p, neighbours, bare)
    if fresh is not None:
        blocks = cut(blocks)
        touched = blocks.join(reduce(DataFrame.unionByName, fresh).distinct(), "cid").select("type", "block", "part").distinct()
        blocks = blocks.join(touched, ["type", "block", "part"], "left_semi")
    rows = blocks.join(p.drop("type"), "cid").repartition("type", "block", "part").sortWithinPartitions("type", "block", "part", "cid")
    shape, decide = ["cid", "into", "near", "size"], resolve_bare if bare else resolve_names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, members = None, []
        for b in batches:
            out = []
            sets = [b[f].to_list() for f in _SETS]
            for i, (kind, block, part, cid, size, near, lone) in enumerate(zip(b["type"], b["block"], b["part"], b["cid"], b["size"], b["near"], b["lone"], strict=True)):
                key = (kind, block, part)
                if key != at:
                    if len(members) > 1:
                        out += decide(members)
                    at, members = key, []
                members.append({"cid": cid, "type": kind, "size": size, "near": near, "lone": lone, **{f: set(x[i]) for f, x in zip(_SETS, sets, strict=True)}})
            yield pd.DataFrame(out, columns=shape)
        if len(members) > 1:
            yield pd.DataFrame(decide(members), columns=shape)

    links = cut(rows.mapInPandas(run, "cid long, into long, near boolean, size long").filter("cid <> into"))
    sure = links.filter("not near").select("cid", "into")
    best = links.filter("near").groupBy("cid").agg(F.max_by("into", F.struct("size", -F.col("into"))).alias("into"))
    links = sure.unionByName(best.join(sure, "cid", "left_anti"))
    # each profile moves to the smallest it was linked with, in either direction; the next round goes on
    both = links.unionByName(links.select(F.col("into").alias("cid"), F.col("cid").alias("into")))
    return both.groupBy("cid").agg(F.min("into").alias("into")).filter("into < cid")


def resolve(rows: DataFrame) -> DataFrame:
    """name_id, cid: rows of one person or institution share a cid.

    Rounds for names with a forename and for bare surnames take turns until neither merges anything; each round
    with a merge leaves fewer profiles, so they end."""
    own = cut(profiles(rows).withColumn("print", F.md5(F.to_json(F.struct("type", *_SETS)))))
    p = cut(own.filter("size(spellings) > 0").groupBy("print").agg(F.min("name_id").alias("cid"), F.count("*").alias("size"), F.first("type").alias("type"), *(F.first(f).alias(f) for f in _SETS)))
    members = p.select("print", "cid")
    p = p.drop("print")
    neighbours = cut(_neighbours(p))
    fresh: dict[bool, list[DataFrame] | None] = {False: None, True: None}  # profiles changed since the last round of a kind
    bare = False
    while fresh[False] != [] or fresh[True] != []:
        if fresh[bare] == []:
            bare = not bare
        moves = cut(_round(p, neighbours, bare, fresh[bare]))
        fresh[bare] = []
        if not moves.isEmpty():
            # chains within a round are followed once more, so long ones need few rounds
            step = moves.alias("a").join(moves.alias("b"), F.col("a.into") == F.col("b.cid"), "left").select("a.cid", F.coalesce("b.into", "a.into").alias("into"))
            step = cut(step)
            members = cut(members.join(step, "cid", "left").select("print", F.coalesce("into", "cid").alias("cid")))
            union = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(f)))).alias(f) for f in _SETS]
            p = cut(p.join(step, "cid", "left").withColumn("cid", F.coalesce("into", "cid")).groupBy("cid", "type").agg(F.sum("size").alias("size"), *union))
            fresh = {k: None if v is None else [*v, step.select(F.col("into").alias("cid"))] for k, v in fresh.items()}
        bare = not bare
    return own.select("name_id", "print").join(members, "print", "left").select("name_id", F.coalesce("cid", "name_id").alias("cid"))


def pairs(rows: DataFrame) -> DataFrame:
    """name_id_a < name_id_b of rows that name the same person or institution."""
    c = cut(resolve(rows))
    a, b = c.withColumnRenamed("name_id", "name_id_a"), c.withColumnRenamed("name_id", "name_id_b")
    return a.join(b, "cid").filter("name_id_a < name_id_b").select("name_id_a", "name_id_b")
