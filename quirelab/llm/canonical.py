"""Freely entered values mapped to the closest entry of a reference list (problem 1). Built-in SQL only.

Partition-based pigeonhole join: a reference string of length L with tolerance k is cut into k+1 segments;
a value within k edits must hold one of them unchanged, shifted by a bounded amount. Values are probed at
exactly those places by equality join on (kind, length, segment number, substring); candidates are verified
with `levenshtein`. Values without a match are found by anti-join and reported as `none`.

Before that, values are cleaned (markers, struck beginnings, broken lines, case, accents) and spelled in
variants: without leading common nouns, trailing authors and additions, inverted at a comma, with
abbreviated first words written out. Abbreviations (a prefix ending in a full stop, an initial of the genus)
are equality joins on heads of the reference strings, verified by prefix.

Work is done on distinct values; hot values count once. Ties: exact before abbreviated before fewer edits,
normalized_form before text, then the smaller ehd_id.

Defined cases: null, blank and too short values match nothing; a mention sent twice counts once; a mention
with a null id is left out; an empty reference list leaves every value unmatched; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut

# Common nouns and prepositions put before a name, by language, and what follows a name.
LEADING = r"^(?:an|nach|bei|bey|dorf|flecken|stadt|village|town|ville|pueblo|ciudad|hacia|near|cerca|pres|a|in|zu|at|to|de|villa)(?: (?:of|de|del|von|la))? "
TRAILING = r"(?:,? fl\. ?alb\.?| \(planta\)| mill\.?| l\.)$"
ADDITION = r"(?: \([^)]*\)?| var\. .*| am (?:berg|see|bach)| am [bs]\.?)$"
#: First word as abbreviated -> as in the reference list.
ABBREVIATED = {
    "st.": ["saint", "sankt"], "skt.": ["sankt"], "sta.": ["santa"], "ste.": ["sainte"], "s.": ["san", "santa", "saint", "sankt"], "pto.": ["puerto"], "pt.": ["port"],
    "p.": ["puerto", "port"], "v.": ["villa"], "lt.": ["little"], "l.": ["little"], "gt.": ["great"], "gr.": ["great"], "g.": ["great"], "up.": ["upper"], "u.": ["upper"],
    "mt.": ["mont"], "m.": ["mont"], "c.": ["castra"], "cast.": ["castra"],
}
#: Words that tell places of the same name apart.
OPPOSED = r"^(alt|neu|ober|nieder|unter|great|little|upper|lower|san |santa |saint |sankt |port |puerto |villa |mont |castra )"
ACCENTS = ("àáâãåèéêëìíîïòóôõùúûýÿñç", "aaaaaeeeeiiiioooouuuyync")


def fold(c: Column) -> Column:
    """Case, accents and blanks; umlauts as two letters."""
    c = F.lower(F.regexp_replace(c, r"(?U)\s+", " "))
    for one, two in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("ſ", "s")):
        c = F.replace(c, F.lit(one), F.lit(two))
    return F.trim(F.translate(c, *ACCENTS))


def clean(c: Column) -> Column:
    """Without editorial markers, struck text and line breaks; trailing full stops are kept."""
    c = F.regexp_replace(c, r"~~[^~]*~~", " ")
    c = F.regexp_replace(c, r"</?u>|\[\?\]|[\[\]?]", "")
    c = F.regexp_replace(c, r"[-=¬]\s*\n\s*|(?<=\p{L})- (?=\p{Ll})", "")
    c = F.regexp_replace(fold(c), r"[,;: ]+$", "")
    return F.regexp_replace(c, r"['’]s$", "")


def tolerance(length: Column) -> Column:
    """Edits allowed for a reference string of this length."""
    return F.when(length < 4, 0).when(length < 6, 1).when(length < 13, 2).otherwise(3)


def _keys(register: DataFrame) -> DataFrame:
    """kind, k, ehd_id: one row for each spelling of the reference list; a spelling of two entries keeps both."""
    r = register.select(F.col("ehd_id").cast("string").alias("ehd_id"), F.col("kind").cast("string").alias("kind"), F.explode(F.concat(F.array(F.col("label").cast("string")), F.coalesce("alt_labels", F.array().cast("array<string>")))).alias("k"))
    return r.withColumn("k", fold(F.col("k"))).filter("k <> '' and ehd_id is not null and kind is not null").distinct()


def _variants(values: DataFrame) -> DataFrame:
    """kind, raw, s, less (how much was taken away), dot (s is cut off by a full stop)."""
    v = values.select("kind", "raw", clean(F.col("raw")).alias("c"))
    # a value the writer broke off (`Klost...`) is a beginning, like an abbreviation
    v = v.withColumn("c", F.regexp_replace("c", r"\.{2,}$", ".")).filter("c <> ''")
    v = v.withColumn("c", F.regexp_replace("c", TRAILING, ""))
    bare = F.regexp_replace("c", LEADING, "")
    comma = F.regexp_extract(F.col("c"), r"^([^,]+), ?([^,]+)$", 2)
    inverted = F.when(comma != "", F.concat(comma, F.lit(" "), F.regexp_extract(F.col("c"), r"^([^,]+), ?([^,]+)$", 1)))
    v = v.withColumn("base", F.array_compact(F.array("c", F.when(bare != F.col("c"), bare), inverted)))
    v = v.select("kind", "raw", F.posexplode("base").alias("less", "s"))
    first = F.regexp_extract("s", r"^(\S+\.) \S", 1)
    longer = F.create_map(*[x for k, full in ABBREVIATED.items() for x in (F.lit(k), F.array(*map(F.lit, full)))])
    written = F.transform(F.coalesce(F.try_element_at(longer, first), F.array().cast("array<string>")), lambda w: F.concat(w, F.substring(F.col("s"), F.length(first) + 1, F.length("s"))))
    v = v.select("kind", "raw", "less", F.explode(F.concat(F.array("s"), F.when(F.col("kind") == "place", written).otherwise(F.array().cast("array<string>")))).alias("s"))
    without = F.regexp_replace("s", ADDITION, "")
    v = v.select("kind", "raw", F.explode(F.array_compact(F.array(F.struct("less", "s"), F.when(without != F.col("s"), F.struct((F.col("less") + 3).alias("less"), without.alias("s")))))).alias("x")).select("kind", "raw", "x.*")
    return v.withColumn("dot", F.col("s").endswith(".")).withColumn("s", F.trim(F.regexp_replace("s", r"[., ]+$", ""))).filter("length(s) > 2").distinct()


def _exact(v: DataFrame, keys: DataFrame) -> DataFrame:
    hit = v.join(keys, (v.kind == keys.kind) & (v.s == keys.k)).select(v.kind, "raw", "ehd_id", F.col("less").alias("rank"))
    # the genitive and adjective endings of names
    ended = v.withColumn("t", F.regexp_replace("s", "(?:er|s)$", "")).filter("t <> s and length(t) > 4")
    return hit.unionByName(ended.join(keys, (ended.kind == keys.kind) & (ended.t == keys.k)).select(ended.kind, "raw", "ehd_id", (F.col("less") + 6).alias("rank")))


def _abbreviated(v: DataFrame, keys: DataFrame) -> DataFrame:
    heads = keys.filter("length(k) > 4").withColumn("head", F.substring("k", 1, 4))
    cut_off = v.filter("dot and length(s) >= 4").withColumn("head", F.substring("s", 1, 4))
    a = cut_off.join(heads, ["kind", "head"]).filter(F.col("k").startswith(F.col("s")) & (F.length("s") * 5 >= F.length("k") * 2))
    a = a.select("kind", "raw", "ehd_id", (F.col("less") + 20 + F.length("k") - F.length("s")).alias("rank"))
    two = r"^([a-z]+)\.? ([a-z]+)$"
    binomials = keys.filter(F.col("k").rlike(r"^[a-z]+ [a-z]+$") & (F.col("kind") == "plant")).select("kind", "ehd_id", F.split("k", " ")[0].alias("genus"), F.split("k", " ")[1].alias("epithet"))
    binomials = binomials.withColumn("g1", F.substring("genus", 1, 1)).withColumn("e1", F.substring("epithet", 1, 3))
    short = v.filter(F.col("s").rlike(r"^[a-z]+\. ?[a-z]+$") & (F.col("kind") == "plant"))
    short = short.withColumn("g", F.regexp_extract("s", r"^([a-z]+)\. ?([a-z]+)$", 1)).withColumn("e", F.regexp_extract("s", r"^([a-z]+)\. ?([a-z]+)$", 2))
    short = short.withColumn("g1", F.substring("g", 1, 1)).withColumn("e1", F.substring("e", 1, 3))
    b = short.join(binomials, ["kind", "g1", "e1"]).filter(F.col("genus").startswith(F.col("g")))
    miss = F.when(F.col("epithet") == F.col("e"), 0).when(F.col("dot") & F.col("epithet").startswith(F.col("e")), 1).when((F.length("e") > 5) & (F.levenshtein("epithet", "e") <= 2), 1 + F.levenshtein("epithet", "e"))
    return a.unionByName(b.withColumn("miss", miss).filter("miss is not null").select("kind", "raw", "ehd_id", (F.col("less") + 20 + 8 * F.col("miss")).alias("rank")))


def _segments(keys: DataFrame) -> DataFrame:
    """kind, len_k, tol, i, at, seg, k, ehd_id: tol+1 segments of each reference string; the last ones are longer by one."""
    s = keys.withColumn("len_k", F.length("k")).withColumn("tol", tolerance(F.col("len_k"))).filter("len_k > tol")
    s = s.select("*", F.explode(F.sequence(F.lit(0), F.col("tol"))).alias("i"))
    short, long_ = F.expr("len_k div (tol + 1)"), F.expr("len_k % (tol + 1)")
    start = F.col("i") * short + F.greatest(F.lit(0), F.col("i") - (F.col("tol") + 1 - long_)) + 1
    size = short + (F.col("i") >= F.col("tol") + 1 - long_).cast("int")
    return s.withColumn("at", start.cast("int")).withColumn("size", size.cast("int")).withColumn("seg", F.substring(F.col("k"), F.col("at"), F.col("size")))


def _fuzzy(v: DataFrame, keys: DataFrame) -> DataFrame:
    small = keys.count() <= SMALL
    segments = _segments(keys)
    layout = F.broadcast(segments.select("len_k", "tol", "i", "at", "size").distinct())  # at most 4 rows for each length
    if small:
        segments = F.broadcast(segments)  # at most 4 for each spelling
    p = v.filter("length(s) >= 4").select("kind", "s").distinct().withColumn("len_s", F.length("s"))
    p = p.withColumn("len_k", F.explode(F.sequence(F.col("len_s") - 3, F.col("len_s") + 3))).join(layout, "len_k").filter("abs(len_s - len_k) <= tol")
    # a match in segment i leaves i edits before it and tol - i behind it
    low = F.greatest(-F.col("i"), F.col("len_s") - F.col("len_k") - (F.col("tol") - F.col("i")))
    high = F.least(F.col("i"), F.col("len_s") - F.col("len_k") + (F.col("tol") - F.col("i")))
    p = p.withColumn("low", low).withColumn("high", high).filter("low <= high").withColumn("by", F.explode(F.sequence("low", "high")))
    p = p.filter("at + by >= 1 and at + by + size - 1 <= len_s").select("kind", "s", "len_k", "i", F.substring(F.col("s"), F.col("at") + F.col("by"), F.col("size")).alias("seg"))
    c = p.join(segments.select("kind", "len_k", "tol", "i", "seg", "k", "ehd_id"), ["kind", "len_k", "i", "seg"]).select("kind", "s", "k", "tol", "ehd_id").distinct()
    c = c.withColumn("edits", F.levenshtein("s", "k")).filter("edits <= tol")
    letters = lambda x: F.array_sort(F.split(x, ""))
    inserted = F.length("s") - F.length("k") == F.col("edits")
    same = (letters(F.col("s")) == letters(F.col("k"))) | inserted
    kept = (F.col("edits") == 1) | (F.length("k") >= 9) & ((F.col("edits") == 2) | same | (F.length("k") >= 15)) | (F.length("k") >= 6) & same
    apart = (F.regexp_extract("s", OPPOSED, 1) != F.regexp_extract("k", OPPOSED, 1)) & (F.regexp_extract("s", OPPOSED, 1) != "") & (F.regexp_extract("k", OPPOSED, 1) != "")
    c = c.filter(kept & ~apart)
    return c.join(v, ["kind", "s"]).select("kind", "raw", "ehd_id", (F.col("less") + 10 * F.col("edits")).alias("rank"))


#: Spellings of the reference list up to which it is sent to the tasks; longer lists are joined by shuffle.
SMALL = 50_000


def match_values(values: DataFrame, register: DataFrame) -> DataFrame:
    """kind, raw, ehd_id, rank: the closest entry of each value (kind, raw) that has one."""
    keys = cut(_keys(register))
    if keys.count() <= SMALL:
        keys = F.broadcast(keys)
    v = cut(_variants(values.select("kind", "raw").filter("raw is not null").distinct()))
    exact = cut(_exact(v, keys))
    rest = v.join(exact.select("kind", "raw").distinct(), ["kind", "raw"], "left_anti")
    every = exact.unionByName(_abbreviated(rest, keys)).unionByName(_fuzzy(rest, keys))
    best = F.min(F.struct("rank", "ehd_id")).alias("b")
    return every.groupBy("kind", "raw").agg(best).select("kind", "raw", "b.ehd_id", "b.rank")


def map_mentions(mentions: DataFrame, register: DataFrame) -> DataFrame:
    """mention_id, ehd_id (`none` where no entry is meant), matched_on of each Location and Species."""
    kind = F.when(F.col("entity_type") == "Location", "place").when(F.col("entity_type") == "Species", "plant")
    m = mentions.select(F.col("mention_id").cast("long").alias("mention_id"), kind.alias("kind"), F.col("text").cast("string").alias("text"), F.col("normalized_form").cast("string").alias("nf"))
    m = cut(m.filter("kind is not null and mention_id is not null").dropDuplicates(["mention_id"]))
    values = m.select("kind", F.col("text").alias("raw")).unionByName(m.select("kind", F.col("nf").alias("raw")))
    hits = cut(match_values(values, register))
    sides = m.select("mention_id", "kind", F.explode(F.array(F.struct(F.lit("normalized_form").alias("matched_on"), F.col("nf").alias("raw")), F.struct(F.lit("text").alias("matched_on"), F.col("text").alias("raw")))).alias("x")).select("mention_id", "kind", "x.*").filter("raw is not null")
    found = sides.join(hits, ["kind", "raw"]).groupBy("mention_id").agg(F.min(F.struct("rank", "matched_on", "ehd_id")).alias("b")).select("mention_id", "b.ehd_id", "b.matched_on")
    found = cut(found)
    unmatched = m.join(found, "mention_id", "left_anti").select("mention_id", F.lit("none").alias("ehd_id"), F.lit(None).cast("string").alias("matched_on"))
    return found.unionByName(unmatched)
