"""Text functions as built-in column expressions: keys, folio labels, editorial markup, metric normalisation."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F


def _accent_table() -> tuple[str, str]:
    """Precomposed Latin letters and their base letters, from the Unicode decompositions of two blocks."""
    a, b = [], []
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(cp):
            a.append(chr(cp))
            b.append(base)
    return "".join(a), "".join(b)


ACCENTED, BASES = _accent_table()
# Glyphs the metric normaliser folds, and dashes it unifies.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
DASHES = "‐‑‒–—―"


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def norm_key(c: Column, fold_diacritics: bool = True) -> Column:
    """Key of a name: breaks joined, dots dropped, accents and case folded, blanks collapsed; '' for null."""
    c = F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" ")), r"(?U)-\s+", "")
    c = F.replace(c, F.lit("."), F.lit(""))
    if fold_diacritics:
        c = F.translate(F.regexp_replace(c, r"\p{M}", ""), ACCENTED + "ſ", BASES + "s")
        for one, several in LIGATURES.items():
            c = F.replace(c, F.lit(one), F.lit(several))
    return squeeze(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")))


def metric_norm(c: Column) -> Column:
    """Text as the error rates see it: no apparatus, folded glyphs, joined breaks, no punctuation, lower case."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"</?u>|~~|\[[^\]]*\]", " ")
    c = F.translate(c, "ſ" + DASHES, "s" + "-" * len(DASHES))
    for one, several in LIGATURES.items():
        c = F.replace(c, F.lit(one), F.lit(several))
    c = F.regexp_replace(c, "(?U)­|-\\s+", "")
    return squeeze(F.lower(F.regexp_replace(c, r"(?U)[^\p{L}\p{N}_\s]", "")))


def notebook_norm(c: Column) -> Column:
    """The older evaluation's text: struck text deleted, markers dropped, bracket contents kept, punctuation as blanks."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"~~.*?~~", "")
    c = F.regexp_replace(c, r"\[\?\]|\[\.\.\.\]|</?u>", "")
    c = F.regexp_replace(c, r"\[([^\]]*)\]", "$1")
    return squeeze(F.lower(F.regexp_replace(c, r"(?U)[^\p{L}\p{N}_\s]", " ")))


def last_token(c: Column) -> Column:
    """Last word of the key: surname or species epithet."""
    return F.coalesce(F.element_at(F.split(norm_key(c), " "), -1), F.lit(""))


def genus(c: Column) -> Column:
    """First word of the key if there are several, else ''."""
    words = F.split(norm_key(c), " ")
    return F.when(F.size(words) > 1, words[0]).otherwise("")


def norm_folio(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[\[\]\s]+", ""))


def folio_variants(c: Column) -> Column:
    """Lookup keys of a folio label, the most specific first."""
    key = norm_folio(c)
    bare = F.regexp_replace(key, r"^(?:fol\.?|f\.?)\s*", "")
    number = F.regexp_extract(bare, r"^0*(\d+[rv]?)$", 1)
    return F.array_distinct(F.filter(F.array(key, bare, number), lambda v: v != ""))


def folio_label(c: Column) -> Column:
    """Folio label from an image file name: after `__`, else the last number, else the name."""
    marked, plain = F.regexp_extract(c, r"(?i)__(\d+[rv]?)\.\w+$", 1), F.regexp_extract(c, r"(\d+)\.\w+$", 1)
    return F.coalesce(F.nullif(marked, F.lit("")), F.nullif(plain, F.lit("")), c)


def page_sort_key(c: Column) -> Column:
    """Foliation order: 2n - 1 for recto, 2n for verso, 0 without a number."""
    label = folio_label(c)
    n = F.try_to_number(F.nullif(F.regexp_extract(label, r"^(\d+)", 1), F.lit("")), F.lit("999999999")).cast("int")
    return F.coalesce(2 * n - F.when(F.lower(label).contains("v"), 0).otherwise(1), F.lit(0))


def heading_numbers(c: Column) -> Column:
    """Entry numbers of one heading: exactly two numbers are an inclusive range (empty if it descends)."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(\d+)"), 1)
    low, high = found[0].try_cast("long"), found[1].try_cast("long")
    span = F.when(low <= high, F.transform(F.sequence(low, F.greatest(low, high)), lambda n: n.cast("string"))).otherwise(F.array().cast("array<string>"))
    return F.when((F.size(found) == 2) & low.isNotNull() & high.isNotNull(), span).otherwise(found)


def body_number(c: Column) -> Column:
    """Entry number that main text begins with, or null."""
    return F.nullif(F.regexp_extract(F.trim(F.coalesce(c, F.lit(""))), r"^(\d{1,3})\)", 1), F.lit(""))


def entry_numbers(regions: Column) -> Column:
    """Entry numbers of a page from its ordered regions (structs with region_type and content).

    Numbers of headings are kept as they come; those of main text are added if new."""
    start = F.array().cast("array<string>")

    def add(acc: Column, r: Column) -> Column:
        n = body_number(r["content"])
        return F.when(r["region_type"] == "entry_heading", F.concat(acc, heading_numbers(r["content"]))).when((r["region_type"] == "main_text") & n.isNotNull() & ~F.coalesce(F.array_contains(acc, n), F.lit(False)), F.array_append(acc, n)).otherwise(acc)

    return F.aggregate(regions, start, add)


def line_numbers(c: Column) -> Column:
    """Distinct entry marks (`12)` or `12.`) that begin a line."""
    marks = F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), lambda line: F.regexp_extract(line, r"^\s*(\d{1,3}[).])", 1))
    return F.array_distinct(F.filter(marks, lambda m: m != ""))


def uncertain_readings(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?U)(\w*\[\?\])"), 1)


def strip_editorial(c: Column) -> Column:
    """Words without editorial marks."""
    return F.regexp_replace(F.regexp_replace(c, r"</?u>|~~|\[\?\]", ""), r"\[([^\]]*)\]", "$1")


def authority_label(uri: Column) -> Column:
    """Short name of the authority behind a URI."""
    host = F.lower(F.coalesce(F.regexp_extract(uri, r"^[a-z]+://([^/]+)", 1), F.lit("")))
    out = F.lit("Authority")
    for part, name in (("d-nb.info", "GND"), ("wikidata", "Wikidata"), ("geonames", "GeoNames"), ("gbif", "GBIF"), ("viaf", "VIAF")):
        out = F.when(host.contains(part), name).otherwise(out)
    return F.when(uri.isNotNull(), out)


def register_url(ehd_id: Column, base: str) -> Column:
    """URL of a register id of the form H and digits, else null."""
    return F.when(ehd_id.rlike(r"^H\d+$"), F.concat(F.lit(base), ehd_id))


def append_note(existing: Column, fragment: Column) -> Column:
    """`existing | fragment` unless the fragment is blank or already there."""
    has = F.coalesce(F.trim(fragment) != "", F.lit(False))
    return F.when(~has, existing).when(existing.isNull() | (existing == ""), fragment).when(existing.contains(fragment), existing).otherwise(F.concat_ws(" | ", existing, fragment))


def strip(c: Column) -> Column:
    """Without blanks and line breaks at both ends."""
    return F.regexp_replace(c, r"^[\s\x{A0}]+|[\s\x{A0}]+$", "")


def preview(c: Column, width: int = 72) -> Column:
    """The first characters as they are, without blanks around them."""
    return strip(F.substring(c, 1, width))


def wkt_point(c: Column) -> tuple[Column, Column]:
    """(longitude, latitude) of `Point(lon lat)`."""
    p = r"(?i)point\(\s*(-?[\d.]+)\s+(-?[\d.]+)\s*\)"
    return F.regexp_extract(c, p, 1).try_cast("double"), F.regexp_extract(c, p, 2).try_cast("double")


def confidence(c: Column) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(0.0))
