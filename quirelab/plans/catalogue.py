"""All queries of the core over the driver's tables, with the SQL they are held against.

Every query reads its whole tables; records sent twice are counted once (dropDuplicates on the key)."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import kernels
from ..functions.text import append_note, authority_label, folio_label, folio_variants, genus, last_token, line_numbers, metric_norm, norm_key, notebook_norm, page_sort_key, preview, register_url, strip_editorial, uncertain_readings, wkt_point
from ..operators import audit, ensemble, ground_truth, linking, metrics, pages, providers, reports, runs, shred, stages, views
from ..session import spread, table
from ..sources import tei

KEYS = {"mentions": "mention_id", "regions": "region_id", "pages": "page_id", "person_names": "name_id", "page_records": "record_id"}
EMPTY = "cast([] as varchar[])"


def once(spark, d, name, *columns, where=None):
    """Rows of a table, each record once, with only the columns asked for.

    Records sent again are equal, so `where` is applied before repeats are removed and reaches the scan."""
    t = table(spark, d, name)
    if where is not None:
        t = t.filter(where)
    return (t.select(*columns) if columns else t.drop("received_at")).dropDuplicates([KEYS[name]])


def _sql_once(name):
    return f"(select distinct on ({KEYS[name]}) * from {name})"


M, R, P, N = (_sql_once(n) for n in ("mentions", "regions", "pages", "person_names"))


def _nk(x):
    return f"trim(regexp_replace(replace(lower(strip_accents(replace(regexp_replace(replace(coalesce({x},''),chr(10),' '),'-\\s+','','g'),'.',''))),'ß','ss'),'\\s+',' ','g'))"


def _metric(x):
    y = f"regexp_replace(coalesce({x},''),'</?u>|~~|\\[[^\\]]*\\]',' ','g')"
    y = f"translate({y},'ſ‐‑‒–—―','s------')"
    for a, b in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl")):
        y = f"replace({y},'{a}','{b}')"
    y = f"regexp_replace({y},chr(173)||'|-\\s+','','g')"
    return f"trim(regexp_replace(lower(regexp_replace({y},'[^\\p{{L}}\\p{{N}}_\\s]','','g')),'\\s+',' ','g'))"


# -- linking ---------------------------------------------------------------------------------------------------


def _mentions(s, d):
    return once(s, d, "mentions", "mention_id", "page_id", "journal_id", "text", "entity_type", "context", "normalized_form", "lang", "start_char", "end_char")


def _register(s, d):
    return table(s, d, "register")


def _linked(s, d):
    m = _mentions(s, d)
    return audit.linked_mentions(m, linking.link_exact(m, _register(s, d)), once(s, d, "pages", "page_id", "page_number"))


_KEYS_SQL = f"""rk as (select kind, k, list_sort(list(distinct ehd_id)) ids from (select kind, ehd_id, {_nk('name')} k from (select kind, ehd_id, unnest(list_concat([label], coalesce(alt_labels, {EMPTY}))) as name from register)) where k <> '' group by 1, 2)"""
_LINK_SQL = f"""{_KEYS_SQL},
m as (select mention_id, page_id, entity_type, case entity_type when 'Location' then 'place' when 'Species' then 'plant' when 'Person' then 'person' end kind, text, normalized_form, {_nk('text')} kt, {_nk('normalized_form')} kn from {M}),
l as (select m.*, case when a.ids is not null then a.ids else b.ids end ids, case when a.ids is not null then 'normalized_form' when b.ids is not null then 'exact' end as method, case when a.ids is not null then kn when b.ids is not null then kt end as matched_on
  from m left join rk a on a.kind = m.kind and a.k = m.kn and m.kn <> '' left join rk b on b.kind = m.kind and b.k = m.kt and m.kt <> '' where m.kind is not null),
x as (select l.mention_id, l.entity_type, l.text, l.normalized_form, l.ids[1] as ehd_id, l.method as link_method, case when ids is not null then 1.0 end as link_score, coalesce(len(ids) > 1, false) as link_ambiguous, p.page_number as page, kt as norm_text
  from l left join {P} p using (page_id))"""


def link_coverage(s, d):
    return audit.coverage(_linked(s, d))


def link_methods(s, d):
    m = _mentions(s, d)
    return linking.link_exact(m, _register(s, d)).groupBy("method").agg(F.count("*").alias("n"), F.count_if("ambiguous").alias("ambiguous"))


def link_exact(s, d):
    return linking.link_exact(_mentions(s, d), _register(s, d)).select("mention_id", "ehd_id", "method", "matched_on")


def link_fuzzy(s, d):
    return linking.link_fuzzy(_mentions(s, d), _register(s, d))


def surname_links(s, d):
    return linking.link_surnames(once(s, d, "person_names"))


def register_index(s, d):
    return linking.register_keys(_register(s, d)).select("kind", "k", F.array_join("ids", ",").alias("ids"), "n")


# -- audit: scores vary so that weak links exist -------------------------------------------------------------------


def _scored(s, d):
    """Linked mentions whose score depends on the method, so that some links are weak."""
    x = _linked(s, d)
    return x.withColumn("link_score", F.when(F.col("link_method") == "exact", 0.7).otherwise(F.col("link_score")))


_SCORED_SQL = f"{_LINK_SQL}, y as (select * replace (case when link_method = 'exact' then 0.7 else link_score end as link_score) from x)"


def normalization_conflicts(s, d):
    return audit.normalization_conflicts(_linked(s, d)).select("entity_type", "norm_text", "surface_form", F.array_join("normalized_forms", "|").alias("forms"), F.array_join(F.col("pages").cast("array<string>"), ",").alias("pages"))


def link_conflicts(s, d):
    """Standard forms cut down to their last word, so that one form can have several entries."""
    last = F.element_at(F.split(F.trim(F.coalesce(F.nullif(F.trim("normalized_form"), F.lit("")), "text")), " "), -1)
    return audit.link_conflicts(_linked(s, d).withColumn("normalized_form", last)).select("entity_type", "form", F.array_join("linked_ids", ",").alias("ids"))


def ambiguous_links(s, d):
    return audit.ambiguous_links(_scored(s, d)).select("entity_type", "norm_text", "ehd_id", "surface_form", "link_method", F.array_join(F.col("pages").cast("array<string>"), ",").alias("pages"))


def variant_merges(s, d):
    return audit.variant_merges(_linked(s, d)).select("entity_type", "ehd_id", F.array_join("surface_forms", "|").alias("forms"))


def species_conflicts(s, d):
    return audit.species_conflicts(_linked(s, d)).select("entity_type", "epithet", F.array_join("normalized_forms", "|").alias("forms"))


def issue_rollup(s, d):
    return audit.rollup(audit.issues(_scored(s, d)))


_TRIMMED = "nullif(trim(normalized_form), '')"
_NC = f"select entity_type, norm_text, arg_min(text, mention_id) surface_form, list_sort(list(distinct {_TRIMMED}) filter ({_TRIMMED} is not null)) f, list_sort(list(distinct page) filter (page is not null)) pg from y where norm_text <> '' group by 1, 2 having count(distinct {_TRIMMED}) > 1"
_LC = f"select entity_type, {_nk('coalesce(nullif(normalized_form, chr(0)[2:]), text)')} form, list_sort(list(distinct ehd_id)) f from y where ehd_id is not null group by 1, 2 having count(distinct ehd_id) > 1 and form <> ''"
_LC = _LC.replace("chr(0)[2:]", "''")
_AL = "select a.entity_type, a.norm_text, a.ehd_id, a.surface_form, a.link_method, b.pg from (select entity_type, norm_text, ehd_id, arg_min(text, mention_id) surface_form, arg_min(link_method, mention_id) link_method from y where ehd_id is not null and (link_ambiguous or link_score < 0.75) group by 1, 2, 3) a join (select entity_type, norm_text, list_sort(list(distinct page) filter (page is not null)) pg from y group by 1, 2) b using (entity_type, norm_text)"
_VM = "select entity_type, ehd_id, list_sort(list(distinct s)) f from (select entity_type, ehd_id, nullif(trim(replace(text, chr(10), ' ')), '') s from y where ehd_id is not null) where s is not null group by 1, 2 having count(distinct s) > 1"
_SC = f"""select entity_type, epithet, f from (select entity_type, epithet, list_sort(list(distinct {_TRIMMED}) filter ({_TRIMMED} is not null)) f, list(distinct genus) filter (genus is not null) g, arg_max(genus, (len(genus), genus)) filter (genus is not null) longest
  from (select *, str_split(norm_text, ' ')[-1] epithet, case when contains(norm_text, ' ') then str_split(norm_text, ' ')[1] end genus from y where entity_type = 'Species' and norm_text <> '') group by 1, 2) where len(f) > 1 and (longest is null or len(list_filter(g, lambda z: not starts_with(longest, z))) = 0)"""


def _pages_text(c):
    return f"array_to_string({c}, ',')"


# -- text and pages ------------------------------------------------------------------------------------------------


def name_keys(s, d):
    return _mentions(s, d).select("mention_id", norm_key(F.col("text")).alias("k"), last_token(F.col("text")).alias("epithet"), genus(F.col("text")).alias("genus"))


def metric_text(s, d):
    return once(s, d, "regions", "region_id", "content").select("region_id", metric_norm(F.col("content")).alias("t"))


def legacy_text(s, d):
    return once(s, d, "regions", "region_id", "content").select("region_id", notebook_norm(F.col("content")).alias("t"))


def plain_text(s, d):
    return once(s, d, "regions", "region_id", "content").select("region_id", strip_editorial(F.col("content")).alias("t"), F.size(uncertain_readings(F.col("content"))).alias("uncertain"), F.array_join(line_numbers(F.col("content")), ",").alias("marks"))


def folio_keys(s, d):
    p = once(s, d, "pages", "page_id", "image_filename", "folio_label")
    return p.select("page_id", folio_label(F.col("image_filename")).alias("label"), page_sort_key(F.col("image_filename")).alias("sort_key"), F.array_join(folio_variants(F.col("folio_label")), ",").alias("variants"))


def _regions(s, d, where=None):
    return once(s, d, "regions", where=where)


READ = "size(ensemble_readings) > 0"
BOXED = "size(bbox) = 4"
WITH_TRUTH = "trim(ground_truth_content) <> ''"


def page_text(s, d):
    return pages.full_text(_regions(s, d))


def region_languages(s, d):
    return pages.page_languages(_regions(s, d)).select("page_id", F.array_join("languages", ",").alias("languages"))


def entry_numbers(s, d):
    return pages.page_entries(_regions(s, d)).select("page_id", F.array_join("entry_numbers", ",").alias("numbers"))


def table_text(s, d):
    return pages.table_text(_regions(s, d, "table_data is not null"))


def reading_order(s, d):
    return pages.reading_order(_regions(s, d))


def rectangles(s, d):
    return pages.rectangles(_regions(s, d, BOXED))


def crop_boxes(s, d):
    return pages.crops(_regions(s, d, BOXED), 2950, 4130)


def mask_boxes(s, d):
    return pages.other_boxes(_regions(s, d, BOXED)).groupBy("region_id").agg(F.count("*").alias("others"))


def contents(s, d):
    return pages.contents(_regions(s, d))


def page_copy(s, d):
    return pages.copy_text(_regions(s, d))


def gt_lookup(s, d):
    p = once(s, d, "pages", "page_id", "journal_id", "folio_label")
    truth = p.join(table(s, d, "regions").filter(WITH_TRUTH).select("page_id").distinct(), "page_id")
    return pages.gt_lookup(p, truth)


def gt_coverage(s, d):
    return pages.gt_coverage(once(s, d, "pages", "page_id", "journal_id"), _regions(s, d).select("page_id", "ground_truth_content"))


def unprocessed_pages(s, d):
    return pages.unprocessed(once(s, d, "pages", "page_id", "journal_id"), table(s, d, "regions"))


def carried_folios(s, d):
    p = once(s, d, "pages", "page_id", "journal_id", "page_number", "folio_label")
    return pages.carry(p, ["journal_id"], ["page_number", "page_id"], "folio_label", "folio").select("page_id", "folio")


def type_runs(s, d):
    r = _regions(s, d).select("page_id", "region_index", "region_id", "region_type")
    return pages.islands(r, ["page_id"], ["region_index", "region_id"], "region_type")


# -- ensemble, ground truth, metrics --------------------------------------------------------------------------------


def majority_reading(s, d):
    return ensemble.majority(_regions(s, d, READ))


def reading_votes(s, d):
    return ensemble.annotations(_regions(s, d, READ))


def merged_readings(s, d):
    return ensemble.merge(spread(_regions(s, d, READ)))


def oracle_readings(s, d):
    return ensemble.oracle(_regions(s, d, f"{READ} and {WITH_TRUTH}"))


def label_union(s, d):
    return ensemble.languages_union(_regions(s, d)).select("region_id", F.array_join("languages", ",").alias("languages"))


def aligned_truth(s, d):
    return ground_truth.align(_regions(s, d), ground_truth.truth_blocks(_regions(s, d, WITH_TRUTH)))


def filled_truth(s, d):
    r = _regions(s, d)
    return ground_truth.fill(r, ground_truth.align(r, ground_truth.truth_blocks(_regions(s, d, WITH_TRUTH))))


def truth_entities(s, d):
    """The text of a region stands for its ground truth where it has none, so that there is something to find."""
    r = _regions(s, d, "content is not null").withColumn("ground_truth_content", F.coalesce(F.nullif(F.trim("ground_truth_content"), F.lit("")), "content"))
    return ground_truth.attach_entities(r, once(s, d, "mentions", "mention_id", "page_id", "text"))


def canonical_truth(s, d):
    return ground_truth.canonical_text(_regions(s, d, WITH_TRUTH))


def snapped_truth(s, d):
    """Readings of regions with ground truth on the page, cut verbatim from the page's truth."""
    r = _regions(s, d, "trim(content) <> ''")
    c = ground_truth.canonical_text(_regions(s, d, WITH_TRUTH))
    return r.select("page_id", "region_id", "content").join(c, "page_id").select("region_id", kernels.u_snap("content", "canonical").alias("snapped"))


def truth_diff(s, d):
    r = metrics.scorable(_regions(s, d, WITH_TRUTH))
    return r.select("region_id", F.explode(kernels.u_diff("content", "ground_truth_content")).alias("x")).groupBy("region_id", "x.op").agg(F.count("*").alias("n"))


def entity_spans(s, d):
    m = _mentions(s, d).groupBy("page_id").agg(F.collect_set("text").alias("names"))
    r = once(s, d, "regions", "page_id", "region_id", "content", where="content is not null")
    return r.join(m, "page_id").select("region_id", F.explode(kernels.u_spans("content", "names")).alias("x")).select("region_id", "x.*")


def error_rates(s, d):
    return metrics.page_scores(_regions(s, d, WITH_TRUTH)).withColumn("cer", F.round("cer", 6)).withColumn("wer", F.round("wer", 6))


def book_error_rates(s, d):
    p = metrics.page_scores(_regions(s, d, WITH_TRUTH)).join(once(s, d, "pages", "page_id", "journal_id"), "page_id")
    return metrics.book_scores(p, "journal_id").withColumn("cer", F.round("cer", 6)).withColumn("wer", F.round("wer", 6))


def run_error_rates(s, d):
    p = metrics.page_scores(_regions(s, d, WITH_TRUTH)).join(once(s, d, "pages", "page_id", "run_id"), "page_id")
    return metrics.spread_over_runs(metrics.book_scores(p, "run_id"), "cer")


def run_spread(s, d):
    r = _regions(s, d, "ground_truth_confidence is not null")
    return metrics.spread_over_runs(r.groupBy("run_id", "region_type").agg(F.avg("ground_truth_confidence").alias("v")), "v", "region_type")


def confidence_quartiles(s, d):
    return metrics.quartiles(_regions(s, d, "ground_truth_confidence is not null"), "ground_truth_confidence", "region_type")


def entity_scores(s, d):
    m = _mentions(s, d)
    ours = m.select("journal_id", norm_key(F.col("text")).alias("name"), "entity_type").filter("name <> ''")
    theirs = m.select("journal_id", norm_key(F.col("normalized_form")).alias("name"), "entity_type").filter("name <> ''")
    return metrics.precision_recall(ours, theirs, "journal_id")


def margin_recall(s, d):
    """The text before the layout pass against the text after it."""
    r = once(s, d, "regions", "region_id", "page_id", "region_type", "content", "content_pre_consistency")
    return metrics.margin_recall(r.select("page_id", "region_type", F.col("content_pre_consistency").alias("content")), r.select("page_id", "region_type", "content"))


# -- stages --------------------------------------------------------------------------------------------------------


def layout_duplicates(s, d):
    r = _regions(s, d)
    return stages.apply_layout(r, stages.duplicate_decisions(r)).select("region_id", "region_type", "content", "editorial_note", "issue", "severity", F.coalesce(F.size("uncertain_readings"), F.lit(0)).alias("uncertain"))


def _positions():
    """Position texts and given positions by region_id, so that missing, invalid and contradicting ones occur."""
    pick = lambda values: F.get(F.array(*map(F.lit, values)), (F.col("region_id") % len(values)).cast("int"))
    said = pick(("Left margin", "top left", "upper edge, at the TOP", "bottom", "bleed-through", "opposite page", "interlinear", ""))
    given = F.when(F.col("region_id") % 3 == 0, pick(("top", "mTop", "inline", "Left", "opposite", " ", ""))).when(F.col("region_id") % 3 == 1, F.col("marginal_position"))
    return said.alias("position"), given.alias("marginal_position")


def detections(s, d):
    """Detections with the kinds of positions that models answer."""
    r = _regions(s, d).select("page_id", F.col("region_index").alias("i"), "region_id", "region_type", F.col("content").isNotNull().alias("has_text"), *_positions(), "bbox")
    raw = r.withColumn("ord", F.struct("i", "region_id"))
    return stages.clean_detections(raw).select("page_id", "region_index", "region_type", "has_text", "marginal_position")


def valid_entities(s, d):
    return stages.valid_entities(_mentions(s, d).withColumn("ord", F.col("mention_id"))).select("mention_id")


def _gazetteer(s, d):
    """A gazetteer made of the register's places, with coordinates from their ids."""
    n = F.regexp_extract("ehd_id", r"(\d+)$", 1).cast("int")
    return _register(s, d).filter("kind = 'place'").select(F.trim("label").alias("name"), (n % 180 - 90).cast("double").alias("lat"), (n % 360 - 180).cast("double").alias("lon"), F.lit("register").alias("source"))


def names_to_resolve(s, d):
    return stages.names_to_resolve(_mentions(s, d), _gazetteer(s, d)).select("name")


def resolved_places(s, d):
    names = stages.names_to_resolve(_mentions(s, d), _gazetteer(s, d).limit(0))
    return stages.resolve_places(names, _gazetteer(s, d))


def place_centroid(s, d):
    return stages.centroid(resolved_places(s, d))


def json_answers(s, d):
    return once(s, d, "page_records", "record_id", "payload").select("record_id", F.size(stages.list_answer(F.col("payload"))).alias("items"))


def repaired_json(s, d):
    """What parses is taken as it is by built-ins; only the rest goes to Python."""
    r = once(s, d, "page_records", "record_id", "payload").withColumn("ok", F.try_parse_json("payload"))
    good = r.filter("ok is not null").select("record_id", F.to_json("ok").alias("json"))
    return good.unionByName(r.filter("ok is null").select("record_id", kernels.u_repair_json("payload").alias("json")))


def event_props(s, d):
    return table(s, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k"))


# -- reports and documents ---------------------------------------------------------------------------------------------


def entity_frequency(s, d):
    return reports.entity_frequency(_mentions(s, d))


def entities_by_page(s, d):
    return reports.entities_by_page(_mentions(s, d))


def totals(s, d):
    return reports.totals(once(s, d, "pages", "page_id"), once(s, d, "regions", "region_id"), _mentions(s, d))


def region_types(s, d):
    return reports.region_types(_regions(s, d))


def register_counts(s, d):
    return reports.register_counts(_register(s, d))


def word_search(s, d):
    return reports.search(_regions(s, d, "lower(content) like '%barometer%'"), "Barometer")


def authorities(s, d):
    r = _register(s, d)
    return r.select("ehd_id", register_url(F.col("ehd_id"), "https://register.example/").alias("url"), authority_label(F.concat(F.lit("https://www.wikidata.org/"), "ehd_id")).alias("authority"), append_note(F.col("note"), F.lit("checked")).alias("note"), wkt_point(F.concat(F.lit("Point("), F.regexp_extract("ehd_id", r"(\d+)$", 1), F.lit(" 1.5)")))[0].alias("lon"))


def tei_fragments(s, d):
    p = once(s, d, "pages", "page_id", "page_number", "folio_label", "image_filename")
    return tei.write(spread(tei.page_structs(p, _regions(s, d), _mentions(s, d))))


def tei_round_trip(s, d):
    """Regions that come back from written pages, by type."""
    x = tei_fragments(s, d).select("page_id", F.concat(F.lit("<body>"), "fragment", F.lit("</body>")).alias("xml"))
    return tei.read(x).select(F.explode("regions").alias("r")).groupBy("r.region_type").agg(F.count("*").alias("n"))


# -- runs, providers, views ------------------------------------------------------------------------------------------------


def page_slice(s, d):
    """The pages of a journal without the first two and the last three."""
    p = once(s, d, "pages", "page_id", "journal_id", "page_number")
    return runs.slice_sorted(p, ["journal_id"], ["page_number", "page_id"], 2, -3).select("journal_id", "page_id")


def run_union(s, d):
    """Pages of two runs one after the other, the second without folio labels."""
    p = once(s, d, "pages", "page_id", "run_id", "folio_label")
    return runs.union_runs(p.filter("page_id % 2 = 0"), p.filter("page_id % 2 = 1").drop("folio_label")).groupBy("run_id").agg(F.count("*").alias("pages"), F.count("folio_label").alias("labelled"))


def run_scores(s, d):
    r = _regions(s, d)
    out = runs.score_run(r, ground_truth.canonical_text(_regions(s, d, WITH_TRUTH)), once(s, d, "pages", "page_id", "run_id"))
    return out.select("run_id", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


def legacy_cer(s, d):
    """The stored page text against the text put together from its regions, by the older evaluation."""
    return runs.macro_cer(once(s, d, "pages", "page_id", "full_text"), pages.full_text(_regions(s, d))).select("pages", F.round("cer", 6).alias("cer"))


def variant_scores(s, d):
    """Merge variants against ground truth: the text as it is, and the first reading."""
    first = lambda r: F.coalesce(F.get(F.filter("ensemble_readings", lambda x: F.trim(x) != ""), 0), F.col("content"))
    return runs.variant_scores(_regions(s, d, WITH_TRUTH), {"content": lambda r: F.col("content"), "first": first}).select("variant", F.round("cer", 6).alias("cer"), F.round("wer", 6).alias("wer"))


def swapped_content(s, d):
    """Regions with the majority of their readings in place of their content."""
    r = _regions(s, d)
    merged = ensemble.majority(r.filter(READ)).join(r.select("region_id", "page_id", "region_index"), "region_id").select("page_id", "region_index", F.col("reading").alias("text"))
    return runs.swap_content(r, merged).select("region_id", "content")


def slip_counts(s, d):
    """Pasted slips of each page with text, against those with a text before the layout pass."""
    r = once(s, d, "regions", "region_id", "page_id", "region_type", "content", "content_pre_consistency")
    return runs.slips(r.filter("content <> ''"), r.filter("content_pre_consistency <> ''"))


def link_and_check(s, d):
    """Counts of issues after all stages of linking, persons by surname included."""
    n = once(s, d, "person_names", "name_id", "page_id", "entity_type", "origin", "text", "normalized_form", "surname")
    return audit.rollup(runs.link_and_check(_mentions(s, d), n, _register(s, d), once(s, d, "pages", "page_id", "page_number"))[1])


def unmatched_folios(s, d):
    """Pages whose folio no page with ground truth has."""
    return once(s, d, "pages", "page_id", "folio_label").join(gt_lookup(s, d), "page_id", "left_anti")


def retryable_texts(s, d):
    """Texts that would count as messages of passing failures, with the tries they would be given."""
    t = table(s, d, "documents").select("doc_id", "text")
    return t.select("doc_id", providers.is_retryable(F.col("text")).alias("passing"), providers.attempts_left(F.lit(3), F.col("text")).alias("again"))


def recorded_answers(s, d):
    """Payloads as recorded answers to the pages of the same number; what does not parse is answered by the default."""
    asked = once(s, d, "pages", "page_id").select(F.col("page_id").alias("request"))
    said = table(s, d, "page_records").select(F.col("record_id").alias("request"), F.col("received_at").alias("ord"), F.col("payload").alias("reply"))
    return providers.answered(asked, said).select("request", "ok", F.when(F.col("ok"), F.md5(F.col("answer").cast("binary"))).otherwise(F.col("answer")).alias("answer"))


def prompt_rows(s, d):
    """How many rows each page shows a model, and how long they are."""
    r = once(s, d, "regions", "page_id", "region_id", "region_index", "region_type")
    return providers.prompt_rows(r, "region_index", "region_type").select("page_id", F.length("rows").alias("chars"))


def reconstructed_regions(s, d):
    r = _regions(s, d).withColumn("i", F.row_number().over(W.partitionBy("page_id").orderBy("region_index", "region_id")))
    found = r.select("page_id", F.col("i").alias("region_index"), "region_type", (F.col("region_id") % 5 != 0).alias("has_text"), F.when(F.col("region_id") % 7 == 0, "opposite").otherwise(F.col("marginal_position")).alias("marginal_position"), "bbox")
    read = r.filter("region_id % 3 <> 0").select("page_id", F.col("i").alias("region_index"), "content", "languages", F.when(F.col("region_id") % 2 == 0, F.col("is_visual")).alias("is_visual"), "editorial_note")
    x = providers.reconstruct(found, read)
    return x.select("page_id", "region_index", "content", "is_visual", "editorial_note", F.array_join("languages", ",").alias("languages"), F.size("uncertain_readings").alias("uncertain"))


def legend(s, d):
    return views.legend(once(s, d, "regions", "region_id", "journal_id", "region_type")).select("journal_id", F.array_join("types", ",").alias("types"))


def register_labels(s, d):
    """Labels of the entries links point to, every third id made unknown."""
    ids = linking.link_exact(_mentions(s, d), _register(s, d)).select("mention_id", F.when(F.col("mention_id") % 3 == 0, F.concat(F.lit("X"), "ehd_id")).otherwise(F.col("ehd_id")).alias("ehd_id"))
    return views.with_labels(ids, _register(s, d)).select("mention_id", "label")


def pages_with_image(s, d):
    """Pages whose image is listed; the listing is that of every second page."""
    p = once(s, d, "pages", "page_id", "image_filename")
    return views.with_image(p, table(s, d, "pages").filter("page_id % 2 = 0").select(F.col("image_filename").alias("name"))).select("page_id")


def panels(s, d):
    p = views.panels(once(s, d, "pages", "page_id", "folio_label"), _regions(s, d))
    return p.select("page_id", "folio_label", "heading", F.length("text").alias("chars"), F.coalesce(F.size("boxes"), F.lit(0)).alias("boxes"))


def p2_found(spark, d):
    return shred.found(spread(table(spark, d, "page_records").select("record_id", "payload")))


def _p2(child):
    def query(spark, d):
        return shred.flat(spread(table(spark, d, "page_records").select("record_id", "payload")), child)

    return query


_NAMES = """link_coverage link_methods link_exact link_fuzzy surname_links register_index normalization_conflicts link_conflicts ambiguous_links variant_merges species_conflicts issue_rollup
name_keys metric_text legacy_text plain_text folio_keys page_text region_languages entry_numbers table_text reading_order rectangles crop_boxes mask_boxes contents page_copy gt_lookup gt_coverage
unprocessed_pages carried_folios type_runs majority_reading reading_votes merged_readings oracle_readings label_union aligned_truth filled_truth truth_entities canonical_truth snapped_truth truth_diff
entity_spans error_rates book_error_rates run_error_rates run_spread confidence_quartiles entity_scores margin_recall layout_duplicates detections valid_entities names_to_resolve resolved_places
place_centroid json_answers repaired_json event_props entity_frequency entities_by_page totals region_types register_counts word_search authorities tei_fragments tei_round_trip
page_slice run_union run_scores legacy_cer variant_scores swapped_content slip_counts link_and_check unmatched_folios retryable_texts recorded_answers prompt_rows reconstructed_regions legend register_labels
pages_with_image panels""".split()


def queries():
    own = {n: globals()[n] for n in _NAMES} | {"p2_found": p2_found}
    own |= {f"p2_{name}": _p2(child) for name, child in (("pages", "page"), ("regions", "region"), ("entities", "entity"), ("locations", "location"), ("cells", "table_cell"), ("gt_entities", "gt_entity"), ("entry_numbers", "entry_number"), ("page_languages", "page_language"), ("region_languages", "region_language"), ("bboxes", "bbox"), ("uncertain_readings", "uncertain_reading"), ("ensemble_readings", "ensemble_reading"))}
    return own


_TEXT = "coalesce(content, '')"
_PLACE_NAME = "coalesce(nullif(trim(normalized_form), ''), trim(text))"
_GAZ = "(select trim(label) as name, any_value(cast(cast(regexp_extract(ehd_id, '(\\d+)$', 1) as int) % 180 - 90 as double)) lat, any_value(cast(cast(regexp_extract(ehd_id, '(\\d+)$', 1) as int) % 360 - 180 as double)) lon from register where kind = 'place' group by 1)"
_VOTES = f"v as (select region_id, trim(x) as reading, count(*) n, min(i) first from (select region_id, unnest(ensemble_readings) x, generate_subscripts(ensemble_readings, 1) i from {R}) where trim(x) <> '' group by 1, 2)"
_PARTS = f"""select page_id, region_index, region_id, case when region_type = 'observation_table' and table_data is not null then list_filter(coalesce(flatten(table_data.cells), {EMPTY}), lambda c: trim(c) <> '') else list_filter([{_TEXT}], lambda c: trim(c) <> '') end parts from {R} where not coalesce(is_visual, false)"""
_FOLIO = "lower(regexp_replace(coalesce(folio_label, ''), '[\\[\\]\\s]+', '', 'g'))"
_BARE = f"regexp_replace({_FOLIO}, '^(?:fol\\.?|f\\.?)\\s*', '')"
_NUMBER = f"regexp_extract({_BARE}, '^0*(\\d+[rv]?)$', 1)"
_TRUTH = "trim(ground_truth_content) <> ''"


#: Entry numbers of a page in reading order: numbers of headings, and the marks that begin main text.
_ENTRY_SQL = """l as (select page_id, o, region_type = 'entry_heading' head, case when region_type <> 'entry_heading' then list_filter([nullif(regexp_extract(trim(coalesce(content, '')), '^(\\d{1,3})\\)', 1), '')], lambda z: z is not null)
    when len(f) = 2 and try_cast(f[1] as bigint) is not null and try_cast(f[2] as bigint) is not null then list_transform(range(try_cast(f[1] as bigint), try_cast(f[2] as bigint) + 1), lambda z: z::varchar) else f end l from (select *, regexp_extract_all(coalesce(content, ''), '(\\d+)') f from r)),
  n as (select page_id, o, head, unnest(l) num, generate_subscripts(l, 1) k from l),
  x as (select page_id, string_agg(num, ',' order by o, k) numbers from n a where head or not exists (select 1 from n b where b.page_id = a.page_id and b.o < a.o and b.num = a.num) group by 1)"""


def _strip(x):
    return f"regexp_replace({x}, '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g')"


def _legacy(c):
    return f"trim(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce({c}, ''),'~~.*?~~','','g'),'\\[\\?\\]|\\[\\.\\.\\.\\]|</?u>','','g'),'\\[([^\\]]*)\\]','\\1','g'),'[^\\p{{L}}\\p{{N}}_\\s]',' ','g')),'\\s+',' ','g'))"


def oracle_sql():
    y = f"with {_SCORED_SQL} "
    return {
        "link_coverage": f"with {_LINK_SQL} select entity_type, count(ehd_id) linked, count(*) total, round_even(100.0 * count(ehd_id) / count(*), 1) pct from x group by 1",
        "link_methods": f"with {_LINK_SQL} select link_method as method, count(*) n, count_if(link_ambiguous) ambiguous from x where ehd_id is not null group by 1",
        "link_exact": f"with {_LINK_SQL} select mention_id, ids[1] ehd_id, method, matched_on from l where ids is not null",
        "register_index": f"with {_KEYS_SQL} select kind, k, array_to_string(ids, ',') ids, len(ids)::int n from rk",
        "normalization_conflicts": y + f"select entity_type, norm_text, surface_form, array_to_string(f, '|') forms, {_pages_text('pg')} pages from ({_NC})",
        "link_conflicts": f"with {_LINK_SQL}, y as (select * replace (str_split(trim(coalesce(nullif(trim(normalized_form), ''), text)), ' ')[-1] as normalized_form) from x) select entity_type, form, array_to_string(f, ',') ids from ({_LC})",
        "ambiguous_links": y + f"select entity_type, norm_text, ehd_id, surface_form, link_method, {_pages_text('pg')} pages from ({_AL})",
        "variant_merges": y + f"select entity_type, ehd_id, array_to_string(f, '|') forms from ({_VM})",
        "species_conflicts": y + f"select entity_type, epithet, array_to_string(f, '|') forms from ({_SC})",
        "issue_rollup": y + f", i as (select 'normalization_conflict' issue_type, 'warning' severity from ({_NC}) union all select 'link_conflict', 'warning' from ({_LC}) union all select 'ambiguous_link', 'info' from ({_AL}) union all select 'variant_merge', 'info' from ({_VM}) union all select 'species_name_conflict', 'warning' from ({_SC})) select severity, issue_type, count(*) n from i group by grouping sets ((severity), (issue_type), ())",
        "name_keys": f"select mention_id, k, case when k = '' then '' else str_split(k, ' ')[-1] end epithet, case when contains(k, ' ') then str_split(k, ' ')[1] else '' end genus from (select mention_id, {_nk('text')} k from {M})",
        "metric_text": f"select region_id, {_metric('content')} t from {R}",
        "legacy_text": f"select region_id, trim(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace({_TEXT},'~~.*?~~','','g'),'\\[\\?\\]|\\[\\.\\.\\.\\]|</?u>','','g'),'\\[([^\\]]*)\\]','\\1','g'),'[^\\p{{L}}\\p{{N}}_\\s]',' ','g')),'\\s+',' ','g')) t from {R}",
        "plain_text": f"select region_id, regexp_replace(regexp_replace(content,'</?u>|~~|\\[\\?\\]','','g'),'\\[([^\\]]*)\\]','\\1','g') t, len(regexp_extract_all({_TEXT},'[\\p{{L}}\\p{{N}}_]*\\[\\?\\]'))::int uncertain, (select coalesce(string_agg(m, ',' order by f), '') from (select m, min(i) f from (select regexp_extract(unnest(str_split({_TEXT}, chr(10))), '^\\s*(\\d{{1,3}}[).])', 1) m, generate_subscripts(str_split({_TEXT}, chr(10)), 1) i) where m <> '' group by m)) marks from {R}",
        "folio_keys": f"""select page_id, label, coalesce(2 * try_cast(nullif(regexp_extract(label, '^(\\d+)', 1), '') as int) - case when contains(lower(label), 'v') then 0 else 1 end, 0) sort_key, array_to_string(list_filter([a, case when b <> a then b end, case when c <> a and c <> b then c end], lambda z: z is not null and z <> ''), ',') variants
          from (select page_id, coalesce(nullif(regexp_extract(image_filename, '__(\\d+[rvRV]?)\\.\\w+$', 1), ''), nullif(regexp_extract(image_filename, '(\\d+)\\.\\w+$', 1), ''), image_filename) as label, {_FOLIO} a, {_BARE} b, {_NUMBER} c from {P})""",
        "page_text": f"select page_id, coalesce(string_agg(t, chr(10) || chr(10) order by region_index, region_id, i), '') full_text from (select page_id from {R} group by 1) left join (select page_id, region_index, region_id, unnest(parts) t, generate_subscripts(parts, 1) i from ({_PARTS})) using (page_id) group by 1",
        "region_languages": f"select page_id, coalesce(array_to_string(list_sort(list(distinct l) filter (l is not null and l <> '')), ','), '') languages from (select page_id from {R}) left join (select page_id, unnest(languages) l from {R}) using (page_id) group by 1",
        "entry_numbers": f"""with r as (select page_id, region_index, region_id, region_type, content, row_number() over (partition by page_id order by region_index, region_id) o from {R} where region_type in ('entry_heading', 'main_text')), {_ENTRY_SQL}
          select p.page_id, coalesce(x.numbers, '') numbers from (select distinct page_id from r) p left join x using (page_id)""",
        "crop_boxes": f"""with b as (select region_id, round_even(least(bbox[2], bbox[4]) / 1000 * 2950, 0)::int l, round_even(greatest(bbox[2], bbox[4]) / 1000 * 2950, 0)::int r, round_even(least(bbox[1], bbox[3]) / 1000 * 4130, 0)::int t, round_even(greatest(bbox[1], bbox[3]) / 1000 * 4130, 0)::int u from {R} where len(bbox) = 4)
          select region_id, greatest(0, l - 83) as "left", greatest(0, t - 116) as top, least(2950, r + 83) as "right", least(4130, u + 116) as bottom from b where r > l and u > t""",
        "contents": f"""with f as (select page_id, arg_min(content, (region_index, region_id)) filter (region_type = 'entry_heading' and content <> '') h, arg_min(content, (region_index, region_id)) filter (region_type = 'main_text' and content <> '') m from {R} group by 1)
          select page_id, coalesce(nullif({_strip('substring(h, 1, 72)')}, ''), replace({_strip('substring(m, 1, 72)')}, chr(10), ' ')) heading from f""",
        "page_copy": f"""with c as (select page_id, region_type, marginal_position, region_index, region_id, bbox, coalesce(len(bbox) = 4, false) has, {_strip("coalesce(content, '')")} t from {R}),
          s as (select *, case region_type when 'entry_heading' then chr(10) || '=== ' || t || ' ===' || chr(10) when 'marginal_note' then '[margin ' || coalesce(marginal_position, '') || '] ' || t when 'page_number' then '[page_number] ' || t else t end shown from c where t <> '')
          select page_id, {_strip("string_agg(shown, chr(10) || chr(10) order by not has, case when has then bbox[1] end nulls first, case when has then bbox[2] end nulls first, region_index, region_id)")} as text from s group by 1""",
        "margin_recall": f"""with w as (select page_id, region_type = 'marginal_note' is_margin, list_filter(str_split({_legacy('content')}, ' '), lambda z: z <> '')[1:5] want from {R}),
          h as (select page_id, list(distinct z) have from (select page_id, unnest(str_split({_legacy('content_pre_consistency')}, ' ')) z from {R} where region_type = 'marginal_note') where z <> '' group by 1),
          j as (select page_id, count(*) filter (is_margin and coalesce(list_has_any(want, have), false)) found, count(*) filter (is_margin) n from w left join h using (page_id) group by 1)
          select page_id, found, n, round(found / greatest(n, 1), 6) recall from j""",
        "json_answers": f"""with p as (select record_id, case when json_valid(payload) then payload::json end j from (select distinct on (record_id) record_id, payload from page_records)),
          k as (select *, coalesce({', '.join(f"case when json_type(j, '$.{key}') = 'ARRAY' then json_array_length(j, '$.{key}') end" for key in stages.ANSWER_KEYS)}) known from p)
          select record_id, coalesce(case when json_type(j) = 'ARRAY' then json_array_length(j) when json_type(j) = 'OBJECT' then coalesce(known, (select json_array_length(x) from (select unnest(list_transform(json_keys(j), lambda q: json_extract(j, '$."' || q || '"'))) x) where json_type(x) = 'ARRAY' and (json_array_length(x) = 0 or json_type(x, '$[0]') = 'OBJECT') limit 1), case when json_type(j, '$.region_index') <> 'NULL' then 1 end) end, 0)::int as items from k""",
        "table_text": f"select region_id, coalesce(array_to_string(list_transform(table_data.cells, lambda w: coalesce(array_to_string(list_transform(w, lambda c: coalesce(c, '')), '  '), '')), chr(10)), '') flat from {R} where table_data is not null",
        "reading_order": f"select region_id, page_id, row_number() over (partition by page_id order by case when len(bbox) = 4 then 0 else 1 end, case when len(bbox) = 4 then bbox[1] end nulls last, case when len(bbox) = 4 then bbox[2] end nulls last, region_index, region_id)::int as position from {R}",
        "rectangles": f'select region_id, round(least(bbox[2], bbox[4]) / 10, 4) as "left", round(least(bbox[1], bbox[3]) / 10, 4) top, round(greatest(abs(bbox[4] - bbox[2]) / 10, 0.4), 4) width, round(greatest(abs(bbox[3] - bbox[1]) / 10, 0.4), 4) height from {R} where len(bbox) = 4',
        "mask_boxes": f"select a.region_id, count(*) others from (select page_id, region_id from {R} where len(bbox) = 4) a join (select page_id, region_id from {R} where len(bbox) = 4) b on a.page_id = b.page_id and a.region_id <> b.region_id group by 1",
        "gt_lookup": f"with t as (select journal_id, {_FOLIO} k, max(page_id) gt_page_id from {P} where page_id in (select page_id from regions where {_TRUTH}) and {_FOLIO} <> '' group by 1, 2), q as (select page_id, journal_id, unnest([{_FOLIO}, {_BARE}, {_NUMBER}]) k, unnest([1, 2, 3]) r from {P}) select q.page_id, arg_min(gt_page_id, r) gt_page_id from q join t on q.journal_id = t.journal_id and q.k = t.k and q.k <> '' group by 1",
        "gt_coverage": f"select journal_id, count(*) pages, count(*) filter (where n > 0) with_gt, coalesce(sum(n), 0)::bigint regions_with_gt, count(*) filter (where n is null) as empty from {P} left join (select page_id, count(*) filter (where {_TRUTH}) n from {R} group by 1) using (page_id) group by 1",
        "unprocessed_pages": f"select page_id, journal_id from {P} where page_id not in (select page_id from regions where page_id is not null)",
        "carried_folios": f"select page_id, coalesce(last_value(folio_label ignore nulls) over (partition by journal_id order by page_number, page_id rows between unbounded preceding and current row), first_value(folio_label ignore nulls) over (partition by journal_id order by page_number, page_id rows between current row and unbounded following)) folio from {P}",
        "type_runs": f"select page_id, island, any_value(region_type) region_type, count(*) n from (select *, sum(case when region_type is not distinct from p and rn > 1 then 0 else 1 end) over (partition by page_id order by region_index, region_id)::bigint island from (select page_id, region_index, region_id, region_type, lag(region_type) over (partition by page_id order by region_index, region_id) p, row_number() over (partition by page_id order by region_index, region_id) rn from {R})) group by 1, 2",
        "majority_reading": f"with {_VOTES} select region_id, arg_max(reading, (n, length(reading), -first)) reading from v group by 1",
        "reading_votes": f"with {_VOTES} select region_id, string_agg(reading || ' (×' || n || ')', ' | ' order by n desc, length(reading) desc, first) votes from v group by 1",
        "label_union": f"select r.region_id, coalesce(x.l, '') languages from {R} r left join (select region_id, string_agg(l, ',' order by i) l from (select region_id, l, min(i) i from (select region_id, unnest(languages) l, generate_subscripts(languages, 1) i from {R}) where l is not null group by 1, 2) group by 1) x using (region_id)",
        "truth_entities": f"select r.region_id, m.mention_id from (select region_id, page_id, coalesce(nullif(trim(ground_truth_content), ''), content) g from {R} where content is not null) r join {M} m on r.page_id = m.page_id and m.text <> '' and contains(r.g, m.text)",
        "canonical_truth": f"select page_id, string_agg(ground_truth_content, chr(10) order by region_index, ground_truth_content) canonical from {R} where {_TRUTH} group by 1",
        "run_spread": f"select region_type, count(v) n, round(avg(v), 6) mean, round(coalesce(stddev_pop(v), 0), 6) std from (select run_id, region_type, avg(ground_truth_confidence) v from {R} where ground_truth_confidence is not null group by 1, 2) group by 1",
        "confidence_quartiles": f"select region_type, round(quantile_cont(c, 0.0), 6) low, round(quantile_cont(c, 0.25), 6) q1, round(quantile_cont(c, 0.5), 6) median, round(quantile_cont(c, 0.75), 6) q3, round(quantile_cont(c, 1.0), 6) high from (select region_type, ground_truth_confidence c from {R} where ground_truth_confidence is not null) group by 1",
        "entity_scores": f"""with a as (select distinct journal_id, {_nk('text')} nm, entity_type from {M}), b as (select distinct journal_id, {_nk('normalized_form')} nm, entity_type from {M}), j as (select coalesce(a.journal_id, b.journal_id) journal_id, a.nm x, b.nm z from (select * from a where nm <> '') a full join (select * from b where nm <> '') b on a.journal_id = b.journal_id and a.nm = b.nm and a.entity_type = b.entity_type),
          c as (select journal_id, count_if(x is not null and z is not null) tp, count_if(z is null) fp, count_if(x is null) fn from j group by 1) select journal_id, tp, fp, fn, round(tp / greatest(tp + fp, 1), 6) as precision, round(tp / greatest(tp + fn, 1), 6) recall, round(case when tp > 0 then 2.0 * (tp / greatest(tp + fp, 1)) * (tp / greatest(tp + fn, 1)) / (tp / greatest(tp + fp, 1) + tp / greatest(tp + fn, 1)) else 0 end, 6) f1 from c""",
        "layout_duplicates": f"""with w as (select region_id, region_index, first_value(region_index) over q of, row_number() over q n from {R} where trim(content) <> '' and not coalesce(is_visual, false) window q as (partition by page_id, content order by region_index, region_id)), dd as (select * from w where n > 1 and of <> region_index)
          select r.region_id, r.region_type, case when dd.region_id is not null then '' else r.content end as content, case when dd.region_id is null then r.editorial_note when r.editorial_note is null or r.editorial_note = '' then 'Duplicate of region ' || of || ' — removed here.' when contains(r.editorial_note, 'Duplicate of region ' || of || ' — removed here.') then r.editorial_note else r.editorial_note || ' | Duplicate of region ' || of || ' — removed here.' end editorial_note, case when dd.region_id is not null then 'duplicate_text' end issue,
          case when dd.region_id is not null then 'warning' end severity, case when dd.region_id is not null then 0 else coalesce(len(r.uncertain_readings), 0)::int end uncertain from {R} r left join dd using (region_id)""",
        "detections": f"""with a as (select page_id, region_index, region_id, region_type, content is not null t, lower(['Left margin', 'top left', 'upper edge, at the TOP', 'bottom', 'bleed-through', 'opposite page', 'interlinear', ''][1 + region_id % 8]) said,
            case region_id % 3 when 0 then ['top', 'mTop', 'inline', 'Left', 'opposite', ' ', ''][1 + region_id % 7] when 1 then marginal_position end given from {R}),
          b as (select *, case when (given is null or given = '') and region_type = 'marginal_note' then case when contains(said, 'left') then 'left' when contains(said, 'right') then 'right' when contains(said, 'top') then 'mTop' when contains(said, 'bottom') then 'mBottom' when contains(said, 'opposite') or contains(said, 'bleed') then 'opposite' else given end when given is null or given in ('', 'left', 'right', 'mTop', 'mBottom', 'opposite', 'inline') then given end mp from a)
          select page_id, (row_number() over (partition by page_id order by region_index, region_id) - 1)::int region_index, region_type, case when mp = 'opposite' then false else t end has_text, mp as marginal_position from b""",
        "page_slice": f"select journal_id, page_id from (select journal_id, page_id, row_number() over (partition by journal_id order by page_number, page_id) - 1 i, count(*) over (partition by journal_id) n from {P}) where i >= 2 and i < greatest(n - 3, 0)",
        "run_union": f"select run_id, count(*) pages, count(case when page_id % 2 = 0 then folio_label end) labelled from {P} where page_id % 2 in (0, 1) group by 1",
        "swapped_content": f"with {_VOTES}, m as (select region_id, arg_max(reading, (n, length(reading), -first)) reading from v group by 1), t as (select page_id, region_index, min(reading) t from m join {R} using (region_id) group by 1, 2) select r.region_id, coalesce(t.t, r.content) as content from {R} r left join t using (page_id, region_index)",
        "slip_counts": f"select * from (select page_id, count_if(region_type = 'pasted_slip') found from {R} where content <> '' group by 1) join (select page_id, count_if(region_type = 'pasted_slip') wanted from {R} where content_pre_consistency <> '' group by 1) using (page_id)",
        "unmatched_folios": f"with t as (select distinct journal_id, {_FOLIO} k from {P} where page_id in (select page_id from regions where {_TRUTH}) and {_FOLIO} <> ''), q as (select page_id, journal_id, unnest([{_FOLIO}, {_BARE}, {_NUMBER}]) k from {P}) select page_id, folio_label from {P} where page_id not in (select q.page_id from q join t on q.journal_id = t.journal_id and q.k = t.k and q.k <> '')",
        "retryable_texts": f"select doc_id, p as passing, 3 < case when p then 5 else 3 end again from (select doc_id, {' or '.join(f"contains(lower(coalesce(text, '')), '{x}')" for x in providers.RETRYABLE)} p from documents)",
        "recorded_answers": f"select page_id request, a.r is not null ok, coalesce(md5(a.r), '[]') answer from {P} left join (select record_id, arg_max(payload, received_at) r from page_records where json_valid(payload) group by 1) a on a.record_id = page_id",
        "prompt_rows": f"""select page_id, length('[' || string_agg('{{"region_index":' || region_index || ',"region_type":"' || region_type || '"}}', ',' order by region_index, region_id) || ']')::int chars from {R} group by 1""",
        "reconstructed_regions": f"""with r as (select *, row_number() over (partition by page_id order by region_index, region_id)::int i, coalesce(case when region_id % 7 = 0 then 'opposite' else marginal_position end = 'opposite', false) o, region_id % 3 <> 0 got from {R}), c as (select *, case when o or not got then '' else coalesce(content, '') end c from r)
          select page_id, i region_index, c as content, case when o then false when got and region_id % 2 = 0 and is_visual is not null then is_visual else region_type = 'sketch' or region_id % 5 = 0 end is_visual, case when o then 'Bleedthrough from opposite folio — not transcribed.' when got then editorial_note end editorial_note,
          case when o or not got then '' else coalesce(array_to_string(list_filter(languages, lambda z: z is not null), ','), '') end languages, len(regexp_extract_all(c, '[\\p{{L}}\\p{{N}}_]*\\[\\?\\]'))::int uncertain from c""",
        "legend": f"select journal_id, string_agg(t, ',' order by coalesce(list_position({list(views.LEGEND)}, t), 1000), t) as types from (select distinct journal_id, region_type t from {R} where region_type is not null) group by 1",
        "register_labels": f"with {_LINK_SQL}, i as (select mention_id, case when mention_id % 3 = 0 then 'X' || ids[1] else ids[1] end e from l where ids is not null) select mention_id, coalesce(b.label, e) as label from i left join (select ehd_id, min(trim(label)) as label from register group by 1) b on b.ehd_id = e",
        "pages_with_image": f"select page_id from {P} where image_filename in (select image_filename from pages where page_id % 2 = 0)",
        "valid_entities": f"select min(mention_id) mention_id from {M} where entity_type in ('Person','Location','Species','Instrument','Measurement','Publication','Indigenous_Group','Celestial_Object') and trim(text) <> '' group by page_id, text, entity_type",
        "names_to_resolve": f"select distinct name from (select {_PLACE_NAME} as name from {M} where entity_type = 'Location') where name <> '' and name not in (select trim(label) from register where kind = 'place')",
        "resolved_places": f"select distinct n.name, g.lat, g.lon, case when g.name is not null then 'register' end source, g.name is not null as found from (select {_PLACE_NAME} as name from {M} where entity_type = 'Location') n left join {_GAZ} g on g.name = n.name where n.name <> ''",
        "place_centroid": f"select round(avg(lat), 6) lat, round(avg(lon), 6) lon, count(*) n from (select distinct n.name, g.lat, g.lon from (select {_PLACE_NAME} as name from {M} where entity_type = 'Location') n join {_GAZ} g on g.name = n.name where n.name <> '')",
        "event_props": "select event_id, try_cast(json_extract_string(props, '$.k') as int) k from events",
        "entity_frequency": f"select entity_type, text, n from (select entity_type, text, count(*) n, min(mention_id) f from {M} group by 1, 2 order by n desc, f limit 20)",
        "entities_by_page": f"select page_id, entity_type, count(*) n from {M} group by 1, 2",
        "totals": f"select (select count(*) from {P}) pages, (select count(*) from {R}) regions, (select count(*) from {M}) entities, (select count_if(entity_type = 'Location') from {M}) locations",
        "region_types": f"select journal_id, region_type, count(*) n, count_if(is_visual) visual from {R} group by 1, 2",
        "register_counts": "select kind, count(*) n from register group by 1",
        "word_search": f"select region_id from {R} where contains(lower(content), 'barometer')",
        "authorities": "select ehd_id, case when regexp_full_match(ehd_id, 'H\\d+') then 'https://register.example/' || ehd_id end url, 'Wikidata' authority, case when note is null or note = '' then 'checked' when contains(note, 'checked') then note else note || ' | checked' end note, cast(regexp_extract(ehd_id, '(\\d+)$', 1) as double) lon from register",
    }
