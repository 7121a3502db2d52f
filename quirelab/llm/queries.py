"""The queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import spread, table
from . import bpe, canonical, consensus_readers, languages, lookalike, mix, repair, resolve, spans


def p1_found(spark, d):
    return canonical.map_mentions(table(spark, d, "mentions"), table(spark, d, "register")).select("mention_id", "ehd_id")


def p1_unmatched(spark, d):
    """How often each value without an entry stands in the mentions."""
    m = table(spark, d, "mentions")
    none = canonical.map_mentions(m, table(spark, d, "register")).filter("ehd_id = 'none'").select("mention_id")
    return m.dropDuplicates(["mention_id"]).join(none, "mention_id").groupBy("entity_type", "text").agg(F.count("*").alias("mentions"))


def _text_regions(spark, d):
    return table(spark, d, "regions").select("region_id", "page_id", "region_type", "content", "languages")


def p3_found(spark, d):
    return languages.wrong_labels(_text_regions(spark, d), table(spark, d, "pages").select("page_id", "page_languages"))


def p3_holders(spark, d):
    """Languages and confidence of every text region and page."""
    h = languages.holders(_text_regions(spark, d), table(spark, d, "pages").select("page_id", "page_languages"))
    return h.select("holder", "record_id", F.array_join("label", ",").alias("label"), F.array_join("langs", ",").alias("langs"), "confidence")


def p3_segments(spark, d):
    return languages.segments(_text_regions(spark, d))


def _readings(spark, d):
    return table(spark, d, "regions").select("region_id", "region_type", "ensemble_readings", "reader_ids")


def p4_found(spark, d):
    return consensus_readers.consensus(_readings(spark, d))[0].filter("kinds > 1").select("region_id", "reading")


def p4_consensus(spark, d):
    return consensus_readers.consensus(_readings(spark, d), types=None)[0]


def p4_readers(spark, d):
    return consensus_readers.reader_reliability(_readings(spark, d))


def _spans(spark, d):
    return table(spark, d, "regions").select("region_id", "content", "content_pre_consistency")


def p5_found(spark, d):
    return spans.pairs(_spans(spark, d))


def p5_shares(spark, d):
    return spans.shares(_spans(spark, d), fields=("content", "content_pre_consistency"))


def p5_intervals(spark, d):
    return spans.intervals(_spans(spark, d))


def _scanned(spark, d):
    regions = table(spark, d, "regions").select("region_id", "region_type", "journal_id", "content", "region_index", "bbox", "table_data")
    return regions, table(spark, d, "pages").select("page_id", "journal_id", "full_text", "page_number", "folio_label"), table(spark, d, "journals")


def p6_found(spark, d):
    return repair.find(*_scanned(spark, d))


def p6_repaired(spark, d):
    return repair.repair(*_scanned(spark, d))


def p7_found(spark, d):
    return resolve.pairs(table(spark, d, "person_names"))


def p7_clusters(spark, d):
    return resolve.resolve(table(spark, d, "person_names"))


def p8_ids(spark, d):
    return bpe.encode(spread(table(spark, d, "documents").select("doc_id", "text")))


def p8_round_trip(spark, d):
    """Documents whose decoded text differs from the text: must be empty."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return bpe.decode(bpe.encode(spread(docs))).withColumnRenamed("text", "decoded").join(docs, "doc_id").filter("decoded <> coalesce(text, '')").select("doc_id")


#: The tree over the sources of the documents table: domain of each source.
DOMAINS = {
    "journal_transcript": "transcription", "tei_ground_truth": "transcription", "letter": "correspondence",
    "register_note": "reference", "gazetteer": "reference", "bibliography": "reference", "editorial_comment": "editorial",
    "travel_summary": "editorial", "instrument_log": "observation", "herbarium_label": "observation",
}


def _mixed(spark, d, **how):
    return mix.mix(spread(table(spark, d, "documents").select("doc_id", "text", "lang", "source")), table(spark, d, "mix_targets"), domains=DOMAINS, **how)


def p9_mix(spark, d):
    return _mixed(spark, d)[0]


def p9_shares(spark, d):
    return _mixed(spark, d)[1]


def p9_mix_whole_corpus(spark, d):
    """As many tokens as the corpus has: what scarce sources cannot give is redistributed among siblings, then ancestors."""
    return _mixed(spark, d, share_of_corpus=1.0)[0]


def p9_shares_whole_corpus(spark, d):
    """The shares of that mix; sources out of reach report what they reached."""
    return _mixed(spark, d, share_of_corpus=1.0)[1]


def p10_found(spark, d):
    return lookalike.pairs(table(spark, d, "documents").select("doc_id", "text"))


def p10_normalized(spark, d):
    return lookalike.normalize(table(spark, d, "documents").select("doc_id", "text"))


def queries():
    return {f.__name__: f for f in (p1_found, p1_unmatched, p3_found, p3_holders, p3_segments, p4_found, p4_consensus, p4_readers, p5_found, p5_shares, p5_intervals, p6_found, p6_repaired, p7_found, p7_clusters, p8_ids, p8_round_trip, p9_mix, p9_shares, p9_mix_whole_corpus, p9_shares_whole_corpus, p10_found, p10_normalized)}


_GRAMS = "(select distinct region_id, substring(t, i, 120) g from (select region_id, t, unnest(range(1, length(t) - 118)) i from (select region_id, unnest([content, content_pre_consistency]) t from (select distinct on (region_id) * from regions)) where length(t) >= 120))"


def oracle_sql():
    """SQL where it can say the same on whole tables: shared spans are joined gram by gram; a round trip loses nothing."""
    return {
        "p5_found": f"with g as {_GRAMS}, s as (select g from g group by 1 having count(*) > 1), h as (select * from g where g in (select g from s)) select distinct a.region_id region_id_a, b.region_id region_id_b from h a join h b on a.g = b.g and a.region_id < b.region_id",
        "p8_round_trip": "select doc_id from documents where false",
    }
