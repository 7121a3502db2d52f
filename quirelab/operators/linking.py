"""Entity linking against an authority register: key index, exact cascade, surname ranking, likeness.

Each stage is an equality join on distinct keys; likeness is tried only for values no stage resolved, on
candidates that share a segment at a fitting place, so nothing is compared with the whole register."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import kernels
from ..functions.text import last_token, norm_key
from ..session import cut

#: Keys of the register up to which its pieces are sent to the tasks; of more they are joined by shuffle.
SMALL = 50_000
KINDS = {"Location": "place", "Species": "plant", "Person": "person"}


def kind_of(entity_type: Column, kinds: dict[str, str] = KINDS) -> Column:
    """Register kind of an entity type, null where the type isn't linked."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]), entity_type)


def register_keys(register: DataFrame) -> DataFrame:
    """kind, k, ids, n: the inverted index of labels and other labels; ids in order, without repeats."""
    names = F.concat(F.array("label"), F.coalesce("alt_labels", F.array().cast("array<string>")))
    keys = register.select("kind", "ehd_id", F.explode(names).alias("name")).select("kind", "ehd_id", norm_key(F.col("name")).alias("k")).filter("k <> ''")
    return keys.groupBy("kind", "k").agg(F.array_sort(F.collect_set("ehd_id")).alias("ids")).withColumn("n", F.size("ids"))


def candidates(mentions: DataFrame) -> DataFrame:
    """mention_id, kind, k, stage, method of the names to look up: the standard form before the text."""
    tries = F.array(
        F.struct(F.lit(1).alias("stage"), F.lit("normalized_form").alias("method"), norm_key(F.col("normalized_form")).alias("k")),
        F.struct(F.lit(2).alias("stage"), F.lit("exact").alias("method"), norm_key(F.col("text")).alias("k")),
    )
    return mentions.withColumn("kind", kind_of(F.col("entity_type"))).filter("kind is not null").select("mention_id", "kind", F.explode(tries).alias("c")).select("mention_id", "kind", "c.*").filter("k <> ''")


def link_exact(mentions: DataFrame, register: DataFrame) -> DataFrame:
    """mention_id, ehd_id, method, score, matched_on, ambiguous, candidates of mentions the index resolves; the first stage wins."""
    return _exact(candidates(mentions), register_keys(register))


def _exact(tries: DataFrame, keys: DataFrame) -> DataFrame:
    hits = tries.join(keys, ["kind", "k"])
    first = hits.groupBy("mention_id").agg(F.min(F.struct("stage", "method", "k", "ids")).alias("h"))
    return first.select("mention_id", F.col("h.ids")[0].alias("ehd_id"), F.col("h.method").alias("method"), F.lit(1.0).alias("score"), F.col("h.k").alias("matched_on"), (F.size("h.ids") > 1).alias("ambiguous"), F.slice("h.ids", 2, 1000000).alias("candidates"))


def near_pairs(values: DataFrame, keys: DataFrame, share: float = 0.1) -> DataFrame:
    """kind, s, k for values and keys at most `share` of their joint length apart in edits.

    A key of length L allows at most t edits; cut into t + 1 pieces, one stands unchanged in the value, shifted
    by at most t. Pieces are matched by equality, candidates verified by the built-in distance."""
    t = F.floor((2 * F.length("k") + 4) * share).cast("int")
    pieces = keys.select("kind", "k", t.alias("t")).filter("length(k) > t").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("t"))))
    pieces = pieces.withColumn("size", F.expr("length(k) div (t + 1)")).withColumn("at", (F.col("i") * F.col("size") + 1).cast("int"))
    pieces = pieces.withColumn("size", F.when(F.col("i") == F.col("t"), F.length("k") - F.col("at") + 1).otherwise(F.col("size")).cast("int")).withColumn("piece", F.expr("substring(k, at, size)"))
    small = keys.count() <= SMALL
    pieces = cut(pieces)
    layout = F.broadcast(pieces.select("kind", F.length("k").alias("len"), "t", "i", "at", "size").distinct())  # bounded by lengths times pieces
    probes = values.select("kind", "s").distinct().withColumn("len", F.explode(F.sequence(F.length("s") - 4, F.length("s") + 4))).join(layout, ["kind", "len"])
    probes = probes.withColumn("shift", F.explode(F.sequence(-F.col("t"), F.col("t")))).filter("at + shift >= 1 and at + shift + size - 1 <= length(s)")
    probes = probes.select("kind", "s", "len", "i", F.expr("substring(s, at + shift, size)").alias("piece")).distinct()
    held = pieces.select("kind", "k", "i", "piece", F.length("k").alias("len"))
    found = probes.join(F.broadcast(held) if small else held, ["kind", "len", "i", "piece"]).select("kind", "s", "k").distinct()
    return found.filter(F.levenshtein("s", "k") <= (F.length("s") + F.length("k")) * share)


def link_fuzzy(mentions: DataFrame, register: DataFrame, cutoff: float = 0.9) -> DataFrame:
    """mention_id, ehd_id, method, score, matched_on, ambiguous of mentions without an exact link.

    The likeness ratio must be above `cutoff`; the standard form wins ties, then the smaller key."""
    keys, tries = cut(register_keys(register)), cut(candidates(mentions))
    return _fuzzy(tries.join(tries.join(keys, ["kind", "k"], "left_semi").select("mention_id").distinct(), "mention_id", "left_anti"), keys, cutoff)


def _fuzzy(rest: DataFrame, keys: DataFrame, cutoff: float) -> DataFrame:
    """Links by likeness of the names `rest` to the register's keys."""
    pairs = near_pairs(rest.select("kind", F.col("k").alias("s")), keys, 1 - cutoff)
    rated = pairs.withColumn("score", kernels.u_ratio(F.col("s"), F.col("k"))).filter(F.col("score") > cutoff)
    hits = rest.withColumnRenamed("k", "s").join(rated, ["kind", "s"]).join(keys, ["kind", "k"])
    best = hits.groupBy("mention_id").agg(F.min(F.struct((-F.col("score")).alias("minus"), "stage", "k", "ids")).alias("h"))
    score = F.round(-F.col("h.minus"), 3)
    return best.select("mention_id", F.col("h.ids")[0].alias("ehd_id"), F.format_string("fuzzy:%.2f", -F.col("h.minus")).alias("method"), score.alias("score"), F.col("h.k").alias("matched_on"), (F.size("h.ids") > 1).alias("ambiguous"))


def link(mentions: DataFrame, register: DataFrame, fuzzy: bool = True, cutoff: float = 0.9) -> DataFrame:
    """Mentions with their link columns, null where nothing matched."""
    keys, tries = cut(register_keys(register)), cut(candidates(mentions))
    found = _exact(tries, keys).drop("candidates")
    if fuzzy:
        found = cut(found)
        found = found.unionByName(_fuzzy(tries.join(found.select("mention_id"), "mention_id", "left_anti"), keys, cutoff))
    return mentions.join(found, "mention_id", "left")


def link_surnames(names: DataFrame) -> DataFrame:
    """name_id, register_id, method, score, ambiguous of persons found by full name, then by surname.

    Register rows are those with origin `register`; persons of one surname are ranked by likeness of the full
    name, and the two best closer than 0.10 are ambiguous."""
    people = names.filter("entity_type = 'Person'")
    reg = people.filter("origin = 'register'").select(F.col("name_id").alias("register_id"), F.coalesce("normalized_form", "text").alias("label"), "surname").withColumn("full", norm_key(F.col("label")))
    asked = people.filter("origin = 'entity'").select("name_id", F.explode(F.array(F.struct(F.lit(1).alias("stage"), F.col("normalized_form").alias("name")), F.struct(F.lit(2).alias("stage"), F.col("text").alias("name")))).alias("c")).select("name_id", "c.*")
    asked = asked.withColumn("full", norm_key(F.col("name"))).filter("full <> ''")
    whole = reg.groupBy("full").agg(F.min("register_id").alias("register_id"), F.count("*").alias("n"))
    by_name = asked.join(whole, "full").groupBy("name_id").agg(F.min(F.struct("stage", "register_id", "n")).alias("h"))
    by_name = by_name.select("name_id", "h.register_id", F.when(F.col("h.stage") == 1, "normalized_form").otherwise("exact").alias("method"), F.lit(1.0).alias("score"), (F.col("h.n") > 1).alias("ambiguous"))
    rest = asked.join(by_name.select("name_id"), "name_id", "left_anti").withColumn("key", last_token(F.col("name")))
    surnames = reg.withColumn("key", norm_key(F.col("surname"))).filter("key <> ''").select("key", "register_id", F.col("full").alias("label"))
    # distinct (full name, surname) pairs are rated, not mentions
    pairs = rest.select("full", "key").distinct().join(surnames, "key").withColumn("ratio", kernels.u_ratio(F.col("full"), F.col("label")))
    order = W.partitionBy("full", "key").orderBy(F.desc("ratio"), "register_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).withColumn("runner", F.lead("ratio").over(order)).filter("rank = 1")
    close = F.col("runner").isNotNull() & (F.col("ratio") - F.col("runner") < 0.10)
    score = F.round(F.when(close, 0.6).otherwise(F.greatest(F.lit(0.7), F.least(F.lit(0.9), F.col("ratio")))), 3)
    ranked = ranked.select("full", "key", "register_id", score.alias("score"), close.alias("ambiguous"))
    by_surname = rest.join(ranked, ["full", "key"]).groupBy("name_id").agg(F.min(F.struct("stage", "register_id", "score", "ambiguous")).alias("h"))
    return by_name.unionByName(by_surname.select("name_id", "h.register_id", F.lit("surname").alias("method"), "h.score", "h.ambiguous"))
