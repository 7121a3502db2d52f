"""Mixing sources to target weights (problem 9): hierarchical budgeting over a domain-language-source tree.

A leaf is (domain, language, source). The target of a source is spread over its leaves in proportion to
their tokens, and a node's weight is the sum of its leaves' weights. Budgets flow from the root down by
weight; what a leaf cannot hold (its tokens times max_repeats) goes to its siblings first, then to the
nearest ancestor with room. Each leaf takes a token prefix of its seeded epochs: whole epochs, then the
documents of one more epoch in the order of a seeded hash until the budget is met.

Only the tree (sources x languages) is small; it is what the budgets are worked out on. Documents are
never gathered: the prefix of the last epoch is found from token sums per hash bucket, and only the one
bucket per leaf at the boundary is ordered document by document.

Defined cases: null and blank languages form the language `und`, also `false`; a source without a target
has target 0 and is left out; a source with a target but no tokens reports share 0; null max_repeats
counts as 1; null, empty and zero-token documents are never drawn; repeated doc_ids are separate documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import cut
from . import bpe
from .sampling import bounded

BUCKETS = 1 << 14
#: A language is a code of two or three letters; anything else is `und`.
CODE = r"^[a-z]{2,3}$"
#: Leaves (sources x languages) the driver will work budgets out for, and targets it will read.
LEAVES = 200_000


def allot(leaves: dict[tuple, dict], total: float) -> None:
    """Set `budget` of each leaf (keys are paths domain, language, source; needs weight, room).

    A node shares what it is given among its children by weight; what finds no room in a child goes to the
    others, and only what finds none in any goes up. Every pass over a node fills a child, so work grows with the
    nodes and the depth."""
    tree: dict[tuple, dict[tuple, None]] = {}
    for k, leaf in leaves.items():
        leaf["budget"] = 0.0
        for n in range(len(k)):
            tree.setdefault(k[:n], {})[k[: n + 1]] = None
    # weight and room of what is not full, by node
    weight: dict[tuple, float] = {}
    room: dict[tuple, float] = {}
    for k, leaf in leaves.items():
        for n in range(len(k) + 1):
            weight[k[:n]] = weight.get(k[:n], 0.0) + leaf["weight"]
            room[k[:n]] = room.get(k[:n], 0.0) + leaf["room"]

    def fill(node: tuple, amount: float) -> None:
        """Place `amount`, for which there is room, under `node`."""
        if node in leaves:
            leaves[node]["budget"] += amount
            return
        # children that would overflow are filled whole; the rest share what is left by weight
        live = {c: None for c in sorted(tree[node]) if room[c] > 1e-9 and weight[c] > 0}
        while live:
            whole = sum(weight[c] for c in live)
            full = [c for c in live if amount * weight[c] / whole >= room[c]]
            if not full:
                for c in live:
                    fill(c, amount * weight[c] / whole)
                return
            for c in full:
                fill(c, min(room[c], amount))
                amount = max(0.0, amount - room[c])
                del live[c]

    if leaves:
        fill((), min(total, room[()]))


def feasible_total(sources: dict[str, dict]) -> float:
    """The largest mix in which every source that has tokens reaches its target exactly."""
    able = [s["tokens"] * s["repeats"] / s["target"] for s in sources.values() if s["target"] > 0 and s["tokens"] > 0]
    reachable = sum(s["target"] for s in sources.values() if s["tokens"] > 0)
    return min(able, default=0.0) * reachable


def mix(docs: DataFrame, targets: DataFrame, total: float | None = None, share_of_corpus: float | None = None, seed: int = 7, path: str = bpe.DEFAULT_VOCABULARY, domains: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, domain, language, n_tokens, copies) of the drawn documents, and the report by source.

    `total`: tokens of the mix; `share_of_corpus`: the same as a multiple of all tokens; by default the
    largest total at which every target is reached. `domains`: domain of each source; a source it does not name is
    a domain of its own."""
    domains = domains or {}
    spark = docs.sparkSession
    lang = F.lower(F.trim(F.col("lang").cast("string")))
    base = docs.select(
        "doc_id", "text", F.col("source").cast("string").alias("source"),
        F.when(lang.rlike(CODE), lang).otherwise("und").alias("language"),
    )
    bucket = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(BUCKETS)).cast("int")
    counted = cut(bpe.count_tokens(base, path=path).filter("source is not null and n_tokens > 0").withColumn("bucket", bucket))
    held = bounded(counted.groupBy("source", "language").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), LEAVES, "sources and languages")
    wanted = {r["source"]: r for r in bounded(targets.groupBy("source").agg(F.max("target_share").alias("t"), F.max("max_repeats").alias("m")).filter("source is not null"), LEAVES, "targets")}
    sources = {s: {"target": r["t"] or 0.0, "repeats": max(1, r["m"] if r["m"] is not None else 1), "tokens": 0, "docs": 0} for s, r in wanted.items()}
    for r in held:
        s = sources.setdefault(r["source"], {"target": 0.0, "repeats": 1, "tokens": 0, "docs": 0})
        s["tokens"] += r["tokens"]
        s["docs"] += r["docs"]
    leaves = {}
    for r in held:
        s = sources[r["source"]]
        if s["target"] > 0:
            leaves[(domains.get(r["source"], r["source"]), r["language"], r["source"])] = {"weight": s["target"] * r["tokens"] / s["tokens"], "room": float(r["tokens"] * s["repeats"]), "tokens": r["tokens"], "repeats": s["repeats"]}
    corpus = sum(s["tokens"] for s in sources.values())
    goal = total if total is not None else share_of_corpus * corpus if share_of_corpus is not None else feasible_total(sources)
    allot(leaves, goal)

    rows = [(d, g, s, int(x["budget"] // x["tokens"]), x["budget"] - (x["budget"] // x["tokens"]) * x["tokens"], x["repeats"]) for (d, g, s), x in leaves.items()]
    plan = F.broadcast(spark.createDataFrame(rows, "domain string, language string, source string, epochs int, rest double, most int"))
    drawn = counted.join(plan, ["source", "language"])
    # Token sums per (leaf, bucket): at most BUCKETS rows a leaf, so the running sum is over a bounded table.
    sums = drawn.groupBy("source", "language", "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
    order = W.partitionBy("source", "language").orderBy("bucket")
    sums = sums.withColumn("before", F.coalesce(F.sum("in_bucket").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    edge = sums.join(plan, ["source", "language"]).filter("before < rest and before + in_bucket > rest")
    edge = F.broadcast(edge.select("source", "language", F.col("bucket").alias("edge"), F.col("before").alias("edge_before")))  # one row a leaf
    full = F.broadcast(sums.join(plan, ["source", "language"]).filter("before + in_bucket <= rest").groupBy("source", "language").agg(F.max("bucket").alias("full_to")))
    marked = drawn.join(edge, ["source", "language"], "left").join(full, ["source", "language"], "left")
    inside = F.col("bucket") <= F.coalesce("full_to", F.lit(-1))
    at_edge = marked.filter("bucket = edge")
    within = W.partitionBy("source", "language").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id")
    at_edge = at_edge.withColumn("upto", F.col("edge_before") + F.sum("n_tokens").over(within.rowsBetween(W.unboundedPreceding, 0)))
    # A document is taken while the greater part of it lies within the budget.
    at_edge = at_edge.withColumn("more", (F.col("upto") - F.col("n_tokens") / 2 <= F.col("rest")).cast("int")).drop("upto")
    others = marked.filter("edge is null or bucket <> edge").withColumn("more", inside.cast("int"))
    out = others.unionByName(at_edge).withColumn("copies", F.least(F.col("epochs") + F.col("more"), F.col("most")))
    out = out.filter("copies > 0").select("doc_id", "source", "domain", "language", "n_tokens", "copies")

    known = spark.createDataFrame([(s, float(x["target"]), x["repeats"], x["tokens"], x["docs"]) for s, x in sources.items()], "source string, target_share double, max_repeats int, source_tokens long, source_docs long")
    got = out.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mix_tokens"), F.max("copies").alias("most_copies"))
    report = F.broadcast(known).join(got, "source", "left").withColumn("mix_tokens", F.coalesce("mix_tokens", F.lit(0)))
    share = F.col("mix_tokens") / F.nullif(F.sum("mix_tokens").over(W.partitionBy(F.lit(1))), F.lit(0))  # one row a source
    report = report.withColumn("actual_share", F.round(F.coalesce(share, F.lit(0.0)), 6))
    report = report.withColumn("out_of_reach", (F.col("target_share") > 0) & (F.lit(goal) * F.col("target_share") > F.col("source_tokens") * F.col("max_repeats") + 0.5) | ((F.col("target_share") > 0) & (F.col("source_tokens") == 0)))
    return out, report.withColumn("most_copies", F.coalesce("most_copies", F.lit(0)))
