"""Long exact spans shared between records (problem 5).

1. Anchors: of every ANCHOR-gram of a text those are kept that have the smallest hash in some run of
   least - ANCHOR + 1 grams. Any span of `least` characters holds one, the same one wherever it stands.
   Anchors and region ids alone are shuffled; an anchor of one region only (its two fields mostly say the
   same) leads nowhere, and a region without a shared anchor is not read again.
2. The surroundings of shared anchors (a span of `least` characters around the anchor lies within) go to
   shards by anchor. A shard runs one pass for each bit of the number a text has under its anchor: the texts
   with a 0 there make a compressed FM-index (wavelet matrix over the Burrows-Wheeler transform), those with
   a 1 are streamed through it by backward search, which keeps matching statistics and widens the suffix
   interval where a character fails. Where they reach `least`, the interval at that depth names the texts that
   share the span. Any two texts differ in some bit, so each pair meets once in an index it is not part of.
3. Spans that say the same become classes, and runs of places with one set of texts intervals of a class.

Work is done on distinct surroundings; those of several regions enter their shard twice, so that the search
itself reports them. An anchor with more than HOT distinct surroundings would make one shard too large: it is
lengthened to the left and to the right by half of what a span has beyond it (each span holds one of the two),
until its groups are small or it is as long as a span; such a group is split, and each part is streamed through
the index of the group's first text.

Defined cases: null, blank and short texts share nothing; a region sent twice counts once; content and
content_pre_consistency of one region do not count against each other; null ids are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import cut, spread

FIELDS = ("content", "content_pre_consistency")
ANCHOR = 60
#: Distinct surroundings of an anchor from which on it is lengthened.
HOT = 5000
#: Distinct surroundings a shard holds on average.
PER_SHARD = 3000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _slide(x: np.ndarray, w: int, best) -> np.ndarray:
    """best (min or max) over every run of w values, by doubling."""
    step, y = 1, x
    while step * 2 <= w:
        y = best(y[: len(y) - step], y[step:])
        step *= 2
    return best(y[: len(x) - w + 1], y[w - step : w - step + len(x) - w + 1]) if step < w else y


def anchors(texts: list[str], least: int = 120, k: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, hash) of the anchors of several texts."""
    none = np.empty(0, np.int64)
    keep = [i for i, t in enumerate(texts) if len(t) >= least]
    if not keep:
        return none, none, none
    w = least - k + 1
    codes = np.frombuffer("".join(texts[i] for i in keep).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(texts[i]) for i in keep])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    n = len(codes)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)
        inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _INVERSE)]), dtype=np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((codes + np.uint64(1)) * inverse, dtype=np.uint64)])
        h = (sums[k:] - sums[:-k]) * powers[: n - k + 1]
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        h ^= h >> np.uint64(31)
    h = np.maximum(h, np.uint64(1))
    low = _slide(h, w, np.minimum)
    inside = np.zeros(len(low), bool)
    for s, length in zip(starts, lengths, strict=True):
        inside[s : s + length - least + 1] = True
    low[~inside] = 0
    padded = np.concatenate([np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)])
    chosen = np.flatnonzero(_slide(padded, w, np.maximum)[: len(h)] == h)
    text = np.searchsorted(starts, chosen, "right") - 1
    return np.array(keep)[text], chosen - starts[text], h[chosen].view(np.int64)


class WaveletMatrix:
    """Rank of a symbol in a prefix, one packed bit vector with popcounts per level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels, x = bits, [], symbols
        for b in range(bits - 1, -1, -1):
            one = ((x >> b) & 1).astype(bool)
            pad = np.concatenate([one, np.zeros((-len(one)) % 64 + 64, bool)])
            words = np.packbits(pad, bitorder="little").view(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            zeros = int(len(one) - one.sum())
            self.levels.append((words, counts, zeros))
            x = np.concatenate([x[~one], x[one]])

    @staticmethod
    def _ones(words: np.ndarray, counts: np.ndarray, i: np.ndarray) -> np.ndarray:
        block, bit = i >> 6, (i & 63).astype(np.uint64)
        return counts[block] + np.bitwise_count(words[block] & ((np.uint64(1) << bit) - np.uint64(1)))

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each c before each i."""
        start = np.zeros_like(i)
        for b, (words, counts, zeros) in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            one = ((c >> b) & 1).astype(bool)
            s, e = self._ones(words, counts, start), self._ones(words, counts, i)
            start, i = np.where(one, zeros + s, start - s), np.where(one, zeros + e, i - e)
        return i - start


class FMIndex:
    """FM-index of several texts with the matching statistics of patterns against it."""

    def __init__(self, texts: list[str]):
        whole = "\x01".join(texts) + "\x01\x00"
        raw = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.alphabet, codes = np.unique(raw, return_inverse=True)
        codes = codes.astype(np.int64)
        n = len(codes)
        longest = max(map(len, texts)) + 1
        ranks, step, order = [codes], 1, np.argsort(codes, kind="stable")
        while step < longest:
            r = ranks[-1]
            second = np.concatenate([r[step:] + 1, np.zeros(min(step, n), np.int64)])[:n]
            key = r * (n + 2) + second
            order = np.argsort(key, kind="stable")
            sorted_ = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])
            ranks.append(new)
            step *= 2
        self.suffixes, self.n = order, n
        a, b = order[:-1].copy(), order[1:].copy()
        lcp = np.zeros(n - 1, np.int64)
        for j in range(len(ranks) - 1, -1, -1):
            ok = (a < n) & (b < n)
            same = np.zeros(n - 1, bool)
            same[ok] = ranks[j][a[ok]] == ranks[j][b[ok]]
            lcp[same] += 1 << j
            a[same] += 1 << j
            b[same] += 1 << j
        #: lcp[i]: common prefix of suffixes i-1 and i; ends are -1.
        self.lcp = np.concatenate([[-1], lcp, [-1]])
        self.before = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(self.alphabet)))])
        self.ranks = WaveletMatrix(codes[order - 1], max(1, int(len(self.alphabet) - 1).bit_length()))
        lengths = np.array([len(t) + 1 for t in texts])
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self._below: dict[int, np.ndarray] = {}

    def _widen(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Parent intervals and their depths."""
        depth = np.maximum(self.lcp[lo], self.lcp[hi])
        new_lo, new_hi = lo.copy(), hi.copy()
        for d in np.unique(depth):
            if d not in self._below:
                self._below[d] = np.flatnonzero(self.lcp < d)
            at, m = self._below[d], depth == d
            new_lo[m] = at[np.searchsorted(at, lo[m], "right") - 1]
            new_hi[m] = at[np.searchsorted(at, hi[m], "left")]
        return new_lo, new_hi, np.maximum(depth, 0)

    def statistics(self, patterns: list[str]) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
        """(pattern numbers, distance from the right end, match length, suffix interval start) at each step leftwards."""
        lengths = np.array([len(p) for p in patterns])
        order = np.argsort(-lengths, kind="stable")
        width = int(lengths.max(initial=0))
        text = np.full((len(patterns), width), -1, np.int64)
        lookup = {c: i for i, c in enumerate(self.alphabet.tolist())}
        for row, p in enumerate(order):
            text[row, : lengths[p]] = [lookup.get(ord(c), -1) for c in reversed(patterns[p])]
        lengths = lengths[order]
        lo, hi, got = np.zeros(len(order), np.int64), np.full(len(order), self.n, np.int64), np.zeros(len(order), np.int64)
        for step in range(width):
            live = int(np.searchsorted(-lengths, -step, "left"))
            c = text[:live, step]
            todo = np.arange(live)
            lost = todo[c < 0]
            lo[lost], hi[lost], got[lost] = 0, self.n, 0
            todo = todo[c >= 0]
            while len(todo):
                x = c[todo]
                nlo, nhi = self.before[x] + self.ranks.rank(x, lo[todo]), self.before[x] + self.ranks.rank(x, hi[todo])
                good = nlo < nhi
                lo[todo[good]], hi[todo[good]] = nlo[good], nhi[good]
                got[todo[good]] += 1
                todo = todo[~good]
                empty = got[todo] == 0
                todo = todo[~empty]
                if len(todo):
                    lo[todo], hi[todo], got[todo] = self._widen(lo[todo], hi[todo])
            yield order[:live], step, got[:live].copy(), lo[:live].copy()


def _hits(index: FMIndex, texts: list[str], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, suffix interval start) of every span of `least` characters of the streamed texts that the index holds."""
    who, at, lo = [], [], []
    lengths = np.array([len(t) for t in texts])
    for number, step, got, low in index.statistics(texts):
        hit = got >= least
        if hit.any():
            who.append(number[hit])
            at.append(lengths[number[hit]] - 1 - step)
            lo.append(low[hit])
    none = np.empty(0, np.int64)
    return tuple(np.concatenate(x) if x else none for x in (who, at, lo))


def _number(wid: str) -> int:
    return int(wid[:16], 16)


def shared_spans(anchor: list[int], wids: list[str], texts: list[str], copies: list[int], least: int) -> list[tuple[str, str, int, int]]:
    """(class, wid, first, last place) of spans of `least` characters that several texts under one anchor, or one held by two regions, contain."""
    order = sorted(range(len(texts)), key=lambda i: (anchor[i], wids[i]))
    entry = [i for i in order for _ in range(min(copies[i], 2))]
    t = [texts[i] for i in entry]
    key = np.array([anchor[i] for i in entry], np.int64)
    first = np.concatenate([[True], key[1:] != key[:-1]])
    begin = np.flatnonzero(first)
    group = np.cumsum(first) - 1
    size = np.diff(np.concatenate([begin, [len(key)]]))[group]
    ordinal = np.arange(len(key)) - begin[group]
    grams = np.array([len(x) - least + 1 for x in t])
    offset = np.concatenate([[0], np.cumsum(grams)])
    label = np.arange(offset[-1])  # of each span: the first one known to say the same
    for bit in range(int(size.max() - 1).bit_length()):
        within, streamed = size > 1 << bit, ordinal >> bit & 1 == 1
        a, b = np.flatnonzero(within & ~streamed), np.flatnonzero(within & streamed)
        index = FMIndex([t[i] for i in a])
        who, at, lo = _hits(index, [t[i] for i in b], least)
        if not len(who):
            continue
        same = np.cumsum(index.lcp[: index.n] < least)  # suffixes with the same first `least` characters
        held = np.searchsorted(index.starts, index.suffixes, "right") - 1
        place = index.suffixes - index.starts[held]
        asked = np.zeros(same[-1] + 1, bool)
        asked[same[lo]] = True
        held = np.minimum(held, len(a) - 1)
        ok = asked[same] & (place < grams[a][held])
        at_index, at_stream = offset[a[held[ok]]] + place[ok], offset[b[who]] + at
        where, cls = np.concatenate([at_index, at_stream]), np.concatenate([same[ok], same[lo]])
        least_label = np.full(same[-1] + 1, len(label))
        np.minimum.at(least_label, cls, label[where])
        label[where] = least_label[cls]
    owner = np.repeat(np.arange(len(t)), grams)
    by = np.lexsort((owner, label))
    new = np.concatenate([[True], (label[by][1:] != label[by][:-1]) | (owner[by][1:] != owner[by][:-1])])
    pl, po = label[by][new], owner[by][new]
    several = np.bincount(pl, minlength=len(label)) > 1
    # a class is the set of its texts: sums of their numbers name it, and a second copy adds nothing
    is_copy = np.array([j > 0 and entry[j] == entry[j - 1] for j in range(len(entry))])
    number = np.array([0 if c else _number(wids[i]) for i, c in zip(entry, is_copy, strict=True)], np.uint64)
    name = np.zeros(len(label), np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(name, pl, number[po])
    keep = np.flatnonzero(several[label] & ~is_copy[owner])
    if not len(keep):
        return []
    names, who, at = name[label[keep]], owner[keep], keep - offset[owner[keep]]
    start = np.concatenate([[True], (names[1:] != names[:-1]) | (who[1:] != who[:-1]) | (at[1:] != at[:-1] + 1)])
    firsts = np.flatnonzero(start)
    lasts = np.concatenate([firsts[1:] - 1, [len(keep) - 1]])
    return [(f"{n:016x}", wids[entry[w]], int(x), int(y)) for n, w, x, y in zip(names[firsts].tolist(), who[firsts].tolist(), at[firsts].tolist(), at[lasts].tolist(), strict=True)]


def _marks(regions: DataFrame, least: int) -> DataFrame:
    """anchor, region_id: the anchors of each region's two fields."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            content, before = b["content"].fillna("").tolist(), b["content_pre_consistency"].fillna("").tolist()
            texts = content + ["" if x == y else x for x, y in zip(before, content, strict=True)]
            number, _, h = anchors(texts, least)
            ids = b["region_id"].to_numpy()
            yield pd.DataFrame({"anchor": h, "region_id": ids[number % max(len(ids), 1)]}).drop_duplicates()

    return regions.mapInPandas(run, "anchor long, region_id long")


def _surroundings(regions: DataFrame, least: int) -> DataFrame:
    """region_id, field, anchor, start, off, w, wid: the surroundings of each anchor that several regions hold."""
    r = regions.select(F.col("region_id").cast("long").alias("region_id"), F.col("content").cast("string").alias("content"), F.col("content_pre_consistency").cast("string").alias("content_pre_consistency"))
    r = r.filter(f"region_id is not null and (length(content) >= {least} or length(content_pre_consistency) >= {least})")
    marks = cut(_marks(spread(r), least))
    several = marks.groupBy("anchor").agg(F.min("region_id").alias("a"), F.max("region_id").alias("b")).filter("a < b").select("anchor")
    wanted = marks.join(several, "anchor", "left_semi").groupBy("region_id").agg(F.collect_set("anchor").alias("anchors"))
    pad = least - ANCHOR
    shape = ["region_id", "field", "anchor", "start", "off", "w"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for field in FIELDS:
                texts = b[field].fillna("").tolist()
                number, place, h = anchors(texts, least)
                asked = [set(x) for x in b["anchors"]]
                for n, at, x in zip(number.tolist(), place.tolist(), h.tolist(), strict=True):
                    if x in asked[n]:
                        start = max(at - pad, 0)
                        out.append((b["region_id"].iat[n], field, x, start, at - start, texts[n][start : at + least]))
            yield pd.DataFrame(out, columns=shape)

    w = r.join(wanted, "region_id").dropDuplicates(["region_id"]).mapInPandas(run, "region_id long, field string, anchor long, start int, off int, w string")
    return cut(w.withColumn("wid", F.md5(F.col("w").cast("binary"))))


def _grouped(entries: DataFrame, least: int) -> tuple[DataFrame, DataFrame | None]:
    """key, off, wid, w, copies in groups of at most HOT; and the groups of one whole span that are larger, split by `part`, each part with the group's first text."""
    keyed, length, done = entries.withColumnRenamed("anchor", "key"), ANCHOR, None
    while True:
        counts = keyed.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("copies").alias("n")).filter("n > 1")
        hot = cut(counts.filter(f"kinds > {HOT}"))
        if hot.isEmpty():
            return (keyed if done is None else done.unionByName(keyed)), None
        cool = keyed.join(hot.select("key"), "key", "left_anti")
        done = cool if done is None else done.unionByName(cool)
        keyed = keyed.join(hot, "key")
        if length == least:
            home = keyed.groupBy("key").agg(F.min("wid").alias("home"), F.min_by("w", "wid").alias("home_w"), F.min_by("off", "wid").alias("home_off"))
            return done, keyed.withColumn("part", F.pmod(F.xxhash64("wid"), F.ceil(F.col("kinds") / max(HOT, 1)))).join(home, "key")
        more = -(-(least - length) // 2)
        left = F.when(F.col("off") >= more, F.struct(F.xxhash64("key", F.lit("l"), F.expr(f"substring(w, off - {more} + 1, {more})")).alias("key"), (F.col("off") - more).alias("off")))
        right = F.when(F.col("off") + length + more <= F.length("w"), F.struct(F.xxhash64("key", F.lit("r"), F.expr(f"substring(w, off + {length} + 1, {more})")).alias("key"), F.col("off").alias("off")))
        keyed = cut(keyed.select(F.explode(F.array_compact(F.array(left, right))).alias("x"), "wid", "w", "copies").select("x.key", "x.off", "wid", "w", "copies"))
        length += more


def find(regions: DataFrame, least: int = 120) -> DataFrame:
    """cls, region_id, field, start, stop: stretches of both fields whose spans stand in several regions."""
    w = _surroundings(regions, least)
    entries = w.groupBy("anchor", "wid").agg(F.first("w").alias("w"), F.first("off").alias("off"), (1 + (F.min("region_id") < F.max("region_id")).cast("int")).alias("copies"))
    groups, whole = _grouped(entries, least)
    groups = cut(groups)
    total = groups.count()
    shards = max(regions.sparkSession.sparkContext.defaultParallelism, -(-total // PER_SHARD))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = shared_spans(pdf["key"].tolist(), pdf["wid"].tolist(), pdf["w"].tolist(), pdf["copies"].tolist(), least)
        return pd.DataFrame(rows, columns=["cls", "wid", "first", "last"])

    found = groups.groupBy(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")).applyInPandas(search, "cls string, wid string, first int, last int")
    if whole is not None:

        def confirm(pdf: pd.DataFrame) -> pd.DataFrame:
            home = pdf.iloc[0]
            who, at, lo = _hits(index := FMIndex([home["home_w"]]), pdf["w"].tolist(), least)
            right = (index.suffixes[lo] == home["home_off"]) & (at == pdf["off"].to_numpy()[who])
            out = pdf.iloc[who[right]]
            return pd.DataFrame({"cls": "k" + out["key"].astype(str), "wid": out["wid"], "first": out["off"], "last": out["off"]})

        found = found.unionByName(whole.groupBy("key", "part").applyInPandas(confirm, "cls string, wid string, first int, last int"))
    out = found.join(w.select("wid", "region_id", "field", "start").distinct(), "wid")
    out = cut(out.select("cls", "region_id", "field", (F.col("start") + F.col("first")).alias("start"), (F.col("start") + F.col("last") + least).alias("stop")))
    several = out.groupBy("cls").agg(F.min("region_id").alias("a"), F.max("region_id").alias("b")).filter("a < b").select("cls")
    return out.join(several, "cls", "left_semi")


def pairs(regions: DataFrame, least: int = 120) -> DataFrame:
    """region_id_a < region_id_b of regions that share a span of at least `least` characters."""
    members = cut(find(regions, least).select("cls", "region_id").distinct())
    a, b = members.withColumnRenamed("region_id", "region_id_a"), members.withColumnRenamed("region_id", "region_id_b")
    return a.join(b, "cls").filter("region_id_a < region_id_b").select("region_id_a", "region_id_b").distinct()


def intervals(regions: DataFrame, least: int = 120) -> DataFrame:
    """region_id, field, start, stop (from 0, stop excluded) of the stretches of both fields that stand in another region; overlapping stretches are one."""
    order = W.partitionBy("region_id", "field").orderBy("start", "stop")
    s = find(regions, least).select("region_id", "field", "start", "stop").distinct()
    s = s.withColumn("upto", F.coalesce(F.max("stop").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    s = s.withColumn("run", F.sum((F.col("start") > F.col("upto")).cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    return s.groupBy("region_id", "field", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")


def shares(regions: DataFrame, least: int = 120, fields: tuple[str, ...] = ("content",)) -> DataFrame:
    """region_id, field, n_chars, shared_chars, share of each region's `fields` that stands in another region."""
    covered = intervals(regions, least).groupBy("region_id", "field").agg(F.sum(F.col("stop") - F.col("start")).alias("shared_chars"))
    texts = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.length(F.col(f).cast("string")).alias("n")) for f in fields))).alias("x")
    every = regions.select(F.col("region_id").cast("long").alias("region_id"), texts).filter("region_id is not null")
    every = every.select("region_id", "x.field", F.coalesce("x.n", F.lit(0)).alias("n_chars")).groupBy("region_id", "field").agg(F.max("n_chars").alias("n_chars"))
    out = every.join(covered, ["region_id", "field"], "left").withColumn("shared_chars", F.coalesce("shared_chars", F.lit(0)))
    return out.select("region_id", "field", "n_chars", "shared_chars", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(0.0).alias("share"))
