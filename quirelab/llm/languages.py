"""Languages of documents and of mixed segments (problem 3): a linear-chain conditional random field.

Words carry lexicon, affix and n-gram features; learned transitions tie neighbours, and forward-backward
gives each word a probability for each language. Sentences take the language that holds the greater part of
them, with a confidence that grows with their length; a text has the languages of its confident sentences, a
page those of its text regions.

The model is trained here, on the labels as they come: a bounded sample (SAMPLE texts by hash of the id)
gives word counts by label, a Markov chain over them relabels the words (two rounds, which outvotes wrong
labels), and the field is fitted to those words by gradient ascent. Everything else covers every row: one
narrow Python stage over the text, after which only ids and codes are shuffled. Scores of words are
memoised per worker; the forward and backward passes run over all texts of a batch at once.

Defined cases: null and blank texts have no language; texts of names and numbers only have none either; a
label counts as the set of the exact two-letter codes in it, so null, empty, blank, upper-case and
three-letter labels are missing; rows sent twice count once; null ids are left out.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import spread
from .sampling import first_by_hash
from .workers import held

CODES = ("de", "en", "es", "fr", "la")
TEXT_TYPES = ("main_text", "marginal_note", "pasted_slip", "crossed_out")
#: Bound of the training sample, in texts.
SAMPLE = 2500
#: Confidence from which on a sentence gives a text its language. The confidence of a sentence in which x words of
#: the lexicon are expected to be of its language is x / (x + 1): few words are little evidence.
CONFIDENT = 0.79
#: A word must stand in so many training texts to enter the lexicon.
LEAST = 4
_WORD = re.compile(r"[^\W\d_]+|[.!?](?=\s|$)")
_BROKEN = re.compile(r"(?<=[^\W\d_])[-=¬­]+ ?\n\s*(?=[^\W\d_])|\[\?\]|</?u>")
_MARK = "~"


def tokens(text: str) -> list[str]:
    """Words and sentence ends of a text, broken words joined, struck words left out."""
    return _WORD.findall(_BROKEN.sub("", re.sub(r"~~[^~]*~~", " ", text) if "~~" in text else text))


def features(word: str) -> list[str]:
    """Lexicon, affix and n-gram features of a word."""
    w = word.lower()
    padded = f"^{w}$"
    out = ["=" + w, "<" + w[:2], "<" + w[:3], ">" + w[-2:], ">" + w[-3:]]
    if word[:1].islower():
        out += ["#" + padded[i : i + 3] for i in range(len(padded) - 2)]
    else:
        out.append("Aa")
    return out


def forward_backward(x: np.ndarray, lengths: np.ndarray, steps: np.ndarray, moves: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of each position, and expected transitions; x: potentials (positions x codes), steps: transition potentials."""
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    starts = (np.concatenate([[0], np.cumsum(lengths[np.argsort(order, kind="stable")])[:-1]]))[order].astype(np.int64)
    n, k = x.shape
    alpha, beta = np.empty((n, k)), np.ones((n, k))
    longest = int(lengths[0]) if len(lengths) else 0
    live = np.searchsorted(-lengths, -np.arange(longest), "left")
    for t in range(longest):
        at = starts[: live[t]] + t
        a = x[at] if t == 0 else (alpha[at - 1] @ steps) * x[at]
        alpha[at] = a / a.sum(1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        at = starts[: live[t + 1]] + t
        b = (x[at + 1] * beta[at + 1]) @ steps.T
        beta[at] = b / b.sum(1, keepdims=True)
    p = alpha * beta
    p /= p.sum(1, keepdims=True)
    last = np.zeros(n, bool)
    last[starts + lengths - 1] = True
    left = np.flatnonzero(~last)
    if not moves:
        return p, steps
    joint = alpha[left][:, :, None] * steps[None] * (x[left + 1] * beta[left + 1])[:, None, :]
    joint /= joint.sum((1, 2), keepdims=True)
    return p, joint.sum(0)


class Field:
    """Weights of a trained field: feature -> one weight per code, and the transition potentials."""

    def __init__(self, weights: dict[str, np.ndarray], steps: np.ndarray):
        self.weights, self.steps = weights, steps
        self.clear()

    def clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.rows: list[tuple[np.ndarray, bool]] = []

    def number(self, word: str) -> int:
        """Row of a word that isn't memoised yet."""
        get = self.weights.get
        known = get("=" + word.lower())
        total = np.zeros(len(CODES))
        if known is not None or word[:1].islower():
            names = features(word)
        else:  # a name: the affixes alone
            names = ("<" + word[:3].lower(), ">" + word[-3:].lower(), "Aa")
        for f in names:
            w = get(f)
            if w is not None:
                total += w
        self.memo[word] = len(self.rows)
        self.rows.append((total, known is not None))
        return len(self.rows) - 1


def train(rows: list[tuple[str, list[str]]], rounds: int = 15) -> Field:
    """A field from (text, codes of its label)."""
    texts = [[w for w in tokens(t) if w[0].isalpha()] for t, _ in rows]
    labels = [set(l) & set(CODES) for _, l in rows]
    keep = [i for i, t in enumerate(texts) if t]
    texts, labels = [texts[i] for i in keep], [labels[i] for i in keep]
    if not texts:
        return Field({}, np.eye(len(CODES)) + 0.05)
    seen = Counter(w for t in texts for w in {x.lower() for x in t})
    lexicon = {w for w, n in seen.items() if n >= LEAST}
    types: dict[str, int] = {}
    flat = np.array([types.setdefault(w, len(types)) for t in texts for w in t])
    lengths = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)
    words = list(types)
    known = np.array([w.lower() in lexicon for w in words])
    low = {w: i for i, w in enumerate(sorted(lexicon))}
    as_low = np.array([low.get(w.lower(), -1) for w in words])[flat]
    k = len(CODES)
    # Word counts by label; a text with one label speaks for it, wrong ones are outvoted.
    truth = np.zeros((len(flat), k))
    for i, code in enumerate(CODES):
        truth[np.array([l == {code} for l in labels])[owner], i] = 1.0
    stay = np.full((k, k), 0.02 / (k - 1)) + np.eye(k) * (0.98 - 0.02 / (k - 1))
    for _ in range(3):
        counts = np.array([np.bincount(as_low[as_low >= 0], truth[as_low >= 0, i], minlength=len(low)) for i in range(k)]).T + 0.2
        likely = counts / counts.sum(0)
        likely = likely / likely.sum(1, keepdims=True)
        x = np.ones((len(flat), k))
        x[as_low >= 0] = likely[as_low[as_low >= 0]]
        truth, _ = forward_backward(x, lengths, stay)
    gold = truth.argmax(1)
    # Features of word types; rare ones are left out.
    per_type = [features(w) for w in words]
    freq = Counter()
    for fs, n in zip(per_type, np.bincount(flat, minlength=len(words)), strict=True):
        for f in fs:
            freq[f] += int(n)
    ids: dict[str, int] = {}
    for w, fs in zip(words, per_type, strict=True):
        for f in fs:
            if (f[0] != "=" and freq[f] >= 8) or (f[0] == "=" and w.lower() in lexicon):
                ids.setdefault(f, len(ids))
    cols = [[ids[f] for f in fs if f in ids] for fs in per_type]
    sizes = np.array([len(c) for c in cols])
    col = np.array([c for cs in cols for c in cs], np.int64)
    row = np.repeat(np.arange(len(words)), sizes)
    weights, trans = np.zeros((len(ids), k)), np.log(stay)
    square_w, square_t = np.full((len(ids), k), 1e-6), np.full((k, k), 1e-6)
    real = np.zeros((len(flat), k))
    real[np.arange(len(flat)), gold] = 1
    inner = np.ones(len(flat), bool)
    inner[np.cumsum(lengths) - 1] = False
    moves = np.zeros((k, k))
    np.add.at(moves, (gold[:-1][inner[:-1]], gold[1:][inner[:-1]]), 1)
    for _ in range(rounds):
        e = np.array([np.bincount(row, weights[col, i], minlength=len(words)) for i in range(k)]).T
        p, expected = forward_backward(np.exp(np.clip(e, -20, 20))[flat], lengths, np.exp(trans))
        gap = np.array([np.bincount(flat, real[:, i] - p[:, i], minlength=len(words)) for i in range(k)]).T
        grad = np.array([np.bincount(col, gap[row, i], minlength=len(ids)) for i in range(k)]).T - 0.02 * weights
        square_w += grad**2
        weights += 0.6 * grad / np.sqrt(square_w)
        step = moves - expected - 0.5 * (trans - np.log(stay))
        square_t += step**2
        trans += 0.1 * step / np.sqrt(square_t)
    table = {f: weights[i].copy() for f, i in ids.items()}
    return Field(table, np.exp(trans))


def sentences(field: Field, texts: list[str | None]) -> Iterator[list[tuple[int, float, int, int]]]:
    """For each text its sentences with a word of the lexicon, as (code number, confidence, first token, last token)."""
    ids, lengths, ends = [], [], []
    if len(field.rows) > 400_000:
        field.clear()
    get, number = field.memo.get, field.number
    for t in texts:
        own_ends, start = [], len(ids)
        for w in tokens(t) if t else ():
            i = get(w)
            if i is not None:
                ids.append(i)
            elif w in ".!?":
                own_ends.append(len(ids) - start)
            else:
                ids.append(number(w))
        lengths.append(len(ids) - start)
        ends.append([e for e in own_ends if e])
    lengths = np.array(lengths)
    some = lengths > 0
    ids = np.array(ids, np.int64)
    table = np.exp(np.clip(np.array([r[0] for r in field.rows] or np.empty((0, len(CODES)))), -20, 20))
    p = forward_backward(table[ids], lengths[some], field.steps, moves=False)[0] if some.any() else np.empty((0, len(CODES)))
    evidence = np.array([r[1] for r in field.rows], bool)[ids]
    # Pieces between sentence ends; one without enough words of the lexicon ends in an abbreviation.
    so_far = [0, *np.cumsum(evidence).tolist()]
    bounds, per_text, at = [], [], 0
    for n, own_ends in zip(lengths.tolist(), ends, strict=True):
        first, before = at, len(bounds)
        for e in own_ends:
            stop = at + e
            if e < n and so_far[stop] - so_far[first] >= 3:
                bounds.append((first, stop, at))
                first = stop
        if first < at + n:
            bounds.append((first, at + n, at))
        per_text.append((before, len(bounds)))
        at += n
    b = np.array(bounds, np.int64).reshape(-1, 3)
    sums = np.concatenate([np.zeros((1, len(CODES))), np.cumsum(p * evidence[:, None], axis=0)])
    share = sums[b[:, 1]] - sums[b[:, 0]]
    words = np.array(so_far)[b[:, 1]] - np.array(so_far)[b[:, 0]]
    best = share.argmax(1)
    expected = share[np.arange(len(b)), best]
    sure = expected / (expected + 1)
    found = list(zip(best.tolist(), sure.tolist(), (b[:, 0] - b[:, 2]).tolist(), (b[:, 1] - b[:, 2]).tolist(), (words > 0).tolist(), strict=True))
    for first, stop in per_text:
        yield [f[:4] for f in found[first:stop] if f[4]]


def _label(c: Column) -> Column:
    """The exact two-letter codes of a label, as an ordered set."""
    return F.array_sort(F.array_distinct(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.isin(*CODES))))


def sample(regions: DataFrame, size: int = SAMPLE) -> list[tuple[str, list[str]]]:
    """The training texts: the first `size` text regions by hash of their id, each once."""
    r = regions.filter(F.col("region_type").isin(*TEXT_TYPES) & F.col("content").rlike(r"\p{L}") & F.col("region_id").isNotNull())
    r = r.select("region_id", "content", _label(F.col("languages")).alias("label")).filter("size(label) = 1")
    rows = first_by_hash(r, "region_id", size + size // 50).collect()
    return [(x["content"], x["label"]) for x in {x["region_id"]: x for x in rows}.values()][:size]


def detect(regions: DataFrame, model: Field | None = None) -> DataFrame:
    """region_id, page_id, label, langs, confidence of each text region; langs ordered, confidence of the least certain."""
    field = model or train(sample(regions))
    shared = regions.sparkSession.sparkContext.broadcast((field.weights, field.steps))  # bounded by SAMPLE
    key = str(uuid.uuid4())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = held(key, lambda: Field(*shared.value))
        for b in batches:
            langs, sure = [], []
            for s in sentences(own, b["content"].tolist()):
                by = defaultdict(float)
                for code, c, _, _ in s:
                    if c < CONFIDENT:
                        continue
                    by[CODES[code]] = max(by[CODES[code]], c)
                langs.append(sorted(by))
                sure.append(min(by.values()) if by else None)
            yield pd.DataFrame({"region_id": b["region_id"], "page_id": b["page_id"], "label": b["label"], "langs": langs, "confidence": sure})

    r = regions.filter(F.col("region_type").isin(*TEXT_TYPES) & F.col("content").rlike(r"\p{L}") & F.col("region_id").isNotNull())
    r = r.select(F.col("region_id").cast("long").alias("region_id"), F.col("page_id").cast("long").alias("page_id"), F.col("content").cast("string").alias("content"), _label(F.col("languages")).alias("label"))
    out = spread(r).mapInPandas(run, "region_id long, page_id long, label array<string>, langs array<string>, confidence double")
    return out.dropDuplicates(["region_id"])


def segments(regions: DataFrame, model: Field | None = None) -> DataFrame:
    """region_id, segment, lang, confidence, first_word, last_word: runs of sentences in one language, short ones with their low confidence."""
    field = model or train(sample(regions))
    shared = regions.sparkSession.sparkContext.broadcast((field.weights, field.steps))
    key = str(uuid.uuid4())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = held(key, lambda: Field(*shared.value))
        for b in batches:
            rows = []
            for region, s in zip(b["region_id"], sentences(own, b["content"].tolist()), strict=True):
                runs: list[list] = []
                for code, c, first, stop in s:
                    if runs and runs[-1][0] == code:
                        runs[-1][1].append(c)
                        runs[-1][3] = stop
                    else:
                        runs.append([code, [c], first, stop])
                rows += [(region, i, CODES[code], float(np.mean(c)), first, stop - 1) for i, (code, c, first, stop) in enumerate(runs)]
            yield pd.DataFrame(rows, columns=["region_id", "segment", "lang", "confidence", "first_word", "last_word"])

    r = regions.filter(F.col("region_type").isin(*TEXT_TYPES) & F.col("content").rlike(r"\p{L}") & F.col("region_id").isNotNull())
    r = r.select(F.col("region_id").cast("long").alias("region_id"), F.col("content").cast("string").alias("content"))
    return spread(r).mapInPandas(run, "region_id long, segment int, lang string, confidence double, first_word int, last_word int").dropDuplicates(["region_id", "segment"])


def holders(regions: DataFrame, pages: DataFrame) -> DataFrame:
    """holder, record_id, label, langs, confidence of every text region and page; of a page, the least certain language of its regions."""
    from ..session import cut

    found = cut(detect(regions))
    own = found.select(F.lit("region").alias("holder"), F.col("region_id").alias("record_id"), "label", "langs", "confidence")
    each = found.filter("page_id is not null").select("page_id", "confidence", F.explode("langs").alias("lang")).groupBy("page_id", "lang").agg(F.max("confidence").alias("c"))
    by_page = each.groupBy("page_id").agg(F.array_sort(F.collect_list("lang")).alias("langs"), F.min("c").alias("confidence"))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), _label(F.col("page_languages")).alias("label")).filter("page_id is not null").dropDuplicates(["page_id"])
    none = F.array().cast("array<string>")
    return own.unionByName(p.join(by_page, "page_id", "left").select(F.lit("page").alias("holder"), F.col("page_id").alias("record_id"), "label", F.coalesce("langs", none).alias("langs"), "confidence"))


def wrong_labels(regions: DataFrame, pages: DataFrame) -> DataFrame:
    """holder, record_id, lang: the languages of every text region and page whose label is missing or wrong."""
    return holders(regions, pages).filter("label <> langs").select("holder", "record_id", F.explode("langs").alias("lang"))
