"""Consensus of several annotators who disagree (problem 4): a community confusion model.

A reading is explained character by character: each true character is read as some character, dropped, or
one is put in. Annotators belong to types (communities) that share one confusion table; tables, memberships
and the true reading of each item are inferred together by variational updates under Dirichlet priors, so
an annotator with few labels takes over the table of the type it resembles. Annotators who make the same
mistakes on the same items more often than others do are not independent: where they agree, their labels
count as less than two (the excess is measured on the posterior, pair by pair).

Alignments of each reading with each candidate are worked out once, inside a band about as wide as their
distance, and written to the checkpoint folder as counts of events; an update is one pass over them with
partial sums per task. What reaches the driver is counts by annotator
and pair of characters: it grows with annotators and alphabet, not with items.

Defined cases: blanks around readings are removed; null and blank readings are no label, an item without
any is left out; readings and reader lists of different length pair up as far as both go; an unnamed
annotator counts as `?`; ties go to the longer, then the smaller reading; an item sent twice counts once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import cut

#: The region types p4_found asks for.
TYPES = ("entry_heading", "page_number", "calculation")
_SHIFT = 21
_FAR = 1 << 30
#: Items worked on at once, and the longest texts whose alignment is remembered.
PIECE, SHORT = 500, 40


def _costs(a: str, b: str) -> tuple[list[list[int]], int]:
    """Edit costs of all prefixes no further than `t` from the diagonal, and t: at least the distance, so cheapest paths lie within."""
    n, m, t = len(a), len(b), max(8, abs(len(a) - len(b)))
    while True:
        rows = [list(range(min(m, t) + 1))]
        for x in range(1, n + 1):
            above, start, c, left, row = rows[-1], max(0, x - 1 - t), a[x - 1], _FAR, []
            for y in range(max(0, x - t), min(m, x + t) + 1):
                i = y - start
                up = above[i] if i < len(above) else _FAR
                best = (up if up < left else left) + 1
                if y and (across := above[i - 1] + (c != b[y - 1])) < best:
                    best = across
                row.append(best)
                left = best
            rows.append(row)
        if rows[-1][-1] <= t or t >= max(n, m):
            return rows, t
        t *= 2


def _run(a: str, i: int, b: str, j: int) -> int:
    """How many characters are equal from places i and j on."""
    start, step = i, 32
    while a[i : i + step] == b[j : j + step] and i + step <= len(a) and j + step <= len(b):
        i, j = i + step, j + step
    while i < len(a) and j < len(b) and a[i] == b[j]:
        i, j = i + 1, j + 1
    return i - start


def _diagonals(a: str, b: str) -> list[tuple[int, int]]:
    """(true, read) character codes of a cheapest alignment, from the end, by the furthest places reached with 0, 1, 2, ... edits on each diagonal.

    Time grows with the length and the square of the distance: long readings mostly differ in little."""
    n, m = len(a), len(b)
    reached = [{0: _run(a, 0, b, 0)}]
    while reached[-1].get(m - n, -1) < n:
        last, row = reached[-1], {}
        for k in range(-len(reached), len(reached) + 1):  # k: place in b less place in a
            i = max(last.get(k, -2) + 1, last.get(k + 1, -2) + 1, last.get(k - 1, -1))
            i = min(i, n, m - k)
            if i >= 0 and i + k >= 0:
                row[k] = i + _run(a, i, b, i + k)
        reached.append(row)
    out: list[tuple[int, int]] = []
    i, k = n, m - n
    for d in range(len(reached) - 1, 0, -1):
        last = reached[d - 1]
        change, gone, more = last.get(k, -2) + 1, last.get(k + 1, -2) + 1, last.get(k - 1, -1)
        at = min(max(change, gone, more), n, m - k)
        out += [(ord(c), ord(c)) for c in reversed(a[at:i])]
        if change >= at and at >= 1 and at + k >= 1:
            i = at - 1
            out.append((ord(a[i]), ord(b[i + k])))
        elif gone >= at and at >= 1:
            i, k = at - 1, k + 1
            out.append((ord(a[i]), 0))
        else:
            i, k = at, k - 1
            out.append((0, ord(b[i + k])))
    return out + [(ord(c), ord(c)) for c in reversed(a[:i])]


def events(truth: str, reading: str) -> tuple[int, ...]:
    """Pairs (true character, read character) of the cheapest alignment; 0 stands for nothing.

    A gap between characters where nothing was put in is the pair (0, 0)."""
    n, m = len(truth), len(reading)
    if max(n, m) > SHORT:
        pairs = [(t << _SHIFT) | r for t, r in _diagonals(truth, reading)]
        return (*pairs, *[0] * max(0, n + 1 - sum(e < 1 << _SHIFT for e in pairs)))
    i = 0
    while i < min(n, m) and truth[i] == reading[i]:
        i += 1
    j = 0
    while j < min(n, m) - i and truth[n - 1 - j] == reading[m - 1 - j]:
        j += 1
    out = [(ord(c) << _SHIFT) | ord(c) for c in truth[:i] + truth[n - j :]]
    a, b = truth[i : n - j], reading[i : m - j]
    rows, t = _costs(a, b)

    def cost(x: int, y: int) -> int:
        k = y - max(0, x - t)
        return rows[x][k] if 0 <= k < len(rows[x]) else _FAR

    x, y = len(a), len(b)
    while x or y:
        if x and y and cost(x, y) == cost(x - 1, y - 1) + (a[x - 1] != b[y - 1]):
            x, y = x - 1, y - 1
            out.append((ord(a[x]) << _SHIFT) | ord(b[y]))
        elif x and cost(x, y) == cost(x - 1, y) + 1:
            x -= 1
            out.append(ord(a[x]) << _SHIFT)
        else:
            y -= 1
            out.append(ord(b[y]))
    put_in = sum(e < 1 << _SHIFT for e in out)
    return (*out, *[0] * max(0, n + 1 - put_in))


def _counted(truth: str, reading: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """The different events of the alignment and how often each occurs."""
    found = Counter(events(truth, reading))
    return tuple(found), tuple(found.values())


@lru_cache(200_000)
def _short(truth: str, reading: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
    return _counted(truth, reading)


def _turned(counted: tuple[tuple[int, ...], tuple[int, ...]], n: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """The counts with truth (n characters) and reading exchanged."""
    low = (1 << _SHIFT) - 1
    found = {((e & low) << _SHIFT) | (e >> _SHIFT): x for e, x in zip(*counted, strict=True) if e}
    if free := max(0, n + 1 - sum(x for e, x in found.items() if e < 1 << _SHIFT)):
        found[0] = free
    return tuple(found), tuple(found.values())


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for k in range(0, len(b), PIECE):
            yield b.iloc[k : k + PIECE]


def _digamma(x: np.ndarray) -> np.ndarray:
    shift = np.zeros_like(x)
    while (x < 6).any():
        shift = np.where(x < 6, shift - 1 / x, shift)
        x = np.where(x < 6, x + 1, x)
    y = 1 / (x * x)
    return shift + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y / 252))


class Communities:
    """Variational posterior of memberships and confusion tables, from counts by annotator and event."""

    def __init__(self, counts: dict[tuple[str, int], float], k: int, strength: float = 2.0, match: float = 20.0):
        self.readers = sorted({r for r, _ in counts})
        self.events = np.array(sorted({e for _, e in counts}), np.int64)
        self.k, self.strength, self.match = min(k, max(1, len(self.readers))), strength, match
        self.true = self.events >> _SHIFT
        self.right = self.true == (self.events & ((1 << _SHIFT) - 1))
        self.set_counts(counts)
        wrong = np.where(self.right, 0, self.n)
        profile = wrong / np.maximum(self.n.sum(1, keepdims=True), 1)
        seeds = [int(np.argmax(profile.sum(1)))]
        while len(seeds) < self.k:
            seeds.append(int(np.argmax(np.min([np.abs(profile - profile[s]).sum(1) for s in seeds], axis=0))))
        near = np.array([np.abs(profile - profile[s]).sum(1) for s in seeds]).T
        self.q = np.exp(-200 * near) + 1e-9
        self.q /= self.q.sum(1, keepdims=True)

    def set_counts(self, counts: dict[tuple[str, int], float]) -> None:
        rows, cols = {r: i for i, r in enumerate(self.readers)}, {e: i for i, e in enumerate(self.events.tolist())}
        self.n = np.zeros((len(self.readers), len(self.events)))
        for (r, e), x in counts.items():
            self.n[rows[r], cols[e]] += x

    def update(self) -> None:
        """A few rounds of tables given memberships and memberships given tables."""
        _, group = np.unique(self.true, return_inverse=True)
        everyone = self.n.sum(0)
        base = everyone + np.where(self.right, self.match, 0.05)
        base = base / np.bincount(group, base)[group]  # shared shape of the prior
        for _ in range(10):
            alpha = self.q.T @ self.n + self.strength * base + 1e-3
            total = np.array([np.bincount(group, a)[group] for a in alpha])
            self.log = _digamma(alpha) - _digamma(total)
            weight = self.q.sum(0) + 1.0 / self.k
            fit = self.n @ self.log.T + _digamma(weight) - _digamma(np.array([weight.sum()]))
            fit -= fit.max(1, keepdims=True)
            self.q = np.exp(fit)
            self.q /= self.q.sum(1, keepdims=True)

    def scores(self) -> dict[str, np.ndarray]:
        """Expected log-probability of each event by annotator."""
        return {r: self.q[i] @ self.log for i, r in enumerate(self.readers)}

    def spelling(self) -> dict[int, float]:
        """Log-probability of each true character: a longer reading explains more and is less likely before any label."""
        true = self.n.sum(0) * (self.true > 0)
        codes, at = np.unique(self.true, return_inverse=True)
        sums = np.bincount(at, true) + 0.5
        return dict(zip(codes.tolist(), np.log(sums / sums.sum()).tolist(), strict=True))

    def reliability(self) -> list[tuple[str, float, float, int, float]]:
        """(annotator, share of characters read right, smoothed by the type's table, type, its probability)."""
        out = []
        for i, r in enumerate(self.readers):
            own, p, good = self.n[i], self.q[i], self.right & (self.true > 0)
            shared = p @ np.exp(self.log)
            seen = self.n.sum(0)
            typed = float((seen * shared)[good].sum() / max(seen[self.true > 0].sum(), 1e-9))
            total = own[self.true > 0].sum()
            smooth = (own[good].sum() + self.match * typed) / (total + self.match)
            out.append((r, float(own[good].sum() / max(total, 1e-9)), float(min(smooth, 1.0)), int(p.argmax()), float(p.max())))
        return out


def _labels(regions: DataFrame, types: tuple[str, ...] | None) -> DataFrame:
    """region_id, names, readings of items with at least one label; of all region types where `types` is None."""
    r = regions.filter(F.col("region_id").isNotNull() & (F.size("ensemble_readings") > 0))
    if types is not None:
        r = r.filter(F.col("region_type").isin(*types))
    r = r.select(F.col("region_id").cast("long").alias("region_id"), "ensemble_readings", "reader_ids").dropDuplicates(["region_id"])
    zipped = F.transform(F.col("ensemble_readings"), lambda x, i: F.struct(F.coalesce(F.get("reader_ids", i), F.lit("?")).alias("name"), F.regexp_replace(x, r"(?U)^\s+|\s+$", "").alias("reading")))
    r = r.select("region_id", F.filter(zipped, lambda x: x["reading"] != "").alias("z")).filter("size(z) > 0")
    return r.select("region_id", F.col("z.name").alias("names"), F.col("z.reading").alias("readings"))


def _aligned(labels: DataFrame) -> DataFrame:
    """Per item: candidates, and for each event the candidate and the label it belongs to and its count, flattened."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _pieces(batches):
            rows = []
            for names, readings in zip(b["names"], b["readings"], strict=True):
                candidates = sorted(set(readings), key=lambda x: (-list(readings).count(x), -len(x), x))
                place = {c: i for i, c in enumerate(candidates)}
                cand, who, what, times = [], [], [], []
                # each two different readings are aligned once
                pairs = {}
                for c, truth in enumerate(candidates):
                    for k in range(c + 1):
                        if max(len(truth), len(candidates[k])) <= SHORT:
                            pairs[c, k], pairs[k, c] = _short(truth, candidates[k]), _short(candidates[k], truth)
                        else:
                            pairs[c, k] = _counted(truth, candidates[k])
                            pairs[k, c] = pairs[c, k] if k == c else _turned(pairs[c, k], len(candidates[k]))
                for c in range(len(candidates)):
                    for i, reading in enumerate(readings):
                        e, n = pairs[c, place[reading]]
                        cand += [c] * len(e)
                        who += [i] * len(e)
                        what += e
                        times += n
                rows.append((candidates, [list(readings).count(c) for c in candidates], [place[x] for x in readings], cand, who, what, times))
            out = pd.DataFrame(rows, columns=["candidates", "votes", "chose", "cand", "who", "what", "times"])
            out.insert(0, "region_id", b["region_id"].to_numpy())
            out.insert(1, "names", b["names"].to_list())
            yield out

    return labels.mapInPandas(run, "region_id long, names array<string>, candidates array<string>, votes array<int>, chose array<int>, cand array<int>, who array<int>, what array<long>, times array<int>")


def _weights(b: pd.DataFrame, twins: dict[str, dict[str, float]]) -> list[float]:
    """Weight of each label: less than 1 where dependent annotators agree."""
    out = []
    for names, chose in zip(b["names"], b["chose"], strict=True):
        for i, n in enumerate(names):
            near = twins.get(n)
            out.append(1.0 / (1.0 + sum(near.get(m, 0.0) for j, m in enumerate(names) if j != i and chose[j] == chose[i])) if near else 1.0)
    return out


def _dependence(aligned: DataFrame, state: dict) -> dict[str, dict[str, float]]:
    """For pairs of annotators, how much more often than usual two wrong labels are the same one (0 to 1)."""
    shared = aligned.sparkSession.sparkContext.broadcast(state)  # annotators x pairs of characters

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _pieces(batches):
            *_, first, p = _posterior(b, shared.value)
            seen: dict[tuple[str, str], list[int]] = {}
            for i, (names, chose) in enumerate(zip(b["names"], b["chose"], strict=True)):
                best = int(p[first[i] : first[i + 1]].argmax())
                wrong = [(n, c) for n, c in zip(names, chose, strict=True) if c != best]
                for x, (n, c) in enumerate(wrong):
                    for m, e in wrong[x + 1 :]:
                        if n != m:
                            cell = seen.setdefault((min(n, m), max(n, m)), [0, 0])
                            cell[0] += 1
                            cell[1] += c == e
            yield pd.DataFrame([(*k, *v) for k, v in seen.items()], columns=["a", "b", "both", "same"])

    rows = aligned.mapInPandas(run, "a string, b string, both long, same long").groupBy("a", "b").agg(F.sum("both").alias("both"), F.sum("same").alias("same")).collect()
    rates = [(r["same"] + 2) / (r["both"] + 6) for r in rows]
    usual = float(np.median(rates)) if rates else 0.0
    out: dict[str, dict[str, float]] = {}
    for r, rate in zip(rows, rates, strict=True):
        if (rho := (rate - usual) / max(1 - usual, 1e-9)) > 0.25 and r["both"] >= 10:
            out.setdefault(r["a"], {})[r["b"]] = rho
            out.setdefault(r["b"], {})[r["a"]] = rho
    return out


def _posterior(b: pd.DataFrame, model: dict | None):
    """Annotator, event, count and candidate of each entry, and the probability of each candidate of each item."""
    sizes = b["candidates"].str.len().to_numpy()
    first = np.concatenate([[0], np.cumsum(sizes)])
    n_events = b["what"].str.len().to_numpy()
    item = np.repeat(np.arange(len(b)), n_events)
    slot = first[item] + np.concatenate([*b["cand"], np.empty(0, np.int32)]).astype(np.int64)
    what = np.concatenate([*b["what"], np.empty(0, np.int64)]).astype(np.int64)
    times = np.concatenate([*b["times"], np.empty(0, np.int32)]).astype(np.int64)
    names = sorted({n for x in b["names"] for n in x})
    code = {n: i for i, n in enumerate(names)}
    start = np.concatenate([[0], np.cumsum(b["names"].str.len().to_numpy())])
    label = start[item] + np.concatenate([*b["who"], np.empty(0, np.int32)]).astype(np.int64)
    reader = np.array([code[n] for x in b["names"] for n in x] or [0])[label]
    owner = np.repeat(np.arange(len(b)), sizes)
    if model is None:
        score = 2.0 * np.concatenate([*b["votes"], np.empty(0)]).astype(float)
    else:
        at = np.minimum(np.searchsorted(model["events"], what), len(model["events"]) - 1)
        known = model["events"][at] == what
        table = np.array([model["scores"].get(n, model["mean"]) for n in names]) if names else np.empty((0, len(model["events"])))
        weight = np.array(_weights(b, model["twins"]))[label] if len(label) else np.empty(0)
        rare = model["rare"]
        prior = np.array([sum(model["prior"].get(ord(x), rare) for x in c) for cs in b["candidates"] for c in cs])
        score = prior + np.bincount(slot, weight * times * np.where(known, table[reader, at], -8.0), minlength=first[-1])
    top = np.full(len(b), -np.inf)
    np.maximum.at(top, owner, score)
    p = np.exp(score - top[owner])
    p /= np.bincount(owner, p, minlength=len(b))[owner]
    return names, reader, what, times, slot, owner, first, p


def fit(aligned: DataFrame, communities: int = 8, rounds: int = 6) -> Communities:
    """The model after `rounds` passes over all items; the first is weighted by votes."""
    counts_of = lambda rows: {(r["name"], r["event"]): r["x"] for r in rows}
    model, state, twins = None, None, {}
    for turn in range(rounds):
        shared = aligned.sparkSession.sparkContext.broadcast(state)  # annotators x pairs of characters

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for b in _pieces(batches):
                names, reader, what, times, slot, _, _, p = _posterior(b, shared.value)
                if len(what):
                    out = pd.DataFrame({"name": reader, "event": what, "x": p[slot] * times}).groupby(["name", "event"], as_index=False)["x"].sum()
                    yield out.assign(name=np.array(names, object)[out["name"].to_numpy()])

        counts = counts_of(aligned.mapInPandas(run, "name string, event long, x double").groupBy("name", "event").agg(F.sum("x").alias("x")).collect())
        if not counts:
            return Communities({("?", 0): 0.0}, 1)
        if model is None or set(e for _, e in counts) - set(model.events.tolist()):
            model = Communities(counts, communities)
        else:
            model.set_counts(counts)
        model.update()
        s = model.scores()
        state = {"events": model.events, "scores": s, "mean": np.mean(list(s.values()), axis=0), "twins": twins, "prior": model.spelling()}
        state["rare"] = min(state["prior"].values())
        if turn in (1, rounds - 2):
            state["twins"] = twins = _dependence(aligned, state)
    model.state = state
    return model


def consensus(regions: DataFrame, communities: int = 8, rounds: int = 6, types: tuple[str, ...] | None = TYPES) -> tuple[DataFrame, Communities]:
    """region_id, reading, confidence, agreement (share of label pairs that agree; null for one label), readings (labels), kinds (different labels).

    Items are the regions of `types`; None means all."""
    aligned = cut(_aligned(_labels(regions, types)))
    model = fit(aligned, communities, rounds)
    shared = regions.sparkSession.sparkContext.broadcast(getattr(model, "state", None))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _pieces(batches):
            *_, owner, first, p = _posterior(b, shared.value)
            rows = []
            for i, (c, v) in enumerate(zip(b["candidates"], b["votes"], strict=True)):
                own = p[first[i] : first[i + 1]]
                best = int(own.argmax())  # candidates stand by votes, length, spelling: ties go to the first
                n = int(sum(v))
                rows.append((c[best], float(own[best]), float(sum(x * (x - 1) for x in v)) / (n * (n - 1)) if n > 1 else None, n, len(c)))
            out = pd.DataFrame(rows, columns=["reading", "confidence", "agreement", "readings", "kinds"])
            out.insert(0, "region_id", b["region_id"].to_numpy())
            yield out

    return aligned.mapInPandas(run, "region_id long, reading string, confidence double, agreement double, readings int, kinds int"), model


def reader_reliability(regions: DataFrame, communities: int = 8, rounds: int = 6, types: tuple[str, ...] | None = None) -> DataFrame:
    """reader_id, accuracy (characters), reliability (smoothed by its type), community, membership; from all labels unless `types` are named."""
    spark = regions.sparkSession
    model = fit(cut(_aligned(_labels(regions, types))), communities, rounds)
    rows = model.reliability() if hasattr(model, "state") else []
    return spark.createDataFrame(rows, "reader_id string, accuracy double, reliability double, community int, membership double")
