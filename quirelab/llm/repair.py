"""Repair of text from scanned pages (problem 6): averaged-perceptron editing of characters and lines.

Two averaged perceptrons are trained here, on the data itself:
* the editor tags every character with keep, replace by a character, or delete, every gap after a character with
  keep or insert, and a hyphen-like mark at a line end with keep or join (the line goes on in the next one). Its
  features are the characters around, the case of the word, and whether the word, or the word after an operation,
  is in the lexicon. Operations that belong together (`rn` for m is replace and delete) are rated together; what
  beats keeping is done, again and again until nothing does. Words of the lexicon and words unknown to it go the
  same way: the lexicon is a feature among others. It learns from words with the confusions that rare words of a
  bounded sample show against the lexicon, put into known and unknown words, and from words left as they are;
* the furniture classifier tells running headers and page numbers from text, for every line that is not blank, by
  the line's place in the field, the field's place on the page (region_index, height of the box), the folio label
  and page number, shape, first word, and likeness to the journal's title. It learns from regions typed as page
  numbers, headings and calculations and from lines that hold the title's names; a part of those is shown without
  the likeness, so that place and shape must do.

The lexicon of ordinary words comes from word counts over all text: a word must make up LEXICON of all words
and stand in many journals, which leaves out names, misreadings and halves of broken words but keeps older
spellings. It and the models are small (words by share, weights by sample size) and are sent to the tasks;
every text is then edited in one narrow stage. Decisions on words and on shapes of lines are memoised per worker.

Defined cases: null and blank texts have no lines; a mark on the last line of running text is no break; an
elliptic hyphen (`Nord- und`) is none; header and page-number lines have no other flaw; a record sent twice
counts once; null ids are left out; unknown journals have an empty title; missing places on the page are unknown.
"""

from __future__ import annotations

import random
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import spread
from .sampling import bounded, first_by_hash
from .workers import held

TEXT_TYPES = ("main_text", "marginal_note", "pasted_slip", "crossed_out")
#: Bound of the training sample, in regions.
SAMPLE = 12000
#: Bound of the misread words the editor is trained on.
PAIRS = 6000
#: A rarer word one replacement away from a word of the lexicon is an older spelling, not a misreading, from
#: this share of the other's count (and count) on.
SPELLING, SPELLING_COUNT = 0.03, 12
#: Least share of all words, and least number of (hashed) journals, of a word of the lexicon.
LEXICON, JOURNALS = 4e-5, 8
#: How often a shape of line is shown to the furniture classifier in training at most.
REPEATS = 6
#: Titles the tasks are sent at most.
JOURNALS_MOST = 500_000
#: Share of the header examples that are shown again without their likeness to the title.
HIDDEN = 0.4
_MARK_SET = frozenset("-=¬⸗­")
MARKS = "-=¬⸗­"
_WORD = re.compile(r"[^\W_]+")
_NAME = re.compile(r"[^\W\d_]{4,}")
_MARKED = re.compile(rf"[^\W\d_]([{MARKS}]) *$")


class Perceptron:
    """Averaged multi-class perceptron over named features; an example may be open to some classes only."""

    def __init__(self, classes: list[str]):
        self.classes, self.w, self.rows = classes, {}, None

    def fit(self, rows: list[tuple], epochs: int = 4, seed: int = 3) -> Perceptron:
        """Rows are (features, class) or (features, class, open classes)."""
        w: dict[str, dict[str, float]] = {c: {} for c in self.classes}
        summed: dict[str, dict[str, float]] = {c: {} for c in self.classes}  # weights times the steps they did not hold
        order, t = list(range(len(rows))), 0
        shuffle = random.Random(seed).shuffle
        for _ in range(epochs):
            shuffle(order)
            for i in order:
                fs, gold, *rest = rows[i]
                t += 1
                guess, top = None, None
                for c in rest[0] if rest else self.classes:
                    of = w[c]
                    score = sum([of[f] for f in fs if f in of])
                    if top is None or (score, c) > top:
                        guess, top = c, (score, c)
                if guess != gold:
                    for c, by in ((gold, 1.0), (guess, -1.0)):
                        of, late = w[c], summed[c]
                        for f in fs:
                            of[f] = of.get(f, 0.0) + by
                            late[f] = late.get(f, 0.0) + by * (t - 1)
        self.w, self.rows = {}, None
        for c, of in w.items():
            averages = {f: x - summed[c][f] / max(t, 1) for f, x in of.items()}
            if kept := {f: x for f, x in averages.items() if abs(x) > 1e-3}:
                self.w[c] = kept
        return self

    def score(self, fs: list[str], c: str) -> float:
        w = self.w.get(c)
        return sum([w[f] for f in fs if f in w]) if w else 0.0

    def best(self, fs: list[str]) -> str:
        """The class of the highest score; of equal ones the last by name."""
        if self.rows is None:
            self.rows = {f: tuple(self.w.get(c, {}).get(f, 0.0) for c in self.classes) for f in {f for w in self.w.values() for f in w}}
        rows = self.rows
        found = [rows[f] for f in fs if f in rows]
        totals = map(sum, zip(*found, strict=True)) if found else [0.0] * len(self.classes)
        return max(zip(totals, self.classes, strict=True))[1]


def difference(clean: str, seen: str) -> tuple[int, str, str]:
    """(place, clean part, seen part) between the common head and tail."""
    i = 0
    while i < min(len(clean), len(seen)) and clean[i] == seen[i]:
        i += 1
    k = 0
    while k < min(len(clean), len(seen)) - i and clean[-1 - k] == seen[-1 - k]:
        k += 1
    return i, clean[i : len(clean) - k], seen[i : len(seen) - k]


class Neighbours:
    """Lexicon words that one replacement (one or two characters by one or two) turns into a given word."""

    def __init__(self, lexicon):
        self.words, self.holes = frozenset(lexicon), defaultdict(list)
        for w in lexicon:
            if len(w) >= 3:
                for n in (1, 2):
                    for i in range(len(w) - n + 1):
                        self.holes[w[:i] + "\0" + w[i + n :]].append((w, n))

    def of(self, seen: str) -> set[str]:
        out, holes = set(), self.holes
        for n in (1, 2):
            for i in range(len(seen) - n + 1):
                hit = holes.get(seen[:i] + "\0" + seen[i + n :])
                if hit:
                    out.update(w for w, m in hit if not (n == m == 2) and w != seen)
        return out


KEEP, DELETE, JOIN = "K", "D", "J"


def context(w: str, i: int, gap: bool, known: bool, case: str, digits: int) -> list[str]:
    """Features of a character of a word, or of the gap after it."""
    p = f"^^{w}$$"
    j = i + 2
    if gap:
        return ["g", "gl" + p[j], "gr" + p[j + 1], "gm" + p[j : j + 2], "gw" + p[j - 1 : j + 3], f"g {known}", "g" + case]
    c = p[j]
    return ["b" + c, "l" + p[j - 1] + c, "r" + c + p[j + 1], "m" + p[j - 1 : j + 2], "L" + p[j - 2 : j + 1], "R" + p[j : j + 3], "w" + p[j - 2 : j + 3], f"{c} {known}", c + case, f"{c} digits {digits} of {len(w) if len(w) < 5 else 5}"]


def operations(good: str, bad: str) -> list[tuple[int, bool, str]]:
    """(place from the start of `bad`, whether in the gap after it, operation) that together turn `bad` into `good`."""
    n = min(len(good), len(bad))
    out = [(k, False, "R" + good[k]) for k in range(n) if good[k] != bad[k]]
    out += [(k, False, DELETE) for k in range(n, len(bad))]
    return out + [(len(bad) - 1, True, "I" + c) for c in good[n:]]


def case_of(word: str) -> str:
    return "a" if word[:1].islower() else "A" if word[1:].upper() == word[1:] and len(word) > 1 else "Aa" if word[:1].isupper() else "1"


def digits_of(w: str) -> int:
    return 0 if w.isalpha() else min(sum(map(str.isdigit, w)), 3)


class Changes:
    """The known confusions (what stands on the page, what was read), and where they could apply in a word."""

    def __init__(self, confusions):
        self.by_first: dict[str, list[tuple[str, str, list]]] = defaultdict(list)
        for good, bad in sorted(confusions):
            self.by_first[bad[0]].append((good, bad, operations(good, bad)))

    def of(self, w: str) -> list[tuple[int, str, list]]:
        """(place, word after the change, operations) of every change that fits."""
        out = []
        for i, c in enumerate(w):
            for good, bad, ops in self.by_first.get(c, ()):
                if len(bad) == 1 or w.startswith(bad, i):
                    out.append((i, w[:i] + good + w[i + len(bad) :], ops))
        return out

    def positions(self, w: str, lexicon, case: str, known: bool | None = None) -> dict[tuple[int, bool], tuple[list[str], list[str]]]:
        """Features and open operations of every place of a word that a change could touch."""
        known, out = w in lexicon if known is None else known, {}
        digits = digits_of(w)
        for i, clean, ops in self.of(w):
            right = clean in lexicon
            for k, gap, op in ops:
                at = (i + k, gap)
                if at not in out:
                    out[at] = (context(w, i + k, gap, known, case, digits), [])
                fs, open_ = out[at]
                if op not in open_:
                    open_.append(op)
                if right:
                    fs.append("word " + op)
        return out


class Editor:
    """All models, and the lexicon, as the tasks need them."""

    def __init__(self, lexicon: frozenset[str], characters: Perceptron, furniture: Perceptron, titles: dict[str, str], confusions: frozenset[tuple[str, str]] = frozenset()):
        self.confusions, self.lexicon, self.characters, self.furniture = confusions, lexicon, characters, furniture
        self.changes, self.titles, self.memo, self.names, self.shapes, self.cells = Changes(confusions), titles, {}, {}, {}, {}
        # by first letter: each change and the most the lexicon could add to it
        self.open: dict[str, list] = {}
        self.pair = {}
        reach = {c: {op for _, _, ops in row for _, _, op in ops} for c, row in self.changes.by_first.items()}
        anything = set().union(*reach.values())
        for c, row in self.changes.by_first.items():
            for good, bad, ops in row:
                most = sum(max(0.0, self.bonus(op, "word " + o)) for k, gap, op in ops for o in (reach[c] if k == 0 and not gap else anything))
                self.open.setdefault(c, []).append((good, bad, ops, most))
                self.pair[id(ops)] = (good, bad)
        self.kinds: dict[str, tuple[int, str, str | None]] = {}
        self.short: dict[str, tuple] = {}
        self.alike: dict[tuple[str, ...], dict[str, int]] = {}

    def edit(self, word: str) -> tuple[int, str] | None:
        """(place of the first change, repaired word in lower case) of a misread word, else None."""
        if word in self.memo:
            return self.memo[word]
        w, first, case = word.lower(), None, case_of(word)
        if len(w) >= 3 and not w.isnumeric():  # fractions count as digits
            for _ in range(len(w)):  # a word has at most so many characters to repair
                best = self.best_change(w, case)
                if best is None:
                    break
                first = best[2] if first is None else min(first, best[2])
                w = best[1]
        if len(self.memo) > 400_000:
            self.memo.clear()
        out = None if first is None or w == word.lower() else (first, w)
        self.memo[word] = out
        return out

    def best_change(self, w: str, case: str) -> tuple[float, str, int] | None:
        """(preference over keeping, word after it, place) of the change the editor prefers most, if it prefers any.

        What a place says apart from the lexicon depends on the five characters around it; that is remembered."""
        lexicon, cells, score = self.lexicon, self.cells, self.characters.score
        digits, known, p = digits_of(w), w in self.lexicon, f"^^{w}$$"
        says = f"{known}{case}{digits}{len(w) if len(w) < 5 else 5}"
        if len(cells) > 400_000:
            cells.clear()
        rated: dict[tuple[int, str, str], float] = {}
        hope = False
        for i, c in enumerate(w):
            for good, bad, ops, most in self.open.get(c, ()):
                if len(bad) > 1 and not w.startswith(bad, i):
                    continue
                total = 0.0
                for k, gap, op in ops:
                    j = i + k
                    key = says + p[j : j + 5] + ("+" + op if gap else op)
                    margin = cells.get(key)
                    if margin is None:
                        fs = context(w, j, gap, known, case, digits)
                        margin = cells[key] = score(fs, op) - score(fs, KEEP)
                    total += margin
                rated[i, good, bad] = total
                hope = hope or total + most > 0
        if not hope:  # not even with all the lexicon could say
            return None
        found, right, best = self.changes.of(w), {}, None
        for i, clean, ops in found:
            if clean in lexicon:
                for k, gap, op in ops:
                    right.setdefault((i + k, gap), []).append("word " + op)
        for i, clean, ops in found:
            total = rated[i, *self.pair[id(ops)]]
            if right:
                for k, gap, op in ops:
                    for f in right.get((i + k, gap), ()):
                        total += self.bonus(op, f)
            if total > 0 and (best is None or (total, clean) > best[:2]):
                best = (total, clean, i)
        return best

    def bonus(self, op: str, f: str) -> float:
        w = self.characters.w
        return w.get(op, {}).get(f, 0.0) - w.get(KEEP, {}).get(f, 0.0)

    def alike_to(self, names: list[str]) -> dict[str, int]:
        """What is known of words against the names of a title."""
        alike = self.alike.setdefault(tuple(names), {})
        if len(alike) > 100_000:
            alike.clear()
        return alike

    def joins(self, part: str, mark: str, following: str) -> bool:
        """Whether the word before a mark at the line end goes on in the next line."""
        fs = join_features(self.lexicon, part, mark, following)
        return self.characters.score(fs, JOIN) > self.characters.score(fs, KEEP)

    def title_names(self, journal: str | None) -> list[str]:
        if journal not in self.names:
            self.names[journal] = [x.lower() for x in _NAME.findall(self.titles.get(journal) or "") if x[0].isupper()][1:]
        return self.names[journal]


def likeness(line: str, names: list[str]) -> int:
    """How many of the title's names the line has, near misses included."""
    low = line.lower()
    found = sum(n in low for n in names)
    if found < len(names) and len(low) < 90:
        words = _NAME.findall(low)
        for n in names:
            if n not in low and any(abs(len(w) - len(n)) <= 2 and w[0] == n[0] and _close(w, n) for w in words):
                found += 1
    return found


def which_name(word: str, names: list[str]) -> int:
    """Place of the title's name that a word is, or nearly is; -1 for none."""
    return next((i for i, n in enumerate(names) if n in word or abs(len(word) - len(n)) <= 2 and word[0] == n[0] and _close(word, n)), -1)


def _close(a: str, b: str) -> bool:
    """At most two letters apart once sorted, and alike in their pairs."""
    x, y = Counter(a), Counter(b)
    return sum(((x - y) + (y - x)).values()) <= 2 and len({a[i : i + 2] for i in range(len(a) - 1)} & {b[i : b and i + 2] for i in range(len(b) - 1)}) * 2 >= len(b) - 2


#: A field whose place on the page is unknown: (holder, index of the region on the page, top of its box in thousandths, page number, folio label).
NOWHERE = ("region", None, None, None, None)
_LETTERS, _DIGITS, _SIGNS, _PAGE = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"[\w\s]"), re.compile(r"(?i)(?:fol|f|p|pag|s|bl)[rv]?")


def line_shape(e: Editor, line: str, k: int, n: int, before: str, after: str, names: list[str], place: tuple = NOWHERE, hide: bool = False, alike: dict[str, int] | None = None) -> tuple:
    """What the classifier sees of a line: its shape, its place in the field and on the page, and its likeness to the title (unless hidden)."""
    s = line.strip()
    words = s.replace("–", " ").replace("—", " ").split() or [s]
    many, lexicon = len(words), e.lexicon
    known = named = 0
    lead = None
    kinds, matched = e.kinds, 0
    if alike is None and names and not hide:
        alike = e.alike_to(names)
    for w in words:
        kind = kinds.get(w)
        if kind is None:
            if len(kinds) > 400_000:
                kinds.clear()
            x = w.strip(",.;:()[]—–-").lower()
            capital = x if w[0].isupper() and x else None
            kind = kinds[w] = (1, x, capital) if x in lexicon else (2 if capital else 0, "-", capital)
        if lead is None:
            lead = kind[1]
        if kind[0] == 1:
            known += 1
        elif kind[0]:
            named += 1
        if alike is not None and (x := kind[2]) is not None:
            at = alike.get(x)
            if at is None:
                at = alike[x] = which_name(x, names)
            if at >= 0:
                matched |= 1 << at
    found = matched.bit_count()
    part = "all" if names and found == len(names) else "some" if found else "none"
    end = s[-1]
    common = (
        part, "first" if k == 0 else "last" if k == n - 1 else "inner", many if many < 10 else 9 if many < 13 else 13, min(known, 4), min(named, 3), len(s) > 6 and s.isupper(),
        not before or before.rstrip()[-1:] in ".!?", "low" if after[:1].islower() else "up" if after else "none", "a" if end.isalpha() else "9" if end.isdigit() else end,
    )
    holder, index, top, number, folio = place
    # the place of the field tells of its first and last line
    where = (holder, -1, -1) if 0 < k < n - 1 else (holder, -1 if index is None else min(int(index), 3), -1 if top is None else int(top) // 125)
    if many > 12:
        return common
    if many > 4:
        return (*common, lead, where)
    made = e.short.get(s)
    if made is None:
        if len(e.short) > 200_000:
            e.short.clear()
        letters = "".join(_LETTERS.findall(s))
        numbers = _DIGITS.findall(s)
        kind = "none" if not letters else "rv" if letters.lower() in ("r", "v") else "page" if _PAGE.fullmatch(letters) else "other"
        form = _LETTERS.sub("a", _DIGITS.sub("9", s)) if kind != "other" else kind
        made = e.short[s] = (kind, form, "".join(sorted(set(_SIGNS.sub("", s)))), numbers)
    kind, form, signs, numbers = made
    same = None
    if len(numbers) == 1 and kind != "other":
        same = (numbers[0] == str(number), bool(folio) and folio.strip("[]. ").lower() == s.strip("[]-—–. ").lower())
    return (*common, lead, where, kind, form, signs, min(len(numbers), 3), same, (number is not None, bool(folio)))


def line_features(shape: tuple) -> list[str]:
    """Names of the features of a shape."""
    part, where, size, known, named, caps, stop, following, end = shape[:9]
    out = [
        f"n{size}", f"like {part} {size}", f"like {part} {where}", "at " + where, f"known {known} of {size}", f"named {named} {known}", f"caps {caps} {part}",
        f"after {stop}", "next " + following, "end " + end,
    ]
    if len(shape) > 9:
        lead, place = shape[9:11]
        on_page = [place[0], f"index {place[1]}", f"top {place[2]}"]
        out += [f"lead {lead} {part == 'none'} {min(named, 2)}", f"lead {lead != '-'} {known} of {size} {part}"]
        if len(shape) == 11:
            return out + [f"{x} {part}" for x in on_page]
        kind, form, signs, numbers, same, given = shape[11:]
        out += ["letters " + kind, "signs " + signs[:4], f"num{numbers} {kind}", "shape " + form, f"kind {kind} {min(numbers, 2)} {'plain' if not set(signs) - set('-—–[].') else 'odd'}", f"kind {kind} {where}"]
        if same is not None:
            out.append(f"same {same}")
        out += [f"{x} {kind}" for x in [*on_page, f"given {given}"]]
    return out


def furniture_lines(e: Editor, lines: list[str], journal: str | None, place: tuple = NOWHERE) -> list[str]:
    """Class of each line: text, header or page_number."""
    names, out = e.title_names(journal), []
    alike = e.alike_to(names) if names else None
    for k, line in enumerate(lines):
        if not line or line.isspace():
            out.append("text")
            continue
        shape = line_shape(e, line, k, len(lines), lines[k - 1] if k else "", lines[k + 1] if k + 1 < len(lines) else "", names, place, False, alike)
        if shape not in e.shapes:
            if len(e.shapes) > 400_000:
                e.shapes.clear()
            e.shapes[shape] = e.furniture.best(line_features(shape))
        out.append(e.shapes[shape])
    return out


#: Words that follow an elliptic hyphen (`Nord- und`).
CONJUNCTIONS = frozenset("und oder bis y o e et ou and or vel atque".split())


def join_features(lexicon, part: str, mark: str, following: str) -> list[str]:
    nxt = _WORD.match(following)
    nxt = nxt[0] if nxt else ""
    whole = (part + nxt).lower()
    a, b, c = part.lower() in lexicon, nxt.lower() in lexicon, whole in lexicon
    return ["j", "mark " + mark, f"part {a}", f"next {b}", f"whole {c}", f"{a} {b} {c}", "low" if nxt[:1].islower() else "other", f"short {len(nxt) < 3}", f"conjunction {nxt in CONJUNCTIONS} {c}"]


def flaws(e: Editor, text: str | None, journal: str | None, place: tuple = NOWHERE, mend: bool = True) -> tuple[list[str], list[tuple[int, str]], list[str]]:
    """Lines, their flaws (line number from 1, flaw), and the repaired running lines (unless `mend` is false)."""
    if not text or not text.strip():
        return [], [], []
    lines = text.split("\n")
    kinds = furniture_lines(e, lines, journal, place)
    out, repaired = [], []
    carried: tuple[str, int] | None = None  # part of a word broken before this line, and its line
    memo, edit = e.memo, e.edit
    for k, line in enumerate(lines):
        if kinds[k] != "text":
            out.append((k + 1, kinds[k]))
            continue
        if not line or line.isspace():
            carried = None
            repaired.append(line + "\n")
            continue
        words = _WORD.findall(line)
        rest = words
        bad: set[int] = set()
        fixed: dict[str, str] = {}
        if carried and words:
            part, at = carried
            if (hit := edit(part + words[0])) is not None:
                bad.add(at if hit[0] < len(part) else k)
            rest = words[1:]
        carried = None
        m = _MARKED.search(line) if line.rstrip(" ")[-1:] in _MARK_SET else None
        if m and words:
            j = k + 1
            while j < len(lines) and kinds[j] != "text":
                j += 1
            if j < len(lines) and lines[j].strip() and e.joins(words[-1], m[1], lines[j].lstrip()):
                out.append((k + 1, "hyphen"))
                carried = (words[-1], k)
                rest = rest[:-1]
        for w in rest:
            if w in memo:
                hit = memo[w]
            else:
                hit = edit(w)
            if hit is not None:
                bad.add(k)
                fixed[w] = hit[1].capitalize() if w[0].isupper() else hit[1]
        out += [(i + 1, "misread") for i in bad]
        if not mend:
            continue
        if fixed:
            line = _WORD.sub(lambda x: fixed.get(x[0], x[0]), line)
        repaired.append(line[: m.start(1)] if carried else line + " ")
    return lines, sorted(set(out)), repaired


def lexicon_of(regions: DataFrame) -> frozenset[str]:
    """Ordinary words, from counts over the content of all regions."""
    t = regions.filter(F.col("content").isNotNull())
    bit = F.expr("shiftleft(1L, cast(pmod(xxhash64(journal_id), 60) as int))")
    words = t.select(bit.alias("journal"), F.explode(F.split(F.lower("content"), r"[^\p{L}]+")).alias("w")).filter("w <> ''")
    counts = words.groupBy("w").agg(F.count("*").alias("n"), F.expr("bit_count(bit_or(journal))").alias("journals"))
    from ..session import cut

    counts = cut(counts.filter("n > 3"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    journals = min(JOURNALS, max(1, (counts.agg(F.max("journals")).first()[0] or 1) // 3))
    # words by share of all: at most 10 / LEXICON of them
    seen = {r["w"]: r["n"] for r in counts.filter((F.col("n") >= LEXICON * total / 10) & (F.col("journals") >= journals)).select("w", "n").collect()}
    lexicon = {w for w, n in seen.items() if n >= LEXICON * total}
    near = Neighbours(lexicon)
    older = {w for w, n in seen.items() if w not in lexicon and n >= SPELLING_COUNT and any(n >= SPELLING * seen[c] for c in near.of(w))}
    return frozenset(lexicon | older)


_NUMBER = re.compile(r"^[^\w]{0,3}(?:[a-zA-Z]{1,4}\.? ?)?\d{1,4} ?[rv]?[^\w]{0,3}$")


def train(regions: DataFrame, journals: DataFrame, size: int = SAMPLE) -> Editor:
    """Models from the lexicon of all text and a bounded sample of regions by hash of the id."""
    lexicon = lexicon_of(regions)
    titles = {r["journal_id"]: r["title"] for r in bounded(journals.select("journal_id", "title"), JOURNALS_MOST, "journals")}
    cells = F.flatten("table_data.cells") if "table_data" in regions.columns else F.lit(None).cast("array<string>")
    rows = first_by_hash(regions.filter("content is not null and region_id is not null").select("region_id", "region_type", "journal_id", "content", cells.alias("cells"), *_place_columns(regions, "region")), "region_id", size).collect()
    texts = [(r["content"], r["journal_id"], _place(r)) for r in rows if r["region_type"] in TEXT_TYPES]
    characters, confusions = _train_characters(lexicon, [t for t, *_ in texts])
    e = Editor(lexicon, characters, Perceptron(["text"]), titles, confusions)
    e.furniture = _train_furniture(e, rows, texts[: SAMPLE // 3])
    return e


def _train_characters(lexicon: frozenset[str], texts: list[str]) -> tuple[Perceptron, frozenset[tuple[str, str]]]:
    """The editor of characters and line joins, and the confusions it knows."""
    near, rng = Neighbours(lexicon), random.Random(11)
    # Confusions: rare words against the only lexicon word they could come from.
    support: dict[tuple[str, str], set[str]] = defaultdict(set)
    others, mined = [], []
    for word in dict.fromkeys(w for t in texts for w in _WORD.findall(re.sub(rf"[{MARKS}] *\n", "", t))):
        w = word.lower()
        if w in lexicon or w.isnumeric() or len(w) < 3:
            continue
        found = near.of(w) if len(w) > 3 else ()
        if len(found) == 1:
            clean = next(iter(found))
            _, good, bad = difference(clean, w)
            if good and bad:
                mined.append((word, (good, bad)))
                support[good, bad].add(clean)
                continue
        others.append(word)
    confusions = frozenset(op for op, s in support.items() if len(s) >= 3)
    changes, examples = Changes(confusions), []
    # two spellings of one word in the lexicon (`étoit`, `était`): where such a change may be one of spelling
    twins = {(w, i, clean[i : i + 1], w[i : i + 3]) for w in sorted(lexicon) for i, clean, ops in changes.of(w) if clean in lexicon and len(ops) == 1 and ops[0][2] != DELETE and not ops[0][1]}
    count = Counter((good, around) for _, _, good, around in twins)
    spelling = {x for x, n in count.items() if n >= 3 and len(x[1]) == 3}

    def show(word: str, truth: dict[tuple[int, bool], str], known: bool | None = None) -> None:
        """One example for each place of a word that a change could touch."""
        for at, (fs, open_) in changes.positions(word.lower(), lexicon, case_of(word), known).items():
            gold = truth.get(at, KEEP)
            examples.append((fs, gold, [KEEP, *open_] if gold in open_ or gold == KEEP else [KEEP, gold, *open_]))

    def spoil(words: list[str], at_most: int) -> None:
        made = []
        for word in words:
            for good, bad in sorted(confusions):
                for i in range(len(word)) if len(word) > 2 else ():
                    seen = word[:i] + bad + word[i + len(good) :]
                    if word.startswith(good, i) and seen.lower() not in lexicon and (good, seen[i : i + 3].lower()) not in spelling:
                        made.append((seen, {(i + k, gap): op for k, gap, op in operations(good, bad)}))
        for seen, truth in rng.sample(made, min(len(made), at_most)):
            show(seen, truth)

    known = sorted(lexicon)
    spoil(known, PAIRS)
    spoil([w.capitalize() for w in known], PAIRS // 4)
    for w in known:
        for word in (w, w.capitalize()):
            show(word, {})
            if not any(clean in lexicon for _, clean, _ in changes.of(w)):
                show(word, {}, False)  # as if unknown
    # words the lexicon does not hold are mostly right as they are; what shows a misreading in them is what no right word has
    for w, *_ in sorted(twins):
        show(w, {}, False)
    plain = rng.sample(others, min(len(others), PAIRS))
    for w in plain:
        show(w, {})
    spoil([w for w in plain if w.islower()], len(plain) // 8)
    for word, (good, bad) in mined:
        w = word.lower()
        if (good, bad) not in confusions or any((good, w[i : i + 3]) in spelling and w[:i] + good + w[i + 1 :] in lexicon for i in range(len(w))):
            show(word, {})
            continue
        for i, clean, ops in changes.of(w):
            if clean in lexicon and w.startswith(bad, i) and clean == w[:i] + good + w[i + len(bad) :]:
                show(word, {(i + k, gap): op for k, gap, op in ops})
                break
    # a mark at a line end
    for t in texts[: SAMPLE // 3]:
        lines = t.split("\n")
        for k, line in enumerate(lines[:-1]):
            m, words, after = _MARKED.search(line), _WORD.findall(line), lines[k + 1]
            if m and after and words:
                fs = join_features(lexicon, words[-1], m[1], after)
                if f"conjunction {True} {False}" in fs:
                    examples.append((fs, KEEP, [KEEP, JOIN]))
                elif f"whole {True}" in fs or f"part {False}" in fs and "low" in fs:
                    examples.append((fs, JOIN, [KEEP, JOIN]))  # half a word is no word
                elif f"part {True}" in fs and f"next {True}" in fs:
                    examples.append((fs, KEEP, [KEEP, JOIN]))
    # elliptic hyphens are rare at line ends: made from the lexicon
    for w in rng.sample(known, min(40, len(known))):
        examples += [(join_features(lexicon, part, "-", f"{c} {w}"), KEEP, [KEEP, JOIN]) for c in sorted(CONJUNCTIONS)[::3] for part in (w, w[::-1])]
    return Perceptron(sorted({op for _, gold, open_ in examples for op in open_} | {KEEP, JOIN})).fit(examples, epochs=4), confusions


def _train_furniture(e: Editor, rows: list, texts: list[tuple[str, str, tuple]]) -> Perceptron:
    """The classifier of lines, from what titles and region types say."""
    rng, out, placed = random.Random(11), [], []
    features = lambda *x, **y: line_features(line_shape(*x, **y))
    for t, journal, place in texts:
        lines, names = t.split("\n"), e.title_names(journal)
        for k, line in enumerate(lines):
            if not line.strip():
                continue
            before, after = lines[k - 1] if k else "", lines[k + 1] if k + 1 < len(lines) else ""
            header = bool(names) and len(line.split()) <= 10 and likeness(line, names) == len(names)
            if header or not _NUMBER.match(line.strip()):
                kind = "header" if header else "text"
                for holder in (place, ("page", None, None, *place[3:])):
                    out.append((features(e, line, k, len(lines), before, after, names, holder), kind))
                if header and rng.random() < HIDDEN:
                    out.append((features(e, line, k, len(lines), before, after, names, place, hide=True), kind))
        if len(lines) > 1:  # running text without line breaks
            for k, n in ((0, 1), (0, 3), (1, 3)):
                out.append((features(e, " ".join(lines), k, n, "", "", names, place), "text"))
        for k in {0, len(lines) // 2, len(lines)}:
            placed.append((k, len(lines), lines[k - 1] if k else "", lines[k] if k < len(lines) else "", place))
    for r in rows:
        kind, c = r["region_type"], r["content"].strip()
        # on a page the cells of a table are lines
        for x in r["cells"] or ():
            if x and x.strip() and not _NUMBER.match(x.strip()):
                out.append((features(e, x, 1, 3, "", "", [], ("page", None, None, r["page_number"], r["folio_label"])), "text"))
        if kind not in ("page_number", "entry_heading", "calculation") or not c:
            continue
        label = "page_number" if kind == "page_number" else "text"
        if label == "text" and not _NUMBER.match(c):
            continue
        forms = [c]
        if label == "page_number" and re.fullmatch(r"\d+\.?", c):  # also set between dashes or after p.
            n = c.rstrip(".")
            forms += [f"- {n} -", f"— {n} —", f"p. {n}", n]
        for x in forms:
            out.append((features(e, x, 0, 1, "", "", [], _place(r)), label))
            for k, n, before, after, place in rng.sample(placed, min(3, len(placed))):
                out.append((features(e, x, k, n + 1, before, after, [], place), label))
                # on a page a field ends at a blank line
                for up, down in ((before, ""), ("", after), ("", "")):
                    out.append((features(e, x, k + 1, n + 3, up, down, [], ("page", None, None, *place[3:])), label))
    # ends of measured values on a line of their own are text
    out += [(features(e, f"{n}{end}", k, 3, "", "", []), "text") for n in (3, 14, 82) for end in ("'.", "°.", " °.", " '.", "½", "° R..") for k in (0, 1, 2)]
    # more than REPEATS lines of one shape say nothing new
    shown = Counter((tuple(fs), kind) for fs, kind in out)
    return Perceptron(["header", "page_number", "text"]).fit([(list(fs), kind) for (fs, kind), n in shown.items() for _ in range(min(n, REPEATS))], epochs=3)


def _place_columns(df: DataFrame, holder: str) -> list:
    """region_index, top, page_number, folio_label as far as `df` has them."""
    def own(name: str, kind: str):
        return (F.col(name) if name in df.columns else F.lit(None)).cast(kind)

    top = F.get(F.col("bbox"), F.lit(0)).cast("double") if "bbox" in df.columns else F.lit(None).cast("double")
    return [own("region_index", "int").alias("region_index"), top.alias("top"), own("page_number", "int").alias("page_number"), own("folio_label", "string").alias("folio_label")]


def _place(r) -> tuple:
    return ("region", r["region_index"], r["top"], r["page_number"], r["folio_label"])


def _holders(regions: DataFrame, pages: DataFrame) -> DataFrame:
    """holder, record_id, journal_id, text and place of text regions and pages."""
    r = regions.filter(F.col("region_type").isin(*TEXT_TYPES)).select(F.lit("region").alias("holder"), F.col("region_id").cast("long").alias("record_id"), "journal_id", F.col("content").alias("text"), *_place_columns(regions, "region"))
    p = pages.select(F.lit("page").alias("holder"), F.col("page_id").cast("long").alias("record_id"), "journal_id", F.col("full_text").alias("text"), *_place_columns(pages, "page"))
    return r.unionByName(p).filter(F.col("text").rlike(r"\S") & F.col("record_id").isNotNull())


def _shared(e: Editor, spark):
    return spark.sparkContext.broadcast((e.lexicon, e.characters, e.furniture, e.titles, e.confusions))  # bounded by LEXICON and SAMPLE


def _rows(b: pd.DataFrame):
    """holder, record_id, journal, text, place of each row."""
    known = lambda c: b[c].astype(object).where(b[c].notna(), None).tolist()
    number = [None if x is None else int(x) for x in known("page_number")]
    yield from zip(b["holder"], b["record_id"].tolist(), b["journal_id"], b["text"], zip(b["holder"], known("region_index"), known("top"), number, known("folio_label"), strict=True), strict=True)


def find(regions: DataFrame, pages: DataFrame, journals: DataFrame, editor: Editor | None = None) -> DataFrame:
    """holder, record_id, line_no, flaw of every faulty line."""
    shared, key = _shared(editor or train(regions, journals), regions.sparkSession), str(uuid.uuid4())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = held(key, lambda: Editor(*shared.value))
        for b in batches:
            out = []
            for holder, record, journal, text, place in _rows(b):
                out += [(holder, record, n, flaw) for n, flaw in flaws(e, text, journal, place, mend=False)[1]]
            yield pd.DataFrame(out, columns=["holder", "record_id", "line_no", "flaw"])

    return spread(_holders(regions, pages)).mapInPandas(run, "holder string, record_id long, line_no long, flaw string").distinct()


def repair(regions: DataFrame, pages: DataFrame, journals: DataFrame, editor: Editor | None = None) -> DataFrame:
    """holder, record_id, text: continuous paragraphs without furniture, breaks and misread words."""
    shared, key = _shared(editor or train(regions, journals), regions.sparkSession), str(uuid.uuid4())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = held(key, lambda: Editor(*shared.value))
        for b in batches:
            texts = []
            for _, _, journal, text, place in _rows(b):
                joined = "".join(flaws(e, text, journal, place)[2])
                texts.append("\n\n".join(re.sub(r"\s+", " ", x).strip() for x in joined.split("\n") if x.strip()))
            yield pd.DataFrame({"holder": b["holder"], "record_id": b["record_id"], "text": texts})

    return spread(_holders(regions, pages)).mapInPandas(run, "holder string, record_id long, text string").dropDuplicates(["holder", "record_id"])
