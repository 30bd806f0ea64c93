"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

A sentence is read as windows: its words, its runs of single letters joined
("i d i o t"), overlapping slices of over-long words, and two or three
neighbouring words with the blanks between them ("wo rth less"). Kernel of two
windows: the gap-weighted count of common subsequences of three symbols, weight
DECAY per skipped position, over the windows' lengths; punctuation and blanks
are positions that can only be skipped, so inserted characters cost decay
instead of the match. Landmarks give the Nystroem map K(., Z) K(Z, Z)^-1/2, on
which a linear squared-hinge SVM is trained.

The decision function is a sum over landmarks of a dot product of subsequence
weights, so it collapses, exactly, to one weight per subsequence: a table of
64^3 numbers, whatever the data. That table is what the executors score with.
Neighbouring words are joined where the table's weights of the two subsequences
next to the blank reach a bound that nine tenths of split insults reach in training (and
a tenth of ordinary neighbours at most).

A text scores by a logistic curve over the margins of its TOP worst different
words and its number of words; one word or one join is enough where its margin
is one that hardly any clean text reaches, and none is toxic without a window
on the toxic side.

Labels belong to documents, so windows are labelled by multiple-instance rounds:
toxic windows are first those that occur in toxic documents more often than
chance allows (words, and pairs of words that are harmless alone), then the ones
that the current machine finds worst in each toxic document; windows of a clean
document are clean. Training uses a bounded sample of labelled rows (TRAIN_DOCS
of each class, in order of a hash of the id) and runs in one task, in a fork of
its worker, so that its memory ends with it.

Null and empty texts score as a text without any window. Very long texts are
read whole. Repeated rows are scored each. Labels that contradict each other
count as toxic; null ids and null labels are ignored. Without both classes among the labels nothing is
learnt and every score is 0. Other columns are never read.
"""

from __future__ import annotations

import heapq
import pickle
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import apart, give_back, leaves_nothing
from .words import mix

TRAIN_DOCS = 2000
DECAY, SPAN, WINDOW, STRIDE = 0.6, 7, 20, 10
LANDMARKS, NEGATIVES, ROUNDS, FOLDS = 384, 6000, 4, 3
PER_DOCUMENT, TOP, RIDGE = 3, 4, 1e-4
THRESHOLD, SHARP, ENOUGH = 0.7, 4.0, 0.002
#: Documents that a window counts for at most; cost of a margin error.
OFTEN, COST = 200, 1.0
#: Longest stretch of text, in characters, that a join of words may cover.
JOINED = 24
_AT_THRESHOLD = float(np.log(THRESHOLD / (1 - THRESHOLD)))
#: Margin of a text without any window.
NOTHING = -9.0
_EDGE = 1
_MEMO_ENTRIES = 300_000
_SPELLED = re.compile(r"(?<!\S)(?:\S\s+){2,}\S(?!\S)")
#: Symbols: 0 is what can only be skipped, 1 a word's edge, then letters and digits; the rest of the alphabet folds onto its base letter or onto 63.
_SYMBOLS = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789àáâäãåæçèéêëíîïñóôöõøœúû", 2)}


class _Codes(dict):
    def __missing__(self, c: str) -> int:
        code = _SYMBOLS.get(c)
        if code is None:
            base = unicodedata.normalize("NFD", c)[0]
            code = _SYMBOLS.get(base, 63 if base.isalnum() else 0)
        self[c] = code
        return code


_CODES = _Codes()


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    """Symbol of each code point of the basic plane; what lies beyond it is taken as its last."""
    return np.array([_EDGE if x == 1 else _CODES[chr(x)] if not 0xD800 <= x < 0xE000 else 0 for x in range(0x10000)], np.int32)


def spelled(text: str) -> list[str]:
    """Runs of single characters, joined: an insult written with gaps."""
    return ["".join(run.split()) for run in _SPELLED.findall(text)]


def slices(word: str) -> list[str]:
    """The word between edges, or its overlapping slices when it is over-long."""
    word = "\x01" + word + "\x01"
    if len(word) <= WINDOW:
        return [word]
    return [word[i : i + WINDOW] for i in range(0, len(word) - WINDOW + STRIDE, STRIDE)]


def _strip(word: str) -> str:
    """Without the punctuation around it."""
    i, j = 0, len(word)
    while i < j and not word[i].isalnum():
        i += 1
    while j > i and not word[j - 1].isalnum():
        j -= 1
    return word[i:j]


def _indices(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Position triples of span SPAN at most in a window of n symbols, and their weights."""
    at = [(i, j, k) for i in range(n) for j in range(i + 1, min(n, i + SPAN - 1)) for k in range(j + 1, min(n, i + SPAN))]
    i, j, k = np.array(at, np.int64).reshape(-1, 3).T
    return i, j, k, (DECAY ** (k - i - 2)).astype(np.float32)


_INDICES: dict[int, tuple] = {}


def subsequences(windows: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows grouped by length: (their places, subsequence codes, weights); code 0 is one that touches a skipped symbol."""
    by_length: dict[int, list[int]] = {}
    for at, w in enumerate(windows):
        if len(w) >= 3:
            by_length.setdefault(len(w), []).append(at)
    for n, places in by_length.items():
        if n not in _INDICES:
            _INDICES[n] = _indices(n)
        i, j, k, weight = _INDICES[n]
        for lo in range(0, len(places), 4096):
            part = places[lo : lo + 4096]
            points = np.frombuffer("".join([windows[p] for p in part]).encode("utf-32-le", "surrogatepass"), "<u4")
            c = _table()[np.minimum(points, 0xFFFF)].reshape(len(part), n)
            skipped = ~c.all(axis=1)
            for rows, plain in ((np.flatnonzero(~skipped), True), (np.flatnonzero(skipped), False)):
                if rows.size:
                    x = c[rows]
                    code = (x[:, i] * 64 + x[:, j]) * 64 + x[:, k]
                    if plain:
                        norm = np.broadcast_to(weight / np.sqrt((weight * weight).sum()), code.shape)
                    else:
                        code[(x[:, i] == 0) | (x[:, j] == 0) | (x[:, k] == 0)] = 0
                        norm = weight / np.sqrt(np.maximum(((code > 0) * (weight * weight)).sum(axis=1), 1e-6))[:, None]
                    yield np.array(part)[rows], code, norm


@dataclass
class Model:
    """One weight per subsequence, the bias, and the calibration of a text's margins."""

    weights: np.ndarray
    bias: float
    #: What the seam of two neighbouring words has to reach for them to be read as one window.
    seam: float = np.inf
    #: 0: nothing was learnt. Else the logistic curve's slope, a factor for each of a text's margins and a constant, and the margins from which a single window is enough: a word, a join.
    slope: float = 0.0
    factors: np.ndarray = field(default_factory=lambda: np.zeros(TOP + 2))
    alone: tuple[float, float] = (np.inf, np.inf)
    memo: dict[str, tuple[float, str]] = field(default_factory=dict, repr=False)

    def windows(self, windows: list[str]) -> np.ndarray:
        out = np.full(len(windows), self.bias, np.float64)
        for places, code, weight in subsequences(windows):
            out[places] += np.einsum("bm,bm->b", self.weights[code], weight)
        return out

    def _remember(self, words: set[str]) -> None:
        """Margins of new words, each with its core; windows are remembered, so each worker scores a word once."""
        new = [w for w in words if w not in self.memo]
        cores = [_strip(w) for w in new]
        parts = [slices(c) if c else [] for c in cores]
        flat, at = self.windows([x for p in parts for x in p]).tolist(), 0
        for w, c, p in zip(new, cores, parts, strict=True):
            self.memo[w] = (max(flat[at : at + len(p)], default=NOTHING), c)
            at += len(p)

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, list[str | None]]:
        """Of each text the margins of its TOP worst different words, of its worst join and the logarithm of its words; and the worst window."""
        if len(self.memo) > _MEMO_ENTRIES:
            self.memo.clear()
        lower = [(t or "").lower() for t in texts]
        bags = [words_of(t) for t in lower]
        joined = [joins(t, self.weights, self.seam) for t in lower]
        self._remember(set().union(*bags, *joined))
        out, worst = np.full((len(texts), TOP + 2), NOTHING), []
        for i, (bag, join) in enumerate(zip(bags, joined, strict=True)):
            top = heapq.nlargest(TOP, {self.memo[w] for w in bag})
            out[i, : len(top)] = [m for m, _ in top]
            across = max((self.memo[w] for w in join), default=(NOTHING, None))
            out[i, TOP], out[i, TOP + 1] = across[0], np.log1p(len(bag))
            worst.append(max([*top[:1], across], key=lambda x: x[0])[1])
        return out, worst

    def probability(self, margins: np.ndarray) -> np.ndarray:
        if not self.slope:
            return np.zeros(len(margins))
        z = self.slope * np.column_stack([_bounded(margins), np.ones(len(margins))]) @ self.factors
        for column, enough in zip((0, TOP), self.alone, strict=True):
            z = np.maximum(z, SHARP * (margins[:, column] - enough) + _AT_THRESHOLD)
        # without a window on the toxic side a text isn't toxic, however short it is
        z = np.minimum(z, SHARP * margins[:, [0, TOP]].max(axis=1) + _AT_THRESHOLD)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _bounded(margins: np.ndarray) -> np.ndarray:
    """What the calibration sees of margins: the words', within 3 of the machine's edge, and the number of words."""
    return np.column_stack([np.clip(margins[:, :TOP], -3, 3), margins[:, TOP + 1]])


def words_of(lower: str) -> set[str]:
    return {*lower.split(), *spelled(lower)}


def _spaces() -> np.ndarray:
    return np.array([chr(x).isspace() for x in range(0x10000)])


_IS_SPACE = _spaces()


def seams(lower: str, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text, and of each word but the first the weights of the two subsequences next to the blank before it."""
    points = np.minimum(np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), "<u4"), 0xFFFF)
    c = np.concatenate([[0, 0], _table()[points], [0, 0]])
    blank = np.concatenate([[True], _IS_SPACE[points], [True]])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edge[0::2], edge[1::2]
    # two places of c before a word's end, two from a word's start; blanks and punctuation are 0 and weigh nothing
    a, b, d, e = c[end[:-1]], c[end[:-1] + 1], c[start[1:] + 2], c[start[1:] + 3]
    return start, end, weights[(a * 64 + b) * 64 + d] * ((a > 0) & (b > 0) & (d > 0)) + weights[(b * 64 + d) * 64 + e] * ((b > 0) & (d > 0) & (e > 0))


def joins(lower: str, weights: np.ndarray, seam: float) -> set[str]:
    """Two or three neighbouring words as one window, its blanks being skippable, where the subsequences at each seam speak for an insult."""
    if not np.isfinite(seam):
        return set()
    start, end, at_seam = seams(lower, weights)
    hit = np.flatnonzero(at_seam >= seam)
    out = set()
    for i in hit.tolist():
        out.add((i, i + 1))
    out |= {(i, i + 2) for i, j in zip(hit[:-1].tolist(), hit[1:].tolist(), strict=True) if j == i + 1}
    found = {" ".join(lower[start[i] : end[j]].split()) for i, j in out if end[j] - start[i] <= JOINED}
    return {w for w in found if len(w) + 2 <= WINDOW}


def _variants(word: str, rng: np.random.Generator) -> list[str]:
    """The word with gaps and inserted characters, as insults are disguised."""
    at = rng.integers(1, max(2, len(word)), 5)
    letter = ["abcdefghijklmnopqrstuvwxyz"[i] for i in rng.integers(0, 26, 4)]
    inserted = [word[:i] + c + word[i:] for i, c in zip(at, ("*", word[at[1] - 1], *letter[:2], " "), strict=True)]
    return [*(c.join(word) for c in ".-_"), *inserted, letter[2] + word + letter[3]]


def _kernel(windows: list[str], landmarks: np.ndarray) -> np.ndarray:
    """Kernel of windows with landmarks given as subsequence weights (64^3 x L)."""
    out = np.zeros((len(windows), landmarks.shape[1]), np.float32)
    for places, code, weight in subsequences(windows):
        for lo in range(0, len(places), 64):
            out[places[lo : lo + 64]] = np.einsum("bm,bml->bl", weight[lo : lo + 64], landmarks[code[lo : lo + 64]])
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, wanted: np.ndarray, cost: float = COST) -> tuple[np.ndarray, float]:
    """Primal squared-hinge SVM by Newton steps on the active set; each example has its wanted margin."""
    n = x.shape[1] + 1
    ridge = np.eye(n)
    ridge[-1, -1] = 1e-6
    w = np.zeros(n)
    for _ in range(30):
        left, right = ridge.copy(), np.zeros(n)
        for lo in range(0, len(x), 2048):  # doubles of one block at a time
            part = slice(lo, lo + 2048)
            active = y[part] * (x[part] @ w[:-1] + w[-1]) < wanted[part]
            xa = np.column_stack([x[part][active].astype(np.float64), np.ones(active.sum())])
            weighed = xa * (cost * weight[part][active])[:, None]
            left += weighed.T @ xa
            right += weighed.T @ (y * wanted)[part][active]
        new = np.linalg.solve(left, right)
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w[:-1], float(w[-1])


def _machine(positive: list[str], negative: list[str], often: dict[str, int], balance: float, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """Subsequence weights and bias of an SVM on the Nystroem map of windows; a window weighs as often as documents of its class hold it, a toxic one `balance` times that."""
    marks = [*positive[: LANDMARKS // 2]]
    marks += [negative[i] for i in rng.permutation(len(negative))[: LANDMARKS - len(marks)]]
    codes: set[int] = set()
    for _, code, _ in subsequences(marks):
        codes.update(np.unique(code).tolist())
    row = np.zeros(64**3, np.int32)  # row 0: subsequences that no landmark has
    row[sorted(codes - {0})] = np.arange(1, len(codes - {0}) + 1)
    z = np.zeros((len(codes - {0}) + 1, len(marks)), np.float32)
    for places, code, weight in subsequences(marks):
        for p, c, v in zip(places, code, weight, strict=True):
            np.add.at(z[:, p], row[c], v)
    z[0] = 0
    table = _Rows(row, z)
    values, vectors = np.linalg.eigh(_kernel(marks, table).astype(np.float64))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    weighed = [(p, often[p], 1) for p in positive] + [(n, often[n], -1) for n in negative]
    disguised = [(v, often[p] / 8, 1) for p in positive for u in _variants(p.strip("\x01"), rng) for v in slices(u)]
    windows, counts, y = zip(*weighed, *disguised, strict=True)
    y = np.array(y, float)
    weight = np.clip(counts, 1 / 8, OFTEN) * np.where(y > 0, balance, 1.0)
    # what is in many toxic documents has to be clearer than what is in a few
    wanted = 1 + np.where(y > 0, np.log10(np.clip(counts, 1, OFTEN)), 0)
    w, bias = _svm(_kernel(windows, table) @ whiten.astype(np.float32), y, weight, wanted)
    weights = np.zeros(64**3, np.float32)
    weights[sorted(codes - {0})] = (z[1:] @ (whiten @ w)).astype(np.float32)
    return weights, bias


class _Rows:
    """Landmark weights by subsequence code, without the rows no landmark has."""

    def __init__(self, row: np.ndarray, z: np.ndarray):
        self.row, self.z, self.shape = row, z, (len(row), z.shape[1])

    def __getitem__(self, code: np.ndarray) -> np.ndarray:
        return self.z[self.row[code]]


def _explaining(docs: list[set[str]], clean: Counter, least: int) -> list[str]:
    """Windows that together explain the toxic documents: greedily the one in most unexplained documents, rare in clean ones."""
    seen = Counter(w for d in docs for w in d)
    ok = {w for w, n in seen.items() if n >= least and n > 10 * clean[w]}
    where: dict[str, list[int]] = {w: [] for w in ok}
    for i, d in enumerate(docs):
        for w in d & ok:
            where[w].append(i)
    chosen, open_docs, counts = [], set(range(len(docs))), Counter({w: len(x) for w, x in where.items()})
    while counts:
        w, n = max(counts.items(), key=lambda x: (x[1], x[0]))
        if n < least:
            break
        chosen.append(w)
        for i in where[w]:
            if i in open_docs:
                open_docs.discard(i)
                for u in docs[i] & ok:
                    counts[u] -= 1
        counts = +counts
    return chosen


def _one_of_each(bags: list[set[str]]) -> list[int]:
    """Places of bags, without near copies: their words would look like insults. Bags that share a band of minima of their longer words are one."""
    rng = np.random.default_rng(3)
    a, b = (rng.integers(1, 1 << 62, 24, dtype=np.uint64) | np.uint64(1) for _ in range(2))
    seen, out = set(), []
    for place, bag in enumerate(bags):
        x = np.array([xxhash.xxh3_64_intdigest(w) for w in bag if len(w) > 7], np.uint64)
        least = mix(x[:, None] * a + b).min(axis=0).reshape(6, 4) if len(x) else np.zeros((6, 4), np.uint64)
        keys = [(i, row.tobytes()) for i, row in enumerate(least)] if len(x) > 8 else [tuple(sorted(bag))]
        if seen.isdisjoint(keys):
            out.append(place)
        seen.update(keys)
    return out


def _significant(toxic: Counter, clean: Counter, n1: int, n0: int, false: float = 0.05, tried: int | None = None) -> list[str]:
    """Windows, of the `tried` ones that were looked at, that occur in toxic documents more often than chance allows, and at least ten times as often; a share of `false` may be chance (Benjamini and Hochberg, on Chernoff's bound)."""
    q, found = np.log(n1 / (n1 + n0)), []
    r = np.log(n0 / (n1 + n0))
    for w, n in toxic.items():
        c = clean[w]
        if n > 10 * c:
            found.append((-n * (np.log(n / (n + c)) - q) - (c and c * (np.log(c / (n + c)) - r)), w))
    found.sort()
    last = max((k for k, (log_p, _) in enumerate(found, 1) if log_p <= np.log(k / (tried or len(toxic)) * false)), default=0)
    return sorted((w for _, w in found[:last]), key=lambda w: (-toxic[w], w))


def _pairs(lower: str) -> set[str]:
    """Neighbouring words with the blank between them, short enough for a window."""
    core: dict[str, str] = {}
    words = [core[w] if w in core else core.setdefault(w, _strip(w)) for w in lower.split()]
    return {f"\x01{a} {b}\x01" for a, b in zip(words[:-1], words[1:], strict=True) if a and b and len(a) + len(b) + 3 <= WINDOW}


def _frequent_pairs(documents: list[_Document], least: int) -> tuple[set[str], int]:
    """Pairs of words in at least so many documents, and the number of all pairs; counted by hash, as most occur once."""
    hashes = [np.fromiter((xxhash.xxh3_64_intdigest(p) for p in _pairs(d.lower)), np.uint64) for d in documents]
    values, counts = np.unique(np.concatenate(hashes), return_counts=True)
    often = set(values[counts >= least].tolist())
    return {p for d in documents for p in _pairs(d.lower) if xxhash.xxh3_64_intdigest(p) in often}, len(values)


@dataclass(frozen=True)
class _Document:
    """A labelled document: its text and words (between edges, sliced). Its pairs of neighbouring words are made again where they are needed."""

    lower: str
    toxic: bool
    words: set[str]


def train(texts: list[str | None], labels: list[int], seed: int = 5) -> Model:
    """The model of labelled texts. All of them train the machine; its calibration is of the margins that machines trained on the other FOLDS - 1 parts give each part."""
    rng = np.random.default_rng(seed)
    documents, of_word, known = [], {}, {}  # one string for a word of many documents
    for i in rng.permutation(len(texts)):
        lower = (texts[i] or "").lower()
        words = words_of(lower)
        for w in words - of_word.keys():
            of_word[w] = slices(core) if (core := _strip(w)) else []
        words = {v for w in words for v in of_word[w]}
        documents.append(_Document(lower, bool(labels[i]), {known.setdefault(v, v) for v in words}))
    del of_word, known
    documents = [documents[i] for i in _one_of_each([d.words for d in documents])]
    model = _learn(documents, rng)
    if model is None:
        return Model(np.zeros(64**3, np.float32), -1.0)
    margins, toxic = [], []
    for k in range(FOLDS):
        part, others = documents[k::FOLDS], [d for i, d in enumerate(documents) if i % FOLDS != k]
        judge = _learn(others, rng)
        if judge is not None and part:
            margins.append(np.concatenate([judge.texts([d.lower for d in part[lo : lo + 256]])[0] for lo in range(0, len(part), 256)]))
            toxic += [d.toxic for d in part]
    if not margins:  # too few documents for parts
        margins, toxic = [model.texts([d.lower for d in documents])[0]], [d.toxic for d in documents]
    _calibrate(model, np.concatenate(margins), np.array(toxic, float))
    return model


def _learn(documents: list[_Document], rng: np.random.Generator) -> Model | None:
    """A machine and its bound on seams, not yet calibrated; None without anything that tells toxic documents."""
    toxic, clean = [d for d in documents if d.toxic], [d for d in documents if not d.toxic]
    if not toxic or not clean:
        return None
    in_toxic, in_clean = Counter(w for d in toxic for w in d.words), Counter(w for d in clean for w in d.words)
    positive = _significant(in_toxic, in_clean, len(toxic), len(clean))
    known = set(positive)
    # insults of two words that are harmless alone
    often, n_pairs = _frequent_pairs(toxic, 3)
    pairs_toxic, pairs_clean = (Counter(p for d in part for p in _pairs(d.lower) & often) for part in (toxic, clean))
    two = [p for p in _significant(pairs_toxic, pairs_clean, len(toxic), len(clean), 0.05, n_pairs) if not any(f"\x01{w}\x01" in known for w in p.strip("\x01").split(" "))]
    two = two[: LANDMARKS // 4]
    rest = [d.words for d in toxic if known.isdisjoint(d.words)]
    positive += _explaining(rest, in_clean, 3) or ([] if positive or two else _explaining(rest, in_clean, 1))
    positive += two
    if not positive:
        return None
    harmless = sorted(w for w, n in in_clean.items() if n >= in_toxic[w])
    ordinary = sorted({p for i in rng.permutation(len(clean))[: NEGATIVES // 20] for p in _pairs(clean[i].lower)} - set(two))
    negative = [harmless[i] for i in rng.permutation(len(harmless))[:NEGATIVES]]
    negative += [ordinary[i] for i in rng.permutation(len(ordinary))[: NEGATIVES // 4]]
    counts = {**in_toxic, **{p: pairs_toxic[p] for p in two}, **dict.fromkeys(ordinary, 1), **{w: in_clean[w] for w in harmless}}
    candidates = sorted({w for w, n in in_toxic.items() if n > 10 * in_clean[w]})
    for turn in range(ROUNDS):
        model = Model(*_machine(positive, negative, counts, len(clean) / len(toxic), rng))
        if turn + 1 == ROUNDS:
            break
        worst = model.windows(harmless)
        hard = np.argsort(-worst)[: NEGATIVES // 4]
        negative = list(dict.fromkeys([*(harmless[i] for i in hard if worst[i] > -1), *negative]))
        scores = dict(zip(candidates, model.windows(candidates), strict=True))
        again = [w for d in toxic for w in heapq.nlargest(PER_DOCUMENT, d.words & scores.keys(), key=lambda w: (scores[w], w)) if scores[w] > 0.5]
        positive = list(dict.fromkeys([*positive, *again]))
    split = [*two, *(a + " " + b for w in positive if w not in two for a, b in _halves(w.strip("\x01")))]
    at_seam = np.array([seams(w, model.weights)[2].max() for w in split] or [0.0])
    usual = np.concatenate([seams(d.lower, model.weights)[2] for d in clean[: NEGATIVES // 20]] + [np.zeros(1)])
    # most split insults, and a tenth of ordinary neighbours at most
    model.seam = float(max(np.quantile(at_seam, 0.1), np.quantile(usual, 0.9), 1e-6))
    return model


def _halves(word: str) -> list[tuple[str, str]]:
    return [(word[:i], word[i:]) for i in range(2, len(word) - 1)]


def _calibrate(model: Model, margins: np.ndarray, y: np.ndarray) -> None:
    """A logistic curve of the worst words' margins and the number of words (Platt: both classes weighing the same, smoothed targets), moved to reach THRESHOLD where the classes part.

    Where a single window is enough: above the margin that a share of ENOUGH of the clean texts reaches.
    """
    n1, n0 = max(1.0, y.sum()), max(1.0, (1 - y).sum())
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y > 0, 0.5 / n1, 0.5 / n0)
    x = np.column_stack([_bounded(margins), np.ones(len(margins))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + RIDGE * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (p - target)) + RIDGE * w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    w[-1] += _AT_THRESHOLD - _split(x @ w, y)
    model.slope, model.factors = 1.0, w
    highest = np.sort(margins[y == 0], axis=0)[::-1][int(ENOUGH * n0) :][:1]
    if len(highest):
        model.alone = tuple(float(max(highest[0, c], 0.0) + 1 / SHARP) for c in (0, TOP))


def _split(margin: np.ndarray, y: np.ndarray) -> float:
    """The margin that parts the classes with the fewest errors, a rejected clean text counting twice; in the middle of its gap."""
    order = np.argsort(margin, kind="stable")
    m, t = margin[order], y[order]
    missed = np.concatenate([[0.0], np.cumsum(t)])
    rejected = np.concatenate([[0.0], np.cumsum((1 - t)[::-1])])[::-1]
    at = int((missed + 2 * rejected).argmin())
    low, high = m[at - 1] if at else m[0] - 1, m[at] if at < len(m) else m[-1] + 1
    return float((low + high) / 2)


def fold(id_col: str, of: int = 3) -> F.Column:
    return F.crc32(F.col(id_col).cast("string")) % of


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_docs: int = TRAIN_DOCS) -> Model:
    """Train on a sample of at most train_docs labelled documents of each class, from the rows whose crc32(id) mod 3 is not 1; of an id's texts the least one is read."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    known = known.where(fold("id") != 1).groupBy("id").agg(F.max("y").alias("y"))
    picked = [known.where(c).orderBy(F.xxhash64("id"), "id").limit(train_docs) for c in ("y = 1", "y = 0")]
    sample = picked[0].unionByName(picked[1])  # 2 * train_docs rows at most
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    rows = texts.groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y"))

    @leaves_nothing
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if parts := list(batches):
            known = pa.Table.from_batches(parts).sort_by("id")
            del parts
            model = apart(lambda: pickle.dumps(train(known["text"].to_pylist(), known["y"].to_pylist())))
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    # in a task, and there apart: what training leaves behind would stay in the driver, or the worker, for as long as that runs
    learnt = rows.coalesce(1).mapInArrow(learn, "model binary").collect()
    return pickle.loads(learnt[0]["model"]) if learnt else train([], [])


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, worst (the window of the highest margin) of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # 64^3 numbers
    source = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    @leaves_nothing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                margins, worst = shared.value.texts([t.as_py() for t in part.column(1)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(shared.value.probability(margins)), pa.array(worst, pa.string())], names=["doc_id", "score", "worst"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double, worst string")


def drop_toxic(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of df that score below the threshold, with all columns of df."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for texts in batches:
                out = [shared.value.texts(texts.iloc[lo : lo + 256].tolist())[0] for lo in range(0, len(texts), 256)]
                yield pd.Series(shared.value.probability(np.concatenate(out)) if out else [], dtype="float64")
        finally:
            give_back()

    return df.where(probability(F.col(text_col)) < threshold)
