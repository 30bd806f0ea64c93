"""Benchmark decontamination by SimHash of item-sized windows.

Each window of a document that is as long (in words) as a benchmark item gets a
128-bit SimHash of its words; a multi-index of eight 16-bit blocks finds every
item within RADIUS bits (two fingerprints that differ in at most 31 bits differ
in at most 3 in one of the blocks; an item is listed under every value within
one bit of its block, and every value within two bits of a window's block is
looked up); candidates are then verified by the exact weighted Jaccard
similarity of five-word shingles, each weighing as often as it occurs: sum of
minima over sum of maxima, SIMILARITY or more.

Windows that hold too few shingles of the items of their length to reach the similarity (two
sets of a and b shingles need SIMILARITY / (1 + SIMILARITY) * (a + b) in common)
aren't fingerprinted; that loses nothing.

The benchmark is the query set: its items are indexed on the driver and
broadcast in blocks of BLOCK items, one pass over the documents each. Null or
wordless items and documents match nothing. Items of fewer than five words are
one shingle. Documents shorter than an item are one window. Very long texts are
scanned whole. Repeated rows are reported each; repeated items once by id and
text. Ties between windows go to the earliest. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import give_back
from .words import WordHashes, hash_words, mix, shingles, split_words

BLOCK, RADIUS, SIMILARITY, WORDS = 20_000, 31, 0.75, 5
#: Bits by which a value that is looked up may differ from a window's block, and an item's from a value that it is listed under; both together are 31 // 8.
LOOKED_UP, LISTED = 2, 1
_FILTER_BITS = 22


def _signs(hashes: np.ndarray) -> np.ndarray:
    """128 signs (+1, -1) of each word."""
    two = np.column_stack([mix(hashes + np.uint64(1)), mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))])
    return np.unpackbits(two.view(np.uint8), axis=1).astype(np.int32) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """Sums of signs (n x 128) -> n x 8 blocks of 16 bits."""
    return np.packbits(sums > 0, axis=1).view(np.uint16)


@lru_cache(maxsize=2)
def _near_values(radius: int) -> np.ndarray:
    """All 16-bit numbers with at most `radius` bits set."""
    x = np.arange(1 << 16, dtype=np.uint16)
    return x[np.bitwise_count(x) <= radius]


class Index:
    """The items of one block."""

    def __init__(self, items: list[tuple[int, str]]):
        memo = WordHashes()
        self.ids, lengths, prints, known, counts, self.short = [], [], [], [], [], set()
        for item_id, text in items:
            h = hash_words(split_words(text), memo)
            if not len(h):
                continue
            bag, n = np.unique(shingles(h, WORDS), return_counts=True)
            self.ids.append(item_id)
            lengths.append(len(h))
            known.append(bag)
            counts.append(n.astype(np.int32))
            prints.append(_fingerprints(_signs(h).sum(axis=0)[None, :])[0])
            if len(h) < WORDS:
                self.short.add(len(h))
        self.lengths = np.array(lengths, np.int32)
        self.prints = np.array(prints, np.uint16).reshape(-1, 8)
        # the items' shingles, sorted within each item, with how often they occur
        self.ends = np.cumsum([0, *map(len, known)])
        self.shingles = np.concatenate([*known, np.empty(0, np.uint64)])
        self.counts = np.concatenate([*counts, np.empty(0, np.int32)])
        # the lengths of the items that hold a shingle, in order of shingles
        self.known, place = np.unique(self.shingles, return_inverse=True)
        self.longest = int(self.lengths.max(initial=0))
        held = np.unique(place * (self.longest + 1) + np.repeat(self.lengths, np.diff(self.ends)))
        self.lengths_from = np.searchsorted(held // (self.longest + 1), np.arange(len(self.known) + 1))
        self.lengths_of = (held % (self.longest + 1)).astype(np.int32)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[self.known >> np.uint64(64 - _FILTER_BITS)] = True
        # per block of the fingerprint: items in order of the values they are listed under, the bit changed for that, and where each value starts
        self.tables = []
        for b in range(8):
            values = (self.prints[:, b][:, None] ^ _near_values(LISTED)[None, :]).ravel()
            order = np.argsort(values, kind="stable")
            starts = np.searchsorted(values[order], np.arange((1 << 16) + 1)).astype(np.int32)
            items, changed = order // len(_near_values(LISTED)), _near_values(LISTED)[order % len(_near_values(LISTED))]
            self.tables.append((starts, starts[1:] > starts[:-1], items.astype(np.int32), changed))

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs whose fingerprints differ in at most RADIUS bits: all of them.

        Every value within LOOKED_UP bits of a window's block is looked up. Of
        the ways to split three bits the one that lists by the lowest is taken.
        """
        pairs = [np.empty(0, np.int64)]
        near = _near_values(LOOKED_UP)
        lowest, whole = near & (~near + np.uint16(1)), np.bitwise_count(near) == LOOKED_UP
        for at in range(0, len(prints), 512):
            part = prints[at : at + 512]
            for b, (starts, listed, items_of, changed) in enumerate(self.tables):
                values = (part[:, b][:, None] ^ near[None, :]).ravel()
                full = np.flatnonzero(listed[values])
                lo = starts[values[full]].astype(np.int64)
                n = starts[values[full].astype(np.int32) + 1] - lo
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
                of = np.repeat(full, n)
                once = (changed[place] == 0) | (whole[of % len(near)] & (changed[place] < lowest[of % len(near)]))
                window, items = of[once] // len(near) + at, items_of[place[once]]
                ok = np.bitwise_count(prints[window] ^ self.prints[items]).sum(axis=1) <= RADIUS
                pairs.append(window[ok] * np.int64(len(self.ids)) + items[ok])
        pair = np.unique(np.concatenate(pairs))
        return pair // max(1, len(self.ids)), pair % max(1, len(self.ids))

    def similarity(self, window: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of a window's word hashes and an item."""
        bag, n = np.unique(shingles(window, WORDS), return_counts=True)
        own, m = self.shingles[self.ends[item] : self.ends[item + 1]], self.counts[self.ends[item] : self.ends[item + 1]]
        place = np.minimum(np.searchsorted(own, bag), len(own) - 1)
        both = int(np.minimum(n, m[place])[own[place] == bag].sum())
        return both / (int(n.sum()) + int(m.sum()) - both)

    def hits(self, h: np.ndarray, size: int) -> np.ndarray:
        """Known shingles in a document: its place times (longest + 1) plus the length of an item that holds it, for each such length."""
        s = shingles(h, size)
        at = np.flatnonzero(self.maybe[s >> np.uint64(64 - _FILTER_BITS)])
        place = np.minimum(np.searchsorted(self.known, s[at]), len(self.known) - 1)
        right = self.known[place] == s[at]
        at, place = at[right], place[right]
        lo = self.lengths_from[place]
        n = self.lengths_from[place + 1] - lo
        lengths = self.lengths_of[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
        return np.repeat(at, n) * (self.longest + 1) + lengths

    def matches(self, h: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """item -> (similarity, first word, words) of its most similar window in a document's word hashes."""
        found: dict[int, tuple[float, int, int]] = {}
        if not len(h) or not self.ids:
            return found
        hits = np.unique(np.concatenate([self.hits(h, WORDS), *(self.hits(h, n) for n in self.short if n < len(h))]))
        if not hits.size:
            return found
        longest = self.longest
        at, lengths = hits // (longest + 1), hits % (longest + 1)
        # stretches of the document that windows with a hit can cover
        first, last = np.maximum(at - longest, 0), np.minimum(at + longest + WORDS, len(h))
        cut = np.flatnonzero(first[1:] > last[:-1])
        for lo, hi in zip(first[np.append(0, cut + 1)], last[np.append(cut, len(at) - 1)], strict=True):
            for piece in range(lo, hi, 4096):  # bounded memory in texts that are all hits
                stop = min(hi, piece + 4096 + longest)
                own = slice(*np.searchsorted(at, (piece, stop)))
                self._scan(h, piece, stop, at[own], lengths[own], found)
        return found

    def _scan(self, h: np.ndarray, lo: int, hi: int, own: np.ndarray, lengths: np.ndarray, found: dict) -> None:
        sums = None
        for n in np.unique(lengths).tolist():
            size = min(n, hi - lo)
            held, wanted = max(1, size - WORDS + 1), max(1, n - WORDS + 1)
            least = math.ceil(SIMILARITY / (1 + SIMILARITY) * (held + wanted) - 1e-9)
            # windows with enough hits inside
            places = own[lengths == n] - lo
            if len(places) < least:
                continue
            known = np.zeros(hi - lo + 1, np.int32)
            known[places + 1] = 1
            np.cumsum(known, out=known)
            starts = np.arange(hi - lo - size + 1)
            starts = starts[known[starts + held] - known[starts] >= least]
            if not starts.size:
                continue
            if sums is None:
                sums = np.zeros((hi - lo + 1, 128), np.int32)
                np.cumsum(_signs(h[lo:hi]), axis=0, out=sums[1:])
            windows, items = self.within(_fingerprints(sums[starts + size] - sums[starts]))
            right = self.lengths[items] == n
            for w, i in zip(windows[right].tolist(), items[right].tolist(), strict=True):
                start = lo + int(starts[w])
                similarity = self.similarity(h[start : start + size], i)
                if similarity >= SIMILARITY and (i not in found or similarity > found[i][0]):
                    found[i] = (similarity, start, size)


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, similarity, start_word, n_words: the most similar window of every document and item that are similar enough."""
    source = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = source.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    out = None
    for shared in _indexes(items):
        part = source.mapInArrow(_matcher(shared, benchmark.select(item_col).schema), f"doc_id {kinds[0]}, item_id {kinds[1]}, similarity double, start_word long, n_words int")
        out = part if out is None else out.unionByName(part)
    return out


def _indexes(items: DataFrame) -> Iterator:
    """A broadcast index for each block of items (item_id, text): the benchmark is the query set, a block has BLOCK items or so."""
    blocks = max(1, -(-items.count() // BLOCK))
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        yield items.sparkSession.sparkContext.broadcast(Index([(r["item_id"], r["text"]) for r in block]))


def _matcher(shared, item_schema):
    from pyspark.sql.pandas.types import to_arrow_schema

    item_type = to_arrow_schema(item_schema).field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, memo = shared.value, WordHashes()
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column(1)):
                for item, (similarity, start, size) in sorted(index.matches(hash_words(split_words(text.as_py()), memo)).items()):
                    rows.append(i)
                    found.append((index.ids[item], similarity, start, size))
            if rows:
                ids, similarity, start, size = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(ids, item_type), pa.array(similarity, pa.float64()), pa.array(start, pa.int64()), pa.array(size, pa.int32())],
                    names=["doc_id", "item_id", "similarity", "start_word", "n_words"],
                )

    return run


def drop_contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of df that hold no benchmark item, with all columns of df; each row is judged by its own text, whatever its id."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    for shared in _indexes(items):
        df = df.where(~_holds(shared)(F.col(text_col)))
    return df


def _holds(shared):
    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = WordHashes()
        try:
            for texts in batches:
                yield pd.Series([bool(shared.value.matches(hash_words(split_words(t), memo))) for t in texts], dtype=bool)
        finally:
            memo.clear()
            give_back()

    return holds
