"""Elias-Fano sequences and a two-level n-gram trie in flat, memory-mapped arrays."""

from __future__ import annotations

import json
import os
import tempfile

import numpy as np

#: log10 probabilities are stored as multiples of 1 / STEP below 0; NONE is "not there".
STEP, NONE = 6000, 0xFFFF
_SLICE = 65_536


class EliasFano:
    """A monotone sequence: the low bits of all values packed one after the other, the high bits in unary with a count of ones per 64-bit word."""

    def __init__(self, low: np.ndarray, high: np.ndarray, ones: np.ndarray, low_bits: int, n: int):
        self.low, self.high, self.ones, self.low_bits, self.n = low, high, ones, low_bits, n

    @staticmethod
    def encode(values: np.ndarray) -> EliasFano:
        """values: unsigned and in order."""
        values, n = values.astype(np.uint64), len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (max(1, top) // max(1, n)).bit_length() - 1)
        packed = np.zeros(-(-n * low_bits // 64) + 1, np.uint64)
        if low_bits and n:
            low = values & np.uint64((1 << low_bits) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(packed, word, low << shift)
            over = np.flatnonzero(shift + np.uint64(low_bits) > np.uint64(64))
            np.bitwise_or.at(packed, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(at[-1]) // 64 + 1 if n else 1) * 64, bool)
        bits[at] = True
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.append(0, np.cumsum(np.bitwise_count(high), dtype=np.uint32)).astype(np.uint32)
        return EliasFano(packed, high, ones, low_bits, n)

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        # a shift by 64 in two steps, as one of 64 isn't defined
        both = (self.low[word] >> shift) | (self.low[np.minimum(word + 1, len(self.low) - 1)] << np.uint64(1) << (np.uint64(63) - shift))
        return both & np.uint64((1 << self.low_bits) - 1)

    def _joined(self, high: np.ndarray, i: np.ndarray) -> np.ndarray:
        return (high.astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i) if self.low_bits else high.astype(np.uint64)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        out = np.empty(len(i), np.uint64)
        for lo in range(0, len(i), _SLICE):
            k = i[lo : lo + _SLICE]
            word = np.searchsorted(self.ones, k, side="right") - 1
            bits = np.unpackbits(self.high[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            nth = (k - self.ones[word] + 1).astype(np.uint8)
            place = (np.cumsum(bits, axis=1, dtype=np.uint8) == nth[:, None]).argmax(axis=1)
            out[lo : lo + _SLICE] = self._joined(word.astype(np.int64) * 64 + place - k, k)
        return out

    def decode(self) -> np.ndarray:
        """All values, in order."""
        places = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[: self.n]
        i = np.arange(self.n)
        return self._joined(places - i, i)


class Trie:
    """Contexts (sorted hashes), monotone pointers to their successors, the successors' 32-bit fingerprints (sorted within their context and made one
    monotone sequence by adding 2^32 for each context before theirs), and a quantised log10 probability each."""

    def __init__(self, contexts: np.ndarray, pointers: EliasFano, successors: EliasFano, log_p: np.ndarray):
        self.contexts, self.pointers, self.successors, self.log_p = contexts, pointers, successors, log_p
        self.decoded: np.ndarray | None = None

    @staticmethod
    def build(contexts: np.ndarray, successors: np.ndarray, p: np.ndarray) -> Trie:
        """From distinct (context, successor) pairs in order, with their probabilities."""
        first = np.flatnonzero(np.append(True, contexts[1:] != contexts[:-1])) if len(contexts) else np.empty(0, np.int64)
        code = np.minimum(np.rint(-np.log10(np.maximum(p, 1e-300)) * STEP), NONE - 1).astype(np.uint16)
        rank = np.repeat(np.arange(len(first), dtype=np.uint64), np.diff(np.append(first, len(contexts))))
        monotone = (rank << np.uint64(32)) + successors.astype(np.uint64)
        return Trie(contexts[first], EliasFano.encode(np.append(first, len(contexts))), EliasFano.encode(monotone), code)

    def lookup(self, contexts: np.ndarray, runs: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Codes of queries: each context is followed by its run of successors; NONE for pairs the trie doesn't have."""
        out = np.full(len(successors), NONE, np.uint16)
        if not len(self.contexts) or not len(successors):
            return out
        node = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
        known = self.contexts[node] == contexts
        begin, end = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        begin[known], end[known] = self.pointers.access(node[known]), self.pointers.access(node[known] + 1)
        if self.decoded is None:  # once a cell, whatever the number of queries
            self.decoded = (self.successors.decode() & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        # successor search: the first in the context's range that isn't below the wanted one
        lo, hi = np.repeat(begin, runs), np.repeat(end, runs)
        stop, active = hi.copy(), np.flatnonzero(lo < hi)
        while active.size:
            a, b = lo[active], hi[active]
            mid = (a + b) >> 1
            less = self.decoded[mid] < successors[active]
            lo[active], hi[active] = np.where(less, mid + 1, a), np.where(less, b, mid)
            active = active[lo[active] < hi[active]]
        inside = np.flatnonzero(lo < stop)
        hit = inside[self.decoded[lo[inside]] == successors[inside]]
        out[hit] = self.log_p[lo[hit]]
        return out

    def dump(self) -> bytes:
        """All arrays one after the other behind a JSON header."""
        arrays, head, at = [], {}, 0
        parts = [("contexts", self.contexts), ("log_p", self.log_p)]
        for level in ("pointers", "successors"):
            sequence = getattr(self, level)
            head[level] = [sequence.low_bits, sequence.n]
            parts += [(f"{level}_{x}", getattr(sequence, x)) for x in ("low", "high", "ones")]
        for name, a in parts:
            raw = np.ascontiguousarray(a).tobytes()
            head[name] = [str(a.dtype), at, len(a)]
            arrays.append(raw + b"\0" * (-len(raw) % 8))
            at += len(arrays[-1])
        text = json.dumps(head).encode()
        text += b" " * (-len(text) % 8)
        return len(text).to_bytes(8, "little") + text + b"".join(arrays)

    def mapped(self) -> Trie:
        """The same trie over a memory-mapped file of the task's own, which is gone when its arrays are."""
        data = self.dump()
        fd, name = tempfile.mkstemp(suffix=".trie")
        with os.fdopen(fd, "wb") as f:
            f.write(data)
        whole = np.memmap(name, np.uint8, "r")
        os.unlink(name)
        size = int.from_bytes(data[:8], "little")
        head, base = json.loads(data[8 : 8 + size]), 8 + size

        def part(key: str) -> np.ndarray:
            kind, at, n = head[key]
            return whole[base + at : base + at + n * np.dtype(kind).itemsize].view(kind)

        def sequence(level: str) -> EliasFano:
            return EliasFano(*(part(f"{level}_{x}") for x in ("low", "high", "ones")), *head[level])

        return Trie(part("contexts"), sequence("pointers"), sequence("successors"), part("log_p"))
