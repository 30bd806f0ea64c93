"""Language-model scores from Elias-Fano n-gram tries.

Tokens: words (runs of bytes outside [\\x20\\x09-\\x0D], A-Z lower-cased), then one
end token; the context of a text's first token is an end token. The model is a
word bigram over the training vocabulary and one class of unknown words:

    p(w | v) = (1 - U) * c(v w) / c(v) + U * p(w),   p(w) alone where v is unknown,
    p(w) = (c(w) - d) / N,   p(unknown) = d * V / N,   d = n1 / (n1 + 2 * n2)

with n1 and n2 the words seen once and twice; it sums to 1 for every context.

Plan. Texts are read once into chunks of about CHUNK_TOKENS tokens: a row with
the chunk's word hashes and its tokens as places among them. Words go to shards by hash and
come back with their counts; pairs go to cells of a grid (context hash by
successor hash, so a frequent context is spread over a row of cells) as
per-chunk distinct pairs. A cell adds up its pairs, builds a trie (monotone
pointers and context-relative successors, both Elias-Fano, quantised joint
probabilities), maps it into memory and answers each chunk's pairs by
successor search. Words' counts and pairs' probabilities meet in the chunk,
where the model interpolates them. Each chunk then scores its documents. A word or pair has one
entry a chunk at most, however frequent it is, and a chunk as many rows as it has pairs at most; shards and cells grow in number
with the corpus, without a limit; no vocabulary, count table or document is collected.

Null and empty texts are the end token alone. A very long text is a chunk of
its own size. Rows that repeat an id are learnt and scored each. Null ids are
training rows (they have no remainder). Without training tokens all words are
unknown, with probability 1. An empty table gives an empty result. Other
columns are never read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .elias_fano import NONE, STEP, Trie
from .runtime import materialise
from .words import split_words

CHUNK_TOKENS, CELL_CHARS, UNIGRAM = 800_000, 14_000_000, 0.7
END = b"\n"
FOLDS, HELD = 5, 1
#: Bits of a word's hash that the grid may use: more cells than any corpus needs.
_HASH_BITS = 32


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD


class _Local(dict):
    """word -> its number in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _pack(a: np.ndarray) -> bytes:
    """An array's bytes, by significance, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


_CHUNK = "chunk long, hashes binary, tops binary, tokens binary, end int, ids array<long>, held array<boolean>, sizes array<long>, train_tokens long"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _chunks(df: DataFrame) -> DataFrame:
    """One row per chunk of df (doc_id, text): sorted word hashes, tokens as places among them, the place of the end token, documents."""

    def finish(number: int, ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        local = _Local()
        end = local[END]
        sizes = [len(t) + 1 for t in texts]
        tokens = np.fromiter((local[w] for t in texts for w in (*t, END)), np.uint32, sum(sizes))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, local), np.uint64, len(local))
        order = np.argsort(hashes)
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        held = [held_out(i) for i in ids]
        row = {
            "chunk": number, "hashes": hashes[order].tobytes(), "tops": _pack((hashes[order] >> np.uint64(64 - _HASH_BITS)).astype(np.uint32)), "tokens": _pack(place[tokens]), "end": int(place[end]),
            "ids": ids, "held": held, "sizes": sizes, "train_tokens": sum(n for n, h in zip(sizes, held, strict=True) if not h),
        }
        return pa.RecordBatch.from_pylist([row], _schema(_CHUNK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                texts.append(split_words(text.as_py()))
                size += len(texts[-1]) + 1
                if size >= CHUNK_TOKENS:
                    yield finish(part << 24 | k, ids, texts)
                    ids, texts, size, k = [], [], 0, k + 1
        if ids:
            yield finish(part << 24 | k, ids, texts)

    return df.mapInArrow(run, _CHUNK)


class _Pairs:
    """The distinct (context, successor) pairs of a chunk in the order of the grid's cells, and the pair of each token."""

    def __init__(self, tokens: np.ndarray, end: int, tops: np.ndarray, bits: int):
        n = len(tops)
        before = np.append(np.uint32(end), tokens[:-1]).astype(np.int64)
        keys, inverse = np.unique(before * n + tokens, return_inverse=True)
        v, w = keys // n, keys % n
        shift = _HASH_BITS - bits
        cell = (tops[v].astype(np.int64) >> shift << bits) | (tops[w].astype(np.int64) >> shift)
        # keys are in order of context, then successor, both by hash; a stable sort keeps that within a cell
        order = np.argsort(cell, kind="stable")
        self.v, self.w, self.cell = v[order], w[order], cell[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.of_token = place[inverse]


def _train_mask(row: dict) -> np.ndarray:
    return np.repeat(~np.array(row["held"], bool), row["sizes"])


_WORDS = "chunk long, shard long, words binary, counts binary"
_CELLS = "chunk long, cell long, contexts binary, runs binary, successors binary, counts binary"


def _word_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, tokens = np.frombuffer(row["hashes"], np.uint64), _unpack(row["tokens"], "<u4")
                counts = np.bincount(tokens[_train_mask(row)], minlength=len(hashes)).astype(np.uint32)
                shard, begin = np.unique((hashes >> np.uint64(64 - bits)).astype(np.int64), return_index=True)
                rows = [{"chunk": row["chunk"], "shard": s, "words": hashes[a:b].tobytes(), "counts": _pack(counts[a:b])} for s, a, b in zip(shard.tolist(), begin.tolist(), [*begin[1:].tolist(), len(hashes)], strict=True)]
                yield pa.RecordBatch.from_pylist(rows, _schema(_WORDS))

    return run


def _pair_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, tokens = np.frombuffer(row["hashes"], np.uint64), _unpack(row["tokens"], "<u4")
                pairs = _Pairs(tokens, row["end"], _unpack(row["tops"], "<u4"), bits)
                counts = np.bincount(pairs.of_token[_train_mask(row)], minlength=len(pairs.v)).astype(np.uint32)
                # cells that the chunk has pairs in: as many rows as there are pairs at most, however many cells there are
                cells, begin = np.unique(pairs.cell, return_index=True)
                rows = []
                for c, a, b in zip(cells.tolist(), begin.tolist(), [*begin[1:].tolist(), len(pairs.cell)], strict=True):
                    if a < b:
                        v = pairs.v[a:b]
                        first = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
                        runs = np.diff(np.append(first, len(v))).astype(np.uint32)
                        fingerprints = (hashes[pairs.w[a:b]] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                        rows.append({"chunk": row["chunk"], "cell": c, "contexts": hashes[v[first]].tobytes(), "runs": _pack(runs), "successors": fingerprints.tobytes(), "counts": _pack(counts[a:b])})
                        if len(rows) >= 64:
                            yield pa.RecordBatch.from_pylist(rows, _schema(_CELLS))
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _schema(_CELLS))

    return run


def _add_up(group: pd.DataFrame) -> pd.DataFrame:
    """A shard's words over all chunks: to each chunk its words' totals; the shard's words in training, once and twice there, go with the first."""
    words = np.concatenate([np.frombuffer(w, np.uint64) for w in group["words"]])
    ends = np.cumsum([0, *(len(w) // 8 for w in group["words"])])
    _, place = np.unique(words, return_inverse=True)
    totals = np.bincount(place, np.concatenate([_unpack(c, "<u4") for c in group["counts"]])).astype(np.int64)
    found = [int(x.sum()) for x in (totals > 0, totals == 1, totals == 2)]
    more = len(group) - 1
    return pd.DataFrame({
        "chunk": group["chunk"], "part": group["shard"], "answer": [_pack(totals[place[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)],
        "distinct": [found[0], *[0] * more], "once": [found[1], *[0] * more], "twice": [found[2], *[0] * more],
    })


def _answer(n_tokens: int):
    """A cell: the trie of its pairs in training, and each chunk's codes from it."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        contexts = [np.frombuffer(c, np.uint64) for c in group["contexts"]]
        runs = [_unpack(r, "<u4").astype(np.int64) for r in group["runs"]]
        successors = [np.frombuffer(s, np.uint32) for s in group["successors"]]
        counts = np.concatenate([_unpack(c, "<u4") for c in group["counts"]]).astype(np.int64)
        v, w = np.concatenate([np.repeat(c, r) for c, r in zip(contexts, runs, strict=True)]), np.concatenate(successors)
        learnt = np.flatnonzero(counts)
        order = learnt[np.lexsort((w[learnt], v[learnt]))]
        new = np.append(True, (v[order][1:] != v[order][:-1]) | (w[order][1:] != w[order][:-1])) if order.size else np.empty(0, bool)
        n = np.add.reduceat(counts[order], np.flatnonzero(new)) if order.size else np.empty(0, np.int64)
        trie = Trie.build(v[order][new], w[order][new], n / max(1, n_tokens)).mapped()
        del v, w, order
        answers = []
        for c, r, s in zip(contexts, runs, successors, strict=True):
            answers.append(_pack(trie.lookup(c, r, s)))
        return pd.DataFrame({"chunk": group["chunk"], "part": group["cell"], "answer": answers})

    return run


def _score_chunk(n_tokens: int, distinct: int, once: int, twice: int, bits: int):
    discount = once / (once + 2 * twice) if once else 0.5
    log_base = math.log10(n_tokens + 0.5 * (distinct + 1))
    unknown = discount * distinct / n_tokens if n_tokens else 1.0

    def run(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = chunk.iloc[0]
        size, ids = np.asarray(row["sizes"], np.int64), list(row["ids"])
        tokens, tops = _unpack(row["tokens"], "<u4"), _unpack(row["tops"], "<u4")
        ordered = answers.sort_values("part")
        totals = np.concatenate([_unpack(a, "<i8") for a in ordered["answer"][~ordered["is_pair"]]])
        codes = np.concatenate([_unpack(a, "<u2") for a in ordered["answer"][ordered["is_pair"]]])
        pairs = _Pairs(tokens, row["end"], tops, bits)
        p1 = np.where(totals > 0, (totals - discount) / max(1, n_tokens), unknown)
        joint = np.where(codes == NONE, 0.0, 10.0 ** (-codes.astype(np.float64) / STEP))
        context = totals[pairs.v] / max(1, n_tokens)
        p2 = np.where(context > 0, (1 - UNIGRAM) * joint / np.maximum(context, 1e-300) + UNIGRAM * p1[pairs.w], p1[pairs.w])
        doc, n = np.repeat(np.arange(len(ids)), size), len(ids)
        return pd.DataFrame({
            "doc_id": pd.array(ids, "Int64"), "held_out": list(row["held"]), "n_tokens": size,
            "n_known": np.bincount(doc, (totals > 0)[tokens], n).astype(np.int64), "train_tokens": n_tokens,
            "base_score": np.bincount(doc, np.log10(totals + 0.5)[tokens], n) - size * log_base,
            "score": np.bincount(doc, np.log10(np.minimum(p2, 1.0))[pairs.of_token], n),
        })

    return run


def scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; learns from rows that aren't held out."""
    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    # a grid of 2^bits by 2^bits cells, and as many shards of words
    bits = max(1, math.ceil(math.log2(max(1, chars / CELL_CHARS)) / 2))
    made = materialise(_chunks(source), "lm-chunks")
    n_tokens = made.agg(F.sum("train_tokens")).first()[0] or 0
    words = made.select("chunk", "hashes", "tokens", "held", "sizes").mapInArrow(_word_rows(2 * bits), _WORDS).groupBy("shard").applyInPandas(_add_up, "chunk long, part long, answer binary, distinct long, once long, twice long")
    words = materialise(words, "lm-words")
    distinct, once, twice = (x or 0 for x in words.agg(F.sum("distinct"), F.sum("once"), F.sum("twice")).first())
    cells = made.select("chunk", "hashes", "tops", "tokens", "end", "held", "sizes").mapInArrow(_pair_rows(bits), _CELLS).groupBy("cell").applyInPandas(_answer(n_tokens), "chunk long, part long, answer binary")
    cells = materialise(cells, "lm-pairs")
    answers = words.select("chunk", "part", "answer", F.lit(False).alias("is_pair")).unionByName(cells.withColumn("is_pair", F.lit(True)))
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    chunks = made.select("chunk", "tops", "tokens", "end", "ids", "held", "sizes")
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_score_chunk(n_tokens, distinct, once, twice, bits), out)
