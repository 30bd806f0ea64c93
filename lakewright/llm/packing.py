"""Best-two-fit packing of token pieces into fixed-length sequences.

Best-two-fit: fill a bin greedily with the longest piece that still fits; when
none fits, replace the bin's smallest piece by two unpacked pieces that fill the
expanded gap more tightly, if there are such.

Pieces of one length are interchangeable, so the rule runs on the histogram of
lengths alone: at most `capacity` counts, whatever the size of the corpus. A
bin pattern repeats as often as its counts allow before the rule is asked again,
so the plan has at most a few patterns per length, each with a multiplicity.
Pieces then find their place by their rank within their length. Only the
histogram reaches the driver and only the plan (bounded by capacity, not by the
corpus) is broadcast.

Null text is empty: a document of one end token. Longer documents than the
capacity are cut, the first piece taking the remainder. Null and repeated ids
are packed like any row. An empty table packs into nothing.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .memory import leaves_nothing
from .runtime import materialise

CAPACITY = 1024
END_TOKEN = 2


def _byte_of() -> dict[str, int]:
    """Inverse of the printable alphabet that byte-level BPE files write bytes in."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """A function text -> uint32 ids, equal to tokenizers' encode(add_special_tokens=False).

    The byte-level BPE vocabulary is run by tiktoken, whose ids are the same (tested)
    at about six times the speed; texts that hold an added token go to tokenizers itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    spec = json.load(open(path, encoding="utf-8"))
    added = {t["content"] for t in spec["added_tokens"]}
    byte = _byte_of()
    ranks = {bytes(byte[c] for c in tok): i for tok, i in spec["model"]["vocab"].items() if tok not in added}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    slow = lru_cache(maxsize=1)(lambda: Tokenizer.from_file(path))  # as few texts need it

    def encode(text: str) -> np.ndarray:
        if any(a in text for a in added):
            return np.array(slow().encode(text, add_special_tokens=False).ids, "<u4")
        return fast.encode_to_numpy(text).astype("<u4", copy=False)

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, preceded by the remainder."""
    first = n % capacity
    return ([(0, first)] if first else []) + [(s, capacity) for s in range(first, n, capacity)]


def pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_token: int = END_TOKEN) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and (part, local): the rank of the piece among its length in its task."""
    source = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    @leaves_nothing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, part = tokenizer(tokenizer_path), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        end = np.array([end_token], "<u4")
        for batch in batches:
            rows, out = [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.concatenate([encode(text.as_py()), end])
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append(i)
                    out.append((k, start, length, zlib.crc32(ids[start : start + length].tobytes()), part, seen[length]))
                    seen[length] += 1
            if rows:
                c = [np.array(x) for x in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(c[0].astype("i4")), *(pa.array(x.astype("i8")) for x in c[1:4]), pa.array(c[4].astype("i4")), pa.array(c[5].astype("i8"))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"],
                )

    return source.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, local long")


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(multiplicity, lengths in the bin) of a packing of counts[length] pieces of each length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is outside 1..{capacity}")
        left[length] = n
    plan = []
    while left.any():
        now, content, gap = left.copy(), [], capacity
        while (fits := np.flatnonzero(now[: gap + 1])).size:
            content.append(int(fits[-1]))
            now[fits[-1]] -= 1
            gap -= int(fits[-1])
        if gap and len(content) > 1 and (pair := _tightest_pair(now, content[-1] + gap, content[-1])):
            content[-1:] = pair
        used = np.bincount(content, minlength=capacity + 1)
        times = int((left[used > 0] // used[used > 0]).min())
        left -= times * used
        plan.append((times, content))
    return plan


def _tightest_pair(left: np.ndarray, room: int, more_than: int) -> list[int] | None:
    """Two remaining lengths whose sum is the largest within (more_than, room]; the longer first."""
    have = np.flatnonzero(left[: room + 1])
    if not have.size:
        return None
    # the longest partner of each length that keeps the sum within room
    at = np.searchsorted(have, room - have, side="right") - 1
    ok = at >= 0
    # a length needs two pieces to pair with itself; else it takes the next shorter one
    same = ok & (have[np.maximum(at, 0)] == have) & (left[have] < 2)
    at = at - same
    ok &= at >= 0
    if not ok.any():
        return None
    total = np.where(ok, have + have[np.maximum(at, 0)], 0)
    i = int(total.argmax())
    if total[i] <= more_than:
        return None
    return sorted((int(have[i]), int(have[at[i]])), reverse=True)


def slots(plan: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first rank, offset): where the pieces of a length go, by rank."""
    out, used, sequence = [], {}, 0
    for times, content in plan:
        offset = 0
        for length in content:
            first = used.get(length, 0)
            out.append((length, first, first + times - 1, sequence, offset))
            used[length] = first + times
            offset += length
        sequence += times
    return out


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows with (length, part, local), where (part, length, local) is unique and local counts from 0."""
    spark = cut_pieces.sparkSession
    made = materialise(cut_pieces, "pieces")
    counts = materialise(made.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = slots(best_two_fit(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = made.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("local"))
    # all slots of a length in one row, so that a piece finds its own by the number of slots that begin no later
    by_length: dict[int, list] = {}
    for length, first, _, sequence, offset in plan:
        by_length.setdefault(length, []).append((first, sequence, offset))
    rows = [(length, *map(list, zip(*sorted(found), strict=True))) for length, found in by_length.items()]
    places = spark.createDataFrame(rows, "length long, firsts array<long>, sequences array<long>, offsets array<long>")
    at = F.size(F.filter("firsts", lambda x: x <= F.col("rank"))) - 1
    placed = ranked.join(F.broadcast(places), "length").withColumn("at", at)
    sequence = F.get("sequences", F.col("at")) + F.col("rank") - F.get("firsts", F.col("at"))
    return placed.select(*(c for c in made.columns if c not in ("part", "local")), sequence.alias("sequence_id"), F.get("offsets", F.col("at")).alias("offset"))


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_token: int = END_TOKEN) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    return pack(pieces(df, tokenizer_path, id_col, text_col, capacity, end_token), capacity)
