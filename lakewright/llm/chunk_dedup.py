"""Substring dedup by content-defined chunking with a gear rolling hash.

The gear hash of a position is a sum of per-byte random numbers, each shifted
by its age, so it sees the last 32 bytes only. An anchor is a position whose
hash is the least of some WINDOW neighbouring positions; it stands for the SEED
bytes that end there, compared by 128-bit digest. WINDOW + SEED - 1 bytes that
two texts share hold the same anchor in both, whatever is around them, and seeds
of neighbouring anchors overlap. A run of neighbouring duplicate seeds is then extended
byte by byte, to both sides, to the last word's edge that equals the first occurrence; runs of
at least MIN_SPAN bytes are duplicate spans. The first occurrence (smallest id, then position) is kept.

Null and empty texts have no anchors. Texts shorter than MIN_SPAN have no spans;
exact copies of longer texts are one span. Very long texts are read whole.
A seed that recurs within its own text is a duplicate as well. Null ids sort
first; rows that repeat an id are told apart by their text, and rows that
repeat both count once. Empty tables give empty results. Other columns are
never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import hot_and_cold, materialise

RADIUS, MAX_CHUNK, MIN_SPAN = 24, 512, 120
#: A passage of MIN_SPAN bytes has an anchor: WINDOW + SEED - 1 is MIN_SPAN; WINDOW < SEED, so seeds overlap. CONTEXT: bytes that a run can be extended by.
SEED, WINDOW, CONTEXT = 64, 57, 96
_GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(data: bytes) -> np.ndarray:
    """The gear hash after each byte: the sum over the last 32 bytes of gear[byte] << age."""
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for span in (1, 2, 4, 8, 16):
        older = h[:-span] << np.uint32(span)
        h = h.copy()
        h[span:] += older
    return h


def _least_of_next(h: np.ndarray, n: int) -> np.ndarray:
    """Minimum of h[i : i + n], the end padded with the largest number."""
    h, span = np.append(h, np.full(n, 0xFFFFFFFF, np.uint32)), 1
    while 2 * span <= n:
        h[:-span] = np.minimum(h[:-span], h[span:])
        span *= 2
    return np.minimum(h[:-n], h[n - span : len(h) - span])


def boundaries(data: bytes) -> np.ndarray:
    """Ends of the chunks, the text's end last."""
    if not data:
        return np.empty(0, np.int64)
    h = gear_hashes(data)
    if len(h) <= 2 * RADIUS + 1:
        return np.array([len(data)])
    least = _least_of_next(h, RADIUS)  # of i .. i + RADIUS - 1
    at = np.arange(RADIUS, len(h) - RADIUS)
    # the leftmost of equal hashes counts, so periodic text has no boundary of its own
    is_cut = (h[at] < least[at - RADIUS]) & (h[at] <= least[at + 1])
    cuts = at[is_cut] + 1
    ends = np.append(cuts, len(data))
    gaps = np.diff(ends, prepend=0)
    if (gaps > MAX_CHUNK).any():
        # stretches without a boundary are cut evenly from their start
        ends = np.concatenate([np.append(np.arange(e - g + MAX_CHUNK, e, MAX_CHUNK), e) for e, g in zip(ends, gaps, strict=True)])
    return ends


def text_key(doc_id: int | None, data: bytes) -> int:
    """Identity of a row: its id and its text, as a signed 64-bit number."""
    if doc_id is None:  # a row of its own beside one of id 0
        data, doc_id = data + b"\0null", 0
    return int(np.uint64(xxhash.xxh3_64_intdigest(data, seed=doc_id & 0xFFFFFFFFFFFFFFFF)).astype(np.int64))


def anchors(data: bytes) -> np.ndarray:
    """Ends of the seeds: each WINDOW neighbouring positions have one at their least hash (of equal ones, one at least)."""
    if len(data) < SEED:
        return np.empty(0, np.int64)
    h = gear_hashes(data)[SEED - 1 :].astype(np.int64)
    w = min(WINDOW, len(h))
    least = _least_of_next(h.astype(np.uint32), w)[: len(h) - w + 1].astype(np.int64)
    # a position is chosen if it is the least of the window whose least is the largest among its windows
    most = np.full(len(h) + w - 1, -1, np.int64)
    most[w - 1 : w - 1 + len(least)] = least
    largest = np.lib.stride_tricks.sliding_window_view(most, w).max(axis=1)
    at = np.flatnonzero(h == largest)
    same = np.flatnonzero(np.diff(h[at]) == 0)
    if len(same):  # of positions with equal hashes, as in periodic text, as many as the windows need
        drop, tied = np.zeros(len(at), bool), np.append(np.diff(h[at]) == 0, False)
        last = at[0]
        for k in range(1, len(at)):
            if tied[k - 1] and tied[k] and at[k + 1] - last <= w:
                drop[k] = True
            else:
                last = at[k]
        at = at[~drop]
    return at + SEED


def seeds(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, doc_key, places (ends in bytes of UTF-8) and both halves of the digests of the seeds of every row."""
    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, places, digests = [], [], [np.empty(0, np.int64)], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = (text.as_py() or "").encode()
                ends = anchors(data)
                keys.append(text_key(doc_id, data))
                sizes.append(len(ends))
                places.append(ends)
                digests.extend(xxhash.xxh3_128_digest(data[e - SEED : e]) for e in ends.tolist())
            offsets = pa.array(np.cumsum([0, *sizes]).astype(np.int32))
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (np.concatenate(places).astype(np.int32), halves[:, 0].copy(), halves[:, 1].copy())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), *lists], names=["doc_id", "doc_key", "places", "digests", "checks"])

    return source.mapInArrow(run, "doc_id long, doc_key long, places array<int>, digests array<long>, checks array<long>")


def _contexts(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key, at, after, bytes: what lies before (and 4 bytes after) or after (and 4 before) each wanted place (key, at, after)."""
    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.octet_length("text") >= SEED)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [text_key(i, t.as_py().encode()) for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column(1)], names=["key", "text"])

    places = wanted.groupBy("key").agg(F.collect_set(F.struct("at", "after")).alias("places"))
    rows = source.mapInArrow(keyed, "key long, text string").join(places, "key").select("key", F.encode("text", "UTF-8").alias("data"), "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (key, p["at"], p["after"], data[max(0, p["at"] - 4) : p["at"] + CONTEXT] if p["after"] else data[max(0, p["at"] - CONTEXT) : p["at"] + 4])
                for key, data, all_places in zip(*(c.to_pylist() for c in batch.columns), strict=True) for p in all_places
            ]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True) if out else [()] * 4, (pa.int64(), pa.int32(), pa.bool_(), pa.binary()), strict=True)], names=["key", "at", "after", "bytes"])

    return rows.mapInArrow(cut, "key long, at int, after boolean, bytes binary").distinct()


def shared_bytes(own: bytes, other: bytes, at: int, other_at: int, after: bool) -> int:
    """How many bytes before or after two places are equal, to the last edge of a word among them.

    Without any such edge, to a character's edge of the own text: below 0 where the place is inside a character.
    """
    i, j = (min(4, at), min(4, other_at)) if after else (min(CONTEXT, at), min(CONTEXT, other_at))
    n, step = 0, 1 if after else -1
    most = min(len(own) - i, len(other) - j) if after else min(i, j)
    while n < most and own[i + step * n - (not after)] == other[j + step * n - (not after)]:
        n += 1
    for m in range(n, 0, -1):
        edge = i + step * m
        if edge in (0, len(own)) or own[edge - 1 : edge].isspace() or own[edge : edge + 1].isspace():
            return m
    while 0 <= i + step * n < len(own) and 0x80 <= own[i + step * n] < 0xC0:
        n -= 1
    return n


def duplicate_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_span: int = MIN_SPAN) -> DataFrame:
    """One row per duplicate span: doc_id, doc_key, start, length (bytes), n_chunks (its seeds), kept (its seeds' first occurrence), first_doc_id.

    A run ends where the next seed is no duplicate or, unlike it, is (or isn't) a
    first occurrence. A first occurrence is extended as far as any of its copies.
    """
    made = materialise(seeds(df, id_col, text_col), "seeds")
    each = made.select("doc_id", "doc_key", F.explode(F.arrays_zip("digests", "checks", "places")).alias("c"))
    each = each.select("doc_id", "doc_key", F.col("c.digests").alias("digest"), F.col("c.checks").alias("check"), F.col("c.places").alias("place"))
    # only digests are counted over all seeds
    keys = ["digest", "check"]
    often = materialise(each.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1"), "recurring")
    hot, cold = (part.drop("n").distinct() for part in hot_and_cold(each, often, keys, "n"))
    # the last place in the text of the first occurrence, too: in periodic text it is what a run goes on before
    last = F.max(F.struct(F.col("doc_id").isNull(), F.bitwise_not("doc_id"), F.bitwise_not("doc_key"), "place"))
    facts = {"n": F.count("*"), "first": F.min(F.struct("doc_id", "doc_key", "place")), "last": last}
    of_digest = Window.partitionBy(*keys)  # as the join has left the cold rows: no further shuffle
    cold = cold.withColumns({name: f.over(of_digest) for name, f in facts.items()})
    hot = hot.join(F.broadcast(hot.groupBy(*keys).agg(*[f.alias(name) for name, f in facts.items()])), keys)  # as few groups as hot_and_cold allows
    found = cold.unionByName(hot).where("n > 1").withColumn("last", F.col("last.place"))
    found = found.withColumn("kept", (F.col("doc_key") == F.col("first.doc_key")) & (F.col("place") == F.col("first.place")))
    found = materialise(found.select("doc_id", "doc_key", "place", "first", "last", "kept"), "duplicates")
    of_text = Window.partitionBy("doc_key").orderBy("place")
    new = (F.col("place") - F.lag("place").over(of_text) > SEED) | (F.lag("kept").over(of_text) != F.col("kept"))
    runs = found.withColumn("new", F.coalesce(new, F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(of_text))
    end = F.struct("place", F.col("first.doc_key").alias("key"), F.col("first.place").alias("at"), "last")
    spans = materialise(runs.groupBy("doc_id", "doc_key", "run", "kept").agg(F.min(end).alias("low"), F.max(end).alias("high"), F.count("*").alias("n_chunks"), F.min("first.doc_id").alias("first_doc_id")), "runs")

    def side(after: bool, c: str, at: str, back: int) -> F.Column:
        at_first = (F.col(f"{c}.{at}") == F.col(f"{c}.at")).alias("at_first")
        return F.struct(F.lit(after).alias("after"), (F.col(f"{c}.place") - back).alias("own_at"), F.col(f"{c}.key").alias("other_key"), (F.col(f"{c}.{at}") - back).alias("other_at"), at_first)

    sides = F.array_distinct(F.array(side(False, "low", "at", SEED), side(False, "low", "last", SEED), side(True, "high", "at", 0)))
    ends = spans.where("NOT kept").select("doc_key", "run", F.explode(sides).alias("e")).select("doc_key", "run", "e.*")
    # a text's own later places are no earlier occurrence
    ends = ends.where("at_first OR doc_key <> other_key")
    wanted = ends.select(F.col("doc_key").alias("key"), F.col("own_at").alias("at"), "after").unionByName(ends.select(F.col("other_key").alias("key"), F.col("other_at").alias("at"), "after"))
    contexts = materialise(_contexts(df, wanted, id_col, text_col), "contexts")
    own = contexts.select(F.col("key").alias("doc_key"), F.col("at").alias("own_at"), "after", F.col("bytes").alias("own"))
    other = contexts.select(F.col("key").alias("other_key"), F.col("at").alias("other_at"), "after", F.col("bytes").alias("other"))

    @F.pandas_udf("int")
    def more(own: pd.Series, other: pd.Series, at: pd.Series, other_at: pd.Series, after: pd.Series) -> pd.Series:
        return pd.Series([shared_bytes(*x) for x in zip(own, other, at, other_at, after, strict=True)], dtype="int32")

    longer = materialise(ends.join(own, ["doc_key", "own_at", "after"]).join(other, ["other_key", "other_at", "after"]).withColumn("more", more("own", "other", "own_at", "other_at", "after")).drop("own", "other"), "longer")

    def by(keys: list[str], name: str, after: str) -> DataFrame:
        # what precedes a last place says nothing of the first
        return longer.where(after).where("true" if keys[0] == "doc_key" else "at_first").groupBy(*[F.col(k).alias(a) for k, a in zip(keys, ("doc_key", "at"), strict=True)]).agg(F.max("more").alias(name))

    copies = spans.where("NOT kept")
    kept = spans.where("kept")
    out = []
    for part, keys, low, high in ((copies, ["doc_key", "run"], F.col("run"), F.col("run")), (kept, ["other_key", "other_at"], F.col("low.place") - SEED, F.col("high.place"))):
        part = part.withColumn("at", low).join(by(keys, "before", "NOT after"), ["doc_key", "at"], "left")
        part = part.withColumn("at", high).join(by(keys, "behind", "after"), ["doc_key", "at"], "left")
        start = F.col("low.place") - SEED - F.coalesce("before", F.lit(0))
        stop = F.col("high.place") + F.coalesce("behind", F.lit(0))
        out.append(part.select("doc_id", "doc_key", "kept", start.cast("long").alias("start"), (stop - start).cast("long").alias("length"), "n_chunks", "first_doc_id"))
    return out[0].unionByName(out[1]).where(F.col("length") >= min_span)


def cut_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_span: int = MIN_SPAN) -> DataFrame:
    """df with every duplicate span that isn't a first occurrence cut out of its text."""
    spans = duplicate_spans(df, id_col, text_col, min_span).where("NOT kept")
    cut = spans.groupBy(F.col("doc_key").alias("__key")).agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("__cut"))

    @F.pandas_udf("long")
    def key(ids: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([text_key(None if i is None else int(i), (t or "").encode()) for i, t in zip(ids, texts, strict=True)], dtype="int64")

    @F.pandas_udf("string")
    def without(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        out = []
        for text, spans in zip(texts, cuts, strict=True):
            if spans is not None and text is not None:
                data, keep, at = text.encode(), [], 0
                for s in spans:
                    keep.append(data[at : s["start"]])
                    at = max(at, s["start"] + s["length"])  # extended spans may overlap
                text = b"".join([*keep, data[at:]]).decode("utf-8", "ignore")
            out.append(text)
        return pd.Series(out, dtype=object)

    keyed = df.withColumn("__row_key", key(F.col(id_col).cast("long").cast("string"), F.col(text_col)))
    joined = keyed.join(cut, keyed["__row_key"] == cut["__key"], "left")
    return joined.withColumn(text_col, without(F.col(text_col), F.col("__cut"))).select(*df.columns)
