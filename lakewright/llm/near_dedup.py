"""Circulant MinHash near-dedup: candidate banding, exact Jaccard verification, components.

Signature: with permutations sigma (a bijective hash onto a circle) and pi (a
fixed random circle of values), coordinate k of a set is the least
pi[sigma(x) + k] over its members x. All coordinates of one member are a
contiguous slice of the circle, so a signature is a running minimum of slices.
Rows of the signature are hashed in bands; texts that share a band are
candidates, and a link needs 100 * intersection >= 75 * union on the full sets.

Texts with equal shingle sets form a class and are one node. Within a band
bucket each class is compared with the bucket's first class; classes that this
leaves outside the bucket's largest component are then compared with all
others, so huge groups of near copies stay linear. Pairs are made only where
three exact or safe bounds allow a link: set sizes, the members that a set
shares with any other (a text with more than a quarter of its own can't link),
and the low bits of all 512 coordinates (which agree with probability
similarity + (1 - similarity) / 16). Texts that merely share a passage don't become pairs.

With 40 bands of 4 rows a pair at similarity 0.75 is missed with probability
(1 - 0.75^4)^40 < 3e-7; the bits, at five standard deviations, miss as few. Null or wordless texts have an empty set and link with
nothing. Rows that repeat an id are reported each; their id stands for all
their texts in component_id. Null ids are reported as their own component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .memory import leaves_nothing
from .runtime import materialise, small_or_shuffled
from .words import WordHashes, hash_words, mix, shingles, split_words

BANDS, ROWS, COORDINATES, CIRCLE_BITS, SEED = 40, 4, 512, 21, 7
SHARE, WORDS = 75, 5
#: Low bits kept of each coordinate. How many coordinates may differ in them: the mean at similarity 0.75 and five standard deviations.
KEPT_BITS, _DIFFER = 4, 0.25 * (1 - 2.0**-4)
MOST_DIFFERENT = int(COORDINATES * _DIFFER + 5 * (COORDINATES * _DIFFER * (1 - _DIFFER)) ** 0.5)
BIT_WORDS = COORDINATES * KEPT_BITS // 64
_BLOCK = 512
#: Size of the table that bounds what sets can have in common: 4 MB, whatever the corpus.
_COUNT_BITS, _COUNT_BLOCKS = 22, 64


@lru_cache(maxsize=1)
def _circle() -> np.ndarray:
    size = 1 << CIRCLE_BITS
    pi = np.random.default_rng(SEED).permutation(size).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:COORDINATES]]), COORDINATES)


def signature(members: np.ndarray) -> np.ndarray:
    """The circulant MinHash coordinates of a non-empty set of 64-bit hashes."""
    slices, at = _circle(), (mix(members ^ np.uint64(SEED)) >> np.uint64(64 - CIRCLE_BITS)).astype(np.int64)
    least = slices[at[:_BLOCK]].min(axis=0)
    for i in range(_BLOCK, len(at), _BLOCK):
        np.minimum(least, slices[at[i : i + _BLOCK]].min(axis=0), out=least)
    return least


def bands(sig: np.ndarray) -> np.ndarray:
    """One 64-bit hash a band; the band's number is part of it."""
    rows = sig[: BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS)
    out = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for i in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return out.view(np.int64)


def low_bits(sig: np.ndarray) -> np.ndarray:
    """The lowest four bits of each coordinate, sixteen coordinates to a number."""
    low = (sig & np.uint32(15)).astype(np.uint8)
    return (low[0::2] << 4 | low[1::2]).view(np.int64)


def shingle_set(text: str | None, memo: WordHashes) -> np.ndarray:
    return np.unique(shingles(hash_words(split_words(text), memo), WORDS))


def _sketches(df: DataFrame, with_sets: bool = False) -> DataFrame:
    """doc_id, n_shingles, class (128-bit digest of the set), and the band hashes followed by the low bits, or else the set itself."""
    last = "members" if with_sets else "sketch"

    def sketch(members: np.ndarray) -> np.ndarray:
        sig = signature(members)
        return np.concatenate([bands(sig), low_bits(sig)])

    @leaves_nothing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            sizes, digests, lists = [], [], []
            for text in batch.column(1):
                members = shingle_set(text.as_py(), memo)
                sizes.append(len(members))
                digests.append(xxhash.xxh3_128_hexdigest(members.tobytes()))
                lists.append(members.view(np.int64) if with_sets else sketch(members) if len(members) else np.empty(0, np.int64))
            flat = pa.array(np.concatenate(lists) if lists else np.empty(0, np.int64))
            ends = pa.array(np.cumsum([0, *map(len, lists)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.ListArray.from_arrays(ends, flat)], names=["doc_id", "n_shingles", "class", last])

    return df.mapInArrow(run, f"doc_id long, n_shingles long, class string, {last} array<long>")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (u, v) of classes, those whose sets are similar enough."""
    a, b = (sets.select(F.col("rep").alias(k), F.col("members").alias(f"of_{k}")) for k in "uv")
    common = F.size(F.array_intersect("of_u", "of_v"))
    union = F.size("of_u") + F.size("of_v") - common
    return pairs.join(a, "u").join(b, "v").where(100 * common >= SHARE * union).select("u", "v")


def _likely(n_u: Column, n_v: Column, bits_u: Column, bits_v: Column) -> Column:
    """Whether set sizes and low bits allow a link."""

    def differing(i: int) -> Column:
        x = F.get(bits_u, F.lit(i)).bitwiseXOR(F.get(bits_v, F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(0x1111111111111111)))

    different = sum((differing(i) for i in range(BIT_WORDS)), F.lit(0))
    return (100 * n_u >= SHARE * n_v) & (100 * n_v >= SHARE * n_u) & (different <= MOST_DIFFERENT)


@leaves_nothing
def _count_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of a task's sets have a member of each hash: none, one, or more (2), in blocks."""
    seen = np.zeros(1 << _COUNT_BITS, np.uint8)
    for batch in batches:
        for members in batch.column(0):
            at = np.unique(members.values.to_numpy().view(np.uint64) >> np.uint64(64 - _COUNT_BITS))
            seen[at] = np.minimum(seen[at] + 1, 2)
    blocks = seen.reshape(_COUNT_BLOCKS, -1)
    yield pa.RecordBatch.from_arrays([pa.array(range(_COUNT_BLOCKS), pa.int32()), pa.array([b.tobytes() for b in blocks])], names=["block", "seen"])


def _add_counts(group: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros((1 << _COUNT_BITS) // _COUNT_BLOCKS, np.uint8)
    for seen in group["seen"]:
        total = np.minimum(total + np.frombuffer(seen, np.uint8), 2)
    return pd.DataFrame({"block": group["block"].iloc[:1], "seen": [total.tobytes()]})


def _with_shareable(some: DataFrame, sets: DataFrame) -> DataFrame:
    """`some` (rep, n_shingles) with `shareable`, a bound on the members that a set has in common with any other, without sets that it rules out.

    A link needs at least SHARE % of either set in common. Members are counted
    in a table of fixed size; where hashes collide the bound is only looser.
    """
    spark = some.sparkSession
    held = materialise(some.select("rep").join(sets.select("rep", "members"), "rep"), "held")
    blocks = held.select("members").mapInArrow(_count_members, "block int, seen binary").groupBy("block").applyInPandas(_add_counts, "block int, seen binary").collect()
    table = spark.sparkContext.broadcast(np.concatenate([np.frombuffer(b["seen"], np.uint8) for b in sorted(blocks, key=lambda b: b["block"])]) if blocks else np.zeros(1 << _COUNT_BITS, np.uint8))

    @leaves_nothing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [x.values.to_numpy().view(np.uint64) >> np.uint64(64 - _COUNT_BITS) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([int((table.value[x] > 1).sum()) for x in lists], pa.int64())], names=["rep", "shareable"])

    bound = held.select("rep", "members").mapInArrow(run, "rep long, shareable long")
    return some.join(bound, "rep").where(100 * F.col("shareable") >= SHARE * F.col("n_shingles"))


def _side(rows: DataFrame, k: str) -> DataFrame:
    return rows.withColumnsRenamed({"rep": k, "component": f"c_{k}", "n_shingles": f"n_{k}", "bits": f"bits_{k}", "bands": f"bands_{k}", "shareable": f"m_{k}"})


def _pairs_across(rows: DataFrame) -> DataFrame:
    """Likely pairs (u, v) of rows (bucket, rep, component, n_shingles, bits, bands, shareable) that share a bucket but no component.

    Of such a pair one is outside the bucket's largest component, so only those
    outside are compared with all: a huge component isn't compared with itself.
    A pair is made in the first of the bands it shares.
    """
    sizes = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
    outside = rows.join(largest, "bucket").where(F.col("component") != F.col("largest"))
    most = F.least("m_u", "m_v")
    likely = (
        (F.col("c_u") != F.col("c_v"))
        & ((F.col("u") < F.col("v")) | (F.col("c_v") == F.col("largest")))
        & _likely(*map(F.col, ("n_u", "n_v", "bits_u", "bits_v")))
        & (100 * most >= SHARE * (F.col("n_u") + F.col("n_v") - most))
        & (F.get(F.array_intersect("bands_u", "bands_v"), F.lit(0)) == F.col("bucket"))
    )
    return _side(outside, "u").join(_side(rows, "v"), "bucket").where(likely).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, class."""
    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = materialise(_sketches(source), "sketches")
    real = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = materialise(real.groupBy("class").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "classes")
    reps = reps.select("class", "rep", "n_shingles", F.slice("sketch", 1, BANDS).alias("bands"), F.slice("sketch", BANDS + 1, BIT_WORDS).alias("bits"))
    buckets = reps.select("rep", F.explode("bands").alias("bucket")).distinct()
    heads = buckets.groupBy("bucket").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = materialise(buckets.join(heads, "bucket"), "buckets")

    sized = reps.select("rep", "n_shingles", "bits")
    star = members.where("rep <> head").select(F.col("head").alias("u"), F.col("rep").alias("v")).distinct()
    star = star.join(_side(sized, "u"), "u").join(_side(sized, "v"), "v").where(_likely(*map(F.col, ("n_u", "n_v", "bits_u", "bits_v"))))
    first = materialise(star.select("u", "v"), "pairs")
    wanted = small_or_shuffled(members.select("rep").distinct())
    texts = source.join(wanted, source["doc_id"] == wanted["rep"], "left_semi")
    sets = _sketches(texts, with_sets=True).dropDuplicates(["class"])
    sets = materialise(sets.join(reps.select("class", "rep"), "class").select("rep", "n_shingles", "members"), "sets")
    linked = materialise(_links(first, sets), "links")
    components = connected_components(linked)

    # classes of a bucket that are in different components still
    member = members.join(components.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    open_buckets = member.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("bucket")
    still = materialise(member.join(open_buckets, "bucket"), "open-buckets")
    linkable = materialise(_with_shareable(still.select("rep").distinct().join(reps.drop("class"), "rep"), sets), "linkable")
    pairs = _pairs_across(still.join(linkable, "rep"))
    more = materialise(_links(pairs.join(first, ["u", "v"], "left_anti"), sets), "more-links")
    if not more.isEmpty():
        components = connected_components(linked.unionByName(more))

    of_class = reps.select("class", "rep").join(components.withColumnRenamed("node", "rep"), "rep", "left").select("class", F.coalesce("component", "rep").alias("component"))
    out = sketches.join(of_class, "class", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), "class")
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "class")


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df whose id is the smallest of its component, with all columns of df."""
    groups = near_groups(df, id_col, text_col)
    gone = small_or_shuffled(materialise(groups.where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct(), "near-gone"))
    return df.join(gone, df[id_col] == gone["__gone"], "left_anti")
