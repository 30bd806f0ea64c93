"""Exact dedup by progressive refinement: length, then a prefix hash, then the full hash.

Texts are equal when identical after deleting every character of
[\\x20\\x09-\\x0D]. Level 1 counts normalised lengths and keeps rows whose length
occurs twice; level 2 hashes the first characters of those rows only and keeps
(length, prefix hash) that occur twice; only rows of the surviving groups have
their full content hashed and compared.

Null text counts as empty; empty texts are equal to each other. Ties in length
go to the smallest id (a null id sorts first). Rows that repeat id and text are
one group; one of them is kept (`repeat` numbers them). An empty table gives an
empty result. Other columns of the input are never read, so clashes can't occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import join_groups, materialise, small_or_shuffled

PREFIX = 64
_SPACE = "[\\x20\\x09-\\x0D]+"


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _SPACE, "")


def _digest(norm: Column) -> Column:
    return F.sha2(F.encode(norm, "UTF-8"), 256)


def _twice(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The keys that occur twice or more, written, with a broadcast hint if they are few."""
    return small_or_shuffled(materialise(rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys), name))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, repeat.

    digest_all: also hash the full content of rows that refinement has shown to be
    alone; otherwise their text_sha256 is null and their content isn't hashed.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("norm", normalised("text")).withColumn("n_norm", F.length("norm").cast("long"))
    lengths = _twice(rows.select("n_norm"), ["n_norm"], "exact-lengths").withColumn("same_length", F.lit(True))
    # a row whose length is its own has no prefix hash, and a null key joins nothing
    prefix = F.when(F.col("same_length"), F.xxhash64(F.substring("norm", 1, PREFIX)))
    prefixed = rows.join(lengths, "n_norm", "left").withColumn("prefix", prefix)
    surviving = _twice(prefixed.where("prefix IS NOT NULL").select("n_norm", "prefix"), ["n_norm", "prefix"], "exact-survivors").withColumn("survives", F.lit(True))
    keyed = prefixed.select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_cp"), "norm", "n_norm", "prefix")
    keyed = keyed.join(surviving, ["n_norm", "prefix"], "left").withColumn("survives", F.coalesce("survives", F.lit(False)))
    digest = _digest(F.col("norm"))
    digested = keyed.select("doc_id", "n_cp", "survives", (digest if digest_all else F.when(F.col("survives"), digest)).alias("text_sha256"))
    digested = materialise(digested, "exact-digests")
    best = F.min(F.struct((-F.col("n_cp")).alias("neg"), F.col("doc_id"))).alias("best")
    groups = digested.where("survives").groupBy("text_sha256").agg(best, F.count("*").alias("group_size"))
    groups = materialise(groups.select("text_sha256", F.col("best.doc_id").alias("keep_id"), "group_size"), "exact-keepers")
    alone = digested.where("NOT survives").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", F.lit(1).alias("repeat"))
    same = Window.partitionBy("text_sha256", "doc_id").orderBy(F.desc("n_cp"))
    grouped = join_groups(digested.where("survives").withColumn("repeat", F.row_number().over(same)), groups, ["text_sha256"], "group_size")
    grouped = grouped.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 1)).alias("kept"), "text_sha256", "repeat")
    return alone.unionByName(grouped)


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df that exact_groups keeps, with all columns of df."""
    groups = materialise(exact_groups(df, id_col, text_col), "exact-groups")
    dropped = groups.where("NOT kept AND NOT doc_id <=> keep_id").select(F.col("doc_id").alias("__gone"), F.col("text_sha256").alias("__sha"))
    # an id is dropped together with its text: an id given to two texts loses only the copy. The join's key is the id;
    # a digest is found in another only where they are equal, which, unlike "=", isn't a key to be hashed for every row
    gone = small_or_shuffled(dropped.distinct())
    out = df.join(gone, df[id_col].eqNullSafe(gone["__gone"]) & (F.instr(_digest(normalised_of(df, text_col)), gone["__sha"]) == 1), "left_anti")
    repeated = groups.where("repeat > 1").select(F.col("doc_id").alias("__again")).distinct()
    if not repeated.isEmpty():
        again = small_or_shuffled(materialise(repeated, "exact-repeats"))
        same_id = out[id_col].eqNullSafe(again["__again"])
        once = out.join(again, same_id, "left_semi").withColumn("__norm", normalised(text_col)).dropDuplicates([id_col, "__norm"]).drop("__norm")
        out = out.join(again, same_id, "left_anti").unionByName(once)
    return out


def normalised_of(df: DataFrame, text_col: str) -> Column:
    return F.regexp_replace(F.coalesce(df[text_col], F.lit("")), _SPACE, "")
