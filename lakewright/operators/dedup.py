"""One row per key: keep-latest, priority, rank-based and upsert operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import row_hash
from ..session import materialise


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order; the rank filter is pushed below the shuffle as a group limit."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def keep_latest(df: DataFrame, keys: list[str], at: str, tie: list[Column] | None = None) -> DataFrame:
    """The row with the largest `at` of each key, nulls last; ties go to the smallest hash of the row unless `tie` says otherwise."""
    return keep_first(df, keys, [F.col(at).desc_nulls_last(), *(tie or [row_hash(df.columns).asc()])])


def keep_latest_ties(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """All rows that share the largest `at` of their key."""
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(at).desc_nulls_last()))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """A sequence number within each key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))


def surrogate_key(df: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
    """A stable key from the row's content: the same on every run and partitioning."""
    return df.withColumn(name, row_hash(columns or df.columns))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old without the keys of new, then new: DELETE by key + INSERT, INSERT OR REPLACE, UPDATE-else-INSERT."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def update_from(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], only_where: Column | None = None) -> DataFrame:
    """UPDATE ... FROM: columns of target replaced by source's where a key matches (source has one row a key) and only_where holds."""
    taken = source.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in columns], F.lit(True).alias("__hit"))
    joined = target.join(taken, keys, "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False)) & (F.lit(True) if only_where is None else F.coalesce(only_where, F.lit(False)))
    return joined.withColumns({c: F.when(hit, F.col(f"__new_{c}")).otherwise(F.col(c)) for c in columns}).select(*target.columns)


def delete_orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of child whose key is in parent; chains of these are cascading deletes."""
    return child.join(parent.select(*keys).distinct(), keys, "left_semi")


def retain(df: DataFrame, at: str, as_of: Column, days: int) -> DataFrame:
    """Rows of the last `days` days before as_of; rows without a time stay."""
    return df.where(F.col(at).isNull() | (F.col(at) >= F.date_sub(as_of, days)))


def duplicate_audit(df: DataFrame, keys: list[str]) -> DataFrame:
    """rows, distinct keys and the difference, as one row."""
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(F.struct(*keys)).alias("n_keys")).withColumn("n_duplicates", F.col("n_rows") - F.col("n_keys"))


def line_numbers(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """df with the place of each row in a total order, from 1, without a single task.

    Rows are range-partitioned once and written; a part's rows are counted, and
    each is numbered within its part behind the rows of the parts before it.
    """
    parts = materialise(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "line-numbers")
    sizes = parts.groupBy("__part").agg(F.count("*").alias("__n"))  # a row per part
    before = sizes.withColumn("__before", F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))).drop("__n")
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return parts.join(F.broadcast(before), "__part").withColumn(out, (place + F.coalesce("__before", F.lit(0))).cast("long")).drop("__part", "__before")


def null_aware_anti(df: DataFrame, listed: DataFrame, key: str, listed_key: str) -> DataFrame:
    """Rows of df that SQL's NOT IN keeps: none where the list holds a null, all where it is empty, else those not listed whose key isn't null."""
    facts = listed.agg(F.coalesce(F.max(F.col(listed_key).isNull()), F.lit(False)).alias("__null"), F.count("*").alias("__n"))  # one row
    rest = df.join(listed.select(F.col(listed_key).alias("__listed")), F.col(key) == F.col("__listed"), "left_anti")
    return rest.join(F.broadcast(facts), (F.col("__n") == 0) | (~F.col("__null") & F.col(key).isNotNull()), "inner").drop("__null", "__n")
