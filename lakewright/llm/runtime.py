"""Shared plumbing: size-checked broadcasts and joins on keys that may be hot; written intermediates are lakewright.session's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, shared_dir

__all__ = ["hot_and_cold", "join_groups", "materialise", "shared_dir", "small_or_shuffled", "table"]

#: Rows of two longs or so that a broadcast side may have (about 32 MB).
BROADCAST_ROWS = 500_000
#: Groups that may be called hot: one has at least this part of all rows, so there can't be more.
HOT_GROUPS, HOT_ROWS = 10_000, 200


def small_or_shuffled(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """side with a broadcast hint if it has at most `rows` rows, else as it is (a shuffled join)."""
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side


def hot_and_cold(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Inner join of rows with the groups they are in, in two parts; `size` counts a group's rows, all groups together those of the table or fewer.

    Rows of a hot group don't meet in one task: groups of at least a
    HOT_GROUPS-th of all rows (`total`, summed here unless it is given) are HOT_GROUPS at most and are broadcast; only
    the rest, the second part, is shuffled by the keys.
    """
    if total is None:
        total = groups.agg(F.sum(size)).first()[0] or 0
    least = max(HOT_ROWS, -(-total // HOT_GROUPS))
    hot = F.broadcast(groups.where(F.col(size) >= least))
    cold = rows.join(hot.select(*keys), keys, "left_anti").join(groups.where(F.col(size) < least), keys)
    return rows.join(hot, keys), cold


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int | None = None) -> DataFrame:
    """hot_and_cold() as one table."""
    hot, cold = hot_and_cold(rows, groups, keys, size, total)
    return hot.unionByName(cold)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
