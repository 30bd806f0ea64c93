"""Event timelines, monthly ledgers, balances, dense months."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def event_timeline(branches: list[DataFrame], keys: list[str], order: dict[str, int], kind: str = "reference") -> DataFrame:
    """All branches by name, missing columns null, repeats once, with the sort place of each kind (kinds unknown last)."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches).distinct()
    place = F.create_map(*[F.lit(x) for p in order.items() for x in p])
    return rows.withColumn("type_order", F.coalesce(F.try_element_at(place, F.col(kind)), F.lit(len(order) + 1)).cast("long"))


def with_fallback_date(df: DataFrame, date: str, fallback: str, days: int = 14) -> DataFrame:
    """date, or `days` after fallback, flagged as estimated."""
    return df.withColumns({date: F.coalesce(F.col(date), F.date_add(F.col(fallback), days)), "is_estimated": F.col(date).isNull() & F.col(fallback).isNotNull()})


def first_event_cohort(df: DataFrame, key: str, date: str, since: Column) -> DataFrame:
    """Rows of keys whose first event isn't before `since`."""
    return df.withColumn("__first", F.min(date).over(Window.partitionBy(key))).where(F.col("__first") >= since).drop("__first")


def prior_count(df: DataFrame, key: str, date: str, counted: Column, name: str) -> DataFrame:
    """How many counted rows of the key have an earlier date; 0 without a date. One window instead of a correlated subquery."""
    day = F.datediff(F.col(date).cast("date"), F.lit("1970-01-01").cast("date"))
    window = Window.partitionBy(key).orderBy(day).rangeBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.when(F.col(date).isNull(), F.lit(0).cast("long")).otherwise(F.count_if(counted & F.col(date).isNotNull()).over(window)))


def monthly_ledger(usage: DataFrame, billing: DataFrame, key: str, month: str = "month") -> DataFrame:
    """key, month, n_usage, n_billing and running totals, with what is used but not billed.

    usage and billing have key, month, n. Their cells are unioned and summed once,
    so no spine join is needed; rows of zero on both sides are dropped after
    the running sums.
    """
    cells = usage.select(key, month, F.col("n").alias("n_usage"), F.lit(0).cast("long").alias("n_billing")).unionByName(
        billing.select(key, month, F.lit(0).cast("long").alias("n_usage"), F.col("n").alias("n_billing"))
    )
    summed = cells.groupBy(key, month).agg(F.sum("n_usage").alias("n_usage"), F.sum("n_billing").alias("n_billing"))
    running = Window.partitionBy(key).orderBy(month).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = summed.withColumns({"total_usage": F.sum("n_usage").over(running), "total_billing": F.sum("n_billing").over(running)})
    return out.withColumn("missing", F.col("total_usage") - F.col("total_billing")).where("n_usage > 0 OR n_billing > 0")


def inventory_balance(movements: DataFrame, key: str, at: str, signed: str, quarantine: DataFrame | None = None) -> DataFrame:
    """Running balance of signed movements per key; keys in quarantine are left out."""
    rows = movements if quarantine is None else movements.join(quarantine.select(key).distinct(), key, "left_anti")
    running = Window.partitionBy(key).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    daily = rows.groupBy(key, at).agg(F.sum(signed).alias("moved"))
    return daily.withColumn("balance", F.sum("moved").over(running))


def dense_months(cells: DataFrame, key: str, month: str, value: str, last_month: Column, name: str = "filled") -> DataFrame:
    """Every month (a date, its first day) from a key's first cell to last_month (an aggregate of its cells), the value carried forward.

    Months come from sequence() per key: no cross join of keys and months.
    """
    bounds = cells.groupBy(key).agg(F.min(month).alias("__a"), last_month.alias("__b"))
    grid = bounds.select(key, F.explode(F.sequence("__a", F.greatest("__a", "__b"), F.expr("interval 1 month"))).alias(month))
    carried = Window.partitionBy(key).orderBy(month).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return grid.join(cells.select(key, month, value), [key, month], "left").withColumn(name, F.last(value, ignorenulls=True).over(carried))


def assumed_history(usage: DataFrame, month: str, cutoff: str, price: float) -> DataFrame:
    """Billing assumed for usage before the cutoff month, at a constant price."""
    return usage.where(F.col(month) < cutoff).withColumns({"amount": F.col("n") * F.lit(price), "is_assumed": F.lit(True)})


def latest_per_key(df: DataFrame, key: str, month: str) -> DataFrame:
    """The last ledger rows of each key, ties kept."""
    from .dedup import keep_latest_ties

    return keep_latest_ties(df, [key], month)
