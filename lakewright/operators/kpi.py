"""Pipeline KPIs, weighted forecast, cumulative funnel, wide summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NO_HISTORY = 0.15


def win_rates(deals: DataFrame, stage: str = "stage", status: str = "status") -> DataFrame:
    """Won over closed per stage; NO_HISTORY where a stage has no won deal."""
    won, lost = F.count_if(F.col(status) == "won"), F.count_if(F.col(status) == "lost")
    return deals.groupBy(stage).agg(won.alias("won"), lost.alias("lost")).withColumn("win_rate", F.when(F.col("won") > 0, F.col("won") / (F.col("won") + F.col("lost"))).otherwise(F.lit(NO_HISTORY)))


def weighted_forecast(deals: DataFrame, value: str, stage: str = "stage", status: str = "status") -> DataFrame:
    """Open value per stage, as it is and weighted by the stage's win rate."""
    open_value = deals.where(F.col(status) == "ongoing").groupBy(stage).agg(F.count("*").alias("n_open"), F.sum(value).alias("open_value"))
    return open_value.join(win_rates(deals, stage, status), stage).withColumn("weighted_value", F.col("open_value") * F.col("win_rate"))


def pipeline_kpis(deals: DataFrame, value: str, created: str, updated: str, closed: str, stalled_days: int = 15) -> DataFrame:
    """One row: counts by status, win rate (%), values, mean cycle and age in days, stalled deals by the newest update."""
    newest = deals.agg(F.max(updated).alias("__now"))
    d = deals.join(F.broadcast(newest), F.lit(True))
    days = lambda a, b: F.timestamp_diff("SECOND", F.col(a), F.col(b)) / 86400
    is_open, won, lost = (F.col("status") == s for s in ("ongoing", "won", "lost"))
    row = d.agg(
        F.count("*").alias("n_deals"), F.count_if(is_open).alias("n_open"), F.count_if(won).alias("n_won"), F.count_if(lost).alias("n_lost"),
        F.sum(F.when(won, F.col(value))).alias("won_value"), F.sum(F.when(is_open, F.col(value))).alias("open_value"),
        F.avg(F.when(won, days(created, closed))).alias("cycle_days"), F.avg(F.when(is_open, days(created, "__now"))).alias("age_days"),
        F.count_if(is_open & (days(updated, "__now") >= stalled_days)).alias("n_stalled"),
    )
    return row.withColumn("win_rate", F.coalesce(100 * F.try_divide(F.col("n_won"), F.col("n_won") + F.col("n_lost")), F.lit(0.0)))


def funnel(df: DataFrame, key: str, stage: str, stages: list[str]) -> DataFrame:
    """step, stage, reached (keys whose highest stage is this or a later one), step and overall conversion."""
    place = F.create_map(*[F.lit(x) for i, s in enumerate(stages, 1) for x in (s, i)])
    top = df.select(key, F.try_element_at(place, F.col(stage)).alias("step")).where("step IS NOT NULL").groupBy(key).agg(F.max("step").alias("step"))
    counts = top.groupBy("step").agg(F.count("*").alias("n"))
    spine = df.sparkSession.createDataFrame([(i, s) for i, s in enumerate(stages, 1)], "step int, stage string")
    # as many rows as there are stages
    after = Window.orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = spine.join(counts, "step", "left").withColumn("reached", F.sum(F.coalesce("n", F.lit(0))).over(after))
    by_step = Window.orderBy("step")
    first = F.first("reached").over(by_step.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.lag("reached").over(by_step)
    return reached.select(F.col("step").cast("long").alias("step"), "stage", "reached", F.try_divide("reached", F.coalesce(before, F.col("reached"))).alias("step_rate"), F.try_divide("reached", first).alias("overall_rate"))


def group_mode(df: DataFrame, keys: list[str], value: str, name: str = "mode") -> DataFrame:
    """The most frequent non-null value of each key, ties to the smallest."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("__n"), value))
    return counted.withColumn("__r", rank).where("__r = 1").select(*keys, F.col(value).alias(name))


def impute_mode(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Nulls of value filled with the key's mode."""
    return df.join(group_mode(df, keys, value, "__mode"), keys, "left").withColumn(value, F.coalesce(value, "__mode")).drop("__mode")


def classify_change(old: Column, new: Column) -> Column:
    """How a status code moved: new, unchanged, became_available (200), lost (from 200), changed."""
    return F.when(old.isNull(), "new").when(old.eqNullSafe(new), "unchanged").when(new == 200, "became_available").when(old == 200, "lost").otherwise("changed")


def changes(previous: DataFrame, current: DataFrame, key: str, code: str) -> DataFrame:
    """key, old, new, change of keys of current whose state differs from the previous one (taken before the upsert)."""
    old = previous.select(key, F.col(code).alias("old"))
    joined = current.select(key, F.col(code).alias("new")).join(old, key, "left")
    return joined.withColumn("change", classify_change(F.col("old"), F.col("new"))).where("change <> 'unchanged'")


def financial_summary(cycles: DataFrame, payments: DataFrame, key: str) -> DataFrame:
    """Per key: cycles (n), payments (n, amount) and flags computed from the sums, not from the rows."""
    c = cycles.groupBy(key).agg(F.count("*").alias("n_cycles"))
    p = payments.groupBy(key).agg(F.count("*").alias("n_payments"), F.sum("amount").alias("amount"))
    both = c.join(p, key, "full").fillna(0, ["n_cycles", "n_payments"]).fillna(0.0, ["amount"])
    flag = F.when((F.col("n_cycles") > 0) & (F.col("n_payments") == 0), "cycles_without_payment").when((F.col("n_cycles") == 0) & (F.col("n_payments") > 0), "payment_without_cycles").when(F.col("n_cycles") > F.col("n_payments"), "more_cycles").when(F.col("n_cycles") < F.col("n_payments"), "more_payments").otherwise("balanced")
    return both.withColumn("status", flag)
