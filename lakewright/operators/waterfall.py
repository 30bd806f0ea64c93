"""Waterfall matching: ordered rules, each seeing only what the earlier ones left."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


@dataclass(frozen=True)
class Rule:
    """Equal keys plus a residual condition on l.* and r.*; distance breaks ties (least first)."""

    keys: list[tuple[str, str]]
    where: Column | None = None
    distance: Column | None = None


def waterfall(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, rules: list[Rule], consume: str = "both", cut: Callable[[DataFrame], DataFrame] | None = materialise
) -> DataFrame:
    """left_id, right_id, step of the matched pairs.

    consume="both": a rule sees rows unmatched on either side and keeps pairs
    that are each other's first choice (1:1). consume="left": only left rows are
    used up, several left rows may match one right row. First choice: least
    distance, then the ids; rows that repeat an id and tie are one pair, which two
    row numbers would lose whenever they numbered different rows first. cut: writes and re-reads each step's pairs, so that every
    rule is planned once and on stored keys, however long the chain is.
    """
    pairs = None
    for step, rule in enumerate(rules, 1):
        l, r = left, right
        if pairs is not None:
            l = l.join(pairs.select(left_id), left_id, "left_anti")
            if consume == "both":
                r = r.join(pairs.select(right_id), right_id, "left_anti")
        on = F.lit(True)
        for a, b in rule.keys:
            on = on & (F.col(f"l.{a}") == F.col(f"r.{b}"))
        if rule.where is not None:
            on = on & rule.where
        distance = F.lit(0) if rule.distance is None else rule.distance
        found = l.alias("l").join(r.alias("r"), on).select(F.col(f"l.{left_id}").alias(left_id), F.col(f"r.{right_id}").alias(right_id), distance.alias("__d"))
        first = Window.partitionBy(left_id).orderBy("__d", right_id)
        if consume == "both":
            by_right = F.rank().over(Window.partitionBy(right_id).orderBy("__d", left_id))
            found = found.withColumns({"__l": F.rank().over(first), "__r": by_right}).where("__l = 1 AND __r = 1").select(left_id, right_id).distinct()
        else:
            found = found.withColumn("__l", F.row_number().over(first)).where("__l = 1")
        found = found.select(left_id, right_id, F.lit(step).cast("long").alias("step"))
        found = cut(found) if cut else found
        pairs = found if pairs is None else pairs.unionByName(found)
    return pairs


def bridge_outer(left: DataFrame, bridge: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """All rows of left and right, side by side where the bridge pairs them; right_id is null where there is no right row."""
    paired = left.join(bridge.select(left_id, F.col(right_id).alias("__r")), left_id, "left")
    return paired.join(right, F.col("__r") == F.col(right_id), "full").drop("__r")
