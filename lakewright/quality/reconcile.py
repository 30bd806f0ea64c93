"""Reconciliation, cell diffs, profiles, plausibility and gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import normalise_key


def check_schema(df: DataFrame, keys: list[str], values: list[str] | None = None) -> list[str]:
    """Columns that are missing, whatever their case; empty if the table is as expected."""
    have = {c.lower() for c in df.columns}
    return [c for c in [*keys, *(values or [])] if c.lower() not in have]


def reconcile_keys(left: DataFrame, right: DataFrame, key: str, value: str | None = None) -> DataFrame:
    """One row: distinct normalised keys on both sides, on one side, and the value sums of each side over shared keys."""
    def side(df: DataFrame, n: str) -> DataFrame:
        v = F.sum(F.col(value).cast("double")) if value else F.lit(0.0)
        return df.select(normalise_key(F.col(key)).alias("k"), *([value] if value else [])).where("k IS NOT NULL").groupBy("k").agg(v.alias(f"v_{n}")).withColumn(f"in_{n}", F.lit(True))

    j = side(left, "l").join(side(right, "r"), "k", "full")
    both = F.col("in_l").isNotNull() & F.col("in_r").isNotNull()
    out = j.agg(F.count("in_l").alias("n_left"), F.count("in_r").alias("n_right"), F.count_if(both).alias("n_both"), F.sum(F.when(both, F.col("v_l"))).alias("sum_left"), F.sum(F.when(both, F.col("v_r"))).alias("sum_right"))
    return out.withColumns({"only_left": F.col("n_left") - F.col("n_both"), "only_right": F.col("n_right") - F.col("n_both"), "overlap": F.try_divide("n_both", "n_left"), "difference": F.col("sum_right") - F.col("sum_left")})


def canonical_cell(c: Column, kind: str, digits: int = 4) -> Column:
    """A cell as text: nulls and blanks alike, doubles rounded."""
    if kind in ("double", "float"):
        return F.round(c.cast("double"), digits).cast("string")
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def cell_diff(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """column, compared, different: cells of rows with equal keys, in one pass."""
    kinds = dict(left.dtypes)
    l = left.select(*keys, *[canonical_cell(F.col(c), kinds[c]).alias(f"l_{c}") for c in columns])
    r = right.select(*keys, *[canonical_cell(F.col(c), kinds[c]).alias(f"r_{c}") for c in columns])
    j = l.join(r, keys)
    row = j.agg(F.count("*").alias("compared"), *[F.count_if(~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))).alias(c) for c in columns])
    return row.unpivot(["compared"], columns, "column", "different")


def fill_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column, n_rows, n_filled, fill_rate (%): one aggregate pass over the table."""
    columns = columns or df.columns
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    row = df.agg(F.count("*").alias("n_rows"), *[F.count_if(~blank(c)).alias(c) for c in columns])
    return row.unpivot(["n_rows"], columns, "column", "n_filled").withColumn("fill_rate", F.round(100 * F.try_divide("n_filled", "n_rows"), 2))


def match_rate(df: DataFrame, matched: Column, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(F.count("*").alias("n_rows"), F.count_if(matched).alias("n_matched")).withColumn("match_rate", F.round(100 * F.try_divide("n_matched", "n_rows"), 2))


def plausibility(c: Column, low: float, high: float) -> Column:
    """Missing (null or not positive), Typo (outside low..high), Valid."""
    return F.when(c.isNull() | (c <= 0), "Missing").when((c > high) | (c < low), "Typo").otherwise("Valid")


def repetition_check(df: DataFrame, group: str, value: str, low: float, high: float, least_std: float, least_rows: int = 10, most_mode: float = 0.5) -> DataFrame:
    """Per group: totals by class, spread, share of the most frequent valid value, and whether values look copied."""
    rated = df.withColumn("__class", plausibility(F.col(value), low, high))
    valid = F.col("__class") == "Valid"
    per_value = rated.groupBy(group, value).agg(F.count_if(valid).alias("__n"))
    modes = per_value.groupBy(group).agg(F.max("__n").alias("__mode"))
    stats = rated.groupBy(group).agg(
        F.count("*").alias("n_rows"), F.count_if(valid).alias("n_valid"), F.count_if(F.col("__class") == "Typo").alias("n_typo"), F.count_if(F.col("__class") == "Missing").alias("n_missing"),
        F.coalesce(F.stddev_samp(F.when(valid, F.col(value))), F.lit(0.0)).alias("std"),
    )
    out = stats.join(modes, group).withColumn("mode_share", F.coalesce(F.try_divide("__mode", "n_valid"), F.lit(0.0))).drop("__mode")
    return out.withColumn("repeated", (F.col("n_valid") >= least_rows) & ((F.col("std") < least_std) | (F.col("mode_share") >= most_mode)))


def invoice_reconcile(left: DataFrame, right: DataFrame, invoice: str, year: str, series: str, value: str) -> DataFrame:
    """Per year: invoices on both sides and on one, values, and how many shared invoices have a series in common."""
    def side(df: DataFrame, n: str) -> DataFrame:
        return df.groupBy(year, invoice).agg(F.sum(value).alias(f"v_{n}"), F.collect_set(series).alias(f"s_{n}"))

    j = side(left, "l").join(side(right, "r"), [year, invoice], "full")
    both = F.col("v_l").isNotNull() & F.col("v_r").isNotNull()
    return j.groupBy(year).agg(
        F.count_if(both).alias("n_both"), F.count_if(F.col("v_r").isNull()).alias("only_left"), F.count_if(F.col("v_l").isNull()).alias("only_right"),
        F.count_if(both & F.arrays_overlap("s_l", "s_r")).alias("n_series_shared"), F.sum(F.when(both, F.col("v_r") - F.col("v_l"))).alias("difference"),
    )


#: Least rates, and the largest relative difference of row counts.
THRESHOLDS = {"client_match_rate": 0.95, "patient_match_rate": 0.95, "financial_alignment_rate": 0.9999, "row_count_pct_diff": 0.02}


def gate(metrics: dict[str, float], thresholds: dict[str, float] | None = None) -> list[str]:
    """What fails; empty if all metrics that are given pass."""
    out = []
    for name, limit in (thresholds or THRESHOLDS).items():
        if name in metrics:
            value = metrics[name]
            if abs(value) > limit if name.endswith("_diff") else value < limit:
                out.append(f"{name}: {value:.4%} against {limit:.4%}")
    return out


def layer_compare(layers: dict[str, DataFrame], last: dict[str, int] | None = None) -> list[dict]:
    """rows, columns and the change against the last run, per table."""
    out = []
    for name, df in layers.items():
        n = df.count()
        out.append({"table": name, "n_rows": n, "n_columns": len(df.columns), "change": None if name not in (last or {}) else n - last[name]})
    return out


def running_share(df: DataFrame, group: str) -> DataFrame:
    """Groups by size, with their share and the cumulative share."""
    counts = df.groupBy(group).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    # as many rows as there are groups
    w = Window.orderBy(F.desc("n"), group).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = counts.join(F.broadcast(total), F.lit(True))
    return j.select(group, "n", (F.col("n") / F.col("total")).alias("share"), (F.sum("n").over(w) / F.col("total")).alias("cumulative_share"))


def differs_anywhere(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [~x.eqNullSafe(y) for x, y in zip(left, right, strict=True)], F.lit(False))
