"""Change capture into an append log: hash append, soft deletes, batch promotion, schema evolution, marks."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import clean_value, row_hash


def clean_values(df: DataFrame) -> DataFrame:
    """Every column as text; blank and "none" become null, nested values JSON."""
    nested = {f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct")}
    return df.select(*[(F.to_json(c) if c in nested else clean_value(F.col(c))).alias(c) for c in df.columns])


def append_new(log: DataFrame, batch: DataFrame, stamp: Column, keys: list[str] | None = None) -> DataFrame:
    """log plus the rows of batch whose content it doesn't have (per business key, if given), stamped with `hash` and `extraction_timestamp`.

    Repeats inside the batch count once; new columns are added, missing ones are null.
    """
    hashed = batch.withColumn("hash", row_hash(batch.columns)).dropDuplicates([*(keys or []), "hash"])
    fresh = hashed.join(log.select(*(keys or []), "hash").distinct(), [*(keys or []), "hash"], "left_anti")
    return log.unionByName(fresh.withColumn("extraction_timestamp", stamp), allowMissingColumns=True)


def soft_delete(stored: DataFrame, fetched: DataFrame, keys: list[str], in_window: Column) -> DataFrame:
    """stored with is_deleted: the row is inside the re-read window and its key wasn't fetched again."""
    seen = fetched.select(*keys).distinct().withColumn("__seen", F.lit(True))
    return stored.join(seen, keys, "left").withColumn("is_deleted", F.coalesce(in_window, F.lit(False)) & F.col("__seen").isNull()).drop("__seen")


def absent_from_latest(log: DataFrame, at: str) -> DataFrame:
    """is_deleted by batch time: the row is older than the newest batch.

    Right only for logs that repeat unchanged rows; where unchanged rows are
    skipped, compare with the fetched keys instead (soft_delete).
    """
    newest = log.agg(F.max(at).alias("__newest"))
    return log.join(F.broadcast(newest), F.lit(True)).withColumn("is_deleted", F.col(at) < F.col("__newest")).drop("__newest")


def latest_of_log(log: DataFrame, keys: list[str], at: str = "extraction_timestamp") -> DataFrame:
    """One row a key: its newest; ties by hash."""
    from .dedup import keep_latest

    return keep_latest(log, keys, at, [F.col("hash").asc()] if "hash" in log.columns else None)


def high_water_mark(df: DataFrame, at: str, start):
    """The largest `at` so far, parsed, or start."""
    return df.agg(F.max(F.col(at).cast("timestamp_ntz"))).first()[0] or start


def time_chunks(first: date, last: date, days: int = 30) -> list[tuple[date, date]]:
    """Consecutive [from, to] stretches of at most `days` days."""
    out, at = [], first
    while at <= last:
        end = min(last, at + timedelta(days=days - 1))
        out.append((at, end))
        at = end + timedelta(days=1)
    return out


def bisect_ranges(first: int, last: int, count: Callable[[int, int], int], limit: int) -> list[tuple[int, int]]:
    """[a, b] ranges of whole units (days, seconds) that hold at most `limit` rows by count(a, b). A single unit above the limit can't be split: an error, as a part of it would be missed."""
    todo, out = [(first, last)], []
    while todo:
        a, b = todo.pop()
        if (n := count(a, b)) > limit:
            if a == b:
                raise ValueError(f"{n} rows in the one unit {a}, more than the {limit} that the service gives; use finer units")
            mid = (a + b) // 2
            todo += [(mid + 1, b), (a, mid)]
        else:
            out.append((a, b))
    return out


def sweep(step: Callable[[], int], most: int = 20) -> int:
    """Repeat an ingestion step until it adds no row; the number of sweeps."""
    for n in range(1, most + 1):
        if step() == 0:
            return n
    raise RuntimeError(f"no convergence after {most} sweeps")


def unseen_or_open(candidates: DataFrame, stored: DataFrame, keys: list[str], is_open: Column) -> DataFrame:
    """Keys to fetch: those never stored and those whose stored state is open."""
    unseen = candidates.select(*keys).distinct().join(stored.select(*keys).distinct(), keys, "left_anti")
    return unseen.union(candidates.select(*keys).distinct().join(stored.where(is_open).select(*keys).distinct(), keys, "left_semi"))


def flatten_details(df: DataFrame, details: str) -> DataFrame:
    """A header row per element of an array of structs; headers without any keep one row."""
    return df.select(*[c for c in df.columns if c != details], F.explode_outer(details).alias("__d")).select(*[c for c in df.columns if c != details], "__d.*")
