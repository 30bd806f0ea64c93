"""Config-driven casting: a column's name picks its rule."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V


@dataclass(frozen=True)
class CastConfig:
    """Column names by rule, in order of precedence; other columns stay text."""

    timestamps: frozenset[str] = frozenset()
    dates: frozenset[str] = frozenset()
    times: frozenset[str] = frozenset()
    currency: frozenset[str] = frozenset()
    charts: frozenset[str] = frozenset()
    ints: frozenset[str] = frozenset()
    doubles: frozenset[str] = frozenset()
    measures: frozenset[str] = frozenset()
    as_of: str = "2100-01-01"
    renames: dict[str, str] = field(default_factory=dict)


def cast_column(name: str, config: CastConfig) -> Column:
    c, key = F.col(f"`{name}`").cast("string"), name.lower()
    as_of = F.lit(config.as_of).cast("date")
    rules = [
        (config.timestamps, lambda: V.clean_timestamp(c, F.lit(config.as_of).cast("timestamp_ntz"))),
        (config.dates, lambda: V.clean_date(c, as_of)),
        (config.times, lambda: V.clean_time(c)),
        (config.currency, lambda: V.currency(c)),
        (config.charts, lambda: V.chart_number(c)),
        (config.ints, lambda: V.rounded_int(c)),
        (config.doubles, lambda: c.try_cast("double")),
        (config.measures, lambda: V.measure(c)),
    ]
    for names, rule in rules:
        if key in {n.lower() for n in names}:
            return rule()
    return c


def cast_by_name(df: DataFrame, config: CastConfig) -> DataFrame:
    return df.select(*[cast_column(c, config).alias(config.renames.get(c, c)) for c in df.columns])


def infer_types(df: DataFrame, date_share: float = 0.5, number_share: float = 0.8, patterns: tuple[str, ...] = ("yyyy-MM-dd", "d/M/yyyy")) -> dict[str, str]:
    """timestamp, int, double or string for each text column, from one pass over all its non-null values."""
    found = []
    for c in df.columns:
        x = F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit(""))
        found += [F.count(x), F.count(V.first_date(x, list(patterns))), F.count(x.try_cast("double")), F.count(F.when(x.rlike(r"^-?\d+(\.0+)?$"), 1))]
    row = list(df.agg(*[f.alias(f"a{i}") for i, f in enumerate(found)]).first())
    kinds = {}
    for i, c in enumerate(df.columns):
        n, dates, numbers, whole = row[4 * i : 4 * i + 4]
        if n and dates > date_share * n:
            kinds[c] = "timestamp_ntz"
        elif n and numbers > number_share * n:
            kinds[c] = "bigint" if whole == numbers else "double"
        else:
            kinds[c] = "string"
    return kinds


def type_of_name(name: str) -> str:
    """Type by parts of the column's name, for registries that state none."""
    key = name.lower()
    if "date" in key or key.startswith("data_"):
        return "date"
    if key.startswith(("number", "no_", "num_", "n_")) or "count" in key:
        return "int"
    return "string"


def drop_valid_less(df: DataFrame, charts: list[str], keep_all: bool = False) -> DataFrame:
    """Chart columns cleaned; rows without any valid chart are dropped unless keep_all."""
    cleaned = df.withColumns({c: V.chart_number(F.col(c)) for c in charts})
    return cleaned if keep_all else cleaned.where(F.coalesce(*[F.col(c) for c in charts]).isNotNull())
