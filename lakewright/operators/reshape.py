"""Unpivot, link-column joins, pivots, JSON flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unpivot_links(df: DataFrame, keep: list[str], links: list[str], role: str = "role", value: str = "link_id") -> DataFrame:
    """One row per non-null link column: an OR over n columns becomes one equi join."""
    return df.unpivot(keep, links, role, value).where(F.col(value).isNotNull())


def unpivot_roles(df: DataFrame, keep: list[str], roles: list[str], fields: list[str]) -> DataFrame:
    """One row per role, with its columns role_field as field; one pass, no union."""
    have = set(df.columns)
    structs = [F.struct(F.lit(r).alias("role"), *[(F.col(f"{r}_{f}") if f"{r}_{f}" in have else F.lit(None).cast("string")).cast("string").alias(f) for f in fields]) for r in roles]
    return df.select(*keep, F.inline(F.array(*structs)))


def discover_roles(columns: list[str], fixed: dict[str, int] | None = None) -> dict[str, int]:
    """role -> priority for every R with R_nome and one of R_cpf, R_nascimento; unknown roles follow in order of name."""
    fixed = {"esposa": 2, "marido": 3, "responsavel": 4} if fixed is None else fixed
    have = {c.lower() for c in columns}
    roles = sorted(c[:-5] for c in have if c.endswith("_nome") and {f"{c[:-5]}_cpf", f"{c[:-5]}_nascimento"} & have)
    free = max(fixed.values(), default=1) + 1
    rest = [r for r in roles if r not in fixed]
    return {r: fixed[r] for r in roles if r in fixed} | {r: free + i for i, r in enumerate(rest)}


def pivot_measures(df: DataFrame, keys: list[str], category: str, values: list[str], measures: dict[str, Column]) -> DataFrame:
    """<value>_<measure> columns for a fixed, ordered list of categories; absent cells are null."""
    aggs = [m.alias(n) for n, m in measures.items()]
    out = df.where(F.col(category).isin(values)).groupBy(*keys).pivot(category, values).agg(*aggs)
    if len(measures) == 1:
        name = next(iter(measures))
        out = out.withColumnsRenamed({v: f"{v}_{name}" for v in values})
    return out


def categories(df: DataFrame, category: str, most: int = 1000) -> list[str]:
    """Sorted distinct categories for a pivot; more than `most` is an error, as they become columns."""
    rows = df.select(category).where(F.col(category).isNotNull()).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{category} has more than {most} values")
    return sorted(r[0] for r in rows)


def flatten_annotations(df: DataFrame, keys: list[str], json_col: str, path: str = "AnnotationList") -> DataFrame:
    """keys, Name, Time, Value, Timestamp, position: the annotations of a JSON document, the first of each name."""
    schema = f"struct<{path}: array<struct<Name: string, Time: string, Value: string, Timestamp: string>>>"
    each = df.select(*keys, F.posexplode(F.from_json(json_col, schema)[path]).alias("position", "a")).select(*keys, "position", "a.*")
    rank = F.row_number().over(Window.partitionBy(*keys, "Name").orderBy("position"))
    return each.where(F.col("Name").isNotNull()).withColumn("__r", rank).where("__r = 1").drop("__r")


def pivot_annotations(flat: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Time_<name>, Value_<name>, Timestamp_<name> columns."""
    cells = [F.max(F.when(F.col("Name") == n, F.col(f))).alias(f"{f}_{n}") for n in names for f in ("Time", "Value", "Timestamp")]
    return flat.groupBy(*keys).agg(*cells)
