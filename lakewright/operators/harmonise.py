"""Many sources, one schema: header detection, names, synonyms, mapping tables, unions, blank rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import snake_case


def unique_names(names: list[str]) -> list[str]:
    """Repeated headers, in any case, get _1, _2, ...; empty ones are named by their place."""
    seen: dict[str, int] = {}
    out = []
    for i, name in enumerate(names):
        name = name or f"column_{i + 1}"
        n = seen.get(name.lower(), 0)
        seen[name.lower()] = n + 1
        out.append(f"{name}_{n}" if n else name)
    return out


def header_row(rows: list[list[str | None]], keywords: list[str], look: int = 20) -> int:
    """The place of the row, among the first ones, that holds the most keywords; 0 if none has any."""
    votes = [sum(any(k.lower() in (v or "").lower() for v in row) for k in keywords) for row in rows[:look]]
    return max(range(len(votes)), key=lambda i: (votes[i], -i)) if votes else 0


def canonical(df: DataFrame, synonyms: dict[str, str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Columns in snake_case without accents, synonyms resolved; several columns of one name are coalesced in order."""
    groups: dict[str, list[Column]] = {}
    for c in df.columns:
        name = snake_case(c)
        groups.setdefault((synonyms or {}).get(name, name), []).append(F.col(f"`{c}`"))
    return df.select(*[(cs[0] if len(cs) == 1 else F.coalesce(*cs)).alias(n) for n, cs in groups.items() if keep is None or n in keep])


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """target: source projection over what exists; missing sources are null text."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[s.lower()]}`") if s.lower() in have else F.lit(None).cast("string")).alias(t) for t, s in columns.items()])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows, columns by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_mapped(sources: dict[str, tuple[DataFrame, dict[str, str]]], tag: str = "source") -> DataFrame:
    """Each source projected by its own mapping and tagged with its name."""
    return union_all([project(df, columns).withColumn(tag, F.lit(name)) for name, (df, columns) in sources.items()])


def prefixed(df: DataFrame, alias: str, columns: list[str] | None = None) -> list[Column]:
    """alias.col AS alias_col for the configured columns that exist."""
    return [F.col(f"{alias}.{c}").alias(f"{alias}_{c}") for c in (columns or df.columns) if c in df.columns]


def is_blank(c: Column) -> Column:
    """Null, only white space, or a spelling of nothing."""
    return c.isNull() | F.lower(F.trim(c.cast("string"))).isin("", "nan", "none", "null", "nat")


def drop_blank_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows with something in at least one of the columns."""
    return df.where(F.exists(F.array(*[~is_blank(F.col(f"`{c}`")) for c in (columns or df.columns)]), lambda x: x))


def drop_sparse_rows(df: DataFrame, share: float = 0.5) -> DataFrame:
    """Rows of which at most `share` of the columns are null."""
    nulls = reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNull().cast("int") for c in df.columns])
    return df.where(nulls / len(df.columns) <= share)


def drop_sparse_columns(df: DataFrame, share: float = 0.9, protect: list[str] | None = None) -> DataFrame:
    """Columns of which at most `share` of the values are null, and the protected ones; one aggregate pass."""
    row = df.agg(F.count("*").alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    keep = [c for i, c in enumerate(df.columns) if c in (protect or []) or not row["n"] or 1 - row[f"c{i}"] / row["n"] <= share]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def starts_with_any(c: Column, prefixes: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.startswith(p) for p in prefixes], F.lit(False))


def add_missing(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    return df.withColumns({n: v for n, v in defaults.items() if n not in df.columns})


def consolidate_sites(sites: dict[str, DataFrame], keys: list[str], at: str, tag: str = "site") -> DataFrame:
    """Rows of all sites, tagged, the latest of each key within its site."""
    from .dedup import keep_latest

    tagged = union_all([df.withColumn(tag, F.lit(name)) for name, df in sites.items()])
    return keep_latest(tagged, [tag, *keys], at)


def map_columns(left: list[str], right: list[str], custom: dict[str, str] | None = None, prefixes: tuple[str, ...] = ()) -> dict[str, str]:
    """left -> right column names: custom ones, then equal in snake_case, then equal without a prefix."""
    by_name = {snake_case(c): c for c in right}
    out = {}
    for c in left:
        name = snake_case(c)
        bare = next((name[len(p) :] for p in prefixes if name.startswith(p)), name)
        found = (custom or {}).get(c) or by_name.get(name) or by_name.get(bare)
        if found:
            out[c] = found
    return out
