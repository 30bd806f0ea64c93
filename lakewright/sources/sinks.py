"""Sinks: tables, views, exports for people, small reports and run state."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import scrub_pii


def overwrite(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def append(df: DataFrame, table: str) -> None:
    """Columns are matched by name."""
    df.select(*df.sparkSession.table(table).columns).write.mode("append").saveAsTable(table)


def view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def european_csv(df: DataFrame, path: str, digits: int = 2) -> None:
    """Semicolons, decimal commas, all quoted, a byte-order mark in every file's first header."""
    numbers = {c for c, kind in df.dtypes if kind in ("double", "float") or kind.startswith("decimal")}
    cells = [F.when(F.col(c).isNotNull(), F.replace(F.format_string(f"%.{digits}f", F.col(c).cast("double")), F.lit("."), F.lit(","))).alias(c) if c in numbers else F.col(c).cast("string").alias(c) for c in df.columns]
    marked = df.select(*cells).withColumnRenamed(df.columns[0], "﻿" + df.columns[0])
    marked.write.mode("overwrite").csv(path, sep=";", quoteAll=True, header=True, encoding="UTF-8", nullValue="")


def excel(df: DataFrame, path: str, most: int = 1_000_000) -> None:
    """A workbook on the driver; needs openpyxl. More rows than a sheet holds are an error."""
    rows = df.limit(most + 1).toPandas()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows don't fit a sheet; use european_csv")
    rows.to_excel(path, index=False)


def markdown(df: DataFrame, title: str, most: int = 500) -> str:
    """A small result as a Markdown table, personal data scrubbed. More rows than `most` are an error."""
    rows = df.select(*[scrub_pii(F.col(c).cast("string")).alias(c) for c in df.columns]).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows are no report; aggregate them or use european_csv")
    head = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join(head + ["| " + " | ".join("" if v is None else v.replace("|", "\\|") for v in r) + " |" for r in rows]) + "\n"


def save_state(path: str, counts: dict[str, int]) -> dict[str, int]:
    """Write a run's counts and return the last run's."""
    file = Path(path)
    last = json.loads(file.read_text()) if file.exists() else {}
    file.write_text(json.dumps(counts, indent=1, sort_keys=True))
    return last
