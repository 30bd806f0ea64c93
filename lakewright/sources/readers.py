"""Readers: databases, text files as text, JSON, spreadsheets, files by pattern, the catalog."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.harmonise import header_row, unique_names, union_all


def jdbc(spark: SparkSession, url: str, query: str, partition_column: str | None = None, bounds: tuple | None = None, partitions: int = 16, **options: str) -> DataFrame:
    """A query of a database; with a partition column and bounds, read in parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column and bounds:
        reader = reader.option("dbtable", f"({query}) q").options(partitionColumn=partition_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions))
        return reader.load()
    return reader.option("query", query).load()


def csv_text(spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """All columns as text, with file_name: no inference pass, no guessed types."""
    rows = spark.read.csv(path, header=True, sep=sep, encoding=encoding, inferSchema=False, multiLine=True, escape='"')
    return rows.select("*", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file_name"))


def json_arrays(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold one JSON array each."""
    return spark.read.schema(schema).json(path, multiLine=True)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Result logs, a JSON object a line; broken lines go to _corrupt_record where the schema has it."""
    return spark.read.schema(schema).json(path)


def with_path_metadata(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Columns read from the file's path (decoded): name -> pattern with one group."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return df.withColumns({n: F.nullif(F.regexp_extract(path, p, 1), F.lit("")) for n, p in patterns.items()})


def newest_file(spark: SparkSession, pattern: str) -> str:
    """The path of the file that was written last among those of a pattern."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime").orderBy(F.desc("modificationTime"), F.desc("path")).limit(1).collect()
    if not files:
        raise FileNotFoundError(pattern)
    return files[0]["path"]


def sheets(spark: SparkSession, pattern: str, keywords: list[str] | None = None) -> DataFrame:
    """Spreadsheets of a pattern: file_name, sheet_name, line_number, cells (header -> text), read on the executors.

    The header is the row with most of the keywords. .csv and .tsv files are one
    sheet; .xlsx and .xls need a reader that pandas knows (openpyxl).
    """
    wanted = list(keywords or [])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                name = path.rsplit("/", 1)[-1]
                if name.lower().endswith((".csv", ".tsv")):
                    raw = {"": pd.read_csv(io.BytesIO(content), header=None, dtype=str, sep="\t" if name.lower().endswith(".tsv") else None, engine="python", skip_blank_lines=False)}
                else:
                    raw = pd.read_excel(io.BytesIO(content), sheet_name=None, header=None, dtype=str)
                for sheet, table in raw.items():
                    rows = table.astype(object).where(table.notna(), None).values.tolist()
                    if not rows:
                        continue
                    at = header_row(rows, wanted)
                    names = unique_names([(v or "").strip() for v in rows[at]])
                    out = [(name, sheet, i, dict(zip(names, r, strict=True))) for i, r in enumerate(rows[at + 1 :], at + 2)]
                    yield pd.DataFrame(out, columns=["file_name", "sheet_name", "line_number", "cells"])

    files = spark.read.format("binaryFile").load(pattern).select("path", "content")
    return files.mapInPandas(run, "file_name string, sheet_name string, line_number long, cells map<string, string>")


def table_of_file(file_name: str) -> str:
    """A table name from a file's stem."""
    stem = re.sub(r"\.[^.]*$", "", file_name)
    return re.sub(r"[^0-9a-z]+", "_", stem.lower()).strip("_")


def tables_like(spark: SparkSession, pattern: str, database: str | None = None) -> list[str]:
    """Names of tables and views that match, in order."""
    return sorted(t.name for t in spark.catalog.listTables(database, pattern))


def union_tables_like(spark: SparkSession, pattern: str, database: str | None = None, tag: str = "source_table") -> DataFrame:
    """All matching tables by name of column, each row tagged with its table."""
    found = tables_like(spark, pattern, database)
    if not found:
        raise LookupError(f"no table like {pattern}")
    return union_all([spark.table(f"{database}.{t}" if database else t).withColumn(tag, F.lit(t)) for t in found])


def describe(spark: SparkSession, name: str) -> dict[str, str]:
    """column -> type of a table, without reading it."""
    return dict(spark.table(name).dtypes)
