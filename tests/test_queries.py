"""Every query outside llm against its SQL on the smallest tables."""

import pandas as pd
import pytest
from pyspark.sql.functions import pandas_udf

from lakewright.functions.fuzzy import jaro_winkler_pair
from lakewright.plans import catalogue, scalars
from tests.oracle import differences


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    assert not differences(catalogue.QUERIES[name](spark, sf), catalogue.ORACLE_SQL[name], sf)[:3]


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_query_runs(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).columns


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["link_scored_match", "match_validation"])
def test_matchers_without_sql_take_every_customer(spark, sf, name):
    found = catalogue.QUERIES[name](spark, sf).select("source_id").collect()
    assert {int(r.source_id) % 100_000 % 3 for r in found} == {0, 1, 2}


def test_names_are_compared_once_for_all_keys(spark, tmp_path, monkeypatch):
    parts = [(k // 2 * 2, [None, "blue ring", "hot bolt", "hot gear"][k % 4], "Brand#1" if k % 5 else None, k % 2) for k in range(400)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    seen = spark.sparkContext.accumulator(0)

    @pandas_udf("double")
    def counted(a: pd.Series, b: pd.Series) -> pd.Series:
        seen.add(len(a))
        return pd.Series([None if x is None or y is None else jaro_winkler_pair(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    monkeypatch.setattr(scalars, "jaro_winkler", counted)
    assert not differences(catalogue.QUERIES["jaro_winkler_pairs"](spark, str(tmp_path)), catalogue.ORACLE_SQL["jaro_winkler_pairs"], str(tmp_path))[:3]
    assert 0 < seen.value <= 8  # two sizes, two names each
