"""Functions and operators on small rows: casts, names, scores, CDC, matching, ledgers, quality."""

import random
import unicodedata
from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from lakewright.functions import fuzzy, text
from lakewright.functions import values as V
from lakewright.operators import cdc, dedup, harmonise, kpi, reshape, timeline
from lakewright.operators import entity_resolution as er
from lakewright.operators.cast import infer_types
from lakewright.operators.waterfall import Rule, waterfall
from lakewright.quality import reconcile as rc


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(("value", "want"), [("5/2/2024", date(2024, 2, 5)), ("31/02/2024", None), ("00/00/0000", None), ("", None), ("NULL", None), (None, None), ("01/01/2031", None), ("1/1/1899", None)])
def test_clean_date(spark, value, want):
    assert one(spark, value, lambda c: V.clean_date(c, F.lit("2030-12-31").cast("date"))) == want


@pytest.mark.parametrize(("value", "want"), [("520.124", 520124), ("0", None), ("1", 1), ("123.0", 123), ("12A", None), (" 7 ", 7), (None, None)])
def test_chart_number(spark, value, want):
    assert one(spark, value, V.chart_number) == want
    assert one(spark, "1", lambda c: V.chart_number(c, 2)) is None


@pytest.mark.parametrize(("f", "value", "want"), [(V.currency, "1.234,56", 1234.56), (V.measure, "1,65m", 1.65), (V.measure, "kg", None), (V.clean_time, "7:05", "07:05"), (V.clean_time, "25:00", None), (V.tax_id, "123.456.789-01", "12345678901"), (V.tax_id, "111.111.111-11", None), (V.tax_id, "1234", None), (V.rounded_int, "1.7", 2), (V.rounded_int, "x", None), (V.drug_group, "b-folitropin alfa", "FOLITROPIN"), (V.id_date, "D2023.05.15_S1", date(2023, 5, 15))])
def test_values(spark, f, value, want):
    assert one(spark, value, f) == want


@pytest.mark.parametrize(("value", "want"), [("00123", "123"), ("123.0", "123"), ("2024-01-05 00:00:00", "2024-01-05"), (" AbC ", "abc"), ("000", "0"), (None, None)])
def test_normalise_key(spark, value, want):
    assert one(spark, value, V.normalise_key) == want


def test_scrub_order(spark):
    raw = "a.b@c.com, +55 11 98765-4321, 123.456.789-01, 12.345.678/0001-90"
    assert one(spark, raw, V.scrub_pii).startswith("[EMAIL_REDACTED], [PHONE_REDACTED], [")
    assert "345.678" not in one(spark, "x 12.345.678/0001-90", V.scrub_pii)


def test_strip_accents_equals_duckdb(spark):
    letters = "".join(chr(c) for c in range(0xC0, 0x250)) + unicodedata.normalize("NFD", "ãéîõüç")
    want = duckdb.execute("SELECT strip_accents(?)", [letters]).fetchone()[0]
    assert one(spark, letters, text.strip_accents) == want


def test_jaro_winkler_equals_duckdb():
    r = random.Random(0)
    pairs = [("".join(r.choice("abcd ") for _ in range(r.randrange(0, 12))), "".join(r.choice("abcd ") for _ in range(r.randrange(0, 12)))) for _ in range(400)]
    for a, b in pairs:
        want = duckdb.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]
        assert abs(fuzzy.jaro_winkler_pair(a, b) - want) < 1e-9, (a, b)


SCORES = [
    ("LIMA, Zoe", "Zoé Lima", 1), ("", "Ana Lima", 1), ("Ana Lima", "", 5), ("Ana Costa Lima", "Ana Lima", 2), ("Ana Costa Reis", "Ana Reis Costa", 2), ("Ana Costa Reis X", "Costa Ana Reis", 3), ("Ana Reis", "Ana Prado", 4),
    ("Fabio Lima", "Fabia Lima", 5), ("Phelipe Lima", "Felipe Lima", 2), ("Andre Reis", "Andra Reis", 5), ("Ana Reis", "Bruno Reis", 5), ("Kristina Reis", "Cristiny Reis", 2), ("Zoe", "Zoe", 1), ("Gabriel Reis", "Gabriela Reis", 5),
]


@pytest.mark.parametrize(("a", "b", "want"), SCORES)
def test_name_score(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string").select(text.name_words(F.col("a")).alias("p"), text.name_words(F.col("b")).alias("c"))
    score = fuzzy.name_score(F.col("p"), F.col("c"), text.phonetic_fold(F.get("p", F.lit(0))), text.phonetic_fold(F.get("c", F.lit(0))))
    assert df.select(score).first()[0] == want


def people(spark):
    rows = [
        (10, "Ana Lima", "11122233344", "05/02/1980", "Ivo Reis", None, None, "0", None, None),
        (20, "Rute Costa", None, "10/10/1985", "Otto Prado", None, None, "0", 777, None),
        (30, "Ana Lima", "11122233344", "05/02/1980", None, None, None, "1", None, None),
        (40, "Lea Moura", None, "17/03/1990", None, None, None, "0", None, 888),
    ]
    return er.prepare_people(spark.createDataFrame(rows, "codigo long, esposa_nome string, esposa_cpf string, esposa_nascimento string, marido_nome string, marido_cpf string, marido_nascimento string, inativo string, prontuario_esposa long, prontuario_marido long"), links=["prontuario_esposa", "prontuario_marido"])


def test_tiers(spark):
    source = [("x1", "Lima, Ana", None, "111.222.333-44"), ("20", "Rute Costa", None, None), ("20", "Otto Prado", None, None), ("777", "Rute Costa", "1985-10-01", None), ("40", "Nuno Pinto", None, None), ("10", "Ana Lima", None, "11122233344"), ("", "No Id", None, None), ("40", None, None, None)]
    s = er.prepare_source(spark.createDataFrame(source, "id string, name string, birth string, cpf string"), "id", "name", "birth", "cpf")
    got = {(r.source_id, r.name): (r.chart, r.tier) for r in er.resolve(s, people(spark)).collect()}
    assert got == {
        ("x1", "Lima, Ana"): (10, 1), ("20", "Rute Costa"): (20, 0), ("20", "Otto Prado"): (20, 0), ("777", "Rute Costa"): (20, 2), ("40", "Nuno Pinto"): (-1, None), ("10", "Ana Lima"): (10, 0), ("40", None): (40, 0),
    }
    target = spark.createDataFrame([("x1", -1), ("20", 5), ("zz", None)], "id string, chart long")
    filled = er.fill_unmatched(target, er.resolve(s, people(spark)), "id", "chart")
    assert {r.id: r.chart for r in filled.collect()} == {"x1": 10, "20": 5, "zz": None}


def test_validation_flags(spark):
    rows = [("1", "2", date(1980, 1, 5), date(1980, 1, 6), "ana lima", "ana lima"), (None, "2", date(1980, 1, 1), date(1980, 1, 9), "ana lima", "zzz"), (None, None, date(1980, 2, 3), date(1981, 2, 3), "ana", "otto")]
    got = [r.flags for r in er.validation_flags(spark.createDataFrame(rows, "tax string, cand_tax string, birth date, cand_birth date, full string, cand_full string")).collect()]
    assert got == ["CPF_MISMATCH,DOB_WARNING", "NAME_MISMATCH", "DOB_MISMATCH,NAME_MISMATCH"]


def test_cdc_is_idempotent_and_evolves(spark):
    empty = spark.createDataFrame([], "id string, v string, hash string, extraction_timestamp int")
    batch = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "b")], "id string, v string")
    log = cdc.append_new(empty, batch, F.lit(1))
    assert log.count() == 2
    assert cdc.append_new(log, batch, F.lit(2)).count() == 2
    wider = spark.createDataFrame([("1", "a", "new"), ("2", "c", None)], "id string, v string, w string")
    log = cdc.append_new(log, wider, F.lit(3))
    assert log.count() == 4
    assert {(r.id, r.v) for r in cdc.latest_of_log(log, ["id"]).collect()} == {("1", "a"), ("2", "c")}
    # an unchanged key of an older batch isn't deleted when compared with what was fetched
    assert {r.id: r.is_deleted for r in cdc.soft_delete(batch.distinct(), wider.where("id = '1'"), ["id"], F.lit(True)).collect()} == {"1": False, "2": True}


def test_planning_helpers():
    assert cdc.time_chunks(date(2024, 1, 1), date(2024, 3, 1), 30) == [(date(2024, 1, 1), date(2024, 1, 30)), (date(2024, 1, 31), date(2024, 2, 29)), (date(2024, 3, 1), date(2024, 3, 1))]
    ranges = cdc.bisect_ranges(0, 99, lambda a, b: b - a + 1, 10)
    with pytest.raises(ValueError, match="finer units"):
        cdc.bisect_ranges(0, 9, lambda a, b: 11, 10)
    assert [x for a, b in ranges for x in range(a, b + 1)] == list(range(100))
    assert all(b - a < 10 for a, b in ranges)
    left = [3, 2, 0]
    assert cdc.sweep(lambda: left.pop(0)) == 3
    assert harmonise.unique_names(["A", "a", "", "b"]) == ["A", "a_1", "column_3", "b"]
    assert harmonise.header_row([["x", None], ["Nome", "Data"], ["Ana", "1"]], ["nome", "data"]) == 1
    assert text.snake_case("Data da Punção") == "data_da_puncao"
    assert harmonise.map_columns(["EmbryoID", "x"], ["embryo_id"]) == {"EmbryoID": "embryo_id"}
    assert reshape.discover_roles(["esposa_nome", "esposa_cpf", "marido_nome", "outro_nome", "outro_nascimento"]) == {"esposa": 2, "outro": 5}
    assert rc.gate({"client_match_rate": 0.9, "row_count_pct_diff": 0.01}) == ["client_match_rate: 90.0000% against 95.0000%"]


def test_keep_latest_is_idempotent(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, None, "b"), (1, 5, "c"), (2, None, "d")], "k int, t int, v string")
    kept = dedup.keep_latest(df, ["k"], "t")
    assert kept.count() == 2
    assert sorted(map(tuple, dedup.keep_latest(kept, ["k"], "t").collect())) == sorted(map(tuple, kept.collect()))
    assert dedup.keep_latest_ties(df, ["k"], "t").count() == 3


def test_waterfall_one_to_one(spark):
    left = spark.createDataFrame([(1, "a", 10), (2, "a", 11), (3, "b", 5)], "lid int, k string, d int")
    right = spark.createDataFrame([(7, "a", 11), (8, "a", 13), (9, "c", 5)], "rid int, k string, d int")
    gap = F.abs(F.col("l.d") - F.col("r.d"))
    got = waterfall(left, right, "lid", "rid", [Rule([("k", "k"), ("d", "d")]), Rule([("k", "k")], gap <= 3, gap)]).collect()
    assert sorted((r.lid, r.rid, r.step) for r in got) == [(1, 8, 2), (2, 7, 1)]


def test_waterfall_keeps_pairs_of_repeated_ids(spark):
    left = spark.range(0, 6000, 1, 4).selectExpr("id % 4 AS lid", "10 + 2 * (id div 4 % 2) AS d")
    right = spark.range(0, 4, 1, 1).selectExpr("id AS rid", "11 AS d")
    gap, setting = F.abs(F.col("l.d") - F.col("r.d")), "spark.shuffle.spill.numElementsForceSpillThreshold"
    conf = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().conf()
    conf.set(setting, "300")  # sorts that spill don't keep the order of ties
    try:
        got = waterfall(left, right, "lid", "rid", [Rule([("lid", "rid")], gap <= 3, gap)]).collect()
    finally:
        conf.remove(setting)
    assert sorted((r.lid, r.rid, r.step) for r in got) == [(k, k, 1) for k in range(4)]


def test_ledger_and_dense_months(spark):
    usage = spark.createDataFrame([(1, "2024-01", 2), (1, "2024-03", 1)], "k int, month string, n long")
    billing = spark.createDataFrame([(1, "2024-02", 4), (2, "2024-01", 1)], "k int, month string, n long")
    got = {(r.k, r.month): (r.n_usage, r.n_billing, r.missing) for r in timeline.monthly_ledger(usage, billing, "k").collect()}
    assert got == {(1, "2024-01"): (2, 0, 2), (1, "2024-02"): (0, 4, -2), (1, "2024-03"): (1, 0, -1), (2, "2024-01"): (0, 1, -1)}
    cells = spark.createDataFrame([(1, date(2024, 1, 1), 3), (1, date(2024, 3, 1), 0), (2, date(2024, 2, 1), 0)], "k int, m date, n int")
    dense = timeline.dense_months(cells, "k", "m", "n", F.when(F.max("n") > 0, F.lit("2024-04-01").cast("date")).otherwise(F.max("m"))).collect()
    assert sorted((r.k, r.m.month, r.filled) for r in dense) == [(1, 1, 3), (1, 2, 3), (1, 3, 0), (1, 4, 0), (2, 2, 0)]


def test_annotations(spark):
    docs = [(1, '{"AnnotationList": [{"Name": "t2", "Time": "1"}, {"Name": "t2", "Time": "9"}, {"Name": "t3", "Value": "x"}]}'), (2, "broken"), (3, None), (4, '{"Other": 1}')]
    flat = reshape.flatten_annotations(spark.createDataFrame(docs, "id int, raw string"), ["id"], "raw")
    wide = reshape.pivot_annotations(flat, ["id"], ["t2", "t3"]).collect()
    assert [(r.id, r.Time_t2, r.Value_t3) for r in wide] == [(1, "1", "x")]


def test_reconcile_with_itself(spark):
    df = spark.createDataFrame([("1", 2.0, "a"), ("2", None, None), ("3", 4.0, " ")], "k string, v double, s string")
    r = rc.reconcile_keys(df, df.withColumn("k", F.concat(F.lit("00"), "k", F.lit(".0"))), "k", "v").first()
    assert (r.overlap, r.only_left, r.only_right, r.difference) == (1.0, 0, 0, 0.0)
    assert all(r.different == 0 for r in rc.cell_diff(df, df, ["k"], ["v", "s"]).collect())


def test_changes_and_forecast(spark):
    old, new = spark.createDataFrame([(1, 204), (2, 200), (3, 200)], "k int, c int"), spark.createDataFrame([(1, 200), (2, 500), (3, 200), (4, 200)], "k int, c int")
    assert {r.k: r.change for r in kpi.changes(old, new, "k", "c").collect()} == {1: "became_available", 2: "lost", 4: "new"}
    deals = spark.createDataFrame([("s", "lost", 1.0), ("s", "ongoing", 100.0), ("t", "won", 1.0), ("t", "ongoing", 10.0)], "stage string, status string, v double")
    assert {r.stage: r.weighted_value for r in kpi.weighted_forecast(deals, "v").collect()} == {"s": 15.0, "t": 10.0}


def test_infer_types(spark):
    df = spark.createDataFrame([("2024-01-01", "1", "1.5", "x"), ("5/2/2024", "2.0", "2", None)], "a string, b string, c string, d string")
    assert infer_types(df) == {"a": "timestamp_ntz", "b": "bigint", "c": "double", "d": "string"}


def test_clean_timestamp(spark):
    assert one(spark, "20240102_030405", lambda c: V.clean_timestamp(c, F.lit("2024-12-31").cast("timestamp_ntz"))) == datetime(2024, 1, 2, 3, 4, 5)
