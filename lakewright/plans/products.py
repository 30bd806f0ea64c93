"""Gold products: dimensions, stars in a legacy layout, CRM fields, a table for models, simpler matchers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import name_words
from ..operators import entity_resolution as er
from ..operators.dedup import keep_first
from ..operators.timeline import prior_count
from .analytics import FIRST, LAST, _er_frames, _people, _source_name, _sql_list, _words_sql
from .registry import Tables, query

L = F.lit


@query("""WITH last AS (SELECT o_custkey, o_orderpriority, o_orderdate::DATE AS d FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1)
SELECT c_custkey, c_name, coalesce(o_orderpriority, 'none') AS last_priority, d AS last_date, coalesce(n_name, 'unknown') AS unit FROM customer LEFT JOIN last ON c_custkey = o_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def patient_dimension(t: Tables) -> DataFrame:
    """An entity with its latest attributes, its unit, and defaults."""
    last = keep_first(t.orders.where("o_orderstatus = 'F'"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("last_date"))
    d = t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return d.select("c_custkey", "c_name", F.coalesce("o_orderpriority", L("none")).alias("last_priority"), "last_date", F.coalesce("n_name", L("unknown")).alias("unit"))


@query("""SELECT lpad(o_custkey::VARCHAR, 6, '0') AS "Cliente", upper(c_name) AS "Nome", o_orderdate::DATE AS "DT Emissao", p_name AS "Descricao", l_quantity AS "Qntd.", round(l_extendedprice * (1 - l_discount), 4) AS "Total",
CASE WHEN n_regionkey IN (0, 1) THEN 'North' WHEN n_regionkey = 2 THEN 'Centre' ELSE 'South' END AS "Unidade", CASE WHEN l_returnflag = 'R' THEN 'DEV' ELSE 'NF' END AS "Serie Docto.", coalesce(nullif(l_linestatus, 'O'), 'open') AS "Situacao"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON l_partkey = p_partkey WHERE o_orderstatus <> 'P'""")
def sales_star_legacy(t: Tables) -> DataFrame:
    """Invoice lines with their dimensions in the column names of an older export."""
    d = t.lineitem.join(t.orders.where("o_orderstatus <> 'P'"), F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    d = d.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
    unit = F.when(F.col("n_regionkey").isin(0, 1), "North").when(F.col("n_regionkey") == 2, "Centre").otherwise("South")
    return d.select(
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("Cliente"), F.upper("c_name").alias("Nome"), F.to_date("o_orderdate").alias("DT Emissao"), F.col("p_name").alias("Descricao"), F.col("l_quantity").alias("Qntd."),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("Total"), unit.alias("Unidade"), F.when(F.col("l_returnflag") == "R", "DEV").otherwise("NF").alias("Serie Docto."), F.coalesce(F.nullif("l_linestatus", L("O")), L("open")).alias("Situacao"),
    )


@query("""SELECT event_id, user_id AS contact_id, c AS linked_contact, nullif(props->>'$.k', '')::BIGINT AS field_k, CASE WHEN user_id % 2 = 0 THEN 'clinic-' || user_id % 5 END AS clinic FROM events, (VALUES (0), (1)) v(i), LATERAL (SELECT (user_id + i)::VARCHAR AS c) WHERE i <= event_id % 2""")
def crm_fields_and_bridge(t: Tables) -> DataFrame:
    """Custom fields out of a JSON object with hyphenated keys, and a bridge row per id of a JSON array."""
    u = F.col("user_id")
    fields = F.to_json(F.struct(F.when(u % 2 == 0, F.concat(L("clinic-"), (u % 5).cast("string"))).alias("custom-clinic")))
    ids = F.to_json(F.when(F.col("event_id") % 2 == 0, F.array(u.cast("string"))).otherwise(F.array(u.cast("string"), (u + 1).cast("string"))))
    d = t.events.select("event_id", u.alias("contact_id"), "props", fields.alias("custom_fields"), ids.alias("contact_ids"))
    return d.select("event_id", "contact_id", F.explode(F.from_json("contact_ids", "array<string>")).alias("linked_contact"), F.get_json_object("props", "$.k").try_cast("long").alias("field_k"), F.get_json_object("custom_fields", "$['custom-clinic']").alias("clinic"))


@query("""SELECT o_orderkey AS "Order Key", coalesce(nullif(o_orderpriority, '5-LOW'), c_mktsegment) AS "Class", round(c_acctbal, 1) AS "Balance", (SELECT count(*) FROM orders b WHERE b.o_custkey = o.o_custkey AND b.o_orderdate::DATE < o.o_orderdate::DATE) AS "Prior Orders",
(SELECT count(*) FROM orders b WHERE b.o_custkey = o.o_custkey AND b.o_orderdate::DATE < o.o_orderdate::DATE AND b.o_orderstatus = 'O') AS "Prior Open" FROM orders o JOIN customer ON o_custkey = c_custkey""")
def model_table(t: Tables) -> DataFrame:
    """Renamed columns, fallbacks, and counts of what happened before each row's date."""
    d = prior_count(t.orders, "o_custkey", "o_orderdate", L(True), "Prior Orders")
    d = prior_count(d, "o_custkey", "o_orderdate", F.col("o_orderstatus") == "O", "Prior Open").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return d.select(F.col("o_orderkey").alias("Order Key"), F.coalesce(F.nullif("o_orderpriority", L("5-LOW")), "c_mktsegment").alias("Class"), F.round("c_acctbal", 1).alias("Balance"), "Prior Orders", "Prior Open")


_PEOPLE = f"""names AS (SELECT c_custkey AS k, {_sql_list(FIRST)}[c_custkey % 12 + 1] AS f, {_sql_list(LAST)}[c_custkey % 7 + 1] AS n FROM customer),
src AS (SELECT k, {_words_sql("CASE k % 5 WHEN 0 THEN n || ', ' || f WHEN 1 THEN f || ' ' || n WHEN 2 THEN upper(f) || ' X ' || n WHEN 3 THEN replace(f, 'a', 'aa') || ' ' || n ELSE 'Beltrano ' || n END")} AS p FROM names),
cand AS (SELECT k, 1 AS priority, {_words_sql("f || ' ' || n")} AS c FROM names UNION ALL SELECT k + 3, 2, {_words_sql("f || ' ' || n")} FROM names UNION ALL SELECT k + 5, 3, {_words_sql("f || ' ' || n")} FROM names)"""


@query(f"""WITH {_PEOPLE}, j AS (SELECT src.k, priority, cand.c, CASE WHEN contains(array_to_string(c, ' '), p[1]) THEN 1 WHEN contains(array_to_string(c, ' '), p[-1]) THEN 2 END AS pass FROM src JOIN cand ON src.k = cand.k WHERE len(p) > 0)
SELECT k, pass::BIGINT AS pass, priority::BIGINT AS priority, array_to_string(c, ' ') AS name FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY pass, priority, array_to_string(c, ' ') DESC) AS rn FROM j WHERE pass IS NOT NULL) WHERE rn = 1""")
def pass_matcher(t: Tables) -> DataFrame:
    """The first matcher: an id join filtered by the first name inside the candidate's, then by the last; main, spouse, other."""
    p = _people(t)
    words = lambda c: name_words(c)
    src = p.select("k", words(_source_name()).alias("p")).where(F.size("p") > 0)
    full = F.array_join(words(F.concat("f", L(" "), "n")), " ")
    cand = p.select(F.explode(F.array(*[F.struct((F.col("k") + s).alias("k"), L(i).alias("priority")) for i, s in ((1, 0), (2, 3), (3, 5))])).alias("x"), full.alias("name")).select("x.*", "name")
    j = src.join(cand, "k").withColumn("pass", F.when(F.contains("name", F.get("p", L(0))), 1).when(F.contains("name", F.try_element_at("p", L(-1))), 2))
    best = Window.partitionBy("k").orderBy("pass", "priority", F.desc("name"))
    return j.where("pass IS NOT NULL").withColumn("rn", F.row_number().over(best)).where("rn = 1").select("k", F.col("pass").cast("long"), F.col("priority").cast("long"), "name")


_SOURCE = "CASE k % 5 WHEN 0 THEN n || ', ' || f WHEN 1 THEN f || ' ' || n WHEN 2 THEN upper(f) || ' X ' || n WHEN 3 THEN replace(f, 'a', 'aa') || ' ' || n ELSE 'Beltrano ' || n END"


@query(f"""WITH names AS (SELECT c_custkey AS k, {_sql_list(FIRST)}[c_custkey % 12 + 1] AS f, {_sql_list(LAST)}[c_custkey % 7 + 1] AS n FROM customer),
src AS (SELECT CASE WHEN k % 2 = 0 THEN k ELSE k + 100000 END AS num, {_words_sql(_SOURCE)} AS p FROM names),
pat AS (SELECT k, CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END AS inactive, {_words_sql("f || ' ' || n")} AS e, {_words_sql(f"{_sql_list(FIRST)}[(k + 5) % 12 + 1] || ' ' || {_sql_list(LAST)}[(k + 3) % 7 + 1]")} AS m FROM names),
links AS (SELECT *, k + 100000 AS link_id, 1 AS rank FROM pat UNION ALL SELECT *, k + 99997, 3 FROM pat WHERE k % 2 = 0),
scored AS (SELECT num, k, inactive, rank + CASE WHEN p[-1] IN (e[-1], m[-1]) THEN 0 ELSE 2 END AS score FROM src JOIN links ON num = link_id WHERE p[1] IN (e[1], m[1]))
SELECT num::VARCHAR AS source_id, k AS chart, score::BIGINT AS score FROM (SELECT *, row_number() OVER (PARTITION BY num ORDER BY inactive, score, k DESC) AS rn FROM scored) WHERE rn = 1""")
def link_scored_match(t: Tables) -> DataFrame:
    """The scored matcher over many link columns, active people first."""
    source, patients = _er_frames(t)
    people = patients.select(F.col("codigo").alias("chart"), F.col("inativo").alias("inactive"), "esposa_nome", "marido_nome", "prontuario_esposa", "prontuario_marido")
    return er.link_scored_match(er.prepare_source(source, "id", "name"), people, ["prontuario_esposa", "prontuario_marido"], ["esposa_nome", "marido_nome"])


def run_flow(steps: list[tuple[str, Callable[[], None]]], log: Callable[[str], None] = print) -> None:
    """Named steps one after the other; the first that fails stops the flow."""
    for name, step in steps:
        log(f"start {name}")
        step()
        log(f"done {name}")
