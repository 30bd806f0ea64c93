"""Casts, dates, text, JSON, hashes, keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.fuzzy import jaro_winkler
from ..functions.text import FOLD, name_words, phonetic_fold, strip_accents
from .registry import Tables, query

L = F.lit


@query("""SELECT o_orderkey, try_cast(x AS INTEGER)::BIGINT AS i, try_cast(x AS DOUBLE) AS d, CASE WHEN x LIKE '%,%' THEN try_cast(replace(replace(x, '.', ''), ',', '.') AS DOUBLE) END AS money
FROM (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN (o_custkey / 4.0)::VARCHAR WHEN 1 THEN 'NULL' WHEN 2 THEN ' 5 ' WHEN 3 THEN '' WHEN 4 THEN '1.234,56' ELSE o_custkey::VARCHAR END AS x FROM orders)""")
def try_cast_rules(t: Tables) -> DataFrame:
    k = F.col("o_orderkey") % 6
    x = F.when(k == 0, (F.col("o_custkey") / 4.0).cast("string")).when(k == 1, "NULL").when(k == 2, " 5 ").when(k == 3, "").when(k == 4, "1.234,56").otherwise(F.col("o_custkey").cast("string"))
    d = t.orders.select("o_orderkey", x.alias("x"))
    half_even = F.rint(F.col("x").try_cast("double"))
    return d.select("o_orderkey", F.when(F.col("x").try_cast("double") % 1 == 0.5, F.round(F.col("x").try_cast("double"))).otherwise(half_even).cast("long").alias("i"), F.col("x").try_cast("double").alias("d"), F.when(F.contains("x", L(",")), V.currency(F.col("x"))).alias("money"))


_DATES = """(SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%-d/%-m/%Y') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 2 THEN '00/00/0000' WHEN 3 THEN '31/02/1999'
WHEN 4 THEN '' WHEN 5 THEN '5/2/2150' ELSE '5/2/1850' END AS x FROM orders)"""


@query(f"""SELECT o_orderkey, CASE WHEN try_strptime(x, '%d/%m/%Y') <= DATE '2000-01-01' AND year(try_strptime(x, '%d/%m/%Y')) BETWEEN 1900 AND 2030 THEN try_strptime(x, '%d/%m/%Y')::DATE END AS d FROM {_DATES}""")
def date_parse_rules(t: Tables) -> DataFrame:
    """Day/month/year texts; sentinels, impossible days, the future of a fixed day and odd years are null."""
    k = F.col("o_orderkey") % 7
    x = F.when(k == 0, F.date_format("o_orderdate", "d/M/yyyy")).when(k == 1, F.date_format("o_orderdate", "dd/MM/yyyy")).when(k == 2, "00/00/0000").when(k == 3, "31/02/1999").when(k == 4, "").when(k == 5, "5/2/2150").otherwise("5/2/1850")
    return t.orders.select("o_orderkey", V.clean_date(x, L("2000-01-01").cast("date")).alias("d"))


@query("""SELECT o_orderkey, coalesce(try_strptime(x, '%Y-%m-%d'), try_strptime(x, '%Y%m%d'), try_strptime(x, '%d/%m/%Y'))::DATE AS d FROM (SELECT o_orderkey,
CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE 'soon' END AS x FROM orders)""")
def date_fallback(t: Tables) -> DataFrame:
    k = F.col("o_orderkey") % 4
    x = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "yyyyMMdd")).when(k == 2, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise("soon")
    return t.orders.select("o_orderkey", V.first_date(x, ["yyyy-MM-dd", "yyyyMMdd", "d/M/yyyy"]).alias("d"))


@query("""SELECT o_orderkey, year(d)::BIGINT AS y, month(d)::BIGINT AS m, day(d)::BIGINT AS dd, date_trunc('month', d)::DATE AS first_day, (d + 14) AS later, date_diff('day', DATE '1995-01-01', d) AS age,
round(date_diff('day', d, DATE '2002-01-01') / 365.25, 2) AS years FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
def date_parts(t: Tables) -> DataFrame:
    d = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return d.select("o_orderkey", F.year("d").cast("long").alias("y"), F.month("d").cast("long").alias("m"), F.day("d").cast("long").alias("dd"), F.trunc("d", "month").alias("first_day"), F.date_add("d", 14).alias("later"),
                    F.datediff("d", L("1995-01-01").cast("date")).cast("long").alias("age"), V.age_years(F.col("d"), L("2002-01-01").cast("date")).alias("years"))


@query("""SELECT event_id, try_strptime(regexp_extract(x, 'D(20[0-9]{2}\\.[0-9]{2}\\.[0-9]{2})', 1), '%Y.%m.%d')::DATE AS d FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'D' || strftime(ts, '%Y.%m.%d') || '_S' || user_id WHEN event_id % 3 = 1 THEN 'X' || event_id ELSE NULL END AS x FROM events)""")
def id_embedded_date(t: Tables) -> DataFrame:
    k = F.col("event_id") % 3
    x = F.when(k == 0, F.concat(L("D"), F.date_format("ts", "yyyy.MM.dd"), L("_S"), F.col("user_id").cast("string"))).when(k == 1, F.concat(L("X"), F.col("event_id").cast("string")))
    return t.events.select("event_id", V.id_date(x).alias("d"))


@query("""SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits, lpad(right(c_name, 4), 6, '*') AS tail, position('#' IN c_name)::BIGINT AS hash_at, split_part(c_name, '#', 1) AS head, split_part(c_name, '#', 5) AS none,
list_aggregate(regexp_extract_all(c_name, '[0-9]{3}'), 'string_agg', '|') AS groups, regexp_matches(c_name, '7$') AS ends7 FROM customer""")
def regex_clean(t: Tables) -> DataFrame:
    n = F.col("c_name")
    return t.customer.select("c_custkey", F.regexp_replace(n, "[^0-9]", "").alias("digits"), F.lpad(F.right(n, L(4)), 6, "*").alias("tail"), F.instr(n, "#").cast("long").alias("hash_at"), F.split_part(n, L("#"), L(1)).alias("head"), F.split_part(n, L("#"), L(5)).alias("none"),
                             F.array_join(F.regexp_extract_all(n, L("[0-9]{3}"), L(0)), "|").alias("groups"), n.rlike("7$").alias("ends7"))


@query("""SELECT p_partkey, w[1] AS first_word, w[-1] AS last_word, w[9] AS ninth, len(w) AS n_words, list_contains(w, 'part') AS has_part FROM (SELECT p_partkey, list_filter(regexp_split_to_array(lower(' ' || p_name), '\\s+'), lambda x: length(x) > 0) AS w FROM part)""")
def split_rules(t: Tables) -> DataFrame:
    w = F.filter(F.split(F.lower(F.concat(L(" "), F.col("p_name"))), r"\s+"), lambda x: F.length(x) > 0)
    d = t.part.select("p_partkey", w.alias("w"))
    return d.select("p_partkey", F.get("w", L(0)).alias("first_word"), F.try_element_at("w", L(-1)).alias("last_word"), F.try_element_at("w", L(9)).alias("ninth"), F.size("w").cast("long").alias("n_words"), F.array_contains("w", "part").alias("has_part"))


@query("""SELECT o_orderkey, least(nullif(o_orderkey % 3, 0), nullif(o_custkey % 5, 0)) AS lo, greatest(nullif(o_orderkey % 3, 0), nullif(o_custkey % 5, 0)) AS hi, round(power(o_custkey % 9, 2), 2) AS sq, abs(o_custkey - 700) AS dist,
floor(o_totalprice * 10) / 10 AS cut, o_custkey / nullif(o_orderkey % 4, 0) AS ratio FROM orders""")
def math_null_rules(t: Tables) -> DataFrame:
    a, b = F.nullif(F.col("o_orderkey") % 3, L(0)), F.nullif(F.col("o_custkey") % 5, L(0))
    return t.orders.select("o_orderkey", F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"), F.round(F.pow(F.col("o_custkey") % 9, L(2)), 2).alias("sq"), F.abs(F.col("o_custkey") - 700).alias("dist"),
                           (F.floor(F.col("o_totalprice") * 10) / 10).alias("cut"), F.try_divide("o_custkey", F.col("o_orderkey") % 4).alias("ratio"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k, json_extract_string(props, '$.\"missing-key\"') AS missing, json_extract_string('[{\"email\": \"u' || user_id || '\"}, {\"email\": \"x\"}]', '$[0].email') AS first_email FROM events")
def json_extract(t: Tables) -> DataFrame:
    emails = F.concat(L('[{"email": "u'), F.col("user_id").cast("string"), L('"}, {"email": "x"}]'))
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"), F.get_json_object("props", "$['missing-key']").alias("missing"), F.get_json_object(emails, "$[0].email").alias("first_email"))


@query("SELECT event_id, unnest(string_split(event_type || ',' || (user_id % 7) || ',' || event_type, ',')) AS item FROM events")
def json_explode(t: Tables) -> DataFrame:
    text = F.to_json(F.array(F.col("event_type"), (F.col("user_id") % 7).cast("string"), F.col("event_type")))
    return t.events.select("event_id", F.explode(F.from_json(text, "array<string>")).alias("item"))


@query("SELECT o_orderkey, md5('o_custkey:' || o_custkey || '|o_orderkey:' || o_orderkey || '|o_orderpriority:' || trim(o_orderpriority) || '|o_orderstatus:' || coalesce(nullif(o_orderstatus, 'P'), '')) AS hash FROM orders")
def row_hash(t: Tables) -> DataFrame:
    d = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", F.nullif("o_orderstatus", L("P")).alias("o_orderstatus"))
    return d.select("o_orderkey", V.row_hash(["o_orderstatus", "o_orderkey", "o_custkey", "o_orderpriority"]).alias("hash"))


@query("""SELECT o_orderkey, CASE WHEN regexp_matches(k, '^[0-9]+$') THEN coalesce(nullif(ltrim(k, '0'), ''), '0') ELSE replace(k, ' 00:00:00', '') END AS k FROM (SELECT o_orderkey, regexp_replace(lower(trim(x)), '\\.0$', '') AS k FROM (SELECT o_orderkey,
CASE o_orderkey % 5 WHEN 0 THEN ' 00' || o_custkey || ' ' WHEN 1 THEN o_custkey || '.0' WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00') WHEN 3 THEN 'AbC' || o_custkey ELSE '000' END AS x FROM orders))""")
def normalised_keys(t: Tables) -> DataFrame:
    k, c = F.col("o_orderkey") % 5, F.col("o_custkey").cast("string")
    x = F.when(k == 0, F.concat(L(" 00"), c, L(" "))).when(k == 1, F.concat(c, L(".0"))).when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd 00:00:00")).when(k == 3, F.concat(L("AbC"), c)).otherwise("000")
    return t.orders.select("o_orderkey", V.normalise_key(x).alias("k"))


@query("""SELECT o_orderkey, CASE WHEN regexp_matches(x, '^[0-9]{1,3}(\\.[0-9]{3})+$|^[0-9]+$') THEN nullif(replace(x, '.', '')::BIGINT, 0) END AS chart FROM (SELECT o_orderkey, regexp_replace(trim(x), '\\.0$', '') AS x FROM (SELECT o_orderkey,
CASE o_orderkey % 6 WHEN 0 THEN '520.124' WHEN 1 THEN '0' WHEN 2 THEN o_custkey || '.0' WHEN 3 THEN o_custkey || 'A' WHEN 4 THEN ' ' || o_custkey ELSE NULL END AS x FROM orders))""")
def chart_numbers(t: Tables) -> DataFrame:
    k, c = F.col("o_orderkey") % 6, F.col("o_custkey").cast("string")
    x = F.when(k == 0, "520.124").when(k == 1, "0").when(k == 2, F.concat(c, L(".0"))).when(k == 3, F.concat(c, L("A"))).when(k == 4, F.concat(L(" "), c))
    return t.orders.select("o_orderkey", V.chart_number(x).alias("chart"))


_SCRUB = "text"
for _pattern, _new in V.SCRUB:
    _SCRUB = f"regexp_replace({_SCRUB}, '{_pattern}', '{_new}', 'g')"


@query(f"SELECT doc_id, md5({_SCRUB}) AS scrubbed, ({_SCRUB}) <> text AS changed FROM documents")
def pii_scrub(t: Tables) -> DataFrame:
    s = V.scrub_pii(F.col("text"))
    return t.documents.select("doc_id", F.md5(s).alias("scrubbed"), (s != F.col("text")).alias("changed"))


@query("SELECT doc_id, md5(strip_accents(text)) AS plain FROM documents")
def accents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(strip_accents(F.col("text"))).alias("plain"))


_FOLD = "lower(p_name)"
for _a, _b in FOLD:
    _FOLD = f"replace({_FOLD}, '{_a}', '{_b}')"


@query(f"SELECT p_partkey, {_FOLD} AS folded FROM part")
def phonetic_folds(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", phonetic_fold(F.lower("p_name")).alias("folded"))


@query("""SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(regexp_replace(strip_accents(lower(trim(CASE WHEN contains(n, ',') THEN split_part(n, ',', 2) || ' ' || split_part(n, ',', 1) ELSE n END))), '[^a-z]', ' ', 'g'), '\\s+'), lambda w: length(w) > 0), ' ') AS words FROM (SELECT doc_id, text AS n FROM documents)""")
def name_words_of_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.array_join(name_words(F.col("text")), " ").alias("words"))


@query("SELECT a.p_partkey AS a, b.p_partkey AS b, round(jaro_winkler_similarity(a.p_name, b.p_name), 4) AS similarity FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey")
def jaro_winkler_pairs(t: Tables) -> DataFrame:
    """Equi join of the distinct names of a brand and size first; the Arrow function sees each pair of those once, and keys are paired after it."""
    p = t.part.groupBy("p_brand", "p_size", "p_name").agg(F.collect_list("p_partkey").alias("keys"), F.min("p_partkey").alias("lo"), F.max("p_partkey").alias("hi"))
    a, b = p.withColumnsRenamed({"p_name": "x", "keys": "of_x"}).drop("hi"), p.withColumnsRenamed({"p_name": "y", "keys": "of_y"}).drop("lo")
    scored = a.join(b, ["p_brand", "p_size"]).where("lo < hi").select("of_x", "of_y", F.round(jaro_winkler(F.col("x"), F.col("y")), 4).alias("similarity"))
    return scored.select(F.explode("of_x").alias("a"), "of_y", "similarity").select("a", F.explode("of_y").alias("b"), "similarity").where("a < b")


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, round(abs((l_quantity) * try_cast(replace(replace(regexp_replace(dose, '[^0-9,.]', '', 'g'), '.', ''), ',', '.') AS DOUBLE) * (24.0 / nullif(gap, 0))), 4) AS dose_total,
CASE WHEN length(split_part(upper(replace(drug, '-', ' ')), ' ', 1)) <= 1 THEN split_part(upper(replace(drug, '-', ' ')), ' ', 2) ELSE split_part(upper(replace(drug, '-', ' ')), ' ', 1) END AS drug_group
FROM (SELECT *, (l_linenumber * 1.5)::VARCHAR || ',25 mg' AS dose, l_linenumber % 4 AS gap, CASE WHEN l_linenumber % 2 = 0 THEN 'b-' || l_returnflag || 'x' ELSE lower(l_linestatus) || 'n-' || l_returnflag END AS drug FROM lineitem)""")
def prescription_enrichment(t: Tables) -> DataFrame:
    n = F.col("l_linenumber")
    dose = F.concat((n * L(1.5).cast("decimal(2,1)")).cast("string"), L(",25 mg"))
    drug = F.when(n % 2 == 0, F.concat(L("b-"), F.col("l_returnflag"), L("x"))).otherwise(F.concat(F.lower("l_linestatus"), L("n-"), F.col("l_returnflag")))
    return t.lineitem.select("l_orderkey", n.cast("long").alias("l_linenumber"), F.round(V.total_dose(F.col("l_quantity"), V.dose(dose), n % 4), 4).alias("dose_total"), V.drug_group(drug).alias("drug_group"))


@query("SELECT p_partkey, CASE WHEN w > 0 AND h > 0 THEN round(w / power(h, 2), 2) END AS bmi FROM (SELECT p_partkey, try_cast(replace(p_size || ',5kg', ',', '.')[:-3] AS DOUBLE) AS w, (p_partkey % 3) * 0.9 AS h FROM part)")
def bmi_measures(t: Tables) -> DataFrame:
    weight = V.measure(F.concat(F.col("p_size").cast("string"), L(",5kg")))
    return t.part.select("p_partkey", V.bmi(weight, (F.col("p_partkey") % 3) * 0.9).alias("bmi"))
