"""Matching, KPIs, funnel, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import name_score
from ..functions.text import FOLD, name_words, phonetic_fold
from ..operators import entity_resolution as er
from ..operators import kpi
from ..operators.waterfall import Rule, waterfall
from ..quality import reconcile as rc
from .registry import Tables, query

L = F.lit

_STEPS = """l AS (SELECT l_orderkey * 10 + l_linenumber AS lid, o_custkey AS ck, l_shipdate::DATE AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
r AS (SELECT o_orderkey AS rid, o_custkey AS ck, o_orderdate::DATE AS d FROM orders)"""


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    left = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("lid"), F.col("o_custkey").alias("ck"), F.to_date("l_shipdate").alias("d"))
    return left, t.orders.select(F.col("o_orderkey").alias("rid"), F.col("o_custkey").alias("ck"), F.to_date("o_orderdate").alias("d"))


#: Days that the rules allow, one after the other: the strict six, and nine whose last ones are tolerant.
STRICT, TOLERANT = (0, 1, 2, 3, 5, 7), (0, 1, 2, 3, 5, 7, 14, 30, 60)


def _rules(days: tuple[int, ...]) -> list[Rule]:
    gap = F.abs(F.datediff(F.col("l.d"), F.col("r.d")))
    return [Rule([("ck", "ck"), ("d", "d")]) if n == 0 else Rule([("ck", "ck")], gap <= n, gap) for n in days]


def _waterfall_sql(days: tuple[int, ...], both: bool) -> str:
    ctes, seen = [_STEPS], []
    for i, on in enumerate((f"abs(date_diff('day', l.d, r.d)) <= {n}" if n else "l.d = r.d" for n in days), 1):
        left = "".join(f" AND l.lid NOT IN (SELECT lid FROM m{j})" for j in seen)
        right = "".join(f" AND r.rid NOT IN (SELECT rid FROM m{j})" for j in seen) if both else ""
        gap = "abs(date_diff('day', l.d, r.d))"
        ranks = f"row_number() OVER (PARTITION BY lid ORDER BY {gap}, rid) AS a, row_number() OVER (PARTITION BY rid ORDER BY {gap}, lid) AS b"
        ctes.append(f"m{i} AS (SELECT lid, rid, {i}::BIGINT AS step FROM (SELECT lid, rid, {ranks} FROM l JOIN r ON l.ck = r.ck AND {on}{left}{right}) WHERE a = 1{' AND b = 1' if both else ''})")
        seen.append(i)
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(f"SELECT * FROM m{i}" for i in seen)


@query(_waterfall_sql(STRICT, True))
def waterfall_one_to_one(t: Tables) -> DataFrame:
    left, right = _sides(t)
    return waterfall(left, right, "lid", "rid", _rules(STRICT))


@query(_waterfall_sql(TOLERANT, False))
def waterfall_left(t: Tables) -> DataFrame:
    left, right = _sides(t)
    return waterfall(left, right, "lid", "rid", _rules(TOLERANT), consume="left")


#: Invented names, for a corpus of people made from customer keys.
FIRST = ["Ana", "Paula", "João", "Marta", "Rute", "Ivo", "Philipe", "Yara", "Zoe", "Otto", "Lea", "Nuno"]
LAST = ["Lima", "Costa", "de Souza", "Pinto", "Moura", "Reis", "Prado"]


def _sql_list(x: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in x) + "]"


_NAMES = f"""names AS (SELECT c_custkey AS k, {_sql_list(FIRST)}[c_custkey % 12 + 1] AS f, {_sql_list(LAST)}[c_custkey % 7 + 1] AS n FROM customer)"""
_SOURCE_NAME = """CASE k % 5 WHEN 0 THEN n || ', ' || f WHEN 1 THEN f || ' ' || n WHEN 2 THEN upper(f) || ' X ' || n WHEN 3 THEN replace(f, 'a', 'aa') || ' ' || n ELSE 'Beltrano ' || n END"""


def _people(t: Tables) -> DataFrame:
    pick = lambda x, n: F.get(F.array(*map(L, x)), (F.col("k") % n).cast("int"))
    return t.customer.select(F.col("c_custkey").alias("k")).select("k", pick(FIRST, 12).alias("f"), pick(LAST, 7).alias("n"))


def _source_name() -> F.Column:
    k, f, n = F.col("k") % 5, F.col("f"), F.col("n")
    return F.when(k == 0, F.concat(n, L(", "), f)).when(k == 1, F.concat(f, L(" "), n)).when(k == 2, F.concat(F.upper(f), L(" X "), n)).when(k == 3, F.concat(F.replace(f, L("a"), L("aa")), L(" "), n)).otherwise(F.concat(L("Beltrano "), n))


def _words_sql(c: str) -> str:
    ordered = f"CASE WHEN contains({c}, ',') THEN split_part({c}, ',', 2) || ' ' || split_part({c}, ',', 1) ELSE {c} END"
    return f"list_filter(regexp_split_to_array(regexp_replace(strip_accents(lower(trim({ordered}))), '[^a-z]', ' ', 'g'), '\\s+'), lambda w: length(w) > 0)"


def _fold_sql(c: str) -> str:
    for a, b in FOLD:
        c = f"replace({c}, '{a}', '{b}')"
    return c


def _score_sql(p: str, c: str, pf: str, cf: str) -> str:
    """The name score without the couple rule."""
    ends = lambda pairs: " OR ".join(f"({pf} LIKE '%{a}' AND {cf} LIKE '%{b}')" for a, b in pairs)
    weak = [("o", "a"), ("a", "o"), ("o", "e"), ("e", "o")]
    strong = [*weak, ("an", "ne"), ("ne", "an"), ("dre", "dra"), ("dra", "dre")]
    near = f"levenshtein({pf}, {cf}) <= 1 AND NOT ({ends(strong)} OR {cf} = {pf} || 'a' OR {pf} = {cf} || 'a')"
    two = f"levenshtein({pf}, {cf}) = 2 AND list_contains({c}, {p}[-1]) AND NOT ({ends(weak)})"
    return f"""(CASE WHEN {p} IS NULL OR len({p}) = 0 THEN 1 WHEN {c} IS NULL OR len({c}) = 0 THEN 5 WHEN {p} = {c} THEN 1
WHEN NOT (list_contains({c}, {p}[1]) OR coalesce({near}, false) OR coalesce({two}, false)) THEN 5 WHEN list_contains({c}, {p}[-1]) THEN 2 WHEN len(list_filter({p}, lambda w: list_contains({c}, w))) > 1 THEN 3 ELSE 4 END)::BIGINT"""


@query(f"""WITH {_NAMES}, w AS (SELECT k, {_words_sql(_SOURCE_NAME)} AS p, {_words_sql("f || ' ' || n")} AS c0 FROM names), o AS (SELECT a.k AS a, b.k AS b, a.p, b.c0 AS c FROM w a JOIN w b ON b.k BETWEEN a.k - 3 AND a.k + 3)
SELECT a, b, {_score_sql("p", "c", _fold_sql("p[1]"), _fold_sql("c[1]"))} AS score FROM o""")
def name_scores(t: Tables) -> DataFrame:
    w = _people(t).select("k", name_words(_source_name()).alias("p"), name_words(F.concat("f", L(" "), "n")).alias("c"))
    # each name against those of the seven keys around it
    a, b = w.select(F.col("k").alias("a"), "p", F.explode(F.sequence(F.col("k") - 3, F.col("k") + 3)).alias("b")), w.select(F.col("k").alias("b"), "c")
    score = name_score(F.col("p"), F.col("c"), phonetic_fold(F.get("p", L(0))), phonetic_fold(F.get("c", L(0))))
    return a.join(b, "b").select("a", "b", score.cast("long").alias("score"))


def _er_frames(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Source records that name a chart, a tax id or a partner, and the charts with two roles each."""
    p = _people(t)
    k = F.col("k")
    tax = lambda n: F.lpad((n * 7919 + 12345678).cast("string"), 11, "0")
    source = p.select(
        F.when(k % 2 == 0, k).otherwise(k + 100000).cast("string").alias("id"), _source_name().alias("name"), F.when(k % 4 == 1, tax(k)).alias("cpf"), F.date_format(F.date_add(L("1980-01-01").cast("date"), (k % 5000).cast("int")), "yyyy-MM-dd").alias("birthdate"),
    )
    pick = lambda x, n: F.get(F.array(*map(L, x)), (n % len(x)).cast("int"))
    patients = p.select(
        k.alias("codigo"), F.concat("f", L(" "), "n").alias("esposa_nome"), tax(k).alias("esposa_cpf"), F.date_format(F.date_add(L("1980-01-01").cast("date"), (k % 5000).cast("int")), "dd/MM/yyyy").alias("esposa_nascimento"),
        F.concat(pick(FIRST, k + 5), L(" "), pick(LAST, k + 3)).alias("marido_nome"), L(None).cast("string").alias("marido_cpf"), L(None).cast("string").alias("marido_nascimento"),
        F.when(k % 9 == 0, "1").otherwise("0").alias("inativo"), (k + 100000).alias("prontuario_esposa"), F.when(k % 2 == 0, k + 99997).alias("prontuario_marido"),
    )
    return source, patients


def _er_sql(links: bool = True) -> str:
    tax = "lpad(({} * 7919 + 12345678)::VARCHAR, 11, '0')".format
    roles = []
    for role, pri in (("esposa", 2), ("marido", 3)):
        roles.append(f"SELECT codigo AS chart, codigo AS link_id, 1 AS priority, {role}_nome AS nome, {role}_cpf AS cpf, {role}_nascimento AS nasc, e_w, m_w, inativo FROM pw")
        if links:
            roles.append(f"SELECT codigo, prontuario_{role}, {pri}, {role}_nome, {role}_cpf, {role}_nascimento, e_w, m_w, inativo FROM pw WHERE prontuario_{role} IS NOT NULL")
    fold = _fold_sql
    own, e, m = (_score_sql("p", c, fold("p[1]"), fold(f"{c}[1]")) for c in ("c", "e_w", "m_w"))
    full = lambda w: f"array_to_string({w}, ' ')"

    def couple(s: str, c: str) -> str:
        """The score with the couple rule where the id is direct."""
        shared = f"list_filter(p, lambda w: list_contains({c}, w))"
        strong = f"len(list_filter({shared}, lambda w: w NOT IN ('de', 'da', 'do', 'dos', 'das', 'e', 'a', 'o'))) >= 2"
        return f"CASE WHEN {s} = 5 AND tier IN (0, 3) AND len({c}) > 0 AND jaro_winkler_similarity(p_full, {full(c)}) >= 0.72 AND {strong} THEN CASE WHEN list_contains({c}, p[-1]) THEN 2 WHEN len({shared}) > 1 THEN 3 ELSE 4 END ELSE {s} END"

    return f"""WITH {_NAMES}, src AS (SELECT DISTINCT CASE WHEN k % 2 = 0 THEN k ELSE k + 100000 END AS num, {_SOURCE_NAME} AS name, CASE WHEN k % 4 = 1 THEN {tax('k')} END AS cpf, (DATE '1980-01-01' + (k % 5000)::INTEGER) AS birth FROM names),
s AS (SELECT *, {_words_sql('name')} AS p FROM src), s2 AS (SELECT *, {full('p')} AS p_full FROM s),
pat AS (SELECT k AS codigo, f || ' ' || n AS esposa_nome, {tax('k')} AS esposa_cpf, (DATE '1980-01-01' + (k % 5000)::INTEGER) AS esposa_nascimento, {_sql_list(FIRST)}[(k + 5) % 12 + 1] || ' ' || {_sql_list(LAST)}[(k + 3) % 7 + 1] AS marido_nome,
NULL::VARCHAR AS marido_cpf, NULL::DATE AS marido_nascimento, CASE WHEN k % 9 = 0 THEN '1' ELSE '0' END AS inativo, k + 100000 AS prontuario_esposa, CASE WHEN k % 2 = 0 THEN k + 99997 END AS prontuario_marido FROM names),
pw AS (SELECT *, {_words_sql('esposa_nome')} AS e_w, {_words_sql('marido_nome')} AS m_w FROM pat), people AS (SELECT *, {_words_sql('nome')} AS c FROM ({' UNION ALL '.join(roles)})),
cand AS (SELECT s2.*, people.*, 1 AS tier FROM s2 JOIN people ON s2.cpf = people.cpf UNION ALL SELECT s2.*, people.*, 2 FROM s2 JOIN people ON num = link_id WHERE s2.cpf IS NULL AND (birth = nasc OR day(birth) = 1 AND date_trunc('month', birth) = date_trunc('month', nasc))
UNION ALL SELECT s2.*, people.*, 0 FROM s2 JOIN people ON num = link_id AND priority = 1 UNION ALL SELECT s2.*, people.*, 3 FROM s2 JOIN people ON num = link_id AND priority >= 2),
sc AS (SELECT *, {own} AS s0, {e} AS s1, {m} AS s2_ FROM cand), sc2 AS (SELECT *, least({couple('s0', 'c')}, {couple('s1', 'e_w')}, {couple('s2_', 'm_w')}) AS score FROM sc),
best AS (SELECT num, name, chart, tier, score, nome, row_number() OVER (PARTITION BY num, name ORDER BY tier, inativo, CASE WHEN link_id = num THEN 0 ELSE 1 END, score, priority, chart DESC, nome) AS rn FROM sc2 WHERE score < 5)
SELECT s.num::VARCHAR AS source_id, s.name, coalesce(b.chart, -1)::BIGINT AS chart, b.tier::BIGINT AS tier, b.score::BIGINT AS score, b.nome AS matched_name FROM (SELECT DISTINCT num, name FROM s) s LEFT JOIN best b ON s.num = b.num AND s.name = b.name AND rn = 1"""


@query(_er_sql())
def entity_resolution(t: Tables) -> DataFrame:
    """All tiers over a corpus of invented people, each of whom is a source, too."""
    source, patients = _er_frames(t)
    s = er.prepare_source(source, "id", "name", "birthdate", "cpf")
    return er.resolve(s, er.prepare_people(patients, links=["prontuario_esposa", "prontuario_marido"]))


_SIMILAR, _MONTH = "jaro_winkler_similarity(a, b)", "day(birth) = 1 AND date_trunc('month', birth) = date_trunc('month', nasc)"


@query(f"""WITH er AS ({_er_sql(links=False)}), {_NAMES}, person AS (SELECT CASE WHEN k % 2 = 0 THEN k ELSE k + 100000 END AS num, {_SOURCE_NAME} AS name, CASE WHEN k % 4 = 1 THEN lpad((k * 7919 + 12345678)::VARCHAR, 11, '0') END AS cpf, (DATE '1980-01-01' + (k % 5000)::INTEGER) AS birth FROM names),
pat AS (SELECT k AS codigo, f || ' ' || n AS nome, lpad((k * 7919 + 12345678)::VARCHAR, 11, '0') AS own, (DATE '1980-01-01' + (k % 5000)::INTEGER) AS nasc FROM names),
pairs AS (SELECT source_id, chart, cpf, own, birth, nasc, array_to_string({_words_sql("person.name")}, ' ') AS a, array_to_string({_words_sql("pat.nome")}, ' ') AS b FROM er JOIN person ON er.source_id = person.num::VARCHAR AND er.name = person.name JOIN pat ON chart = codigo)
SELECT source_id, chart, concat_ws(',', CASE WHEN cpf IS NOT NULL AND cpf <> own THEN 'CPF_MISMATCH' END, CASE WHEN birth <> nasc AND NOT ({_MONTH}) AND {_SIMILAR} < 0.85 THEN 'DOB_MISMATCH' END,
CASE WHEN birth <> nasc AND NOT ({_MONTH}) AND {_SIMILAR} >= 0.85 THEN 'DOB_WARNING' END, CASE WHEN {_SIMILAR} < 0.75 THEN 'NAME_MISMATCH' END) AS flags FROM pairs""")
def match_validation(t: Tables) -> DataFrame:
    """Flags against matches."""
    source, patients = _er_frames(t)
    s = er.prepare_source(source, "id", "name", "birthdate", "cpf")
    people = er.prepare_people(patients)
    found = er.resolve(s, people).where("chart <> -1")
    joined = found.join(s.select("source_id", "name", "tax", "birth", "full"), ["source_id", "name"]).join(people.where("role = 'esposa' AND priority = 1").select("chart", "cand_tax", "cand_birth", "cand_full"), "chart")
    return er.validation_flags(joined).select("source_id", "chart", "flags")


_DEALS = """deals AS (SELECT event_id, user_id % 4 AS stage, CASE event_type WHEN 'purchase' THEN 'won' WHEN 'error' THEN 'lost' ELSE 'ongoing' END AS status, value, ts - INTERVAL 1 DAY * (event_id % 40) AS created, ts AS updated, ts + INTERVAL 1 HOUR * (event_id % 50) AS closed FROM events)"""


def _deals(t: Tables) -> DataFrame:
    e, k = F.col("event_type"), F.col("event_id")
    status = F.when(e == "purchase", "won").when((e == "error"), "lost").otherwise("ongoing")
    back = F.make_dt_interval((k % 40).cast("int"), L(0), L(0), L(0).cast("decimal(18,6)"))
    on = F.make_dt_interval(L(0), (k % 50).cast("int"), L(0), L(0).cast("decimal(18,6)"))
    return t.events.select("event_id", (F.col("user_id") % 4).alias("stage"), status.alias("status"), "value", (F.col("ts") - back).alias("created"), F.col("ts").alias("updated"), (F.col("ts") + on).alias("closed"))


@query(f"""WITH {_DEALS}, n AS (SELECT max(updated) AS now FROM deals) SELECT count(*) AS n_deals, count(*) FILTER (status = 'ongoing') AS n_open, count(*) FILTER (status = 'won') AS n_won, count(*) FILTER (status = 'lost') AS n_lost, round(sum(value) FILTER (status = 'won'), 2) AS won_value,
round(sum(value) FILTER (status = 'ongoing'), 2) AS open_value, round(avg(date_diff('second', created, closed) / 86400) FILTER (status = 'won'), 2) AS cycle_days, round(avg(date_sub('second', created, now) / 86400) FILTER (status = 'ongoing'), 2) AS age_days,
count(*) FILTER (status = 'ongoing' AND date_sub('second', updated, now) / 86400 >= 15) AS n_stalled, round(100.0 * count(*) FILTER (status = 'won') / count(*) FILTER (status IN ('won', 'lost')), 2) AS win_rate FROM deals, n""")
def crm_kpis(t: Tables) -> DataFrame:
    k = kpi.pipeline_kpis(_deals(t), "value", "created", "updated", "closed")
    return k.select("n_deals", "n_open", "n_won", "n_lost", *[F.round(c, 2).alias(c) for c in ("won_value", "open_value", "cycle_days", "age_days")], "n_stalled", F.round("win_rate", 2).alias("win_rate"))


@query(f"""WITH {_DEALS} SELECT stage, count(*) FILTER (status = 'ongoing') AS n_open, round(sum(value) FILTER (status = 'ongoing') * CASE WHEN count(*) FILTER (status = 'won') > 0 THEN count(*) FILTER (status = 'won') / count(*) FILTER (status <> 'ongoing') ELSE 0.15 END, 2) AS weighted_value FROM deals GROUP BY 1""")
def weighted_forecast(t: Tables) -> DataFrame:
    return kpi.weighted_forecast(_deals(t), "value").select("stage", "n_open", F.round("weighted_value", 2).alias("weighted_value"))


@query("""WITH top AS (SELECT user_id, event_id % 3 AS g, max(CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 END) AS step FROM events GROUP BY 1, 2),
r AS (SELECT s.step, s.stage, count(top.step) AS reached FROM (VALUES (1::BIGINT, 'signup'), (2, 'view'), (3, 'click'), (4, 'purchase')) s(step, stage) LEFT JOIN (SELECT user_id * 3 + g AS k, step FROM top) top ON top.step >= s.step GROUP BY 1, 2)
SELECT step, stage, reached, round(reached / nullif(coalesce(lag(reached) OVER (ORDER BY step), reached), 0), 6) AS step_rate, round(reached / nullif(first_value(reached) OVER (ORDER BY step), 0), 6) AS overall_rate FROM r""")
def funnel(t: Tables) -> DataFrame:
    e = t.events.select((F.col("user_id") * 3 + F.col("event_id") % 3).alias("k"), "event_type")
    f = kpi.funnel(e, "k", "event_type", ["signup", "view", "click", "purchase"])
    return f.select("step", "stage", "reached", F.round("step_rate", 6).alias("step_rate"), F.round("overall_rate", 6).alias("overall_rate"))


@query("""WITH e AS (SELECT user_id, CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 204 WHEN 'error' THEN 500 ELSE 0 END AS code, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events),
j AS (SELECT a.user_id, b.code AS old, a.code AS new FROM e a LEFT JOIN e b ON a.user_id = b.user_id AND b.rn = 2 AND a.user_id % 10 <> 0 WHERE a.rn = 1)
SELECT user_id, old::BIGINT AS old, new::BIGINT AS new, CASE WHEN old IS NULL THEN 'new' WHEN new = 200 THEN 'became_available' WHEN old = 200 THEN 'lost' ELSE 'changed' END AS change FROM j WHERE old IS DISTINCT FROM new""")
def change_classify(t: Tables) -> DataFrame:
    code = F.when(F.col("event_type") == "view", 200).when(F.col("event_type") == "click", 204).when(F.col("event_type") == "error", 500).otherwise(0).cast("long")
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    d = t.events.select("user_id", code.alias("code"), F.row_number().over(w).alias("rn")).where("rn <= 2")
    return kpi.changes(d.where("rn = 2 AND user_id % 10 <> 0"), d.where("rn = 1"), "user_id", "code")


@query("""SELECT coalesce(c.k, p.k) AS k, coalesce(n_cycles, 0) AS n_cycles, coalesce(n_payments, 0) AS n_payments, round(coalesce(amount, 0), 2) AS amount, CASE WHEN coalesce(n_cycles, 0) > 0 AND coalesce(n_payments, 0) = 0 THEN 'cycles_without_payment' WHEN coalesce(n_cycles, 0) = 0 THEN 'payment_without_cycles'
WHEN n_cycles > n_payments THEN 'more_cycles' WHEN n_cycles < n_payments THEN 'more_payments' ELSE 'balanced' END AS status FROM (SELECT user_id AS k, count(*) AS n_cycles FROM events WHERE event_type = 'view' GROUP BY 1) c
FULL JOIN (SELECT o_custkey AS k, count(*) AS n_payments, sum(o_totalprice) AS amount FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) p ON c.k = p.k""")
def financial_summary(t: Tables) -> DataFrame:
    cycles = t.events.where("event_type = 'view'").select(F.col("user_id").alias("k"))
    payments = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("amount"))
    return kpi.financial_summary(cycles, payments, "k").withColumn("amount", F.round("amount", 2))


def _copy(t: Tables) -> DataFrame:
    """orders with a tenth missing, keys written differently and a few values changed."""
    k = F.col("o_orderkey")
    return t.orders.where("o_orderkey % 10 <> 7").select(F.concat(L("00"), k.cast("string"), L(".0")).alias("key"), F.when(k % 13 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"), F.when(k % 17 == 0, "?").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), k.alias("o_orderkey"))


@query("""SELECT (SELECT count(*) FROM orders) AS n_left, count(*) AS n_right, count(*) AS n_both, (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 7) AS only_left, 0::BIGINT AS only_right, round(count(*) / (SELECT count(*) FROM orders), 6) AS overlap,
count(*) FILTER (o_orderkey % 13 = 0)::DOUBLE AS difference FROM orders WHERE o_orderkey % 10 <> 7""")
def reconcile_keys(t: Tables) -> DataFrame:
    left = t.orders.select(F.col("o_orderkey").cast("string").alias("key"), "o_totalprice")
    r = rc.reconcile_keys(left, _copy(t), "key", "o_totalprice")
    return r.select("n_left", "n_right", "n_both", "only_left", "only_right", F.round("overlap", 6).alias("overlap"), F.round("difference", 2).alias("difference"))


@query("""SELECT c AS "column", count(*) AS compared, CASE c WHEN 'o_totalprice' THEN count(*) FILTER (o_orderkey % 13 = 0) ELSE count(*) FILTER (o_orderkey % 17 = 0) END AS different FROM orders, (VALUES ('o_totalprice'), ('o_orderstatus')) v(c) WHERE o_orderkey % 10 <> 7 GROUP BY c""")
def cell_diff(t: Tables) -> DataFrame:
    return rc.cell_diff(t.orders, _copy(t), ["o_orderkey"], ["o_totalprice", "o_orderstatus"])


@query("""SELECT 'p' AS "column", count(*) AS n_rows, count(*) FILTER (o_orderkey % 4 <> 0) AS n_filled, round(100.0 * count(*) FILTER (o_orderkey % 4 <> 0) / count(*), 2) AS fill_rate FROM orders
UNION ALL SELECT 'o_custkey', count(*), count(*), 100.0 FROM orders""")
def fill_profile(t: Tables) -> DataFrame:
    d = t.orders.select(F.when(F.col("o_orderkey") % 4 == 1, " x ").when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).otherwise(L(" ")).alias("p"), "o_custkey")
    return rc.fill_profile(d, ["p", "o_custkey"])


@query("""WITH c AS (SELECT event_type, value, CASE WHEN value IS NULL OR value <= 0 THEN 'Missing' WHEN value > 150 OR value < 40 THEN 'Typo' ELSE 'Valid' END AS c FROM events), m AS (SELECT event_type, max(n) AS m FROM (SELECT event_type, value, count(*) AS n FROM c WHERE c = 'Valid' GROUP BY 1, 2) GROUP BY 1)
SELECT c.event_type, count(*) AS n_rows, count(*) FILTER (c = 'Valid') AS n_valid, count(*) FILTER (c = 'Typo') AS n_typo, count(*) FILTER (c = 'Missing') AS n_missing, round(stddev_samp(value) FILTER (c = 'Valid'), 4) AS std, round(m.m / nullif(count(*) FILTER (c = 'Valid'), 0), 6) AS mode_share,
count(*) FILTER (c = 'Valid') >= 10 AND (stddev_samp(value) FILTER (c = 'Valid') < 1 OR m.m / nullif(count(*) FILTER (c = 'Valid'), 0) >= 0.5) AS repeated FROM c JOIN m ON c.event_type = m.event_type GROUP BY c.event_type, m.m""")
def plausibility(t: Tables) -> DataFrame:
    r = rc.repetition_check(t.events, "event_type", "value", 40, 150, 1.0)
    return r.withColumns({"std": F.round("std", 4), "mode_share": F.round("mode_share", 6)})


@query("""SELECT year(o_orderdate)::BIGINT AS y, count(*) AS n_rows, count(*) FILTER (c_acctbal > 5000) AS n_matched, round(100.0 * count(*) FILTER (c_acctbal > 5000) / count(*), 2) AS match_rate FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def join_match_rate(t: Tables) -> DataFrame:
    j = t.orders.join(t.customer.where("c_acctbal > 5000"), F.col("o_custkey") == F.col("c_custkey"), "left").withColumn("y", F.year("o_orderdate").cast("long"))
    return rc.match_rate(j, F.col("c_custkey").isNotNull(), ["y"])


@query("""WITH l AS (SELECT year(o_orderdate)::BIGINT AS y, o_custkey AS i, sum(o_totalprice) AS v, list(DISTINCT o_orderstatus) AS s FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1, 2), r AS (SELECT year(o_orderdate)::BIGINT AS y, o_custkey AS i, sum(o_totalprice) AS v, list(DISTINCT o_orderstatus) AS s FROM orders WHERE o_orderkey % 3 <> 1 GROUP BY 1, 2)
SELECT coalesce(l.y, r.y) AS y, count(*) FILTER (l.v IS NOT NULL AND r.v IS NOT NULL) AS n_both, count(*) FILTER (r.v IS NULL) AS only_left, count(*) FILTER (l.v IS NULL) AS only_right, count(*) FILTER (list_has_any(l.s, r.s)) AS n_series_shared,
round(sum(r.v - l.v), 2) AS difference FROM l FULL JOIN r ON l.y = r.y AND l.i = r.i GROUP BY 1""")
def invoice_reconcile(t: Tables) -> DataFrame:
    d = t.orders.withColumn("y", F.year("o_orderdate").cast("long"))
    r = rc.invoice_reconcile(d.where("o_orderkey % 3 <> 0"), d.where("o_orderkey % 3 <> 1"), "o_custkey", "y", "o_orderstatus", "o_totalprice")
    return r.withColumn("difference", F.round("difference", 2))
