"""Reusable pipeline operators: CDC, deletes, casts, harmonising, timelines, ledgers, balances."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import cdc, timeline
from ..operators.cast import CastConfig, cast_by_name
from ..operators.harmonise import canonical, consolidate_sites, drop_blank_rows, drop_sparse_columns, union_all
from ..operators.reshape import flatten_annotations, pivot_annotations, pivot_measures
from .registry import Tables, query

L = F.lit


def _text(d: DataFrame, *columns: str) -> DataFrame:
    return d.select(*[F.col(c).cast("string").alias(c) for c in columns])


@query("""SELECT o_orderkey, o_orderstatus, batch FROM (SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, 1::BIGINT AS batch FROM orders WHERE o_orderkey % 10 < 7
UNION ALL SELECT o_orderkey::VARCHAR, CASE WHEN o_orderkey % 10 = 6 THEN 'X' ELSE o_orderstatus END, 2 FROM orders WHERE o_orderkey % 10 >= 6)""")
def cdc_append(t: Tables) -> DataFrame:
    """Two overlapping batches into a log: content that is there already isn't appended; a changed row is."""
    o = _text(t.orders, "o_orderkey", "o_orderstatus")
    n = F.col("o_orderkey").cast("long") % 10
    first, second = o.where(n < 7), o.where(n >= 5).withColumn("o_orderstatus", F.when(n == 6, "X").otherwise(F.col("o_orderstatus")))
    log = cdc.append_new(first.withColumns({"hash": L(""), "extraction_timestamp": L(0).cast("long")}).limit(0), first, L(1).cast("long"))
    return cdc.append_new(log, second, L(2).cast("long")).select("o_orderkey", "o_orderstatus", F.col("extraction_timestamp").alias("batch"))


@query("SELECT o_orderkey, o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderkey % 10 = 3 AS is_deleted FROM orders")
def soft_delete(t: Tables) -> DataFrame:
    """Keys inside the re-read window that weren't fetched again."""
    fetched = t.orders.where("o_orderdate >= '2000-01-01' AND o_orderkey % 10 <> 3")
    return cdc.soft_delete(t.orders.select("o_orderkey", "o_orderdate"), fetched, ["o_orderkey"], F.col("o_orderdate") >= L("2000-01-01").cast("timestamp_ntz")).select("o_orderkey", "is_deleted")


@query("SELECT event_id, ts::DATE < (SELECT max(ts::DATE) FROM events) AS is_deleted FROM events")
def latest_batch_flag(t: Tables) -> DataFrame:
    return cdc.absent_from_latest(t.events.select("event_id", F.to_date("ts").alias("batch")), "batch").select("event_id", "is_deleted")


@query("""SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT user_id FROM events) OR o_custkey IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 90)""")
def unseen_or_open(t: Tables) -> DataFrame:
    stored = t.events.select(F.col("user_id").alias("o_custkey"), ((F.col("event_type") == "error") & (F.col("value") > 90)).alias("open"))
    return cdc.unseen_or_open(t.orders, stored, ["o_custkey"], F.col("open"))


@query("""SELECT o_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def header_detail_flatten(t: Tables) -> DataFrame:
    details = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey")).alias("items"))
    nested = t.orders.select("o_orderkey").join(details, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    return cdc.flatten_details(nested, "items")


@query("""SELECT o_orderkey::BIGINT AS o_orderkey, o_orderdate::DATE AS data_pedido, o_totalprice AS total, nullif(o_custkey, 0) AS prontuario, o_orderpriority AS nota FROM orders""")
def config_cast(t: Tables) -> DataFrame:
    """An all-text copy of orders, typed by column name."""
    money = F.replace(F.format_string("%.2f", "o_totalprice"), L("."), L(","))
    bronze = t.orders.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("data_pedido"), money.alias("total"), F.col("o_custkey").cast("string").alias("prontuario"), F.col("o_orderpriority").alias("nota"))
    config = CastConfig(dates=frozenset({"data_pedido"}), currency=frozenset({"total"}), charts=frozenset({"prontuario"}), ints=frozenset({"o_orderkey"}))
    return cast_by_name(bronze, config).withColumn("o_orderkey", F.col("o_orderkey").cast("long"))


@query("""SELECT c_custkey AS codigo, c_name AS nome_da_paciente, 'north' AS unidade FROM customer WHERE c_nationkey < 10 AND c_custkey % 4 <> 0 UNION ALL SELECT s_suppkey, s_name, 'south' FROM supplier""")
def harmonise_union(t: Tables) -> DataFrame:
    """Two sources with their own headers, renamed alike, unioned, blank and empty parts removed."""
    a = t.customer.where("c_nationkey < 10").select(F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey")).alias("Código"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")).alias("Nome da Paciente"), L(None).cast("string").alias("Vazio"))
    b = t.supplier.select(F.col("s_suppkey").alias("PIN"), F.col("s_name").alias("NOME_DA_PACIENTE"))
    synonyms = {"pin": "codigo"}
    frames = [drop_blank_rows(canonical(d, synonyms), ["codigo", "nome_da_paciente"]).withColumn("unidade", L(u)) for d, u in ((a, "north"), (b, "south"))]
    return drop_sparse_columns(union_all(frames), 0.9)


@query("""WITH u AS (SELECT 'A' AS site, o_custkey, o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'B', o_custkey, o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 2 = 1),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site, o_custkey ORDER BY o_orderdate DESC) AS rn, count(*) OVER (PARTITION BY site, o_custkey, o_orderdate) AS n FROM u) WHERE rn = 1 AND n = 1) SELECT site, o_custkey, o_orderkey FROM k""")
def multi_site(t: Tables) -> DataFrame:
    """Latest per site and key; keys with a tie at the top are left out here, as only the row hash orders them."""
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    ties = F.count("*").over(Window.partitionBy("site", "o_custkey", "o_orderdate"))
    even, odd = (o.where(F.col("o_orderkey") % 2 == i) for i in (0, 1))
    tagged = consolidate_sites({"A": even, "B": odd}, ["o_custkey"], "o_orderdate")
    unique = union_all([even.withColumn("site", L("A")), odd.withColumn("site", L("B"))]).withColumn("n", ties).where("n = 1").select("site", "o_orderkey")
    return tagged.join(unique, ["site", "o_orderkey"], "left_semi").select("site", "o_custkey", "o_orderkey")


@query("""SELECT DISTINCT kind, k, d, est AS is_estimated, CASE kind WHEN 'order' THEN 1 WHEN 'ship' THEN 2 ELSE 3 END::BIGINT AS type_order FROM (SELECT 'order' AS kind, o_custkey AS k, o_orderdate::DATE AS d, false AS est FROM orders
UNION ALL SELECT 'ship', o_custkey, CASE WHEN l_returnflag = 'R' THEN o_orderdate::DATE + 14 ELSE l_shipdate::DATE END, l_returnflag = 'R' FROM lineitem JOIN orders ON l_orderkey = o_orderkey UNION ALL SELECT 'event', user_id, ts::DATE, false FROM events)""")
def patient_timeline(t: Tables) -> DataFrame:
    """Three sources into one schema; a missing date is 14 days after the fallback and flagged."""
    o = t.orders.select(L("order").alias("kind"), F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("d"), L(False).alias("is_estimated"))
    s = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(L("ship").alias("kind"), F.col("o_custkey").alias("k"), F.when(F.col("l_returnflag") != "R", F.to_date("l_shipdate")).alias("d"), F.to_date("o_orderdate").alias("fallback"))
    s = timeline.with_fallback_date(s, "d", "fallback").drop("fallback")
    e = t.events.select(L("event").alias("kind"), F.col("user_id").alias("k"), F.to_date("ts").alias("d"), L(False).alias("is_estimated"))
    return timeline.event_timeline([o, s, e], ["k"], {"order": 1, "ship": 2}, "kind")


def _usage(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy("o_custkey", F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


def _billing(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


_LEDGER = """WITH u AS (SELECT o_custkey, strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
b AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1, 2), spine AS (SELECT o_custkey, month FROM u UNION SELECT o_custkey, month FROM b),
cells AS (SELECT s.o_custkey, s.month, coalesce(u.n, 0) AS n_usage, coalesce(b.n, 0) AS n_billing FROM spine s LEFT JOIN u ON s.o_custkey = u.o_custkey AND s.month = u.month LEFT JOIN b ON s.o_custkey = b.o_custkey AND s.month = b.month),
ledger AS (SELECT *, (sum(n_usage) OVER w)::BIGINT AS total_usage, (sum(n_billing) OVER w)::BIGINT AS total_billing, (sum(n_usage) OVER w - sum(n_billing) OVER w)::BIGINT AS missing FROM cells
WINDOW w AS (PARTITION BY o_custkey ORDER BY month ROWS UNBOUNDED PRECEDING)) """


@query(_LEDGER + "SELECT * FROM ledger WHERE n_usage > 0 OR n_billing > 0")
def monthly_ledger(t: Tables) -> DataFrame:
    """Usage against billing per customer and month: two aggregations, one union, one window."""
    return timeline.monthly_ledger(_usage(t), _billing(t), "o_custkey")


@query(_LEDGER + "SELECT * FROM ledger QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY month DESC) = 1")
def ledger_latest(t: Tables) -> DataFrame:
    return timeline.latest_per_key(monthly_ledger(t), "o_custkey", "month")


_MOVES = """SELECT l_suppkey, l_shipdate::DATE AS d, CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS q FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)"""


@query(f"SELECT l_suppkey, d, round(moved, 2) AS moved, round(sum(moved) OVER (PARTITION BY l_suppkey ORDER BY d ROWS UNBOUNDED PRECEDING), 2) AS balance FROM (SELECT l_suppkey, d, sum(q) AS moved FROM ({_MOVES}) GROUP BY 1, 2)")
def inventory_balance(t: Tables) -> DataFrame:
    moves = t.lineitem.select("l_suppkey", F.to_date("l_shipdate").alias("d"), F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("q"))
    bad = t.supplier.where("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return timeline.inventory_balance(moves, "l_suppkey", "d", "q", bad).select("l_suppkey", "d", F.round("moved", 2).alias("moved"), F.round("balance", 2).alias("balance"))


@query("""WITH c AS (SELECT o_custkey AS k, date_trunc('month', o_orderdate)::DATE AS m, count(*) AS n FROM orders GROUP BY 1, 2), e AS (SELECT k, min(m) AS a, greatest(min(m), CASE WHEN max(n) > 1 THEN DATE '2001-12-01' ELSE max(m) END) AS b FROM c GROUP BY 1),
g AS (SELECT k, unnest(generate_series(a, b, INTERVAL 1 MONTH))::DATE AS m FROM e) SELECT g.k, g.m, c.n, last_value(c.n IGNORE NULLS) OVER (PARTITION BY g.k ORDER BY g.m ROWS UNBOUNDED PRECEDING) AS filled FROM g LEFT JOIN c ON g.k = c.k AND g.m = c.m""")
def densify_ffill(t: Tables) -> DataFrame:
    """A month for every month of a customer, to a fixed end where any balance was above 1, else to the last cell."""
    cells = t.orders.groupBy(F.col("o_custkey").alias("k"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("m")).agg(F.count("*").alias("n"))
    return timeline.dense_months(cells, "k", "m", "n", F.when(F.max("n") > 1, L("2001-12-01").cast("date")).otherwise(F.max("m")))


@query("""SELECT o_custkey, month, n, round(n * 2500.0, 2)::DOUBLE AS amount, true AS is_assumed FROM (SELECT o_custkey, strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) WHERE month < '1997-01'""")
def historic_assumed(t: Tables) -> DataFrame:
    return timeline.assumed_history(_usage(t), "month", "1997-01", 2500.0)


_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("SELECT user_id, " + ", ".join(f"nullif(count(*) FILTER (event_type = '{e}'), 0) AS {e}_n, round(sum(value) FILTER (event_type = '{e}'), 2) AS {e}_total, max(value) FILTER (event_type = '{e}') AS {e}_most" for e in _TYPES) + " FROM events GROUP BY 1")
def pivot_multi_measure(t: Tables) -> DataFrame:
    return pivot_measures(t.events, ["user_id"], "event_type", _TYPES, {"n": F.count(L(1)), "total": F.round(F.sum("value"), 2), "most": F.max("value")})


@query("""WITH f AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) SELECT user_id, max(value) FILTER (event_type = 'click')::VARCHAR AS Value_click,
max(value) FILTER (event_type = 'view')::VARCHAR AS Value_view FROM f WHERE rn = 1 GROUP BY 1""")
def annotation_pivot(t: Tables) -> DataFrame:
    """Annotations of a JSON document: the first of each name, as columns."""
    notes = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type", "value"))), lambda e: F.struct(e["event_type"].alias("Name"), e["event_id"].cast("string").alias("Time"), e["value"].cast("string").alias("Value")))
    docs = t.events.groupBy("user_id").agg(F.to_json(F.struct(notes.alias("AnnotationList"))).alias("raw_json"))
    wide = pivot_annotations(flatten_annotations(docs, ["user_id"], "raw_json"), ["user_id"], ["click", "view"])
    return wide.select("user_id", "Value_click", "Value_view")
