"""Projections, filters, joins, set operations, sorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import mapped
from ..operators.dedup import delete_orphans, null_aware_anti, update_from, upsert
from ..operators.harmonise import add_missing, drop_sparse_rows, prefixed, starts_with_any, union_all, union_mapped
from ..operators.reshape import unpivot_links
from ..operators.waterfall import bridge_outer
from .registry import Tables, query

L = F.lit


@query("""SELECT l.l_orderkey, l.l_linenumber::BIGINT AS l_linenumber, o.o_orderstatus, c.c_name, n.n_name, r.r_name, p.p_brand, s.s_name
FROM lineitem l LEFT JOIN orders o ON l_orderkey = o_orderkey LEFT JOIN customer c ON o_custkey = c_custkey LEFT JOIN nation n ON c_nationkey = n_nationkey
LEFT JOIN region r ON n_regionkey = r_regionkey LEFT JOIN part p ON l_partkey = p_partkey LEFT JOIN supplier s ON l_suppkey = s_suppkey""")
def star_left_chain(t: Tables) -> DataFrame:
    """Fact and six dimensions; small ones are broadcast by their statistics, not by a hint."""
    d = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    d = d.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    d = d.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return d.select("l_orderkey", F.col("l_linenumber").cast("long"), "o_orderstatus", "c_name", "n_name", "r_name", "p_brand", "s_name")


@query("""SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS n_lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey GROUP BY 1, 2""")
def same_dim_twice(t: Tables) -> DataFrame:
    cn = t.nation.select(F.col("n_nationkey").alias("ck"), F.col("n_name").alias("customer_nation"))
    sn = t.nation.select(F.col("n_nationkey").alias("sk"), F.col("n_name").alias("supplier_nation"))
    d = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return d.join(cn, F.col("c_nationkey") == F.col("ck"), "left").join(sn, F.col("s_nationkey") == F.col("sk"), "left").groupBy("customer_nation", "supplier_nation").agg(F.count("*").alias("n_lines"))


@query("""SELECT coalesce(o.k, e.k) AS k, n_orders, n_events FROM (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1) o
FULL JOIN (SELECT user_id AS k, count(*) AS n_events FROM events GROUP BY 1) e ON o.k = e.k""")
def full_outer_summary(t: Tables) -> DataFrame:
    o = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n_orders"))
    e = t.events.groupBy(F.col("user_id").alias("k")).agg(F.count("*").alias("n_events"))
    return o.join(e, "k", "full")


@query("""WITH l AS (SELECT o_custkey AS lid, count(*) AS n_orders FROM orders GROUP BY 1), r AS (SELECT user_id + 100 AS rid, count(*) AS n_events FROM events GROUP BY 1),
b AS (SELECT lid, lid AS rid FROM l WHERE lid % 2 = 0) SELECT l.lid, n_orders, r.rid, n_events FROM l LEFT JOIN b ON l.lid = b.lid FULL JOIN r ON b.rid = r.rid""")
def bridge_full_outer(t: Tables) -> DataFrame:
    left = t.orders.groupBy(F.col("o_custkey").alias("lid")).agg(F.count("*").alias("n_orders"))
    right = t.events.groupBy((F.col("user_id") + 100).alias("rid")).agg(F.count("*").alias("n_events"))
    bridge = left.where("lid % 2 = 0").select("lid", F.col("lid").alias("rid"))
    return bridge_outer(left, bridge, right, "lid", "rid")


_BAND = """FROM (SELECT l_orderkey, l_linenumber, o_custkey AS ck, l_shipdate::DATE AS ship FROM lineitem JOIN orders ON l_orderkey = o_orderkey) l JOIN orders o ON l.ck = o.o_custkey"""


def _ship(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders.select("o_orderkey", F.col("o_custkey").alias("ck")), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "ck", F.to_date("l_shipdate").alias("ship"))


@query(f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, o_orderkey, date_diff('day', o_orderdate::DATE, ship) AS days {_BAND} WHERE date_diff('day', o_orderdate::DATE, ship) BETWEEN -3 AND 3")
def band_join_days(t: Tables) -> DataFrame:
    """Equal customer and a date difference: the equi key makes it a hash or merge join with a residual."""
    days = F.datediff("ship", F.to_date("o_orderdate"))
    return _ship(t).join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), (F.col("ck") == F.col("o_custkey")) & days.between(-3, 3)).select("l_orderkey", "l_linenumber", "o_orderkey", days.cast("long").alias("days"))


@query(f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, o_orderkey {_BAND} WHERE date_diff('day', o_orderdate::DATE, ship) BETWEEN -1 AND 1 OR date_diff('day', o_orderdate::DATE, ship) BETWEEN 29 AND 31")
def or_band_join(t: Tables) -> DataFrame:
    days = F.datediff("ship", F.to_date("o_orderdate"))
    return _ship(t).join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), (F.col("ck") == F.col("o_custkey")) & (days.between(-1, 1) | days.between(29, 31))).select("l_orderkey", "l_linenumber", "o_orderkey")


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, 'l_partkey' AS role, p_name FROM lineitem JOIN part ON l_partkey = p_partkey
UNION ALL SELECT l_orderkey, l_linenumber::BIGINT, 'l_suppkey', p_name FROM lineitem JOIN part ON l_suppkey = p_partkey""")
def unpivot_link_join(t: Tables) -> DataFrame:
    """An id that may match either of two link columns, as one equi join over the unpivoted columns."""
    links = unpivot_links(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])
    return links.join(t.part, F.col("link_id") == F.col("p_partkey")).select("l_orderkey", F.col("l_linenumber").cast("long"), "role", "p_name")


@query("SELECT s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON contains(lower(n_name), lower(left(r_name, 2))) OR n_regionkey = r_regionkey AND s_acctbal > 5000")
def like_join(t: Tables) -> DataFrame:
    """A join without an equi key: only dimension tables, whose small side is broadcast."""
    d = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    on = F.contains(F.lower("n_name"), F.lower(F.left("r_name", F.lit(2)))) | ((F.col("n_regionkey") == F.col("r_regionkey")) & (F.col("s_acctbal") > 5000))
    return d.join(t.region, on).select("s_name", "n_name")


@query("SELECT c_custkey, c_name FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000 WHERE o_orderkey IS NULL")
def anti_left_null(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL)")
def anti_not_in(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_orderstatus = 'F' AND o_custkey IS NOT NULL"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END FROM orders WHERE o_orderstatus = 'F')")
def anti_not_in_null(t: Tables) -> DataFrame:
    """NOT IN over a list that may hold a null: nothing is then known to be outside of it. One flag is broadcast, not the list."""
    listed = t.orders.where("o_orderstatus = 'F'").select(F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("k"))
    return null_aware_anti(t.customer, listed, "c_custkey", "k").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def semi_in(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def exists_semi(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem.where("l_returnflag = 'R'"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderdate::DATE = b.o_orderdate::DATE AND a.o_orderkey < b.o_orderkey AND levenshtein(a.o_orderpriority, b.o_orderpriority) > 3")
def self_join_conflict(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"), "o_orderpriority")
    a, b = o.withColumnsRenamed({"o_orderkey": "a", "o_orderpriority": "pa"}), o.withColumnsRenamed({"o_orderkey": "b", "o_orderpriority": "pb"})
    return a.join(b, ["o_custkey", "d"]).where((F.col("a") < F.col("b")) & (F.levenshtein("pa", "pb") > 3)).select("a", "b")


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders JOIN (SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS m FROM lineitem WHERE l_quantity = 50) ON strftime(o_orderdate, '%Y-%m') = m GROUP BY 1")
def month_key_join(t: Tables) -> DataFrame:
    m = t.lineitem.where("l_quantity = 50").select(F.date_format("l_shipdate", "yyyy-MM").alias("month")).distinct()
    return t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).join(m, "month", "left_semi").groupBy("month").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey AS o_orderkey, o_custkey AS o_custkey, NULL::VARCHAR AS note FROM orders WHERE o_orderpriority LIKE '%HIGH%' AND o_orderstatus IN ('O', 'P') AND NOT o_orderpriority ILIKE '5%' AND (o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%')")
def filter_patterns(t: Tables) -> DataFrame:
    p = F.col("o_orderpriority")
    d = t.orders.where(p.like("%HIGH%") & F.col("o_orderstatus").isin("O", "P") & ~p.ilike("5%") & starts_with_any(p, ["1", "2"]))
    return add_missing(d.select("o_orderkey", "o_custkey"), {"note": L(None).cast("string")})


@query("SELECT count(*) AS n FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey AND nullif(a.o_orderstatus, 'P') IS NOT DISTINCT FROM nullif(b.o_orderstatus, 'F')")
def null_safe_eq(t: Tables) -> DataFrame:
    a = t.orders.select("o_orderkey", F.nullif("o_orderstatus", L("P")).alias("x"))
    b = t.orders.select("o_orderkey", F.nullif("o_orderstatus", L("F")).alias("y"))
    return a.join(b, "o_orderkey").where(F.col("x").eqNullSafe(F.col("y"))).agg(F.count("*").alias("n"))


@query("SELECT * EXCLUDE (c_acctbal) REPLACE (upper(c_mktsegment) AS c_mktsegment) FROM (SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer)")
def star_except_replace(t: Tables) -> DataFrame:
    return t.customer.withColumns({"c_mktsegment": F.upper("c_mktsegment"), "c_nationkey": F.col("c_nationkey").cast("long")}).drop("c_acctbal")


@query("""SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size BETWEEN 10 AND 30 THEN 'medium' ELSE 'large' END AS size_class,
CASE WHEN p_brand IN ('Brand#1', 'Brand#11', 'Brand#12') THEN 'A' WHEN p_brand IN ('Brand#2', 'Brand#21', 'Brand#22') THEN 'B' ELSE 'other' END AS brand_group FROM part""")
def case_and_synonyms(t: Tables) -> DataFrame:
    size = F.when(F.col("p_size") < 10, "small").when(F.col("p_size").between(10, 30), "medium").otherwise("large")
    groups = {"A": ["Brand#1", "Brand#11", "Brand#12"], "B": ["Brand#2", "Brand#21", "Brand#22"]}
    return t.part.select("p_partkey", size.alias("size_class"), mapped(F.col("p_brand"), groups, "other").alias("brand_group"))


@query("SELECT n.n_nationkey::BIGINT AS n_n_nationkey, n.n_name AS n_n_name, r.r_name AS r_r_name FROM nation n JOIN region r ON n_regionkey = r_regionkey")
def config_projection(t: Tables) -> DataFrame:
    n, r = t.nation.withColumn("n_nationkey", F.col("n_nationkey").cast("long")), t.region
    d = n.alias("n").join(r.alias("r"), F.col("n.n_regionkey") == F.col("r.r_regionkey"))
    return d.select(*prefixed(n, "n", ["n_nationkey", "n_name", "n_missing"]), *prefixed(r, "r", ["r_name"]))


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error' OR value > 20")
def blank_row_rules(t: Tables) -> DataFrame:
    """Rows of which more than half of the checked columns are null are dropped; here one of one."""
    marked = t.events.select("event_id", "user_id", "event_type", F.when(~((F.col("event_type") == "error") & (F.col("value") <= 20)), 1).alias("v"))
    return marked.join(drop_sparse_rows(marked.select("v", F.col("event_id").alias("id")), 0.4).select(F.col("id").alias("event_id")), "event_id", "left_semi").select("event_id", "user_id", "event_type")


@query("""SELECT 'order' AS kind, o_custkey AS k, o_orderdate::DATE AS d, o_totalprice AS amount FROM orders UNION ALL SELECT 'event', user_id, ts::DATE, NULL FROM events
UNION ALL SELECT 'ship', o_custkey, l_shipdate::DATE, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity > 48""")
def union_all_timeline(t: Tables) -> DataFrame:
    o = t.orders.select(L("order").alias("kind"), F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").alias("amount"))
    e = t.events.select(L("event").alias("kind"), F.col("user_id").alias("k"), F.to_date("ts").alias("d"))
    s = t.lineitem.where("l_quantity > 48").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(L("ship").alias("kind"), F.col("o_custkey").alias("k"), F.to_date("l_shipdate").alias("d"), F.col("l_extendedprice").alias("amount"))
    return union_all([o, e, s])


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month FROM orders UNION SELECT strftime(l_shipdate, '%Y-%m') FROM lineitem")
def union_spine(t: Tables) -> DataFrame:
    return t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).union(t.lineitem.select(F.date_format("l_shipdate", "yyyy-MM"))).distinct()


@query("SELECT 'customer' AS source, c_custkey::VARCHAR AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_suppkey::VARCHAR, s_name, NULL FROM supplier")
def union_missing_cols(t: Tables) -> DataFrame:
    text = lambda d: d.select(*[F.col(c).cast("string").alias(c) for c in d.columns])
    return union_mapped({"customer": (text(t.customer), {"id": "C_CUSTKEY", "name": "c_name", "segment": "c_mktsegment"}), "supplier": (text(t.supplier), {"id": "s_suppkey", "name": "s_name", "segment": "s_segment"})})


@query("SELECT o_custkey AS k FROM orders INTERSECT SELECT user_id FROM events")
def set_intersect(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("k")).intersect(t.events.select(F.col("user_id").alias("k")))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def set_except(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("k")).exceptAll(t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")).distinct())


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def topk(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20 OFFSET 40")
def paged(t: Tables) -> DataFrame:
    return t.orders.orderBy("o_orderdate", "o_orderkey").offset(40).limit(20).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 THEN -1 WHEN o_custkey % 5 = 0 THEN c_nationkey::BIGINT ELSE 0 END AS tag FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def update_from_source(t: Tables) -> DataFrame:
    """UPDATE ... FROM where the target is still unset."""
    target = t.orders.select("o_orderkey", "o_custkey", F.when(F.col("o_custkey") % 7 == 0, L(-1)).otherwise(L(0)).cast("long").alias("tag"))
    source = t.customer.where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("long").alias("tag"))
    return update_from(target, source, ["o_custkey"], ["tag"], F.col("tag") == 0).select("o_orderkey", "tag")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders UNION ALL SELECT o_orderkey + 100000000, 'new' FROM orders WHERE o_orderkey % 30 = 0")
def upsert_by_key(t: Tables) -> DataFrame:
    old = t.orders.select("o_orderkey", "o_orderstatus")
    new = t.orders.where("o_orderkey % 3 = 0").select("o_orderkey", L("new").alias("o_orderstatus"))
    more = t.orders.where("o_orderkey % 30 = 0").select((F.col("o_orderkey") + 100000000).alias("o_orderkey"), L("new").alias("o_orderstatus"))
    return upsert(old, new.unionByName(more), ["o_orderkey"])


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))""")
def cascading_delete(t: Tables) -> DataFrame:
    """Children of rejected parents go, level by level."""
    customers = t.customer.where("c_acctbal > 0")
    orders = delete_orphans(t.orders.withColumnRenamed("o_custkey", "c_custkey"), customers, ["c_custkey"])
    return delete_orphans(t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), orders, ["o_orderkey"]).select(F.col("o_orderkey").alias("l_orderkey"), F.col("l_linenumber").cast("long"))
