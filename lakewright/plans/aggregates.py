"""Aggregates and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.dedup import duplicate_audit, keep_first, keep_latest, keep_latest_ties, line_numbers, numbered
from ..operators.kpi import group_mode, impute_mode
from ..operators.timeline import first_event_cohort, prior_count
from .registry import Tables, query

r2 = lambda c: F.round(c, 2)


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty, round(avg(l_discount), 6) AS avg_disc, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY 1, 2""")
def agg_basic(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), r2(F.sum("l_quantity")).alias("sum_qty"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.min("l_extendedprice").alias("lo"),
        F.max("l_extendedprice").alias("hi"), r2(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("revenue"),
    )


@query("""SELECT o_custkey, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_f, round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END), 2) AS open_value,
min(CASE WHEN o_orderstatus = 'P' THEN o_orderdate::DATE END) AS first_p FROM orders GROUP BY 1""")
def agg_conditional(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    return t.orders.groupBy("o_custkey").agg(F.count_if(s == "F").alias("n_f"), r2(F.sum(F.when(s == "O", F.col("o_totalprice")).otherwise(0))).alias("open_value"), F.min(F.when(s == "P", F.to_date("o_orderdate"))).alias("first_p"))


@query("""SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_customers, count(DISTINCT o_orderpriority) AS n_priorities,
count(DISTINCT CASE WHEN o_totalprice > 100000 THEN coalesce(nullif(o_orderkey % 10, 0)::VARCHAR, o_custkey::VARCHAR || '|' || o_orderpriority) END) AS n_surrogate FROM orders GROUP BY 1""")
def agg_distinct_surrogate(t: Tables) -> DataFrame:
    k = F.coalesce(F.nullif(F.col("o_orderkey") % 10, F.lit(0)).cast("string"), F.concat_ws("|", F.col("o_custkey").cast("string"), "o_orderpriority"))
    return t.orders.groupBy("o_orderstatus").agg(F.count_distinct("o_custkey").alias("n_customers"), F.count_distinct("o_orderpriority").alias("n_priorities"), F.count_distinct(F.when(F.col("o_totalprice") > 100000, k)).alias("n_surrogate"))


@query("SELECT year(o_orderdate)::BIGINT AS y, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 5 AND avg(o_totalprice) > 1000")
def agg_having(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.year("o_orderdate").cast("long").alias("y"), "o_orderpriority").agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("a")).where("n > 5 AND a > 1000").drop("a")


@query("SELECT o_custkey, o_orderpriority AS mode FROM (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn FROM orders GROUP BY 1, 2) WHERE rn = 1")
def agg_mode(t: Tables) -> DataFrame:
    return group_mode(t.orders, ["o_custkey"], "o_orderpriority")


@query("SELECT round(avg(n), 4) AS mean_size, median(n)::DOUBLE AS median_size, min(n) AS min_size, max(n) AS max_size FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)")
def agg_median_sizes(t: Tables) -> DataFrame:
    sizes = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return sizes.agg(F.round(F.avg("n"), 4).alias("mean_size"), F.median("n").alias("median_size"), F.min("n").alias("min_size"), F.max("n").alias("max_size"))


@query("""SELECT k, sum(n)::BIGINT AS n, round(sum(v), 2) AS v FROM (SELECT o_custkey AS k, count(*) AS n, sum(o_totalprice) AS v FROM orders GROUP BY 1
UNION ALL SELECT user_id, count(*), sum(value) FROM events GROUP BY 1) GROUP BY 1""")
def agg_two_level(t: Tables) -> DataFrame:
    a = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("v"))
    b = t.events.groupBy(F.col("user_id").alias("k")).agg(F.count("*").alias("n"), F.sum("value").alias("v"))
    return a.unionByName(b).groupBy("k").agg(F.sum("n").alias("n"), r2(F.sum("v")).alias("v"))


@query("""SELECT event_type, round(stddev_samp(value), 4) AS std, count(DISTINCT value) AS n_values, round(100.0 * count(*) / nullif((SELECT count(*) FROM events), 0), 4) AS pct FROM events GROUP BY 1""")
def agg_std_repetition(t: Tables) -> DataFrame:
    total = t.events.agg(F.count("*").alias("total"))
    g = t.events.groupBy("event_type").agg(F.round(F.stddev_samp("value"), 4).alias("std"), F.count_distinct("value").alias("n_values"), F.count("*").alias("n"))
    return g.join(F.broadcast(total), F.lit(True)).select("event_type", "std", "n_values", F.round(100 * F.try_divide("n", "total"), 4).alias("pct"))


@query("SELECT user_id, arg_min(event_type, struct_pack(ts := ts, event_id := event_id)) AS first_type FROM events GROUP BY 1")
def agg_first(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"))


@query("SELECT count(*) AS n_rows, count(DISTINCT (o_custkey, o_orderpriority)) AS n_keys, count(*) - count(DISTINCT (o_custkey, o_orderpriority)) AS n_duplicates FROM orders")
def duplicate_key_audit(t: Tables) -> DataFrame:
    return duplicate_audit(t.orders, ["o_custkey", "o_orderpriority"])


@query("""WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1) SELECT event_type, n, round(n / sum(n) OVER (), 6) AS share,
round(sum(n) OVER (ORDER BY n DESC, event_type ROWS UNBOUNDED PRECEDING) / sum(n) OVER (), 6) AS cumulative_share FROM c""")
def cumulative_share(t: Tables) -> DataFrame:
    from ..quality.reconcile import running_share

    return running_share(t.events, "event_type").select("event_type", "n", F.round("share", 6).alias("share"), F.round("cumulative_share", 6).alias("cumulative_share"))


@query("""SELECT coalesce(o_orderstatus, 'TOTAL') AS status, coalesce(year(o_orderdate)::VARCHAR, 'TOTAL') AS y, count(*) AS n FROM orders GROUP BY GROUPING SETS ((), (o_orderstatus), (year(o_orderdate)))""")
def total_and_by_group(t: Tables) -> DataFrame:
    """TOTAL, per status and per year in one pass."""
    d = t.orders.select("o_orderstatus", F.year("o_orderdate").cast("string").alias("yr"))
    g = d.groupingSets([[], ["o_orderstatus"], ["yr"]], "o_orderstatus", "yr").agg(F.count("*").alias("n"))
    return g.select(F.coalesce("o_orderstatus", F.lit("TOTAL")).alias("status"), F.coalesce("yr", F.lit("TOTAL")).alias("y"), "n")


@query("SELECT o_custkey, o_orderkey, o_orderdate::DATE AS d FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def keep_latest_order(t: Tables) -> DataFrame:
    return keep_latest(t.orders, ["o_custkey"], "o_orderdate", [F.col("o_orderkey").asc()]).select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("d"))


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, nullif(o_orderpriority, '5-LOW') DESC NULLS LAST, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def priority_dedup(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    order = [F.when(s == "F", 0).when(s == "O", 1).otherwise(2).asc(), F.nullif("o_orderpriority", F.lit("5-LOW")).desc_nulls_last(), F.col("o_orderkey").asc()]
    return keep_first(t.orders, ["o_custkey"], order).select("o_custkey", "o_orderkey")


@query("SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY nullif(l_returnflag, 'N') NULLS LAST, l_linenumber, l_partkey) AS seq FROM lineitem")
def domain_sequence(t: Tables) -> DataFrame:
    d = numbered(t.lineitem, ["l_orderkey"], [F.nullif("l_returnflag", F.lit("N")).asc_nulls_last(), F.col("l_linenumber").asc(), F.col("l_partkey").asc()], "seq")
    return d.select("l_orderkey", F.col("l_linenumber").cast("long"), "seq")


@query("SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running FROM orders")
def running_sum(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    return t.orders.select("o_orderkey", r2(F.sum("o_totalprice").over(w)).alias("running"))


_PRIOR = "SELECT o.o_orderkey, (SELECT count(*) FROM orders b WHERE b.o_custkey = o.o_custkey AND b.o_orderdate::DATE < o.o_orderdate::DATE AND b.o_orderstatus = 'F') AS n_prior FROM orders o"


@query(_PRIOR)
def prior_count_window(t: Tables) -> DataFrame:
    """Earlier events as one range window."""
    return prior_count(t.orders, "o_custkey", "o_orderdate", F.col("o_orderstatus") == "F", "n_prior").select("o_orderkey", "n_prior")


@query(_PRIOR)
def ineq_prior_count(t: Tables) -> DataFrame:
    """The same as an equi join with an inequality, then an aggregate."""
    a = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"))
    b = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("bd"))
    return a.join(b, (F.col("o_custkey") == F.col("k")) & (F.col("bd") < F.col("d")), "left").groupBy("o_orderkey").agg(F.count("k").alias("n_prior"))


@query("SELECT o_orderkey FROM (SELECT *, sum(o_totalprice) OVER (PARTITION BY o_custkey) AS total FROM orders) WHERE o_totalprice > 0.3 * total")
def partition_total_filter(t: Tables) -> DataFrame:
    return t.orders.withColumn("total", F.sum("o_totalprice").over(Window.partitionBy("o_custkey"))).where("o_totalprice > 0.3 * total").select("o_orderkey")


@query("SELECT event_id FROM (SELECT *, min(ts) OVER (PARTITION BY user_id) AS f FROM events) WHERE f >= TIMESTAMP '2024-01-01 12:00:00'")
def first_event_cohort_rows(t: Tables) -> DataFrame:
    return first_event_cohort(t.events, "user_id", "ts", F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")).select("event_id")


@query("""SELECT l_orderkey, l_partkey FROM (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_linenumber) AS a,
row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS b FROM lineitem) WHERE a = 1 AND b = 1""")
def mutual_first(t: Tables) -> DataFrame:
    p = F.desc("l_extendedprice")
    a, b = Window.partitionBy("l_orderkey").orderBy(p, "l_partkey", "l_linenumber"), Window.partitionBy("l_partkey").orderBy(p, "l_orderkey", "l_linenumber")
    return t.lineitem.withColumns({"a": F.row_number().over(a), "b": F.row_number().over(b)}).where("a = 1 AND b = 1").select("l_orderkey", "l_partkey")


@query("SELECT o_orderkey FROM orders JOIN (SELECT o_custkey AS k, max(o_orderdate::DATE) AS d FROM orders GROUP BY 1) ON o_custkey = k AND o_orderdate::DATE = d")
def group_max_join(t: Tables) -> DataFrame:
    """Latest rows per key with ties, by rank instead of a self join."""
    return keep_latest_ties(t.orders.withColumn("d", F.to_date("o_orderdate")), ["o_custkey"], "d").select("o_orderkey")


@query("""WITH p AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS p FROM orders), m AS (SELECT o_custkey, p AS m FROM (SELECT o_custkey, p,
row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, p) AS rn FROM p WHERE p IS NOT NULL GROUP BY 1, 2) WHERE rn = 1) SELECT o_orderkey, coalesce(p, m) AS p FROM p LEFT JOIN m USING (o_custkey)""")
def mode_impute(t: Tables) -> DataFrame:
    d = t.orders.select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("p"))
    return impute_mode(d, ["o_custkey"], "p").select("o_orderkey", "p")


@query("SELECT md5(event_id::VARCHAR) AS k, row_number() OVER (ORDER BY ts, event_id) AS line FROM events")
def global_row_number(t: Tables) -> DataFrame:
    """A global line number over all rows, without a single task."""
    numbered = line_numbers(t.events.select("event_id", "ts"), ["ts", "event_id"], "line")
    return numbered.select(F.md5(F.col("event_id").cast("string")).alias("k"), "line")
