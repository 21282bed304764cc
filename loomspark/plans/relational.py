"""The kinds of operators that users of the corpus tables say in SQL, over the star schema."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomspark.plans.registry import query


@query("""select l_returnflag, l_linestatus, count(*) as n, sum(cast(l_quantity as bigint)) as sum_qty, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship from lineitem group by all""", raw=True)
def r_hash_aggregate(t):
    return t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("sum_qty"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))


@query("""select n_name, count(*) as n from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where l_shipdate > o_orderdate group by n_name""", raw=True)
def r_joins(t):
    """An equi-join chain; which side is sent around is decided from sizes at run time."""
    line, orders = t("lineitem").select("l_orderkey", "l_shipdate"), t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).where("l_shipdate > o_orderdate")
    joined = joined.join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))


@query("""select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey)""", raw=True)
def r_semi_join(t):
    return t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("""select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)""", raw=True)
def r_anti_join(t):
    return t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("""select coalesce(s.s_nationkey, c.c_nationkey) as nation, coalesce(ns, 0) as suppliers, coalesce(nc, 0) as customers from (select s_nationkey, count(*) as ns from supplier group by 1) s
full join (select c_nationkey, count(*) as nc from customer group by 1) c on s_nationkey = c_nationkey""", raw=True)
def r_full_outer(t):
    s, c = t("supplier").groupBy("s_nationkey").agg(F.count("*").alias("ns")), t("customer").groupBy("c_nationkey").agg(F.count("*").alias("nc"))
    both = s.join(c, F.col("s_nationkey") == F.col("c_nationkey"), "full_outer")
    return both.select(F.coalesce("s_nationkey", "c_nationkey").alias("nation"), F.coalesce("ns", F.lit(0)).alias("suppliers"), F.coalesce("nc", F.lit(0)).alias("customers"))


@query("""select l_returnflag, l_linestatus, count(*) as n from lineitem group by rollup (l_returnflag, l_linestatus)""", raw=True)
def r_rollup(t):
    return t("lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("""select l_returnflag, l_linestatus, count(*) as n from lineitem group by cube (l_returnflag, l_linestatus)""", raw=True)
def r_cube(t):
    return t("lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("""select l_returnflag, count(distinct l_suppkey) as suppliers, count(distinct l_partkey) as parts from lineitem group by 1""", raw=True)
def r_distinct_aggregate(t):
    return t("lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("l_partkey").alias("parts"))


@query("""select user_id, event_id, rank() over w as r, lag(event_id) over w as before, count(*) over (partition by user_id order by ts, event_id rows between 2 preceding and current row) as near from events window w as (partition by user_id order by ts, event_id)""", raw=True)
def r_windows(t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t("events").select("user_id", "event_id", F.rank().over(w).cast("long").alias("r"), F.lag("event_id").over(w).alias("before"), F.count("*").over(w.rowsBetween(-2, 0)).alias("near"))


@query("""select s_nationkey as k from supplier union select c_nationkey from customer""", raw=True)
def r_union(t):
    return t("supplier").select(F.col("s_nationkey").alias("k")).union(t("customer").select("c_nationkey")).distinct()


@query("""select c_custkey as k from customer except select o_custkey from orders""", raw=True)
def r_except(t):
    return t("customer").select(F.col("c_custkey").alias("k")).subtract(t("orders").select("o_custkey"))


@query("""select c_custkey as k from customer intersect select o_custkey from orders""", raw=True)
def r_intersect(t):
    return t("customer").select(F.col("c_custkey").alias("k")).intersect(t("orders").select("o_custkey"))


@query("""select l_orderkey, l_linenumber from lineitem order by l_shipdate desc, l_orderkey, l_linenumber limit 100""", raw=True)
def r_top_n(t):
    return t("lineitem").orderBy(F.col("l_shipdate").desc(), "l_orderkey", "l_linenumber").limit(100).select("l_orderkey", "l_linenumber")


@query("""select a.event_id, (select max(b.event_id) from events b where b.user_id = a.user_id and b.event_id % 5 = 0 and b.event_id <= a.event_id) as last_fifth from events a""", raw=True)
def r_as_of_join(t):
    """The last fifth event of the same user at or before each event: one window over the union, no range join."""
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(F.col("event_id") % 5 == 0, F.col("event_id"))
    return t("events").select("event_id", F.last(mark, ignorenulls=True).over(w).alias("last_fifth"))


@query("""select time_bucket(interval '1 hour', ts) as start, count(*) as n, count(distinct user_id) as users from events group by 1""", raw=True)
def r_tumbling(t):
    w = t("events").groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))
    return w.select(F.col("w.start").alias("start"), "n", "users")


@query("""select b - o * interval '30 minutes' as start, count(*) as n from (select time_bucket(interval '30 minutes', ts) as b from events), (values (0), (1)) v(o) group by 1""", raw=True)
def r_sliding(t):
    w = t("events").groupBy(F.window("ts", "1 hour", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    return w.select(F.col("w.start").alias("start"), "n")


@query("""select user_id, min(ts) as start, count(*) as n from (select *, sum(fresh) over (partition by user_id order by ts, event_id) as s from (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) < interval '30 minutes' then 0 else 1 end as fresh from events)) group by user_id, s""", raw=True)
def r_sessions(t):
    s = t("events").groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n"), F.min("ts").alias("start"))
    return s.select("user_id", "start", "n")


@query("""select l_returnflag, count(*) filter (l_linestatus = 'O') as o, count(*) filter (l_linestatus = 'F') as f from lineitem group by 1""", raw=True)
def r_pivot(t):
    wide = t("lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["O", "F"]).agg(F.count(F.lit(1)))
    return wide.select("l_returnflag", F.coalesce("O", F.lit(0)).alias("o"), F.coalesce("F", F.lit(0)).alias("f"))
