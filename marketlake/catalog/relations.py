"""Repeated keys, joins, sorts, top-k and set operations."""

from pyspark.sql import functions as F

from marketlake.catalog.aggregates import _EMPTY, _NULLS, NODES, PROFILED, area_nodes, n_rows
from marketlake.catalog.base import VAC, events, query, table, vacancies
from marketlake.operators.dedup import (
    keep_any,
    keep_latest,
    publication_counts,
    repeated_rows,
    with_publication_count,
)
from marketlake.operators.joins import keep_members
from marketlake.operators.profile import list_column_report, null_and_empty_report
from marketlake.operators.series import daily_counts, date_spine
from marketlake.operators.topk import top_groups
from marketlake.operators.tree import flatten_children, walk_tree


@query("w1_latest_per_key", """select * from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def w1(spark, sf):
    return keep_latest(events(spark, sf), ["user_id"],
                       [F.col("ts").desc(), F.col("event_id").desc()])


@query("w1_latest_order", """select * from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""")
def w1_orders(spark, sf):
    return keep_latest(table(spark, sf, "orders"), ["o_custkey"],
                       [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query("w2_any_per_key", "select distinct user_id from events")
def w2(spark, sf):
    return keep_any(events(spark, sf), ["user_id"]).select("user_id")


@query("w3_compound_key", "select distinct l_orderkey, l_linenumber from lineitem")
def w3(spark, sf):
    return keep_any(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber")


@query("w4_repeated_rows", """select * from lineitem
qualify count(*) over (partition by l_orderkey, l_linenumber) > 1""")
def w4(spark, sf):
    items = table(spark, sf, "lineitem")
    return repeated_rows(items, ["l_orderkey", "l_linenumber"]).orderBy(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")


@query("w5_publication_counts", """select user_id, count(*) as publication_cnt,
  count(distinct cast(ts as date)) as day_cnt, min(ts)::date as first_day, max(ts)::date as last_day
from events group by 1""")
def w5(spark, sf):
    return publication_counts(events(spark, sf), "user_id", F.to_date("ts"))


@query("w5_publication_column", """select event_id, user_id,
  count(*) over (partition by user_id) as publication_cnt from events""")
def w5_column(spark, sf):
    return with_publication_count(events(spark, sf), "user_id").select(
        "event_id", "user_id", "publication_cnt")


@query("j1_report_join", f"""with {VAC}, n as ({_NULLS}), e as ({_EMPTY})
select n."column", (select count(*) from vac) as total_cnt, cast(null_cnt as bigint) as null_cnt,
  round(null_cnt / (select count(*) from vac) * 100, 1) as null_pcnt,
  cast(empty_list_cnt as bigint) as empty_list_cnt,
  round(empty_list_cnt / (select count(*) from vac) * 100, 1) as empty_pcnt
from n left join e on n."column" = e."column" """)
def j1(spark, sf):
    return null_and_empty_report(vacancies(spark, sf).select(*PROFILED))


@query("j3_rows_of_keys", """select * from events where user_id in
  (select user_id from events group by 1 having count(*) > 70)""")
def j3(spark, sf):
    ev = events(spark, sf)
    busy = ev.groupBy("user_id").agg(n_rows()).filter("cnt > 70")
    return keep_members(ev, busy, "user_id")


@query("j4_spine_join", """select cast(d as date) as day, row_number() over (order by d) - 1 as idx,
  coalesce(n, 0) as found
from (select unnest(generate_series(max(o_orderdate)::date - 364, max(o_orderdate)::date, interval 1 day)) as d
      from orders)
left join (select cast(o_orderdate as date) as day, count(*) as n from orders group by 1) o
  on o.day = cast(d as date)""")
def j4(spark, sf):
    orders = table(spark, sf, "orders")
    day = F.col("o_orderdate")
    return daily_counts(orders, day, date_spine(orders, day, 365))


@query("j5_tree_flatten", """select 'r' || r_regionkey as parent_id, r_name as parent_name,
  'n' || n_nationkey as id, n_name as name from region join nation on n_regionkey = r_regionkey""")
def j5(spark, sf):
    nations = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.collect_list(F.struct(
        F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("name"))
    ).alias("areas"))
    nested = table(spark, sf, "region").join(
        nations, F.col("r_regionkey") == F.col("n_regionkey")).select(
        F.concat(F.lit("r"), "r_regionkey").alias("id"), F.col("r_name").alias("name"), "areas")
    return flatten_children(nested, "areas")


@query("j6_tree_walk", f"""with recursive {NODES}, t as (
  select id, parent_id, name, cast(0 as bigint) as level, name as path from nodes where parent_id is null
  union all select n.id, n.parent_id, n.name, t.level + 1, t.path || ' / ' || n.name
  from nodes n join t on n.parent_id = t.id)
select * from t""")
def j6(spark, sf):
    return walk_tree(area_nodes(spark, sf))


@query("o1_sort", "select event_id, user_id, value from events order by value desc, event_id")
def o1(spark, sf):
    return events(spark, sf).select("event_id", "user_id", "value").orderBy(
        F.col("value").desc(), "event_id")


@query("o2_top_groups", """select user_id, count(*) as cnt from events group by 1
order by cnt desc, user_id limit 10""")
def o2(spark, sf):
    return top_groups(events(spark, sf), ["user_id"], 10)


@query("o3_list_column_report", f"""with {VAC}
select case when work_format_ids is null then null else '[' || array_to_string(list_transform(work_format_ids,
    lambda w: '{{"id":"' || w || '","name":"' || case w when 'ON_SITE' then 'on site' else lower(w) end || '"}}'), ',') || ']' end as value,
  cast(len(work_format_ids) as bigint) as len, count(*) as cnt
from vac group by work_format_ids order by cnt desc, value nulls first limit 10""")
def o3(spark, sf):
    return list_column_report(vacancies(spark, sf), "work_format", 10)


@query("u1_union_by_name", """select c_custkey as id, c_name as name, c_mktsegment as segment, null::double as balance from customer
union all by name select s_suppkey as id, s_name as name, s_acctbal as balance from supplier""")
def u1(spark, sf):
    cust = table(spark, sf, "customer").selectExpr("c_custkey id", "c_name name", "c_mktsegment segment")
    supp = table(spark, sf, "supplier").selectExpr("s_suppkey id", "s_name name", "s_acctbal balance")
    return cust.unionByName(supp, allowMissingColumns=True)


@query("u2_strict_union", """select * from events where event_type in ('click', 'view')
union all select * from events where value > 50""")
def u2(spark, sf):
    ev = events(spark, sf)
    return ev.filter("event_type in ('click', 'view')").union(ev.filter("value > 50"))


@query("u3_union_keep_repeats", """select user_id, count(*) as cnt from (
  select user_id from events where event_type in ('click', 'view')
  union all select user_id from events where event_type in ('view', 'error')) group by 1""")
def u3(spark, sf):
    ev = events(spark, sf).select("user_id", "event_type")
    both = ev.filter("event_type in ('click', 'view')").unionAll(
        ev.filter("event_type in ('view', 'error')"))
    return both.groupBy("user_id").agg(n_rows())
