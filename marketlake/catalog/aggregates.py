"""Aggregations, profiles and facets."""

from pyspark.sql import functions as F

from marketlake.catalog.base import VAC, events, query, table, vacancies
from marketlake.functions.lists import first_item, list_len
from marketlake.operators.dedup import distinct_rows_of_top_key, duplicate_share
from marketlake.operators.facets import facet_counts
from marketlake.operators.profile import (
    column_summary,
    empty_list_report,
    fill_report,
    list_length_stats,
    null_counts,
    null_report,
)
from marketlake.operators.quantiles import exact_quantiles
from marketlake.operators.series import daily_counts, date_spine, describe_counts
from marketlake.operators.sketches import daily_sketches, distinct_in_ranges
from marketlake.operators.tree import child_counts

# Every column of the derived records and when it is NULL.
PROFILED = {
    "id": "false", "name": "false", "schedule": "schedule_id is null", "internship": "false",
    "accept_temporary": "accept_temporary is null", "published_at": "false", "created_at": "false",
    "url": "false", "salary": "salary_from is null", "employer": "false", "area": "false",
    "employment_form": "employment_form_id is null", "work_format": "work_format_ids is null",
    "professional_roles": "false", "relations": "false", "snippet": "false",
    "extra": "event_id % 3 <> 0", "brand_snippet": "day(ts) < 15",
}


def n_rows(name="cnt"):
    return F.count(F.lit(1)).alias(name)


@query("a1_counts", f"""with {VAC}
select count(*) as rows_cnt, count(salary_from) as salary_cnt, count(schedule_id) as schedule_cnt
from vac""")
def a1(spark, sf):
    return vacancies(spark, sf).agg(
        n_rows("rows_cnt"), F.count("salary").alias("salary_cnt"),
        F.count("schedule").alias("schedule_cnt"))


@query("a2_distinct_count", "select count(*) as rows_cnt, count(distinct user_id) as unique_id_cnt from events")
def a2(spark, sf):
    return events(spark, sf).agg(n_rows("rows_cnt"), F.count_distinct("user_id").alias("unique_id_cnt"))


@query("a2_distinct_by_week", """with d as (select *, cast(ts as date) as day from events),
w as (select unnest(generate_series(min(day), max(day), interval 7 day))::date as first_day from d)
select first_day, (first_day + 6)::date as last_day, count(distinct value) as exact_cnt, true as within_5_percent
from w left join d on day between first_day and first_day + 6 group by first_day""")
def a2_weeks(spark, sf):
    """Distinct values of every week from daily sketches, beside the exact count."""
    days = events(spark, sf).withColumn("day", F.to_date("ts"))
    span = days.agg(F.min("day").alias("low"), F.max("day").alias("high")).filter("low is not null")
    ranges = span.select(F.explode(F.expr("sequence(low, high, interval 7 days)")).alias("first_day")).withColumn(
        "last_day", F.date_add("first_day", 6))
    marked = days.withColumn("mark", F.col("value").cast("string"))  # sketches take text, not doubles
    found = distinct_in_ranges(daily_sketches(marked, F.col("day"), "mark"), ranges)
    inside = ranges.withColumn("day", F.explode(F.sequence("first_day", "last_day")))
    exact = inside.join(days, "day", "left").groupBy("first_day").agg(F.count_distinct("value").alias("exact_cnt"))
    near = F.abs(F.col("estimate") - F.col("exact_cnt")) <= 0.05 * F.col("exact_cnt")
    return found.join(exact, "first_day").select("first_day", "last_day", "exact_cnt", near.alias("within_5_percent"))


@query("a3_duplicate_share", """select l_shipdate, count(l_orderkey) as total_id_cnt,
  count(distinct l_orderkey) as unique_id_cnt,
  round((count(l_orderkey) - count(distinct l_orderkey)) / count(l_orderkey) * 100, 2)
    as share_of_duplicates_pcnt
from lineitem group by 1""")
def a3(spark, sf):
    return duplicate_share(table(spark, sf, "lineitem"), "l_orderkey", ["l_shipdate"])


@query("a4_distinct_rows_of_top_key", """with top as (select l_orderkey, l_linenumber from lineitem
  group by all order by count(*) desc, l_orderkey, l_linenumber limit 1)
select l_orderkey, l_linenumber, count(*) as row_cnt, count(distinct l) as distinct_row_cnt
from lineitem l join top using (l_orderkey, l_linenumber) group by all""")
def a4(spark, sf):
    return distinct_rows_of_top_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("a5_distinct_lists", f"""with {VAC}
select count(role_ids) as rows_cnt, count(distinct role_ids) as unique_cnt,
  count(distinct role_ids[1]) as unique_ids_cnt from vac""")
def a5(spark, sf):
    roles = F.col("professional_roles")
    return vacancies(spark, sf).agg(
        F.count(roles).alias("rows_cnt"), F.count_distinct(roles).alias("unique_cnt"),
        F.count_distinct(first_item(roles)["id"]).alias("unique_ids_cnt"))


_NULLS = " union all ".join(
    f"select '{c}' as \"column\", count_if({w}) as null_cnt from vac" for c, w in PROFILED.items())


@query("a6_null_counts", f"""with {VAC}
select {", ".join(f"count_if({w})::bigint as {c}" for c, w in PROFILED.items())} from vac""")
def a6(spark, sf):
    return null_counts(vacancies(spark, sf).select(*PROFILED))


@query("a7_null_percent", f"""with {VAC}, n as ({_NULLS})
select "column", (select count(*) from vac) as total_cnt, cast(null_cnt as bigint) as null_cnt,
  round(null_cnt / (select count(*) from vac) * 100, 1) as null_pcnt from n""")
def a7(spark, sf):
    return null_report(vacancies(spark, sf).select(*PROFILED))


_EMPTY = """select 'work_format' as "column", count_if(len(work_format_ids) = 0) as empty_list_cnt from vac
  union all select 'professional_roles', count_if(len(role_ids) = 0) from vac
  union all select 'relations', count(*) from vac"""


@query("a8_empty_lists", f"""with {VAC}, n as ({_EMPTY})
select "column", (select count(*) from vac) as total_cnt,
  cast(empty_list_cnt as bigint) as empty_list_cnt,
  round(empty_list_cnt / (select count(*) from vac) * 100, 1) as empty_pcnt from n""")
def a8(spark, sf):
    return empty_list_report(vacancies(spark, sf).select(*PROFILED))


@query("a9_filtered_count", f"""with {VAC}
select count(*) filter (where requirement is null) as null_cnt,
  count(*) filter (where len(work_format_ids) = 0) as empty_cnt from vac""")
def a9(spark, sf):
    return vacancies(spark, sf).agg(
        F.count_if(F.col("snippet.requirement").isNull()).alias("null_cnt"),
        F.count_if(F.size("work_format") == 0).alias("empty_cnt"))


@query("a10_date_range", "select min(ts) as min_date, max(ts) as max_date from events")
def a10(spark, sf):
    return events(spark, sf).agg(F.min("ts").alias("min_date"), F.max("ts").alias("max_date"))


_NEAR = """(select {c} from (select {c}, row_number() over (order by {c}) as rn from {t}
  where {c} is not null) where rn = (select round({q} * (count({c}) - 1)) + 1 from {t}))"""


def _near(column, q, relation):
    return _NEAR.format(c=column, q=q, t=relation)


@query("a11_list_length_stats", f"""with {VAC}, l as (select cast(len(work_format_ids) as bigint) as len from vac)
select min(len) as min_len, max(len) as max_len, round(avg(len), 6) as avg_len,
  quantile_cont(len, 0.5) as median_len, {_near('len', 0.25, 'l')} as p25_len,
  {_near('len', 0.75, 'l')} as p75_len, {_near('len', 0.95, 'l')} as p95_len from l""")
def a11(spark, sf):
    return list_length_stats(vacancies(spark, sf), "work_format")


@query("a11_max_length", f"with {VAC} select max(len(role_ids)) as max_roles_cnt from vac")
def a11_max(spark, sf):
    return vacancies(spark, sf).agg(F.max(list_len(F.col("professional_roles"))).alias("max_roles_cnt"))


@query("a11_exact_quantiles", """select 'l_extendedprice' as "column", p as prob,
  round(case p when 0.05 then quantile_cont(l_extendedprice, 0.05) when 0.5 then quantile_cont(l_extendedprice, 0.5)
  else quantile_cont(l_extendedprice, 0.95) end, 6) as value
from lineitem, (select unnest([0.05, 0.5, 0.95]::double[]) as p) group by p
union all select 'l_quantity', p,
  round(case p when 0.05 then quantile_cont(l_quantity, 0.05) when 0.5 then quantile_cont(l_quantity, 0.5) else quantile_cont(l_quantity, 0.95) end, 6)
from lineitem, (select unnest([0.05, 0.5, 0.95]::double[]) as p) group by p""")
def a11_quantiles(spark, sf):
    return exact_quantiles(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"],
                           [0.05, 0.5, 0.95]).withColumn("value", F.round("value", 6)).drop("exact")


# Keys moved beyond 2**53, where neighbouring integers are one double.
@query("a11_big_integers", """select p as prob, cast(nth as varchar) as exact from (
  select p, (select k from (select 9007199254740993 + o_orderkey as k, row_number() over (order by o_orderkey) - 1 as r,
    count(*) over () as n from orders) where r = round(p * (n - 1))) as nth from (select unnest([0.25, 0.5, 0.9]::double[]) as p))""")
def a11_big(spark, sf):
    keys = table(spark, sf, "orders").select((F.col("o_orderkey") + F.lit(9007199254740993)).alias("k"))
    return exact_quantiles(keys, ["k"], [0.25, 0.5, 0.9], "nearest").select(
        "prob", F.col("exact").cast("decimal(38,0)").cast("string").alias("exact"))


@query("a12_group_count", f"with {VAC} select role_ids[1] as role, count(*) as cnt from vac group by 1")
def a12(spark, sf):
    return vacancies(spark, sf).groupBy(
        first_item(F.col("professional_roles"))["id"].alias("role")).agg(n_rows())


@query("a13_group_by_nested", f"""with {VAC}
select schedule_id, array_to_string(role_ids, ',') as roles, count(*) as cnt from vac group by schedule_id, role_ids""")
def a13(spark, sf):
    return vacancies(spark, sf).groupBy("schedule", "professional_roles").agg(n_rows()).select(
        F.col("schedule.id").alias("schedule_id"),
        F.array_join("professional_roles.id", ",").alias("roles"), "cnt")


@query("a14_count_and_distinct", f"""with {VAC}
select schedule_id, count(*) as rows_cnt, count(distinct id) as unique_id_cnt from vac group by 1""")
def a14(spark, sf):
    return vacancies(spark, sf).groupBy("schedule").agg(
        n_rows("rows_cnt"), F.count_distinct("id").alias("unique_id_cnt")).select(
        F.col("schedule.id").alias("schedule_id"), "rows_cnt", "unique_id_cnt")


@query("a15_facet_counts", f"""with {VAC}, f as (
  select 'area' as facet, area_name as value from vac
  union all select 'employment', employment_form_id from vac
  union all select 'employer', employer_id from vac
  union all select 'accept_temporary', cast(accept_temporary as varchar) from vac
  union all select 'professional_role', unnest(role_ids) from vac
  union all select 'work_format', unnest(work_format_ids) from vac
  union all select 'work_format', null from vac where work_format_ids is null)
select facet, value, count(*) as found from f group by all""")
def a15(spark, sf):
    return facet_counts(
        vacancies(spark, sf),
        {"area": F.col("area.name"), "employment": F.col("employment_form.id"),
         "employer": F.col("employer.id"), "accept_temporary": F.col("accept_temporary")},
        {"professional_role": F.col("professional_roles.id"),
         "work_format": F.col("work_format.id")},
    )


@query("a15_order_facets", """with f as (
  select 'status' as facet, o_orderstatus as value from orders
  union all select 'priority', o_orderpriority from orders
  union all select 'segment', c_mktsegment from orders join customer on o_custkey = c_custkey)
select facet, value, count(*) as found from f group by all""")
def a15_orders(spark, sf):
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return facet_counts(orders, {
        "status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority"),
        "segment": F.col("c_mktsegment")})


_SUMMARY_NUM = """select '{c}' as "column", count({c}) as "count", count_if({c} is null)::bigint as null_count,
  round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, cast(min({c}) as double) as min,
  cast(max({c}) as double) as max, cast({p25} as double) as p25, cast({p50} as double) as p50,
  cast({p75} as double) as p75, cast(null as varchar) as first_value, cast(null as varchar) as last_value
from orders"""
_SUMMARY_TEXT = """select '{c}', count({c}), count_if({c} is null)::bigint, null, null, null, null, null, null, null,
  cast(min({c}) as varchar), cast(max({c}) as varchar) from orders"""
_SUMMARY = " union all ".join(
    [_SUMMARY_NUM.format(c=c, p25=_near(c, 0.25, "orders"), p50=_near(c, 0.5, "orders"),
                         p75=_near(c, 0.75, "orders"))
     for c in ("o_orderkey", "o_custkey", "o_totalprice")]
    + [_SUMMARY_TEXT.format(c=c) for c in ("o_orderstatus", "o_orderpriority", "o_orderdate")])


@query("a16_column_summary", _SUMMARY)
def a16(spark, sf):
    return column_summary(table(spark, sf, "orders")).drop("total_cnt").withColumns({
        "mean": F.round("mean", 4), "std": F.round("std", 4)})


_SPINE = """spine as (select cast(d as date) as day, row_number() over (order by d) - 1 as idx
  from (select unnest(generate_series(max(ts)::date - 89, max(ts)::date, interval 1 day)) as d from events)),
series as (select day, idx, coalesce(n, 0) as found from spine left join
  (select cast(ts as date) as day, count(*) as n from events group by 1) using (day))"""
_DESCRIBE = """count(found) as "count", round(avg(found), 6) as mean, round(stddev_samp(found), 6) as std,
  cast(min(found) as double) as min, round(quantile_cont(found, 0.25), 6) as p25,
  round(quantile_cont(found, 0.5), 6) as p50, round(quantile_cont(found, 0.75), 6) as p75,
  cast(max(found) as double) as max"""


def _daily(spark, sf):
    ev = events(spark, sf)
    return daily_counts(ev, F.col("ts"), date_spine(ev, F.col("ts"), 90))


@query("a17_describe_series", f"""with {_SPINE}
select 'all' as part, {_DESCRIBE} from series
union all select 'after 60', {_DESCRIBE} from series where idx >= 60""")
def a17(spark, sf):
    part = F.explode(F.when(F.col("idx") >= 60, F.array(F.lit("all"), F.lit("after 60")))
                     .otherwise(F.array(F.lit("all"))))
    return describe_counts(_daily(spark, sf).withColumn("part", part), "found", ["part"])


@query("a18_daily_series", f"with {_SPINE} select * from series")
def a18(spark, sf):
    return _daily(spark, sf)


@query("a19_alias_in_select", f"""with {VAC}
select rows_cnt, unique_cnt, null_cnt, round(null_cnt / rows_cnt * 100, 2) as null_prcnt,
  round(null_cnt / (rows_cnt + null_cnt) * 100, 2) as null_share from (
select count(requirement) as rows_cnt, count(distinct requirement) as unique_cnt,
  count(*) filter (where requirement is null) as null_cnt from vac)""")
def a19(spark, sf):
    return fill_report(vacancies(spark, sf), "snippet.requirement")


@query("a20_found_per_window", f"""with {VAC}
select date_trunc('hour', published_at_utc) as start, employment_form_id, count(*) as found
from vac group by all""")
def a20(spark, sf):
    from marketlake.plans.silver import with_utc_and_offset

    return with_utc_and_offset(vacancies(spark, sf)).groupBy(
        F.date_trunc("hour", "published_at_utc").cast("timestamp_ntz").alias("start"),
        F.col("employment_form.id").alias("employment_form_id"),
    ).agg(n_rows("found"))


def area_nodes(spark, sf):
    """region -> nation -> customer as (id, parent_id, name)."""
    region = table(spark, sf, "region").selectExpr(
        "concat('r', r_regionkey) as id", "cast(null as string) as parent_id", "r_name as name")
    nation = table(spark, sf, "nation").selectExpr(
        "concat('n', n_nationkey)", "concat('r', n_regionkey)", "n_name")
    customer = table(spark, sf, "customer").selectExpr(
        "concat('c', c_custkey)", "concat('n', c_nationkey)", "c_name")
    return region.union(nation).union(customer)


NODES = """nodes as (select 'r' || r_regionkey as id, cast(null as varchar) as parent_id, r_name as name from region
  union all select 'n' || n_nationkey, 'r' || n_regionkey, n_name from nation
  union all select 'c' || c_custkey, 'n' || c_nationkey, c_name from customer)"""


@query("a21_child_counts", f"""with {NODES}
select n.id, n.name, count(c.id) as child_cnt from nodes n left join nodes c on c.parent_id = n.id
group by all""")
def a21(spark, sf):
    return child_counts(area_nodes(spark, sf))


@query("t9_area_grid", f"""with g as (select n_name as area, count(c_custkey) as found
  from nation left join customer on c_nationkey = n_nationkey group by 1)
select 'nations' as grid, {_DESCRIBE} from g
union all select 'sample', {_DESCRIBE} from
  (select * from g order by md5(area) limit 10)""")
def t9(spark, sf):
    from marketlake.operators.topk import stable_sample

    nation, customer = table(spark, sf, "nation"), table(spark, sf, "customer")
    found = customer.groupBy("c_nationkey").agg(n_rows("n"))
    grid = nation.join(found, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
        F.col("n_name").alias("area"), F.coalesce("n", F.lit(0)).alias("found"))
    both = grid.withColumn("grid", F.lit("nations")).union(
        stable_sample(grid, 10, F.col("area")).withColumn("grid", F.lit("sample")))
    return describe_counts(both, "found", ["grid"])
