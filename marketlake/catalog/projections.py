"""Projections, filters and samples."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.catalog.base import VAC, events, query, table, vacancies
from marketlake.functions.casts import try_cast_text
from marketlake.functions.lists import first_item
from marketlake.operators.joins import keep_members, look_up
from marketlake.operators.dedup import most_repeated_key
from marketlake.operators.topk import random_rows, stable_sample, tail
from marketlake.plans.historical import Dump, to_canonical
from marketlake.sources.contract import DEPRECATED_COLUMNS, VACANCY

CUSTOMER_DUMP = Dump("customer", ";", "yyyy-MM-dd",
                     {"vacancy_id": "c_custkey", "vacancy_name": "c_name",
                      "salary_from": "c_acctbal"})
SUPPLIER_DUMP = Dump("supplier", ";", "yyyy-MM-dd",
                     {"vacancy_id": "s_suppkey", "vacancy_name": "s_name"})


@query("p1_select_alias", "select event_id as id, event_type as kind, value from events")
def p1(spark, sf):
    return events(spark, sf).select(
        F.col("event_id").alias("id"), F.col("event_type").alias("kind"), "value")


@query("p2_derived_columns", """select event_id, ts, round(value * 2, 2) as doubled,
  length(props) as props_len, value > 50 as is_big from events""")
def p2(spark, sf):
    return events(spark, sf).select("event_id", "ts", "value", "props").withColumns({
        "doubled": F.round(F.col("value") * 2, 2),
        "props_len": F.length("props").cast("bigint"),
        "is_big": F.col("value") > 50,
    }).drop("value", "props")


@query("p3_all_but", "select * exclude (props, value) from events")
def p3(spark, sf):
    return events(spark, sf).drop("props", "value")


@query("p4_rename_mapping", """select cast(c_custkey as varchar) as vacancy_id,
  c_name as vacancy_name from customer""")
def p4(spark, sf):
    return to_canonical(table(spark, sf, "customer"), CUSTOMER_DUMP).select(
        "vacancy_id", "vacancy_name")


P5_TYPES = {"o_orderkey": "string", "o_orderstatus": "bigint", "o_orderpriority": "string",
            "o_totalprice": "bigint"}


@query("p5_cast_mapping", """select cast(o_orderkey as varchar) as o_orderkey,
  try_cast(o_orderstatus as bigint) as o_orderstatus, o_orderpriority,
  cast(trunc(o_totalprice) as bigint) as o_totalprice from orders""")
def p5(spark, sf):
    return table(spark, sf, "orders").select(
        *[_typed(table(spark, sf, "orders"), c, t).alias(c) for c, t in P5_TYPES.items()])


def _typed(df, column, kind):
    if df.schema[column].dataType == T.StringType() and kind != "string":
        return try_cast_text(F.col(column), T.LongType())
    return F.col(column).try_cast(kind)


@query("p6_provenance", """select cast(s_suppkey as varchar) as vacancy_id,
  'supplier' as file_source from supplier""")
def p6(spark, sf):
    return to_canonical(table(spark, sf, "supplier"), SUPPLIER_DUMP).select(
        "vacancy_id", "file_source")


@query("p7_default_column", """select cast(s_suppkey as varchar) as vacancy_id,
  'hh' as data_source from supplier""")
def p7(spark, sf):
    return to_canonical(table(spark, sf, "supplier"), SUPPLIER_DUMP).select(
        "vacancy_id", "data_source")


@query("p8_key_not_null", f"""with {VAC}
select url, salary_from from vac where salary_from is not null""")
def p8(spark, sf):
    return vacancies(spark, sf).filter(F.col("salary").isNotNull()).select(
        "url", F.col("salary.from").alias("salary_from"))


@query("p9_drop_any_null", f"""with {VAC}
select url, requirement, responsibility from vac
where requirement is not null and responsibility is not null""")
def p9(spark, sf):
    return vacancies(spark, sf).select(
        "url", F.col("snippet.requirement").alias("requirement"),
        F.col("snippet.responsibility").alias("responsibility"),
    ).dropna("any", subset=["requirement", "responsibility"])


@query("p10_filter_by_found_key", """select * from lineitem where l_orderkey = (
  select l_orderkey from lineitem group by 1 order by count(*) desc, l_orderkey limit 1)""")
def p10(spark, sf):
    items = table(spark, sf, "lineitem")
    return keep_members(items, most_repeated_key(items, ["l_orderkey"]), "l_orderkey")


@query("p11_first_element_filter", f"""with {VAC}
select url, name from vac where role_ids[1] = 'r3'""")
def p11(spark, sf):
    return vacancies(spark, sf).filter(
        first_item(F.col("professional_roles"))["id"] == "r3").select("url", "name")


@query("p12_key_set", """select * from orders
where o_custkey in (select c_custkey from customer where c_mktsegment = 'MACHINERY')""")
def p12(spark, sf):
    members = table(spark, sf, "customer").filter("c_mktsegment = 'MACHINERY'").select(
        F.col("c_custkey").alias("o_custkey"))
    return keep_members(table(spark, sf, "orders"), members, "o_custkey")


@query("p13_struct_fields", f"""with {VAC}
select url, area_name, employer_id, requirement from vac""")
def p13(spark, sf):
    return vacancies(spark, sf).select(
        "url", F.col("area.name").alias("area_name"), F.col("employer.id").alias("employer_id"),
        F.col("snippet.requirement").alias("requirement"))


@query("p14_deprecated_columns", f"""with {VAC}
select url, schedule_id, salary_from,
 case when event_id % 7 > 0 then ['full', 'part', 'project'][cast(event_id % 3 + 1 as int)] end as employment_id,
 case when event_id % 5 > 0 then 'd' || (event_id % 3) end as working_days_ids,
 case when event_id % 4 > 0 then 'i' || (event_id % 6) || ',i6' else '' end as working_time_intervals_ids,
 'm' || (user_id % 4) as working_time_modes_ids from vac""")
def p14(spark, sf):
    """All declared deprecated columns, as the contract reads them from JSON lines that hold them."""
    def items(*ids):
        return F.array(*[F.struct(i.alias("id"), F.lit("name").alias("name")) for i in ids])

    event = F.col("event_id")
    kind = F.element_at(F.array(F.lit("full"), F.lit("part"), F.lit("project")), (event % 3 + 1).cast("int"))
    own = vacancies(spark, sf).join(events(spark, sf).select("event_id", "user_id"), "event_id").withColumns({
        "employment": F.when(event % 7 > 0, F.struct(kind.alias("id"), F.lit("name").alias("name"))),
        "working_days": F.when(event % 5 > 0, items(F.concat(F.lit("d"), event % 3))),
        "working_time_intervals": F.when(event % 4 > 0, items(F.concat(F.lit("i"), event % 6), F.lit("i6")))
        .otherwise(F.array().cast("array<struct<id:string,name:string>>")),
        "working_time_modes": items(F.concat(F.lit("m"), F.col("user_id") % 4)),
    })
    lines = own.select(F.to_json(F.struct(*[c for c in own.columns if c not in ("event_id", "ts", "user_id")])).alias("line"))
    record = T.StructType([f for f in VACANCY if f.name in ("url", *DEPRECATED_COLUMNS)])
    read = lines.select(F.from_json("line", record).alias("r")).select("r.url", *[f"r.{c}" for c in DEPRECATED_COLUMNS])
    return read.select(
        "url", F.col("schedule.id").alias("schedule_id"), F.col("salary.from").alias("salary_from"),
        F.col("employment.id").alias("employment_id"),
        *[F.array_join(f"{c}.id", ",").alias(f"{c}_ids") for c in DEPRECATED_COLUMNS if c.startswith("working_")])


@query("p15_head_tail", """select 'head' as part, * from (select * from events order by ts, event_id limit 1000)
union all select 'tail', * from (select * from events order by ts desc, event_id desc limit 1000)""")
def p15(spark, sf):
    ev = events(spark, sf)
    head = ev.orderBy("ts", "event_id").limit(1000)
    parts = head.withColumn("part", F.lit("head")).union(
        tail(ev, 1000, ["ts", "event_id"]).withColumn("part", F.lit("tail")))
    return parts


@query("p16_stable_sample", """select * from events
order by md5(cast(event_id as varchar)) limit 10""")
def p16(spark, sf):
    return stable_sample(events(spark, sf), 10, F.col("event_id"))


@query("p16_random_rows", "select least(count(*), 10) as row_cnt from events")
def p16_random(spark, sf):
    return random_rows(events(spark, sf), 10, seed=42).agg(F.count(F.lit(1)).alias("row_cnt"))


@query("j2_dictionary_lookup", """select c_custkey, n_name, n_regionkey
from customer left join nation on c_nationkey = n_nationkey""")
def j2(spark, sf):
    return look_up(table(spark, sf, "customer"), table(spark, sf, "nation"), "c_nationkey",
                   "n_nationkey").select("c_custkey", "n_name", "n_regionkey")
