"""Projections, filters, sources and snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lapsewise.functions import dates, text
from lapsewise.operators import snapshots
from lapsewise.queries.base import query, table
from lapsewise.queries.stand_ins import CONTRACTS_SQL, contracts
from lapsewise.sources import files, sinks, tables, workspace


@query("""select cast(c_custkey as varchar) as customer_id, c_name as name, 'DONE' as mark,
       cast(trunc(c_acctbal) as integer) as balance, c_mktsegment as network from customer""")
def projection_basics(spark, sf_dir):
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
        .withColumnsRenamed({"c_custkey": "customer_id", "c_name": "name", "c_mktsegment": "network"})
        .withColumn("customer_id", F.col("customer_id").cast("string"))
        .withColumn("mark", F.lit("DONE"))
        .withColumn("balance", F.col("c_acctbal").cast("int"))
        .drop("c_acctbal")
    )


@query("""select o_orderkey, strftime(o_orderdate, '%Y%m') as month, o_orderstatus = 'F' as closed from orders
where o_orderstatus in ('F', 'O') and o_orderpriority <> '' and o_totalprice >= 1000 and o_totalprice <= 400000
  and strftime(o_orderdate, '%Y%m') <= '199912'""")
def filter_basics(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(
        F.col("o_orderstatus").isin("F", "O")
        & (F.col("o_orderpriority") != "")
        & (F.col("o_totalprice") >= 1000)
        & (F.col("o_totalprice") <= 400000)
        & (F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))  # a date, so that the scan gets it
    )
    closed = F.col("o_orderstatus") == "F"
    return orders.select("o_orderkey", dates.month_key(F.col("o_orderdate")).alias("month"), closed.alias("closed"))


@query("select l_orderkey, l_linenumber, l_quantity from lineitem where l_linenumber is null or l_linenumber <> 2")
def null_tolerant_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return rows.where(~F.col("l_linenumber").eqNullSafe(2))


@query(f"""with {CONTRACTS_SQL}
select contract_id, coalesce(end_date, start_date) as known_end, coalesce(end_date, date '9999-12-01') as filled_end
from contracts""")
def coalesce_start(spark, sf_dir):
    return contracts(spark, sf_dir).select(
        "contract_id",
        F.coalesce("end", "start").alias("known_end"),
        F.coalesce("end", F.lit("9999-12-01").cast("date")).alias("filled_end"),
    )


@query("""select o_orderkey, case when o_orderstatus in ('F', 'O') then lpad(cast(o_custkey as varchar), 11, '0')
            else cast(o_custkey as varchar) end as policy,
       case when length(cast(o_custkey as varchar)) >= 3 then cast(o_custkey as varchar)
            else lpad(cast(o_custkey as varchar), 3, '0') end as filled
from orders""")
def policy_key(spark, sf_dir):
    customer = F.col("o_custkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.policy_number(customer, F.col("o_orderstatus"), ("F", "O"), 11).alias("policy"),
        text.zero_fill(customer, 3).alias("filled"),
    )


@query("""select l_orderkey, l_linenumber,
       cast(l_orderkey as varchar) || '_' || nullif(l_returnflag, 'N') || '_' || l_linestatus as contract_key
from lineitem""")
def contract_key(spark, sf_dir):
    flag = F.nullif(F.col("l_returnflag"), F.lit("N"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        text.contract_key(F.col("l_orderkey"), flag, F.col("l_linestatus")).alias("contract_key"),
    )


@query("""select o_orderkey, strftime(o_orderdate, '%Y%m') as month, cast(year(o_orderdate) as integer) as year,
       cast(month(o_orderdate) as integer) as month_no from orders""")
def month_key(spark, sf_dir):
    date = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.month_key(date).alias("month"), F.year(date).alias("year"), F.month(date).alias("month_no")
    )


@query("""select event_id, item from (
  select event_id, unnest([event_type, json_extract_string(props, '$.k')]) as item from events)""")
def array_roundtrip(spark, sf_dir):
    key = F.get_json_object("props", "$.k")
    as_text = F.concat(F.lit('["'), F.col("event_type"), F.lit('", "'), key, F.lit('"]'))
    return table(spark, sf_dir, "events").select("event_id", F.explode(text.text_list(as_text)).alias("item"))


@query("""select l_orderkey, l_linenumber, l_linestatus, l_quantity from lineitem
where l_linenumber = 3 and l_linestatus = 'F'""")
def snapshot_scan(spark, sf_dir):
    lines = tables.snapshot(table(spark, sf_dir, "lineitem"), "3", "l_linenumber")
    return tables.snapshot(lines, "F", "l_linestatus").select(
        "l_orderkey", "l_linenumber", "l_linestatus", "l_quantity"
    )


@query("""with p as (
  select p_partkey as p_partkey_part, p_brand, p_size, p_retailprice as p_retailprice_part, p_name
  from part where p_type = 'PROMO' and contains(p_name, 'e'))
select p_partkey_part, p_brand, p_size, p_retailprice_part from p
qualify p_size = max(p_size) over (partition by p_brand)""")
def load_table(spark, sf_dir):
    return tables.shape_table(
        table(spark, sf_dir, "part"),
        ["p_partkey_part", "p_brand", "p_size", "p_retailprice_part"],
        equals={"p_type": "PROMO"},
        contains={"p_name": "e"},
        suffixed=["p_partkey", "p_retailprice"],
        suffix="part",
        latest_by=(["p_brand"], "p_size"),
    )


@query("""select o_custkey, o_orderkey, o_orderdate, o_totalprice from orders
qualify o_orderdate = max(o_orderdate) over (partition by o_custkey)""")
def latest_snapshot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return snapshots.keep_latest(orders, ["o_custkey"], "o_orderdate")


@query("""select o_custkey, o_orderkey, o_totalprice from orders
qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) = 1""")
def first_per_client(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return snapshots.first_per_key(orders, ["o_custkey"], [F.col("o_totalprice").desc(), "o_orderkey"])


@query("""select o_orderkey as id, 'order' as origin, o_totalprice as amount, cast(null as varchar) as kind from orders
union all by name select event_id as id, 'event' as origin, value as amount, event_type as kind from events""")
def union_by_name(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.lit("order").alias("origin"), F.col("o_totalprice").alias("amount")
    )
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("kind"), F.col("event_id").alias("id"), F.lit("event").alias("origin"),
        F.col("value").alias("amount"),
    )
    return snapshots.union_all(spark, [orders, events], "id bigint, origin string, amount double, kind string")


@query("select c_custkey, c_name, c_acctbal, c_mktsegment from customer")
def csv_scan(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    path = workspace.new_path(spark, "customers")
    sinks.write_csv(customers, path)
    return files.read_delimited(spark, path, customers.schema)


@query("""select s_nationkey, upper(s_name) as email, 'CC' || cast(s_suppkey as varchar) as cc_nom, s_name as cc_prenom
from supplier""")
def advisor_scan(spark, sf_dir):
    advisors = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("CC"), F.col("s_suppkey").cast("string")).alias("Nom"),
        F.col("s_name").alias("Prénom"),
        F.upper("s_name").alias("Adresse mail"),
    )
    path = workspace.new_path(spark, "advisors")
    advisors.write.csv(path, sep=";", header=True, encoding="UTF-8")
    nations = table(spark, sf_dir, "supplier").select("s_nationkey", F.upper("s_name").alias("email"))
    return files.read_advisors(spark, path).join(nations, "email")


@query("select event_id, ts, user_id, event_type, value from events")
def frame_scan(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    path = workspace.new_path(spark, "events")
    sinks.write_frame(events, path)
    return files.read_frame(spark, path, events.schema)


@query("select o_orderstatus, count(*) as n, cast(sum(o_orderkey) as bigint) as keys from orders group by o_orderstatus")
def catalog_lookup(spark, sf_dir):
    database = f"lapse_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database}")
    try:
        for name in ("orders", "customer"):
            spark.sql(f"CREATE TABLE {database}.{name}_snapshot USING parquet LOCATION '{sf_dir}/{name}.parquet'")
        found = spark.table(f"{database}.{tables.find_table(spark, database, 'orders', 'snapshot')}")
        counts = found.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))
    finally:  # the frame reads the files, which stay
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return counts
