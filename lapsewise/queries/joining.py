"""Joins, marks, exclusions and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsewise import fixed_values as fv
from lapsewise.operators import joins, lookups
from lapsewise.queries.base import derived, plain, query, table
from lapsewise.queries.stand_ins import LISTS, lists
from lapsewise.sources.files import recent_contacts


@query("""select o_custkey, o_orderkey, c_name, c_acctbal from orders
left join (select * from customer where c_acctbal > 0) on o_custkey = c_custkey""")
def left_dim_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    customers = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_acctbal"
    )
    return joins.add_reference(orders, customers, ["o_custkey"])


@query("""select distinct l_partkey as partkey, l_suppkey, p_type, p_brand
from lineitem join part on l_partkey = p_partkey where p_size > 10""")
def inner_distinct_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("partkey"), "l_suppkey")
    parts = table(spark, sf_dir, "part").where("p_size > 10").select(
        F.col("p_partkey").alias("partkey"), "p_type", "p_brand"
    )
    return joins.match_distinct(lines, parts, ["partkey"])


@query("""select c_custkey, case when exists (select 1 from supplier where s_nationkey = c_nationkey and s_acctbal > 5000)
  then 'O' else 'N' end as present from customer""")
def presence_flag(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    rich = table(spark, sf_dir, "supplier").where("s_acctbal > 5000")
    return joins.mark_text(customers, "c_nationkey", rich, "s_nationkey", "present", "O", "N").drop("c_nationkey")


@query("""select l.s_suppkey, upper(coalesce(l.mail, '')) as mail, r.email, r.balance
from (select s_suppkey, case when s_nationkey <> 3 then lower(s_name) end as mail from supplier) l
left join (select upper(s_name) as email, s_acctbal as balance from supplier where s_acctbal > 0) r
  on upper(coalesce(l.mail, '')) = r.email""")
def email_like_enrich(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    left = suppliers.select("s_suppkey", F.when(F.col("s_nationkey") != 3, F.lower("s_name")).alias("mail"))
    right = suppliers.where("s_acctbal > 0").select(F.upper("s_name").alias("email"), F.col("s_acctbal").alias("balance"))
    return joins.add_by_upper_key(left, "mail", right, "email")


BUYERS_SQL = """(select distinct user_id from events
  where event_type = 'purchase' and cast(ts as date) between date '2024-01-05' and date '2024-01-25')"""


def _buyers(spark, sf_dir):
    day = F.col("ts").cast("date")
    return table(spark, sf_dir, "events").where(
        (F.col("event_type") == "purchase")
        & day.between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-25").cast("date"))
    )


@query(f"select c_custkey, c_name from customer where c_custkey not in {BUYERS_SQL}")
def contact_exclusion(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return joins.exclude_members(customers, "c_custkey", _buyers(spark, sf_dir), "user_id")


@query(f"select c_custkey, case when c_custkey in {BUYERS_SQL} then 'DONE' else '-' end as contact from customer")
def contact_mark(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return joins.mark_text(customers, "c_custkey", _buyers(spark, sf_dir), "user_id", "contact", "DONE", "-")


@query(f"""select NOGPA as identifiantrce, note_fragilite from ({plain(LISTS)})
where month_end between last_day(date '1999-09-30' - interval 8 month) and date '1999-09-30'
union all
select lpad(cast(user_id as varchar), 8, '0'), 10 from events where event_type = 'signup'""")
def contact_history(spark, sf_dir):
    extra = table(spark, sf_dir, "events").where("event_type = 'signup'").select(
        F.lpad(F.col("user_id").cast("string"), 8, "0").alias("NOGPA"), F.lit(10).alias("note_fragilite")
    )
    return recent_contacts(lists(spark, sf_dir), "19990930", extra=[extra])


@query("select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_acctbal < 0)")
def rerun_semi(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.keep_members(orders, "o_custkey", table(spark, sf_dir, "customer").where("c_acctbal < 0"), "c_custkey")


@query("""select o_orderkey, o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING') as control
from orders""")
def control_mark(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    members = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    return joins.mark_members(orders, "o_custkey", members, "c_custkey", "control").drop("o_custkey")


PREFIX_SQL = ", ".join(f"({k}, '{v}')" for k, v in fv.DIAL_PREFIX.items())


@query(f"""select p_partkey, coalesce(prefix, '-') as prefix
from (select p_partkey, case when p_type = 'PROMO' then '2A' when p_size > 45 then null
             else cast(2 * p_size as varchar) end as department from part) p
left join (values {PREFIX_SQL}) t(number, prefix) on try_cast(department as integer) = number""")
def dial_prefix(spark, sf_dir):
    department = (
        F.when(F.col("p_type") == "PROMO", "2A").when(F.col("p_size") <= 45, (F.col("p_size") * 2).cast("string"))
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", department.alias("department"))
    return lookups.add_dial_prefix(parts, "department", "prefix").drop("department")


LADDER_SQL = ", ".join(str(row) for row in fv.PRODUCT_LADDER)
# a product code and an action id for every part
PRODUCTS = """
select p_partkey, p_name,
       case when p_type = 'PROMO' then 'SATEI-FS' when p_type = 'LARGE' then 'OLD-' else 'SATEI-FM' end
         || case when p_type = 'PROMO' and p_size < 25 then '3P'
                 else '0' || cast(1 + cast(floor(p_size / 9) as int) as varchar(2)) end as product,
       cast(case when p_size > 30 then 1 else 0 end as varchar(1)) || case when p_size < 20 then '1' else '0' end
         || case when p_type = 'PROMO' then '1' else '0' end || case when p_size > 10 then '1' else '0' end as action
from {part}
"""


@query(f"""with p as ({plain(PRODUCTS)}), ladder as (select * from (values {LADDER_SQL}) t(code, next_code, family, label))
select p_partkey, product, action,
       coalesce(label, p_name || ' (' || product || ')') as product_label, coalesce(family, 'AUTRE') as product_family,
       case when substr(action, 3, 1) = '1' then coalesce(next_code, 'SATEI-FS03')
            when substr(action, 2, 1) = '1' then coalesce(next_code, 'SATEI-FM03')
            when substr(action, 1, 1) = '1' then 'SATEI-FS03' else product end as proposed_product
from p left join ladder on product = code""")
def product_ladder(spark, sf_dir):
    return lookups.add_ladder(derived(spark, sf_dir, PRODUCTS), "product", "p_name", "action").drop("p_name")


GRID_SQL = """(select p_type as department, cast(10 * floor(p_size / 10) as int) as age_min,
  cast(10 * floor(p_size / 10) + 9 as int) as age_max, p_type || cast(cast(floor(p_size / 10) as int) as varchar) as formula,
  min(p_retailprice) as price from part where p_size < 40 group by p_type, floor(p_size / 10))"""


@query(f"""select p_partkey, p_type, p_size, g.formula, g.price
from part left join {GRID_SQL} g on p_type = department and p_size between age_min and age_max""")
def tariff_lookup(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    band = F.floor(F.col("p_size") / 10).cast("int")
    grid = (
        parts.where("p_size < 40")
        .groupBy(F.col("p_type").alias("department"), band.alias("band"))
        .agg(F.min("p_retailprice").alias("price"))
        .select(
            "department", (F.col("band") * 10).alias("age_min"), (F.col("band") * 10 + 9).alias("age_max"),
            F.concat("department", F.col("band").cast("string")).alias("formula"), "price",
        )
    )
    return lookups.add_price(parts.select("p_partkey", "p_type", "p_size"), grid, "p_size", "p_type")
