"""Stand-ins for the portfolio and campaign tables, derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lapsewise.functions.rules import add_flags
from lapsewise.queries.base import derived, plain

FIRST, LAST = "199701", "199909"
FLAGS = ("top_line_senior", "top_line_clas", "top_solo", "top_pro", "top_part", "top_autre")
SCOPE_COLUMNS = ("p_type", "p_name", "p_brand")

# versions of a contract: the orders of a customer from one supplier
CONTRACTS = """
select cast(o_custkey as varchar(20)) || '_' || cast(l_suppkey as varchar(20)) as contract_id,
       o_custkey as client_id,
       cast(o_orderdate as date) as start_date,
       case when l_shipdate >= o_orderdate then cast(l_shipdate as date) end as end_date,
       c_mktsegment as network, p_type, p_name, p_brand
from {lineitem} join {orders} on l_orderkey = o_orderkey
     join {customer} on o_custkey = c_custkey
     join {part} on l_partkey = p_partkey
"""


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, CONTRACTS).withColumnsRenamed({"start_date": "start", "end_date": "end"})


def scope_rules() -> dict:
    line = F.col("p_type").rlike("PROMO|ECONOMY")
    return {
        "top_line_senior": line & F.col("p_name").rlike("gear|bolt|ring"),
        "top_line_clas": line & (F.col("top_line_senior") == 0),
        "top_solo": F.col("p_brand") == "Brand#4",
        "top_pro": F.col("p_type") == "LARGE",
        "top_part": F.col("p_type") == "SMALL",
    }


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_flags(contracts(spark, sf_dir), scope_rules(), other="top_autre")


FLAGS_SQL = """
  case when regexp_matches(p_type, 'PROMO|ECONOMY') and regexp_matches(p_name, 'gear|bolt|ring') then 1 else 0 end as top_line_senior,
  case when regexp_matches(p_type, 'PROMO|ECONOMY') and not regexp_matches(p_name, 'gear|bolt|ring') then 1 else 0 end as top_line_clas,
  case when p_brand = 'Brand#4' then 1 else 0 end as top_solo,
  case when p_type = 'LARGE' then 1 else 0 end as top_pro,
  case when p_type = 'SMALL' then 1 else 0 end as top_part,
  case when not regexp_matches(p_type, 'PROMO|ECONOMY') and p_brand <> 'Brand#4' and p_type not in ('LARGE', 'SMALL')
       then 1 else 0 end as top_autre"""

CONTRACTS_SQL = f"""contracts as ({plain(CONTRACTS)}),
flagged as (select *, {FLAGS_SQL} from contracts)"""

FROM_SQL, TO_SQL = "date '1997-01-01'", "date '1999-09-01'"

# contract-months, the ends of a contract's versions merged
EXPANDED_SQL = f"""clipped as (
  select *, greatest(cast(date_trunc('month', start_date) as date), {FROM_SQL}) as s,
         least(cast(date_trunc('month', coalesce(end_date, {TO_SQL})) as date), {TO_SQL}) as e
  from flagged where start_date <> end_date or end_date is null),
spans as (select * from clipped where s <= e),
merged as (select *, max(coalesce(end_date, date '9999-12-01')) over (partition by contract_id) as exit_date from spans),
exploded as (select *, unnest(generate_series(s, e, interval 1 month)) as at_month from merged),
monthly as (
  select *, strftime(at_month, '%Y%m') as month, strftime(at_month, '%Y') as year,
         strftime(exit_date, '%Y%m') as exit_month, strftime(exit_date, '%Y') as exit_year
  from exploded)"""
MONTHLY_SQL = f"""{CONTRACTS_SQL},
{EXPANDED_SQL}"""

IDS = (("nbCli", "client_id"), ("nbCtr", "contract_id"))


def wide_stock_sql(flags=FLAGS) -> str:
    return ", ".join(
        f"nullif(count(distinct case when {f} = 1 then {c} end), 0) as {k}_{f}" for f in flags for k, c in IDS
    )


def wide_exit_sql(period: str, flags=FLAGS) -> str:
    return ", ".join(
        f"case when max({f}) = 1 then count(distinct case when {f} = 1 and {period} = exit_{period} then {c} end) end"
        f" as {k}_{f}"
        for f in flags
        for k, c in IDS
    )


MEASURES = ", ".join(f"{k}_{f}" for f in FLAGS for k, _ in IDS)
MEASURES_SQL = f"""{MONTHLY_SQL},
stock_wide as (select month, network, {wide_stock_sql()} from monthly group by month, network),
exit_wide as (select month, network, {wide_exit_sql('month')} from monthly group by month, network),
stock_long as (unpivot stock_wide on {MEASURES} into name name value stock),
exit_long as (unpivot exit_wide on {MEASURES} into name name value terminated),
measures as (
  select s.month, s.network, s.name, s.stock, x.terminated,
         split_part(s.name, '_', 1) as kind, substr(s.name, 11) as product,
         substr(s.month, 1, 4) as year,
         cast(x.terminated as double) / s.stock as rate
  from stock_long s join exit_long x using (month, network, name))"""

# campaign candidates: a customer is a contract, two neighbouring customers are one person
CANDIDATES = """
select 'C' || cast(c_custkey as varchar(20)) as identifiant,
       cast(cast(floor(c_custkey / 2) as bigint) as varchar(20)) as identifiantrce,
       c_nationkey as identifiantintermediaire,
       case when c_nationkey % 6 <> 0 then lower(s_name) end as intmail,
       case when c_custkey % 5 <> 0 then cast(600000000 + c_custkey as double) end as telmobile,
       case when c_custkey % 7 <> 0 then cast(100000000 + c_custkey as double) end as telfixe,
       c_nationkey + 1 as codedepartement,
       case when c_custkey % 11 <> 0 then cast(15 + c_custkey % 75 as double) end as agepersphysique,
       case c_mktsegment when 'BUILDING' then 'GAV' when 'MACHINERY' then 'GAV, SANTEIS'
            when 'FURNITURE' then 'SERENIVIE, GAV, SANTEIS' when 'HOUSEHOLD' then 'SERENIVIE' else 'MRH' end as proposition,
       yearly as montantannuelttcvalestime,
       case when c_nationkey % 3 = 0 then '' when c_nationkey % 3 = 1 then 'AUTO' else 'AUTO, VIE' end
         as autres_produits_detenus,
       case when c_custkey % 4 = 0 then '[]' else '["le client paie peu", ''le client est jeune'']' end as raisons_fragilite,
       case when c_custkey % 2 = 0 then 'SEUL' else 'MARIE' end as libsituationfamiliale,
       case when c_custkey % 3 = 0 then 'Solo' when c_custkey % 3 = 1 then 'Famille' else 'Duo' end as SITFAM_2,
       c_mktsegment as lib_produit, c_name as nompersonne, n_name as prenom, c_mktsegment as libcsp,
       n_name as nomrue, n_name as localite,
       c_acctbal as score_model,
       coalesce(n_orders, 0) as anciennete_contrat_mois,
       case when c_custkey % 3 = 0 then c_custkey % 10 - 6 end as nb_mois_depuis_resiliation,
       c_custkey % 2 as actions_123, c_custkey % 3 as actions_67,
       coalesce(first_month, 1) as mois_anniversaire
from {customer} join {nation} on c_nationkey = n_nationkey
     left join (select o_custkey, count(*) as n_orders, month(min(o_orderdate)) as first_month,
                       cast(max(o_totalprice) as double) as yearly
                from {orders} group by o_custkey) o on c_custkey = o_custkey
     left join (select s_nationkey, min(s_name) as s_name from {supplier} group by s_nationkey) s
       on c_nationkey = s_nationkey
"""
# advisors: the first supplier of each nation; hierarchy: nations with their region as level
ADVISORS = """
select s_nationkey as nation, upper(min(s_name)) as email, 'CC' || cast(s_nationkey as varchar(20)) as cc_nom,
       'P' || cast(s_nationkey as varchar(20)) as cc_prenom
from {supplier} group by s_nationkey
"""
HIERARCHY = """
select n_nationkey as Id_Intermediaire, case when n_regionkey = 2 then 4 else 5 end as niveau_ptf from {nation}
"""
# contact lists: the customers of each order month
LISTS = """
select lpad(cast(cast(floor(o_custkey / 2) as bigint) as varchar(20)), 8, '0') as NOGPA,
       cast(7 + o_custkey % 4 as int) as note_fragilite, o_orderstatus as campaign,
       case when o_orderpriority = '1-URGENT' then 'temoin' else 'contact' end as role,
       cast(last_day(cast(o_orderdate as date)) as date) as month_end
from {orders}
"""
# price grids by part type and size band
HEALTH_GRID = """
select cast(nation + 1 as int) as department, cast(10 * band as int) as age_min, cast(10 * band + 9 as int) as age_max,
       case when band < 6 then 'SATEI-FM03' else 'SATEI-FS03' end as formula, cast(20 + band + nation as double) as price
from (select distinct p_partkey % 25 as nation, cast(floor(p_size / 5) as int) as band from {part}) b
"""
FUNERAL_GRID = """
select cast(10 * band as int) as age_min, cast(10 * band + 9 as int) as age_max,
       case when band < 4 then '' when band < 7 then 'REFERENCE' else 'PRESTIGE' end as formula,
       cast(30 + band as double) as price
from (select distinct cast(floor(p_size / 5) as int) as band from {part}) b
"""


def stand_in(text: str):
    return lambda spark, sf_dir: derived(spark, sf_dir, text)


candidates, advisors, hierarchy, lists, health_grid, funeral_grid = map(
    stand_in, (CANDIDATES, ADVISORS, HIERARCHY, LISTS, HEALTH_GRID, FUNERAL_GRID)
)
