"""Segmentation, cleaning, scoring, messages and calendar rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsewise.functions import amounts, dates, messages, rules, text
from lapsewise.operators import scoring
from lapsewise.queries.base import derived, plain, query, table

# segmentation inputs from orders: formula, age, out of pocket, seniority, contracts by family
ACTIONS = """
select o_orderkey,
       case when o_orderpriority = '1-URGENT' then 'SANTEIS_SENIOR' when o_orderpriority = '2-HIGH' then 'SANTEIS_CLASSIQUE'
            when o_orderpriority = '3-MEDIUM' then 'AUTRE' end as formule,
       cast(20 + o_custkey % 70 as int) as age_assure, o_totalprice / 1000 as montant_rac_12,
       cast(o_custkey % 2 as int) as top_multiequipe, cast(o_custkey % 3 as int) as mrh, cast(o_orderkey % 3 as int) as gav,
       cast(o_orderkey % 2 as int) as pj, cast(month(o_orderdate) * 4 as int) as anciennete_contrat_mois
from {orders}
"""


def _actions(spark, sf_dir):
    formula, age = F.col("formule"), F.col("age_assure")
    spent, months = F.col("montant_rac_12"), F.col("anciennete_contrat_mois")
    return derived(spark, sf_dir, ACTIONS).select(
        "o_orderkey",
        rules.to_senior(formula, age).alias("action1"),
        rules.classic_upgrade(formula, spent, age).alias("action2"),
        rules.senior_upgrade(formula, spent).alias("action3"),
        rules.cross_sell(F.col("top_multiequipe")).alias("action4"),
        rules.single_family(F.col("mrh"), F.col("gav"), F.col("pj")).alias("action5"),
        rules.loyalty_one_year(formula, months).alias("action6"),
        rules.loyalty_three_years(formula, months).alias("action7"),
    )


ACTIONS_SQL = f"""actions as (select o_orderkey,
  case when (formule is null or formule <> 'SANTEIS_SENIOR') and age_assure > 60 then 1 else 0 end as action1,
  case when (formule is null or formule <> 'SANTEIS_SENIOR') and montant_rac_12 > 100 and age_assure <= 60 then 1 else 0 end as action2,
  case when formule = 'SANTEIS_SENIOR' and montant_rac_12 > 250 then 1 else 0 end as action3,
  case when top_multiequipe = 0 then 1 else 0 end as action4,
  case when (mrh > 0 and gav = 0 and pj = 0) or (mrh = 0 and gav > 0 and pj = 0) or (mrh = 0 and gav = 0 and pj > 0)
       then 1 else 0 end as action5,
  case when formule in ('SANTEIS_SENIOR', 'SANTEIS_CLASSIQUE') and anciennete_contrat_mois >= 6
            and anciennete_contrat_mois < 30 then 1 else 0 end as action6,
  case when formule in ('SANTEIS_SENIOR', 'SANTEIS_CLASSIQUE') and anciennete_contrat_mois >= 30 then 1 else 0 end as action7
from ({plain(ACTIONS)}))"""


@query(f"with {ACTIONS_SQL} select * from actions")
def actions(spark, sf_dir):
    return _actions(spark, sf_dir)


def _action_ids(spark, sf_dir):
    loyalty = F.greatest("action6", "action7")
    code = rules.action_id(F.col("action1"), F.col("action2"), F.col("action3"), loyalty)
    return _actions(spark, sf_dir).select("o_orderkey", code.alias("action"))


ACTION_ID_SQL = f"""{ACTIONS_SQL}, ids as (
  select o_orderkey, lpad(cast(1000 * action1 + 100 * action2 + 10 * action3 + greatest(action6, action7) as varchar), 4, '0')
         as action from actions)"""


@query(f"with {ACTION_ID_SQL} select * from ids")
def action_id(spark, sf_dir):
    return _action_ids(spark, sf_dir)


@query(f"""with {ACTION_ID_SQL}
select o_orderkey, case when action[1] = '1' then 'Montée de formule'
   when action[2] = '1' or action[3] = '1' then 'Montée de produit' when action[4] = '1' then 'Bonus fidélité' else '' end as label
from ids""")
def action_label(spark, sf_dir):
    return _action_ids(spark, sf_dir).select("o_orderkey", rules.action_label(F.col("action")).alias("label"))


@query("""select c_custkey, case when code in ('Alsace Moselle', '3') then 'AM' else 'STEA' end as regime,
       case when frame in ('Fonctionnaire', '3') then 'F' else 'NF' end as legal_frame
from (select c_custkey, case when c_mktsegment = 'BUILDING' then 'Alsace Moselle' else cast(nullif(c_nationkey, 5) as varchar) end as code,
             case when c_acctbal < 0 then 'Fonctionnaire' else cast(nullif(c_nationkey, 7) as varchar) end as frame from customer)""")
def recode(spark, sf_dir):
    nation = F.col("c_nationkey")
    code = F.when(F.col("c_mktsegment") == "BUILDING", "Alsace Moselle").otherwise(
        F.nullif(nation, F.lit(5)).cast("string")
    )
    frame = F.when(F.col("c_acctbal") < 0, "Fonctionnaire").otherwise(F.nullif(nation, F.lit(7)).cast("string"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", rules.regime(code).alias("regime"), rules.legal_frame(frame).alias("legal_frame")
    )


@query("""select c_custkey, coalesce('0' || cast(cast(mobile as bigint) as varchar), '0' || cast(cast(landline as bigint) as varchar), '')
         as telephone
from (select c_custkey, case when c_acctbal > 2000 then cast(600000000 + c_custkey as double) end as mobile,
             case when c_nationkey > 3 then cast(100000000 + c_custkey as double) end as landline from customer)""")
def phone(spark, sf_dir):
    mobile = F.when(F.col("c_acctbal") > 2000, (F.col("c_custkey") + 600000000).cast("double")).otherwise(F.lit(float("nan")))
    landline = F.when(F.col("c_nationkey") > 3, (F.col("c_custkey") + 100000000).cast("double"))
    return table(spark, sf_dir, "customer").select("c_custkey", rules.phone(mobile, landline).alias("telephone"))


@query("""with s as (
  select l_orderkey, l_linenumber, l_returnflag <> 'N' as known, l_extendedprice - 20000 as actual,
         (l_extendedprice - 20000) * (1 + l_discount * 2) as simulated, case when l_tax > 0.05 then 'KO' else 'OK' end as status
  from lineitem), f as (
  select *, case when known and ((actual > 0 and 100 * (abs(actual - simulated) / actual) > 10 and abs(actual - simulated) > 5)
                                 or (actual <= 0 and simulated >= 1)) then 1 else 0 end as atypical from s)
select l_orderkey, l_linenumber, atypical, round(abs(actual - simulated), 5) as gap,
       round(case when atypical = 1 then actual else simulated end, 5) as corrected,
       round(case when atypical = 1 or status = 'KO' then actual else 0 end, 5) as failed_amount
from f""")
def sim_flags(spark, sf_dir):
    actual = F.col("l_extendedprice") - 20000
    simulated = actual * (F.col("l_discount") * 2 + 1)
    status = F.when(F.col("l_tax") > 0.05, "KO").otherwise("OK")
    lines = table(spark, sf_dir, "lineitem").withColumns({"actual": actual, "simulated": simulated, "status": status})
    flag = rules.atypical_simulation(F.col("l_returnflag") != "N", F.col("actual"), F.col("simulated"))
    atypical = F.col("atypical")
    return lines.withColumn("atypical", flag).select(
        "l_orderkey", "l_linenumber", "atypical",
        F.round(amounts.gap(F.col("actual"), F.col("simulated")), 5).alias("gap"),
        F.round(rules.corrected_simulation(atypical, F.col("actual"), F.col("simulated")), 5).alias("corrected"),
        F.round(rules.failed_simulation_amount(atypical, F.col("actual"), F.col("status")), 5).alias("failed_amount"),
    )


@query("""select c_custkey, cast(floor(coalesce(balance, 0) / 50) * 50 as bigint) as bucket
from (select c_custkey, nullif(c_acctbal, 73.0) as balance from customer)""")
def bucket_amount(spark, sf_dir):
    balance = F.nullif(F.col("c_acctbal"), F.lit(73.0))
    return table(spark, sf_dir, "customer").select("c_custkey", amounts.floor_to_step(balance, 50).alias("bucket"))


@query("""select o_orderkey, cast(trunc(coalesce(case when o_orderstatus <> 'P' then o_totalprice end, 0) / 12) as integer) as monthly
from orders""")
def monthly_premium(spark, sf_dir):
    yearly = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select("o_orderkey", amounts.monthly_amount(yearly).alias("monthly"))


@query("""select o_orderkey, cast(cast(round_even(o_totalprice / 1000, 0) as bigint) as varchar) || 'k' as label,
       cast(year(o_orderdate) as varchar) || ' (stock = ' || cast(cast(trunc(o_totalprice) as bigint) as varchar) || ')' as row_label
from orders""")
def compact_label(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.compact_thousands(F.col("o_totalprice")).alias("label"),
        text.stock_label(F.year("o_orderdate"), F.col("o_totalprice")).alias("row_label"),
    )


@query("""select l_orderkey, l_linenumber, case when nullif(l_discount, 0) = 0 then null else
       round(l_tax / nullif(l_discount, 0), 6) end as rate, round_even(l_tax / nullif(l_discount, 0) * 100, 1) as percent
from lineitem""")
def rates(spark, sf_dir):
    tax, discount = F.col("l_tax"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.round(amounts.ratio(tax, discount), 6).alias("rate"),
        amounts.percent(tax, discount).alias("percent"),
    )


THRESHOLDS = (0.95, 0.9, 0.8, 0.65, 0.5, 0.3, 0.2)


@query(f"""select c_custkey, cast(case {' '.join(
    f'when p >= {t} then {10 - i}' for i, t in enumerate(THRESHOLDS))} end as integer) as score
from (select c_custkey, c_acctbal / 10000 as p from customer)""")
def score_ladder(spark, sf_dir):
    probability = F.col("c_acctbal") / 10000
    return table(spark, sf_dir, "customer").select(
        "c_custkey", rules.score_on_ten(probability, THRESHOLDS).alias("score")
    )


@query("""select c_custkey, cast(7 + cast('0x' || substr(md5(cast(c_custkey as varchar)), 1, 8) as bigint) % 4 as integer) as score
from customer""")
def fragility_score(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", rules.placeholder_score(F.col("c_custkey")).alias("score"))


@query("""select coalesce(segment, 'NULL') as segment, coalesce(status, 'NULL') as status, coalesce(price, 0) as price,
       coalesce(orders, 0) as orders, label, id
from (select o_orderkey as id, nullif(o_orderpriority, '5-LOW') as segment, nullif(o_orderstatus, 'P') as status,
             case when o_totalprice > 5000 then o_totalprice end as price, nullif(o_custkey, 5) as orders,
             o_orderstatus as label from orders)""")
def feature_frame(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("segment"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") > 5000, F.col("o_totalprice")).alias("price"),
        F.nullif(F.col("o_custkey"), F.lit(5)).alias("orders"),
        F.col("o_orderstatus").alias("label"),
    )
    return scoring.feature_frame(orders, ["segment", "status"], ["price", "orders"], ["label"], ["id"])


METRICS_SQL = """select %s round(avg((y - p) * (y - p)), 0) as mse, round(sqrt(avg((y - p) * (y - p))), 4) as rmse,
       round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 6) as r2, round(avg(abs(y - p)), 4) as mae,
       round(avg((p - m) * (p - m)), 0) as explained_variance
from (select l_returnflag, l_extendedprice as y, l_quantity * p_retailprice as p,
             avg(l_extendedprice) over (%s) as m from lineitem join part on l_partkey = p_partkey) %s"""


def predictions(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_quantity", "l_extendedprice")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return lines.join(parts, "l_partkey").withColumn("prediction", F.col("l_quantity") * F.col("p_retailprice"))


def rounded_metrics(metrics):
    digits = {"mse": 0, "rmse": 4, "r2": 6, "mae": 4, "explained_variance": 0}
    return metrics.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(METRICS_SQL % ("", "", ""))
def regression_metrics(spark, sf_dir):
    return rounded_metrics(scoring.regression_metrics(predictions(spark, sf_dir), "l_extendedprice"))


@query(METRICS_SQL % ("l_returnflag, ", "partition by l_returnflag", "group by l_returnflag"))
def regression_metrics_by_segment(spark, sf_dir):
    return rounded_metrics(
        scoring.regression_metrics(predictions(spark, sf_dir), "l_extendedprice", by=["l_returnflag"])
    )


@query("""select l_returnflag, round(sqrt(avg(pow(l_extendedprice - l_quantity * p_retailprice, 2))), 4) as rmse
from lineitem join part on l_partkey = p_partkey group by l_returnflag""")
def rmse_by_segment(spark, sf_dir):
    error = scoring.rmse(F.col("l_extendedprice"), F.col("prediction"))
    return predictions(spark, sf_dir).groupBy("l_returnflag").agg(F.round(error, 4).alias("rmse"))


# message inputs from parts
TEXTS = """
select p_partkey,
       case when p_size < 10 then '' when p_size < 30 then p_type else p_type || ', ' || p_brand end as held,
       case when p_type = 'LARGE' then '[]' else '["le client a ' || p_name || '", ''le client part'']' end as reasons,
       case when p_size < 8 then '' when p_size < 20 then 'GAV' when p_size < 30 then 'GAV, SANTEIS'
            when p_size < 40 then 'SERENIVIE, GAV' else 'SANTEIS' end as proposal,
       p_brand as family_status, case when p_type = 'SMALL' then 'Solo' when p_type = 'PROMO' then 'Duo' else 'Famille' end as family_size,
       case when p_type = 'MEDIUM' then 'N' else 'O' end as advisor,
       case when p_size < 25 then 'SATEI-FM03' when p_size < 48 then 'SATEI-FS03' else p_brand end as health,
       case when p_size < 34 then '' when p_size < 37 then 'PRESTIGE' else 'REFERENCE' end as funeral,
       cast(cast(p_size as double) / 2 as double) as price
from {part}
"""


def finding_sql(held: str, reasons: str) -> str:
    return f"""case when coalesce({held}, '') = '' then 'Le client ne détient que de la MRH'
    else 'En plus de la MRH, le client détient également le(s) produit(s) suivant(s) : ' || replace({held}, ',', ' / ') end || '. ' ||
  case when {reasons} = '[]' then 'Le risque de résiliation du client est dans la moyenne'
    else 'Le client est jugé fragile car : ' || replace(replace(regexp_replace({reasons}, '[\\[\\]"'']', '', 'g'), 'le client', 'il'), ',', ' / ')
  end || '.'"""


def offer_sql(proposal, status, size, advisor, health, health_price, funeral, funeral_price) -> str:
    return f"""case when {proposal} = '' then 'Le client n''a a priori pas d''appétence particulière à un produit'
    else 'Le client a le profil type des clients appétents à ' || replace({proposal}, ',', ' / ') end || '. ' ||
  case when {advisor} = 'N' then 'Néanmoins, il n''est rattaché a priori à aucun CC' else
    case when contains({proposal}, 'GAV') then 'Il est conseillé de proposer au client une GAV ' || {size} ||
      ' car sa situation familiale est ' || {status} || ', ' ||
      case {size} when 'Solo' then 'le tarif proposé est: 146.97 EUR pour une IP de 5% / 120.27 EUR pour une IP de 30%. '
        when 'Famille' then 'le tarif proposé est: 267.03 EUR pour une IP de 5% / 213.61 EUR pour une IP de 30%. ' else '' end else '' end ||
    case when contains({proposal}, 'SANTEIS') then 'Il est conseillé de proposer au client un contrat SANTEIS (' ||
      case {health} when 'SATEI-FM03' then 'Formule 3 CLASSIQUE' when 'SATEI-FS03' then 'Formule 3 SENIOR' else coalesce({health}, '') end ||
      '), le tarif proposé est: ' || coalesce(cast({health_price} as varchar), '') || ' EUR. ' else '' end ||
    case when contains({proposal}, 'SERENIVIE') and {funeral} <> '' then
      'Il est conseillé de proposer au client un contrat SERENIVIE (Paiement VIAGER - Formule ' ||
      {funeral} || '), le tarif proposé est environ: ' || coalesce(cast({funeral_price} as varchar), '') || ' EUR. ' else '' end end"""


@query(f"select p_partkey, {finding_sql('held', 'reasons')} as message from ({plain(TEXTS)})")
def message_constat(spark, sf_dir):
    return derived(spark, sf_dir, TEXTS).select(
        "p_partkey", messages.finding(F.col("held"), F.col("reasons")).alias("message")
    )


OFFER_INPUTS = ("proposal", "family_status", "family_size", "advisor", "health", "price", "funeral", "price")


@query(f"select p_partkey, {offer_sql(*OFFER_INPUTS)} as message from ({plain(TEXTS)})")
def message_offer(spark, sf_dir):
    return derived(spark, sf_dir, TEXTS).select(
        "p_partkey", messages.offer(*[F.col(c) for c in OFFER_INPUTS]).alias("message")
    )


@query("""select o_orderkey, 'OF_R2_MRH_Vague ' || cast(year(o_orderdate + interval 1 month) as varchar) || ' - S' ||
       lpad(cast(week(o_orderdate) as varchar), 2, '0') as campaign from orders""")
def campaign_name(spark, sf_dir):
    date = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.campaign_name(date, F.weekofyear(date)).alias("campaign")
    )


@query("""select o_orderkey, strftime(unnest(generate_series(date_trunc('month', o_orderdate),
       date_trunc('month', o_orderdate) + interval 5 month, interval 1 month)), '%Y%m%d') as month_start from orders""")
def month_sequence(spark, sf_dir):
    starts = dates.month_starts(F.col("o_orderdate"), 6)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(starts).alias("month_start"))


@query("""with ends as (
  select 12 + 3 * i as month_id, strftime(last_day(date '2016-12-01' + interval (3 * i) month), '%Y%m%d') as date_ref
  from (select unnest(range(24)) as i))
select month_id, date_ref, n from (select cast(month_id as integer) as month_id, date_ref from ends)
join (select strftime(last_day(o_orderdate + interval 20 year), '%Y%m%d') as ref, count(*) as n from orders group by 1)
  on date_ref = ref""")
def quarter_calendar(spark, sf_dir):
    month_end = F.date_format(F.last_day(F.add_months("o_orderdate", 240)), "yyyyMMdd")
    per_month = table(spark, sf_dir, "orders").groupBy(month_end.alias("date_ref")).agg(F.count(F.lit(1)).alias("n"))
    return per_month.join(F.broadcast(dates.quarter_calendar(spark)), "date_ref")


@query("""with ends as (
  select 12 + 3 * i as month_id, strftime(last_day(date '2016-12-01' + interval (3 * i) month), '%Y%m%d') as ref
  from (select unnest(range(24)) as i))
select o_orderkey, date_ref, coalesce(cast(month_id as varchar), '') as month_id
from (select o_orderkey, strftime(last_day(o_orderdate + interval 20 year), '%Y%m%d') as date_ref from orders)
left join ends on date_ref = ref""")
def month_id_lookup(spark, sf_dir):
    month_end = F.date_format(F.last_day(F.add_months("o_orderdate", 240)), "yyyyMMdd")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", month_end.alias("date_ref"))
    return dates.add_month_id(orders, "date_ref")


# texts that are dates, nearly dates, or not dates
DATE_TEXTS = """
select l_orderkey, l_linenumber,
       case when l_linenumber = 1 then cast(l_partkey as varchar(20)) when l_linenumber = 2 then null
            else cast(year(l_shipdate) as varchar(4)) || lpad(cast(l_quantity as int), 2, '0')
                 || case when l_linenumber > 4 then '30' else '' end end as value
from {lineitem}
""".replace("lpad(cast(l_quantity as int), 2, '0')", "lpad(cast(cast(l_quantity as int) as varchar(9)), 2, '0')")


@query(f"""select l_orderkey, l_linenumber, value,
       coalesce(regexp_full_match(value, '[0-9]{{4}}(1[0-2]|0?[1-9])') and left(value, 4) <> '0000', false) as is_month,
       coalesce(length(value) = 8 and try_strptime(value, '%Y%m%d') is not null, false) as is_day
from ({plain(DATE_TEXTS)})""")
def valid_dates(spark, sf_dir):
    value = F.col("value")
    return derived(spark, sf_dir, DATE_TEXTS).select(
        "l_orderkey", "l_linenumber", "value",
        dates.is_month_text(value).alias("is_month"),
        dates.is_day_text(value).alias("is_day"),
    )


@query("""select o_orderkey, cast(last_day(o_orderdate - interval 1 month) as date) as previous_end,
       strftime(o_orderdate, '%b') as month_name, strftime(o_orderdate - interval 1 year, '%Y%m') as year_ago from orders""")
def date_parts(spark, sf_dir):
    date = F.col("o_orderdate")
    month = dates.month_key(date)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.last_day(F.add_months(date, -1)).alias("previous_end"),
        dates.month_name(month).alias("month_name"),
        (month.cast("int") - 100).cast("string").alias("year_ago"),
    )
