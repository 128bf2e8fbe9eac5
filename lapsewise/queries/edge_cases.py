"""Missing, open, repeated and numeric inputs, which the driver tables do not hold by themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsewise import fixed_values as fv
from lapsewise.functions import dates, rules
from lapsewise.operators import joins, lookups, selection, snapshots
from lapsewise.queries.base import derived, query, table
from lapsewise.queries.drawing import MARKED_SQL, _marked
from lapsewise.queries.joining import PRODUCTS, plain

QUOTA = 110


@query("""with o as (select nullif(o_custkey % 50, 7) as client, o_orderkey, o_totalprice from orders)
select client, o_orderkey, o_totalprice from o
qualify client is null or row_number() over (partition by client order by o_totalprice desc, o_orderkey) = 1""")
def first_per_client_or_none(spark, sf_dir):
    client = F.nullif(F.col("o_custkey") % 50, F.lit(7)).alias("client")
    orders = table(spark, sf_dir, "orders").select(client, "o_orderkey", "o_totalprice")
    return snapshots.first_per_key(orders, ["client"], [F.col("o_totalprice").desc(), "o_orderkey"])


@query("""select c_custkey, case when code = 3 then 'AM' else 'STEA' end as regime, case when code = 3 then 'F' else 'NF' end as legal_frame
from (select c_custkey, cast(nullif(c_nationkey, 5) as double) as code from customer)""")
def recode_numbers(spark, sf_dir):
    code = F.nullif(F.col("c_nationkey"), F.lit(5)).cast("double")
    customers = table(spark, sf_dir, "customer")
    return customers.select("c_custkey", rules.regime(code).alias("regime"), rules.legal_frame(code).alias("legal_frame"))


@query("""with f as (select p_partkey, nullif(p_size % 3, 2) as a, nullif(p_size % 2, 0) - 1 + p_size % 2 as b, nullif(p_size % 5, 4) % 2 as c from part)
select p_partkey, a, b, c, case when (a > 0 and b = 0 and c = 0) or (a = 0 and b > 0 and c = 0) or (a = 0 and b = 0 and c > 0)
  then 1 else 0 end as single from f""")
def single_family_or_unknown(spark, sf_dir):
    size = F.col("p_size")
    families = {
        "a": F.nullif(size % 3, F.lit(2)), "b": F.nullif(size % 2, F.lit(0)) - 1 + size % 2, "c": F.nullif(size % 5, F.lit(4)) % 2
    }
    parts = table(spark, sf_dir, "part").select("p_partkey", *[c.alias(n) for n, c in families.items()])
    return parts.withColumn("single", rules.single_family(F.col("a"), F.col("b"), F.col("c")))


@query("""with grid(low, high, formula, price) as (values (null, 9, 'A', 1.0::double), (10, 29, 'B', 2.0), (30, null, 'C', 3.0))
select p_partkey, age, formula, price from (select p_partkey, nullif(p_size, 13) * 1.5::double as age from part)
left join grid on floor(age) >= coalesce(low, 0) and floor(age) <= coalesce(high, 150)""")
def tariff_open_bands(spark, sf_dir):
    bands = [(None, 9, "A", 1.0), (10, 29, "B", 2.0), (30, None, "C", 3.0)]
    grid = spark.createDataFrame(bands, "age_min int, age_max int, formula string, price double")
    age = (F.nullif(F.col("p_size"), F.lit(13)) * 1.5).alias("age")
    return lookups.add_price(table(spark, sf_dir, "part").select("p_partkey", age), grid, "age")


@query("""with grid(department, low, high, formula, price) as (values
  (0, null, 17, 'A', 1.0::double), (0, 18, 60, 'B', 2.0), (0, 61, null, 'C', 3.0), (1, 100, 220, 'D', 4.0), (1, 200, null, 'E', 5.0))
select p_partkey, age, dep, formula, price from (select p_partkey, p_size * 6 - 20 as age, cast(p_partkey % 3 as integer) as dep from part)
left join grid on dep = department and age >= coalesce(low, -1000) and age <= coalesce(high, 1000)""")
def tariff_any_age(spark, sf_dir):
    """Ages below 0 and far beyond a life: open bands have no end; two bands overlap."""
    bands = [(0, None, 17, "A", 1.0), (0, 18, 60, "B", 2.0), (0, 61, None, "C", 3.0), (1, 100, 220, "D", 4.0), (1, 200, None, "E", 5.0)]
    grid = spark.createDataFrame(bands, "department int, age_min int, age_max int, formula string, price double")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_size") * 6 - 20).alias("age"), (F.col("p_partkey") % 3).cast("int").alias("dep")
    )
    return lookups.add_price(parts, grid, "age", "dep")


@query("""with d as (select o_orderkey, strftime(last_day(o_orderdate) + interval 30 year, '%Y%m%d') as ref,
  last_day(o_orderdate) + interval 30 year as day from orders)
select o_orderkey, ref as date_ref, case when month(day) % 3 = 0 and day = last_day(day)
  then cast((year(day) - 2016) * 12 + month(day) as varchar) else '' end as month_id from d""")
def month_id_of_later_years(spark, sf_dir):
    later = F.add_months(F.last_day("o_orderdate"), 360)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(later, "yyyyMMdd").alias("date_ref"))
    return dates.add_month_id(orders)


@query("""with r as (select s_nationkey % 7 as mail, s_suppkey, s_acctbal from supplier where s_acctbal > 0),
one as (select case when mail = 4 then ' ' else 'N' || mail end as email, min((s_suppkey, s_acctbal)) as row from r group by mail)
select l.s_suppkey as id, upper(coalesce(l.mail, '')) as mail, case when one.row is not null then email end as email,
  row[1] as s_suppkey, row[2] as s_acctbal
from (select s_suppkey, case when s_nationkey <> 3 then case when s_nationkey % 7 = 4 then ' ' else 'n' || s_nationkey % 7 end end as mail
  from supplier) l left join one on upper(l.mail) = one.email and trim(one.email) <> ''""")
def email_enrich_repeats(spark, sf_dir):
    suppliers, seventh = table(spark, sf_dir, "supplier"), F.col("s_nationkey") % 7
    mail = F.when(seventh == 4, " ").otherwise(F.concat(F.lit("n"), seventh.cast("string")))
    left = suppliers.select(F.col("s_suppkey").alias("id"), F.when(F.col("s_nationkey") != 3, mail).alias("mail"))
    right = suppliers.where("s_acctbal > 0").select(F.upper(mail).alias("email"), "s_suppkey", "s_acctbal")
    return joins.add_by_upper_key(left, "mail", right, "email", repeats="first")


@query(f"""with {MARKED_SQL},
rows as (
  select *, case when mois_anniversaire = (3 + 4) % 12 + 1 then 1 when mois_anniversaire = 1 then 2 end as bucket
  from marked where score_fragilite >= 7 and anciennete_contrat_mois > 6
    and (nb_mois_depuis_resiliation is null or nb_mois_depuis_resiliation < -1)
    and ((actions_123 > 0 and Presence_CC = 'O') or actions_67 > 0))
select identifiant, bucket, score_model from rows where bucket is not null
order by bucket, score_model desc, identifiant limit {QUOTA}""")
def quota_two_buckets(spark, sf_dir):
    drawn = selection.quota_waterfall(_marked(spark, sf_dir), QUOTA, F.lit(3))
    return drawn.select("identifiant", "bucket", "score_model")


SCOPE_ROWS = """
select p_partkey, case when p_size % 3 = 0 then 'SANTéIS FORMULE 3S' when p_size % 3 = 1 then 'FORMULE 5S' end as lbproduit_cv,
       case when p_size % 2 = 0 then 'SANTEIS BASE' when p_size % 4 = 1 then 'OTHER' end as lib_produit,
       case when p_type = 'PROMO' then 'A246' when p_type = 'LARGE' then 'A241' end as rlpcodc,
       case when p_size > 40 then '460' end as cdprodcdgauer
from {part}
"""
SENIOR, CLASSIC, SINGLE, SELF, PRIVATE, OTHER = fv.SCOPES


@query(f"""with r as ({plain(SCOPE_ROWS)}), l as (
  select *, lbproduit_cv like '%{fv.LINE_PATTERN_COLLECTOR}%' or lib_produit like '%{fv.LINE_PATTERN_BASE}%' as line,
         lbproduit_cv like '%FORMULE 3S%' or lbproduit_cv like '%FORMULE 5S%' as old from r), s as (
  select *, case when line and old then 1 else 0 end as {SENIOR},
         case when line and not coalesce(line and old, false) then 1 else 0 end as {CLASSIC},
         case when rlpcodc = '{fv.SELF_EMPLOYED_REF}' then 1 else 0 end as {SELF},
         case when rlpcodc = '{fv.PRIVATE_REF}' then 1 else 0 end as {PRIVATE},
         case when cdprodcdgauer = '{fv.SINGLE_PRODUCT_CODE}' then 1 else 0 end as {SINGLE} from l)
select p_partkey, {SENIOR}, {CLASSIC}, {SELF}, {PRIVATE}, {SINGLE},
       case when {SENIOR} + {CLASSIC} + {SELF} + {PRIVATE} + {SINGLE} = 0 then 1 else 0 end as {OTHER} from s""")
def health_scopes(spark, sf_dir):
    scoped = rules.add_health_scopes(derived(spark, sf_dir, SCOPE_ROWS))
    return scoped.select("p_partkey", *fv.SCOPES)


LADDER_CODES = ", ".join(f"'{row[0]}'" for row in fv.PRODUCT_LADDER)


@query(f"""with s as (select product, p_partkey % 40 - 5.0::double as actual, p_partkey % 90 - 3.0::double as simulated from ({plain(PRODUCTS)}))
select product, actual, simulated, case when product in ({LADDER_CODES}) and
    ((actual > 0 and 100 * (abs(actual - simulated) / actual) > 10 and abs(actual - simulated) > 5) or (actual <= 0 and simulated >= 1))
  then 1 else 0 end as atypical from s""")
def sim_known_formula(spark, sf_dir):
    key = F.col("p_partkey")
    products = derived(spark, sf_dir, PRODUCTS).select(
        "product", (key % 40).cast("double").alias("a"), (key % 90).cast("double").alias("s")
    ).select("product", (F.col("a") - 5.0).alias("actual"), (F.col("s") - 3.0).alias("simulated"))
    known = lookups.known_formula(F.col("product"))
    return products.withColumn("atypical", rules.atypical_simulation(known, F.col("actual"), F.col("simulated")))
