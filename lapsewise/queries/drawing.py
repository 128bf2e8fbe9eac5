"""Draws: waves, control groups, quotas, ties and funnels."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsewise.operators import quality, selection
from lapsewise.queries.base import plain, query, table
from lapsewise.queries.stand_ins import CANDIDATES, HIERARCHY, candidates, hierarchy
from lapsewise.operators import joins

CONTACTS, CONTROLS, QUOTA = 300, 40, 100


def _marked(spark, sf_dir):
    """Candidates with the columns a draw needs."""
    level = hierarchy(spark, sf_dir).where("niveau_ptf = 5")
    rows = joins.mark_text(
        candidates(spark, sf_dir), "identifiantintermediaire", level, "Id_Intermediaire", "Presence_CC", "O", "N"
    )
    buyers = table(spark, sf_dir, "events").where("event_type = 'purchase' and value > 50").select(
        F.col("user_id").cast("string").alias("user_id")
    )
    rows = joins.mark_text(rows, "identifiantrce", buyers, "user_id", "Contact", "DONE", "-")
    return rows.withColumns(
        {
            "age_assure": F.coalesce(F.col("agepersphysique"), F.lit(0)).cast("int"),
            "score_fragilite": (F.col("mois_anniversaire") % 4 + 6).cast("int"),
        }
    )


MARKED_SQL = f"""candidates as ({plain(CANDIDATES)}), levels as ({plain(HIERARCHY)}),
marked as (
  select *, case when identifiantintermediaire in (select Id_Intermediaire from levels where niveau_ptf = 5) then 'O' else 'N' end
           as Presence_CC,
         case when identifiantrce in (select cast(user_id as varchar) from events where event_type = 'purchase' and value > 50)
           then 'DONE' else '-' end as Contact,
         cast(coalesce(agepersphysique, 0) as integer) as age_assure,
         cast(mois_anniversaire % 4 + 6 as integer) as score_fragilite
  from candidates)"""
TARGETS_SQL = ("('GAV', 'GAV, SANTEIS', 'SANTEIS', 'SERENIVIE', 'SERENIVIE, GAV', 'SERENIVIE, GAV, SANTEIS', "
               "'SERENIVIE, SANTEIS')")
ELIGIBLE_SQL = f"Contact = '-' and Presence_CC = 'O' and proposition in {TARGETS_SQL} and age_assure <= 80"
WAVE_SQL = f"""{MARKED_SQL},
drawn as (select * from marked where {ELIGIBLE_SQL} order by score_model desc, identifiant limit {CONTACTS + CONTROLS})"""


@query(f"""with {WAVE_SQL}
select identifiant, identifiantrce, score_model,
       row_number() over (order by md5('1:' || identifiant), identifiant) <= {CONTROLS} as temoin
from drawn""")
def wave_selection(spark, sf_dir):
    wave = selection.wave(
        _marked(spark, sf_dir), [("score_model", "desc")], contacts=CONTACTS, controls=CONTROLS
    )
    return wave.select("identifiant", "identifiantrce", "score_model", "temoin")


@query(f"""with {MARKED_SQL}
select identifiant, identifiant in (select identifiant from marked where score_model > 9000) as temoin
from marked where identifiant in (select identifiant from marked where score_model > 5000)""")
def rerun_draw(spark, sf_dir):
    rows = _marked(spark, sf_dir)
    former = rows.where("score_model > 5000").select(
        F.col("identifiant").alias("id_contrat"), (F.col("score_model") > 9000).alias("temoin")
    )
    return selection.draw_or_reuse(rows, former, []).select("identifiant", "temoin")


@query("""select o_orderkey, o_custkey, o_custkey in (
  select o_custkey from (select distinct o_custkey from orders) order by md5('7:' || cast(o_custkey as varchar)), o_custkey limit 100)
  as control from orders""")
def control_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return selection.control_group(orders, "o_custkey", 100, seed=7, out="control")


WATERFALL_SQL = f"""{MARKED_SQL},
rows as (
  select *, case when mois_anniversaire = (8 + 4) % 12 + 1 then 1 when mois_anniversaire = 1 then 2 end as bucket
  from marked where score_fragilite >= 7 and anciennete_contrat_mois > 6
    and (nb_mois_depuis_resiliation is null or nb_mois_depuis_resiliation < -1)
    and ((actions_123 > 0 and Presence_CC = 'O') or actions_67 > 0))"""


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 2000")
def top_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return selection.top_n(orders, 2000, [("o_totalprice", "desc"), ("o_orderkey", "asc")])


@query(f"""with {WATERFALL_SQL} select identifiant, bucket, score_model from rows where bucket is not null
order by bucket, score_model desc, identifiant limit {QUOTA}""")
def quota_waterfall(spark, sf_dir):
    drawn = selection.quota_waterfall(_marked(spark, sf_dir), QUOTA, F.lit(8))
    return drawn.select("identifiant", "bucket", "score_model")


@query(f"""with {WATERFALL_SQL} select identifiant, bucket, score from (
  select *, floor(score_model / 500) as score from rows where bucket is not null)
qualify rank() over (order by bucket, score desc) <= {QUOTA // 2}""")
def quota_waterfall_ties(spark, sf_dir):
    rows = _marked(spark, sf_dir).withColumn("score", F.floor(F.col("score_model") / 500).cast("double"))
    drawn = selection.quota_waterfall(rows, QUOTA // 2, F.lit(8), score="score", ties=True)
    return drawn.select("identifiant", "bucket", "score")


@query("""select o_orderkey, o_orderpriority, hundreds from (
  select o_orderkey, o_orderpriority, cast(floor(o_totalprice / 100) as bigint) as hundreds from orders)
qualify rank() over (partition by o_orderpriority order by hundreds desc) <= 50""")
def topk_with_ties(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.floor(F.col("o_totalprice") / 100).alias("hundreds")
    )
    return selection.top_with_ties(orders, 50, [("hundreds", "desc")], by=["o_orderpriority"])


@query("""select o_orderkey, hundreds from (
  select o_orderkey, cast(floor(o_totalprice / 100) as bigint) as hundreds from orders)
qualify rank() over (order by hundreds desc) <= 500""")
def topk_with_ties_overall(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 100).alias("hundreds"))
    return selection.top_with_ties(orders, 500, [("hundreds", "desc")])


FUNNEL_STEPS = ("start", "not contacted", "advisor present", "target proposal", "age limit")


@query(f"""with {MARKED_SQL}, c as (
  select count(*) as c0, count(*) filter (Contact = '-') as c1, count(*) filter (Contact = '-' and Presence_CC = 'O') as c2,
         count(*) filter (Contact = '-' and Presence_CC = 'O' and proposition in {TARGETS_SQL}) as c3,
         count(*) filter ({ELIGIBLE_SQL}) as c4 from marked)
{' union all '.join(f"select {i} as step_no, '{s}' as step, c{i} as rows from c" for i, s in enumerate(FUNNEL_STEPS))}""")
def funnel(spark, sf_dir):
    return quality.funnel(_marked(spark, sf_dir), selection.wave_steps())


@query("""select o_custkey, o_orderdate, count(*) as rows from orders group by o_custkey, o_orderdate having count(*) > 1""")
def repeated_keys(spark, sf_dir):
    return quality.repeated_keys(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])
