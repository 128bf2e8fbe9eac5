"""Whole jobs: portfolio load, churn report, campaign lists, run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lapsewise import fixed_values as fv
from lapsewise.functions.dates import check_day
from lapsewise.operators import scoring
from lapsewise.operators.snapshots import union_all
from lapsewise.plans import campaign, churn, contacts, portfolio
from lapsewise.queries.base import derived, plain, query, table
from lapsewise.queries.drawing import TARGETS_SQL
from lapsewise.queries.joining import PREFIX_SQL
from lapsewise.queries.rule_sets import METRICS_SQL, finding_sql, offer_sql, predictions, rounded_metrics
from lapsewise.queries.stand_ins import (
    ADVISORS, CANDIDATES, EXPANDED_SQL, FIRST, FLAGS, FUNERAL_GRID, HEALTH_GRID, HIERARCHY, LAST, LISTS, MONTHLY_SQL, advisors,
    candidates, flagged, funeral_grid, health_grid, hierarchy, lists, wide_exit_sql, wide_stock_sql,
)
from lapsewise.sources import files, manifest, sinks, workspace

PARTITION = "199909"
# contract lines as the portfolio's five tables
BASE = """
select '199909' as dt_partition,
       case c_mktsegment when 'BUILDING' then 'AGENT' when 'MACHINERY' then 'COURTIER' when 'FURNITURE' then 'SALARIE GPROX'
            else 'AUTRE' end as libreseaucalcule,
       case when l_quantity > 5 then 'SANTE INDIVIDUELLE' else 'AUTO' end as famille_cible,
       case when l_linenumber < 7 then 1 else 0 end as top_client,
       case when l_linenumber = 1 then null else l_linenumber end as indicateurgpma,
       cast(l_orderkey as varchar(20)) as identifiant,
       case when o_orderstatus = 'F' then '07' when o_orderstatus = 'O' then '59' else '99' end as societedugroupe,
       l_returnflag as systemeorigine,
       case when l_tax > 0.02 then o_orderdate end as periodevaliditectrstartdate,
       case when l_shipdate >= o_orderdate then l_shipdate end as periodevaliditectrenddate,
       c_custkey as uidpersgen, p_type as cdprodcdgauer, p_name as lib_produit, p_size as agepersphysique
from {lineitem} join {orders} on l_orderkey = o_orderkey join {customer} on o_custkey = c_custkey
     join {part} on l_partkey = p_partkey
"""
VALIDITY = """
select '199909' as dt_partition, '07' as cd_cie, lpad(cast(o_orderkey as varchar(20)), 11, '0') as num_ctrt, 'A' as cd_appli,
       o_orderdate as dt_deb_valdt_ctrt from {orders} where o_orderstatus = 'F'
"""
REFERENCE = """
select distinct '199909' as dt_partition, '07' as ciecodc, p_type as catcodc,
       case when p_type = 'PROMO' then 'A246' when p_type = 'LARGE' then 'A241' else 'A000' end as rlpcodc, p_type as rlplibl
from {part}
"""
COLLECTOR = """
select '199909' as dt_partition, cast(l_orderkey as varchar(20)) as nucontra, l_linenumber as cdlotimport,
       l_returnflag as cdcompagnie, l_linestatus as cdappli, p_type as cdproduit, '07' as cdciegen
from {lineitem} join {part} on l_partkey = p_partkey
"""
COLLECTOR_PRODUCTS = """
select distinct '199909' as dt_partition, l_returnflag as cdcompagnie, l_linestatus as cdappli, p_type as cdproduit,
       p_type as lbproduit, lower(p_type) as lbcommercial, case when p_type = 'SMALL' then 'C' else 'I' end as cdcollindiv
from {lineitem} join {part} on l_partkey = p_partkey
"""
COLLECTOR_COLUMNS = ("cdcompagnie", "cdappli", "cdproduit", "nucontra", "cdciegen")


PORTFOLIO_SQL = f"""base as ({plain(BASE)}), validity as ({plain(VALIDITY)}), reference as ({plain(REFERENCE)}),
collector as ({plain(COLLECTOR)}), products as ({plain(COLLECTOR_PRODUCTS)}),
ctr as (
  select *, case when societedugroupe in ('07', '59', '01', '81', '76', '57') then lpad(identifiant, 11, '0') else identifiant end
    as polcodc
  from base where dt_partition = '199909' and libreseaucalcule in ('AGENT', 'COURTIER', 'SALARIE GPROX')
    and famille_cible = 'SANTE INDIVIDUELLE' and top_client = 1 and (indicateurgpma <> 2 or indicateurgpma is null)),
dated as (
  select c.*, coalesce(periodevaliditectrstartdate, dt_deb_valdt_ctrt) as date_effet
  from ctr c left join validity v on societedugroupe = cd_cie and polcodc = num_ctrt and systemeorigine = cd_appli),
latest as (select * from collector qualify cdlotimport = max(cdlotimport) over (partition by nucontra)),
cv as (
  select distinct l.nucontra, l.cdciegen, l.cdcompagnie, l.cdappli, l.cdproduit, p.lbproduit, p.lbcommercial
  from latest l join products p using (cdcompagnie, cdappli, cdproduit) where cdcollindiv = 'I'),
portfolio as (
select polcodc, uidpersgen, famille_cible, identifiant, date_effet, periodevaliditectrenddate as date_resil, societedugroupe,
       systemeorigine, strftime(date_effet, '%Y%m') as mois_entree, strftime(periodevaliditectrenddate, '%Y%m') as mois_sortie,
       cast(year(periodevaliditectrenddate) as integer) as annee_sortie, libreseaucalcule,
       cast(year(date_effet) as integer) as year, cdprodcdgauer, lib_produit, dated.dt_partition, agepersphysique as age,
       identifiant || '_' || societedugroupe || '_' || systemeorigine as idCtr, rlpcodc, rlplibl,
       cv.cdproduit as cdproduit_cv, cv.lbproduit as lbproduit_cv, cv.lbcommercial as lbcommercial_cv
from dated left join reference on societedugroupe = ciecodc and cdprodcdgauer = catcodc
     left join cv on identifiant = nucontra and societedugroupe = cdciegen)"""


@query(f"with {PORTFOLIO_SQL} select * from portfolio")
def portfolio_load(spark, sf_dir):
    base, validity, reference, collector, products = (
        derived(spark, sf_dir, t) for t in (BASE, VALIDITY, REFERENCE, COLLECTOR, COLLECTOR_PRODUCTS)
    )
    return portfolio.load_portfolio(
        base, validity, reference, collector, products, PARTITION, carried=(), collector_columns=COLLECTOR_COLUMNS
    )


HEALTH_FLAGS_SQL = f"""
  case when line and regexp_matches(lbproduit_cv, '{fv.SENIOR_PATTERN}') then 1 else 0 end as {fv.SCOPES[0]},
  case when line and not coalesce(regexp_matches(lbproduit_cv, '{fv.SENIOR_PATTERN}'), false) then 1 else 0 end as {fv.SCOPES[1]},
  case when rlpcodc = '{fv.SELF_EMPLOYED_REF}' then 1 else 0 end as {fv.SCOPES[3]},
  case when rlpcodc = '{fv.PRIVATE_REF}' then 1 else 0 end as {fv.SCOPES[4]},
  case when cdprodcdgauer = '{fv.SINGLE_PRODUCT_CODE}' then 1 else 0 end as {fv.SCOPES[2]},
  case when line or rlpcodc in ('{fv.SELF_EMPLOYED_REF}', '{fv.PRIVATE_REF}') or cdprodcdgauer = '{fv.SINGLE_PRODUCT_CODE}'
    then 0 else 1 end as {fv.SCOPES[5]}"""


def _report_sql(name: str, period: str, measures: str) -> str:
    return f"select '{name}' as report, {period} as period, network, {measures} from monthly group by {period}, network"


REPORT_SQL = f"with {MONTHLY_SQL} " + " union all ".join(
    (
        _report_sql("STOCK", "month", wide_stock_sql()),
        _report_sql("RESIL ANNEE", "year", wide_exit_sql("year")),
        _report_sql("RESIL MOIS", "month", wide_exit_sql("month")),
    )
)


@query(REPORT_SQL)
def churn_report(spark, sf_dir):
    return churn.report_table(churn.churn_report(flagged(spark, sf_dir), FIRST, LAST, FLAGS))


@query(REPORT_SQL)
def churn_report_files(spark, sf_dir):
    path = workspace.new_path(spark, "churn")
    churn.write_churn_report(flagged(spark, sf_dir), FIRST, LAST, FLAGS, path)
    names = (churn.STOCK, churn.BY_YEAR, churn.BY_MONTH)
    return churn.report_table({name: files.read_frame(spark, f"{path}/report={name}") for name in names})


EXTRACTION, WEEK, CONTACTS, CONTROLS = "19990930", "7", 200, 40


def _campaign_inputs(spark, sf_dir):
    """Candidates, hierarchy, advisors, contact history and both price grids."""
    people = candidates(spark, sf_dir).withColumn("score_fragilite", F.col("score_model"))
    recent = files.recent_contacts(lists(spark, sf_dir), check_day(EXTRACTION))
    return (
        people, hierarchy(spark, sf_dir), advisors(spark, sf_dir).drop("nation"), recent, health_grid(spark, sf_dir),
        funeral_grid(spark, sf_dir),
    )


def _campaign(spark, sf_dir, **options):
    inputs = _campaign_inputs(spark, sf_dir)
    return campaign.campaign(*inputs, EXTRACTION, WEEK, contacts=CONTACTS, controls=CONTROLS, **options)


CAMPAIGN_SQL = f"""candidates as ({plain(CANDIDATES)}), advisors as ({plain(ADVISORS)}), levels as ({plain(HIERARCHY)}),
lists as ({plain(LISTS)}), health as ({plain(HEALTH_GRID)}), funeral as ({plain(FUNERAL_GRID)}),
recent as (select distinct cast(NOGPA as bigint) as id from lists
           where month_end between last_day(date '1999-09-30' - interval 8 month) and date '1999-09-30'),
dial as (select * from (values {PREFIX_SQL}) t(number, prefix)),
rows as (
  select c.*, case when identifiantintermediaire in (select Id_Intermediaire from levels where niveau_ptf = 5)
                then 'O' else 'N' end as Presence_CC,
         a.cc_nom, a.cc_prenom, score_model as score_fragilite,
         coalesce('0' || cast(cast(telmobile as bigint) as varchar), '0' || cast(cast(telfixe as bigint) as varchar), '') as telephone,
         coalesce(prefix, '-') as indicatif,
         case when cast(identifiantrce as bigint) in (select id from recent) then 'DONE' else '-' end as Contact,
         cast(agepersphysique as integer) as age_assure
  from candidates c left join advisors a on upper(coalesce(intmail, '')) = email
       left join dial on codedepartement = number),
reachable as (select * from rows where telephone <> '' and agepersphysique >= 18),
one_each as (
  select * from reachable qualify row_number() over (partition by identifiantrce
    order by case when proposition in {TARGETS_SQL} and Presence_CC = 'O' then 0 else 1 end, score_fragilite desc, identifiant) = 1),
drawn as (
  select * from one_each where Contact = '-' and Presence_CC = 'O' and proposition in {TARGETS_SQL} and age_assure <= 80
  order by score_fragilite desc, identifiant limit {CONTACTS + CONTROLS}),
work as (
  select d.*, row_number() over (order by md5('1:' || identifiant), identifiant) <= {CONTROLS} as temoin,
         h.formula as health_formula, h.price as health_price, f.formula as funeral_formula, f.price as funeral_price
  from drawn d left join health h on codedepartement = department and age_assure between h.age_min and h.age_max
       left join funeral f on age_assure between f.age_min and f.age_max)"""


@query(f"""with {CAMPAIGN_SQL}
select identifiant as id_contrat, lpad(identifiantrce, 8, '0') as identifiantrce, temoin, telephone, indicatif, age_assure, cc_nom,
       cast(trunc(coalesce(montantannuelttcvalestime, 0) / 12) as integer) as prime_mensuelle,
       health_formula as proposition_formule_santeis, health_price as proposition_tarif_santeis,
       funeral_formula as proposition_formule_serenivie, funeral_price as proposition_tarif_serenivie,
       'OF_R2_MRH_Vague 1999 - S07' as campagne
from work""")
def campaign_list(spark, sf_dir):
    return _campaign(spark, sf_dir).select(
        "id_contrat", "identifiantrce", "temoin", "telephone", "indicatif", "age_assure", "cc_nom", "prime_mensuelle",
        "proposition_formule_santeis", "proposition_tarif_santeis", "proposition_formule_serenivie",
        "proposition_tarif_serenivie", "campagne",
    )


@query(f"""with {CAMPAIGN_SQL}
select lpad(identifiantrce, 8, '0') as NOGPA, score_fragilite as note_fragilite, temoin from work""")
def contact_list(spark, sf_dir):
    work = workspace.stored(_campaign(spark, sf_dir), "work")
    lists_of = [campaign.contact_list(work, c).withColumn("temoin", F.lit(c)) for c in (False, True)]
    return lists_of[0].unionByName(lists_of[1])


OFFER_INPUTS = (
    "proposition", "libsituationfamiliale", "SITFAM_2", "Presence_CC", "health_formula", "health_price",
    "funeral_formula", "funeral_price",
)


@query(f"""with {CAMPAIGN_SQL}
select lpad(identifiantrce, 8, '0') as identifiantrce, nompersonne as nom, prenom, 'OF_R2_MRH_Vague 1999 - S07' as campagne,
       age_assure, libcsp, telephone, nomrue, localite, lib_produit as formule,
       cast(trunc(coalesce(montantannuelttcvalestime, 0) / 12) as integer) as prime, 0 as rac,
       {finding_sql('autres_produits_detenus', 'raisons_fragilite')} as message1, {offer_sql(*OFFER_INPUTS)} as message2,
       identifiant as id_contrat, ' - ' as type_contrat, cc_nom, cc_prenom, indicatif
from work where not temoin""")
def app_export(spark, sf_dir):
    return campaign.app_export(_campaign(spark, sf_dir))


def _read(spark, root, name):
    return manifest.read_output(spark, root, EXTRACTION, name)


@query(f"""with {CAMPAIGN_SQL}, keyed as (select *, lpad(identifiantrce, 8, '0') as person from work)
select 'work' as output, person, identifiant as contract, score_fragilite as score from keyed
union all select case when temoin then 'control' else 'contact' end, person, null, score_fragilite from keyed
union all select 'app', person, identifiant, null from keyed where not temoin""")
def campaign_files(spark, sf_dir):
    root = workspace.new_path(spark, "campaign")
    campaign.write_campaign(*_campaign_inputs(spark, sf_dir), EXTRACTION, WEEK, root, contacts=CONTACTS, controls=CONTROLS)
    columns = {
        "work": ("identifiantrce", "id_contrat", "score_fragilite"), "contact": ("NOGPA", None, "note_fragilite"),
        "control": ("NOGPA", None, "note_fragilite"), "app": ("identifiantrce", "id_contrat", None),
    }
    parts = [
        _read(spark, root, name).select(
            F.lit(name).alias("output"), F.col(person).alias("person"),
            (F.col(contract) if contract else F.lit(None).cast("string")).alias("contract"),
            (F.col(score) if score else F.lit(None).cast("double")).alias("score"),
        )
        for name, (person, contract, score) in columns.items()
    ]
    return union_all(spark, parts, parts[0].schema)


@query(f"""with {CAMPAIGN_SQL} select identifiant as id_contrat, temoin from work""")
def campaign_rerun_files(spark, sf_dir):
    """The second run finds the list of its date, though all its people are in the contact history by then."""
    root = workspace.new_path(spark, "campaign")
    people, levels, named, recent, *grids = _campaign_inputs(spark, sf_dir)
    first = campaign.write_campaign(people, levels, named, recent, *grids, EXTRACTION, WEEK, root, contacts=CONTACTS, controls=CONTROLS)
    told = _read(spark, root, "work").select("identifiantrce", F.lit(7).alias("note_fragilite"))
    again = campaign.write_campaign(people, levels, named, recent.unionByName(told), *grids, EXTRACTION, WEEK, root, contacts=1, controls=1)
    assert first["run"] != again["run"]
    return _read(spark, root, "work").select("id_contrat", "temoin")


FUNNEL = (
    ("candidates", "true"), ("phone", "telephone <> ''"), ("adult", "agepersphysique >= 18"), ("not contacted", "Contact = '-'"),
    ("advisor present", "Presence_CC = 'O'"), ("target proposal", f"proposition in {TARGETS_SQL}"), ("age limit", "age_assure <= 80"),
)
FUNNEL_SQL = " union all ".join(
    f"select {i} as step_no, '{name}' as step, count(*) as rows, count(distinct identifiantrce) as ids from rows where "
    + " and ".join(condition for _, condition in FUNNEL[: i + 1])
    for i, (name, _) in enumerate(FUNNEL)
)


@query(f"with {CAMPAIGN_SQL} {FUNNEL_SQL}")
def campaign_funnel(spark, sf_dir):
    root = workspace.new_path(spark, "campaign")
    campaign.write_campaign(*_campaign_inputs(spark, sf_dir), EXTRACTION, WEEK, root, contacts=CONTACTS, controls=CONTROLS)
    return _read(spark, root, "funnel")


LOST_MONTH, BROKEN = "1999-05-31", "1999-08-31"
HISTORY_SQL = f"""lists as ({plain(LISTS)}),
kept as (select NOGPA, note_fragilite, month_end from lists
         where month_end between last_day(date '1999-09-30' - interval 8 month) and date '1999-09-30' and month_end <> '{LOST_MONTH}'
         union all select '00000001', null, date '{BROKEN}')"""


def _stored_lists(spark, sf_dir):
    """Contact lists as files: one month was never written, and one file has a line that is no score."""
    path = workspace.new_path(spark, "lists")
    kept = lists(spark, sf_dir).where(f"month_end <> '{LOST_MONTH}' and month_end >= '1998-11-30'")
    kept.write.option("header", True).partitionBy("campaign", "role", "month_end").csv(path)
    broken = spark.createDataFrame([("NOGPA,note_fragilite",), ("00000001,no score",)], "line string").coalesce(1)
    broken.write.text(f"{path}/campaign=X/role=contact/month_end={BROKEN}")
    return path


@query(f"with {HISTORY_SQL} select NOGPA as identifiantrce, cast(note_fragilite as integer) as note_fragilite from kept")
def contact_history_files(spark, sf_dir):
    path = workspace.new_path(spark, "history")
    contacts.write_rolling_history(spark, _stored_lists(spark, sf_dir), EXTRACTION, path)
    return files.read_delimited(spark, path, files.HISTORY_SCHEMA)


@query(f"""with {HISTORY_SQL},
ends as (select cast(last_day(d) as date) as month_end from (select unnest(generate_series(date '1999-01-01', date '1999-09-01', interval 1 month)) as d))
select e.month_end, case when count(k.month_end) > 0 then 'present' else 'missing' end as state, count(k.month_end) as rows,
       count(*) filter (k.month_end is not null and note_fragilite is null) as malformed
from ends e left join kept k using (month_end) group by e.month_end""")
def contact_history_months(spark, sf_dir):
    return files.rolling_contacts(spark, _stored_lists(spark, sf_dir), EXTRACTION)[1].drop("files")


@query("""select 'no active contract' as problem, 'nothing' as written, count(*) as contracts from orders where o_orderdate < date '1990-01-01'
union all select null, 'report', count(*) from customer""")
def churn_report_guard(spark, sf_dir):
    """A range without any contract is refused before anything is written; another one is written."""
    rows = []
    spans = flagged(spark, sf_dir)
    customers = table(spark, sf_dir, "customer").count()
    for first, last, contracts_ in (("198001", "198012", 0), (FIRST, LAST, customers)):
        path = workspace.new_path(spark, "guarded")
        try:
            churn.write_churn_report(spans, first, last, FLAGS, path)
            problem = None
        except ValueError as error:
            problem = "no active contract" if "no rows" in str(error) else str(error)
        rows.append((problem, "report" if manifest.data_files(spark, path) else "nothing", contracts_))
    return spark.createDataFrame(rows, "problem string, written string, contracts bigint")


SNAPSHOT_SQL = f"""{PORTFOLIO_SQL},
flagged as (
  select idCtr as contract_id, uidpersgen as client_id, cast(date_effet as date) as start_date, cast(date_resil as date) as end_date,
         libreseaucalcule as network, {HEALTH_FLAGS_SQL}
  from (select *, coalesce(regexp_matches(lbproduit_cv, '{fv.LINE_PATTERN_COLLECTOR}'), false)
               or coalesce(regexp_matches(lib_produit, '{fv.LINE_PATTERN_BASE}'), false) as line from portfolio)),
{EXPANDED_SQL}"""
SNAPSHOT_REPORT_SQL = f"with {SNAPSHOT_SQL} " + " union all ".join(
    f"select '{name}' as report, {period} as period, network as libreseaucalcule, {measures} from monthly group by {period}, network"
    for name, period, measures in (
        ("STOCK", "month", wide_stock_sql(fv.SCOPES)),
        ("RESIL ANNEE", "year", wide_exit_sql("year", fv.SCOPES)),
        ("RESIL MOIS", "month", wide_exit_sql("month", fv.SCOPES)),
    )
)


@query(SNAPSHOT_REPORT_SQL)
def snapshot_churn_report(spark, sf_dir):
    """One call from the five snapshot tables to the written reports."""
    names = ("contracts", "validity", "product_reference", "collector_contracts", "collector_product_table")
    tables = {n: derived(spark, sf_dir, t) for n, t in zip(names, (BASE, VALIDITY, REFERENCE, COLLECTOR, COLLECTOR_PRODUCTS), strict=True)}
    path = workspace.new_path(spark, "churn")
    churn.report_from_snapshots(tables, PARTITION, FIRST, LAST, path, carried=(), collector_columns=COLLECTOR_COLUMNS)
    names = (churn.STOCK, churn.BY_YEAR, churn.BY_MONTH)
    return churn.report_table({name: files.read_frame(spark, f"{path}/report={name}") for name in names})


LOG_SQL = " cross join ".join(
    f"(select {', '.join(f'{m} as {p}_{m}' for m in ('mse', 'rmse', 'r2', 'mae', 'explained_variance'))} from "
    f"({METRICS_SQL % ('l_returnflag, ', 'partition by l_returnflag', 'group by l_returnflag')}) where l_returnflag = '{f}')"
    for p, f in (("Training", "N"), ("Dev", "A"), ("Test", "R"))
)


@query(f"""select '1999_09_30-12_00_00' as Date, 'quantity/price' as Variables, run as Params, *
from {LOG_SQL} cross join (values ('depth=3'), ('depth=4')) v(run)""".replace("as Params, *", "as Params, * exclude (run)"))
def run_log_append(spark, sf_dir):
    rows = predictions(spark, sf_dir)
    path = workspace.new_path(spark, "runs")
    metrics = [
        rounded_metrics(scoring.regression_metrics(rows.where(F.col("l_returnflag") == f), "l_extendedprice"))
        for f in ("N", "A", "R")
    ]
    for params in ("depth=3", "depth=4"):
        sinks.append_run(spark, path, ["quantity", "price"], params, *metrics, date=datetime(1999, 9, 30, 12))
    return files.read_frame(spark, path)
