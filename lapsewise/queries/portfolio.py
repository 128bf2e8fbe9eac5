"""Stock and terminations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsewise.functions.amounts import id_when
from lapsewise.functions.rules import add_flags
from lapsewise.operators import measures, spans
from lapsewise.queries.base import query, table
from lapsewise.queries.stand_ins import (
    CONTRACTS_SQL, FIRST, FLAGS, FLAGS_SQL, FROM_SQL, LAST, MONTHLY_SQL, TO_SQL, contracts, flagged, scope_rules,
    wide_exit_sql, wide_stock_sql,
)
from lapsewise.sources.workspace import stored

THETA_SQL = f"""with {CONTRACTS_SQL},
calendar as (select cast(unnest(generate_series({FROM_SQL}, {TO_SQL}, interval 1 month)) as date) as m)
select strftime(m, '%Y%m') as month, count(distinct client_id) as "nbCli", count(distinct contract_id) as "nbCtr"
from calendar join contracts
  on date_trunc('month', start_date) <= m and (end_date is null or date_trunc('month', end_date) >= m)
where start_date <> end_date or end_date is null
group by m"""


@query(THETA_SQL)
def stock_monthly(spark, sf_dir):
    return measures.stock_of_spans(contracts(spark, sf_dir), FIRST, LAST)


@query(THETA_SQL)
def stock_theta(spark, sf_dir):
    monthly = spans.list_months(spans.drop_empty(contracts(spark, sf_dir)), FIRST, LAST)
    return measures.stock(monthly)


STOCK_SQL = f"with {MONTHLY_SQL} select month, network, {wide_stock_sql()} from monthly group by month, network"


@query(STOCK_SQL)
def stock_by_network_product(spark, sf_dir):
    return measures.stock_of_spans(flagged(spark, sf_dir), FIRST, LAST, FLAGS)


@query(STOCK_SQL)
def stock_by_network_product_expanded(spark, sf_dir):
    monthly = spans.list_months(spans.drop_empty(flagged(spark, sf_dir)), FIRST, LAST)
    return measures.stock(monthly, FLAGS)


def _exits_sql(period: str) -> str:
    return f"""with {MONTHLY_SQL}
select {period}, count(distinct case when {period} = exit_{period} then client_id end) as "nbCli",
       count(distinct case when {period} = exit_{period} then contract_id end) as "nbCtr"
from monthly group by {period}"""


@query(_exits_sql("month"))
def terminations_monthly(spark, sf_dir):
    return measures.terminations_of_spans(contracts(spark, sf_dir), FIRST, LAST, "month")


@query(_exits_sql("year"))
def terminations_yearly(spark, sf_dir):
    return measures.terminations_of_spans(contracts(spark, sf_dir), FIRST, LAST, "year")


@query(f"with {MONTHLY_SQL} select month, network, {wide_exit_sql('month')} from monthly group by month, network")
def terminations_by_network_product(spark, sf_dir):
    return measures.terminations_of_spans(flagged(spark, sf_dir), FIRST, LAST, "month", FLAGS)


@query(f"with {MONTHLY_SQL} select year, network, {wide_exit_sql('year')} from monthly group by year, network")
def terminations_by_year_network_product(spark, sf_dir):
    return measures.terminations_of_spans(flagged(spark, sf_dir), FIRST, LAST, "year", FLAGS)


@query(f"""with {MONTHLY_SQL}
select month, count(distinct case when month = exit_month then client_id end) as "nbCli",
       count(distinct case when month = exit_month then contract_id else '0' end) as "nbCtr"
from monthly group by month""")
def terminations_sentinel_compat(spark, sf_dir):
    narrow = stored(measures.narrow_spans(contracts(spark, sf_dir), FIRST, LAST, ()), "spans")
    return measures.terminations(spans.listed_portfolio(narrow, FIRST, LAST), "month", sentinel=True)


@query(f"""with {MONTHLY_SQL}
select month, exit_month, exit_year, network, count(*) as contract_months from monthly
group by month, exit_month, exit_year, network""")
def monthly_portfolio(spark, sf_dir):
    monthly = spans.monthly_portfolio(contracts(spark, sf_dir), FIRST, LAST)
    return monthly.groupBy("month", "exit_month", "exit_year", "network").agg(
        F.count(F.lit(1)).alias("contract_months")
    )


@query(f"""with {CONTRACTS_SQL}
select contract_id, client_id, start_date as "start",
       max(coalesce(end_date, date '9999-12-01')) over (partition by contract_id) as "end"
from contracts where start_date <> end_date or end_date is null""")
def contract_end_merge(spark, sf_dir):
    rows = spans.drop_empty(contracts(spark, sf_dir)).select("contract_id", "client_id", "start", "end")
    return spans.merge_ends(rows)


@query(f"""select p_partkey, {FLAGS_SQL},
       case when p_type = 'LARGE' then p_partkey end as pro_id from part""")
def product_flags(spark, sf_dir):
    flags = add_flags(table(spark, sf_dir, "part"), scope_rules(), other="top_autre")
    return flags.select("p_partkey", *FLAGS, id_when(F.col("top_pro") == 1, F.col("p_partkey")).alias("pro_id"))
