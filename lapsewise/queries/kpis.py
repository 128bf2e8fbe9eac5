"""Churn KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapsewise import fixed_values as fv
from lapsewise.operators import kpis, reshape
from lapsewise.operators.measures import narrow_spans, stock_of_spans, terminations_of_spans
from lapsewise.plans.churn import read_measures, write_measures
from lapsewise.queries.base import query
from lapsewise.queries.portfolio import STOCK_SQL
from lapsewise.queries.stand_ins import FIRST, FLAGS, LAST, MEASURES_SQL, flagged
from lapsewise.sources import workspace

YEARS = ("1997", "1998", "1999")
MONTHS_OF_YEAR = ", ".join(
    f"avg(case when month_no = {i} then %s end) as \"{label}\"" for i, label in enumerate(fv.MONTH_LABELS, 1)
)


def _measures(spark, sf_dir):
    """Measures as stored: the KPIs read these few rows only."""
    root = workspace.new_path(spark, "measures")
    write_measures(flagged(spark, sf_dir), FIRST, LAST, FLAGS, root)
    measures, last = read_measures(spark, root, LAST)
    assert last == LAST
    return measures


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(f"""with {MEASURES_SQL},
t as (select network, product, kind, year, cast(substr(month, 5, 2) as int) as month_no, stock from measures)
select network, product, kind, year, {MONTHS_OF_YEAR % (('stock',) * 12)} from t group by network, product, kind, year""")
def pivot_stock_month(spark, sf_dir):
    return kpis.months_table(_measures(spark, sf_dir), "stock")


@query(f"""with {MEASURES_SQL}
select month, network, name, kind, product, year, stock,
       strftime(strptime(month || '01', '%Y%m%d'), '%b') as month_name
from (select month, network, name, stock, split_part(name, '_', 1) as kind, substr(name, 11) as product,
             substr(month, 1, 4) as year from stock_long)""")
def measures_long(spark, sf_dir):
    return reshape.to_long(stock_of_spans(flagged(spark, sf_dir), FIRST, LAST, FLAGS), "stock")


@query(STOCK_SQL)
def measures_round_trip(spark, sf_dir):
    wide = stock_of_spans(flagged(spark, sf_dir), FIRST, LAST, FLAGS)
    names = [c for c in wide.columns if c not in ("month", "network")]
    return reshape.to_wide(reshape.to_long(wide), ["month", "network"], names)


@query(f"""with {MEASURES_SQL}
select month, network, name, kind, product, stock, terminated, round(rate, 6) as rate from measures""")
def churn_rate_monthly(spark, sf_dir):
    spans = workspace.stored(narrow_spans(flagged(spark, sf_dir), FIRST, LAST, FLAGS), "spans")
    wide = workspace.stored(stock_of_spans(spans, FIRST, LAST, FLAGS), "stock")
    stock = reshape.to_long(wide, "stock")
    terminated = reshape.to_long(terminations_of_spans(spans, FIRST, LAST, "month", FLAGS, stock=wide, store=False), "terminated")
    return _rounded(kpis.monthly_rates(stock, terminated), "rate").drop("year", "month_name")


ANNUAL_SQL = f"""{MEASURES_SQL},
annual as (
  select year, network, product, arg_min(stock, month) as stock, cast(sum(terminated) as bigint) as terminated,
         round_even(cast(sum(terminated) as double) / arg_min(stock, month) * 100, 1) as annual_rate
  from measures where kind = 'nbCtr' group by year, network, product)"""


@query(f"with {ANNUAL_SQL} select * from annual")
def churn_rate_annual(spark, sf_dir):
    return kpis.annual_rates(_measures(spark, sf_dir))


SHARE_SQL = f"""{ANNUAL_SQL},
share as (
  select network, product,
         cast(sum(case when year = '1998' and month <= '199809' then terminated end) as double)
           / nullif(sum(case when year = '1998' then terminated end), 0) as share
  from measures where kind = 'nbCtr' group by network, product)"""


@query(f"with {SHARE_SQL} select network, product, round(share, 6) as share from share")
def ytd_share(spark, sf_dir):
    return _rounded(kpis.year_to_date_share(_measures(spark, sf_dir)), "share")


@query(f"""with {SHARE_SQL}
select network, product, year, stock, terminated, annual_rate, round(share, 6) as share,
       round_even(annual_rate / nullif(share, 0), 1) as annualised_rate
from annual join share using (network, product) where year = '1999'""")
def annualised_rate(spark, sf_dir):
    return _rounded(kpis.annualised_rates(_measures(spark, sf_dir), LAST), "share")


@query(f"""with {MEASURES_SQL},
sums as (
  select network, product, kind,
         cast(sum(case when year = '1999' and month <= '199909' then terminated end) as bigint) as this_year,
         cast(sum(case when year = '1998' then terminated end) as bigint) as last_year,
         cast(sum(case when year = '1998' and month <= '199809' then terminated end) as bigint) as last_year_to_date,
         cast(sum(case when year = '1997' then terminated end) as bigint) as base_year,
         max(case when month = '199701' then stock end) as stock_base,
         max(case when month = '199801' then stock end) as stock_last,
         max(case when month = '199901' then stock end) as stock_this
  from measures group by network, product, kind)
select *, round_even(cast(base_year as double) / nullif(stock_base, 0) * 100, 1) as rate_base,
       round_even(cast(last_year as double) / nullif(stock_last, 0) * 100, 1) as rate_last,
       round_even(cast(this_year as double) * last_year / nullif(last_year_to_date, 0) / nullif(stock_this, 0) * 100, 1) as rate_this
from sums""")
def selection_kpis(spark, sf_dir):
    return kpis.selection_kpis(_measures(spark, sf_dir), "1997", LAST)


@query(f"""with {ANNUAL_SQL}
select network, product, {', '.join(
    f"cast(cast(round_even(avg(case when year = '{y}' then stock end) / 1000, 0) as bigint) as varchar) || 'k' as \"{y}\""
    for y in YEARS)}
from annual group by network, product""")
def pivot_stock_year(spark, sf_dir):
    return kpis.stock_per_year(kpis.annual_rates(_measures(spark, sf_dir)), YEARS)


@query(f"""with {ANNUAL_SQL}
select network, product, {', '.join(f"avg(case when year = '{y}' then annual_rate end) as \"{y}\"" for y in YEARS)}
from annual group by network, product""")
def pivot_rate_year(spark, sf_dir):
    return kpis.rate_per_year(kpis.annual_rates(_measures(spark, sf_dir)), YEARS)


@query(f"""with {MEASURES_SQL},
t as (select network, product, kind, year, cast(substr(month, 5, 2) as int) as month_no, terminated, stock from measures),
p as (select network, product, kind, year, {MONTHS_OF_YEAR % (('terminated',) * 12)},
             max(case when month_no = 1 then stock end) as january
      from t group by network, product, kind, year)
select * exclude (january), year || ' (stock = ' || cast(january as varchar) || ')' as label
from p where year > (select min(year) from measures)""")
def pivot_terminations_month(spark, sf_dir):
    return kpis.terminations_table(_measures(spark, sf_dir))


@query(f"""with {MEASURES_SQL},
t as (select network, product, kind, year, cast(substr(month, 5, 2) as int) as month_no, round(rate, 6) as rate from measures)
select network, product, kind, year, {MONTHS_OF_YEAR % (('rate',) * 12)} from t group by network, product, kind, year""")
def pivot_rate_month(spark, sf_dir):
    return kpis.months_table(_rounded(_measures(spark, sf_dir), "rate"), "rate")


@query(f"""with {MEASURES_SQL}
select month, network, name, kind, product, year, stock, terminated, round(rate, 6) as rate
from measures where year in ('1998', '1999')""")
def two_year_series(spark, sf_dir):
    return _rounded(kpis.two_year_series(_measures(spark, sf_dir), LAST), "rate").drop("month_name")


@query(f"""with {MEASURES_SQL}
select month, year, stock, terminated, round(rate, 6) as rate
from measures where network = 'BUILDING' and product = 'line_clas' and kind = 'nbCli'""")
def selected_series(spark, sf_dir):
    series = kpis.selection(_measures(spark, sf_dir), "BUILDING", "line_clas", "nbCli")
    return _rounded(series, "rate").select("month", "year", "stock", "terminated", "rate")


@query(f"with {MEASURES_SQL} select distinct network, product from measures where kind = 'nbCtr'")
def product_list(spark, sf_dir):
    return kpis.product_list(_measures(spark, sf_dir))
