"""The individual-health portfolio: contracts, validity, product reference, life collector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lapsewise import fixed_values as fv
from lapsewise.functions.dates import month_key
from lapsewise.functions.text import contract_key, policy_number
from lapsewise.operators.joins import add_reference, match_distinct
from lapsewise.operators.snapshots import keep_latest
from lapsewise.sources.tables import snapshot


def base_contracts(contracts: DataFrame, partition: str) -> DataFrame:
    """Contracts in scope, with the policy number."""
    return snapshot(contracts, partition).where(
        F.col("libreseaucalcule").isin(*fv.NETWORKS)
        & (F.col("famille_cible") == fv.PRODUCT_FAMILY)
        & (F.col("top_client") == 1)
        & ~F.col("indicateurgpma").eqNullSafe(fv.EXCLUDED_PARTNER_CODE)
    ).withColumn(
        "polcodc",
        policy_number(F.col("identifiant"), F.col("societedugroupe"), fv.PADDED_COMPANIES, fv.POLICY_WIDTH),
    )


def add_validity(contracts: DataFrame, validity: DataFrame, partition: str, carried: Sequence[str]) -> DataFrame:
    """Start from the validity table where the contract has none; months and years; contract key."""
    starts = snapshot(validity, partition).select(
        F.col("cd_cie").alias("societedugroupe"),
        F.col("num_ctrt").alias("polcodc"),
        F.col("cd_appli").alias("systemeorigine"),
        "dt_deb_valdt_ctrt",
    )
    start = F.coalesce("periodevaliditectrstartdate", "dt_deb_valdt_ctrt")
    end = F.col("periodevaliditectrenddate")
    joined = add_reference(contracts, starts, ["societedugroupe", "polcodc", "systemeorigine"])
    return joined.select(
        "polcodc", "uidpersgen", "famille_cible", "identifiant",
        start.alias("date_effet"),
        end.alias("date_resil"),
        "societedugroupe", "systemeorigine",
        month_key(start).alias("mois_entree"),
        month_key(end).alias("mois_sortie"),
        F.year(end).alias("annee_sortie"),
        "libreseaucalcule",
        F.year(start).alias("year"),
        "cdprodcdgauer", "lib_produit", "dt_partition",
        F.col("agepersphysique").alias("age"),
        *carried,
        contract_key(F.col("identifiant"), F.col("societedugroupe"), F.col("systemeorigine")).alias("idCtr"),
    )


def collector_products(
    contracts: DataFrame, products: DataFrame, partition: str, columns: Sequence[str] = fv.COLLECTOR_CONTRACT
) -> DataFrame:
    """Latest import of each life-collector contract with its individual product."""
    latest = keep_latest(snapshot(contracts, partition).select(*columns, "cdlotimport"), ["nucontra"], "cdlotimport")
    individual = snapshot(products, partition).where(F.col("cdcollindiv") == fv.INDIVIDUAL_PRODUCT)
    matched = match_distinct(
        latest.select(*columns), individual.select(*fv.COLLECTOR_PRODUCT), ["cdcompagnie", "cdappli", "cdproduit"]
    )
    return matched.select(
        F.col("nucontra").alias("identifiant"),
        F.col("cdciegen").alias("societedugroupe"),
        F.col("cdproduit").alias("cdproduit_cv"),
        F.col("lbproduit").alias("lbproduit_cv"),
        F.col("lbcommercial").alias("lbcommercial_cv"),
    )


def load_portfolio(
    contracts: DataFrame,
    validity: DataFrame,
    product_reference: DataFrame,
    collector_contracts: DataFrame,
    collector_product_table: DataFrame,
    partition: str,
    carried: Sequence[str] = fv.CARRIED,
    collector_columns: Sequence[str] = fv.COLLECTOR_CONTRACT,
) -> DataFrame:
    """Contracts of one snapshot with start, end, product reference and collector product."""
    base = add_validity(base_contracts(contracts, partition), validity, partition, carried)
    reference = snapshot(product_reference, partition).select(
        F.col("ciecodc").alias("societedugroupe"), F.col("catcodc").alias("cdprodcdgauer"), "rlpcodc", "rlplibl"
    )
    collector = collector_products(collector_contracts, collector_product_table, partition, collector_columns)
    with_reference = add_reference(base, reference, ["societedugroupe", "cdprodcdgauer"])
    return add_reference(with_reference, collector, ["identifiant", "societedugroupe"])
