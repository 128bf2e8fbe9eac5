"""Campaign lists: enrichment, exclusion, draw, prices, messages, and the lists to send."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lapsewise import fixed_values as fv
from lapsewise.functions import messages, rules
from lapsewise.functions.amounts import monthly_amount, nan_to_null
from lapsewise.functions.dates import campaign_name, check_day, day
from lapsewise.functions.text import zero_fill
from lapsewise.operators import joins
from lapsewise.operators.lookups import add_dial_prefix, add_price
from lapsewise.operators.quality import apply_steps, funnel
from lapsewise.operators.selection import Order, draw_or_reuse, sorting, wave_steps
from lapsewise.operators.snapshots import first_per_key
from lapsewise.sources import manifest
from lapsewise.sources.workspace import stored

SCORE = "score_fragilite"


def enriched(candidates: DataFrame, hierarchy: DataFrame, advisors: DataFrame, history: DataFrame) -> DataFrame:
    """Candidates with advisor, contact mark, phone, dial prefix and age.

    ``score_fragilite`` is the candidates' own column or a placeholder.
    """
    level = hierarchy.where(F.col("niveau_ptf") == fv.ADVISOR_LEVEL)
    df = joins.mark_text(
        candidates, "identifiantintermediaire", level, "Id_Intermediaire", "Presence_CC", "O", "N"
    )
    df = joins.add_by_upper_key(df, "intmail", advisors, "email", repeats="first").drop("email")
    if SCORE not in df.columns:
        df = df.withColumn(SCORE, rules.placeholder_score(F.col("identifiant")))
    df = df.withColumns(
        {
            "identifiantrce": F.col("identifiantrce").cast("string").try_cast("bigint"),
            "telephone": rules.phone(F.col("telmobile"), F.col("telfixe")),
            "agepersphysique": nan_to_null(F.col("agepersphysique")),
        }
    )
    contacted = history.select(F.col("identifiantrce").cast("string").try_cast("bigint").alias("contacted"))
    df = joins.mark_text(df, "identifiantrce", contacted, "contacted", "Contact", "DONE", "-")
    df = add_dial_prefix(df, "codedepartement")
    return df.withColumns(
        {
            "identifiantrce": zero_fill(F.col("identifiantrce"), 8),
            "age_assure": F.col("agepersphysique").cast("int"),
        }
    )


def reach_steps() -> dict[str, Column]:
    """Whom a campaign can reach at all."""
    return {"phone": F.col("telephone") != "", "adult": F.col("agepersphysique") >= fv.MIN_AGE}


def campaign_steps() -> dict[str, Column]:
    """All filter steps from the candidates to the draw, for :func:`quality.funnel`."""
    return {**reach_steps(), **wave_steps()}


def price_and_write(df: DataFrame, health_grid: DataFrame, funeral_grid: DataFrame, extraction: str, week: str) -> DataFrame:
    """Premiums, proposed prices, the two messages and the campaign name."""
    yearly = F.coalesce(nan_to_null(F.col("montantannuelttcvalestime")), F.lit(0.0))
    df = df.withColumn("prime_annuelle", yearly).withColumn("prime_mensuelle", monthly_amount(yearly))
    df = add_price(
        df, health_grid, "age_assure", "codedepartement", "proposition_formule_santeis", "proposition_tarif_santeis"
    )
    df = add_price(
        df, funeral_grid, "age_assure", None, "proposition_formule_serenivie", "proposition_tarif_serenivie"
    )
    return df.withColumns(
        {
            "message1": messages.finding(F.col("autres_produits_detenus"), F.col("raisons_fragilite")),
            "message2": messages.offer(
                F.col("proposition"), F.col("libsituationfamiliale"), F.col("SITFAM_2"), F.col("Presence_CC"),
                F.col("proposition_formule_santeis"), F.col("proposition_tarif_santeis"),
                F.col("proposition_formule_serenivie"), F.col("proposition_tarif_serenivie"),
            ),
            "campagne": campaign_name(day(extraction), F.lit(week)),
            "formule": F.col("lib_produit"),
        }
    )


def campaign(
    candidates: DataFrame,
    hierarchy: DataFrame,
    advisors: DataFrame,
    history: DataFrame,
    health_grid: DataFrame,
    funeral_grid: DataFrame,
    extraction: str,
    week: str,
    order: Order = ((SCORE, "desc"),),
    former: DataFrame | None = None,
    dedupe: str = "before",
    **options,
) -> DataFrame:
    """The work list of one wave.

    One row per insured person is kept, by ``order`` and contract, before the draw, so
    that the list is full; ``dedupe='after'`` drops repeats from the drawn list instead.
    The enriched candidates are written once, and drawn from there.
    """
    check_day(extraction)
    rows = stored(enriched(candidates, hierarchy, advisors, history), "candidates")
    return work_list(rows, health_grid, funeral_grid, extraction, week, order, former, dedupe, **options)


def work_list(
    rows: DataFrame,
    health_grid: DataFrame,
    funeral_grid: DataFrame,
    extraction: str,
    week: str,
    order: Order = ((SCORE, "desc"),),
    former: DataFrame | None = None,
    dedupe: str = "before",
    **options,
) -> DataFrame:
    """:func:`campaign` from the enriched candidates."""
    rows = apply_steps(rows, reach_steps())
    one_each = sorting([*order, ("identifiant", "asc")])
    if dedupe == "before" and former is None:
        rows = first_per_key(rows, ["identifiantrce"], [*_eligible_first(), *one_each])
    drawn = draw_or_reuse(rows, former, order, **options)
    if dedupe == "after" or former is not None:
        drawn = first_per_key(drawn, ["identifiantrce"], one_each)
    priced = price_and_write(drawn, health_grid, funeral_grid, extraction, week)
    return priced.withColumnsRenamed({"nompersonne": "nom", "identifiant": "id_contrat"})


def write_campaign(
    candidates: DataFrame,
    hierarchy: DataFrame,
    advisors: DataFrame,
    history: DataFrame,
    health_grid: DataFrame,
    funeral_grid: DataFrame,
    extraction: str,
    week: str,
    root: str,
    order: Order = ((SCORE, "desc"),),
    dedupe: str = "before",
    **options,
) -> dict:
    """Write all outputs of a wave below ``root``; gives the manifest that names them.

    Outputs: ``work`` and ``funnel`` as parquet, ``contact``, ``control`` and ``app`` as CSV. The candidates are enriched and
    written once; the funnel and the draw read what was written, and the lists are cut from the stored work
    list. All outputs are committed under the extraction date together (:mod:`manifest`). Where that date has
    a list already, its contracts and control flags are taken again instead of a new draw.
    """
    check_day(extraction)
    spark = candidates.sparkSession
    former = manifest.read_output(spark, root, extraction, "work")
    rows = stored(enriched(candidates, hierarchy, advisors, history), "candidates")
    run = manifest.Run(spark, root, extraction)
    work = work_list(rows, health_grid, funeral_grid, extraction, week, order, former, dedupe, **options)
    work = run.frame(work, "work")
    run.csv(contact_list(work, control=False), "contact")
    run.csv(contact_list(work, control=True), "control")
    run.csv(app_export(work), "app")
    run.frame(funnel(rows, campaign_steps(), start="candidates", ids="identifiantrce"), "funnel")
    return run.commit()


def _eligible_first() -> list[Column]:
    """Of a person's contracts those a wave may draw come first, so that one of them is kept."""
    target = F.col("proposition").isin(*fv.TARGET_PROPOSALS) & (F.col("Presence_CC") == "O")
    return [F.coalesce(target, F.lit(False)).desc()]


def contact_list(work: DataFrame, control: bool) -> DataFrame:
    """Ids and scores to contact, or of the control group."""
    group = F.col("temoin") if control else ~F.col("temoin")
    return work.where(group).select(F.col("identifiantrce").alias("NOGPA"), F.col(SCORE).alias("note_fragilite"))


def app_export(work: DataFrame) -> DataFrame:
    """Rows for the advisors' application, without the control group."""
    return (
        work.where(~F.col("temoin"))
        .withColumnRenamed("prime_mensuelle", "prime")
        .withColumns({"rac": F.lit(0), "type_contrat": F.lit(" - ")})
        .select(*fv.APP_COLUMNS)
    )
