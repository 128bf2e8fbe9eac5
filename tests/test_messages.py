"""Sales messages word by word."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lapsewise.functions import messages


@pytest.fixture(scope="module")
def value(spark):
    return lambda column: spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "held,reasons,expected",
    [
        ("", "[]", "Le client ne détient que de la MRH. Le risque de résiliation du client est dans la moyenne."),
        (
            "AUTO, VIE",
            "[\"le client a 1 sinistre\", 'le client part']",
            "En plus de la MRH, le client détient également le(s) produit(s) suivant(s) : AUTO /  VIE. "
            "Le client est jugé fragile car : il a 1 sinistre /  il part.",
        ),
        (None, None, "Le client ne détient que de la MRH. Le risque de résiliation du client est dans la moyenne."),
    ],
)
def test_findings(value, held, reasons, expected):
    assert value(messages.finding(F.lit(held).cast("string"), F.lit(reasons).cast("string"))) == expected


APPETITE = "Le client a le profil type des clients appétents à "


@pytest.mark.parametrize(
    "inputs,expected",
    [
        (
            ("", "SEUL", "Solo", "O", "SATEI-FM03", 45.0, "", 0.0),
            "Le client n'a a priori pas d'appétence particulière à un produit. ",
        ),
        (
            ("GAV, SANTEIS", "SEUL", "Solo", "N", "SATEI-FM03", 45.0, "", 0.0),
            APPETITE + "GAV /  SANTEIS. Néanmoins, il n'est rattaché a priori à aucun CC",
        ),
        (
            ("GAV", "MARIE", "Famille", "O", "SATEI-FM03", 45.0, "", 0.0),
            APPETITE + "GAV. Il est conseillé de proposer au client une GAV Famille car sa situation familiale est MARIE, "
            "le tarif proposé est: 267.03 EUR pour une IP de 5% / 213.61 EUR pour une IP de 30%. ",
        ),
        (
            ("SANTEIS", "SEUL", "Solo", "O", "SATEI-FS03", 45.5, "", 0.0),
            APPETITE + "SANTEIS. Il est conseillé de proposer au client un contrat SANTEIS (Formule 3 SENIOR), "
            "le tarif proposé est: 45.5 EUR. ",
        ),
        (
            ("SERENIVIE", "SEUL", "Solo", "O", "SATEI-FS03", 45.5, "PRESTIGE", 30.0),
            APPETITE + "SERENIVIE. Il est conseillé de proposer au client un contrat SERENIVIE "
            "(Paiement VIAGER - Formule PRESTIGE), le tarif proposé est environ: 30.0 EUR. ",
        ),
        (("SERENIVIE", "SEUL", "Solo", "O", "SATEI-FS03", 45.5, "", 30.0), APPETITE + "SERENIVIE. "),
        (
            ("GAV", "SEUL", "Duo", "O", "", 1.0, "", 0.0),
            APPETITE + "GAV. Il est conseillé de proposer au client une GAV Duo car sa situation familiale est SEUL, ",
        ),
    ],
)
def test_offers(value, inputs, expected):
    assert value(messages.offer(*map(F.lit, inputs))) == expected
