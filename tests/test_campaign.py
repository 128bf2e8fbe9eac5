"""The campaign job end to end on a few people."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lapsewise import fixed_values as fv
from lapsewise.plans import campaign
from lapsewise.sources import manifest

CANDIDATE = (
    "identifiant string, identifiantrce string, identifiantintermediaire string, intmail string, telmobile double, "
    "telfixe double, codedepartement int, agepersphysique double, proposition string, montantannuelttcvalestime double, "
    "autres_produits_detenus string, raisons_fragilite string, libsituationfamiliale string, SITFAM_2 string, "
    "lib_produit string, nompersonne string, prenom string, libcsp string, nomrue string, localite string, score_fragilite int"
)


def person(contract, rce, **changes):
    row = {
        "identifiant": contract, "identifiantrce": rce, "identifiantintermediaire": "i1", "intmail": "a@x", "telmobile": 611111111.0,
        "telfixe": None, "codedepartement": 75, "agepersphysique": 45.0, "proposition": "GAV", "montantannuelttcvalestime": 250.0,
        "autres_produits_detenus": "", "raisons_fragilite": "[]", "libsituationfamiliale": "SEUL", "SITFAM_2": "Solo",
        "lib_produit": "MRH", "nompersonne": "N", "prenom": "P", "libcsp": "c", "nomrue": "r", "localite": "l", "score_fragilite": 8,
    }
    return tuple({**row, **changes}.values())


@pytest.fixture(scope="module")
def inputs(spark):
    people = [
        person("kept", "12"), person("second", "12", score_fragilite=7), person("done", "13"),
        person("no_phone", "14", telmobile=float("nan")), person("minor", "15", agepersphysique=17.9),
        person("no_age", "16", agepersphysique=None), person("no_advisor", "17", identifiantintermediaire="i2"),
        person("old", "18", agepersphysique=81.0), person("other", "19", proposition="AUTO"),
        person("better", "20", score_fragilite=10, intmail=None), person("pair_bad", "21", proposition="AUTO", score_fragilite=10),
        person("pair_good", "21"),
    ]
    grid = "age_min int, age_max int, formula string, price double"
    return dict(
        candidates=spark.createDataFrame(people, CANDIDATE),
        hierarchy=spark.createDataFrame([("i1", 5), ("i1", 5), ("i2", 4)], "Id_Intermediaire string, niveau_ptf int"),
        advisors=spark.createDataFrame([("DUPONT", "Zoé", "A@X")], "cc_nom string, cc_prenom string, email string"),
        history=spark.createDataFrame([("00000013", 7), ("00000013", 8)], "identifiantrce string, note_fragilite int"),
        health_grid=spark.createDataFrame([(75, 18, 60, "SATEI-FM03", 40.0)], f"department int, {grid}"),
        funeral_grid=spark.createDataFrame([(18, 60, "", 0.0)], grid),
        extraction="20211231", week="3",
    )


def ids(work):
    return {r.id_contrat: r for r in work.collect()}


def test_work_list(inputs):
    work = ids(campaign.campaign(**inputs, contacts=10, controls=1))
    assert set(work) == {"kept", "better", "pair_good"}
    row = work["kept"]
    assert (row.identifiantrce, row.telephone, row.indicatif, row.prime_mensuelle) == ("00000012", "0611111111", "01", 20)
    assert (row.cc_nom, row.campagne) == ("DUPONT", "OF_R2_MRH_Vague 2022 - S03")
    assert row.proposition_formule_santeis == "SATEI-FM03" and "146.97" in row.message2
    assert work["better"].cc_nom is None
    assert sum(r.temoin for r in work.values()) == 1


def test_lists_to_send(inputs):
    work = campaign.campaign(**inputs, contacts=10, controls=1)
    contact = {r.NOGPA for r in campaign.contact_list(work, False).collect()}
    control = {r.NOGPA for r in campaign.contact_list(work, True).collect()}
    assert contact.isdisjoint(control) and len(contact | control) == 3
    export = campaign.app_export(work)
    assert tuple(export.columns) == fv.APP_COLUMNS and export.count() == 2
    assert {(r.rac, r.type_contrat) for r in export.collect()} == {(0, " - ")}


def test_rerun_keeps_the_list_even_when_it_is_in_the_history(inputs):
    first = campaign.campaign(**inputs, contacts=10, controls=1)
    former = first.select("id_contrat", "temoin")
    told = inputs["history"].unionByName(first.select("identifiantrce", F.lit(7).alias("note_fragilite")))
    again = campaign.campaign(**{**inputs, "history": told}, former=former)
    assert {k: r.temoin for k, r in ids(again).items()} == {k: r.temoin for k, r in ids(first).items()}


def test_repeats_may_be_dropped_after_the_draw(inputs):
    work = ids(campaign.campaign(**inputs, contacts=2, controls=1, dedupe="after"))
    assert set(work) == {"better", "kept", "pair_good"}
    fewer = ids(campaign.campaign(**inputs, contacts=3, controls=1, dedupe="after"))
    assert set(fewer) == {"better", "kept", "pair_good"}


def test_bad_dates_are_refused(inputs):
    with pytest.raises(ValueError):
        campaign.campaign(**{**inputs, "extraction": "202112"})


def committed(spark, root, date="20211231"):
    names = ("work", "contact", "control", "app", "funnel")
    frames = {n: manifest.read_output(spark, root, date, n) for n in names}
    return {n: None if f is None else sorted(map(str, f.collect())) for n, f in frames.items()}


def test_outputs_are_written_and_found(spark, inputs, tmp_path):
    root = str(tmp_path)
    found = campaign.write_campaign(**inputs, root=root, contacts=10, controls=1)
    assert manifest.lookup(spark, root, "20211231") == found and manifest.lookup(spark, root, "20220131") is None
    work = {r.id_contrat: r for r in manifest.read_output(spark, root, "20211231", "work").collect()}
    assert set(work) == {"kept", "better", "pair_good"}
    lists = [manifest.read_output(spark, root, "20211231", n).collect() for n in ("contact", "control", "app")]
    assert [len(x) for x in lists] == [2, 1, 2]
    assert {r.NOGPA for r in lists[0]} | {r.NOGPA for r in lists[1]} == {r.identifiantrce for r in work.values()}
    steps = [(r.step, r.rows, r.ids) for r in manifest.read_output(spark, root, "20211231", "funnel").orderBy("step_no").collect()]
    assert steps == [
        ("candidates", 12, 10), ("phone", 11, 9), ("adult", 9, 7), ("not contacted", 8, 6), ("advisor present", 7, 5),
        ("target proposal", 5, 4), ("age limit", 4, 3),
    ]


def test_second_run_takes_the_stored_list(spark, inputs, tmp_path):
    root = str(tmp_path)
    campaign.write_campaign(**inputs, root=root, contacts=10, controls=1)
    first = committed(spark, root)
    told = inputs["history"].unionByName(manifest.read_output(spark, root, "20211231", "work").select("identifiantrce", F.lit(7).alias("note_fragilite")))
    campaign.write_campaign(**{**inputs, "history": told}, root=root, contacts=1, controls=0)
    again = committed(spark, root)
    assert all(again[n] == first[n] for n in ("contact", "control", "app"))
    campaign.write_campaign(**{**inputs, "extraction": "20220131"}, root=root, contacts=1, controls=1)
    assert len(committed(spark, root, "20220131")["work"]) == 2 and committed(spark, root) == again


def test_a_run_that_stops_between_two_outputs_leaves_the_former_ones(spark, inputs, tmp_path, monkeypatch):
    root, write = str(tmp_path), manifest.Run.csv

    def stops(self, df, name):
        if name == "control":
            raise RuntimeError("driver lost")
        write(self, df, name)

    monkeypatch.setattr(manifest.Run, "csv", stops)
    with pytest.raises(RuntimeError):
        campaign.write_campaign(**inputs, root=root, contacts=10, controls=1)
    assert set(committed(spark, root).values()) == {None} and manifest.lookup(spark, root, "20211231") is None
    monkeypatch.setattr(manifest.Run, "csv", write)
    campaign.write_campaign(**inputs, root=root, contacts=10, controls=1)
    before = committed(spark, root)
    monkeypatch.setattr(manifest.Run, "csv", stops)
    with pytest.raises(RuntimeError):
        campaign.write_campaign(**inputs, root=root, contacts=10, controls=1)
    assert committed(spark, root) == before
