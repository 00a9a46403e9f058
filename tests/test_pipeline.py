"""End-to-end run of the pipeline on small raw CSV fixtures (see FIXTURES.md)."""
import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from agora.plans import analogs
from agora.plans import bronze as B
from agora.plans import gold as G
from agora.plans import pipeline as P
from agora.plans import governance as GOV
from agora.plans.governance import RULES

TS = dt.datetime(2026, 1, 1, 2, 0, 0)


def write_csv(path, header, data, sep=";"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, delimiter=sep)
        w.writerow(header)
        w.writerows(data)
    return str(path)


def socio_row(code, pop="1000", h="500", f="500", med="20000,5", act="400", chom=("10", "20", "5")):
    vals = {c: "1" for c in P.RAW_COLUMNS["socio"]}
    vals.update({"CODGEO": code, "P22_POP": pop, "P22_POPH": h, "P22_POPF": f, "MED21": med,
                 "P22_ACT15P": act, "P22_CHOM1524": chom[0], "P22_CHOM2554": chom[1],
                 "P22_CHOM5564": chom[2], "P22_LOG": "200", "P22_RP_LOCHLMV": "50", "P22_LOGVAC": "S",
                 "TP6021": " 12,5 ", "D121": "", "D921": "S"})
    return [vals[c] for c in P.RAW_COLUMNS["socio"]]


@pytest.fixture(scope="module")
def raw_paths(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    assoc = [write_csv(d / f"rna_{dep}.csv", ["adrs_codeinsee", "position"], rows) for dep, rows in [
        ("92", [["92004", "A"], ["92004", "A"], ["92004", "D"], ["75056", "A"], ["", "A"]]),
        ("93", [["93001", "A"]]),
        ("94", [["94002", "A"], ["94002", None]])]]
    crime = write_csv(d / "crime.csv", P.RAW_COLUMNS["crime"], [
        ["93001", "2022", "Cambriolages de logement", "5,25"],
        ["93001", "2022", "Cambriolages de logement", " 3.25 "],
        ["93001", "2022", "Vols avec armes", "NA"],
        ["93001", "2021", "Vols avec armes", "9"],
        ["92004", "2022", "Violences sexuelles", ""],
        ["92004", "2022", "Autre", "7"],
        ["01001", "2022", "Vols avec armes", "1"]])
    socio = write_csv(d / "socio.csv", P.RAW_COLUMNS["socio"], [
        socio_row("92004"), socio_row("93001", pop="S", h="10", f="20"),
        socio_row("94002", act="0", med="S"), socio_row("01001")])
    elections = write_csv(d / "elections.csv", P.RAW_COLUMNS["elections"], [
        ["92", "Hauts-de-Seine", "92004", "Asnières", "1200", "200", "1000", "10", "5", "985"],
        ["92", "Hauts-de-Seine", "92004", "Asnières", "800", "NA", "600", "", "5", "590"],
        ["93", "Seine-Saint-Denis", "93001", "Aubervilliers", "0", "0", "0", "0", "0", "0"],
        ["93", "Seine-Saint-Denis", "93001", "Auberv.", "NA", "NA", "NA", "NA", "NA", "NA"],
        ["94", "Val-de-Marne", "94002", "Alfortville", "100", "10", "120", "1", "1", "118"],
        ["75", "Paris", "75056", "Paris", "5", "1", "4", "0", "0", "4"]])
    cands = write_csv(d / "t1.csv", P.RAW_COLUMNS["candidates"], [
        ["92", "Hauts-de-Seine", "92004", "Asnières", " Emmanuel ", " Macron ", "512"],
        ["92", "Hauts-de-Seine", "92004", "Asnières", "Jean-Luc", "MÉLENCHON", "512.0"],
        ["92", "Hauts-de-Seine", "92004", "Asnières", "X", "Inconnu", "NA"],
        ["93", "Seine-Saint-Denis", "93001", "Aubervilliers", "Marine", "LE PEN", "0"],
        ["93", "Seine-Saint-Denis", "93001", "Aubervilliers", "Eric", "Zemmour", ""],
        ["75", "Paris", "75056", "Paris", "Anne", "HIDALGO", "100"]])
    return {"associations": assoc, "crime": crime, "socio": socio, "elections": elections,
            "candidates": cands}


@pytest.fixture(scope="module")
def tables(spark, raw_paths, tmp_path_factory):
    raw = P.read_raw(spark, raw_paths, sep=";")
    wh = str(tmp_path_factory.mktemp("warehouse"))
    return P.run(spark, raw, wh, start_ts=TS, end_ts=TS + dt.timedelta(minutes=30))


def as_dict(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_bronze_associations_and_crime(tables):
    assert as_dict(tables["vie_associative_commune"], "code_commune") .keys() == {"92004", "93001", "94002"}
    assert as_dict(tables["vie_associative_commune"], "code_commune")["92004"]["nb_associations"] == 2
    crime = as_dict(tables["criminalite_commune"], "code_commune")
    assert set(crime) == {"93001", "92004", B.PATCHED_COMMUNE}
    assert crime["93001"]["taux_cambriolage"] == 4.25 and crime["93001"]["taux_vols_armes"] is None
    assert crime[B.PATCHED_COMMUNE]["source_fichier"] == B.PATCH_SOURCE
    clean = as_dict(tables["criminalite_commune_clean"], "code_commune")
    assert all(v is not None for r in clean.values() for k, v in r.items() if k.startswith("taux"))


def test_bronze_socio_and_participation(tables):
    socio = as_dict(tables["socio_demo_communes"], "code_commune")
    assert set(socio) == {"92004", "93001", "94002"}
    assert socio["92004"]["revenu_median_menages_2021"] == 20000.5
    assert socio["92004"]["taux_pauvrete_total_2021"] == 12.5
    assert socio["93001"]["population_totale_2022"] is None
    el = {(r.code_commune, r.libelle_commune): r for r in tables["elections_communes"].collect()}
    asn = el[("92004", "Asnières")]
    assert asn.total_inscrits == 2000.0 and asn.total_blancs == 10.0
    assert asn.ratio_votants_inscrits == 80.0
    assert el[("93001", "Aubervilliers")].ratio_votants_inscrits == 0.0   # zero guard
    assert el[("93001", "Auberv.")].ratio_votants_inscrits is None       # all NA
    assert ("75056", "Paris") not in el


def test_candidate_shares(tables):
    c = {(r.code_commune, r.nom): r for r in tables["presidentielle_2022_communes_candidats_pct"].collect()}
    assert c[("92004", "Macron")].voix == 512 and c[("92004", "Macron")].pourcentage_voix == 50.0
    assert c[("92004", "Inconnu")].pourcentage_voix is None
    assert c[("93001", "LE PEN")].pourcentage_voix == 0.0
    assert c[("92004", "Macron")].prenom == "Emmanuel"


def test_dimensions(spark, tables):
    dim = tables["DIM_COMMUNE"].collect()
    # 93001 has two labels -> two current rows (fan-out kept)
    assert sorted(r.code_commune for r in dim) == ["92004", "93001", "93001", "94002"]
    assert sorted(r.id_commune for r in dim) == [1, 2, 3, 4]
    assert {r.nom_departement for r in dim} == {"Hauts-de-Seine", "Seine-Saint-Denis", "Val-de-Marne"}
    cal = {r.id_temps: r for r in tables["DIM_TEMPS"].collect()}
    assert (cal[2].annee, cal[2].mois, cal[2].trimestre, cal[2].semestre, cal[2].annee_electorale) == \
        (2022, 4, 2, 1, True)
    assert (cal[5].annee, cal[5].trimestre, cal[5].semestre, cal[5].annee_electorale) == (2021, 4, 2, False)
    assert tables["DIM_CANDIDAT"].count() == 13 and tables["DIM_PARTI_POLITIQUE"].count() == 13
    assert tables["FACT_EDUCATION"].count() == 0
    assert tables["FACT_EDUCATION"].schema == G.SOURCE_EDUCATION_SCHEMA


def test_results_fact(tables):
    f = tables["FACT_RESULTATS_ELECTORAUX"].collect()
    by_voix = sorted((r.fk_candidat, r.nb_voix, r.rang_commune) for r in f if r.fk_commune == 1)
    # MACRON and MÉLENCHON tie at 512 (rank 1), the unknown name gets key 0 and rank 3 (NULL last)
    assert by_voix == [(0, None, 3), (1, 512, 1), (3, 512, 1)]
    assert sorted(r.id_fait for r in f) == list(range(1, len(f) + 1))
    assert all(r.ratio_voix_exprimes in (0.5, None, 0.0) for r in f)


def test_economy_fact(tables):
    e = {r.fk_commune: r for r in tables["FACT_ECONOMIE_LOCALE"].collect()}
    assert e[1].taux_chomage == 35 * 100.0 / 400 and e[1].nb_associations == 2
    assert e[4].taux_chomage is None                     # no workforce -> NULL


def test_quality_log_and_audit(tables):
    log = {r.id_check: r for r in tables["DATA_QUALITY_LOG"].collect()}
    assert sorted(log) == [r.id_check for r in RULES]
    assert log[17].statut == "FAIL" and log[17].nb_erreurs == 1     # duplicate current commune
    assert log[12].statut == "FAIL"                                   # 1 unknown of 5 rows
    assert log[5].nb_erreurs == 1
    audit = tables["META_CHARGEMENT"].orderBy("id_chargement").collect()
    assert [r.statut for r in audit] == ["IN_PROGRESS", "IN_PROGRESS", "SUCCESS", "SUCCESS"]
    assert [r.nb_lignes_rejetees for r in audit] == [None, None, 0, 0]
    rep = P.reports(tables)
    assert rep["fail_count"].first()[0] == sum(1 for r in log.values() if r.statut == "FAIL")
    assert rep["load_history"].first().id_chargement in (3, 4)


def test_end_rows_count_what_the_loads_read_and_stored(spark, raw_paths, tmp_path):
    raw = P.read_raw(spark, raw_paths, sep=";")
    tables = P.run(spark, raw, str(tmp_path), start_ts=TS, end_ts=TS, loads=lambda stored: [
        (raw["socio"], stored["socio_demo_communes"]), (stored["socio_demo_communes"], stored["FACT_POPULATION"])])
    n = [raw["socio"].count(), tables["socio_demo_communes"].count(), tables["FACT_POPULATION"].count()]
    end = [tuple(r) for r in tables["META_CHARGEMENT"].where("id_chargement > 2").orderBy("id_chargement")
           .select("nb_lignes_source", "nb_lignes_chargees", "nb_lignes_rejetees").collect()]
    assert n[0] > n[1] and end == [(n[0], n[1], n[0] - n[1]), (n[1], n[2], n[1] - n[2])]


def test_audit_log_counts_the_rows_of_its_run(spark, tmp_path):
    """Two labels of one commune give two facts; a row without a code is rejected."""
    for name, df in {
            "customer": spark.range(6, 11).select(F.when(F.col("id") < 10, F.col("id")).alias("c_custkey")),
            "orders": spark.createDataFrame([(1, 6, "F"), (2, 7, "F"), (3, 7, "O")], "o_orderkey long, o_custkey long, o_orderstatus string")
            .withColumns({"o_orderpriority": F.lit("1-URGENT"), "o_totalprice": F.lit(10.0)}),
            "lineitem": spark.sql("select 1L l_orderkey, 1L l_partkey, 1L l_suppkey, 2 l_linenumber, 4.0D l_quantity, 'A' l_returnflag, 'F' l_linestatus"),
            "events": spark.sql("select 1L event_id, 1L user_id, timestamp'2024-01-02' ts, 'view' event_type, 1.5D value")}.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    end = [tuple(r) for r in analogs.q_audit_log(spark, str(tmp_path)).where("statut = 'SUCCESS'").orderBy("id_chargement")
           .select("nb_lignes_source", "nb_lignes_chargees", "nb_lignes_rejetees").collect()]
    assert end == [(5, 4, 1), (4, 5, -1)]


def test_rerun_is_idempotent_and_logs_append(spark, raw_paths, tmp_path):
    raw = P.read_raw(spark, raw_paths, sep=";")
    wh = str(tmp_path / "wh")
    first = P.run(spark, raw, wh, start_ts=TS, end_ts=TS)
    n_results = first["FACT_RESULTATS_ELECTORAUX"].count()
    n_crime = first["criminalite_commune"].count()
    second = P.run(spark, raw, wh, start_ts=TS, end_ts=TS)
    assert second["FACT_RESULTATS_ELECTORAUX"].count() == n_results          # overwritten, not doubled
    assert second["criminalite_commune"].count() == n_crime
    assert second["META_CHARGEMENT"].count() == 8                             # audit appends
    assert second["DATA_QUALITY_LOG"].count() == 2 * len(RULES)


def test_wide_reordered_files(spark, raw_paths, tmp_path):
    """The same results from files with further columns in another order."""
    def widened(path):
        with open(path, encoding="utf-8", newline="") as f:
            data = list(csv.reader(f, delimiter=";"))
        out = tmp_path / path.rsplit("/", 1)[-1]
        return write_csv(out, ["more", *reversed(data[0]), "other"], [["m", *reversed(r), "o"] for r in data[1:]])

    wide = {k: [widened(x) for x in p] if isinstance(p, list) else widened(p) for k, p in raw_paths.items()}
    narrow, wide = P.read_raw(spark, raw_paths, sep=";"), P.read_raw(spark, wide, sep=";")
    for k in narrow:
        assert sorted(map(repr, narrow[k].collect())) == sorted(map(repr, wide[k].collect()))


def test_failed_load_is_logged(spark, raw_paths, tmp_path):
    raw = P.read_raw(spark, raw_paths, sep=";")
    raw["elections"] = raw["elections"].withColumn("inscrits", F.raise_error(F.lit("broken file")).cast("string")) \
        if "inscrits" in raw["elections"].columns else raw["elections"].drop(raw["elections"].columns[0])
    with pytest.raises(Exception):
        P.run(spark, raw, str(tmp_path), start_ts=TS)
    log = spark.read.parquet(f"{tmp_path}/governance/META_CHARGEMENT").orderBy("id_chargement").collect()
    assert [r.statut for r in log] == ["IN_PROGRESS", "IN_PROGRESS", "FAILED", "FAILED"]
    assert all(r.erreur_message for r in log[2:]) and all(r.date_chargement > TS for r in log[2:])


def test_end_rows_are_stamped_at_the_end(spark, raw_paths, tmp_path):
    tables = P.run(spark, P.read_raw(spark, raw_paths, sep=";"), str(tmp_path))
    at = {r.id_chargement: r.date_chargement for r in tables["META_CHARGEMENT"].collect()}
    assert at[3] > at[1] and tables["META_CHARGEMENT"].schema.fieldNames() == [f.name for f in GOV.AUDIT_SCHEMA]


def test_code_lists(tables):
    assert sorted((r.type_election, r.tour, r.annee_election) for r in tables["DIM_ELECTION"].collect())[0][1:] == (1, 2022)
    assert [r.code for r in tables["DIM_TYPE_RESULTAT_VOTE"].orderBy("id_type_resultat").collect()] == ["CANDIDAT", "BLANC", "NUL"]
    assert [r.code for r in tables["DIM_TYPE_PARTICIPATION"].orderBy("id_type_participation").collect()] == ["VOTANT", "ABSTENTION"]
