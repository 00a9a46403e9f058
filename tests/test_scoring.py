from pyspark.sql import functions as F

from agora.operators.scoring import (CANDIDATS, LinearModel, candidate_scores, dummy_name,
                                     expand_candidates, one_hot_align, predict_scores, ranking,
                                     vote_allocation, winners)
from agora.sources.ingest import ingest_summary, landed_listing, landing_report, manifest_frame

MODEL = LinearModel(10.0, {"a": 2.0, "b": -1.0, dummy_name(CANDIDATS[0]): 5.0,
                           dummy_name(CANDIDATS[3]): 5.0, dummy_name("OTHER"): 3.0})


def scen(spark):
    return spark.createDataFrame([("c1", 1.0, 2.0, 1000.0), ("c2", 0.0, 10.0, 500.0)],
                                 "commune string, a double, b double, population_totale_2022 double")


def test_one_hot_align_then_linear_equals_analytic_scores(spark):
    s = scen(spark)
    aligned = one_hot_align(expand_candidates(s), "nom_complet", MODEL.model_columns,
                            keep=["commune", "ordinal"])
    assert aligned.columns == ["commune", "ordinal", *MODEL.model_columns]
    by_hand = aligned.select("commune", "ordinal", F.bround(MODEL.expression(
        {c: F.col(c) for c in MODEL.model_columns}), 4).alias("s"))
    scored = predict_scores(s, MODEL).select("commune", "ordinal", F.col("score_brut_modele").alias("s"))
    assert sorted(map(tuple, by_hand.collect())) == sorted(map(tuple, scored.collect()))


def test_allocation_ranking_and_winner(spark):
    s = scen(spark)
    alloc = {(r.commune, r.candidat): r for r in vote_allocation(s, MODEL).collect()}
    c1 = [alloc[("c1", c)] for c in CANDIDATS]
    total = sum(r.score_brut_modele for r in c1)
    for r in c1:
        assert r.voix_predites_estimees == int(round(r.score_brut_modele / total * 1000.0))
    # c2: score 0 for most candidates, ties keep list order
    ranked = ranking(s, MODEL)
    c2 = [r for r in ranked.orderBy("commune", "rang").collect() if r.commune == "c2"]
    assert [r.rang for r in c2] == list(range(1, 13))
    assert c2[0].candidat == CANDIDATS[0] and c2[1].candidat == CANDIDATS[3]
    w = {r.commune: r for r in winners(ranked).collect()}
    assert w["c2"].gagnant_predit == CANDIDATS[0]
    assert w["c2"].famille_politique_gagnant == "Extrême gauche"


def test_zero_total_gives_null_votes(spark):
    s = spark.createDataFrame([("z", -10.0, 0.0, 100.0)],
                              "commune string, a double, b double, population_totale_2022 double")
    m = LinearModel(20.0, {"a": 2.0})
    assert all(r.voix_predites_estimees is None for r in vote_allocation(s, m).collect())


def test_landing_report_from_binary_files(spark, tmp_path):
    root = tmp_path / "datalake"
    (root / "raw_2" / "elections").mkdir(parents=True)
    (root / "raw_2" / "elections" / "a.csv").write_bytes(b"12345")
    manifest = manifest_frame(spark, [
        {"category": "elections", "filename": "a.csv", "url": "http://x/a.csv"},
        {"category": "elections", "filename": "b.csv", "url": "http://x/b.csv"}])
    landed = landed_listing(spark, str(root), bucket="datalake")
    rep = {r.dataset: r for r in landing_report(manifest, landed, bucket="datalake",
                                                prefix="raw_2").collect()}
    assert rep["a.csv"].status == "OK" and rep["a.csv"].size_bytes == 5
    assert rep["a.csv"].object_path == "datalake/raw_2/elections/a.csv"
    assert rep["b.csv"].status == "ERREUR_DOWNLOAD" and rep["b.csv"].error
    summary = {r.status: r for r in ingest_summary(landing_report(
        manifest, landed, "datalake", "raw_2")).collect()}
    assert summary["OK"].nb_fichiers == 1 and summary["OK"].nb_total == 2
