"""Raw CSV files by column name, the landing audit on real files, scenarios."""
import json

import pytest
from pyspark.sql import functions as F

from agora.operators.scoring import (CANDIDATS, SCENARIO_FEATURES, SCENARIO_SCHEMA, LinearModel, predict_scores, ranking,
                                     read_scenarios, score_with_pipeline, winners)
from agora.sources.ingest import landed_listing, landing_report, manifest_frame
from agora.sources.raw import file_headers, read_text_csv
from conftest import rows


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_columns_are_found_by_name(spark, tmp_path):
    a = write(tmp_path / "a.csv", "x;code;y;position\n1;01001;2;A\n")
    b = write(tmp_path / "b.csv", "position;code\nD;92004\n")
    c = write(tmp_path / "c.csv", "code;position;z\n93001;;9\n")
    got = read_text_csv(spark, [a, b, c], ["code", "position"], sep=";")
    assert got.dtypes == [("code", "string"), ("position", "string")]
    assert rows(got) == sorted([("01001", "A"), ("92004", "D"), ("93001", None)], key=repr)
    with pytest.raises(ValueError, match="b.csv has no column x"):
        read_text_csv(spark, [a, b], ["code", "x"], sep=";")


def test_a_folder_is_read_as_the_list_of_its_files(spark, tmp_path):
    """Swapped, missing and further columns, a byte order mark, odd names, an empty file."""
    made = {"a.csv": "code,n,x\n92002,2,é\n", "b 2.csv": "n,code\n3,92003\n", "c[1]{x}.csv": "\ufeffcode,n\n92004,4\n",
            "d%20.csv": "y,n,code\n9,5,92005\n", "e.csv": "", "f.csv": "code,n,x\n", "g.csv": '\n"n","co""de",code\n6,z,92006\n',
            "h.csv": "code,n\n" + "1,1\n" * 5000}
    files = [write(tmp_path / "raw" / name, text) for name, text in made.items()]
    want = sorted([(f"9200{i}", str(i)) for i in range(2, 7)] + [("1", "1")] * 5000)
    for paths in (str(tmp_path / "raw"), str(tmp_path / "raw" / "*.csv"), [str(tmp_path / "r?w"), ]):
        assert rows(read_text_csv(spark, paths, ["code", "n"])) == want
    listed = [f for f in files if "[" not in f and "{" not in f]  # a path given is a pattern
    assert rows(read_text_csv(spark, listed, ["code", "n"])) == [w for w in want if w[0] != "92004"]
    assert file_headers(spark, str(tmp_path / "raw")).count() == 7
    write(tmp_path / "raw" / "z.csv", "n,cod\n1,2\n")
    with pytest.raises(ValueError, match="z.csv has no column code"):
        read_text_csv(spark, str(tmp_path / "raw"), ["code", "n"])
    write(tmp_path / "twice" / "t.csv", "n,code,code\n1,2,3\n")
    with pytest.raises(ValueError, match="more than one column code"):
        read_text_csv(spark, str(tmp_path / "twice"), ["code"])
    write(tmp_path / "none" / "t.csv", "")
    with pytest.raises(ValueError, match="no file with a header"):
        read_text_csv(spark, str(tmp_path / "none"), ["code"])


def test_headers_in_another_encoding(spark, tmp_path):
    for name, text in {"a.csv": "libellé;n\nÉvry;1\n", "b.csv": "n;libellé\n2;Sèvres\n"}.items():
        write(tmp_path / "l" / name, "")
        (tmp_path / "l" / name).write_text(text, encoding="latin-1")
    assert rows(read_text_csv(spark, str(tmp_path / "l"), ["libellé", "n"], sep=";", encoding="ISO-8859-1")) == [("Sèvres", "2"), ("Évry", "1")]


def test_quotes_line_breaks_and_no_header(spark, tmp_path):
    p = write(tmp_path / "q.csv", 'n,code\n"a ""b"",\nc",1\n')
    assert rows(read_text_csv(spark, p, ["code", "n"], multi_line=True)) == [("1", 'a "b",\nc')]
    p = write(tmp_path / "plain.csv", "01,x\n02,y\n")
    assert rows(read_text_csv(spark, p, ["code", "n"], header=False)) == [("01", "x"), ("02", "y")]


def test_landing_below_a_nested_root(spark, tmp_path):
    root = tmp_path / "data" / "sub" / "data"
    write(root / "raw_2" / "c" / "f.csv", "abc")
    write(root / "raw_2" / "c" / "empty.csv", "")
    manifest = manifest_frame(spark, [{"category": "c", "filename": n, "url": n} for n in ("f.csv", "empty.csv", "never.csv")])
    for given in (str(root), f"file://{root}/", f"file:{root}"):
        report = landing_report(manifest, landed_listing(spark, given, "data"), "data", "raw_2")
        assert rows(report, "dataset", "status", "object_path", "size_bytes") == sorted([
            ("f.csv", "OK", "data/raw_2/c/f.csv", 3), ("empty.csv", "OK", "data/raw_2/c/empty.csv", 0),
            ("never.csv", "ERREUR_DOWNLOAD", None, None)], key=repr)
    with pytest.raises(ValueError, match="absolute"):
        landed_listing(spark, "data", "data")


def test_folders_are_listed_level_by_level(spark, tmp_path):
    root = tmp_path / "zone é%20"
    want = {}
    for i in range(30):
        name = f"raw/c{i % 3}/d {i % 5}/f{i},é.csv"
        write(root / name, "x" * i)
        want[f"zone/{name}"] = i
    for hidden in ("raw/_tmp/f", "raw/.git/f", "raw/c0/_SUCCESS"):
        write(root / hidden, "abc")
    (root / "raw" / "empty").mkdir()
    for given in (str(root), f"file://{root}"):
        got = landed_listing(spark, given, "zone").collect()
        assert {r.object_path: r.length for r in got} == want and len(got) == 30
        assert all((tmp_path / r.path).exists() for r in got)
    (tmp_path / "nothing").mkdir()
    assert landed_listing(spark, str(tmp_path / "nothing"), "b").count() == 0


def scenarios_file(tmp_path):
    full = {"commune": "full", **{f: 2.0 for f in SCENARIO_FEATURES}}
    lacking = {k: v for k, v in full.items() if k != "taux_hlm"} | {"commune": "lacking"}
    return write(tmp_path / "s.json", "\n".join(json.dumps(x) for x in (full, lacking, {"commune": "none"})))


def test_incomplete_scenarios_are_rejected_not_filled(spark, tmp_path):
    s = read_scenarios(spark, scenarios_file(tmp_path))
    assert s.drop("statut").schema == SCENARIO_SCHEMA and len(SCENARIO_FEATURES) == 14
    assert rows(s, "commune", "statut") == [("full", "OK"), ("lacking", "REJETE"), ("none", "REJETE")]
    model = LinearModel(1.0, {f: 0.5 for f in SCENARIO_FEATURES})
    scored = predict_scores(s, model).collect()
    assert len(scored) == 3 * len(CANDIDATS)
    assert {(r.statut, r.score_brut_modele) for r in scored} == {("OK", 15.0), ("REJETE", None)}
    ranked = ranking(s, model)
    assert ranked.where("statut = 'REJETE' and voix_predites_estimees is not null").count() == 0
    assert rows(winners(ranked), "commune", "gagnant_predit") == sorted(
        [("full", CANDIDATS[0]), ("lacking", None), ("none", None)], key=repr)


def test_fitted_pipeline_model(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.regression import LinearRegression

    train = spark.range(240).select(*[(F.rand(i) * 10).alias(f) for i, f in enumerate(SCENARIO_FEATURES)],
                                    F.element_at(F.array(*map(F.lit, CANDIDATS)), (F.col("id") % 12 + 1).cast("int")).alias("nom_complet"))
    train = train.withColumn("y", F.col(SCENARIO_FEATURES[0]) * 3 + 5 + F.when(F.col("nom_complet") == CANDIDATS[3], 7).otherwise(0))
    model = Pipeline(stages=[StringIndexer(inputCol="nom_complet", outputCol="i"), OneHotEncoder(inputCol="i", outputCol="o"),
                             VectorAssembler(inputCols=[*SCENARIO_FEATURES, "o"], outputCol="features"),
                             LinearRegression(labelCol="y")]).fit(train)
    got = {(r.commune, r.candidat): r.score_brut_modele
           for r in score_with_pipeline(read_scenarios(spark, scenarios_file(tmp_path)), model).collect()}
    assert len(got) == 3 * len(CANDIDATS)
    assert abs(got["full", CANDIDATS[0]] - 11) < 0.01 and abs(got["full", CANDIDATS[3]] - 18) < 0.01
    assert got["lacking", CANDIDATS[0]] is None
