import pytest

from profilematch import Index, search
from profilematch.sources import artefacts, dictionaries, results, tables


def test_term_map_rules(spark, tmp_path):
    path = tmp_path / "map.txt"
    path.write_text("x\t1\ny\t2\nno tab here\nx\t3\nk\ta\tb\n pad \t v \n\tonly\n", encoding="utf8")
    found = {r.term: r.replacement for r in dictionaries.read_term_map(spark, str(path)).collect()}
    assert found == {"x": "3", "y": "2", "k": "a\tb", " pad ": " v ", "": "only"}
    stripped = {r.term: r.replacement for r in dictionaries.read_term_map(spark, str(path), strip=True).collect()}
    assert stripped == {"x": "3", "y": "2", "k": "a\tb", "pad ": " v"}


def test_fallbacks(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("một\nhai\nmột\n\n", encoding="utf8")
    d = dictionaries.load_dictionaries(spark, stop=[str(tmp_path / "none.txt"), str(path)])
    assert {r.term for r in d.stop.collect()} == {"một", "hai", ""}
    assert d.slang.where("term = 'ko'").first().replacement == "không"
    assert d.english.count() == 4 and d.wrong.count() == 5
    assert dictionaries.load_word_list(spark, []).count() == 0


def test_result_files(spark, tmp_path):
    (tmp_path / "r.csv").write_text(",Accuracy\nForest,0.5\nKNN,0.75\n")
    (tmp_path / "r.json").write_text('{\n "One": 0.25,\n "Two": 1.0\n}')
    (tmp_path / "m.json").write_text(
        '{\n"best_model": "KNN", "best_accuracy": 0.75,\n"sklearn_models": ["Forest", "KNN"], "pyspark_models": []}'
    )
    assert [tuple(r) for r in results.read_results_csv(spark, str(tmp_path / "r.csv")).collect()] == [
        ("Forest", 0.5),
        ("KNN", 0.75),
    ]
    assert {tuple(r) for r in results.read_results_json(spark, str(tmp_path / "r.json")).collect()} == {
        ("One", 0.25),
        ("Two", 1.0),
    }
    assert results.read_training_meta(spark, str(tmp_path / "m.json")).first().sklearn_models == ["Forest", "KNN"]
    from profilematch.plans.reports import model_report

    report = model_report(spark, *[str(tmp_path / f) for f in ("r.csv", "r.json", "m.json")])
    assert report["results"].count() == 4
    assert report["best"].first().best_accuracy_text == "75.00%"
    assert report["computed_best"].first().best_model == "Two"


def test_companies_csv(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('id,Company Name,"Why you\'ll love working here",Country\n0,A,"two\nlines",VN\n1,B,x,\n')
    df = tables.read_companies(spark, str(path), "csv")
    assert df.columns == ["id", "company_name", "why_youll_love_working_here", "country"]
    assert [r.id for r in df.orderBy("id").collect()] == [0, 1]
    assert df.where("id = 0").first().why_youll_love_working_here == "two\nlines"
    path.write_text("id,Company Name\n0,A\n0,B\n")
    with pytest.raises(ValueError, match="not a key"):
        tables.read_companies(spark, str(path), "csv")


def test_index_round_trip(spark, indexes, tmp_path):
    path = str(tmp_path / "index")
    indexes["A"].save(path)
    asked = spark.createDataFrame([(1, "python cloud")], "request_id long, query_text string")
    before = search(indexes["A"], asked, 4).collect()
    loaded = Index.load(spark, path)
    assert loaded.formula == "log2" and sorted(search(loaded, asked, 4).collect()) == sorted(before)
    with pytest.raises(FileNotFoundError):
        Index.load(spark, str(tmp_path / "nothing"))
    artefacts.write_results(loaded.vocab, str(tmp_path / "out"), ["term", "df"])
    assert spark.read.parquet(str(tmp_path / "out")).columns == ["term", "df"]
