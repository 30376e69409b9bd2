import json

import pytest
from pyspark.sql import functions as F

from wordloom import session
from wordloom.sources import readers, writers


def test_scan_and_stage(spark, tmp_path):
    for name, texts in {"automatable": ["a", None], "non_automatable": ["b"]}.items():
        readers.stage_parquet(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), str(tmp_path / name))
    again = spark.createDataFrame([(5, "other")], "doc_id bigint, text string")
    assert readers.stage_parquet(again, str(tmp_path / "automatable")).count() == 2
    assert readers.stage_parquet(again, str(tmp_path / "automatable"), append=True).count() == 3
    rows = readers.scan_corpus(spark, {n: str(tmp_path / n) for n in ("automatable", "non_automatable")})
    assert rows.groupBy("category").count().count() == 2 and rows.count() == 4


def test_category_rule(spark):
    df = spark.createDataFrame([("Automatable",), ("no",), (None,)], "x string")
    assert [r[0] for r in df.select(readers.category_of(F.col("x"))).collect()] == ["automatable", "non_automatable", "non_automatable"]


def test_windows_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"t\n\x93caf\xe9\x94 \x80\n")
    (tmp_path / "b.csv").write_bytes(b"t\n\x93x\x81\n\x93y\n")
    got = {r.t for r in readers.read_windows_csv(spark, str(tmp_path), "t string").collect()}
    assert got == {"\u201ccaf\u00e9\u201d \u20ac", "\x93x\x81", "\x93y"}


def test_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], [" no ", "DESCRIPTION"], )
    assert [tuple(r) for r in readers.numbered_descriptions(df).collect()] == [("1", ""), ("2", "x")]
    with pytest.raises(ValueError, match="missing columns: \\['b'\\]"):
        readers.require_columns(spark.createDataFrame([(1,)], ["a"]), ["a", "b"])


def test_network_round_trip(spark, tmp_path):
    keywords = spark.createDataFrame(
        [("c", 1, "y", [], False), ("c", 0, "x", [("y", 8.5)], True), ("d", 0, "z", [], False)],
        "category string, pos bigint, keyword string, nested array<struct<keyword: string, weight: double>>, is_sufficient boolean")
    sequences = spark.createDataFrame([("c", 0, ["x", "y", "z"], True)], "category string, pos bigint, sequence array<string>, is_sufficient boolean")
    path = str(tmp_path / "net")
    writers.write_network(writers.network_documents(keywords, sequences), path)
    net = readers.read_network(spark, path)
    rows = {(r.category, r.pos): (r.keyword, r.nested, r.is_sufficient) for r in readers.network_keywords(net).collect()}
    assert rows == {("c", 0): ("x", ["y"], True), ("c", 1): ("y", [], False), ("d", 0): ("z", [], False)}
    seq = readers.network_sequences(net).collect()
    assert [r.nested_sequences for r in seq] == [[["x", "y"], ["y", "z"], ["x", "y", "z"]]]

    (tmp_path / "array.json").write_text(json.dumps([{"Category": "e", "Keywords": [], "Sequences": []}, {"Category": "f", "Keywords": [
        {"keyword": "k", "nested_keywords": [{"keyword": "n", "weight": 9}], "is_sufficient": True}], "Sequences": []}], indent=4))
    whole = readers.read_network(spark, str(tmp_path / "array.json"), lines=False)
    assert [(r.category, r.keyword, r.nested) for r in readers.network_keywords(whole).collect()] == [("f", "k", ["n"])]


def test_network_rows_do_not_grow_with_the_network(spark, tmp_path):
    keywords = spark.range(500).selectExpr(
        "'c' category", "id pos", "concat('k', id) keyword", "array(named_struct('keyword', 'n', 'weight', 9D)) nested", "id % 2 = 0 is_sufficient")
    sequences = spark.range(300).selectExpr("'c' category", "id pos", "array('x', concat('k', id)) sequence", "true is_sufficient")
    rows = writers.network_documents(keywords, sequences)
    assert rows.count() == 800
    path = str(tmp_path / "net")
    writers.write_network(rows, path)
    assert max(len(r.value) for r in spark.read.text(path).collect()) < 200
    net = readers.read_network(spark, path)
    found = sorted((r.pos, r.keyword, r.nested, r.is_sufficient, r.category) for r in readers.network_keywords(net).collect())
    assert found == [(i, f"k{i}", ["n"], i % 2 == 0, "c") for i in range(500)]
    assert sorted((r.pos, r.sequence[1]) for r in readers.network_sequences(net).collect()) == [(i, f"k{i}") for i in range(300)]


def test_scan_documents_and_reports(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.Txt").write_bytes("été".encode())
    (tmp_path / "in" / "b").write_text("plain")
    rows = {r.file_type: (r.content, r.file_size) for r in readers.scan_documents(spark, str(tmp_path / "in")).collect()}
    assert rows == {"TXT": ("été", 5), "": ("plain", 5)}
    lines = spark.createDataFrame([(2, "b"), (1, "a")], "n int, line string")
    writers.write_report_lines(lines, "line", str(tmp_path / "out"), ["n"])
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect() if r.value) == ["a", "b"]
    writers.write_report_lines(lines, "line", str(tmp_path / "headed"), ["n"], "Results")
    files = sorted((tmp_path / "headed").glob("part-*"))
    assert "".join(f.read_text() for f in files) == "Results\n\na\n\nb\n\n"


def test_result_table_keeps_input_columns(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "id int, text string")
    results = spark.createDataFrame([(1, True)], "id int, ok boolean")
    writers.write_results(rows, results, ["id"], str(tmp_path / "r"))
    assert sorted((r.id, r.text, r.ok) for r in spark.read.parquet(str(tmp_path / "r")).collect() if r.text) == [(1, "a", True)]
    assert spark.read.parquet(str(tmp_path / "r")).filter("id = 2 AND ok IS NULL").count() == 2
    with pytest.raises(ValueError, match="text"):
        writers.write_results(rows, results.withColumn("Text", F.lit(1)), ["id"], str(tmp_path / "s"))


def test_corpus_from_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('doc_id,text,more\n1,"one, ""two""\nthree",x\n2,,y\n')
    (tmp_path / "b.csv").write_text("doc_id,text,more\n3,four,z\n")
    paths = {"a": str(tmp_path / "a.csv"), "b": str(tmp_path / "b.csv")}
    rows = readers.scan_corpus(spark, paths, schema="doc_id bigint, text string, more string", format="csv").collect()
    assert sorted((r.doc_id, r.category, r.text) for r in rows) == [(1, "a", 'one, "two"\nthree'), (2, "a", None), (3, "b", "four")]
    with pytest.raises(ValueError, match="schema"):
        readers.scan_corpus(spark, paths, format="csv")


def test_staging_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        assert session.shared_dir(spark) == named.rstrip("/")
    assert session.stage(spark.range(5), "five").count() == 5


def test_spread_leaves_wide_inputs_alone(spark):
    wide = spark.range(0, 100, 1, 64)
    assert session.spread(wide) is wide
    assert session.spread(wide.coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
