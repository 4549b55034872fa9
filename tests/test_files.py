"""Readers, sinks and the stream on small trees of files."""

import csv

import pytest
from pyspark.sql import functions as F

from docloom.sources import readers, writers
from docloom.streaming import texts


@pytest.fixture
def tree(tmp_path):
    files = {"a (1)/x.txt": "\ufeffone\ntwo", "a (1)/deep/y.TXT": "three", "z.txt": "four", "empty.txt": "", "no.csv": "x", "b/w.text": "no"}
    for name, body in files.items():
        p = tmp_path / "in.d" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(body, encoding="utf-8")
    return tmp_path / "in.d"


def test_texts_of_a_tree(spark, tree):
    got = {r["file_name"]: r for r in readers.read_texts(spark, str(tree)).collect()}
    assert {k: r["text"] for k, r in got.items()} == {"x.txt": "one\ntwo", "y.TXT": "three", "z.txt": "four"}
    assert (got["x.txt"]["rel_dir"], got["y.TXT"]["rel_dir"], got["z.txt"]["rel_dir"]) == ("a (1)", "a (1)/deep", "")
    one = readers.read_texts(spark, str(tree / "a (1)" / "deep")).collect()
    assert [r["text"] for r in one] == ["three"]


def test_binary_documents(spark, tmp_path):
    for name in ("b.PDF", "a.docx", "c.txt", "d.xls"):
        (tmp_path / name).write_bytes(b"x")
    assert sorted(r["suffix"] for r in readers.find_documents(spark, str(tmp_path)).collect()) == ["docx", "pdf", "xls"]
    with pytest.raises(RuntimeError):
        readers.require("pdf")


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", 'say "x"', None), ("", "2", "3")], "`file name` string, v string, w string")
    writers.write_csv(df.coalesce(1), str(tmp_path / "out"))
    writers.write_csv(df.coalesce(1), str(tmp_path / "out"))  # a second time replaces the first
    (part,) = (tmp_path / "out").glob("part-*")
    raw = part.read_text(encoding="utf-8")
    assert raw.startswith("\ufeff") or raw.startswith('"\ufeff')
    assert list(csv.reader(raw.lstrip("\ufeff").replace('"\ufeff', '"').splitlines(keepends=True)))[1][:2] == ["a\nb", 'say "x"']
    plain = tmp_path / "s.csv"
    plain.write_text('"file name","v"\n"a\nb",\n"c","x, ""y"""\n', encoding="utf-8")
    assert [tuple(r) for r in readers.read_summary(spark, str(plain)).collect()] == [("a\nb", ""), ("c", 'x, "y"')]


def test_rules_of_both_kinds(tmp_path):
    (tmp_path / "r.yaml").write_text("steps:\n  - op: strip\n", encoding="utf-8")
    (tmp_path / "r.dsl").write_text("\ufeffv:\n", encoding="utf-8")
    assert readers.read_rules(str(tmp_path / "r.dsl")) == "v:\n"
    pytest.importorskip("yaml")
    assert readers.read_rules(str(tmp_path / "r.yaml")) == [{"op": "strip"}]


def test_text_tree(spark, tmp_path):
    df = spark.createDataFrame([("p", "x.txt", "one\ntwo"), ("q", "y.txt", "three")], "rel_dir string, file_name string, text string")
    writers.write_texts(df, str(tmp_path / "t"))
    (part,) = (tmp_path / "t" / "rel_dir=p" / "file_name=x.txt").glob("part-*")
    assert part.read_text() == "one\ntwo\n"


def test_json_drops_blank_lines(spark):
    df = spark.createDataFrame([(1, "a\n \nb", None)], "i long, t string, n string")
    assert writers.json_lines(df).first()["value"] == '{"i":1,"t":"a\\nb","n":null}'


def test_log(spark):
    df = spark.createDataFrame([("f", 3, None), ("g", None, "broken")], "path string, pages int, error string")
    rows = [tuple(r)[1:] for r in writers.extraction_log(df).orderBy("file").collect()]
    assert rows == [("f", 3, "OK", ""), ("g", 0, "FAIL", "broken")]


def test_stream_of_texts(spark, tree, tmp_path):
    script = 'v:\n    search text : "two"\n    if found :\n        set("has two")\n'
    q = texts.stream_fields(spark, str(tree / "a (1)"), script).writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = [r["v"] for r in spark.read.parquet(str(tmp_path / "o")).where(F.col("v").isNotNull()).collect()]
    assert got == ["has two"]
