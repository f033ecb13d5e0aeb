"""Readers and writers on files made here."""

import json

from pyspark.sql import functions as F

from folioflow.sources import readers, writers


def test_processed_documents_and_pages(spark, tmp_path):
    doc = lambda i, v, pages: {"schema_version": v, "source": {"document_id": i}, "pages": pages, "structure": {"confidence": "partial", "line_count": 1}}
    p = [{"page_number": 1, "text": "a"}, {"page_number": 2, "text": "b", "text_source": "ocr", "indexable": False, "ocr": {"text": "B", "accepted": True}}]
    for i, d in enumerate([doc("x", 2, p), doc("y", 9, p), doc("z", 1, [{**p[0], "indexable": False}])]):
        (tmp_path / f"{i}.json").write_text(json.dumps(d, indent=1))
    sound, refused = readers.processed_documents(spark, str(tmp_path))
    assert {r["source"]["document_id"] for r in refused.collect()} == {"y"}
    pages = readers.pages(sound)
    got = {(r["document_id"], r["page_number"]): (r["selected_text"], r["missing"]) for r in pages.collect()}
    assert got["x", 1] == ("a", ["ocr", "quality", "text_source"]) and got["x", 2][0] == "B"
    assert {(r["document_id"], r["page_number"]) for r in readers.assessed_pages(pages).collect()} == {("x", 1), ("z", 1)}


def test_predictions_are_checked(spark, tmp_path):
    sub = {"system": "s", "split": "dev", "predictions": {"q1": {"10": [["d", 0, 5], ["d", 9, 3]], "20": []}, "q9": {"10": [], "20": []}, "q2": {"10": [["d", 1, 2]]}}}
    (tmp_path / "p.json").write_text(json.dumps(sub))
    asked = spark.createDataFrame([("q1",), ("q2",), ("q3",)], "question_id string")
    spans, problems = readers.predictions(spark, str(tmp_path / "p.json"), asked, [10, 20])
    assert {(r["question_id"], r["budget"], r["rank"], r["start"], r["end"]) for r in spans.collect()} == {("q1", 10, 1, 0, 5), ("q2", 10, 1, 1, 2)}
    assert {tuple(r) for r in problems.collect()} == {("q9", "unknown question"), ("q3", "no entry"), ("q1", "bad span"), ("q2", "missing budget")}


def test_lists_labels_targets_and_journals(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("a\n# note\n\n b # why\n")
    assert {r[0] for r in readers.listed_ids(spark, str(tmp_path / "ids.txt")).collect()} == {"a", "b"}
    (tmp_path / "l.csv").write_text("document_id,page_number,label,legal_critical_errors,notes\nd,1,good,\"x; y\",\nd,2,,,\n")
    assert [(r["label"], r["legal_critical_errors"]) for r in readers.labels(spark, str(tmp_path / "l.csv")).collect()] == [("GOOD", ["x", "y"])]
    kinds = {"rule": "rules"}
    (tmp_path / "t.csv").write_text("url,type,parent_url\nu1,Rule,\n ,rule,\n")
    (tmp_path / "t.json").write_text(json.dumps([{"url": "u2", "type": "rule"}]))
    (tmp_path / "u.json").write_text(json.dumps({"documents": [{"url": "u3", "type": "other"}]}))
    got = [(r["url"], r["category"]) for f in ("t.csv", "t.json", "u.json") for r in readers.targets(spark, str(tmp_path / f), kinds).collect()]
    assert got == [("u1", "rules"), ("u2", "rules"), ("u3", None)]
    (tmp_path / "j.jsonl").write_text('{"document_id":"a","status":"ok"}\n\n{"bro\n{"status":"x"}\n')
    assert [r["document_id"] for r in readers.journal(spark, str(tmp_path / "j.jsonl")).collect()] == ["a"]


def test_files_and_tables(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f/a.pdf").write_bytes(b"%PDF-1.4" + b"x" * 200 + b"%%EOF")
    (tmp_path / "f/b.pdf").write_bytes(b"<html>" + b"x" * 200)
    (tmp_path / "f/c.pdf").write_bytes(b"%PDF")
    assert {r["path"][-5:]: r["problem"] for r in readers.pdf_problems(spark, str(tmp_path / "f")).collect()} == {"b.pdf": "no header", "c.pdf": "short"}
    assert [r["bytes"] for r in readers.checksums(spark, str(tmp_path / "f")).collect()] == [213, 206, 4]
    df = spark.createDataFrame([("a", "=x"), ("b", "y")], "document_id string, t string")
    assert {r[0] for r in writers.unbuilt(df, df.where("t = 'y'")).collect()} == {"a"} and writers.unbuilt(df, df, force=True).count() == 2
    writers.write_review_csv(df, str(tmp_path / "r"))
    assert {r["t"] for r in spark.read.option("header", True).csv(str(tmp_path / "r")).collect()} == {"'=x", "y"}
    writers.write_table(df, str(tmp_path / "t"), ["document_id"])
    assert spark.read.parquet(str(tmp_path / "t")).where(F.col("document_id") == "a").count() == 1
    writers.write_json_lines(df, str(tmp_path / "j"), ["document_id"])
    assert [r[0] for r in spark.read.text(str(tmp_path / "j")).collect()][0] == '{"document_id":"a","t":"=x"}'
