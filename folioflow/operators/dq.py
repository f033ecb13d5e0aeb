"""Data rules as columns: each row with the problems it has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.operators.journal import all_reasons


def location_problems(questions: DataFrame, documents: DataFrame) -> DataFrame:
    """(question_id, group_id, location, problem): evidence that is empty, backward, off its pages, without a
    key, named unlike its path, or in no known document. ``documents`` has document_id."""
    g = questions.select("question_id", F.explode("gold_evidence").alias("g")).select("question_id", "g.group_id", F.posexplode("g.locations").alias("location", "x"))
    known = documents.select(F.col("document_id").alias("known")).distinct()
    rows = g.join(known, F.col("x.document_id") == F.col("known"), "left")
    rules = [
        (F.col("known").isNull(), "unknown document"),
        (F.col("x.char_end") <= F.col("x.char_start"), "no length"),
        (F.col("x.char_start") < 0, "negative start"),
        (F.col("x.page_end") < F.col("x.page_start"), "pages backward"),
        (F.coalesce("x.key", F.lit("")) == "", "no key"),
        (F.col("x.key") != T.path_key(F.col("x.unit_path")), "key and path differ"),
        (~F.coalesce(F.col("x.text_sha256"), F.lit("")).rlike("^[0-9a-f]{64}$"), "no text hash"),
    ]
    return rows.select("question_id", "group_id", "location", F.explode(all_reasons(rules)).alias("problem"))


def question_problems(questions: DataFrame) -> DataFrame:
    """(question_id, problem): rules over one question and over all: repeated ids, evidence where there must
    be none or none where there must be, citations outside the evidence, facts that are only a number."""
    n = questions.groupBy("question_id").agg(F.count("*").alias("n")).where("n > 1").select("question_id", F.lit("repeated id").alias("problem"))
    some = F.size(F.coalesce("gold_evidence", F.array())) > 0
    keys = F.flatten(F.transform("gold_evidence", lambda g: F.transform(g["locations"], lambda x: F.struct(x["document_id"], x["key"]))))
    outside = F.exists("must_cite", lambda c: ~F.exists(keys, lambda k: (k["document_id"] == c["document_id"]) & (k["key"] == c["key"])))
    rules = [
        (F.trim(F.coalesce("question", F.lit(""))) == "", "no question"),
        (F.col("unanswerable") & some, "unanswerable with evidence"),
        (~F.col("unanswerable") & ~some, "answerable without evidence"),
        (~F.col("unanswerable") & F.coalesce(outside, F.lit(False)), "citation outside the evidence"),
        (F.exists("required_facts", lambda f: F.exists(f, lambda v: F.trim(v).rlike("^[0-9]+$"))), "fact is a number only"),
    ]
    each = questions.dropDuplicates(["question_id"]).select("question_id", F.explode(all_reasons(rules)).alias("problem"))
    return each.unionByName(n)


def wording_leaks(questions: DataFrame, evidence: DataFrame, most: float = 0.5) -> DataFrame:
    """(question_id, leakage): questions more than ``most`` of whose content words stand in their evidence
    (question_id, text)."""
    words = evidence.groupBy("question_id").agg(F.array_distinct(F.flatten(F.collect_list(T.content_words(F.col("text"))))).alias("words"))
    rows = questions.select("question_id", "question").distinct().join(words, "question_id")
    return rows.select("question_id", F.round(T.containment(T.content_words(F.col("question")), F.col("words")), 4).alias("leakage")).where(F.col("leakage") > most)


def span_text_differs(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """Spans (document_id, char_start, char_end, text_sha256) whose stretch of the document's text has
    another hash, or whose document has no text."""
    piece = F.substring(F.col("text"), F.col("char_start").cast("int") + 1, (F.col("char_end") - F.col("char_start")).cast("int"))
    return spans.join(texts.select("document_id", "text"), "document_id", "left").where(F.coalesce(F.sha2(piece, 256) != F.col("text_sha256"), F.lit(True))).drop("text")


def contradictions(labels: DataFrame, label: str, allowed: list[str]) -> DataFrame:
    """Rows whose label is none of those allowed, or that share their key with another label."""
    return labels.where(~F.coalesce(F.upper(label).isin(*allowed), F.lit(False)))


def unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key).distinct(), key, "left_anti")


def missing_locations(questions: DataFrame) -> DataFrame:
    """Evidence groups without a location."""
    g = questions.select("question_id", F.explode("gold_evidence").alias("g"))
    return g.where(F.size(F.coalesce("g.locations", F.array())) == 0).select("question_id", "g.group_id")

