"""Readers: tables, processed documents, pages, questions, predictions, labels, id lists, targets, journals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators.journal import parsed
from folioflow.sources import schemas


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def processed_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, refused): records of a known schema version, and those of another or without a structure."""
    rows = spark.read.schema(schemas.PROCESSED).option("multiLine", True).json(path)
    sound = F.coalesce(F.col("schema_version").isin(*schemas.VERSIONS), F.lit(False)) & F.col("structure").isNotNull()
    return rows.where(sound), rows.where(~sound)


def pages(documents: DataFrame) -> DataFrame:
    """One row a page, with the defaults of optional fields, the reading that counts, and the names of the
    optional fields that the page lacks. Scanned text counts only if it is named as the source and not empty."""
    p = documents.select(F.col("source.document_id").alias("document_id"), F.explode("pages").alias("p")).select("document_id", "p.*")
    absent = F.array_sort(F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in ("text_source", "ocr", "quality")])))
    p = p.withColumn("missing", absent).withColumn("text_source", F.coalesce("text_source", F.lit("backend"))).withColumn("indexable", F.coalesce("indexable", F.lit(True)))
    return p.withColumn("selected_text", F.when((F.col("text_source") == "ocr") & (F.length("ocr.text") > 0), F.col("ocr.text")).otherwise(F.coalesce("text", F.lit(""))))


def assessed_pages(all_pages: DataFrame) -> DataFrame:
    """The indexable pages of each document, or all of one that has none."""
    some = all_pages.groupBy("document_id").agg(F.bool_or("indexable").alias("some"))
    return all_pages.join(some, "document_id").where(F.col("indexable") | ~F.col("some")).drop("some")


def questions(spark: SparkSession, path: str, verified: bool = False) -> DataFrame:
    rows = spark.read.schema(schemas.QUESTION).option("multiLine", True).json(path)
    return rows.where("provenance.status = 'verified'") if verified else rows


def predictions(spark: SparkSession, path: str, asked: DataFrame, budgets: list[int]) -> tuple[DataFrame, DataFrame]:
    """(spans, problems) of a submission: (question_id, budget, rank, document_id, start, end) of the sound
    entries; (question_id, problem) of unknown questions, missing budgets and bad spans, and of questions
    without an entry."""
    rows = spark.read.schema(schemas.PREDICTIONS).option("multiLine", True).json(path).select(F.explode("predictions").alias("question_id", "by_budget"))
    each = rows.select("question_id", F.explode("by_budget").alias("budget", "spans")).select("question_id", F.col("budget").try_cast("bigint").alias("budget"), F.posexplode("spans").alias("n", "s"))
    spans = each.select("question_id", "budget", (F.col("n") + 1).alias("rank"), F.try_element_at("s", F.lit(1)).alias("document_id"), F.try_element_at("s", F.lit(2)).try_cast("bigint").alias("start"), F.try_element_at("s", F.lit(3)).try_cast("bigint").alias("end"))
    sound = F.col("document_id").isNotNull() & F.coalesce((F.col("start") >= 0) & (F.col("end") >= F.col("start")), F.lit(False))
    ids = asked.select("question_id").distinct()
    problems = [
        rows.join(ids, "question_id", "left_anti").select("question_id", F.lit("unknown question").alias("problem")),
        ids.join(rows, "question_id", "left_anti").select("question_id", F.lit("no entry").alias("problem")),
        spans.where(~sound).select("question_id", F.lit("bad span").alias("problem")).distinct(),
        rows.where(~F.forall(F.array(*[F.lit(str(b)) for b in budgets]), lambda b: F.array_contains(F.map_keys("by_budget"), b))).select("question_id", F.lit("missing budget").alias("problem")),
    ]
    out = problems[0]
    for p in problems[1:]:
        out = out.unionByName(p)
    return spans.where(sound), out


def labels(spark: SparkSession, path: str) -> DataFrame:
    """Reviewers' labels from CSV: upper case, errors as an array; unlabelled rows are dropped."""
    rows = spark.read.schema(schemas.LABELS).option("header", True).csv(path)
    rows = rows.withColumn("document_id", F.regexp_replace("document_id", "^﻿", "")).withColumn("label", F.upper(F.trim("label")))
    errors = F.filter(F.transform(F.split(F.coalesce("legal_critical_errors", F.lit("")), "[,;]"), lambda x: F.trim(x)), lambda x: x != "")
    return rows.where(F.coalesce("label", F.lit("")) != "").withColumn("legal_critical_errors", errors)


def listed_ids(spark: SparkSession, path: str, name: str = "document_id") -> DataFrame:
    """One id a line; blank lines and what follows a # are ignored."""
    bare = F.trim(F.regexp_replace("value", "#.*$", ""))
    return spark.read.text(path).select(bare.alias(name)).where(F.col(name) != "")


def targets(spark: SparkSession, path: str, kinds: dict[str, str]) -> DataFrame:
    """(url, type, parent_url, category) from CSV, or from JSON as a list or under ``documents``."""
    if path.endswith(".csv"):
        rows = spark.read.schema(schemas.TARGETS).option("header", True).csv(path)
    else:
        text = spark.read.text(path, wholetext=True)
        rows_ddl = f"array<struct<{schemas.TARGETS.replace(' string', ':string')}>>"
        listed = F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", rows_ddl)).otherwise(F.from_json("value", f"documents {rows_ddl}")["documents"])
        rows = text.select(F.explode(listed).alias("x")).select("x.*")
    known = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return rows.where(F.trim("url") != "").withColumn("category", known[F.lower("type")])


def journal(spark: SparkSession, path: str) -> DataFrame:
    return parsed(spark.read.text(path), schemas.JOURNAL, "document_id")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, bytes) of every file under a folder, in order."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes")).orderBy("path")


def pdf_problems(spark: SparkSession, path: str) -> DataFrame:
    """(path, problem) of files that are no whole PDF: too short, no header, no trailer in the last 2 KB."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    head, tail = F.substring(F.col("content"), 1, 1024).cast("string"), F.expr("substring(content, greatest(1, length(content) - 2047), 2048)").cast("string")
    return f.select("path", F.when(F.col("length") < 100, "short").when(~head.contains("%PDF"), "no header").when(~tail.contains("%%EOF"), "no trailer").alias("problem")).where("problem is not null")


