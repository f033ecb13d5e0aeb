"""The queries of this subpackage: each reads whole tables of ``sf_dir`` and runs one problem's operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import splits

    return splits.found(_t(spark, sf_dir, "questions"))


def p1_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import splits

    return splits.assign_splits(_t(spark, sf_dir, "questions"))


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each linked set its questions and how many splits they are in: one."""
    rows = p1_split(spark, sf_dir)
    return rows.groupBy("first_question_id").agg(F.count("*").alias("questions"), F.countDistinct("split").alias("splits"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import pieces

    return pieces.found(_t(spark, sf_dir, "page_lines"))


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import pieces

    return pieces.page_pieces(_t(spark, sf_dir, "page_lines"))


def p2_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each page the characters that its pieces hold beyond their overlaps: those of the page, block by block."""
    rows = p2_pieces(spark, sf_dir).groupBy("document_id", "page_number", "block").agg(F.sum(F.length("text") - F.col("overlap")).alias("chars"), F.max(F.length("text")).alias("longest"))
    return rows.groupBy("document_id", "page_number").agg((F.sum("chars") + F.count("*") - 1).alias("chars"), (F.max("longest") <= 2000).alias("within"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import quality

    return quality.found(_t(spark, sf_dir, "page_lines"))


def p3_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import quality

    return quality.assess(_t(spark, sf_dir, "page_lines")).select("document_id", "signals.*", "text_class", "classification", "score")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import scans

    return scans.noisy_lines(_t(spark, sf_dir, "page_lines"))


def p4_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import scans

    return scans.paragraphs(_t(spark, sf_dir, "page_lines"))


def p4_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import scans

    return scans.repaired_labels(_t(spark, sf_dir, "footnote_blocks"), _t(spark, sf_dir, "page_lines"), ["document_id", "page_number", "line_start", "line_end"])


def p4_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import scans

    return scans.repaired_labels(_t(spark, sf_dir, "furniture_lines"), _t(spark, sf_dir, "page_lines"), ["document_id", "page_number", "line_index"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import likeness

    return likeness.found(_t(spark, sf_dir, "page_lines"))


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import likeness

    return likeness.like_groups(_t(spark, sf_dir, "page_lines"))


def p5_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import likeness

    return likeness.titled_groups(_t(spark, sf_dir, "page_lines"), _t(spark, sf_dir, "corpus_documents"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import languages

    model = languages.fit(_t(spark, sf_dir, "documents"))
    return languages.unnamed(_t(spark, sf_dir, "page_lines"), _t(spark, sf_dir, "corpus_documents"), _t(spark, sf_dir, "inventory"), model)


def p6_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import languages

    model = languages.fit(_t(spark, sf_dir, "documents"))
    return languages.document_languages(_t(spark, sf_dir, "page_lines"), model)


def p6_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import languages

    model = languages.fit(_t(spark, sf_dir, "documents"))
    return languages.segments(_t(spark, sf_dir, "page_lines"), model)


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import containers

    return containers.assign(_t(spark, sf_dir, "documents"))


def p7_certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import containers

    return containers.certificates(containers.token_counts(_t(spark, sf_dir, "documents")))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import leaks

    return leaks.leaks(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import visual

    return visual.look_alike_pairs(_t(spark, sf_dir, "documents"))


def p9_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.llm import visual

    return visual.normalise(_t(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1:2].isdigit()}
