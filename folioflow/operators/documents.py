"""Facts of pages and documents from what a page reader measured: layers, orientation, which reading to take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.functions.wordlists import FUNCTION_WORDS, LANGUAGE

MIN_LETTERS, IMAGE_SHARE, OUTLINE_PATHS = 100, 0.5, 50


def page_facts(pages: DataFrame) -> DataFrame:
    """Adds has_text (100 letters or more), is_image_backed (half the page or more) and is_vector_outlined
    (neither, but 50 drawn paths or more). Columns: text, image_area, width, height, paths; nulls count as
    nothing."""
    letters = T.letters(F.coalesce("text", F.lit("")))
    image = T.share(F.coalesce("image_area", F.lit(0.0)), F.col("width") * F.col("height"), None) >= IMAGE_SHARE
    out = pages.withColumn("has_text", letters >= MIN_LETTERS).withColumn("is_image_backed", image)
    return out.withColumn("is_vector_outlined", ~F.col("has_text") & ~F.col("is_image_backed") & (F.coalesce("paths", F.lit(0)) >= OUTLINE_PATHS))


def document_classes(pages: DataFrame) -> DataFrame:
    """(document_id, pages, pdf_type, text_status) from page facts: vector_outlined from half the pages on;
    scanned from 90 % images, text_based up to 10 %, else mixed; ok from 90 % of pages with text, requires_ocr
    up to 10 %, else partial."""
    n = F.count("*")
    rows = pages.groupBy("document_id").agg(n.alias("pages"), (F.count_if("is_vector_outlined") / n).alias("outlined"), (F.count_if("is_image_backed") / n).alias("images"), (F.count_if("has_text") / n).alias("texts"))
    kind = F.when(F.col("outlined") >= 0.5, "vector_outlined").when(F.col("images") >= 0.9, "scanned").when(F.col("images") <= 0.1, "text_based").otherwise("mixed")
    status = F.when(F.col("texts") >= 0.9, "ok").when(F.col("texts") <= 0.1, "requires_ocr").otherwise("partial")
    return rows.select("document_id", "pages", kind.alias("pdf_type"), status.alias("text_status"))


def direction_faults(pages: DataFrame) -> DataFrame:
    """Pages (document_id, page_number, orientation, direction) with ``inconsistent``: an upright page that is
    written against most pages of its document; of two directions as common, the reverse one (-1)."""
    w = Window.partitionBy("document_id")
    votes = (F.col("orientation") == "upright") & F.col("direction").isNotNull()
    along, against = F.sum((votes & (F.col("direction") > 0)).cast("int")).over(w), F.sum((votes & (F.col("direction") < 0)).cast("int")).over(w)
    minority = F.when(along >= against, F.col("direction") < 0).otherwise(F.col("direction") > 0)
    return pages.withColumn("inconsistent", F.coalesce(votes & minority & (along > 0) & (against > 0), F.lit(False)))


def orientation_summary(pages: DataFrame, suspect: float = 0.1) -> DataFrame:
    """(document_id, pages, sideways, inconsistent, ratio, orientation_suspect)."""
    bad = F.count_if((F.col("orientation") == "sideways") | F.col("inconsistent"))
    rows = pages.groupBy("document_id").agg(F.count("*").alias("pages"), F.count_if(F.col("orientation") == "sideways").alias("sideways"), F.count_if("inconsistent").alias("inconsistent"), bad.alias("bad"))
    return rows.withColumn("ratio", T.share(F.col("bad"), F.col("pages"))).withColumn("orientation_suspect", F.col("ratio") >= suspect).drop("bad")


def function_word_rate(text: Column) -> Column:
    words = T.clean_words(text)
    return T.share(F.size(F.filter(words, lambda w: w.isin(*FUNCTION_WORDS))), F.size(words), None)


def better_reading(first: Column, second: Column, first_score: Column, second_score: Column) -> Column:
    """Whether the second reading of a page is to be taken: there was no first, or its panel score is higher
    and its function words aren't rarer. An empty second reading never is."""
    none = F.trim(F.coalesce(first, F.lit(""))) == ""
    gain = (second_score > first_score) & (function_word_rate(F.coalesce(second, F.lit(""))) >= function_word_rate(F.coalesce(first, F.lit(""))))
    return (F.trim(F.coalesce(second, F.lit(""))) != "") & (none | F.coalesce(gain, F.lit(False)))


def document_language(documents: DataFrame, profiles: DataFrame) -> DataFrame:
    """(document_id, language): the verdict over a document's whole text (document_id, verdict), refined by its
    pages (``panels.page_language_profile``): English with enough pages of both kinds is bilingual_en, English
    without a single English page uncertain."""
    rows = documents.join(profiles, "document_id", "left")
    english = F.coalesce(F.col("measurable") - F.col("non_en_pages"), F.lit(0))
    refined = F.when((F.col("measurable") > 0) & (english == 0), "uncertain").when(F.coalesce(F.col("non_en_ratio"), F.lit(0.0)) >= LANGUAGE["mixed"], "bilingual_en").otherwise("en")
    return rows.select("document_id", F.when(F.col("verdict") == "en", refined).otherwise(F.col("verdict")).alias("language"))
