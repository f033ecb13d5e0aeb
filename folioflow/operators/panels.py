"""Rule panels over text: quality, mangled scripts, content language, tables, orientation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.functions.wordlists import FUNCTION_WORDS, LANGUAGE, QUALITY, WEIGHTS


def with_signals(df: DataFrame, text: str = "text") -> DataFrame:
    return df.select("*", *[c.alias(n) for n, c in T.text_signals(F.coalesce(F.col(text), F.lit(""))).items()])


def shape_suspect() -> Column:
    """A page's words are too short, too often single letters or oddly cased; needs enough words."""
    q = QUALITY
    return (F.col("word_count") >= q["page_words"]) & ((F.col("mean_word_length") < q["mean_word_length"]) | (F.col("single_char_rate") > q["single_char_rate"]) | (F.col("mixed_case_rate") > q["mixed_case_rate"]))


def page_verdict() -> Column:
    return F.when(F.col("word_count") < QUALITY["page_words"], "unjudged").when(shape_suspect(), "suspect").otherwise("good")


def quality_panel(signals: DataFrame, suspect_share: Column | None = None) -> DataFrame:
    """Adds ``score``, ``failed_checks`` and ``classification``: the weighted share of checks passed, good
    from 0.8, questionable from 0.55; two failed checks of word shape cap it, three make it bad. The check of
    page consistency joins in where ``suspect_share`` isn't null, that of replacement characters where there
    are any. Too few words: questionable, score 0."""
    q = QUALITY
    passed = {
        "mean_word_length": F.col("mean_word_length") >= q["mean_word_length"], "single_char_rate": F.col("single_char_rate") <= q["single_char_rate"],
        "mixed_case_rate": F.col("mixed_case_rate") <= q["mixed_case_rate"], "alnum_mix_rate": F.col("alnum_mix_rate") <= q["alnum_mix_rate"],
        "alpha_ratio": F.col("alpha_ratio") >= q["alpha_ratio"], "common_word_rate": F.col("common_word_rate") >= q["common_word_rate"],
        "symbol_ratio": F.col("symbol_ratio") <= q["symbol_ratio"], "vowelless_ratio": F.col("vowelless_ratio") <= q["vowelless_ratio"],
        "replacement_characters": F.when(F.col("replacement_char_count") > 0, F.lit(False)),
    }
    if suspect_share is not None:
        passed["page_consistency"] = suspect_share <= q["suspect_ratio"]
    total = sum((F.when(c.isNotNull(), WEIGHTS[n]).otherwise(0.0) for n, c in passed.items()), F.lit(0.0))
    won = sum((F.when(c, WEIGHTS[n]).otherwise(0.0) for n, c in passed.items()), F.lit(0.0))
    failed = F.array_sort(F.array_compact(F.array(*[F.when(~c, n) for n, c in passed.items()])))
    shape = F.size(F.array_intersect(F.col("failed_checks"), T.words_in(["mean_word_length", "single_char_rate", "mixed_case_rate"])))
    out = signals.withColumn("failed_checks", failed).withColumn("score", F.round(won / total, 4))
    few = F.col("word_count") < q["min_words"]
    verdict = F.when(few, "questionable").when(shape >= 3, "bad").when(F.col("score") >= q["good"], F.when(shape >= 2, "questionable").otherwise("good")).when(F.col("score") >= q["questionable"], "questionable").otherwise("bad")
    out = out.withColumn("classification", verdict)
    return out.withColumn("score", F.when(few, 0.0).otherwise(F.col("score"))).withColumn("failed_checks", F.when(few, F.array(F.lit("insufficient_text"))).otherwise(F.col("failed_checks")))


def mangled(text: Column) -> Column:
    """Latin letters that a legacy font made of another script: short words, few function words, and odd
    symbols or vowelless words; from 40 words on."""
    words = T.all_matches(text, "[A-Za-z]+")
    n = F.size(words)
    mean = T.share(F.length(F.array_join(words, "")), n, None)
    rate = T.share(F.size(F.filter(words, lambda w: F.lower(w).isin(*FUNCTION_WORDS))), n, None)
    q = T.quality_signals(text)
    shape = (mean < 2.0) & (q["symbol_ratio"] >= 0.15) & (rate < 0.15)
    vocabulary = (rate < 0.06) & (mean < 3.0) & ((q["symbol_ratio"] >= 0.05) | (q["vowelless_ratio"] >= 0.25))
    return (n >= LANGUAGE["mangled_words"]) & (shape | vocabulary)


def language_signals(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds letters, non_latin_ratio, clean_word_count, function_word_rate (unrounded) and
    distinct_function_words."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = T.clean_words(t)
    hits = F.filter(words, lambda w: w.isin(*FUNCTION_WORDS))
    all_, latin = T.letters(t), T.script_counts(t, ["latin"])["latin"]
    return df.withColumns({"letters": all_, "non_latin_ratio": T.share(all_ - latin, all_, None), "clean_word_count": F.size(words), "function_word_rate": T.share(F.size(hits), F.size(words), None), "distinct_function_words": F.size(F.array_distinct(hits))})


def content_language() -> Column:
    """The language rules in their order: another script settles it unless English is established besides;
    then too few words, decisive short texts, the lower and the upper bound."""
    g = LANGUAGE
    n, rate, distinct = F.col("clean_word_count"), F.col("function_word_rate"), F.col("distinct_function_words") >= g["distinct"]
    english = (rate >= g["english"]) & distinct & (n >= g["min_words"])
    short = (n >= g["short_words"]) & (rate >= g["short_rate"]) & distinct
    return (
        F.when((F.col("non_latin_ratio") >= g["non_latin"]) & (F.col("letters") >= g["letters"]) & ~english, "non_en")
        .when((n < g["min_words"]) & ~short, "uncertain")
        .when(n < g["min_words"], "en")
        .when(rate <= g["non_english"], "non_en")
        .when((rate >= g["english"]) & distinct, "en")
        .otherwise("uncertain")
    )


def line_language(text: Column) -> Column:
    """en, non_en, or unknown for a line of fewer than 10 letters, by its share of letters that aren't Latin."""
    all_, latin = T.letters(text), T.script_counts(text, ["latin"])["latin"]
    return F.when(all_ < LANGUAGE["line_letters"], "unknown").when((all_ - latin) >= LANGUAGE["non_latin"] * all_, "non_en").otherwise("en")


def page_language(text: Column) -> Column:
    all_, latin = T.letters(text), T.script_counts(text, ["latin"])["latin"]
    return F.when(all_ < LANGUAGE["letters"], "unknown").when((all_ - latin) >= LANGUAGE["non_latin"] * all_, "non_en").when(mangled(text), "non_en").otherwise("en")


def page_language_profile(pages: DataFrame) -> DataFrame:
    """Per document, over (document_id, page_number, verdict): pages by verdict, the share that isn't English
    of those that can be told, the first 50 such pages, and whether the document is mixed."""
    known = F.sum(F.when(F.col("verdict") != "unknown", 1).otherwise(0))
    other = F.sum(F.when(F.col("verdict") == "non_en", 1).otherwise(0))
    numbers = F.slice(F.array_sort(F.collect_list(F.when(F.col("verdict") == "non_en", F.col("page_number")))), 1, 50)
    return pages.groupBy("document_id").agg(F.count("*").alias("pages"), known.alias("measurable"), other.alias("non_en_pages"), T.share(other, known).alias("non_en_ratio"), numbers.alias("numbers")).withColumn("mixed", F.col("non_en_ratio") >= LANGUAGE["mixed"])


def vocabulary(documents: DataFrame, least: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word): words of four letters or more that at least so many documents hold."""
    words = documents.select(key, F.explode(F.array_distinct(F.transform(T.all_matches(F.col(text), "[A-Za-z]{4,}"), F.lower))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("df")).where(F.col("df") >= least).select("word")


def word_validity(documents: DataFrame, words: DataFrame, key: str = "doc_id", text: str = "text", least: int = 200) -> DataFrame:
    """(key, words, valid, rate, measurable): share of the words of four letters or more that are in a
    vocabulary. Counted per document and distinct word before the join."""
    each = documents.select(key, F.explode(F.transform(T.all_matches(F.col(text), "[A-Za-z]{4,}"), F.lower)).alias("word")).groupBy(key, "word").agg(F.count("*").alias("n"))
    hit = each.join(words.withColumn("known", F.lit(1)), "word", "left")
    out = hit.groupBy(key).agg(F.sum("n").alias("words"), F.sum(F.when(F.col("known") == 1, F.col("n")).otherwise(0)).alias("valid"))
    return out.select(key, "words", "valid", T.share(F.col("valid"), F.col("words")).alias("rate"), (F.col("words") >= least).alias("measurable"))


def table_verdict(cells: Column) -> Column:
    """Why an array of rows of cells is no table, by the first rule it fails; null for a table: rows, columns,
    cells filled, each column filled, rows of the commonest shape, contents entries."""
    filled = lambda r: F.size(F.filter(r, lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""))
    rows, cols = F.size(cells), F.array_max(F.transform(cells, F.size))
    shapes = F.transform(cells, filled)
    all_ = F.aggregate(shapes, F.lit(0), lambda a, x: a + x)
    column = F.transform(F.sequence(F.lit(1), cols), lambda k: F.size(F.filter(cells, lambda r: F.trim(F.coalesce(F.try_element_at(r, k), F.lit(""))) != "")))
    modal = F.array_max(F.transform(F.array_distinct(shapes), lambda s: F.size(F.filter(shapes, lambda x: x == s))))
    first = F.filter(F.transform(cells, lambda r: F.trim(F.coalesce(F.try_element_at(r, F.lit(1)), F.lit("")))), lambda c: c != "")
    number = lambda c: F.substring_index(c, ".", 1)
    rest = lambda c: F.substring(c, F.length(number(c)) + 2, F.lit(1 << 30))
    entry = lambda c: number(c).rlike("^[0-9]{1,4}[A-Z]{0,3} *$") & rest(c).startswith(" ") & F.length(F.trim(rest(c))).between(1, 119)
    entries = F.size(F.filter(first, entry))
    return (
        F.when(rows < 3, "rows").when(F.coalesce(cols, F.lit(0)) < 2, "columns").when(T.share(all_, rows * cols, None) < 0.7, "filled")
        .when(F.array_min(column) < 0.6 * rows, "column_fill").when(modal < 0.75 * rows, "row_shape").when(T.share(entries, F.size(first), None) > 0.34, "contents")
    )


def orientation(directions: Column, rotation: Column) -> Column:
    """upright, sideways or unknown, from the writing directions (x, y) of a page's lines and its declared
    rotation: from 8 lines on, 70 % sideways or 30 % at most."""
    turned = F.pmod(rotation, F.lit(180)) == 90
    side = F.size(F.filter(directions, lambda d: (F.abs(d["y"]) > F.abs(d["x"])) != turned))
    n = F.size(directions)
    return F.when(F.coalesce(n, F.lit(0)) < 8, "unknown").when(side >= 0.7 * n, "sideways").when(side <= 0.3 * n, "upright").otherwise("unknown")


def dpi(width: Column, height: Column, wanted: int = 300, megapixels: float = 40.0, least: int = 200) -> Column:
    """The resolution at which a page of so many points stays within a number of pixels."""
    mp = width * height / (72.0 * 72.0) * wanted * wanted / 1e6
    return F.when(mp <= megapixels, wanted).otherwise(F.greatest(F.lit(least), F.floor(wanted * F.sqrt(megapixels / mp)).cast("int")))
