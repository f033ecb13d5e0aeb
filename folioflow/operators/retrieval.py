"""Keyword retrieval: postings, BM25 over documents or windows, and the fill of a character budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.session import cut

K1, B, MAX_TERMS = 1.2, 0.75, 24


def query_terms(questions: DataFrame, key: str, text: str, most: int = MAX_TERMS) -> DataFrame:
    """(key, term): the first ``most`` distinct content words of each question; one without any has none."""
    return questions.select(key, F.explode(F.slice(F.array_distinct(T.content_words(F.col(text))), 1, most)).alias("term"))


def postings(units: DataFrame, key: list[str], text: str, terms: DataFrame | None = None) -> DataFrame:
    """(*key, term, tf, dl): how often each term occurs in each unit, beside the unit's length in terms. With
    ``terms`` (term) of those only: other words are dropped in the scan's own tasks, where Spark can broadcast
    the terms, before anything is counted or shuffled."""
    words = units.select(*key, T.content_words(F.col(text)).alias("words"))
    rows = words.select(*key, F.size("words").alias("dl"), F.explode("words").alias("term"))
    if terms is not None:
        rows = rows.join(terms.select("term").distinct(), "term", "left_semi")
    return rows.groupBy(*key, "dl", "term").agg(F.count("*").alias("tf"))


def unit_statistics(units: DataFrame, text: str) -> tuple[int, float]:
    """How many units there are, and the mean length in terms of those that hold one: one aggregate."""
    n = F.size(T.content_words(F.col(text)))
    many, mean = units.agg(F.count("*"), F.avg(F.when(n > 0, n))).first()
    return many, float(mean or 1.0)


def search(terms: DataFrame, units: DataFrame, query: str, key: list[str], text: str, top: int, within: DataFrame | None = None) -> DataFrame:
    """(query, *key, score, rank) of the ``top`` units by BM25 over the units' texts (``bm25``)."""
    index = cut(postings(units, key, text, terms))
    return bm25(terms, index, *unit_statistics(units, text), query, key, top, within)


def bm25(terms: DataFrame, index: DataFrame, units: int, mean: float, query: str, key: list[str], top: int, within: DataFrame | None = None) -> DataFrame:
    """(query, *key, score, rank): the ``top`` units of each query by BM25, ties by key. ``index`` holds the
    postings of the queries' terms in all units, of which there are ``units`` with ``mean`` terms. ``within``
    restricts the result to (query, key...) pairs. Each task ranks what it has first, so the last window sees
    ``top`` rows a task and query."""
    df = F.col("df")
    idf = index.groupBy("term").agg(F.count("*").alias("df")).select("term", F.log(1 + (units - df + 0.5) / (df + 0.5)).alias("idf"))
    wanted = index.join(idf, "term")
    score = F.sum(F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / mean)))
    hits = terms.join(wanted, "term")
    if within is not None:
        hits = hits.join(within, [c for c in within.columns], "left_semi")
    found = hits.groupBy(query, *key).agg(F.round(score, 6).alias("score"))
    w = Window.partitionBy(query).orderBy(F.desc("score"), *key)
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def fill_budget(ranked: DataFrame, query: str, budget: int, start: str = "start", end: str = "end") -> DataFrame:
    """Spans in rank order until their lengths reach the budget, the one that crosses it included."""
    w = Window.partitionBy(query).orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return ranked.withColumn("before", F.coalesce(F.sum(F.col(end) - F.col(start)).over(w), F.lit(0))).where(F.col("before") < budget).drop("before")


def window_count(budget: int) -> int:
    return max(1, min(64, budget // 200 + 2))


def oracle_spans(questions: DataFrame, noise: int = 0) -> DataFrame:
    """(question_id, rank, document_id, start, end): the gold locations as a retriever would give them, those
    of required groups first, the first of each group before the others; ``noise`` characters wider."""
    g = questions.select("question_id", F.posexplode("gold_evidence").alias("g", "group"))
    loc = g.select("question_id", "g", (F.col("group.requirement") != "required").cast("int").alias("late"), F.posexplode("group.locations").alias("l", "x"))
    w = Window.partitionBy("question_id").orderBy((F.col("l") > 0).cast("int"), "late", "g", "l")
    start, end = F.greatest(F.lit(0), F.col("x.char_start") - noise), F.col("x.char_end") + noise
    return loc.select("question_id", F.row_number().over(w).alias("rank"), F.col("x.document_id").alias("document_id"), start.alias("start"), end.alias("end"))
