"""Scoring of retrieved spans against gold evidence under a character budget."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_novel(spans: list[tuple[str, int, int]], budget: int) -> list[tuple[int, str, int, int]]:
    """(rank, document, start, end) of the characters that count: of each span in order what no earlier one
    of the document held, until the budget is spent; the last piece is cut to fit. Empty and backward spans
    count nothing."""
    taken: dict[str, list[tuple[int, int]]] = {}
    out, left = [], budget
    for rank, (doc, start, end) in enumerate(spans, 1):
        if left <= 0:
            break
        if end <= start:
            continue
        held, at = taken.setdefault(doc, []), start
        for a, b in [*held, (end, end)]:
            if b <= at and a < end:
                continue
            stop = min(a, end)
            if stop > at and left > 0:
                stop = min(stop, at + left)
                out.append((rank, doc, at, stop))
                left -= stop - at
            at = max(at, b)
            if at >= end:
                break
        merged: list[tuple[int, int]] = []
        for a, b in sorted([*held, (start, end)]):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        taken[doc] = merged
    return out


def within_budget(spans: DataFrame, budgets: list[int]) -> DataFrame:
    """(question_id, budget, rank, document_id, start, end): the pieces of ranked spans that count for each
    budget. One question's ranked spans are one group; a ranking is as long as its retriever makes it."""
    names = ["question_id", "budget", "rank", "document_id", "start", "end"]
    types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for q, listed in zip(*(c.to_pylist() for c in batch.columns)):
                ranked = [(x["document_id"], x["start"], x["end"]) for x in listed]
                rows += [(q, b, *piece) for b in budgets for piece in keep_novel(ranked, b)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types], names)

    ranked = spans.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("rank", "document_id", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end")))).alias("listed"))
    return ranked.mapInArrow(run, "question_id string, budget bigint, rank int, document_id string, start bigint, end bigint")


def gold_locations(questions: DataFrame) -> DataFrame:
    """(question_id, group_id, requirement, location, document_id, key, char_start, char_end)."""
    g = questions.select("question_id", F.explode("gold_evidence").alias("g"))
    return g.select("question_id", "g.group_id", "g.requirement", F.posexplode("g.locations").alias("location", "x")).select("question_id", "group_id", "requirement", "location", "x.document_id", "x.key", "x.char_start", "x.char_end")


def coverage(pieces: DataFrame, gold: DataFrame) -> DataFrame:
    """Gold locations by budget with the share of each that the pieces cover: an equi-join on the question
    and document, then the overlap of two intervals. A location without length is covered 0."""
    overlap = F.greatest(F.lit(0), F.least(F.col("end"), F.col("char_end")) - F.greatest(F.col("start"), F.col("char_start")))
    held = gold.join(pieces, ["question_id", "document_id"]).groupBy("question_id", "group_id", "location", "document_id", "budget").agg(F.sum(overlap).alias("covered"))
    n = F.col("char_end") - F.col("char_start")
    return held.join(gold, ["question_id", "group_id", "location", "document_id"]).withColumn("coverage", F.when(n > 0, F.col("covered") / n).otherwise(0.0))


def question_scores(questions: DataFrame, pieces: DataFrame, budgets: list[int], tau: float = 0.5) -> DataFrame:
    """(question_id, category, budget, recall, all_required, document_recall, precision, used): per question
    and budget. A group is hit if any of its locations is covered by ``tau`` or more; recall is over all
    groups. Precision counts a gold character once for each location that holds it. Questions without
    evidence are left out; nothing retrieved scores 0."""
    spark = questions.sparkSession
    gold = gold_locations(questions)
    grid = spark.createDataFrame([(b,) for b in budgets], "budget bigint")
    covered = coverage(pieces, gold)
    keys = ["question_id", "group_id", "location", "document_id", "budget"]
    full = gold.crossJoin(F.broadcast(grid)).join(covered.select(*keys, "coverage", "covered"), keys, "left").fillna({"coverage": 0.0, "covered": 0})
    group = full.groupBy("question_id", "budget", "group_id", "requirement").agg((F.max("coverage") >= tau).alias("hit"), F.sum("covered").alias("held"))
    per = group.groupBy("question_id", "budget").agg(F.avg(F.col("hit").cast("double")).alias("recall"), F.min(F.when(F.col("requirement") == "required", F.col("hit").cast("int"))).alias("all_required"), F.sum("held").alias("held"))
    docs = gold.select("question_id", "document_id").distinct().join(pieces.select("question_id", "document_id", "budget", F.lit(1).alias("seen")).distinct(), ["question_id", "document_id"]).groupBy("question_id", "budget").agg(F.count("*").alias("docs"))
    many = gold.groupBy("question_id").agg(F.countDistinct("document_id").alias("gold_docs"))
    used = pieces.groupBy("question_id", "budget").agg(F.sum(F.col("end") - F.col("start")).alias("used"))
    out = per.join(many, "question_id").join(docs, ["question_id", "budget"], "left").join(used, ["question_id", "budget"], "left").fillna({"docs": 0, "used": 0})
    out = out.withColumn("document_recall", F.col("docs") / F.col("gold_docs")).withColumn("precision", F.try_divide(F.col("held").cast("double"), F.col("used").cast("double")))
    return out.join(questions.select("question_id", "category"), "question_id").select("question_id", "category", "budget", "recall", "all_required", "document_recall", "precision", "used")


def first_hits(spans: DataFrame, gold: DataFrame, tau: float = 0.5) -> DataFrame:
    """(question_id, group_id, rank): the rank at which a group is first covered by ``tau``, from pieces that
    don't overlap: coverage only grows with rank, so it is the least rank whose running sum reaches it."""
    from pyspark.sql import Window

    overlap = F.greatest(F.lit(0), F.least(F.col("end"), F.col("char_end")) - F.greatest(F.col("start"), F.col("char_start")))
    held = gold.join(spans, ["question_id", "document_id"]).withColumn("o", overlap).groupBy("question_id", "group_id", "location", "char_start", "char_end", "rank").agg(F.sum("o").alias("o"))
    w = Window.partitionBy("question_id", "group_id", "location").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    run = held.withColumn("covered", F.sum("o").over(w)).where(F.col("covered") >= tau * (F.col("char_end") - F.col("char_start")))
    return run.groupBy("question_id", "group_id").agg(F.min("rank").alias("rank"))


def report(scores: DataFrame) -> DataFrame:
    """Means by category and budget; undefined values don't count. No mean over categories is given."""
    return scores.groupBy("category", "budget").agg(F.count("*").alias("questions"), *[F.round(F.avg(c), 4).alias(c) for c in ("recall", "all_required", "document_recall", "precision", "used")], F.count_if(F.col("used") == 0).alias("empty"))


def answer_scores(questions: DataFrame, answers: DataFrame, texts: DataFrame) -> DataFrame:
    """(question_id, facts, citation_precision, citation_recall, quotes, grounded): of the answers
    (question_id, answer, citations array<struct<document_id,key>>) the share of required facts stated, in any
    wording of each; of the citations those that name a gold location, and of the gold groups those cited at
    any of their locations; of the quoted strings those found in a cited text (document_id, text). Ratios of
    nothing are null. An answer without an entry is left out."""
    from folioflow.functions.text import quotes
    from folioflow.functions.unicode import appears_in

    asked = questions.select("question_id", "required_facts").join(answers, "question_id")
    fact = asked.select("question_id", "answer", F.posexplode("required_facts").alias("n", "wordings")).select("question_id", "answer", "n", F.explode("wordings").alias("wording"))
    stated = fact.groupBy("question_id", "n").agg(F.max(appears_in("wording", "answer").cast("int")).alias("hit")).groupBy("question_id").agg(F.avg("hit").alias("facts"))
    gold = gold_locations(questions).select("question_id", "group_id", "document_id", "key").distinct()
    cited = answers.select("question_id", F.explode(F.array_distinct("citations")).alias("c")).select("question_id", "c.document_id", "c.key")
    named = cited.join(gold.select("question_id", "document_id", "key").distinct().withColumn("hit", F.lit(1)), ["question_id", "document_id", "key"], "left").groupBy("question_id").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("citation_precision"))
    found = gold.join(cited.distinct().withColumn("hit", F.lit(1)), ["question_id", "document_id", "key"], "left").groupBy("question_id", "group_id").agg(F.max(F.coalesce("hit", F.lit(0))).alias("hit")).groupBy("question_id").agg(F.avg("hit").alias("citation_recall"))
    said = answers.select("question_id", F.explode(F.array_distinct(quotes(F.col("answer")))).alias("quote"))
    sources = cited.select("question_id", "document_id").distinct().join(texts.select("document_id", "text"), "document_id")
    held = said.join(sources, "question_id", "left").groupBy("question_id", "quote").agg(F.max(F.coalesce(F.contains("text", "quote"), F.lit(False)).cast("int")).alias("hit")).groupBy("question_id").agg(F.count("*").alias("quotes"), F.avg("hit").alias("grounded"))
    out = answers.select("question_id").distinct()
    for part in (stated, named, found, held):
        out = out.join(part, "question_id", "left")
    return out.fillna(0, ["quotes"])
