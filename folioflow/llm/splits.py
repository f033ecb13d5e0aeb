"""Problem 1: train, validation and test splits that keep related records together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.operators.graph import connected_components
from folioflow.session import cut

#: Share of the questions in each split.
SHARES = {"train": 0.70, "validation": 0.15, "test": 0.15}
#: Equally large groups that one task ranks, about; they are spread over as many buckets as that takes.
RANKED = 100_000


def document_key(raw: Column) -> Column:
    """The form in which every way of writing a document id is the same: no outer white space, no file
    suffix, lower case."""
    bare = F.regexp_replace(raw, r"^[\s ]+|[\s ]+$", "")
    return F.lower(F.regexp_replace(bare, r"(?i)(\.pdf)+$", ""))


def evidence_links(questions: DataFrame) -> DataFrame:
    """(question_id, document_id): each distinct document that a location of the question means. Rows
    without a question id and locations without a document are dropped; repeated rows count once."""
    docs = F.flatten(F.transform("gold_evidence", lambda g: F.coalesce(g["locations"]["document_id"], F.array().cast("array<string>"))))
    return (
        questions.where("question_id is not null")
        .select("question_id", F.explode(F.array_distinct(F.transform(F.filter(docs, lambda d: d.isNotNull()), document_key))).alias("document_id"))
        .where("document_id <> ''")
    )


def question_groups(questions: DataFrame) -> DataFrame:
    """(question_id, first_question_id): the questions with evidence, each with the least of its linked
    set. Questions and documents are the two sides of one graph; the side is part of the node's name and
    sorts questions first, so the least node of a component is a question."""
    links = evidence_links(questions).select(F.concat(F.lit("0"), "question_id").alias("a"), F.concat(F.lit("1"), "document_id").alias("b"))
    found = connected_components(links)
    return found.where(F.col("node").startswith("0")).select(F.expr("substring(node, 2)").alias("question_id"), F.expr("substring(component, 2)").alias("first_question_id"))


def deal(histogram: list[tuple[int, int]], shares: dict[str, float]) -> dict[int, list[int]]:
    """Largest first, each group to the split furthest below its target: for each group size, how many
    groups of it each split gets. ``histogram`` holds (size, number of groups).

    Groups of one size are interchangeable, so a long run of them is dealt in bulk to the level that the
    one-by-one rule would reach and only the remainder is dealt singly.
    """
    total = sum(s * n for s, n in histogram)
    short = [share * total for share in shares.values()]
    out = {}
    for size, n in sorted(histogram, reverse=True):
        given = [0] * len(short)
        if n > 8 * len(short):
            low, high = min(short) - size * n, max(short)
            for _ in range(200):
                mid = (low + high) / 2
                if sum(max(0, int((d - mid) // size)) for d in short) > n - 2 * len(short):
                    low = mid
                else:
                    high = mid
            given = [max(0, int((d - high) // size)) for d in short]
            short = [d - size * g for d, g in zip(short, given)]
        for _ in range(n - sum(given)):
            k = max(range(len(short)), key=lambda i: (short[i], -i))
            given[k] += 1
            short[k] -= size
        out[size] = given
    return out


def assign_splits(questions: DataFrame, shares: dict[str, float] | None = None) -> DataFrame:
    """(question_id, first_question_id, split) for every distinct question; one without evidence is a
    group of its own.

    Only the histogram of group sizes comes to the driver: its rows are the distinct sizes, of which N
    questions allow at most sqrt(2 N). Groups of one size are ranked by hash, bucket by bucket with the
    buckets' offsets added, and the rank picks the split. Empty table: no rows.
    """
    shares = shares or SHARES
    alone = questions.where("question_id is not null").select("question_id").distinct()
    members = alone.join(question_groups(questions), "question_id", "left").withColumn("first_question_id", F.coalesce("first_question_id", "question_id"))
    sizes = cut(members.groupBy("first_question_id").agg(F.count("*").alias("size")))
    histogram = [(r["size"], r["n"]) for r in sizes.groupBy("size").agg(F.count("*").alias("n")).collect()]
    plan = deal(histogram, shares)
    buckets = -(-max((n for _, n in histogram), default=1) // RANKED)
    sizes = sizes.withColumn("bucket", F.pmod(F.xxhash64("first_question_id"), F.lit(buckets)))
    cells = sizes.groupBy("size", "bucket").agg(F.count("*").alias("n"))
    names = list(shares)
    spark = questions.sparkSession
    ends = spark.createDataFrame([(s, *[sum(g[: k + 1]) for k in range(len(g))]) for s, g in plan.items()], "size bigint, " + ", ".join(f"end_{k} bigint" for k in range(len(names))))
    before = cells.withColumn("before", F.sum("n").over(Window.partitionBy("size").orderBy("bucket")) - F.col("n")).drop("n")
    ranked = sizes.withColumn("rank", F.row_number().over(Window.partitionBy("size", "bucket").orderBy(F.xxhash64("first_question_id"), "first_question_id")))
    ranked = ranked.join(before, ["size", "bucket"]).join(F.broadcast(ends), "size").withColumn("rank", F.col("rank") + F.col("before"))
    split = F.lit(names[-1])
    for k in reversed(range(len(names) - 1)):
        split = F.when(F.col("rank") <= F.col(f"end_{k}"), names[k]).otherwise(split)
    return members.join(ranked.select("first_question_id", split.alias("split")), "first_question_id").select("question_id", "first_question_id", "split")


def found(questions: DataFrame) -> DataFrame:
    """(first_question_id, question_id) for every linked question but the least of its set."""
    return question_groups(questions).where("question_id <> first_question_id").select("first_question_id", "question_id")
