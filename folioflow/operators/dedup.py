"""Duplicate and parallel documents: line fingerprints, candidate pairs, scored edges, clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.operators.graph import connected_components
from folioflow.session import cut

MIN_TOKENS, MAX_DOCUMENTS, MIN_SHARED = 5, 50, 3
SAME, VERSION, TITLE, CONTAINS = 0.95, 0.5, 0.8, 0.9
#: Scores are rounded to four places before they are judged.
ROUNDING = 1e-4


def _prints(text: str) -> Column:
    lines = F.transform(T.split_lines(F.lower(text)), lambda x: T.all_matches(x, "[a-z0-9]+"))
    return F.array_distinct(F.transform(F.filter(lines, lambda w: F.size(w) >= MIN_TOKENS), lambda w: F.unhex(F.sha2(F.array_join(w, " "), 256))))


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint): the distinct lines of a text of MIN_TOKENS tokens or more, as the 32 bytes of a hash of
    their tokens. Compatibility characters are expected to be folded (``functions.unicode.nfkc``)."""
    return documents.select(key, F.explode(_prints(text)).alias("fingerprint"))


def line_sets(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, first, n): each text with fingerprints beside the least key with the same set of them, and how
    many there are. ``first`` stands for all its copies."""
    each = documents.select(key, _prints(text).alias("p")).where(F.size("p") > 0).select(key, F.size("p").alias("n"), F.unhex(F.sha2(F.array_join(F.transform(F.array_sort("p"), F.hex), ""), 256)).alias("h"))
    return each.join(each.groupBy("h").agg(F.min(key).alias("first")), "h").select(key, "first", "n")


def candidate_pairs(prints: DataFrame, key: str = "doc_id") -> DataFrame:
    """(a, b, shared), a < b: pairs that share MIN_SHARED fingerprints or more of those in 2 to MAX_DOCUMENTS
    documents. A boilerplate line proposes no pairs, so no join group is larger than MAX_DOCUMENTS; it still
    counts when a pair is scored. This is the reference's list; ``alike_pairs`` is the one without a cap."""
    rare = prints.groupBy("fingerprint").agg(F.count("*").alias("df")).where(F.col("df").between(2, MAX_DOCUMENTS)).select("fingerprint")
    kept = prints.join(rare, "fingerprint")
    a, b = kept.select("fingerprint", F.col(key).alias("a")), kept.select("fingerprint", F.col(key).alias("b"))
    return a.join(b, "fingerprint").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared")).where(F.col("shared") >= MIN_SHARED)


def _ranked(prints: DataFrame, key: str) -> DataFrame:
    """(k, fingerprint, df, at, n): each document's fingerprints, rarest first, from 1 on."""
    df = prints.groupBy("fingerprint").agg(F.count("*").alias("df"))
    own = Window.partitionBy("k")
    rows = prints.select(F.col(key).alias("k"), "fingerprint").join(df, "fingerprint")
    return rows.withColumn("at", F.row_number().over(own.orderBy("df", "fingerprint"))).withColumn("n", F.count("*").over(own))


def alike_pairs(prints: DataFrame, key: str = "doc_id", jaccard: float = 0.5, containment: float | None = None) -> DataFrame:
    """(a, b), a < b: candidates among which are all pairs that reach the Jaccard likeness or, where it is
    given, the containment. An exact prefix filter: of two sets so alike, one fingerprint is among the first
    n - ceil(least * n) + 1 of both, rarest first; of a set so contained, one of its first is anywhere in
    the other. No fingerprint is left out for being frequent. ``prints`` holds one document of each set."""
    ranked = cut(_ranked(prints, key))
    side = lambda rows, c: rows.select("fingerprint", *[F.col(x).alias(f"{x}_{c}") for x in ("k", "n", "at")])
    shared = ranked.where("df > 1")
    head = lambda least: shared.where(F.col("at") <= F.col("n") - F.ceil((least - ROUNDING) * F.col("n")) + 1)
    may = 1 + F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    least = jaccard - ROUNDING
    near = side(head(jaccard), "a").join(side(head(jaccard), "b"), "fingerprint").where((F.col("k_a") < F.col("k_b")) & (may * (1 + least) >= least * (F.col("n_a") + F.col("n_b"))))
    out = near.select(F.col("k_a").alias("a"), F.col("k_b").alias("b"))
    if containment is not None:
        inside = side(head(containment), "a").join(side(shared, "b"), "fingerprint").where((F.col("k_a") != F.col("k_b")) & (F.col("n_a") <= F.col("n_b")) & (may >= (containment - ROUNDING) * F.col("n_a")))
        out = out.unionByName(inside.select(F.least("k_a", "k_b").alias("a"), F.greatest("k_a", "k_b").alias("b")))
    return out.distinct()


def identity_links(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(first, key): each copy of a text that isn't blank beside the first document with it. One row a copy
    ties them together, however many there are."""
    same = documents.where(F.trim(text) != "").select(key, F.unhex(F.sha2(text, 256)).alias("h"))
    first = same.groupBy("h").agg(F.min(key).alias("first"), F.count("*").alias("n")).where("n > 1")
    return same.join(first, "h").where(F.col(key) != F.col("first")).select("first", key)


def scored_edges(pairs: DataFrame, prints: DataFrame, key: str = "doc_id") -> DataFrame:
    """(a, b, shared, jaccard, containment): pairs scored over all their fingerprints, boilerplate included,
    in one join on the fingerprint; no set is gathered. Empty unions count as 1."""
    sizes = prints.groupBy(key).agg(F.count("*").alias("n"))
    side = lambda c: prints.select(F.col(key).alias(c), "fingerprint")
    shared = pairs.select("a", "b").join(side("a"), "a").join(side("b"), ["b", "fingerprint"]).groupBy("a", "b").agg(F.count("*").alias("shared"))
    n = lambda c: sizes.select(F.col(key).alias(c), F.col("n").alias(f"n_{c}"))
    out = shared.join(n("a"), "a").join(n("b"), "b")
    union = F.col("n_a") + F.col("n_b") - F.col("shared")
    return out.select("a", "b", "shared", F.round(F.coalesce(F.try_divide(F.col("shared").cast("double"), union.cast("double")), F.lit(1.0)), 4).alias("jaccard"), F.round(F.col("shared") / F.least("n_a", "n_b"), 4).alias("containment"))


def relation(jaccard: Column, title: Column, containment: Column, same_file: Column | None = None, same_text: Column | None = None, apart: Column | None = None) -> Column:
    """What two documents are to each other: identical, same_instrument, parallel, contains or unrelated.
    ``apart``: their titles name different places, which makes two instruments of the same text."""
    same_file, same_text, apart = (F.lit(False) if c is None else c for c in (same_file, same_text, apart))
    return (
        F.when(same_file | (same_text & ~apart), "identical")
        .when(~apart & ((jaccard >= SAME) | ((jaccard >= VERSION) & (title >= TITLE))), "same_instrument")
        .when(jaccard >= VERSION, "parallel")
        .when(containment >= CONTAINS, "contains")
        .otherwise("unrelated")
    )


def clusters(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, cluster): members of each linked set under its least member."""
    return connected_components(links, a, b).withColumnRenamed("component", "cluster")


def numbered(found: DataFrame) -> DataFrame:
    """Clusters with the name dup-00001 and on, in order of their least member: numbered within ranges of that
    member, to which the sizes of the ranges before are added, so that no task orders all clusters."""
    ranged = cut(found.select("cluster").distinct().repartitionByRange("cluster").select("cluster", F.spark_partition_id().alias("range")))
    sizes = ranged.groupBy("range").agg(F.count("*").alias("n"))
    before = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("range").orderBy("cluster")) + F.col("before")
    names = ranged.join(F.broadcast(before), "range").select("cluster", F.format_string("dup-%05d", place).alias("cluster_id"))
    return found.join(names, "cluster")


def representatives(members: DataFrame, by: str, *order: Column) -> DataFrame:
    """The member of each cluster that is least in the order given."""
    return members.groupBy(by).agg(F.min_by(F.struct(*[F.col(c) for c in members.columns if c != by]), F.struct(*order)).alias("m")).select(by, "m.*")


def word_sets(rows: DataFrame, key: str, words: str) -> DataFrame:
    """(key, words, first): each row's set of words, where it isn't empty, and the least key of those with the
    same set. ``words`` is an array of distinct values, sorted."""
    rows = rows.where(F.size(words) > 0).select(key, F.col(words).alias("words"))
    return rows.join(rows.groupBy("words").agg(F.min(key).alias("first")), "words").select(key, "words", "first")


def set_pairs(sets: DataFrame, key: str, words: str, least: float = 0.5) -> DataFrame:
    """(a, b, likeness), a < b: all pairs of different sets whose Jaccard likeness is ``least`` or more, by an
    exact prefix filter. Of sets so alike, the words in order of rarity share one among the first
    n - ceil(least * n) + 1 of each; a pair is kept at its first common word only, where the words from there
    on can still make the likeness. No word is left out for being frequent."""
    each = sets.select(F.col(key).alias("k"), F.explode(words).alias("word"))
    df = each.groupBy("word").agg(F.count("*").alias("df"))
    ordered = each.join(df, "word").groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "word"))), lambda x: x["word"]).alias("w"))
    n = F.size("w")
    prefix = ordered.withColumn("n", n).select("k", "w", "n", F.posexplode(F.slice("w", 1, n - F.ceil(F.lit(least) * n).cast("int") + 1)).alias("at", "word"))
    side = lambda c: prefix.select("word", *[F.col(x).alias(f"{x}_{c}") for x in ("k", "w", "n", "at")])
    may = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    pairs = side("a").join(side("b"), "word").where((F.col("k_a") < F.col("k_b")) & (may * (1 + least) >= least * (F.col("n_a") + F.col("n_b")) - 1e-9))
    both = pairs.withColumn("both", F.array_intersect("w_a", "w_b")).where(F.col("both")[0] == F.col("word"))
    shared = F.size("both")
    out = both.select(F.col("k_a").alias("a"), F.col("k_b").alias("b"), F.round(shared / (F.col("n_a") + F.col("n_b") - shared), 4).alias("likeness"))
    return out.where(F.col("likeness") >= least)


def span_classes(spans: DataFrame, key: str = "document_id", text: str = "text") -> DataFrame:
    """(class_hash, documents, spans, first): spans of one normalised text that occur in two documents or
    more."""
    h = spans.select(key, F.sha2(T.squeeze(F.col(text)), 256).alias("class_hash"))
    return h.groupBy("class_hash").agg(F.countDistinct(key).alias("documents"), F.count("*").alias("spans"), F.min(key).alias("first")).where("documents > 1")


def merged_listings(entries: DataFrame, fill: list[str], key: str = "english_pdf_url", order: str = "discovered_at") -> DataFrame:
    """One row a document address: the first listing's, with its empty fields filled from later ones in
    order and the distinct sources of all. The address is trimmed, its spaces escaped; rows without one are
    dropped. Ties in order go by document id."""
    rows = entries.where(F.trim(key) != "").withColumn("dedup_key", F.regexp_replace(F.trim(key), " ", "%20"))
    at = F.struct(F.col(order), F.col("document_id"))
    kept = [F.min_by(F.nullif(F.col(c), F.lit("")), F.when(F.nullif(F.col(c), F.lit("")).isNotNull(), at)).alias(c) for c in fill]
    return rows.groupBy("dedup_key").agg(F.min_by("document_id", at).alias("document_id"), *kept, F.size(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("source_count"), F.count("*").alias("listings"))
