"""The corpus as tables: instruments under several ids, equal provisions, document facts, evidence locations and
the checks that published facts are held against."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.functions.unicode import nfkc, title_similarity
from folioflow.operators import dedup
from folioflow.operators.lines import carried
from folioflow.operators.structure import PROVISIONS
from folioflow.session import cut

#: Titles of one text that are less alike than this disagree.
TITLES_DISAGREE = 0.5
# How a kind of provision is written in a citation.
ABBREVIATIONS = {"article": "art.", "rule": "r.", "regulation": "reg.", "section": "s."}


def line_prints(lines: DataFrame, key: str = "document_id") -> DataFrame:
    """(key, fingerprint): the distinct lines of a document of dedup.MIN_TOKENS tokens or more, compatibility
    characters folded, as a hash of their tokens. Lines stay lines: no document is put together for it."""
    tokens = T.all_matches(F.lower(nfkc("text")), "[a-z0-9]+")
    rows = lines.where(f"{key} is not null and text is not null").select(key, tokens.alias("w")).where(F.size("w") >= dedup.MIN_TOKENS)
    return rows.select(key, F.xxhash64(F.array_join("w", " ")).alias("fingerprint")).distinct()


def instrument_edges(prints: DataFrame, facts: DataFrame, places: dict[str, Sequence[str]]) -> DataFrame:
    """(a, b, relation, jaccard, containment, title_similarity, shared, same_file, same_text, places_differ) of
    documents that share enough lines, or have one file or text. ``prints`` holds (document_id, fingerprint),
    ``facts`` (document_id, title, sha256, text_hash); unrelated pairs are left out.

    Pairs come from lines in 2 to dedup.MAX_DOCUMENTS documents, as in the reference's list; documents of one file or
    one text are tied to the least of them, one row a copy. Titles that name places and none in common make two
    instruments of one text, but not of one file.
    """
    prints = cut(prints)
    one = lambda c: facts.where(F.col(c).isNotNull()).select("document_id", c).join(facts.groupBy(c).agg(F.min("document_id").alias("first")), c).where("document_id <> first").select(F.col("first").alias("a"), F.col("document_id").alias("b"))
    pairs = dedup.candidate_pairs(prints, "document_id").select("a", "b").unionByName(one("sha256")).unionByName(one("text_hash")).distinct()
    scored = pairs.join(dedup.scored_edges(pairs, prints, "document_id"), ["a", "b"], "left").fillna({"shared": 0, "jaccard": 0.0, "containment": 0.0})
    side = lambda c: facts.select(F.col("document_id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("title", "sha256", "text_hash")])
    rows = scored.join(side("a"), "a").join(side("b"), "b")
    same = lambda c: F.coalesce(F.col(f"{c}_a") == F.col(f"{c}_b"), F.lit(False))
    pa, pb = T.places_in(F.col("title_a"), places), T.places_in(F.col("title_b"), places)
    apart = (F.size(pa) > 0) & (F.size(pb) > 0) & ~F.arrays_overlap(pa, pb)
    rows = rows.withColumns({"title_similarity": F.round(title_similarity("title_a", "title_b"), 4), "same_file": same("sha256"), "same_text": same("text_hash"), "places_differ": apart})
    rows = rows.where((F.col("shared") >= dedup.MIN_SHARED) | F.col("same_file") | F.col("same_text"))
    relation = dedup.relation(F.col("jaccard"), F.col("title_similarity"), F.col("containment"), F.col("same_file"), F.col("same_text"), F.col("places_differ"))
    return rows.withColumn("relation", relation).where("relation <> 'unrelated'").select("a", "b", "relation", "jaccard", "containment", "title_similarity", "shared", "same_file", "same_text", "places_differ")


def review_band(edges: DataFrame) -> DataFrame:
    """Edges with the band in which they are reviewed, the riskiest first, and whether their titles conflict: one
    text under titles that disagree."""
    r, t = F.col("relation"), F.col("title_similarity")
    identical, same = r == "identical", r == "same_instrument"
    band = F.when(identical & (t < TITLES_DISAGREE), "identical, titles disagree").when(identical, "identical, titles agree").when(same & (t < dedup.TITLE), "same instrument by text alone").when(same, "same instrument, another version").otherwise(r)
    return edges.withColumn("band", band).withColumn("title_conflict", identical & (t < TITLES_DISAGREE))


def instrument_clusters(edges: DataFrame) -> DataFrame:
    """(document_id, cluster_id): documents of one instrument under the name of their cluster."""
    same = edges.where(F.col("relation").isin("identical", "same_instrument")).select("a", "b")
    return dedup.numbered(dedup.clusters(same)).select(F.col("node").alias("document_id"), "cluster_id")


def provision_texts(units: DataFrame, lines: DataFrame) -> DataFrame:
    """(document_id, line_no, unit_type, number, key, detected_by, text): each provision with its whole text, the
    lines from its heading to its end. The heading is carried down to its lines over buckets of lines; the lines
    of one provision make a group."""
    own = units.where(F.col("unit_type").isin(*PROVISIONS)).select("document_id", "line_no", F.struct(F.col("line_no").alias("first"), F.col("line_end").alias("final")).alias("_own"))
    rows = carried(lines.select("document_id", "line_no", "text").join(own, ["document_id", "line_no"], "left"), "document_id", "line_no", {"_in": F.col("_own")}, own=True).where("line_no <= _in.final")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n")
    held = rows.groupBy("document_id", F.col("_in.first").alias("line_no")).agg(text.alias("_text"))
    return units.join(held, ["document_id", "line_no"]).select("document_id", "line_no", "unit_type", "number", "key", "detected_by", F.col("_text").alias("text"))


def provision_classes(provisions: DataFrame, clusters: DataFrame) -> DataFrame:
    """(document_id, key, class_hash, documents, same_instrument): provisions whose text, in single spaces and
    with compatibility characters folded, stands in two documents or more; whether all of those are one
    instrument. A document without a cluster is an instrument of its own. Classes are counted by their hash; no
    list of members is gathered."""
    rows = provisions.select("document_id", "key", F.sha2(T.squeeze(nfkc("text")), 256).alias("class_hash"))
    rows = rows.join(clusters, "document_id", "left").withColumn("instrument", F.coalesce("cluster_id", "document_id"))
    each = rows.groupBy("class_hash").agg(F.countDistinct("document_id").alias("documents"), (F.countDistinct("instrument") == 1).alias("same_instrument")).where("documents > 1")
    return rows.join(each, "class_hash").select("document_id", "key", "class_hash", "documents", "same_instrument")


def version_mates(provisions: DataFrame, clusters: DataFrame) -> DataFrame:
    """(document_id, key, mate_id, mate_key): for each provision of a document in a cluster, the provision of the
    same kind and number in each other document of the cluster that has exactly one such."""
    rows = provisions.where("number is not null").join(clusters, "document_id").select("cluster_id", "unit_type", "number", "document_id", "key")
    single = rows.groupBy("cluster_id", "unit_type", "number", "document_id").agg(F.count("*").alias("n"), F.min("key").alias("mate_key")).where("n = 1").select("cluster_id", "unit_type", "number", F.col("document_id").alias("mate_id"), "mate_key")
    return rows.join(single, ["cluster_id", "unit_type", "number"]).where("document_id <> mate_id").select("document_id", "key", "mate_id", "mate_key")


def document_meta(documents: DataFrame, listed: DataFrame, lines: DataFrame, units: DataFrame, assessed: DataFrame) -> DataFrame:
    """One row a document: its own record, filled from its latest listing; the size of its text, lines and pages;
    its provisions, how they were found and which keys occur twice; and its last assessment. ``listed`` and
    ``assessed`` hold one row a document."""
    own = listed.select("document_id", *[F.col(c).alias(f"_{c}") for c in ("short_title", "act_number", "ministry", "department", "parent_title", "parent_handle", "enactment_date", "india_code_url")])
    size = lines.groupBy("document_id").agg((F.sum(F.length("text")) + F.count("*") - 1).alias("char_count"), F.count("*").alias("line_count"), F.countDistinct("page_number").alias("page_count"))
    found = units.where(F.col("unit_type").isin(*PROVISIONS))
    keys = found.groupBy("document_id", "key").agg(F.count("*").alias("n")).groupBy("document_id").agg(F.sum("n").alias("provisions"), F.count_if(F.col("n") > 1).alias("ambiguous_keys"), F.sum(F.col("n") - 1).alias("duplicate_keys"))
    by = found.groupBy("document_id", "detected_by").agg(F.count("*").alias("n")).groupBy("document_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "detected_by", "n"))), ",").alias("detected_by"))
    last = assessed.select("document_id", F.col("classification").alias("extraction_quality"), F.col("score").alias("extraction_quality_score"))
    out = documents
    for part in (own, size, keys, by, last):
        out = out.join(part, "document_id", "left")
    fill = lambda c, d: F.coalesce(F.nullif(F.col(c), F.lit("")), F.nullif(F.col(d), F.lit(""))).alias(c)
    some = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return out.select(
        "document_id", "title", F.col("_short_title").alias("short_title"), "category", "document_type", "jurisdiction", "year", F.col("_act_number").alias("act_number"), fill("enactment_date", "_enactment_date"),
        F.col("_ministry").alias("ministry"), F.col("_department").alias("department"), fill("parent_title", "_parent_title"), F.col("_parent_handle").alias("parent_handle"), F.col("_india_code_url").alias("listing_url"), "source_url", "sha256", "bytes",
        some("char_count"), some("line_count"), some("page_count"), some("provisions"), some("duplicate_keys"), some("ambiguous_keys"), "detected_by", "extraction_quality", "extraction_quality_score",
    )


def citation(title: Column, unit_type: Column, number: Column) -> Column:
    """How a person would name a provision: the title, the kind in short and the number."""
    short = F.lit(ABBREVIATIONS["section"])
    for kind, said in ABBREVIATIONS.items():
        short = F.when(unit_type == kind, said).otherwise(short)
    return F.concat(title, F.lit(", "), short, F.lit(" "), number)


def evidence_exclusion(tier: Column, ambiguous: Column, conflicted: Column, structured: Column, text: Column, least: int = 200, most: int = 6000, stub_words: int = 12) -> Column:
    """The first rule by which a provision is no evidence, null if none: a weak detector, an ambiguous key, titles in
    conflict, a document without structure, too short, too long, or a placeholder for what was left out."""
    n = F.length(text)
    stub = text.rlike(r"(?i)[\[(]?\s*\b(omitted|repealed|rep|reserved|deleted)\b\.?\s*[\])]?") & (F.size(T.all_matches(text, r"\w+")) <= stub_words)
    return F.when(tier != "high", "tier").when(ambiguous, "ambiguous").when(conflicted, "title_conflict").when(~structured, "structure").when(stub, "stub").when(n < least, "too_short").when(n > most, "too_long")


def pages_to_index(pages: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The pages of an English document; of a bilingual one those that aren't in another script as a whole, or
    hold enough of their own English lines; none where the language was not established. ``pages`` holds
    (document_id, page_number, verdict, mangled, english_letters), ``verdicts`` (document_id, content_language)."""
    rows = pages.join(verdicts, "document_id")
    kept = ~F.coalesce(F.col("mangled"), F.lit(False)) & ((F.col("english_letters") >= 200) | (F.col("verdict") != "non_en"))
    return rows.where((F.col("content_language") == "en") | ((F.col("content_language") == "bilingual_en") & kept)).select("document_id", "page_number")


def sound_pages(pages: DataFrame) -> DataFrame:
    """Pages (document_id, page_number, verdict) that are good, and those too short to judge of documents whose
    judged pages are mostly good; a document with no page to judge has none."""
    per = pages.groupBy("document_id").agg(F.count_if(F.col("verdict") == "good").alias("good"), F.count_if(F.col("verdict") == "suspect").alias("suspect"))
    return pages.join(per, "document_id").where((F.col("verdict") == "good") | ((F.col("verdict") == "unjudged") & (F.col("good") > F.col("suspect")))).select("document_id", "page_number")


def text_faults(meta: DataFrame, texts: DataFrame, pages: DataFrame, provisions: DataFrame) -> DataFrame:
    """(document_id, problem): where published texts are not what their records say. ``meta`` holds (document_id,
    sha256, char_count, line_count), ``texts`` (document_id, text), ``pages`` (document_id, page_number, char_start,
    char_end), ``provisions`` (document_id, key, char_start, char_end, text_sha256)."""
    from folioflow.operators.dq import span_text_differs
    from folioflow.operators.lines import tiling_faults

    rows = meta.join(texts, "document_id", "left")
    n = F.length("text")
    rules = F.array(
        F.when(F.col("text").isNull(), "no text"), F.when(F.sha2("text", 256) != F.col("sha256"), "text hash differs"), F.when(n != F.col("char_count"), "text length differs"),
        F.when((n > 0) & (F.size(T.split_lines(F.col("text"))) != F.col("line_count")), "line count differs"),
    )
    own = rows.select("document_id", F.explode(F.array_compact(rules)).alias("problem"))
    gaps = tiling_faults(pages).select("document_id", F.lit("page map has a gap or overlap").alias("problem")).distinct()
    ends = pages.groupBy("document_id").agg(F.max("char_end").alias("end")).join(texts.select("document_id", n.alias("n")), "document_id").where("end <> n").select("document_id", F.lit("page map ends elsewhere").alias("problem"))
    spans = span_text_differs(provisions, texts).select("document_id", F.concat(F.lit("provision differs: "), "key").alias("problem"))
    return own.unionByName(gaps).unionByName(ends).unionByName(spans)


def fingerprint(files: DataFrame) -> DataFrame:
    """(files, fingerprint): what a result must name to be comparable: one hash over the hashes of all files (path,
    sha256), in any order; added up by partial sums, so nothing is gathered."""
    h = F.sha2(F.concat_ws("  ", "sha256", "path"), 256)
    words = [F.sum(F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)")).alias(f"w{k}") for k in range(8)]
    return files.agg(F.count("*").alias("files"), *words).select("files", F.sha2(F.concat_ws("-", *[F.coalesce(F.col(f"w{k}"), F.lit(0)).cast("string") for k in range(8)]), 256).alias("fingerprint"))
