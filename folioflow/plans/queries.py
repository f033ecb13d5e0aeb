"""The core queries: each reads whole tables of ``sf_dir`` and applies one operator to them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.functions import unicode as U
from folioflow.operators import corpus, dedup, dq, html, journal, lines, panels, respace, retrieval, sampling, spans, stats, structure
from folioflow.session import cut, stage
from folioflow.sources.readers import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
BUDGETS = [2000, 8000, 32000]


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _asked(spark: SparkSession, d: str) -> DataFrame:
    """Questions without repeats; repeated rows are alike."""
    return table(spark, d, "questions").dropDuplicates(["question_id"])


# Scans and joins


@query
def corpus_identity(spark: SparkSession, d: str) -> DataFrame:
    last = journal.latest(table(spark, d, "inventory").select("document_id", "discovered_at", "enactment_date", "year"), "document_id", "discovered_at", "year")
    last = last.select("document_id", F.col("enactment_date").alias("listed_date"), F.col("year").alias("listed_year"))
    out = table(spark, d, "corpus_documents").join(last, "document_id", "left")
    return out.select("document_id", "category", "title", F.coalesce("year", "listed_year").alias("year"), F.coalesce("enactment_date", "listed_date").alias("enactment_date"), F.col("listed_year").isNotNull().alias("listed"))


@query
def documents_without_lines(spark: SparkSession, d: str) -> DataFrame:
    return dq.unmatched(table(spark, d, "corpus_documents"), table(spark, d, "page_lines"), "document_id").select("document_id", "category")


@query
def listings_merged(spark: SparkSession, d: str) -> DataFrame:
    return dedup.merged_listings(table(spark, d, "inventory"), ["title", "ministry", "department", "act_number"])


@query
def address_parts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "corpus_documents")
    return rows.select("document_id", *[c.alias(n) for n, c in T.url_parts(F.col("source_url")).items()], T.url_parts(F.col("primary_pdf_url"))["kind"].alias("file_kind"), T.url_parts(F.col("primary_pdf_url"))["file_name"].alias("pdf_name"))


@query
def gold_keys(spark: SparkSession, d: str) -> DataFrame:
    g = _asked(spark, d).select("question_id", F.explode("gold_evidence").alias("g")).select("question_id", "g.group_id", F.posexplode("g.locations").alias("location", "x"))
    return g.select("question_id", "group_id", "location", "x.document_id", T.path_key(F.col("x.unit_path")).alias("path_key"), (F.col("x.char_end") - F.col("x.char_start")).alias("length"))


@query
def title_slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "corpus_documents").select("document_id", U.slug("title").alias("slug"))


@query
def bands(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "corpus_documents").select(T.era_band(F.col("year")).alias("era"), T.size_band(F.col("bytes")).alias("size"))
    return rows.groupBy("era", "size").agg(F.count("*").alias("n"))


@query
def readable_sizes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "corpus_documents")
    return rows.select("document_id", T.year_of(F.col("enactment_date")).alias("enacted"), (F.col("bytes") >= 1024 * 1024).alias("large"), T.host_allowed(F.col("source_url"), ["laws.example"]).alias("own_host"))


# Lines


@query
def line_stream(spark: SparkSession, d: str) -> DataFrame:
    rows = lines.without_labelled(lines.deduplicated(table(spark, d, "page_lines")), table(spark, d, "furniture_lines"))
    return lines.line_stream(rows).select("document_id", "stream_index", "line_no")


@query
def line_offsets(spark: SparkSession, d: str) -> DataFrame:
    return lines.line_offsets(lines.deduplicated(table(spark, d, "page_lines"))).select("document_id", "stream_index", "char_start", "char_end")


@query
def page_map(spark: SparkSession, d: str) -> DataFrame:
    return lines.page_map(lines.line_offsets(lines.deduplicated(table(spark, d, "page_lines"))))


@query
def zone_lines(spark: SparkSession, d: str) -> DataFrame:
    z = lines.zone_lines(lines.deduplicated(table(spark, d, "page_lines")))
    return z.select("document_id", "stream_index", "zone")


@query
def recurring_furniture(spark: SparkSession, d: str) -> DataFrame:
    return lines.furniture(lines.deduplicated(table(spark, d, "page_lines"))).select("document_id", "page_number", "stream_index", "kind")


@query
def page_number_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = lines.deduplicated(table(spark, d, "page_lines"))
    return rows.where(T.is_page_number(F.col("text"))).select("document_id", "stream_index", F.trim("text").alias("text"))


@query
def text_windows(spark: SparkSession, d: str) -> DataFrame:
    return lines.windows_of(table(spark, d, "documents")).select("doc_id", "start", "end", F.length("body").alias("length"))


@query
def gold_unions(spark: SparkSession, d: str) -> DataFrame:
    gold = spans.gold_locations(_asked(spark, d)).select("document_id", F.col("char_start").alias("start"), F.col("char_end").alias("end"))
    return lines.merged_intervals(gold, "document_id")


# Duplicates


def _folded(spark: SparkSession, d: str) -> DataFrame:
    """The documents with compatibility characters folded."""
    return table(spark, d, "documents").withColumn("text", U.nfkc("text"))


@query
def line_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return dedup.fingerprints(_folded(spark, d)).withColumn("fingerprint", F.lower(F.hex("fingerprint")))


@query
def shared_line_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dedup.candidate_pairs(dedup.fingerprints(_folded(spark, d)))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    prints = cut(dedup.fingerprints(_folded(spark, d)))
    return dedup.scored_edges(dedup.candidate_pairs(prints), prints)


@query
def near_dup_edges(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d).withColumn("relation", dedup.relation(F.col("jaccard"), F.lit(0.0), F.col("containment")))


@query
def exact_text_links(spark: SparkSession, d: str) -> DataFrame:
    return dedup.identity_links(table(spark, d, "documents"))


def _links(docs: DataFrame, sets: DataFrame, jaccard: float, containment: float | None = None) -> DataFrame:
    """Scored edges between the firsts of equal line sets (``dedup.line_sets``), without a cap on how many
    documents a line is in."""
    firsts = sets.where("doc_id = first and n >= " + str(dedup.MIN_SHARED)).select("doc_id")
    prints = cut(dedup.fingerprints(docs.join(firsts, "doc_id", "left_semi")))
    return dedup.scored_edges(dedup.alike_pairs(prints, "doc_id", jaccard, containment), prints).where(F.col("shared") >= dedup.MIN_SHARED)


@query
def line_sets(spark: SparkSession, d: str) -> DataFrame:
    """Each document with fingerprints beside the least document with the same ones."""
    return dedup.line_sets(_folded(spark, d)).select("doc_id", "first")


@query
def near_dup_links(spark: SparkSession, d: str) -> DataFrame:
    """All near duplicates and containing texts between the firsts of ``line_sets``; ``near_dup_edges`` is
    the reference's list, in which lines of more than 50 documents propose no pair."""
    docs = _folded(spark, d)
    edges = _links(docs, dedup.line_sets(docs), dedup.VERSION, dedup.CONTAINS)
    return edges.withColumn("relation", dedup.relation(F.col("jaccard"), F.lit(0.0), F.col("containment"))).where("relation <> 'unrelated'")


def _clusters(spark: SparkSession, d: str) -> DataFrame:
    docs, folded = table(spark, d, "documents"), _folded(spark, d)
    sets = cut(dedup.line_sets(folded))
    edges = _links(folded, sets, dedup.SAME)
    same = edges.where(dedup.relation(F.col("jaccard"), F.lit(0.0), F.col("containment")) == "same_instrument").select("a", "b")
    members = sets.where((F.col("doc_id") != F.col("first")) & (F.col("n") >= dedup.MIN_SHARED)).select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    copies = dedup.identity_links(docs).select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    return dedup.clusters(same.unionByName(members).unionByName(copies))


@query
def dup_clusters(spark: SparkSession, d: str) -> DataFrame:
    return _clusters(spark, d).select(F.col("node").alias("doc_id"), "cluster")


@query
def cluster_names(spark: SparkSession, d: str) -> DataFrame:
    return dedup.numbered(_clusters(spark, d)).select(F.col("node").alias("doc_id"), "cluster_id")


@query
def cluster_representatives(spark: SparkSession, d: str) -> DataFrame:
    members = _clusters(spark, d).join(table(spark, d, "documents").select(F.col("doc_id").alias("node"), "n_chars", "source"), "node")
    return dedup.representatives(members, "cluster", -F.col("n_chars"), F.col("node")).select("cluster", F.col("node").alias("doc_id"), "n_chars")


@query
def shared_passages(spark: SparkSession, d: str) -> DataFrame:
    rows = lines.from_texts(_folded(spark, d)).where(F.length("line") >= 40)
    return dedup.span_classes(rows, "doc_id", "line")


def _title_sets(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "corpus_documents").where("title is not null").select("document_id", T.title_words(F.col("title")).alias("words"))
    return cut(dedup.word_sets(t, "document_id", "words"))


def _title_set_pairs(sets: DataFrame) -> DataFrame:
    return dedup.set_pairs(sets.where("document_id = first"), "first", "words")


@query
def title_sets(spark: SparkSession, d: str) -> DataFrame:
    """Each titled document beside the least document whose title has the same words."""
    return _title_sets(spark, d).select("document_id", "first")


@query
def title_set_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of different sets of title words that are alike, each under its least document (``title_sets``)."""
    return _title_set_pairs(_title_sets(spark, d))


@query
def title_pairs(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of documents whose titles share half of their words or more, with how alike they are: the
    pairs of sets, and of each set with itself, for all their members."""
    sets = _title_sets(spark, d)
    same = sets.groupBy("first").agg(F.count("*").alias("n")).where("n > 1").select(F.col("first").alias("a"), F.col("first").alias("b"), F.lit(1.0).alias("likeness"))
    found = _title_set_pairs(sets).unionByName(same)
    side = lambda c: sets.select(F.col("first").alias(c), F.col("document_id").alias(f"d{c}"))
    rows = found.join(side("a"), "a").join(side("b"), "b").where("a <> b or da < db")
    return rows.select(F.least("da", "db").alias("a"), F.greatest("da", "db").alias("b"), "likeness")


# Panels


@query
def text_signals(spark: SparkSession, d: str) -> DataFrame:
    s = panels.with_signals(table(spark, d, "documents"))
    return s.select("doc_id", "characters", "word_count", "token_count", "mean_word_length", "single_char_rate", "mixed_case_rate", "alnum_mix_rate", "common_word_rate", "vowelless_ratio", "replacement_char_count")


@query
def quality_panel(spark: SparkSession, d: str) -> DataFrame:
    q = panels.quality_panel(panels.with_signals(table(spark, d, "documents")))
    return q.select("doc_id", "score", "classification", F.array_join("failed_checks", ",").alias("failed"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """The text of each page; pages are bounded by what they are printed on."""
    rows = lines.deduplicated(table(spark, d, "page_lines"))
    page = rows.groupBy("document_id", "page_number").agg(F.array_sort(F.collect_list(F.struct("stream_index", "text"))).alias("l"))
    return page.select("document_id", "page_number", F.array_join(F.transform("l", lambda x: x["text"]), "\n").alias("text"))


@query
def page_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return panels.with_signals(_pages(spark, d)).select("document_id", "page_number", "word_count", panels.page_verdict().alias("verdict"))


@query
def worst_pages(spark: SparkSession, d: str) -> DataFrame:
    """The five pages of each document with the shortest words, of those long enough to tell."""
    from pyspark.sql import Window

    s = panels.with_signals(_pages(spark, d)).where("word_count >= 60")
    w = Window.partitionBy("document_id").orderBy("mean_word_length", "page_number")
    return s.withColumn("rank", F.row_number().over(w)).where("rank <= 5").select("document_id", "page_number", "rank")


@query
def mangled_pages(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).where(panels.mangled(F.col("text"))).select("document_id", "page_number")


@query
def language_verdicts(spark: SparkSession, d: str) -> DataFrame:
    s = panels.language_signals(table(spark, d, "documents"))
    return s.select("doc_id", "clean_word_count", F.round("function_word_rate", 4).alias("function_word_rate"), "distinct_function_words", panels.content_language().alias("verdict"))


@query
def script_profile(spark: SparkSession, d: str) -> DataFrame:
    names = ["devanagari", "bengali", "tamil", "greek", "cyrillic"]
    return table(spark, d, "documents").select("doc_id", *[c.alias(n) for n, c in T.script_counts(F.coalesce("text", F.lit("")), names).items()])


@query
def line_languages(spark: SparkSession, d: str) -> DataFrame:
    rows = lines.deduplicated(table(spark, d, "page_lines")).select("document_id", panels.line_language(F.col("text")).alias("verdict"))
    return rows.groupBy("document_id", "verdict").agg(F.count("*").alias("n"))


@query
def page_language_profile(spark: SparkSession, d: str) -> DataFrame:
    pages = _pages(spark, d).select("document_id", "page_number", panels.page_language(F.col("text")).alias("verdict"))
    return panels.page_language_profile(pages).withColumn("numbers", F.array_join("numbers", ","))


@query
def word_validity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return panels.word_validity(docs, panels.vocabulary(docs))


@query
def glued_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.glued_token_rate(F.col("text")).alias("glued"), F.size(T.quotes(F.col("text"))).alias("quotes"))


@query
def page_measures(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", *[c.alias(n) for n, c in T.measure(F.col("text")).items()])


@query
def table_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Texts of rows divided by tabs or bars, with the rule by which they are no table."""
    docs = table(spark, d, "documents")
    rows = F.filter(T.split_lines(F.col("text")), lambda x: (F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit("")))) > 0)
    cells = docs.select("doc_id", F.transform(rows, lambda r: F.split(r, r"\|", -1)).alias("cells")).where(F.size("cells") > 0)
    return cells.select("doc_id", F.size("cells").alias("rows"), F.coalesce(panels.table_verdict(F.col("cells")), F.lit("table")).alias("verdict"))


@query
def respaced_documents(spark: SparkSession, d: str) -> DataFrame:
    """How many words of each text were run together and parted, and a hash of the text they make. The test
    texts have none: what it must show there is that no sound text is touched."""
    docs = table(spark, d, "documents")
    out = respace.respaced(docs.where("text is not null"), panels.vocabulary(docs), "doc_id")
    return out.select("doc_id", "changed", F.sha2("text", 256).alias("hash"))


def _item_pages(spark: SparkSession, d: str) -> DataFrame:
    """Each document's record as the repository's item page writes it: tags, a table of labels and a file."""
    safe = lambda c: F.replace(F.replace(F.replace(F.replace(F.col(c).cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    tag = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f'<meta name="DC.{c}" content="'), safe(c), F.lit('">')))
    row = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"<tr><td>{c}:</td><td>"), safe(c), F.lit("</td></tr>")))
    file = F.when(F.col("primary_pdf_url").isNotNull(), F.concat(F.lit('<a href="'), safe("primary_pdf_url"), F.lit('">'), F.coalesce(safe("language"), F.lit("")), F.lit("</a>")))
    page = F.concat_ws("", F.lit("<html><head>"), tag("title"), tag("jurisdiction"), F.lit("</head><body><table>"), row("year"), row("handle"), F.lit("</table>"), file, F.lit("</body></html>"))
    return html.page_rows(table(spark, d, "corpus_documents").select("document_id", F.coalesce("source_url", F.lit("")).alias("url"), page.alias("html")), key="document_id")


@query
def item_metadata(spark: SparkSession, d: str) -> DataFrame:
    return html.metadata(_item_pages(spark, d), "document_id").select("document_id", "name", F.array_join("values", "|").alias("values"))


@query
def item_files(spark: SparkSession, d: str) -> DataFrame:
    links = html.file_links(_item_pages(spark, d), "document_id")
    return html.the_english_file(links.withColumn("language", html.link_language()), "document_id")


# Structure


def _stream(spark: SparkSession, d: str) -> DataFrame:
    return stage(lines.line_stream(lines.deduplicated(table(spark, d, "page_lines"))).select("document_id", "line_no", "page_number", "text"), "stream")


@query
def contents_pages(spark: SparkSession, d: str) -> DataFrame:
    return structure.contents_pages(lines.deduplicated(table(spark, d, "page_lines")))


@query
def anchors(spark: SparkSession, d: str) -> DataFrame:
    return structure.anchors(_stream(spark, d)).select("document_id", "line_no", "unit_type", "number", "detected_by")


@query
def provision_style(spark: SparkSession, d: str) -> DataFrame:
    return structure.provision_style(structure.anchors(_stream(spark, d)))


@query
def ascending_numbers(spark: SparkSession, d: str) -> DataFrame:
    return structure.ascending_share(structure.anchors(_stream(spark, d)))


def _units(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    stream = _stream(spark, d)
    found = stage(structure.in_sequence(structure.chosen_provisions(stage(structure.anchors(stream), "anchors"))), "provisions")
    return stage(structure.unit_spans(found, stream), "units"), stream


@query
def legal_units(spark: SparkSession, d: str) -> DataFrame:
    units, _ = _units(spark, d)
    return lines.numbered_keys(units, "key", "document_id", "line_no").select("document_id", "line_no", "line_end", "unit_type", "unique_key", "ambiguous")


@query
def section_bodies(spark: SparkSession, d: str) -> DataFrame:
    units, stream = _units(spark, d)
    return structure.section_bodies(units, stream)


@query
def preambles(spark: SparkSession, d: str) -> DataFrame:
    stream = _stream(spark, d)
    return structure.preambles(stream, structure.anchors(stream))


@query
def structure_summary(spark: SparkSession, d: str) -> DataFrame:
    units, _ = _units(spark, d)
    return structure.structure_summary(units).select("document_id", "provisions", "units", "confidence")


@query
def number_ambiguity(spark: SparkSession, d: str) -> DataFrame:
    """In how many documents each kind and number of provision stands."""
    found = structure.anchors(_stream(spark, d)).where(F.col("unit_type").isin("section", "article") & F.col("number").isNotNull())
    return found.groupBy("unit_type", "number").agg(F.countDistinct("document_id").alias("documents"))


@query
def cross_references(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of a section, with the line that opens it where the document has one section of that number."""
    stream = _stream(spark, d)
    heads = structure.anchors(stream).where("unit_type = 'section'").groupBy("document_id", "number").agg(F.count("*").alias("n"), F.min("line_no").alias("target")).where("n = 1").drop("n")
    said = stream.select("document_id", "line_no", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\b[Ss]ections?\s+([0-9]{1,4}[A-Z]{0,3})\b"), F.lit(1)))).alias("number"))
    return said.join(heads, ["document_id", "number"]).where("line_no <> target")


@query
def document_titles(spark: SparkSession, d: str) -> DataFrame:
    return structure.titles(_stream(spark, d), table(spark, d, "corpus_documents"))


# The corpus


def _instrument_edges(spark: SparkSession, d: str) -> DataFrame:
    """Near duplicates among the documents by their lines, titles, files and the places that titles name."""
    rows = lines.deduplicated(table(spark, d, "page_lines"))
    named = table(spark, d, "collections").where("jurisdiction is not null").select(F.lower("jurisdiction").alias("j")).distinct()
    places = {r["j"]: (r["j"],) for r in named.collect()}  # one row a collection of the repository
    facts = table(spark, d, "corpus_documents").select("document_id", "title", "sha256")
    text = rows.groupBy("document_id").agg(F.sha2(F.concat_ws("-", F.sum(F.xxhash64("stream_index", "text").cast("decimal(38,0)")).cast("string"), F.count("*").cast("string")), 256).alias("text_hash"))
    return cut(corpus.review_band(corpus.instrument_edges(corpus.line_prints(rows), facts.join(text, "document_id", "left"), places)))


@query
def instrument_edges(spark: SparkSession, d: str) -> DataFrame:
    return _instrument_edges(spark, d)


@query
def instrument_clusters(spark: SparkSession, d: str) -> DataFrame:
    return corpus.instrument_clusters(_instrument_edges(spark, d))


def _provisions(spark: SparkSession, d: str) -> DataFrame:
    units, stream = _units(spark, d)
    keyed = lines.numbered_keys(units, "key", "document_id", "line_no")
    texts = corpus.provision_texts(keyed.withColumn("key", F.col("unique_key")), stream)
    return stage(texts.join(keyed.select("document_id", "line_no", "ambiguous"), ["document_id", "line_no"]), "provision-texts")


@query
def provision_classes(spark: SparkSession, d: str) -> DataFrame:
    return corpus.provision_classes(_provisions(spark, d), corpus.instrument_clusters(_instrument_edges(spark, d)))


@query
def version_mates(spark: SparkSession, d: str) -> DataFrame:
    return corpus.version_mates(_provisions(spark, d).where("not ambiguous"), corpus.instrument_clusters(_instrument_edges(spark, d)))


@query
def evidence_exclusions(spark: SparkSession, d: str) -> DataFrame:
    """How many provisions each rule leaves out of the evidence, by document type; ``eligible`` is the rest."""
    rows = _provisions(spark, d)
    conflicts = _instrument_edges(spark, d).where("title_conflict").select(F.explode(F.array("a", "b")).alias("document_id")).distinct().withColumn("conflicted", F.lit(True))
    sizes = rows.groupBy("document_id").agg((F.count("*") >= 3).alias("structured"))
    rows = rows.join(conflicts, "document_id", "left").join(sizes, "document_id").join(table(spark, d, "corpus_documents").select("document_id", "document_type"), "document_id")
    tier = structure.evidence_tier(F.col("detected_by"), F.array(F.lit(0)), F.array().cast("array<int>"))
    reason = corpus.evidence_exclusion(tier, F.col("ambiguous"), F.coalesce("conflicted", F.lit(False)), F.col("structured"), F.col("text"))
    return rows.groupBy("document_type", F.coalesce(reason, F.lit("eligible")).alias("reason")).agg(F.count("*").alias("n"))


@query
def document_meta(spark: SparkSession, d: str) -> DataFrame:
    units, stream = _units(spark, d)
    cols = ("short_title", "act_number", "ministry", "department", "parent_title", "parent_handle", "enactment_date", "india_code_url")
    listed = journal.latest(table(spark, d, "inventory").select("document_id", "discovered_at", *cols), "document_id", "discovered_at", *cols)
    q = table(spark, d, "quality_assessments").select("document_id", "assessed_at", "classification", "score")
    return corpus.document_meta(table(spark, d, "corpus_documents"), listed, lines.deduplicated(table(spark, d, "page_lines")), units, journal.latest(q, "document_id", "assessed_at", "score", "classification"))


@query
def provision_citations(spark: SparkSession, d: str) -> DataFrame:
    units, _ = _units(spark, d)
    rows = units.where(F.col("unit_type").isin(*structure.PROVISIONS)).join(table(spark, d, "corpus_documents").select("document_id", "title"), "document_id")
    return rows.select("document_id", "line_no", corpus.citation(F.col("title"), F.col("unit_type"), F.col("number")).alias("citation"))


@query
def sound_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = panels.with_signals(_pages(spark, d)).select("document_id", "page_number", panels.page_verdict().alias("verdict"))
    return corpus.sound_pages(cut(pages))


# Retrieval


@query
def content_word_counts(spark: SparkSession, d: str) -> DataFrame:
    w = T.content_words(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(w).alias("words"), F.size(F.array_distinct(w)).alias("different"))


@query
def document_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.postings(table(spark, d, "documents"), ["doc_id"], "text").groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


def _terms(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.query_terms(table(spark, d, "eval_items"), "item_id", "text")


@query
def bm25_documents(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.search(_terms(spark, d), table(spark, d, "documents"), "item_id", ["doc_id"], "text", 10).select("item_id", "doc_id", "rank")


WINDOW_KEY = ["doc_id", "start", "end"]


def _windows(spark: SparkSession, d: str) -> DataFrame:
    return lines.windows_of(table(spark, d, "documents"))


@query
def bm25_windows(spark: SparkSession, d: str) -> DataFrame:
    found = retrieval.search(_terms(spark, d), _windows(spark, d), "item_id", WINDOW_KEY, "body", retrieval.window_count(2000))
    return retrieval.fill_budget(found, "item_id", 2000).select("item_id", "rank", "doc_id", "start", "end")


@query
def bm25_two_stage(spark: SparkSession, d: str) -> DataFrame:
    terms = _terms(spark, d)
    first = retrieval.search(terms, table(spark, d, "documents"), "item_id", ["doc_id"], "text", 5).select("item_id", "doc_id")
    found = retrieval.search(terms, _windows(spark, d), "item_id", WINDOW_KEY, "body", retrieval.window_count(2000), within=cut(first))
    return retrieval.fill_budget(found, "item_id", 2000).select("item_id", "rank", "doc_id", "start", "end")


@query
def wording_leakage(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "eval_items").select("item_id", F.round(T.leakage(F.col("question"), F.col("text")), 4).alias("leakage"))


# Spans


@query
def oracle_spans(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.oracle_spans(_asked(spark, d))


def _pieces(spark: SparkSession, d: str) -> DataFrame:
    return cut(spans.within_budget(retrieval.oracle_spans(_asked(spark, d), noise=200), BUDGETS))


@query
def budget_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d)


@query
def span_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Gold locations covered by the raw spans of a noisy retriever, overlaps among them not removed."""
    asked = _asked(spark, d)
    raw = retrieval.oracle_spans(asked, noise=-50).withColumn("budget", F.lit(0).cast("bigint"))
    return spans.coverage(raw, spans.gold_locations(asked)).select("question_id", "group_id", "location", "covered", F.round("coverage", 4).alias("coverage"))


@query
def question_scores(spark: SparkSession, d: str) -> DataFrame:
    out = spans.question_scores(_asked(spark, d), _pieces(spark, d), BUDGETS)
    return out.select("question_id", "category", "budget", F.round("recall", 4).alias("recall"), F.round("document_recall", 4).alias("document_recall"), F.round("precision", 4).alias("precision"), "used")


@query
def score_report(spark: SparkSession, d: str) -> DataFrame:
    return spans.report(spans.question_scores(_asked(spark, d), _pieces(spark, d), BUDGETS))


@query
def mean_reciprocal_rank(spark: SparkSession, d: str) -> DataFrame:
    asked = _asked(spark, d)
    hits = spans.first_hits(_pieces(spark, d).where("budget = 32000"), spans.gold_locations(asked))
    groups = spans.gold_locations(asked).select("question_id", "group_id").distinct()
    per = groups.join(hits, ["question_id", "group_id"], "left").groupBy("question_id").agg(F.avg(F.coalesce(1.0 / F.col("rank"), F.lit(0.0))).alias("rr"))
    return per.join(asked.select("question_id", "category"), "question_id").groupBy("category").agg(F.round(F.avg("rr"), 4).alias("mrr"), F.count("*").alias("questions"))


@query
def gold_answer_scores(spark: SparkSession, d: str) -> DataFrame:
    """The given answers, quoted whole and with their own citations, against facts, evidence and page texts."""
    asked = _asked(spark, d)
    answers = asked.select("question_id", F.concat(F.lit('"'), F.coalesce("gold_answer", F.lit("")), F.lit('"')).alias("answer"), F.col("must_cite").alias("citations"))
    out = spans.answer_scores(asked, answers, _pages(spark, d))
    return out.select("question_id", *[F.round(c, 4).alias(c) for c in ("facts", "citation_precision", "citation_recall", "grounded")], "quotes")


# Samples


@query
def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.top_by_hash(table(spark, d, "corpus_documents"), ["category"], "document_id", 25).select("document_id", "category", "rank")


@query
def seats_by_category(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "corpus_documents").groupBy("category").agg(F.count("*").cast("double").alias("share"))
    return sampling.largest_remainder(n, "category", "share", 100)


@query
def dev_test_split(spark: SparkSession, d: str) -> DataFrame:
    q = _asked(spark, d).select("question_id", "category", F.coalesce("jurisdiction_hint", F.lit("")).alias("place"))
    return sampling.stratified_split(q, ["category", "place"], "question_id").select("question_id", "split")


@query
def round_robin_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "corpus_documents").withColumn("place", F.coalesce("jurisdiction", F.lit("")))
    return sampling.round_robin(rows, "document_type", "place", "document_id", 40).select("document_id", "document_type", "place")


@query
def drawn_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "corpus_documents").withColumn("place", F.coalesce("jurisdiction", F.lit("")))
    seats = sampling.largest_remainder(rows.groupBy("category").agg(F.count("*").cast("double").alias("share")), "category", "share", 80)
    return sampling.draw(rows, "category", "place", "document_id", seats).select("document_id", "category")


@query
def balanced_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "corpus_documents").select("document_id", "category", F.coalesce("jurisdiction", F.lit("")).alias("place"), F.concat_ws("/", T.era_band(F.col("year")), T.size_band(F.col("bytes"))).alias("cell"))
    return sampling.spread_greedily(rows, "category", "cell", "place", "document_id", sampling.scaled_quotas({"central_acts": 25, "state_acts": 30, "rules": 25, "regulations": 20}, 100))


# Statistics


@query
def size_description(spark: SparkSession, d: str) -> DataFrame:
    return stats.describe(table(spark, d, "corpus_documents"), ["document_type"], "bytes")


def _probes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "corpus_documents").withColumn("place", F.coalesce("jurisdiction", F.lit("")))
    return sampling.round_robin(rows, "document_type", "place", "document_id", 40)


@query
def stratified_size(spark: SparkSession, d: str) -> DataFrame:
    return stats.stratified_estimate(table(spark, d, "corpus_documents"), _probes(spark, d), "document_type", "bytes")


@query
def total_size(spark: SparkSession, d: str) -> DataFrame:
    return stats.estimate_total(stats.stratified_estimate(table(spark, d, "corpus_documents"), _probes(spark, d), "document_type", "bytes"))


@query
def size_by_place(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "corpus_documents").withColumn("place", F.coalesce("jurisdiction", F.lit("")))
    return stats.estimate_by_cell(rows, _probes(spark, d), "document_type", "place", "bytes")


def _labels(spark: SparkSession, d: str) -> DataFrame:
    """The verdicts of the last and of the first assessment of each document."""
    q = table(spark, d, "quality_assessments").select("document_id", "assessed_at", F.lower(F.nullif(F.trim("classification"), F.lit(""))).alias("verdict"))
    a = q.groupBy("document_id").agg(F.max_by("verdict", F.struct("assessed_at", "verdict")).alias("last"), F.min_by("verdict", F.struct("assessed_at", "verdict")).alias("first"))
    return a


@query
def verdict_confusion(spark: SparkSession, d: str) -> DataFrame:
    return stats.confusion(_labels(spark, d), "first", "last")


@query
def acceptance_safety(spark: SparkSession, d: str) -> DataFrame:
    rows = _labels(spark, d).join(table(spark, d, "corpus_documents").select("document_id", "category"), "document_id")
    return stats.safety(rows, ["category"], F.coalesce(F.col("last") == "good", F.lit(False)), F.col("first").isin("bad"), F.col("first").isin("good"))


@query
def corpus_counts(spark: SparkSession, d: str) -> DataFrame:
    return stats.counts_by(table(spark, d, "corpus_documents"), "category", "document_type", "jurisdiction", "language_source")


@query
def label_count_difference(spark: SparkSession, d: str) -> DataFrame:
    n = lambda t: table(spark, d, t).groupBy(F.coalesce("document_type", F.lit("none")).alias("document_type")).agg(F.count("*").alias("n"))
    return stats.count_difference(n("inventory"), n("corpus_documents"), ["document_type"])


@query
def changed_labels(spark: SparkSession, d: str) -> DataFrame:
    last = journal.latest(table(spark, d, "inventory").select("document_id", "discovered_at", "title", "language", "jurisdiction", "year"), "document_id", "discovered_at", "title", "language", "jurisdiction", "year")
    return stats.changed_rows(table(spark, d, "corpus_documents"), last, "document_id", ["title", "language", "jurisdiction", "year"])


@query
def failed_check_coverage(spark: SparkSession, d: str) -> DataFrame:
    names = spark.createDataFrame([(n,) for n in ("alnum_mix_rate", "alpha_ratio", "common_word_rate", "mean_word_length", "mixed_case_rate", "single_char_rate", "symbol_ratio", "vowelless_ratio")], "check string")
    return stats.coverage_of(table(spark, d, "quality_assessments"), "failed_checks", names, "check")


@query
def extreme_documents(spark: SparkSession, d: str) -> DataFrame:
    return stats.extremes(table(spark, d, "corpus_documents"), {"largest": "bytes", "newest": "year"}, "document_id")


# Journals


@query
def latest_assessments(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "quality_assessments").select("document_id", "assessed_at", "classification", "score")
    return journal.latest(q, "document_id", "assessed_at", "score", "classification")


@query
def latest_events(spark: SparkSession, d: str) -> DataFrame:
    return journal.latest(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id")


@query
def attempt_counts(spark: SparkSession, d: str) -> DataFrame:
    return journal.attempts(table(spark, d, "quality_assessments"), "document_id", F.coalesce(F.col("classification") == "bad", F.lit(False)))


@query
def listing_versions(spark: SparkSession, d: str) -> DataFrame:
    return journal.versions(table(spark, d, "inventory"), "document_id", F.concat_ws("|", F.coalesce("title", F.lit("")), F.coalesce("language", F.lit(""))), "discovered_at")


@query
def work_plan(spark: SparkSession, d: str) -> DataFrame:
    """Documents to assess, by the first reason that holds."""
    state = journal.latest(table(spark, d, "quality_assessments").select("document_id", "assessed_at", "classification", "score", F.col("signals.word_count").alias("words")), "document_id", "assessed_at", "score", "classification", "words")
    none = F.nullif(F.trim("classification"), F.lit("")).isNull()
    reason = journal.first_reason([(F.col("assessed_at").isNull(), "never assessed"), (none, "no verdict"), (F.col("assessed_at") < F.col("downloaded_at"), "outdated"), (F.col("words").isNull(), "no signals")])
    return journal.to_do(table(spark, d, "corpus_documents").select("document_id", "downloaded_at"), state, "document_id", reason).select("document_id", "reason")


@query
def order_changes(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's orders against the one before: whether the status changed."""
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    rows = table(spark, d, "orders").withColumn("before", F.lag("o_orderstatus").over(w))
    return rows.select("o_orderkey", journal.change_kind(F.col("before"), F.col("o_orderstatus")).alias("change"))


# Rules


@query
def question_problems(spark: SparkSession, d: str) -> DataFrame:
    return dq.question_problems(table(spark, d, "questions"))


@query
def location_problems(spark: SparkSession, d: str) -> DataFrame:
    return dq.location_problems(_asked(spark, d), table(spark, d, "corpus_documents"))


@query
def map_faults(spark: SparkSession, d: str) -> DataFrame:
    return lines.tiling_faults(lines.page_map(lines.line_offsets(lines.deduplicated(table(spark, d, "page_lines")))))
