"""Operators on small tables: decision tables, brute force and invariants."""

import random

import pytest
from pyspark.sql import functions as F

from folioflow.operators import corpus, dedup, documents, dq, geometry, graph, html, journal, lines, panels, respace, retrieval, sampling, spans, stats, structure
from folioflow.plans import queries

LINES = "document_id string, stream_index int, page_number int, page_line_index int, text string"


def stream(spark, pages, did="d"):
    rows, n = [], 0
    for p, page in enumerate(pages, 1):
        for i, t in enumerate(page):
            rows.append((did, n, p, i, t))
            n += 1
    return spark.createDataFrame(rows, LINES)


# Graph


@pytest.mark.parametrize("seed", range(3))
def test_components_against_union_find(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(7, x) for x in range(0, 300, 3)] + [(299, 299)]
    parent = list(range(300))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
    got = {r["node"]: r["component"] for r in graph.connected_components(df).collect()}
    assert got == {x: top(x) for e in edges for x in e}


def test_components_of_many_levels(spark, monkeypatch):
    monkeypatch.setattr(graph, "FOREST_EDGES", 10)
    df = spark.createDataFrame([(i, i + 1) for i in range(500)], "a bigint, b bigint").repartition(16)
    assert {r[0] for r in graph.connected_components(df).select("component").distinct().collect()} == {0}


def test_components_that_forests_alone_would_not_shrink(spark, monkeypatch):
    monkeypatch.setattr(graph, "FOREST_EDGES", 40)
    r = random.Random(3)
    names = list(range(900))
    r.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(899) if i % 300] + [(2000, 2001), (5000, 5000)]
    r.shuffle(edges)
    got = {x["node"]: x["component"] for x in graph.connected_components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(8)).collect()}
    want = {}
    for at in ((0,), range(1, 301), range(301, 601), range(601, 900)):
        own = [names[i] for i in at]
        want |= {x: min(own) for x in own if len(own) > 1}
    assert got == want | {2000: 2000, 2001: 2000, 5000: 5000}


def test_components_of_strings_nulls_and_nothing(spark):
    df = spark.createDataFrame([("b", "a"), (None, "x"), ("c", None), ("é", "z")], "a string, b string")
    assert {tuple(r) for r in graph.connected_components(df).collect()} == {("a", "a"), ("b", "a"), ("z", "z"), ("é", "z")}
    assert graph.connected_components(df.limit(0)).count() == 0


# Lines


def test_offsets_and_page_map_tile_the_text(spark):
    df = stream(spark, [["ab", "", "cde"], ["f"], ["gh", "i"]])
    off = lines.line_offsets(lines.deduplicated(df.unionByName(df.limit(2))))
    text = "\n".join(["ab", "", "cde", "f", "gh", "i"])
    for r in off.collect():
        assert text[r["char_start"] : r["char_end"]] == r["text"]
    pages = sorted((r["char_start"], r["char_end"]) for r in lines.page_map(off).collect())
    assert pages[0][0] == 0 and pages[-1][1] == len(text) and all(a[1] == b[0] for a, b in zip(pages, pages[1:]))
    assert lines.tiling_faults(lines.page_map(off)).count() == 0


def test_furniture_needs_enough_pages(spark):
    pages = [["The Running Head", f"body {n} one", f"body {n} two", f"body {n} six", f"between {n}", f"body {n} x", f"{n}"] for n in range(1, 5)]
    got = {(r["page_number"], r["text"], r["kind"]) for r in lines.furniture(stream(spark, pages)).collect()}
    assert {(n, "The Running Head", "header") for n in range(1, 5)} <= got and {(n, str(n), "page_number") for n in range(1, 5)} <= got and len(got) == 8
    assert lines.furniture(stream(spark, pages[:2])).count() == 0


def test_keys_windows_and_intervals(spark):
    df = spark.createDataFrame([("d", "s:1", 1), ("d", "s:1", 5), ("d", "s:2", 7)], "d string, k string, n int")
    assert [(r["unique_key"], r["ambiguous"]) for r in lines.numbered_keys(df, "k", "d", "n").orderBy("n").collect()] == [("s:1", True), ("s:1#2", True), ("s:2", False)]
    for n in (0, 1, 1199, 1200, 1201, 2100, 2101, 5000):
        got = sorted((r["start"], r["end"]) for r in lines.windows_of(spark.createDataFrame([(1, "x" * n)], "doc_id int, text string")).collect())
        want, s = [], 0
        while n:
            want.append((s, min(s + 1200, n)))
            if s + 1200 >= n:
                break
            s += 900
        assert got == want
    iv = spark.createDataFrame([("a", 1, 3), ("a", 3, 5), ("a", 7, 9), ("a", 2, 4)], "g string, start int, end int")
    assert sorted((r["start"], r["end"]) for r in lines.merged_intervals(iv, "g").collect()) == [(1, 5), (7, 9)]


# Duplicates


@pytest.mark.parametrize(
    ("jaccard", "title", "containment", "flags", "want"),
    [(0.2, 0, 0.1, (True, False, True), "identical"), (1.0, 1, 1, (False, True, False), "identical"), (1.0, 1, 1, (False, True, True), "parallel"), (0.95, 0, 0, (), "same_instrument"), (0.6, 0.8, 0, (), "same_instrument"), (0.6, 0.79, 0, (), "parallel"), (0.4, 1, 0.9, (), "contains"), (0.4, 1, 0.89, (), "unrelated")],
)
def test_relations(spark, jaccard, title, containment, flags, want):
    args = [F.lit(x) for x in (jaccard, title, containment, *flags)]
    assert spark.range(1).select(dedup.relation(*args)).first()[0] == want


def test_title_pairs_against_brute_force(spark, tmp_path):
    r = random.Random(5)
    words = ["harbour", "estate", "market", "fund", "council", "tribunal", "parcel", "licence"]
    titles = {f"d{i:03}": " ".join(r.sample(words, r.randint(1, 5))) for i in range(120)} | {f"e{i:02}": "Rare Zanzibar Manifest" for i in range(25)} | {"x": None, "y": "1950"}
    spark.createDataFrame(list(titles.items()), "document_id string, title string").write.parquet(f"{tmp_path}/corpus_documents.parquet")
    sets = {k: frozenset(t.lower().split()) for k, t in titles.items() if t and t != "1950"}
    want = {(a, b, round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 4)) for a in sets for b in sets if a < b and 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b])}
    got = [tuple(x) for x in queries.title_pairs(spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    first = {x["document_id"]: x["first"] for x in queries.title_sets(spark, str(tmp_path)).collect()}
    assert first == {k: min(x for x in sets if sets[x] == s) for k, s in sets.items()}
    assert {tuple(x) for x in queries.title_set_pairs(spark, str(tmp_path)).collect()} == {x for x in want if x[0] == first[x[0]] and x[1] == first[x[1]] and sets[x[0]] != sets[x[1]]}


def test_links_without_a_cap_against_brute_force(spark, tmp_path):
    r = random.Random(9)
    line = lambda i: f"line number {'abcdefghijklmnopqrstuvwxyz'[i % 26]}{i} of the act"
    whole = [line(i) for i in range(40)]
    texts = {i: whole for i in range(60)} | {60: whole[:39], 61: whole[:25], 62: whole[:20] + [line(i) for i in range(50, 65)]}
    texts |= {100 + k: [line(i) for i in r.sample(range(100, 116), r.randint(2, 12))] for k in range(70)}
    spark.createDataFrame([(k, "\n".join(t), "s", 1) for k, t in texts.items()], "doc_id bigint, text string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    sets = {k: frozenset(t) for k, t in texts.items()}
    first = {k: min(x for x in sets if sets[x] == s) for k, s in sets.items()}
    firsts = sorted(set(first.values()))
    want = {}
    for i, a in enumerate(firsts):
        for b in firsts[i + 1 :]:
            n = len(sets[a] & sets[b])
            j, c = round(n / len(sets[a] | sets[b]), 4), round(n / min(len(sets[a]), len(sets[b])), 4)
            if n >= dedup.MIN_SHARED and (j >= 0.5 or c >= 0.9):
                want[a, b] = (n, j, c)
    got = {(x["a"], x["b"]): (x["shared"], x["jaccard"], x["containment"]) for x in queries.near_dup_links(spark, str(tmp_path)).collect()}
    assert got == want and (0, 60) in got and (0, 61) in got
    assert {tuple(x) for x in queries.line_sets(spark, str(tmp_path)).collect()} == set(first.items())
    cluster = {x["doc_id"]: x["cluster"] for x in queries.dup_clusters(spark, str(tmp_path)).collect()}
    assert all(cluster[i] == 0 for i in range(61)) and 61 not in cluster


def test_edges_against_sets(spark):
    r = random.Random(3)
    pool = [" ".join(f"t{r.randrange(200)}" for _ in range(6)) for _ in range(60)]
    docs = {i: "\n".join(r.sample(pool, 12) + ["short line"]) for i in range(25)} | {90: None, 91: ""}
    prints = dedup.fingerprints(spark.createDataFrame(list(docs.items()), "doc_id int, text string"))
    sets = {i: {x for x in (t or "").split("\n") if len(x.split()) >= 5} for i, t in docs.items()}
    want = {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 3}
    got = {(r["a"], r["b"]): (r["shared"], r["jaccard"]) for r in dedup.scored_edges(dedup.candidate_pairs(prints), prints).collect()}
    assert {k: v[0] for k, v in got.items()} == want
    assert all(v[1] == pytest.approx(v[0] / len(sets[k[0]] | sets[k[1]]), abs=1e-4) for k, v in got.items())


def test_listings_merge_in_order(spark):
    df = spark.createDataFrame([("b", " http://x/a b ", "2024-01-02", "B", None, [("s2",)]), ("a", "http://x/a%20b", "2024-01-01", "", "m", [("s1",)]), ("c", None, "2024-01-01", "C", None, None)], "document_id string, english_pdf_url string, discovered_at string, title string, ministry string, sources array<struct<via:string>>")
    rows = dedup.merged_listings(df, ["title", "ministry"]).collect()
    assert [(r["dedup_key"], r["document_id"], r["title"], r["ministry"], r["source_count"], r["listings"]) for r in rows] == [("http://x/a%20b", "a", "B", "m", 2, 2)]


# Panels


def test_panel_levels(spark):
    good = "The officer of the state shall make any order under this section and the court may hear an appeal by any person within the period. " * 6
    bad = "xq zr ~~ Bk tHRg wW qrstv @@ n1x9 zZtk " * 20
    df = spark.createDataFrame([(1, good), (2, bad), (3, "few words"), (4, None)], "doc_id int, text string")
    got = {r["doc_id"]: (r["classification"], r["score"]) for r in panels.quality_panel(panels.with_signals(df)).collect()}
    assert got[1] == ("good", 1.0) and got[2][0] == "bad" and got[3] == got[4] == ("questionable", 0.0)


def test_language_rules(spark):
    en = "the court of the state may by order in any case under this act make such rules as it thinks fit for that purpose and no person shall be or have had more than one of these " * 6
    rows = [(1, en), (2, "देवनागरी लिपि " * 60), (3, en + "देवनागरी लिपि " * 200), (4, "lorem ipsum dolor " * 80), (5, "too short"), (6, None)]
    df = panels.language_signals(spark.createDataFrame(rows, "doc_id int, text string"))
    assert {r[0]: r[1] for r in df.select("doc_id", panels.content_language()).collect()} == {1: "en", 2: "non_en", 3: "en", 4: "non_en", 5: "uncertain", 6: "uncertain"}


def test_tables_orientation_and_resolution(spark):
    grid = [["a", "1"], ["b", "2"], ["c", "3"], ["d", "4"]]
    cases = {"table": grid, "rows": grid[:2], "columns": [["a"]] * 4, "filled": [["a", ""], ["", ""], ["", "b"]], "contents": [[f"{i}. Short title", "x"] for i in range(4)], "column_fill": [["a", "b", "c"], ["a", "b", ""], ["a", "b", ""], ["a", "b", ""]]}
    df = spark.createDataFrame(list(cases.items()), "k string, c array<array<string>>")
    assert all(r["k"] == (r["v"] or "table") for r in df.select("k", panels.table_verdict(F.col("c")).alias("v")).collect())
    o = spark.createDataFrame([([(1.0, 0.0)] * 9, 0), ([(0.0, 1.0)] * 9, 0), ([(0.0, 1.0)] * 9, 90), ([(1.0, 0.0)] * 3, 0), (None, 0)], "d array<struct<x:double,y:double>>, r int")
    assert [r[0] for r in o.select(panels.orientation(F.col("d"), F.col("r"))).collect()] == ["upright", "sideways", "upright", "unknown", "unknown"]
    assert spark.range(1).select(panels.dpi(F.lit(612.0), F.lit(792.0)), panels.dpi(F.lit(6000.0), F.lit(6000.0))).first()[:] == (300, 200)


# Structure


ACT = [["THE RIVER ACT, 1950", "An Act to regulate rivers.", "CHAPTER I", "PRELIMINARY", "1. Short title.—(1) This Act may be called the River Act.", "(2) It extends to the whole land.", "2. Definitions.—In this Act,—", "(a) “river” means", "(i) a stream;", "(ii) a canal;", "(b) “boat” means a vessel."], ["CHAPTER II", "3. Duties.—(1) Every owner shall", "Provided that no owner need", "(2) The board may", "Explanation.—A board is", "THE SCHEDULE", "Rates"]]


def test_the_tree_of_an_act(spark):
    rows = lines.line_stream(stream(spark, ACT))
    units = structure.unit_spans(structure.in_sequence(structure.chosen_provisions(structure.anchors(rows))), rows)
    got = {r["key"]: (r["line_no"], r["line_end"]) for r in units.collect()}
    assert got == {"chapter:I": (2, 10), "chapter:I/section:1": (4, 5), "chapter:I/section:2": (6, 10), "chapter:II": (11, 15), "chapter:II/section:3": (12, 15), "schedule:_": (16, 17)}
    inner = [(r["line_no"], r["line_end"], r["unit_type"], r["label"], r["depth"]) for r in structure.section_bodies(units, rows).orderBy("line_no").collect()]
    assert inner == [(4, 4, "subsection", "1", 1), (5, 5, "subsection", "2", 1), (7, 9, "clause", "a", 1), (8, 8, "subclause", "i", 2), (9, 9, "subclause", "ii", 2), (10, 10, "clause", "b", 1), (12, 13, "subsection", "1", 1), (13, 13, "proviso", None, 2), (14, 15, "subsection", "2", 1), (15, 15, "explanation", None, 2)]
    assert structure.structure_summary(units).first()["confidence"] == "structured"
    assert [(r["line_no"], r["line_end"]) for r in structure.preambles(rows, structure.anchors(rows)).collect()] == [(1, 1)]


HEADINGS = [
    ("PART II", "part", "II", None), ("Part 3-A. Of Owners", "part", "3-A", "Of Owners"), ("PART VIA — OF FUNDS", "part", "VIA", "OF FUNDS"), ("PART-I", None, None, None), ("Part of the river", None, None, None), ("Part I of the Act shall", None, None, None),
    ("CHAPTER 5: Duties", "chapter", "5", "Duties"), ("CHAPTER V,", None, None, None), ("Chapter XIIII", "chapter", "XIIII", None),
    ("THE FIRST SCHEDULE", "schedule", "FIRST", None), ("SCHEDULE II", "schedule", "II", None), ("Second Schedule: Rates", "schedule", "Second", "Rates"), ("THE 3RD SCHEDULE", "schedule", "3RD", None), ("SCHEDULE", "schedule", None, None), ("The schedule of fees", None, None, None), ("the owner", None, None, None),
    ("APPENDIX B", "appendix", "B", None), ("Appendix 2. Forms", "appendix", "2", "Forms"), ("appendixes to", None, None, None),
    ("Article 21.", "article", "21", None), ("ARTICLE 370", "article", "370", None), ("Art. 5 Duties", "article", "5", "Duties"), ("Article 14 – Conflict of rights – Whoever", "article", "14", "Conflict of rights"), ("Article 348 of the Act", None, None, None), ("article 4", None, None, None),
    ("12. Duties of owners.—Whoever holds", "section", "12", "Duties of owners"), ("[12 - A. Fees .-- The fee", "section", "12-A", "Fees"), ("376AB. Fees. – x", "section", "376AB", "Fees"), ("12A. Duties of owners.", "section", "12A", "Duties of owners"), ("12.Duties", None, None, None), ("12345. Duties", None, None, None), ("12 Duties", None, None, None), ("12abc. Duties", None, None, None), ("", None, None, None),
]


def test_headings(spark):
    rows = spark.createDataFrame([(f"d{i:02d}", 0, 1, t) for i, (t, *_) in enumerate(HEADINGS)], "document_id string, line_no int, page_number int, text string")
    got = {r["document_id"]: (r["unit_type"], r["number"], r["heading"]) for r in structure.anchors(rows).collect()}
    assert {HEADINGS[i][0]: got.get(f"d{i:02d}", (None,) * 3) for i in range(len(HEADINGS))} == {t: tuple(x) for t, *x in HEADINGS}


def test_captions_below(spark):
    rows = lines.line_stream(stream(spark, [["CHAPTER V", "OF THE OWNER", "PART I", "(a) BOATS", "SCHEDULE", "Rates of fees", "APPENDIX A", "12. FEES"]]))
    assert [(r["heading"], r["detected_by"]) for r in structure.anchors(rows).where("unit_type <> 'section'").orderBy("line_no").collect()] == [("OF THE OWNER", "chapter_heading_caption_below"), (None, "part_heading"), (None, "schedule_heading"), (None, "appendix_heading")]


def test_units_of_parts_and_schedules(spark):
    rows = lines.line_stream(stream(spark, [["PART I", "CHAPTER 1", "1. A b.", "PART II", "2. C d.", "x", "SCHEDULE I", "1. E f.", "y", "CHAPTER 2", "3. G h."]]))
    got = {r["key"]: (r["line_no"], r["line_end"], r["parent_line"]) for r in structure.unit_spans(structure.anchors(rows), rows).collect()}
    assert got == {"part:I": (0, 2, None), "part:I/chapter:1": (1, 2, 0), "part:I/chapter:1/section:1": (2, 2, 1), "part:II": (3, 5, None), "part:II/section:2": (4, 5, 3), "schedule:I": (6, 8, None), "schedule:I/section:1": (7, 8, 6), "chapter:2": (9, 10, None), "chapter:2/section:3": (10, 10, 9)}


@pytest.mark.parametrize("ahead", [False, True])
def test_carried_over_buckets(spark, monkeypatch, ahead):
    monkeypatch.setattr(lines, "BUCKET", 7)
    r = random.Random(2)
    rows = [(k, i, r.choice([None, None, i])) for k in "ab" for i in range(60) if r.random() < 0.7]
    got = {(x["k"], x["i"]): x["c"] for x in lines.carried(spark.createDataFrame(rows, "k string, i int, v int"), "k", "i", {"c": F.col("v")}, own=False, ahead=ahead).collect()}
    near = (lambda k, i: min((v for q, j, v in rows if q == k and j > i and v is not None), default=None)) if ahead else (lambda k, i: max((v for q, j, v in rows if q == k and j < i and v is not None), default=None))
    assert got == {(k, i): near(k, i) for k, i, _ in rows}


def test_titles(spark):
    rows = lines.line_stream(stream(spark, ACT)).unionByName(lines.line_stream(stream(spark, [["THE HARBOUR RULES OF 1950", "x"]], "e")))
    docs = spark.createDataFrame([("d", "The River  Act, 1950"), ("e", None), ("f", "Gone"), ("g", " ")], "document_id string, title string")
    assert {tuple(r) for r in structure.titles(rows, docs).collect()} == {("d", "The River  Act, 1950", "metadata_confirmed_on_page"), ("e", "THE HARBOUR RULES OF 1950", "first_page_heading"), ("f", "Gone", "metadata"), ("g", None, None)}


def test_contents_pages_are_left_out(spark):
    toc = ["ARRANGEMENT OF SECTIONS", "1. Short title.", "2. Definitions."]
    listing = [f"{i}. Caption" for i in range(1, 7)]
    rows = lines.line_stream(stream(spark, [toc, listing, ACT[0]]))
    assert {r["page_number"] for r in structure.contents_pages(rows).collect()} == {1, 2}
    assert {r["page_number"] for r in structure.anchors(rows).collect()} == {3}


@pytest.mark.parametrize("seed", range(6))
def test_longest_ascending(seed):
    r = random.Random(seed)
    keys = [(r.randrange(12), "") for _ in range(14)]
    kept = structure.longest_ascending(keys)
    best = [1] * len(keys)
    for i in range(len(keys)):
        best[i] = 1 + max([best[j] for j in range(i) if keys[j] <= keys[i]], default=0)
    assert len(kept) == max(best) and kept == sorted(kept) and all(keys[a] <= keys[b] for a, b in zip(kept, kept[1:]))


def test_outliers_go_and_disorder_stays(spark):
    def kept(numbers):
        df = spark.createDataFrame([("d", i, 1, "t", "section", n, "h", "numbered_heading_line") for i, n in enumerate(numbers)], "document_id string, line_no int, page_number int, text string, unit_type string, number string, heading string, detected_by string")
        return [r["number"] for r in structure.in_sequence(df).orderBy("line_no").collect()]

    assert kept(["1", "2", "90", "3", "4", "4A", "5"]) == ["1", "2", "3", "4", "4A", "5"]
    assert kept(["9", "3", "7", "1"]) == ["9", "3", "7", "1"] and kept(["2", "1"]) == ["2", "1"]


def test_tiers(spark):
    df = spark.createDataFrame([("article_marker", [1, 2], [3]), ("article_marker", [1, 3], [3]), ("numbered_heading_line", [1], None), ("numbered_heading_line", [3], [3])], "by string, p array<int>, o array<int>")
    assert [r[0] for r in df.select(structure.evidence_tier(F.col("by"), F.col("p"), F.col("o"))).collect()] == ["high", "medium", "medium", "low"]


# The corpus


def test_instruments_and_what_they_share(spark):
    own = lambda k, n: [f"line {i} of the {k} text is here" for i in range(n)]
    texts = {"a": own("first", 20), "b": own("first", 20), "c": own("first", 15) + own("other", 5), "d": own("first", 20), "e": own("e", 9), "f": own("f", 9), "g": ["short"]}
    rows = spark.createDataFrame([(d, i, t) for d, x in texts.items() for i, t in enumerate(x)], "document_id string, stream_index int, text string")
    facts = [("a", "The Harbour Act", "1", "x"), ("b", "Harbor Act", "2", "x"), ("c", "Harbour Act", "3", "y"), ("d", "Harbour Act of Ombrey", "4", "x"), ("e", "Fees of Orvale", "9", "z"), ("f", "Ferries", "9", "w"), ("g", None, None, None)]
    places = {"ombrey": ("ombrey",), "orvale": ("orvale",)}
    edges = corpus.review_band(corpus.instrument_edges(corpus.line_prints(rows), spark.createDataFrame(facts, "document_id string, title string, sha256 string, text_hash string"), places))
    got = {(r["a"], r["b"]): (r["relation"], r["title_conflict"]) for r in edges.collect()}
    assert got == {("a", "b"): ("identical", False), ("a", "c"): ("same_instrument", False), ("a", "d"): ("identical", False), ("b", "c"): ("same_instrument", False), ("b", "d"): ("identical", False), ("c", "d"): ("parallel", False), ("e", "f"): ("identical", True)}
    clusters = corpus.instrument_clusters(edges)
    assert {tuple(r) for r in clusters.collect()} == {(x, "dup-00001") for x in "abcd"} | {("e", "dup-00002"), ("f", "dup-00002")}
    provisions = spark.createDataFrame([("a", "section:1", "section", "1", "The  fee."), ("b", "section:1", "section", "1", "The fee."), ("e", "section:1", "section", "1", "The\nfee."), ("c", "section:2", "section", "2", "Own."), ("a", "section:2", "section", "2", "x"), ("a", "section:2#2", "section", "2", "y")], "document_id string, key string, unit_type string, number string, text string")
    assert {(r["document_id"], r["documents"], r["same_instrument"]) for r in corpus.provision_classes(provisions, clusters).collect()} == {("a", 3, False), ("b", 3, False), ("e", 3, False)}
    assert {tuple(r) for r in corpus.version_mates(provisions, clusters).collect()} == {("a", "section:1", "b", "section:1"), ("b", "section:1", "a", "section:1"), ("a", "section:2", "c", "section:2"), ("a", "section:2#2", "c", "section:2")}


def test_texts_of_provisions_and_their_faults(spark):
    rows = lines.line_stream(stream(spark, ACT))
    units = structure.unit_spans(structure.in_sequence(structure.chosen_provisions(structure.anchors(rows))), rows)
    texts = {r["key"]: r["text"] for r in corpus.provision_texts(units, rows).collect()}
    assert texts["chapter:I/section:1"] == "\n".join(ACT[0][4:6]) and len(texts) == 3
    meta = spark.createDataFrame([("d", "x", 3, 1), ("e", None, None, None)], "document_id string, sha256 string, char_count int, line_count int")
    body = spark.createDataFrame([("d", "ab\nc")], "document_id string, text string")
    pages = spark.createDataFrame([("d", 1, 0, 2), ("d", 2, 3, 4)], "document_id string, page_number int, char_start int, char_end int")
    spans_ = spark.createDataFrame([("d", "k", 0, 2, "no")], "document_id string, key string, char_start int, char_end int, text_sha256 string")
    assert {tuple(r) for r in corpus.text_faults(meta, body, pages, spans_).collect()} == {("d", "text hash differs"), ("d", "text length differs"), ("d", "line count differs"), ("d", "page map has a gap or overlap"), ("d", "provision differs: k"), ("e", "no text")}


def test_evidence_rules_and_pages(spark):
    df = spark.createDataFrame([("high", False, False, True, "w " * 150), ("low", True, True, False, ""), ("high", True, True, True, ""), ("high", False, False, False, "x"), ("high", False, False, True, "12. [Omitted.]"), ("high", False, False, True, "short text"), ("high", False, False, True, "w " * 5000)], "t string, a boolean, c boolean, s boolean, x string")
    assert [r[0] for r in df.select(corpus.evidence_exclusion(*[F.col(c) for c in ("t", "a", "c", "s", "x")])).collect()] == [None, "tier", "ambiguous", "structure", "stub", "too_short", "too_long"]
    pages = spark.createDataFrame([("d", 1, "good"), ("d", 2, "unjudged"), ("d", 3, "suspect"), ("d", 4, "good"), ("e", 1, "unjudged"), ("f", 1, "suspect"), ("f", 2, "unjudged")], "document_id string, page_number int, verdict string")
    assert {tuple(r) for r in corpus.sound_pages(pages).collect()} == {("d", 1), ("d", 2), ("d", 4)}
    p = spark.createDataFrame([("b", 1, "non_en", False, 300), ("b", 2, "non_en", False, 10), ("b", 3, "en", True, 900), ("e", 1, "non_en", True, 0), ("u", 1, "en", False, 500)], "document_id string, page_number int, verdict string, mangled boolean, english_letters int")
    v = spark.createDataFrame([("b", "bilingual_en"), ("e", "en"), ("u", "uncertain")], "document_id string, content_language string")
    assert {tuple(r) for r in corpus.pages_to_index(p, v).collect()} == {("b", 1), ("e", 1)}
    assert spark.range(1).select(corpus.citation(F.lit("The Act"), F.lit("article"), F.lit("5"))).first()[0] == "The Act, art. 5"
    files = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, sha256 string")
    one, two = corpus.fingerprint(files).first(), corpus.fingerprint(files.orderBy(F.desc("path"))).first()
    assert one == two and one["files"] == 2 and corpus.fingerprint(files.limit(1)).first()["fingerprint"] != one["fingerprint"]


# Retrieval and spans


def test_bm25_against_the_formula(spark):
    import math

    docs = {1: "river boat river", 2: "boat owner", 3: "market fund owner owner", 4: "of the"}
    df = spark.createDataFrame(list(docs.items()), "doc_id int, text string")
    q = spark.createDataFrame([(1, "river owner of the boat"), (2, "the of")], "item_id int, text string")
    terms = retrieval.query_terms(q, "item_id", "text")
    got = {(r["item_id"], r["doc_id"]): r["score"] for r in retrieval.search(terms, df, "item_id", ["doc_id"], "text", 10).collect()}
    bags = {d: [w for w in t.split() if w not in ("of", "the")] for d, t in docs.items()}
    mean = (3 + 2 + 4) / 3
    for d in (1, 2, 3):
        want = 0.0
        for t in ("river", "owner", "boat"):
            tf, df_ = bags[d].count(t), sum(t in b for b in bags.values())
            want += math.log(1 + (4 - df_ + 0.5) / (df_ + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(bags[d]) / mean))
        assert got[1, d] == pytest.approx(want, abs=1e-5)
    assert len(got) == 3


@pytest.mark.parametrize("seed", range(5))
def test_budget_fold_against_characters(seed):
    r = random.Random(seed)
    listed = [(r.choice("ab"), s := r.randrange(60), s + r.randrange(-3, 25)) for _ in range(12)]
    budget = r.randrange(1, 90)
    seen, want = set(), []
    for doc, s, e in listed:
        for c in range(s, e):
            if (doc, c) not in seen and len(want) < budget:
                want.append((doc, c))
            if len(want) < budget or (doc, c) in want:
                seen.add((doc, c))
    got = [(d, c) for _, d, s, e in spans.keep_novel(listed, budget) for c in range(s, e)]
    assert got == want


def test_scores(spark):
    loc = lambda d, s, e: (d, "k", s, e)
    rows = [("q1", "c", [("g1", "required", [loc("a", 0, 100), loc("b", 0, 100)]), ("g2", "sufficient", [loc("a", 500, 600)])]), ("q2", "c", [("g1", "sufficient", [loc("z", 0, 10)])])]
    q = spark.createDataFrame(rows, "question_id string, category string, gold_evidence array<struct<group_id:string,requirement:string,locations:array<struct<document_id:string,key:string,char_start:bigint,char_end:bigint>>>>")
    got = spark.createDataFrame([("q1", 1, "b", 0, 60), ("q1", 2, "a", 500, 540)], "question_id string, rank int, document_id string, start bigint, end bigint")
    pieces = spans.within_budget(got, [50, 1000])
    s = {(r["question_id"], r["budget"]): r for r in spans.question_scores(q, pieces, [50, 1000]).collect()}
    assert s["q1", 1000]["recall"] == 0.5 and s["q1", 1000]["all_required"] == 1 and s["q1", 1000]["document_recall"] == 1.0 and s["q1", 1000]["precision"] == 1.0
    assert s["q1", 50]["recall"] == 0.5 and s["q1", 50]["used"] == 50 and s["q2", 50]["recall"] == 0.0 and s["q2", 50]["precision"] is None
    assert {(r["group_id"], r["rank"]) for r in spans.first_hits(pieces.where("budget = 1000"), spans.gold_locations(q)).collect()} == {("g1", 1)}


def test_the_oracle_covers_everything(spark):
    loc = lambda d, s, e: (d, "k", s, e)
    q = spark.createDataFrame([("q1", "c", [("g1", "sufficient", [loc("a", 0, 9)]), ("g2", "required", [loc("b", 0, 9), loc("c", 5, 9)])])], "question_id string, category string, gold_evidence array<struct<group_id:string,requirement:string,locations:array<struct<document_id:string,key:string,char_start:bigint,char_end:bigint>>>>")
    o = retrieval.oracle_spans(q)
    assert [r["document_id"] for r in o.orderBy("rank").collect()] == ["b", "a", "c"]
    assert spans.question_scores(q, spans.within_budget(o, [100]), [100], 1.0).first()["recall"] == 1.0


# Samples and statistics


def test_quotas_seats_and_splits(spark):
    assert sampling.scaled_quotas({"a": 25, "b": 30, "c": 25, "d": 20}, 10) == {"a": 3, "b": 3, "c": 2, "d": 2} and sum(sampling.scaled_quotas({"a": 98, "b": 1, "c": 1}, 3).values()) == 3
    w = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2)], "n string, s double")
    assert {r["n"]: r["seats"] for r in sampling.largest_remainder(w, "n", "s", 7).collect()} == {"a": 4, "b": 2, "c": 1}
    df = spark.createDataFrame([(f"k{i}", "abc"[i % 3], None if i % 2 else "x") for i in range(100)], "k string, s string, t string")
    rows = sampling.stratified_split(df, ["s", "t"], "k").collect()
    assert len(rows) == 100 and sum(r["split"] == "dev" for r in rows) == 30
    again = {r["k"]: r["split"] for r in sampling.stratified_split(df.repartition(7), ["s", "t"], "k").collect()}
    assert again == {r["k"]: r["split"] for r in rows}


def test_greedy_spread_takes_turns(spark):
    df = spark.createDataFrame([(f"k{i}", "c", f"cell{i % 2}", f"p{i % 5}") for i in range(60)], "k string, s string, cell string, p string")
    rows = sampling.spread_greedily(df, "s", "cell", "p", "k", {"c": 10}).collect()
    assert len(rows) == 10 and sum(r["cell"] == "cell0" for r in rows) == 5 and {sum(r["p"] == f"p{i}" for r in rows) for i in range(5)} == {2}


def test_reports(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y")], "h string, s string")
    got = {(r["h"], r["s"]): r["n"] for r in stats.confusion(df, "h", "s").collect()}
    assert got["a", "x"] == 1 and got["a", "none"] == 1 and got["*", "*"] == 3 and got["a", "*"] == 2
    b, a = spark.createDataFrame([("k", 2), ("gone", 1)], "k string, n bigint"), spark.createDataFrame([("k", 5), ("new", 4)], "k string, n bigint")
    assert {r["k"]: r["delta"] for r in stats.count_difference(b, a, ["k"]).collect()} == {"k": 3, "gone": -1, "new": 4}
    d = stats.describe(spark.createDataFrame([("g", float(x)) for x in (1, 2, 3, 4, 10)] + [("one", 5.0), ("none", None)], "g string, v double"), ["g"], "v")
    rows = {r["g"]: r for r in d.collect()}
    assert rows["g"]["median"] == 3.0 and rows["g"]["p90"] == pytest.approx(7.6) and rows["one"]["deviation"] == 0.0 and rows["none"]["n"] == 0


# Journals


def test_last_records_versions_and_upserts(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "x"), ("b", None, "z"), (None, 9, "w")], "k string, t int, v string")
    assert {tuple(r) for r in journal.latest(df, "k", "t").collect()} == {("a", 3, "y"), ("b", None, "z")}
    assert [(r["k"], r["version"], r["content"], r["valid_from"], r["valid_to"]) for r in journal.versions(df, "k", F.col("v"), "t").orderBy("k", "version").collect()] == [("a", 1, "x", 1, 3), ("a", 2, "y", 3, None)]
    up = journal.upserted(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), spark.createDataFrame([("b", None), ("c", 3)], "k string, v int"), "k")
    assert {tuple(r) for r in up.collect()} == {("a", 1), ("b", None), ("c", 3)}
    raw = spark.createDataFrame([('{"document_id":"a","n":1}',), ("",), ("{broken",), ('{"n":2}',)], "value string")
    assert [tuple(r) for r in journal.parsed(raw, "document_id string, n int", "document_id").collect()] == [("a", 1)]


def test_a_kept_table(spark, tmp_path):
    from folioflow.streaming.journal import into_table

    src, out = tmp_path / "in", str(tmp_path / "table")
    src.mkdir()
    for n, rows in enumerate([[("a", 1, "x"), ("b", 1, "y"), (None, 1, "z")], [("a", 3, "new"), ("a", 2, "old"), ("c", 1, "w")], [("b", 0, "late")]]):
        spark.createDataFrame(rows, "k string, t int, v string").coalesce(1).write.mode("append").json(str(src))
        into_table(spark.readStream.schema("k string, t int, v string").json(str(src)), out, str(tmp_path / "cp"), "k", "t").trigger(availableNow=True).start().awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(out).select("k", "t", "v").collect()} == {("a", 3, "new"), ("b", 1, "y"), ("c", 1, "w")}


def test_a_journal_stream(spark, tmp_path):
    from folioflow.streaming.journal import latest_stream, windowed_counts

    src = tmp_path / "in"
    spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string").coalesce(1).write.json(str(src))
    s = spark.readStream.schema("k string, t int, v string").json(str(src))
    q = latest_stream(s, "k", "t").writeStream.format("memory").queryName("last").outputMode("complete").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.table("last").select("k", "t", "v").collect()} == {("a", 2, "y"), ("b", 1, "z")}
    ev = spark.readStream.schema("k string, t int, v string").json(str(src)).select("k", F.timestamp_seconds(F.col("t") * 86400).alias("ts"))
    q = windowed_counts(ev, "ts", ["k"]).writeStream.format("memory").queryName("days").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("days").count() == 3


# Pages, areas, respacing, rules


PAGE = """<html><head><title>The Act</title><meta name="DC.title" content="The River Act"><meta name="DC.subject" content="a"><meta name="DC.subject" content="b"></head>
<body><table><tr><th>Title:</th><td>The River Act, 1950</td></tr></table><table><tr><td>1</td><td>Rules</td><td><table><tr><td>in</td></tr></table></td><td><a href="/bitstream/1/r_eng.pdf">English</a></td></tr></table>
<a href="/bitstream/1/r_hin.pdf">हिन्दी</a><a href="/about">About</a><script>var x = "<a href='/no'>";</script></body></html>"""


def test_pages(spark):
    df = spark.createDataFrame([(1, "https://x.example/handle/1", PAGE), (2, None, None)], "page_id int, url string, html string")
    rows = html.page_rows(df).cache()
    meta = {r["name"]: r["values"] for r in html.metadata(rows).collect()}
    assert meta["dc.subject"] == ["a", "b"] and meta["title"] == ["The River Act, 1950"]
    links = html.file_links(rows).withColumn("language", html.link_language())
    assert {(r["url"], r["language"]) for r in links.collect()} == {("https://x.example/bitstream/1/r_eng.pdf", "en"), ("https://x.example/bitstream/1/r_hin.pdf", "hi")}
    assert html.the_english_file(links).first()["url"].endswith("r_eng.pdf") and html.listing_rows(rows).first()["cells"][1] == "Rules"


@pytest.mark.parametrize("n", [0, 3, 40, 300])
def test_areas(n):
    r = random.Random(n)
    rects = [(x := r.randrange(90), y := r.randrange(90), x + r.randrange(30), y + r.randrange(30)) for _ in range(n)]
    cells = {(i, j) for a, b, c, d in rects for i in range(a, min(c, 100)) for j in range(b, min(d, 100))}
    assert geometry.covered_area(rects, (0, 0, 100, 100)) == pytest.approx(len(cells), rel=0.02, abs=1e-9)


def test_small_print_at_the_foot(spark):
    rows = [("d", 1, i, t, s, y, 800.0) for i, (t, s, y) in enumerate([("body one", 11.0, 100.0), ("body two", 11.0, 200.0), ("1. Ins. by Act 4", 8.0, 700.0), ("of 1950", 8.0, 720.0)])]
    df = spark.createDataFrame(rows, "document_id string, page_number int, page_line_index int, text string, size double, y0 double, height double")
    assert [tuple(r) for r in geometry.small_print(df).collect()] == [("d", 1, 2, 3)]


@pytest.mark.parametrize(("word", "want"), [("theGovernment", "the Government"), ("subsection12", "subsection 12"), ("ofthecentral", "of the central"), ("McDonald", "McDonald"), ("notwithstanding", "notwithstanding"), ("NOTICE", "NOTICE"), ("unknownwordhere", "unknownwordhere"), ("(underthe),", "(under the),")])
def test_respacing(word, want):
    assert respace.respaced_word(word, frozenset("the government subsection of central notwithstanding under donald".split())) == want


def test_question_rules(spark):
    schema = "question_id string, question string, gold_evidence array<struct<group_id:string,locations:array<struct<document_id:string,key:string,char_start:bigint,char_end:bigint,page_start:int,page_end:int,unit_path:array<struct<unit_type:string,number:string>>,text_sha256:string>>>>, required_facts array<array<string>>, must_cite array<struct<document_id:string,key:string>>, unanswerable boolean"
    loc = ("a", "section:1", 5, 9, 1, 1, [("section", "1")], "0" * 64)
    rows = [("q1", "who", [("g", [loc])], [["12"]], [("a", "section:2")], False), ("q2", " ", None, None, None, False), ("q3", "x", [("g", [("z", "k", 9, 5, 2, 1, [("section", None)], "bad")])], None, None, True), ("q4", "y", [("g", [loc])], [["ten days"]], [("a", "section:1")], False), ("q4", "y", [("g", [loc])], [["ten days"]], [("a", "section:1")], False)]
    q = spark.createDataFrame(rows, schema)
    got = {tuple(r) for r in dq.question_problems(q).collect()}
    assert got == {("q1", "citation outside the evidence"), ("q1", "fact is a number only"), ("q2", "no question"), ("q2", "answerable without evidence"), ("q3", "unanswerable with evidence"), ("q4", "repeated id")}
    bad = {r["problem"] for r in dq.location_problems(q, spark.createDataFrame([("a",)], "document_id string")).where("question_id = 'q3'").collect()}
    assert bad == {"unknown document", "no length", "pages backward", "key and path differ", "no text hash"}


# Documents


def test_page_facts_and_classes(spark):
    rows = [("a", 1, "x" * 100, 0.0, 0), ("a", 2, "y" * 300, None, None), ("s", 1, "", 90.0, 0), ("s", 2, None, 100.0, 0), ("v", 1, "few", 0.0, 50), ("m", 1, "z" * 200, 60.0, 0), ("m", 2, "z" * 200, 0.0, 0)]
    df = spark.createDataFrame([(d, p, t, a, 10.0, 10.0, n) for d, p, t, a, n in rows], "document_id string, page_number int, text string, image_area double, width double, height double, paths int")
    got = {r["document_id"]: (r["pdf_type"], r["text_status"]) for r in documents.document_classes(documents.page_facts(df)).collect()}
    assert got == {"a": ("text_based", "ok"), "s": ("scanned", "requires_ocr"), "v": ("vector_outlined", "requires_ocr"), "m": ("mixed", "ok")}


def test_directions(spark):
    rows = [("a", 1, "upright", 1), ("a", 2, "upright", 1), ("a", 3, "upright", -1), ("a", 4, "sideways", -1), ("b", 1, "upright", 1), ("b", 2, "upright", -1), ("c", 1, "upright", -1), ("c", 2, "unknown", None)]
    df = documents.direction_faults(spark.createDataFrame(rows, "document_id string, page_number int, orientation string, direction int"))
    assert {(r["document_id"], r["page_number"]) for r in df.where("inconsistent").collect()} == {("a", 3), ("b", 2)}
    assert {r["document_id"]: r["ratio"] for r in documents.orientation_summary(df).collect()} == {"a": 0.5, "b": 0.5, "c": 0.0}


def test_readings_and_languages(spark):
    df = spark.createDataFrame([(None, "the new", None, 0.2), ("old the", "", 0.1, 0.9), ("old xx", "the of it", 0.5, 0.9), ("the of", "xx yy", 0.5, 0.9), ("the of", "the of", 0.9, 0.9)], "a string, b string, x double, y double")
    assert [r[0] for r in df.select(documents.better_reading(F.col("a"), F.col("b"), F.col("x"), F.col("y"))).collect()] == [True, False, True, False, False]
    d = spark.createDataFrame([("a", "en"), ("b", "en"), ("c", "en"), ("d", "non_en"), ("e", "en")], "document_id string, verdict string")
    p = spark.createDataFrame([("a", 4, 0, 0.0), ("b", 4, 2, 0.5), ("c", 2, 2, 1.0)], "document_id string, measurable int, non_en_pages int, non_en_ratio double")
    assert {tuple(r) for r in documents.document_language(d, p).collect()} == {("a", "en"), ("b", "bilingual_en"), ("c", "uncertain"), ("d", "non_en"), ("e", "en")}


def test_answers(spark):
    loc = lambda d, k: (d, k, 0, 9)
    q = spark.createDataFrame([("q1", "c", [["ten days", "10 days"], ["fine"]], [("g1", "required", [loc("a", "s:1"), loc("b", "s:1")]), ("g2", "required", [loc("a", "s:2")])])], "question_id string, category string, required_facts array<array<string>>, gold_evidence array<struct<group_id:string,requirement:string,locations:array<struct<document_id:string,key:string,char_start:bigint,char_end:bigint>>>>")
    a = spark.createDataFrame([("q1", 'Within 10 Days, as "the owner shall pay" and "not in any text".', [("b", "s:1"), ("a", "s:9")])], "question_id string, answer string, citations array<struct<document_id:string,key:string>>")
    t = spark.createDataFrame([("b", "… the owner shall pay the fund")], "document_id string, text string")
    r = spans.answer_scores(q, a, t).first()
    assert (r["facts"], r["citation_precision"], r["citation_recall"], r["quotes"], r["grounded"]) == (0.5, 0.5, 0.5, 2, 0.5)
