"""DuckDB SQL for the core queries. Operators that SQL cannot state (string matching by edit ratio, the
nesting of units, sequential choices) have none; the tests hold those against brute force."""

from __future__ import annotations

from folioflow.functions.wordlists import COMMON_WORDS, FUNCTION_WORDS, STOPWORDS, TITLE_STOPWORDS


def _list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _words(text: str) -> str:
    return f"regexp_extract_all({text}, '[A-Za-z]+')"


def _content(text: str) -> str:
    return f"list_filter(list_transform(regexp_extract_all(coalesce({text}, ''), '[A-Za-z0-9]+'), lambda w: lower(w)), lambda w: length(w) > 1 AND NOT list_contains({_list(STOPWORDS)}, w))"


def _share(a: str, b: str, digits: int = 4) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE round(CAST({a} AS DOUBLE) / ({b}), {digits}) END"


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


LINES = "(SELECT document_id, stream_index, min(page_number) AS page_number, min(page_line_index) AS page_line_index, coalesce(min(text), '') AS text FROM page_lines WHERE document_id IS NOT NULL AND stream_index IS NOT NULL GROUP BY 1, 2)"
OFFSETS = f"(SELECT *, char_start + length(text) AS char_end FROM (SELECT *, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY document_id ORDER BY stream_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_start FROM {LINES}))"
STREAM = f"(SELECT document_id, page_number, text, CAST(row_number() OVER (PARTITION BY document_id ORDER BY stream_index) - 1 AS INTEGER) AS line_no FROM {LINES} WHERE trim(regexp_replace(text, '[\\s\\x{{00A0}}]+', '', 'g')) <> '')"
PAGES = f"(SELECT document_id, page_number, string_agg(text, chr(10) ORDER BY stream_index) AS text FROM {LINES} GROUP BY 1, 2)"
MAP = f"(SELECT document_id, page_number, char_start, coalesce(lead(char_start) OVER (PARTITION BY document_id ORDER BY char_start), last) AS char_end FROM (SELECT document_id, page_number, min(char_start) AS char_start, max(char_end) AS last FROM {OFFSETS} GROUP BY 1, 2))"
ASKED = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id) AS _n FROM questions) WHERE _n = 1)"
GROUPS = f"(SELECT question_id, category, g, gold_evidence[g] AS grp FROM (SELECT *, unnest(range(1, len(gold_evidence) + 1)) AS g FROM {ASKED}))"
GOLD = f"(SELECT question_id, category, g, grp.group_id AS group_id, grp.requirement AS requirement, CAST(l - 1 AS INTEGER) AS location, grp.locations[l] AS x FROM (SELECT *, unnest(range(1, len(grp.locations) + 1)) AS l FROM {GROUPS}))"
# Compatibility characters that the texts hold: full-width forms, spaces of other widths and ligatures.
_SPACES = "".join(map(chr, (0xA0, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)))
_WIDE, _PLAIN_FORMS = ("".join(chr(at + i) for i in range(94)).replace("'", "''") + tail for at, tail in ((0xFF01, _SPACES), (0x21, " " * len(_SPACES))))
_NFKC = f"nfc_normalize(replace(replace(replace(replace(replace(translate(text, '{_WIDE}', '{_PLAIN_FORMS}'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl'), 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'))"
PRINTS = f"(SELECT DISTINCT doc_id, sha256(array_to_string(w, ' ')) AS fingerprint FROM (SELECT doc_id, regexp_extract_all(unnest(string_split(lower({_NFKC}), chr(10))), '[a-z0-9]+') AS w FROM documents) WHERE len(w) >= 5)"
PAIRS = f"(SELECT a, b, count(*) AS shared FROM (SELECT p.doc_id AS a, q.doc_id AS b FROM {PRINTS} p JOIN {PRINTS} q ON p.fingerprint = q.fingerprint AND p.doc_id < q.doc_id JOIN (SELECT fingerprint FROM {PRINTS} GROUP BY 1 HAVING count(*) BETWEEN 2 AND 50) r ON r.fingerprint = p.fingerprint) GROUP BY 1, 2 HAVING count(*) >= 3)"
EDGES = f"""(SELECT a, b, shared, round(CAST(shared AS DOUBLE) / (na + nb - shared), 4) AS jaccard, round(CAST(shared AS DOUBLE) / least(na, nb), 4) AS containment FROM (
 SELECT c.a, c.b, count(*) AS shared, any_value(x.n) AS na, any_value(y.n) AS nb FROM {PAIRS} c JOIN {PRINTS} p ON p.doc_id = c.a JOIN {PRINTS} q ON q.doc_id = c.b AND q.fingerprint = p.fingerprint
 JOIN (SELECT doc_id, count(*) AS n FROM {PRINTS} GROUP BY 1) x ON x.doc_id = c.a JOIN (SELECT doc_id, count(*) AS n FROM {PRINTS} GROUP BY 1) y ON y.doc_id = c.b GROUP BY 1, 2))"""
COPIES = "(SELECT first, doc_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first FROM documents WHERE trim(text) <> '') WHERE doc_id <> first)"
CLUSTERS = f"""(WITH RECURSIVE link AS (SELECT a, b FROM {EDGES} WHERE jaccard >= 0.95 UNION SELECT first, doc_id FROM {COPIES}),
 both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link), reach AS (SELECT a AS node, a AS seen FROM both_ways UNION SELECT r.node, w.b FROM reach r JOIN both_ways w ON w.a = r.seen)
 SELECT node, min(seen) AS cluster FROM reach GROUP BY 1)"""
RELATION = "CASE WHEN jaccard >= 0.95 THEN 'same_instrument' WHEN jaccard >= 0.5 THEN 'parallel' WHEN containment >= 0.9 THEN 'contains' ELSE 'unrelated' END"
TITLES = f"list_sort(list_distinct(list_filter(regexp_extract_all(lower(coalesce(title, '')), '[a-z]+'), lambda w: NOT list_contains({_list(TITLE_STOPWORDS)}, w))))"

_T = "coalesce(text, '')"
_SOLID = f"list_filter(regexp_split_to_array({_T}, '\\s+'), lambda t: t <> '')"
_MIXED = f"len(list_filter({_words(_T)}, lambda w: length(w) >= 4 AND NOT regexp_full_match(w, '[a-z]+|[A-Z]+|[A-Z][a-z]+')))"
_LONG = f"list_filter({_words(_T)}, lambda w: length(w) >= 4)"
_NOISE = "[^\\p{L}\\p{N}\\s.,;:()\\[\\]{}''\"/\\-–—―‐’‘“”…§¶&%*!?°×]"
SIGNALS = f"""(SELECT *, length({_T}) AS characters, len({_words(_T)}) AS word_count, len({_SOLID}) AS token_count,
 {_share(f"length(array_to_string({_words(_T)}, ''))", f"len({_words(_T)})", 3)} AS mean_word_length,
 {_share(f"len(list_filter({_words(_T)}, lambda w: length(w) = 1))", f"len({_words(_T)})")} AS single_char_rate,
 {_share(_MIXED, f"len({_words(_T)})")} AS mixed_case_rate,
 {_share(f"len(list_filter({_SOLID}, lambda t: length(t) >= 4 AND regexp_matches(t, '[A-Za-z]') AND regexp_matches(t, '[0-9]')))", f"len({_SOLID})")} AS alnum_mix_rate,
 {_share(_count(_T, "\\p{L}"), f"length({_T})")} AS alpha_ratio,
 {_share(f"len(list_filter({_words(_T)}, lambda w: list_contains({_list(COMMON_WORDS)}, lower(w))))", f"len({_words(_T)})")} AS common_word_rate,
 {_share(_count(_T, _NOISE), f"length({_T})")} AS symbol_ratio,
 {_share(f"len(list_filter({_LONG}, lambda w: NOT regexp_matches(w, '[aeiouyAEIOUY]')))", f"len({_LONG})")} AS vowelless_ratio,
 length({_T}) - length(replace({_T}, chr(65533), '')) AS replacement_char_count FROM """
_CHECKS = {
    "mean_word_length": ("mean_word_length >= 4.2", 2.0), "single_char_rate": ("single_char_rate <= 0.12", 2.0), "mixed_case_rate": ("mixed_case_rate <= 0.01", 2.0), "alnum_mix_rate": ("alnum_mix_rate <= 0.035", 1.5),
    "alpha_ratio": ("alpha_ratio >= 0.5", 1.0), "common_word_rate": ("common_word_rate >= 0.28", 1.0), "symbol_ratio": ("symbol_ratio <= 0.06", 1.0), "vowelless_ratio": ("vowelless_ratio <= 0.15", 1.0),
}
_WON = " + ".join(f"CASE WHEN {c} THEN {w} ELSE 0.0 END" for c, w in _CHECKS.values())
_FAILED = "list_sort(list_filter([" + ", ".join([*(f"CASE WHEN NOT ({c}) THEN '{n}' END" for n, (c, _) in _CHECKS.items()), "CASE WHEN replacement_char_count > 0 THEN 'replacement_characters' END"]) + "], lambda x: x IS NOT NULL))"
_SHAPE = "(CAST(mean_word_length < 4.2 AS INT) + CAST(single_char_rate > 0.12 AS INT) + CAST(mixed_case_rate > 0.01 AS INT))"
PANEL = f"""SELECT doc_id, CASE WHEN few THEN 0.0 ELSE score END AS score, CASE WHEN few THEN 'questionable' WHEN shape >= 3 THEN 'bad' WHEN score >= 0.8 THEN CASE WHEN shape >= 2 THEN 'questionable' ELSE 'good' END WHEN score >= 0.55 THEN 'questionable' ELSE 'bad' END AS classification,
 CASE WHEN few THEN 'insufficient_text' ELSE failed END AS failed FROM (SELECT doc_id, word_count < 60 AS few, {_SHAPE} AS shape, round(({_WON}) / (11.5 + CASE WHEN replacement_char_count > 0 THEN 1.0 ELSE 0.0 END), 4) AS score, array_to_string({_FAILED}, ',') AS failed FROM {SIGNALS} documents))"""

_LETTERS = _count("text", "\\p{L}")
_LATIN = _count("text", "\\p{Latin}")
LINE_LANGUAGE = f"CASE WHEN {_LETTERS} < 10 THEN 'unknown' WHEN {_LETTERS} - {_LATIN} >= 0.25 * {_LETTERS} THEN 'non_en' ELSE 'en' END"
_RATE = f"(CASE WHEN len({_words('text')}) = 0 THEN 0.0 ELSE CAST(len(list_filter({_words('text')}, lambda w: list_contains({_list(FUNCTION_WORDS)}, lower(w)))) AS DOUBLE) / len({_words('text')}) END)"
MANGLED = f"""(word_count >= 40 AND (((CAST(length(array_to_string({_words('text')}, '')) AS DOUBLE) / word_count) < 2.0 AND symbol_ratio >= 0.15 AND {_RATE} < 0.15)
 OR ({_RATE} < 0.06 AND (CAST(length(array_to_string({_words('text')}, '')) AS DOUBLE) / word_count) < 3.0 AND (symbol_ratio >= 0.05 OR vowelless_ratio >= 0.25))))"""
_CLEAN = "list_transform(list_filter(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+'), lambda w: regexp_full_match(w, '[a-z]{2,}|[A-Z]{2,}|[A-Z][a-z]+')), lambda w: lower(w))"
LANGUAGE = f"""SELECT doc_id, n AS clean_word_count, round(rate, 4) AS function_word_rate, distinct_function_words, CASE
 WHEN other >= 0.25 AND letters >= 200 AND NOT (rate >= 0.15 AND distinct_function_words >= 12 AND n >= 150) THEN 'non_en'
 WHEN n < 150 AND NOT (n >= 60 AND rate >= 0.3 AND distinct_function_words >= 12) THEN 'uncertain' WHEN n < 150 THEN 'en' WHEN rate <= 0.08 THEN 'non_en'
 WHEN rate >= 0.15 AND distinct_function_words >= 12 THEN 'en' ELSE 'uncertain' END AS verdict FROM (
 SELECT doc_id, len(w) AS n, CASE WHEN len(w) = 0 THEN 0.0 ELSE CAST(len(h) AS DOUBLE) / len(w) END AS rate, len(list_distinct(h)) AS distinct_function_words, letters, CASE WHEN letters = 0 THEN 0.0 ELSE (letters - latin) / CAST(letters AS DOUBLE) END AS other FROM (
 SELECT doc_id, w, list_filter(w, lambda x: list_contains({_list(FUNCTION_WORDS)}, x)) AS h, letters, latin FROM (SELECT doc_id, {_CLEAN} AS w, {_LETTERS} AS letters, {_LATIN} AS latin FROM documents)))"""

# Provisions are read by what stands before a line's first full stop and what closes the caption after it. The
# tables have no parts, chapters, schedules or articles; those readings are held against a table of cases in the tests.
_BARE = "regexp_replace(text, '^[\\s\\x{00A0}]+|[\\s\\x{00A0}]+$', '', 'g')"
_CONTENTS = _list(("index", "section", "sections", "content", "contents", "table of content", "table of contents", *(f"arrangement of {x}{s}" for x in ("section", "rule", "regulation", "clause", "chapter", "paragraph") for s in ("", "s"))))
_NUMBERED = "regexp_full_match(number, '[0-9]{1,4}(-?[A-Z]{1,3})?')"


def _read(lines: str) -> str:
    return f"""(SELECT *, regexp_replace(trim(rest), '\\s*\\.$', '') AS plain, CASE WHEN {_NUMBERED} AND stopped AND length(closed) BETWEEN 1 AND 199 THEN closed END AS dashed FROM (
 SELECT *, regexp_extract(rest, '^\\s*(\\S.*?)\\s*\\.\\s*[‐‑‒–—―-]', 1) AS closed FROM (
 SELECT *, regexp_replace(rtrim(split_part(inside, '.', 1)), '\\s?-\\s?', '-') AS number, contains(inside, '.') AS stopped, substr(inside, length(split_part(inside, '.', 1)) + 2) AS rest FROM (
 SELECT *, regexp_replace(bare, '^\\[\\s*', '') AS inside FROM (SELECT *, {_BARE} AS bare FROM {lines}))) WHERE regexp_matches(inside, '^[0-9]') OR list_contains({_CONTENTS}, regexp_replace(lower(bare), '[.:]+$', ''))))"""


def _contents(lines: str) -> str:
    entry = f"NOT starts_with(bare, '[') AND {_NUMBERED} AND (NOT stopped OR trim(rest) = '' OR (regexp_matches(rest, '^\\s') AND length(trim(rest)) <= 119 AND dashed IS NULL))"
    return f"""(SELECT document_id, page_number FROM (SELECT document_id, page_number, count(*) FILTER (WHERE {entry}) AS entries, bool_or(list_contains({_CONTENTS}, regexp_replace(lower(bare), '[.:]+$', ''))) AS named FROM {_read(lines)} GROUP BY 1, 2)
 JOIN (SELECT document_id, page_number, count(*) AS n FROM {lines} GROUP BY 1, 2) USING (document_id, page_number) WHERE named OR (entries >= 5 AND entries * 2 >= n))"""


CONTENTS = _contents(LINES)
ANCHORS = f"""(SELECT document_id, line_no, page_number, 'section' AS unit_type, number, CASE WHEN dashed IS NOT NULL THEN 'numbered_heading_dash' ELSE 'numbered_heading_line' END AS detected_by FROM {_read(STREAM)} r
 WHERE {_NUMBERED} AND stopped AND (dashed IS NOT NULL OR (regexp_matches(rest, '^\\s') AND length(plain) BETWEEN 1 AND 199 AND length(bare) <= 200)) AND NOT EXISTS (SELECT 1 FROM {_contents(STREAM)} c WHERE c.document_id = r.document_id AND c.page_number = r.page_number))"""
FORMULA = "regexp_matches(lower(text), '(^|\\s)(an\\s+act\\s+to|an\\s+act\\s+further\\s+to|whereas|be\\s+it\\s+enacted|in\\s+exercise\\s+of\\s+the\\s+powers\\s+conferred)([^a-z0-9]|$)')"

# The characters of ranked spans that no earlier span of the document holds: between any two ends the least rank.
RANKED = f"(SELECT question_id, document_id, rank, greatest(0, start - 200) AS start, \"end\" + 200 AS \"end\" FROM (SELECT question_id, CAST(row_number() OVER (PARTITION BY question_id ORDER BY CAST(location > 0 AS INTEGER), CAST(requirement <> 'required' AS INTEGER), g, location) AS INTEGER) AS rank, x.document_id AS document_id, x.char_start AS start, x.char_end AS \"end\" FROM {GOLD}))"
NOVEL = f"""(WITH s AS (SELECT * FROM {RANKED} WHERE "end" > start), pt AS (SELECT question_id, document_id, start AS a FROM s UNION SELECT question_id, document_id, "end" FROM s),
 seg AS (SELECT *, lead(a) OVER (PARTITION BY question_id, document_id ORDER BY a) AS b FROM pt),
 own AS (SELECT seg.question_id, seg.document_id, a, b, min(rank) AS rank FROM seg JOIN s ON s.question_id = seg.question_id AND s.document_id = seg.document_id AND s.start <= a AND s."end" >= b GROUP BY 1, 2, 3, 4),
 isl AS (SELECT *, sum(fresh) OVER (PARTITION BY question_id, document_id, rank ORDER BY a ROWS UNBOUNDED PRECEDING) AS i FROM (SELECT *, CASE WHEN lag(b) OVER (PARTITION BY question_id, document_id, rank ORDER BY a) = a THEN 0 ELSE 1 END AS fresh FROM own))
 SELECT *, coalesce(sum(b - a) OVER (PARTITION BY question_id ORDER BY rank, a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT question_id, document_id, rank, min(a) AS a, max(b) AS b FROM isl GROUP BY question_id, document_id, rank, i))"""
PIECES = f"(SELECT question_id, budget, rank, document_id, a AS start, CAST(least(b, a + budget - before) AS BIGINT) AS \"end\" FROM {NOVEL}, (VALUES (2000), (8000), (32000)) b(budget) WHERE before < budget)"
SPANS_SCORED = f"""(WITH p AS MATERIALIZED (SELECT * FROM {PIECES}), gold AS (SELECT question_id, group_id, requirement, location, x.document_id AS document_id, x.char_start AS cs, x.char_end AS ce FROM {GOLD}),
 held AS (SELECT g.question_id, g.group_id, g.requirement, g.location, g.budget, ce - cs AS n, coalesce(sum(greatest(0, least(p."end", ce) - greatest(p.start, cs))) FILTER (WHERE p.start IS NOT NULL), 0) AS o FROM (SELECT * FROM gold, (VALUES (2000), (8000), (32000)) b(budget)) g LEFT JOIN p ON p.question_id = g.question_id AND p.document_id = g.document_id AND p.budget = g.budget GROUP BY g.question_id, g.group_id, g.requirement, g.location, g.document_id, g.budget, cs, ce),
 grp AS (SELECT question_id, budget, group_id, requirement, max(CASE WHEN n > 0 AND CAST(o AS DOUBLE) / n >= 0.5 THEN 1 ELSE 0 END) AS hit, sum(o) AS o FROM held GROUP BY 1, 2, 3, 4)
 SELECT question_id, category, budget, recall, all_required, coalesce(docs, 0) / CAST(gold_docs AS DOUBLE) AS document_recall, CASE WHEN used > 0 THEN o / CAST(used AS DOUBLE) END AS precision, CAST(coalesce(used, 0) AS BIGINT) AS used FROM
 (SELECT question_id, budget, avg(hit) AS recall, min(hit) FILTER (WHERE requirement = 'required') AS all_required, sum(o) AS o FROM grp GROUP BY 1, 2)
 JOIN (SELECT question_id, count(DISTINCT document_id) AS gold_docs FROM gold GROUP BY 1) USING (question_id)
 LEFT JOIN (SELECT question_id, budget, count(DISTINCT document_id) AS docs FROM p WHERE (question_id, document_id) IN (SELECT (question_id, document_id) FROM gold) GROUP BY 1, 2) USING (question_id, budget)
 LEFT JOIN (SELECT question_id, budget, sum("end" - start) AS used FROM p GROUP BY 1, 2) USING (question_id, budget) JOIN (SELECT question_id, category FROM {ASKED}) USING (question_id))"""
RECIPROCAL = f"""WITH p AS (SELECT * FROM {PIECES} WHERE budget = 32000), o AS (SELECT l.question_id, l.group_id, l.location, l.x.char_start AS cs, l.x.char_end AS ce, p.rank, sum(greatest(0, least(p."end", l.x.char_end) - greatest(p.start, l.x.char_start))) AS o FROM {GOLD} l JOIN p ON p.question_id = l.question_id AND p.document_id = l.x.document_id GROUP BY ALL),
 hit AS (SELECT question_id, group_id, min(rank) AS rank FROM (SELECT *, sum(o) OVER (PARTITION BY question_id, group_id, location ORDER BY rank ROWS UNBOUNDED PRECEDING) AS got FROM o) WHERE got >= 0.5 * (ce - cs) GROUP BY 1, 2),
 per AS (SELECT question_id, avg(coalesce(1.0 / rank, 0.0)) AS rr FROM (SELECT DISTINCT question_id, group_id FROM {GOLD}) LEFT JOIN hit USING (question_id, group_id) GROUP BY 1)
 SELECT category, round(avg(rr), 4) AS mrr, count(*) AS questions FROM per JOIN (SELECT question_id, category FROM {ASKED}) USING (question_id) GROUP BY 1"""
_PLAIN = "lower(trim(regexp_replace({}, '[\\s\\x{{00A0}}]+', ' ', 'g')))"
_STATED = "len(list_filter(range(1, len(parts)), lambda i: NOT regexp_matches(right(parts[i], 1), '[a-z0-9]') AND NOT regexp_matches(left(parts[i + 1], 1), '[a-z0-9]'))) > 0"
ANSWERS = f"""WITH a AS (SELECT question_id, '"' || coalesce(gold_answer, '') || '"' AS answer, must_cite, required_facts FROM {ASKED}),
 fact AS (SELECT question_id, avg(hit) AS facts FROM (SELECT question_id, n, max(CAST({_STATED} AS INTEGER)) AS hit FROM (SELECT question_id, n, string_split({_PLAIN.format("answer")}, {_PLAIN.format("wording")}) AS parts FROM (SELECT question_id, answer, n, unnest(required_facts[n]) AS wording FROM (SELECT *, unnest(range(1, len(required_facts) + 1)) AS n FROM a))) GROUP BY 1, 2) GROUP BY 1),
 cited AS (SELECT question_id, c.document_id AS document_id, c.key AS key FROM (SELECT question_id, unnest(list_distinct(must_cite)) AS c FROM a)), gold AS (SELECT DISTINCT question_id, group_id, x.document_id AS document_id, x.key AS key FROM {GOLD}),
 named AS (SELECT question_id, avg(CASE WHEN (question_id, document_id, key) IN (SELECT (question_id, document_id, key) FROM gold) THEN 1 ELSE 0 END) AS cp FROM cited GROUP BY 1),
 found AS (SELECT question_id, avg(hit) AS cr FROM (SELECT question_id, group_id, max(CASE WHEN (question_id, document_id, key) IN (SELECT (question_id, document_id, key) FROM cited) THEN 1 ELSE 0 END) AS hit FROM gold GROUP BY 1, 2) GROUP BY 1),
 said AS (SELECT DISTINCT question_id, unnest(list_concat(regexp_extract_all(answer, '"([^"]{{12,}})"', 1), regexp_extract_all(answer, '“([^”]{{12,}})”', 1))) AS quote FROM a),
 held AS (SELECT question_id, count(*) AS quotes, avg(hit) AS grounded FROM (SELECT s.question_id, s.quote, max(CASE WHEN contains(t.text, s.quote) THEN 1 ELSE 0 END) AS hit FROM said s LEFT JOIN (SELECT DISTINCT question_id, document_id FROM cited) c ON c.question_id = s.question_id LEFT JOIN {PAGES} t ON t.document_id = c.document_id GROUP BY 1, 2) GROUP BY 1)
 SELECT question_id, round(facts, 4) AS facts, round(cp, 4) AS citation_precision, round(cr, 4) AS citation_recall, round(grounded, 4) AS grounded, coalesce(quotes, 0) AS quotes FROM a LEFT JOIN fact USING (question_id) LEFT JOIN named USING (question_id) LEFT JOIN found USING (question_id) LEFT JOIN held USING (question_id)"""

WINDOWS = "(SELECT doc_id, text, CAST(s AS INTEGER) AS start, CAST(least(s + 1200, length(text)) AS INTEGER) AS \"end\", substring(text, CAST(s AS BIGINT) + 1, 1200) AS body FROM (SELECT doc_id, text, unnest(range(0, CAST(greatest(0, ceil((length(text) - 1200) / 900.0)) AS BIGINT) * 900 + 1, 900)) AS s FROM documents WHERE length(text) > 0))"
TERMS = f"(SELECT DISTINCT item_id, unnest(list_slice(list_filter(w, lambda x, i: list_position(w, x) = i), 1, 24)) AS term FROM (SELECT item_id, {_content('text')} AS w FROM eval_items))"


def _bm25(units: str, text: str, key: str, top: int, within: str = "") -> str:
    index = f"(SELECT {key}, dl, term, count(*) AS tf FROM (SELECT {key}, len(w) AS dl, unnest(w) AS term FROM (SELECT {key}, {_content(text)} AS w FROM {units})) GROUP BY ALL)"
    return f"""(WITH idx AS MATERIALIZED (SELECT * FROM {index}), st AS (SELECT avg(dl) AS mean FROM (SELECT DISTINCT {key}, dl FROM idx)), df AS (SELECT term, ln(1 + ((SELECT count(*) FROM {units}) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM idx GROUP BY 1)
 SELECT item_id, {key}, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, {key}) AS rank FROM (
 SELECT item_id, {key}, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean))), 6) AS score FROM {TERMS} JOIN idx USING (term) JOIN df USING (term), st {within} GROUP BY ALL)) WHERE rank <= {top})"""


DOC_BM25 = _bm25("documents", "text", "doc_id", 10)
W_KEY = 'doc_id, start, "end"'
_FILL = 'SELECT item_id, rank, doc_id, start, "end" FROM (SELECT *, coalesce(sum("end" - start) OVER (PARTITION BY item_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM {}) WHERE before < 2000'
_FIRST = _bm25("documents", "text", "doc_id", 5)

SPLIT_Q = f"(SELECT question_id, category, coalesce(jurisdiction_hint, '') AS place FROM {ASKED})"
PROBES = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_type ORDER BY turn, place) AS place_no FROM (SELECT *, row_number() OVER (PARTITION BY document_type, place ORDER BY sha256(document_id), document_id) AS turn FROM (SELECT *, coalesce(jurisdiction, '') AS place FROM corpus_documents))) WHERE place_no <= 40)"
_SEATS = "(SELECT category, CAST(whole AS BIGINT) + CASE WHEN row_number() OVER (ORDER BY round(exact - whole, 9) DESC, category) <= {0} - sum(whole) OVER () THEN 1 ELSE 0 END AS seats FROM (SELECT category, share * {0} / sum(share) OVER () AS exact, floor(share * {0} / sum(share) OVER ()) AS whole FROM (SELECT category, CAST(count(*) AS DOUBLE) AS share FROM corpus_documents GROUP BY 1)))"
STRATA = f"(SELECT document_type, population, coalesce(m, 0) AS sampled, round(population * mean, 4) AS estimate, round(CASE WHEN m > 1 THEN population * sqrt(greatest(0.0, 1 - CAST(m AS DOUBLE) / population) * v / m) ELSE 0.0 END, 4) AS standard_error FROM (SELECT document_type, count(*) AS population FROM corpus_documents GROUP BY 1) LEFT JOIN (SELECT document_type, count(bytes) AS m, avg(CAST(bytes AS DOUBLE)) AS mean, coalesce(var_samp(CAST(bytes AS DOUBLE)), 0.0) AS v FROM {PROBES} GROUP BY 1) USING (document_type))"
VERDICTS = "(SELECT document_id, lower(nullif(trim(classification), '')) AS verdict, assessed_at FROM quality_assessments)"
LABELS = f"(SELECT document_id, first(verdict ORDER BY assessed_at DESC NULLS LAST, verdict DESC NULLS LAST) AS last, first(verdict ORDER BY assessed_at NULLS FIRST, verdict NULLS FIRST) AS first FROM {VERDICTS} GROUP BY 1)"
LATEST_INVENTORY = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY discovered_at DESC NULLS LAST, year DESC NULLS LAST) AS _n FROM inventory) WHERE _n = 1)"

ORACLES: dict[str, str] = {
    "respaced_documents": "SELECT doc_id, CAST(0 AS INTEGER) AS changed, sha256(text) AS hash FROM documents WHERE text IS NOT NULL",
    "item_metadata": "SELECT document_id, 'dc.title' AS name, title AS values FROM corpus_documents WHERE title IS NOT NULL UNION ALL SELECT document_id, 'dc.jurisdiction', jurisdiction FROM corpus_documents WHERE jurisdiction IS NOT NULL UNION ALL "
    + " UNION ALL ".join(f"SELECT document_id, '{c}', trim(regexp_replace(CAST({c} AS VARCHAR), '\\s+', ' ', 'g')) FROM corpus_documents WHERE trim(CAST({c} AS VARCHAR)) <> ''" for c in ("year", "handle")),
    "item_files": "SELECT document_id, CASE WHEN said = 'en' THEN primary_pdf_url END AS url, CASE WHEN said = 'hi' THEN 'only Hindi' WHEN said <> 'en' THEN 'undetermined' END AS refusal FROM (SELECT document_id, primary_pdf_url, CASE WHEN regexp_matches(lower(concat_ws(' ', language, primary_pdf_url)), '(हिन्दी|हिंदी|\\bhindi\\b|[_-]h(in)?\\.pdf$)') OR regexp_matches(coalesce(language, ''), '[ऀ-ॿ]') THEN 'hi' WHEN regexp_matches(lower(concat_ws(' ', language, primary_pdf_url)), '(\\benglish\\b|\\beng\\b|[_-]e(ng)?\\.pdf$)') THEN 'en' ELSE 'undetermined' END AS said FROM corpus_documents WHERE regexp_matches(lower(primary_pdf_url), '(/bitstream/|\\.pdf($|\\?)|viewfile)'))",
    "sound_pages": f"WITH v AS (SELECT document_id, page_number, CASE WHEN word_count < 60 THEN 'unjudged' WHEN mean_word_length < 4.2 OR single_char_rate > 0.12 OR mixed_case_rate > 0.01 THEN 'suspect' ELSE 'good' END AS verdict FROM {SIGNALS} {PAGES})), c AS (SELECT document_id, count(*) FILTER (WHERE verdict = 'good') AS good, count(*) FILTER (WHERE verdict = 'suspect') AS suspect FROM v GROUP BY 1) SELECT document_id, page_number FROM v JOIN c USING (document_id) WHERE verdict = 'good' OR (verdict = 'unjudged' AND good > suspect)",
    "document_titles": f"""WITH h AS (SELECT document_id, line_no, {_BARE} AS bare, regexp_replace(lower(trim(regexp_replace(text, '[\\s\\x{{00A0}}]+', ' ', 'g'))), '[0-9]+', '#', 'g') AS line FROM {STREAM} s WHERE line_no < 40 AND NOT EXISTS (SELECT 1 FROM {_contents(STREAM)} c WHERE c.document_id = s.document_id AND c.page_number = s.page_number)),
 m AS (SELECT document_id, nullif(trim(title), '') AS said, regexp_replace(regexp_replace(lower(trim(regexp_replace(title, '\\s+', ' ', 'g'))), '[0-9]+', '#', 'g'), '^the ', '') AS key FROM corpus_documents)
 SELECT document_id, coalesce(said, top) AS title, CASE WHEN said IS NOT NULL AND hit THEN 'metadata_confirmed_on_page' WHEN said IS NOT NULL THEN 'metadata' WHEN top IS NOT NULL THEN 'first_page_heading' END AS title_source FROM (
 SELECT m.document_id, max(said) AS said, bool_or(coalesce(contains(line, key), false)) AS hit, arg_min(bare, line_no) FILTER (WHERE length(bare) BETWEEN 10 AND 200 AND len(regexp_extract_all(bare, '\\p{{Lu}}')) > 0.8 * len(regexp_extract_all(bare, '\\p{{L}}'))) AS top FROM m LEFT JOIN h ON h.document_id = m.document_id GROUP BY 1)""",
    "anchors": f"SELECT document_id, line_no, unit_type, number, detected_by FROM {ANCHORS}",
    "provision_style": f"SELECT *, CASE WHEN dashed >= 3 THEN 'dash' WHEN plain >= 3 THEN 'line' WHEN dashed > 0 THEN 'dash' ELSE 'line' END AS style FROM (SELECT document_id, CAST(0 AS BIGINT) AS articles, count(*) FILTER (WHERE detected_by = 'numbered_heading_dash') AS dashed, count(*) FILTER (WHERE detected_by = 'numbered_heading_line') AS plain FROM {ANCHORS} GROUP BY 1)",
    "ascending_numbers": f"SELECT document_id, pairs, CASE WHEN pairs >= 4 THEN round(CAST(up AS DOUBLE) / pairs, 4) END AS share FROM (SELECT document_id, count(before) AS pairs, count(*) FILTER (WHERE n >= before) AS up FROM (SELECT *, lag(n) OVER (PARTITION BY document_id ORDER BY line_no) AS before FROM (SELECT *, CAST(regexp_extract(number, '^[0-9]+') AS INTEGER) AS n FROM {ANCHORS})) GROUP BY 1)",
    "number_ambiguity": f"SELECT unit_type, number, count(DISTINCT document_id) AS documents FROM {ANCHORS} GROUP BY 1, 2",
    "cross_references": f"SELECT DISTINCT s.document_id, s.number, s.line_no, h.target FROM (SELECT document_id, line_no, unnest(regexp_extract_all(text, '\\b[Ss]ections?\\s+([0-9]{{1,4}}[A-Z]{{0,3}})\\b', 1)) AS number FROM {STREAM}) s JOIN (SELECT document_id, number, min(line_no) AS target FROM {ANCHORS} GROUP BY 1, 2 HAVING count(*) = 1) h USING (document_id, number) WHERE s.line_no <> h.target",
    "preambles": f"SELECT s.document_id, min(s.line_no) AS line_no, greatest(min(s.line_no), coalesce(min(f.first) - 1, min(l.last))) AS line_end FROM {STREAM} s LEFT JOIN (SELECT document_id, min(line_no) AS first FROM {ANCHORS} GROUP BY 1) f ON f.document_id = s.document_id JOIN (SELECT document_id, max(line_no) AS last FROM {STREAM} GROUP BY 1) l ON l.document_id = s.document_id WHERE {FORMULA} AND s.line_no < coalesce(f.first, 2147483647) AND NOT EXISTS (SELECT 1 FROM {_contents(STREAM)} c WHERE c.document_id = s.document_id AND c.page_number = s.page_number) GROUP BY 1",
    "budget_pieces": f"SELECT question_id, CAST(budget AS BIGINT) AS budget, rank, document_id, start, \"end\" FROM {PIECES}",
    "question_scores": f"SELECT question_id, category, CAST(budget AS BIGINT) AS budget, round(recall, 4) AS recall, round(document_recall, 4) AS document_recall, round(precision, 4) AS precision, used FROM {SPANS_SCORED}",
    "score_report": f"SELECT category, CAST(budget AS BIGINT) AS budget, count(*) AS questions, round(avg(recall), 4) AS recall, round(avg(all_required), 4) AS all_required, round(avg(document_recall), 4) AS document_recall, round(avg(precision), 4) AS precision, round(avg(used), 4) AS used, count(*) FILTER (WHERE used = 0) AS empty FROM {SPANS_SCORED} GROUP BY 1, 2",
    "mean_reciprocal_rank": RECIPROCAL,
    "gold_answer_scores": ANSWERS,
    "corpus_identity": f"SELECT c.document_id, c.category, c.title, coalesce(c.year, i.year) AS year, coalesce(c.enactment_date, i.enactment_date) AS enactment_date, i.year IS NOT NULL AS listed FROM corpus_documents c LEFT JOIN {LATEST_INVENTORY} i USING (document_id)",
    "documents_without_lines": "SELECT document_id, category FROM corpus_documents WHERE document_id NOT IN (SELECT document_id FROM page_lines WHERE document_id IS NOT NULL)",
    "listings_merged": "SELECT dedup_key, arg_min(document_id, (discovered_at, document_id)) AS document_id, "
    + ", ".join(f"arg_min({c}, (discovered_at, document_id)) FILTER (WHERE nullif({c}, '') IS NOT NULL) AS {c}" for c in ("title", "ministry", "department", "act_number"))
    + ", len(list_distinct(flatten(list(sources)))) AS source_count, count(*) AS listings FROM (SELECT *, replace(trim(english_pdf_url), ' ', '%20') AS dedup_key FROM inventory WHERE trim(english_pdf_url) <> '') GROUP BY 1",
    "address_parts": "SELECT document_id, lower(regexp_extract(source_url, '^[a-zA-Z]+://([^/:?#]+)', 1)) AS host, CASE WHEN contains(p, '/bitstream') THEN 'bitstream' WHEN contains(p, '/handle/') THEN 'handle' WHEN contains(p, 'viewfile') THEN 'viewfile' WHEN p IS NULL THEN 'other' ELSE 'other' END AS kind, regexp_extract(p, '/handle/([0-9.]+/[0-9]+)', 1) AS handle, list_last(string_split(p, '/')) AS file_name, CASE WHEN contains(q, '/bitstream') THEN 'bitstream' WHEN contains(q, '/handle/') THEN 'handle' WHEN contains(q, 'viewfile') THEN 'viewfile' ELSE 'other' END AS file_kind, list_last(string_split(q, '/')) AS pdf_name FROM (SELECT *, regexp_extract(source_url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1) AS p, regexp_extract(primary_pdf_url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1) AS q FROM corpus_documents)",
    "gold_keys": f"SELECT question_id, group_id, location, x.document_id AS document_id, array_to_string(list_transform(x.unit_path, lambda p: p.unit_type || ':' || coalesce(p.number, '_')), '/') AS path_key, x.char_end - x.char_start AS length FROM {GOLD}",
    "title_slugs": "SELECT document_id, trim(left(trim(regexp_replace(lower(strip_accents(coalesce(title, ''))), '[^a-z0-9]+', '-', 'g'), '-'), 60), '-') AS slug FROM corpus_documents",
    "bands": "SELECT CASE WHEN year IS NULL THEN 'year_unknown' WHEN year <= 1899 THEN 'pre_1900' WHEN year <= 1949 THEN '1900_1949' WHEN year <= 1990 THEN '1950_1990' WHEN year <= 2010 THEN '1991_2010' ELSE '2011_plus' END AS era, CASE WHEN bytes IS NULL THEN NULL WHEN bytes < 102400 THEN 'tiny' WHEN bytes < 512000 THEN 'small' WHEN bytes < 2097152 THEN 'medium' WHEN bytes < 8388608 THEN 'large' ELSE 'huge' END AS size, count(*) AS n FROM corpus_documents GROUP BY 1, 2",
    "readable_sizes": "SELECT document_id, list_filter(list_transform(regexp_extract_all(enactment_date, '[0-9]{4}'), lambda y: CAST(y AS INTEGER)), lambda y: y BETWEEN 1500 AND 2200)[1] AS enacted, bytes >= 1048576 AS large, regexp_matches(lower(source_url), '^[a-z]+://([^/]*\\.)?laws\\.example(/|$)') AS own_host FROM corpus_documents",
    "line_stream": f"SELECT document_id, stream_index, CAST(row_number() OVER (PARTITION BY document_id ORDER BY stream_index) - 1 AS INTEGER) AS line_no FROM {LINES} l WHERE NOT EXISTS (SELECT 1 FROM furniture_lines f WHERE f.document_id = l.document_id AND f.page_number = l.page_number AND f.line_index = l.page_line_index) AND trim(regexp_replace(text, '[\\s\\x{{00A0}}]+', '', 'g')) <> ''",
    "line_offsets": f"SELECT document_id, stream_index, char_start, char_end FROM {OFFSETS}",
    "page_map": f"SELECT * FROM {MAP}",
    "map_faults": f"SELECT document_id, page_number, char_start, char_end FROM (SELECT *, coalesce(lag(char_end) OVER (PARTITION BY document_id ORDER BY char_start, page_number), 0) AS before FROM {MAP}) WHERE char_start <> before",
    "zone_lines": f"SELECT document_id, stream_index, unnest(list_filter([CASE WHEN t <= 3 THEN 'header' END, CASE WHEN b <= 3 THEN 'footer' END], lambda z: z IS NOT NULL)) AS zone FROM (SELECT *, row_number() OVER (PARTITION BY document_id, page_number ORDER BY stream_index) AS t, row_number() OVER (PARTITION BY document_id, page_number ORDER BY stream_index DESC) AS b FROM {LINES} WHERE trim(text) <> '')",
    "page_number_lines": f"SELECT document_id, stream_index, trim(text) AS text FROM {LINES} WHERE trim(text) <> '' AND regexp_matches(text, '(?i)^\\s*(page\\s*)?([0-9]{{1,4}}|[ivxlcdm]{{1,7}})(\\s*(of|/)\\s*[0-9]{{1,4}})?\\s*[.\\-–—]?\\s*$')",
    "text_windows": f'SELECT doc_id, start, "end", length(body) AS length FROM {WINDOWS}',
    "gold_unions": f"SELECT document_id, min(start) AS start, max(\"end\") AS \"end\" FROM (SELECT *, sum(opens) OVER (PARTITION BY document_id ORDER BY start, \"end\" ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN start <= max(\"end\") OVER (PARTITION BY document_id ORDER BY start, \"end\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM (SELECT x.document_id AS document_id, x.char_start AS start, x.char_end AS \"end\" FROM {GOLD}))) GROUP BY document_id, island",
    "line_fingerprints": f"SELECT doc_id, fingerprint FROM {PRINTS}",
    "shared_line_pairs": f"SELECT a, b, shared FROM {PAIRS}",
    "near_dup_edges": f"SELECT a, b, shared, jaccard, containment, {RELATION} AS relation FROM {EDGES}",
    "exact_text_links": f"SELECT first, doc_id FROM {COPIES}",
    "dup_clusters": f"SELECT node AS doc_id, cluster FROM {CLUSTERS}",
    "cluster_names": f"SELECT node AS doc_id, 'dup-' || lpad(CAST(dense_rank() OVER (ORDER BY cluster) AS VARCHAR), 5, '0') AS cluster_id FROM {CLUSTERS}",
    "cluster_representatives": f"SELECT cluster, node AS doc_id, n_chars FROM (SELECT c.cluster, c.node, d.n_chars, row_number() OVER (PARTITION BY c.cluster ORDER BY d.n_chars DESC, c.node) AS r FROM {CLUSTERS} c JOIN documents d ON d.doc_id = c.node) WHERE r = 1",
    "shared_passages": f"SELECT class_hash, count(DISTINCT doc_id) AS documents, count(*) AS spans, min(doc_id) AS first FROM (SELECT doc_id, sha256(trim(regexp_replace(line, '[\\s\\x{{00A0}}]+', ' ', 'g'))) AS class_hash FROM (SELECT doc_id, unnest(string_split({_NFKC}, chr(10))) AS line FROM documents) WHERE length(line) >= 40) GROUP BY 1 HAVING count(DISTINCT doc_id) > 1",
    "title_pairs": f"WITH t AS (SELECT document_id, {TITLES} AS w FROM corpus_documents WHERE title IS NOT NULL) SELECT a, b, likeness FROM (SELECT x.document_id AS a, y.document_id AS b, round(CAST(len(list_intersect(x.w, y.w)) AS DOUBLE) / len(list_distinct(list_concat(x.w, y.w))), 4) AS likeness FROM t x JOIN t y ON x.document_id < y.document_id WHERE len(x.w) > 0 AND len(y.w) > 0) WHERE likeness >= 0.5",
    "text_signals": f"SELECT doc_id, characters, word_count, token_count, mean_word_length, single_char_rate, mixed_case_rate, alnum_mix_rate, common_word_rate, vowelless_ratio, replacement_char_count FROM {SIGNALS} documents)",
    "quality_panel": PANEL,
    "page_verdicts": f"SELECT document_id, page_number, word_count, CASE WHEN word_count < 60 THEN 'unjudged' WHEN mean_word_length < 4.2 OR single_char_rate > 0.12 OR mixed_case_rate > 0.01 THEN 'suspect' ELSE 'good' END AS verdict FROM {SIGNALS} {PAGES})",
    "worst_pages": f"SELECT document_id, page_number, CAST(rank AS INTEGER) AS rank FROM (SELECT document_id, page_number, row_number() OVER (PARTITION BY document_id ORDER BY mean_word_length, page_number) AS rank FROM {SIGNALS} {PAGES}) WHERE word_count >= 60) WHERE rank <= 5",
    "mangled_pages": f"SELECT document_id, page_number FROM {SIGNALS} {PAGES}) WHERE {MANGLED}",
    "language_verdicts": LANGUAGE,
    "script_profile": "SELECT doc_id, " + ", ".join(f"len(regexp_extract_all(l, '\\p{{{n.title()}}}')) AS {n}" for n in ("devanagari", "bengali", "tamil", "greek", "cyrillic")) + " FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[^\\p{L}]+', '', 'g') AS l FROM documents)",
    "line_languages": f"SELECT document_id, verdict, count(*) AS n FROM (SELECT document_id, {LINE_LANGUAGE} AS verdict FROM {LINES}) GROUP BY 1, 2",
    "page_language_profile": f"WITH p AS (SELECT document_id, page_number, CASE WHEN l < 200 THEN 'unknown' WHEN l - lat >= 0.25 * l THEN 'non_en' WHEN m THEN 'non_en' ELSE 'en' END AS v FROM (SELECT document_id, page_number, {_LETTERS} AS l, {_LATIN} AS lat, {MANGLED} AS m FROM {SIGNALS} {PAGES}))) SELECT document_id, count(*) AS pages, count(*) FILTER (WHERE v <> 'unknown') AS measurable, count(*) FILTER (WHERE v = 'non_en') AS non_en_pages, {_share("count(*) FILTER (WHERE v = 'non_en')", "count(*) FILTER (WHERE v <> 'unknown')")} AS non_en_ratio, coalesce(array_to_string(list_slice(list_sort(list(page_number) FILTER (WHERE v = 'non_en')), 1, 50), ','), '') AS numbers, {_share("count(*) FILTER (WHERE v = 'non_en')", "count(*) FILTER (WHERE v <> 'unknown')")} >= 0.15 AS mixed FROM p GROUP BY 1",
    "word_validity": "WITH e AS (SELECT doc_id, lower(w) AS word FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z]{4,}')) AS w FROM documents)), v AS (SELECT word FROM e GROUP BY 1 HAVING count(DISTINCT doc_id) >= 20) SELECT doc_id, count(*) AS words, count(v.word) AS valid, round(CAST(count(v.word) AS DOUBLE) / count(*), 4) AS rate, count(*) >= 200 AS measurable FROM e LEFT JOIN v USING (word) GROUP BY 1",
    "glued_tokens": f"SELECT doc_id, {_share('len(list_filter(' + _words('text') + ', lambda w: length(w) >= 12))', 'len(' + _words('text') + ')')} AS glued, len(regexp_extract_all(text, '\"([^\"]{{12,}})\"')) + len(regexp_extract_all(text, '“([^”]{{12,}})”')) AS quotes FROM documents",
    "page_measures": f"SELECT doc_id, {_count('text', '(?m)^\\s*[0-9]{1,4}[A-Z]{0,3}\\.\\s')} AS sections, {_count('text', '\\([0-9]{1,3}[A-Z]?\\)')} AS subsections, {_count('text', '\\([a-z]{1,2}\\)')} AS clauses, length(text) AS characters, len(string_split(text, chr(10))) AS lines FROM documents",
    "contents_pages": f"SELECT * FROM {CONTENTS}",
    "content_word_counts": f"SELECT doc_id, len({_content('text')}) AS words, len(list_distinct({_content('text')})) AS different FROM documents",
    "document_frequencies": f"SELECT term, count(DISTINCT doc_id) AS df, count(*) AS tf FROM (SELECT doc_id, unnest({_content('text')}) AS term FROM documents) GROUP BY 1",
    "bm25_documents": f"SELECT item_id, doc_id, rank FROM {DOC_BM25}",
    "bm25_windows": _FILL.format(_bm25(WINDOWS, "body", W_KEY, 12)),
    "bm25_two_stage": _FILL.format(_bm25(WINDOWS, "body", W_KEY, 12, f"WHERE (item_id, doc_id) IN (SELECT (item_id, doc_id) FROM {_FIRST})")),
    "wording_leakage": f"SELECT item_id, CASE WHEN len(list_distinct(q)) = 0 THEN 0.0 ELSE round(CAST(len(list_intersect(list_distinct(q), e)) AS DOUBLE) / len(list_distinct(q)), 4) END AS leakage FROM (SELECT item_id, {_content('question')} AS q, {_content('text')} AS e FROM eval_items)",
    "oracle_spans": f"SELECT question_id, CAST(row_number() OVER (PARTITION BY question_id ORDER BY CAST(location > 0 AS INTEGER), CAST(requirement <> 'required' AS INTEGER), g, location) AS INTEGER) AS rank, x.document_id AS document_id, greatest(0, x.char_start) AS start, x.char_end AS \"end\" FROM {GOLD}",
    "span_coverage": f"""WITH s AS (SELECT question_id, x.document_id AS document_id, greatest(0, x.char_start + 50) AS start, x.char_end - 50 AS "end" FROM {GOLD}), h AS (SELECT l.question_id, l.group_id, l.location, l.x.char_end - l.x.char_start AS n, CAST(sum(greatest(0, least(s."end", l.x.char_end) - greatest(s.start, l.x.char_start))) AS BIGINT) AS covered FROM {GOLD} l JOIN s ON s.question_id = l.question_id AND s.document_id = l.x.document_id GROUP BY ALL)
 SELECT question_id, group_id, location, covered, CASE WHEN n > 0 THEN round(CAST(covered AS DOUBLE) / n, 4) ELSE 0.0 END AS coverage FROM h""",
    "hash_sample": "SELECT document_id, category, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY sha256(document_id), document_id) AS rank FROM corpus_documents) WHERE rank <= 25",
    "seats_by_category": f"SELECT * FROM {_SEATS.format(100)}",
    "dev_test_split": f"WITH q AS (SELECT *, row_number() OVER (PARTITION BY category, place ORDER BY sha256(question_id), question_id) AS r FROM {SPLIT_Q}), s AS (SELECT category, place, floor(u * 0.3 + 1e-9) - floor((u - n) * 0.3 + 1e-9) AS seats FROM (SELECT category, place, n, sum(n) OVER (ORDER BY category NULLS FIRST, place ROWS UNBOUNDED PRECEDING) AS u FROM (SELECT category, place, count(*) AS n FROM {SPLIT_Q} GROUP BY 1, 2))) SELECT question_id, CASE WHEN r <= seats THEN 'dev' ELSE 'test' END AS split FROM q JOIN s ON q.category IS NOT DISTINCT FROM s.category AND q.place = s.place",
    "round_robin_sample": f"SELECT document_id, document_type, place FROM {PROBES}",
    "drawn_sample": f"SELECT document_id, category FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY turn, sha256(place), place) AS p FROM (SELECT *, row_number() OVER (PARTITION BY category, place ORDER BY sha256(document_id), document_id) AS turn FROM (SELECT *, coalesce(jurisdiction, '') AS place FROM corpus_documents))) JOIN {_SEATS.format(80)} USING (category) WHERE p <= seats",
    "size_description": "SELECT document_type, count(bytes) AS n, round(CAST(sum(bytes) AS DOUBLE), 4) AS total, round(avg(bytes), 4) AS mean, round(quantile_cont(bytes, 0.5), 4) AS median, round(quantile_cont(bytes, 0.9), 4) AS p90, round(quantile_cont(bytes, 0.95), 4) AS p95, round(quantile_cont(bytes, 0.99), 4) AS p99, CAST(min(bytes) AS DOUBLE) AS least, CAST(max(bytes) AS DOUBLE) AS greatest, round(coalesce(stddev_samp(bytes), 0.0), 4) AS deviation FROM corpus_documents GROUP BY 1",
    "stratified_size": f"SELECT * FROM {STRATA}",
    "total_size": f"SELECT round(sum(estimate), 2) AS total, round(sum(estimate) - 1.96 * sqrt(sum(standard_error * standard_error)), 2) AS low, round(sum(estimate) + 1.96 * sqrt(sum(standard_error * standard_error)), 2) AS high, count(*) FILTER (WHERE estimate IS NULL) AS uncovered FROM {STRATA}",
    "size_by_place": f"SELECT document_type, place, population, round(population * CASE WHEN m >= 5 THEN mean ELSE wide END, 4) AS estimate, coalesce(m >= 5, false) AS measured FROM (SELECT document_type, coalesce(jurisdiction, '') AS place, count(*) AS population FROM corpus_documents GROUP BY 1, 2) LEFT JOIN (SELECT document_type, place, count(bytes) AS m, avg(CAST(bytes AS DOUBLE)) AS mean FROM {PROBES} GROUP BY 1, 2) USING (document_type, place) LEFT JOIN (SELECT document_type, avg(CAST(bytes AS DOUBLE)) AS wide FROM {PROBES} GROUP BY 1) USING (document_type)",
    "corpus_counts": " UNION ALL ".join(f"SELECT '{c}' AS dimension, coalesce({c}, 'none') AS value, count(*) AS n FROM corpus_documents GROUP BY 2" for c in ("category", "document_type", "jurisdiction", "language_source")),
    "label_count_difference": "SELECT document_type, coalesce(a.n, 0) AS before, coalesce(b.n, 0) AS after, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM (SELECT coalesce(document_type, 'none') AS document_type, count(*) AS n FROM inventory GROUP BY 1) a FULL JOIN (SELECT coalesce(document_type, 'none') AS document_type, count(*) AS n FROM corpus_documents GROUP BY 1) b USING (document_type)",
    "failed_check_coverage": "SELECT c AS check, coalesce(n, 0) AS n FROM (SELECT unnest(['alnum_mix_rate', 'alpha_ratio', 'common_word_rate', 'mean_word_length', 'mixed_case_rate', 'single_char_rate', 'symbol_ratio', 'vowelless_ratio']) AS c) LEFT JOIN (SELECT f, count(*) AS n FROM (SELECT unnest(list_distinct(failed_checks)) AS f FROM quality_assessments) GROUP BY 1) ON f = c",
    "extreme_documents": "SELECT 'largest' AS slot, (SELECT document_id FROM corpus_documents WHERE bytes IS NOT NULL ORDER BY bytes DESC, document_id DESC LIMIT 1) AS document_id, (SELECT CAST(max(bytes) AS DOUBLE) FROM corpus_documents) AS value UNION ALL SELECT 'newest', (SELECT document_id FROM corpus_documents WHERE year IS NOT NULL ORDER BY year DESC, document_id DESC LIMIT 1), (SELECT CAST(max(year) AS DOUBLE) FROM corpus_documents)",
    "latest_assessments": "SELECT document_id, assessed_at, classification, score FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY assessed_at DESC NULLS LAST, score DESC NULLS LAST, classification DESC NULLS LAST) AS n FROM quality_assessments WHERE document_id IS NOT NULL) WHERE n = 1",
    "latest_events": "SELECT user_id, ts, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS n FROM events WHERE user_id IS NOT NULL) WHERE n = 1",
    "attempt_counts": "SELECT document_id, count(*) AS attempts, count(*) FILTER (WHERE classification = 'bad') AS failures FROM quality_assessments WHERE document_id IS NOT NULL GROUP BY 1",
    "listing_versions": "WITH r AS (SELECT document_id, discovered_at AS valid_from, coalesce(title, '') || '|' || coalesce(language, '') AS content FROM inventory WHERE document_id IS NOT NULL AND discovered_at IS NOT NULL), o AS (SELECT * FROM (SELECT *, lag(content) OVER w AS before, row_number() OVER w AS n FROM r WINDOW w AS (PARTITION BY document_id ORDER BY valid_from, content)) WHERE n = 1 OR content IS DISTINCT FROM before) SELECT document_id, CAST(row_number() OVER w AS INTEGER) AS version, content, valid_from, lead(valid_from) OVER w AS valid_to FROM o WINDOW w AS (PARTITION BY document_id ORDER BY valid_from, content)",
    "work_plan": "SELECT document_id, reason FROM (SELECT c.document_id, CASE WHEN a.assessed_at IS NULL THEN 'never assessed' WHEN nullif(trim(a.classification), '') IS NULL THEN 'no verdict' WHEN a.assessed_at < c.downloaded_at THEN 'outdated' WHEN a.signals.word_count IS NULL THEN 'no signals' END AS reason FROM corpus_documents c LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY assessed_at DESC NULLS LAST, score DESC NULLS LAST, classification DESC NULLS LAST, signals.word_count DESC NULLS LAST) AS n FROM quality_assessments) WHERE n = 1) a USING (document_id)) WHERE reason IS NOT NULL",
    "order_changes": "SELECT o_orderkey, CASE WHEN before IS NULL THEN 'new' WHEN before = o_orderstatus THEN 'unchanged' ELSE 'updated' END AS change FROM (SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders)",
    "location_problems": f"SELECT question_id, group_id, location, unnest(list_filter([CASE WHEN k.document_id IS NULL THEN 'unknown document' END, CASE WHEN x.char_end <= x.char_start THEN 'no length' END, CASE WHEN x.char_start < 0 THEN 'negative start' END, CASE WHEN x.page_end < x.page_start THEN 'pages backward' END, CASE WHEN coalesce(x.key, '') = '' THEN 'no key' END, CASE WHEN x.key <> array_to_string(list_transform(x.unit_path, lambda p: p.unit_type || ':' || coalesce(p.number, '_')), '/') THEN 'key and path differ' END, CASE WHEN NOT regexp_full_match(coalesce(x.text_sha256, ''), '[0-9a-f]{{64}}') THEN 'no text hash' END], lambda p: p IS NOT NULL)) AS problem FROM {GOLD} l LEFT JOIN (SELECT DISTINCT document_id FROM corpus_documents) k ON k.document_id = l.x.document_id",
    "verdict_confusion": f"SELECT coalesce(f, '*') AS first, coalesce(l, '*') AS last, count(*) AS n FROM (SELECT coalesce(first, 'none') AS f, coalesce(last, 'none') AS l FROM {LABELS}) GROUP BY CUBE (f, l)",
    "acceptance_safety": f"""SELECT category, count(*) FILTER (WHERE first = 'bad') AS rejected, count(*) FILTER (WHERE first = 'good') AS accepted, count(*) FILTER (WHERE first = 'bad' AND last = 'good') AS false_acceptances,
 CASE WHEN count(*) FILTER (WHERE first = 'bad') > 0 THEN round(CAST(count(*) FILTER (WHERE first = 'bad' AND last = 'good') AS DOUBLE) / count(*) FILTER (WHERE first = 'bad'), 4) END AS false_acceptance_rate,
 count(*) FILTER (WHERE first = 'good' AND last IS DISTINCT FROM 'good') AS false_quarantines, CASE WHEN count(*) FILTER (WHERE first = 'good') > 0 THEN round(CAST(count(*) FILTER (WHERE first = 'good' AND last IS DISTINCT FROM 'good') AS DOUBLE) / count(*) FILTER (WHERE first = 'good'), 4) END AS false_quarantine_rate
 FROM {LABELS} JOIN corpus_documents USING (document_id) GROUP BY 1""",
    "changed_labels": "WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY discovered_at DESC NULLS LAST, title DESC NULLS LAST, language DESC NULLS LAST, jurisdiction DESC NULLS LAST, year DESC NULLS LAST) AS _n FROM inventory) WHERE _n = 1) "
    + " UNION ALL ".join(f"SELECT document_id, '{c}' AS field, CAST(c.{c} AS VARCHAR) AS before, CAST(l.{c} AS VARCHAR) AS after FROM corpus_documents c JOIN l USING (document_id) WHERE c.{c} IS DISTINCT FROM l.{c}" for c in ("title", "language", "jurisdiction", "year")),
    "question_problems": f"""SELECT question_id, unnest(list_filter([CASE WHEN trim(coalesce(question, '')) = '' THEN 'no question' END, CASE WHEN unanswerable AND coalesce(len(gold_evidence), 0) > 0 THEN 'unanswerable with evidence' END, CASE WHEN NOT unanswerable AND coalesce(len(gold_evidence), 0) = 0 THEN 'answerable without evidence' END,
 CASE WHEN NOT unanswerable AND len(list_filter(must_cite, lambda c: NOT list_contains(list_transform(flatten(list_transform(gold_evidence, lambda g: g.locations)), lambda x: x.document_id || '|' || x.key), c.document_id || '|' || c.key))) > 0 THEN 'citation outside the evidence' END,
 CASE WHEN len(list_filter(flatten(required_facts), lambda v: regexp_full_match(trim(v), '[0-9]+'))) > 0 THEN 'fact is a number only' END], lambda p: p IS NOT NULL)) AS problem FROM {ASKED} UNION ALL SELECT question_id, 'repeated id' FROM questions GROUP BY 1 HAVING count(*) > 1""",
    "recurring_furniture": f"""WITH live AS (SELECT *, row_number() OVER (PARTITION BY document_id, page_number ORDER BY stream_index) AS t, row_number() OVER (PARTITION BY document_id, page_number ORDER BY stream_index DESC) AS b FROM {LINES} WHERE trim(text) <> ''),
 z AS (SELECT document_id, page_number, stream_index, zone, lower(trim(regexp_replace(text, '[\\s\\x{{00A0}}]+', ' ', 'g'))) AS literal, CASE WHEN regexp_matches(text, '(?i)^\\s*(page\\s*)?([0-9]{{1,4}}|[ivxlcdm]{{1,7}})(\\s*(of|/)\\s*[0-9]{{1,4}})?\\s*[.\\-–—]?\\s*$') THEN regexp_replace(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), '[0-9]+', '#', 'g') END AS number
 FROM (SELECT *, 'header' AS zone FROM live WHERE t <= 3 UNION ALL SELECT *, 'footer' FROM live WHERE b <= 3) WHERE length(trim(text)) <= 120),
 need AS (SELECT document_id, greatest(3, round(count(DISTINCT page_number) * 0.6)) AS least FROM {LINES} GROUP BY 1),
 l AS (SELECT document_id, zone, literal FROM z JOIN need USING (document_id) GROUP BY document_id, zone, literal, least HAVING count(DISTINCT page_number) >= least),
 n AS (SELECT document_id, zone, number FROM z JOIN need USING (document_id) WHERE number IS NOT NULL GROUP BY document_id, zone, number, least HAVING count(DISTINCT page_number) >= least)
 SELECT document_id, page_number, stream_index, arg_min(kind, CASE kind WHEN 'page_number' THEN 0 WHEN 'header' THEN 1 ELSE 2 END) AS kind FROM (SELECT z.document_id, z.page_number, z.stream_index, CASE WHEN n.number IS NOT NULL THEN 'page_number' ELSE z.zone END AS kind
 FROM z LEFT JOIN l USING (document_id, zone, literal) LEFT JOIN n ON n.document_id = z.document_id AND n.zone = z.zone AND n.number = z.number WHERE n.number IS NOT NULL OR (z.document_id, z.zone, z.literal) IN (SELECT (document_id, zone, literal) FROM l)) GROUP BY 1, 2, 3""",
}
