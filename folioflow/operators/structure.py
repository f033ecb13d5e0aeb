"""Legal structure: contents pages, headings, provision style, the unit tree and canonical keys.

A line is read by its fields: the word or number it opens with, the number after that word, the mark that
closes the number, and what is left as the caption. Lines that may open a heading are told by one cheap
match in Spark; their fields are taken apart in Arrow batches. Counts over a document are Column expressions.
The nesting inside a section depends on what stands open, so it runs as one pass over the marks of a section.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.operators.lines import carried
from folioflow.session import stage

# The words that open headings, notes and enacting formulas, and the marks around numbers.
ORDINALS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth")
LISTED = ("section", "rule", "regulation", "clause", "chapter", "paragraph")
CONTENTS = ("index", "section", "sections", "content", "contents", "table of content", "table of contents", *(f"arrangement of {x}{s}" for x in LISTED for s in ("", "s")))
FORMULAS = ("an act to", "an act further to", "whereas", "be it enacted", "in exercise of the powers conferred")
PROVISO_WORDS = ("that", "further", "also", "however")
DASHES = "‐‑‒–—―-"
CLOSERS = ".:—–-"
NUMERALS = "IVXLCDM"

MAX_HEADING, MAX_CAPTION, MAX_ENTRY = 200, 199, 119
#: Letters of a caption below its heading that are capitals, as a share.
CAPITALS = 0.8
PROVISIONS = ("section", "article")
STRONG = ("numbered_heading_dash", "article_heading_dash", "article_marker")

_DASH = f"[{DASHES}]"
_DIGITS, _UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS = _UPPER + _UPPER.lower()
#: What a heading or a contents entry may open with: one match that most lines fail.
_OPENS = r"(?i)^\s*(\[?\s*[0-9]|(part|chapter|schedules?|appendix|articles?|art|the|" + "|".join(ORDINALS) + r"|index|sections?|contents?|table|arrangement)\b)"


def _lead(s: str, of: str) -> tuple[str, str]:
    """The opening characters of a text that are among ``of``, and the rest."""
    n = len(s) - len(s.lstrip(of))
    return s[:n], s[n:]


def _hyphenated(tail: str, of: str) -> tuple[str, str]:
    """A suffix of up to three letters behind a hyphen, with a space on either side at most, and the rest."""
    at = tail.find("-", 0, 2)
    if at < 0 or not (at == 0 or tail[0].isspace()):
        return "", tail
    run, rest = _lead(tail[at + 1 :].removeprefix(" "), of)
    return (f"-{run}", rest) if 1 <= len(run) <= 3 and not rest[:1].isalnum() else ("", tail)


def _provision_number(s: str) -> tuple[str, str] | None:
    """The number of a section or article and what follows it: up to four digits and a suffix in capitals."""
    digits, tail = _lead(s, _DIGITS)
    if not 1 <= len(digits) <= 4:
        return None
    suffix, rest = _lead(tail, _UPPER)
    if suffix:
        return (digits + suffix, rest) if len(suffix) <= 3 and not rest[:1].isalnum() else None
    suffix, rest = _hyphenated(tail, _UPPER)
    return digits + suffix, rest


def _division_number(s: str) -> tuple[str, str] | None:
    """The number of a part or chapter: digits or a roman numeral, and a suffix of up to three letters."""
    run, tail = _lead(s, _DIGITS + _LETTERS)
    digits = _lead(run, _DIGITS)[0]
    core = len(digits) if len(digits) <= 3 else 0
    if not digits:
        core = min(7, len(_lead(run.upper(), NUMERALS)[0]))
    if not core or len(run) - core > 3 or not run[core:].isalpha() and run[core:]:
        return None
    suffix, rest = _hyphenated(tail, _LETTERS) if len(run) == core else ("", tail)
    return run + suffix, rest


def _short_number(s: str, letter: bool) -> tuple[str | None, str]:
    """The number that may follow a schedule or appendix: digits, a numeral or, with ``letter``, one letter."""
    digits, rest = _lead(s, _DIGITS)
    if digits:
        return digits[:3], s[len(digits[:3]) :]
    n = min(7, len(_lead(s.upper(), NUMERALS)[0]))
    if n:
        return s[:n], s[n:]
    return (s[0], s[1:]) if letter and s[:1] and s[0] in _LETTERS and not s[1:2].isalpha() else (None, s)


def _unclosed(s: str) -> str:
    """A caption without the mark that closes the number before it."""
    s = s.lstrip()
    return s[1:].lstrip() if s[:1] and s[0] in CLOSERS else s


def caption(s: str | None) -> str | None:
    """A caption in single spaces, without marks at its ends; None if nothing is left."""
    return " ".join(s.split()).strip(" " + CLOSERS) or None if s else None


def _closed_by_dash(rest: str) -> tuple[str, str] | None:
    """Caption and body of a provision whose caption a full stop and a dash close."""
    rest = rest.lstrip()
    at = rest.find(".", 1)
    while 0 < at:
        body = rest[at + 1 :].lstrip()
        if body[:1] and body[0] in DASHES:
            own = rest[:at].rstrip()
            return (own, body.lstrip(DASHES).lstrip()) if len(own) <= MAX_CAPTION else None
        at = rest.find(".", at + 1)
    return None


def _division(bare: str) -> tuple[str, str | None, str] | None:
    """(kind, number, caption) of a part, chapter, schedule or appendix. A schedule's ordinal may stand
    before its word, after "the"."""
    words = bare.split(None, 3)
    low = [w.lower() for w in words]
    after = bare[len(words[0]) :].lstrip()
    if low[0] in ("part", "chapter"):
        told = _division_number(after)
        return (low[0], told[0], _unclosed(told[1])) if told else None
    first = _lead(bare, _LETTERS)
    if first[0].lower() == "appendix":
        number, rest = _short_number(first[1].lstrip(), True)
        return "appendix", number, _unclosed(rest)
    skip = int(low[0] == "the")
    ordinal = words[skip] if skip < len(low) and (low[skip] in ORDINALS or low[skip][-2:] in ("st", "nd", "rd", "th") and low[skip][:-2].isdigit() and len(low[skip]) <= 4) else None
    for _ in range(skip + (ordinal is not None)):
        bare = bare.split(None, 1)[1] if len(bare.split(None, 1)) > 1 else ""
    word, rest = _lead(bare, _LETTERS)
    if word.lower() not in ("schedule", "schedules"):
        return None
    number, rest = _short_number(rest.lstrip(), False)
    return "schedule", number or ordinal, _unclosed(rest)


def _article(bare: str) -> tuple[str, str | None, bool] | None:
    """(number, caption, dashed) of an article, which is told by the word alone: a caption between two dashes,
    or whatever follows the number unless it goes on in small letters."""
    word, _, rest = bare.partition(" ")
    told = _provision_number(rest.lstrip()) if word in ("Article", "ARTICLE", "Art.") else None
    if told is None:
        return None
    tail = told[1].lstrip().removeprefix(".").removeprefix("º").lstrip()
    if tail[:1] and tail[0] in DASHES:
        own = tail.lstrip(DASHES).lstrip()
        ends = [k for d in DASHES if (k := own.find(d, 1)) > 0]
        if ends and min(ends) <= MAX_CAPTION:
            return told[0], own[: min(ends)].rstrip().removesuffix("."), True
    own = _unclosed(tail)
    if own[:1].islower():
        return None
    return told[0], own if len(bare) <= MAX_HEADING // 2 else None, False


def heading_of(text: str) -> tuple[str, str | None, str | None, str] | None:
    """(unit_type, number, heading, detected_by) of a line, by the first reading that it allows: division,
    article, provision closed by a dash, numbered line. A part, chapter, schedule or appendix is short, not
    left open by a comma and not followed by small letters."""
    bare = text.strip()
    if not bare:
        return None
    short = len(bare) <= MAX_HEADING
    if bare[0] in _LETTERS:
        found = _division(bare) if short and bare[-1] not in ",;" else None
        if found and not found[2][:1].islower():
            return found[0], caption(found[1]), caption(found[2]), f"{found[0]}_heading"
        found = _article(bare)
        return ("article", found[0], caption(found[1]), "article_heading_dash" if found[2] else "article_marker") if found else None
    told = _provision_number(bare.removeprefix("[").lstrip())
    if told is None or not (rest := told[1].lstrip()).startswith("."):
        return None
    rest = rest[1:]
    closed = _closed_by_dash(rest)
    if closed:
        return "section", told[0], caption(closed[0]), "numbered_heading_dash"
    own = rest.strip()
    own = own[:-1].rstrip() if own.endswith(".") else own
    return ("section", told[0], caption(own), "numbered_heading_line") if short and rest[:1].isspace() and 1 <= len(own) <= MAX_CAPTION else None


def listed(text: str) -> tuple[bool, bool]:
    """Whether a line is a contents entry (a number with a short caption and no body, or a number alone), and
    whether it names a contents page."""
    bare = text.strip()
    named = len(bare) < 64 and " ".join(bare.lower().rstrip(".:").split()) in CONTENTS
    told = _provision_number(bare)
    if told is None:
        return False, named
    rest = told[1].lstrip()
    if rest in ("", "."):
        return True, named
    own = rest[1:].strip()
    return rest[0] == "." and rest[1:2].isspace() and len(own) <= MAX_ENTRY and _closed_by_dash(rest[1:]) is None, named


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(b.num_columns - 1).to_pylist()
        found = [heading_of(t) or (None,) * 4 for t in texts]
        marks = [listed(t) for t in texts]
        new = [pa.array([m[k] for m in marks], pa.bool_()) for k in (0, 1)] + [pa.array([f[k] for f in found], pa.string()) for k in range(4)]
        yield pa.RecordBatch.from_arrays([*b.columns, *new], [*b.schema.names, "entry", "named", *_FIELDS])


_FIELDS = ("unit_type", "number", "heading", "detected_by")


def _readings(lines: DataFrame, *keys: str) -> DataFrame:
    """The keys and text of each line that may be a heading or a contents entry, with what it is read for."""
    rows = lines.where(F.col("text").rlike(_OPENS)).select(*keys, "text")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_read, f"{ddl}, entry boolean, named boolean, " + ", ".join(f"{x} string" for x in _FIELDS))


def _contents(read: DataFrame, lines: DataFrame, run: int = 5) -> DataFrame:
    marks = read.where("entry or named").groupBy("document_id", "page_number").agg(F.count_if("entry").alias("entries"), F.bool_or("named").alias("named"))
    sizes = lines.groupBy("document_id", "page_number").agg(F.count("*").alias("n"))
    pages = marks.where(F.col("named") | (F.col("entries") >= run)).join(sizes, ["document_id", "page_number"])
    return pages.where(F.col("named") | (F.col("entries") * 2 >= F.col("n"))).select("document_id", "page_number")


def contents_pages(lines: DataFrame, run: int = 5) -> DataFrame:
    """(document_id, page_number): pages that name themselves contents, or of whose lines five and half at
    least are bare entries: a number with a short caption and no body, or a number alone."""
    return _contents(_readings(lines, "document_id", "page_number"), lines, run)


def _is_caption(text: Column) -> Column:
    """Short, in capitals and not itself a heading or a label."""
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    letters, upper = F.regexp_count(bare, F.lit(r"\p{L}")), F.regexp_count(bare, F.lit(r"\p{Lu}"))
    word = F.lower(F.regexp_extract(bare, "^[A-Za-z]*", 0))
    return (F.length(bare) <= MAX_HEADING) & (letters > 0) & (upper >= CAPITALS * letters) & ~word.isin("part", "chapter", "article") & ~bare.rlike(r"^(\(|\[?\s*[0-9]+)")


def anchors(lines: DataFrame) -> DataFrame:
    """(document_id, line_no, page_number, text, unit_type, number, heading, detected_by): the headings of a
    line stream (``operators.lines.line_stream``) off its contents pages (``heading_of``). A division without a
    caption of its own takes the next line, if that is one (``..._caption_below``).

    The readings are written to the shared folder: they are few lines and used several times.
    """
    read = stage(_readings(lines, "document_id", "line_no", "page_number"), "readings")
    found = read.where("unit_type is not null").join(_contents(read, lines), ["document_id", "page_number"], "left_anti")
    bare = found.where(F.col("heading").isNull() & ~F.col("unit_type").isin(*PROVISIONS)).select("document_id", "line_no")
    below = lines.where(_is_caption(F.col("text"))).select("document_id", (F.col("line_no") - 1).alias("line_no"), F.col("text").alias("_below"))
    taken = bare.join(below, ["document_id", "line_no"]).select("document_id", "line_no", F.nullif(F.regexp_replace(F.regexp_replace("_below", r"\s+", " "), f"^[ {CLOSERS}]+|[ {CLOSERS}]+$", ""), F.lit("")).alias("_below"))
    out = found.join(taken, ["document_id", "line_no"], "left")
    return out.select("document_id", "line_no", "page_number", "text", "unit_type", "number", F.coalesce("heading", "_below").alias("heading"), F.when(F.col("_below").isNotNull(), F.concat("detected_by", F.lit("_caption_below"))).otherwise(F.col("detected_by")).alias("detected_by"))


def provision_style(found: DataFrame) -> DataFrame:
    """(document_id, style): how a document numbers its provisions: articles from three on, else dashed
    headings from three on, else plain lines from three on, else whichever there are in that order."""
    n = lambda c: F.count_if(c)
    by = F.col("detected_by")
    c = found.groupBy("document_id").agg(n(by.startswith("article")).alias("articles"), n(by == "numbered_heading_dash").alias("dashed"), n(by == "numbered_heading_line").alias("plain"))
    style = F.when(F.col("articles") >= 3, "article").when(F.col("dashed") >= 3, "dash").when(F.col("plain") >= 3, "line").when(F.col("articles") > 0, "article").when(F.col("dashed") > 0, "dash").when(F.col("plain") > 0, "line").otherwise("none")
    return c.withColumn("style", style)


def chosen_provisions(found: DataFrame) -> DataFrame:
    """Divisions, and the provisions of the document's own style only; a document of articles keeps its
    dashed sections from three on."""
    style = provision_style(found)
    by = F.col("detected_by")
    keep = ~F.col("unit_type").isin(*PROVISIONS) | ((F.col("style") == "article") & (by.startswith("article") | ((by == "numbered_heading_dash") & (F.col("dashed") >= 3)))) | ((F.col("style") == "dash") & (by == "numbered_heading_dash")) | ((F.col("style") == "line") & (by == "numbered_heading_line"))
    return found.join(style, "document_id").where(keep).select(found.columns)


def _first_number(number: Column) -> Column:
    return F.nullif(F.regexp_extract(number, r"^([0-9]+)", 1), F.lit("")).cast("int")


def ascending_share(provisions: DataFrame) -> DataFrame:
    """(document_id, pairs, share): of consecutive provision numbers, those that don't fall; null below five."""
    rows = provisions.where(F.col("unit_type").isin(*PROVISIONS)).withColumn("n", _first_number(F.col("number"))).where("n is not null").select("document_id", "line_no", "n")
    rows = carried(rows, "document_id", "line_no", {"before": F.col("n")}, own=False)
    out = rows.groupBy("document_id").agg(F.count("before").alias("pairs"), F.count_if(F.col("n") >= F.col("before")).alias("up"))
    return out.select("document_id", "pairs", F.when(F.col("pairs") >= 4, F.round(F.col("up") / F.col("pairs"), 4)).alias("share"))


def longest_ascending(keys: list) -> list[int]:
    """Places of a longest run of keys that never falls; of several, one that ends as early as it can."""
    tails: list = []
    at: list[int] = []
    back = [-1] * len(keys)
    for i, k in enumerate(keys):
        p = bisect_right(tails, k)
        if p:
            back[i] = at[p - 1]
        if p == len(tails):
            tails.append(k)
            at.append(i)
        else:
            tails[p], at[p] = k, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def _order(number: str | None) -> tuple[int, str]:
    m = re.match(r"(\d+)\s*-?\s*([A-Z]*)", number or "")
    return (int(m[1]), m[2]) if m else (0, number or "")


def in_sequence(provisions: DataFrame) -> DataFrame:
    """Provisions without those that break their kind's ascending order, as long as they are 30 % at most;
    fewer than three, or more breaks, leave all. The numbers of one document and kind make a group, without
    their texts: a longest ascending run is a property of the whole sequence."""
    names = ["document_id", "unit_type", "line_no"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for did, kind, listed in zip(*(c.to_pylist() for c in batch.columns)):
                kept = longest_ascending([_order(x["number"]) for x in listed])
                if len(listed) < 3 or len(listed) - len(kept) > 0.3 * len(listed):
                    kept = range(len(listed))
                out += [(did, kind, listed[k]["line_no"]) for k in kept]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int32()))] if out else [pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], pa.int32())], names)

    own = provisions.where(F.col("unit_type").isin(*PROVISIONS)).groupBy("document_id", "unit_type").agg(F.array_sort(F.collect_list(F.struct("line_no", "number"))).alias("listed"))
    kept = own.mapInArrow(run, "document_id string, unit_type string, line_no int")
    return provisions.where(~F.col("unit_type").isin(*PROVISIONS)).unionByName(provisions.join(kept, names).select(provisions.columns))


def unit_spans(found: DataFrame, lines: DataFrame) -> DataFrame:
    """Units with ``line_end``, ``parent_line`` and ``key``. A provision, schedule or appendix runs to the line
    before the next heading, the last one to the document's end; a part or chapter, or whatever else holds
    units, to the end of the last of them. A provision stands in the schedule that no part or chapter has
    followed, else in the chapter since the last part, else in that part; a chapter stands in the part
    before it, unless a schedule came between. The key is the path of types and numbers.

    What stands before a heading is carried over buckets of lines (``lines.carried``), so that a document of
    any size is many tasks' work.
    """
    last = lines.groupBy("document_id").agg(F.max("line_no").alias("last"))
    kind, at = F.col("unit_type"), F.col("line_no")
    own = F.struct("line_no", "unit_type", "number")
    rows = carried(found, "document_id", "line_no", {"_schedule": F.when(kind.isin("schedule", "appendix"), own), "_part": F.when(kind == "part", own), "_chapter": F.when(kind == "chapter", own)}, own=False)
    rows = carried(rows, "document_id", "line_no", {"_next": at}, own=False, ahead=True).join(last, "document_id")
    place = lambda c: F.coalesce(F.col(c)["line_no"], F.lit(-1))
    s, p, c = place("_schedule"), place("_part"), place("_chapter")
    top = kind.isin("schedule", "appendix", "part")
    chapter = F.when(~top & (kind != "chapter") & (c > F.greatest(s, p)), F.col("_chapter"))
    part = F.when(~top & (p > s), F.col("_part"))
    schedule = F.when(~top & (kind != "chapter") & (s > F.greatest(p, c)), F.col("_schedule"))
    end = F.when(kind.isin("part", "chapter"), at).otherwise(F.coalesce(F.col("_next") - 1, F.col("last"))).cast("int")
    step = lambda x: F.when(x.isNotNull(), F.concat(x["unit_type"], F.lit(":"), F.coalesce(x["number"], F.lit("_"))))
    rows = rows.withColumns({"line_end": end, "_in": F.array_compact(F.array(part["line_no"], chapter["line_no"], schedule["line_no"])), "key": F.concat_ws("/", step(schedule), step(part), step(chapter), step(own))})
    rows = rows.withColumn("parent_line", F.array_max("_in")).drop("_schedule", "_part", "_chapter", "_next", "last")
    held = rows.select("document_id", F.explode("_in").alias("line_no"), F.col("line_end").alias("_held")).groupBy("document_id", "line_no").agg(F.max("_held").alias("_held"))
    rows = rows.drop("_in").join(held, ["document_id", "line_no"], "left")
    return rows.withColumn("line_end", F.greatest("line_end", "_held")).drop("_held")


def inner_units(first: int, final: int, marks: list[tuple[int, str | None, str | None]]) -> list[tuple[int, int, str, str | None, int, str]]:
    """(line, line_end, kind, label, depth, path) of what the marks of a section open: subsections, clauses,
    subclauses, provisos and explanations. ``marks`` holds (line, kind, label) in order; of a labelled one
    the kind is not yet known.

    Each label is read as every kind that it allows, and the reading with most behind it counts: a digit is a
    subsection; a letter may be the next clause, a numeral the next subclause of an open clause. What a unit
    runs up to is the next mark, or the end of the last unit inside it.
    """
    rank = {"subsection": 1, "clause": 2, "subclause": 3}
    units: list[list] = []
    stack: list[int] = []
    clause = ""
    for n, (line, kind, label) in enumerate(marks):
        if label:
            low = label.lower()
            inside = any(units[k][2] == "clause" for k in stack)
            weight = {"subsection": 9} if label[0].isdigit() else {"clause": 1}
            if not label[0].isdigit() and not low.strip("ivxlcdm"):
                weight["subclause"] = 2 if inside else 0
                if len(low) == len(clause) == 1 and ord(low) - ord(clause) == 1:
                    weight["clause"] = 3
            kind = max(weight, key=weight.get)
            while stack and rank[units[stack[-1]][2]] >= rank[kind]:
                stack.pop()
            clause = "" if kind == "subsection" else low if kind == "clause" else clause
        up = stack[-1] if stack else -1
        stop = marks[n + 1][0] - 1 if n + 1 < len(marks) else final
        step = f"{kind}:{label or '_'}"
        units.append([line, max(line, stop), kind, label, len(stack) + 1, f"{units[up][5]}/{step}" if stack else step, up])
        if label:
            stack.append(n)
    for u in reversed(units):
        if u[6] >= 0:
            units[u[6]][1] = max(units[u[6]][1], u[1])
    return [tuple(u[:6]) for u in units]


def _after(c: Column, n: Column) -> Column:
    """What follows the first ``n`` characters."""
    return F.substring(c, n + 1, F.lit(1 << 30))


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _label(bare: Column) -> Column:
    """What stands in the brackets that a line opens with, if more follows them."""
    inside = F.substring_index(_after(bare, F.lit(1)), ")", 1)
    label = F.trim(inside)
    sound = bare.startswith("(") & F.length(label).between(1, 6) & ~label.rlike("[^0-9A-Za-z]") & (F.trim(_after(bare, F.length(inside) + 2)) != "")
    return F.when(sound, label)


def _qualifier(bare: Column) -> Column:
    """proviso or explanation, by the first words of a line."""
    inner = F.lower(F.regexp_replace(bare, r"^\[\s*", ""))
    tokens = F.split(inner, r"[^a-z]+", 3)
    told = F.regexp_replace(_after(inner, F.lit(len("explanation"))), r"^\s*[0-9ivx]{0,4}\s*", "")
    return F.when(inner.startswith("explanation") & told.rlike(f"^[{CLOSERS}]"), "explanation").when((tokens[0] == "provided") & F.coalesce(F.get(tokens, F.lit(1)), F.lit("")).isin(*PROVISO_WORDS), "proviso")


def section_bodies(units: DataFrame, lines: DataFrame) -> DataFrame:
    """(document_id, key, line_no, line_end, unit_type, label, depth, path): the units inside each provision.

    Only lines that open with a label, a proviso or an explanation leave Spark, without their texts; the
    provision that each stands in is carried down to it over buckets of lines. The marks of one provision make
    a group.
    """
    own = units.where(F.col("unit_type").isin(*PROVISIONS))
    body = F.element_at(F.split("text", rf"\.\s*{_DASH}+\s*", 2), -1)
    opened = F.when(F.col("detected_by") == "numbered_heading_dash", _label(body)).when(F.col("detected_by") == "article_heading_dash", _label(F.element_at(F.split("text", rf"{_DASH}+\s*", 3), -1)))
    heads = own.select("document_id", "line_no", F.struct("key", F.col("line_no").alias("first"), F.col("line_end").alias("final")).alias("_own"), F.lit(None).cast("string").alias("kind"), opened.alias("label"))
    bare = _strip(F.col("text"))
    rows = lines.where(F.col("text").rlike(r"(?i)^\s*(\(|\[?\s*(provided|explanation))")).select("document_id", "line_no", F.lit(None).cast(heads.schema["_own"].dataType).alias("_own"), _qualifier(bare).alias("kind"), _label(bare).alias("label"))
    rows = carried(rows.where("kind is not null or label is not null").unionByName(heads), "document_id", "line_no", {"_in": F.col("_own")}).where("_in is not null and line_no <= _in.final and (kind is not null or label is not null)")
    bodies = rows.groupBy("document_id", "_in").agg(F.array_sort(F.collect_list(F.struct("line_no", "kind", "label"))).alias("marks")).select("document_id", "_in.*", "marks")
    names = ["document_id", "key", "line_no", "line_end", "unit_type", "label", "depth", "path"]
    types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(did, key, *u) for did, key, first, final, marks in zip(*(c.to_pylist() for c in batch.columns)) for u in inner_units(first, final, [tuple(m.values()) for m in marks])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], names)

    return bodies.mapInArrow(run, "document_id string, key string, line_no int, line_end int, unit_type string, label string, depth int, path string")


def has_formula(text: Column) -> Column:
    """Whether an enacting formula begins at the line's start or after white space, and ends with a word."""
    flat = F.concat(F.lit(" "), F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9\s]", " |"), r"\s+", " "), F.lit(" "))
    return F.greatest(*[flat.contains(f" {x} ").cast("int") for x in FORMULAS]) == 1


def preambles(lines: DataFrame, found: DataFrame) -> DataFrame:
    """(document_id, line_no, line_end): from the first enacting formula off the contents pages to the line
    before the first heading; documents without a formula there have none."""
    first = found.groupBy("document_id").agg(F.min("line_no").alias("first"))
    said = lines.where(has_formula(F.col("text"))).join(contents_pages(lines), ["document_id", "page_number"], "left_anti")
    rows = said.join(first, "document_id", "left").where(F.col("line_no") < F.coalesce("first", F.lit(2**31 - 1)))
    last = lines.groupBy("document_id").agg(F.max("line_no").alias("last"))
    return rows.groupBy("document_id").agg(F.min("line_no").alias("line_no"), F.min("first").alias("first")).join(last, "document_id").select("document_id", "line_no", F.greatest("line_no", F.coalesce(F.col("first") - 1, F.col("last"))).alias("line_end"))


def titles(lines: DataFrame, documents: DataFrame, head: int = 40) -> DataFrame:
    """(document_id, title, title_source): the recorded title, confirmed where one of the first ``head`` lines
    off the contents pages holds it; without one, the first of those lines in capitals, of ten characters at
    least. Neither: both null."""
    top = lines.where(F.col("line_no") < head).join(contents_pages(lines), ["document_id", "page_number"], "left_anti")
    bare = _strip(F.col("text"))
    fold = lambda c: F.regexp_replace(F.regexp_replace(F.lower(_strip(c)), r"\s+", " "), "[0-9]+", "#")
    caps = F.length(bare).between(10, MAX_HEADING) & (F.regexp_count(bare, F.lit(r"\p{Lu}")) > CAPITALS * F.regexp_count(bare, F.lit(r"\p{L}")))
    rows = documents.select("document_id", F.nullif(F.trim("title"), F.lit("")).alias("_said")).join(top.select("document_id", "line_no", bare.alias("_bare"), caps.alias("_caps"), fold(F.col("text")).alias("_line")), "document_id", "left")
    rows = rows.withColumn("_hit", F.coalesce(F.col("_line").contains(F.regexp_replace(fold(F.col("_said")), "^the ", "")), F.lit(False)))
    out = rows.groupBy("document_id").agg(F.max("_said").alias("said"), F.max("_hit").alias("hit"), F.min_by("_bare", F.when(F.col("_caps"), F.col("line_no"))).alias("line"))
    source = F.when(F.col("said").isNotNull(), F.when(F.col("hit"), "metadata_confirmed_on_page").otherwise("metadata")).when(F.col("line").isNotNull(), "first_page_heading")
    return out.select("document_id", F.coalesce("said", "line").alias("title"), source.alias("title_source"))


def structure_summary(units: DataFrame) -> DataFrame:
    """(document_id, counts, confidence): units by type; structured from three provisions on, partial with any
    provision, part, chapter or schedule."""
    per = units.groupBy("document_id", "unit_type").agg(F.count("*").alias("n"))
    some = lambda *kinds: F.sum(F.when(F.col("unit_type").isin(*kinds), F.col("n")).otherwise(0))
    out = per.groupBy("document_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("unit_type", "n")))).alias("counts"), some(*PROVISIONS).alias("provisions"), some("part", "chapter", "schedule").alias("divisions"), F.sum("n").alias("units"))
    return out.withColumn("confidence", F.when(F.col("provisions") >= 3, "structured").when(F.col("provisions") + F.col("divisions") > 0, "partial").otherwise("unstructured"))


def evidence_tier(detected_by: Column, pages: Column, ocr_pages: Column) -> Column:
    """high for a strong heading off OCR pages, medium for one of the two, else low."""
    strong, ocr = detected_by.isin(*STRONG), F.coalesce(F.arrays_overlap(pages, ocr_pages), F.lit(False))
    return F.when(strong & ~ocr, "high").when(strong | ~ocr, "medium").otherwise("low")
