"""Problem 3: text quality statistics, and prose told apart from lists, tables and junk."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.furniture import BODY, Roles, series
from folioflow.llm.lines import doc_chunks, groups, heads_of
from folioflow.llm.scans import _give, line_words, words_of
from folioflow.session import cut

PROSE, LIST, TABLE, JUNK = "prose", "list", "table", "junk"
CLASSES = (PROSE, LIST, TABLE, JUNK)

#: A common word stands in at least this share of the documents with its script, and in COMMON_LEAST of them. Of each
#: script there are at most 1 / share times as many as a document has different words on average.
COMMON_SHARE, COMMON_LEAST = 0.002, 2
#: Of a line's words, this share at least is common in readable text.
READABLE = 0.5
#: Characters that don't occur in writing, as a share of a line, from which on it is junk.
ODD_SHARE = 0.15
#: Copies of one line in a chunk from which on it is filler.
FILLER = 3
#: Unless of its words this share is common.
FAMILIAR = 0.8
#: Lines before and after a row that its cells are held against, and the share of them that must stand under others.
ALIGNED, STANDS_UNDER = 2, 0.6
#: Points from which on a line is an entry of a list.
ITEM = 3

_ENUM = re.compile(r"\s*(?:[\[(](?:\d{1,3}|[A-Za-z]|[ivxlcIVXLC]{1,7})[\])]|(?:\d{1,3}|[A-Za-z]|[ivxlcIVXLC]{1,7})[.)]\s|[•\-*–—▪◦·‣►]\s)")
_BULLETS = frozenset("0123456789[(•-*–—▪◦·‣►")
_LEADER = re.compile(r"[.·…]{4,}\s*\S{0,8}\s*\Z")
_BLANKS = re.compile(r"_{3,}|\.{12,}\Z")
_GAP = re.compile(r"(?<=\S)\s{2,}(?=\S)")
_CELL = re.compile(r"[^\s|](?:[^\s|]|[^\S\t](?=[^\s|]))*")
_VALUE = re.compile(r"\s*(?:[-–—]|nil|n/?a|[$₹€£]?\s*-?[\d.,]*\d[\d.,]*\s*%?)\s*\Z", re.I)
_END = frozenset(".!?;:।")
_SENTENCE = re.compile(r"[.!?।](?:\s|\Z)")


#: Words that one task holds before it gives them; a document with more than MANY of them gives them in PARTS.
HELD, MANY, PARTS = 400_000, 20_000, 8
#: Stands among a document's words for the document itself and, with a number after it, for its scripts. No
#: word holds this character.
MARK_OF = "="
FAR_SCRIPTS = 40


def script_of(word: str) -> int:
    """The block of 128 code points that a word's first letter is in; Latin letters are 0, those beyond the
    alphabets are one."""
    c = ord(word[0])
    return min(c >> 7, FAR_SCRIPTS) if c > 0x24F else 0


def marks_of(words: set[str]) -> set[str]:
    """The marks of a document with these words and of the scripts of those that begin with a letter."""
    return {MARK_OF, *(f"{MARK_OF}{script_of(c)}" for c in {w[0] for w in words} if c.isalpha())}


def part_of(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % PARTS


def runs(b: pa.RecordBatch) -> Iterator[tuple[str, str]]:
    """Of a batch of (document_id, text): each run of rows of one document as one text, joined in Arrow."""
    if b.num_rows:
        ids = b.column(0).dictionary_encode()
        place = np.asarray(ids.indices)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1, [b.num_rows]]).astype(np.int32)
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), b.column(1).fill_null("")), "\n")
        yield from zip(ids.dictionary.take(pa.array(place[cuts[:-1]])).to_pylist(), texts.to_pylist())


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(document_id, part, words): the different words of each document, as far as a task sees it, with the
    marks of the document and its scripts. Part -1 holds whatever the document's words are; a document of very
    many gives them by part."""
    held: dict[str, set[str]] = defaultdict(set)
    size = 0

    def give() -> pa.RecordBatch:
        rows: list[tuple[str, int, str]] = []
        for did, own in held.items():
            marks = marks_of(own)
            if len(own) <= MANY:
                rows.append((did, -1, " ".join(own | marks)))
                continue
            parts: dict[int, list[str]] = defaultdict(list)
            for w in own:
                parts[part_of(w)].append(w)
            rows += [(did, -1, " ".join(marks)), *((did, k, " ".join(x)) for k, x in parts.items())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.string()))] if rows else [pa.array([], pa.string()), pa.array([], pa.int32()), pa.array([], pa.string())], ["document_id", "part", "words"])

    for b in batches:
        for did, text in runs(b):
            own = held[did]
            before = len(own)
            own.update(words_of(text))
            size += len(own) - before
        if size > HELD:
            yield give()
            held.clear()
            size = 0
    yield give()


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each word, from rows in order of (document_id, part) of which those of a document are all in
    one task. Words of part -1 wait for the part they belong to, if the document has parts."""
    seen: Counter[str] = Counter()
    now, at, own, waiting = None, -1, set(), set()
    for b in batches:
        for did, part, words in zip(*(c.to_pylist() for c in b.columns)):
            if did != now:
                seen.update(own | waiting)
                now, at, own, waiting = did, -1, set(), set()
            if part != at:
                if at < 0:
                    own, waiting = set(), own
                seen.update(own)
                own = {w for w in waiting if part_of(w) == part}
                waiting -= own
                at = part
            own.update(words.split(" "))
        if len(seen) > HELD:
            yield from _give(seen)
            seen = Counter()
    seen.update(own | waiting)
    yield from _give(seen)


def common_words(lines: DataFrame) -> frozenset[str]:
    """Words that many documents hold, so that what one document repeats does not become common. A document
    counts once for a word, in whatever order and pieces its lines are stored; numbers and single letters
    are left out. A word is held against the documents that have words of its script, so that a rare script
    is judged by its own documents."""
    rows = lines.where("document_id is not null").select("document_id", "text").mapInArrow(_partial, "document_id string, part int, words string")
    rows = rows.repartition("document_id").sortWithinPartitions("document_id", "part")
    counts = cut(rows.mapInArrow(_frequencies, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    marks = {r["word"][1:]: r["n"] for r in counts.where(F.col("word").startswith(MARK_OF)).collect()}
    least = lambda n: max(COMMON_LEAST, n * COMMON_SHARE)
    script = F.when(F.ascii("word") > 0x24F, F.least(F.shiftright(F.ascii("word"), 7), F.lit(FAR_SCRIPTS))).otherwise(0)
    cutoff = F.lit(least(marks.pop("", 0)))
    for k, n in marks.items():
        cutoff = F.when(script == int(k), least(n)).otherwise(cutoff)
    kept = counts.where((F.length("word") > 1) & ~F.col("word").startswith(MARK_OF) & (F.col("n") >= cutoff)).toPandas()
    return frozenset(w for w in kept["word"] if not w.isdigit())


#: A group has words of its own if of its unknown words with OWN_LETTERS letters or more this share stands on
#: OWN_LINES lines or more, and so many different ones do.
OWN_LINES, OWN_LETTERS, OWN_SHARE, OWN_WORDS = 3, 4, 0.4, 15


def own_words(tokens: list[list[str]], common: frozenset[str]) -> set[str]:
    """Words outside ``common`` that a group of lines uses again and again, as a language does that few
    documents are in: a rare language is told from junk by its own texts, however small its share of the
    corpus. Garbled text repeats few of its words, filler has few different ones; both give none."""
    unknown = set().union(*tokens) - common
    if len(unknown) < OWN_WORDS:
        return set()
    seen: Counter[str] = Counter()
    for t in tokens:
        seen.update(unknown.intersection(t))
    long = {w: n for w, n in seen.items() if (len(w) >= OWN_LETTERS and w.isalpha()) or not w.isascii()}
    again = [n for n in long.values() if n >= OWN_LINES]
    if len(again) < OWN_WORDS or sum(again) < OWN_SHARE * sum(long.values()):
        return set()
    return {w for w, n in seen.items() if n >= OWN_LINES and w[0].isalpha()}


LETTER, DIGIT, MARK, SPACE, PLAIN, SYMBOL, ODD = range(7)
_PLAIN = frozenset(".,;:!?'\"()[]%&/|-–—‘’“”•*§°·।॥‐¬₹$€£#+=")
#: Characters that written text does not hold; an underscore counts with blanks to fill in.
_NEVER = frozenset("_�¤#+=~<>^{}\\@`")


@lru_cache(1)
def kinds_of_characters() -> np.ndarray:
    """The kind of each code point of the basic plane; the last entry stands for all others."""
    out = np.full(0x10001, ODD, np.uint8)
    for c in range(0x10000):
        ch = chr(c)
        cat = unicodedata.category(ch)
        out[c] = (
            ODD if ch in _NEVER else SPACE if ch.isspace() or ch in "\xad\u200b\u200c\u200d" else PLAIN if ch in _PLAIN else LETTER if cat[0] == "L" and not 0xC2 <= c <= 0xC3 else DIGIT if cat == "Nd" else MARK if cat[0] == "M" else SYMBOL if cat[0] in "SPN" and c not in (0xA9, 0xAC, 0x20AC) else ODD
        )
    return out


def character_kinds(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Kinds of all characters of the texts with a line break after each, and where each text begins."""
    cps = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return kinds_of_characters()[np.minimum(cps, 0x10000)], at


def cells(text: str) -> tuple[str, list[str]]:
    """The delimiter of a line's cells and the cells: a tab, a bar, a gap of spaces or, where most cells are
    values, a comma or semicolon; else none and the line alone."""
    t = text.strip()
    if "\t" in t:
        return "\t", [x.strip() for x in t.split("\t")]
    if " | " in t or t.count("|") > 1:
        return "|", [x.strip() for x in t.strip("|").split("|")]
    if "  " in t and len(parts := _GAP.split(t)) > 1 and not _LEADER.search(t):
        return " ", parts
    if "," in t or "; " in t:
        for d in (", ", "; ", ","):
            if t.count(d) > 1 or d != "," and d in t:
                parts = t.split(d)
                values = sum(_VALUE.match(x) is not None for x in parts)
                if values >= 0.4 * len(parts) and values:
                    return d[0], parts
    return "", [t]


def columns(text: str) -> list[tuple[int, int]]:
    """Where the cells that gaps or bars part begin and end in a line."""
    return [(m.start(), m.end()) for m in _CELL.finditer(text.rstrip())]


def alignment(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> float:
    """Of the cells of two lines, as a share of the larger number, those that begin or end in one column, a
    character off at most: cells flush left or flush right."""
    left, right = {x + d for x, _ in b for d in (-1, 0, 1)}, {y + d for _, y in b for d in (-1, 0, 1)}
    return sum(x in left or y in right for x, y in a) / max(len(a), len(b), 1)


def autocorrelation(x: np.ndarray, most: int = 4) -> float:
    """Greatest correlation of a series with itself 1 to ``most`` places on; 0 where it is too short or even."""
    x = x - x.mean()
    base = float((x * x).sum())
    if len(x) < 2 * most or base == 0:
        return 0.0
    return max(float((x[k:] * x[:-k]).sum()) / base for k in range(1, most + 1))


def upper(x: np.ndarray, share: float = 0.9) -> float:
    """The value that ``share`` of a series lie below, between two by proportion; 0 of an empty one."""
    if not len(x):
        return 0.0
    x, at = np.sort(x), share * (len(x) - 1)
    k = int(at)
    return float(x[k] + (x[min(k + 1, len(x) - 1)] - x[k]) * (at - k))


def periodicity(indent: np.ndarray) -> float:
    """How regularly indented lines recur: the greatest autocorrelation of the indentation."""
    return autocorrelation(indent.astype(float)) if indent.any() else 0.0


def in_table(i: int, split: list[tuple[str, list[str]]], texts: list[str]) -> bool:
    """Whether a line is a row of cells. Its cells are values, or they stand under those of a line near by:
    the same delimiter as often, or gaps and bars in the same columns (``alignment``)."""
    mark, own = split[i]
    values = sum(_VALUE.match(c) is not None for c in own)
    if len(own) >= 3 and 2 * values >= len(own):
        return True
    if not values and (len(own) < 3 or sum(map(len, own)) > 25 * len(own)):
        return False
    near = [j for j in range(max(0, i - ALIGNED), min(len(split), i + ALIGNED + 1)) if j != i and len(split[j][1]) > 1]
    if any(len(split[j][1]) == len(own) for j in near):
        return True
    return mark in " |" and any(split[j][0] == mark and alignment(columns(texts[i]), columns(texts[j])) >= STANDS_UNDER for j in near)


def opening(s: str) -> int:
    """Characters of the number, letter or bullet that a line opens with; 0 for none."""
    if s[:1] in _BULLETS or "." in s[1:9] or ")" in s[1:9]:
        m = _ENUM.match(s)
        return m.end() if m else 0
    return 0


def list_evidence(i: int, bare: list[str], toks: list[str], out: list[str], short: bool, filled: float, rhythm: float, running: float) -> int:
    """What speaks for a line as an entry of a list, in points; ITEM or more make it one.

    A sentence, or small letters that go on in the next line, take away all. An opened line (a number, letter or
    bullet) has 2, and 1 if it leaves room: short, on a loose page, the last, or before another opened line.
    Other lines begin with a capital: 3 for items in a row; else 1 each for a page that running text doesn't
    fill, for few words, and for no line before that breaks off. Indentation that recurs adds 1 and line
    lengths that follow each other take 2, as the fill of running text makes them do.
    """
    s = bare[i]
    following = bare[i + 1] if i + 1 < len(bare) else ""
    next_opened = opening(following) > 0
    if following[:1].islower() and not next_opened:
        return 0
    opened = opening(s)
    if not opened and not s[:1].isupper():
        return 0
    if len(s) - opened > 160 or _SENTENCE.search(s, opened):
        return 0
    if opened:
        return 2 + (short or filled < 0.5 or not following or next_opened)
    if s.count(",") >= 2 and len(toks) <= 2.2 * (s.count(",") + 1):
        return ITEM
    whole = i == 0 or out[-1] == LIST or not bare[i - 1][-1:].islower()
    return (filled < 0.35) + (len(toks) <= 6) + whole + (rhythm > 0.5) - 2 * (running > 0.5)


def classify_lines(texts: list[str], tokens: list[list[str]], common: frozenset[str] | set[str], odd: np.ndarray | None = None, known: list[int] | None = None) -> list[str]:
    """A class for each line of one group, from the line and the ones around it.

    Tables: rows of cells that are values or stand under those of other rows (``in_table``). Junk: characters
    that aren't writing, blanks to fill in, lines repeated, words that aren't words. Lists: led by dots to a
    page, or enough evidence for an entry (``list_evidence``), in which the group's fill, the periodicity of its
    indentation and the autocorrelation of its line lengths count. ``known`` is the number of common words of each.
    """
    n = len(texts)
    size = np.array([len(t.rstrip()) for t in texts], float)
    full = upper(size)
    filled = float((size >= 0.8 * full).mean()) if n else 0.0
    bare = [t.strip() for t in texts]
    copies = Counter(bare)
    running, rhythm = autocorrelation(size), periodicity(np.array([len(t) - len(t.lstrip()) for t in texts]))
    if odd is None:
        kind, at = character_kinds(texts)
        odd = np.add.reduceat(kind == ODD, at[:-1], dtype=np.int64) if n else at[:0]
    if known is None:
        known = [len([w for w in x if w in common]) for x in tokens]
    short = (size < 0.8 * full).tolist()
    split = [cells(t) for t in bare]
    out: list[str] = []
    for i, (s, toks, strange, k) in enumerate(zip(bare, tokens, odd.tolist(), known)):
        words = len(toks)
        alone = len(split[i][1]) == 1
        few = words > 5 and len(set(toks)) <= words // 3
        leader = "...." in s or "··" in s or "……" in s
        if alone and k == words and s[:1].islower() and not strange and not few and not leader and copies[s] < FILLER and not opening(s):
            out.append(PROSE)  # nothing below could hold: no cells, no junk, no entry without a capital or an opening
            continue
        if k < READABLE * words or copies[s] >= FILLER:
            words -= len([w for w in toks if w[0].isdigit()])
        if strange > ODD_SHARE * len(s) or "__" in s and k < 3 and _BLANKS.search(s):
            out.append(JUNK)
        elif not alone and in_table(i, split, texts):
            out.append(TABLE)
        elif copies[s] >= FILLER and len(s) > 8 and k < FAMILIAR * words or words > 1 and k < READABLE * words or few:
            out.append(JUNK)
        elif leader and _LEADER.search(s):
            out.append(LIST)
        else:
            out.append(LIST if list_evidence(i, bare, toks, out, short[i], filled, rhythm, running) >= ITEM else PROSE)
    return out


_FIGURES = ["lines", "characters", "letters", "spaces", "symbols", "replaced", "words", "word_letters", "single", "common", "ended", *CLASSES]


def figures(texts: list[str], common: frozenset[str]) -> list[int]:
    tokens = line_words(texts)
    known = [len([w for w in x if w in common]) for x in tokens]
    readable, some = common, known
    if sum(map(len, tokens)) - sum(known) >= OWN_LINES * OWN_WORDS and (own := own_words(tokens, common)):
        readable = common | own
        some = [len([w for w in x if w in readable]) for x in tokens]
    kind, at = character_kinds(texts)
    of = np.bincount(kind, minlength=7).tolist()
    words = [w for t in tokens for w in t]
    classes = Counter(classify_lines(texts, tokens, readable, np.add.reduceat(kind == ODD, at[:-1], dtype=np.int64), some))
    return [
        len(texts), len(kind) - 1, of[LETTER], of[SPACE] - 1, of[SYMBOL] + of[ODD], sum(t.count("�") for t in texts), len(words), sum(map(len, words)),
        len([w for w in words if len(w) == 1]), sum(known), sum(t.rstrip()[-1:] in _END for t in texts), *(classes[k] for k in CLASSES),
    ]


def document_figures(lines: DataFrame) -> DataFrame:
    """(document_id, *_FIGURES): counts over each document's running text, running heads, feet and notes
    aside. They are taken by chunk and added up, so no document is ever in one task."""
    shared = lines.sparkSession.sparkContext.broadcast(common_words(lines))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, roles = shared.value, Roles()
        for b in batches:
            rows = []
            for heads, (did, page, _, texts, ahead) in zip(heads_of(b), groups(b)):
                role = roles.of(did, page, texts, heads)
                body = [t for t, r, a in zip(texts, role, ahead) if r == BODY and not a and t.strip()]
                rows.append((did, *(figures(body, common) if body else [0] * len(_FIGURES))))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)] if rows else [pa.array([], pa.string())] + [pa.array([], pa.int64())] * len(_FIGURES), ["document_id", *_FIGURES])

    ddl = "document_id string, " + ", ".join(f"{c} bigint" for c in _FIGURES)
    parts = doc_chunks(lines, heads=series(lines)).select("document_id", "lines").mapInArrow(run, ddl)
    return parts.groupBy("document_id").agg(*[F.sum(c).alias(c) for c in _FIGURES])


def assess(lines: DataFrame) -> DataFrame:
    """(document_id, signals, text_class, classification, score): the signals of ``quality_assessments``,
    the class most lines have, and a verdict from both.

    The score is the share of prose lines, less what symbols, single letters and replacement characters
    take off. ``good`` from 0.8, ``questionable`` from 0.55, else ``bad``. A document without running text
    has null ratios, class null, score 0 and the verdict bad.
    """
    f = document_figures(lines)
    ratio = lambda a, b, k: F.round(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), k)
    signals = F.struct(
        "characters", F.col("words").alias("word_count"), ratio("word_letters", "words", 3).alias("mean_word_length"), ratio("single", "words", 4).alias("single_char_rate"),
        F.round(F.try_divide(F.col("letters").cast("double"), (F.col("characters") - F.col("spaces")).cast("double")), 4).alias("alpha_ratio"),
        F.round(F.try_divide(F.col("symbols").cast("double"), (F.col("characters") - F.col("spaces")).cast("double")), 4).alias("symbol_ratio"),
        ratio("common", "words", 4).alias("common_word_rate"), F.col("replaced").alias("replacement_char_count"), ratio("ended", "lines", 4).alias("ended_line_rate"),
    )
    most = F.greatest(*CLASSES)
    named = F.when(F.col("lines") == 0, None)
    for k in (JUNK, TABLE, LIST):
        named = named.when((F.col(k) == most) & (F.col(PROSE) < F.col(LIST) + F.col(TABLE) + F.col(JUNK)), k)
    f = f.withColumn("signals", signals).withColumn("text_class", named.otherwise(PROSE))
    penalty = 2 * F.coalesce("signals.symbol_ratio", F.lit(0.0)) + F.coalesce("signals.single_char_rate", F.lit(0.0)) / 2
    f = f.withColumn("score", F.round(F.greatest(F.lit(0.0), F.coalesce(F.try_divide(F.col(PROSE).cast("double"), F.col("lines").cast("double")), F.lit(0.0)) - penalty), 4))
    verdict = F.when(F.col("score") >= 0.8, "good").when(F.col("score") >= 0.55, "questionable").otherwise("bad")
    return f.select("document_id", "signals", "text_class", verdict.alias("classification"), "score")


def found(lines: DataFrame) -> DataFrame:
    """(document_id, text_class) of the documents that are mostly not sentences."""
    return assess(lines).where(F.col("text_class") != PROSE).select("document_id", "text_class")
