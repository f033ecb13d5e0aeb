"""Roles of page lines: running heads and feet, page numbers, footnotes, running text."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.lines import BLOCK_LINES, CHUNK_PAGES
from folioflow.session import stage

BODY, FURNITURE, FOOTNOTE = 0, 1, 2

#: Lines at either end of a page that may be furniture.
EDGE = 2
#: A running head or foot is no longer than this.
MOST_CHARS = 120
#: A series is the furniture of at least so many documents.
SERIES_DOCUMENTS = 3
#: Pages a document on which a series stands, on average; a line of copied text stands on one.
SERIES_PAGES = 1.3

# What a scanner reads for a letter or pair of letters, as (true, read).
CONFUSIONS = [
    ("e", "c"), ("t", "f"), ("a", "o"), ("i", "1"), ("s", "5"), ("o", "0"), ("l", "1"), ("g", "q"), ("h", "b"), ("i", "l"), ("l", "i"), ("i", "|"), ("l", "|"), ("b", "8"), ("g", "9"), ("z", "2"), ("y", "v"), ("c", "e"),
    ("d", "cl"), ("u", "ii"), ("m", "rn"), ("w", "vv"), ("h", "li"), ("n", "ri"), ("k", "lc"), ("u", "li"),
    ("in", "m"), ("rn", "m"), ("cl", "d"), ("li", "h"), ("ni", "m"), ("ri", "n"), ("ii", "u"), ("vv", "w"),
]

_LETTERS = re.compile(r"[^\W\d_]+")
_WORDS = re.compile(r"[^\W_|]+(?:\|[^\W_]*)*")
_DIGITLIKE = re.compile(r"[0-9loisb|]+\Z")
_PAGE_NUMBER = re.compile(r"(?:page\s+)?[\[({\-–—.\s]*(?:[0-9loOIisSBb|]{1,5}|[ivxlcm]{1,8}|[IVXLCM]{1,8})[\])}\-–—.\s]*(?:\s*(?:of|/)\s*[0-9loOIiSBb|]{1,5})?\Z", re.I)
_NUMERAL = re.compile(r"[loI|]{1,3}\Z|(?=[ivxlcm])m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})\Z", re.I)
_PAIRS = str.maketrans({"0": "a", "o": "a", "1": "i", "l": "i", "|": "i", "5": "s", "c": "e", "f": "t", "q": "g", "9": "g", "b": "h", "8": "h", "u": "h", "v": "y", "2": "z"})
# How an amendment note opens after its number.
_NOTE = re.compile(r"\s*(?:[\[(]?[0-9lIO]{1,3}[\])]?[.)]?|[*†‡])\s+(?:subs|ins|om|omitted|rep|repealed|added|inserted|substituted|see|vide|the\s+w\S{0,3}rds?|w\.\s?e\.\s?f|cf|ibid|renumbered|amended)\b", re.I)
_NOTE_NUMBER = re.compile(r"\s*(?:[0-9]{1,3}[.)]|[*†‡])\s+\S")


def fold(text: str) -> str:
    """A key that a line keeps through misreading and numbering: numbers dropped, letters that scanners
    confuse made one, punctuation dropped."""
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
    words = _WORDS.findall(text.lower())
    out = []
    for w in words:
        if _DIGITLIKE.match(w) and (len(w) <= 3 or any(c.isdigit() for c in w)) or w in ("i", "ii", "iii", "iv", "v", "vi"):
            continue
        out.append(w)
    w = " ".join(out).translate(_PAIRS)
    for read, one in (("in", "m"), ("rn", "m"), ("ei", "d"), ("ii", "h"), ("yy", "w"), ("ri", "n")):
        w = w.replace(read, one)
    return w


def is_page_number(text: str) -> bool:
    t = text.strip()
    if not t or len(t) > 24 or not _PAGE_NUMBER.match(t):
        return False
    core = re.sub(r"(?i)^page\s+|[\[\](){}\-–—.\s]", "", t)
    return bool(core) and (any(c.isdigit() for c in core) or bool(_NUMERAL.match(core)))


def looks_like_head(text: str) -> bool:
    """Short, mostly letters, at least two words: what a running head or foot is made of."""
    t = text.strip()
    if len(t) > MOST_CHARS:
        return False
    words = _LETTERS.findall(t)
    return len(words) > 1 and len("".join(words)) >= 0.6 * len(t.replace(" ", "")) and sum(len(w) > 2 for w in words) > 1


def slug_key(document_id: str) -> frozenset[str]:
    """Folded words of the title that a document id opens with."""
    return frozenset(fold(document_id.split("__")[0].replace("-", " ")).split()) - {"the"}


def page_ends(lines: DataFrame) -> DataFrame:
    """(document_id, page_number, block, text): the first two and the last two lines of each page that are not
    page numbers, by the page line index, in one aggregation that Spark starts before the shuffle."""
    plain = ~F.col("text").rlike(r"^[\s\[({\-]*(?i:page\s+)?[0-9loOIi|]{1,5}[\s\])}\-]*((?i:of)\s*[0-9loOIi|]{1,5})?$")
    rows = lines.where(plain & F.col("document_id").isNotNull() & (F.length("text") <= MOST_CHARS)).select("document_id", "page_number", F.coalesce("page_line_index", F.lit(0)).alias("at"), "text")
    line = F.struct((F.col("at") / BLOCK_LINES).cast("int").alias("block"), "text")
    ends = rows.groupBy("document_id", "page_number").agg(F.array_compact(F.array(F.min_by(line, "at"), F.max_by(line, "at"), F.max(F.when(F.col("at") == 1, line)))).alias("ends"))
    return ends.select("document_id", "page_number", F.explode(F.array_distinct("ends")).alias("x")).select("document_id", "page_number", "x.block", "x.text")


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = [fold(t) if looks_like_head(t) else None for t in b.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(keys, pa.string())], ["document_id", "page_number", "block", "key"])


def series(lines: DataFrame) -> DataFrame:
    """(document_id, chunk, block, key): folded heads and feet of whole series of documents, by the chunk
    (``lines.doc_chunks``) in which they stand: page ends that recur over SERIES_DOCUMENTS documents and, within
    them, over pages. Nothing comes to the driver; each chunk gets its own heads with its lines."""
    ends = page_ends(lines.where("page_number > 1")).mapInArrow(_folded, "document_id string, page_number int, block int, key string").where("key is not null and key <> ''")
    chunk = F.floor(F.col("page_number") / CHUNK_PAGES).cast("int")
    per = stage(ends.groupBy("key", "document_id", chunk.alias("chunk"), "block").agg(F.countDistinct("page_number").alias("pages")), "page-ends")
    docs = per.groupBy("key", "document_id").agg(F.sum("pages").alias("pages")).groupBy("key").agg(F.count("*").alias("docs"), F.sum("pages").alias("pages"))
    kept = docs.where((F.col("docs") >= SERIES_DOCUMENTS) & (F.col("pages") >= SERIES_PAGES * F.col("docs"))).select("key")
    return per.join(kept, "key", "left_semi").select("document_id", "chunk", "block", "key")


class Roles:
    """Tells the role of each line of a chunk."""

    def __init__(self) -> None:
        self.keys: dict[str, str] = {}

    def key(self, text: str) -> str:
        k = self.keys.get(text)
        if k is None:
            if len(self.keys) > 200_000:
                self.keys.clear()
            k = self.keys[text] = fold(text) if looks_like_head(text) else ""
        return k

    def of(self, document_id: str, pages: list[int], texts: list[str], heads: Collection[str] = ()) -> list[int]:
        """Roles of lines that are given in order, with the page each is on. ``heads`` are the folded heads of
        series that the chunk holds."""
        role = [BODY] * len(texts)
        spans, start = [], 0
        for i in range(1, len(texts) + 1):
            if i == len(texts) or pages[i] != pages[start]:
                spans.append((start, i))
                start = i
        edge: list[tuple[int, bool, str]] = []
        on = defaultdict(set)
        number = set()
        for s, e in spans:
            live = [i for i in range(s, e) if texts[i].strip()]
            top, bottom = live[: EDGE + 1], live[-EDGE - 1 :]
            for i in (*top[:EDGE], *bottom[-EDGE:]):
                if is_page_number(texts[i]):
                    role[i] = FURNITURE
                    number.add(i)
            top, bottom = [i for i in top if i not in number][:EDGE], [i for i in bottom if i not in number][-EDGE:]
            for side, at in ((True, top), (False, bottom)):
                for i in at:
                    k = self.key(texts[i])
                    if k:
                        edge.append((i, side, k))
                        on[side, k].add(pages[i])
        if not edge:
            return self._notes(spans, texts, role)
        edges = {i for i, _, _ in edge}
        again = {k for (_, k), p in on.items() if len(p) > 1}
        if again:
            sizes = [len(texts[i]) for i, _, k in edge if k in again]
            least, most = min(sizes) - 6, max(sizes) + 6  # a reading keeps a line's length, but for a few characters
            inside = Counter(self.key(t) for i, t in enumerate(texts) if least <= len(t) <= most and i not in edges)
            again = {k for k in again if inside[k] == 0}
        title = slug_key(document_id)
        for i, side, k in edge:
            words = set(k.split()) - {"the"}
            titled = len(words) >= 2 and len(words & title) >= 0.8 * len(words) and len(words & title) >= 0.5 * len(title)
            if pages[i] <= 1 and side and titled and not re.search(r"^\s*\d+\s{2,}|\s{2,}\d+\s*$", texts[i]):
                continue  # the title itself
            if k in heads or titled and side or k in again and len(on[side, k]) > 1:
                role[i] = FURNITURE
        return self._notes(spans, texts, role)

    @staticmethod
    def _notes(spans: list[tuple[int, int]], texts: list[str], role: list[int]) -> list[int]:
        """Footnotes: from the first amendment note in the lower part of a page down to its foot."""
        for s, e in spans:
            live = [i for i in range(s, e) if role[i] == BODY and texts[i].strip()]
            first = None
            for i in reversed(live):
                if _NOTE.match(texts[i]):
                    first = i
                elif first is not None and i < first - 6:
                    break
            if first is not None:
                for i in live:
                    if i >= first:
                        role[i] = FOOTNOTE
        return role
