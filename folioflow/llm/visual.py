"""Problem 9: one consistent form for texts that look the same, by table lookups over code-point arrays."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import cut

# Letters and marks of other scripts or blocks that fonts draw like the plain one beside them.
LOOK_ALIKES = {
    "А": "A", "В": "B", "Е": "E", "З": "3", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "Ѕ": "S", "І": "I", "Ї": "Ï", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Һ": "h", "Ӏ": "I",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ї": "ï", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ѵ": "v",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "ρ": "p", "ι": "ı",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "Օ": "O", "Տ": "S", "Լ": "L",
    "ɡ": "g", "ɑ": "a", "ı": "ı", "‐": "-", "‑": "-", "⁄": "/", "∕": "/", "՚": "'", "ʼ": "'", "։": ":", "ː": ":", "∶": ":", "․": ".", "‚": ",",
}
# The kinds of compatibility mapping whose two sides look alike, as the character database names them.
ALIKE_KINDS = ("", "<wide>", "<narrow>", "<noBreak>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>")
# Characters without a shape that are not of the category for format characters.
SHAPELESS = [0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]
TOP = 0x110000


def _form_of(ch: str) -> str:
    """What one character becomes: decomposed, its look-alikes replaced; nothing if it has no shape."""
    kind = unicodedata.category(ch)
    if kind == "Cf" or ord(ch) in _NO_SHAPE:
        return ""
    if kind == "Zs":
        return " "
    split = unicodedata.decomposition(ch)
    tag = split.split(" ", 1)[0] if split.startswith("<") else ""
    if tag not in ALIKE_KINDS:
        return ch
    if not split and not 0xAC00 <= ord(ch) < 0xD7A4:
        return LOOK_ALIKES.get(ch, ch)
    whole = unicodedata.normalize("NFKD" if tag else "NFD", ch)
    return "".join(LOOK_ALIKES.get(c, c) for c in whole if unicodedata.category(c) != "Cf")


_NO_SHAPE = frozenset(SHAPELESS)


def mapped() -> Iterator[int]:
    """The code points any table looks at: all but surrogates, private use and the unmapped ideographs."""
    for a, b in ((0, 0x3400), (0xA000, 0xD800), (0xF900, 0x12000), (0x16000, 0x17000), (0x1D000, 0x20000), (0x2F800, 0x2FA20), (0xE0000, 0xE01F0)):
        yield from range(a, b)


class Table:
    """Expansion of each code point: ``size`` code points of ``pool`` from ``first`` on."""

    def __init__(self, of) -> None:  # noqa: ANN001
        self.size = np.ones(TOP, np.uint8)
        self.single = np.arange(TOP, dtype=np.uint32)
        self.first = np.zeros(TOP, np.int32)
        pool: list[int] = []
        for c in mapped():
            ch = chr(c)
            to = of(ch)
            if to == ch:
                continue
            self.size[c] = len(to)
            if len(to) == 1:
                self.single[c] = ord(to)
            elif to:
                self.first[c] = len(pool)
                pool += map(ord, to)
        self.pool = np.array(pool or [0], np.uint32)

    def apply(self, cps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code points, index of the one each came from)."""
        size = self.size[cps]
        if size.min(initial=1) == 1 == size.max(initial=1):
            return self.single[cps], None
        src = np.repeat(np.arange(len(cps)), size)
        out = self.single[cps][src]
        many = size > 1
        if many.any():
            at = np.cumsum(size, dtype=np.int64) - size
            for k in range(int(size.max())):
                hit = np.flatnonzero(size > max(k, 1))
                out[at[hit] + k] = self.pool[self.first[cps[hit]] + k]
        return out, src


@lru_cache(1)
def tables() -> tuple[Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Expansions; combining classes; and the canonical pairs as sorted keys, their composites, and the
    flags of characters that can be the second of a pair."""
    form = Table(_form_of)
    rank = np.zeros(TOP, np.uint8)
    second = np.zeros(TOP, bool)
    pairs = {}
    for c in mapped():
        ch = chr(c)
        if 0xAC00 <= c < 0xD7A4:  # syllables follow a rule
            k, tail = divmod(c - 0xAC00, 28)
            a, b = (c - tail, 0x11A7 + tail) if tail else (0x1100 + k // 21, 0x1161 + k % 21)
            pairs[a << 21 | b] = c
            second[b] = True
            continue
        if r := unicodedata.combining(ch):
            rank[c] = r
        d = unicodedata.decomposition(ch)
        if d and d[0] != "<" and " " in d and unicodedata.normalize("NFC", ch) == ch:
            a, b = (int(x, 16) for x in d.split())
            pairs[a << 21 | b] = c
            second[b] = True
    keys = np.array(sorted(pairs), np.int64)
    return form, rank, keys, np.array([pairs[k] for k in keys.tolist()], np.uint32), second


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one code-point array, and the offsets of each; a null counts as empty."""
    texts = texts.cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    cps = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return cps, lead[at - at[0]]


def to_arrow(cps: np.ndarray, at: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    width = 1 + (cps >= 0x80).astype(np.int64) + (cps >= 0x800) + (cps >= 0x10000)
    ends = np.concatenate([[0], np.cumsum(width)])[at]
    data = cps.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    mask = None if valid is None or valid.all() else pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [mask, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data)])


def moved(at: np.ndarray, src: np.ndarray | None) -> np.ndarray:
    """Text offsets after an expansion or a selection, given the source index of each code point."""
    return at if src is None else np.searchsorted(src, at)


def compose(cps: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put runs of marks in canonical order, then join each mark with the letter right before it where the
    pair has a composite."""
    _, rank, keys, composite, second = tables()
    if not len(cps) or cps.max() < 0x300:
        return cps, at
    first = np.zeros(len(cps) + 1, bool)
    first[at] = True
    order = rank[cps]
    while len(bad := np.flatnonzero((order[1:] > 0) & (order[:-1] > order[1:]) & ~first[1:-1])):
        bad = bad[np.concatenate([[True], np.diff(bad) > 1])]
        for x in (cps, order):
            x[bad], x[bad + 1] = x[bad + 1].copy(), x[bad].copy()
    while len(i := np.flatnonzero(second[cps[1:]] & ~first[1:-1])):
        key = cps[i].astype(np.int64) << 21 | cps[i + 1]
        k = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[k] == key
        i, k = i[hit], k[hit]
        if not len(i):
            break
        own = np.concatenate([[True], np.diff(i) > 1])
        i, k = i[own], k[own]
        cps[i] = composite[k]
        keep = np.ones(len(cps), bool)
        keep[i + 1] = False
        src = np.flatnonzero(keep)
        at = np.searchsorted(src, at)
        cps = cps[keep]
        first = np.zeros(len(cps) + 1, bool)
        first[at] = True
    return cps, at


def visual_form(texts: pa.Array) -> pa.Array:
    """One form of each text: without characters that have no shape, every space a plain one, full-width
    forms, ligatures and look-alike letters as the plain letters, marks in order and composed. Case,
    accents, digits, words and line breaks stay. Null stays null, an empty text empty."""
    valid = np.asarray(texts.is_valid())
    cps, at = code_points(texts)
    out, src = tables()[0].apply(cps)
    out, at = compose(out, moved(at, src))
    return to_arrow(out, at, valid)


def normalise(df: DataFrame, column: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, text): the visual form of each text."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), visual_form(b.column(1)).cast(pa.string())], ["key", "text"])

    return df.select(F.col(key).alias("key"), F.col(column).alias("text")).mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def look_alike_pairs(documents: DataFrame) -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: documents whose texts have one form but are not stored alike.

    Texts are compared by SHA-256. Only forms with two stored texts or more go on; the distinct stored
    texts of a form are paired first and the documents of each then joined, so copies of one text, were
    they a third of all rows, are never held against each other. Null texts are left out.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), visual_form(b.column(1)).cast(pa.string())], ["doc_id", "text", "form"])

    texts = documents.where("text is not null").select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, text string, form string")
    rows = texts.select("doc_id", F.unhex(F.sha2("form", 256)).alias("form"), F.unhex(F.sha2("text", 256)).alias("stored"))
    rows = cut(rows)
    mixed = rows.groupBy("form").agg(F.min("stored").alias("lo"), F.max("stored").alias("hi")).where("lo <> hi").select("form")
    rows = rows.join(mixed, "form", "left_semi")
    kinds = rows.select("form", "stored").distinct()
    pairs = kinds.select("form", F.col("stored").alias("stored_a")).join(kinds.select("form", F.col("stored").alias("stored_b")), "form").where("stored_a < stored_b")
    a = rows.select("form", F.col("stored").alias("stored_a"), F.col("doc_id").alias("x"))
    b = rows.select("form", F.col("stored").alias("stored_b"), F.col("doc_id").alias("y"))
    found = pairs.join(a, ["form", "stored_a"]).join(b, ["form", "stored_b"])
    return found.where("x <> y").select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b")).distinct()
