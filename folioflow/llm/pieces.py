"""Problem 2: oversized items cut at natural boundaries, by agglomerative merging."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.lines import BLOCK_LINES, page_blocks
from folioflow.session import cut

LIMIT, OVERLAP = 2000, 200

#: An atom ends after a line end, after a sentence end with its space, or at the end of the text.
_ATOM = re.compile(r"[^\n]*?(?:[.!?।;:][\"'”’)\]]*\s+|\n+)|[^\n]+\Z|[^\n]+(?=\n)", re.S)
_WORD = re.compile(r"\s*\S+\s*")
_SENTENCE_END = re.compile(r"[.!?।][\"'”’)\]]*\s*\Z")


def atoms(text: str, most: int) -> list[tuple[int, int]]:
    """Spans that tile ``text``: lines and sentences, those longer than ``most`` cut into words, words
    longer than that into stretches of ``most`` characters."""
    out, at = [], 0
    for m in _ATOM.finditer(text):
        if m.end() > at:
            out.append((at, m.end()))
            at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    fine = []
    for s, e in out:
        if e - s <= most:
            fine.append((s, e))
            continue
        p = s
        for m in _WORD.finditer(text, s, e):
            q = m.end()
            while q - p > most:
                fine.append((p, p + most))
                p += most
            if q > p:
                fine.append((p, q))
            p = q
        while p < e:
            fine.append((p, min(e, p + most)))
            p = fine[-1][1]
    return fine


def strength(text: str, at: int) -> int:
    """Of a boundary: 0 inside a word, 1 between words, 2 between lines, 3 between sentences, 4 between
    sentences at a line end, 5 at a blank line."""
    head = text[max(0, at - 8) : at]
    if not head[-1:].isspace() and not text[at : at + 1].isspace():
        return 0
    line, sentence = "\n" in head[len(head.rstrip()) :], _SENTENCE_END.search(head) is not None
    return 5 if line and head.endswith("\n\n") else 4 if line and sentence else 3 if sentence else 2 if line else 1


def overlap_start(text: str, at: int, overlap: int) -> int:
    """Where the repeated end of the piece before ``at`` begins: ``overlap`` characters back, or a little
    less to begin at a word; exactly there if no word begins in that stretch."""
    lo = max(0, at - overlap)
    if lo == 0 or text[lo - 1].isspace():
        return lo
    m = re.compile(r"\s(?=\S)").search(text, lo, at)
    return m.end() if m and m.end() < at else lo


def cut_points(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(overlap start, start, end) of consecutive pieces whose start..end tile ``text``.

    Atoms are neighbours in a list; a heap holds each adjacent pair by the strength of the boundary
    between them, then by joint size, then by place. The weakest boundary goes first, as long as the joint
    size and the overlap fit the limit. A text within the limit is one piece; an empty one has none.
    """
    if len(text) <= limit:
        return [(0, 0, len(text))] if text else []
    room = limit - overlap
    spans = atoms(text, room)
    n = len(spans)
    start, end = [s for s, _ in spans], [e for _, e in spans]
    nxt, prv, live, version = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n, [0] * n
    weight = [strength(text, e) for e in end]
    heap = [(weight[i], end[i + 1] - start[i], i, 0, 0) for i in range(n - 1)]
    heapq.heapify(heap)
    while heap:
        _, size, i, vi, vj = heapq.heappop(heap)
        j = nxt[i]
        if not live[i] or j >= n or version[i] != vi or version[j] != vj:
            continue
        if size > room and not (start[i] == 0 and size <= limit):
            continue
        end[i], live[j], nxt[i], weight[i] = end[j], False, nxt[j], weight[j]
        version[i] += 1
        if nxt[j] < n:
            prv[nxt[j]] = i
            heapq.heappush(heap, (weight[i], end[nxt[j]] - start[i], i, version[i], version[nxt[j]]))
        if prv[i] >= 0:
            heapq.heappush(heap, (weight[prv[i]], end[i] - start[prv[i]], prv[i], version[prv[i]], version[i]))
    out = []
    for i in range(n):
        if live[i]:
            out.append((overlap_start(text, start[i], overlap) if start[i] else 0, start[i], end[i]))
    return out


_PIECES = "document_id string, page_number int, block int, piece int, char_start int, overlap int, text string"


def _cut(limit: int, overlap: int):
    schema = pa.schema([("document_id", pa.string()), ("page_number", pa.int32()), ("block", pa.int32()), ("piece", pa.int32()), ("char_start", pa.int32()), ("overlap", pa.int32()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for did, page, block, carried, body in zip(*(c.to_pylist() for c in b.columns)):
                text, base = carried + body, len(carried)
                if block and base:
                    spans = [(overlap_start(text, base + s, overlap), base + s, base + e) for _, s, e in cut_points(body, limit - overlap, overlap)] if len(body) + overlap > limit else [(overlap_start(text, base, overlap), base, len(text))]
                else:
                    spans = cut_points(text, limit, overlap)
                rows += [(did, page, block, k, s - base, s - o, text[o:e]) for k, (o, s, e) in enumerate(spans)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)] if rows else [pa.array([], t) for t in schema.types], schema=schema)

    return run


#: Long pages up to which their names are broadcast to choose their lines; beyond, the choice is a join.
BROADCAST_PAGES = 200_000


def long_pages(lines: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(document_id, page_number) of the pages that make more than ``limit`` characters, from the lengths of
    their lines alone: no text is shuffled. Lengths are added up by block first, so a page of any size is
    many tasks' work."""
    at = F.coalesce("page_line_index", F.lit(0))
    rows = lines.where("document_id is not null and stream_index is not null").select("document_id", "page_number", (at / BLOCK_LINES).cast("int").alias("block"), F.struct("stream_index", F.length(F.coalesce("text", F.lit(""))).alias("n")).alias("line"))
    blocks = rows.groupBy("document_id", "page_number", "block").agg(F.collect_set("line").alias("l")).select("document_id", "page_number", F.size("l").alias("k"), F.aggregate("l", F.lit(0).cast("bigint"), lambda s, x: s + x["n"]).alias("n"))
    return blocks.groupBy("document_id", "page_number").agg((F.sum("n") + F.sum("k") - 1).alias("size")).where(F.col("size") > limit).select("document_id", "page_number")


def page_pieces(lines: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, cut_only: bool = False) -> DataFrame:
    """(document_id, page_number, block, piece, char_start, overlap, text): every page of ``page_lines`` in
    pieces of at most ``limit`` characters, each but a page's first opening with the ``overlap`` characters
    before it.

    Only longer pages go through Python; a page within the limit is its own single piece, made by Spark.
    ``cut_only`` leaves those out. A page of over BLOCK_LINES lines is cut block by block, each block but
    the first with the lines before it for the overlap; ``piece`` and ``char_start`` count within the block.
    """
    if overlap * 2 > limit:
        raise ValueError("the overlap may be half the limit at most")
    groups = page_blocks(lines, carry=overlap + 1)
    text = lambda carried: F.array_join(F.transform(F.filter("lines", lambda x: (x["at"] < 0) == F.lit(carried)), lambda x: x["text"]), "\n")
    pages = groups.select("document_id", "page_number", "block", text(True).alias("carried"), text(False).alias("body"))
    pages = pages.withColumn("carried", F.when(F.col("carried") == "", "").otherwise(F.concat("carried", F.lit("\n"))))
    long = F.length("body") > limit
    oversized = pages.where(long | (F.col("block") > 0)).mapInArrow(_cut(limit, overlap), _PIECES)
    if cut_only:
        return oversized
    whole = pages.where(~long & (F.col("block") == 0) & (F.col("body") != "")).select("document_id", "page_number", "block", F.lit(0).alias("piece"), F.lit(0).alias("char_start"), F.lit(0).alias("overlap"), F.col("body").alias("text"))
    return whole.unionByName(oversized)


def found(lines: DataFrame) -> DataFrame:
    """(document_id, page_number) of the pages that came out in more than one piece. Pages that are too short
    to be cut are told by the lengths of their lines (``long_pages``); only the others' texts move."""
    names = cut(long_pages(lines).where("page_number is not null"))
    few = names.count() <= BROADCAST_PAGES
    chosen = lines.join(F.broadcast(names) if few else names, ["document_id", "page_number"], "left_semi")
    pieces = page_pieces(chosen, cut_only=True)
    return pieces.where((F.col("piece") == 1) | (F.col("block") > 0)).select("document_id", "page_number").distinct()
