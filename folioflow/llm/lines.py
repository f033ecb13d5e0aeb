"""Page lines without their redeliveries, grouped so that no group is unbounded."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines of a page that one group holds at most; longer pages go on in further blocks.
BLOCK_LINES = 4096


def page_blocks(lines: DataFrame, carry: int = 0, keep: list[str] | None = None) -> DataFrame:
    """(document_id, page_number, block, lines): each ``stream_index`` once, in order.

    A redelivered line has the same text, so the set of (stream_index, text) drops it, before the shuffle
    already where both copies meet. Block k holds the page's lines k * BLOCK_LINES onwards; with ``carry``
    the last so many lines of a block also open the next one, marked by a negative ``page_line_index``.
    Null text counts as empty, a null page line index as 0. Rows without a document id or stream index are
    dropped. Extra columns are ignored.
    """
    at = F.coalesce("page_line_index", F.lit(0))
    item = F.struct("stream_index", at.alias("at"), F.coalesce("text", F.lit("")).alias("text"), *(keep or []))
    rows = lines.where("document_id is not null and stream_index is not null").select("document_id", "page_number", at.cast("int").alias("at"), item.alias("line"))
    block = (F.col("at") / BLOCK_LINES).cast("int")
    own = F.struct(block.alias("block"), F.col("line").alias("line"))
    if carry:
        next_ = F.struct((block + 1).alias("block"), F.col("line").withField("at", F.lit(-1)).alias("line"))
        last = F.pmod("at", F.lit(BLOCK_LINES)) >= BLOCK_LINES - carry
        rows = rows.select("document_id", "page_number", F.explode(F.when(last, F.array(own, next_)).otherwise(F.array(own))).alias("x")).select("document_id", "page_number", "x.*")
    else:
        rows = rows.select("document_id", "page_number", block.alias("block"), "line")
    return rows.groupBy("document_id", "page_number", "block").agg(F.array_sort(F.collect_set("line")).alias("lines"))


def joined(lines: Column) -> Column:
    return F.array_join(F.transform(lines, lambda x: x["text"]), "\n")


#: Pages of a document that one group holds at most; longer documents go on in further chunks.
CHUNK_PAGES = 64


def groups(batch: pa.RecordBatch) -> Iterator[tuple[str, list[int], list[int], list[str], list[bool]]]:
    """Of a batch of (document_id, lines): id, pages, stream indexes, texts and ahead flags of each group. Heads
    that ``doc_chunks`` put before the lines are left out (``heads_of``)."""
    lists = batch.column(1)
    at = lists.offsets.to_pylist()
    line = lists.values
    page, index, text, ahead = (line.field(k).to_pylist() for k in ("page", "stream_index", "text", "ahead"))
    for did, a, b in zip(batch.column(0).to_pylist(), at, at[1:]):
        while a < b and page[a] == HEADS:
            a += 1
        yield did, page[a:b], index[a:b], text[a:b], ahead[a:b]


#: The page number under which a group's heads stand before its lines.
HEADS = -(1 << 31)


def heads_of(batch: pa.RecordBatch) -> Iterator[list[str]]:
    """Of a batch of (document_id, lines): the heads that came with each group."""
    lists = batch.column(1)
    at = lists.offsets.to_pylist()
    page, text = (lists.values.field(k).to_pylist() for k in ("page", "text"))
    for a, b in zip(at, at[1:]):
        end = a
        while end < b and page[end] == HEADS:
            end += 1
        yield text[a:end]


def doc_chunks(lines: DataFrame, back: bool = False, heads: DataFrame | None = None) -> DataFrame:
    """(document_id, chunk, block, lines): a document's lines in order, CHUNK_PAGES pages and BLOCK_LINES
    lines of a page at most to a group, so that a document with a third of all rows is many groups.

    The first page of a chunk also closes the one before, marked ``ahead``: what runs on over the chunk's
    end can be seen there. With ``back`` the last page of a chunk also opens the next, marked the same way. Redeliveries are dropped as in ``page_blocks``; a null page number counts as 0.

    ``heads`` (document_id, chunk, key) are put before the lines of each group they belong to, so that what is
    known of a chunk's heads comes with it and nothing is broadcast.
    """
    page, at = F.coalesce("page_number", F.lit(0)), F.coalesce("page_line_index", F.lit(0))
    line = lambda ahead: F.struct(page.alias("page"), "stream_index", at.alias("at"), F.coalesce("text", F.lit("")).alias("text"), F.lit(ahead).alias("ahead"))
    chunk = F.floor(page / CHUNK_PAGES).cast("int")
    own = F.struct(chunk.alias("chunk"), line(False).alias("line"))
    before = F.struct((chunk - 1).alias("chunk"), line(True).alias("line"))
    after = F.struct((chunk + 1).alias("chunk"), line(True).alias("line"))
    first = (F.pmod(page, F.lit(CHUNK_PAGES)) == 0) & (page > 0)
    ends = F.when(first, F.array(own, before))
    if back:
        ends = ends.when(F.pmod(page, F.lit(CHUNK_PAGES)) == CHUNK_PAGES - 1, F.array(own, after))
    rows = lines.where("document_id is not null and stream_index is not null").select("document_id", (at / BLOCK_LINES).cast("int").alias("block"), F.explode(ends.otherwise(F.array(own))).alias("x"))
    rows = rows.select("document_id", F.col("x.chunk").alias("chunk"), "block", "x.line")
    if heads is not None:
        none = F.lit(-1)
        known = F.struct(F.lit(HEADS).alias("page"), none.alias("stream_index"), none.alias("at"), F.coalesce("key", F.lit("")).alias("text"), F.lit(False).alias("ahead"))
        rows = rows.unionByName(heads.select("document_id", "chunk", "block", known.alias("line")))
    return rows.groupBy("document_id", "chunk", "block").agg(F.array_sort(F.collect_set("line")).alias("lines")).where(F.element_at("lines", -1)["page"] != HEADS)
