"""Line streams: order, offsets, page maps and keys, all as window functions over a document's lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import text as T


def deduplicated(lines: DataFrame) -> DataFrame:
    """(document_id, page_number, stream_index, page_line_index, text) with redeliveries dropped. Rows
    without a document or place are dropped; a null text is empty."""
    return (
        lines.where("document_id is not null and stream_index is not null")
        .groupBy("document_id", "stream_index")
        .agg(F.min("page_number").alias("page_number"), F.min("page_line_index").alias("page_line_index"), F.coalesce(F.min("text"), F.lit("")).alias("text"))
    )


def from_texts(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_no, line): the lines of each text from 0; a null text has none."""
    return documents.select(key, F.posexplode(T.split_lines(F.col(text))).alias("line_no", "line"))


def without_labelled(lines: DataFrame, labels: DataFrame, index: str = "line_index") -> DataFrame:
    """Lines that no label (document, page, line of the page) claims. The text itself is never changed."""
    keys = labels.select("document_id", "page_number", F.col(index).alias("page_line_index")).distinct()
    return lines.join(keys, ["document_id", "page_number", "page_line_index"], "left_anti")


#: Places of a document's order that one task adds up.
BUCKET = 4096


def running_total(rows: DataFrame, key: str, order: str, value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same key that come before in order.

    Places go in buckets of BUCKET: sums run within a bucket, and what the buckets before hold is added from
    a table of one row a bucket. A document with a third of all lines is thus many tasks' work.
    """
    at = F.floor(F.col(order) / BUCKET)
    w = Window.partitionBy(key, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.withColumn("_bucket", at).withColumn("_value", value)
    sums = inner.groupBy(key, "_bucket").agg(F.sum("_value").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    carried = sums.select(key, "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    out = inner.withColumn("_own", F.coalesce(F.sum("_value").over(w), F.lit(0))).join(carried, [key, "_bucket"])
    return out.withColumn(name, (F.col("_own") + F.col("_before")).cast("bigint")).select(*rows.columns, name)


def carried(rows: DataFrame, key: str, order: str, values: dict[str, Column], own: bool = True, ahead: bool = False) -> DataFrame:
    """Adds each of ``values``: the last one that isn't null over the rows of the same key up to this one in
    order; with ``own`` false before this one, with ``ahead`` the first one after it instead. Places go in
    buckets as in ``running_total``, and what the buckets before hold comes from a table of one row a bucket."""
    at = F.floor(F.col(order) / BUCKET)
    sort = F.desc if ahead else F.asc
    frame = lambda w, last: w.rowsBetween(Window.unboundedPreceding, last)
    w = frame(Window.partitionBy(key, "_bucket").orderBy(sort(order)), 0 if own else -1)
    inner = rows.withColumn("_bucket", at).withColumns({f"_v{n}": c for n, c in values.items()})
    pick = F.min_by if ahead else F.max_by
    ends = inner.groupBy(key, "_bucket").agg(*[pick(f"_v{n}", F.when(F.col(f"_v{n}").isNotNull(), F.col(order))).alias(f"_v{n}") for n in values])
    v = frame(Window.partitionBy(key).orderBy(sort("_bucket")), -1)
    before = ends.select(key, "_bucket", *[F.last(f"_v{n}", True).over(v).alias(f"_b{n}") for n in values])
    out = inner.withColumns({f"_o{n}": F.last(f"_v{n}", True).over(w) for n in values}).join(before, [key, "_bucket"])
    return out.select(*rows.columns, *[F.coalesce(f"_o{n}", f"_b{n}").alias(n) for n in values])


def line_stream(lines: DataFrame) -> DataFrame:
    """Lines that aren't blank with a dense ``line_no`` in document order beside their own index."""
    live = lines.where(~T.is_blank(F.col("text")))
    return running_total(live, "document_id", "stream_index", F.lit(1), "line_no").withColumn("line_no", F.col("line_no").cast("int"))


def line_offsets(lines: DataFrame, key: str = "document_id", order: str = "stream_index", text: str = "text") -> DataFrame:
    """Adds ``char_start`` and ``char_end`` of each line in the text its document's lines make, joined by
    one newline each: half-open, in code points."""
    out = running_total(lines, key, order, F.length(text) + 1, "char_start")
    return out.withColumn("char_end", F.col("char_start") + F.length(text))


def page_map(offsets: DataFrame) -> DataFrame:
    """(document_id, page_number, char_start, char_end): ranges that tile each text. A page owns the newline
    after its last line; the last page ends with the text. Runs of one page number count as one page."""
    w = Window.partitionBy("document_id").orderBy("char_start")
    pages = offsets.groupBy("document_id", "page_number").agg(F.min("char_start").alias("char_start"), F.max("char_end").alias("last"))
    return pages.select("document_id", "page_number", "char_start", F.coalesce(F.lead("char_start").over(w), F.col("last")).alias("char_end"))


def tiling_faults(pages: DataFrame) -> DataFrame:
    """Pages of a map that leave a gap or overlap: none in a sound map."""
    w = Window.partitionBy("document_id").orderBy("char_start", "page_number")
    return pages.withColumn("before", F.coalesce(F.lag("char_end").over(w), F.lit(0))).where("char_start <> before").drop("before")


def zone_lines(lines: DataFrame, size: int = 3) -> DataFrame:
    """The first and the last ``size`` lines of each page that aren't blank, with ``zone`` header or footer;
    on a short page a line may be both."""
    live = lines.where(~T.is_blank(F.col("text")))
    w = Window.partitionBy("document_id", "page_number")
    top, bottom = F.row_number().over(w.orderBy("stream_index")), F.row_number().over(w.orderBy(F.desc("stream_index")))
    ranked = live.withColumn("top", top).withColumn("bottom", bottom)
    return ranked.select("document_id", "page_number", "stream_index", "text", F.explode(F.array_compact(F.array(F.when(F.col("top") <= size, "header"), F.when(F.col("bottom") <= size, "footer")))).alias("zone"))


def numbered_keys(rows: DataFrame, key: str, by: str, order: str) -> DataFrame:
    """Adds ``occurrence``, the ``unique_key`` with #n from the second on, and ``ambiguous`` for every row of
    a key that occurs more than once."""
    w = Window.partitionBy(by, key)
    n = F.row_number().over(w.orderBy(order))
    return rows.withColumn("occurrence", n).withColumn("unique_key", F.when(F.col("occurrence") > 1, F.concat(F.col(key), F.lit("#"), F.col("occurrence"))).otherwise(F.col(key))).withColumn("ambiguous", F.count("*").over(w) > 1)


def furniture(lines: DataFrame, zone: int = 3, min_pages: int = 3, min_share: float = 0.6, most_chars: int = 120) -> DataFrame:
    """(document_id, page_number, stream_index, kind, text): lines in a page zone whose text recurs there on
    enough pages of the document, either literally or as a page number with its digits folded. A line that
    is both is a page number. A document of fewer than ``min_pages`` pages has none."""
    z = zone_lines(lines, zone).where(F.length(F.trim("text")) <= most_chars)
    z = z.withColumn("literal", T.fold_line(F.col("text"), digits=False)).withColumn("number", F.when(T.is_page_number(F.col("text")), T.fold_line(F.col("text"))))
    pages = lines.groupBy("document_id").agg(F.countDistinct("page_number").alias("pages"))
    need = F.greatest(F.lit(min_pages), F.round(F.col("pages") * min_share).cast("int"))

    def recurring(key: str) -> DataFrame:
        return z.where(F.col(key).isNotNull()).groupBy("document_id", "zone", key).agg(F.countDistinct("page_number").alias("on")).join(pages, "document_id").where(F.col("on") >= need).select("document_id", "zone", key, F.lit(True).alias(f"is_{key}"))

    out = z.join(recurring("literal"), ["document_id", "zone", "literal"], "left").join(recurring("number"), ["document_id", "zone", "number"], "left")
    out = out.where(F.coalesce("is_literal", F.lit(False)) | F.coalesce("is_number", F.lit(False)))
    out = out.withColumn("kind", F.when(F.col("is_number"), "page_number").otherwise(F.col("zone")))
    w = Window.partitionBy("document_id", "stream_index").orderBy(F.when(F.col("kind") == "page_number", 0).when(F.col("kind") == "header", 1).otherwise(2))
    return out.withColumn("rank", F.row_number().over(w)).where("rank = 1").select("document_id", "page_number", "stream_index", "kind", "text")


def windows_of(texts: DataFrame, key: str = "doc_id", text: str = "text", window: int = 1200, stride: int = 900) -> DataFrame:
    """(key, start, end, body): overlapping windows of each text, up to the first that reaches its end. An
    empty text has none."""
    n = F.length(text)
    last = F.greatest(F.lit(0), F.ceil((n - window) / stride)).cast("int")
    starts = F.transform(F.sequence(F.lit(0), last), lambda k: k * stride)
    return texts.where(n > 0).select(key, text, F.explode(starts).alias("start")).select(key, "start", F.least(F.col("start") + window, n).alias("end"), F.substring(F.col(text), F.col("start") + 1, F.lit(window)).alias("body"))


def merged_intervals(spans: DataFrame, by: Column | str, start: str = "start", end: str = "end") -> DataFrame:
    """Disjoint unions of touching or overlapping intervals, per group: gaps and islands by a running
    maximum."""
    w = Window.partitionBy(by).orderBy(start, end)
    opens = F.coalesce(F.col(start) > F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    rows = spans.withColumn("_open", opens.cast("int")).withColumn("_island", F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(by, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")
