"""Areas of rectangle unions, and footnotes by type size."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

EXACT, CELLS = 128, 512


def covered_area(rects: list[tuple[float, float, float, float]], clip: tuple[float, float, float, float]) -> float:
    """Area that the rectangles cover of ``clip``: exact over the grid that their edges make, or over a
    raster of cell centres where there are more than EXACT different ones."""
    x0, y0, x1, y1 = clip
    kept = {(max(a, x0), max(b, y0), min(c, x1), min(d, y1)) for a, b, c, d in rects}
    r = np.array([k for k in kept if k[2] > k[0] and k[3] > k[1]], float)
    if not len(r):
        return 0.0
    if len(r) <= EXACT:
        xs, ys = np.unique(r[:, [0, 2]]), np.unique(r[:, [1, 3]])
        mx, my, wide, tall = (xs[:-1] + xs[1:]) / 2, (ys[:-1] + ys[1:]) / 2, np.diff(xs), np.diff(ys)
    else:
        wide, tall = np.full(CELLS, (x1 - x0) / CELLS), np.full(CELLS, (y1 - y0) / CELLS)
        mx, my = x0 + wide[0] * (np.arange(CELLS) + 0.5), y0 + tall[0] * (np.arange(CELLS) + 0.5)
    grid = np.zeros((len(mx), len(my)), bool)
    for a, b, c, d in r:
        grid[np.searchsorted(mx, a) : np.searchsorted(mx, c), np.searchsorted(my, b) : np.searchsorted(my, d)] = True
    return float((grid * wide[:, None] * tall[None, :]).sum())


@F.pandas_udf(DoubleType())
def union_area(rects: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    """Covered area of a page from its array of struct<x0,y0,x1,y1>; null or empty arrays cover nothing."""
    return pd.Series([covered_area([(x["x0"], x["y0"], x["x1"], x["y1"]) for x in (r if r is not None else [])], (0.0, 0.0, w, h)) for r, w, h in zip(rects, width, height)])


def body_size(lines: DataFrame, share: float = 0.55) -> DataFrame:
    """(document_id, body_size): the commonest size, to a tenth, of lines in the upper ``share`` of their
    pages, the larger of two as common; of all lines where there are none. Columns: size, y0, height."""
    rows = lines.where("size > 0").withColumn("size", F.round("size", 1)).withColumn("upper", F.col("y0") < F.col("height") * share)
    per = rows.groupBy("document_id", "size").agg(F.count("*").alias("n"), F.count_if("upper").alias("u"))
    return per.groupBy("document_id").agg(F.coalesce(F.max_by("size", F.when(F.col("u") > 0, F.struct("u", "size"))), F.max_by("size", F.struct("n", "size"))).alias("body_size"))


def small_print(lines: DataFrame, ratio: float = 0.92, share: float = 0.55, most: int = 60) -> DataFrame:
    """(document_id, page_number, line_start, line_end): on each page the run of small lines that ends with
    it, below the middle, under larger type, of ``most`` lines at most and opened by a number or mark.
    Columns: text, size, y0, height, page_line_index."""
    page = Window.partitionBy("document_id", "page_number")
    rows = lines.where(F.trim("text") != "").join(body_size(lines, share), "document_id").withColumn("large", F.col("size") > F.col("body_size") * ratio)
    rows = rows.withColumn("last_large", F.max(F.when(F.col("large"), F.col("page_line_index"))).over(page))
    tail = rows.where(F.col("page_line_index") > F.col("last_large"))
    out = tail.groupBy("document_id", "page_number").agg(F.min("page_line_index").alias("line_start"), F.max("page_line_index").alias("line_end"), F.min_by("text", "page_line_index").alias("opening"), F.max("y0").alias("low"), F.max("height").alias("height"), F.count("*").alias("n"))
    sound = (F.col("low") >= F.col("height") * share) & (F.col("n") <= most) & F.col("opening").rlike(r"^\s*(\[?[0-9]{1,3}[\].)]?|[*†‡])\s")
    return out.where(sound).select("document_id", "page_number", "line_start", "line_end")
