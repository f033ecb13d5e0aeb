"""Writers: Spark's committer makes a table appear whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import guarded_cell


def unbuilt(wanted: DataFrame, built: DataFrame, key: str = "document_id", force: bool = False) -> DataFrame:
    """What is still to be made: everything if forced, else what the target lacks."""
    return wanted if force else wanted.join(built.select(key).distinct(), key, "left_anti")


def write_table(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    (w.partitionBy(*by) if by else w).parquet(path)


def write_json_lines(df: DataFrame, path: str, order: list[str]) -> None:
    """Compact JSON, one row a line, in order within and over files."""
    df.orderBy(*order).select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def write_review_csv(df: DataFrame, path: str) -> None:
    """CSV for spreadsheets: text cells guarded against being read as formulas."""
    cells = [guarded_cell(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes]
    df.select(*cells).write.mode("overwrite").option("header", True).csv(path)


def band_sample(edges: DataFrame, band: str, key: list[str], most: int) -> DataFrame:
    """Rows to review: ``most`` of each band in hash order."""
    from pyspark.sql import Window

    w = Window.partitionBy(band).orderBy(F.sha2(F.concat_ws("|", *key), 256))
    return edges.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")
