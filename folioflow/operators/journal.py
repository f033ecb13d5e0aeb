"""Append-only journals: the last record of each key, attempts, changes and versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The last record of each key by ``order``; a null order comes first. Rows without a key are dropped.
    One aggregation that starts before the shuffle, no sort."""
    rest = [c for c in df.columns if c != key]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*[F.struct(F.col(o).isNotNull(), F.col(o)) for o in order])).alias("r")).select(key, "r.*")


def attempts(df: DataFrame, key: str, failed: Column) -> DataFrame:
    """(key, attempts, failures): records of each key, and those that failed."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("attempts"), F.count_if(failed).alias("failures"))


def upserted(state: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The state with the rows of the same key replaced and new ones added: one full outer join."""
    cols = [c for c in state.columns if c != key]
    s, u = state.withColumn("_s", F.lit(1)).alias("s"), updates.select(state.columns).withColumn("_u", F.lit(1)).alias("u")
    return s.join(u, key, "full_outer").select(key, *[F.when(F.col("_u") == 1, F.col(f"u.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in cols])


def change_kind(before: Column, after: Column) -> Column:
    """new, unchanged, updated or gone, from two content hashes."""
    return F.when(before.isNull() & after.isNotNull(), "new").when(after.isNull(), "gone").when(before == after, "unchanged").otherwise("updated")


def versions(df: DataFrame, key: str, content: Column, order: str) -> DataFrame:
    """(key, version, content, valid_from, valid_to): the history of each key, a version from each change of
    content to the next; null while current. Records that repeat the content before them open none; ties in
    order go by content."""
    rows = df.where(F.col(key).isNotNull() & F.col(order).isNotNull()).select(key, F.col(order).alias("valid_from"), content.alias("content"))
    w = Window.partitionBy(key).orderBy("valid_from", "content")
    first = F.lag("content").over(w)
    opened = rows.withColumn("n", F.row_number().over(w)).withColumn("before", first).where((F.col("n") == 1) | ~F.col("content").eqNullSafe(F.col("before")))
    return opened.select(key, F.row_number().over(w).alias("version"), "content", "valid_from", F.lead("valid_from").over(w).alias("valid_to"))


def parsed(lines: DataFrame, schema: str, key: str, column: str = "value") -> DataFrame:
    """JSON lines as rows; blank and broken ones, and those without the key, are dropped."""
    return lines.where(F.trim(column) != "").select(F.from_json(column, schema, {"mode": "PERMISSIVE"}).alias("r")).where(F.col(f"r.{key}").isNotNull()).select("r.*")


def first_reason(rules: list[tuple[Column, str]]) -> Column:
    """The reason of the first rule that holds; null if none does."""
    return F.coalesce(*[F.when(c, r) for c, r in rules])


def all_reasons(rules: list[tuple[Column, str]]) -> Column:
    """The reasons of all rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, r) for c, r in rules]))


def to_do(corpus: DataFrame, state: DataFrame, key: str, reason: Column, limit: int | None = None) -> DataFrame:
    """Corpus rows that their state gives a reason to process, in key order, ``limit`` at most. ``reason`` is
    a column over the corpus row and the state's, null for done."""
    rows = corpus.join(state, key, "left").withColumn("reason", reason).where("reason is not null")
    return rows if limit is None else rows.orderBy(key).limit(limit)
