"""Descriptions, stratified estimates, confusion and safety rates, and the difference of two reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def describe(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, sum, mean, median, 90th, 95th and 99th percentile, least, greatest and sample deviation (0 of
    one value) per group; percentiles by linear interpolation."""
    v = F.col(value).cast("double")
    at = [F.round(F.percentile(v, q), 4).alias(n) for n, q in (("median", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99))]
    return df.groupBy(*by).agg(F.count(v).alias("n"), F.round(F.sum(v), 4).alias("total"), F.round(F.avg(v), 4).alias("mean"), *at, F.min(v).alias("least"), F.max(v).alias("greatest"), F.round(F.coalesce(F.try_divide(F.stddev_samp(v), F.lit(1.0)), F.lit(0.0)), 4).alias("deviation"))


def stratified_estimate(population: DataFrame, sample: DataFrame, by: str, value: str) -> DataFrame:
    """(by, population, sampled, estimate, standard_error): each stratum's total as its size times the sample
    mean, with the finite population correction. A stratum without a sample has a null estimate."""
    size = population.groupBy(by).agg(F.count("*").alias("population"))
    v = F.col(value).cast("double")
    seen = sample.groupBy(by).agg(F.count(v).alias("sampled"), F.avg(v).alias("mean"), F.coalesce(F.var_samp(v), F.lit(0.0)).alias("variance"))
    n, m = F.col("population"), F.col("sampled")
    error = F.when(m > 1, n * F.sqrt(F.greatest(F.lit(0.0), 1 - m / n) * F.col("variance") / m)).otherwise(F.lit(0.0))
    return size.join(seen, by, "left").select(by, "population", F.coalesce("sampled", F.lit(0)).alias("sampled"), F.round(n * F.col("mean"), 4).alias("estimate"), F.round(F.when(m > 0, error), 4).alias("standard_error"))


def estimate_total(strata: DataFrame) -> DataFrame:
    """The total of the strata with its 95 % interval, and how many strata have no sample."""
    total, error = F.sum("estimate"), F.sqrt(F.sum(F.col("standard_error") ** 2))
    return strata.agg(F.round(total, 2).alias("total"), F.round(total - 1.96 * error, 2).alias("low"), F.round(total + 1.96 * error, 2).alias("high"), F.count_if(F.col("estimate").isNull()).alias("uncovered"))


def estimate_by_cell(population: DataFrame, sample: DataFrame, by: str, cell: str, value: str, least: int = 5) -> DataFrame:
    """(by, cell, population, estimate, measured): totals by cell from its own mean, or from its stratum's
    where fewer than ``least`` of the cell were sampled."""
    size = population.groupBy(by, cell).agg(F.count("*").alias("population"))
    v = F.col(value).cast("double")
    own = sample.groupBy(by, cell).agg(F.count(v).alias("m"), F.avg(v).alias("mean"))
    wide = sample.groupBy(by).agg(F.avg(v).alias("wide"))
    measured = F.coalesce(F.col("m") >= least, F.lit(False))
    return size.join(own, [by, cell], "left").join(wide, by, "left").select(by, cell, "population", F.round(F.col("population") * F.when(measured, F.col("mean")).otherwise(F.col("wide")), 4).alias("estimate"), measured.alias("measured"))


def confusion(pairs: DataFrame, said: str, found: str) -> DataFrame:
    """(said, found, n) with the margins, in one pass: a margin's other side is ``*``; a null is ``none``."""
    rows = pairs.select(F.coalesce(F.col(said).cast("string"), F.lit("none")).alias(said), F.coalesce(F.col(found).cast("string"), F.lit("none")).alias(found))
    return rows.cube(said, found).agg(F.count("*").alias("n")).select(F.coalesce(said, F.lit("*")).alias(said), F.coalesce(found, F.lit("*")).alias(found), "n")


def safety(pairs: DataFrame, by: list[str], admitted: Column, rejects: Column, accepts: Column) -> DataFrame:
    """Rates of false acceptance (admitted of the rejected) and false quarantine (held back of the accepted);
    null where there is no such row. Rows that are neither are left out of both."""
    wrong_in, wrong_out = F.count_if(rejects & admitted), F.count_if(accepts & ~admitted)
    rate = lambda a, b: F.round(F.try_divide(a.cast("double"), b.cast("double")), 4)
    return pairs.groupBy(*by).agg(F.count_if(rejects).alias("rejected"), F.count_if(accepts).alias("accepted"), wrong_in.alias("false_acceptances"), rate(wrong_in, F.count_if(rejects)).alias("false_acceptance_rate"), wrong_out.alias("false_quarantines"), rate(wrong_out, F.count_if(accepts)).alias("false_quarantine_rate"))


def counts_by(df: DataFrame, *dimensions: str) -> DataFrame:
    """(dimension, value, n): the counts of several dimensions in one pass over grouping sets."""
    names = F.map_from_entries(F.array(*[F.struct(F.lit(d), F.coalesce(F.col(d).cast("string"), F.lit("none"))) for d in dimensions]))
    return df.select(F.explode(names).alias("dimension", "value")).groupBy("dimension", "value").agg(F.count("*").alias("n"))


def count_difference(before: DataFrame, after: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """(*keys, before, after, delta) over the union of keys; a key one side lacks counts 0 there."""
    b, a = before.select(*keys, F.col(n).alias("before")), after.select(*keys, F.col(n).alias("after"))
    return b.join(a, keys, "full_outer").fillna(0, ["before", "after"]).withColumn("delta", F.col("after") - F.col("before"))


def changed_rows(before: DataFrame, after: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """(key, field, before, after): fields that differ between two versions of a row, nulls compared as
    values; rows that only one side has are left out."""
    joined = before.alias("b").join(after.alias("a"), key)
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"b.{c}").cast("string").alias("before"), F.col(f"a.{c}").cast("string").alias("after")) for c in tracked])
    rows = joined.select(key, F.explode(cells).alias("x")).select(key, "x.*")
    return rows.where(~F.col("before").eqNullSafe(F.col("after")))


def coverage_of(labels: DataFrame, array: str, names: DataFrame, name: str) -> DataFrame:
    """(name, n): rows that carry each label, labels that none carries included."""
    seen = labels.select(F.explode(F.array_distinct(array)).alias(name)).groupBy(name).agg(F.count("*").alias("n"))
    return names.select(name).distinct().join(seen, name, "left").fillna(0, ["n"])


def extremes(df: DataFrame, slots: dict[str, str], key: str) -> DataFrame:
    """(slot, key, value): of each metric the row that has most of it, ties by the greater key."""
    cells = F.array(*[F.struct(F.lit(s).alias("slot"), F.col(c).cast("double").alias("value")) for s, c in slots.items()])
    return df.select(key, F.explode(cells).alias("x")).where("x.value is not null").groupBy("x.slot").agg(F.max_by(key, F.struct("x.value", key)).alias(key), F.max("x.value").alias("value"))
