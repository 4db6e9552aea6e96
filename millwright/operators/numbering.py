"""Consecutive row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millwright.session import materialize

BUCKETS = 4096


def _number_in_buckets(df: DataFrame, bucket: Column, order: list[str], out: str, start: int) -> DataFrame:
    """Number rows by (bucket, order). Only the bucket totals, at most ``BUCKETS`` + 1 rows,
    ever meet in one task; the rows themselves are numbered bucket by bucket."""
    placed = df.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return (
        placed.withColumn("_row", inside)
        .join(offsets, "_bucket")
        .withColumn(out, (F.col("_row") + F.col("_offset") + start - 1).cast("bigint"))
        .drop("_bucket", "_row", "_offset")
    )


def number_by_key(df: DataFrame, key: str, out: str, start: int = 1) -> DataFrame:
    """Number rows in ascending order of a unique integer key.

    Ranges come from a sample of the keys, so an outlier does not leave all other rows in one
    range. Rows are stored with the range they were dealt to, as ranges are not drawn twice alike.
    """
    dealt = materialize(df.repartitionByRange(key).withColumn("_range", F.spark_partition_id()), "key-ranges")
    return _number_in_buckets(dealt, F.col("_range"), [key], out, start).drop("_range")


def number_by_hash(df: DataFrame, keys: list[str], out: str, start: int = 1) -> DataFrame:
    """Number rows with unique ``keys`` in a repeatable but arbitrary order."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    return _number_in_buckets(df, bucket, keys, out, start)
