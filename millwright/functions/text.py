"""Text helpers, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def initcap(col: Column) -> Column:
    """Title case that restarts after every non-alphanumeric, not only after blanks."""
    runs = F.regexp_extract_all(F.lower(col), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def readable_ore(col: Column) -> Column:
    """'A B C' becomes 'B C, A'."""
    return F.regexp_replace(col, r"(?s)^([^ ]*) (.*)$", "$2, $1")


def contains_text(col: Column, text: str | None) -> Column:
    """Substring match on upper-cased text. No text means any value that is not null."""
    return col.isNotNull() if not text else col.contains(text.upper())


def first_word(col: Column) -> Column:
    return F.substring_index(col, " ", 1)


def concat_skipping_nulls(*cols: Column) -> Column:
    return F.concat_ws("", *cols)


def decimal_text(col: Column) -> Column:
    """A decimal without trailing zeros."""
    return F.regexp_replace(F.regexp_replace(col.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def build_list(text: Column) -> Column:
    """'5x{a,b}' as struct(units, names): names upper-cased and trimmed, lower-case x only."""
    body = F.regexp_replace(F.substring(F.upper(text), 1, 2**31 - 1), r"^[^{]*", "")
    body = F.regexp_replace(body, r"[{}]", "")
    names = F.transform(F.split(body, ","), lambda n: F.trim(n))
    units = F.expr("try_cast(null as bigint)")
    units = F.when(text.contains("x"), F.substring_index(text, "x", 1)).otherwise(units)
    return F.struct(units.try_cast("bigint").alias("units"), names.alias("names"))


def explode_build_lists(lists: DataFrame, keys: list[str], list_col: str, priority_col: str) -> DataFrame:
    """One row per (keys, label): units of the first list, by priority, that names the label."""
    parsed = lists.where(F.col(list_col).contains("{")).withColumn("_list", build_list(F.col(list_col)))
    named = parsed.select(*keys, priority_col, F.col("_list.units").alias("units"),
                          F.explode("_list.names").alias("label"))
    return (
        named.where(F.length("label") > 0)
        .groupBy(*keys, "label")
        .agg(F.min(F.struct(priority_col, "units")).alias("_first"))
        .select(*keys, "label", F.col("_first.units").alias("units"))
    )
