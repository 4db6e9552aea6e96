"""Comma-separated catalogue and bill-of-materials files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class FileColumn:
    name: str
    kind: str
    max_length: int
    required: bool = False


# File layouts and field lengths.
PART_FILE = (
    FileColumn("label", "string", 100, required=True),
    FileColumn("market_browser_path", "string", 500),
    FileColumn("volume", "decimal(15,3)", 10, required=True),
    FileColumn("external_id", "bigint", 10),
    FileColumn("material_efficiency", "decimal(10,3)", 10),
    FileColumn("outcome_units", "bigint", 5),
    FileColumn("base_invent_success", "decimal(10,3)", 10),
    FileColumn("base_invent_copies", "bigint", 3),
)
BOM_FILE = (
    FileColumn("good", "string", 100, required=True),
    FileColumn("part", "string", 100, required=True),
    FileColumn("quantity", "decimal(10,3)", 10, required=True),
)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The raw lines of every file, each without its first line (column ``line``)."""
    return (
        spark.read.schema("line string").option("header", True).option("enforceSchema", True)
        .option("sep", "\u0001").option("quote", "").option("escape", "").option("comment", "").csv(path)
    )


def _field(name: str) -> Column:
    value = F.trim(F.col(f"_f.{name}"))
    return F.when(F.length(value) > 0, value)


def parse_catalogue(lines: DataFrame, columns: tuple[FileColumn, ...]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines). Empty and missing trailing fields are null, further
    fields are ignored; a field that is too long or not of its type rejects the line, as
    does a missing required field. Blank lines are neither."""
    text = ", ".join(f"{c.name} STRING" for c in columns)
    options = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE",
               "escape": '"'}
    split = lines.where(F.length(F.trim("line")) > 0).withColumn("_f", F.from_csv("line", text, options))
    bad = F.lit(False)
    typed = []
    for c in columns:
        value = _field(c.name)
        cast = value if c.kind == "string" else value.try_cast(c.kind)
        typed.append(cast.alias(c.name))
        bad = bad | F.coalesce(F.length(value) > c.max_length, F.lit(False)) | (value.isNotNull() & cast.isNull())
        if c.required:
            bad = bad | value.isNull()
    return split.where(~bad).select(*typed), split.where(bad).select("line")


def read_catalogue(spark: SparkSession, path: str, columns: tuple[FileColumn, ...]) -> tuple[DataFrame, DataFrame]:
    return parse_catalogue(read_lines(spark, path), columns)


def staging_filter(rows: DataFrame, key: str) -> DataFrame:
    return rows.where(F.col(key).isNotNull())
