"""Small catalogue queries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from millwright.functions.text import contains_text
from millwright.operators.bom import with_labels
from millwright.operators.tags import without_tags
from millwright.plans.tables import Tables


def where_used(rates: DataFrame, part: str | None) -> DataFrame:
    """Edges into which a part goes."""
    return rates.where(contains_text(F.col("part"), part))


def browse_produce(t: Tables, produce: str) -> DataFrame:
    """All paths of one product with names, sorted."""
    root = t.parts.where(F.col("label") == produce).select(F.col("part_id").alias("produce_id"))
    return with_labels(t.paths.join(root, "produce_id", "left_semi"), t.parts).orderBy(
        "produce", "good", "part", "depth")


def distinct_goods(edges: DataFrame) -> DataFrame:
    return edges.select("good").distinct().orderBy("good")


def unusual_efficiency(t: Tables) -> DataFrame:
    """Items with efficiency below 10 and not 4, under none of five tags."""
    odd = t.parts.where((F.col("material_efficiency") < 10) & (F.col("material_efficiency") != Decimal(4)))
    tags = ["BLUEPRINTS", "BOOSTER", "MATERIALS", "RESEARCH EQUIPMENT", "CONTRACTS"]
    return without_tags(odd, t.tags, tags).orderBy("material_efficiency", "label")


def remaining_count(rows: DataFrame) -> DataFrame:
    """The rows with their total number on each."""
    total = rows.agg(F.count(F.lit(1)).alias("_n")).scalar()
    return rows.withColumn("remain", total)
