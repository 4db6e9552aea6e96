"""Stock on hand from nested holdings documents."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

# Hauler type ids that must equal the published ones.
# 12753 Impel, 12747 Mastodon, 12733 Prorator, 12735 Prowler, 20189 Fenrir, 20183 Providence, 28850 Ark
HAULER_TYPES = ("12753", "12747", "12733", "12735", "20189", "20183", "28850")


@dataclass(frozen=True)
class Holder:
    """An owner of assets; ``kind`` is 'corp' (factory hangars) or 'char' (ship cargoes)."""

    name: str
    kind: str


def known_assets(assets: DataFrame, parts: DataFrame) -> DataFrame:
    """Asset rows of catalogued items only."""
    ids = parts.where(F.col("external_id").isNotNull()).select(
        F.col("external_id").cast("string").alias("item_type")).distinct()
    return assets.join(ids, "item_type", "left_semi")


def counted_assets(assets: DataFrame, holders: Sequence[Holder], home_location: str,
                   ship_types: Sequence[str] = HAULER_TYPES) -> DataFrame:
    """Corporate rows at the home location, plus character rows inside hauling ships."""
    corps = [h.name for h in holders if h.kind == "corp"]
    chars = [h.name for h in holders if h.kind == "char"]
    columns = ["holder", "item_type", "quantity"]
    hangar = assets.where(F.col("holder").isin(corps) & (F.col("location_id") == home_location)).select(*columns)
    cargo = assets.where(F.col("holder").isin(chars) & F.col("location_type").isin(list(ship_types))).select(*columns)
    return hangar.unionByName(cargo)


def stock(assets: DataFrame, parts: DataFrame, holders: Sequence[Holder], home_location: str,
          ship_types: Sequence[str] = HAULER_TYPES, mode: str = "last") -> DataFrame:
    """(part_id, pile) for every part with an external id: the counted sum, or 0.

    Each holder's load overwrites the one before, so by default the last holder's stock
    stands; ``mode='sum'`` adds all holders up.
    """
    if mode not in ("last", "sum"):
        raise ValueError("mode must be 'last' or 'sum'")
    counted = counted_assets(assets, holders[-1:] if mode == "last" else holders, home_location, ship_types)
    totals = counted.groupBy(F.col("item_type").try_cast("bigint").alias("external_id")).agg(
        F.sum("quantity").alias("_held"))
    return (
        parts.where(F.col("external_id").isNotNull()).select("part_id", "external_id")
        .join(totals, "external_id", "left")
        .select("part_id", F.coalesce("_held", F.lit(0)).cast("bigint").alias("pile"))
    )


def upsert_stock(parts: DataFrame, piles: DataFrame) -> DataFrame:
    """Parts with the new stock; parts without an external id keep what they had."""
    fresh = piles.select("part_id", F.col("pile").alias("_pile"))
    return parts.join(fresh, "part_id", "left").withColumn("pile", F.coalesce("_pile", "pile")).select(*parts.columns)
