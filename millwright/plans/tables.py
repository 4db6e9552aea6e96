"""The tables reports read, and the lookups they share."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from millwright.functions.text import explode_build_lists
from millwright.operators.bom import bom_explode, bom_rates
from millwright.operators.market import buys_by_region, sells_by_region
from millwright.params import Params


@dataclass(frozen=True)
class Tables:
    """One consistent snapshot. ``paths`` is the materialized explosion, see ``refresh``."""

    parts: DataFrame
    edges: DataFrame
    tags: DataFrame
    regions: DataFrame
    aggregates: DataFrame
    paths: DataFrame | None = None
    params: Params = Params()

    @cached_property
    def sells(self) -> DataFrame:
        return sells_by_region(self.aggregates, self.regions)

    @cached_property
    def buys(self) -> DataFrame:
        return buys_by_region(self.aggregates, self.regions)

    @cached_property
    def rates(self) -> DataFrame:
        return bom_rates(self.edges, self.parts, self.tags, self.params)

    def refresh(self) -> "Tables":
        """The same tables with the paths exploded anew."""
        return Tables(self.parts, self.edges, self.tags, self.regions, self.aggregates,
                      bom_explode(self.rates), self.params)


def best_offers(t: Tables, local: DataFrame | None = None) -> DataFrame:
    """One row per quoted part: its cheapest region among the local ones.

    ``econ_region`` and what belongs to it are null when the part is quoted elsewhere only.
    """
    sells = t.sells
    offer = F.struct("offers_low_range", "region", "name_region")
    if local is not None:
        near = local.select("region").distinct().withColumn("_near", F.lit(True))
        sells = sells.join(near, "region", "left")
        offer = F.when(F.col("_near"), offer)
    return sells.groupBy("part_id").agg(F.min(offer).alias("_best")).select(
        "part_id", F.col("_best.region").alias("econ_region"), F.col("_best.name_region").alias("name_region"),
        F.col("_best.offers_low_range").alias("price"), F.lit(True).alias("quoted"))


def with_best_offer(df: DataFrame, t: Tables, local: DataFrame | None, keep_unquoted: bool = False) -> DataFrame:
    """Rows with their part's best offer. Parts without any quote stay, parts quoted only
    outside the local regions go, unless ``keep_unquoted``."""
    priced = df.join(best_offers(t, local), "part_id", "left")
    if not keep_unquoted:
        priced = priced.where(F.col("quoted").isNull() | F.col("econ_region").isNotNull())
    return priced.drop("quoted")


def build_units(t: Tables, lists: Sequence[str | None] | DataFrame) -> DataFrame:
    """(part_id, units) of the items named in the build lists; the first list wins.

    Lists are given as texts, or as a table (priority, list), a row per list. Of lists with equal priority, the one with the
    least units wins; a null priority comes first; null and empty texts, and texts that are no list, name nothing.
    """
    if not isinstance(lists, DataFrame):
        given = [text for text in lists if text]
        rows = [F.struct(F.lit(i).alias("priority"), F.lit(text).alias("list")) for i, text in enumerate(given)]
        if not rows:
            return t.parts.where(F.lit(False)).select("part_id", F.lit(0).cast("bigint").alias("units"))
        lists = t.parts.sparkSession.range(1).select(F.inline(F.array(*rows)))
    units = explode_build_lists(lists, [], "list", "priority").where(F.col("units").isNotNull())
    return t.parts.withColumn("label", F.upper("label")).join(units, "label").select("part_id", "units")
