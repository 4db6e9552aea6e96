"""The recurring loads, end to end. Each takes the current snapshots and returns the next."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from millwright.operators.bom import bom_cycles
from millwright.operators.market import order_depth_average, relevant_orders
from millwright.operators.merge import newest, replace_snapshot, upsert_edges, upsert_parts, upsert_prices
from millwright.operators.quality import load_violations
from millwright.operators.stock import HAULER_TYPES, Holder, known_assets, stock, upsert_stock
from millwright.operators.tags import TagRule, add_tags, apply_rules, explode_keywords
from millwright.params import Params
from millwright.schemas import ORDER
from millwright.session import materialize
from millwright.sources.catalogue import staging_filter
from millwright.sources.documents import ASSETS, accepted, parse_assets, read_books, rejected


class LoadRefused(ValueError):
    """The loaded files break a rule; ``violations`` holds all of them."""

    def __init__(self, violations: DataFrame):
        shown = "; ".join(f"{r.rule}: {r.key} ({r.detail})" for r in violations.limit(10).collect())
        super().__init__(f"load refused, {violations.count()} violations, among them {shown}")
        self.violations = violations


@dataclass(frozen=True)
class Catalogue:
    parts: DataFrame
    edges: DataFrame
    tags: DataFrame


def _refuse_if_any(violations: DataFrame) -> None:
    if not violations.isEmpty():
        raise LoadRefused(violations)


def load_catalogue(current: Catalogue, part_rows: DataFrame, bom_rows: DataFrame,
                   rules: Sequence[TagRule] = ()) -> Catalogue:
    """Loaded part and bill-of-materials rows merged into the catalogue.

    Refuses duplicate labels or ids, goods made of themselves, unknown labels and cycles
    before anything is returned. Tags come from the browser path, plus ``rules`` if given.
    """
    part_rows, bom_rows = staging_filter(part_rows, "label"), staging_filter(bom_rows, "good")
    _refuse_if_any(load_violations(part_rows, bom_rows))
    parts = materialize(upsert_parts(current.parts, part_rows), "parts")
    edges = materialize(upsert_edges(current.edges, bom_rows, parts), "edges")
    cycles = bom_cycles(edges)
    _refuse_if_any(cycles.select(F.lit("cycle").alias("rule"), F.col("good_id").cast("string").alias("key"),
                                 F.array_join("path", ">").alias("detail")))
    paths = part_rows.join(parts.select("part_id", "label"), "label")
    tags = add_tags(current.tags, explode_keywords(paths, "part_id", "market_browser_path"))
    if rules:
        tags = add_tags(tags, apply_rules(parts, rules))
    return Catalogue(parts, edges, materialize(tags, "tags"))


@dataclass(frozen=True)
class Market:
    orders: DataFrame
    aggregates: DataFrame


def refresh_market(current: Market, docs: DataFrame, parts: DataFrame, now: datetime, security: Decimal,
                   params: Params = Params(), version: str = "cached_until", everywhere: bool = True) -> Market:
    """Fresh order-book documents (item_type_id, xdoc, ``version`` if there are several of an item) into orders and aggregates.

    All orders of a refreshed item are replaced by those of its newest document; only refreshed items are priced again.
    ``everywhere=False`` reads the orders of ``params.regions_of_interest`` alone. Refused documents refresh nothing: their
    items keep what they had. Each document is parsed once.
    """
    books = read_books(docs, version=version, regions=None if everywhere else params.regions_of_interest)
    items = parts.where(F.col("external_id").isNotNull()).select(
        F.col("external_id").alias("item_type_id"), "part_id")
    stamp = F.lit(now).cast("timestamp_ntz").alias("time_quotes_exec")
    quotes = relevant_orders(books.orders, now, security, params).join(items, "item_type_id")
    fresh = materialize(quotes.select(*ORDER.names[:-1], stamp), "orders")
    touched = books.items.join(items, "item_type_id").select("part_id")
    priced = order_depth_average(fresh, params).withColumn("time_quotes_exec", stamp)
    return replace(
        current,
        orders=materialize(replace_snapshot(current.orders, fresh, touched, "part_id"), "orders"),
        aggregates=materialize(upsert_prices(current.aggregates, priced), "aggregates"))


def refresh_stock(parts: DataFrame, docs: DataFrame, holders: Sequence[Holder], home_location: str,
                  ship_types: Sequence[str] = HAULER_TYPES, mode: str = "last", version: str = "cached_until") -> DataFrame:
    """Holdings documents (holder, xdoc, ``version`` if there are several of a holder) into the parts' stock.

    The newest document of a holder counts. A holder of whom all documents are refused loads nothing: the holder before
    stands, and a sum over all, or a load without any other holder, leaves the stock as it is.
    """
    good = newest(accepted(docs, ASSETS), "holder", version)
    refused = rejected(docs, ASSETS).select("holder").join(good.select("holder"), "holder", "left_anti")
    # at most one row per named holder
    names = {r.holder for r in refused.where(F.col("holder").isin([h.name for h in holders])).distinct().collect()}
    left = [h for h in holders if h.name not in names]
    if names and (mode == "sum" or not left):
        return parts
    docs, holders = good, left
    assets = known_assets(parse_assets(docs), parts)
    return materialize(upsert_stock(parts, stock(assets, parts, holders, home_location, ship_types, mode)), "parts")
