"""Reports on what to buy: prices, material lists, ore yields, blueprints."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from millwright.functions.numbers import cargo_share, div, half_up, micro, tenth_power, value_micro, whole
from millwright.functions.text import contains_text, initcap, readable_ore
from millwright.operators.bom import bom_quantity, evaluate
from millwright.operators.tags import has_keyword, with_tag, without_tags
from millwright.plans.tables import Tables, best_offers, build_units, with_best_offer
from millwright.schemas import QUANTITY, WHOLE
from millwright.session import materialize

WIDE_MONEY = "decimal(38,6)"


def best_universe_price(t: Tables) -> DataFrame:
    """Cheapest region of every part anywhere."""
    return best_offers(t).select("part_id", F.col("price").alias("best_price"), F.col("name_region").alias("best_region"))


def compare_region_price(t: Tables, region_text: str) -> DataFrame:
    """Every part's price in a region whose name contains the text (lowest id if several)."""
    here = t.sells.where(contains_text(F.col("name_region"), region_text))
    return here.groupBy("part_id").agg(
        F.min(F.struct("region", "offers_low_range", "name_region")).alias("_here")
    ).select("part_id", F.col("_here.offers_low_range").alias("here_price"),
             F.col("_here.name_region").alias("here_region"))


def cheapest_region_for_keyword(t: Tables, keyword: str, local: DataFrame | None = None,
                                current_region: str | None = None) -> DataFrame:
    """Cheapest region of well-supplied items under a tag, against the best anywhere and
    against the current region. Prices in cents, ratios truncated to whole percent."""
    offers = best_offers(t, local).where(F.col("econ_region").isNotNull())
    supply = t.aggregates.where(F.col("direction") == "SELL").select(
        "part_id", F.col("region").alias("econ_region"), "samples")
    rows = (
        with_tag(t.parts.select("part_id", "label"), t.tags, keyword)
        .join(offers, "part_id").join(supply, ["part_id", "econ_region"])
        .where(whole(F.col("price")) * F.col("samples").cast("decimal(19,0)") > F.lit(Decimal(t.params.notable_supply)))
        .join(has_keyword(t.tags, "ORE").withColumn("_ore", F.lit(True)), "part_id", "left")
    )
    none_pct, none_text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    best_pct, best_name, here_pct, here_name = none_pct, none_text, none_pct, none_text
    if local is not None:
        rows = rows.join(best_universe_price(t), "part_id", "left")
        best_pct, best_name = div(F.col("price") * 100, F.col("best_price")), initcap(F.col("best_region"))
    if current_region is not None:
        rows = rows.join(compare_region_price(t, current_region), "part_id", "left")
        here_pct, here_name = div(F.col("here_price") * 100, F.col("price")), initcap(F.col("here_region"))
    cents = F.col("price").cast("decimal(15,0)")
    return rows.select(
        initcap(F.when(F.col("_ore"), readable_ore(F.col("label"))).otherwise(F.col("label"))).alias("part"),
        initcap(F.lit(keyword)).alias("keyword"),
        initcap(F.col("name_region")).alias("region"),
        best_pct.alias("of_best_buy_pct"), best_name.alias("of_best_buy_region"),
        F.col("price").alias("sellers"),
        here_pct.alias("compares_pct"), here_name.alias("compares_region"),
        (cents * F.lit(Decimal("1.02"))).alias("premium_two"),
        (cents * F.lit(Decimal("1.04"))).alias("premium_four"),
    ).orderBy("part")


# --- material lists -------------------------------------------------------------------


def _shortage(needed: Column, held: Column) -> Column:
    return F.when(needed - held > 0, (needed - held).cast(QUANTITY))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("part_id").agg(
        F.sum("q_orig").cast(QUANTITY).alias("quantity_orig"), F.sum("q_copy").cast(QUANTITY).alias("quantity"))


def _stocked_and_priced(demand: DataFrame, t: Tables, local: DataFrame | None, short_only: bool,
                        keep_unquoted: bool) -> DataFrame:
    items = demand.join(t.parts.select("part_id", "label", "volume", "pile"), "part_id")
    rows = with_best_offer(items, t, local, keep_unquoted).withColumn(
        "short", _shortage(F.col("quantity"), F.col("pile")))
    if short_only:
        rows = rows.where(F.col("quantity") - F.col("pile") > 0)
    # at most one row per item, read three times: for the rows and for both grand totals
    return materialize(rows, "material-rows")


def grand_total(rows: DataFrame, value: Column) -> Column:
    """The sum over all rows, to be shown on each: a scalar subquery, not a one-task window."""
    return rows.agg(value.alias("_total")).scalar()


def _load_total(rows: DataFrame, quantity: str, capacity_m3: int) -> Column:
    """Percent of a hold filled by all rows together, rounded once to one decimal."""
    milli = whole(F.col("volume").cast("decimal(13,3)") * F.lit(Decimal(1000))).cast("decimal(13,0)")
    load = whole(F.sum(whole(milli * micro(F.col(quantity)).cast("decimal(20,0)"))))
    share = half_up(whole(load * F.lit(Decimal(1000))), F.lit(Decimal(capacity_m3) * 10**9).cast(WHOLE))
    return grand_total(rows, tenth_power(share, 1))


def _shown(lists: Sequence[str | None] | DataFrame) -> Column:
    """The lists as given, or how many a table of them holds."""
    if isinstance(lists, DataFrame):
        return lists.agg(F.concat(F.count(F.lit(1)), F.lit(" lists"))).scalar()
    return F.lit(" ".join(text or "" for text in lists))


def _list_columns(rows: DataFrame, t: Tables, lists: Sequence[str | None] | DataFrame, keyword: str | None) -> list[Column]:
    spent = F.sum(value_micro(F.col("price"), F.col("short"))).cast(WIDE_MONEY)
    return [
        _shown(lists).alias("params"),
        initcap(F.lit(keyword).cast("string")).alias("keyword"),
        initcap(F.col("label")).alias("part"),
        "quantity_orig", "quantity", "pile", F.col("short").alias("shop_list"),
        F.col("price").alias("quote"), initcap(F.col("name_region")).alias("region"),
        grand_total(rows, spent).alias("items_tot"),
        cargo_share(F.col("volume"), F.col("short"), t.params.deep_transport_m3, 2).alias("item_dst_cargo"),
    ]


def materials_for_builds(t: Tables, lists: Sequence[str | None] | DataFrame, keyword: str | None = None,
                         bpc_runs: int | None = None, local: DataFrame | None = None,
                         short_only: bool = False, keep_unquoted: bool = False) -> DataFrame:
    """Everything the listed builds take, at all depths: need, stock, shortage, cost, cargo."""
    roots = build_units(t, lists).withColumnRenamed("part_id", "produce_id")
    paths = with_tag(t.paths.join(roots, "produce_id"), t.tags, keyword)
    runs = None if bpc_runs is None else F.lit(bpc_runs).cast("bigint")
    demand = _summed(bom_quantity(paths, F.col("units"), runs))
    rows = _stocked_and_priced(demand, t, local, short_only, keep_unquoted).join(
        has_keyword(t.tags, "COMPONENTS").withColumn("_component", F.lit(True)), "part_id", "left")
    job = F.concat(F.format_number(F.round("short", 0).cast("bigint"), 0), F.lit("  "), initcap(F.col("label")))
    return rows.select(
        *_list_columns(rows, t, lists, keyword),
        _load_total(rows, "quantity", t.params.build_list_transport_m3).alias("total_dst_cargo"),
        F.when(F.col("_component") & (F.col("short") > 0), job).alias("job_list"),
    ).orderBy("part")


def component_demand(t: Tables, lists: Sequence[str | None] | DataFrame, bpc_runs: int | None = None) -> DataFrame:
    """(part_id, units_orig, units_copy): what the listed goods take, summed over all builds.

    Rows are chosen by the good an input goes into, wherever that good stands in a tree, so
    a listed item that is also an intermediate counts once per path to it.
    """
    goods = build_units(t, lists).withColumnRenamed("part_id", "good_id")
    runs = None if bpc_runs is None else F.lit(bpc_runs).cast("bigint")
    demand = _summed(bom_quantity(t.paths.join(goods, "good_id"), F.col("units"), runs))
    return demand.select("part_id", F.col("quantity_orig").alias("units_orig"), F.col("quantity").alias("units_copy"))


def components_rebuild(t: Tables, demand: DataFrame, keyword: str | None = None) -> DataFrame:
    """The summed components taken apart again, each in one job for all builds."""
    roots = demand.withColumnRenamed("part_id", "produce_id")
    paths = with_tag(t.paths.join(roots, "produce_id"), t.tags, keyword)
    return _summed(paths.withColumns({
        "q_orig": evaluate(F.col("units_orig")).cast(QUANTITY),
        "q_copy": evaluate(F.col("units_copy")).cast(QUANTITY),
    }))


def materials_three_tier(t: Tables, lists: Sequence[str | None] | DataFrame, keyword: str | None = None,
                         bpc_runs: int | None = None, local: DataFrame | None = None,
                         short_only: bool = False, keep_unquoted: bool = False) -> DataFrame:
    """Materials when components shared by the builds are made together."""
    demand = components_rebuild(t, component_demand(t, lists, bpc_runs), keyword)
    rows = _stocked_and_priced(demand, t, local, short_only, keep_unquoted)
    return rows.select(
        *_list_columns(rows, t, lists, keyword),
        _load_total(rows, "short", t.params.deep_transport_m3).alias("total_dst_cargo"),
    ).orderBy("part")


# --- ore, blueprints, prices ----------------------------------------------------------


def ore_yields(t: Tables, yield_m3: Decimal, sell_region: str | None = None) -> DataFrame:
    """What ``yield_m3`` of every ore gives, with the bids of matching regions."""
    ores = with_tag(t.parts, t.tags, "ORE").select(
        F.col("part_id").alias("good_id"), F.col("label").alias("label_ore"), F.col("volume").alias("volume_ore"))
    minerals = t.parts.select("part_id", F.col("label").alias("label_mineral"))
    amount = F.lit(yield_m3).cast("decimal(18,6)") / F.col("volume_ore")
    bids = t.buys.where(contains_text(F.col("name_region"), sell_region))
    return (
        t.paths.join(ores, "good_id")
        .withColumn("repcor", evaluate(amount).cast(QUANTITY))
        .select("good_id", "label_ore", "part_id", "repcor")
        .join(minerals, "part_id")
        .join(bids.select("part_id", "bids_high_range", "name_region"), "part_id")
    )


def ore_value(yields: DataFrame) -> DataFrame:
    """Sum per ore of the yields' bid values, each rounded to a whole amount (in cents)."""
    value = half_up(micro(value_micro(F.col("bids_high_range"), F.col("repcor"))), F.lit(Decimal(100_000_000)).cast(WHOLE)) * 100
    return yields.groupBy("good_id").agg(F.sum(value).alias("value_index"))


def ore_ranking(t: Tables, yield_m3: Decimal, sell_region: str | None = None) -> DataFrame:
    """Ores by the value of their minerals for a fixed volume."""
    yields = materialize(ore_yields(t, yield_m3, sell_region), "ore-yields")
    return (
        yields.join(ore_value(yields), "good_id")
        .select(
            initcap(readable_ore(F.col("label_ore"))).alias("ore"), "repcor",
            initcap(F.col("label_mineral")).alias("mineral"), F.col("bids_high_range").alias("bid"),
            initcap(F.col("name_region")).alias("region"), "value_index")
        .distinct()
        .orderBy(F.desc("value_index"), "ore", "mineral", "region", "repcor")
    )


def blueprint_pipeline(t: Tables, jobs: DataFrame, now: datetime) -> DataFrame:
    """Blueprints, scarcest first, with the invention jobs under way and the time left."""
    prints = without_tags(with_tag(t.parts, t.tags, "BLUEPRINTS"), t.tags, ["CONTRACTS"])
    running = jobs.withColumnRenamed("product_type_id", "external_id")
    return (
        prints.select("label", "pile", "external_id").join(running, "external_id", "left")
        .select("label", "pile", "installer_name", "blueprint_type_name", "runs", "licensed_runs", "probability",
                (F.col("date_end") - F.lit(now).cast("timestamp_ntz")).alias("ready_in_days"))
        .orderBy(F.asc_nulls_first("pile"), "label", "ready_in_days")
    )


def practical_price(t: Tables, part: str | None = None, per_region: bool = False) -> DataFrame:
    """Lowest offer, best practical price and average practical price per item."""
    named = t.parts.where(contains_text(F.col("label"), part)).select("part_id", "label")
    rows = named.join(t.sells, "part_id")
    keys = ["label", "name_region"] if per_region else ["label"]
    figures = rows.groupBy(*keys).agg(
        F.min("lowest_offer").alias("lowest_offer"), F.min("offers_low_range").alias("best_practical"),
        F.sum("offers_low_range").alias("_sum"), F.count("offers_low_range").alias("_n"))
    region = [initcap(F.col("name_region")).alias("regions")] if per_region else []
    return figures.select(
        initcap(F.col("label")).alias("part"), "lowest_offer", "best_practical",
        half_up(F.col("_sum"), F.col("_n")).alias("avg_low_all_regions"), *region,
    ).orderBy("avg_low_all_regions", "part")


def part_price_listing(t: Tables, part: str, region: str | None = None) -> DataFrame:
    """All regional offers of the items whose label is like ``part`` (% and _ are wildcards)."""
    named = t.parts.where(F.col("label").like(part.upper())).select("part_id", "label")
    sells = t.sells if region is None else t.sells.where(F.col("name_region") == region)
    return named.join(sells, "part_id").select("label", *sells.columns).orderBy("offers_low_range", "label", "region")
