"""Reports on what to build and what it costs."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from millwright.functions.numbers import (
    adjusted_offer_x200, breakeven_micro, cargo_share, div, from_micro, greatest_or_null, half_up, micro,
    per_cent_exact, value_micro, whole,
)
from millwright.functions.text import contains_text, initcap
from millwright.operators.bom import bom_quantity, direct_parts_tagged, evaluate, leaf_paths
from millwright.operators.market import in_local
from millwright.operators.tags import with_tag, without_tags
from millwright.plans.tables import Tables, best_offers, with_best_offer
from millwright.schemas import QUANTITY, WHOLE
from millwright.session import materialize


def buildable_products(t: Tables, produce: str | None = None, keyword: str | None = None) -> DataFrame:
    """Items worth asking about: by name and tag, no ore, no blueprints, and nothing that
    needs a part only sold on contract."""
    named = t.parts.where(contains_text(F.col("label"), produce))
    wanted = without_tags(with_tag(named, t.tags, keyword), t.tags, ["ORE", "BLUEPRINTS"])
    contract = direct_parts_tagged(t.edges, t.tags, "CONTRACTS").withColumnRenamed("good_id", "part_id")
    return wanted.join(contract, "part_id", "left_anti")


def product_breakeven(t: Tables, produce: str | None = None, keyword: str | None = None,
                      local_buy: DataFrame | None = None) -> DataFrame:
    """(produce_id, produce, outcome_units, break_micro): cost of one unit from its leaf
    inputs at their cheapest region, in millionths of a cent. Leaves without a price drop out."""
    goods = buildable_products(t, produce, keyword).select(
        F.col("part_id").alias("produce_id"), F.col("label").alias("produce"), "outcome_units")
    offers = best_offers(t, local_buy).where(F.col("econ_region").isNotNull()).select("part_id", "price")
    # paths are folded and summed per input before prices come in, so the step arrays
    # meet one shuffle at most and the next one carries two ids and a number
    need = (
        leaf_paths(t.paths).select("produce_id", "part_id", "steps", "round_kind")
        .join(goods, "produce_id")
        .withColumn("_need", evaluate(F.col("outcome_units")).cast(QUANTITY))
        .groupBy("produce_id", "produce", "outcome_units", "part_id").agg(F.sum("_need").cast(QUANTITY).alias("_need"))
    )
    costs = (
        need.join(offers, "part_id").withColumn("_value", value_micro(F.col("price"), F.col("_need")))
        .groupBy("produce_id", "produce", "outcome_units").agg(F.sum("_value").alias("_value"))
    )
    total = breakeven_micro(micro(F.col("_value")), F.col("outcome_units"),
                            t.params.build_cost_multiplier, t.params.sales_cost_multiplier)
    return costs.select("produce_id", "produce", "outcome_units", total.alias("break_micro"))


def sell_buy_spread(t: Tables, local_sell: DataFrame | None = None) -> DataFrame:
    """Both sides of the book per part and region, where both are quoted."""
    sells = in_local(t.sells, local_sell).select(
        "part_id", "region", "name_region", F.col("samples").alias("sells"), "lowest_offer", "offers_low_range")
    buys = t.buys.select("part_id", "region", F.col("samples").alias("buys"), "highest_bid", "bids_high_range")
    return sells.join(buys, ["part_id", "region"])


def hub_mid_spread(t: Tables) -> DataFrame:
    """(part_id, mid_spread_hub): middle of the book at the hub region, rounded to cents."""
    hub = t.params.hub_region
    book = sell_buy_spread(t).where(F.col("region") == hub)
    return book.groupBy("part_id").agg(
        half_up(F.min("lowest_offer") + F.max("highest_bid"), F.lit(2).cast("bigint")).alias("mid_spread_hub"))


def what_to_build(t: Tables, produce: str | None = None, keyword: str | None = None, adjust: int = 0,
                  local_buy: DataFrame | None = None, local_sell: DataFrame | None = None,
                  notable_demand: bool = False, bids_near_break: bool = False,
                  offers_above_break: bool = False) -> DataFrame:
    """Margin of every product in every region where it is both offered and bid for.

    ``adjust`` places the asking price between the highest bid (-100), the middle (0) and
    the lowest offer (100). The three thresholds are off by default, and never apply to a
    search by name.
    """
    cost = product_breakeven(t, produce, keyword, local_buy).withColumnRenamed("produce_id", "part_id")
    rows = cost.join(sell_buy_spread(t, local_sell), "part_id").join(hub_mid_spread(t), "part_id", "left")
    brk = F.col("break_micro")
    if produce is None:
        million = F.lit(Decimal(1_000_000)).cast("decimal(7,0)")
        if notable_demand:
            rows = rows.where(whole(F.col("bids_high_range")) * F.col("buys").cast("decimal(19,0)")
                              > F.lit(Decimal(t.params.notable_demand)))
        if bids_near_break:
            rows = rows.where(whole(brk) < F.col("highest_bid").cast("decimal(18,0)") * million * F.lit(t.params.buys_max_below_break))
        if offers_above_break:
            rows = rows.where(F.col("lowest_offer").cast("decimal(18,0)") * million > brk.cast("decimal(20,0)") * F.lit(t.params.sells_min_above_break))
    asked_x200 = adjusted_offer_x200(F.col("lowest_offer"), F.col("highest_bid"), adjust)
    asked = asked_x200 * 5000  # in millionths
    hub = F.col("mid_spread_hub") * 1_000_000
    margin = per_cent_exact(greatest_or_null(asked, hub) - brk, brk, 1)
    unrounded = (greatest_or_null(asked, hub) - brk).cast("double") / brk
    # sorted before the display columns are made: the sort's sampling pass skips those
    ordered = rows.orderBy(unrounded.desc_nulls_first(), "produce", "name_region")
    return ordered.select(
        initcap(F.col("produce")).alias("produce"), initcap(F.col("name_region")).alias("region"),
        "sells", "lowest_offer", "offers_low_range", "buys", "highest_bid", "bids_high_range",
        ((F.col("lowest_offer") + F.col("highest_bid")).cast("decimal(19,0)") * F.lit(Decimal("0.5"))).alias("mid_spread"),
        F.lit(adjust).alias("adj"),
        (asked_x200.cast("decimal(19,0)") * F.lit(Decimal("0.005"))).alias("my_adjusted_offer"),
        F.col("mid_spread_hub").alias("mid_spread_jita"),
        from_micro(brk).alias("break"),
        (F.col("buys") * F.col("bids_high_range")).alias("demand"),
        margin.alias("margin"),
    )


def buy_it_price(t: Tables, local_sell: DataFrame | None = None) -> DataFrame:
    """(part_id, buy_price): what the finished item costs in its cheapest region."""
    return best_offers(t, local_sell).where(F.col("econ_region").isNotNull()).select(
        "part_id", F.col("price").alias("buy_price"))


def _whole_money(value: Column) -> Column:
    """Millionths of a cent as cents, rounded to a whole amount."""
    return half_up(value, F.lit(Decimal(100_000_000)).cast(WHOLE)) * 100


def product_cost_breakdown(t: Tables, produce: str, units: int, bpc_runs: int | None = None,
                           local_buy: DataFrame | None = None, local_sell: DataFrame | None = None,
                           keep_unquoted: bool = False) -> DataFrame:
    """Cost, share and shortage of every leaf input of the matching products."""
    if units < 1:
        raise ValueError("units must be at least 1")
    goods = t.parts.where(contains_text(F.col("label"), produce)).select(
        F.col("part_id").alias("produce_id"), F.col("label").alias("produce"))
    runs = None if bpc_runs is None else F.lit(bpc_runs).cast("bigint")
    need = (
        bom_quantity(leaf_paths(t.paths).join(goods, "produce_id"), F.lit(units).cast("bigint"), runs)
        .groupBy("produce_id", "produce", "part_id").agg(F.sum("q_copy").cast(QUANTITY).alias("quantity"))
        .join(t.parts.select("part_id", F.col("label").alias("part"), "volume", "pile"), "part_id")
    )
    rows = with_best_offer(need, t, local_buy, keep_unquoted).withColumn(
        "_value", micro(value_micro(F.col("price"), F.col("quantity"))))
    # used twice, for the totals and for the rows: written once instead of folded twice
    rows = materialize(rows, "cost-rows")
    totals = rows.groupBy("produce_id").agg(F.sum("_value").cast(WHOLE).alias("_total"))
    finished = buy_it_price(t, local_sell).withColumnRenamed("part_id", "produce_id")
    rows = rows.join(totals, "produce_id").join(finished, "produce_id", "left").withColumn(
        "items_tot", _whole_money(F.col("_value")))

    held_short = F.when(F.col("quantity") - F.col("pile") > 0, (F.col("quantity") - F.col("pile")).cast(QUANTITY))
    factor = Decimal(int(t.params.build_cost_multiplier * 100) * int(t.params.sales_cost_multiplier * 100))
    step = F.lit(Decimal(10**12)).cast(WHOLE)  # 10^4 for the two multipliers, 10^8 for whole money
    break_total = div(whole(whole(F.col("_total") * F.lit(factor)) + step - 1), step) * 100
    goods_total = _whole_money(F.col("_total"))
    size = F.lit(units).cast("bigint")
    ordered = rows.orderBy("produce", F.desc_nulls_first("items_tot"), "part", "produce_id", "part_id")
    return ordered.select(
        F.concat(F.lit(f"{units}x "), initcap(F.substring("produce", 1, 22))).alias("produce"),
        initcap(F.substring("part", 1, 22)).alias("part"),
        "produce_id", "part_id", "quantity", "pile", held_short.alias("short"),
        cargo_share(F.col("volume"), held_short, t.params.deep_transport_m3, 1).alias("dst"),
        cargo_share(F.col("volume"), held_short, t.params.jump_freighter_m3, 1).alias("jf"),
        F.col("price").alias("quote"), initcap(F.substring("name_region", 1, 15)).alias("region"),
        "items_tot",
        half_up(whole(F.col("_value") * 100), F.nullif(F.col("_total"), F.lit(Decimal(0)).cast(WHOLE))).alias("pct"),
        goods_total.alias("goods_tot"), break_total.alias("break"),
        (F.col("buy_price") * units).alias("just_buy_it"),
        half_up(goods_total, size).alias("goods_unit"),
        half_up(goods_total * 93, size * 100).alias("dsconut_seven"),
        half_up(break_total, size).alias("break_unit"),
        F.col("buy_price").alias("just_buy_one"),
    )


def cost_share(t: Tables, produce: str | None, units: int) -> DataFrame:
    """(produce_id, part_id, pct, goods_tot): each leaf input's share of its product's cost."""
    return product_cost_breakdown(t, produce, units).select("produce_id", "part_id", "pct", "goods_tot")
