"""Order-book analytics: relevance, depth-limited prices, cheapest regions."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from millwright.functions.numbers import div, half_up, whole
from millwright.functions.text import first_word
from millwright.operators.numbering import number_by_key
from millwright.operators.tags import without_tags
from millwright.params import Params
from millwright.schemas import WHOLE
from millwright.session import materialize

GROUP = ["part_id", "direction", "region"]


def relevant_orders(quotes: DataFrame, now: datetime, security: Decimal, params: Params = Params()) -> DataFrame:
    """Quotes in secure enough places that stay open for more than the relevancy days."""
    horizon = F.lit(now).cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(params.order_relevancy_days))
    return (
        quotes.where((F.col("security") >= F.lit(security)) & (F.col("expires").cast("timestamp_ntz") > horizon))
        .withColumn("system_name", first_word(F.col("station_name")))
    )


# --- depth-limited average ------------------------------------------------------------


def _acceptable() -> Column:
    keys = F.col("part_id").isNotNull() & F.col("region").isNotNull() & F.col("direction").isin("SELL", "BUY")
    return F.coalesce(keys & (F.col("price") > 0) & (F.col("quantity") > 0), F.lit(False))


def valid_orders(orders: DataFrame) -> DataFrame:
    """Orders with all group keys, a known direction, and a price and quantity above zero."""
    return orders.where(_acceptable())


def rejected_orders(orders: DataFrame) -> DataFrame:
    """The orders no price is made of: the complement of ``valid_orders``."""
    return orders.where(~_acceptable())


def _worth() -> Column:
    """Price times quantity, wide enough for any two longs that make sense together."""
    return whole(F.col("price").cast("decimal(19,0)") * F.col("quantity").cast("decimal(19,0)"))


def _signed(price: Column) -> Column:
    """Sort key that puts the best price first: low for SELL, high for BUY."""
    return F.when(F.col("direction") == "SELL", price).otherwise(-price)


def _ranked(levels: DataFrame) -> DataFrame:
    """Levels with the key their group is walked by, as a column, so that windows one after the other share a sort."""
    return levels.withColumn("_rank", _signed(F.col("price")))


def _cap(params: Params) -> Column:
    return F.when(F.col("direction") == "SELL", F.lit(params.supply_depth)).otherwise(F.lit(params.demand_depth))


def _believable(price: Column, top: Column, params: Params) -> Column:
    """Not so far from the best price that it must be an anomaly."""
    limit = F.lit(params.spread_overshoot)
    return F.when(F.col("direction") == "SELL", price <= top * limit).otherwise(price * 100 >= top * limit)


def _figures(taken: DataFrame, params: Params) -> DataFrame:
    """Final figures from per-group sums; a SELL must be worth the trip."""
    figures = taken.select(
        *GROUP,
        F.col("qty").cast("bigint").alias("samples"),
        "price_top",
        half_up(F.col("value"), F.col("qty")).alias("price_average"),
    )
    return _notable(figures, params)


def _notable(figures: DataFrame, params: Params) -> DataFrame:
    worth = whole(F.col("price_average")) * F.col("samples").cast("decimal(19,0)")
    return figures.where((F.col("direction") == "BUY") | (worth > F.lit(Decimal(params.notable_supply))))


LEADING_BITS = 12


def _bits(col: Column) -> Column:
    return F.length(F.bin(col))


def _coarse(col: Column) -> Column:
    """A positive integer with all but its leading bits cleared: an order-preserving bucket.

    At most 2^11 buckets per power of two, and a bucket spans at most 1/2^11 of its values.
    """
    shift = F.greatest(_bits(col) - LEADING_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", col, shift), shift)


def _levels(orders: DataFrame) -> DataFrame:
    """Orders counted per (group, price, quantity), with map-side combine; equal ones are interchangeable."""
    return materialize(orders.groupBy(*GROUP, "price", "quantity").agg(F.count(F.lit(1)).alias("n")), "levels")


def _bounds() -> list[Column]:
    return [F.count(F.lit(1)).alias("_levels"), F.min("price").alias("_low"), F.max("price").alias("_high"),
            F.min("quantity").alias("_least"), F.max("quantity").alias("_most")]


def _sums() -> list[Column]:
    qty = whole(F.col("quantity")) * F.col("n").cast("decimal(19,0)")
    return [F.sum(whole(qty)).cast(WHOLE).alias("qty"),
            F.sum(whole(whole(qty) * F.col("price").cast("decimal(19,0)"))).cast(WHOLE).alias("value")]


def _near() -> Column:
    return F.when(F.col("direction") == "SELL", F.col("_low")).otherwise(F.col("_high"))


def _groups(levels: DataFrame) -> DataFrame:
    """One row per group: its levels, their bounds and the best price; the cell every cut is looked for in first."""
    return materialize(levels.groupBy(*GROUP).agg(*_bounds()).withColumn("price_top", _near())
                       .withColumn("_offset", F.lit(Decimal(0)).cast(WHOLE)), "groups")


def _cut(cells: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """Cells before the cut, and the one cell per group the cut falls in, with the value before it."""
    cap = _cap(params).cast(WHOLE)
    before = Window.partitionBy(*GROUP).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("_prior", whole(F.col("_offset") + F.coalesce(F.sum("value").over(before), F.lit(Decimal(0)))))
    started = materialize(placed.where(F.col("_prior") < cap).withColumn("_complete", whole(F.col("_prior") + F.col("value")) < cap), "cells")
    cut = started.where(~F.col("_complete")).select(
        *GROUP, "price_top", F.col("_prior").alias("_offset"), "_levels", "_low", "_high", "_least", "_most")
    return started.where("_complete").select(*GROUP, "price_top", "qty", "value"), cut


def _inside(levels: DataFrame, cut: DataFrame, params: Params) -> DataFrame:
    """The believable levels of the cells the cut falls in, with the bounds of the cell."""
    return levels.join(cut, GROUP).where(
        F.col("price").between(F.col("_low"), F.col("_high")) & F.col("quantity").between(F.col("_least"), F.col("_most"))
        & _believable(F.col("price"), F.col("price_top"), params))


def _depth_by_cells(levels: DataFrame, params: Params) -> DataFrame:
    """Figures from cell totals, narrowed until the cell of the cut is small.

    A group is one cell at first. While a cell holds more than ``cell_rows`` levels, its price range, and once that is one
    price its quantity range, is divided by the next ``radix_bits`` bits: parts before the cut count as a whole, the one part
    the cut falls in goes on. So no window sees more than ``cell_rows`` levels or 2^``radix_bits`` + 1 parts of a group,
    whatever the number of orders and however close their prices, and only small cells are sorted.
    """
    cut, pool, parts = _groups(levels), levels, []
    while True:
        large = cut.where(F.col("_levels") > params.cell_rows)
        if large.isEmpty():
            break
        parts.append(_last_cell(_ranked(_inside(pool, cut.where(F.col("_levels") <= params.cell_rows), params)), params))
        pool = materialize(_inside(pool, large, params), "levels")
        by_price = F.col("_low") < F.col("_high")
        width = F.when(by_price, F.col("_high") - F.col("_low")).otherwise(F.col("_most") - F.col("_least"))
        from_best = F.when(F.col("direction") == "SELL", F.col("price") - F.col("_low")).otherwise(F.col("_high") - F.col("price"))
        place = F.when(by_price, from_best).otherwise(F.col("quantity") - F.col("_least"))
        part = F.call_function("shiftright", place, F.greatest(_bits(width) - params.radix_bits, F.lit(0)))
        settled, cut = _cut(pool.groupBy(*GROUP, "price_top", "_offset", part.alias("_part")).agg(*_sums(), *_bounds()), params)
        parts.append(settled)
        pool = pool.select(*levels.columns)
    parts.append(_last_cell(_ranked(_inside(pool, cut, params)), params))
    taken = parts[0]
    for more in parts[1:]:
        taken = taken.unionByName(more)
    return _figures(taken.groupBy(*GROUP, "price_top").agg(F.sum("qty").cast(WHOLE).alias("qty"), F.sum("value").cast(WHOLE).alias("value")), params)


def _depth_by_groups(orders: DataFrame, total: int, params: Params) -> DataFrame:
    """Figures of groups of at most ``cell_rows`` orders: brought together once, cut and summed where they meet.

    The number of tasks follows the number of orders, so what one task sorts does not grow with the input.
    """
    tasks = max(orders.sparkSession.sparkContext.defaultParallelism, total // params.task_rows + 1)
    met = orders.select(*GROUP, "price", "quantity").repartition(tasks, *GROUP)
    if max(params.supply_depth, params.demand_depth) * params.cell_rows < 2**62:
        return _figures(_taken_in_longs(met, params), params)
    levels = _ranked(met.groupBy(*GROUP, "price", "quantity").agg(F.count(F.lit(1)).alias("n")))
    walk = Window.partitionBy(*GROUP).orderBy("_rank", "quantity").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = levels.withColumn("price_top", F.first("price").over(walk)).withColumn("_offset", F.lit(Decimal(0)).cast(WHOLE))
    taken = _last_cell(rows.where(_believable(F.col("price"), F.col("price_top"), params)), params)
    return _figures(taken.groupBy(*GROUP, "price_top").agg(F.sum("qty").cast(WHOLE).alias("qty"), F.sum("value").cast(WHOLE).alias("value")), params)


def _taken_in_longs(met: DataFrame, params: Params) -> DataFrame:
    """What is taken of groups that meet in a task, order by order, in 64-bit sums.

    An order worth the cap or more counts as the cap while the value before each order is summed: the sum stays below the cap
    exactly where the true one does, and is the same there. Such an order is the last one taken; its own worth is a decimal.
    Orders that are not believable come behind all others of their group, so they add nothing to the value before one that is.
    """
    cap = _cap(params).cast("bigint")
    dear = F.col("quantity") > div(cap, F.col("price"))
    walk = Window.partitionBy(*GROUP).orderBy("_rank", "quantity")
    rows = _ranked(met).withColumn("_each", F.when(dear, cap).otherwise(F.col("price") * F.col("quantity"))).withColumns({
        "price_top": F.first("price").over(walk.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_prior": F.coalesce(F.sum("_each").over(walk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))})
    started = rows.where((F.col("_prior") < cap) & _believable(F.col("price"), F.col("price_top"), params))
    sums = started.groupBy(*GROUP, "price_top").agg(
        F.sum("quantity").alias("qty"), F.sum(F.when(dear, F.lit(0)).otherwise(F.col("_each"))).alias("_plain"), F.max(F.when(dear, _worth())).alias("_dear"))
    value = whole(whole(F.col("_plain")) + F.coalesce(F.col("_dear"), F.lit(Decimal(0)).cast(WHOLE)))
    return sums.select(*GROUP, "price_top", whole(F.col("qty")).alias("qty"), value.alias("value"))


def _last_cell(rows: DataFrame, params: Params) -> DataFrame:
    """What is taken of the few ranked levels of a group's last cell: of equal orders as many as it takes to reach the cap."""
    each = whole(F.col("quantity").cast("decimal(19,0)") * F.col("price").cast("decimal(19,0)"))
    before = Window.partitionBy(*GROUP).orderBy("_rank", "quantity").rowsBetween(Window.unboundedPreceding, -1)
    worth = whole(each * F.col("n").cast("decimal(19,0)"))
    prior = whole(F.col("_offset") + F.coalesce(F.sum(worth).over(before), F.lit(Decimal(0))))
    cap = _cap(params).cast(WHOLE)
    started = rows.withColumn("_prior", prior).where(F.col("_prior") < cap)
    taken = F.least(div(whole(cap - F.col("_prior") + each - 1), each), F.col("n")).cast("decimal(19,0)")
    return started.select(*GROUP, "price_top", whole(taken * F.col("quantity").cast("decimal(19,0)")).alias("qty"),
                          whole(taken * whole(each)).alias("value"))


def order_depth_average(orders: DataFrame, params: Params = Params(), exact_steps: bool = False) -> DataFrame:
    """Practical price per part, direction and region.

    Walks orders best price first; stops before an anomalous price and after the cumulative
    value reaches the depth cap. Emits samples (quantity), price_top and price_average, the
    average as an exact ratio rounded once. SELL groups below the notable value are left out.

    Only ``valid_orders`` take part; the others are what ``rejected_orders`` returns. Orders are counted per part first. Those of
    parts with no more than ``cell_rows`` orders meet by group in one shuffle; those of busier parts are counted per
    (price, quantity) and go by cells. Both ways give the same figures. ``exact_steps`` rounds the running average to cents
    after every order instead.
    """
    valid = valid_orders(orders)
    if exact_steps:
        return _depth_by_steps(_levels(valid), params)
    counts = materialize(valid.groupBy("part_id").agg(F.count(F.lit(1)).alias("_orders")), "order-counts")
    total = counts.agg(F.sum("_orders")).first()[0] or 0
    busy = materialize(counts.where(F.col("_orders") > params.cell_rows).select("part_id"), "busy-parts")
    if busy.isEmpty():
        return _depth_by_groups(valid, total, params)
    return _depth_by_groups(valid.join(busy, "part_id", "left_anti"), total, params).unionByName(
        _depth_by_cells(_levels(valid.join(busy, "part_id", "left_semi")), params))


# --- average rounded at every order ---------------------------------------------------


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _walked_prefixes(levels: DataFrame, params: Params) -> DataFrame:
    """(group, price_top, _cut, _levels): rank of the last price bucket the walk can reach, and the levels up to it.

    Bucket by bucket, the running average is at least the larger of two bounds. It never leaves the prices walked: it
    only rises (SELL), or stays above the lowest price so far (BUY). And each rounding takes at most half a cent per unit held,
    which is added up over the walked prefix only. Once the bound times the units reaches the cap, the walk has ended.
    What meets per group is a row per bucket of leading price bits; their number depends on the number format alone.
    """
    cells = (levels.groupBy(*GROUP, _coarse(F.col("price")).alias("_cell")).agg(*_sums(), *_bounds(), F.sum("n").alias("_orders"))
             .withColumn("_rank", _signed(F.col("_cell"))))
    buckets = F.array_sort(F.collect_list(F.struct("_rank", "_low", "_orders", "_levels", "qty", "value")))
    cap, sell = _cap(params).cast(WHOLE), F.col("direction") == "SELL"
    state = lambda low, units, cut, held, over: F.struct(
        whole(low).alias("low"), whole(units).alias("units"), cut.cast("bigint").alias("cut"), held.cast("bigint").alias("held"), over.alias("over"))
    start = state(F.lit(Decimal(0)), F.lit(Decimal(0)), F.lit(0), F.lit(0), F.lit(False))

    def step(s: Column, c: Column) -> Column:
        units = whole(s["units"] + c["qty"])
        drifted = div(whole(whole(whole(s["low"] * s["units"]) + c["value"]) * 2) - whole(c["_orders"].cast("decimal(19,0)") * units), whole(units * 2))
        held = F.when(sell & (s["units"] > 0), s["low"]).otherwise(whole(c["_low"]))
        low = F.greatest(held, whole(drifted))
        return F.when(s["over"], s).otherwise(_let(F.struct(whole(low).alias("low"), units.alias("units")), lambda b: state(
            b["low"], b["units"], c["_rank"], s["held"] + c["_levels"], whole(b["low"] * b["units"]) >= cap)))

    return (cells.groupBy(*GROUP).agg(buckets.alias("_buckets"), F.min("_low").alias("_low"), F.max("_high").alias("_high"))
            .withColumn("_end", F.aggregate("_buckets", start, step))
            .select(*GROUP, _near().alias("price_top"), F.col("_end.cut").alias("_cut"), F.col("_end.held").alias("_levels")))


_WALK = "struct<average:decimal(38,0),units:decimal(38,0),over:boolean,rest:bigint>"


def _walk(steps: Column, start: Column, cap: Column) -> Column:
    """The state after walking sorted levels (rank, quantity, price, n): average, units, and whether the cap is reached.

    Equal orders pull the average towards their price, each at least a cent or nothing; once one leaves it where it is, so do
    the rest, and those are added at once.
    """
    state = lambda average, units, over, rest: F.struct(
        whole(average).alias("average"), whole(units).alias("units"), over.alias("over"), rest.cast("bigint").alias("rest"))

    def one(s: Column, level: Column) -> Column:
        price, quantity = whole(level["price"]), whole(level["quantity"])
        units = whole(s["units"] + quantity)
        value = whole(whole(s["average"] * s["units"]) + whole(price * quantity))
        next_ = F.struct(whole(div(whole(whole(value * 2) + units), whole(units * 2))).alias("average"), units.alias("units"))

        def moved(x: Column) -> Column:
            each = whole(x["average"] * quantity)
            needed = div(whole(cap - whole(x["average"] * s["units"]) + each - 1), each)
            same = F.greatest(F.least(needed, s["rest"]), F.lit(1))
            after = whole(s["units"] + whole(whole(same) * quantity))
            return F.when(x["average"] == s["average"], state(x["average"], after, whole(x["average"] * after) >= cap, F.lit(0))).otherwise(
                state(x["average"], x["units"], whole(x["average"] * x["units"]) >= cap, s["rest"] - 1))

        return F.when(s["over"] | (s["rest"] == 0), s).otherwise(_let(next_, moved))

    def level_after(s: Column, level: Column) -> Column:
        some = lambda t: F.aggregate(F.sequence(F.lit(1), F.least(t["rest"], F.lit(1024)).cast("int")), t, lambda u, _: one(u, level))
        rounds = F.sequence(F.lit(1).cast("bigint"), F.ceil(level["n"] / 1024))
        begun = state(s["average"], s["units"], s["over"], level["n"])
        return F.when(s["over"], s).otherwise(F.aggregate(
            rounds, begun, lambda t, _: F.when(t["over"] | (t["rest"] == 0), t).otherwise(some(t))))

    return F.aggregate(steps, start, level_after)


def _depth_by_steps(levels: DataFrame, params: Params) -> DataFrame:
    """The running average rounded to cents at every order.

    Rounding at each order makes this sequential within a group. In groups of more than ``cell_rows`` levels, bucket totals first
    tell how far the walk can get. The levels up to there are folded natively, one array per group. A group with more than
    ``piece_rows`` of them is range-partitioned by price and quantity, and folded piece after piece, so no array grows with the
    group; the pieces of all such groups advance together.
    """
    cap = _cap(params).cast(WHOLE)
    groups = _groups(levels)
    ends = groups.where(F.col("_levels") <= params.cell_rows).select(*GROUP, "price_top", F.lit(None).cast("bigint").alias("_cut"), "_levels")
    many = groups.where(F.col("_levels") > params.cell_rows).select(*GROUP)
    if not many.isEmpty():
        ends = ends.unionByName(materialize(_walked_prefixes(levels.join(many, GROUP, "left_semi"), params), "walked-prefixes"))
    step = F.struct(_signed(F.col("price")).alias("rank"), "quantity", "price", "n")
    reached = F.col("_cut").isNull() | (_signed(_coarse(F.col("price"))) <= F.col("_cut"))
    rows = levels.join(ends, GROUP).where(reached & _believable(F.col("price"), F.col("price_top"), params))
    start = F.struct(F.lit(0).alias("average"), F.lit(0).alias("units"), F.lit(False).alias("over"), F.lit(0).alias("rest")).cast(_WALK)
    small = rows.where(F.col("_levels") <= params.piece_rows)
    ended = (small.groupBy(*GROUP, "price_top").agg(F.array_sort(F.collect_list(step)).alias("_steps"))
             .select(*GROUP, "price_top", _walk(F.col("_steps"), start, cap).alias("s")))
    large = ends.where(F.col("_levels") > params.piece_rows)
    if not large.isEmpty():
        ended = ended.unionByName(_walk_in_pieces(rows.where(F.col("_levels") > params.piece_rows), large, step, start, cap, params))
    figures = ended.select(*GROUP, F.col("s.units").cast("bigint").alias("samples"), "price_top", F.col("s.average").cast("bigint").alias("price_average"))
    return _notable(figures, params)


def _walk_in_pieces(rows: DataFrame, ends: DataFrame, step: Column, start: Column, cap: Column, params: Params) -> DataFrame:
    n = ends.agg(F.sum("_levels")).first()[0] // params.piece_rows + 1
    dealt = rows.select(*GROUP, "price_top", step.alias("step")).repartitionByRange(n, *GROUP, "step").withColumn("_range", F.spark_partition_id())
    dealt = materialize(dealt, "walk-ranges")
    number = F.row_number().over(Window.partitionBy(*GROUP).orderBy("_range"))
    pieces = materialize(dealt.select(*GROUP, "_range").distinct().withColumn("_piece", number), "walk-pieces")
    state, last = ends.select(*GROUP, "price_top", start.alias("s")), pieces.agg(F.max("_piece")).first()[0]
    for k in range(1, last + 1):
        now = dealt.join(pieces.where(F.col("_piece") == k), [*GROUP, "_range"])
        steps = now.groupBy(*GROUP).agg(F.array_sort(F.collect_list("step")).alias("_steps"))
        walked = state.join(steps, GROUP, "left").withColumn(
            "s", F.when(F.col("_steps").isNull() | F.col("s.over"), F.col("s")).otherwise(_walk(F.col("_steps"), F.col("s"), cap))).drop("_steps")
        state = materialize(walked, "walked")
        if state.where("not s.over").isEmpty():
            break
    return state


# --- regional views -------------------------------------------------------------------


def _by_region(aggregates: DataFrame, regions: DataFrame, direction: str, top: str, average: str) -> DataFrame:
    stamp = ["time_quotes_exec"] if "time_quotes_exec" in aggregates.columns else []
    return aggregates.where(F.col("direction") == direction).join(regions, "region").select(
        "part_id", "direction", "samples", F.col("price_top").alias(top), F.col("price_average").alias(average),
        *stamp, "region", "name_region")


def sells_by_region(aggregates: DataFrame, regions: DataFrame) -> DataFrame:
    return _by_region(aggregates, regions, "SELL", "lowest_offer", "offers_low_range")


def buys_by_region(aggregates: DataFrame, regions: DataFrame) -> DataFrame:
    return _by_region(aggregates, regions, "BUY", "highest_bid", "bids_high_range")


def local_regions(regions: DataFrame, text: str | None) -> DataFrame:
    """Regions whose name occurs in the parameter text."""
    return regions.where(F.instr(F.lit(text), F.col("name_region")) > 0).select("region")


def in_local(df: DataFrame, local: DataFrame | None) -> DataFrame:
    """Rows in a local region, or all rows when there is no restriction."""
    return df if local is None else df.join(local, "region", "left_semi")


def econ_region(aggregates: DataFrame, direction: str, local: DataFrame | None = None) -> DataFrame:
    """Cheapest (SELL) or dearest (BUY) region of every part; the lower id wins a tie."""
    price = F.col("price_average") if direction == "SELL" else -F.col("price_average")
    best = F.min(F.struct(price.alias("_key"), "region", "price_average"))
    return (
        in_local(aggregates.where(F.col("direction") == direction), local)
        .groupBy("part_id").agg(best.alias("_best"))
        .select("part_id", "_best.region", "_best.price_average")
    )


def stale_items(parts: DataFrame, tags: DataFrame, cache: DataFrame, now: datetime, per_batch: int = 5) -> DataFrame:
    """Items whose order book must be fetched again, numbered into fetch batches.

    Items with an external id, neither contract goods nor blueprints, whose cached document
    is missing or expired. ``batch`` = row number / ``per_batch`` rounded half up.
    """
    candidates = without_tags(parts.where(F.col("external_id").isNotNull()), tags, ["CONTRACTS", "BLUEPRINTS"])
    expiry = cache.select(F.col("item_type_id").alias("external_id"), "cached_until")
    stale = candidates.select("part_id", "external_id").join(expiry, "external_id", "left").where(
        F.col("cached_until").isNull() | (F.col("cached_until") < F.lit(now).cast("timestamp_ntz")))
    numbered = number_by_key(stale, "external_id", "item_no")
    return numbered.select(
        "part_id", "external_id", "cached_until", "item_no",
        half_up(F.col("item_no"), F.lit(per_batch).cast("bigint")).alias("batch"))
