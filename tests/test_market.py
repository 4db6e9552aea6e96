from datetime import date, datetime
from decimal import Decimal
import random

import pytest
from pyspark.sql import functions as F

from millwright import Params
from millwright.operators import market
from tests.builders import aggregates_of, orders_of, parts_of, regions_of, rows_of, tags_of

SMALL = Params(supply_depth=10_000, demand_depth=12_000, notable_supply=1_000, spread_overshoot=7)


def by_hand(orders, params, exact_steps=False):
    """One order at a time, as a clerk would."""
    groups = {}
    for part, side, region, price, quantity in orders:
        groups.setdefault((part, side, region), []).append((price, quantity))
    result = []
    for (part, side, region), book in groups.items():
        book.sort(key=lambda o: (o[0] if side == "SELL" else -o[0], o[1]))
        cap = params.supply_depth if side == "SELL" else params.demand_depth
        top, value, units, average = book[0][0], 0, 0, 0
        for price, quantity in book:
            if (side == "SELL" and price > params.spread_overshoot * top) or (
                    side == "BUY" and price * 100 < params.spread_overshoot * top):
                break
            average = (2 * (average * units + price * quantity) + units + quantity) // (2 * (units + quantity))
            value += price * quantity
            units += quantity
            if (average * units if exact_steps else value) >= cap:
                break
        if not exact_steps:
            average = (2 * value + units) // (2 * units)
        if side == "BUY" or average * units > params.notable_supply:
            result.append((part, side, region, units, top, average))
    return sorted(result)


def random_book(seed, n=400):
    r = random.Random(seed)
    return [(r.choice([1, 1, 1, 2, 3]), r.choice(["BUY", "SELL"]), r.choice([1, 2]),
             r.choice([7, 100, 100, r.randint(1, 50), r.randint(50, 5000)]), r.choice([1, 1, 5, r.randint(1, 40)]))
            for _ in range(n)]


def test_groups_that_meet_are_walked_once_in_longs(spark):
    """One window over orders, 64-bit sums; a worth beyond 64 bits counts as the cap while sums are made, and whole in the figures."""
    book = [(1, side, 1, price, quantity) for side in ("BUY", "SELL") for price, quantity in (
        (2**40, 2**40), (2**40, 2**40), (2**40 + 5, 1), (90, 100), (91, 3), (90, 2**62), (10_000, 1), (12_000, 1), (9_999, 1))]
    book += [(2, side, 1, price, quantity) for side in ("BUY", "SELL") for price, quantity in ((100, 50), (100, 50), (100, 50), (101, 20))]
    book += [(3, side, 1, price, 1) for side in ("BUY", "SELL") for price in (9_999, 10_000, 12_000, 70_000, 700)]
    groups = market._depth_by_groups(orders_of(spark, book), len(book), SMALL)
    assert sorted(rows_of(groups)) == by_hand(book, SMALL)
    plan = groups._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "count(1)" not in plan
    wide = SMALL.but(supply_depth=2**61, demand_depth=2**61)  # too many for sums in longs
    assert sorted(rows_of(market._depth_by_groups(orders_of(spark, book), len(book), wide))) == by_hand(book, wide)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("rows,bits", [(4096, 12), (1, 1), (20, 3)])
def test_depth_average(spark, seed, rows, bits):
    """Cells of any size, divided by any number of bits, give the clerk's figures."""
    book = random_book(seed, 40 if seed == 3 else 400)
    params = SMALL.but(cell_rows=rows, radix_bits=bits, supply_depth=[300, 10_000, 90_000][seed - 1])
    got = rows_of(market.order_depth_average(orders_of(spark, book), params))
    assert sorted(got) == by_hand(book, params)


@pytest.mark.parametrize("rows", [60, 150, 4096])
def test_calm_parts_go_another_way_than_busy_ones(spark, rows):
    """Parts 2 and 3 have fewer orders than part 1; wherever the border lies, the figures are the clerk's."""
    book = random_book(4)
    params = SMALL.but(cell_rows=rows, radix_bits=2)
    assert sorted(rows_of(market.order_depth_average(orders_of(spark, book), params))) == by_hand(book, params)


def test_calm_parts_meet_once(spark, monkeypatch):
    """No part has many orders: nothing as long as the orders is written on the way, and they are shuffled once."""
    written, keep = [], market.materialize
    monkeypatch.setattr(market, "materialize", lambda df, name: written.append(name) or keep(df, name))
    figures = market.order_depth_average(orders_of(spark, random_book(6)), SMALL)
    assert written == ["order-counts", "busy-parts"]
    assert figures._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_tiers_cut_inside_one_price_and_quantity(spark):
    """Ten thousand equal orders: the cap falls inside one (price, quantity)."""
    equal = spark.range(10_000).select(F.lit(1).cast("bigint").alias("part_id"), F.lit("SELL").alias("direction"),
                                       F.lit(1).cast("bigint").alias("region"), F.lit(300).cast("bigint").alias("price"),
                                       F.lit(7).cast("bigint").alias("quantity"))
    for exact_steps in (False, True):
        assert rows_of(market.order_depth_average(equal, SMALL, exact_steps)) == [(1, "SELL", 1, 35, 300, 300)]
        assert rows_of(market.order_depth_average(equal, SMALL.but(supply_depth=10**10), exact_steps)) == [(1, "SELL", 1, 70_000, 300, 300)]


def test_wide_price_range_crosses_buckets(spark):
    r = random.Random(5)
    book = [(1, side, 1, r.randint(10**6, 9 * 10**6), r.randint(1, 10**6)) for side in ("BUY", "SELL") for _ in range(300)]
    params = Params(supply_depth=10**13, demand_depth=3 * 10**13, notable_supply=0)
    expected = by_hand(book, params)
    for rows in (1, 10_000):
        assert sorted(rows_of(market.order_depth_average(orders_of(spark, book), params.but(cell_rows=rows)))) == expected


def test_close_prices_never_meet_in_one_window(spark, monkeypatch):
    """100,000 different prices within 0.02 %: cells of at most 2^8 + 1 parts, last cells of at most 50 levels."""
    sizes, cut, last = [], market._cut, market._last_cell
    monkeypatch.setattr(market, "_cut", lambda cells, p: sizes.append(("cells", cells.groupBy(*market.GROUP).count().agg(F.max("count")).first()[0])) or cut(cells, p))
    monkeypatch.setattr(market, "_last_cell", lambda rows, p: sizes.append(("last", rows.groupBy(*market.GROUP).count().agg(F.max("count")).first()[0] or 0)) or last(rows, p))
    n, base = 100_000, 1 << 40
    orders = spark.range(n).select(F.lit(1).cast("bigint").alias("part_id"), F.lit("SELL").alias("direction"), F.lit(1).cast("bigint").alias("region"),
                                   (F.lit(base) + F.col("id") * 2000).alias("price"), (F.col("id") % 7 + 1).alias("quantity"))
    params = Params(supply_depth=150_000 * base, notable_supply=0, cell_rows=50, radix_bits=8)
    [got] = rows_of(market.order_depth_average(orders, params))
    value, units, k = 0, 0, 0
    while value < params.supply_depth:
        value, units, k = value + (base + 2000 * k) * (k % 7 + 1), units + k % 7 + 1, k + 1
    assert got == (1, "SELL", 1, units, base, (2 * value + units) // (2 * units))
    assert all(n <= (257 if kind == "cells" else 50) for kind, n in sizes) and len(sizes) >= 4


@pytest.mark.parametrize("seed,rows", [(11, 1_000_000), (12, 3), (13, 20)])
def test_exact_steps(spark, seed, rows):
    """One array per group, and pieces of a few levels in turn."""
    book = random_book(seed)
    params = SMALL.but(supply_depth=40_000, demand_depth=40_000, cell_rows=rows, piece_rows=rows)
    got = rows_of(market.order_depth_average(orders_of(spark, book), params, exact_steps=True))
    assert sorted(got) == by_hand(book, params, exact_steps=True)


def test_the_walk_reads_little_more_than_it_needs(spark):
    """A hot cheap group: 200,000 orders at 500 to 2,499 cents, where rounding half a cent per order is no small thing."""
    rows = [(1, d, 1, 500 + i * 7919 % 2000, i % 9 + 1) for i in range(200_000) for d in ("SELL", "BUY")]
    book = spark.createDataFrame(rows, "part_id bigint, direction string, region bigint, price bigint, quantity bigint")
    params = SMALL.but(supply_depth=60_000_000, demand_depth=60_000_000)
    expected = by_hand(rows, params, exact_steps=True)
    assert sorted(rows_of(market.order_depth_average(book, params, exact_steps=True))) == expected
    needed = {r[1]: r[3] / 5 for r in expected}  # orders are of 5 units in the mean
    for end in market._walked_prefixes(market._levels(book), params).collect():
        walked = sum(1 for o in rows if o[1] == end["direction"] and (o[3] if o[1] == "SELL" else -o[3]) <= end["_cut"])
        assert walked <= 1.5 * needed[end["direction"]] < 100_000


def test_step_rounding_drift_is_bounded(spark):
    book = random_book(21)
    free = Params(supply_depth=10**12, demand_depth=10**12, notable_supply=0, spread_overshoot=10**6)
    free_buys = [b for b in book if b[1] == "SELL"]
    once = {r[:3]: r for r in rows_of(market.order_depth_average(orders_of(spark, free_buys), free))}
    steps = {r[:3]: r for r in rows_of(market.order_depth_average(orders_of(spark, free_buys), free, exact_steps=True))}
    sizes = {}
    for b in free_buys:
        sizes[b[:1] + (b[1], b[2])] = sizes.get(b[:1] + (b[1], b[2]), 0) + 1
    for key, row in once.items():
        assert steps[key][3:5] == row[3:5] and abs(steps[key][5] - row[5]) <= 0.5 * sizes[key] + 1


def test_relevance(spark):
    now = datetime(2015, 3, 8, 12)
    rows = [("a", "GE-8JV VII - Braveland", Decimal("0.5"), date(2015, 3, 11)), ("b", "Jita", Decimal("0.5"), date(2015, 3, 11)),
            ("c", "Low IV", Decimal("0.4"), date(2015, 3, 20)), ("d", "Soon IV", Decimal("0.9"), date(2015, 3, 10))]
    quotes = spark.createDataFrame(rows, "id string, station_name string, security decimal(4,2), expires date")
    got = market.relevant_orders(quotes, now, Decimal("0.5"))
    # no trailing blank; the whole name when it has none
    assert [(r.id, r.system_name) for r in got.orderBy("id").collect()] == [("a", "GE-8JV"), ("b", "Jita")]
    # exactly two days ahead is not enough
    assert market.relevant_orders(quotes, datetime(2015, 3, 9), Decimal("0.5")).count() == 0


def test_econ_region_ties_and_local(spark):
    agg = aggregates_of(spark, [(1, "SELL", 3, 1, 5, 50), (1, "SELL", 2, 1, 5, 50), (1, "SELL", 1, 1, 5, 60),
                                (1, "BUY", 1, 1, 5, 40), (1, "BUY", 2, 1, 5, 45), (2, "SELL", 1, 1, 1, 9)])
    assert rows_of(market.econ_region(agg, "SELL"), "part_id") == [(1, 2, 50), (2, 1, 9)]
    assert rows_of(market.econ_region(agg, "BUY")) == [(1, 2, 45)]
    local = market.local_regions(regions_of(spark), "THE EAST")
    assert rows_of(local) == [(3,)]
    assert rows_of(market.econ_region(agg, "SELL", local)) == [(1, 3, 50)]


def test_stale_items(spark):
    parts = parts_of(spark, [(i, f"P{i}", {"external_id": None if i == 4 else i * 1000}) for i in range(1, 12)])
    tags = tags_of(spark, [(2, "CONTRACTS"), (3, "BLUEPRINTS"), (5, "OTHER")])
    cache = spark.createDataFrame([(5000, datetime(2015, 1, 2)), (6000, datetime(2014, 1, 1))],
                                  "item_type_id bigint, cached_until timestamp_ntz")
    got = market.stale_items(parts, tags, cache, datetime(2015, 1, 1), per_batch=2)
    assert [(r.part_id, r.item_no, r.batch) for r in got.orderBy("item_no").collect()] == [
        (1, 1, 1), (6, 2, 1), (7, 3, 2), (8, 4, 2), (9, 5, 3), (10, 6, 3), (11, 7, 4)]


@pytest.mark.parametrize("exact_steps", [False, True])
def test_group_size_never_changes_a_result(spark, exact_steps):
    """Missing, zero, negative and huge values: the same rows under every limit, and none lost."""
    huge = 4 * 10**15
    book = [
        (1, "SELL", 1, None, 10), (1, "SELL", 1, 10, 10), (1, "SELL", 1, 12, 10), (2, "SELL", 1, -5, 10), (2, "SELL", 1, 5, 10),
        (3, "BUY", 1, 7, 0), (3, "BUY", 1, 9, None), (3, "BUY", 1, 8, 4), (4, "SELL", 1, huge, huge), (4, "SELL", 1, huge + 1, 3),
        (5, None, 1, 3, 3), (None, "BUY", 1, 3, 3), (5, "BUY", None, 3, 3), (6, "SELL", 1, 4, 0), (6, "LEND", 1, 4, 2)]
    params = Params(supply_depth=10**9, demand_depth=10**9, notable_supply=0)
    orders = orders_of(spark, book)
    results = [sorted(rows_of(market.order_depth_average(orders, params.but(cell_rows=n, piece_rows=n), exact_steps=exact_steps))) for n in (1, 2, 10**6)]
    assert all(r == results[0] for r in results)
    assert (1, "SELL", 1, 20, 10, 11) in results[0] and (2, "SELL", 1, 10, 5, 5) in results[0] and (3, "BUY", 1, 4, 8, 8) in results[0]
    assert market.rejected_orders(orders).count() + market.valid_orders(orders).count() == len(book)
    assert market.rejected_orders(orders).count() == 9


def test_row_numbers_with_an_outlier(spark):
    from millwright.operators.numbering import number_by_key

    ids = [*range(2000), 10**12]
    numbered = number_by_key(spark.createDataFrame([(i,) for i in ids], "k long").repartition(3), "k", "n")
    assert [(r["k"], r["n"]) for r in numbered.orderBy("k").collect()] == [(k, i + 1) for i, k in enumerate(ids)]
