from datetime import datetime
from decimal import Decimal

import pytest
from millwright.operators import market
from millwright.plans import checks, manufacture, materials
from millwright.plans.tables import build_units, with_best_offer
from tests.builders import rows_of, tables_of

# SHIP takes 2 FRAME and 3 CHIP; FRAME takes 10 IRON; CHIP takes 4 GOLD; IRON and GOLD are bought
PARTS = [
    (1, "SHIP", {"pile": 0}), (2, "FRAME", {"pile": 3}), (3, "CHIP", {"pile": None}),
    (4, "IRON", {"pile": 15, "volume": Decimal("0.5")}), (5, "GOLD", {"pile": 0, "volume": Decimal(2)}),
    (6, "FIERY ROCK", {"volume": Decimal("4.4")}), (7, "SHIP BLUEPRINT COPY", {"pile": None, "external_id": 700}),
]
EDGES = [(1, 2, 2), (1, 3, 3), (2, 4, 10), (3, 5, 4), (6, 4, "2.5")]
TAGS = [(2, "COMPONENTS"), (3, "COMPONENTS"), (4, "MATERIALS"), (5, "MATERIALS"), (6, "ORE"), (6, "RAW MATERIALS"),
        (7, "BLUEPRINTS"), (1, "SUBSYSTEMS"), (2, "SUBSYSTEMS"), (3, "SUBSYSTEMS")]
QUOTES = [
    (1, "SELL", 1, 5, 9_000, 10_000), (1, "BUY", 1, 4, 8_001, 7_000), (1, "SELL", 2, 5, 9_500, 9_900), (1, "BUY", 2, 3, 8_500, 8_000),
    (4, "SELL", 1, 1000, 10, 12), (4, "SELL", 2, 1000, 11, 11), (4, "BUY", 1, 10, 8, 8), (4, "BUY", 2, 10, 9, 9),
    (5, "SELL", 2, 1000, 200, 210), (5, "BUY", 1, 10, 150, 140),
]


@pytest.fixture(scope="module")
def t(spark):
    return tables_of(spark, PARTS, EDGES, TAGS, QUOTES)


def local(t, text):
    return market.local_regions(t.regions, text)


def test_breakeven(t):
    rows = {r.produce: r.break_micro for r in manufacture.product_breakeven(t).collect()}
    # IRON 20 x 11 + GOLD 12 x 210 = 2740 cents
    assert rows["SHIP"] == round(2740 * 1.03 * 1.02 * 1_000_000)
    # leaves without a local price drop out
    only_north = {r.produce: r.break_micro for r in manufacture.product_breakeven(t, local_buy=local(t, "NORTH")).collect()}
    assert only_north["SHIP"] == round(240 * 1.03 * 1.02 * 1_000_000) and "CHIP" not in only_north


def test_what_to_build(t):
    rows = manufacture.what_to_build(t, produce="ship", adjust=50).collect()
    assert [r.region for r in rows] == ["South", "North"]
    north = rows[1]
    brk = 2740 * 1.03 * 1.02
    assert float(north.mid_spread) == 8500.5 and float(north.my_adjusted_offer) == 8500.5 + 499.5 / 2
    assert north.mid_spread_jita == 8501 and north.demand == 28_000
    assert float(north.margin) == round((8750.25 - brk) / brk * 100, 1)
    assert manufacture.what_to_build(t, local_sell=local(t, "EAST")).count() == 0


def test_no_hub_quote_gives_null_margin_first(spark):
    tables = tables_of(spark, PARTS, EDGES, TAGS, QUOTES, hub_region=3)
    rows = manufacture.what_to_build(tables, "ship").collect()
    assert all(r.margin is None for r in rows) and len(rows) == 2


def test_excluded_products(spark):
    tables = tables_of(spark, PARTS, EDGES, [*TAGS, (3, "CONTRACTS")], QUOTES)
    kept = {r.label for r in manufacture.buildable_products(tables).collect()}
    assert kept == {"FRAME", "CHIP", "IRON", "GOLD"}


def test_thresholds_never_apply_to_a_search(t):
    assert manufacture.what_to_build(t, notable_demand=True).count() == 0
    assert manufacture.what_to_build(t, "ship", notable_demand=True).count() == 2


def test_materials(t):
    rows = {r.part: r for r in materials.materials_for_builds(t, ["2x{ship}", None, "9x{ship, frame}"]).collect()}
    # the first list wins for SHIP; FRAME comes on its own too
    assert {p: int(r.quantity) for p, r in rows.items()} == {"Frame": 4, "Chip": 6, "Iron": 40 + 90, "Gold": 24}
    assert int(rows["Iron"].shop_list) == 115 and rows["Iron"].quote == 11
    # no stock known: no shortage known
    assert rows["Chip"].pile is None and rows["Chip"].shop_list is None and rows["Chip"].job_list is None
    assert rows["Frame"].job_list == "1  Frame" and rows["Frame"].quote is None
    assert float(rows["Gold"].items_tot) == 115 * 11 + 24 * 210
    assert float(rows["Iron"].item_dst_cargo) == round(115 * 0.5 / 71500 * 100, 2)
    assert float(rows["Iron"].total_dst_cargo) == round((4 * 1 + 6 * 1 + 130 * 0.5 + 24 * 2) / 80500 * 100, 1)


def test_filters(t):
    got = materials.materials_for_builds(t, ["2x{ship}"], keyword="materials", short_only=True)
    assert [(r.part, int(r.shop_list)) for r in got.collect()] == [("Gold", 24), ("Iron", 25)]


def test_quoted_only_elsewhere_is_dropped(t):
    north = local(t, "NORTH")
    kept = {r.part for r in materials.materials_for_builds(t, ["1x{ship}"], local=north).collect()}
    assert kept == {"Frame", "Chip", "Iron"}
    all_rows = materials.materials_for_builds(t, ["1x{ship}"], local=north, keep_unquoted=True)
    assert {r.part for r in all_rows.collect()} == {"Frame", "Chip", "Iron", "Gold"}
    assert with_best_offer(t.parts.select("part_id"), t, north).where("part_id = 5").count() == 0


def test_three_tier_counts_a_nested_list_item_again(t):
    # FRAME is listed and also an input of SHIP: its row is reached from both roots
    demand = {r.part_id: int(r.units_orig) for r in materials.component_demand(t, ["1x{ship,frame}"]).collect()}
    assert demand == {2: 2, 3: 3, 4: 10 + 20}
    rows = {r.part: int(r.quantity) for r in materials.materials_three_tier(t, ["1x{ship}"]).collect()}
    assert rows == {"Iron": 20, "Gold": 12}


def test_shared_components_save_material(spark):
    # two ships each need one plate of 1.5 iron: 2 + 2 apart, 3 together
    parts = [(1, "A", {}), (2, "B", {}), (3, "PLATE", {}), (4, "IRON", {})]
    tables = tables_of(spark, parts, [(1, 3, 1), (2, 3, 1), (3, 4, "1.5")], [(3, "BOOSTER")], [])
    apart = {r.part: int(r.quantity) for r in materials.materials_for_builds(tables, ["1x{a,b}"]).collect()}
    together = {r.part: int(r.quantity) for r in materials.materials_three_tier(tables, ["1x{a,b}"]).collect()}
    assert (apart["Iron"], together["Iron"]) == (4, 3)


def test_cost_breakdown(t):
    rows = {r.part: r for r in manufacture.product_cost_breakdown(t, "ship", 3).where("produce_id = 1").collect()}
    iron, gold = rows["Iron"], rows["Gold"]
    assert (int(iron.quantity), int(gold.quantity)) == (60, 36)
    total = 60 * 11 + 36 * 210
    whole = lambda cents: round(cents / 100) * 100
    assert gold.items_tot == whole(36 * 210) and gold.goods_tot == whole(total) and gold.pct == round(36 * 210 / total * 100)
    assert gold["break"] == -(-int(total * 10506) // 1_000_000) * 100
    assert gold.just_buy_it == 9_900 * 3 and gold.just_buy_one == 9_900 and gold.goods_unit == round(whole(total) / 3)
    assert int(iron.short) == 45 and float(iron.dst) == round(45 * 0.5 / 71500 * 100, 1)
    with pytest.raises(ValueError):
        manufacture.product_cost_breakdown(t, "ship", 0)


def test_nothing_to_pay_for_has_no_shares(spark):
    # half an iron, rounded down
    tables = tables_of(spark, PARTS, [(6, 4, "0.5")], TAGS, QUOTES)
    row = manufacture.product_cost_breakdown(tables, "rock", 1).first()
    assert (row.quantity, row.goods_tot, row.pct) == (0, 0, None)


def test_ore(t):
    rows = materials.ore_ranking(t, Decimal(100)).collect()
    # 100 / 4.4 = 22.73 units x 2.5, rounded down: 56; several regions add up in the index
    assert {(r.ore, r.mineral, int(r.repcor), r.region, r.bid) for r in rows} == {
        ("Rock, Fiery", "Iron", 56, "North", 8), ("Rock, Fiery", "Iron", 56, "South", 9)}
    assert {r.value_index for r in rows} == {round(56 * 8 / 100) * 100 + round(56 * 9 / 100) * 100}


def test_cheapest_region(t):
    row = materials.cheapest_region_for_keyword(t, "materials", local(t, "NORTH"), "nor").collect()
    assert [(r.part, r.region, r.of_best_buy_pct, r.of_best_buy_region, r.compares_pct) for r in row] == [
        ("Iron", "North", 12 * 100 // 11, "South", 100)]
    free = materials.cheapest_region_for_keyword(t, "materials").collect()
    assert [(r.part, r.sellers, r.of_best_buy_pct, r.compares_pct, float(r.premium_two)) for r in free] == [
        ("Gold", 210, None, None, 214.2), ("Iron", 11, None, None, 11.22)]


def test_blueprints(spark, t):
    now = datetime(2015, 1, 1)
    jobs = spark.createDataFrame(
        [("X", "P", 1, 2, 0.5, 700, datetime(2015, 1, 3, 12)), ("Y", "Q", 1, 2, 0.5, 999, datetime(2015, 1, 3))],
        "installer_name string, blueprint_type_name string, runs bigint, licensed_runs bigint, probability double, product_type_id bigint, date_end timestamp_ntz")
    rows = materials.blueprint_pipeline(t, jobs, now).collect()
    assert [(r.label, r.installer_name, r.ready_in_days.total_seconds()) for r in rows] == [("SHIP BLUEPRINT COPY", "X", 2.5 * 86400)]


def test_prices(t):
    row = materials.practical_price(t, "iron").first()
    assert tuple(row) == ("Iron", 10, 11, 12)
    assert {r.regions: r.best_practical for r in materials.practical_price(t, "iron", per_region=True).collect()} == {"North": 12, "South": 11}
    # without a region all regions are listed
    assert materials.part_price_listing(t, "iron").count() == 2
    assert materials.part_price_listing(t, "ir%", "SOUTH").first().offers_low_range == 11


def test_small_queries(t):
    assert {r.good for r in checks.where_used(t.rates, "iron").collect()} == {"FRAME", "FIERY ROCK"}
    assert [(r.good, r.part, r.depth) for r in checks.browse_produce(t, "SHIP").collect()] == [
        ("CHIP", "GOLD", 2), ("FRAME", "IRON", 2), ("SHIP", "CHIP", 1), ("SHIP", "FRAME", 1)]
    assert [r.good for r in checks.distinct_goods(t.edges).collect()] == ["CHIP", "FIERY ROCK", "FRAME", "SHIP"]
    assert {r.label for r in checks.unusual_efficiency(t).collect()} == {r[1] for r in PARTS} - {"IRON", "GOLD", "SHIP BLUEPRINT COPY"}
    assert {r.remain for r in checks.remaining_count(t.parts).collect()} == {7}


def test_lists_of_a_table_count_as_those_given_as_texts(spark, t):
    given = ["2x{ship}", None, "9x{ship, frame}", "", "no list"]
    rows = [(i, text) for i, text in enumerate(given)]
    table = spark.createDataFrame(rows[::-1] + [(7, "5x{nothing known}"), (8, "3X{frame}")], "priority int, list string").repartition(3)
    assert set(rows_of(build_units(t, table))) == set(rows_of(build_units(t, given)))
    by_table = materials.materials_for_builds(t, table)
    assert {r.params for r in by_table.collect()} == {"7 lists"}
    assert rows_of(by_table.drop("params"), "part") == rows_of(materials.materials_for_builds(t, given).drop("params"), "part")
    assert build_units(t, table.limit(0)).count() == 0


def test_ties_of_lists_go_to_the_least_units(spark, t):
    table = spark.createDataFrame([(1, "4x{ship}"), (1, "2x{ship}"), (2, "1x{ship}")], "priority int, list string")
    assert [r.units for r in build_units(t, table).collect()] == [2]


def test_no_lists(t):
    assert build_units(t, [None, ""]).count() == 0
    assert rows_of(build_units(t, ["5X{ship}"])) == []


def test_reports_broadcast_nothing_by_hint(t):
    """Sides are broadcast only by their measured size, never by a hint."""
    plan = manufacture.what_to_build(t)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in plan
