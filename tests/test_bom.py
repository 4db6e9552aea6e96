import random
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millwright.operators import bom
from tests import golden
from tests.builders import edges_of, parts_of, rows_of, tags_of


@pytest.fixture(scope="module")
def ship(spark):
    labels = sorted({x for e in golden.edges() for x in e[:2]})
    ids = {label: i for i, label in enumerate(labels)}
    parts = parts_of(spark, [(ids[x], x, {"material_efficiency": Decimal(golden.EFFICIENCY.get(x, 0))}) for x in labels])
    edges = edges_of(spark, [(ids[g], ids[p], q) for g, p, q in golden.edges()], parts)
    tags = tags_of(spark, [(ids[x], "BLUEPRINTS") for x in labels if "BLUEPRINT COPY" in x])
    paths = bom.with_labels(bom.bom_explode(bom.bom_rates(edges, parts, tags)), parts)
    return paths.cache()


def test_path_counts(ship):
    assert {r.depth: r["count"] for r in ship.groupBy("depth").count().collect()} == {1: 48, 2: 36}
    pilgrim = ship.where("produce = 'PILGRIM'")
    assert (pilgrim.count(), pilgrim.where("leaf").count()) == (48, 38)


@pytest.mark.parametrize("units,column", [(1, 0), (9, 1)])
def test_golden_totals(ship, units, column):
    rows = bom.bom_quantity(ship.where("produce = 'PILGRIM' and leaf"), F.lit(units)).groupBy("part").agg(F.sum("q_orig"))
    assert {p: q.normalize() for p, q in rows_of(rows)} == {
        p: Decimal(v[column]).normalize() for p, v in golden.totals().items()}


def chain(spark, quantities, tags=(), efficiency=0, units=1):
    """1 -> 2 -> 3 ... with the given quantities."""
    n = len(quantities) + 1
    parts = parts_of(spark, [(i, f"P{i}", {"material_efficiency": Decimal(efficiency), "outcome_units": units}) for i in range(1, n + 1)])
    edges = edges_of(spark, [(i + 1, i + 2, q) for i, q in enumerate(quantities)], parts)
    return bom.bom_rates(edges, parts, tags_of(spark, list(tags) or [(99, "NONE")]))


def deepest(spark, rates, units, runs=None):
    paths = bom.bom_explode(rates)
    top = paths.where("produce_id = 1").orderBy(F.desc("depth")).limit(1)
    row = bom.bom_quantity(top, F.lit(units).cast("bigint"), None if runs is None else F.lit(runs).cast("bigint")).first()
    return row.q_orig, row.q_copy


def test_documented_formula(spark):
    # 1323 x 0.96 and 17 x 0.9 x 0.98, both rounded up in turn: 3 units take 57143
    parts = parts_of(spark, [(1, "SHIP", {"material_efficiency": Decimal(4)}), (2, "CHIP", {"material_efficiency": Decimal(10)}), (3, "ORE", {})])
    edges = edges_of(spark, [(1, 2, 1350), (2, 3, 17)], parts)
    rates = bom.bom_rates(edges, parts, tags_of(spark, [(9, "X")]))
    paths = bom.bom_explode(rates).where("depth = 2")
    formula = paths.select(bom.formula_text(paths)).first()[0]
    assert formula == "CEIL(CEIL(:UNITS * 1270.08) * 14.994)"
    assert bom.bom_quantity(paths, F.lit(3)).first().q_orig == 57143


def test_decimal_ceil_is_exact(spark):
    # 0.07 x 100 is 7 in decimals and just above 7 in doubles
    assert deepest(spark, chain(spark, [Decimal("0.07142")], efficiency=Decimal("2"), units=1), 1)[0] == 1
    rates = chain(spark, ["0.07"], tags=[(1, "SUBSYSTEMS")])
    assert deepest(spark, rates, 100)[0] == 7


def test_fraction_times_factor_keeps_twelve_digits(spark):
    parts = parts_of(spark, [(1, "A", {}), (2, "B", {})])
    rates = bom.bom_rates(edges_of(spark, [(1, 2, "2.97")], parts), parts, tags_of(spark, [(1, "BOOSTER")]))
    paths = bom.bom_explode(rates)
    third = F.lit(Decimal(1000)).cast("decimal(18,6)") / F.lit(Decimal("4.4")).cast("decimal(10,3)")
    assert paths.select(bom.evaluate(third)).first()[0] == 675


@pytest.mark.parametrize("tag,side,quantity,station,pos,kind", [
    ("RAW MATERIALS", 1, 1, "0.9", "0.9", "FLOOR"),
    (None, 1, 1, "1", "1", "CEIL"),
    ("BLUEPRINTS", 1, 5, "1", "1", "NONE"),
    ("BLUEPRINTS", 2, 5, "1", "1", "NONE"),
    ("RESEARCH EQUIPMENT", 2, 5, "1", "1", "CEIL"),
    ("SUBSYSTEMS", 1, 5, "0.9", "0.9", "CEIL"),
    ("STRATEGIC CRUISERS", 1, 5, "0.9", "0.9", "CEIL"),
    ("BOOSTER", 1, 5, "0.9", "0.9", "CEIL"),
    (None, 1, 5, "0.9", "0.882", "CEIL"),
])
def test_rate_rules(spark, tag, side, quantity, station, pos, kind):
    tags = [(side, tag)] if tag else [(99, "OTHER")]
    row = chain(spark, [quantity], tags, efficiency=10).first()
    assert (row.consume_rate_base, row.consume_rate_true_station, row.consume_rate_true_pos, row.round_kind) == (
        Decimal("0.9"), Decimal(station), Decimal(pos), kind)


def test_rounding_kind_comes_from_the_deepest_edge(spark):
    # deepest good is raw material: the whole path rounds down
    assert deepest(spark, chain(spark, ["1.5", "1.5"], tags=[(2, "RAW MATERIALS")]), 1)[0] == 1
    # a blueprint edge on the way is not rounded
    assert deepest(spark, chain(spark, ["1.25", "3"], tags=[(2, "BLUEPRINTS")]), 1)[0] == Decimal("3.75")


def test_copies(spark):
    rates = chain(spark, ["1.5"], tags=[(1, "BOOSTER")])
    # 7 units: one job 11; copies of 3: 5 + 5 + 2
    assert deepest(spark, rates, 7, 3) == (11, 12)
    assert deepest(spark, rates, 7) == (11, 11)


def test_runs_below_one_are_refused(spark):
    with pytest.raises(Exception, match="at least 1"):
        deepest(spark, chain(spark, [2]), 5, 0)


def brute_paths(edges):
    below = {}
    for g, p in edges:
        below.setdefault(g, []).append(p)
    found = set()

    def walk(path):
        for p in below.get(path[-1], ()):
            if p not in path:
                found.add(tuple(path + [p]))
                walk(path + [p])

    for g in below:
        walk([g])
    return found


@settings(max_examples=6, deadline=None)
@given(st.sets(st.tuples(st.integers(1, 9), st.integers(1, 9)).filter(lambda e: e[0] < e[1]), min_size=1, max_size=14))
def test_explosion_equals_brute_force(spark, edges):
    parts = parts_of(spark, [(i, f"P{i}", {}) for i in range(1, 10)])
    rates = bom.bom_rates(edges_of(spark, [(g, p, 2) for g, p in edges], parts), parts, tags_of(spark, [(99, "X")]))
    rows = bom.bom_explode(rates).collect()
    assert sorted(tuple(r.path) for r in rows) == sorted(brute_paths(edges))
    goods = {g for g, _ in edges}
    assert all(r.leaf == (r.part_id not in goods) and r.depth == len(r.path) - 1 == len(r.steps) for r in rows)


def test_only_paths_that_can_follow_are_joined(spark):
    """Of the paths from 1, 2, 3 and 4, those from 3 alone follow on a way that ends there."""
    known = spark.createDataFrame([(r, [r, r + 1]) for r in (1, 2, 3, 3, 4)], "produce_id bigint, path array<bigint>")
    heads = spark.createDataFrame([(3,), (3,), (9,)], "_joint bigint")
    assert sorted(rows_of(bom._tails(known, heads))) == [(3, [3, 4], [4])] * 2


def test_diamond_gives_one_row_per_path(spark):
    parts = parts_of(spark, [(i, f"P{i}", {}) for i in range(1, 5)])
    rates = bom.bom_rates(edges_of(spark, [(1, 2, 1), (1, 3, 1), (2, 4, 1), (3, 4, 1)], parts), parts, tags_of(spark, [(99, "X")]))
    assert bom.bom_explode(rates).where("produce_id = 1 and part_id = 4").count() == 2


def test_cycles(spark):
    edges = edges_of(spark, [(1, 2, 1), (2, 3, 1), (3, 1, 1), (3, 4, 1), (5, 1, 1), (6, 6, 1), (4, 7, 1)])
    assert rows_of(bom.bom_cycles(edges), "good_id") == [
        (1, 2, [1, 2, 3, 1]), (2, 3, [2, 3, 1, 2]), (3, 1, [3, 1, 2, 3]), (6, 6, [6, 6])]
    assert bom.bom_cycles(edges_of(spark, [(1, 2, 1), (2, 3, 1)])).count() == 0


def test_cycles_of_random_graphs(spark):
    """Against reachability, edge by edge; every walk is closed, follows edges and holds no more than two ways of the component."""
    rng = random.Random(8)
    pairs = {(rng.randint(1, 25), rng.randint(1, 25)) for _ in range(40)} | {(k, k + 1) for k in range(100, 107)} | {(107, 100), (105, 102)}
    reach = {n: {p for g, p in pairs if g == n} for n in {x for e in pairs for x in e}}
    grown = True
    while grown:
        grown = False
        for n, seen in reach.items():
            more = set().union(*(reach[x] for x in seen)) - seen if seen else set()
            seen |= more
            grown |= bool(more)
    found = {(r["good_id"], r["part_id"]): r["path"] for r in bom.bom_cycles(edges_of(spark, [(g, p, 1) for g, p in pairs])).collect()}
    assert set(found) == {(g, p) for g, p in pairs if g in reach[p] or g == p}
    for (good, part), path in found.items():
        assert path[:2] == [good, part] and path[-1] == good
        assert all(hop in pairs for hop in zip(path, path[1:]))


def test_monotone_in_units(spark):
    paths = bom.bom_explode(chain(spark, ["1.37", "2.91"], efficiency=7)).where("depth = 2")
    sized = paths.withColumn("u", F.explode(F.sequence(F.lit(1), F.lit(400))))
    got = [r.q_orig for r in bom.bom_quantity(sized, F.col("u")).orderBy("u").collect()]
    assert len(got) == 400 and got == sorted(got)
