"""Bill-of-materials rates, path explosion and rounded quantities."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millwright.functions.text import decimal_text
from millwright.operators.tags import tag_flags
from millwright.params import Params
from millwright.schemas import FACTOR, FOLD, QUANTITY
from millwright.session import materialize, new_table_path

RATE = T.DecimalType(9, 7)
EDGE_RESULT = T.DecimalType(19, 12)
CENTI = Decimal("0.01")

GOOD_FLAGS = {
    "_raw": ["RAW MATERIALS"],
    "_good_print": ["BLUEPRINTS"],
    "_no_pos": ["SUBSYSTEMS", "STRATEGIC CRUISERS", "BOOSTER"],
}
PART_FLAGS = {"_part_print": ["BLUEPRINTS"], "_research": ["RESEARCH EQUIPMENT"]}


def bom_detail(edges: DataFrame, parts: DataFrame) -> DataFrame:
    """Edges with the attributes of the good they belong to."""
    goods = parts.select(F.col("part_id").alias("good_id"), "volume", "material_efficiency",
                         "outcome_units", "pile", "external_id")
    return edges.join(goods, "good_id").select(
        "edge_id", "good_id", "good", "volume", "material_efficiency", "outcome_units", "pile",
        "external_id", "part_id", "part", "quantity")


def bom_rates(edges: DataFrame, parts: DataFrame, tags: DataFrame, params: Params = Params()) -> DataFrame:
    """True consumption rates and quantities of every edge, plus how its quantity is rounded.

    ``round_kind`` is NONE for edges from or to a blueprint, FLOOR for raw materials taken
    apart, CEIL otherwise. ``factor`` is the multiplier used on paths: quantity per unit.
    """
    goods = (
        parts.select(F.col("part_id").alias("good_id"), "external_id", "material_efficiency", "outcome_units")
        .join(tag_flags(tags, GOOD_FLAGS).withColumnRenamed("part_id", "good_id"), "good_id", "left")
    )
    joined = edges.join(goods, "good_id").join(tag_flags(tags, PART_FLAGS), "part_id", "left")

    def flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False))

    efficiency = ((F.lit(Decimal(100)) - F.col("material_efficiency")) * F.lit(CENTI)).cast(RATE)
    pos = (efficiency * F.lit(Decimal(100 - params.pos_bonus_me) * CENTI)).cast(RATE)
    one = F.lit(1).cast(RATE)
    blueprint = flag("_good_print") | flag("_part_print")
    station_rate = (
        F.when(flag("_raw"), efficiency)
        .when(F.col("quantity") == 1, one)
        .when(blueprint | flag("_research"), one)
    )
    pos_rate = station_rate.when(flag("_no_pos"), efficiency).otherwise(pos)
    kind = F.when(blueprint, "NONE").when(flag("_raw"), "FLOOR").otherwise("CEIL")
    rated = joined.select(
        "edge_id", "good_id", "good", "external_id", "material_efficiency", "outcome_units",
        efficiency.alias("consume_rate_base"),
        station_rate.otherwise(efficiency).alias("consume_rate_true_station"),
        pos_rate.alias("consume_rate_true_pos"),
        "part_id", "part", F.col("quantity").alias("quantity_raw"),
        kind.alias("round_kind"), flag("_raw").alias("raw_good"),
    )
    return rated.withColumns({
        "quantity_true_station": (F.col("quantity_raw") * F.col("consume_rate_true_station")).cast(EDGE_RESULT),
        "quantity_true_pos": (F.col("quantity_raw") * F.col("consume_rate_true_pos")).cast(EDGE_RESULT),
    }).withColumn(
        "factor",
        (F.col("quantity_true_pos") / F.col("outcome_units").cast(T.DecimalType(10, 0))).cast(FACTOR),
    )


def _tails(known: DataFrame, heads: DataFrame) -> DataFrame:
    """The paths that can follow on heads: those that start where one ends.

    The ends are written first, so that few of them are broadcast and the other paths, above all those of the topmost goods, which
    run through the whole tree, are neither shuffled nor sorted.
    """
    joints = materialize(heads.select(F.col("_joint").alias("produce_id")).distinct(), "joints")
    return known.join(joints, "produce_id", "left_semi").withColumn("_rest", F.slice("path", 2, F.size("path")))


def bom_explode(rates: DataFrame) -> DataFrame:
    """One row per path from every good down to every part below it.

    Columns: produce_id (root), good_id and part_id (deepest edge), depth, leaf, round_kind,
    ``steps`` (factor and rounding switch per edge, root first) and ``path`` (node ids).
    Path lengths double each round: paths of exactly n edges are joined with all paths of
    up to n edges, so a tree of depth d takes log2(d) joins. Every round is written once.
    A path never revisits a node, so a cyclic input ends too; ``bom_cycles`` reports it.
    """
    edges = rates.select(
        "edge_id", "good_id", "part_id", "raw_good",
        F.struct(F.col("factor"), (F.col("round_kind") != "NONE").alias("rounded")).alias("step"))
    goods = edges.select(F.col("good_id").alias("part_id")).distinct().withColumn("_inner", F.lit(True))
    singles = (
        edges.where(F.col("good_id") != F.col("part_id"))
        .join(goods, "part_id", "left")
        .select(
            F.col("good_id").alias("produce_id"), "good_id", "part_id",
            F.lit(1).alias("depth"), F.col("_inner").isNull().alias("leaf"),
            F.when(F.col("raw_good"), "FLOOR").otherwise("CEIL").alias("round_kind"),
            F.array("step").alias("steps"), F.array("good_id", "part_id").alias("path"),
            "edge_id",
        )
    )
    folder = new_table_path(rates.sparkSession, "paths")

    def add_round(rows: DataFrame, number: int) -> DataFrame:
        """Write one round beside the others; all of them read back as a single table."""
        rows.write.parquet(f"{folder}/round={number}")
        return rates.sparkSession.read.schema(f"{rows.schema.toDDL()}, round int").parquet(folder)

    known = add_round(singles, 0)
    longest, span, number = known, 1, 0
    while True:
        # a leaf cannot be extended: its rows, often all on a few very common inputs,
        # stay out of the join
        heads = longest.where(~F.col("leaf")).select(
            F.col("produce_id").alias("_root"), F.col("part_id").alias("_joint"),
            F.col("steps").alias("_steps"), F.col("path").alias("_path"))
        tails = _tails(known, heads)
        grown = (
            heads.join(tails, F.col("_joint") == F.col("produce_id"))
            .where(~F.arrays_overlap("_path", "_rest"))
            .select(
                F.col("_root").alias("produce_id"), "good_id", "part_id",
                (F.col("depth") + span).alias("depth"), "leaf", "round_kind",
                F.concat("_steps", "steps").alias("steps"),
                F.concat("_path", "_rest").alias("path"),
                "edge_id",
            )
        )
        number += 1
        known = add_round(grown, number)
        span *= 2
        longest = known.where((F.col("round") == number) & (F.col("depth") == span))
        if longest.isEmpty():
            return known.drop("round")


def with_labels(paths: DataFrame, parts: DataFrame) -> DataFrame:
    """Names joined last, onto the id-only paths."""
    names = parts.select(F.col("part_id").alias("_id"), F.col("label").alias("_label"))
    for key, name in (("produce_id", "produce"), ("good_id", "good"), ("part_id", "part")):
        paths = paths.join(names.withColumnsRenamed({"_id": key, "_label": name}), key)
    return paths


def leaf_paths(paths: DataFrame) -> DataFrame:
    return paths.where("leaf")


def formula_text(paths: DataFrame) -> Column:
    """The path's rounding formula as text, e.g. CEIL(CEIL(:UNITS * 2) * 3)."""
    kind = F.col("round_kind")

    def wrap(acc: Column, step: Column) -> Column:
        product = F.concat(acc, F.lit(" * "), decimal_text(step["factor"]))
        return F.when(step["rounded"], F.concat(kind, F.lit("("), product, F.lit(")"))).otherwise(product)

    return F.aggregate("steps", F.lit(":UNITS"), wrap)


def evaluate(units: Column) -> Column:
    """Fold ``steps`` over a number of units, rounding after every rounded step.

    Exact: products are formed from the whole and the fractional part separately, so no
    digit is lost within 38, and carry 12 decimals between steps.
    """
    wide = T.DecimalType(37, 12)
    kind = F.col("round_kind")

    def advance(acc: Column, step: Column) -> Column:
        value = acc.cast(T.DecimalType(29, 12))  # leaves room for the exact difference
        entire = F.floor(value).cast(T.DecimalType(17, 0))
        fraction = (value - entire).cast(T.DecimalType(13, 12))
        product = (entire * step["factor"]).cast(wide) + (fraction * step["factor"]).cast(wide)
        down = F.floor(product).cast(FOLD)
        up = F.ceil(product).cast(FOLD)
        return F.when(~step["rounded"], product.cast(FOLD)).when(kind == "FLOOR", down).otherwise(up)

    return F.aggregate("steps", units.cast(FOLD), advance)


def bom_quantity(paths: DataFrame, units: Column, runs: Column | None = None) -> DataFrame:
    """Paths with ``q_orig`` (all units in one job) and ``q_copy`` (full copies of ``runs``
    units plus one job for the rest). Without runs both are equal. Runs must be 1 or more."""
    result = paths.withColumn("q_orig", evaluate(units).cast(QUANTITY))
    if runs is None:
        return result.withColumn("q_copy", F.col("q_orig"))
    runs = F.coalesce(runs, units)
    checked = F.when(runs >= 1, runs).when(
        runs.isNotNull(), F.raise_error(F.lit("runs per copy must be at least 1")).cast("bigint"))
    full = evaluate(checked).cast(QUANTITY)
    rest = evaluate(F.pmod(units, checked)).cast(QUANTITY)
    copies = F.call_function("div", units, checked)
    all_full = (full * copies.cast(T.DecimalType(13, 0))).cast(QUANTITY)
    return result.withColumn("q_copy", (all_full + rest).cast(QUANTITY))


def _peeled(core: DataFrame) -> DataFrame:
    """Edges left when those that end in a plain input or start at a plain product are taken off until nothing changes."""
    size = core.count()
    while size:
        goods = core.select(F.col("good_id").alias("part_id")).distinct()
        inputs = core.select(F.col("part_id").alias("good_id")).distinct()
        core = materialize(core.join(goods, "part_id", "left_semi").join(inputs, "good_id", "left_semi").select("good_id", "part_id"), "cycle-core")
        left = core.count()
        if left == size:
            break
        size = left
    return core


def _colours(core: DataFrame) -> DataFrame:
    """(node, colour): the least node that leads to it, itself included. One row per node, whatever the number of ways."""
    nodes = core.select(F.col("good_id").alias("node")).unionByName(core.select(F.col("part_id").alias("node"))).distinct()
    colours = materialize(nodes.select("node", F.col("node").alias("colour")), "cycle-colours")
    while True:
        sent = core.join(colours.withColumnRenamed("node", "good_id"), "good_id").groupBy(F.col("part_id").alias("node")).agg(F.min("colour").alias("_sent"))
        after = materialize(colours.join(sent, "node", "left").select(
            "node", F.least("colour", "_sent").alias("colour"), (F.col("_sent") < F.col("colour")).alias("_changed")), "cycle-colours")
        colours = after.select("node", "colour")
        if after.where("_changed").isEmpty():
            return colours


def _ways(hops: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, colour, path): the shortest way from a root of (node, colour) over hops (node, next, colour), the least of equals.

    Breadth first; a node is reached once, so there is a row per node of a component, never one per pair.
    """
    reached = frontier = materialize(roots.select("node", "colour", F.array("node").alias("path")), "cycle-ways")
    while True:
        step = (frontier.join(hops, ["node", "colour"]).groupBy(F.col("next").alias("node"), "colour")
                .agg(F.min(F.concat("path", F.array("next"))).alias("path"))
                .join(reached.select("node", "colour"), ["node", "colour"], "left_anti"))
        frontier = materialize(step.select("node", "colour", "path"), "cycle-ways")
        if frontier.isEmpty():
            return reached
        reached = reached.unionByName(frontier)


def _back_ways(hops: DataFrame, roots: DataFrame) -> DataFrame:
    """As ``_ways``, towards the root: paths from the node, the least of the shortest."""
    reached = frontier = materialize(roots.select("node", "colour", F.array("node").alias("path")), "cycle-ways")
    while True:
        step = (frontier.withColumnRenamed("node", "next").join(hops, ["next", "colour"]).groupBy("node", "colour")
                .agg(F.min(F.concat(F.array("node"), "path")).alias("path"))
                .join(reached.select("node", "colour"), ["node", "colour"], "left_anti"))
        frontier = materialize(step.select("node", "colour", "path"), "cycle-ways")
        if frontier.isEmpty():
            return reached
        reached = reached.unionByName(frontier)


def bom_cycles(edges: DataFrame) -> DataFrame:
    """Edges that lie on a cycle, each with a closed walk through it: good, part, on to the root of their component and back to the good.

    Components are found by forward and backward colouring. What is on no cycle is peeled off first; an acyclic tree
    peels away completely. Every node takes the least node that leads to it as its colour; a node of its own colour is a root, and
    the nodes of its colour that lead back to it are its component. These leave, and the rest goes round again. The root is
    the least node of its component; ways to and from it are the shortest, the least of equals.
    """
    given = materialize(edges.where("good_id is not null and part_id is not null").select("good_id", "part_id").distinct(), "cycle-edges")
    core, found = _peeled(given), None
    while not core.isEmpty():
        colours = _colours(core)
        ends = colours.select(F.col("node").alias("part_id"), F.col("colour").alias("_other"))
        hops = materialize(core.join(colours.withColumnRenamed("node", "good_id"), "good_id").join(ends, "part_id").where("colour = _other").select(
            F.col("good_id").alias("node"), F.col("part_id").alias("next"), "colour"), "cycle-hops")
        members = _back_ways(hops, colours.where("node = colour"))
        found = members if found is None else found.unionByName(members)
        gone = members.select("node")
        core = _peeled(materialize(
            core.join(gone.withColumnRenamed("node", "good_id"), "good_id", "left_anti")
            .join(gone.withColumnRenamed("node", "part_id"), "part_id", "left_anti").select("good_id", "part_id"), "cycle-core"))
    if found is None:
        return given.where("false").select("good_id", "part_id", F.array("good_id").alias("path"))

    to_root = materialize(found, "cycle-members")
    member = to_root.select(F.col("node").alias("good_id"), "colour")
    other = to_root.select(F.col("node").alias("part_id"), F.col("colour").alias("_other"), F.col("path").alias("_to"))
    on_cycle = materialize(given.join(member, "good_id").join(other, "part_id").where("colour = _other").select("good_id", "part_id", "colour", "_to"),
                           "cycle-hops")
    from_root = _ways(on_cycle.select(F.col("good_id").alias("node"), F.col("part_id").alias("next"), "colour"),
                      to_root.where("node = colour").select("node", "colour"))
    back = from_root.select(F.col("node").alias("good_id"), F.col("path").alias("_from"))
    return on_cycle.join(back, "good_id").select(
        "good_id", "part_id", F.concat(F.array("good_id"), "_to", F.slice("_from", F.lit(2), F.size("_from"))).alias("path"))


def direct_parts_tagged(edges: DataFrame, tags: DataFrame, keyword: str) -> DataFrame:
    """Goods with a direct input that carries the tag."""
    tagged = tags.where(F.col("keyword") == keyword).select("part_id").distinct()
    return edges.join(tagged, "part_id", "left_semi").select("good_id").distinct()
