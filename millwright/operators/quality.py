"""Load-time checks. Every check returns all violations; the caller decides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millwright.operators.bom import bom_cycles
from millwright.session import materialize


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row, with the row count; null keys do not collide."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def self_loops(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("good") == F.col("part"))


def orphan_edges(edges: DataFrame, parts: DataFrame) -> DataFrame:
    """Edges whose good or part is not in the catalogue, with the missing label."""
    labels = parts.select("label").where(F.col("label").isNotNull()).distinct()
    named = edges.where(F.col("good").isNotNull()).select("good", "part")
    missing = [
        named.withColumn("label", F.col(side)).join(labels, "label", "left_anti")
        .select("good", "part", F.lit(side).alias("side"), F.col("label").alias("missing"))
        for side in ("good", "part")
    ]
    return missing[0].unionByName(missing[1])


def region_conflicts(regions: DataFrame) -> DataFrame:
    """Regions that share an id under different names, or a name under different ids."""
    by_id = regions.groupBy("region").agg(F.min("name_region").alias("_a"), F.max("name_region").alias("_b"))
    by_name = regions.groupBy("name_region").agg(F.min("region").alias("_a"), F.max("region").alias("_b"))
    bad_ids = by_id.where(F.col("_a") != F.col("_b")).select("region")
    bad_names = by_name.where(F.col("_a") != F.col("_b")).select("name_region")
    return (
        regions.join(bad_ids, "region", "left_semi").select("region", "name_region")
        .unionByName(regions.join(bad_names, "name_region", "left_semi").select("region", "name_region"))
        .distinct()
    )


def aggregates_without_orders(aggregates: DataFrame, orders: DataFrame) -> DataFrame:
    return aggregates.join(orders.select("part_id").distinct(), "part_id", "left_anti")


def _rows(df: DataFrame, rule: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


Rules = dict[str, tuple[Column, Column, Column]]


def _not_null(table: str, df: DataFrame, key: str, columns: tuple[str, ...]) -> Rules:
    return {f"{table}.{c} not null": (F.col(c).isNull(), F.col(key), F.lit(c)) for c in columns if c in df.columns}


def _unknown(parent: DataFrame, key: str, tables: list[tuple[DataFrame, str]]) -> DataFrame:
    """The ids that the tables name and the parent does not have: ids alone are shuffled, and few are left to join the rows with."""
    named = reduce(DataFrame.unionByName, [df.where(F.col(c).isNotNull()).select(F.col(c).alias(key)).distinct() for df, c in tables])
    return materialize(named.distinct().join(parent.select(key), key, "left_anti"), "unknown-ids")


def _checks(df: DataFrame, rules: Rules, known: dict[str, tuple[str, DataFrame, Column, Column]] | None = None,
            unique: dict[str, list[str]] | None = None) -> DataFrame:
    """(rule, key, detail) of all rules of a table: an array of the violations of each row, and a row per key held twice.

    ``rules`` has (violated, key, detail). ``known`` has for a foreign key (column, ids the parent does not have, key, detail); the ids
    join as a flag. ``unique`` has the key columns; null keys do not collide.
    """
    found = dict(rules)
    copies = [_rows(duplicates(df, keys), rule, F.col(keys[0]), F.col(keys[-1])) for rule, keys in (unique or {}).items()]
    for rule, (column, unknown, key, detail) in (known or {}).items():
        flag = f"_unknown_{len(df.columns)}"
        df = df.join(unknown.toDF(column).withColumn(flag, F.lit(True)), column, "left")
        found[rule] = (F.col(flag), key, detail)
    broken = [
        F.when(violated, F.struct(F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail")))
        for rule, (violated, key, detail) in found.items()
    ]
    return reduce(DataFrame.unionByName, copies, df.select(F.inline(F.array_compact(F.array(*broken)))))


def constraint_violations(parts: DataFrame, edges: DataFrame, tags: DataFrame, orders: DataFrame,
                          aggregates: DataFrame, regions: DataFrame) -> DataFrame:
    """(rule, key, detail) for every declared NOT NULL, CHECK, UNIQUE and foreign key.

    Rows are checked in place; only keys and ids are shuffled.
    A null is reported by its NOT NULL rule alone. Columns a table does not have are not checked.
    """
    def side(table: str) -> Rules:
        return {f"{table} direction": (~F.col("direction").isin("BUY", "SELL"), F.col("part_id"), F.col("direction"))}

    def positive(table: str, columns: tuple[str, ...]) -> Rules:
        return {f"{table}.{c} positive": (F.col(c) <= 0, F.col("part_id"), F.col(c)) for c in columns}

    no_parts = _unknown(parts, "part_id", [(edges, "good_id"), (edges, "part_id"), (tags, "part_id"), (orders, "part_id"), (aggregates, "part_id")])
    no_regions = _unknown(regions, "region", [(orders, "region"), (aggregates, "region")])

    def catalogue(rule: str, column: str, key: str, detail: str):
        return {rule: (column, no_parts, F.col(key), F.col(detail))}

    def region(table: str):
        return {f"{table}.region known": ("region", no_regions, F.col("part_id"), F.col("region"))}

    return reduce(DataFrame.unionByName, [
        _checks(parts, _not_null("part", parts, "part_id", ("part_id", "label", "volume", "outcome_units")), unique={"part unique": ["part_id"]}),
        _checks(edges, {
            **_not_null("edge", edges, "edge_id", ("edge_id", "good_id", "part_id", "good", "part", "quantity")),
            "edge good differs from part": (F.col("good") == F.col("part"), F.col("edge_id"), F.col("good"))},
            {**catalogue("edge.good_id in catalogue", "good_id", "edge_id", "good_id"),
             **catalogue("edge.part_id in catalogue", "part_id", "edge_id", "part_id")},
            {"edge unique": ["good_id", "part_id"]}),
        _checks(tags, _not_null("tag", tags, "part_id", ("part_id", "keyword")),
                catalogue("tag.part_id in catalogue", "part_id", "part_id", "keyword"), {"tag unique": ["part_id", "keyword"]}),
        _checks(regions, _not_null("region", regions, "region", ("region", "name_region")),
                unique={"region unique": ["region"], "region name unique": ["name_region"]}),
        _checks(orders, {
            **_not_null("order", orders, "part_id", ("part_id", "direction", "system_name", "region", "price", "quantity", "min_qty",
                                                     "expires", "time_quotes_exec")),
            **side("order"), **positive("order", ("price", "quantity", "min_qty"))},
            {**catalogue("order.part_id in catalogue", "part_id", "part_id", "direction"), **region("order")}),
        _checks(aggregates, {
            **_not_null("aggregate", aggregates, "part_id", ("part_id", "direction", "region", "samples", "price_top", "price_average",
                                                             "time_quotes_exec")),
            **side("aggregate"), **positive("aggregate", ("price_average",))},
            {**catalogue("aggregate.part_id in catalogue", "part_id", "part_id", "direction"), **region("aggregate")}),
    ])


def load_violations(parts: DataFrame, edges: DataFrame) -> DataFrame:
    """The checks made before a catalogue load: (rule, key, detail)."""
    cycles = bom_cycles(edges).select("good_id", "part_id", "path") if "good_id" in edges.columns else None
    checks = [
        _rows(duplicates(parts, ["label"]), "duplicate label", F.col("label"), F.col("copies")),
        _rows(duplicates(parts, ["external_id"]), "duplicate external id", F.col("external_id"), F.col("copies")),
        _rows(self_loops(edges), "good equals part", F.col("good"), F.col("part")),
        _rows(orphan_edges(edges, parts), "not in catalogue", F.col("missing"), F.col("good")),
        _rows(duplicates(edges, ["good", "part"]), "edge loaded twice", F.col("good"), F.col("part")),
    ]
    if cycles is not None:
        checks.append(_rows(cycles, "cycle", F.col("good_id"), F.array_join("path", ">")))
    return reduce(DataFrame.unionByName, checks)
