"""Upserts as snapshot-to-snapshot DataFrame transforms."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millwright.operators.numbering import number_by_hash


def _differs(target: Column, source: Column, changed: str) -> Column:
    if changed == "null_safe":
        return ~target.eqNullSafe(source)
    if changed == "legacy_nvl":  # null and 1 count as equal
        return F.coalesce(target, F.lit(1)) != F.coalesce(source, F.lit(1))
    if changed == "always":
        return F.lit(True)
    raise ValueError(f"unknown change rule {changed!r}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] = (),
    insert_cols: Sequence[str] | None = None,
    changed: str = "null_safe",
    compare_cols: Sequence[str] | None = None,
    guard: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """The target after MERGE of ``source``, both unique on ``keys``.

    A matched row takes ``update_cols`` from the source when any of ``compare_cols``
    (default: ``update_cols``) changed and ``guard(target_row, source_row)`` holds.
    Unmatched source rows are inserted with ``insert_cols`` (default: all they share with
    the target) unless that is empty; unmatched target rows stay. One full outer join.
    """
    keys = list(keys)
    compare_cols = list(update_cols if compare_cols is None else compare_cols)
    if insert_cols is None:
        insert_cols = [c for c in target.columns if c in source.columns]
    old = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.struct(*target.columns).alias("_t"))
    new = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.struct(*source.columns).alias("_s"))
    on = [F.col(f"_t_{k}") == F.col(f"_s_{k}") for k in keys]
    how = "full" if insert_cols else "left"
    joined = old.join(new, on, how)

    in_target, in_source = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    take = in_target & in_source
    if update_cols:
        any_changed = F.lit(False)
        for c in compare_cols:
            any_changed = any_changed | _differs(F.col(f"_t.{c}"), F.col(f"_s.{c}"), changed)
        take = take & any_changed
        if guard is not None:
            take = take & guard(F.col("_t"), F.col("_s"))

    columns = []
    for c in target.columns:
        kind = target.schema[c].dataType
        from_target = F.col(f"_t.{c}")
        from_source = F.col(f"_s.{c}").cast(kind) if c in source.columns else F.lit(None).cast(kind)
        inserted = from_source if c in insert_cols else F.lit(None).cast(kind)
        value = F.when(in_target, from_target).otherwise(inserted)
        if c in update_cols:
            value = F.when(take, from_source).otherwise(value)
        columns.append(value.alias(c))
    return joined.select(*columns)


def replace_snapshot(target: DataFrame, source: DataFrame, refreshed: DataFrame, key: str) -> DataFrame:
    """Drop every target row of a refreshed key, then add the source rows.

    ``refreshed`` names the keys separately, because a refreshed key may have no rows left.
    """
    kept = target.join(refreshed.select(key).distinct(), key, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def keep_latest(docs: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key, that of the highest version."""
    rest = [c for c in docs.columns if c not in (key, version)]
    best = docs.groupBy(key).agg(F.max(F.struct(version, *rest)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in docs.columns if c != key])


def newest(docs: DataFrame, key: str, version: str) -> DataFrame:
    """One document per key: ``keep_latest``, and of equal versions, or without any, the greatest row."""
    if version not in docs.columns:
        docs = docs.withColumn(version, F.lit(0))
    return keep_latest(docs, key, version)


def assign_new_ids(target: DataFrame, source: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Source rows with the target's id where the key is known, and fresh ids beyond the
    target's highest where it is not."""
    keys = list(keys)
    known = source.join(target.select(*keys, id_col), keys, "inner")
    highest = target.agg(F.max(id_col)).first()[0] or 0
    fresh = number_by_hash(source.join(target.select(*keys), keys, "left_anti"), keys, id_col, highest + 1)
    return known.unionByName(fresh)


# --- one upsert per target table -----------------------------------

PART_UPDATES = ["external_id", "volume", "material_efficiency", "outcome_units",
                "base_invent_success", "base_invent_copies"]


def upsert_regions(regions: DataFrame, source: DataFrame) -> DataFrame:
    """Insert-only by region id."""
    return upsert(regions, source, ["region"])


def _with_copies(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``_copies``, the rows that share a whole key. The upsert's join deals by the same keys, so this shuffles nothing more."""
    return source.withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy(*keys)))


def refused_parts(loaded: DataFrame) -> DataFrame:
    """Loaded catalogue rows that ``upsert_parts`` leaves out, with ``reason``: no label, or a label loaded twice."""
    counted = _with_copies(loaded.where("label is not null"), ["label"]).where("_copies > 1").drop("_copies")
    return loaded.where("label is null").withColumn("reason", F.lit("no label")).unionByName(
        counted.withColumn("reason", F.lit("label loaded twice")))


def upsert_parts(parts: DataFrame, loaded: DataFrame, changed: str = "null_safe") -> DataFrame:
    """Loaded catalogue rows into ``parts`` by label; new labels get ids, stock is kept.

    Rows without a label, and all rows of a label loaded twice, are left out; ``refused_parts`` returns them.
    """
    known = _with_copies(loaded.where(F.col("label").isNotNull()), ["label"]).where("_copies = 1").drop("_copies")
    defaults = known.withColumns({
        "material_efficiency": F.coalesce("material_efficiency", F.lit(0)),
        "outcome_units": F.coalesce("outcome_units", F.lit(1)),
    })
    source = assign_new_ids(parts, defaults, ["label"], "part_id")
    return upsert(parts, source, ["label"], PART_UPDATES,
                  ["part_id", "label", *PART_UPDATES], changed)


def resolve_edges(loaded: DataFrame, parts: DataFrame) -> DataFrame:
    """Loaded (good, part, quantity) rows with good_id, part_id, and ``reason`` if they cannot be stored, else null."""
    goods = parts.select(F.col("part_id").alias("good_id"), F.col("label").alias("good"))
    inputs = parts.select("part_id", F.col("label").alias("part"))
    resolved = loaded.join(goods, "good", "left").join(inputs, "part", "left").select("good_id", "part_id", "good", "part", "quantity")
    reason = (F.when(F.col("good_id").isNull(), "good not in catalogue").when(F.col("part_id").isNull(), "part not in catalogue")
              .when(F.col("good_id") == F.col("part_id"), "good equals part").when(F.col("quantity").isNull(), "no quantity")
              .when(F.col("_copies") > 1, "edge loaded twice"))
    return _with_copies(resolved, ["good_id", "part_id"]).withColumn("reason", reason).drop("_copies")


def refused_edges(loaded: DataFrame, parts: DataFrame) -> DataFrame:
    """Loaded rows that ``upsert_edges`` leaves out, with ``reason``."""
    return resolve_edges(loaded, parts).where("reason is not null").select("good", "part", "quantity", "reason")


def upsert_edges(edges: DataFrame, loaded: DataFrame, parts: DataFrame) -> DataFrame:
    """Loaded (good, part, quantity) rows into ``edges`` by resolved ids; only quantity changes.

    A row whose labels are not in the catalogue, and all rows of an edge loaded twice, are left out; ``refused_edges`` returns them.
    """
    resolved = resolve_edges(loaded, parts).where("reason is null").drop("reason")
    source = assign_new_ids(edges, resolved, ["good_id", "part_id"], "edge_id")
    return upsert(edges, source, ["good_id", "part_id"], ["quantity"])


def upsert_newer_docs(cache: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Replace a cached document only by one that expires later."""
    return upsert(cache, incoming, [key], ["cached_until", "xdoc"], changed="always",
                  guard=lambda t, s: t["cached_until"] < s["cached_until"])


def upsert_docs(cache: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Replace a cached document unconditionally."""
    return upsert(cache, incoming, [key], ["cached_until", "xdoc"], changed="always")


def upsert_prices(aggregates: DataFrame, fresh: DataFrame, prune: bool = False) -> DataFrame:
    """Fresh aggregates by (part, direction, region), stamped only when a figure changed.

    Rows of regions no longer quoted stay, unless ``prune``: then rows of refreshed parts
    that got no fresh figure are dropped.
    """
    figures = ["samples", "price_top", "price_average"]
    keys = ["part_id", "direction", "region"]
    if prune:
        stale = aggregates.join(fresh.select("part_id").distinct(), "part_id", "left_semi").join(
            fresh.select(*keys), keys, "left_anti")
        aggregates = aggregates.join(stale.select(*keys), keys, "left_anti")
    return upsert(aggregates, fresh, keys, [*figures, "time_quotes_exec"], compare_cols=figures)
