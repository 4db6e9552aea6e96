"""Keyword tags on items."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from millwright.operators.merge import assign_new_ids


def explode_keywords(items: DataFrame, id_col: str, path_col: str) -> DataFrame:
    """(part_id, keyword) for every level of a '/'-separated path; empty levels are dropped."""
    levels = F.split(F.upper(F.trim(F.col(path_col), F.lit("/"))), "/")
    return (
        items.select(F.col(id_col).alias("part_id"), F.explode(levels).alias("keyword"))
        .where(F.length("keyword") > 0)
        .distinct()
    )


def add_tags(tags: DataFrame, new: DataFrame) -> DataFrame:
    """Insert-only: existing mappings are never removed."""
    return tags.select("part_id", "keyword").unionByName(new.select("part_id", "keyword")).distinct()


def encode_keywords(dictionary: DataFrame, tags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The keyword dictionary (keyword_id, keyword) with new words added, and the
    (keyword_id, part_id) bridge."""
    words = tags.select("keyword").distinct()
    grown = dictionary.join(words, "keyword", "left_anti").select("keyword_id", "keyword").unionByName(
        assign_new_ids(dictionary, words, ["keyword"], "keyword_id").select("keyword_id", "keyword"))
    bridge = tags.join(grown, "keyword").select("keyword_id", "part_id").distinct()
    return grown, bridge


def has_keyword(tags: DataFrame, keyword: str) -> DataFrame:
    """The distinct part ids that carry a tag, for semi and anti joins."""
    return tags.where(F.col("keyword") == keyword.upper()).select("part_id").distinct()


def with_tag(df: DataFrame, tags: DataFrame, keyword: str | None, on: str = "part_id") -> DataFrame:
    """Rows whose item carries the tag; all rows when no tag is asked."""
    if keyword is None:
        return df
    return df.join(has_keyword(tags, keyword).withColumnRenamed("part_id", on), on, "left_semi")


def without_tags(df: DataFrame, tags: DataFrame, keywords: Sequence[str], on: str = "part_id") -> DataFrame:
    """Rows whose item carries none of the tags."""
    tagged = tags.where(F.col("keyword").isin([k.upper() for k in keywords])).select(F.col("part_id").alias(on))
    return df.join(tagged.distinct(), on, "left_anti")


def tag_flags(tags: DataFrame, flags: dict[str, Sequence[str]]) -> DataFrame:
    """One row per tagged part with a boolean per flag: does it carry any of those tags?"""
    wanted = sorted({k for words in flags.values() for k in words})
    return (
        tags.where(F.col("keyword").isin(wanted))
        .groupBy("part_id")
        .agg(*[F.max(F.col("keyword").isin(list(words))).alias(name) for name, words in flags.items()])
    )


@dataclass(frozen=True)
class TagRule:
    """Tag the items named in ``labels``, or whose label contains every text of one ``all_of``."""

    keywords: tuple[str, ...]
    labels: tuple[str, ...] = ()
    all_of: tuple[tuple[str, ...], ...] = field(default=())

    def matches(self, label: Column) -> Column:
        hit = label.isin(list(self.labels)) if self.labels else F.lit(False)
        for texts in self.all_of:
            every = F.lit(True)
            for text in texts:
                every = every & label.contains(text)
            hit = hit | every
        return hit


def apply_rules(parts: DataFrame, rules: Sequence[TagRule]) -> DataFrame:
    """(part_id, keyword) for every rule an item matches: one pass, literals only, no join."""
    words = [
        F.when(rule.matches(F.col("label")), F.array(*[F.lit(k) for k in rule.keywords]))
        for rule in rules
    ]
    found = F.array_distinct(F.flatten(F.array_compact(F.array(*words))))
    return parts.select("part_id", F.explode(found).alias("keyword")).distinct()
