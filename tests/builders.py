"""Small tables for tests, in the schemas the jobs use."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from millwright import Params
from millwright.plans.tables import Tables
from millwright.schemas import AGGREGATE, EDGE, PART, REGION, TAG

T0 = datetime(2015, 1, 1)


def parts_of(spark, rows):
    """rows: (id, label, {column: value})"""
    full = []
    for part_id, label, extra in rows:
        values = {"external_id": part_id + 100, "volume": Decimal(1), "material_efficiency": Decimal(0),
                  "outcome_units": 1, "pile": 0, "base_invent_success": None, "base_invent_copies": None, **extra}
        full.append((part_id, label, *[values[c] for c in PART.names[2:]]))
    return spark.createDataFrame(full, PART)


def edges_of(spark, rows, parts=None):
    """rows: (good_id, part_id, quantity)"""
    names = {r.part_id: r.label for r in parts.collect()} if parts is not None else {}
    data = [(i, g, p, names.get(g, str(g)), names.get(p, str(p)), Decimal(str(q))) for i, (g, p, q) in enumerate(rows)]
    return spark.createDataFrame(data, EDGE)


def tags_of(spark, rows):
    return spark.createDataFrame(rows, TAG)


def regions_of(spark, rows=((1, "NORTH"), (2, "SOUTH"), (3, "EAST"))):
    return spark.createDataFrame([(i, n) for i, n in rows], REGION)


def aggregates_of(spark, rows):
    """rows: (part, direction, region, samples, top, average)"""
    return spark.createDataFrame([(*r, T0) for r in rows], AGGREGATE)


def tables_of(spark, parts, edges, tags, aggregates, regions=None, **params):
    p = parts_of(spark, parts)
    settings = {"hub_region": 1, "notable_supply": 0, **params}
    return Tables(p, edges_of(spark, edges, p), tags_of(spark, tags), regions or regions_of(spark),
                  aggregates_of(spark, aggregates), params=Params().but(**settings)).refresh()


def orders_of(spark, rows):
    """rows: (part, direction, region, price, quantity)"""
    schema = "part_id bigint, direction string, region bigint, price bigint, quantity bigint"
    return spark.createDataFrame(rows, schema)


def rows_of(df, *order):
    data = df.collect() if not order else df.orderBy(*[F.asc_nulls_first(c) for c in order]).collect()
    return [tuple(r) for r in data]
