"""Column types shared by the jobs.

Money is ``BIGINT`` cents throughout, so sums and comparisons are exact and stay on
primitive longs in generated code. Quantities that can carry a fraction are decimals.
"""

from __future__ import annotations

from pyspark.sql import types as T

VOLUME = T.DecimalType(10, 3)
EFFICIENCY = T.DecimalType(5, 3)
EDGE_QUANTITY = T.DecimalType(12, 5)
FACTOR = T.DecimalType(19, 12)
"""One edge's multiplier: quantity(5) x rate(7) has at most 12 decimals."""
FOLD = T.DecimalType(38, 12)
QUANTITY = T.DecimalType(24, 6)
WHOLE = T.DecimalType(38, 0)

STEP = T.StructType([T.StructField("factor", FACTOR), T.StructField("rounded", T.BooleanType())])


def schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


PART = schema(
    ("part_id", T.LongType()),
    ("label", T.StringType()),
    ("external_id", T.LongType()),
    ("volume", VOLUME),
    ("material_efficiency", EFFICIENCY),
    ("outcome_units", T.LongType()),
    ("pile", T.LongType()),
    ("base_invent_success", EFFICIENCY),
    ("base_invent_copies", T.LongType()),
)

EDGE = schema(
    ("edge_id", T.LongType()),
    ("good_id", T.LongType()),
    ("part_id", T.LongType()),
    ("good", T.StringType()),
    ("part", T.StringType()),
    ("quantity", EDGE_QUANTITY),
)

TAG = schema(("part_id", T.LongType()), ("keyword", T.StringType()))

REGION = schema(("region", T.LongType()), ("name_region", T.StringType()))

ORDER = schema(
    ("part_id", T.LongType()),
    ("direction", T.StringType()),
    ("system_name", T.StringType()),
    ("region", T.LongType()),
    ("price", T.LongType()),
    ("quantity", T.LongType()),
    ("min_qty", T.LongType()),
    ("expires", T.DateType()),
    ("time_quotes_exec", T.TimestampNTZType()),
)

AGGREGATE = schema(
    ("part_id", T.LongType()),
    ("direction", T.StringType()),
    ("region", T.LongType()),
    ("samples", T.LongType()),
    ("price_top", T.LongType()),
    ("price_average", T.LongType()),
    ("time_quotes_exec", T.TimestampNTZType()),
)
