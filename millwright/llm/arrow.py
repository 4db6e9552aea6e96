"""Small loops over Arrow batches, shared by the operators that work in Python tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes; null stays null. Bytes that are not UTF-8 survive the trip to Python."""
    return F.col(column).cast("binary")


def decoded(raw: bytes | None) -> str:
    """Null as empty text, invalid bytes as U+FFFD."""
    return raw.decode("utf-8", "replace") if raw else ""


def map_rows(df: DataFrame, rows: Callable[[list[dict]], Iterator[dict] | list[dict]], schema: str,
             at_once: int = 1000) -> DataFrame:
    """``rows`` turns up to ``at_once`` input rows into output rows; columns by name."""
    kind = pa_schema(df, schema)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                out = list(rows(batch.slice(start, at_once).to_pylist()))
                yield pa.RecordBatch.from_pylist(out, schema=kind)

    return df.mapInArrow(run, schema)


def pa_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))
