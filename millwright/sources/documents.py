"""XML documents as rows.

A document that is missing or not well-formed, or an order book with a price that is no amount, is refused as a whole: the
parsers give no row for it, ``rejected`` returns it with the reason, ``accepted`` the others.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millwright.functions.numbers import to_cents
from millwright.functions.times import zone_shift
from millwright.session import materialize

_ORDER = ("struct<_id:bigint,region:bigint,station:string,station_name:string,security:string,"
          "price:string,vol_remain:bigint,min_volume:bigint,expires:string>")
ORDER_BOOK = f"sell_orders struct<order:array<{_ORDER}>>, buy_orders struct<order:array<{_ORDER}>>"
SIDES = {"SELL": "sell_orders", "BUY": "buy_orders"}
_CARGO = "struct<row:array<struct<_typeID:string,_quantity:bigint>>>"
ASSETS = (f"cachedUntil string, result struct<rowset:struct<row:array<struct<_locationID:string,"
          f"_typeID:string,rowset:{_CARGO}>>>>")
JOBS = ("cachedUntil string, result struct<rowset:struct<row:array<struct<_jobID:string,_installerName:string,"
        "_activityID:int,_blueprintID:string,_blueprintTypeID:string,_blueprintTypeName:string,_runs:bigint,"
        "_licensedRuns:bigint,_probability:string,_productTypeID:string,_productTypeName:string,_endDate:string>>>>")


_BROKEN = "_corrupt_record"


def order_book(sides: Sequence[str] = tuple(SIDES)) -> str:
    """The schema of an order book with whole orders on the sides asked for; of the others only prices, which can refuse the document."""
    return ", ".join(f"{field} struct<order:array<{_ORDER if side in sides else 'struct<price:string>'}>>" for side, field in SIDES.items())


def opened(docs: DataFrame, kind: str, xml: str = "xdoc") -> DataFrame:
    """Adds ``_doc``, the document as a struct of ``kind``, and ``_fault``, why it is refused, else null."""
    return docs.withColumn("_doc", _parsed(kind, xml)).withColumn("_fault", _refusal(kind, xml))


def _parsed(kind: str, xml: str) -> Column:
    return F.from_xml(F.col(xml), f"{kind}, {_BROKEN} string", {"columnNameOfCorruptRecord": _BROKEN})


def _unreadable(price: Column) -> Column:
    return price.try_cast("decimal(17,2)").isNull()


def _refusal(kind: str, xml: str) -> Column:
    fault = F.when(F.col(xml).isNull(), "no document").when(
        F.col("_doc").isNull() | F.col(f"_doc.{_BROKEN}").isNotNull(), "not well-formed")
    if kind.startswith("sell_orders"):
        for side in SIDES.values():
            fault = fault.when(F.exists(f"_doc.{side}.order", lambda o: _unreadable(o["price"])), "unreadable price")
    return fault


def accepted(docs: DataFrame, kind: str, xml: str = "xdoc") -> DataFrame:
    """The documents that can be loaded."""
    return opened(docs, kind, xml).where("_fault is null").drop("_doc", "_fault")


def rejected(docs: DataFrame, kind: str, xml: str = "xdoc") -> DataFrame:
    """The documents that are refused, with ``reason``."""
    return opened(docs, kind, xml).where("_fault is not null").withColumnRenamed("_fault", "reason").drop("_doc")


def _loaded(rows: Column | str) -> Column:
    """Rows of a document that is not refused."""
    return F.when(F.col("_fault").isNull(), F.col(rows) if isinstance(rows, str) else rows)


def _orders(sides: Sequence[str], regions: Sequence[int] | None) -> Column:
    """The orders of a document that is not refused, pruned to the regions asked for while they are an array still."""
    def side(direction: str) -> Column:
        found = _loaded(f"_doc.{SIDES[direction]}.order")
        if regions is not None:
            found = F.filter(found, lambda o: o["region"].isin(list(regions)))
        rows = F.transform(found, lambda o: F.struct(F.lit(direction).alias("direction"), o.alias("o")))
        return F.coalesce(rows, F.expr(f"cast(array() as array<struct<direction:string,o:{_ORDER}>>)"))

    return F.concat(*[side(direction) for direction in sides])


def _order_columns() -> list[Column]:
    return [F.col("direction"), F.col("o._id").alias("order_id"), F.col("o.region"), F.col("o.station"), F.col("o.station_name"),
            F.col("o.security").try_cast("decimal(4,2)").alias("security"),
            to_cents(F.col("o.price").try_cast("decimal(17,2)")).alias("price"),
            F.col("o.vol_remain").alias("quantity"), F.col("o.min_volume").alias("min_qty"),
            F.col("o.expires").try_cast("date").alias("expires")]


def parse_orders(docs: DataFrame, key: str = "item_type_id", xml: str = "xdoc", sides: Sequence[str] = tuple(SIDES),
                 regions: Sequence[int] | None = None) -> DataFrame:
    """One row per quoted order, all sides from one parse; only ``sides`` and ``regions`` (None: all) are read."""
    rows = opened(docs, order_book(sides), xml).select(key, F.inline(_orders(sides, regions)))
    return rows.select(key, *_order_columns())


# --- plain order books ----------------------------------------------------------------

# XML that can be read as it stands: elements without attributes but a numeric id, values of printable ASCII without markup
# and references, in each order the values of the schema in its sequence and nothing else. Such text means the same to a pattern
# and to a parser; all else goes to the parser. The pattern never steps back over an order.
# Characters are listed one by one: Java looks those up in a table, ranges it tries one after the other.
_SPACE, _NAME, _NUMBER = r"[ \t\r\n]*", "[A-Za-z_][A-Za-z0-9_.-]*+", "-?[0-9]{1,18}"
_TEXT = f"[{re.escape(''.join(chr(c) for c in range(32, 127) if chr(c) not in '<>&'))}]*"
_VALUES = {"region": _NUMBER, "station": _TEXT, "station_name": _TEXT, "security": _TEXT, "price": _TEXT,
           "vol_remain": _NUMBER, "min_volume": _NUMBER, "expires": _TEXT}
_ONE = f'<order(?: id="{_NUMBER}")?+>{_SPACE}{"".join(f"<{name}>{value}</{name}>{_SPACE}" for name, value in _VALUES.items())}</order>{_SPACE}'
_PLAIN = (f"^<(?!(?i:order|{'|'.join([*SIDES.values(), *_VALUES])}))({_NAME})>{_SPACE}"
          + "".join(f"<{side}>{_SPACE}(?:{_ONE})*+</{side}>{_SPACE}" for side in SIDES.values()) + f"</\\1>{_SPACE}\\z")


def _shape(xml: str) -> Column:
    """``none``: no document; ``endless``: its first element is never closed; ``plain``, or ``other``."""
    root = F.regexp_extract(F.substring(xml, 1, 200), f"^<({_NAME})>", 1)
    endless = (root != "") & ~F.contains(F.col(xml), F.concat(F.lit("</"), root))
    return F.when(F.col(xml).isNull(), "none").when(endless, "endless").when(F.col(xml).rlike(_PLAIN), "plain").otherwise("other")


def _plain_refusal(xml: str) -> Column:
    """Why a document that is not parsed is refused, else null. Prices are read where one is no short plain amount."""
    doubtful = F.col(xml).rlike(r"<price>(?!-?[0-9]{1,14}(?:\.[0-9]{1,20})?<)")
    unreadable = F.exists(F.regexp_extract_all(xml, F.lit("<price>([^<]*)<"), F.lit(1)), _unreadable)
    return F.when(F.col("_shape") == "none", "no document").when(F.col("_shape") == "endless", "not well-formed").when(
        doubtful & unreadable, "unreadable price")


def _plain_orders(docs: DataFrame, key: str, xml: str, sides: Sequence[str]) -> DataFrame:
    """The orders of plain documents as (key, direction, o), o as the parser gives it. Each is found by the tag that opens it."""
    def side(direction: str, part: int) -> Column:
        found = F.split(F.get("_parts", F.lit(part)), "<order")
        return F.transform(F.slice(found, 2, F.lit(2**30)), lambda o: F.concat(F.lit(direction), o))

    parts = docs.select(key, F.split(xml, "</sell_orders>").alias("_parts"))
    rows = parts.select(key, F.explode(F.concat(*[side(direction, n) for n, direction in enumerate(SIDES) if direction in sides])).alias("_row"))
    return rows.select(key, *_plain_values("_row"))


def _plain_values(row: str) -> list[Column]:
    """An order as text, with its side for the opening tag's name: cut before every tag it is the id, then each value and what ends it."""
    tag = lambda n: F.get(F.split(row, "<"), F.lit(n))
    value = lambda n: F.trim(F.substring_index(tag(n), ">", -1))
    typed = [value(n).try_cast("bigint") if pattern == _NUMBER else value(n) for n, pattern in zip(range(1, 99, 2), _VALUES.values())]
    number = F.get(F.split(tag(0), '"'), F.lit(1)).try_cast("bigint")
    order = F.struct(number.alias("_id"), *[v.alias(name) for v, name in zip(typed, _VALUES, strict=True)])
    return [F.substring_index(F.substring_index(tag(0), " ", 1), ">", 1).alias("direction"), order.alias("o")]


# --- order books, the newest of each item ---------------------------------------------


@dataclass(frozen=True)
class Books:
    """What one parse of order-book documents gave: the orders of the newest accepted document of each item, the items that
    have one (also without orders), and the refused documents with the reason."""

    orders: DataFrame
    items: DataFrame
    rejected: DataFrame


def read_books(docs: DataFrame, key: str = "item_type_id", version: str = "cached_until", xml: str = "xdoc",
               sides: Sequence[str] = tuple(SIDES), regions: Sequence[int] | None = None) -> Books:
    """Check each document once and store it with what was found; orders, items and refused documents are read from there.

    Plain documents are checked by pattern, and only the newest of an item is taken apart; the others are parsed, and their
    orders stored beside them. The newest accepted document of an item counts: that of the highest ``version``; of equal ones, or
    without any, the greatest.
    """
    if version not in docs.columns:
        docs = docs.withColumn(version, F.lit(0))
    kind, other = order_book(sides), F.col("_shape") == "other"
    book = docs.select(key, version, xml, _shape(xml).alias("_shape")).withColumn("_doc", F.when(other, _parsed(kind, xml)))
    book = book.withColumn("_fault", F.when(other, _refusal(kind, xml)).otherwise(_plain_refusal(xml)))
    stored = materialize(book.select(
        key, version, F.monotonically_increasing_id().alias("_document"), "_fault", xml, "_shape",
        F.when(other, _orders(sides, regions)).alias("_rows")), "books")
    newest = materialize(_newest(stored.where("_fault is null"), key, version, xml), "newest-books")
    marks = materialize(_marks(newest), "newest-marks")
    plain = _marked(stored.where("_shape = 'plain' and _fault is null").select(key, "_document", xml), marks)
    orders = _plain_orders(plain, key, xml, sides).select(key, *_order_columns())
    if regions is not None:
        orders = orders.where(F.col("region").isin(list(regions)))
    parsed = _marked(stored.where("_shape = 'other' and _fault is null").select(key, "_document", "_rows"), marks)
    refused = stored.where("_fault is not null").select(key, version, xml, F.col("_fault").alias("reason"))
    return Books(orders.unionByName(parsed.select(key, F.inline("_rows")).select(key, *_order_columns())), newest.select(key), refused)


def _newest(heads: DataFrame, key: str, version: str, xml: str) -> DataFrame:
    """(key, _document) of the highest version; texts are compared, and shuffled, only where that one has several documents."""
    last = materialize(
        heads.groupBy(key, version).agg(F.max("_document").alias("_document"), F.count(F.lit(1)).alias("_n"))
        .groupBy(key).agg(F.max(F.struct(version, "_document", "_n")).alias("_last")).select(key, "_last.*"), "last-versions")
    single = last.where("_n = 1").select(key, "_document")
    tied = last.where("_n > 1").select(F.col(key).alias("_key"), F.col(version).alias("_version"))
    if tied.isEmpty():
        return single
    best = F.max(F.struct(xml, "_document")).alias("_best")
    several = heads.join(tied, F.col(key).eqNullSafe(F.col("_key")) & F.col(version).eqNullSafe(F.col("_version")), "left_semi")
    return single.unionByName(several.groupBy(key).agg(best).select(key, F.col("_best._document").alias("_document")))


_MARKS = 32768


def _marks(documents: DataFrame) -> DataFrame:
    """(_bucket, _bits): a bit for each of the documents, ``_MARKS`` numbers in a row, so that texts need not be shuffled to find them."""
    return documents.groupBy(F.shiftright("_document", 15).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.col("_document") % _MARKS).alias("_bits"))


def _marked(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows of the documents that are marked."""
    at = (F.col("_document") % _MARKS).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("_bucket", F.shiftright("_document", 15)).join(marks, "_bucket")
    return found.where(F.call_function("shiftright", byte, at % 8) % 2 == 1).drop("_bucket", "_bits")


def parse_assets(docs: DataFrame, holder: str = "holder", xml: str = "xdoc") -> DataFrame:
    """Items one level inside a place or ship; places without contents give no row."""
    outer = opened(docs, ASSETS, xml).select(F.col(holder).alias("holder"), F.explode(_loaded("_doc.result.rowset.row")).alias("_place"))
    inner = outer.select("holder", F.col("_place._locationID").alias("location_id"),
                         F.col("_place._typeID").alias("location_type"),
                         F.explode("_place.rowset.row").alias("_item"))
    return inner.select("holder", "location_id", "location_type",
                        F.col("_item._typeID").alias("item_type"), F.col("_item._quantity").alias("quantity"))


def parse_jobs(docs: DataFrame, zone: str = "UTC", activity: int = 8, xml: str = "xdoc") -> DataFrame:
    """Running jobs of one activity (8 = invention), end times in ``zone``."""
    rows = opened(docs, JOBS, xml).select(F.explode(_loaded("_doc.result.rowset.row")).alias("j"))
    return rows.where(F.col("j._activityID") == activity).select(
        F.col("j._jobID").alias("job_id"), F.col("j._installerName").alias("installer_name"),
        F.col("j._activityID").alias("activity_id"), F.col("j._blueprintID").alias("blueprint_id"),
        F.col("j._blueprintTypeID").alias("blueprint_type_id"),
        F.col("j._blueprintTypeName").alias("blueprint_type_name"),
        F.col("j._runs").alias("runs"), F.col("j._licensedRuns").alias("licensed_runs"),
        F.col("j._probability").try_cast("double").alias("probability"),
        F.col("j._productTypeID").try_cast("bigint").alias("product_type_id"),
        F.col("j._productTypeName").alias("product_type_name"),
        zone_shift(F.col("j._endDate").try_cast("timestamp_ntz"), zone).alias("date_end"))


def cached_until(docs: DataFrame, zone: str = "UTC", xml: str = "xdoc") -> DataFrame:
    """The documents with their expiry, server time shifted to ``zone``."""
    stamp = F.xpath_string(F.col(xml), F.lit("//cachedUntil")).try_cast("timestamp_ntz")
    return docs.withColumn("cached_until", zone_shift(stamp, zone))
