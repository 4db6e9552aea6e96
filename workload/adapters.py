"""Operator inputs derived from the given star-schema tables.

Every rule is deterministic and total: each table row takes part. ``workload/oracle.py``
states the same rules in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millwright.operators.market import order_depth_average
from millwright.operators.tags import explode_keywords
from millwright.params import Params
from millwright.plans.tables import Tables
from millwright.session import materialize, spread
from millwright.sources.documents import cached_until

# Depth caps scaled to the given order values, and a hub among the five given regions.
PARAMS = Params(demand_depth=10_000_000, supply_depth=8_000_000, notable_demand=5_000_000,
                notable_supply=500_000, hub_region=1)

TYPE_TAGS = {"PROMO": "BLUEPRINTS", "ECONOMY": "RAW MATERIALS", "SMALL": "SUBSYSTEMS", "LARGE": "COMPONENTS",
             "MEDIUM": "MATERIALS", "STANDARD": "STRATEGIC CRUISERS"}
WORD_TAGS = {"GIZMO": "CONTRACTS", "ANVIL": "ORE", "ROD": "RESEARCH EQUIPMENT", "RING": "BOOSTER",
             "WIDGET": "MINERALS", "PLATE": "INVENTION"}
LOCAL_TEXT = "AMERICA ASIA EUROPE"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mapped(col: Column, words: dict[str, str]) -> Column:
    result = F
    for word, tag in words.items():
        result = result.when(col == word, tag)
    return result.otherwise(col)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    coded = key % 10 != 0
    return read(spark, sf_dir, "part").select(
        key.alias("part_id"),
        F.concat(F.upper("p_name"), F.lit(" "), key).alias("label"),
        F.when(coded, key * 3 + 7).alias("external_id"),
        (F.col("p_size") * F.lit(Decimal("0.1"))).cast("decimal(10,3)").alias("volume"),
        (key % 11).cast("decimal(5,3)").alias("material_efficiency"),
        F.when(key % 40 == 0, F.lit(40)).otherwise(1).cast("bigint").alias("outcome_units"),
        F.when(coded, key * 7 % 500).alias("pile"),
        F.lit(None).cast("decimal(5,3)").alias("base_invent_success"),
        F.lit(None).cast("bigint").alias("base_invent_copies"),
    )


def tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.upper(F.substring_index("p_name", " ", -1))
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_id"),
        F.concat(F.lit("/"), _mapped(F.col("p_type"), TYPE_TAGS), F.lit("//"), F.col("p_brand"), F.lit("/"),
                 _mapped(word, WORD_TAGS), F.lit("/")).alias("market_browser_path"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_keywords(tag_paths(spark, sf_dir), "part_id", "market_browser_path")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k goes into 4k+1 .. 4k+4; every seventh also into 4k+9, which gives diamonds.

    Quantities are small so that the deep trees of larger tables stay within 17 digits.
    """
    catalogue = parts(spark, sf_dir)
    goods = catalogue.select(F.col("part_id").alias("good_id"), F.col("label").alias("good"))
    slots = F.when(F.col("good_id") % 7 == 0, F.array(*[F.lit(j) for j in (1, 2, 3, 4, 9)])).otherwise(
        F.array(*[F.lit(j) for j in (1, 2, 3, 4)]))
    k, j = F.col("good_id"), F.col("j")
    quantity = (k * 31 + j * 17) % 5 + 1 + F.when(j == 2, F.lit(Decimal("0.17"))).otherwise(0)
    return (
        goods.withColumn("j", F.explode(slots))
        .withColumn("part_id", k * 4 + j)
        .join(catalogue.select("part_id", F.col("label").alias("part")), "part_id")
        .select((k * 10 + j).alias("edge_id"), "good_id", "part_id", "good", "part",
                quantity.cast("decimal(12,5)").alias("quantity"))
    )


def build_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(priority, list): a build list per order, naming all it asks for; the first order that names an item counts."""
    labels = parts(spark, sf_dir).select("part_id", F.lower("label").alias("label"))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("part_id"), "l_quantity")
    units, names = F.max("l_quantity").cast("bigint"), F.array_join(F.sort_array(F.collect_set("label")), ", ")
    return lines.join(labels, "part_id").groupBy(F.col("l_orderkey").alias("priority")).agg(
        F.concat(units, F.lit("x{"), names, F.lit("}")).alias("list"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("region"), F.col("r_name").alias("name_region"))


def placed_lines(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Line items with their place. Joined in this order so that each small table is sized
    on its own: the product of two is estimated larger than a short line item file."""
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        nation, F.col("s_nationkey") == F.col("n_nationkey"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed_lines(spark, sf_dir, read(spark, sf_dir, "lineitem")).select(
        F.col("l_partkey").alias("part_id"),
        F.when(F.col("l_linestatus") == "O", "SELL").otherwise("BUY").alias("direction"),
        F.col("n_name").alias("system_name"),
        F.col("n_regionkey").cast("bigint").alias("region"),
        F.round(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("bigint").alias("price"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_linenumber").cast("bigint").alias("min_qty"),
        F.date_add(F.col("l_shipdate").cast("date"), 30).alias("expires"),
        F.col("l_shipdate").alias("time_quotes_exec"),
    )


_SNAPSHOTS: dict[tuple[str, str], Tables] = {}


def build_snapshot(spark: SparkSession, sf_dir: str) -> Tables:
    """The stored layer the reports read: catalogue, tags, aggregates and exploded paths."""
    def stored(name: str, df: DataFrame) -> DataFrame:
        return materialize(df, name)

    return Tables(
        stored("parts", parts(spark, sf_dir)), stored("edges", edges(spark, sf_dir)),
        stored("tags", tags(spark, sf_dir)), regions(spark, sf_dir),
        stored("aggregates", order_depth_average(orders(spark, sf_dir), PARAMS)), params=PARAMS).refresh()


def snapshot(spark: SparkSession, sf_dir: str) -> Tables:
    """As ``build_snapshot``, built once per session and folder, like any stored layer."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SNAPSHOTS:
        _SNAPSHOTS[key] = build_snapshot(spark, sf_dir)
    return _SNAPSHOTS[key]


# --- documents ------------------------------------------------------------------------


def _text(value) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.lit(value)


def _concat(*items) -> Column:
    return F.concat(*[_text(i) for i in items])


_LINE = ["l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", "n_name", "n_regionkey"]


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    return placed_lines(spark, sf_dir, spread(lines))


def _quoted(line: Callable[[str], Column]) -> Column:
    """A line item as XML orders: what is before the price, the prices of the sell and the buy order, and what is behind; ``line`` gives its columns."""
    price = F.round(line("l_extendedprice") * 100 / line("l_quantity")).cast("bigint")
    security = ((line("l_suppkey") % 15 - 4) * F.lit(Decimal("0.1"))).cast("decimal(3,1)")
    expires = F.date_add(line("l_shipdate").cast("date"), 30)
    amount = lambda cents: (cents.cast("decimal(15,0)") * F.lit(Decimal("0.01"))).cast("decimal(17,2)").cast("string")
    return F.struct(
        _concat('<order id="', line("l_orderkey"), '"><region>', line("n_regionkey"), "</region><station>",
                line("l_suppkey"), "</station><station_name>", line("n_name"), " IV - Dock ",
                line("l_suppkey"), "</station_name><security>", security, "</security><price>").alias("before"),
        amount(price).alias("sell"), amount(F.call_function("div", price * 9, F.lit(10).cast("bigint"))).alias("buy"),
        _concat("</price><vol_remain>", line("l_quantity").cast("bigint"), "</vol_remain><min_volume>",
                line("l_linenumber"), "</min_volume><expires>", expires, "</expires></order>").alias("behind"))


def _book(sells: Column, buys: Column) -> Column:
    return _concat("<quicklook><sell_orders>", sells, "</sell_orders><buy_orders>", buys, "</buy_orders></quicklook>").alias("xdoc")


def order_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order-book document per line item: a sell order and a buy order a tenth lower."""
    texts = _order_lines(spark, sf_dir).select(F.col("l_partkey").alias("item_type_id"), _quoted(F.col).alias("o"))
    return texts.select("item_type_id", _book(*[F.concat("o.before", f"o.{side}", "o.behind") for side in ("sell", "buy")]))


def order_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per item, with all its orders. They meet as line items and are made text then, each once for both sides."""
    lines = _order_lines(spark, sf_dir).groupBy(F.col("l_partkey").alias("item_type_id")).agg(F.collect_list(F.struct(*_LINE)).alias("lines"))
    texts = lines.select("item_type_id", F.transform("lines", lambda o: _quoted(lambda name: o[name])).alias("texts"))
    side = lambda name: F.concat_ws("", F.transform("texts", lambda o: F.concat(o["before"], o[name], o["behind"])))
    return texts.select("item_type_id", _book(side("sell"), side("buy")))


HOLDERS = {"BUILDING": "corp", "MACHINERY": "char"}
HOME_LOCATION = "60000003"


def asset_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One holdings document per order: a place with two items and a place without contents."""
    buyers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    ship = F.element_at(F.array(*[F.lit(s) for s in ("12753", "12747", "28844", "20189")]), (key % 4 + 1).cast("int"))
    docs = spread(read(spark, sf_dir, "orders")).join(buyers, "o_custkey").select(
        F.col("c_mktsegment").alias("holder"), "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
        _concat("<holdings><result><rowset><row locationID=\"", key % 5 + 60_000_000, "\" typeID=\"", ship,
                "\"><rowset><row typeID=\"", cust * 3 + 7, "\" quantity=\"", key % 50 + 1,
                "\"/><row typeID=\"", key * 3 + 7, "\" quantity=\"", key % 9 + 1,
                "\"/></rowset></row><row locationID=\"1\" typeID=\"2\"/></rowset></result><cachedUntil>",
                F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "</cachedUntil></holdings>").alias("xdoc"))
    return docs


def job_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One jobs document per order: an invention job and a manufacturing job."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def row(activity: int) -> Column:
        return _concat("<row jobID=\"", key, "\" installerName=\"Clerk ", cust % 100, "\" activityID=\"", activity,
                       "\" blueprintID=\"", key + 1, "\" blueprintTypeID=\"", cust, "\" blueprintTypeName=\"Print ", cust,
                       "\" runs=\"", key % 7 + 1, "\" licensedRuns=\"", key % 3 + 1, "\" probability=\"0.",
                       key % 4 + 2, "\" productTypeID=\"", cust * 3 + 7, "\" productTypeName=\"Thing ", cust,
                       "\" endDate=\"", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "\"/>")

    return spread(read(spark, sf_dir, "orders")).select(
        _concat("<jobs><result><rowset>", row(8), row(1), "</rowset></result></jobs>").alias("xdoc"))


def expiring_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cached_until(asset_docs(spark, sf_dir))
