"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millwright.functions import numbers, text, times
from millwright.operators import bom, market, merge, quality, stock, tag_rules, tags as tagging
from millwright.plans import checks, manufacture, materials
from millwright.plans.tables import build_units
from millwright.session import DOCUMENTS, materialize, new_table_path
from millwright.sources import catalogue, documents, regions as region_source
from millwright.streaming import orders as order_stream
from workload import adapters as a

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

NOW = datetime(1998, 6, 1, 12, 30, 17)
SECURITY = Decimal("0.5")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles (from exact millionths), arrays as text: types any reader compares."""
    columns = []
    for field in df.schema.fields:
        value, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DecimalType):
            if kind.scale:
                value = numbers.micro(F.round(value, 6)).cast("double") / F.lit(1_000_000.0)
            else:
                value = value.cast("bigint")
        elif isinstance(kind, T.ArrayType):
            value = F.array_join(value.cast("array<string>"), ">")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


def _local(t) -> DataFrame:
    return market.local_regions(t.regions, a.LOCAL_TEXT)


# --- sources --------------------------------------------------------------------------


def _part_file(spark, d):
    rows = a.parts(spark, d).join(a.tag_paths(spark, d), "part_id")
    bad = F.col("part_id") % 17 == 3
    folder = new_table_path(spark, "part-file")
    rows.select(
        "label", "market_browser_path", F.when(bad, "n/a").otherwise(F.col("volume").cast("string")).alias("volume"),
        "external_id", F.col("material_efficiency").cast("string").alias("material_efficiency"), "outcome_units",
        F.lit(None).cast("string").alias("base_invent_success"), F.lit(None).cast("string").alias("base_invent_copies"),
    ).write.option("header", True).option("quoteAll", True).option("emptyValue", "").csv(folder)
    return catalogue.read_catalogue(spark, folder, catalogue.PART_FILE)


@query
def csv_catalogue_parts(spark, d):
    return _part_file(spark, d)[0].drop("base_invent_success", "base_invent_copies")


@query
def csv_rejected_lines(spark, d):
    return _part_file(spark, d)[1].select(F.regexp_extract("line", '^"([^"]*)"', 1).alias("label"))


@query
def csv_catalogue_bom(spark, d):
    folder = new_table_path(spark, "bom-file")
    a.edges(spark, d).select("good", "part", F.col("quantity").cast("string").alias("quantity"),
                             F.lit("TRUE").alias("meffic")).write.option("header", True).csv(folder)
    return catalogue.read_catalogue(spark, folder, catalogue.BOM_FILE)[0]


@query
def staging_filter(spark, d):
    rows = a.read(spark, d, "part").select(
        F.when(F.col("p_size") != 13, F.upper("p_name")).alias("label"), "p_partkey")
    return catalogue.staging_filter(rows, "label")


_QUOTE = ["item_type_id", "order_id", "region", "station", "station_name", "security", "price", "quantity", "min_qty", "expires"]


def _xml_side(spark, d, direction):
    return documents.parse_orders(a.order_docs(spark, d), sides=[direction]).select(*_QUOTE)


@query
def xml_orders_sell(spark, d):
    return _xml_side(spark, d, "SELL")


@query
def xml_orders_buy(spark, d):
    return _xml_side(spark, d, "BUY")


@query
def orders_in_regions(spark, d):
    """Both sides of the book in two of the regions, cut while the orders are arrays still."""
    return documents.parse_orders(a.order_docs(spark, d), regions=[1, 3]).select(*_QUOTE, "direction")


@query
def orders_rejected(spark, d):
    """Per item, of a good, a truncated, a missing and a wrongly priced document: the refused ones, and the orders of the newest good one."""
    docs = materialize(a.order_books(spark, d), "books")
    cut, wrong = F.expr("left(xdoc, length(xdoc) - 20)"), F.regexp_replace("xdoc", r"<price>\d+", "<price>x")
    given = docs.select("item_type_id", F.inline(F.array(*[F.struct(F.lit(v).alias("version"), x.alias("xdoc")) for v, x in (
        (1, F.regexp_replace("xdoc", r"<price>\d", "<price>9")), (2, F.col("xdoc")), (3, cut), (4, F.lit(None).cast("string")), (5, wrong))])))
    books = documents.read_books(given, version="version")
    kept = books.orders.groupBy("item_type_id").agg(F.count(F.lit(1)).alias("orders"), F.sum("price").alias("cents"))
    refused = books.rejected.groupBy("item_type_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "version", "reason"))), ", ").alias("refused"))
    return refused.join(kept, "item_type_id", "left")


def _assets(spark, d):
    return stock.known_assets(documents.parse_assets(a.asset_docs(spark, d)), a.parts(spark, d))


@query
def xml_assets_nested(spark, d):
    return _assets(spark, d).select("holder", "location_id", "location_type", "item_type", "quantity")


@query
def xml_jobs(spark, d):
    return documents.parse_jobs(a.job_docs(spark, d))


@query
def xml_cached_until(spark, d):
    return documents.cached_until(a.asset_docs(spark, d).select("o_orderkey", "xdoc"), "Asia/Tokyo").select(
        "o_orderkey", "cached_until")


# --- upserts --------------------------------------------------------------------------


@query
def upsert_regions(spark, d):
    nations = a.read(spark, d, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("region"), F.col("n_name").alias("name_region"))
    return merge.upsert_regions(a.regions(spark, d), region_source.region_literals(spark).unionByName(nations))


@query
def upsert_parts(spark, d):
    kinds = a.read(spark, d, "part").select(F.col("p_partkey").alias("part_id"), "p_type", "p_size")
    known = a.parts(spark, d).join(kinds, "part_id")
    target = known.where(F.col("p_type") != "SMALL").drop("p_type", "p_size")
    loaded = known.select(
        "label", "external_id", F.when(F.col("p_size") > 40, F.col("volume") + 1).otherwise(F.col("volume")).alias("volume"),
        F.when(F.col("p_size") != 7, F.col("material_efficiency")).alias("material_efficiency"),
        F.when(F.col("p_type") != "LARGE", F.col("outcome_units")).alias("outcome_units"),
        "base_invent_success", "base_invent_copies")
    return merge.upsert_parts(target, loaded).select(
        "label", "external_id", "volume", "material_efficiency", "outcome_units", "pile")


@query
def upsert_bom(spark, d):
    all_edges = a.edges(spark, d)
    loaded = all_edges.select("good", "part", (F.col("quantity") + F.when(F.col("quantity") > 2, 1).otherwise(0)).alias("quantity"))
    return merge.upsert_edges(all_edges.where(F.col("quantity") < 5), loaded, a.parts(spark, d)).drop("edge_id")


@query
def keyword_explode(spark, d):
    return a.tags(spark, d)


@query
def keyword_dictionary(spark, d):
    known = a.read(spark, d, "part").select(F.upper("p_brand").alias("keyword")).distinct()
    empty = known.where(F.lit(False)).select(F.lit(0).cast("bigint").alias("keyword_id"), "keyword")
    first, _ = tagging.encode_keywords(empty, known.withColumn("part_id", F.lit(0)))
    first = materialize(first, "dictionary")
    words, bridge = tagging.encode_keywords(first, a.tags(spark, d))
    return words.join(bridge, "keyword_id").groupBy("keyword").agg(
        F.count(F.lit(1)).alias("parts"), F.count_distinct("keyword_id").alias("ids"))


def _rule_labels():
    return [*tag_rules.BOUGHT_ON_CONTRACT, *tag_rules.INVENTED, *tag_rules.INVENTED_UNTAGGED, *tag_rules.REVERSE_ENGINEERED]


def _print_labels(spark, d):
    words = F.array(*[F.lit(w) for w in _rule_labels()])
    picked = F.element_at(words, (F.col("p_partkey") % F.size(words) + 1).cast("int"))
    label = (F.when(F.col("p_type") == "PROMO", picked)
             .when(F.col("p_type") == "SMALL", F.concat(F.upper("p_name"), F.lit(" - BLUEPRINT COPY")))
             .otherwise(F.upper("p_name")))
    return a.read(spark, d, "part").select(F.col("p_partkey").alias("part_id"), label.alias("label"))


@query
def keyword_rules(spark, d):
    return tagging.apply_rules(_print_labels(spark, d), tag_rules.RULES)


@query
def tag_union_distinct(spark, d):
    return tagging.apply_rules(_print_labels(spark, d), tag_rules.RULES[3:]).select("part_id").distinct()


def _doc_versions(spark, d, status):
    docs = a.expiring_docs(spark, d).where(F.col("o_orderstatus") == status)
    return merge.keep_latest(docs.select(F.col("o_custkey").alias("item"), "cached_until", "xdoc"), "item", "cached_until")


@query
def asset_cache_upsert(spark, d):
    return merge.upsert_newer_docs(_doc_versions(spark, d, "F"), _doc_versions(spark, d, "O"), "item")


@query
def market_cache_upsert(spark, d):
    return merge.upsert_docs(_doc_versions(spark, d, "F"), _doc_versions(spark, d, "O"), "item")


def _holders():
    return [stock.Holder(name, kind) for name, kind in a.HOLDERS.items()]


@query
def assets_union_all(spark, d):
    return stock.counted_assets(_assets(spark, d), _holders(), a.HOME_LOCATION)


@query
def stock_left_zero(spark, d):
    return stock.stock(_assets(spark, d), a.parts(spark, d), _holders(), a.HOME_LOCATION, mode="sum")


@query
def stock_upsert(spark, d):
    catalogue_parts = a.parts(spark, d)
    piles = stock.stock(_assets(spark, d), catalogue_parts, _holders(), a.HOME_LOCATION)
    return stock.upsert_stock(catalogue_parts, piles).select("part_id", "label", "pile")


@query
def snapshot_replace(spark, d):
    columns = ["part_id", "direction", "region", "price", "quantity"]
    target = a.orders(spark, d).select(*columns)
    refreshed = a.read(spark, d, "part").where(F.col("p_size") > 25).select(F.col("p_partkey").alias("part_id"))
    fresh = target.join(refreshed, "part_id", "left_semi").where(F.col("direction") == "SELL").withColumn(
        "price", F.col("price") + 1)
    return merge.replace_snapshot(target, fresh, refreshed, "part_id")


@query
def price_upsert(spark, d):
    book = a.orders(spark, d)
    early = book.where(F.col("time_quotes_exec") < F.lit(datetime(1998, 1, 1)).cast("timestamp_ntz"))

    def priced(rows, stamp):
        return market.order_depth_average(rows, a.PARAMS).withColumn("time_quotes_exec", F.lit(stamp).cast("timestamp_ntz"))

    return merge.upsert_prices(priced(early, datetime(2020, 1, 1)),
                               priced(book.where(F.col("quantity") > 20), datetime(2020, 2, 1)))


@query
def local_region_set(spark, d):
    return market.local_regions(a.regions(spark, d), a.LOCAL_TEXT)


# --- projections, checks --------------------------------------------------------------


@query
def bom_detail(spark, d):
    return bom.bom_detail(a.edges(spark, d), a.parts(spark, d))


@query
def sells_by_region(spark, d):
    return a.snapshot(spark, d).sells


@query
def buys_by_region(spark, d):
    return a.snapshot(spark, d).buys


@query
def order_relevance(spark, d):
    quotes = documents.parse_orders(a.order_docs(spark, d))
    return market.relevant_orders(quotes, NOW, SECURITY, a.PARAMS).select(
        "item_type_id", "direction", "system_name", "region", "price", "quantity", "min_qty", "expires")


@query
def stale_items(spark, d):
    cache = (
        a.read(spark, d, "lineitem").join(
            a.read(spark, d, "part").where(F.col("p_brand") != "Brand#1").select(F.col("p_partkey").alias("l_partkey")),
            "l_partkey")
        .groupBy((F.col("l_partkey") * 3 + 7).alias("item_type_id")).agg(F.max("l_shipdate").alias("cached_until"))
    )
    return market.stale_items(a.parts(spark, d), a.tags(spark, d), cache, datetime(2001, 8, 15), 5)


@query
def where_used(spark, d):
    return checks.where_used(_rates(spark, d), "widget").select(
        "good", "part", "quantity_raw", "quantity_true_station", "quantity_true_pos")


@query
def browse_produce(spark, d):
    t = a.snapshot(spark, d)
    label = t.parts.select(F.min_by("label", "part_id")).first()[0]
    return checks.browse_produce(t, label).select("produce", "good", "part", "depth", "leaf")


@query
def distinct_goods(spark, d):
    return checks.distinct_goods(a.edges(spark, d))


@query
def keyword_exclusion(spark, d):
    return checks.unusual_efficiency(a.snapshot(spark, d)).select("part_id", "label", "material_efficiency")


@query
def remaining_count(spark, d):
    t = a.snapshot(spark, d)
    return checks.remaining_count(t.parts.where("external_id is not null").select("part_id"))


@query
def has_keyword(spark, d):
    return tagging.has_keyword(a.tags(spark, d), "components")


@query
def dup_label_check(spark, d):
    rows = a.read(spark, d, "part").select(F.upper("p_name").alias("label"))
    return quality.duplicates(rows, ["label"])


@query
def dup_extid_check(spark, d):
    key = F.col("p_partkey")
    rows = a.read(spark, d, "part").select(
        F.when(F.col("p_type") == "PROMO", F.call_function("div", key, F.lit(2).cast("bigint")))
        .when(F.col("p_type") != "SMALL", key * 3 + 1_000_000_007).alias("external_id"))
    return quality.duplicates(rows, ["external_id"])


def _looped_edges(spark, d):
    """The edges plus ways back: from the first input of every product of size 50, and from an input of that of those of size 44 to 49."""
    e = a.edges(spark, d)
    sizes = a.read(spark, d, "part").select(F.col("p_partkey").alias("good_id"), "p_size")
    first = e.where(F.col("edge_id") % 10 == 1).join(sizes, "good_id")
    below = e.where(F.col("edge_id") % 10 <= 2).select(F.col("good_id").alias("part_id"), F.col("part_id").alias("low_id"), F.col("part").alias("low"))
    near = first.where("p_size = 50").select("edge_id", F.col("part_id").alias("good_id"), F.col("good_id").alias("part_id"),
                                             F.col("part").alias("good"), F.col("good").alias("part"), "quantity")
    far = first.where("p_size between 44 and 49").join(below, "part_id").select(
        "edge_id", F.col("low_id").alias("good_id"), F.col("good_id").alias("part_id"), F.col("low").alias("good"), F.col("good").alias("part"), "quantity")
    return e.unionByName(near).unionByName(far)


@query
def self_loop_check(spark, d):
    e = a.edges(spark, d).withColumn("part", F.when(F.col("quantity") == 3, F.col("good")).otherwise(F.col("part")))
    return quality.self_loops(e).select("edge_id", "good", "part")


@query
def bom_cycles(spark, d):
    return bom.bom_cycles(_looped_edges(spark, d))


@query
def orphan_edges(spark, d):
    kept = a.parts(spark, d).join(
        a.read(spark, d, "part").where(F.col("p_type") == "SMALL").select(F.col("p_partkey").alias("part_id")),
        "part_id", "left_anti")
    return quality.orphan_edges(a.edges(spark, d), kept)


@query
def region_conflicts(spark, d):
    nation = a.read(spark, d, "nation")
    nations = nation.select(F.col("n_nationkey").cast("bigint").alias("region"), F.col("n_name").alias("name_region"))
    depots = a.read(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        (F.col("s_suppkey") + 1000).alias("region"), F.concat(F.lit("DEPOT "), F.col("s_acctbal").cast("int")).alias("name_region"))
    return quality.region_conflicts(a.regions(spark, d).unionByName(nations).unionByName(depots))


@query
def aggregates_without_orders(spark, d):
    book = a.orders(spark, d).where(F.col("quantity") > 48)
    return quality.aggregates_without_orders(a.snapshot(spark, d).aggregates, book)


@query
def constraint_violations(spark, d):
    t = a.snapshot(spark, d)
    broken = t.parts.join(a.read(spark, d, "part").select(F.col("p_partkey").alias("part_id"), "p_size"), "part_id")
    broken = broken.where(F.col("p_size") != 50).withColumn("volume", F.when(F.col("p_size") != 49, F.col("volume"))).drop("p_size")
    book = a.orders(spark, d).withColumn("price", F.col("price") - 20_000).withColumn(
        "quantity", F.when(F.col("quantity") != 7, F.col("quantity")))
    tags = t.tags.withColumn("part_id", F.when(F.col("keyword") != "STRATEGIC CRUISERS", F.col("part_id")))
    figures = t.aggregates.withColumn("samples", F.when(F.col("samples") % 10 != 0, F.col("samples")))
    named = t.regions.where("region <> 4").withColumn("name_region", F.when(F.col("region") != 2, F.col("name_region")))
    return quality.constraint_violations(broken, t.edges.unionByName(t.edges.where("quantity = 5")), tags, book, figures, named)


@query
def load_violations(spark, d):
    """Catalogue files with labels and ids twice, edges twice, unknown parts, and goods made of themselves."""
    parts, edges = a.parts(spark, d), a.edges(spark, d).select("good", "part", "quantity")
    part = F.when(F.col("quantity") == 4, F.concat(F.lit("NO "), "part")).when(F.col("quantity") == 3, F.col("good")).otherwise(F.col("part"))
    return quality.load_violations(parts.unionByName(parts.where("part_id % 50 = 0")),
                                   edges.withColumn("part", part).unionByName(edges.where("quantity = 5")))


@query
def refused_edges(spark, d):
    """The same edges, resolved: what the upsert leaves out, and how many rows it has after taking in the rest."""
    parts, edges = a.parts(spark, d), a.edges(spark, d)
    part = F.when(F.col("quantity") == 4, F.concat(F.lit("NO "), "part")).when(F.col("quantity") == 3, F.col("good")).otherwise(F.col("part"))
    loaded = edges.select("good", part.alias("part"), "quantity").unionByName(edges.where("quantity = 5").select("good", "part", "quantity"))
    stored = merge.upsert_edges(edges.where("quantity < 2"), loaded, parts)
    return merge.refused_edges(loaded, parts).unionByName(stored.select("good", "part", "quantity", F.lit("stored").alias("reason")))


# --- market ---------------------------------------------------------------------------


@query
def order_depth_average(spark, d):
    return market.order_depth_average(a.orders(spark, d), a.PARAMS)


@query
def order_depth_hot_groups(spark, d):
    """The same figures with the cell of the cut divided down to four prices and quantities at most."""
    return market.order_depth_average(a.orders(spark, d), a.PARAMS.but(cell_rows=4, radix_bits=12))


@query
def order_depth_exact_steps(spark, d):
    return market.order_depth_average(a.orders(spark, d), a.PARAMS, exact_steps=True)


@query
def econ_region(spark, d):
    t = a.snapshot(spark, d)
    return market.econ_region(t.aggregates, "SELL", _local(t))


@query
def econ_region_buy(spark, d):
    return market.econ_region(a.snapshot(spark, d).aggregates, "BUY")


@query
def local_semi(spark, d):
    t = a.snapshot(spark, d)
    return market.in_local(t.aggregates, _local(t))


@query
def orders_stream(spark, d):
    """Documents landed as files, streamed into order and price tables.

    Every item comes in two batches; the second one holds an older, the right and a truncated document of it. The older
    documents are cheaper, so every group they price is priced again and no figure of theirs may stay.
    """
    landed, folder = new_table_path(spark, "landed"), new_table_path(spark, "stream")
    books = materialize(a.order_books(spark, d), "books", **DOCUMENTS)
    cheaper, cut = F.regexp_replace("xdoc", r"<price>(\d+)\d\.", "<price>$1."), F.expr("left(xdoc, length(xdoc) - 20)")
    first = books.select("item_type_id", F.lit(1).alias("version"), cheaper.alias("xdoc"))
    second = books.select("item_type_id", F.inline(F.array(*[
        F.struct(F.lit(v).alias("version"), x.alias("xdoc")) for v, x in ((2, cheaper), (3, F.col("xdoc")), (4, cut))])))
    items = a.parts(spark, d).select(F.col("part_id").alias("item_type_id"), "part_id")
    for batch in (first, second):
        batch.write.mode("append").options(**DOCUMENTS).parquet(landed)
        docs = spark.readStream.schema(batch.schema).parquet(landed)
        order_stream.refresh_prices(docs, items, folder, lambda: NOW, SECURITY, a.PARAMS, version="version").awaitTermination()
    return order_stream.current_aggregates(spark, folder).drop("time_quotes_exec")


@query
def cart_total(spark, d):
    sells = a.snapshot(spark, d).sells.select("part_id", "region", "samples", "offers_low_range")
    total = materials.grand_total(sells, F.sum(F.col("samples") * F.col("offers_low_range")))
    return sells.withColumn("items_tot", total)


# --- bills of materials ---------------------------------------------------------------


def _rates(spark, d):
    return bom.bom_rates(a.edges(spark, d), a.parts(spark, d), a.tags(spark, d), a.PARAMS)


@query
def bom_rates(spark, d):
    return _rates(spark, d).select("edge_id", "consume_rate_base", "consume_rate_true_station",
                                   "consume_rate_true_pos", "round_kind", "factor")


@query
def bom_quantities(spark, d):
    return _rates(spark, d).select("edge_id", "good", "part", "quantity_raw", "quantity_true_station", "quantity_true_pos")


@query
def bom_explode(spark, d):
    paths = bom.bom_explode(_rates(spark, d))
    return paths.select("produce_id", "good_id", "part_id", "depth", "leaf", "path")


@query
def bom_formula(spark, d):
    return a.snapshot(spark, d).paths.select("path", bom.formula_text(a.snapshot(spark, d).paths).alias("formula_bp_orig"))


@query
def bom_evaluate(spark, d):
    return bom.bom_quantity(a.snapshot(spark, d).paths, F.lit(9)).select("path", F.col("q_orig").alias("quantity"))


@query
def bom_copy_runs(spark, d):
    paths = bom.bom_quantity(a.snapshot(spark, d).paths, F.lit(25).cast("bigint"), F.lit(4).cast("bigint"))
    return paths.select("path", "q_orig", "q_copy")


@query
def leaf_paths(spark, d):
    return bom.leaf_paths(a.snapshot(spark, d).paths).select("produce_id", "good_id", "part_id", "depth")


# --- report building blocks -----------------------------------------------------------


@query
def no_contract_parts(spark, d):
    return manufacture.buildable_products(a.snapshot(spark, d)).select("part_id", "label")


@query
def sell_buy_spread(spark, d):
    return manufacture.sell_buy_spread(a.snapshot(spark, d))


@query
def best_universe_price(spark, d):
    return materials.best_universe_price(a.snapshot(spark, d))


@query
def compare_region_price(spark, d):
    return materials.compare_region_price(a.snapshot(spark, d), "i")


@query
def hub_mid_spread(spark, d):
    return manufacture.hub_mid_spread(a.snapshot(spark, d))


@query
def buy_it_price(spark, d):
    t = a.snapshot(spark, d)
    return manufacture.buy_it_price(t, _local(t))


@query
def product_breakeven(spark, d):
    t = a.snapshot(spark, d)
    return manufacture.product_breakeven(t, local_buy=_local(t))


@query
def component_demand(spark, d):
    t = a.snapshot(spark, d)
    return materials.component_demand(t, a.build_lists(spark, d), 4)


@query
def components_rebuild(spark, d):
    t = a.snapshot(spark, d)
    return materials.components_rebuild(t, materials.component_demand(t, a.build_lists(spark, d), 4))


@query
def ore_value(spark, d):
    return materials.ore_value(materials.ore_yields(a.snapshot(spark, d), Decimal(1000)))


@query
def ore_value_index(spark, d):
    """The sum per ore shown on each of its rows, then distinct."""
    yields = materialize(materials.ore_yields(a.snapshot(spark, d), Decimal(1000)), "ore-yields")
    return yields.join(materials.ore_value(yields), "good_id").select("label_ore", "value_index").distinct()


@query
def cost_share(spark, d):
    return manufacture.cost_share(a.snapshot(spark, d), None, 10)


@query
def parse_build_list(spark, d):
    """Build lists made from every part: two names each, and a second list per item."""
    p = a.read(spark, d, "part")
    size, key = F.col("p_size"), F.col("p_partkey")
    first = F.concat(size, F.lit("x{"), F.col("p_name"), F.lit(", "), key, F.lit("}"))
    second = F.concat(size + 1, F.when(size % 2 == 0, "x{").otherwise("X{"), key, F.lit(" ,"), F.col("p_name"), F.lit(",last}"))
    lists = p.select(key, F.explode(F.array(F.struct(F.lit(0).alias("n"), first.alias("list")),
                                            F.struct(F.lit(1).alias("n"), second.alias("list")))).alias("l"))
    return text.explode_build_lists(lists.select("p_partkey", "l.n", "l.list"), ["p_partkey"], "list", "n")


@query
def build_units_of_lists(spark, d):
    t = a.snapshot(spark, d)
    return build_units(t, a.build_lists(spark, d))


def _priced_parts(spark, d):
    """Every part with a price in cents and a second one two ninths lower."""
    prices = a.read(spark, d, "part").select(
        F.col("p_partkey").alias("part_id"), "p_brand", F.round(F.col("p_retailprice") * 100).cast("bigint").alias("cents"))
    return a.parts(spark, d).join(prices, "part_id").withColumn(
        "low", F.call_function("div", F.col("cents") * 7, F.lit(9).cast("bigint")))


@query
def per_cent(spark, d):
    return _priced_parts(spark, d).select(
        "part_id", numbers.per_cent_exact(F.col("pile") - 250, F.col("pile") % 7, 1).alias("per_cent"),
        numbers.greatest_or_null(F.col("pile"), F.col("external_id")).alias("greatest"))


@query
def readable_ore(spark, d):
    ore = text.readable_ore(F.concat("label", F.lit("-"), "p_brand"))
    return _priced_parts(spark, d).select("part_id", text.initcap(ore).alias("readable_ore"))


@query
def breakeven(spark, d):
    cost = numbers.micro(F.col("cents").cast("decimal(24,6)"))
    brk = numbers.breakeven_micro(cost, F.col("outcome_units"), a.PARAMS.build_cost_multiplier, a.PARAMS.sales_cost_multiplier)
    return _priced_parts(spark, d).select("part_id", brk.alias("break_micro"))


@query
def adjusted_offer(spark, d):
    return _priced_parts(spark, d).select(
        "part_id", numbers.adjusted_offer_x200(F.col("cents"), F.col("low"), 35).alias("adjusted_offer_x200"),
        numbers.to_cents(numbers.money(F.col("cents"))).alias("cents"))


@query
def cargo_share(spark, d):
    share = numbers.cargo_share(F.col("volume"), F.col("pile").cast("decimal(24,6)"), a.PARAMS.deep_transport_m3, 2)
    return _priced_parts(spark, d).select("part_id", share.alias("cargo_share"))


@query
def zone_shift(spark, d):
    return a.read(spark, d, "orders").select(
        "o_orderkey", times.zone_shift(F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int")),
                                       "Asia/Tokyo").alias("host_time"))


@query
def cache_ttl(spark, d):
    now = F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_custkey") % 60).cast("decimal(18,6)"))
    return a.read(spark, d, "orders").select("o_orderkey", times.cache_ttl(now, F.col("o_orderkey")).alias("cached_until"))


# --- reports --------------------------------------------------------------------------


@query
def cheapest_region_for_keyword(spark, d):
    t = a.snapshot(spark, d)
    return materials.cheapest_region_for_keyword(t, "ore", _local(t), "africa")


@query
def materials_for_builds(spark, d):
    t = a.snapshot(spark, d)
    return materials.materials_for_builds(t, a.build_lists(spark, d), bpc_runs=4, local=_local(t))


@query
def materials_for_builds_short(spark, d):
    t = a.snapshot(spark, d)
    return materials.materials_for_builds(t, a.build_lists(spark, d), "components", short_only=True)


@query
def materials_three_tier(spark, d):
    t = a.snapshot(spark, d)
    return materials.materials_three_tier(t, a.build_lists(spark, d), bpc_runs=4, local=_local(t))


@query
def ore_ranking(spark, d):
    return materials.ore_ranking(a.snapshot(spark, d), Decimal(1000), "a")


@query
def blueprint_pipeline(spark, d):
    rows = materials.blueprint_pipeline(a.snapshot(spark, d), documents.parse_jobs(a.job_docs(spark, d)), NOW)
    seconds = F.extract(F.lit("DAY"), F.col("ready_in_days")) * 86_400 + F.extract(F.lit("HOUR"), F.col("ready_in_days")) * 3600 \
        + F.extract(F.lit("MINUTE"), F.col("ready_in_days")) * 60 + F.extract(F.lit("SECOND"), F.col("ready_in_days")).cast("bigint")
    return rows.withColumn("ready_in_days", seconds.cast("bigint")).withColumnRenamed("ready_in_days", "ready_in_seconds")


@query
def practical_price(spark, d):
    return materials.practical_price(a.snapshot(spark, d))


@query
def practical_price_per_region(spark, d):
    return materials.practical_price(a.snapshot(spark, d), "ring", per_region=True)


@query
def part_price_listing(spark, d):
    return materials.part_price_listing(a.snapshot(spark, d), "%widget%", "ASIA")


@query
def what_to_build(spark, d):
    t = a.snapshot(spark, d)
    return manufacture.what_to_build(t, adjust=35, local_buy=_local(t), local_sell=_local(t))


@query
def what_to_build_promising(spark, d):
    t = a.snapshot(spark, d)
    return manufacture.what_to_build(t, keyword="materials", adjust=-20, notable_demand=True, bids_near_break=True,
                                     offers_above_break=True)


@query
def product_cost_breakdown(spark, d):
    t = a.snapshot(spark, d)
    return manufacture.product_cost_breakdown(t, "e", 25, 4, _local(t), _local(t))
