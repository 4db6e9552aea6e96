from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millwright import session
from millwright.operators import merge, quality, stock, tag_rules, tags
from millwright.sources import catalogue, documents, regions
from tests import golden
from tests.builders import T0, aggregates_of, edges_of, parts_of, regions_of, rows_of, tags_of

T1 = datetime(2015, 2, 1)


# --- files ----------------------------------------------------------------------------


def test_read_catalogue(spark, tmp_path):
    (tmp_path / "a.txt").write_text(
        "label, path, volume, id, me, units\n\n"
        '"PILGRIM"      , "Ships/Recon" ,  "10000" , "11965" , "4"\n'
        "Some words of explanation, with a comma\n"
        '"WITH, COMMA",,0.01,34,,100,0.3,10,extra\n'
        '"BAD ID",,0.01,x34\n'
        + '"' + "L" * 101 + '",,1\n'
        + '"NO VOLUME"\n')
    (tmp_path / "b.txt").write_text("another header\nSECOND FILE,,1.5\n")
    good, rejected = catalogue.read_catalogue(spark, str(tmp_path), catalogue.PART_FILE)
    assert rows_of(good, "label") == [
        ("PILGRIM", "Ships/Recon", Decimal(10000), 11965, Decimal(4), None, None, None),
        ("SECOND FILE", None, Decimal("1.5"), None, None, None, None, None),
        ("WITH, COMMA", None, Decimal("0.01"), 34, None, 100, Decimal("0.3"), 10),
    ]
    starts = sorted(r.line[:8] for r in rejected.collect())
    assert starts == ['"BAD ID"', '"LLLLLLL', '"NO VOLU', "Some wor"]


def test_bom_file_ignores_further_fields(spark, tmp_path):
    lines = "\n".join(f'"{g}" , "{p}" , "{q}" , "TRUE"' for g, p, q in golden.edges())
    (tmp_path / "bom.txt").write_text("good,part,quantity,meffic\nSome prose line\n\n" + lines + "\n")
    good, rejected = catalogue.read_catalogue(spark, str(tmp_path), catalogue.BOM_FILE)
    assert (good.count(), good.select("good").distinct().count(), rejected.count()) == (48, 11, 1)


def test_staging_drops_rows_without_key(spark):
    df = spark.createDataFrame([("a",), (None,)], "label string")
    assert rows_of(catalogue.staging_filter(df, "label")) == [("a",)]


# --- documents ------------------------------------------------------------------------

def _order(number, **fields):
    inner = "".join(f"<{name}>{value}</{name}>" for name, value in fields.items())
    return f"<order id='{number}'>{inner}</order>"


def _book(sells=(), buys=()):
    return f"<quicklook><sell_orders>{''.join(sells)}</sell_orders><buy_orders>{''.join(buys)}</buy_orders></quicklook>"


BOOK = _book(
    sells=[_order(501, region=3, station=17, station_name="Kiln Gate IX", security="1.0", price="11", vol_remain=64, min_volume=8, expires="2016-01-31")],
    buys=[_order(502, price="0.05", region=4, vol_remain=10**10, min_volume=1, station=18, station_name="Slag", security="-1.0", expires="2016-02-29"),
          _order(503, region=4, station=18, station_name="Slag", security="0.45", price="1234567.89", vol_remain=1, min_volume=1, expires="never")])


def test_order_book(spark):
    lone = "<quicklook><other_orders>" + _order(9, price="7") + "</other_orders><buy_orders>" + _order(8, price="1.5") + "</buy_orders></quicklook>"
    docs = spark.createDataFrame([(34, BOOK), (35, lone), (36, "<quicklook/>"), (37, "not xml")], "item_type_id bigint, xdoc string")
    rows = documents.parse_orders(docs).orderBy("item_type_id", "order_id").collect()
    assert [(r.item_type_id, r.direction, r.order_id, r.region, r.price, r.quantity, r.security) for r in rows] == [
        (34, "SELL", 501, 3, 1100, 64, Decimal("1.0")), (34, "BUY", 502, 4, 5, 10**10, Decimal("-1.0")),
        (34, "BUY", 503, 4, 123456789, 1, Decimal("0.45")), (35, "BUY", 8, None, 150, None, None)]
    assert [(r.station_name, str(r.expires)) for r in rows[:3]] == [("Kiln Gate IX", "2016-01-31"), ("Slag", "2016-02-29"), ("Slag", "None")]
    assert [r.order_id for r in documents.parse_orders(docs, sides=["SELL"]).collect()] == [501]
    assert [r.order_id for r in documents.parse_orders(docs, regions=[4]).orderBy("order_id").collect()] == [502, 503]


def test_books_are_parsed_once_and_the_newest_counts(spark):
    """Versions, ties and refusals; an item whose newest document is empty has no orders but is refreshed."""
    cheap, bad = BOOK.replace(">11<", ">10<"), BOOK.replace("0.05", "five")
    rows = [(1, 1, BOOK), (1, 2, cheap), (1, 3, bad), (2, 1, BOOK), (2, 9, "<quicklook/>"), (3, 1, cheap), (3, 1, BOOK), (4, 1, None), (None, 1, BOOK)]
    books = documents.read_books(spark.createDataFrame(rows, "item_type_id bigint, version int, xdoc string"), version="version", sides=["SELL"])
    assert sorted((r.item_type_id or 0, r.price) for r in books.orders.collect()) == [(0, 1100), (1, 1000), (3, 1100)]
    assert sorted(r.item_type_id or 0 for r in books.items.collect()) == [0, 1, 2, 3]
    # the price that cannot be read is on the side not asked for
    assert sorted((r.item_type_id, r.version, r.reason) for r in books.rejected.collect()) == [(1, 3, "unreadable price"), (4, 1, "no document")]


def test_plain_books_mean_what_the_parser_reads(spark):
    """Plain books, cut ones and all others give the orders and the refusals that parsing each of them gives."""
    def line(number, **values):
        known = {"region": number, "station": 7, "station_name": "Kiln - IX", "security": "0.5", "price": "1.25", "vol_remain": 4, "min_volume": 1,
                 "expires": "2016-01-31"} | values
        return f'<order id="{number}">' + "".join(f"<{k}>{v}</{k}>" for k, v in known.items()) + "</order>"

    book = _book([line(1), line(2)], [line(3, price="-0.999")])
    plain = [book, _book(), _book([], [line(4)]), book.replace("><", ">\n  <") + "\n", book.replace(' id="1"', ""), book.replace("Kiln - IX", " a  $1'\" "),
             book.replace("Kiln - IX", ""), book.replace("quicklook", "q"), _book([line(1, price="x")]), _book([line(1, price="")]),
             _book([line(1, price="999999999999999")], [line(2, price="9999999999999999")])]
    other = [book.replace("Kiln", "&amp;"), book.replace("Kiln", "Öl"), book.replace("Kiln", "<!-- -->"), book + "junk", book.replace("quicklook", "price"),
             book.replace("quicklook", "orders"), book.replace("<region>2</region>", f"<region>{'9' * 19}</region>"), book.replace("<region>2</region>", ""),
             book.replace("<price>", "<price>7</price><price>", 1), book.replace("</order>", "<x>1</x></order>"), book.replace('"1"', '"a"'), BOOK, "", "<q/>"]
    cut = [book[:k] for k in range(11, len(book) - 11, 7)]
    rows = [(n, 1, text) for n, text in enumerate([*plain, *other, *cut, None])]
    docs = spark.createDataFrame(rows, "item_type_id bigint, version int, xdoc string")
    shapes = [r.s for r in docs.select(documents._shape("xdoc").alias("s"), "item_type_id").orderBy("item_type_id").collect()]
    assert shapes == ["plain"] * len(plain) + ["other"] * len(other) + ["endless"] * len(cut) + ["none"]
    for sides, regions in ((("SELL", "BUY"), None), (("BUY",), None), (("SELL", "BUY"), [1, 3])):
        books = documents.read_books(docs, version="version", sides=sides, regions=regions)
        parsed = documents.parse_orders(docs, sides=sides, regions=regions)
        assert rows_of(books.orders.select(*parsed.columns), "item_type_id", "order_id") == rows_of(parsed, "item_type_id", "order_id")
        refused = documents.rejected(docs, documents.order_book(sides)).select("item_type_id", "version", "xdoc", "reason")
        assert rows_of(books.rejected, "item_type_id") == rows_of(refused, "item_type_id")
        assert books.items.count() + refused.count() == len(rows)


def test_documents_are_marked_by_a_bit_each(spark):
    numbers = [0, 1, 7, 8, 32767, 32768, (1 << 33) + 5, (3 << 33) + 40000]
    some = spark.createDataFrame([(n,) for n in numbers[::2]], "_document bigint")
    every = spark.createDataFrame([(n, str(n)) for n in numbers + [2, 9, 32769, 1 << 34]], "_document bigint, xdoc string")
    assert rows_of(documents._marked(every, documents._marks(some)), "_document") == [(n, str(n)) for n in numbers[::2]]


def test_texts_are_compared_only_where_versions_tie(spark):
    """The key of an item with one newest document is settled without its text; a null version is the lowest, a null key an item."""
    schema = "k bigint, v int, xdoc string, _document bigint"
    clear = spark.createDataFrame([(1, None, "z", 1), (1, 2, "a", 2), (2, None, "b", 3), (None, 1, "c", 4)], schema)
    found = documents._newest(clear, "k", "v", "xdoc")
    assert sorted(r._document for r in found.collect()) == [2, 3, 4]
    assert "xdoc" not in found._jdf.queryExecution().analyzed().toString()
    tied = clear.unionByName(spark.createDataFrame([(2, None, "a", 9), (None, 1, "c", 5), (1, 1, "z", 7)], schema))
    assert sorted((r.k or 0, r._document) for r in documents._newest(tied, "k", "v", "xdoc").collect()) == [(0, 5), (1, 2), (2, 3)]


def test_refused_documents(spark):
    rows = [(1, BOOK), (2, BOOK[:-30]), (3, "not xml"), (4, None), (5, BOOK.replace(">11<", ">1,000.00<")), (6, "<quicklook/>"), (7, ""),
            (8, BOOK.replace("<price>11</price>", ""))]
    docs = spark.createDataFrame(rows, "item_type_id bigint, xdoc string")
    why = {r.item_type_id: r.reason for r in documents.rejected(docs, documents.ORDER_BOOK).collect()}
    assert why == {2: "not well-formed", 3: "not well-formed", 4: "no document", 5: "unreadable price", 7: "not well-formed", 8: "unreadable price"}
    assert rows_of(documents.accepted(docs, documents.ORDER_BOOK).select("item_type_id"), "item_type_id") == [(1,), (6,)]
    assert {r.item_type_id for r in documents.parse_orders(docs).collect()} == {1}


def test_assets_one_level_deep(spark):
    doc = """<api><result><rowset><row locationID="60" typeID="27"><rowset>
      <row typeID="34" quantity="5"/><row typeID="35" quantity="7"><rowset><row typeID="36" quantity="1"/></rowset></row>
    </rowset></row><row locationID="61" typeID="28"/></rowset></result><cachedUntil>2015-07-01 10:00:00</cachedUntil></api>"""
    docs = spark.createDataFrame([("me", doc)], "holder string, xdoc string")
    assert rows_of(documents.parse_assets(docs), "item_type") == [("me", "60", "27", "34", 5), ("me", "60", "27", "35", 7)]
    stamp = documents.cached_until(docs, "Europe/Helsinki").first().cached_until
    assert stamp == datetime(2015, 7, 1, 12)


def test_jobs_of_one_activity(spark):
    row = '<row jobID="{}" installerName="X" activityID="{}" runs="2" licensedRuns="3" probability="0.4" productTypeID="77" endDate="2015-01-05 00:00:00"/>'
    doc = "<api><result><rowset>" + row.format(1, 8) + row.format(2, 1) + "</rowset></result></api>"
    rows = documents.parse_jobs(spark.createDataFrame([(doc,)], "xdoc string")).collect()
    assert [(r.job_id, r.runs, r.product_type_id, r.date_end) for r in rows] == [("1", 2, 77, datetime(2015, 1, 5))]


def test_region_literals(spark):
    got = regions.region_literals(spark)
    assert (got.count(), got.select("region").distinct().count(), got.select("name_region").distinct().count()) == (64, 64, 64)
    assert quality.region_conflicts(got).count() == 0


# --- upserts --------------------------------------------------------------------------


def test_upsert_parts(spark):
    target = parts_of(spark, [(1, "A", {"pile": 9}), (7, "B", {"external_id": None}), (3, "GONE", {})])
    loaded = spark.createDataFrame(
        [("A", 555, Decimal(2), None, None, None, None), ("B", 1, Decimal(1), Decimal(0), 1, None, None), ("NEW", None, Decimal(3), Decimal(5), 40, None, None)],
        "label string, external_id bigint, volume decimal(15,3), material_efficiency decimal(10,3), outcome_units bigint, base_invent_success decimal(10,3), base_invent_copies bigint")
    after = merge.upsert_parts(target, loaded)
    rows = {r.label: r for r in after.collect()}
    assert set(rows) == {"A", "B", "GONE", "NEW"}
    assert (rows["A"].part_id, rows["A"].external_id, rows["A"].volume, rows["A"].pile, rows["A"].outcome_units) == (1, 555, 2, 9, 1)
    # null to 1 is a change, unless the old comparison is asked for
    assert rows["B"].external_id == 1
    assert {r.label: r for r in merge.upsert_parts(target, loaded, "legacy_nvl").collect()}["B"].external_id is None
    assert rows["NEW"].part_id == 8 and rows["NEW"].outcome_units == 40 and rows["NEW"].pile is None
    # loading the same again changes nothing
    again = merge.upsert_parts(after, loaded)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, after.collect()), key=str)


def test_upsert_edges(spark):
    parts = parts_of(spark, [(1, "A", {}), (2, "B", {}), (3, "C", {})])
    target = edges_of(spark, [(1, 2, 5)], parts)
    loaded = spark.createDataFrame([("A", "B", Decimal(6)), ("A", "C", Decimal(7))], "good string, part string, quantity decimal(10,3)")
    rows = merge.upsert_edges(target, loaded, parts).orderBy("part_id").collect()
    assert [(r.edge_id, r.good_id, r.part_id, r.quantity) for r in rows] == [(0, 1, 2, 6), (1, 1, 3, 7)]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "item bigint, cached_until timestamp_ntz, xdoc string")


def test_document_caches(spark):
    cache = docs_of(spark, [(1, T1, "old"), (2, T0, "old")])
    incoming = docs_of(spark, [(1, T0, "new"), (2, T1, "new"), (3, T0, "new")])
    assert [r[2] for r in rows_of(merge.upsert_newer_docs(cache, incoming, "item"), "item")] == ["old", "new", "new"]
    assert [r[2] for r in rows_of(merge.upsert_docs(cache, incoming, "item"), "item")] == ["new", "new", "new"]


def test_replace_snapshot_of_an_emptied_item(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "part_id bigint, x string")
    fresh = spark.createDataFrame([(1, "z")], "part_id bigint, x string")
    refreshed = spark.createDataFrame([(1,), (2,)], "part_id bigint")
    assert rows_of(merge.replace_snapshot(target, fresh, refreshed, "part_id")) == [(1, "z")]


def test_prices_keep_stale_rows(spark):
    old = aggregates_of(spark, [(1, "SELL", 1, 10, 5, 6), (1, "SELL", 2, 10, 5, 6), (2, "BUY", 1, 1, 1, 1)])
    fresh = aggregates_of(spark, [(1, "SELL", 1, 10, 5, 6), (1, "SELL", 3, 4, 4, 4)]).withColumn(
        "time_quotes_exec", F.lit(T1).cast("timestamp_ntz"))
    after = merge.upsert_prices(old, fresh)
    assert [(r.part_id, r.region, r.time_quotes_exec) for r in after.orderBy("part_id", "region").collect()] == [
        (1, 1, T0), (1, 2, T0), (1, 3, T1), (2, 1, T0)]
    assert merge.upsert_prices(old, fresh, prune=True).where("region = 2").count() == 0


def test_insert_only(spark):
    after = merge.upsert_regions(regions_of(spark, [(1, "NORTH")]), regions_of(spark, [(1, "RENAMED"), (2, "SOUTH")]))
    assert rows_of(after, "region") == [(1, "NORTH"), (2, "SOUTH")]


# --- tags -----------------------------------------------------------------------------


def test_keywords(spark):
    items = spark.createDataFrame([(1, "/Ships//Recon Ships/ships/"), (2, None), (3, "/")], "id bigint, path string")
    found = tags.explode_keywords(items, "id", "path")
    assert rows_of(found, "keyword") == [(1, "RECON SHIPS"), (1, "SHIPS")]
    words = spark.createDataFrame([(5, "SHIPS")], "keyword_id bigint, keyword string")
    grown, bridge = tags.encode_keywords(words, found)
    assert rows_of(grown, "keyword_id") == [(5, "SHIPS"), (6, "RECON SHIPS")]
    assert rows_of(bridge, "keyword_id") == [(5, 1), (6, 1)]
    assert tags.add_tags(found, found).count() == 2


def test_tag_rules(spark):
    labels = ["ISHTAR BLUEPRINT COPY", "ONYX BLUEPRINT COPY", "LOKI BLUEPRINT COPY", "GILA BLUEPRINT COPY",
              "LOKI OFFENSIVE - X BLUEPRINT COPY", "A - B", "ISHTAR"]
    parts = parts_of(spark, [(i, label, {}) for i, label in enumerate(labels)])
    got = {}
    for i, k in rows_of(tags.apply_rules(parts, tag_rules.RULES)):
        got.setdefault(labels[i], set()).add(k)
    assert got == {
        "ISHTAR BLUEPRINT COPY": {"INVENTION"}, "ONYX BLUEPRINT COPY": {"BLUEPRINTS", "INVENTION"},
        "LOKI BLUEPRINT COPY": {"BLUEPRINTS", "REVERSE ENGINEERING"}, "GILA BLUEPRINT COPY": {"BLUEPRINTS", "CONTRACTS"},
        "LOKI OFFENSIVE - X BLUEPRINT COPY": {"BLUEPRINTS", "REVERSE ENGINEERING"}}


# --- stock ----------------------------------------------------------------------------


def test_stock(spark):
    parts = parts_of(spark, [(1, "A", {}), (2, "B", {}), (3, "C", {"external_id": None, "pile": None})])
    assets = spark.createDataFrame(
        [("corp", "60", "27", "101", 5), ("corp", "61", "27", "101", 100), ("char", "9", "12753", "101", 3),
         ("char", "9", "99999", "102", 50), ("corp", "60", "27", "999", 1)],
        "holder string, location_id string, location_type string, item_type string, quantity bigint")
    assert stock.known_assets(assets, parts).count() == 4
    holders = [stock.Holder("corp", "corp"), stock.Holder("char", "char")]
    # every load overwrites the one before: the last holder stands
    assert rows_of(stock.stock(assets, parts, holders, "60"), "part_id") == [(1, 3), (2, 0)]
    summed = stock.stock(assets, parts, holders, "60", mode="sum")
    assert rows_of(summed, "part_id") == [(1, 8), (2, 0)]
    assert [r.pile for r in stock.upsert_stock(parts, summed).orderBy("part_id").collect()] == [8, 0, None]
    # which ships count is a parameter
    assert rows_of(stock.stock(assets, parts, holders, "60", ["99999"]), "part_id") == [(1, 0), (2, 50)]


# --- checks ---------------------------------------------------------------------------


def test_stored_tables_are_packed(spark):
    """Documents that are much alike take little room."""
    stored = session.materialize(spark.range(2000).select(F.concat(F.lit(BOOK), F.col("id").cast("string")).alias("xdoc")), "packed")
    assert all(".zstd." in name for name in stored.inputFiles())


def test_golden_orphan(spark):
    labels = sorted({x for e in golden.edges() for x in e[:2]} - {"CONSTRUCTION BLOCKS"})
    parts = parts_of(spark, [(i, x, {}) for i, x in enumerate(labels)])
    edges = spark.createDataFrame([(g, p) for g, p, _ in golden.edges()], "good string, part string")
    assert rows_of(quality.orphan_edges(edges, parts)) == [("PILGRIM", "CONSTRUCTION BLOCKS", "part", "CONSTRUCTION BLOCKS")]


def test_load_violations(spark):
    parts = parts_of(spark, [(1, "A", {}), (2, "A", {}), (3, "C", {"external_id": 101}), (4, "D", {"external_id": None}), (5, "E", {"external_id": None})])
    edges = edges_of(spark, [(1, 3, 1), (3, 1, 1), (4, 4, 1), (5, 9, 1)], parts)
    got = {(r.rule, r.key) for r in quality.load_violations(parts, edges).collect()}
    assert got == {("duplicate label", "A"), ("duplicate external id", "101"), ("good equals part", "D"),
                   ("not in catalogue", "9"), ("cycle", "1"), ("cycle", "3"), ("cycle", "4")}


def test_constraint_violations(spark):
    parts = parts_of(spark, [(1, "A", {"volume": None}), (2, "B", {})])
    edges = edges_of(spark, [(1, 2, 1), (1, 2, 1), (1, 9, 1)], parts)
    orders = spark.createDataFrame([(1, "SELL", 1, 5, 0, 1), (8, "HOLD", 9, 5, 1, 1)],
                                   "part_id bigint, direction string, region bigint, price bigint, quantity bigint, min_qty bigint")
    agg = aggregates_of(spark, [(1, "SELL", 1, 1, 1, 0)])
    got = {(r.rule, r.key) for r in quality.constraint_violations(
        parts, edges, tags_of(spark, [(1, "X"), (1, "X"), (7, "Y")]), orders, agg, regions_of(spark)).collect()}
    assert got == {("part.volume not null", "1"), ("edge unique", "1"), ("edge.part_id in catalogue", "2"), ("tag unique", "1"),
                   ("tag.part_id in catalogue", "7"), ("order direction", "8"), ("order.part_id in catalogue", "8"),
                   ("order.region known", "8"), ("order.quantity positive", "1"), ("aggregate.price_average positive", "1")}


def test_checks_shuffle_keys_alone(spark):
    """Keys held twice are counted, without a window or a sort; null keys do not collide; each unknown id comes once."""
    parts = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "part_id bigint")
    found = quality._checks(parts, quality._not_null("part", parts.where("false"), "part_id", ("part_id",)), unique={"part unique": ["part_id"]})
    assert sorted(r.rule for r in found.collect()) == ["part unique", "part.part_id not null", "part.part_id not null"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    edges = edges_of(spark, [(1, 2, 1), (1, 7, 1), (1, 7, 2)])
    assert sorted(r.part_id for r in quality._unknown(parts, "part_id", [(edges, "part_id"), (edges, "good_id")]).collect()) == [7]


def test_nulls_are_violations(spark):
    schema = "part_id bigint, direction string, region bigint, price bigint, quantity bigint, min_qty bigint"
    orders = spark.createDataFrame([(1, "SELL", 1, None, 2, 1), (None, "BUY", 1, 5, None, 1), (1, None, None, 5, 1, None)], schema)
    parts = parts_of(spark, [(1, "A", {}), (1, "B", {}), (2, None, {})])
    got = sorted(((r.rule, r.key, r.detail) for r in quality.constraint_violations(
        parts, edges_of(spark, [(1, 2, 1)]), tags_of(spark, [(1, None), (1, None), (None, "X")]), orders,
        aggregates_of(spark, [(1, "BUY", 1, None, 5, 5)]), regions_of(spark, [(1, "A"), (1, "B"), (None, "B"), (4, None)])).collect()), key=lambda r: (r[0], r[1] or "", r[2]))
    assert got == sorted([
        ("aggregate.samples not null", "1", "samples"), ("order.direction not null", "1", "direction"), ("order.min_qty not null", "1", "min_qty"),
        ("order.part_id not null", None, "part_id"), ("order.price not null", "1", "price"), ("order.quantity not null", None, "quantity"),
        ("order.region not null", "1", "region"), ("part unique", "1", "1"), ("part.label not null", "2", "label"),
        ("region name unique", "B", "B"), ("region unique", "1", "1"), ("region.name_region not null", "4", "name_region"),
        ("region.region not null", None, "region"), ("tag.keyword not null", "1", "keyword"), ("tag.keyword not null", "1", "keyword"),
        ("tag.part_id not null", None, "part_id")], key=lambda r: (r[0], r[1] or "", r[2]))


def test_ambiguous_and_unresolved_edges_are_refused(spark):
    parts = parts_of(spark, [(1, "A", {}), (2, "B", {}), (3, "C", {})])
    loaded = spark.createDataFrame([("A", "B", 1), ("A", "B", 2), ("A", "NOPE", 3), ("A", "C", 4), (None, "C", 1), ("C", "C", 1), ("B", "C", None)],
                                   "good string, part string, quantity int")
    assert rows_of(merge.upsert_edges(edges_of(spark, []), loaded, parts).select("good_id", "part_id", F.col("quantity").cast("int"))) == [(1, 3, 4)]
    assert sorted((r.good or "", r.part, r.reason) for r in merge.refused_edges(loaded, parts).collect()) == [
        ("", "C", "good not in catalogue"), ("A", "B", "edge loaded twice"), ("A", "B", "edge loaded twice"), ("A", "NOPE", "part not in catalogue"),
        ("B", "C", "no quantity"), ("C", "C", "good equals part")]
    twice = parts.select(*[c for c in parts.columns if c != "part_id"]).unionByName(parts.where("label = 'A'").drop("part_id"))
    assert [r.label for r in merge.refused_parts(twice).collect()] == ["A", "A"]
    assert sorted(r.label for r in merge.upsert_parts(parts.where("label = 'C'"), twice).collect()) == ["B", "C"]


def test_region_conflicts(spark):
    df = regions_of(spark, [(1, "A"), (1, "B"), (2, "C"), (3, "C"), (4, "D"), (4, "D")])
    assert rows_of(quality.region_conflicts(df), "region", "name_region") == [(1, "A"), (1, "B"), (2, "C"), (3, "C")]


def test_unknown_change_rule(spark):
    with pytest.raises(ValueError):
        merge.upsert(regions_of(spark), regions_of(spark), ["region"], ["name_region"], changed="maybe")


def test_price_check_copies_no_prices(spark):
    """Prices are looked at where they stand, on either side, a missing one included; no array of both sides is made."""
    order = "<order id='1'><region>1</region>{}</order>"
    book = "<quicklook><sell_orders>{}</sell_orders><buy_orders>{}</buy_orders></quicklook>"
    good, bad, none = (order.format(p) for p in ("<price>1.50</price>", "<price>x</price>", ""))
    docs = spark.createDataFrame([(i, book.format(*sides)) for i, sides in enumerate(
        [(good, good), (good, ""), ("", ""), (good, bad), (bad, good), (good + none, good), (good, good + none)])], "item int, xdoc string")
    for sides in (["SELL"], ["BUY"], ["SELL", "BUY"]):
        opened = documents.opened(docs, documents.order_book(sides))
        assert sorted((r.item, r._fault) for r in opened.collect()) == [(i, "unreadable price" if i > 2 else None) for i in range(7)]
        plan = opened._jdf.queryExecution().optimizedPlan().toString()
        assert "exists(" in plan and "concat(" not in plan
