from datetime import datetime
from decimal import Decimal

import pytest

from millwright import Params
from millwright.functions.numbers import present
from millwright.operators import tag_rules
from millwright.operators.stock import Holder
from millwright.plans.jobs import Catalogue, LoadRefused, Market, load_catalogue, refresh_market, refresh_stock
from millwright.schemas import AGGREGATE, EDGE, ORDER, PART, TAG
from millwright.sources.catalogue import BOM_FILE, PART_FILE, read_catalogue
from tests.builders import parts_of
from tests.test_streaming import book

PART_LINES = """label,path,volume,id,me,units
SHIP,/Ships/Cruisers,100,10,4,
PLATE,Components,1,11,10,
LOKI BLUEPRINT COPY,Prints,0,,,
"""
BOM_LINES = "good,part,quantity\nSHIP,PLATE,5\n"


def files(spark, tmp_path, part_lines=PART_LINES, bom_lines=BOM_LINES):
    (tmp_path / "parts.txt").write_text(part_lines)
    (tmp_path / "bom.txt").write_text(bom_lines)
    return (read_catalogue(spark, str(tmp_path / "parts.txt"), PART_FILE)[0],
            read_catalogue(spark, str(tmp_path / "bom.txt"), BOM_FILE)[0])


def empty(spark):
    return Catalogue(*[spark.createDataFrame([], s) for s in (PART, EDGE, TAG)])


def test_catalogue_load_and_reload(spark, tmp_path):
    first = load_catalogue(empty(spark), *files(spark, tmp_path), rules=tag_rules.RULES)
    ids = {r.label: r.part_id for r in first.parts.collect()}
    assert sorted(ids.values()) == [1, 2, 3]
    assert [(r.good_id, r.part_id, int(r.quantity)) for r in first.edges.collect()] == [(ids["SHIP"], ids["PLATE"], 5)]
    tags = {(r.part_id, r.keyword) for r in first.tags.collect()}
    loki = ids["LOKI BLUEPRINT COPY"]
    assert tags == {(ids["SHIP"], "SHIPS"), (ids["SHIP"], "CRUISERS"), (ids["PLATE"], "COMPONENTS"), (loki, "PRINTS"),
                    (loki, "BLUEPRINTS"), (loki, "REVERSE ENGINEERING")}
    again = load_catalogue(first, *files(spark, tmp_path, PART_LINES.replace(",4,", ",5,"), BOM_LINES.replace("5", "6")))
    assert {r.label: (r.part_id, r.material_efficiency) for r in again.parts.collect()}["SHIP"] == (ids["SHIP"], 5)
    assert again.edges.first().quantity == 6
    # what is no longer loaded stays
    assert again.tags.count() == 6


@pytest.mark.parametrize("more_parts,more_edges,rule", [
    ("SHIP,,1,99\n", "", "duplicate label"), ("OTHER,,1,10\n", "", "duplicate external id"),
    ("", "SHIP,SHIP,1\n", "good equals part"), ("", "SHIP,NOWHERE,1\n", "not in catalogue"),
    ("", "PLATE,SHIP,1\n", "cycle"),
])
def test_bad_loads_are_refused(spark, tmp_path, more_parts, more_edges, rule):
    rows = files(spark, tmp_path, PART_LINES + more_parts, BOM_LINES + more_edges)
    with pytest.raises(LoadRefused, match=rule):
        load_catalogue(empty(spark), *rows)


def test_market_refresh(spark):
    parts = parts_of(spark, [(1, "A", {"external_id": 34}), (2, "B", {"external_id": 35})])
    market = Market(spark.createDataFrame([], ORDER), spark.createDataFrame([], AGGREGATE))
    params = Params(notable_supply=0)

    def refresh(market, now, rows):
        docs = spark.createDataFrame(rows, "item_type_id bigint, xdoc string")
        return refresh_market(market, docs, parts, now, Decimal("0.5"), params)

    market = refresh(market, datetime(2015, 3, 1), [(34, book([(1, "10.00", 5), (2, "11.00", 5)])), (35, book([(1, "2.00", 1)]))])
    market = refresh(market, datetime(2015, 3, 2), [(34, book([(1, "10.00", 5)]))])
    assert {(r.part_id, r.region, r.price, r.system_name) for r in market.orders.collect()} == {(1, 1, 1000, "Jita"), (2, 1, 200, "Jita")}
    # same figures keep their stamp, vanished regions keep their row
    assert {(r.part_id, r.region, r.price_average, r.time_quotes_exec.day) for r in market.aggregates.collect()} == {
        (1, 1, 1000, 1), (1, 2, 1100, 1), (2, 1, 200, 1)}
    shown = present(market.aggregates, ["price_top", "price_average"]).where("region = 2").first()
    assert shown.price_average == Decimal("11.00")


def test_stock_refresh(spark):
    parts = parts_of(spark, [(1, "A", {"external_id": 34, "pile": 7})])
    doc = ('<api><result><rowset><row locationID="60" typeID="27"><rowset><row typeID="34" quantity="5"/></rowset></row>'
           "</rowset></result></api>")
    docs = spark.createDataFrame([("corp", doc)], "holder string, xdoc string")
    assert refresh_stock(parts, docs, [Holder("corp", "corp")], "60").first().pile == 5
    assert refresh_stock(parts, docs, [Holder("corp", "corp")], "61").first().pile == 0


def test_bad_documents_change_nothing(spark):
    parts = parts_of(spark, [(1, "A", {"external_id": 34, "pile": 7}), (2, "B", {"external_id": 35})])
    market = Market(spark.createDataFrame([], ORDER), spark.createDataFrame([], AGGREGATE))

    def refresh(market, rows):
        docs = spark.createDataFrame(rows, "item_type_id bigint, cached_until int, xdoc string")
        return refresh_market(market, docs, parts, datetime(2015, 3, 1), Decimal("0.5"), Params(notable_supply=0))

    # of two documents of an item the newer one counts
    market = refresh(market, [(34, 2, book([(1, "10.00", 5)])), (34, 1, book([(1, "9.00", 5), (2, "9.00", 5)])), (35, 1, book([(1, "2.00", 1)]))])
    expected = {(1, 1, 1000), (2, 1, 200)}
    assert {(r.part_id, r.region, r.price) for r in market.orders.collect()} == expected
    market = refresh(market, [(34, 3, book([(1, "10.00", 5)])[:-20]), (35, 3, book([(1, "1,000.00", 5), (1, "6.00", 1)]))])
    assert {(r.part_id, r.region, r.price) for r in market.orders.collect()} == expected

    doc = ('<api><result><rowset><row locationID="60" typeID="27"><rowset><row typeID="34" quantity="5"/></rowset></row>'
           "</rowset></result></api>")
    holders = [Holder("first", "corp"), Holder("second", "corp")]
    piles = lambda rows, mode="last": {r.part_id: r.pile for r in refresh_stock(
        parts, spark.createDataFrame(rows, "holder string, xdoc string"), holders, "60", mode=mode).collect()}
    assert piles([("first", doc[:-9]), ("second", doc[:-9])]) == {1: 7, 2: 0}
    assert piles([("first", doc), ("second", doc[:-9])]) == {1: 5, 2: 0}
    assert piles([("first", doc), ("second", doc[:-9])], "sum") == {1: 7, 2: 0}
