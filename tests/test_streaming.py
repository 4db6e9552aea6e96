import os
from datetime import datetime
from decimal import Decimal

from millwright import Params
from millwright.session import materialize, scratch, shared_folder
from millwright.streaming.orders import current_aggregates, current_orders, refresh_prices

NOW = datetime(2015, 3, 1)


def book(sells, buys=()):
    def order(region, price, quantity):
        return (f"<order><region>{region}</region><station_name>Jita IV</station_name><security>0.9</security><price>{price}</price>"
                f"<vol_remain>{quantity}</vol_remain><min_volume>1</min_volume><expires>2015-04-01</expires></order>")

    return ("<quicklook><sell_orders>" + "".join(order(*o) for o in sells) + "</sell_orders><buy_orders>"
            + "".join(order(*o) for o in buys) + "</buy_orders></quicklook>")


def test_each_batch_replaces_its_items(spark, tmp_path):
    landed, folder = str(tmp_path / "landed"), str(tmp_path / "state")
    schema = "item_type_id bigint, xdoc string"
    items = spark.createDataFrame([(34, 1), (35, 2)], "item_type_id bigint, part_id bigint")
    params = Params(notable_supply=0)

    def land_and_run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
        docs = spark.readStream.schema(schema).parquet(landed)
        refresh_prices(docs, items, folder, lambda: NOW, Decimal("0.5"), params).awaitTermination()

    land_and_run([(34, book([(1, "10.00", 5), (2, "11.00", 5)])), (35, book([], [(1, "3.00", 2)]))])
    land_and_run([(34, book([(1, "12.00", 4)])), (99, book([(1, "1.00", 1)]))])
    land_and_run([(35, book([]))])

    assert sorted((r.part_id, r.direction, r.region, r.price, r.quantity) for r in current_orders(spark, folder).collect()) == [
        (1, "SELL", 1, 1200, 4)]
    # the folders of the list hold no more than about twice the live rows; no row of the first batch is live
    named = {r[0] for r in spark.read.parquet(f"{folder}/live/orders/2").select("batch_id").collect()}
    assert named == {1} and spark.read.parquet(f"{folder}/live/orders/0").count() == 2
    # region 2 of item 1, and item 2, are quoted no more but keep their last figures
    assert sorted((r.part_id, r.direction, r.region, r.samples, r.price_average) for r in current_aggregates(spark, folder).collect()) == [
        (1, "SELL", 1, 4, 1200), (1, "SELL", 2, 5, 1100), (2, "BUY", 1, 2, 300)]


def test_thin_folders_are_carried_over(spark, tmp_path):
    """Three parts in one batch, two of them replaced: the third moves into the newest folder, and history is opened no more."""
    landed, folder = str(tmp_path / "landed"), str(tmp_path / "state")
    schema = "item_type_id bigint, xdoc string"
    items = spark.createDataFrame([(k, k) for k in range(1, 6)], "item_type_id bigint, part_id bigint")
    batches = [[(k, book([(1, f"{k}.00", k)])) for k in (1, 2, 3)], [(1, book([(1, "7.00", 1)]))], [(2, book([(2, "8.00", 1)])), (4, "<quicklook>")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
        docs = spark.readStream.schema(schema).parquet(landed)
        refresh_prices(docs, items, folder, lambda: NOW, Decimal("0.5"), Params(notable_supply=0)).awaitTermination()
    assert sorted((r.part_id, r.region, r.price) for r in current_orders(spark, folder).collect()) == [(1, 1, 700), (2, 2, 800), (3, 1, 300)]
    assert {r[0] for r in spark.read.parquet(f"{folder}/live/orders/2").select("batch_id").collect()} == {1, 2}
    assert [(r.item_type_id, r.reason) for r in spark.read.parquet(f"{folder}/rejected").collect()] == [(4, "not well-formed")]
    assert sorted((r.part_id, r.region, r.price_average) for r in current_aggregates(spark, folder).collect()) == [
        (1, 1, 700), (2, 1, 200), (2, 2, 800), (3, 1, 300)]


def test_a_batch_leaves_only_its_folders(spark, tmp_path):
    """The documents, orders and figures a batch stores on its way are gone when it ends; tables stored around it stay."""
    kept = materialize(spark.range(3), "kept")
    shared = f"{shared_folder(spark)}/millwright"
    before = set(os.listdir(shared))
    with scratch(spark):
        inner = materialize(spark.range(5), "inner")
        assert inner.count() == 5 and len(os.listdir(shared)) == len(before) + 1
    landed, folder = str(tmp_path / "landed"), str(tmp_path / "state")
    schema = "item_type_id bigint, xdoc string"
    items = spark.createDataFrame([(1, 1), (2, 2)], "item_type_id bigint, part_id bigint")
    for rows in ([(1, book([(1, "2.00", 2)])), (2, "<quicklook>")], [(2, book([(1, "3.00", 3)]))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
        docs = spark.readStream.schema(schema).parquet(landed)
        refresh_prices(docs, items, folder, lambda: NOW, Decimal("0.5"), Params(notable_supply=0)).awaitTermination()
    assert set(os.listdir(shared)) == before and kept.count() == 3
    assert sorted((r.part_id, r.price) for r in current_orders(spark, folder).collect()) == [(1, 200), (2, 300)]
    assert [r.xdoc for r in spark.read.parquet(f"{folder}/rejected").collect()] == ["<quicklook>"]
