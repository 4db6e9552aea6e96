from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millwright.functions import numbers, text, times
from millwright.operators.numbering import number_by_hash, number_by_key


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("n,d,expected", [(5, 2, 3), (-5, 2, -3), (4, 3, 1), (-4, 3, -1), (0, 7, 0), (7, 7, 1)])
def test_half_up(spark, n, d, expected):
    assert one(spark, numbers.half_up(F.lit(n), F.lit(d))) == expected
    assert one(spark, numbers.half_up(numbers.whole(F.lit(n)), numbers.whole(F.lit(d)))) == expected


def test_per_cent(spark):
    assert one(spark, numbers.per_cent(F.lit(1), F.lit(3), 1)) == Decimal("33.3")
    assert one(spark, numbers.per_cent(F.lit(1), F.lit(0))) == 0
    assert one(spark, numbers.per_cent(F.lit(None).cast("int"), F.lit(3))) is None
    assert one(spark, numbers.per_cent_exact(F.lit(-25), F.lit(1000), 0)) == -3
    assert one(spark, numbers.per_cent_exact(F.lit(25), F.lit(-1000), 1)) == Decimal("-2.5")
    assert one(spark, numbers.per_cent_exact(F.lit(25), F.lit(0), 1)) == 0
    assert one(spark, numbers.per_cent_exact(F.lit(None).cast("int"), F.lit(5), 1)) is None


def test_greatest_is_null_when_either_is(spark):
    assert one(spark, numbers.greatest_or_null(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(spark, numbers.greatest_or_null(F.lit(1), F.lit(2))) == 2


def test_money(spark):
    assert one(spark, numbers.money(F.lit(12345))) == Decimal("123.45")
    assert one(spark, numbers.to_cents(F.lit("10.92").cast("decimal(15,2)"))) == 1092
    assert one(spark, numbers.cargo_share(F.lit(Decimal("0.010")), F.lit(Decimal("3575")), 71_500, 2)) == Decimal("0.05")


@pytest.mark.parametrize("given_text,expected", [
    ("R.A.M.- STARSHIP KOR-AZOR", "R.A.M.- Starship Kor-Azor"), ("o'neill 4th", "O'Neill 4th"), ("", ""), (None, None)])
def test_initcap(spark, given_text, expected):
    assert one(spark, text.initcap(F.lit(given_text).cast("string"))) == expected


def test_text(spark):
    assert one(spark, text.readable_ore(F.lit("FIERY KERNITE X"))) == "KERNITE X, FIERY"
    assert one(spark, text.readable_ore(F.lit("VELDSPAR"))) == "VELDSPAR"
    assert one(spark, text.concat_skipping_nulls(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == "ab"
    names = spark.createDataFrame([("PILGRIM",), (None,)], "x string")
    # no text asked: everything that is not null
    assert names.where(text.contains_text(F.col("x"), None)).count() == 1
    assert names.where(text.contains_text(F.col("x"), "ilg")).count() == 1
    assert one(spark, text.decimal_text(F.lit(Decimal("1270.080000000000")))) == "1270.08"
    assert one(spark, text.decimal_text(F.lit(Decimal("100.000")))) == "100"


def test_build_list(spark):
    raw = "5x{tengu engineering - augmented capacitor reservoir,pilgrim, ishtar blueprint copy ,ishtar}"
    units, names = one(spark, text.build_list(F.lit(raw)))
    assert units == 5 and names == ["TENGU ENGINEERING - AUGMENTED CAPACITOR RESERVOIR", "PILGRIM", "ISHTAR BLUEPRINT COPY", "ISHTAR"]
    # only a lower-case x separates the units
    assert one(spark, text.build_list(F.lit("5X{a}")))[0] is None


def test_first_list_wins(spark):
    lists = spark.createDataFrame([(0, "9x{a,b}"), (1, "5x{b,c}")], "n int, list string")
    got = text.explode_build_lists(lists, [], "list", "n")
    assert sorted(map(tuple, got.collect())) == [("A", 9), ("B", 9), ("C", 5)]


def test_zone_shift_uses_event_time(spark):
    winter, summer = datetime(2015, 1, 10, 12), datetime(2015, 7, 10, 12)
    for at in (winter, summer):
        got = one(spark, times.zone_shift(F.lit(at).cast("timestamp_ntz"), "Europe/Helsinki"))
        assert got == at.replace(hour=14)
    assert one(spark, times.zone_shift(F.lit(summer).cast("timestamp_ntz"), "UTC")) == summer.replace(hour=11)


def test_cache_ttl(spark):
    now = datetime(2015, 1, 1, 10, 0, 7)
    assert one(spark, times.cache_ttl(F.lit(now).cast("timestamp_ntz"), F.lit(34))) == now.replace(hour=15)


@settings(max_examples=5, deadline=None)
@given(st.sets(st.integers(-10**12, 10**12), min_size=1, max_size=60))
def test_row_numbers(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = {r.k: r.n for r in number_by_key(df, "k", "n", 5).collect()}
    assert got == {k: i + 5 for i, k in enumerate(sorted(keys))}
    assert sorted(r.n for r in number_by_hash(df, ["k"], "n").collect()) == list(range(1, len(keys) + 1))
