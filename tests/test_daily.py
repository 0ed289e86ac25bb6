"""The kept day rows against the matrix of all purchases."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from basketry.plans import daily
from basketry.plans.daily import DayStore, bought_between
from basketry.plans.features import FLAG_NAMES, FeatureSpec, feature_matrix
from basketry.sources.partitions import partition_values
from conftest import plan_of, rows
from test_features import AS_OF, Shop, edge_shop, random_shop

DAYS = (AS_OF, AS_OF - timedelta(days=13), AS_OF + timedelta(days=40))


def one_time(shop: Shop) -> Shop:
    """The versions of a purchase at one time, which the store asks for."""
    times = {row[0]: row[7] for row in sorted(shop.purchases, key=lambda row: row[-1])}
    shop.purchases = [(*row[:7], times[row[0]], row[8]) for row in shop.purchases]
    return shop


def check(store, inputs, days=DAYS, **options):
    for day in days:
        spec = options.get("spec", FeatureSpec())
        assert rows(store.matrix(inputs.customers, day, **options)) == rows(feature_matrix(inputs, day, spec))


def before(inputs, day):
    return replace(inputs, purchases=inputs.purchases.filter(f"purchase_datetime < '{day}'"))


def purchases_of(spark, inputs, shop):
    return spark.createDataFrame(shop.purchases, inputs.purchases.schema)


@pytest.mark.parametrize("shop", [one_time(edge_shop()), random_shop(3)], ids=["edges", "random"])
def test_build_refresh_and_roll_up_equal_the_matrix(spark, tmp_path, shop):
    inputs = shop.inputs(spark)
    store = DayStore(spark, str(tmp_path))
    first = AS_OF - timedelta(days=20)
    store.build(before(inputs, first), AS_OF - timedelta(days=200))
    store.refresh(inputs, first, AS_OF - timedelta(days=3))
    store.refresh(inputs, AS_OF - timedelta(days=2), AS_OF + timedelta(days=60))
    check(store, inputs, DAYS[1:])
    store.roll_up(AS_OF - timedelta(days=110))
    check(store, inputs, DAYS[:1])
    # limits, windows and hours are free to change
    other = FeatureSpec(week_days=3, month_days=45, night_from_hour=12, morning_before_hour=16, early_to_hour=16, bulk_over=1)
    check(store, inputs, DAYS[:1], spec=other)
    assert rows(store.matrix(inputs.customers, AS_OF, ["new_customer"])) == rows(feature_matrix(inputs, AS_OF, flags=["new_customer"]))


def test_refresh_takes_new_versions_and_clears_days(spark, tmp_path):
    shop = random_shop(5)
    inputs = shop.inputs(spark)
    store = DayStore(spark, str(tmp_path))
    store.build(inputs)
    day = min(row[7] for row in shop.purchases)[:10]
    there = [row for row in shop.purchases if row[7].startswith(day)]
    # one purchase of the day changes, the others go
    shop.purchases = [row for row in shop.purchases if row not in there]
    changed = (*there[0][:4], 99_999.0, *there[0][5:8], 7)
    shop.purchases += [there[0], changed]
    inputs = replace(inputs, purchases=purchases_of(spark, inputs, shop))
    first = date.fromisoformat(day)
    for _ in range(2):
        store.refresh(inputs, first, first)
        check(store, inputs, DAYS[:1])
    shop.purchases = shop.purchases[:-2]
    inputs = replace(inputs, purchases=purchases_of(spark, inputs, shop))
    store.refresh(inputs, first, first)
    check(store, inputs, DAYS[:1])


def test_refresh_reads_no_old_purchases(spark, tmp_path):
    shop = random_shop(8)
    inputs = shop.inputs(spark)
    whole = rows(feature_matrix(inputs, AS_OF))
    first = AS_OF - timedelta(days=10)
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    inputs.purchases.filter(f"purchase_datetime < '{first}'").write.parquet(old)
    inputs.purchases.filter(f"purchase_datetime >= '{first}'").write.parquet(new)
    store = DayStore(spark, str(tmp_path / "store"))
    store.build(replace(inputs, purchases=spark.read.parquet(old)))
    # only the new loads are at hand
    store.refresh(replace(inputs, purchases=spark.read.parquet(new)), first, AS_OF + timedelta(days=30))
    assert rows(store.matrix(inputs.customers, AS_OF)) == whole
    plan = plan_of(bought_between(spark.read.parquet(new), first, AS_OF))
    assert "PushedFilters: [IsNotNull(purchase_datetime), GreaterThanOrEqual(purchase_datetime" in plan


def test_a_refresh_shuffles_no_items_of_other_purchases(spark, tmp_path):
    inputs = random_shop(9).inputs(spark)
    store = DayStore(spark, str(tmp_path / "store"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")  # as if the tables were large
    try:
        for df in store._made(inputs, F.lit("20250801"), few=True).values():
            semi = [line for line in plan_of(df).split("== Physical Plan ==")[1].split("\n") if "LeftSemi" in line]
            assert semi and all("BroadcastHashJoin" in line for line in semi)
    finally:
        spark.conf.set(threshold, kept)


def test_a_roll_up_that_stops_half_way_counts_nothing_twice(spark, tmp_path, monkeypatch):
    shop = random_shop(4)
    inputs = shop.inputs(spark)
    store = DayStore(spark, str(tmp_path))
    store.build(inputs)
    days = partition_values(spark, f"{tmp_path}/partials", "period")
    with monkeypatch.context() as stopped:
        stopped.setattr(daily, "drop_partitions", lambda *_: None)
        store.roll_up(date(2025, 6, 10))
    assert set(days) < set(partition_values(spark, f"{tmp_path}/partials", "period"))
    check(store, inputs, DAYS[:1], spec=FeatureSpec(quarter_days=50))
    store.roll_up(date(2025, 6, 10))
    left = partition_values(spark, f"{tmp_path}/partials", "period")
    assert len(left) < len(days) and any(len(period) == 6 for period in left)
    check(store, inputs, DAYS[:1], spec=FeatureSpec(quarter_days=50))


def test_rolled_up_days_cannot_be_asked_for(spark, tmp_path):
    shop = random_shop(6)
    inputs = shop.inputs(spark)
    store = DayStore(spark, str(tmp_path))
    store.build(inputs, date(2025, 6, 1))
    with pytest.raises(ValueError, match="rolled up, and windows"):
        store.matrix(inputs.customers, AS_OF)
    # without windows that reach there it may be asked
    assert rows(store.matrix(inputs.customers, AS_OF, ["bulk_buyer", "recurrent_buyer"])) == rows(
        feature_matrix(inputs, AS_OF, flags=["bulk_buyer", "recurrent_buyer"])
    )
    with pytest.raises(ValueError, match="whole month"):
        store.refresh(inputs, date(2025, 5, 30), date(2025, 6, 2))
    store.refresh(inputs, date(2025, 5, 1), date(2025, 6, 2))
    quarter = FeatureSpec(quarter_days=50)
    check(store, inputs, DAYS[:1], spec=quarter)


def test_store_of_nothing_and_of_odd_rows(spark, tmp_path):
    shop = Shop()
    shop.customer(1)
    shop.buy(10, 1, 5, items=(1,))
    inputs = shop.inputs(spark)
    store = DayStore(spark, str(tmp_path / "none"))
    store.build(replace(inputs, purchases=inputs.purchases.limit(0)))
    assert rows(store.matrix(inputs.customers, AS_OF)) == rows(
        feature_matrix(replace(inputs, purchases=inputs.purchases.limit(0)), AS_OF)
    )
    odd = [
        (11, 1, 2, 0, 700.0, 2, False, "some day", 1),
        (12, None, 2, 0, 700.0, 2, False, "2025-07-30 10:00:00", 1),
        (13, 1, None, 1, None, None, True, "2025-07-30 10:00:00", 1),
    ]
    shop.purchases += odd
    shop.items.append((1100, 11, 2, 1.0, 10.0, 1))
    inputs = shop.inputs(spark)
    store = DayStore(spark, str(tmp_path / "odd"))
    store.build(inputs)
    check(store, inputs, DAYS[:1])
    assert set(FLAG_NAMES) < set(store.matrix(inputs.customers, AS_OF).columns)
