"""Flags against the same rules written out in plain Python, on edge rows and on random data."""

from __future__ import annotations

import random
from collections import defaultdict
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from basketry.operators.lookup import measure
from basketry.plans.features import (
    FLAG_NAMES,
    FeatureSpec,
    duplicate_customers,
    feature_matrix,
    require_customers,
)
from basketry.plans.prepare import MartInputs, SmallSides, hex_keys_as_bytes, items_by_purchase, prepare_purchases
from conftest import plan_of

AS_OF = date(2025, 8, 1)
SPEC = FeatureSpec()
MILK, FRUIT, VEGGIE, MEAT = SPEC.milk_category, SPEC.fruit_category, SPEC.veggie_category, SPEC.meat_category


class Shop:
    """Rows of the mart tables, and what the flags should be."""

    def __init__(self):
        self.customers, self.purchases, self.items = [], [], []
        self.products, self.categories, self.stores = [], [], []
        self.addresses, self.delivery = [], []
        self.methods = [(1, "card", 1), (2, "cash", 1), (3, "online", 1), (2, "cash", 0)]
        for i, name in enumerate((MILK, FRUIT, VEGGIE, MEAT, "чай", "соки"), 1):
            self.categories += [(i, name, 1), (i, "old " + name, 0)]
            self.products.append((i, f"Product {i}", 1.0, False, f"p{i}", i, 1))
        self.products.append((7, "Свежий ХЛЕБ ржаной", 1.0, True, "p7", 99, 1))  # unknown category
        self.products.append((7, "old", 1.0, False, "p7", 1, 0))
        for store in range(1, 5):
            self.stores.append((store, True, store * 10, 1))
        self.addresses += [(10, 100, 1), (20, 200, 1), (30, 100, 1), (30, 100, 1)]  # store 4 has no known city
        self.delivery += [(1, 100, 1), (2, 300, 1), (2, 999, 0)]

    def customer(self, pk, days_ago=400, loyal=True, version=1):
        registered = datetime.combine(AS_OF, datetime.min.time()) - timedelta(days=days_ago)
        self.customers.append((pk, f"cus-{pk}", f"{registered:%Y-%m-%d %H:%M:%S}", loyal, version))

    def buy(self, pk, customer, days_ago, items=(), hour=16, minute=0, total=500.0, store=1, delivery=0,
            delivered=False, method=1, version=1):
        moment = datetime.combine(AS_OF, datetime.min.time()) - timedelta(days=days_ago)
        moment = moment.replace(hour=hour, minute=minute)
        self.purchases.append((pk, customer, store, delivery, total, method, delivered, f"{moment:%Y-%m-%d %H:%M:%S}",
                               version))
        for n, product in enumerate(items):
            self.items.append((pk * 100 + n, pk, product, 1.0, 10.0, 1))

    def inputs(self, spark) -> MartInputs:
        make = spark.createDataFrame
        return MartInputs(
            customers=make(self.customers, "customer_pk bigint, customer_id string, registration_date string, "
                           "is_loyalty_member boolean, version bigint"),
            purchases=make(self.purchases, "purchase_pk bigint, customer_pk bigint, store_pk bigint, "
                           "delivery_address_id bigint, total_amount double, payment_method_id int, "
                           "is_delivery boolean, purchase_datetime string, version bigint"),
            products=make(self.products, "product_pk bigint, product_name string, price double, is_organic boolean, "
                          "product_id string, category_id bigint, version bigint"),
            stores=make(self.stores, "store_pk bigint, store_delivery_available boolean, location_id bigint, "
                        "version bigint"),
            items=make(self.items, "item_pk bigint, purchase_pk bigint, product_pk bigint, quantity double, "
                       "total_price double, version bigint"),
            delivery_addresses=make(self.delivery, "delivery_address_id bigint, delivery_city_id bigint, "
                                    "version bigint"),
            payment_methods=make(self.methods, "payment_method_id int, payment_method_name string, version bigint"),
            categories=make(self.categories, "category_id bigint, category_name string, version bigint"),
            addresses=make(self.addresses, "address_id bigint, store_city_id bigint, version bigint"),
        )

    def expected(self) -> dict[str, dict[str, int]]:
        def last(rows):
            found = {}
            for row in rows:
                if row[0] not in found or row[-1] > found[row[0]][-1]:
                    found[row[0]] = row
            return found

        category = {k: v[1] for k, v in last(self.categories).items()}
        product = {k: (v[1], category.get(v[5], "Без категории"), v[3]) for k, v in last(self.products).items()}
        city_of_address = {k: v[1] for k, v in last(self.addresses).items()}
        store_city = {k: city_of_address.get(v[2], -1) for k, v in last(self.stores).items()}
        delivery_city = {k: v[1] for k, v in last(self.delivery).items()}
        method = {k: v[1] for k, v in last(self.methods).items()}
        items = defaultdict(list)
        for row in last(self.items).values():
            items[row[1]].append(row[2])
        purchases = defaultdict(list)
        for row in last(self.purchases).values():
            purchases[row[1]].append(row)
        words = SPEC.bakery_words
        result = {}
        for pk, customer in last(self.customers).items():
            mine = purchases[pk]
            days = lambda p: (AS_OF - datetime.fromisoformat(p[7]).date()).days
            hour = lambda p: datetime.fromisoformat(p[7]).hour
            known = [(p, product[i]) for p in mine for i in items[p[0]] if i in product]

            def bought(name, limit):
                return {p[0] for p, (_, c, _) in known if c == name and days(p) <= limit}

            def share(test):
                return sum(map(test, mine)) / len(mine) if mine else None

            baskets = [len(items[p[0]]) for p in mine if items[p[0]]]
            visited = {p[2] for p in mine if not p[6]}
            cities = {
                (delivery_city.get(p[3]) if p[6] and delivery_city.get(p[3]) is not None else store_city[p[2]])
                for p in mine
                if p[2] in store_city
            }
            weekend = share(lambda p: datetime.fromisoformat(p[7]).weekday() >= 5)
            average = sum(p[4] for p in mine) / len(mine) if mine else None
            registered = datetime.fromisoformat(customer[2]).date()
            flags = {
                "bought_milk_last_30d": bought(MILK, 30),
                "bought_fruits_last_14d": bought(FRUIT, 14),
                "not_bought_veggies_14d": not bought(VEGGIE, 14),
                "recurrent_buyer": sum(days(p) <= 30 for p in mine) > 2,
                "inactive_14_30": mine and 14 < min(map(days, mine)) <= 30,
                "new_customer": (AS_OF - registered).days <= 30,
                "delivery_user": any(p[6] for p in mine),
                "organic_preference": any(organic for _, (_, _, organic) in known),
                "bulk_buyer": mine and average > 1000,
                "low_cost_buyer": mine and average < 200,
                "buys_bakery": any(w in name.lower() for _, (name, _, _) in known for w in words),
                "loyal_customer": customer[3] and len(mine) >= 3,
                "multicity_buyer": len(cities) > 1,
                "bought_meat_last_week": bought(MEAT, 7),
                "night_shopper": any(hour(p) >= 20 for p in mine),
                "morning_shopper": any(hour(p) < 10 for p in mine),
                "prefers_cash": mine and share(lambda p: method.get(p[5]) == "cash") >= 0.7,
                "prefers_card": mine and share(lambda p: method.get(p[5]) == "card") >= 0.7,
                "weekend_shopper": mine and weekend >= 0.6,
                "weekday_shopper": mine and weekend <= 0.4,
                "single_item_buyer": baskets and baskets.count(1) / len(baskets) >= 0.5,
                "varied_shopper": len({c for _, (_, c, _) in known}) >= 4,
                "store_loyal": len(visited) == 1,
                "switching_store": len(visited) > 1,
                "family_shopper": baskets and sum(baskets) / len(baskets) >= 4,
                "early_bird": any(12 <= hour(p) <= 15 for p in mine),
                "no_purchases": not mine,
                "recent_high_spender": sum(p[4] for p in mine if days(p) <= 7) > 2000,
                "fruit_lover": len(bought(FRUIT, 30)) >= 3,
                "vegetarian_profile": not bought(MEAT, 90),
            }
            result[customer[1]] = {name: int(bool(flags[name])) for name in FLAG_NAMES}
        return result


def computed(matrix):
    return {row.customer_id: {name: row[name] for name in FLAG_NAMES} for row in matrix.collect()}


def edge_shop() -> Shop:
    shop = Shop()
    pk = iter(range(1, 10_000))
    customer = iter(range(1, 1000))

    def new(**kwargs):
        key = next(customer)
        shop.customer(key, **kwargs)
        return key

    new()  # no purchases at all
    for days in (29, 30, 31):
        new(days_ago=days)
    for days in (-3, 0, 7, 8, 14, 15, 30, 31, 90, 91):
        shop.buy(next(pk), new(), days, items=(1, 2, 3, 4))
    for hour, minute in ((9, 59), (10, 0), (11, 59), (12, 0), (15, 59), (16, 0), (19, 59), (20, 0), (0, 0)):
        shop.buy(next(pk), new(), 3, hour=hour, minute=minute)
    for total in (199.99, 200.0, 1000.0, 1000.01):
        shop.buy(next(pk), new(), 40, total=total)
    for totals in ((1000.0, 1000.0), (1000.0, 1000.01)):
        key = new()
        for total in totals:
            shop.buy(next(pk), key, 7, total=total)
    for count in (2, 3):
        key = new(loyal=True)
        other = new(loyal=False)
        for _ in range(count):
            shop.buy(next(pk), key, 30, items=(2,))
            shop.buy(next(pk), other, 31, items=(2,))
    for cash in (6, 7):
        key, card = new(), new()
        for i in range(10):
            shop.buy(next(pk), key, 50 + i, method=2 if i < cash else 3)
            shop.buy(next(pk), card, 50 + i, method=1 if i < cash else 9)  # 9 is no known method
    for weekends in (2, 3):  # of five: 1 August 2025 is a Friday
        key = new()
        for i in range(5):
            shop.buy(next(pk), key, 6 + 7 * i if i < weekends else 7 + 7 * i)
    for single in ((1, 2), (1, 2, 2), (2,)):
        key = new()
        for size in single:
            shop.buy(next(pk), key, 20, items=range(1, size + 1))
        shop.buy(next(pk), key, 20)  # a purchase without items does not count
    for products in ((1, 2, 3), (1, 2, 3, 7), (1, 2, 3, 77), (7,)):
        shop.buy(next(pk), new(), 20, items=products)
    for sizes in ((4,), (4, 3), (5, 3), (4, 4, 77)):
        key = new()
        for size in sizes:
            shop.buy(next(pk), key, 20, items=[5] * min(size, 9))
    for stores, deliveries in (((1, 1), (0, 0)), ((1, 2), (0, 0)), ((1, 3), (0, 0)), ((1, 4), (0, 0)), ((1, 9), (0, 0)),
                               ((9, 9), (1, 2)), ((1, 1), (1, 2)), ((1, 2), (1, 1)), ((1, 2), (5, 1)), ((4, 4), (0, 2))):
        key = new()
        for store, address in zip(stores, deliveries):
            shop.buy(next(pk), key, 20, store=store, delivery=address, delivered=address > 0)
    key = new()
    shop.buy(next(pk), key, 20, delivery=2, delivered=False)  # an address without delivery says nothing
    # versions: a customer, a purchase and an item that were loaded again
    key = new()
    shop.customer(key, days_ago=1, loyal=False, version=2)
    purchase = next(pk)
    shop.buy(purchase, key, 3, items=(1, 4), total=5000.0)
    shop.buy(purchase, key, 60, total=100.0, version=2)
    shop.items += [(purchase * 100, purchase, 7, 1.0, 1.0, 5)]
    # the same rows twice
    shop.purchases.append(shop.purchases[-1])
    shop.items.append(shop.items[-1])
    shop.customers.append(shop.customers[-1])
    # purchases of nobody
    shop.buy(next(pk), 5555, 3, items=(1,))
    shop.buy(next(pk), None, 3, items=(1,))
    return shop


def random_shop(seed: int) -> Shop:
    generator = random.Random(seed)
    shop = Shop()
    for key in range(1, 60):
        shop.customer(key, generator.randint(-2, 60), generator.random() < 0.5)
    for pk in range(1, 600):
        # one customer and one store hold a third of all purchases
        customer = 1 if generator.random() < 0.33 else generator.randint(1, 50)
        store = 1 if generator.random() < 0.33 else generator.randint(1, 6)
        shop.buy(pk, customer, generator.choice((0, 6, 7, 8, 13, 14, 15, 29, 30, 31, 60, 89, 90, 91)),
                 items=[generator.randint(1, 9) for _ in range(generator.randint(0, 6))],
                 hour=generator.randint(0, 23), total=generator.choice((50.0, 150.0, 900.0, 1500.0, 2500.0)),
                 store=store, delivery=generator.randint(0, 3), delivered=generator.random() < 0.4,
                 method=generator.randint(0, 4))
    return shop


@pytest.mark.parametrize("shop", [edge_shop(), random_shop(1), random_shop(2)], ids=["edges", "random1", "random2"])
def test_flags_match_plain_python(spark, shop):
    got = computed(feature_matrix(shop.inputs(spark), AS_OF))
    expected = shop.expected()
    assert got.keys() == expected.keys()
    for customer, flags in expected.items():
        assert got[customer] == flags, customer


def test_edges_reach_both_values_of_every_flag():
    expected = edge_shop().expected().values()
    for name in FLAG_NAMES:
        assert {flags[name] for flags in expected} == {0, 1}, name


def test_single_flags_equal_the_matrix(spark):
    inputs = random_shop(3).inputs(spark)
    whole = computed(feature_matrix(inputs, AS_OF))
    for names in (["varied_shopper"], ["family_shopper", "single_item_buyer"], ["new_customer"], ["multicity_buyer"]):
        part = feature_matrix(inputs, AS_OF, flags=names)
        assert part.columns == ["customer_id", *names]
        assert {row.customer_id: [row[n] for n in names] for row in part.collect()} == {
            customer: [flags[n] for n in names] for customer, flags in whole.items()
        }


def test_large_lookup_sides_give_the_same(spark, monkeypatch):
    """With nothing small enough to broadcast, the shuffled and spread lookups must agree."""
    from basketry.plans import prepare

    inputs = random_shop(4).inputs(spark)
    expected = computed(feature_matrix(inputs, AS_OF))
    monkeypatch.setattr(prepare, "BROADCAST_BYTES", -1)
    nothing = prepare.SmallSides.measure
    monkeypatch.setattr(
        prepare.SmallSides, "measure", classmethod(lambda cls, *a, **k: nothing(*a, **{**k, "max_bytes": -1}))
    )
    matrix = feature_matrix(inputs, AS_OF)
    assert "_salt" in plan_of(matrix)
    assert computed(matrix) == expected


def test_empty_dimensions(spark):
    shop = edge_shop()
    shop.categories, shop.addresses, shop.delivery = [(1, "x", 1)], [(77, 1, 1)], [(77, 1, 1)]
    assert computed(feature_matrix(shop.inputs(spark), AS_OF)) == shop.expected()


def test_any_number_of_categories(spark):
    shop = Shop()
    shop.customer(1)
    shop.categories = [(i, f"it's \\{i}", 1) for i in range(1, 80)]
    shop.buy(1, 1, 3, items=(1, 2, 3, 4))
    assert computed(feature_matrix(shop.inputs(spark), AS_OF))["cus-1"]["varied_shopper"] == 1


def test_matrix_shape(spark):
    shop = edge_shop()
    matrix = feature_matrix(shop.inputs(spark), AS_OF)
    assert matrix.columns == ["customer_id", *FLAG_NAMES] and len(FLAG_NAMES) == 30
    assert {field.dataType.simpleString() for field in matrix.schema.fields[1:]} == {"int"}
    assert duplicate_customers(matrix).count() == 0
    assert duplicate_customers(matrix.unionByName(matrix.limit(1))).first()["rows"] == 2


def test_plan_has_no_cross_join_and_no_python(spark):
    plan = plan_of(feature_matrix(edge_shop().inputs(spark), AS_OF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval"):
        assert word not in plan


def as_hex(inputs):
    """The same inputs with keys as the mart makes them: SHA-256 in hex, "0" for none."""
    def digest(key):
        return F.when(F.col(key) == 0, "0").otherwise(F.sha2(F.col(key).cast("string"), 256))

    keys = {"customers": ["customer_pk"], "purchases": ["purchase_pk", "customer_pk", "store_pk", "delivery_address_id"],
            "products": ["product_pk"], "stores": ["store_pk"], "items": ["item_pk", "purchase_pk", "product_pk"],
            "delivery_addresses": ["delivery_address_id"]}
    return replace(inputs, **{name: getattr(inputs, name).withColumns({k: digest(k) for k in names})
                              for name, names in keys.items()})


@pytest.mark.parametrize("small", [True, False])
def test_keys_as_bytes_and_items_by_purchase_give_the_same(spark, monkeypatch, small):
    shop = random_shop(4)
    packed = items_by_purchase(hex_keys_as_bytes(as_hex(shop.inputs(spark))))
    assert packed.items.schema["purchase_pk"].dataType.simpleString() == "binary"
    assert measure({"items": packed.items})["items"].bytes > 3 * 32 * len(shop.items)
    if not small:
        monkeypatch.setattr(SmallSides, "measure", classmethod(lambda cls, *_args, **_more: cls()))
    assert computed(feature_matrix(packed, AS_OF)) == shop.expected()


def test_a_key_that_is_no_hex_is_an_error(spark):
    inputs = random_shop(4).inputs(spark)
    wrong = replace(as_hex(inputs), products=inputs.products.withColumn("product_pk", F.lit("no hex")))
    with pytest.raises(PySparkException):
        hex_keys_as_bytes(wrong).products.collect()


def test_empty_inputs_are_refused(spark):
    shop = Shop()
    shop.customer(1)
    with pytest.raises(ValueError, match="purchases"):
        require_customers(shop.inputs(spark))


def test_prepare_purchases_does_not_multiply(spark):
    shop = edge_shop()
    inputs = shop.inputs(spark)
    prepared = prepare_purchases(inputs.purchases, inputs.delivery_addresses, inputs.payment_methods)
    assert prepared.count() == len({row[0] for row in shop.purchases})
    row = prepared.filter("purchase_datetime is not null").orderBy("purchase_pk").first()
    assert row.weekday == f"{row.purchase_datetime:%A}" and row.purchase_hour == row.purchase_datetime.hour
