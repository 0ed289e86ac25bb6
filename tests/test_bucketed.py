"""Tables in buckets: the same flags, without shuffles up to the customers."""

from __future__ import annotations

import re
import uuid

import pytest

from basketry.plans.features import feature_matrix
from basketry.sources.bucketed import by_purchase, open_buckets, write_buckets
from conftest import rows
from test_features import AS_OF, edge_shop, random_shop


@pytest.fixture(params=["edges", "random"])
def shop(request):
    return edge_shop() if request.param == "edges" else random_shop(9)


def named(name):
    return f"{name}_{uuid.uuid4().hex}"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flags_need_no_shuffle_below_the_customers(spark, tmp_path, shop):
    inputs = shop.inputs(spark)
    purchases = write_buckets(inputs.purchases, named("purchases"), str(tmp_path / "purchases"), "purchase_pk", 4)
    items = write_buckets(inputs.items, named("items"), str(tmp_path / "items"), "purchase_pk", 4)
    matrix = feature_matrix(by_purchase(inputs, purchases, items), AS_OF)
    assert rows(matrix) == rows(feature_matrix(inputs, AS_OF))
    shuffles = set(re.findall(r"Exchange hashpartitioning\((\w+?)#\d+", physical(matrix)))
    assert "customer_pk" in shuffles and not shuffles & {"purchase_pk", "item_pk", "basket_pk"}
    plain = set(re.findall(r"Exchange hashpartitioning\((\w+?)#\d+", physical(feature_matrix(inputs, AS_OF))))
    assert {"purchase_pk", "item_pk"} <= plain


def test_loads_are_added_to_their_buckets(spark, tmp_path):
    shop = random_shop(2)
    inputs = shop.inputs(spark)
    half, path, name = len(shop.purchases) // 2, str(tmp_path / "purchases"), named("purchases")
    make = lambda some: spark.createDataFrame(some, inputs.purchases.schema)
    write_buckets(make(shop.purchases[:half]), name, path, "purchase_pk", 4)
    purchases = write_buckets(make(shop.purchases[half:]), name, path, "purchase_pk", 4, mode="append")
    assert len(list((tmp_path / "purchases").glob("*.parquet"))) == 8
    opened = open_buckets(spark, named("opened"), path, "purchase_pk", 4)
    assert rows(opened) == rows(purchases) == rows(inputs.purchases)
    counted = opened.groupBy("purchase_pk").count()
    assert "Exchange" not in physical(counted) and counted.count() == len({row[0] for row in shop.purchases})
