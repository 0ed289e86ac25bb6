"""Documents to raw tables to mart tables to the exported matrix, on hand-written documents."""

from __future__ import annotations

import copy
import hashlib
import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from basketry.functions.keys import Keys
from basketry.operators import latest_version
from basketry.plans.features import FLAG_NAMES
from basketry.plans.mart import (
    DETAILS,
    DIMENSIONS,
    MART_KEYS,
    MartContext,
    contributions,
    mart_rejects,
    mart_table,
    quantity_text,
)
from basketry.plans.pipeline import documents_to_raw, raw_to_mart, run
from basketry.schemas import CORRUPT, RAW_SCHEMAS
from basketry.sources.documents import load_all, read_documents
from basketry.sources.export import export_csv
from basketry.sources.tables import (
    PROJECTIONS,
    Split,
    jdbc_options,
    normalize_unsigned,
    parquet_reader,
    project_mart,
    read_by_month,
    read_mart,
    write_by_month,
)
from basketry.sources.topics import publish, subscribe_folder, write_topic_folder
from basketry.streaming.ingest import REJECTS, drop_replays, ingest_stream, raw_streams, route
from basketry.streaming.marts import live_mart_reader, mart_stream
from conftest import rows

AS_OF = date(2025, 8, 1)
CONTEXT = MartContext(as_of=datetime(2025, 8, 1, tzinfo=timezone.utc))
SENT = "2025-07-31T12:00:00Z"

STORE = {
    "store_id": "Store-1", "store_name": "Лавка", "store_network": "Сеть", "store_type_description": "big",
    "type": "Offline", "categories": ["🥛 Молочные продукты", "🍎 Фрукты и ягоды"],
    "manager": {"name": "Анна", "phone": "8 (900) 1", "email": " A@b.RU "},
    "location": {"country": "Россия", "city": "Омск", "street": "Мира", "house": "1", "postal_code": "644000",
                 "coordinates": {"latitude": 54.9, "longitude": "73.3"}},
    "opening_hours": {"mon_fri": "09-21", "sat": "10-20", "sun": ""},
    "accepts_online_orders": True, "delivery_available": "да", "warehouse_connected": 0,
    "last_inventory_date": "2025-07-01", "kafka_send_date": SENT,
}
PRODUCT = {
    "id": "PRD-1", "name": "Молоко", "group": "🥛 Молочные продукты", "description": None,
    "kbju": {"calories": 60, "protein": 2.9, "fat": "x", "carbohydrates": "4.7"}, "price": "80.5", "unit": "шт",
    "origin_country": "Россия", "expiry_days": "12.7", "is_organic": "yes", "barcode": "4600",
    "manufacturer": {"name": "Завод", "country": "", "website": "WWW", "inn": "77"}, "kafka_send_date": SENT,
}
CUSTOMER = {
    "customer_id": "CUS-1", "first_name": "Иван", "last_name": "Петров", "email": "I@p.ru", "phone": "+7 900",
    "birth_date": "1990-05-05", "gender": "Male", "registration_date": "2025-07-20T10:00:00.123456Z",
    "is_loyalty_member": True, "loyalty_card_number": "C1",
    "purchase_location": {"store_id": "Store-1", "store_name": "Лавка", "store_network": "Сеть",
                          "store_type_description": "big", "country": "Россия", "city": "Омск", "street": "Мира",
                          "house": "1", "postal_code": "644000"},
    "delivery_address": {"country": "Россия", "city": "Тара", "street": "Ленина", "house": "2", "apartment": "3",
                         "postal_code": "646530"},
    "preferences": {"preferred_language": "RU", "preferred_payment_method": "Card", "receive_promotions": False},
    "kafka_send_date": SENT,
}
PURCHASE = {
    "purchase_id": "ORD-1",
    "customer": {"customer_id": "CUS-1", "first_name": "Иван", "last_name": "Петров", "email": "I@p.ru",
                 "phone": "+7 900", "is_loyalty_member": True, "loyalty_card_number": "C1"},
    "store": {"store_id": "Store-1", "store_name": "Лавка", "store_network": "Сеть",
              "store_type_description": "big",
              "location": {"city": "Омск", "street": "Мира", "house": "1", "postal_code": "644000"}},
    "items": [
        {"product_id": "PRD-1", "name": "Молоко", "category": "🥛 Молочные продукты", "quantity": 2, "unit": "шт",
         "price_per_unit": 80.5, "total_price": 161.0, "kbju": {"calories": 60, "protein": 1, "fat": 1,
                                                                "carbohydrates": 1}, "extra": "kept"},
        {"product_id": "PRD-2", "name": "Сыр", "category": "Сыры", "quantity": 0.5, "unit": "кг",
         "total_price": 300, "manufacturer": {"name": "Завод", "inn": "77"}},
        {"product_id": "PRD-3", "name": "Даром", "category": "Сыры", "quantity": 1, "unit": "кг", "total_price": 0},
        {"product_id": "", "name": "?", "category": "Сыры", "quantity": 1, "unit": "кг", "total_price": 5},
    ],
    "total_amount": 461.0, "payment_method": "Cash", "is_delivery": True,
    "delivery_address": {"country": "Россия", "city": "Тара", "street": "Ленина", "house": "2", "apartment": "3",
                         "postal_code": "646530"},
    "purchase_datetime": "2025-07-30T21:15:00.5+03:00", "kafka_send_date": SENT,
}
ALL = {"stores": [STORE], "products": [PRODUCT], "customers": [CUSTOMER], "purchases": [PURCHASE]}


def changed(document, **fields):
    document = copy.deepcopy(document)
    for path, value in fields.items():
        *parents, name = path.split("__")
        target = document
        for parent in parents:
            target = target[parent]
        target[name] = value
    return document


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def messages(spark, documents):
    data = [(topic, json.dumps(d, ensure_ascii=False)) for topic, docs in documents.items() for d in docs]
    return spark.createDataFrame(data, "topic string, value string")


def raw_of(spark, **documents):
    return route(messages(spark, documents))[0]


def write_folder(path, documents):
    path.mkdir(parents=True)
    for i, document in enumerate(documents):
        text = document if isinstance(document, str) else json.dumps(document, ensure_ascii=False, indent=2)
        (path / f"doc-{i}.json").write_text(text, encoding="utf-8")
    return str(path)


def test_raw_rows(spark):
    raw, rejected = route(messages(spark, ALL))
    assert rejected.count() == 0
    for table, schema in RAW_SCHEMAS.items():
        expected = spark.createDataFrame([], schema).schema
        assert [(f.name, f.dataType) for f in raw[table].schema] == [(f.name, f.dataType) for f in expected]
        assert not any(value is None for value in raw[table].first())
    store = raw["raw_stores"].first()
    assert (store.accepts_online_orders, store.delivery_available, store.warehouse_connected) == (True, True, False)
    assert (store.location_latitude, store.location_longitude) == (54.9, 73.3)
    product = raw["raw_products"].first()
    assert (product.price, product.fat, product.carbohydrates, product.expiry_days) == (80.5, 0.0, 4.7, 12)
    assert product.description == "" and product.is_organic is True
    assert product.version == int(datetime(2025, 7, 31, 12, tzinfo=timezone.utc).timestamp())
    purchase = raw["raw_purchases"].first()
    assert json.loads(purchase["items"]) == PURCHASE["items"]
    assert purchase.delivery_apartment == "3" and purchase.total_amount == 461.0


def test_missing_parts_get_defaults(spark):
    bare = {"stores": [{"store_id": "s"}], "products": [{"id": "p"}], "customers": [{"customer_id": "c"}],
            "purchases": [{"purchase_id": "o", "items": None, "customer": None}]}
    raw, rejected = route(messages(spark, bare), F.lit("2025-08-01 00:00:00").cast("timestamp"))
    assert rejected.count() == 0
    assert raw["raw_stores"].first().categories == []
    purchase = raw["raw_purchases"].first()
    assert purchase["items"] == "[]" and purchase.customer_id == "" and purchase.is_delivery is False
    assert raw["raw_customers"].first().birth_date == date(1970, 1, 1)
    for df in raw.values():
        assert not any(value is None for value in df.first())


def test_poison_and_unknown_messages_are_kept_aside(spark):
    data = [("products", '{"id": '), ("products", None), ("returns", "{}"), (None, "{}"), ("stores", json.dumps(STORE))]
    raw, rejected = route(spark.createDataFrame(data, "topic string, value string"))
    assert raw["raw_products"].count() == 0 and raw["raw_stores"].count() == 1
    assert rows(rejected.groupBy("reason").count()) == [("unknown topic", 2), ("unreadable JSON", 2)]


def test_publish_masks_sensitive_topics_only(spark, tmp_path):
    folder = write_folder(tmp_path / "customers", [CUSTOMER])
    customers = read_documents(spark, folder, "customers").good
    value = json.loads(publish(customers, "customers").first().value)
    assert value["email"] == digest("i@p.ru") and value["phone"] == digest("+7900")
    assert value["first_name"] == "Иван" and "Иван" in publish(customers, "customers").first().value
    assert value["_source_file"] == "doc-0.json" and value["kafka_send_date"]
    assert json.loads(publish(customers, "other").first().value)["email"] == "I@p.ru"


def test_read_documents(spark, tmp_path):
    folder = write_folder(tmp_path / "stores", [STORE, '{"store_id": ', changed(STORE, store_id="Store-2")])
    (tmp_path / "stores" / "notes.txt").write_text("no document")
    (tmp_path / "stores" / "bytes.json").write_bytes('{"store_id": "Ж"}'.encode("cp1251"))
    (tmp_path / "stores" / "list.json").write_text('[{"store_id": "x"}]')
    found = read_documents(spark, folder, "stores")
    assert sorted(row.store_id for row in found.good.collect()) == ["Store-1", "Store-2"]
    assert found.good.filter("_source_file = 'doc-0.json'").count() == 1
    assert {row._source_file for row in found.rejected.collect()} == {"doc-1.json", "bytes.json", "list.json"}
    assert CORRUPT not in found.good.columns
    missing = read_documents(spark, str(tmp_path / "nowhere"), "stores")
    assert missing.good.count() == 0 and missing.good.columns == found.good.columns
    (tmp_path / "empty").mkdir()
    assert read_documents(spark, str(tmp_path / "empty"), "stores").good.count() == 0


def test_load_all_refreshes_or_appends(spark, tmp_path):
    folders = {"stores": write_folder(tmp_path / "in" / "stores", [STORE]),
               "products": write_folder(tmp_path / "in" / "products", [PRODUCT, "{"])}
    target = str(tmp_path / "out")
    paths = load_all(spark, folders, target)
    load_all(spark, folders, target)
    assert spark.read.parquet(paths["stores"]).count() == 1
    load_all(spark, folders, target, full_refresh=False)
    assert spark.read.parquet(paths["stores"]).count() == 2
    assert spark.read.parquet(f"{target}/_rejected/products").count() == 2


def test_mart_keys_join_without_lookups(spark):
    mart = raw_to_mart(raw_of(spark, **ALL), CONTEXT)
    first = {name: df.first() for name, df in mart.items()}
    assert first["purchases_details"].customer_pk == first["customers_details"].customer_pk
    assert first["purchases_details"].store_pk == first["stores_details"].store_pk
    assert first["purchases_details"].delivery_address_id == first["dim_delivery_addresses"].delivery_address_id
    assert first["link_customers_stores"].address_id == first["dim_delivery_addresses"].address_id
    assert first["products_details"].category_id == first["dim_categories"].category_id
    assert first["products_details"].category_id in first["stores_details"].category_ids
    assert first["products_details"].manufacturer_id == first["dim_manufacturer"].manufacturer_id
    assert first["dim_manufacturer"].country_id == 0
    assert first["stores_details"].manager_id == first["dim_managers"].manager_id
    assert first["stores_details"].opening_hours_id == first["dim_opening_hours"].opening_hours_id
    assert first["dim_categories"].clear_category_name == "молочные продукты"
    assert first["dim_categories"].category_name == "🥛 молочные продукты"
    addresses = {row.record_source: row for row in mart["dim_address"].collect()}
    assert addresses["raw_stores"].address_id == first["stores_details"].location_id
    assert addresses["raw_customers"].latitude == 0.0
    items = {row.quantity: row for row in mart["purchase_item_details"].collect()}
    assert set(items) == {2.0, 0.5}
    assert items[2.0].manufacturer_id == 0 and items[0.5].manufacturer_id == first["dim_manufacturer"].manufacturer_id
    assert first["dim_payment_method"].payment_method_id == 2 and first["dim_gender"].gender_id == 1
    assert first["purchases_details"].purchase_datetime == datetime(2025, 7, 30, 18, 15)
    countries = {row.record_source for row in mart["dim_countries"].collect()}
    assert mart["dim_countries"].count() == 1 and countries == {"raw_stores"}


BROKEN = {
    "products_details": (PRODUCT, [{"id": ""}, {"name": None}, {"group": ""}, {"unit": ""}, {"price": 0},
                                   {"manufacturer__name": ""}, {"manufacturer__inn": ""}]),
    "customers_details": (CUSTOMER, [{"customer_id": ""}, {"first_name": ""}, {"last_name": None},
                                     {"birth_date": "1900-01-01"}, {"birth_date": "2025-08-02"},
                                     {"registration_date": "2025-08-01T00:00:01Z"}]),
    "stores_details": (STORE, [{"store_id": ""}, {"store_name": ""}, {"location__city": ""}, {"manager__email": ""},
                               {"last_inventory_date": "2025-08-02"}, {"last_inventory_date": "1899-12-31"}]),
    "link_customers_stores": (CUSTOMER, [{"purchase_location__store_id": ""}, {"delivery_address__house": ""}]),
    "purchases_details": (PURCHASE, [{"purchase_id": ""}, {"customer__customer_id": ""}, {"store__store_id": ""},
                                     {"total_amount": 0}, {"total_amount": "much"}]),
}


@pytest.mark.parametrize("target", BROKEN)
def test_quality_gates(spark, target):
    document, faults = BROKEN[target]
    source = contributions(target)[0].source
    topic = source.removeprefix("raw_")
    documents = [document, *[changed(document, **fault) for fault in faults]]
    raw = raw_of(spark, **{topic: documents})
    assert mart_table(target, raw, CONTEXT).count() == 1
    rejects = mart_rejects(target, raw, CONTEXT)[source]
    assert rejects.count() == len(faults)
    assert rejects.filter(F.size("_reasons") != 1).count() == 0


def test_edges_of_dates_pass(spark):
    good = [changed(CUSTOMER, birth_date="1900-01-02"), changed(CUSTOMER, birth_date="2025-08-01"),
            changed(CUSTOMER, birth_date="never"), changed(CUSTOMER, registration_date="2025-08-01T00:00:00Z")]
    assert mart_table("customers_details", raw_of(spark, customers=good), CONTEXT).count() == 4


def test_future_purchases_can_be_refused(spark):
    raw = raw_of(spark, purchases=[PURCHASE, changed(PURCHASE, purchase_datetime="2025-08-02T00:00:00Z")])
    assert mart_table("purchases_details", raw, CONTEXT).count() == 2
    strict = MartContext(as_of=CONTEXT.as_of, reject_future=True)
    assert mart_table("purchases_details", raw, strict).count() == 1


def test_optional_keys(spark):
    store = changed(STORE, type="", store_network=None, location__country="")
    mart = raw_to_mart(raw_of(spark, **{**ALL, "stores": [store]}), CONTEXT)
    row = mart["stores_details"].first()
    assert (row.type_id, row.store_network_id) == (0, 0)
    assert mart["dim_cities"].first().country_id == 0
    assert mart["dim_type_store"].count() == 0 and mart["dim_store_networks"].count() == 0
    incomplete = changed(PURCHASE, delivery_address__apartment="")
    assert mart_table("purchases_details", raw_of(spark, purchases=[incomplete]), CONTEXT).first()[
        "delivery_address_id"] == 0


def test_dimension_rows_are_unique_and_last_version_wins(spark):
    newer = changed(PRODUCT, kafka_send_date="2025-07-31T13:00:00Z", group="МОЛОЧНЫЕ продукты")
    raw = raw_of(spark, products=[newer, PRODUCT, PRODUCT, changed(PRODUCT, id="PRD-9")])
    row = mart_table("dim_categories", raw, CONTEXT).collect()
    assert len(row) == 1 and row[0].category_name == "молочные продукты"
    details = mart_table("products_details", raw, CONTEXT)
    assert details.count() == 4 and latest_version(details, ["product_pk"]).count() == 2


def test_malformed_items_give_no_rows(spark):
    for items in (None, [], "text", [None, {}], {"a": 1}):
        raw = raw_of(spark, purchases=[changed(PURCHASE, items=items)])
        assert mart_table("purchase_item_details", raw, CONTEXT).count() == 0
        assert mart_table("purchases_details", raw, CONTEXT).count() == 1


def test_bad_items_take_no_others_with_them(spark):
    good = PURCHASE["items"][0]
    raw = raw_of(spark, purchases=[changed(PURCHASE, items=[good, 5, "x", None, [good]])])
    assert mart_table("purchase_item_details", raw, CONTEXT).count() == 1


def test_nan_is_not_positive(spark):
    raw = raw_of(spark, purchases=[changed(PURCHASE, total_amount="nan")], products=[changed(PRODUCT, price="nan")])
    assert mart_table("purchases_details", raw, CONTEXT).count() == 0
    assert mart_table("products_details", raw, CONTEXT).count() == 0


def test_quantity_text(spark):
    df = spark.createDataFrame([(2.0,), (0.5,), (10.0,)], "q double")
    assert [row[0] for row in df.select(quantity_text(F.col("q"))).collect()] == ["2", "0.5", "10"]


def test_unsigned_keys_survive(spark):
    df = spark.sql("SELECT CAST(18446744073709551615 AS decimal(20,0)) a, CAST(9223372036854775807 AS decimal(20,0)) b, "
                   "CAST(9223372036854775808 AS decimal(20,0)) c, CAST(5 AS decimal(10,0)) d")
    assert tuple(normalize_unsigned(df).first())[:3] == (-1, 2**63 - 1, -(2**63))
    assert dict(normalize_unsigned(df).dtypes)["d"] == "decimal(10,0)"


def test_projections_prune_and_rename(spark, tmp_path):
    mart = raw_to_mart(raw_of(spark, **ALL), CONTEXT)
    mart["stores_details"].write.parquet(str(tmp_path / "stores_details"))
    stores = read_mart(parquet_reader(spark, str(tmp_path)), "stores_details")
    assert stores.columns == ["store_pk", "store_delivery_available", "location_id", "version"]
    plan = stores._jdf.queryExecution().toString()
    assert "ReadSchema: struct<store_pk:bigint,location_id:bigint,delivery_available:boolean,version:bigint>" in plan
    purchases = project_mart(mart["purchases_details"], "purchases_details").first()
    assert purchases.purchase_datetime == "2025-07-30 18:15:00"
    assert project_mart(mart["dim_units"], "dim_units").columns == mart["dim_units"].columns
    assert set(PROJECTIONS) < set(MART_KEYS)


def test_jdbc_options_split_the_read():
    options = jdbc_options("jdbc:x", "t", Split("pk", 0, 100, 8), user="u")
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "pk" and options["user"] == "u"
    assert options["fetchsize"] == "10000"
    assert "partitionColumn" not in jdbc_options("jdbc:x", "t")


def test_tables_by_month(spark, tmp_path):
    df = spark.sql("SELECT id, timestamp'2025-01-31 23:00:00' + make_dt_interval(0, cast(id as int)) AS load_date FROM range(4)")
    write_by_month(df, str(tmp_path / "t"))
    back = read_by_month(spark, str(tmp_path / "t"), since="202502")
    assert sorted(row.id for row in back.collect()) == [1, 2, 3]
    write_by_month(df, str(tmp_path / "t"), mode="overwrite", rebalance=True)
    assert read_by_month(spark, str(tmp_path / "t")).count() == 4
    assert "PartitionFilters: [isnotnull" in back._jdf.queryExecution().toString()


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 0)], "customer_id string, flag int").repartition(2)
    path = export_csv(df, str(tmp_path), date(2025, 8, 1))
    assert path.endswith("/analytics/analytic_result_2025_08_01.csv")
    assert rows(spark.read.option("header", True).schema(df.schema).csv(path)) == [("a", 1), ("b", 0)]


def test_run_from_folders_to_matrix(spark, tmp_path):
    folders = {
        topic: write_folder(tmp_path / "in" / topic, [*documents, "{broken"]) for topic, documents in ALL.items()
    }
    path = run(spark, folders, str(tmp_path / "work"), AS_OF, CONTEXT)
    matrix = spark.read.option("header", True).csv(path).collect()
    assert len(matrix) == 1 and matrix[0].customer_id == "cus-1"
    ones = {name for name in FLAG_NAMES if matrix[0][name] == "1"}
    assert ones == {"bought_milk_last_30d", "not_bought_veggies_14d", "new_customer", "delivery_user",
                    "organic_preference", "prefers_cash", "weekday_shopper", "vegetarian_profile"}
    again = run(spark, folders, str(tmp_path / "work"), AS_OF, CONTEXT)
    assert again == path and spark.read.option("header", True).csv(path).collect() == matrix


def many(spark):
    documents = {
        "stores": [changed(STORE, store_id=f"S{i}", location__city=f"City {i % 3}") for i in range(6)],
        "products": [changed(PRODUCT, id=f"P{i}", unit=f"u{i % 2}") for i in range(6)],
        "customers": [changed(CUSTOMER, customer_id=f"C{i}", delivery_address__house=str(i)) for i in range(6)],
        "purchases": [changed(PURCHASE, purchase_id=f"O{i}", payment_method=("Card", "x", "y")[i % 3])
                      for i in range(6)],
    }
    documents["purchases"].append(changed(documents["purchases"][0], total_amount=1.0,
                                          kafka_send_date="2025-07-31T13:00:00Z"))
    return messages(spark, documents)


def stream_all(spark, work):
    ingest_stream(subscribe_folder(spark, f"{work}/topics", max_files=2), f"{work}/raw",
                  f"{work}/checkpoint/ingest").awaitTermination()
    for name, stream in raw_streams(spark, f"{work}/raw", RAW_SCHEMAS).items():
        mart_stream(stream, name, f"{work}/mart", f"{work}/checkpoint/mart", CONTEXT).awaitTermination()


def test_streams_equal_the_batch_and_replays_change_nothing(spark, tmp_path):
    work = str(tmp_path)
    everything = many(spark)
    batch = raw_to_mart(route(everything)[0], CONTEXT)
    expected = {}
    for name, df in batch.items():
        expected[name] = rows(df if name in DIMENSIONS else latest_version(df, [MART_KEYS[name]]))
    broken = spark.createDataFrame([("stores", "{"), ("?", "{}")], "topic string, value string")
    write_topic_folder(everything.unionByName(broken).repartition(5), f"{work}/topics")
    stream_all(spark, work)
    read = live_mart_reader(spark, f"{work}/mart")
    for name in MART_KEYS:
        assert rows(read(name)) == expected[name], name
    assert spark.read.parquet(f"{work}/raw/{REJECTS}").count() == 2
    raw_count = spark.read.parquet(f"{work}/raw/raw_purchases").count()

    stream_all(spark, work)  # nothing new: the checkpoint knows
    assert spark.read.parquet(f"{work}/raw/raw_purchases").count() == raw_count

    write_topic_folder(everything, f"{work}/topics")  # the same messages delivered again
    stream_all(spark, work)
    assert spark.read.parquet(f"{work}/raw/raw_purchases").count() == 2 * raw_count
    for name in DETAILS + DIMENSIONS:
        assert rows(read(name)) == expected[name], name


def test_topic_files_are_compressed_and_bounded(spark, tmp_path):
    sent = spark.range(500).select(F.lit("stores").alias("topic"), F.concat(F.lit('{"store_id":"'), "id", F.lit('"}')).alias("value"))
    write_topic_folder(sent.coalesce(1), str(tmp_path / "topics"), file_messages=100)
    files = [path.name for path in (tmp_path / "topics").glob("part-*")]
    assert len(files) == 5 and all(name.endswith(".json.gz") for name in files)
    query = subscribe_folder(spark, str(tmp_path / "topics"), max_files=2).writeStream.format("parquet").option(
        "path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    query.start().awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(sent)


def test_mart_stream_holds_no_batch(spark, tmp_path, monkeypatch):
    raw = raw_of(spark, **ALL)["raw_purchases"]
    write_by_month(raw, str(tmp_path / "raw/raw_purchases"))
    schemas = {"raw_purchases": RAW_SCHEMAS["raw_purchases"]}
    stream = raw_streams(spark, str(tmp_path / "raw"), schemas)["raw_purchases"]
    cached = []
    for name in ("persist", "cache"):
        monkeypatch.setattr(type(raw), name, lambda df, *_args: cached.append(df) or df)
    mart_stream(stream, "raw_purchases", str(tmp_path / "mart"), str(tmp_path / "c"), CONTEXT).awaitTermination()
    assert not cached
    for target in ("purchases_details", "purchase_item_details", "dim_payment_method"):
        there = spark.read.parquet(str(tmp_path / "mart" / target)).drop("source")
        assert rows(there) == rows(mart_table(target, {"raw_purchases": raw}, CONTEXT)), target


def test_drop_replays(spark, tmp_path):
    df = spark.sql("SELECT id % 50 AS id, timestamp'2025-01-01 00:00:00' + make_dt_interval(0, 0, cast(id % 50 as int)) "
                   "AS ts FROM range(100)")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = drop_replays(stream, ["id"], "ts", "2 hours").writeStream.format("parquet").option(
        "path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    query.start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


def test_sha256_keys_run_through(spark):
    context = MartContext(Keys("sha256"), CONTEXT.as_of)
    mart = raw_to_mart(documents_to_raw_from_messages(spark), context)
    assert len(mart["purchase_item_details"].first().item_pk) == 64
    assert mart["dim_manufacturer"].first().country_id == "0"


def documents_to_raw_from_messages(spark):
    return raw_of(spark, **ALL)


def test_documents_to_raw_masks(spark, tmp_path):
    folder = write_folder(tmp_path / "stores", [STORE])
    raw = documents_to_raw({"stores": read_documents(spark, folder, "stores").good})
    assert raw["raw_stores"].first().manager_email == digest("a@b.ru")
