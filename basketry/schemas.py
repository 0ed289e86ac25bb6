"""Schemas of documents, raw tables and mart tables.

Documents are read with every scalar as text: the source is JSON without a fixed typing (a price may be 12, 12.5 or
"12.5"), and the raw layer casts with defaults. JSON numbers and booleans arrive as their own text.
"""

from __future__ import annotations

from pyspark.sql import types as T

COLLECTIONS = ("stores", "products", "customers", "purchases")
RAW_TABLES = {topic: f"raw_{topic}" for topic in COLLECTIONS}
RAW_KEYS = {
    "raw_products": "id",
    "raw_customers": "customer_id",
    "raw_stores": "store_id",
    "raw_purchases": "purchase_id",
}
CORRUPT = "_corrupt_record"


def _texts(names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names.split()]


def _struct(names: str, **nested: T.DataType) -> T.StructType:
    return T.StructType(_texts(names) + [T.StructField(name, dtype) for name, dtype in nested.items()])


MANUFACTURER = _struct("name country website inn")
KBJU = _struct("calories protein fat carbohydrates")
ITEM = _struct(
    "product_id name category quantity unit price_per_unit total_price", kbju=KBJU, manufacturer=MANUFACTURER
)

DOCUMENTS: dict[str, T.StructType] = {
    "stores": _struct(
        "_id store_id store_name store_network store_type_description type accepts_online_orders delivery_available "
        "warehouse_connected last_inventory_date kafka_send_date",
        categories=T.ArrayType(T.StringType()),
        manager=_struct("name phone email"),
        location=_struct("country city street house postal_code", coordinates=_struct("latitude longitude")),
        opening_hours=_struct("mon_fri sat sun"),
    ),
    "products": _struct(
        "_id id name group description price unit origin_country expiry_days is_organic barcode kafka_send_date",
        kbju=KBJU,
        manufacturer=MANUFACTURER,
    ),
    "customers": _struct(
        "_id customer_id first_name last_name email phone birth_date gender registration_date is_loyalty_member "
        "loyalty_card_number kafka_send_date",
        purchase_location=_struct(
            "store_id store_name store_network store_type_description country city street house postal_code"
        ),
        delivery_address=_struct("country city street house apartment postal_code"),
        preferences=_struct("preferred_language preferred_payment_method receive_promotions"),
    ),
    "purchases": _struct(
        "_id purchase_id total_amount payment_method is_delivery purchase_datetime kafka_send_date",
        customer=_struct("customer_id first_name last_name email phone is_loyalty_member loyalty_card_number"),
        store=_struct(
            "store_id store_name store_network store_type_description",
            location=_struct("city street house postal_code"),
        ),
        items=T.ArrayType(ITEM),
        delivery_address=_struct("country city street house apartment postal_code"),
    ),
}


def message_schema(topic: str) -> T.StructType:
    """Schema of a message value. The items of a purchase stay JSON text, with everything they hold."""
    fields = [
        T.StructField("items", T.StringType()) if field.name == "items" else field
        for field in DOCUMENTS[topic].fields
    ]
    return T.StructType(fields)


_STAMPS = "load_date timestamp, version bigint"

RAW_SCHEMAS: dict[str, str] = {
    "raw_products": "id string, name string, `group` string, description string, calories double, protein double, "
    "fat double, carbohydrates double, price double, unit string, origin_country string, expiry_days int, "
    "is_organic boolean, barcode string, manufacturer_name string, manufacturer_country string, "
    f"manufacturer_website string, manufacturer_inn string, {_STAMPS}",
    "raw_customers": "customer_id string, first_name string, last_name string, email string, phone string, "
    "birth_date date, gender string, registration_date timestamp, is_loyalty_member boolean, "
    "loyalty_card_number string, purchase_location_store_id string, purchase_location_store_name string, "
    "purchase_location_store_network string, purchase_location_store_type_description string, "
    "purchase_location_country string, purchase_location_city string, purchase_location_street string, "
    "purchase_location_house string, purchase_location_postal_code string, delivery_address_country string, "
    "delivery_address_city string, delivery_address_street string, delivery_address_house string, "
    "delivery_address_apartment string, delivery_address_postal_code string, preferred_language string, "
    f"preferred_payment_method string, receive_promotions boolean, {_STAMPS}",
    "raw_stores": "store_id string, store_name string, store_network string, store_type_description string, "
    "type string, categories array<string>, manager_name string, manager_phone string, manager_email string, "
    "location_country string, location_city string, location_street string, location_house string, "
    "location_postal_code string, location_latitude double, location_longitude double, "
    "opening_hours_mon_fri string, opening_hours_sat string, opening_hours_sun string, "
    "accepts_online_orders boolean, delivery_available boolean, warehouse_connected boolean, "
    f"last_inventory_date date, {_STAMPS}",
    "raw_purchases": "purchase_id string, customer_id string, customer_first_name string, "
    "customer_last_name string, customer_email string, customer_phone string, "
    "customer_is_loyalty_member boolean, customer_loyalty_card_number string, store_id string, "
    "store_name string, store_network string, store_type_description string, store_city string, "
    "store_street string, store_house string, store_postal_code string, items string, delivery_city string, "
    "delivery_street string, delivery_house string, delivery_apartment string, delivery_postal_code string, "
    f"total_amount double, payment_method string, is_delivery boolean, purchase_datetime timestamp, {_STAMPS}",
}

# What the mart reads out of the items of a purchase.
ITEM_EXTRACT = (
    "struct<product_id:string,category:string,quantity:string,unit:string,total_price:string,"
    "manufacturer:struct<name:string,inn:string>>"
)
