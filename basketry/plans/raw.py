"""Raw layer: nested documents flattened to one fixed schema per collection, without NULLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.clean import parse_date, parse_json, parse_ts_utc, safe_bool, safe_float, safe_int
from basketry.operators.versioned import version_stamp
from basketry.schemas import CORRUPT, message_schema


class _Document:
    """Field access by dotted path; a path the frame does not have reads as missing."""

    def __init__(self, df: DataFrame, load_ts: Column | None) -> None:
        self.schema = df.schema
        self.load_ts = F.current_timestamp() if load_ts is None else load_ts

    def dtype(self, path: str) -> T.DataType | None:
        dtype: T.DataType | None = self.schema
        for part in path.split("."):
            if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
                return None
            dtype = dtype[part].dataType
        return dtype

    def col(self, path: str) -> Column:
        if self.dtype(path) is None:
            return F.lit(None).cast("string")
        first, *rest = path.split(".")
        column = F.col(f"`{first}`")
        for part in rest:
            column = column[part]
        return column

    def text(self, path: str) -> Column:
        return F.coalesce(self.col(path).cast("string"), F.lit(""))

    def number(self, path: str) -> Column:
        return safe_float(self.col(path))

    def whole(self, path: str) -> Column:
        return safe_int(self.col(path))

    def flag(self, path: str) -> Column:
        return safe_bool(self.col(path), numeric_text=True)

    def day(self, path: str) -> Column:
        return parse_date(self.col(path))

    def instant(self, path: str) -> Column:
        return F.date_trunc("second", parse_ts_utc(self.col(path), self.load_ts))


def _finish(df: DataFrame, doc: _Document, columns: dict[str, Column]) -> DataFrame:
    flat = df.select(*[column.alias(name) for name, column in columns.items()],
                     doc.instant("kafka_send_date").alias("load_date"))
    return flat.withColumn("version", version_stamp(F.col("load_date")))


def _texts(doc: _Document, prefix: str, path: str, names: str) -> dict[str, Column]:
    return {f"{prefix}{name}": doc.text(f"{path}{name}") for name in names.split()}


def raw_products(documents: DataFrame, load_ts: Column | None = None) -> DataFrame:
    doc = _Document(documents, load_ts)
    return _finish(
        documents,
        doc,
        {
            **_texts(doc, "", "", "id name group description"),
            **{name: doc.number(f"kbju.{name}") for name in ("calories", "protein", "fat", "carbohydrates")},
            "price": doc.number("price"),
            **_texts(doc, "", "", "unit origin_country"),
            "expiry_days": doc.whole("expiry_days"),
            "is_organic": doc.flag("is_organic"),
            "barcode": doc.text("barcode"),
            **_texts(doc, "manufacturer_", "manufacturer.", "name country website inn"),
        },
    )


def raw_customers(documents: DataFrame, load_ts: Column | None = None) -> DataFrame:
    doc = _Document(documents, load_ts)
    return _finish(
        documents,
        doc,
        {
            **_texts(doc, "", "", "customer_id first_name last_name email phone"),
            "birth_date": doc.day("birth_date"),
            "gender": doc.text("gender"),
            "registration_date": doc.instant("registration_date"),
            "is_loyalty_member": doc.flag("is_loyalty_member"),
            "loyalty_card_number": doc.text("loyalty_card_number"),
            **_texts(
                doc,
                "purchase_location_",
                "purchase_location.",
                "store_id store_name store_network store_type_description country city street house postal_code",
            ),
            **_texts(
                doc,
                "delivery_address_",
                "delivery_address.",
                "country city street house apartment postal_code",
            ),
            **_texts(doc, "", "preferences.", "preferred_language preferred_payment_method"),
            "receive_promotions": doc.flag("preferences.receive_promotions"),
        },
    )


def raw_stores(documents: DataFrame, load_ts: Column | None = None) -> DataFrame:
    doc = _Document(documents, load_ts)
    categories = doc.col("categories").cast("array<string>")
    return _finish(
        documents,
        doc,
        {
            **_texts(doc, "", "", "store_id store_name store_network store_type_description type"),
            "categories": F.coalesce(categories, F.array().cast("array<string>")),
            **_texts(doc, "manager_", "manager.", "name phone email"),
            **_texts(doc, "location_", "location.", "country city street house postal_code"),
            "location_latitude": doc.number("location.coordinates.latitude"),
            "location_longitude": doc.number("location.coordinates.longitude"),
            **_texts(doc, "opening_hours_", "opening_hours.", "mon_fri sat sun"),
            "accepts_online_orders": doc.flag("accepts_online_orders"),
            "delivery_available": doc.flag("delivery_available"),
            "warehouse_connected": doc.flag("warehouse_connected"),
            "last_inventory_date": doc.day("last_inventory_date"),
        },
    )


def raw_purchases(documents: DataFrame, load_ts: Column | None = None) -> DataFrame:
    doc = _Document(documents, load_ts)
    items = doc.col("items")
    if not isinstance(doc.dtype("items"), (T.StringType, type(None))):
        items = F.to_json(items)
    return _finish(
        documents,
        doc,
        {
            "purchase_id": doc.text("purchase_id"),
            "customer_id": doc.text("customer.customer_id"),
            **_texts(doc, "customer_", "customer.", "first_name last_name email phone"),
            "customer_is_loyalty_member": doc.flag("customer.is_loyalty_member"),
            "customer_loyalty_card_number": doc.text("customer.loyalty_card_number"),
            **_texts(doc, "", "store.", "store_id store_name store_network store_type_description"),
            **_texts(doc, "store_", "store.location.", "city street house postal_code"),
            "items": F.coalesce(items, F.lit("[]")),
            **_texts(doc, "delivery_", "delivery_address.", "city street house apartment postal_code"),
            "total_amount": doc.number("total_amount"),
            "payment_method": doc.text("payment_method"),
            "is_delivery": doc.flag("is_delivery"),
            "purchase_datetime": doc.instant("purchase_datetime"),
        },
    )


FLATTEN = {
    "products": raw_products,
    "customers": raw_customers,
    "stores": raw_stores,
    "purchases": raw_purchases,
}


def parse_messages(messages: DataFrame, topic: str) -> DataFrame:
    """Documents of one topic's messages, with the text of an unreadable message kept in the corrupt column."""
    return parse_json(messages.select("value"), message_schema(topic).add(CORRUPT, T.StringType()))


#: why a message of a known topic gives no raw row
UNREADABLE = "unreadable JSON"


def unreadable() -> Column:
    """Whether a parsed message is poison."""
    return F.col(CORRUPT).isNotNull() | F.col("value").isNull()


def split_messages(parsed: DataFrame, topic: str, load_ts: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Of one topic's parsed messages, the raw rows and the poison messages (topic, value, reason), which never stop
    a batch."""
    good = FLATTEN[topic](parsed.filter(~unreadable()).drop(CORRUPT, "value"), load_ts)
    bad = parsed.filter(unreadable()).select(F.lit(topic).alias("topic"), "value", F.lit(UNREADABLE).alias("reason"))
    return good, bad
