"""Mart: what each raw table contributes to dimensions, details and links.

A target may have several sources (countries come from products, stores and customers). In a batch their
contributions are united; in a stream each source appends its own part. Rows carry the load date and version of
the raw row they come from, so running a job again gives the same rows and the last version still wins.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.clean import GENDER_CODES, PAYMENT_CODES, clean_category, code_map, safe_float
from basketry.functions.keys import Keys, packed_key, unpacked_key
from basketry.operators.quality import accepted, filled, rejected
from basketry.operators.versioned import latest_version
from basketry.schemas import ITEM_EXTRACT

STAMPS = ("load_date", "version")

# Key of each mart table: one row per key counts, the one with the last version.
MART_KEYS = {
    "dim_categories": "category_id",
    "dim_units": "unit_id",
    "dim_countries": "country_id",
    "dim_language": "language_id",
    "dim_cities": "city_id",
    "dim_address": "address_id",
    "dim_delivery_addresses": "delivery_address_id",
    "dim_managers": "manager_id",
    "dim_store_networks": "store_network_id",
    "dim_opening_hours": "opening_hours_id",
    "dim_gender": "gender_id",
    "dim_manufacturer": "manufacturer_id",
    "dim_payment_method": "payment_method_id",
    "dim_type_store": "type_id",
    "products_details": "product_pk",
    "customers_details": "customer_pk",
    "stores_details": "store_pk",
    "link_customers_stores": "link_pk",
    "purchases_details": "purchase_pk",
    "purchase_item_details": "item_pk",
}
#: columns that hold keys of mart tables
KEY_COLUMNS = frozenset({*MART_KEYS.values(), "location_id"})
DIMENSIONS = tuple(name for name in MART_KEYS if name.startswith("dim_"))
DETAILS = tuple(name for name in MART_KEYS if not name.startswith("dim_"))


@dataclass(frozen=True)
class MartContext:
    """Settings of a mart run: how keys are made, what "now" is, whether future purchases are refused."""

    keys: Keys = field(default_factory=Keys)
    as_of: datetime | date | None = None
    reject_future: bool = False

    @property
    def now(self) -> Column:
        return F.current_timestamp() if self.as_of is None else F.lit(self.as_of).cast("timestamp")

    @property
    def today(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of).cast("date")


Rules = dict[str, Column]
Columns = dict[str, Column]


@dataclass(frozen=True)
class Contribution:
    """One raw table's part of one mart table: the rows it accepts and the columns it makes of them."""

    target: str
    source: str
    define: Callable[[MartContext], tuple[Rules, Columns]]
    reshape: Callable[[DataFrame], DataFrame] | None = None

    def _shaped(self, raw: DataFrame) -> DataFrame:
        return raw if self.reshape is None else self.reshape(raw)

    def rows(self, raw: DataFrame, context: MartContext) -> DataFrame:
        rules, columns = self.define(context)
        named = [column.alias(name) for name, column in columns.items()]
        return accepted(self._shaped(raw), rules).select(*named, *STAMPS)

    def rejects(self, raw: DataFrame, context: MartContext) -> DataFrame:
        return rejected(self._shaped(raw), self.define(context)[0])


CONTRIBUTIONS: list[Contribution] = []


def _contributes(target: str, source: str, reshape: Callable[[DataFrame], DataFrame] | None = None):
    def register(define: Callable[[MartContext], tuple[Rules, Columns]]):
        CONTRIBUTIONS.append(Contribution(target, source, define, reshape))
        return define

    return register


# Parts that several tables share.


def _lower(*names: str) -> list[Column]:
    return [F.lower(F.col(name)) for name in names]


def _as_is(*names: str) -> Columns:
    return {name: F.col(name) for name in names}


def _address(prefix: str, *, apartment: bool = False) -> list[str]:
    parts = ["city", "street", "house", *(["apartment"] if apartment else []), "postal_code"]
    return [f"{prefix}{part}" for part in parts]


def _optional_key(context: MartContext, name: str) -> Column:
    return context.keys.key_if(F.col(name) != "", F.lower(F.col(name)))


def _opening_hours() -> dict[str, Column]:
    days = ("mon_fri", "sat", "sun")
    return {day: F.coalesce(F.lower(F.col(f"opening_hours_{day}")), F.lit("")) for day in days}


def _manager_key(context: MartContext) -> Column:
    return context.keys.key(F.lower("manager_name"), F.col("manager_phone"), F.col("manager_email"))


def _past_day(name: str, context: MartContext) -> Rules:
    return {
        f"{name} is in the future": F.col(name) <= context.today,
        f"{name} is not after 1900-01-01": F.col(name) > F.lit(date(1900, 1, 1)),
    }


# Dimensions of the distinct lower-case values of one column.


def _name_dimension(target: str, source: str, column: str, key: str, name: str, *, tell_source: bool = False) -> None:
    @_contributes(target, source)
    def define(context: MartContext) -> tuple[Rules, Columns]:
        columns = {key: context.keys.key(F.lower(F.col(column))), name: F.lower(F.col(column))}
        if tell_source:
            columns["record_source"] = F.lit(source)
        return filled(column), columns


def _code_dimension(target: str, source: str, column: str, key: str, name: str, codes: Mapping[str, int]) -> None:
    """All names without a code share code 0."""

    @_contributes(target, source)
    def define(context: MartContext) -> tuple[Rules, Columns]:
        return filled(column), {key: code_map(F.col(column), codes), name: F.lower(F.col(column))}


_name_dimension("dim_units", "raw_products", "unit", "unit_id", "unit_name")
_name_dimension("dim_language", "raw_customers", "preferred_language", "language_id", "language_name")
_name_dimension("dim_store_networks", "raw_stores", "store_network", "store_network_id", "store_network_name")
_name_dimension("dim_type_store", "raw_stores", "type", "type_id", "type_name")
for _source, _column in (
    ("raw_products", "origin_country"),
    ("raw_stores", "location_country"),
    ("raw_customers", "delivery_address_country"),
):
    _name_dimension("dim_countries", _source, _column, "country_id", "country_name", tell_source=True)
_code_dimension("dim_gender", "raw_customers", "gender", "gender_id", "gender_name", GENDER_CODES)
_code_dimension(
    "dim_payment_method",
    "raw_purchases",
    "payment_method",
    "payment_method_id",
    "payment_method_name",
    PAYMENT_CODES,
)


# The other dimensions.


@_contributes("dim_categories", "raw_products")
def _categories(context: MartContext) -> tuple[Rules, Columns]:
    clear = clean_category(F.col("group"))
    return filled("group"), {
        "category_id": context.keys.key(clear),
        "category_name": F.lower("group"),
        "clear_category_name": clear,
    }


@_contributes("dim_cities", "raw_stores")
def _cities(context: MartContext) -> tuple[Rules, Columns]:
    return filled("location_city"), {
        "city_id": context.keys.key(F.lower("location_city")),
        "city_name": F.lower("location_city"),
        "country_id": _optional_key(context, "location_country"),
    }


def _address_columns(context: MartContext, prefix: str, latitude: Column, longitude: Column) -> Columns:
    return {
        "address_id": context.keys.key(*_lower(*_address(prefix))),
        "country_id": _optional_key(context, f"{prefix}country"),
        "city_id": context.keys.key(F.lower(f"{prefix}city")),
        **{part: F.lower(f"{prefix}{part}") for part in ("street", "house", "postal_code")},
        "latitude": latitude,
        "longitude": longitude,
    }


@_contributes("dim_address", "raw_stores")
def _store_addresses(context: MartContext) -> tuple[Rules, Columns]:
    columns = _address_columns(context, "location_", F.col("location_latitude"), F.col("location_longitude"))
    return filled(*_address("location_")), {**columns, "record_source": F.lit("raw_stores")}


@_contributes("dim_address", "raw_customers")
def _customer_addresses(context: MartContext) -> tuple[Rules, Columns]:
    columns = _address_columns(context, "delivery_address_", F.lit(0.0), F.lit(0.0))
    return filled(*_address("delivery_address_")), {**columns, "record_source": F.lit("raw_customers")}


@_contributes("dim_delivery_addresses", "raw_customers")
def _delivery_addresses(context: MartContext) -> tuple[Rules, Columns]:
    full = _address("delivery_address_", apartment=True)
    return filled(*full), {
        "delivery_address_id": context.keys.key(*_lower(*full)),
        "address_id": context.keys.key(*_lower(*_address("delivery_address_"))),
        "city_id": context.keys.key(F.lower("delivery_address_city")),
        "country_id": _optional_key(context, "delivery_address_country"),
        "apartment": F.lower("delivery_address_apartment"),
    }


@_contributes("dim_managers", "raw_stores")
def _managers(context: MartContext) -> tuple[Rules, Columns]:
    rules = {
        **filled("manager_name"),
        "manager has neither phone nor email": (F.col("manager_phone") != "") | (F.col("manager_email") != ""),
    }
    return rules, {
        "manager_id": _manager_key(context),
        "manager_name": F.lower("manager_name"),
        **_as_is("manager_phone", "manager_email"),
    }


@_contributes("dim_opening_hours", "raw_stores")
def _hours(context: MartContext) -> tuple[Rules, Columns]:
    hours = _opening_hours()
    some = reduce(lambda a, b: a | b, [F.col(f"opening_hours_{day}") != "" for day in hours])
    return {"opening hours are empty": some}, {"opening_hours_id": context.keys.key(*hours.values()), **hours}


@_contributes("dim_manufacturer", "raw_products")
def _manufacturers(context: MartContext) -> tuple[Rules, Columns]:
    names = ("manufacturer_name", "manufacturer_inn")
    return filled(*names), {
        "manufacturer_id": context.keys.key(*_lower(*names)),
        "country_id": _optional_key(context, "manufacturer_country"),
        "manufacturer_name": F.lower("manufacturer_name"),
        "manufacturer_website": F.coalesce(F.lower("manufacturer_website"), F.lit("")),
        "manufacturer_inn": F.lower("manufacturer_inn"),
    }


# Details and links.


def _positive(name: str) -> Column:
    """Above zero; NaN, which Spark sorts above all numbers, is not."""
    return (F.col(name) > 0) & ~F.isnan(name)


@_contributes("products_details", "raw_products")
def _products(context: MartContext) -> tuple[Rules, Columns]:
    rules = {
        **filled("id", "name", "group", "unit", "manufacturer_name", "manufacturer_inn"),
        "price is not positive": _positive("price"),
    }
    return rules, {
        "product_pk": context.keys.key(F.lower("id")),
        "product_id": F.lower("id"),
        "name": F.lower("name"),
        "category_id": context.keys.key(clean_category(F.col("group"))),
        "description": F.coalesce(F.lower("description"), F.lit("")),
        **_as_is("calories", "protein", "fat", "carbohydrates", "price"),
        "unit_id": context.keys.key(F.lower("unit")),
        "country_id": _optional_key(context, "origin_country"),
        **_as_is("expiry_days", "is_organic", "barcode"),
        "manufacturer_id": context.keys.key(*_lower("manufacturer_name", "manufacturer_inn")),
        "record_source": F.lit("raw_products"),
    }


@_contributes("customers_details", "raw_customers")
def _customers(context: MartContext) -> tuple[Rules, Columns]:
    rules = {
        **filled("customer_id", "first_name", "last_name"),
        **_past_day("birth_date", context),
        "registration_date is in the future": F.col("registration_date") <= context.now,
    }
    return rules, {
        "customer_pk": context.keys.key(F.lower("customer_id")),
        "customer_id": F.lower("customer_id"),
        "first_name": F.lower("first_name"),
        "last_name": F.lower("last_name"),
        **_as_is("email", "phone", "birth_date"),
        "gender_id": code_map(F.col("gender"), GENDER_CODES),
        **_as_is("registration_date", "is_loyalty_member"),
        "loyalty_card_number": F.lower("loyalty_card_number"),
        "language_id": context.keys.key(F.lower("preferred_language")),
        "payment_method_id": code_map(F.col("preferred_payment_method"), PAYMENT_CODES),
        "receive_promotions": F.col("receive_promotions"),
        "record_source": F.lit("raw_customers"),
    }


@_contributes("stores_details", "raw_stores")
def _stores(context: MartContext) -> tuple[Rules, Columns]:
    rules = {
        **filled("store_id", "store_name", *_address("location_")),
        **filled("manager_name", "manager_phone", "manager_email"),
        **_past_day("last_inventory_date", context),
    }
    return rules, {
        "store_pk": context.keys.key(F.lower("store_id")),
        "store_id": F.lower("store_id"),
        "store_name": F.lower("store_name"),
        "type_id": _optional_key(context, "type"),
        "store_network_id": _optional_key(context, "store_network"),
        "category_ids": F.transform("categories", lambda name: context.keys.key(clean_category(name))),
        "manager_id": _manager_key(context),
        "location_id": context.keys.key(*_lower(*_address("location_"))),
        "opening_hours_id": context.keys.key(*_opening_hours().values()),
        **_as_is("accepts_online_orders", "delivery_available", "warehouse_connected", "last_inventory_date"),
    }


@_contributes("link_customers_stores", "raw_customers")
def _customer_stores(context: MartContext) -> tuple[Rules, Columns]:
    """The delivery address here is keyed without the apartment, so it is an address_id; both names carry it."""
    ids = ("customer_id", "purchase_location_store_id")
    address = context.keys.key(*_lower(*_address("delivery_address_")))
    return filled(*ids, *_address("delivery_address_")), {
        "link_pk": context.keys.key(*_lower(*ids)),
        "customer_pk": context.keys.key(F.lower("customer_id")),
        "store_pk": context.keys.key(F.lower("purchase_location_store_id")),
        "delivery_address_id": address,
        "address_id": address,
        "record_source": F.lit("raw_customers"),
    }


@_contributes("purchases_details", "raw_purchases")
def _purchases(context: MartContext) -> tuple[Rules, Columns]:
    address = _address("delivery_", apartment=True)
    complete = reduce(lambda a, b: a & b, [F.col(name) != "" for name in address])
    rules = {
        **filled("purchase_id", "customer_id", "store_id"),
        "total_amount is not positive": _positive("total_amount"),
    }
    if context.reject_future:
        rules["purchase_datetime is in the future"] = F.col("purchase_datetime") <= context.now
    return rules, {
        "purchase_pk": context.keys.key(F.lower("purchase_id")),
        "purchase_id": F.lower("purchase_id"),
        "customer_pk": context.keys.key(F.lower("customer_id")),
        "store_pk": context.keys.key(F.lower("store_id")),
        "delivery_address_id": context.keys.key_if(complete, *_lower(*address)),
        "total_amount": F.col("total_amount"),
        "payment_method_id": code_map(F.col("payment_method"), PAYMENT_CODES),
        **_as_is("is_delivery", "purchase_datetime"),
    }


def explode_items(raw_purchases: DataFrame) -> DataFrame:
    """One row per item of each purchase; purchases without items give none.

    Each element is parsed by itself, so a bad one takes no other with it; it comes with empty fields. The parsed
    elements are what is exploded: a filter on their fields then reads a column and parses nothing again.
    """
    parsed = F.transform(F.from_json("items", "array<string>"), lambda element: F.from_json(element, ITEM_EXTRACT))
    items = raw_purchases.select("purchase_id", *STAMPS, F.explode(parsed).alias("_item"))
    items = items.select("purchase_id", *STAMPS, "_item.*")
    empty = F.lit("")
    return items.select(
        "purchase_id",
        *STAMPS,
        *[F.coalesce(F.col(name), empty).alias(name) for name in ("product_id", "category", "unit")],
        *[safe_float(F.col(name)).alias(name) for name in ("quantity", "total_price")],
        F.coalesce("manufacturer.name", empty).alias("manufacturer_name"),
        F.coalesce("manufacturer.inn", empty).alias("manufacturer_inn"),
    )


def quantity_text(quantity: Column) -> Column:
    """Quantity as it enters the item key: whole numbers without a fraction (2, not 2.0)."""
    return F.regexp_replace(quantity.cast("string"), r"\.0$", "")


@_contributes("purchase_item_details", "raw_purchases", reshape=explode_items)
def _items(context: MartContext) -> tuple[Rules, Columns]:
    made = (F.col("manufacturer_name") != "") | (F.col("manufacturer_inn") != "")
    rules = {
        **filled("purchase_id", "product_id", "category", "unit"),
        "total_price is not positive": _positive("total_price"),
    }
    return rules, {
        "item_pk": context.keys.key(*_lower("purchase_id", "product_id"), quantity_text(F.col("quantity"))),
        "purchase_pk": context.keys.key(F.lower("purchase_id")),
        "product_pk": context.keys.key(F.lower("product_id")),
        "category_id": context.keys.key(clean_category(F.col("category"))),
        "quantity": F.col("quantity"),
        "unit_id": context.keys.key(F.lower("unit")),
        "total_price": F.col("total_price"),
        "manufacturer_id": context.keys.key_if(made, *_lower("manufacturer_name", "manufacturer_inn")),
    }


# Assembly.


def contributions(target: str | None = None, source: str | None = None) -> list[Contribution]:
    return [
        part
        for part in CONTRIBUTIONS
        if (target is None or part.target == target) and (source is None or part.source == source)
    ]


def merge_dimension(df: DataFrame, target: str) -> DataFrame:
    """One row per key of a dimension.

    A dimension repeats few rows many times, so equal rows are merged first, before the shuffle; what is left for
    the choice of the last version is about the size of the dimension.
    """
    attributes = [name for name in df.columns if name not in STAMPS]
    merged = df.groupBy(*attributes).agg(*[F.max(name).alias(name) for name in STAMPS])
    order = [name for name in reversed(attributes) if name != MART_KEYS[target]]
    return latest_version(merged, [MART_KEYS[target]], tie_break=order)


def text_keys(df: DataFrame) -> list[str]:
    """The columns of a mart table that hold keys in hex."""
    return [field.name for field in df.schema.fields if field.name in KEY_COLUMNS and isinstance(field.dataType, T.StringType)]


def latest_details(df: DataFrame, target: str, choose: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The last version of each key of a table, or what else ``choose`` says; keys in hex are shuffled as bytes."""
    keys = text_keys(df)
    packed = df.withColumns({name: packed_key(F.col(name)) for name in keys})
    chosen = latest_version(packed, [MART_KEYS[target]]) if choose is None else choose(packed)
    return chosen.withColumns({name: unpacked_key(F.col(name)) for name in keys})


def mart_table(target: str, raw: Mapping[str, DataFrame], context: MartContext) -> DataFrame:
    """A mart table of all given raw rows. Dimensions come with one row per key; details keep every version."""
    parts = [part.rows(raw[part.source], context) for part in contributions(target) if part.source in raw]
    rows = reduce(DataFrame.unionByName, parts)
    return merge_dimension(rows, target) if target in DIMENSIONS else rows


def mart_rejects(target: str, raw: Mapping[str, DataFrame], context: MartContext) -> dict[str, DataFrame]:
    """Per raw table, the rows it could not contribute to the target, with reasons."""
    return {part.source: part.rejects(raw[part.source], context) for part in contributions(target)}
