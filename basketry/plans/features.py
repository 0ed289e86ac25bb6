"""Thirty 0/1 flags per customer from one pass over the purchases.

Three steps, whatever the number of flags:

1. items with their product's marks, aggregated per purchase ("basket facts");
2. purchases with basket facts, payment method and city, aggregated per customer ("measures");
3. customers left-joined to their measures; each flag is an expression over measures.

Every aggregate is combined on the map side before it is shuffled, so a customer, purchase or product with a large
part of the rows costs no more than others. Only what the requested flags need is computed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.lookup import lookup_join
from basketry.plans.prepare import (
    NO_CATEGORY,
    MartInputs,
    SmallSides,
    latest_purchases,
    prepare_customers,
    prepare_items,
    prepare_products,
    prepare_stores,
    with_delivery_city,
    with_payment_method,
)


@dataclass(frozen=True)
class FeatureSpec:
    """Limits, windows and names behind the flags. The defaults are fixed values of the data model."""

    week_days: int = 7
    short_days: int = 14
    month_days: int = 30
    quarter_days: int = 90
    milk_category: str = "молочные продукты"
    fruit_category: str = "фрукты и ягоды"
    veggie_category: str = "овощи и зелень"
    meat_category: str = "мясо, рыба, яйца и бобовые"
    bakery_words: tuple[str, ...] = ("булочка", "хлеб", "лаваш", "пряник", "вафли", "кекс", "батон", "печенье")
    recurrent_over: int = 2
    bulk_over: float = 1000
    low_cost_under: float = 200
    loyal_purchases: int = 3
    night_from_hour: int = 20
    morning_before_hour: int = 10
    early_from_hour: int = 12
    early_to_hour: int = 15
    cash_name: str = "cash"
    card_name: str = "card"
    payment_share: float = 0.7
    weekend_share: float = 0.6
    weekday_share: float = 0.4
    single_item_share: float = 0.5
    varied_categories: int = 4
    family_items: float = 4
    high_spend_over: float = 2000
    fruit_lover_purchases: int = 3


# What a product can be, as bits of one number, so that "any item of this kind" is one bit_or.
MARKS = ("milk", "fruit", "veggie", "meat", "organic", "bakery")


def _text(value: str) -> str:
    """A text as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bit(mark: str) -> str:
    return f"{1 << MARKS.index(mark)}L"


def product_marks(spec: FeatureSpec) -> str:
    """The marks of a product as SQL."""
    conditions = {
        "milk": f"category_name = {_text(spec.milk_category)}",
        "fruit": f"category_name = {_text(spec.fruit_category)}",
        "veggie": f"category_name = {_text(spec.veggie_category)}",
        "meat": f"category_name = {_text(spec.meat_category)}",
        "organic": "is_organic",
        "bakery": f"lower(product_name) RLIKE {_text('|'.join(spec.bakery_words))}",
    }
    bits = [f"if({condition}, {_bit(mark)}, 0L)" for mark, condition in conditions.items()]
    return " | ".join(bits)


@dataclass(frozen=True)
class _Scope:
    """What measures are written with: the spec and the day."""

    spec: FeatureSpec
    today: str

    def since(self, days: int) -> str:
        return f"purchase_date >= date_sub({self.today}, {days})"

    def count(self, condition: str) -> str:
        return f"count_if({condition})"

    def any(self, condition: str) -> str:
        return f"max(if({condition}, 1, 0))"

    def seen(self, mark: str, days: int | None = None) -> str:
        """Whether an item with this mark was bought, in the last days if given."""
        marks = "marks" if days is None else f"if({self.since(days)}, marks, NULL)"
        return f"if(bit_or({marks}) & {_bit(mark)} <> 0, 1, 0)"


_CITY_OF = "if(known_store_pk IS NOT NULL, coalesce(if(is_delivery, delivery_city_id, NULL), store_city_id), NULL)"
_VISITED_STORE = "if(NOT is_delivery, store_pk, NULL)"

# Aggregates over a customer's purchases, in SQL. Whether a count of distinct values is one or more than one shows
# in their minimum and maximum, which need no set. Equal aggregates in several measures are computed once.
MEASURES: dict[str, Callable[[_Scope], str]] = {
    "n_purchases": lambda s: s.count("purchase_pk IS NOT NULL"),
    "n_rows": lambda s: s.count("true"),
    "n_month": lambda s: s.count(s.since(s.spec.month_days)),
    "last_date": lambda s: "max(purchase_date)",
    "any_delivery": lambda s: s.any("is_delivery"),
    "avg_basket": lambda s: "avg(total_amount)",
    "spent_week": lambda s: f"sum(if({s.since(s.spec.week_days)}, total_amount, NULL))",
    "last_hour": lambda s: "max(purchase_hour)",
    "first_hour": lambda s: "min(purchase_hour)",
    "any_early": lambda s: s.any(f"purchase_hour BETWEEN {s.spec.early_from_hour} AND {s.spec.early_to_hour}"),
    "n_cash": lambda s: s.count(f"payment_method_name = {_text(s.spec.cash_name)}"),
    "n_card": lambda s: s.count(f"payment_method_name = {_text(s.spec.card_name)}"),
    "n_weekend": lambda s: s.count("dayofweek(purchase_date) IN (1, 7)"),
    "min_city": lambda s: f"min({_CITY_OF})",
    "max_city": lambda s: f"max({_CITY_OF})",
    "min_store": lambda s: f"min({_VISITED_STORE})",
    "max_store": lambda s: f"max({_VISITED_STORE})",
    "milk_month": lambda s: s.seen("milk", s.spec.month_days),
    "fruit_short": lambda s: s.seen("fruit", s.spec.short_days),
    "veggie_short": lambda s: s.seen("veggie", s.spec.short_days),
    "meat_week": lambda s: s.seen("meat", s.spec.week_days),
    "meat_quarter": lambda s: s.seen("meat", s.spec.quarter_days),
    "organic": lambda s: s.seen("organic"),
    "bakery": lambda s: s.seen("bakery"),
    "n_fruit_month": lambda s: s.count(f"marks & {_bit('fruit')} <> 0 AND {s.since(s.spec.month_days)}"),
    "n_baskets": lambda s: s.count("n_items IS NOT NULL"),
    "n_single": lambda s: s.count("n_items = 1"),
    "n_items_total": lambda s: "sum(n_items)",
}
_MARK_MEASURES = frozenset(
    ("milk_month", "fruit_short", "veggie_short", "meat_week", "meat_quarter", "organic", "bakery", "n_fruit_month")
)
_ITEM_COUNTS = frozenset(("n_baskets", "n_single", "n_items_total"))
_PAYMENTS = frozenset(("n_cash", "n_card"))
_CITIES = frozenset(("min_city", "max_city"))


@dataclass(frozen=True)
class Flag:
    """A flag: the measures it reads and its condition in SQL; an undecided condition counts as not met."""

    needs: tuple[str, ...]
    rule: Callable[[FeatureSpec, str], str]


def _met(measure: str) -> Flag:
    return Flag((measure,), lambda spec, today: f"{measure} = 1")


def _not_met(measure: str) -> Flag:
    """Also holds for customers without purchases."""
    return Flag((measure,), lambda spec, today: f"coalesce({measure}, 0) = 0")


def _share(part: str, whole: str, test: Callable[[FeatureSpec], str]) -> Flag:
    return Flag((part, whole), lambda spec, today: f"try_divide({part}, {whole}) {test(spec)}")


def _limit(measure: str, test: Callable[[FeatureSpec], str]) -> Flag:
    return Flag((measure,), lambda spec, today: f"{measure} {test(spec)}")


# In the order of the exported matrix.
FLAGS: dict[str, Flag] = {
    "bought_milk_last_30d": _met("milk_month"),
    "bought_fruits_last_14d": _met("fruit_short"),
    "not_bought_veggies_14d": _not_met("veggie_short"),
    "recurrent_buyer": _limit("n_month", lambda spec: f"> {spec.recurrent_over}"),
    "inactive_14_30": Flag(
        ("last_date",),
        lambda spec, today: f"last_date >= date_sub({today}, {spec.month_days}) "
        f"AND last_date < date_sub({today}, {spec.short_days})",
    ),
    "new_customer": Flag((), lambda spec, today: f"reg_date >= date_sub({today}, {spec.month_days})"),
    "delivery_user": _met("any_delivery"),
    "organic_preference": _met("organic"),
    "bulk_buyer": _limit("avg_basket", lambda spec: f"> {spec.bulk_over}"),
    "low_cost_buyer": _limit("avg_basket", lambda spec: f"< {spec.low_cost_under}"),
    "buys_bakery": _met("bakery"),
    "loyal_customer": Flag(
        ("n_purchases",), lambda spec, today: f"is_loyalty_member AND n_purchases >= {spec.loyal_purchases}"
    ),
    "multicity_buyer": Flag(("min_city", "max_city"), lambda spec, today: "min_city <> max_city"),
    "bought_meat_last_week": _met("meat_week"),
    "night_shopper": _limit("last_hour", lambda spec: f">= {spec.night_from_hour}"),
    "morning_shopper": _limit("first_hour", lambda spec: f"< {spec.morning_before_hour}"),
    "prefers_cash": _share("n_cash", "n_rows", lambda spec: f">= {spec.payment_share}D"),
    "prefers_card": _share("n_card", "n_rows", lambda spec: f">= {spec.payment_share}D"),
    "weekend_shopper": _share("n_weekend", "n_rows", lambda spec: f">= {spec.weekend_share}D"),
    "weekday_shopper": _share("n_weekend", "n_rows", lambda spec: f"<= {spec.weekday_share}D"),
    "single_item_buyer": _share("n_single", "n_baskets", lambda spec: f">= {spec.single_item_share}D"),
    "varied_shopper": _limit("n_categories", lambda spec: f">= {spec.varied_categories}"),
    "store_loyal": Flag(("min_store", "max_store"), lambda spec, today: "min_store = max_store"),
    "switching_store": Flag(("min_store", "max_store"), lambda spec, today: "min_store <> max_store"),
    "family_shopper": _share("n_items_total", "n_baskets", lambda spec: f">= {spec.family_items}"),
    "early_bird": _met("any_early"),
    "no_purchases": _limit("n_rows", lambda spec: "IS NULL"),
    "recent_high_spender": _limit("spent_week", lambda spec: f"> {spec.high_spend_over}"),
    "fruit_lover": _limit("n_fruit_month", lambda spec: f">= {spec.fruit_lover_purchases}"),
    "vegetarian_profile": _not_met("meat_quarter"),
}
FLAG_NAMES = tuple(FLAGS)


#: measured apart from the others, see customer_categories
CATEGORIES = "n_categories"


def basket_facts(
    items: DataFrame, products: DataFrame | None, spec: FeatureSpec, *, small: bool | None = None
) -> DataFrame:
    """Per purchase: number of items and the marks of its products.

    The product join is a left join: an item with an unknown product still counts as an item.
    """
    facts = [F.count("item_pk").alias("n_items")]
    if products is not None:
        marked = products.select(F.col("product_pk").alias("known_product_pk"), F.expr(product_marks(spec)).alias("marks"))
        items = lookup_join(items, marked, "product_pk", "known_product_pk", small=small, spread_by="item_pk")
        facts.append(F.bit_or("marks").alias("marks"))
    return items.groupBy(F.col("purchase_pk").alias("basket_pk")).agg(*facts)


def bought_categories(
    items: DataFrame, products: DataFrame, purchases: DataFrame, *, by: Sequence[str] = (), small: bool | None = None
) -> DataFrame:
    """The distinct category names that each customer_pk bought, also by columns of the purchase if some are named.

    Equal pairs are merged by purchase and then by customer, before each shuffle; no set of names is held in a row.
    """
    named = products.select(F.col("product_pk").alias("known_product_pk"), "category_name")
    bought = lookup_join(items, named, "product_pk", "known_product_pk", small=small, spread_by="item_pk")
    bought = bought.filter(F.col("category_name").isNotNull()).select("purchase_pk", "category_name").distinct()
    pairs = bought.join(purchases.select("purchase_pk", "customer_pk", *by), "purchase_pk")
    return pairs.select("customer_pk", "category_name", *by).distinct()


def customer_categories(
    items: DataFrame, products: DataFrame, purchases: DataFrame, *, small: bool | None = None
) -> DataFrame:
    """n_categories per customer_pk: the distinct category names bought, however many there are."""
    pairs = bought_categories(items, products, purchases, small=small)
    return pairs.groupBy("customer_pk").agg(F.count(F.lit(1)).alias(CATEGORIES))


@dataclass(frozen=True)
class LookupSides:
    """The lookup sides of a run: which are small, and the products if items are looked up."""

    small: SmallSides
    products: DataFrame | None


def lookup_sides(inputs: MartInputs, needed: set[str]) -> LookupSides:
    by_product, with_names = bool(needed & _MARK_MEASURES), CATEGORIES in needed
    small = SmallSides.measure(
        inputs, items=by_product or with_names, cities=bool(needed & _CITIES), names=with_names
    )
    products = prepare_products(inputs.products, inputs.categories, small.categories) if by_product or with_names else None
    return LookupSides(small, products)


def purchase_rows(
    purchases: DataFrame, items: DataFrame, inputs: MartInputs, spec: FeatureSpec, needed: set[str], sides: LookupSides
) -> DataFrame:
    """Last versions of purchases with what the measures need: basket facts, payment method, cities."""
    rows = purchases
    by_product = bool(needed & _MARK_MEASURES)
    # By purchase first: the last versions are already spread by purchase, so this join moves only the baskets.
    if by_product or needed & _ITEM_COUNTS:
        baskets = basket_facts(items, sides.products if by_product else None, spec, small=sides.small.products)
        rows = rows.join(baskets, F.col("purchase_pk") == F.col("basket_pk"), "left")
    if needed & _PAYMENTS:
        rows = with_payment_method(rows, inputs.payment_methods)
    if needed & _CITIES:
        rows = _with_cities(rows, inputs, sides.small)
    return rows


def customer_measures(inputs: MartInputs, spec: FeatureSpec, today: str, measures: Sequence[str]) -> DataFrame:
    """The requested measures per customer_pk."""
    needed = set(measures)
    sides = lookup_sides(inputs, needed)
    purchases, items = latest_purchases(inputs.purchases), prepare_items(inputs.items, inputs.item_keys)
    rows = purchase_rows(purchases, items, inputs, spec, needed, sides)
    scope = _Scope(spec, today)
    grouped = [F.expr(MEASURES[name](scope)).alias(name) for name in measures if name != CATEGORIES]
    found = rows.groupBy("customer_pk").agg(*grouped) if grouped else None
    if CATEGORIES in needed:
        counted = customer_categories(items, sides.products, purchases, small=sides.small.products)
        found = counted if found is None else found.join(counted, "customer_pk", "left")
    return found


def _with_cities(purchases: DataFrame, inputs: MartInputs, small: SmallSides) -> DataFrame:
    """Add the store's city where the store is known, and the delivery city where there is a delivery."""
    stores = prepare_stores(inputs.stores, inputs.addresses, small.addresses).select(
        F.col("store_pk").alias("known_store_pk"), "store_city_id"
    )
    purchases = lookup_join(
        purchases, stores, "store_pk", "known_store_pk", small=small.stores, spread_by="purchase_pk"
    )
    purchases = purchases.withColumn("_delivered_to", F.when(F.col("is_delivery"), F.col("delivery_address_id")))
    return with_delivery_city(purchases, inputs.delivery_addresses, "_delivered_to", small.delivery_addresses)


def feature_matrix(
    inputs: MartInputs,
    as_of: date | None = None,
    spec: FeatureSpec | None = None,
    flags: Sequence[str] = FLAG_NAMES,
) -> DataFrame:
    """customer_id and the flags as 0/1 integers, one row per customer, customers without purchases included."""
    spec = spec or FeatureSpec()
    today = day_sql(as_of)
    measures = needed_measures(flags)
    found = customer_measures(inputs, spec, today, measures) if measures else None
    return with_flags(prepare_customers(inputs.customers), found, spec, today, flags)


def day_sql(as_of: date | None) -> str:
    return "current_date()" if as_of is None else f"date'{as_of:%Y-%m-%d}'"


def measure_sql(spec: FeatureSpec, today: str = "current_date()") -> dict[str, str]:
    """The aggregates over a customer's purchases, in SQL."""
    scope = _Scope(spec, today)
    return {name: measure(scope) for name, measure in MEASURES.items()}


def needed_measures(flags: Sequence[str]) -> list[str]:
    return [name for name in (*MEASURES, CATEGORIES) if any(name in FLAGS[flag].needs for flag in flags)]


def with_flags(
    customers: DataFrame, found: DataFrame | None, spec: FeatureSpec, today: str, flags: Sequence[str]
) -> DataFrame:
    """customer_id and the flags of prepared customers, from the measures found for their customer_pk."""
    if found is not None:
        found = found.withColumnRenamed("customer_pk", "buyer_pk")
        customers = customers.join(found, F.col("customer_pk") == F.col("buyer_pk"), "left")
    values = [F.expr(f"if({FLAGS[flag].rule(spec, today)}, 1, 0)").alias(flag) for flag in flags]
    return customers.select("customer_id", *values)


def duplicate_customers(matrix: DataFrame) -> DataFrame:
    """Customer ids that occur more than once in the matrix."""
    return matrix.groupBy("customer_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def require_customers(inputs: MartInputs) -> None:
    """Refuse to make a matrix of nothing."""
    for name in ("customers", "purchases", "products", "stores", "items"):
        if getattr(inputs, name).isEmpty():
            raise ValueError(f"no rows in {name}")
