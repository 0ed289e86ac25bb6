"""SQL over the given tables that says what each query must return.

Written from the meaning of the operators, in the shape of one aggregate per flag and plain selects per table.
"""

from __future__ import annotations

from basketry.plans.features import FLAG_NAMES, FeatureSpec

DAY = "date '2001-08-01'"
NOW = "timestamp '2001-08-01 00:00:00'"


def text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def key(*parts: str) -> str:
    return f"sha256(concat_ws(chr(1), {', '.join(parts)}))"


def lowered(*names: str) -> list[str]:
    return [f"lower({name})" for name in names]


def clean(column: str) -> str:
    return f"lower(trim(regexp_replace({column}, '^\\p{{So}}+\\s*', '')))"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def latest(table: str, pk: str, order: str, columns: str = "*") -> str:
    return (
        f"(SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {pk} ORDER BY {order}) AS rn "
        f"FROM {table}) WHERE rn = 1)"
    )


# The mart tables that the feature queries read.

PAYMENT = (
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN {0} "
    "WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN {1} ELSE {2} END"
)

MART = f"""
customers_details AS (
  SELECT c_custkey AS customer_pk, c_name AS customer_id, c_acctbal AS bal FROM customer
  UNION ALL SELECT -1 - s_suppkey, s_name, s_acctbal FROM supplier),
customers AS (
  SELECT customer_pk, customer_id, {DAY} - CAST(trunc(abs(bal)) AS INTEGER) % 700 AS reg_date,
         bal > 5000 AS is_loyalty_member FROM customers_details),
purchases AS (
  SELECT o_orderkey AS purchase_pk, o_custkey AS customer_pk, (o_custkey * 7 + o_orderkey % 2) % 110 AS store_pk,
         CASE WHEN o_orderstatus = 'F' THEN o_custkey + 1 END AS delivery_address_id,
         CASE WHEN o_orderstatus = 'F' THEN c_nationkey END AS delivery_city_id,
         o_totalprice AS total_amount, {PAYMENT.format("'card'", "'cash'", "'online'")} AS payment_method_name,
         o_orderstatus = 'F' AS is_delivery,
         date_trunc('day', o_orderdate) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS purchase_datetime
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
products AS (
  SELECT p_partkey AS product_pk, p_name AS product_name, p_retailprice AS price,
         CASE WHEN p_type = 'PROMO' THEN 'Без категории' ELSE lower(p_type) END AS category_name,
         p_brand = 'Brand#7' AND p_size <= 5 AS is_organic FROM part),
stores AS (
  SELECT s_suppkey AS store_pk, s_acctbal > 0 AS store_delivery_available,
         CASE WHEN s_acctbal > 0 THEN s_nationkey ELSE -1 END AS store_city_id FROM supplier),
item_versions AS (
  SELECT l_orderkey * 10 + l_linenumber AS item_pk, l_orderkey AS purchase_pk, l_partkey AS product_pk,
         l_quantity AS quantity, l_extendedprice AS total_price, CAST(epoch(l_shipdate) AS BIGINT) AS version
  FROM lineitem),
items AS {latest("item_versions", "item_pk", "version DESC, purchase_pk DESC, product_pk DESC, quantity DESC, total_price DESC", "item_pk, purchase_pk, product_pk, quantity, total_price")}
"""


def matrix(spec: FeatureSpec, day: str = DAY) -> str:
    """CTEs from customers, purchases, products, stores and items to ``matrix``."""

    def since(days: int) -> str:
        return f"CAST(purchase_datetime AS DATE) >= {day} - {days}"

    def bought(category: str, days: int) -> str:
        return f"SELECT DISTINCT customer_pk FROM bought WHERE category_name = {quoted(category)} AND {since(days)}"

    bakery = quoted("|".join(spec.bakery_words))
    hour = "extract(hour FROM purchase_datetime)"
    ones = {
        "bought_milk_last_30d": bought(spec.milk_category, spec.month_days),
        "bought_fruits_last_14d": bought(spec.fruit_category, spec.short_days),
        "bought_veggies": bought(spec.veggie_category, spec.short_days),
        "recurrent_buyer": f"SELECT customer_pk FROM purchases WHERE {since(spec.month_days)} GROUP BY 1 "
        f"HAVING count(*) > {spec.recurrent_over}",
        "inactive_14_30": "SELECT customer_pk FROM purchases GROUP BY 1 HAVING "
        f"max(CAST(purchase_datetime AS DATE)) < {day} - {spec.short_days} "
        f"AND max(CAST(purchase_datetime AS DATE)) >= {day} - {spec.month_days}",
        "delivery_user": "SELECT DISTINCT customer_pk FROM purchases WHERE is_delivery",
        "organic_preference": "SELECT DISTINCT customer_pk FROM bought WHERE is_organic",
        "bulk_buyer": f"SELECT customer_pk FROM purchases GROUP BY 1 HAVING avg(total_amount) > {spec.bulk_over}",
        "low_cost_buyer": "SELECT customer_pk FROM purchases GROUP BY 1 "
        f"HAVING avg(total_amount) < {spec.low_cost_under}",
        "buys_bakery": "SELECT DISTINCT customer_pk FROM bought "
        f"WHERE regexp_matches(lower(product_name), {bakery})",
        "loyal_customer": "SELECT p.customer_pk FROM purchases p JOIN customers c ON p.customer_pk = c.customer_pk "
        "WHERE is_loyalty_member GROUP BY 1 "
        f"HAVING count(DISTINCT purchase_pk) >= {spec.loyal_purchases}",
        "multicity_buyer": "SELECT customer_pk FROM purchases p JOIN stores s ON p.store_pk = s.store_pk GROUP BY 1 "
        "HAVING count(DISTINCT coalesce(CASE WHEN is_delivery THEN delivery_city_id END, store_city_id)) > 1",
        "bought_meat_last_week": bought(spec.meat_category, spec.week_days),
        "night_shopper": f"SELECT DISTINCT customer_pk FROM purchases WHERE {hour} >= {spec.night_from_hour}",
        "morning_shopper": f"SELECT DISTINCT customer_pk FROM purchases WHERE {hour} < {spec.morning_before_hour}",
        "prefers_cash": "SELECT customer_pk FROM purchases GROUP BY 1 HAVING "
        f"CAST(count(*) FILTER (payment_method_name = '{spec.cash_name}') AS DOUBLE) / count(*) "
        f">= CAST({spec.payment_share} AS DOUBLE)",
        "prefers_card": "SELECT customer_pk FROM purchases GROUP BY 1 HAVING "
        f"CAST(count(*) FILTER (payment_method_name = '{spec.card_name}') AS DOUBLE) / count(*) "
        f">= CAST({spec.payment_share} AS DOUBLE)",
        "weekend_shopper": "SELECT customer_pk FROM purchases GROUP BY 1 HAVING "
        "CAST(count(*) FILTER (dayofweek(purchase_datetime) IN (0, 6)) AS DOUBLE) / count(*) "
        f">= CAST({spec.weekend_share} AS DOUBLE)",
        "weekday_shopper": "SELECT customer_pk FROM purchases GROUP BY 1 HAVING "
        "CAST(count(*) FILTER (dayofweek(purchase_datetime) IN (0, 6)) AS DOUBLE) / count(*) "
        f"<= CAST({spec.weekday_share} AS DOUBLE)",
        "single_item_buyer": "SELECT customer_pk FROM baskets GROUP BY 1 HAVING "
        f"avg(CASE WHEN n_items = 1 THEN 1.0 ELSE 0.0 END) >= {spec.single_item_share}",
        "varied_shopper": "SELECT customer_pk FROM bought GROUP BY 1 "
        f"HAVING count(DISTINCT category_name) >= {spec.varied_categories}",
        "store_loyal": "SELECT customer_pk FROM purchases WHERE NOT is_delivery GROUP BY 1 "
        "HAVING count(DISTINCT store_pk) = 1",
        "switching_store": "SELECT customer_pk FROM purchases WHERE NOT is_delivery GROUP BY 1 "
        "HAVING count(DISTINCT store_pk) > 1",
        "family_shopper": f"SELECT customer_pk FROM baskets GROUP BY 1 HAVING avg(n_items) >= {spec.family_items}",
        "early_bird": "SELECT DISTINCT customer_pk FROM purchases "
        f"WHERE {hour} >= {spec.early_from_hour} AND {hour} <= {spec.early_to_hour}",
        "any_purchase": "SELECT DISTINCT customer_pk FROM purchases",
        "recent_high_spender": f"SELECT customer_pk FROM purchases WHERE {since(spec.week_days)} GROUP BY 1 "
        f"HAVING sum(total_amount) > {spec.high_spend_over}",
        "fruit_lover": f"SELECT customer_pk FROM bought WHERE {since(spec.month_days)} "
        f"AND category_name = {quoted(spec.fruit_category)} GROUP BY 1 "
        f"HAVING count(DISTINCT purchase_pk) >= {spec.fruit_lover_purchases}",
        "bought_meat": bought(spec.meat_category, spec.quarter_days),
    }
    inverse = {
        "not_bought_veggies_14d": "bought_veggies",
        "no_purchases": "any_purchase",
        "vegetarian_profile": "bought_meat",
    }
    columns = []
    for flag in FLAG_NAMES:
        if flag == "new_customer":
            condition = f"reg_date >= {day} - {spec.month_days}"
        elif flag in inverse:
            condition = f"one_{inverse[flag]}.customer_pk IS NULL"
        else:
            condition = f"one_{flag}.customer_pk IS NOT NULL"
        columns.append(f"CASE WHEN {condition} THEN 1 ELSE 0 END AS {flag}")
    ctes = ",\n".join(f"one_{name} AS ({sql})" for name, sql in ones.items())
    joins = "\n".join(f"LEFT JOIN one_{name} ON one_{name}.customer_pk = c.customer_pk" for name in ones)
    return f"""
bought AS (
  SELECT p.customer_pk, p.purchase_pk, p.purchase_datetime, product_name, category_name, is_organic
  FROM purchases p JOIN items i ON p.purchase_pk = i.purchase_pk JOIN products r ON i.product_pk = r.product_pk),
baskets AS (
  SELECT p.customer_pk, p.purchase_pk, count(DISTINCT item_pk) AS n_items
  FROM purchases p JOIN items i ON p.purchase_pk = i.purchase_pk GROUP BY 1, 2),
{ctes},
matrix AS (SELECT customer_id, {", ".join(columns)} FROM customers c
{joins})
"""


# The raw tables that the documents must give.

GROUP = (
    "CASE p_type WHEN 'STANDARD' THEN '🥛 Молочные продукты' WHEN 'ECONOMY' THEN '🍎 Фрукты и ягоды' "
    "WHEN 'MEDIUM' THEN '🥦 Овощи и зелень' WHEN 'LARGE' THEN '🥩 Мясо, рыба, яйца и бобовые' "
    "WHEN 'PROMO' THEN '🌾 Зерновые и хлебобулочные изделия' ELSE 'Напитки ' END"
)


def padded(column: str, width: int, fill: str = "0") -> str:
    return f"lpad(CAST({column} AS VARCHAR), {width}, '{fill}')"


def address(k: str, prefix: str, condition: str = "true", country: bool = True) -> str:
    parts = {
        "country": f"CASE WHEN {k} % 10 = 1 THEN '' ELSE concat('Country ', {k} % 5) END",
        "city": f"concat('City ', {k} % 40)",
        "street": f"concat('Street ', {k} % 7)",
        "house": f"CAST({k} % 50 AS VARCHAR)",
        "apartment": f"CASE WHEN {k} % 11 = 0 THEN '' ELSE CAST({k} % 90 AS VARCHAR) END",
        "postal_code": padded(f"{k} % 40", 6, "1"),
    }
    if not country:
        del parts["country"]
    return ", ".join(
        f"CASE WHEN {k} % 6 <> 0 AND {condition} THEN {sql} ELSE '' END AS {prefix}{name}"
        for name, sql in parts.items()
    )


def masked_phone(k: str) -> str:
    return f"sha256('+7900' || {padded(k, 7)})"


MASKED_ITEM_MAKER = '{"name":"Maker","country":"Country 1","website":"www.maker","inn":"7700"}'
ITEM_KBJU = '{"calories":"10","protein":"1","fat":"2","carbohydrates":"3"}'

RAW = f"""
raw_products AS (
  SELECT concat('PRD-', {padded("p_partkey", 7)}) AS id,
         concat(upper(p_name), CASE WHEN p_size < 5 THEN ' Хлеб' ELSE '' END) AS name,
         CASE WHEN p_size = 48 THEN '' ELSE {GROUP} END AS "group",
         CASE WHEN p_size % 7 = 0 THEN '' ELSE concat(p_brand, ' ', p_type) END AS description,
         CAST(p_size * 10 AS DOUBLE) AS calories, CAST(p_size + 0.5 AS DOUBLE) AS protein,
         CAST(CASE WHEN p_size = 13 THEN 0 ELSE 10 END AS DOUBLE) AS fat, CAST(0 AS DOUBLE) AS carbohydrates,
         CASE WHEN p_size = 50 THEN 0 ELSE p_retailprice END AS price,
         CASE p_size % 4 WHEN 0 THEN 'КГ' WHEN 1 THEN 'шт' WHEN 2 THEN 'Упаковка' ELSE '' END AS unit,
         CASE WHEN p_size % 9 = 0 THEN '' ELSE concat('Country ', p_size % 5) END AS origin_country,
         CASE WHEN p_size % 3 = 2 THEN 0 ELSE p_size END AS expiry_days,
         p_size % 5 IN (0, 1, 2) AS is_organic, {padded("p_partkey", 13)} AS barcode,
         CASE WHEN p_size = 47 THEN '' ELSE p_brand END AS manufacturer_name,
         CASE WHEN p_size = 47 THEN '' ELSE concat('Country ', p_size % 5) END AS manufacturer_country,
         CASE WHEN p_size = 47 THEN '' ELSE concat('WWW.', p_brand) END AS manufacturer_website,
         CASE WHEN p_size = 47 THEN '' ELSE concat('77', substring(p_brand, 7)) END AS manufacturer_inn,
         timestamp '2001-07-01 10:00:00' AS load_date
  FROM part),
raw_customers AS (
  SELECT upper(c_name) AS customer_id, CASE WHEN c_custkey % 40 = 7 THEN '' ELSE c_mktsegment END AS first_name,
         concat('Family', c_custkey % 500) AS last_name, sha256(lower(concat(c_name, '@Mail.RU'))) AS email,
         CASE WHEN c_custkey % 3 = 2 THEN '' ELSE {masked_phone("c_custkey")} END AS phone,
         CASE WHEN c_custkey % 41 = 0 THEN date '1970-01-01' WHEN c_custkey % 43 = 0 THEN date '2030-01-01'
              WHEN c_custkey % 47 = 0 THEN date '1900-01-01'
              ELSE date '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER) END AS birth_date,
         CASE c_custkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'Other' ELSE '' END AS gender,
         CAST({DAY} - CAST(c_custkey % 120 AS INTEGER) AS TIMESTAMP)
           + to_hours(CAST(c_custkey % 24 - 3 * (c_custkey % 2) AS INTEGER))
           + INTERVAL 30 MINUTE + INTERVAL 15 SECOND AS registration_date,
         c_acctbal > 0 AS is_loyalty_member, concat('CARD-', c_custkey) AS loyalty_card_number,
         concat('Supplier#', {padded("c_custkey % 100", 9)}) AS purchase_location_store_id,
         concat('Shop Supplier#', {padded("c_custkey % 100", 9)}) AS purchase_location_store_name,
         'Market' AS purchase_location_store_network, 'near home' AS purchase_location_store_type_description,
         concat('Country ', c_custkey % 5) AS purchase_location_country,
         concat('City ', c_custkey % 30) AS purchase_location_city, 'Main' AS purchase_location_street,
         '1' AS purchase_location_house, '111111' AS purchase_location_postal_code,
         {address("c_custkey", "delivery_address_")},
         CASE c_custkey % 3 WHEN 0 THEN 'RU' WHEN 1 THEN 'en' ELSE '' END AS preferred_language,
         CASE c_custkey % 5 WHEN 0 THEN 'CARD' WHEN 1 THEN 'Cash' WHEN 2 THEN 'online' WHEN 3 THEN 'crypto'
              ELSE '' END AS preferred_payment_method,
         c_custkey % 3 <> 1 AS receive_promotions, timestamp '2001-07-02 10:00:00' AS load_date
  FROM customer),
raw_stores AS (
  SELECT s_name AS store_id, concat('Shop ', s_name) AS store_name,
         CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE concat('Market ', s_suppkey % 4) END AS store_network,
         'near home' AS store_type_description,
         CASE s_suppkey % 3 WHEN 0 THEN 'Offline' WHEN 1 THEN 'online' ELSE '' END AS type,
         CASE WHEN s_suppkey % 19 = 0 THEN CAST([] AS VARCHAR[])
              ELSE ['🥛 Молочные продукты', concat('🍎🍏 Section ', s_suppkey % 5), 'Напитки '] END AS categories,
         concat('Manager ', s_suppkey % 20) AS manager_name,
         {masked_phone("s_suppkey % 20")} AS manager_phone,
         CASE WHEN s_suppkey % 13 = 0 THEN '' ELSE sha256(concat('boss', s_suppkey % 20, '@shop.ru')) END
           AS manager_email,
         CASE WHEN s_suppkey % 8 = 0 THEN '' ELSE concat('Country ', s_suppkey % 5) END AS location_country,
         concat('City ', s_suppkey % 30) AS location_city, concat('Street ', s_suppkey % 10) AS location_street,
         CAST(s_suppkey % 12 AS VARCHAR) AS location_house,
         CASE WHEN s_suppkey % 17 = 0 THEN '' ELSE {padded("s_suppkey % 30", 6, "1")} END AS location_postal_code,
         s_acctbal AS location_latitude,
         CAST(CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE 37.5 END AS DOUBLE) AS location_longitude,
         CASE WHEN s_suppkey % 23 = 0 THEN '' ELSE concat('0', s_suppkey % 3 + 7, ':00-22:00') END
           AS opening_hours_mon_fri,
         CASE WHEN s_suppkey % 23 = 0 THEN '' ELSE '09:00-21:00' END AS opening_hours_sat,
         CASE WHEN s_suppkey % 23 = 0 OR s_suppkey % 2 = 1 THEN '' ELSE 'Closed' END AS opening_hours_sun,
         s_suppkey % 2 = 0 AS accepts_online_orders, s_acctbal > 0 AS delivery_available,
         true AS warehouse_connected,
         CASE WHEN s_suppkey % 29 = 0 THEN date '2099-01-01' ELSE date '2001-06-01' END AS last_inventory_date,
         timestamp '2001-07-03 08:00:00' AS load_date
  FROM supplier),
raw_purchases AS (
  SELECT concat('ORD-', l_orderkey, '-', l_linenumber) AS purchase_id,
         concat('CUSTOMER#', {padded("o_custkey", 9)}) AS customer_id,
         'First' AS customer_first_name, 'Last' AS customer_last_name,
         sha256(concat('customer#', {padded("o_custkey", 9)}, '@mail.ru')) AS customer_email,
         {masked_phone("o_custkey")} AS customer_phone, true AS customer_is_loyalty_member,
         concat('CARD-', o_custkey) AS customer_loyalty_card_number,
         concat('Supplier#', {padded("l_suppkey", 9)}) AS store_id, 'Shop' AS store_name,
         'Market' AS store_network, 'near home' AS store_type_description,
         concat('City ', l_suppkey % 30) AS store_city, 'Street' AS store_street, '1' AS store_house,
         '111111' AS store_postal_code,
         concat('[{{"product_id":"PRD-', {padded("l_partkey", 7)}, '","name":"first","category":"',
                CASE l_returnflag WHEN 'A' THEN '🥛 Молочные продукты' ELSE '🍎 Фрукты и ягоды' END,
                '","quantity":"', l_quantity, '","unit":"КГ","price_per_unit":"1.5","total_price":"',
                l_extendedprice, '","kbju":{ITEM_KBJU},"manufacturer":{MASKED_ITEM_MAKER}}},',
                '{{"product_id":"PRD-', {padded("l_partkey + 1", 7)},
                '","name":"second","category":"🥦 Овощи и зелень","quantity":"', l_linenumber,
                '","unit":"шт","price_per_unit":"2","total_price":"',
                CASE WHEN l_linenumber = 1 THEN '0' ELSE '2.5' END, '","kbju":{ITEM_KBJU}',
                CASE WHEN l_linenumber = 2 THEN ',"manufacturer":{MASKED_ITEM_MAKER}' ELSE '' END, '}}]') AS items,
         {address("o_custkey", "delivery_", "o_orderstatus = 'F'", country=False)},
         CASE WHEN l_quantity = 50 THEN -1 ELSE l_extendedprice END AS total_amount,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Card' WHEN '2-HIGH' THEN 'CARD' WHEN '3-MEDIUM' THEN 'cash'
              WHEN '5-LOW' THEN 'barter' ELSE 'online' END AS payment_method,
         o_orderstatus = 'F' AS is_delivery,
         date_trunc('day', o_orderdate) + to_hours(CAST(l_orderkey % 24 AS INTEGER)) + INTERVAL 15 MINUTE
           AS purchase_datetime,
         l_shipdate AS load_date, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""

VERSION = "CAST(epoch(load_date) AS BIGINT) AS version"
STAMPS = f"{text('load_date')} AS load_date, {VERSION}"

RAW_OUTPUT = {
    "raw_products": f"SELECT * EXCLUDE (load_date), {STAMPS} FROM raw_products",
    "raw_customers": "SELECT * EXCLUDE (load_date) REPLACE (CAST(birth_date AS VARCHAR) AS birth_date, "
    f"{text('registration_date')} AS registration_date), {STAMPS} FROM raw_customers",
    "raw_stores": "SELECT * EXCLUDE (load_date) REPLACE (CAST(last_inventory_date AS VARCHAR) AS "
    f"last_inventory_date, array_to_string(categories, '|') AS categories), {STAMPS} FROM raw_stores",
    "raw_purchases": "SELECT * EXCLUDE (load_date, l_partkey, l_linenumber, l_quantity, l_extendedprice, "
    f"l_returnflag) REPLACE ({text('purchase_datetime')} AS purchase_datetime), {STAMPS} FROM raw_purchases",
}


def names(prefix: str, apartment: bool = False) -> list[str]:
    return [f"{prefix}{part}" for part in ("city", "street", "house", *(["apartment"] if apartment else []), "postal_code")]


def not_empty(*columns: str) -> str:
    return " AND ".join(f"{column} <> ''" for column in columns)


def optional(column: str) -> str:
    return f"CASE WHEN {column} <> '' THEN {key(f'lower({column})')} ELSE '0' END"


def code(column: str, codes: dict[str, int]) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {value}" for name, value in codes.items())
    return f"CASE lower({column}) {cases} ELSE 0 END"


METHODS = {"card": 1, "cash": 2, "online": 3}
GENDERS = {"male": 1, "female": 2}
HOURS = [f"lower(opening_hours_{day})" for day in ("mon_fri", "sat", "sun")]
MANAGER = key("lower(manager_name)", "manager_phone", "manager_email")


def value_dim(column: str, table: str, pk: str, name: str) -> str:
    return f"SELECT {key(f'lower({column})')} AS {pk}, lower({column}) AS {name} FROM {table} WHERE {column} <> ''"


def sourced_dim(column: str, table: str) -> str:
    return (
        f"SELECT {key(f'lower({column})')} AS country_id, lower({column}) AS country_name, '{table}' AS record_source, "
        f"load_date FROM {table} WHERE {column} <> ''"
    )


def address_dim(table: str, prefix: str, latitude: str, longitude: str) -> str:
    return (
        f"SELECT {key(*lowered(*names(prefix)))} AS address_id, {optional(prefix + 'country')} AS country_id, "
        f"{key(f'lower({prefix}city)')} AS city_id, lower({prefix}street) AS street, lower({prefix}house) AS house, "
        f"lower({prefix}postal_code) AS postal_code, {latitude} AS latitude, {longitude} AS longitude, "
        f"'{table}' AS record_source, load_date FROM {table} WHERE {not_empty(*names(prefix))}"
    )


def plain_dim(select: str, table: str, where: str) -> str:
    return f"SELECT DISTINCT {select}, load_date FROM {table} WHERE {where}"


DELIVERY = names("delivery_address_", apartment=True)

# Per dimension: its rows before the choice of one row per key, the key, and the order of the choice after version.
DIMS: dict[str, tuple[str, str, str]] = {
    "dim_categories": (
        plain_dim(
            f'{key(clean(chr(34) + "group" + chr(34)))} AS category_id, lower("group") AS category_name, '
            f'{clean(chr(34) + "group" + chr(34))} AS clear_category_name',
            "raw_products",
            "\"group\" <> ''",
        ),
        "category_id",
        "clear_category_name DESC, category_name DESC",
    ),
    "dim_units": (
        plain_dim(f"{key('lower(unit)')} AS unit_id, lower(unit) AS unit_name", "raw_products", "unit <> ''"),
        "unit_id",
        "unit_name",
    ),
    "dim_countries": (
        " UNION ALL ".join(
            (
                sourced_dim("origin_country", "raw_products"),
                sourced_dim("location_country", "raw_stores"),
                sourced_dim("delivery_address_country", "raw_customers"),
            )
        ),
        "country_id",
        "record_source DESC",
    ),
    "dim_language": (
        plain_dim(
            f"{key('lower(preferred_language)')} AS language_id, lower(preferred_language) AS language_name",
            "raw_customers",
            "preferred_language <> ''",
        ),
        "language_id",
        "language_name",
    ),
    "dim_cities": (
        plain_dim(
            f"{key('lower(location_city)')} AS city_id, lower(location_city) AS city_name, "
            f"{optional('location_country')} AS country_id",
            "raw_stores",
            "location_city <> ''",
        ),
        "city_id",
        "country_id DESC",
    ),
    "dim_address": (
        address_dim("raw_stores", "location_", "location_latitude", "location_longitude")
        + " UNION ALL "
        + address_dim("raw_customers", "delivery_address_", "0.0", "0.0"),
        "address_id",
        "record_source DESC, longitude DESC, latitude DESC, postal_code DESC, house DESC, street DESC, "
        "city_id DESC, country_id DESC",
    ),
    "dim_delivery_addresses": (
        plain_dim(
            f"{key(*lowered(*DELIVERY))} AS delivery_address_id, "
            f"{key(*lowered(*names('delivery_address_')))} AS address_id, "
            f"{key('lower(delivery_address_city)')} AS city_id, {optional('delivery_address_country')} AS country_id, "
            "lower(delivery_address_apartment) AS apartment",
            "raw_customers",
            not_empty(*DELIVERY),
        ),
        "delivery_address_id",
        "apartment DESC, country_id DESC",
    ),
    "dim_managers": (
        plain_dim(
            f"{MANAGER} AS manager_id, lower(manager_name) AS manager_name, manager_phone, manager_email",
            "raw_stores",
            "manager_name <> '' AND (manager_phone <> '' OR manager_email <> '')",
        ),
        "manager_id",
        "manager_email DESC",
    ),
    "dim_store_networks": (
        plain_dim(
            f"{key('lower(store_network)')} AS store_network_id, lower(store_network) AS store_network_name",
            "raw_stores",
            "store_network <> ''",
        ),
        "store_network_id",
        "store_network_name",
    ),
    "dim_opening_hours": (
        plain_dim(
            f"{key(*HOURS)} AS opening_hours_id, {HOURS[0]} AS mon_fri, {HOURS[1]} AS sat, {HOURS[2]} AS sun",
            "raw_stores",
            "opening_hours_mon_fri <> '' OR opening_hours_sat <> '' OR opening_hours_sun <> ''",
        ),
        "opening_hours_id",
        "mon_fri",
    ),
    "dim_gender": (
        plain_dim(
            f"{code('gender', GENDERS)} AS gender_id, lower(gender) AS gender_name", "raw_customers", "gender <> ''"
        ),
        "gender_id",
        "gender_name DESC",
    ),
    "dim_manufacturer": (
        plain_dim(
            f"{key(*lowered('manufacturer_name', 'manufacturer_inn'))} AS manufacturer_id, "
            f"{optional('manufacturer_country')} AS country_id, lower(manufacturer_name) AS manufacturer_name, "
            "lower(manufacturer_website) AS manufacturer_website, lower(manufacturer_inn) AS manufacturer_inn",
            "raw_products",
            not_empty("manufacturer_name", "manufacturer_inn"),
        ),
        "manufacturer_id",
        "manufacturer_inn DESC, manufacturer_website DESC, manufacturer_name DESC, country_id DESC",
    ),
    "dim_payment_method": (
        plain_dim(
            f"{code('payment_method', METHODS)} AS payment_method_id, lower(payment_method) AS payment_method_name",
            "raw_purchases",
            "payment_method <> ''",
        ),
        "payment_method_id",
        "payment_method_name DESC",
    ),
    "dim_type_store": (
        plain_dim(f"{key('lower(type)')} AS type_id, lower(type) AS type_name", "raw_stores", "type <> ''"),
        "type_id",
        "type_name",
    ),
}


def dim_rows(name: str) -> str:
    rows, pk, order = DIMS[name]
    return latest(f"({rows})", pk, f"load_date DESC, {order}", "* EXCLUDE (rn)")


def past_day(column: str) -> str:
    return f"{column} <= {DAY} AND {column} > date '1900-01-01'"


ITEMS = f"""
item_rows AS (
  SELECT purchase_id, concat('PRD-', {padded("l_partkey", 7)}) AS product_id,
         CASE l_returnflag WHEN 'A' THEN '🥛 Молочные продукты' ELSE '🍎 Фрукты и ягоды' END AS category,
         l_quantity AS quantity, 'КГ' AS unit, l_extendedprice AS total_price, 'Maker' AS m_name, '7700' AS m_inn,
         load_date FROM raw_purchases
  UNION ALL
  SELECT purchase_id, concat('PRD-', {padded("l_partkey + 1", 7)}), '🥦 Овощи и зелень',
         CAST(l_linenumber AS DOUBLE), 'шт', CASE WHEN l_linenumber = 1 THEN 0 ELSE 2.5 END,
         CASE WHEN l_linenumber = 2 THEN 'Maker' ELSE '' END, CASE WHEN l_linenumber = 2 THEN '7700' ELSE '' END,
         load_date FROM raw_purchases)
"""

DETAILS = {
    "products_details": f"""
SELECT {key("lower(id)")} AS product_pk, lower(id) AS product_id, lower(name) AS name,
       {key(clean('"group"'))} AS category_id, lower(description) AS description, calories, protein, fat,
       carbohydrates, price, {key("lower(unit)")} AS unit_id, {optional("origin_country")} AS country_id, expiry_days,
       is_organic, barcode, {key(*lowered("manufacturer_name", "manufacturer_inn"))} AS manufacturer_id,
       'raw_products' AS record_source, load_date
FROM raw_products
WHERE {not_empty("id", "name", '"group"', "unit", "manufacturer_name", "manufacturer_inn")} AND price > 0""",
    "customers_details": f"""
SELECT {key("lower(customer_id)")} AS customer_pk, lower(customer_id) AS customer_id, lower(first_name) AS first_name,
       lower(last_name) AS last_name, email, phone, CAST(birth_date AS VARCHAR) AS birth_date,
       {code("gender", GENDERS)} AS gender_id, {text("registration_date")} AS registration_date, is_loyalty_member,
       lower(loyalty_card_number) AS loyalty_card_number, {key("lower(preferred_language)")} AS language_id,
       {code("preferred_payment_method", METHODS)} AS payment_method_id, receive_promotions,
       'raw_customers' AS record_source, load_date
FROM raw_customers
WHERE {not_empty("customer_id", "first_name", "last_name")} AND {past_day("birth_date")}
  AND registration_date <= {NOW}""",
    "stores_details": f"""
SELECT {key("lower(store_id)")} AS store_pk, lower(store_id) AS store_id, lower(store_name) AS store_name,
       {optional("type")} AS type_id, {optional("store_network")} AS store_network_id,
       array_to_string(list_transform(categories, lambda x: {key(clean("x"))}), '|') AS category_ids,
       {MANAGER} AS manager_id, {key(*lowered(*names("location_")))} AS location_id,
       {key(*HOURS)} AS opening_hours_id, accepts_online_orders, delivery_available, warehouse_connected,
       CAST(last_inventory_date AS VARCHAR) AS last_inventory_date, load_date
FROM raw_stores
WHERE {not_empty("store_id", "store_name", *names("location_"), "manager_name", "manager_phone", "manager_email")}
  AND {past_day("last_inventory_date")}""",
    "link_customers_stores": f"""
SELECT {key("lower(customer_id)", "lower(purchase_location_store_id)")} AS link_pk,
       {key("lower(customer_id)")} AS customer_pk, {key("lower(purchase_location_store_id)")} AS store_pk,
       {key(*lowered(*names("delivery_address_")))} AS delivery_address_id,
       {key(*lowered(*names("delivery_address_")))} AS address_id, 'raw_customers' AS record_source, load_date
FROM raw_customers
WHERE {not_empty("customer_id", "purchase_location_store_id", *names("delivery_address_"))}""",
    "purchases_details": f"""
SELECT {key("lower(purchase_id)")} AS purchase_pk, lower(purchase_id) AS purchase_id,
       {key("lower(customer_id)")} AS customer_pk, {key("lower(store_id)")} AS store_pk,
       CASE WHEN {not_empty(*names("delivery_", apartment=True))}
            THEN {key(*lowered(*names("delivery_", apartment=True)))} ELSE '0' END AS delivery_address_id,
       total_amount, {code("payment_method", METHODS)} AS payment_method_id, is_delivery,
       {text("purchase_datetime")} AS purchase_datetime, load_date
FROM raw_purchases
WHERE {not_empty("purchase_id", "customer_id", "store_id")} AND total_amount > 0""",
    "purchase_item_details": f"""
SELECT {key("lower(purchase_id)", "lower(product_id)", "CAST(CAST(quantity AS INTEGER) AS VARCHAR)")} AS item_pk,
       {key("lower(purchase_id)")} AS purchase_pk, {key("lower(product_id)")} AS product_pk,
       {key(clean("category"))} AS category_id, quantity, {key("lower(unit)")} AS unit_id, total_price,
       CASE WHEN m_name = '' AND m_inn = '' THEN '0' ELSE {key("lower(m_name)", "lower(m_inn)")} END
         AS manufacturer_id, load_date
FROM item_rows
WHERE {not_empty("purchase_id", "product_id", "category", "unit")} AND total_price > 0""",
}


def detail_rows(name: str) -> str:
    return f"({DETAILS[name]})"


def with_raw(select: str, *ctes: str) -> str:
    return f"WITH {', '.join((RAW, ITEMS, *ctes))} {select}"


def with_mart(select: str, *ctes: str) -> str:
    return f"WITH {', '.join((MART, *ctes))} {select}"


def stamped(select: str) -> str:
    return f"SELECT * EXCLUDE (load_date), {STAMPS} FROM {select}"
