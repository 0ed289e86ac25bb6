"""The given tables in the roles of the retail model.

Two views of them: mart tables with natural keys for the feature job, and nested JSON-like documents for the layers
before it. Both are plain projections, so their size follows the tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.parallel import spread
from basketry.plans.features import FeatureSpec
from basketry.plans.prepare import MartInputs

AS_OF = date(2001, 8, 1)
LOAD_TS = "2001-08-01 00:00:00"

# Limits that split the given tables' customers; the windows are wide because orders are years apart.
SPEC = FeatureSpec(
    week_days=90,
    short_days=180,
    month_days=365,
    quarter_days=730,
    milk_category="standard",
    fruit_category="economy",
    veggie_category="medium",
    meat_category="large",
    bakery_words=("red plate", "cold ring"),
    recurrent_over=2,
    bulk_over=270000,
    low_cost_under=230000,
    loyal_purchases=10,
    single_item_share=0.2,
    varied_categories=6,
    family_items=3,
    high_spend_over=300000,
    fruit_lover_purchases=2,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mart_inputs(spark: SparkSession, sf_dir: str) -> MartInputs:
    """Mart tables: orders are purchases, lineitem their items, part the products, supplier the stores."""
    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")

    registered = "date_format(date_sub(date'2001-08-01', cast(abs(acctbal) as int) % 700), 'yyyy-MM-dd HH:mm:ss')"
    people = customer.selectExpr("c_custkey AS pk", "c_name AS name", "c_acctbal AS acctbal").unionByName(
        supplier.selectExpr("-1 - s_suppkey AS pk", "s_name AS name", "s_acctbal AS acctbal")
    )
    return MartInputs(
        customers=people.selectExpr(
            "pk AS customer_pk",
            "name AS customer_id",
            f"{registered} AS registration_date",
            "acctbal > 5000 AS is_loyalty_member",
            "1L AS version",
        ),
        purchases=orders.selectExpr(
            "o_orderkey AS purchase_pk",
            "o_custkey AS customer_pk",
            "(o_custkey * 7 + o_orderkey % 2) % 110 AS store_pk",
            "if(o_orderstatus = 'F', o_custkey + 1, 0L) AS delivery_address_id",
            "o_totalprice AS total_amount",
            "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 "
            "WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN 2 ELSE 3 END AS payment_method_id",
            "o_orderstatus = 'F' AS is_delivery",
            "concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' ', lpad(o_orderkey % 24, 2, '0'), ':00:00') "
            "AS purchase_datetime",
            "1L AS version",
        ),
        products=part.selectExpr(
            "p_partkey AS product_pk",
            "p_name AS product_name",
            "p_retailprice AS price",
            "p_brand = 'Brand#7' AND p_size <= 5 AS is_organic",
            "cast(p_partkey AS string) AS product_id",
            "lower(p_type) AS category_id",
            "1L AS version",
        ),
        stores=supplier.selectExpr(
            "s_suppkey AS store_pk",
            "s_acctbal > 0 AS store_delivery_available",
            "s_suppkey AS location_id",
            "1L AS version",
        ),
        items=lineitem.selectExpr(
            "l_orderkey * 10 + l_linenumber AS item_pk",
            "l_orderkey AS purchase_pk",
            "l_partkey AS product_pk",
            "l_quantity AS quantity",
            "l_extendedprice AS total_price",
            "unix_seconds(cast(l_shipdate AS timestamp)) AS version",
        ),
        delivery_addresses=customer.selectExpr(
            "c_custkey + 1 AS delivery_address_id", "c_nationkey AS delivery_city_id", "1L AS version"
        ),
        payment_methods=orders.selectExpr(
            "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 "
            "WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN 2 ELSE 3 END AS payment_method_id",
            "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'card' "
            "WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN 'cash' ELSE 'online' END AS payment_method_name",
            "1L AS version",
        ).distinct(),
        categories=part.filter("p_type <> 'PROMO'")
        .selectExpr("lower(p_type) AS category_id", "lower(p_type) AS category_name", "1L AS version")
        .distinct(),
        addresses=supplier.filter("s_acctbal > 0").selectExpr(
            "s_suppkey AS address_id", "s_nationkey AS store_city_id", "1L AS version"
        ),
    )


GROUP_OF_TYPE = (
    "CASE {0} WHEN 'STANDARD' THEN '🥛 Молочные продукты' WHEN 'ECONOMY' THEN '🍎 Фрукты и ягоды' "
    "WHEN 'MEDIUM' THEN '🥦 Овощи и зелень' WHEN 'LARGE' THEN '🥩 Мясо, рыба, яйца и бобовые' "
    "WHEN 'PROMO' THEN '🌾 Зерновые и хлебобулочные изделия' ELSE 'Напитки ' END"
)


def product_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "concat('PRD-', lpad(p_partkey, 7, '0')) AS id",
        "concat(upper(p_name), if(p_size < 5, ' Хлеб', '')) AS name",
        f"if(p_size = 48, '', {GROUP_OF_TYPE.format('p_type')}) AS `group`",
        "if(p_size % 7 = 0, NULL, concat(p_brand, ' ', p_type)) AS description",
        "named_struct('calories', cast(p_size * 10 AS string), 'protein', concat(p_size, '.5'), "
        "'fat', if(p_size = 13, 'n/a', '1e1'), 'carbohydrates', cast(NULL AS string)) AS kbju",
        "if(p_size = 50, '0', cast(p_retailprice AS string)) AS price",
        "CASE p_size % 4 WHEN 0 THEN 'КГ' WHEN 1 THEN 'шт' WHEN 2 THEN 'Упаковка' ELSE '' END AS unit",
        "if(p_size % 9 = 0, '', concat('Country ', p_size % 5)) AS origin_country",
        "CASE p_size % 3 WHEN 0 THEN cast(p_size AS string) WHEN 1 THEN concat(p_size, '.7') ELSE 'bad' END "
        "AS expiry_days",
        "CASE p_size % 5 WHEN 0 THEN 'ДА' WHEN 1 THEN 'true' WHEN 2 THEN '1' WHEN 3 THEN 'no' END AS is_organic",
        "lpad(p_partkey, 13, '0') AS barcode",
        "if(p_size = 47, NULL, named_struct('name', p_brand, 'country', concat('Country ', p_size % 5), "
        "'website', concat('WWW.', p_brand), 'inn', concat('77', substring(p_brand, 7)))) AS manufacturer",
        "'2001-07-01T10:00:00.000Z' AS kafka_send_date",
    )


def _delivery_address(key: str) -> str:
    return (
        f"if({key} % 6 = 0, NULL, named_struct('country', if({key} % 10 = 1, '', concat('Country ', {key} % 5)), "
        f"'city', concat('City ', {key} % 40), 'street', concat('Street ', {key} % 7), "
        f"'house', cast({key} % 50 AS string), 'apartment', if({key} % 11 = 0, '', cast({key} % 90 AS string)), "
        f"'postal_code', lpad({key} % 40, 6, '1')))"
    )


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = "concat('Supplier#', lpad(c_custkey % 100, 9, '0'))"
    return table(spark, sf_dir, "customer").selectExpr(
        "upper(c_name) AS customer_id",
        "if(c_custkey % 40 = 7, '', c_mktsegment) AS first_name",
        "concat('Family', c_custkey % 500) AS last_name",
        "concat('  ', c_name, '@Mail.RU ') AS email",
        "CASE c_custkey % 3 WHEN 0 THEN concat('8 (900) ', lpad(c_custkey, 7, '0')) "
        "WHEN 1 THEN concat('+7-900-', lpad(c_custkey, 7, '0')) ELSE '' END AS phone",
        "CASE WHEN c_custkey % 41 = 0 THEN 'unknown' WHEN c_custkey % 43 = 0 THEN '2030-01-01' "
        "WHEN c_custkey % 47 = 0 THEN '1900-01-01' "
        "ELSE concat(cast(date_add(date'1950-01-01', cast(c_custkey % 18000 AS int)) AS string), "
        "if(c_custkey % 5 = 0, 'T00:00:00', '')) END AS birth_date",
        "CASE c_custkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'Other' ELSE '' END AS gender",
        "concat(cast(date_sub(date'2001-08-01', cast(c_custkey % 120 AS int)) AS string), "
        "'t', lpad(c_custkey % 24, 2, '0'), ':30:15.123', if(c_custkey % 2 = 0, 'z', '+03:00')) AS registration_date",
        "if(c_acctbal > 0, 'Yes', 'false') AS is_loyalty_member",
        "concat('CARD-', c_custkey) AS loyalty_card_number",
        f"named_struct('store_id', {store}, 'store_name', concat('Shop ', {store}), 'store_network', 'Market', "
        "'store_type_description', 'near home', 'country', concat('Country ', c_custkey % 5), 'city', "
        "concat('City ', c_custkey % 30), 'street', 'Main', 'house', '1', 'postal_code', '111111') "
        "AS purchase_location",
        f"{_delivery_address('c_custkey')} AS delivery_address",
        "named_struct('preferred_language', CASE c_custkey % 3 WHEN 0 THEN 'RU' WHEN 1 THEN 'en' ELSE '' END, "
        "'preferred_payment_method', CASE c_custkey % 5 WHEN 0 THEN 'CARD' WHEN 1 THEN 'Cash' "
        "WHEN 2 THEN 'online' WHEN 3 THEN 'crypto' ELSE '' END, "
        "'receive_promotions', CASE c_custkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' ELSE 'true' END) AS preferences",
        "'2001-07-02T10:00:00' AS kafka_send_date",
    )


def store_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_name AS store_id",
        "concat('Shop ', s_name) AS store_name",
        "if(s_suppkey % 11 = 0, '', concat('Market ', s_suppkey % 4)) AS store_network",
        "'near home' AS store_type_description",
        "CASE s_suppkey % 3 WHEN 0 THEN 'Offline' WHEN 1 THEN 'online' ELSE '' END AS type",
        "if(s_suppkey % 19 = 0, NULL, array('🥛 Молочные продукты', concat('🍎🍏 Section ', s_suppkey % 5), 'Напитки ')) "
        "AS categories",
        "named_struct('name', concat('Manager ', s_suppkey % 20), 'phone', concat('8 900 ', lpad(s_suppkey % 20, 7, '0')), "
        "'email', if(s_suppkey % 13 = 0, '', concat('Boss', s_suppkey % 20, '@Shop.ru'))) AS manager",
        "named_struct('country', if(s_suppkey % 8 = 0, '', concat('Country ', s_suppkey % 5)), "
        "'city', concat('City ', s_suppkey % 30), 'street', concat('Street ', s_suppkey % 10), "
        "'house', cast(s_suppkey % 12 AS string), 'postal_code', if(s_suppkey % 17 = 0, '', lpad(s_suppkey % 30, 6, '1')), "
        "'coordinates', named_struct('latitude', cast(s_acctbal AS string), 'longitude', "
        "if(s_suppkey % 2 = 0, 'east', '37.5'))) AS location",
        "if(s_suppkey % 23 = 0, NULL, named_struct('mon_fri', concat('0', s_suppkey % 3 + 7, ':00-22:00'), "
        "'sat', '09:00-21:00', 'sun', if(s_suppkey % 2 = 0, 'Closed', ''))) AS opening_hours",
        "if(s_suppkey % 2 = 0, 'yes', 'no') AS accepts_online_orders",
        "if(s_acctbal > 0, 'true', 'false') AS delivery_available",
        "'2' AS warehouse_connected",
        "CASE WHEN s_suppkey % 29 = 0 THEN '2099-01-01' ELSE '2001-06-01' END AS last_inventory_date",
        "'2001-07-03T10:00:00.5+02:00' AS kafka_send_date",
    )


def purchase_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One purchase per line of an order, with two items; a line that occurs again is a newer version."""
    lineitem = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
    lines = lineitem.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    kbju = (
        "named_struct('calories', '10', 'protein', '1', 'fat', '2', 'carbohydrates', '3')"
    )
    maker = "named_struct('name', 'Maker', 'country', 'Country 1', 'website', 'www.maker', 'inn', '7700')"
    first = (
        "named_struct('product_id', concat('PRD-', lpad(l_partkey, 7, '0')), 'name', 'first', "
        "'category', CASE l_returnflag WHEN 'A' THEN '🥛 Молочные продукты' ELSE '🍎 Фрукты и ягоды' END, "
        "'quantity', cast(l_quantity AS string), 'unit', 'КГ', 'price_per_unit', '1.5', "
        f"'total_price', cast(l_extendedprice AS string), 'kbju', {kbju}, 'manufacturer', {maker})"
    )
    second = (
        "named_struct('product_id', concat('PRD-', lpad(l_partkey + 1, 7, '0')), 'name', 'second', "
        "'category', '🥦 Овощи и зелень', 'quantity', cast(l_linenumber AS string), 'unit', 'шт', "
        "'price_per_unit', '2', 'total_price', if(l_linenumber = 1, '0', '2.5'), "
        f"'kbju', {kbju}, 'manufacturer', if(l_linenumber = 2, {maker}, NULL))"
    )
    return lines.selectExpr(
        "concat('ORD-', l_orderkey, '-', l_linenumber) AS purchase_id",
        "named_struct('customer_id', concat('CUSTOMER#', lpad(o_custkey, 9, '0')), 'first_name', 'First', "
        "'last_name', 'Last', 'email', concat('Customer#', lpad(o_custkey, 9, '0'), '@Mail.RU'), "
        "'phone', concat('8 (900) ', lpad(o_custkey, 7, '0')), 'is_loyalty_member', 'true', "
        "'loyalty_card_number', concat('CARD-', o_custkey)) AS customer",
        "named_struct('store_id', concat('Supplier#', lpad(l_suppkey, 9, '0')), 'store_name', 'Shop', "
        "'store_network', 'Market', 'store_type_description', 'near home', 'location', named_struct('city', "
        "concat('City ', l_suppkey % 30), 'street', 'Street', 'house', '1', 'postal_code', '111111')) AS store",
        f"array({first}, {second}) AS items",
        "if(l_quantity = 50, '-1', cast(l_extendedprice AS string)) AS total_amount",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Card' WHEN '2-HIGH' THEN 'CARD' WHEN '3-MEDIUM' THEN 'cash' "
        "WHEN '5-LOW' THEN 'barter' ELSE 'online' END AS payment_method",
        "if(o_orderstatus = 'F', 'true', 'false') AS is_delivery",
        "concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T', lpad(l_orderkey % 24, 2, '0'), ':15:00.250000Z') "
        "AS purchase_datetime",
        f"if(o_orderstatus = 'F', {_delivery_address('o_custkey')}, NULL) AS delivery_address",
        "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss\") AS kafka_send_date",
    )


def documents(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "products": product_documents(spark, sf_dir),
        "customers": customer_documents(spark, sf_dir),
        "stores": store_documents(spark, sf_dir),
        "purchases": purchase_documents(spark, sf_dir),
    }
