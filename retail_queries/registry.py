"""All queries by name, and the SQL of those that SQL can say."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions import (
    Keys,
    clean_category,
    code_map,
    mask_pii,
    normalize_email,
    normalize_phone,
    parse_date,
    parse_ts_utc,
    safe_bool,
    safe_float,
    safe_int,
    safe_json,
    sha256_hex,
)
from basketry.functions.clean import GENDER_CODES, PAYMENT_CODES, safe_number_bool
from basketry.operators import (
    dataset_stats,
    duplicate_ratio,
    expire,
    latest_version,
    sample_documents,
    version_stamp,
)
from basketry.operators.parallel import spread
from basketry.operators.quality import REASONS, with_reasons
from basketry.operators.versioned import MART_DAYS, RAW_DAYS
from basketry.plans.daily import DayStore
from basketry.plans.features import FLAG_NAMES, FeatureSpec, duplicate_customers, feature_matrix
from basketry.plans.mart import DETAILS, DIMENSIONS, MART_KEYS, MartContext, mart_rejects, mart_table
from basketry.plans.pipeline import documents_to_raw, mart_reader, raw_to_mart
from basketry.plans.prepare import (
    MartInputs,
    cast_to_schema,
    hex_keys_as_bytes,
    items_by_purchase,
    prepare_customers,
    prepare_items,
    prepare_products,
    prepare_purchases,
    prepare_stores,
)
from basketry.schemas import RAW_SCHEMAS
from basketry.session import apply_settings, shared_dir
from basketry.sources.bucketed import by_purchase, write_buckets
from basketry.sources.documents import read_documents
from basketry.sources.export import export_csv
from basketry.sources.retention import expire_stored
from basketry.sources.tables import PROJECTIONS, normalize_unsigned, project_mart, read_by_month, write_by_month
from basketry.sources.topics import (
    publish,
    publish_texts,
    published,
    subscribe_folder,
    unpublished,
    write_topic_folder,
)
from basketry.streaming.current import current_mart, mart_changes
from basketry.streaming.ingest import REJECTS, count_outcomes, drop_replays, ingest_stream, raw_streams, route
from basketry.streaming.marts import live_mart_reader, mart_stream
from retail_queries import oracle as sql
from retail_queries.tables import AS_OF, GROUP_OF_TYPE, SPEC, documents, mart_inputs, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

CONTEXT = MartContext(Keys("sha256"), datetime(2001, 8, 1, tzinfo=timezone.utc))


def query(name: str, oracle: str | None = None):
    def register(function: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(apply_settings(spark), sf_dir)

        QUERIES[name] = prepared
        if oracle is not None:
            ORACLE[name] = oracle
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates, times and arrays as text, small integers as integers, for comparison with other engines."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.concat_ws("|", column)
        elif isinstance(field.dataType, (T.ByteType, T.ShortType)):
            column = column.cast("int")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def work_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Versions, retention, quality.

VERSIONED = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, "
    "CAST(epoch(l_shipdate) AS BIGINT) AS version FROM lineitem"
)


def _versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        version_stamp(F.col("l_shipdate")).alias("version"),
    )


@query(
    "latest_version",
    f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
    f"version DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM ({VERSIONED})) WHERE rn = 1",
)
def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_version(_versioned(spark, sf_dir), ["l_orderkey", "l_linenumber"])


@query(
    "latest_version_ties",
    f"SELECT * FROM ({VERSIONED}) JOIN (SELECT l_orderkey, l_linenumber, max(version) AS version "
    f"FROM ({VERSIONED}) GROUP BY 1, 2) USING (l_orderkey, l_linenumber, version)",
)
def _latest_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_version(_versioned(spark, sf_dir), ["l_orderkey", "l_linenumber"], ties="all")


def _expired(days: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
        return plain(expire(orders, "o_orderdate", days, AS_OF))

    return run


for _name, _days in (("expire_raw_180", RAW_DAYS), ("expire_mart_365", MART_DAYS)):
    query(
        _name,
        f"SELECT o_orderkey, {sql.text('o_orderdate')} AS o_orderdate FROM orders "
        f"WHERE o_orderdate > {sql.NOW} - INTERVAL {_days} DAY",
    )(_expired(_days))


@query(
    "version_stamp",
    "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS version FROM orders",
)
def _version_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", version_stamp(F.col("o_orderdate")).alias("version"))


@query(
    "load_month_partitions",
    "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y%m') AS load_month FROM orders "
    "WHERE o_orderdate >= timestamp '2000-06-01 00:00:00'",
)
def _by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    path = work_dir(spark, "orders-by-month")
    write_by_month(orders, path, mode="overwrite", ts="o_orderdate")
    return read_by_month(spark, path, since="200006").drop("o_orderdate")


@query(
    "expire_stored",
    f"SELECT o_orderkey, {sql.text('o_orderdate')} AS o_orderdate, strftime(o_orderdate, '%Y%m') AS load_month FROM orders "
    f"WHERE o_orderdate > {sql.NOW} - INTERVAL {MART_DAYS} DAY",
)
def _expire_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by month whose old months are dropped and whose border month is rewritten; a second run finds nothing."""
    path = work_dir(spark, "orders-to-expire")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    write_by_month(orders, path, mode="overwrite", ts="o_orderdate")
    for _ in range(2):
        expire_stored(spark, path, MART_DAYS, AS_OF, ts="o_orderdate")
    return plain(read_by_month(spark, path))


@query(
    "quality_gate",
    "SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_mktsegment IN ('', 'BUILDING') THEN "
    "'segment is not served' END, CASE WHEN NOT c_acctbal > 0 THEN 'balance is not positive' END, "
    "CASE WHEN NOT c_nationkey < 20 THEN 'nation is unknown' END], lambda x: x IS NOT NULL), '|') AS reasons "
    "FROM customer",
)
def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "segment is not served": ~F.col("c_mktsegment").isin("", "BUILDING"),
        "balance is not positive": F.col("c_acctbal") > 0,
        "nation is unknown": F.col("c_nationkey") < 20,
    }
    judged = with_reasons(table(spark, sf_dir, "customer"), rules)
    return plain(judged.select("c_custkey", F.col(REASONS).alias("reasons")))


@query(
    "rejected_customers",
    sql.with_raw(
        "SELECT customer_id, array_to_string(list_filter(["
        "CASE WHEN customer_id = '' THEN 'customer_id is empty' END, "
        "CASE WHEN first_name = '' THEN 'first_name is empty' END, "
        "CASE WHEN last_name = '' THEN 'last_name is empty' END, "
        f"CASE WHEN birth_date > {sql.DAY} THEN 'birth_date is in the future' END, "
        "CASE WHEN birth_date <= date '1900-01-01' THEN 'birth_date is not after 1900-01-01' END, "
        f"CASE WHEN registration_date > {sql.NOW} THEN 'registration_date is in the future' END"
        "], lambda x: x IS NOT NULL), '|') AS reasons FROM raw_customers WHERE customer_id = '' OR first_name = '' "
        f"OR last_name = '' OR birth_date > {sql.DAY} OR birth_date <= date '1900-01-01' "
        f"OR registration_date > {sql.NOW}"
    ),
)
def _rejected_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = documents_to_raw({"customers": documents(spark, sf_dir)["customers"]})
    rejects = mart_rejects("customers_details", raw, CONTEXT)["raw_customers"]
    return plain(rejects.select("customer_id", F.col(REASONS).alias("reasons")))


DUPLICATE_KEYS = {
    "lineitem": ["l_orderkey", "l_linenumber"],
    "orders": ["o_orderkey"],
    "events": ["user_id", "event_type"],
    "customer": ["c_custkey"],
}


@query(
    "duplicate_ratio",
    "SELECT *, duplicate_percent > 50 AS alert FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS total_rows, count(*) AS distinct_keys, "
        f"round((1 - CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM {name})) * 100, 4) AS duplicate_percent "
        f"FROM (SELECT DISTINCT {', '.join(keys)} FROM {name})"
        for name, keys in DUPLICATE_KEYS.items()
    )
    + ")",
)
def _duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_ratio({name: (table(spark, sf_dir, name), keys) for name, keys in DUPLICATE_KEYS.items()})


COUNTED = ("customer", "orders", "lineitem", "part", "supplier", "events")


@query(
    "dataset_stats",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS total_documents, count(*) = 0 AS is_empty FROM {name}"
        for name in COUNTED
    ),
)
def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_stats(spark, {name: table(spark, sf_dir, name) for name in COUNTED}).drop("error")


@query(
    "layer_counts",
    sql.with_raw(
        " UNION ALL ".join(
            f"SELECT '{name}' AS name, count(*) AS total_documents, count(*) = 0 AS is_empty FROM {name}"
            for name in sql.RAW_OUTPUT
        )
    ),
)
def _layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_stats(spark, documents_to_raw(documents(spark, sf_dir))).drop("error")


SAMPLED = {
    "products": ("id", "concat('PRD-', lpad(p_partkey::VARCHAR, 7, '0'))", "part"),
    "customers": ("customer_id", "upper(c_name)", "customer"),
    "stores": ("store_id", "s_name", "supplier"),
    "purchases": ("purchase_id", "concat('ORD-', l_orderkey, '-', l_linenumber)", "lineitem JOIN orders ON l_orderkey = o_orderkey"),
}


@query(
    "sample_documents",
    " UNION ALL ".join(
        f"(SELECT '{name}' AS name, k AS key FROM (SELECT {key} AS k FROM {rows}) ORDER BY md5(k) LIMIT 3)"
        for name, (_, key, rows) in SAMPLED.items()
    ),
)
def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = sample_documents(documents(spark, sf_dir), 3, {name: [column] for name, (column, _, _) in SAMPLED.items()})
    key = F.coalesce(*(F.get_json_object("document", f"$.{column}") for column, _, _ in SAMPLED.values()))
    return samples.select("name", key.alias("key"))


# Cleaning expressions.


@query(
    "safe_casts",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE value END AS as_float, "
    "CAST(trunc(value) AS INTEGER) AS as_int, CASE WHEN event_type = 'view' THEN -1 ELSE CAST(user_id AS INTEGER) END "
    "AS whole_int, event_type IN ('click', 'signup', 'view') AS as_bool, user_id <> 0 AS number_bool, "
    "CAST(json_extract(props, '$.k') AS BIGINT) AS parsed FROM events",
)
def _safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        safe_float(F.expr("if(event_type = 'error', 'n/a', concat(' ', value, ' '))")).alias("as_float"),
        safe_int(F.expr("cast(value AS string)")).alias("as_int"),
        safe_int(F.expr("if(event_type = 'view', '1e3', cast(user_id AS string))"), -1).alias("whole_int"),
        safe_bool(
            F.expr("CASE event_type WHEN 'click' THEN 'ДА' WHEN 'signup' THEN 'Yes' WHEN 'view' THEN '1' "
                   "WHEN 'error' THEN '2' ELSE NULL END")
        ).alias("as_bool"),
        safe_number_bool(F.col("user_id")).alias("number_bool"),
        safe_json(F.col("props"), "k bigint")["k"].alias("parsed"),
    )


@query(
    "parse_dates",
    f"SELECT event_id, CASE event_type WHEN 'signup' THEN {sql.text(f'CAST(CAST(ts AS DATE) AS TIMESTAMP)')} "
    f"WHEN 'error' THEN '2001-08-01 00:00:00' WHEN 'view' THEN {sql.text('ts - INTERVAL 3 HOUR')} "
    f"ELSE {sql.text('ts')} END AS instant, CASE event_type WHEN 'error' THEN '1970-01-01' "
    "ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS day FROM events",
)
def _parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.expr(
        "CASE event_type WHEN 'click' THEN date_format(ts, \"yyyy-MM-dd't'HH:mm:ss'z'\") "
        "WHEN 'view' THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+03:00'\") "
        "WHEN 'purchase' THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') "
        "WHEN 'signup' THEN date_format(ts, 'yyyy-MM-dd') ELSE 'soon' END"
    )
    events = table(spark, sf_dir, "events").withColumn("written", written)
    day = F.concat(F.lit(" "), F.regexp_replace("written", "[tT ].*", "T12:00"), F.lit(" "))
    return plain(
        events.select(
            "event_id",
            parse_ts_utc(F.col("written"), datetime(2001, 8, 1, tzinfo=timezone.utc)).alias("instant"),
            parse_date(F.when(F.col("written") == "soon", "soon").otherwise(day)).alias("day"),
        )
    )


@query(
    "phone_email_mask",
    f"SELECT c_custkey, '+7900' || {sql.padded('c_custkey', 7)} AS phone, lower(c_name) || '@mail.ru' AS email, "
    f"sha256('+7900' || {sql.padded('c_custkey', 7)}) AS phone_hash, "
    "CASE WHEN c_acctbal < 0 THEN '' ELSE sha256(lower(c_name) || '@mail.ru') END AS email_hash FROM customer",
)
def _masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    phone = F.expr("concat('8 (900) ', lpad(c_custkey, 7, '0'))")
    email = F.expr("concat('  ', c_name, '@Mail.RU ')")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        normalize_phone(phone).alias("phone"),
        normalize_email(email).alias("email"),
        sha256_hex(normalize_phone(phone)).alias("phone_hash"),
        sha256_hex(F.when(F.col("c_acctbal") < 0, "").otherwise(normalize_email(email))).alias("email_hash"),
    )


@query(
    "mask_pii_nested",
    "SELECT c_custkey, c_name, sha256('+7' || c_custkey || '1') AS home, "
    "CASE WHEN c_nationkey = 3 THEN NULL ELSE sha256('+7' || c_custkey || '2') END AS last_phone, "
    "sha256(lower(c_name)) AS email, c_mktsegment AS note FROM customer",
)
def _mask_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "c_name",
        "named_struct('PhoneNumbers', array(concat('8', c_custkey, '1'), if(c_nationkey = 3, NULL, "
        "concat('8-', c_custkey, '-2'))), 'contacts', array(named_struct('work_email', concat(' ', c_name, ' '), "
        "'note', c_mktsegment))) AS person",
    )
    return mask_pii(nested).select(
        "c_custkey",
        "c_name",
        F.col("person.PhoneNumbers")[0].alias("home"),
        F.col("person.PhoneNumbers")[1].alias("last_phone"),
        F.col("person.contacts")[0]["work_email"].alias("email"),
        F.col("person.contacts")[0]["note"].alias("note"),
    )


@query(
    "clean_category",
    f"SELECT p_partkey, {sql.clean('grp')} AS category FROM (SELECT p_partkey, concat({sql.GROUP}, '  ') AS grp FROM part)",
)
def _clean_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        clean_category(F.concat(F.expr(GROUP_OF_TYPE.format("p_type")), F.lit("  "))).alias("category"),
    )


@query(
    "code_map",
    sql.with_raw(
        f"SELECT customer_id, {sql.code('gender', sql.GENDERS)} AS gender_id, "
        f"{sql.code('preferred_payment_method', sql.METHODS)} AS payment_method_id FROM raw_customers"
    ),
)
def _code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir)["customers"].select(
        "customer_id",
        code_map(F.col("gender"), GENDER_CODES).alias("gender_id"),
        code_map(F.col("preferences.preferred_payment_method"), PAYMENT_CODES).alias("payment_method_id"),
    )


@query(
    "surrogate_key",
    f"SELECT c_custkey, {sql.key('lower(c_name)', 'lower(c_mktsegment)')} AS pair_key, "
    f"CASE WHEN c_acctbal > 0 THEN {sql.key('lower(c_name)')} ELSE '0' END AS optional_key, "
    f"{sql.key('coalesce(CASE WHEN c_nationkey = 1 THEN NULL ELSE c_name END, {0})'.format(chr(39) * 2), 'c_mktsegment')} "
    "AS gap_key FROM customer",
)
def _surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = CONTEXT.keys
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        keys.key(F.lower("c_name"), F.lower("c_mktsegment")).alias("pair_key"),
        keys.key_if(F.col("c_acctbal") > 0, F.lower("c_name")).alias("optional_key"),
        keys.key(F.when(F.col("c_nationkey") != 1, F.col("c_name")), F.col("c_mktsegment")).alias("gap_key"),
    )


@query(
    "normalize_unsigned",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS signed_key FROM orders",
)
def _unsigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "cast(if(o_orderkey % 2 = 0, 18446744073709551615BD - o_orderkey, cast(o_orderkey AS decimal(20, 0))) "
        "AS decimal(20, 0)) AS signed_key",
    )
    return normalize_unsigned(wide)


# Raw layer.


def _raw(name: str) -> Query:
    topic = name.removeprefix("raw_")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(documents_to_raw({topic: documents(spark, sf_dir)[topic]})[name])

    return run


for _name, _sql in sql.RAW_OUTPUT.items():
    query(_name, sql.with_raw(_sql))(_raw(_name))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as messages, with one message of an unknown topic and one broken value per nation."""
    frames = documents(spark, sf_dir)
    messages = None
    for topic, df in frames.items():
        part = publish(df, topic, F.lit("2001-08-01 00:00:00").cast("timestamp"))
        messages = part if messages is None else messages.unionByName(part)
    nation = table(spark, sf_dir, "nation")
    unknown = nation.select(F.lit("returns").alias("topic"), F.to_json(F.struct("n_name")).alias("value"))
    broken = nation.select(F.lit("products").alias("topic"), F.concat(F.lit('{"id": '), "n_name").alias("value"))
    return messages.unionByName(unknown).unionByName(broken)


@query(
    "publish_messages",
    sql.with_raw(
        "SELECT 'customers' AS topic, customer_id AS id, email, phone FROM raw_customers UNION ALL "
        "SELECT 'stores', store_id, manager_email, manager_phone FROM raw_stores"
    ),
)
def _publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = documents(spark, sf_dir)

    def field(path: str) -> F.Column:
        return F.get_json_object("value", path)

    customers = publish(frames["customers"], "customers").select(
        "topic", field("$.customer_id").alias("id"), field("$.email").alias("email"), field("$.phone").alias("phone")
    )
    stores = publish(frames["stores"], "stores").select(
        "topic",
        field("$.store_id").alias("id"),
        field("$.manager.email").alias("email"),
        field("$.manager.phone").alias("phone"),
    )
    return customers.unionByName(stores)


@query(
    "publish_unknown_fields",
    "SELECT c_custkey, lower(c_name) AS id, sha256('+7' || c_custkey || '1') AS phone, sha256('+7' || c_custkey || '2') AS other, "
    "sha256(lower(c_name)) AS email, c_mktsegment AS note, '{\"deep\":[[{\"n\":' || c_nationkey || '}],null]}' AS rest, "
    "CASE WHEN c_nationkey % 2 = 0 THEN sha256('7900' || c_custkey) ELSE '' END AS whole, "
    "'2001-08-01T00:00:00.000000' AS sent FROM customer WHERE c_nationkey <> 3 "
    "UNION ALL SELECT NULL, '', '', '', '', '', '{\"unreadable\": ' || c_name, '', '' FROM customer WHERE c_nationkey = 3",
)
def _publish_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as text with fields that no schema names: phones and e-mails masked at any depth, the rest unchanged."""
    documents_ = spread(table(spark, sf_dir, "customer"), "c_custkey").selectExpr(
        "if(c_nationkey = 3, concat('{\"unreadable\": ', c_name), to_json(named_struct('_id', c_name, 'key', c_custkey, "
        "'extra', named_struct('Contact Phones', array(concat('8-', c_custkey, '-1'), concat('+7', c_custkey, '2')), "
        "'people', array(named_struct('WorkEmail', concat(' ', c_name, ' '), 'note', c_mktsegment)), "
        "'rest', named_struct('deep', array(array(named_struct('n', c_nationkey)), NULL)), "
        "'home_phone', if(c_nationkey % 2 = 0, cast(concat('7900', c_custkey) AS bigint), 0L))), "
        "map('ignoreNullFields', 'false'))) AS value"
    )
    messages = publish_texts(documents_, "customers", F.lit("2001-08-01").cast("timestamp"))

    def field(path: str) -> F.Column:
        return F.get_json_object("value", path)

    sent = published(messages).select(
        field("$.key").cast("bigint").alias("c_custkey"),
        field("$._id").alias("id"),
        field("$.extra['Contact Phones'][0]").alias("phone"),
        field("$.extra['Contact Phones'][1]").alias("other"),
        field("$.extra.people[0].WorkEmail").alias("email"),
        field("$.extra.people[0].note").alias("note"),
        field("$.extra.rest").alias("rest"),
        F.regexp_replace(field("$.extra.home_phone"), "^0$", "").alias("whole"),
        field("$.kafka_send_date").alias("sent"),
    )
    none = {name: F.lit("") for name in ("id", "phone", "other", "email", "note", "whole", "sent")}
    lost = unpublished(messages).withColumns({**none, "c_custkey": F.lit(None).cast("bigint"), "rest": F.col("value")})
    return sent.unionByName(lost.select(*sent.columns))


ROUTED = " UNION ALL ".join(
    f"SELECT '{name}' AS target, '' AS reason, count(*) AS n FROM {name}" for name in sql.RAW_OUTPUT
) + (
    " UNION ALL SELECT 'rejected', 'unknown topic', count(*) FROM nation"
    " UNION ALL SELECT 'rejected', 'unreadable JSON', count(*) FROM nation"
)


def _routed_counts(tables: dict[str, DataFrame], rejected: DataFrame) -> DataFrame:
    counts = rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("rejected").alias("target"), "reason", "n"
    )
    for name, df in tables.items():
        counts = counts.unionByName(
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("target"), F.lit("").alias("reason"), "n")
        )
    return counts


@query("route_topics", sql.with_raw(ROUTED))
def _route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_outcomes(route(_messages(spark, sf_dir)))


@query("read_documents", sql.with_raw(sql.RAW_OUTPUT["raw_customers"]))
def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "customer-documents")
    documents(spark, sf_dir)["customers"].write.json(folder)
    read = read_documents(spark, folder, "customers", one_per_file=False)
    return plain(documents_to_raw({"customers": read.good})["raw_customers"])


# Mart.


def _mart(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(mart_table(name, documents_to_raw(documents(spark, sf_dir)), CONTEXT))

    return run


for _name in DIMENSIONS:
    query(_name, sql.with_raw(sql.stamped(sql.dim_rows(_name))))(_mart(_name))
for _name in DETAILS:
    query(_name, sql.with_raw(sql.stamped(sql.detail_rows(_name))))(_mart(_name))


def _projection_sql(name: str) -> str:
    rows = sql.dim_rows(name) if name in DIMENSIONS else sql.detail_rows(name)
    columns = ", ".join(f"{column} AS {alias}" for column, alias in PROJECTIONS[name].items())
    return f"SELECT {columns} FROM ({sql.stamped(rows)})"


def _projected(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        mart = mart_table(name, documents_to_raw(documents(spark, sf_dir)), CONTEXT)
        return plain(project_mart(mart, name))

    return run


for _name in PROJECTIONS:
    query(f"read_{_name}", sql.with_raw(_projection_sql(_name)))(_projected(_name))


# Features.


@query(
    "prepare_purchases",
    sql.with_mart(
        "SELECT purchase_pk, customer_pk, store_pk, delivery_address_id, delivery_city_id, total_amount, "
        f"payment_method_name, is_delivery, {sql.text('purchase_datetime')} AS purchase_datetime, "
        "CAST(CAST(purchase_datetime AS DATE) AS VARCHAR) AS purchase_date, "
        "CAST(extract(hour FROM purchase_datetime) AS INTEGER) AS purchase_hour, dayname(purchase_datetime) AS weekday "
        "FROM purchases"
    ),
)
def _prepare_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = mart_inputs(spark, sf_dir)
    return plain(prepare_purchases(inputs.purchases, inputs.delivery_addresses, inputs.payment_methods))


@query(
    "prepare_customers",
    sql.with_mart(
        "SELECT customer_pk, customer_id, CAST(reg_date AS VARCHAR) AS reg_date, is_loyalty_member FROM customers"
    ),
)
def _prepare_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(prepare_customers(mart_inputs(spark, sf_dir).customers))


@query("prepare_products", sql.with_mart("SELECT * FROM products"))
def _prepare_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = mart_inputs(spark, sf_dir)
    return prepare_products(inputs.products, inputs.categories)


@query("prepare_stores", sql.with_mart("SELECT * FROM stores"))
def _prepare_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = mart_inputs(spark, sf_dir)
    return prepare_stores(inputs.stores, inputs.addresses)


@query("prepare_items", sql.with_mart("SELECT * FROM items"))
def _prepare_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_items(mart_inputs(spark, sf_dir).items)


@query("cast_to_schema", "SELECT c_name AS name, CAST(c_nationkey AS BIGINT) AS nation FROM customer")
def _cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType().add("name", T.StringType()).add("nation", T.LongType())
    renamed = table(spark, sf_dir, "customer").selectExpr("c_nationkey AS nation", "c_name AS name", "c_acctbal")
    return cast_to_schema(renamed, schema)


def _flag(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return feature_matrix(mart_inputs(spark, sf_dir), AS_OF, SPEC, [name])

    return run


for _name in FLAG_NAMES:
    query(f"f_{_name}", sql.with_mart(f"SELECT customer_id, {_name} FROM matrix", sql.matrix(SPEC)))(_flag(_name))


@query("feature_matrix", sql.with_mart("SELECT * FROM matrix", sql.matrix(SPEC)))
def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_matrix(mart_inputs(spark, sf_dir), AS_OF, SPEC)


@query("feature_matrix_bucketed", sql.with_mart("SELECT * FROM matrix", sql.matrix(SPEC)))
def _matrix_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases and items written in buckets of the purchase, then read without a shuffle up to the customers."""
    inputs, mark = mart_inputs(spark, sf_dir), uuid.uuid4().hex
    tables = [
        write_buckets(df, f"{name}_{mark}", work_dir(spark, name), "purchase_pk", 8)
        for name, df in (("purchases", inputs.purchases), ("items", inputs.items))
    ]
    return feature_matrix(by_purchase(inputs, *tables), AS_OF, SPEC)


# A catalogue in which nearly every product has a category of its own.

LARGE_SPEC = replace(SPEC, varied_categories=30, milk_category="red plate", fruit_category="cold ring")
LARGE_MART = sql.MART.replace(
    "CASE WHEN p_type = 'PROMO' THEN 'Без категории' ELSE lower(p_type) END",
    "CASE WHEN p_size % 5 = 0 THEN lower(p_name) ELSE concat_ws(' ', p_name, p_brand, p_partkey) END",
)


@query("feature_matrix_large_catalogue", f"WITH {LARGE_MART}, {sql.matrix(LARGE_SPEC)} SELECT * FROM matrix")
def _matrix_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue of any size takes the same way."""
    inputs = mart_inputs(spark, sf_dir)
    name = F.expr("if(p_size % 5 = 0, lower(p_name), concat_ws(' ', p_name, p_brand, p_partkey))")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_pk"), name.alias("category_id"))
    products = inputs.products.drop("category_id").join(part, "product_pk")
    categories = part.select("category_id", F.col("category_id").alias("category_name"), F.lit(1).cast("long").alias("version"))
    return feature_matrix(replace(inputs, products=products, categories=categories.distinct()), AS_OF, LARGE_SPEC)


BY_DAY = (date(2001, 8, 1), date(2001, 7, 15), date(2001, 6, 1))
DAILY_SPEC = replace(SPEC, week_days=30, short_days=45, month_days=60, quarter_days=120, recurrent_over=0)


@query(
    "feature_matrix_by_day",
    sql.with_mart(
        " UNION ALL ".join(
            f"SELECT '{day}' AS as_of, * FROM (WITH {sql.matrix(DAILY_SPEC, f"date '{day}'")} SELECT * FROM matrix)" for day in BY_DAY
        )
    ),
)
def _matrix_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store built of the purchases up to June, refreshed with July and with the first of August, asked for three days."""
    inputs = mart_inputs(spark, sf_dir)
    store = DayStore(spark, work_dir(spark, "days"), DAILY_SPEC)
    store.build(replace(inputs, purchases=inputs.purchases.filter("purchase_datetime < '2001-07-01'")), date(2001, 1, 1))
    store.refresh(inputs, date(2001, 7, 1), date(2001, 7, 31))
    store.roll_up(date(2001, 2, 1))
    store.refresh(inputs, date(2001, 8, 1), date(2001, 8, 1))
    matrices = [
        store.matrix(inputs.customers, day).select(F.lit(str(day)).alias("as_of"), "*") for day in BY_DAY
    ]
    return reduce(DataFrame.unionByName, matrices)


@query(
    "duplicate_customers",
    "SELECT c_mktsegment AS customer_id, count(*) AS \"rows\" FROM customer GROUP BY 1 HAVING count(*) > 1",
)
def _duplicate_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_customers(table(spark, sf_dir, "customer").selectExpr("c_mktsegment AS customer_id"))


@query("export_csv", sql.with_mart("SELECT * FROM matrix", sql.matrix(SPEC)))
def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = feature_matrix(mart_inputs(spark, sf_dir), AS_OF, SPEC)
    path = export_csv(matrix, work_dir(spark, "export"), AS_OF)
    return spark.read.option("header", True).schema(matrix.schema).csv(path)


# The layers together: from documents to flags.

FROM_DOCUMENTS = f"""
pd AS {sql.latest("(" + sql.stamped(sql.detail_rows("purchases_details")) + ")", "purchase_pk", "version DESC, load_date DESC, purchase_id DESC, customer_pk DESC, store_pk DESC, delivery_address_id DESC, total_amount DESC, payment_method_id DESC, is_delivery DESC, purchase_datetime DESC")},
customers AS (SELECT customer_pk, customer_id, CAST(registration_date AS DATE) AS reg_date, is_loyalty_member
  FROM {sql.detail_rows("customers_details")}),
purchases AS (SELECT purchase_pk, customer_pk, store_pk, c.city_id AS delivery_city_id, total_amount,
    CASE payment_method_id WHEN 1 THEN 'card' WHEN 2 THEN 'cash' WHEN 3 THEN 'online' ELSE 'barter' END
      AS payment_method_name, is_delivery, CAST(purchase_datetime AS TIMESTAMP) AS purchase_datetime
  FROM pd LEFT JOIN {sql.dim_rows("dim_delivery_addresses")} c USING (delivery_address_id)),
products AS (SELECT product_pk, name AS product_name, coalesce(clear_category_name, 'Без категории')
    AS category_name, is_organic
  FROM {sql.detail_rows("products_details")} LEFT JOIN {sql.dim_rows("dim_categories")} USING (category_id)),
stores AS (SELECT store_pk, coalesce(a.city_id, '-1') AS store_city_id
  FROM {sql.detail_rows("stores_details")} s LEFT JOIN {sql.dim_rows("dim_address")} a ON location_id = address_id),
items AS {sql.latest("(" + sql.stamped(sql.detail_rows("purchase_item_details")) + ")", "item_pk", "version DESC, purchase_pk DESC, product_pk DESC, quantity DESC, total_price DESC", "item_pk, purchase_pk, product_pk")}
"""

STORY_SPEC = FeatureSpec(
    week_days=90,
    short_days=180,
    month_days=365,
    quarter_days=730,
    bulk_over=60000,
    low_cost_under=45000,
    loyal_purchases=30,
    recurrent_over=4,
    high_spend_over=100000,
    family_items=1.9,
    varied_categories=6,
)


def _story_inputs(spark: SparkSession, sf_dir: str) -> MartInputs:
    mart = raw_to_mart(documents_to_raw(documents(spark, sf_dir)), CONTEXT)
    return items_by_purchase(hex_keys_as_bytes(MartInputs.read(mart_reader(mart))))


@query("customer_360", sql.with_raw("SELECT * FROM matrix", FROM_DOCUMENTS, sql.matrix(STORY_SPEC)))
def _story(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_matrix(_story_inputs(spark, sf_dir), AS_OF, STORY_SPEC)


# Streams.


@query("stream_ingest", sql.with_raw(ROUTED))
def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = work_dir(spark, "stream-ingest")
    write_topic_folder(_messages(spark, sf_dir), f"{work}/topics")
    messages = subscribe_folder(spark, f"{work}/topics", max_files=8)
    ingest_stream(messages, f"{work}/raw", f"{work}/checkpoint").awaitTermination()
    tables = {name: spark.read.parquet(f"{work}/raw/{name}") for name in RAW_SCHEMAS}
    return _routed_counts(tables, spark.read.parquet(f"{work}/raw/{REJECTS}"))


@query(
    "incremental_mart",
    sql.with_raw(
        " UNION ALL ".join(
            f"SELECT '{name}' AS target, count(DISTINCT {pk}) AS n FROM "
            f"{sql.dim_rows(name) if name in DIMENSIONS else sql.detail_rows(name)}"
            for name, pk in MART_KEYS.items()
        )
    ),
)
def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables on disk, followed by one stream each into the mart; rows per table in their last version."""
    work = work_dir(spark, "incremental-mart")
    for name, df in documents_to_raw(documents(spark, sf_dir)).items():
        write_by_month(df, f"{work}/raw/{name}", mode="overwrite")
    streams = [
        mart_stream(raw, name, f"{work}/mart", f"{work}/checkpoint", CONTEXT)
        for name, raw in raw_streams(spark, f"{work}/raw", RAW_SCHEMAS).items()
    ]
    for stream in streams:
        stream.awaitTermination()
    read = live_mart_reader(spark, f"{work}/mart")
    counts = dataset_stats(spark, {name: read(name) for name in MART_KEYS})
    return counts.select(F.col("name").alias("target"), F.col("total_documents").alias("n"))


LAST_PURCHASES = sql.latest(
    "(" + sql.stamped(sql.detail_rows("purchases_details")) + ")",
    "purchase_pk",
    "version DESC, purchase_id DESC, customer_pk DESC, store_pk DESC, delivery_address_id DESC, total_amount DESC, "
    "payment_method_id DESC, is_delivery DESC, purchase_datetime DESC, load_date DESC",
    "* EXCLUDE (rn)",
)


@query(
    "mart_by_state",
    sql.with_raw(
        f"SELECT * FROM {LAST_PURCHASES} WHERE load_date > "
        f"(SELECT strftime(max(CAST(load_date AS TIMESTAMP)) - INTERVAL {MART_DAYS} DAY, '%Y-%m-%d %H:%M:%S') FROM {LAST_PURCHASES})"
    ),
)
def _by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart stream's purchases through keyed state, delivered twice: the last version of each that has not expired."""
    work = work_dir(spark, "mart-by-state")
    raw = documents_to_raw({"purchases": documents(spark, sf_dir)["purchases"]})["raw_purchases"]
    for _ in range(2):
        write_by_month(raw, f"{work}/raw/raw_purchases")
        source = raw_streams(spark, f"{work}/raw", {"raw_purchases": RAW_SCHEMAS["raw_purchases"]})["raw_purchases"]
        mart_stream(source, "raw_purchases", f"{work}/mart", f"{work}/checkpoint", CONTEXT).awaitTermination()
        mart_changes(
            spark, f"{work}/mart", "purchases_details", f"{work}/changes", f"{work}/checkpoint/changes"
        ).awaitTermination()
    return plain(current_mart(spark, "purchases_details", f"{work}/changes"))


@query("stream_drop_replays", "SELECT event_id, user_id, event_type FROM events")
def _replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice; each is kept once."""
    work = work_dir(spark, "replays")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.unionByName(events).write.parquet(f"{work}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{work}/in")
    kept = drop_replays(stream, ["event_id"], "ts", "40 days").select("event_id", "user_id", "event_type")
    kept.writeStream.format("parquet").option("path", f"{work}/out").option(
        "checkpointLocation", f"{work}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{work}/out")
