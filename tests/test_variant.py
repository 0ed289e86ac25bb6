"""Masking of JSON of any shape against a recursive walk in plain Python."""

from __future__ import annotations

import hashlib
import json
import random
import re

from pyspark.sql import functions as F

from basketry.functions.variant import MOST_DEPTH, deeper_than, mask_json
from basketry.plans.raw import parse_messages, split_messages
from basketry.sources.topics import publish, publish_texts, published, unpublished
from conftest import rows


def masked(value, name=""):
    if isinstance(value, dict):
        return {key: masked(part, key) for key, part in value.items()}
    if isinstance(value, list):
        return [masked(part, name) for part in value]
    if not value or not ("phone" in name.lower() or "email" in name.lower()):
        return value
    text = str(value)
    if "phone" in name.lower():
        text = re.sub(r"[^\d+]", "", text)
        text = "+7" + text[1:] if text.startswith("8") else text
    else:
        text = text.strip().lower()
    return hashlib.sha256(text.encode()).hexdigest() if text else text


def made(random_, depth):
    kind = random_.randrange(10 if depth else 6)
    if kind < 6:
        return random_.choice([None, True, False, 0, 7, 89001234567, 1.5, "", " 8 (900) 1 ", "A@B.ru ", "é\"\\{[", "ключ"])
    if kind < 8:
        return [made(random_, depth - 1) for _ in range(random_.randrange(4))]
    names = ["a", "Phone", "work_email", "PHONES", "email list", "", "_id", "ё", "name"]
    return {name: made(random_, depth - 1) for name in random_.sample(names, random_.randrange(6))}


def test_masking_equals_a_recursive_walk(spark):
    random_ = random.Random(7)
    documents = [{"x": made(random_, 5), "phones": made(random_, 4), "email": made(random_, 2)} for _ in range(300)]
    documents += [[], {}, "text", 5, [[{"phone": ["8"]}]]]
    df = spark.createDataFrame([(k, json.dumps(d, ensure_ascii=k % 2 == 0)) for k, d in enumerate(documents)], "k int, value string")
    for k, text in df.select("k", mask_json(F.col("value"))).collect():
        assert json.loads(text) == masked(documents[k]), documents[k]


def test_depth_is_a_limit_and_nothing_is_half_masked(spark):
    def nested(depth, inner='{"phone":"8"}'):
        return '{"a":' * (depth - 1) + inner + "}" * (depth - 1)

    texts = [nested(MOST_DEPTH), nested(MOST_DEPTH + 1), nested(40), '{"s":"[[[[[[[[[[[[[[[[{{{{"}', "[" * 9 + "]" * 9, "{", None, "[" + "{}," * 99 + "[]]"]
    df = spark.createDataFrame([(k, text) for k, text in enumerate(texts)], "k int, value string")
    found = dict(df.select("k", mask_json(F.col("value"))).collect())
    assert '"8"' not in found[0] and found[0].count("{") == MOST_DEPTH
    assert found[1] is None and found[2] is None and found[5] is None and found[6] is None
    assert json.loads(found[3]) == json.loads(texts[3]) and found[4] == texts[4]
    assert json.loads(found[7]) == json.loads(texts[7])
    assert dict(df.select("k", deeper_than(F.col("value"), 9)).collect())[4] is False


def test_texts_and_schemas_publish_the_same(spark):
    schema = "_id string, customer_id string, email string, phone string, preferences struct<preferred_language: string>"
    document = ("ABC", "c-1", " Ann@Mail.ru", "8 (900) 1", ("RU",))
    typed = spark.createDataFrame([document], schema)
    sent = F.lit("2025-08-01 10:00:00").cast("timestamp")
    by_schema = publish(typed, "customers", sent)
    by_text = publish_texts(typed.select(F.to_json(F.struct("*")).alias("value")), "customers", sent)
    ((_, one),), ((_, other),) = rows(by_schema), rows(published(by_text))
    assert json.loads(one) == json.loads(other)
    # the raw layer reads both alike
    for messages in (by_schema, published(by_text)):
        good, bad = split_messages(parse_messages(messages, "customers"), "customers", sent)
        assert good.count() == 1 and bad.count() == 0
    # products are not masked
    plain = publish_texts(spark.createDataFrame([('{"phone":"8"}',)], "value string"), "products", sent)
    assert json.loads(published(plain).first().value)["phone"] == "8"


def test_texts_that_are_no_documents_are_kept_aside(spark):
    texts = ['{"_id": "X"}', "{", "[1]", '"text"', "null", None, "", "7"]
    messages = publish_texts(spark.createDataFrame([(text,) for text in texts], "value string"), "customers")
    assert [json.loads(row.value)["_id"] for row in published(messages).collect()] == ["x"]
    assert sorted(row.value or "" for row in unpublished(messages).collect()) == sorted(text or "" for text in texts[1:])


def test_documents_without_an_id_or_with_another(spark):
    texts = ['{"a": 1}', '{"_id": {"$oid": "AB"}}', '{"_id": null, "kafka_send_date": "old"}']
    sent = F.lit("2025-08-01").cast("timestamp")
    messages = publish_texts(spark.createDataFrame([(text,) for text in texts], "value string"), "stores", sent)
    found = [json.loads(row.value) for row in published(messages).collect()]
    assert found[0] == {"a": 1, "kafka_send_date": "2025-08-01T00:00:00.000000"}
    assert found[1]["_id"] == '{"$oid":"ab"}'.lower() and found[2]["_id"] is None
    assert found[2]["kafka_send_date"] == "2025-08-01T00:00:00.000000"


def test_what_is_readable_is_found_without_masking(spark):
    texts = [('{"_id":"X","phone":"8"}',), ("{bad",), ("null",), ("[1]",), (None,)]
    messages = publish_texts(spark.createDataFrame(texts, "value string"), "customers")

    def masks(df):
        return df._jdf.queryExecution().executedPlan().toString().count("transform(map_entries(")

    # once, though a filter comes before it
    assert masks(published(messages)) == masks(messages.select("value")) > 0
    assert masks(unpublished(messages)) == 0
    assert [json.loads(row.value)["_id"] for row in published(messages).collect()] == ["x"]
    assert sorted(row.value or "" for row in unpublished(messages).collect()) == ["", "[1]", "null", "{bad"]
