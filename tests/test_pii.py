from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from basketry.functions import mask_pii, stamp
from conftest import plan_of


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_mask_any_depth(spark):
    schema = (
        "id int, Phone string, note string, manager struct<name:string,email:string>, "
        "people array<struct<home_phone:string,tags:array<string>>>, emails array<string>, "
        "contacts map<string,string>, phone_number bigint"
    )
    row = (1, "8-900", "8-900", ("Ann", " A@B.ru "), [("8 1", ["x"]), (None, None)], ["C@d.ru", None, ""],
           {"work phone": "8 2", "Email": "Q@q.ru", "city": "Omsk"}, 8900)
    masked = mask_pii(spark.createDataFrame([row, (2,) + (None,) * 7], schema)).orderBy("id").collect()
    first, second = masked
    assert first.Phone == digest("+7900") and first.note == "8-900"
    assert first.manager.name == "Ann" and first.manager.email == digest("a@b.ru")
    assert first.people[0].home_phone == digest("+71") and first.people[0].tags == ["x"]
    assert first.people[1].home_phone is None
    assert first.emails == [digest("c@d.ru"), None, ""]
    assert first.contacts == {"work phone": digest("+72"), "Email": digest("q@q.ru"), "city": "Omsk"}
    assert first.phone_number == digest("+7900")
    assert second.manager is None and second.people is None and second.contacts is None


def test_untouched_columns_can_be_pruned(spark):
    df = spark.createDataFrame([("a", "8")], "name string, phone string")
    assert "sha2" not in plan_of(mask_pii(df).select("name")).split("Optimized Logical Plan")[1]


def test_stamp(spark):
    df = spark.createDataFrame([("ABC", 1)], "_id string, x int")
    row = stamp(df, F.lit("2025-01-02 03:04:05").cast("timestamp")).first()
    assert row._id == "abc" and row.kafka_send_date == "2025-01-02T03:04:05.000000"
    assert "_id" not in stamp(df.drop("_id")).columns
