"""Keys in hex that are moved and held as bytes: the same keys, the same choice of the last version."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from basketry.functions.keys import packed_key, unpacked_key
from basketry.operators.versioned import latest_version
from basketry.plans.mart import latest_details
from basketry.streaming.current import changes_stream, current_rows
from basketry.streaming.marts import live_mart_reader
from conftest import plan_of, rows

HEX = [hashlib.sha256(bytes([k])).hexdigest() for k in range(200)]
ODD = ["0", "", "00", "x", "é", HEX[0].upper(), HEX[1][:-1], HEX[1][:-2], f"{HEX[2]}00", "z" * 64, "a" * 32, None]


def test_packed_keys_come_back(spark):
    df = spark.createDataFrame([(k,) for k in [*HEX, *ODD]], "key string")
    df = df.select("key", packed_key(F.col("key")).alias("packed")).localCheckpoint()
    assert df.filter(unpacked_key(F.col("packed")).eqNullSafe(F.col("key"))).count() == df.count()
    found = {row.key: row.packed for row in df.collect()}
    assert {len(found[key]) for key in HEX} == {32} and len(found["0"]) == 1
    assert sorted([*HEX, "0"]) == sorted([*HEX, "0"], key=lambda key: bytes(found[key]))
    assert len({bytes(value) for value in found.values() if value is not None}) == len(found) - 1


def test_live_details_shuffle_keys_as_bytes(spark, tmp_path):
    """The rows of live tables were shuffled with their keys as text of 64 letters."""
    made = [
        (HEX[k % 40] if k % 7 else None, HEX[(k * 5) % 90], "0" if k % 3 else HEX[k % 60], f"n{k % 4}", k % 5, f"2001-01-0{1 + k % 9}")
        for k in range(300)
    ]
    df = spark.createDataFrame(made, "purchase_pk string, customer_pk string, delivery_address_id string, purchase_id string, version long, load_date string")
    df.write.parquet(f"{tmp_path}/purchases_details/source=raw_purchases")
    live = live_mart_reader(spark, str(tmp_path))("purchases_details")
    assert live.schema == df.schema
    assert rows(live) == rows(latest_version(df, ["purchase_pk"])) == rows(latest_details(df, "purchases_details"))
    below = plan_of(live).split("== Physical Plan ==")[1].split("Exchange")[1]
    assert "unhex" in below


def test_state_of_packed_keys_equals_the_batch(spark, tmp_path):
    """Keys in hex are held in the state as bytes; what is passed on has them as text."""
    made = [(HEX[k % 30] if k % 9 else "0", HEX[k * 3 % 70] if k % 5 else None, k * 7 % 4, k % 3) for k in range(200)]
    df = spark.createDataFrame(made, "id string, other string, version long, size int")
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    changes_stream(stream, ["id"], f"{tmp_path}/out", f"{tmp_path}/checkpoint", groups=8, packed=["id", "other"]).awaitTermination()
    changes = spark.read.parquet(f"{tmp_path}/out")
    assert rows(current_rows(changes, ["id"])) == rows(latest_version(df, ["id"]))
