from __future__ import annotations

from pyspark.sql import functions as F

from basketry.operators import lookup_join
from basketry.session import SETTINGS, apply_settings, object_store, shared_dir


def test_object_store():
    settings = object_store("https://s3.example", "a", "b")
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "https://s3.example"
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert settings["spark.hadoop.fs.s3a.multipart.size"] == "104857600"
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert "spark.hadoop.fs.s3a.access.key" not in object_store("http://s3.example")


def test_shared_dir_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_settings_apply_to_a_running_session(spark):
    apply_settings(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == SETTINGS["spark.sql.session.timeZone"]


def test_hex_keys_are_stored_in_half_their_text(spark, tmp_path):
    apply_settings(spark)
    keys = spark.range(0, 20000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("key"))
    keys.write.parquet(str(tmp_path / "keys"))
    stored = sum(path.stat().st_size for path in (tmp_path / "keys").glob("part-*"))
    assert stored < 0.7 * 64 * 20000
    assert spark.read.parquet(str(tmp_path / "keys")).distinct().count() == 20000


def test_hot_key_of_a_large_lookup_is_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(0, 60000, 1, 8).select("id", F.expr("if(id % 3 = 0, 7, id % 1000)").alias("k"))
        dim = spark.range(1000).select(F.col("id").alias("dk"), F.col("id").alias("v"))
        joined = lookup_join(left, dim, "k", "dk", small=False, spread_by="id")
        assert joined.filter("v = 7").count() == 20000 + 40
        joined.write.format("noop").mode("overwrite").save()
        final = joined.groupBy("v").agg(F.sum("id"))
        assert len(final.collect()) == 1000
        assert "skew=true" in final._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
