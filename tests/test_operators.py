from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from basketry.operators import (
    dataset_stats,
    duplicate_ratio,
    expire,
    fits,
    latest_version,
    lookup_join,
    measure,
    quality_gate,
    require_rows,
    sample_documents,
    spread,
    version_stamp,
)
from basketry.operators.quality import REASONS, filled
from conftest import plan_of, rows


def test_latest_version_one_row_per_key(spark):
    data = [(1, "a", 1), (1, "b", 3), (1, "c", 3), (2, "x", None), (None, "n", 1), (None, "m", 2)]
    df = spark.createDataFrame(data, "k int, v string, version bigint")
    assert rows(latest_version(df, ["k"])) == rows(
        spark.createDataFrame([(1, "c", 3), (2, "x", None), (None, "m", 2)], df.schema)
    )


def test_latest_version_keeps_ties(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 3), (2, "x", 1)], "k int, v string, version int")
    assert rows(latest_version(df, ["k"], ties="all")) == [(1, "b", 3), (1, "c", 3), (2, "x", 1)]
    with pytest.raises(ValueError):
        latest_version(df, ["k"], ties="some")


def test_latest_version_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("version"))
    plan = plan_of(latest_version(df, ["k"])).split("Physical Plan")[1]
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_latest_version_does_not_depend_on_row_order(spark):
    generator = random.Random(3)
    data = [(generator.randint(0, 20), generator.randint(0, 3), generator.random()) for _ in range(500)]
    df = spark.createDataFrame(data, "k int, version int, v double")
    shuffled = df.orderBy(F.rand(5)).repartition(7)
    assert rows(latest_version(df, ["k"])) == rows(latest_version(shuffled, ["k"]))


def test_expire_and_version(spark):
    df = spark.createDataFrame(
        [(1, datetime(2025, 1, 1)), (2, datetime(2025, 1, 2)), (3, datetime(2025, 1, 2, 0, 0, 1))], "i int, ts timestamp"
    )
    assert [row.i for row in expire(df, "ts", 30, date(2025, 2, 1)).collect()] == [3]
    assert df.select(version_stamp(F.col("ts"))).first()[0] == int(datetime(2025, 1, 1).timestamp())


def test_quality_gate_loses_no_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("", 1.0), (None, 2.0), ("b", 0.0), ("", None)], "name string, price double")
    good, bad = quality_gate(df, {**filled("name"), "price is not positive": F.col("price") > 0})
    assert rows(good) == [("a", 1.0)]
    assert {(row["name"], tuple(row[REASONS])) for row in bad.collect()} == {
        ("", ("name is empty",)),
        (None, ("name is empty",)),
        ("b", ("price is not positive",)),
        ("", ("name is empty", "price is not positive")),
    }


def test_duplicate_ratio(spark):
    half = spark.createDataFrame([(1,), (1,), (2,), (2,)], "k int")
    more = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    empty = spark.createDataFrame([], "k int")
    got = {row.table_name: row for row in duplicate_ratio(
        {"half": (half, ["k"]), "more": (more, ["k"]), "empty": (empty, ["k"])}).collect()}
    assert (got["half"].duplicate_percent, got["half"].alert) == (50.0, False)
    assert got["more"].alert and got["more"].total_rows == 3
    assert (got["empty"].duplicate_percent, got["empty"].alert) == (0.0, False)


def test_dataset_stats(spark, tmp_path):
    one = spark.range(5)
    none = spark.range(0)
    stats = dataset_stats(spark, {"one": one, "none": none, "lost": lambda: spark.read.parquet(str(tmp_path / "no"))})
    got = {row.name: row for row in stats.collect()}
    assert (got["one"].total_documents, got["one"].is_empty, got["one"].error) == (5, False, None)
    assert got["none"].is_empty and got["lost"].is_empty and "PATH_NOT_FOUND" in got["lost"].error
    assert require_rows(stats) == 5
    with pytest.raises(ValueError):
        require_rows(dataset_stats(spark, {"none": none}))
    assert sample_documents({"one": one, "none": none}).count() == 3


def test_measure(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None), (3, "абв")], "i int, s string")
    size = measure({"a": df, "b": df.limit(0)})
    assert size["a"].rows == 3 and size["a"].bytes == 3 * 32 + 2 + 6 and size["a"].widest == 38
    assert size["b"].bytes == 0
    assert fits(df, 104) and not fits(df, 103)


@pytest.fixture
def skewed(spark):
    """A third of the rows with no key, a third with the "none" key, some unknown."""
    left = spark.range(3000).select(
        F.col("id"),
        F.expr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 0 ELSE id % 50 END").alias("k"),
    )
    return left


@pytest.mark.parametrize("with_zero", [True, False])
def test_lookup_join_ways_agree(spark, skewed, with_zero):
    known = [(k, f"v{k}") for k in range(1, 40)] + ([(0, "zero")] if with_zero else [])
    dim = spark.createDataFrame(known, "dk bigint, v string")
    small = lookup_join(skewed, dim, "k", "dk", small=True)
    large = lookup_join(skewed, dim, "k", "dk", small=False, empty_keys=[0], spread_by="id")
    plain = lookup_join(skewed, dim, "k", "dk", small=False)
    assert small.columns == large.columns == plain.columns
    assert rows(small) == rows(large) == rows(plain)
    assert small.count() == 3000
    assert lookup_join(skewed, dim, "k", "dk", max_bytes=10, spread_by="id").count() == 3000


def test_lookup_join_spreads_rows_without_a_key(spark, skewed):
    dim = spark.createDataFrame([(k, f"v{k}") for k in range(40)], "dk bigint, v string")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        joined = lookup_join(skewed, dim, "k", "dk", small=False, empty_keys=[0], spread_by="id")
        sizes = [row[1] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(sizes) > 12 and max(sizes) < 3000 / 4


def test_spread(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(9)
    assert spread(many, "id") is many


def test_sample_does_not_depend_on_the_partitions(spark):
    df = spark.range(500).selectExpr("id", "id % 7 AS part", "if(id = 3, NULL, 'x') AS text")
    wanted = None
    for some in (df.coalesce(1), df.repartition(7, "part"), df.orderBy(F.desc("id"))):
        found = sorted(tuple(row) for row in sample_documents({"a": some, "b": some.limit(0)}, 5, {"a": ["id", "text"]}).collect())
        assert len(found) == 5 and {row[0] for row in found} == {"a"}
        assert wanted in (None, found)
        wanted = found
    plan = sample_documents({"a": df}, 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
