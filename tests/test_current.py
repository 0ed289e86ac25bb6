"""Keyed state against the batch choice of the last version."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from basketry.operators.versioned import latest_version
from basketry.streaming.current import EXPIRED, changes_stream, current_rows
from conftest import rows

SCHEMA = "id long, part string, version long, name string, size double, tags array<string>, load_date timestamp"
START = datetime(2025, 1, 1)


def feed(spark, work, batch, **options):
    """Deliver rows, run the stream, return the changes so far."""
    spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{work}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{work}/in")
    changes_stream(stream, ["id", "part"], f"{work}/out", f"{work}/checkpoint", **options).awaitTermination()
    return spark.read.parquet(f"{work}/out")


def made(seed, count=150):
    random_ = random.Random(seed)
    return [
        (
            random_.choice((None, 1, 2, 2**62 + 1, *range(5, 15))),
            random_.choice(("a", "b")),
            random_.choice((None, 1, 2, 3)),
            random_.choice((None, "", "x", "é", "z", "\U0001f34e", "￿")),
            random_.choice((None, 0.0, -1.5, float("nan"), float("inf"))),
            random_.choice((None, [], ["a"], ["a", None], ["b"])),
            START + timedelta(hours=random_.randrange(50)),
        )
        for _ in range(count)
    ]


def test_state_equals_the_batch_and_replays_emit_nothing(spark, tmp_path):
    work = str(tmp_path)
    delivered = []
    for seed in (1, 2):
        batch = made(seed)
        delivered += batch
        changes = feed(spark, work, batch)
        wanted = latest_version(spark.createDataFrame(delivered, SCHEMA), ["id", "part"])
        # as text, since NaN is not itself
        assert str(rows(current_rows(changes, ["id", "part"]))) == str(rows(wanted.select(*changes.drop(EXPIRED).columns)))
    before = changes.count()
    # within a batch only the newest row of a key is passed on
    assert before <= 2 * wanted.count()
    assert feed(spark, work, delivered).count() == before


def test_rows_expire_and_may_come_again(spark, tmp_path):
    work, options = str(tmp_path), {"ts": "load_date", "days": 30}

    def row(id_, version, day):
        return (id_, "a", version, "n", 1.0, [], START + timedelta(days=day))

    feed(spark, work, [row(1, 1, 0), row(2, 1, 0)], **options)
    # key 2 is renewed in time; the watermark passes key 1
    feed(spark, work, [row(2, 2, 25)], **options)
    changes = feed(spark, work, [row(3, 1, 40)], **options)
    found = {(r.id, r.version, r.expired) for r in changes.collect()}
    assert found == {(1, 1, False), (2, 1, False), (2, 2, False), (3, 1, False), (1, 1, True)}
    assert {r.id for r in current_rows(changes, ["id", "part"]).collect()} == {2, 3}
    # a replay of an expired row stays away, a new version comes back
    changes = feed(spark, work, [row(1, 1, 0), row(1, 9, 41)], **options)
    assert {(r.id, r.version) for r in current_rows(changes, ["id", "part"]).collect()} == {(1, 9), (2, 2), (3, 1)}
    assert changes.filter(EXPIRED).count() == 1


def test_keys_share_the_state_by_group(spark, tmp_path):
    work = str(tmp_path)
    delivered = made(3)
    spark.createDataFrame(delivered, SCHEMA).coalesce(1).write.parquet(f"{work}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{work}/in")
    query = changes_stream(stream, ["id", "part"], f"{work}/out", f"{work}/checkpoint", groups=4)
    query.awaitTermination()
    assert 0 < max(part["numRowsTotal"] for p in query.recentProgress for part in p["stateOperators"]) <= 4
    wanted = latest_version(spark.createDataFrame(delivered, SCHEMA), ["id", "part"])
    changes = spark.read.parquet(f"{work}/out")
    assert changes.count() == wanted.count()
    assert str(rows(current_rows(changes, ["id", "part"]))) == str(rows(wanted.select(*changes.drop(EXPIRED).columns)))


def test_rows_of_a_group_expire_each_at_its_time(spark, tmp_path):
    work, options = str(tmp_path), {"ts": "load_date", "days": 30, "groups": 1}

    def row(id_, day):
        return (id_, "a", 1, "n", 1.0, [], None if day is None else START + timedelta(days=day))

    feed(spark, work, [row(1, 0), row(2, 0), row(3, 5), row(4, 20), row(5, None)], **options)
    changes = feed(spark, work, [row(6, 36)], **options)
    assert {r.id for r in changes.filter(EXPIRED).collect()} == {1, 2, 3}
    changes = feed(spark, work, [row(7, 51)], **options)
    assert sorted(r.id for r in changes.filter(EXPIRED).collect()) == [1, 2, 3, 4]
    assert {r.id for r in current_rows(changes, ["id", "part"]).collect()} == {5, 6, 7}


def test_other_streams_keep_their_state_store(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    feed(spark, str(tmp_path), [])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_expiry_needs_a_time_and_days(spark, tmp_path):
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path))
    with pytest.raises(ValueError, match="expire"):
        changes_stream(stream, ["id"], "out", "checkpoint", days=3)


def test_current_rows_of_changes(spark):
    changes = spark.createDataFrame(
        [(1, 1, "a", False), (1, 2, "a", False), (1, 2, "a", True), (2, 1, "a", False), (2, 1, "b", False), (3, 1, "a", True), (3, 2, "a", False)],
        f"id int, version int, name string, {EXPIRED} boolean",
    )
    assert rows(current_rows(changes, ["id"]).select("id", "version", F.upper("name"))) == [(2, 1, "B"), (3, 2, "A")]
