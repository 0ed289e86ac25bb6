"""Expiry of stored tables against the filter."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

from basketry.operators.versioned import expire
from basketry.sources import retention
from basketry.sources.partitions import partition_values
from basketry.sources.retention import Expiry, expire_stored
from basketry.sources.tables import read_by_month, write_by_month
from conftest import rows

AS_OF = datetime(2025, 8, 20, 12, tzinfo=timezone.utc)
LIMIT = AS_OF - timedelta(days=180)  # 21 February, noon


def table(spark, ages):
    moments = [None if age is None else f"{AS_OF - timedelta(days=age):%Y-%m-%d %H:%M:%S}" for age in ages]
    made = [(k, moment) for k, moment in enumerate(moments)]
    return spark.createDataFrame(made, "id int, at string").selectExpr("id", "cast(at AS timestamp) AS load_date")


def files(path):
    return {str(file): file.stat().st_mtime_ns for file in Path(path).rglob("*.parquet")}


AGES = (0, 10, 100, 170, 179.9, 179.99999, 180, 180.00002, 185, 210, 300, 500, None)


def test_old_months_go_and_the_border_month_is_rewritten(spark, tmp_path):
    path = str(tmp_path / "table")
    df = table(spark, AGES)
    write_by_month(df, path)
    newer = {name: at for name, at in files(path).items() if "202502" not in name}
    done = expire_stored(spark, path, 180, AS_OF)
    assert done.rewritten == "202502" and "202501" in done.dropped and "202403" not in partition_values(spark, path, "load_month")
    kept = expire(df, "load_date", 180, AS_OF)
    assert rows(read_by_month(spark, path).select("id", "load_date")) == rows(kept)
    assert set(partition_values(spark, path, "load_month")) == {row[0] for row in read_by_month(spark, path).select("load_month").distinct().collect()}
    # files of later months are the same, untouched
    assert {name: at for name, at in files(path).items() if "202502" not in name}.items() <= newer.items()
    before = files(path)
    assert expire_stored(spark, path, 180, AS_OF) == Expiry()
    assert files(path) == before
    assert not (tmp_path / "table.kept").exists()


@pytest.mark.parametrize("ages", [(0, 100), (0, 181, 182), (500,)], ids=["all new", "border all old", "all old"])
def test_nothing_to_rewrite(spark, tmp_path, ages):
    path = str(tmp_path / "table")
    df = table(spark, ages)
    write_by_month(df, path)
    assert expire_stored(spark, path, 180, AS_OF).rewritten is None
    left = sum(age < 180 for age in ages)
    assert len(partition_values(spark, path, "load_month")) == left
    if left:
        assert rows(read_by_month(spark, path).select("id", "load_date")) == rows(expire(df, "load_date", 180, AS_OF))


def test_a_run_that_stops_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    df = table(spark, AGES)
    write_by_month(df, path)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as stopped:
        stopped.setattr(retention, "_replace", stop)
        with pytest.raises(RuntimeError):
            expire_stored(spark, path, 180, AS_OF)
    # the border month is lost half way through its replacement
    for file in Path(path, "load_month=202502").iterdir():
        file.unlink()
    expire_stored(spark, path, 180, AS_OF)
    assert rows(read_by_month(spark, path).select("id", "load_date")) == rows(expire(df, "load_date", 180, AS_OF))


def test_tables_without_months_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "dimension")
    df = table(spark, AGES)
    df.write.parquet(path)
    for _ in range(2):
        expire_stored(spark, path, 180, AS_OF)
        assert rows(spark.read.parquet(path)) == rows(expire(df, "load_date", 180, AS_OF))
        before = files(path)
    expire_stored(spark, path, 180, AS_OF)
    assert files(path) == before
