"""The last version of each key, kept in state: a stream of changes instead of a history to merge at each read.

The state of a key is its newest row. A row that is newer replaces it and is passed on as a change; one that is older or
the same, as after a replay, passes nothing on. State lives in RocksDB, on disk, so it may outgrow memory, and is
checkpointed with the stream.

Each call to the state costs a round trip between Python and the JVM, so keys share it by the group their hash falls in:
one value holds the rows of a group, which is read and written once a batch, if at all. A checkpoint belongs to the
number of groups it was begun with, and to keys in hex being held as bytes, which ``mart_changes`` asks for.

Rows expire ``days`` after their time, counted from the newest row of the stream: the watermark lags by that much, a
timer at the earliest time of a group fires when the watermark passes it, the rows that are passed leave the state and
are passed on as expired. Rows that arrive already expired are dropped by the same watermark.

Which of several rows is newest is what ``latest_version`` says: the highest version, then the highest values of the
other columns, missing ones lowest.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from operator import itemgetter

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from basketry.functions.keys import packed_key, unpacked_key
from basketry.operators.versioned import MART_DAYS, latest_version
from basketry.plans.mart import DIMENSIONS, MART_KEYS, STAMPS, latest_details, text_keys

EXPIRED = "expired"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def keep_newest(
    schema: T.StructType, keys: Sequence[str], ranked: Sequence[str], ts: str | None
) -> StatefulProcessor:
    """Keeps the highest row of each key of a group by the ``ranked`` columns; with ``ts``, until that time (in
    microseconds) is passed.

    The class is local so that it travels to the executors by value; they need no copy of the library.
    """
    names = [field.name for field in schema.fields]
    state_schema = T.StructType([T.StructField("rows", T.ArrayType(schema))])
    key_places = [names.index(name) for name in keys]
    places = [names.index(name) for name in ranked]
    time_place = None if ts is None else names.index(ts)
    output = Row(*names, EXPIRED)

    def rank(value):
        if value is None:
            return (0,)
        if isinstance(value, float) and value != value:
            return (2,)
        if isinstance(value, (list, tuple)):
            return (1, tuple(rank(item) for item in value))
        return (1, bytes(value) if isinstance(value, bytearray) else value)

    def newer(row: tuple, held: tuple) -> bool:
        for place in places:
            if row[place] != held[place]:
                its, other = rank(row[place]), rank(held[place])
                if its != other:
                    return its > other
        return False

    def key_of(row: tuple) -> tuple:
        return tuple(rank(row[place]) for place in key_places)

    class Newest(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.newest = handle.getValueState("newest", state_schema)

        def _held(self) -> dict[tuple, tuple]:
            state = self.newest.get()
            return {} if state is None else {key_of(row): row for row in map(tuple, state[0])}

        def _keep(self, held: dict[tuple, tuple]) -> None:
            """Write the rows of the group back, and set its timer to the earliest of their times."""
            if held:
                self.newest.update((list(held.values()),))
            else:
                self.newest.clear()
            if time_place is not None:
                times = [row[time_place] for row in held.values() if row[time_place] is not None]
                first = min(times) // 1000 if times else None
                timers = list(self.handle.listTimers())
                for timer in timers:
                    if timer != first:
                        self.handle.deleteTimer(timer)
                if first is not None and first not in timers:
                    self.handle.registerTimer(first)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            held, changed, pick = self._held(), {}, None
            for row in rows:
                if pick is None:
                    pick = itemgetter(*map(row.__fields__.index, names))
                values = pick(tuple(row))
                its_key = key_of(values)
                before = held.get(its_key)
                if before is None or newer(values, before):
                    held[its_key] = changed[its_key] = values
            if changed:
                self._keep(held)
                for row in changed.values():
                    yield output(*row, False)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs() + 1)
            held, expired = {}, []
            for its_key, row in self._held().items():
                if row[time_place] is not None and row[time_place] // 1000 < passed:
                    expired.append(row)
                else:
                    held[its_key] = row
            self._keep(held)
            for row in expired:
                yield output(*row, True)

        def close(self) -> None:
            pass

    return Newest()


_TIMES = (T.TimestampType, T.TimestampNTZType)
_EVENT = "_event_time"
_GROUP = "_group"
#: groups of keys in the state: with more, a batch of few keys reads and writes less; with fewer, one of many keys calls less
STATE_GROUPS = 1 << 16


def _as_held(df: DataFrame, packed: Sequence[str]) -> DataFrame:
    """Times in microseconds: workers read times in the zone of their machine, numbers are the same everywhere. Keys in
    hex as bytes, if ``packed``."""

    def held(field: T.StructField) -> F.Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _TIMES):
            return F.unix_micros(column.cast("timestamp")).alias(field.name)
        return packed_key(column).alias(field.name) if field.name in packed else column

    return df.select(*map(held, df.schema.fields))


def _as_given(df: DataFrame, schema: T.StructType, packed: Sequence[str]) -> DataFrame:
    def given(field: T.StructField) -> F.Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _TIMES):
            return F.timestamp_micros(column).cast(field.dataType).alias(field.name)
        return unpacked_key(column).alias(field.name) if field.name in packed else column

    return df.select(*map(given, schema.fields), EXPIRED)


@contextmanager
def _state_in_rocksdb(spark: SparkSession):
    """Streams that start within keep their state in RocksDB; others of the session keep what they have."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def changes_stream(
    rows: DataFrame,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    version: str = "version",
    tie_break: Sequence[str] | None = None,
    ts: str | None = None,
    days: int | None = None,
    groups: int = STATE_GROUPS,
    packed: Sequence[str] = (),
) -> StreamingQuery:
    """Append to ``path`` what changes the last version of a key, take what is there and stop.

    ``tie_break`` orders rows of one version, all other columns unless some are named. ``ts`` and ``days`` tell when rows
    expire; without them none do. The changes carry the boolean ``expired``. ``groups`` is how many groups the keys share;
    ``packed`` names the columns of keys in hex, which are shuffled and held as bytes.
    """
    if (ts is None) != (days is None):
        raise ValueError("rows expire by a time column and a number of days, or not at all")
    if tie_break is None:
        tie_break = [name for name in rows.columns if name not in (*keys, version)]
    schema, numbers = rows.schema, _as_held(rows, packed)
    processor = keep_newest(numbers.schema, keys, [version, *tie_break], ts)
    output = T.StructType([*numbers.schema.fields, T.StructField(EXPIRED, T.BooleanType())])
    mode = "None"
    if days is not None:
        numbers = numbers.withColumn(_EVENT, F.timestamp_micros(ts)).withWatermark(_EVENT, f"{days} days")
        mode = "EventTime"
    grouped = numbers.withColumn(_GROUP, F.pmod(F.xxhash64(*keys), F.lit(groups))).groupBy(_GROUP)
    changes = _as_given(grouped.transformWithState(processor, output, "Append", mode), schema, packed)
    with _state_in_rocksdb(rows.sparkSession):
        return (
            changes.writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def current_rows(changes: DataFrame, keys: Sequence[str], version: str = "version", tie_break: Sequence[str] | None = None) -> DataFrame:
    """The rows that hold after all changes: the last of each key, unless it is expired."""
    if tie_break is None:
        tie_break = [name for name in changes.columns if name not in (*keys, version, EXPIRED)]
    last = latest_version(changes, keys, version, [EXPIRED, *tie_break])
    return last.filter(~F.col(EXPIRED)).drop(EXPIRED)


def mart_tie_break(table: str, columns: Sequence[str]) -> list[str]:
    """How rows of one version are ordered when the mart table is read in a batch."""
    key = MART_KEYS[table]
    if table in DIMENSIONS:
        return [*(name for name in reversed(columns) if name not in (key, *STAMPS)), "load_date"]
    return [name for name in columns if name not in (key, "version")]


def mart_changes(
    spark: SparkSession,
    root: str,
    table: str,
    path: str,
    checkpoint: str,
    days: int | None = MART_DAYS,
    groups: int = STATE_GROUPS,
) -> StreamingQuery:
    """The changes of a mart table that ``mart_stream`` appends to under ``root``.

    That stream merges the rows of a dimension in each of its batches, so a value that most rows repeat comes here once
    a batch and its key is no burden.
    """
    schema = spark.read.parquet(f"{root}/{table}").schema
    rows = spark.readStream.schema(schema).parquet(f"{root}/{table}").drop("source")
    ts = None if days is None else "load_date"
    return changes_stream(
        rows,
        [MART_KEYS[table]],
        path,
        checkpoint,
        tie_break=mart_tie_break(table, rows.columns),
        ts=ts,
        days=days,
        groups=groups,
        packed=text_keys(rows),
    )


def current_mart(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A mart table from its changes."""
    changes = spark.read.parquet(path)
    tie_break = mart_tie_break(table, [name for name in changes.columns if name != EXPIRED])
    return latest_details(changes, table, lambda held: current_rows(held, [MART_KEYS[table]], tie_break=tie_break))
