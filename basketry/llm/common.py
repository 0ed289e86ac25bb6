"""Tables, folders and column handling shared by the operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path, not yet used, in the folder that all executors share."""
    return f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def input_columns(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator needs, under names of its own. Extra columns of the input can clash with nothing."""
    return df.select(*(df[f"`{column}`"].alias(name) for name, column in columns.items()))


def utf8(column: str) -> F.Column:
    """The bytes of a text; null reads as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def held_out(key: F.Column) -> F.Column:
    """The fixed fifth of the ids that no model may learn from. A null id is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def ship(spark: SparkSession) -> None:
    """Give the library to the executors' Python, as a file that Spark itself distributes; once per application."""
    context = spark.sparkContext
    if getattr(context, "_basketry_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    handle, path = tempfile.mkstemp(suffix=".zip", prefix="basketry-")
    with os.fdopen(handle, "wb") as file, zipfile.ZipFile(file, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    context.addPyFile(path)
    context._basketry_shipped = True


def per_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema, rows: int | None = None) -> DataFrame:
    """Apply a function to each Arrow batch of each partition, ``rows`` rows at a time if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows or max(1, batch.num_rows)):
                out = fn(batch.slice(at, rows))
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]
        batch = out = None
        rest()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def on_texts(fn: Callable[[pa.Array], pa.Array], dtype: str, rows: int) -> Callable[[F.Column], F.Column]:
    """A column computed from one column of texts, ``rows`` of them at a time. Only the texts go to Python; the rows
    they stand in stay where they are."""

    @F.arrow_udf(dtype)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [fn(batch.slice(at, rows)) for at in range(0, max(1, len(batch)), rows)]
            yield pa.concat_arrays(parts)
        batch = parts = None
        rest()

    return run.asNondeterministic()


_HELD: dict = {}


def of_worker(key, make: Callable):
    """What a worker keeps between tasks, such as a table of tokens.

    A worker serves one operator after another; it holds the table of the last one only.
    """
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
    return _HELD[key]


def rest() -> None:
    """What a worker does at the end of a task: tables that say how drop what is cheap to make again."""
    for held in _HELD.values():
        if hasattr(held, "rest"):
            held.rest()
    give_back()


def let_go() -> None:
    """Drop what the worker keeps, before work that needs none of it."""
    _HELD.clear()
    give_back()


def give_back() -> None:
    """Return freed memory to the system, so that workers that wait hold little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Index(dict):
    """Numbers tokens in the order they are first seen; ``fresh`` are those not yet taken."""

    def __init__(self):
        self.fresh: list = []

    def __missing__(self, token) -> int:
        self[token] = number = len(self)
        self.fresh.append(token)
        return number


class TokenTable:
    """Numbers of tokens with one row of numbers each, computed once per distinct token and worker.

    ``rows_of(tokens)`` gives an array with a row per token. Beyond ``limit`` distinct tokens the table starts anew,
    which bounds its memory and changes no result.
    """

    def __init__(self, rows_of: Callable[[list], np.ndarray], limit: int = 500_000):
        self.rows_of, self.limit = rows_of, limit
        self.clear()

    def clear(self) -> None:
        self.index, self.rows = Index(), None

    def numbers(self, tokens: list) -> np.ndarray:
        if len(self.index) > self.limit:
            self.clear()
        found = np.fromiter(map(self.index.__getitem__, tokens), np.int64, len(tokens))
        fresh = self.index.fresh
        if fresh:
            size = len(self.index)
            new = self.rows_of(fresh)
            if self.rows is None or size > len(self.rows):
                grown = np.zeros((max(1024, 2 * size), new.shape[1]), new.dtype)
                if self.rows is not None:
                    grown[: size - len(fresh)] = self.rows[: size - len(fresh)]
                self.rows = grown
            self.rows[size - len(fresh) : size] = new
            self.index.fresh = []
        return found


def texts_of(column: pa.Array) -> list[bytes]:
    return [value or b"" for value in column.to_pylist()]
