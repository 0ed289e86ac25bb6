"""Left lookup joins that hold up when the small side grows or one key holds many rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 64


@dataclass(frozen=True)
class Size:
    """Rows of a frame, their bytes with all texts, and the bytes of the widest row."""

    rows: int
    bytes: int
    widest: int


def measure(frames: Mapping[str, DataFrame]) -> dict[str, Size]:
    """Sizes of frames, in one job that brings back one row per frame."""
    parts = []
    for name, df in frames.items():
        row = F.lit(16 + 8 * len(df.columns)).cast("long")
        for field in df.schema.fields:
            if isinstance(field.dataType, (T.StringType, T.BinaryType)):
                row = row + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
            elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
                row = row + F.octet_length(F.to_json(F.struct(field.name)))
        parts.append(
            df.agg(
                F.count(F.lit(1)).alias("rows"),
                F.coalesce(F.sum(row), F.lit(0)).alias("bytes"),
                F.coalesce(F.max(row), F.lit(0)).alias("widest"),
            ).select(F.lit(name).alias("name"), "*")
        )
    rows = reduce(DataFrame.unionByName, parts).collect() if parts else []
    return {row["name"]: Size(row["rows"], row["bytes"], row["widest"]) for row in rows}


def fits(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a frame's rows stay under ``max_bytes``. Runs one aggregation."""
    return measure({"frame": df})["frame"].bytes <= max_bytes


def lookup_join(
    left: DataFrame,
    dim: DataFrame,
    left_key: str,
    dim_key: str,
    *,
    small: bool | None = None,
    max_bytes: int = BROADCAST_BYTES,
    empty_keys: Sequence[object] = (),
    spread_by: str | None = None,
) -> DataFrame:
    """Left join on one key; ``dim`` must have one row per key.

    ``small`` tells the outcome of a check already made; left out, ``dim`` is measured here. A dimension under the
    limit is broadcast. A larger one is shuffled: rows of ``left`` whose key is missing or one of ``empty_keys``
    ("no address" and the like, often most of the rows) are spread by ``spread_by`` over SALTS partitions, with as
    many copies of the dimension row for that key, if there is one. AQE splits any other hot key.
    """
    if small is None:
        small = fits(dim, max_bytes)
    if small:
        return left.join(F.broadcast(dim), left[left_key] == dim[dim_key], "left")
    if spread_by is None:
        return left.join(dim, left[left_key] == dim[dim_key], "left")
    hot = F.col(left_key).isNull()
    copied = F.lit(False)
    if empty_keys:
        hot = hot | F.col(left_key).isin(*empty_keys)
        copied = F.coalesce(F.col(dim_key).isin(*empty_keys), F.lit(False))
    salt = F.when(hot, F.pmod(F.xxhash64(F.col(spread_by)), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    salted = left.withColumn("_salt", salt)
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    copies = dim.withColumn("_dim_salt", F.explode(F.when(copied, every).otherwise(F.array(F.lit(0)))))
    condition = (salted[left_key] == copies[dim_key]) & (F.col("_salt") == F.col("_dim_salt"))
    return salted.join(copies, condition, "left").drop("_salt", "_dim_salt")
