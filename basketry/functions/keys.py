"""Surrogate keys: hashes of natural keys, so a foreign key never needs a lookup join."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\u0001"
#: added to texts that are no key of 64 digits; longer than the bytes of one, so that both are told apart by length
_PAD = b"\0" * 33


def packed_key(key: Column) -> Column:
    """A SHA-256 key in hex as its 32 bytes, and the "none" key 0 as one: half the size, the same order.

    Other texts are kept, longer than before; they come after or among the keys in another order.
    """
    digits = F.unhex(key)
    whole = (F.octet_length(digits) == 32) & (F.lower(F.hex(digits)) == key)
    other = F.when(key == "0", F.lit(b"\0")).otherwise(F.concat(key.cast("binary"), F.lit(_PAD)))
    return F.when(whole, digits).otherwise(other)


def unpacked_key(packed: Column) -> Column:
    """What ``packed_key`` was made of."""
    size = F.octet_length(packed)
    text = F.substring(packed, F.lit(1), size - len(_PAD)).cast("string")
    return F.when(size == 32, F.lower(F.hex(packed))).when(size == 1, "0").otherwise(text)


@dataclass(frozen=True)
class Keys:
    """How keys are made.

    ``xxhash64`` gives a bigint and suits every dimension. Above some 10^9 rows in one table, 64 bits start to
    collide; ``sha256`` gives a hex string that does not.
    """

    algo: str = "xxhash64"

    def __post_init__(self) -> None:
        if self.algo not in ("xxhash64", "sha256"):
            raise ValueError(f"unknown key algorithm {self.algo!r}")

    def key(self, *parts: Column) -> Column:
        """Key of the parts in this order. A missing part counts as empty, since hashing would skip it."""
        filled = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
        if self.algo == "sha256":
            return F.sha2(F.concat_ws(SEPARATOR, *filled), 256)
        return F.xxhash64(*filled)

    def key_if(self, condition: Column, *parts: Column) -> Column:
        """Key where the condition holds, else the "none" key 0."""
        return F.when(condition, self.key(*parts)).otherwise(self.none)

    @property
    def none(self) -> Column:
        return F.lit("0") if self.algo == "sha256" else F.lit(0).cast("bigint")
