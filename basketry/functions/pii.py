"""Masking of phones and e-mails at any depth, from the schema alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.clean import normalize_email, normalize_phone, sha256_hex

SENSITIVE_TOPICS = ("stores", "customers", "purchases")


def mask_phone(column: Column) -> Column:
    return sha256_hex(normalize_phone(column))


def mask_email(column: Column) -> Column:
    return sha256_hex(normalize_email(column))


def _kind(name: str) -> str | None:
    lowered = name.lower()
    if "phone" in lowered:
        return "phone"
    return "email" if "email" in lowered else None


def _touches(dtype: T.DataType, name: str) -> bool:
    """Whether masking can change a value of this type under this field name."""
    if isinstance(dtype, T.StructType):
        return any(_touches(field.dataType, field.name) for field in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _touches(dtype.elementType, name)
    if isinstance(dtype, T.MapType):
        return isinstance(dtype.keyType, T.StringType)
    return _kind(name) is not None


def _masked(column: Column, dtype: T.DataType, name: str) -> Column:
    if not _touches(dtype, name):
        return column
    if isinstance(dtype, T.StructType):
        fields = [_masked(column[f.name], f.dataType, f.name).alias(f.name) for f in dtype.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(column, lambda item: _masked(item, dtype.elementType, name))
    if isinstance(dtype, T.MapType):
        return _masked_map(column, dtype)
    return mask_phone(column) if _kind(name) == "phone" else mask_email(column)


def _masked_map(column: Column, dtype: T.MapType) -> Column:
    """Map keys are field names known only at run time; values keep one type, so only text can be masked."""
    value_type = dtype.valueType
    if isinstance(value_type, T.StringType):
        return F.transform_values(
            column,
            lambda key, value: F.when(F.lower(key).contains("phone"), mask_phone(value))
            .when(F.lower(key).contains("email"), mask_email(value))
            .otherwise(value),
        )
    if isinstance(value_type, T.ArrayType) and isinstance(value_type.elementType, T.StringType):
        return F.transform_values(
            column,
            lambda key, value: F.when(F.lower(key).contains("phone"), F.transform(value, mask_phone))
            .when(F.lower(key).contains("email"), F.transform(value, mask_email))
            .otherwise(value),
        )
    return F.transform_values(column, lambda _key, value: _masked(value, value_type, ""))


def mask_pii(df: DataFrame) -> DataFrame:
    """Normalise and hash every field whose name contains "phone" or "email"; array items inherit the name.

    Columns without such a field pass through untouched, so they can still be pruned.
    """
    return df.select(*[_masked(F.col(f"`{f.name}`"), f.dataType, f.name).alias(f.name) for f in df.schema.fields])


def stamp(df: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """Lower-case the document id, if there is one, and note when the document was sent."""
    sent = F.current_timestamp() if load_ts is None else load_ts
    if "_id" in df.columns:
        df = df.withColumn("_id", F.lower(F.col("_id").cast("string")))
    return df.withColumn("kafka_send_date", F.date_format(sent, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
