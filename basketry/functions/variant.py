"""Masking of JSON whose fields are not known: parsed to VARIANT, walked, rebuilt. No schema, no UDF.

A level of the walk takes the values of an object or array, masks them by the name they stand under and puts them back;
levels are nested expressions, one per depth, so their number is fixed when a plan is made. Text that is nested deeper
is found by its brackets and comes out as missing, never half masked.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.functions.pii import mask_email, mask_phone

#: levels of objects and arrays; deeper documents are rejected
MOST_DEPTH = 12

_STRINGS = r'"(?:[^"\\]|\\.)*+"'


def _kind(name: Column) -> Column:
    lowered = F.lower(name)
    return F.when(lowered.contains("phone"), "phone").when(lowered.contains("email"), "email")


def _masked_scalar(value: Column, kind: Column) -> Column:
    """Missing, empty, zero and false stay as they are; whole numbers are masked by their digits."""
    text = F.try_variant_get(value, "$", "string")
    masked = F.when(kind == "phone", mask_phone(text)).otherwise(mask_email(text))
    return F.when(kind.isNull() | text.isNull() | text.isin("", "false", "0", "0.0"), value).otherwise(masked.cast("variant"))


def mask_variant(value: Column, kind: Column | None = None, depth: int = MOST_DEPTH) -> Column:
    """A VARIANT with the scalars under names with "phone" or "email" normalised and hashed.

    ``kind``: "phone" or "email" if the value itself stands under such a name. Items of an array inherit the name; the
    fields of an object have names of their own.
    """
    kind = F.lit(None).cast("string") if kind is None else kind
    if depth == 0:
        return _masked_scalar(value, kind)
    # what is inside, with names in an object and without in an array; missing for a scalar
    fields = F.transform(
        F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")),
        lambda entry: F.struct(entry["key"].alias("name"), _kind(entry["key"]).alias("kind"), entry["value"].alias("part")),
    )
    items = F.transform(
        F.try_variant_get(value, "$", "array<variant>"),
        lambda item: F.struct(F.lit(None).cast("string").alias("name"), kind.alias("kind"), item.alias("part")),
    )
    done = F.transform(
        F.coalesce(fields, items),
        lambda entry: F.struct(entry["name"].alias("name"), mask_variant(entry["part"], entry["kind"], depth - 1).alias("part")),
    )
    # one element, so that what was done is computed once and looked at several times
    return F.transform(
        F.array(done),
        lambda parts: F.when(parts.isNull(), _masked_scalar(value, kind))
        .when(F.size(parts) == 0, value)
        .when(parts[0]["name"].isNull(), F.to_variant_object(F.transform(parts, lambda entry: entry["part"])))
        .otherwise(F.to_variant_object(F.map_from_entries(parts))),
    )[0]


def deeper_than(text: Column, depth: int) -> Column:
    """Whether JSON text nests objects and arrays more than ``depth`` levels deep."""
    brackets = F.regexp_replace(F.regexp_replace(text, _STRINGS, ""), r"[^\[\]{}]", "")
    left = brackets
    for _ in range(depth):
        # each turn takes the innermost level away
        left = F.regexp_replace(left, r"\[\]|\{\}", "")
    return F.when(F.length(brackets) > 2 * depth, F.length(left) > 0).otherwise(F.lit(False))


def parse_variant(text: Column, depth: int = MOST_DEPTH) -> Column:
    """JSON text as VARIANT; NULL if it cannot be read or is nested too deep."""
    return F.when(~deeper_than(text, depth), F.try_parse_json(text))


def mask_json(text: Column, depth: int = MOST_DEPTH) -> Column:
    """JSON text with its phones and e-mails masked, whatever fields it has; NULL if it cannot be read or is too deep."""
    return F.to_json(mask_variant(parse_variant(text, depth), depth=depth))


def stamped_variant(document: Column, sent: Column) -> Column:
    """A VARIANT document with its id as text in lower case and the time it was sent; NULL if it is no object.

    What ``stamp`` does to documents of a schema.
    """
    fields = F.try_variant_get(document, "$", "map<string,variant>")
    fields = F.map_filter(fields, lambda name, _: name != "kafka_send_date")
    lowered = F.transform_values(
        fields,
        lambda name, part: F.when(name == "_id", F.lower(F.try_variant_get(part, "$", "string")).cast("variant")).otherwise(part),
    )
    moment = F.date_format(sent, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.to_variant_object(F.map_concat(lowered, F.create_map(F.lit("kafka_send_date"), moment.cast("variant"))))
