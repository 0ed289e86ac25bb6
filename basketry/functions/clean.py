"""Cleaning expressions. Each takes and returns a Column, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.schemas import CORRUPT

# They must be these for the results to be right.
TRUE_WORDS = ("true", "1", "yes", "да")
PAYMENT_CODES = {"card": 1, "cash": 2, "online": 3}
GENDER_CODES = {"male": 1, "female": 2}
LEADING_SYMBOLS = r"^\p{So}+\s*"
DEFAULT_DATE = date(1970, 1, 1)

_DECIMAL_TEXT = r"(?i)^\s*[+-]?(\d[\d_]*\.?[\d_]*|\.\d[\d_]*)(e[+-]?\d+)?\s*$|^\s*[+-]?(nan|inf|infinity)\s*$"
_INTEGER_TEXT = r"^\s*[+-]?\d+(_\d+)*\s*$"
# Times that a cast reads as they are: ISO, and the loose forms with single digits.
_TIME_TEXT = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?)?$"
    r"|^\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}:\d{1,2})?$"
)
# The rarer ISO forms: no dashes in the day, no minutes or seconds, no colon in the offset.
_RARE_TIME_TEXT = r"^\d{4}-?\d{2}-?\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
_BASIC_DAY = r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])"


def _text(column: Column) -> Column:
    return column.cast("string")


def safe_float(column: Column, default: float = 0.0) -> Column:
    """The number, or the default when it is missing or no number."""
    text = _text(column)
    number = F.when(text.rlike(_DECIMAL_TEXT), F.translate(text, "_", "")).try_cast("double")
    return F.coalesce(number, F.lit(float(default)))


def safe_int(column: Column, default: int = 0) -> Column:
    """The whole number; text with a point is cut towards zero ("12.7" -> 12); anything else is the default."""
    text = _text(column)
    fraction = F.when(text.rlike(_DECIMAL_TEXT), F.translate(text, "_", "")).try_cast("double")
    whole = F.when(text.rlike(_INTEGER_TEXT), F.translate(text, "_", "")).try_cast("int")
    return F.coalesce(
        F.when(text.contains("."), F.when(~F.isnan(fraction), fraction).try_cast("int")).otherwise(whole),
        F.lit(int(default)),
    )


def safe_bool(column: Column, default: bool = False, *, numeric_text: bool = False) -> Column:
    """Booleans as they are, the words of TRUE_WORDS as true, all other text the default.

    ``numeric_text`` is for values taken from JSON as text, where a bare number stands for "not zero".
    """
    text = F.lower(_text(column))
    result = F.when(text.isin(*TRUE_WORDS), F.lit(True))
    if numeric_text:
        result = result.when(text.isin("false", "no"), F.lit(False))
        result = result.when(text.rlike(_DECIMAL_TEXT), safe_float(column) != 0.0)
    return F.coalesce(result, F.lit(bool(default)))


def safe_number_bool(column: Column, default: bool = False) -> Column:
    """Numbers: true unless zero; missing is the default."""
    return F.coalesce(column.cast("double") != 0.0, F.lit(bool(default)))


def safe_json(column: Column, schema: T.DataType | str) -> Column:
    """Parsed JSON; text that cannot be parsed gives an empty value of the schema."""
    return F.coalesce(F.from_json(column, schema), F.from_json(F.lit("{}"), schema))


def parse_json(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Add the fields of the JSON in a column; a field of the schema named CORRUPT takes text that is no such JSON.

    The value goes through ``inline``, so that a filter on the fields does not parse it a second time.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.select("*", F.inline(F.array(F.from_json(column, schema, options))))


def parse_ts_utc(column: Column, default: Column | datetime | None = None) -> Column:
    """Text to a UTC instant: ISO with or without offset or ``Z`` (either case), date and time, date only.

    Text without an offset is read in the session's time zone, which is UTC in this library. A missing or
    unreadable value becomes the default, which is the current time unless one is given.
    """
    text = F.translate(_text(column), "tz,", "TZ.")
    parsed = F.when(text.rlike(_TIME_TEXT), text).try_cast("timestamp")
    full = F.regexp_replace(text, _BASIC_DAY, "$1-$2-$3")
    full = F.regexp_replace(full, r"([T ]\d{2})(?=[Z+-]|$)", "$1:00")
    full = F.regexp_replace(full, r"([T ]\d{2}:\d{2})(?=[Z+-]|$)", "$1:00")
    full = F.regexp_replace(full, r"([T ].*[+-]\d{2})(?=$)", "$1:00")
    full = F.regexp_replace(full, r"([T ].*[+-]\d{2})(\d{2})$", "$1:$2")
    rare = F.when(text.rlike(_RARE_TIME_TEXT), full).try_cast("timestamp")
    if default is None:
        fallback = F.current_timestamp()
    elif isinstance(default, Column):
        fallback = default
    else:
        fallback = F.lit(default)
    return F.coalesce(parsed, rare, fallback.cast("timestamp"))


def parse_date(column: Column, default: date = DEFAULT_DATE) -> Column:
    """The date before a ``T``, ISO form only; anything else is the default."""
    text = F.regexp_replace(_text(column), r"(?U)^\s+|\s+$", "")
    day = F.regexp_replace(F.substring_index(text, "T", 1), _BASIC_DAY, "$1-$2-$3")
    return F.coalesce(F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day).try_cast("date"), F.lit(default))


def normalize_phone(column: Column) -> Column:
    """Digits and plus signs only, a leading 8 written as +7. Empty and missing stay as they are."""
    digits = F.regexp_replace(_text(column), r"[^\p{Nd}+]", "")
    return F.regexp_replace(digits, "^8", "+7")


def normalize_email(column: Column) -> Column:
    return F.lower(F.regexp_replace(_text(column), r"(?U)^\s+|\s+$", ""))


def sha256_hex(column: Column) -> Column:
    """SHA-256 in hex; empty and missing stay as they are."""
    text = _text(column)
    return F.when(F.length(text) > 0, F.sha2(text, 256)).otherwise(text)


def lower_utf8(column: Column) -> Column:
    return F.lower(column)


def clean_category(column: Column) -> Column:
    """Category name without the symbols in front, trimmed, in lower case."""
    return F.lower(F.trim(F.regexp_replace(column, LEADING_SYMBOLS, "")))


def code_map(column: Column, codes: Mapping[str, int], default: int = 0) -> Column:
    """Name to code without regard to case; unknown names get the default."""
    name = F.lower(column)
    result = None
    for value, code in codes.items():
        branch = name == value
        result = F.when(branch, F.lit(code)) if result is None else result.when(branch, F.lit(code))
    return F.lit(default) if result is None else result.otherwise(F.lit(default))
