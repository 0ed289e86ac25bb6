from __future__ import annotations

import hashlib
import math
import random
import re
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from basketry.functions import (
    Keys,
    clean_category,
    code_map,
    normalize_email,
    normalize_phone,
    parse_date,
    parse_ts_utc,
    safe_bool,
    safe_float,
    safe_int,
    safe_json,
    sha256_hex,
)
from basketry.functions.clean import PAYMENT_CODES, safe_number_bool

DEFAULT = datetime(2020, 5, 5, tzinfo=timezone.utc)


def evaluate(spark, values, expression, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [row[1] for row in df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()]


def python_float(value):
    try:
        return 0.0 if value is None else float(value)
    except ValueError:
        return 0.0


def python_int(value):
    try:
        if value is None:
            return 0
        number = int(float(value)) if "." in value else int(value)
        return number if abs(number) < 2**31 else 0  # the column holds 32 bits
    except (ValueError, OverflowError):
        return 0


NUMBERS = [None, "", " ", "12", "12.7", "-3.9", "+4", " 5 ", "1e3", "1.5e2", ".5", "5.", "abc", "1d", "1.0f", "0x1",
           "1_000", "12,5", "--1", "nan", "inf", "-Infinity", "1e", "7 8"]


def test_safe_float(spark):
    got = evaluate(spark, NUMBERS, safe_float)
    for value, result in zip(NUMBERS, got):
        expected = python_float(value)
        assert result == expected or (math.isnan(result) and math.isnan(expected)), value


def test_safe_int(spark):
    assert evaluate(spark, NUMBERS, safe_int) == [python_int(value) for value in NUMBERS]


def test_safe_numbers_of_random_text(spark):
    generator = random.Random(7)
    values = ["".join(generator.choices("0123456789.+-eE_ ", k=generator.randint(1, 5))) for _ in range(3000)]
    values = [value for value in values if "__" not in value and not re.search(r"(^|\D)_|_(\D|$)", value)]
    assert evaluate(spark, values, safe_int) == [python_int(value) for value in values]
    for value, result in zip(values, evaluate(spark, values, safe_float)):
        assert result == python_float(value), value


def test_safe_bool(spark):
    values = ["true", "TRUE", "1", "Yes", "да", "ДА", "no", "0", "2", "", None, "нет"]
    assert evaluate(spark, values, safe_bool) == [True] * 6 + [False] * 6
    assert evaluate(spark, values, lambda c: safe_bool(c, True)) == [True] * 12
    assert evaluate(spark, ["2", "0", "0.5", "да", "x", "false"], lambda c: safe_bool(c, numeric_text=True)) == [
        True, False, True, True, False, False]
    assert evaluate(spark, [True, False, None], safe_bool, "boolean") == [True, False, False]
    assert evaluate(spark, [2.0, 0.0, None], safe_number_bool, "double") == [True, False, False]


def test_safe_json(spark):
    got = evaluate(spark, ['{"a": 1}', "{bad", None, "{}"], lambda c: safe_json(c, "a int"))
    assert [row and row.a for row in got] == [1, None, None, None]
    assert got[1] is not None and got[2] is not None


TIMES = {
    "2025-03-01T10:20:30Z": "2025-03-01 10:20:30",
    "2025-03-01t10:20:30.123456z": "2025-03-01 10:20:30",
    "2025-03-01T10:20:30+03:00": "2025-03-01 07:20:30",
    "2025-03-01T10:20:30.5-05:30": "2025-03-01 15:50:30",
    "2025-03-01T10:20:30": "2025-03-01 10:20:30",
    "2025-03-01 10:20": "2025-03-01 10:20:00",
    "2025-03-01T10": "2025-03-01 10:00:00",
    "2025-03-01T10Z": "2025-03-01 10:00:00",
    "2025-03-01T10:20:30+03": "2025-03-01 07:20:30",
    "2025-03-01T10:20:30+0300": "2025-03-01 07:20:30",
    "20250301": "2025-03-01 00:00:00",
    "2025-3-1 4:5:6": "2025-03-01 04:05:06",
    "2025-3-1": "2025-03-01 00:00:00",
    "2025-03-01": "2025-03-01 00:00:00",
    "2025": None,
    "2025-13-01": None,
    "2025-02-30": None,
    "2025-03-01T25:00:00": None,
    "soon": None,
    "": None,
    None: None,
}


def test_parse_ts_utc(spark):
    got = evaluate(
        spark, list(TIMES), lambda c: F.date_format(parse_ts_utc(c, DEFAULT), "yyyy-MM-dd HH:mm:ss")
    )
    assert got == [text or "2020-05-05 00:00:00" for text in TIMES.values()]


def test_parse_ts_utc_defaults_to_now(spark):
    got = evaluate(spark, ["soon"], lambda c: (F.current_timestamp() - parse_ts_utc(c)) < F.expr("interval 1 hour"))
    assert got == [True]


def test_parse_date(spark):
    values = ["2025-03-01", " 2025-03-01 ", "2025-03-01T10:00:00Z", "2025-3-1", "x", "", None, "20250301", "2025-02-30"]
    day, default = date(2025, 3, 1), date(1970, 1, 1)
    assert evaluate(spark, values, parse_date) == [day, day, day, default, default, default, default, day, default]


@pytest.mark.parametrize(
    ("phone", "expected"),
    [("8 (900) 123-45-67", "+79001234567"), ("+7 900", "+7900"), ("7900", "7900"), ("", ""), (None, None), ("88", "+78")],
)
def test_normalize_phone(spark, phone, expected):
    assert evaluate(spark, [phone], normalize_phone) == [expected]


def test_email_and_hash(spark):
    assert evaluate(spark, [" A@B.ru\t", "", None], normalize_email) == ["a@b.ru", "", None]
    digest = hashlib.sha256("приветx".encode()).hexdigest()
    assert evaluate(spark, ["приветx", "", None], sha256_hex) == [digest, "", None]


def test_clean_category(spark):
    values = ["🥛 Молочные продукты", "🍎🍏  Фрукты ", "Напитки", "  Чай", "", "A 🥛"]
    assert evaluate(spark, values, clean_category) == ["молочные продукты", "фрукты", "напитки", "чай", "", "a 🥛"]


def test_code_map(spark):
    got = evaluate(spark, ["CARD", "cash", "Online", "x", "", None], lambda c: code_map(c, PAYMENT_CODES))
    assert got == [1, 2, 3, 0, 0, 0]


@pytest.mark.parametrize("algo", ["xxhash64", "sha256"])
def test_keys(spark, algo):
    keys = Keys(algo)
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "c"), ("c", None)], "a string, b string")
    got = [row[0] for row in df.select(keys.key(F.col("a"), F.col("b"))).collect()]
    assert len(set(got)) == 4
    zero = df.select(keys.key_if(F.col("a") == "zz", F.col("a"))).first()[0]
    assert str(zero) == "0"
    with pytest.raises(ValueError):
        Keys("md5")
