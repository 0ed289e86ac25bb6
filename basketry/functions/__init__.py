from basketry.functions.clean import (
    clean_category,
    code_map,
    lower_utf8,
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
from basketry.functions.keys import Keys
from basketry.functions.pii import mask_pii, stamp

__all__ = [
    "Keys",
    "clean_category",
    "code_map",
    "lower_utf8",
    "mask_pii",
    "normalize_email",
    "normalize_phone",
    "parse_date",
    "parse_ts_utc",
    "safe_bool",
    "safe_float",
    "safe_int",
    "safe_json",
    "sha256_hex",
    "stamp",
]
